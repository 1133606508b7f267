"""Each operator against plain Python: small texts with nulls, ties, repeats, long and empty ones."""

import base64
import glob
import gzip
import hashlib
import random
import tracemalloc
import zlib
from pathlib import Path

import brute
import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

tiktoken = pytest.importorskip("tiktoken")
P = pytest.importorskip("public_tokenizers")

from feldspark.llm import (  # noqa: E402
    arrays, bpe_tree, decontaminate, line_frequency, minhash_tensor, pu_quality, substring_dedup, suffix_dedup, superkmers, token_orc,
    toxicity_knn, warc_chunks,
)
from feldspark.llm.frames import id_and_text, own_keys  # noqa: E402

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
RNG = random.Random(5)
WORDS = ["w%d" % i for i in range(300)] + ["É", "ß", "日本", "a.b", "x,y", "#", "<|b|>"]


def prose(n, rng=RNG):
    return " ".join(rng.choice(WORDS) for _ in range(n))


def make_texts():
    rng = random.Random(11)
    passage, base = prose(60, rng), prose(120, rng).split()
    texts = {
        1: None, 2: "", 3: " \n\t ", 4: "one", 5: "one two three four", 6: "One  TWO\tthree FOUR", 7: prose(34, rng), 8: prose(35, rng),
        9: prose(50, rng) + "\n" + passage + "\n" + prose(9, rng), 10: passage, 11: prose(3, rng) + " " + passage, 12: "a b " * 90,
        13: "same line here\n" * 12 + prose(30, rng), 14: prose(4000, rng) + passage, 15: "x" * 5000, 16: "x" * 250, 17: "日本語" * 90,
    }
    for i in range(20, 40):  # a family of near copies
        copy = list(base)
        for _ in range(i % 4):
            copy[rng.randrange(len(copy))] = "edit%d" % i
        texts[i] = " ".join(copy)
    for i in range(40, 50):  # exact copies
        texts[i] = texts[9]
    for i in range(50, 60):
        texts[i] = prose(rng.randrange(1, 200), rng)
    return texts


TEXTS = make_texts()


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(d, t, "en", "s%d" % (d % 2), None) for d, t in TEXTS.items()]
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def odd(spark):
    """Rows with missing ids, repeated rows, and columns whose names the operators use themselves."""
    rows = [(1, "", 9), (1, "", 9), (None, prose(40), 9), (None, None, 9), (2, TEXTS[9], 9), (2, TEXTS[9], 9), (3, TEXTS[9], 9)]
    df = spark.createDataFrame(rows, "doc_id long, text string, did long")
    return df.selectExpr("*", "did AS spans", "did AS own_id", "did AS removed_lines", "did AS judged_id", "did AS spans_", "did AS n_words_",
                         "did AS s", "did AS e", "did AS score", "did AS y", "did AS id", "'h' AS source", "cast(null AS long) AS n_chars", "'en' AS lang")


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def got(df, *columns):
    return {r["doc_id"]: tuple(r[c] for c in columns) for r in df.collect()}


# ---- windows


SUBSTRING = ("n_words", "n_removed", "kept_sha256")
SUFFIX = ("n_bytes", "n_removed", "n_spans", "kept_sha256")


def test_substring(docs):
    assert got(substring_dedup.remove_repeats(docs), *SUBSTRING) == brute.substring(TEXTS)


def test_suffix(docs):
    assert got(suffix_dedup.remove_repeats(docs), *SUFFIX) == brute.suffix(TEXTS)


@pytest.mark.parametrize("operator, columns, want", [(substring_dedup, SUBSTRING, brute.substring), (suffix_dedup, SUFFIX, brute.suffix)])
def test_heavy_buckets_are_parted(docs, monkeypatch, operator, columns, want):
    monkeypatch.setattr(superkmers, "BUCKET_BYTES", 200)
    monkeypatch.setattr(superkmers, "HEAVY", 0.5)
    monkeypatch.setattr(superkmers, "parts_for", lambda *a: 5)
    assert superkmers.measure(id_and_text(docs), superkmers.Units(35, 4, True), 5, 0)
    assert got(operator.remove_repeats(docs), *columns) == want(TEXTS)


@pytest.mark.parametrize("batch", [1, 700, 20_000])
def test_windows_do_not_depend_on_batches(docs, monkeypatch, batch):
    monkeypatch.setattr(arrays, "BATCH_BYTES", batch)
    assert got(substring_dedup.remove_repeats(docs.repartition(1)), *SUBSTRING) == brute.substring(TEXTS)
    assert got(suffix_dedup.remove_repeats(docs.repartition(1)), *SUFFIX) == brute.suffix(TEXTS)


def test_windows_of_odd_rows(odd, empty):
    rows = substring_dedup.remove_repeats(odd).collect()
    assert len(rows) == odd.count()
    n = len(brute.words(TEXTS[9]))
    assert [(r.n_words, r.n_removed) for r in rows if r.doc_id in (2, 3)] == [(n, n)] * 3
    assert [r.n_removed for r in rows if r.doc_id == 1] == [0, 0]
    rows = suffix_dedup.remove_repeats(odd).collect()
    assert sorted((r.doc_id, r.n_removed > 0) for r in rows if r.doc_id in (2, 3)) == [(2, False), (2, True), (3, True)]
    assert substring_dedup.remove_repeats(empty).count() == suffix_dedup.remove_repeats(empty).count() == 0


def test_strip_repeats(docs, odd, empty):
    out = {r["doc_id"]: r for r in substring_dedup.strip_repeats(docs).collect()}
    want = brute.substring(TEXTS)
    for d, t in TEXTS.items():
        assert brute.sha(" ".join(brute.words(out[d]["text"]))) == want[d][2]
        if not want[d][1]:
            assert (out[d]["text"], out[d]["n_chars"]) == (t, None)
        else:
            assert out[d]["n_chars"] == len(out[d]["text"])
    assert substring_dedup.strip_repeats(odd).columns == odd.columns and substring_dedup.strip_repeats(odd).count() == odd.count()
    assert substring_dedup.strip_repeats(empty).count() == 0


def test_refine_is_the_order_of_equal_strings():
    data = np.frombuffer(bytes(RNG.choice(b"ab") for _ in range(3000)), np.uint8)
    for size in (3, 8, 11, 40, 100):
        at = np.arange(len(data) - size)
        names = suffix_dedup.refine(data, at, size)
        raw = data.tobytes()
        by_text = {}
        for i, n in zip(at.tolist(), names.tolist()):
            assert by_text.setdefault(raw[i : i + size], n) == n
        assert len(set(by_text.values())) == len(by_text)


# ---- lines


@pytest.mark.parametrize("min_docs, share", [(20, 0.02), (3, 0.0), (1, 0.3)])
def test_lines(docs, min_docs, share):
    columns = ("base_failed", "n_line_words", "kept")
    want = brute.lines([(d, "s%d" % (d % 2), t) for d, t in TEXTS.items()], min_docs, share)
    verdicts = line_frequency.judge(docs, min_docs, share)
    assert got(verdicts, *columns) == want
    assert got(verdicts, *line_frequency.STATS) == {d: brute.base(t) for d, t in TEXTS.items()}
    left = got(line_frequency.strip_lines(docs, verdicts), "text", "n_chars")
    assert set(left) == {d for d, w in want.items() if w[2]}
    for d, (text, n) in left.items():
        assert len(brute.words(text)) == len(brute.words(TEXTS[d])) - want[d][1]
        assert n == len(text)


def test_lines_of_odd_rows(odd, empty):
    verdicts = line_frequency.judge(odd, 1, 0.0)
    assert verdicts.count() == odd.count()
    assert not [r for r in verdicts.collect() if r.doc_id == 1 and r.kept]
    rows, key = own_keys(odd)
    out = line_frequency.strip_lines(rows, line_frequency.judge(rows, 1, 0.0, id_col=key), key)
    assert out.columns == rows.columns
    assert sorted(r.doc_id for r in out.where("doc_id IS NOT NULL").select("doc_id").collect())[:2] == [2, 2]
    assert line_frequency.judge(empty).count() == 0


# ---- contamination


ITEMS = [(1, TEXTS[10]), (2, "one two"), (3, None), (4, ""), (5, "日本語"), (1, "w1 w2"), (7, TEXTS[14][-300:])]
CONTAMINATION = ("n_words", "n_hit", "n_items", "items_sha256", "contaminated")


@pytest.mark.parametrize("block", [1 << 20, 200])
def test_contamination(spark, docs, block):
    bench = spark.createDataFrame(ITEMS, "item_id long, text string")
    want = brute.contamination(TEXTS, ITEMS)
    assert got(decontaminate.judge(docs, bench, block_bytes=block), *CONTAMINATION) == want
    left = decontaminate.remove_contaminated(docs, bench, block_bytes=block)
    assert {r.doc_id: r.text for r in left.collect()} == {d: TEXTS[d] for d, w in want.items() if not w[4]}
    longest = decontaminate.matches(docs, bench, block_bytes=block).where("doc_id = 10 AND item_id = '1' AND item_word = 0").collect()
    assert [(r.doc_word, r.length) for r in longest] == [(0, want[10][0])]


def test_contamination_of_odd_rows(spark, odd, empty):
    bench = spark.createDataFrame(ITEMS, "item_id long, text string")
    assert decontaminate.judge(odd, bench).count() == odd.count()
    assert decontaminate.remove_contaminated(odd, bench).columns == odd.columns
    assert decontaminate.judge(empty, bench).count() == 0
    none = decontaminate.judge(odd, bench.limit(0)).collect()
    assert len(none) == odd.count() and not any(r.contaminated for r in none)


# ---- tokens


def test_token_files(spark, docs, odd, empty, tmp_path, capsys):
    from tokenizers import Tokenizer

    path = P.path("word_bpe_49k.json")
    plain = Tokenizer.from_file(path)
    token_orc.write_tokens(docs, str(tmp_path / "a"), path, file_bytes=2000)
    read = token_orc.read_tokens(spark, str(tmp_path / "a"))
    at, want = 0, {}
    for d in sorted(TEXTS):
        ids = plain.encode(TEXTS[d] or "", add_special_tokens=False).ids + [2]
        want[d] = (at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        at += len(ids)
    assert got(token_orc.checksums(read), "start", "n_tokens", "ids_crc32") == want
    found = token_orc.lookup(spark, str(tmp_path / "a"), [9, 11])
    assert sorted(r.doc_id for r in found.collect()) == [9, 11]
    found.explain("formatted")
    assert "PushedFilters: [In(doc_id" in capsys.readouterr().out
    orc = pytest.importorskip("pyarrow.orc")
    ids = [v for f in sorted(glob.glob(str(tmp_path / "a" / "*.orc"))) for v in orc.ORCFile(f).read(["doc_id"])["doc_id"].to_pylist()]
    assert ids == sorted(TEXTS)  # files and rows ascend
    token_orc.write_tokens(odd, str(tmp_path / "b"), path)
    rows = token_orc.read_tokens(spark, str(tmp_path / "b")).orderBy("start").collect()
    assert [r.doc_id for r in rows] == [None, None, 1, 1, 2, 2, 3]
    assert [r.start + r.n_tokens for r in rows][:-1] == [r.start for r in rows][1:]
    token_orc.write_tokens(empty, str(tmp_path / "c"), path)
    assert token_orc.checksums(token_orc.read_tokens(spark, str(tmp_path / "c"))).count() == 0


ALPHABET = ["'", "'s", "'ll", "'re", "l", "r", "e", " ", "  ", "\n", "\t", "a", "B", "é", "ß", "1", "22", "!", "?!", "…", "日本", " ", "　",
            "<|endoftext|>", "<|startoftext|>", "<|StartOfText|>", "<|", "J̌", "İ", "ΑΣ", "K", ".", ",", "...", "H̱", "́", "\x85", "\x1c"]


def strings(n, size):
    rng = random.Random(n)
    return ["".join(rng.choice(ALPHABET) for _ in range(rng.randrange(size))) for _ in range(n)]


def test_pieces_are_those_of_the_tokenizer():
    from tokenizers import Tokenizer

    path = P.path("word_bpe_49k.json")
    plain, pieces = Tokenizer.from_file(path), token_orc.Pieces(path)
    texts = strings(1500, 30)
    ids, sizes = pieces.encode([t.encode() for t in texts])
    assert np.split(ids, np.cumsum(sizes)[:-1])[7].tolist() == plain.encode(texts[7], add_special_tokens=False).ids
    assert ids.tolist() == [i for t in texts for i in plain.encode(t, add_special_tokens=False).ids]


def test_encoder_memory_is_bounded(monkeypatch):
    path, rng = P.path("word_bpe_49k.json"), random.Random(6)
    words = ["".join(rng.choices("abcdefghij", k=7)) for _ in range(20_000)]
    texts = [" ".join(rng.choices(words, k=250)) for _ in range(4000)]  # 8 MB
    pieces, sums, kept = token_orc.Pieces(path), [], []
    tracemalloc.start()
    for _, part in arrays.batches(pa.array(texts), token_orc.TEXT_BYTES):
        ids, sizes = pieces.encode(part)
        sums.append(int(ids.sum()))
        kept.append(sizes)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 150e6
    # a cache that is begun afresh again and again gives the same ids
    monkeypatch.setattr(token_orc, "CACHE", 5000)
    small = token_orc.Pieces(path)
    again = [small.encode(part) for _, part in arrays.batches(pa.array(texts), token_orc.TEXT_BYTES // 16)]
    assert sum(int(ids.sum()) for ids, _ in again) == sum(sums) and small.n < pieces.n == len(set(words))
    assert np.array_equal(np.concatenate([s for _, s in again]), np.concatenate(kept))


def codec():
    return bpe_tree.Codec(P.path("byte_bpe_50k.tiktoken"), P.PATTERN)


def test_tree_joins_are_exact():
    tree = codec()
    rng = random.Random(3)
    for text in [*strings(1500, 60), " " * 300, "a" * 300, "a" + " " * 200 + "b", "'" * 90, "\n \n" * 60]:
        want = tree.encoding.encode_ordinary(text)
        assert tree.encode(text, rng.randrange(1, 12)).tolist() == want
        assert tree.decode(np.array(want, np.uint32), 5) == text.encode()
        assert tree.decimal(np.array(want, np.uint32)) == " ".join(map(str, want)).encode()


def test_bpe(spark, docs, odd, empty):
    path, tree = P.path("byte_bpe_50k.tiktoken"), codec()
    want = {}
    for d, t in TEXTS.items():
        ids = tree.encoding.encode_ordinary(t or "")
        want[d] = (len(ids), brute.sha(" ".join(map(str, ids))), brute.sha(t or ""))
    tokens = bpe_tree.encode(docs, path, P.PATTERN, leaf=50)
    assert got(bpe_tree.digests(tokens, path, P.PATTERN), "n_tokens", "ids_sha256", "decoded_sha256") == want
    assert got(bpe_tree.decode(tokens, path, P.PATTERN), "data") == {d: ((t or "").encode(),) for d, t in TEXTS.items()}
    assert bpe_tree.digests(bpe_tree.encode(odd, path, P.PATTERN), path, P.PATTERN).count() == odd.count()
    assert bpe_tree.encode(empty, path, P.PATTERN).count() == 0
    assert base64 and tiktoken


# ---- scores


def labelled_texts(spark, n=900):
    rng = random.Random(2)
    bad = ["bilge", "scurvy", "dreck"]
    rows, labels = [], []
    for i in range(n):
        toxic, poor = i % 5 == 0, i % 4 == 0
        words = [rng.choice(WORDS[:200]) for _ in range(60)]
        if toxic:
            words[3] = words[40] = rng.choice(bad)
        text = " ".join(words)
        rows.append((i, text.upper().replace(" ", " $$ ") if poor else text))
        if i % 3:
            labels.append((i, 0 if poor else 1, int(toxic)))
    rows += [(n, ""), (n + 1, None), (None, "bilge water")]
    labels += [(None, 1, 1), (5, None, None), (1, None, 0), (1, 1, 0)]
    return spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")


@pytest.mark.parametrize("score, truth, fold, folds", [
    (pu_quality.score, lambda i: i % 4 != 0, 2, 4), (toxicity_knn.score, lambda i: i % 5 == 0, 1, 3),
])
def test_scores_on_held_out_texts(spark, empty, score, truth, fold, folds):
    docs, labels = labelled_texts(spark)
    rows = score(docs, labels).collect()
    assert len(rows) == docs.count()
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.7) for r in rows)
    assert all(r.held_out == (r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % folds == fold) for r in rows)
    held = [r for r in rows if r.held_out and r.doc_id < 900]
    assert sum(r.predicted == truth(r.doc_id) for r in held) >= 0.97 * len(held)
    assert score(empty, labels).count() == 0
    assert score(docs, labels.limit(0)).count() == docs.count()


def test_scores_ignore_held_out_labels(spark):
    docs, labels = labelled_texts(spark, 300)
    for score, label, fold, folds in ((pu_quality.score, "quality", 2, 4), (toxicity_knn.score, "toxic", 1, 3)):
        other = labels.withColumn(label, F.when(pu_quality.remainder("doc_id", folds) == fold, 1 - F.col(label)).otherwise(F.col(label)))
        a, b = ({r.doc_id: r.score for r in score(docs, x).collect()} for x in (labels, other))
        assert a == b


def test_risk_gradient_keeps_the_bracket_non_negative():
    rng = np.random.default_rng(0)
    positive, unlabelled = rng.normal(1, 1, (300, 3)), np.concatenate([rng.normal(1, 1, (500, 3)), rng.normal(-1, 1, (500, 3))])
    model = pu_quality.fit(positive, unlabelled, 0.5)
    assert (model.score(unlabelled[:500]) > 0.5).mean() > 0.8 > 0.2 > (model.score(unlabelled[500:]) > 0.5).mean()


def test_risk_and_its_gradient_by_differences():
    """One step without momentum moves against the numerical gradient of the risk, on either side of zero."""
    rng = np.random.default_rng(2)
    for shift, prior in ((0.0, 0.4), (1.5, 0.9)):
        p, u = rng.normal(1, 1, (200, 2)), rng.normal(shift, 1, (300, 2))
        both = np.concatenate([p, u])
        z = lambda x: pu_quality.expand((x - both.mean(axis=0)) / both.std(axis=0))
        start = pu_quality.fit(p, u, prior, steps=7)
        at = np.append(start.weights, start.bias)
        softplus = lambda f: np.logaddexp(0, f).mean()

        def parts(v):
            fp, fu = z(p) @ v[:-1] + v[-1], z(u) @ v[:-1] + v[-1]
            return prior * softplus(-fp), softplus(fu) - prior * softplus(fp)

        bracket = parts(at)[1]
        goal = (lambda v: sum(parts(v))) if bracket >= 0 else (lambda v: -parts(v)[1])
        numeric = np.array([(goal(at + e) - goal(at - e)) / 2e-6 for e in np.eye(len(at)) * 1e-6])
        after = pu_quality.fit(p, u, prior, steps=8, decay=0.0)
        before = pu_quality.fit(p, u, prior, steps=7, decay=0.0)
        earlier = pu_quality.fit(p, u, prior, steps=6, decay=0.0)
        flat = lambda m: np.append(m.weights, m.bias)
        step = flat(after) - flat(before) - 0.9 * (flat(before) - flat(earlier))
        assert np.allclose(step, -pu_quality.RATE * numeric, atol=2e-3)


@pytest.mark.parametrize("prior", [0.2, 0.5, 0.9])
def test_prior_is_near_the_true_share(prior):
    rng = np.random.default_rng(5)
    n = 6000
    good = rng.random(n) < prior
    unlabelled = rng.normal(np.where(good, 2.0, -2.0)[:, None], 1, (n, 4))
    assert abs(pu_quality.estimate_prior(rng.normal(2, 1, (3000, 4)), unlabelled) - prior) < 0.05


def test_neighbours_are_exact():
    rng = np.random.default_rng(1)
    n, terms = 700, 40
    dense = rng.random((n, terms)) * (rng.random((n, terms)) < 0.15)
    dense[5] = dense[6] = dense[7]
    dense /= np.maximum(np.linalg.norm(dense, axis=1, keepdims=True), 1e-12)
    owner, term = np.nonzero(dense)
    index = toxicity_knn.Index(owner, term, dense[owner, term], n, terms, 16)
    for q in range(0, n, 7):
        t = np.flatnonzero(dense[q])
        if len(t):
            best, cosine = index.nearest(t, dense[q][t], 9, q)
            full = dense @ dense[q]
            full[q] = -1
            want = np.lexsort((np.arange(n), -np.round(full, 9)))[:9]
            want = want[full[want] > 0]
            assert best.tolist() == want.tolist() and np.allclose(cosine, full[want])


def test_neighbours_of_whole_texts(spark):
    rng = random.Random(8)
    words = ["w%d" % i for i in range(2000)]
    docs = {i: " ".join(rng.choices(words[: rng.choice((40, 400, 2000))], k=rng.choice((1, 3, 20, 80)))) for i in range(240)}
    docs |= {240: "", 241: None, 242: docs[7].upper(), 243: "seen nowhere else", 244: docs[8] + " strange strange words"}
    labels = [(i, int(rng.random() < 0.2)) for i in range(0, 230)]
    frames = spark.createDataFrame(list(docs.items()), "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, toxic int")
    out = {r.doc_id: r for r in toxicity_knn.score(*frames).collect()}
    want = brute.neighbours(docs, [i for i, _ in labels if zlib.crc32(str(i).encode()) % 3 != 1], toxicity_knn.K)
    assert out.keys() == want.keys() and len(want[242]) == toxicity_knn.K and not want[243]
    for i, near in want.items():
        assert out[i].neighbours == [e for e, _ in near]
        assert np.allclose(out[i].cosines, [c for _, c in near], atol=1e-9)


def test_scores_move_little(spark, monkeypatch):
    """Only words of examples are counted ahead, by their place; texts of examples are not moved unless an id repeats; neighbours travel by place."""
    seen = {}

    def watched(df, label):
        seen[label] = df.columns, df._jdf.queryExecution().executedPlan().toString(), [tuple(r) for r in df.collect()]
        return materialize(df, label)

    materialize = toxicity_knn.materialize
    monkeypatch.setattr(toxicity_knn, "materialize", watched)
    docs = {i: f"common w{i % 7} rare{i // 2} alone{i}" for i in range(40)} | {40: "", 41: None, 42: "nowhere nowhere else"}
    labels = spark.createDataFrame([(i, i % 2) for i in range(12)], "doc_id long, toxic int")
    out = {r.doc_id: r for r in toxicity_knn.score(spark.createDataFrame(list(docs.items()), "doc_id long, text string"), labels).collect()}
    examples = [i for i in range(12) if zlib.crc32(str(i).encode()) % 3 != 1]
    for i, near in brute.neighbours(docs, examples, toxicity_knn.K).items():
        assert out[i].neighbours == [e for e, _ in near] and np.allclose(out[i].cosines, [c for _, c in near], atol=1e-12)
    assert "first(" not in seen["examples"][1]
    words = {w for i in examples for w in docs[i].split()}
    df = {w: sum(w in (t or "").split() for t in docs.values()) for w in {w for t in docs.values() for w in (t or "").split()} - words}
    assert sorted(r[1] for r in seen["terms"][2]) == pytest.approx([1 + np.log((1 + len(docs)) / (1 + n)) for n in sorted(df.values(), reverse=True) if n > 1])
    assert "labels" not in seen["votes"][0] and "places" in seen["votes"][0]

    twice = spark.createDataFrame([*docs.items(), (1, docs[1]), (41, "one more")], "doc_id long, text string")
    rows = toxicity_knn.score(twice, labels).collect()
    assert len(rows) == len(docs) + 2 and "first(" in seen["examples"][1]
    assert len({(r.score, tuple(r.neighbours), tuple(r.cosines)) for r in rows if r.doc_id == 1}) == 1


def test_scores_without_examples(spark):
    """Every word is one that no example holds, also where a word is in all texts."""
    docs = spark.createDataFrame([(i, f"common w{i}") for i in range(9)] + [(None, None)], "doc_id long, text string")
    labels = spark.createDataFrame([], "doc_id long, toxic int")
    rows = toxicity_knn.score(docs, labels).collect()
    assert [(r.score, r.neighbours) for r in rows] == [(0.0, [])] * 10


# ---- archives


def archive_rows(rows):
    first = {}
    for i, _, html in rows:
        b = (html or "").encode()
        if len(b) >= 100 and i is not None:
            first[b] = min(first.get(b, i), i)
    out = []
    for i, _, html in rows:
        b = (html or "").encode()
        f = first.get(b)
        again = f is not None and (i is None or i > f)
        out.append((i, len(b), hashlib.sha256(b).hexdigest(), "revisit" if again else "response", f if again else None))
    return sorted(out, key=str)


@pytest.mark.parametrize("size", [7, 100, 1 << 20])
def test_archives(spark, tmp_path, size):
    x = "é\r\n\r\n" * 100
    rows = [(1, "u", x), (2, None, x), (2, "a b\r\nX: y", x), (3, "", None), (4, "u", ""), (5, "u", ""), (6, "u", "\r\n\r\n"), (None, "u", x),
            (None, "u", "q" * 500), (None, "u", "q" * 500), (9, "u", "日本" * 1000), (9, "u", "日本" * 1000), (10, "u", "WARC/1.1\r\n" * 40)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    table = warc_chunks.chunk_table(warc_chunks.classify(pages), size)
    assert max(len(r.data) for r in table.collect()) <= size + 3
    warc_chunks.write_archives(table, str(tmp_path / "w"))
    read = warc_chunks.read_archives(spark, str(tmp_path / "w"))
    assert sorted(map(tuple, warc_chunks.payload_index(read).collect()), key=str) == archive_rows(rows)
    heads = [gzip.open(f).read() for f in glob.glob(str(tmp_path / "w" / "*.gz"))]
    assert all(h.startswith(b"WARC/1.1\r\n") and h.endswith(b"\r\n\r\n") for h in heads if h)
    # files of bounded size, and rows as those of few large ones
    warc_chunks.write_archives(table.coalesce(1), str(tmp_path / "small"), 400, 1000)
    small = glob.glob(str(tmp_path / "small" / "*.gz"))
    assert len(small) > 3 and max(len(gzip.open(f).read()) for f in small) < 1000 + size + 2000
    again = warc_chunks.payload_index(warc_chunks.read_archives(spark, str(tmp_path / "small")))
    assert sorted(map(tuple, again.collect()), key=str) == archive_rows(rows)
    warc_chunks.write_archives(warc_chunks.chunk_table(warc_chunks.classify(pages.limit(0))), str(tmp_path / "none"))
    assert warc_chunks.payload_index(warc_chunks.read_archives(spark, str(tmp_path / "none"))).count() == 0


# ---- near duplicates


NEAR = ("n_shingles", "component_id", "kept")


@pytest.mark.parametrize("bands", [14, 3])
def test_near_components(docs, bands):
    assert got(minhash_tensor.near_components(docs, bands=bands), *NEAR) == brute.near(TEXTS)


def test_near_components_of_odd_rows(odd, empty):
    rows = minhash_tensor.near_components(odd).collect()
    assert len(rows) == odd.count()
    assert sorted((r.doc_id, r.component_id, r.kept) for r in rows if r.doc_id) == [(1, 1, True)] * 2 + [(2, 2, False), (2, 2, True), (3, 2, False)]
    assert minhash_tensor.near_components(empty).count() == 0


def test_marks_of_pairs_are_compared_in_full(spark):
    """Unequal marks from bit planes, and what bins allow, as mark by mark."""
    rng = np.random.default_rng(3)
    for width in (1, 12, 56, 64, 70):
        x = rng.integers(0, 16, (40, width)).astype(np.uint64)
        y = np.where(rng.random((40, width)) < 0.5, x, rng.integers(0, 16, (40, width)).astype(np.uint64))
        longs = [minhash_tensor.bit_planes(z).view(np.int64).tolist() for z in (x, y)]
        df = spark.createDataFrame([(i, *pair) for i, pair in enumerate(zip(*longs))], "i long, m array<long>, m_ array<long>")
        found = [r.d for r in df.withColumn("d", minhash_tensor._mismatches("m", "m_", width)).orderBy("i").collect()]
        assert found == (x != y).sum(axis=1).tolist()
    rows, sizes = [], []
    for share in (0.0, 0.5, 0.6, 0.65, 0.7, 0.75, 0.8, 1.0):
        for n in (1, 5, 60, 700, 9000):
            both = rng.integers(0, 1 << 63, n).astype(np.uint64) * np.uint64(2)
            keep = int(n * share)
            for h in (both, np.append(both[:keep], rng.integers(0, 1 << 63, n - keep).astype(np.uint64) * np.uint64(2))):
                h = np.unique(h)
                rows.append(minhash_tensor.bin_marks(h, np.zeros(len(h), np.int64), 1)[0])
                sizes.append(len(h))
    w, other = np.array(rows[0::2]), np.array(rows[1::2])
    total = np.array(sizes[0::2]) + np.array(sizes[1::2])
    want = []
    for p, q, n in zip(w.tolist(), other.tolist(), total.tolist()):
        marks = [[sum((z[8 * k + i // 64] >> i % 64 & 1) << k for k in range(4)) for i in range(512)] for z in (p, q)]
        differ = sum(a != b for a, b in zip(*marks))
        either = sum(a > 0 or b > 0 for a, b in zip(*marks))
        spread = either * (0.75 * 0.25 * (1 - min(1.0, either / (n / 1.75))) + 0.25 * 14 / 225)
        want.append(differ <= 0.25 * 14 / 15 * either + 4.5 * spread**0.5 + 1)
    pairs = zip(range(len(want)), w.view(np.int64).tolist(), other.view(np.int64).tolist(), sizes[0::2], sizes[1::2])
    df = spark.createDataFrame(list(pairs), "i int, w array<long>, w_ array<long>, n long, n_ long")
    assert [r.ok for r in df.withColumn("ok", minhash_tensor._bins_allow()).orderBy("i").collect()] == want and 0 < sum(want) < len(want)
    h = np.sort(rng.integers(0, 1 << 63, 200).astype(np.uint64) * np.uint64(2))
    for n in (1, 3):  # the middle of three texts is empty
        owner = np.repeat(np.arange(n)[::2], [100, 100][:n - n // 2] if n > 1 else [200])
        planes = minhash_tensor.bin_marks(h if n == 1 else np.concatenate([h[:100], h[100:]]), owner, n)
        least = {}
        for x, o in sorted(zip(h.tolist(), owner.tolist())):
            least.setdefault((o, x >> 55), x)
        dense = [[0] * 512 for _ in range(n)]
        for (o, b), x in least.items():
            dense[o][b] = 1 + int(arrays.mix(np.array([x], np.uint64))[0]) % 15
        assert (minhash_tensor.bit_planes(np.array(dense, np.uint64)) == planes).all()
    assert minhash_tensor.bin_marks(h[:0], np.zeros(0, np.int64), 2).tolist() == [[0] * 32] * 2


def test_half_keys_and_pairs_in_plain_plans(docs):
    """The second collection is counted among documents left by the first; the dearest condition of a pair comes last."""
    sketches = minhash_tensor.sketches(id_and_text(docs), 5, 4, 2).where("n > 0").cache()
    rows = {r.did: r for r in sketches.collect()}
    some = set(list(rows)[::2])

    def shared(side, ids):
        halves = [h for i in ids for h in set(getattr(rows[i], side))]
        found = {i: {h for h in getattr(rows[i], side) if halves.count(h) > 1} for i in ids}
        return {i: h for i, h in found.items() if h}

    ids = docs.sparkSession.createDataFrame([(i,) for i in some], "did long")
    in_a = minhash_tensor._shared_halves(sketches, ids, "a")
    assert {r.did: set(r.a) for r in in_a.collect()} == shared("a", some)
    in_b = minhash_tensor._shared_halves(sketches, in_a.select("did"), "b")
    assert {r.did: set(r.b) for r in in_b.collect()} == shared("b", shared("a", some))
    comp = sketches.select("did", F.col("did").alias("comp"))
    tried = docs.sparkSession.createDataFrame([], "u long, v long, linked boolean")
    pairs = minhash_tensor._across(sketches.drop("f1", "f2"), comp, tried, 0.5, 16)
    plan = pairs._jdf.queryExecution().optimizedPlan().toString()
    assert 0 < plan.index("array_intersect") < plan.index("exists(")
    near = {tuple(sorted(p)) for p in pairs.collect()}
    sets = {i: set(s.tolist()) for i, s in zip(rows, minhash_tensor.shingle_sets([(TEXTS[i] or "").encode() for i in rows]))}
    linked = {(i, j) for i in rows for j in rows if i < j and 4 * len(sets[i] & sets[j]) >= 3 * len(sets[i] | sets[j])}
    meet = {(i, j) for i, j in linked if set(rows[i].a) & set(rows[j].a) and set(rows[i].b) & set(rows[j].b)}
    assert meet and meet <= near


def test_pairs_are_confirmed_together(monkeypatch):
    """Texts of a run are cut into shingles in one call, each once; runs are bounded by bytes of text."""
    zstandard = minhash_tensor.zstandard
    packed = [zstandard.compress(bytes([97 + i]) * 100) for i in range(4)]
    monkeypatch.setattr(arrays, "BATCH_BYTES", 250)
    left, right = [packed[i] for i in (0, 1, 2, 3, 0)], [packed[i] for i in (1, 0, 2, 3, 3)]
    runs = list(minhash_tensor._together(left, right))
    assert [len(r) for r in runs] == [2, 2, 1] and [p for r in runs for p in r] == list(zip(left, right))
    assert list(minhash_tensor._together([], [])) == []


def test_rows_without_own_ids_do_not_touch_each_other(spark):
    """Every row is a document of its own, whatever its id: results equal those of the same texts under unique ids."""
    texts = [prose(80, random.Random(i)) for i in range(6)]
    texts += [texts[0], texts[0][:400] + " " + prose(9, random.Random(70)), "", None]
    ids = [None, None, None, 4, 4, 4, None, 4, None, 4]
    df = spark.createDataFrame(list(zip(ids, texts)), "doc_id long, text string").repartition(3)
    order = sorted(range(len(ids)), key=lambda i: (ids[i] is None, ids[i] or 0))
    rows, key = own_keys(df)
    place = {}
    for r in rows.collect():
        place.setdefault((r.doc_id, r.text), []).append(r[key])
    assert len({k for ks in place.values() for k in ks}) == len(ids) and len(order) == rows.count()
    unique = {k: t for (_, t), ks in place.items() for k in ks}
    back = {k: i for (i, _), ks in place.items() for k in ks}
    for operator, columns, want in ((substring_dedup, SUBSTRING, brute.substring), (suffix_dedup, SUFFIX, brute.suffix)):
        rows_out = sorted((str(r.doc_id), *(r[c] for c in columns)) for r in operator.remove_repeats(df).collect())
        assert rows_out == sorted((str(back[k]), *v) for k, v in want(unique).items())
    near = sorted((str(r.doc_id), r.n_shingles, str(r.component_id), r.kept) for r in minhash_tensor.near_components(df).collect())
    assert near == sorted((str(back[k]), n, str(back[c]), kept) for k, (n, c, kept) in brute.near(unique).items())


# two words of 1,024 letters whose polynomials agree modulo 2**64, whatever the base
def thue_morse(letters, n=1024):
    return "".join(letters[bin(i).count("1") % 2] for i in range(n))


TWINS = thue_morse("ab"), thue_morse("ba")


def test_words_with_equal_polynomials_stay_apart(spark, tmp_path):
    data = [np.frombuffer(t.encode(), np.uint8) for t in TWINS]
    ends = [np.array([0]), np.array([1024])]
    assert arrays.slice_hash(arrays.prefix_hash(data[0]), *ends) == arrays.slice_hash(arrays.prefix_hash(data[1]), *ends)
    assert arrays.exact_hash(arrays.exact_prefix(data[0]), *ends) != arrays.exact_hash(arrays.exact_prefix(data[1]), *ends)
    tail = " one two three four five six seven eight nine ten eleven twelve"
    texts = {i: f"{TWINS[i % 2]} {TWINS[i // 2 % 2]} x{i}{tail}" for i in range(8)}
    df = spark.createDataFrame([(d, t, "h") for d, t in texts.items()], "doc_id long, text string, source string")
    assert got(minhash_tensor.near_components(df), *NEAR) == brute.near(texts)
    assert got(line_frequency.judge(df, 1, 0.0), *line_frequency.STATS) == {d: brute.base(t) for d, t in texts.items()}
    one_line = {i: f"{TWINS[i % 2]}\n{prose(12, random.Random(i))}" for i in range(6)}
    lines_df = spark.createDataFrame([(d, t, "h") for d, t in one_line.items()], "doc_id long, text string, source string")
    assert got(line_frequency.judge(lines_df, 2, 0.0), "base_failed", "n_line_words", "kept") == brute.lines([(d, "h", t) for d, t in one_line.items()], 2, 0.0)
    items = spark.createDataFrame([(1, TWINS[0] + tail)], "item_id long, text string")
    assert got(decontaminate.judge(df, items), *CONTAMINATION) == brute.contamination(texts, [(1, TWINS[0] + tail)])
    pieces = token_orc.Pieces(P.path("word_bpe_49k.json"))
    ids, sizes = pieces.encode([t.encode() for t in TWINS])
    want = [pieces.tokenizer.encode(t, add_special_tokens=False).ids for t in TWINS]
    assert ids.tolist() == want[0] + want[1] and sizes.tolist() == [len(w) for w in want]


def test_components(spark):
    rng = random.Random(4)
    links = [(rng.randrange(400), rng.randrange(400)) for _ in range(260)] + [(i, i + 1) for i in range(1000, 1040)] + [(7, 7)]
    parent = {x: x for e in links for x in e}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        x, y = find(a), find(b)
        parent[max(x, y)] = min(x, y)
    out = {r.node: r.root for r in minhash_tensor.components(spark.createDataFrame(links, "u long, v long")).collect()}
    assert all(out.get(x, x) == find(x) for x in parent)


def test_index_of_many_terms():
    """Queries of several hundred terms among a million: exact neighbours, and little memory beside the sums."""
    rng, n, terms = np.random.default_rng(8), 300, 1_000_000
    held = [np.unique(np.append(rng.integers(0, 2000, 280), rng.integers(0, terms, 40))) for _ in range(n)]
    weights = [w / np.linalg.norm(w) for w in (rng.random(len(h)) + 0.1 for h in held)]
    owner = np.repeat(np.arange(n), [len(h) for h in held])
    index = toxicity_knn.Index(owner, np.concatenate(held), np.concatenate(weights), n, terms, 16)
    queries = [(held[i], weights[i], i) for i in range(0, n, 3)] + [(np.array([], np.int64), np.array([]), -1)]
    tracemalloc.start()
    found = index.nearest_of(queries, 7)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 5e6
    for (term, weight, skip), (near, cosine) in zip(queries, found):
        full = np.zeros(terms)
        full[term] = weight
        sums = np.array([full[h] @ w for h, w in zip(held, weights)])
        sums[skip if skip >= 0 else slice(0)] = 0
        want = [i for i in np.lexsort((np.arange(n), -np.round(sums, 9))) if sums[i] > 0][:7]
        assert near.tolist() == want and np.allclose(cosine, sums[want], rtol=1e-12)


def test_real_tables(spark):
    folder = Path("/root/testdata/sf0.001")
    if not folder.exists():
        pytest.skip("no test tables")
    docs = spark.read.parquet(str(folder / "documents.parquet"))
    texts = {r.doc_id: r.text for r in docs.collect()}
    assert got(substring_dedup.remove_repeats(docs), *SUBSTRING) == brute.substring(texts)
    assert got(suffix_dedup.remove_repeats(docs), *SUFFIX) == brute.suffix(texts)
    assert got(minhash_tensor.near_components(docs), *NEAR) == brute.near(texts)
