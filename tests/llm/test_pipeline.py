"""The pipeline, stage by stage and as a whole, against plain Python."""

import hashlib
import random

import brute
import pytest

tiktoken = pytest.importorskip("tiktoken")
P = pytest.importorskip("public_tokenizers")

import corpus_pipeline  # noqa: E402

from feldspark.llm import bpe_tree  # noqa: E402

RNG = random.Random(21)
WORDS = ["w%d" % i for i in range(400)] + ["É", "日本", "a.b"]
BENCH = " ".join(RNG.choice(WORDS) for _ in range(40))


def prose(n):
    return " ".join(RNG.choice(WORDS) for _ in range(n))


def make_rows():
    """(doc_id, text): near and exact copies, contaminated, rejected, null, empty and repeated rows, shared passages and lines."""
    base, passage, footer = prose(150), prose(60), "subscribe to our news letter now"
    rows = [(1, None), (2, ""), (3, "too short"), (4, "again and again " * 40), (5, base), (6, base), (7, base.replace("w1 ", "v1 ")), (8, base + " end")]
    rows += [(9, prose(30) + " " + BENCH + " " + prose(30)), (10, BENCH[:60] + " " + prose(300)), (11, prose(40) + "\n" + passage + "\n" + prose(50))]
    rows += [(12, passage + " " + prose(70)), (13, prose(2000)), (None, prose(90)), (None, prose(90)), (14, prose(80)), (14, prose(80)), (14, base)]
    rows += [(100 + i, prose(60) + "\n" + footer) for i in range(30)] + [(200, footer + "\n" + prose(9))]
    return rows


ROWS = make_rows()
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, row_key string, kept_id string, spans string"


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("tables"))
    rows = [(d, t, "en", "h%d" % (i % 1), None if t is None else len(t), "a", "b", "c") for i, (d, t) in enumerate(ROWS)]
    spark.createDataFrame(rows, SCHEMA).repartition(3).write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame([(1, BENCH), (2, None)], "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")
    return path


def numbered(docs):
    """Rows in order of id (missing last), each under a number, as no id tells them apart."""
    return {i: r for i, r in enumerate(sorted(docs, key=lambda r: (r.doc_id is None, r.doc_id or 0)))}


def key(r):
    return str(r.doc_id), r.text or ""


def test_each_stage_and_the_whole(spark, folder):
    docs, held = spark.read.parquet(f"{folder}/documents.parquet"), {}
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, folder)
        held[name] = (docs.collect(), out.collect())
        if name != "encoding":
            assert out.columns == docs.columns
        docs = out

    before, after = held["quality"]
    rows = numbered(before)
    verdict = brute.lines([(i, r.source, r.text) for i, r in rows.items()], 20, 0.02)
    assert sorted(str(r.doc_id) for r in after) == sorted(str(rows[i].doc_id) for i, v in verdict.items() if v[2])
    words_left = sorted((str(rows[i].doc_id), len(brute.words(rows[i].text)) - v[1]) for i, v in verdict.items() if v[2])
    assert sorted((str(r.doc_id), len(brute.words(r.text))) for r in after) == words_left
    assert all(r.n_chars == len(r.text) and (r.row_key, r.kept_id, r.spans) == ("a", "b", "c") for r in after)
    assert {1, 2, 3, 4, 200}.isdisjoint({r.doc_id for r in after})

    before, after = held["near_dedup"]
    rows = numbered(before)
    parts = brute.near({i: r.text for i, r in rows.items()})
    groups = {}
    for i, (_, c, _) in parts.items():
        groups.setdefault(c, set()).add(key(rows[i]))
    assert len(after) == len(groups)
    left = [key(r) for r in after]
    assert all(sum(k in g for k in left) == 1 for g in groups.values())
    assert all(int(min((k for k in g), key=lambda k: (k[0] == "None", int(k[0]) if k[0] != "None" else 0))[0]) in {r.doc_id for r in after}
               for g in groups.values() if any(k[0] != "None" for k in g))

    before, after = held["substring_dedup"]
    rows = numbered(before)
    want = brute.substring({i: r.text for i, r in rows.items()})
    assert sorted(brute.sha(" ".join(brute.words(r.text))) for r in after) == sorted(w[2] for w in want.values())
    assert sum(w[1] for w in want.values()) > 100

    before, after = held["decontamination"]
    rows = numbered(before)
    want = brute.contamination({i: r.text for i, r in rows.items()}, [(1, BENCH), (2, None)])
    assert sorted(map(key, after)) == sorted(key(rows[i]) for i, w in want.items() if not w[4])
    assert 9 not in {r.doc_id for r in after}

    before, after = held["encoding"]
    encoding = bpe_tree.Codec(P.path("byte_bpe_50k.tiktoken"), P.PATTERN).encoding
    want = []
    for r in before:
        ids = encoding.encode_ordinary(r.text)
        want.append((str(r.doc_id), len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(), brute.sha(r.text)))
    assert sorted((str(r.doc_id), r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in after) == sorted(want)

    final = sorted((str(r.doc_id), r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in corpus_pipeline.run(spark, folder).collect())
    assert final == sorted(want)


def test_empty_tables(spark, folder, tmp_path):
    spark.createDataFrame([], SCHEMA).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
