"""Spelling variants against a plain version, in one pass and in many."""

import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from feldspark.llm import spelling as S


def plain(docs):
    c = Counter()
    for d, t in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", t or ""):
            run = "".join(chr(ord(x) + 32) if "A" <= x <= "Z" else x for x in run)
            h = zlib.crc32(f"{'' if d is None else d}:{run}".encode())
            if h % 31 == 0:
                i = h % len(run)
                run = run[:i] + run[i + 1 :]
            if len(run) >= 7:
                c[run] += 1
    v = {w: n for w, n in c.items() if n >= 2}
    near = defaultdict(set)
    for w in v:
        for x in v:
            if w != x and one_edit(w, x):
                near[w].add(x)
    form = {}
    for w, others in near.items():
        b = min(others, key=lambda x: (-v[x], x))
        if v[b] >= 10 * v[w]:
            form[w] = b

    def root(w):
        while w in form:
            w = form[w]
        return w

    return {(w, form.get(w), root(w), v[w], len(near[w]), v.get(form.get(w))) for w in v}


def one_edit(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(b) - len(a) > 1:
        return False
    i = 0
    while i < len(a) and a[i] == b[i]:
        i += 1
    return a[i + 1 :] == b[i + 1 :] if len(a) == len(b) else a[i:] == b[i + 1 :]


def corpus():
    rng = random.Random(8)
    base = ["letterl", "bookkeeper", "aaaaaaaa", "éééçççßß", "Straßenbahn", "mississippi", "x" * 300, "planetary", "planetarz", "ÀÿÀÿÀÿÀ", "ÇÇÇÇÇÇÇa"]
    docs = [(None, None), (1, ""), (2, "short words only"), (3, "no-letters 12345678"), (None, "planetary planetary")]
    for i in range(260):
        words = []
        for _ in range(12):
            w = rng.choice(base)
            if rng.random() < 0.08:
                k = rng.randrange(len(w))
                w = rng.choice([w[:k] + w[k + 1 :], w[:k] + rng.choice("aeé") + w[k:], w[:k] + rng.choice("aeÿ") + w[k + 1 :]])
            words.append(w.upper() if rng.random() < 0.1 else w)
        docs.append((rng.randrange(400), rng.choice([" ", "-", "1"]).join(words)))
    return docs + [(50, "planetary " * 900)]


@pytest.mark.parametrize("limit", [S.FILTER_BYTES, 64])
def test_variants_match_the_plain_version(spark, limit):
    docs = corpus()
    df = spark.createDataFrame([(d, t, "w", 1, "f") for d, t in docs], "doc_id long, text string, word string, n int, form string").repartition(3)
    got = {tuple(r) for r in S.variants(df, limit=limit).collect()}
    assert got == plain(docs) and any(r[1] for r in got)


def test_filters_in_pieces_hold_every_word(spark):
    words = ["w%07d" % i for i in range(5000)]
    df = spark.createDataFrame([(w.translate(str.maketrans("0123456789", "abcdefghij")), 2) for w in words], "word string, n long")
    blocks, pieces, passes = S.shards(df, 4096)
    assert pieces[8] == 3 and len(passes) == 3
    keys = S.key_rows(df, blocks, pieces)
    held = [S.built(keys, blocks, pieces, wanted) for wanted in passes]
    (size, _, codes), = S.by_length([r.word for r in df.collect()])
    mine = S._terms(codes).sum(axis=1, dtype=np.uint64)
    hit = np.sort(np.concatenate([f.has(8, mine) for f in held]))
    assert (hit == np.arange(5000)).all()
    other = np.random.default_rng(1).integers(0, 1 << 63, 20_000).astype(np.uint64)
    assert sum(len(f.has(8, other)) for f in held) < 200


def test_empty_and_chains(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert S.variants(empty).count() == 0
    forms = spark.createDataFrame([(chr(97 + i), chr(98 + i)) for i in range(20)] + [("u", None)], "word string, form string")
    assert {tuple(r) for r in S.roots(forms).collect()} == {(chr(97 + i), "u") for i in range(20)}
