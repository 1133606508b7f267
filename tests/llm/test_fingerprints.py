"""Fingerprints against a plain version with another library's hashes."""

import hashlib

import numpy as np
import pytest
from pyspark.sql import functions as F

xxhash = pytest.importorskip("xxhash")

from feldspark.llm import fingerprints as P  # noqa: E402

LONG = " ".join("w%d" % (i % 700) for i in range(3000))
TEXTS = {
    1: None, 2: "", 3: " \n\t", 4: "one", 5: "One two", 6: "a b c d e", 7: "A B\tC  D\nE", 8: "a b c d e f g h " * 30, 9: "日本語 é ß x y z w",
    10: LONG, 11: LONG, 12: LONG[: len(LONG) // 2] + " tail of another kind entirely", 13: "x" * 20_000, 14: "😀" * 9 + " é é é é é",
}


def signed(x):
    return x - (1 << 64) if x >> 63 else x


def chained(parts, size=8):
    h = 42
    for p in parts:
        raw = p.encode() if isinstance(p, str) else (p & ((1 << (8 * size)) - 1)).to_bytes(size, "little")
        h = xxhash.xxh64(raw, seed=h).intdigest()
    return h


def pair(a, b):
    """xxhash64 of a long and an int."""
    h = xxhash.xxh64((a & ((1 << 64) - 1)).to_bytes(8, "little"), seed=42).intdigest()
    return xxhash.xxh64((b & ((1 << 32) - 1)).to_bytes(4, "little"), seed=h).intdigest()


def words_of(text):
    text = (text or "").lower()
    for c in "\t\n\x0b\x0c\r":
        text = text.replace(c, " ")
    return [w for w in text.split(" ") if w]


def plain(text):
    w = words_of(text)
    if not w:
        return []
    grams = [w[i : i + 5] for i in range(len(w) - 4)] if len(w) >= 5 else [w]
    hashes = {(chained(g) >> 2) & ~1 for g in grams}
    shift = 62 - P.BIN_BITS
    least = {}
    for h in hashes:
        least[h >> shift] = min(h, least.get(h >> shift, h))
    lanes = []
    for j in range(P.BINS):
        x = least.get(j)
        if x is None:
            tries = (signed(_int_pair(j, t)) % P.BINS for t in range(P.TRIES))
            hit = next((b for b in tries if b in least), None)
            if hit is None:
                hit = min(least, key=lambda b: signed(_mixed(j, b)))
            x = least[hit]
        lanes.append(pair(x, j) & 255)
    return lanes


def _int_pair(a, b):
    h = xxhash.xxh64(a.to_bytes(4, "little"), seed=42).intdigest()
    return xxhash.xxh64(b.to_bytes(4, "little"), seed=h).intdigest()


def _mixed(a, b):
    h = xxhash.xxh64(a.to_bytes(4, "little"), seed=42).intdigest()
    return xxhash.xxh64(b.to_bytes(8, "little"), seed=h).intdigest()


def text_of(lanes):
    out = ""
    for i in range(0, len(lanes), 8):
        out += "".join("%02x" % x for x in reversed(lanes[i : i + 8]))
    return out


def jaccard(a, b):
    sets = [{tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} for w in map(words_of, (a, b))]
    return len(sets[0] & sets[1]) / len(sets[0] | sets[1])


def test_fingerprints_are_those_of_the_plain_version(spark):
    df = spark.createDataFrame(list(TEXTS.items()), "doc_id long, text string").repartition(3)
    got = {r.doc_id: r.f for r in P.fingerprints(df).select("doc_id", P.as_text(F.col("fingerprint")).alias("f")).collect()}
    assert got == {d: text_of(plain(t)) for d, t in TEXTS.items()}


def test_compare_against_plain_rows(spark):
    schema = "doc_id long, text string, fingerprint string, h int, bucket string, copy string"
    df = spark.createDataFrame([(d, t, "x", 1, "y", "z") for d, t in TEXTS.items()], schema).repartition(4)
    got = {r.doc_id: r for r in P.compare(df).collect()}
    order = sorted(TEXTS, reverse=True)
    assert set(got) == set(TEXTS)
    for k, d in enumerate(order):
        text, after = TEXTS[d] or "", TEXTS[order[(k + 1) % len(order)]] or ""
        half = len(text) // 2
        edited = text[: len(text) - half] + after[:half]
        r = got[d]
        assert r.n_chars == len(text) and r.edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        assert r.fingerprint == text_of(plain(text)) and r.edited_fingerprint == text_of(plain(edited))
        assert 0 <= r.near_next <= 1 and 0 <= r.near_edited <= 1
        if text == edited:
            assert r.near_edited == 1
    assert got[11].near_next == 1  # equal texts
    assert abs(got[12].near_next - jaccard(TEXTS[12], TEXTS[11])) < 0.15


def test_estimates_are_near_the_truth(spark):
    rng = np.random.default_rng(3)
    rows, truth = [], []
    for i in range(60):
        a = ["v%d" % x for x in rng.integers(0, 5000, 400)]
        b = list(a)
        b[: int(400 * i / 60)] = ["u%d" % x for x in rng.integers(0, 5000, int(400 * i / 60))]
        rows.append((i, " ".join(a), " ".join(b)))
        truth.append(jaccard(rows[-1][1], rows[-1][2]))
    df = spark.createDataFrame(rows, "i int, a string, b string")
    got = df.select("i", P.likeness(P.fingerprint(F.col("a")), P.fingerprint(F.col("b"))).alias("x")).orderBy("i").collect()
    errors = np.array([r.x for r in got]) - truth
    assert np.abs(errors).mean() < 0.03 and abs(errors.mean()) < 0.015 and np.abs(errors).max() < 0.12


def test_missing_and_repeated_ids_and_hot_ids(spark):
    rows = [(None, "t%d is here with words" % i) for i in range(30)] + [(7, "same text for all of them")] * 20 + [(7, "other %d" % i) for i in range(10)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    pairs = P.edit_pairs(df, bucket_bytes=64)
    got = pairs.select("did", "text", "edited").collect()
    assert sorted(r.text for r in got) == sorted(t for _, t in rows)
    # the order is by id, then by hash of the text; equal rows follow each other
    same = "same text for all of them"
    assert sum(r.edited == same[:13] + same[:12] for r in got if r.text == same) >= 19
    buckets = P.with_bucket(df.selectExpr("coalesce(doc_id, -9223372036854775808) AS did", "xxhash64(text) AS h"), 12)
    assert buckets.where(f"did = {-(1 << 63)}").select("bucket").distinct().count() > 3
    ranges = buckets.groupBy("bucket").agg(F.min(F.struct("did", "h")).alias("a"), F.max(F.struct("did", "h")).alias("b")).orderBy("bucket").collect()
    assert all(x.b < y.a for x, y in zip(ranges, ranges[1:]))


def test_one_row_and_none(spark):
    one = spark.createDataFrame([(5, "alone in the table today")], "doc_id long, text string")
    assert P.compare(one).first().near_next == 1
    assert P.compare(one.limit(0)).count() == 0


def test_no_python_in_the_plan(spark):
    df = spark.createDataFrame([(5, "alone")], "doc_id long, text string")
    plan = P.compare(df)._jdf.queryExecution().executedPlan().toString()
    assert not any(word in plan for word in ("Python", "Arrow", "Pandas"))
