import datetime as dt
import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from feldspark.operators import ordering as O


@pytest.mark.parametrize("kind", ["ties", "spread", "wide", "big"])
def test_selection_matches_sorting(spark, kind):
    rng = random.Random(3)
    values = {
        "ties": [7.0] * 400 + [float(rng.randint(0, 30)) for _ in range(600)],
        "spread": [rng.gauss(0, 1) for _ in range(1000)],
        "wide": [rng.choice([-1, 1]) * 10 ** rng.uniform(-9, 15) for _ in range(1000)],
        "big": [2**60 + rng.randint(0, 300) for _ in range(1000)],
    }[kind]
    df = spark.createDataFrame([(v,) for v in values], "x bigint" if kind == "big" else "x double")
    ordered = sorted(values)
    ranks = [1, 250, 251, 777, 1000]
    found = O.select_ranks(df, {"x": F.col("x")}, {"x": ranks}, {"x": 1000}, gather_rows=5)
    for r in ranks:
        v = ordered[r - 1]
        assert found["x", r] == (v, sum(w < v for w in ordered), ordered.count(v)), r


@settings(max_examples=8, deadline=None)
@given(st.lists(st.floats(-1e6, 1e6), min_size=1, max_size=60), st.integers(1, 8))
def test_quantiles_match_numpy(spark, values, gather):
    df = spark.createDataFrame([(v,) for v in values], "x double")
    got = O.exact_quantiles(df, {"x": F.col("x")}, (0.0, 0.25, 0.5, 0.75, 1.0), {"x": len(values)}, gather_rows=gather)
    assert np.allclose(got["x"], np.quantile(values, (0.0, 0.25, 0.5, 0.75, 1.0)))


def test_quantiles_of_no_rows(spark):
    df = spark.createDataFrame([], "x double")
    assert O.exact_quantiles(df, {"x": F.col("x")}, (0.5,), {"x": 0}) == {"x": [None]}


def test_useless_hints_do_no_harm(spark):
    df = spark.range(1000).select(F.col("id").cast("double").alias("x"))
    got = O.exact_quantiles(df, {"x": F.col("x")}, (0.25, 0.75), {"x": 1000}, gather_rows=5, hints={"x": [990.0, 995.0] * 2})
    assert got["x"] == [249.75, 749.25]


def _brute(rows):
    groups = {}
    for g, *key in rows:
        groups.setdefault(g, []).append(tuple(key))
    return {(g, *k): i for g, ks in groups.items() for i, k in enumerate(sorted(ks), 1)}


@pytest.mark.parametrize("chunk_rows", [7, 40, 10_000])
def test_rank_within_hot_groups(spark, chunk_rows):
    rng = random.Random(5)
    rows = [(rng.choice(["hot", "hot", "hot", "a", "b"]), rng.choice([50, 50, rng.randint(0, 99)]), i) for i in range(600)]
    df = spark.createDataFrame(rows, "g string, t int, id long")
    got = O.rank_within(df, ["g"], ["t", "id"], chunk_rows=chunk_rows)
    assert {(r.g, r.t, r.id): r.position for r in got.collect()} == _brute(rows)


def test_rank_within_by_timestamps_and_missing_group(spark):
    start = dt.datetime(2024, 1, 1)
    rows = [(None if i % 3 else "x", start + dt.timedelta(microseconds=(i * 37) % 101), i) for i in range(90)]
    df = spark.createDataFrame(rows, "g string, t timestamp_ntz, id long")
    got = O.rank_within(df, ["g"], ["t", "id"], chunk_rows=10)
    assert {(r.g, r.t, r.id): r.position for r in got.collect()} == _brute(rows)


def test_missing_order_values_come_first(spark):
    df = spark.createDataFrame([("a", None, i) for i in range(5)] + [("a", float(i), i) for i in range(20)], "g string, t double, id int")
    got = O.rank_within(df, ["g"], ["t", "id"], chunk_rows=6).collect()
    assert sorted(r.position for r in got) == list(range(1, 26))
    assert sorted(r.position for r in got if r.t is None) == [1, 2, 3, 4, 5]


def test_small_chunks_make_no_more_ranges_than_the_shuffle(spark, monkeypatch):
    """Thousands of chunks of a few rows are no thousands of tasks, and a hot group is still parted."""
    made, write = [], O.materialize
    monkeypatch.setattr(O, "materialize", lambda df, label: made.append(df.rdd.getNumPartitions()) or write(df, label))
    df = spark.range(3000).selectExpr("CASE WHEN id % 3 = 0 THEN id % 7 END AS g", "(id * 37) % 11 AS t", "id")
    got = O.rank_within(df, ["g"], ["t", "id"], chunk_rows=2)
    parts = spark.conf.get("spark.sql.shuffle.partitions")
    assert made == [int(parts)]
    rows = [(r.g, r.t, r.id) for r in df.collect()]
    assert {(r.g, r.t, r.id): r.position for r in got.collect()} == _brute(rows)
    assert O._ranges(df, 10 * O.CHUNK_ROWS, O.CHUNK_ROWS) == 10 and O._ranges(df, 50, 30) == 2


@pytest.mark.parametrize("kind", ["prefix", "long", "decimal", "null", "empty"])
def test_rank_within_whole_keys(spark, kind):
    """Values alike in their first bytes, longs beyond 2**53 and decimals of 20 digits keep their order in small chunks."""
    rng = random.Random(7)
    from decimal import Decimal

    value = {
        "prefix": lambda: "checkpoint/epoch-%03d" % rng.randrange(40), "long": lambda: (1 << 60) + rng.randrange(40),
        "decimal": lambda: Decimal("1234567890123456789.0") + rng.randrange(40), "null": lambda: None, "empty": lambda: "",
    }[kind]
    shape = {"prefix": "string", "long": "long", "decimal": "decimal(25,1)", "null": "string", "empty": "string"}[kind]
    rows = [(rng.choice(["hot"] * 5 + ["a", None]), value(), i) for i in range(200)]
    df = spark.createDataFrame(rows, f"g string, t {shape}, id long")
    got = {(r.g, r.id): r.position for r in O.rank_within(df, ["g"], ["t", "id"], chunk_rows=9).collect()}
    groups = {}
    for g, t, i in rows:
        groups.setdefault(g, []).append((t is not None, t if t is not None else 0, i))
    assert got == {(g, i): k for g, held in groups.items() for k, (_, _, i) in enumerate(sorted(held), 1)}


def test_blocks_repeat_the_tail(spark):
    df = spark.range(1, 26).withColumnRenamed("id", "p")
    rows = O.in_blocks(df, "p", 10, halo=3).collect()
    assert sorted(r.p for r in rows if r._own) == list(range(1, 26))
    assert sorted((r.p, r._block) for r in rows if not r._own) == [(8, 1), (9, 1), (10, 1), (18, 2), (19, 2), (20, 2)]
    with pytest.raises(ValueError):
        O.in_blocks(df, "p", 2, halo=3)


@pytest.mark.parametrize("how", ["left", "inner"])
def test_lookup_is_the_same_salted(spark, how):
    df = spark.range(200).selectExpr("id", "CASE WHEN id % 3 = 0 THEN 0 ELSE id % 50 END AS k")
    lookup = spark.range(40).selectExpr("id AS k", "id * 10 AS v")
    small = sorted(map(tuple, O.join_lookup(df, lookup, ["k"], how).select("id", "k", "v").collect()))
    salted = sorted(map(tuple, O.join_lookup(df, lookup, ["k"], how, max_rows=3).select("id", "k", "v").collect()))
    assert [str(x) for x in small] == [str(x) for x in salted]
    assert len(small) == sum(how == "left" or (0 if i % 3 == 0 else i % 50) < 40 for i in range(200))


def test_only_hot_keys_are_repeated(spark):
    df = spark.range(600).selectExpr("id", "CASE WHEN id % 3 = 0 THEN 7 WHEN id % 3 = 1 THEN NULL ELSE id END AS k", "'x' AS other")
    lookup = spark.range(600).selectExpr("id AS k", "id * 10 AS v")
    assert O.hot_keys(df, ["k"], 150) and len(O.hot_keys(df, ["k"], 150)) == 2 and O.hot_keys(df, ["k"], 250) == []
    for how in ("left", "inner"):
        plain = sorted((tuple(r) for r in df.join(lookup, ["k"], how).select("id", "k", "v").collect()), key=str)
        for options in ({"max_rows": 1, "hot_rows": 150, "salts": 4}, {"max_bytes": 10, "hot_rows": 10**9}):
            got = O.join_lookup(df, lookup, ["k"], how, **options)
            assert got.columns == ["k", "id", "other", "v"]
            assert sorted((tuple(r) for r in got.select("id", "k", "v").collect()), key=str) == plain


def test_order_number_keeps_microseconds(spark):
    times = [dt.datetime(2024, 3, 31, 2, 30, 0, 1), dt.datetime(2024, 3, 31, 2, 30), dt.datetime(1969, 12, 31, 23, 59, 59, 999999)]
    df = spark.createDataFrame([(t,) for t in times], "t timestamp_ntz")
    got = [r[0] for r in df.select(O.order_number(df, "t")).collect()]
    epoch = dt.datetime(1970, 1, 1)
    assert got == [(t - epoch) // dt.timedelta(microseconds=1) for t in times]
    with pytest.raises(TypeError):
        O.order_number(spark.createDataFrame([("a",)], "s string"), "s")
