import hashlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from feldspark.operators import splits as S


def _h(seed, key):
    return hashlib.md5(f"{seed}:{key}".encode()).hexdigest()


def _expected(keys, order, train=0.7, validation=0.15):
    ranked = sorted(keys, key=order)
    a = int(len(ranked) * train)
    b = a + int(len(ranked) * validation)
    return {k: "train" if i < a else "validation" if i < b else "test" for i, k in enumerate(ranked)}


def test_random_is_stable_and_near_its_shares(spark):
    df = spark.range(4000)
    one = {r.id: r.split for r in S.random_split(df, "id").collect()}
    two = {r.id: r.split for r in S.random_split(df.repartition(7), "id").collect()}
    assert one == two
    share = Counter(one.values())
    assert abs(share["train"] / 4000 - 0.7) < 0.03 and abs(share["test"] / 4000 - 0.15) < 0.03
    assert one != {r.id: r.split for r in S.random_split(df, "id", seed=1).collect()}


def test_holdout(spark):
    assert {r.split for r in S.holdout(spark.range(50), "id", 0.0).collect()} == {"train"}
    assert {r.split for r in S.holdout(spark.range(50), "id").collect()} == {"train", "validation"}


@pytest.mark.parametrize("bin_rows", [4, 1_000_000])
def test_stratified_is_exact_per_stratum(spark, bin_rows):
    rows = [(i, "hot" if i % 3 else ("one" if i == 0 else None if i % 2 else "rest")) for i in range(500)]
    df = spark.createDataFrame(rows, "id long, s string")
    got = {r.id: r.split for r in S.stratified_split(df, "id", "s", bin_rows=bin_rows).collect()}
    want = {}
    for s in {s for _, s in rows}:
        want |= _expected([i for i, t in rows if t == s], lambda k: _h(42, k))
    assert got == want


@pytest.mark.parametrize("bin_rows", [3, 1_000_000])
def test_groups_stay_whole(spark, bin_rows):
    df = spark.range(600).selectExpr("id", "CASE WHEN id % 3 = 0 THEN 0 ELSE id % 41 END AS g")
    rows = S.group_split(df, "g", bin_rows=bin_rows).collect()
    want = _expected(sorted({r.g for r in rows}), lambda g: _h(42, g))
    assert {(r.g, r.split) for r in rows} == set(want.items())


def test_one_group_and_no_rows(spark):
    df = spark.range(5).withColumn("g", F.lit("a"))
    assert {r.split for r in S.group_split(df, "g").collect()} == {"test"}
    assert S.group_split(df.limit(0), "g").collect() == []
    assert S.time_split(df.limit(0), "id", "id").collect() == []
    assert S.stratified_split(df.limit(0), "id", "g").collect() == []


@pytest.mark.parametrize("gather", [3, 50_000])
def test_time_split_with_ties(spark, gather):
    rows = [(i, (i * 7) % 5 if i % 2 else 3) for i in range(300)]
    df = spark.createDataFrame(rows, "id long, t long")
    got = {r.id: r.split for r in S.time_split(df, "t", "id", gather_rows=gather).collect()}
    times = dict(rows)
    assert got == _expected(list(times), lambda k: (times[k], k))


@pytest.mark.parametrize("times", [1, 3])
def test_time_split_cuts_string_keys_in_their_order(spark, times):
    keys = ["order/2024/number-%05d" % i for i in range(300)] + ["", "a", "ab", "é", "日本", "order/2024/number-"]
    rows = [(k, i % times) for i, k in enumerate(keys)]
    df = spark.createDataFrame(rows, "id string, t int").repartition(4)
    got = {r.id: r.split for r in S.time_split(df, "t", "id", gather_rows=20).collect()}
    order = [k for k, t in sorted(rows, key=lambda r: (r[1], r[0].encode()))]
    a, b = int(len(rows) * 0.7), int(len(rows) * 0.15)
    assert [got[k] for k in order] == ["train"] * a + ["validation"] * b + ["test"] * (len(rows) - a - b)


def test_time_split_by_decimals(spark):
    from decimal import Decimal

    rows = [(i, Decimal("12345678901234.%04d" % ((i * 37) % 500))) for i in range(500)]
    df = spark.createDataFrame(rows, "id long, t decimal(18,4)")
    got = {r.id: r.split for r in S.time_split(df, "t", "id").collect()}
    order = [i for i, _ in sorted(rows, key=lambda r: r[1])]
    assert [got[i] for i in order] == ["train"] * 350 + ["validation"] * 75 + ["test"] * 75


def test_time_split_string_keys_and_missing_times(spark):
    rows = [(f"k{i}", None if i < 10 else float(i % 4)) for i in range(100)]
    df = spark.createDataFrame(rows, "id string, t double")
    got = S.time_split(df, "t", "id").collect()
    assert Counter(r.split for r in got) == {"train": 70, "validation": 15, "test": 15}
    assert {r.split for r in got if r.t is None} == {"train"}


def test_dispatch(spark):
    df = spark.range(100).withColumn("g", F.col("id") % 4)
    with pytest.raises(ValueError, match="sum to 1"):
        S.Splitter("id", 0.5, 0.1, 0.1)
    with pytest.raises(ValueError, match="Unknown strategy"):
        S.Splitter("id", strategy="other")
    for strategy, column in (("stratified", "stratify_col"), ("time_based", "time_col"), ("group_based", "group_col")):
        with pytest.raises(ValueError, match=column):
            S.Splitter("id", strategy=strategy).split(df)
        assert S.Splitter("id", strategy=strategy, **{column: "g"}).split(df).count() == 100
    labelled = S.default_splitter("id").split(df)
    assert sum(p.count() for p in S.parts(labelled).values()) == 100


@pytest.mark.parametrize("kind", ["timestamp", "timestamp_ntz", "date"])
def test_time_split_of_time_types(spark, kind):
    df = spark.range(200).withColumn(
        "t", F.expr(f"cast(timestamp_ntz'2024-03-30 22:00:00.000001' + make_dt_interval(0, id % 50) AS {kind})")
    ).withColumn("t", F.when(F.col("id") >= 5, F.col("t")))
    got = {r.id: (r.t, r.split) for r in S.time_split(df, "t", "id", gather_rows=4).collect()}
    low = (False, 0)
    ranked = _expected(list(got), lambda k: (low if got[k][0] is None else (True, got[k][0]), k))
    assert {k: s for k, (_, s) in got.items()} == ranked


@pytest.mark.parametrize("bin_rows", [4, 1_000_000])
def test_stratified_with_a_hot_key(spark, bin_rows):
    df = spark.range(300).selectExpr("CASE WHEN id % 3 = 0 THEN 0 ELSE id END AS k", "id % 2 AS s")
    rows = S.stratified_split(df, "k", "s", bin_rows=bin_rows).collect()
    assert len(rows) == 300
    want = {}
    for s in (0, 1):
        keys = sorted((r.k for r in rows if r.s == s), key=lambda k: _h(42, k))
        a = int(len(keys) * 0.7)
        b = a + int(len(keys) * 0.15)
        one, two = _h(42, keys[a - 1]), _h(42, keys[b - 1])
        want |= {(s, k): "train" if _h(42, k) <= one else "validation" if _h(42, k) <= two else "test" for k in keys}
    assert {(r.s, r.k): r.split for r in rows} == want


def test_empty_shares(spark):
    df = spark.range(40).withColumn("g", F.lit("a"))
    rows = S.stratified_split(df, "id", "g", train=0.0, validation=0.0).collect()
    assert {r.split for r in rows} == {"test"}
