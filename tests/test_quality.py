import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from feldspark.operators import filters, quality as Q
from feldspark.sources import parquet as P
from feldspark.sources import synthetic as Y


@pytest.fixture()
def raw(spark):
    return spark.range(3).selectExpr(
        "id", *[f"double(id * {i}) AS feature_{i}" for i in range(1, 5)], "timestamp'2024-01-01' AS timestamp", "int(id % 2) AS target"
    )


def test_schema_families(raw):
    assert Q.check_schema(raw, Q.RAW_SCHEMA) is raw
    shuffled = raw.select(*reversed(raw.columns)).withColumn("timestamp", F.col("timestamp").cast("timestamp_ntz"))
    assert Q.check_schema(shuffled, Q.RAW_SCHEMA) is shuffled
    with pytest.raises(Q.SchemaMismatch, match="Schema mismatch.*missing column feature_4"):
        Q.check_schema(raw.drop("feature_4"), Q.RAW_SCHEMA)
    with pytest.raises(Q.SchemaMismatch, match="extra column more"):
        Q.check_schema(raw.withColumn("more", F.lit(1)), Q.RAW_SCHEMA)
    with pytest.raises(Q.SchemaMismatch, match="feature_1"):
        Q.check_schema(raw.withColumn("feature_1", F.col("id")), Q.RAW_SCHEMA)
    assert Q.processed_schema(Q.processed_schema()) == Q.processed_schema()


def test_schema_diff_rows(spark, raw):
    rows = Q.schema_diff(raw.drop("id").withColumn("target", F.lit("a")), Q.RAW_SCHEMA).collect()
    assert [(r.column, r.problem, r.num_rows) for r in rows] == [("id", "missing", 3), ("target", "type", 3)]
    assert Q.schema_diff(raw, Q.RAW_SCHEMA).collect() == []


@pytest.mark.parametrize("dtype", ["float32", "float64", "int32", "int64", "string", "bool"])
def test_declarable_types(dtype):
    field = Q.ColumnRule("a", dtype, "categorical").struct_field()
    assert field.dataType == Q.DECLARABLE[dtype] and field.metadata["feature_type"] == "categorical"


def test_undeclarable_type():
    with pytest.raises(ValueError, match="Unsupported dtype"):
        Q.ColumnRule("a", "complex64")


def test_rules(spark):
    df = spark.createDataFrame([(1.0, "x"), (float("nan"), "z"), (9.0, None)], "a double, b string")
    rules = Q.DatasetRules("d", "1", (
        Q.ColumnRule("a", "float32", allowed_range=(0.0, 5.0)),
        Q.ColumnRule("b", "string", required=False, allowed_values=("x", "y")),
        Q.ColumnRule("c", "int64"), Q.ColumnRule("d", "int64", required=False),
    ))
    got = [sorted(r.violations) for r in rules.annotate(df).collect()]
    assert got == [["c:absent"], ["a:required", "b:values", "c:absent"], ["a:range", "c:absent"]]
    assert {r.violation: r.n for r in rules.violation_counts(df).collect()}["c:absent"] == 3
    assert Q.DatasetRules("d", "1", ()).annotate(df).first().violations == []
    assert rules.struct_type().names == ["a", "b", "c", "d"]


def test_records(spark):
    inf = float("inf")
    df = spark.createDataFrame([(1.0, 1), (None, 1), (float("nan"), None), (inf, 1), (100.0, 1)], "a double, b int")
    rows = Q.validate_records(df, ["a", "b", "z"], {"a": {"mean": 0.0, "std": 2.0}, "q": {"mean": 0.0, "std": 1.0}}).collect()
    assert rows[0].errors == ["Missing required feature: z"] and not rows[0].valid
    assert "Missing required feature: a" in rows[1].errors
    assert {"Feature a is NaN", "Missing required feature: b"} <= set(rows[2].errors) and rows[2].warnings == []
    assert "Feature a is infinite" in rows[3].errors
    assert rows[4].warnings == ["Feature a is an outlier (z-score: 50.00)"]
    assert all(r.valid for r in Q.validate_records(df.limit(1), ["a"], {}).collect())


def test_vectors(spark):
    good = spark.createDataFrame([([1.0, 2.0], 1.0), ([3.0, 4.0], 2.0)], "v array<double>, t double")
    assert Q.check_vectors(good, "v", "t") is good
    with pytest.raises(ValueError, match="same length"):
        Q.check_vectors(spark.createDataFrame([([1.0],), ([1.0, 2.0],)], "v array<double>"), "v")
    with pytest.raises(ValueError, match="targets"):
        Q.check_vectors(spark.createDataFrame([([1.0], None), ([1.0], 1.0)], "v array<double>, t double"), "v", "t")
    with pytest.raises(ValueError, match="empty"):
        Q.check_vectors(good.limit(0), "v")
    assert Q.vector_shape(good.limit(0), "v").first().valid is False


def test_projections(raw):
    assert Q.numeric_projection(raw).columns == [c for c in raw.columns if c != "timestamp"]
    assert Q.infer_features(raw, "target") == ["feature_1", "feature_2", "feature_3", "feature_4"]
    info = Q.dataset_info(raw)
    assert info["num_rows"] == 3 and info["schema"]["feature_1"] == "double"


def test_filters_ignore_nan_and_unknown(spark):
    df = spark.createDataFrame([(1.0,), (float("nan"),), (None,), (5.0,)], "x double")

    def kept(text):
        return [r.x for r in filters.apply_steps(df, [{"type": "filter", "column": "x", "condition": text}]).collect()]

    assert kept("not_null") == [1.0, 5.0] and kept("gt:2") == [5.0] and kept("lt:2") == [1.0]
    assert len(kept("unknown")) == 4
    with pytest.raises(ValueError):
        filters.apply_steps(df, [{"type": "other"}])


def test_filters_reach_the_scan(spark, tmp_path):
    spark.range(10).selectExpr("double(id) AS x", "id AS y").write.parquet(str(tmp_path / "t"))
    df = filters.apply_steps(spark.read.parquet(str(tmp_path / "t")), [{"type": "filter", "column": "x", "condition": "gt:3"}])
    plan = df.select("x")._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThan(x,3.0)" in plan and "ReadSchema: struct<x:double>" in plan


def test_model_input(spark):
    df = spark.createDataFrame([(1.0, None, 3.0), (None, 2.0, 4.0), (None, None, 5.0)], "a_norm double, a double, b double")
    rows = filters.model_input(df, ["a_norm", "b"], on_missing="flag").collect()
    assert [(r.a_norm, r.b, r.valid) for r in rows] == [(1.0, 3.0, True), (2.0, 4.0, True), (None, 5.0, False)]
    with pytest.raises(ValueError, match="Missing feature: c"):
        filters.model_input(df, ["c"])
    with pytest.raises(Exception, match="Missing feature: a_norm"):
        filters.model_input(df, ["a_norm"]).collect()


def test_sources(spark, raw, tmp_path):
    path = str(tmp_path / "raw")
    P.write_parquet(raw, path, ["target"])
    assert P.create_source(spark, "parquet", path=path).count() == 3
    with pytest.raises(FileNotFoundError):
        P.read_parquet(spark, str(tmp_path / "absent"))
    with pytest.raises(ValueError, match="Partition columns not found"):
        P.write_parquet(raw, str(tmp_path / "other"), ["absent"])
    with pytest.raises(ValueError, match="Unknown source type"):
        P.create_source(spark, "csv")
    health = P.health_check(raw)
    assert health["valid"] and health["num_rows"] == 3 and health["null_counts"]["id"] == 0
    assert not P.health_check(raw.limit(0))["valid"]


def test_synthetic(spark):
    df = P.create_source(spark, "synthetic", num_samples=2000, num_features=3, seed=1)
    assert Y.check_synthetic(df, 2000, 3) and not Y.check_synthetic(df, 5, 3)
    row = df.agg(F.avg("feature_1"), F.stddev("feature_1"), F.corr("feature_1", "feature_2")).first()
    assert abs(row[0]) < 0.1 and abs(row[1] - 1) < 0.1 and abs(row[2]) < 0.1
    again = Y.synthetic_regression(spark, 2000, 3, 1).repartition(9)
    assert sorted(map(tuple, df.collect())) == sorted(map(tuple, again.collect()))
    labelled = Y.synthetic_labelled(spark, 1500)
    share = labelled.agg(F.avg("target"), F.max("timestamp")).first()
    assert abs(share[0] - 0.5) < 0.06 and str(share[1]) == "2024-01-02 00:59:00"
    part = Y.synthetic_partitioned(spark, 1005)
    assert part.count() == 1000 and part.filter("feature_2 < 0 OR feature_2 >= 1 OR target NOT IN (0, 1)").isEmpty()
