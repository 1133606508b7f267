import math

import pytest
from pyspark.sql import functions as F

from feldspark.operators import serving as V
from feldspark.operators.store import DatasetNotFound, FeatureStore, new_version, path_partitions
from feldspark.plans.flows import build_features


@pytest.fixture()
def store(spark, tmp_path):
    return FeatureStore(spark, str(tmp_path / "store"))


def test_statistics_of_the_counting_set(store, counting):
    version = store.write(counting, "d", description="x", tags={"a": "b"})
    df, known = store.read("d", version)
    s = known.feature_stats["feature_1_norm"]
    assert (s["mean"], s["min"], s["max"], s["count"], s["null_count"]) == (49.5, 0.0, 99.0, 100, 0)
    assert set(known.feature_stats) == {"feature_1_norm", "feature_2_norm", "feature_3", "feature_4"}
    assert known.num_rows == df.count() == 100 and known.schema["id"] == "bigint" and known.tags == {"a": "b"}


def test_partitions_and_order_of_columns(store, counting, tmp_path):
    df = counting.withColumn("split", F.when(F.col("id") < 50, "train").otherwise("test"))
    store.write(df.select("split", "id"), "d", "1.0.0", partition_cols=["split"])
    back, known = store.read("d", "1.0.0")
    assert known.partitions == ["split"] and back.columns == ["split", "id"]
    assert back.filter("split = 'train'").count() == 50
    assert (tmp_path / "store" / "d" / "v=1.0.0" / "split=train").exists()
    assert path_partitions("/data/d/v=1.0.0/split=train/date=2024-01-01") == ["split", "date"]
    assert path_partitions("/data/d/v=1.0.0") == []


def test_latest_is_the_newest_not_the_greatest(store, counting):
    for i, version in enumerate(["v9", "v10", "v2"]):
        store.write(counting.withColumn("new", F.lit(i)), "d", version)
    df, known = store.read("d")
    assert known.version == "v2" and df.first()["new"] == 2
    row = store.list_datasets().first()
    assert (row["latest_version"], row.num_rows, row.num_versions) == ("v2", 100, 3)


def test_same_version_of_two_datasets(store, counting):
    store.write(counting, "a", "v1")
    store.write(counting.limit(5), "b", "v1")
    assert store.metadata("a", "v1").num_rows == 100 and store.metadata("b", "v1").num_rows == 5
    with pytest.raises(ValueError, match="already exists"):
        store.write(counting, "a", "v1")
    store.write(counting.limit(7), "a", "v1", overwrite=True)
    assert store.read("a", "v1")[0].count() == 7


def test_not_found_and_delete(store, counting):
    with pytest.raises(DatasetNotFound, match="not found"):
        store.read("d")
    with pytest.raises(DatasetNotFound, match="Metadata not found"):
        store.metadata("d", "v1")
    with pytest.raises(DatasetNotFound):
        store.delete("d")
    store.write(counting, "d", "v1")
    store.write(counting, "d", "v2")
    store.delete("d", "v2")
    assert store.metadata("d").version == "v1"
    store.delete("d")
    assert store.list_datasets().collect() == []


def test_empty_and_without_statistics(store, counting):
    store.write(counting.limit(0), "d", "v1", partition_cols=["target"])
    df, known = store.read("d")
    assert df.count() == 0 and known.num_rows == 0 and df.columns == counting.columns
    store.write(counting, "d", "v2", compute_stats=False)
    assert store.metadata("d", "v2").feature_stats == {}


@pytest.mark.parametrize("rows", [1, 10, 1000])
def test_sizes(store, spark, rows):
    store.write(spark.range(rows).selectExpr("id", "double(id) AS feature_1_norm", "id % 2 AS target"), "d", "v1")
    known = store.metadata("d")
    assert known.num_rows == rows and known.feature_stats["feature_1_norm"]["max"] == rows - 1


def test_version_ids(store, counting):
    assert len(new_version()) == 8 and len(new_version("uuid")) == 36
    assert "_" in new_version("timestamp") and new_version("v1.2.3") == "v1.2.3"
    for bad in ("../x", "a/b", ""):
        with pytest.raises(ValueError, match="Not a valid"):
            store.write(counting, bad, "v1")


def test_failed_write_is_not_seen(store, counting):
    broken = counting.withColumn("feature_9", F.raise_error(F.lit("boom")).cast("double"))
    with pytest.raises(Exception, match="boom"):
        store.write(broken, "d", "v1")
    with pytest.raises(DatasetNotFound):
        store.read("d")
    store.write(counting, "d", "v1")
    assert store.read("d")[0].count() == 100


def test_build_features(store, counting):
    version = build_features(store, counting, "features")
    df, known = store.read("features", version)
    assert "feature_3_log" in df.columns and known.tags == {"stage": "features"}


def test_transform_records(spark):
    df = spark.createDataFrame([(3.0, 4.0), (None, 1.0)], "feature_1 double, feature_2 double")
    stats = {"feature_1_norm": {"mean": 1.0, "std": 2.0}, "feature_2": {"mean": 0.0, "std": 0.0}, "other": {"mean": 0.0, "std": 1.0}}
    rows = V.transform_records(df, stats).collect()
    assert (rows[0].feature_1_norm, rows[0].feature_2_norm, rows[0].feature_interaction) == (1.0, 0.0, 0.0)
    assert rows[1].feature_1_norm is None and rows[1].feature_interaction is None
    assert "feature_interaction" not in V.transform_records(df, stats, interaction=False).columns
    assert V.transform_records(df, {"feature_1": {"std": 2.0}}).columns == df.columns
    assert V.transform_records(df, {}).columns == df.columns


def test_saved_stats(spark, tmp_path):
    path = str(tmp_path / "stats")
    V.save_stats(spark, path, {"a": {"mean": 1.0, "std": 2.0, "min": 0.0, "max": 3.0, "count": 4}}, "one")
    V.save_stats(spark, path, {"b": {"mean": math.pi, "std": 2.0, "min": 0.0, "max": 3.0, "count": 4}}, "two", "text")
    rows = {r.name: r for r in V.load_stats(spark, path).collect()}
    assert rows["two"].mean == math.pi and rows["one"].num_features == 1 and rows["two"].description == "text"


def test_prediction_log_is_repeatable(spark):
    df = spark.range(5).withColumn("x", F.col("id") * 1.0)
    log = V.prediction_log(V.score_linear(df, ["x"], [2.0], 1.0), "id", "3", "b1", features=["x"])
    ids = [r.prediction_id for r in log.collect()]
    assert ids == [r.prediction_id for r in log.collect()] and len(set(ids)) == 5 and len(ids[0]) == 36
    assert sorted(r.prediction for r in log.collect()) == [1.0, 3.0, 5.0, 7.0, 9.0]
    assert V.batch_summary(log).first()["count"] == 5


def test_latest_versions(spark):
    df = spark.createDataFrame([("a", "9"), ("a", "10"), ("a", "x"), ("b", "v1"), ("b", "v2")], "model string, version string")
    assert {r.model: r.latest_version for r in V.latest_versions(df).collect()} == {"a": "10", "b": "v2"}


def test_failing_second_step_keeps_the_old_version(store, counting, monkeypatch):
    from feldspark.operators import store as module

    store.write(counting, "d", "1", overwrite=True)
    monkeypatch.setattr(module, "create_file", lambda spark, path, text, real=module.create_file: (
        real(spark, path, text) if "_reserved" in path else (_ for _ in ()).throw(OSError("no space"))))
    with pytest.raises(OSError):
        store.write(counting.limit(3), "d", "1", overwrite=True)
    monkeypatch.undo()
    df, known = store.read("d", "1")
    assert df.count() == 100 and known.num_rows == 100
    store.write(counting.limit(3), "d", "1", overwrite=True)
    assert store.read("d", "1")[0].count() == 3 and store.catalog().count() == 1
    store.delete("d", "1")
    assert store.catalog().count() == 0


def test_of_two_writers_the_later_one_fails(store, counting, monkeypatch):
    from feldspark.operators import store as module

    real = module.write_parquet

    def slow(df, path, *args, **kwargs):
        monkeypatch.setattr(module, "write_parquet", real)
        store.write(counting.limit(7), "d", "1", overwrite=True)  # another writer comes and commits in between
        real(df, path, *args, **kwargs)

    monkeypatch.setattr(module, "write_parquet", slow)
    with pytest.raises(ValueError, match="already exists"):
        store.write(counting, "d", "1", overwrite=True)
    assert store.read("d", "1")[0].count() == 7


def test_failing_first_write_leaves_nothing(store, counting):
    with pytest.raises(Exception):
        store.write(counting.withColumn("x", F.raise_error(F.lit("bad")).cast("int")), "d", "1")
    assert store.catalog().collect() == []
    with pytest.raises(LookupError):
        store.read("d", "1")
    store.write(counting, "d", "1")
    assert store.read("d")[0].count() == 100
