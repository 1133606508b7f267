import math

import numpy as np
import pytest

from feldspark.operators.preprocess import Preprocessor
from feldspark.operators.recipe import Recipe, default_recipe, fill_interaction
from feldspark.operators.stats import (
    column_stats, epoch_loss, null_profile, record_stats, record_stats_map, regression_metrics, target_distribution,
)
from feldspark.plans.flows import preprocess_table
from feldspark.operators.quality import SchemaMismatch


def _column(df, name):
    return [r[name] for r in df.collect()]


def test_fit_skips_missing(spark):
    values = [1.0, 2.0, float("nan"), None, 10.0]
    df = spark.createDataFrame([(v,) for v in values], "feature_1 double")
    s = Preprocessor().fit(df).complete().stats["feature_1"]
    known = np.array([1.0, 2.0, 10.0])
    assert s["mean"] == pytest.approx(known.mean()) and s["std"] == pytest.approx(known.std(ddof=1))
    assert (s["min"], s["max"]) == (1.0, 10.0)
    assert [s["q25"], s["q75"]] == pytest.approx(list(np.quantile(known, [0.25, 0.75])))


def test_transform_before_fit_and_bad_options():
    with pytest.raises(ValueError, match="fitted"):
        Preprocessor().transform(None)
    with pytest.raises(ValueError):
        Preprocessor("other")
    with pytest.raises(ValueError):
        Preprocessor(clip_mode="other")


def test_outliers_on_both_sides(spark):
    values = [0.0] * 50 + [1.0] * 50 + [100.0, -100.0]
    df = spark.createDataFrame([(v,) for v in values], "feature_1 double")
    fitted = Preprocessor().fit(df)
    scaled = _column(fitted.transform(df), "feature_1_norm")
    assert max(scaled) == pytest.approx(3.0) and min(scaled) == pytest.approx(-3.0)
    fitted.clip_mode = "null"
    assert _column(fitted.transform(df), "feature_1_norm").count(None) == 2


def test_names_order_and_in_place(spark):
    df = spark.createDataFrame([(1, 1.0, 2.0), (2, 3.0, 6.0)], "id int, feature_1 double, feature_2_norm double")
    done = Preprocessor("minmax").fit_transform(df)
    assert done.columns == ["id", "feature_2_norm", "feature_1_norm"]
    assert sorted(map(tuple, done.collect())) == [(1, 0.0, 0.0), (2, 1.0, 1.0)]


@pytest.mark.parametrize("method", ["standard", "minmax", "robust"])
def test_constant_one_row_and_empty(spark, method):
    df = spark.createDataFrame([(5.0,), (5.0,)], "feature_1 double")
    assert set(_column(Preprocessor(method).fit_transform(df), "feature_1_norm")) == {0.0}
    assert _column(Preprocessor(method).fit_transform(df.limit(1)), "feature_1_norm") == [0.0]
    none = spark.createDataFrame([(None,)], "feature_1 double")
    assert _column(Preprocessor(method).fit_transform(none), "feature_1_norm") == [None]


def test_approximate_quartiles(spark, counting):
    s = Preprocessor().fit(counting, approx=True).stats["feature_3"]
    assert abs(s["q25"] - 74.25) <= 3 and abs(s["q75"] - 222.75) <= 3


def test_state_roundtrip(spark, counting, tmp_path):
    fitted = Preprocessor("robust", clip_threshold=2.0).fit(counting)
    fitted.save(spark, str(tmp_path / "state"))
    assert Preprocessor.load(spark, str(tmp_path / "state")) == fitted


def test_preprocess_table_checks(spark, counting, tmp_path):
    raw = spark.range(20).selectExpr(
        "id", *[f"float(id * {i}) AS feature_{i}" for i in range(1, 5)], "timestamp_ntz'2024-01-01' AS timestamp", "id % 2 AS target"
    )
    done = preprocess_table(spark, raw, str(tmp_path / "out"), str(tmp_path / "state"))
    assert done.count() == 20 and "feature_4_norm" in done.columns
    with pytest.raises(SchemaMismatch):
        preprocess_table(spark, counting, str(tmp_path / "o"), str(tmp_path / "s"))
    with pytest.raises(ValueError, match="empty"):
        preprocess_table(spark, raw.limit(0), str(tmp_path / "o"), str(tmp_path / "s"))


def test_recipe_defaults_and_resolution(spark, counting):
    made = default_recipe().transform(counting)
    assert made.columns[-5:] == [
        "feature_1_norm_feature_2_norm_interaction", "feature_1_norm_poly_2", "feature_2_norm_poly_2", "feature_3_log", "feature_4_log",
    ]
    row = made.filter("id = 3").first()
    assert row["feature_1_norm_feature_2_norm_interaction"] == 18.0 and row["feature_2_norm_poly_2"] == 36.0
    assert row["feature_3_log"] == pytest.approx(math.log(10.0))
    assert "feature_1_norm_feature_2_norm_interaction" not in default_recipe(False).transform(counting).columns
    assert Recipe().transform(counting) is counting
    with pytest.raises(ValueError, match="Missing feature"):
        Recipe().add_log("absent").transform(counting)
    renamed = counting.withColumnRenamed("feature_3", "feature_3_norm")
    assert "feature_3_log" in default_recipe().transform(renamed).columns


def test_dependent_statistics(spark, counting):
    made = (
        Recipe().add_standardization("feature_3", "z").add_polynomial("z", 2, "zz").add_standardization("zz", "w")
        .add_expression("twice", "w * 2").add_polynomial("feature_3", 1, "feature_3").transform(counting)
    )
    w = np.array(_column(made, "w"))
    assert w.mean() == pytest.approx(0, abs=1e-9) and w.std(ddof=1) == pytest.approx(1)


def test_binning_matches_right_closed_intervals(spark):
    df = spark.createDataFrame([(v,) for v in [0.0, 1.0, 2.0, 2.5, 4.0, None, float("nan")]], "x double")
    assert _column(Recipe().add_binning("x", 4).transform(df), "x_binned") == [0, 0, 1, 2, 3, None, None]
    assert _column(Recipe().add_binning("x", 2, labels=["a", "b"]).transform(df), "x_binned") == ["a", "a", "a", "b", "b", None, None]
    constant = spark.createDataFrame([(5.0,), (5.0,)], "x double")
    assert _column(Recipe().add_binning("x", 2).transform(constant), "x_binned") == [0, 0]
    wide = spark.range(101).selectExpr("double(id) AS x")
    assert _column(Recipe().add_binning("x", 50).transform(wide), "x_binned") == [max(math.ceil(i / 2) - 1, 0) for i in range(101)]
    nothing = spark.createDataFrame([(None,)], "x double")
    assert _column(Recipe().add_binning("x", 2).transform(nothing), "x_binned") == [None]


def test_batch_functions(spark, counting):
    def double(batches):
        for b in batches:
            yield b[["id"]].assign(twice=b["feature_3"] * 2)

    assert Recipe().add_batches(double, "id long, twice double").transform(counting).agg({"twice": "max"}).first()[0] == 594.0


def test_fill_interaction(spark):
    df = spark.createDataFrame([(2.0, 3.0, None), (2.0, 3.0, 9.0)], "feature_1 double, feature_2 double, feature_interaction double")
    assert _column(fill_interaction(df), "feature_interaction") == [6.0, 9.0]
    assert _column(fill_interaction(df.drop("feature_interaction")), "feature_interaction") == [6.0, 6.0]


def test_column_and_record_stats(spark, counting):
    got = {r.feature: r for r in column_stats(counting).collect()}
    first = got["feature_1_norm"]
    assert (first["mean"], first["min"], first["max"], first["count"], first["null_count"]) == (49.5, 0.0, 99.0, 100, 0)
    df = spark.createDataFrame([(1.0, None), (3.0, None), (float("nan"), None)], "a double, b double")
    rows = record_stats(df).collect()
    assert [(r.feature, r.mean, r["count"], r.std) for r in rows] == [("a", 2.0, 2, 1.0)]
    maps = spark.createDataFrame([({"a": 1.0},), ({"a": 3.0, "b": None},), ({},)], "r map<string,double>")
    assert [(r.feature, r.mean, r["count"]) for r in record_stats_map(maps, "r").collect()] == [("a", 2.0, 2)]


def test_null_profile_counts_nan(spark):
    df = spark.createDataFrame([(1.0, "a"), (float("nan"), None), (None, "b")], "x double, s string")
    assert {r.column: (r.null_count, r.num_rows) for r in null_profile(df).collect()} == {"x": (2, 3), "s": (1, 3)}


def test_regression_metrics(spark):
    df = spark.createDataFrame([(1.0, 1.0), (2.0, 4.0), (3.0, 3.0), (None, 5.0)], "y double, p double")
    r = regression_metrics(df, "y", "p").first()
    assert (r.mse, r.mae) == pytest.approx((4 / 3, 2 / 3)) and r.r2 == pytest.approx(-1.0)
    assert regression_metrics(df.filter("y = 1"), "y", "p").first().r2 is None


def test_epoch_loss_is_mean_of_batch_means(spark):
    df = spark.createDataFrame([(1, 1, 1.0), (1, 1, 1.0), (1, 2, 4.0)], "e int, b int, l double")
    r = epoch_loss(df, "e", "b", "l").first()
    assert (r.loss, r.row_loss, r.num_batches) == (2.5, 2.0, 2)
    assert {r.b: r.n for r in target_distribution(df, "b").collect()} == {1: 2, 2: 1}
