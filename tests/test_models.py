import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from feldspark.operators import mlp, models as J, tuning as K
from feldspark.sources.synthetic import coefficients, regression_rows

X = ["feature_1", "feature_2", "feature_3", "feature_4"]


@pytest.fixture(scope="module")
def rows(spark):
    return regression_rows(spark.range(1500)).withColumn(
        "y", sum((F.col(x) * w for x, w in zip(X, coefficients(42, 4))), F.lit(3.0))
    ).cache()


def test_linear_and_ridge(rows):
    exact = J.linear_regression(rows, X, "y")
    assert np.allclose(exact.weights, coefficients(42, 4)) and exact.intercept == pytest.approx(3.0)
    data = np.array(rows.select(*X, "y").collect())
    x, y = data[:, :4] - data[:, :4].mean(axis=0), data[:, 4] - data[:, 4].mean()
    want = np.linalg.solve(x.T @ x + 50 * np.eye(4), x.T @ y)
    assert np.allclose(J.fit_model("ridge", rows, X, "y", alpha=50.0).weights, want)
    with pytest.raises(ValueError, match="Unknown model"):
        J.fit_model("svr", rows, X, "y")
    with pytest.raises(ValueError, match="no complete rows"):
        J.ridge_regression(rows.limit(0), X, "y")


def test_incomplete_rows_are_left_out(spark):
    df = spark.createDataFrame([(float(i), 2.0 * i + 1) for i in range(9)] + [(float("nan"), 1.0), (None, 5.0), (1.0, None)], "x double, y double")
    m = J.ridge_regression(df, ["x"], "y", 0.0)
    assert m.weights == pytest.approx([2.0]) and m.intercept == pytest.approx(1.0)


def test_dependent_features(spark):
    df = spark.range(20).selectExpr("double(id) AS a", "double(5) AS b", "double(3 * id + 1) AS y")
    assert J.ridge_regression(df, ["a", "b"], "y", 0.0).weights == pytest.approx([3.0, 0.0])


def test_forest(rows):
    fitted = J.random_forest(rows, X, "y", trees=5)
    assert J.forest_predictions(fitted, rows, X, "y").count() == 1500


def test_forest_of_sums_splits_as_sparks_own(rows):
    """Without draws the trees are the same, node by node; the table is rounded, so that both bin at all values."""
    few = rows.select(*[F.round(F.col(x), 0).alias(x) for x in X], "y")
    options = {"trees": 2, "depth": 4, "every_feature": True, "all_rows": True}
    spark_s, ours = (J.random_forest(few, X, "y", bagged_bytes=b, **options) for b in (1 << 40, 0))
    assert str(ours.forest.uid).startswith("rfr_") and ours.forest.getNumTrees == 2
    one = [r.prediction for r in J.forest_predictions(spark_s, few, X, "y").orderBy(*X, "y").collect()]
    assert [r.prediction for r in J.forest_predictions(ours, few, X, "y").orderBy(*X, "y").collect()] == pytest.approx(one, rel=1e-9)
    tree = lambda m: [line for line in m.forest.trees[0].toDebugString.splitlines() if "feature" in line]
    assert tree(ours) == tree(spark_s) and len(tree(ours)) > 10


def test_forest_of_sums_draws_rows_and_is_kept(rows, spark, tmp_path):
    ours, again, spark_s = (J.random_forest(rows, X, "y", trees=40, bagged_bytes=b) for b in (0, 0, 1 << 40))
    error = lambda m: J.forest_predictions(m, rows, X, "y").agg(F.avg((F.col("prediction") - F.col("y")) ** 2)).first()[0]
    assert error(ours) == error(again) and error(ours) == pytest.approx(error(spark_s), rel=0.15)
    trees = [t.toDebugString.split("\n", 1)[1] for t in ours.forest.trees]
    assert len(trees) == 40 and len(set(trees)) == 40
    registry = J.ModelRegistry(spark, str(tmp_path / "models"))
    registry.save("forest", "1", ours)
    assert error(registry.load("forest", "1")) == pytest.approx(error(ours))


def test_poisson_draws():
    from feldspark.operators.forest import _draws

    got = _draws()(np.random.default_rng(1), (1000, 1000))
    for k in range(6):
        p = np.exp(-1) / math.factorial(k)
        assert (got == k).mean() == pytest.approx(p, abs=5 * np.sqrt(p / 1e6))
    assert got.mean() == pytest.approx(1, abs=0.005) and got.var() == pytest.approx(1, abs=0.01)


def test_gradient_matches_differences():
    sizes = [3, 5, 2, 1]
    rng = np.random.default_rng(0)
    x, y = rng.normal(size=(7, 3)), rng.normal(size=7)
    flat = mlp.initial_weights(sizes, 1) * 3
    for activation in ("tanh", "relu"):
        grad, _ = mlp._gradient(flat, sizes, x, y, activation)
        for i in range(0, len(flat), 3):
            step = np.zeros_like(flat)
            step[i] = 1e-6
            change = (mlp._gradient(flat + step, sizes, x, y, activation)[1] - mlp._gradient(flat - step, sizes, x, y, activation)[1]) / 2e-6
            assert grad[i] == pytest.approx(change, abs=1e-5)


def test_network_learns_and_repeats(rows, spark, tmp_path):
    options = {"hidden": (16,), "epochs": 6, "batch_size": 32, "learning_rate": 1e-2, "block_rows": 1000}
    model = mlp.train_mlp(rows, X, "y", **options)
    losses = [h["val_loss"] for h in model.history]
    assert losses[-1] < 0.1 and losses[-1] < losses[0] and len(mlp.history_frame(model, rows).collect()) == 6
    again = mlp.train_mlp(rows.repartition(7), X, "y", **options)
    assert np.allclose(model.weights, again.weights, atol=1e-4)
    registry = J.ModelRegistry(spark, str(tmp_path / "models"))
    registry.save("net", "1", model, metrics={"val_loss": losses[-1]}, tags={"a": "b"})
    loaded = registry.load("net", "1")
    assert loaded == model
    one = [r.p for r in model.transform(rows, "p").orderBy("id").limit(5).collect()]
    assert one == pytest.approx([r.p for r in loaded.transform(rows, "p").orderBy("id").limit(5).collect()])
    hole = rows.limit(1).withColumn("feature_1", F.lit(None).cast("double"))
    assert model.transform(hole).first()["prediction"] is None
    with pytest.raises(LookupError):
        registry.load("net", "2")


def test_blocks_do_not_depend_on_partitions(rows):
    options = {"hidden": (4,), "epochs": 2, "batch_size": 16, "block_rows": 100}
    a, b = (mlp.train_mlp(rows.repartition(n), X, "y", **options) for n in (1, 5))
    assert np.allclose(a.weights, b.weights, atol=1e-6)


def test_training_goes_on_where_it_stopped(rows, spark, tmp_path):
    registry = J.ModelRegistry(spark, str(tmp_path / "models"))
    options = {"hidden": (8,), "batch_size": 64, "learning_rate": 1e-2, "block_rows": 300, "plateau": {"patience": 2}, "patience": 9}
    whole = mlp.train_mlp(rows, X, "y", epochs=7, **options)
    mlp.train_mlp(rows, X, "y", epochs=4, on_epoch=mlp.checkpointer(registry, "net", every=2), **options)
    resumed = mlp.train_mlp(rows, X, "y", epochs=7, resume=registry.load("net", "epoch-00004"), **options)
    assert resumed.weights == whole.weights and resumed.history == whole.history and resumed.optimizer == whole.optimizer
    assert mlp.train_mlp(rows, X, "y", epochs=7, resume=whole, **options).weights == whole.weights  # nothing left to do
    with pytest.raises(ValueError, match="resume"):
        mlp.train_mlp(rows, X, "y", epochs=7, resume=whole, **{**options, "hidden": (9,)})


def test_arrays_are_added_in_a_tree(spark):
    state = lambda i: (i, [float(i), 1.0], i, 1, 0.5, 2, 0.25)
    df = spark.createDataFrame([state(i) for i in range(200)], mlp.SUMS)
    for tasks in (1, 200, 10_000):
        row = mlp.added_up(df, tasks)
        assert row["state"].tolist() == [19900.0, 200.0] and (row["steps"], row["rows"], row["held"]) == (199, 200, 400)


def test_equal_rows_share_no_block(spark):
    df = spark.range(1000).selectExpr("CASE WHEN id % 2 = 0 THEN 1.0D ELSE double(id) END AS a", "1.0D AS b")
    ready = mlp.prepare_training(df, ["a"], "b", validation_split=0.0, block_rows=100)
    sizes = [len(r.fitted) // 16 for r in spark.read.parquet(ready.path).collect()]
    assert sum(sizes) == 1000 and len(sizes) == 10 and max(sizes) < 150


@pytest.mark.parametrize("batch_size", [16, 130, 1 << 40])
def test_large_blocks_are_trained_in_pieces(rows, spark, batch_size):
    """Named blocks of any size lie in pieces of ``block_rows``, and train as if they were whole."""
    named = rows.withColumn("block", F.when(F.col("id") < 1000, 7).otherwise(F.col("id") % 3)).withColumn("held", F.col("id") % 5 == 0)
    found = []
    for block_rows in (64, 1500):
        ready = mlp.prepare_training(named, X, "y", block_rows=block_rows, block="block", held="held")
        sizes = {}
        for r in spark.read.parquet(ready.path).collect():
            sizes.setdefault(r.block, []).append((len(r.fitted) + len(r.held)) // 40)
            assert sizes[r.block][-1] <= block_rows
        assert {b: sum(n) for b, n in sizes.items()} == {7: 1000, 0: 166, 1: 167, 2: 167}
        options = {"hidden": (5,), "epochs": 3, "batch_size": batch_size, "learning_rate": 1e-2, "weight_decay": 1e-3, "double": True}
        found.append(mlp.train_mlp(named, X, "y", prepared=ready, **options))
    a, b = found
    assert np.allclose(a.weights, b.weights, rtol=1e-9, atol=1e-12) and a.optimizer["steps"] == b.optimizer["steps"]
    for x, y in zip(a.history, b.history, strict=True):
        assert x == pytest.approx(y, rel=1e-9)


def test_sampled_trials_report_stop_and_fail(spark):
    space = K.search_space(spark.range(6).withColumnRenamed("id", "trial"))

    def start(config):
        if config["trial"] == 2:
            raise RuntimeError("no room")
        return config["trial"]

    def epoch(state, rate):
        return state, 1.0 + state, (None if state == 5 else 2.0 - state if state == 1 else 1.0 + state)

    got = K.tune_sampled(space, start, epoch, epochs=9, patience=3, plateau=2).orderBy("trial", "epoch").collect()
    by = {}
    for r in got:
        by.setdefault(r.trial, []).append(r)
    assert [len(by[t]) for t in range(6)] == [4, 4, 1, 4, 4, 4] and by[2][0].error.startswith("RuntimeError")
    assert by[0][3].rate == pytest.approx(by[0][0].rate / 2) and by[0][2].rate == by[0][0].rate
    assert K.best_trial(K.last_epochs(space.sparkSession.createDataFrame([r for r in got])), "val_loss").first().trial in (0, 1)


def test_network_stops_and_is_kept(rows, spark, tmp_path):
    registry = J.ModelRegistry(spark, str(tmp_path / "models"))
    options = {"hidden": (4,), "learning_rate": 1e-9, "epochs": 9, "patience": 2, "plateau": {"patience": 1}}
    keep = mlp.checkpointer(registry, "net", every=1, keep=2)
    model = mlp.train_mlp(rows, X, "y", on_epoch=keep, **options)
    assert len(model.history) == 3
    assert sorted(r.version for r in registry.entries().collect()) == ["epoch-00002", "epoch-00003"]
    with pytest.raises(ValueError):
        registry.save("net", "epoch-00003", model)


def test_forest_is_saved_and_held_out_by_value(rows, spark, tmp_path):
    registry = J.ModelRegistry(spark, str(tmp_path / "models"))
    forest = J.random_forest(rows, X, "y", trees=3, depth=3)
    registry.save("forest", "1", forest)
    loaded = registry.load("forest", "1")
    pairs = [[r.prediction for r in m.transform(rows).orderBy("id").collect()] for m in (forest, loaded)]
    assert pairs[0] == pairs[1]
    hole = rows.limit(1).withColumn("feature_1", F.lit(None).cast("double"))
    assert loaded.transform(hole).first()["prediction"] is None
    a, b = (K.forest_trials(rows.repartition(n), X, "y", [1], [1]).first().val_loss for n in (2, 7))
    assert a == pytest.approx(b)


def test_tuning_flow(rows, spark):
    trials = spark.range(2).withColumnRenamed("id", "trial")
    history, best = K.tune_mlp(rows, X, "y", trials, epochs=2)
    assert history.count() == 4
    last = {r.trial: r.val_loss for r in history.where("epoch = 2").collect()}
    assert best.first().trial == min(last, key=lambda t: (last[t], t))


def test_network_without_validation(rows):
    model = mlp.train_mlp(rows, X, "y", hidden=(4,), epochs=1, validation_split=0.0)
    assert model.history[0]["val_loss"] is None


def test_search_space(spark):
    df = K.search_space(spark.range(500).withColumnRenamed("id", "trial"))
    rows = df.collect()
    assert all(1e-4 <= r.learning_rate <= 1e-2 and 0.1 <= r.dropout_rate <= 0.5 for r in rows)
    assert {r.batch_size for r in rows} == set(K.BATCH_SIZES) and {r.num_layers for r in rows} == set(K.LAYERS)
    assert rows == sorted(df.repartition(5).collect(), key=lambda r: r.trial)


def test_trials(rows, spark):
    trials = K.ridge_trials(rows, X, "y", [0.0, 1e4])
    got = trials.orderBy("trial").collect()
    assert got[0].val_loss == pytest.approx(0.0, abs=1e-9) and got[1].val_loss > 1
    assert K.best_trial(trials, "val_loss").first().trial == 0 and K.best_trial(trials, "val_loss", "max").first().trial == 1
    assert K.forest_trials(rows, X, "y", [2], [2, 3]).count() == 2
    nets = K.mlp_trials(rows, X, "y", [{"hidden": (4,)}, {"hidden": (8,)}], epochs=2)
    assert nets.count() == 4
    ties = spark.createDataFrame([(2, 1.0), (1, 1.0), (3, float("nan")), (4, None)], "trial int, m double")
    assert K.best_trial(ties, "m").first().trial == 1 and K.best_trial(ties, "m", "max").first().trial == 1
    assert K.best_trial(ties.filter("trial > 2"), "m").collect() == []
    with pytest.raises(ValueError):
        K.best_trial(ties, "m", "other")


def test_train_and_score_flows(rows, spark, tmp_path):
    from feldspark.operators.store import FeatureStore
    from feldspark.plans.flows import score_records, train_from_store

    store = FeatureStore(spark, str(tmp_path / "store"))
    registry = J.ModelRegistry(spark, str(tmp_path / "models"))
    store.write(rows.drop("target").withColumn("label", F.lit("a")), "d", "v1")
    model, found = train_from_store(store, "d", registry, "m", target="y", key="id")
    assert model.features == X and {r.split for r in found.collect()} == {"train", "validation"}
    assert all(r.mse < 1e-12 for r in found.collect())
    assert registry.entries().first().metrics["validation_r2"] == pytest.approx(1.0)
    with pytest.raises(ValueError, match="Unknown model type"):
        train_from_store(store, "d", registry, "m", target="y", key="id", kind="other")
    net, _ = train_from_store(store, "d", registry, "net", target="y", key="id", kind="mlp", hidden=(4,), epochs=1)
    assert registry.load("net", "1") == net
    log = score_records(rows, {}, registry.load("m", "1"), key="id", version="1", batch="b")
    assert log.count() == 1500 and log.first()["features"]["feature_1"] is not None
