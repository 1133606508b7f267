import datetime as dt
import functools
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from feldspark.operators import monitoring as M
from feldspark.operators import ordering
from feldspark.operators import runs as R
from feldspark.streaming import metrics as N

START = dt.datetime(2024, 1, 1)


def _metrics(spark, values, contexts=None, names=None, seconds=None):
    rows = [
        (i, (names or ["loss"])[i % len(names or [1])], float(v), START + dt.timedelta(seconds=(seconds or range(len(values)))[i]),
         (contexts or ["c"] * len(values))[i])
        for i, v in enumerate(values)
    ]
    return spark.createDataFrame(rows, "seq long, name string, value double, ts timestamp_ntz, context string")


def _spikes(values, contexts, seconds):
    found, history = set(), {}
    for i in sorted(range(len(values)), key=lambda i: (seconds[i], i)):
        past = history.setdefault(contexts[i], [])
        if past:
            mean = np.mean(past[-9:])
            if mean > 0 and values[i] > 5 * mean:
                found.add(i)
        past.append(values[i])
    return found


@pytest.mark.parametrize("chunk_rows", [10, 33, 10_000])
def test_spikes_in_hot_contexts(spark, chunk_rows):
    rng = random.Random(1)
    values = [rng.expovariate(1) for _ in range(500)]
    contexts = [rng.choice(["hot", "hot", "hot", "a", "b"]) for _ in values]
    seconds = [rng.choice([5, rng.randint(0, 60)]) for _ in values]
    df = _metrics(spark, values, contexts, seconds=seconds)
    got = {r.seq for r in M.loss_spikes(df, chunk_rows=chunk_rows).collect()}
    assert got == _spikes(values, contexts, seconds) and got


def test_spikes_of_text_order_need_few_tasks(spark, monkeypatch):
    """Steps of text alike in their first bytes, in chunks of twelve rows: no task a chunk."""
    made, write = [], ordering.materialize
    monkeypatch.setattr(ordering, "materialize", lambda df, label: made.append(df.rdd.getNumPartitions()) or write(df, label))
    rng = random.Random(8)
    values = [rng.expovariate(1) for _ in range(600)]
    contexts = [rng.choice(["hot", "hot", "a"]) for _ in values]
    seconds = [rng.randint(10, 60) for _ in values]
    df = _metrics(spark, values, contexts, seconds=seconds)
    df = df.withColumn("ts", F.concat(F.lit("runs/checkpoint-"), F.date_format("ts", "HH:mm:ss")))
    got = {r.seq for r in M.loss_spikes(df, chunk_rows=12).collect()}
    assert got == _spikes(values, contexts, seconds) and got
    assert made == [int(spark.conf.get("spark.sql.shuffle.partitions"))]


def _ks(a, b):
    points = sorted(set(a) | set(b))
    return max(abs(np.mean([x <= p for x in a]) - np.mean([x <= p for x in b])) for p in points)


@pytest.mark.parametrize("chunks", [1, 7, 60])
def test_drift_statistic(spark, chunks):
    rng = random.Random(2)
    a = [rng.choice([0.0, -0.0, rng.gauss(0, 1)]) for _ in range(300)]
    b = [rng.choice([0.0, rng.gauss(0.4, 1)]) for _ in range(200)]
    ref = spark.createDataFrame([(x, 1.0, None) for x in a], "x double, c double, n double")
    cur = spark.createDataFrame([(x, 1.0, None) for x in b] + [(float("nan"), 1.0, None)], "x double, c double, n double")
    rows = {r.feature: r for r in M.ks_drift(ref, cur, ["x", "c", "n"], min_chunks=chunks).collect()}
    assert rows["x"].ks_statistic == pytest.approx(_ks(a, b))
    assert rows["c"].ks_statistic == 0.0 and rows["c"].ks_pvalue == 1.0 and not rows["c"].drift_detected
    assert rows["n"].ks_statistic is None and rows["n"].ks_pvalue is None and rows["n"].drift_detected is None


def test_drift_pvalue_at_the_critical_value(spark):
    from feldspark.functions.expressions import kolmogorov_pvalue

    df = spark.createDataFrame([(1.3581 / 50**0.5, 100, 100), (1e-9, 100, 100), (1.0, 100, 100)], "d double, n long, m long")
    got = [r[0] for r in df.select(kolmogorov_pvalue(F.col("d"), F.col("n"), F.col("m"))).collect()]
    assert got[0] == pytest.approx(0.05, abs=1e-4) and got[1] == 1.0 and got[2] < 1e-9
    same = spark.range(500).selectExpr("double(id) AS x")
    moved = spark.range(500).selectExpr("double(id + 200) AS x")
    assert M.ks_drift(same, moved, ["x"]).first().drift_detected
    assert M.drift_alerts(M.ks_drift(same, moved, ["x"])).first().tags == {"feature": "x"}
    none = M.ks_drift(same.limit(0), moved, ["x"])
    assert [tuple(r) for r in none.collect()] == [("x", None, None, None)] and M.drift_alerts(none).count() == 0


def test_decay(spark):
    cur = spark.createDataFrame([("a", 1.2), ("b", 1.0), ("z", 1.0), ("only", 1.0)], "name string, value double")
    ref = spark.createDataFrame([("a", 1.0), ("b", 1.05), ("z", 0.0)], "name string, value double")
    rows = {r.name: r for r in M.metric_decay(cur, ref).collect()}
    assert set(rows) == {"a", "b"} and rows["a"].decayed and not rows["b"].decayed
    assert M.decay_alerts(M.metric_decay(cur, ref), "7").first().message == "Model 7 performance decay in a: 20.0% decay"


def test_thresholds_and_summary(spark):
    names = ["system.cpu.percent", "system.memory.percent", "serving.prediction.latency", "training.loss"]
    df = _metrics(spark, [81, 90, 1.5, 1e9, 80, 95, float("nan"), 1], names=names)
    alerts = {(r.seq, r.message) for r in M.threshold_alerts(df).collect()}
    assert alerts == {(0, "High CPU usage: 81.0%"), (5, "High memory usage: 95.0%"), (2, "High prediction latency: 1.500s")}
    assert {r.seq for r in M.threshold_alerts(df, recent=3).collect()} == {5}
    assert {r.name: (r.avg, r.max) for r in M.metric_summary(df).collect()} == {names[0]: (80.5, 81.0), names[1]: (92.5, 95.0)}
    raised = M.all_alerts(M.limit_alerts(M.exceeding(df)))
    counts = M.monitor_counts(df, raised).first()
    assert (counts.total_metrics, counts.recent_metrics_count, counts.active_alerts) == (8, 8, 3)
    assert M.recent_alerts(raised, 2).count() == 2
    assert [r.seq for r in M.recent_metrics(df, 2).collect()] == [7, 6]
    assert M.recent_metrics(df, 50, buffer=4).count() == 4


def _early(losses, patience, delta=1e-4):
    best, wait = float("inf"), 0
    for i, loss in enumerate(losses):
        if loss < best - delta:
            best, wait = loss, 0
        else:
            wait += 1
            if wait >= patience:
                return best, i
    return best, None


def _rates(losses, patience, lr=1e-3):
    best, wait, out = float("inf"), 0, []
    for loss in losses:
        if loss < best - 1e-4:
            best, wait = loss, 0
        else:
            wait += 1
            if wait >= patience:
                lr, wait = max(lr * 0.5, 1e-6), 0
        out.append(lr)
    return out


RUNS = {
    "plateau": [1.0] * 12,
    "improving": [1.0 - 0.01 * i for i in range(40)],
    "late": [1.0 - 0.01 * i for i in range(25)] + [0.9] * 10,
    "tiny": [1.0 - 1e-6 * i for i in range(30)],
    "short": [1.0],
    "random": [random.Random(4).random() for _ in range(60)],
    "nan": [1.0, float("nan"), 0.5, float("nan"), float("nan"), float("nan"), 0.4],
}


@pytest.mark.parametrize("block_rows", [4, 100_000])
def test_folds_match_a_loop(spark, block_rows):
    rows = [(run, i, loss) for run, losses in RUNS.items() for i, loss in enumerate(losses)]
    df = spark.createDataFrame(rows, "run string, epoch int, loss double").repartition(3)
    got = {r.run: (r.best_loss, r.stopped_epoch) for r in R.early_stop(df, "run", "epoch", "loss", 3, block_rows=block_rows).collect()}
    assert got == {run: _early(losses, 3) for run, losses in RUNS.items()}
    rates = {(r.run, r.epoch): r.lr for r in R.lr_schedule(df, "run", "epoch", "loss", patience=2, block_rows=block_rows).collect()}
    assert rates == {(run, i): x for run, losses in RUNS.items() for i, x in enumerate(_rates(losses, 2))}


def test_small_blocks_are_summed_up_in_streams(spark):
    """No call of Python a block or run: a task streams them, whatever the batches that cut them."""
    rows = [(run, i, loss) for run, losses in RUNS.items() for i, loss in enumerate(losses)]
    df = spark.createDataFrame(rows, "run string, epoch int, loss double").repartition(3)
    size = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(size)
    spark.conf.set(size, "5")
    try:
        stops = R.early_stop(df, "run", "epoch", "loss", 3, block_rows=7)
        plan = stops._jdf.queryExecution().executedPlan().toString()
        assert "MapInPandas" in plan and "FlatMapGroupsInPandas" not in plan
        assert {r.run: (r.best_loss, r.stopped_epoch) for r in stops.collect()} == {run: _early(losses, 3) for run, losses in RUNS.items()}
        rates = {(r.run, r.epoch): r.lr for r in R.lr_schedule(df, "run", "epoch", "loss", patience=2, block_rows=7).collect()}
        assert rates == {(run, i): x for run, losses in RUNS.items() for i, x in enumerate(_rates(losses, 2))}
    finally:
        spark.conf.set(size, before)
    zeros = spark.createDataFrame([(-0.0 if i % 2 else 0.0, i, float(-i)) for i in range(9)], "run double, epoch int, loss double")
    assert [(r.best_loss, r.stopped_epoch) for r in R.early_stop(zeros, "run", "epoch", "loss", 3, block_rows=4).collect()] == [(-8.0, None)]


@pytest.mark.parametrize("kind", ["string", "bigint", "double", "struct<a: bigint, b: string>", "array<bigint>"])
def test_blocks_are_summed_up_where_they_lie(spark, kind):
    """Only summaries are shuffled; files may cut blocks anywhere, in any order, and put runs side by side that fit together."""
    ids = {
        "string": list(RUNS), "bigint": [2**60 + i for i in range(len(RUNS))], "double": [float(i) - 0.5 for i in range(len(RUNS))],
        "struct<a: bigint, b: string>": [(i, None) for i in range(len(RUNS))], "array<bigint>": [[i] for i in range(len(RUNS))],
    }[kind]
    rows = [(i, n + 1, n // 4, loss) for i, losses in zip(ids, RUNS.values()) for n, loss in enumerate(losses)]
    schema = f"run {kind}, position bigint, _block bigint, loss double"
    size = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(size)
    spark.conf.set(size, "5")
    try:
        for order in (rows, sorted(rows, key=lambda r: (r[1], str(r[0]))), random.Random(1).sample(rows, len(rows))):
            found = R.plateaus(spark.createDataFrame(order, schema), "run", "loss", 2, 1e-4, 3)
            plan = found._jdf.queryExecution().executedPlan().toString()
            assert plan.count("Exchange") == 1, plan
            got = {str(r.run): (r.best, [d.position for d in r.drops]) for r in found.collect()}
            assert len(got) == len(RUNS)
            for run, losses in zip(spark.createDataFrame([(i,) for i in ids], f"run {kind}").collect(), RUNS.values()):
                rates = _rates(losses, 2)
                want = [n + 1 for n, (a, b) in enumerate(zip([1e-3, *rates], rates)) if a != b][:3]
                assert got[str(run.run)][1] == want
    finally:
        spark.conf.set(size, before)


def test_runs_dealt_to_ranges_are_summed_up_in_order(spark, monkeypatch):
    """Positions found by ranges lie in order too, so a block is few summaries."""
    monkeypatch.setattr(R, "rank_within", functools.partial(R.rank_within, chunk_rows=30))
    rows = [(run, i, loss) for run, losses in RUNS.items() for i, loss in enumerate(losses)]
    rows += [(None, 0, 1.0), ("twice", 1, 2.0), ("twice", 1, 2.0), ("twice", 1, None)]
    df = spark.createDataFrame(rows, "run string, epoch int, loss double").repartition(5)
    slim = R._slim(df, "run", "epoch", "loss")
    placed = R._placed(slim, "run", "epoch", "loss", 10, (60, slim.count()))
    parts = placed.withColumn("file", F.input_file_name()).withColumn("row", F.monotonically_increasing_id()).orderBy("row").collect()
    ends = sum((a.file, a.run, a.position + 1) != (b.file, b.run, b.position) for a, b in zip(parts, parts[1:]))
    assert ends < len(RUNS) + 1 + 16
    rates = {(r.run, r.epoch): r.lr for r in R.lr_schedule(df.where("run <> 'twice'"), "run", "epoch", "loss", patience=2, block_rows=7).collect()}
    assert rates == {(run, i): x for run, losses in RUNS.items() for i, x in enumerate(_rates(losses, 2))}


def test_many_rates_are_looked_up_as_few(spark):
    df = spark.createDataFrame([("flat", i, 1.0) for i in range(90)], "run string, epoch int, loss double")
    for factor in (0.5, 0.9):  # 11 rates, 67 rates
        one, blocks = (
            {r.epoch: r.lr for r in R.lr_schedule(df, "run", "epoch", "loss", factor=factor, patience=1, block_rows=n).collect()} for n in (1000, 7)
        )
        assert one == pytest.approx(blocks, rel=1e-12) and len(one) == 90 and min(one.values()) == 1e-6


def test_compare_runs(spark):
    rows = [("b", "val_loss", 0.5), ("a", "val_loss", 0.5), ("c", "acc", 1.0), ("d", "val_loss", float("nan"))]
    df = spark.createDataFrame(rows, "run string, metric string, value double")
    got = {r.run: r.is_best for r in R.compare_runs(df, "run", "metric", "value", ["val_loss", "acc"]).collect()}
    assert got == {"a": True, "b": False, "c": False, "d": False}
    none = R.compare_runs(df.filter("run = 'c'"), "run", "metric", "value", ["val_loss", "acc"]).collect()
    assert [r.is_best for r in none] == [False]


def test_flatten(spark):
    texts = [
        r'{"a": {"b": {"c": 1, "d": [1, {"z": 2}]}}, "e": "x", "n": null}', r'{"e": "{", "f": {}}', "{}", None, "oops", "[1]",
        r'{"s": "{\"q\": 1}", "t": "}}", "u": {"v": {"w": {"x": "\\"}}}}',
    ]
    df = spark.createDataFrame(list(enumerate(texts)), "id int, j string")
    got = {(r.id, r.key, r.value) for r in R.flatten_json(df, "j", ["id"]).collect()}
    assert got == {
        (0, "a.b.c", "1"), (0, "a.b.d", '[1,{"z":2}]'), (0, "e", "x"), (0, "n", None), (1, "e", "{"), (4, None, "oops"), (5, None, "[1]"),
        (6, "s", '{"q": 1}'), (6, "t", "}}"), (6, "u.v.w.x", "\\"),
    }


def test_checkpoints_and_series(spark):
    df = spark.createDataFrame([("a", i, x) for i, x in enumerate([3.0, 1.0, 2.0, 1.0, float("nan")])], "run string, epoch int, val_loss double")
    assert [(r.epoch, r.rank) for r in R.best_checkpoints(df, "run", "epoch", "val_loss").orderBy("rank").collect()] == [(1, 1), (3, 2), (2, 3)]
    rows = R.run_series(spark, [{"x": 1}, {"x": 0}], lambda c: 1 // c["x"]).collect()
    assert [(r.status, r.result) for r in rows] == [("success", "1"), ("error", None)] and "ZeroDivision" in rows[1].error


def _stream(spark, folder, df, parts):
    """The metrics as ``parts`` files in time order, one file per micro-batch."""
    for i in range(parts):
        df.filter((F.col("seq") * parts / 120).cast("int") == i).coalesce(1).write.parquet(f"{folder}/p{i}")
    return spark.readStream.schema(df.schema).option("maxFilesPerTrigger", 1).parquet(f"{folder}/p*")


@pytest.mark.parametrize("compact", [1, 2, 20])
def test_stream_spikes_over_several_batches(spark, tmp_path, compact):
    rng = random.Random(6)
    values = [rng.expovariate(1) for _ in range(120)]
    contexts = ["rare" if i % 37 == 0 else None if i % 3 == 0 else rng.choice("aab") for i in range(120)]
    df = _metrics(spark, values, contexts)
    got = {r.seq for r in N.run_spikes(_stream(spark, tmp_path, df, 5), compact=compact).collect()}
    assert got == _spikes(values, contexts, range(120)) and got


def test_replayed_batch_writes_the_same(spark, tmp_path):
    df = _metrics(spark, [1.0, 1.0, 9.0, 1.0, 30.0])
    detector = N.SpikeDetector(str(tmp_path / "d"))
    detector(df.filter("seq < 3"), 0)
    for _ in range(2):
        detector(df.filter("seq >= 3"), 1)
    assert sorted(r.seq for r in detector.results(spark).collect()) == [2, 4]


def test_old_state_is_removed(spark, tmp_path):
    df = _metrics(spark, [1.0] * 6)
    detector = N.SpikeDetector(str(tmp_path / "d"), compact=2)
    for i in range(6):
        detector(df.filter(f"seq = {i}"), i)
    left = sorted(int(p.name.split("=")[1]) for p in (tmp_path / "d" / "state").iterdir())
    assert left == [4, 5]
    assert detector._kept(spark, 6, df.select("seq", "context", "ts", "value").schema).count() == 6


@pytest.mark.parametrize("compact, chunk", [(1, None), (3, None), (3, 20)])
def test_stream_spikes_in_any_order_within_the_delay(spark, compact, chunk, monkeypatch):
    if chunk:  # contexts too large for a task
        monkeypatch.setattr(N, "CHUNK_ROWS", chunk)
    rng = random.Random(9)
    values = [rng.expovariate(1) for _ in range(150)]
    contexts = ["rare" if i % 37 == 0 else None if i % 3 == 0 else rng.choice("aab") for i in range(150)]
    df = _metrics(spark, values, contexts, seconds=[float(i) for i in range(150)])
    arrival = F.col("seq") + F.pmod(F.xxhash64("seq"), F.lit(40))
    arrivals = N.Arrivals(df, "ts", 6, arrival)
    found = N.run_spikes(lambda rows: rows, arrivals=arrivals, compact=compact, delay=40.0)
    assert {r.seq for r in found.collect()} == _spikes(values, contexts, range(150))
    assert found.count() == len(_spikes(values, contexts, range(150)))


def test_late_rows_take_no_part_and_replays_repeat(spark, tmp_path):
    df = _metrics(spark, [1.0, 1.0, 1.0, 90.0, 1.0, 80.0], seconds=[0.0, 1.0, 2.0, 3.0, 50.0, 60.0])
    detector = N.SpikeDetector(str(tmp_path / "d"), delay=10.0)
    detector(df.filter("seq in (0, 1, 4)"), 0)  # the watermark is 40 now, row 4 waits
    fresh = N.SpikeDetector(str(tmp_path / "d"), delay=10.0)  # after a restart
    for _ in range(2):
        fresh(df.filter("seq in (3, 5)"), 1)
    fresh(df.filter("seq = 2"), 2)
    assert sorted(r.seq for r in fresh.results(spark).collect()) == [3]
    assert [r.seq for r in fresh.late(spark).collect()] == [2]
    schema = df.select("seq", "context", "ts", "value").schema
    assert [r.seq for r in fresh.waiting(spark, 2, schema).collect()] == []  # 80 against a mean with 90 in it
    assert sorted(r.seq for r in spark.read.parquet(fresh._buffer(2)).collect()) == [5]


def test_plateaus_of_a_long_steady_run(spark):
    n = 200_000
    df = spark.range(n).selectExpr("'long' AS run", "id AS epoch", "1 - id * 0.0002 AS loss")
    end = spark.createDataFrame([("long", n + i, 5.0) for i in range(30)], "run string, epoch long, loss double")
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("few", "few")
    row = R.early_stop(df.unionByName(end), "run", "epoch", "loss", 10, block_rows=2_000).first()
    assert row.stopped_epoch == n + 9 and row.best_loss == pytest.approx(1 - (n - 1) * 0.0002)
    assert len(tracker.getJobIdsForGroup("few")) < 30  # 100 blocks
    spark.sparkContext.setJobGroup("rest", "rest")
    rates = R.lr_schedule(df.unionByName(end), "run", "epoch", "loss", patience=5, block_rows=2_000)
    assert {(r.epoch, r.lr) for r in rates.filter(f"epoch in (7, {n + 3}, {n + 4}, {n + 29})").collect()} == {
        (7, 1e-3), (n + 3, 1e-3), (n + 4, 5e-4), (n + 29, 1e-3 * 0.5**6)}
    with pytest.raises(ValueError):
        R.lr_schedule(df, "run", "epoch", "loss", factor=1.0)


def test_exact_small_sample_probabilities():
    from itertools import combinations

    for n, m in ((1, 1), (3, 3), (4, 2), (5, 3)):
        gaps = []
        for pick in combinations(range(n + m), n):
            i = j = 0
            top = 0.0
            for k in range(n + m):
                i, j = (i + 1, j) if k in pick else (i, j + 1)
                top = max(top, abs(i / n - j / m))
            gaps.append(top)
        for g in sorted(set(gaps)):
            assert M.ks_exact(g, n, m) == pytest.approx(sum(x > g - 1e-9 for x in gaps) / len(gaps))
    assert M.ks_exact(0.0, 5, 5) == 1.0 and 0 <= M.ks_exact(0.03, 10_000, 9_000) < 1e-3


def test_stream_summary_and_alerts(spark, tmp_path):
    df = _metrics(spark, [float(i) for i in range(120)], names=["system.cpu.percent", "x"], seconds=[i * 60 for i in range(120)])
    stream = _stream(spark, tmp_path, df, 3)
    windows = N.run_updates(N.window_summary(stream), "w", ["window_start", "name"]).collect()
    assert {(r.window_start.hour, r.name, r.avg, r.max, r.n) for r in windows} == {
        (0, "x", 30.0, 59.0, 30), (0, "system.cpu.percent", 29.0, 58.0, 30),
        (1, "x", 90.0, 119.0, 30), (1, "system.cpu.percent", 89.0, 118.0, 30),
    }
    closed = N.run_to_table(N.window_summary(stream), "c").collect()
    assert {r.window_start.hour for r in closed} == {0}
    alerts = N.run_to_table(N.alert_stream(stream), "a")
    assert {r.seq for r in alerts.collect()} == set(range(82, 120, 2))
