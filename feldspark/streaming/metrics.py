"""The metric stream: windowed summaries, threshold alerts and loss spikes."""

from __future__ import annotations

from collections.abc import Callable
from contextlib import contextmanager
from multiprocessing.pool import ThreadPool

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from feldspark.functions.missing import number
from feldspark.operators.monitoring import SPIKE_FACTOR, THRESHOLDS, exceeding, loss_spikes
from feldspark.operators.ordering import CHUNK_ROWS, group_sizes, order_number
from feldspark.session import materialize, remove_path, scratch_path


def read_stream(spark: SparkSession, folder: str, pattern: str, schema, files: int | None = None) -> DataFrame:
    """A file stream over the parquet files of ``folder`` that match ``pattern``, ``files`` a batch if given."""
    reader = spark.readStream.schema(schema).option("pathGlobFilter", pattern)
    return (reader.option("maxFilesPerTrigger", files) if files else reader).parquet(folder)


class Arrivals:
    """A table that arrives in spans, for runs of a stream over what has landed so far.

    Spans follow ``arrival`` (by default ``time``), about equal numbers of rows each. A span is written with Spark's
    own partitions into a folder of its own; iterating lands one span after the other, and a stream that is run over
    ``stream`` after each takes that span as one batch.
    """

    def __init__(self, rows: DataFrame, time: str, parts: int = 4, arrival: Column | None = None):
        self.folder = scratch_path(rows.sparkSession, "arrivals")
        self.columns = rows.columns
        at = F.unix_micros(F.col(time).cast("timestamp")) if arrival is None else arrival
        self.rows, self.spark, self.schema = rows.withColumn("_at", at), rows.sparkSession, rows.schema
        cuts = self.rows.agg(F.percentile_approx("_at", [i / parts for i in range(1, parts)])).first()[0] or []
        self.edges = [None, *sorted(set(cuts)), None]

    def __iter__(self):
        at = F.col("_at")
        for k, (low, high) in enumerate(zip(self.edges, self.edges[1:])):
            inside = F.lit(True) if high is None else at <= high
            # rows without a time come first
            inside = F.coalesce(inside, F.lit(True)) if low is None else inside & (at > low)
            self.rows.filter(inside).select(*self.columns).write.parquet(f"{self.folder}/span={k:05d}")
            yield k

    def stream(self) -> DataFrame:
        return self.spark.readStream.schema(self.schema).parquet(f"{self.folder}/*")


def window_summary(metrics: DataFrame, width: str = "1 hour", delay: str = "10 minutes") -> DataFrame:
    """Average, maximum and count per tumbling window and metric name."""
    value = number(metrics, "value")
    timed = metrics.withColumn("ts", F.col("ts").cast("timestamp")).withWatermark("ts", delay)
    return timed.groupBy(F.window("ts", width).alias("w"), "name").agg(
        F.avg(value).alias("avg"), F.max(value).alias("max"), F.count(value).alias("n")
    ).select(F.col("w.start").alias("window_start"), "name", "avg", "max", "n")


def alert_stream(metrics: DataFrame, thresholds=THRESHOLDS) -> DataFrame:
    """Threshold alerts; a narrow filter, so it needs no state."""
    return exceeding(metrics, thresholds)


class SpikeDetector:
    """Loss spikes per context over micro-batches, in order of event time.

    Rows wait in an event-time buffer until the watermark (the newest time seen less ``delay`` seconds) has passed
    them, so rows may arrive in any order within the delay. Those that are ready are judged by the batch operator
    together with the last ``window - 1`` losses kept of their contexts; a hot context is cut into blocks here too.
    The buffer is a table per batch. Kept losses are written for the contexts of a batch, and every ``compact``
    batches for all; earlier ones are read for the contexts of the batch only. A replayed batch reads the same
    earlier tables and writes the same rows again. Rows that come after later rows of their context have been judged
    take no part; ``late`` returns them. ``results`` holds what the watermark has passed, ``waiting`` judges the rest.
    """

    def __init__(
        self, path: str, context: str = "context", window: int = 10, factor: float = SPIKE_FACTOR, compact: int = 20, delay: float = 0.0
    ):
        self.path, self.context, self.window, self.factor, self.compact = path, context, window, factor, compact
        self.delay = int(delay * 1_000_000)
        self.mark: tuple[int, int | None] | None = None  # (batch, watermark after it)

    def _state(self, batch: int) -> str:
        return f"{self.path}/state/batch={batch}"

    def _buffer(self, batch: int) -> str:
        return f"{self.path}/buffer/batch={batch}"

    def _tail(self, rows: DataFrame) -> DataFrame:
        newest = Window.partitionBy(self.context).orderBy(F.desc("ts"), F.desc("seq"))
        # the limit on the rank is applied before the shuffle, so a hot context shrinks first
        return rows.withColumn("_r", F.row_number().over(newest)).filter(F.col("_r") < self.window).drop("_r")

    def _stored(self, spark: SparkSession, batch_id: int, schema) -> DataFrame:
        """Losses kept before this batch, those of older batches too; a row may stand in several."""
        first = max(batch_id - 1, 0) // self.compact * self.compact
        paths = [self._state(b) for b in range(first, batch_id)]
        return spark.read.schema(schema).parquet(*paths) if paths else spark.createDataFrame([], schema)

    def _kept(self, spark: SparkSession, batch_id: int, schema) -> DataFrame:
        """The newest losses of every context before this batch."""
        return self._tail(self._stored(spark, batch_id, schema).dropDuplicates([self.context, "seq"]))

    def _waiting(self, spark: SparkSession, batch_id: int, schema) -> DataFrame:
        """Rows that were buffered after a batch."""
        if not self.delay or batch_id < 0:
            return spark.createDataFrame([], schema)
        return spark.read.schema(schema).parquet(self._buffer(batch_id))

    def _mark_after(self, spark: SparkSession, batch_id: int) -> int | None:
        """The watermark after a batch: kept here, or read back after a restart."""
        if batch_id < 0 or not self.delay:
            return None
        if self.mark is None or self.mark[0] != batch_id:
            self.mark = (batch_id, spark.read.schema("mark long").parquet(f"{self.path}/mark/batch={batch_id}").first()[0])
        return self.mark[1]

    def _judged(self, ready: DataFrame, batch_id: int, largest: int, total: int, every: bool = False) -> tuple[DataFrame, DataFrame, DataFrame]:
        """(spikes, losses to keep, late rows) of the rows that are ready after those kept before the batch.

        With ``every`` the losses of all contexts are returned to keep, else those of the contexts of the batch.
        """
        spark, schema, names = ready.sparkSession, ready.schema, ready.columns
        key, place = F.col(self.context), F.struct("ts", "seq")
        if largest + self.window * (self.compact + 1) > CHUNK_ROWS:
            return self._judged_hot(ready, self._kept(spark, batch_id, schema), (largest + self.window, total), every)
        stored = self._stored(spark, batch_id, schema)
        rows = ready.withColumn("_new", F.lit(True)).unionByName(stored.withColumn("_new", F.lit(False)))
        # one shuffle by context; older rows than the kept ones do no harm, as only the nearest before a row count
        of_context = Window.partitionBy(self.context)
        rows = rows.withColumns({
            "_seen": F.max("_new").over(of_context), "_last": F.max(F.when(~F.col("_new"), place)).over(of_context),
            "_again": F.lag(place).over(of_context.orderBy("ts", "seq")).eqNullSafe(place) & ~F.col("_new"),
        }).filter(~F.col("_again") & (F.col("_seen") | F.lit(every)))
        rows = rows.withColumn("_late", F.col("_new") & F.coalesce(place < F.col("_last"), F.lit(False)))
        order = Window.partitionBy(self.context, "_late").orderBy("ts", "seq")
        rows = rows.withColumns({
            "previous": F.avg("value").over(order.rowsBetween(1 - self.window, -1)),
            "_newest": F.lead(F.lit(1), self.window - 1).over(order).isNull() if self.window > 1 else F.lit(False),
        })
        both = materialize(rows.select(*names, "_new", "_late", "previous", "_newest"), "batch")
        fine = both.filter("NOT _late")
        spikes = fine.filter(F.col("_new") & (F.col("previous") > 0) & (F.col("value") > F.col("previous") * F.lit(self.factor)))
        return spikes.select(*names, "previous"), fine.filter("_newest").select(*names), both.filter("_late").select(*names)

    def _judged_hot(self, ready: DataFrame, kept: DataFrame, sizes: tuple[int, int], every: bool) -> tuple[DataFrame, DataFrame, DataFrame]:
        """The same where a context may be too large for one task: the batch operator cuts it into blocks."""
        names = ready.columns
        same = F.col(self.context).eqNullSafe(F.col("_seen"))
        seen = ready.select(F.col(self.context).alias("_seen")).distinct()
        mine = kept if every else kept.join(seen, same, "left_semi")
        newest = kept.groupBy(F.col(self.context).alias("_seen")).agg(F.max(F.struct("ts", "seq")).alias("_last"))
        late = F.coalesce(F.struct("ts", "seq") < F.col("_last"), F.lit(False))
        marked = ready.join(newest, same, "left").select(*names, late.alias("_late"), F.lit(True).alias("_new"))
        both = materialize(marked.unionByName(mine.withColumn("_late", F.lit(False)).withColumn("_new", F.lit(False))), "batch")
        fine = both.filter("NOT _late")
        found = loss_spikes(fine.select(*names), self.context, self.window, self.factor, sizes=sizes)
        found = found.join(fine.filter("_new").select("seq"), "seq", "left_semi")
        return found, self._tail(fine.select(*names)), both.filter("_late").select(*names)

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        new = batch.select("seq", self.context, "ts", number(batch, "value").alias("value"))
        rows = new.unionByName(self._waiting(spark, batch_id - 1, new.schema)) if self.delay else new
        at = order_number(rows, "ts")
        # one light job: the watermark and the largest context
        by = rows.groupBy(self.context).agg(F.count(F.lit(1)).alias("n"), F.max(at).alias("at"))
        newest, largest, total = by.agg(F.max("at"), F.max("n"), F.sum("n")).first()
        before = self._mark_after(spark, batch_id - 1)
        mark = max((m for m in (before, None if newest is None else newest - self.delay) if m is not None), default=None)
        passed = F.lit(False) if mark is None else F.coalesce(at <= F.lit(mark), F.lit(True))
        full = batch_id > 0 and batch_id % self.compact == 0
        ready = rows.filter(passed) if self.delay else rows
        spikes, state, late = self._judged(ready, batch_id, largest or 0, total or 0, full)
        writes = [(spikes, f"{self.path}/spikes/batch={batch_id}"), (state, self._state(batch_id))]
        if batch_id:
            writes.append((late, f"{self.path}/late/batch={batch_id}"))
        if self.delay:
            writes.append((rows.filter(~passed), self._buffer(batch_id)))
            writes.append((spark.createDataFrame([(mark,)], "mark long").coalesce(1), f"{self.path}/mark/batch={batch_id}"))
        with ThreadPool(len(writes)) as pool:  # small jobs that do not depend on each other
            pool.map(lambda w: w[0].write.mode("overwrite").parquet(w[1]), writes)
        self.mark = (batch_id, mark)
        if self.delay and batch_id > 1:
            remove_path(spark, self._buffer(batch_id - 2))
        if batch_id % self.compact == 1 % self.compact and batch_id > self.compact:
            # the batch before was a full one, so a replay of this batch needs nothing older
            for old in range(max(batch_id - 1 - self.compact, 0), batch_id - 1):
                remove_path(spark, self._state(old))

    def waiting(self, spark: SparkSession, batch_id: int, schema) -> DataFrame:
        """Spikes among the rows that the watermark had not passed after a batch, judged as if nothing else came."""
        rows = self._waiting(spark, batch_id, schema)
        return self._judged(rows, batch_id + 1, *group_sizes(rows, [self.context]))[0]

    def late(self, spark: SparkSession) -> DataFrame:
        """Rows that came after rows of their context that follow them; needs two batches or more."""
        return spark.read.parquet(f"{self.path}/late").drop("batch")

    def results(self, spark: SparkSession) -> DataFrame:
        return spark.read.parquet(f"{self.path}/spikes").drop("batch")


@contextmanager
def _setting(spark: SparkSession, key: str, value: str):
    """A setting of the session for a while; a stream keeps what holds when it starts."""
    before = spark.conf.get(key)
    spark.conf.set(key, value)
    try:
        yield
    finally:
        spark.conf.set(key, before)


def _drain(writer, checkpoint: str) -> None:
    query = writer.option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    try:
        query.awaitTermination()
    finally:
        query.stop()


def run_to_table(stream: DataFrame | Callable[[DataFrame], DataFrame], label: str, arrivals: Arrivals | None = None) -> DataFrame:
    """Process all that is available, append mode, into a parquet table; return the table.

    In append mode a window is written once the watermark has passed it; the windows
    still open at the end stay in the state for the next run. With ``arrivals`` the stream is a
    function of their stream, run after each span.
    """
    build = (lambda: stream(arrivals.stream())) if arrivals else lambda: stream
    spark = arrivals.spark if arrivals else stream.sparkSession
    path = scratch_path(spark, label)
    for _ in arrivals or (0,):
        out = build()
        _drain(out.writeStream.format("parquet").outputMode("append").option("path", f"{path}/data"), f"{path}/checkpoint")
    return spark.read.schema(out.schema).parquet(f"{path}/data")


def run_updates(
    stream: DataFrame | Callable[[DataFrame], DataFrame], label: str, keys: list[str], arrivals: Arrivals | None = None
) -> DataFrame:
    """Process all that is available in update mode and return the newest row per key.

    Every batch overwrites its own folder, so a replayed batch leaves no second copy.
    """
    build = (lambda: stream(arrivals.stream())) if arrivals else lambda: stream
    spark = arrivals.spark if arrivals else stream.sparkSession
    path = scratch_path(spark, label)

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/data/batch={batch_id}")

    with _setting(spark, "spark.sql.streaming.noDataMicroBatches.enabled", "false"):  # they bring no update
        for _ in arrivals or (0,):
            out = build()
            _drain(out.writeStream.outputMode("update").foreachBatch(write), f"{path}/checkpoint")
    rows = spark.read.parquet(f"{path}/data")
    values = [c for c in out.columns if c not in keys]
    return rows.groupBy(*keys).agg(F.max_by(F.struct(*values), "batch").alias("v")).select(*keys, "v.*")


def run_spikes(
    stream: DataFrame | Callable[[DataFrame], DataFrame], label: str = "spikes", arrivals: Arrivals | None = None, **options
) -> DataFrame:
    """Run the spike detector over all that is available and return its findings, rows still waiting included."""
    build = (lambda: stream(arrivals.stream())) if arrivals else lambda: stream
    spark = arrivals.spark if arrivals else stream.sparkSession
    path = scratch_path(spark, label)
    detector = SpikeDetector(path, **options)
    last = [-1]

    def process(batch: DataFrame, batch_id: int) -> None:
        detector(batch, batch_id)
        last[0] = batch_id

    for _ in arrivals or (0,):
        out = build()
        _drain(out.writeStream.foreachBatch(process), f"{path}/checkpoint")
    found = detector.results(spark)
    if detector.delay:
        schema = out.select("seq", detector.context, "ts", number(out, "value").alias("value")).schema
        found = found.unionByName(detector.waiting(spark, last[0], schema))
    return found
