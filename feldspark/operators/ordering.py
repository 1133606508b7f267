"""Order statistics, ranks inside hot groups and checked lookups.

Everything that needs an order in this package goes through here, so that no
operator sorts a whole table, or a whole group, in one task.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass
from datetime import datetime
from functools import reduce
from operator import and_, or_

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from feldspark.session import materialize

GATHER_ROWS = 50_000  # a search interval this small is sorted inside one aggregate
SKETCH_ACCURACY = 10_000
CHUNK_ROWS = 2_000_000  # rows of one group that one task may sort
SAMPLE_PER_CHUNK = 1_000
BROADCAST_ROWS = 500_000
BROADCAST_BYTES = 64 << 20
HOT_ROWS = 1_000_000  # rows of one key that one task of a join may take


def order_number(df: DataFrame, name: str) -> Column:
    """A numeric image of a column that keeps its order (dates and timestamps in microseconds)."""
    c, kind = F.col(f"`{name}`"), df.schema[name].dataType
    if isinstance(kind, (T.FloatType, T.DoubleType)):
        return F.when(~F.isnan(c), c).cast("double")
    if isinstance(kind, T.IntegralType):
        return c.cast("long")
    if isinstance(kind, T.DecimalType):
        # up to 18 digits are exact as whole numbers of the last place, more are compared as doubles
        return (c * F.lit(10**kind.scale)).cast("long") if kind.precision <= 18 else c.cast("double")
    if isinstance(kind, T.TimestampType):
        return F.unix_micros(c)
    if isinstance(kind, T.DateType):
        return F.unix_date(c).cast("long") * F.lit(86_400_000_000)
    if isinstance(kind, T.TimestampNTZType):
        # field by field, so that the session time zone plays no part
        seconds = F.unix_date(c.cast("date")).cast("long") * 86_400 + F.hour(c) * 3_600 + F.minute(c) * 60
        micros = (F.extract(F.lit("SECOND"), c) * 1_000_000).cast("long")
        return seconds * F.lit(1_000_000) + micros
    raise TypeError(f"column {name} of type {kind.simpleString()} has no numeric order")


# ---------------------------------------------------------------- selection


def literal(value) -> Column:
    """A literal of a collected value; datetimes stand for timestamps without a zone."""
    if isinstance(value, datetime):
        return F.lit(value.isoformat(sep=" ")).cast("timestamp_ntz")
    return F.lit(value)


@dataclass
class _Search:
    """One rank of one column; the answer lies strictly between ``low`` and ``high``."""

    column: str
    rank: int
    size: int
    low: float | int | None = None
    high: float | int | None = None
    below: int = 0  # rows at or under ``low``
    stuck: bool = False
    answer: tuple | None = None  # (value, rows below it, rows equal to it)

    def inside(self, x: Column) -> Column:
        bounds = [] if self.low is None else [x > literal(self.low)]
        bounds += [] if self.high is None else [x < literal(self.high)]
        return reduce(and_, bounds) if bounds else x.isNotNull()

    def clamp(self, pivot):
        """The pivot, moved into the interval if rounding put it outside."""
        if self.low is not None and pivot < self.low:
            return self.low
        return self.high if self.high is not None and pivot > self.high else pivot

    def narrow(self, low_pivot, high_pivot, under: int, at_low: int, between: int, at_high: int) -> None:
        """Keep the part, of the five that two pivots make, which holds the rank."""
        before, size = self.below, self.size
        rest = self.rank - self.below
        if rest <= under:
            self.high, self.size = low_pivot, under
        elif rest <= under + at_low:
            self.answer = (low_pivot, self.below + under, at_low)
        elif rest <= under + at_low + between:
            self.low, self.high = low_pivot, high_pivot
            self.below += under + at_low
            self.size = between
        elif rest <= under + at_low + between + at_high:
            self.answer = (high_pivot, self.below + under + at_low + between, at_high)
        else:
            gone = under + at_low + between + at_high
            self.low = high_pivot
            self.below += gone
            self.size -= gone
        self.stuck = self.answer is None and (self.below, self.size) == (before, size)


def select_ranks(
    df: DataFrame,
    columns: dict[str, Column],
    ranks: dict[str, Sequence[int]],
    counts: dict[str, int],
    gather_rows: int = GATHER_ROWS,
    pivots: dict[tuple[str, int], tuple] | None = None,
) -> dict[tuple[str, int], tuple]:
    """Exact values at 1-based ascending ranks: ``{(column, rank): (value, n_below, n_equal)}``.

    Quickselect with sketched pivots. Each round asks a bounded-size quantile sketch
    for two pivots around every rank and counts the five parts they make; a sketch of
    accuracy a leaves about n/a rows, so two or three rounds are enough for any size.
    Only counters and sketches are shuffled, never the rows. A value that holds a
    large share of the rows becomes a pivot and is settled by its count. ``pivots`` from
    an earlier pass over the rows save the first sketch.
    """
    # plain columns first: the conditions below refer to each of them many times
    df = df.select(*[c.alias(name) for name, c in columns.items()])
    columns = {name: F.col(f"`{name}`") for name in columns}
    searches = [
        _Search(name, rank, counts[name]) for name, wanted in ranks.items() for rank in sorted(set(wanted))
    ]
    for s in searches:
        if not 1 <= s.rank <= s.size:
            raise ValueError(f"rank {s.rank} of {s.column} is outside 1..{s.size}")
    while True:
        open_ = [s for s in searches if s.answer is None]
        if not open_:
            break
        small = [s for s in open_ if s.size <= gather_rows]
        large = [s for s in open_ if s.size > gather_rows]
        intervals = {(s.column, s.low, s.high): s.inside(columns[s.column]) for s in open_}
        scope = df.filter(reduce(or_, intervals.values()))
        if small:
            _gather(scope, columns, small)
        if large:
            known = pivots if pivots and all((s.column, s.rank) in pivots for s in large) else None
            _narrow(scope, columns, large, known or _sketch(scope, columns, large))
        pivots = None
    return {(s.column, s.rank): s.answer for s in searches}


def _gather(df: DataFrame, columns: dict[str, Column], searches: list[_Search]) -> None:
    lists: dict[tuple, list[_Search]] = {}
    for s in searches:
        lists.setdefault((s.column, s.low, s.high), []).append(s)
    names = {key: f"v{i}" for i, key in enumerate(lists)}
    packed = df.agg(
        *[
            F.sort_array(F.collect_list(F.when(g[0].inside(columns[k[0]]), columns[k[0]]))).alias(names[k])
            for k, g in lists.items()
        ]
    )
    picks = [_pick(F.col(names[k]), F.lit(s.rank - s.below)) for k, g in lists.items() for s in g]
    row = packed.select(*picks).first()
    for s, found in zip([s for g in lists.values() for s in g], row, strict=True):
        s.answer = (found["value"], s.below + found["under"], found["same"])


def pivot_places(p: float) -> list[float]:
    """The two places around ``p`` that a sketch is asked for."""
    margin = 2.0 / SKETCH_ACCURACY
    return [max(p - margin, 0.0), min(p + margin, 1.0)]


def _sketch(df: DataFrame, columns: dict[str, Column], searches: list[_Search]) -> dict[tuple[str, int], tuple]:
    """Two pivots per search; searches in one interval share a sketch, near ranks share pivots."""
    intervals: dict[tuple, list[_Search]] = {}
    for s in searches:
        intervals.setdefault((s.column, s.low, s.high, s.stuck), []).append(s)
    exprs, clusters = [], []
    for (column, _, _, stuck), group in intervals.items():
        x = F.when(group[0].inside(columns[column]), columns[column])
        near: list[list[_Search]] = []
        for s in sorted(group, key=lambda g: g.rank):
            if near and (stuck or s.rank - near[-1][0].rank <= s.size / SKETCH_ACCURACY):
                near[-1].append(s)
            else:
                near.append([s])
        clusters.append(near)
        if stuck:  # integers too large for the doubles of the sketch: halve their range
            middle = F.min(x) + F.floor((F.max(x) - F.min(x)) / 2)
            exprs.append(F.array(middle, middle))
        else:
            places = [q for c in near for q in pivot_places((c[0].rank - c[0].below) / c[0].size)]
            exprs.append(F.percentile_approx(x, places, SKETCH_ACCURACY))
    found: dict[tuple[str, int], tuple] = {}
    for near, values in zip(clusters, df.agg(*exprs).first(), strict=True):
        for i, cluster in enumerate(near):
            for s in cluster:
                found[s.column, s.rank] = (s.clamp(values[2 * i]), s.clamp(values[2 * i + 1]))
    return found


def _narrow(
    df: DataFrame, columns: dict[str, Column], searches: list[_Search], pivots: dict[tuple[str, int], tuple]
) -> None:
    """Count the five parts that each pair of pivots makes, and keep the part with the rank."""
    parts: dict[tuple, list[_Search]] = {}
    for s in searches:
        parts.setdefault((s.column, s.low, s.high, *pivots[s.column, s.rank]), []).append(s)
    exprs = []
    for (column, _, _, a, b), group in parts.items():
        x = F.when(group[0].inside(columns[column]), columns[column])
        exprs += [F.count_if(x < literal(a)), F.count_if(x <= literal(a)), F.count_if(x < literal(b)), F.count_if(x <= literal(b))]
    row = df.agg(*exprs).first()
    for i, (key, group) in enumerate(parts.items()):
        under_a, upto_a, under_b, upto_b = row[4 * i:4 * i + 4]
        a, b = key[3], key[4]
        between, at_b = (under_b - upto_a, upto_b - under_b) if a < b else (0, 0)
        for s in group:
            s.narrow(a, b, under_a, upto_a - under_a, between, at_b)


def _pick(values: Column, place: Column) -> Column:
    """The value at a 1-based place of a sorted array, with the numbers of smaller and equal ones."""
    x = F.when((place >= 1) & (place <= F.size(values)), F.element_at(values, place))
    under = F.size(F.filter(values, lambda e: e < x))
    same = F.size(F.filter(values, lambda e: e == x))
    return F.struct(x.alias("value"), under.alias("under"), same.alias("same"))


def exact_quantiles(
    df: DataFrame,
    columns: dict[str, Column],
    probabilities: Sequence[float],
    counts: dict[str, int],
    gather_rows: int = GATHER_ROWS,
    hints: dict[str, Sequence] | None = None,
) -> dict[str, list[float | None]]:
    """Quantiles with linear interpolation between neighboring values.

    ``hints`` are the sketched values at ``pivot_places`` of each probability, if an
    earlier pass has taken them.
    """
    ranks: dict[str, list[int]] = {}
    for name, n in counts.items():
        if n:
            places = [math.floor((n - 1) * p) for p in probabilities]
            ranks[name] = [r for k in places for r in (k + 1, min(k + 2, n))]
    pivots = {}
    for name, values in (hints or {}).items():
        for i in range(len(probabilities) if values else 0):
            for r in ranks.get(name, [])[2 * i:2 * i + 2]:
                pivots[name, r] = (values[2 * i], values[2 * i + 1])
    found = select_ranks(df, columns, ranks, counts, gather_rows, pivots) if ranks else {}
    result: dict[str, list[float | None]] = {}
    for name, n in counts.items():
        values: list[float | None] = []
        for p in probabilities:
            if not n:
                values.append(None)
                continue
            place = (n - 1) * p
            k = math.floor(place)
            low, high = found[name, k + 1][0], found[name, min(k + 2, n)][0]
            values.append(low + (high - low) * (place - k))
        result[name] = values
    return result


# ------------------------------------------------------------ ranks in groups


def cut_points(df: DataFrame, columns: dict[str, Column], n: int, chunks: int) -> dict[str, list[float]]:
    """Per column ``chunks - 1`` ascending values that part about ``n`` rows into even chunks.

    A value may repeat; a repeated value alone fills at least one chunk. Any cut points
    are right, even ones only help the balance, so a random part of a large table will do.
    """
    if chunks <= 1:
        return {name: [] for name in columns}
    steps = [i / chunks for i in range(1, chunks)]
    share = SAMPLE_PER_CHUNK * chunks / max(n, 1)
    rows = df.select(*[x.cast("double").alias(name) for name, x in columns.items()])
    if share < 0.5:
        rows = rows.filter(F.rand(17) < F.lit(share))
    accuracy = max(SKETCH_ACCURACY, 10 * chunks)
    row = rows.agg(*[F.percentile_approx(f"`{name}`", steps, accuracy) for name in columns]).first()
    return {name: cuts or [] for name, cuts in zip(columns, row, strict=True)}


def with_bucket(df: DataFrame, column: str, cuts: Sequence[float], output: str) -> DataFrame:
    """Add how many distinct ``cuts`` are at or below a double column; -1 where it is NULL."""
    if not cuts:
        bucket = F.lit(0)
        return df.withColumn(output, F.when(F.col(column).isNull(), -1).otherwise(bucket))
    splits = [float("-inf"), *sorted(set(cuts)), float("inf")]
    found = Bucketizer(splits=splits, inputCol=column, outputCol=output, handleInvalid="keep").transform(df)
    return found.withColumn(output, F.when(F.col(column).isNull(), -1).otherwise(F.col(output).cast("int")))


def group_sizes(df: DataFrame, groups: Sequence[str]) -> tuple[int, int]:
    """Rows of the largest group and of the whole table; reads only the group columns."""
    largest, total = df.groupBy(*groups).count().agg(F.max("count"), F.sum("count")).first()
    return largest or 0, total or 0


def _present(df: DataFrame, name: str) -> Column:
    """The column with NaN as NULL."""
    c = F.col(f"`{name}`")
    return F.when(~F.isnan(c), c) if isinstance(df.schema[name].dataType, (T.FloatType, T.DoubleType)) else c


def rank_within(
    df: DataFrame,
    groups: Sequence[str],
    order: Sequence[str],
    output: str = "position",
    chunk_rows: int = CHUNK_ROWS,
    sizes: tuple[int, int] | None = None,
) -> DataFrame:
    """1-based position of each row in its group, in the order of ``order`` (its last column unique).

    NULL and NaN come first and are ties; then numbers, times or strings ascend. A light job (unless ``sizes`` are
    given) measures the largest group. If one task can sort it, this is a plain window. Otherwise the rows are dealt
    to ranges of the whole key (groups, then every order column, compared as they are; the cut rows are sampled), so
    that a group of any size is spread over many tasks whatever its leading values look like. A range is sorted where
    it lies, which spills if it must; a position is a row's place in its range, counted from the first row of its group
    there and shifted by the rows of the group in the ranges before. However small ``chunk_rows``, there are no more
    ranges than the shuffle has partitions, or than ranges of ``CHUNK_ROWS``.
    """
    order_by = [_present(df, c).asc_nulls_first() for c in order]
    largest, total = sizes or group_sizes(df, groups)
    if largest <= chunk_rows:
        return df.withColumn(output, F.row_number().over(Window.partitionBy(*groups).orderBy(*order_by)))

    key = [*[F.col(f"`{g}`").asc_nulls_first() for g in groups], *order_by]
    ranged = df.repartitionByRange(_ranges(df, total, chunk_rows), *key).sortWithinPartitions(*key)
    # written once: the jobs below must see the same ranges
    staged = materialize(
        ranged.withColumn("_chunk", F.spark_partition_id()).withColumn("_row", F.monotonically_increasing_id()), "ranges"
    )
    keys = [*groups, "_chunk"]
    by_group = Window.partitionBy(*groups).orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        staged.groupBy(*keys)
        .agg(F.count(F.lit(1)).alias("_n"), F.min("_row").alias("_first"))
        .select(*[F.col(k).alias(f"_r{i}") for i, k in enumerate(keys)],
                (F.coalesce(F.sum("_n").over(by_group), F.lit(0)) - F.col("_first") + 1).alias("_shift"))
    )
    same = [F.col(k).eqNullSafe(F.col(f"_r{i}")) for i, k in enumerate(keys)]
    return staged.join(offsets, same, "inner").select(
        *df.columns, (F.col("_row") + F.col("_shift")).cast("long").alias(output)
    )


def _ranges(df: DataFrame, total: int, chunk_rows: int) -> int:
    """How many ranges ``total`` rows are dealt to: what ``chunk_rows`` asks for, within what tasks are worth."""
    worth = max(math.ceil(total / CHUNK_ROWS), int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    return max(1, min(math.ceil(total / chunk_rows), worth))


def in_blocks(df: DataFrame, position: str, block_rows: int, halo: int = 0) -> DataFrame:
    """Add ``_block`` (consecutive runs of ``block_rows`` positions) and ``_own``.

    With ``halo`` the last rows of each block are repeated at the head of the next one
    (``_own`` is false there), so that a sliding window may run per block.
    """
    if halo > block_rows:
        raise ValueError("halo must not exceed block_rows")
    home = F.floor((F.col(position) - 1) / F.lit(block_rows)).cast("long")
    if not halo:
        return df.withColumn("_block", home).withColumn("_own", F.lit(True))
    tail = (F.col(position) - 1) % F.lit(block_rows) >= F.lit(block_rows - halo)
    homes = F.when(tail, F.array(home, home + 1)).otherwise(F.array(home))
    return df.withColumn("_home", home).withColumn("_block", F.explode(homes)).withColumn(
        "_own", F.col("_block") == F.col("_home")
    ).drop("_home")


# ------------------------------------------------------------------- lookups


def hot_keys(df: DataFrame, on: Sequence[str], hot_rows: int = HOT_ROWS, most: int = 256) -> list[int]:
    """Hashes of the keys that hold more than ``hot_rows`` rows, from one pass with a frequent-items sketch.

    The sketch may miss a key near the limit or name one below it; that only changes how rows are spread.
    """
    keys = df.select(F.xxhash64(*[f"`{c}`" for c in on]).alias("_key"))
    items = keys.agg(F.expr(f"approx_top_k(_key, {most}, {64 * most})").alias("t")).first()["t"]
    return [r["item"] for r in items or [] if r["count"] > hot_rows]


def join_lookup(
    df: DataFrame,
    lookup: DataFrame,
    on: Sequence[str],
    how: str = "left",
    max_rows: int = BROADCAST_ROWS,
    salts: int = 64,
    max_bytes: int = BROADCAST_BYTES,
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Join per-key values to rows: broadcast when the measured lookup is small, else by shuffle with hot keys salted.

    ``lookup`` has one row per key. It is small if it has at most ``max_rows`` rows and ``max_bytes`` as text. Beyond
    that, a sketch finds the keys that hold more than ``hot_rows`` rows of ``df``; only their lookup rows are repeated,
    once per salt, and their rows are spread over the salts by content.
    """
    lookup = materialize(lookup, "lookup")
    rows, size = lookup.agg(F.count(F.lit(1)), F.sum(F.length(F.to_json(F.struct(*[f"`{c}`" for c in lookup.columns]))))).first()
    if rows <= max_rows and (size or 0) <= max_bytes:
        return df.join(F.broadcast(lookup), list(on), how)
    hot = hot_keys(df, on, hot_rows)
    if not hot:
        return df.join(lookup, list(on), how)
    is_hot = F.xxhash64(*[f"`{c}`" for c in on]).isin(hot)
    plain = [f.name for f in df.schema.fields if not isinstance(f.dataType, (T.MapType, T.VariantType))]
    salt = F.pmod(F.xxhash64(*[f"`{c}`" for c in plain]), F.lit(salts)).cast("int")
    salted = df.withColumn("_salt", F.when(is_hot, salt).otherwise(0))
    every = F.sequence(F.lit(0), F.lit(salts - 1))
    repeated = lookup.withColumn("_salt", F.explode(F.when(is_hot, every).otherwise(F.array(F.lit(0)))))
    return salted.join(repeated, [*on, "_salt"], how).drop("_salt")
