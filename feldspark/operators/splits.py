"""Dataset splits: random, stratified, by time and by group.

Every split labels rows in place (column ``split``). The cut points are found first,
with counters and small selections; the labelling itself is a narrow projection,
so the full rows are not shuffled or sorted.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from feldspark.functions.hashing import token, uniform
from feldspark.operators.ordering import join_lookup, literal, order_number, select_ranks
from feldspark.session import materialize

TRAIN, VALIDATION, TEST = "train", "validation", "test"
BIN_ROWS = 1_000_000


def _label(first: Column, second: Column) -> Column:
    return F.when(first, TRAIN).when(second, VALIDATION).otherwise(TEST)


def random_split(
    df: DataFrame, key: str, train: float = 0.7, validation: float = 0.15, seed: int = 42, output: str = "split"
) -> DataFrame:
    """Label by the hash of ``key``: no shuffle, and stable under any repartitioning."""
    draw = uniform(seed, F.col(key))
    return df.withColumn(output, _label(draw < F.lit(train), draw < F.lit(train + validation)))


def holdout(
    df: DataFrame, key: str, validation_split: float = 0.2, seed: int = 42, output: str = "split"
) -> DataFrame:
    """Train and validation labels only; a share of 0 leaves everything in train."""
    draw = uniform(seed, F.col(key))
    return df.withColumn(output, F.when(draw < F.lit(1.0 - validation_split), TRAIN).otherwise(VALIDATION))


def cut_tokens(
    hashed: DataFrame, strata: Sequence[str], train: float, validation: float, bin_rows: int = BIN_ROWS
) -> DataFrame:
    """Per stratum the tokens at ranks ``int(n*train)`` and ``+int(n*validation)``.

    ``hashed`` has the strata and ``_token``. Tokens are uniform hex digests, so their
    first digits are even bins: counting bins shows in which bin a rank falls, and only
    the rows of those bins are ranked. A stratum of any size is spread over its bins.
    """
    total = hashed.count()
    if total <= bin_rows:  # one task may rank all of it
        group = Window.partitionBy(*strata)
        ranked = hashed.groupBy(*strata, "_token").agg(F.count(F.lit(1)).alias("_n")).select(
            *strata, "_token",
            F.sum("_n").over(group.orderBy("_token").rowsBetween(Window.unboundedPreceding, 0)).alias("_r"),
            F.sum("_n").over(group).alias("_total"),
        )
        first, second = _cut_ranks(train, validation)
        return _tokens_at(ranked.withColumn("_k1", first).withColumn("_k2", second), strata)
    digits = max(1, math.ceil(math.log(total / bin_rows, 16)))  # 16 bins per digit
    binned = hashed.withColumn("_bin", F.substring("_token", 1, digits))
    counted = binned.groupBy(*strata, "_bin").agg(F.count(F.lit(1)).alias("_n"))
    order = Window.partitionBy(*strata).orderBy("_bin")
    running = counted.select(
        *strata, "_bin", "_n",
        F.sum("_n").over(order.rowsBetween(Window.unboundedPreceding, 0)).alias("_upto"),
        F.sum("_n").over(Window.partitionBy(*strata)).alias("_total"),
    )
    first, second = _cut_ranks(train, validation)
    wanted = running.select(
        "*", F.explode(F.array(F.struct(F.lit(1).alias("cut"), first.alias("rank")),
                               F.struct(F.lit(2).alias("cut"), second.alias("rank")))).alias("_c")
    ).filter((F.col("_c.rank") > F.col("_upto") - F.col("_n")) & (F.col("_c.rank") <= F.col("_upto")))
    wanted = wanted.groupBy(*strata, "_bin").agg(
        F.max(F.when(F.col("_c.cut") == 1, F.col("_c.rank") - F.col("_upto") + F.col("_n"))).alias("_k1"),
        F.max(F.when(F.col("_c.cut") == 2, F.col("_c.rank") - F.col("_upto") + F.col("_n"))).alias("_k2"),
    )
    inside = join_lookup(binned, wanted, [*strata, "_bin"], "inner")
    # counted per token first: a key that holds many rows is one row here
    tokens = inside.groupBy(*strata, "_bin", "_k1", "_k2", "_token").agg(F.count(F.lit(1)).alias("_n"))
    along = Window.partitionBy(*strata, "_bin").orderBy("_token").rowsBetween(Window.unboundedPreceding, 0)
    return _tokens_at(tokens.withColumn("_r", F.sum("_n").over(along)), strata)


def _cut_ranks(train: float, validation: float) -> tuple[Column, Column]:
    first = F.floor(F.col("_total") * F.lit(float(train)))
    return first, first + F.floor(F.col("_total") * F.lit(float(validation)))


def _tokens_at(placed: DataFrame, strata: Sequence[str]) -> DataFrame:
    """The first tokens whose running count reaches ``_k1`` and ``_k2``; empty where a rank is 0."""

    def reached(k: str) -> Column:
        return F.coalesce(F.min(F.when((F.col(k) > 0) & (F.col("_r") >= F.col(k)), F.col("_token"))), F.lit(""))

    return placed.groupBy(*strata).agg(reached("_k1").alias("_first"), reached("_k2").alias("_second"))


def stratified_split(
    df: DataFrame, key: str, stratum: str, train: float = 0.7, validation: float = 0.15,
    seed: int = 42, output: str = "split", bin_rows: int = BIN_ROWS,
) -> DataFrame:
    """Exact shares inside each stratum, in hash order of ``key`` (a unique column).

    Rows that share a key in a stratum stay in one split, the one its first row reaches.
    """
    # NULL is a stratum of its own; the join needs a value for it
    marked = df.withColumn("_token", token(seed, F.col(key))).withColumn("_stratum", F.struct(
        F.col(stratum).isNull().alias("none"), F.coalesce(F.col(stratum).cast("string"), F.lit("")).alias("value")))
    cuts = cut_tokens(marked.select("_stratum", "_token"), ["_stratum"], train, validation, bin_rows)
    second = F.greatest(F.col("_first"), F.col("_second"))
    labelled = join_lookup(marked, cuts, ["_stratum"]).withColumn(
        output,
        _label(F.col("_token") <= F.coalesce("_first", F.lit("")), F.col("_token") <= F.coalesce(second, F.lit(""))),
    )
    return labelled.select(*[c for c in df.columns if c != output], output)


def group_split(
    df: DataFrame, group: str, train: float = 0.7, validation: float = 0.15,
    seed: int = 42, output: str = "split", bin_rows: int = BIN_ROWS,
) -> DataFrame:
    """Whole groups go to one split. The label depends on the group's hash alone: no join."""
    # NULL is a group of its own, apart from the empty string
    name = F.coalesce(F.col(group).cast("string"), F.lit("\x00"))
    # a written table: the groups are counted, binned and ranked from the same copy
    groups = materialize(df.select(token(seed, name).alias("_token")).distinct(), "groups")
    row = cut_tokens(groups, [], train, validation, bin_rows).first()
    first, second = (row["_first"], max(row["_first"], row["_second"])) if row else ("", "")
    mine = token(seed, name)
    return df.withColumn(output, _label(mine <= F.lit(first), mine <= F.lit(second)))


def _among_first(tied: DataFrame, key: str, rest: int, same: int, **search) -> Column:
    """Whether one of ``same`` tied rows is among the first ``rest`` by key (NULL first).

    Numbers are selected directly. Strings are selected seven bytes at a time, each as a whole number that keeps
    their order: among the rows that agree so far the next seven bytes of the cut key are found, until it ends.
    """
    if not isinstance(tied.schema[key].dataType, T.StringType):
        tie = order_number(tied, key)
        return tie <= F.lit(select_ranks(tied, {"tie": tie}, {"tie": [rest]}, {"tie": same}, **search)["tie", rest][0])
    text, rows, depth = F.col(f"`{key}`"), tied, 0
    while True:
        head = F.rpad(F.hex(F.substring(text.cast("binary"), 7 * depth + 1, 7)), 14, "0")
        piece = F.coalesce(F.conv(head, 16, 10).cast("long"), F.lit(-1))
        value, below, same = select_ranks(rows, {"p": piece}, {"p": [rest]}, {"p": same}, **search)["p", rest]
        if value == -1:
            return text.isNull()
        rows, rest, depth = rows.filter(piece == F.lit(value)), rest - below, depth + 1
        if same == 1 or value % 256 == 0:  # one row is left, or all rows left end here and are equal
            return text.isNull() | (text <= F.lit(rows.agg(F.max(text)).first()[0]))


def time_split(
    df: DataFrame, time: str, key: str, train: float = 0.7, validation: float = 0.15,
    output: str = "split", **search,
) -> DataFrame:
    """The first ``int(n*train)`` rows by (time, key), the next ``int(n*validation)``, the rest.

    Finds the two cut rows by selection; no global sort. Missing times sort first.
    """
    kind = df.schema[time].dataType
    if isinstance(kind, T.TimestampNTZType):
        when = F.coalesce(F.col(time), literal(datetime.min))
    else:
        wide = isinstance(kind, T.DecimalType) and kind.precision > 18
        floating = wide or isinstance(kind, (T.FloatType, T.DoubleType))
        when = F.coalesce(order_number(df, time), F.lit(float("-inf")) if floating else F.lit(-(2**62)))
    total = df.count()
    first = int(total * train)
    second = first + int(total * validation)
    ranks = sorted({r for r in (first, second) if r > 0})
    found = select_ranks(df, {"when": when}, {"when": ranks}, {"when": total}, **search) if ranks else {}

    def upto(rank: int) -> Column:
        if rank == 0:
            return F.lit(False)
        value, below, same = found["when", rank]
        rest = rank - below
        if rest == same:
            return when <= literal(value)
        tied = df.filter(when == literal(value))
        return (when < literal(value)) | ((when == literal(value)) & _among_first(tied, key, rest, same, **search))

    return df.withColumn(output, _label(upto(first), upto(second)))


@dataclass(frozen=True)
class Splitter:
    """One entry point for all strategies; ``key`` is the unique row key."""

    key: str
    train: float = 0.7
    validation: float = 0.15
    test: float = 0.15
    strategy: str = "random"
    seed: int = 42
    stratify_col: str | None = None
    time_col: str | None = None
    group_col: str | None = None

    def __post_init__(self) -> None:
        total = self.train + self.validation + self.test
        if not math.isclose(total, 1.0, rel_tol=1e-5, abs_tol=1e-8):
            raise ValueError(f"Split proportions must sum to 1, got {total}")
        if self.strategy not in ("random", "stratified", "time_based", "group_based"):
            raise ValueError(f"Unknown strategy: {self.strategy}")

    def split(self, df: DataFrame, output: str = "split") -> DataFrame:
        shares = {"train": self.train, "validation": self.validation, "output": output}
        if self.strategy == "random":
            return random_split(df, self.key, seed=self.seed, **shares)
        needed = {"stratified": "stratify_col", "time_based": "time_col", "group_based": "group_col"}[self.strategy]
        column = getattr(self, needed)
        if column is None:
            raise ValueError(f"{needed} must be specified for a {self.strategy} split")
        if self.strategy == "stratified":
            return stratified_split(df, self.key, column, seed=self.seed, **shares)
        if self.strategy == "time_based":
            return time_split(df, column, self.key, **shares)
        return group_split(df, column, seed=self.seed, **shares)


def default_splitter(key: str) -> Splitter:
    return Splitter(key)


def parts(df: DataFrame, column: str = "split") -> dict[str, DataFrame]:
    """The labelled frame as one lazy frame per split."""
    return {name: df.filter(F.col(column) == name) for name in (TRAIN, VALIDATION, TEST)}
