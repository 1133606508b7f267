"""Small DataFrame helpers of this subpackage."""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from feldspark.llm import arrays
from feldspark.session import materialize

NO_ID = -(1 << 63)  # stands for a missing doc_id inside an operator


def table(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    df = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    return df.select(*columns) if columns else df


def id_and_text(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(did, text) with a number for a missing id; other columns of ``docs`` play no part."""
    return docs.select(
        F.coalesce(F.col(f"`{id_col}`").cast("long"), F.lit(NO_ID)).alias("did"),
        F.col(f"`{text_col}`").cast("string").alias("text"),
    )


def real_id(column: str = "did"):
    return F.when(F.col(column) != NO_ID, F.col(column))


def own_keys(docs: DataFrame, id_col: str = "doc_id") -> tuple[DataFrame, str]:
    """``docs`` and the name of a long column that is different in every row.

    That is the id column where ids are present and unique, which one light job over the ids tells. Otherwise rows
    are written once in order of id (missing ids last), then of content, and numbered in that order.
    """
    ids = docs.select(F.col(f"`{id_col}`").cast("long").alias("did")).groupBy("did").count()
    if ids.where("count > 1 OR did IS NULL").isEmpty():
        return docs, id_col
    key, spark = fresh(docs, "row_key"), docs.sparkSession
    order = [F.col(f"`{id_col}`").cast("long").asc_nulls_last(), F.xxhash64(*[f"`{c}`" for c in docs.columns]).asc()]
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    numbered = docs.repartitionByRange(parts, *order).sortWithinPartitions(*order).withColumn(key, F.monotonically_increasing_id())
    return materialize(numbered, "numbered"), key


def per_row(docs: DataFrame, run: Callable[[DataFrame, str], DataFrame], id_col: str, ids: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``run(docs, key)`` with a key per row; the keys in the columns ``ids`` of its result are ids again."""
    rows, key = own_keys(docs, id_col)
    out = run(rows, key)
    if key == id_col:
        return out
    names, columns = rows.select(F.col(key).alias("_key"), F.col(f"`{id_col}`").cast("long").alias("_id")), out.columns
    for c in ids:
        out = out.join(names, out[c] == names["_key"], "left").drop(c, "_key").withColumnRenamed("_id", c)
    return out.select(*columns)


def map_batches(df: DataFrame, f: Callable[[pa.RecordBatch], Iterator[pa.RecordBatch]], schema: str) -> DataFrame:
    """Apply ``f`` to each Arrow batch; batches hold whole rows and stream through a task."""

    def run(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in source:
            if batch.num_rows:
                yield from f(batch)
            arrays.release()

    return df.mapInArrow(run, schema)


def text_bytes(docs: DataFrame, column: str = "text") -> int:
    """UTF-8 bytes of all texts: one scan of one column."""
    return docs.agg(F.sum(F.octet_length(F.col(column)))).first()[0] or 0


def parts_for(spark: SparkSession, size: float, target: float) -> int:
    """Pieces of about ``target`` bytes, and at least one per shuffle partition."""
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), math.ceil(size / target), 1)


def fresh(df: DataFrame, name: str) -> str:
    """``name``, or a longer one if ``df`` has it already."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name
