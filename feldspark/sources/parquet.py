"""Parquet source and sink, health check, and the source factory."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.errors import AnalysisException

from feldspark.operators.quality import RAW_SCHEMA, check_schema
from feldspark.operators.stats import null_profile
from feldspark.sources.synthetic import synthetic_regression


def read_parquet(
    spark: SparkSession, path: str, expected: T.StructType | None = None, **options
) -> DataFrame:
    """A lazy scan of a file or folder. A missing path raises ``FileNotFoundError``."""
    try:
        df = spark.read.options(**options).parquet(path)
    except AnalysisException as e:
        if e.getCondition() == "PATH_NOT_FOUND":
            raise FileNotFoundError(f"Path not found: {path}") from e
        raise
    return check_schema(df, expected) if expected is not None else df


def health_check(df: DataFrame, expected: T.StructType | None = None) -> dict:
    """Row count, missing values per column and a verdict; one job."""
    if expected is not None:
        check_schema(df, expected)
    rows = null_profile(df).collect()  # one row per column
    total = rows[0]["num_rows"] if rows else 0
    return {
        "valid": total > 0,
        "num_rows": total,
        "null_counts": {r["column"]: r["null_count"] for r in rows},
    }


def gathered(df: DataFrame, partition_cols: Sequence[str]) -> DataFrame:
    """Bring equal partition values together, so that a folder gets few files of good size.

    The rebalance hint lets adaptive execution split the values that hold many rows.
    """
    missing = [c for c in partition_cols if c not in df.columns]
    if missing:
        raise ValueError(f"Partition columns not found: {missing}")
    return df.hint("rebalance", *partition_cols) if partition_cols else df


def write_parquet(
    df: DataFrame, path: str, partition_cols: Sequence[str] = (), mode: str = "errorifexists", gather: bool = True
) -> None:
    laid_out = gathered(df, partition_cols) if gather else df
    writer = laid_out.write.mode(mode)
    (writer.partitionBy(*partition_cols) if partition_cols else writer).parquet(path)


SOURCES = {
    "parquet": lambda spark, path, schema_validation=True, expected=RAW_SCHEMA, **kw: read_parquet(
        spark, path, expected if schema_validation else None, **kw
    ),
    "synthetic": synthetic_regression,
}


def create_source(spark: SparkSession, source_type: str, **options) -> DataFrame:
    """Build a source by name; further ones can be added to ``SOURCES``."""
    if source_type not in SOURCES:
        raise ValueError(f"Unknown source type: {source_type}")
    return SOURCES[source_type](spark, **options)
