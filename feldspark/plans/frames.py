"""Adapters: the feature frame and the metric stream made from the given tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from feldspark.sources.parquet import read_parquet


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return read_parquet(spark, f"{folder}/{name}.parquet")


def feature_frame(lineitem: DataFrame) -> DataFrame:
    """The raw schema (id, four features, timestamp, target) from line items."""
    return lineitem.select(
        F.col("l_orderkey").alias("id"),
        F.col("l_quantity").alias("feature_1"),
        F.col("l_discount").alias("feature_2"),
        F.col("l_extendedprice").alias("feature_3"),
        F.col("l_tax").alias("feature_4"),
        F.col("l_shipdate").alias("timestamp"),
        (F.col("l_returnflag") == "R").cast("long").alias("target"),
    )


def metric_frame(events: DataFrame) -> DataFrame:
    """Events as metrics: the event type is the name, the user the context."""
    return events.select(
        F.col("event_id").alias("seq"), F.col("event_type").alias("name"), "value", "ts",
        F.col("user_id").alias("context"),
    )


def system_metrics(events: DataFrame) -> DataFrame:
    """Events under the metric names that have limits and summaries."""
    name = (
        F.when(F.col("event_type") == "click", "system.cpu.percent")
        .when(F.col("event_type") == "view", "system.memory.percent")
        .when(F.col("event_type") == "error", "serving.prediction.latency")
        .otherwise(F.concat(F.lit("training."), F.col("event_type")))
    )
    return events.select(
        F.col("event_id").alias("seq"), name.alias("name"), "value", "ts", F.col("user_id").alias("context")
    )
