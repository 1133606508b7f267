"""A corpus in five stages: each works on the documents that the one before has kept.

A stage takes (spark, docs, sf_dir) and returns a DataFrame; ``run`` writes it as Parquet below the
shared scratch folder and reads it again for the next. All stages but the last return the columns
of ``documents`` as they came, with ``n_chars`` following a changed text. Every row is a document of its own: where
ids are missing or repeat, rows are numbered by id and content for the stage. A null text is an empty one (it has no
words, so the quality stage rejects it); an empty table stays empty; other columns come along unchanged.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from feldspark.llm import bpe_tree, decontaminate, line_frequency, minhash_tensor, substring_dedup
from feldspark.llm.frames import fresh, own_keys
from feldspark.session import materialize

ORACLE_SQL = None  # byte-level BPE has no SQL; tests hold each stage against plain Python


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Reject texts by base rules and line frequency; take frequent lines out of those kept."""
    rows, key = own_keys(docs)
    verdicts = materialize(line_frequency.judge(rows, id_col=key), "verdicts")
    return line_frequency.strip_lines(rows, verdicts, key).select(*docs.columns)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one document (the smallest doc_id) of each component of near duplicates."""
    rows, key = own_keys(docs)
    kept_id = fresh(rows, "kept_id")
    found = minhash_tensor.near_components(rows, id_col=key).where("kept").select(F.col("doc_id").alias(kept_id))
    return rows.join(found, rows[key] == found[kept_id], "left_semi").select(*docs.columns)


def substring_removal(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Remove words covered by repeated windows; every document stays, with the words that are left."""
    return substring_dedup.strip_repeats(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Remove documents contaminated by benchmark items."""
    bench = spark.read.parquet(f"{sf_dir}/benchmark.parquet").select("item_id", "text")
    return decontaminate.remove_contaminated(docs, bench)


def encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each text, with digests of the ids and of the text decoded from them."""
    ranks, pattern = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN
    return bpe_tree.digests(bpe_tree.encode(docs, ranks, pattern), ranks, pattern)


STAGES = [
    ("quality", quality),
    ("near_dedup", near_dedup),
    ("substring_dedup", substring_removal),
    ("decontamination", decontamination),
    ("encoding", encoding),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), name)
    return docs
