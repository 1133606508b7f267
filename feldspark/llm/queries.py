"""One query per operator over its whole table, with its SQL where SQL can say the same."""

from __future__ import annotations

from collections.abc import Callable

import corpus_pipeline
import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from feldspark.llm import (
    bpe_tree, decontaminate, fingerprints, line_frequency, minhash_tensor, oracles, pu_quality, spelling, substring_dedup, suffix_dedup,
    token_orc, toxicity_knn, warc_chunks, whitening,
)
from feldspark.llm.frames import table
from feldspark.session import scratch_path

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(oracle: str | None = None):
    def register(f):
        QUERIES[f.__name__] = f
        if oracle is not None:
            ORACLES[f.__name__] = oracle
        return f

    return register


def documents(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "documents", "doc_id", "text")


@query(oracles.SUBSTRING)
def op2_substring_dedup(spark, sf):
    return substring_dedup.remove_repeats(documents(spark, sf)).drop("text")


@query(oracles.SUFFIX)
def op9_suffix_dedup(spark, sf):
    return suffix_dedup.remove_repeats(documents(spark, sf)).drop("kept")


@query(oracles.LINE_FREQUENCY)
def op1_line_frequency(spark, sf):
    docs = table(spark, sf, "documents", "doc_id", "text", "source")
    return line_frequency.judge(docs).drop("removed_lines")


@query(oracles.DECONTAMINATE)
def op3_decontaminate(spark, sf):
    bench = table(spark, sf, "benchmark", "item_id", "text")
    return decontaminate.judge(documents(spark, sf), bench).drop("items")


@query(oracles.NEAR)
def op10_minhash_tensor(spark, sf):
    return minhash_tensor.near_components(documents(spark, sf))


@query()
def op4_token_orc(spark, sf):
    path = scratch_path(spark, "tokens")
    token_orc.write_tokens(documents(spark, sf), path, public_tokenizers.path("word_bpe_49k.json"))
    return token_orc.checksums(token_orc.read_tokens(spark, path))


@query()
def op5_bpe_tree(spark, sf):
    ranks, pattern = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN
    return bpe_tree.digests(bpe_tree.encode(documents(spark, sf), ranks, pattern), ranks, pattern)


@query()
def op6_pu_quality(spark, sf):
    return pu_quality.score(documents(spark, sf), table(spark, sf, "labels", "doc_id", "quality"))


@query()
def op7_toxicity_knn(spark, sf):
    return toxicity_knn.score(documents(spark, sf), table(spark, sf, "labels", "doc_id", "toxic")).drop("neighbours", "cosines")


@query(oracles.ARCHIVES)
def op8_warc_chunks(spark, sf):
    path = scratch_path(spark, "archives")
    warc_chunks.write_archives(warc_chunks.chunk_table(warc_chunks.classify(table(spark, sf, "pages", "page_id", "url", "html"))), path)
    return warc_chunks.payload_index(warc_chunks.read_archives(spark, path))


@query()
def op11_oph_fingerprint(spark, sf):
    return fingerprints.compare(documents(spark, sf))


@query()
def op12_whiten_refine(spark, sf):
    return whitening.whiten(table(spark, sf, "embeddings", "vec_id", "embedding"))


@query(oracles.SPELLING)
def op13_bloom_spelling(spark, sf):
    return spelling.variants(documents(spark, sf))


@query(corpus_pipeline.ORACLE_SQL)
def pipeline(spark, sf):
    return corpus_pipeline.run(spark, sf)
