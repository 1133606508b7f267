"""Quality by cross-document line frequency.

Lines are normalised (A-Z lower-cased, white space collapsed) and hashed to 64 bits. Per host the
distinct documents that hold a line are counted, exact copies of a text once. A line is frequent
above ``max(min_docs, share * texts of the host)``; it is removed from all documents of the host
but the first (smallest doc_id), so that a family of near copies never vanishes as a whole. A
document is rejected when removal leaves it depleted: fewer than ``min_words`` words or under
``min_left`` of them. Base checks reject short and repetitive texts.

Null and empty texts have no words and fail the base checks. A missing host is a host of its own.
Each row is a document of its own, also where ids are missing or repeat (the first of them in order of
id, missing ids last, then of a hash of the row).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feldspark.llm import arrays
from feldspark.llm.frames import NO_ID, fresh, per_row, real_id
from feldspark.session import materialize

MIN_DOCS = 20
SHARE = 0.02
MIN_WORDS = 10
MIN_LEFT = 0.3
WINDOW = 5
_SYMBOL = np.zeros(256, bool)
_SYMBOL[list(b"#*$%&|<>")] = True
STATS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
SCHEMA = "did long, host string, print long, " + ", ".join(f"{c} long" for c in STATS) + ", lines array<long>, line_words array<int>"


def _profile(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """Base figures of each text, and its lines with a word as (hash, words)."""
    for row, texts in arrays.batches(batch.column(2)):
        n = len(texts)
        _, data, lo, hi = arrays.joined(texts)
        starts, ends = arrays.word_bounds(data)
        first, last = np.searchsorted(starts, lo), np.searchsorted(starts, hi)
        n_words = last - first
        prefix = arrays.exact_prefix(data)
        # code points of words: bytes that begin a character
        heads = np.zeros(len(data) + 1, np.int64)
        np.cumsum((data & 0xC0) != 0x80, out=heads[1:])
        chars = np.append(0, np.cumsum(heads[ends] - heads[starts]))
        symbols = np.flatnonzero(_SYMBOL[data])

        # lines; the line feed after a text ends its last one
        line_ends = np.flatnonzero(data == 10)
        line_starts = np.append(0, line_ends[:-1] + 1)
        line_first, line_last = np.searchsorted(starts, line_starts), np.searchsorted(starts, line_ends)
        full = line_last > line_first
        line_starts, line_ends, line_first, line_last = (x[full] for x in (line_starts, line_ends, line_first, line_last))
        owner = np.searchsorted(lo, line_starts, side="right") - 1
        exact = arrays.exact_hash(prefix, line_starts, line_ends)
        distinct = np.unique(arrays.mix(exact + owner.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)), return_index=True)[1]
        lines = np.bincount(owner, minlength=n)
        n_dup = lines - np.bincount(owner[distinct], minlength=n)

        words = arrays.exact_hash(prefix, starts, ends)
        word_owner = np.repeat(np.arange(n), n_words)
        windows = arrays.window_hash(words, WINDOW)
        n_repeat = np.zeros(n, np.int64)
        if len(windows):
            whole = word_owner[: len(windows)] == word_owner[WINDOW - 1 :]
            at = np.flatnonzero(whole)
            key = arrays.mix(windows[at] + word_owner[at].astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
            twice = at[arrays.repeated(key)]
            hit = arrays.covered(len(words), twice, twice + WINDOW)
            n_repeat = np.bincount(word_owner[hit], minlength=n)

        low = arrays.exact_hash(arrays.exact_prefix(arrays.LOWER[data]), starts, ends)
        normal = arrays.exact_hash(arrays.exact_prefix(low), line_first, line_last).view(np.int64)
        offsets = pa.array(np.append(0, np.cumsum(lines)), pa.int32())
        columns = [
            n_words, chars[last] - chars[first], np.searchsorted(symbols, hi) - np.searchsorted(symbols, lo), n_dup, n_repeat,
        ]
        yield pa.RecordBatch.from_arrays(
            [
                batch.column(0).slice(row, n), batch.column(1).slice(row, n), pa.array(arrays.exact_hash(prefix, lo, hi).view(np.int64)),
                *(pa.array(np.asarray(c, np.int64)) for c in columns),
                pa.ListArray.from_arrays(offsets, pa.array(normal)),
                pa.ListArray.from_arrays(offsets, pa.array((line_last - line_first).astype(np.int32))),
            ],
            ["did", "host", "print", *STATS, "lines", "line_words"],
        )


def _map(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in source:
        if batch.num_rows:
            yield from _profile(batch)
        arrays.release()


def judge(docs: DataFrame, min_docs: int = MIN_DOCS, share: float = SHARE, min_words: int = MIN_WORDS, min_left: float = MIN_LEFT,
          id_col: str = "doc_id", text_col: str = "text", host_col: str = "source") -> DataFrame:
    """One row per row of ``docs``: doc_id, the base figures, base_failed, n_line_words (words of removed
    lines), removed_lines (their hashes), kept."""
    run = lambda rows, key: _judged(rows, min_docs, share, min_words, min_left, key, text_col, host_col)
    return per_row(docs, run, id_col)


def _judged(docs: DataFrame, min_docs: int, share: float, min_words: int, min_left: float, id_col: str, text_col: str, host_col: str) -> DataFrame:
    source = docs.select(
        F.coalesce(F.col(f"`{id_col}`").cast("long"), F.lit(NO_ID)).alias("did"),
        F.col(f"`{host_col}`").cast("string").alias("host"), F.col(f"`{text_col}`").cast("string").alias("text"),
    )
    profile = materialize(source.mapInArrow(_map, SCHEMA).withColumn("host", F.xxhash64("host")), "lines")
    hosts = profile.groupBy("host", "print").agg(F.lit(1)).groupBy("host").agg(F.count("*").alias("texts"))
    line = profile.select("host", "print", "did", F.explode(F.array_distinct("lines")).alias("line"))
    # the fingerprint is part of the first key, so a line that all share is spread and summed up in two steps
    held = line.groupBy("host", "line", "print").agg(F.min("did").alias("did")).groupBy("host", "line").agg(
        F.count("*").alias("docs"), F.min("did").alias("first")
    ).where(F.col("docs") > min_docs)
    limit = F.greatest(F.lit(float(min_docs)), F.lit(share) * F.col("texts"))
    frequent = held.join(hosts, "host").where(F.col("docs") > limit).select("host", "line", "first")
    gone = line.join(frequent, ["host", "line"]).where("did <> first").groupBy("did", "print").agg(F.collect_set("line").alias("gone"))
    judged = profile.join(gone, ["did", "print"], "left")
    gone_words = F.aggregate(
        F.zip_with("lines", "line_words", lambda h, w: F.when(F.array_contains("gone", h), w).otherwise(0).cast("long")),
        F.lit(0).cast("long"), lambda a, x: a + x,
    )
    removed = F.when(F.col("gone").isNull(), F.lit(0).cast("long")).otherwise(gone_words)
    base_failed = (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))
    left = F.col("n_words") - F.col("n_line_words")
    depleted = (F.col("n_line_words") > 0) & ((left < min_words) | (left < min_left * F.col("n_words")))
    return judged.withColumn("n_line_words", removed).select(
        real_id().alias("doc_id"), *STATS, base_failed.alias("base_failed"), "n_line_words",
        F.coalesce("gone", F.array().cast("array<long>")).alias("removed_lines"), (~base_failed & ~depleted).alias("kept"),
    )


def strip_lines(docs: DataFrame, verdicts: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """The kept rows of ``docs`` (a unique id, text and more) without their removed lines; n_chars follows the text."""

    def strip(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in source:
            at = batch.schema.get_field_index("text")
            texts = batch.column(at).to_pylist()
            for i, gone in enumerate(batch.column(batch.schema.get_field_index(removed)).to_pylist()):
                if gone and texts[i] is not None:
                    gone = set(gone)
                    lines = texts[i].split("\n")
                    texts[i] = "\n".join(x for x, h in zip(lines, line_hashes(lines)) if h not in gone)
            columns = dict(zip(batch.schema.names, batch.columns))
            columns["text"] = pa.array(texts, pa.string())
            if "n_chars" in columns:
                columns["n_chars"] = pa.array([None if t is None else len(t) for t in texts], columns["n_chars"].type)
            yield pa.RecordBatch.from_arrays([columns[c] for c in names], names)
            arrays.release()

    names = docs.columns
    judged, removed = fresh(docs, "judged_id"), fresh(docs, "removed_lines")
    some = verdicts.where("kept").select(F.col("doc_id").alias(judged), F.col("removed_lines").alias(removed)).dropDuplicates([judged])
    joined = docs.join(some, F.col(f"`{id_col}`").eqNullSafe(F.col(judged))).select(*(f"`{c}`" for c in names), removed)
    return joined.mapInArrow(strip, docs.schema)


def line_hashes(lines: list[str]) -> list[int | None]:
    """The hash of each normalised line; None for a line without a word."""
    out = []
    for text in lines:
        data = arrays.LOWER[np.frombuffer(text.encode() + b"\n", np.uint8)]
        starts, ends = arrays.word_bounds(data)
        if not len(starts):
            out.append(None)
            continue
        low = arrays.exact_hash(arrays.exact_prefix(data), starts, ends)
        whole = arrays.exact_hash(arrays.exact_prefix(low), np.array([0]), np.array([len(low)]))
        out.append(int(whole.view(np.int64)[0]))
    return out
