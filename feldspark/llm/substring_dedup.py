"""Repeated word windows, counted exactly in super-k-mer buckets.

Every window of ``size`` consecutive words belongs to one super-k-mer, a run of windows that
share a minimiser. The run travels as one packed string to the minimiser's bucket, where the
windows are sorted and equal neighbours, compared word for word, are counted. Each word covered
by a window that starts at two or more places is removed.

Null and empty texts have no words. Each row is a document of its own, also where ids are missing or
repeat. Other columns play no part.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feldspark.llm import arrays
from feldspark.llm.frames import fresh, id_and_text, map_batches, own_keys, per_row, real_id, text_bytes
from feldspark.llm.superkmers import Units, exchange, union_spans, with_spans

WINDOW = 35
GRAM = 4


def repeated_windows(texts: list[bytes], did, start, windows, shared, size: int) -> np.ndarray:
    """For every window of the strings, in order, whether its words stand at another place too."""
    raw = b"\n".join(texts) + b"\n"
    data = np.frombuffer(raw, np.uint8)
    low, high = arrays.word_bounds(data)
    owner = np.repeat(np.arange(len(texts)), windows)
    offset = np.arange(len(owner)) - np.repeat(np.cumsum(windows) - windows, windows)
    word = np.repeat(np.cumsum(windows + size - 1) - (windows + size - 1), windows) + offset
    a, b = low[word], high[word + size - 1]
    key = arrays.slice_hash(arrays.prefix_hash(data), a, b)
    order = np.argsort(key, kind="stable")
    same = key[order[1:]] == key[order[:-1]]
    out = np.zeros(len(owner), bool)
    place = np.stack([np.asarray(did)[owner], np.asarray(start)[owner] + offset], axis=1)
    first = np.flatnonzero(np.append(True, ~same))
    for i, j in zip(first.tolist(), np.append(first[1:], len(order)).tolist()):
        if j - i < 2:
            continue
        members = order[i:j]
        by_text: dict[bytes, list[int]] = {}
        for m in members.tolist():
            by_text.setdefault(raw[a[m] : b[m]], []).append(m)
        for same_words in by_text.values():
            if shared[owner[same_words]].any() or (place[same_words] != place[same_words[0]]).any():
                out[same_words] = True
    return out


def repeated_spans(docs: DataFrame, size: int = WINDOW, gram: int = GRAM, total: int | None = None) -> DataFrame:
    """(did, s, e): word ranges covered by windows that start at two or more places of ``docs`` (did, text)."""
    units = Units(size, gram, True)

    def reduce(texts, did, start, windows, shared):
        return repeated_windows(texts, did, start, windows, shared, size)

    return exchange(docs, units, True, reduce, 3.3, text_bytes(docs) if total is None else total)


def remove_repeats(docs: DataFrame, size: int = WINDOW, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: doc_id, n_words, n_removed, kept_sha256, text.

    ``text`` is the text without the removed words: white space before a kept word stays, so
    lines survive; a text that loses nothing is unchanged.
    """
    return per_row(docs, lambda rows, key: _removed(rows, size, key, text_col), id_col)


def _removed(docs: DataFrame, size: int, id_col: str, text_col: str) -> DataFrame:
    pairs = id_and_text(docs, id_col, text_col)
    joined = with_spans(pairs, repeated_spans(pairs, size))

    def cut(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        out: list[list] = [[], [], [], [], []]
        for did, packed, spans in zip(*(c.to_pylist() for c in batch.columns)):
            text, words, n = without(zstandard.decompress(packed), spans or ())
            row = (did, n, n - len(words), hashlib.sha256(b" ".join(words)).hexdigest(), text)
            for column, value in zip(out, row):
                column.append(value)
        kinds = (pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.binary())
        yield pa.RecordBatch.from_arrays(
            [pa.array(v, k) for v, k in zip(out, kinds)], ["did", "n_words", "n_removed", "kept_sha256", "text"]
        )

    done = map_batches(joined, cut, "did long, n_words long, n_removed long, kept_sha256 string, text binary")
    return done.select(real_id().alias("doc_id"), "n_words", "n_removed", "kept_sha256", F.col("text").cast("string").alias("text"))


def strip_repeats(docs: DataFrame, size: int = WINDOW, id_col: str = "doc_id") -> DataFrame:
    """All rows and columns of ``docs`` (doc_id, text and more) without the removed words; n_chars follows a changed text."""
    kept, (docs, id_col) = docs.columns, own_keys(docs, id_col)
    names, pairs = docs.columns, id_and_text(docs, id_col)
    own, other, found = (fresh(docs, c) for c in ("own_id", "span_id", "spans"))
    spans = repeated_spans(pairs, size).groupBy(F.col("did").alias(other)).agg(F.collect_list(F.struct("s", "e")).alias(found))
    joined = docs.withColumn(own, F.col(f"`{id_col}`").cast("long")).join(spans, F.col(own) == F.col(other), "left")

    def strip(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in source:
            at = batch.schema.get_field_index("text")
            texts = batch.column(at).to_pylist()
            chars = batch.column(batch.schema.get_field_index("n_chars")).to_pylist() if "n_chars" in names else None
            for i, spans in enumerate(batch.column(batch.schema.get_field_index(found)).to_pylist()):
                if spans and texts[i] is not None:
                    texts[i] = without(texts[i].encode(), spans)[0].decode("utf-8", "replace")
                    if chars:
                        chars[i] = len(texts[i])
            columns = dict(zip(batch.schema.names, batch.columns))
            columns["text"] = pa.array(texts, pa.string())
            if chars:
                columns["n_chars"] = pa.array(chars, columns["n_chars"].type)
            yield pa.RecordBatch.from_arrays([columns[c] for c in names], names)
            arrays.release()

    return joined.select(*(f"`{c}`" for c in names), found).mapInArrow(strip, docs.schema).select(*(f"`{c}`" for c in kept))


def without(text: bytes, spans: list) -> tuple[bytes, list[bytes], int]:
    """The text without the words in ``spans``, the words left, and how many there were."""
    low, high = arrays.word_bounds(np.frombuffer(text + b"\n", np.uint8))
    a, b = union_spans([(x["s"], x["e"]) for x in spans])
    kept = np.ones(len(low), bool)
    edges = np.append(low, len(text))
    pieces, at = [], 0
    for s, e in zip(a.tolist(), b.tolist()):
        kept[s:e] = False
        pieces.append(text[at : edges[s]])
        at = int(edges[e])
    pieces.append(text[at:])
    return b"".join(pieces), [text[i:j] for i, j in zip(low[kept].tolist(), high[kept].tolist())], len(low)
