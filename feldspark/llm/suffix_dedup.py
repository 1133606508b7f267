"""Repeated byte strings, found by suffix arrays sorted with bucket-pointer refinement.

Equal strings of ``size`` bytes share their minimiser, so the suffixes that can begin with such a
string meet in one bucket (see ``superkmers``). There the suffixes of the bucket's text are
sorted to depth ``size``: a first q-gram pass (q = 8 bytes) gives every suffix a bucket; then
each bucket that still holds two or more suffixes is refined by sorting on the bucket
identifiers of the suffixes q bytes further on. The refined identifiers are used again for the
next step, so the sorted depth doubles each time (8, 16, 32, 64, then 64 + 36 = 100); suffixes
alone in their bucket are settled and left out. Those left together at depth ``size`` start with
the same string. All of them but the first place (smallest doc_id, then start) are removed.

Null and empty texts have no bytes. Each row is a document of its own, also where ids are missing or
repeat; among those the order is that of a hash of the row, and rows without an id come last.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame

from feldspark.llm import arrays
from feldspark.llm.frames import id_and_text, map_batches, per_row, real_id, text_bytes
from feldspark.llm.superkmers import Units, exchange, union_spans, with_spans

WINDOW = 100
GRAM = 12
Q = 8


def refine(data: np.ndarray, at: np.ndarray, size: int) -> np.ndarray:
    """Bucket identifiers, at depth ``size``, of the suffixes at ``at``; equal exactly for equal strings.

    A bucket's identifier is where its suffixes begin in sorted order, so parts of a bucket get
    identifiers from its own range. ``data`` needs ``size`` bytes after each of ``at``. Only the suffixes that begin
    inside one of these strings take part: identifiers of all others are never looked at, or stand for no bucket.
    """
    n = len(data)
    tail = np.concatenate([data, np.zeros(Q, np.uint8)])
    word = np.zeros(n, np.uint64)
    depth = min(Q, size)
    for k in range(depth):
        word = (word << np.uint64(8)) | tail[k : n + k]
    # the first pass needs no order of its own: every suffix that is needed is in play
    some = np.flatnonzero(arrays.covered(n, at, at + max(size - depth, 0) + 1)) if len(at) < n else np.arange(n)
    word = word[some]
    order = np.argsort(word)
    bucket = np.full(n + 1, -1, np.int64)  # past the end, and where nothing is needed
    play = _part(bucket, some[order], word[order], np.zeros(len(some), np.int64))
    while depth < size and len(play):
        step = min(depth, size - depth)
        pair = bucket[play] * np.int64(n + 1) + bucket[np.minimum(play + step, n)] + 1
        order = np.argsort(pair)
        play = play[order]
        play = _part(bucket, play, pair[order], bucket[play])
        depth += step
    return bucket[at]


def _part(bucket: np.ndarray, play: np.ndarray, keys: np.ndarray, old: np.ndarray) -> np.ndarray:
    """Give the sorted suffixes in ``play`` their finer buckets; those that are not alone stay in play."""
    n = len(play)
    if not n:
        return play
    new = np.append(True, keys[1:] != keys[:-1])
    whole = np.append(True, old[1:] != old[:-1])
    head, first = np.flatnonzero(new), np.flatnonzero(whole)
    base = first[np.cumsum(whole)[head] - 1]
    size = np.diff(np.append(head, n))
    finer = old[head] + head - base
    bucket[play] = np.repeat(finer, size)
    return play[np.repeat(size > 1, size)]


def later_windows(texts: list[bytes], did, start, windows, size: int) -> np.ndarray:
    """For every window of the strings (given in order of place), whether its bytes start at an earlier place too."""
    data = np.frombuffer(b"".join(texts), np.uint8)
    owner = np.repeat(np.arange(len(texts)), windows)
    offset = np.arange(len(owner)) - np.repeat(np.cumsum(windows) - windows, windows)
    at = np.repeat(np.cumsum(windows + size - 1) - (windows + size - 1), windows) + offset
    out = np.zeros(len(owner), bool)
    # windows whose hash stands alone have no equal; all others are told apart by their bytes
    twice = np.flatnonzero(arrays.repeated(arrays.window_hash(data, size)[at]))
    if not len(twice):
        return out
    bucket = refine(data, at[twice], size)
    doc, place = np.asarray(did)[owner[twice]], np.asarray(start)[owner[twice]] + offset[twice]
    order = np.argsort(bucket, kind="stable")  # windows come in order of place
    head = np.append(True, bucket[order[1:]] != bucket[order[:-1]])
    first = order[np.flatnonzero(head)[np.cumsum(head) - 1]]
    out[twice[order]] = (doc[order] != doc[first]) | (place[order] != place[first])
    return out


def repeated_spans(docs: DataFrame, size: int = WINDOW, gram: int = GRAM, total: int | None = None) -> DataFrame:
    """(did, s, e): byte ranges covered by strings that also start earlier in ``docs`` (did, text)."""
    units = Units(size, gram, False)

    def reduce(texts, did, start, windows, shared):
        return later_windows(texts, did, start, windows, size)

    return exchange(docs, units, False, reduce, 3.4, text_bytes(docs) if total is None else total)


def remove_repeats(docs: DataFrame, size: int = WINDOW, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: doc_id, n_bytes, n_removed, n_spans, kept_sha256, kept (the bytes left)."""
    return per_row(docs, lambda rows, key: _removed(rows, size, key, text_col), id_col)


def _removed(docs: DataFrame, size: int, id_col: str, text_col: str) -> DataFrame:
    pairs = id_and_text(docs, id_col, text_col)
    joined = with_spans(pairs, repeated_spans(pairs, size))

    def cut(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        out: list[list] = [[], [], [], [], [], []]
        for did, packed, spans in zip(*(c.to_pylist() for c in batch.columns)):
            text = zstandard.decompress(packed)
            a, b = union_spans([(x["s"], x["e"]) for x in spans or ()])
            pieces, at = [], 0
            for s, e in zip(a.tolist(), b.tolist()):
                pieces.append(text[at:s])
                at = e
            pieces.append(text[at:])
            kept = b"".join(pieces)
            row = (did, len(text), len(text) - len(kept), len(a), hashlib.sha256(kept).hexdigest(), kept)
            for column, value in zip(out, row):
                column.append(value)
        kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.binary())
        names = ["did", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"]
        yield pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(out, kinds)], names)

    schema = "did long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary"
    return map_batches(joined, cut, schema).select(
        real_id().alias("doc_id"), "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"
    )
