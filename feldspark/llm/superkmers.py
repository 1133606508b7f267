"""Super-k-mers: runs of consecutive windows that share one minimiser occurrence.

A window is ``size`` consecutive units (words or bytes) of one text. Its minimiser is the
smallest hash among its grams of ``gram`` units, so equal windows have equal minimisers and
meet in the same bucket, wherever they stand. Consecutive windows around one occurrence of a
minimiser travel as one packed string: ``windows + size - 1`` units instead of
``windows * size``. A run never holds the same window twice.

Heavy buckets: a first pass adds up the bytes of every bucket. A bucket beyond the target is
parted further by two more minimisers under other orders, again functions of the window
alone. Runs with the same string in one task are merged there before they travel, so a passage
that a third of all texts share costs a bucket one string per task.

Rows between the passes are blobs, one per task chunk and bucket, zstd-compressed.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feldspark.llm import arrays
from feldspark.llm.frames import map_batches, parts_for

BUCKET_BYTES = 12 << 20  # packed bytes that one group of the second stage should hold
HEAVY = 3  # a bucket is parted further beyond so many times its share
CHUNK_BYTES = 12 << 20  # texts of a task that are packed together
LEVEL = 3  # of zstd
_LOW = np.uint64((1 << 28) - 1)  # position part of a minimiser key
BLOB = "bucket long, kind int, blob binary"
SPANS = "did long, s int, e int"


@dataclass(frozen=True)
class Units:
    """How a text is cut into windows."""

    size: int
    gram: int
    words: bool  # units are words, else bytes


@dataclass
class Runs:
    """Runs of windows of one batch: owner, first unit, windows, and the slice of the packed text."""

    text: bytes
    did: np.ndarray
    start: np.ndarray
    windows: np.ndarray
    low: np.ndarray
    high: np.ndarray
    route: np.ndarray
    value: np.ndarray


def find_runs(dids: np.ndarray, texts: list[bytes], units: Units, buckets: int, split: dict[int, int]) -> Runs | None:
    raw, data, lo, hi = arrays.joined(texts)
    if units.words:
        starts, ends = arrays.word_bounds(data)
        values = arrays.slice_hash(arrays.prefix_hash(data), starts, ends)
        first, last = np.searchsorted(starts, lo), np.searchsorted(starts, hi)
    else:
        values, first, last = data, lo, hi
    n, width = len(values), units.size - units.gram + 1
    if n < units.size:
        return None
    grams = arrays.window_hash(values, units.gram)
    place = np.arange(len(grams), dtype=np.uint64) & _LOW
    least = arrays.sliding_min((grams & ~_LOW) | place, width)
    at = np.arange(len(least))
    # the occurrence each window leans on; the low bits of a key are its place
    seat = at + ((least - at.astype(np.uint64)) & _LOW).astype(np.int64)
    step = np.zeros(n + 1, np.int32)
    long_enough = last - first >= units.size
    np.add.at(step, first[long_enough], 1)
    np.add.at(step, last[long_enough] - units.size + 1, -1)
    valid = np.cumsum(step[: len(least)]) > 0
    if not valid.any():
        return None
    new = valid.copy()
    new[1:] &= ~valid[:-1] | (seat[1:] != seat[:-1])
    start = np.flatnonzero(new)
    # windows of a run have one value, and one route unless their bucket is heavy
    value = arrays.mix(grams[seat[start]] ^ np.uint64(0x5851F42D4C957F2D))
    route = (value % np.uint64(buckets)).astype(np.int64)
    known = np.array(sorted(split), np.int64)
    place = np.minimum(np.searchsorted(known, route), max(len(known) - 1, 0))
    heavy = known[place] == route if len(known) else np.zeros(len(route), bool)
    if heavy.any():
        parts = np.where(heavy, np.array([split[k] for k in known.tolist()], np.int64)[place], 1)
        other = [arrays.sliding_min(arrays.mix(grams * np.uint64(k)), width) for k in (0x2545F491, 0x9E3779B1)]
        run = np.cumsum(new) - 1
        run[run < 0] = 0  # before the first window, where nothing is valid
        sub = (arrays.mix(other[0] ^ (other[1] << np.uint64(1))) % parts[run].astype(np.uint64)).astype(np.int64)
        each = route[run] + buckets * sub
        new[1:] |= valid[1:] & valid[:-1] & (each[1:] != each[:-1])
        start = np.flatnonzero(new)
        value, route = value[run[start]], each[start]
    stop = np.flatnonzero(valid & np.append(new[1:] | ~valid[1:], True)) + 1
    windows = stop - start
    if units.words:
        # one space between words: a word byte, or the first byte after a word
        inside = arrays.SPACE[data]
        keep = inside.copy()
        keep[1:] |= inside[:-1]
        packed = np.where(inside, data, np.uint8(32))[keep]
        size = np.cumsum(np.append(0, ends - starts + 1))
        text, low, high = packed.tobytes(), size[start], size[start + windows + units.size - 1] - 1
    else:
        text, low, high = raw, start, start + windows + units.size - 1
    owner = np.searchsorted(first, start, side="right") - 1
    return Runs(text, dids[owner], start - first[owner], windows, low, high, route, value)


def measure(docs: DataFrame, units: Units, buckets: int, share: float) -> dict[int, int]:
    """How many parts each bucket needs that holds far more than its ``share`` of the packed bytes of all texts."""

    def weigh(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        dids = np.asarray(batch.column(0))
        for row, texts in arrays.batches(batch.column(1)):
            runs = find_runs(dids[row : row + len(texts)], texts, units, buckets, {})
            if runs:
                some, at = np.unique(runs.route, return_inverse=True)
                total = np.bincount(at, runs.high - runs.low, len(some)).astype(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(total)], ["bucket", "size"])

    sizes = map_batches(docs, weigh, "bucket long, size long").groupBy("bucket").agg(F.sum("size").alias("size"))
    target = max(BUCKET_BYTES, share)
    # at most buckets / HEAVY rows come back
    heavy = sizes.where(F.col("size") > HEAVY * target).collect()
    return {r["bucket"]: int(r["size"] // target) + 1 for r in heavy}


def _pack(runs: Runs, rows: np.ndarray) -> bytes:
    """Runs as one compressed string: what differs little from row to row as differences, then the texts."""
    low, high = runs.low[rows], runs.high[rows]
    text = b"".join([runs.text[a:b] for a, b in zip(low.tolist(), high.tolist())])
    did = runs.did[rows].astype(np.int64)
    head = [
        np.array([len(rows), did[0]], np.int64), np.diff(did), runs.start[rows].astype(np.int64), (high - low).astype(np.int64),
        runs.windows[rows].astype(np.int32), (runs.value[rows] >> np.uint64(32)).astype(np.uint32),
    ]
    # bytes of equal weight stand together
    planes = [np.ascontiguousarray(x.view(np.uint8).reshape(-1, x.itemsize).T) for x in head[1:]]
    return zstandard.compress(b"".join(x.tobytes() for x in [head[0], *planes]) + text, LEVEL)


def _unpack(blob: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray, bytes]:
    """did, start, bytes of text, short minimiser, windows, and the texts in a row."""
    data = zstandard.decompress(blob)
    n, first = np.frombuffer(data, np.int64, 2).tolist()
    at = 16
    out = []
    for kind, many in ((np.int64, n - 1), (np.int64, n), (np.int64, n), (np.int32, n), (np.uint32, n)):
        wide = np.dtype(kind).itemsize
        planes = np.frombuffer(data, np.uint8, many * wide, at).reshape(wide, many)
        out.append(np.ascontiguousarray(planes.T).view(kind).ravel())
        at += many * wide
    step, start, size, windows, value = out
    return np.cumsum(np.append(first, step)), start, size, value, windows, data[at:]


def same_text(texts: list[bytes], value: np.ndarray, did: np.ndarray, start: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each run the first place (smallest id, then start) of its very string, and whether that string has other places."""
    order = np.lexsort((start, did, value))
    first = np.arange(len(texts))
    seen: dict[bytes, int] = {}
    again = repeated_values(value)
    for i in order[again[order]].tolist():
        first[i] = seen.setdefault(texts[i], i)
    other = (did != did[first]) | (start != start[first])
    shared = np.zeros(len(texts), bool)
    shared[first[other]] = True
    return first, shared[first]


def repeated_values(value: np.ndarray) -> np.ndarray:
    return arrays.repeated(value)


def exchange(docs: DataFrame, units: Units, every_place: bool, reduce: Callable, packed_per_byte: float, size: int) -> DataFrame:
    """Spans (did, s, e) of repeated windows over ``docs`` (did, text); e is past the last unit covered.

    ``reduce(texts, did, start, windows, shared)`` gets the distinct strings of a bucket whose
    minimiser stands in two or more of them, and returns for each a mask of its repeated windows.
    ``every_place``: all places of a repeated window count, else all but the first.
    """
    spark = docs.sparkSession
    buckets = parts_for(spark, size * packed_per_byte, BUCKET_BYTES)
    split = measure(docs, units, buckets, size * packed_per_byte / buckets)
    routes = buckets * max([1, *split.values()])

    def pack(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in source:
            dids = np.asarray(batch.column(0))
            for row, texts in arrays.batches(batch.column(1), CHUNK_BYTES):
                yield from _packed(dids[row : row + len(texts)], texts)
            arrays.release()

    def _packed(dids: np.ndarray, texts: list[bytes]) -> Iterator[pa.RecordBatch]:
        parts = []
        at = 0
        for few in _few(texts):
            runs = find_runs(dids[at : at + len(few)], few, units, buckets, split)
            at += len(few)
            if runs:
                parts.append(runs)
        if not parts:
            return
        shift = np.cumsum([0] + [len(r.text) for r in parts])
        runs = Runs(
            b"".join(r.text for r in parts), *(np.concatenate([getattr(r, k) for r in parts]) for k in ("did", "start", "windows")),
            np.concatenate([r.low + s for r, s in zip(parts, shift)]), np.concatenate([r.high + s for r, s in zip(parts, shift)]),
            *(np.concatenate([getattr(r, k) for r in parts]) for k in ("route", "value")),
        )
        # merge equal strings of this chunk
        again = np.flatnonzero(arrays.repeated(runs.value))
        text = [runs.text[a:b] for a, b in zip(runs.low[again].tolist(), runs.high[again].tolist())]
        first, shared = same_text(text, runs.value[again], runs.did[again], runs.start[again])
        gone = first != np.arange(len(again))
        done = shared if every_place else (runs.did[again] != runs.did[again][first]) | (runs.start[again] != runs.start[again][first])
        spans = again[done]
        keep = np.ones(len(runs.did), bool)
        keep[again[gone]] = False
        multi = np.zeros(len(runs.did), bool)
        multi[again[shared]] = every_place
        # a string with several places is told apart by the sign of its window count
        runs.windows = np.where(multi, -runs.windows, runs.windows)
        rows = np.flatnonzero(keep)
        rows = rows[np.argsort(runs.route[rows], kind="stable")]
        cut = np.flatnonzero(np.diff(runs.route[rows])) + 1
        groups = np.split(rows, cut)
        bucket, kind, blobs = [int(runs.route[g[0]]) for g in groups], [0] * len(groups), [_pack(runs, g) for g in groups]
        if len(spans):
            owner = runs.did[spans].astype(np.int64)
            lane = (arrays.mix(owner.view(np.uint64)) % np.uint64(buckets)).astype(np.int64)
            windows = np.abs(runs.windows[spans])
            s, e = runs.start[spans], runs.start[spans] + windows + units.size - 1
            order = np.argsort(lane, kind="stable")
            for g in np.split(order, np.flatnonzero(np.diff(lane[order])) + 1):
                bucket.append(routes + int(lane[g[0]]))
                kind.append(1)
                blobs.append(b"".join(x.astype(np.int64).tobytes() for x in (owner[g], s[g], e[g])))
        for i in range(0, len(bucket), 256):
            j = slice(i, i + 256)
            yield pa.RecordBatch.from_arrays(
                [pa.array(bucket[j], pa.int64()), pa.array(kind[j], pa.int32()), pa.array(blobs[j], pa.binary())], ["bucket", "kind", "blob"]
            )

    def settle(group: pa.Table) -> pa.Table:
        out = []
        kinds, blobs = group.column("kind").to_pylist(), group.column("blob").to_pylist()
        for k, b in zip(kinds, blobs):
            if k:
                out.append(np.frombuffer(b, np.int64).reshape(3, -1))
        packs = [_unpack(b) for k, b in zip(kinds, blobs) if not k]
        if packs:
            out.append(_settle(packs))
        did, s, e = np.concatenate(out, axis=1)
        return pa.table([pa.array(did), pa.array(s.astype(np.int32)), pa.array(e.astype(np.int32))], ["did", "s", "e"])

    def _settle(packs: list) -> np.ndarray:
        value = np.concatenate([p[3] for p in packs])
        pick = arrays.repeated(value)
        texts, at = [], 0
        for p in packs:
            ends = np.cumsum(p[2])
            mine = np.flatnonzero(pick[at : at + len(ends)])
            texts += [p[5][b - n : b] for b, n in zip(ends[mine].tolist(), p[2][mine].tolist())]
            at += len(ends)
        if not texts:
            return np.zeros((3, 0), np.int64)
        did, start, windows = (np.concatenate([p[i] for p in packs])[pick] for i in (0, 1, 4))
        value, told = value[pick], windows < 0
        windows = np.abs(windows).astype(np.int64)
        first, shared = same_text(texts, value, did, start)
        if every_place:
            known = np.zeros(len(texts), bool)
            np.logical_or.at(known, first, told)
            shared |= known[first]
            whole = shared & ~told
        else:
            whole = (did != did[first]) | (start != start[first])
        spans = [np.stack([did[whole], start[whole], start[whole] + windows[whole] + units.size - 1])]
        rep = np.flatnonzero(first == np.arange(len(texts)))
        rep = rep[arrays.repeated(value[rep])]
        if len(rep):
            rep = rep[np.lexsort((start[rep], did[rep]))]
            marked = reduce([texts[i] for i in rep.tolist()], did[rep], start[rep], windows[rep], shared[rep])
            owner = np.repeat(np.arange(len(rep)), windows[rep])
            offset = np.arange(len(owner)) - np.repeat(np.cumsum(windows[rep]) - windows[rep], windows[rep])
            if every_place:
                marked &= ~shared[rep][owner]
            edge = marked.copy()
            edge[1:] &= ~(marked[:-1] & (owner[1:] == owner[:-1]))
            stop = marked.copy()
            stop[:-1] &= ~(marked[1:] & (owner[1:] == owner[:-1]))
            a, b = np.flatnonzero(edge), np.flatnonzero(stop)
            base = rep[owner[a]]
            spans.append(np.stack([did[base], start[base] + offset[a], start[base] + offset[b] + units.size]))
        return np.concatenate(spans, axis=1)

    blobs = docs.mapInArrow(pack, BLOB)
    return blobs.groupBy("bucket").applyInArrow(settle, SPANS)


def _few(texts: list[bytes]) -> Iterator[list[bytes]]:
    first, size = 0, 0
    for i, text in enumerate(texts):
        if size and size + len(text) > arrays.BATCH_BYTES:
            yield texts[first:i]
            first, size = i, 0
        size += len(text) + 1
    if first < len(texts):
        yield texts[first:]


def union_spans(spans: list[tuple[int, int]] | None) -> tuple[np.ndarray, np.ndarray]:
    """Disjoint, sorted spans that cover the same units; spans that touch are one."""
    if not spans:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    at = np.array(sorted(spans), np.int64).reshape(-1, 2)
    reach = np.maximum.accumulate(at[:, 1])
    new = np.append(True, at[1:, 0] > reach[:-1])
    first = np.flatnonzero(new)
    return at[first, 0], reach[np.append(first[1:], len(at)) - 1]


def with_spans(docs: DataFrame, spans: DataFrame) -> DataFrame:
    """(did, packed, spans) for every row of ``docs``; texts travel zstd-compressed."""

    def shrink(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        tool = zstandard.ZstdCompressor(3)
        for row, texts in arrays.batches(batch.column(1)):
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).slice(row, len(texts)), pa.array([tool.compress(t) for t in texts], pa.binary())], ["did", "packed"]
            )

    listed = spans.groupBy("did").agg(F.collect_list(F.struct("s", "e")).alias("spans"))
    return map_batches(docs, shrink, "did long, packed binary").join(listed, "did", "left")
