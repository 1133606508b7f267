"""Byte-level BPE as a reduction tree over each text.

A text is halved until pieces are at most ``leaf`` characters; pieces are encoded on their own
and neighbours are joined. At a seam the matches of the split pattern may change, so a window is
encoded again: it begins at the last match of the left part whose end lies two or more characters
before the seam (the pattern never looks further ahead, so all before is settled) and grows to
the right until one of its own settled matches ends where a match of the right part ends. From a
shared match end on both scans are the same, as the pattern never looks back; tokens outside the
window therefore stay. The join is associative, so the tree's shape does not matter, and its
result is that of encoding each match of the whole text on its own. Decoding concatenates the
bytes of halves of the ids.

Null and empty texts have no tokens. Invalid UTF-8 is replaced before encoding. Rows that repeat a
doc_id are each encoded and returned; a missing doc_id stays missing.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feldspark.llm import arrays
from feldspark.llm.frames import map_batches

LEAF = 16_384
AHEAD = 2  # characters past its end on which a match may depend


class Codec:
    """The rank file with its split pattern; one per Python worker."""

    def __init__(self, path: str, pattern: str):
        import regex
        import tiktoken

        with open(path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}
        self.encoding = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        self.pattern = regex.compile(pattern)
        size = max(ranks.values()) + 1
        self.length = np.zeros(size, np.int64)
        digits = [b""] * size
        for token, i in ranks.items():
            self.length[i] = len(token)
            digits[i] = b"%d " % i
        width = max(map(len, digits))
        self.digits = np.frombuffer(b"".join(d.ljust(width) for d in digits), np.uint8).reshape(size, width)
        self.used = np.arange(width) < np.fromiter(map(len, digits), np.int64, size)[:, None]

    @staticmethod
    def held(path: str, pattern: str) -> "Codec":
        cache = arrays.worker_cache()
        key = f"codec {path} {pattern}"
        if key not in cache:
            cache[key] = Codec(path, pattern)
        return cache[key]

    def piece(self, text: str) -> np.ndarray:
        return np.asarray(self.encoding.encode_to_numpy(text, disallowed_special=()), np.uint32)

    def encode(self, text: str, leaf: int = LEAF) -> np.ndarray:
        if leaf < 1:
            raise ValueError("leaf must be at least one character")
        if len(text) <= leaf:
            return self.piece(text)
        return self._node(text, 0, len(text), leaf)[0]

    def _node(self, text: str, lo: int, hi: int, leaf: int) -> tuple[np.ndarray, int]:
        """Ids of text[lo:hi] and its last match end (or ``lo``) that what follows cannot change."""
        if hi - lo <= leaf:
            settled = lo
            for end in self._match_ends(text, lo, hi):
                if end > hi - AHEAD:
                    break
                settled = end
            return self.piece(text[lo:hi]), settled
        seam = (lo + hi) // 2
        left, right = self._node(text, lo, seam, leaf), self._node(text, seam, hi, leaf)
        return self._join(text, left, right, seam, hi)

    def _match_ends(self, text: str, lo: int, hi: int) -> Iterator[int]:
        """Where the matches of text[lo:hi] on its own end; a slice, as lookahead must not see past it."""
        return (lo + m.end() for m in self.pattern.finditer(text[lo:hi]))

    def _join(self, text: str, left: tuple, right: tuple, seam: int, hi: int) -> tuple[np.ndarray, int]:
        (a, begin), (b, settled) = left, right
        size = 64
        while True:
            end = min(seam + size, hi)
            mine = list(self._match_ends(text, begin, end))
            if end < hi:
                mine = [x for x in mine if x <= end - AHEAD]
            reach = mine[-1] if mine else begin
            theirs = {seam}
            for x in self._match_ends(text, seam, hi):
                if x > reach:
                    break
                theirs.add(x)
            shared = [x for x in mine if x in theirs]
            if shared or end == hi:
                stop = shared[0] if shared else hi
                break
            size *= 2
        # match by match: cut off at its end, a run of white space would be one match
        edges = [begin, *(x for x in mine if x <= stop)]
        window = [self.piece(text[i:j]) for i, j in zip(edges, edges[1:])]
        ids = np.concatenate([self._before(a, len(text[begin:seam].encode())), *window, self._after(b, len(text[seam:stop].encode()))])
        if settled < stop or settled > hi - AHEAD:
            settled = max([begin, *(x for x in mine if x <= min(stop, hi - AHEAD))])
        return ids, settled

    def _before(self, ids: np.ndarray, cut: int) -> np.ndarray:
        """All but the last tokens, which hold ``cut`` bytes."""
        n, step = len(ids), 64
        while cut:
            held = np.cumsum(self.length[ids[max(0, n - step) :]][::-1])
            if held[-1] >= cut:
                return ids[: n - int(np.searchsorted(held, cut)) - 1]
            step *= 4
        return ids

    def _after(self, ids: np.ndarray, cut: int) -> np.ndarray:
        step = 64
        while cut:
            held = np.cumsum(self.length[ids[:step]])
            if held[-1] >= cut:
                return ids[int(np.searchsorted(held, cut)) + 1 :]
            step *= 4
        return ids

    def decode(self, ids: np.ndarray, leaf: int = LEAF) -> bytes:
        if len(ids) <= leaf:
            return self.encoding.decode_bytes(ids.tolist())
        half = len(ids) // 2
        return self.decode(ids[:half], leaf) + self.decode(ids[half:], leaf)

    def decimal(self, ids: np.ndarray) -> bytes:
        """The ids in decimal with one space between."""
        return self.digits[ids][self.used[ids]].tobytes()[:-1]


def encode(docs: DataFrame, path: str, pattern: str, leaf: int = LEAF, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, ids: one row per row of ``docs``."""

    def run(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        codec = Codec.held(path, pattern)
        for row, texts in arrays.batches(batch.column(1)):
            ids = [codec.encode(t.decode("utf-8", "replace"), leaf) for t in texts]
            offsets = np.cumsum([0, *map(len, ids)])
            flat = np.concatenate([np.zeros(0, np.uint32), *ids]).astype(np.int32)
            lists = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(flat))
            yield pa.RecordBatch.from_arrays([batch.column(0).slice(row, len(texts)), lists], ["doc_id", "ids"])

    source = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{text_col}`").cast("string").alias("text"))
    return map_batches(source, run, "doc_id long, ids array<int>")


def decode(tokens: DataFrame, path: str, pattern: str) -> DataFrame:
    """doc_id, ids, data: the bytes that the ids of each row stand for."""

    def run(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        codec = Codec.held(path, pattern)
        data = [codec.decode(ids) for ids in id_arrays(batch.column(1))]
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(data, pa.binary())], ["doc_id", "ids", "data"])

    return map_batches(tokens.select("doc_id", "ids"), run, "doc_id long, ids array<int>, data binary")


def digests(tokens: DataFrame, path: str, pattern: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 of encoded rows; texts are decoded and not kept."""

    def run(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        codec = Codec.held(path, pattern)
        ids = id_arrays(batch.column(1))
        sums = [hashlib.sha256(codec.decimal(x)).hexdigest() for x in ids]
        back = [hashlib.sha256(codec.decode(x)).hexdigest() for x in ids]
        n = pa.array([len(x) for x in ids], pa.int64())
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), n, pa.array(sums, pa.string()), pa.array(back, pa.string())], ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
        )

    return map_batches(tokens.select("doc_id", "ids"), run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")


def id_arrays(column: pa.Array) -> list[np.ndarray]:
    """The lists of a column of ids; a null list is empty."""
    flat = np.asarray(column.flatten())
    ends = np.cumsum(np.nan_to_num(np.asarray(column.value_lengths().fill_null(0)), nan=0).astype(np.int64))
    return [flat[a:b] for a, b in zip(np.append(0, ends[:-1]).tolist(), ends.tolist())]
