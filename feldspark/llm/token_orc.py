"""Token ids in ORC files, in order of doc_id.

Documents are range-partitioned and sorted by doc_id, so each file holds a range of ids and its
rows ascend. A row is (doc_id, part, at, n_tokens, ids): ``ids`` ends with the end id, ``at`` counts
the ids before it in its file, ``part`` is constant in a file. ORC stores integers run-length
encoded in stripes; row indexes and a Bloom filter on doc_id let a reader skip stripes and row
groups, and stripes are read in parallel. The ids before a file follow from the sums of
``n_tokens`` per part, one row per file.

Encoding: white space separates the pieces that the tokenizer merges within, and so does the place
between a Latin-1 letter and a full stop or comma; ids of a text are those of its pieces in order.
Each distinct piece is encoded once per worker by the tokenizers library and kept (up to
``CACHE`` pieces, then afresh). Upper-case ASCII letters are folded first where that is what the
tokenizer's normalizer does anyway. Pieces are told apart by hashes modulo 2**61 - 1.

A null text is empty and holds the end id only. Rows that repeat a doc_id are each stored, in order
of text; rows without a doc_id come first.
"""

from __future__ import annotations

import os
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from feldspark.llm import arrays
from feldspark.llm.bpe_tree import id_arrays
from feldspark.llm.frames import parts_for, text_bytes
from feldspark.session import materialize

END_ID = 2
FILE_BYTES = 64 << 20  # text bytes that one file should hold
STRIPE_BYTES = 16 << 20
CACHE = 1_000_000
TEXT_BYTES = 1 << 20  # texts whose pieces are looked up together; arrays of about 60 times this size stand beside them
BROADCAST_FILES = 1_000_000  # two numbers a file: up to 16 MB
_UPPER = np.zeros(256, bool)
_UPPER[65:91] = True
_LETTER = np.zeros(256, bool)
_LETTER[65:91] = _LETTER[97:123] = True
_STOP = np.zeros(256, bool)
_STOP[list(b".,")] = True


class Pieces:
    """Ids of distinct pieces, kept by hash."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        # folding early equals folding late only if the normalizer folds
        self.folds = self.tokenizer.encode("A", add_special_tokens=False).ids == self.tokenizer.encode("a", add_special_tokens=False).ids
        self.clear()

    def clear(self) -> None:
        self.keys, self.slot = np.zeros(0, np.uint64), np.zeros(0, np.int32)  # sorted hashes, and where their pieces stand
        self.start, self.size, self.flat, self.n, self.used = np.zeros(1024, np.int64), np.zeros(1024, np.int64), np.zeros(4096, np.int32), 0, 0

    @staticmethod
    def held(path: str) -> "Pieces":
        cache = arrays.worker_cache()
        key = f"pieces {path}"
        if key not in cache:
            cache[key] = Pieces(path)
        return cache[key]

    def _add(self, texts: list[str]) -> None:
        for i in range(0, len(texts), 4096):
            found = [e.ids for e in self.tokenizer.encode_batch_fast(texts[i : i + 4096], add_special_tokens=False)]
            sizes = np.fromiter(map(len, found), np.int64, len(found))
            flat = np.array([x for ids in found for x in ids], np.int32)
            while self.n + len(found) > len(self.start):
                self.start, self.size = np.append(self.start, np.zeros_like(self.start)), np.append(self.size, np.zeros_like(self.size))
            while self.used + len(flat) > len(self.flat):
                self.flat = np.append(self.flat, np.zeros_like(self.flat))
            self.start[self.n : self.n + len(found)] = self.used + np.cumsum(sizes) - sizes
            self.size[self.n : self.n + len(found)] = sizes
            self.flat[self.used : self.used + len(flat)] = flat
            self.n += len(found)
            self.used += len(flat)

    def encode(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the texts in a row, and how many each text has."""
        raw, data, lo, hi = arrays.joined(texts)
        if self.folds and b"<|" not in raw:
            # the names of special tokens are case-sensitive, and a letter may join a mark that follows it
            fold = _UPPER[data]
            fold[:-1] &= data[1:] < 0xC4
            data = np.where(fold, data + np.uint8(32), data)
            raw = data.tobytes()
        starts, ends = arrays.word_bounds(data)
        letter = _LETTER[data]
        # the letters of Latin-1: two bytes, of which the second alone tells them from signs
        letter[1:] |= (data[:-1] == 0xC3) & (data[1:] != 0x97) & (data[1:] != 0xB7)
        cut = np.flatnonzero(letter[:-1] & _STOP[data[1:]]) + 1
        starts, ends = np.sort(np.concatenate([starts, cut])), np.sort(np.concatenate([ends, cut]))
        keys, first, piece = np.unique(arrays.exact_hash(arrays.exact_prefix(data), starts, ends), return_index=True, return_inverse=True)
        if self.n + len(keys) > CACHE:
            self.clear()
        at = np.searchsorted(self.keys, keys)
        new = at == len(self.keys)
        new[~new] = self.keys[at[~new]] != keys[~new]
        fresh = np.flatnonzero(new)
        if len(fresh):
            a, b = starts[first[fresh]].tolist(), ends[first[fresh]].tolist()
            place = np.arange(self.n, self.n + len(fresh), dtype=np.int32)
            self._add([raw[i:j].decode("utf-8", "replace") for i, j in zip(a, b)])
            self.keys, self.slot = np.insert(self.keys, at[fresh], keys[fresh]), np.insert(self.slot, at[fresh], place)
            at = np.searchsorted(self.keys, keys)
        slot = self.slot[at][piece]
        size = self.size[slot]
        total = np.append(0, np.cumsum(size))
        ids = self.flat[np.repeat(self.start[slot] - total[:-1], size) + np.arange(total[-1])]
        return ids, total[np.searchsorted(starts, hi)] - total[np.searchsorted(starts, lo)]


def write_tokens(docs: DataFrame, path: str, tokenizer: str, end_id: int = END_ID, file_bytes: int = FILE_BYTES,
                 stripe_bytes: int = STRIPE_BYTES, id_col: str = "doc_id", text_col: str = "text") -> None:
    """Encode every text and write the ORC files to the new folder ``path``."""

    def run(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = Pieces.held(tokenizer)
        at = 0
        for batch in source:
            for row, texts in arrays.batches(batch.column(1), TEXT_BYTES):
                ids, sizes = pieces.encode(texts)
                ends = np.cumsum(sizes)
                ids = np.insert(ids, ends, end_id).astype(np.int32)
                offsets = np.append(0, ends + np.arange(1, len(texts) + 1))
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(row, len(texts)), pa.array(at + offsets[:-1]), pa.array(np.diff(offsets)),
                        pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(ids)),
                    ],
                    ["doc_id", "at", "n_tokens", "ids"],
                )
                at += int(offsets[-1])
            arrays.release()

    source = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{text_col}`").cast("string").alias("text"))
    parts = parts_for(docs.sparkSession, text_bytes(source), file_bytes)
    ordered = source.repartitionByRange(parts, "doc_id").sortWithinPartitions("doc_id", "text")
    tokens = ordered.mapInArrow(run, "doc_id long, at long, n_tokens long, ids array<int>")
    (
        tokens.select("doc_id", F.spark_partition_id().alias("part"), "at", "n_tokens", "ids")
        .write.option("orc.compress", "ZSTD").option("orc.stripe.size", str(stripe_bytes)).option("orc.create.index", "true")
        .option("orc.row.index.stride", "1000").option("orc.bloom.filter.columns", "doc_id").option("orc.bloom.filter.fpp", "0.01")
        .orc(path)
    )


def read_tokens(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, start (ids of all documents before it), n_tokens, ids."""
    rows = spark.read.schema("doc_id long, part int, at long, n_tokens long, ids array<int>").orc(path)
    sums = rows.groupBy("part").agg(F.sum("n_tokens").alias("n"))
    # one row per file
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    base = materialize(sums.select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base")), "starts")
    if base.count() <= BROADCAST_FILES:
        base = F.broadcast(base)
    return rows.join(base, "part").select("doc_id", (F.col("base") + F.col("at")).alias("start"), "n_tokens", "ids")


def lookup(spark: SparkSession, path: str, ids: list[int]) -> DataFrame:
    """The rows of a few documents; Bloom filters and indexes keep all other row groups unread."""
    return spark.read.schema("doc_id long, part int, at long, n_tokens long, ids array<int>").orc(path).where(F.col("doc_id").isin(ids))


def checksums(tokens: DataFrame) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 (of the ids as little-endian unsigned 32-bit integers)."""

    def run(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in source:
            sums = [zlib.crc32(x.astype("<u4").tobytes()) for x in id_arrays(batch.column(3))]
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(sums, pa.int64())], ["doc_id", "start", "n_tokens", "ids_crc32"])

    return tokens.mapInArrow(run, "doc_id long, start long, n_tokens long, ids_crc32 long")
