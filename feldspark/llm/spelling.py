"""Spelling variants: words one edit apart, found by probing Bloom filters with generated edits.

The vocabulary is counted in Spark. A filter per word length is built in tasks (blocks of 64 bytes; a key sets
three bits in each of two longs of its block) and broadcast; each word generates its shorter neighbours (one
code point deleted) and its later neighbours of the same length (one code point replaced by a greater one) and
probes them. Every pair of near words is generated from one side. Only positives become strings, shuffle, and
meet the vocabulary in an exact join, so false positives end there. A word has at most a few neighbours per code
point, so no group grows with the table.

Filters are sent in passes of at most ``FILTER_BYTES``: short vocabularies take one pass; the filter of a length
that alone is larger is cut by key hash into pieces, each probed in its own pass, with the same result.

Forms point from rare to frequent (ten times at least), so chains are short; their ends are found by doubling.

Defined results: null and empty texts have no words; a missing id counts as an empty string before the colon.
Repeated rows count as often as they stand there. Of several near words of equal count the smallest is the form.
An empty table gives no rows. Other columns play no part.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feldspark.llm import arrays
from feldspark.llm.frames import map_batches, parts_for
from feldspark.session import materialize

LEAST_LENGTH = 7
LEAST_COUNT = 2
DELETE_ONE_IN = 31
RATIO = 10
BITS = 16  # of filter per word
BLOCK = 8  # longs
CHUNK_BLOCKS = 4096  # blocks built by one group of a shuffle
FILTER_BYTES = 64 << 20  # sent in one pass
PROBES = 1 << 18  # edits looked up at a time
_BASE = np.uint64(0x9E3779B97F4A7C55)
_UNDO = np.uint64(pow(int(_BASE), -1, 1 << 64))


def vocabulary(docs: DataFrame, least_length: int = LEAST_LENGTH, least_count: int = LEAST_COUNT, one_in: int = DELETE_ONE_IN,
               id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(word, n): the words of whole texts, one in ``one_in`` occurrences with a code point deleted by hash."""
    upper, lower = "".join(map(chr, range(65, 91))), "".join(map(chr, range(97, 123)))
    text = F.translate(F.col(f"`{text_col}`").cast("string"), upper, lower)
    runs = F.regexp_extract_all(text, F.lit(f"[a-zÀ-ÿ]{{{least_length},}}"), F.lit(0))
    own = F.concat(F.coalesce(F.col(f"`{id_col}`").cast("string"), F.lit("")), F.lit(":"))
    each = docs.select(own.alias("own"), F.explode(runs).alias("run")).withColumn("h", F.crc32(F.concat("own", "run")))
    at = (F.col("h") % F.length("run")).cast("int")
    cut = F.concat(F.substring(F.col("run"), F.lit(1), at), F.substring(F.col("run"), at + 2, F.length("run")))
    each = each.select(F.when(F.col("h") % one_in == 0, cut).otherwise(F.col("run")).alias("word"))
    return each.where(F.length("word") >= least_length).groupBy("word").agg(F.count("*").alias("n")).where(F.col("n") >= least_count)


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    up, down = np.full(n, _BASE), np.full(n, _UNDO)
    up[0] = down[0] = 1
    return np.multiply.accumulate(up), np.multiply.accumulate(down)


def by_length(words: list[str]) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(length, which words, their code points as a matrix) for each length."""
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    for size in np.unique(lengths).tolist():
        which = np.flatnonzero(lengths == size)
        step = max(1, (1 << 20) // size)
        for a in range(0, len(which), step):
            part = which[a : a + step]
            codes = np.frombuffer("".join(words[i] for i in part.tolist()).encode("utf-32-le"), np.uint32)
            yield size, part, codes.reshape(len(part), size)


def _terms(codes: np.ndarray) -> np.ndarray:
    return (codes.astype(np.uint64) + np.uint64(1)) * _powers(codes.shape[1])[0]


def _spots(keys: np.ndarray, blocks: int) -> tuple[np.ndarray, np.ndarray]:
    """Block of each key and the mixed key that picks the bits in it."""
    h = arrays.mix(keys)
    return ((h >> np.uint64(32)) * np.uint64(blocks)) >> np.uint64(32), h


def _words_of(block: np.ndarray, h: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Two different longs of the block and the bits that a key sets in them."""
    one, six, three = np.uint64(1), np.uint64(63), np.uint64(7)
    first = h & three
    second = (first + one + ((h >> np.uint64(3)) & three) % three) & three
    bits = lambda s: (one << ((h >> np.uint64(s)) & six)) | (one << ((h >> np.uint64(s + 6)) & six))
    last = lambda s: one << ((arrays.mix(h + np.uint64(s)) >> np.uint64(20)) & six)
    base = block * np.uint64(BLOCK)
    return (base + first).astype(np.int64), bits(6) | last(1), (base + second).astype(np.int64), bits(18) | last(2)


class Filters:
    """Blocked Bloom filters by (word length, piece); ``pieces`` says into how many a length is cut."""

    def __init__(self, held: dict[tuple[int, int], np.ndarray], pieces: dict[int, int]):
        self.held, self.pieces = held, pieces
        self.of: dict[int, list[int]] = {}
        for size, piece in held:
            self.of.setdefault(size, []).append(piece)

    def has(self, size: int, keys: np.ndarray) -> np.ndarray:
        """Positions of the keys that may be words of this length, in the pieces held."""
        out = []
        for piece in self.of.get(size, ()):
            mine, at = keys, None
            if self.pieces[size] > 1:
                at = np.flatnonzero(piece_of(keys, self.pieces[size]) == piece)
                mine = keys[at]
            bits = self.held[size, piece]
            block, h = _spots(mine, len(bits) // BLOCK)
            # most keys fail by their first two bits; the rest is looked at in full
            one, six = np.uint64(1), np.uint64(63)
            word = bits[(block * np.uint64(BLOCK) + (h & np.uint64(7))).astype(np.int64)]
            ok = np.flatnonzero((word >> ((h >> np.uint64(6)) & six)) & (word >> ((h >> np.uint64(12)) & six)) & one)
            i, m, j, k = _words_of(block[ok], h[ok])
            ok = ok[((bits[i] & m) == m) & ((bits[j] & k) == k)]
            out.append(ok if at is None else at[ok])
        return np.concatenate(out) if out else np.zeros(0, np.int64)


def piece_of(keys: np.ndarray, pieces: int) -> np.ndarray:
    return (arrays.mix(keys ^ np.uint64(0x5851F42D4C957F2D)) >> np.uint64(32)) * np.uint64(pieces) >> np.uint64(32)


def shards(words: DataFrame, limit: int = FILTER_BYTES) -> tuple[dict[int, int], dict[int, int], list[list[tuple[int, int]]]]:
    """Blocks of each piece and number of pieces by length, and the passes in which pieces are sent."""
    counts = sorted((r["size"], r["c"]) for r in words.groupBy(F.length("word").alias("size")).agg(F.count("*").alias("c")).collect())
    blocks, pieces, passes, room = {}, {}, [], 0
    for size, c in counts:
        whole = max(1, math.ceil(c * BITS / (64 * BLOCK)))
        pieces[size] = math.ceil(whole * BLOCK * 8 / limit)
        blocks[size] = math.ceil(whole / pieces[size])
        for piece in range(pieces[size]):
            if blocks[size] * BLOCK * 8 > room:
                passes.append([])
                room = limit
            passes[-1].append((size, piece))
            room -= blocks[size] * BLOCK * 8
    return blocks, pieces, passes


def built(keys: DataFrame, blocks: dict[int, int], pieces: dict[int, int], wanted: list[tuple[int, int]]) -> Filters:
    """The wanted filters; chunks of each are built by the tasks of a shuffle of key hashes."""
    spark = keys.sparkSession
    chosen = spark.createDataFrame(wanted, "size int, piece int")

    def fill(group: pa.Table) -> pa.Table:
        size, piece, chunk = (group.column(c)[0].as_py() for c in ("size", "piece", "chunk"))
        n = min(CHUNK_BLOCKS, blocks[size] - chunk * CHUNK_BLOCKS)
        bits = np.zeros(n * BLOCK, np.uint64)
        block, h = _spots(group.column("key").to_numpy().view(np.uint64), blocks[size])
        i, m, j, k = _words_of(block - np.uint64(chunk * CHUNK_BLOCKS), h)
        np.bitwise_or.at(bits, i, m)
        np.bitwise_or.at(bits, j, k)
        return pa.table({"size": pa.array([size], pa.int32()), "piece": pa.array([piece], pa.int32()), "chunk": pa.array([chunk], pa.int32()),
                         "bits": pa.array([bits.tobytes()], pa.binary())})

    parts = keys.join(F.broadcast(chosen), ["size", "piece"]).groupBy("size", "piece", "chunk").applyInArrow(
        fill, "size int, piece int, chunk int, bits binary"
    )
    held = {(s, p): np.zeros(blocks[s] * BLOCK, np.uint64) for s, p in wanted}
    for r in parts.toLocalIterator():  # at most the bytes of one pass
        at = r["chunk"] * CHUNK_BLOCKS * BLOCK
        bits = np.frombuffer(r["bits"], np.uint64)
        held[r["size"], r["piece"]][at : at + len(bits)] = bits
    return Filters(held, pieces)


def key_rows(words: DataFrame, blocks: dict[int, int], pieces: dict[int, int]) -> DataFrame:
    """(size, piece, chunk, key) of each word."""

    def hashes(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        for size, _, codes in by_length(batch.column(0).to_pylist()):
            keys = _terms(codes).sum(axis=1, dtype=np.uint64)
            chunk = _spots(keys, blocks[size])[0] // np.uint64(CHUNK_BLOCKS)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(keys), size, np.int32)), pa.array(piece_of(keys, pieces[size]).astype(np.int32)),
                 pa.array(chunk.astype(np.int32)), pa.array(keys.view(np.int64))], ["size", "piece", "chunk", "key"]
            )

    return map_batches(words.select("word"), hashes, "size int, piece int, chunk int, key long")


def edits(size: int, codes: np.ndarray, letters: np.ndarray, filters: Filters) -> Iterator[tuple[np.ndarray, np.ndarray, int]]:
    """(rows, positions, letter or -1 for a deletion) of the edits of words of one length that the filters let pass."""
    up, down = _powers(size)
    terms = _terms(codes)
    whole = terms.sum(axis=1, dtype=np.uint64)
    if size - 1 in filters.of:
        before = np.cumsum(terms, axis=1, dtype=np.uint64) - terms
        keys = before + (whole[:, None] - before - terms) * down[1 if size > 1 else 0]
        # of a run of equal code points one deletion stands for all
        fresh = np.append(np.ones((len(codes), 1), bool), codes[:, 1:] != codes[:, :-1], axis=1)
        rows, at = np.nonzero(fresh)
        for a in range(0, len(rows), PROBES):
            ok = a + filters.has(size - 1, keys[rows[a : a + PROBES], at[a : a + PROBES]])
            yield rows[ok], at[ok], -1
    if size in filters.of:
        step = max(1, PROBES // size)
        for a in range(0, len(codes), step):
            some = codes[a : a + step].ravel()
            base = np.repeat(whole[a : a + step], size)
            power = np.tile(up, len(some) // size)
            for letter in letters.tolist():
                at = np.flatnonzero(some < letter)
                ok = at[filters.has(size, base[at] + (np.uint64(letter) - some[at].astype(np.uint64)) * power[at])]
                yield a + ok // size, ok % size, letter


def near_pairs(words: DataFrame, limit: int = FILTER_BYTES) -> DataFrame:
    """(u, nu, v, nv): each pair of near words of (word, n) once."""
    spark = words.sparkSession

    def letters_of(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = np.zeros(0, np.uint32)
        for batch in source:
            for _, _, codes in by_length(batch.column(0).to_pylist()):
                seen = np.union1d(seen, codes)
        yield pa.RecordBatch.from_arrays([pa.array(seen.astype(np.int32))], ["letter"])

    # at most as many as the word pattern has letters
    found = words.select("word").mapInArrow(letters_of, "letter int").distinct().collect()
    letters = np.sort(np.array([r["letter"] for r in found], np.uint32))
    blocks, pieces, passes = shards(words, limit)
    if not passes:
        return words.select(F.col("word").alias("u"), F.col("n").alias("nu"), F.col("word").alias("v"), F.col("n").alias("nv"))
    keys = materialize(key_rows(words, blocks, pieces), "keys") if len(passes) > 1 else key_rows(words, blocks, pieces)
    hits = []
    for wanted in passes:
        sent = spark.sparkContext.broadcast(built(keys, blocks, pieces, wanted))
        sizes = sorted({s for size, _ in wanted for s in (size, size + 1)})

        def probe(batch: pa.RecordBatch, sent=sent) -> Iterator[pa.RecordBatch]:
            filters = sent.value
            words, counts = batch.column(0).to_pylist(), batch.column(1)
            for size, which, codes in by_length(words):
                for rows, at, letter in edits(size, codes, letters, filters):
                    own = which[rows]
                    put = "" if letter < 0 else chr(letter)
                    other = [(w := words[i])[:p] + put + w[p + 1 :] for i, p in zip(own.tolist(), at.tolist())]
                    if other:
                        own = pa.array(own)
                        yield pa.RecordBatch.from_arrays([batch.column(0).take(own), counts.take(own), pa.array(other)], ["u", "nu", "v"])

        ask = words.where(F.length("word").isin(sizes)) if len(passes) > 1 else words
        dealt = ask.select("word", "n").repartition(parts_for(spark, len(letters) * sum(blocks.values()) * 32.0, 1 << 24))
        found = map_batches(dealt, probe, "u string, nu long, v string")
        hits.append(materialize(found, "positives") if len(passes) > 1 else found)
        if len(passes) > 1:
            sent.unpersist()
    every = hits[0]
    for more in hits[1:]:
        every = every.unionByName(more)
    return every.join(words.select(F.col("word").alias("v"), F.col("n").alias("nv")), "v").select("u", "nu", "v", "nv")


def roots(forms: DataFrame) -> DataFrame:
    """(word, root) of the words with a form: chains followed to their ends by doubling."""
    to = materialize(forms.where("form IS NOT NULL").select("word", F.col("form").alias("root")), "roots")
    while True:
        ahead = to.select(F.col("word").alias("root"), F.col("root").alias("far"))
        both = to.join(ahead, "root", "left")
        to = materialize(both.select("word", F.coalesce("far", "root").alias("root"), F.col("far").isNotNull().alias("moved")), "roots")
        if to.where("moved").isEmpty():
            return to.select("word", "root")
        to = to.select("word", "root")


def variants(docs: DataFrame, ratio: int = RATIO, limit: int = FILTER_BYTES, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per word: word, form, root, n, n_near, form_n."""
    words = materialize(vocabulary(docs, id_col=id_col, text_col=text_col), "vocabulary")
    pairs = near_pairs(words, limit)
    way = lambda a, na, b, nb: F.struct(F.col(a).alias("word"), F.col(na).alias("n"), F.struct((-F.col(nb)).alias("m"), F.col(b).alias("w")).alias("near"))
    both = pairs.select(F.inline(F.array(way("u", "nu", "v", "nv"), way("v", "nv", "u", "nu"))))
    alone = words.select("word", "n", F.lit(None).cast("struct<m: bigint, w: string>").alias("near"))
    best = both.unionByName(alone).groupBy("word", "n").agg(F.count("near").alias("n_near"), F.min("near").alias("near"))
    has = -F.col("near.m") >= ratio * F.col("n")
    forms = materialize(
        best.select("word", "n", "n_near", F.when(has, F.col("near.w")).alias("form"), F.when(has, -F.col("near.m")).alias("form_n")), "forms"
    )
    return forms.join(roots(forms), "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
