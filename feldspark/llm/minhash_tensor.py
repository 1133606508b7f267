"""Near-duplicate components by MinHash with tensored banding.

Two small collections of ``bands`` half keys each (``rows`` minhashes a half key) are computed
per document; every pair of a half key of the first and one of the second collection is a table
key. ``2 * bands * rows`` minhashes thus give ``bands ** 2`` tables. Two documents of
similarity s meet in a table unless all half keys of one collection differ: at 0.75, with 14
bands of two rows, 2 * (1 - 0.75 ** 2) ** 14 = 0.00002 of the pairs would be missed.

Nothing is emitted per pair of a group:

* Documents with the same shingle set are one representative from the start.
* Half keys that stand in one document only are dropped before keys are formed, and of the
  table keys with the same members one is kept.
* In each of the first rounds the members of each table are put in an order of its own, large tables
  in parts, and only neighbours meet. Every document is compared with the most alike of all it
  meets in other components. Links are confirmed on the full shingle sets, and components are
  joined at once.
* What is left are the pairs across components that still share half keys of both collections and
  have not been compared. Each comes once, from the first half key that both have.

The tables and the marks are statistical filters, and what passes them is confirmed exactly: against an exact
prefix-filter join all 135 links of the 10,000 documents of sf0.1 were found.

A pair is left out unseen if the set sizes exclude a link or if the marks (four bits of each minhash)
differ in more than ``differ`` of the places: at 0.75 that is over four standard deviations off. Pairs
of the last pass must agree by the marks of 512 bins of the set as well, by the same standard.

Documents without words are linked with nothing. Each row is a document of its own, also where ids are missing or
repeat; of a component the row of smallest id (missing ids last, then by a hash of the row) is kept.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import reduce
from operator import add

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from feldspark.llm import arrays
from feldspark.llm.frames import id_and_text, map_batches, per_row, real_id
from feldspark.session import materialize

SHINGLE = 5
BANDS = 14
ROWS = 2
NUMERATOR, DENOMINATOR = 75, 100  # similarity that links
BINS = 512  # of a set's bin marks, four bits each
DIFFER = 0.5  # largest share of unequal marks for which sets are compared in the last round
ROUNDS = 2
PART_ROWS = 1000


def shingle_sets(texts: list[bytes], size: int = SHINGLE) -> list[np.ndarray]:
    """Sorted distinct hashes of the shingles of each text: lower-case A-Z, runs of ``size`` words."""
    raw, _, lo, hi = arrays.joined(texts)
    data = np.frombuffer(raw.lower(), np.uint8)
    starts, ends = arrays.word_bounds(data)
    words = arrays.exact_hash(arrays.exact_prefix(data), starts, ends)
    first, last = np.searchsorted(starts, lo), np.searchsorted(starts, hi)
    grams = arrays.window_hash(words, size)
    out = []
    for a, b in zip(first.tolist(), last.tolist()):
        if b - a >= size:
            h = np.sort(grams[a : b - size + 1])
            out.append(h[np.append(True, h[1:] != h[:-1])])
        elif b > a:
            out.append(arrays.window_hash(words[a:b], b - a) ^ np.uint64(b - a))
        else:
            out.append(np.zeros(0, np.uint64))
    return out


def multipliers(n: int) -> np.ndarray:
    return arrays.mix(np.arange(1, n + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)) | np.uint64(1)


def bin_marks(hashes: np.ndarray, owner: np.ndarray, n: int) -> np.ndarray:
    """Per text (of n) and bin of the hash range four bits of the least hash in it, 0 if there is none, as bit planes."""
    out = np.zeros((4, n * BINS // 64), np.uint64)
    if len(hashes):
        spot = owner * BINS + (hashes >> np.uint64(64 - BINS.bit_length() + 1)).astype(np.int64)
        first = np.flatnonzero(np.append(True, spot[1:] != spot[:-1]))
        spot, mark = spot[first], np.uint64(1) + arrays.mix(hashes[first]) % np.uint64(15)
        long, at = spot // 64, (spot % 64).astype(np.uint64)
        begin = np.flatnonzero(np.append(True, long[1:] != long[:-1]))
        for k in range(4):
            out[k, long[begin]] = np.bitwise_or.reduceat((mark >> np.uint64(k) & np.uint64(1)) << at, begin)
    return out.reshape(4, n, BINS // 64).transpose(1, 0, 2).reshape(n, -1)


def bit_planes(marks: np.ndarray) -> np.ndarray:
    """Four-bit marks (rows of them) as longs: the first bits of all marks, 64 a long, then the second bits and so on."""
    n, width = marks.shape
    longs = -(-width // 64)
    wide = np.zeros((n, longs * 64), np.uint64)
    wide[:, :width] = marks
    wide = wide.reshape(n, longs, 64)
    at = np.arange(64, dtype=np.uint64)
    return np.concatenate([((wide >> np.uint64(b) & np.uint64(1)) << at).sum(axis=2, dtype=np.uint64) for b in range(4)], axis=1)


def sketches(docs: DataFrame, size: int, bands: int, rows: int) -> DataFrame:
    """did, n (set size), f1 and f2 (a 128-bit name of the set), half keys a and b, marks m, bin marks w."""
    n_hash = 2 * bands * rows

    def sketch(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        factor = multipliers(n_hash)
        salt = arrays.mix(np.arange(2 * bands, dtype=np.uint64) + np.uint64(77))
        for row, texts in arrays.batches(batch.column(1)):
            sets = shingle_sets(texts, size)
            n = np.fromiter(map(len, sets), np.int64, len(sets))
            some = np.flatnonzero(n)
            least = np.zeros((len(sets), n_hash), np.uint64)
            f1, f2 = np.zeros(len(sets), np.uint64), np.zeros(len(sets), np.uint64)
            bins = np.zeros((len(sets), BINS // 16), np.uint64)
            if len(some):
                h = np.concatenate([sets[i] for i in some.tolist()])
                at = np.cumsum(n[some]) - n[some]
                bins[some] = bin_marks(h, np.repeat(np.arange(len(some)), n[some]), len(some))
                f1[some], f2[some] = np.add.reduceat(h, at), np.bitwise_xor.reduceat(arrays.mix(h + np.uint64(1)), at)
                for k in range(n_hash):
                    least[some, k] = np.minimum.reduceat(h * factor[k], at)
            half = least.reshape(len(sets), 2 * bands, rows)
            key = np.tile(salt, (len(sets), 1))
            for r in range(rows):
                key = arrays.mix(key * np.uint64(31) + half[:, :, r])
            key = key.view(np.int64)
            flat = lambda x: pa.ListArray.from_arrays(
                pa.array(np.arange(len(sets) + 1) * x.shape[1], pa.int32()), pa.array(np.ascontiguousarray(x).view(np.int64).ravel())
            )
            mark = bit_planes((least >> np.uint64(20)) & np.uint64(15))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).slice(row, len(sets)), pa.array(n), pa.array(f1.view(np.int64)), pa.array(f2.view(np.int64)),
                    flat(key[:, :bands]), flat(key[:, bands:]), flat(mark), flat(bins),
                ],
                ["did", "n", "f1", "f2", "a", "b", "m", "w"],
            )

    schema = "did long, n long, f1 long, f2 long, a array<long>, b array<long>, m array<long>, w array<long>"
    return map_batches(docs, sketch, schema)


def components(links: DataFrame) -> DataFrame:
    """(node, root) of the undirected links (u, v): large and small stars in turn until nothing changes."""
    edges = materialize(links.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).where("u <> v").distinct(), "edges")
    before = None
    while True:
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v")
        # below each node: its smaller neighbours hang from the least of them
        down = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(down, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        edges = materialize(small.union(down.select("u", F.col("m").alias("v"))).distinct(), "edges")
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == before:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
        before = now


def _together(left: list[bytes], right: list[bytes]) -> Iterator[list[tuple[bytes, bytes]]]:
    """Pairs of packed texts in runs of about ``arrays.BATCH_BYTES`` of text, each text of a run counted once."""
    run, seen, size = [], set(), 0
    for pair in zip(left, right):
        more = sum(zstandard.frame_content_size(x) for x in set(pair) - seen)
        if run and size + more > arrays.BATCH_BYTES:
            yield run
            run, seen, size = [], set(), 0
            more = sum(zstandard.frame_content_size(x) for x in set(pair))
        run.append(pair)
        seen.update(pair)
        size += more
    if run:
        yield run


def _confirm(pairs: DataFrame, packed: DataFrame, size: int) -> DataFrame:
    """(u, v, linked) with the sets of both texts compared in full."""

    def compare(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        u, v, pu, pv = batch.columns
        linked = []
        for pairs in _together(pu.to_pylist(), pv.to_pylist()):
            texts = list(dict.fromkeys(x for pair in pairs for x in pair))
            sets = dict(zip(texts, shingle_sets([zstandard.decompress(x) for x in texts], size)))
            for x, y in pairs:
                p, q = sets[x], sets[y]
                both = len(np.intersect1d(p, q, assume_unique=True))
                linked.append(DENOMINATOR * both >= NUMERATOR * (len(p) + len(q) - both))
        yield pa.RecordBatch.from_arrays([u, v, pa.array(linked, pa.bool_())], ["u", "v", "linked"])

    left = packed.select(F.col("did").alias("u"), F.col("packed").alias("pu"))
    right = packed.select(F.col("did").alias("v"), F.col("packed").alias("pv"))
    both = pairs.select("u", "v").join(left, "u").join(right, "v").select("u", "v", "pu", "pv")
    return materialize(map_batches(both, compare, "u long, v long, linked boolean"), "confirmed")


def _mismatches(m: str, other: str, n_hash: int) -> Column:
    """How many of the four-bit marks of two rows differ; a few longs (bit planes), so each is spelled out for generated code."""
    longs = -(-n_hash // 64)
    planes = [F.col(m)[k].bitwiseXOR(F.col(other)[k]) for k in range(4 * longs)]
    return reduce(add, [F.bit_count(reduce(Column.bitwiseOR, planes[k::longs])) for k in range(longs)])


def _bins(of: Callable[[Column, Column], Column]) -> Column:
    """In how many bins ``of`` the marks of two rows has a bit; one short expression however many bins there are."""
    longs = BINS // 64

    def bits(i: Column) -> Column:
        return reduce(Column.bitwiseOR, [of(F.get("w", i + k * longs), F.get("w_", i + k * longs)) for k in range(4)])

    return F.aggregate(F.sequence(F.lit(0), F.lit(longs - 1)), F.lit(0), lambda s, i: s + F.bit_count(bits(i)))


def _bins_allow() -> Column:
    """Whether the bin marks of two rows allow for a link: each bin that either has is a draw from the union.

    Draws are without replacement, so the spread shrinks as bins cover the union; the limit is four and a
    half standard deviations above the differing bins expected at the similarity that links.
    """
    differ, s = _bins(Column.bitwiseXOR), NUMERATOR / DENOMINATOR
    chance = (1 - s) * 14 / 15
    whole = (F.col("n") + F.col("n_")) / (1 + s)

    def allowed(either: Column) -> Column:
        spread = either * (s * (1 - s) * (1 - F.least(F.lit(1.0), either / whole)) + (1 - s) * 14 / 225)
        return differ <= chance * either + 4.5 * F.sqrt(spread) + 1

    return F.exists(F.array(_bins(Column.bitwiseOR)), allowed)  # so that it is added up once


def _sizes_allow(n: str, other: str) -> Column:
    return F.expr(f"{DENOMINATOR} * least({n}, {other}) >= {NUMERATOR} * greatest({n}, {other})")


def _shared_halves(docs: DataFrame, some: DataFrame, side: str) -> DataFrame:
    """(did, side) of the documents of ``some`` (did) that share half keys of a collection with others of them: these half keys."""
    halves = docs.select("did", side).join(some, "did", "left_semi").select("did", F.explode(side).alias("h"))
    shared = halves.groupBy("h").agg(F.count("*").alias("c")).where("c > 1").select("h")
    return halves.join(shared, "h", "left_semi").groupBy("did").agg(F.collect_set("h").alias(side))


def _partners(held: DataFrame, round_: int, differ: float, n_hash: int) -> DataFrame:
    """(u, v): for each document the most alike of the members of other components next to it in its tables.

    Members of a table stand in an order drawn for the table and the round; a large table is dealt into
    parts of about ``PART_ROWS`` first.
    """
    part = F.pmod(F.xxhash64(F.lit(round_), "did"), F.ceil(F.col("c") / PART_ROWS))
    # another order in each table, so that a document meets other members in each of its tables
    order = Window.partitionBy("key", "part").orderBy(F.xxhash64("did", "key", F.lit(round_)), "did")
    beside = held.withColumn("part", part).withColumn("p", F.lag(F.struct("did", "comp", "n", "m")).over(order))
    met = beside.where(F.expr("p.comp <> comp") & _sizes_allow("n", "p.n")).withColumn("d", _mismatches("m", "p.m", n_hash))
    met = met.where(F.col("d") <= differ * n_hash).select(F.col("did").alias("x"), F.col("p.did").alias("y"), "d")
    ways = met.select("d", F.inline(F.array(F.struct("x", "y"), F.struct(F.col("y").alias("x"), F.col("x").alias("y")))))
    best = ways.groupBy("x").agg(F.min(F.struct("d", "y")).alias("b")).select("x", F.col("b.y").alias("y"))
    return best.select(F.greatest("x", "y").alias("u"), F.least("x", "y").alias("v")).distinct()


def _across(known: DataFrame, comp: DataFrame, tried: DataFrame, differ: float, n_hash: int) -> DataFrame:
    """(u, v): the pairs across components that share a half key of either collection and look alike by size and marks.

    A pair comes from the least half key of the first collection that both have, so it comes once.
    """
    rows = known.join(comp, "did").select("did", "comp", "n", "m", "w", "a", "b", F.explode("a").alias("key"))
    sizes = rows.groupBy("key", "comp").agg(F.count("*").alias("c")).groupBy("key").agg(
        F.max(F.struct("c", "comp")).alias("top"), F.count("*").alias("kinds"), F.sum("c").alias("all")
    ).where("kinds > 1")
    # a key of many small components is dealt to several tasks: each has a part of the few and all rows
    slots = F.ceil((F.col("all") - F.col("top.c")) / PART_ROWS).cast("int")
    rows = rows.join(sizes.select("key", F.col("top.comp").alias("top"), slots.alias("slots")), "key")
    few = rows.where("comp <> top").select(
        *(F.col(c).alias(f"{c}_") for c in ("did", "comp", "n", "m", "w", "a", "b", "key")), F.pmod(F.xxhash64("did"), "slots").alias("slot_")
    )
    rows = rows.withColumn("slot", F.explode(F.sequence(F.lit(0), F.col("slots") - 1)))
    # two rows that are both few meet twice; the smaller id of them stands on the left
    near = (
        (F.col("key_") == F.col("key")) & (F.col("slot_") == F.col("slot"))
        & F.expr("comp <> comp_ AND (comp = top OR did_ < did)") & _sizes_allow("n", "n_")
        & (_mismatches("m", "m_", n_hash) <= differ * n_hash) & (F.array_min(F.array_intersect("a", "a_")) == F.col("key"))
        & F.arrays_overlap("b", "b_") & _bins_allow()  # the dearest last, once a pair
    )
    pairs = few.join(rows, near).select(F.greatest("did", "did_").alias("u"), F.least("did", "did_").alias("v"))
    return pairs.join(tried.select("u", "v"), ["u", "v"], "left_anti")


def near_components(docs: DataFrame, size: int = SHINGLE, bands: int = BANDS, rows: int = ROWS, differ: float = DIFFER, rounds: int = ROUNDS,
                    id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: doc_id, n_shingles, component_id (null if no row of it has an id), kept."""
    run = lambda d, key: _near_components(d, size, bands, rows, differ, rounds, key, text_col)
    return per_row(docs, run, id_col, ("doc_id", "component_id"))


def _near_components(docs: DataFrame, size: int, bands: int, rows: int, differ: float, rounds: int, id_col: str, text_col: str) -> DataFrame:
    pairs_in = id_and_text(docs, id_col, text_col)
    all_docs = materialize(sketches(pairs_in, size, bands, rows), "sketches")
    sets = all_docs.where("n > 0").groupBy("f1", "f2", "n").agg(F.min("did").alias("rep"))
    sets = materialize(sets, "sets")
    reps = sets.select(F.col("rep").alias("did"))  # one row a set, as ids are unique here (per_row)
    # documents that meet in a table share half keys of both collections: the second is looked at among those left by the first
    in_a = materialize(_shared_halves(all_docs, reps, "a"), "halves")
    in_b = _shared_halves(all_docs, in_a.select("did"), "b")
    known = materialize(all_docs.select("did", "n", "m", "w").join(in_a, "did").join(in_b, "did"), "known")
    keys = known.select("did", "b", F.explode("a").alias("x")).select("did", "x", F.explode("b").alias("y"))
    keys = keys.select("did", F.xxhash64("x", "y").alias("key"))
    # tables with two or more members, one for each set of members
    members = keys.groupBy("key").agg(F.count("*").alias("c"), F.min("did").alias("m"), F.sum(F.xxhash64("did") % (1 << 40)).alias("s"))
    tables = members.where("c > 1").groupBy("c", "m", "s").agg(F.min("key").alias("key")).select("key", "c")
    keys = materialize(keys.join(tables, "key").join(known.select("did", "n", "m"), "did"), "tables")
    wanted = keys.select("did").distinct()

    def shrink(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        tool = zstandard.ZstdCompressor(3)
        for row, texts in arrays.batches(batch.column(1)):
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).slice(row, len(texts)), pa.array([tool.compress(t) for t in texts], pa.binary())], ["did", "packed"]
            )

    packed = map_batches(pairs_in, shrink, "did long, packed binary").join(wanted, "did", "left_semi")  # ids are unique here (per_row)
    packed = materialize(packed, "packed")
    n_hash = 2 * bands * rows
    comp = None  # at first every document is its own component
    tried = None
    for round_ in range(rounds + 1):
        held = keys.withColumn("comp", F.col("did")) if comp is None else keys.join(comp, "did")
        if round_ < rounds:
            pairs = _partners(held, round_, differ, n_hash)
        else:
            pairs = _across(known, comp, tried, differ, n_hash)
        done = _confirm(pairs, packed, size)
        links = done.where("linked")
        tried = done if tried is None else tried.unionByName(done)
        if links.isEmpty():
            if comp is None:
                comp = wanted.select("did", F.col("did").alias("comp"))
            continue
        if comp is None:
            joined = components(links)
            comp = wanted.join(joined, wanted["did"] == joined["node"], "left").select("did", F.coalesce("root", "did").alias("comp"))
        else:
            of_u = comp.select(F.col("did").alias("u"), F.col("comp").alias("cu"))
            of_v = comp.select(F.col("did").alias("v"), F.col("comp").alias("cv"))
            joined = components(links.join(of_u, "u").join(of_v, "v").select(F.col("cu").alias("u"), F.col("cv").alias("v")))
            comp = comp.join(joined, comp["comp"] == joined["node"], "left").select("did", F.coalesce("root", "comp").alias("comp"))
        comp = materialize(comp, "components")
    by_set = sets.join(comp.withColumnRenamed("did", "rep"), "rep", "left").select("f1", "f2", "n", F.coalesce("comp", "rep").alias("comp"))
    out = all_docs.select("did", "f1", "f2", "n").join(by_set, ["f1", "f2", "n"], "left").withColumn("comp", F.coalesce("comp", "did"))
    return out.select(
        real_id().alias("doc_id"), F.col("n").alias("n_shingles"), real_id("comp").alias("component_id"), (F.col("did") == F.col("comp")).alias("kept")
    )
