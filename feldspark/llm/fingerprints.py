"""Document fingerprints by one-permutation MinHash, in DataFrame functions only.

Each shingle of a text (lower case, five words between ASCII white space; a shorter text is one shingle) is hashed once. The top bits of
the hash are its bin; the least hash of each bin is kept. An empty bin takes the value of a bin that is not empty:
each bin has its own sequence of bins to try, the same for all texts, drawn independently of each other (optimal
densification). Tries beyond ``TRIES`` follow a fixed order of the bins that differs from bin to bin, so every
sequence ends. What is stored are the low-order bits of a value mixed with its bin, eight bits a bin, packed into
longs; agreement by chance is 1 in 256 a bin and is taken out of the estimate.

The bins come from one sorted array: a mark for the end of each bin is sorted in with the hashes, and the first
entry of each bin is its least hash, or its mark if it is empty. Nothing is exploded or shuffled for a fingerprint.

Defined results: null and empty texts, and texts without words, have the fingerprint '' and are alike only to
each other. Likeness is between 0 and 1, and 1 for equal texts. In ``edit_pairs`` documents stand in falling order
of id, rows without id after all others; rows that share an id stand in the order of a hash of their texts, so
that repeated rows follow each other. The row after the last is the first; a document alone follows itself. An
empty table gives no rows. Other columns play no part.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from feldspark.llm.frames import NO_ID, id_and_text, parts_for, real_id

SHINGLE = 5
BIN_BITS = 8
BINS = 1 << BIN_BITS
LANE = 8  # bits stored of a bin
TRIES = 12
CHANCE = 1 / (1 << LANE)
BUCKET_BYTES = 1 << 25
_TOP = 62  # bits of a hash that are used; the sign stays clear


def let(value: Column, use) -> Column:
    """``use`` applied to ``value``, which is computed once however often it is used."""
    return F.transform(F.array(value), use)[0]


def shingle_hashes(text: Column, size: int = SHINGLE) -> Column:
    """A long from 0 to 2**62 - 1, even, for each shingle."""
    low = F.lower(F.coalesce(text, F.lit("")))
    for space in "\t\n\x0b\f\r":
        low = F.replace(low, F.lit(space), F.lit(" "))
    words = F.array_remove(F.split(low, " "), "")

    def of_words(w: Column) -> Column:
        windows = F.transform(
            F.sequence(F.lit(0), F.size(w) - size), lambda i: F.xxhash64(*(F.get(w, i + k) for k in range(size)))
        )
        few = F.when(F.size(w) > 0, F.array(F.xxhash64(w))).otherwise(F.array().cast("array<long>"))
        return F.when(F.size(w) >= size, windows).otherwise(few)

    return F.transform(let(words, of_words), lambda h: F.shiftrightunsigned(h, 64 - _TOP).bitwiseAND(F.lit(~1)))


def bin_minima(hashes: Column) -> Column:
    """The least hash of each bin in order; an odd number where the bin is empty."""
    shift = _TOP - BIN_BITS
    marks = F.transform(F.sequence(F.lit(1).cast("long"), F.lit(BINS).cast("long")), lambda b: F.shiftleft(b, shift) - 1)
    firsts = lambda s: F.filter(
        s, lambda x, i: (i == 0) | (F.shiftright(x, shift) != F.shiftright(F.get(s, i - 1), shift))
    )
    return let(F.sort_array(F.concat(hashes, marks)), firsts)


def densified(minima: Column) -> Column:
    """Every empty bin filled from the first of its own sequence of bins that is not empty."""
    full = lambda x: x.bitwiseAND(F.lit(1)) == 0

    def fill(v: Column) -> Column:
        def tried(j: Column, t: int) -> Column:
            x = F.get(v, F.pmod(F.xxhash64(j, F.lit(t)), F.lit(BINS)).cast("int"))
            return F.when(full(x), x)

        def rest(j: Column) -> Column:
            by_rank = F.transform(F.filter(v, full), lambda x: F.struct(F.xxhash64(j, F.shiftright(x, _TOP - BIN_BITS)).alias("r"), x.alias("x")))
            return F.array_min(by_rank).getField("x")

        return F.transform(v, lambda x, j: F.when(full(x), x).otherwise(F.coalesce(*(tried(j, t) for t in range(TRIES)), rest(j))))

    return let(minima, fill)


def packed(values: Column) -> Column:
    """Low-order bits of the values, ``64 // LANE`` bins to a long."""
    each = 64 // LANE
    low = F.transform(values, lambda x, j: F.xxhash64(x, j).bitwiseAND(F.lit((1 << LANE) - 1)))

    def join(p: Column) -> Column:
        def word(i: Column) -> Column:
            out = F.get(p, i * each)
            for k in range(1, each):
                out = out.bitwiseOR(F.shiftleft(F.get(p, i * each + k), LANE * k))
            return out

        return F.transform(F.sequence(F.lit(0), F.lit(BINS // each - 1)), word)

    return let(low, join)


def fingerprint(text: Column, size: int = SHINGLE) -> Column:
    """Packed fingerprint (array of longs) of a text; empty for a text without words."""
    none = F.array().cast("array<long>")
    return let(shingle_hashes(text, size), lambda h: F.when(F.size(h) > 0, packed(densified(bin_minima(h)))).otherwise(none))


def as_text(prints: Column) -> Column:
    """A fingerprint in lower-case hex."""
    return F.lower(F.array_join(F.transform(prints, lambda x: F.lpad(F.hex(x), 16, "0")), ""))


def likeness(a: Column, b: Column) -> Column:
    """Estimated share of common shingles: the share of equal lanes, less what chance gives."""
    ones = int("01" * (64 // LANE), 16)

    def differ(x: Column, y: Column) -> Column:
        z = x.bitwiseXOR(y)
        for k in (4, 2, 1):
            z = z.bitwiseOR(F.shiftrightunsigned(z, k))
        return F.bit_count(z.bitwiseAND(F.lit(ones)))

    unequal = F.aggregate(F.zip_with(a, b, differ), F.lit(0), lambda s, n: s + n)
    share = (1 - unequal / F.lit(float(BINS)) - CHANCE) / (1 - CHANCE)
    both = F.when(F.size(a) == F.size(b), F.greatest(F.lit(0.0), share)).otherwise(0.0)
    return F.when((F.size(a) == 0) & (F.size(b) == 0), 1.0).otherwise(both)


def fingerprints(docs: DataFrame, size: int = SHINGLE, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, fingerprint) of every row, as packed longs."""
    return id_and_text(docs, id_col, text_col).select(real_id().alias("doc_id"), fingerprint(F.col("text"), size).alias("fingerprint"))


def _below(bounds: list[int], value: Column, or_equal: bool) -> Column:
    """How many of the sorted bounds are below ``value``, by binary search."""
    if not bounds:
        return F.lit(0)
    steps = [1 << k for k in range(len(bounds).bit_length() - 1, -1, -1)]
    held = F.array(*map(F.lit, bounds)) if len(bounds) < 100 else F.from_json(F.lit(str(bounds)), "array<bigint>")

    def search(b: Column) -> Column:
        def step(at: Column, s: Column) -> Column:
            x = F.get(b, at + s - 1)
            return F.when(F.coalesce(x <= value if or_equal else x < value, F.lit(False)), at + s).otherwise(at)

        return F.aggregate(F.array(*map(F.lit, steps)), F.lit(0), step)

    return let(held, search)


def with_bucket(rows: DataFrame, buckets: int) -> DataFrame:
    """``rows`` (did, h, ...) with a number that rises with (did, h): about equal numbers of rows, ids shared by many cut by h."""
    at = [k / buckets for k in range(1, buckets)]
    bounds = rows.agg(F.percentile_approx("did", at, max(10_000, 10 * buckets)).alias("b")).first()["b"] if at else []
    bounds = sorted(bounds or [])
    low, high = _below(bounds, F.col("did"), False), _below(bounds, F.col("did"), True)
    share = F.shiftrightunsigned(F.col("h").bitwiseXOR(F.lit(-(1 << 63))), 11) / F.lit(float(1 << 53))
    rows = rows.withColumn("low", low).withColumn("high", high)
    inside = F.least(F.floor(share * (F.col("high") - F.col("low"))).cast("int"), F.col("high") - F.col("low") - 1)
    return rows.withColumn("bucket", F.col("low") + F.greatest(F.lit(0), inside)).drop("low", "high")


def edit_pairs(docs: DataFrame, bucket_bytes: int = BUCKET_BYTES, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(did, text, print, edited, next_print): each text with one whose second half is the start of the next text.

    Rows are dealt to ranges of ids and sorted within them; a copy of the last row of each range is sent ahead to the
    range that follows it in falling order.
    """
    spark = docs.sparkSession
    rows = id_and_text(docs, id_col, text_col).withColumn("text", F.coalesce("text", F.lit(""))).withColumn("h", F.xxhash64("text"))
    size = rows.agg(F.sum(F.octet_length("text") + 8)).first()[0] or 0
    rows = with_bucket(rows, parts_for(spark, size, bucket_bytes))
    # the row that comes first (in falling order) in each range, for the range above; one row a range
    firsts = sorted(tuple(r) for r in rows.groupBy("bucket").agg(F.max(F.struct("did", "h")).alias("t")).select("bucket", "t.did", "t.h").collect())
    moved = [(firsts[(k + 1) % len(firsts)][0], *f) for k, f in enumerate(firsts)]
    copies = spark.createDataFrame([(to, did, h) for to, _, did, h in moved], "ahead int, did long, h long")
    extra = rows.drop("bucket").join(F.broadcast(copies), ["did", "h"]).dropDuplicates(["ahead"])
    both = rows.withColumn("copy", F.lit(0)).unionByName(extra.withColumnRenamed("ahead", "bucket").withColumn("copy", F.lit(1)))
    both = both.withColumn("print", fingerprint(F.col("text"))).withColumn("n", F.length("text"))
    order = Window.partitionBy("bucket").orderBy("copy", F.desc("did"), F.desc("h"))
    both = both.withColumn("next_text", F.lead("text").over(order)).withColumn("next_print", F.lead("print").over(order)).where("copy = 0")
    half = F.floor(F.col("n") / 2).cast("int")
    edited = F.concat(F.substring("text", F.lit(1), F.col("n") - half), F.substring(F.col("next_text"), F.lit(1), half))
    return both.select("did", "text", "n", "print", edited.alias("edited"), "next_print")


def compare(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: its fingerprint, that of its edited text, and its likeness to that and to the next."""
    pairs = edit_pairs(docs, id_col=id_col, text_col=text_col)
    pairs = pairs.withColumn("other", fingerprint(F.col("edited")))
    return pairs.select(
        real_id().alias("doc_id"), F.col("n").cast("long").alias("n_chars"), F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"),
        as_text(F.col("print")).alias("fingerprint"), as_text(F.col("other")).alias("edited_fingerprint"),
        likeness(F.col("print"), F.col("other")).alias("near_edited"), likeness(F.col("print"), F.col("next_print")).alias("near_next"),
    )
