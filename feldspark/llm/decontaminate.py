"""Benchmark decontamination with suffix arrays over shards of the training texts.

The texts of a task are taken in shards of whole documents. A shard's suffix array sorts the
word suffixes that begin like some suffix of a benchmark item (the first ``q`` words hash to one
that occurs there; no other suffix can be found by the search). Each suffix of each item is then
looked up by two binary searches for its first ``window`` words (all its words, if the item is
shorter); the interval between them holds every occurrence, and comparing on from there gives the
longest verbatim match at each. Words are compared by 64-bit hashes.

The benchmark is the query set: it is sent to the tasks in blocks of at most ``block_bytes``
(its size is measured first), one pass per block. Documents never travel.

Null and empty texts and items have no words: such items match nothing, such documents are clean.
Items with the same id are listed once. Rows that repeat a doc_id are each judged and returned.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feldspark.llm import arrays
from feldspark.llm.frames import fresh, id_and_text, map_batches, real_id
from feldspark.llm.superkmers import union_spans

WINDOW = 13
BLOCK_BYTES = 16 << 20
STATE = ("n_words_", "spans_", "items_")


def word_hashes(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hash of every word of the texts, and the first and last (excluded) word of each text."""
    _, data, lo, hi = arrays.joined(texts)
    data = arrays.LOWER[data]
    starts, ends = arrays.word_bounds(data, arrays.ALNUM)
    words = arrays.exact_hash(arrays.exact_prefix(data), starts, ends)
    return words, np.searchsorted(starts, lo), np.searchsorted(starts, hi)


class Tests:
    """The suffixes of the items of one block, by number of words that a match needs."""

    def __init__(self, ids: list[str], texts: list[bytes], window: int):
        words, first, last = word_hashes(texts)
        self.ids, self.window, self.words = ids, window, words
        length = last - first
        self.vocabulary = np.unique(words)
        self.end = np.repeat(last, length)
        # every suffix that can hold a window; an item under a window is one window
        need = np.minimum(length, window)
        at, item = [], []
        for i in range(len(ids)):
            if length[i]:
                starts = np.arange(first[i], last[i] - need[i] + 1)
                at.append(starts)
                item.append(np.full(len(starts), i))
        self.at = np.concatenate(at) if at else np.zeros(0, np.int64)
        self.item = np.concatenate(item) if item else np.zeros(0, np.int64)
        self.need = need[self.item] if len(self.item) else np.zeros(0, np.int64)
        self.q = int(min(self.need.min(), 4)) if len(self.need) else 0
        if self.q:
            grams = arrays.window_hash(words, self.q)
            self.heads = np.unique(grams[self.at])


def _keys(words: np.ndarray, vocabulary: np.ndarray, at: np.ndarray, end: np.ndarray, depth: int) -> np.ndarray:
    """Rows of ``depth`` word numbers from each of ``at``; 0 stands past the end, 1 for a word of no item."""
    place = at[:, None] + np.arange(depth)
    inside = place < end[:, None]
    values = words[np.where(inside, place, 0)]
    number = np.searchsorted(vocabulary, values)
    number[number == len(vocabulary)] = 0
    known = vocabulary[number] == values
    return np.where(inside, np.where(known, number + 2, 1), 0)


def search(tests: Tests, texts: list[bytes]) -> dict[str, np.ndarray]:
    """All places where a suffix of an item matches by its needed words: item, item_word, doc, doc_word, length."""
    words, first, last = word_hashes(texts)
    none = {k: np.zeros(0, np.int64) for k in ("item", "item_word", "doc", "doc_word", "length")}
    if not tests.q or len(words) < tests.q:
        return none | {"first": first, "last": last}
    grams = arrays.window_hash(words, tests.q)
    spot = np.searchsorted(tests.heads, grams)
    spot[spot == len(tests.heads)] = 0
    at = np.flatnonzero(tests.heads[spot] == grams)
    doc = np.searchsorted(first, at, side="right") - 1
    whole = at + tests.q <= last[doc]
    at, doc = at[whole], doc[whole]
    if not len(at):
        return none | {"first": first, "last": last}
    depth = tests.window
    suffixes = _keys(words, tests.vocabulary, at, last[doc], depth).astype(np.int64)
    order = np.lexsort(suffixes.T[::-1])  # the suffix array of the shard
    wanted = _keys(tests.words, tests.vocabulary, tests.at, tests.end[tests.at], depth).astype(np.int64)
    wanted[np.arange(depth) >= tests.need[:, None]] = 0
    top = wanted.copy()
    top[np.arange(depth) >= tests.need[:, None]] = np.iinfo(np.int64).max
    pack = lambda rows: np.ascontiguousarray(rows).astype(">i8").view(f"V{8 * depth}").ravel()  # noqa: E731  big-endian bytes order like the numbers
    table = pack(suffixes[order])
    lo, hi = _bisect(table, pack(wanted), False), _bisect(table, pack(top), True)
    count = hi - lo
    test = np.repeat(np.arange(len(count)), count)
    entry = np.repeat(lo - (np.cumsum(count) - count), count) + np.arange(len(test))
    place = at[order[entry]]
    length = tests.need[test].copy()
    i, j = tests.at[test] + length, place + length
    stop_i, stop_j = tests.end[tests.at[test]], last[doc[order[entry]]]
    more = np.flatnonzero((i < stop_i) & (j < stop_j))
    while len(more):
        more = more[tests.words[i[more]] == words[j[more]]]
        length[more] += 1
        i[more] += 1
        j[more] += 1
        more = more[(i[more] < stop_i[more]) & (j[more] < stop_j[more])]
    owner = doc[order[entry]]
    return {"item": tests.item[test], "item_word": tests.at[test], "doc": owner, "doc_word": place - first[owner], "length": length,
            "first": first, "last": last}


def _bisect(table: np.ndarray, wanted: np.ndarray, after: bool) -> np.ndarray:
    """Binary search of packed rows in the sorted table."""
    rows = table.view(np.uint8).reshape(len(table), -1)
    keys = wanted.view(np.uint8).reshape(len(wanted), -1)
    lo, hi = np.zeros(len(wanted), np.int64), np.full(len(wanted), len(table))
    while (lo < hi).any():
        mid = (lo + hi) // 2
        a, b = rows[np.minimum(mid, len(table) - 1)], keys
        differ = a != b
        at = differ.argmax(axis=1)
        pick = np.arange(len(keys))
        less = np.where(differ.any(axis=1), a[pick, at] < b[pick, at], after)
        go = (lo < hi) & less
        hi = np.where((lo < hi) & ~less, mid, hi)
        lo = np.where(go, mid + 1, lo)
    return lo


def benchmark_blocks(bench: DataFrame, id_col: str, text_col: str, block_bytes: int) -> Iterator[tuple[list[str], list[bytes]]]:
    """The items as ids and texts, at most ``block_bytes`` of text (or one item) at a time on the driver."""
    items = bench.select(F.col(id_col).cast("string").alias("id"), F.col(text_col).cast("string").alias("text")).where("text IS NOT NULL")
    total = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n = -(-total // block_bytes) or 1
    for k in range(n):
        part = items if n == 1 else items.where(F.pmod(F.xxhash64("id", "text"), F.lit(n)) == k)
        rows = part.collect()
        yield [r["id"] for r in rows], [r["text"].encode() for r in rows]


def matches(docs: DataFrame, bench: DataFrame, window: int = WINDOW, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """The longest verbatim matches: doc_id, doc_word, item_id, item_word, length, where no longer one covers a match."""

    def find(tests: Tests):
        def run(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
            for row, texts in arrays.batches(batch.column(1)):
                got = search(tests, texts)
                item, a, b = got["item"], got["item_word"], got["doc_word"]
                # a match is longest if the places before it do not match as well
                key = np.stack([got["doc"], b - a, item, a], axis=1)
                order = np.lexsort(key.T[::-1])
                k = key[order]
                longest = np.append(True, (k[1:, :3] != k[:-1, :3]).any(axis=1) | (k[1:, 3] != k[:-1, 3] + 1)) if len(k) else np.zeros(0, bool)
                o = order[longest]
                dids = batch.column(0).slice(row, len(texts)).take(pa.array(got["doc"][o]))
                starts = np.zeros(len(tests.ids), np.int64)
                if len(tests.item):
                    head = np.unique(tests.item, return_index=True)
                    starts[head[0]] = tests.at[head[1]]
                yield pa.RecordBatch.from_arrays(
                    [dids, pa.array(b[o]), pa.array([tests.ids[i] for i in item[o].tolist()], pa.string()), pa.array(a[o] - starts[item[o]]),
                     pa.array(got["length"][o])],
                    ["did", "doc_word", "item_id", "item_word", "length"],
                )
        return run

    pairs = id_and_text(docs)
    out = None
    for ids, texts in benchmark_blocks(bench, "item_id", "text", block_bytes):
        part = map_batches(pairs, find(Tests(ids, texts, window)), "did long, doc_word long, item_id string, item_word long, length long")
        out = part if out is None else out.unionByName(part)
    return out.select(real_id().alias("doc_id"), "doc_word", "item_id", "item_word", "length")


def _found(state: DataFrame, bench: DataFrame, window: int, block_bytes: int) -> DataFrame:
    """``state`` (text and more) with three more columns: words, hit word ranges and ids found.

    Each block of the benchmark is one step of the same pass; a step hands on what was found so far.
    """
    n_words, found_spans, found_items = (fresh(state, c) for c in STATE)
    state = state.selectExpr(
        "*", f"0L AS {n_words}", f"CAST(array() AS array<long>) AS {found_spans}", f"CAST(array() AS array<string>) AS {found_items}"
    )

    def step(tests: Tests):
        def run(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
            text, known_spans, known_items = (batch.column(batch.schema.get_field_index(c)) for c in ("text", found_spans, found_items))
            for row, texts in arrays.batches(text):
                got = search(tests, texts)
                n = got["last"] - got["first"]
                spans = [list(x or ()) for x in known_spans.slice(row, len(texts)).to_pylist()]
                items = [set(x or ()) for x in known_items.slice(row, len(texts)).to_pylist()]
                ends = got["doc_word"] + np.minimum(got["length"], window)
                for d, a, b in np.unique(np.stack([got["doc"], got["doc_word"], ends], axis=1), axis=0).tolist():
                    if spans[d] and spans[d][-2] <= a <= spans[d][-1]:
                        spans[d][-1] = max(b, spans[d][-1])
                    else:
                        spans[d] += [a, b]
                for d, i in np.unique(np.stack([got["doc"], got["item"]], axis=1), axis=0).tolist():
                    items[d].add(tests.ids[i])
                columns = dict(zip(batch.schema.names, batch.slice(row, len(texts)).columns))
                columns[n_words] = pa.array(n, pa.int64())
                columns[found_spans] = pa.array(spans, pa.list_(pa.int64()))
                columns[found_items] = pa.array([sorted(x) for x in items], pa.list_(pa.string()))
                yield pa.RecordBatch.from_arrays(list(columns.values()), list(columns))
        return run

    for ids, texts in benchmark_blocks(bench, "item_id", "text", block_bytes):
        state = map_batches(state, step(Tests(ids, texts, window)), state.schema)
    return state


def _contaminated(n_hit, n_words):
    return (n_hit > 0) & (20 * n_hit >= n_words)


def judge(docs: DataFrame, bench: DataFrame, window: int = WINDOW, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_words, n_hit, n_items, items (sorted ids), items_sha256, contaminated."""

    def digest(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        lists = batch.column(3).to_pylist()
        sums = [hashlib.sha256(",".join(x).encode()).hexdigest() for x in lists]
        n_hit = pa.array([_hit(x) for x in batch.column(2).to_pylist()], pa.int64())
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), n_hit, batch.column(3), pa.array(sums, pa.string())],
            ["did", "n_words", "n_hit", "items", "items_sha256"],
        )

    found = _found(id_and_text(docs), bench, window, block_bytes).select("did", *STATE)
    done = map_batches(found, digest, "did long, n_words long, n_hit long, items array<string>, items_sha256 string")
    return done.select(
        real_id().alias("doc_id"), "n_words", "n_hit", F.size("items").cast("long").alias("n_items"), "items", "items_sha256",
        _contaminated(F.col("n_hit"), F.col("n_words")).alias("contaminated"),
    )


def _hit(flat: list[int]) -> int:
    a, b = union_spans(list(zip(flat[0::2], flat[1::2])))
    return int((b - a).sum())


def remove_contaminated(docs: DataFrame, bench: DataFrame, window: int = WINDOW, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """The rows of ``docs`` (text and more) that are not contaminated, unchanged; rows never leave their task."""
    names = docs.columns
    state = [fresh(docs, c) for c in STATE[:2]]

    def clean(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in source:
            n_words, spans = (batch.column(batch.schema.get_field_index(c)).to_pylist() for c in state)
            keep = [not (0 < (h := _hit(s)) and 20 * h >= n) for n, s in zip(n_words, spans)]
            yield batch.select(names).filter(pa.array(keep, pa.bool_()))

    return _found(docs, bench, window, block_bytes).mapInArrow(clean, docs.schema)
