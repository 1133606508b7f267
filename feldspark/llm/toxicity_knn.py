"""Toxicity by votes of the nearest labelled examples under exact TF-IDF cosine of whole texts.

Examples are at most ``examples`` labelled rows (smallest hash of the id first). Every word of a text is
a term; inverse document frequencies are counted over all documents. The ``common`` terms that most
examples hold are a matrix with the largest weight of each block of ``block`` consecutive examples, all
others have postings. A query adds up its postings; only blocks that their largest weights may lift to
the k-th best sum are completed with the common terms, and what comes near the k-th best is computed
again in double precision, so the k neighbours are exact. Words that no example holds count in the length of a query.

Votes are weighted by the second and by the fourth power of the cosine and by the inverse share of their class among
examples, so that a rare class can win. They, the best cosine of either class and the toxic share of the neighbours
are turned into a probability by a logistic fit on the examples themselves: a document is never its own neighbour, so
the votes for an example are those of the others, and no held-out label is seen. The neighbours are the evidence.

Null and empty texts have no neighbour and get the share of toxic examples among those without a
word; texts without a word of any example get that among all. Rows that repeat a doc_id are each scored;
an id labelled twice counts by its mean label. Without labels every score is 0.
"""

from __future__ import annotations

import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feldspark.llm import arrays
from feldspark.llm.frames import NO_ID, id_and_text, map_batches, real_id
from feldspark.llm.pu_quality import first_by_hash, labelled, remainder
from feldspark.session import materialize

EXAMPLES = 20_000
K = 30
BLOCK = 64
COMMON = 512
TOGETHER = 16  # blocks looked at together
WIDE = 20  # a term is common if one in so many examples holds it
QUERIES = 128  # scored together
SHRINK = 0.02
THRESHOLD = 0.7
ERROR = 1e-4  # relative; above that of single-precision sums of positive products


def word_sets(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes of the words of all texts (A-Z lower-cased), and where each text's begin and end."""
    _, data, lo, hi = arrays.joined(texts)
    data = arrays.LOWER[data]
    starts, ends = arrays.word_bounds(data, arrays.ALNUM)
    return arrays.slice_hash(arrays.prefix_hash(data), starts, ends), np.searchsorted(starts, lo), np.searchsorted(starts, hi)


def term_counts(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Sorted distinct words of all texts; for each (text, word) the text, the place of the word and how often it stands there."""
    words, first, last = word_sets(texts)
    distinct, at = np.unique(words, return_inverse=True)
    width = max(len(distinct), 1)
    key, tf = np.unique(np.repeat(np.arange(len(texts)), last - first) * width + at, return_counts=True)
    return distinct, key // width, key % width, tf


def count_documents(batch: pa.RecordBatch, vocabulary: np.ndarray) -> Iterator[pa.RecordBatch]:
    """(place in the sorted vocabulary, documents that hold the word)."""
    for _, texts in arrays.batches(batch.column(0)):
        distinct, _, place, _ = term_counts(texts)
        at, hit = within(vocabulary, distinct)
        df = np.bincount(place, minlength=len(distinct))
        yield pa.RecordBatch.from_arrays([pa.array(at[hit].astype(np.int32)), pa.array(df[hit])], ["place", "df"])


def count_terms(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    for row, texts in arrays.batches(batch.column(2)):
        distinct, owner, place, tf = term_counts(texts)
        offsets = pa.array(np.searchsorted(owner, np.arange(len(texts) + 1)), pa.int32())
        yield pa.RecordBatch.from_arrays(
            [
                *(batch.column(i).slice(row, len(texts)) for i in (0, 1)), pa.ListArray.from_arrays(offsets, pa.array(distinct[place].view(np.int64))),
                pa.ListArray.from_arrays(offsets, pa.array(tf.astype(np.int32))),
            ],
            ["did", "y", "terms", "tf"],
        )


def within(keys: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Place of each value among sorted keys, and whether it is one of them."""
    if not len(keys):
        return np.zeros(len(values), np.int64), np.zeros(len(values), bool)
    at = np.searchsorted(keys, values)
    at[at == len(keys)] = 0
    return at, keys[at] == values


def pack(values: np.ndarray) -> bytes:
    """Compressed bytes of whole numbers, equal places of all of them together."""
    values = values.astype("<i4")
    return zlib.compress(values.view(np.uint8).reshape(-1, 4).T.tobytes(), 1)


def unpack(data: bytes) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(zlib.decompress(data), np.uint8).reshape(4, -1).T).view("<i4").ravel()


class Index:
    """Block-max index over unit vectors: a matrix of the commonest terms, postings of all others."""

    def __init__(self, owner: np.ndarray, term: np.ndarray, weight: np.ndarray, n: int, n_terms: int, block: int, common: int = COMMON):
        self.n, self.block, self.n_terms = n, block, n_terms
        # whole vectors, for the last word, by the numbers that examples came with
        if (owner[1:] < owner[:-1]).any():
            order = np.argsort(owner, kind="stable")
            owner, term, weight = owner[order], term[order], weight[order]
            del order
        self.term, self.weight = term.astype(np.int32, copy=False), weight
        self.start = np.append(0, np.cumsum(np.bincount(owner, minlength=n)))
        held = np.bincount(term, minlength=n_terms)
        most = np.argsort(-held, kind="stable")[:common]
        most = most[held[most] * WIDE >= n]
        self.column = np.full(n_terms, -1, np.int32)
        self.column[most] = np.arange(len(most))
        self.dense = np.zeros((n, len(most)), np.float32)
        spot = np.flatnonzero(self.column[term] >= 0)
        self.dense[owner[spot], self.column[term[spot]]] = weight[spot]
        # examples that share common terms stand together, so that blocks differ; ``number`` leads back
        self.number = self._order()
        self.place = np.empty(n, np.int64)
        self.place[self.number] = np.arange(n)
        self.dense, owner = self.dense[self.number], self.place[owner].astype(np.int32)
        self.peak = np.maximum.reduceat(self.dense, np.arange(0, n, block), axis=0) if n else self.dense
        spot = np.flatnonzero(self.column[term] < 0)
        spot = spot[np.argsort(term[spot], kind="stable")]
        # one number a posting, so that a run of them is one copy: owner in the lower half, weight in single precision in the upper
        self.post = np.empty((len(spot), 2), np.int32)
        self.post[:, 0] = owner[spot]
        self.post[:, 1] = weight[spot].astype(np.float32).view(np.int32)
        self.post = self.post.view(np.int64).ravel()
        del spot
        self.post_at = np.append(0, np.cumsum(np.where(self.column < 0, held, 0)))

    def _order(self) -> np.ndarray:
        """Examples by the leading direction of the common terms that they lean on most, then by how much."""
        if not self.n or not self.dense.shape[1]:
            return np.arange(self.n)
        few = self.dense[:: max(1, self.n // 4096)]
        lead = np.abs(self.dense @ np.linalg.eigh(few.T @ few)[1][:, -8:].astype(np.float32))
        most = lead[:, :-1].argmax(axis=1) if lead.shape[1] > 1 else np.zeros(self.n, np.int64)
        return np.lexsort((np.arange(self.n), lead[np.arange(self.n), most], most))

    def nearest(self, term: np.ndarray, weight: np.ndarray, k: int, skip: int) -> tuple[np.ndarray, np.ndarray]:
        """The k examples of largest cosine with a query (smaller number first among equals), and the cosines."""
        return self.nearest_of([(term, weight, skip)], k)[0]

    def nearest_of(self, queries: list[tuple[np.ndarray, np.ndarray, int]], k: int) -> list[tuple[np.ndarray, np.ndarray]]:
        """``nearest`` for several queries (term, weight, skip)."""
        if not self.n:
            return [(np.zeros(0, np.int64), np.zeros(0))] * len(queries)
        ask = np.zeros((len(queries), self.dense.shape[1]), np.float32)
        sums = np.zeros((len(queries), self.n), np.float32)
        for j, (term, weight, _) in enumerate(queries):
            column = self.column[term]
            common = column >= 0
            ask[j, column[common]] = weight[common]
            rare, factor = term[~common], weight[~common].astype(np.float32)
            if len(rare):
                a, b = self.post_at[rare], self.post_at[rare + 1]
                found = np.concatenate([self.post[p:q] for p, q in zip(a.tolist(), b.tolist())]).view(np.int32)
                sums[j] = np.bincount(found[0::2], found[1::2].view(np.float32) * np.repeat(factor, b - a), self.n)
        skips = np.array([self.place[skip] if skip >= 0 else -1 for *_, skip in queries])
        own = np.flatnonzero(skips >= 0)
        sums[own, skips[own]] = -np.inf
        # sums of the postings bound the k-th best from below; a block is left out if its largest weights cannot lift it there
        starts = np.arange(0, self.n, self.block)
        if ask.shape[1]:
            best = np.maximum.reduceat(sums, starts, axis=1)
            visit = (best + ask @ self.peak.T) * (1 + ERROR) >= self._bound(best, k)[:, None]
            for i in range(0, len(starts), TOGETHER):
                mine = np.flatnonzero(visit[:, i : i + TOGETHER].any(axis=1))
                part = slice(i * self.block, (i + TOGETHER) * self.block)
                if len(mine):
                    sums[mine, part] += ask[mine] @ self.dense[part].T
        # above zero: an example that shares no term is no neighbour
        least = np.maximum(self._bound(np.maximum.reduceat(sums, starts, axis=1), k) * (1 - ERROR), np.finfo(np.float32).tiny)
        # the place of a term in the query (from 1) in few bytes, then its weight
        spot, out = np.zeros(self.n_terms, np.min_scalar_type(max(len(term) for term, *_ in queries))), []
        for j, (term, weight, _) in enumerate(queries):
            near = np.flatnonzero(sums[j] >= least[j])
            if len(near) > k:
                near = near[sums[j, near] >= np.partition(sums[j, near], len(near) - k)[len(near) - k] * (1 - ERROR)]
            near, cosine = self.number[near], np.zeros(0)
            if len(near):
                spot[term] = np.arange(1, len(term) + 1)
                a, b = self.start[near], self.start[near + 1]
                spans = list(zip(a.tolist(), b.tolist()))
                product = np.concatenate([self.weight[p:q] for p, q in spans])
                product *= np.append(0.0, weight).take(spot.take(np.concatenate([self.term[p:q] for p, q in spans])))
                cosine = np.add.reduceat(product, np.cumsum(b - a) - (b - a))
                spot[term] = 0
            order = np.lexsort((near, -np.round(cosine, 9)))[:k]
            out.append((near[order], cosine[order]))
        return out

    def _bound(self, best: np.ndarray, k: int) -> np.ndarray:
        """No more than the k-th best sum: k blocks have a sum of at least the k-th best of the blocks' best."""
        m = best.shape[1]
        return np.maximum(np.partition(best, m - k, axis=1)[:, m - k], 0) if k <= m else np.zeros(len(best))


def vote_features(owner: np.ndarray, cosine: np.ndarray, label: np.ndarray, n: int, pull: tuple[float, float]) -> np.ndarray:
    """Per document (of n): log odds of two votes, best toxic and best clean cosine, toxic share of its neighbours."""
    out = []
    weight = np.where(label == 1, pull[1], pull[0])
    for power in (2, 4):
        w = cosine**power * weight
        vote = (np.bincount(owner, w * label, n) + SHRINK / 2) / (np.bincount(owner, w, n) + SHRINK)
        vote = np.clip(vote, 1e-4, 1 - 1e-4)
        out.append(np.log(vote / (1 - vote)))
    for y in (1, 0):
        best = np.zeros(n)
        np.maximum.at(best, owner, cosine * (label == y))
        out.append(best)
    out.append(np.bincount(owner, label, n) / np.maximum(np.bincount(owner, minlength=n), 1))
    return np.stack(out, axis=1)


def fit_logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1e-2) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Centers, scales and weights (first the constant) of a logistic model by Newton steps; labels may be fractions."""
    center, scale = x.mean(axis=0), x.std(axis=0) + 1e-9
    z = np.column_stack([np.ones(len(x)), (x - center) / scale])
    keep = ridge * np.eye(z.shape[1])
    w = np.zeros(z.shape[1])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -40, 40)))
        step = np.linalg.solve((z * (p * (1 - p))[:, None]).T @ z + keep, z.T @ (p - y) + keep @ w)
        w = w - step
        if np.abs(step).max() < 1e-10:
            break
    return center, scale, w


def probability(x: np.ndarray, model: tuple[np.ndarray, np.ndarray, np.ndarray]) -> np.ndarray:
    center, scale, w = model
    return 1 / (1 + np.exp(-np.clip(w[0] + ((x - center) / scale) @ w[1:], -40, 40)))


def score(docs: DataFrame, labels: DataFrame, fold: int = 1, folds: int = 3, examples: int = EXAMPLES, k: int = K, block: int = BLOCK,
          threshold: float = THRESHOLD, label: str = "toxic", id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: doc_id, held_out, score, predicted, neighbours (ids), cosines. Labels of fold ``fold`` are never used."""
    pairs = id_and_text(docs, id_col, text_col)
    train = labelled(labels, label).where(remainder("id", folds) != fold)
    chosen = first_by_hash(train, "id", examples, train.count())
    total = pairs.count()
    idf_of = lambda df: F.log((1 + total) / (1 + df)) + 1
    # bounded: at most ``examples`` rows of an id, a label and a text; they are moved only if an id repeats
    sample = pairs.join(F.broadcast(chosen), pairs["did"] == chosen["id"]).select("did", "y", "text")
    if not sample.groupBy("did").count().where("count > 1").isEmpty():
        sample = sample.dropDuplicates(["did"])
    sample = materialize(map_batches(sample, count_terms, "did long, y int, terms array<long>, tf array<int>"), "examples")
    rows = sample.toArrow().combine_chunks().sort_by("did").combine_chunks()
    words = rows["terms"].combine_chunks().flatten().to_numpy().view(np.uint64)
    vocabulary = np.unique(words)
    y = rows["y"].to_numpy().astype(float)
    size = rows["terms"].combine_chunks().value_lengths().to_numpy()
    base = float(y.mean()) if len(y) else 0.0
    bare = y[size == 0]
    alone = float((bare.sum() + base) / (len(bare) + 1))
    ids, votes = rows["did"].to_numpy()[size > 0], y[size > 0]
    context = docs.sparkSession.sparkContext
    known = context.broadcast((vocabulary, ids, votes))
    # words of examples by their place among them; those of no example are counted where they are found
    counts = map_batches(pairs.select("text"), lambda batch: count_documents(batch, known.value[0]), "place int, df long")
    counts = counts.groupBy("place").agg(F.sum("df").alias("df")).select("place", idf_of(F.col("df")).alias("idf")).toArrow()
    idf = counts["idf"].to_numpy()[np.argsort(counts["place"].to_numpy())]
    term = within(vocabulary, words)[0]
    vectors = pack(size[size > 0]), pack(np.diff(term, prepend=0)), pack(rows["tf"].combine_chunks().flatten().to_numpy())
    del rows, words, term
    # of each class half of all votes
    part = float(votes.mean()) if len(votes) else 0.5
    pull = 0.5 / max(1 - part, 1e-12), 0.5 / max(part, 1e-12)
    shared = context.broadcast((vectors, idf))
    token = uuid.uuid4().hex

    def index_of(vectors: tuple[bytes, bytes, bytes], idf: np.ndarray) -> Index:
        """Built once a worker; the one before is dropped."""
        held = arrays.worker_cache()
        if held.get("toxicity", (None,))[0] != token:
            held.pop("toxicity", None)
            size = unpack(vectors[0])
            owner, term = np.repeat(np.arange(len(size), dtype=np.int32), size), np.cumsum(unpack(vectors[1]), dtype=np.int32)
            weight = np.log(unpack(vectors[2]))
            weight += 1
            weight *= idf[term]
            for a, b in zip((np.cumsum(size) - size).tolist(), np.cumsum(size).tolist()):
                weight[a:b] /= np.linalg.norm(weight[a:b])
            held["toxicity"] = token, Index(owner, term, weight, len(size), len(idf), block)
            del owner, term, weight
            arrays.release()
        return held["toxicity"][1]

    def vote(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        (vectors, idf), (vocabulary, ids, _) = shared.value, known.value
        index = index_of(vectors, idf)
        for row, texts in arrays.batches(batch.column(1)):
            distinct, owner, place, tf = term_counts(texts)
            at, hit = within(vocabulary, distinct)
            at, hit, log_tf = at[place], hit[place], 1 + np.log(tf)
            weight = np.where(hit, log_tf * idf[at], 0) if len(idf) else np.zeros(len(tf))
            length = np.bincount(owner, weight * weight, len(texts))
            dids = np.asarray(batch.column(0).slice(row, len(texts)))
            own, is_own = within(ids, dids)
            skips = np.where(is_own & (dids != NO_ID), own, -1).tolist()
            starts = np.searchsorted(owner, np.arange(len(texts) + 1))
            queries = []
            for i, (a, b) in enumerate(zip(starts[:-1].tolist(), starts[1:].tolist())):
                mine = np.flatnonzero(hit[a:b]) + a
                queries.append((at[mine], weight[mine] / max(length[i], 1e-300) ** 0.5, skips[i]))
            found = [x for i in range(0, len(queries), QUERIES) for x in index.nearest_of(queries[i : i + QUERIES], k)]
            near = pa.array(np.append(0, np.cumsum([len(e) for e, _ in found])), pa.int32())
            strange = pa.array(np.append(0, np.cumsum(np.bincount(owner[~hit], minlength=len(texts)))), pa.int32())
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(dids), pa.array(np.diff(starts)), pa.array(length),
                    pa.ListArray.from_arrays(near, pa.array(np.concatenate([e for e, _ in found]).astype(np.int32))),
                    pa.ListArray.from_arrays(near, pa.array(np.concatenate([c for _, c in found]))),
                    pa.ListArray.from_arrays(strange, pa.array(distinct[place[~hit]].view(np.int64))),
                    pa.ListArray.from_arrays(strange, pa.array(log_tf[~hit])),
                ],
                ["did", "n", "length", "places", "cosines", "strange", "log_tf"],
            )

    # neighbours by their place among the examples, which leads to id and label
    schema = "did long, n long, length double, places array<int>, cosines array<double>, strange array<long>, log_tf array<double>"
    found = materialize(map_batches(pairs, vote, schema).withColumn("row", F.monotonically_increasing_id()), "votes")
    # words that no example holds: each document that holds one has a row of it here, so the rows tell their frequencies;
    # only words of two or more documents need be joined
    strange = found.select("row", F.explode(F.arrays_zip("strange", "log_tf")).alias("s")).select("row", F.col("s.strange").alias("term"), F.col("s.log_tf").alias("log_tf"))
    shared_by = strange.groupBy("term").agg(F.count("*").alias("df")).where("df > 1").select("term", idf_of(F.col("df")).alias("idf"))
    shared_by = materialize(shared_by, "terms")
    # sorted, so that the sum does not depend on the order of arrival
    weight = F.col("log_tf") * F.coalesce("idf", idf_of(F.lit(1).cast("long")))
    more = strange.join(shared_by, "term", "left").groupBy("row").agg(F.array_sort(F.collect_list(F.pow(weight, 2))).alias("squares"))
    more = more.select("row", F.aggregate("squares", F.lit(0.0), lambda a, x: a + x).alias("more"))
    share = F.when(F.col("length") > 0, F.col("length") / (F.col("length") + F.coalesce("more", F.lit(0.0)))).otherwise(0.0)
    done = materialize(
        found.drop("strange", "log_tf").join(more, "row", "left").select(
            "did", "n", "places", F.transform("cosines", lambda c: c * F.sqrt(share)).alias("cosines")), "cosines"
    )

    def features(batch: pa.RecordBatch) -> np.ndarray:
        """Of the last two columns: places and cosines of the neighbours."""
        size = batch.column(batch.num_columns - 1).value_lengths().to_numpy(zero_copy_only=False)
        place, cosine = (batch.column(batch.num_columns - k).flatten().to_numpy(zero_copy_only=False) for k in (2, 1))
        return vote_features(np.repeat(np.arange(len(size)), size), cosine, known.value[2][place], len(size), pull)

    def of_examples(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(features(batch).tolist(), pa.list_(pa.float64()))], ["did", "y", "x"])

    mine = done.join(F.broadcast(sample.select("did", "y")), "did").where("size(places) > 0").select("did", F.col("y").cast("double"), "places", "cosines")
    # bounded: at most ``examples`` rows of an id, a label and five numbers
    fit = map_batches(mine, of_examples, "did long, y double, x array<double>").toArrow().combine_chunks().sort_by("did").combine_chunks()
    targets = fit["y"].to_numpy()
    model = fit_logistic(np.array(fit["x"].to_pylist()), targets) if len(targets) and 0 < targets.mean() < 1 else None

    def judge(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        n, size = (np.asarray(batch.column(1)), batch.column(2).value_lengths().to_numpy(zero_copy_only=False))
        p = probability(features(batch), model) if model else np.full(len(n), base)
        p = np.where(n == 0, alone, np.where(size == 0, base, p))
        near = pa.array(np.append(0, np.cumsum(size)), pa.int32())
        neighbours = pa.ListArray.from_arrays(near, pa.array(known.value[1][batch.column(2).flatten().to_numpy(zero_copy_only=False)]))
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(p), neighbours, batch.column(3)], ["did", "score", "neighbours", "cosines"])

    scored = map_batches(done, judge, "did long, score double, neighbours array<long>, cosines array<double>").withColumn("doc_id", real_id())
    return scored.select(
        "doc_id", (remainder("doc_id", folds) == fold).alias("held_out"), "score", F.when(F.col("score") >= threshold, 1).otherwise(0).alias("predicted"),
        "neighbours", "cosines",
    )
