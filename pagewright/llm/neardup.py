"""Near-duplicate documents by improved consistent weighted sampling over TF-IDF shingles.

A text is a weighted set of its 5-word shingles (A-Z lower-cased). A shingle weighs its count times
an inverse document frequency with a floor: shingles in under `FLOOR` of the different texts share
the top weight 1, the frequent ones (boilerplate) weigh less, down to `LEAST`. The frequent ones are
found exactly in two passes: a shingle that is frequent over all texts is frequent in some task, so
tasks report theirs, and the reported ones are counted over all texts. There are at most
(shingles per text) / FLOOR of them, whatever the number of texts; that table is broadcast.

Sampling gives each text consistent samples that agree for two texts with the probability of their
weighted Jaccard similarity. Samples are banded, texts of one bucket are paired as graph.linked says,
and pairs are verified by exact weighted Jaccard; components of the links are the classes.

Defined cases: equal texts are one class without sampling; a null text is empty; texts without words
are equal only to their like; a text of fewer than 5 words is one shingle; rows that repeat a doc_id
stay or go together; a null doc_id is its own class (null) and stays; an empty table gives an empty
result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import (
    KEY_BITS,
    SPACED,
    TEXTS,
    EqualTexts,
    U,
    Words,
    bitmap,
    counted_rows,
    in_bitmap,
    keeping_columns,
    materialise,
    mix,
    rows_inside,
    run_hashes,
    small_batches,
    word_slices,
    worker_broadcast,
)
from .graph import linked

SHINGLE = 5
SIMILARITY = 0.8
ROWS, BANDS = 5, 24
#: Share of the texts from which on a shingle counts as frequent, and the weight that one in all texts has.
FLOOR, LEAST = 0.01, 0.5
#: Shingles that a task counts at once.
CHUNK = 500_000
#: Entries of the table of random variates.
VARIATES = 1 << 16
SEED = 20240229
#: Bins of hashes whose weights bound what two texts have in common; a power of two.
BINS = 256
#: Weights in bins are whole numbers of this part, rounded up.
PART = 4096
BINNED = "node long, weight double, bins array<bigint>"


def shingles(words: Words) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, hash, count) of the different shingles of each text, in order of text and hash."""
    grams, inside = run_hashes(words.hashes, words.doc, SHINGLE)
    doc, h = words.doc[: len(grams)][inside], grams[inside]
    b = words.bounds()
    few = np.flatnonzero((np.diff(b) > 0) & (np.diff(b) < SHINGLE))
    if len(few):
        whole = np.array([int(mix(np.array([words.hashes[b[i] : b[i + 1]].sum(dtype=U)], U))[0]) if b[i + 1] - b[i] == 1 else _whole(words.hashes[b[i] : b[i + 1]]) for i in few], U)
        doc, h = np.r_[doc, few], np.r_[h, whole]
    order = np.lexsort((h, doc))
    doc, h = doc[order], h[order]
    if not len(h):
        return doc, h, np.empty(0, np.int64)
    new = np.flatnonzero(np.r_[True, (h[1:] != h[:-1]) | (doc[1:] != doc[:-1])])
    return doc[new], h[new], np.diff(np.r_[new, len(h)])


def _whole(hashes: np.ndarray) -> int:
    return int(run_hashes(hashes, np.zeros(len(hashes), np.int64), len(hashes), 3)[0][0])


class LocalCounts:
    """Counts of the shingles of a task's texts, each text's once, in bounded memory (lossy counting).

    A shingle that at most a `share` of the texts so far can have had may be dropped. `n` counts it since it was last
    taken up, and `before` is what it can have had by then.
    """

    def __init__(self, share: float, chunk: int = CHUNK):
        self.share, self.chunk = share, chunk
        self.h, self.n, self.before = np.empty(0, U), np.empty(0, np.int64), np.empty(0)
        self.held: list[np.ndarray] = []
        self.size = self.texts = 0
        self.dropped = 0.0

    def add(self, h: np.ndarray, texts: int) -> None:
        self.held.append(h)
        self.size += len(h)
        self.texts += texts
        if self.size >= self.chunk:
            self._merge()
            self.dropped = self.share * self.texts
            stay = self.n + self.before > self.dropped
            self.h, self.n, self.before = self.h[stay], self.n[stay], self.before[stay]

    def _merge(self) -> None:
        h, n = np.unique(np.concatenate([np.empty(0, U), *self.held]), return_counts=True)
        self.held, self.size = [], 0
        at = np.searchsorted(self.h, h)
        known = np.zeros(len(h), bool)
        known[at < len(self.h)] = self.h[at[at < len(self.h)]] == h[at < len(self.h)]
        self.n[at[known]] += n[known]
        new = ~known
        order = np.argsort(np.concatenate([self.h, h[new]]), kind="stable")
        self.h = np.concatenate([self.h, h[new]])[order]
        self.n = np.concatenate([self.n, n[new]])[order]
        self.before = np.concatenate([self.before, np.full(int(new.sum()), self.dropped)])[order]

    def over(self, floor: float) -> np.ndarray:
        """All shingles that more than `floor` of the texts have, and no other that under `floor - share` of them have."""
        self._merge()
        return self.h[self.n + self.before > floor * self.texts]


def _locally_frequent(floor: float):
    def function(skip):
        def mapped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            counts = LocalCounts(floor / 4)
            for batch in batches:
                for words in word_slices(counted_rows(batch, skip)["text"], SPACED, lower=True):
                    counts.add(shingles(words)[1], words.n_docs)
            yield pa.RecordBatch.from_arrays([pa.array(counts.over(floor).view(np.int64))], ["shingle"])

        return mapped

    return function


def _occurrences(filter_):
    def function(skip):
        def mapped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for words in word_slices(counted_rows(batch, skip)["text"], SPACED, lower=True):
                    _, h, _ = shingles(words)
                    yield pa.RecordBatch.from_arrays([pa.array(h[in_bitmap(filter_.value, h)].view(np.int64))], ["shingle"])

        return mapped

    return function


def frequent_weights(texts: EqualTexts, floor: float = FLOOR) -> tuple[np.ndarray, np.ndarray]:
    """Frequent shingles in order, and their weights."""
    spark = texts.docs.sparkSession
    n = texts.keys.select("text_key", "key2").distinct().count()
    reported = materialise(texts.scan(_locally_frequent(floor), "shingle long").distinct(), "reported")
    filter_ = worker_broadcast(spark, bitmap(reported, "shingle", KEY_BITS))
    found = (
        texts.scan(_occurrences(filter_), "shingle long")
        .groupBy("shingle")
        .agg(F.count(F.lit(1)).alias("n"))
        .where(F.col("n") > floor * n)
        .toArrow()
    )
    h = found["shingle"].to_numpy().view(U)
    share = found["n"].to_numpy() / max(n, 1)
    weight = LEAST + (1 - LEAST) * np.log(np.maximum(share, floor)) / np.log(floor)
    order = np.argsort(h)
    return h[order], np.minimum(weight[order], 1.0)


def weighted(h: np.ndarray, n: np.ndarray, table: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    w = n.astype(np.float64)
    if len(table[0]):
        at = np.minimum(np.searchsorted(table[0], h), len(table[0]) - 1)
        w *= np.where(table[0][at] == h, table[1][at], 1.0)
    return w


class Sampler:
    """Consistent weighted samples (Ioffe's scheme) with variates drawn from a table by hash of the shingle."""

    def __init__(self, samples: int):
        rng = np.random.default_rng(SEED)
        self.factors = rng.integers(0, 1 << 63, samples, dtype=np.int64).view(U) | U(1)
        self.r = rng.gamma(2.0, 1.0, VARIATES).astype(np.float32)
        self.beta = rng.random(VARIATES).astype(np.float32)
        log_c = np.log(rng.gamma(2.0, 1.0, VARIATES)).astype(np.float32)
        # ln a = ln c - r * (t - beta) - r with t = floor(ln w / r + beta): for weight 1 t is 0
        self.base = log_c + self.r * self.beta - self.r

    def samples(self, h: np.ndarray, weights: np.ndarray) -> np.ndarray:
        """The chosen (shingle, t) of each sample as one hash. h is in order, so ties go to the smallest."""
        best = np.full(len(self.factors), np.inf, np.float32)
        chosen = np.zeros(len(self.factors), U)
        rows = np.arange(len(self.factors))
        for k in range(0, len(h), 4096):
            part, log_w = h[k : k + 4096], np.log(weights[k : k + 4096]).astype(np.float32)
            at = ((self.factors[:, None] * part[None, :]) >> U(48)).astype(np.int32)
            value = self.base[at]
            other = np.flatnonzero(log_w)
            t = np.zeros((len(rows), len(other)), np.float32)
            if len(other):
                r = self.r[at[:, other]]
                t = np.floor(log_w[other] / r + self.beta[at[:, other]])
                value[:, other] -= r * t
            low = value.argmin(axis=1)
            v = value[rows, low]
            steps = np.zeros(len(rows), np.int64)
            if len(other):
                place = np.searchsorted(other, low)
                hit = (place < len(other)) & (other[np.minimum(place, len(other) - 1)] == low)
                steps[hit] = t[rows[hit], place[hit]].astype(np.int64)
            better = v < best
            best[better] = v[better]
            chosen[better] = mix(part[low] + steps.view(U) * U(0x9E3779B97F4A7C15))[better]
        return chosen


def _signatures(table, rows: int, bands: int):
    def function(skip):
        def mapped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            sampler = Sampler(rows * bands)
            scale = np.cumprod(np.full(rows, U(0xD1342543DE82EF95)))
            for batch in batches:
                batch = counted_rows(batch, skip)
                ids = batch["doc_id"].to_numpy(zero_copy_only=False)
                for words in word_slices(batch["text"], SPACED, lower=True):
                    doc, h, n = shingles(words)
                    w = weighted(h, n, table.value)
                    b = np.searchsorted(doc, np.arange(words.n_docs + 1))
                    nodes, keys = [], []
                    for i in np.flatnonzero(np.diff(b)):
                        s = sampler.samples(h[b[i] : b[i + 1]], w[b[i] : b[i + 1]])
                        keys.append(mix((s.reshape(bands, rows) * scale).sum(axis=1, dtype=U) + np.arange(bands, dtype=U)))
                        nodes.append(ids[words.first + i])
                    if nodes:
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(np.repeat(np.asarray(nodes, np.int64), bands)), pa.array(np.concatenate(keys).view(np.int64))],
                            ["node", "bucket"],
                        )

        return mapped

    return function


def weighted_jaccard(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> float:
    _, i, j = np.intersect1d(a[0], b[0], assume_unique=True, return_indices=True)
    both = np.minimum(a[1][i], b[1][j]).sum()
    return float(both / (a[1].sum() + b[1].sum() - both)) if len(a[0]) and len(b[0]) else 0.0


def _verified(table, similarity: float):
    def set_of(text: str):
        for words in word_slices(pa.array([text], pa.string()), SPACED, lower=True):
            _, h, n = shingles(words)
            return h, weighted(h, n, table.value)

    def mapped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, tuple] = {}
        for batch in batches:
            found = []
            for r in batch.to_pylist():
                if len(held) > 64:
                    held.clear()
                for x in ("a", "b"):
                    if r[x] not in held:
                        held[r[x]] = set_of(r[f"text_{x}"])
                s = weighted_jaccard(held[r["a"]], held[r["b"]])
                if s >= similarity - 1e-9:
                    found.append((r["a"], r["b"], s))
            columns = list(zip(*found, strict=True)) or [(), (), ()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(columns[0], pa.int64()), pa.array(columns[1], pa.int64()), pa.array(columns[2], pa.float64())], ["a", "b", "similarity"]
            )

    return mapped


def texts_of(nodes: DataFrame, texts: EqualTexts) -> DataFrame:
    """doc_id, text of the nodes; only what a filter of fixed size lets through is moved."""
    wanted = worker_broadcast(nodes.sparkSession, bitmap(nodes, "node", KEY_BITS))
    moved = texts.docs.mapInArrow(rows_inside(wanted, "doc_id"), TEXTS).select("doc_id", "text").dropDuplicates(["doc_id"])
    return materialise(moved.join(nodes, moved["doc_id"] == nodes["node"], "left_semi"), "node-texts")


def _binned(table):
    def mapped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch["doc_id"].to_numpy()
            for words in word_slices(batch["text"], SPACED, lower=True):
                doc, h, n = shingles(words)
                w = weighted(h, n, table.value)
                whole = np.bincount(doc, w, words.n_docs)
                bins = np.bincount(doc * BINS + (h >> U(64 - BINS.bit_length() + 1)).astype(np.int64), w, words.n_docs * BINS)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(ids[words.first : words.first + words.n_docs]),
                        pa.array(whole),
                        pa.array(list(np.ceil(bins * PART).astype(np.int64).reshape(-1, BINS)), pa.list_(pa.int64())),
                    ],
                    ["node", "weight", "bins"],
                )

    return mapped


def binned_weights(nodes: DataFrame, texts: EqualTexts, table) -> DataFrame:
    """(node, weight, bins): the weight of each text's shingles, as a whole and in bins of their hashes.

    In each bin two texts have at most the smaller weight in common, which bounds their similarity.
    """
    return texts_of(nodes, texts).mapInArrow(_binned(table), BINNED)


def _may_reach(x: dict, y: dict, similarity: float):
    """Whether two texts' measures allow the similarity: what they can have in common against all they have."""
    least = (x["weight"] + y["weight"]) * (similarity * (1 - 1e-9))
    common = F.aggregate(F.zip_with(x["bins"], y["bins"], lambda a, b: F.least(a, b)), F.lit(0).cast("bigint"), lambda n, c: n + c) / PART
    return common * (1 + similarity) >= least


def verified(pairs: DataFrame, texts: EqualTexts, table, similarity: float) -> DataFrame:
    """The pairs (a, b) whose texts are similar enough; only texts of documents in pairs are moved."""
    moved = texts_of(pairs.select(F.col("a").alias("node")).unionAll(pairs.select(F.col("b").alias("node"))).distinct(), texts)
    a = moved.select(F.col("doc_id").alias("a"), F.col("text").alias("text_a"))
    b = moved.select(F.col("doc_id").alias("b"), F.col("text").alias("text_b"))
    joined = pairs.join(a, "a").join(b, "b").select("a", "b", "text_a", "text_b")
    return joined.mapInArrow(_verified(table, similarity), "a long, b long, similarity double")


def near_duplicates(
    documents: DataFrame, similarity: float = SIMILARITY, rows: int = ROWS, bands: int = BANDS
) -> tuple[DataFrame, DataFrame]:
    """(classes, links): doc_id, class_id of each row; and the verified links (a, b, similarity) between different texts."""
    spark = documents.sparkSession
    small_batches(spark)
    texts = EqualTexts(documents)
    table = worker_broadcast(spark, frequent_weights(texts))
    buckets = materialise(texts.scan(_signatures(table, rows, bands), "node long, bucket long"), "buckets")
    links, roots = linked(
        buckets,
        lambda pairs: verified(pairs, texts, table, similarity),
        lambda nodes: binned_weights(nodes, texts, table),
        lambda x, y: _may_reach(x, y, similarity),
    )
    spoken = texts.keys.join(texts.groups, ["text_key", "key2"], "left").select("doc_id", F.coalesce("low", "doc_id").alias("node"))
    classes = spoken.join(roots, "node", "left").select("doc_id", F.coalesce("root", "node").alias("class_id"))
    unnamed = documents.where(F.col("doc_id").isNull()).select(F.col("doc_id").cast("long"), F.lit(None).cast("long").alias("class_id"))
    return classes.unionAll(unnamed), links


def dedup_report(documents: DataFrame) -> DataFrame:
    """doc_id, class_id (smallest doc_id of its class), kept."""
    classes, _ = near_duplicates(documents)
    return classes.select("doc_id", "class_id", F.coalesce(F.col("doc_id") == F.col("class_id"), F.lit(True)).alias("kept"))


@keeping_columns
def deduplicated(documents: DataFrame) -> DataFrame:
    """The documents that stay, with all their columns."""
    classes, _ = near_duplicates(documents)
    gone = classes.where("doc_id <> class_id").select(F.col("doc_id").alias("_id")).distinct()
    return documents.join(gone.hint("shuffle_hash"), documents["doc_id"] == gone["_id"], "left_anti")
