"""Substring dedup: seed and extend over winnowed anchors.

Seeds: each text keeps the minimum k-gram hash of every sliding window (its anchors); anchors that stand in two
documents or more are seeds. Any run of `length` words that two documents share holds a seed.
Join: each occurrence of a seed meets the occurrence in the smallest document that has it, and the match is extended both
ways: as far as windows of `length` words around the seed are equal. What an occurrence has beyond that, other documents
with the seed may share; there windows are grouped by content, with the smallest document of each. Matched windows of a
document chain into maximal repeats, whose words are removed.

So a passage that a third of all documents share costs a row for each seed in it and document, a map-side minimum, and a join
that Spark can split where it is hot; no two of its documents are paired with each other.

Equal texts are settled as wholes before that: copies of a smaller document lose all their words.

Windows are told apart by 128 bits of hash, the seed's and their own. Seeds, and the keys of copied or shortened texts, reach
later passes as filters of fixed size; where one fills up, more rows move and the result stays the same.

Defined cases: null or wordless text has no words; texts under `length` words lose nothing; rows
with equal doc_id never remove each other's words; a null doc_id neither removes nor loses any;
repeated rows get the same result each; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import (
    SPACED,
    U,
    bitmap,
    in_bitmap,
    materialise,
    minima,
    mix,
    run_hashes,
    small_batches,
    text_or_empty,
    winnow,
    word_slices,
    worker_broadcast,
)

LENGTH = 13
#: Words of an anchor: short enough for few anchors, long enough that texts seldom share one by chance.
K = 7
FILTER_BITS = 26
#: Bits of the filters of text keys.
COPY_BITS = 24
SEEDED = "anchor long, doc_id long, key32 int, windows array<long>"


def _parts(batch: pa.RecordBatch, skip) -> Iterator[tuple]:
    """Words of the batch's texts with a mask of the texts that count here: those outside the filter."""
    keys = batch["text_key"].to_numpy()
    ids = batch["doc_id"].to_numpy(zero_copy_only=False)
    out = np.ones(len(keys), bool) if skip is None else ~in_bitmap(skip.value, keys.view(U))
    for words in word_slices(pc.if_else(pa.array(out), batch["text"], ""), SPACED):
        yield words, ids, keys


def _anchors(skip, k: int, w: int):
    def mapped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for words, ids, _ in _parts(batch, skip):
                grams, _ = run_hashes(words.hashes, words.doc, k)
                at = winnow(grams, words.doc, k, w)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(grams[at].view(np.int64)), pa.array(ids[words.first + words.doc[at]], pa.int64())],
                    ["anchor", "doc_id"],
                )

    return mapped


def _seeded(filter_, skip, length: int, k: int, w: int):
    """A row for each seed of a text: the windows of `length` words whose own minimum k-gram it is, in order."""

    def mapped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = filter_.value
        for batch in batches:
            for words, ids, keys in _parts(batch, skip):
                whole, inside = run_hashes(words.hashes, words.doc, length)
                if not len(whole):
                    continue
                grams, _ = run_hashes(words.hashes, words.doc, k)
                seed = minima(grams, len(whole), w)
                starts = np.flatnonzero(inside & in_bitmap(bits, grams[seed]))
                if not len(starts):
                    continue
                # windows of one seed stand in a row; a text that repeats such a row has it once here
                first = np.flatnonzero(np.r_[True, seed[starts[1:]] != seed[starts[:-1]]])
                sizes = np.diff(np.r_[first, len(starts)])
                row = mix(np.add.reduceat(whole[starts], first) + sizes.astype(U))
                _, once = np.unique(mix(row + words.doc[starts[first]].astype(U)), return_index=True)
                ends = np.r_[0, np.cumsum(sizes[once])]
                values = starts[np.arange(ends[-1]) + np.repeat(first[once] - ends[:-1], sizes[once])]
                at = starts[first[once]]
                doc = words.first + words.doc[at]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(grams[seed[at]].view(np.int64)),
                        pa.array(ids[doc], pa.int64()),
                        pa.array(keys[doc].astype(np.int32)),
                        pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), pa.array(whole[values].view(np.int64))),
                    ],
                    ["anchor", "doc_id", "key32", "windows"],
                )

    return mapped


def _inside(filter_):
    """The rows whose text key passes the filter."""

    def mapped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = batch.filter(pa.array(in_bitmap(filter_.value, batch["text_key"].to_numpy().view(U))))
            if len(found):
                yield found

    return mapped


def covered(positions: np.ndarray, n: int, length: int) -> np.ndarray:
    """Which of n words lie in a window of `length` words that starts at one of the positions."""
    edge = np.zeros(n + 1, np.int32)
    np.add.at(edge, positions, 1)
    np.add.at(edge, np.minimum(positions + length, n), -1)
    return np.cumsum(edge[:n]) > 0


def _kept(length: int, skip=None):
    def mapped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if skip is not None:
                batch = batch.filter(pa.array(~in_bitmap(skip.value, batch["text_key"].to_numpy().view(U))))
            n_words, n_removed, texts, spans = [], [], [], []
            windows = batch["windows"] if skip is None else None
            copies = batch["copy"].to_pylist() if skip is None else None
            for words in word_slices(batch["text"], SPACED):
                b = words.bounds()
                counts = np.diff(b).tolist()
                for i in range(words.n_docs):
                    # bytes.split() cuts at the same six characters as the words' pattern
                    parts, repeats_ = words.text(i).split(), []
                    if skip is None:
                        if copies[words.first + i] and counts[i] >= length:
                            parts, repeats_ = [], [(0, counts[i])]
                        elif (gone := windows[words.first + i]).is_valid and len(gone):
                            first = int(b[i])
                            whole, _ = run_hashes(words.hashes[first : first + counts[i]], words.doc[first : first + counts[i]], length)
                            at = np.flatnonzero(np.isin(whole, gone.values.to_numpy().view(U)))
                            out = covered(at, counts[i], length)
                            edges = np.flatnonzero(np.diff(np.r_[False, out, False].astype(np.int8)))
                            repeats_ = list(zip(edges[::2].tolist(), edges[1::2].tolist(), strict=True))
                            parts = [p for p, x in zip(parts, out.tolist(), strict=True) if not x]
                    n_words.append(counts[i])
                    n_removed.append(counts[i] - len(parts))
                    texts.append(b" ".join(parts))
                    spans.append([{"start": a, "stop": z} for a, z in repeats_])
            yield pa.RecordBatch.from_arrays(
                [
                    batch["doc_id"],
                    pa.array(n_words, pa.int64()),
                    pa.array(n_removed, pa.int64()),
                    pa.array([hashlib.sha256(t).hexdigest() for t in texts], pa.string()),
                    pa.array([t.decode("utf-8", "surrogatepass") for t in texts], pa.string()),
                    pa.array(spans, pa.list_(pa.struct([("start", pa.int32()), ("stop", pa.int32())]))),
                ],
                ["doc_id", "n_words", "n_removed", "kept_sha256", "kept_text", "repeats"],
            )

    return mapped


KEPT = "doc_id long, n_words long, n_removed long, kept_sha256 string, kept_text string, repeats array<struct<start int, stop int>>"
TEXTS = "doc_id long, text_key long, text string"


def keyed_texts(documents: DataFrame) -> DataFrame:
    text = text_or_empty(documents)
    return documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(text).alias("text_key"), text.alias("text"))


def repeats(documents: DataFrame, length: int = LENGTH, k: int = K, filter_bits: int = FILTER_BITS) -> DataFrame:
    """(doc_id, text_key, windows, copy): hashes of windows that also start in a smaller document; copy: the whole text does.

    Equal texts are settled as wholes: only the smallest document of each group is looked into.
    """
    spark = documents.sparkSession
    small_batches(spark)
    w = length - k + 1
    docs = keyed_texts(documents.where(F.col("doc_id").isNotNull()))
    keys = docs.select("doc_id", "text_key", F.xxhash64(F.lit("second"), "text").alias("key2"))
    groups = keys.groupBy("text_key", "key2").agg(F.min("doc_id").alias("low"), F.max("doc_id").alias("high")).where("low < high").drop("high")
    groups = materialise(groups, "equal-texts")
    maybe = worker_broadcast(spark, bitmap(groups, "text_key", COPY_BITS))
    grouped = docs.mapInArrow(_inside(maybe), TEXTS).withColumn("key2", F.xxhash64(F.lit("second"), "text"))
    firsts = grouped.join(groups, ["text_key", "key2"], "left").where(F.coalesce(F.col("doc_id") == F.col("low"), F.lit(True)))
    firsts = materialise(firsts.select("doc_id", "text_key", "text"), "first-texts")

    def scanned(function, schema: str) -> DataFrame:
        return docs.mapInArrow(function(maybe), schema).unionAll(firsts.mapInArrow(function(None), schema))

    seeds = (
        scanned(lambda skip: _anchors(skip, k, w), "anchor long, doc_id long")
        .groupBy("anchor")
        .agg(F.min("doc_id").alias("low"), F.max("doc_id").alias("high"))
        .where("low < high")
    )
    filter_ = worker_broadcast(spark, bitmap(seeds.select("anchor"), "anchor", filter_bits))
    found = materialise(scanned(lambda skip: _seeded(filter_, skip, length, k, w), SEEDED), "seeds")
    # written, so that the choice among occurrences in one document is made once, and a hot seed's join can be split
    lowest = found.groupBy("anchor").agg(F.min("doc_id").alias("low"), F.max("doc_id").alias("high"), F.min_by("windows", "doc_id").alias("_low"))
    lowest = materialise(lowest.where("low < high").drop("high"), "first-occurrences")
    matched = found.join(lowest, "anchor").select(
        "anchor",
        "doc_id",
        "key32",
        F.when(F.col("doc_id") > F.col("low"), F.array_intersect("windows", "_low")).alias("windows"),
        F.array_except("windows", "_low").alias("_rest"),
    )
    matched = materialise(matched, "matches")
    rest = matched.select("anchor", "doc_id", "key32", F.explode("_rest").alias("h"))
    shared = rest.groupBy("anchor", "h").agg(F.min("doc_id").alias("low"), F.max("doc_id").alias("high")).where("low < high").drop("high")
    later = rest.join(materialise(shared, "shared-windows"), ["anchor", "h"]).where(F.col("doc_id") > F.col("low"))
    every = matched.where(F.size("windows") > 0).select("doc_id", "key32", "windows").unionAll(later.select("doc_id", "key32", F.array("h").alias("windows")))
    cut = every.groupBy("doc_id", "key32").agg(F.array_distinct(F.flatten(F.collect_list("windows"))).alias("windows"))
    copies = keys.join(groups, ["text_key", "key2"]).where(F.col("doc_id") > F.col("low")).select("doc_id", "text_key").distinct()
    # the key's low half is enough to tell rows of one doc_id apart
    looked = docs.select("doc_id", "text_key", F.expr("cast(shiftright(shiftleft(text_key, 32), 32) as int)").alias("key32"))
    cut = cut.join(looked, ["doc_id", "key32"]).select("doc_id", "text_key", "windows", F.lit(False).alias("copy")).distinct()
    return cut.unionAll(copies.select("doc_id", "text_key", F.lit(None).cast("array<bigint>").alias("windows"), F.lit(True).alias("copy")))


def without_repeats(documents: DataFrame, length: int = LENGTH, k: int = K) -> DataFrame:
    """Per row of documents: doc_id, n_words, n_removed, kept_sha256, kept_text (words joined by one space), repeats (the
    maximal runs of words that were removed).

    Only texts that may lose words are shuffled; a filter of fixed size tells them apart.
    """
    found = materialise(repeats(documents, length, k), "repeats")
    docs = keyed_texts(documents)
    touched = worker_broadcast(documents.sparkSession, bitmap(found, "text_key", COPY_BITS))
    whole = docs.mapInArrow(_kept(length, touched), KEPT)
    joined = docs.mapInArrow(_inside(touched), TEXTS).join(found, ["doc_id", "text_key"], "left")
    return whole.unionAll(joined.select("doc_id", "text", "windows", "copy").mapInArrow(_kept(length), KEPT))


def dedup_substrings(documents: DataFrame) -> DataFrame:
    return without_repeats(documents).select("doc_id", "n_words", "n_removed", "kept_sha256")


def dedup_sql(length: int = LENGTH) -> str:
    """The same in DuckDB, window by window."""
    return rf"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
win AS (SELECT r, doc_id, p, array_to_string(w[p:p + {length - 1}], ' ') AS g FROM d, unnest(range(1, len(w) - {length - 2})) t(p)),
low AS (SELECT g, min(doc_id) AS low FROM win GROUP BY g),
gone AS (SELECT DISTINCT r, unnest(range(p, p + {length})) AS q FROM win JOIN low USING (g) WHERE doc_id > low),
word AS (SELECT r, q, w[q] AS x FROM d, unnest(range(1, len(w) + 1)) t(q)),
kept AS (SELECT r, count(*) AS n, string_agg(x, ' ' ORDER BY q) AS t FROM word ANTI JOIN gone USING (r, q) GROUP BY r)
SELECT doc_id, cast(len(w) AS BIGINT) AS n_words, len(w) - coalesce(n, 0) AS n_removed, sha256(coalesce(t, '')) AS kept_sha256
FROM d LEFT JOIN kept USING (r)"""
