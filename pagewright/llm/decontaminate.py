"""Benchmark decontamination by winnowing.

Both sides keep the minimum k-gram hash of every sliding window, fingerprints are joined, and each
hit is extended both ways to its whole run. k-gram length plus window is one more than the span
that must be found, so every shared span of `span` words holds a shared fingerprint. Items shorter
than that form one window of their own length; for each such length there is a finer winnowing.

Document fingerprints pass a filter of fixed size made from the benchmark's, so documents without a
hit move nothing; what passes is joined exactly.

Defined cases: a null or wordless text has no words, no hits; a wordless item never occurs; repeated
rows are separate rows with the same result; items with a null item_id count as one item, which has no
name in the digest; an empty benchmark leaves every document clean.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import (
    ALNUM,
    U,
    bitmap,
    in_bitmap,
    keeping_columns,
    keyed_texts,
    materialise,
    run_hashes,
    small_batches,
    text_or_empty,
    winnow,
    word_slices,
    worker_broadcast,
)

SPAN = 10
FILTER_BITS = 22


def scheme(span: int) -> tuple[int, int]:
    """(k, w) with k + w - 1 = span: half the span each."""
    k = (span + 1) // 2
    return k, span - k + 1


def _fingerprints(words, first: int, last: int, span: int) -> tuple[np.ndarray, np.ndarray]:
    """(hash, position) of one text's fingerprints for a span; positions count from its first word."""
    k, w = scheme(span)
    hashes, doc = words.hashes[first:last], words.doc[first:last]
    grams, inside = run_hashes(hashes, doc, k, span)
    at = winnow(grams, doc, k, w)
    return grams[at].view(np.int64), at


def _benchmark_side(span: int):
    def mapped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch["item_id"]
            for words in word_slices(batch["text"], ALNUM, lower=True):
                b = words.bounds()
                for i in range(words.n_docs):
                    n = int(b[i + 1] - b[i])
                    if not n:
                        continue
                    length = min(n, span)
                    h, at = _fingerprints(words, b[i], b[i + 1], length)
                    item = ids[words.first + i].as_py()
                    m = len(h)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([item] * m, pa.int64()), pa.array([length] * m, pa.int32()), pa.array(h), pa.array(at.astype(np.int32))],
                        ["item_id", "span", "fp", "item_pos"],
                    )

    return mapped


def _document_side(filter_, spans: list[int]):
    def mapped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        row = TaskContext.get().partitionId() << 33
        bits = filter_.value
        for batch in batches:
            ids, texts = batch["doc_id"], batch["text"]
            for words in word_slices(texts, ALNUM, lower=True):
                b = words.bounds()
                hits: list[list[dict]] = [[] for _ in range(words.n_docs)]
                for span in spans:
                    k, w = scheme(span)
                    grams, _ = run_hashes(words.hashes, words.doc, k, span)
                    at = winnow(grams, words.doc, k, w)
                    at = at[in_bitmap(bits, grams[at])]
                    for p in at.tolist():
                        d = int(words.doc[p])
                        hits[d].append({"fp": int(grams[p].astype(np.int64)), "span": span, "pos": int(p - b[d])})
                part = texts.slice(words.first, words.n_docs).to_pylist()
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.arange(row, row + words.n_docs)),
                        ids.slice(words.first, words.n_docs),
                        batch["text_key"].slice(words.first, words.n_docs),
                        pa.array(np.diff(b).astype(np.int64)),
                        pa.array(hits, pa.list_(pa.struct([("fp", pa.int64()), ("span", pa.int32()), ("pos", pa.int32())]))),
                        pa.array([t if h else None for t, h in zip(part, hits, strict=True)], pa.string()),
                    ],
                    ["row", "doc_id", "text_key", "n_words", "hits", "text"],
                )
                row += words.n_docs

    return mapped


def _word_list(text: str) -> np.ndarray:
    for words in word_slices(pa.array([text], pa.string()), ALNUM, lower=True):
        return words.hashes
    return np.empty(0, U)


def extend(doc: np.ndarray, item: np.ndarray, shifts: list[int], span: int) -> list[tuple[int, int]]:
    """Runs [start, end) of document words equal to the item's at one of the shifts, of `span` words or more."""
    found = []
    for shift in sorted(set(shifts)):
        low, high = max(0, shift), min(len(doc), shift + len(item))
        if high - low < span:
            continue
        same = np.r_[False, doc[low:high] == item[low - shift : high - shift], False]
        edges = np.flatnonzero(same[1:] != same[:-1])
        found += [(low + int(a), low + int(z)) for a, z in zip(edges[::2], edges[1::2], strict=True) if z - a >= span]
    return found


def _extended(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows, items, spans = [], [], []
        for r in batch.to_pylist():
            doc = _word_list(r["text"])
            for hit in r["items"]:
                item = _word_list(hit["item_text"])
                runs = extend(doc, item, hit["shifts"], min(SPAN, len(item)))
                if runs:
                    rows.append(r["row"])
                    items.append(hit["item_id"])
                    spans.append([{"start": a, "stop": z} for a, z in runs])
        yield pa.RecordBatch.from_arrays(
            [pa.array(rows, pa.int64()), pa.array(items, pa.int64()), pa.array(spans, pa.list_(pa.struct([("start", pa.int32()), ("stop", pa.int32())])))],
            ["row", "item_id", "spans"],
        )


def contamination(documents: DataFrame, benchmark: DataFrame) -> DataFrame:
    """Per row of documents: row, doc_id, text_key, n_words, spans (disjoint hit intervals of words), item_ids (sorted as strings), n_items."""
    spark = documents.sparkSession
    small_batches(spark)
    items = benchmark.select("item_id", text_or_empty(benchmark).alias("text")).distinct()
    prints = materialise(
        items.mapInArrow(_benchmark_side(SPAN), "item_id long, span int, fp long, item_pos int"), "benchmark-prints"
    )
    # at most SPAN different lengths
    spans = sorted(r["span"] for r in prints.select("span").distinct().collect())
    shared = worker_broadcast(spark, bitmap(prints, "fp", FILTER_BITS))
    docs = keyed_texts(documents)
    scanned = materialise(
        docs.mapInArrow(
            _document_side(shared, spans),
            "row long, doc_id long, text_key long, n_words long, hits array<struct<fp long, span int, pos int>>, text string",
        ),
        "document-prints",
    )
    hits = scanned.where(F.size("hits") > 0).select("row", F.inline("hits").alias("fp", "span", "pos"))
    pairs = (
        hits.join(prints, ["fp", "span"])
        .groupBy("row", "item_id")
        .agg(F.collect_set(F.col("pos") - F.col("item_pos")).alias("shifts"))
    )
    named = items.select(F.col("item_id").alias("_id"), F.col("text").alias("item_text"))
    with_items = pairs.join(named, pairs["item_id"].eqNullSafe(named["_id"])).drop("_id")
    # a text moves once, whatever the number of items that it hits
    per_text = with_items.groupBy("row").agg(F.collect_list(F.struct("item_id", "item_text", "shifts")).alias("items"))
    with_texts = scanned.where(F.col("text").isNotNull()).select("row", "text").join(per_text, "row")
    found = with_texts.select("row", "text", "items").mapInArrow(
        _extended, "row long, item_id long, spans array<struct<start int, stop int>>"
    )
    merged = F.aggregate(
        F.array_sort(F.flatten(F.collect_list("spans"))),
        F.expr("cast(array() as array<struct<start int, stop int>>)"),
        lambda done, x: F.when(
            (F.size(done) > 0) & (F.element_at(done, -1)["stop"] >= x["start"]),
            F.concat(
                F.slice(done, 1, F.size(done) - 1),
                F.array(
                    F.struct(
                        F.element_at(done, -1)["start"].alias("start"),
                        F.greatest(F.element_at(done, -1)["stop"], x["stop"]).alias("stop"),
                    )
                ),
            ),
        ).otherwise(F.concat(done, F.array(x))),
    )
    unnamed = F.max(F.col("item_id").isNull().cast("int"))
    per_row = found.groupBy("row").agg(
        merged.alias("spans"),
        F.sort_array(F.collect_set(F.col("item_id").cast("string"))).alias("item_ids"),
        (F.size(F.collect_set("item_id")) + unnamed).alias("n_items"),
    )
    return scanned.select("row", "doc_id", "text_key", "n_words").join(per_row, "row", "left")


def decontaminate(documents: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The digest per document: words hit, items found, verdict."""
    n_hit = F.aggregate("spans", F.lit(0).cast("long"), lambda n, x: n + (x["stop"] - x["start"]))
    found = contamination(documents, benchmark)
    return found.select(
        "doc_id",
        "n_words",
        F.coalesce(n_hit, F.lit(0)).cast("long").alias("n_hit"),
        F.coalesce("n_items", F.lit(0)).cast("long").alias("n_items"),
        F.sha2(F.coalesce(F.array_join("item_ids", ","), F.lit("")).cast("binary"), 256).alias("items_sha256"),
        F.coalesce(F.size("spans") > 0, F.lit(False)).alias("contaminated"),
    )



@keeping_columns
def cleaned(documents: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The documents that hold no benchmark span, with all their columns."""
    found = contamination(documents, benchmark).where(F.size("spans") > 0)
    hit = found.select(F.col("doc_id").alias("_id"), F.col("text_key").alias("_key")).distinct()
    keyed = documents.withColumn("_key0", F.xxhash64(text_or_empty(documents)))
    same = keyed["doc_id"].cast("long").eqNullSafe(hit["_id"]) & (keyed["_key0"] == hit["_key"])
    return keyed.join(hit.hint("shuffle_hash"), same, "left_anti").select(documents.columns)


def decontaminate_sql() -> str:
    """The same in DuckDB, window by window."""
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    pattern = r"'[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'"
    words = f"regexp_extract_all(translate(coalesce(text, ''), '{upper}', '{upper.lower()}'), {pattern})"
    return f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, {words} AS w FROM documents),
i AS (SELECT item_id, {words} AS w FROM benchmark),
iw AS (SELECT DISTINCT item_id, least({SPAN}, len(w)) AS m, array_to_string(w[p:p + least({SPAN}, len(w)) - 1], ' ') AS g
  FROM i, unnest(range(1, greatest(len(w) - {SPAN}, 0) + 2)) t(p) WHERE len(w) > 0),
ms AS (SELECT DISTINCT m FROM iw),
dw AS (SELECT r, p, m, array_to_string(w[p:p + m - 1], ' ') AS g FROM d, ms, unnest(range(1, len(w) - m + 2)) t(p) WHERE len(w) >= m),
hit AS (SELECT r, p, m, item_id FROM dw JOIN iw USING (m, g)),
per_word AS (SELECT r, count(DISTINCT q) AS n_hit FROM (SELECT r, unnest(range(p, p + m)) AS q FROM hit) GROUP BY r),
per_item AS (SELECT r, count(*) AS n_items, string_agg(s, ',' ORDER BY s) AS ids
  FROM (SELECT DISTINCT r, cast(item_id AS VARCHAR) AS s FROM hit) GROUP BY r)
SELECT doc_id, cast(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN per_word USING (r) LEFT JOIN per_item USING (r)"""
