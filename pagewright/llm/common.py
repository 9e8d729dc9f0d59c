"""What the operators share: scratch tables, word spans over Arrow text, hashes of word runs.

The numpy helpers work on one Arrow batch inside a task. They see the UTF-8 bytes of whole
texts; a word never crosses from one text into the next.
"""

from __future__ import annotations

import contextlib
import contextvars
import functools
import os
import tempfile
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Rows of an Arrow batch: a batch holds whole texts, so its rows bound a worker's memory.
BATCH_ROWS = 512
# Bytes of text hashed in one go; a longer text is taken alone.
SLICE_BYTES = 1 << 19

U = np.uint64
_P = 0x9E3779B97F4A7C15
_P_INV = pow(_P, -1, 1 << 64)


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir; where it is unset and all run on one machine, as in tests, one of our own."""
    held = spark.sparkContext.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if not held:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir is not set: it must name a folder that driver and executors share")
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="pagewright-"))
        held = spark.sparkContext.getCheckpointDir()
    return held.rstrip("/")


#: Of each open block of `scratch`, the innermost last: the tables written in it.
_written: contextvars.ContextVar[tuple[list[str], ...]] = contextvars.ContextVar("written", default=())


@contextlib.contextmanager
def scratch(spark: SparkSession):
    """Tables that are written inside the block are deleted at its end; those written with keep=True last as long as the block around it."""
    paths: list[str] = []
    before = _written.set((*_written.get(), paths))
    try:
        yield
    finally:
        _written.reset(before)
        for path in paths:
            at = spark._jvm.org.apache.hadoop.fs.Path(path)
            at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)


def materialise(df: DataFrame, name: str = "t", keep: bool = False) -> DataFrame:
    """Write df as Parquet in the shared folder and read it back: lineage ends here, and a lost executor loses nothing."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    around = _written.get()[:-1] if keep else _written.get()
    if around:
        around[-1].append(path)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def small_batches(spark: SparkSession) -> None:
    """Keep Arrow batches of whole texts small."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))


def text_or_empty(df: DataFrame, column: str = "text"):
    return F.coalesce(df[column].cast("string"), F.lit(""))


#: Columns of documents that operators read by name.
KNOWN = ("doc_id", "text", "lang", "source", "n_chars")


def keeping_columns(operator):
    """For operators from documents to documents: other columns go under names of their own meanwhile, so none can clash."""

    @functools.wraps(operator)
    def run(documents: DataFrame, *args, **named) -> DataFrame:
        names = documents.columns
        inner = documents.toDF(*[c if c in KNOWN else f"extra_column_{k}" for k, c in enumerate(names)])
        return operator(inner, *args, **named).toDF(*names)

    return run


def byte_class(separators: bytes) -> np.ndarray:
    """A table of 256 booleans: True where a byte belongs to a word."""
    table = np.ones(256, dtype=bool)
    table[list(separators)] = False
    return table


# [^\x20\x09-\x0D]+
SPACED = byte_class(bytes([0x20, *range(0x09, 0x0E)]))
# [^\x00-\x2F\x3A-\x60\x7B-\x7F]+ of text whose A-Z are lower-cased
ALNUM = byte_class(bytes([*range(0x00, 0x30), *range(0x3A, 0x61), *range(0x7B, 0x80)]))
LOWER = np.arange(256, dtype=np.uint8)
LOWER[ord("A") : ord("Z") + 1] += 32


def mix(h: np.ndarray) -> np.ndarray:
    """A bijective finaliser on unsigned 64-bit values."""
    h = h ^ (h >> U(30))
    h = h * U(0xBF58476D1CE4E5B9)
    h = h ^ (h >> U(27))
    h = h * U(0x94D049BB133111EB)
    return h ^ (h >> U(31))


_powers: tuple[np.ndarray, np.ndarray] = (np.ones(1, U), np.ones(1, U))


def powers_to(n: int) -> tuple[np.ndarray, np.ndarray]:
    global _powers
    if len(_powers[0]) < n:
        size = max(n, SLICE_BYTES + 1)
        up, down = np.full(size, U(_P)), np.full(size, U(_P_INV))
        up[0] = down[0] = 1
        _powers = np.multiply.accumulate(up), np.multiply.accumulate(down)
    return _powers


class Words:
    """The words of a few texts: first and last+1 byte, text number and hash of each, in order."""

    __slots__ = ("data", "doc", "ends", "first", "hashes", "n_docs", "offsets", "starts")

    def __init__(self, data: np.ndarray, offsets: np.ndarray, table: np.ndarray, first: int):
        self.data, self.offsets, self.first, self.n_docs = data, offsets, first, len(offsets) - 1
        if not len(data):
            self.starts = self.ends = self.doc = np.empty(0, np.int64)
            self.hashes = np.empty(0, U)
            return
        word = table[data]
        before, after = np.empty_like(word), np.empty_like(word)
        before[0], before[1:] = False, word[:-1]
        after[-1], after[:-1] = False, word[1:]
        before[offsets[:-1][offsets[:-1] < len(data)]] = False
        after[offsets[1:][offsets[1:] > 0] - 1] = False
        self.starts = np.flatnonzero(word & ~before)
        self.ends = np.flatnonzero(word & ~after) + 1
        self.doc = np.searchsorted(offsets, self.starts, "right") - 1
        up, down = powers_to(len(data) + 1)
        sums = np.empty(len(data) + 1, U)
        sums[0] = 0
        np.cumsum((data.astype(U) + U(1)) * up[: len(data)], out=sums[1:])
        length = (self.ends - self.starts).astype(U)
        self.hashes = mix((sums[self.ends] - sums[self.starts]) * down[self.starts] + length)

    def bounds(self) -> np.ndarray:
        """Where each text's words begin; one more entry at the end."""
        return np.searchsorted(self.doc, np.arange(self.n_docs + 1), "left")

    def text(self, k: int) -> bytes:
        return self.data[self.offsets[k] : self.offsets[k + 1]].tobytes()


def word_slices(column: pa.Array, table: np.ndarray, lower: bool = False, fold: np.ndarray | None = None) -> Iterator[Words]:
    """Words of an Arrow string column, a few whole texts at a time. A null text has none.

    lower: A-Z count as a-z. fold: what each byte counts as, instead.
    """
    fold = LOWER if lower else fold
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_string()).fill_null("")
    n = len(column)
    if not n:
        return
    _, offs, body = column.buffers()
    offsets = np.frombuffer(offs, np.int64, n + 1, column.offset * 8)
    body = np.frombuffer(body, np.uint8) if body is not None else np.empty(0, np.uint8)
    k = 0
    while k < n:
        end = max(k + 1, int(np.searchsorted(offsets, offsets[k] + SLICE_BYTES, "right")) - 1)
        data = body[offsets[k] : offsets[end]]
        yield Words(data if fold is None else fold[data], offsets[k : end + 1] - offsets[k], table, k)
        k = end


def run_hashes(hashes: np.ndarray, doc: np.ndarray, k: int, seed: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """Hash of each k consecutive words, and whether they lie in one text. Empty if there are fewer."""
    n = len(hashes) - k + 1
    if n <= 0:
        return np.empty(0, U), np.empty(0, bool)
    h = np.full(n, U((seed * 2 + 1) * 0x5851F42D4C957F2D & (2**64 - 1)))
    for j in range(k):
        h = h * U(0xD1342543DE82EF95 if seed == 0 else 0xAF251AF3B0F025B5) + hashes[j : j + n]
    return mix(h), doc[:n] == doc[k - 1 : k - 1 + n]


def minima(grams: np.ndarray, n: int, w: int) -> np.ndarray:
    """The place of the least (leftmost on ties) of w hashes from each of the first n places on."""
    low, at = grams[:n].copy(), np.zeros(n, np.int8)
    for j in range(1, w):
        x = grams[j : j + n]
        less = x < low
        np.copyto(low, x, where=less)
        at[less] = j
    return np.arange(n) + at


def winnow(grams: np.ndarray, doc: np.ndarray, k: int, w: int) -> np.ndarray:
    """Positions of the minimum (leftmost on ties) of each w consecutive k-gram hashes inside one text.

    Every run of w + k - 1 words inside one text holds a chosen k-gram, and equal runs choose
    the same ones: the choice depends on the run's words alone.
    """
    n = len(grams) - w + 1
    if n <= 0:
        return np.empty(0, np.int64)
    inside = doc[:n] == doc[w + k - 2 : w + k - 2 + n]
    chosen = minima(grams, n, w)[inside]
    return chosen[np.r_[True, chosen[1:] != chosen[:-1]]] if len(chosen) else chosen


def bitmap(df: DataFrame, column: str, bits: int) -> np.ndarray:
    """A filter of 2**bits bits with a bit set for each hash of the column.

    Its size is fixed by the parameter, whatever the number of rows: at most 2**bits / 64 words
    reach the driver. A full filter lets everything through and so costs time, never rows.
    """
    mask = (1 << bits) - 1
    at = F.col(column).bitwiseAND(F.lit(mask))
    words = (
        df.select(F.shiftright(at, 6).alias("w"), F.expr(f"shiftleft(1L, cast({column} & 63 as int))").alias("b"))
        .groupBy("w")
        .agg(F.bit_or("b").alias("b"))
        .toArrow()
    )
    out = np.zeros(1 << (bits - 6), np.int64)
    out[words["w"].to_numpy()] = words["b"].to_numpy()
    return out.view(U)


def in_bitmap(filter_: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    at = hashes & U(len(filter_) * 64 - 1)
    return (filter_[at >> U(6)] >> (at & U(63))) & U(1) == 1


def worker_broadcast(spark: SparkSession, value):
    return spark.sparkContext.broadcast(value)


def rows_inside(filter_, column: str, inside: bool = True):
    """For mapInArrow: the rows whose value in a long column passes the filter, or those where it doesn't."""

    def mapped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = batch[column].to_numpy(zero_copy_only=False).astype(np.int64, copy=False)
            found = batch.filter(pa.array(in_bitmap(filter_.value, keys.view(U)) == inside))
            if len(found):
                yield found

    return mapped


#: Bytes of records that a task deals out, or takes in, at once.
HELD = 1 << 24


def parts_of(hashes: np.ndarray, parts: int) -> np.ndarray:
    """The part of each hash, in order of the hashes."""
    return ((hashes >> U(32)) * U(parts) >> U(32)).astype(np.int32)


def dealt_rows(rows: np.ndarray, part: np.ndarray) -> pa.RecordBatch:
    """Records in order of their part, as one binary value a part."""
    firsts = np.flatnonzero(np.r_[True, part[1:] != part[:-1]]) if len(part) else np.empty(0, np.int64)
    ends = (np.r_[firsts, len(rows)] * rows.dtype.itemsize).astype(np.int32)
    held = pa.Array.from_buffers(pa.binary(), len(firsts), [None, pa.py_buffer(ends), pa.py_buffer(np.ascontiguousarray(rows))])
    return pa.RecordBatch.from_arrays([pa.array(part[firsts]), held], ["part", "rows"])


def shares(pieces: Iterator[np.ndarray]) -> Iterator[np.ndarray]:
    """Arrays of records put together to about HELD bytes."""
    held, size = [], 0
    for piece in pieces:
        held.append(piece)
        size += piece.nbytes
        if size >= HELD:
            yield np.concatenate(held)
            held, size = [], 0
    if size:
        yield np.concatenate(held)


def taken_rows(batches: Iterator[pa.RecordBatch], kind: np.dtype) -> Iterator[np.ndarray]:
    """The records that dealt_rows gave."""
    for batch in batches:
        for value in batch["rows"]:
            yield np.frombuffer(value.as_buffer(), kind)


def dealt(df: DataFrame, deal, take, schema: str) -> DataFrame:
    """Rows by way of records: deal(parts) makes a mapInArrow function that gives part and rows (as dealt_rows does), take one over all that a part has."""
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return df.mapInArrow(deal(parts), "part int, rows binary").repartitionById(parts, F.col("part")).mapInArrow(take, schema)


TEXTS = "doc_id long, text_key long, text string"
#: Bits of the filters of text keys and document ids.
KEY_BITS = 24


def keyed_texts(documents: DataFrame) -> DataFrame:
    """doc_id, text_key, text of each row; a null text is empty."""
    text = text_or_empty(documents)
    return documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(text).alias("text_key"), text.alias("text"))


class EqualTexts:
    """Equal texts of documents with an id, found by two 64-bit hashes; each group's smallest id speaks for it.

    `keys`: doc_id, text_key, key2 of each row. `groups`: text_key, key2, low of texts that two ids or
    more share. `scan` runs a function over every different text once: texts outside a filter of fixed
    size are read where they lie, the others come from `firsts`, a table of the groups' first rows.
    """

    def __init__(self, documents: DataFrame):
        spark = documents.sparkSession
        self.docs = keyed_texts(documents.where(F.col("doc_id").isNotNull()))
        second = F.xxhash64(F.lit("second"), "text").alias("key2")
        self.keys = self.docs.select("doc_id", "text_key", second)
        lows = self.keys.groupBy("text_key", "key2").agg(F.min("doc_id").alias("low"), F.max("doc_id").alias("high"))
        self.groups = materialise(lows.where("low < high").drop("high"), "equal-texts")
        self.shared = worker_broadcast(spark, bitmap(self.groups, "text_key", KEY_BITS))
        maybe = self.docs.mapInArrow(rows_inside(self.shared, "text_key"), TEXTS).withColumn("key2", second)
        first = maybe.join(self.groups, ["text_key", "key2"], "left").where(F.coalesce(F.col("doc_id") == F.col("low"), F.lit(True)))
        self.firsts = materialise(first.select("doc_id", "text_key", "text"), "first-texts")

    def scan(self, function, schema: str) -> DataFrame:
        """function(skip) makes a mapInArrow function over doc_id, text_key, text that leaves out rows inside skip."""
        return self.docs.mapInArrow(function(self.shared), schema).unionAll(self.firsts.mapInArrow(function(None), schema))


def counted_rows(batch: pa.RecordBatch, skip) -> pa.RecordBatch:
    """The rows of a batch that lie outside the filter."""
    if skip is None:
        return batch
    return batch.filter(pa.array(~in_bitmap(skip.value, batch["text_key"].to_numpy().view(U))))


os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
