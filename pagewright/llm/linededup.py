"""Fuzzy line dedup over the whole corpus.

Lines are normalised (A-Z lower-cased, digits alike, white space aside) and told apart by hash, so an
equal line costs one row of a map-side minimum.

Candidates: each line draws min-wise samples of its words and of its runs of three words (short lines: of two), and lines that
agree in one of each, in one of `BANDS` bands, are paired as graph.linked says. A sample agrees with the Jaccard similarity of the two
sets as its probability. All weigh alike: a word that nobody else has, such as a misspelt one, takes over no more samples than another,
and no verdict hangs on the rest of the corpus; that lines seldom meet over words that everybody uses is due to the runs. Blocks of a
SimHash, the usual way, can't serve a threshold of 0.8: a fifth of the words changed turns a fifth of the bits, and blocks wide
enough to part millions of lines then miss nearly every pair.

Verification: a parity of the lines' words, of which an edit turns two bits at most, and their lengths drop pairs that
can't reach the threshold; the others are verified by edit similarity: one less the edits of words by the longer line's
words. Each connected group keeps its first occurrence by (doc_id, place in the text); the other occurrences are removed.

Keys are dealt out as records, a binary value a part, and meet in arrays: no key is a row before another line has it, and of a
bucket of up to `LARGE` lines only those stay whose parities and sizes allow the similarity to another one there.

Defined cases: lines under `MIN_WORDS` words stay, as a fifth of them is no whole word: equal ones too, since such a line
(a heading, a signature) says nothing of where it comes from; a null text is empty; rows with a null doc_id are left
alone; rows that repeat doc_id and text lose the same lines; equal lines of one text count as occurrences like others;
an empty table gives an empty result; columns of any other name are carried along.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import (
    HELD,
    KEY_BITS,
    LOWER,
    SPACED,
    U,
    Words,
    bitmap,
    dealt,
    dealt_rows,
    in_bitmap,
    keeping_columns,
    keyed_texts,
    materialise,
    mix,
    parts_of,
    powers_to,
    run_hashes,
    scratch,
    shares,
    small_batches,
    taken_rows,
    text_or_empty,
    word_slices,
    worker_broadcast,
)
from .graph import linked

MIN_WORDS = 5
SIMILARITY = 0.8
#: Bands. Of pairs with a tenth of the words replaced over 99 % share one, with a fifth 94 % or more.
BANDS = 12
#: Lines of fewer steps give runs of two words, others of three.
SHORT_STEPS = 6
#: A line of so many times the words of another stands a step higher in the scale of sizes.
SIZE_STEP = 1.6
SEED = 20240311
#: In buckets of more lines than this all stay; in others those that may be alike to another one.
LARGE = 64


FOLD = LOWER.copy()
FOLD[ord("1") : ord("9") + 1] = ord("0")


class Lines:
    """The lines with a word in a few texts: text, place, number of words and two hashes of each, in order.

    A line counts as the words in it: A-Z lower-cased, digits alike, white space aside.
    """

    def __init__(self, words: Words):
        self.words = words
        ends = np.cumsum(words.data == 10)
        at = ends[words.starts] if len(words.starts) else np.empty(0, np.int64)
        new = np.r_[True, (at[1:] != at[:-1]) | (words.doc[1:] != words.doc[:-1])] if len(at) else np.empty(0, bool)
        self.firsts = np.flatnonzero(new)
        self.doc = words.doc[self.firsts]
        begun = words.offsets[self.doc]
        self.place = at[self.firsts] - np.where(begun > 0, ends[begun - 1] if len(ends) else 0, 0)
        self.sizes = np.diff(np.r_[self.firsts, len(at)])
        self.h = self._hashes(words.hashes)
        self.h2 = self._hashes(mix(words.hashes ^ U(0xA5A5A5A55A5A5A5A)))

    def _hashes(self, hashes: np.ndarray) -> np.ndarray:
        up, down = powers_to(len(hashes) + 1)
        sums = np.zeros(len(hashes) + 1, U)
        np.cumsum(hashes * up[: len(hashes)], out=sums[1:])
        return mix((sums[self.firsts + self.sizes] - sums[self.firsts]) * down[self.firsts] + self.sizes.astype(U))

    def parities(self) -> np.ndarray:
        """256 bits a line, as four numbers: each bit the parity of the words whose hash names it."""
        bit = U(1) << (self.words.hashes >> U(58))
        part = (self.words.hashes >> U(56)) & U(3)
        return np.stack([np.bitwise_xor.reduceat(np.where(part == U(k), bit, U(0)), self.firsts) for k in range(4)], axis=1)

    def folds(self) -> np.ndarray:
        """The parities of a line in two numbers."""
        p = self.parities()
        return p[:, :2] ^ p[:, 2:]

    def bands(self, some: np.ndarray, sampler: Sampler) -> np.ndarray:
        """A key for each band of some lines, a row a line."""
        words = np.repeat(np.arange(len(self.firsts)), self.sizes)
        wanted = np.zeros(len(self.firsts), bool)
        wanted[some] = True
        firsts = np.cumsum(self.sizes[some]) - self.sizes[some]
        return sampler.bands(self.words.hashes[wanted[words]], firsts, self.sizes[some])


class Sampler:
    """Min-wise samples: of a line's hashes the one whose image under a random bijection is least.

    A band's key holds a sample of the words, one of the runs of words, and the line's size on a coarse logarithmic scale, which
    begins elsewhere in each band: lines of one size always agree there, lines of very unlike sizes never. The scale says too how
    long the runs are, so lines that agree in it have runs of one length.
    """

    def __init__(self, bands: int = BANDS):
        rng = np.random.default_rng(SEED)
        self.turned, factors = rng.integers(0, 1 << 63, (2, 2 * bands), dtype=np.int64).view(U)
        self.factors = (factors << U(1)) | U(1)
        self.number = np.arange(bands)

    def samples(self, hashes: np.ndarray, firsts: np.ndarray, which: slice = slice(None)) -> np.ndarray:
        """The images chosen (columns, a bijection each) of sets of hashes (rows); firsts: where each non-empty set begins."""
        drawn = list(zip(self.turned[which], self.factors[which], strict=True))
        chosen = np.empty((len(firsts), len(drawn)), U)
        for k, (turned, factor) in enumerate(drawn):
            chosen[:, k] = np.minimum.reduceat((hashes ^ turned) * factor, firsts)
        return chosen

    def of_runs(self, hashes: np.ndarray, firsts: np.ndarray, sizes: np.ndarray, n: int) -> np.ndarray:
        """Samples of the runs of n words of lines with n words or more."""
        runs, _ = run_hashes(hashes, np.zeros(len(hashes), np.int8), n)
        place = np.arange(len(runs)) - np.repeat(firsts, sizes)[: len(runs)]
        inside = place <= np.repeat(sizes, sizes)[: len(runs)] - n
        return self.samples(runs[inside], firsts - np.arange(len(firsts)) * (n - 1), slice(len(self.number), None))

    def bands(self, hashes: np.ndarray, firsts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """A key for each band of lines of three words or more."""
        if not len(firsts):
            return np.empty((0, len(self.number)), U)
        k = self.number
        scale = np.floor(np.log(sizes)[:, None] / np.log(SIZE_STEP) + k / len(k))
        keys = scale.astype(U) * U(0x9E3779B97F4A7C15) + k.astype(U)
        keys = keys * U(0xD1342543DE82EF95) + self.samples(hashes, firsts, slice(len(k)))
        runs = self.of_runs(hashes, firsts, sizes, 3)
        short = np.flatnonzero((scale < SHORT_STEPS).any(axis=1))
        if len(short):
            n = sizes[short]
            wanted = np.zeros(len(sizes), bool)
            wanted[short] = True
            pairs = self.of_runs(hashes[np.repeat(wanted, sizes)], np.cumsum(n) - n, n, 2)
            runs[short] = np.where(scale[short] < SHORT_STEPS, pairs, runs[short])
        return mix(mix(keys) + runs)


def line_slices(column: pa.Array) -> Iterator[Lines]:
    for words in word_slices(column, SPACED, fold=FOLD):
        yield Lines(words)


def _fingerprinted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ids, keys = batch["doc_id"].to_numpy(), batch["text_key"].to_numpy()
        for lines in line_slices(batch["text"]):
            some = np.flatnonzero(lines.sizes >= MIN_WORDS)
            if not len(some):
                continue
            doc = lines.words.first + lines.doc[some]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(ids[doc]),
                    pa.array(keys[doc]),
                    pa.array(lines.place[some].astype(np.int32)),
                    *[pa.array(x.view(np.int64)) for x in (lines.h[some], lines.h2[some])],
                ],
                ["doc_id", "text_key", "place", "h", "h2"],
            )


def _coded(filter_, holders):
    """The words of the lines inside the filter, four bytes for each, with their parities.

    Only texts inside `holders` are read; each such line has one there.
    """

    def mapped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            here = batch.filter(pa.array(in_bitmap(holders.value, batch["text_key"].to_numpy().view(U))))
            for lines in line_slices(here["text"]):
                some = np.flatnonzero(in_bitmap(filter_.value, lines.h) & (lines.sizes >= MIN_WORDS))
                if not len(some):
                    continue
                wanted = np.zeros(len(lines.sizes), bool)
                wanted[some] = True
                codes = (lines.words.hashes >> U(32)).astype("<u4")[np.repeat(wanted, lines.sizes)]
                ends = (np.r_[0, np.cumsum(lines.sizes[some])] * 4).astype(np.int32)
                texts = pa.Array.from_buffers(pa.binary(), len(some), [None, pa.py_buffer(ends), pa.py_buffer(codes)])
                parities = lines.parities()[some].view(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(lines.h[some].view(np.int64)), texts, *[pa.array(parities[:, k].copy()) for k in range(4)]],
                    ["h", "line", *PARITIES],
                )

    return mapped


PARITIES = ("p0", "p1", "p2", "p3")
#: Cells of the distance tables that are worked out together.
CELLS = 1 << 17


def _trimmed(x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two sequences without what they begin and end with alike."""
    short = min(len(x), len(y))
    differ = np.flatnonzero(x[:short] != y[:short])
    begin = int(differ[0]) if len(differ) else short
    x, y = x[begin:], y[begin:]
    short = min(len(x), len(y))
    differ = np.flatnonzero(x[len(x) - short :] != y[len(y) - short :])
    end = short - 1 - int(differ[-1]) if len(differ) else short
    return x[: len(x) - end], y[: len(y) - end]


def within(a: list[np.ndarray], b: list[np.ndarray], most: np.ndarray) -> np.ndarray:
    """Whether the edit distance of two sequences is at most so much, for each pair: many pairs' tables at once, a row after the other, inside a band."""
    found = np.array([len(x) == len(y) and np.count_nonzero(x != y) <= k for x, y, k in zip(a, b, most, strict=True)], bool)
    open_ = np.flatnonzero(~found)
    pairs = [_trimmed(a[i], b[i]) for i in open_]
    found[open_] = _within([x for x, _ in pairs], [y for _, y in pairs], most[open_])
    return found


def _within(a: list[np.ndarray], b: list[np.ndarray], most: np.ndarray) -> np.ndarray:
    sizes = np.array([(len(x), len(y)) for x, y in zip(a, b, strict=True)]).reshape(-1, 2)
    longest = sizes.max(axis=1, initial=0)
    band = np.minimum(most, longest)
    found = np.zeros(len(a), bool)
    # pairs whose size and band are alike on a scale of powers go together
    class_of = np.ceil(np.log2(longest + 1) * 2).astype(np.int64) * 64 + np.ceil(np.log2(band + 1) * 2).astype(np.int64)
    order = np.argsort(class_of, kind="stable")
    ends = np.flatnonzero(np.r_[class_of[order][1:] != class_of[order][:-1], True]) + 1 if len(order) else np.empty(0, np.int64)
    at = 0
    while at < len(order):
        end = int(ends[np.searchsorted(ends, at, "right")])
        width = int((longest + 2 * band)[order[at:end]].max()) + 1
        some = order[at : min(end, at + max(1, CELLS // width))]
        at += len(some)
        n, k = int(longest[some].max()), int(band[some].max())
        x, y = np.zeros((len(some), n), np.uint32), np.zeros((len(some), n + 2 * k), np.uint32)
        for row, i in enumerate(some):
            x[row, : len(a[i])] = a[i]
            y[row, k : k + len(b[i])] = b[i]
        # column d is place i + d - k of b; what lies before its begin is never reached
        place = np.arange(2 * k + 1, dtype=np.int32)
        never = np.int32(1 << 29)
        table = np.tile(np.where(place >= k, place - k, never), (len(some), 1))
        last = sizes[some, 0]
        column = np.clip(sizes[some, 1] - last + k, 0, 2 * k)
        near = np.abs(sizes[some, 1] - last) <= most[some]
        for i in range(int(last.max(initial=0)) + 1):
            if i:
                turned = table + (x[:, i - 1, None] != y[:, i - 1 : i + 2 * k])
                np.minimum(turned[:, :-1], table[:, 1:] + 1, out=turned[:, :-1])
                table = np.minimum.accumulate(turned - place, axis=1) + place
                if i % 16 == 0 and (table.min(axis=1) > most[some]).all():
                    break
            if len(ended := np.flatnonzero(near & (last == i))):
                found[some[ended]] = table[ended, column[ended]] <= most[some[ended]]
    return found


def _close(similarity: float):
    """Pairs (a, b) of lines whose edit similarity is high enough."""

    def codes(column: pa.Array) -> list[np.ndarray]:
        return [np.frombuffer(x.as_buffer(), "<u4") for x in column]

    def mapped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for batch in chain(batches, [None]):
            if batch is not None:
                held.append(batch)
            if held and (batch is None or sum(x.nbytes for x in held) > HELD):
                x, y = ([line for some in held for line in codes(some[c])] for c in ("line_a", "line_b"))
                longest = np.array([max(len(p), len(q)) for p, q in zip(x, y, strict=True)], np.int64)
                near = within(x, y, np.floor(longest * (1 - similarity) + 1e-9).astype(np.int64))
                pairs = pa.Table.from_batches(held).select(["a", "b"]).filter(pa.array(near))
                yield from pairs.to_batches()
                held = []

    return mapped


def _place_hash(h: np.ndarray, text_key: np.ndarray, place: np.ndarray) -> np.ndarray:
    return mix(h ^ mix(text_key + place.astype(U)))


def _firsts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        h, key = (batch[c].to_numpy().view(U) for c in ("h", "text_key"))
        yield pa.RecordBatch.from_arrays([pa.array(_place_hash(h, key, batch["place"].to_numpy()).view(np.int64))], ["at"])


#: A line's occurrences: the first one and their number.
SEEN = np.dtype([("h", "<u8"), ("h2", "<u8"), ("doc_id", "<i8"), ("place", "<i4"), ("text_key", "<i8"), ("n", "<i8")])


def _summed(seen: np.ndarray) -> np.ndarray:
    """A record for each different line, in order of h."""
    seen = seen[np.lexsort([seen[c] for c in ("text_key", "place", "doc_id", "h2", "h")])]
    new = np.r_[True, (seen["h"][1:] != seen["h"][:-1]) | (seen["h2"][1:] != seen["h2"][:-1])]
    firsts = np.flatnonzero(new)
    out = seen[firsts]
    out["n"] = np.add.reduceat(seen["n"], firsts)
    return out


def _seen(parts: int):
    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[np.ndarray]:
        for batch in batches:
            rows = np.ones(len(batch), SEEN)
            for c in ("h", "h2"):
                rows[c] = batch[c].to_numpy().view(U)
            for c in ("doc_id", "place", "text_key"):
                rows[c] = batch[c].to_numpy()
            yield rows

    def mapped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in shares(pieces(batches)):
            few = _summed(rows)
            yield dealt_rows(few, parts_of(few["h"], parts))

    return mapped


def _different(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held = [_summed(rows) for rows in shares(taken_rows(batches, SEEN))]
    if held:
        rows = _summed(np.concatenate(held))
        yield pa.RecordBatch.from_arrays([pa.array(np.ascontiguousarray(rows[c]).view(np.int64) if c != "place" else rows[c]) for c in SEEN.names], list(SEEN.names))


#: A key of a line; a size under 0 marks one of a bucket that is known to be large.
KEYED = np.dtype([("bucket", "<u8"), ("node", "<u8"), ("fold", "<u8", (2,)), ("size", "<i4")])


def _ranked(rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Records in order of bucket, each with its rank there, from 0; the same line in a bucket once."""
    order = np.argsort(keys := rows["bucket"].copy())
    again = (keys := keys[order])[1:] == keys[:-1]
    shared = np.r_[False, again] | np.r_[again, False]
    some = rows[order[shared]]
    order[shared] = order[shared][np.lexsort((some["node"], some["bucket"]))]
    rows = rows[order]
    new = np.r_[True, rows["bucket"][1:] != rows["bucket"][:-1]]
    other = new | np.r_[True, rows["node"][1:] != rows["node"][:-1]]
    rows, new = rows[other], new[other]
    at = np.arange(len(rows))
    return rows, at - np.maximum.accumulate(np.where(new, at, 0))


def _keyed(repeated, firsts):
    """Deals out the keys of lines, each with the line, its parities and size.

    A line inside `repeated` gives them where its place is inside `firsts`, so that few lines give them twice. Of a bucket that is
    large in what a task holds at once, all but LARGE + 1 lines go anywhere, so no part gets all of a large bucket.
    """

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[np.ndarray]:
        sampler = Sampler()
        for batch in batches:
            text_keys = batch["text_key"].to_numpy().view(U)
            for lines in line_slices(batch["text"]):
                at = _place_hash(lines.h, text_keys[lines.words.first + lines.doc], lines.place)
                once = ~in_bitmap(repeated.value, lines.h) | in_bitmap(firsts.value, at)
                some = np.flatnonzero((lines.sizes >= MIN_WORDS) & once)
                if not len(some):
                    continue
                keys = lines.bands(some, sampler)
                rows = np.empty(keys.shape, KEYED)
                rows["bucket"] = keys
                rows["node"], rows["size"], rows["fold"] = lines.h[some, None], lines.sizes[some, None], lines.folds()[some, None]
                yield rows.ravel()

    def deal(parts: int):
        def mapped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for rows in shares(pieces(batches)):
                rows = rows[np.argsort(rows["bucket"].copy())]
                new = np.flatnonzero(np.r_[True, rows["bucket"][1:] != rows["bucket"][:-1]])
                rank = np.arange(len(rows)) - np.repeat(new, np.diff(np.r_[new, len(rows)]))
                yield dealt_rows(few := rows[rank <= LARGE], parts_of(few["bucket"], parts))
                if (rank > LARGE).any():
                    more = rows[rank > LARGE]
                    more["size"] = -1
                    more = more[np.argsort(more["node"])]
                    yield dealt_rows(more, parts_of(more["node"], parts))

        return mapped

    return deal


def _met(similarity: float):
    """(bucket, node) of the keys that different lines share, without lines that can't be alike to another one of the bucket."""

    def kept(rows: np.ndarray, rank: np.ndarray) -> np.ndarray:
        firsts = np.flatnonzero(rank == 0)
        of = np.diff(np.r_[firsts, len(rows)])
        of = np.repeat(of, of)
        keep = of > LARGE
        a = np.flatnonzero(of <= LARGE)
        for step in range(1, LARGE):
            a = a[rank[a] + step < of[a]]
            if not len(a):
                break
            x, y = rows[a], rows[a + step]
            most = np.floor(np.maximum(x["size"], y["size"]) * (1 - similarity) + 1e-9)
            apart = np.abs(x["size"] - y["size"])
            turned = np.bitwise_count(x["fold"] ^ y["fold"]).sum(axis=1)
            may = a[(apart <= most) & (turned <= 2 * most - apart)]
            keep[may] = keep[may + step] = True
        return rows[keep]

    def out(rows: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(np.ascontiguousarray(rows[c]).view(np.int64)) for c in ("bucket", "node")], ["bucket", "node"])

    def mapped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = np.empty(0, KEYED)
        waiting, size = [], 0
        for rows in shares(taken_rows(batches, KEYED)):
            large = rows["size"] < 0
            if large.any():
                yield out(rows[large])
                rows = rows[~large]
            waiting.append(rows)
            size += rows.nbytes
            if size > max(4 * HELD, held.nbytes):
                # a bucket stays large with LARGE + 1 of its lines, the others can go
                held, rank = _ranked(np.concatenate([held, *waiting]))
                yield out(held[rank > LARGE])
                held, waiting, size = held[rank <= LARGE], [], 0
        if len(rows := np.concatenate([held, *waiting])):
            yield out(kept(*_ranked(rows)))

    return mapped


def _may_be_alike(x: dict, y: dict, parities: tuple[str, ...], similarity: float):
    """Whether sizes and parities of two lines allow the similarity: an edit turns two bits at most, one if it changes the size."""
    most = F.floor(F.greatest(x["size"], y["size"]) * (1 - similarity) + 1e-9)
    apart = F.abs(x["size"] - y["size"])
    turned = sum((F.bit_count(x[p].bitwiseXOR(y[p])) for p in parities), F.lit(0))
    return (apart <= most) & (turned <= 2 * most - apart)


def _compared(documents: DataFrame, similarity: float) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(occurrences, different, roots): line occurrences; h, h2, node, first, n of each different line; node and root of those in groups."""
    spark = documents.sparkSession
    small_batches(spark)
    docs = keyed_texts(documents.where(F.col("doc_id").isNotNull()))
    occurrences = materialise(docs.mapInArrow(_fingerprinted, "doc_id long, text_key long, place int, h long, h2 long"), "line-occurrences")
    counted = dealt(occurrences, _seen, _different, "h long, h2 long, doc_id long, place int, text_key long, n long")
    different = materialise(counted.select("h", "h2", F.struct("doc_id", "place", "text_key").alias("first"), "n", F.col("h").alias("node")), "lines")
    more = different.where("n > 1").select("h", "first.text_key", "first.place")
    repeated = worker_broadcast(spark, bitmap(more, "h", KEY_BITS))
    firsts = worker_broadcast(spark, bitmap(more.mapInArrow(_firsts, "at long"), "at", KEY_BITS))
    buckets = materialise(dealt(docs, _keyed(repeated, firsts), _met(similarity), "bucket long, node long"), "line-buckets")
    nodes = buckets.select("node").distinct()
    wanted = worker_broadcast(spark, bitmap(nodes, "node", KEY_BITS))
    held = different.join(nodes, "node", "left_semi").select(F.col("first.text_key").alias("text_key"))
    holders = worker_broadcast(spark, bitmap(held, "text_key", KEY_BITS))
    schema = "h long, line binary, p0 long, p1 long, p2 long, p3 long"
    coded = materialise(docs.mapInArrow(_coded(wanted, holders), schema).dropDuplicates(["h"]), "coded-lines")
    measured = coded.select(F.col("h").alias("node"), (F.octet_length("line") / 4).cast("int").alias("size"), *PARITIES)

    def possible(x: dict, y: dict):
        return _may_be_alike(x, y, PARITIES, similarity)

    def verify(pairs: DataFrame) -> DataFrame:
        left, right = (measured.select(F.col("node").alias(e), *[F.col(c).alias(f"{c}_{e}") for c in ("size", *PARITIES)]) for e in "ab")
        sides = [{c: F.col(f"{c}_{e}") for c in ("size", *PARITIES)} for e in "ab"]
        near = pairs.join(left, "a").join(right, "b").where(possible(*sides))
        line_a = coded.select(F.col("h").alias("a"), F.col("line").alias("line_a"))
        line_b = coded.select(F.col("h").alias("b"), F.col("line").alias("line_b"))
        return near.select("a", "b").join(line_a, "a").join(line_b, "b").mapInArrow(_close(similarity), "a long, b long").distinct()

    _, roots = linked(buckets, verify, lambda some: some.join(measured, "node"), possible)
    return occurrences, different, roots


def _named(different: DataFrame, roots: DataFrame) -> DataFrame:
    """h, h2, node, root, first of different lines."""
    named = different.join(roots.withColumnRenamed("node", "_n"), different["node"] == F.col("_n"), "left")
    named = named.where("n > 1 or root is not null").select("h", "h2", "node", F.coalesce("root", "node").alias("root"), "first")
    named = materialise(named, "named-lines")
    lowest = named.groupBy("root").agg(F.min("first").alias("group_first"))
    return named.join(lowest, "root").select("h", "h2", "node", "root", F.col("group_first").alias("first"))


def line_groups(documents: DataFrame, similarity: float = SIMILARITY) -> tuple[DataFrame, DataFrame]:
    """(occurrences, groups): the line occurrences that were compared; and h, h2, node, root, first of each different line.

    first: the (doc_id, place, text_key) of the group's occurrence that stays.
    """
    occurrences, different, roots = _compared(documents, similarity)
    groups = _named(different, roots)
    alone = different.join(groups.select("h", "h2"), ["h", "h2"], "left_anti").select("h", "h2", "node", F.col("node").alias("root"), "first")
    return occurrences, groups.unionByName(alone)


def removals(documents: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """(doc_id, text_key, places): the lines that each text loses.

    Only lines that occur again or are in a group with others can lose an occurrence.
    """
    occurrences, different, roots = _compared(documents, similarity)
    groups = _named(different, roots)
    here = F.struct("doc_id", "place", "text_key")
    lost = occurrences.join(groups, ["h", "h2"]).where(here != F.col("first"))
    return lost.groupBy("doc_id", "text_key").agg(F.sort_array(F.collect_set("place")).alias("places"))


def _without(documents: DataFrame) -> DataFrame:
    """documents with _lines, and _kept without the lines lost. Only texts that may lose lines are shuffled."""
    spark = documents.sparkSession
    with scratch(spark):
        lost = materialise(removals(documents), "lost-lines", keep=True)
    touched = worker_broadcast(spark, bitmap(lost, "text_key", KEY_BITS))
    keyed = documents.withColumn("_key0", F.xxhash64(text_or_empty(documents)))
    # only keys go to Python and back, texts stay where they are
    flag = F.arrow_udf(lambda keys: pa.array(in_bitmap(touched.value, keys.to_numpy().view(U))), "boolean")
    flagged = keyed.withColumn("_touched", flag("_key0"))
    inside, outside = (flagged.where(c).drop("_touched") for c in (F.col("_touched"), ~F.col("_touched")))
    lost = lost.select(F.col("doc_id").alias("_id"), F.col("text_key").alias("_key"), "places")
    joined = inside.join(lost.hint("shuffle_hash"), (inside["doc_id"] == lost["_id"]) & (inside["_key0"] == lost["_key"]), "left")
    whole = joined.drop("_id", "_key").unionByName(outside.withColumn("places", F.lit(None).cast("array<int>")))
    split = whole.withColumn("_lines", F.split(text_or_empty(whole), "\n", -1))
    kept = F.filter("_lines", lambda x, i: ~F.array_contains("places", i))
    return split.withColumn("_kept", F.when(F.col("places").isNull(), F.col("_lines")).otherwise(kept)).drop("_key0")


def dedup_report(documents: DataFrame) -> DataFrame:
    """Per row: doc_id, n_lines, n_removed, and the sha256 of the text that is left."""
    return _without(documents.select("doc_id", "text")).select(
        "doc_id",
        F.size("_lines").cast("long").alias("n_lines"),
        (F.size("_lines") - F.size("_kept")).cast("long").alias("n_removed"),
        F.sha2(F.array_join("_kept", "\n").cast("binary"), 256).alias("kept_sha256"),
    )


@keeping_columns
def deduplicated(documents: DataFrame) -> DataFrame:
    """The documents without repeated lines, all columns; a text that loses every line goes.

    n_chars, where there is one, is counted again for texts that lose lines.
    """
    left = _without(documents)
    cut = F.col("places").isNotNull()
    out = left.where(~cut | F.exists("_kept", lambda x: F.btrim(x) != ""))
    text = F.when(cut, F.array_join("_kept", "\n")).otherwise(F.col("text"))
    out = out.withColumn("text", text)
    if "n_chars" in documents.columns:
        counted = F.when(cut, F.length("text").cast(documents.schema["n_chars"].dataType)).otherwise(F.col("n_chars"))
        out = out.withColumn("n_chars", counted)
    return out.select(documents.columns)
