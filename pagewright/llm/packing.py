"""Hierarchical multi-length packing.

Documents become token ids and are routed by length to tiers of context sizes. Inside a task a
bounded buffer of documents is packed tier by tier from the longest: whole windows are cut off long
documents, a remainder opens a window of its tier, the gap is filled with the largest shorter
remainders that fit, and at last with a cut piece of one that doesn't. So every window is full, and
what doesn't fill one waits for the next buffer; only a task's last window can have padding.
Full windows of a tier are dealt into step groups of equal token counts.

Nothing is shuffled and nothing meets in one task: partitions are packed on their own, and sequence
ids carry the partition. Token ids are cut and checked where they are made.

Defined cases: a null or empty text is the end token alone; repeated rows are packed each; an empty
table gives an empty result.
"""

from __future__ import annotations

import bisect

import zlib
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

from .common import small_batches, text_or_empty

#: Context sizes, each a power of two; the largest is the window of a sequence.
TIERS = (256, 512, 1024, 2048)
#: Ends each document.
END = 1
#: Tokens of a buffer, and of a step group.
BUFFER = 1 << 20
STEP = 1 << 17
#: Words whose ids a worker remembers.
CACHE = 1_500_000
#: Symbols that end words; none of them begins a contraction of the tokenizer's pattern.
TRAILING = b".,;:!?%*#&$)"
BLANKS = bytes.maketrans(b"\t\n\r", b"   ")
#: Joins words for one call of the tokenizer; texts that hold it are encoded on their own.
MARK = "\x00"

PIECE = (
    "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, "
    "tier int, step_group long, ids array<int>"
)


class WordIds:
    """Token ids of texts by way of their words: the tokenizer drops white space and never joins across it.

    Only space, newline, tab and carriage return part words here; other white space stays inside a
    word and is left to the tokenizer. A word's trailing symbols are a token run of their own, so
    words that differ in them, or in the case of A-Z, share one call.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.known: dict[bytes, bytes] = {}
        mark = self.tokenizer.encode(MARK, add_special_tokens=False).ids
        self.mark = mark[0] if len(mark) == 1 else None

    def _encode(self, words: list[bytes]) -> None:
        texts = [w.decode("utf-8", "surrogatepass") for w in words]
        plain = [t for t in texts if MARK not in t] if self.mark is not None else []
        rest = set(texts).difference(plain)
        if plain:
            joined = f" {MARK} ".join(plain)
            ids = np.asarray(self.tokenizer.encode_batch_fast([joined], add_special_tokens=False)[0].ids, "<u4")
            cuts = np.flatnonzero(ids == self.mark)
            if len(cuts) == len(plain) - 1:
                first = (np.r_[0, cuts + 1] * 4).tolist()
                last = (np.r_[cuts, len(ids)] * 4).tolist()
                raw = ids.tobytes()
                self.known.update(
                    (t.encode("utf-8", "surrogatepass"), raw[a:z]) for t, a, z in zip(plain, first, last, strict=True)
                )
            else:  # a word that makes the mark's own id
                rest.update(plain)
        for t in rest:
            ids = np.asarray(self.tokenizer.encode(t, add_special_tokens=False).ids, "<u4")
            self.known[t.encode("utf-8", "surrogatepass")] = ids.tobytes()

    def _learn(self, new: set[bytes]) -> None:
        whole, composed = set(), []
        for w in new:
            core = w.rstrip(TRAILING)
            if core != w and core and core.decode("utf-8", "surrogatepass")[-1].isalnum():
                composed.append((w, core, w[len(core) :]))
            else:
                whole.add(w)
        for _, core, tail in composed:
            whole.add(core)
            whole.add(tail)
        missing = list(whole.difference(self.known))
        for k in range(0, len(missing), 20_000):
            self._encode(missing[k : k + 20_000])
        known = self.known
        for w, core, tail in composed:
            known[w] = known[core] + known[tail]

    def of(self, texts: list[str]) -> list[bytes]:
        """Ids of each text as little-endian unsigned 32-bit numbers."""
        if len(self.known) > CACHE:
            self.known = {}
        parts = [t.encode("utf-8", "surrogatepass").lower().translate(BLANKS).split(b" ") for t in texts]
        self._learn(set(chain.from_iterable(parts)).difference(self.known))
        get = self.known.__getitem__
        return [b"".join(map(get, p)) for p in parts]


_made: dict[str, WordIds] = {}


def word_ids(path: str) -> WordIds:
    """One per worker process, kept from task to task."""
    if path not in _made:
        _made[path] = WordIds(path)
    return _made[path]


class Packer:
    """Packs documents of token ids into full windows, and keeps what is left over for later."""

    def __init__(self, tiers: tuple[int, ...], emit):
        self.tiers, self.emit = tiers, emit
        #: open remainders as (length, order, document, start), in order of length
        self.open: list[tuple[int, int, int, int]] = []
        self.order = self.total = 0

    def put(self, document: int, length: int) -> None:
        top, start = self.tiers[-1], 0
        while length - start >= top:
            self.emit(top, [(document, start, top)])
            start += top
        if length > start:
            self._hold(length - start, document, start)

    def _hold(self, length: int, document: int, start: int) -> None:
        bisect.insort(self.open, (length, self.order, document, start))
        self.order += 1
        self.total += length

    def _take(self, most: int) -> tuple[int, int, int, int] | None:
        """The longest remainder of at most so many tokens."""
        k = bisect.bisect_right(self.open, (most, float("inf"), 0, 0))
        return self._pop(k - 1) if k else None

    def _pop(self, k: int) -> tuple[int, int, int, int]:
        found = self.open.pop(k)
        self.total -= found[0]
        return found

    def _fill(self, size: int) -> list[tuple[int, int, int]]:
        """A window of exactly `size` tokens, or all there is."""
        pieces, gap = [], size
        while gap and self.open:
            if (found := self._take(gap)) is not None:
                length, _, document, start = found
                pieces.append((document, start, length))
                gap -= length
            else:  # every remainder is longer than the gap: cut the shortest
                length, _, document, start = self._pop(0)
                pieces.append((document, start, gap))
                self._hold(length - gap, document, start + gap)
                gap = 0
        return pieces

    def pack(self, last: bool = False) -> None:
        """Fill windows tier by tier from the longest, while the tier has remainders of its own."""
        for below, size in zip((*self.tiers[-2::-1], 0), self.tiers[::-1], strict=True):
            while self.open and self.open[-1][0] > below and self.total >= size:
                self.emit(size, self._fill(size))
        if last and self.open:
            for size in self.tiers[::-1]:
                while self.total >= size:
                    self.emit(size, self._fill(size))
            if self.open:
                self.emit(self.tiers[-1], self._fill(self.tiers[-1]))


def _packed(path: str, tiers: tuple[int, ...], with_ids: bool):
    def mapped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = word_ids(path)
        end = np.asarray([END], "<u4").tobytes()
        partition = TaskContext.get().partitionId() << 32
        held: dict[int, tuple[int | None, bytes]] = {}
        out: list[tuple] = []
        made = dict.fromkeys(tiers, 0)
        sequence, pending, number = 0, 0, 0

        def emit(size: int, pieces: list[tuple[int, int, int]]) -> None:
            nonlocal sequence
            offset, rank = 0, tiers.index(size)
            step = made[size] // max(1, STEP // size) * len(tiers) + rank
            made[size] += 1
            for document, start, length in pieces:
                doc_id, raw = held[document]
                piece = raw[4 * start : 4 * (start + length)]
                out.append((doc_id, start, length, zlib.crc32(piece), len(raw) // 4, partition + sequence, offset, size, partition + step, np.frombuffer(piece, "<i4") if with_ids else None))
                offset += length
            sequence += 1

        def flush() -> Iterator[pa.RecordBatch]:
            waiting = {x[2] for x in packer.open}
            for k in [k for k in held if k not in waiting]:
                del held[k]
            names = [f.split()[0] for f in PIECE.split(", ")]
            types = [pa.int64()] * 7 + [pa.int32(), pa.int64(), pa.list_(pa.int32())]
            for k in range(0, len(out), 10_000):
                columns = zip(*out[k : k + 10_000], strict=True)
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names)
            out.clear()

        packer = Packer(tiers, emit)
        for batch in batches:
            ids, texts = batch["doc_id"].to_pylist(), batch["text"].to_pylist()
            for doc_id, raw in zip(ids, words.of(texts), strict=True):
                raw += end
                held[number] = (doc_id, raw)
                packer.put(number, len(raw) // 4)
                number += 1
                pending += len(raw) // 4
                if pending >= BUFFER:
                    packer.pack()
                    pending = 0
                    yield from flush()
        packer.pack(last=True)
        yield from flush()

    return mapped


def packed(documents: DataFrame, path: str, tiers: tuple[int, ...] = TIERS, with_ids: bool = True) -> DataFrame:
    """Pieces of documents in their sequences; `path` is the vocabulary file, which every node holds."""
    small_batches(documents.sparkSession)
    docs = documents.select("doc_id", text_or_empty(documents).alias("text"))
    return docs.mapInArrow(_packed(path, tiers, with_ids), PIECE)


def vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def pack_documents(documents: DataFrame, path: str | None = None) -> DataFrame:
    return packed(documents, path or vocabulary(), with_ids=False).drop("ids")
