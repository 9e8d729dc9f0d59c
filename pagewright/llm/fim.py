"""Fill-in-the-middle by bit masks: a text's bytes become big integers, one bit a byte.

`bytes.translate` and a binary parse make the mask of a byte class (bit i: byte i belongs to it), shifts and
boolean operations on whole masks mark where units end, `bit_count` counts the units, and the end of the k-th
unit is found by halving the mask and counting its lower half. A cut never touches a character, so no
text is decoded. Each row is worked on alone, nothing is shuffled.

Defined cases: a null text counts as empty, an empty text is plain; a null doc_id is hashed as the empty string; repeated rows
give equal rows; bytes that are no UTF-8 belong to the character before; an empty table gives an empty
result; other columns, of any name, are left out.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import small_batches, text_or_empty

#: Shares of a hundred: texts left plain, and those of the others that begin with the suffix.
PLAIN, SUFFIX_FIRST = 10, 20
#: Mark the prefix, the suffix and the middle.
SENTINELS = ("<P>", "<S>", "<M>")
FORMED = "doc_id long, n long, form string, prefix_chars long, middle_chars long, output string"


def byte_table(members: set[int]) -> bytes:
    return bytes(0x31 if b in members else 0x30 for b in range(256))


ASCII, CONTINUED = set(range(0x80)), set(range(0x80, 0xC0))
PAIRS, TRIPLES, FOURS = set(range(0xC0, 0xE0)), set(range(0xE0, 0xF0)), set(range(0xF0, 0x100))
BLANK = {0x20, *range(0x09, 0x0E)}
TABLES = {name: byte_table(b) for name, b in (("one", ASCII), ("two", PAIRS), ("three", TRIPLES), ("four", FOURS), ("inside", CONTINUED), ("blank", BLANK), ("newline", {0x0A}))}


def mask(backwards: bytes, name: str) -> int:
    """The class's mask of a text whose bytes are given last to first."""
    return int(backwards.translate(TABLES[name]), 2)


def character_ends(raw: bytes) -> int:
    """A bit at the last byte of every code point: a lead byte of k bytes ends k - 1 bytes further on."""
    if raw.isascii():
        return (1 << len(raw)) - 1
    back = raw[::-1]
    whole = (1 << len(raw)) - 1
    ends = mask(back, "one") | mask(back, "two") << 1 | mask(back, "three") << 2 | mask(back, "four") << 3
    inside = mask(back, "inside")
    starts = whole & ~inside | 1
    followed = starts >> 1 | 1 << (len(raw) - 1)
    return ends if ends == followed else followed


def word_ends(raw: bytes) -> int:
    """A bit at the last byte of every word: the byte behind it is blank or none."""
    words = ~mask(raw[::-1], "blank") & ((1 << len(raw)) - 1)
    return words & ~(words >> 1)


def line_ends(raw: bytes) -> int:
    """A bit at every newline, and at the last byte."""
    return mask(raw[::-1], "newline") | 1 << (len(raw) - 1)


UNITS = {"character": character_ends, "word": word_ends, "line": line_ends}


def ranked(bits: int, k: int) -> int:
    """The place of the k-th set bit, from 1: the half that holds it is kept until one bit is left."""
    at, width = 0, bits.bit_length()
    while width > 1:
        half = width >> 1
        low = bits & ((1 << half) - 1)
        below = low.bit_count()
        if k <= below:
            bits, width = low, half
        else:
            bits, k, at, width = bits >> half, k - below, at + half, width - half
    return at


def cuts(raw: bytes, unit: str, first: int, second: int) -> tuple[int, int, int, int, int]:
    """Units, then the units and the bytes before either of two cuts, which are taken modulo the units and one."""
    ends = UNITS[unit](raw) if raw else 0
    n = ends.bit_count()
    a, b = sorted((first % (n + 1), second % (n + 1)))
    return n, a, b, ranked(ends, a) + 1 if a else 0, ranked(ends, b) + 1 if b else 0


def checked(sentinels: tuple[str, str, str]) -> tuple[bytes, bytes, bytes]:
    """Sentinels of which none can arise where a text meets one: no end of any is the beginning of any."""
    for a in sentinels:
        for b in sentinels:
            if not a or any(b.startswith(a[k:]) for k in range(1, len(a))) or (a is not b and a in b):
                raise ValueError(f"sentinels {a!r} and {b!r} overlap")
    return tuple(s.encode() for s in sentinels)


def _formed(seed: int, unit: str, plain: int, suffix_first: int, sentinels: tuple[bytes, bytes, bytes]):
    head, tail, mid = sentinels
    names = [f.split()[0] for f in FORMED.split(", ")]
    types = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.large_binary()]

    def one(doc_id: int | None, raw: bytes) -> tuple:
        h = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
        h1, h2, h3, h4 = (int(h[k : k + 8], 16) for k in range(0, 32, 8))
        n, a, b, x, y = cuts(raw, unit, h1, h2)
        if not raw or h3 % 100 >= 100 - plain or any(s in raw for s in sentinels):
            return doc_id, n, "plain", None, None, raw
        if h4 % 100 < suffix_first:
            return doc_id, n, "spm", a, b - a, b"".join((tail, raw[y:], head, raw[:x], mid, raw[x:y]))
        return doc_id, n, "psm", a, b - a, b"".join((head, raw[:x], tail, raw[y:], mid, raw[x:y]))

    def mapped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [one(i, t) for i, t in zip(batch["doc_id"].to_pylist(), batch["text"].to_pylist(), strict=True)]
            if rows:
                columns = [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)]
                columns[-1] = columns[-1].cast(pa.binary())
                yield pa.RecordBatch.from_arrays(columns, names)

    return mapped


def transformed(
    documents: DataFrame, seed: int = 1, unit: str = "character", plain: int = PLAIN, suffix_first: int = SUFFIX_FIRST, sentinels: tuple[str, str, str] = SENTINELS
) -> DataFrame:
    """doc_id, n, form, prefix_chars, middle_chars, output of each document; n and the two counts are of `unit`.

    Two cuts at seeded units part a text into prefix, middle and suffix. psm: prefix, suffix, middle, each behind
    its sentinel; spm: suffix, prefix, middle. Plain, as they are: `plain` of a hundred, empty texts and texts that hold a sentinel.
    """
    small_batches(documents.sparkSession)
    docs = documents.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty(documents).cast("binary").alias("text"))
    made = docs.mapInArrow(_formed(seed, unit, plain, suffix_first, checked(sentinels)), FORMED.replace("output string", "output binary"))
    return made.withColumn("output", F.col("output").cast("string"))


def restored(output: Column, form: Column, sentinels: tuple[str, str, str] = SENTINELS) -> Column:
    """The text that an output was made of."""
    parts = F.split(output, "|".join(re.escape(s) for s in sentinels), -1)
    first, second, third = (F.element_at(parts, k) for k in (2, 3, 4))
    return F.when(form == "psm", F.concat(first, third, second)).when(form == "spm", F.concat(second, third, first)).otherwise(output)


def fill_in_middle(documents: DataFrame) -> DataFrame:
    """The digest columns of every document's output and of the text rebuilt from it."""
    out = transformed(documents)
    return out.select(
        "doc_id", "n", "form", "prefix_chars", "middle_chars",
        F.sha2("output", 256).alias("output_sha256"), F.sha2(restored(F.col("output"), F.col("form")), 256).alias("restored_sha256"),
    )


def fim_sql() -> str:
    """The same in DuckDB, by characters."""
    h = [f"cast('0x' || h[{k}:{k + 7}] AS BIGINT)" for k in (1, 9, 17, 25)]
    return f"""
WITH hashed AS (
  SELECT doc_id, coalesce(text, '') AS t, cast(length(coalesce(text, '')) AS BIGINT) AS n, sha256('1:' || coalesce(cast(doc_id AS VARCHAR), '')) AS h FROM documents
), cut AS (
  SELECT *, least({h[0]} % (n + 1), {h[1]} % (n + 1)) AS a, greatest({h[0]} % (n + 1), {h[1]} % (n + 1)) AS b,
    CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR {h[2]} % 100 >= {100 - PLAIN} THEN 'plain'
      WHEN {h[3]} % 100 < {SUFFIX_FIRST} THEN 'spm' ELSE 'psm' END AS form FROM hashed
), parts AS (
  SELECT *, t[1:a] AS p, t[a + 1:b] AS m, t[b + 1:] AS s FROM cut
)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN a END AS prefix_chars, CASE WHEN form <> 'plain' THEN b - a END AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m ELSE '<S>' || s || '<P>' || p || '<M>' || m END) AS output_sha256,
  sha256(t) AS restored_sha256
FROM parts"""
