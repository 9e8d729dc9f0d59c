"""Similarity of short strings, in Arrow batches: what no built-in expression computes.

`ratio` is the matching-block ratio of difflib. `could_reach` is its upper bound by length, to put
before it in a join condition.
"""

from __future__ import annotations

import difflib
import unicodedata

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

PUNCTUATION = ".,;:!?…\"'“”‘’()[]-–—«»"


def could_reach(a: Column, b: Column, threshold: float) -> Column:
    """Whether two strings' lengths allow the ratio: 2 * shorter / (sum of both)."""
    return 2 * F.least(F.length(a), F.length(b)) >= threshold * (F.length(a) + F.length(b))


@F.pandas_udf(T.DoubleType())
def ratio(a: pd.Series, b: pd.Series) -> pd.Series:
    return pd.Series([None if x is None or y is None else 1.0 if x == y else difflib.SequenceMatcher(None, x, y, autojunk=False).ratio() for x, y in zip(a, b, strict=True)], dtype="float64")


@F.pandas_udf(T.ArrayType(T.StructType([T.StructField("a", T.IntegerType()), T.StructField("b", T.IntegerType())])))
def matched(a: pd.Series, b: pd.Series) -> pd.Series:
    """Places of the characters that two strings have in common, by matching blocks."""
    blocks = (difflib.SequenceMatcher(None, x or "", y or "", autojunk=False).get_matching_blocks() for x, y in zip(a, b, strict=True))
    return pd.Series([[{"a": i + k, "b": j + k} for i, j, n in found for k in range(n)] for found in blocks], dtype=object)


@F.pandas_udf(T.StringType())
def nfc(c: pd.Series) -> pd.Series:
    return c.map(lambda x: None if x is None else unicodedata.normalize("NFC", x))


def _bare(words: list[str]) -> list[str]:
    return [w.strip(PUNCTUATION) for w in words if w.strip(PUNCTUATION)]


def differing(a: str, b: str) -> list[list[str]]:
    """Spans of words that differ in more than punctuation."""
    left, right = a.split(), b.split()
    out = []
    for op, i, j, k, m in difflib.SequenceMatcher(None, left, right, autojunk=False).get_opcodes():
        if op != "equal" and _bare(left[i:j]) != _bare(right[k:m]):
            out.append([" ".join(left[i:j]), " ".join(right[k:m])])
    return out


@F.pandas_udf(T.ArrayType(T.ArrayType(T.StringType())))
def word_diff(a: pd.Series, b: pd.Series) -> pd.Series:
    return pd.Series([None if x is None or y is None else differing(x, y) for x, y in zip(a, b, strict=True)])


@F.pandas_udf(T.LongType())
def word_edits(a: pd.Series, b: pd.Series) -> pd.Series:
    """Edit distance in words."""

    def distance(x: str, y: str) -> int:
        left, right = x.split(), y.split()
        row = list(range(len(right) + 1))
        for i, w in enumerate(left, 1):
            last, row = row, [i]
            for j, v in enumerate(right, 1):
                row.append(min(last[j] + 1, row[-1] + 1, last[j - 1] + (w != v)))
        return row[-1]

    return pd.Series([distance(x or "", y or "") for x, y in zip(a, b, strict=True)], dtype="int64")
