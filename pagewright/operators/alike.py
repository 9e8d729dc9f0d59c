"""Similarity join of short strings: pairs whose matching-block ratio reaches a threshold, by an index of bigrams.

Two strings of n and m characters with ratio t have at least L = ceil(t (n + m) / 2) characters in common, in order, so
one loses n - L of them and the other gets m - L. A character lost breaks two of the n + 1 bigrams (with a mark at both
ends), one got breaks one: at least 3 L - n - m + 1 bigrams are the same. From this follow, for t over 2/3,

- a prefix filter: with bigrams ordered from rare to frequent, only the first ones of either string need to meet;
- a length filter: the shorter one has at least t / (2 - t) of the other's characters;
- a position filter: a bigram that either string has once has moved by what was lost or got before it at most;
- a rest filter: what stands behind a meeting bigram in both orders must make up the number.

Pairs that pass are looked at once: their characters are compared, then their longest common subsequence is measured, and the ratio is worked out for what is left. No pair is dropped that
reaches the threshold. Lower thresholds index single characters, of which L are the same.
"""

from __future__ import annotations

import difflib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from ..functions import subsequence

#: From this threshold on bigrams leave something in common.
BIGRAMS_FROM = 2 / 3 + 1e-6
#: Guards sums of decimal fractions against rounding.
EPS = 1e-9
#: Grams of an Arrow batch.
BATCH_GRAMS = 1 << 16


def grams_of(key: str, width: int) -> list[str]:
    padded = f"\x02{key}\x03" if width == 2 else key
    return [padded[i : i + width] for i in range(len(padded) - width + 1)]


def _listed(width: int, held: list[str], schema: pa.Schema):
    """The grams of each key: how often each came before, its place, and whether it comes once."""

    def mapped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows: list[tuple] = []

            def flush(batch: pa.RecordBatch = batch) -> pa.RecordBatch:
                columns = [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), [pa.int64(), *schema.types[len(held) :]], strict=True)]
                rows.clear()
                return pa.RecordBatch.from_arrays([*[batch[c].take(columns[0]) for c in held], *columns[1:]], schema.names)

            for r, key in enumerate(batch["key"].to_pylist()):
                found = grams_of(key, width)
                seen: dict[str, int] = {}
                nth = []
                for g in found:
                    seen[g] = seen.get(g, -1) + 1
                    nth.append(seen[g])
                rows.extend((r, len(key), g, k, i, seen[g] == 0) for i, (g, k) in enumerate(zip(found, nth, strict=True)))
                if len(rows) >= BATCH_GRAMS:
                    yield flush()
            if rows:
                yield flush()

    return mapped


def ratio_from(threshold: float):
    """The ratio of two strings, or 0 where a bound says that it stays below the threshold."""

    @F.pandas_udf("double")
    def score(keys: pd.Series, others: pd.Series) -> pd.Series:
        known = (keys.notna() & others.notna()).to_numpy()
        out = np.where(known, 0.0, np.nan)
        some = np.flatnonzero(known)
        left, mine = pd.factorize(keys.to_numpy(object)[some])
        right, theirs = pd.factorize(others.to_numpy(object)[some])
        for at in subsequence.near(list(mine), list(theirs), left, right, threshold):
            a, b = mine[left[at]], theirs[right[at]]
            out[some[at]] = 1.0 if a == b else difflib.SequenceMatcher(None, a, b, autojunk=False).ratio()
        return pd.Series([None if np.isnan(x) else x for x in out], dtype="float64")

    # a filter on the score would otherwise move below its projection and have it worked out twice
    return score.asNondeterministic()


def _least_common(total: Column, threshold: float, bigrams: bool) -> Column:
    """Grams that two strings with that many characters together must share."""
    matched = F.ceil(total * threshold / 2 - EPS)
    return 3 * matched - total + 1 if bigrams else matched


def index(keys: DataFrame, scope: list[str], threshold: float) -> DataFrame:
    """A row for each gram of a key's prefix: scope, id, n, gram, nth, pos, lone, rest (grams behind it in the order)."""
    bigrams = threshold >= BIGRAMS_FROM
    held = [*scope, "id"]
    asked = keys.where(F.length("key") > 0).select(*held, "key")
    out = T.StructType([*asked.schema.fields[:-1], *T._parse_datatype_string("n int, gram string, nth int, pos int, lone boolean").fields])
    grams = asked.mapInArrow(_listed(2 if bigrams else 1, held, to_arrow_schema(out)), out)
    often = grams.groupBy(*scope, "gram", "nth").agg(F.count(F.lit(1)).alias("often"))
    ordered = F.sort_array(F.collect_list(F.struct("often", "gram", "nth", "pos", "lone")))
    listed = grams.join(often, [*scope, "gram", "nth"]).groupBy(*scope, "id", "n").agg(ordered.alias("g"))
    shortest = F.col("n") + F.ceil(F.col("n") * (threshold / (2 - threshold)) - EPS)
    least = F.ceil(shortest * (1.5 * threshold - 1) + 1 - EPS) if bigrams else F.ceil(shortest * threshold / 2 - EPS)
    size = F.size("g")
    prefix = F.slice("g", F.lit(1), F.greatest(size - F.greatest(least, F.lit(1)) + 1, F.lit(0)).cast("int"))
    return listed.select(*scope, "id", "n", size.alias("_size"), F.posexplode(prefix).alias("_at", "g")).select(*scope, "id", "n", (F.col("_size") - F.col("_at")).alias("rest"), "g.gram", "g.nth", "g.pos", "g.lone")


def candidates(left: DataFrame, right: DataFrame, scope: list[str], threshold: float, both: bool) -> DataFrame:
    """(scope, id, other_id) of indexed keys that may reach the threshold, each pair once. both: left is right, and pairs are made one way."""
    bigrams = threshold >= BIGRAMS_FROM
    other = right.select(*scope, "gram", "nth", *[F.col(c).alias(f"o_{c}") for c in ("id", "n", "pos", "lone", "rest")])
    total = F.col("n") + F.col("o_n")
    matched = F.ceil(total * (threshold / 2) - EPS)
    moved = F.col("o_pos") - F.col("pos")
    in_place = ~(F.col("lone") & F.col("o_lone")) | moved.between(matched - F.col("n"), F.col("o_n") - matched)
    enough = F.least("rest", "o_rest") >= _least_common(total, threshold, bigrams)
    apart = F.col("id") < F.col("o_id") if both else F.col("id") != F.col("o_id")
    met = left.join(other, [*scope, "gram", "nth"]).where(apart & (F.least("n", "o_n") >= matched) & in_place & enough)
    return met.select(*scope, "id", F.col("o_id").alias("other_id")).distinct()


def alike(left: DataFrame, right: DataFrame | None, threshold: float, scope: list[str] | None = None) -> DataFrame:
    """(scope, key, other, score): keys of left and right whose ratio reaches the threshold, equal ones with 1.

    left, right: scope and key; right is left where None is given. A null key has no partner, an empty one only its equal.
    """
    scope = ["book"] if scope is None else scope
    named = lambda df: df.where(F.col("key").isNotNull()).select(*scope, "key").distinct().withColumn("id", F.unhex(F.md5("key")))
    a = named(left)
    b = a if right is None else named(right)
    equal = a.join(b.select(*scope, "id"), [*scope, "id"], "left_semi").select(*scope, "key", F.col("key").alias("other"), F.lit(1.0).alias("score"))
    if threshold > 1 - EPS:
        return equal
    every = a if right is None else a.unionByName(b).distinct()
    rows = index(every, scope, threshold)
    if right is None:
        met = candidates(rows, rows, scope, threshold, True)
    else:
        of = lambda df: rows.join(df.select(*scope, "id"), [*scope, "id"], "left_semi")
        met = candidates(of(a), of(b), scope, threshold, False)
    texts = met.join(a.select(*scope, "id", "key"), [*scope, "id"]).join(b.select(*scope, F.col("id").alias("other_id"), F.col("key").alias("other")), [*scope, "other_id"])
    near = texts.select(*scope, "key", "other")
    if right is None:  # the ratio depends on the order of its sides
        near = near.select(*scope, F.explode(F.array(F.struct("key", "other"), F.struct(F.col("other").alias("key"), F.col("key").alias("other")))).alias("_p")).select(*scope, "_p.*")
    scored = near.withColumn("score", ratio_from(threshold)("key", "other"))
    return equal.unionByName(scored.where(F.col("score") >= threshold))


