"""Mixing sources to target weights, by a minimum-cost flow over membership patterns.

Documents are summed by pattern (the set of sources they belong to). Words flow from patterns to the quotas of
their sources; a pattern's first pass over its documents is free, each further one costs more, so nothing is
repeated while words without repetition are left. Costs sit on the arcs into patterns only and grow with the pass, so
the cheapest flow is found pass by pass: a greatest flow with the capacity of one pass is augmented with that of the next.
Patterns that share no source do not influence each other: each connected part is solved on its own, in its own task.

A pattern's flow is then taken from its documents in seeded order: every document as often as full passes go,
and the first ones once more; the document in which the flow ends is cut. The order's running total is over hash buckets,
and only the rows of a pattern's last bucket are sorted.

Defined cases: a null text has no words and gives none; a null source is a source of its own, the last; a null doc_id is
hashed as the empty string; of rows alike in doc_id and size any may be the one that is cut; an empty table gives an empty result; a target is
0 where all texts are empty; other columns, of any name, are left out.
"""

from __future__ import annotations

from collections import deque

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import materialise, text_or_empty
from .graph import components

#: Weights of the sources in order, again from the first after the last.
WEIGHTS = (5, 2, 1)
#: Passes over a document at most.
PASSES = 3
#: Hexadecimal digits of a document's hash that make its bucket.
DIGITS = 3
#: Words.
WORD = r"[^\x20\x09-\x0D]+"


class Flow:
    """A greatest flow in a network of whole-number capacities, by shortest augmenting paths."""

    def __init__(self, nodes: int):
        self.arcs: list[list[int]] = [[] for _ in range(nodes)]
        self.to: list[int] = []
        self.room: list[int] = []

    def arc(self, a: int, b: int, room: int) -> int:
        self.to += [b, a]
        self.room += [room, 0]
        k = len(self.to) - 2
        self.arcs[a].append(k)
        self.arcs[b].append(k + 1)
        return k

    def augment(self, source: int, sink: int) -> None:
        """Send all that goes, level by level; what was sent before may be sent another way."""
        while True:
            level = {source: 0}
            queue = deque([source])
            while queue:
                a = queue.popleft()
                for k in self.arcs[a]:
                    if self.room[k] and self.to[k] not in level:
                        level[self.to[k]] = level[a] + 1
                        queue.append(self.to[k])
            if sink not in level:
                return
            untried = [0] * len(self.arcs)
            path: list[int] = []
            at = source
            while True:
                if at == sink:
                    most = min(self.room[k] for k in path)
                    for k in path:
                        self.room[k] -= most
                        self.room[k ^ 1] += most
                    path, at = [], source
                    continue
                while untried[at] < len(self.arcs[at]):
                    k = self.arcs[at][untried[at]]
                    if self.room[k] and level.get(self.to[k]) == level[at] + 1:
                        break
                    untried[at] += 1
                else:
                    if at == source:
                        break
                    back = path.pop()
                    at = self.to[back ^ 1]
                    untried[at] += 1
                    continue
                path.append(k)
                at = self.to[k]


def cheapest(sizes: list[int], members: list[list[int]], quotas: list[int], passes: int) -> list[dict[int, int]]:
    """Words that each pattern gives to each of its sources: as many as quotas and passes let, with as little repetition as can be."""
    n, m = len(sizes), len(quotas)
    net = Flow(n + m + 2)
    root, sink = n + m, n + m + 1
    into = [net.arc(root, p, 0) for p in range(n)]
    through = [[(s, net.arc(p, n + s, sizes[p] * passes)) for s in members[p]] for p in range(n)]
    for s, quota in enumerate(quotas):
        net.arc(n + s, sink, quota)
    for _ in range(passes):
        for p, k in enumerate(into):
            net.room[k] += sizes[p]
        net.augment(root, sink)
    return [{s: net.room[k ^ 1] for s, k in arcs if net.room[k ^ 1]} for arcs in through]


def _solved(passes: int):
    def solve(group: pd.DataFrame) -> pd.DataFrame:
        """Rows of one connected part: a pattern, its size, one of its sources and that one's quota."""
        names = sorted(set(group["member"]))
        number = {s: k for k, s in enumerate(names)}
        quota = dict(zip(group["member"], group["quota"], strict=True))
        patterns = group.sort_values(["pattern", "member"]).groupby("pattern", sort=True)
        keys = [key for key, _ in patterns]
        sizes = [int(rows["pattern_size"].iloc[0]) for _, rows in patterns]
        members = [[number[s] for s in rows["member"]] for _, rows in patterns]
        given = cheapest(sizes, members, [int(quota[s]) for s in names], passes)
        rows = [(key, names[s], words) for key, flow in zip(keys, given, strict=True) for s, words in flow.items()]
        return pd.DataFrame(rows, columns=["pattern", "member", "words"])

    return solve


def source_key(source: Column) -> Column:
    """A source as a string that is never null and sorts like the source, null last."""
    return F.coalesce(F.concat(F.lit("0"), source.cast("string")), F.lit("1"))


def sized(documents: DataFrame, sources: Column, seed: int) -> DataFrame:
    """doc_id, size, members (sorted keys of the sources), pattern and seeded order of each document."""
    members = F.array_sort(F.array_distinct(F.transform(sources, source_key)))
    name = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit(":"), F.col("size").cast("string"))
    return (
        documents.select(
            F.col("doc_id").cast("long").alias("doc_id"), members.alias("members"), F.regexp_count(text_or_empty(documents), F.lit(WORD)).cast("long").alias("size")
        )
        .withColumn("order", F.sha2(name, 256))
        .withColumn("pattern", F.sha2(F.to_json("members"), 256))
    )


def targets(patterns: DataFrame, weights: tuple[int, ...] = WEIGHTS, passes: int = PASSES) -> DataFrame:
    """member, source_size, target: the sources' shares of all words by weight, none above `passes` times its size.

    With sources in order of size per weight, those that stop at their limit come first. So the share per weight
    is what the first k leave, by the weight of the rest, for the first k at which the next source's limit is not below it. A row a
    source is sorted here, not a row a document.
    """
    by_source = patterns.select(F.explode("members").alias("member"), "pattern_size").groupBy("member").agg(F.sum("pattern_size").alias("source_size"))
    place = (F.row_number().over(Window.orderBy("member")) - 1) % len(weights)
    weighed = by_source.withColumn("weight", F.element_at(F.array(*map(F.lit, weights)), place + 1)).withColumn("most", passes * F.col("source_size"))
    by_limit = Window.orderBy((F.col("most") / F.col("weight")), "member")
    before = by_limit.rowsBetween(Window.unboundedPreceding, -1)
    all_words = patterns.agg(F.sum("pattern_size")).scalar()
    swept = weighed.select(
        "*", (all_words - F.coalesce(F.sum("most").over(before), F.lit(0))).alias("left"),
        F.sum("weight").over(by_limit.rowsBetween(Window.currentRow, Window.unboundedFollowing)).alias("weight_left"),
    )
    level = F.col("left").cast("double") / F.col("weight_left").cast("double")
    fits = F.when(F.col("most") >= F.col("weight") * level, level)
    level = swept.withColumn("level", F.first(fits, ignorenulls=True).over(by_limit.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)))
    return level.select("member", "source_size", F.coalesce(F.least(F.col("most").cast("double"), F.col("weight") * F.col("level")), F.lit(0.0)).alias("target"))


def flows(patterns: DataFrame, quotas: DataFrame, passes: int = PASSES) -> DataFrame:
    """pattern, member, words: what each pattern gives to each of its sources. A connected part of patterns and sources is one group."""
    pairs = patterns.select("pattern", "pattern_size", F.explode("members").alias("member")).join(quotas, "member")
    several = pairs.join(patterns.where(F.size("members") > 1).select(F.explode("members").alias("member")).distinct(), "member", "left_semi")
    if several.isEmpty():
        return pairs.select("pattern", "member", F.least(F.col("quota"), passes * F.col("pattern_size")).alias("words"))
    alone = pairs.join(several.select("pattern").distinct(), "pattern", "left_anti")
    single = alone.select("pattern", "member", F.least(F.col("quota"), passes * F.col("pattern_size")).alias("words"))
    member, pattern = F.xxhash64("member").alias("b"), F.xxhash64("pattern").alias("a")
    part = components(several.select(pattern, member))
    joined = several.withColumn("a", F.xxhash64("pattern")).join(part.toDF("a", "part"), "a")
    together = joined.groupBy("part").applyInPandas(_solved(passes), "pattern string, member string, words long")
    return single.unionByName(together)


def mixed(documents: DataFrame, sources: Column, weights: tuple[int, ...] = WEIGHTS, passes: int = PASSES, seed: int = 7) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Documents (doc_id, members, size, pattern, taken), sources (member, source_size, target, quota) and flows (pattern, member, words).

    sources: an array column, the sources of a document; one without any is left out. A document taken t words gives t div size whole
    passes and the first t % size words once more. Where sources overlap, a source may be unable to reach its target.
    """
    docs = materialise(sized(documents, sources, seed), "sized")
    patterns = materialise(docs.groupBy("pattern").agg(F.first("members").alias("members"), F.sum("size").alias("pattern_size")), "patterns")
    aims = materialise(targets(patterns, weights, passes).withColumn("quota", F.round("target").cast("long")), "targets")
    given = materialise(flows(patterns, aims.select("member", "quota"), passes), "flows")
    words = given.groupBy("pattern").agg(F.sum("words").alias("words"))
    asked = patterns.join(words, "pattern", "left").select(
        "pattern", F.least(F.lit(passes), F.expr("coalesce(words, 0L) div greatest(pattern_size, 1L)")).alias("full"), F.coalesce("words", F.lit(0)).alias("words"), "pattern_size"
    ).withColumn("rest", F.col("words") - F.col("full") * F.col("pattern_size"))
    bucket = F.substring("order", 1, DIGITS)
    counts = docs.groupBy("pattern", bucket.alias("bucket")).agg(F.sum("size").alias("bucket_size"))
    running = F.sum("bucket_size").over(Window.partitionBy("pattern").orderBy("bucket"))
    ending = counts.withColumn("upto", running).join(asked, "pattern").where("upto >= rest and upto - bucket_size < rest")
    ends = ending.groupBy("pattern").agg(F.min("bucket").alias("last"), F.min_by(F.col("rest") - F.col("upto") + F.col("bucket_size"), "bucket").alias("rest_there"))
    plan = materialise(asked.join(ends, "pattern", "left").select("pattern", "full", F.coalesce("last", F.lit("")).alias("last"), F.coalesce("rest_there", F.lit(0)).alias("rest_there")), "plan")
    planned = docs.withColumn("bucket", bucket).join(plan, "pattern")
    aside = planned.where("bucket <> last").withColumn("more", F.when(F.col("bucket") < F.col("last"), F.col("size")).otherwise(0))
    before = F.coalesce(F.sum("size").over(Window.partitionBy("pattern").orderBy("order", "doc_id").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    within = planned.where("bucket = last").withColumn("more", F.greatest(F.lit(0), F.least("size", F.col("rest_there") - before)))
    taken = aside.unionByName(within).select("doc_id", "members", "size", "pattern", (F.col("full") * F.col("size") + F.col("more")).cast("long").alias("taken"))
    return taken, aims, given


def mix_documents(documents: DataFrame) -> DataFrame:
    """doc_id, size, source_size, target, taken of each document, which belongs to its one source."""
    taken, aims, _ = mixed(documents, F.array("source"))
    own = taken.withColumn("member", F.element_at("members", 1))
    return own.join(aims, "member").select("doc_id", "size", "source_size", "target", "taken")


def mix_sql(weights: tuple[int, ...] = WEIGHTS, passes: int = PASSES, seed: int = 7) -> str:
    """The same in DuckDB, where a document has one source: a source's flow is its quota."""
    weight = f"[{', '.join(map(str, weights))}][(row_number() OVER (ORDER BY member) - 1) % {len(weights)} + 1]"
    return rf"""
WITH sized AS (
  SELECT doc_id, coalesce('0' || source, '1') AS member, cast(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size FROM documents
), ordered AS (
  SELECT *, sha256('{seed}:' || coalesce(cast(doc_id AS VARCHAR), '') || ':' || size) AS h FROM sized
), by_source AS (
  SELECT member, cast(sum(size) AS BIGINT) AS source_size FROM sized GROUP BY member
), weighed AS (
  SELECT *, {weight} AS weight, {passes} * source_size AS most FROM by_source
), swept AS (
  SELECT *, cast((SELECT sum(size) FROM sized) - coalesce(sum(most) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS DOUBLE)
    / cast(sum(weight) OVER (w ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS DOUBLE) AS level FROM weighed
  WINDOW w AS (ORDER BY most / weight, member)
), aims AS (
  SELECT member, source_size, coalesce(least(cast(most AS DOUBLE), weight * (SELECT level FROM swept WHERE most >= weight * level ORDER BY most / weight, member LIMIT 1)), 0.0) AS target FROM swept
), quotas AS (
  SELECT *, cast(round(target) AS BIGINT) AS quota FROM aims
), passed AS (
  SELECT o.*, q.source_size, q.target, least({passes}, quota // greatest(q.source_size, 1)) AS passes, quota,
    coalesce(sum(size) OVER (PARTITION BY o.member ORDER BY h, doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
  FROM ordered o JOIN quotas q ON o.member = q.member
)
SELECT doc_id, size, source_size, target,
  cast(passes * size + greatest(0, least(size, quota - passes * source_size - before)) AS BIGINT) AS taken
FROM passed"""
