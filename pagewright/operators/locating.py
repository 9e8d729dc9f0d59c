"""Where a book's entries begin: an assignment of entries to headings that keeps their order, and places for those without one.

Candidates come from a join of entries and segments on the pages where an entry may begin. Of a book's
candidates the heaviest chain is taken in which places rise with entries, so a title that is printed twice goes to the entry whose
neighbours agree. Only that chain is worked out a book at a time; what is left without a heading is placed by windows.
"""

from __future__ import annotations

import bisect

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import text
from . import alike, toc

#: Least scores of a heading on an entry's printed page, and of one in the pages between its neighbours.
ON_PAGE, BETWEEN = 0.75, 0.8
#: What a heading's score has before that of other segments.
AS_HEADING = 0.05
#: Printed pages may be off by so many.
REACH = 1
#: Words of a row that is only a marker with a garbled title.
FEW_WORDS = 4
#: Levels that are told apart; deeper ones count as the deepest.
LEVELS = 12
#: What entries without a heading of their own are placed by.
PLACE = "struct<page: int, seq: int>"


def heaviest_chain(ords: list[int], places: list[tuple], weights: list[float]) -> list[int]:
    """Candidates (by index) of the greatest weight in all, one an entry at most, whose places rise with the entries.

    A tree of prefix maxima over places holds the best chain that ends before a place, so n candidates cost n log n.
    """
    ranks = {p: k + 1 for k, p in enumerate(sorted(set(places)))}
    tree: list[tuple[float, int]] = [(0.0, -1)] * (len(ranks) + 1)
    came_from = [-1] * len(ords)
    totals = [0.0] * len(ords)
    order = sorted(range(len(ords)), key=lambda k: (ords[k], places[k]))
    at = 0
    while at < len(order):
        until = bisect.bisect_right(order, ords[order[at]], lo=at, key=lambda k: ords[k])
        mine = order[at:until]
        for k in mine:
            best, i = (0.0, -1), ranks[places[k]] - 1
            while i:
                best = max(best, tree[i], key=lambda x: x[0])
                i &= i - 1
            totals[k], came_from[k] = best[0] + weights[k], best[1]
        for k in mine:  # after all of the entry's own, so that it is taken once
            i = ranks[places[k]]
            while i <= len(ranks):
                if totals[k] > tree[i][0]:
                    tree[i] = (totals[k], k)
                i += i & -i
        at = until
    last = max(range(len(ords)), key=lambda k: (totals[k], -ords[k]), default=-1)
    chain = []
    while last >= 0:
        chain.append(last)
        last = came_from[last]
    return chain[::-1]


def _chain(group: pd.DataFrame) -> pd.DataFrame:
    places = list(zip(group["page"], group["seq"], strict=True))
    return group.iloc[heaviest_chain(group["ord"].tolist(), places, group["weight"].tolist())]


def windows(entries: DataFrame, segments: DataFrame) -> DataFrame:
    """entries (book, ord, title, pdf_page) with the pages where they may begin: around the printed one, else between those of the neighbours."""
    ends = segments.groupBy("book").agg(F.min("page").alias("_first"), F.max("page").alias("_last"))
    w = Window.partitionBy("book").orderBy("ord")
    before = F.last("pdf_page", ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, -1))
    behind = F.last("pdf_page", ignorenulls=True).over(Window.partitionBy("book").orderBy(F.desc("ord")).rowsBetween(Window.unboundedPreceding, -1))
    known = F.col("pdf_page").isNotNull()
    low = F.when(known, F.col("pdf_page") - REACH).otherwise(F.coalesce(before - REACH, F.col("_first")))
    high = F.when(known, F.col("pdf_page") + REACH).otherwise(F.coalesce(behind + REACH, F.col("_last")))
    return entries.join(ends, "book").withColumn("low", low).withColumn("high", F.greatest(low, high))


def scored(entries: DataFrame, segments: DataFrame) -> DataFrame:
    """(book, ord, page, seq, weight): segments that may be an entry's heading. Nearer to the printed page weighs a little more."""
    asked = windows(entries, segments).select("book", "ord", "pdf_page", toc.unmarked_key(F.col("title")).alias("_a"), F.explode(F.sequence("low", "high")).alias("page"))
    some = segments.where(~F.col("kind").isin("footnote", "line_number")).select("book", "page", "seq", toc.unmarked_key(F.col("text")).alias("_b"), (F.col("kind") == "heading").alias("_head"))
    met = asked.join(some, ["book", "page"]).where((F.length("_a") > 0) & (F.length("_b") > 0))
    score = toc.heading_score(F.col("_a"), F.col("_b"), alike.ratio_from(ON_PAGE - AS_HEADING)) + F.when(F.col("_head"), AS_HEADING).otherwise(0.0)
    least = F.when(F.col("pdf_page").isNotNull(), ON_PAGE).otherwise(BETWEEN)
    away = F.coalesce(F.abs(F.col("page") - F.col("pdf_page")), F.lit(0)) * 0.001
    return met.withColumn("_s", score).where(F.col("_s") >= least).select("book", F.col("ord").cast("long").alias("ord"), F.col("page").cast("int").alias("page"), F.col("seq").cast("int").alias("seq"), (F.col("_s") - away).alias("weight"))


def _next(c: Column, order: Window) -> Column:
    return F.last(c, ignorenulls=True).over(order.rowsBetween(Window.unboundedPreceding, -1))


def by_marker(entries: DataFrame, segments: DataFrame) -> DataFrame:
    """(book, ord, page, seq): short rows that open with the marker of an entry without a place, between the places of its neighbours.

    entries: book, ord, title, place (null where it is asked for). Entries with one marker between the same neighbours take its rows in order.
    """
    marker = lambda c: F.lower(F.regexp_extract(F.ltrim(c, F.lit("-* ")), toc.LEAD, 1))
    up, down = Window.partitionBy("book").orderBy("ord"), Window.partitionBy("book").orderBy(F.desc("ord"))
    around = entries.withColumn("_before", _next(F.col("place"), up)).withColumn("_behind", _next(F.col("place"), down)).withColumn("marker", marker(F.col("title")))
    nth = F.row_number().over(Window.partitionBy("book", "marker", "_before", "_behind").orderBy("ord"))
    asked = around.where("place is null and marker <> ''").withColumn("_nth", nth).select("book", "ord", "marker", "_before", "_behind", "_nth")
    # words are counted of the rows with a marker only
    rows = segments.withColumn("marker", marker(F.col("text"))).where("marker <> ''").where(F.size(text.words(F.col("text"))) <= FEW_WORDS).select("book", "marker", "page", "seq")
    spot = F.struct(F.col("page").cast("int").alias("page"), F.col("seq").cast("int").alias("seq"))
    met = asked.join(rows, ["book", "marker"]).where((F.col("_before").isNull() | (spot > F.col("_before"))) & (F.col("_behind").isNull() | (spot < F.col("_behind"))))
    place = F.get(F.sort_array(F.collect_list(spot)), F.first("_nth") - 1)
    return met.groupBy("book", "ord").agg(place.alias("_m")).where("_m is not null").select("book", "ord", "_m.*")


def located(entries: DataFrame, segments: DataFrame) -> DataFrame:
    """entries (book, ord, level, title, pdf_page) with page, seq and `located`: how the place was found.

    heading: one of the chain; printed page: its top; marker: a garbled heading; first child: that of the entry's first placed
    descendant; not found: that of the entry before, or the top of the book.
    """
    candidates = scored(entries, segments)
    chain = candidates.groupBy("book").applyInPandas(_chain, candidates.schema).select("book", "ord", F.struct("page", "seq").cast(PLACE).alias("_h"))
    placed = entries.join(chain, ["book", "ord"], "left")
    top = F.when(F.col("pdf_page").isNotNull(), F.struct(F.col("pdf_page").alias("page"), F.lit(0).alias("seq")).cast(PLACE))
    how = F.when(F.col("_h").isNotNull(), "heading").when(F.col("pdf_page").isNotNull(), "printed page")
    placed = placed.withColumn("place", F.coalesce("_h", top)).withColumn("located", how)
    marked = by_marker(placed, segments).select("book", "ord", F.struct("page", "seq").cast(PLACE).alias("_m"))
    placed = placed.join(marked, ["book", "ord"], "left").withColumn("located", F.coalesce("located", F.when(F.col("_m").isNotNull(), "marker"))).withColumn("place", F.coalesce("place", "_m"))
    up, down = Window.partitionBy("book").orderBy("ord"), Window.partitionBy("book").orderBy(F.desc("ord"))
    level = F.least("level", F.lit(LEVELS))
    # a subtree ends before the next entry that stands no deeper
    ends = F.coalesce(*[F.when(level == k, _next(F.when(F.col("level") <= k, F.col("ord")), down)) for k in range(LEVELS + 1)])
    following = _next(F.when(F.col("place").isNotNull(), F.struct("ord", "place")), down)
    placed = placed.withColumn("_end", ends).withColumn("_next", following)
    inside = F.col("_end").isNull() | (F.col("_next.ord") < F.col("_end"))
    child = F.when(F.col("place").isNull() & F.col("_next").isNotNull() & inside, F.col("_next.place"))
    placed = placed.withColumn("_child", child).withColumn("located", F.coalesce("located", F.when(F.col("_child").isNotNull(), "first child"), F.lit("not found"))).withColumn("place", F.coalesce("place", "_child"))
    first = segments.groupBy("book").agg(F.min("page").alias("_first"))
    last = F.last("place", ignorenulls=True).over(up.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    filled = placed.join(first, "book", "left").withColumn("place", F.coalesce(last, F.struct(F.col("_first").alias("page"), F.lit(0).alias("seq")).cast(PLACE)))
    return filled.select(*[c for c in entries.columns if c not in ("page", "seq", "located")], "place.page", "place.seq", "located")
