"""Page ranges: labels, lists, and sets of pages."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import page_label


def islands(df: DataFrame, keys: list[str], number: str) -> DataFrame:
    """Runs of consecutive distinct numbers of each key: first, last, n.

    A number less its rank is the same along a run.
    """
    distinct = df.where(F.col(number).isNotNull()).select(*keys, number).distinct()
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(number))
    return (
        distinct.withColumn("_run", F.col(number) - rank)
        .groupBy(*keys, "_run")
        .agg(F.min(number).alias("first"), F.max(number).alias("last"), F.count(F.lit(1)).alias("n"))
        .drop("_run")
    )


def range_labels(df: DataFrame, keys: list[str], number: str) -> DataFrame:
    """Each key's numbers as one label, such as `1-3,7`."""
    runs = islands(df, keys, number).select(*keys, F.struct("first", page_label(F.col("first"), F.col("last")).alias("label")).alias("_r"))
    ordered = F.transform(F.array_sort(F.collect_list("_r")), lambda r: r["label"])
    return runs.groupBy(*keys).agg(F.array_join(ordered, ",").alias("pages"))


def expanded(label: Column) -> Column:
    """The pages of a label as an array: `1-3,7` gives 1, 2, 3, 7; none of a blank label."""
    parts = F.filter(F.split(F.regexp_replace(label, r"\s", ""), ","), lambda p: p != "")
    return F.flatten(
        F.transform(
            parts,
            lambda p: F.sequence(F.element_at(F.split(p, "-"), 1).cast("int"), F.element_at(F.split(p, "-"), -1).cast("int")),
        )
    )


def selected_pages(books: DataFrame, spec: str | None) -> DataFrame:
    """(book, page): `ocr` (the default) takes the pages that need OCR, `all` every page, else a label."""
    if spec in (None, "", "ocr"):
        return pages_to_ocr(books)
    every = F.sequence(F.lit(1), F.col("page_count"))
    chosen = every if spec == "all" else F.array_intersect(expanded(F.lit(spec)), every)
    return books.where("page_count > 0").select("book", F.explode(chosen).alias("page"))


def pages_to_ocr(books: DataFrame) -> DataFrame:
    """(book, page): pages of text versions, pages that no version covers, and included pages; less excluded ones.

    books: book, page_count, versions array<struct<content, pages>>, include, exclude (labels).
    """
    version = books.select("book", F.explode("versions").alias("v")).select("book", "v.content", F.explode(expanded(F.col("v.pages"))).alias("page"))
    every = books.where("page_count > 0").select("book", F.explode(F.sequence(F.lit(1), F.col("page_count"))).alias("page"))
    uncovered = every.join(version.select("book", "page").distinct(), ["book", "page"], "left_anti")
    text = version.where("content = 'text'").select("book", "page")
    listed = lambda c: books.where(F.col(c).isNotNull()).select("book", F.explode(expanded(F.col(c))).alias("page"))
    return text.union(uncovered).union(listed("include")).distinct().join(listed("exclude").distinct(), ["book", "page"], "left_anti")


def source_pages(sources: DataFrame) -> DataFrame:
    """Where each source file's pages stand in the book: sources (book, ord, pdf, pages) with first and last page."""
    before = Window.partitionBy("book").orderBy("ord").rowsBetween(Window.unboundedPreceding, -1)
    start = F.coalesce(F.sum("pages").over(before), F.lit(0))
    return sources.withColumn("first", start + 1).withColumn("last", start + F.col("pages"))


def book_pages(counts: DataFrame) -> DataFrame:
    """(book, page): pages 1 to n of each book (book, n). Books are dealt out by blocks of pages, so a long one is not a single task's."""
    held = counts.where("n > 0").select("book", "n", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("n") - 1) / DEALT))).alias("_block"))
    first = F.col("_block") * DEALT + 1
    return held.repartition("book", "_block").select("book", F.explode(F.sequence(first, F.least(first + (DEALT - 1), F.col("n").cast("long")))).alias("page"))


def source_of(pages: DataFrame, sources: DataFrame) -> DataFrame:
    """(book, page, pdf, index): the source file of each page and the page's index in it, from 0.

    Sources meet pages by small blocks of pages, so a page sees the few files around it. The join is a merge join by its hint: what is made
    of a few rows by listing pages must not pass for a small table, which Spark would send to the driver.
    """
    block = lambda c: F.floor(F.col(c) / NEAR)
    some = source_pages(sources).where("first <= last")
    placed = some.select("book", "pdf", "first", "last", F.explode(F.sequence(block("first"), block("last"))).alias("_block"))
    return (
        pages.withColumn("_block", block("page"))
        .join(placed.hint("merge"), ["book", "_block"])
        .where(F.col("page").between(F.col("first"), F.col("last")))
        .select("book", "page", "pdf", (F.col("page") - F.col("first")).alias("index"))
    )


#: Pages of a block by which source files meet pages, and of one that a task lists at once.
NEAR, DEALT = 64, 1 << 14
#: Pages of a block by which intervals meet pages.
BLOCK = 1024


def intervals(spec: Column) -> Column:
    """`1-3,7` as an array of start and stop; null and empty have none."""
    parts = F.filter(F.transform(F.split(F.coalesce(spec.cast("string"), F.lit("")), ","), lambda p: F.btrim(p)), lambda p: p != "")
    ends = lambda p: F.transform(F.split(p, "-"), lambda x: F.btrim(x).cast("int"))
    return F.transform(parts, lambda p: F.struct(ends(p)[0].alias("start"), F.element_at(ends(p), -1).alias("stop")))


def merged(spans: DataFrame) -> DataFrame:
    """(book, start, stop): spans of pages as few disjoint ones; those that touch are one."""
    w = Window.partitionBy("book").orderBy("start", "stop")
    reached = F.max("stop").over(w.rowsBetween(Window.unboundedPreceding, -1))
    opens = F.coalesce(F.col("start") > reached + 1, F.lit(True))
    some = spans.where("start <= stop").select("book", "start", "stop")
    run = F.sum(F.col("_new").cast("int")).over(w)
    return some.withColumn("_new", opens).withColumn("_run", run).groupBy("book", "_run").agg(F.min("start").alias("start"), F.max("stop").alias("stop")).drop("_run")


def outside(pages: DataFrame, spans: DataFrame) -> DataFrame:
    """Rows (book, page, …) whose page lies in none of the spans (book, start, stop).

    Spans are merged and meet pages by blocks of pages, so neither a span's pages nor the pairs of a book are listed.
    """
    block = lambda c: F.floor(F.col(c) / BLOCK)
    held = merged(spans).select(F.col("book").alias("_book"), F.col("start").alias("_from"), F.col("stop").alias("_to"), F.explode(F.sequence(block("start"), block("stop"))).alias("_block"))
    asked = pages.withColumn("_at", block("page"))
    inside = (F.col("book") == F.col("_book")) & (F.col("_at") == F.col("_block")) & F.col("page").between(F.col("_from"), F.col("_to"))
    return asked.join(held, inside, "left_anti").drop("_at")


def section_starts(versions: DataFrame, intros: DataFrame) -> DataFrame:
    """(book, page): where a book's sections begin. versions: book, work, pages (as text); intros: book, pages. A work begins on its first page in any version."""
    first = F.array_min(F.transform(intervals(F.col("pages")), lambda x: x["start"]))
    works = versions.groupBy("book", "work").agg(F.min(first).alias("page")).where("page is not null").select("book", "page")
    opening = intros.select("book", F.get(intervals(F.col("pages")), F.lit(0))["start"].alias("page")).where("page is not null")
    return works.unionByName(opening).distinct()
