"""The inventory of a library: split files beside master pages, versions, works, duplicates, what is left over, progress."""

from __future__ import annotations

import difflib
from functools import reduce

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import text
from .ranges import range_labels

#: Master pages of one image that a list holds at most.
LISTED = 64
#: Share of a title that a file of another version has to have to be the same work (fixed value).
WORK_ALIKE = 0.75


def matched_pages(split: DataFrame, masters: DataFrame) -> DataFrame:
    """(file, page, book, master_page) of split pages: the master page of the same image hashes with the most common places.

    split: file, page, hashes, coords. masters: book, page, ord, hashes, coords; ord decides ties. A page without hashes,
    or whose hashes no master page has, stays with nulls.
    """
    place = Window.partitionBy("hashes").orderBy("ord", "book", "page")
    known = masters.where(F.size("hashes") > 0).withColumn("_at", F.floor((F.row_number().over(place) - 1) / LISTED))
    lists = known.groupBy("hashes", "_at").agg(F.collect_list(F.struct(F.col("coords").alias("coords"), F.col("ord"), F.col("book"), F.col("page").alias("master_page"))).alias("_known"))
    # split pages meet lists of masters, so a row is made for each list and not for each master
    rank = lambda m: F.struct(F.size(F.array_intersect("coords", m["coords"])).alias("shared"), (-m["ord"]).alias("ord"), m["book"].alias("book"), m["master_page"].alias("master_page"))
    met = split.where(F.size("hashes") > 0).join(lists, "hashes").select("file", "page", F.array_max(F.transform("_known", rank)).alias("_b"))
    best = met.groupBy("file", "page").agg(F.max_by(F.struct("_b.book", "_b.master_page"), F.struct("_b.shared", "_b.ord")).alias("_m"))
    return split.select("file", "page").join(best, ["file", "page"], "left").select("file", "page", "_m.book", "_m.master_page")


def version_of(folder: Column, kinds: list[tuple[str, str]], default: str) -> Column:
    """The kind of a version by its folder's name: of the first prefix (prefix, kind) that the slug has, else the slug; no folder is the default."""
    slug = text.slug(folder)
    found = reduce(lambda c, k: c.when(slug.startswith(k[0]), k[1]), kinds, F.when(folder.isNull(), default))
    return found.otherwise(slug)


def duplicate_files(files: DataFrame) -> DataFrame:
    """(book, version, file, same_pages_as): files of one version whose pages an earlier one has; files: book, version, ord, file, pages."""
    w = Window.partitionBy("book", "version", "pages").orderBy("ord", "file")
    named = files.withColumn("same_pages_as", F.first("file").over(w)).withColumn("_n", F.row_number().over(w))
    return named.where("_n > 1").select("book", "version", "file", "same_pages_as")


def _works(files: pd.DataFrame) -> pd.DataFrame:
    """Files in order of version: each goes to the likest work that hasn't its version yet, or opens one."""
    files = files.assign(version=files["version"].fillna("")).sort_values(["version", "ord"])
    per_version = files.groupby("version").size()
    single = len(per_version) > 1 and (per_version == 1).all()
    works: list[tuple[str, set[str]]] = []
    numbers = []
    for row in files.itertuples():
        if single:
            home = 0 if works else None
        else:
            alike = [(difflib.SequenceMatcher(None, t, row.key).ratio(), -k) for k, (t, versions) in enumerate(works) if row.version not in versions]
            best = max(alike, default=(0.0, 0))
            home = -best[1] if best[0] >= WORK_ALIKE else None
        if home is None:
            home = len(works)
            works.append((row.key, set()))
        works[home][1].add(row.version)
        numbers.append(home)
    return pd.DataFrame({"book": files["book"], "file": files["file"], "work": numbers})


def grouped_works(files: DataFrame) -> DataFrame:
    """(book, file, work): files of a book (book, version, ord, file, title) put into works, numbered from 0, a book at a time."""
    keyed = files.select("book", "version", F.col("ord").cast("long").alias("ord"), "file", text.alnum_key(F.col("title")).alias("key"))
    return keyed.groupBy("book").applyInPandas(_works, "book string, file string, work long")


def works_by_page(works: DataFrame) -> DataFrame:
    """works (book, work, pages array) with `place`, from 1: by their first page, those without pages first."""
    first = F.coalesce(F.array_min("pages"), F.lit(0))
    return works.withColumn("place", F.row_number().over(Window.partitionBy("book").orderBy(first, "work")))


def unassigned_pages(books: DataFrame, covered: DataFrame) -> DataFrame:
    """(book, pages): the pages of books (book, page_count) that no version covers (book, page), as a label."""
    every = books.where("page_count > 0").select("book", F.explode(F.sequence(F.lit(1).cast("long"), F.col("page_count").cast("long"))).alias("page"))
    left = every.join(covered.select("book", F.col("page").cast("long").alias("page")).distinct(), ["book", "page"], "left_anti")
    return range_labels(left, ["book"], "page")


def progress(books: DataFrame, stages: dict[str, DataFrame]) -> DataFrame:
    """books (book) with the number of different pages that each stage (book, page) has of it."""
    for name, done in stages.items():
        counted = done.groupBy("book").agg(F.countDistinct("page").alias(name))
        books = books.join(counted, "book", "left").fillna(0, [name])
    return books


def flagged_rates(agreement: DataFrame) -> DataFrame:
    """(book, rows, flagged, rate) over all pages (book, page, rows, flagged); 0 of no rows."""
    summed = agreement.groupBy("book").agg(F.sum("rows").alias("rows"), F.sum("flagged").alias("flagged"))
    return summed.withColumn("rate", F.when(F.col("rows") > 0, F.col("flagged") / F.col("rows")).otherwise(F.lit(0.0)))


#: What a page's language may be guessed to be (fixed values).
GUESSES = ("vi", "mixed", "other", "unknown")


def language_counts(pages: DataFrame) -> DataFrame:
    """(book, vi, mixed, other, unknown): pages (book, guess) by their guessed language."""
    return pages.groupBy("book").agg(*[F.count_if(F.col("guess") == g).alias(g) for g in GUESSES])
