"""Sinks: bundles of a book's tables, files of the web edition, and the append-only log."""

from __future__ import annotations

import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import corrections, listing, publish


class Refused(ValueError):
    """What was to be written has problems; all of them are listed."""


def refuse(violations: DataFrame, most: int = 1000) -> None:
    """Raise if there is a problem. So many are listed at most; the message says how many there are."""
    n = violations.count()
    if n:
        shown = violations.orderBy("book", "problem").limit(most).collect()
        raise Refused(f"{n} problem(s):\n" + "\n".join(f"  {r.book}: {r.problem}" for r in shown))


def replaced(tables: dict[str, DataFrame], path: str) -> None:
    """Write tables, by folder below `path`, so that a reader finds all of the old ones or all of the new.

    They are written to a folder beside it, which then takes its place by renaming. A run that breaks off before that
    leaves what was there; one between the two renames leaves it as `<path>.before-…`.
    """
    spark = next(iter(tables.values())).sparkSession
    staged, before = (f"{path.rstrip('/')}.{word}-{uuid.uuid4().hex}" for word in ("new", "before"))
    for name, table in tables.items():
        table.write.format("json" if name in JSON else "parquet").partitionBy(*(["book"] if name in BY_BOOK else [])).save(f"{staged}/{name}")
    hadoop = spark._jvm.org.apache.hadoop.fs
    old, new, aside = (hadoop.Path(p) for p in (path, staged, before))
    fs = old.getFileSystem(spark._jsc.hadoopConfiguration())
    held = fs.exists(old)
    if held and not fs.rename(old, aside) or not fs.rename(new, old):
        raise OSError(f"{path} can't be replaced; its new tables are in {staged}")
    if held:
        fs.delete(aside, True)


#: Tables that are written as JSON lines; others are Parquet.
JSON = ("files", "contents", "pages", "manifest")
#: Tables with a folder a book.
BY_BOOK = ("text", "log", "toc", "notes", "passes", "files", "pages")


def append_log(entries: DataFrame, path: str) -> None:
    entries.write.mode("append").json(path)


def write_pages(entries: DataFrame, path: str) -> None:
    """The hand-off: pages as JSON lines, a folder a book, and a manifest of what each book has."""
    manifest = entries.groupBy("book").agg(F.count(F.lit(1)).alias("pages"), F.min("page").alias("first"), F.max("page").alias("last"))
    replaced({"pages": entries, "manifest": manifest}, path)


def write_final(blocks: DataFrame, log: DataFrame, draft: DataFrame, passes: DataFrame, path: str) -> None:
    """text, log, toc and notes of final books; nothing is written while there is a problem."""
    refuse(corrections.finalize_violations(blocks, draft, passes))
    entries, _ = corrections.final_toc(blocks, draft)
    notes = corrections.final_notes(blocks, entries)
    replaced({"text": blocks, "log": log, "toc": entries, "notes": notes, "passes": passes}, path)


def write_web(blocks: DataFrame, books: DataFrame, path: str) -> None:
    """The web edition as rows of (book, file, content) and its table of contents; all or nothing."""
    refuse(publish.violations(blocks, books))
    files = publish.web_files(blocks, books)
    story = F.struct("entry", "file", "start_page", "end_page", "n_notes")
    contents = files.select("book", story.alias("story")).groupBy("book").agg(F.array_sort(F.collect_list("story")).alias("stories"))
    replaced({"files": files.select("book", "file", "content"), "contents": contents}, path)


def update_listing(current: DataFrame, raw: DataFrame, model: DataFrame, path: str) -> None:
    """Bring the listing of spelling occurrences below `path` up to date; sections that didn't change keep their rows."""
    spark = current.sparkSession
    try:
        held = spark.read.parquet(f"{path}/sections"), spark.read.parquet(f"{path}/occurrences")
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        held = None
    sections, occurrences = listing.refreshed(held, current, raw, model)
    replaced({"sections": sections, "occurrences": occurrences}, path)
