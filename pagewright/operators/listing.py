"""Listing of spelling occurrences that is kept from run to run: a section is worked out again only if its text changed.

Rows hang on a section's version, a digest of its texts in all readings, and count blocks from the section's first, so sections
that merely move keep theirs. What depends on the whole book (which words are common) is put on when the listing is read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import spelling
from .blocks import with_sections

ROWS = ("start", "stop", "word", "fold", "ocr", "ai", "heading", "before", "after")


def versions(current: DataFrame, raw: DataFrame, model: DataFrame) -> DataFrame:
    """(book, k, first, version) of the current text's sections; blocks come with their k."""

    def digest(blocks: DataFrame, name: str) -> DataFrame:
        parts = F.transform(F.sort_array(F.collect_list(F.struct("idx", "text"))), lambda x: F.coalesce(x["text"], F.lit("")))
        first = [F.min("idx").alias("first")] if name == "_current" else []
        return blocks.groupBy("book", "k").agg(F.sha2(F.to_json(parts), 256).alias(name), *first)

    joined = digest(current, "_current").join(digest(raw, "_raw"), ["book", "k"], "left").join(digest(model, "_model"), ["book", "k"], "left")
    whole = F.sha2(F.concat_ws(":", "_current", F.coalesce("_raw", F.lit("-")), F.coalesce("_model", F.lit("-"))), 256)
    return joined.select("book", "k", "first", whole.alias("version"))


def changed(held: DataFrame | None, now: DataFrame) -> DataFrame:
    """Sections (book, k, first, version) whose version isn't held; of sections alike the first."""
    first = F.row_number().over(Window.partitionBy("book", "version").orderBy("k")) == 1
    new = now if held is None else now.join(held.select("book", "version"), ["book", "version"], "left_anti")
    return new.withColumn("_first", first).where("_first").select("book", "k", "first", "version")


def refreshed(held: tuple[DataFrame, DataFrame] | None, current: DataFrame, raw: DataFrame, model: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(sections, occurrences) after a run. held: what the run before gave. Blocks: book, idx, text.

    sections: book, version, k, first, fresh (worked out in this run). occurrences: book, version, block (from the section's first) and ROWS.
    """
    cut = [with_sections(b.select("book", "idx", "text")) for b in (current, raw, model)]
    now = versions(*cut)
    new = changed(held[0] if held else None, now)
    mine = [b.join(new.select("book", "k"), ["book", "k"], "left_semi") for b in cut]
    none = current.sparkSession.createDataFrame([], "book string, fold string")
    found = spelling.find_pairs(*mine, none).join(new, ["book", "k"])
    rows = found.select("book", "version", (F.col("idx") - F.col("first")).cast("long").alias("block"), *ROWS)
    fresh = new.select("book", "version", F.lit(True).alias("_new"))
    sections = now.join(fresh, ["book", "version"], "left").select("book", "version", "k", "first", F.coalesce("_new", F.lit(False)).alias("fresh"))
    if held is None:
        return sections, rows
    kept = held[1].join(now.select("book", "version").distinct(), ["book", "version"], "left_semi")
    return sections, kept.select(*rows.columns).unionByName(rows)


def listed(sections: DataFrame, occurrences: DataFrame, common: DataFrame) -> DataFrame:
    """Occurrences as `spelling.find_pairs` gives them, by the book's common words (book, fold)."""
    met = occurrences.join(sections.select("book", "version", "k", "first"), ["book", "version"])
    met = met.join(common.select("book", "fold").distinct().withColumn("_common", F.lit(True)), ["book", "fold"], "left")
    named = met.withColumn("name", F.col("_common").isNull() & ~F.col("heading")).withColumn("idx", F.col("first") + F.col("block"))
    differs = lambda c: F.coalesce(F.lower(c) != F.lower("word"), F.lit(False))
    # a row that no reading differs in is held for its two spellings, which only a name's count
    kept = named.where(differs("ocr") | differs("ai") | F.col("name"))
    return kept.select("book", "k", "idx", "start", "stop", "word", "fold", "ocr", "ai", "heading", "name", "before", "after")
