"""Markdown books as tables of blocks and sections.

blocks: book, idx, text. sections: book, k, title, level, start, end (exclusive), pdf_a, pdf_b, flags.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import text

#: The title of what stands before the first heading (fixed value).
BEFORE_HEADINGS = "(trước tiêu đề)"
#: Length of a probe (fixed value).
PROBE = 16


def split_blocks(books: DataFrame, separator: str = "\n\n") -> DataFrame:
    """(book, idx, text) of books (book, text): trailing newlines go; an empty book has no blocks."""
    body = F.regexp_replace("text", r"\n+$", "")
    some = books.withColumn("_t", body).where("_t <> ''")
    return some.select("book", F.posexplode(F.split("_t", separator)).alias("idx", "text"))


def join_blocks(blocks: DataFrame, keys: list[str], order: str = "idx", separator: str = "\n\n") -> DataFrame:
    """The inverse of split_blocks: one text a key, with one newline at its end."""
    parts = F.transform(F.array_sort(F.collect_list(F.struct(order, "text"))), lambda x: x["text"])
    return blocks.groupBy(*keys).agg(F.concat(F.array_join(parts, separator), F.lit("\n")).alias("text"))


def with_sections(blocks: DataFrame) -> DataFrame:
    """blocks with the number of their section, from 0; text before the first heading is a section of its own."""
    w = Window.partitionBy("book").orderBy("idx")
    heading = (text.heading_level(F.col("text")) > 0).cast("int")
    counted = blocks.withColumn("_n", F.sum(heading).over(w))
    return counted.withColumn("k", F.col("_n") - F.min("_n").over(Window.partitionBy("book"))).drop("_n")


def clean_title(heading: Column) -> Column:
    """A heading's text without its marks, note calls and line breaks."""
    body = F.regexp_extract(heading, r"(?s)^#{1,6}\s+(.*)$", 1)
    return F.btrim(F.regexp_replace(F.regexp_replace(body, r"\[\^[^\]\s]+\]:?", ""), r"\s*\n#*\s*", " "))


def sections(blocks: DataFrame) -> DataFrame:
    placed = with_sections(blocks)
    level = text.heading_level(F.col("text"))
    first_page = F.regexp_extract("text", r"^<!--\s*pdf\s+(\d+)", 1)
    last_page = F.regexp_extract("text", r"^<!--\s*pdf\s+\d+-(\d+)", 1)
    is_range = first_page != ""
    return placed.groupBy("book", "k").agg(
        F.coalesce(F.min_by(F.when(level > 0, clean_title(F.col("text"))), "idx"), F.lit(BEFORE_HEADINGS)).alias("title"),
        F.coalesce(F.min_by(F.when(level > 0, level), "idx"), F.lit(1)).alias("level"),
        F.min("idx").alias("start"),
        (F.max("idx") + 1).alias("end"),
        F.min_by(F.when(is_range, first_page.cast("int")), F.when(is_range, F.col("idx"))).alias("pdf_a"),
        F.min_by(F.when(is_range, F.coalesce(F.when(last_page != "", last_page.cast("int")), first_page.cast("int"))), F.when(is_range, F.col("idx"))).alias("pdf_b"),
        F.sum(F.regexp_count("text", F.lit("⚠"))).alias("flags"),
    )


def flagged_sections(blocks: DataFrame) -> DataFrame:
    """(book, title, flags) of the sections that still have a mark."""
    return sections(blocks).where("flags > 0").select("book", "title", "flags")


def zip_sections(mine: DataFrame, theirs: DataFrame) -> DataFrame:
    """Sections of two books paired by order, and `paired`: both stand there with the same level."""
    left = mine.select("book", "k", F.col("title").alias("title_a"), F.col("level").alias("level_a"))
    right = theirs.select("book", "k", F.col("title").alias("title_b"), F.col("level").alias("level_b"))
    return left.join(right, ["book", "k"], "full").withColumn("paired", F.col("level_a").eqNullSafe(F.col("level_b")))


def probes(letters: Column) -> Column:
    """What of a text's letters to look for: none under 3, all up to 16, else 16 at a quarter, half and three quarters."""
    n = F.length(letters)
    at = lambda p: F.substring(letters, p + 1, F.lit(PROBE))
    three = F.array_distinct(F.array(at(F.floor(n / 4).cast("int")), at(F.floor(n / 2).cast("int")), at((F.floor(n * 3 / 4) - PROBE // 2).cast("int"))))
    return F.when(n < 3, F.array().cast("array<string>")).when(n <= PROBE, F.array(letters)).otherwise(three)


def locate_blocks(blocks: DataFrame, segments: DataFrame) -> DataFrame:
    """(book, idx, page, seq, bbox): segments on a block's section's pages that the block's text holds.

    A segment is looked for by its probes, with and without the number a heading opens with.
    """
    placed = with_sections(blocks).join(sections(blocks).select("book", "k", "pdf_a", "pdf_b"), ["book", "k"])
    plain = F.regexp_replace(F.regexp_replace("text", r"\[\^[^\]\s]+\]:?", ""), r"(?s)<!--.*?-->", "")
    unnumbered = F.regexp_replace(plain, r"^#+\s*(?:[\dIVXLA-Z]{1,4}\.\s+)?", "")
    texts = placed.where(~text.block_kind(F.col("text")).isin("comment", "break") & F.col("pdf_a").isNotNull())
    texts = texts.select("book", "idx", F.explode(F.sequence("pdf_a", "pdf_b")).alias("page"), F.array(text.bare_letters(plain), text.bare_letters(unnumbered)).alias("_norms"))
    said = F.when(F.col("kind") == "footnote", F.regexp_replace("text", r"^\s*\(?\*?\d*\)\s*", "")).otherwise(F.col("text"))
    sought = segments.select("book", "page", "seq", "bbox", F.explode(probes(text.bare_letters(said))).alias("_probe"))
    hit = F.exists("_norms", lambda m: F.when(F.length("_probe") >= 8, m.contains(F.col("_probe"))).otherwise(m == F.col("_probe")))
    return texts.join(sought, ["book", "page"]).where(hit).select("book", "idx", "page", "seq", "bbox").distinct()


def known_boxes(blocks: DataFrame, boxes: DataFrame) -> DataFrame:
    """Boxes kept under a text's sha1: where several entries have it, the one nearest in the book; the earlier on ties."""
    keyed = blocks.withColumn("sha1", F.sha1(F.col("text").cast("binary")))
    met = keyed.join(boxes.where(F.size("boxes") > 0), ["book", "sha1"])
    best = F.min(F.struct(F.abs(F.col("i") - F.col("idx")).alias("d"), "i", "boxes"))
    return met.groupBy("book", "idx").agg(best.alias("_b")).select("book", "idx", "_b.boxes")
