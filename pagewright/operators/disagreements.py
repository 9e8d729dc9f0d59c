"""Where a book's contents, its catalogue and its pages disagree: rules side by side, a row for each one that an entry breaks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import similarity, text
from .toc import heading_score

#: A heading is another one below this likeness; titles differ below the second.
SAME_HEADING, SAME_TITLE = 0.5, 0.9


def _bare(title: Column) -> Column:
    """A title without its brackets, as a key."""
    return text.alnum_key(F.substring_index(title, "(", 1))


def measured(entries: DataFrame) -> DataFrame:
    """entries with `start` (the page of the contents, else of the catalogue) and the likeness of their headings and titles."""
    title, listed = F.col("title"), F.coalesce("structure_title", "title")
    key = text.alnum_key
    head = F.col("heading")
    score = F.greatest(heading_score(key(title), key(head)), heading_score(key(listed), key(head)))
    like = F.least(similarity.ratio(_bare(F.col("heading_title")), _bare(title)), similarity.ratio(_bare(F.col("heading_title")), _bare(listed)))
    return entries.withColumn("start", F.coalesce("pdf_start", "structure_start")).withColumn("_score", score).withColumn("_like", like)


def rules() -> dict[str, tuple[Column, Column]]:
    """For each kind of disagreement: when an entry shows it, and what is said of it."""
    said = lambda pattern, *c: F.format_string(pattern, *[F.coalesce(F.col(x).cast("string"), F.lit("-")) for x in c])
    known, seen = F.col("structure_start").isNotNull(), F.col("heading").isNotNull()
    apart = (F.col("structure_start") != F.col("start")) | ~F.col("structure_end").eqNullSafe(F.col("pdf_end"))
    return {
        "no page": (F.col("pdf_start").isNull() & known, said("no page in the contents; %s from the catalogue", "structure_start")),
        "other pages": (known & apart, said("pages %s-%s by the contents, %s-%s by the catalogue", "start", "pdf_end", "structure_start", "structure_end")),
        "other printed page": (F.col("printed_page") != F.col("printed_page_est"), said("page %s in the contents, printed page %s", "printed_page", "printed_page_est")),
        "no heading": (~seen, said("no heading on page %s", "start")),
        "unlike heading": (seen & (F.col("_score") < SAME_HEADING), said("heading '%s' is not '%s'", "heading", "title")),
        "other titles": (seen & (F.col("_score") >= SAME_HEADING) & (F.col("_like") < SAME_TITLE), said("heading '%s', contents '%s', catalogue '%s'", "heading", "title", "structure_title")),
    }


def report(entries: DataFrame) -> DataFrame:
    """(book, ord, kind, page, said): what entries disagree in; one pass over them, whatever the number of rules.

    entries: book, ord, title, structure_title, printed_page, printed_page_est, pdf_start, pdf_end, structure_start, structure_end,
    heading (all of its rows), heading_title. What is null is not known and breaks no rule but those that ask for it.
    """
    each = [F.when(F.coalesce(when, F.lit(False)), F.struct(F.lit(kind).alias("kind"), said.alias("said"))) for kind, (when, said) in rules().items()]
    found = measured(entries).select("book", "ord", F.col("start").alias("page"), F.explode(F.array_compact(F.array(*each))).alias("_d"))
    return found.select("book", "ord", "_d.kind", "page", "_d.said")
