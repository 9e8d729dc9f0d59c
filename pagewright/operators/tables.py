"""Ruled tables in the text: segments inside a table's box give way to it, and a header goes on over its pages."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import similarity, text

#: A segment lies in a table if the middle of its height does, with so much room.
ROOM = 0.01
#: A page's first row is the header again if it is this much like it.
HEADER_ALIKE = 0.5


def pipe_table(rows: Column) -> Column:
    """Rows of cells as a Markdown table; the first row is its header, short rows are filled up."""
    width = F.array_max(F.transform(rows, F.size))
    lines = F.transform(rows, lambda r: text.table_row(r, width))
    rule = F.concat(F.lit("|"), F.repeat(F.lit("---|"), width))
    return F.array_join(F.concat(F.slice(lines, 1, 1), F.array(rule), F.slice(lines, F.lit(2), F.greatest(F.size(lines) - 1, F.lit(0)))), "\n")


def with_headers(tables: DataFrame) -> DataFrame:
    """tables (book, table, page, rows) whose later pages begin with the header of the first one that was read, where they don't have it."""
    w = Window.partitionBy("book", "table").orderBy("page").rowsBetween(Window.unboundedPreceding, -1)
    header = F.first(F.get("rows", F.lit(0)), ignorenulls=True).over(w)
    key = lambda c: text.alnum_key(F.array_join(c, " "))
    led = tables.withColumn("_header", header).withColumn("_like", similarity.ratio(key(F.get("rows", F.lit(0))), key(F.col("_header"))))
    rows = F.when(F.col("_header").isNotNull() & (F.col("_like") < HEADER_ALIKE), F.concat(F.array("_header"), "rows")).otherwise(F.col("rows"))
    return led.withColumn("rows", rows).drop("_header", "_like")


def table_text(tables: DataFrame) -> DataFrame:
    """tables with `text`: the Markdown that stands for a page of a table; of a table's pages that weren't read, the first says so."""
    w = Window.partitionBy("book", "table", F.col("rows").isNull()).orderBy("page")
    left_out = F.when(F.size("dropped") > 0, F.concat(F.lit("; column "), F.array_join("dropped", ", "), F.lit(" left out"))).otherwise("")
    note = F.concat(F.lit("<!-- table read cell by cell from pdf "), F.col("page"), left_out, F.lit(" -->\n\n"), pipe_table(F.col("rows")))
    failed = F.when(F.row_number().over(w) == 1, F.concat(F.lit("<!-- table not parsed, see pdf "), "pages", F.lit(" -->"))).otherwise("")
    return with_headers(tables).withColumn("text", F.when(F.col("rows").isNotNull(), note).otherwise(failed))


def placed_tables(segments: DataFrame, tables: DataFrame) -> DataFrame:
    """Segments in which a table's text stands for all it covers, at the first of them, as a segment of kind `table`.

    segments: book, page, seq, kind, text, bbox. tables: book, table (its number), pages (as it is called), page, bbox, rows (null where no
    grid was found: then the page's segments go), dropped (columns left out). Where tables overlap, the one of the smaller number covers a segment.
    """
    middle = (F.col("bbox.y0") + F.col("bbox.y1")) / 2
    asked = table_text(tables).select("book", "page", "table", F.col("bbox").alias("_box"), F.col("rows").isNotNull().alias("_read"), F.col("text").alias("_text"))
    covered = ~F.col("_read") | middle.between(F.col("_box.y0") - ROOM, F.col("_box.y1") + ROOM)
    hits = segments.select("book", "page", "seq", "bbox").join(asked, ["book", "page"]).where(covered)
    hits = hits.groupBy("book", "page", "seq").agg(F.min_by(F.struct("table", "_text"), "table").alias("_t"))
    first = F.row_number().over(Window.partitionBy("book", "page", "_t.table").orderBy("seq")) == 1
    hits = hits.withColumn("_first", first).select("book", "page", "seq", F.col("_t._text").alias("_text"), "_first")
    met = segments.join(hits, ["book", "page", "seq"], "left")
    kept = met.where(F.col("_first").isNull() | (F.col("_first") & (F.col("_text") != "")))
    instead = {"kind": F.when(F.col("_first"), "table").otherwise(F.col("kind")), "text": F.coalesce("_text", "text")}
    return kept.withColumns(instead).select(*segments.columns)
