"""The web edition: every problem of a final book listed together, and its files where there is none."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import text
from .blocks import with_sections
from .notes import audit, definitions, renumbered

#: The section that opens a book, and what the web edition says of problems, in its own words (fixed values).
PREFACE = "Lời giới thiệu"


def entries(blocks: DataFrame) -> DataFrame:
    """Level-2 headings in order: book, entry (from 0), idx, name, number, until (index of the next entry)."""
    w = Window.partitionBy("book").orderBy("idx")
    heads = blocks.where(text.heading_level(F.col("text")) == 2)
    name = F.btrim(F.regexp_replace(F.regexp_replace("text", r"\[\^([^\]\s]+)\](?!:)", ""), r"^##\s+", ""))
    number = F.regexp_extract(name, r"^(\d+)\.\s+", 1)
    placed = heads.select("book", "idx", name.alias("name"), F.when(number != "", number.cast("int")).alias("number"))
    last = F.lead("idx").over(w)
    return placed.withColumn("entry", F.row_number().over(w) - 1).withColumn("until", F.coalesce(last, F.lit(1 << 30)))


def entry_blocks(blocks: DataFrame) -> DataFrame:
    """Blocks with the entry they stand in; null before the first."""
    w = Window.partitionBy("book").orderBy("idx")
    n = F.sum((text.heading_level(F.col("text")) == 2).cast("int")).over(w)
    return blocks.withColumn("entry", F.when(n > 0, n - 1))


def violations(blocks: DataFrame, books: DataFrame) -> DataFrame:
    """(book, problem): all that would publish a broken book. books: book, printed_page_offset, stories."""
    short = text.shortened
    listed = entries(blocks)
    placed = entry_blocks(blocks)
    found = [
        books.where("printed_page_offset is null").select("book", F.lit("the book has no printed page offset").alias("problem")),
        placed.where(F.col("entry").isNull() & (text.heading_level(F.col("text")) != 1) & (text.block_kind(F.col("text")) != "comment")).select("book", F.concat(F.lit("text before the first entry: "), short(F.col("text"))).alias("problem")),
        listed.where(((F.col("entry") == 0) & (F.col("name") != PREFACE)) | ((F.col("entry") > 0) & ~F.col("number").eqNullSafe(F.col("entry")))).select("book", F.concat(short(F.col("name")), F.lit(" is where "), F.when(F.col("entry") == 0, PREFACE).otherwise(F.concat(F.lit("story "), F.col("entry").cast("string"))), F.lit(" should be")).alias("problem")),
    ]
    below = blocks.select("book", (F.col("idx") - 1).alias("idx"), F.col("text").rlike(r"^<!--\s*pdf\s+\d+").alias("_pdf"))
    found.append(listed.join(below, ["book", "idx"], "left").where(~F.coalesce("_pdf", F.lit(False))).select("book", F.concat("name", F.lit(" has no page comment under it")).alias("problem")))
    counted = listed.groupBy("book").agg(F.count(F.lit(1)).alias("_n"))
    missing = books.join(counted, "book", "left").withColumn("_n", F.coalesce("_n", F.lit(0)))
    lost = missing.select("book", F.explode(F.when(F.col("_n") <= F.col("stories"), F.sequence(F.col("_n"), F.col("stories")))).alias("_k"))
    found.append(lost.select("book", F.when(F.col("_k") == 0, F.concat(F.lit(PREFACE), F.lit(" is missing"))).otherwise(F.concat(F.lit("story "), F.col("_k").cast("string"), F.lit(" is missing"))).alias("problem")))
    found.append(listed.join(books, "book").where("entry > stories").select("book", F.concat(F.lit("after the last story: "), "name").alias("problem")))
    marked = audit(blocks)
    note = F.concat(F.lit("[^"), "note_id", F.lit("] "))
    says = F.array_compact(
        F.array(
            F.when(F.col("n_defined") > 1, "is defined twice"),
            F.when(F.col("n_called") > 1, F.concat(F.lit("is called "), F.col("n_called").cast("string"), F.lit(" times"))),
            F.when((F.col("n_called") > 0) & (F.col("n_defined") == 0), "is called but has no definition"),
            F.when((F.col("n_called") == 0) & (F.col("n_defined") > 0), "is defined but never called"),
        )
    )
    found.append(marked.select("book", note.alias("_n"), F.explode(says).alias("_s")).select("book", F.concat("_n", "_s").alias("problem")))
    d = definitions(blocks)
    found.append(d.where("page is null").select("book", F.concat(note, F.lit("has no page in its definition")).alias("problem")))
    found.append(d.where(text.unsupported_markdown(F.col("text"))).select("book", F.concat(note, F.lit("has Markdown the website does not render")).alias("problem")))
    body = placed.where(F.col("entry").isNotNull() & (text.heading_level(F.col("text")) != 2) & ~text.block_kind(F.col("text")).isin("note", "comment"))
    shown = text.website_dialect(F.regexp_replace(F.regexp_replace("text", r"(?s)\s*<!--.*?-->", ""), r"\[\^[^\]\s]+\](?!:)", ""))
    found.append(body.where(text.unsupported_markdown(shown)).select("book", F.concat(F.lit("Markdown the website does not render: "), short(F.col("text"))).alias("problem")))
    every = found[0]
    for more in found[1:]:
        every = every.unionByName(more)
    return every


def web_files(blocks: DataFrame, books: DataFrame) -> DataFrame:
    """(book, entry, file, content, start_page, end_page, n_notes) of books without a violation."""
    sound = books.join(violations(blocks, books).select("book").distinct(), "book", "left_anti")
    placed = entry_blocks(with_sections(blocks)).join(sound, "book").where("entry is not null")
    numbers = renumbered(blocks).groupBy("book", "k").agg(F.map_from_entries(F.collect_list(F.struct("note_id", F.col("number").cast("string")))).alias("_numbers"))
    body = placed.where(~text.block_kind(F.col("text")).isin("note", "comment")).join(numbers, ["book", "k"], "left")
    plain = F.regexp_replace("text", r"(?s)\s*<!--.*?-->", "")
    last = Window.partitionBy("book", "entry").orderBy(F.col("idx").desc())
    body = body.withColumn("_closing", (F.col("entry") == 0) & (F.row_number().over(last) == 1)).withColumn("_t", plain)
    pieces = F.transform(F.split("_t", r"\[\^(?=[^\]\s]+\](?!:))"), lambda p: p)
    tail = lambda p: F.concat(F.lit("[^"), F.coalesce(F.element_at("_numbers", F.regexp_extract(p, r"^([^\]]+)\]", 1)), F.lit("?")), F.regexp_replace(p, r"^[^\]]+", ""))
    renamed = F.array_join(F.concat(F.slice(pieces, 1, 1), F.transform(F.slice(pieces, 2, 1 << 20), tail)), "")
    body = body.withColumn("_t", F.when(F.size(pieces) > 1, renamed).otherwise(F.col("_t"))).withColumn("_t", text.website_dialect(F.col("_t"), F.col("_closing")))
    ordered = lambda order, value: F.transform(F.array_sort(F.collect_list(F.struct(order, value))), lambda x: x[value])
    bodies = body.groupBy("book", "entry").agg(ordered("idx", "_t").alias("_body"))
    d = definitions(blocks).join(renumbered(blocks), ["book", "k", "note_id"]).join(sound, "book")
    line = F.concat(F.lit("[^"), F.col("number").cast("string"), F.lit("]: (Trang "), (F.col("page") - F.col("printed_page_offset")).cast("string"), F.lit(") "), F.col("text"))
    where_ = with_sections(entry_blocks(blocks)).select("book", "idx", "entry")
    notes = d.withColumn("_line", line).join(where_, ["book", "idx"]).groupBy("book", "entry").agg(ordered("number", "_line").alias("_notes"))
    pages = placed.withColumn("_a", F.regexp_extract("text", r"^<!--\s*pdf\s+(\d+)", 1)).withColumn("_b", F.regexp_extract("text", r"^<!--\s*pdf\s+\d+-(\d+)", 1)).where("_a <> ''")
    first = F.min_by(F.struct(F.col("_a").cast("int").alias("a"), F.when(F.col("_b") != "", F.col("_b").cast("int")).otherwise(F.col("_a").cast("int")).alias("b")), "idx")
    ranges = pages.groupBy("book", "entry", "printed_page_offset").agg(first.alias("_p"))
    whole = bodies.join(notes, ["book", "entry"], "left").join(ranges, ["book", "entry"], "left")
    blocks_out = F.when(F.col("_notes").isNotNull(), F.concat("_body", F.array(F.lit("---"), F.lit("### Chú thích")), "_notes")).otherwise(F.col("_body"))
    name = F.when(F.col("entry") == 0, "loi_gioi_thieu.md").otherwise(F.format_string("story_%03d.md", F.col("entry").cast("int")))
    return whole.select("book", "entry", name.alias("file"), F.concat(F.array_join(blocks_out, "\n\n"), F.lit("\n")).alias("content"), (F.col("_p.a") - F.col("printed_page_offset")).alias("start_page"), (F.col("_p.b") - F.col("printed_page_offset")).alias("end_page"), F.coalesce(F.size("_notes"), F.lit(0)).alias("n_notes"))
