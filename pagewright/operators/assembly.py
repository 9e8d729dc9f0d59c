"""Segments of pages to the blocks of a book, and what goes into and out of their texts.

Order is (page, seq) over a book. Joins across pages are running groups, so no page waits for another
in one process.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import text

FLAG = " ⚠"
#: A flag that says nothing about the text (fixed value).
SILENT = "dropcap?"


def flagged() -> Column:
    """Whether a segment's flags say that its text needs a look."""
    return F.size(F.array_except("flags", F.array(F.lit(SILENT)))) > 0


def joined_paragraphs(segments: DataFrame) -> DataFrame:
    """Segments of which a paragraph that goes on on the next page is one, at its first place.

    A word cut at its hyphen before a lower-case letter stays together; other parts join with a blank.
    """
    w = Window.partitionBy("book").orderBy("page", "seq")
    body = segments.where(~F.col("kind").isin("footnote", "line_number"))
    t = F.regexp_replace(text.collapsed(F.col("text")), r"^\\(?=[-–—])", "")
    goes_on = F.coalesce("continues", F.lit(False)) & (F.col("kind") == "paragraph") & (F.lag("kind").over(w) == "paragraph")
    df = body.withColumn("_t", F.when(goes_on, t).otherwise(text.collapsed(F.col("text")))).withColumn("_on", F.coalesce(goes_on, F.lit(False)))
    glued = F.lag("_t").over(w).rlike(r"\p{L}-$") & F.col("_t").rlike(r"^\p{Ll}")
    df = df.withColumn("_glue", F.when(~F.col("_on") | F.coalesce(glued, F.lit(False)), "").otherwise(" "))
    df = df.withColumn("_n", F.sum((~F.col("_on")).cast("int")).over(w))
    parts = F.transform(F.array_sort(F.collect_list(F.struct("page", "seq", "_glue", "_t"))), lambda x: F.concat(x["_glue"], x["_t"]))
    first = F.struct("page", "seq")
    return df.groupBy("book", "_n").agg(
        F.min(first)["page"].alias("page"),
        F.min(first)["seq"].alias("seq"),
        F.min_by("kind", first).alias("kind"),
        F.array_join(parts, "").alias("text"),
        F.bool_or(flagged()).alias("flagged"),
        F.min_by(F.coalesce("stanza_break", F.lit(False)), first).alias("stanza_break"),
        F.min_by("line_no", first).alias("line_no"),
    ).drop("_n")


def assembled(segments: DataFrame) -> DataFrame:
    """(book, idx, text): Markdown blocks. Verse lines up to a stanza's end are one block of hard breaks."""
    w = Window.partitionBy("book").orderBy("page", "seq")
    df = joined_paragraphs(segments)
    mark = F.when(F.col("flagged"), FLAG).otherwise("")
    said = F.concat(text.escaped_line(F.col("text")), mark)
    shown = (
        F.when(F.col("kind") == "heading", F.concat(F.lit("### "), F.col("text"), mark))
        .when(F.col("kind") == "speaker", F.concat(F.lit("**"), F.col("text"), F.lit("**"), mark))
        .when(F.col("kind") == "break", F.lit("* * *"))
        .otherwise(said)
    )
    same = (F.col("kind") == "verse") & (F.lag("kind").over(w) == "verse") & ~F.col("stanza_break")
    df = df.withColumn("_shown", shown).withColumn("_n", F.sum((~F.coalesce(same, F.lit(False))).cast("int")).over(w))
    lines = F.transform(F.array_sort(F.collect_list(F.struct("page", "seq", "_shown"))), lambda x: x["_shown"])
    blocks = df.groupBy("book", "_n").agg(F.array_join(lines, "  \n").alias("text"))
    return blocks.select("book", (F.row_number().over(Window.partitionBy("book").orderBy("_n")) - 1).alias("idx"), "text")


def preview(segments: DataFrame, pages: DataFrame) -> DataFrame:
    """(book, page, text): each page as Markdown under a line of its number, mode and language."""
    mark = F.when(F.size("flags") > 0, FLAG).otherwise("")
    number = F.when(F.col("line_no").isNotNull(), F.concat(F.col("line_no").cast("string"), F.lit(". "))).otherwise("")
    shown = (
        F.when(F.col("kind") == "heading", F.concat(F.lit("### "), "text", mark))
        .when(F.col("kind") == "verse", F.concat(F.when(F.col("stanza_break"), "\n").otherwise(""), number, "text", mark, F.lit("  ")))
        .when(F.col("kind") == "speaker", F.concat(F.lit("**"), "text", F.lit("**"), mark, F.lit("  ")))
        .when(F.col("kind") == "footnote", F.concat(F.lit("> "), "text", mark))
        .otherwise(F.concat(F.when(F.col("continues"), "… ").otherwise(""), "text", mark))
    )
    body = segments.where("kind <> 'line_number'").withColumn("_s", shown).groupBy("book", "page").agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("seq", "_s"))), lambda x: x["_s"]), "\n").alias("_body")
    )
    printed = F.when(F.col("printed_page_est").isNotNull(), F.concat(F.lit(" · tr. "), F.col("printed_page_est").cast("string"), F.when(F.col("printed_page_suspect"), "?").otherwise("")))
    head = F.concat(F.lit("## "), text.page_id(F.col("page").cast("int")), F.coalesce(printed, F.lit("")), F.lit(" · "), "mode", F.lit(" · "), F.coalesce("guess", F.lit("unknown")))
    return pages.join(body, ["book", "page"], "left").select("book", "page", F.concat_ws("\n\n", head, "_body").alias("text"))


def scene_breaks(segments: DataFrame, marks: DataFrame) -> DataFrame:
    """Segments with a break before the first one that stands below each mark (book, page, y), numbered anew."""
    below = segments.join(marks.select("book", "page", "y"), ["book", "page"]).where(F.col("bbox.y0") > F.col("y"))
    first = below.groupBy("book", "page", "y").agg(F.min("seq").alias("seq")).select("book", "page", "seq").distinct()
    added = first.withColumn("kind", F.lit("break")).withColumn("text", F.lit("* * *")).withColumn("_half", F.lit(0))
    every = segments.withColumn("_half", F.lit(1)).unionByName(added, allowMissingColumns=True)
    return every.withColumn("seq", F.row_number().over(Window.partitionBy("book", "page").orderBy("seq", "_half")) - 1).drop("_half")


def spliced(value: Column, edits: Column) -> Column:
    """A text with array<struct<start, stop, new>> put in; edits don't overlap. Blanks before an edit go."""
    start = F.struct(F.lit("").alias("out"), F.lit(0).alias("at"))

    def put(done, e):
        kept = F.substring(value, done["at"] + 1, e["start"] - done["at"])
        return F.struct(F.concat(done["out"], F.rtrim(kept), e["new"]).alias("out"), e["stop"].cast("int").alias("at"))

    return F.aggregate(F.array_sort(edits), start, put, lambda d: F.concat(d["out"], F.substring(value, d["at"] + 1, F.length(value))))


def sentence_around(value: Column, start: Column, stop: Column) -> Column:
    """The sentence that holds [start, stop), without that part."""
    before, after = F.substring(value, F.lit(1), start), F.substring(value, stop + 1, F.length(value))
    opened = F.regexp_replace(before, r"(?s)^.*[.!?…] ", "")
    closed = F.regexp_extract(after, r"(?s)^(.*?[.!?…])", 1)
    return F.btrim(F.concat(opened, F.when(closed != "", closed).otherwise(after)))


def word_before(value: Column, start: Column) -> Column:
    return F.regexp_extract(F.substring(value, F.lit(1), start), r"(\S+)\s*$", 1)


def scope_of(pages: DataFrame, configured: DataFrame, entries: DataFrame) -> DataFrame:
    """(book, page, scope): the configured range (book, scope, first, last) that holds a page, else its deepest entry."""
    held = configured.select("book", "scope", F.explode(F.sequence("first", "last")).alias("page")).groupBy("book", "page").agg(F.min("scope").alias("_set"))
    inside = entries.select("book", "id", "level", F.explode(F.sequence("pdf_start", "pdf_end")).alias("page"))
    deepest = inside.groupBy("book", "page").agg(F.max_by("id", F.struct("level", "id")).alias("_entry"))
    return pages.select("book", "page").distinct().join(held, ["book", "page"], "left").join(deepest, ["book", "page"], "left").select("book", "page", F.coalesce("_set", "_entry").alias("scope"))


def _suffixed(group: pd.DataFrame) -> pd.DataFrame:
    taken: set[str] = set()
    out = []
    for slug in group.sort_values("ord")["slug"]:
        name, n = slug, 2
        while name in taken:
            name, n = f"{slug}-{n}", n + 1
        taken.add(name)
        out.append(name)
    return pd.DataFrame({"book": group["book"], "ord": sorted(group["ord"]), "id": out})


def unique_ids(named: DataFrame) -> DataFrame:
    """(book, ord, id) of (book, ord, title): slugs, with -2, -3 … where one is taken, a book at a time.

    A made id can meet a real one, so each waits for those before it.
    """
    slugs = named.select("book", F.col("ord").cast("long").alias("ord"), text.slug(F.col("title")).alias("slug"))
    return slugs.groupBy("book").applyInPandas(_suffixed, "book string, ord long, id string")


#: What a digit may have been read for (fixed values of the print).
CONFUSED = {"8": "630", "6": "85", "3": "8", "5": "63", "1": "7", "7": "1", "0": "86"}


def one_slip_away(page: int) -> set[int]:
    """Numbers that one slip makes of a page number: a digit too many, or one read for another."""
    digits = str(page)
    cut = {digits[:i] + digits[i + 1 :] for i in range(len(digits))} if len(digits) > 1 else set()
    swapped = {digits[:i] + d + digits[i + 1 :] for i, c in enumerate(digits) for d in CONFUSED.get(c, "")}
    return {int(x) for x in cut | swapped}


def _monotone(group: pd.DataFrame) -> pd.DataFrame:
    """Pages that must rise: one not between its neighbours is read again, if just one reading a slip away lies there."""
    pages = [None if pd.isna(p) else int(p) for p in group.sort_values("ord")["printed_page"]]
    following: list[float] = [float("inf")]
    for page in reversed(pages[1:]):
        following.append(page or following[-1])
    low, out = 0, []
    for page, high in zip(pages, reversed(following), strict=True):
        if page is not None and not low < page < high:
            fits = [x for x in one_slip_away(page) if low < x < high]
            page = fits[0] if len(fits) == 1 else None
        out.append(page)
        low = page or low
    return pd.DataFrame({"book": group["book"], "ord": sorted(group["ord"]), "page": pd.array(out, dtype="Int64")})


def repaired_pages(entries: DataFrame) -> DataFrame:
    """(book, ord, page): the printed pages of contents entries, made to rise; null where not just one slip explains one."""
    needed = entries.select("book", F.col("ord").cast("long").alias("ord"), F.col("printed_page").cast("long").alias("printed_page"))
    return needed.groupBy("book").applyInPandas(_monotone, "book string, ord long, page long")
