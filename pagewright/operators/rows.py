"""OCR lines to visual rows, and rows of two engines side by side.

A box is struct<x0, y0, x1, y1> in parts of the page, from its top left corner. Pages are the natural
scope: every join has (book, page) as its equi key, so the overlap condition never meets more than a
page's rows, and every grouped function gets one page.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import similarity, text

#: Under this confidence a row is flagged.
LOW_CONFIDENCE = {"vision": 0.5, "tesseract": 0.75}
ALIKE = 0.9
OVERLAP = 0.5

LINE = "text string, conf double, bbox struct<x0: double, y0: double, x1: double, y1: double>, alternatives array<string>"
ROW = "book string, engine string, page int, row int, text string, bbox struct<x0: double, y0: double, x1: double, y1: double>, conf double, alternatives array<string>"


def height(box: Column) -> Column:
    return box["y1"] - box["y0"]


def overlap(a: Column, b: Column) -> Column:
    """Shared height of two boxes; may be negative."""
    return F.least(a["y1"], b["y1"]) - F.greatest(a["y0"], b["y0"])


def overlap_of_smaller(a: Column, b: Column) -> Column:
    least = F.least(height(a), height(b))
    return F.when(least > 0, F.greatest(overlap(a, b), F.lit(0.0)) / least).otherwise(F.lit(0.0))


def overlap_of_larger(a: Column, b: Column) -> Column:
    most = F.greatest(height(a), height(b))
    return F.when(most > 0, F.greatest(overlap(a, b), F.lit(0.0)) / most).otherwise(F.lit(0.0))


def union_box(box: Column) -> Column:
    """Aggregate: the box around all boxes of a group."""
    return F.struct(F.min(box["x0"]).alias("x0"), F.min(box["y0"]).alias("y0"), F.max(box["x1"]).alias("x1"), F.max(box["y1"]).alias("y1"))


def lines_from_words(words: DataFrame) -> DataFrame:
    """Tesseract's word table to lines: words of level 5 that aren't blank, by block, paragraph and line.

    words: book, page, width, height, level, block_num, par_num, line_num, word_num, left, top, width_px, height_px, conf, text.
    """
    some = words.where("level = 5 and trim(text) <> ''")
    keys = ["book", "page", "block_num", "par_num", "line_num"]
    ordered = F.transform(F.array_sort(F.collect_list(F.struct("word_num", "text", "conf"))), lambda w: F.struct(w["text"].alias("word"), (w["conf"] / 100).alias("conf")))
    grouped = some.groupBy(*keys).agg(
        ordered.alias("words"),
        F.avg(F.when(F.col("conf") >= 0, F.col("conf") / 100)).alias("conf"),
        F.struct(
            F.min(F.col("left") / F.col("width")).alias("x0"),
            F.min(F.col("top") / F.col("height")).alias("y0"),
            F.max((F.col("left") + F.col("width_px")) / F.col("width")).alias("x1"),
            F.max((F.col("top") + F.col("height_px")) / F.col("height")).alias("y1"),
        ).alias("bbox"),
    )
    place = Window.partitionBy("book", "page").orderBy("bbox.y0", "bbox.x0", "block_num", "par_num", "line_num")
    return grouped.select(
        "book",
        F.lit("tesseract").alias("engine"),
        "page",
        (F.row_number().over(place) - 1).alias("line"),
        F.array_join(F.transform("words", lambda w: w["word"]), " ").alias("text"),
        F.coalesce(F.round("conf", 3), F.lit(0.0)).alias("conf"),
        "bbox",
        "words",
        F.array().cast("array<string>").alias("alternatives"),
    )


def lines_from_observations(observations: DataFrame) -> DataFrame:
    """Recognised text with boxes measured from the bottom (x, y, w, h): flipped, three candidates kept, in reading order."""
    box = F.struct(F.col("x").alias("x0"), (1 - F.col("y") - F.col("h")).alias("y0"), (F.col("x") + F.col("w")).alias("x1"), (1 - F.col("y")).alias("y1"))
    place = Window.partitionBy("book", "page").orderBy("bbox.y0", "bbox.x0")
    return (
        observations.withColumn("bbox", box)
        .withColumn("line", F.row_number().over(place) - 1)
        .select("book", F.lit("vision").alias("engine"), "page", "line", F.element_at("candidates", 1).alias("text"), "conf", "bbox", F.slice("candidates", 2, 2).alias("alternatives"))
    )


def _page_rows(page: pd.DataFrame) -> pd.DataFrame:
    """Lines of one page to rows: each joins the first row all of whose lines it overlaps by half of the taller."""
    boxes = list(page["bbox"])
    order = sorted(range(len(page)), key=lambda i: (boxes[i]["y0"], boxes[i]["x0"]))
    rows: list[list[int]] = []

    def together(i: int, j: int) -> bool:
        a, b = boxes[i], boxes[j]
        most = max(a["y1"] - a["y0"], b["y1"] - b["y0"])
        return most > 0 and (min(a["y1"], b["y1"]) - max(a["y0"], b["y0"])) / most >= OVERLAP

    for i in order:
        home = next((r for r in rows if all(together(i, j) for j in r)), None)
        if home is None:
            rows.append([i])
        else:
            home.append(i)
    first, out = page.iloc[0], []
    for members in rows:
        members.sort(key=lambda i: boxes[i]["x0"])
        texts = [(page["text"].iloc[i] or "").strip() for i in members]
        box = {k: f(boxes[i][k] for i in members) for k, f in (("x0", min), ("y0", min), ("x1", max), ("y1", max))}
        others = [a for i in members for a in (page["alternatives"].iloc[i] if page["alternatives"].iloc[i] is not None else [])]
        out.append((" ".join(t for t in texts if t), box, min(float(page["conf"].iloc[i]) for i in members), others))
    out.sort(key=lambda r: (r[1]["y0"], r[1]["x0"]))
    return pd.DataFrame([(first["book"], first["engine"], first["page"], k, *r) for k, r in enumerate(out)], columns=[c.split()[0] for c in ("book", "engine", "page", "row", "text", "bbox", "conf", "alternatives")])


def group_rows(lines: DataFrame) -> DataFrame:
    """Lines (book, engine, page, text, conf, bbox, alternatives) to rows in reading order, page by page."""
    needed = lines.select("book", "engine", "page", "text", "conf", "bbox", "alternatives")
    return needed.groupBy("book", "engine", "page").applyInPandas(_page_rows, ROW)


def pair_rows(primary: DataFrame, secondary: DataFrame, engine: str = "vision") -> DataFrame:
    """Rows of the primary engine with what the secondary saw at their height, and rows that only it saw.

    Flags: low_conf, disagree, missing_in_secondary, only_in_secondary. A page that the secondary
    engine never read has neither text beside it nor the flag of a missing row.
    """
    p = primary.select("book", "page", "row", "text", "bbox", "conf", "alternatives")
    s = secondary.select("book", "page", F.col("row").alias("s_row"), F.col("text").alias("s_text"), F.col("bbox").alias("s_bbox"))
    met = p.select("book", "page", "row", "bbox").join(s, ["book", "page"]).where(overlap_of_smaller(F.col("bbox"), F.col("s_bbox")) >= OVERLAP)
    beside = met.groupBy("book", "page", "row").agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("s_row", "s_text"))), lambda x: x["s_text"]), " ").alias("secondary")
    )
    read = secondary.select("book", "page").distinct().withColumn("_read", F.lit(True))
    joined = p.join(beside, ["book", "page", "row"], "left").join(read, ["book", "page"], "left")
    a, b = text.collapsed(F.col("text")), text.collapsed(F.col("secondary"))
    compared = joined.withColumn("similarity", similarity.ratio(a, b)).withColumn("diff", similarity.word_diff(F.col("text"), F.col("secondary")))
    compared = compared.withColumn("_alike", similarity.ratio(text.compare_key(F.col("text")), text.compare_key(F.col("secondary"))))
    only_marks = F.forall("diff", lambda d: text.compare_key(d[0]) == text.compare_key(d[1]))
    flags = F.array_compact(
        F.array(
            F.when(F.col("conf") < LOW_CONFIDENCE.get(engine, 0.5), "low_conf"),
            F.when((F.size("diff") > 0) & ~only_marks & (F.col("_alike") < ALIKE), "disagree"),
            F.when(F.col("_read") & F.col("secondary").isNull(), "missing_in_secondary"),
        )
    )
    left = compared.select("book", "page", "text", "bbox", "conf", "alternatives", "secondary", "similarity", F.when(F.size("diff") > 0, F.col("diff")).alias("diff"), flags.alias("flags"))
    alone = s.join(met.select("book", "page", "s_row").distinct(), ["book", "page", "s_row"], "left_anti").where("trim(s_text) <> ''")
    right = alone.select(
        "book",
        "page",
        F.col("s_text").alias("text"),
        F.col("s_bbox").alias("bbox"),
        F.lit(0.0).alias("conf"),
        F.array().cast("array<string>").alias("alternatives"),
        F.col("s_text").alias("secondary"),
        F.lit(None).cast("double").alias("similarity"),
        F.lit(None).cast("array<array<string>>").alias("diff"),
        F.array(F.lit("only_in_secondary")).alias("flags"),
    )
    place = Window.partitionBy("book", "page").orderBy("bbox.y0", "bbox.x0", "text")
    return left.unionByName(right).withColumn("row", F.row_number().over(place) - 1)


def page_agreement(merged: DataFrame) -> DataFrame:
    """Rows, flagged rows and mean similarity of each page."""
    return merged.groupBy("book", "page").agg(
        F.count(F.lit(1)).alias("rows"), F.sum((F.size("flags") > 0).cast("long")).alias("flagged"), F.avg("similarity").alias("agreement")
    )


def lines_in_segments(lines: DataFrame, segments: DataFrame, removed: DataFrame) -> DataFrame:
    """Each line with the first segment that holds its middle, and its role: removed, footnote or body.

    A removed text takes as many lines as it stands in `removed`, the first ones: k-th meets k-th.
    """
    nth = lambda order: F.row_number().over(Window.partitionBy("book", "page", "_t").orderBy(order))
    gone = removed.select("book", "page", F.btrim("text").alias("_t"), "ord").withColumn("_k", nth("ord")).select("book", "page", "_t", "_k", F.lit(True).alias("_gone"))
    marked = lines.withColumn("_t", F.btrim("text")).withColumn("_k", nth("line")).join(gone, ["book", "page", "_t", "_k"], "left")
    x, y = (F.col("bbox.x0") + F.col("bbox.x1")) / 2, (F.col("bbox.y0") + F.col("bbox.y1")) / 2
    s = segments.select("book", "page", "seq", "kind", F.col("bbox").alias("s"))
    inside = x.between(F.col("s.x0") - 0.01, F.col("s.x1") + 0.01) & y.between(F.col("s.y0") - 0.005, F.col("s.y1") + 0.005)
    found = lines.join(s, ["book", "page"]).where(inside).groupBy("book", "page", "line").agg(F.min(F.struct("seq", "kind")).alias("_s"))
    role = F.when(F.col("_gone"), "removed").when(F.col("_s.kind") == "footnote", "footnote").otherwise("body")
    return marked.join(found, ["book", "page", "line"], "left").select(
        "book", "page", "line", "text", "bbox", role.alias("role"), F.when(~F.coalesce("_gone", F.lit(False)), F.col("_s.seq")).alias("seq")
    )
