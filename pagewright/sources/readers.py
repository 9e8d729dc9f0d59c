"""Sources: what the digitisation pipeline leaves on disk, read with fixed schemas.

A schema is never inferred: a key that a file leaves out is null. Paths go to Spark's readers alone.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import similarity, text

BOX = "array<double>"
OCR_PAGE = f"engine string, page int, image_size array<int>, lines array<struct<text: string, conf: double, bbox: {BOX}, alternatives: array<string>>>"
LOG = "time string, action string, section string, pdf_pages array<int>, before array<string>, after array<string>, rule array<string>"
TSV = "level int, page_num int, block_num int, par_num int, line_num int, word_num int, left double, top double, width_px double, height_px double, conf double, text string"


def box_struct(c):
    return F.struct(*[c[i].alias(n) for i, n in enumerate(("x0", "y0", "x1", "y1"))])


def book_of_path(level: int = 3):
    """The folder so many steps above a file's name."""
    return F.element_at(F.split(F.input_file_name(), "/"), -level)


def ocr_pages(spark: SparkSession, path: str) -> DataFrame:
    """Lines of page files (one JSON a page): book, engine, page, line, text (NFC), conf, bbox, alternatives."""
    pages = spark.read.schema(OCR_PAGE).option("multiLine", True).json(path)
    number = text.page_number(F.regexp_extract(F.input_file_name(), r"(p\d{4})\.json$", 1))
    rows = pages.select(book_of_path().alias("book"), "engine", F.coalesce("page", number).alias("page"), F.posexplode("lines").alias("line", "_l"))
    return rows.select("book", "engine", "page", "line", similarity.nfc("_l.text").alias("text"), "_l.conf", box_struct(F.col("_l.bbox")).alias("bbox"), "_l.alternatives")


def tesseract_words(spark: SparkSession, path: str) -> DataFrame:
    """Word tables as Tesseract writes them: tab separated, without quoting; one file a page."""
    words = spark.read.schema(TSV).option("sep", "\t").option("quote", "").option("header", True).csv(path)
    number = text.page_number(F.regexp_extract(F.input_file_name(), r"(p\d{4})\.tsv$", 1))
    named = words.select(book_of_path().alias("book"), number.alias("page"), "*")
    # the page's own row, of level 1, says how large the page is
    page = Window.partitionBy("book", "page")
    size = lambda c: F.max(F.when(F.col("level") == 1, F.col(c))).over(page)
    return named.withColumn("width", size("width_px")).withColumn("height", size("height_px"))


def correction_log(spark: SparkSession, path: str) -> DataFrame:
    """A log of one JSON object a line, in its order; blank lines are no entries.

    Order comes from the place in the file, so a log is read by whole files. A book without a log has no entries.
    """
    try:
        whole = spark.read.text(path, wholetext=True)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], f"book string, ord long, {LOG}")
    files = whole.select(book_of_path().alias("book"), F.posexplode(F.split("value", r"\r?\n")).alias("ord", "_line"))
    return files.where("trim(_line) <> ''").select("book", F.col("ord").cast("long").alias("ord"), F.from_json("_line", LOG).alias("_e")).select("book", "ord", "_e.*")


def markdown_books(spark: SparkSession, path: str) -> DataFrame:
    """(book, text) of Markdown files."""
    return spark.read.text(path, wholetext=True).select(book_of_path(2).alias("book"), F.col("value").alias("text"))


def known_boxes(spark: SparkSession, path: str) -> DataFrame:
    """Boxes by sha1 of the text they show; entries without a box are left out. (book, i, sha1, boxes)"""
    schema = f"sha1 string, boxes array<struct<page: int, bbox: {BOX}>>"
    files = spark.read.text(path, wholetext=True).select(book_of_path(2).alias("book"), F.posexplode(F.split("value", "\n")).alias("i", "_line"))
    return files.select("book", "i", F.from_json("_line", schema).alias("_e")).select("book", "i", "_e.*").where(F.size("boxes") > 0)


def custom_words(spark: SparkSession, paths: list[str]) -> DataFrame:
    """(word, ord): words of word lists in their order, each once; what follows # is a comment."""
    lists = None
    for k, path in enumerate(paths):
        one = spark.read.text(path, wholetext=True).select(F.lit(k).alias("_file"), F.posexplode(F.split("value", "\n")).alias("_line", "_w"))
        lists = one if lists is None else lists.unionAll(one)
    word = similarity.nfc(F.btrim(F.regexp_replace("_w", "#.*", "")))
    some = lists.withColumn("word", word).where("word <> ''")
    return some.groupBy("word").agg(F.min(F.struct("_file", "_line")).alias("ord")).orderBy("ord")


def resolved_books(books: DataFrame, name: str) -> DataFrame:
    """Books of a name: all, the one so called, or the ones that hold it; the caller refuses any number but one."""
    if name == "all":
        return books
    exact = F.col("book") == name
    any_exact = F.max(exact).over(Window.partitionBy())  # a catalogue is small
    return books.withColumn("_any", any_exact).where(exact | (~F.col("_any") & F.col("book").contains(name))).drop("_any")


def resolved_book(books: DataFrame, name: str) -> str:
    """The one book of a name; an error says which there are instead."""
    found = [r.book for r in resolved_books(books, name).select("book").orderBy("book").limit(20).collect()]
    if len(found) != 1:
        raise LookupError(f"{name}: " + (f"several books, {', '.join(found)}" if found else "no such book"))
    return found[0]


def split_files(spark: SparkSession, path: str, root: str) -> DataFrame:
    """Split PDFs under a root by their folders: path, ethnic group, collection and version (null one folder higher)."""
    listed = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path).select("path")
    below = F.split(F.substring_index("path", root.rstrip("/") + "/", -1), "/")
    return listed.select("path", below[0].alias("ethnic_group"), below[1].alias("collection"), F.when(F.size(below) > 3, below[2]).alias("version"))
