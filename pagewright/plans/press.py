"""Queries of structure and layout: tables in the text, entries located in order, books cleaned by their own strategies."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import text
from ..operators import disagreements, locating, ranges, strategies, tables
from .lens import ROWS_SQL, _long, _read, page_rows

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def _query(sql: str | None = None):
    def register(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return register


# A page's rows from the second to the fourth are a table; ten pages of a book share one, and every seventh page wasn't read.
# Its header is the page's language, which is like another one's by half unless one of them is fr.
@_query(f"""
WITH {ROWS_SQL},
d AS (SELECT source AS book, doc_id // 10 AS t, doc_id AS page, lang, doc_id % 7 <> 0 AS read, doc_id % 3 = 0 AS cut, len(string_split(text, chr(10))) AS n FROM documents WHERE text IS NOT NULL),
h AS (SELECT *, first_value(CASE WHEN read THEN lang END IGNORE NULLS) OVER (PARTITION BY book, t ORDER BY page ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS header,
  row_number() OVER (PARTITION BY book, t, read ORDER BY page) AS nth FROM d),
m AS (SELECT book, page, n, read, CASE WHEN NOT read THEN CASE WHEN nth = 1 THEN '<!-- table not parsed, see pdf ' || t || ' -->' ELSE '' END ELSE
  '<!-- table read cell by cell from pdf ' || page || CASE WHEN cut THEN '; column 2, 3 left out' ELSE '' END || ' -->' || chr(10) || chr(10) ||
  CASE WHEN header IS NOT NULL AND (header = 'fr') <> (lang = 'fr') THEN '| ' || header || ' |  |' || chr(10) || '|---|---|' || chr(10) || '| ' || lang || ' |  |' ELSE '| ' || lang || ' |  |' || chr(10) || '|---|---|' END
  || chr(10) || '| ' || book || ' | a\\|b |' END AS said FROM h),
c AS (SELECT r.book, r.page, r.row, r.text, m.said, NOT m.read OR (r.y0 + r.y1) / 2 BETWEEN 1.0 / m.n - 0.01::DOUBLE AND 4.0 / m.n + 0.01::DOUBLE AS inside FROM r JOIN m USING (book, page)),
f AS (SELECT *, row_number() OVER (PARTITION BY book, page, inside ORDER BY row) AS k FROM c)
SELECT book, page, cast(row AS BIGINT) AS row, CASE WHEN inside THEN 'table' ELSE 'paragraph' END AS kind, md5(CASE WHEN inside THEN said ELSE text END) AS digest FROM f WHERE NOT inside OR k = 1 AND said <> ''""")
def placed_tables(spark, sf_dir):
    segments = page_rows(spark, sf_dir).select("book", "page", F.col("row").alias("seq"), F.lit("paragraph").alias("kind"), "text", "bbox")
    d = _read(spark, sf_dir, "documents").where("text is not null")
    n = F.size(F.split("text", "\n"))
    box = F.struct(F.lit(0.0).alias("x0"), (F.lit(1.0) / n).alias("y0"), F.lit(1.0).alias("x1"), (F.lit(4.0) / n).alias("y1"))
    rows = F.array(F.array("lang"), F.array(F.col("source"), F.lit("a|b")))
    read = F.col("doc_id") % 7 != 0
    number = F.expr("doc_id div 10")
    dropped = F.when(F.col("doc_id") % 3 == 0, F.array(F.lit(2), F.lit(3))).otherwise(F.array().cast("array<int>"))
    t = d.select(F.col("source").alias("book"), number.alias("table"), number.cast("string").alias("pages"), F.col("doc_id").alias("page"), F.when(read, box).alias("bbox"), F.when(read, rows).alias("rows"), dropped.alias("dropped"))
    return tables.placed_tables(segments, t).select("book", "page", *[F.col("seq").cast("long").alias("row")], "kind", F.md5("text").alias("digest"))


@_query()
def located_entries(spark, sf_dir):
    """Documents as pages and every fifth one's first row as an entry of its source's contents; two of three have lost their page."""
    rows = page_rows(spark, sf_dir)
    every = Window.partitionBy("book").orderBy("page")
    numbered = rows.where("row = 0").withColumn("ord", F.row_number().over(every))
    segments = rows.join(numbered.select("book", "page", F.col("ord").alias("pdf")), ["book", "page"])
    segments = segments.select("book", F.col("pdf").alias("page"), F.col("row").alias("seq"), F.when(F.col("row") == 0, "heading").otherwise("paragraph").alias("kind"), "text")
    entries = numbered.where("ord % 5 = 0").select("book", F.col("ord").cast("long").alias("ord"), (F.col("ord") % 3 + 1).cast("int").alias("level"), F.col("text").alias("title"), F.when(F.col("ord") % 15 == 0, F.col("ord")).alias("pdf_page"))
    return locating.located(entries, segments).select("book", "ord", *_long("page", "seq"), "located")


def _registry() -> strategies.Registry:
    made = strategies.Registry()
    made.strategy("clean")(lambda rows: rows.select("book", "page", "row", F.btrim("text").alias("text")))
    made.strategy("clean", "letters")(lambda rows: rows.select("book", "page", "row", text.letters_key(F.col("text")).alias("text")).where("text <> ''"))
    return made


@_query(rf"""
WITH {ROWS_SQL}
SELECT book, page, cast(row AS BIGINT) AS row, md5(text) AS digest FROM (
  SELECT book, page, row, CASE WHEN own THEN regexp_replace(translate(replace(lower(text), 'ß', 'ss'), '{text.MARKED}', '{text.BASE}'), '[^a-z]', '', 'g') ELSE trim(text) END AS text, own
  FROM (SELECT *, book IN (SELECT DISTINCT source FROM documents WHERE doc_id % 50 = 3) AS own FROM r)) WHERE NOT own OR text <> ''""")
def cleaned_by_strategy(spark, sf_dir):
    own = _read(spark, sf_dir, "documents").where("doc_id % 50 = 3").select(F.col("source").alias("book")).distinct()
    rules = own.select("book", F.lit("clean").alias("step"), F.lit("letters").alias("strategy"))
    done = _registry().run("clean", rules, page_rows(spark, sf_dir))
    return done.select("book", "page", *_long("row"), F.md5("text").alias("digest"))


@_query("""
WITH p AS (SELECT source AS book, doc_id AS page FROM documents), s AS (SELECT book, page AS a, page + page % 5 AS z FROM p WHERE page % 17 = 0 UNION ALL SELECT book, page AS a, page + 3000 AS z FROM p WHERE page % 331 = 5)
SELECT book, page FROM p WHERE NOT EXISTS (SELECT 1 FROM s WHERE s.book = p.book AND p.page BETWEEN a AND z)""")
def pages_not_skipped(spark, sf_dir):
    p = _read(spark, sf_dir, "documents").select(F.col("source").alias("book"), F.col("doc_id").alias("page"))
    some = p.where("page % 17 = 0").select("book", F.col("page").alias("start"), F.expr("page + page % 5").alias("stop"))
    wide = p.where("page % 331 = 5").select("book", F.col("page").alias("start"), F.expr("page + 3000").alias("stop"))
    return ranges.outside(p, some.unionByName(wide))


@_query("""
WITH v AS (SELECT source AS book, doc_id % 40 AS work, least(doc_id, doc_id % 97) AS page FROM documents), i AS (SELECT DISTINCT source AS book, 1 AS page FROM documents WHERE lang = 'en')
SELECT book, cast(min(page) AS INTEGER) AS page FROM v GROUP BY book, work UNION SELECT book, page FROM i""")
def section_starts(spark, sf_dir):
    d = _read(spark, sf_dir, "documents")
    spec = F.concat(F.col("doc_id").cast("string"), F.lit("-"), (F.col("doc_id") + 2).cast("string"), F.lit(", "), (F.col("doc_id") % 97).cast("string"))
    versions = d.select(F.col("source").alias("book"), (F.col("doc_id") % 40).alias("work"), spec.alias("pages"))
    return ranges.section_starts(versions, d.where("lang = 'en'").select(F.col("source").alias("book"), F.lit("1-4,9").alias("pages")).distinct())


# Titles are languages: two that differ are alike by half, but fr is like no other one.
@_query("""
WITH e AS (SELECT source AS book, doc_id AS ord, lang AS title, CASE WHEN doc_id % 3 = 0 THEN 'fr' WHEN doc_id % 3 = 1 THEN lang END AS st, CASE WHEN doc_id % 11 = 0 THEN NULL ELSE doc_id END AS pdf_start, doc_id + 2 AS pdf_end,
  CASE WHEN doc_id % 5 = 0 THEN NULL ELSE doc_id + (CASE WHEN doc_id % 7 = 0 THEN 1 ELSE 0 END) END AS s, doc_id + 2 AS t, doc_id + 10 AS printed, CASE WHEN doc_id % 4 = 0 THEN doc_id + 9 WHEN doc_id % 4 = 1 THEN doc_id + 10 END AS est,
  CASE doc_id % 4 WHEN 1 THEN lang WHEN 2 THEN 'es' WHEN 3 THEN 'fr' END AS h FROM documents),
m AS (SELECT *, coalesce(pdf_start, s) AS start, coalesce(st, title) AS l FROM e),
k AS (SELECT *, greatest(CASE WHEN h = title THEN 1.0 WHEN 'fr' IN (h, title) THEN 0.0 ELSE 0.5 END, CASE WHEN h = l THEN 1.0 WHEN 'fr' IN (h, l) THEN 0.0 ELSE 0.5 END) AS score FROM m)
SELECT book, ord, 'no page' AS kind, start AS page, 'no page in the contents; ' || s || ' from the catalogue' AS said FROM k WHERE pdf_start IS NULL AND s IS NOT NULL
UNION ALL SELECT book, ord, 'other pages', start, 'pages ' || start || '-' || pdf_end || ' by the contents, ' || s || '-' || t || ' by the catalogue' FROM k WHERE s <> start OR (s IS NOT NULL AND t <> pdf_end)
UNION ALL SELECT book, ord, 'other printed page', start, 'page ' || printed || ' in the contents, printed page ' || est FROM k WHERE printed <> est
UNION ALL SELECT book, ord, 'no heading', start, 'no heading on page ' || coalesce(cast(start AS VARCHAR), '-') FROM k WHERE h IS NULL
UNION ALL SELECT book, ord, 'unlike heading', start, 'heading ''' || h || ''' is not ''' || title || '''' FROM k WHERE h IS NOT NULL AND score < 0.5
UNION ALL SELECT book, ord, 'other titles', start, 'heading ''' || h || ''', contents ''' || title || ''', catalogue ''' || coalesce(st, '-') || '''' FROM k WHERE h IS NOT NULL AND score >= 0.5 AND (h <> title OR h <> l)""")
def contents_disagreements(spark, sf_dir):
    d, i = _read(spark, sf_dir, "documents"), F.col("doc_id")
    entries = d.select(
        F.col("source").alias("book"), i.alias("ord"), F.col("lang").alias("title"), F.when(i % 3 == 0, "fr").when(i % 3 == 1, F.col("lang")).alias("structure_title"), (i + 10).alias("printed_page"),
        F.when(i % 4 == 0, i + 9).when(i % 4 == 1, i + 10).alias("printed_page_est"), F.when(i % 11 != 0, i).alias("pdf_start"), (i + 2).alias("pdf_end"), F.when(i % 5 != 0, i + F.when(i % 7 == 0, 1).otherwise(0)).alias("structure_start"),
        (i + 2).alias("structure_end"), F.when(i % 4 == 1, F.col("lang")).when(i % 4 == 2, "es").when(i % 4 == 3, "fr").alias("heading"),
    )
    return disagreements.report(entries.withColumn("heading_title", F.col("heading"))).select("book", "ord", "kind", "page", "said")
