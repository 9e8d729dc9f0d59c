"""Queries that hold the operators to SQL: each reads the tables at hand as the operators' input.

A document is a page, its source or language a book, a line a row. Every query reads its whole tables.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import text
from ..operators import blocks, corrections, inventory, notes, pages, quality, ranges, rows, spelling, toc


def _read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _long(*names: str) -> list:
    return [F.col(n).cast("long").alias(n) for n in names]


def page_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as pages of rows: a line takes its share of the page's height, and of the width by its length."""
    lines = F.split("text", "\n")
    longest = F.greatest(F.array_max(F.transform(lines, lambda x: F.length(x))), F.lit(1))
    # sizes in a step of their own, or each row would split its whole page again for them
    d = _read(spark, sf_dir, "documents").where("text is not null").select(F.col("source").alias("book"), F.col("doc_id").alias("page"), lines.alias("_lines"), F.size(lines).alias("_n"), longest.alias("_most"))
    d = d.select("book", "page", "_n", "_most", F.posexplode("_lines").alias("row", "text"))
    box = F.struct(
        F.lit(0.0).alias("x0"), (F.col("row") / F.col("_n")).alias("y0"), (F.length("text") / F.col("_most")).alias("x1"), ((F.col("row") + 1) / F.col("_n")).alias("y1")
    )
    return d.select("book", "page", "row", "text", box.alias("bbox"), F.array().cast("array<string>").alias("flags"))


ROWS_SQL = """r AS (SELECT book, page, row, text, 0.0::DOUBLE AS x0, row / n AS y0, length(text) / most AS x1, (row + 1) / n AS y1 FROM (
  SELECT source AS book, doc_id AS page, len(l) AS n, greatest(list_max(list_transform(l, lambda x: length(x))), 1) AS most,
    unnest(l) AS text, unnest(range(0, len(l))) AS row FROM (SELECT source, doc_id, string_split(text, chr(10)) AS l FROM documents WHERE text IS NOT NULL)))"""


def key_sql(c: str, kept: str = "a-z") -> str:
    return f"regexp_replace(translate(replace(lower({c}), 'ß', 'ss'), '{text.MARKED}', '{text.BASE}'), '[^{kept}]', '', 'g')"


def collapsed_sql(c: str) -> str:
    return rf"trim(regexp_replace({c}, '[\s ]+', ' ', 'g'))"


def words_sql(c: str) -> str:
    return f"list_filter(string_split({collapsed_sql(c)}, ' '), lambda w: w <> '')"


#: Words as runs of letters, case folded.
LETTER_WORDS = r"regexp_extract_all(replace(lower(text), 'ß', 'ss'), '\p{L}+')"

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def _query(sql: str | None = None):
    def register(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return register


@_query(f"""
WITH {ROWS_SQL},
e AS (SELECT *, row_number() OVER (PARTITION BY book, page ORDER BY row) AS d, row_number() OVER (PARTITION BY book, page ORDER BY row DESC) AS u FROM r),
k AS (SELECT DISTINCT book, page, {key_sql("text")} AS key FROM e WHERE (d <= 2 AND y1 <= 0.15::DOUBLE) OR (u <= 2 AND y0 >= 0.85::DOUBLE)),
p AS (SELECT book, count(DISTINCT page) AS n_pages FROM r GROUP BY book)
SELECT book, key, count(*) AS n FROM k JOIN p USING (book) WHERE length(key) >= 4 GROUP BY book, key, n_pages
HAVING count(*) >= greatest(3, floor(n_pages * 0.04::DOUBLE))""")
def running_headers(spark, sf_dir):
    return pages.running_headers(page_rows(spark, sf_dir), fuzzy=False).select("book", "key", *_long("n"))


@_query()
def running_headers_fuzzy(spark, sf_dir):
    return pages.running_headers(page_rows(spark, sf_dir)).select("book", "key", *_long("n"))


@_query(f"""
WITH {ROWS_SQL}, k AS (SELECT DISTINCT book, page, {key_sql("text")} AS key FROM r)
SELECT book, key, count(*) AS n FROM k WHERE length(key) >= 4 GROUP BY book, key HAVING count(*) >= 3""")
def line_frequency(spark, sf_dir):
    keys = page_rows(spark, sf_dir).select("book", "page", text.letters_key(F.col("text")).alias("key")).where(F.length("key") >= 4).distinct()
    return keys.groupBy("book", "key").agg(F.count(F.lit(1)).alias("n")).where("n >= 3")


@_query("""
WITH d AS (SELECT DISTINCT source AS book, doc_id FROM documents),
g AS (SELECT book, doc_id, doc_id - row_number() OVER (PARTITION BY book ORDER BY doc_id) AS run FROM d)
SELECT book, min(doc_id) AS first, max(doc_id) AS last, count(*) AS n FROM g GROUP BY book, run""")
def page_islands(spark, sf_dir):
    d = _read(spark, sf_dir, "documents").select(F.col("source").alias("book"), "doc_id")
    return ranges.islands(d, ["book"], "doc_id")


@_query("""
WITH d AS (SELECT DISTINCT source AS book, doc_id FROM documents),
g AS (SELECT book, doc_id, doc_id - row_number() OVER (PARTITION BY book ORDER BY doc_id) AS run FROM d),
s AS (SELECT book, min(doc_id) AS a, max(doc_id) AS b FROM g GROUP BY book, run)
SELECT book, string_agg(CASE WHEN a = b THEN cast(a AS VARCHAR) ELSE a || '-' || b END, ',' ORDER BY a) AS pages FROM s GROUP BY book""")
def range_labels(spark, sf_dir):
    d = _read(spark, sf_dir, "documents").select(F.col("source").alias("book"), "doc_id")
    return ranges.range_labels(d, ["book"], "doc_id")


@_query("""
SELECT p_partkey, cast(unnest(list_concat(range(p_size, p_size + 4), [p_size + 9])) AS BIGINT) AS page FROM part""")
def range_expand(spark, sf_dir):
    size = F.col("p_size")
    label = F.format_string("%d-%d, %d", size, size + 3, size + 9)
    return _read(spark, sf_dir, "part").select("p_partkey", F.explode(ranges.expanded(label)).alias("page")).select("p_partkey", *_long("page"))


@_query("""
WITH s AS (SELECT p_brand AS book, p_partkey AS pdf, cast(p_size AS BIGINT) AS n, sum(cast(p_size AS BIGINT)) OVER (PARTITION BY p_brand ORDER BY p_partkey) AS upto FROM part)
SELECT book, page, pdf, cast(page - (upto - n + 1) AS BIGINT) AS index FROM (SELECT book, pdf, upto, n, cast(unnest(range(cast(upto - n + 1 AS BIGINT), cast(upto + 1 AS BIGINT))) AS BIGINT) AS page FROM s)""")
def pages_of_sources(spark, sf_dir):
    sources = _read(spark, sf_dir, "part").select(F.col("p_brand").alias("book"), F.col("p_partkey").alias("ord"), F.col("p_partkey").alias("pdf"), F.col("p_size").cast("long").alias("pages"))
    every = ranges.book_pages(sources.groupBy("book").agg(F.sum("pages").alias("n")))
    return ranges.source_of(every, sources).select("book", "pdf", *_long("page", "index"))


@_query("""
WITH p AS (SELECT event_type AS book, event_id AS page, event_id - cast(floor(value) AS BIGINT) AS printed FROM events),
q AS (SELECT p.book, p.page, m.page - m.printed AS o FROM p JOIN p m ON p.book = m.book AND m.page BETWEEN p.page - 15 AND p.page + 15 AND m.page <> p.page AND m.printed > 0),
n AS (SELECT book, page, count(*) AS n, quantile_disc(o, 0.5) AS o FROM q GROUP BY book, page),
s AS (SELECT n.book, n.page, n.n, n.o, count(*) AS c FROM n JOIN q ON n.book = q.book AND n.page = q.page AND n.o = q.o GROUP BY ALL),
e AS (SELECT book, page, page - o AS est FROM s WHERE n >= 3 AND c >= greatest(2, n // 2) AND page - o >= 1)
SELECT p.book, p.page, p.printed AS printed_page, coalesce(est, printed) AS printed_page_est, coalesce(printed > 0 AND printed <> est, false) AS printed_page_suspect
FROM p LEFT JOIN e ON p.book = e.book AND p.page = e.page""")
def printed_page_inference(spark, sf_dir):
    e = _read(spark, sf_dir, "events")
    p = e.select(F.col("event_type").alias("book"), F.col("event_id").alias("page"), (F.col("event_id") - F.floor("value").cast("long")).alias("printed_page"))
    return pages.infer_printed_pages(p).select("book", "page", *_long("printed_page", "printed_page_est"), "printed_page_suspect")


@_query(f"""
WITH {ROWS_SQL}, b AS (SELECT *, y0 - lag(y1) OVER (PARTITION BY book, page ORDER BY row) AS gap FROM r),
m AS (SELECT book, page, count(*) AS n, list_sort(list(x0))[cast(floor(count(*) / 10) AS BIGINT) + 1] AS a, list_sort(list(x1))[cast(floor(count(*) * 9 / 10) AS BIGINT) + 1] AS z, median(y1 - y0) AS h FROM b GROUP BY book, page),
w AS (SELECT m.*, greatest(z - a, 1e-6::DOUBLE) AS w FROM m),
f AS (SELECT b.book, b.page, avg(CASE WHEN x1 >= z - 0.04::DOUBLE * w THEN 1.0 ELSE 0.0 END::DOUBLE) AS fs, avg((x1 - x0) / w) AS mw FROM b JOIN w ON b.book = w.book AND b.page = w.page GROUP BY ALL)
SELECT w.book, w.page, n, a AS "left", z AS "right", h, CASE WHEN (n >= 4 AND fs >= 0.45::DOUBLE) OR mw > 0.85::DOUBLE THEN 'prose' ELSE 'verse' END AS mode
FROM w JOIN f ON w.book = f.book AND w.page = f.page""")
def page_layout(spark, sf_dir):
    return pages.layout(page_rows(spark, sf_dir)).select("book", "page", *_long("n"), "left", "right", "h", "mode")


@_query(f"""
WITH d AS (SELECT doc_id, regexp_extract_all(text, '\\p{{L}}+') AS a FROM documents),
w AS (SELECT doc_id, CASE WHEN len(list_filter(a, lambda x: NOT regexp_matches(x, '^\\p{{Lu}}'))) >= 8 THEN list_filter(a, lambda x: NOT regexp_matches(x, '^\\p{{Lu}}')) ELSE a END AS w FROM d),
b AS (SELECT doc_id, len(w) AS words, len(list_filter(list_transform(w, lambda x: translate(replace(lower(x), 'ß', 'ss'), '{text.TONED}', '{text.TONELESS}')), lambda x: NOT (regexp_matches(x, '{text.SYLLABLE}') OR x IN ('gi', 'gin')))) AS bad FROM w),
r AS (SELECT doc_id, cast(words AS BIGINT) AS words, CASE WHEN words > 0 THEN bad / words ELSE 0.0::DOUBLE END AS invalid_ratio FROM b)
SELECT *, CASE WHEN words < 8 THEN 'unknown' WHEN invalid_ratio < 0.12::DOUBLE THEN 'vi' WHEN invalid_ratio < 0.35::DOUBLE THEN 'mixed' ELSE 'other' END AS guess FROM r""")
def language_guess(spark, sf_dir):
    return pages.language(_read(spark, sf_dir, "documents"), "text", ["doc_id"]).select("doc_id", "words", "invalid_ratio", "guess")


@_query(rf"""
WITH {ROWS_SQL}, s AS (SELECT book, page, row, text, replace(text, ' ', '') AS t FROM r)
SELECT book, page, cast(row AS BIGINT) AS row,
  CASE WHEN length(t) > 0 THEN length(regexp_replace(t, '[^\p{{L}}]', '', 'g')) / length(t) ELSE 0.0::DOUBLE END AS letters,
  NOT regexp_matches(text, '\p{{L}}{{3}}') AND CASE WHEN length(t) > 0 THEN length(regexp_replace(t, '[^\p{{L}}\p{{N}}]', '', 'g')) / length(t) ELSE 0.0::DOUBLE END < 0.7::DOUBLE AS noise
FROM s""")
def row_letters(spark, sf_dir):
    t = F.col("text")
    return page_rows(spark, sf_dir).select("book", "page", *_long("row"), text.letter_share(t).alias("letters"), text.is_noise(t).alias("noise"))


@_query(f"""
WITH d AS (SELECT doc_id, left(text, 80) AS t FROM documents WHERE text IS NOT NULL), k AS (SELECT doc_id, text FROM documents WHERE text IS NOT NULL)
SELECT k.doc_id, {key_sql("text", "a-z0-9")} AS alnum_key, trim(regexp_replace(lower(translate(text, '{text.MARKED}', '{text.BASE}')), '[^a-z0-9]+', '-', 'g'), '-') AS slug,
  substr(sha1(text), 1, 12) AS version FROM k""")
def text_keys(spark, sf_dir):
    t = F.col("text")
    return _read(spark, sf_dir, "documents").where("text is not null").select("doc_id", text.alnum_key(t).alias("alnum_key"), text.slug(t).alias("slug"), text.content_version(t).alias("version"))


@_query("""
SELECT doc_id, first_value(doc_id) OVER (PARTITION BY md5(text) ORDER BY doc_id) AS first_id, row_number() OVER (PARTITION BY md5(text) ORDER BY doc_id) - 1 AS nth
FROM documents WHERE text IS NOT NULL""")
def repeated_pages(spark, sf_dir):
    w = Window.partitionBy(F.md5(F.col("text").cast("binary"))).orderBy("doc_id")
    d = _read(spark, sf_dir, "documents").where("text is not null")
    return d.select("doc_id", F.first("doc_id").over(w).alias("first_id"), (F.row_number().over(w) - 1).cast("long").alias("nth"))


@_query("""
WITH k AS (SELECT o_orderpriority AS book, o_custkey AS printed, min(o_orderkey) AS pdf FROM orders GROUP BY ALL),
c AS (SELECT book, max(pdf) AS page_count FROM k GROUP BY book),
a AS (SELECT DISTINCT book, c_custkey AS printed FROM customer, c),
x AS (SELECT a.book, a.printed, k.pdf + a.printed - k.printed AS g, row_number() OVER (PARTITION BY a.book, a.printed ORDER BY abs(k.printed - a.printed), k.pdf) AS rn
  FROM a JOIN k ON a.book = k.book)
SELECT x.book, printed, CASE WHEN g BETWEEN 1 AND page_count THEN g END AS pdf FROM x JOIN c ON x.book = c.book WHERE rn = 1""")
def nearest_page(spark, sf_dir):
    o = _read(spark, sf_dir, "orders").select(F.col("o_orderpriority").alias("book"), F.col("o_custkey").alias("printed"), F.col("o_orderkey").alias("pdf"))
    counts = o.groupBy("book").agg(F.max("pdf").alias("page_count"))
    asked = _read(spark, sf_dir, "customer").select(F.col("c_custkey").alias("printed"), F.explode(F.array(*[F.lit(p) for p in PRIORITIES])).alias("book"))
    return toc.printed_to_pdf(asked.join(counts, "book", "left_semi"), o, counts)


#: The order priorities of the table (fixed values).
PRIORITIES = ("1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW")


@_query("""
SELECT user_id AS book, event_id AS page, last_value(CASE WHEN event_type = 'signup' THEN event_id END IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY event_id ROWS UNBOUNDED PRECEDING) AS entry FROM events""")
def carried_entries(spark, sf_dir):
    e = _read(spark, sf_dir, "events").select(F.col("user_id").alias("book"), F.col("event_id").alias("page"), F.lit(0).alias("seq"), "event_type")
    located = e.where("event_type = 'signup'").select("book", "page", "seq", F.col("page").alias("ord"))
    return toc.carried_entry(e, located).select("book", "page", "entry")


def _talk(spark, sf_dir):
    """Conversations as books: what the user says opens a section."""
    c = _read(spark, sf_dir, "conversations")
    said = F.when(F.col("role") == "user", F.concat(F.lit("## "), F.col("text"))).otherwise(F.concat(F.lit("<!-- pdf "), F.col("turn"), F.lit("-"), F.col("turn") + 1, F.lit(" -->")))
    return c.select(F.col("conv_id").alias("book"), F.col("turn").alias("idx"), said.alias("text"))


@_query(r"""
WITH b AS (SELECT conv_id AS book, turn AS idx, role, text, sum(CASE WHEN role = 'user' AND text IS NOT NULL THEN 1 ELSE 0 END) OVER (PARTITION BY conv_id ORDER BY turn) AS n FROM conversations),
s AS (SELECT *, n - min(n) OVER (PARTITION BY book) AS k FROM b)
SELECT book, cast(k AS BIGINT) AS k, coalesce(min_by(trim(regexp_replace(text, '\s*\n#*\s*', ' ', 'g')), idx) FILTER (WHERE role = 'user'), '(trước tiêu đề)') AS title,
  min(idx) AS start, max(idx) + 1 AS "end", min(idx) FILTER (WHERE role <> 'user') AS pdf_a, min(idx) FILTER (WHERE role <> 'user') + 1 AS pdf_b
FROM s GROUP BY book, k""")
def section_bounds(spark, sf_dir):
    return blocks.sections(_talk(spark, sf_dir)).select("book", "title", *_long("k", "start", "end", "pdf_a", "pdf_b"))


@_query("""
SELECT conv_id AS book, string_agg(CASE WHEN role = 'user' THEN '## ' || text ELSE '<!-- pdf ' || turn || '-' || turn + 1 || ' -->' END, chr(10) || chr(10) ORDER BY turn) || chr(10) AS text
FROM conversations GROUP BY conv_id""")
def joined_blocks(spark, sf_dir):
    return blocks.join_blocks(_talk(spark, sf_dir), ["book"])


@_query("""
SELECT conv_id AS book, turn AS idx, CASE WHEN role = 'user' THEN 'heading' ELSE 'comment' END AS kind FROM conversations""")
def split_and_kinds(spark, sf_dir):
    joined = blocks.join_blocks(_talk(spark, sf_dir), ["book"])
    return blocks.split_blocks(joined).select("book", *_long("idx"), text.block_kind(F.col("text")).alias("kind"))


@_query(f"""
WITH {ROWS_SQL} SELECT book, word, count(*) AS n FROM (SELECT book, unnest({LETTER_WORDS}) AS word FROM r) GROUP BY book, word""")
def word_lexicon(spark, sf_dir):
    return quality.unigrams(page_rows(spark, sf_dir))


@_query(f"""
WITH {ROWS_SQL}, w AS (SELECT book, {LETTER_WORDS} AS w FROM r),
p AS (SELECT book, unnest(w[1:len(w) - 1]) AS word, unnest(w[2:len(w)]) AS next FROM w WHERE len(w) > 1)
SELECT book, word, next, count(*) AS n FROM p GROUP BY book, word, next""")
def bigram_lexicon(spark, sf_dir):
    return quality.bigrams(page_rows(spark, sf_dir))


def _fold_sql(c: str) -> str:
    return rf"regexp_replace(translate(lower({c}), '{text.MARKED}', '{text.BASE}'), '[^\p{{L}}\p{{N}}]', '', 'g')"


@_query(rf"""
WITH d AS (SELECT source AS book, 0::BIGINT AS k, unnest(regexp_extract_all(text, '\p{{L}}+')) AS word FROM documents),
c AS (SELECT book, k, {_fold_sql("word")} AS fold, word, count(*) AS n FROM d GROUP BY ALL),
r AS (SELECT *, cast(sum(n) OVER (PARTITION BY book, k, fold) AS BIGINT) AS total, row_number() OVER (PARTITION BY book, k, fold ORDER BY n DESC, word) AS rn FROM c)
SELECT book, k, fold, word, n, total, n >= 0.6::DOUBLE * total AND total >= 3 AS clear FROM r WHERE rn = 1""")
def spelling_majority(spark, sf_dir):
    return spelling.name_majorities(_said(spark, sf_dir))


def _said(spark, sf_dir):
    d = _read(spark, sf_dir, "documents").select(F.col("source").alias("book"), F.lit(0).cast("long").alias("k"), F.explode(text.letter_words(F.col("text"))).alias("word"))
    return d.withColumn("fold", text.word_key(F.col("word")))


@_query(rf"""
WITH d AS (SELECT source AS book, unnest(regexp_extract_all(text, '\p{{L}}+')) AS word FROM documents), f AS (SELECT book, {_fold_sql("word")} AS fold, word FROM d),
c AS (SELECT DISTINCT book, fold FROM f WHERE regexp_matches(word, '^\p{{Ll}}'))
SELECT f.book, f.fold, count(DISTINCT lower(word)) AS ways, count(*) AS n FROM f JOIN c ON f.book = c.book AND f.fold = c.fold GROUP BY f.book, f.fold HAVING count(DISTINCT lower(word)) > 1""")
def spelling_variants(spark, sf_dir):
    d = _read(spark, sf_dir, "documents").select(F.col("source").alias("book"), "text")
    return spelling.fold_variants(quality.word_counts(d, F.col("text")))


@_query(f"""
WITH {ROWS_SQL}
SELECT book, page, count(*) AS rows, count(*) FILTER (WHERE length(text) < 40) AS flagged, avg(length(text)) AS agreement FROM r GROUP BY book, page""")
def agreement_stats(spark, sf_dir):
    flagged = F.when(F.length("text") < 40, F.array(F.lit("low_conf"))).otherwise(F.array().cast("array<string>"))
    r = page_rows(spark, sf_dir).withColumn("flags", flagged).withColumn("similarity", F.length("text").cast("double"))
    return rows.page_agreement(r)


@_query(f"""
WITH t AS (SELECT conv_id AS book, turn AS page, regexp_replace(translate({collapsed_sql("text")}, '{text.MARKED}', '{text.BASE}'), '[^ -~]', '?', 'g') AS t FROM conversations)
SELECT a.book, a.page, levenshtein(a.t, b.t) / greatest(length(a.t), 1) AS cer FROM t a JOIN t b ON a.book = b.book AND b.page = a.page + 1""")
def turn_error_rates(spark, sf_dir):
    c = _read(spark, sf_dir, "conversations")
    plain = F.regexp_replace(text.without_marks(text.collapsed(F.col("text"))), "[^ -~]", "?")
    truth = c.select(F.col("conv_id").alias("book"), F.col("turn").alias("page"), plain.alias("text"))
    read = truth.select("book", (F.col("page") - 1).alias("page"), F.lit("next").alias("source"), "text")
    return quality.error_rates(read, truth).select("book", "page", "cer")


@_query("""
WITH c AS (SELECT page_id AS book, unnest(regexp_extract_all(html, 'href="/([^"\\s\\]]+)"', 1)) AS id FROM pages),
d AS (SELECT page_id AS book, unnest(regexp_extract_all(html, '<p>([^<\\s\\]]+)', 1)) AS id FROM pages),
cc AS (SELECT book, id, count(*) AS n FROM c GROUP BY ALL), dd AS (SELECT book, id, count(*) AS n FROM d GROUP BY ALL)
SELECT coalesce(cc.book, dd.book) AS book, coalesce(cc.id, dd.id) AS note_id, coalesce(dd.n, 0) AS n_defined, coalesce(cc.n, 0) AS n_called
FROM cc FULL JOIN dd ON cc.book = dd.book AND cc.id = dd.id""")
def note_audit(spark, sf_dir):
    p = _read(spark, sf_dir, "pages")
    called = F.transform(F.regexp_extract_all("html", F.lit(r'href="/([^"\s\]]+)"'), 1), lambda x: F.concat(F.lit("[^"), x, F.lit("]")))
    defined = F.transform(F.regexp_extract_all("html", F.lit(r"<p>([^<\s\]]+)"), 1), lambda x: F.concat(F.lit("[^"), x, F.lit("]: text")))
    b = p.select(F.col("page_id").alias("book"), F.posexplode(F.concat(F.array(F.concat(F.lit("x "), F.array_join(called, " "))), defined)).alias("idx", "text"))
    return notes.audit(b).select("book", "note_id", *_long("n_defined", "n_called"))


@_query(r"""
SELECT page_id, regexp_replace(html, '(?s)\s*<!--.*?-->', '', 'g') AS text, len(regexp_extract_all(html, '<!-- ad \d+ -->')) AS n_ads FROM pages""")
def comments_stripped(spark, sf_dir):
    return _read(spark, sf_dir, "pages").select("page_id", F.regexp_replace("html", r"(?s)\s*<!--.*?-->", "").alias("text"), F.regexp_count("html", F.lit(r"<!-- ad \d+ -->")).cast("long").alias("n_ads"))


@_query("""
WITH b AS (SELECT l_orderkey AS page, l_linenumber AS row, l_returnflag AS flag, l_quantity AS y0, l_quantity + 5 AS y1 FROM lineitem),
o AS (SELECT a.page, cast(a.row AS BIGINT) AS row, cast(s.row AS BIGINT) AS s_row, greatest(least(a.y1, s.y1) - greatest(a.y0, s.y0), 0.0::DOUBLE) / 5 AS share
  FROM b a JOIN b s ON a.page = s.page WHERE a.flag = 'N' AND s.flag <> 'N')
SELECT page, row, s_row, share FROM o WHERE share >= 0.5::DOUBLE""")
def overlapping_boxes(spark, sf_dir):
    box = F.struct(F.lit(0.0).alias("x0"), F.col("l_quantity").alias("y0"), F.lit(1.0).alias("x1"), (F.col("l_quantity") + 5).alias("y1"))
    b = _read(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("page"), F.col("l_linenumber").cast("long").alias("row"), "l_returnflag", box.alias("bbox"))
    s = b.where("l_returnflag <> 'N'").select("page", F.col("row").alias("s_row"), F.col("bbox").alias("s_bbox"))
    met = b.where("l_returnflag = 'N'").join(s, "page").withColumn("share", rows.overlap_of_smaller(F.col("bbox"), F.col("s_bbox")))
    return met.where(F.col("share") >= rows.OVERLAP).select("page", "row", "s_row", "share")


@_query("""
WITH e AS (SELECT p_brand AS book, p_partkey AS ord, CASE WHEN p_size > 25 THEN 2 ELSE 1 END AS level, cast(sum(p_size) OVER (PARTITION BY p_brand ORDER BY p_partkey) AS BIGINT) AS pdf_start, cast(sum(p_size) OVER (PARTITION BY p_brand) AS BIGINT) + 10 AS page_count FROM part),
n AS (SELECT a.book, a.ord, min_by(b.pdf_start, b.ord) AS f FROM e a JOIN e b ON a.book = b.book AND b.ord > a.ord AND b.level <= a.level GROUP BY a.book, a.ord)
SELECT e.book, e.ord, pdf_start, greatest(pdf_start, coalesce(f - 1, page_count)) AS pdf_end FROM e LEFT JOIN n ON e.book = n.book AND e.ord = n.ord""")
def entry_ends(spark, sf_dir):
    w = Window.partitionBy("p_brand")
    e = _read(spark, sf_dir, "part").select(
        F.col("p_brand").alias("book"),
        F.col("p_partkey").alias("ord"),
        F.when(F.col("p_size") > 25, 2).otherwise(1).alias("level"),
        F.sum(F.col("p_size").cast("long")).over(w.orderBy("p_partkey")).alias("pdf_start"),
        (F.sum(F.col("p_size").cast("long")).over(w) + 10).alias("page_count"),
    )
    return toc.entry_ends(e).select("book", "ord", *_long("pdf_start", "pdf_end"))


@_query("""
SELECT o_custkey AS book, o_orderkey AS work FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_totalprice DESC, o_orderkey) AS rn FROM orders) WHERE rn = 1""")
def best_match(spark, sf_dir):
    best = F.max_by("o_orderkey", F.struct("o_totalprice", -F.col("o_orderkey")))
    return _read(spark, sf_dir, "orders").groupBy(F.col("o_custkey").alias("book")).agg(best.alias("work"))


@_query("""
SELECT d.source AS book, count(*) AS n, count(l.doc_id) AS labelled, count(*) FILTER (WHERE quality = 1) AS good, count(*) FILTER (WHERE toxic = 1) AS toxic
FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id GROUP BY d.source""")
def status_counts(spark, sf_dir):
    d = _read(spark, sf_dir, "documents").select(F.col("source").alias("book"), F.col("doc_id").alias("page"))
    done = d.join(_read(spark, sf_dir, "labels").withColumnRenamed("doc_id", "page"), "page")
    stages = {"n": d, "labelled": done, "good": done.where("quality = 1"), "toxic": done.where("toxic = 1")}
    return inventory.progress(d.select("book").distinct(), stages)


@_query(r"""
WITH d AS (SELECT doc_id, regexp_replace(replace(text, chr(10), '  ' || chr(10)), '(?m)^\\-', '-', 'g') AS t FROM documents WHERE text IS NOT NULL)
SELECT doc_id, CASE WHEN regexp_matches(t, ' {2,}\n') THEN array_to_string(list_transform(string_split(t, chr(10)), lambda x: '> ' || rtrim(x)), chr(10)) ELSE t END AS text,
  regexp_matches(t, '[*_`|\\]|<[A-Za-z/!]|\]\(') OR regexp_matches(t, '(?m)^(?:[+] |\d+[.)] |-{3,}\s*$)') AS unsupported FROM d""")
def website_blocks(spark, sf_dir):
    t = F.replace("text", F.lit("\n"), F.lit("  \n"))
    d = _read(spark, sf_dir, "documents").where("text is not null").select("doc_id", t.alias("text"))
    return d.select("doc_id", text.website_dialect(F.col("text")).alias("text"), text.unsupported_markdown(F.col("text")).alias("unsupported"))


@_query("""
WITH l AS (SELECT doc_id, string_split(text, chr(10)) AS l FROM documents WHERE text IS NOT NULL),
g AS (SELECT l.doc_id, l.l, len(list_filter(l.l, lambda x: x = l.l[1])) = 1 AND l.doc_id IN (SELECT doc_id FROM labels WHERE quality = 0) AS gone FROM l),
k AS (SELECT doc_id, CASE WHEN gone THEN l[2:] ELSE l END AS l FROM g)
SELECT cast(doc_id AS VARCHAR) AS book, unnest(range(0, len(l))) AS idx, unnest(l) AS text FROM k""")
def correction_replay(spark, sf_dir):
    """Every document of low quality loses its first line; its other lines stay."""
    d = _read(spark, sf_dir, "documents").where("text is not null").select(F.col("doc_id").cast("string").alias("book"), F.col("doc_id"), F.split("text", "\n").alias("l"))
    b = d.select("book", F.posexplode("l").alias("idx", "text"))
    bad = d.join(_read(spark, sf_dir, "labels").where("quality = 0"), "doc_id", "left_semi")
    log = bad.select("book", F.lit(0).cast("long").alias("ord"), F.lit("delete").alias("action"), F.lit("(trước tiêu đề)").alias("section"), F.slice("l", 1, 1).alias("before"), F.array().cast("array<string>").alias("after"))
    replayed, _ = corrections.replay(b, log)
    return replayed
