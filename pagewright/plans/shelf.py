"""More queries that hold operators to SQL: the inventory, tables of contents, notes, text functions.

As in lens, a document is a page, its source or language a book, a line a row; each query reads its whole tables.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text
from ..operators import blocks, inventory, notes, pages, quality, ranges, spelling, toc
from .lens import LETTER_WORDS, ORACLES as LENS_ORACLES, ROWS_SQL, _long, _read, key_sql, page_rows

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def _query(sql: str):
    def register(f):
        QUERIES[f.__name__] = f
        ORACLES[f.__name__] = sql
        return f

    return register


def plain_sql(c: str) -> str:
    return f"translate(replace(lower({c}), 'ß', 'ss'), '{text.MARKED}', '{text.BASE}')"


def slug_sql(c: str) -> str:
    return f"trim(regexp_replace(lower(translate({c}, '{text.MARKED}', '{text.BASE}')), '[^a-z0-9]+', '-', 'g'), '-')"


# --- text functions


@_query(rf"""
WITH {ROWS_SQL}, c AS (SELECT *, regexp_replace(text, '[^\p{{L}}]', '', 'g') AS l FROM r)
SELECT book, page, cast(row AS BIGINT) AS row, trim(regexp_replace({plain_sql("text")}, '[\s ]+', ' ', 'g')) AS compared,
  regexp_replace(lower(text), '[^\p{{L}}\p{{N}}]', '', 'g') AS bare, CASE WHEN length(text) <= 80 THEN text ELSE left(text, 80) || '…' END AS short,
  translate(text, 'lI|!Oo', '111100') AS repaired,
  CASE WHEN length(l) > 0 THEN length(regexp_replace(l, '[^\p{{Lu}}]', '', 'g')) / length(l) ELSE 0.0::DOUBLE END AS caps,
  'p' || CASE WHEN row < 1000 THEN right('000' || row, 4) ELSE cast(row AS VARCHAR) END AS page_id,
  regexp_matches(text, '\p{{L}}') AS lettered
FROM c""")
def line_functions(spark, sf_dir):
    t = F.col("text")
    r = page_rows(spark, sf_dir)
    some = pages.lettered(r).select("book", "page", "row", F.lit(True).alias("lettered"))
    out = r.select(
        "book", "page", "row", text.compare_key(t).alias("compared"), text.bare_letters(t).alias("bare"), text.shortened(t).alias("short"),
        text.digits_repaired(t).alias("repaired"), text.caps_share(t).alias("caps"), text.page_id(F.col("row")).alias("page_id"),
    )
    return out.join(some, ["book", "page", "row"], "left").fillna(False, ["lettered"]).withColumn("row", F.col("row").cast("long"))


@_query(r"""
WITH p AS (SELECT p_partkey, translate(cast(p_partkey AS VARCHAR), '0123456789', 'IVXIVXIVXl') AS t FROM part),
v AS (SELECT p_partkey, t, list_transform(string_split(translate(upper(t), '1L|', 'III'), ''), lambda c: CASE c WHEN 'I' THEN 1 WHEN 'V' THEN 5 WHEN 'X' THEN 10 ELSE 0 END) AS v FROM p)
SELECT p_partkey, t, list_sum(list_transform(range(1, len(v) + 1), lambda i: v[i] * CASE WHEN coalesce(list_max(v[i + 1:]), 0) > v[i] THEN -1 ELSE 1 END))::INTEGER AS value FROM v""")
def roman_numerals(spark, sf_dir):
    t = F.translate(F.col("p_partkey").cast("string"), "0123456789", "IVXIVXIVXl")
    return _read(spark, sf_dir, "part").select("p_partkey", t.alias("t"), text.roman_value(t).alias("value"))


@_query(r"""
WITH d AS (SELECT conv_id, turn, CASE turn % 4 WHEN 0 THEN '# ' WHEN 1 THEN '12. ' WHEN 2 THEN ' - ' ELSE '<b ' END || text AS t FROM conversations WHERE text IS NOT NULL)
SELECT conv_id, turn, regexp_replace(regexp_replace(t, '^(\s*)([#>+\-*]|\d+[.)])(\s)', '\1\\\2\3'), '<([A-Za-z/!])', '&lt;\1', 'g') AS line,
  '| ' || replace(t, '|', '\|') || ' | ' || turn || ' |  |' AS cells FROM d""")
def escaped_lines(spark, sf_dir):
    opening = F.element_at(F.array(*[F.lit(x) for x in ("# ", "12. ", " - ", "<b ")]), (F.col("turn") % 4 + 1).cast("int"))
    d = _read(spark, sf_dir, "conversations").where("text is not null").select("conv_id", "turn", F.concat(opening, "text").alias("t"))
    cells = text.table_row(F.array("t", F.col("turn").cast("string")), F.lit(3))
    return d.select("conv_id", "turn", text.escaped_line(F.col("t")).alias("line"), cells.alias("cells"))


@_query(rf"""
WITH p AS (SELECT p_partkey, CASE WHEN p_size % 3 = 0 THEN p_size || '. ' ELSE '' END || p_name || CASE WHEN p_size % 2 = 0 THEN ' (' || p_type || ')' ELSE '' END AS t FROM part)
SELECT p_partkey, try_cast(nullif(regexp_extract(t, '(?s)^(?:(\d+)\.\s+)?(.*?)(?:\s*\(([^()]*)\))?$', 1), '') AS INTEGER) AS number,
  regexp_extract(t, '(?s)^(?:(\d+)\.\s+)?(.*?)(?:\s*\(([^()]*)\))?$', 2) AS name, nullif(regexp_extract(t, '(?s)^(?:(\d+)\.\s+)?(.*?)(?:\s*\(([^()]*)\))?$', 3), '') AS subtitle,
  array_to_string(list_filter(list_transform(string_split_regex(t, '[()]'), lambda x: {slug_sql("x")}), lambda x: x <> ''), ' | ') AS parts
FROM p""")
def story_headings(spark, sf_dir):
    size = F.col("p_size")
    number = F.when(size % 3 == 0, F.concat(size.cast("string"), F.lit(". "))).otherwise("")
    t = F.concat(number, "p_name", F.when(size % 2 == 0, F.concat(F.lit(" ("), "p_type", F.lit(")"))).otherwise(""))
    story = text.section_story(F.col("t"))
    p = _read(spark, sf_dir, "part").select("p_partkey", t.alias("t"))
    return p.select("p_partkey", story["number"].alias("number"), story["name"].alias("name"), story["subtitle"].alias("subtitle"), F.array_join(toc.title_parts(F.col("t")), " | ").alias("parts"))


@_query(r"""
SELECT page_id, CASE WHEN h <> '' THEN h END AS heading FROM (SELECT page_id, regexp_extract('<!-- pdf 1 · heading: ' || url || ' -->', 'heading:\s*(.*?)\s*-->', 1) AS h FROM pages)""")
def headings_read(spark, sf_dir):
    comment = F.concat(F.lit("<!-- pdf 1 · heading: "), "url", F.lit(" -->"))
    return _read(spark, sf_dir, "pages").select("page_id", text.heading_read(comment).alias("heading"))


# --- inventory


@_query("""
WITH m AS (SELECT l_partkey AS k, l_returnflag AS f, l_orderkey AS book, l_linenumber AS master_page, l_orderkey * 10 + l_linenumber AS ord, [l_quantity, l_discount, l_tax] AS c FROM lineitem WHERE l_linenumber % 2 = 1),
s AS (SELECT l_partkey AS k, l_returnflag AS f, l_orderkey AS file, l_linenumber AS page, [l_quantity, l_discount, l_tax] AS c FROM lineitem WHERE l_linenumber % 2 = 0),
j AS (SELECT file, page, book, master_page, row_number() OVER (PARTITION BY file, page ORDER BY len(list_intersect(list_distinct(s.c), m.c)) DESC, ord) AS rn FROM s JOIN m USING (k, f))
SELECT s.file, s.page, j.book, j.master_page FROM s LEFT JOIN j ON s.file = j.file AND s.page = j.page AND rn = 1""")
def matched_split_pages(spark, sf_dir):
    i = _read(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", F.array(F.col("l_partkey").cast("string"), "l_returnflag").alias("hashes"), F.array("l_quantity", "l_discount", "l_tax").alias("coords")
    )
    masters = i.where("l_linenumber % 2 = 1").select(F.col("l_orderkey").alias("book"), F.col("l_linenumber").alias("page"), (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("ord"), "hashes", "coords")
    split = i.where("l_linenumber % 2 = 0").select(F.col("l_orderkey").alias("file"), F.col("l_linenumber").alias("page"), "hashes", "coords")
    return inventory.matched_pages(split, masters)


#: Prefixes of the part types (fixed values of the table) as kinds of versions.
KINDS = [("standard-a", "text"), ("standard", "translation"), ("small", "summary"), ("promo-b", "index")]


@_query(f"""
SELECT p_partkey, CASE WHEN p_size % 7 = 0 THEN 'none' {" ".join(f"WHEN {slug_sql('p_type')} LIKE '{a}%' THEN '{b}'" for a, b in KINDS)} ELSE {slug_sql("p_type")} END AS kind FROM part""")
def version_kinds(spark, sf_dir):
    folder = F.when(F.col("p_size") % 7 != 0, F.col("p_type"))
    return _read(spark, sf_dir, "part").select("p_partkey", inventory.version_of(folder, KINDS, "none").alias("kind"))


@_query("""
WITH f AS (SELECT lang AS book, source AS version, doc_id AS ord, doc_id AS file, [length(text) % 50, length(text) // 50] AS pages FROM documents),
n AS (SELECT *, first_value(file) OVER w AS same_pages_as, row_number() OVER w AS rn FROM f WINDOW w AS (PARTITION BY book, version, pages ORDER BY ord))
SELECT book, version, file, same_pages_as FROM n WHERE rn > 1""")
def duplicate_files(spark, sf_dir):
    n = F.length("text")
    f = _read(spark, sf_dir, "documents").select(
        F.col("lang").alias("book"), F.col("source").alias("version"), F.col("doc_id").alias("ord"), F.col("doc_id").alias("file"), F.array(n % 50, F.floor(n / 50).cast("int")).alias("pages")
    )
    return inventory.duplicate_files(f)


@_query("""
SELECT book, work, row_number() OVER (PARTITION BY book ORDER BY coalesce(list_min(pages), 0), work) AS place
FROM (SELECT o_custkey AS book, o_orderkey AS work, CASE WHEN o_orderkey % 5 = 0 THEN NULL ELSE [o_orderkey % 11, o_orderkey % 7] END AS pages FROM orders)""")
def works_by_page(spark, sf_dir):
    k = F.col("o_orderkey")
    w = _read(spark, sf_dir, "orders").select(F.col("o_custkey").alias("book"), k.alias("work"), F.when(k % 5 != 0, F.array(k % 11, k % 7)).alias("pages"))
    return inventory.works_by_page(w).select("book", "work", F.col("place").cast("long").alias("place"))


@_query("""
WITH b AS (SELECT o_custkey AS book, max(o_orderkey) % 97 + 3 AS n FROM orders GROUP BY o_custkey),
e AS (SELECT book, unnest(range(1, n + 1)) AS page FROM b), c AS (SELECT DISTINCT o_custkey AS book, o_orderkey % 100 AS page FROM orders),
g AS (SELECT book, page, page - row_number() OVER (PARTITION BY book ORDER BY page) AS run FROM e ANTI JOIN c USING (book, page)),
s AS (SELECT book, min(page) AS a, max(page) AS z FROM g GROUP BY book, run)
SELECT book, string_agg(CASE WHEN a = z THEN cast(a AS VARCHAR) ELSE a || '-' || z END, ',' ORDER BY a) AS pages FROM s GROUP BY book""")
def unassigned_pages(spark, sf_dir):
    o = _read(spark, sf_dir, "orders").select(F.col("o_custkey").alias("book"), "o_orderkey")
    books = o.groupBy("book").agg((F.max("o_orderkey") % 97 + 3).alias("page_count"))
    return inventory.unassigned_pages(books, o.select("book", (F.col("o_orderkey") % 100).alias("page")))


@_query(f"""
WITH {ROWS_SQL}, a AS (SELECT book, count(*) AS rows, count(*) FILTER (WHERE length(text) < 40) AS flagged FROM r GROUP BY book)
SELECT *, flagged / rows AS rate FROM a""")
def flagged_rates(spark, sf_dir):
    from .lens import agreement_stats

    return inventory.flagged_rates(agreement_stats(spark, sf_dir)).select("book", *_long("rows", "flagged"), "rate")


@_query(f"""
SELECT source AS book, {", ".join(f"count(*) FILTER (WHERE guess = '{g}') AS {g}" for g in inventory.GUESSES)}
FROM ({LENS_ORACLES["language_guess"]}) g JOIN documents USING (doc_id) GROUP BY source""")
def language_histogram(spark, sf_dir):
    from .lens import language_guess

    d = _read(spark, sf_dir, "documents").select("doc_id", F.col("source").alias("book"))
    return inventory.language_counts(language_guess(spark, sf_dir).join(d, "doc_id"))


# --- pages


@_query("""
WITH s AS (SELECT user_id % 50 AS book, event_id AS page, event_type <> 'error' AS verse, CASE WHEN event_type = 'purchase' THEN event_id % 100 END AS line_no FROM events),
c AS (SELECT book, page, last_value(line_no IGNORE NULLS) OVER (PARTITION BY book ORDER BY page ROWS UNBOUNDED PRECEDING) AS couplet FROM s WHERE verse)
SELECT * FROM c WHERE couplet IS NOT NULL""")
def carried_couplets(spark, sf_dir):
    kind = F.when(F.col("event_type") == "error", "paragraph").otherwise("verse")
    number = F.when(F.col("event_type") == "purchase", F.col("event_id") % 100)
    s = _read(spark, sf_dir, "events").select((F.col("user_id") % 50).alias("book"), F.col("event_id").alias("page"), F.lit(0).alias("seq"), kind.alias("kind"), number.alias("line_no"))
    return pages.carried_couplets(s).select("book", "page", "couplet")


@_query(f"""
WITH {ROWS_SQL}, e AS (SELECT book, page, list_sort(list(x0 + row / 100))[cast(floor(count(*) / 10) AS BIGINT) + 1] AS a, list_sort(list(x1))[cast(floor(count(*) * 9 / 10) AS BIGINT) + 1] AS z
  FROM r WHERE row % 5 <> 4 GROUP BY book, page)
SELECT book, page, a AS "left", z AS "right", a + 0.05::DOUBLE * (z - a) AS indent_at FROM e""")
def column_edges(spark, sf_dir):
    role = F.when(F.col("row") % 5 == 4, "footnote").otherwise("body")
    shifted = F.col("bbox").withField("x0", F.col("bbox.x0") + F.col("row") / 100)
    return pages.column_edges(page_rows(spark, sf_dir).withColumn("role", role).withColumn("bbox", shifted))


@_query(f"""
WITH {ROWS_SQL}, g AS (SELECT book, page, text FROM r WHERE length(text) < 60 AND page % 2 = 0)
SELECT book, page, cast(row AS BIGINT) AS row FROM r ANTI JOIN g USING (book, page, text)""")
def rows_not_removed(spark, sf_dir):
    r = page_rows(spark, sf_dir)
    return toc.without_removed(r, r.where("length(text) < 60 and page % 2 = 0")).select("book", "page", *_long("row"))


@_query("""
WITH b AS (SELECT s_suppkey AS book, 20 + s_suppkey % 5 AS n FROM supplier), e AS (SELECT book, unnest(range(1, n + 1)) AS page FROM b)
SELECT book, page FROM e WHERE (page <= 4 OR page > 12 OR page = 6 + book % 3) AND NOT (page BETWEEN 2 AND 2 + book % 2)""")
def pages_to_ocr(spark, sf_dir):
    k = F.col("s_suppkey")
    version = lambda content, p: F.struct(F.lit(content).alias("content"), F.lit(p).alias("pages"))
    books = _read(spark, sf_dir, "supplier").select(
        k.alias("book"), (k % 5 + 20).cast("int").alias("page_count"), F.array(version("text", "1-4"), version("pdf", "5-12")).alias("versions"),
        (k % 3 + 6).cast("string").alias("include"), F.concat(F.lit("2-"), (k % 2 + 2).cast("string")).alias("exclude"),
    )
    return ranges.selected_pages(books, "ocr").select("book", F.col("page").cast("long").alias("page"))


# --- tables of contents


def _entries(spark, sf_dir, some: str = "true"):
    p = _read(spark, sf_dir, "part").where(some)
    return p.select(F.col("p_brand").alias("book"), F.col("p_partkey").alias("ord"), F.col("p_partkey").alias("work"), F.col("p_name").alias("title"), "p_size")


@_query(f"""
WITH a AS (SELECT p_brand AS book, p_partkey AS ord, {key_sql("p_name", "a-z0-9")} AS t FROM part WHERE p_size % 2 = 0), b AS (SELECT p_brand AS book, p_partkey AS work, {key_sql("p_name", "a-z0-9")} AS t FROM part WHERE p_size % 2 = 1)
SELECT a.book, a.ord, min(work) AS work FROM a JOIN b ON a.book = b.book AND a.t = b.t GROUP BY a.book, a.ord""")
def works_by_title(spark, sf_dir):
    return toc.match_works(_entries(spark, sf_dir, "p_size % 2 = 0"), _entries(spark, sf_dir, "p_size % 2 = 1"), threshold=1.0)


#: Longest matching blocks of two strings, then of what is left and right of them, as difflib finds them; their share is the ratio.
RATIO_SQL = """blocks(a, b, i0, i1, j0, j1, best) AS (
  SELECT a, b, 0, length(a), 0, length(b), NULL::STRUCT(k BIGINT, i BIGINT, j BIGINT) FROM pairs
  UNION ALL
  SELECT a, b, r.i0, r.i1, r.j0, r.j1, best FROM (
    SELECT a, b, best, unnest([{'i0': i0, 'i1': -best.i, 'j0': j0, 'j1': -best.j}, {'i0': best.k - best.i, 'i1': i1, 'j0': best.k - best.j, 'j1': j1}]) AS r FROM (
      SELECT a, b, i0, i1, j0, j1, list_max(flatten(flatten(list_transform(range(i0, i1), lambda i: list_transform(range(j0, j1), lambda j: list_transform(
        list_filter(range(1, least(i1 - i, j1 - j) + 1), lambda k: substr(a, i + 1, k) = substr(b, j + 1, k)), lambda k: {'k': k, 'i': -i, 'j': -j})))))) AS best
      FROM blocks) WHERE best IS NOT NULL)
), ratios AS (
  SELECT a, b, 2 * sum(k) / (length(a) + length(b)) AS score FROM (SELECT DISTINCT a, b, best.k AS k, best.i, best.j FROM blocks WHERE best IS NOT NULL) GROUP BY a, b
)"""


@_query(f"""
WITH RECURSIVE a AS (SELECT p_brand AS book, p_partkey AS ord, {key_sql("p_name", "a-z0-9")} AS t FROM part WHERE p_size % 2 = 0), b AS (SELECT p_brand AS book, p_partkey AS work, {key_sql("p_name", "a-z0-9")} AS t FROM part WHERE p_size % 2 = 1),
pairs AS (SELECT x.a, y.b FROM (SELECT DISTINCT t AS a FROM a) x, (SELECT DISTINCT t AS b FROM b) y WHERE 2 * least(length(x.a), length(y.b)) >= 0.75 * (length(x.a) + length(y.b))),
{RATIO_SQL}
SELECT book, ord, arg_min(work, (-score, work)) AS work FROM (SELECT a.book, a.ord, b.work, r.score FROM a JOIN b ON a.book = b.book JOIN ratios r ON r.a = a.t AND r.b = b.t WHERE r.score >= 0.75) GROUP BY book, ord""")
def works_by_likeness(spark, sf_dir):
    return toc.match_works(_entries(spark, sf_dir, "p_size % 2 = 0"), _entries(spark, sf_dir, "p_size % 2 = 1"), threshold=0.75)


@_query("""
WITH a AS (SELECT p_brand AS book, p_partkey AS ord, row_number() OVER (PARTITION BY p_brand ORDER BY p_partkey) AS k FROM part WHERE p_size % 2 = 0),
b AS (SELECT p_brand AS book, p_partkey AS work, row_number() OVER (PARTITION BY p_brand ORDER BY p_partkey) AS k FROM part WHERE p_size % 2 = 1)
SELECT coalesce(a.book, b.book) AS book, ord, work FROM a FULL JOIN b ON a.book = b.book AND a.k = b.k""")
def works_in_order(spark, sf_dir):
    return toc.works_in_order(_entries(spark, sf_dir, "p_size % 2 = 0").select("book", "ord"), _entries(spark, sf_dir, "p_size % 2 = 1").select("book", "ord", "work")).select("book", "ord", "work")


@_query("""
WITH e AS (SELECT p_brand AS book, p_partkey AS ord, p_size * 3 AS a, p_size * 3 + p_partkey % 4 AS z FROM part),
h AS (SELECT book, ord, unnest(range(a, z + 1)) AS page FROM e), m AS (SELECT book, page, min(ord) AS ord FROM h GROUP BY ALL),
p AS (SELECT DISTINCT p_brand AS book, cast(unnest(range(0, 160)) AS INTEGER) AS page FROM part)
SELECT p.book, p.page, m.ord FROM p LEFT JOIN m ON p.book = m.book AND p.page = m.page""")
def page_owners(spark, sf_dir):
    e = _entries(spark, sf_dir)
    start = F.col("p_size") * 3
    placed = e.select("book", "ord", start.alias("pdf_start"), (start + F.col("ord") % 4).cast("int").alias("pdf_end"))
    every = e.select("book").distinct().select("book", F.explode(F.sequence(F.lit(0), F.lit(159))).alias("page"))
    return toc.owner_of(every, placed)


# --- books of blocks


@_query("""
WITH t AS (SELECT conv_id AS book, turn AS k, role FROM conversations), a AS (SELECT book, k, CASE role WHEN 'user' THEN 2 ELSE 3 END AS l FROM t WHERE k % 3 < 2), b AS (SELECT book, k, CASE WHEN k % 2 = 0 THEN 2 ELSE 3 END AS l FROM t WHERE k % 3 > 0)
SELECT coalesce(a.book, b.book) AS book, coalesce(a.k, b.k) AS k, a.l IS NOT DISTINCT FROM b.l AS paired FROM a FULL JOIN b ON a.book = b.book AND a.k = b.k""")
def zipped_sections(spark, sf_dir):
    t = _read(spark, sf_dir, "conversations").select(F.col("conv_id").alias("book"), F.col("turn").alias("k"), F.col("text").alias("title"), "role")
    a = t.where("k % 3 < 2").withColumn("level", F.when(F.col("role") == "user", 2).otherwise(3))
    b = t.where("k % 3 > 0").withColumn("level", F.when(F.col("k") % 2 == 0, 2).otherwise(3))
    return blocks.zip_sections(a, b).select("book", "k", "paired")


@_query("""
WITH d AS (SELECT source AS book, doc_id AS idx, text, sha1(text) AS s FROM documents WHERE text IS NOT NULL),
x AS (SELECT book, s, idx + 3 AS i FROM d WHERE idx % 3 = 0),
m AS (SELECT d.book, d.idx, x.i, row_number() OVER (PARTITION BY d.book, d.idx ORDER BY abs(x.i - d.idx), x.i) AS rn FROM d JOIN x ON d.book = x.book AND d.s = x.s)
SELECT book, idx, i AS box FROM m WHERE rn = 1""")
def known_boxes(spark, sf_dir):
    d = _read(spark, sf_dir, "documents").where("text is not null").select(F.col("source").alias("book"), F.col("doc_id").alias("idx"), "text")
    i = F.col("idx") + 3
    held = d.where("idx % 3 = 0").select("book", i.alias("i"), F.sha1(F.col("text").cast("binary")).alias("sha1"), F.array(i).alias("boxes"))
    return blocks.known_boxes(d, held).select("book", "idx", F.col("boxes")[0].alias("box"))


def _noted(spark, sf_dir):
    """Pages as books: links call notes, paragraphs define them."""
    p = _read(spark, sf_dir, "pages")
    called = F.transform(F.regexp_extract_all("html", F.lit(r'href="/([^"\s\]]+)"'), 1), lambda x: F.concat(F.lit("[^"), x, F.lit("]")))
    defined = F.transform(F.regexp_extract_all("html", F.lit(r"<p>([^<\s\]]+)"), 1), lambda x: F.concat(F.lit("[^"), x, F.lit("]: said of "), x, F.lit(" ⚠ <!-- note pdf 7 · x -->")))
    return p.select(F.col("page_id").alias("book"), F.posexplode(F.concat(F.array(F.concat(F.lit("x "), F.array_join(called, " "))), defined)).alias("idx", "text"))


@_query(r"""
WITH d AS (SELECT page_id AS book, regexp_extract_all(html, '<p>([^<\s\]]+)', 1) AS l FROM pages), f AS (SELECT book, unnest(range(1, len(l) + 1)) AS idx, unnest(l) AS note_id FROM d)
SELECT book, idx, note_id, 7 AS page, string_split(note_id, '-')[-1] AS marker, 'said of ' || note_id AS text FROM f""")
def note_definitions(spark, sf_dir):
    return notes.definitions(_noted(spark, sf_dir)).select("book", *_long("idx"), "note_id", "page", "marker", "text")


@_query(r"""
WITH d AS (SELECT page_id AS book, regexp_extract_all(html, 'href="/([^"\s\]]+)"', 1) AS l FROM pages), c AS (SELECT book, unnest(range(1, len(l) + 1)) AS nth, unnest(l) AS note_id FROM d),
f AS (SELECT book, note_id, min(nth) AS first FROM c GROUP BY ALL)
SELECT book, note_id, row_number() OVER (PARTITION BY book ORDER BY first) AS number FROM f""")
def renumbered_notes(spark, sf_dir):
    return notes.renumbered(_noted(spark, sf_dir)).select("book", "note_id", *_long("number"))


@_query(r"""
WITH n AS (SELECT o_custkey AS book, o_orderpriority AS scope, row_number() OVER (PARTITION BY o_custkey, o_orderpriority ORDER BY o_orderkey) AS number, o_orderkey AS id, o_orderstatus AS s FROM orders),
l AS (SELECT book, scope, number, '[^' || id || ']: &lt;b> ' || s || CASE WHEN s = 'O' THEN ' ⚠' ELSE '' END || ' <!-- note pdf ' || CASE WHEN id % 2 = 0 THEN cast(id AS VARCHAR) ELSE id || '-' || id + 1 END || ' · ' ||
  CASE WHEN s = 'F' THEN 'call not found' ELSE 'called on pdf ' || number END || ' -->' AS line FROM n)
SELECT book, scope, '**Chú thích:**' || chr(10) || chr(10) || string_agg(line, chr(10) ORDER BY number) AS text FROM l GROUP BY book, scope""")
def rendered_notes(spark, sf_dir):
    from pyspark.sql import Window

    o = _read(spark, sf_dir, "orders")
    number = F.row_number().over(Window.partitionBy("o_custkey", "o_orderpriority").orderBy("o_orderkey"))
    k, s = F.col("o_orderkey"), F.col("o_orderstatus")
    n = o.withColumn("number", number).select(
        F.col("o_custkey").alias("book"), F.col("o_orderpriority").alias("scope"), "number", k.cast("string").alias("id"), F.concat(F.lit("<b> "), s).alias("text"),
        k.alias("first"), (k + k % 2).alias("last"), F.when(s != "F", F.col("number")).alias("called_on"), (s == "O").alias("flagged"),
    )
    return notes.rendered_definitions(n)


# --- words


WORDS_SQL = f"regexp_extract_all(text, '[A-Za-z0-9{text.MARKED}]+')"


def _words(spark, sf_dir, most=None):
    d = _read(spark, sf_dir, "documents").where("text is not null").select(F.col("lang").alias("book"), F.col("doc_id").alias("idx"), "text")
    return spelling.word_rows(d, "book", "idx", most=most)


@_query(f"""
WITH d AS (SELECT lang AS book, doc_id AS idx, {WORDS_SQL} AS w FROM documents WHERE text IS NOT NULL), s AS (SELECT book, idx, unnest(range(0, len(w))) AS i, unnest(w) AS word FROM d)
SELECT book, idx, cast(i AS INTEGER) AS i, word, lower(translate(word, '{text.MARKED}', '{text.BASE}')) AS fold FROM s""")
def words_with_folds(spark, sf_dir):
    return _words(spark, sf_dir).select("book", "idx", "i", "word", "fold")


@_query(f"""
WITH d AS (SELECT lang AS book, {WORDS_SQL} AS w FROM documents WHERE text IS NOT NULL), r AS (SELECT DISTINCT book, w[1] AS a, w[2] AS z FROM d WHERE len(w) > 1),
p AS (SELECT book, lower(unnest(w[1:len(w) - 1])) AS a, lower(unnest(w[2:len(w)])) AS z FROM d WHERE len(w) > 1), c AS (SELECT book, a, z, count(*) AS n FROM p GROUP BY ALL)
SELECT r.book, r.a || ' ' || r.z AS spelling, coalesce(n, 0) AS n FROM r LEFT JOIN c ON r.book = c.book AND lower(r.a) = c.a AND lower(r.z) = c.z""")
def times_spelled(spark, sf_dir):
    two = _words(spark, sf_dir, 2).groupBy("book", "idx").agg(F.transform(F.array_sort(F.collect_list(F.struct("i", "word"))), lambda x: x["word"]).alias("words"))
    rules = two.where(F.size("words") == 2).select("book", F.array_join("words", " ").alias("spelling"), "words").distinct()
    texts = _read(spark, sf_dir, "documents").where("text is not null").select(F.col("lang").alias("book"), "text")
    return spelling.times_spelled(texts, rules)


@_query(f"""
WITH {ROWS_SQL}, l AS (SELECT book, page, row AS line, list_distinct({LETTER_WORDS}) AS f FROM r), h AS (SELECT book, page, line, f, unnest(f) AS fold FROM l),
d AS (SELECT source AS book, doc_id AS id, {LETTER_WORDS} AS w FROM documents WHERE text IS NOT NULL), o AS (SELECT book, id, w[3] AS fold, list_distinct(w[1:6]) AS near FROM d WHERE len(w) > 5),
p AS (SELECT book, id, fold, near, unnest([id, id + 20]) AS page FROM o),
m AS (SELECT p.book, p.id, p.page, h.line, row_number() OVER (PARTITION BY p.book, p.id ORDER BY p.page = p.id DESC, len(list_intersect(near, f)) DESC, p.page, h.line) AS rn FROM p JOIN h ON p.book = h.book AND p.page = h.page AND p.fold = h.fold)
SELECT book, id, page, cast(line AS BIGINT) AS line FROM m WHERE rn = 1""")
def nearest_lines(spark, sf_dir):
    folds = lambda c: text.letter_words(text.casefolded(F.col(c)))
    lines = page_rows(spark, sf_dir).select("book", "page", F.col("row").alias("line"), folds("text").alias("folds"))
    d = _read(spark, sf_dir, "documents").where("text is not null").select(F.col("source").alias("book"), F.col("doc_id").alias("id"), folds("text").alias("w")).where(F.size("w") > 5)
    asked = d.select("book", "id", F.col("w")[2].alias("fold"), F.slice("w", 1, 6).alias("near"), F.array("id").alias("pages"), F.array(F.col("id") + 20).alias("more_pages"))
    return spelling.nearest_lines(asked, lines).select("book", "id", "page", *_long("line"))


@_query("""
SELECT o_custkey AS book, o_orderkey AS word, rank FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_totalprice DESC, o_orderkey) AS rank FROM orders) WHERE rank <= 4""")
def top_candidates(spark, sf_dir):
    o = _read(spark, sf_dir, "orders").select(F.col("o_custkey").alias("book"), F.lit(0).alias("id"), F.col("o_orderkey").alias("word"), F.col("o_totalprice").alias("score"))
    return quality.top_candidates(o).select("book", "word", F.col("rank").cast("long").alias("rank"))


@_query(f"""
WITH {ROWS_SQL}, w AS (SELECT book, {LETTER_WORDS} AS w FROM r), one AS (SELECT book, word, count(*) AS n FROM (SELECT book, unnest(w) AS word FROM w) GROUP BY ALL),
two AS (SELECT book, word, next, count(*) AS n FROM (SELECT book, unnest(w[1:len(w) - 1]) AS word, unnest(w[2:len(w)]) AS next FROM w WHERE len(w) > 1) GROUP BY ALL),
tone AS (SELECT book, translate(word, '{text.TONED}', '{text.TONELESS}') AS bare, next, sum(n) AS n FROM two GROUP BY ALL)
SELECT a.book, a.word, a.next, (50 * a.n + least(one.n, 100))::DOUBLE + 0.5::DOUBLE * (tone.n - a.n) AS score
FROM two a JOIN one ON a.book = one.book AND a.word = one.word JOIN tone ON a.book = tone.book AND a.next = tone.next AND tone.bare = translate(a.word, '{text.TONED}', '{text.TONELESS}') WHERE a.n >= 3""")
def lexicon_scores(spark, sf_dir):
    lexicon = quality.written(quality.followed(page_rows(spark, sf_dir)))
    asked = lexicon.where("next is not null and n >= 3").select("book", "word", "next")
    return quality.scored(asked, lexicon).select("book", "word", "next", F.col("score").cast("double").alias("score"))


@_query("""
WITH p AS (SELECT event_type AS book, event_id AS page, CASE WHEN event_id % 4 > 0 THEN event_id - cast(floor(value) AS BIGINT) % 3 END AS printed FROM events)
SELECT book, page, printed AS printed_page, CASE WHEN printed IS NOT NULL THEN EXISTS (SELECT 1 FROM p q WHERE q.book = p.book AND q.page <> p.page AND abs(q.page - p.page) <= 2 AND q.printed > 0 AND q.page - q.printed = p.page - p.printed) END AS agrees FROM p""")
def neighbouring_numbers(spark, sf_dir):
    k = F.col("event_id")
    printed = F.when(k % 4 > 0, k - F.floor("value").cast("long") % 3)
    p = _read(spark, sf_dir, "events").select(F.col("event_type").alias("book"), k.alias("page"), printed.alias("printed_page"))
    agrees = F.when(F.col("printed_page").isNotNull(), F.coalesce("agrees", F.lit(False)))
    return pages.supported_by_neighbours(p).select("book", "page", "printed_page", agrees.alias("agrees"))


@_query("""
SELECT p_brand AS book, min(p_size) AS pdf_start, max(p_size + p_partkey % 4) AS pdf_end FROM part GROUP BY p_brand""")
def toc_roots(spark, sf_dir):
    from ..operators import corrections

    e = _entries(spark, sf_dir).select("book", F.col("p_size").cast("long").alias("pdf_start"), (F.col("p_size") + F.col("ord") % 4).alias("pdf_end"))
    return corrections.toc_root(e).select("book", F.col("pdf_start").cast("int").alias("pdf_start"), "pdf_end")


@_query(rf"""
WITH {ROWS_SQL}, n AS (SELECT book, page, CASE WHEN row % 3 = 0 THEN text || ' .. ' || row ELSE text END AS t FROM r)
SELECT book, page, avg(CASE WHEN regexp_matches(t, '\d{{1,4}}\W*$') THEN 1.0 ELSE 0.0 END::DOUBLE) AS share FROM n GROUP BY book, page""")
def numbered_shares(spark, sf_dir):
    t = F.when(F.col("row") % 3 == 0, F.concat("text", F.lit(" .. "), F.col("row").cast("string"))).otherwise(F.col("text"))
    return toc.numbered_share(page_rows(spark, sf_dir).withColumn("text", t))


@_query(r"""
WITH p AS (SELECT p_partkey, p_name || '(' || p_size || ') and (' || p_partkey || ') as on [tr. ' || p_partkey || '] x' AS t FROM part)
SELECT p_partkey, array_to_string(regexp_extract_all(t, '\S\((\d{1,2})\)', 1), ',') AS called, array_to_string(regexp_extract_all(t, '\[tr\.\s*(\d+)\]', 1), ',') AS referred FROM p""")
def numbers_called(spark, sf_dir):
    key = F.col("p_partkey").cast("string")
    t = F.concat("p_name", F.lit("("), F.col("p_size").cast("string"), F.lit(") and ("), key, F.lit(") as on [tr. "), key, F.lit("] x"))
    said = lambda c: F.array_join(c.cast("array<string>"), ",")
    return _read(spark, sf_dir, "part").select("p_partkey", said(text.numbers_called(t)).alias("called"), said(text.pages_referred(t)).alias("referred"))


@_query(f"""
WITH {ROWS_SQL}, b AS (SELECT book, max(page) AS page_count, CASE WHEN max(page) % 2 = 0 THEN max(page) - 30 END AS end_page FROM r GROUP BY book)
SELECT book, page, cast(row AS BIGINT) AS row, row_number() OVER (PARTITION BY book ORDER BY page, row) - 1 AS place
FROM r JOIN b USING (book) WHERE page BETWEEN 1 AND coalesce(end_page, page_count) AND page % 7 <> 0""")
def book_stream(spark, sf_dir):
    r = page_rows(spark, sf_dir).withColumnRenamed("row", "seq")
    last = F.max("page")
    books = r.groupBy("book").agg(last.alias("page_count"), F.when(last % 2 == 0, last - 30).alias("end_page"))
    placed = pages.stream_of(r, books, r.where("page % 7 = 0"))
    return placed.select("book", "page", F.col("seq").cast("long").alias("row"), F.col("place").cast("long").alias("place"))


@_query(f"""
WITH {ROWS_SQL}, t AS (SELECT * FROM r WHERE page % 3 = 0 AND length(text) > 30), p AS (SELECT DISTINCT book, page FROM t)
SELECT book, page, cast(row AS BIGINT) AS row FROM t UNION ALL SELECT book, page, cast(row AS BIGINT) AS row FROM r ANTI JOIN p USING (book, page)""")
def preferred_rows(spark, sf_dir):
    r = page_rows(spark, sf_dir)
    return toc.preferred_rows(r, r.where("page % 3 = 0 and length(text) > 30")).select("book", "page", *_long("row"))


@_query("""
WITH e AS (SELECT p_brand AS book, CASE p_size % 3 WHEN 0 THEN 'a' WHEN 1 THEN 'a/b' || p_size ELSE 'a/b' || p_size || '/c' || p_partkey END AS entry_id, p_partkey FROM part),
s AS (SELECT book, entry_id, string_split(entry_id, '/') AS p FROM e)
SELECT book, entry_id, array_to_string(p[1:n], '/') AS ancestor, cast(n AS INTEGER) AS depth FROM (SELECT *, unnest(range(1, len(p))) AS n FROM s)""")
def entry_ancestors(spark, sf_dir):
    size = F.col("p_size").cast("string")
    path = F.when(F.col("p_size") % 3 == 0, "a").when(F.col("p_size") % 3 == 1, F.concat(F.lit("a/b"), size))
    path = path.otherwise(F.concat(F.lit("a/b"), size, F.lit("/c"), F.col("p_partkey").cast("string")))
    return toc.ancestors(_read(spark, sf_dir, "part").select(F.col("p_brand").alias("book"), path.alias("entry_id")))
