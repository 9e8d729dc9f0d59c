"""Quality rules: base counts of each text and cross-document line frequency, in DataFrame functions.

Line frequency: normalised lines are hashed, distinct documents per host are counted for each, lines
above the host's limit are removed, and documents that lose most of their words are rejected.

The limit of a host is the larger of `MIN_DOCUMENTS` and a share of the host's documents, so a group
of copies inside a host is left to the deduplication operators and only what a tenth of a host
repeats counts as its furniture.

What counts as a document there: in the report each row, as its SQL says; in `filtered` each different
text of a host, so that copies of one text never make its own lines furniture and the text is kept for
the deduplication operators to choose from.

Defined cases: a null text has no words and fails; repeated rows are separate documents with the same
result; a null source is a host of its own; a line counts once for a document however often it stands there;
an empty table gives an empty result; columns of any other name are carried along by `filtered`.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import keeping_columns, materialise, text_or_empty

#: White space that parts words (fixed characters of the contract).
SPACES = " \t\n\x0b\f\r"
#: Symbols that are counted (fixed characters of the contract).
SYMBOLS = "#*$%&|<>"
MIN_WORDS = 50
#: Repeated words of a text at most, in hundredths of its words.
MOST_REPEATED = 50
#: A line is furniture if more documents of its host hold it than both of these,
MIN_DOCUMENTS = 20
HOST_SHARE = 0.10
#: and a document is depleted if fewer of its words than this share are left.
LEAST_LEFT = 0.5
#: Up to so many repeated windows of a text are looked up one by one; more are found by sorting.
FEW = 48


def spaced(text: Column) -> Column:
    """The text with a blank for each of the six white characters."""
    for c in SPACES[1:]:
        text = F.replace(text, F.lit(c), F.lit(" "))
    return text


def _has_word(line: Column) -> Column:
    return F.btrim(line, F.lit(SPACES)) != ""


def repeated_words(df: DataFrame, words: str, out: str) -> DataFrame:
    """Add `out`: the words of an array that lie in 3-word windows found twice or more in it.

    Windows are compared by 64-bit hash. Repeated hashes are neighbours in sorted order; the places of
    repeated windows then cover min(3, distance to the next place) words each.
    """
    w = f"`{words}`"
    hashed = df.withColumn(
        "_tri",
        F.expr(
            f"if(size({w}) < 3, cast(array() as array<bigint>), transform(sequence(0, size({w}) - 3), "
            f"i -> xxhash64({w}[i], {w}[i + 1], {w}[i + 2])))"
        ),
    )
    marked = hashed.withColumn("_twice", F.expr("size(array_distinct(_tri)) < size(_tri)"))
    sorted_ = marked.withColumn("_sorted", F.expr("if(_twice, sort_array(_tri), cast(array() as array<bigint>))"))
    repeated = sorted_.withColumn(
        "_same", F.expr("array_distinct(filter(_sorted, (x, i) -> i > 0 and x = get(_sorted, i - 1)))")
    )
    pairs = "array_sort(transform(_tri, (x, i) -> struct(x as h, i as i)))"
    placed = repeated.withColumn(
        "_pairs", F.expr(f"if(size(_same) > {FEW}, {pairs}, cast(array() as array<struct<h: bigint, i: int>>))")
    ).withColumn(
        "_at",
        F.expr(
            "case when size(_same) = 0 then cast(array() as array<int>) "
            f"when size(_same) <= {FEW} then filter(transform(_tri, (x, i) -> if(array_contains(_same, x), i, -1)), i -> i >= 0) "
            "else sort_array(transform(filter(_pairs, (p, k) -> p.h = get(_pairs, k - 1).h or p.h = get(_pairs, k + 1).h), p -> p.i)) end"
        ),
    )
    total = (
        "cast(if(size(_at) = 0, 0, 3 + aggregate(transform(_at, (p, k) -> if(k = 0, 0, least(3, p - get(_at, k - 1)))), 0, (n, x) -> n + x)) as bigint)"
    )
    return placed.withColumn(out, F.expr(total)).drop("_tri", "_twice", "_sorted", "_same", "_pairs", "_at")


def _folded(text: Column) -> Column:
    """Lower case, digits alike, each white character but a line end as a blank."""
    folded = F.lower(text)
    folded = F.when(folded.rlike("[1-9]"), F.translate(folded, "123456789", "0" * 9)).otherwise(folded)
    for c in SPACES.replace("\n", "")[1:]:
        folded = F.replace(folded, F.lit(c), F.lit(" "))
    return folded


def _single(line: Column) -> Column:
    """A folded line with single blanks and none at its ends."""
    return F.btrim(F.when(F.contains(line, F.lit("  ")), F.regexp_replace(line, " +", " ")).otherwise(line))


def normalised(line: Column) -> Column:
    """A line for comparison: lower case, single spaces, digits alike."""
    return _single(_folded(line))


def counted(documents: DataFrame) -> DataFrame:
    """doc_id, source, text_key, base columns of each row, and `_held`: hash and number of words of its lines with a word.

    The one pass over whole texts.
    """
    text = text_or_empty(documents)
    lines = F.filter(F.split(F.col("_text"), "\n", -1), _has_word)
    normal = F.filter(F.transform(F.split(_folded(F.col("_text")), "\n", -1), _single), lambda x: x != "")
    n_in = lambda x: F.length(x) - F.length(F.replace(x, F.lit(" "), F.lit(""))) + 1
    read = (
        documents.select("doc_id", "source", text.alias("_text"))
        .withColumn("_parts", F.split(spaced(F.col("_text")), " ", -1))
        .withColumn("_words", F.filter("_parts", lambda w: w != ""))
        .withColumn("_lines", lines)
        .withColumn("_held", F.transform(normal, lambda x: F.struct(F.xxhash64(x).alias("h"), n_in(x).alias("n"))))
    )
    full = repeated_words(read, "_words", "n_repeat_words")
    n_words = F.size("_words").cast("long")
    symbols = F.length("_text") - F.length(F.translate("_text", SYMBOLS, ""))
    return full.select(
        "doc_id",
        "source",
        F.xxhash64("_text").alias("text_key"),
        n_words.alias("n_words"),
        # as many white characters as there are cuts
        (F.length("_text") - F.size("_parts") + 1).cast("long").alias("word_chars"),
        F.when(F.col("_text").rlike(f"[{SYMBOLS}]"), symbols).otherwise(0).cast("long").alias("n_symbols"),
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long").alias("n_dup_lines"),
        "n_repeat_words",
        ((n_words < MIN_WORDS) | (F.col("n_repeat_words") * 100 > n_words * MOST_REPEATED)).alias("base_failed"),
        "_held",
    )


def furniture(documents: DataFrame, per_text: bool = False) -> DataFrame:
    """(source, h): lines that more documents of a host hold than its limit."""
    return _furniture(counted(documents), per_text)


def _furniture(rows: DataFrame, per_text: bool) -> DataFrame:
    """The same for what `counted` gives.

    A document counts once for a line: its hashes are made distinct before they leave the row. The
    counts combine before the shuffle, so a line that every document holds is no hot spot.
    per_text: equal texts of a host count as one document, also in the host's size.
    """
    if per_text:
        rows = rows.groupBy("source", "text_key").agg(F.first("_held").alias("_held"))
    lines = (
        rows.select("source", F.explode(F.array_distinct("_held.h")).alias("h"))
        .groupBy("source", "h")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    hosts = rows.groupBy("source").agg(F.count(F.lit(1)).alias("n_host"))
    return (
        lines.where(F.col("n") > MIN_DOCUMENTS)
        .join(hosts, lines["source"].eqNullSafe(hosts["source"]))
        .where(F.col("n") > F.col("n_host") * HOST_SHARE)
        .select(lines["source"], "h")
    )


def _lost(rows: DataFrame, gone: DataFrame) -> DataFrame:
    """(doc_id, source, text_key, n_lost): words in furniture lines."""
    gone = gone.select(F.col("source").alias("_source"), F.col("h").alias("_h"))
    lines = rows.select("doc_id", "source", "text_key", F.posexplode("_held").alias("place", "_line"))
    lines = lines.select("doc_id", "source", "text_key", "place", "_line.h", "_line.n")
    hit = lines.join(gone, lines["source"].eqNullSafe(gone["_source"]) & (lines["h"] == gone["_h"]), "left_semi")
    # rows equal in all three columns have the same lines, each as often as there are such rows
    per_line = hit.groupBy("doc_id", "source", "text_key", "place").agg(F.max("n").alias("n"))
    return per_line.groupBy("doc_id", "source", "text_key").agg(F.sum("n").alias("n_lost"))


def judged(documents: DataFrame, per_text: bool = False) -> tuple[DataFrame, DataFrame]:
    """Base columns, words lost with furniture lines and verdict of each row; and the furniture (source, h).

    Counts and furniture are written, so the texts are read once.
    """
    rows = materialise(counted(documents), "counts")
    gone = materialise(_furniture(rows, per_text), "furniture")
    lost = _lost(rows, gone).select(
        F.col("doc_id").alias("_id"), F.col("source").alias("_src"), F.col("text_key").alias("_key"), "n_lost"
    )
    base = rows.drop("_held")
    same = base["doc_id"].eqNullSafe(lost["_id"]) & (base["text_key"] == lost["_key"]) & base["source"].eqNullSafe(lost["_src"])
    left = F.col("n_words") - F.coalesce("n_lost", F.lit(0))
    depleted = (left < F.col("n_words")) & ((left < F.col("n_words") * LEAST_LEFT) | (left < MIN_WORDS))
    verdicts = (
        base.join(lost, same, "left")
        .withColumn("n_lost", F.coalesce("n_lost", F.lit(0)))
        .withColumn("kept", ~F.col("base_failed") & ~depleted)
        .drop("_id", "_src", "_key")
    )
    return verdicts, gone


def quality_report(documents: DataFrame) -> DataFrame:
    return judged(documents)[0].select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"
    )


@keeping_columns
def filtered(documents: DataFrame) -> DataFrame:
    """The documents that stay, without furniture lines; all columns, n_chars counted again where there is one."""
    text = text_or_empty(documents)
    verdicts, gone = judged(documents, per_text=True)
    keys = verdicts.where("kept").select(
        F.col("doc_id").alias("_id"), F.col("source").alias("_src"), F.col("text_key").alias("_key"), (F.col("n_lost") > 0).alias("_cut")
    ).distinct()
    keyed = documents.withColumn("_text_key", F.xxhash64(text))
    same = keyed["doc_id"].eqNullSafe(keys["_id"]) & (keyed["_text_key"] == keys["_key"]) & keyed["source"].eqNullSafe(keys["_src"])
    stay = keyed.join(keys.hint("shuffle_hash"), same, "inner")
    # at most (lines a document) / HOST_SHARE lines a host
    rows = gone.groupBy("source").agg(F.collect_set("h").alias("_gone")).withColumnRenamed("source", "_host")
    whole = stay.where(~F.col("_cut"))
    cut = stay.where("_cut").join(rows, stay["source"].eqNullSafe(rows["_host"]), "left")
    lines = F.filter(F.split("text", "\n", -1), lambda x: ~F.array_contains("_gone", F.xxhash64(normalised(x))))
    cut = cut.withColumn("text", F.array_join(lines, "\n"))
    if "n_chars" in documents.columns:
        cut = cut.withColumn("n_chars", F.length("text").cast(documents.schema["n_chars"].dataType))
    return whole.select(documents.columns).unionByName(cut.select(documents.columns))


def quality_sql() -> str:
    """The same in DuckDB, lines by their text and windows by their words."""
    words = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"
    one_line = r"trim(regexp_replace(translate(lower(l), '123456789', '000000000'), '[\x20\x09-\x0D]+', ' ', 'g'))"
    return rf"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, source, coalesce(text, '') AS t, {words} AS w FROM documents),
win AS (SELECT r, p, array_to_string(w[p:p + 2], ' ') AS g FROM d, unnest(range(1, len(w) - 1)) x(p)),
rep AS (SELECT r, count(DISTINCT q) AS n_rep FROM (
  SELECT r, unnest(range(p, p + 3)) AS q FROM win JOIN (SELECT r, g FROM win GROUP BY r, g HAVING count(*) > 1) USING (r, g)) GROUP BY r),
ln AS (SELECT r, source, l FROM (SELECT r, source, unnest(string_split(t, chr(10))) AS l FROM d) WHERE regexp_matches(l, '[^\x20\x09-\x0D]')),
dup AS (SELECT r, count(*) - count(DISTINCT l) AS n_dup FROM ln GROUP BY r),
nl AS (SELECT r, source, {one_line} AS k, len(regexp_extract_all(l, '[^\x20\x09-\x0D]+')) AS n FROM ln),
host AS (SELECT source, count(*) AS n_host FROM d GROUP BY source),
fur AS (SELECT f.source, k FROM (SELECT source, k, count(DISTINCT r) AS c FROM nl GROUP BY source, k) f
  JOIN host h ON f.source IS NOT DISTINCT FROM h.source WHERE c > {MIN_DOCUMENTS} AND c > n_host * {HOST_SHARE:.2f}::DOUBLE),
lost AS (SELECT r, sum(n) AS n_lost FROM nl JOIN fur ON nl.source IS NOT DISTINCT FROM fur.source AND nl.k = fur.k GROUP BY r),
b AS (SELECT doc_id, cast(len(w) AS BIGINT) AS n_words, length(regexp_replace(t, '[\x20\x09-\x0D]', '', 'g')) AS word_chars,
    length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS n_symbols, coalesce(n_dup, 0) AS n_dup_lines,
    coalesce(n_rep, 0) AS n_repeat_words, len(w) - coalesce(n_lost, 0) AS n_left
  FROM d LEFT JOIN rep USING (r) LEFT JOIN dup USING (r) LEFT JOIN lost USING (r)),
j AS (SELECT *, n_words < {MIN_WORDS} OR 100 * n_repeat_words > {MOST_REPEATED} * n_words AS base_failed FROM b)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT base_failed AND NOT (n_left < n_words AND (n_left < n_words * {LEAST_LEFT} OR n_left < {MIN_WORDS})) AS kept
FROM j"""
