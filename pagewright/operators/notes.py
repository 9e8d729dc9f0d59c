"""Footnotes and their calls: numbering, evidence, gaps, and audits of a book's notes."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import text
from .blocks import with_sections

#: How much a call's kind counts; any other kind counts 1 (fixed values).
WEIGHTS = {"clean": 2.0, "secondary": 1.5, "headword": 1.5, "verse": 1.5}
CLEAN = r"\((\d{1,2})\)"
GLUED = r"(?<=\p{L})(\d{1,2})(?![\d\p{L}])"


def call_candidates(segments: DataFrame) -> DataFrame:
    """(book, page, seq, start, number, kind): numbers in text that may call a note."""
    t = F.col("text")
    found = []
    for kind, pattern in (("clean", CLEAN), ("glued", GLUED)):
        hits = F.regexp_extract_all(t, F.lit(pattern), 1)
        # the k-th hit starts behind k pieces and the hits between them
        pieces = F.split(t, pattern)
        sizes = F.regexp_extract_all(t, F.lit(pattern), 0)
        start = lambda k, p=pieces, s=sizes: F.aggregate(F.slice(p, 1, k + 1), F.lit(0), lambda n, x: n + F.length(x)) + F.aggregate(F.slice(s, 1, k), F.lit(0), lambda n, x: n + F.length(x))
        rows = segments.where(F.col("kind") != "footnote").select("book", "page", "seq", "text", F.posexplode(hits).alias("_k", "_n"))
        found.append(rows.select("book", "page", "seq", start(F.col("_k")).alias("start"), F.col("_n").cast("int").alias("number"), F.lit(kind).alias("kind")))
    return found[0].unionByName(found[1]).where("number between 1 and 99")


def heaviest_run(numbers: list[int], weights: list[float]) -> list[int]:
    """Places of the run of increasing numbers with the greatest weight; the earliest on ties.

    For each number the best run that ends with it so far is kept, which a later, larger number goes on from.
    """
    ends: dict[int, tuple[float, int]] = {}
    came_from: dict[int, int | None] = {}
    for place, (number, weight) in enumerate(zip(numbers, weights, strict=True)):
        below = [(-total, last) for n, (total, last) in ends.items() if n < number]
        lost, last = min(below, default=(0.0, None))
        came_from[place] = last
        if weight - lost > ends.get(number, (0.0, 0))[0]:
            ends[number] = (weight - lost, place)
    at = min(((-total, last) for total, last in ends.values()), default=(0.0, None))[1]
    places = []
    while at is not None:
        places.append(at)
        at = came_from[at]
    return places[::-1]


def _chosen(group: pd.DataFrame) -> pd.DataFrame:
    group = group.sort_values(["page", "seq", "start"], ignore_index=True)
    places = heaviest_run(group["number"].tolist(), [WEIGHTS.get(k, 1.0) for k in group["kind"]])
    return group.iloc[places][["book", "scope", "page", "seq", "start", "number", "kind"]]


def chosen_calls(candidates: DataFrame, scopes: DataFrame) -> DataFrame:
    """The calls of each note scope: its heaviest increasing run of numbers up to its last note (scope, last)."""
    some = candidates.join(scopes.select("book", "scope", "last"), ["book", "scope"]).where(F.col("number").between(1, F.col("last"))).drop("last")
    columns = some.select("book", "scope", "page", "seq", "start", "number", "kind")
    return columns.groupBy("book", "scope").applyInPandas(_chosen, columns.schema)


def filled_gaps(chosen: DataFrame, candidates: DataFrame, scopes: DataFrame) -> DataFrame:
    """Calls for numbers that the run leaves out, only where as many confirmed marks lie between as are missing."""
    edges = scopes.select("book", "scope", F.lit(0).alias("number"), F.struct(F.lit(-1).alias("page"), F.lit(-1).alias("seq"), F.lit(-1).alias("start")).alias("pos"))
    ends = scopes.select("book", "scope", (F.col("last") + 1).alias("number"), F.struct(F.lit(1 << 30).alias("page"), F.lit(0).alias("seq"), F.lit(0).alias("start")).alias("pos"))
    cast = "struct<page: bigint, seq: bigint, start: bigint>"
    runs = chosen.select("book", "scope", "number", F.struct("page", "seq", "start").cast(cast).alias("pos")).unionByName(edges.withColumn("pos", F.col("pos").cast(cast))).unionByName(ends.withColumn("pos", F.col("pos").cast(cast)))
    w = Window.partitionBy("book", "scope").orderBy("number")
    gaps = runs.withColumn("_next", F.lead("number").over(w)).withColumn("_until", F.lead("pos").over(w)).where(F.col("_next") - F.col("number") > 1)
    gaps = gaps.select("book", "scope", F.col("number").alias("_from"), (F.col("_next") - F.col("number") - 1).alias("missing"), F.col("pos").alias("_after"), "_until")
    marks = candidates.where("kind in ('junk', 'mark') and confirmed").withColumn("pos", F.struct("page", "seq", "start").cast(cast))
    held = marks.join(gaps, ["book", "scope"]).where((F.col("pos") > F.col("_after")) & (F.col("pos") < F.col("_until")))
    g = Window.partitionBy("book", "scope", "_from")
    sure = held.withColumn("_n", F.count(F.lit(1)).over(g)).where(F.col("_n") == F.col("missing"))
    return sure.select("book", "scope", "page", "seq", "start", (F.col("_from") + F.row_number().over(g.orderBy("pos"))).alias("number"), "kind")


def split_notes(rows: DataFrame) -> DataFrame:
    """Notes under a page's rule: a row that opens with a mark starts one, the others go on. (book, page, note, text, marker)"""
    w = Window.partitionBy("book", "page").orderBy("row")
    opens = F.col("text").rlike(r"^\s*(\(?\d{1,2}[.)]|\(?\*+\)?)")
    numbered = rows.withColumn("note", F.sum(opens.cast("int")).over(w)).where("note > 0")
    joined = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("row", "text"))), lambda x: F.btrim(x["text"])), " ")
    out = numbered.groupBy("book", "page", "note").agg(joined.alias("text"))
    return out.withColumn("marker", F.regexp_extract("text", r"^\s*\(?(\d{1,2}|\*+)", 1))


def sequenced(notes: DataFrame) -> DataFrame:
    """Notes numbered by their order on the page, stars apart; what was read stays as `ocr_marker` where it differs."""
    star = F.col("marker").startswith("*")
    n = F.row_number().over(Window.partitionBy("book", "page", star).orderBy("note"))
    read = text.digits_repaired(F.col("marker")).try_cast("int")
    return notes.withColumn("number", F.when(~star, n)).withColumn("ocr_marker", F.when(~star & ~read.eqNullSafe(n), F.col("marker")))


def definitions(blocks: DataFrame) -> DataFrame:
    """Note definitions: book, idx, k (section), note_id, page, marker, text without its comment and marks."""
    pattern = r"(?s)^\[\^([^\]\s]+)\]:\s?(.*)$"
    some = with_sections(blocks).where(F.col("text").rlike(pattern))
    body = F.regexp_extract("text", pattern, 2)
    page = F.regexp_extract(body, r"<!--\s*note pdf (\d+)", 1)
    plain = F.btrim(F.replace(F.regexp_replace(body, r"(?s)\s*<!--.*?-->", ""), F.lit(" ⚠"), F.lit("")))
    note_id = F.regexp_extract("text", pattern, 1)
    return some.select("book", "idx", "k", note_id.alias("note_id"), F.when(page != "", page.cast("int")).alias("page"), F.element_at(F.split(note_id, "-"), -1).alias("marker"), F.replace(plain, F.lit("&lt;"), F.lit("<")).alias("text"))


def calls(blocks: DataFrame) -> DataFrame:
    """(book, idx, k, note_id, nth): calls in reading order of the blocks that aren't definitions or comments."""
    some = with_sections(blocks).where(~text.block_kind(F.col("text")).isin("note", "comment"))
    return some.select("book", "idx", "k", F.posexplode(text.note_calls(F.col("text"))).alias("nth", "note_id"))


def audit(blocks: DataFrame) -> DataFrame:
    """(book, k, note_id, n_defined, n_called): every note of a section that is defined or called."""
    d = definitions(blocks).groupBy("book", "k", "note_id").agg(F.count(F.lit(1)).alias("n_defined"))
    c = calls(blocks).groupBy("book", "k", "note_id").agg(F.count(F.lit(1)).alias("n_called"))
    return d.join(c, ["book", "k", "note_id"], "full").fillna(0, ["n_defined", "n_called"])


def synced(raw: DataFrame, current: DataFrame) -> DataFrame:
    """(book, note_id, change): how a corrected book's definitions differ from the raw one's, and calls that came or went.

    change: added, removed or edited for a definition; called or uncalled where it is defined in both alike.
    """
    a = definitions(raw).select("book", "note_id", F.col("text").alias("before"))
    b = definitions(current).select("book", "note_id", F.col("text").alias("after"))
    was = calls(raw).groupBy("book", "note_id").agg(F.count(F.lit(1)).alias("n_before"))
    now = calls(current).groupBy("book", "note_id").agg(F.count(F.lit(1)).alias("n_after"))
    met = a.join(b, ["book", "note_id"], "full").join(was, ["book", "note_id"], "full").join(now, ["book", "note_id"], "full")
    change = (
        F.when(F.col("before").isNull() & F.col("after").isNotNull(), "added")
        .when(F.col("after").isNull() & F.col("before").isNotNull(), "removed")
        .when(F.col("before") != F.col("after"), "edited")
        .when(F.col("n_before").isNull() & F.col("n_after").isNotNull(), "called")
        .when(F.col("n_after").isNull() & F.col("n_before").isNotNull(), "uncalled")
    )
    return met.select("book", "note_id", "before", "after", change.alias("change")).where("change is not null")


def counts_by_scope(notes: DataFrame) -> DataFrame:
    """(book, counts): scope to status to number."""
    by_status = notes.groupBy("book", "scope", "status").agg(F.count(F.lit(1)).alias("n"))
    inner = by_status.groupBy("book", "scope").agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("status", "n")))).alias("m"))
    return inner.groupBy("book").agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("scope", "m")), lambda x, y: F.when(x["scope"] < y["scope"], -1).when(x["scope"] > y["scope"], 1).otherwise(0))).alias("counts"))


def renumbered(blocks: DataFrame) -> DataFrame:
    """(book, k, note_id, number): calls numbered by first appearance in their section."""
    first = calls(blocks).groupBy("book", "k", "note_id").agg(F.min(F.struct("idx", "nth")).alias("_first"))
    return first.withColumn("number", F.row_number().over(Window.partitionBy("book", "k").orderBy("_first"))).drop("_first")


def headword_evidence(notes: DataFrame, segments: DataFrame) -> DataFrame:
    """(book, note_id, page, seq, start): where a note's headword stands once, and only once, in its scope's pages.

    notes: book, note_id, text (headword before a colon), first, last (pages).
    """
    word = F.btrim(F.regexp_extract("text", r"^([^:]{2,40}):", 1))
    asked = notes.withColumn("_w", word).where("_w <> ''").select("book", "note_id", "_w", F.explode(F.sequence("first", "last")).alias("page"))
    body = segments.where("kind <> 'footnote'").select("book", "page", "seq", "text")
    met = asked.join(body, ["book", "page"]).where(F.expr("contains(text, _w)"))
    times = (F.length("text") - F.length(F.expr("replace(text, _w, '')"))) / F.length("_w")
    place = F.expr("locate(_w, text)") + F.length("_w") - 1
    found = met.groupBy("book", "note_id").agg(F.sum(times).alias("_n"), F.min(F.struct("page", "seq", place.alias("start"))).alias("_f"))
    return found.where("_n = 1").select("book", "note_id", "_f.*")


def rendered_definitions(notes: DataFrame) -> DataFrame:
    """(book, scope, text): the Markdown of each scope's notes, in order of their numbers.

    notes: book, scope, number, id, text, first, last (PDF pages), called_on (page, null where the call isn't found), flagged.
    """
    where = F.when(F.col("called_on").isNull(), "call not found").otherwise(F.concat(F.lit("called on pdf "), F.col("called_on").cast("string")))
    plain = F.regexp_replace("text", "<(?=[A-Za-z/!])", "&lt;")
    flag = F.when(F.col("flagged"), " ⚠").otherwise("")
    pages = text.page_label(F.col("first"), F.col("last"))
    line = F.concat(F.lit("[^"), "id", F.lit("]: "), plain, flag, F.lit(" <!-- note pdf "), pages, F.lit(" · "), where, F.lit(" -->"))
    lines = F.transform(F.array_sort(F.collect_list(F.struct("number", line.alias("line")))), lambda x: x["line"])
    whole = F.concat_ws("\n", F.lit("**Chú thích:**"), F.lit(""), F.array_join(lines, "\n"))
    return notes.groupBy("book", "scope").agg(whole.alias("text"))


#: How a block of notes is titled, how its notes open, and digits that are misread there (fixed patterns of the print).
BLOCK_TITLE = r"(?iu)^[^\p{L}\p{N}_]*ch[uú]\s*th[ií]ch[^\p{L}\p{N}_]*$"
NOTE_OPENS = r"^[^\p{L}\p{N}_]{0,3}\(\s*([0-9lLIi|!¡]{0,3})\s*\)\s*"
MISREAD_ONES = "lLIi|!¡"


def note_blocks(segments: DataFrame) -> DataFrame:
    """(book, block, number, read, fixed, text, pages, start_page, start_seq, flags): the notes of blocks that a title opens.

    segments: book, page, seq, kind, text, flags, cut (true where another part begins). A block runs to a cut, a heading or the
    next title, and has no notes if something else follows its title. Other rows go on with the note before them. Notes are
    numbered from 1; `fixed` says that another number was read.
    """
    order = Window.partitionBy("book").orderBy("page", "seq")
    titled = F.col("text").rlike(BLOCK_TITLE) | (text.letters_key(F.col("text")) == "chuthich")
    opens = F.col("text").rlike(NOTE_OPENS)
    numbered = segments.withColumn("_title", titled).withColumn("block", F.sum(titled.cast("int")).over(order)).where("block > 0")
    inside = Window.partitionBy("book", "block").orderBy("page", "seq")
    rows = numbered.withColumn("number", F.sum((opens & ~F.col("_title")).cast("int")).over(inside))
    ends = ~F.col("_title") & (F.coalesce("cut", F.lit(False)) | (F.col("kind") == "heading") | (F.col("number") == 0))
    held = rows.withColumn("_ended", F.max(ends.cast("int")).over(inside)).where("not _title and _ended = 0")
    said = F.when(opens, F.btrim(F.regexp_replace("text", NOTE_OPENS, ""))).otherwise(F.btrim("text"))
    read = F.regexp_extract("text", NOTE_OPENS, 1)
    marked = held.withColumn("_said", said).withColumn("_read", F.when(opens, read)).withColumn("_at", F.struct("page", "seq"))
    out = marked.groupBy("book", "block", "number").agg(
        F.min_by("_read", "_at").alias("read"),
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("page", "seq", "_said"))), lambda x: x["_said"]), " ").alias("text"),
        F.array_sort(F.collect_set("page")).alias("pages"),
        F.min("_at").alias("_first"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_list(F.coalesce("flags", F.array().cast("array<string>")))))).alias("flags"),
    )
    repaired = F.translate("read", MISREAD_ONES, "1" * len(MISREAD_ONES))
    fixed = ~repaired.try_cast("int").eqNullSafe(F.col("number").cast("int"))
    return out.select("book", "block", "number", "read", fixed.alias("fixed"), "text", "pages", F.col("_first.page").alias("start_page"), F.col("_first.seq").alias("start_seq"), "flags")
