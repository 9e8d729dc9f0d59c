"""The log of human corrections: replay over a new draft, edits by version, and the gates before publication."""

from __future__ import annotations

import re
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import text
from .blocks import BEFORE_HEADINGS, flagged_sections, sections, with_sections
from .notes import audit, definitions
from .spelling import fold_line, title_fold

#: Reasons of a log's entries that respelled words (fixed phrases of the log).
RESPELLED = ("names as the OCR prints them", "Spelling Rule:")
CORRECTION = "book string, ord long, action string, section string, pdf_pages array<int>, before array<string>, after array<string>"


HEADING = re.compile(r"#{1,6}\s+(.*)", re.DOTALL)


def _title(heading: str) -> str | None:
    """The section title that a block gives, None if it is no heading."""
    found = HEADING.match(heading)
    if found is None:
        return None
    return re.sub(r"\s*\n#*\s*", " ", re.sub(r"\[\^[^\]\s]+\]:?", "", found[1])).strip()


class Draft:
    """The blocks of a book as a chain, with the places of each text, so that a correction costs its own blocks only.

    Place 0 stands before the first block; `following` of the last one is 0.
    """

    def __init__(self, blocks: list[str]):
        self.text = dict(enumerate(blocks, 1))
        n = len(blocks)
        self.following = {k: k + 1 for k in range(n)} | {n: 0}
        self.preceding = {k: k - 1 for k in range(1, n + 1)}
        self.preceding[0] = n
        self.places: dict[str, set[int]] = {}
        for k, t in self.text.items():
            self.places.setdefault(t, set()).add(k)
        self.fresh = n + 1

    def run(self, place: int, n: int) -> list[int]:
        """Up to n places from one on."""
        out = []
        while place and len(out) < n:
            out.append(place)
            place = self.following[place]
        return out

    def section(self, place: int) -> str:
        while place:
            if (title := _title(self.text[place])) is not None:
                return title
            place = self.preceding[place]
        return BEFORE_HEADINGS

    def find(self, wanted: list[str], section: str) -> list[int]:
        """The places of a run of blocks: the only one in its section, else the only one in the book, else none."""
        runs = [self.run(k, len(wanted)) for k in self.places.get(wanted[0], ())] if wanted else []
        runs = [r for r in runs if [self.text[k] for k in r] == wanted]
        own = [r for r in runs if self.section(r[0]) == section]
        return own[0] if len(own) == 1 else runs[0] if len(runs) == 1 else []

    def put(self, places: list[int], blocks: list[str]) -> None:
        """Other blocks in the place of some that stand in a row."""
        left, right = self.preceding[places[0]], self.following[places[-1]]
        for k in places:
            self.places[self.text.pop(k)].discard(k)
        for t in blocks:
            k, self.fresh = self.fresh, self.fresh + 1
            self.text[k] = t
            self.places.setdefault(t, set()).add(k)
            self.following[left], self.preceding[k] = k, left
            left = k
        self.following[left], self.preceding[right] = right, left

    def blocks(self) -> list[str]:
        return [self.text[k] for k in self.run(self.following[0], len(self.text))]


def replay_one(blocks: list[str], log: list[dict]) -> tuple[list[str], list[int], list[int]]:
    """(blocks, applied, missed): corrections in order, each where its blocks stand once in its section, or once at all."""
    draft, outcome = Draft(blocks), {True: [], False: []}
    for c in log:
        before, after = list(c["before"]), list(c["after"])
        if c["action"] == "spelling" or before == after:
            continue
        places = draft.find(before, c["section"])
        if places:
            draft.put(places, after)
        outcome[bool(places)].append(c["ord"])
    return draft.blocks(), outcome[True], outcome[False]


def replay(blocks: DataFrame, log: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(blocks, outcomes): a book's log over its blocks, a book a row; outcomes say which corrections were applied.

    A book is the scope of its log: later corrections see what earlier ones made. Only books with a log are gathered.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for book in batch.to_pylist():
                lines, log_of = [b["text"] for b in book["blocks"]], [c["entry"] for c in book["log"]]
                new, applied, missed = replay_one(lines, log_of)
                rows = [("block", i, t, None) for i, t in enumerate(new)]
                rows += [("outcome", o, None, flag) for flag, some in ((True, applied), (False, missed)) for o in some]
                columns = [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), (pa.string(), pa.int64(), pa.string(), pa.bool_()), strict=True)] if rows else None
                if columns:
                    yield pa.RecordBatch.from_arrays([pa.array([book["book"]] * len(rows), pa.string()), *columns], ["book", "what", "i", "text", "applied"])

    # new names for the columns: both sides may come from one table
    fresh = lambda df, *names: df.select(*[F.col(c).alias(c) for c in names])
    whole, corrected = fresh(blocks, "book", "idx", "text"), fresh(log, "book", "ord", "action", "section", "before", "after")
    logged = corrected.select("book").distinct()
    # a book without corrections only has its blocks numbered anew
    plain = whole.join(logged, "book", "left_anti").select("book", (F.row_number().over(Window.partitionBy("book").orderBy(F.asc_nulls_last("idx"))) - 1).cast("long").alias("idx"), "text")
    listed = lambda df, order, value, name: df.groupBy("book").agg(F.array_sort(F.collect_list(F.struct(order, value))).alias(name))
    per_log = listed(corrected, F.col("ord").alias("at"), F.struct("ord", "action", "section", "before", "after").alias("entry"), "log")
    per_book = listed(whole.join(logged, "book", "left_semi"), F.col("idx").alias("at"), F.col("text"), "blocks")
    none = F.expr("cast(array() as array<struct<at: bigint, text: string>>)")
    both = per_log.join(per_book, "book", "left").select(F.col("book").cast("string").alias("book"), F.coalesce("blocks", none).alias("blocks"), "log")
    out = both.mapInArrow(run, "book string, what string, i long, text string, applied boolean")
    return (
        plain.select(F.col("book").cast("string").alias("book"), "idx", "text").unionByName(out.where("what = 'block'").select("book", F.col("i").alias("idx"), "text")),
        out.where("what = 'outcome'").select("book", F.col("i").alias("ord"), "applied"),
    )


def edit(blocks: DataFrame, commands: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(blocks, refused): single-block commands (book, idx, version, text) applied where the version still fits.

    A null text deletes the block. The version is that of the block as its editor saw it.
    """
    met = blocks.join(commands.select("book", "idx", "version", F.col("text").alias("_new"), F.lit(True).alias("_asked")), ["book", "idx"], "left")
    fits = F.coalesce(F.col("version") == text.content_version(F.col("text")), F.lit(False))
    kept = met.where(~(F.coalesce("_asked", F.lit(False)) & fits & F.col("_new").isNull()))
    done = kept.select("book", "idx", F.when(fits & F.col("_asked"), F.col("_new")).otherwise(F.col("text")).alias("text"))
    held = blocks.select("book", "idx", text.content_version(F.col("text")).alias("version"))
    return done, commands.join(held, ["book", "idx", "version"], "left_anti")


def joined_blocks(a: Column, b: Column) -> Column:
    """Two blocks as one paragraph: a word that is broken at the end of the first goes on in the second; a mark on either stays."""
    flag = r"\s*⚠$"
    left, right = F.regexp_replace(a, flag, ""), F.regexp_replace(F.regexp_replace(b, flag, ""), r"^\\", "")
    broken = left.rlike(r"\p{L}-$") & right.rlike(r"^\p{Ll}")
    whole = F.when(broken, F.concat(left, right)).otherwise(F.concat(left, F.lit(" "), right))
    return F.when(a.endswith("⚠") | b.endswith("⚠"), F.concat(whole, F.lit(" ⚠"))).otherwise(whole)


def edit_blocks(blocks: DataFrame, commands: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(blocks, refused, log) after commands (book, idx, version, action, text), one a block, each as its editor saw it.

    edit puts the blocks of a text in the place of one, none of a blank text; merge joins a block with the one behind it.
    refused: commands with a problem. log: book, idx, action, before, after of what has changed. Blocks are numbered anew.
    """
    w = Window.partitionBy("book").orderBy("idx")
    asked = commands.select("book", "idx", "version", "action", F.col("text").alias("_new"))
    met = blocks.join(asked, ["book", "idx"], "left").withColumn("_next", F.lead("text").over(w)).withColumn("_next_asked", F.lead("action").over(w))
    merge = F.col("action") == "merge"
    problem = (
        F.when(F.col("action").isNull(), None)
        .when(F.col("version") != text.content_version(F.col("text")), "the block has changed")
        .when(~F.col("action").isin("edit", "merge"), "unknown action")
        .when(merge & F.col("_next").isNull(), "no block after this one")
        .when(merge & F.col("_next_asked").isNotNull(), "the block after this one is asked for as well")
    )
    judged = met.withColumn("problem", problem)
    good = F.col("action").isNotNull() & F.col("problem").isNull()
    parts = F.filter(F.transform(F.split(F.replace("_new", F.lit("\r"), F.lit("")), "\n{2,}"), lambda x: F.btrim(x, F.lit("\n"))), lambda x: F.btrim(x) != "")
    after = F.when(good & merge, F.array(joined_blocks(F.col("text"), F.col("_next")))).when(good, F.coalesce(parts, F.array().cast("array<string>")))
    changed = judged.withColumn("after", after).withColumn("_merged", good & merge)
    changed = changed.withColumn("_swallowed", F.coalesce(F.lag("_merged").over(w), F.lit(False)))
    left = changed.where(~F.col("_swallowed"))
    every = left.select("book", "idx", F.posexplode(F.coalesce("after", F.array("text"))).alias("_k", "text"))
    done = every.select("book", (F.row_number().over(Window.partitionBy("book").orderBy("idx", "_k")) - 1).alias("idx"), "text")
    before = F.when(merge, F.array("text", "_next")).otherwise(F.array("text"))
    action = F.when(F.size("after") == 0, "delete").otherwise(F.col("action"))
    log = left.where(F.col("after").isNotNull()).select("book", "idx", action.alias("action"), before.alias("before"), "after").where("before <> after")
    unknown = asked.join(blocks.select("book", "idx"), ["book", "idx"], "left_anti").withColumn("problem", F.lit("no such block"))
    columns = ["book", "idx", "version", "action", F.col("_new").alias("text"), "problem"]
    return done, judged.where("problem is not null").select(*columns).unionByName(unknown.select(*columns)), log


def final_toc(blocks: DataFrame, draft: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(entries, unknown): sections under the title with the draft's id and printed page, by first PDF page."""
    below = sections(blocks).where("level > 1")
    met = below.join(draft.select("book", F.col("pdf_start").alias("pdf_a"), "id", "printed_page"), ["book", "pdf_a"], "left")
    story = text.section_story(F.col("title"))
    entries = met.where("id is not null").select("book", "k", "id", story["number"].alias("number"), story["name"].alias("title"), story["subtitle"].alias("subtitle"), (F.col("level") - 1).alias("level"), "printed_page", F.col("pdf_a").alias("pdf_start"), F.col("pdf_b").alias("pdf_end"))
    return entries, met.where("id is null").select("book", "k", "title")


def toc_root(entries: DataFrame) -> DataFrame:
    return entries.groupBy("book").agg(F.min("pdf_start").alias("pdf_start"), F.max("pdf_end").alias("pdf_end"))


def final_notes(blocks: DataFrame, entries: DataFrame) -> DataFrame:
    """Note definitions with their story's id and whether anything calls them."""
    called = audit(blocks).groupBy("book", "note_id").agg((F.sum("n_called") > 0).alias("called"))
    scope = entries.select("book", "k", F.col("id").alias("scope"))
    return definitions(blocks).join(scope, ["book", "k"], "left").join(called, ["book", "note_id"], "left").select("book", F.col("note_id").alias("id"), "scope", "page", "marker", "text", "called")


def finalize_violations(blocks: DataFrame, draft: DataFrame, passes: DataFrame) -> DataFrame:
    """(book, problem): all that keeps books from being final.

    passes: book, pass_id, known (the id of a pass that was finalized or replayed; null where none was).
    """
    marks = flagged_sections(blocks).select("book", F.concat_ws(" ", F.col("flags").cast("string"), F.lit("marks left in"), "title").alias("problem"))
    unread = passes.where("not (pass_id <=> known)").select("book", F.lit("made from another pass whose corrections were not replayed").alias("problem"))
    _, unknown = final_toc(blocks, draft)
    lost = unknown.select("book", F.concat(F.lit("no story of the draft starts on the first page of "), "title").alias("problem"))
    return marks.unionByName(unread).unionByName(lost)


def replay_violations(books: DataFrame) -> DataFrame:
    """(book, problem) for a replay. books: book, has_final, pass_id, replayed_id, n_corrections."""
    b = F.col
    problem = (
        F.when(~b("has_final"), "no final book yet, nothing to replay")
        .when(b("pass_id").isNull(), "the pass has no log")
        .when(b("pass_id") == b("replayed_id"), "replayed on this pass already")
        .when(b("n_corrections") > 0, "the draft has corrections already")
    )
    return books.select("book", problem.alias("problem")).where("problem is not null")


def changed_headings(before: DataFrame, after: DataFrame) -> DataFrame:
    """(book, pdf, title): headings that differ, for books whose sections pair by number and level."""
    a, b = sections(before), sections(after)
    pairs = a.select("book", "k", "level", F.col("title").alias("_old")).join(b.select("book", "k", F.col("level").alias("_level"), "title", "pdf_a"), ["book", "k"], "full")
    broken = pairs.where("not (level <=> _level)").select("book").distinct()
    return pairs.join(broken, "book", "left_anti").where("_old <> title and pdf_a is not null").select("book", F.col("pdf_a").alias("pdf"), "title")


def before_rules(blocks: DataFrame, log: DataFrame) -> DataFrame:
    """(book, idx, text): a model's draft with the changes of its spelling rules taken back.

    log: book, ord, section, before, after (arrays), reason, rule. Entries of a rule, or with a reason
    that says so, count if they have one block before and after. In order of the log, each takes the first block still
    free that has the words of what it made, one of its own section before others. Blocks of other words don't
    matter to it, so the words of a block are the group.
    """
    single = (F.size("before") == 1) & (F.size("after") == 1)
    said = F.lit(False)
    for phrase in RESPELLED:
        said = said | F.contains(F.coalesce("reason", F.lit("")), F.lit(phrase))
    ruled = log.where(single & ((F.size("rule") > 0) | said))
    entries = ruled.select(
        "book", fold_line(F.col("after")[0]).alias("key"), "ord", title_fold(F.col("section")).alias("section"), F.col("before")[0].alias("before")
    )
    titles = sections(blocks).select("book", "k", title_fold(F.col("title")).alias("section"))
    placed = with_sections(blocks).join(titles, ["book", "k"], "left")
    keyed = placed.select("book", fold_line(F.col("text")).alias("key"), "idx", F.coalesce("section", F.lit("")).alias("section"))

    def run(key, b: pd.DataFrame, e: pd.DataFrame) -> pd.DataFrame:
        free = list(b.sort_values("idx")[["section", "idx"]].itertuples(index=False, name=None))
        out = []
        for section, before in e.sort_values("ord")[["section", "before"]].itertuples(index=False, name=None):
            if free:
                taken = min(free, key=lambda f: (f[0] != section, f[1]))
                free.remove(taken)
                out.append((key[0], taken[1], before))
        return pd.DataFrame(out, columns=["book", "idx", "before"])

    undone = keyed.groupBy("book", "key").cogroup(entries.groupBy("book", "key")).applyInPandas(run, "book string, idx long, before string")
    return blocks.join(undone, ["book", "idx"], "left").select("book", "idx", F.coalesce("before", "text").alias("text"))
