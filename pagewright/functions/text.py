"""Text functions as Column expressions: they stay in the JVM and push down with the plan.

Folds go through translate tables that a rule builds from the Unicode database, so the same strings
serve Spark and any SQL engine.
"""

from __future__ import annotations

import unicodedata

from pyspark.sql import Column
from pyspark.sql import functions as F


def _latin() -> list[str]:
    """Letters of the Latin blocks with marks, in both cases."""
    blocks = [range(0x00C0, 0x0250), range(0x1E00, 0x1F00)]
    return [chr(c) for block in blocks for c in block if chr(c).isalpha()]


def _base_table() -> tuple[str, str]:
    """Marked letters and their base letters; đ counts as d. Letters without a one-letter base stay."""
    source, target = [], []
    for c in _latin():
        base = {"đ": "d", "Đ": "D"}.get(c) or unicodedata.normalize("NFD", c)[0]
        if base != c and base.isascii():
            source.append(c)
            target.append(base)
    return "".join(source), "".join(target)


#: Combining marks of the five tones: grave, acute, tilde, hook above, dot below (fixed values).
TONES = "̣̀́̃̉"


def _tone_table() -> tuple[str, str]:
    """Letters with a tone and the same letters without it; other marks stay."""
    source, target = [], []
    for c in _latin():
        bare = unicodedata.normalize("NFC", "".join(m for m in unicodedata.normalize("NFD", c) if m not in TONES))
        if bare != c and len(bare) == 1:
            source.append(c)
            target.append(bare)
    return "".join(source), "".join(target)


MARKED, BASE = _base_table()
TONED, TONELESS = _tone_table()

#: The shape of a Vietnamese syllable without its tone (fixed pattern of the orthography).
SYLLABLE = (
    "^(ngh|ng|gh|gi|kh|nh|ph|qu|th|tr|ch|[bcdđghklmnprstvx])?"
    "[aăâeêioôơuưy]{1,3}"
    "(ch|nh|ng|[cmnpt])?$"
)
#: Two syllables that the shape leaves out (fixed values).
SYLLABLES = ("gi", "gin")


#: What the website's Markdown leaves out, how notes are called by number and pages referred to (fixed patterns of those formats).
UNSUPPORTED_INLINE = r"[*_`|\\]|<[A-Za-z/!]|\]\("
UNSUPPORTED_LINE = r"(?m)^(?:[+] |\d+[.)] |-{3,}\s*$)"
NUMBER_CALLED = r"(?<=\S)\((\d{1,2})\)"
PAGE_REFERRED = r"\[tr\.\s*(\d+)\]"


def without_marks(c: Column) -> Column:
    """Base letters; case stays."""
    return F.translate(c, MARKED, BASE)


def casefolded(c: Column) -> Column:
    return F.replace(F.lower(c), F.lit("ß"), F.lit("ss"))


def letters_key(c: Column) -> Column:
    """a-z only: identity of a page header."""
    return F.regexp_replace(without_marks(casefolded(c)), "[^a-z]", "")


def alnum_key(c: Column) -> Column:
    """a-z and 0-9 only: comparison of titles."""
    return F.regexp_replace(without_marks(casefolded(c)), "[^a-z0-9]", "")


def compare_key(c: Column) -> Column:
    """Case and marks aside, single spaces."""
    return collapsed(without_marks(casefolded(c)))


def word_key(c: Column) -> Column:
    """Lower-case letters and digits without marks; ß stays."""
    return F.regexp_replace(without_marks(F.lower(c)), r"[^\p{L}\p{N}]", "")


def bare_letters(c: Column) -> Column:
    """Lower-case letters and digits, marks kept."""
    return F.regexp_replace(F.lower(c), r"[^\p{L}\p{N}]", "")


def toneless(c: Column) -> Column:
    return F.translate(c, TONED, TONELESS)


def is_syllable(word: Column) -> Column:
    bare = toneless(casefolded(word))
    return bare.rlike(SYLLABLE) | bare.isin(*SYLLABLES)


def slug(c: Column) -> Column:
    return F.btrim(F.regexp_replace(F.lower(without_marks(c)), "[^a-z0-9]+", "-"), F.lit("-"))


def collapsed(c: Column) -> Column:
    """Single spaces, none at the ends."""
    return F.btrim(F.regexp_replace(c, r"[\s ]+", " "))


def words(c: Column) -> Column:
    """Words between white space; none of a blank text."""
    return F.filter(F.split(collapsed(c), " "), lambda w: w != "")


def letter_words(c: Column) -> Column:
    """Runs of letters."""
    return F.regexp_extract_all(c, F.lit(r"\p{L}+"), 0)


def spaced_words(c: Column) -> Column:
    """Runs of letters with a blank between them."""
    return F.regexp_replace(c, r"\P{L}+", " ")


def letter_share(c: Column) -> Column:
    """Letters by characters other than spaces; 0 of none."""
    spaceless = F.replace(c, F.lit(" "), F.lit(""))
    letters = F.length(F.regexp_replace(spaceless, r"[^\p{L}]", ""))
    return F.when(F.length(spaceless) > 0, letters / F.length(spaceless)).otherwise(F.lit(0.0))


def caps_share(c: Column) -> Column:
    letters = F.regexp_replace(c, r"[^\p{L}]", "")
    upper = F.length(F.regexp_replace(letters, r"[^\p{Lu}]", ""))
    return F.when(F.length(letters) > 0, upper / F.length(letters)).otherwise(F.lit(0.0))


def is_noise(c: Column) -> Column:
    """No word of three letters, and under seven tenths letters and digits."""
    spaceless = F.replace(c, F.lit(" "), F.lit(""))
    alnum = F.length(F.regexp_replace(spaceless, r"[^\p{L}\p{N}]", ""))
    share = F.when(F.length(spaceless) > 0, alnum / F.length(spaceless)).otherwise(F.lit(0.0))
    return ~c.rlike(r"\p{L}{3}") & (share < 0.7)


def page_id(n: Column) -> Column:
    return F.format_string("p%04d", n)


def page_number(identifier: Column) -> Column:
    return F.substring(identifier, 2, 10).cast("int")


def page_label(first: Column, last: Column) -> Column:
    return F.when(first == last, first.cast("string")).otherwise(F.concat_ws("-", first.cast("string"), last.cast("string")))


def shortened(c: Column, n: int = 80) -> Column:
    line = F.replace(c, F.lit("\n"), F.lit(" "))
    return F.when(F.length(line) <= n, line).otherwise(F.concat(F.left(line, F.lit(n)), F.lit("…")))


def digits_repaired(c: Column) -> Column:
    """Letters that OCR reads for 1 and 0 in numbers."""
    return F.translate(c, "lI|!Oo", "111100")


def heading_level(block: Column) -> Column:
    return F.length(F.regexp_extract(block, r"^(#{1,6})\s", 1))


def block_kind(block: Column) -> Column:
    """heading, comment, note, break or text, the first that fits."""
    return (
        F.when(block.rlike(r"^#{1,6}\s"), "heading")
        .when(block.startswith("<!--"), "comment")
        .when(block.rlike(r"^\[\^[^\]\s]+\]:"), "note")
        .when(collapsed(block) == "* * *", "break")
        .otherwise("text")
    )


def website_dialect(block: Column, closing: Column | None = None) -> Column:
    """Plain dialogue dashes; a block of hard breaks becomes verse lines, or right-aligned lines where it closes a preface."""
    dashed = F.regexp_replace(block, r"(?m)^\\-", "-")
    mark = F.lit("> ") if closing is None else F.when(closing, "-> ").otherwise("> ")
    lines = F.transform(F.split(dashed, "\n"), lambda x: F.concat(mark, F.rtrim(x)))
    return F.when(dashed.rlike(r" {2,}\n"), F.array_join(lines, "\n")).otherwise(dashed)


def unsupported_markdown(block: Column) -> Column:
    """What the website would show wrongly: other headings than level 3, emphasis, code, links, tables, lists, rules."""
    inline = block.rlike(UNSUPPORTED_INLINE) | block.rlike(UNSUPPORTED_LINE)
    return F.when(heading_level(block) > 0, heading_level(block) != 3).otherwise(inline)


def note_calls(c: Column) -> Column:
    """Ids of [^id] calls, definitions aside."""
    return F.regexp_extract_all(c, F.lit(r"\[\^([^\]\s]+)\](?!:)"), 1)


def numbers_called(c: Column) -> Column:
    """(n) right after text, as numbers."""
    return F.transform(F.regexp_extract_all(c, F.lit(NUMBER_CALLED), 1), lambda x: x.cast("int"))


def pages_referred(c: Column) -> Column:
    """[tr. n] references, as numbers."""
    return F.transform(F.regexp_extract_all(c, F.lit(PAGE_REFERRED), 1), lambda x: x.cast("int"))


def escaped_line(line: Column) -> Column:
    """A line of text that Markdown would take for something else."""
    marked = F.regexp_replace(line, r"^(\s*)([#>+\-*](?=\s)|\d+[.)](?=\s))", r"$1\\$2")
    return F.regexp_replace(marked, r"<(?=[A-Za-z/!])", "&lt;")


def table_row(cells: Column, width: Column) -> Column:
    """Cells as one line of a pipe table, padded to `width`."""
    escaped = F.transform(cells, lambda x: F.replace(x, F.lit("|"), F.lit(r"\|")))
    padded = F.concat(escaped, F.array_repeat(F.lit(""), F.greatest(width - F.size(cells), F.lit(0)).cast("int")))
    return F.concat(F.lit("| "), F.array_join(padded, " | "), F.lit(" |"))


def section_story(title: Column) -> Column:
    """number, name and subtitle of a heading such as `3. Name (subtitle)`."""
    pattern = r"(?s)^(?:(\d+)\.\s+)?(.*?)(?:\s*\(([^()]*)\))?$"
    part = lambda k: F.regexp_extract(title, pattern, k)
    blank = lambda c: F.when(c != "", c)
    return F.struct(blank(part(1)).cast("int").alias("number"), part(2).alias("name"), blank(part(3)).alias("subtitle"))


def heading_read(comment: Column) -> Column:
    """The model's own reading of a heading in a page comment, null where there is none."""
    found = F.regexp_extract(comment, r"heading:\s*(.*?)\s*-->", 1)
    return F.when(comment.startswith("<!--") & (found != ""), found)


def content_version(c: Column) -> Column:
    """The first twelve digits of a text's sha1: what an edit must name to be applied."""
    return F.substring(F.sha1(c.cast("binary")), 1, 12)


def roman_value(c: Column) -> Column:
    """The number of a Roman numeral; l and 1 count as I. Null for anything else."""
    plain = F.translate(F.upper(c), "1L|", "III")
    value = lambda x: F.when(x == "I", 1).when(x == "V", 5).when(x == "X", 10).otherwise(0)
    digits = F.reverse(F.transform(F.split(plain, ""), value))
    fold = F.aggregate(
        digits,
        F.struct(F.lit(0).alias("sum"), F.lit(0).alias("most")),
        lambda s, d: F.struct((s["sum"] + F.when(d < s["most"], -d).otherwise(d)).alias("sum"), F.greatest(s["most"], d).alias("most")),
        lambda s: s["sum"],
    )
    return F.when(plain.rlike("^[IVX]+$"), fold)


def without_noise(c: Column) -> Column:
    """A row without the specks that OCR reads before its first word.

    Those are words without a letter or digit, single letters that aren't capitals, and a single capital before the
    number of an item; the last word of a row goes only if it has neither letter nor digit.
    """
    speck = r"[^\p{L}\p{N}\s]+(?:\s+|$)|(?!\p{Lu})\p{L}\s+(?=\S)|\p{Lu}\s+(?=\d{1,3}[.,:)])"
    return F.regexp_replace(collapsed(c), f"^(?:{speck})+", "")
