"""Language identification by rank-order profiles of character n-grams.

A profile is the list of a language's most frequent n-grams (1 to 3 characters, words padded with a
blank) in order. A text is ranked the same way and goes to the language whose profile is nearest by
out-of-place distance: the sum over the text's n-grams of how far each stands from its place in the
profile, with the profile's length for an n-gram that isn't there. N-grams of one frequency stand by length and characters.

Learning counts words per language over all training rows (counts combine before the shuffle), then
n-grams of the different words. A profile has `PROFILE` entries a language, so the learned model is
bounded by the number of languages. Prediction reads whole texts and nothing else.

Defined cases: a null text, or one without a letter, is `und` with score 0; with no training rows
every text is `und`; rows without lang or with a null text teach nothing; ties go to the language
first in the alphabet; repeated rows are separate rows; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import small_batches, text_or_empty, worker_broadcast

PROFILE = 400
GRAMS = (1, 2, 3)
#: Rows with this remainder of crc32(doc_id) by FOLDS are held out.
FOLDS, HELD_OUT = 4, 2
UNKNOWN = "und"
#: Characters hashed at once.
SLICE = 1 << 20


def held_out(doc_id):
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % FOLDS == HELD_OUT, F.lit(False))


def profiles(documents: DataFrame, size: int = PROFILE) -> DataFrame:
    """(lang, gram, rank): the most frequent n-grams of each language over the training rows, rank from 0."""
    rows = documents.where(F.col("lang").isNotNull() & F.col("text").isNotNull() & ~held_out(F.col("doc_id")))
    plain = F.lower(F.regexp_replace("text", r"[^\p{L}]+", " "))
    words = (
        rows.select("lang", F.explode(F.split(plain, " ")).alias("word"))
        .where("word <> ''")
        .groupBy("lang", "word")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    # all n-grams of a word between blanks
    cut = ", ".join(f"transform(sequence(1, length(w) - {g - 1}), i -> substring(w, i, {g}))" for g in GRAMS)
    grams = words.withColumn("w", F.concat(F.lit(" "), F.col("word"), F.lit(" "))).select(
        "lang", "n", F.explode(F.expr(f"flatten(array({cut}))")).alias("gram")
    )
    counted = grams.where("gram <> ' '").groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    order = Window.partitionBy("lang").orderBy(F.col("n").desc(), F.length("gram"), "gram")
    # the limit stands on the row number itself, so each task keeps its first ones before they meet
    first = counted.withColumn("_place", F.row_number().over(order)).where(F.col("_place") <= size)
    return first.select("lang", "gram", (F.col("_place") - 1).alias("rank"))


def _code(gram: str) -> int:
    """An n-gram as one number: 21 bits a character, the first one highest."""
    out = 0
    for c in gram:
        out = out << 21 | ord(c)
    return out


class Model:
    """Ranks of every profile n-gram in every language; PROFILE where it isn't there."""

    def __init__(self, rows: list[tuple[str, str, int]], size: int = PROFILE):
        self.size = size
        self.languages = sorted({r[0] for r in rows})
        self.codes = np.array(sorted({_code(r[1]) for r in rows}), np.int64)
        self.ranks = np.full((len(self.codes), max(1, len(self.languages))), size, np.int32)
        for lang, gram, rank in rows:
            self.ranks[np.searchsorted(self.codes, _code(gram)), self.languages.index(lang)] = rank

    def distances(self, codes: np.ndarray) -> tuple[np.ndarray, int]:
        """Out-of-place distance of a text's ranked n-grams to each language, and the largest there can be."""
        if not len(self.codes) or not len(codes):
            return np.zeros(len(self.languages)), 0
        at = np.minimum(np.searchsorted(self.codes, codes), len(self.codes) - 1)
        known = self.codes[at] == codes
        place = np.arange(len(codes))[:, None]
        apart = np.where(known[:, None] & (self.ranks[at] < self.size), np.abs(self.ranks[at] - place), self.size)
        return apart.sum(axis=0), self.size * len(codes)


def _folded(text: str) -> np.ndarray:
    """Lower-case letters as code points, with one blank for each run of anything else and at both ends."""
    lower = text.lower()
    points = np.frombuffer(lower.encode("utf-32-le", "surrogatepass"), np.int32)
    letters = _is_letter(points)
    points = np.where(letters, points, 32)
    points = np.concatenate([[32], points, [32]]).astype(np.int64)
    blank = points == 32
    return points[~(blank & np.r_[False, blank[:-1]])]


_letters = np.zeros(0x110000, np.int8)


def _is_letter(points: np.ndarray) -> np.ndarray:
    """Whether each code point is a letter; looked up once per code point and worker."""
    seen = _letters[points]
    if (seen == 0).any():
        for p in np.unique(points[seen == 0]).tolist():
            _letters[p] = 1 if chr(p).isalpha() else 2
        seen = _letters[points]
    return seen == 1


def ranked(text: str, size: int = PROFILE) -> np.ndarray:
    """The codes of a text's most frequent n-grams, in order; ties in order of the code."""
    points = _folded(text)
    if len(points) < 3:
        return np.empty(0, np.int64)
    whole_codes, whole_counts = np.empty(0, np.int64), np.empty(0, np.int64)
    for k in range(0, len(points), SLICE):
        p = points[k : k + SLICE + 2]
        last = k + SLICE >= len(points)
        one = p[: len(p) if last else SLICE]
        two = (p[:-1] << 21 | p[1:])[: None if last else SLICE]
        three = (p[:-2] << 42 | p[1:-1] << 21 | p[2:])[: None if last else SLICE]
        # an n-gram with a blank inside would span two words; padding blanks stand at its ends
        three = three[(p[1:-1] != 32)[: len(three)]]
        found, n = np.unique(np.concatenate([one[one != 32], two, three]), return_counts=True)
        if not len(whole_codes):
            whole_codes, whole_counts = found, n
        else:
            whole_codes, where = np.unique(np.concatenate([whole_codes, found]), return_inverse=True)
            whole_counts = np.bincount(where, np.concatenate([whole_counts, n])).astype(np.int64)
    order = np.lexsort((whole_codes, -whole_counts))[:size]
    return whole_codes[order]


def _predict(model):
    def mapped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m: Model = model.value
        for batch in batches:
            found, scores = [], []
            for text in batch["text"].to_pylist():
                codes = ranked(text) if m.languages else np.empty(0, np.int64)
                if not len(codes):
                    found.append(UNKNOWN)
                    scores.append(0.0)
                    continue
                apart, most = m.distances(codes)
                best = int(apart.argmin())
                found.append(m.languages[best])
                scores.append(float(1 - apart[best] / most))
            yield pa.RecordBatch.from_arrays(
                [batch["doc_id"], batch["held_out"], pa.array(found, pa.string()), pa.array(scores, pa.float64())],
                ["doc_id", "held_out", "lang_pred", "score"],
            )

    return mapped


def identify(documents: DataFrame) -> DataFrame:
    """doc_id, held_out, lang_pred, score of each row."""
    spark = documents.sparkSession
    small_batches(spark)
    learned = profiles(documents).toArrow()
    model = Model(list(zip(*[learned[c].to_pylist() for c in ("lang", "gram", "rank")], strict=True)))
    rows = documents.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), text_or_empty(documents).alias("text"))
    return rows.mapInArrow(_predict(worker_broadcast(spark, model)), "doc_id long, held_out boolean, lang_pred string, score double")
