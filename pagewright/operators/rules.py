"""A book's spelling rules as a table that commands change: new rules, respelt ones, exceptions, and pairs left to the reader.

rules: book, kind (word or phrase), ord, spelling, except (titles of stories). depends: book, spellings (of one fold).
Every command is a row; what can't be done comes back with the reason, and the rest takes effect at once for all books.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import similarity
from .spelling import fold_line, title_fold


def _keyed(rules: DataFrame) -> DataFrame:
    return rules.withColumn("_key", fold_line(F.col("spelling")))


def _size(key: Column) -> Column:
    return F.when(key == "", 0).otherwise(F.size(F.split(key, " ")))


def rule_problems(commands: DataFrame, common: DataFrame) -> DataFrame:
    """commands for new rules (book, kind, fold, spelling) with `problem`, null where there is none.

    common: (book, fold) of words that stand in lower case somewhere; they can't have a word rule.
    """
    key = fold_line(F.col("spelling"))
    known = common.select("book", "fold").distinct().withColumn("_common", F.lit(True))
    problem = (
        F.when(key == "", "no spelling")
        .when(~F.array_contains(F.split(key, " "), F.col("fold")), "not a spelling of the word")
        .when(~F.col("kind").isin("word", "phrase"), "unknown kind of rule")
        .when((F.col("kind") == "word") & (_size(key) != 1), "a word rule has one word")
        .when((F.col("kind") == "word") & F.col("_common"), "a common word: only a phrase rule can have it")
        .when((F.col("kind") == "phrase") & (_size(key) < 2), "a phrase rule has two words or more")
    )
    return commands.join(known, ["book", "fold"], "left").withColumn("problem", problem).drop("_common")


def with_rules(rules: DataFrame, depends: DataFrame, commands: DataFrame, common: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(rules, depends, refused) after new rules (book, ord, kind, fold, spelling).

    A new rule takes the place of those of its kind with the same folds, the last command for them counting, and
    ends what was said of its word in depends.
    """
    judged = rule_problems(commands.withColumn("spelling", similarity.nfc(F.btrim("spelling"))), common)
    good = _keyed(judged.where("problem is null"))
    latest = Window.partitionBy("book", "kind", "_key").orderBy(F.col("ord").desc())
    new = good.withColumn("_n", F.row_number().over(latest)).where("_n = 1")
    behind = rules.groupBy("book").agg(F.max("ord").alias("_last"))
    placed = new.join(behind, "book", "left").withColumn("ord", F.coalesce("_last", F.lit(-1)) + 1 + F.col("ord"))
    held = _keyed(rules).join(new.select("book", "kind", "_key"), ["book", "kind", "_key"], "left_anti")
    columns = ["book", "kind", "ord", "spelling", "except"]
    added = placed.withColumn("except", F.array().cast("array<string>")).select(*columns)
    settled = good.select("book", F.col("fold").alias("_fold")).distinct()
    pairs = depends.withColumn("_fold", fold_line(F.col("spellings")[0]))
    return held.select(*columns).unionByName(added), pairs.join(settled, ["book", "_fold"], "left_anti").select(*depends.columns), judged.where("problem is not null")


def changed_rules(rules: DataFrame, commands: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(rules, refused) after commands (book, kind, old, spelling): a rule respelt in its marks, or deleted where spelling is null."""
    asked = commands.select("book", "kind", F.col("old").alias("spelling"), similarity.nfc(F.btrim("spelling")).alias("_new"), F.lit(True).alias("_asked"))
    known = rules.select("book", "kind", "spelling").distinct().withColumn("_known", F.lit(True))
    judged = asked.join(known, ["book", "kind", "spelling"], "left")
    problem = F.when(F.col("_known").isNull(), "no such rule").when(F.col("_new").isNotNull() & (fold_line(F.col("_new")) != fold_line(F.col("spelling"))), "a rule changes marks, not letters")
    judged = judged.withColumn("problem", problem)
    good = judged.where("problem is null").select("book", "kind", "spelling", "_new", "_asked")
    met = rules.join(good, ["book", "kind", "spelling"], "left").where("_asked is null or _new is not null")
    done = met.withColumn("spelling", F.coalesce("_new", "spelling")).select(*rules.columns)
    return done, judged.where("problem is not null").select("book", "kind", F.col("spelling").alias("old"), F.col("_new").alias("spelling"), "problem")


def with_exceptions(rules: DataFrame, commands: DataFrame) -> DataFrame:
    """rules that leave out stories from now on: commands (book, spelling, story); a title that is excepted already isn't named again."""
    asked = commands.groupBy("book", "spelling").agg(F.array_sort(F.collect_set("story")).alias("_more"))
    met = rules.join(asked, ["book", "spelling"], "left")
    known = F.transform(F.coalesce("except", F.array().cast("array<string>")), title_fold)
    fresh = F.filter(F.coalesce("_more", F.array().cast("array<string>")), lambda s: ~F.array_contains(known, title_fold(s)))
    return met.withColumn("except", F.concat(F.coalesce("except", F.array().cast("array<string>")), fresh)).select(*rules.columns)


def with_depends(depends: DataFrame, rules: DataFrame, commands: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(depends, refused) after commands (book, fold, spellings, on): a pair is left to the reader, or no longer.

    A word that has a rule can't depend; spellings of other folds aren't taken.
    """
    ruled = _keyed(rules.where("kind = 'word'")).select("book", F.col("_key").alias("fold"), F.lit(True).alias("_ruled")).distinct()
    mine = F.array_distinct(F.filter("spellings", lambda s: fold_line(s) == F.col("fold")))
    judged = commands.withColumn("spellings", mine).join(ruled, ["book", "fold"], "left")
    problem = F.when(~F.col("on"), None).when(F.col("_ruled"), "the word has a rule").when(F.size("spellings") == 0, "no spelling of the word")
    judged = judged.withColumn("problem", problem).drop("_ruled")
    good = judged.where("problem is null")
    pairs = depends.withColumn("fold", fold_line(F.col("spellings")[0]))
    left = pairs.join(good.select("book", "fold").distinct(), ["book", "fold"], "left_anti").select("book", "spellings")
    return left.unionByName(good.where("on").select("book", "spellings")), judged.where("problem is not null")


def left_to_reader(words: DataFrame, depends: DataFrame) -> DataFrame:
    """Words (book, fold, ...) that depend: their spelling is decided from place to place."""
    pairs = depends.select("book", F.explode("spellings").alias("_s")).select("book", fold_line(F.col("_s")).alias("fold")).distinct()
    return words.join(pairs, ["book", "fold"], "left_semi")
