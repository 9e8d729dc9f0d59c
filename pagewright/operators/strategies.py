"""Strategies by book: books that are laid out otherwise have a step of their own, others take the shared one.

A step is a function from DataFrames, all with a column `book`, to one DataFrame. `run` sends every book through
the strategy that a table of rules names for it: each strategy is planned once, over all of its books, and the results are one plan.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

Step = Callable[..., DataFrame]
#: Takes the books that no rule names.
SHARED = "shared"


class Registry:
    """Strategies by step and name."""

    def __init__(self):
        self.steps: dict[str, dict[str, Step]] = {}

    def strategy(self, step: str, name: str = SHARED) -> Callable[[Step], Step]:
        def add(function: Step) -> Step:
            if name in self.steps.setdefault(step, {}):
                raise ValueError(f"{step} has a strategy {name} already")
            self.steps[step][name] = function
            return function

        return add

    def own(self, step: str, rules: DataFrame) -> DataFrame:
        """(book, strategy): books with a strategy of their own for the step (rules: book, step, strategy); a rule that names none there is counts for nothing."""
        named = rules.where((F.col("step") == step) & F.col("strategy").isin(*self.steps[step]) & (F.col("strategy") != SHARED))
        return named.groupBy("book").agg(F.min("strategy").alias("strategy"))

    def unknown(self, rules: DataFrame) -> DataFrame:
        """(book, problem): rules that name no strategy there is, or two for one step."""
        names = F.array(*[F.lit(f"{step}/{name}") for step, by_name in self.steps.items() for name in by_name] or [F.lit("")])
        named = F.concat_ws("/", "step", "strategy")
        none = rules.where(~F.array_contains(names, named)).select("book", F.concat(F.lit("no strategy "), named).alias("problem"))
        twice = rules.groupBy("book", "step").agg(F.countDistinct("strategy").alias("_n")).where("_n > 1")
        return none.unionByName(twice.select("book", F.concat(F.lit("two strategies for "), "step").alias("problem")))

    def run(self, step: str, rules: DataFrame, *tables: DataFrame) -> DataFrame:
        """The step over all books of its tables. A strategy that no rule names is planned too and finds no book."""
        if SHARED not in self.steps.get(step, {}):
            raise KeyError(f"{step} has no shared strategy")
        own = self.own(step, rules)
        results = []
        for name, function in self.steps[step].items():
            # rules are few: books meet them, and the tables' rows stay where they lie as long as they do
            mine, how = (own, "left_anti") if name == SHARED else (own.where(F.col("strategy") == name), "left_semi")
            results.append(function(*[t.join(mine.select("book"), "book", how) for t in tables]))
        return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), results)
