"""The corpus pipeline: raw documents to packed training sequences.

Five stages, each on all that its predecessor kept. A stage's rows are written as Parquet in the
shared folder and read again, so a stage that fails is run again from whole input.

Defined cases, for every stage: rows with a null doc_id pass through quality rules, decontamination and packing like others and are
left alone by the two deduplications; a null text counts as empty, which the quality rules reject; repeated rows are judged
alike (near dedup keeps or drops them together); an empty table gives an empty result with the same columns; columns of any other
name are carried along, clashing ones too, up to packing, which returns pieces.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from pagewright.llm import decontaminate, linededup, neardup, packing, quality
from pagewright.llm.common import materialise


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that fail the base rules or are depleted go; furniture lines leave the others."""
    return quality.filtered(docs)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every group of like lines keeps its first occurrence; a text that loses every line goes."""
    return linededup.deduplicated(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates stays."""
    return neardup.deduplicated(docs)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a span of a benchmark item go."""
    return decontaminate.cleaned(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of the documents in their training sequences."""
    return packing.pack_documents(docs)


STAGES = [
    ("quality rules", quality_rules),
    ("line dedup", line_dedup),
    ("near dedup", near_dedup),
    ("benchmark decontamination", benchmark_decontamination),
    ("packing", pack),
]

#: Fuzzy line groups, sampled near-duplicates and token ids have no SQL form; tests hold the stages to brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage over the documents of sf_dir."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = materialise(stage(spark, docs, sf_dir), f"stage-{name.replace(' ', '-')}")
    return docs
