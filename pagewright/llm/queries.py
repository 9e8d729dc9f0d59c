"""The registered queries of the training-data operators and the SQL that holds them to account.

Each query applies its operator with production parameters to its whole table.
"""

from __future__ import annotations

from collections.abc import Callable

import corpus_pipeline
from pyspark.sql import DataFrame, SparkSession

from . import decontaminate, extract, fim, langid, linededup, mixing, neardup, packing, quality, sharding, substrings, trie, warc


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_documents(_table(spark, sf_dir, "documents"))


def op2_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.archive_pages(_table(spark, sf_dir, "pages"))


def op3_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality_report(_table(spark, sf_dir, "documents"))


def op4_fuzzy_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return linededup.dedup_report(_table(spark, sf_dir, "documents"))


def op5_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract.extract(_table(spark, sf_dir, "pages"))


def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(_table(spark, sf_dir, "documents"))


def op7_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.decontaminate(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op8_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.identify(_table(spark, sf_dir, "documents"))


def op9_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.dedup_report(_table(spark, sf_dir, "documents"))


def op10_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substrings.dedup_substrings(_table(spark, sf_dir, "documents"))


def op11_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fim.fill_in_middle(_table(spark, sf_dir, "documents"))


def op12_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_documents(_table(spark, sf_dir, "documents"))


def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trie.conversation_trie(_table(spark, sf_dir, "conversations"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_sharding": op1_sharding,
    "op2_warc": op2_warc,
    "op3_quality": op3_quality,
    "op4_fuzzy_lines": op4_fuzzy_lines,
    "op5_html_extraction": op5_html_extraction,
    "op6_packing": op6_packing,
    "op7_decontamination": op7_decontamination,
    "op8_language": op8_language,
    "op9_near_duplicates": op9_near_duplicates,
    "op10_substrings": op10_substrings,
    "op11_fill_in_middle": op11_fill_in_middle,
    "op12_mixing": op12_mixing,
    "op13_prefix_trie": op13_prefix_trie,
    "pipeline": corpus_pipeline.run,
}

ORACLES: dict[str, str] = {
    "op1_sharding": sharding.shard_sql(),
    "op2_warc": warc.archive_sql(),
    "op3_quality": quality.quality_sql(),
    "op7_decontamination": decontaminate.decontaminate_sql(),
    "op10_substrings": substrings.dedup_sql(),
    "op11_fill_in_middle": fim.fim_sql(),
    "op12_mixing": mixing.mix_sql(),
    "op13_prefix_trie": trie.trie_sql(),
} | ({"pipeline": corpus_pipeline.ORACLE_SQL} if corpus_pipeline.ORACLE_SQL else {})
