"""Corrections as a stream: every new log entry is replayed over the books it names.

An extension of the batch replay: file stream in, one replay per micro-batch over the touched books.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from ..operators.corrections import CORRECTION, replay


def correction_stream(spark: SparkSession, path: str) -> DataFrame:
    return spark.readStream.schema(CORRECTION).json(path)


def replay_stream(stream: DataFrame, drafts: str, out: str, checkpoint: str) -> StreamingQuery:
    """Replay each batch of corrections over the drafts (Parquet: book, idx, text) of its books.

    Results go to a folder a batch, so a batch that is run again replaces its own and nothing else.
    """

    def one(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        touched = spark.read.parquet(drafts).join(batch.select("book").distinct(), "book", "left_semi")
        blocks, outcomes = replay(touched, batch)
        blocks.write.mode("overwrite").parquet(f"{out}/blocks/batch={number}")
        outcomes.write.mode("overwrite").parquet(f"{out}/outcomes/batch={number}")

    return stream.writeStream.foreachBatch(one).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
