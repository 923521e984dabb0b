"""Corpus streams against a fixed vocabulary of any size, micro-batch by micro-batch."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wordloom.operators.encode import HEAD, encode, unknown_rates
from wordloom.params import Encoding


def write_encoded(
    stream: DataFrame, vocab: DataFrame, enc: Encoding, path: str, checkpoint: str, length: int | None = None, limit: int = HEAD
) -> None:
    """Encode what has arrived and append it to `path`, micro-batch by micro-batch.

    Needs no state and takes a vocabulary of any size: each batch goes through the same code as a
    table. A batch that is run again after a failure replaces its own folder.
    """

    def append(batch: DataFrame, number: int) -> None:
        encode(batch, vocab, enc, length, limit=limit).write.mode("overwrite").parquet(f"{path}/batch={number}")

    query = stream.writeStream.foreachBatch(append).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()


def count_unknown(stream: DataFrame, vocab: DataFrame, enc: Encoding, path: str, checkpoint: str, limit: int = HEAD) -> None:
    """Count the tokens and unknown words that have arrived, for a vocabulary of any size.

    Every micro-batch leaves one row of totals under its number; run again after a failure it
    replaces that row, so nothing counts twice.
    """

    def count(batch: DataFrame, number: int) -> None:
        totals = unknown_rates(batch, vocab, enc, limit=limit).agg(F.sum("tokens").alias("tokens"), F.sum("unknown").alias("unknown"))
        totals.coalesce(1).write.mode("overwrite").parquet(f"{path}/batch={number}")

    query = stream.writeStream.foreachBatch(count).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()


def unknown_so_far(spark, path: str) -> DataFrame:
    """(tokens, unknown) over all micro-batches that `count_unknown` has stored."""
    stored = spark.read.schema("tokens long, unknown long").parquet(path)
    return stored.agg(F.coalesce(F.sum("tokens"), F.lit(0)).alias("tokens"), F.coalesce(F.sum("unknown"), F.lit(0)).alias("unknown"))
