"""Starting and finishing streams."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def scan(spark: SparkSession, path: str, schema: str, files_per_trigger: int = 1000) -> DataFrame:
    """An incremental Parquet scan; the trigger limit bounds what one micro-batch holds."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_trigger).parquet(path)


def use_rocksdb(spark: SparkSession) -> None:
    """Keyed state lives on disk, not on the heap."""
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)


def append_available(stream: DataFrame, out: str, checkpoint: str) -> None:
    """Process what is there, append it to `out`, stop. A rerun goes on from the checkpoint."""
    query = (
        stream.writeStream.format("parquet")
        .option("checkpointLocation", checkpoint)
        .option("path", out)
        .outputMode("append")
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
