"""Vocabulary files: Parquet rows with a one-row settings table, and import of JSON files."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wordloom.params import FIRST_WORD_ID, Encoding


def save_vocabulary(vocab: DataFrame, enc: Encoding, path: str) -> None:
    """Replace the vocabulary at `path`: rows under `words`, settings under `config`."""
    spark = vocab.sparkSession
    vocab.write.mode("overwrite").parquet(f"{path}/words")
    written = spark.read.parquet(f"{path}/words")
    size = written.agg(F.count(F.lit(1)).alias("vocab_size"))
    size.select(
        F.lit(enc.to_json()).alias("config"), F.lit(enc.min_frequency).alias("min_frequency"), "vocab_size"
    ).coalesce(1).write.mode("overwrite").parquet(f"{path}/config")


def load_vocabulary(spark: SparkSession, path: str) -> tuple[DataFrame, Encoding]:
    row = spark.read.parquet(f"{path}/config").first()
    stored = json.loads(row["config"]) if row["config"] else None
    return spark.read.parquet(f"{path}/words"), Encoding.from_stored(stored, row["min_frequency"])


def save_settings(spark: SparkSession, path: str, posted: dict) -> Encoding:
    """Overlay posted settings on the stored ones; they take effect at the next rebuild."""
    _, stored = load_vocabulary(spark, path)
    enc = stored.merged(posted)
    old = spark.read.parquet(f"{path}/config").first()
    row = [(enc.to_json(), enc.min_frequency, old["vocab_size"])]
    spark.createDataFrame(row, "config string, min_frequency int, vocab_size long").coalesce(1).write.mode(
        "overwrite"
    ).parquet(f"{path}/config")
    return enc


def import_json(spark: SparkSession, path: str) -> tuple[DataFrame, Encoding]:
    """Read a vocabulary kept as one JSON object; older files have no `config`."""
    raw = spark.read.text(path, wholetext=True)
    fields = "struct<config:string,minFrequency:int,vocabSize:long,word2id:map<string,int>>"
    parsed = raw.select(F.from_json("value", fields).alias("v"))
    words = parsed.select(F.explode("v.word2id").alias("token", "id")).select(
        "id", "token", F.lit(0).cast("long").alias("n"), (F.col("id") < FIRST_WORD_ID).alias("is_special")
    )
    row = parsed.select("v.config", "v.minFrequency").first()
    stored = json.loads(row["config"]) if row["config"] else None
    return words, Encoding.from_stored(stored, row["minFrequency"])
