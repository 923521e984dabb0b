"""End-to-end jobs: rebuild a vocabulary, build a training set."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wordloom.operators.samples import (
    batched,
    pair_samples,
    shifted,
    shuffled_batches,
    sliding_windows,
    train_val_split,
    with_masks,
)
from wordloom.operators.vocab import vocabulary, word_counts
from wordloom.params import DEFAULT, Encoding, TrainingPlan, require_rows
from wordloom.session import scratch_path
from wordloom.sources.texts import flatten_for_vocab, normalize
from wordloom.sources.vocab_store import load_vocabulary, save_vocabulary


def build_vocabulary(examples: DataFrame, enc: Encoding) -> DataFrame:
    """Vocabulary over the texts of training examples, in example order."""
    return vocabulary(word_counts(flatten_for_vocab(examples), enc, "flat_id"), enc)


def rebuild_vocabulary(spark: SparkSession, rows: DataFrame, path: str, key: str = "ex_id", enc: Encoding | None = None) -> DataFrame:
    """Full refresh of a stored vocabulary with its stored settings (or `enc`).

    The counts are written first: they are small next to the corpus, and every later step then
    reads them instead of tokenising again.
    """
    if enc is None:
        _, enc = load_vocabulary(spark, path)
    enc.check()
    examples = normalize(rows, key)
    counts_path = scratch_path(spark, "word-counts")
    word_counts(flatten_for_vocab(examples), enc, "flat_id").write.parquet(counts_path)
    counts = spark.read.parquet(counts_path)
    require_rows(counts, "training texts")
    save_vocabulary(vocabulary(counts, enc), enc, path)
    return load_vocabulary(spark, path)[0]


def build_training_set(
    spark: SparkSession, rows: DataFrame, vocab: DataFrame, plan: TrainingPlan, out: str, key: str = "ex_id", enc: Encoding = DEFAULT
) -> None:
    """Write `out/train` and `out/val`: shifted, masked samples with their batch numbers.

    Samples are stored before they are numbered, so encoding runs once per split.
    """
    plan.check()
    examples = normalize(rows, key)
    require_rows(examples, "training examples")
    paired = examples.select("kind").limit(1).first()["kind"] == "pair"
    parts = train_val_split(examples, "ex_id", plan.val_split)
    for name in ("train", "val"):
        part = parts.where(F.col("split") == name)
        if paired:
            samples = pair_samples(part, vocab, enc, plan.seq_length).withColumn("start", F.lit(0))
        else:
            samples = sliding_windows(part, vocab, enc, plan.seq_length, key="ex_id")
        stored = scratch_path(spark, f"samples-{name}")
        with_masks(shifted(samples, plan.seq_length)).write.parquet(stored)
        ready = spark.read.parquet(stored)
        if name == "train":
            ready = shuffled_batches(ready, plan.batch_size, ["ex_id", "start"], seed=0)
        else:
            ready = batched(ready, plan.batch_size, "ex_id", tie=["start"], bits=8)
        ready.write.mode("overwrite").parquet(f"{out}/{name}")
    require_rows(spark.read.parquet(f"{out}/train"), "training samples")
