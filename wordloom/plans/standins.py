"""Views over the test tables that stand in for the inputs the operators expect.

Every view covers its whole table. Metric values are rounded to 1/64 and 1/256, which doubles
hold exactly, so averages do not depend on the order of addition.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wordloom.operators.order import positional_index
from wordloom.operators.vocab import vocabulary, word_counts
from wordloom.params import DEFAULT, Encoding
from wordloom.session import checkpoint
from wordloom.sources.texts import read_texts

EPOCH = 200  # steps per epoch in the telemetry view


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def documents(spark, sf) -> DataFrame:
    return read_texts(spark, f"{sf}/documents.parquet")


def counts(spark, sf, enc: Encoding = DEFAULT) -> DataFrame:
    return word_counts(documents(spark, sf), enc)


def document_vocab(spark, sf, enc: Encoding = DEFAULT) -> DataFrame:
    return vocabulary(counts(spark, sf, enc), enc)


def stored_vocab(spark, sf, enc: Encoding = DEFAULT) -> DataFrame:
    """The same as a stored table, as encoding jobs find it: built once, then only read."""
    return checkpoint(document_vocab(spark, sf, enc))


def turns(spark, sf) -> DataFrame:
    """(ex_id, conv_id, turn, role, text); `ex_id` keeps the order of (conv_id, turn)."""
    c = table(spark, sf, "conversations")
    return c.select((F.col("conv_id") * 1048576 + F.col("turn")).alias("ex_id"), "conv_id", "turn", "role", "text")


def pairs(spark, sf) -> DataFrame:
    """User turns with the assistant turn that follows: an equality join on (conv_id, turn)."""
    t = turns(spark, sf)
    user = t.where("role = 'user'").select("ex_id", "conv_id", "turn", F.col("text").alias("prompt"))
    said = t.where("role = 'assistant'").select("conv_id", (F.col("turn") - 1).alias("turn"), F.col("text").alias("response"))
    return user.join(said, ["conv_id", "turn"]).select("ex_id", "conv_id", "prompt", "response")


def conversation_vocab(spark, sf, enc: Encoding = DEFAULT) -> DataFrame:
    """Vocabulary over all turns in order."""
    return vocabulary(word_counts(turns(spark, sf), enc, "ex_id"), enc)


def stored_conversation_vocab(spark, sf, enc: Encoding = DEFAULT) -> DataFrame:
    return checkpoint(conversation_vocab(spark, sf, enc))


def events(spark, sf) -> DataFrame:
    return shape_events(table(spark, sf, "events"))


def shape_events(e: DataFrame) -> DataFrame:
    """(run_id, event_id, loss, grad_norm, accuracy, micros) from rows of `events`."""
    k = F.get_json_object("props", "$.k").cast("long")
    run = F.col("user_id") % 10
    loss = F.floor(F.col("value") * 64) / F.lit(64.0)
    grad = F.floor(F.col("value") * 6.4) / F.lit(64.0)
    acc = F.least(F.lit(1.0), (k + run * 10 + 100) / F.lit(256.0))
    return e.select(
        run.alias("run_id"), "event_id", loss.alias("loss"), grad.alias("grad_norm"), acc.alias("accuracy"),
        F.unix_micros(F.col("ts").cast("timestamp")).alias("micros"),
    )


def steps(spark, sf) -> DataFrame:
    """Step metrics: run_id, 1-based step in event order, 0-based epoch, loss, grad_norm, accuracy."""
    placed = positional_index(events(spark, sf), "event_id", ["run_id"], out="_i")
    return placed.select(
        "run_id",
        (F.col("_i") + 1).alias("step"),
        F.floor(F.col("_i") / EPOCH).alias("epoch"),
        "loss", "grad_norm", "accuracy", "micros", "event_id",
    )


def noisy(df: DataFrame, order: str = "step") -> DataFrame:
    """NaN and infinite losses, NaN gradients, and mostly-zero gradients on every third run."""
    o = F.col(order)
    loss = F.when(o % 97 == 0, F.lit(math.nan)).when(o % 211 == 0, F.lit(math.inf)).otherwise(F.col("loss"))
    grad = F.when(o % 89 == 0, F.lit(math.nan)).when((F.col("run_id") % 3 == 0) & (o % 4 != 0), 0.0)
    return df.withColumns({"loss": loss, "grad_norm": grad.otherwise(F.col("grad_norm"))})


def noisy_steps(spark, sf) -> DataFrame:
    return noisy(steps(spark, sf))


def validation(steps: DataFrame) -> DataFrame:
    """(run_id, step, val_loss, attn_entropy, memory_gb), recorded at the last step of an epoch."""
    means = steps.groupBy("run_id", "epoch").agg(F.avg("loss").alias("m"), F.max("step").alias("step"))
    return means.select(
        "run_id", "epoch", "step",
        F.col("m").alias("val_loss"),
        (F.col("m") * F.col("run_id") / 90.0).alias("attn_entropy"),
        (F.col("m") / 4.0).alias("memory_gb"),
    )


def scores(spark, sf) -> DataFrame:
    e = table(spark, sf, "embeddings")
    return e.select("vec_id", F.col("embedding").cast("array<double>").alias("logits"), "label", F.floor(F.col("vec_id") / 10).alias("batch"))
