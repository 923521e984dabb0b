"""Accuracy, loss and entropy reports over score tables and step metrics."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wordloom.functions.scores import argmax, entropy, perplexity, smoothed_cross_entropy
from wordloom.operators.encode import decode
from wordloom.operators.order import running
from wordloom.params import PAD_ID


def batch_accuracy(scores: DataFrame, batch: Sequence[str], logits: str = "logits", label: str = "label") -> DataFrame:
    """(batch, correct, counted, accuracy), padding labels not counted."""
    hit = (argmax(F.col(logits)) == F.col(label)) & (F.col(label) != PAD_ID)
    sums = scores.groupBy(*batch).agg(
        F.count_if(hit).alias("correct"), F.count_if(F.col(label) != PAD_ID).alias("counted")
    )
    return sums.withColumn("accuracy", F.col("correct") / F.greatest("counted", F.lit(1)))


def overall_accuracy(batches: DataFrame) -> DataFrame:
    """One row: macro (mean over batches) and micro (sum over sum) accuracy."""
    return batches.agg(
        F.avg("accuracy").alias("macro_accuracy"),
        (F.sum("correct") / F.greatest(F.sum("counted"), F.lit(1))).alias("micro_accuracy"),
        F.sum("counted").alias("counted"),
    )


def row_losses(scores: DataFrame, smoothing: float, logits: str = "logits", label: str = "label") -> DataFrame:
    """Add the smoothed loss of every row whose label counts."""
    loss = smoothed_cross_entropy(F.col(logits), F.col(label), smoothing)
    return scores.withColumn("loss", loss).where("loss is not null")


def epoch_summary(steps: DataFrame) -> DataFrame:
    """(run_id, epoch, batches, mean_loss, perplexity): the unweighted mean of batch losses."""
    means = steps.groupBy("run_id", "epoch").agg(F.count(F.lit(1)).alias("batches"), F.avg("loss").alias("mean_loss"))
    return means.withColumn("perplexity", perplexity(F.col("mean_loss")))


def throughput(steps: DataFrame, tokens: Column, micros: Column, group=("run_id", "epoch")) -> DataFrame:
    """Add tokens_per_second and batch_time at every step, counted from the epoch's start.

    `tokens` counts the padding too; `micros` is the step's clock in microseconds.
    """
    timed = steps.withColumns({"_micros": micros, "_one": F.lit(1).cast("long")})
    run = running(
        timed,
        group,
        "step",
        {"_tok": (tokens, "sum"), "_t0": (F.col("_micros"), "min"), "_nb": (F.col("_one"), "sum")},
    )
    elapsed = (F.col("_micros") - F.col("_t0")) / F.lit(1e6)
    return run.withColumns(
        {
            "tokens_per_second": F.col("_tok") / F.greatest(elapsed, F.lit(1.0)),
            "batch_time": elapsed / F.col("_nb"),
        }
    ).drop("_tok", "_t0", "_nb", "_micros", "_one")


def best_epochs(epochs: DataFrame) -> DataFrame:
    """Mark the epochs whose validation loss beats every earlier one of the run."""
    past = running(epochs, ["run_id"], "epoch", {"_best": (F.col("val_loss"), "min")}, inclusive=False)
    better = F.col("val_loss") < F.coalesce("_best", F.lit(float("inf")))
    return past.withColumn("is_best", F.coalesce(better, F.lit(False))).drop("_best")


def head_entropies(attention: DataFrame, keys: Sequence[str], corner: int = 32) -> DataFrame:
    """(keys, entropy): mean row entropy over the leading corner of each attention matrix.

    `attention` has `keys`, `row` and `weights`; the corner is a property of the report.
    """
    rows = attention.where(F.col("row") < corner)
    each = rows.select(*keys, entropy(F.slice("weights", 1, corner)).alias("_e"))
    return each.groupBy(*keys).agg(F.avg("_e").alias("entropy"))


def global_entropy(attention: DataFrame, matrix: Sequence[str], layer: str = "layer") -> DataFrame:
    """(matrix, entropy): mean row entropy of layer 0 averaged over heads, at full size.

    Heads are averaged as whole rows of the matrix, summed inside each task first.
    """
    heads = attention.where(F.col(layer) == 0).select(*matrix, "row", array_to_vector(F.col("weights").cast("array<double>")).alias("w"))
    mean = heads.groupBy(*matrix, "row").agg(vector_to_array(Summarizer.mean(F.col("w"))).alias("w"))
    return mean.groupBy(*matrix).agg(F.avg(entropy(F.col("w"))).alias("entropy"))


def prediction_samples(batches: DataFrame, vocab: DataFrame, key: Sequence[str], per_batch: int = 10) -> DataFrame:
    """Source, target and prediction as text for the first samples of every batch."""
    shown = batches.where(F.col("slot") < per_batch)
    for ids, out in (("source_ids", "source"), ("label", "target"), ("predicted_ids", "predicted")):
        shown = decode(shown, vocab, ids, out, key=key)
    return shown.select(*key, "batch", "slot", "source", "target", "predicted")
