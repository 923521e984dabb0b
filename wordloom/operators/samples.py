"""Fixed-length training samples, positional splits and batches."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wordloom.functions.text import tokens
from wordloom.operators.encode import add_ids, fitted
from wordloom.operators.order import before, positional_index
from wordloom.params import EOS_ID, PAD_ID, SOS_ID, Encoding


def pair_samples(pairs: DataFrame, vocab: DataFrame, enc: Encoding, length: int, key: str = "ex_id") -> DataFrame:
    """(key, src, tgt): prompt fitted to `length`, response to `length - 1`.

    Rows with no token on either side are dropped.
    """
    toks = pairs.select(key, tokens(F.col("prompt"), enc).alias("_p"), tokens(F.col("response"), enc).alias("_r"))
    # Both sides travel as one array, so the vocabulary is applied once.
    joint = toks.select(key, F.size("_p").alias("_np"), F.size("_r").alias("_nr"), F.concat("_p", "_r").alias("_t"))
    coded = add_ids(joint, vocab, "_t", [key]).where("_np > 0 and _nr > 0")
    src = F.slice("ids", F.lit(1), F.col("_np"))
    tgt = F.slice("ids", F.col("_np") + 1, F.col("_nr"))
    return coded.select(key, fitted(src, length).alias("src"), fitted(tgt, length - 1).alias("tgt"))


def window_starts(n: Column, length: int) -> Column:
    """0, L, 2L, ... below n - 2L, as an array; empty when n <= 2L."""
    last = n - 2 * length - 1
    return F.when(last >= 0, F.sequence(F.lit(0), last, F.lit(length))).otherwise(F.array().cast("array<int>"))


def window_keys(texts: DataFrame, enc: Encoding, length: int, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, start) of every sliding window. Needs token counts only: no vocabulary, no ids."""
    n = texts.select(key, F.size(tokens(F.col(text), enc)).alias("_n"))
    starts = n.select(key, F.explode_outer(window_starts(F.col("_n"), length)).alias("start"))
    return starts.where("start is not null")


def sliding_windows(texts: DataFrame, vocab: DataFrame, enc: Encoding, length: int, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, start, src, tgt): neighbouring stretches of `length` ids, one window per `length`."""
    toks = texts.select(key, tokens(F.col(text), enc).alias("_t"))
    coded = add_ids(toks, vocab, "_t", [key])
    starts = coded.select(key, "ids", F.explode_outer(window_starts(F.size("ids"), length)).alias("start"))
    return starts.where("start is not null").select(
        key,
        "start",
        F.slice("ids", F.col("start") + 1, F.lit(length)).alias("src"),
        F.slice("ids", F.col("start") + length + 1, F.lit(length)).alias("tgt"),
    )


def shifted(samples: DataFrame, length: int) -> DataFrame:
    """Teacher forcing: decoder input starts with SOS, the label ends with EOS in the last slot.

    EOS stands behind the padding, and replaces the last id of a full window.
    """
    head = F.slice("tgt", 1, length - 1)
    return samples.withColumns(
        {
            "encoder_input": F.slice("src", 1, length),
            "decoder_input": F.concat(F.array(F.lit(SOS_ID)), head),
            "label": F.concat(head, F.array(F.lit(EOS_ID))),
        }
    ).drop("src", "tgt")


def with_masks(samples: DataFrame) -> DataFrame:
    """Add 0/1 padding masks. The causal half is `decoder_allows`, never an L x L array."""

    def real(c):
        return F.transform(c, lambda i: (i != PAD_ID).cast("int"))

    return samples.withColumns({"encoder_mask": real("encoder_input"), "decoder_mask": real("decoder_input")})


def decoder_allows(row: Column, col: Column, decoder_input: Column) -> Column:
    """May position `row` look at position `col` (0-based)?"""
    return (col <= row) & (F.get(decoder_input, col) != PAD_ID)


def prompt_samples(texts: DataFrame, vocab: DataFrame, enc: Encoding, length: int, key: str = "ex_id", text: str = "prompt") -> DataFrame:
    """(key, ids): prompts fitted to `length`, without SOS and EOS."""
    toks = texts.select(key, tokens(F.col(text), enc).alias("_t"))
    coded = add_ids(toks, vocab, "_t", [key])
    return coded.select(key, fitted(F.col("ids"), length).alias("ids"))


def split_rank(n: Column, val_split: float) -> Column:
    """Rows before the cut; computed in DOUBLE, as the split fraction is a float."""
    return F.floor(n.cast("double") * (F.lit(1.0) - F.lit(val_split))).cast("long")


def train_val_split(df: DataFrame, key: str, val_split: float, out: str = "split", tie: Sequence[str] = ()) -> DataFrame:
    """Mark the leading rows in the order (key, *tie) `train`, the rest `val`; nothing is shuffled.

    The cut is one place in the order, so the table itself is only filtered or projected.
    """
    n = df.agg(F.count(F.lit(1)).alias("n")).select(split_rank(F.col("n"), val_split)).scalar()
    return df.withColumn(out, F.when(before(df, key, n, tie), "train").otherwise("val"))


def batched(df: DataFrame, batch: int, key: str, tie=(), bits: int = 16) -> DataFrame:
    """Add `batch` and `slot`; the incomplete last batch is left out."""
    n = df.agg(F.count(F.lit(1))).scalar()
    placed = positional_index(df, key, tie=tie, out="_i", bits=bits)
    full = F.floor(n / batch) * batch
    return placed.where(F.col("_i") < full).select(
        "*", F.floor(F.col("_i") / batch).cast("long").alias("batch"), (F.col("_i") % batch).alias("slot")
    ).drop("_i")


def shuffle_key(keys: list[str], seed: int) -> Column:
    """A repeatable pseudo-random LONG (60 bits) from the sample key."""
    text = F.concat_ws(":", F.lit(str(seed)), *[F.col(k).cast("string") for k in keys])
    return F.conv(F.substring(F.md5(text), 1, 15), 16, 10).cast("long")


def shuffled_batches(df: DataFrame, batch: int, keys: list[str], seed: int) -> DataFrame:
    """Batches over a repeatable random order; blocks are stretches of the hash space."""
    drawn = df.withColumn("_draw", shuffle_key(keys, seed))
    return batched(drawn, batch, "_draw", tie=keys, bits=44).drop("_draw")


def sample_counts(samples: DataFrame, key: str) -> DataFrame:
    """(samples, texts): rows, and distinct source texts that yielded any."""
    per_text = samples.groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    return per_text.agg(F.sum("n").alias("samples"), F.count(F.lit(1)).alias("texts"))


def step_budget(samples: DataFrame, batch: int, epochs: int) -> DataFrame:
    """(samples, batches, total_steps) with the incomplete batch dropped."""
    n = samples.agg(F.count(F.lit(1)).alias("samples"))
    per_epoch = F.floor(F.col("samples") / batch)
    return n.select("samples", per_epoch.alias("batches"), (per_epoch * epochs).alias("total_steps"))
