"""Word counts and vocabularies with stable ids."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wordloom.functions.text import tokens
from wordloom.operators.order import _before, positional_index
from wordloom.params import FIRST_WORD_ID, SPECIALS, Encoding

_POS_SPAN = 4294967296  # positions per text: an ARRAY has fewer than 2**31 elements


def token_rows(texts: DataFrame, enc: Encoding, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, pos, token), one row per token.

    The outer explode keeps the optimiser from copying the tokeniser into a row filter, which
    would tokenise every text twice.
    """
    toks = texts.select(key, tokens(F.col(text), enc).alias("_t"))
    return toks.select(key, F.posexplode_outer("_t").alias("pos", "token")).where("token is not null")


def word_counts(texts: DataFrame, enc: Encoding, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(token, n, first): how often each token occurs and where it is first seen.

    `first` packs (key, position) in one decimal. That keeps the aggregate in hash tables and
    combines before the shuffle, so a token that is a third of the corpus costs one row per
    map task.
    """
    packed = (F.col(key).cast("decimal(20,0)") * F.lit(_POS_SPAN).cast("decimal(11,0)")).cast("decimal(38,0)")
    toks = texts.select(packed.alias("_base"), tokens(F.col(text), enc).alias("_t"))
    rows = toks.select("_base", F.posexplode_outer("_t").alias("_pos", "token")).where("token is not null")
    return rows.groupBy("token").agg(
        F.count(F.lit(1)).alias("n"),
        F.min((F.col("_base") + F.col("_pos")).cast("decimal(38,0)")).alias("first"),
    )


def frequent(counts: DataFrame, enc: Encoding) -> DataFrame:
    return counts.where(F.col("n") >= enc.min_frequency)


def _first_key(col: str = "first"):
    return F.floor(F.col(col) / F.lit(_POS_SPAN).cast("decimal(11,0)")).cast("long")


def first_seen_order(words: DataFrame, group=(), out: str = "idx") -> DataFrame:
    """Dense position by first occurrence. Blocks of 16 texts bound the words per task."""
    keyed = words.withColumn("_fk", _first_key())
    return positional_index(keyed, "_fk", group, out=out, tie=["first"], bits=4).drop("_fk")


def frequency_order(words: DataFrame, out: str = "idx") -> DataFrame:
    """Dense position by falling count, ties by first occurrence.

    Most words share a few small counts, so ranking by count alone would crowd one task. The
    order is built from two parts: how many words have a larger count (one row per distinct
    count), and the first-seen position among words with the same count.
    """
    keyed = words.withColumn("_desc", -F.col("n"))
    sizes = keyed.groupBy("_desc").agg(F.count(F.lit(1)).alias("_n"))
    above = _before(sizes, (), "_desc", {"_n": "sum"})
    ranked = first_seen_order(keyed, group=["_desc"], out="_same")
    return ranked.join(above, "_desc").withColumn(out, F.col("_same") + F.col("_n")).drop("_desc", "_same", "_n")


def special_rows(spark, enc: Encoding) -> DataFrame:
    rows = [(i, enc.special_tokens[role], 0, True) for i, role in enumerate(SPECIALS)]
    return spark.createDataFrame(rows, "id int, token string, n long, is_special boolean")


def vocabulary(counts: DataFrame, enc: Encoding) -> DataFrame:
    """(id, token, n, is_special): the special tokens, then the surviving words.

    Ids follow first occurrence. Under a cap that binds, only the most frequent words stay and
    ids follow frequency; whether it binds is decided inside the query by a scalar subquery.
    """
    enc.check()
    names = [enc.special_tokens[r] for r in SPECIALS]
    words = frequent(counts, enc)
    if enc.max_vocab_size is None:
        placed = first_seen_order(words)
    else:
        room = enc.max_vocab_size - FIRST_WORD_ID
        both = frequency_order(first_seen_order(words, out="_seen"), out="_freq")
        total = words.agg(F.count(F.lit(1))).scalar()
        binding = total > room
        placed = (
            both.withColumn("idx", F.when(binding, F.col("_freq")).otherwise(F.col("_seen")))
            .where(~binding | (F.col("_freq") < room))
            .drop("_seen", "_freq")
        )
    # A reserved token that also turns up as a word keeps its reserved id only.
    clash = F.col("token").isin(names)
    rows = placed.select(
        (F.col("idx") + FIRST_WORD_ID).cast("int").alias("id"),
        "token",
        "n",
        F.lit(False).alias("is_special"),
        clash.alias("_clash"),
    )
    rows = rows.where(
        F.when(F.col("_clash"), F.raise_error(F.lit("a special token is also a word of the corpus")).cast("boolean"))
        .otherwise(F.lit(True))
    ).drop("_clash")
    return special_rows(counts.sparkSession, enc).unionByName(rows)


def vocab_summary(counts: DataFrame, enc: Encoding) -> DataFrame:
    """One row: distinct words seen, kept, dropped, and the final size with specials."""
    kept = F.count_if(F.col("n") >= enc.min_frequency)
    if enc.max_vocab_size is not None:
        kept = F.least(kept, F.lit(enc.max_vocab_size - FIRST_WORD_ID))
    seen = F.count(F.lit(1))
    return counts.agg(seen.alias("seen"), kept.alias("kept")).select(
        "seen",
        "kept",
        (F.col("seen") - F.col("kept")).alias("dropped"),
        (F.col("kept") + FIRST_WORD_ID).alias("vocab_size"),
    )
