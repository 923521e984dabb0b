"""The corpus pipeline: toxicity, quality rules, near duplicates, personal data, packing.

Each stage takes all documents that the stage before kept, and its decisions take effect: toxic
and rejected documents go, lines that fail a rule leave their text, one document of each group of
near duplicates stays, personal data are exchanged, and what is left is packed into sequences.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wordloom.llm.common import stored, table
from wordloom.llm.packing import pack
from wordloom.llm.pii import pseudonymised, session_key
from wordloom.llm.quality import clean_documents
from wordloom.llm.simhash import RADIUS
from wordloom.llm.similar import keep_one
from wordloom.llm.toxicity import fit, toxicity


def _columns(docs: DataFrame, text: Column | None = None) -> list[Column]:
    """The columns of `docs` out of the struct `row`, with another text and its length."""
    made = []
    for c in docs.columns:
        col = F.col("row").getField(c)
        if text is not None and c == "text":
            col = text
        elif text is not None and c == "n_chars":
            col = F.length(text).cast(docs.schema[c].dataType)
        made.append(col.alias(c))
    return made


def _rows(docs: DataFrame) -> DataFrame:
    return docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a toxicity score below 0.5."""
    index = fit(docs, table(spark, sf_dir, "labels"))
    judged = _rows(docs).withColumn("judged", toxicity(F.col("row.text"), index, spark))
    return judged.where(F.col("judged.score") < 0.5).select(*_columns(docs))


def clean_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the quality rules, without the lines that fail them."""
    judged = clean_documents(docs)
    return judged.where("quality.kept").select(*_columns(docs, F.col("quality.clean_text")))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates: the one with the smallest id. Groups are what
    SimHash links (fingerprints within 3 bits, as in op10) connect, together with the pairs of a 5-word
    Jaccard similarity of 0.8 or more that lie beyond 3 bits."""
    return keep_one(docs, radius=RADIUS)


def exchange_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with pseudonyms in place of personal data and secrets."""
    return pseudonymised(docs, session_key(spark)).select(*_columns(docs, F.col("pii.text")))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents in sequences of 2,048 tokens."""
    return pack(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("toxicity", drop_toxic),
    ("quality_rules", clean_lines),
    ("simhash_near_dedup", drop_near_copies),
    ("pii", exchange_personal_data),
    ("packing", pack_sequences),
]
# No stage from the first on can be written as SQL; tests compare the rows with plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over `documents`; every stage but the last is written and read again."""
    docs = table(spark, sf_dir, "documents")
    *firsts, (_, last) = STAGES
    for name, stage in firsts:
        docs = stored(stage(spark, docs, sf_dir), f"stage-{name}")
    return last(spark, docs, sf_dir)
