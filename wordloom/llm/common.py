"""Small helpers shared by the operators of this subpackage."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wordloom.session import scratch_path

SPACE = r"[\x20\x09-\x0D]+"  # the six white space characters that separate words


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def bind(value: Column, body: Callable[[Column], Column]) -> Column:
    """`body(value)` with `value` computed once, however often the body names it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write `df` to a fresh place in the shared folder and read it back: cuts the lineage."""
    spark, path = df.sparkSession, scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def words(text: Column) -> Column:
    """The words of a text, `[^\\x20\\x09-\\x0D]+`; none for null."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), SPACE), lambda w: w != "")
