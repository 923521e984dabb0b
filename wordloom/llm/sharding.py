"""Sharding by vector bin packing: bytes, tokens and rows are balanced jointly.

Rows with equal texts form a group, and a group goes to one shard. Placing is greedy: the largest
group first, each to the shard where the dot product of its size vector with the residual capacity
is highest (all three dimensions in shares of a shard, bytes weighed most).

* A group of more than `SPLIT` of a shard in any dimension would break the balance. It is dealt
  into slices; there are at most `shards / SPLIT` such groups in each dimension, so they are
  placed first, on the driver.
* All other groups are spread over buckets by hash. Each bucket is packed by one task, towards
  its share of what the large groups left free in every shard. A bucket holds about `BUCKET`
  groups whatever the data look like, and its last, smallest groups even out what the first left.

Only size vectors move, never texts. Null texts have size 16 and form one group, like empty ones.
Repeated rows are placed one by one. An empty table gives an empty table. Other columns are not
read.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wordloom.llm.common import stored, table, words
from wordloom.operators.order import positional_index

SHARDS = 40
SPLIT = 1 / 8  # of a shard: larger groups are sliced
BUCKET = 20_000  # groups per packing task, about
DIMENSIONS = ("bytes", "tokens", "rows")
WEIGHTS = (16.0, 1.0, 1.0)  # of the dimensions in the dot product: the law is on bytes


def place(sizes: np.ndarray, capacity: np.ndarray, weights=WEIGHTS) -> np.ndarray:
    """The bin of each item: items (n, d) by descending size, bins by residual capacity (b, d).

    Sizes and capacities are shares of a whole shard, weighed by dimension; ties go to the
    lowest bin.
    """
    weighed = sizes * np.asarray(weights)
    residual = capacity.astype(np.float64).copy()
    bins = np.empty(len(sizes), np.int32)
    for i in np.argsort(-weighed.sum(1), kind="stable").tolist():
        b = int(np.argmax(residual @ weighed[i]))
        bins[i] = b
        residual[b] -= sizes[i]
    return bins


def _pack(unit: np.ndarray, free: np.ndarray, whole: np.ndarray):
    def bucket(frame: pd.DataFrame) -> pd.DataFrame:
        sizes = frame[list(DIMENSIONS)].to_numpy(np.float64) / unit
        share = sizes.sum(0) / np.maximum(whole, 1e-300)
        return pd.DataFrame({"g": frame["g"], "shard": place(sizes, free * share)})

    return bucket


def shard(docs: DataFrame, key: str = "doc_id", text: str = "text", shards: int = SHARDS) -> DataFrame:
    """(key, size, text_crc32, law, shard, slot, grown_shard): law `bytes`, near-equal sizes.

    A row's size is the UTF-8 bytes of its text plus 16. Slots count from 0 without gaps in
    every shard, in the order in which the rows were read.
    """
    t = F.coalesce(F.col(text), F.lit(""))
    rows = docs.select(
        F.col(key).alias("k"),
        (F.octet_length(t) + 16).cast("long").alias("size"),
        F.crc32(t.cast("binary")).alias("crc"),
        F.size(words(t)).cast("long").alias("n"),
        F.xxhash64(t).alias("g"),
        F.monotonically_increasing_id().alias("r"),
    )
    rows = stored(rows, "sizes")
    vectors = (F.sum("size").alias("bytes"), F.sum("n").alias("tokens"), F.count(F.lit(1)).alias("rows"))
    groups = stored(rows.groupBy("g").agg(*vectors), "groups")
    total = groups.agg(*[F.coalesce(F.sum(d), F.lit(0)).alias(d) for d in DIMENSIONS], F.count(F.lit(1)).alias("groups")).first()
    unit = np.array([max(total[d], 1) / shards for d in DIMENSIONS])  # one shard

    # Groups above the split share: at most shards / SPLIT in each dimension.
    big = F.greatest(*[F.col(d) / float(u) for d, u in zip(DIMENSIONS, unit)])
    large = [(r["g"], max(1, int(np.ceil(r["x"] / SPLIT)))) for r in groups.where(big > SPLIT).select("g", big.alias("x")).collect()]
    spark = docs.sparkSession
    cuts = F.broadcast(spark.createDataFrame(large, "g long, slices int"))
    sliced = rows.join(cuts, "g").withColumn("s", F.pmod(F.xxhash64("r"), F.col("slices")).cast("int"))
    parts = sorted(sliced.groupBy("g", "s").agg(*vectors).collect(), key=lambda r: (r["g"], r["s"])) if large else []
    sizes = np.array([[p[d] for d in DIMENSIONS] for p in parts], np.float64).reshape(-1, 3) / unit
    bins = place(sizes, np.ones((shards, 3)))
    load = np.zeros((shards, 3))
    np.add.at(load, bins, sizes)
    homes = F.broadcast(spark.createDataFrame([(p["g"], p["s"], int(b)) for p, b in zip(parts, bins)], "g long, s int, shard int"))
    placed_large = sliced.join(homes, ["g", "s"]).select("k", "size", "crc", "r", "shard")

    # The others, towards their share of what is still free.
    free = np.maximum(1.0 - load, 0.0)
    whole = shards - load.sum(0)  # what all small groups hold, in shards
    free *= whole / np.maximum(free.sum(0), 1e-300)
    buckets = max(1, total["groups"] // BUCKET)
    small = groups.join(cuts, "g", "left_anti").withColumn("_b", F.pmod(F.xxhash64(F.col("g"), F.lit(7)), F.lit(buckets)))
    found = small.groupBy("_b").applyInPandas(_pack(unit, free, whole), "g long, shard int")
    placed_small = rows.join(cuts, "g", "left_anti").join(found, "g").select("k", "size", "crc", "r", "shard")

    numbered = positional_index(placed_large.unionByName(placed_small), "r", ["shard"], out="slot")
    return numbered.select(
        F.col("k").alias(key),
        "size",
        F.col("crc").alias("text_crc32"),
        F.lit("bytes").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def op6_sharding(spark, sf: str) -> DataFrame:
    """One row per document: its shard of 40 and its slot there."""
    return shard(table(spark, sf, "documents").select("doc_id", "text"))
