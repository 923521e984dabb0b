"""Exact top-k search over binary codes by incremental multi-index hashing.

A code is cut into segments, and every segment is an index of its own. Round s looks up, in every
segment, the values at exactly s differing bits from the query's. After it, every code not yet met
differs by at least s + 1 bits in each segment, so all codes within `segments * (s + 1) - 1` bits
are known; a query is finished once its k-th verified distance is covered by that. Only unfinished
queries go on to the next radius.

Rows with equal codes are one index entry that keeps the k smallest ids: no other row with that
code can be among the k nearest, as ties go to the smaller id. Queries with equal codes are
searched once. A row is a neighbour of itself at distance 0.

Null, empty or differently sized vectors, and null ids, have no code: they are neither found nor
answered. Repeated rows count as often as they occur. With fewer than k rows all are returned. An
empty table gives an empty table; other columns are not read.
"""

from __future__ import annotations

from functools import reduce
from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from wordloom.llm.common import stored, table

BITS = 64
SEGMENTS = 4
K = 10
EVERY = 100  # ids divisible by this are the queries


def sign_code(vector: Column) -> Column:
    """One bit per dimension: set where the value is above zero; null unless 64 values are there."""
    bits = [F.shiftleft(F.coalesce(F.get(vector, F.lit(i)) > 0, F.lit(False)).cast("long"), i) for i in range(BITS)]
    return F.when(F.size(vector) == BITS, reduce(lambda a, b: a.bitwiseOR(b), bits))


def _segment(code: Column, j: int, segments: int = SEGMENTS) -> Column:
    width = BITS // segments
    return F.shiftrightunsigned(code, j * width).bitwiseAND((1 << width) - 1)


def _flips(width: int, s: int) -> list[int]:
    """All values with s of `width` bits set."""
    return [sum(1 << b for b in at) for at in combinations(range(width), s)]


def _first(df: DataFrame, group: str, order: list[str], k: int, rank: str) -> DataFrame:
    """The first k rows of each group; each task cuts to k before the rows move."""
    return df.withColumn(rank, F.row_number().over(W.partitionBy(group).orderBy(*order))).where(F.col(rank) <= k)


def top_k(codes: DataFrame, queries: DataFrame, k: int = K, segments: int = SEGMENTS) -> DataFrame:
    """(query_id, rank, id, distance) for `codes` and `queries`, both (id, code LONG).

    The k nearest codes of every query by (Hamming distance, id).
    """
    width = BITS // segments
    codes = codes.where("code is not null and id is not null")
    firsts = _first(codes.select("id", "code"), "code", ["id"], k, "_r")
    index = stored(firsts.groupBy("code").agg(F.sort_array(F.collect_list("id")).alias("ids")), "codes")
    held = index.agg(F.coalesce(F.sum(F.size("ids")), F.lit(0)).alias("n")).first()["n"]
    want = min(k, held)  # rows beyond the k-th of a code are never needed
    asked = queries.where("code is not null and id is not null").select(F.col("id").alias("query_id"), F.col("code").alias("q"))
    asked = stored(asked, "queries")
    slots = stored(
        index.select("code", "ids", F.posexplode(F.array(*[_segment(F.col("code"), j, segments) for j in range(segments)])).alias("j", "v")),
        "segments",
    )
    open_ = asked.select("q").distinct().withColumn("bound", F.lit(BITS))
    best = None
    for s in range(width + 1 if want else 0):
        values = F.array(*[_segment(F.col("q"), j, segments) for j in range(segments)])
        probes = open_.select("q", "bound", F.posexplode(values).alias("j", "_v"))
        probes = probes.select("q", "bound", "j", F.explode(F.lit(_flips(width, s))).alias("_f"), "_v")
        probes = probes.select("q", "bound", "j", F.col("_v").bitwiseXOR(F.col("_f").cast("long")).alias("v"))
        # Never broadcast: stored queries are small, but their probes grow with the radius.
        met = probes.join(slots.hint("merge"), ["j", "v"]).withColumn("distance", F.bit_count(F.col("q").bitwiseXOR(F.col("code"))))
        # A code is met at this radius by its nearest segment, and counted by the first of those.
        apart = F.array(*[F.bit_count(_segment(F.col("q").bitwiseXOR(F.col("code")), i, segments)) for i in range(segments)])
        nearest = F.array_position(apart, F.array_min(apart)) - 1
        fresh = met.where((F.array_min(apart) == s) & (nearest == F.col("j")) & (F.col("distance") <= F.col("bound")))
        rows = fresh.select("q", F.explode("ids").alias("id"), "distance")
        if best is not None:
            rows = rows.unionByName(best.select("q", "id", "distance"))
        best = stored(_first(rows, "q", ["distance", "id"], k, "rank"), f"radius-{s}")
        kth = best.where(F.col("rank") == want).select("q", F.col("distance").alias("kth"))
        covered = segments * (s + 1) - 1
        left = open_.select("q").join(kth, "q", "left").where(F.col("kth").isNull() | (F.col("kth") > covered))
        open_ = stored(left.select("q", F.coalesce("kth", F.lit(BITS)).alias("bound")), f"open-{s}")
        if open_.isEmpty():
            break
    if best is None:
        best = open_.select("q", F.lit(0).alias("rank"), F.lit(0).cast("long").alias("id"), F.lit(0).alias("distance")).limit(0)
    return asked.join(best, "q").select("query_id", "rank", "id", "distance")


def op1_hamming_top_k(spark, sf: str) -> DataFrame:
    """The ten nearest vectors by sign code of every vector whose id is divisible by 100."""
    vectors = table(spark, sf, "embeddings")
    codes = stored(vectors.select(F.col("vec_id").alias("id"), sign_code(F.col("embedding")).alias("code")), "sign-codes")
    found = top_k(codes, codes.where(F.col("id") % EVERY == 0))
    return found.select("query_id", F.col("rank").cast("long").alias("rank"), F.col("id").alias("vec_id"), F.col("distance").cast("long").alias("distance"))


OP1_SQL = """
WITH q AS (SELECT vec_id AS query_id, embedding AS a FROM embeddings WHERE vec_id % 100 = 0),
d AS (
  SELECT query_id, vec_id,
         list_sum(list_transform(range(1, 65), lambda i: ((a[i] > 0) <> (embedding[i] > 0))::INT))::BIGINT AS distance
  FROM q, embeddings
),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY distance, vec_id) AS rank FROM d)
SELECT query_id, rank, vec_id, distance FROM r WHERE rank <= 10
"""
