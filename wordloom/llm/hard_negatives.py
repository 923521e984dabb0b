"""Hard negatives by a secondary-sort shuffle.

Vectors become integers (floor of 256 x), so scores are exact inner products. Anchors meet all rows
block by block, as matrix products of bounded size. A first pass keeps, per block, the best rows of
an anchor's own label; the best of those over all blocks are its positives. A second pass knows
their score windows and keeps, per block and window, the first rows of other labels. Both cuts only
leave out what other rows of the same block already displace, so nothing that belongs to the result
is lost and an anchor's rows stay few, however many rows share its label.

What is left is keyed (anchor, descending score, positive first, id), dealt by anchor and sorted
inside the partitions: DataFrame's form of repartitionAndSortWithinPartitions. An iterator then
walks each partition once. A positive opens a window, a negative is emitted to every open window
that holds its score, and windows that are full or passed are closed; the state is at most
`positives` windows, whatever the length of an anchor's rows.

Defined cases: rows with a null id, label or vector, or with a null or non-finite component, take
no part. A pair of vectors of different lengths has no score and is no pair; empty vectors score 0.
Rows that share an id are never compared with each other. A row that repeats counts as often as it
occurs as a positive or negative, and once as an anchor. Ties go to the smaller id. A positive whose
score is 0 has the negatives of score 0; one below 0 has an empty window. Anchors without positives
or negatives give no rows, and so does an empty table. Other columns are not read. A score that
does not fit a LONG stops the job.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from wordloom.llm.common import stored, table

SCALE = 256
POSITIVES = 5
NEGATIVES = 10
LOW, HIGH, WHOLE = 30, 90, 100  # a window is LOW to HIGH hundredths of the positive's score
ROWS = 8192  # rows of one block
ANCHORS = 1024  # anchors of one block
AT_ONCE = 128  # anchors multiplied at a time
EVERY = 100  # ids divisible by this are anchors

_PAIRS = "anchor long, score long, negative boolean, id long"
_MINED = "anchor long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"


def usable(vectors: DataFrame, key: str, vector: str, label: Column) -> DataFrame:
    """(id, label, v) of the rows that take part; components are whole doubles."""
    bad = F.exists(F.col("v"), lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == F.lit(math.inf)))
    rows = vectors.select(
        F.col(key).cast("long").alias("id"), label.cast("long").alias("label"), F.col(vector).cast("array<double>").alias("v")
    )
    return rows.where(F.col("id").isNotNull() & F.col("label").isNotNull() & F.col("v").isNotNull()).where(~bad)


def _integers(column: pa.ChunkedArray) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """Vector length -> (places, matrix of whole numbers) of an Arrow list column."""
    lists = column.combine_chunks()
    if isinstance(lists, pa.ChunkedArray):
        lists = pa.concat_arrays(lists.chunks) if lists.num_chunks else pa.array([], lists.type)
    offsets = lists.offsets.to_numpy()
    flat = np.floor(lists.values.to_numpy(zero_copy_only=False).astype(np.float64) * SCALE)
    sizes = np.diff(offsets)
    out = {}
    for d in np.unique(sizes).tolist():
        at = np.flatnonzero(sizes == d)
        out[d] = at, flat[offsets[at][:, None] + np.arange(d)[None, :]]
    return out


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact inner products of whole-number rows; the widest type is taken only where needed."""
    top = float(np.abs(a).max(initial=0)) * float(np.abs(b).max(initial=0)) * a.shape[1]
    if top < 2**53:
        return (a @ b.T).astype(np.int64)  # every partial sum is a whole number below 2**53
    exact = np.vectorize(int, otypes=[object])
    if top < 2**62:
        return exact(a).astype(np.int64) @ exact(b).astype(np.int64).T
    return np.dot(exact(a), exact(b).T).astype(np.int64)  # too large for a LONG: OverflowError


def _blocks(anchors: pa.Table, rows: pa.Table) -> Iterator[tuple]:
    """(anchor number, its row in `anchors`, scores, ids, places in `rows`), one anchor at a time."""
    mine, theirs = _integers(anchors["v"]), _integers(rows["v"])
    ids = rows["id"].to_numpy()
    for d, (at, a) in mine.items():
        if d in theirs:
            places, b = theirs[d]
            for lo in range(0, len(at), AT_ONCE):
                for i, scores in zip(at[lo : lo + AT_ONCE].tolist(), products(a[lo : lo + AT_ONCE], b)):
                    yield i, scores, ids[places], places


def _best(scores: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """The places of the first k by descending score, then id."""
    if len(scores) > 4 * k:
        cut = np.partition(scores, len(scores) - k)[len(scores) - k]
        near = np.flatnonzero(scores >= cut)
        return near[np.lexsort((ids[near], -scores[near]))[:k]]
    return np.lexsort((ids, -scores))[:k]


def _pairs(found: list[tuple]) -> pa.Table:
    """Rows of `_PAIRS` from (anchor, scores, negative, ids)."""
    n = [len(f[1]) for f in found]
    whole = [np.concatenate([f[i] for f in found]) if found else np.empty(0, np.int64) for i in (1, 3)]
    return pa.table(
        {
            "anchor": pa.array(np.repeat(np.array([f[0] for f in found], np.int64), n), pa.int64()),
            "score": pa.array(whole[0], pa.int64()),
            "negative": pa.array(np.repeat(np.array([f[2] for f in found], bool), n), pa.bool_()),
            "id": pa.array(whole[1], pa.int64()),
        }
    )


def _near(k: int):
    """Per block: the best `k` rows of the anchor's label."""

    def per_block(anchors: pa.Table, rows: pa.Table) -> pa.Table:
        number, key, label = (anchors[c].to_numpy() for c in ("anchor", "id", "label"))
        labels, found = rows["label"].to_numpy(), []
        for i, scores, ids, places in _blocks(anchors, rows):
            own = np.flatnonzero((labels[places] == label[i]) & (ids != key[i]))
            best = own[_best(scores[own], ids[own], k)]
            found.append((number[i], scores[best], False, ids[best]))
        return _pairs(found)

    return per_block


def _inside(k: int):
    """Per block and window of a positive: the first `k` rows of other labels."""

    def per_block(anchors: pa.Table, rows: pa.Table) -> pa.Table:
        number, key, label = (anchors[c].to_numpy() for c in ("anchor", "id", "label"))
        windows = anchors["windows"].to_pylist()
        labels, found = rows["label"].to_numpy(), []
        for i, scores, ids, places in _blocks(anchors, rows):
            spans = [(-(-LOW * p // WHOLE), HIGH * p // WHOLE) for p in windows[i]]
            low, high = min(lo for lo, _ in spans), max(hi for _, hi in spans)
            other = np.flatnonzero((labels[places] != label[i]) & (ids != key[i]) & (scores >= low) & (scores <= high))
            s, d = scores[other], ids[other]
            taken = np.zeros(len(other), bool)
            for lo, hi in spans:
                held = np.flatnonzero((s >= lo) & (s <= hi))
                taken[held[_best(s[held], d[held], k)]] = True
            found.append((number[i], s[taken], True, d[taken]))
        return _pairs(found)

    return per_block


def emit(batches: Iterator[pa.RecordBatch], positives: int, negatives: int) -> Iterator[pa.RecordBatch]:
    """Walk rows sorted by (anchor, descending score, positive first, id) and mine the negatives."""
    anchor, seen, windows = None, 0, []
    for batch in batches:
        out = []
        for a, score, negative, row in zip(*(c.to_pylist() for c in batch.columns)):
            if a != anchor:
                anchor, seen, windows = a, 0, []
            if not negative:
                if seen < positives:
                    seen += 1
                    windows.append([row, score, 0])
                continue
            windows = [w for w in windows if w[2] < negatives and LOW * w[1] <= WHOLE * score]
            for w in windows:
                if WHOLE * score <= HIGH * w[1]:
                    w[2] += 1
                    out.append((a, w[0], w[2], row, w[1], score))
        columns = list(zip(*out)) or [()] * 6
        kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()]
        names = ["anchor", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names)


def hard_negatives(rows: DataFrame, anchors: DataFrame, positives: int = POSITIVES, negatives: int = NEGATIVES, block: int = ROWS, ask: int = ANCHORS) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score).

    `rows` and `anchors` are (id, label, v) as `usable` gives them.
    """
    rows = stored(rows, "vectors")
    w = W.partitionBy("id").orderBy("label", "v")
    asked = anchors.distinct().withColumn("variant", F.row_number().over(w))
    # Anchors are numbered by their place in the stored table; numbers need not be dense.
    asked = stored(asked, "anchors-told")
    asked = stored(asked.withColumn("anchor", F.monotonically_increasing_id()), "anchors")
    # Places in a stored table are stable, so a block holds the same rows when a task is repeated.
    n, m = rows.count(), asked.count()
    across, down = max(1, math.ceil(n / block)), max(1, math.ceil(m / ask))

    def dealt(df: DataFrame, parts: int) -> Column:
        return F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(parts)).cast("int")

    def every(parts: int) -> Column:
        return F.explode(F.sequence(F.lit(0), F.lit(parts - 1)))

    left = stored(rows.withColumn("g", dealt(rows, across)), "blocks") if across > 1 else rows.withColumn("g", F.lit(0))
    left = left.withColumn("h", every(down))

    def compare(told: DataFrame, how) -> DataFrame:
        right = told.withColumn("h", dealt(told, down) if down > 1 else F.lit(0)).withColumn("g", every(across))
        return right.groupBy("g", "h").cogroup(left.groupBy("g", "h")).applyInArrow(how, _PAIRS)

    def first(df: DataFrame) -> DataFrame:
        best = W.partitionBy("anchor").orderBy(F.desc("score"), "id")
        return df.withColumn("_r", F.row_number().over(best)).where(F.col("_r") <= positives).drop("_r")

    found = stored(first(compare(asked, _near(positives))), "positives")
    windows = found.groupBy("anchor").agg(F.sort_array(F.collect_set("score")).alias("windows"))
    told = stored(asked.join(windows, "anchor"), "windows")
    keyed = found.unionByName(compare(told, _inside(negatives)))
    ordered = keyed.repartition("anchor").sortWithinPartitions("anchor", F.desc("score"), "negative", "id")
    mined = ordered.mapInArrow(lambda batches: emit(batches, positives, negatives), _MINED)
    return mined.join(asked.select("anchor", F.col("id").alias("anchor_id")), "anchor").select(
        "anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"
    )


def op12_hard_negative_mining(spark, sf: str) -> DataFrame:
    """The hard negatives of every vector whose id is divisible by 100, for its five positives."""
    shifted = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    rows = usable(table(spark, sf, "embeddings"), "vec_id", "embedding", shifted)
    return hard_negatives(rows, rows.where(F.col("id") % EVERY == 0))


OP12_SQL = """
WITH r AS (
  SELECT vec_id AS id, (CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END)::BIGINT AS label,
         list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0
),
a AS (SELECT *, row_number() OVER (ORDER BY id, label, v) AS n FROM (SELECT DISTINCT * FROM r WHERE id % 100 = 0)),
s AS (
  SELECT a.n, a.id AS anchor_id, r.id, r.label = a.label AS same,
         coalesce(list_sum(list_transform(range(1, len(a.v) + 1), lambda i: a.v[i] * r.v[i])), 0)::BIGINT AS score
  FROM a JOIN r ON r.id <> a.id AND len(r.v) = len(a.v)
),
p AS (
  SELECT n, anchor_id, id AS positive_id, score AS positive_score,
         row_number() OVER (PARTITION BY n ORDER BY score DESC, id) AS place
  FROM s WHERE same QUALIFY place <= 5
),
m AS (
  SELECT p.n, p.anchor_id, p.positive_id, p.positive_score, s.id AS negative_id, s.score AS negative_score,
         row_number() OVER (PARTITION BY p.n, p.place ORDER BY s.score DESC, s.id) AS rank
  FROM p JOIN s ON s.n = p.n AND NOT s.same AND 30 * p.positive_score <= 100 * s.score AND 100 * s.score <= 90 * p.positive_score
  QUALIFY rank <= 10
)
SELECT anchor_id, positive_id, rank::INT AS rank, negative_id, positive_score, negative_score FROM m
"""
