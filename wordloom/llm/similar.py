"""Near duplicates by the Jaccard similarity of their word shingles.

1. Equal texts are one node. Every node gets MinHash keys: `BANDS` keys of `ROWS` minima each. Two
   texts of similarity s miss each other with probability (1 - s**ROWS)**BANDS, 2.5e-7 at 0.8.
2. Every node is tied to the smallest one of each of its buckets, one row a node and bucket. The
   components of these ties hold all nodes that share a bucket, so all pairs to compare.
3. Within a component every pair is verified by its exact shingle sets. A component of more than
   `cell` shingles is dealt into cells, and pairs of cells are compared, so no task holds more than
   two cells and no pair is left out. A task reports a spanning forest of its links.
4. The components of the verified links are the groups of near duplicates.
5. With a `radius`, the fingerprints of `simhash` link texts as well, and the components are those of
   both kinds of links: what SimHash finds, and what lies beyond its radius.

Null and empty texts, and texts without words, are equal to each other; a text of fewer words than
a shingle is one shingle. Null keys name nothing but take part. An empty table gives an empty table.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wordloom.llm.common import stored
from wordloom.llm.simhash import _xxh64, components, fingerprints, grouped, one_of_each
from wordloom.llm.simhash import links as simhash_links

WIDTH = 5  # words of a shingle
SIMILARITY = 0.8
ROWS, BANDS = 6, 50
CELL = 250_000  # shingles compared with each other in one step

_draws = np.random.default_rng(7).integers(0, 2**63, (2, ROWS * BANDS), dtype=np.uint64)
_FACTORS, _SHIFTS = _draws[0] * np.uint64(2) + np.uint64(1), _draws[1]


def shingles(text: str | None, width: int = WIDTH) -> np.ndarray:
    """The distinct hashes of a text's shingles, sorted."""
    words = (text or "").encode().lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    if len(words) < width:
        grams = [b" ".join(words)]
    else:
        grams = map(b" ".join, zip(*[words[i:] for i in range(width)]))
    return np.unique(np.fromiter(map(_xxh64, grams), np.uint64))


def bands(found: np.ndarray) -> np.ndarray:
    """The MinHash keys of a set; equal sets have equal keys."""
    low = np.full(ROWS * BANDS, np.iinfo(np.uint64).max, np.uint64)
    for at in range(0, len(found), 2048):  # bounded memory for very long texts
        part = found[at : at + 2048]
        part = part ^ (part >> np.uint64(29))
        low = np.minimum(low, (part[:, None] * _FACTORS + _SHIFTS).min(0))
    return np.array([_xxh64(x.tobytes()) for x in low.reshape(BANDS, ROWS)], np.uint64)


def sketch(text: Column, width: int = WIDTH) -> Column:
    """STRUCT(n, bands): the number of distinct shingles and the MinHash keys."""

    @F.arrow_udf("n long, bands array<long>")
    def made(texts: pa.Array) -> pa.Array:
        sets = [shingles(t.as_py(), width) for t in texts]
        keys = [bands(s).view(np.int64) for s in sets]
        flat = np.concatenate(keys) if keys else np.zeros(0, np.int64)
        lists = pa.ListArray.from_arrays(pa.array(np.arange(0, len(flat) + 1, BANDS), pa.int32()), pa.array(flat, pa.int64()))
        return pa.StructArray.from_arrays([pa.array([len(s) for s in sets], pa.int64()), lists], ["n", "bands"])

    return made(text)


def linked(sets: list[np.ndarray], side: np.ndarray, similarity: float = SIMILARITY) -> list[tuple[int, int]]:
    """A spanning forest, as index pairs, of the links between sides 0 and 1, or within side 0."""
    sizes = np.array([len(s) for s in sets])
    order = np.argsort(sizes, kind="stable")
    sizes, side = sizes[order], side[order]
    ends = np.concatenate([[0], np.cumsum(sizes)])
    seen, flat = np.unique(np.concatenate([sets[i] for i in order] or [np.zeros(0, np.uint64)]), return_inverse=True)
    mark = np.zeros(len(seen), bool)
    both = side.any()
    group, forest = np.arange(len(sets)), []
    empty = int(np.count_nonzero(sizes == 0))
    forest += [(int(order[0]), int(x)) for x in order[1:empty]]
    for a in range(empty, len(sets)):
        # Larger sets only; no set above size / similarity can reach the similarity.
        hi = np.searchsorted(sizes, np.floor(sizes[a] / similarity + 1e-9), "right")
        open_ = group[a + 1 : hi] != group[a]
        if both:
            open_ &= side[a + 1 : hi] != side[a]
        if not open_.any():
            continue
        own = flat[ends[a] : ends[a + 1]]
        mark[own] = True
        shared = np.add.reduceat(mark[flat[ends[a + 1] : ends[hi]]], ends[a + 1 : hi] - ends[a + 1], dtype=np.int64)
        mark[own] = False
        # Rounding must not decide: s >= p/q is compared as shared * (1 + s) >= s * (sum of sizes).
        hit = open_ & (shared * (1 + similarity) >= similarity * (sizes[a] + sizes[a + 1 : hi]) - 1e-6)
        for b in (np.nonzero(hit)[0] + a + 1).tolist():
            if group[a] != group[b]:
                group[group == group[b]] = group[a]
                forest.append((int(order[a]), int(order[b])))
    return forest


def _verify(width: int, similarity: float):
    def verify(rows: pa.Table) -> pa.Table:
        """One component, or one pair of cells of a large one."""
        ids = rows.column("v").to_numpy()
        sets = [shingles(t.as_py(), width) for t in rows.column("text")]
        pairs = linked(sets, rows.column("side").to_numpy(), similarity)
        made = np.array([(ids[x], ids[y]) for x, y in pairs], np.int64).reshape(-1, 2)
        return pa.table({"a": pa.array(made[:, 0]), "b": pa.array(made[:, 1])})

    return verify


def _digest(text: Column) -> Column:
    return F.sha1(F.coalesce(text, F.lit("")).cast("binary"))


def links(docs: DataFrame, nodes: DataFrame, text: str, width: int, similarity: float, cell: int) -> DataFrame:
    """(a, b): verified links between `nodes` (v, d, n, bands) that keep every component connected."""
    spread = nodes.select("v", F.posexplode("bands").alias("t", "band"))
    low = spread.groupBy("t", "band").agg(F.min("v").alias("m"), F.count(F.lit(1)).alias("c")).where("c > 1").drop("c")
    ties = spread.join(low, ["t", "band"]).where("v <> m").select(F.col("m").alias("a"), F.col("v").alias("b"))
    tied = stored(components(ties), "candidates")  # all but the smallest node of each component
    tied = tied.union(tied.select(F.col("component").alias("v"), "component").distinct())
    near = nodes.join(tied, "v").select("v", "d", "n", F.col("component").alias("c"))
    sizes = near.groupBy("c").agg(F.ceil(F.sum("n") / cell).cast("int").alias("cells")).select("c", F.greatest("cells", F.lit(1)).alias("cells"))
    found = stored(near.join(sizes, "c").select("v", "d", "c", "cells"), "near")
    # One text of each node; equal texts are reduced before they are shuffled.
    texts = docs.select(_digest(F.col(text)).alias("d"), F.col(text).alias("text")).join(found, "d")
    texts = texts.groupBy("v", "c", "cells").agg(F.first("text").alias("text"))
    mine = F.pmod(F.xxhash64("v"), F.col("cells")).cast("int")
    spots = F.transform(
        F.sequence(F.lit(0), F.col("cells") - 1),
        lambda o: F.struct(F.least(o, F.col("_c")).alias("i"), F.greatest(o, F.col("_c")).alias("j"), (o < F.col("_c")).cast("int").alias("side")),
    )
    dealt = texts.withColumn("_c", mine).select("c", "v", "text", F.explode(spots).alias("s")).select("c", "v", "text", "s.i", "s.j", "s.side")
    return dealt.groupBy("c", "i", "j").applyInArrow(_verify(width, similarity), "a long, b long")


def _fingerprint_links(nodes: DataFrame, radius: int) -> DataFrame:
    """(a, b): the SimHash links of `nodes` (v, fp): equal fingerprints are one vertex, and those within
    `radius` are linked by the bucket tables and pivot rows of `simhash`."""
    prints = stored(nodes.groupBy("fp").agg(F.min("v").alias("v")), "prints")
    same = nodes.join(prints.select("fp", F.col("v").alias("a")), "fp").where("a <> v").select("a", F.col("v").alias("b"))
    return simhash_links(prints.select("v", "fp"), radius).union(same)


def keep_one(
    docs: DataFrame, key: str = "doc_id", text: str = "text", width: int = WIDTH, similarity: float = SIMILARITY, cell: int = CELL, radius: int | None = None
) -> DataFrame:
    """One row of each group of near duplicates: the rows of the smallest key, or one row of a group
    without any key. Rows that repeat a key are one document and stay together. With a `radius`, texts
    whose SimHash fingerprints differ by that many bits at most are linked too."""
    made = {"s": sketch(F.col(text), width)} | ({} if radius is None else {"fp": fingerprints(F.col(text))})
    rows = docs.select(F.col(key).alias("k"), _digest(F.col(text)).alias("d"), *[c.alias(n) for n, c in made.items()])
    marks = rows.groupBy("d").agg(F.min("k").alias("k"), *[F.first(n).alias(n) for n in made])
    kept = ["d", "k", "s.n", "s.bands", *[n for n in made if n != "s"], F.monotonically_increasing_id().alias("v")]
    nodes = stored(marks.select(*kept), "nodes")
    edges = links(docs, nodes, text, width, similarity, cell)
    if radius is not None:
        edges = edges.union(_fingerprint_links(nodes.select("v", "fp"), radius))
    found = components(edges)
    return one_of_each(docs, key, _digest(F.col(text)), grouped(nodes.select("v", "k", F.col("d").alias("mark")), found))
