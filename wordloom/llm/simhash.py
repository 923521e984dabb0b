"""SimHash near-duplicates through pivot distance tables.

1. Every text becomes one 64-bit fingerprint; equal fingerprints are one row from here on. A
   component is named by its smallest doc_id; one without any doc_id has no name.
2. Every fingerprint gets a row of the pivot table: its Hamming distances to fixed reference
   fingerprints. By the triangle inequality two fingerprints within `radius` differ by at most
   `radius` in every coordinate, so a larger difference in any one discards the pair.
3. Which pairs meet at all is decided by shared bits: the 64 bits are cut into `radius + 2`
   blocks, and fingerprints within `radius` agree in at least two of them. Each pair of blocks is
   a bucket table. Inside a bucket the pivot rows discard pairs and the survivors are verified.
   A bucket of more than `cell` fingerprints is dealt into cells, and pairs of cells are compared,
   so no task ever holds more than two cells, and no pair is left out.
4. A task reports a spanning forest of its links, never all pairs; the forests are merged into
   components by rounds of joins on (vertex, smallest neighbour).

Null and empty texts, and texts without words, have fingerprint zero and link like any other.
Repeated rows and equal texts share a fingerprint. An empty table gives an empty table.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wordloom.llm.common import stored, table

RADIUS = 3
SHINGLE = 3
CELL = 2048  # fingerprints compared with each other in one step
PIVOTS = 24

_xxh64 = partial(xxhash.xxh64_intdigest, seed=42)


def pivots(n: int = PIVOTS) -> np.ndarray:
    """Fixed reference fingerprints: the hashes of 0 .. n-1, spread over the whole cube."""
    return np.array([_xxh64(str(i).encode()) for i in range(n)], dtype=np.uint64)


# ── fingerprints ─────────────────────────────────────────────────────────────────────────


def fingerprint(text: str | None, width: int = SHINGLE) -> int:
    """The SimHash of one text; words are bytes between ASCII white space, A-Z lowered."""
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    if len(words) < width:
        shingles = [b" ".join(words)]
    else:
        shingles = map(b" ".join, zip(*[words[i:] for i in range(width)]))
    h = np.fromiter(map(_xxh64, shingles), np.uint64)
    ones = np.zeros(64, np.int64)
    for at in range(0, len(h), 65536):  # bounded memory for very long texts
        part = h[at : at + 65536].view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(ones * 2 > len(h), bitorder="little").view(np.uint64)[0])


def fingerprints(text: Column, width: int = SHINGLE) -> Column:
    """The fingerprint as a signed 64-bit value."""

    @F.arrow_udf("long")
    def simhash(texts: pa.Array) -> pa.Array:
        made = np.fromiter((fingerprint(t.as_py(), width) for t in texts), np.uint64, len(texts))
        return pa.array(made.view(np.int64))

    return simhash(text)


# ── links ────────────────────────────────────────────────────────────────────────────────


def block_masks(radius: int = RADIUS) -> list[int]:
    """Masks of two blocks each, out of `radius + 2` blocks of the 64 bits.

    At most `radius` differing bits touch at most `radius` blocks, so two blocks stay equal.
    """
    edges = np.linspace(0, 64, radius + 3).astype(int).tolist()
    blocks = [sum(1 << b for b in range(a, z)) for a, z in zip(edges, edges[1:])]
    return [x | y for x, y in combinations(blocks, 2)]


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def linked(fps: np.ndarray, left: np.ndarray, right: np.ndarray, radius: int, ref: np.ndarray, step: int = 256) -> list[tuple[int, int]]:
    """A spanning forest, as index pairs, of the links between members `left` and `right`."""
    coords = np.bitwise_count(fps[:, None] ^ ref[None, :]).astype(np.int8)
    order = right[np.argsort(coords[right, 0], kind="stable")]
    first = coords[order, 0]
    root = np.arange(len(fps))

    def find(x: int) -> int:
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    forest = []
    rows = left[np.argsort(coords[left, 0], kind="stable")]
    for at in range(0, len(rows), step):
        mine = rows[at : at + step]
        # The window of the first pivot: everything outside differs too much in that coordinate.
        lo = np.searchsorted(first, coords[mine[0], 0] - radius, "left")
        hi = np.searchsorted(first, coords[mine[-1], 0] + radius, "right")
        theirs = order[lo:hi]
        near = np.ones((len(mine), len(theirs)), bool)
        for p in range(coords.shape[1]):
            near &= np.abs(coords[mine, p][:, None] - coords[theirs, p][None, :]) <= radius
            if not near.any():
                break
        x, y = np.nonzero(near)
        x, y = mine[x], theirs[y]
        hit = (x < y if left is right else x != y) & (np.bitwise_count(fps[x] ^ fps[y]) <= radius)
        for a, b in zip(x[hit].tolist(), y[hit].tolist()):
            ra, rb = find(a), find(b)
            if ra != rb:
                root[ra] = rb
                forest.append((a, b))
    return forest


def _compare(radius: int, ref: np.ndarray):
    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Each row is one bucket, or one pair of cells of a large one."""
        for batch in batches:
            lists = batch.column(0)
            ends = lists.offsets.to_numpy()
            ids, prints, sides = (lists.values.field(n).to_numpy() for n in ("v", "fp", "side"))
            made = []
            for lo, hi in zip(ends, ends[1:]):
                side = sides[lo:hi]
                left = np.nonzero(side == 0)[0]
                right = np.nonzero(side == 1)[0] if side.any() else left
                for x, y in linked(prints[lo:hi].view(np.uint64), left, right, radius, ref):
                    made.append((ids[lo + x], ids[lo + y]))
            pairs = np.array(made, np.int64).reshape(-1, 2)
            yield pa.RecordBatch.from_arrays([pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], ["a", "b"])

    return compare


def links(nodes: DataFrame, radius: int = RADIUS, cell: int = CELL) -> DataFrame:
    """(a, b): links between rows of `nodes` (v, fp; distinct fingerprints) that keep every
    component connected: each pair within `radius` is joined by links inside its bucket."""
    masks = block_masks(radius)
    keys = F.array(*[F.col("fp").bitwiseAND(_signed(m)) for m in masks])
    spread = nodes.select("v", "fp", F.posexplode(keys).alias("t", "key"))
    sizes = spread.groupBy("t", "key").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    met = spread.join(sizes, ["t", "key"])
    # One cell for nearly every bucket; a large bucket is a triangle of cell pairs (i <= j).
    cells = F.ceil(F.col("n") / cell).cast("int")
    mine = F.pmod(F.xxhash64("fp"), cells).cast("int")
    spots = F.transform(
        F.sequence(F.lit(0), cells - 1),
        lambda o: F.struct(
            F.least(o, F.col("_c")).alias("i"), F.greatest(o, F.col("_c")).alias("j"), (o < F.col("_c")).cast("tinyint").alias("side")
        ),
    )
    dealt = met.withColumn("_c", mine).select("t", "key", "v", "fp", F.explode(spots).alias("s"))
    rows = dealt.groupBy("t", "key", "s.i", "s.j").agg(
        F.collect_list(F.struct("v", "fp", F.col("s.side").alias("side"))).alias("members")
    )
    return rows.where(F.size("members") > 1).select("members").mapInArrow(_compare(radius, pivots()), "a long, b long")


# ── components ───────────────────────────────────────────────────────────────────────────


def components(edges: DataFrame, rounds: int = 60) -> DataFrame:
    """(v, component): the smallest vertex reachable from each vertex of `edges` (a, b).

    Rounds of two steps: every vertex hands its smallest neighbour to its larger neighbours,
    then to its smaller ones, until nothing changes. A hub's neighbours are reduced to one
    minimum by partial aggregation and met again by a join, which splits when skewed.
    """
    e = stored(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "links")
    for _ in range(rounds):
        both = e.select("a", "b").union(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.join(low, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = stored(large.where("a <> b").distinct(), "large")
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(low, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        small = small.union(low.select("a", F.col("m").alias("b"))).where("a <> b")
        made = stored(small.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "small")
        if made.count() == e.count() and made.exceptAll(e).isEmpty():
            break
        e = made
    else:
        raise RuntimeError(f"no stable components after {rounds} rounds")
    return e.select(F.col("a").alias("v"), F.col("b").alias("component"))


def grouped(nodes: DataFrame, found: DataFrame) -> DataFrame:
    """(mark, g, component) of `nodes` (v, k, mark) and the components `found`: the group of each
    mark and the smallest key in it, null in a group without any key."""
    joined = nodes.join(found.withColumnRenamed("component", "g"), "v", "left").select("mark", "k", F.coalesce("g", "v").alias("g"))
    joined = stored(joined, "groups")
    names = joined.groupBy("g").agg(F.min("k").alias("component"))
    return joined.join(names, "g").select("mark", "g", "component")


def one_of_each(docs: DataFrame, key: str, mark: Column, groups: DataFrame) -> DataFrame:
    """The rows of `docs` whose key names their group, and one row of each group without any key."""
    winners = groups.where("component is not null").select(F.col("component").alias("_winner")).distinct()
    named = docs.join(winners, docs[key] == winners["_winner"], "left_semi")
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")
    nameless = docs.where(F.col(key).isNull()).select(row, mark.alias("mark")).join(groups.where("component is null"), "mark")
    nameless = nameless.groupBy("g").agg(F.first("row").alias("row"))
    return named.unionByName(nameless.select(*[F.col("row").getField(c).alias(c) for c in docs.columns]))


def _groups(prints: DataFrame, radius: int) -> DataFrame:
    """(mark, g, component) of every fingerprint; a fingerprint is its own vertex, so that one
    which has null keys only takes part."""
    nodes = stored(prints.groupBy("fp").agg(F.min("k").alias("k")), "nodes").withColumn("v", F.col("fp"))
    found = components(links(nodes.select("v", "fp"), radius))
    return grouped(nodes.select("v", "k", F.col("fp").alias("mark")), found)


def near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text", width: int = SHINGLE, radius: int = RADIUS) -> DataFrame:
    """(key, fp, component): the fingerprint of each row and the smallest key of its component."""
    prints = stored(docs.select(F.col(key).alias("k"), fingerprints(F.col(text), width).alias("fp")), "prints")
    named = _groups(prints, radius).select(F.col("mark").alias("fp"), "component")
    return prints.join(named, "fp").select(F.col("k").alias(key), "fp", "component")


def keep_one(docs: DataFrame, key: str = "doc_id", text: str = "text", width: int = SHINGLE, radius: int = RADIUS) -> DataFrame:
    """The rows of `docs` whose key names their component: one row of each group.

    Rows that repeat a key are one document and stay together; rows with a null key are judged
    by their text alone and go if any keyed row carries a linked one. One row of a group
    that has null keys only stays.
    """
    prints = stored(docs.select(F.col(key).alias("k"), fingerprints(F.col(text), width).alias("fp")), "prints")
    return one_of_each(docs, key, fingerprints(F.col(text), width), _groups(prints, radius))


def op10_simhash_near_dedup(spark, sf: str) -> DataFrame:
    """One row per document: fingerprint (16 hex digits) and the smallest doc_id of its component."""
    docs = table(spark, sf, "documents").select("doc_id", "text")
    digits = F.lower(F.lpad(F.hex("fp"), 16, "0"))
    return near_duplicates(docs).select("doc_id", digits.alias("fingerprint"), F.col("component").alias("component_id"))
