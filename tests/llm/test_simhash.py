import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from wordloom.llm import simhash as sh


def plain_components(prints, radius):
    """Key -> smallest key reachable, by comparing everything with everything."""
    keys = sorted(prints)
    root = {k: k for k in keys}

    def find(k):
        while root[k] != k:
            k = root[k]
        return k

    for i, a in enumerate(keys):
        for b in keys[i + 1 :]:
            if (prints[a] ^ prints[b]).bit_count() <= radius:
                x, y = sorted((find(a), find(b)))
                root[y] = x
    return {k: find(k) for k in keys}


def by_bits(text, width=3):
    """The definition, one bit at a time."""
    import re

    import xxhash

    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    w = re.findall(r"[^\x20\x09-\x0D]+", low)
    if not w:
        return 0
    grams = [" ".join(w[i : i + width]) for i in range(len(w) - width + 1)] or [" ".join(w)]
    h = [xxhash.xxh64_intdigest(g.encode(), seed=42) for g in grams]
    return sum(1 << b for b in range(64) if sum(x >> b & 1 for x in h) * 2 > len(h))


TEXTS = [None, "", " \n", "One", "one", "Two words", "a b c", "A b  c", "É é É é", "x y z", "k " * 70000, "tie a tie a tie"]


def test_fingerprints(spark):
    df = spark.createDataFrame(list(enumerate(TEXTS)), "i int, t string")
    got = {r.i: r.f % 2**64 for r in df.select("i", sh.fingerprints(F.col("t")).alias("f")).collect()}
    assert got == {i: by_bits(t) for i, t in enumerate(TEXTS)}
    spark_hash = df.where("i = 8").select(F.xxhash64(F.lit("é é é"))).first()[0]
    assert spark_hash % 2**64 == sh._xxh64("é é é".encode())


def near(rnd, base, bits):
    for b in rnd.sample(range(64), bits):
        base ^= 1 << b
    return base


@pytest.mark.parametrize("cell", [3, 16, 2048])
def test_links_keep_every_component(spark, cell):
    rnd = random.Random(cell)
    centres = [rnd.getrandbits(64) for _ in range(12)]
    prints = {i: near(rnd, centres[i % 12], rnd.randint(0, 4)) for i in range(240)}
    # One crowd with most bits in common, so that buckets exceed a cell; and one chain.
    for i in range(240, 300):
        prints[i] = near(rnd, centres[0], 2)
    at = centres[1]
    for i in range(300, 330):
        at = near(rnd, at, 3)
        prints[i] = at
    distinct = {}
    for k, f in sorted(prints.items()):
        distinct.setdefault(f, k)
    nodes = spark.createDataFrame([(k, f - 2**64 if f >> 63 else f) for f, k in distinct.items()], "v long, fp long")
    edges = sh.links(nodes, cell=cell)
    for e in edges.collect():
        assert (prints[e.a] ^ prints[e.b]).bit_count() <= 3
    got = {r.v: r.component for r in sh.components(edges).collect()}
    want = plain_components({k: f for f, k in distinct.items()}, 3)
    assert {k: got.get(k, k) for k in want} == want


def test_pivots_only_discard():
    rnd = random.Random(4)
    fps = np.array([near(rnd, 12345, rnd.randint(0, 5)) for _ in range(300)] + [rnd.getrandbits(64) for _ in range(300)], np.uint64)
    every = np.arange(len(fps))
    forest = sh.linked(fps, every, every, 3, sh.pivots(), step=50)
    got = plain_components({}, 3)
    root = {i: i for i in range(len(fps))}

    def find(k):
        while root[k] != k:
            k = root[k]
        return k

    for a, b in forest:
        x, y = sorted((find(a), find(b)))
        root[y] = x
    got = {i: find(i) for i in root}
    assert got == plain_components({i: int(f) for i, f in enumerate(fps)}, 3)


def test_whole_table(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text")
    prints = {r.doc_id: by_bits(r.text) for r in docs.collect()}
    want = plain_components(prints, 3)
    got = {r.doc_id: (r.fingerprint, r.component_id) for r in sh.op10_simhash_near_dedup(spark, sf).collect()}
    assert got == {i: (f"{prints[i]:016x}", want[i]) for i in prints}


def test_edge_rows(spark):
    rows = [(5, None, "x"), (3, "", "y"), (9, " ", "z"), (9, " ", "z"), (7, "a b c d", None), (8, "A b c d", None), (None, "a b c d", None), (None, "alone in the world", "n")]
    df = spark.createDataFrame(rows, "doc_id long, text string, component string").repartition(3)
    got = sorted((r.doc_id or -1, r.component or -1) for r in sh.near_duplicates(df).collect())
    assert got == [(-1, -1), (-1, 7), (3, 3), (5, 3), (7, 7), (8, 7), (9, 3), (9, 3)]
    kept = sh.keep_one(df)
    # A row without a key goes if a linked text has one; the other has no near copy and stays.
    assert kept.columns == df.columns and sorted((r.doc_id or -1, r.text) for r in kept.collect()) == [(-1, "alone in the world"), (3, ""), (7, "a b c d")]
    assert sh.near_duplicates(df.limit(0)).count() == 0
