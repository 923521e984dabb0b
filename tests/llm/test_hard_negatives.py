"""Hard-negative mining against a plain reading of its definition."""

import math
import random

import duckdb
import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from wordloom.llm import hard_negatives as hn

SCHEMA = "id long, label int, v array<double>"


def brute(rows, anchors, positives=5, negatives=10):
    """Rows and anchors are (id, label, components)."""
    whole = [(i, y, [math.floor(256 * x) for x in v]) for i, y, v in rows]
    made = []
    for i, y, v in sorted({(i, y, tuple(math.floor(256 * x) for x in v)) for i, y, v in anchors}):
        scored = [(-sum(a * b for a, b in zip(v, w)), j, label) for j, label, w in whole if j != i and len(w) == len(v)]
        scored.sort()
        for p, j, _ in [s for s in scored if s[2] == y][:positives]:
            p = -p
            inside = [s for s in scored if s[2] != y and 30 * p <= -100 * s[0] <= 90 * p][:negatives]
            made += [(i, j, n + 1, k, p, -s) for n, (s, k, _) in enumerate(inside)]
    return sorted(made)


def mined(spark, rows, anchors, **how):
    df = hn.usable(spark.createDataFrame(rows, SCHEMA).repartition(3), "id", "v", F.col("label"))
    asked = hn.usable(spark.createDataFrame(anchors, SCHEMA), "id", "v", F.col("label"))
    return sorted(tuple(r) for r in hn.hard_negatives(df, asked, **how).collect())


@pytest.mark.parametrize("block, ask", [(8192, 1024), (40, 3)])
def test_equals_the_definition(spark, block, ask):
    rnd = random.Random(block)
    centre = [[rnd.gauss(0, 1) for _ in range(6)] for _ in range(4)]
    rows = [(i, i % 4, [c + rnd.gauss(0, 0.8) for c in centre[rnd.randrange(4)]]) for i in range(300)]
    rows += [(300 + i, 1, list(rows[7][2])) for i in range(100)]  # one very common vector
    anchors = [r for r in rows if r[0] % 20 == 0]
    got = mined(spark, rows, anchors, block=block, ask=ask)
    assert got == brute(rows, anchors) and len(got) > 200


def test_ties_zero_and_negative_scores(spark):
    rows = [(1, 0, [1.0, 0.0]), (2, 0, [0.0, 1.0]), (3, 1, [0.0, -1.0]), (4, 1, [0.0, 3.0]), (5, 0, [-1.0, 0.0]), (6, 1, [0.5, 0.0]), (0, 1, [0.0, 0.0])]
    got = mined(spark, rows, rows[:1])
    assert got == brute(rows, rows[:1])
    # Score 0 is in the window of a positive of score 0, whatever the ids; below 0 nothing is.
    assert {(p, n) for _, p, _, n, _, _ in got} == {(2, 0), (2, 3), (2, 4)}


def test_rows_that_take_no_part_and_repeats(spark):
    bad = [(None, 0, [1.0, 1.0]), (7, None, [1.0, 1.0]), (8, 0, None), (9, 0, [1.0, None]), (10, 1, [math.nan, 1.0]), (11, 1, [math.inf, 1.0])]
    fine = [(1, 0, [1.0, 1.0]), (2, 0, [1.0, 0.9]), (3, 1, [0.5, 0.5]), (3, 1, [0.5, 0.5]), (4, 1, [0.4]), (5, 0, []), (6, 1, []), (2, 1, [0.6, 0.6])]
    anchors = [fine[0], fine[0], fine[5], fine[1], fine[7]]
    got = mined(spark, bad + fine, anchors + bad)
    assert got == brute(fine, anchors) and got
    assert [r[3] for r in got if r[0] == 1] == [2, 3, 3]
    assert mined(spark, fine, []) == [] and mined(spark, [], fine[:1]) == []


def test_products_are_exact():
    rnd = np.random.default_rng(3)
    for size in (10.0, 2.0**26, 2.0**29):
        a, b = (np.floor(rnd.uniform(-size, size, (4, 5))) for _ in range(2))
        want = [[sum(int(x) * int(y) for x, y in zip(r, s)) for s in b] for r in a]
        assert hn.products(a, b).tolist() == want
    assert hn.products(np.array([[2.0**40]]), np.array([[2.0**20]])).tolist() == [[2**60]]
    with pytest.raises(OverflowError):
        hn.products(np.array([[2.0**60]]), np.array([[2.0**20]]))


def test_the_iterator_keeps_its_state_over_batches():
    rows = [(1, 100, False, 9), (1, 90, True, 4), (1, 80, False, 8), (1, 75, True, 5), (1, 70, True, 6), (2, 5, True, 1)]
    names = ["anchor", "score", "negative", "id"]
    batches = [pa.RecordBatch.from_pylist([dict(zip(names, r))]) for r in rows]
    got = [tuple(r.values()) for b in hn.emit(iter(batches), 5, 2) for r in b.to_pylist()]
    assert got == [(1, 9, 1, 4, 100, 90), (1, 9, 2, 5, 100, 75), (1, 8, 1, 6, 80, 70)]


def test_other_columns_and_the_query(spark, sf):
    got = hn.op12_hard_negative_mining(spark, sf)
    assert got.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    con = duckdb.connect()
    con.execute(f"CREATE VIEW embeddings AS SELECT * FROM '{sf}/embeddings.parquet'")
    assert sorted(tuple(r) for r in got.collect()) == sorted(con.execute(hn.OP12_SQL).fetchall())
    df = spark.createDataFrame([(1, 0, [1.0], "x", 5)], SCHEMA + ", anchor string, score int")
    assert hn.usable(df, "id", "v", F.col("label")).columns == ["id", "label", "v"]
