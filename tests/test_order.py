"""Block operators against the obvious sequential answer, with blocks far smaller than a run."""

import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as hs
from pyspark.sql import functions as F

from wordloom.operators.samples import train_val_split
from wordloom.operators.order import asof_backward, first_rows, key_at_rank, positional_index, rolling, running


def rows(spark, data, schema):
    return spark.createDataFrame(data, schema).repartition(5)


@pytest.mark.parametrize("bits", [1, 4, 16, 50])
def test_positional_index(spark, bits):
    rnd = random.Random(bits)
    keys = {g: sorted(rnd.sample(range(-(2**40), 2**62), 60) + list(range(40))) for g in "ab"}
    df = rows(spark, [(g, k) for g in keys for k in keys[g]], "g string, k long")
    got = {(r.g, r.k): r.idx for r in positional_index(df, "k", ["g"], bits=bits).collect()}
    assert got == {(g, k): i for g in keys for i, k in enumerate(sorted(set(keys[g])))}


def test_ties_follow_the_second_key(spark):
    df = rows(spark, [(k, t) for k in (5, 3) for t in range(20)], "k long, t int")
    got = sorted((r.idx, r.k, r.t) for r in positional_index(df, "k", tie=["t"], bits=0).collect())
    assert [(k, t) for _, k, t in got] == sorted((k, t) for k in (5, 3) for t in range(20))


@pytest.mark.parametrize("n", [0, 1, 7, 99, 100, 1000])
def test_first_rows(spark, n):
    keys = [i * 70001 - 900 for i in range(100)]
    df = rows(spark, [(k,) for k in keys], "k long")
    assert sorted(r.k for r in first_rows(df, "k", n).collect()) == keys[:n]
    at = [r.k for r in key_at_rank(df, "k", n).collect()]
    assert at == keys[n : n + 1]


def test_cuts_on_repeated_and_null_keys(spark):
    df = rows(spark, [(k, i) for i, k in enumerate([1, 2, 2, 2, 3])], "k long, t int")
    assert sorted((r.k, r.t) for r in first_rows(df, "k", 3, tie=["t"]).collect()) == [(1, 0), (2, 1), (2, 2)]
    assert sorted(r.k for r in first_rows(df, "k", 4).collect()) == [1, 2, 2, 2]  # falls between keys
    with pytest.raises(Exception, match="share their order key"):
        first_rows(df, "k", 3).collect()
    split = train_val_split(df, "k", 0.4, tie=["t"]).collect()
    assert sorted((r.k, r.t) for r in split if r.split == "train") == [(1, 0), (2, 1), (2, 2)]
    nulls = rows(spark, [(None,), (4,)], "k long")
    for made in (lambda: first_rows(nulls, "k", 1), lambda: positional_index(nulls, "k")):
        with pytest.raises(Exception, match="order key is null"):
            made().collect()


@pytest.mark.parametrize("bits", [0, 8])
def test_hashed_keys_spread_over_window_tasks(spark, bits):
    keys = [random.Random(i).getrandbits(62) for i in range(3000)]
    df = rows(spark, [(k,) for k in keys], "k long")
    made = positional_index(df, "k", bits=bits)
    assert {r.k: r.idx for r in made.collect()} == {k: i for i, k in enumerate(sorted(keys))}


@settings(max_examples=4, deadline=None)
@given(hs.lists(hs.one_of(hs.none(), hs.integers(-5, 5)), min_size=1, max_size=60), hs.integers(1, 3))
def test_running(spark, values, bits):
    df = rows(spark, [(i, v) for i, v in enumerate(values)], "p long, v int").withColumn("g", F.lit(1))
    made = running(
        df, ["g"], "p", {"s": (F.col("v"), "sum"), "m": (F.col("v"), "min"), "l": (F.col("v"), "last")}, bits=bits
    )
    for r in made.collect():
        seen = [v for v in values[: r.p + 1] if v is not None]
        assert (r.s, r.m, r.l) == (sum(seen), min(seen, default=None), seen[-1] if seen else None)
    before = running(df, ["g"], "p", {"s": (F.col("v"), "sum"), "l": (F.col("v"), "last")}, bits=bits, inclusive=False)
    for r in before.collect():
        seen = [v for v in values[: r.p] if v is not None]
        assert (r.s, r.l) == (sum(seen), seen[-1] if seen else None)


def test_rolling_frames_cross_blocks(spark):
    values = [random.Random(3).randint(0, 99) for _ in range(200)]
    df = rows(spark, list(enumerate(values)), "p long, v int").withColumn("g", F.lit(1))
    made = rolling(df, ["g"], "p", 6, lambda f: {"s": F.sum("v").over(f(-6, -2)), "n": F.count("v").over(f(-6, 0))}, bits=3)
    got = made.collect()
    assert len(got) == 200
    for r in got:
        assert r.s == (sum(values[max(0, r.p - 6) : max(0, r.p - 1)]) if r.p >= 2 else None)
        assert r.n == min(r.p + 1, 7)
    with pytest.raises(ValueError):
        rolling(df, ["g"], "p", 8, lambda f: {}, bits=3)


def test_asof_is_strictly_earlier(spark):
    left = rows(spark, [(1, s) for s in range(10)] + [(2, 4)], "g int, s long")
    right = rows(spark, [(1, 3, 30.0), (1, 7, 70.0), (3, 0, 1.0)], "g int, s long, v double")
    got = {(r.g, r.s): r.v for r in asof_backward(left, right, ["g"], "s", ["v"]).collect()}
    want = {(1, s): None if s <= 3 else 30.0 if s <= 7 else 70.0 for s in range(10)} | {(2, 4): None}
    assert got == want
