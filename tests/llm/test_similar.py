import random

import numpy as np
import pytest

import corpus_pipeline as cp
from test_null_keys import check_null_rows
from wordloom.llm import similar as sm
from wordloom.llm import simhash as sh


def grams(text, width=5):
    import re

    w = re.findall(r"[^\x20\x09-\x0D]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
    return frozenset(tuple(w[i : i + width]) for i in range(max(1, len(w) - width + 1))) if w else frozenset()


def plain_groups(sets, limit=(4, 5)):
    """Key -> smallest key reachable over pairs of Jaccard 4/5 or more; everything with everything."""
    p, q = limit
    keys, root = sorted(sets), {k: k for k in sets}

    def find(k):
        while root[k] != k:
            k = root[k]
        return k

    for i, a in enumerate(keys):
        for b in keys[i + 1 :]:
            x, y = sets[a], sets[b]
            if min(len(x), len(y)) * q < max(len(x), len(y)) * p:
                continue
            if len(x & y) * q >= len(x | y) * p:
                u, v = sorted((find(a), find(b)))
                root[v] = u
    return {k: find(k) for k in keys}


def copies(rnd, n=24):
    """Texts of 300 words and copies of them with one to twelve words exchanged."""
    made = {}
    for i in range(n):
        base = [f"w{rnd.randrange(5000)}" for _ in range(300)]
        for j in range(5):
            words = list(base)
            for at in rnd.sample(range(300), j * 3):
                words[at] = f"x{rnd.randrange(5000)}"
            made[i * 10 + j] = " ".join(words)
    return made


@pytest.mark.parametrize("cell", [600, 250_000])
def test_copies_that_differ_in_a_few_words(spark, cell):
    texts = copies(random.Random(5))
    want = plain_groups({k: grams(t) for k, t in texts.items()})
    bits = {k: sh.fingerprint(t) for k, t in texts.items()}
    assert any((bits[k] ^ bits[c]).bit_count() > 3 for k, c in want.items())  # out of reach of 3 bits
    df = spark.createDataFrame(list(texts.items()), "doc_id long, text string").repartition(3)
    assert {r.doc_id for r in sm.keep_one(df, cell=cell).collect()} == {k for k, c in want.items() if k == c}


def test_linked_is_exact():
    rnd = random.Random(6)
    sets = []
    for _ in range(40):
        base = rnd.sample(range(100_000), rnd.randint(1, 60))
        sets += [np.unique(np.array([x if rnd.random() > 0.1 else rnd.randrange(100_000) for x in base], np.uint64)) for _ in range(5)]
    sets += [np.zeros(0, np.uint64)] * 2
    want = plain_groups({i: frozenset(s.tolist()) for i, s in enumerate(sets) if len(s)})
    root = {i: i for i in range(len(sets))}

    def find(k):
        while root[k] != k:
            k = root[k]
        return k

    for a, b in sm.linked(sets, np.zeros(len(sets), int)):
        x, y = sorted((find(a), find(b)))
        root[y] = x
    assert find(len(sets) - 1) == len(sets) - 2
    assert {i: find(i) for i in want} == want


def test_the_stage_on_the_table(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    want = plain_groups({r.doc_id: grams(r.text) for r in docs.collect()})
    assert {r.doc_id for r in cp.drop_near_copies(spark, docs, sf).collect()} == {k for k, c in want.items() if k == c}


def test_rows_without_a_key_stay_unless_linked(spark):
    check_null_rows(spark, sm.keep_one)


def test_simhash_links_decide_too(spark, sf):
    same = "x y z " * 50
    texts = {1: same, 2: same + "one more word", 3: "another text of seven words in all"}
    assert (sh.fingerprint(texts[1]) ^ sh.fingerprint(texts[2])).bit_count() <= 3
    a, b = set(grams(texts[1])), set(grams(texts[2]))
    assert len(a & b) < sm.SIMILARITY * len(a | b)
    df = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    assert {r.doc_id for r in cp.drop_near_copies(spark, df, sf).collect()} == {1, 3}
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    by_simhash = {r.doc_id for r in sh.keep_one(docs).collect()}
    assert {r.doc_id for r in cp.drop_near_copies(spark, docs, sf).collect()} <= by_simhash
