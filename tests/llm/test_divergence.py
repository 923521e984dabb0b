"""The divergence audit against plain counting, and its trees against plain sums."""

import random
import re
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pytest

from wordloom.llm import divergence as dv

TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")


def brute(docs, min_docs=3, top=200):
    """`docs`: (text, lang, source)."""
    count, held = defaultdict(Counter), defaultdict(Counter)
    for text, lang, source in docs:
        lang, source = lang or "", source or ""
        low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        found = TERM.findall(low)
        count[lang, source].update(found)
        held[lang].update(set(found))
    made = set()
    for lang in held:
        kept = {t for t, n in held[lang].items() if n >= min_docs}
        groups = {s: c for (la, s), c in count.items() if la == lang}
        every = Counter()
        for c in groups.values():
            every.update(c)

        def shares(c):
            total = sum(c[t] for t in kept) + len(kept)
            return {t: 1 + 10**9 * (c[t] + 1) // total for t in kept}

        p, q = {s: shares(c) for s, c in groups.items()}, shares(every)
        for s in groups:
            pairs = [(-sum((p[s][t] - p[o][t]) ** 2 // p[o][t] for t in kept), o.encode(), o) for o in groups if o != s]
            terms = [(-((p[s][t] - q[t]) ** 2 // q[t]), t.encode(), t) for t in kept if groups[s][t] and p[s][t] > q[t]]
            made |= {(lang, s, "pair", o, -v, i + 1) for i, (v, _, o) in enumerate(sorted(pairs))}
            made |= {(lang, s, "term", t, -v, i + 1) for i, (v, _, t) in enumerate(sorted(terms)[:top])}
    return made


def audited(spark, docs, **how):
    df = spark.createDataFrame(docs, "text string, lang string, source string").repartition(3)
    return {tuple(r) for r in dv.divergence(df, **how).collect()}


def corpus(rnd, n=160, sources=9):
    words = ["Der", "the", "Été", "x", "naïve", "日本", "ZZ", "a1b", "q-r"] + [f"w{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(60)]
    docs = [(" ".join(rnd.choices(words, [1 / (i + 1) for i in range(len(words))], k=rnd.randint(0, 40))), rnd.choice("en de".split()), f"s{rnd.randrange(sources)}") for _ in range(n)]
    return docs + [("the the the", "en", "s0")] * 80  # a hot source


@pytest.mark.parametrize("leaves, groups", [(4096, 64), (8, 2), (7, 3)])
def test_equals_plain_counting(spark, leaves, groups):
    docs = corpus(random.Random(leaves))
    assert audited(spark, docs, leaves=leaves, groups=groups) == brute(docs)


def test_top_and_ties(spark):
    docs = [("same rare", "en", "a")] * 3 + [("same other more", "en", "b")] * 3 + [("", "en", "c")]
    for top in (1, 200):
        assert audited(spark, docs, top=top) == brute(docs, top=top)


def test_edges(spark):
    docs = [(None, None, None), ("", "en", "a"), ("one two", "en", "b"), ("1234 --", "fr", "x"), ("only few", "fr", "y"), ("alone", "de", "z")]
    got = audited(spark, docs)
    assert got == brute(docs)
    assert ("fr", "x", "pair", "y", 0, 1) in got and not any(r[0] in ("", "de") for r in got)
    assert audited(spark, docs * 3) == brute(docs * 3)
    assert audited(spark, []) == set()
    long = [("Word " * 200_000 + "end", "en", "a"), ("word end", "en", "b"), ("word", "en", "c"), ("end", "en", "c")]
    assert audited(spark, long) == brute(long)
    df = spark.createDataFrame([("a b", "en", "s", 1, "x")] * 3, "text string, lang string, source string, n int, term string")
    assert {tuple(r) for r in dv.divergence(df).collect()} == brute([("a b", "en", "s")] * 3)


def test_trees_share_equal_subtrees():
    rnd = np.random.default_rng(1)
    counts = rnd.choice([0, 0, 0, 1, 2], (12, 300))
    padded = np.full((12, 512), -1)
    padded[:, :300] = counts
    levels, leaves, roots = dv.consed(padded)
    assert len(leaves) == 4 and len(levels) == 9 and all(len(np.unique(x, axis=0)) == len(x) for x in levels)
    assert len(levels[0]) <= 10 < 12 * 256  # pairs of 0, 1, 2 and the filler
    assert len(roots) == 12 and len(np.unique(dv.consed(np.zeros((5, 64)))[2])) == 1
    left, right = np.triu_indices(12, 1)
    pair, a, b, times = dv.leaf_pairs(levels, len(leaves), roots[left], roots[right])
    for k in (0, 5, 65):
        got = {(leaves[x], leaves[y]): t for p, x, y, t in zip(pair, a, b, times) if p == k}
        assert got == Counter(zip(padded[left[k]].tolist(), padded[right[k]].tolist()))


def test_large_counts_are_exact():
    counts, totals = np.array([[0, 7, 3 * 10**10], [10**10, 0, 1]]), np.array([3 * 10**10 + 10, 10**10 + 4])
    there, back = dv.prices(counts, totals, np.array([0]), np.array([1]), 3)
    p, q = ([1 + 10**9 * (int(c) + 1) // int(t) for c in row] for row, t in zip(counts, totals))
    assert there[0] == sum((x - y) ** 2 // y for x, y in zip(p, q)) and back[0] == sum((x - y) ** 2 // x for x, y in zip(p, q))


def test_tasks_hand_on_in_parts(spark, monkeypatch):
    import pyarrow as pa

    monkeypatch.setattr(dv, "HELD", 2)
    batch = pa.RecordBatch.from_arrays([pa.array([b"a b", b"b c d", b""]), pa.array(["en"] * 3), pa.array(["s"] * 3)], ["text", "lang", "source"])
    total = Counter()
    for made in dv._count(iter([batch, batch])):
        for r in made.to_pylist():
            total[r["term"], "n"] += r["n"]
            total[r["term"], "docs"] += r["docs"]
    assert total["b", "n"] == 4 and total["b", "docs"] == 4 and total["", "docs"] == 6 and total["d", "n"] == 2


def test_query(spark, sf):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{sf}/documents.parquet'")
    got = dv.op13_source_divergence_audit(spark, sf)
    assert got.columns == ["lang", "source", "part", "item", "value", "rank"]
    assert sorted(tuple(r) for r in got.collect()) == sorted(con.execute(dv.OP13_SQL).fetchall())
