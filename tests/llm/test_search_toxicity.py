import math
import random
import zlib
from collections import Counter

import numpy as np
import pytest

from wordloom.llm import hamming, toxicity
from wordloom.llm.queries import ORACLES, QUERIES

# ── Hamming search ───────────────────────────────────────────────────────────────────────


def signed(x):
    return x - 2**64 if x >> 63 else x


def brute(codes, queries, k):
    made = set()
    for q, a in queries:
        near = sorted(((a ^ b).bit_count(), i) for i, b in codes)[:k]
        made |= {(q, n + 1, i, d) for n, (d, i) in enumerate(near)}
    return made


def search(spark, codes, queries, k):
    c = spark.createDataFrame([(i, signed(x)) for i, x in codes], "id long, code long").repartition(3)
    q = spark.createDataFrame([(i, signed(x)) for i, x in queries], "id long, code long")
    return {tuple(r) for r in hamming.top_k(c, q, k).collect()}


@pytest.mark.parametrize("k", [1, 10])
def test_search_is_exact(spark, k):
    rnd = random.Random(k)
    centres = [rnd.getrandbits(64) for _ in range(5)]
    codes = [(i, centres[i % 5] ^ sum(1 << b for b in rnd.sample(range(64), rnd.randint(0, 12)))) for i in range(200)]
    codes += [(200 + i, centres[0]) for i in range(100)]  # a crowd of ties
    codes += [(300 + i, rnd.getrandbits(64)) for i in range(100)]
    queries = [c for c in codes if c[0] % 40 == 0] + [(1000, centres[0]), (1001, 0)]
    assert search(spark, codes, queries, k) == brute(codes, queries, k)


def test_search_edges(spark):
    few = [(1, 5), (2, 7)]
    assert search(spark, few, few, 10) == brute(few, few, 10)
    assert search(spark, few, [(9, 2**64 - 1)], 1) == {(9, 1, 2, 61)}
    c = spark.createDataFrame([(1, None), (None, 3), (2, 3)], "id long, code long")
    assert {tuple(r) for r in hamming.top_k(c, c).collect()} == {(2, 1, 2, 0)}
    assert hamming.top_k(c.limit(0), c).count() == 0 and hamming.top_k(c, c.limit(0)).count() == 0


def test_sign_codes(spark):
    vectors = [[1.0 if i % 3 == 0 else -1.0 for i in range(64)], [0.0] * 64, [1.0] * 63, None, [1.0] * 64]
    df = spark.createDataFrame(list(enumerate(vectors)), "i int, v array<float>")
    got = {r.i: r.c for r in df.select("i", hamming.sign_code(df.v).alias("c")).collect()}
    assert got == {0: signed(sum(1 << i for i in range(0, 64, 3))), 1: 0, 2: None, 3: None, 4: -1}


def test_search_table(spark, sf):
    from checking import compare, connect

    for name, sql in ORACLES.items():
        problem, n = compare(spark, connect(sf), sf, QUERIES[name], sql)
        assert problem is None and n > 0, problem


# ── toxicity ─────────────────────────────────────────────────────────────────────────────


def plain_cut(text):
    import regex

    return Counter(w for token in (text or "").lower().split() for w in regex.findall(r"\p{L}+", token))


def plain_starts(examples):
    """The beginnings of words that go with a label beyond chance."""
    begun = [{w[:m] for w in plain_cut(t) for m in (4, 5, 6) if len(w) >= m} for _, _, t in examples]
    n1, n0 = sum(y for _, y, _ in examples), sum(1 - y for _, y, _ in examples)
    made = []
    for x in set().union(*begun):
        a, b = (sum(x in s for s, (_, y, _) in zip(begun, examples) if y == k) for k in (1, 0))
        out = (n1 + n0 - a - b) * (a + b) * n1 * n0
        if out and (n1 + n0) * (a * n0 - b * n1) ** 2 / out >= 30:
            made.append(x)
    return made


def plain_toxicity(examples, totals, texts, k=15):
    """(score, neighbours) of every text by the definition, comparing with every example.

    `examples`: (key, label, text) by key; `totals`: label -> labelled rows.
    """
    cut = plain_cut
    begun = lambda w: [w[:m] for m in (4, 5, 6) if len(w) >= m]
    rows = [cut(t) for _, _, t in examples]
    label = [y for _, y, _ in examples]
    n, n1, n0 = len(rows), sum(label), len(rows) - sum(label)

    def chi(holding):
        a = sum(label[i] for i in holding)
        b = len(holding) - a
        lead = a * n0 - b * n1
        return n * lead * lead / max((a + b) * (n - a - b) * n1 * n0, 1)

    def holders(sets):
        made = {}
        for i, s in enumerate(sets):
            for t in s:
                made.setdefault(t, set()).add(i)
        return made

    starts = set(plain_starts(examples))
    known = set().union(*rows) if rows else set()

    def terms(counts):
        made = Counter()
        for w, m in counts.items():
            if w in known:
                made["=" + w] += m
            for x in begun(w):
                if x in starts:
                    made["^" + x] += m
        return made

    rows = [terms(r) for r in rows]
    hold = holders(rows)
    scale = {t: math.log1p(n / len(h)) * chi(h) / (chi(h) + 30) + 1e-6 for t, h in hold.items()}

    def unit(counts):
        w = {t: (1 + math.log(m)) * scale[t] for t, m in counts.items()}
        norm = math.sqrt(sum(x * x for x in w.values()))
        return {t: x / norm for t, x in w.items()}

    rows = [unit(r) for r in rows]
    stands = [totals[y] / max(1, (n1 if y else n0)) for y in label]
    prior = totals.get(1, 0) / max(1, sum(totals.values()))
    bare = [i for i in range(n) if not rows[i]]
    blank = (sum(stands[i] * label[i] for i in bare) + prior) / (sum(stands[i] for i in bare) + 1)
    made = []
    for t in texts:
        v = unit(terms(cut(t)))
        near = sorted(((sum(x * r[u] for u, x in v.items() if u in r), i) for i, r in enumerate(rows)), key=lambda p: -p[0])
        near = [(c, i) for c, i in near if c > 0]
        # Examples at the k-th cosine may stand in for each other.
        least = near[k - 1][0] if len(near) >= k else 0.0
        votes = [(stands[i] / (1.05 - min(c, 1.0)), label[i]) for c, i in near[:k]]
        score = (sum(v for v, y in votes if y) + prior / 1.05) / (sum(v for v, _ in votes) + 1 / 1.05) if votes else blank
        made.append((score, [examples[i][0] for c, i in near if c > least + 1e-6], [examples[i][0] for c, i in near if c >= least - 1e-6]))
    return made


def index_of(examples, totals):
    import pyarrow as pa

    batch = pa.RecordBatch.from_arrays([pa.array([e[0] for e in examples]), pa.array([e[1] for e in examples], pa.int32()), pa.array([e[2] for e in examples])], ["k", "y", "t"])
    return toxicity.indexed(pa.Table.from_batches(toxicity._vectors(iter([batch]))), plain_starts(examples), totals)


def check_scores(index, examples, totals, texts):
    score, rows, found = index.score(*toxicity._counted(toxicity._Known(index), texts), len(texts))
    keys = np.array(index.keys.to_pylist(), object)
    for i, (want, sure, maybe) in enumerate(plain_toxicity(examples, totals, texts)):
        got = keys[found[rows == i]].tolist()
        assert set(sure) <= set(got) <= set(maybe) and len(got) == min(15, len(maybe)), texts[i]
        if len(maybe) <= 15 or len(sure) == 15:
            assert score[i] == pytest.approx(want, abs=1e-5), texts[i]


@pytest.mark.parametrize("block, frequent", [(256, 256), (8, 20), (4, 1)])
def test_nearest_is_exact(monkeypatch, block, frequent):
    monkeypatch.setattr(toxicity, "BLOCK", block)
    monkeypatch.setattr(toxicity, "FREQUENT", frequent)
    rnd = random.Random(block)
    vocabulary = ["the", "of"] * 20 + [f"{a}{b}{c}" for a in "abc" for b in ("lpha", "et") for c in ("", "s", "x", "ing")] + ["rare" + chr(97 + i) * 3 for i in range(26)]
    texts = [" ".join(rnd.choices(vocabulary, k=rnd.randint(0, 25))) + rnd.choice(["", ".", " Nasty" + rnd.choice(["", "ish", "ly!"])]) for _ in range(330)]
    examples = [(i, int("nasty" in t.lower()), t) for i, t in enumerate(texts[:250])]
    totals = {0: 900, 1: 300}
    index = index_of(examples, totals)
    assert "nasty" in index.starts and "the" in index.words
    check_scores(index, examples, totals, texts[250:] + ["", None, "!!", "unseen", "nastyfresh"])
    assert not block < 256 or index.first[-1] > len(index.scale)


def test_toxic_texts_of_many_rare_words_are_found():
    """A lexicon of 60 words, each in about twelve of 720 examples: none goes far beyond chance."""
    rnd = random.Random(9)
    letters = "bcdfghjklmnprstvwz"
    lexicon = ["".join(rnd.choice(letters) for _ in range(7)) for _ in range(60)]
    plain = [f"word{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(300)]
    text = lambda bad: " ".join(rnd.choices(plain, k=40) + ([rnd.choice(lexicon), rnd.choice(lexicon)] if bad else []))
    examples = [(i, i % 2, text(i % 2)) for i in range(720)]
    index = index_of(examples, {0: 360, 1: 360})
    held = [(i % 2, text(i % 2)) for i in range(200)]
    score, rows, _ = index.score(*toxicity._counted(toxicity._Known(index), [t for _, t in held]), 200)
    assert set(rows.tolist()) == set(range(200))  # every text has neighbours
    assert sum(score[i] >= 0.5 for i, (y, _) in enumerate(held) if y) >= 80
    assert sum(score[i] >= 0.5 for i, (y, _) in enumerate(held) if not y) <= 20


def labelled(n=600):
    rnd = random.Random(7)
    docs, labels = [], []
    for i in range(n):
        bad = rnd.random() < 0.3
        words = [rnd.choice("abcdefgh") * rnd.randint(1, 4) for _ in range(30)]
        if bad:
            words[rnd.randrange(30)] = rnd.choice(["nastyword", "Nastyish!", "awfulthing"])
        docs.append((i, " ".join(words)))
        labels.append((i, 1, int(bad)))
    return docs, labels


def test_held_out_accuracy_and_evidence(spark):
    docs, labels = labelled()
    d = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    index = toxicity.fit(d, spark.createDataFrame(labels, "doc_id long, quality int, toxic int"))
    folds = {i: zlib.crc32(str(i).encode()) % 5 for i, _ in docs}
    assert all(folds[k] for k in index.keys.to_pylist())
    from pyspark.sql import functions as F

    rows = d.select("doc_id", toxicity.toxicity(F.col("text"), index, spark).alias("j"), toxicity.fold(F.col("doc_id")).alias("f")).collect()
    truth = {i: y for i, _, y in labels}
    assert all(r.f == folds[r.doc_id] for r in rows)
    held = [(truth[r.doc_id], r.j.score >= 0.5) for r in rows if r.f == 0]
    assert sum(a == b for a, b in held) > 0.97 * len(held)
    evidence = [truth[k] for r in rows if r.j.score >= 0.5 for k in r.j.neighbours]
    assert np.mean(evidence) > 0.9


def test_toxicity_edges(spark):
    from pyspark.sql import functions as F

    docs, labels = labelled(200)
    d = spark.createDataFrame(docs, "doc_id long, text string")
    odd = spark.createDataFrame([(1, None), (2, ""), (3, "!!"), (4, "x " * 50000), (4, "x " * 50000)], "doc_id long, text string")
    lab = spark.createDataFrame(labels + [(5, None, None), (None, 1, 1), (7, 1, 1), (999, 0, 1)], "doc_id long, quality int, toxic int")
    for y in (lab, lab.where("toxic = 0"), lab.limit(0)):
        index = toxicity.fit(d, y)
        scores = [r.j.score for r in odd.select(toxicity.toxicity(F.col("text"), index, spark).alias("j")).collect()]
        assert len(set(scores)) == 1 and 0 <= scores[0] < 0.5, scores
    assert odd.limit(0).select(toxicity.toxicity(F.col("text"), index, spark)).count() == 0


def test_terms():
    assert toxicity.words_of("don't!") == ["don", "t"] and toxicity.words_of("a1é") == ["a", "é"]
    assert toxicity.beginnings("awfulness") == ["awfu", "awful", "awfuln"] and toxicity.beginnings("awe") == []


def test_string_and_null_keys(spark):
    from pyspark.sql import functions as F

    docs, labels = labelled(200)
    d = spark.createDataFrame([(f"k{i}", t) for i, t in docs] + [(None, "plain")], "doc_id string, text string")
    lab = spark.createDataFrame([(f"k{i}", q, y) for i, q, y in labels] + [(None, 1, 1)], "doc_id string, quality int, toxic int")
    index = toxicity.fit(d, lab)
    rows = d.select("doc_id", toxicity.toxicity(F.col("text"), index, spark).alias("j")).collect()
    assert all(k in {r.doc_id for r in rows} for r in rows for k in r.j.neighbours) and len(rows) == 201


def test_toxicity_table(spark, sf):
    rows = {r.doc_id: r for r in toxicity.op3_toxicity(spark, sf).collect()}
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id").collect()
    assert set(rows) == {r.doc_id for r in docs}
    for r in rows.values():
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0)
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5)
    tally = Counter((r.toxic, rows[r.doc_id].predicted) for r in spark.read.parquet(f"{sf}/labels.parquet").collect())
    assert tally[0, 0] > 0.97 * (tally[0, 0] + tally[0, 1])
