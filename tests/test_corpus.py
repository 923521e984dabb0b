import json
import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as hs
from pyspark.sql import functions as F

from wordloom.operators import encode as en
from wordloom.operators import samples as sa
from wordloom.operators import vectors as ve
from wordloom.operators import vocab as vo
from wordloom.params import DEFAULT, TrainingPlan, require_rows
from wordloom.plans.jobs import build_training_set, rebuild_vocabulary
from wordloom.plans.standins import documents
from wordloom.session import checkpoint, scratch_path
from wordloom.sources import texts as tx
from wordloom.sources.vocab_store import import_json, load_vocabulary, save_settings, save_vocabulary

ONE = DEFAULT.updated(min_frequency=1)


def corpus(spark, texts, start=0):
    return spark.createDataFrame([(i + start, t) for i, t in enumerate(texts)], "doc_id long, text string").repartition(3)


def words(spark, texts, enc=ONE):
    v = vo.vocabulary(vo.word_counts(corpus(spark, texts), enc), enc)
    return v, {r.token: r.id for r in v.collect() if not r.is_special}


def test_ids_follow_first_occurrence(spark):
    _, ids = words(spark, ["b a b", "c a", "a d ."])
    assert ids == {"b": 4, "a": 5, "c": 6, "d": 7, ".": 8}


def test_binding_cap_orders_by_frequency(spark):
    texts = ["b a b", "c a", "a d ."]
    assert words(spark, texts, ONE.updated(max_vocab_size=7))[1] == {"a": 4, "b": 5, "c": 6}
    assert words(spark, texts, ONE.updated(max_vocab_size=9))[1] == {"b": 4, "a": 5, "c": 6, "d": 7, ".": 8}


def test_extreme_keys_keep_order(spark):
    df = spark.createDataFrame([(2**62, "z y"), (-(2**62), "x y"), (0, "w")], "doc_id long, text string")
    got = vo.vocabulary(vo.word_counts(df, ONE), ONE).where("not is_special").orderBy("id")
    assert [r.token for r in got.collect()] == ["x", "y", "w", "z"]


@pytest.mark.parametrize("partitions", ["1", "4", "200"])
def test_vocabulary_does_not_depend_on_partitions(spark, sf, partitions):
    old = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    try:
        rows = vo.vocabulary(vo.word_counts(documents(spark, sf), DEFAULT), DEFAULT).orderBy("id").collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
    assert [r.id for r in rows] == list(range(len(rows)))
    assert hash(tuple(r.token for r in rows)) == test_vocabulary_does_not_depend_on_partitions.__dict__.setdefault(
        "seen", hash(tuple(r.token for r in rows))
    )


def test_one_hot_token_and_tokenless_corpus(spark):
    _, ids = words(spark, ["the " * 500] * 40 + ["rare the"])
    assert ids == {"the": 4, "rare": 5}
    assert words(spark, ["", " \n"])[1] == {}


def test_encode_lengths(spark):
    v, _ = words(spark, ["a b c d e"])
    df = corpus(spark, ["a b c d e", "", "a zz"])

    def run(**kw):
        return [r.ids for r in en.encode(df, v, ONE, **kw).orderBy("doc_id").collect()]

    assert run() == [[2, 4, 5, 6, 7, 8, 3], [2, 3], [2, 4, 1, 3]]
    assert run(length=4) == [[2, 4, 5, 6], [2, 3, 0, 0], [2, 4, 1, 3]]
    assert run(special=False) == [[4, 5, 6, 7, 8], [], [4, 1]]


@pytest.mark.parametrize("limit", [0, 1, 7, 50])
def test_head_size_does_not_change_results(spark, limit):
    rnd = random.Random(limit)
    pool = [f"w{i}" for i in range(60)]
    texts = [" ".join(rnd.choices(pool, k=rnd.randint(0, 40))) for _ in range(30)] + ["", "w0 " * 300]
    v, _ = words(spark, texts, DEFAULT.updated(min_frequency=9))
    df = corpus(spark, texts + ["unseen w1 unseen"])
    small = en.encode(df, v, ONE)
    want = {r.doc_id: r.ids for r in small.collect()}
    assert {r.doc_id: r.ids for r in en.encode(df, v, ONE, limit=limit).collect()} == want
    for skip in ((0, 1, 2, 3), (0, 2, 3), ()):
        a = {r.doc_id: r.text for r in en.decode(small, v, skip=skip).collect()}
        b = {r.doc_id: r.text for r in en.decode(small, v, skip=skip, limit=limit).collect()}
        assert a == b


@pytest.mark.parametrize("limit", [0, 3, 100])
def test_decode_looks_ids_up(spark, limit):
    """Sparse ids, ids without a word, and a token that holds a line end."""
    known = {0: "<PAD>", 1: "<UNK>", 2: "<SOS>", 3: "<EOS>", 4: "a", 7: "b\nx", 9: "c"}
    v = spark.createDataFrame([(i, t, 1, i < 4) for i, t in known.items()], "id int, token string, n long, is_special boolean")
    df = spark.createDataFrame([(0, [4, 7, 9, 5, -1])], "doc_id long, ids array<int>")
    assert en.decode(df, v, limit=limit).first().text == "a b\nx c <UNK> <UNK>"


def test_decode(spark):
    v, _ = words(spark, ["a b"])
    df = spark.createDataFrame([(0, [2, 4, 1, 9999, 3])], "doc_id long, ids array<int>")
    assert en.decode(df, v).first().text == "a <UNK>"
    assert en.decode(df, v, skip=(0, 2, 3)).first().text == "a <UNK> <UNK>"
    assert en.decode(df, v, skip=(0, 1, 2, 3), default="?").first().text == "a ?"


@settings(max_examples=5, deadline=None)
@given(hs.lists(hs.text(alphabet="ab ,.-", max_size=25), min_size=1, max_size=20))
def test_round_trip_keeps_vocabulary_words(spark, texts):
    v, _ = words(spark, texts, DEFAULT.updated(min_frequency=2))
    assert en.self_check(corpus(spark, texts), v, ONE)


def test_reports(spark):
    v, _ = words(spark, ["a b"])
    df = corpus(spark, ["a x x", "", "a b"])
    rates = en.unknown_rates(df, v, ONE)
    assert [(r.tokens, r.known, r.unknown, r.unk_rate) for r in rates.orderBy("doc_id").collect()] == [(3, 1, 2, 2 / 3), (0, 0, 0, 0.0), (2, 2, 0, 0.0)]
    assert [r.doc_id for r in en.unknown_alerts(rates, 0.15).collect()] == [0]
    d = en.diagnose(df, v, ONE).first()
    assert (d.tokens, d.unknown, d.health, list(d.top_unknown), d.vocab_size) == (5, 2, "high", ["x"], 6)
    marks = en.annotate(df, v, ONE).where("doc_id = 0").orderBy("pos").collect()
    assert [(r.token, r.id, r.type) for r in marks] == [
        ("<SOS>", 2, "special"), ("a", 4, "known"), ("x", 1, "unknown"), ("x", 1, "unknown"), ("<EOS>", 3, "special"),
    ]


def test_pairs(spark):
    v, _ = words(spark, ["a b c"])
    pairs = spark.createDataFrame([(1, "a", "b c"), (2, "", "a"), (3, "a", "€"), (4, "a b c a b c", "c " * 9)], "ex_id long, prompt string, response string")
    got = {r.ex_id: r for r in sa.with_masks(sa.shifted(sa.pair_samples(pairs, v, ONE, 5), 5)).collect()}
    assert set(got) == {1, 4}
    assert (got[1].encoder_input, got[1].decoder_input, got[1].label) == ([4, 0, 0, 0, 0], [2, 5, 6, 0, 0], [5, 6, 0, 0, 3])
    assert (got[1].encoder_mask, got[1].decoder_mask) == ([1, 0, 0, 0, 0], [1, 1, 1, 0, 0])
    assert (got[4].encoder_input, got[4].label) == ([4, 5, 6, 4, 5], [6, 6, 6, 6, 3])
    sees = sa.decoder_allows(F.lit(1), F.col("c"), F.array(*map(F.lit, [2, 5, 0])))
    assert [r[0] for r in spark.createDataFrame([(0,), (1,), (2,)], "c int").orderBy("c").select(sees).collect()] == [True, True, False]


@pytest.mark.parametrize("n,count", [(0, 0), (31, 0), (32, 0), (33, 1), (48, 1), (49, 2), (64, 2)])
def test_window_count(spark, n, count):
    v, _ = words(spark, ["a"])
    got = sa.sliding_windows(corpus(spark, ["a " * n]), v, ONE, 16).collect()
    assert len(got) == count == len(range(0, n - 32, 16))
    assert all(len(r.src) == len(r.tgt) == 16 for r in got)


@pytest.mark.parametrize("n,v", [(90, 0.3), (170, 0.3), (10, 0.1), (1, 0.1), (1, 0.9)])
def test_split(spark, n, v):
    df = spark.range(n).withColumnRenamed("id", "k").repartition(3)
    assert sa.train_val_split(df, "k", v).where("split = 'train'").count() == int(n * (1 - v))


def test_batches(spark):
    df = spark.range(0, 2300, 100).withColumnRenamed("id", "k").repartition(4)
    got = sa.batched(df, 5, "k", bits=8).orderBy("k").collect()
    assert [(r.batch, r.slot) for r in got] == [(i // 5, i % 5) for i in range(20)]
    a, b = (sorted((r.batch, r.slot, r.k) for r in sa.shuffled_batches(df.repartition(p), 5, ["k"], 1).collect()) for p in (2, 7))
    assert a == b and len(a) == 20 and [k for *_, k in a] != sorted(k for *_, k in a)
    assert a != sorted((r.batch, r.slot, r.k) for r in sa.shuffled_batches(df, 5, ["k"], 2).collect())
    assert sa.step_budget(df, 5, 3).first()[:] == (23, 4, 12)


MESSAGES = "ex_id long, messages array<struct<content:string,reasoning:string>>"


def test_shapes(spark):
    shape = tx.detect_shape
    assert shape(["messages", "text"]) == "messages" and shape(["instruction", "output", "prompt"]) == "instruction"
    assert shape(["instruction", "prompt"]) == "preference" and shape(["question", "gold"]) == "qa"
    assert shape(["question", "text"]) == "text" and shape(["body"]) == "fallback"
    js = spark.createDataFrame([('{"messages":[]}',), ('{"question":1,"answer":2}',), ('{"question":1}',), ("{}",)], "j string")
    assert [r[0] for r in js.select(tx.row_shape(F.col("j"))).collect()] == ["messages", "qa", "fallback", "fallback"]

    m = spark.createDataFrame([(1, [("hi", None), ("", "why"), ("yo", "so")]), (2, [("", None)]), (3, None)], MESSAGES)
    assert [(r.ex_id, r.text) for r in tx.normalize(m).collect()] == [(1, "hi why yo so")]

    ins = spark.createDataFrame(
        [(1, " do ", " it ", "ok"), (2, " do ", "", "ok"), (3, "do", None, ""), (4, "", "x", "y"), (5, None, None, "z")],
        "ex_id long, instruction string, input string, output string",
    )
    assert [(r.ex_id, r.prompt) for r in tx.normalize(ins).collect()] == [(1, "do   it"), (2, " do "), (4, "x")]

    pref = spark.createDataFrame([(1, [("a",), (None,), ("b",)], "c"), (2, None, "c"), (3, [("a",)], None)], "ex_id long, prompt array<struct<content:string>>, chosen string")
    assert [(r.ex_id, r.prompt, r.response) for r in tx.normalize(pref).collect()] == [(1, "a  b", "c")]

    qa = spark.createDataFrame([(1, "q", "", "g"), (2, "q", "a", "g"), (3, None, "a", "g"), (4, "q", None, "")], "ex_id long, question string, answer string, gold string")
    assert [(r.ex_id, r.response) for r in tx.normalize(qa).collect()] == [(1, "g"), (2, "a")]

    fall = spark.createDataFrame(
        [(1, "u", [("x",), (None,)], 5, "v"), (2, None, None, 5, None), (3, "", None, 5, None)],
        "ex_id long, a string, l array<struct<value:string>>, n int, b string",
    )
    assert [(r.ex_id, r.text) for r in tx.normalize(fall).collect()] == [(1, "u x  v"), (3, "")]

    both = tx.normalize(ins).unionByName(tx.normalize(m))
    flat = tx.flatten_for_vocab(both).orderBy("flat_id", "side").collect()
    assert [(r.ex_id, r.side) for r in flat].count((1, 0)) == 2 and (1, 1) in [(r.ex_id, r.side) for r in flat]


def test_vocabulary_files(spark, tmp_path):
    v, ids = words(spark, ["a b a"])
    path = scratch_path(spark, "v")
    save_vocabulary(v, ONE, path)
    back, enc = load_vocabulary(spark, path)
    assert enc == ONE and sorted(back.collect()) == sorted(v.collect())
    assert save_settings(spark, path, {"min_frequency": 2, "junk": 1}).min_frequency == 2
    with pytest.raises(ValueError):
        save_settings(spark, path, {"min_frequency": 0})
    rows = spark.createDataFrame([(1, "a b a"), (2, "c")], "ex_id long, text string")
    assert {r.token for r in rebuild_vocabulary(spark, rows, path).where("not is_special").collect()} == {"a"}

    legacy = {"minFrequency": 3, "vocabSize": 6, "word2id": {"<PAD>": 0, "<UNK>": 1, "<SOS>": 2, "<EOS>": 3, **ids}, "id2word": {}}
    for name, extra, want in (("old", {}, 3), ("new", {"config": {**ONE.to_dict(), "other": 1}}, 1)):
        (tmp_path / name).write_text(json.dumps({**legacy, **extra}))
        words_, enc = import_json(spark, str(tmp_path / name))
        assert enc.min_frequency == want
        assert {r.token: r.id for r in words_.where("not is_special").collect()} == ids


@pytest.mark.parametrize("kind", ["pair", "text"])
def test_training_set(spark, kind):
    v, _ = words(spark, ["a b c"])
    if kind == "pair":
        rows = spark.createDataFrame([(i, "a b", "c") for i in range(40)], "ex_id long, prompt string, chosen string")
    else:
        rows = spark.createDataFrame([(i, "a b c " * 9) for i in range(40)], "ex_id long, text string")
    out = scratch_path(spark, "set")
    plan = TrainingPlan(batch_size=3, seq_length=4, val_split=0.25)
    build_training_set(spark, rows, v, plan, out, enc=ONE)
    per = 1 if kind == "pair" else len(range(0, 27 - 8, 4))
    for name, n in (("train", 30), ("val", 10)):
        got = spark.read.parquet(f"{out}/{name}")
        assert got.count() == n * per // 3 * 3
        assert got.groupBy("batch").count().where("count <> 3").isEmpty()
    with pytest.raises(ValueError):
        require_rows(rows.where("ex_id < 0"), "rows")
    with pytest.raises(ValueError):
        TrainingPlan(val_split=1.0).check()


def nearest(ids, x, k):
    x = x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-8)
    sim = np.round(x @ x.T, 9)
    np.fill_diagonal(sim, -9)
    return {(int(i), int(ids[j]), r + 1) for n, i in enumerate(ids) for r, j in enumerate(np.lexsort((ids, -sim[n]))[:k])}


@pytest.mark.parametrize("pivots", [None, 6, 30])
def test_neighbours_with_copies(spark, pivots):
    rng = np.random.default_rng(1)
    centres = rng.normal(size=(5, 8)) * 4
    x = np.concatenate([centres[rng.integers(0, 5, 120)] + rng.normal(size=(120, 8)) * 0.3, np.tile(centres[0], (70, 1))])
    ids = rng.permutation(len(x)) * 3
    df = spark.createDataFrame([(int(i), [float(a) for a in v]) for i, v in zip(ids, x)], "id long, v array<double>")
    got = {(r.id, r.neighbour, r["rank"]) for r in ve.knn_cosine(df, "id", "v", 3, block=40, pivots=pivots).collect()}
    assert got == nearest(ids, x, 3)


def test_the_pivot_tree_is_exact_and_compares_few_pairs(spark):
    rng = np.random.default_rng(4)
    centres = rng.normal(size=(40, 12))
    x = centres[rng.integers(0, 40, 4000)] + rng.normal(size=(4000, 12)) * 0.05
    x = np.concatenate([x, [np.zeros(12)], -centres[:3]])
    u = x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-8)
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(u)], "rep long, u array<double>").repartition(5)
    near, compared = ve.search(df, 3, block=200, pivots=64)
    got = {}
    for r in near.collect():
        got.setdefault(r.rep, []).append(r.sim)
    sim = u @ u.T
    np.fill_diagonal(sim, -9)
    want = -np.sort(-sim, axis=1)[:, :3]
    assert all(np.allclose(sorted(got[i], reverse=True), want[i], atol=1e-9) for i in range(len(u)))
    assert compared < 0.25 * len(u) ** 2


def test_few_vectors(spark):
    df = spark.createDataFrame([(1, [1.0, 0.0]), (2, [0.0, 0.0])], "id long, v array<double>")
    got = ve.knn_cosine(df, "id", "v", 3).collect()
    assert sorted((r.id, r.neighbour, r.sim) for r in got) == [(1, 2, 0.0), (2, 1, 0.0)]
    edges = spark.createDataFrame([(1, 2), (2, 1), (5, 2), (3, 1)], "id long, neighbour long")
    assert sorted(map(tuple, ve.undirected_edges(edges).collect())) == [(1, 2), (3, 1), (5, 2)]


def test_pca_and_map(spark):
    rng = np.random.default_rng(0)
    x = rng.normal(size=(60, 5)) * [9, 5, 3, 1, 1] + 7
    df = spark.createDataFrame([(i + 4, [float(a) for a in v]) for i, v in enumerate(x)], "id long, v array<double>")
    got = np.array([r[1:] for r in ve.pca(df, "id", "v").orderBy("id").collect()])
    c = x - x.mean(axis=0)
    axes = np.linalg.svd(c, full_matrices=False)[2][:3].T
    axes *= np.sign(axes[np.abs(axes).argmax(axis=0), range(3)])
    assert np.allclose(got, c @ axes, atol=1e-8)
    v, _ = words(spark, ["a b c"])
    nodes, edges = ve.word_map(df, v, "id", "v", words=20)
    rows = nodes.orderBy("id").collect()
    assert [r.word for r in rows[:4]] == ["a", "b", "c", "?"] and len(rows) == 20
    assert max(r.x for r in rows) == 1.0 and min(r.z for r in rows) == -1.0
    assert not edges.isEmpty()


@pytest.mark.parametrize("limit", [2, 1000])
def test_stream_takes_any_vocabulary(spark, tmp_path, limit):
    from wordloom.streaming import corpus as sc
    from wordloom.streaming import sources as ss

    df = corpus(spark, ["a b c", "", "c c zz", "d a"])
    v, _ = words(spark, ["a b c d e"])
    v = checkpoint(v)
    df.repartition(2).write.parquet(str(tmp_path / "in"))
    stream = ss.scan(spark, str(tmp_path / "in"), "doc_id long, text string")
    sc.write_encoded(stream, v, ONE, str(tmp_path / "out"), str(tmp_path / "mark"), limit=limit)
    got = {r.doc_id: r.ids for r in spark.read.parquet(str(tmp_path / "out")).collect()}
    assert got == {r.doc_id: r.ids for r in en.encode(df, v, ONE).collect()}


def test_a_comparison_holds_one_tile_of_pairs(spark):
    import tracemalloc

    import pyarrow as pa

    rng = np.random.default_rng(2)
    n, k = 6000, 3
    u = rng.normal(size=(n, 8))
    u /= np.linalg.norm(u, axis=1, keepdims=True)
    u[:20] = np.eye(8)[0]  # equal values: the smaller ids
    rows = pa.table({"rep": np.arange(n), "u": pa.array(list(u), pa.list_(pa.float64()))})
    tracemalloc.start()
    got = ve._best(rows, rows, k)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < n * n * 8 / 3  # all pairs in double precision: 288 MB
    sim = u @ u.T
    np.fill_diagonal(sim, -9)
    assert np.allclose(got["sim"].to_numpy().reshape(n, k), -np.sort(-sim, axis=1)[:, :k], atol=1e-12)
    assert got["nrep"].to_pylist()[:6] == [1, 2, 3, 0, 2, 3]


def test_ids_in_a_row_are_looked_up_without_an_index(monkeypatch):
    import pyarrow as pa

    items, known = pa.array([2, 0, 7, -1, None], pa.int32()), pa.array([0, 1, 2], pa.int32())
    assert en._places(items, pa.array([0, 2], pa.int32()), False).to_pylist() == [1, 0, None, None, None]
    monkeypatch.setattr(en.pc, "index_in", None)
    assert en._places(items, known, True).to_pylist() == [2, 0, None, None, None]


def test_annotations_make_no_array_of_rows(spark):
    v, enc = words(spark, ["a b b"])
    df = spark.createDataFrame([(1, "a zz b"), (2, ""), (3, None)], "doc_id long, text string")
    made = en.annotate(df, v, ONE)
    assert "transform" not in made._jdf.queryExecution().optimizedPlan().toString()
    got = sorted((r.doc_id, r.pos, r.token, r.type) for r in made.where("doc_id < 3").collect())
    sos, eos = ONE.special_tokens["sos"], ONE.special_tokens["eos"]
    assert got == [(1, 0, sos, "special"), (1, 1, "a", "known"), (1, 2, "zz", "unknown"), (1, 3, "b", "known"), (1, 4, eos, "special"), (2, 0, sos, "special"), (2, 1, eos, "special")]
    assert [tuple(r) for r in made.where("doc_id = 3").collect()] == [(3, None, None, None, None)]


@pytest.mark.parametrize("limit", [2, 1000])
def test_a_large_vocabulary_moves_no_texts(spark, limit):
    """Rows whose key repeats or is null, and words beyond the dictionary: looked up where the rows are."""
    v, _ = words(spark, ["a b c d e f g"])
    rows = [(None, "a b c d zz"), (None, "d c b a"), (1, "a b"), (1, "c d e f g"), (2, None), (3, "")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    coded = en.encode(df, checkpoint(v), ONE, limit=limit)
    back = en.decode(coded, v, skip=(0, 2, 3), limit=limit)
    lost = en.roundtrip_losses(df, v, ONE, length=3, limit=limit)
    for made in (coded, back, lost):
        plan = made._jdf.queryExecution().executedPlan().toString()
        assert "Exchange" not in plan and "Join" not in plan
    got = sorted((r.doc_id or 0, r.ids or [], r.text) for r in back.collect())
    assert got == [
        (0, [2, 4, 5, 6, 7, 1, 3], "a b c d <UNK>"), (0, [2, 7, 6, 5, 4, 3], "d c b a"),
        (1, [2, 4, 5, 3], "a b"), (1, [2, 6, 7, 8, 9, 10, 3], "c d e f g"), (2, [], None), (3, [2, 3], ""),
    ]
    assert sorted((r.doc_id or 0, r.token) for r in lost.collect()) == [(0, t) for t in "abcd"] + [(1, t) for t in "efg"]
    assert en.roundtrip_losses(df, v, ONE, limit=limit).isEmpty()


def test_the_driver_and_a_worker_hold_one_part_at_a_time(spark):
    import pickle

    import pyarrow as pa

    v, _ = words(spark, [" ".join(f"w{i}" for i in range(50))])
    parts = list(en._parts(v, 7))
    assert [len(k) for k, _ in parts] == [7] * 7 + [5]
    wide = pa.table({"token": ["x" * 100] * 1000, "id": range(1000)})
    assert len(pickle.dumps(en._columns(wide.slice(10, 5)), 5)) < 2000
    assert sorted((t, i) for k, n in parts for t, i in zip(k.to_pylist(), n.to_pylist())) == sorted((r.token, r.id) for r in v.collect())

    class Part:
        """A broadcast value as a worker has it: read when it is asked for."""

        _path = "here"

        def __init__(self, part):
            self.part = part

        @property
        def value(self):
            assert not any("_value" in vars(p) for p in shared)
            self._value = self.part
            return self._value

    shared = [Part(p) for p in parts]
    ids = {r.token: r.id for r in v.collect()}
    got = en._from_parts(pa.array(["w3", None, "w49", "w3", "x"]), shared, -1).to_pylist()
    assert got == [ids["w3"], -1, ids["w49"], ids["w3"], -1] and not any("_value" in vars(p) for p in shared)
