"""Sinks that survive a second run of a batch, mixed JSON lines, and counts over streams."""

import json

import pytest
from pyspark.sql import functions as F

from wordloom.operators.vocab import vocabulary, word_counts
from wordloom.params import DEFAULT, get_encoding
from wordloom.session import scratch_path
from wordloom.sources import telemetry as te
from wordloom.sources import texts as tx
from wordloom.streaming import corpus as sc
from wordloom.streaming import sources as ss
from wordloom.streaming import telemetry as stel

ROW = "run_id long, step long, epoch long, loss double, grad_norm double, accuracy double, lr double"


def test_a_batch_that_runs_again_counts_once(spark):
    path = scratch_path(spark, "sink")
    rows = lambda *steps: spark.createDataFrame([(1, s, 0, 0.123456, 1.0, 0.5, 1e-4) for s in steps], ROW)
    te.append_batch(rows(1, 2), path, 0)
    te.append_batch(rows(3), path, 1)
    te.append_batch(rows(1, 2), path, 0)
    # A batch that stopped before its line was written is not read.
    rows(9).write.parquet(f"{path}/rows/batch=2/attempt=lost")
    got = te.read_batches(spark, path).orderBy("step").collect()
    assert [r.step for r in got] == [1, 2, 3] and got[0].loss == 0.1235


def test_a_stream_goes_on_from_its_checkpoint(spark):
    src, path, mark = (scratch_path(spark, n) for n in ("arriving", "sink", "mark"))
    for lo in (0, 10):
        spark.createDataFrame([(1, s, 0, 1.0, 1.0, 0.5, 1e-4) for s in range(lo, lo + 10)], ROW).write.mode("append").parquet(src)
        te.write_batches(ss.scan(spark, src, ROW, files_per_trigger=1), path, mark)
        assert sorted(r.step for r in te.read_batches(spark, path).collect()) == list(range(lo + 10))


LINES = [
    ({"messages": [{"content": "a"}, {"content": None, "reasoning": "why"}, {"content": ""}], "text": "x"}, ("messages", "text", None, None, "a why")),
    ({"messages": [{"content": ""}]}, None),
    ({"instruction": "do", "input": " it ", "output": "done"}, ("instruction", "pair", "do  it", "done", None)),
    ({"instruction": "do", "input": None, "output": "done"}, ("instruction", "pair", "do", "done", None)),
    ({"instruction": "do", "output": ""}, None),
    ({"prompt": "p", "chosen": [{"content": "c"}, {"role": "u"}]}, ("preference", "pair", "p", "c ", None)),
    ({"prompt": [{"content": "p"}], "chosen": "c", "text": "t"}, ("preference", "pair", "p", "c", None)),
    ({"prompt": "p"}, None),
    ({"question": "q", "prediction": "", "answer": "yes", "gold": "no"}, ("qa", "pair", "q", "yes", None)),
    ({"question": 7, "gold": 8}, ("qa", "pair", "7", "8", None)),
    ({"text": "t", "n": 1}, ("text", "text", None, None, "t")),
    ({"text": ""}, None),
    ({"z": "last", "a": [{"value": "v"}, {"content": "w"}], "n": 3, "m": "more"}, ("fallback", "text", None, None, "last v w more")),
    ({"n": 3}, None),
]


def test_mixed_json_lines(spark):
    path = scratch_path(spark, "lines")
    lines = [json.dumps({"ex_id": i} | row) for i, (row, _) in enumerate(LINES)] + ["not json", "[1, 2]", ""]
    spark.createDataFrame([(x,) for x in lines], "js string").write.text(path)
    got = {r.ex_id: (r.shape, r.kind, r.prompt, r.response, r.text) for r in tx.normalize_mixed(tx.read_json_lines(spark, path)).collect()}
    assert got == {i: want for i, (_, want) in enumerate(LINES) if want}


@pytest.mark.parametrize("limit", [10, 1_000_000])
def test_unknown_counts_for_any_vocabulary(spark, limit):
    docs = spark.createDataFrame([(i, f"alpha beta w{i % 40} w{i % 7} rare{i}") for i in range(200)], "doc_id long, text string")
    enc = get_encoding("default")
    words = vocabulary(word_counts(docs, enc), enc)
    src, path, mark = (scratch_path(spark, n) for n in ("docs", "totals", "mark"))
    docs.repartition(3).write.parquet(src)
    stream = lambda: ss.scan(spark, src, "doc_id long, text string", files_per_trigger=1)
    sc.count_unknown(stream(), words, DEFAULT, path, mark, limit=limit)
    sc.count_unknown(stream(), words, DEFAULT, path, mark, limit=limit)  # nothing new has arrived
    got = sc.unknown_so_far(spark, path).first()
    assert (got.tokens, got.unknown) == (1000, 200)


def test_asof_values_on_a_stream(spark):
    src, out, mark = (scratch_path(spark, n) for n in ("rows", "out", "mark"))
    marks = [(1, 5, 0.5), (1, 40, 4.0), (1, 300, 30.0), (2, 7, 0.7)]
    rows = [(r, at) for r in (1, 2, 3) for at in (0, 5, 6, 7, 8, 39, 40, 41, 100, 299, 300, 301, 5000)]
    spark.createDataFrame(rows, "run_id long, event_id long").repartition(3).write.parquet(src)
    m = spark.createDataFrame(marks, "run_id long, event_id long, val_loss double")
    joined = stel.asof_static(ss.scan(spark, src, "run_id long, event_id long"), m, "run_id", "event_id", "val_loss", bits=4)
    ss.append_available(joined, out, mark)
    got = {(r.run_id, r.event_id): r.val_loss for r in spark.read.parquet(out).collect()}
    want = {(r, at): next((v for g, x, v in reversed(marks) if g == r and x < at), None) for r, at in rows}
    assert got == want and joined.select(F.col("val_loss")).columns == ["val_loss"]


def test_files_that_grow_are_read_once(spark):
    sink, n = scratch_path(spark, "sink"), 0
    cols = [c.split(" ")[0] for c in ROW.split(", ")]
    for batch, size in ((0, 2), (0, 2), (1, 5), (1, 5), (2, 5)):
        path = scratch_path(spark, "files")
        arrays = json.dumps({name: [float(i) for i in range(size)] for name in te.ARRAYS.values()})
        files = spark.createDataFrame([(1, 0, arrays), (2, 3, '{"trainLosses": [7.0]}'), (4, 0, "{}")], "run_id long, epoch long, value string")
        files.write.partitionBy("run_id", "epoch").text(path)
        rows = te.read_metrics_files(spark, path).withColumn("step", F.col("pos") + 1)
        te.append_new(rows.select(*cols), sink, batch)
        n = max(n, size)
        got = sorted((r.run_id, r.epoch, r.step, r.loss) for r in te.read_batches(spark, sink).collect())
        assert got == [(1, 0, i + 1, float(i)) for i in range(n)] + [(2, 3, 1, 7.0)]
    assert te.read_metrics_files(spark, path, since="2999-01-01T00:00:00").isEmpty()


def test_metrics_files_of_many_epochs(spark):
    path = scratch_path(spark, "lines")
    lines = [(1, json.dumps({"epoch": e, "trainLosses": [e + 0.5, e + 0.25]})) for e in range(30)] + [(2, '{"epoch": 4}')]
    spark.createDataFrame(lines, "run_id long, value string").coalesce(1).write.partitionBy("run_id").text(path)
    got = sorted((r.run_id, r.epoch, r.pos, r.loss) for r in te.read_metrics_files(spark, path, lines=True).collect())
    assert got == [(1, e, i, e + x) for e in range(30) for i, x in ((0, 0.5), (1, 0.25))]
    assert len(te.read_metrics_files(spark, path, lines=True).inputFiles()) == 2
    assert te.read_metrics_files(spark, path, since="2999-01-01T00:00:00", lines=True).isEmpty()


def test_a_run_is_folded_in_chunks():
    import numpy as np
    import pandas as pd

    at = np.random.default_rng(0).permutation(25_000)
    chunks = (pd.DataFrame({"at": at[i : i + 999], "loss": at[i : i + 999] / 2}) for i in range(0, len(at), 999))
    parts = list(stel._in_order(chunks, ["at", "loss"]))
    assert max(map(len, parts)) <= stel.CHUNK and [x for p in parts for x in p] == [(i, i / 2) for i in range(25_000)]
