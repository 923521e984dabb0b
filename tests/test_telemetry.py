import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from wordloom.operators import rolling as ro
from wordloom.operators import tuner as tu
from wordloom.operators.evaluation import best_epochs, throughput
from wordloom.session import checkpoint, scratch_path
from wordloom.sources.telemetry import append_steps, latest_state, read_steps, unfold
from wordloom.streaming import sources as ss
from wordloom.streaming import telemetry as stel

NAN, INF = math.nan, math.inf


def series(n, seed, nan_from=None):
    """n steps of (loss, grad, acc) on binary grids, with bad values and flat stretches."""
    rnd = random.Random(seed)
    out = []
    for i in range(1, n + 1):
        loss = rnd.randint(200, 260) / 64 if (i // 300) % 2 else rnd.randint(1, 640) / 64
        grad = 0.0 if (i // 150) % 3 == 0 and i % 4 else rnd.choice([0.5, 2.0, 12.0, 25.0])
        acc = min(1.0, (180 + ((i // 200) % 5 + 2 * (seed == 2)) * 15 + rnd.randint(0, 20)) / 256)
        if i % 173 == 0:
            loss = 60.0
        if i % 97 == 0:
            loss = NAN
        if i % 211 == 0:
            loss = INF
        if i % 89 == 0:
            grad = NAN
        if nan_from and nan_from <= i < nan_from + 4500:
            loss = NAN
        out.append((i, loss, grad, acc))
    return out


def buffers(steps, val=None):
    """The checks of every step, from buffers of the last 100 usable values."""
    losses, grads, accs, pairs, found = [], [], [], [], {}
    for i, loss, grad, acc in steps:
        losses += [loss] if math.isfinite(loss) else []
        grads += [] if math.isnan(grad) else [grad]
        accs.append(acc)
        pairs.append(0.0 if math.isnan(loss) else loss)
        tail = [b[-100:] for b in (losses, grads, accs, pairs)]
        found[i] = stel._fired(i, loss, grad, acc, *tail, val) if i >= 30 else []
    return found


@pytest.fixture(scope="module")
def runs():
    # The first run is longer than two blocks and has a long stretch without a usable loss.
    return {1: series(9500, 1, nan_from=4000), 2: series(700, 2), 3: series(25, 3)}


@pytest.fixture(scope="module")
def checked(spark, runs):
    data = [(r, *s, s[0] // 200) for r, steps in runs.items() for s in steps]
    df = spark.createDataFrame(data, "run_id long, step long, loss double, grad_norm double, accuracy double, epoch long")
    return checkpoint(ro.health_status(ro.all_checks(df.repartition(6), bits=12)))


def test_checks_equal_buffers(runs, checked):
    got = {(r.run_id, r.step): [c for c in ro.CHECKS if r[c]] for r in checked.collect()}
    for run, steps in runs.items():
        want = buffers(steps)
        wrong = [(run, i, got[run, i], want[i]) for i in want if got[run, i] != want[i]]
        assert not wrong, wrong[:3]
    seen = {c for cs in got.values() for c in cs}
    assert seen >= set(ro.CHECKS) - {"sft_overfitting", "overconfidence_divergence"}


def test_health(runs, checked):
    for r in checked.collect():
        bad = sum(not math.isfinite(s[1]) for s in runs[r.run_id][: r.step])
        assert r.nan_count == bad
        if r.step < 30:
            assert r.health == "warmup"
        elif bad > 5:
            assert r.health == "critical"


def test_stream_equals_batch(spark, runs, checked):
    """Several micro-batches, chunks of a few rows, a restart and a late row."""
    ss.use_rocksdb(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    schema = "run_id long, event_id long, loss double, grad_norm double, accuracy double, val_loss double"
    src, out, mark = (scratch_path(spark, n) for n in ("src", "out", "mark"))
    data = [(r, *s, None) for r, steps in runs.items() if r != 1 for s in steps]
    data += [(1, *s, None) for s in runs[1][:900]]

    def feed(rows):
        spark.createDataFrame(rows, schema).repartition(1).write.mode("append").parquet(src)

    def drain():
        ss.append_available(stel.health(ss.scan(spark, src, schema, files_per_trigger=1)), out, mark)

    try:
        early, late = [d for d in data if d[1] <= 333], [d for d in data if d[1] > 333]
        random.Random(0).shuffle(early)
        feed(early[: len(early)])
        drain()
        random.Random(1).shuffle(late)
        feed(late)
        feed([(2, 5, 1.0, 1.0, 1.0, None)])
        drain()
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    got = spark.read.parquet(out)
    assert [(r.run_id, r.event_id) for r in got.where("late").collect()] == [(2, 5)]
    snapshots = {(r.run_id, r.event_id): r for r in got.where("not late").collect()}
    assert len(snapshots) == len(data)

    replayed = checkpoint(tu.replay(checked))
    at = tu.settings_at(checked.select("run_id", "step"), replayed)
    for r in at.collect():
        if (r.run_id, r.step) in snapshots:
            s = snapshots[r.run_id, r.step]
            assert s.step == r.step
            assert tuple(s[c] for c in tu.SETTINGS) == tuple(r[c] for c in tu.SETTINGS)
    for r in replayed.collect():
        if (r.run_id, r.step) in snapshots:
            s = snapshots[r.run_id, r.step]
            assert (list(s.reasons), s.adjusted, s.adjustments) == (list(r.reasons), r.adjusted, r.adjustments)
    for r in checked.select("run_id", "step", "health").collect():
        if (r.run_id, r.step) in snapshots:
            assert snapshots[r.run_id, r.step].health == r.health


def test_tuner_reports(spark, checked):
    replayed = checkpoint(tu.replay(checked))
    done = tu.adjustments(replayed).orderBy("run_id", "step").collect()
    per_run = {}
    for r in done:
        per_run.setdefault(r.run_id, []).append(r)
        assert set(r.changes) == set(r.before)
    recent = tu.recent_adjustments(replayed).collect()
    for run, rows in per_run.items():
        assert sorted(x.step for x in recent if x.run_id == run) == [x.step for x in rows[-10:]]
        assert [x.adjustments for x in rows] == list(range(1, len(rows) + 1))
    table = {r.run_id: r for r in tu.summary(checked, replayed).collect()}
    for run, rows in per_run.items():
        assert table[run].adjustments == len(rows)
        assert tuple(table[run][s] for s in tu.SETTINGS) == tuple(rows[-1][s] for s in tu.SETTINGS)
    assert table[3].adjustments == 0 and table[3].scale == 1.0 and table[3].steps == 25
    assert table[3].health == "warmup"
    last = {r.run_id: r.health for r in ro.health_status(checked).collect() if r.step == table[r.run_id].steps}
    assert {run: r.health for run, r in table.items()} == last
    counts = {(r.run_id, r.reason): r.n for r in tu.reason_counts(replayed).collect()}
    assert sum(counts.values()) == sum(len(r.reasons) for r in done)
    lr = tu.effective_lr(checked.select("run_id", "step", F.lit(2.0).alias("lr")), replayed)
    first = per_run[2][0]
    got = {r.step: r for r in lr.where("run_id = 2").collect()}
    assert got[first.step].lr_scale == 1.0 and got[first.step + 1].effective_lr == 2.0 * first.scale


def test_decisions_by_hand():
    t = tu.Tuner()
    # Explosion then vanishing in one step: the later finding wins on both settings.
    assert t.decide(30, ["gradient_explosion", "gradient_vanishing"])[1] == {"clip": 1.32, "scale": 1.15}
    assert t.before == {"clip": 1.1, "scale": 1.0}
    # Resting: nothing happens, but the finding is reported.
    assert t.decide(100, ["loss_plateau"]) == (["loss_plateau"], {})
    # An emergency applies everything that is due in that step.
    assert t.decide(120, ["accuracy_stall", "nan_loss_critical"])[1] == {"smoothing": 0.18, "scale": 0.575, "clip": 0.66}
    assert t.last == 120
    assert t.decide(319, ["loss_plateau"])[1] == {}
    assert t.decide(320, ["loss_plateau"])[1] == {"scale": 0.6325}


def test_chain_moves_on_at_the_cap():
    t = tu.Tuner(smoothing=0.3)
    chain = list(tu.CHAIN)
    assert t.decide(30, chain) == (chain, {})
    t.smoothing = 0.29
    assert t.decide(31, chain) == (chain[:1], {"smoothing": 0.3})
    assert tu.Tuner(dropout=0.48).decide(40, ["sft_overfitting"])[1] == {"dropout": 0.5}
    assert tu.Tuner(scale=0.06).decide(40, ["nan_loss_critical"])[1]["scale"] == 0.05
    assert tu.Tuner(scale=3.0).decide(40, ["loss_plateau"])[1] == {}


@pytest.mark.parametrize("bits", [4, 7])
def test_windows_do_not_depend_on_blocks(spark, runs, bits):
    """Blocks far shorter than a window, and stretches of blocks without a usable value."""
    steps = [(1, *x) for x in runs[1][3800:5200]]
    steps = [(r, i + 1, NAN if i > 200 and i < 700 else x[2], x[3], x[4], 0) for i, x in enumerate(steps) for r in [1]]
    steps += [(2, *x, 0) for x in runs[2]] + [(3, 1, NAN, NAN, 0.5, 0), (3, 2, None, 1.0, 0.5, 0)]
    df = spark.createDataFrame(steps, "run_id long, step long, loss double, grad_norm double, accuracy double, epoch long").repartition(5)
    one, other = (
        {(r.run_id, r.step): r for r in ro.windows(df, "loss", "grad", "step", bits=b).collect()} for b in (bits, 16)
    )
    assert set(one) == set(other) == {(x[0], x[1]) for x in steps}
    for key, row in one.items():
        for name, value in row.asDict().items():
            assert value == other[key][name] or (value != value and other[key][name] != other[key][name]), (key, name)
    assert one[3, 1].n_loss is None and one[3, 2].nan_count == 1 and one[3, 2].n_grad == 1


def test_all_checks_take_few_exchanges(spark, runs):
    data = [(r, *s, s[0] // 200) for r, steps in runs.items() for s in steps[:300]]
    path = scratch_path(spark, "plan-steps")
    schema = "run_id long, step long, loss double, grad_norm double, accuracy double, epoch long"
    spark.createDataFrame(data, schema).write.parquet(path)
    df = ro.health_status(ro.all_checks(spark.read.parquet(path)))
    df.collect()
    final = df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    lines = [x.strip(" +-:*()0123456789") for x in final.splitlines()]
    assert sum(x.startswith("Exchange") for x in lines) <= 4 and sum("ReusedExchange" in x for x in lines) == 1
    assert sum("FileScan" in x or "Scan parquet" in x for x in lines) == 1


def fold(flags):
    """The log of one run by the plain loop over its flagged steps."""
    t, out = tu.Tuner(), []
    for step, fired in flags:
        found, changes = t.decide(step, fired)
        out.append((step, found, bool(changes), changes, t.before if changes else {}, *t.settings(), t.count))
    return out


def random_flags(rnd, n, weights):
    every = []
    for step in range(1, n + 1):
        fired = [c for c in tu.CHECKS if rnd.random() < weights.get(c, 0.0)]
        if fired and step >= 30:
            every.append((step, fired))
    return every


@pytest.mark.parametrize("bits", [5, 8, 16])
def test_replay_equals_the_fold(spark, bits):
    rnd = random.Random(bits)
    kinds = [
        {"gradient_vanishing": 1.0},  # always due, until both settings are at their limit
        {"gradient_vanishing": 0.6, "gradient_explosion": 0.3, "gradient_spike": 0.1, "accuracy_stall": 0.2, "overconfidence_early": 0.3},
        {"loss_plateau": 0.02, "accuracy_degrading": 0.02, "loss_spike": 0.004, "nan_loss_critical": 0.002, "sft_overfitting": 0.05},
        {c: 0.3 for c in tu.CHAIN} | {"accuracy_stall": 0.1},
        {"overconfidence_high_acc": 0.001},
    ]
    runs = {i: random_flags(rnd, 3000, k) for i, k in enumerate(kinds)}
    runs[9] = [(2900, ["loss_plateau"])]
    data = [(r, s, *[c in fired for c in tu.CHECKS]) for r, flags in runs.items() for s, fired in flags]
    df = spark.createDataFrame(data, "run_id long, step long, " + ", ".join(f"{c} boolean" for c in tu.CHECKS)).repartition(5)
    got = {}
    for r in sorted(tu.replay(df, bits=bits).collect(), key=lambda r: r.step):
        got.setdefault(r.run_id, []).append((r.step, list(r.reasons), r.adjusted, r.changes, r.before, r.clip, r.scale, r.smoothing, r.dropout, r.adjustments))
    for run, flags in runs.items():
        assert got[run] == fold(flags), run
    assert tu.replay(df.limit(0)).count() == 0


@pytest.mark.parametrize("bits", [6, 16])
def test_rounded_average_equals_the_loop(spark, bits):
    rnd = random.Random(bits)
    runs = {
        1: [round(rnd.random() * 9, 3) for _ in range(700)],
        2: [2.5] * 300 + [2.5001] * 300 + [rnd.random() * 1e-3 for _ in range(100)],  # starts that never meet
        3: [rnd.gauss(0, 1e6) for _ in range(300)],
        4: [1.0] * 100 + [INF] + [1.0] * 100 + [-INF, 1.0],
        5: [1.0] * 130 + [NAN] + [1.0] * 50,
        6: [0.12345],
    }
    data = [(r, i + 1, v) for r, values in runs.items() for i, v in enumerate(values)]
    df = spark.createDataFrame(data, "run_id long, step long, loss double").repartition(4)
    got = {}
    for r in sorted(ro.ema(df, digits=4, bits=bits).collect(), key=lambda r: r.step):
        got.setdefault(r.run_id, []).append(r.ema)
    for run, values in runs.items():
        want, e = [], None
        for v in values:
            e = round(v if e is None else 0.95 * e + (1 - 0.95) * v, 4)
            want.append(e)
        assert str(got[run]) == str(want), run
    assert ro.ema(df, digits=4).columns == ["run_id", "step", "loss", "ema"]


@pytest.mark.parametrize("keep", [0.5, 0.95, 0.999])
def test_ema_any_length(spark, keep):
    rnd = random.Random(5)
    values = [rnd.random() * 10 ** rnd.randint(-3, 6) for _ in range(3000)]
    want, e = [], None
    for v in values:
        e = v if e is None else keep * e + (1 - keep) * v
        want.append(e)
    df = spark.createDataFrame([(1, i + 1, v) for i, v in enumerate(values)], "run_id long, step long, loss double")
    got = [r.ema for r in ro.ema(df.repartition(4), keep=keep, bits=8).orderBy("step").collect()]
    assert np.allclose(got, want, rtol=1e-9)


def test_ema_keeps_bad_values(spark):
    data = [(1, i, NAN if i == 3 else 1.0) for i in range(1, 20001, 1)]
    data += [(2, i, INF if i == 2 else -INF if i == 5 else 1.0) for i in range(1, 8)]
    df = spark.createDataFrame(data, "run_id long, step long, loss double")
    got = ro.ema(df, bits=12)
    assert got.where("run_id = 1 and not isnan(ema)").count() == 2
    two = [r.ema for r in got.where("run_id = 2").orderBy("step").collect()]
    assert two[0] == 1.0 and two[1:4] == [INF] * 3 and all(map(math.isnan, two[4:]))


def test_stream_ema_rounded(spark):
    ss.use_rocksdb(spark)
    src, out, mark = (scratch_path(spark, n) for n in ("src", "out", "mark"))
    rnd = random.Random(2)
    values = [round(rnd.random() * 9, 2) for _ in range(150)]
    schema = "run_id long, event_id long, loss double"
    spark.createDataFrame([(1, i, v) for i, v in enumerate(values)], schema).repartition(3).write.parquet(src)
    ss.append_available(stel.ema(ss.scan(spark, src, schema), digits=4), out, mark)
    want, e = [], None
    for v in values:
        e = round(v if e is None else 0.95 * e + (1 - 0.95) * v, 4)
        want.append(e)
    assert [r.ema for r in spark.read.parquet(out).orderBy("event_id").collect()] == want


def test_schedule(spark):
    lr = ro.learning_rate(F.col("id"), 5e-4, 1e-5, 500, F.lit(1000))
    got = [r[0] for r in spark.range(0, 1501).orderBy("id").select(lr).collect()]
    assert got[0] == 0 and got[250] == 2.5e-4 and got[500] == 5e-4
    assert got[750] == pytest.approx((5e-4 + 1e-5) / 2) and got[1000] == pytest.approx(1e-5) and got[1500] == got[1000]


def test_best_epochs(spark):
    data = [(1, e, v) for e, v in enumerate([5.0, 4.0, 4.0, 6.0, 3.0])] + [(2, 0, NAN)]
    df = spark.createDataFrame(data, "run_id long, epoch long, val_loss double")
    got = {(r.run_id, r.epoch) for r in best_epochs(df).where("is_best").collect()}
    assert got == {(1, 0), (1, 1), (1, 4)}


def test_throughput(spark):
    data = [(1, 0, s, (s - 1) * 2_000_000) for s in range(1, 6)]
    df = spark.createDataFrame(data, "run_id long, epoch long, step long, t long")
    got = throughput(df, F.lit(100).cast("long"), F.col("t")).orderBy("step").collect()
    assert [r.tokens_per_second for r in got] == [100.0] + [100 * s / (2.0 * (s - 1)) for s in range(2, 6)]
    assert [r.batch_time for r in got] == [2.0 * (s - 1) / s for s in range(1, 6)]


def test_sinks_and_files(spark):
    path = scratch_path(spark, "steps")
    row = (1, 1, 0, 1.234567, 0.1, 0.5, 1.23456789e-4)
    schema = "run_id long, step long, epoch long, loss double, grad_norm double, accuracy double, lr double"
    for step in (1, 2):
        append_steps(spark.createDataFrame([(1, step) + row[2:]], schema), path)
    got = read_steps(spark, path).orderBy("step").collect()
    assert [r.step for r in got] == [1, 2] and got[0].loss == 1.2346 and got[0].lr == 0.00012346
    js = '{"trainLosses":[1.0,2.0],"gradNorms":[3.0],"x":1}'
    files = spark.createDataFrame([(7, js), (8, "{}")], "f long, js string")
    flat = unfold(files, F.col("js"), ["f"], ("loss", "grad_norm")).orderBy("pos").collect()
    assert [(r.f, r.pos, r.loss, r.grad_norm) for r in flat] == [(7, 0, 1.0, 3.0), (7, 1, 2.0, None)]
    states = spark.createDataFrame([(1, 5, "a"), (1, 9, "b")], "run_id long, step long, health string")
    last = latest_state(states, spark.range(1, 3).withColumnRenamed("id", "run_id"), {"step": 0, "health": "unknown"})
    assert sorted((r.run_id, r.step, r.health) for r in last.collect()) == [(1, 9, "b"), (2, 0, "unknown")]
