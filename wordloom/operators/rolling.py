"""Rolling checks over step metrics, for runs of any length.

Steps are (run_id, step, epoch, loss, grad_norm, accuracy) with a dense 1-based LONG step per
run. Windows follow the metrics that were usable: losses skip NaN and infinities, gradient
norms skip NaN, accuracies and (accuracy, loss) pairs take every step with a NaN loss as 0.
"""

from __future__ import annotations

import math
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wordloom.operators import blocks

# Window lengths and thresholds of the checks.
WINDOW = 100
WARMUP = 30
RECENT = 20
GRAD_HIGH, GRAD_HIGH_SHARE, GRAD_SPIKE = 10.0, 0.3, 20.0
GRAD_LOW, GRAD_LOW_SHARE = 1e-4, 0.5
PLATEAU_MIN, PLATEAU_GAIN = 50, 0.002
ACC_MIN, ACC_GAIN, ACC_LOSS = 80, 0.001, -0.01
PAIR_SPAN, PAIR_ACC, PAIR_GAIN = 60, 0.85, 0.005  # the newer half, 30 steps, also feeds the risk
PAIR_RISE, PAIR_LOSS_RISE = 0.005, 1.01
EARLY_STEPS, EARLY_ACC = 500, 0.90
SPIKE_MIN, SPIKE_RATIO = 10, 3.0
RISK_SPAN, RISK_EDGE, RISK_ACC = 30, 15, 0.5
OVERFIT_RATIO, OVERFIT_ACC = 1.15, 0.4
NAN_LIMIT = 5
CAPACITY_LOSS, CAPACITY_EPOCH = 4.5, 2
ENTROPY_LOW, ENTROPY_HIGH, MEMORY_HIGH = 1.5, 5.0, 14.0


def _finite(c: Column) -> Column:
    return ~(F.isnan(c) | (c == F.lit(math.inf)) | (c == F.lit(-math.inf)))


def _gt(a: Column, b) -> Column:
    """a > b where a NaN on the left is not greater than anything."""
    return (a > b) & ~F.isnan(a)


def _flag(c: Column) -> Column:
    return F.coalesce(c, F.lit(False))


def _numbers(rows: pa.Table, name: str) -> np.ndarray:
    """A metric as doubles; a null is NaN."""
    return rows[name].combine_chunks().cast(pa.float64()).to_numpy(zero_copy_only=False).astype(np.float64)


def _usable(family: str, rows: pa.Table) -> tuple[np.ndarray, list[np.ndarray]]:
    """Which rows a family of windows takes, and its values on them."""
    if family == "loss":
        loss = _numbers(rows, "loss")
        keep = np.isfinite(loss)
        return keep, [loss[keep]]
    if family == "grad":
        grad = _numbers(rows, "grad_norm")
        keep = ~np.isnan(grad)
        return keep, [grad[keep]]
    loss = _numbers(rows, "loss")
    return np.ones(len(loss), bool), [_numbers(rows, "accuracy"), np.where(np.isnan(loss), 0.0, loss)]


class _Frames:
    """The last 100 values at every place from `first` on, as rows of a view, zeros in front."""

    def __init__(self, values: np.ndarray, first: int):
        self.values, self.first = values, first
        self.view = self._view(values, 0.0)
        self.n = np.minimum(np.arange(first, len(values)) + 1, WINDOW)

    def _view(self, values: np.ndarray, front: float) -> np.ndarray:
        if not len(values):
            return np.zeros((0, WINDOW))
        padded = np.concatenate([np.full(WINDOW - 1, front), values])
        return np.lib.stride_tricks.sliding_window_view(padded, WINDOW)[self.first : len(values)]

    def mean(self, start: int = 1 - WINDOW, end: int = 0) -> np.ma.MaskedArray:
        """Mean of the values at the offsets start..end; masked where there is none."""
        n = np.clip(self.n + end, 0, end - start + 1)
        total = self.view[:, WINDOW - 1 + start : WINDOW + end].sum(axis=1)
        return np.ma.masked_array(total / np.maximum(n, 1), n == 0)

    def share(self, over, span: int) -> np.ndarray:
        """Share of the last `span` values that satisfy `over`, which holds for no filler."""
        seen = self._view(over(self.values).astype(np.float64), 0.0)
        return seen[:, -span:].sum(axis=1) / np.minimum(self.n, span)

    def extreme(self, reduce, front: float, span: int = WINDOW) -> np.ndarray:
        return reduce(self._view(self.values, front)[:, -span:], axis=1)

    def short(self, whole: np.ma.MaskedArray, part) -> np.ma.MaskedArray:
        """`whole`, but `part(values)` where there are fewer than 100: at the first 99 of a run."""
        for i in np.flatnonzero(self.n < WINDOW).tolist():
            values = part(self.values[: self.first + i + 1])
            whole[i] = values.mean() if len(values) else np.ma.masked
        return whole

    def halves(self) -> tuple[np.ma.MaskedArray, np.ma.MaskedArray]:
        """Means of the older and newer half; the older one of an odd number is the shorter."""
        half = WINDOW // 2
        return (
            self.short(self.mean(1 - WINDOW, -half), lambda v: v[: len(v) // 2]),
            self.short(self.mean(1 - half, 0), lambda v: v[len(v) // 2 :]),
        )


def _loss_frames(f: _Frames) -> dict:
    older, newer = f.halves()
    return {
        "n_loss": f.n,
        "loss_older": older,
        "loss_newer": newer,
        "loss_early": f.short(f.mean(1 - WINDOW, RISK_EDGE - WINDOW), lambda v: v[:RISK_EDGE]),
        "loss_late": f.mean(1 - RISK_EDGE),
        "loss_recent": f.mean(1 - RECENT),
        "avg_loss": f.mean(),
    }


def _grad_frames(f: _Frames) -> dict:
    return {
        "n_grad": f.n,
        "grad_high_share": f.share(lambda g: g > GRAD_HIGH, RECENT),
        "grad_low_share": f.share(lambda g: g < GRAD_LOW, RECENT),
        "grad_recent_max": f.extreme(np.max, -math.inf, RECENT),
        "avg_grad": f.mean(),
        "max_grad": f.extreme(np.max, -math.inf),
        "min_grad": f.extreme(np.min, math.inf),
    }


def _step_frames(accuracy: _Frames, loss: _Frames) -> dict:
    older, newer = accuracy.halves()
    before, after = (1 - PAIR_SPAN, -PAIR_SPAN // 2), (1 - PAIR_SPAN // 2, 0)
    return {
        "n_acc": accuracy.n,
        "acc_older": older,
        "acc_newer": newer,
        "avg_accuracy": accuracy.mean(),
        "pair_acc_a": accuracy.mean(*before),
        "pair_acc_b": accuracy.mean(*after),
        "pair_loss_a": loss.mean(*before),
        "pair_loss_b": loss.mean(*after),
    }


_FRAMES = {"loss": _loss_frames, "grad": _grad_frames, "step": _step_frames}
_LISTS = {"loss": ["_loss"], "grad": ["_grad"], "step": ["_acc", "_pair"]}
_MADE = {
    "loss": ["n_loss", "loss_older", "loss_newer", "loss_early", "loss_late", "loss_recent", "avg_loss"],
    "grad": ["n_grad", "grad_high_share", "grad_low_share", "grad_recent_max", "avg_grad", "max_grad", "min_grad"],
    "step": ["n_acc", "acc_older", "acc_newer", "avg_accuracy", "pair_acc_a", "pair_acc_b", "pair_loss_a", "pair_loss_b"],
}


def _column(values, shown: np.ndarray, at: np.ndarray, kind: pa.DataType) -> pa.Array:
    """Values of the usable rows on every row: each repeats the last usable one, null before."""
    data, hidden = np.ma.getdata(values), np.ma.getmaskarray(values)
    if not len(data):
        return pa.nulls(len(shown), kind)
    at = np.maximum(at, 0)
    return pa.array(data[at], kind, mask=~shown | hidden[at])


def windows(steps: DataFrame, *families: str, bits: int = blocks.BITS) -> DataFrame:
    """Add the windows of the named families (`loss`, `grad`, `step`) and `nan_count`, the bad losses
    so far, in one pass over blocks.

    What a block needs of the rows before it are the last 100 usable values of each family and the
    count of bad losses: a summary that two neighbouring blocks merge into one of the same size, so
    long stretches without usable values cost nothing. Inside a block every window is a row of a
    strided view, summed on its own: no running sums, whose rounding would drift.
    """
    lists = [name for f in families for name in _LISTS[f]]
    tail = WINDOW

    def summarise(rows: pa.Table) -> dict:
        out = {"_bad": _bad(rows)}
        for f in families:
            for name, values in zip(_LISTS[f], _usable(f, rows)[1]):
                out[name] = values[-tail:].tolist()
        return out

    def link(state: dict | None, own: dict) -> tuple[dict, dict]:
        before = state or {"_bad": 0} | {name: [] for name in lists}
        after = {name: (before[name] + own[name])[-tail:] for name in lists}
        return before, after | {"_bad": before["_bad"] + own["_bad"]}

    def finish(rows: pa.Table, carry: dict) -> pa.Table:
        bad = carry["_bad"] + np.cumsum(_bad_rows(rows))
        for f in families:
            keep, values = _usable(f, rows)
            known = [np.array(carry[name], np.float64) for name in _LISTS[f]]
            # A row that is not usable repeats the last usable one, maybe of an earlier block.
            first = max(0, len(known[0]) - 1)
            frames = _FRAMES[f](*[_Frames(np.concatenate(pair), first) for pair in zip(known, values)])
            at = len(known[0]) - 1 - first + np.cumsum(keep)
            for name in _MADE[f]:
                kind = pa.int32() if name.startswith("n_") else pa.float64()
                rows = rows.append_column(name, _column(frames[name], at >= 0, at, kind))
        return rows.append_column("nan_count", pa.array(bad, pa.int64()))

    fields = ", ".join(["_bad long"] + [f"{name} array<double>" for name in lists])
    made = ", ".join(f"{n} {'int' if n.startswith('n_') else 'double'}" for f in families for n in _MADE[f])
    return blocks.scan(steps, "run_id", "step", summarise, link, finish, fields, fields, ", ".join([made, "nan_count long"] if made else ["nan_count long"]), bits)


def _bad_rows(rows: pa.Table) -> np.ndarray:
    known = ~rows["loss"].combine_chunks().is_null().to_numpy(zero_copy_only=False)
    return known & ~np.isfinite(_numbers(rows, "loss"))


def _bad(rows: pa.Table) -> int:
    return int(_bad_rows(rows).sum())


def _warm() -> Column:
    return F.col("step") >= WARMUP


def gradient_checks() -> dict[str, Column]:
    ready = _warm() & (F.col("n_grad") >= RECENT)
    burst = F.col("grad_high_share") > GRAD_HIGH_SHARE
    return {
        "gradient_explosion": _flag(ready & burst),
        "gradient_spike": _flag(ready & ~burst & (F.col("grad_recent_max") > GRAD_SPIKE)),
        "gradient_vanishing": _flag(ready & (F.col("grad_low_share") > GRAD_LOW_SHARE)),
    }


def plateau_checks() -> dict[str, Column]:
    a, b = F.col("loss_older"), F.col("loss_newer")
    gain = F.when(a > 0, (a - b) / a).otherwise(0.0)
    ready = _warm() & (F.col("n_loss") >= PLATEAU_MIN)
    return {"loss_plateau": _flag(ready & (gain >= 0) & (gain < PLATEAU_GAIN))}


def accuracy_checks() -> dict[str, Column]:
    gain = F.col("acc_newer") - F.col("acc_older")
    ready = _warm() & (F.col("n_acc") >= ACC_MIN) & ~F.isnan(gain)
    return {
        "accuracy_stall": _flag(ready & (gain >= 0) & (gain < ACC_GAIN)),
        "accuracy_degrading": _flag(ready & (gain < ACC_LOSS)),
    }


def overconfidence_checks() -> dict[str, Column]:
    """The three patterns on their own; which of them is acted on depends on the tuner state."""
    a, b = F.col("pair_loss_a"), F.col("pair_loss_b")
    gain = F.when(a > 0, (a - b) / a).otherwise(0.0)
    ready = _warm() & (F.col("n_acc") >= PAIR_SPAN)
    flat = (gain < PAIR_GAIN) & ~F.isnan(gain)
    rising = _gt(F.col("pair_acc_b"), F.col("pair_acc_a") + PAIR_RISE)
    return {
        "overconfidence_high_acc": _flag(ready & _gt(F.col("pair_acc_b"), PAIR_ACC) & flat),
        "overconfidence_divergence": _flag(ready & rising & (b > a * PAIR_LOSS_RISE)),
        "overconfidence_early": _flag(ready & (F.col("step") < EARLY_STEPS) & _gt(F.col("pair_acc_b"), EARLY_ACC)),
    }


def divergence_checks() -> dict[str, Column]:
    ready = _warm() & (F.col("n_loss") >= SPIKE_MIN)
    fine = _finite(F.col("loss"))
    return {
        "nan_loss_critical": _flag(ready & ~fine),
        "loss_spike": _flag(
            ready & fine & (F.col("loss_recent") > 0) & (F.col("loss") > F.col("loss_recent") * SPIKE_RATIO)
        ),
    }


def overfit_checks() -> dict[str, Column]:
    """Needs `val_loss`, the latest validation loss known at the step."""
    gap = _gt(F.col("val_loss"), F.col("loss") * OVERFIT_RATIO)
    return {"sft_overfitting": _flag(_warm() & gap & _gt(F.col("accuracy"), OVERFIT_ACC))}


def gradient_flags(steps: DataFrame) -> DataFrame:
    return windows(steps, "grad").withColumns(gradient_checks())


def plateau_flags(steps: DataFrame) -> DataFrame:
    return windows(steps, "loss").withColumns(plateau_checks())


def spike_flags(steps: DataFrame) -> DataFrame:
    return windows(steps, "loss").withColumns(divergence_checks())


def accuracy_trend(steps: DataFrame) -> DataFrame:
    return windows(steps, "step").withColumns(accuracy_checks())


def overconfidence_flags(steps: DataFrame) -> DataFrame:
    return windows(steps, "step").withColumns(overconfidence_checks())


def overconfidence_risk(steps: DataFrame) -> DataFrame:
    """Add `risk` in [0, 1]: recent accuracy above one half, times lack of loss progress."""
    return windows(steps, "loss", "step").withColumn("risk", risk_score())


def risk_score() -> Column:
    sure = F.greatest(F.lit(0.0), F.col("pair_acc_b") - RISK_ACC) / 0.5
    early, late = F.col("loss_early"), F.col("loss_late")
    stuck = F.when((F.col("n_loss") >= RISK_SPAN) & (early > 0), F.greatest(F.lit(0.0), 1 - (early - late) / early))
    score = F.least(sure * F.coalesce(stuck, F.lit(0.0)), F.lit(1.0))
    return F.when(F.col("n_acc") >= RISK_SPAN, score).otherwise(0.0)


def rolling_diagnostics(steps: DataFrame) -> DataFrame:
    """Add the means and extremes of the last 100 usable values, 0 while there are none."""
    wide = windows(steps, "loss", "grad", "step")
    cols = ("avg_loss", "avg_grad", "avg_accuracy", "max_grad", "min_grad")
    return wide.withColumns({c: F.coalesce(F.col(c), F.lit(0.0)) for c in cols})


def recommendations(steps: DataFrame) -> DataFrame:
    """(run_id, step, param, action, reason): advice from loss, epoch, attention entropy and memory.

    Expects `current_epoch`, `attn_entropy` and `memory_gb` as known at the step.
    """

    def advice(when, param, action, reason):
        said = reason if isinstance(reason, Column) else F.lit(reason)
        return F.when(when, F.struct(F.lit(param).alias("param"), F.lit(action).alias("action"), said.alias("reason")))

    def told(text, value, digits):
        return F.format_string(text.replace("#", f"%.{digits}f"), value)

    ent, memory = F.coalesce("attn_entropy", F.lit(0.0)), F.coalesce("memory_gb", F.lit(0.0))
    # The texts of the advice.
    given = F.array_compact(
        F.array(
            advice((F.col("loss") > CAPACITY_LOSS) & ~F.isnan("loss") & (F.col("current_epoch") > CAPACITY_EPOCH), "dModel / Heads", "Increase", "High training loss after multiple epochs. Model capacity may be too low."),
            advice((ent > 0) & (ent < ENTROPY_LOW), "Heads (h)", "Increase", told("Low attention entropy (#). Attention is too focused.", ent, 2)),
            advice(_gt(ent, ENTROPY_HIGH), "Layers (N)", "Decrease", told("High attention entropy (#). Attention is too diffuse.", ent, 2)),
            advice(_gt(memory, MEMORY_HIGH), "Batch Size / Seq Len", "Decrease", told("Memory usage is very high (# GB).", memory, 1)),
        )
    )
    rows = steps.where(_warm()).select("run_id", "step", F.explode_outer(given).alias("_a"))
    return rows.where("_a is not null").select("run_id", "step", "_a.param", "_a.action", "_a.reason")


def all_checks(steps: DataFrame, bits: int = blocks.BITS) -> DataFrame:
    """Every window and every check on every step, plus the running count of bad losses.

    `val_loss` may be absent; then the overfit check never fires.
    """
    base = steps if "val_loss" in steps.columns else steps.withColumn("val_loss", F.lit(None).cast("double"))
    return windows(base, "loss", "grad", "step", bits=bits).withColumns(
        {
            **gradient_checks(),
            **plateau_checks(),
            **accuracy_checks(),
            **overconfidence_checks(),
            **divergence_checks(),
            **overfit_checks(),
        }
    )


CHECKS = (
    "gradient_explosion",
    "gradient_spike",
    "gradient_vanishing",
    "loss_plateau",
    "accuracy_stall",
    "accuracy_degrading",
    "overconfidence_high_acc",
    "overconfidence_divergence",
    "overconfidence_early",
    "nan_loss_critical",
    "loss_spike",
    "sft_overfitting",
)


def any_check() -> Column:
    out = F.col(CHECKS[0])
    for c in CHECKS[1:]:
        out = out | F.col(c)
    return out


def health_status(checked: DataFrame) -> DataFrame:
    """Add `health`: warmup, critical, warning or healthy."""
    critical = (F.col("nan_count") > NAN_LIMIT) | F.col("nan_loss_critical")
    status = (
        F.when(~_warm(), "warmup").when(critical, "critical").when(any_check(), "warning").otherwise("healthy")
    )
    return checked.withColumn("health", status)


def ema(steps: DataFrame, value: str = "loss", keep: float = 0.95, out: str = "ema", digits: int | None = None, bits: int = blocks.BITS) -> DataFrame:
    """Exponential moving average per run, seeded with the first value, for runs of any length.

    A block changes the average before it by a linear map, two numbers that the next block needs.
    NaN and infinities never leave the average again. With `digits` every average is rounded
    before it feeds the next one, see `_rounded`.
    """
    made = f"{out if digits is None else '_whole'} double"

    def summarise(rows: pa.Table) -> dict:
        x = _numbers(rows, value)
        return {"_first": float(x[0]), "_n": len(x), "_end": _average(x, 0.0, keep)[-1]}

    def link(state: dict | None, own: dict) -> tuple[dict, dict]:
        before = own["_first"] if state is None else state["_before"]
        # What is not finite stays; a factor that underflows must not hide it.
        kept = keep ** own["_n"] * before if math.isfinite(before) else before
        return {"_before": None if state is None else before}, {"_before": kept + own["_end"]}

    def finish(rows: pa.Table, carry: dict) -> pa.Table:
        after = _average(_numbers(rows, value), carry["_before"], keep)
        return rows.append_column(made.split(" ")[0], pa.array(after if digits is None else [carry["_before"], *after[:-1]], pa.float64()))

    whole = blocks.scan(steps, "run_id", "step", summarise, link, finish, "_first double, _n long, _end double", "_before double", made, bits)
    return whole if digits is None else _rounded(whole, value, keep, out, digits, bits)


def _average(x: np.ndarray, before: float | None, keep: float, digits: int | None = None) -> list[float]:
    """The average after every value; without one before it, the first value is the first average."""

    def step(e: float, v: float) -> float:
        e = keep * e + (1.0 - keep) * v
        return e if digits is None else round(e, digits)

    values = x.tolist()
    if before is None:
        seed = values[0] if digits is None else round(values[0], digits)
        return list(accumulate(values[1:], step, initial=seed))
    return list(accumulate(values, step, initial=before))[1:]


def _rounded(whole: DataFrame, value: str, keep: float, out: str, digits: int, bits: int) -> DataFrame:
    """The average whose every value is rounded; `_whole` is the unrounded one before each row.

    Rounding shifts an average by less than half a unit over 1 - keep, so before a block it is one
    of a few dozen values around the unrounded one. Each block is played from all of them; they
    keep their order and fall together as they go. Which of them it was, the block before tells.
    """
    unit = 10.0**-digits

    def summarise(rows: pa.Table) -> dict:
        x, before = _numbers(rows, value), rows["_whole"][0].as_py()
        if before is None or not math.isfinite(before):
            return {"_from": [], "_to": [_average(x, before, keep, digits)[-1]]}
        # Half a unit a step, and what the two ways of computing may differ by.
        reach = unit / 2 / (1.0 - keep) + 1e-12 * max(abs(before), float(np.abs(x[np.isfinite(x)]).max(initial=0.0)))
        if reach > 1e6 * unit:
            raise ValueError(f"averages near {before} have no {digits} digits to round")
        low, high = math.floor((before - reach) / unit) - 1, math.ceil((before + reach) / unit) + 1
        starts = [k / 10**digits for k in range(low, high + 1)]
        at, ends = list(range(len(starts))), list(starts)  # start -> place among the values still apart
        for v in x.tolist():
            ends = [round(keep * e + (1.0 - keep) * v, digits) for e in ends]
            if len(ends) > 1:
                apart = sorted(set(ends)) if math.isfinite(v) else ends[:1]
                if len(apart) < len(ends):
                    place = {e: i for i, e in enumerate(apart)}
                    moved = [place.get(e, 0) for e in ends]
                    at, ends = [moved[i] for i in at], apart
        return {"_from": starts, "_to": [ends[i] for i in at]}

    def link(state: dict | None, own: dict) -> tuple[dict, dict]:
        before = None if state is None else state["_e"]
        ends = dict(zip(own["_from"], own["_to"])) if own["_from"] else {before: own["_to"][0]}
        return {"_e": before}, {"_e": ends[before]}

    def finish(rows: pa.Table, carry: dict) -> pa.Table:
        made = _average(_numbers(rows, value), carry["_e"], keep, digits)
        return rows.append_column(out, pa.array(made, pa.float64()))

    fields = "_from array<double>, _to array<double>"
    return blocks.scan(whole, "run_id", "step", summarise, link, finish, fields, "_e double", f"{out} double", bits).drop("_whole")


def sampled(steps: DataFrame, every: int, batch: str = "batch", last: str = "last_batch") -> Column:
    """True on every `every`-th batch (1-based) and on the last one of an epoch."""
    return (F.col(batch) % every == 0) | (F.col(batch) == F.col(last))


def with_last_batch(steps: DataFrame) -> DataFrame:
    """Add the 1-based `batch` within its epoch and the epoch's `last_batch`.

    Two aggregates over (run, epoch), combined before the shuffle; no window over an epoch.
    """
    ends = steps.groupBy("run_id", "epoch").agg(F.min("step").alias("_s0"), F.max("step").alias("_s1"))
    return steps.join(ends, ["run_id", "epoch"]).select(
        *steps.columns,
        (F.col("step") - F.col("_s0") + 1).alias("batch"),
        (F.col("_s1") - F.col("_s0") + 1).alias("last_batch"),
    )


def sampled_steps(steps: DataFrame, every: int) -> DataFrame:
    wide = with_last_batch(steps)
    return wide.where(sampled(wide, every))


def accumulation_steps(steps: DataFrame, every: int) -> DataFrame:
    """Add `is_step` and log a gradient norm of 0 on the batches that only accumulate."""
    wide = with_last_batch(steps)
    wide = wide.withColumn("is_step", sampled(wide, every))
    return wide.withColumn("grad_norm", F.when(F.col("is_step"), F.col("grad_norm")).otherwise(0.0))


def learning_rate(step: Column, max_lr: float, min_lr: float, warmup: int, total: Column) -> Column:
    """Linear warm-up, then half a cosine from the top rate to the bottom one."""
    done = F.least((step - warmup) / F.greatest(total - warmup, F.lit(1)), F.lit(1.0))
    cosine = F.lit(min_lr) + (F.lit(max_lr) - F.lit(min_lr)) * 0.5 * (F.cos(F.lit(math.pi) * done) + 1.0)
    return F.when(step < warmup, F.lit(max_lr) * (step / max(warmup, 1))).otherwise(cosine)
