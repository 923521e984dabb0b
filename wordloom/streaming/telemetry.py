"""Step metrics as they arrive: moving average and health monitor, keyed by run.

Rows of a run reach the state in chunks without order. Within a micro-batch they are put in
order first; a row at or before the last one folded in is reported as late and changes nothing.
The step number is the count of rows folded in so far.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from wordloom.operators import rolling as r
from wordloom.operators.tuner import SETTINGS, Tuner
from wordloom.session import checkpoint


CHUNK = 10_000  # rows that are Python objects at a time


def _in_order(chunks: Iterator[pd.DataFrame], names: list[str]) -> Iterator[list[tuple]]:
    """The rows of a run, in the order of the first column and `CHUNK` at a time. Until then each is a
    few numbers in arrays: 8 bytes a field."""
    held = {n: [] for n in names}
    for chunk in chunks:
        for n in names:
            held[n].append(chunk[n].to_numpy())
    order, columns = None, []
    for n in names:
        whole = np.concatenate(held.pop(n))
        order = np.argsort(whole, kind="stable") if order is None else order
        columns.append(whole[order])
        del whole
    for lo in range(0, len(order), CHUNK):
        yield list(zip(*[c[lo : lo + CHUNK].tolist() for c in columns]))


class _Average(StatefulProcessor):
    def __init__(self, order: str, keep: float, digits: int | None):
        self.order, self.keep, self.digits = order, keep, digits

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.state = handle.getValueState("average", "last long, step long, ema double")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        last, step, ema = self.state.get() if self.state.exists() else (None, 0, math.nan)
        for chunk in _in_order(rows, [self.order, "loss"]):
            out = []
            for at, loss in chunk:
                late = last is not None and at <= last
                if not late:
                    ema = loss if step == 0 else self.keep * ema + (1.0 - self.keep) * loss
                    if self.digits is not None:
                        ema = round(ema, self.digits)
                    last, step = at, step + 1
                out.append((key[0], at, None if late else step, loss, None if late else ema, late))
            yield pd.DataFrame(out, columns=["run_id", self.order, "step", "loss", "ema", "late"]).astype({"step": "Int64"})
        self.state.update((last, step, ema))

    def close(self) -> None:
        pass


def ema(stream: DataFrame, order: str = "event_id", keep: float = 0.95, digits: int | None = None) -> DataFrame:
    """(run_id, order, step, loss, ema, late). With `digits` each average is rounded before it
    feeds the next one."""
    return stream.select("run_id", order, "loss").groupBy("run_id").transformWithStateInPandas(
        statefulProcessor=_Average(order, keep, digits),
        outputStructType=f"run_id long, {order} long, step long, loss double, ema double, late boolean",
        outputMode="append",
        timeMode="none",
    )


def asof_static(stream: DataFrame, marks: DataFrame, group: str, on: str, value: str, bits: int = 16) -> DataFrame:
    """Stream rows with the latest `value` of `marks` at a strictly smaller `on`, null before the first.

    `marks` (group, on, value) is a stored table. It is laid out once by (group, block of `on`): the
    values recorded in a block, and the one before it. A stream row finds its block by an equality
    join; rows behind the last block find the last value of their group.
    """
    kept = marks.select(F.col(group), F.col(on).cast("long").alias("_at"), F.col(value).alias("_v"))
    w = W.partitionBy(group).orderBy("_at")
    kept = kept.withColumn("_own", F.shiftright("_at", bits)).withColumn("_next", F.lead("_own").over(w))
    # A value is looked for in its own block and in the ones up to the next value's.
    kept = kept.withColumn("_b", F.explode(F.sequence("_own", F.coalesce("_next", "_own"))))
    blocks = checkpoint(kept.groupBy(group, "_b").agg(F.sort_array(F.collect_list(F.struct("_at", "_v")), asc=False).alias("_in")))
    last = checkpoint(kept.groupBy(group).agg(F.max(F.struct("_at", "_v")).alias("_end")))
    wide = stream.withColumn("_b", F.shiftright(F.col(on).cast("long"), bits)).join(blocks, [group, "_b"], "left").join(last, group, "left")
    inside = F.get(F.filter("_in", lambda m: m["_at"] < F.col(on)), F.lit(0))
    behind = F.when(F.col("_end._at") < F.col(on), F.col("_end._v"))
    return wide.withColumn(value, F.coalesce(behind, inside["_v"])).drop("_b", "_in", "_end")


def _mean(values: list[float]) -> float:
    return sum(values) / len(values)


def _gain(a: float, b: float) -> float:
    return (a - b) / a if a > 0 else 0.0


def _fired(step, loss, grad, acc, losses, grads, accs, pairs, val_loss) -> list[str]:
    """The checks of `rolling`, on the buffers (plain lists) of one run."""
    on = dict.fromkeys(r.CHECKS, False)
    if len(grads) >= r.RECENT:
        g = grads[-r.RECENT :]
        on["gradient_explosion"] = sum(x > r.GRAD_HIGH for x in g) / len(g) > r.GRAD_HIGH_SHARE
        on["gradient_spike"] = not on["gradient_explosion"] and max(g) > r.GRAD_SPIKE
        on["gradient_vanishing"] = sum(x < r.GRAD_LOW for x in g) / len(g) > r.GRAD_LOW_SHARE
    if len(losses) >= r.PLATEAU_MIN:
        mid = len(losses) // 2
        on["loss_plateau"] = 0 <= _gain(_mean(losses[:mid]), _mean(losses[mid:])) < r.PLATEAU_GAIN
    if len(accs) >= r.ACC_MIN:
        mid = len(accs) // 2
        rise = _mean(accs[mid:]) - _mean(accs[:mid])
        on["accuracy_stall"] = 0 <= rise < r.ACC_GAIN
        on["accuracy_degrading"] = rise < r.ACC_LOSS
    if len(accs) >= r.PAIR_SPAN:
        before, after = slice(-r.PAIR_SPAN, -r.PAIR_SPAN // 2), slice(-r.PAIR_SPAN // 2, None)
        acc_b, a, b = _mean(accs[after]), _mean(pairs[before]), _mean(pairs[after])
        on["overconfidence_high_acc"] = acc_b > r.PAIR_ACC and _gain(a, b) < r.PAIR_GAIN
        on["overconfidence_divergence"] = acc_b > _mean(accs[before]) + r.PAIR_RISE and b > a * r.PAIR_LOSS_RISE
        on["overconfidence_early"] = step < r.EARLY_STEPS and acc_b > r.EARLY_ACC
    if len(losses) >= r.SPIKE_MIN:
        recent = _mean(losses[-r.RECENT :])
        on["nan_loss_critical"] = not math.isfinite(loss)
        on["loss_spike"] = math.isfinite(loss) and recent > 0 and loss > recent * r.SPIKE_RATIO
    if val_loss is not None and not math.isnan(val_loss):
        on["sft_overfitting"] = val_loss > loss * r.OVERFIT_RATIO and acc > r.OVERFIT_ACC
    return [c for c in r.CHECKS if on[c]]


_BUFFERS = ("losses", "grads", "accs", "pairs")
_HEALTH = (
    "run_id long, {order} long, step long, late boolean, health string, reasons array<string>, adjusted boolean, "
    "nan_count long, clip double, scale double, smoothing double, dropout double, adjustments long"
)


class _Monitor(StatefulProcessor):
    def __init__(self, order: str):
        self.order = order

    def init(self, handle: StatefulProcessorHandle) -> None:
        numbers = "last long, step long, nan_count long, clip double, scale double, smoothing double, dropout double, adjusted long, count long"
        self.numbers = handle.getValueState("numbers", numbers)
        self.buffers = handle.getValueState("buffers", ", ".join(f"{b} array<double>" for b in _BUFFERS))

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        last, step, nans, tuner = None, 0, 0, Tuner()
        kept = {b: [] for b in _BUFFERS}
        if self.numbers.exists():
            last, step, nans, *settings, adjusted, count = self.numbers.get()
            tuner = Tuner(*settings, last=adjusted, count=count)
            kept = {b: list(v) for b, v in zip(_BUFFERS, self.buffers.get())}

        def push(name, value):
            kept[name].append(value)
            del kept[name][: -r.WINDOW]

        names = [c.split(" ")[0] for c in _HEALTH.format(order=self.order).split(", ")]
        for chunk in _in_order(rows, [self.order, "loss", "grad_norm", "accuracy", "val_loss"]):
            out = []
            for at, loss, grad, acc, val in chunk:
                if last is not None and at <= last:
                    out.append((key[0], at, None, True, None, [], False, nans, *self._settings(tuner), tuner.count))
                    continue
                last, step = at, step + 1
                if math.isfinite(loss):
                    push("losses", loss)
                else:
                    nans += 1
                if not math.isnan(grad):
                    push("grads", grad)
                push("accs", acc)
                push("pairs", 0.0 if math.isnan(loss) else loss)
                health, found, changes = "warmup", [], {}
                if step >= r.WARMUP:
                    fired = _fired(step, loss, grad, acc, *(kept[b] for b in _BUFFERS), val)
                    found, changes = tuner.decide(step, fired)
                    critical = nans > r.NAN_LIMIT or "nan_loss_critical" in found
                    health = "critical" if critical else "warning" if found else "healthy"
                out.append((key[0], at, step, False, health, found, bool(changes), nans, *self._settings(tuner), tuner.count))
            yield pd.DataFrame(out, columns=names).astype({"step": "Int64"})
        self.numbers.update((last, step, nans, *self._settings(tuner), tuner.last, tuner.count))
        self.buffers.update(tuple(kept[b] for b in _BUFFERS))

    @staticmethod
    def _settings(tuner: Tuner) -> tuple[float, ...]:
        return tuple(getattr(tuner, s) for s in SETTINGS)

    def close(self) -> None:
        pass


def health(stream: DataFrame, order: str = "event_id") -> DataFrame:
    """One state snapshot per arriving step; see `rolling` and `tuner` for what it means.

    Needs run_id, the order key, loss, grad_norm, accuracy and val_loss (null while unknown).
    """
    cols = ["run_id", order, "loss", "grad_norm", "accuracy", "val_loss"]
    return stream.select(*cols).groupBy("run_id").transformWithStateInPandas(
        statefulProcessor=_Monitor(order),
        outputStructType=_HEALTH.format(order=order),
        outputMode="append",
        timeMode="none",
    )
