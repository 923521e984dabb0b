"""The adjustment log: what is done about the steps on which some check fired.

What a check finds is a window query (`rolling.all_checks`). What is done about it depends on the
settings in force and on the last adjustment: a finding that can change nothing more starts no
cooldown, so the next adjustment cannot be told from the flags alone. Between two adjustments
nothing changes, though. Flagged steps are therefore cut into blocks that are played side by side:
inside a block the next adjusting step is searched among many steps at once, and the loop is over
adjustments; between blocks the states are guessed and mended until they agree (`starts`). One run
spreads over many tasks, and no task holds more than a block.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from wordloom.operators.blocks import BITS, BLOCK, tagged
from wordloom.operators.order import running
from wordloom.operators.rolling import CHECKS, any_check, health_status
from wordloom.params import TrainingPlan
from wordloom.session import checkpoint

COOLDOWN = 200  # fixed value: steps between adjustments

# What each finding does, as (setting, factor, addend, lowest, highest).
EFFECTS = {
    "gradient_explosion": [("clip", 0.8, 0.0, 0.1, None), ("scale", 0.85, 0.0, 0.1, None)],
    "gradient_spike": [("clip", 0.9, 0.0, 0.1, None)],
    "gradient_vanishing": [("clip", 1.2, 0.0, None, 10.0), ("scale", 1.15, 0.0, None, 3.0)],
    "loss_plateau": [("scale", 1.1, 0.0, None, 3.0)],
    "accuracy_stall": [("smoothing", 1.0, -0.02, 0.0, None)],
    "accuracy_degrading": [("scale", 0.9, 0.0, 0.1, None)],
    "overconfidence_high_acc": [("smoothing", 1.0, 0.025, None, 0.3)],
    "overconfidence_divergence": [("smoothing", 1.0, 0.03, None, 0.3)],
    "overconfidence_early": [("smoothing", 1.0, 0.04, None, 0.3)],
    "nan_loss_critical": [("scale", 0.5, 0.0, 0.05, None), ("clip", 0.5, 0.0, 0.1, None)],
    "loss_spike": [("scale", 0.7, 0.0, 0.1, None)],
    "sft_overfitting": [("dropout", 1.0, 0.05, None, 0.5)],
}
# Findings whose effect is recorded even when it changes nothing.
ALWAYS = {"gradient_spike", "nan_loss_critical", "loss_spike"}
EMERGENCY = {"nan_loss_critical", "loss_spike"}
# Weakest first; a later effect on the same setting wins.
PRIORITY = (
    "accuracy_stall",
    "accuracy_degrading",
    "loss_plateau",
    "overconfidence_high_acc",
    "overconfidence_divergence",
    "overconfidence_early",
    "gradient_explosion",
    "gradient_spike",
    "gradient_vanishing",
    "sft_overfitting",
    "nan_loss_critical",
    "loss_spike",
)
CHAIN = ("overconfidence_high_acc", "overconfidence_divergence", "overconfidence_early")
SETTINGS = ("clip", "scale", "smoothing", "dropout")


@dataclass
class Tuner:
    """Current settings and the last adjusted step of one run."""

    clip: float = TrainingPlan.grad_clip
    scale: float = 1.0
    smoothing: float = TrainingPlan.label_smoothing
    dropout: float = TrainingPlan.dropout
    last: int = -COOLDOWN
    count: int = 0
    before: dict = field(default_factory=dict)

    def settings(self) -> tuple[float, ...]:
        return tuple(getattr(self, s) for s in SETTINGS)

    def effects(self, check: str) -> dict[str, float]:
        out = {}
        for name, factor, addend, low, high in EFFECTS[check]:
            now = getattr(self, name)
            new = now * factor + addend
            new = new if low is None else max(new, low)
            new = new if high is None else min(new, high)
            if new != now or check in ALWAYS:
                out[name] = round(new, 4)
        return out

    def decide(self, step: int, fired: list[str]) -> tuple[list[str], dict[str, float]]:
        """The findings that count at this step, and the settings changed by them.

        Of the overconfidence patterns, one ends the chain once it has something to change.
        """
        found, effects, settled = [], {}, False
        for check in fired:
            if check in CHAIN:
                if settled:
                    continue
                effects[check] = self.effects(check)
                settled = bool(effects[check])
            else:
                effects[check] = self.effects(check)
            found.append(check)
        changes: dict[str, float] = {}
        for check in PRIORITY:
            changes.update(effects.get(check, {}))
        resting = step - self.last < COOLDOWN
        if not changes or (resting and EMERGENCY.isdisjoint(found)):
            return found, {}
        self.before = {k: getattr(self, k) for k in changes}
        for name, value in changes.items():
            setattr(self, name, value)
        self.last, self.count = step, self.count + 1
        return found, changes


REPLAY = (
    "run_id long, step long, reasons array<string>, adjusted boolean, changes map<string,double>, "
    "before map<string,double>, clip double, scale double, smoothing double, dropout double, adjustments long"
)
_STATE = "clip double, scale double, smoothing double, dropout double, last long, count long"
_FIELDS = (*SETTINGS, "last", "count")
_BITS = {c: 1 << i for i, c in enumerate(CHECKS)}
_EMERGENCY = sum(_BITS[c] for c in EMERGENCY)
_CHAIN = [_BITS[c] for c in CHAIN]
LOOK = 256  # flagged steps looked at first for the next adjustment


def _effective(tuner: Tuner) -> int:
    """The checks that would change something under the current settings, as bits."""
    return sum(bit for check, bit in _BITS.items() if tuner.effects(check))


def _next(steps: np.ndarray, fired: np.ndarray, start: int, tuner: Tuner, effective: int) -> int:
    """The first flagged step from `start` on that adjusts something; their number if none does.

    Steps are looked at together, in stretches that double, as the settings do not change between.
    """
    lo, width = start, LOOK
    while lo < len(steps):
        s, f = steps[lo : lo + width], fired[lo : lo + width]
        hit = np.flatnonzero(((f & effective) != 0) & ((s - tuner.last >= COOLDOWN) | ((f & _EMERGENCY) != 0)))
        if len(hit):
            return lo + int(hit[0])
        lo, width = lo + width, width * 2
    return len(steps)


def _found(fired: np.ndarray, effective: int) -> np.ndarray:
    """What is reported: of the overconfidence patterns, none after the first that changes something."""
    fired = fired.copy()
    for i, bit in enumerate(_CHAIN):
        if effective & bit:
            fired[(fired & bit) != 0] &= ~sum(_CHAIN[i + 1 :])
    return fired


def _play(steps: np.ndarray, fired: np.ndarray, tuner: Tuner, log: list | None = None) -> Tuner:
    """Replay flagged steps of one run in order; the loop is over adjustments, not over steps.

    `log` gets (first, end, settings, adjustments, found, changes, before) of every stretch of steps.
    """
    at = 0
    while at < len(steps):
        effective = _effective(tuner)
        hit = _next(steps, fired, at, tuner, effective)
        if log is not None and hit > at:
            log.append((at, hit, tuner.settings(), tuner.count, _found(fired[at:hit], effective), {}, {}))
        if hit < len(steps):
            found, changes = tuner.decide(int(steps[hit]), [c for c, bit in _BITS.items() if fired[hit] & bit])
            if log is not None:
                log.append((hit, hit + 1, tuner.settings(), tuner.count, np.array([sum(_BITS[c] for c in found)]), changes, tuner.before))
        at = hit + 1
    return tuner


def _started(start: pa.Table) -> Tuner:
    row = start.to_pylist()[0]
    return Tuner(**{f: row[f] for f in _FIELDS})


def _ends(rows: pa.Table, start: pa.Table) -> pa.Table:
    """The state after a block, from the state before it; `count` counts this block only."""
    rows, tuner = rows.sort_by("step"), _started(start)
    tuner.count = 0
    end = _play(rows["step"].to_numpy(), rows["fired"].to_numpy(), tuner)
    keys = {k: start[k] for k in ("run_id", BLOCK)}
    return pa.table(keys | {f: pa.array([getattr(end, f)]) for f in _FIELDS})


def _logged(rows: pa.Table, start: pa.Table) -> pa.Table:
    rows, log = rows.sort_by("step"), []
    _play(rows["step"].to_numpy(), rows["fired"].to_numpy(), _started(start), log)
    n = [end - first for first, end, *_ in log]
    names = {}  # bits -> the checks they stand for; few kinds occur

    def reasons(bits: int) -> list[str]:
        return names.setdefault(bits, [c for c, bit in _BITS.items() if bits & bit])

    def each(values, kind):
        return pa.array([v for v, k in zip(values, n) for _ in range(k)], kind)

    pairs = pa.map_(pa.string(), pa.float64())
    made = {
        "run_id": rows["run_id"],
        "step": rows["step"],
        "reasons": pa.array([reasons(b) for stretch in log for b in stretch[4].tolist()], pa.list_(pa.string())),
        "adjusted": each([bool(x[5]) for x in log], pa.bool_()),
        "changes": each([list(x[5].items()) for x in log], pairs),
        "before": each([list(x[6].items()) if x[5] else [] for x in log], pairs),
    }
    made |= {s: each([x[2][i] for x in log], pa.float64()) for i, s in enumerate(SETTINGS)}
    return pa.table(made | {"adjustments": each([x[3] for x in log], pa.int64())})


def _rested(bits: int) -> Column:
    """The last adjustment so long before a block that it does not matter there."""
    return F.shiftleft(F.col(BLOCK), bits) - COOLDOWN


def _handed(ends: DataFrame, bits: int) -> DataFrame:
    """The state before every block: the end of the block before, and the adjustments so far.

    A cooldown that is over counts as just over, so that states alike in effect are equal.
    """
    w, first = W.partitionBy("run_id").orderBy(BLOCK), Tuner()
    before = [F.coalesce(F.lag(s).over(w), F.lit(getattr(first, s))).alias(s) for s in SETTINGS]
    last = F.greatest(F.lag("last").over(w), _rested(bits)).alias("last")
    count = F.coalesce(F.sum("count").over(w.rowsBetween(W.unboundedPreceding, -1)), F.lit(0)).alias("count")
    return ends.select("run_id", BLOCK, *before, last, count)


def starts(flagged: DataFrame, bits: int) -> DataFrame:
    """(run_id, block, state before it) for every block with flagged steps.

    Every block is played from a guess, all at once. Where a block ends otherwise than its successor
    assumed, the successor is played again, until all agree: then every state follows from the one
    before, as in a single fold. Settings run into their limits and cooldowns run out, so guesses
    soon stop to matter; at worst each round settles one more block of a run. Only those blocks and
    one row per block move in a round.
    """
    guess = [F.lit(getattr(Tuner(), s)).alias(s) for s in SETTINGS] + [_rested(bits).alias("last"), F.lit(0).cast("long").alias("count")]
    begun = checkpoint(flagged.select("run_id", BLOCK).distinct().select("run_id", BLOCK, *guess))
    most = begun.groupBy("run_id").count().agg(F.max("count").alias("n")).first()["n"] or 0
    if most <= 1:
        return begun
    keys, ends, again = ["run_id", BLOCK], None, begun
    schema = f"run_id {flagged.schema['run_id'].dataType.simpleString()}, {BLOCK} long, {_STATE}"
    while True:
        played = flagged.join(again.select(*keys), keys, "left_semi").groupBy(*keys).cogroup(again.groupBy(*keys)).applyInArrow(_ends, schema)
        kept = [] if ends is None else [ends.join(again.select(*keys), keys, "left_anti")]
        ends = checkpoint(reduce(DataFrame.unionByName, kept, played))
        handed = checkpoint(_handed(ends, bits))
        assumed = begun.select(*keys, *[F.col(f).alias("_" + f) for f in (*SETTINGS, "last")])
        wrong = reduce(lambda a, b: a | b, [F.col(f) != F.col("_" + f) for f in (*SETTINGS, "last")])
        again = checkpoint(handed.join(assumed, keys).where(wrong).select(handed.columns))
        begun = handed
        if again.isEmpty():
            return begun


def replay(checked: DataFrame, bits: int = BITS) -> DataFrame:
    """One row per flagged step: what was found, whether it was acted on, and the settings after."""
    fired = reduce(lambda a, b: a + b, [F.when(F.col(c), bit).otherwise(0) for c, bit in _BITS.items()])
    flagged = checked.where(any_check()).select("run_id", F.col("step").cast("long").alias("step"), fired.alias("fired"))
    flagged = checkpoint(tagged(flagged, "step", bits))
    keys = ["run_id", BLOCK]
    logged = flagged.groupBy(*keys).cogroup(starts(flagged, bits).groupBy(*keys)).applyInArrow(_logged, REPLAY)
    return logged


def adjustments(replayed: DataFrame) -> DataFrame:
    return replayed.where("adjusted")


def settings_at(steps: DataFrame, replayed: DataFrame) -> DataFrame:
    """Add the settings in force after every step: the last ones set, or the initial ones."""
    changed = adjustments(replayed).select("run_id", "step", *SETTINGS)
    start = Tuner()
    both = steps.join(changed, ["run_id", "step"], "left")
    filled = running(both, ["run_id"], "step", {"_s_" + s: (F.col(s), "last") for s in SETTINGS})
    filled = filled.drop(*SETTINGS)
    return filled.withColumns(
        {s: F.coalesce(F.col("_s_" + s), F.lit(getattr(start, s))) for s in SETTINGS}
    ).drop(*["_s_" + s for s in SETTINGS])


def effective_lr(steps: DataFrame, replayed: DataFrame, scheduled: str = "lr") -> DataFrame:
    """Scheduled rate times the scale in force before the step's own adjustment."""
    changed = adjustments(replayed).select("run_id", "step", F.col("scale").alias("_sc"))
    both = steps.join(changed, ["run_id", "step"], "left")
    filled = running(both, ["run_id"], "step", {"lr_scale": (F.col("_sc"), "last")}, inclusive=False).drop("_sc")
    scale = F.coalesce("lr_scale", F.lit(1.0))
    return filled.withColumns({"lr_scale": scale, "effective_lr": F.col(scheduled) * scale})


DIAGNOSTICS = ("avg_loss", "avg_grad", "avg_accuracy", "max_grad", "min_grad", "risk")


def tuner_state(checked: DataFrame, replayed: DataFrame, k: int = 10) -> DataFrame:
    """The state of every run after its last step, as a reader is shown it.

    One row per run: step, health, reasons, nan_count, the settings, adjustments, the steps of the
    last `k` adjustments, the steps until the next one may follow, and the rolling diagnostics.
    `checked` holds every step with its checks, health and diagnostics. Aggregates by run, combined
    before they move; no run is gathered.
    """
    shown = ["health", "nan_count", *DIAGNOSTICS]
    last = checked.groupBy("run_id").agg(F.max("step").alias("step"), *[F.max_by(c, "step").alias(c) for c in shown])
    done = adjustments(replayed)
    tuned = done.groupBy("run_id").agg(
        *[F.max_by(s, "step").alias(s) for s in SETTINGS], F.max("step").alias("_last"), F.max("adjustments").alias("adjustments")
    )
    recent = recent_adjustments(replayed, k).groupBy("run_id").agg(F.sort_array(F.collect_list("step")).alias("recent"))
    found = replayed.select("run_id", "step", "reasons")
    wide = last.join(tuned, "run_id", "left").join(recent, "run_id", "left").join(found, ["run_id", "step"], "left")
    start = Tuner()
    waiting = F.greatest(F.lit(0), F.lit(COOLDOWN) - (F.col("step") - F.coalesce("_last", F.lit(start.last))))
    return wide.select(
        "run_id", "step", *shown,
        *[F.coalesce(s, F.lit(getattr(start, s))).alias(s) for s in SETTINGS],
        F.coalesce("adjustments", F.lit(0)).cast("long").alias("adjustments"),
        F.coalesce("recent", F.array().cast("array<long>")).alias("recent"),
        F.coalesce("reasons", F.array().cast("array<string>")).alias("reasons"),
        waiting.cast("long").alias("cooldown"),
    )


def recent_adjustments(replayed: DataFrame, k: int = 10) -> DataFrame:
    """The last `k` adjustments of every run."""
    w = W.partitionBy("run_id").orderBy(F.desc("step"))
    return adjustments(replayed).withColumn("recency", F.row_number().over(w)).where(F.col("recency") <= k)


def reason_counts(replayed: DataFrame) -> DataFrame:
    """(run_id, reason, n): how often each finding was part of an adjustment."""
    each = adjustments(replayed).select("run_id", F.explode_outer("reasons").alias("reason"))
    return each.groupBy("run_id", "reason").agg(F.count(F.lit(1)).alias("n"))


def summary(checked: DataFrame, replayed: DataFrame) -> DataFrame:
    """One row per run: steps, adjustments, bad losses, final settings and final health."""
    totals = checked.groupBy("run_id").agg(F.max("step").alias("step"), F.max("nan_count").alias("nan_events"))
    final = health_status(settings_at(checked, replayed)).select("run_id", "step", *SETTINGS, "health")
    counts = adjustments(replayed).groupBy("run_id").agg(F.count(F.lit(1)).alias("adjustments"))
    return (
        totals.join(final, ["run_id", "step"])
        .join(counts, "run_id", "left")
        .select("run_id", F.col("step").alias("steps"), F.coalesce("adjustments", F.lit(0)).alias("adjustments"), "nan_events", *SETTINGS, "health")
    )
