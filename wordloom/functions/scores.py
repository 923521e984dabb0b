"""Expressions over score, logit and probability arrays."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# What is added before a logarithm, and where the exponent is clamped.
LOG_EPS = 1e-9
LOSS_CLAMP = 20.0


def total(values: Column) -> Column:
    return F.aggregate(values, F.lit(0.0), lambda a, x: a + x)


def argmax(scores: Column) -> Column:
    """0-based position of the first maximum."""
    return F.array_position(scores, F.array_max(scores)) - 1


def log_sum_exp(logits: Column) -> Column:
    peak = F.array_max(logits)
    return peak + F.log(total(F.transform(logits, lambda x: F.exp(x - peak))))


def softmax(logits: Column) -> Column:
    lse = log_sum_exp(logits)
    return F.transform(logits, lambda x: F.exp(x - lse))


def smoothed_cross_entropy(logits: Column, label: Column, smoothing: float, ignore: int = 0) -> Column:
    """Label-smoothed cross entropy of one row; null for the ignored label."""
    lse = log_sum_exp(logits)
    hit = lse - F.get(logits, label)
    spread = lse - total(logits) / F.size(logits)
    return F.when(label != ignore, hit * (1 - smoothing) + spread * smoothing)


def entropy(weights: Column) -> Column:
    return -total(F.transform(weights, lambda p: p * F.log(p + F.lit(LOG_EPS))))


def perplexity(loss: Column) -> Column:
    return F.exp(F.least(loss, F.lit(LOSS_CLAMP)))
