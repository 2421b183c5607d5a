"""Scalars of chunked control and of training schedules."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

SCHEDULES = ("ones", "zeros", "linear", "exp")


def prefix_weight(k: Column, start: Column, end: Column, total: int, schedule: str = "linear") -> Column:
    """The weight of a chunk's step k: 1 before start, falling to 0 at end, 0 from there on."""
    if schedule not in SCHEDULES:
        raise ValueError(f"schedule must be one of {SCHEDULES}")
    e = F.greatest(F.lit(0), F.least(F.lit(total), end))
    s = F.least(F.greatest(F.lit(0), F.least(F.lit(total), start)), e)
    if schedule in ("ones", "zeros"):
        return F.when(k < (e if schedule == "ones" else s), 1.0).otherwise(0.0)
    falling = F.lit(1.0) - (k - s + 1) / (e - s + 1).cast("double")
    w = F.when(k >= e, 0.0).when(k < s, 1.0).otherwise(F.greatest(F.lit(0.0), F.least(F.lit(1.0), falling)))
    return w * F.expm1(w) / (math.e - 1) if schedule == "exp" else w


def prefix_weights(start: Column, end: Column, total: int, schedule: str = "linear") -> Column:
    """The weights of all steps of a chunk, as an array. For a row per step prefix_weight is cheaper."""
    if schedule not in SCHEDULES:
        raise ValueError(f"schedule must be one of {SCHEDULES}")
    return F.transform(F.sequence(F.lit(0), F.lit(total - 1)), lambda k: prefix_weight(k, start, end, total, schedule))


def guidance_weight(t: Column, most: float) -> Column:
    """(t^2 + (1-t)^2) / (t (1-t)), with t kept 1e-6 from both ends, at most `most`."""
    c = F.greatest(F.lit(1e-6), F.least(F.lit(1 - 1e-6), t))
    return F.least((c * c + (F.lit(1.0) - c) * (F.lit(1.0) - c)) / (c * (F.lit(1.0) - c)), F.lit(float(most)))


def warmup_cosine(step: Column, warmup: int = 1000, peak: float = 2.5e-5, decay_steps: int = 30_000, end: float = 2.5e-6) -> Column:
    """Linear from peak / (warmup + 1) to peak, then half a cosine to `end` at decay_steps."""
    first = peak / (warmup + 1)
    rising = F.lit(first) + (F.lit(peak) - first) * step / float(max(1, warmup))
    done = F.least((step - warmup) / float(decay_steps - warmup), F.lit(1.0))
    return F.when(step < warmup, rising).otherwise(F.lit(end) + (F.lit(peak) - end) * (F.cos(done * F.pi()) + 1) / 2)


def warmup_rsqrt(step: Column, warmup: int = 1000, peak: float = 5e-5, timescale: float = 10_000) -> Column:
    """Linear from peak / (warmup + 1) to peak, then peak / sqrt((timescale + steps since) / timescale)."""
    first = peak / (warmup + 1)
    rising = F.lit(first) + (F.lit(peak) - first) * step / float(max(1, warmup))
    return F.when(step < warmup, rising).otherwise(F.lit(peak) / F.sqrt((F.lit(timescale) + step - warmup) / timescale))


def delay_steps(quantile: Column, margin: int, horizon: Column) -> Column:
    """ceil(quantile - 1e-9) + margin, within [0, horizon - 1]."""
    steps = F.ceil(quantile - 1e-9) + margin
    return F.greatest(F.lit(0), F.least(steps, F.greatest(horizon - 1, F.lit(0)))).cast("int")


def execution_horizon(delay: Column, scale: float, least: int, chunk: Column) -> Column:
    """max(scale * delay rounded half to even, least), within [delay + 1, chunk]."""
    h = F.greatest(F.bround(delay * F.lit(float(scale))), F.lit(least))
    return F.least(F.greatest(h, delay + 1), chunk).cast("int")


def milliseconds(seconds: Column, nanoseconds: Column) -> Column:
    return seconds * 1000.0 + nanoseconds * 1e-6
