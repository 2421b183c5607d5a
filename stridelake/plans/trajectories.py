"""The source of training steps out of whole trajectories, as one plan without a shuffle of its own."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stridelake.operators.joins import kept_steps
from stridelake.operators.windows import steps_from_arrays


def chunked_arrays(values: Column, horizon: int) -> Column:
    """For each element the next `horizon` ones, the last repeating: array<array>."""
    tail = F.concat(values, F.array_repeat(F.element_at(values, -1), horizon - 1))
    return F.when(F.size(values) == 0, F.array()).otherwise(F.transform(values, lambda v, i: F.slice(tail, i + 1, horizon)))


def trajectory_source(episodes: DataFrame, success: Column, arrays: Sequence[str], actions: str, horizon: int, ranges: DataFrame | None = None, key: str = "episode_id") -> DataFrame:
    """Steps of the episodes (a row each, with equally long arrays) that succeeded, with chunks of the next actions;
    with ranges (key, start, end), only the steps inside one. Empty episodes give no steps."""
    kept = episodes.where(success & (F.size(actions) > 0)).withColumn("_chunks", chunked_arrays(F.col(actions), horizon))
    steps = steps_from_arrays(kept, [*arrays, "_chunks"])
    steps = steps.drop(actions) if actions in steps.columns else steps
    return kept_steps(steps.withColumnRenamed("_chunks", actions), ranges, key)
