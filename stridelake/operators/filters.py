"""Filters and predicates on episodes, steps and channels."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W


def successful(df: DataFrame, path: str = "file_path") -> DataFrame:
    return df.where(F.contains(F.col(path), F.lit("success")))


def idle(x: Column, order: Column, key: Column, tolerance: float = 1e-3) -> Column:
    """Whether all elements moved less than the tolerance since the step before; the first step isn't idle."""
    before = F.lag(x).over(W.partitionBy(key).orderBy(order))
    still = F.forall(F.zip_with(x, before, lambda a, b: F.abs(a - b) < tolerance), lambda v: v)
    return F.coalesce(still, F.lit(False))


def moving(df: DataFrame, flag: str = "movement_enabled", wanted: bool = True) -> DataFrame:
    """Without steps whose flag is false (a missing flag is true), if that is wanted."""
    return df.where(F.coalesce(F.col(flag), F.lit(True))) if wanted and flag in df.columns else df


def until_first_failure(df: DataFrame, failed: Column, key: str, order: str) -> DataFrame:
    """Each episode's steps before its first failed one."""
    seen = F.max(failed).over(W.partitionBy(key).orderBy(order).rowsBetween(W.unboundedPreceding, 0))
    return df.withColumn("_failed", seen).where(~F.coalesce(F.col("_failed"), F.lit(False))).drop("_failed")


def cameras_by_kind(kinds: Column, wrist: bool, most: int) -> Column:
    """Names of the wrist cameras (kind 0) or of the others of a map name to kind, in order of name."""
    chosen = F.map_filter(kinds, lambda _, v: v == 0 if wrist else v != 0)
    return F.slice(F.array_sort(F.map_keys(chosen)), 1, most)


def without_depth(images: Column) -> Column:
    return F.map_filter(images, lambda k, _: ~F.contains(k, F.lit("_depth")))


def camera_of(images: Column, name: str) -> Column:
    """The value of the last key, in order of name, that holds both the name and `left`."""
    chosen = F.map_filter(images, lambda k, _: F.contains(k, F.lit(name)) & F.contains(k, F.lit("left")))
    return F.element_at(chosen, F.array_max(F.map_keys(chosen)))


def frame_range(df: DataFrame, index: str, start: int = 0, end: int | None = None, length: str | None = None) -> DataFrame:
    """Steps start <= index < end; negative bounds count from the end and need the length's column."""

    def bound(v: int) -> Column:
        if v >= 0:
            return F.lit(v)
        if length is None:
            raise ValueError("negative bounds need a length column")
        return F.greatest(F.col(length) + v, F.lit(0))

    kept = df.where(F.col(index) >= bound(start))
    return kept if end is None else kept.where(F.col(index) < bound(end))


def fresh(stamps: list[Column], now: Column, timeout: float) -> Column:
    """Whether every channel has been seen and none is older than the timeout, in seconds."""
    ok = F.lit(True)
    for s in stamps:
        ok = ok & s.isNotNull() & ((now - s) <= timeout)
    return F.coalesce(ok, F.lit(False))


def paths_matching(df: DataFrame, pattern: str, path: str = "path", negate: bool = False) -> DataFrame:
    """Rows whose `/`-joined path matches the pattern as a whole, or those that don't."""
    hit = F.col(path).rlike(f"^(?:{pattern})$")
    return df.where(~hit if negate else hit)


def after_warm_up(df: DataFrame, step: str = "step", steps: int = 10) -> DataFrame:
    return df.where(F.col(step) >= steps)


def required(df: DataFrame, condition: Column, message: str) -> DataFrame:
    """df, whose evaluation raises an error at a row that fails the condition."""
    guard = F.when(F.coalesce(condition, F.lit(False)), F.lit(True)).otherwise(F.raise_error(F.lit(message)).cast("boolean"))
    return df.where(guard)


def divisible_batch(batch: int, devices: int) -> None:
    if batch % devices:
        raise ValueError(f"batch size {batch} can't be divided among {devices} devices")
