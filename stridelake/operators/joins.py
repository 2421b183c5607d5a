"""Lookups: tasks, instructions, ranges, statistics, latest values."""

from __future__ import annotations

import difflib
from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

#: A side is broadcast only when a count stays under this.
BROADCAST_ROWS = 1_000_000


def sized(df: DataFrame, limit: int = BROADCAST_ROWS) -> DataFrame:
    """Broadcast if a count shows that it is small; else left to the optimiser and adaptive execution."""
    return F.broadcast(df) if df.limit(limit + 1).count() <= limit else df


def task_prompts(steps: DataFrame, tasks: DataFrame, index: str = "task_index") -> DataFrame:
    """steps with prompt; a step without its task raises an error."""
    known = sized(tasks.select(index, "prompt"))
    missing = F.raise_error(F.concat(F.lit(f"{index}="), F.coalesce(F.col(index).cast("string"), F.lit("null")), F.lit(" not found in task mapping"))).cast("string")
    return steps.join(known, index, "left").withColumn("prompt", F.coalesce("prompt", missing))


def instructions(episodes: DataFrame, annotations: DataFrame, key: str, default: str = "Do something") -> DataFrame:
    """episodes with instruction, the default where there is none."""
    return episodes.join(sized(annotations.select(key, "instruction")), key, "left").withColumn("instruction", F.coalesce("instruction", F.lit(default)))


def kept_steps(steps: DataFrame, ranges: DataFrame | None, key: str = "episode_id", step: str = "step") -> DataFrame:
    """Steps inside any [start, end) of their episode; all, where there are no ranges at all."""
    if ranges is None:
        return steps
    r = ranges.select(F.col(key).alias("_key"), "start", "end")
    return steps.join(sized(r), (F.col(key) == F.col("_key")) & (F.col(step) >= F.col("start")) & (F.col(step) < F.col("end")), "left_semi")


def with_statistics(df: DataFrame, stats: DataFrame, key: str) -> DataFrame:
    """df with the struct `stats` of one key's statistics on every row."""
    one = stats.where(F.col("key") == key).limit(1).select(F.struct("mean", "std", "q01", "q99").alias("stats"))
    return df.crossJoin(F.broadcast(one))  # one row


def with_episode_columns(steps: DataFrame, episodes: DataFrame, key: str = "episode_id") -> DataFrame:
    return steps.join(episodes, key)


def camera_frames(steps: DataFrame, frames: DataFrame, cameras: Sequence[str], key: Sequence[str] = ("episode_id", "step")) -> DataFrame:
    """Steps with a column per camera; steps without a frame of each camera are left out."""
    wide = frames.where(F.col("camera").isin(*cameras)).groupBy(*key).pivot("camera", list(cameras)).agg(F.first("frame", ignorenulls=True))
    whole = wide.where(" AND ".join(f"`{c}` IS NOT NULL" for c in cameras))
    return steps.join(whole, list(key))


def latest_values(events: DataFrame, key: str, channel: str, channels: Sequence[str], ts: str, value: str, order: str, timeout: float) -> DataFrame:
    """For each event: the latest value of every channel of its key up to then, null where it is missing or
    older than the timeout (seconds), and whether all are fresh."""
    up_to_now = W.partitionBy(key).orderBy(ts, order).rowsBetween(W.unboundedPreceding, 0)
    out = events
    for c in channels:
        own = F.when(F.col(channel) == c, F.struct(F.col(ts).alias("at"), F.col(value).alias("v")))
        out = out.withColumn(f"_{c}", F.last(own, ignorenulls=True).over(up_to_now))
    seconds = lambda x: F.unix_micros(x.cast("timestamp")) / 1e6
    ok = F.lit(True)
    for c in channels:
        is_fresh = F.coalesce((seconds(F.col(ts)) - seconds(F.col(f"_{c}.at"))) <= timeout, F.lit(False))
        out = out.withColumn(f"latest_{c}", F.when(is_fresh, F.col(f"_{c}.v")))
        ok = ok & is_fresh
    return out.withColumn("all_fresh", ok).drop(*[f"_{c}" for c in channels])


def asof(left: DataFrame, right: DataFrame, key: str, ts: str, values: Sequence[str], tolerance: float | None = None) -> DataFrame:
    """left with the values of the last row of right at or before each row's time, within the tolerance (seconds).

    One shuffle by key: both sides are put together in time order, and the last right row is carried along."""
    l = left.withColumn("_side", F.lit(1)).withColumn("_right", F.lit(None).cast(right.select(F.struct(F.col(ts).alias("at"), *values).alias("s")).schema["s"].dataType))  # noqa: E741
    r = right.select(F.col(key), F.col(ts), F.lit(0).alias("_side"), F.struct(F.col(ts).alias("at"), *values).alias("_right"))
    w = W.partitionBy(key).orderBy(ts, "_side").rowsBetween(W.unboundedPreceding, 0)
    both = l.unionByName(r, allowMissingColumns=True).withColumn("_last", F.last("_right", ignorenulls=True).over(w)).where("_side = 1")
    near = F.lit(True) if tolerance is None else (F.unix_micros(F.col(ts).cast("timestamp")) - F.unix_micros(F.col("_last.at").cast("timestamp"))) / 1e6 <= tolerance
    return both.select(*[F.col(c) for c in left.columns], *[F.when(near, F.col(f"_last.{v}")).alias(v) for v in values])


def matched_pairs(starts: DataFrame, ends: DataFrame, key: str = "pts") -> DataFrame:
    """Start and end events of one presentation time, and the time between (ms)."""
    return starts.select(key, F.col("at").alias("started")).join(ends.select(key, F.col("at").alias("ended")), key).withColumn("latency_ms", (F.col("ended") - F.col("started")) * 1000.0)


def aligned_chunk(previous: Column, prefix_start: Column, n: int) -> Column:
    """Row k is previous[prefix_start + k]; rows beyond it are zeros of the same width."""
    width = F.size(F.get(previous, F.lit(0)))
    zero = F.array_repeat(F.lit(0.0), width)
    return F.transform(F.sequence(F.lit(0), F.lit(n - 1)), lambda k: F.coalesce(F.get(previous, prefix_start + k), zero))


def merged_parameters(loaded: DataFrame, reference: DataFrame, missing: str) -> DataFrame:
    """(path, value): loaded rows that the reference has, cast to its type, and reference rows that aren't
    loaded but match the pattern."""
    kind = reference.schema["value"].dataType
    have = loaded.join(reference.select("path"), "path", "left_semi").select("path", F.col("value").cast(kind).alias("value"))
    rest = reference.join(loaded.select("path"), "path", "left_anti").where(F.col("path").rlike(f"^(?:{missing})$")).select("path", "value")
    return have.unionByName(rest)


def shared_rows(a: DataFrame, b: DataFrame, key: str) -> DataFrame:
    return a.join(b.select(key), key, "left_semi")


def unprocessed(todo: DataFrame, done: DataFrame, key: str) -> DataFrame:
    """Rows whose key isn't done yet."""
    return todo.join(done.select(key).distinct(), key, "left_anti")


def config_named(name: str, known: Iterable[str]) -> str:
    """The name, or an error with the closest known one."""
    names = list(known)
    if name in names:
        return name
    near = difflib.get_close_matches(name, names, n=1, cutoff=0.0)
    raise ValueError(f"config '{name}' not found" + (f"; did you mean '{near[0]}'?" if near else ""))
