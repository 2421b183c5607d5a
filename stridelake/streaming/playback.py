"""Playback in batch form: brokers, ramps, due times, server timing, recorders."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from stridelake.functions import vectors as V


def broker_position(step: Column, horizon: int) -> tuple[Column, Column]:
    """Chunk and place in it of a step, when a chunk is dropped after `horizon` steps."""
    return F.floor(step / horizon).cast("long"), F.pmod(step, F.lit(horizon)).cast("int")


def ramped(commands: DataFrame, key: str, order: str, target: str, ticks: int) -> DataFrame:
    """tick (from 0) and value: from what was published last to each command's target in `ticks` ticks. The
    first command of a key ramps from its own target."""
    w = W.partitionBy(key).orderBy(order)
    start = F.coalesce(F.lag(target).over(w), F.col(target))
    rows = commands.withColumn("_start", start).withColumn("tick", F.explode(F.sequence(F.lit(0), F.lit(ticks - 1))))
    return rows.withColumn("value", V.ramp(F.col("_start"), F.col(target), (F.col("tick") + 1) / float(ticks))).drop("_start")


def due_times(df: DataFrame, step: str, start: Column, period: float) -> DataFrame:
    """due: start + (step + 1) * period, which doesn't drift."""
    return df.withColumn("due", start + (F.col(step) + 1) * period)


def server_timing(df: DataFrame, key: str, order: str, total: str) -> DataFrame:
    """previous_total: the total of the reply before."""
    return df.withColumn("previous_total", F.lag(total).over(W.partitionBy(key).orderBy(order)))


def every_nth(df: DataFrame, key: str, order: str, n: int) -> DataFrame:
    return df.withColumn("_n", F.row_number().over(W.partitionBy(key).orderBy(order))).where(F.pmod("_n", F.lit(n)) == 0).drop("_n")


def if_new(df: DataFrame, key: str, order: str, mark: str) -> DataFrame:
    """Rows whose mark differs from the one before."""
    w = W.partitionBy(key).orderBy(order)
    return df.withColumn("_same", F.col(mark).eqNullSafe(F.lag(mark).over(w)) & (F.row_number().over(w) > 1)).where(~F.col("_same")).drop("_same")


def newer(df: DataFrame, key: str, order: str, ts: str) -> DataFrame:
    """Rows that are newer than all that came before them, in order of arrival; the first always is."""
    before = F.max(ts).over(W.partitionBy(key).orderBy(order).rowsBetween(W.unboundedPreceding, -1))
    return df.withColumn("_before", before).where(F.col("_before").isNull() | (F.col(ts) > F.col("_before"))).drop("_before")


def recorded(df: DataFrame, key: str, order: str, fields: Sequence[str]) -> DataFrame:
    """Each row with the latest value of each field so far: messages of several kinds, each of which fills some."""
    upto = W.partitionBy(key).orderBy(order).rowsBetween(W.unboundedPreceding, 0)
    return df.withColumns({f: F.last(f, ignorenulls=True).over(upto) for f in fields})


def episode_progress(df: DataFrame, key: str, order: str, reward: str, done: Column) -> DataFrame:
    """episode (from 0), done and episode_reward: the greatest reward of the episode so far, 0 at least. An episode
    ends with its first row that is done, and the next row starts another."""
    whole = W.partitionBy(key).orderBy(order)
    ended = F.coalesce(F.sum(F.col("done").cast("long")).over(whole.rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    rows = df.withColumn("done", F.coalesce(done, F.lit(False))).withColumn("episode", ended)
    best = F.max(reward).over(W.partitionBy(key, "episode").orderBy(order).rowsBetween(W.unboundedPreceding, 0))
    return rows.withColumn("episode_reward", F.greatest(F.lit(0.0), best))
