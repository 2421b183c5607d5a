"""Windows and sequences: chunks, runs, masks, flattening."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

MIN_IDLE, MIN_ACTIVE, DROP_LAST = 7, 16, 10


def with_steps(df: DataFrame, key: str, order: Sequence[str]) -> DataFrame:
    """step (from 0) and length of each row's episode."""
    return df.withColumn("step", F.row_number().over(W.partitionBy(key).orderBy(*order)) - 1).withColumn("length", F.count("*").over(W.partitionBy(key)))


def chunked(df: DataFrame, key: str, order: Sequence[str], value: str, horizon: int) -> DataFrame:
    """actions: the next `horizon` values from each step on, the episode's last repeating; is_pad marks those
    repeats. One shuffle and sort by episode; the frame ends where the episode does."""
    ahead = W.partitionBy(key).orderBy(*order).rowsBetween(0, horizon - 1)
    got = F.collect_list(value).over(ahead)
    out = df.withColumn("_got", got)
    n = F.size("_got")
    steps = F.sequence(F.lit(0), F.lit(horizon - 1))
    return out.withColumn("actions", F.transform(steps, lambda k: F.get("_got", F.least(k, n - 1)))).withColumn("is_pad", F.transform(steps, lambda k: k >= n)).drop("_got")


def runs(df: DataFrame, key: str, order: str, flag: str) -> DataFrame:
    """key, flag, start, end (half open, in steps) of each run of equal flags; order counts steps from 0."""
    w = W.partitionBy(key).orderBy(order)
    change = F.coalesce((F.col(flag) != F.lag(flag).over(w)).cast("int"), F.lit(1))
    island = df.withColumn("_change", change).withColumn("_run", F.sum("_change").over(w.rowsBetween(W.unboundedPreceding, 0)))
    return island.groupBy(key, "_run", flag).agg(F.min(order).alias("start"), (F.max(order) + 1).alias("end")).drop("_run")


def active_ranges(df: DataFrame, key: str, order: str, idle: str, min_idle: int = MIN_IDLE, min_active: int = MIN_ACTIVE, drop_last: int = DROP_LAST) -> DataFrame:
    """key, start, end of what is left of each episode without idle runs of min_idle steps or more, in runs of
    min_active steps or more, each less its last steps."""
    w = W.partitionBy(key).orderBy(order)
    change = F.coalesce((F.col(idle) != F.lag(idle).over(w)).cast("int"), F.lit(1))
    island = df.withColumn("_change", change).withColumn("_run", F.sum("_change").over(w.rowsBetween(W.unboundedPreceding, 0)))
    long_idle = F.col(idle) & (F.count("*").over(W.partitionBy(key, "_run")) >= min_idle)
    kept = runs(island.withColumn("_keep", ~long_idle), key, order, "_keep")
    return kept.where(F.col("_keep") & (F.col("end") - F.col("start") >= min_active)).select(key, F.col("start").cast("long"), (F.col("end") - drop_last).cast("long").alias("end"))


def steps_from_arrays(df: DataFrame, columns: Sequence[str], step: str = "step") -> DataFrame:
    """A row per step out of a row per episode of arrays; arrays of different lengths raise an error."""
    sizes = F.array_distinct(F.array(*[F.size(c) for c in columns]))
    zipped = F.arrays_zip(*[F.col(c) for c in columns])
    same = F.when(F.size(sizes) == 1, zipped).otherwise(F.raise_error(F.lit("arrays of an episode have different lengths")).cast(df.select(zipped.alias("z")).schema["z"].dataType))
    rest = [F.col(c) for c in df.columns if c not in columns]
    return df.select(*rest, F.posexplode(same).alias(step, "_z")).select(*[F.col(c) for c in df.columns if c not in columns], step, *[F.col(f"_z.{c}").alias(c) for c in columns])


def arrays_from_steps(df: DataFrame, key: str, order: str, columns: Sequence[str]) -> DataFrame:
    """A row per episode with arrays in step order."""
    rows = F.array_sort(F.collect_list(F.struct(order, *columns)))
    return df.groupBy(key).agg(rows.alias("_rows")).select(key, *[F.col(f"_rows.{c}").alias(c) for c in columns])


def largest_step_change(df: DataFrame, key: str, order: str, value: str) -> DataFrame:
    """change: the largest absolute change of any element since the step before; null at the first step."""
    before = F.lag(value).over(W.partitionBy(key).orderBy(order))
    return df.withColumn("change", F.array_max(F.zip_with(F.col(value), before, lambda a, b: F.abs(a - b))))


def held(df: DataFrame, key: str, ts: Column, order: str, error: str, tolerance: float, seconds: float) -> DataFrame:
    """converged: the error has been below the tolerance for that long without a break."""
    t = df.withColumn("_t", ts).withColumn("_bad", (F.col(error) >= tolerance).cast("int"))
    block = F.sum("_bad").over(W.partitionBy(key).orderBy("_t", order).rowsBetween(W.unboundedPreceding, 0))
    t = t.withColumn("_block", block)
    since = F.min(F.when(F.col("_bad") == 0, F.col("_t"))).over(W.partitionBy(key, "_block"))
    return t.withColumn("converged", (F.col("_bad") == 0) & (F.col("_t") - since >= seconds)).drop("_t", "_bad", "_block")


def global_positions(df: DataFrame, order: Sequence[str], ranges: int = 64) -> DataFrame:
    """position: the row's place in the order of all rows, from 0, without one task for all of them: the
    ranges are sorted apart, and each starts where the rows of those before it end. order must be unique, and
    df a stored table, so that its ranges come out the same each time they are read."""
    spark = df.sparkSession
    low = df.select(F.struct(*order).alias("o"))
    cuts = low.orderBy(F.xxhash64("o")).limit(ranges * 20).select("o").collect()
    edges = sorted((tuple(r["o"]) for r in cuts), key=lambda v: tuple((x is not None, x) for x in v))
    edges = edges[:: max(1, len(edges) // ranges)][1:]
    kind = low.schema["o"].dataType
    table = spark.createDataFrame([(i + 1, e) for i, e in enumerate(edges)], f"part int, o {kind.simpleString()}")
    at = F.coalesce(F.size(F.filter("_edges", lambda e: e["o"] <= F.struct(*order))), F.lit(0))
    listed = table.agg(F.collect_list(F.struct("part", "o")).alias("_edges"))
    parts = df.crossJoin(F.broadcast(listed)).withColumn("_part", at).drop("_edges")
    sums = parts.groupBy("_part").count().withColumn("_base", F.coalesce(F.sum("count").over(W.orderBy("_part").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))).drop("count")
    place = F.row_number().over(W.partitionBy("_part").orderBy(*order)) - 1
    return parts.withColumn("_place", place).join(F.broadcast(sums), "_part").withColumn("position", F.col("_base") + F.col("_place")).drop("_part", "_place", "_base")
