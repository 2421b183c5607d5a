"""Aggregations: per-dimension statistics, timings, rates, summaries."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

QUANTILES = (0.01, 0.99)


def refined_quantiles(long: DataFrame, keys: Sequence[str], value: str, quantiles: Sequence[float], bins: int = 4096, edges: DataFrame | None = None) -> DataFrame:
    """keys and q (an array): exact quantiles, linear between ranks, of any number of rows. edges, if they are known:
    keys, _low, _high and _n (values that aren't null) of each group.

    Three passes with bounded memory: the range of each group; counts of its equal bins, which tell the bins
    that hold the ranks; and the distinct values of those bins alone, with their counts."""
    on = list(keys)
    if edges is None:
        edges = long.where(F.col(value).isNotNull()).groupBy(*on).agg(F.min(value).alias("_low"), F.max(value).alias("_high"), F.count(value).alias("_n"))
    width = (F.col("_high") - F.col("_low")) / bins
    place = F.when(width > 0, F.least(F.floor((F.col(value) - F.col("_low")) / width), F.lit(bins - 1))).otherwise(0).cast("int")
    placed = long.where(F.col(value).isNotNull()).join(edges, on).withColumn("_bin", place)
    counts = placed.groupBy(*on, "_bin").agg(F.count("*").alias("_c"), F.first("_n").alias("_n"))
    upto = W.partitionBy(*on).orderBy("_bin").rowsBetween(W.unboundedPreceding, -1)
    counts = counts.withColumn("_before", F.coalesce(F.sum("_c").over(upto), F.lit(0)))
    ranks = F.array(*[r for q in quantiles for r in (F.floor(F.col("_n") * q - q), F.ceil(F.col("_n") * q - q))])
    inside = F.exists(ranks, lambda r: (r >= F.col("_before")) & (r < F.col("_before") + F.col("_c")))
    held = placed.join(counts.where(inside).select(*on, "_bin", "_before"), [*on, "_bin"])
    values = held.groupBy(*on, "_bin", "_before", "_n", value).agg(F.count("*").alias("_c"))
    within = W.partitionBy(*on, "_bin").orderBy(value).rowsBetween(W.unboundedPreceding, -1)
    values = values.withColumn("_first", F.col("_before") + F.coalesce(F.sum("_c").over(within), F.lit(0)))
    at = lambda r: F.max(F.when((r >= F.col("_first")) & (r < F.col("_first") + F.col("_c")), F.col(value)))
    pairs = [(at(F.floor(F.col("_n") * q - q)).alias(f"_a{i}"), at(F.ceil(F.col("_n") * q - q)).alias(f"_b{i}")) for i, q in enumerate(quantiles)]
    rows = values.groupBy(*on, "_n").agg(*[c for pair in pairs for c in pair])
    share = lambda q: F.col("_n") * q - q - F.floor(F.col("_n") * q - q)
    return rows.select(*on, F.array(*[F.col(f"_a{i}") + share(q) * (F.col(f"_b{i}") - F.col(f"_a{i}")) for i, q in enumerate(quantiles)]).alias("q"))


def vector_statistics(df: DataFrame, columns: Sequence[str], method: str = "refined", accuracy: int = 100_000) -> DataFrame:
    """key, dim, count, mean, std (population), min, max, q01, q99: a row per column and dimension.

    Partial aggregation per (key, dim). Quantiles by method: `refined` exact in bounded memory, for tables of any
    size, in three passes; `exact` in one pass, with the distinct values of a dimension in memory, for tables known
    to be small; `approx` in one pass with memory of the accuracy. Everything else is exact, and nothing depends on partitioning. Vectors of one
    column should have one length; a row per column and dimension is small enough to broadcast."""
    if method not in ("exact", "refined", "approx"):
        raise ValueError(f"unknown method {method}")
    elements = F.explode(F.array(*[F.struct(F.lit(c).alias("key"), F.col(c).cast("array<double>").alias("x")) for c in columns]))
    long = df.select(elements.alias("e")).select("e.key", F.posexplode("e.x").alias("dim", "x"))
    plain = [F.count("x").alias("count"), F.avg("x").alias("mean"), F.stddev_pop("x").alias("std"), F.min("x").alias("min"), F.max("x").alias("max")]
    if method == "refined":
        agg = long.groupBy("key", "dim").agg(*plain)
        edges = F.broadcast(agg.select("key", "dim", F.col("min").alias("_low"), F.col("max").alias("_high"), F.col("count").alias("_n")))
        agg = agg.join(F.broadcast(refined_quantiles(long, ["key", "dim"], "x", QUANTILES, edges=edges)), ["key", "dim"], "left")
    else:
        q = F.percentile("x", F.array(*[F.lit(v) for v in QUANTILES])) if method == "exact" else F.percentile_approx("x", list(QUANTILES), accuracy)
        agg = long.groupBy("key", "dim").agg(*plain, q.alias("q"))
    return agg.select("key", "dim", "count", "mean", "std", "min", "max", F.get("q", F.lit(0)).alias("q01"), F.get("q", F.lit(1)).alias("q99"))


def moments(df: DataFrame, column: str, dims: int) -> DataFrame:
    """count, mean and std of each of `dims` dimensions, one row: no explosion, one wide partial aggregate.

    For vectors of a known, moderate length: each dimension is an expression inside one generated loop."""
    x = [F.get(F.col(column), F.lit(i)).cast("double") for i in range(dims)]
    return df.agg(F.count("*").alias("count"), F.array(*[F.avg(c) for c in x]).alias("mean"), F.array(*[F.stddev_pop(c) for c in x]).alias("std"))


def packed_statistics(stats: DataFrame) -> DataFrame:
    """key and arrays mean, std, q01, q99 in order of dim; error for keys with fewer than two rows counted."""
    s = F.array_sort(F.collect_list(F.struct("dim", "mean", "std", "q01", "q99", "count")))
    rows = stats.groupBy("key").agg(s.alias("s"))
    few = F.exists("s", lambda v: v["count"] < 2)
    rows = rows.withColumn("s", F.when(few, F.raise_error(F.lit("statistics need two rows or more")).cast(rows.schema["s"].dataType)).otherwise(F.col("s")))
    return rows.select("key", *[F.col(f"s.{c}").alias(c) for c in ("mean", "std", "q01", "q99")])


def histogram_quantiles(df: DataFrame, column: str, bins: int = 5000, quantiles: Sequence[float] = QUANTILES) -> DataFrame:
    """dim and the left edge of the first of `bins` equal bins whose running count reaches q * count: the
    histogram's answer, but over the range of all rows (two passes), so it loses no mass."""
    long = df.select(F.posexplode(F.col(column).cast("array<double>")).alias("dim", "x"))
    edges = long.groupBy("dim").agg(F.min("x").alias("low"), F.max("x").alias("high"), F.count("x").alias("n"))
    width = (F.col("high") - F.col("low")) / bins
    binned = long.join(F.broadcast(edges), "dim").withColumn("bin", F.when(width > 0, F.least(F.floor((F.col("x") - F.col("low")) / width), F.lit(bins - 1))).otherwise(0))
    counts = binned.groupBy("dim", "bin", "low", "high", "n").agg(F.count("*").alias("c"))
    up_to = F.sum("c").over(W.partitionBy("dim").orderBy("bin").rowsBetween(W.unboundedPreceding, 0))
    running = counts.withColumn("sum", up_to)
    out = [F.min(F.when(F.col("sum") >= F.lit(q) * F.col("n"), F.col("low") + width * F.col("bin"))).alias(f"q{round(q * 100):02d}") for q in quantiles]
    return running.groupBy("dim").agg(*out)


def chunk_weights(length: Column, step: Column, horizon: int) -> Column:
    """How often a step is in its episode's chunks of `horizon` steps, the last one repeating at the end."""
    m = F.least(length, F.lit(horizon))
    last = m * horizon - (m * (m - 1) / 2)
    return F.when(step < length - 1, F.least(step + 1, F.lit(horizon))).otherwise(last).cast("double")


def weighted_statistics(df: DataFrame, column: str, weight: str) -> DataFrame:
    """dim, weight, mean, std of exploded vectors, each row counted `weight` times; no explosion of chunks."""
    long = df.select(F.col(weight).alias("w"), F.posexplode(F.col(column).cast("array<double>")).alias("dim", "x"))
    agg = long.groupBy("dim").agg(F.sum("w").alias("weight"), F.sum(F.col("w") * F.col("x")).alias("s"), F.sum(F.col("w") * F.col("x") * F.col("x")).alias("ss"))
    mean = F.col("s") / F.col("weight")
    return agg.select("dim", "weight", mean.alias("mean"), F.sqrt(F.greatest(F.lit(0.0), F.col("ss") / F.col("weight") - mean * mean)).alias("std"))


def timing_statistics(df: DataFrame, key: str, value: str) -> DataFrame:
    """mean, std (population) and exact percentiles 25, 50, 75, 90, 95, 99 by key, in bounded memory; rows without a key
    are left out."""
    df = df.where(F.col(key).isNotNull())
    q = (0.25, 0.5, 0.75, 0.9, 0.95, 0.99)
    agg = df.groupBy(key).agg(F.avg(value).alias("mean"), F.stddev_pop(value).alias("std")).join(refined_quantiles(df, [key], value, q), key, "left")
    return agg.select(key, "mean", "std", *[F.get("q", F.lit(i)).alias(f"p{int(v * 100)}") for i, v in enumerate(q)])


def success_rates(df: DataFrame, task: str, success: str) -> DataFrame:
    """Trials, successes and rate of each task and, with task null, of all."""
    return df.rollup(task).agg(F.count("*").alias("trials"), F.sum(F.col(success).cast("int")).alias("successes"), F.avg(F.col(success).cast("double")).alias("rate"))


def rolling_rate(df: DataFrame, key: str, ts: str, order: str, last: int, latency: str | None = None) -> DataFrame:
    """rate of the last samples, (n - 1) / time spanned, 0 with fewer than two, and their mean latency."""
    w = W.partitionBy(key).orderBy(ts, order).rowsBetween(-(last - 1), 0)
    t = F.unix_micros(F.col(ts).cast("timestamp")) / 1e6
    n, span = F.count("*").over(w), F.max(t).over(w) - F.min(t).over(w)
    out = df.withColumn("rate", F.when((n >= 2) & (span > 0), (n - 1) / span).otherwise(0.0))
    return out if latency is None else out.withColumn("mean_latency", F.avg(latency).over(w))


def interval_rates(df: DataFrame, ts: str, seconds: int, *keys: str) -> DataFrame:
    """Start, events and events per second of each tumbling interval."""
    w = F.window(F.col(ts).cast("timestamp"), f"{seconds} seconds")
    return df.groupBy(w.alias("w"), *keys).agg(F.count("*").alias("n")).select(F.col("w.start").alias("start"), *keys, "n", (F.col("n") / seconds).alias("rate"))


def mean_frequency(df: DataFrame, key: str, ts: str, order: str, last: int = 50) -> DataFrame:
    """1 / mean time between the last samples of each key."""
    newest = F.row_number().over(W.partitionBy(key).orderBy(F.col(ts).desc(), F.col(order).desc()))
    t = F.unix_micros(F.col(ts).cast("timestamp")) / 1e6
    kept = df.withColumn("_n", newest).where(F.col("_n") <= last)
    return kept.groupBy(key).agg(F.when((F.count("*") > 1) & (F.max(t) > F.min(t)), (F.count("*") - 1) / (F.max(t) - F.min(t))).alias("frequency"))


def interval_means(df: DataFrame, step: str, every: int, metrics: Sequence[str]) -> DataFrame:
    """Means of metrics between log steps: step 0 alone, then (0, every], (every, 2 * every] ..."""
    group = F.ceil(F.col(step) / every)
    return df.groupBy(group.alias("log")).agg(F.max(step).alias(step), *[F.avg(m).alias(m) for m in metrics])


def tree_norm(df: DataFrame, value: str, *keys: str) -> DataFrame:
    return df.groupBy(*keys).agg(F.sqrt(F.sum(F.col(value) * F.col(value))).alias("norm"))


def episode_summary(df: DataFrame, key: str, order: Sequence[str], value: str) -> DataFrame:
    """First, last, least and greatest value and the largest change in one step, by episode."""
    w = W.partitionBy(key).orderBy(*order)
    jump = df.withColumn("_jump", F.abs(F.col(value) - F.lag(value).over(w))).withColumn("_at", F.struct(*order))
    return jump.groupBy(key).agg(F.min_by(value, "_at").alias("first"), F.max_by(value, "_at").alias("last"), F.min(value).alias("least"), F.max(value).alias("greatest"), F.max("_jump").alias("largest_jump"), F.count("*").alias("steps"))


def observed_quantile(df: DataFrame, key: str, order: str, value: str, last: int, q: float) -> DataFrame:
    """The quantile of each row's last values, its own included."""
    w = W.partitionBy(key).orderBy(order).rowsBetween(-(last - 1), 0)
    return df.withColumn("quantile", F.percentile(value, F.lit(q)).over(w))


def ranges_by_episode(episodes: DataFrame, ranges: DataFrame, key: str) -> DataFrame:
    """key and ranges, an ordered list of (start, end); an empty one where an episode has none."""
    lists = ranges.groupBy(key).agg(F.array_sort(F.collect_list(F.struct("start", "end"))).alias("ranges"))
    empty = F.array().cast("array<struct<start:bigint,end:bigint>>")
    return episodes.select(key).distinct().join(lists, key, "left").withColumn("ranges", F.coalesce(F.col("ranges").cast("array<struct<start:bigint,end:bigint>>"), empty))


def require_unique(df: DataFrame, key: str) -> None:
    repeated = df.groupBy(key).count().where("count > 1").limit(1).collect()
    if repeated:
        raise ValueError(f"{key} {repeated[0][0]!r} isn't unique")


def latest_checkpoint(names: DataFrame, name: str = "name") -> DataFrame:
    """The largest all-digit name, as a number."""
    return names.where(F.col(name).rlike("^[0-9]+$")).agg(F.max(F.col(name).cast("long")).alias("step"))
