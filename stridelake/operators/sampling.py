"""Sampling, shuffling, batching: all drawn by hashes of (seed, key), never by partition."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W


def draw(seed: int | str, *keys: str | Column) -> Column:
    """A uniform hex string of the seed and keys, the same in any engine that has md5."""
    parts = [k if isinstance(k, Column) else F.col(k) for k in keys]
    return F.md5(F.concat_ws(":", F.lit(str(seed)), *[p.cast("string") for p in parts]))


def sampled_steps(df: DataFrame, key: str, step: str, k: int, seed: int) -> DataFrame:
    """k steps of each episode at most, without replacement, in step order."""
    rank = F.row_number().over(W.partitionBy(key).orderBy(draw(seed, key, step), step))
    return df.withColumn("_rank", rank).where(F.col("_rank") <= k).drop("_rank")


def shuffled(df: DataFrame, seed: int, epoch: int, *keys: str) -> DataFrame:
    """All rows in an order drawn for the epoch; a range sort."""
    return df.orderBy(draw(f"{seed}:{epoch}", *keys), *keys)


def epochs(df: DataFrame, n: int) -> DataFrame:
    """Each row n times, with its epoch."""
    return df.withColumn("epoch", F.explode(F.sequence(F.lit(0), F.lit(n - 1))))


def first_rows(df: DataFrame, n: int, seed: int, *keys: str) -> DataFrame:
    """n rows of the drawn order (a limit is what this operator is for)."""
    return df.orderBy(draw(seed, *keys), *keys).limit(n)


def batched(df: DataFrame, size: int, seed: int, keys: Sequence[str], shards: int = 64, drop_last: bool = True) -> DataFrame:
    """shard, batch and slot of rows in a drawn order. Rows are dealt to shards by a hash, and each shard is
    ordered and batched by itself, so with several shards no task sees all rows. Batches that aren't full
    are dropped unless they are wanted."""
    d = draw(seed, *keys)
    shard = F.pmod(F.conv(F.substring(d, 1, 8), 16, 10).cast("long"), F.lit(shards)).cast("int")
    place = F.row_number().over(W.partitionBy("shard").orderBy(draw(f"{seed}:order", *keys), *keys)) - 1
    rows = df.withColumn("shard", shard).withColumn("_place", place)
    if drop_last:
        rows = rows.withColumn("_n", F.count("*").over(W.partitionBy("shard"))).where(F.floor(F.col("_place") / size) < F.floor(F.col("_n") / size)).drop("_n")
    return rows.withColumn("batch", F.floor(F.col("_place") / size).cast("long")).withColumn("slot", F.pmod("_place", F.lit(size)).cast("int")).drop("_place")


def rank_share(df: DataFrame, world: int, rank: int, seed: int, epoch: int, *keys: str) -> DataFrame:
    """The rows of one of `world` readers in an epoch: dealt by hash, disjoint and complete."""
    d = F.conv(F.substring(draw(f"{seed}:{epoch}", *keys), 1, 8), 16, 10).cast("long")
    return df.where(F.pmod(d, F.lit(world)) == rank)


def one_of(choices: Column, seed: int, *keys: str) -> Column:
    """One element for each key: drawn per episode, not per step, when the key is the episode's."""
    d = F.conv(F.substring(draw(seed, *keys), 1, 8), 16, 10).cast("long")
    return F.get(choices, F.pmod(d, F.size(choices)).cast("int"))


def categorical(logits: Column, temperature: float, seed: int, *keys: str) -> Column:
    """Index drawn with probability softmax(logits / temperature), by Gumbel's trick; argmax at temperature 0."""
    if temperature <= 0:
        return (F.array_position(logits, F.array_max(logits)) - 1).cast("int")

    def noisy(v: Column, i: Column) -> Column:
        d = F.conv(F.substring(F.md5(F.concat_ws(":", F.lit(str(seed)), *[F.col(k).cast("string") for k in keys], i.cast("string"))), 1, 8), 16, 10).cast("double")
        return v / temperature - F.log(-F.log((d + 0.5) / float(1 << 32)))

    x = F.transform(logits, noisy)
    return (F.array_position(x, F.array_max(x)) - 1).cast("int")


def stacked(df: DataFrame, batch: Sequence[str], slot: str, columns: Sequence[str]) -> DataFrame:
    """A row per batch with arrays in slot order."""
    rows = F.array_sort(F.collect_list(F.struct(slot, *columns)))
    return df.groupBy(*batch).agg(rows.alias("_rows")).select(*batch, *[F.col(f"_rows.{c}").alias(c) for c in columns])
