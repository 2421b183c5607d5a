"""Sinks."""

from __future__ import annotations

import json
import uuid
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stridelake.operators.joins import unprocessed


def _fs(spark: SparkSession, path: str):
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """A small file, through a temporary name."""
    fs, target = _fs(spark, path)
    _, temporary = _fs(spark, f"{path}.{uuid.uuid4().hex}.partial")
    fs.mkdirs(target.getParent())
    out = fs.create(temporary, True)
    out.write(bytearray(text.encode()))
    out.close()
    fs.delete(target, False)
    fs.rename(temporary, target)


def write_episodes(steps: DataFrame, path: str, fps: float, per_chunk: int = 1000, episode: str = "episode_id", features: Mapping[str, object] | None = None) -> None:
    """Steps as Parquet by chunk of episodes, and meta/info.json. What was there is overwritten."""
    chunk = F.floor(F.col(episode) / per_chunk).cast("int")
    rows = steps.withColumn("episode_chunk", chunk).repartition("episode_chunk", episode).sortWithinPartitions(episode, "step")
    rows.write.mode("overwrite").partitionBy("episode_chunk").parquet(f"{path}/data")
    info = {"fps": fps, "chunks_size": per_chunk, "features": features or {f.name: f.dataType.simpleString() for f in steps.schema.fields}}
    write_text(steps.sparkSession, f"{path}/meta/info.json", json.dumps(info, indent=2))


def write_statistics(stats: DataFrame, folder: str) -> None:
    """norm_stats.json of rows key, mean, std, q01, q99 (a row per key)."""
    rows = {r["key"]: {c: r[c] for c in ("mean", "std", "q01", "q99") if r[c] is not None} for r in stats.collect()}
    write_text(stats.sparkSession, f"{folder}/norm_stats.json", json.dumps({"norm_stats": rows}, indent=2))


def append_new(rows: DataFrame, path: str, key: str) -> int:
    """Appends the rows whose key isn't stored yet; the number of keys that were stored before. A run that is
    repeated after a failure goes on where files were committed."""
    spark = rows.sparkSession
    fs, p = _fs(spark, path)
    if not fs.exists(p):
        rows.write.parquet(path)
        return 0
    done = spark.read.parquet(path).select(key).distinct()
    unprocessed(rows, done, key).write.mode("append").parquet(path)
    return done.count()


def append_ranges(rows: DataFrame, path: str, key: str = "episode_id") -> int:
    """Appends (key, start, end) as JSON lines, one per key that isn't stored yet; the number of keys stored before.
    What a run committed before it failed is skipped by the next."""
    spark = rows.sparkSession
    fs, p = _fs(spark, path)
    done = spark.read.schema("key string").json(path).distinct() if fs.exists(p) else spark.createDataFrame([], "key string")
    fresh = unprocessed(rows.withColumn("key", F.col(key).cast("string")), done, "key")
    lists = fresh.groupBy("key").agg(F.array_sort(F.collect_list(F.array(F.col("start").cast("long"), F.col("end").cast("long")))).alias("ranges"))
    known = done.count()
    lists.write.mode("append").json(path)
    return known


def append_records(rows: DataFrame, path: str) -> None:
    rows.write.mode("append").parquet(path)


def write_timings(rows: DataFrame, path: str) -> None:
    """Long form: key, seq, ms, so keys may have different numbers of values."""
    rows.select("key", "seq", "ms").write.mode("overwrite").parquet(path)


def write_results(rows: DataFrame, path: str) -> None:
    rows.select("success", "duration", "video_filename").write.mode("overwrite").csv(path, header=True)


def append_json(rows: DataFrame, path: str) -> None:
    rows.write.mode("append").json(path)


def replace_folder(df: DataFrame, path: str) -> None:
    """Writes beside the folder and then takes its place, so readers never see a part. The old folder is moved aside
    and goes last: a crash between the two renames leaves both whole, under their other names."""
    spark = df.sparkSession
    mark = uuid.uuid4().hex
    temporary, old = f"{path}.tmp-{mark}", f"{path}.old-{mark}"
    df.write.parquet(temporary)
    fs, target = _fs(spark, path)
    aside = _fs(spark, old)[1]
    before = fs.exists(target)
    if before and not fs.rename(target, aside):
        raise OSError(f"can't move {path} aside")
    if not fs.rename(_fs(spark, temporary)[1], target):
        if before:
            fs.rename(aside, target)
        raise OSError(f"can't move the new rows to {path}")
    if before:
        fs.delete(aside, True)


def subsampled_frames(df: DataFrame, every: int, step: str = "step") -> DataFrame:
    """Frames that go into a video: each n-th, from 0."""
    return df.where(F.pmod(F.col(step), F.lit(every)) == 0)


def next_index(names: DataFrame, name: str = "name", pattern: str = r"out_(\d+)") -> DataFrame:
    """One more than the largest number in names, 0 without any."""
    n = F.when(F.col(name).rlike(pattern), F.regexp_extract(name, pattern, 1).cast("int"))
    return names.agg((F.coalesce(F.max(n), F.lit(-1)) + 1).alias("index"))


def commands(batch: DataFrame, send) -> None:
    """For foreachBatch: each partition's rows in order of time, to send(rows)."""
    batch.sortWithinPartitions("t").foreachPartition(send)


def reply(action: Column, infer_ms: Column, previous_ms: Column) -> Column:
    """A server's answer as JSON: action and timing; the first has no previous total."""
    return F.to_json(F.struct(action.alias("actions"), F.struct(infer_ms.alias("infer_ms"), previous_ms.alias("prev_total_ms")).alias("server_timing")))
