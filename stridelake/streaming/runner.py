"""Runs state machines over tables and over streams."""

from __future__ import annotations

import json
import tempfile
import uuid
from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stridelake.workers import importable


def _plain(row: dict) -> dict:
    """pandas' missing values as None."""
    return {k: None if v is None or (isinstance(v, float) and v != v) or v is pd.NaT else v for k, v in row.items()}


def _rows(pdf: pd.DataFrame) -> Iterator[dict]:
    for r in pdf.to_dict("records"):
        yield _plain(r)


def _schema(df: DataFrame, key: str, machine) -> T.StructType:
    kind = next(f for f in df.schema.fields if f.name == key)
    return T.StructType([kind, *T._parse_datatype_string(machine.output).fields])


def over_table(df: DataFrame, machine, key: str, order: Sequence[str]) -> DataFrame:
    """Output rows with their key. Rows are shuffled by key and sorted once; each task goes through its rows
    in order with one state at a time, so a key of any length takes constant memory."""
    importable(df.sparkSession)
    schema = _schema(df, key, machine)
    names = schema.names

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        now, state = object(), None
        for pdf in batches:
            out = []
            for row in _rows(pdf):
                if row[key] != now:
                    now, state = row[key], machine.start()
                out += [{key: now} | o for o in machine.step(state, row)]
            if out:
                yield pd.DataFrame(out, columns=names)

    return df.repartition(key).sortWithinPartitions(key, *order).mapInPandas(run, schema)


def over_stream(df: DataFrame, machine, key: str, order: Sequence[str], idle_ms: int | None = None) -> DataFrame:
    """The same on a stream: rows of a micro-batch are taken in order, and state is kept between batches. With
    idle_ms the state of a key without rows for that long is dropped, and its next row starts anew; such a stream
    is for triggers that go on, as Spark keeps one that ends when its source is drained (`drained`) running for timeouts."""
    importable(df.sparkSession)
    schema = _schema(df, key, machine)
    names = schema.names

    def run(k: tuple, pdfs: Iterator[pd.DataFrame], state) -> Iterator[pd.DataFrame]:
        if state.hasTimedOut:
            state.remove()
            return
        held = json.loads(state.get[0]) if state.exists else machine.start()
        rows = pd.concat(list(pdfs)).sort_values(list(order), kind="stable")
        out = [{key: k[0]} | o for row in _rows(rows) for o in machine.step(held, row)]
        state.update((json.dumps(held),))
        if idle_ms is not None:
            state.setTimeoutDuration(idle_ms)
        if out:
            yield pd.DataFrame(out, columns=names)

    return df.groupBy(key).applyInPandasWithState(run, schema, "state string", "append", "NoTimeout" if idle_ms is None else "ProcessingTimeTimeout")


def shared_folder(spark: SparkSession, name: str) -> str:
    """A new folder below spark.checkpoint.dir, which all executors share; a temporary one only where that is unset
    and the master is local."""
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not root:
        master = spark.sparkContext.master
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        root = tempfile.mkdtemp(prefix="stridelake-")
    return f"{root.rstrip('/')}/stridelake/{name}-{uuid.uuid4().hex}"


def drained(stream: DataFrame, name: str, complete: bool = False) -> DataFrame:
    """All rows that a stream makes of what its source holds now, stored as Parquet in the shared folder.

    Batches are written by number, so one that is repeated after a failure replaces itself. complete: the
    stream's aggregates are written as a whole after each batch."""
    spark = stream.sparkSession
    folder = shared_folder(spark, name)

    def store(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{folder}/out" if complete else f"{folder}/out/batch={number}")

    q = stream.writeStream.foreachBatch(store).option("checkpointLocation", f"{folder}/state").outputMode("complete" if complete else "append").trigger(availableNow=True).start()
    q.awaitTermination()
    return spark.read.schema(stream.schema).parquet(f"{folder}/out").select(*stream.columns)


def newest_of_batch(df: DataFrame, key: str, ts: str) -> DataFrame:
    """A queue of one: each key's newest row of a micro-batch. For foreachBatch, or for a table."""
    rest = [c for c in df.columns if c != key]
    best = df.groupBy(key).agg(F.max_by(F.struct(*rest), F.col(ts)).alias("_best"))
    return best.select(key, "_best.*")


def interval_rates_stream(df: DataFrame, ts: str, seconds: int, late: str, *keys: str) -> DataFrame:
    """Events per second of each tumbling interval, with events later than `late` left out."""
    w = F.window(ts, f"{seconds} seconds")
    agg = df.withWatermark(ts, late).groupBy(w, *keys).agg(F.count("*").alias("n"))
    return agg.select(F.col("window.start").alias("start"), *keys, "n", (F.col("n") / seconds).alias("rate"))


def matched_stream(starts: DataFrame, ends: DataFrame, key: str, ts: str, within: str) -> DataFrame:
    """Inner join of start and end events of a key within a time bound, which bounds the state that is held."""
    s = starts.withWatermark(ts, within).select(F.col(key), F.col(ts).alias("started"))
    e = ends.withWatermark(ts, within).select(F.col(key).alias("_key"), F.col(ts).alias("ended"))
    on = (F.col(key) == F.col("_key")) & (F.col("ended") >= F.col("started")) & (F.col("ended") <= F.col("started") + F.expr(f"interval {within}"))
    return s.join(e, on).drop("_key")


def without_repeats_stream(df: DataFrame, keys: Sequence[str], ts: str, late: str) -> DataFrame:
    return df.withWatermark(ts, late).dropDuplicatesWithinWatermark(list(keys))
