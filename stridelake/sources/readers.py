"""Sources."""

from __future__ import annotations

import importlib.util
import json
from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stridelake.operators.sets import concatenated
from stridelake.operators.windows import chunked, steps_from_arrays
from stridelake.workers import importable

RANGES = "map<string,array<array<bigint>>>"
STATS = "norm_stats map<string,struct<mean:array<double>,std:array<double>,q01:array<double>,q99:array<double>>>"


class MissingLibrary(RuntimeError):
    pass


def need(library: str) -> None:
    """Error unless an optional library is installed."""
    if importlib.util.find_spec(library) is None:
        raise MissingLibrary(f"this source needs {library}, which isn't installed; convert to Parquet first")


def episodes(spark: SparkSession, path: str, columns: Sequence[str] | None = None) -> DataFrame:
    """A stored dataset of steps (see writers.write_episodes), with only the columns that are asked for."""
    df = spark.read.parquet(f"{path}/data")
    return df.select(*columns) if columns else df


def dataset_info(spark: SparkSession, path: str) -> dict:
    """meta/info.json: fps, chunk size, schema of the features."""
    return json.loads(spark.read.text(f"{path}/meta/info.json", wholetext=True).first()[0])


def chunked_dataset(spark: SparkSession, path: str, horizon: int, value: str = "action", key: str = "episode_id", step: str = "step") -> DataFrame:
    """Steps with the next `horizon` actions."""
    return chunked(episodes(spark, path), key, [step], value, horizon)


def dataset(spark: SparkSession, ids: str | Sequence[str] | None, horizon: int, shapes: Mapping[str, int] | None = None, rows: int = 1024) -> DataFrame:
    """One stored dataset, several put together, or `fake` rows; none at all is an error."""
    if not ids:
        raise ValueError("no dataset is named")
    if ids == "fake":
        return fake_rows(spark, rows, shapes or {"state": 32})
    many = [ids] if isinstance(ids, str) else list(ids)
    parts = [chunked_dataset(spark, i, horizon) for i in many]
    return parts[0] if isinstance(ids, str) else concatenated(parts)


def fake_rows(spark: SparkSession, n: int, shapes: Mapping[str, int], integers: Sequence[str] = ()) -> DataFrame:
    """n rows whose values are hashes of (row, column, place): uniform in [-1, 1), or integers below 2048."""
    def drawn(name: str):
        return lambda k: F.pmod(F.xxhash64("index", F.lit(name), k), F.lit(1 << 30))

    def whole(h):
        return lambda k: F.pmod(h(k), F.lit(2048)).cast("int")

    def real(h):
        return lambda k: h(k) / float(1 << 29) - 1

    df = spark.range(n).withColumnRenamed("id", "index")
    for name, size in shapes.items():
        value = (whole if name in integers else real)(drawn(name))
        df = df.withColumn(name, F.transform(F.sequence(F.lit(0), F.lit(size - 1)), value))
    return df


def low_dimensional(df: DataFrame, kinds: tuple[type, ...] = (T.BinaryType,)) -> DataFrame:
    """Without image and video columns, so that the scan doesn't read them."""

    def heavy(t: T.DataType) -> bool:
        return isinstance(t, kinds) or isinstance(t, T.StructType) and any(heavy(f.dataType) for f in t.fields) or isinstance(t, T.ArrayType) and heavy(t.elementType) or isinstance(t, T.MapType) and heavy(t.valueType)

    return df.drop(*[f.name for f in df.schema.fields if heavy(f.dataType)])


def found_files(spark: SparkSession, path: str, pattern: str) -> DataFrame:
    """path, length and modificationTime of files below a folder, by glob; contents aren't read."""
    return spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", pattern).load(path).select("path", "length", "modificationTime")


def episode_order(files: DataFrame) -> DataFrame:
    """episode_id of each file: its place in the order of paths, for lists that fit one task."""
    from pyspark.sql import Window as W

    return files.withColumn("episode_id", F.dense_rank().over(W.orderBy("path")) - 1)


def probed(spark: SparkSession, files: Sequence[str], optional: Sequence[str]) -> list[str]:
    """Which optional columns the first file has; all files are read with that schema."""
    have = spark.read.parquet(files[0]).columns
    return [c for c in optional if c in have and "depth" not in c]


def columnar_episode(df: DataFrame, leaves: Sequence[str]) -> DataFrame:
    """Steps out of episodes of equally long leaf arrays."""
    return steps_from_arrays(df, leaves)


def stepped(datasets: Sequence[DataFrame], steps: str = "steps") -> DataFrame:
    """All datasets, one row per element of the array of step structs, with its place."""
    rows = concatenated(datasets)
    rest = [c for c in rows.columns if c != steps]
    return rows.select(*rest, F.posexplode(steps).alias("step", "_s")).select(*rest, "step", "_s.*")


def replay(spark: SparkSession, path: str, episode: int, column: str, per_chunk: int) -> DataFrame:
    """step and one column of one episode; its chunk folder is the only one that is listed."""
    return spark.read.parquet(f"{path}/data").where((F.col("episode_chunk") == episode // per_chunk) & (F.col("episode_id") == episode)).select("step", column)


def keep_ranges(spark: SparkSession, path: str) -> DataFrame:
    """episode_id, start, end of a JSON object of lists of pairs."""
    raw = spark.read.text(path, wholetext=True).select(F.from_json("value", RANGES).alias("m"))
    return raw.select(F.explode("m").alias("episode_id", "r")).select("episode_id", F.explode("r").alias("p")).select("episode_id", F.col("p")[0].alias("start"), F.col("p")[1].alias("end"))


def stored_ranges(spark: SparkSession, path: str) -> DataFrame:
    """episode_id, start, end of the JSON lines of writers.append_ranges."""
    rows = spark.read.schema("key string, ranges array<array<bigint>>").json(path)
    return rows.select(F.col("key").alias("episode_id"), F.explode("ranges").alias("p")).select("episode_id", F.col("p")[0].alias("start"), F.col("p")[1].alias("end"))


def annotations(spark: SparkSession, path: str) -> DataFrame:
    """episode_id and its fields, of a JSON object of objects of text."""
    raw = spark.read.text(path, wholetext=True).select(F.from_json("value", "map<string,map<string,string>>").alias("m"))
    return raw.select(F.explode("m").alias("episode_id", "fields"))


def statistics(spark: SparkSession, folder: str, strict: bool = True) -> DataFrame | None:
    """key, mean, std, q01, q99 of norm_stats.json; a missing file is an error, or None if not strict."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{folder}/norm_stats.json")
    if not path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(path):
        if strict:
            raise FileNotFoundError(f"{folder}/norm_stats.json")
        return None
    raw = spark.read.schema(STATS).option("multiLine", "true").json(f"{folder}/norm_stats.json")
    return raw.select(F.explode("norm_stats").alias("key", "s")).select("key", "s.*")


def stale(path: Column, modified: Column, rules: Sequence[tuple[str, str]]) -> Column:
    """Whether a cached file is out of date: the first pattern that matches its path gives the last UTC time
    that is too old; no match is not stale."""
    out = None
    for pattern, expiry in rules:
        old = modified <= F.to_timestamp(F.lit(expiry))
        out = F.when(path.rlike(f"^(?:{pattern})$"), old) if out is None else out.when(path.rlike(f"^(?:{pattern})$"), old)
    return F.lit(False) if out is None else out.otherwise(F.lit(False))


def records(spark: SparkSession, path: str) -> DataFrame:
    """Stored policy records in order of step."""
    return spark.read.parquet(path).orderBy("step")


def joint_limits(spark: SparkSession, limits: Mapping[str, tuple[Sequence[float], Sequence[float]]]) -> DataFrame:
    """arm, lower, upper: a small dimension table."""
    return spark.createDataFrame([(a, [float(x) for x in lo], [float(x) for x in hi]) for a, (lo, hi) in limits.items()], "arm string, lower array<double>, upper array<double>")


def event_stream(spark: SparkSession, path: str, schema: T.StructType | str, per_batch: int = 1) -> DataFrame:
    """Parquet files of a folder as a stream, so many a batch."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", per_batch).parquet(path)


def converted(spark: SparkSession, files: DataFrame, reader: Callable[[bytes], list[dict]], schema: str, library: str | None = None) -> DataFrame:
    """Rows that a reader of a file format makes of each file's bytes, on the executors. library: what the
    reader needs, checked first (HDF5 and TFRecord readers need one that may not be here)."""
    if library:
        need(library)
    import pandas as pd

    importable(spark)
    names = T._parse_datatype_string(schema).fieldNames()

    def run(batches):
        for pdf in batches:
            for content in pdf["content"]:
                yield pd.DataFrame(reader(content), columns=names)

    return files.select("content").mapInPandas(run, schema)


#: Shapes of a robot's rows, by preset.
SHAPES = {
    "dual_arm_14": {"state": 14, "actions": 14},
    "single_arm_8": {"joints": 7, "gripper": 1, "actions": 8},
    "single_arm_7": {"joints": 6, "gripper": 1, "actions": 7},
    "two_hands_first": {"state": 48, "actions": 48},
    "two_hands_second": {"state": 62, "actions": 62},
}


def robot_rows(spark: SparkSession, name: str, n: int, horizon: int = 1, prompt: str = "do something") -> DataFrame:
    """n made-up rows of a robot, with chunks of `horizon` equal actions."""
    df = fake_rows(spark, n, SHAPES[name]).withColumn("prompt", F.lit(prompt))
    return df.withColumn("actions", F.array_repeat("actions", horizon))


def fetched(spark: SparkSession, url: str, cache: str, force: bool = False) -> str:
    """A copy of a remote file in the cache folder, made under a partial name and then renamed; a path without
    a scheme is checked and returned. For files that aren't read as tables, such as vocabularies."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    source = jvm.org.apache.hadoop.fs.Path(url)
    fs = source.getFileSystem(conf)
    if "://" not in url:
        if not fs.exists(source):
            raise FileNotFoundError(url)
        return url
    target = jvm.org.apache.hadoop.fs.Path(f"{cache.rstrip('/')}/{url.split('://', 1)[1]}")
    to = target.getFileSystem(conf)
    if force or not to.exists(target):
        partial = target.suffix(".partial")
        jvm.org.apache.hadoop.fs.FileUtil.copy(fs, source, to, partial, False, True, conf)
        to.delete(target, True)
        to.rename(partial, target)
    return target.toString()


def request_stream(spark: SparkSession, folder: str, request: str, line: str = "line") -> DataFrame:
    """One row per line of the JSON files that arrive in a folder: the fields of `request`, a schema, all null where a
    line isn't JSON, and the line itself."""
    lines = spark.readStream.text(folder).withColumnRenamed("value", line)
    return lines.withColumn("_r", F.from_json(line, request, {"mode": "PERMISSIVE"})).select("_r.*", line)
