"""More queries of the driver contract: images, trajectories as one plan, and tables that go through sinks and come
back through sources, each with the DuckDB SQL that it equals. Imported by queries.py."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stridelake.functions import images as I
from stridelake.functions import text as X
from stridelake.operators import projections, stats, windows
from stridelake.plans import trajectories
from stridelake.queries import STEP_SQL, query, r6, t, user_steps, vectors64
from stridelake.sources import readers, writers
from stridelake.streaming.runner import shared_folder

# --- images: frames of 2 x 4 pixels of 4 channels, made of hashes of vec_id

FRAME_SQL = "SELECT vec_id, upper(md5('a:' || CAST(vec_id AS VARCHAR)) || md5('b:' || CAST(vec_id AS VARCHAR))) AS hx FROM embeddings"


def frames(spark: SparkSession, sf: str) -> DataFrame:
    half = lambda k: F.unhex(F.md5(F.concat(F.lit(k), F.col("vec_id").cast("string")).cast("binary")))
    size = [F.lit(v).alias(k) for k, v in (("h", 2), ("w", 4), ("c", 4))]
    return t(spark, sf, "embeddings").select("vec_id", F.struct(*size, F.concat(half("a:"), half("b:")).alias("data")).alias("frame"))


def moved(*views: tuple[str, int, str]) -> str:
    """SQL for frames whose i-th byte, of n, is the source's byte at a place given as an expression of i."""
    hexes = [f"array_to_string(list_transform(range({n}), lambda i: substr(hx, CAST(2 * ({at}) + 1 AS BIGINT), 2)), '') AS {name}" for name, n, at in views]
    return f"SELECT vec_id, {', '.join(hexes)} FROM ({FRAME_SQL})"


@query(moved(("both", 32, "(7 - i // 4) * 4 + i % 4"), ("half", 16, "(7 - (i // 8) * 4 - i % 8 // 4) * 4 + i % 4"), ("reversed", 24, "(i // 3) * 4 + 2 - i % 3")))
def turned_frames(spark: SparkSession, sf: str) -> DataFrame:
    shown = [F.hex(f("frame")["data"]).alias(name) for name, f in (("both", I.turned), ("half", I.stereo_left), ("reversed", I.channels_reversed))]
    return frames(spark, sf).select("vec_id", *shown)


@query(f"SELECT vec_id, CAST(i AS INTEGER) AS place, round(CAST('0x' || substr(hx, CAST(2 * i + 1 AS BIGINT), 2) AS INTEGER) / 255.0 * 2 - 1, 5) + 0.0 AS x FROM (SELECT vec_id, hx, unnest(range(32)) AS i FROM ({FRAME_SQL}))")
def scaled_frames(spark: SparkSession, sf: str) -> DataFrame:
    out = frames(spark, sf).select("vec_id", F.posexplode(I.scaled("frame")).alias("place", "x"))
    return out.select("vec_id", "place", (F.round(F.col("x").cast("double"), 5) + F.lit(0.0)).alias("x"))


# doubled in both directions: each pixel is 3/4 of the nearest and 1/4 of the next one, columns first
PADDED = f"""WITH p AS (SELECT vec_id, i // 16 AS y, i // 4 % 4 AS x, i % 4 AS c, CAST('0x' || substr(hx, CAST(2 * i + 1 AS BIGINT), 2) AS INTEGER) AS v FROM (SELECT vec_id, hx, unnest(range(32)) AS i FROM ({FRAME_SQL}))),
wide AS (SELECT a.vec_id, a.y, a.c, o.x AS x, floor(0.75::DOUBLE * a.v + 0.25::DOUBLE * b.v + 0.5::DOUBLE) AS v FROM (SELECT unnest(range(8)) AS x) o JOIN p a ON a.x = o.x // 2
  JOIN p b ON b.vec_id = a.vec_id AND b.y = a.y AND b.c = a.c AND b.x = least(3, greatest(0, CASE WHEN o.x % 2 = 0 THEN a.x - 1 ELSE a.x + 1 END))),
tall AS (SELECT a.vec_id, a.x, a.c, o.y AS y, CAST(floor(0.75::DOUBLE * a.v + 0.25::DOUBLE * b.v + 0.5::DOUBLE) AS INTEGER) AS v FROM (SELECT unnest(range(4)) AS y) o JOIN wide a ON a.y = o.y // 2
  JOIN wide b ON b.vec_id = a.vec_id AND b.x = a.x AND b.c = a.c AND b.y = least(1, greatest(0, CASE WHEN o.y % 2 = 0 THEN a.y - 1 ELSE a.y + 1 END)))
SELECT vec_id, 256 AS n_bytes, CAST(sum(v * ((y + 2) * 32 + x * 4 + c + 1)) AS BIGINT) AS weighted FROM tall GROUP BY vec_id"""


@query(PADDED)
def padded_frames(spark: SparkSession, sf: str) -> DataFrame:
    """Resized to fit 8 x 8 pixels, and the sum of each byte times its place."""
    out = frames(spark, sf).select("vec_id", I.resize_with_pad(F.col("frame"), 8, 8)["data"].alias("d"))
    byte = F.posexplode(F.transform(F.sequence(F.lit(0), F.lit(255)), lambda i: F.conv(F.hex(F.substring("d", i + 1, F.lit(1))), 16, 10).cast("long")))
    places = out.select("vec_id", F.length("d").alias("n_bytes"), byte.alias("i", "v"))
    return places.groupBy("vec_id", "n_bytes").agg(F.sum(F.col("v") * (F.col("i") + 1)).alias("weighted"))


@query("SELECT p_partkey, unnest(['head_left_eye', 'left_wrist_right_eye']) AS name, CAST(unnest([round_even(p_size * 10 * 0.125, 0), round_even(p_size * 10 * 0.5, 0)]) AS INTEGER) AS x1, CAST(unnest([round_even(p_size * 6 * 0.3529411765, 0), round_even(p_size * 6 * 0.8529411765, 0)]) AS INTEGER) AS y1 FROM part")
def view_corners(spark: SparkSession, sf: str) -> DataFrame:
    boxes = t(spark, sf, "part").select("p_partkey", F.explode(I.view_boxes(F.col("p_size").cast("int") * 10, F.col("p_size").cast("int") * 6)).alias("name", "box"))
    return boxes.where(F.col("name").isin("head_left_eye", "left_wrist_right_eye")).select("p_partkey", "name", F.col("box")[0].alias("x1"), F.col("box")[1].alias("y1"))


# --- trajectories and sinks

STEPS_SQL = f"SELECT user_id, event_id, value, {STEP_SQL} AS step, count(*) OVER (PARTITION BY user_id) AS length FROM events"


@query(f"""WITH s AS ({STEPS_SQL}), k AS (SELECT *, unnest(range(3)) AS k FROM s WHERE length % 2 = 0 AND step >= 2 AND step < 12)
SELECT k.user_id, CAST(k.step AS INTEGER) AS step, CAST(k.k AS INTEGER) AS k, k.event_id, a.value AS action FROM k JOIN s a ON a.user_id = k.user_id AND a.step = least(k.step + k.k, k.length - 1)""")
def trajectory_source(spark: SparkSession, sf: str) -> DataFrame:
    """Episodes of an even length count as successes; steps 2 to 11 of each are kept."""
    episodes = windows.arrays_from_steps(user_steps(spark, sf), "user_id", "step", ["event_id", "value"])
    ranges = episodes.select("user_id", F.lit(2).alias("start"), F.lit(12).alias("end"))
    out = trajectories.trajectory_source(episodes, F.size("value") % 2 == 0, ["event_id"], "value", 3, ranges, "user_id")
    return out.select("user_id", "step", "event_id", F.posexplode("value").alias("k", "action"))


@query(f"""WITH s AS ({STEPS_SQL}), k AS (SELECT *, CAST(unnest(range(2)) AS INTEGER) AS k FROM s) SELECT k.user_id AS episode_id, k.step, k.k, a.value AS action, k.step + k.k >= k.length AS is_pad FROM k JOIN s a ON a.user_id = k.user_id AND a.step = least(k.step + k.k, k.length - 1)""")
def stored_episode_chunks(spark: SparkSession, sf: str) -> DataFrame:
    path = shared_folder(spark, "episodes")
    steps = user_steps(spark, sf).select(F.col("user_id").cast("long").alias("episode_id"), F.col("step").cast("long").alias("step"), F.col("value").alias("action"))
    writers.write_episodes(steps, path, 10.0, per_chunk=100)
    out = readers.chunked_dataset(spark, path, 2).select("episode_id", "step", F.posexplode(F.arrays_zip("actions", "is_pad")).alias("k", "v"))
    return out.select("episode_id", "step", "k", F.col("v.actions").alias("action"), F.col("v.is_pad").alias("is_pad"))


@query("SELECT CAST(l_orderkey AS VARCHAR) AS episode_id, CAST(l_linenumber AS BIGINT) AS start, CAST(l_linenumber + l_quantity AS BIGINT) AS \"end\" FROM lineitem")
def resumed_ranges(spark: SparkSession, sf: str) -> DataFrame:
    """Ranges of the orders that were returned are stored by a first run, and those of all by a second."""
    path = shared_folder(spark, "ranges")
    rows = t(spark, sf, "lineitem").select(F.col("l_orderkey").alias("episode_id"), F.col("l_linenumber").cast("long").alias("start"), (F.col("l_linenumber") + F.col("l_quantity")).cast("long").alias("end"))
    first = t(spark, sf, "lineitem").where("l_returnflag = 'R'").select(F.col("l_orderkey").alias("episode_id"))
    writers.append_ranges(rows.join(first, "episode_id", "left_semi"), path)
    writers.append_ranges(rows, path)
    return readers.stored_ranges(spark, path)


@query("SELECT c_custkey, c_acctbal FROM customer")
def resumed_rows(spark: SparkSession, sf: str) -> DataFrame:
    path = shared_folder(spark, "rows")
    rows = t(spark, sf, "customer").select("c_custkey", "c_acctbal")
    writers.append_new(rows.where("c_acctbal > 0"), path, "c_custkey")
    writers.append_new(rows, path, "c_custkey")
    return spark.read.parquet(path)


@query("""WITH l AS (SELECT vec_id, CAST(unnest(range(64)) AS INTEGER) AS dim, CAST(unnest(embedding) AS DOUBLE) AS x FROM embeddings)
SELECT 'x' AS key, dim, round(avg(x), 6) + 0.0 AS mean, round(stddev_pop(x), 6) + 0.0 AS std FROM l GROUP BY dim""")
def stored_statistics(spark: SparkSession, sf: str) -> DataFrame:
    folder = shared_folder(spark, "statistics")
    writers.write_statistics(stats.packed_statistics(stats.vector_statistics(vectors64(spark, sf), ["x"])), folder)
    both = readers.statistics(spark, folder).select("key", F.posexplode(F.arrays_zip("mean", "std")).alias("dim", "v"))
    return both.select("key", "dim", r6("v.mean").alias("mean"), r6("v.std").alias("std"))


@query("SELECT user_id, event_id, value FROM events")
def policy_records(spark: SparkSession, sf: str) -> DataFrame:
    path = shared_folder(spark, "records")
    rows = t(spark, sf, "events").select(F.col("event_id").alias("step"), F.struct(F.struct("user_id").alias("inputs"), F.struct("value").alias("outputs")).alias("record"))
    writers.append_records(projections.flatten(rows), path)
    out = readers.records(spark, path)
    return out.select(F.col("`record/inputs/user_id`").alias("user_id"), F.col("step").alias("event_id"), F.col("`record/outputs/value`").alias("value"))


@query("SELECT p_partkey, p_name, CAST(p_size AS BIGINT) AS p_size FROM part")
def replaced_folder(spark: SparkSession, sf: str) -> DataFrame:
    """A folder of other rows gives way to the table as a whole."""
    path = shared_folder(spark, "replaced")
    part = t(spark, sf, "part").select("p_partkey", "p_name", F.col("p_size").cast("long").alias("p_size"))
    writers.replace_folder(part.where("p_size > 25"), path)
    writers.replace_folder(part, path)
    return spark.read.parquet(path)


@query("SELECT user_id, value FROM events WHERE user_id = (SELECT min(user_id) FROM events)")
def replayed_episode(spark: SparkSession, sf: str) -> DataFrame:
    path = shared_folder(spark, "replayed")
    steps = user_steps(spark, sf).select(F.col("user_id").cast("long").alias("episode_id"), F.col("step").cast("long").alias("step"), "value")
    writers.write_episodes(steps, path, 10.0, per_chunk=100)
    first = t(spark, sf, "events").agg(F.min("user_id")).first()[0]
    return readers.replay(spark, path, first, "value", 100).select(F.lit(first).cast(steps.schema["episode_id"].dataType).alias("user_id"), "value")


@query("""SELECT c_custkey, CASE WHEN c_acctbal > 0 THEN '100' WHEN c_acctbal > -500 THEN 'n' ELSE '25' END AS answer, CASE WHEN c_acctbal > 0 THEN 1.0::DOUBLE WHEN c_acctbal > -500 THEN 0.0::DOUBLE ELSE 0.25::DOUBLE END AS success FROM customer""")
def stored_results(spark: SparkSession, sf: str) -> DataFrame:
    """Answers of a person, their values, and a CSV of results."""
    path = shared_folder(spark, "results")
    answer = F.when(F.col("c_acctbal") > 0, "100").when(F.col("c_acctbal") > -500, "n").otherwise("25")
    rows = t(spark, sf, "customer").select(X.success_value(answer).alias("success"), F.lit(1).alias("duration"), F.concat_ws(":", "c_custkey", answer).alias("video_filename"))
    writers.write_results(rows, path)
    back = spark.read.option("header", True).csv(path)
    name = F.split("video_filename", ":")
    return back.select(name[0].cast("long").alias("c_custkey"), name[1].alias("answer"), F.col("success").cast("double").alias("success"))
