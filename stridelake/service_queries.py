"""Queries of the driver contract on recorders, sessions of a server and environments, each with the DuckDB SQL that it
equals. Imported by queries.py."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stridelake.operators import windows
from stridelake.plans.environments import Environment, two_hands
from stridelake.queries import event_stream, query, r6, t
from stridelake.source_queries import FRAME_SQL, frames
from stridelake.sources import readers
from stridelake.streaming import machines, playback, runner

# --- recorders


@query("""WITH e AS (SELECT user_id, event_id, CAST(floor(value * 10) AS BIGINT) AS stamp FROM events)
SELECT event_id, stamp FROM (SELECT *, max(stamp) OVER (PARTITION BY user_id ORDER BY event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS before FROM e) WHERE before IS NULL OR stamp > before""")
def newer_frames(spark: SparkSession, sf: str) -> DataFrame:
    e = t(spark, sf, "events").select("user_id", "event_id", F.floor(F.col("value") * 10).alias("stamp"))
    return playback.newer(e, "user_id", "event_id", "stamp").select("event_id", "stamp")


@query("""SELECT user_id, CAST(stamp AS DOUBLE) AS t FROM (SELECT *, max(stamp) OVER (PARTITION BY user_id ORDER BY event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS before
FROM (SELECT user_id, event_id, floor(value * 10) AS stamp FROM events)) WHERE before IS NULL OR stamp > before""")
def stream_newer_frames(spark: SparkSession, sf: str) -> DataFrame:
    stamped = event_stream(spark, sf).select("user_id", "event_id", F.floor(F.col("value") * 10).cast("double").alias("t"))
    return runner.drained(runner.over_stream(stamped, machines.Newer(), "user_id", ["event_id"]), "newer")


@query("""SELECT event_id, coalesce(round(last_value(CASE WHEN event_type = 'click' THEN value END IGNORE NULLS) OVER w, 6), -1.0) AS position,
coalesce(round(last_value(CASE WHEN event_type = 'view' THEN value END IGNORE NULLS) OVER w, 6), -1.0) AS command FROM events WINDOW w AS (PARTITION BY user_id ORDER BY event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)""")
def recorded_states(spark: SparkSession, sf: str) -> DataFrame:
    of = lambda kind, name: F.when(F.col("event_type") == kind, F.col("value")).alias(name)
    e = t(spark, sf, "events").select("user_id", "event_id", of("click", "position"), of("view", "command"))
    out = playback.recorded(e, "user_id", "event_id", ["position", "command"])
    return out.select("event_id", *[F.coalesce(F.round(c, 6), F.lit(-1.0)).alias(c) for c in ("position", "command")])


# --- sessions of a server: each 20th message of a user connects, each 11th event can't be read, each 13th asks for health

SESSIONS = """WITH o AS (SELECT user_id, event_id, value, event_id % 13 = 0 AS health, event_id % 11 = 0 AS bad, row_number() OVER (PARTITION BY user_id ORDER BY event_id) % 20 = 1 AS connects FROM events),
g AS (SELECT *, sum(CAST(connects AND NOT health AS INTEGER)) OVER (PARTITION BY user_id ORDER BY event_id) AS g FROM o),
f AS (SELECT *, min(CASE WHEN bad AND NOT health THEN event_id END) OVER (PARTITION BY user_id, g) AS failed FROM g),
a AS (SELECT *, lag(value + 1) OVER (PARTITION BY user_id, g ORDER BY event_id) AS total FROM f WHERE NOT health AND g > 0 AND (failed IS NULL OR event_id < failed)),
m AS (SELECT user_id, event_id, 'health' AS kind, 'OK' AS body, -1.0 AS infer_ms, -1.0 AS prev_total_ms FROM o WHERE health
UNION ALL SELECT user_id, event_id, 'metadata', '{"v":1}', -1.0, -1.0 FROM o WHERE connects AND NOT health
UNION ALL SELECT user_id, event_id, 'error', 'the request can''t be read', -1.0, -1.0 FROM f WHERE g > 0 AND event_id = failed
UNION ALL SELECT user_id, event_id, 'answer', 'a' || CAST(event_id AS VARCHAR), round(value, 6), coalesce(round(total, 6), -1.0) FROM a)
SELECT user_id, CAST(event_id AS DOUBLE) AS t, kind, body, CAST(infer_ms AS DOUBLE) AS infer_ms, CAST(prev_total_ms AS DOUBLE) AS prev_total_ms FROM m"""

MESSAGE = "user_id long, t double, path string, connect boolean, value double"


def _messages(spark: SparkSession, sf: str) -> DataFrame:
    """A message per event; those that can't be read have no value."""
    e = windows.with_steps(t(spark, sf, "events"), "user_id", ["event_id"])
    n = F.col("event_id")
    path = F.when(n % 13 == 0, "/healthz").otherwise("/").alias("path")
    return e.select(F.col("user_id").cast("long").alias("user_id"), n.cast("double").alias("t"), path, (F.col("step") % 20 == 0).alias("connect"), F.when(n % 11 != 0, F.col("value")).alias("value"))


def _policy(messages: DataFrame) -> DataFrame:
    """The policy is a projection: the answer of a message, and the times that it took."""
    answer = F.when(F.col("value").isNotNull(), F.concat(F.lit("a"), F.col("t").cast("long").cast("string")))
    return messages.withColumns({"answer": answer, "infer_ms": F.col("value"), "total_ms": F.col("value") + 1}).drop("value")


def _shown(out: DataFrame) -> DataFrame:
    times = [F.coalesce(F.round(c, 6), F.lit(-1.0)).alias(c) for c in ("infer_ms", "prev_total_ms")]
    return out.select("user_id", "t", "kind", F.regexp_replace("body", r"\n$", "").alias("body"), *times)


@query(SESSIONS)
def request_sessions(spark: SparkSession, sf: str) -> DataFrame:
    return _shown(runner.over_table(_policy(_messages(spark, sf)), machines.Session('{"v":1}'), "user_id", ["t"]))


@query(SESSIONS)
def stream_request_sessions(spark: SparkSession, sf: str) -> DataFrame:
    """The same messages as lines of JSON that a stream reads as they come."""
    folder = runner.shared_folder(spark, "requests")
    _messages(spark, sf).write.json(folder)
    got = readers.request_stream(spark, folder, MESSAGE).drop("line")
    return _shown(runner.drained(runner.over_stream(_policy(got), machines.Session('{"v":1}'), "user_id", ["t"]), "sessions"))


# --- environments


@query("""WITH o AS (SELECT user_id, event_id, value - 50 AS reward, event_type = 'purchase' AS done FROM events),
g AS (SELECT *, coalesce(sum(CAST(done AS INTEGER)) OVER (PARTITION BY user_id ORDER BY event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS episode FROM o)
SELECT event_id, CAST(episode AS BIGINT) AS episode, done, round(greatest(0.0::DOUBLE, max(reward) OVER (PARTITION BY user_id, episode ORDER BY event_id)), 6) + 0.0 AS episode_reward FROM g""")
def environment_progress(spark: SparkSession, sf: str) -> DataFrame:
    steps = t(spark, sf, "events").select("user_id", "event_id", (F.col("value") - 50).alias("reward"), (F.col("event_type") == "purchase").alias("terminated"), F.lit(False).alias("truncated"))
    out = Environment({}, completes=True).progress(steps, "user_id", "event_id")
    return out.select("event_id", "episode", "done", r6("episode_reward").alias("episode_reward"))


@query(f"""SELECT vec_id, array_to_string(list_transform(range(32), lambda i: substr(hx, CAST(2 * ((i % 8) * 4 + i // 8) + 1 AS BIGINT), 2)), '') AS cam_high, hx AS head_camera, 'go' AS prompt, CAST(64 AS INTEGER) AS dims FROM ({FRAME_SQL})""")
def environment_observations(spark: SparkSession, sf: str) -> DataFrame:
    """One frame as two environments show it: channels first, and as it comes."""
    state = t(spark, sf, "embeddings").select("vec_id", F.col("embedding").alias("state"))
    views = ("top", "top_depth", "left_color", "right_color", "head_camera")
    images = F.create_map(*[c for v in views for c in (F.lit(v), F.col("frame"))])
    steps = frames(spark, sf).join(state, "vec_id").withColumn("images", images)
    first = Environment({"top": "cam_high"}, (2, 4)).observations(steps, "vec_id", "images")
    second = two_hands("go").observations(first, "vec_id", "cam_high")
    return second.select("vec_id", F.hex("cam_high").alias("cam_high"), F.hex(F.col("`observation/images/head_camera`")["data"]).alias("head_camera"), "prompt", F.size(F.col("`observation/state`")).alias("dims"))
