"""More queries of the driver contract: robot adapters, token and name handling, cameras, and the machines over
tables, each with the DuckDB SQL that it equals. Imported by queries.py."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stridelake.functions import control as C
from stridelake.functions import robots as R
from stridelake.functions import text as X
from stridelake.functions import vectors as V
from stridelake.operators import filters, joins, projections, sampling, sets, windows
from stridelake.plans.presets import PRESETS
from stridelake.queries import E64, STEP_SQL, TIMES, query, r6, spread, t, user_steps, vectors64
from stridelake.sources import writers
from stridelake.streaming import machines, runner

SIGNS = str(list(R.FOURTEEN_SIGNS))
X64 = "SELECT vec_id, label, list_transform(embedding, lambda v: CAST(v AS DOUBLE)) AS x FROM embeddings"


def unrolled(list_sql: str, n: int, source: str = X64) -> str:
    """SQL for a row per element of a list, rounded as on the other side."""
    return f"WITH s AS ({source}), l AS (SELECT vec_id, {list_sql} AS y FROM s) SELECT vec_id, CAST(i AS INTEGER) AS dim, round(y[i + 1], 6) + 0.0 AS x FROM (SELECT vec_id, y, unnest(range({n})) AS i FROM l)"


def rows_of(df: DataFrame, rows: Column) -> DataFrame:
    """A row per element of all action rows, in order."""
    return spread(df.select("vec_id", F.flatten(rows).alias("y")), "vec_id", "y")


# --- vectors


@query(unrolled(f"list_transform(range(1, 15), lambda i: CASE WHEN i = 4 THEN 9.0 ELSE greatest(-0.1, least(0.1, x[i] * ({SIGNS})[i])) END)", 14))
def flip_clamp_put(spark: SparkSession, sf: str) -> DataFrame:
    low, high = V.vector([-0.1] * 14), V.vector([0.1] * 14)
    y = V.put_at(V.clamp(V.flip(F.slice("x", 1, 14), R.FOURTEEN_SIGNS), low, high), F.lit(3), F.lit(9.0))
    return spread(vectors64(spark, sf).select("vec_id", y.alias("y")), "vec_id", "y")


@query(unrolled("list_transform(range(1, 33), lambda i: greatest(-0.06, least(0.06, 0.7 * (x[i] - x[i + 32]))))", 32))
def proportional_control(spark: SparkSession, sf: str) -> DataFrame:
    y = V.proportional(F.slice("x", 1, 32), F.slice("x", 33, 32), 0.7, V.vector([0.2] * 32))
    return spread(vectors64(spark, sf).select("vec_id", y.alias("y")), "vec_id", "y")


@query("SELECT vec_id, round(max(abs(a - b)), 6) AS error FROM (SELECT vec_id, CAST(unnest(embedding[1:32]) AS DOUBLE) AS a, CAST(unnest(embedding[33:64]) AS DOUBLE) AS b FROM embeddings) GROUP BY vec_id")
def largest_errors(spark: SparkSession, sf: str) -> DataFrame:
    return vectors64(spark, sf).select("vec_id", F.round(V.largest_error(F.slice("x", 1, 32), F.slice("x", 33, 32)), 6).alias("error"))


@query(unrolled("list_transform(range(1, 49), lambda i: x[i] + CASE WHEN i <= 32 AND (i - 1) % 16 < 8 THEN x[49 + (i - 1) % 16] - x[57 + (i - 1) % 16] ELSE 0 END)", 48))
def reanchored_rows(spark: SparkSession, sf: str) -> DataFrame:
    rows = F.array(*[F.slice("x", a, 16) for a in (1, 17, 33)])
    return rows_of(vectors64(spark, sf), V.reanchor(rows, F.lit(2), F.slice("x", 49, 8), F.slice("x", 57, 8)))


@query(unrolled("list_transform(range(80), lambda i: CASE WHEN i % 20 < 16 THEN x[(i // 20) * 16 + i % 20 + 1] ELSE 0.0 END)", 80))
def padded_action_rows(spark: SparkSession, sf: str) -> DataFrame:
    return rows_of(vectors64(spark, sf), V.pad_rows(F.array(*[F.slice("x", a, 16) for a in (1, 17, 33, 49)]), 20))


@query(unrolled("list_concat(x[2:64], CASE WHEN list_contains(list_transform(x, lambda v: v > 0), true) THEN list_concat(x[65 - list_position(list_reverse(list_transform(x, lambda v: v > 0)), true) + 1:64], x[1:65 - list_position(list_reverse(list_transform(x, lambda v: v > 0)), true)]) ELSE x END)", 127))
def shifted_tokens(spark: SparkSession, sf: str) -> DataFrame:
    y = F.concat(X.next_tokens(F.col("x")), V.align_right(F.col("x"), F.transform("x", lambda v: v > 0)))
    return spread(vectors64(spark, sf).select("vec_id", y.alias("y")), "vec_id", "y")


# --- robots

ANGLE = "(asin(greatest(-1, least(1, (0.022 * 0.022 - 0.036 * 0.036 + ({p}) * ({p})) / (2 * 0.022 * ({p}))))) - 0.5476) / (1.6296 - 0.5476)"
DECODED = f"list_transform(range(1, 15), lambda i: CASE WHEN i IN (7, 14) THEN {ANGLE.format(p=f'x[i] * ({SIGNS})[i] * (0.058 - 0.01844) + 0.01844')} ELSE x[i] * ({SIGNS})[i] END)"


@query(unrolled(DECODED, 14))
def decoded_state_14(spark: SparkSession, sf: str) -> DataFrame:
    return spread(vectors64(spark, sf).select("vec_id", R.decode_state_14(F.slice("x", 1, 14)).alias("y")), "vec_id", "y")


@query(f"SELECT vec_id, round(sqrt(list_sum(list_transform({DECODED}, lambda v: v * v))), 6) + 0.0 AS state_norm, 32 AS width FROM ({X64})")
def model_input_rows(spark: SparkSession, sf: str) -> DataFrame:
    df = vectors64(spark, sf).select("vec_id", F.slice("x", 1, 14).alias("state"), F.array(F.slice("x", 15, 14), F.slice("x", 29, 14)).alias("actions"))
    out = PRESETS["dual_arm_14"]().training(df, skip_stats=True)
    return out.select("vec_id", r6(V.norm(F.col("state"))).alias("state_norm"), F.size(F.get("actions", F.lit(0))).alias("width"))


@query(unrolled(f"list_transform(range(28), lambda k: CASE WHEN k % 14 IN (6, 13) THEN (x[k // 14 * 16 + k % 14 + 1] * ({SIGNS})[k % 14 + 1] + 0.5476 + 0.6213) / (1.491 + 0.6213) ELSE x[k // 14 * 16 + k % 14 + 1] * ({SIGNS})[k % 14 + 1] END)", 28))
def encoded_actions_14(spark: SparkSession, sf: str) -> DataFrame:
    rows = F.array(F.slice("x", 1, 16), F.slice("x", 17, 16))
    return rows_of(vectors64(spark, sf), R.encode_actions_14(R.first_dims(rows, 14)))


@query("SELECT event_id, round((value / 100 - 0.01) / (0.05 - 0.01) * (1.5 + 0.6) - 0.6, 6) + 0.0 AS joint, round((value / 100 + 0.6) / (1.5 + 0.6) * (0.05 - 0.01) + 0.01, 6) + 0.0 AS position FROM events")
def gripper_ranges(spark: SparkSession, sf: str) -> DataFrame:
    v, a, b = F.col("value") / 100, (0.01, 0.05), (-0.6, 1.5)
    return t(spark, sf, "events").select("event_id", r6(R.convert_joint(v, a, b)).alias("joint"), r6(R.convert_joint(v, a, b, to_joint=False)).alias("position"))


@query(unrolled("list_transform(range(1, 8), lambda i: greatest(-1, least(1, CASE WHEN i = 7 THEN CASE WHEN x[i] * 8 > 0.5 THEN 1 ELSE 0 END ELSE x[i] * 8 END)))", 7))
def binary_gripper(spark: SparkSession, sf: str) -> DataFrame:
    y = R.binarise_gripper(F.transform(F.slice("x", 1, 7), lambda v: v * 8), F.lit(6))
    return spread(vectors64(spark, sf).select("vec_id", y.alias("y")), "vec_id", "y")


@query(unrolled("list_concat(list_concat(x[1:7], x[9:15]), list_concat(x[1:7], list_concat([0.0], list_concat(x[9:15], [0.0]))))", 30))
def two_hand_states(spark: SparkSession, sf: str) -> DataFrame:
    state = R.state_from_raw(F.col("x"))
    return spread(vectors64(spark, sf).select("vec_id", F.concat(state, R.hand_anchor(state)).alias("y")), "vec_id", "y")


FIRST = "list_concat(list_concat(x[1:7], [CASE WHEN x[40] > 0 THEN 0.5 - x[40] / 7 ELSE 0.5 - x[40] END]), list_concat(x[9:15], [CASE WHEN x[48] < 0 THEN x[48] / 7 + 0.5 ELSE x[48] + 0.5 END]))"
SECOND = "list_concat(list_concat(x[1:7], [CASE WHEN x[40] > 0 THEN (1 - x[40] / 2) * 0.1 ELSE 0.1 - x[40] * 0.9 / 1.6 END]), list_concat(x[9:15], [CASE WHEN x[48] > 0 THEN (1 - x[48] / 2) * 0.1 ELSE 0.1 - x[48] * 0.9 / 1.6 END]))"


@query(unrolled(FIRST, 16))
def first_hands_actions(spark: SparkSession, sf: str) -> DataFrame:
    return rows_of(vectors64(spark, sf), R.first_generation_actions(F.array("x")))


@query(unrolled("list_concat(list_concat(x[1:7], [x[40]]), list_concat(x[9:15], [x[48]]))", 16))
def first_hands_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    return rows_of(vectors64(spark, sf), R.first_generation_outputs(R.first_generation_actions(F.array("x"))))


@query(unrolled(f"list_concat({SECOND}, [x[10], x[11], x[12]])", 19))
def second_hands_with_chassis(spark: SparkSession, sf: str) -> DataFrame:
    raw = F.concat("x", F.slice("x", 1, 12))
    return rows_of(vectors64(spark, sf).withColumn("raw", raw), R.second_generation_actions(F.array("raw"), chassis=True))


BLOCK = "list_concat(list_concat(x[{a}:{b}], [0.0]), list_concat(x[{c}:{d}], [0.0]))"


@query(unrolled(f"list_concat(list_concat({BLOCK.format(a=1, b=7, c=8, d=14)}, {BLOCK.format(a=15, b=21, c=22, d=28)}), list_concat(list_concat(x[29:35], [0.0]), list_concat(x[36:40], [0.0, 0.0, 0.0])))", 48))
def assembled_raw_48(spark: SparkSession, sf: str) -> DataFrame:
    y = R.assemble_48(F.slice("x", 1, 14), F.slice("x", 15, 14), F.slice("x", 29, 12))
    return spread(vectors64(spark, sf).select("vec_id", y.alias("y")), "vec_id", "y")


@query(unrolled("list_concat(list_concat(x[1:6], [CASE WHEN x[8] > 0 THEN 0.5 - x[8] / 7 ELSE 0.5 - x[8] END]), list_concat(x[10:15], [CASE WHEN x[17] > 0 THEN 0.5 - x[17] / 7 ELSE 0.5 - x[17] END]))", 14))
def assembled_arms(spark: SparkSession, sf: str) -> DataFrame:
    return spread(vectors64(spark, sf).select("vec_id", R.assemble_arms(F.slice("x", 1, 18), R.left_effort_to_unit).alias("y")), "vec_id", "y")


@query(unrolled("x[1:8]", 8))
def single_arm_state(spark: SparkSession, sf: str) -> DataFrame:
    from stridelake.plans.presets import single_arm

    df = vectors64(spark, sf).select("vec_id", F.slice("x", 1, 7).alias("joints"), F.slice("x", 8, 1).alias("gripper"))
    for step in single_arm(7, 8).inputs:
        df = step(df)
    return spread(df.select("vec_id", F.col("state").alias("y")), "vec_id", "y")


# --- tokens, names, answers


@query("""WITH d AS (SELECT doc_id, 'Task: a, Action: ' || text AS s FROM documents WHERE text IS NOT NULL)
SELECT doc_id, sha256(regexp_replace(split_part(substr(s, position('Action: ' IN s) + 8), '|', 1), '^\\s+|\\s+$', '', 'g')) AS digest FROM d""".replace("\\\\", "\\"))
def action_texts(spark: SparkSession, sf: str) -> DataFrame:
    docs = t(spark, sf, "documents").where("text IS NOT NULL")
    return docs.select("doc_id", F.sha2(X.action_text(F.concat(F.lit("Task: a, Action: "), "text")).cast("binary"), 256).alias("digest"))


@query("""WITH k AS (SELECT event_id, CAST(unnest(range(6)) AS INTEGER) AS k FROM events)
SELECT event_id, k, CASE WHEN event_id % 10 >= 6 THEN round((event_id * (k + 1)) % 256 / 256.0 * 2 - 1, 6) + 0.0 ELSE 0.0 END AS x FROM k""")
def decoded_bins(spark: SparkSession, sf: str) -> DataFrame:
    e = F.col("event_id")
    tokens = F.slice(F.transform(F.sequence(F.lit(1), F.lit(9)), lambda k: e * k % 256), 1, (e % 10).cast("int"))
    out = t(spark, sf, "events").select("event_id", F.flatten(X.decode_bins(tokens, 256, 3, 2)).alias("y"))
    return out.select("event_id", F.posexplode("y").alias("k", "x")).select("event_id", "k", r6("x").alias("x"))


@query("""SELECT event_id, CAST(event_id AS VARCHAR) AS episode, CAST(event_id AS INTEGER) AS number, replace(event_type, ' ', '_') || '_' || CASE WHEN value > 50 THEN 'success' ELSE 'failure' END AS outcome,
CASE event_id % 4 WHEN 0 THEN 1.0 WHEN 1 THEN 0.0 WHEN 2 THEN CASE WHEN event_id % 200 <= 100 THEN (event_id % 200) / 100.0 END END AS success, event_type AS decoded, round(event_id * 1000.0 + value, 3) AS ms FROM events""")
def names_and_answers(spark: SparkSession, sf: str) -> DataFrame:
    e, s = F.col("event_id"), F.col("event_id").cast("string")
    answer = F.when(e % 4 == 0, " Y ").when(e % 4 == 1, "n").when(e % 4 == 2, (e % 200).cast("string")).otherwise("maybe")
    names = [X.episode_id(F.concat(F.lit("run_b_"), s, F.lit(".tar.gz"))).alias("episode"), X.numbered(F.concat(F.lit("out_"), s, F.lit(".mp4"))).alias("number")]
    rest = [X.outcome_name(F.col("event_type"), F.col("value") > 50).alias("outcome"), X.success_value(answer).alias("success"), X.from_bytes(F.col("event_type").cast("binary")).alias("decoded")]
    return t(spark, sf, "events").select("event_id", *names, *rest, F.round(C.milliseconds(e, F.col("value") * 1e6), 3).alias("ms"))


@query("SELECT CAST(max(event_id) + 1 AS INTEGER) AS index FROM events")
def next_file_index(spark: SparkSession, sf: str) -> DataFrame:
    return writers.next_index(t(spark, sf, "events").select(F.concat(F.lit("out_"), F.col("event_id").cast("string"), F.lit(".mp4")).alias("name")))


# --- leaves, cameras, filters


@query("SELECT event_id, value * 2 AS value, 'none' AS prompt FROM events")
def leaves_and_defaults(spark: SparkSession, sf: str) -> DataFrame:
    e = t(spark, sf, "events").select("event_id", F.struct("value", F.struct("event_type").alias("tag")).alias("obs"), F.lit(1).alias("debug_a"), F.lit(2).alias("debug_b"))
    doubled = projections.apply_to_leaves(projections.without_prefix(e, "debug_"), ["obs/value"], lambda c: c * 2, strict=True)
    flat = projections.without_strings(projections.flatten(doubled).withColumnRenamed("obs/value", "value"))
    return projections.with_default(flat, "prompt", "none")


@query("""SELECT l_orderkey, l_linenumber, round(CAST(l_quantity AS DOUBLE), 6) AS a, round(CAST(l_discount AS DOUBLE), 6) AS g, CAST(l_partkey AS BIGINT) AS part, 'pick ' || l_returnflag AS prompt,
'f--' || CAST(l_orderkey AS VARCHAR) || '--' || CAST(l_linenumber AS VARCHAR) AS step_id FROM lineitem""")
def restructured_steps(spark: SparkSession, sf: str) -> DataFrame:
    src = t(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", F.col("l_linenumber").alias("step"), F.lit("f").alias("folder"), F.col("l_orderkey").cast("string").alias("file"), F.col("l_partkey").cast("long").alias("part"), F.array(F.col("l_quantity").cast("double")).alias("arm"), F.array(F.col("l_discount").cast("double")).alias("grip"), "l_returnflag")
    out = projections.restructure_steps(src, "arm", "grip", {"part": "part", "order": "l_orderkey", "line": "l_linenumber"}, F.concat(F.lit("pick "), "l_returnflag"), ("folder", "file"))
    return out.select(F.col("observation.order").alias("l_orderkey"), F.col("observation.line").alias("l_linenumber"), r6(F.get("actions", F.lit(0))).alias("a"), r6(F.get("actions", F.lit(1))).alias("g"), F.col("observation.part").alias("part"), "prompt", "step_id")


@query("SELECT event_id, CASE WHEN event_id % 3 = 0 THEN 'cam_b,cam_d' ELSE 'cam_b' END AS wrist, CASE WHEN event_id % 3 = 0 THEN 'cam_a' ELSE 'cam_a,cam_d' END AS others, 'cam_a_left,cam_b_left,cam_b_right' AS shown, CAST(event_id + 2 AS BIGINT) AS chosen FROM events")
def camera_choices(spark: SparkSession, sf: str) -> DataFrame:
    e = F.col("event_id")
    kinds = F.create_map(F.lit("cam_d"), F.when(e % 3 == 0, 0).otherwise(1), F.lit("cam_a"), F.lit(1), F.lit("cam_b"), F.lit(0))
    images = F.create_map(F.lit("cam_a_left"), e, F.lit("cam_a_depth"), e + 1, F.lit("cam_b_left"), e + 2, F.lit("cam_b_right"), e + 3, F.lit("cam_b_left_depth"), e + 4)
    seen = filters.without_depth(images)
    joined = lambda c: F.array_join(F.array_sort(c), ",")
    return t(spark, sf, "events").select("event_id", joined(filters.cameras_by_kind(kinds, True, 4)).alias("wrist"), joined(filters.cameras_by_kind(kinds, False, 4)).alias("others"), joined(F.map_keys(seen)).alias("shown"), filters.camera_of(seen, "cam_b").alias("chosen"))


@query("SELECT event_id FROM events WHERE event_type = 'purchase' AND (event_id % 3 = 0 OR event_id % 3 = 1)")
def usable_steps(spark: SparkSession, sf: str) -> DataFrame:
    kind = F.when(F.col("event_type") == "purchase", "success").otherwise("failure")
    e = t(spark, sf, "events").select("event_id", F.concat(F.lit("/data/"), kind, F.lit("/x.h5")).alias("file_path"), F.when(F.col("event_id") % 3 == 0, True).when(F.col("event_id") % 3 == 2, False).alias("movement_enabled"))
    return filters.required(filters.moving(filters.successful(e)), F.col("event_id").isNotNull(), "a step without its id").select("event_id")


@query("SELECT event_id, c_name, c_mktsegment FROM events JOIN customer ON c_custkey = user_id")
def episode_columns(spark: SparkSession, sf: str) -> DataFrame:
    episodes = t(spark, sf, "customer").select(F.col("c_custkey").alias("user_id"), "c_name", "c_mktsegment")
    return joins.with_episode_columns(t(spark, sf, "events").select("event_id", "user_id"), episodes, "user_id").select("event_id", "c_name", "c_mktsegment")


@query("SELECT e.event_id FROM events e WHERE EXISTS (SELECT 1 FROM customer c WHERE c.c_custkey = e.user_id AND c.c_acctbal > 0)")
def shared_keys(spark: SparkSession, sf: str) -> DataFrame:
    good = t(spark, sf, "customer").where("c_acctbal > 0").select(F.col("c_custkey").alias("user_id"))
    return joins.shared_rows(t(spark, sf, "events"), good, "user_id").select("event_id")


@query("SELECT user_id, list_contains(list(event_type), 'click') AND list_contains(list(event_type), 'purchase') AS complete FROM events GROUP BY user_id")
def complete_users(spark: SparkSession, sf: str) -> DataFrame:
    names = t(spark, sf, "events").groupBy("user_id").agg(F.collect_set("event_type").alias("names"))
    return names.select("user_id", sets.has_all(F.col("names"), ["click", "purchase"]).alias("complete"))


@query("SELECT l_orderkey, count(*) AS n, string_agg(CAST(l_partkey AS VARCHAR), ',' ORDER BY l_linenumber, l_partkey) AS parts FROM lineitem GROUP BY l_orderkey")
def stacked_batches(spark: SparkSession, sf: str) -> DataFrame:
    out = sampling.stacked(t(spark, sf, "lineitem"), ["l_orderkey"], "l_linenumber", ["l_partkey"])
    return out.select("l_orderkey", F.size("l_partkey").cast("long").alias("n"), F.array_join(F.transform("l_partkey", lambda v: v.cast("string")), ",").alias("parts"))


@query("SELECT event_id, row_number() OVER (ORDER BY md5('7:2:' || CAST(event_id AS VARCHAR)), event_id) - 1 AS place FROM events")
def shuffled_places(spark: SparkSession, sf: str) -> DataFrame:
    marked = t(spark, sf, "events").select("event_id", sampling.draw("7:2", "event_id").alias("drawn"))
    return windows.global_positions(marked, ["drawn", "event_id"], 8).select("event_id", F.col("position").alias("place"))


# --- machines over tables


def _timed(spark: SparkSession, sf: str, *more: Column) -> DataFrame:
    return t(spark, sf, "events").select("user_id", F.col("event_id").cast("double").alias("t"), *more)


ORDERED = "SELECT user_id, CAST(event_id AS DOUBLE) AS t, event_type, value, row_number() OVER (PARTITION BY user_id ORDER BY event_id) AS n FROM events"


@query(f"""WITH RECURSIVE o AS ({ORDERED}), r AS (SELECT user_id, t, n, t AS last, true AS passed FROM o WHERE n = 1
UNION ALL SELECT o.user_id, o.t, o.n, CASE WHEN o.t - r.last >= 500 THEN o.t ELSE r.last END, o.t - r.last >= 500 FROM r JOIN o ON o.user_id = r.user_id AND o.n = r.n + 1) SELECT user_id, t FROM r WHERE passed""")
def throttled_events(spark: SparkSession, sf: str) -> DataFrame:
    return runner.over_table(_timed(spark, sf), machines.Throttle(500.0), "user_id", ["t"])


@query(f"""WITH o AS ({ORDERED}), g AS (SELECT *, sum(CAST(value >= 60 AS INTEGER)) OVER (PARTITION BY user_id ORDER BY n) AS g FROM o)
SELECT user_id, t, value < 60 AND t - min(CASE WHEN value < 60 THEN t END) OVER (PARTITION BY user_id, g) >= 300 AS converged FROM g""")
def converged_machine(spark: SparkSession, sf: str) -> DataFrame:
    return runner.over_table(_timed(spark, sf, F.col("value")), machines.Converged(60.0, 300.0), "user_id", ["t"])


LATEST = f"""WITH o AS ({ORDERED}), l AS (SELECT user_id, t, n, max(CASE WHEN event_type = 'click' THEN t END) OVER w AS a_at, arg_max(value, n) FILTER (event_type = 'click') OVER w AS a,
max(CASE WHEN event_type = 'view' THEN t END) OVER w AS b_at, arg_max(value, n) FILTER (event_type = 'view') OVER w AS b FROM o WINDOW w AS (PARTITION BY user_id ORDER BY n)) SELECT user_id, t, a AS click, b AS "view" FROM l WHERE """


def _latest(spark: SparkSession, sf: str, barrier: bool) -> DataFrame:
    events = _timed(spark, sf, F.col("event_type").alias("channel"), F.col("value"))
    out = runner.over_table(events, machines.Latest(("click", "view"), 400.0, barrier), "user_id", ["t"])
    return out.select("user_id", "t", F.col("values")["click"].alias("click"), F.col("values")["view"].alias("view"))


@query(LATEST + "t - a_at <= 400 AND t - b_at <= 400")
def latest_machine(spark: SparkSession, sf: str) -> DataFrame:
    return _latest(spark, sf, barrier=False)


@query(LATEST + "a_at IS NOT NULL AND b_at IS NOT NULL")
def barrier_machine(spark: SparkSession, sf: str) -> DataFrame:
    return _latest(spark, sf, barrier=True)


@query(f"""WITH o AS ({ORDERED}) SELECT user_id, t, CAST(CASE WHEN n % 5 <> 0 THEN n - n // 5 ELSE -1 END AS BIGINT) AS chunk, CAST(CASE WHEN n % 5 <> 0 AND n > 1 THEN n - n // 5 - 1 ELSE -1 END AS BIGINT) AS continues,
CAST(CASE WHEN n % 5 <> 0 AND n > 1 THEN n % 7 ELSE -1 END AS INTEGER) AS from_step, CASE WHEN n % 5 = 0 THEN 'chunk 999999 is stale; ' || CAST(n - n // 5 AS VARCHAR) || ' is held' ELSE '' END AS error FROM o""")
def history_machine(spark: SparkSession, sf: str) -> DataFrame:
    n = F.col("step") + 1
    steps = windows.with_steps(t(spark, sf, "events"), "user_id", ["event_id"])
    held = n - 1 - F.floor((n - 1) / 5)
    requests = steps.select("user_id", F.col("event_id").cast("double").alias("t"), F.when(n % 5 == 0, 999999).otherwise(held).cast("long").alias("previous"), (n % 7).cast("int").alias("prefix_start"), F.lit(False).alias("reset"))
    out = runner.over_table(requests, machines.History(), "user_id", ["t"])
    known = [F.coalesce(c, F.lit(-1)).cast(k).alias(c) for c, k in (("chunk", "long"), ("continues", "long"), ("from_step", "int"))]
    return out.select("user_id", "t", *known, F.coalesce("error", F.lit("")).alias("error"))
