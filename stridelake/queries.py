"""Queries of the driver contract on its tables, and the DuckDB SQL that they equal.

Episodes are orders (steps by line number, part, supplier) or users' events (steps by time and id). Floats
are rounded on both sides to 6 digits."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from stridelake.functions import control as C
from stridelake.functions import robots as R
from stridelake.functions import text as X
from stridelake.functions import vectors as V
from stridelake.operators import filters, joins, projections, sampling, sets, stats, windows
from stridelake.plans import pipeline
from stridelake.streaming import machines, playback, runner

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None) -> Callable[[Query], Query]:
    def register(f: Query) -> Query:
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return register


def t(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def r6(c: Column | str) -> Column:
    """Rounded to 6 digits, without negative zero."""
    return F.round(F.col(c) if isinstance(c, str) else c, 6) + F.lit(0.0)


def seconds(c: str) -> Column:
    return F.unix_micros(F.col(c).cast("timestamp")) / 1e6


LINES = ["l_linenumber", "l_partkey", "l_suppkey"]
TIMES = ["ts", "event_id"]
STEP_SQL = "row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) - 1"


def user_steps(spark: SparkSession, sf: str) -> DataFrame:
    return windows.with_steps(t(spark, sf, "events"), "user_id", TIMES)


def vectors64(spark: SparkSession, sf: str) -> DataFrame:
    return t(spark, sf, "embeddings").select("vec_id", "label", V.to_double(F.col("embedding")).alias("x"))


def spread(df: DataFrame, key: str, vector: str) -> DataFrame:
    return df.select(key, F.posexplode(vector).alias("dim", "x")).select(key, "dim", r6("x").alias("x"))


E64 = "SELECT vec_id, CAST(unnest(range(64)) AS INTEGER) AS dim, CAST(unnest(embedding) AS DOUBLE) AS x FROM embeddings"


# --- statistics


@query("""SELECT 'embedding' AS key, dim, count(x) AS count, round(avg(x), 6) + 0.0 AS mean, round(stddev_pop(x), 6) + 0.0 AS std, round(min(x), 6) + 0.0 AS min,
round(max(x), 6) + 0.0 AS max, round(quantile_cont(x, 0.01), 6) + 0.0 AS q01, round(quantile_cont(x, 0.99), 6) + 0.0 AS q99 FROM (""" + E64 + ") GROUP BY dim")
def vector_norm_stats(spark: SparkSession, sf: str) -> DataFrame:
    s = stats.vector_statistics(t(spark, sf, "embeddings"), ["embedding"])
    return s.select("key", "dim", "count", *[r6(c).alias(c) for c in ("mean", "std", "min", "max", "q01", "q99")])


@query("""SELECT 'x' AS key, dim, round(quantile_cont(x, 0.01), 6) + 0.0 AS q01, round(quantile_cont(x, 0.99), 6) + 0.0 AS q99 FROM (""" + E64 + ") GROUP BY dim")
def refined_norm_quantiles(spark: SparkSession, sf: str) -> DataFrame:
    s = stats.vector_statistics(vectors64(spark, sf), ["x"], "refined")
    return s.select("key", "dim", r6("q01").alias("q01"), r6("q99").alias("q99"))


@query("""WITH e AS (""" + E64 + """), s AS (SELECT dim, avg(x) AS mean, stddev_pop(x) AS std FROM e GROUP BY dim)
SELECT vec_id, e.dim, round((x - mean) / (std + 1e-6), 6) + 0.0 AS x FROM e JOIN s ON e.dim = s.dim""")
def zscore_vectors(spark: SparkSession, sf: str) -> DataFrame:
    df = vectors64(spark, sf)
    s = stats.moments(df, "x", 64)
    return spread(df.crossJoin(F.broadcast(s)).select("vec_id", V.zscore(F.col("x"), F.col("mean"), F.col("std")).alias("z")), "vec_id", "z")


@query("""WITH e AS (""" + E64 + """), s AS (SELECT dim, quantile_cont(x, 0.01) AS a, quantile_cont(x, 0.99) AS b FROM e GROUP BY dim)
SELECT vec_id, e.dim, round((x - a) / (b - a + 1e-6) * 2 - 1, 6) + 0.0 AS x FROM e JOIN s ON e.dim = s.dim""")
def quantile_scale_vectors(spark: SparkSession, sf: str) -> DataFrame:
    df = vectors64(spark, sf)
    s = pipeline.literal_statistics(stats.packed_statistics(stats.vector_statistics(df, ["x"])))["x"]
    return spread(df.select("vec_id", V.quantile_scale(F.col("x"), V.vector(s["q01"]), V.vector(s["q99"])).alias("z")), "vec_id", "z")


@query("SELECT vec_id, dim, round(x, 6) + 0.0 AS x, round(x, 6) + 0.0 AS y FROM (" + E64 + ")")
def unnormalize_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    df = vectors64(spark, sf)
    s = pipeline.literal_statistics(stats.packed_statistics(stats.vector_statistics(df, ["x"])))["x"]
    mean, std, low, high = (V.vector(s[c]) for c in ("mean", "std", "q01", "q99"))
    both = df.select("vec_id", V.inverse_zscore(V.zscore(F.col("x"), mean, std), mean, std).alias("a"), V.inverse_quantile_scale(V.quantile_scale(F.col("x"), low, high), low, high).alias("b"))
    return both.select("vec_id", F.posexplode(F.arrays_zip("a", "b")).alias("dim", "z")).select("vec_id", "dim", r6(F.col("z.a")).alias("x"), r6(F.col("z.b")).alias("y"))


@query("""SELECT label, count(*) AS n, round(sum(CASE WHEN dim % 4 = 0 THEN x ELSE 0 END), 6) + 0.0 AS every_fourth, round(sum(CASE WHEN dim < 8 OR (dim >= 12 AND dim < 16) THEN x ELSE 0 END), 6) + 0.0 AS masked,
70 AS padded FROM (SELECT vec_id, label, CAST(unnest(range(64)) AS INTEGER) AS dim, CAST(unnest(embedding) AS DOUBLE) AS x FROM embeddings) GROUP BY label""".replace("count(*)", "count(DISTINCT vec_id)"))
def pad_slice_mask(spark: SparkSession, sf: str) -> DataFrame:
    total = lambda c: F.aggregate(c, F.lit(0.0), lambda a, v: a + v)
    df = vectors64(spark, sf).select("label", V.pad_to(F.col("x"), 70).alias("p"), V.every_nth(F.col("x"), 4).alias("e"), V.delta_anchor(F.col("x"), V.bool_mask(8, -4, 4)).alias("m"))
    return df.groupBy("label").agg(F.count("*").alias("n"), r6(F.sum(total(F.col("e")))).alias("every_fourth"), r6(F.sum(total(F.col("m")))).alias("masked"), F.max(F.size("p")).alias("padded"))


@query("""WITH e AS (""" + E64 + """), r AS (SELECT dim, min(x) AS low, max(x) AS high, count(*) AS n FROM e GROUP BY dim),
b AS (SELECT e.dim, least(floor((x - low) / ((high - low) / 5000)), 4999) AS bin, low, high, n, count(*) AS c FROM e JOIN r ON e.dim = r.dim GROUP BY ALL),
u AS (SELECT *, sum(c) OVER (PARTITION BY dim ORDER BY bin) AS s FROM b)
SELECT dim, round(min(CASE WHEN s >= 0.01 * n THEN low + (high - low) / 5000 * bin END), 6) + 0.0 AS q01, round(min(CASE WHEN s >= 0.99 * n THEN low + (high - low) / 5000 * bin END), 6) + 0.0 AS q99 FROM u GROUP BY dim""")
def histogram_quantiles(spark: SparkSession, sf: str) -> DataFrame:
    q = stats.histogram_quantiles(t(spark, sf, "embeddings"), "embedding")
    return q.select("dim", r6("q01").alias("q01"), r6("q99").alias("q99"))


@query("""SELECT event_type, round(avg(value), 6) AS mean, round(stddev_pop(value), 6) AS std, round(quantile_cont(value, 0.25), 6) AS p25, round(quantile_cont(value, 0.5), 6) AS p50, round(quantile_cont(value, 0.75), 6) AS p75,
round(quantile_cont(value, 0.9), 6) AS p90, round(quantile_cont(value, 0.95), 6) AS p95, round(quantile_cont(value, 0.99), 6) AS p99 FROM events GROUP BY event_type""")
def latency_quantiles(spark: SparkSession, sf: str) -> DataFrame:
    s = stats.timing_statistics(t(spark, sf, "events"), "event_type", "value")
    return s.select("event_type", *[F.round(c, 6).alias(c) for c in s.columns if c != "event_type"])


@query("""SELECT source AS task, count(*) AS trials, CAST(sum(quality) AS BIGINT) AS successes, round(avg(CAST(quality AS DOUBLE)), 6) AS rate FROM documents JOIN labels USING (doc_id) GROUP BY ROLLUP (source)""")
def success_rate_rollup(spark: SparkSession, sf: str) -> DataFrame:
    trials = t(spark, sf, "documents").select("doc_id", F.col("source").alias("task")).join(t(spark, sf, "labels"), "doc_id")
    return stats.success_rates(trials, "task", "quality").withColumn("rate", F.round("rate", 6))


@query("""WITH w AS (SELECT event_id, count(*) OVER k AS n, epoch_us(max(ts) OVER k) / 1e6 - epoch_us(min(ts) OVER k) / 1e6 AS span, avg(value) OVER k AS m FROM events
WINDOW k AS (PARTITION BY event_type ORDER BY ts, event_id ROWS BETWEEN 19 PRECEDING AND CURRENT ROW)) SELECT event_id, round(CASE WHEN n >= 2 AND span > 0 THEN (n - 1) / span ELSE 0 END, 6) AS rate, round(m, 6) AS mean_latency FROM w""")
def rolling_rates(spark: SparkSession, sf: str) -> DataFrame:
    out = stats.rolling_rate(t(spark, sf, "events"), "event_type", "ts", "event_id", 20, "value")
    return out.select("event_id", F.round("rate", 6).alias("rate"), F.round("mean_latency", 6).alias("mean_latency"))


@query("SELECT CAST(epoch(time_bucket(INTERVAL 1 HOUR, ts)) AS BIGINT) AS start, event_type, count(*) AS n, round(count(*) / 3600.0, 6) AS rate FROM events GROUP BY ALL")
def interval_rates(spark: SparkSession, sf: str) -> DataFrame:
    out = stats.interval_rates(t(spark, sf, "events"), "ts", 3600, "event_type")
    return out.select(F.col("start").cast("long").alias("start"), "event_type", "n", F.round("rate", 6).alias("rate"))


@query("""WITH k AS (SELECT user_id, epoch_us(ts) / 1e6 AS s FROM events QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) <= 50)
SELECT user_id, round(CASE WHEN count(*) > 1 AND max(s) > min(s) THEN (count(*) - 1) / (max(s) - min(s)) END, 6) AS frequency FROM k GROUP BY user_id""")
def mean_sample_frequency(spark: SparkSession, sf: str) -> DataFrame:
    return stats.mean_frequency(t(spark, sf, "events"), "user_id", "ts", "event_id").withColumn("frequency", F.round("frequency", 6))


@query("SELECT CAST(ceil(event_id / 100.0) AS BIGINT) AS log, max(event_id) AS event_id, round(avg(value), 6) AS value FROM events GROUP BY 1")
def log_interval_means(spark: SparkSession, sf: str) -> DataFrame:
    return stats.interval_means(t(spark, sf, "events"), "event_id", 100, ["value"]).withColumn("value", F.round("value", 6))


@query("SELECT label, round(sqrt(sum(x * x)), 6) AS norm FROM (SELECT label, CAST(unnest(embedding) AS DOUBLE) AS x FROM embeddings) GROUP BY label")
def tree_norms(spark: SparkSession, sf: str) -> DataFrame:
    long = vectors64(spark, sf).select("label", F.explode("x").alias("x"))
    return stats.tree_norm(long, "x", "label").withColumn("norm", F.round("norm", 6))


@query("""WITH j AS (SELECT *, abs(value - lag(value) OVER (PARTITION BY user_id ORDER BY ts, event_id)) AS d FROM events)
SELECT user_id, arg_min(value, (ts, event_id)) AS first, arg_max(value, (ts, event_id)) AS last, min(value) AS least, max(value) AS greatest, round(max(d), 6) AS largest_jump, count(*) AS steps FROM j GROUP BY user_id""")
def episode_summaries(spark: SparkSession, sf: str) -> DataFrame:
    out = stats.episode_summary(t(spark, sf, "events"), "user_id", TIMES, "value")
    return out.withColumn("largest_jump", F.round("largest_jump", 6))


@query("""WITH w AS (SELECT event_id, quantile_cont(value, 0.9) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN 19 PRECEDING AND CURRENT ROW) AS q FROM events)
SELECT event_id, CAST(greatest(0, least(ceil(q / 10 - 1e-9) + 1, 29)) AS INTEGER) AS delay, CAST(least(greatest(round_even(2.0 * greatest(0, least(ceil(q / 10 - 1e-9) + 1, 29)), 0), 5, greatest(0, least(ceil(q / 10 - 1e-9) + 1, 29)) + 1), 30) AS INTEGER) AS horizon FROM w""")
def adaptive_delay(spark: SparkSession, sf: str) -> DataFrame:
    w = W.partitionBy("user_id").orderBy(*TIMES).rowsBetween(-19, 0)
    q = t(spark, sf, "events").withColumn("quantile", F.percentile("value", F.lit(0.9)).over(w))
    d = q.withColumn("delay", C.delay_steps(F.col("quantile") / 10, 1, F.lit(30)))
    return d.select("event_id", "delay", C.execution_horizon(F.col("delay"), 2.0, 5, F.lit(30)).alias("horizon"))


@query("SELECT vec_id, round(sum(CASE WHEN dim % 3 = 0 THEN x ELSE 0 END) / greatest(sum(CASE WHEN dim % 3 = 0 THEN 1 ELSE 0 END), 1), 6) + 0.0 AS masked, round(sum(CASE WHEN dim >= 5 THEN x ELSE 0 END) / 64.0 * (64.0 / 59), 6) + 0.0 AS suffix FROM (" + E64 + ") GROUP BY vec_id")
def masked_losses(spark: SparkSession, sf: str) -> DataFrame:
    mask = F.transform("x", lambda _, i: i % 3 == 0)
    return vectors64(spark, sf).select("vec_id", r6(V.masked_mean(F.col("x"), mask)).alias("masked"), r6(V.suffix_loss(F.col("x"), F.lit(5))).alias("suffix"))


@query("""WITH RECURSIVE o AS (SELECT user_id, value, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS n FROM events),
r AS (SELECT user_id, n, value AS e FROM o WHERE n = 1 UNION ALL SELECT o.user_id, o.n, r.e * 0.9 + o.value * 0.1 FROM r JOIN o ON o.user_id = r.user_id AND o.n = r.n + 1)
SELECT user_id, round(arg_max(e, n), 6) AS ema FROM r GROUP BY user_id""")
def exponential_average(spark: SparkSession, sf: str) -> DataFrame:
    rows = windows.arrays_from_steps(user_steps(spark, sf), "user_id", "step", ["value"])
    return rows.select("user_id", F.round(V.moving_average(F.col("value"), 0.9), 6).alias("ema"))


@query("SELECT max(CAST(event_type_no AS BIGINT)) AS step FROM (SELECT CAST(event_id AS VARCHAR) AS event_type_no FROM events)")
def latest_checkpoint(spark: SparkSession, sf: str) -> DataFrame:
    e = t(spark, sf, "events")
    names = e.select(F.col("event_id").cast("string").alias("name")).unionByName(e.select(F.concat(F.lit("tmp_"), F.col("event_id").cast("string")).alias("name")))
    return stats.latest_checkpoint(names)


# --- chunks, runs, ranges


@query("""WITH s AS (SELECT *, row_number() OVER w - 1 AS step, count(*) OVER (PARTITION BY l_orderkey) AS n FROM lineitem WINDOW w AS (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey)),
k AS (SELECT s.l_orderkey, s.step, s.n, unnest(range(4)) AS k FROM s)
SELECT k.l_orderkey, CAST(k.step AS INTEGER) AS step, CAST(k.k AS INTEGER) AS k, s.l_quantity AS value, k.step + k.k >= k.n AS is_pad FROM k JOIN s ON s.l_orderkey = k.l_orderkey AND s.step = least(k.step + k.k, k.n - 1)""")
def action_chunks(spark: SparkSession, sf: str) -> DataFrame:
    steps = windows.with_steps(t(spark, sf, "lineitem"), "l_orderkey", LINES)
    out = windows.chunked(steps, "l_orderkey", LINES, "l_quantity", 4)
    return out.select("l_orderkey", "step", F.posexplode(F.arrays_zip("actions", "is_pad")).alias("k", "z")).select("l_orderkey", "step", "k", F.col("z.actions").alias("value"), F.col("z.is_pad").alias("is_pad"))


@query("""WITH s AS (SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey) - 1 AS step, count(*) OVER (PARTITION BY l_orderkey) AS n FROM lineitem),
k AS (SELECT l_orderkey, step, n, unnest(range(16)) AS k FROM s), j AS (SELECT s.l_quantity AS q, s.l_discount AS d FROM k JOIN s ON s.l_orderkey = k.l_orderkey AND s.step = least(k.step + k.k, k.n - 1))
SELECT 0 AS dim, CAST(count(*) AS DOUBLE) AS weight, round(avg(q), 6) AS mean, round(stddev_pop(q), 6) AS std FROM j UNION ALL SELECT 1, CAST(count(*) AS DOUBLE), round(avg(d), 6), round(stddev_pop(d), 6) FROM j""")
def chunk_weighted_stats(spark: SparkSession, sf: str) -> DataFrame:
    steps = windows.with_steps(t(spark, sf, "lineitem"), "l_orderkey", LINES)
    weighted = steps.select(F.array("l_quantity", "l_discount").alias("a"), stats.chunk_weights(F.col("length"), F.col("step"), 16).alias("w"))
    s = stats.weighted_statistics(weighted, "a", "w")
    return s.select("dim", "weight", F.round("mean", 6).alias("mean"), F.round("std", 6).alias("std"))


IDLE = """WITH s AS (SELECT user_id, """ + STEP_SQL + """ AS step, coalesce(abs(value - lag(value) OVER (PARTITION BY user_id ORDER BY ts, event_id)) < 30, false) AS idle FROM events),
a AS (SELECT *, step - row_number() OVER (PARTITION BY user_id, idle ORDER BY step) AS g FROM s), b AS (SELECT *, count(*) OVER (PARTITION BY user_id, idle, g) AS c FROM a),
k AS (SELECT user_id, step FROM b WHERE NOT (idle AND c >= 3)), i AS (SELECT *, step - row_number() OVER (PARTITION BY user_id ORDER BY step) AS g FROM k),
ranges AS (SELECT user_id, CAST(min(step) AS BIGINT) AS "start", CAST(max(step) + 1 - 2 AS BIGINT) AS "end" FROM i GROUP BY user_id, g HAVING count(*) >= 5) """


def _ranges(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    steps = user_steps(spark, sf).withColumn("v", F.array("value"))
    marked = steps.withColumn("idle", filters.idle(F.col("v"), F.col("step"), F.col("user_id"), 30))
    return steps, windows.active_ranges(marked, "user_id", "step", "idle", 3, 5, 2)


@query(IDLE + "SELECT * FROM ranges")
def idle_ranges(spark: SparkSession, sf: str) -> DataFrame:
    return _ranges(spark, sf)[1]


@query(IDLE + ', e AS (SELECT user_id, event_id, ' + STEP_SQL + ' AS step FROM events) SELECT event_id FROM e WHERE EXISTS (SELECT 1 FROM ranges r WHERE r.user_id = e.user_id AND e.step >= r."start" AND e.step < r."end")')
def keep_frames(spark: SparkSession, sf: str) -> DataFrame:
    steps, ranges = _ranges(spark, sf)
    return joins.kept_steps(steps, ranges, "user_id").select("event_id")


@query(IDLE + ', u AS (SELECT DISTINCT user_id FROM events) SELECT u.user_id, count(r."start") AS n, coalesce(sum(r."end" - r."start"), 0)::BIGINT AS steps FROM u LEFT JOIN ranges r ON r.user_id = u.user_id GROUP BY u.user_id')
def range_lists(spark: SparkSession, sf: str) -> DataFrame:
    steps, ranges = _ranges(spark, sf)
    lists = stats.ranges_by_episode(steps, ranges, "user_id")
    return lists.select("user_id", F.size("ranges").cast("long").alias("n"), F.aggregate("ranges", F.lit(0).cast("long"), lambda a, r: a + r["end"] - r["start"]).alias("steps"))


@query("SELECT user_id, event_id, round(abs(value - lag(value) OVER (PARTITION BY user_id ORDER BY ts, event_id)), 6) AS change FROM events")
def step_changes(spark: SparkSession, sf: str) -> DataFrame:
    out = windows.largest_step_change(user_steps(spark, sf).withColumn("v", F.array("value")), "user_id", "step", "v")
    return out.select("user_id", "event_id", F.round("change", 6).alias("change"))


@query("SELECT user_id, CAST(" + STEP_SQL + " AS INTEGER) AS step, value FROM events")
def trajectory_flatten(spark: SparkSession, sf: str) -> DataFrame:
    episodes = windows.arrays_from_steps(user_steps(spark, sf), "user_id", "step", ["value", "ts"])
    return windows.steps_from_arrays(episodes, ["value", "ts"]).select("user_id", "step", "value")


@query("SELECT user_id, event_id, row_number() OVER (ORDER BY user_id, ts, event_id) - 1 AS position FROM events")
def global_index(spark: SparkSession, sf: str) -> DataFrame:
    return windows.global_positions(t(spark, sf, "events"), ["user_id", *TIMES], 8).select("user_id", "event_id", "position")


@query("""WITH m AS (SELECT vec_id, CAST(unnest(range(32)) AS INTEGER) AS dim, CAST(unnest(embedding[1:32]) AS DOUBLE) > 0 AS v, CAST(unnest(embedding[33:64]) AS DOUBLE) > 0 AS s FROM embeddings),
p AS (SELECT *, sum(CAST(v AS INTEGER)) OVER w - 1 AS pos, sum(CAST(s AS INTEGER)) OVER w AS blk FROM m WINDOW w AS (PARTITION BY vec_id ORDER BY dim))
SELECT a.vec_id, CAST(sum(DISTINCT CASE WHEN a.dim = b.dim THEN a.pos * 10 + a.dim * 1000 END) AS BIGINT) AS positions, count(*) FILTER (b.blk <= a.blk AND a.v AND b.v) AS allowed FROM p a JOIN p b ON a.vec_id = b.vec_id GROUP BY a.vec_id""")
def attention_masks(spark: SparkSession, sf: str) -> DataFrame:
    df = vectors64(spark, sf).select("vec_id", F.transform(F.slice("x", 1, 32), lambda v: v > 0).alias("v"), F.transform(F.slice("x", 33, 32), lambda v: v > 0).alias("s"))
    places = F.transform(V.token_positions(F.col("v")), lambda p, i: p * 10 + i * 1000)
    allowed = F.size(F.filter(F.flatten(V.attention_allowed(F.col("v"), F.col("s"))), lambda b: b))
    return df.select("vec_id", F.aggregate(places, F.lit(0).cast("long"), lambda a, v: a + v).alias("positions"), allowed.cast("long").alias("allowed"))


@query("""WITH b AS (SELECT event_id, user_id, epoch_us(ts) / 1e6 AS s, value >= 20 AS bad, sum(CAST(value >= 20 AS INTEGER)) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS g FROM events)
SELECT event_id, NOT bad AND s - min(CASE WHEN NOT bad THEN s END) OVER (PARTITION BY user_id, g) >= 600 AS converged FROM b""")
def convergence_hold(spark: SparkSession, sf: str) -> DataFrame:
    return windows.held(t(spark, sf, "events"), "user_id", seconds("ts"), "event_id", "value", 20, 600).select("event_id", F.coalesce("converged", F.lit(False)).alias("converged"))


# --- joins and lookups


@query("SELECT c_custkey, n_name || ' of ' || r_name AS prompt FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey")
def prompt_from_task(spark: SparkSession, sf: str) -> DataFrame:
    tasks = t(spark, sf, "nation").join(F.broadcast(t(spark, sf, "region")), F.col("n_regionkey") == F.col("r_regionkey")).select(F.col("n_nationkey").alias("task_index"), F.concat("n_name", F.lit(" of "), "r_name").alias("prompt"))
    steps = t(spark, sf, "customer").select("c_custkey", F.col("c_nationkey").alias("task_index"))
    return joins.task_prompts(steps, tasks).select("c_custkey", "prompt")


@query("SELECT d.doc_id, coalesce('quality ' || CAST(l.quality AS VARCHAR), 'Do something') AS instruction FROM documents d LEFT JOIN labels l ON l.doc_id = d.doc_id")
def instruction_default(spark: SparkSession, sf: str) -> DataFrame:
    notes = t(spark, sf, "labels").select("doc_id", F.concat(F.lit("quality "), F.col("quality").cast("string")).alias("instruction"))
    return joins.instructions(t(spark, sf, "documents").select("doc_id"), notes, "doc_id")


@query("SELECT o_orderkey FROM orders WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem)")
def resume_antijoin(spark: SparkSession, sf: str) -> DataFrame:
    return joins.unprocessed(t(spark, sf, "orders").select("o_orderkey"), t(spark, sf, "lineitem").select(F.col("l_orderkey").alias("o_orderkey")), "o_orderkey")


@query("""WITH k AS (SELECT *, epoch_us(ts) / 1e6 AS s, CASE WHEN event_type = 'click' THEN {'s': epoch_us(ts) / 1e6, 'v': value} END AS c, CASE WHEN event_type = 'view' THEN {'s': epoch_us(ts) / 1e6, 'v': value} END AS w FROM events),
l AS (SELECT event_id, s, last_value(c IGNORE NULLS) OVER o AS c, last_value(w IGNORE NULLS) OVER o AS w FROM k WINDOW o AS (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW))
SELECT event_id, CASE WHEN s - c.s <= 3600 THEN c.v END AS latest_click, CASE WHEN s - w.s <= 3600 THEN w.v END AS latest_view, coalesce(s - c.s <= 3600, false) AND coalesce(s - w.s <= 3600, false) AS all_fresh FROM l""")
def latest_with_staleness(spark: SparkSession, sf: str) -> DataFrame:
    out = joins.latest_values(t(spark, sf, "events"), "user_id", "event_type", ["click", "view"], "ts", "value", "event_id", 3600)
    return out.select("event_id", "latest_click", "latest_view", "all_fresh")


@query("""WITH p AS (SELECT user_id, ts, max(value) AS v FROM events WHERE event_type = 'purchase' GROUP BY user_id, ts), c AS (SELECT event_id, user_id, ts FROM events WHERE event_type = 'click')
SELECT c.event_id, CASE WHEN epoch_us(c.ts) / 1e6 - epoch_us(p.ts) / 1e6 <= 7200 THEN p.v END AS v FROM c ASOF LEFT JOIN p ON c.user_id = p.user_id AND c.ts >= p.ts""")
def asof_join(spark: SparkSession, sf: str) -> DataFrame:
    e = t(spark, sf, "events")
    right = e.where("event_type = 'purchase'").groupBy("user_id", "ts").agg(F.max("value").alias("v"))
    return joins.asof(e.where("event_type = 'click'").select("event_id", "user_id", "ts"), right, "user_id", "ts", ["v"], 7200).select("event_id", "v")


@query("""SELECT o_orderkey AS path, round(o_totalprice, 2) AS value FROM orders WHERE o_orderkey IN (SELECT l_orderkey FROM lineitem) AND o_orderstatus = 'F'
UNION ALL SELECT l_orderkey, round(sum(l_extendedprice), 2) FROM lineitem WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders WHERE o_orderstatus = 'F') AND CAST(l_orderkey AS VARCHAR) LIKE '%7' GROUP BY l_orderkey""")
def merged_parameters(spark: SparkSession, sf: str) -> DataFrame:
    loaded = t(spark, sf, "orders").where("o_orderstatus = 'F'").select(F.col("o_orderkey").alias("path"), F.col("o_totalprice").alias("value"))
    reference = t(spark, sf, "lineitem").groupBy(F.col("l_orderkey").alias("path")).agg(F.sum("l_extendedprice").alias("value"))
    as_text = lambda d: d.withColumn("path", F.col("path").cast("string"))
    return joins.merged_parameters(as_text(loaded), as_text(reference), ".*7").select(F.col("path").cast("long").alias("path"), F.round("value", 2).alias("value"))


@query("""WITH s AS (SELECT user_id, """ + STEP_SQL + """ AS step, value FROM events), k AS (SELECT DISTINCT user_id, CAST(unnest(range(4)) AS INTEGER) AS k FROM events)
SELECT k.user_id, k.k, coalesce(s.value, 0.0) AS value FROM k LEFT JOIN s ON s.user_id = k.user_id AND s.step = 5 + k.k AND s.step < 7""")
def chunk_alignment(spark: SparkSession, sf: str) -> DataFrame:
    rows = windows.arrays_from_steps(user_steps(spark, sf), "user_id", "step", ["value"])
    previous = F.transform(F.slice("value", 1, 7), lambda v: F.array(v))
    return rows.select("user_id", F.posexplode(joins.aligned_chunk(previous, F.lit(5), 4)).alias("k", "row")).select("user_id", "k", F.get("row", F.lit(0)).alias("value"))


@query("""WITH f AS (SELECT *, max(CAST(value > 150 AS INTEGER)) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS seen FROM events) SELECT event_id FROM f WHERE seen = 0""")
def until_failure(spark: SparkSession, sf: str) -> DataFrame:
    return filters.until_first_failure(user_steps(spark, sf), F.col("value") > 150, "user_id", "step").select("event_id")


@query("""SELECT event_type, count(*) AS n FROM events WHERE NOT (event_type = 'error' OR event_type LIKE 's%') GROUP BY event_type""")
def path_filter(spark: SparkSession, sf: str) -> DataFrame:
    return filters.paths_matching(t(spark, sf, "events"), "error|s.*", "event_type", negate=True).groupBy("event_type").agg(F.count("*").alias("n"))


@query("WITH s AS (SELECT event_id, " + STEP_SQL + " AS step, count(*) OVER (PARTITION BY user_id) AS n FROM events) SELECT event_id FROM s WHERE step >= 10 AND step < greatest(n - 5, 0)")
def frame_range(spark: SparkSession, sf: str) -> DataFrame:
    return filters.frame_range(filters.after_warm_up(user_steps(spark, sf)), "step", 0, -5, "length").select("event_id")


# --- deltas


DELTA = """WITH s AS (SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity AS q, l_discount AS d, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey) - 1 AS step, count(*) OVER (PARTITION BY l_orderkey) AS n FROM lineitem),
k AS (SELECT *, unnest(range(3)) AS k FROM s), j AS (SELECT k.l_orderkey, CAST(k.step AS INTEGER) AS step, CAST(k.k AS INTEGER) AS k, s.q, s.d, k.q AS q0 FROM k JOIN s ON s.l_orderkey = k.l_orderkey AND s.step = least(k.step + k.k, k.n - 1)) """


def _delta(spark: SparkSession, sf: str, back: bool) -> DataFrame:
    steps = windows.with_steps(t(spark, sf, "lineitem"), "l_orderkey", LINES).withColumn("state", F.array("l_quantity", "l_discount"))
    rows = windows.chunked(steps, "l_orderkey", LINES, "state", 3)
    run = [pipeline.delta_actions([True, False])] + [pipeline.absolute_actions([True, False])] * back
    out = pipeline.composed(run)(rows)
    return out.select("l_orderkey", "step", F.posexplode("actions").alias("k", "a")).select("l_orderkey", "step", "k", r6(F.get("a", F.lit(0))).alias("q"), r6(F.get("a", F.lit(1))).alias("d"))


@query(DELTA + "SELECT l_orderkey, step, k, round(q - q0, 6) + 0.0 AS q, round(d, 6) + 0.0 AS d FROM j")
def delta_actions(spark: SparkSession, sf: str) -> DataFrame:
    return _delta(spark, sf, False)


@query(DELTA + "SELECT l_orderkey, step, k, round(q, 6) + 0.0 AS q, round(d, 6) + 0.0 AS d FROM j")
def absolute_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    return _delta(spark, sf, True)


# --- sampling and batches


def draw_sql(seed: str, key: str) -> str:
    return f"md5('{seed}:' || CAST({key} AS VARCHAR))"


@query("""WITH d AS (SELECT o_orderkey, CAST(('0x' || substr(md5('7:' || CAST(o_orderkey AS VARCHAR)), 1, 8)) AS BIGINT) % 4 AS shard, md5('7:order:' || CAST(o_orderkey AS VARCHAR)) AS o FROM orders),
p AS (SELECT o_orderkey, CAST(shard AS INTEGER) AS shard, row_number() OVER (PARTITION BY shard ORDER BY o, o_orderkey) - 1 AS i, count(*) OVER (PARTITION BY shard) AS n FROM d)
SELECT o_orderkey, shard, i // 32 AS batch, CAST(i % 32 AS INTEGER) AS slot FROM p WHERE i // 32 < n // 32""")
def seeded_batches(spark: SparkSession, sf: str) -> DataFrame:
    return sampling.batched(t(spark, sf, "orders").select("o_orderkey"), 32, 7, ["o_orderkey"], shards=4)


@query("SELECT o_orderkey, (['left', 'right', 'wrist'])[1 + CAST(('0x' || substr(md5('3:' || CAST(o_orderkey AS VARCHAR)), 1, 8)) AS BIGINT) % 3] AS camera FROM orders")
def one_of_n(spark: SparkSession, sf: str) -> DataFrame:
    return t(spark, sf, "orders").select("o_orderkey", sampling.one_of(F.array(F.lit("left"), F.lit("right"), F.lit("wrist")), 3, "o_orderkey").alias("camera"))


@query("WITH s AS (SELECT event_id, user_id, " + STEP_SQL + """ AS step FROM events) SELECT event_id FROM s QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY md5('5:' || CAST(user_id AS VARCHAR) || ':' || CAST(step AS VARCHAR)), step) <= 3""")
def sampled_steps(spark: SparkSession, sf: str) -> DataFrame:
    return sampling.sampled_steps(user_steps(spark, sf), "user_id", "step", 3, 5).select("event_id")


@query("SELECT o_orderkey FROM orders WHERE CAST(('0x' || substr(md5('1:2:' || CAST(o_orderkey AS VARCHAR)), 1, 8)) AS BIGINT) % 8 = 3")
def reader_share(spark: SparkSession, sf: str) -> DataFrame:
    return sampling.rank_share(t(spark, sf, "orders"), 8, 3, 1, 2, "o_orderkey").select("o_orderkey")


@query("SELECT o_orderkey, CAST(unnest(range(3)) AS INTEGER) AS epoch FROM (SELECT o_orderkey FROM orders ORDER BY md5('11:' || CAST(o_orderkey AS VARCHAR)), o_orderkey LIMIT 50)")
def limited_epochs(spark: SparkSession, sf: str) -> DataFrame:
    return sampling.epochs(sampling.first_rows(t(spark, sf, "orders").select("o_orderkey"), 50, 11, "o_orderkey"), 3)


@query("SELECT vec_id, CAST(list_position(embedding, list_max(embedding)) - 1 AS INTEGER) AS best FROM embeddings")
def greedy_choice(spark: SparkSession, sf: str) -> DataFrame:
    return t(spark, sf, "embeddings").select("vec_id", sampling.categorical(F.col("embedding"), 0, 0).alias("best"))


@query("""WITH l AS (SELECT vec_id, CAST(unnest(range(64)) AS INTEGER) AS i, CAST(unnest(embedding) AS DOUBLE) AS v FROM embeddings),
g AS (SELECT vec_id, i, v - ln(-ln((CAST('0x' || substr(md5('9:' || CAST(vec_id AS VARCHAR) || ':' || CAST(i AS VARCHAR)), 1, 8) AS BIGINT) + 0.5::DOUBLE) / 4294967296.0::DOUBLE)) AS x FROM l) SELECT vec_id, arg_max(i, x) AS drawn FROM g GROUP BY vec_id""")
def temperature_choice(spark: SparkSession, sf: str) -> DataFrame:
    return vectors64(spark, sf).select("vec_id", sampling.categorical(F.col("x"), 1.0, 9, "vec_id").alias("drawn"))


# --- sets and projections


@query("SELECT 0 AS dataset_id, c_custkey AS id, c_acctbal AS balance FROM customer UNION ALL SELECT 1, s_suppkey, s_acctbal FROM supplier")
def concatenated_datasets(spark: SparkSession, sf: str) -> DataFrame:
    a = t(spark, sf, "customer").select(F.col("c_custkey").alias("id"), F.col("c_acctbal").alias("balance"))
    b = t(spark, sf, "supplier").select(F.col("s_suppkey").alias("id"), F.col("s_acctbal").alias("balance"))
    return sets.concatenated([a, b]).select("dataset_id", "id", "balance")


@query("SELECT p_partkey AS id, p_name AS name, p_retailprice AS price FROM part")
def repacked_rows(spark: SparkSession, sf: str) -> DataFrame:
    nested = projections.unflatten(t(spark, sf, "part").select("p_partkey", F.col("p_name").alias("about/name"), F.col("p_retailprice").alias("about/price"), F.col("p_size").alias("about/size/mm")))
    renamed = projections.rename_by_pattern(nested, {"about/size/.*": None, "about/(.+)": r"info/\1"})
    return projections.flatten(projections.repack(renamed, {"id": "p_partkey", "name": "info/name", "price": "info/price"}))


@query("SELECT vec_id, round(CAST(embedding[1] AS DOUBLE), 6) + 0.0 AS a, round(CAST(embedding[2] AS DOUBLE), 6) + 0.0 AS b, round(CAST(embedding[3] AS DOUBLE), 6) + 0.0 AS c FROM embeddings")
def plot_columns(spark: SparkSession, sf: str) -> DataFrame:
    out = projections.spread(vectors64(spark, sf).select("vec_id", "x"), "x", ["a", "b", "c"])
    return out.select("vec_id", *[r6(c).alias(c) for c in "abc"])


@query("SELECT p_partkey, len(list_filter(string_split(p_type || ' ' || p_name, ' '), lambda x: x NOT IN ('ECONOMY', 'ring', 'red'))) AS odd FROM part")
def unexpected_names(spark: SparkSession, sf: str) -> DataFrame:
    names = F.split(F.concat_ws(" ", "p_type", "p_name"), " ")
    return t(spark, sf, "part").select("p_partkey", F.size(F.filter(names, lambda n: F.size(sets.unexpected(F.array(n), ["ECONOMY", "ring", "red"])) > 0)).cast("long").alias("odd"))


# --- scalar functions


@query("""WITH e AS (SELECT event_id, value / 47.3 - 1 AS x FROM events) SELECT event_id, round(CASE WHEN x > 0 THEN 0.10 * (1 - x / 2) ELSE 0.10 - x * 0.90 / 1.6 END, 6) AS second, round(x, 6) + 0.0 AS back,
round(CASE WHEN x > 0 THEN 0.5 - x / 7 ELSE 0.5 - x END, 6) AS left_unit, round(CASE WHEN x < 0 THEN x / 7 + 0.5 ELSE x + 0.5 END, 6) AS right_unit, round(greatest(0, least(1, CASE WHEN x > 0 THEN 0.10 * (1 - x / 2) ELSE 0.10 - x * 0.90 / 1.6 END)), 6) AS sent FROM e""")
def gripper_curves(spark: SparkSession, sf: str) -> DataFrame:
    e = t(spark, sf, "events").select("event_id", (F.col("value") / 47.3 - 1).alias("x"))
    trigger = R.effort_to_trigger(F.col("x"))
    return e.select("event_id", F.round(trigger, 6).alias("second"), r6(R.trigger_to_effort(trigger)).alias("back"), F.round(R.left_effort_to_unit(F.col("x")), 6).alias("left_unit"), F.round(R.right_effort_to_unit(F.col("x")), 6).alias("right_unit"), F.round(R.published(trigger), 6).alias("sent"))


@query("""WITH e AS (SELECT event_id, least(value / 100, 1.0) AS x FROM events), p AS (SELECT event_id, x, x * (0.05800 - 0.01844) + 0.01844 AS l FROM e)
SELECT event_id, round((asin(greatest(-1, least(1, (0.022 * 0.022 + l * l - 0.036 * 0.036) / (2 * 0.022 * l)))) - 0.5476) / (1.6296 - 0.5476), 6) + 0.0 AS angle, round((x + 0.5476 + 0.6213) / (1.4910 + 0.6213), 6) AS joint, round(x, 6) AS back FROM p""")
def gripper_angles(spark: SparkSession, sf: str) -> DataFrame:
    x = F.least(F.col("value") / 100, F.lit(1.0))
    return t(spark, sf, "events").select("event_id", r6(R.gripper_to_angle(x)).alias("angle"), F.round(R.gripper_from_angle(x), 6).alias("joint"), F.round(R.gripper_from_angle_inverse(R.gripper_from_angle(x)), 6).alias("back"))


@query("""WITH p AS (SELECT event_id, event_id % 13 AS s, least(greatest(0, event_id % 17), 12) AS e FROM events), q AS (SELECT event_id, least(s, e) AS s, e, CAST(unnest(range(12)) AS INTEGER) AS k FROM p),
w AS (SELECT *, CASE WHEN k >= e THEN 0.0 WHEN k < s THEN 1.0 ELSE greatest(0.0, least(1.0, 1.0 - (k - s + 1) / CAST(e - s + 1 AS DOUBLE))) END AS w FROM q)
SELECT event_id, k, round(w, 6) AS linear, round(w * (exp(w) - 1) / (exp(1.0) - 1), 6) AS expo, CASE WHEN k < e THEN 1.0 ELSE 0.0 END AS ones, CASE WHEN k < s THEN 1.0 ELSE 0.0 END AS zeros FROM w""".replace("0.0 WHEN", "0.0::DOUBLE WHEN").replace("1.0 ELSE 0.0 END", "1.0::DOUBLE ELSE 0.0::DOUBLE END"))
def rtc_prefix_weights(spark: SparkSession, sf: str) -> DataFrame:
    s, e, k = F.col("event_id") % 13, F.col("event_id") % 17, F.col("k")
    named = {"linear": "linear", "exp": "expo", "ones": "ones", "zeros": "zeros"}
    steps = t(spark, sf, "events").select("event_id", F.explode(F.array(*[F.lit(i) for i in range(12)])).alias("k"))
    return steps.select("event_id", "k", *[F.round(C.prefix_weight(k, s, e, 12, kind), 6).alias(n) for kind, n in named.items()])


@query("""WITH t AS (SELECT event_id, greatest(1e-6, least(1 - 1e-6, value / 100)) AS t FROM events) SELECT event_id, round(least((t * t + (1 - t) * (1 - t)) / (t * (1 - t)), 10), 6) AS w FROM t""")
def guidance_weights(spark: SparkSession, sf: str) -> DataFrame:
    return t(spark, sf, "events").select("event_id", F.round(C.guidance_weight(F.col("value") / 100, 10), 6).alias("w"))


@query("""WITH s AS (SELECT event_id AS step FROM events) SELECT step, round(1e6 * CASE WHEN step < 100 THEN 2.5e-5 / 101 + (2.5e-5 - 2.5e-5 / 101) * step / 100.0 ELSE 2.5e-6 + (2.5e-5 - 2.5e-6) * (cos(pi() * least((step - 100) / 4900.0, 1.0)) + 1) / 2 END, 6) AS cosine,
round(1e6 * CASE WHEN step < 100 THEN 5e-5 / 101 + (5e-5 - 5e-5 / 101) * step / 100.0 ELSE 5e-5 / sqrt((10000.0 + step - 100) / 10000.0) END, 6) AS rsqrt FROM s""")
def lr_schedule(spark: SparkSession, sf: str) -> DataFrame:
    step = F.col("event_id")
    return t(spark, sf, "events").select(step.alias("step"), F.round(C.warmup_cosine(step, 100, 2.5e-5, 5000, 2.5e-6) * 1e6, 6).alias("cosine"), F.round(C.warmup_rsqrt(step, 100) * 1e6, 6).alias("rsqrt"))


@query("SELECT vec_id, dim, CASE WHEN x < -1 THEN -1 ELSE CAST(least(floor((x + 1) * 128), 255) AS INTEGER) END AS bin FROM (SELECT vec_id, dim, x * 8 AS x FROM (" + E64 + "))")
def discretize_state(spark: SparkSession, sf: str) -> DataFrame:
    x = F.transform("x", lambda v: v * 8)
    return vectors64(spark, sf).select("vec_id", F.posexplode(V.discretise(x)).alias("dim", "bin"))


@query(r"""WITH p AS (SELECT doc_id, regexp_replace(text, '^\s+|\s+$', '', 'g') AS a, regexp_replace(lower(text), '^\s+|\s+$', '', 'g') AS b FROM documents)
SELECT doc_id, translate(a, '_' || chr(10), '  ') AS prompt, 'Task: ' || translate(b, '_', ' ') || ', State: 1 ' || CAST(doc_id % 256 AS VARCHAR) || ';' || chr(10) || 'Action: ' AS full_prompt FROM p""")
def prompt_template(spark: SparkSession, sf: str) -> DataFrame:
    bins = F.array(F.lit(1).cast("long"), F.col("doc_id") % 256)
    return t(spark, sf, "documents").select("doc_id", X.clean_prompt(F.col("text")).alias("prompt"), X.prompt_with_state(X.clean_prompt_lower(F.col("text")), bins).alias("full_prompt"))


@query("""WITH d AS (SELECT event_id, CAST(event_id % 10 AS INTEGER) AS p, CAST(event_id % 7 AS INTEGER) AS q FROM events), k AS (SELECT *, CAST(unnest(range(12)) AS INTEGER) AS k FROM d)
SELECT event_id, k, CASE WHEN k < p THEN 5 WHEN k < p + q THEN 9 ELSE 0 END AS id, k < p + q AS mask, CAST(k >= p AND k < p + q AS INTEGER) AS ar, k >= p AND k < p + q AS loss FROM k""")
def token_masks(spark: SparkSession, sf: str) -> DataFrame:
    p, q = (F.col("event_id") % 10).cast("int"), (F.col("event_id") % 7).cast("int")
    z = X.prefix_postfix_tokens(F.array_repeat(F.lit(5), p), F.array_repeat(F.lit(9), q), 12)
    out = t(spark, sf, "events").select("event_id", z.alias("z"))
    return out.select("event_id", F.posexplode(F.arrays_zip("z.ids", "z.mask", "z.ar_mask", "z.loss_mask")).alias("k", "v")).select("event_id", "k", F.col("v.ids").alias("id"), F.col("v.mask").alias("mask"), F.col("v.ar_mask").alias("ar"), F.col("v.loss_mask").alias("loss"))


@query("SELECT event_id, CAST(event_id % 8 + 8 * (event_id % 5) + 40 * (event_id % 6) AS BIGINT) AS token, CAST(event_id % 5 AS INTEGER) AS second, CAST(999 - 128 - event_id % 100 AS BIGINT) AS flipped FROM events")
def token_codes(spark: SparkSession, sf: str) -> DataFrame:
    e = F.col("event_id")
    token = X.digits_to_token(F.array(e % 8, e % 5, e % 6), [8, 5, 6])
    return t(spark, sf, "events").select("event_id", token.alias("token"), F.get(X.token_to_digits(token, [8, 5, 6]), F.lit(1)).alias("second"), X.flip_token(e % 100, 1000).alias("flipped"))


@query("SELECT event_id, CAST(props ->> 'k' AS BIGINT) AS k, 'f--' || event_type || '--' || CAST(event_id AS VARCHAR) AS step_id, strftime(ts, '%Y_%m_%d_%H:%M:%S') AS stamp FROM events")
def json_props(spark: SparkSession, sf: str) -> DataFrame:
    return t(spark, sf, "events").select("event_id", F.from_json("props", "k long")["k"].alias("k"), X.step_id(F.lit("f"), F.col("event_type"), F.col("event_id")).alias("step_id"), X.day_stamp(F.col("ts")).alias("stamp"))


@query("""WITH q AS (SELECT vec_id, CAST(embedding[1] AS DOUBLE) AS x, CAST(embedding[2] AS DOUBLE) AS y, CAST(embedding[3] AS DOUBLE) AS z, greatest(-1, least(1, CAST(embedding[4] AS DOUBLE))) AS w FROM embeddings), d AS (SELECT *, sqrt(1 - w * w) AS d FROM q)
SELECT vec_id, round(x * 2 * acos(w) / d, 6) + 0.0 AS a, round(y * 2 * acos(w) / d, 6) + 0.0 AS b, round(z * 2 * acos(w) / d, 6) + 0.0 AS c FROM d""")
def axis_angles(spark: SparkSession, sf: str) -> DataFrame:
    a = V.quaternion_to_axis_angle(F.slice("x", 1, 4))
    return vectors64(spark, sf).select("vec_id", a.alias("a")).select("vec_id", *[r6(F.get("a", F.lit(i))).alias(n) for i, n in enumerate("abc")])


@query("""WITH k AS (SELECT event_id, value, CAST(unnest(range(4)) AS INTEGER) AS k FROM events) SELECT event_id, k, round(sin(value / (4e-3 * pow(4.0 / 4e-3, k / 3.0)) * 2 * pi()), 6) + 0.0 AS s, round(cos(value / (4e-3 * pow(4.0 / 4e-3, k / 3.0)) * 2 * pi()), 6) + 0.0 AS c FROM k""")
def position_embeddings(spark: SparkSession, sf: str) -> DataFrame:
    e = V.sincos_embedding(F.col("value"), 8, 4e-3, 4.0)
    z = F.arrays_zip(F.slice(e, 1, 4).alias("s"), F.slice(e, 5, 4).alias("c"))
    return t(spark, sf, "events").select("event_id", F.posexplode(z).alias("k", "z")).select("event_id", "k", r6(F.col("z.s")).alias("s"), r6(F.col("z.c")).alias("c"))


# --- streams in batch form


@query("WITH s AS (SELECT event_id, " + STEP_SQL + " AS step FROM events) SELECT event_id, CAST(step // 5 AS BIGINT) AS chunk, CAST(step % 5 AS INTEGER) AS k FROM s")
def chunk_broker(spark: SparkSession, sf: str) -> DataFrame:
    chunk, k = playback.broker_position(F.col("step"), 5)
    return user_steps(spark, sf).select("event_id", chunk.alias("chunk"), k.alias("k"))


@query("WITH s AS (SELECT user_id, " + STEP_SQL + " AS step, epoch_us(ts) / 1e6 AS t FROM events) SELECT user_id, t, CAST(step // 5 AS BIGINT) AS chunk, CAST(step % 5 AS INTEGER) AS index, step % 5 = 0 AS asks FROM s")
def chunk_broker_stateful(spark: SparkSession, sf: str) -> DataFrame:
    events = t(spark, sf, "events").select("user_id", seconds("ts").alias("t"), "event_id")
    return runner.over_table(events, machines.Broker(5), "user_id", ["t", "event_id"])


@query("WITH s AS (SELECT user_id, " + STEP_SQL + " AS step FROM events) SELECT user_id, CAST(step AS BIGINT) AS step, CAST(step AS BIGINT) AS chunk_step FROM s")
def rtc_splice(spark: SparkSession, sf: str) -> DataFrame:
    rows = user_steps(spark, sf).select("user_id", "step", (F.col("event_id") % 5 + 1).cast("int").alias("latency"))
    out = runner.over_table(rows, machines.Splice(chunk=30, horizon=10, delay=5), "user_id", ["step"])
    return out.select("user_id", "step", "chunk_step")


@query("""SELECT event_id FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id) QUALIFY row_number() OVER w = 1 OR event_type IS DISTINCT FROM lag(event_type) OVER w""")
def dedupe_latest(spark: SparkSession, sf: str) -> DataFrame:
    return playback.if_new(user_steps(spark, sf), "user_id", "step", "event_type").select("event_id")


@query("SELECT user_id, arg_max(event_id, (ts, event_id)) AS event_id FROM events GROUP BY user_id")
def newest_per_key(spark: SparkSession, sf: str) -> DataFrame:
    events = t(spark, sf, "events").select("user_id", "event_id", F.struct("ts", "event_id").alias("at"))
    return runner.newest_of_batch(events, "user_id", "at").select("user_id", "event_id")


@query("""WITH l AS (SELECT event_id, value, coalesce(lag(value) OVER (PARTITION BY user_id ORDER BY ts, event_id), value) AS s FROM events), k AS (SELECT *, CAST(unnest(range(4)) AS INTEGER) AS tick FROM l)
SELECT event_id, tick, round(s + (tick + 1) / 4.0 * (value - s), 6) AS v FROM k""")
def ramp_interpolation(spark: SparkSession, sf: str) -> DataFrame:
    c = user_steps(spark, sf).select("user_id", "event_id", "step", F.array("value").alias("target"))
    return playback.ramped(c, "user_id", "step", "target", 4).select("event_id", "tick", F.round(F.get("value", F.lit(0)), 6).alias("v"))


@query("SELECT event_id FROM events QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) % 4 = 0")
def heartbeats(spark: SparkSession, sf: str) -> DataFrame:
    return playback.every_nth(user_steps(spark, sf), "user_id", "step", 4).select("event_id")


@query("SELECT event_id, value, lag(value) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS previous_total FROM events")
def server_timing(spark: SparkSession, sf: str) -> DataFrame:
    return playback.server_timing(user_steps(spark, sf), "user_id", "step", "value").select("event_id", "value", "previous_total")


@query("WITH s AS (SELECT event_id, " + STEP_SQL + " AS step FROM events) SELECT event_id, round(100.0 + (step + 1) * 0.02, 6) AS due FROM s")
def replay_due_times(spark: SparkSession, sf: str) -> DataFrame:
    return playback.due_times(user_steps(spark, sf), "step", F.lit(100.0), 0.02).select("event_id", F.round("due", 6).alias("due"))


def event_stream(spark: SparkSession, sf: str) -> DataFrame:
    """The events as a stream, with ts as a timestamp, which watermarks need."""
    schema = t(spark, sf, "events").schema
    raw = spark.readStream.schema(schema).parquet(f"{sf}/events.parque[t]")  # a pattern may also be a single file
    return raw.withColumn("ts", F.col("ts").cast("timestamp"))


@query(SQL["interval_rates"])
def stream_interval_rates(spark: SparkSession, sf: str) -> DataFrame:
    rates = runner.interval_rates_stream(event_stream(spark, sf), "ts", 3600, "1 hour", "event_type")
    out = runner.drained(rates, "stream_interval_rates", complete=True)
    return out.select(F.col("start").cast("long").alias("start"), "event_type", "n", F.round("rate", 6).alias("rate"))


@query(SQL["chunk_broker_stateful"])
def stream_chunk_broker(spark: SparkSession, sf: str) -> DataFrame:
    events = event_stream(spark, sf).select("user_id", seconds("ts").alias("t"), "event_id")
    return runner.drained(runner.over_stream(events, machines.Broker(5), "user_id", ["t", "event_id"]), "stream_chunk_broker")


@query("SELECT DISTINCT user_id, event_type FROM events")
def stream_without_repeats(spark: SparkSession, sf: str) -> DataFrame:
    once = runner.without_repeats_stream(event_stream(spark, sf).select("user_id", "event_type", "ts"), ["user_id", "event_type"], "ts", "9999 days")
    return runner.drained(once, "stream_without_repeats").select("user_id", "event_type")


@query("""WITH e AS (SELECT user_id, event_id, event_id * 0.001::DOUBLE AS t, CASE WHEN event_type = 'click' THEN value END AS c, CASE WHEN event_type <> 'click' THEN value END AS m FROM events),
l AS (SELECT *, last_value(c IGNORE NULLS) OVER w AS command, max(CASE WHEN c IS NOT NULL THEN t END) OVER w AS set_at, max(CASE WHEN m IS NOT NULL THEN t END) OVER (PARTITION BY user_id ORDER BY t, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS seen
FROM e WINDOW w AS (PARTITION BY user_id ORDER BY t, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW))
SELECT user_id, t, greatest(-10.0::DOUBLE, least(10.0::DOUBLE, 0.5::DOUBLE * (command - m))) AS velocity FROM l WHERE m IS NOT NULL AND t - set_at <= 5 AND coalesce(t - seen <= 2, true)""")
def relay_control(spark: SparkSession, sf: str) -> DataFrame:
    e = t(spark, sf, "events").select("user_id", (F.col("event_id") * 0.001).alias("t"), "event_id", F.when(F.col("event_type") == "click", F.col("value")).alias("command"), F.when(F.col("event_type") != "click", F.col("value")).alias("measured"))
    return runner.over_table(e, machines.Relay(0.5, 10.0, 5.0, 2.0), "user_id", ["t", "event_id"])


def queries() -> dict[str, Query]:
    from stridelake import adapter_queries, service_queries, source_queries  # noqa: F401  register their own

    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    queries()
    return dict(SQL)
