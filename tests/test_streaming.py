import pytest
from pyspark.sql import functions as F

from stridelake.streaming import machines as M
from stridelake.streaming import playback, runner


def splice(latencies, **kw):
    m = M.Splice(**kw)
    s = m.start()
    return [o for lat in latencies for o in m.step(s, {"latency": lat})]


@pytest.mark.parametrize("latency", [1, 3, 5, 8, 12])
@pytest.mark.parametrize("adapt", [0, 20])
def test_splice_runs_every_step_once(latency, adapt):
    out = splice([latency] * 90, chunk=30, horizon=10, delay=5, adapt=adapt)
    assert [o["step"] for o in out] == list(range(90)) and all(o["chunk_step"] + 0 == o["step"] for o in out if not o["waited"] or o["step"] == 0)
    assert len({o["chunk_id"] for o in out}) > 3


def test_splice_adapts_to_the_latency():
    out = splice([9] * 200, chunk=30, horizon=6, delay=2, adapt=20, margin=1)
    assert out[-1]["delay"] == 10 and out[-1]["horizon"] == 20


def test_machines_in_batch(spark):
    def run(machine, rows, schema, order=("t",)):
        return [r.asDict() for r in runner.over_table(spark.createDataFrame(rows, schema), machine, "k", list(order)).orderBy("t").collect()]

    rows = [("a", 0.0, "x", 1.0), ("a", 0.5, "y", 2.0), ("a", 1.2, "x", 3.0), ("a", 3.0, "x", 4.0)]
    got = run(M.Latest(["x", "y"], 1.0), rows, "k string, t double, channel string, value double")
    assert [(g["t"], g["values"]) for g in got] == [(0.5, {"x": 1.0, "y": 2.0}), (1.2, {"x": 3.0, "y": 2.0})]
    assert len(run(M.Latest(["x", "y"], 1.0, barrier=True), rows, "k string, t double, channel string, value double")) == 3
    marks = [("a", float(i), m) for i, m in enumerate(["p", "p", "q", "p", None, None])]
    assert [g["t"] for g in run(M.IfNew(), marks, "k string, t double, mark string")] == [0, 2, 3, 4]
    times = [("a", float(i)) for i in range(10)]
    assert [g["count"] for g in run(M.EveryNth(4), times, "k string, t double")] == [4, 8]
    assert [g["t"] for g in run(M.Throttle(3.0), times, "k string, t double")] == [0, 3, 6, 9]
    errors = [("a", float(i), v) for i, v in enumerate([9.0, 1.0, 1.0, 1.0, 9.0, 1.0])]
    assert [g["converged"] for g in run(M.Converged(5, 2), errors, "k string, t double, value double")] == [False, False, False, True, False, False]
    requests = [("a", 0.0, 0, 0, False), ("a", 1.0, 1, 3, False), ("a", 2.0, 1, 3, False), ("a", 3.0, 0, 0, True), ("a", 4.0, 0, 0, False)]
    got = run(M.History(), requests, "k string, t double, previous long, prefix_start int, reset boolean")
    assert [g["chunk"] for g in got] == [1, 2, None, 1] and "stale" in got[2]["error"] and got[1]["from_step"] == 3
    relay = [("a", 0.0, 1.0, None), ("a", 0.1, None, 0.5), ("a", 0.2, None, 0.5), ("a", 0.55, None, 0.5), ("a", 0.6, None, 0.5)]
    got = run(M.Relay(1.0, 0.3), relay, "k string, t double, command double, measured double")
    assert [(g["t"], g["velocity"]) for g in got] == [(0.1, 0.3), (0.2, 0.3)]
    steps = [("a", float(i), i == 2) for i in range(8)]
    assert [(g["episode"], g["step"]) for g in run(M.Runtime(4), steps, "k string, t double, done boolean")] == [(0, 0), (0, 1), (0, 2), (1, 0), (1, 1), (1, 2), (1, 3), (2, 0)]


def test_stream_equals_batch(spark, tmp_path):
    rows = [(k, float(i), i) for i in range(30) for k in ("a", "b", "c")]
    df = spark.createDataFrame(rows, "k string, t double, n int")
    for part in range(3):
        df.where(F.floor(F.col("n") / 10) == part).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    files = spark.readStream.schema(df.schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    for name, machine in (("broker", M.Broker(4)), ("nth", M.EveryNth(7))):
        q = runner.over_stream(files, machine, "k", ["t"]).writeStream.format("memory").queryName(name).option("checkpointLocation", str(tmp_path / name)).outputMode("append").start()
        q.processAllAvailable()
        q.stop()
        want = runner.over_table(df, machine, "k", ["t"])
        assert sorted(map(tuple, spark.table(name).collect())) == sorted(map(tuple, want.select(spark.table(name).columns).collect()))


def test_windows_and_pairs_on_streams(spark, tmp_path):
    df = spark.range(60).select(F.timestamp_seconds(F.col("id") + 6000).alias("ts"), (F.col("id") % 2).alias("pts"))
    df.coalesce(1).write.parquet(str(tmp_path / "in"))
    files = spark.readStream.schema(df.schema).parquet(str(tmp_path / "in"))
    q = runner.interval_rates_stream(files, "ts", 10, "1 second").writeStream.format("memory").queryName("rates").option("checkpointLocation", str(tmp_path / "c1")).outputMode("append").start()
    q.processAllAvailable()
    q.stop()
    assert {r["rate"] for r in spark.table("rates").collect()} == {1.0}
    pair = runner.matched_stream(files.where("ts < timestamp_seconds(6002)"), files.where("ts >= timestamp_seconds(6058)"), "pts", "ts", "2 minutes")
    q = pair.writeStream.format("memory").queryName("pairs").option("checkpointLocation", str(tmp_path / "c2")).outputMode("append").start()
    q.processAllAvailable()
    q.stop()
    assert spark.table("pairs").count() == 2


def test_playback(spark):
    df = spark.createDataFrame([("a", 0, [0.0]), ("a", 1, [4.0])], "k string, step int, target array<double>")
    got = playback.ramped(df, "k", "step", "target", 4).where("step = 1").orderBy("tick")
    assert [r["value"][0] for r in got.collect()] == [1, 2, 3, 4]
    events = spark.createDataFrame([("a", 1, "x"), ("a", 2, "y"), ("b", 1, "z")], "k string, t int, v string")
    assert {(r["k"], r["v"]) for r in runner.newest_of_batch(events, "k", "t").collect()} == {("a", "y"), ("b", "z")}


def test_sessions_and_newer(spark):
    fields = "k string, t double, path string, connect boolean, answer string, infer_ms double, total_ms double"
    rows = [("a", 0.0, "/", False, "x", 1.0, 2.0), ("a", 1.0, "/healthz", False, None, None, None), ("a", 2.0, "/", True, "x", 1.0, 2.0), ("a", 3.0, "/", False, "y", 3.0, 4.0)]
    rows += [("a", 4.0, "/", False, None, None, None), ("a", 5.0, "/", False, "z", 1.0, 1.0), ("a", 6.0, "/", True, "z", 1.0, 1.0)]
    got = runner.over_table(spark.createDataFrame(rows, fields), M.Session("{}"), "k", ["t"]).collect()
    assert [(g["t"], g["kind"]) for g in got] == [(1, "health"), (2, "metadata"), (2, "answer"), (3, "answer"), (4, "error"), (6, "metadata"), (6, "answer")]
    assert [g["prev_total_ms"] for g in got if g["kind"] == "answer"] == [None, 2.0, None]
    times = spark.createDataFrame([("a", i, v) for i, v in enumerate([1.0, 1.0, 3.0, 2.0, 4.0])], "k string, n int, t double")
    assert [g["t"] for g in runner.over_table(times, M.Newer(), "k", ["n"]).collect()] == [1, 3, 4]
    assert [g["t"] for g in playback.newer(times, "k", "n", "t").orderBy("n").collect()] == [1, 3, 4]


def test_idle_state_is_dropped(spark, tmp_path):
    import time

    schema = "k string, t double"
    spark.createDataFrame([("a", float(i)) for i in range(3)], schema).coalesce(1).write.parquet(str(tmp_path / "in"))
    files = spark.readStream.schema(schema).parquet(str(tmp_path / "in"))
    q = runner.over_stream(files, M.EveryNth(2), "k", ["t"], idle_ms=100).writeStream.format("memory").queryName("idle").option("checkpointLocation", str(tmp_path / "c")).outputMode("append").start()
    held = []
    until = time.time() + 60
    while time.time() < until and (not held or held[-1]):
        time.sleep(0.2)
        states = (q.lastProgress or {}).get("stateOperators") or []
        held += [states[0]["numRowsTotal"]] if states and (held or states[0]["numRowsTotal"]) else []
    spark.createDataFrame([("a", 9.0)], schema).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    time.sleep(1)
    while time.time() < until and not any(p["numInputRows"] == 1 for p in q.recentProgress):
        time.sleep(0.2)
    q.stop()
    assert held and held[-1] == 0
    assert [r["count"] for r in spark.table("idle").collect()] == [2]  # with the first state kept, the fourth row would pass too


def test_environments(spark):
    from stridelake.functions import images as I
    from stridelake.plans import environments as E

    frame = F.struct(F.lit(1).alias("h"), F.lit(2).alias("w"), F.lit(3).alias("c"), F.unhex(F.lit("010203040506")).alias("data"))
    df = spark.range(1).select("id", F.array(F.lit(1.0)).alias("state"), F.create_map(F.lit("top"), frame).alias("images"))
    shown = df.select(I.channels_first(F.col("images")["top"]).alias("d")).first()["d"]
    assert list(shown) == [1, 4, 2, 5, 3, 6]
    got = E.dual_arm_simulated().observations(df, "id").first()
    assert len(got["cam_high"]) == 3 * 224 * 224 and got["state"] == [1.0]
    with pytest.raises(Exception, match="observation unavailable"):
        E.dual_arm_real().observations(df).collect()
    actions = spark.createDataFrame([([0.0] * 15,)], "actions array<double>")
    with pytest.raises(Exception, match="16 dimensions"):
        E.two_hands("go").accepted(actions).collect()
    steps = spark.createDataFrame([("a", i, r, d, False) for i, (r, d) in enumerate([(-1.0, False), (2.0, True), (1.0, False)])], "k string, n int, reward double, terminated boolean, truncated boolean")
    rows = E.dual_arm_simulated().progress(steps, "k", "n").orderBy("n").collect()
    assert [(r["episode"], r["done"], r["episode_reward"]) for r in rows] == [(0, False, 0.0), (0, True, 2.0), (1, False, 1.0)]
    assert not any(r["done"] for r in E.dual_arm_real().progress(steps, "k", "n").collect())
