import numpy as np
import pytest
from pyspark.sql import functions as F

from stridelake.functions import vectors as V
from stridelake.operators import filters, joins, sampling, sets, stats, windows
from stridelake.operators import projections as P
from stridelake.plans import pipeline, presets


def idle_ranges(idle, min_idle, min_active, drop):
    keep, n, i = np.ones(len(idle), bool), len(idle), 0
    while i < n:
        j = i
        while j < n and idle[j] == idle[i]:
            j += 1
        if idle[i] and j - i >= min_idle:
            keep[i:j] = False
        i = j
    out, i = [], 0
    while i < n:
        j = i
        while j < n and keep[j] == keep[i]:
            j += 1
        if keep[i] and j - i >= min_active:
            out.append((i, j - drop))
        i = j
    return out


def test_active_ranges_against_numpy(spark):
    rng = np.random.default_rng(4)
    lengths = [1, 6, 7, 15, 16, 17, 40, 160, 90, 33]
    episodes = {e: rng.random(n) < 0.6 for e, n in enumerate(lengths)} | {20: np.ones(30, bool), 21: np.zeros(30, bool)}
    rows = [(e, s, bool(v)) for e, x in episodes.items() for s, v in enumerate(x)]
    df = spark.createDataFrame(rows, "e long, step int, idle boolean")
    got = {}
    for r in windows.active_ranges(df, "e", "step", "idle").collect():
        got.setdefault(r["e"], []).append((r["start"], r["end"]))
    assert {e: sorted(v) for e, v in got.items()} == {e: w for e, x in episodes.items() if (w := idle_ranges(x, 7, 16, 10))}


def test_first_step_is_never_idle(spark):
    df = spark.createDataFrame([(0, 0, [1.0]), (0, 1, [1.0005]), (0, 2, [2.0])], "e int, step int, v array<double>")
    out = df.withColumn("idle", filters.idle(F.col("v"), F.col("step"), F.col("e"))).orderBy("step")
    assert [r["idle"] for r in out.collect()] == [False, True, False]


@pytest.mark.parametrize("n", [1, 3, 5])
def test_chunks_repeat_the_last_row(spark, n):
    df = spark.createDataFrame([(0, i, float(i)) for i in range(n)], "e int, step int, a double")
    for r in windows.chunked(df, "e", ["step"], "a", 3).collect():
        assert r["actions"] == [min(r["step"] + k, n - 1) for k in range(3)]
        assert r["is_pad"] == [r["step"] + k >= n for k in range(3)]


def test_statistics_do_not_depend_on_partitions(spark):
    x = np.arange(12.0).reshape(4, 3)
    df = spark.createDataFrame([(r.tolist(),) for r in x], "v array<double>")
    for parts in (1, 4):
        got = {r["dim"]: r for r in stats.vector_statistics(df.repartition(parts), ["v"]).collect()}
        assert [got[d]["mean"] for d in range(3)] == [4.5, 5.5, 6.5]
        assert got[0]["std"] == pytest.approx(11.25**0.5) and got[1]["q99"] == pytest.approx(np.quantile(x[:, 1], 0.99))
    with pytest.raises(Exception, match="two rows"):
        stats.packed_statistics(stats.vector_statistics(df.limit(1), ["v"])).collect()


@pytest.mark.parametrize("bins", [1, 7, 4096])
def test_refined_quantiles_are_exact(spark, bins):
    rng = np.random.default_rng(5)
    groups = {0: rng.normal(size=500), 1: np.round(rng.normal(size=300), 1), 2: np.array([3.0]), 3: np.full(50, 2.5), 4: np.array([1.0, 2.0])}
    df = spark.createDataFrame([(g, float(v)) for g, x in groups.items() for v in x] + [(0, None)], "g int, x double")
    got = {r["g"]: r["q"] for r in stats.refined_quantiles(df, ["g"], "x", (0.01, 0.5, 0.99), bins).collect()}
    assert all(got[g] == pytest.approx(np.quantile(x, [0.01, 0.5, 0.99])) for g, x in groups.items())


def test_statistics_methods_agree(spark):
    rng = np.random.default_rng(6)
    df = spark.createDataFrame([(rng.normal(size=3).tolist(),) for _ in range(200)], "v array<double>")
    a, b = ({r["dim"]: r for r in stats.vector_statistics(df, ["v"], m).collect()} for m in ("exact", "refined"))
    assert all(a[d]["q01"] == pytest.approx(b[d]["q01"]) and a[d]["q99"] == pytest.approx(b[d]["q99"]) for d in range(3))


def test_weights_equal_exploded_chunks(spark):
    for length in (1, 2, 5, 9):
        for horizon in (1, 3, 6):
            counts = np.zeros(length)
            for t in range(length):
                for k in range(horizon):
                    counts[min(t + k, length - 1)] += 1
            df = spark.range(length).select(stats.chunk_weights(F.lit(length), F.col("id"), horizon).alias("w")).collect()
            assert [r["w"] for r in df] == counts.tolist()


def test_repack_rename_and_conflicts(spark):
    df = P.unflatten(spark.createDataFrame([(1, 2)], "`b/c` int, `e/f` int"))
    assert P.repack(df, {"a": {"b": "b/c"}, "d": "e/f"}).first().asDict(True) == {"a": {"b": 1}, "d": 2}
    with pytest.raises(Exception):
        P.repack(df, {"x": "b/nope"}).collect()
    ab = P.unflatten(spark.createDataFrame([(1, 2)], "`a/b` int, `a/c` int"))
    assert P.rename_by_pattern(ab, {"a/b": "a/c", "a/c": None}).first().asDict(True) == {"a": {"c": 1}}
    with pytest.raises(ValueError, match="Key 'a/c' already exists in output"):
        P.rename_by_pattern(ab, {"a/b": "a/c"})
    assert P.rename_by_pattern(ab, {"a": None}).first().asDict(True) == {"a": {"b": 1, "c": 2}}
    abc = P.unflatten(spark.createDataFrame([(1, 2, 3)], "`a/b` int, `a/c` int, `b/c` int"))
    assert P.rename_by_pattern(abc, {"(.+)/c": r"\1/d"}).first().asDict(True) == {"a": {"b": 1, "d": 2}, "b": {"d": 3}}
    assert P.flatten(ab).columns == ["a/b", "a/c"]
    assert P.with_default(df, "prompt", "go").first()["prompt"] == "go"
    assert P.apply_to_leaves(ab, ["a/b"], lambda c: c + 1).first().asDict(True) == {"a": {"b": 2, "c": 2}}
    with pytest.raises(ValueError):
        P.apply_to_leaves(ab, ["a/x"], lambda c: c, strict=True)


def test_task_prompts(spark):
    tasks = spark.createDataFrame([(1, "Hello, world!")], "task_index int, prompt string")
    steps = spark.createDataFrame([(1,)], "task_index int")
    assert joins.task_prompts(steps, tasks).first()["prompt"] == "Hello, world!"
    with pytest.raises(Exception, match="task_index=2 not found in task mapping"):
        joins.task_prompts(spark.createDataFrame([(2,)], "task_index int"), tasks).collect()


def test_lookups(spark):
    steps = spark.createDataFrame([("a", i) for i in range(6)], "episode_id string, step int")
    ranges = spark.createDataFrame([("a", 1, 3), ("a", 2, 4)], "episode_id string, start long, end long")
    assert sorted(r["step"] for r in joins.kept_steps(steps, ranges).collect()) == [1, 2, 3]
    assert joins.kept_steps(steps, None).count() == 6
    with pytest.raises(ValueError, match="did you mean 'single_arm_8'"):
        joins.config_named("single_arm8", presets.PRESETS)
    with pytest.raises(ValueError, match="unique"):
        stats.require_unique(steps, "episode_id")
    frames = spark.createDataFrame([("a", 0, "l", "x"), ("a", 0, "r", "y"), ("a", 1, "l", "z")], "episode_id string, step int, camera string, frame string")
    assert [(r["step"], r["l"], r["r"]) for r in joins.camera_frames(steps, frames, ["l", "r"]).collect()] == [(0, "x", "y")]


def test_samples_and_batches(spark):
    df = spark.range(100)
    a = sampling.batched(df.repartition(3), 8, 1, ["id"], shards=1).collect()
    b = sampling.batched(df.repartition(7), 8, 1, ["id"], shards=1).collect()
    assert {tuple(r) for r in a} == {tuple(r) for r in b} and len(a) == 96
    shares = [sampling.rank_share(df, 4, r, 1, 0, "id").count() for r in range(4)]
    assert sum(shares) == 100 and min(shares) > 10
    drawn = {r["c"] for r in df.select(sampling.categorical(V.vector([5, 0, 0]), 1.0, 3, "id").alias("c")).collect()}
    assert 0 in drawn


def test_sets(spark):
    a, b = spark.range(5), spark.range(7)
    both = sets.concatenated([a, b])
    assert both.count() == 12 and both.where("dataset_id = 1").count() == 7
    assert sets.equal_tables(a, spark.range(5)) and not sets.equal_tables(a, b)
    with pytest.raises(ValueError):
        sets.concatenated([])


def test_filters(spark):
    df = spark.createDataFrame([({"a_left": 1, "a_right": 2, "a_left_depth": 3},)], "m map<string,int>")
    got = df.select(filters.without_depth(F.col("m")).alias("d"), filters.camera_of(F.col("m"), "a_left").alias("c")).first()
    assert set(got["d"]) == {"a_left", "a_right"} and got["c"] == 3
    with pytest.raises(Exception, match="too small"):
        filters.required(spark.range(2), F.col("id") > 5, "too small").collect()
    with pytest.raises(ValueError):
        filters.divisible_batch(10, 4)


def test_arrays_of_different_lengths_are_errors(spark):
    df = spark.createDataFrame([(0, [1, 2], [1])], "e int, a array<int>, b array<int>")
    with pytest.raises(Exception, match="different lengths"):
        windows.steps_from_arrays(df, ["a", "b"]).collect()


def test_group_order_and_round_trip(spark):
    add = lambda n: lambda df: df.withColumn("log", F.concat("log", F.lit(n)))
    g = pipeline.Group((add("a"),), (add("x"),)).push([add("b")], [add("y")])
    df = spark.createDataFrame([("",)], "log string")
    assert pipeline.composed(g.inputs)(df).first()["log"] == "ab" and pipeline.composed(g.outputs)(df).first()["log"] == "yx"
    with pytest.raises(ValueError, match="statistics"):
        pipeline.DataConfig().training(df)


@pytest.mark.parametrize("name", ["two_hands_first", "two_hands_second"])
@pytest.mark.parametrize("delta", [False, True])
def test_robot_presets_give_the_raw_actions_back(spark, name, delta):
    raw = [0.01 * i for i in range(62)]
    df = spark.createDataFrame([(raw, [raw])], "state array<double>, actions array<array<double>>")
    cfg = presets.config(getattr(presets, name)(delta=delta))
    fed = cfg.training(df, skip_stats=True)
    assert len(fed.first()["actions"][0]) == 32
    got = cfg.reply(fed).first()["actions"][0]
    want = [raw[i] for i in (*range(7), 39, *range(8, 15), 47)]
    assert got[:16] == pytest.approx(want)


def test_dual_arm_preset_round_trip(spark):
    df = spark.createDataFrame([([0.1] * 14, [[0.2] * 14])], "state array<double>, actions array<array<double>>")
    s = {"state": {"mean": [0.0] * 14, "std": [2.0] * 14}, "actions": {"mean": [0.5] * 14, "std": [3.0] * 14}}
    cfg = pipeline.DataConfig(data=presets.dual_arm_14(), stats=s)
    assert cfg.reply(cfg.training(df)).first()["actions"][0] == pytest.approx([0.2] * 14)
