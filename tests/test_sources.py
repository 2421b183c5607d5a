import json

import numpy as np
import pytest
from pyspark.sql import functions as F

from stridelake.operators import stats
from stridelake.sources import codec, readers, writers


def test_episodes_round_trip(spark, tmp_path):
    steps = spark.createDataFrame([(e, s, [float(s)]) for e in range(3) for s in range(4)], "episode_id long, step int, action array<double>")
    path = str(tmp_path / "d")
    writers.write_episodes(steps, path, 50, per_chunk=2)
    assert readers.dataset_info(spark, path)["fps"] == 50
    assert readers.episodes(spark, path).select(steps.columns).exceptAll(steps).isEmpty()
    one = readers.replay(spark, path, 2, "action", 2)
    assert one.count() == 4 and "PartitionFilters: [isnotnull(episode_chunk" in one._jdf.queryExecution().executedPlan().toString()
    assert readers.dataset(spark, [path, path], 2).count() == 24
    with pytest.raises(ValueError):
        readers.dataset(spark, None, 2)


def test_fake_rows_do_not_depend_on_partitions(spark):
    a = readers.fake_rows(spark, 16, {"state": 24, "tokens": 48}, ["tokens"])
    b = readers.fake_rows(spark.newSession(), 16, {"state": 24, "tokens": 48}, ["tokens"]).repartition(5)
    assert a.exceptAll(b).isEmpty()
    r = a.first()
    assert len(r["state"]) == 24 and all(-1 <= v < 1 for v in r["state"]) and all(0 <= v < 2048 for v in r["tokens"])


def test_statistics_file(spark, tmp_path):
    df = spark.createDataFrame([([1.0, 2.0],), ([3.0, 5.0],)], "state array<double>")
    packed = stats.packed_statistics(stats.vector_statistics(df, ["state"]))
    writers.write_statistics(packed, str(tmp_path))
    assert readers.statistics(spark, str(tmp_path)).first()["mean"] == [2.0, 3.5]
    assert set(json.load(open(tmp_path / "norm_stats.json"))["norm_stats"]["state"]) == {"mean", "std", "q01", "q99"}
    assert readers.statistics(spark, str(tmp_path / "no"), strict=False) is None
    with pytest.raises(FileNotFoundError):
        readers.statistics(spark, str(tmp_path / "no"))


def test_ranges_and_annotations(spark, tmp_path):
    (tmp_path / "r.json").write_text(json.dumps({"f--a": [[0, 3], [5, 9]], "f--b": []}))
    got = readers.keep_ranges(spark, str(tmp_path / "r.json")).collect()
    assert sorted(map(tuple, got)) == [("f--a", 0, 3), ("f--a", 5, 9)]
    (tmp_path / "a.json").write_text(json.dumps({"7": {"language": "go"}}))
    assert readers.annotations(spark, str(tmp_path / "a.json")).first()["fields"] == {"language": "go"}


def test_append_new_is_resumable(spark, tmp_path):
    path = str(tmp_path / "t")
    assert writers.append_new(spark.range(5), path, "id") == 0
    assert writers.append_new(spark.range(8), path, "id") == 5
    assert spark.read.parquet(path).count() == 8


def test_small_sinks(spark, tmp_path):
    writers.replace_folder(spark.range(3), str(tmp_path / "x"))
    writers.replace_folder(spark.range(4), str(tmp_path / "x"))
    assert spark.read.parquet(str(tmp_path / "x")).count() == 4
    names = spark.createDataFrame([("out_3",), ("other",)], "name string")
    assert writers.next_index(names).first()["index"] == 4 and writers.next_index(names.where("false")).first()["index"] == 0
    writers.write_results(spark.createDataFrame([(1.0, 2, "v")], "success double, duration int, video_filename string"), str(tmp_path / "csv"))
    assert spark.read.csv(str(tmp_path / "csv"), header=True).columns == ["success", "duration", "video_filename"]
    assert writers.subsampled_frames(spark.range(10).withColumnRenamed("id", "step"), 4).count() == 3


@pytest.mark.parametrize("x", [np.float32(1.5), np.arange(6).reshape(1, 2, 3), np.array([np.nan, np.inf, -np.inf]), np.array(True), np.array(["a", "bc"]), np.zeros((0, 3))])
def test_codec_round_trip(x):
    back = codec.unpacked(codec.packed(x))
    assert back.dtype == np.asarray(x).dtype and back.shape == np.asarray(x).shape and np.array_equal(back, x, equal_nan=back.dtype.kind == "f")


def test_codec_rejects_and_columns(spark):
    with pytest.raises(ValueError):
        codec.packed(np.array([1j]))
    with pytest.raises(ValueError):
        codec.packed(np.array([object()]))
    df = spark.createDataFrame([([1.0, 2.0],)], "v array<double>")
    assert df.select(codec.to_vector(codec.from_vector(F.col("v"))).alias("v")).first()["v"] == [1.0, 2.0]


def test_stale_and_missing_library(spark):
    df = spark.createDataFrame([("a/x", "2025-01-01"), ("b", "2025-01-01")], "p string, m string")
    got = df.select(readers.stale(F.col("p"), F.to_timestamp("m"), [("a/.*", "2025-02-01")]).alias("s")).collect()
    assert [r["s"] for r in got] == [True, False]
    with pytest.raises(readers.MissingLibrary):
        readers.need("h5py_not_here")


def test_robot_rows_run_through_their_presets(spark):
    from stridelake.plans.presets import PRESETS

    for name, make in PRESETS.items():
        cfg = make()
        fed = cfg.training(readers.robot_rows(spark, name, 3, 2), skip_stats=True)
        row = fed.first()
        assert len(row["state"]) == 32 and [len(a) for a in row["actions"]] == [32, 32]
        assert len(cfg.reply(fed).first()["actions"]) == 2


def test_fetched(spark, tmp_path):
    (tmp_path / "a.txt").write_text("x")
    got = readers.fetched(spark, f"file://{tmp_path}/a.txt", str(tmp_path / "cache"))
    assert open(got.removeprefix("file:")).read() == "x"
    assert readers.fetched(spark, str(tmp_path / "a.txt"), "unused") == str(tmp_path / "a.txt")
    with pytest.raises(FileNotFoundError):
        readers.fetched(spark, str(tmp_path / "none"), "unused")
