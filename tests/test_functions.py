import math

import numpy as np
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stridelake.functions import control as C
from stridelake.functions import images as I
from stridelake.functions import robots as R
from stridelake.functions import text as X
from stridelake.functions import vectors as V


@pytest.fixture(scope="module")
def one(spark):
    row = spark.range(1)
    return lambda c: row.select(c.alias("v")).first()["v"]


def rows(*rs):
    return F.array(*[V.vector(r) for r in rs])


def test_deltas(one):
    state, actions = V.vector([1, 2, 3]), rows([3, 4, 5], [5, 6, 7])
    assert one(V.delta_rows(actions, state, [False, True])) == [[3, 2, 5], [5, 4, 7]]
    assert one(V.absolute_rows(actions, state, [False, True])) == [[3, 6, 5], [5, 8, 7]]
    assert one(V.delta_rows(actions, state, None)) == [[3, 4, 5], [5, 6, 7]]
    assert one(V.delta_anchor(V.vector([1, 2, 3, 4, 5]), V.bool_mask(3, -2))) == [1, 2, 3, 0, 0]
    assert one(V.delta_anchor(state, None)) is None
    assert one(V.reanchor(actions, F.lit(1), V.vector([10, 10]), V.vector([1, 2]))) == [[12, 12, 5], [5, 6, 7]]


def test_masks():
    assert V.bool_mask(2, -2, 2) == [True, True, False, False, True, True]
    assert V.bool_mask(2, 0, 2) == [True] * 4


def test_scaling_round_trips_and_extra_dimensions(one):
    x, mean, std = V.vector([1, 2, 3]), V.vector([0.5, 1]), V.vector([2, 3])
    assert one(V.inverse_zscore(V.vector([1, 1, 1]), mean, std)) == pytest.approx([2.5 + 1e-6, 4 + 1e-6, 1 + 1e-6])
    assert one(V.inverse_quantile_scale(V.vector([0, 0, 7]), V.vector([0, 2]), V.vector([2, 4]))) == pytest.approx([1, 3, 7], abs=1e-5)
    full = V.vector([0.1, 0.2, 0.3]), V.vector([3, 4, 5])
    assert one(V.inverse_zscore(V.zscore(x, *full), *full)) == pytest.approx([1, 2, 3])
    assert one(V.inverse_quantile_scale(V.quantile_scale(x, *full), *full)) == pytest.approx([1, 2, 3])
    with pytest.raises(ValueError, match="q99"):
        V.require_quantiles(["mean", "q01"])


def test_padding_never_cuts(one):
    assert one(V.pad_to(V.vector([1, 2]), 4)) == [1, 2, 0, 0]
    assert one(V.pad_to(V.vector([1, 2, 3]), 2)) == [1, 2, 3]
    assert one(V.every_nth(V.vector(range(7)), 3)) == [0, 3, 6]


def test_discretise_edges(one):
    got = one(V.discretise(V.vector([-1.5, -1, -0.99, 0, 0.999, 1, 7, float("nan")])))
    edges = np.linspace(-1, 1, 257)[:-1]
    want = (np.digitize([-1.5, -1, -0.99, 0, 0.999, 1, 7], edges) - 1).tolist()
    assert got == [*want, 255] and got[0] == -1


def test_alignment_and_masks(one):
    valid = F.array(*[F.lit(v) for v in (True, True, False, False)])
    assert one(V.align_right(V.vector([1, 2, 3, 4]), valid)) == [3, 4, 1, 2]
    assert one(V.token_positions(valid)) == [0, 1, 1, 1]
    starts = F.array(F.lit(True), F.lit(False), F.lit(True))
    ok = F.array(F.lit(True), F.lit(True), F.lit(True))
    assert one(V.attention_allowed(ok, starts)) == [[True, True, False], [True, True, False], [True, True, True]]


def test_small_vector_functions(one):
    a, b = V.vector([0, 0]), V.vector([1, 2])
    assert one(V.ramp(a, b, F.lit(0.5))) == [0.5, 1] and one(V.ramp(a, b, F.lit(9.0))) == [1, 2]
    assert one(V.linspace(F.lit(0.0), F.lit(1.0), 3)) == [0, 0.5, 1]
    assert one(V.proportional(b, a, 10, V.vector([1, 100]))) == [0.3, 20]
    assert one(V.clamp(V.vector([5, -5]), V.vector([-1, -1]), V.vector([1, 1]))) == [1, -1]
    assert one(V.clamped_at(V.vector([5, 0]), V.vector([-1, -1]), V.vector([1, 1]))) == [0]
    assert one(V.largest_error(a, b)) == 2 and one(V.argmax(b)) == 1 and one(V.norm(V.vector([3, 4]))) == 5
    assert one(V.put_at(b, F.lit(0), F.lit(9.0))) == [9, 2]
    assert one(V.moving_average(V.vector([1, 3]), 0.5)) == 2
    assert one(V.quaternion_to_axis_angle(V.vector([0, 0, 0, 1]))) == [0, 0, 0]
    assert one(V.quaternion_to_axis_angle(V.vector([math.sin(0.5), 0, 0, math.cos(0.5)]))) == pytest.approx([1, 0, 0])
    with pytest.raises(ValueError):
        V.sincos_embedding(F.lit(1.0), 3, 1, 2)


def test_gripper_round_trips(one):
    for e in (-1.6, -0.4, 0.0, 0.7, 2.0):
        assert one(R.trigger_to_effort(R.effort_to_trigger(F.lit(e)))) == pytest.approx(e, abs=1e-9)
        assert one(R.left_unit_to_effort(R.left_effort_to_unit(F.lit(e)))) == pytest.approx(e, abs=1e-9)
        assert one(R.right_unit_to_effort(R.right_effort_to_unit(F.lit(e)))) == pytest.approx(e, abs=1e-9)
    assert one(R.effort_to_trigger(F.lit(2.0))) == 0 and one(R.effort_to_trigger(F.lit(-1.6))) == pytest.approx(1)


def test_dual_arm_round_trip(one):
    a = rows([0.1 * i for i in range(14)])
    assert one(R.encode_actions_14(R.encode_actions_14_inverse(a))) == [pytest.approx([0.1 * i for i in range(14)])]
    assert one(R.decode_state_14(V.vector(range(14)), adapt=False)) == list(range(14))


def test_two_hands(one):
    raw = rows(range(76))
    got = one(R.second_generation_actions(raw, chassis=True))[0]
    assert got[:7] == list(range(7)) and got[8:15] == list(range(8, 15)) and got[16:] == [73, 74, 75]
    assert got[7] == pytest.approx(0.1 * (1 - 39 / 2))
    with pytest.raises(Exception, match="76"):
        one(R.second_generation_actions(rows(range(48)), chassis=True))
    assert len(one(R.assemble_48(V.vector([1] * 14), V.vector([2]), V.vector([])))) == 48
    with pytest.raises(ValueError, match="unexpected"):
        R.check_cameras(["a", "b"], ["a"], [])


@pytest.mark.parametrize(("schedule", "want"), [("linear", [1, 1, 1, 0.8, 0.6, 0.4, 0.2, 0, 0, 0, 0, 0]), ("ones", [1] * 7 + [0] * 5), ("zeros", [1] * 3 + [0] * 9)])
def test_prefix_weights(one, schedule, want):
    assert one(C.prefix_weights(F.lit(3), F.lit(7), 12, schedule)) == pytest.approx(want)


def test_prefix_weights_exp_and_degenerate(one):
    linear, expo = (one(C.prefix_weights(F.lit(3), F.lit(7), 12, s)) for s in ("linear", "exp"))
    assert expo[2] == 1 and expo[7] == 0 and all(e < x for e, x in zip(expo[3:7], linear[3:7], strict=True))
    for s, e in ((0, 0), (5, 5), (12, 12), (9, 4), (20, 30)):
        w = one(C.prefix_weights(F.lit(s), F.lit(e), 12, "linear"))
        assert len(w) == 12 and all(0 <= x <= 1 for x in w) and w == sorted(w, reverse=True)


def test_guidance_and_delays(one):
    g = lambda t, m=10: one(C.guidance_weight(F.lit(t), m))
    assert g(0.5) == 2 and g(0.3) == pytest.approx(g(0.7)) and g(1.0) == 10 and g(0.001) == 10
    d = C.delay_steps(F.lit(0.120 * 20), 1, F.lit(30))
    assert one(d) == 4 and one(C.execution_horizon(d, 2, 1, F.lit(30))) == 8
    assert one(C.delay_steps(F.lit(4.0000000001), 0, F.lit(30))) == 4


def test_text(one):
    assert one(X.clean_prompt(F.lit("\n Pick_up\nit "))) == "Pick up it"
    assert one(X.clean_prompt_lower(F.lit(" Pick_up\nit "))) == "pick up\nit"
    assert one(X.prompt_with_state(F.lit("p"), F.array(F.lit(1), F.lit(2)))) == "Task: p, State: 1 2;\nAction: "
    assert one(X.action_text(F.lit("x Action: 1 2 |z"))) == "1 2" and one(X.action_text(F.lit("none"))) is None
    assert one(X.decode_bins(F.array(F.lit(0)), 256, 2, 1)) == [[0.0], [0.0]]
    assert one(X.decode_bins(F.array(F.lit(0), F.lit(128)), 256, 2, 1)) == [[-1.0], [0.0]]
    assert one(X.episode_id(F.lit("metadata_ab_12.json"))) == "12"
    assert [one(X.success_value(F.lit(v))) for v in ("y", "N", "50", "101", "x")] == [1.0, 0.0, 0.5, None, None]
    assert one(X.outcome_name(F.lit("pick it up"), F.lit(False))) == "pick_it_up_failure"
    assert one(X.next_tokens(F.array(F.lit(1), F.lit(2)))) == [2]
    p = one(X.padded_tokens(F.array(F.lit(7), F.lit(8), F.lit(9)), 2))
    assert p["ids"] == [7, 8] and p["mask"] == [True, True]


def test_images(spark):
    x = np.arange(10 * 10 * 3, dtype=np.uint8).reshape(10, 10, 3)
    df = spark.createDataFrame([I.image(x), I.image(np.zeros((30, 20, 3), np.uint8))], I.IMAGE)
    c = F.struct("h", "w", "c", "data")
    small = [I.pixels(r["v"].asDict()) for r in df.select(I.resize_with_pad(c, 20, 20).alias("v")).collect()]
    assert [s.shape for s in small] == [(20, 20, 3)] * 2 and not small[1].any()
    assert (I.pixels(df.select(I.turned(c).alias("v")).first()["v"].asDict()) == x[::-1, ::-1]).all()
    assert I.fitted_size(256, 320, 60, 80) == (60, 75, 0, 2)
    assert I.parsed(np.ones((3, 4, 5))).shape == (4, 5, 3)
    wide = np.zeros((2, 4, 3), np.uint8)
    assert I.left_of_stereo(wide).shape == (2, 2, 3) and I.left_of_stereo(wide[:, :3]).shape == (2, 3, 3)
    boxes = spark.range(1).select(I.view_boxes(F.lit(1280), F.lit(1360)).alias("b")).first()["b"]
    assert {k: tuple(v) for k, v in boxes.items()} == {k: I.box_pixels(b, 1280, 1360) for k, b in I.VIEWS.items()}
    assert spark.range(1).select(I.blank(2, 3).alias("b")).first()["b"]["data"] == bytes(18)


def test_resizing_against_sums_pixel_by_pixel():
    rng = np.random.default_rng(3)
    x = rng.integers(0, 256, (9, 14, 3), dtype=np.uint8)

    def line(v, n, kernel):
        reach, curve = I.KERNELS[kernel]
        out, scale = [], len(v) / n
        wide = max(scale, 1)
        for i in range(n):
            centre = (i + 0.5) * scale
            at = range(max(0, int(centre - reach * wide + 0.5)), min(len(v), int(centre + reach * wide + 0.5)))
            share = [float(curve(np.array((j + 0.5 - centre) / wide))) for j in at]
            out.append(min(255, max(0, int(np.floor(sum(s * float(v[j]) for s, j in zip(share, at, strict=True)) / sum(share) + 0.5)))))
        return out

    for kernel in I.KERNELS:
        for h, w in ((4, 5), (20, 31), (9, 6), (13, 14), (1, 1)):
            across = np.array([[line(x[r, :, c], w, kernel) for c in range(3)] for r in range(9)]).transpose(0, 2, 1)
            want = np.array([[line(across[:, q, c], h, kernel) for c in range(3)] for q in range(w)]).transpose(2, 0, 1)
            assert np.abs(I.resized(x, h, w, kernel).astype(int) - want).max() <= 1
        assert (I.resized(np.full((7, 5, 3), 200, np.uint8), 180, 320, kernel) == 200).all()
        assert I.resized(x, 9, 14, kernel) is x


def test_augmentation(spark):
    rng = np.random.default_rng(4)
    x = rng.integers(0, 256, (12, 16, 3), dtype=np.uint8)
    assert (I.rotated(x, 0) == x).all() and (I.rotated(x[:12, :12], 90) == np.rot90(x[:12, :12], -1)).all()
    middle = np.array([0.5, 0.5, 0.5, 0.5, 0.5, 0.5])
    assert (I.varied(x, middle, wrist=True) == x).all()
    df = spark.createDataFrame([(k, I.image(x)) for k in range(6)], T.StructType([T.StructField("k", T.IntegerType()), T.StructField("v", I.IMAGE)]))
    one, other = ([r["v"]["data"] for r in d.select("k", I.augmented(F.col("v"), False, 5, "k").alias("v")).orderBy("k").collect()] for d in (df, df.repartition(3)))
    assert one == other and len(set(one)) == 6 and all(len(d) == x.size for d in one)


def test_token_ids(spark):
    import os

    from stridelake.functions.tokenizers import encoder, token_ids
    from stridelake.plans.pipeline import prompt_tokens

    paths = ["/opt/tokenizers/word_bpe_49k.json", "/opt/tokenizers/piece_bpe_32k.model"]
    if not all(map(os.path.exists, paths)):
        pytest.skip("no vocabularies here")
    df = spark.createDataFrame([("pick_up the cup ",), ("",), (None,)], "prompt string")
    for path in paths:
        encode = encoder(path.rsplit(".", 1)[-1], open(path, "rb").read())
        assert [r[0] for r in df.select(token_ids(spark, path)(F.col("prompt"))).collect()] == encode(["pick_up the cup ", "", ""])
        row = prompt_tokens(token_ids(spark, path), 12, begin=2)(df).first()
        want = [2, *encode(["pick up the cup\n"])[0]]
        assert row["tokenized_prompt"] == want + [0] * (12 - len(want)) and row["tokenized_prompt_mask"] == [k < len(want) for k in range(12)]
    with pytest.raises(ValueError):
        encoder("txt", b"")
