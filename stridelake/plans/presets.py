"""Presets of robots: their projections as Groups. Names say what a robot has."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import functions as F

from stridelake.functions import robots as R
from stridelake.functions import vectors as V
from stridelake.plans.pipeline import DataConfig, Group, absolute_actions, delta_actions, padded


MASK = V.bool_mask(7, -1, 7, -1)


def _state(fn):
    return lambda df: df.withColumn("state", fn(F.col("state")))


def _actions(fn):
    return lambda df: df.withColumn("actions", fn(F.col("actions"))) if "actions" in df.columns else df


def dual_arm_14(adapt: bool = True, delta: bool = True) -> Group:
    """Two arms of 6 joints and a gripper each."""
    g = Group((_state(lambda x: R.decode_state_14(x, adapt)), _actions(lambda a: R.encode_actions_14_inverse(a, adapt))), (_actions(lambda a: R.encode_actions_14(R.first_dims(a, 14), adapt)),))
    mask = V.bool_mask(6, -1, 6, -1)
    return g.push([delta_actions(mask)], [absolute_actions(mask)]) if delta else g


def single_arm(joints: int, dims: int, delta: bool = False) -> Group:
    """joints and gripper columns make the state; the first dims of an action are the robot's."""
    start = lambda df: df.withColumn("state", R.arm_state(F.col("joints"), F.col("gripper"))) if "joints" in df.columns else df
    g = Group((start,), (_actions(lambda a: R.first_dims(a, dims)),))
    mask = V.bool_mask(joints, -1)
    return g.push([delta_actions(mask)], [absolute_actions(mask)]) if delta else g


def _hands(curves_in, curves_out, delta: bool) -> Group:
    """State of 14 joints; actions of both hands' 7 joints and gripper each. With delta the joints (not the
    grippers) are taken relative to the state before scaling, and made absolute again before the curves."""

    def start(df):
        df = df.withColumn("state", R.state_from_raw(F.col("state")))
        if "actions" not in df.columns:
            return df
        df = df.withColumn("actions", curves_in(F.col("actions")))
        return df.withColumn("actions", V.delta_rows(F.col("actions"), R.hand_anchor(F.col("state")), MASK)) if delta else df

    def end(df):
        if "actions" not in df.columns:
            return df
        if delta:
            df = df.withColumn("actions", V.absolute_rows(F.col("actions"), R.hand_anchor(F.col("state")), MASK))
        return df.withColumn("actions", curves_out(F.col("actions")))

    return Group((start,), (end,))


def two_hands_first(delta: bool = False) -> Group:
    """Raw vectors of 48: positions, velocities, efforts; each hand's effort on its own curve."""
    return _hands(R.first_generation_actions, R.first_generation_outputs, delta)


def two_hands_second(chassis: bool = False, delta: bool = False) -> Group:
    """Raw vectors of 62 or more; one curve for both hands; three chassis velocities if asked for."""
    return _hands(lambda a: R.second_generation_actions(a, chassis), R.second_generation_outputs, delta)


def config(data: Group, dim: int = 32, extra: Sequence = ()) -> DataConfig:
    """The robot's transforms with the model's padding."""
    return DataConfig(data=data, model=Group((*extra, padded(dim))))


PRESETS = {
    "dual_arm_14": lambda: config(dual_arm_14()),
    "single_arm_8": lambda: config(single_arm(7, 8)),
    "single_arm_7": lambda: config(single_arm(6, 7, delta=True)),
    "two_hands_first": lambda: config(two_hands_first()),
    "two_hands_second": lambda: config(two_hands_second()),
}
