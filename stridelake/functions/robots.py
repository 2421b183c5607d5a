"""Robot adapters: gripper curves, joint conventions, and the projections of each robot's rows."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stridelake.functions import vectors as V

# Fixed values of the robots' conventions.
FOURTEEN_SIGNS = (1, -1, -1, 1, 1, 1, 1, 1, -1, -1, 1, 1, 1, 1)
GRIPPERS_OF_14 = (6, 13)
LINEAR_CLOSED, LINEAR_OPEN = 0.01844, 0.05800
ARM_LENGTH, HORN_RADIUS = 0.036, 0.022
ANGLE_LOW, ANGLE_HIGH = 0.5476, 1.6296
JOINT_CLOSED, JOINT_OPEN = -0.6213, 1.4910
STATE_INDICES = (*range(0, 7), *range(8, 15))
ACTION_INDICES = (*range(0, 7), 39, *range(8, 15), 47)
CHASSIS_INDICES = (73, 74, 75)


def effort_to_trigger(e: Column) -> Column:
    """Second generation: effort to a trigger in [0, 1], zero effort at 0.10; not clipped."""
    return F.when(e > 0, (F.lit(1.0) - e / 2.0) * 0.10).otherwise(F.lit(0.10) - e * 0.90 / 1.6)


def trigger_to_effort(t: Column) -> Column:
    return F.when(t < 0.10, (F.lit(1.0) - t / 0.10) * 2.0).otherwise((t - 0.10) * -1.6 / 0.90)


def left_effort_to_unit(e: Column) -> Column:
    """First generation, left: effort to [0, 1] around 0.5."""
    return F.when(e > 0, F.lit(0.5) - e / 7.0).otherwise(F.lit(0.5) - e)


def right_effort_to_unit(e: Column) -> Column:
    return F.when(e < 0, e / 7.0 + 0.5).otherwise(e + 0.5)


def left_unit_to_effort(u: Column) -> Column:
    g = F.lit(0.5) - u
    return F.when(g > 0, g * 7.0).otherwise(g)


def right_unit_to_effort(u: Column) -> Column:
    g = u - 0.5
    return F.when(g < 0, g * 7.0).otherwise(g)


def published(t: Column) -> Column:
    """Clipped to [0, 1], as commands are sent."""
    return F.greatest(F.lit(0.0), F.least(F.lit(1.0), t))


def unit(x: Column, low: float, high: float) -> Column:
    return (x - low) / (high - low)


def from_unit(x: Column, low: float, high: float) -> Column:
    return x * (high - low) + low


def gripper_to_angle(x: Column) -> Column:
    """Unit linear gripper position to unit angle."""
    p = from_unit(x, LINEAR_CLOSED, LINEAR_OPEN)
    s = (F.lit(HORN_RADIUS**2 - ARM_LENGTH**2) + p * p) / (p * (2 * HORN_RADIUS))
    return unit(F.asin(F.greatest(F.lit(-1.0), F.least(F.lit(1.0), s))), ANGLE_LOW, ANGLE_HIGH)


def gripper_from_angle(x: Column) -> Column:
    return unit(x + ANGLE_LOW, JOINT_CLOSED, JOINT_OPEN)


def gripper_from_angle_inverse(x: Column) -> Column:
    return from_unit(x, JOINT_CLOSED, JOINT_OPEN) - ANGLE_LOW


def convert_joint(x: Column, position: tuple[float, float], joint: tuple[float, float], to_joint: bool = True) -> Column:
    """Between a gripper's position and joint ranges, each (closed, open)."""
    a, b = (position, joint) if to_joint else (joint, position)
    return from_unit(unit(x, *a), *b)


def _grippers(x: Column, f) -> Column:
    return F.transform(x, lambda v, i: F.when(i.isin(*GRIPPERS_OF_14), f(v)).otherwise(v))


def decode_state_14(x: Column, adapt: bool = True) -> Column:
    return _grippers(V.flip(x, FOURTEEN_SIGNS), gripper_to_angle) if adapt else x


def encode_actions_14(rows: Column, adapt: bool = True) -> Column:
    return F.transform(rows, lambda r: _grippers(V.flip(r, FOURTEEN_SIGNS), gripper_from_angle)) if adapt else rows


def encode_actions_14_inverse(rows: Column, adapt: bool = True) -> Column:
    return F.transform(rows, lambda r: _grippers(V.flip(r, FOURTEEN_SIGNS), gripper_from_angle_inverse)) if adapt else rows


def pick(x: Column, indices: Sequence[int]) -> Column:
    return F.array(*[F.get(x, F.lit(i)) for i in indices])


def binarise_gripper(row: Column, last: Column) -> Column:
    """The element at `last` becomes 1 above 0.5, else 0; all are clipped to [-1, 1]."""
    cut = lambda v, i: F.when(i == last, F.when(v > 0.5, 1.0).otherwise(0.0)).otherwise(v)
    return F.transform(row, lambda v, i: F.greatest(F.lit(-1.0), F.least(F.lit(1.0), cut(v, i))))


def camera_slots(df: DataFrame, slots: Mapping[str, str | None], blank: Column, always: Sequence[str] = ()) -> DataFrame:
    """Structs image and image_mask with a field per slot. A slot without a column, or with a null, gets the
    blank image and a false mask; slots in `always` have a true mask even so."""
    have = set(df.columns)
    image = [(F.coalesce(F.col(c), blank) if c in have else blank).alias(s) for s, c in slots.items()]
    mask = [(F.lit(True) if s in always else F.col(c).isNotNull() if c in have else F.lit(False)).alias(s) for s, c in slots.items()]
    return df.withColumn("image", F.struct(*image)).withColumn("image_mask", F.struct(*mask))


def check_cameras(columns: Sequence[str], allowed: Sequence[str], required: Sequence[str]) -> None:
    """Error on cameras that aren't allowed, or on required ones that are missing."""
    if odd := sorted(set(columns) - set(allowed)):
        raise ValueError(f"unexpected cameras {odd}; allowed are {list(allowed)}")
    if missing := sorted(set(required) - set(columns)):
        raise ValueError(f"missing cameras {missing}")


def first_dims(rows: Column, n: int) -> Column:
    """The first n dimensions of each action row."""
    return F.transform(rows, lambda r: F.slice(r, 1, n))


def arm_state(joints: Column, gripper: Column) -> Column:
    """Joints with a scalar gripper, or a one-element one, at the end."""
    return F.concat(joints, gripper)


def state_from_raw(raw: Column) -> Column:
    """The 14 joints of both arms out of a raw vector of blocks of 16."""
    return pick(raw, STATE_INDICES)


def hand_anchor(state: Column) -> Column:
    """The 14 joints at the places of the 16 action elements, with 0 for the grippers."""
    zero = V.vector([0.0])
    return F.concat(F.slice(state, 1, 7), zero, F.slice(state, 8, 7), zero)


def actions_from_raw(rows: Column, left, right) -> Column:
    """16 elements a row: both arms' joints, each followed by its gripper effort through a curve."""
    one = lambda r: F.transform(pick(r, ACTION_INDICES), lambda v, i: F.when(i == 7, left(v)).when(i == 15, right(v)).otherwise(v))
    return F.transform(rows, one)


def first_generation_actions(rows: Column) -> Column:
    return actions_from_raw(rows, left_effort_to_unit, right_effort_to_unit)


def first_generation_outputs(rows: Column) -> Column:
    return F.transform(rows, lambda r: F.transform(F.slice(r, 1, 16), lambda v, i: F.when(i == 7, left_unit_to_effort(v)).when(i == 15, right_unit_to_effort(v)).otherwise(v)))


def second_generation_actions(rows: Column, chassis: bool = False) -> Column:
    arms = actions_from_raw(rows, effort_to_trigger, effort_to_trigger)
    if not chassis:
        return arms
    short = F.exists(rows, lambda r: F.size(r) < 76)
    checked = F.when(short, F.raise_error(F.lit("chassis needs raw rows of 76 elements")).cast("array<array<double>>")).otherwise(arms)
    return F.zip_with(checked, rows, lambda a, r: F.concat(a, pick(r, CHASSIS_INDICES)))


def second_generation_outputs(rows: Column) -> Column:
    return F.transform(rows, lambda r: F.transform(F.slice(r, 1, 19), lambda v, i: F.when((i == 7) | (i == 15), trigger_to_effort(v)).otherwise(v)))


def assemble_48(position: Column, velocity: Column, effort: Column) -> Column:
    """Raw 48: positions, velocities and efforts of 7 joints of each arm in blocks of 8 whose last element is 0;
    short messages are padded with zeros."""
    block = lambda x: F.concat(F.slice(V.pad_to(x, 14), 1, 7), V.vector([0.0]), F.slice(V.pad_to(x, 14), 8, 7), V.vector([0.0]))
    return F.concat(block(position), block(velocity), block(effort))


def assemble_arms(raw: Column, gripper) -> Column:
    """Per arm 6 joints and its gripper (raw index 7 of 9) through a function: 14 elements of 18."""
    arm = lambda start: F.concat(F.slice(raw, start + 1, 6), F.array(gripper(F.get(raw, F.lit(start + 7)))))
    return F.concat(arm(0), arm(9))

