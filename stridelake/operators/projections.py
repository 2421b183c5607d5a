"""Projections: repacking nested rows, renaming by pattern, defaults, restructuring."""

from __future__ import annotations

import re
from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def paths(schema: T.StructType, prefix: str = "") -> list[str]:
    """`/`-separated path of every leaf of nested structs."""
    out: list[str] = []
    for f in schema.fields:
        p = f"{prefix}{f.name}"
        out += paths(f.dataType, f"{p}/") if isinstance(f.dataType, T.StructType) else [p]
    return out


def path_column(path: str) -> Column:
    head, *rest = path.split("/")
    c = F.col(f"`{head}`")
    for name in rest:
        c = c.getField(name)
    return c


def flatten(df: DataFrame) -> DataFrame:
    """One column per leaf, named by its path."""
    return df.select(*[path_column(p).alias(p) for p in paths(df.schema)])


def _nest(tree: Mapping[str, object]) -> list[Column]:
    return [(F.struct(*_nest(v)) if isinstance(v, Mapping) else v).alias(k) for k, v in tree.items()]


def _tree(columns: Sequence[tuple[str, Column]]) -> dict:
    tree: dict = {}
    for path, c in columns:
        *inner, leaf = path.split("/")
        at = tree
        for name in inner:
            at = at.setdefault(name, {})
            if not isinstance(at, dict):
                raise ValueError(f"{path}: {name} is a leaf already")
        if leaf in at:
            raise ValueError(f"Key '{path}' already exists in output" if not isinstance(at[leaf], dict) else f"{path} is a node already")
        at[leaf] = c
    return tree


def unflatten(df: DataFrame) -> DataFrame:
    """Nested structs out of columns named by path."""
    return df.select(*_nest(_tree([(c, F.col(f"`{c}`")) for c in df.columns])))


def repack(df: DataFrame, structure: Mapping[str, object]) -> DataFrame:
    """A new row of source paths; whatever isn't listed is dropped, a missing path is an analysis error."""

    def build(tree: Mapping[str, object]) -> dict:
        return {k: build(v) if isinstance(v, Mapping) else path_column(str(v)) for k, v in tree.items()}

    return df.select(*_nest(build(structure)))


def rename_by_pattern(df: DataFrame, patterns: Mapping[str, str | None]) -> DataFrame:
    """Leaves renamed (or dropped: None) by the first pattern that matches their whole path; replacements may
    refer to groups. Two leaves of one name, or a leaf where a node is, are errors."""
    kept: list[tuple[str, Column]] = []
    for path in paths(df.schema):
        target: str | None = path
        for pattern, replacement in patterns.items():
            if re.fullmatch(pattern, path):
                target = None if replacement is None else re.sub(pattern, replacement, path, count=1)
                break
        if target is not None:
            kept.append((target, path_column(path)))
    return df.select(*_nest(_tree(kept)))


def apply_to_leaves(df: DataFrame, wanted: Sequence[str], fn: Callable[[Column], Column], strict: bool = False) -> DataFrame:
    """fn on the leaves whose paths are wanted; with strict, a wanted path that is missing is an error."""
    have = paths(df.schema)
    if strict and (missing := sorted(set(wanted) - set(have))):
        raise ValueError(f"missing {missing}")
    return df.select(*_nest(_tree([(p, fn(path_column(p)) if p in wanted else path_column(p)) for p in have])))


def without_strings(df: DataFrame) -> DataFrame:
    return df.drop(*[f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)])


def with_default(df: DataFrame, name: str, value: str) -> DataFrame:
    """The column where it is missing or null: the value."""
    return df.withColumn(name, F.coalesce(F.col(name), F.lit(value)) if name in df.columns else F.lit(value))


def without_prefix(df: DataFrame, prefix: str) -> DataFrame:
    """Without the columns whose names begin with the prefix."""
    return df.drop(*[c for c in df.columns if c.startswith(prefix)])


def spread(df: DataFrame, column: str, names: Sequence[str]) -> DataFrame:
    """Elements of a vector as columns of their own."""
    rest = [F.col(f"`{c}`") for c in df.columns if c != column]
    return df.select(*rest, *[F.get(F.col(column), F.lit(i)).alias(n) for i, n in enumerate(names)])


def describe(schema: T.StructType) -> str:
    """`path: type` of every leaf, a line each."""
    flat = {}
    for p in paths(schema):
        t: T.DataType = schema
        for name in p.split("/"):
            t = t[name].dataType  # type: ignore[index]
        flat[p] = t.simpleString()
    return "\n".join(f"{p}: {t}" for p, t in flat.items())


def restructure_steps(df: DataFrame, action: str, gripper: str, observation: Mapping[str, str], prompt: Column, ids: tuple[str, str]) -> DataFrame:
    """Rows per step for training: actions with the gripper at the end, a nested observation, the prompt, and
    step_id of folder, file and step."""
    return df.select(
        F.concat(F.col(action), F.col(gripper)).alias("actions"),
        F.struct(*[F.col(v).alias(k) for k, v in observation.items()]).alias("observation"),
        prompt.alias("prompt"),
        F.concat_ws("--", F.col(ids[0]), F.col(ids[1]), F.col("step").cast("string")).alias("step_id"),
        *[F.col(c) for c in ("episode_id", "step") if c in df.columns],
    )


def model_input(df: DataFrame, slots: Sequence[str], tokens: tuple[str, str] | None = None) -> DataFrame:
    """Typed rows of a model: image, image_mask, state, optional tokens (ids and mask: both or neither), actions."""
    need = {"image", "image_mask", "state"} | set(tokens or ())
    if missing := sorted(need - set(df.columns)):
        raise ValueError(f"missing {missing}")
    have = [f.name for f in df.schema["image"].dataType.fields]  # type: ignore[attr-defined]
    if lacking := sorted(set(slots) - set(have)):
        raise ValueError(f"missing image slots {lacking}")
    columns = [F.col("image"), F.col("image_mask"), F.col("state").cast("array<float>").alias("state")]
    if tokens:
        columns += [F.col(tokens[0]).alias("tokenized_prompt"), F.col(tokens[1]).alias("tokenized_prompt_mask")]
    if "actions" in df.columns:
        columns.append(F.col("actions").cast("array<array<float>>").alias("actions"))
    return df.select(*columns)
