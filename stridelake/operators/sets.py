"""Set operations on tables, name lists and schemas."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def concatenated(parts: Sequence[DataFrame]) -> DataFrame:
    """All rows, with dataset_id by place; columns that a part lacks are null."""
    if not parts:
        raise ValueError("nothing to concatenate")
    marked = [p.withColumn("dataset_id", F.lit(i)) for i, p in enumerate(parts)]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), marked)


def unexpected(names: Column, allowed: Sequence[str]) -> Column:
    return F.array_except(names, F.array(*[F.lit(a) for a in allowed]))


def has_all(names: Column, needed: Sequence[str]) -> Column:
    return F.size(F.array_except(F.array(*[F.lit(a) for a in needed]), names)) == 0


def equal_tables(a: DataFrame, b: DataFrame, types: bool = True) -> bool:
    """The same columns, types if asked for, and rows with their repeats."""
    if sorted(a.columns) != sorted(b.columns) or types and dict(a.dtypes) != dict(b.dtypes):
        return False
    b = b.select(*a.columns)
    return a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()
