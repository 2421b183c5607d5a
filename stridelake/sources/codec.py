"""Arrays of any shape as struct<dtype:string, shape:array<int>, data:binary>."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stridelake.workers import importable

ARRAY = T.StructType([T.StructField("dtype", T.StringType()), T.StructField("shape", T.ArrayType(T.IntegerType())), T.StructField("data", T.BinaryType())])


def packed(x: np.ndarray) -> dict:
    """Raises on complex, object and structured arrays."""
    x = np.asarray(x)
    if x.dtype.kind in "VOc":
        raise ValueError(f"can't pack {x.dtype}")
    return {"dtype": x.dtype.str, "shape": list(x.shape), "data": x.tobytes()}


def unpacked(v: dict) -> np.ndarray:
    return np.frombuffer(v["data"], np.dtype(v["dtype"])).reshape(tuple(v["shape"]))


@F.pandas_udf(T.ArrayType(T.DoubleType()))
def _flat(dtype: pd.Series, data: pd.Series) -> pd.Series:
    return pd.Series([None if d is None else np.frombuffer(d, np.dtype(t)).astype(float).tolist() for t, d in zip(dtype, data, strict=True)])


@F.pandas_udf(ARRAY)
def _pack(xs: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
    for x in xs:
        yield pd.DataFrame([packed(np.asarray(v, np.float64)) for v in x], columns=["dtype", "shape", "data"])


def to_vector(array: Column) -> Column:
    """The elements of a packed array as array<double>, in row order."""
    importable()
    return _flat(array["dtype"], array["data"])


def from_vector(x: Column) -> Column:
    """A packed float64 array of one dimension."""
    importable()
    return _pack(x)
