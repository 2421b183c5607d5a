"""Transforms are functions from DataFrame to DataFrame; a Group has input ones and, mirrored, output ones."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field, replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stridelake.functions import text as X
from stridelake.functions import vectors as V
from stridelake.operators import projections as P

Transform = Callable[[DataFrame], DataFrame]


@dataclass(frozen=True)
class Group:
    inputs: tuple[Transform, ...] = ()
    outputs: tuple[Transform, ...] = ()

    def push(self, inputs: Sequence[Transform] = (), outputs: Sequence[Transform] = ()) -> Group:
        """Inputs come after those that are there, outputs before them."""
        return Group((*self.inputs, *inputs), (*outputs, *self.outputs))


def composed(transforms: Sequence[Transform]) -> Transform:
    """From left to right."""

    def run(df: DataFrame) -> DataFrame:
        for t in transforms:
            df = df.transform(t)
        return df

    return run


def literal_statistics(stats: DataFrame) -> dict[str, dict[str, list[float]]]:
    """A table of a row per key, collected: its vectors become literals of the plan."""
    return {r["key"]: {c: list(r[c]) for c in ("mean", "std", "q01", "q99") if c in r and r[c] is not None} for r in stats.collect()}


def _scaler(s: Mapping[str, Sequence[float]], quantiles: bool, inverse: bool):
    if quantiles:
        V.require_quantiles(list(s))
        f, a, b = V.inverse_quantile_scale if inverse else V.quantile_scale, "q01", "q99"
    else:
        f, a, b = V.inverse_zscore if inverse else V.zscore, "mean", "std"
    return lambda x: f(x, V.vector(s[a]), V.vector(s[b]))


def _scaled(stats: Mapping[str, Mapping[str, Sequence[float]]], quantiles: bool, nested: Sequence[str], inverse: bool) -> Transform:
    def run(df: DataFrame) -> DataFrame:
        for name in [n for n in stats if n in df.columns]:
            one = _scaler(stats[name], quantiles, inverse)
            df = df.withColumn(name, F.transform(F.col(name), one) if name in nested else one(F.col(name)))
        return df

    return run


def normalise(stats: Mapping[str, Mapping[str, Sequence[float]]], quantiles: bool = False, nested: Sequence[str] = ("actions",)) -> Transform:
    """Scales the columns that have statistics; columns in `nested` hold rows of vectors."""
    return _scaled(stats, quantiles, nested, False)


def unnormalise(stats: Mapping[str, Mapping[str, Sequence[float]]], quantiles: bool = False, nested: Sequence[str] = ("actions",)) -> Transform:
    """Inverse of normalise."""
    return _scaled(stats, quantiles, nested, True)


def delta_actions(mask: Sequence[bool] | None) -> Transform:
    return lambda df: df.withColumn("actions", V.delta_rows(F.col("actions"), F.col("state"), mask)) if "actions" in df.columns else df


def absolute_actions(mask: Sequence[bool] | None) -> Transform:
    return lambda df: df.withColumn("actions", V.absolute_rows(F.col("actions"), F.col("state"), mask)) if "actions" in df.columns else df


def padded(dim: int) -> Transform:
    """State and each action row, to the model's width."""

    def run(df: DataFrame) -> DataFrame:
        df = df.withColumn("state", V.pad_to(F.col("state"), dim))
        return df.withColumn("actions", V.pad_rows(F.col("actions"), dim)) if "actions" in df.columns else df

    return run


def default_prompt(value: str) -> Transform:
    return lambda df: P.with_default(df, "prompt", value)


def tokenised(encode: Callable[[DataFrame], DataFrame], length: int) -> Transform:
    """encode adds tokens (array<int>) by a vocabulary; they are cut or padded, with a mask."""

    def run(df: DataFrame) -> DataFrame:
        if "prompt" not in df.columns:
            raise ValueError("prompt is required")
        t = X.padded_tokens(F.col("tokens"), length)
        return encode(df).withColumn("_t", t).withColumn("tokenized_prompt", F.col("_t.ids")).withColumn("tokenized_prompt_mask", F.col("_t.mask")).drop("_t", "tokens")

    return run


def prompt_tokens(ids: Callable[[Column], Column], length: int, begin: int | None = None) -> Transform:
    """tokenized_prompt and its mask of `length`: the cleaned prompt and a newline, after an optional first id.
    ids: see tokenizers.token_ids."""

    def encode(df: DataFrame) -> DataFrame:
        found = ids(F.concat(X.clean_prompt(F.col("prompt")), F.lit("\n")))
        return df.withColumn("tokens", F.concat(F.array(F.lit(begin)), found) if begin is not None else found)

    return tokenised(encode, length)


@dataclass(frozen=True)
class DataConfig:
    """repack, data and model transforms of a dataset, and its statistics."""

    repack: Group = field(default_factory=Group)
    data: Group = field(default_factory=Group)
    model: Group = field(default_factory=Group)
    stats: Mapping[str, Mapping[str, Sequence[float]]] | None = None
    quantiles: bool = False
    fake: bool = False

    def training(self, df: DataFrame, skip_stats: bool = False) -> DataFrame:
        """repack, data, normalise, model. Missing statistics are an error unless data are fake or it is skipped."""
        if self.stats is None and not (self.fake or skip_stats):
            raise ValueError("no normalisation statistics; compute them first")
        stats = {} if skip_stats or self.stats is None else self.stats
        return composed([*self.repack.inputs, *self.data.inputs, normalise(stats, self.quantiles), *self.model.inputs])(df)

    def for_statistics(self, df: DataFrame) -> DataFrame:
        """repack and data only, without text."""
        return composed([*self.repack.inputs, *self.data.inputs, P.without_strings])(df)

    def request(self, df: DataFrame, prompt: str | None = None) -> DataFrame:
        first = [default_prompt(prompt)] if prompt else []
        return composed([*self.repack.inputs, *first, *self.data.inputs, normalise(self.stats or {}, self.quantiles), *self.model.inputs])(P.without_prefix(df, "rtc/"))

    def reply(self, df: DataFrame) -> DataFrame:
        """The mirror: model, unnormalise, data, repack."""
        return composed([*self.model.outputs, unnormalise(self.stats or {}, self.quantiles), *self.data.outputs, *self.repack.outputs])(df)

    def with_stats(self, stats: DataFrame) -> DataConfig:
        return replace(self, stats=literal_statistics(stats))
