"""Functions of array<double> columns: scaling, deltas, padding, masks, discretisation."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

EPSILON = 1e-6


def vector(values: Sequence[float]) -> Column:
    """Literal array<double>."""
    return F.array(*[F.lit(float(v)) for v in values])


def bools(values: Sequence[bool]) -> Column:
    return F.array(*[F.lit(bool(v)) for v in values])


def bool_mask(*dims: int) -> list[bool]:
    """+n adds n trues, -n adds n falses, 0 adds nothing."""
    return [d > 0 for d in dims for _ in range(abs(d))]


def to_double(x: Column) -> Column:
    return F.transform(x, lambda v: v.cast("double"))


def _at(stats: Column, i: Column) -> Column:
    return F.get(stats, i)


def zscore(x: Column, mean: Column, std: Column) -> Column:
    """(x - mean) / (std + 1e-6), with statistics cut to the length of x."""
    return F.transform(x, lambda v, i: (v - _at(mean, i)) / (_at(std, i) + EPSILON))


def quantile_scale(x: Column, q01: Column, q99: Column) -> Column:
    """Maps [q01, q99] to [-1, 1], with statistics cut to the length of x."""
    return F.transform(x, lambda v, i: (v - _at(q01, i)) / (_at(q99, i) - _at(q01, i) + EPSILON) * 2 - 1)


def inverse_zscore(x: Column, mean: Column, std: Column) -> Column:
    """Inverse of zscore; dimensions beyond the statistics count as mean 0 and deviation 1."""
    return F.transform(x, lambda v, i: v * (F.coalesce(_at(std, i), F.lit(1.0)) + EPSILON) + F.coalesce(_at(mean, i), F.lit(0.0)))


def inverse_quantile_scale(x: Column, q01: Column, q99: Column) -> Column:
    """Inverse of quantile_scale; dimensions beyond the statistics pass through."""
    return F.transform(x, lambda v, i: F.coalesce((v + 1) / 2 * (_at(q99, i) - _at(q01, i) + EPSILON) + _at(q01, i), v))


def require_quantiles(stats_columns: Sequence[str]) -> None:
    """Error at plan time unless both quantile columns are there."""
    missing = {"q01", "q99"} - set(stats_columns)
    if missing:
        raise ValueError(f"quantile scaling needs {sorted(missing)}")


def _masked(mask: Sequence[bool] | None, v: Column, i: Column, changed: Column) -> Column:
    m = bools(mask)
    return F.when(F.coalesce(F.get(m, i), F.lit(False)), changed).otherwise(v)


def delta_rows(rows: Column, state: Column, mask: Sequence[bool] | None) -> Column:
    """Each row of array<array<double>> less the state, on masked dimensions; unchanged without a mask."""
    if mask is None:
        return rows
    return F.transform(rows, lambda r: F.transform(r, lambda v, i: _masked(mask, v, i, v - F.get(state, i))))


def absolute_rows(rows: Column, state: Column, mask: Sequence[bool] | None) -> Column:
    """Inverse of delta_rows."""
    if mask is None:
        return rows
    return F.transform(rows, lambda r: F.transform(r, lambda v, i: _masked(mask, v, i, v + F.get(state, i))))


def delta_anchor(state: Column, mask: Sequence[bool] | None) -> Column:
    """What delta_rows subtracts: the state on masked dimensions, else 0; null without a mask."""
    if mask is None:
        return F.lit(None).cast("array<double>")
    return F.transform(state, lambda v, i: F.when(F.coalesce(F.get(bools(mask), i), F.lit(False)), v).otherwise(F.lit(0.0)))


def reanchor(rows: Column, valid: Column, previous: Column, now: Column) -> Column:
    """Adds (previous - now) to the first `valid` rows; dimensions beyond the anchors stay."""
    moved = lambda r: F.transform(r, lambda v, i: v + F.coalesce(F.get(previous, i) - F.get(now, i), F.lit(0.0)))
    return F.transform(rows, lambda r, k: F.when(k < valid, moved(r)).otherwise(r))


def pad_to(x: Column, n: int | Column, value: float = 0.0) -> Column:
    """Padded on the right to n elements; longer ones are left as they are."""
    more = F.greatest((F.lit(n) if isinstance(n, int) else n) - F.size(x), F.lit(0))
    return F.concat(x, F.array_repeat(F.lit(value), more))


def pad_rows(rows: Column, n: int) -> Column:
    return F.transform(rows, lambda r: pad_to(r, n))


def every_nth(x: Column, stride: int) -> Column:
    return F.filter(x, lambda _, i: i % stride == 0)


def flip(x: Column, signs: Sequence[int]) -> Column:
    return F.zip_with(x, vector(signs), lambda a, b: a * b)


def clamp(x: Column, low: Column, high: Column) -> Column:
    return F.transform(x, lambda v, i: F.greatest(F.get(low, i), F.least(F.get(high, i), v)))


def clamped_at(x: Column, low: Column, high: Column) -> Column:
    """Indices of the elements that clamp changes."""
    flags = F.transform(x, lambda v, i: F.when((v < F.get(low, i)) | (v > F.get(high, i)), i))
    return F.filter(flags, lambda v: v.isNotNull())


def ramp(start: Column, target: Column, alpha: Column) -> Column:
    """start + clip(alpha, 0, 1) * (target - start)."""
    a = F.greatest(F.lit(0.0), F.least(F.lit(1.0), alpha))
    return F.zip_with(start, target, lambda s, t: s + a * (t - s))


def linspace(start: Column, stop: Column, n: int) -> Column:
    return F.transform(F.sequence(F.lit(0), F.lit(n - 1)), lambda k: start + (stop - start) * k / F.lit(float(max(1, n - 1))))


def proportional(desired: Column, measured: Column, gain: float, limit: Column | None = None, share: float = 0.3) -> Column:
    """gain * (desired - measured), clipped to +-share * limit where a limit is given."""
    raw = F.zip_with(desired, measured, lambda d, m: (d - m) * gain)
    return raw if limit is None else F.zip_with(raw, limit, lambda v, k: F.greatest(-k * share, F.least(k * share, v)))


def put_at(x: Column, index: Column, value: Column) -> Column:
    """x with one element replaced."""
    return F.transform(x, lambda v, i: F.when(i == index, value).otherwise(v))


def discretise(x: Column, bins: int = 256) -> Column:
    """Bin of each element among `bins` equal ones of [-1, 1): below is -1, above and NaN the last."""
    half, last = bins / 2, bins - 1
    one = lambda v: F.when(F.isnan(v), last).when(v < -1, -1).otherwise(F.least(F.floor((v + 1) * half), F.lit(last)))
    return F.transform(x, lambda v: one(v).cast("int"))


def largest_error(a: Column, b: Column) -> Column:
    return F.array_max(F.zip_with(a, b, lambda x, y: F.abs(x - y)))


def norm(x: Column) -> Column:
    """Euclidean length."""
    return F.sqrt(F.aggregate(x, F.lit(0.0), lambda a, v: a + v * v))


def argmax(x: Column) -> Column:
    """Index of the first largest element, from 0."""
    return (F.array_position(x, F.array_max(x)) - 1).cast("int")


def masked_mean(x: Column, mask: Column) -> Column:
    """sum(x * mask) / max(sum(mask), 1)."""
    m = F.transform(mask, lambda v: v.cast("double"))
    total = lambda c: F.aggregate(c, F.lit(0.0), lambda a, v: a + v)
    return total(F.zip_with(x, m, lambda a, b: a * b)) / F.greatest(total(m), F.lit(1.0))


def suffix_loss(x: Column, delay: Column) -> Column:
    """Mean of a per-step loss without its first `delay` steps, rescaled as a mean over all steps."""
    n = F.size(x)
    kept = F.slice(x, delay + 1, F.greatest(n - delay, F.lit(0)))
    return F.aggregate(kept, F.lit(0.0), lambda a, v: a + v) / n * (n / F.greatest(n - delay, F.lit(1)))


def moving_average(x: Column, decay: float) -> Column:
    """Exponential moving average over an ordered array, starting at its first element."""
    return F.aggregate(F.slice(x, 2, F.size(x)), F.get(x, F.lit(0)), lambda a, v: a * decay + v * (1 - decay))


def token_positions(mask: Column) -> Column:
    """Positions of valid tokens: running count of trues less 1."""
    ones = F.transform(mask, lambda v: v.cast("int"))
    return F.transform(ones, lambda _, i: F.aggregate(F.slice(ones, 1, i + 1), F.lit(0), lambda a, v: a + v) - 1)


def attention_allowed(valid: Column, starts_block: Column) -> Column:
    """Row i, element j: both valid and the running count of block starts at j is at most that at i."""
    count = F.transform(starts_block, lambda _, i: F.aggregate(F.slice(starts_block, 1, i + 1), F.lit(0), lambda a, v: a + v.cast("int")))
    at = F.arrays_zip(count.alias("c"), valid.alias("v"))
    return F.transform(at, lambda a: F.transform(at, lambda b: (b["c"] <= a["c"]) & a["v"] & b["v"]))


def align_right(x: Column, valid: Column) -> Column:
    """Rolled so that the last valid element comes last."""
    n = F.size(x)
    last = n - F.array_position(F.reverse(valid), F.lit(True)).cast("int") + 1  # count up to the last true
    return F.when(F.array_contains(valid, True), F.concat(F.slice(x, last + 1, n), F.slice(x, 1, last))).otherwise(x)


def sincos_embedding(position: Column, dim: int, shortest: float, longest: float) -> Column:
    """Sines then cosines at dim / 2 periods from shortest to longest in geometric steps."""
    if dim % 2:
        raise ValueError("dim must be even")
    half = dim // 2
    periods = vector([shortest * (longest / shortest) ** (k / max(1, half - 1)) for k in range(half)])
    angle = F.transform(periods, lambda p: position / p * F.lit(2.0) * F.pi())
    return F.concat(F.transform(angle, F.sin), F.transform(angle, F.cos))


def quaternion_to_axis_angle(q: Column) -> Column:
    """(x, y, z, w) to axis times angle; w is clipped to [-1, 1], no rotation gives zeros."""
    w = F.greatest(F.lit(-1.0), F.least(F.lit(1.0), F.get(q, F.lit(3))))
    d = F.sqrt(F.lit(1.0) - w * w)
    return F.transform(F.slice(q, 1, 3), lambda v: F.when(d < 1e-12, F.lit(0.0)).otherwise(v * F.lit(2.0) * F.acos(w) / d))
