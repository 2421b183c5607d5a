"""Images as struct<h:int, w:int, c:int, data:binary> of bytes in row order. Pixels go through Arrow and numpy."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stridelake.workers import importable

IMAGE = T.StructType([T.StructField("h", T.IntegerType()), T.StructField("w", T.IntegerType()), T.StructField("c", T.IntegerType()), T.StructField("data", T.BinaryType())])

# The six views of a composed camera frame, as shares of its width and height (x1, y1, x2, y2).
VIEWS = {
    "head_right_eye": (0.1250, 0.0000, 0.8750, 0.3529411765),
    "head_left_eye": (0.1250, 0.3529411765, 0.8750, 0.7058823529),
    "right_wrist_left_eye": (0.0000, 0.7058823529, 0.5000, 0.8529411765),
    "right_wrist_right_eye": (0.5000, 0.7058823529, 1.0000, 0.8529411765),
    "left_wrist_left_eye": (0.0000, 0.8529411765, 0.5000, 1.0000),
    "left_wrist_right_eye": (0.5000, 0.8529411765, 1.0000, 1.0000),
}


def pixels(v: dict) -> np.ndarray:
    return np.frombuffer(v["data"], np.uint8).reshape(v["h"], v["w"], v["c"])


def image(x: np.ndarray) -> dict:
    h, w, c = x.shape
    return {"h": h, "w": w, "c": c, "data": np.ascontiguousarray(x, np.uint8).tobytes()}


def _udf(fn: Callable[[np.ndarray], np.ndarray]):
    importable()

    @F.pandas_udf(IMAGE)
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            yield pd.DataFrame([image(fn(pixels(r))) for r in f.to_dict("records")], columns=["h", "w", "c", "data"])

    return run


def to_bytes(x: np.ndarray) -> np.ndarray:
    """Floats in [0, 1] to bytes by cutting off; bytes as they are."""
    return x if x.dtype == np.uint8 else (255 * x).astype(np.uint8)


def channels_last(x: np.ndarray) -> np.ndarray:
    return x.transpose(1, 2, 0) if x.ndim == 3 and x.shape[0] == 3 else x


def parsed(x: np.ndarray) -> np.ndarray:
    """Bytes with channels last."""
    return channels_last(to_bytes(np.asarray(x)))


def _cubic(x: np.ndarray) -> np.ndarray:
    """Cubic convolution with a = -0.5."""
    x = np.abs(x)
    return np.where(x < 1, (1.5 * x - 2.5) * x * x + 1, np.where(x < 2, ((-0.5 * x + 2.5) * x - 4) * x + 2, 0))


#: Half the width of each kernel in source pixels, and its curve.
KERNELS = {"bilinear": (1.0, lambda x: np.maximum(0, 1 - np.abs(x))), "bicubic": (2.0, _cubic)}
#: Weights are whole multiples of 1 / SCALE, so sums of pixels are exact in doubles.
SCALE = 1 << 22


@lru_cache(64)
def _weights(n: int, m: int, kernel: str) -> np.ndarray:
    """m by n: the share of each of n pixels in each of m. When shrinking, the kernel widens to cover all pixels."""
    reach, curve = KERNELS[kernel]
    wide = max(n / m, 1.0)
    centre, at = (np.arange(m)[:, None] + 0.5) * (n / m), np.arange(n)[None, :]
    inside = (at >= np.trunc(np.maximum(centre - reach * wide + 0.5, 0))) & (at < np.trunc(centre + reach * wide + 0.5))
    share = np.where(inside, curve((at + 0.5 - centre) / wide), 0.0)
    share = share / share.sum(axis=1, keepdims=True) * SCALE
    return np.trunc(share + np.copysign(0.5, share))


def resized(x: np.ndarray, h: int, w: int, kernel: str = "bilinear") -> np.ndarray:
    """Columns, then rows, each pass rounded to bytes; a side that has its size already is left alone."""
    if x.shape[1] != w:
        x = _bytes(np.einsum("mn,hnc->hmc", _weights(x.shape[1], w, kernel), x.astype(np.float64), optimize=True))
    if x.shape[0] != h:
        x = _bytes(np.einsum("mn,nwc->mwc", _weights(x.shape[0], h, kernel), x.astype(np.float64), optimize=True))
    return x


def _bytes(sums: np.ndarray) -> np.ndarray:
    return np.clip(np.floor(sums / SCALE + 0.5), 0, 255).astype(np.uint8)


def rotated(x: np.ndarray, degrees: float) -> np.ndarray:
    """About the centre, by bilinear samples; black outside."""
    h, w = x.shape[:2]
    c, s = np.cos(np.radians(degrees)), np.sin(np.radians(degrees))
    y, z = np.mgrid[:h, :w] - np.array([(h - 1) / 2, (w - 1) / 2])[:, None, None]
    ys, xs = c * y - s * z + (h - 1) / 2, s * y + c * z + (w - 1) / 2
    framed = np.pad(x.astype(np.float64), ((1, 1), (1, 1), (0, 0)))
    ys, xs = np.clip(ys, -1, h) + 1, np.clip(xs, -1, w) + 1
    y0, x0 = np.minimum(ys.astype(int), h), np.minimum(xs.astype(int), w)
    fy, fx = (ys - y0)[..., None], (xs - x0)[..., None]
    top = framed[y0, x0] * (1 - fx) + framed[y0, x0 + 1] * fx
    low = framed[y0 + 1, x0] * (1 - fx) + framed[y0 + 1, x0 + 1] * fx
    return np.rint(top * (1 - fy) + low * fy).astype(np.uint8)


#: Shares of a training image that are kept by the crop, and by which brightness, contrast and saturation change; degrees.
KEPT, BRIGHTNESS, CONTRAST, SATURATION, DEGREES = 0.95, 0.3, 0.4, 0.5, 5.0


def varied(x: np.ndarray, draws: np.ndarray, wrist: bool) -> np.ndarray:
    """A training image changed by six draws from [0, 1): crop (2) and turn, not for wrist cameras, then
    brightness, contrast and saturation."""
    h, w = x.shape[:2]
    if not wrist:
        ch, cw = max(1, int(h * KEPT)), max(1, int(w * KEPT))
        top, left = int(draws[0] * (h - ch + 1)), int(draws[1] * (w - cw + 1))
        x = rotated(resized(x[top : top + ch, left : left + cw], h, w), (2 * draws[2] - 1) * DEGREES)
    light, contrast, colour = 1 + (2 * np.asarray(draws[3:]) - 1) * (BRIGHTNESS, CONTRAST, SATURATION)
    f = np.clip(x / 255.0 * light, 0, 1)
    f = np.clip((f - f.mean()) * contrast + f.mean(), 0, 1)
    grey = f.mean(axis=2, keepdims=True)
    return np.rint(np.clip(grey + (f - grey) * colour, 0, 1) * 255).astype(np.uint8)


def fitted_size(h: int, w: int, to_h: int, to_w: int) -> tuple[int, int, int, int]:
    """Height and width that keep the aspect, and rows and columns of padding before them; the odd one comes after."""
    ratio = max(w / to_w, h / to_h)
    rh, rw = int(h / ratio), int(w / ratio)
    return rh, rw, (to_h - rh) // 2, (to_w - rw) // 2


def padded_to(x: np.ndarray, h: int, w: int) -> np.ndarray:
    """Resized to fit, centred on black."""
    if x.shape[:2] == (h, w):
        return x
    rh, rw, top, left = fitted_size(*x.shape[:2], h, w)
    out = np.zeros((h, w, x.shape[2]), np.uint8)
    out[top : top + rh, left : left + rw] = resized(x, rh, rw)
    return out


def left_of_stereo(x: np.ndarray, exact: bool = False) -> np.ndarray:
    """Turned by 180 degrees and cut to its left half, if it is twice as wide as high (at least, or exactly)."""
    h, w = x.shape[:2]
    return x[::-1, ::-1][:, : w // 2] if (w == 2 * h if exact else w >= 2 * h) else x


def box_pixels(box: tuple[float, float, float, float], w: int, h: int) -> tuple[int, int, int, int]:
    """Rounded half to even and kept inside."""
    return tuple(max(0, min(n, round(v * n))) for v, n in zip(box, (w, h, w, h), strict=True))  # type: ignore[return-value]


def view_boxes(w: Column, h: Column) -> Column:
    """Map of view to [x1, y1, x2, y2] in pixels, of a frame's size: no pixels needed."""
    side = (w, h, w, h)
    edges = lambda box: F.array(*[F.greatest(F.lit(0), F.least(n, F.bround(n * F.lit(v)).cast("int"))) for v, n in zip(box, side, strict=True)])
    return F.create_map(*[x for name, box in VIEWS.items() for x in (F.lit(name), edges(box))])


def resize_with_pad(c: Column, h: int, w: int) -> Column:
    return _udf(lambda x: padded_to(x, h, w))(c)


def resize(c: Column, h: int, w: int, kernel: str = "bilinear") -> Column:
    return _udf(lambda x: resized(x, h, w, kernel))(c)


def augmented(c: Column, wrist: bool, seed: int, *keys: str) -> Column:
    """Images of training, varied by draws that are hashes of (seed, keys): each row has its own, on any partition."""
    importable()

    @F.pandas_udf(IMAGE)
    def run(frames: Iterator[tuple[pd.DataFrame, pd.Series]]) -> Iterator[pd.DataFrame]:
        for f, draws in frames:
            yield pd.DataFrame([image(varied(pixels(r), d, wrist)) for r, d in zip(f.to_dict("records"), draws, strict=True)], columns=["h", "w", "c", "data"])

    draws = [F.pmod(F.xxhash64(F.lit(seed), F.lit(i), *keys), F.lit(1 << 30)) / float(1 << 30) for i in range(6)]
    return run(c, F.array(*draws))


def channels_first(c: Column, h: int | None = None, w: int | None = None) -> Column:
    """A frame's bytes with channels before rows, resized to fit h x w first if a size is given; one pass in Python."""
    importable()

    @F.pandas_udf(T.BinaryType())
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.Series]:
        for f in frames:
            shown = (pixels(r) if h is None else padded_to(pixels(r), h, w) for r in f.to_dict("records"))
            yield pd.Series([x.transpose(2, 0, 1).tobytes() for x in shown], dtype=object)

    return run(c)


def stereo_left(c: Column, exact: bool = False) -> Column:
    return _udf(lambda x: left_of_stereo(x, exact))(c)


def turned(c: Column) -> Column:
    """Both axes reversed."""
    return _udf(lambda x: x[::-1, ::-1])(c)


def channels_reversed(c: Column) -> Column:
    """Without a fourth channel, the first three in reverse."""
    return _udf(lambda x: x[..., :3][..., ::-1])(c)


def view(c: Column, name: str) -> Column:
    def cut(x: np.ndarray) -> np.ndarray:
        x1, y1, x2, y2 = box_pixels(VIEWS[name], x.shape[1], x.shape[0])
        return x[y1:y2, x1:x2]

    return _udf(cut)(c)


@F.pandas_udf(T.ArrayType(T.FloatType()))
def scaled(frames: Iterator[pd.DataFrame]) -> Iterator[pd.Series]:
    """Bytes to x / 255 * 2 - 1, flat."""
    for f in frames:
        yield pd.Series([(np.frombuffer(d, np.uint8).astype(np.float32) / 255 * 2 - 1).tolist() for d in f["data"]])


def blank(h: int, w: int, c: int = 3) -> Column:
    return F.struct(F.lit(h).alias("h"), F.lit(w).alias("w"), F.lit(c).alias("c"), F.unhex(F.repeat(F.lit("00"), h * w * c)).alias("data"))
