"""What the operators of this subpackage share: scratch tables, checked broadcasts, Arrow helpers."""

from __future__ import annotations

import atexit
import os
import sys
import tempfile
import uuid
from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

ROOT = str(Path(__file__).resolve().parents[2])
#: Rows and bytes of an Arrow batch on its way to a Python worker: bounds the worker's memory.
BATCH_ROWS, BATCH_BYTES = 1000, 8 << 20
#: Rows of ids and digests that a task writes at least, where their number is known.
FILE_ROWS = 20_000
#: A side is broadcast only when its rows and their bytes, both measured, stay under these.
BROADCAST_ROWS, BROADCAST_BYTES = 2_000_000, 48 << 20


def prepare(spark: SparkSession) -> SparkSession:
    """Bounds Arrow batches and lets Python workers import this package when it isn't installed."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS)
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)
    env = spark.sparkContext.environment
    # workers give freed memory back to the system
    env.setdefault("ARROW_DEFAULT_MEMORY_POOL", "system")
    env.setdefault("MALLOC_MMAP_THRESHOLD_", str(16 << 20))
    env.setdefault("MALLOC_TRIM_THRESHOLD_", str(32 << 20))
    if ROOT not in env.get("PYTHONPATH", "").split(os.pathsep):
        env["PYTHONPATH"] = os.pathsep.join(filter(None, [ROOT, env.get("PYTHONPATH", "")]))
    if ROOT not in sys.path:
        sys.path.append(ROOT)
    return spark


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return prepare(spark).read.parquet(f"{sf_dir}/{table}.parquet")


def scratch_root(spark: SparkSession) -> str:
    """The shared folder of spark.checkpoint.dir; a local one only where that is unset and the master is local."""
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not root:
        master = spark.sparkContext.master
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        root = tempfile.mkdtemp(prefix="stridelake-")
        spark.conf.set("spark.checkpoint.dir", root)
    return root.rstrip("/")


def _remove(spark: SparkSession, path: str) -> None:
    try:
        jvm = spark.sparkContext._jvm
        p = jvm.org.apache.hadoop.fs.Path(path)
        p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)
    except Exception:  # noqa: BLE001  the session may be gone at exit
        pass


def materialize(df: DataFrame, name: str, rows: int | None = None) -> DataFrame:
    """Writes df as Parquet to the shared scratch folder and reads it back.

    Cuts the lineage at files that outlive any executor. Deleted when the driver exits.
    rows: of a table of ids and digests whose last stage reads so many rows at most. It then takes a task and a
    file for each FILE_ROWS of them, as on a local path each file also starts processes that set its mode."""
    spark = df.sparkSession
    if rows is not None:
        df = df.coalesce(max(1, -(-rows // FILE_ROWS)))
    path = f"{scratch_root(spark)}/stridelake/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    atexit.register(_remove, spark, path)
    return spark.read.schema(df.schema).parquet(path)


def packed(docs: DataFrame) -> DataFrame:
    """One struct column `row` with all columns of docs, so that no name of theirs can clash; undone by select("row.*")."""
    return docs.select(F.struct(F.col("*")).alias("row"))


def row_width(df: DataFrame) -> Column:
    """About how many bytes each row of df takes in memory."""
    fixed, parts = 16, []
    for f in df.schema.fields:
        if isinstance(f.dataType, (T.StringType, T.BinaryType)):
            parts.append(F.coalesce(F.octet_length(F.col(f"`{f.name}`")), F.lit(0)) + 16)
        elif isinstance(f.dataType, T.ArrayType):
            inner = f.dataType.elementType
            each = 16 + 8 * len(inner.fields) if isinstance(inner, T.StructType) else 8
            parts.append(F.greatest(F.size(F.col(f"`{f.name}`")), F.lit(0)) * each + 16)
        else:
            fixed += 8 if not isinstance(f.dataType, T.StructType) else 32
    return sum(parts, F.lit(fixed).cast("long"))


def fits(df: DataFrame, limit: int = BROADCAST_ROWS, most: int = BROADCAST_BYTES) -> bool:
    """Whether the measured rows of a stored side, and their bytes, are few enough for a broadcast."""
    rows, nbytes = df.agg(F.count("*"), F.sum(row_width(df))).first()
    return rows <= limit and (nbytes or 0) <= most


def small_or_shuffled(df: DataFrame, limit: int = BROADCAST_ROWS, most: int = BROADCAST_BYTES) -> DataFrame:
    """Broadcasts a side whose measured rows and bytes stay under the limits; a shuffled join otherwise."""
    return F.broadcast(df) if fits(df, limit, most) else df.hint("shuffle_merge")


def most_frequent(counts: DataFrame, column: str, most: int) -> DataFrame:
    """The rows of a stored table whose count reaches the smallest cut-off that leaves at most `most` of them.
    The cut-off comes from a histogram of the counts; counts of 1000 and more fall into steps of 5 %."""
    c = F.col(column)
    step = F.when(c < 1000, c).otherwise(F.floor(F.pow(F.lit(1.05), F.floor(F.log(1.05, c)))))
    total, cut = 0, None
    for r in sorted(counts.groupBy(step.alias("n")).count().collect(), key=lambda r: -r["n"]):
        total += r["count"]
        if total > most:
            break
        cut = r["n"]
    return counts.where(F.lit(False)) if cut is None else counts.where(c >= cut)


def text_bytes(column: pa.ChunkedArray | pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of a text column in one array, and n + 1 offsets; null counts as empty."""
    arr = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    if isinstance(arr, pa.ChunkedArray):
        arr = arr.chunk(0) if arr.num_chunks else pa.array([], pa.string())
    if arr.null_count:
        arr = arr.fill_null("")
    wide = pa.types.is_large_string(arr.type)
    buffers = arr.buffers()
    if not len(arr):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    offsets = np.frombuffer(buffers[1], np.int64 if wide else np.int32)[arr.offset : arr.offset + len(arr) + 1].astype(np.int64)
    data = np.frombuffer(buffers[2], np.uint8) if buffers[2] is not None and buffers[2].size else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def slices(batch: pa.RecordBatch, rows: int = 256, nbytes: int = 1 << 19, column: str = "text") -> Iterator[pa.RecordBatch]:
    """Parts of a batch that hold at most so many rows, and at most so many bytes of the column unless one row has more."""
    size = np.cumsum(pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False).astype(np.int64))
    begin = 0
    while begin < batch.num_rows:
        used = int(size[begin - 1]) if begin else 0
        end = min(begin + rows, max(begin + 1, int(np.searchsorted(size, used + nbytes, side="right"))))
        yield batch.slice(begin, end - begin)
        begin = min(end, batch.num_rows)


def mix64(x: np.ndarray) -> np.ndarray:
    """Finaliser of SplitMix64 (public domain), on uint64."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


#: Base of the polynomial hash of a run of bytes, modulo 2^64, and its inverse there.
BASE = 0x9E3779B97F4A7C15 | 1
INVERSE = pow(BASE, -1, 1 << 64)
_POWERS: dict[int, np.ndarray] = {}


def powers(base: int, n: int) -> np.ndarray:
    """base^0 .. base^(n-1) modulo 2^64."""
    have = _POWERS.get(base)
    if have is None or len(have) < n:
        with np.errstate(over="ignore"):
            have = np.full(max(n, 1 << 16), base, np.uint64)
            have[0] = 1
            have = np.multiply.accumulate(have)
        _POWERS[base] = have
    return have[:n]


def run_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each run data[start:end], from one prefix sum."""
    with np.errstate(over="ignore"):
        prefix = np.zeros(len(data) + 1, np.uint64)
        np.cumsum((data.astype(np.uint64) + np.uint64(1)) * powers(BASE, len(data)), out=prefix[1:])
        h = (prefix[ends] - prefix[starts]) * powers(INVERSE, len(data) + 1)[starts]
        return mix64(h ^ (ends - starts).astype(np.uint64))


#: Bytes as they count for words: ASCII letters in lower case, digits and other scripts as they are, the rest as space.
FOLDED = bytes(b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or 48 <= b <= 57 or b >= 128 else 32 for b in range(256))


def word_hashes(column: pa.ChunkedArray | pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Row and 64-bit hash of each word of a batch of texts, in order. Words are runs of ASCII letters,
    digits and bytes of other scripts, in lower case."""
    data, offsets = text_bytes(column)
    if not len(data):
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    folded = np.frombuffer(data.tobytes().translate(FOLDED), np.uint8)
    inside = folded != 32
    edge = np.ones(len(folded) + 1, bool)
    edge[1:-1] = inside[1:] != inside[:-1]
    edge[offsets] = True
    cuts = np.flatnonzero(edge)
    starts, ends = cuts[:-1], cuts[1:]
    word = inside[starts]
    starts, ends = starts[word], ends[word]
    return np.searchsorted(offsets, starts, side="right") - 1, run_hashes(folded, starts, ends)
