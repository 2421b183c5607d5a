"""Packing tokenised documents into fixed-length sequences by the sum-of-squares rule.

Sum of squares: with N(g) open sequences that have g places left, a document of length a goes where the
sum of N(g)^2 becomes smallest, in an open sequence or a new one; ties go to the tightest fit.

Tokens are counted once, in an Arrow stage that yields a row per piece; rows are dealt out evenly into
groups of a bounded number of pieces and each group is packed by one task. Only lengths and ids'
checksums travel, unless the ids themselves are asked for.

Defined cases: a null or empty text is one token, the separator; a document of more than `size` tokens is
cut into pieces of `size`, the last one shorter; repeated rows are packed as often as they occur; null
doc_ids stay null; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import re
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stridelake.llm.common import materialize, prepare, read

SEQUENCE, SEPARATOR, VOCABULARY = 2048, 0, "word_bpe_49k.json"
#: Pieces that one task packs, about.
GROUP_PIECES = 50_000
#: Entries of a generation of a worker's word caches.
CACHE_WORDS = 220_000
#: Characters for which lower() and split() do what the vocabulary's normaliser does; texts with any other take the plain path.
UNUSUAL = re.compile(r"[^\t-\r\x20-\x7e\xa0-įı-ſ]|<\|")


def tokenizer_path(name: str = VOCABULARY) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


#: What the vocabulary's pre-tokeniser splits off, for lower-case texts without unusual characters.
UNITS = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-zªµºß-öø-ſ]+|[0-9²³¹¼-¾]|[^\sa-zªµºß-öø-ſ0-9²³¹¼-¾]+")


def byte_letters() -> dict[int, str]:
    """The printable letter that byte-level vocabularies write for each byte: itself where it is printable,
    else the next free code point from 256 on."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in printable]
    return {b: chr(b) for b in printable} | {b: chr(256 + i) for i, b in enumerate(others)}


class Generations(dict):
    """A dict of bounded size: when it holds `most` keys it becomes the older one, and the older one goes."""

    def __init__(self, most: int, make) -> None:
        super().__init__()
        self.most, self.make, self.older = most, make, {}

    def __missing__(self, key: str) -> bytes:
        value = self.older.get(key)
        if value is None:
            value = self.make(key)
        if len(self) >= self.most:
            self.older = dict(self)
            self.clear()
        self[key] = value
        return value


class WordTokenizer:
    """Ids of texts as packed little-endian uint32, equal to the library's. The ids of each white-space
    separated chunk, across which this vocabulary never merges, and of the units in it are remembered."""

    def __init__(self, path: str) -> None:
        from tokenizers import Tokenizer

        self.plain = Tokenizer.from_file(path)
        self.model, self.letters = self.plain.model, byte_letters()
        self.units = Generations(CACHE_WORDS, self.unit)
        self.chunks = Generations(CACHE_WORDS, self.chunk)

    def unit(self, unit: str) -> bytes:
        if not unit.isascii():
            unit = "".join(map(self.letters.__getitem__, unit.encode()))
        ids = [t.id for t in self.model.tokenize(unit)]
        return struct.pack(f"<{len(ids)}I", *ids)

    def chunk(self, chunk: str) -> bytes:
        if chunk.isalpha() and chunk.isascii():
            return self.units[chunk]
        return b"".join(map(self.units.__getitem__, UNITS.findall(chunk)))

    def __call__(self, texts: list[str | None]) -> list[bytes]:
        odd = [i for i, t in enumerate(texts) if t and UNUSUAL.search(t)]
        skip = set(odd)
        out = [b"" if not t or i in skip else b"".join(map(self.chunks.__getitem__, t.lower().split())) for i, t in enumerate(texts)]
        for i, e in zip(odd, self.plain.encode_batch([texts[i] for i in odd], add_special_tokens=False), strict=True):
            out[i] = np.array(e.ids, "<u4").tobytes()
        return out


_LOADED: dict[str, WordTokenizer] = {}


def tokenizer(path: str) -> WordTokenizer:
    if path not in _LOADED:
        _LOADED[path] = WordTokenizer(path)
    return _LOADED[path]


PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"


def tokenized_pieces(docs: DataFrame, size: int = SEQUENCE, path: str | None = None, with_ids: bool = False) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32 and, if asked for, ids (packed uint32): a row per piece."""
    prepare(docs.sparkSession)
    path = path or tokenizer_path()
    separator = np.array([SEPARATOR], "<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = tokenizer(path)
        for batch in batches:
            ids = [x + separator for x in encode(batch.column("text").to_pylist())]
            step, rows = 4 * size, [(i, k) for i, x in enumerate(ids) for k in range(-(-len(x) // (4 * size)))]
            at, piece = np.array([r[0] for r in rows], np.int64), np.array([r[1] for r in rows], np.int32)
            parts = [ids[i][k * step : (k + 1) * step] for i, k in rows]
            columns = [batch.column("doc_id").take(pa.array(at)), pa.array(piece), pa.array(piece.astype(np.int64) * size), pa.array([len(p) // 4 for p in parts], pa.int64()), pa.array([zlib.crc32(p) for p in parts], pa.int64())]
            names = ["doc_id", "piece", "start", "length", "ids_crc32"]
            if with_ids:
                columns, names = [*columns, pa.array(parts, pa.binary())], [*names, "ids"]
            yield pa.RecordBatch.from_arrays(columns, names)

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, PIECES + ", ids binary" * with_ids)


def sum_of_squares(lengths: np.ndarray, size: int = SEQUENCE) -> tuple[np.ndarray, np.ndarray]:
    """Sequence number and offset of each piece; the pieces are taken in the order given."""
    sequence, offset = np.empty(len(lengths), np.int64), np.empty(len(lengths), np.int64)
    count = np.zeros(size + 1, np.int64)  # by gap; full sequences aren't counted
    open_at: list[list[int]] = [[] for _ in range(size + 1)]
    used = 0
    for i, a in enumerate(lengths.tolist()):
        change = np.where(count[a:size] > 0, 2 * (count[: size - a] - count[a:size]) + 2, 1 << 60)
        if len(change):
            change[0] -= 1  # an exact fit adds no gap
        g = int(change.argmin()) if len(change) else 0
        if len(change) and change[g] <= 2 * count[size - a] + 1:
            gap = g + a
            s = open_at[gap].pop()
            count[gap] -= 1
        else:
            gap, s, used = size, used, used + 1
        sequence[i], offset[i] = s, size - gap
        if gap > a:
            open_at[gap - a].append(s)
            count[gap - a] += 1
    return sequence, offset


def pack_pieces(pieces: DataFrame, size: int = SEQUENCE, group_pieces: int = GROUP_PIECES) -> DataFrame:
    """Adds sequence_id and offset to rows with a length of at most size. The rows should be a stored table."""
    n = pieces.count()
    groups = max(1, -(-n // group_pieces))
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in pieces.schema) + ", sequence_id long, offset long"
    names = pieces.columns

    def pack(key: tuple, table: pa.Table) -> pa.Table:
        lengths = table.column("length").to_numpy()
        order = np.argsort(-lengths, kind="stable")
        sequence, offset = np.empty(len(lengths), np.int64), np.empty(len(lengths), np.int64)
        sequence[order], offset[order] = sum_of_squares(lengths[order], size)
        sequence += key[0].as_py() << 32
        return table.select(names).append_column("sequence_id", pa.array(sequence)).append_column("offset", pa.array(offset))

    dealt = pieces.withColumn("_group", F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(groups)))
    return dealt.groupBy("_group").applyInArrow(pack, schema)


def pack_documents(docs: DataFrame, size: int = SEQUENCE, path: str | None = None, with_ids: bool = False, group_pieces: int = GROUP_PIECES) -> DataFrame:
    """A row per piece: doc_id, piece, start, length, ids_crc32, [ids,] sequence_id, offset."""
    return pack_pieces(materialize(tokenized_pieces(docs, size, path, with_ids), "pieces"), size, group_pieces)


def sequences(packed: DataFrame) -> DataFrame:
    """From pieces with ids: sequence_id, ids (packed uint32), doc_ids and lengths in their order."""
    parts = F.array_sort(F.collect_list(F.struct("offset", "ids", "doc_id", "length")))
    rows = packed.groupBy("sequence_id").agg(parts.alias("p"))  # at most `size` tokens each
    joined = F.aggregate("p", F.lit(b""), lambda a, x: F.concat(a, x["ids"]))
    return rows.select("sequence_id", joined.alias("ids"), F.col("p.doc_id").alias("doc_ids"), F.col("p.length").alias("lengths"))


def op9_sum_of_squares_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(read(spark, sf_dir, "documents"))
