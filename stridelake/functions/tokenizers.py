"""Token ids by a stored vocabulary: a tokenizer's JSON, or a SentencePiece model. The file is read once by the
driver and broadcast, so executors need not see it; vocabularies are a few MB."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import lru_cache

import pandas as pd
from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stridelake.workers import importable

#: A file larger than this isn't a vocabulary, and isn't broadcast.
LARGEST = 64 << 20


@lru_cache(4)
def encoder(kind: str, content: bytes) -> Callable[[list[str]], list[list[int]]]:
    """Ids of each text, without special tokens at its ends."""
    if kind == "json":
        from tokenizers import Tokenizer

        t = Tokenizer.from_str(content.decode())
        return lambda texts: [e.ids for e in t.encode_batch(texts, add_special_tokens=False)]
    if kind == "model":
        from sentencepiece import SentencePieceProcessor

        p = SentencePieceProcessor(model_proto=content)
        return lambda texts: [list(p.encode(x)) for x in texts]
    raise ValueError(f"vocabularies are .json or .model files, not .{kind}")


def token_ids(spark: SparkSession, path: str) -> Callable[[Column], Column]:
    """Column function: text to array<int>, null to an empty one."""
    importable(spark)
    stored = spark.read.format("binaryFile").load(path).select("length", "content")
    if stored.select("length").first()[0] > LARGEST:
        raise ValueError(f"{path} is too large for a vocabulary")
    held = spark.sparkContext.broadcast(bytes(stored.first()["content"]))
    kind = path.rsplit(".", 1)[-1]

    @F.pandas_udf(T.ArrayType(T.IntegerType()))
    def run(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        encode = encoder(kind, held.value)
        for t in texts:
            yield pd.Series(encode(t.fillna("").tolist()))

    return run
