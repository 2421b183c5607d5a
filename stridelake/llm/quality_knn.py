"""Quality classification by nearest-neighbour voting in a latent-semantic space.

Terms of a document are hashed shapes of its characters (runs of 4 character classes), hashed byte
trigrams, word lengths, and words that repeat one of the preceding few. Weights are square roots of
relative frequencies times inverse document frequency; the leading singular directions of the labelled
reference rows span the latent space. The reference vectors are broadcast, every document's cosine with
each of them is computed in blocks, and the NEIGHBOURS most similar vote, weighted by similarity and by
the share of their label among all labelled rows.

The references are a hash sample of about REFERENCES labelled rows per label: that bounds what is
collected, decomposed and broadcast. Every document is scored whole.

Defined cases: a null text counts as empty; texts without any term (empty ones) get the share of label 1;
without labelled rows every score is 0.5; labels repeated for a doc_id count once, the lowest value;
null labels are ignored; of repeated doc_ids with a label one text is a reference; ties in similarity are
broken by the order of doc_id; repeated rows and further columns are harmless.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stridelake.llm.common import mix64, prepare, read, run_hashes, slices, text_bytes
from stridelake.llm.language_id import fold, hash_sample

REFERENCES, DIMENSIONS, NEIGHBOURS, POWER, THRESHOLD = 2500, 64, 15, 8, 0.3
SHAPES, TRIGRAMS, BLOCK = 1024, 1024, 256
LENGTHS, BACK = 24, 12
TERMS = SHAPES + TRIGRAMS + LENGTHS + BACK


def _classes() -> np.ndarray:
    """Character class of each byte: letters, digits and bytes of other scripts share one each."""
    c = np.arange(256, dtype=np.uint8)
    c[ord("a") : ord("z") + 1] = ord("a")
    c[ord("A") : ord("Z") + 1] = ord("A")
    c[ord("0") : ord("9") + 1] = ord("0")
    c[128:] = ord("a")
    return c


CLASSES = _classes()
SPACE = np.isin(np.arange(256), list(b" \t\n\v\f\r"))


def terms(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Square roots of relative term frequencies, a row per document, each kind of term on its own scale."""
    n = len(offsets) - 1
    doc = np.repeat(np.arange(n), np.diff(offsets))
    out = np.zeros((n, TERMS), np.float32)

    def put(first: int, width: int, docs: np.ndarray, term: np.ndarray, totals: np.ndarray) -> None:
        counts = np.bincount(docs * width + term, minlength=n * width).reshape(n, width)
        out[:, first : first + width] = np.sqrt(counts / np.maximum(totals, 1)[:, None])

    for first, width, source, k in ((0, SHAPES, CLASSES[data], 4), (SHAPES, TRIGRAMS, data, 3)):
        if len(data) < k:
            continue
        code, m = np.zeros(len(data) - k + 1, np.uint64), len(data) - k + 1
        for i in range(k):
            code = (code << np.uint64(8)) | source[i : i + m]
        whole = doc[:m] == doc[k - 1 :]
        put(first, width, doc[:m][whole], (mix64(code[whole]) % np.uint64(width)).astype(np.int64), np.diff(offsets))
    inside = ~SPACE[data]
    edge = np.ones(len(data) + 1, bool)
    edge[1:-1] = (inside[1:] != inside[:-1]) | (doc[1:] != doc[:-1])
    cuts = np.flatnonzero(edge)
    starts, ends = cuts[:-1], cuts[1:]
    word = inside[starts] if len(data) else np.zeros(0, bool)
    starts, ends = starts[word], ends[word]
    if len(starts):
        of, words = doc[starts], np.bincount(doc[starts], minlength=n)
        put(SHAPES + TRIGRAMS, LENGTHS, of, np.minimum(ends - starts, LENGTHS) - 1, words)
        h = run_hashes(data, starts, ends)
        for back in range(1, BACK + 1):
            if len(h) > back:
                same = (h[back:] == h[:-back]) & (of[back:] == of[:-back])
                put(SHAPES + TRIGRAMS + LENGTHS + back - 1, 1, of[back:][same], np.zeros(int(same.sum()), np.int64), words)
    return out


def _feature_rows(docs: DataFrame) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, BLOCK):
                x = terms(*text_bytes(part.column("text"))).astype(np.float16)
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), part.column("label"), pa.array([r.tobytes() for r in x], pa.binary())], ["doc_id", "label", "x"])

    return docs.select("doc_id", "label", "text").mapInArrow(run, "doc_id long, label int, x binary")


def fit(docs: DataFrame, labels: DataFrame, references: int = REFERENCES) -> dict:
    """The model, from docs (doc_id, text) and labels (doc_id, label)."""
    once = labels.where(F.col("label").isNotNull() & F.col("doc_id").isNotNull()).groupBy("doc_id").agg(F.min("label").cast("int").alias("label"))
    sizes = {r.label: r["count"] for r in once.groupBy("label").count().collect()}
    sample = None
    for value in sorted(sizes):
        part = hash_sample(once.where(F.col("label") == value), "doc_id", references)
        sample = part if sample is None else sample.unionByName(part)
    if sample is None:
        return {"share": 0.5, "refs": np.zeros((0, DIMENSIONS), np.float32)}
    chosen = docs.select(F.col("doc_id").cast("long"), "text").join(F.broadcast(sample), "doc_id")
    rows = _feature_rows(chosen).groupBy("doc_id", "label").agg(F.max("x").alias("x")).collect()
    rows.sort(key=lambda r: r.doc_id)
    total = sum(sizes.values())
    share = sizes.get(1, 0) / total
    if not rows:
        return {"share": share, "refs": np.zeros((0, DIMENSIONS), np.float32)}
    x = np.stack([np.frombuffer(r.x, np.float16) for r in rows]).astype(np.float32)
    y = np.array([r.label for r in rows], np.float32)
    idf = np.log((1 + len(x)) / (1 + (x > 0).sum(axis=0))).astype(np.float32) + 1
    x *= idf
    _, vectors = np.linalg.eigh((x.T @ x).astype(np.float64))
    basis = np.ascontiguousarray(vectors[:, ::-1][:, :DIMENSIONS] * idf[:, None].astype(np.float64), np.float32)
    refs = x @ (basis / idf[:, None])
    refs /= np.maximum(np.linalg.norm(refs, axis=1, keepdims=True), 1e-9)
    seen = {v: max(1, int((y == v).sum())) for v in sizes}
    weight = np.array([sizes[int(v)] / seen[int(v)] for v in y], np.float32)
    return {"share": share, "basis": basis, "refs": refs, "y": y, "weight": weight}


def score(model: dict, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    n = len(offsets) - 1
    refs = model["refs"]
    if not len(refs):
        return np.full(n, model["share"])
    x = terms(data, offsets) @ model["basis"]
    norm = np.linalg.norm(x, axis=1, keepdims=True)
    cosine = (x / np.maximum(norm, 1e-9)) @ refs.T
    k = min(NEIGHBOURS, len(refs))
    near = np.argpartition(-cosine, k - 1, axis=1)[:, :k]
    vote = np.maximum(np.take_along_axis(cosine, near, axis=1), 1e-6).astype(np.float64) ** POWER * model["weight"][near]
    out = (vote * model["y"][near]).sum(axis=1) / vote.sum(axis=1)
    return np.where(norm[:, 0] > 1e-9, np.clip(out, 0, 1), model["share"])


def scored(docs: DataFrame, model: dict, keep: Sequence[str] | None = None) -> DataFrame:
    """row (a struct of the columns of docs, or of those of `keep`) and score, for every row. A text that is kept
    goes to the workers once, inside its row."""
    shared = prepare(docs.sparkSession).sparkContext.broadcast(model)
    names = list(keep or docs.columns)
    wide = docs.select(F.struct(*(keep or ["*"])).alias("row"), *([] if "text" in names else ["text"]))
    place = names.index("text") if "text" in names else None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            text = batch.column("text") if place is None else pc.struct_field(batch.column("row"), [place])
            for part in slices(pa.RecordBatch.from_arrays([batch.column("row"), text], ["row", "text"]), BLOCK):
                s = score(shared.value, *text_bytes(part.column("text")))
                yield pa.RecordBatch.from_arrays([part.column("row"), pa.array(s, pa.float64())], ["row", "score"])

    return wide.mapInArrow(run, T.StructType([wide.schema["row"], T.StructField("score", T.DoubleType())]))


def good_documents(docs: DataFrame, model: dict, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of docs that score at least the threshold."""
    return scored(docs, model).where(F.col("score") >= threshold).select("row.*")


def model_of(spark: SparkSession, docs: DataFrame, sf_dir: str) -> dict:
    """Fitted on docs and labels.quality, without the rows whose crc32(doc_id) mod 5 is 0."""
    labels = read(spark, sf_dir, "labels").where(fold("doc_id", 5) != 0).select("doc_id", F.col("quality").alias("label"))
    return fit(docs, labels)


def op7_quality_knn(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select(F.col("doc_id").cast("long"), "text")
    found = scored(docs, model_of(spark, docs, sf_dir), ["doc_id"]).select("row.doc_id", "score")
    return found.select("doc_id", (fold("doc_id", 5) == 0).alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
