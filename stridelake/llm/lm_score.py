"""Cross-entropy difference of documents under a target and a background n-gram model.

Both are bigram models of the same form over one vocabulary: the words of the whole corpus, and one class for
words outside it. The background model counts every document, the target model every document of the target
set. Probabilities interpolate the bigram's relative frequency with an additively smoothed unigram. A
document's score is its mean loss per token under the target model less that under the background model: the
lower, the more it is like the target.

`cross_entropy` fits on a table and scores the same table with every word and every bigram; nothing of the
models is collected or broadcast.

- Hashes of words and bigrams count with 56 bits: of 10^12 bigrams one in 70,000 shares another's.
- Each task cuts its documents into chunks of about CHUNK tokens, which are stored: documents, distinct words, and
  tokens as positions among these. A chunk's distinct words and bigrams go, with its own counts, to parts of the range of their hashes. There are as many parts as the text has times
  PART_BYTES, so that a part's size stays the same as the corpus grows; a key comes once a chunk at most.
- A part sums its keys over all chunks and sends each chunk the totals of the keys that it sent, in their order.
- The stored chunk meets these totals and gives the losses.

`fit` and `score` are for other documents than the model's own: a broadcast model of at most VOCABULARY words
and BIGRAMS bigrams, the smallest count that fits being the cut-off. The query doesn't use them.

Defined cases: null and empty texts, and those without words, have 0 tokens, losses 0 and score 0; without
target documents the target model is uniform; repeated rows count as often as they occur; of the target
ids null is none; in `fit`, ties at a cut-off are all left out; an empty table gives an empty result; further
columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stridelake.llm.common import fits, materialize, mix64, most_frequent, prepare, read, slices, word_hashes
from stridelake.llm.language_id import fold

VOCABULARY, BIGRAMS = 1 << 15, 1 << 20
BIGRAM_SHARE, SMOOTH = 0.6, 0.5
#: Distinct keys that a task holds before it sends them on.
HELD = 1_500_000
#: Tokens (or rows) of a chunk, unless one slice has more; bytes of text for each part of the keys.
CHUNK, PART_BYTES = 600_000, 4 << 20
#: Bits of a word's or bigram's hash that count; the others are zeros, which take no room.
KEPT_BITS = np.uint64((1 << 64) - (1 << 8))
#: Stands before a document's first word.
START = np.uint64(0xA0761D6478BD642F) & KEPT_BITS
RESULT = "doc_id long, n_tokens long, target_loss double, background_loss double, score double"


def _summed(keys: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys with the sums of their counts (n by 2)."""
    k, c = np.concatenate(keys), np.concatenate(counts)
    order = np.argsort(k, kind="stable")
    k, c = k[order], c[order]
    starts = np.flatnonzero(np.concatenate([[True], k[1:] != k[:-1]])) if len(k) else np.zeros(0, np.int64)
    return (k[starts], np.add.reduceat(c, starts, axis=0)) if len(k) else (k, c)


def counted(docs: DataFrame, keys) -> DataFrame:
    """key, target, background: sums over all rows of docs (text, target). keys(row, hashes) gives each event's
    position among the words, and its key."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []
        sums: list[np.ndarray] = []

        def out() -> Iterator[pa.RecordBatch]:
            k, c = _summed(held, sums)
            for i in range(0, len(k), 100_000):
                yield pa.RecordBatch.from_arrays([pa.array(k[i : i + 100_000]), pa.array(c[i : i + 100_000, 0]), pa.array(c[i : i + 100_000, 1])], ["key", "target", "background"])
            held.clear()
            sums.clear()

        for batch in (part for whole in batches for part in slices(whole, 4096, 2 << 20)):
            row, h = word_hashes(batch.column("text"))
            if not len(h):
                continue
            at, key = keys(row, h)
            target = batch.column("target").to_numpy(zero_copy_only=False).astype(np.int64)[row[at]]
            k, c = _summed([key], [np.stack([target, np.ones(len(key), np.int64)], axis=1)])
            held.append(k)
            sums.append(c)
            if sum(map(len, held)) > HELD:
                k, c = _summed(held, sums)
                held[:], sums[:] = [k], [c]
                if len(k) > HELD // 2:
                    yield from out()
        if held:
            yield from out()

    parts = docs.select("text", "target").mapInArrow(run, "key long, target long, background long")
    return materialize(parts.groupBy("key").agg(F.sum("target").alias("target"), F.sum("background").alias("background")), "lm-counts")


class Vocabulary:
    """Ids of words by their hash: 0 for others, then by sorted hash; `size` is one more than the words."""

    def __init__(self, hashes: np.ndarray) -> None:
        self.hashes = np.sort(hashes.astype(np.int64))
        self.size = len(self.hashes) + 1

    def __call__(self, h: np.ndarray) -> np.ndarray:
        h = h.view(np.int64)
        if not len(self.hashes):
            return np.zeros(len(h), np.int64)
        at = np.minimum(np.searchsorted(self.hashes, h), len(self.hashes) - 1)
        return np.where(self.hashes[at] == h, at + 1, 0)


def bigram_keys(ids: np.ndarray, row: np.ndarray, size: int) -> np.ndarray:
    """Key of each word with the one before it; `size` stands before a document's first."""
    before = np.full(len(ids), size, np.int64)
    before[1:] = np.where(row[1:] == row[:-1], ids[:-1], size)
    return before * (size + 1) + ids


def fit(docs: DataFrame, vocabulary: int = VOCABULARY, bigrams: int = BIGRAMS) -> dict:
    """Both models, from docs (text, target)."""
    spark = prepare(docs.sparkSession)
    words = counted(docs, lambda row, h: (np.arange(len(h)), h.view(np.int64)))
    kept = most_frequent(words, "background", vocabulary).toArrow().to_pandas().sort_values("key")
    totals = words.agg(F.sum("target"), F.sum("background")).first()
    total = np.array([totals[0] or 0, totals[1] or 0], np.float64)
    vocab = Vocabulary(kept["key"].to_numpy())
    single = np.zeros((vocab.size, 2))
    single[1:] = kept[["target", "background"]].to_numpy()
    single[0] = total - single[1:].sum(axis=0)
    unigram = (single + SMOOTH) / (total + SMOOTH * vocab.size)
    shared = spark.sparkContext.broadcast(vocab)

    def pairs(row: np.ndarray, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        v = shared.value
        return np.arange(len(h)), bigram_keys(v(h), row, v.size)

    both = counted(docs, pairs)
    before = F.floor(F.col("key") / (vocab.size + 1)).cast("int")
    history = np.zeros((vocab.size + 1, 2))
    sums = both.groupBy(before.alias("h")).agg(F.sum("target").alias("t"), F.sum("background").alias("b")).toArrow().to_pandas()  # a row per word of the vocabulary
    history[sums["h"].to_numpy()] = sums[["t", "b"]].to_numpy()
    table = most_frequent(both, "background", bigrams).toArrow().to_pandas().sort_values("key")
    key = table["key"].to_numpy()
    share = table[["target", "background"]].to_numpy() / np.maximum(history[key // (vocab.size + 1)], 1)
    return {"vocabulary": vocab, "unigram": unigram.astype(np.float32), "seen": history > 0, "key": key, "share": share.astype(np.float32)}


def losses(model: dict, row: np.ndarray, h: np.ndarray) -> np.ndarray:
    """Loss (negative natural log) of each word under target and background, n by 2."""
    vocab, key = model["vocabulary"], model["key"]
    ids = vocab(h)
    mine = bigram_keys(ids, row, vocab.size)
    share = np.zeros((len(ids), 2), np.float32)
    if len(key):
        at = np.minimum(np.searchsorted(key, mine), len(key) - 1)
        hit = key[at] == mine
        share[hit] = model["share"][at[hit]]
    weight = np.where(model["seen"][mine // (vocab.size + 1)], np.float32(BIGRAM_SHARE), np.float32(0))
    return -np.log(weight * share + (1 - weight) * model["unigram"][ids])


def score(docs: DataFrame, model: dict) -> DataFrame:
    """doc_id, n_tokens, target_loss, background_loss, score: a row per row of docs (doc_id, text)."""
    shared = prepare(docs.sparkSession).sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (part for whole in batches for part in slices(whole)):
            row, h = word_hashes(batch.column("text"))
            n = np.bincount(row, minlength=batch.num_rows)
            each = losses(shared.value, row, h) if len(h) else np.zeros((0, 2))
            mean = np.stack([np.bincount(row, weights=each[:, i], minlength=batch.num_rows) for i in (0, 1)]) / np.maximum(n, 1)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(n.astype(np.int64)), pa.array(mean[0]), pa.array(mean[1]), pa.array(mean[0] - mean[1])], ["doc_id", "n_tokens", "target_loss", "background_loss", "score"])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, RESULT)


def with_target(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """doc_id, text, target: whether the document is one of ids (doc_id). The rows of a partition come in the same
    order whenever it is computed."""
    chosen = materialize(ids.where(F.col("doc_id").isNotNull()).select(F.col("doc_id").cast("long").alias("_id")).distinct(), "lm-target")
    plain = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    small = fits(chosen)
    side = F.broadcast(chosen) if small else chosen
    joined = plain.join(side, F.col("doc_id") == F.col("_id"), "left").select("doc_id", "text", F.col("_id").isNotNull().alias("target"))
    return joined if small else materialize(joined, "lm-documents")


def pack(*arrays: np.ndarray) -> bytes:
    """Arrays of 64-bit integers, compressed by planes of bytes."""
    planes = b"".join(np.ascontiguousarray(a.view(np.uint8).reshape(-1, 8).T).tobytes() for a in arrays)
    return np.array([len(a) for a in arrays], np.int64).tobytes() + pa.compress(planes, codec="zstd", asbytes=True)


def unpack(body: bytes, n: int) -> list[np.ndarray]:
    """The n arrays of a pack, as int64."""
    lengths = np.frombuffer(body, np.int64, n)
    planes = np.frombuffer(pa.decompress(body[8 * n :], int(lengths.sum()) * 8, codec="zstd", asbytes=True), np.uint8)
    ends = np.cumsum(lengths) * 8
    return [np.ascontiguousarray(planes[e - 8 * k : e].reshape(8, -1).T).view(np.int64).ravel() for e, k in zip(ends.tolist(), lengths.tolist(), strict=True)]


class Chunk:
    """Distinct words and bigrams of a chunk. words: its distinct words' hashes, sorted; ids: the position there
    of each token; row: the document of each token."""

    def __init__(self, words: np.ndarray, ids: np.ndarray, row: np.ndarray) -> None:
        size = len(words)
        self.words = np.append(words, START)
        self.pairs, self.at = np.unique(bigram_keys(ids, row, size), return_inverse=True) if len(ids) else (np.zeros(0, np.int64), np.zeros(0, np.int64))
        self.before, self.word = (x.astype(np.int32) for x in np.divmod(self.pairs, size + 1))
        with np.errstate(over="ignore"):
            self.hashes = mix64(self.words[self.before] * np.uint64(0x9FB21C651E98DF25) + self.words[self.word]) & KEPT_BITS
        self.pair_order, self.word_order = np.argsort(self.hashes, kind="stable"), np.argsort(self.words, kind="stable")

    def events(self, target: np.ndarray) -> tuple[np.ndarray, list[np.ndarray], np.ndarray, list[np.ndarray]]:
        """Sorted hashes of bigrams with their counts, and of words with theirs and those as a history; each
        under target and background. target: 1 for each token of a target document, else 0."""
        both = [np.bincount(self.at, weights=target, minlength=len(self.pairs)), np.bincount(self.at, minlength=len(self.pairs))]
        single = [np.bincount(of, weights=c, minlength=len(self.words)) for of in (self.word, self.before) for c in both]
        i, j = self.pair_order, self.word_order
        return self.hashes[i], [c.astype(np.int64)[i] for c in both], self.words[j], [c.astype(np.int64)[j] for c in single]

    def losses(self, both: list[np.ndarray], single: list[np.ndarray], size: int, total: np.ndarray) -> np.ndarray:
        """Loss of each token under target and background, 2 by n, from the totals of events() over all chunks,
        the number of words and that of tokens."""
        out = np.zeros((2, len(self.at)))
        for m in (0, 1):
            count, word, before = np.zeros(len(self.pairs)), np.zeros(len(self.words)), np.zeros(len(self.words))
            count[self.pair_order], word[self.word_order], before[self.word_order] = both[m], single[m], single[m + 2]
            seen = before[self.before]
            unigram = (word[self.word] + SMOOTH) / (total[m] + SMOOTH * size)
            weight = np.where(seen > 0, BIGRAM_SHARE, 0)
            out[m] = -np.log(weight * count / np.maximum(seen, 1) + (1 - weight) * unigram)[self.at]
        return out


def cuts(hashes: np.ndarray, parts: int) -> np.ndarray:
    """Where each part's share of sorted hashes begins, and the end."""
    return np.searchsorted((hashes >> np.uint64(32)) * np.uint64(parts) >> np.uint64(32), np.arange(parts + 1).astype(np.uint64))


def chunks_of(docs: DataFrame, size: int) -> DataFrame:
    """From (doc_id, text, target): chunk, body. A body holds a chunk's documents, their targets, its distinct words
    and its tokens as positions among these."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, done = TaskContext.get().partitionId(), 0
        held: list[tuple] = []

        def out() -> pa.RecordBatch:
            tokens = np.concatenate([n for _, n, _ in held])
            doc_id, target = (pa.chunked_array([part.column(c) for part, _, _ in held]) for c in ("doc_id", "target"))
            words, ids = np.unique(np.concatenate([h for _, _, h in held]) & KEPT_BITS, return_inverse=True)
            held.clear()
            flags = doc_id.is_valid().to_numpy().astype(np.int64) + 2 * target.to_numpy().astype(np.int64)
            body = pack(doc_id.fill_null(0).to_numpy(), flags, tokens.astype(np.int64), np.diff(words, prepend=np.uint64(0)), ids.astype(np.int64))
            return pa.RecordBatch.from_arrays([pa.array([task << 32 | done], pa.int64()), pa.array([body], pa.binary())], ["chunk", "body"])

        rows = tokens = 0
        for part in (part for whole in batches for part in slices(whole, 4096, 2 << 20)):
            row, h = word_hashes(part.column("text"))
            held.append((part.select(["doc_id", "target"]), np.bincount(row, minlength=part.num_rows), h))
            rows, tokens = rows + part.num_rows, tokens + len(h)
            if max(rows, tokens) >= size:
                yield out()
                rows, tokens, done = 0, 0, done + 1
        if held:
            yield out()

    return docs.select("doc_id", "text", "target").mapInArrow(run, "chunk long, body binary")


def opened(body: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, Chunk]:
    """doc_id, flags (1: has a doc_id, 2: is a target) and tokens of a chunk's documents, the document of each
    token, and the chunk."""
    doc_id, flags, tokens, words, ids = unpack(body, 5)
    row = np.repeat(np.arange(len(tokens)), tokens)
    return doc_id, flags, tokens, row, Chunk(np.cumsum(words).view(np.uint64), ids, row)


def events_of(chunks: DataFrame, parts: int) -> DataFrame:
    """From (chunk, body): chunk, part, body, the chunk's events that fall into each part of the key range."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for number, body in ((n.as_py(), b) for batch in batches for n, b in zip(batch.column("chunk"), batch.column("body"), strict=True)):
            _, flags, _, row, chunk = opened(body.as_py())
            pair, both, word, single = chunk.events((flags >> 1).astype(np.float64)[row])
            a, b = cuts(pair, parts).tolist(), cuts(word, parts).tolist()
            found = []
            for p in range(parts):
                i, j = slice(a[p], a[p + 1]), slice(b[p], b[p + 1])
                if i.start < i.stop or j.start < j.stop:
                    found.append((p, pack(np.diff(pair[i], prepend=np.uint64(0)), *[c[i] for c in both], np.diff(word[j], prepend=np.uint64(0)), *[c[j] for c in single])))
            for k in range(0, len(found), 1000):
                some = found[k : k + 1000]
                yield pa.RecordBatch.from_arrays([pa.array([number] * len(some), pa.int64()), pa.array([p for p, _ in some], pa.int64()), pa.array([body for _, body in some], pa.binary())], ["chunk", "part", "body"])

    return chunks.mapInArrow(run, "chunk long, part long, body binary")


def _totals(events: DataFrame) -> DataFrame:
    """chunk, part, body: the totals of the events that the chunk sent to the part.
    words, target, background: on one row of each part, its number of words and of their tokens."""

    def run(table: pa.Table) -> pa.Table:
        packs = [unpack(b, 8) for b in table.column("body").to_pylist()]
        sums: list[list[np.ndarray]] = []
        facts = [0, 0, 0]
        for first, counts in ((0, 2), (3, 4)):
            sizes = np.cumsum([len(p[first]) for p in packs])[:-1]
            keys, at = np.unique(np.concatenate([np.cumsum(p[first]).view(np.uint64) for p in packs]), return_inverse=True)
            for c in range(first + 1, first + 1 + counts):
                total = np.zeros(len(keys), np.int64)
                np.add.at(total, at, np.concatenate([p[c] for p in packs]))
                sums.append(np.split(total[at], sizes))
                if first and c < first + 3:
                    facts[c - first] = int(total.sum())
                    facts[0] = int((total > 0).sum())  # of the background, which has all words; START is none
        n = table.num_rows
        of = [pa.array([v, *[0] * (n - 1)], pa.int64()) for v in facts]
        return pa.table([table.column("chunk"), table.column("part"), pa.array([pack(*each) for each in zip(*sums, strict=True)], pa.binary()), *of], ["chunk", "part", "body", "words", "target", "background"])

    return events.groupBy("part").applyInArrow(run, "chunk long, part long, body binary, words long, target long, background long")


def cross_entropy(docs: DataFrame, chunk: int = CHUNK, part_bytes: int = PART_BYTES) -> DataFrame:
    """doc_id, n_tokens, target_loss, background_loss, score: a row per row of docs (doc_id, text, target), under the
    models of docs with all their words and bigrams. Chunks are stored first, so that both passes over them see the
    same ones whatever is run again."""
    prepare(docs.sparkSession)
    chunks = materialize(chunks_of(docs, chunk), "lm-chunks")
    nbytes = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    totals = materialize(_totals(events_of(chunks, 1 + nbytes // part_bytes)), "lm-totals")
    facts = [v or 0 for v in totals.agg(F.sum("words"), F.sum("target"), F.sum("background")).first()]
    size, total = facts[0] + 1, np.array(facts[1:], np.float64)

    def run(mine: pa.Table, sums: pa.Table) -> pa.Table:
        doc_id, flags, tokens, row, one = opened(mine.column("body")[0].as_py())
        bodies = sorted(zip(sums.column("part").to_pylist(), sums.column("body").to_pylist(), strict=True))
        back = [np.concatenate(c) for c in zip(*[unpack(body, 6) for _, body in bodies], strict=True)]
        mean = [np.bincount(row, weights=e, minlength=len(tokens)) / np.maximum(tokens, 1) for e in one.losses(back[:2], back[2:], size, total)]
        return pa.table([pa.array(doc_id, mask=flags & 1 == 0), pa.array(tokens), pa.array(mean[0]), pa.array(mean[1]), pa.array(mean[0] - mean[1])], ["doc_id", "n_tokens", "target_loss", "background_loss", "score"])

    return chunks.groupBy("chunk").cogroup(totals.select("chunk", "part", "body").groupBy("chunk")).applyInArrow(run, RESULT)


def op6_lm_cross_entropy(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Target: documents labelled of good quality and not toxic, without those whose crc32(doc_id) mod 5 is 0."""
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    good = read(spark, sf_dir, "labels").where((F.col("quality") == 1) & (F.col("toxic") == 0) & (fold("doc_id", 5) != 0))
    return cross_entropy(with_target(docs, good))
