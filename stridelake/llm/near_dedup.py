"""Near-duplicate detection by improved consistent weighted sampling over TF-IDF shingles.

Features of a text are its SHINGLE-word shingles, the second occurrence of a shingle being a feature of
its own (so weights min and max as term frequencies do), each weighted by inverse document frequency.
Each of SAMPLES improved consistent weighted samples agrees between two texts with the probability of
their weighted Jaccard similarity. Samples are banded; texts that share a band are compared by exact
weighted Jaccard similarity, and links of at least SIMILARITY join texts into classes.

- Words: lower-cased runs of ASCII letters, digits and bytes of other scripts. A text of fewer than
  SHINGLE words is one shingle.
- IDF: ln(1 + (N + 100) / df), relative to that of the rarest shingles; N counts distinct texts, df those that
  have the shingle. What fewer than a share of 1 / COUNTERS of all (text, shingle) pairs hold counts as rare, df
  being that share, at least 1: at up to COUNTERS pairs this is no shingle, and at any size at most COUNTERS
  shingles are more frequent, whose exact df are broadcast. Lossy counting in each task finds all that may be
  (a superset, as no task's error is over half the share), and a second pass counts those exactly.
- Texts that are equal are one text from the start. Of buckets with the same members one is compared.
- A bucket is searched exactly, inside one task: a text is compared with all that it is not linked to
  yet, until no unlinked pair is left; only a spanning forest of links comes out, never all pairs.
- A bucket whose texts have more than BUCKET features is split into shards that each hold its hubs, the texts nearest to
  the bucket's most common samples; texts that no hub links are then compared with every shard, in blocks.

Defined cases: a null text counts as empty; texts without words are in the class of their exact copies;
the document with the smallest doc_id of a class stays (null being the smallest), and one of rows that tie
in doc_id and text; an empty table gives an empty result; further columns are kept by drop_near_copies.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from stridelake.llm.common import fits, materialize, mix64, packed, prepare, read, slices, small_or_shuffled, word_hashes
from stridelake.llm.components import components

SHINGLE, SIMILARITY, BANDS, ROWS = 5, 0.8, 14, 3
SAMPLES = BANDS * ROWS
#: Most features that the texts of a bucket may have together to be compared by one task.
BUCKET, HUBS = 1 << 21, 4
#: Most shingles whose document frequencies are broadcast, texts added to their number, and distinct shingles that
#: a task counts before it leaves out rare ones.
COUNTERS, PSEUDO, HELD = 1 << 19, 100, 500_000
#: Bytes of text that a task counts for each counter, about: the more, the fewer rare shingles it puts out.
COUNTED_BYTES = 24
#: Quantiles in the tables of the two gamma-distributed variables.
TABLE_BITS = 17
NO_ID = -(1 << 63)


def shingles(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For a batch of up to 256 texts: the row of each feature, its shingle's hash (56 bits) and its occurrence
    number in the text, ordered by row and shingle."""
    n = len(column)
    row, words = word_hashes(column)
    if not len(words):
        empty = np.zeros(0, np.int64)
        return empty, empty.astype(np.uint64), empty
    per = np.bincount(row, minlength=n)
    first = np.concatenate([[0], np.cumsum(per)])
    padded = np.concatenate([words, np.zeros(SHINGLE - 1, np.uint64)])
    left = first[row + 1] - np.arange(len(words))  # words from here to the text's end
    with np.errstate(over="ignore"):
        h = np.zeros(len(words), np.uint64)
        for i in range(SHINGLE):
            h = h * np.uint64(0x9FB21C651E98DF25) + np.where(left > i, padded[i : i + len(words)], np.uint64(i + 1))
    take = (left >= SHINGLE) | (np.arange(len(words)) == first[row])
    key = (row[take].astype(np.uint64) << np.uint64(56)) | (mix64(h[take]) >> np.uint64(8))
    key.sort()
    new = np.ones(len(key), bool)
    new[1:] = key[1:] != key[:-1]
    at = np.arange(len(key))
    occurrence = at - np.maximum.accumulate(np.where(new, at, 0))
    return (key >> np.uint64(56)).astype(np.int64), key & np.uint64((1 << 56) - 1), occurrence


class LossyCounter:
    """Counts of distinct keys in bounded memory. A key that is missing, and a count that is short, lack at most
    seen / (2 counters) events, `seen` being the number of all events."""

    def __init__(self, counters: int, held: int = HELD) -> None:
        self.counters, self.held, self.seen, self.bound = counters, held, 0, 0
        self.waiting: list[np.ndarray] = []
        self.keys, self.counts, self.short = np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64)

    def add(self, keys: np.ndarray) -> None:
        self.waiting.append(keys)
        self.seen += len(keys)
        if sum(map(len, self.waiting)) > self.held:
            self.merge()

    def merge(self) -> None:
        """Adds what waits, and leaves out keys whose count may be within the error."""
        new, n = np.unique(np.concatenate([np.zeros(0, np.uint64), *self.waiting]), return_counts=True)
        self.waiting = []
        keys = np.concatenate([self.keys, new])
        counts = np.concatenate([self.counts, n])
        short = np.concatenate([self.short, np.full(len(new), self.bound)])
        order = np.argsort(keys, kind="stable")
        keys, counts, short = keys[order], counts[order], short[order]
        starts = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.zeros(0, np.int64)
        if len(keys):
            keys, counts, short = keys[starts], np.add.reduceat(counts, starts), np.minimum.reduceat(short, starts)
        self.bound = self.seen // (2 * self.counters)
        stays = counts + short > self.bound
        self.keys, self.counts, self.short = keys[stays], counts[stays], short[stays]


class Idf:
    """ln of a shingle's weight: 0 for rare ones."""

    def __init__(self, shingle: np.ndarray, df: np.ndarray, n: int, floor: float) -> None:
        order = np.argsort(shingle)
        self.shingle = shingle[order]
        weight = np.log1p((n + PSEUDO) / np.maximum(df[order], floor)) / np.log1p((n + PSEUDO) / floor)
        self.log = np.log(weight).astype(np.float32)
        self.maybe = np.zeros(1 << 22, bool)  # by the low bits, so that most rare shingles take one look
        self.maybe[(self.shingle & np.uint64((1 << 22) - 1)).astype(np.int64)] = True

    def __call__(self, shingle: np.ndarray) -> np.ndarray:
        out = np.zeros(len(shingle), np.float32)
        look = np.flatnonzero(self.maybe[(shingle & np.uint64((1 << 22) - 1)).astype(np.int64)])
        if len(look):
            some = shingle[look]
            at = np.minimum(np.searchsorted(self.shingle, some), len(self.shingle) - 1)
            hit = self.shingle[at] == some
            out[look[hit]] = self.log[at[hit]]
        return out


def document_frequencies(texts: DataFrame, n: int, nbytes: int, counters: int = COUNTERS) -> Idf:
    """The weights over all rows of texts (text), which number n and have about nbytes together."""
    spark = texts.sparkSession
    tasks = 1 + nbytes // (COUNTED_BYTES * counters)

    def candidates(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = LossyCounter(counters)
        for part in (part for batch in batches for part in slices(batch)):
            _, shingle, occurrence = shingles(part.column("text"))
            count.add(shingle[occurrence == 0])
        count.merge()
        yield pa.RecordBatch.from_arrays([pa.array([-1]), pa.array([count.seen], pa.int64())], ["shingle", "n"])
        for i in range(0, len(count.keys), 100_000):
            yield pa.RecordBatch.from_arrays([pa.array(count.keys[i : i + 100_000].astype(np.int64)), pa.array(count.counts[i : i + 100_000])], ["shingle", "n"])

    schema = "shingle long, n long"
    found = materialize(texts.select("text").coalesce(tasks).mapInArrow(candidates, schema).groupBy("shingle").agg(F.sum("n").alias("n")), "shingle-candidates")
    total = found.where("shingle = -1").agg(F.sum("n")).first()[0] or 0
    floor = max(1.0, total / counters)
    likely = found.where((F.col("shingle") >= 0) & (F.col("n") >= total / (2 * counters)))  # at most 2 x counters rows
    wanted = np.sort(likely.select("shingle").toArrow().column(0).to_numpy())
    shared = spark.sparkContext.broadcast(wanted.astype(np.uint64))

    def exact(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys = shared.value
        counts = np.zeros(len(keys), np.int64)
        for part in (part for batch in batches for part in slices(batch)):
            _, shingle, occurrence = shingles(part.column("text"))
            once = np.sort(shingle[occurrence == 0])
            if len(keys) and len(once):
                at = np.minimum(np.searchsorted(keys, once), len(keys) - 1)
                counts += np.bincount(at[keys[at] == once], minlength=len(keys))
        has = np.flatnonzero(counts)
        for i in range(0, len(has), 100_000):
            some = has[i : i + 100_000]
            yield pa.RecordBatch.from_arrays([pa.array(keys[some].astype(np.int64)), pa.array(counts[some])], ["shingle", "n"])

    counted = texts.select("text").mapInArrow(exact, schema).groupBy("shingle").agg(F.sum("n").alias("n")).where(F.col("n") >= floor)
    table = materialize(counted, "shingle-frequencies").toArrow()  # at most `counters` rows
    return Idf(table.column("shingle").to_numpy().astype(np.uint64), table.column("n").to_numpy(), n, floor)


def features(column: pa.Array, idf: Idf) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row, hash and ln weight of each feature of a batch, ordered by row."""
    row, shingle, occurrence = shingles(column)
    with np.errstate(over="ignore"):
        f = mix64(shingle + occurrence.astype(np.uint64) * np.uint64(0xC2B2AE3D27D4EB4F))
    return row, f, idf(shingle)


_TABLES: list[np.ndarray] = []


def gamma_tables() -> list[np.ndarray]:
    """Quantiles of Gamma(2, 1) and their logarithms, at the middle of equal shares."""
    if not _TABLES:
        p = (np.arange(1 << TABLE_BITS) + 0.5) / (1 << TABLE_BITS)
        x = np.where(p < 0.5, np.sqrt(2 * p), 1.7 - np.log1p(-p))
        for _ in range(60):  # Newton's method on 1 - (1 + x) exp(-x) = p
            x = np.maximum(x - (-np.expm1(-x) - x * np.exp(-x) - p) / (x * np.exp(-x)), x / 4)
        _TABLES.extend([x.astype(np.float32), np.log(x).astype(np.float32)])
    return _TABLES


def weighted_samples(row: np.ndarray, f: np.ndarray, weight: np.ndarray, n: int, samples: int = SAMPLES) -> np.ndarray:
    """Improved consistent weighted samples, n rows by `samples`, each the hash of the feature and the level
    that it is drawn at; rows without features get zeros. weight: ln of the features' weights. A row's samples
    depend on its own features alone, not on the rows beside it.

    Of a feature's hash for a sample come r and c (both Gamma(2, 1)) and b (uniform). With t = floor(ln w / r
    + b) and ln y = r (t - b), the feature with the least ln c - ln y - r is drawn, at level t."""
    out = np.zeros((n, samples), np.int64)
    if not len(row):
        return out
    starts = np.flatnonzero(np.concatenate([[True], row[1:] != row[:-1]]))
    lengths, of = np.diff(np.append(starts, len(row))), row[starts]
    gamma, log_gamma = gamma_tables()
    low = np.uint64((1 << TABLE_BITS) - 1)
    other, full = np.flatnonzero(weight), np.zeros(len(f), np.float32)
    for k in range(samples):
        with np.errstate(over="ignore"):
            x = mix64(f ^ np.uint64((k + 1) * 0x9E3779B97F4A7C15 & (1 << 64) - 1))
        r, b = gamma[(x & low).view(np.int64)], (x >> np.uint64(44)).astype(np.float32) * np.float32(2.0**-20)
        a = log_gamma[((x >> np.uint64(TABLE_BITS)) & low).view(np.int64)] + r * (b - 1)
        level = np.floor(weight[other] / r[other] + b[other])  # where the weight is 1, it is 0
        a[other] -= r[other] * level
        least = np.minimum.reduceat(a, starts)
        hit = np.flatnonzero(a == np.repeat(least, lengths))[::-1]
        chosen = np.zeros(n, np.int64)
        chosen[row[hit]] = hit  # the first one of a tie
        full[other] = level
        with np.errstate(over="ignore"):
            drawn = mix64(f[chosen[of]] + full[chosen[of]].astype(np.int64).view(np.uint64) * np.uint64(0xD6E8FEB86659FD93))
        out[of, k] = drawn.view(np.int64)
    return out


def text_digest(text: Column) -> Column:
    return F.substring(F.unhex(F.sha2(F.coalesce(text, F.lit("")).cast("binary"), 256)), 1, 16)


def representatives(docs: DataFrame, texts: DataFrame) -> DataFrame:
    """digest, text of one document for each of texts (digest, rep_id, again, rows)."""
    keyed = docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)).alias("id"), "text", text_digest(F.col("text")).alias("digest"))
    copied = materialize(texts.where("rows > 1").select(F.col("digest").alias("_digest"), "rep_id", "again"), "near-copied")
    small = fits(copied)
    joined = keyed.join(F.broadcast(copied) if small else copied, F.col("digest") == F.col("_digest"), "left").where("rep_id IS NULL OR rep_id = id")
    if (copied.agg(F.max("again")).first()[0] or 1) > 1:  # rows that are repeated, id and text
        joined = joined.where("coalesce(again, 1) = 1").unionByName(joined.where("again > 1").dropDuplicates(["digest"]))
        small = False
    one = joined.select("digest", "text")
    return one if small else materialize(one, "near-representatives")


def signatures(reps: DataFrame, idf) -> DataFrame:
    """digest, features (their number), samples."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                row, f, weight = features(part.column("text"), idf.value)
                drawn = weighted_samples(row, f, weight, part.num_rows)
                has = np.bincount(row, minlength=part.num_rows)
                flat = pa.ListArray.from_arrays(pa.array(np.arange(part.num_rows + 1) * SAMPLES, pa.int32()), pa.array(drawn.ravel()))
                yield pa.RecordBatch.from_arrays([part.column("digest"), pa.array(has), flat], ["digest", "features", "samples"])

    return reps.select("digest", "text").mapInArrow(run, "digest binary, features long, samples array<long>")


def band_key(band: Column, samples: Column) -> Column:
    return F.xxhash64(band, *[F.element_at(samples, (band * ROWS + i + 1).cast("int")) for i in range(ROWS)])


def buckets(texts: DataFrame) -> DataFrame:
    """From (digest, features, samples): bucket, total (of features), digest for buckets of two texts and more,
    one of those with the same members."""
    bands = texts.select("digest", "features", F.posexplode(F.array(*[band_key(F.lit(b), F.col("samples")) for b in range(BANDS)]))).select(F.col("col").alias("bucket"), "digest", "features")
    bands = materialize(bands, "bands")
    member = F.xxhash64("digest", F.lit(1)).cast("decimal(38,0)")
    sets = bands.groupBy("bucket").agg(F.count("*").alias("size"), F.sum("features").alias("total"), F.sum(member).alias("sum"), F.bit_xor(F.xxhash64("digest", F.lit(2))).alias("xor")).where("size > 1")
    once = materialize(sets.groupBy("size", "sum", "xor").agg(F.min(F.struct("bucket", "total")).alias("b")).select("b.*"), "buckets")
    return bands.join(small_or_shuffled(once), "bucket").select("bucket", "total", "digest", "features")


def packed_weights(weight: np.ndarray) -> bytes:
    """Places and values of the weights that aren't 1."""
    at = np.flatnonzero(weight != 1)
    return at.astype(np.int32).tobytes() + weight[at].astype(np.float32).tobytes()


def unpacked_weights(body: bytes, n: int) -> np.ndarray:
    out, k = np.ones(n, np.float32), len(body) // 8
    out[np.frombuffer(body, np.int32, k)] = np.frombuffer(body, np.float32, k, 4 * k)
    return out


def candidate_features(reps: DataFrame, members: DataFrame, idf) -> DataFrame:
    """digest, f, weight (packed, in the order of f) of the texts that share a bucket."""
    wanted = materialize(members.select("digest").distinct(), "candidates")
    chosen = reps.join(small_or_shuffled(wanted), "digest", "left_semi")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                row, f, weight = features(part.column("text"), idf.value)
                order = np.lexsort((f, row))
                row, f, weight = row[order], f[order], np.exp(weight[order])
                cut = np.searchsorted(row, np.arange(part.num_rows + 1)).tolist()
                ends = list(zip(cut[:-1], cut[1:], strict=True))
                yield pa.RecordBatch.from_arrays([part.column("digest"), pa.array([f[a:b].tobytes() for a, b in ends], pa.binary()), pa.array([packed_weights(weight[a:b]) for a, b in ends], pa.binary())], ["digest", "f", "weight"])

    return materialize(chosen.mapInArrow(run, "digest binary, f binary, weight binary"), "features")


def links_among(sets: list[np.ndarray], weights: list[np.ndarray | None], expand: np.ndarray | None = None, similarity: float = SIMILARITY) -> list[tuple[int, int]]:
    """A spanning forest of the links between texts, exactly.

    A text that is expanded is compared with all that aren't in its component. Without `expand`, the text
    that shares most goes first, and at the end only texts outside the largest component have to be. With it,
    the marked ones are expanded."""
    m = len(sets)
    lengths = np.array([len(s) for s in sets])
    starts = np.concatenate([[0], np.cumsum(lengths)])[:-1]
    _, inverse, counts = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    weight = np.concatenate([np.ones(len(s), np.float32) if w is None else w for s, w in zip(sets, weights, strict=True)])
    totals = np.add.reduceat(weight, starts).astype(np.float64)
    shared = np.add.reduceat(np.minimum(counts[inverse] - 1, m).astype(np.float64), starts)
    owner = np.repeat(np.arange(m), lengths)
    common = counts[inverse] > 1
    inverse, owner, weight = inverse[common], owner[common], weight[common]  # what occurs once can't be shared
    begin = np.searchsorted(owner, np.arange(m + 1))
    label = np.arange(m)
    mark = np.zeros(len(counts), np.float32)
    forest = []
    order = np.argsort(-shared, kind="stable")
    todo = order.tolist() if expand is None else np.flatnonzero(expand).tolist()
    while todo:
        v = todo[0]
        if expand is None:
            waiting = np.array(todo)
            sizes = np.bincount(label[waiting], minlength=m)
            most = int(sizes.argmax())
            if sizes[most] == len(todo):
                break  # any link left would be inside one component
            if sizes[most] > 1:
                v = int(waiting[np.argmax(label[waiting] != most)])
        todo.remove(v)
        mine = slice(begin[v], begin[v + 1])
        mark[inverse[mine]] = weight[mine]
        both = np.bincount(owner, weights=mark[inverse], minlength=m)
        mark[inverse[mine]] = 0
        near = np.flatnonzero((both >= similarity * (totals + totals[v] - both) - 1e-9) & (label != label[v]))
        for u in near.tolist():
            if label[u] != label[v]:
                forest.append((v, u))
                label[label == label[u]] = label[v]
    return forest


def _compare(groups: DataFrame, similarity: float) -> DataFrame:
    """Links (a, b) inside each group (key), from rows key, digest, f, weight, expand (null: all)."""

    def run(table: pa.Table) -> pa.Table:
        names = table.column("digest").to_pylist()
        sets = [np.frombuffer(x, np.uint64) for x in table.column("f").to_pylist()]
        weights = [unpacked_weights(x, len(own)) if x else None for x, own in zip(table.column("weight").to_pylist(), sets, strict=True)]
        marks = table.column("expand").to_pylist()
        expand = None if not marks or marks[0] is None else np.array(marks, bool)
        found = links_among(sets, weights, expand, similarity) if len(sets) > 1 else []
        return pa.table({"a": pa.array([names[a] for a, _ in found], pa.binary()), "b": pa.array([names[b] for _, b in found], pa.binary())})

    return groups.select("key", "digest", "f", "weight", "expand").groupBy("key").applyInArrow(run, "a binary, b binary")


def _compare_large(members: DataFrame, feats: DataFrame, texts: DataFrame, similarity: float, bucket: int) -> DataFrame:
    """Links in buckets that are too large for one task: through hubs first, then the rest against every shard."""
    half = max(1, bucket // 2)
    shards = F.ceil(F.col("total") / half).cast("int")
    members = materialize(members.withColumn("shards", shards).withColumn("shard", F.pmod(F.xxhash64("digest", F.lit(3)), F.col("shards")).cast("int")), "large")
    drawn = materialize(members.join(texts.select("digest", "samples"), "digest"), "large-samples")
    each = drawn.select("bucket", F.posexplode("samples").alias("k", "value")).groupBy("bucket", "k", "value").agg(F.count("*").alias("n"))
    common = each.groupBy("bucket", "k").agg(F.max(F.struct("n", "value"))["value"].alias("value")).groupBy("bucket").agg(F.map_from_entries(F.collect_list(F.struct("k", "value"))).alias("common"))
    agree = F.size(F.filter(F.transform("samples", lambda x, i: x == F.element_at("common", i)), lambda x: x))
    scored = drawn.join(small_or_shuffled(materialize(common, "large-common")), "bucket").withColumn("agree", agree)
    hubs = None
    for h in range(HUBS):  # the best of each of a few random parts, which takes no sort of a bucket
        best = scored.where(F.pmod(F.xxhash64("digest", F.lit(4)), F.lit(HUBS)) == h).groupBy("bucket").agg(F.max(F.struct("agree", "digest"))["digest"].alias("digest"), F.max("shards").alias("shards"))
        hubs = best if hubs is None else hubs.unionByName(best)
    hubs = materialize(hubs, "hubs")
    key = lambda *more: F.concat_ws(":", "bucket", *more)
    everywhere = hubs.withColumn("shard", F.explode(F.sequence(F.lit(0), F.col("shards") - 1)))
    inside = members.select("bucket", "shard", "digest").unionByName(everywhere.select("bucket", "shard", "digest")).distinct()
    first = materialize(_compare(inside.select(key("shard").alias("key"), "digest", F.lit(None).cast("boolean").alias("expand")).join(feats, "digest"), similarity), "large-links")
    linked = components(first)
    of_hubs = materialize(hubs.join(linked, hubs["digest"] == linked["node"]).select("bucket", "label").distinct(), "hub-labels")
    settled = members.join(linked, members["digest"] == linked["node"]).join(of_hubs.groupBy("bucket").agg(F.max("label").alias("main")), "bucket").where("label = main").select("bucket", "digest")
    rest = materialize(members.join(settled, ["bucket", "digest"], "left_anti"), "large-rest")
    block = F.pmod(F.xxhash64("digest", F.lit(5)), F.greatest(F.lit(1), F.ceil(F.col("left") / half))).cast("int")
    blocks = materialize(rest.join(small_or_shuffled(materialize(rest.groupBy("bucket").agg(F.sum("features").alias("left")), "large-left")), "bucket").withColumn("block", block), "large-blocks")
    if blocks.isEmpty():
        return first
    numbers = small_or_shuffled(materialize(blocks.groupBy("bucket").agg(F.max("block").alias("last")), "large-last"))
    a = members.join(numbers, "bucket").withColumn("block", F.explode(F.sequence(F.lit(0), "last"))).select("bucket", "shard", "block", "digest", F.lit(False).alias("expand"))
    b = blocks.drop("shard").withColumn("shard", F.explode(F.sequence(F.lit(0), F.col("shards") - 1))).select("bucket", "shard", "block", "digest", F.lit(True).alias("expand"))
    both = a.unionByName(b).groupBy("bucket", "shard", "block", "digest").agg(F.max("expand").alias("expand"))
    return first.unionByName(_compare(both.select(key("shard", "block").alias("key"), "digest", "expand").join(feats, "digest"), similarity))


def near_texts(docs: DataFrame, similarity: float = SIMILARITY, bucket: int = BUCKET, counters: int = COUNTERS) -> tuple[DataFrame, DataFrame]:
    """rows (doc_id, digest) and classes: digest, label, rep_id of distinct texts; label is shared by a class."""
    spark = prepare(docs.sparkSession)
    rows = materialize(docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)).alias("doc_id"), text_digest(F.col("text")).alias("digest"), F.coalesce(F.octet_length("text"), F.lit(0)).alias("size")), "near-rows")
    per = rows.groupBy("digest", "doc_id").agg(F.count("*").alias("n")).groupBy("digest").agg(F.min(F.struct("doc_id", "n")).alias("least"), F.sum("n").alias("rows"))
    n, nbytes = rows.agg(F.count("*"), F.coalesce(F.sum("size"), F.lit(0))).first()
    groups = materialize(per.select("digest", F.col("least.doc_id").alias("rep_id"), F.col("least.n").alias("again"), "rows"), "near-groups", n)
    reps = representatives(docs, groups)
    idf = spark.sparkContext.broadcast(document_frequencies(reps, groups.count(), nbytes, counters))
    texts = materialize(signatures(reps, idf), "signatures")
    members = materialize(buckets(texts.where("features > 0")), "members")
    feats = candidate_features(reps, members, idf)
    small = members.where(F.col("total") <= bucket)
    links = _compare(small.select(F.col("bucket").alias("key"), "digest", F.lit(None).cast("boolean").alias("expand")).join(feats, "digest"), similarity)
    large = members.where(F.col("total") > bucket)
    if not large.isEmpty():
        links = links.unionByName(_compare_large(large, feats, texts, similarity, bucket))
    labels = components(links)
    classes = groups.select("digest", "rep_id", "rows").join(labels.withColumnRenamed("node", "digest"), "digest", "left").withColumn("label", F.coalesce("label", "digest"))
    return rows.drop("size"), materialize(classes, "classes", n)


def near_classes(docs: DataFrame, similarity: float = SIMILARITY, bucket: int = BUCKET, counters: int = COUNTERS) -> DataFrame:
    """doc_id, class_id (the class's smallest doc_id), class_texts, class_size, kept: a row per row of docs."""
    rows, classes = near_texts(docs, similarity, bucket, counters)
    per = classes.groupBy("label").agg(F.min(F.struct("rep_id", "digest")).alias("best"), F.count("*").alias("class_texts"), F.sum("rows").alias("class_size"))
    of = classes.join(per, "label").select("digest", "best", "class_texts", "class_size")
    more = of.where("class_size > 1")
    joined = rows.join(small_or_shuffled(materialize(more, "class-of")), "digest", "left")
    own = F.coalesce(F.col("best.rep_id"), F.col("doc_id"))
    real = lambda c: F.when(c != NO_ID, c)
    return joined.select(real(F.col("doc_id")).alias("doc_id"), real(own).alias("class_id"), F.coalesce("class_texts", F.lit(1)).cast("long").alias("class_texts"), F.coalesce("class_size", F.lit(1)).cast("long").alias("class_size"), ((F.col("doc_id") == own) & F.coalesce(F.col("digest") == F.col("best.digest"), F.lit(True))).alias("kept"))


def drop_near_copies(docs: DataFrame, similarity: float = SIMILARITY, bucket: int = BUCKET, counters: int = COUNTERS) -> DataFrame:
    """The rows of docs that stay: one of each class."""
    rows, classes = near_texts(docs, similarity, bucket, counters)
    best = classes.groupBy("label").agg(F.min(F.struct("rep_id", "digest")).alias("best"))
    lost = classes.join(best, "label").where("rows > 1 OR digest <> best.digest")
    stays = (rows["doc_id"] == F.col("best.rep_id")) & (rows["digest"] == F.col("best.digest"))
    n = rows.count()
    fates = rows.join(small_or_shuffled(materialize(lost.select("digest", "best"), "lost", n)), "digest").withColumn("stays", stays)
    fates = materialize(fates.groupBy(F.col("doc_id").alias("_id"), "digest").agg(F.max("stays").alias("_stays"), F.count("*").alias("_rows")), "fates", n)
    drop = fates.where("NOT _stays OR _rows > 1")
    ids = materialize(drop.select("_id").distinct(), "lost-ids", n)
    keyed = packed(docs).withColumn("_key", F.coalesce(F.col("row.doc_id").cast("long"), F.lit(NO_ID)))
    flagged = keyed.join(small_or_shuffled(ids), F.col("_key") == F.col("_id"), "left")
    clean, doubtful = flagged.where(F.col("_id").isNull()), flagged.where(F.col("_id").isNotNull())
    # a row whose doc_id has a text that goes, or is repeated, is told apart by its text
    one = doubtful.select("row", "_key", text_digest(F.col("row.text")).alias("_digest"))
    fate = drop.select(F.col("_id").alias("_fate_id"), F.col("digest").alias("_fate_digest"), "_stays")
    left = one.join(fate, (F.col("_key") == F.col("_fate_id")) & (F.col("_digest") == F.col("_fate_digest")), "left").where(F.coalesce("_stays", F.lit(True)))
    first = F.row_number().over(W.partitionBy("_key", "_digest").orderBy(F.lit(0)))
    settled = left.withColumn("_first", first).where("_first = 1")
    return clean.select("row.*").unionByName(settled.select("row.*"))


def op10_icws_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_classes(read(spark, sf_dir, "documents").select("doc_id", "text"))
