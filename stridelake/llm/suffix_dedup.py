"""Removal of long repeated byte strings with suffix arrays.

A byte goes when it is covered by a string of LENGTH bytes that starts anywhere else as well.

0. Of equal texts (sha256) of LENGTH bytes or more every byte goes; one of them takes part in what follows.
1. Anchors. In each window of LENGTH bytes the leftmost smallest hash of its GRAM-byte grams is the
   window's anchor. It depends on the window's bytes alone, so equal windows have equal anchors at equal
   places. Consecutive windows with one anchor are one record: the anchor's hash, where the first starts,
   how many there are, and a cryptographic digest (blake2b, 128 bits) of the bytes they span (the context).
2. Contexts that occur more than once are settled: all of their windows repeat. Anchors that occur in one
   context only need nothing else. The distinct contexts of all other anchors are read.
3. Shards. Contexts are dealt by anchor into shards of about SHARD bytes, so equal windows meet in one
   shard. Each shard gets a suffix array by Larsson-Sadakane refinement in numpy and common prefixes by
   Kasai's algorithm, run in parallel lanes; windows with a neighbour in suffix order that shares LENGTH
   bytes repeat.
4. An anchor with more than HOT contexts is dealt to several shards. Each of those puts out the sorted
   hashes of its distinct windows; lists of different shards are merged, range by range, by binary search,
   and what other shards hold too is looked up in the shard again, by binary search.
5. Passages. A run of WORDS words is often shorter than LENGTH bytes and then stays. So that it can be seen, words in
   runs of WORDS words that another document holds too are counted (n_shared_words); nothing is removed for it. Words
   are runs of bytes that are no ASCII white space, and which white space parts them makes no difference. The way
   is that of 0 to 2 with words for bytes; windows of contexts that differ are compared one by one, by two 64-bit
   hashes, in a shuffle that adds up equal ones before it sends them.

Defined cases: null counts as empty; texts shorter than LENGTH bytes are kept whole; overlaps count, inside
a text too; equal texts of at least LENGTH bytes all go; repeated rows are equal texts; null doc_ids stay
null; an empty table gives an empty result; further columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stridelake.llm.common import BASE, INVERSE, materialize, mix64, powers, prepare, read, run_hashes, slices, small_or_shuffled, text_bytes

LENGTH, GRAM = 400, 100
#: Bytes of a shard, and contexts of an anchor that one shard takes at most, about.
SHARD, HOT = 1 << 19, 500
#: An end for the spans of whole texts, more than any text has bytes.
WHOLE = 1 << 33
#: Most tasks that shards are dealt to.
TASKS = 20_000
#: Windows that are hashed at once.
PIECE = 1 << 20
SEPARATOR = 255  # in no UTF-8 text
#: Words of a passage ("over 50"), and of the grams among which its anchor is chosen.
WORDS, WORD_GRAM = 51, 8
#: Words that are hashed at once; fewer than 2^20 with a passage's.
PIECE_WORDS = 1 << 17


def sliding_least(x: np.ndarray, width: int) -> np.ndarray:
    """Minimum of each run of `width` values, by minima of blocks from both ends."""
    n = len(x) - width + 1
    blocks = -(-len(x) // width)
    padded = np.full(blocks * width, np.iinfo(x.dtype).max, x.dtype)
    padded[: len(x)] = x
    grid = padded.reshape(blocks, width)
    head = np.minimum.accumulate(grid, axis=1).ravel()
    tail = np.minimum.accumulate(grid[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(tail[:n], head[width - 1 : width - 1 + n])


def gram_hashes(data: np.ndarray, gram: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        prefix = np.zeros(len(data) + 1, np.uint64)
        np.cumsum((data.astype(np.uint64) + np.uint64(1)) * powers(BASE, len(data)), out=prefix[1:])
        return mix64((prefix[gram:] - prefix[:-gram]) * powers(INVERSE, len(data) - gram + 1))


def pieces(offsets: np.ndarray, length: int) -> Iterator[tuple[int, int]]:
    """Ranges of a batch that are hashed at once: whole texts of PIECE bytes together, or parts of a longer text,
    cut at fixed places of that text, so that a text's records never depend on its neighbours."""
    i, n = 0, len(offsets) - 1
    while i < n:
        start = int(offsets[i])
        j = max(i + 1, int(np.searchsorted(offsets, start + PIECE, side="right")) - 1)
        end = int(offsets[j])
        if end - start <= PIECE:
            yield start, end
        else:
            for a in range(start, end - length + 1, PIECE):
                yield a, min(a + PIECE + length - 1, end)
        i = j


def records(data: np.ndarray, offsets: np.ndarray, length: int, gram: int) -> tuple[np.ndarray, ...]:
    """Of a batch of texts: text, anchor hash, first window's start in the text, number of windows."""
    found: list[tuple[np.ndarray, ...]] = []
    for a, b in pieces(offsets, length):
        part = data[a:b]
        n = len(part) - length + 1
        if n < 1:
            continue
        h = gram_hashes(part, gram)
        place = np.arange(len(h), dtype=np.uint64)
        least = sliding_least((h & np.uint64(~((1 << 22) - 1) & (1 << 64) - 1)) | place, length - gram + 1)[:n]
        anchor = (least & np.uint64((1 << 22) - 1)).astype(np.int64)
        first = int(np.searchsorted(offsets, a, side="right")) - 1
        last = int(np.searchsorted(offsets, a + n - 1, side="right"))
        text = np.repeat(np.arange(first, last), np.minimum(offsets[first + 1 : last + 1], a + n) - np.maximum(offsets[first:last], a))
        whole = offsets[text + 1] - a >= np.arange(n) + length
        edge = np.ones(n + 1, bool)
        edge[1:-1] = (anchor[1:] != anchor[:-1]) | (whole[1:] != whole[:-1]) | (text[1:] != text[:-1])
        cuts = np.flatnonzero(edge)
        begin, end = cuts[:-1], cuts[1:]
        keep = whole[begin]
        begin, end = begin[keep], end[keep]
        found.append((text[begin], h[anchor[begin]].view(np.int64), begin + a - offsets[text[begin]], end - begin))
    if not found:
        return tuple(np.zeros(0, np.int64) for _ in range(4))
    return tuple(np.concatenate(x) for x in zip(*found, strict=True))


def suffix_array(data: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """Positions in the order of their next `depth` bytes (at least 8; the end counts as zeros), and each
    position's rank; positions that agree in all of them share a rank.

    Larsson-Sadakane: positions are first sorted by 8 bytes. A group that agrees in h bytes is then sorted by
    the ranks of the positions h further on, which makes 2h; groups of one are left alone from then on."""
    n = len(data)
    padded = np.concatenate([data, np.zeros(8, np.uint8)])
    key = np.zeros(n, np.uint64)
    for i in range(8):
        key = (key << np.uint64(8)) | padded[i : i + n]
    order = np.argsort(key)
    key = key[order]
    new = np.concatenate([[True], key[1:] != key[:-1]])
    heads = np.maximum.accumulate(np.where(new, np.arange(n), 0))
    rank = np.empty(n + depth, np.int64)
    rank[n:] = -1
    rank[order] = heads
    h = 8
    while h < depth:
        step = min(h, depth - h)
        single = new & np.concatenate([new[1:], [True]])
        slots = np.flatnonzero(~single)  # of unsorted groups
        if not len(slots):
            break
        at = order[slots]
        group = rank[at]
        by = ((group.astype(np.uint64)) << np.uint64(32)) | (rank[at + step] + 1).astype(np.uint64)
        inside = np.argsort(by)
        by = by[inside]
        order[slots] = at[inside]
        fresh = np.concatenate([[True], by[1:] != by[:-1]])
        new[slots] = fresh
        rank[order[slots]] = np.maximum.accumulate(np.where(fresh, slots, 0))
        h += step
    return order, rank[:n]


def common_prefixes(data: np.ndarray, order: np.ndarray, rank: np.ndarray, most: int, lanes: int = 2048) -> np.ndarray:
    """For each place in suffix order, the bytes (at most `most`) it shares with the place before.

    Kasai: going through positions in text order, the common prefix falls by one at most. The text is cut
    into lanes that go through it side by side. As positions are in order by `most` bytes only, those that
    agree in all of them tell nothing about the next one; they have one rank, which needs no comparison."""
    n = len(order)
    place = np.empty(n, np.int64)
    place[order] = np.arange(n)
    before = np.where(place > 0, order[np.maximum(place, 1) - 1], -1)
    padded = np.concatenate([data, np.zeros(most + 8, np.uint8)])
    words = np.lib.stride_tricks.as_strided(padded[: n + most].view(np.uint8), (n + most, 8), (1, 1))
    out = np.zeros(n, np.int64)
    each = -(-n // lanes)
    starts = np.arange(0, n, each)
    have = np.zeros(len(starts), np.int64)
    for j in range(each):
        at = starts + j
        live = np.flatnonzero((at < n))
        p = at[live]
        q = before[p]
        length = np.where(have[live] < most, np.maximum(have[live] - 1, 0), 0)
        length = np.where(q < 0, 0, np.where(rank[p] == rank[q], most, length))
        going = np.flatnonzero((q >= 0) & (length < most))
        while len(going):
            x, y, z = p[going], q[going], length[going]
            limit = np.minimum(np.minimum(most - z, n - np.maximum(x, y) - z), 8)
            differ = words[np.minimum(x + z, n + most - 1)] != words[np.minimum(y + z, n + most - 1)]
            same = np.where(differ.any(axis=1), differ.argmax(axis=1), 8)
            gain = np.maximum(np.minimum(same, limit), 0)
            length[going] = z + gain
            going = going[gain == 8]
        have[live] = length
        out[place[p]] = length
    return out


def window_places(contexts: list[bytes], windows: list[int]) -> tuple[np.ndarray, np.ndarray]:
    """Positions of a shard's windows in its joined text, and where each context starts there."""
    starts = np.cumsum([0] + [len(c) + 1 for c in contexts])[:-1]
    counts = np.array(windows)
    return np.repeat(starts - np.concatenate([[0], np.cumsum(counts)[:-1]]), counts) + np.arange(counts.sum()), starts


def repeated_windows(contexts: list[bytes], windows: list[int], length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of a shard: the windows' positions, whether each occurs at another one too, and where contexts start."""
    joined = np.frombuffer(b"".join(c + b"\xff" for c in contexts), np.uint8)
    at, starts = window_places(contexts, windows)
    order, rank = suffix_array(joined, length)
    shared = common_prefixes(joined, order, rank, length)
    twice = np.zeros(len(joined) + 1, bool)
    full = np.flatnonzero(shared >= length)
    twice[order[full]] = True
    twice[order[full - 1]] = True
    return at, twice[at], starts


def _runs(at: np.ndarray, hit: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Context, first and number of each run of hit windows."""
    owner = np.searchsorted(starts, at, side="right") - 1
    edge = np.ones(len(at) + 1, bool)
    edge[1:-1] = (hit[1:] != hit[:-1]) | (owner[1:] != owner[:-1])
    cuts = np.flatnonzero(edge)
    begin, end = cuts[:-1], cuts[1:]
    begin, end = begin[hit[begin]], end[hit[begin]]
    return owner[begin], at[begin] - starts[owner[begin]], end - begin


FOUND = "digest binary, first long, windows long"


def _found(table: pa.Table, at: np.ndarray, hit: np.ndarray, starts: np.ndarray) -> pa.Table:
    owner, first, n = _runs(at, hit, starts)
    rows = table.select(["digest", "first"]).take(pa.array(owner))
    return pa.table({"digest": rows.column("digest"), "first": pa.array(rows.column("first").to_numpy() + first), "windows": pa.array(n)})


def _distinct(table: pa.Table) -> pa.Table:
    """Rows of a shard without those that come twice, as rows of a document that is repeated with its id do."""
    seen: dict[tuple, int] = {}
    for i, key in enumerate(zip(table.column("digest").to_pylist(), table.column("first").to_pylist(), table.column("windows").to_pylist(), strict=True)):
        seen.setdefault(key, i)
    return table if len(seen) == table.num_rows else table.take(pa.array(list(seen.values())))


def _shard(length: int):
    def run(table: pa.Table) -> pa.Table:
        table = _distinct(table)
        return _found(table, *repeated_windows(table.column("context").to_pylist(), table.column("windows").to_pylist(), length))

    return run


def _window_hashes(contexts: list[bytes], at: np.ndarray, length: int) -> np.ndarray:
    """Two 64-bit hashes of each window, as one sortable value each."""
    joined = np.frombuffer(b"".join(c + b"\xff" for c in contexts), np.uint8)
    out = np.empty(len(at), [("a", "<u8"), ("b", "<u8")])
    out["a"] = run_hashes(joined, at, at + length)
    other = np.frombuffer(joined.tobytes().translate(bytes((167 * i + 13) % 256 for i in range(256))), np.uint8)
    out["b"] = run_hashes(other, at, at + length)
    return out


def _merge_hot(hot: DataFrame, length: int) -> DataFrame:
    """Repeated windows of anchors that are dealt to several shards; rows: shard, digest, first, windows, context."""
    kind = np.dtype([("a", "<u8"), ("b", "<u8")])

    def lists(table: pa.Table) -> pa.Table:
        table = _distinct(table)
        contexts = table.column("context").to_pylist()
        at, _ = window_places(contexts, table.column("windows").to_pylist())
        mine = np.unique(_window_hashes(contexts, at, length))
        part = (mine["a"] >> np.uint64(54)).astype(np.int64)
        cut = np.flatnonzero(np.concatenate([[True], part[1:] != part[:-1], [True]]))
        return pa.table({"shard": pa.array([table.column("shard")[0].as_py()] * (len(cut) - 1)), "range": pa.array(part[cut[:-1]]), "hashes": pa.array([mine[a:b].tobytes() for a, b in zip(cut[:-1], cut[1:], strict=True)], pa.binary())})

    def merge(table: pa.Table) -> pa.Table:
        own = [np.frombuffer(x, kind) for x in table.column("hashes").to_pylist()]
        everything = np.sort(np.concatenate(own))
        both = [x[np.searchsorted(everything, x, side="right") - np.searchsorted(everything, x, side="left") > 1].tobytes() for x in own]
        return pa.table({"shard": table.column("shard"), "range": table.column("range"), "hashes": pa.array(both, pa.binary())})

    def look_up(rows: pa.Table, shared: pa.Table) -> pa.Table:
        if not rows.num_rows:
            return pa.table({"digest": pa.array([], pa.binary()), "first": pa.array([], pa.int64()), "windows": pa.array([], pa.int64())})
        rows = _distinct(rows)
        contexts = rows.column("context").to_pylist()
        at, twice, starts = repeated_windows(contexts, rows.column("windows").to_pylist(), length)
        elsewhere = np.sort(np.concatenate([np.frombuffer(x, kind) for x in shared.column("hashes").to_pylist()])) if shared.num_rows else np.empty(0, kind)
        if len(elsewhere):
            mine = _window_hashes(contexts, at, length)
            place = np.minimum(np.searchsorted(elsewhere, mine), len(elsewhere) - 1)
            twice = twice | (elsewhere[place] == mine)
        return _found(rows, at, twice, starts)

    schema = "shard string, range long, hashes binary"
    listed = materialize(hot.groupBy("shard").applyInArrow(lists, schema), "window-lists")
    shared = listed.groupBy("range").applyInArrow(merge, schema)
    return hot.groupBy("shard").cogroup(shared.groupBy("shard")).applyInArrow(look_up, FOUND)


def _anchor_records(texts: DataFrame, length: int, gram: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = text_bytes(batch.column("text"))
            text, anchor, first, windows = records(data, offsets, length, gram)
            if len(text):
                begin = offsets[text] + first
                raw = memoryview(data)
                context = [hashlib.blake2b(raw[a:b], digest_size=16).digest() for a, b in zip(begin.tolist(), (begin + windows + length - 1).tolist(), strict=True)]
                yield pa.RecordBatch.from_arrays([batch.column("digest").take(pa.array(text)), pa.array(anchor), pa.array(context, pa.binary()), pa.array(first), pa.array(windows)], ["digest", "anchor", "context", "first", "windows"])

    return texts.select("digest", "text").mapInArrow(run, "digest binary, anchor long, context binary, first long, windows long")


def _contexts(texts: DataFrame, wanted: DataFrame, length: int) -> DataFrame:
    """anchor, digest, first, windows, context (bytes), of wanted (digest, anchor, contexts, first, windows)."""
    per = materialize(wanted.groupBy("digest").agg(F.collect_list(F.struct("anchor", "contexts", "first", "windows")).alias("records")), "wanted")
    chosen = texts.join(small_or_shuffled(per), "digest").select("digest", "text", "records")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = text_bytes(batch.column("text"))
            raw, cut = data.tobytes(), offsets.tolist()
            rows = [(i, r["anchor"], r["contexts"], r["first"], r["windows"]) for i, records in enumerate(batch.column("records").to_pylist()) for r in records]
            context = [raw[cut[i] + first : cut[i] + first + windows + length - 1] for i, _, _, first, windows in rows]
            columns = [pa.array([r[k] for r in rows], pa.int64()) for k in range(1, 5)]
            yield pa.RecordBatch.from_arrays([batch.column("digest").take(pa.array([r[0] for r in rows], pa.int64())), *columns, pa.array(context, pa.binary())], ["digest", "anchor", "contexts", "first", "windows", "context"])

    return chosen.mapInArrow(run, "digest binary, anchor long, contexts long, first long, windows long, context binary")


def _once(keyed: DataFrame, copied: DataFrame) -> DataFrame:
    """The documents of keyed without all but one of those with equal texts; copied: digest, least id."""
    least = copied.select(F.col("digest").alias("_digest"), F.col("id").alias("_id"))
    joined = keyed.join(small_or_shuffled(least), F.col("digest") == F.col("_digest"), "left")
    return joined.where(F.col("_id").isNull() | (F.col("_id") == F.col("id"))).select("digest", "text")


def repeats(docs: DataFrame, length: int = LENGTH, gram: int = GRAM, shard: int = SHARD, hot: int = HOT) -> tuple[DataFrame, DataFrame]:
    """keyed: doc_id, text, digest of every row; spans: digest and spans (start, end) of texts with repeats; an end may
    lie beyond the text's."""
    prepare(docs.sparkSession)
    digest = F.substring(F.unhex(F.sha2(F.coalesce("text", F.lit("")).cast("binary"), 256)), 1, 16)
    keyed = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text")).withColumn("digest", digest).withColumn("id", F.coalesce("doc_id", F.lit(-1 << 63)))
    long_ones = keyed.where(F.octet_length("text") >= length)
    copied = materialize(long_ones.groupBy("digest").agg(F.min("id").alias("id"), F.count("*").alias("n")).where("n > 1").select("digest", "id"), "copied")
    texts = _once(long_ones, copied)
    found = materialize(_anchor_records(texts, length, gram), "anchors")
    distinct = materialize(found.groupBy("anchor", "context").agg(F.count("*").alias("n"), F.min(F.struct("digest", "first", "windows")).alias("at")), "contexts")
    settled = materialize(distinct.where("n > 1").select("anchor", "context"), "settled")
    whole = copied.select("digest", F.lit(0).cast("long").alias("first"), F.lit(-1).cast("long").alias("windows"))
    spans = found.join(small_or_shuffled(settled), ["anchor", "context"]).select("digest", "first", "windows").unionByName(whole)
    several = materialize(distinct.groupBy("anchor").agg(F.count("*").alias("contexts")).where("contexts > 1"), "several")
    wanted = materialize(distinct.join(small_or_shuffled(several), "anchor").select("anchor", "contexts", "at.*"), "to-compare")
    total, most = wanted.agg(F.sum(F.col("windows") + length), F.max("contexts")).first()
    shards = max(1, -(-(total or 0) // shard))
    contexts = _contexts(texts, wanted, length)
    if (most or 0) > hot:
        contexts = materialize(contexts, "context-bytes")
    plain = contexts.where(F.col("contexts") <= hot).withColumn("shard", F.pmod(F.xxhash64("anchor"), F.lit(shards)))
    dealt = plain.select("shard", "digest", "first", "windows", "context").repartition(min(shards, TASKS), "shard")  # few bytes, much work: not to be coalesced
    spans = spans.unionByName(dealt.groupBy("shard").applyInArrow(_shard(length), FOUND))
    if (most or 0) > hot:
        large = contexts.where(F.col("contexts") > hot)
        part = F.pmod(F.xxhash64("digest", "first"), F.ceil(F.col("contexts") / hot))
        spans = spans.unionByName(_merge_hot(large.select(F.concat_ws(":", "anchor", part).alias("shard"), "digest", "first", "windows", "context"), length))
    return keyed, materialize(_merged(spans, length), "spans")


def _merged(spans: DataFrame, length: int) -> DataFrame:
    """digest, spans (start, end): the maximal runs of bytes that the windows of a text cover."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column("found")
            each = lists.flatten()
            row = np.repeat(np.arange(batch.num_rows), lists.value_lengths().to_numpy())
            first, windows = (each.field(k).to_numpy() for k in (0, 1))
            end = np.where(windows < 0, WHOLE, first + windows + length - 1)
            order = np.lexsort((first, row))
            row, first, end = row[order], first[order], end[order]
            reach = np.maximum.accumulate(end + row * (2 * WHOLE)) - row * (2 * WHOLE)
            new = np.ones(len(row), bool)
            new[1:] = (row[1:] != row[:-1]) | (first[1:] > reach[:-1])
            starts = np.flatnonzero(new)
            ends = reach[np.append(starts[1:], len(row)) - 1]
            cut = np.append(np.searchsorted(row[starts], np.arange(batch.num_rows)), len(starts))
            merged = pa.StructArray.from_arrays([pa.array(first[starts]), pa.array(ends)], ["start", "end"])
            yield pa.RecordBatch.from_arrays([batch.column("digest"), pa.ListArray.from_arrays(pa.array(cut, pa.int32()), merged)], ["digest", "spans"])

    lists = spans.groupBy("digest").agg(F.collect_set(F.struct("first", "windows")).alias("found"))
    return lists.mapInArrow(run, "digest binary, spans array<struct<start:long,end:long>>")


def words_of(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of a batch of texts: text and 64-bit hash of each word, in order."""
    inside = (data != 32) & ((data < 9) | (data > 13))
    edge = np.ones(len(data) + 1, bool)
    edge[1:-1] = inside[1:] != inside[:-1]
    edge[offsets] = True
    cuts = np.flatnonzero(edge)
    starts, ends = cuts[:-1], cuts[1:]
    word = inside[starts]
    starts, ends = starts[word], ends[word]
    hashes = np.empty(len(starts), np.uint64)
    i = 0
    while i < len(starts):
        j = max(i + 1, int(np.searchsorted(ends, starts[i] + PIECE, side="right")))
        hashes[i:j] = run_hashes(data[starts[i] : ends[j - 1]], starts[i:j] - starts[i], ends[i:j] - starts[i])
        i = j
    return np.searchsorted(offsets, starts, side="right") - 1, hashes


def sequence_hashes(hashes: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each run hashes[begin:end] of words."""
    with np.errstate(over="ignore"):
        prefix = np.zeros(len(hashes) + 1, np.uint64)
        np.cumsum(hashes * powers(BASE, len(hashes)), out=prefix[1:])
        return mix64((prefix[end] - prefix[begin]) * powers(INVERSE, len(hashes) + 1)[begin])


def _both_hashes(hashes: np.ndarray, begin: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    return sequence_hashes(hashes, begin, end).view(np.int64), sequence_hashes(mix64(~hashes), begin, end).view(np.int64)


def word_records(text: np.ndarray, hashes: np.ndarray, words: int, gram: int) -> tuple[np.ndarray, ...]:
    """Of the words of a batch: text, anchor hash, two hashes of the context, first window's place in the text, number
    of windows. Where a long batch is cut, so is a record: its windows are compared one by one then."""
    low = np.uint64((1 << 20) - 1)
    found = [tuple(np.zeros(0, np.int64) for _ in range(6))]
    for a in range(0, len(hashes) - words + 1, PIECE_WORDS):
        part, owner = hashes[a : a + PIECE_WORDS + words - 1], text[a : a + PIECE_WORDS + words - 1]
        n = len(part) - words + 1
        at = np.arange(len(part) - gram + 1)
        grams = sequence_hashes(part, at, at + gram)
        anchor = (sliding_least((grams & ~low) | at.astype(np.uint64), words - gram + 1) & low).astype(np.int64)
        whole = owner[:n] == owner[words - 1 :]
        edge = np.ones(n + 1, bool)
        edge[1:-1] = (anchor[1:] != anchor[:-1]) | (whole[1:] != whole[:-1]) | (owner[1:n] != owner[: n - 1])
        cuts = np.flatnonzero(edge)
        begin, end = cuts[:-1], cuts[1:]
        keep = whole[begin]
        begin, end = begin[keep], end[keep]
        found.append((owner[begin], grams[anchor[begin]].view(np.int64), *_both_hashes(part, begin, end + words - 1), begin + a - np.searchsorted(text, owner[begin]), end - begin))
    return tuple(np.concatenate(x) for x in zip(*found, strict=True))


def _word_records(texts: DataFrame, words: int, gram: int) -> DataFrame:
    """digest, its first half as a number, and the records of each text."""
    names = ["anchor", "a", "b", "first", "windows"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in (p for batch in batches for p in slices(batch)):
            text, *columns = word_records(*words_of(*text_bytes(part.column("text"))), words, gram)
            if len(text):
                digest = part.column("digest")
                number = np.array([int.from_bytes(x[:8], "little", signed=True) for x in digest.to_pylist()], np.int64)
                yield pa.RecordBatch.from_arrays([digest.take(pa.array(text)), pa.array(number[text]), *map(pa.array, columns)], ["digest", "number", *names])

    return texts.select("digest", "text").mapInArrow(run, "digest binary, number long" + "".join(f", {x} long" for x in names))


def _word_windows(texts: DataFrame, wanted: DataFrame, words: int) -> DataFrame:
    """digest, first, a, b, low, high: each window of wanted (digest, first, windows, low, high)."""
    per = materialize(wanted.groupBy("digest").agg(F.collect_list(F.struct("first", "windows", "low", "high")).alias("records")), "passages-wanted")
    chosen = texts.join(small_or_shuffled(per), "digest").select("digest", "text", "records")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in (p for batch in batches for p in slices(batch)):
            text, hashes = words_of(*text_bytes(part.column("text")))
            lists = part.column("records")
            first, windows, low, high = (lists.flatten().field(k).to_numpy() for k in range(4))
            row = np.repeat(np.arange(part.num_rows), lists.value_lengths().to_numpy())
            record = np.repeat(np.arange(len(row)), windows)
            place = np.arange(len(record)) - np.repeat(np.cumsum(windows) - windows, windows) + first[record]
            begin = np.searchsorted(text, row[record]) + place
            a, b = _both_hashes(hashes, begin, begin + words)
            for i in range(0, len(record), 1 << 17):
                j = slice(i, i + (1 << 17))
                yield pa.RecordBatch.from_arrays([part.column("digest").take(pa.array(row[record[j]])), *(pa.array(x[j]) for x in (place, a, b, low[record], high[record]))], ["digest", "first", "a", "b", "low", "high"])

    return chosen.mapInArrow(run, "digest binary, first long, a long, b long, low long, high long")


def shared_passages(keyed: DataFrame, words: int = WORDS, gram: int = WORD_GRAM) -> DataFrame:
    """digest and passages (start, end, in words): the maximal runs of words that runs of `words` words cover which
    another document holds too. Of a copied text the end is WHOLE, however few its words are. keyed: that of repeats()."""
    long_ones = keyed.where(F.octet_length("text") >= 2 * words - 1)
    copied = materialize(long_ones.groupBy("digest").agg(F.min("id").alias("id"), F.count("*").alias("n")).where("n > 1").select("digest", "id"), "passages-copied")
    texts = _once(long_ones, copied)
    ends = (F.min("number").alias("low"), F.max("number").alias("high"))
    found = materialize(_word_records(texts, words, gram), "passages-anchors")
    several = materialize(found.groupBy("anchor").agg(*ends).where("low < high").select("anchor"), "passages-several")
    near = materialize(found.join(small_or_shuffled(several), "anchor"), "passages-candidates")
    context = ["anchor", "a", "b"]
    distinct = materialize(near.groupBy(*context).agg(*ends, F.min(F.struct("digest", "first", "windows")).alias("at")), "passages-contexts")
    settled = materialize(distinct.where("low < high").select(*context), "passages-settled")
    whole = copied.select("digest", F.lit(0).cast("long").alias("first"), F.lit(-1).cast("long").alias("windows"))
    spans = near.join(small_or_shuffled(settled), context).select("digest", "first", "windows").unionByName(whole)
    differ = materialize(distinct.groupBy("anchor").agg(F.count("*").alias("n")).where("n > 1").select("anchor"), "passages-differ")
    to_compare = materialize(distinct.join(small_or_shuffled(differ), "anchor"), "passages-to-compare")
    # one place stands for a settled context; of the others, which may come twice in their text, every place counts
    places = near.join(small_or_shuffled(materialize(to_compare.where("low = high").select(*context), "passages-open")), context)
    wanted = places.select("digest", "first", "windows", F.col("number").alias("low"), F.col("number").alias("high"))
    wanted = wanted.unionByName(to_compare.where("low < high").select("at.*", "low", "high"))
    windows = materialize(_word_windows(texts, wanted, words), "passages-windows")
    shared = materialize(windows.groupBy("a", "b").agg(F.min("low").alias("low"), F.max("high").alias("high")).where("low < high").select("a", "b"), "passages-shared")
    spans = spans.unionByName(windows.join(small_or_shuffled(shared), ["a", "b"]).select("digest", "first", F.lit(1).cast("long").alias("windows")))
    return materialize(_merged(spans, words).withColumnRenamed("spans", "passages"), "passages")


REMOVED = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"
SHARED = ", n_shared_words long"


def without_repeats(docs: DataFrame, length: int = LENGTH, with_kept: bool = False, words: int | None = None, **params) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256; if `words` is given, n_shared_words: how many words lie in
    runs of so many that another document holds too, as they stand in the input; and, if asked for, spans (start, end
    of each removed run) and kept (the bytes left)."""
    keyed, spans = repeats(docs, length, **params)
    passages = F.lit(0).cast("long")
    if words:
        spans = materialize(spans.join(shared_passages(keyed, words), "digest", "full"), "found")
        passages = F.coalesce(F.aggregate("passages", F.lit(0).cast("long"), lambda n, p: n + p["end"] - p["start"]), passages)
    joined = keyed.join(small_or_shuffled(spans), "digest", "left").select("doc_id", "text", "spans", passages.alias("passages"))
    schema = REMOVED + SHARED * bool(words) + ", spans array<struct<start:long,end:long>>, kept binary" * with_kept

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = text_bytes(batch.column("text"))
            raw, cut = data.tobytes(), offsets.tolist()
            rows = []
            for i, (found, shared) in enumerate(zip(batch.column("spans").to_pylist(), batch.column("passages").to_pylist(), strict=True)):
                text = raw[cut[i] : cut[i + 1]]
                merged = [(s["start"], min(s["end"], len(text))) for s in found or ()]
                edges = [0, *(x for s in merged for x in s), len(text)]
                kept = b"".join(text[a:b] for a, b in zip(edges[::2], edges[1::2], strict=True))
                if shared > len(text):  # a copied text's end is WHOLE
                    shared = n if (n := len(text.split())) >= words else 0
                rows.append((len(text), len(text) - len(kept), len(merged), hashlib.sha256(kept).hexdigest(), shared, [{"start": a, "end": b} for a, b in merged], kept))
            kinds = [pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())])), pa.binary()]
            names = ["n_bytes", "n_removed", "n_spans", "kept_sha256", "n_shared_words", "spans", "kept"]
            chosen = [k for k in range(len(names)) if k < 4 or (words if k == 4 else with_kept)]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *(pa.array([r[k] for r in rows], kinds[k]) for k in chosen)], ["doc_id", *(names[k] for k in chosen)])

    return joined.mapInArrow(run, schema)


def op4_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return without_repeats(read(spark, sf_dir, "documents").select("doc_id", "text"), words=WORDS)
