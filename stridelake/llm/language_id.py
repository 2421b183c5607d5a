"""Language identification with word-first backoff.

A word seen in training is scored by its log frequency in each language. A word not seen is scored by the
mean log frequency of its longest character n-grams that were seen: those of 4 characters if any, else 3,
2, 1. A document's language is the one with the largest sum over its words.

Words are runs of letters in lower case. Words and n-grams are known by 64-bit hashes of their code points,
and all work is on arrays. The model is fitted on a hash sample of about FIT_ROWS labelled rows of each
language, whose texts have at most FIT_BYTES, and keeps every word and n-gram of it. These two parameters and
the number of languages bound what is collected and broadcast. Every document is scored whole.

Defined cases: a null text, or one without a letter, is `und` with score 0; so is every text when there is
no labelled row; rows with null lang are predicted but not learnt from; a null doc_id counts as the empty
text for the fold; ties go to the first language by name; repeated rows and further columns are harmless.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stridelake.llm.common import materialize, prepare, read, run_hashes, slices, small_or_shuffled

FIT_ROWS, FIT_BYTES, LONGEST, SMOOTH = 5_000, 200_000, 4, 0.1
#: Characters that are worked on at once, and events that a task of the fit holds before it sends them on.
PIECE, HELD = 1 << 20, 1_000_000
UNKNOWN = "und"
#: Stands at both ends of a word in its n-grams; no letter.
END = 1


def fold(doc_id: str, n: int) -> Column:
    """crc32 of the id as text, modulo n."""
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).cast("binary")) % n


def hash_sample(rows: DataFrame, key: str, n: int) -> DataFrame:
    """About n rows of a stored table at most, chosen by a hash of key alone."""
    have = rows.count()
    return rows if have <= n else rows.where(F.pmod(F.xxhash64(F.col(key), F.lit("sample")), F.lit(1 << 30)) < int(n / have * (1 << 30)))


_LETTERS: list[np.ndarray] = []


def letters() -> tuple[np.ndarray, np.ndarray]:
    """For each code point, whether it is a letter, and its lower case where that is one letter."""
    if not _LETTERS:
        points = [c for c in range(0x110000) if not 0xD800 <= c < 0xE000]
        is_letter, lower = np.zeros(0x110000, bool), np.arange(0x110000, dtype=np.uint32)
        for c in points:
            x = chr(c)
            if x.isalpha():
                is_letter[c] = True
                low = x.lower()
                if low != x and len(low) == 1:
                    lower[c] = ord(low)
        _LETTERS.extend([is_letter, lower])
    return _LETTERS[0], _LETTERS[1]


@dataclass
class Words:
    """Words of some texts: the lower-cased code points, where each word begins and ends, its text and hash."""

    codes: np.ndarray
    begin: np.ndarray
    end: np.ndarray
    row: np.ndarray
    hashes: np.ndarray = field(init=False)

    def __post_init__(self) -> None:
        self.hashes = run_hashes(self.codes, self.begin, self.end)


def _parts(texts: list[str | None]) -> Iterator[tuple[int, str]]:
    """Row and text, long texts in parts that end between words."""
    for row, text in enumerate(texts):
        at = 0
        while text and at < len(text):
            stop = min(at + PIECE, len(text))
            while stop < len(text) and text[stop - 1].isalpha() and text[stop].isalpha():
                stop += 1
            yield row, text[at:stop]
            at = stop


def words_of(texts: list[str | None]) -> Iterator[Words]:
    """The words of texts, about PIECE characters at a time."""
    held: list[tuple[int, str]] = []

    def out() -> Words:
        is_letter, lower = letters()
        codes = np.frombuffer(" ".join(t for _, t in held).encode("utf-32-le"), np.uint32)
        inside = is_letter[codes]
        change = np.flatnonzero(np.diff(np.concatenate([[0], inside.view(np.int8), [0]])))
        begin, end = change[::2], change[1::2]
        starts = np.cumsum([0] + [len(t) + 1 for _, t in held])[:-1]
        row = np.array([r for r, _ in held])[np.searchsorted(starts, begin, side="right") - 1]
        return Words(lower[codes], begin, end, row)

    size = 0
    for row, text in _parts(texts):
        held.append((row, text))
        size += len(text)
        if size >= PIECE:
            yield out()
            held, size = [], 0
    if held:
        yield out()


def grams(words: Words, which: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Of the chosen words: the place in `which` and the hash of each n-gram. Words have their ends marked, but
    not for single characters."""
    length = words.end[which] - words.begin[which]
    ends = 0 if n == 1 else 1
    size = length + 2 * ends
    first = np.cumsum(size) - size
    total = int(size.sum())
    marked = np.full(total, END, np.uint32)
    inner = np.repeat(np.cumsum(length) - length, length)
    step = np.arange(int(length.sum())) - inner
    marked[np.repeat(first + ends, length) + step] = words.codes[np.repeat(words.begin[which], length) + step]
    count = np.maximum(size - n + 1, 0)
    place = np.repeat(np.arange(len(which)), count)
    at = np.repeat(first, count) + np.arange(int(count.sum())) - np.repeat(np.cumsum(count) - count, count)
    return place, run_hashes(marked, at, at + n)


@dataclass
class Model:
    """By kind, 0 for words and n for n-grams: sorted hashes, and for each its log frequency by language."""

    langs: list[str]
    hashes: list[np.ndarray]
    rows: list[np.ndarray]

    def find(self, kind: int, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Whether each hash is known, and its place."""
        have = self.hashes[kind]
        if not len(have):
            return np.zeros(len(h), bool), np.zeros(len(h), np.int64)
        at = np.minimum(np.searchsorted(have, h), len(have) - 1)
        return have[at] == h, at


def sampled(labelled: DataFrame, rows: int = FIT_ROWS, nbytes: int = FIT_BYTES) -> DataFrame:
    """text, lang of about `rows` rows of each language at most, by a hash of doc_id and text."""
    fit = labelled.where(F.col("lang").isNotNull() & (F.octet_length("text") <= nbytes)).select("doc_id", "text", "lang")
    share = materialize(fit.groupBy("lang").agg(F.least(F.lit(1.0), F.lit(float(rows)) / F.count("*")).alias("share")), "language-shares")
    draw = F.pmod(F.xxhash64("doc_id", "text", F.lit("sample")), F.lit(1 << 30))
    return fit.join(small_or_shuffled(share), "lang").where(draw < F.col("share") * (1 << 30)).select("text", "lang")


def fit(labelled: DataFrame) -> Model:
    """labelled: text, lang; all of its words and n-grams count. Counts are summed on the executors."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple[str, int], tuple[list, list]] = {}

        def out() -> Iterator[pa.RecordBatch]:
            for (lang, kind), (keys, counts) in held.items():
                h, at = np.unique(np.concatenate(keys), return_inverse=True)
                n = np.bincount(at, weights=np.concatenate(counts)).astype(np.int64)
                for i in range(0, len(h), 50_000):
                    k = len(h[i : i + 50_000])
                    yield pa.RecordBatch.from_arrays([pa.array([kind] * k, pa.int32()), pa.array(h[i : i + k].view(np.int64)), pa.array([lang] * k), pa.array(n[i : i + k])], ["kind", "gram", "lang", "n"])
            held.clear()

        size = 0
        for batch in (part for whole in batches for part in slices(whole)):
            lang = np.array(batch.column("lang").to_pylist(), object)
            for words in words_of(batch.column("text").to_pylist()):
                for v in sorted(set(lang[words.row])):
                    mine = np.flatnonzero(lang[words.row] == v)
                    h, first, n = np.unique(words.hashes[mine], return_index=True, return_counts=True)
                    found = [(0, h, n)]
                    for kind in range(1, LONGEST + 1):
                        place, g = grams(words, mine[first], kind)
                        found.append((kind, g, n[place]))
                    for kind, keys, counts in found:
                        k, c = held.setdefault((v, kind), ([], []))
                        k.append(keys)
                        c.append(counts)
                        size += len(keys)
            if size > HELD:
                yield from out()
                size = 0
        yield from out()

    prepare(labelled.sparkSession)
    counted = materialize(labelled.mapInArrow(count, "kind int, gram long, lang string, n long").groupBy("kind", "gram", "lang").agg(F.sum("n").alias("n")), "language-counts")
    table = counted.toArrow()
    langs = sorted(set(table.column("lang").unique().to_pylist()))
    kind, gram, n = (table.column(c).to_numpy() for c in ("kind", "gram", "n"))
    lang = np.searchsorted(np.array(langs, object), table.column("lang").to_numpy(zero_copy_only=False)) if langs else np.zeros(0, np.int64)
    hashes, rows = [], []
    for k in range(LONGEST + 1):
        of = np.flatnonzero(kind == k)
        keys, at = np.unique(gram[of].view(np.uint64), return_inverse=True)
        counts = np.zeros((len(keys), len(langs)))
        counts[at, lang[of]] = n[of]
        total, distinct = counts.sum(axis=0), (counts > 0).sum(axis=0)
        hashes.append(keys)
        rows.append(np.log((counts + SMOOTH) / (total + SMOOTH * np.maximum(distinct, 1) + 1)).astype(np.float32))
    return Model(langs, hashes, rows)


def word_scores(words: Words, which: np.ndarray, model: Model) -> np.ndarray:
    """Log frequencies, a row per chosen word: its own if it was seen, else the mean of its longest n-grams that
    were, else zeros."""
    out = np.zeros((len(which), len(model.langs)), np.float64)
    known, at = model.find(0, words.hashes[which])
    out[known] = model.rows[0][at[known]]
    left = np.flatnonzero(~known)
    for n in range(LONGEST, 0, -1):
        if not len(left):
            break
        place, h = grams(words, which[left], n)
        hit, at = model.find(n, h)
        place, at = place[hit], at[hit]
        found = np.bincount(place, minlength=len(left))
        for j in range(len(model.langs)):
            mean = np.bincount(place, weights=model.rows[n][at, j], minlength=len(left)) / np.maximum(found, 1)
            out[left, j] = np.where(found > 0, mean, out[left, j])
        left = left[found == 0]
    return out


def scores(texts: list[str | None], model: Model) -> tuple[list[str], list[float]]:
    """Language and score of each text."""
    total, n = np.zeros((len(texts), len(model.langs))), np.zeros(len(texts), np.int64)
    for words in words_of(texts) if model.langs else ():
        _, first, of = np.unique(words.hashes, return_index=True, return_inverse=True)
        each = word_scores(words, first, model)
        n += np.bincount(words.row, minlength=len(texts))
        for j in range(len(model.langs)):
            total[:, j] += np.bincount(words.row, weights=each[of, j], minlength=len(texts))
    if not model.langs:
        return [UNKNOWN] * len(texts), [0.0] * len(texts)
    p = np.exp((total - total.max(axis=1, keepdims=True)) / np.maximum(1.0, n / 10)[:, None])
    best = total.argmax(axis=1)
    score = np.where(n > 0, p[np.arange(len(texts)), best] / p.sum(axis=1), 0.0)
    return [model.langs[b] if k else UNKNOWN for b, k in zip(best.tolist(), n.tolist(), strict=True)], score.tolist()


def predict(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, lang_pred, score for every row of docs (doc_id, text)."""
    shared = prepare(docs.sparkSession).sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (part for whole in batches for part in slices(whole)):
            lang, score = scores(batch.column("text").to_pylist(), shared.value)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(lang, pa.string()), pa.array(score, pa.float64())], ["doc_id", "lang_pred", "score"])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, "doc_id long, lang_pred string, score double")


def op8_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    model = fit(sampled(docs.where((fold("doc_id", 3) != 1) & F.col("text").isNotNull())))
    found = predict(docs, model)
    return found.select("doc_id", (fold("doc_id", 3) == 1).alias("held_out"), "lang_pred", "score")
