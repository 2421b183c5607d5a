"""Mixing sources to target weights.

Every document gets a hash-random key. Within each source documents are ordered by that key; key
ranges give a distributed prefix sum of sizes, and the order is cut where the source's budget ends.
A budget above the source's size repeats whole epochs before the cut.

Defined cases: a null text has size 0; a null source is a source of its own, sorted last; sources of
size 0 have target 0; an empty table gives an empty result; repeated rows each count; rows that tie on
key and doc_id are ordered by size, and rows equal in all three are interchangeable. Columns other
than doc_id, text and source are ignored by the decisions and kept by mixed_documents.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from stridelake.llm.common import materialize, packed, prepare, read, small_or_shuffled

WEIGHTS, SHARE, CAP, SEED = (5, 2, 1), 1.5, 2, "mix-1"
WORD = r"[^\x20\x09-\x0D]+"
#: Rows of one source that share a key range, about; a window never holds more than a few times that.
RANGE_ROWS = 4_000


def mix_key(seed: str, doc_id: Column, text: Column) -> Column:
    """Hash-random key of a document: hex digits, uniform. Rows without a doc_id are keyed by their text, so that
    many of them don't share one key."""
    own = F.concat(F.lit("null:"), F.md5(F.coalesce(text, F.lit("")).cast("binary")))
    return F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), own)).cast("binary"))


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def source_targets(sizes: DataFrame, weights: Sequence[float] = WEIGHTS, share: float = SHARE, cap: float = CAP) -> DataFrame:
    """From (source, size) per document: source, source_size, n, target; one row per source.

    Water filling: with sources ordered by cap / weight, the level is the budget left after the full
    ones over the weight left, at the first source that isn't full. The windows see a row per source."""
    per = sizes.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("n"))
    rank = F.row_number().over(W.orderBy(F.col("source").asc_nulls_last())) - 1
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (rank % len(weights) + 1).cast("int"))
    t = per.withColumn("w", weight).withColumn("most", F.lit(float(cap)) * F.col("source_size"))
    order = W.orderBy(F.col("most") / F.col("w"), F.col("source").asc_nulls_last())
    before, rest = order.rowsBetween(W.unboundedPreceding, -1), order.rowsBetween(W.currentRow, W.unboundedFollowing)
    everything = W.orderBy(F.lit(0)).rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    t = t.withColumn("budget", F.lit(float(share)) * F.sum("source_size").over(everything))
    t = t.withColumn("level", (F.col("budget") - F.coalesce(F.sum("most").over(before), F.lit(0.0))) / F.sum("w").over(rest))
    t = t.withColumn("first", F.min(F.when(F.col("most") / F.col("w") >= F.col("level"), F.struct(F.col("most") / F.col("w"), "level"))).over(everything)["level"])
    return t.select("source", "source_size", "n", F.least(F.col("most"), F.col("w") * F.coalesce("first", F.lit(float("inf")))).alias("target"))


def mix_sources(docs: DataFrame, weights: Sequence[float] = WEIGHTS, share: float = SHARE, cap: float = CAP, seed: str = SEED, range_rows: int = RANGE_ROWS) -> DataFrame:
    """doc_id, source, key, size, source_size, target, budget, epochs, before, taken; a row per document.

    taken: words that the mix takes of it; the document at the cut gives its first words only."""
    prepare(docs.sparkSession)
    slim = materialize(docs.select("doc_id", "source", word_count(F.col("text")).alias("size"), mix_key(seed, F.col("doc_id"), F.col("text")).alias("key")), "mix")
    targets = source_targets(slim, weights, share, cap)
    targets = targets.withColumn("budget", F.floor(F.col("target") + 0.5).cast("long"))
    targets = materialize(targets.withColumn("epochs", F.when(F.col("source_size") > 0, F.floor(F.col("budget") / F.col("source_size"))).otherwise(0).cast("long")), "mix-targets")
    largest = targets.agg(F.max("n")).first()[0] or 0
    digits = max(0, math.ceil(math.log(max(1, largest / range_rows), 16)))
    bucketed = slim.withColumn("bucket", F.substring("key", 1, digits)).withColumn("none", F.col("source").isNull()).withColumn("source", F.coalesce("source", F.lit("")))
    sums = bucketed.groupBy("none", "source", "bucket").agg(F.sum("size").alias("in_bucket"))
    ranges = sums.withColumn("base", F.coalesce(F.sum("in_bucket").over(W.partitionBy("none", "source").orderBy("bucket").rowsBetween(W.unboundedPreceding, -1)), F.lit(0)))
    mine = targets.withColumn("none", F.col("source").isNull()).withColumn("source", F.coalesce("source", F.lit("")))
    ranges = ranges.join(small_or_shuffled(mine), ["none", "source"]).drop("in_bucket", "n")
    within = W.partitionBy("none", "source", "bucket").orderBy("key", "doc_id", "size").rowsBetween(W.unboundedPreceding, -1)
    rows = bucketed.withColumn("inside", F.coalesce(F.sum("size").over(within), F.lit(0))).join(ranges, ["none", "source", "bucket"])
    rows = rows.withColumn("before", F.col("base") + F.col("inside"))
    left = F.col("budget") - F.col("epochs") * F.col("source_size") - F.col("before")
    rows = rows.withColumn("taken", F.col("epochs") * F.col("size") + F.greatest(F.lit(0), F.least(F.col("size"), left)))
    return rows.select("doc_id", F.when(~F.col("none"), F.col("source")).alias("source"), "key", "size", "source_size", "target", "budget", "epochs", "before", "taken")


def mixed_documents(docs: DataFrame, **params) -> DataFrame:
    """The rows of docs as often as the mix takes them, each whole: the document at a source's cut comes
    along when at least half of it lies before the cut. Columns are those of docs.

    A source's decision is one cut in (key, doc_id, size) order, so it is applied where the rows are read
    and texts are never shuffled."""
    seed = params.get("seed", SEED)
    mix = mix_sources(docs, **params)
    extra = F.col("taken") - F.col("epochs") * F.col("size")
    last = F.max(F.when((F.col("size") > 0) & (2 * extra >= F.col("size")), F.struct("key", F.coalesce("doc_id", F.lit(-1 << 63)).alias("doc_id"), "size")))
    cuts = mix.groupBy("source").agg(F.first("epochs").alias("_epochs"), last.alias("_cut"), F.max("source_size").alias("_size"))
    cuts = materialize(cuts.select(F.col("source").alias("_source"), "_epochs", "_cut", "_size"), "mix-cuts")
    at = F.struct(mix_key(seed, F.col("row.doc_id"), F.col("row.text")).alias("key"), F.coalesce("row.doc_id", F.lit(-1 << 63)).alias("doc_id"), word_count(F.col("row.text")).alias("size"))
    times = F.col("_epochs") + F.when(F.col("_cut").isNotNull() & (at <= F.col("_cut")), 1).otherwise(0)
    joined = packed(docs).join(small_or_shuffled(cuts), F.col("row.source").eqNullSafe(F.col("_source")))
    out = joined.withColumn("_times", times.cast("int")).where("_times > 0").withColumn("_n", F.explode(F.sequence(F.lit(1), F.col("_times"))))
    return out.select("row.*")


def op1_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix_sources(read(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken", "source")


SQL = r"""
WITH d AS (
  SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size,
         md5('mix-1:' || coalesce(CAST(doc_id AS VARCHAR), 'null:' || md5(coalesce(text, '')))) AS key
  FROM documents),
s AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
         CASE (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 WHEN 0 THEN 5.0::DOUBLE WHEN 1 THEN 2.0::DOUBLE ELSE 1.0::DOUBLE END AS w
  FROM d GROUP BY source),
f AS (
  SELECT *, 2.0::DOUBLE * source_size AS most, 1.5::DOUBLE * sum(source_size) OVER () AS budget FROM s),
g AS (
  SELECT *, (budget - coalesce(sum(most) OVER (ORDER BY most / w, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
         / sum(w) OVER (ORDER BY most / w, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level FROM f),
h AS (SELECT arg_min(level, most / w) AS level FROM g WHERE most / w >= level),
t AS (
  SELECT source, source_size, least(most, w * h.level) AS target FROM g, h),
p AS (
  SELECT d.doc_id, d.source, d.size, t.source_size, t.target, CAST(floor(t.target + 0.5) AS BIGINT) AS budget,
         CAST(coalesce(sum(d.size) OVER (PARTITION BY d.source ORDER BY d.key, d.doc_id, d.size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS before
  FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source),
e AS (SELECT *, CASE WHEN source_size > 0 THEN budget // source_size ELSE 0 END AS epochs FROM p)
SELECT doc_id, size, source_size, target, CAST(epochs * size + greatest(0, least(size, budget - epochs * source_size - before)) AS BIGINT) AS taken, source
FROM e
"""
