"""Exact deduplication with a heavy-hitter split, in DataFrame operations only.

A Misra-Gries pass finds digests that may hold more than a HEAVY-th of all rows. At most HEAVY of them
come out; their exact counts and winning rows are computed with map-side aggregation and broadcast, so
their copies are settled where they are read. All other digests are shuffled as partial aggregates; those of
two rows and more, again by a broadcast if they are few enough, settle the rest. Texts are never shuffled
unless there are too many groups for a broadcast.

Defined cases: a null text counts as empty; the row with the largest doc_id of equal texts stays, a null
doc_id being the smallest; of rows that tie on text and doc_id exactly one stays; an empty table gives an
empty result; further columns are kept by drop_copies and ignored by the decisions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from stridelake.llm.common import materialize, packed, prepare, read, small_or_shuffled

#: Counters of the Misra-Gries sketch, which is the most rows that are ever broadcast.
HEAVY = 512


def digest(text: Column) -> Column:
    return F.sha2(F.coalesce(text, F.lit("")).cast("binary"), 256)


def _best(rows: DataFrame) -> DataFrame:
    """For each digest of two rows and more: group_size, best (doc_id, row) and again, the rows with best's doc_id.
    Both steps combine on the map side, so no group meets in one task."""
    ids = rows.groupBy("text_sha256", "doc_id").agg(F.count("*").alias("n"), F.max("row").alias("row"))
    groups = ids.groupBy("text_sha256").agg(F.sum("n").alias("group_size"), F.max(F.struct("doc_id", "row", "n")).alias("best"))
    return groups.where("group_size > 1").select("text_sha256", "group_size", F.struct("best.doc_id", "best.row").alias("best"), F.col("best.n").alias("again"))


def heavy_winners(rows: DataFrame, heavy: int = HEAVY) -> DataFrame:
    """From (text_sha256, doc_id, row): verified heavy digests with group_size and the winning row."""
    found = rows.select("text_sha256").freqItems(["text_sha256"], 1.0 / heavy)
    candidates = found.select(F.explode("text_sha256_freqItems").alias("text_sha256"))
    return materialize(_best(rows.join(F.broadcast(candidates), "text_sha256")), "exact-heavy")


def other_winners(rows: DataFrame, winners: DataFrame) -> DataFrame:
    """The same for all digests that aren't heavy, by an ordinary shuffle of their digests."""
    rest = rows.join(F.broadcast(winners.select("text_sha256")), "text_sha256", "left_anti")
    return materialize(_best(rest), "exact-groups")


def numbered(docs: DataFrame) -> DataFrame:
    slim = docs.select("doc_id", digest(F.col("text")).alias("text_sha256"), F.monotonically_increasing_id().alias("row"))
    return materialize(slim, "exact-rows")  # fixes the row numbers


def exact_groups(docs: DataFrame, heavy: int = HEAVY) -> DataFrame:
    """doc_id, keep_id, group_size, kept, text_sha256 for every row of docs."""
    prepare(docs.sparkSession)
    rows = numbered(docs)
    winners = heavy_winners(rows, heavy)
    others = other_winners(rows, winners)
    hot = rows.join(F.broadcast(winners), "text_sha256")
    rest = rows.join(F.broadcast(winners.select("text_sha256")), "text_sha256", "left_anti").join(small_or_shuffled(others), "text_sha256", "left")
    best = F.coalesce("best", F.struct("doc_id", "row"))
    result = ["doc_id", best["doc_id"].alias("keep_id"), F.coalesce("group_size", F.lit(1)).cast("long").alias("group_size"), (F.col("row") == best["row"]).alias("kept"), "text_sha256"]
    return hot.select(*result).unionByName(rest.select(*result))


def drop_copies(docs: DataFrame, heavy: int = HEAVY) -> DataFrame:
    """The rows of docs that stay. Losers go where they are read as long as the winners are few enough for a
    broadcast; rows meet only where a winner's row itself is repeated, one of each task."""
    prepare(docs.sparkSession)
    rows = numbered(docs)
    winners = heavy_winners(rows, heavy)
    others = other_winners(rows, winners)
    keyed = packed(docs).withColumn("_digest", digest(F.col("row.text")))
    side = lambda t, name: t.select(F.col("text_sha256").alias(name), F.col("best.doc_id").alias(f"{name}_keep"), F.col("again").alias(f"{name}_again"))
    joined = keyed.join(F.broadcast(side(winners, "_heavy")), F.col("_digest") == F.col("_heavy"), "left")
    joined = joined.join(small_or_shuffled(side(others, "_other")), F.col("_digest") == F.col("_other"), "left")
    stays = lambda name: F.col(name).isNull() | F.col("row.doc_id").eqNullSafe(F.col(f"{name}_keep"))
    left = joined.where(stays("_heavy") & stays("_other"))
    if winners.unionByName(others).where("again > 1").isEmpty():
        return left.select("row.*")
    again = F.coalesce("_heavy_again", "_other_again", F.lit(1))
    first = F.row_number().over(W.partitionBy("_digest").orderBy(F.lit(0)))
    return left.where(again == 1).select("row.*").unionByName(left.where(again > 1).withColumn("_first", first).where("_first = 1").select("row.*"))


def op2_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_groups(read(spark, sf_dir, "documents"))


SQL = """
WITH d AS (SELECT doc_id, sha256(coalesce(text, '')) AS text_sha256 FROM documents),
g AS (SELECT *, max(doc_id) OVER (PARTITION BY text_sha256) AS keep_id, count(*) OVER (PARTITION BY text_sha256) AS group_size,
             row_number() OVER (PARTITION BY text_sha256 ORDER BY doc_id DESC NULLS LAST) AS place FROM d)
SELECT doc_id, keep_id, group_size, place = 1 AS kept, text_sha256 FROM g
"""
