"""The queries of this subpackage and the SQL of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from stridelake.llm import chat_tree, exact_dedup, language_id, lm_score, mixing, near_dedup, ogg_media, packing, quality_knn, suffix_dedup


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    found = (
        mixing.op1_mix_sources,
        exact_dedup.op2_exact_dedup,
        chat_tree.op3_chat_prefix_tree,
        suffix_dedup.op4_suffix_array_dedup,
        ogg_media.op5_ogg_media,
        lm_score.op6_lm_cross_entropy,
        quality_knn.op7_quality_knn,
        language_id.op8_language_id,
        packing.op9_sum_of_squares_packing,
        near_dedup.op10_icws_near_dedup,
    )
    return {f.__name__: f for f in found}


def oracle_sql() -> dict[str, str]:
    return {"op1_mix_sources": mixing.SQL, "op2_exact_dedup": exact_dedup.SQL, "op3_chat_prefix_tree": chat_tree.SQL}
