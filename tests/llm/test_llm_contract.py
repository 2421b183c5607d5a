from __future__ import annotations

import pytest
from conftest import rows_of

from stridelake.llm import registry


@pytest.mark.parametrize("name", sorted(registry.oracle_sql()))
def test_query_equals_duckdb(spark, sf, duck, name):
    assert rows_of(registry.queries()[name](spark, sf).toPandas()) == rows_of(duck.sql(registry.oracle_sql()[name]).df())


def test_one_query_for_each_operator():
    numbers = sorted(int(n[2:].split("_")[0]) for n in registry.queries())
    assert numbers == list(range(1, 11))


def test_pipeline(spark, sf):
    import corpus_pipeline as C

    from stridelake.llm import exact_dedup, near_dedup, quality_knn
    from stridelake.llm.common import materialize

    docs = spark.read.parquet(f"{sf}/documents.parquet")
    seen, columns, tables = docs, docs.columns, []
    for name, stage in C.STAGES:
        seen = materialize(stage(spark, seen, sf), f"test-{name}")
        tables.append(seen)
        if name != C.STAGES[-1][0]:
            assert seen.columns == columns
    good = {r["row"]["doc_id"] for r in quality_knn.scored(docs, quality_knn.model_of(spark, docs, sf)).collect() if r["score"] >= quality_knn.THRESHOLD}
    ids = [[r["doc_id"] for r in t.select("doc_id").collect()] for t in tables]
    assert set(ids[0]) == good and len(ids[0]) == len(good)
    assert sorted(ids[1]) == sorted(r["doc_id"] for r in exact_dedup.exact_groups(tables[0]).where("kept").collect())
    assert sorted(ids[2]) == sorted(r["doc_id"] for r in near_dedup.near_classes(tables[1]).where("kept").collect())
    assert set(ids[3]) <= set(ids[2]) and max(ids[3].count(i) for i in set(ids[3])) <= 2
    assert set(ids[4]) == set(ids[3])
    assert {r["doc_id"] for r in C.run(spark, sf).collect()} == set(ids[4])


def test_no_operator_uses_what_the_contract_forbids():
    import pathlib
    import re

    root = pathlib.Path(registry.__file__).parent
    for p in root.glob("*.py"):
        text = p.read_text()
        assert not re.search(r"localCheckpoint|\.crossJoin\(|\.rdd\b|except ImportError|except ModuleNotFoundError", text), p
