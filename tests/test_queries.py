import pytest
from conftest import rows_of

from stridelake import queries as Q


Q.queries()  # the other modules register theirs


@pytest.mark.parametrize("name", sorted(Q.SQL))
def test_query_equals_duckdb(spark, sf, duck, name):
    assert rows_of(Q.QUERIES[name](spark, sf).toPandas()) == rows_of(duck.sql(Q.SQL[name]).df())


@pytest.mark.parametrize("name", sorted(set(Q.QUERIES) - set(Q.SQL)))
def test_query_without_sql_is_repeatable(spark, sf, name):
    a, b = (rows_of(Q.QUERIES[name](spark, sf).toPandas()) for _ in range(2))
    assert a == b and a[1]


def test_entry(spark, sf):
    import __spark_entry__ as entry

    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert entry.entry(spark).count() == 64


def test_scans_are_pruned_and_filters_pushed(spark, sf):
    from stridelake.operators import sampling

    steps = spark.read.parquet(f"{sf}/lineitem.parquet")
    plan = sampling.rank_share(steps.where("l_quantity > 30").select("l_orderkey"), 4, 1, 0, 0, "l_orderkey")._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<l_orderkey:bigint,l_quantity:double>" in plan and "GreaterThan(l_quantity,30.0)" in plan


def test_small_sides_are_broadcast_after_a_count(spark):
    from stridelake.operators import joins

    small = spark.range(10)
    assert "broadcast" in joins.sized(small)._jdf.queryExecution().logical().toString().lower()
    assert "broadcast" not in joins.sized(small, limit=5)._jdf.queryExecution().logical().toString().lower()


def test_nothing_else_imports_the_llm_subpackage():
    import pathlib
    import re

    root = pathlib.Path(Q.__file__).parent
    for p in root.rglob("*.py"):
        if "llm" not in p.relative_to(root).parts:
            assert not re.search(r"stridelake\.llm|from \.+llm|import llm", p.read_text()), p
