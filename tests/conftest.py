from __future__ import annotations

import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from pyspark.sql import SparkSession

    conf = {
        "spark.sql.shuffle.partitions": "4",
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.sql.session.timeZone": "UTC",
        "spark.driver.memory": "4g",
        "spark.checkpoint.dir": str(tmp_path_factory.mktemp("checkpoints")),
        "spark.sql.warehouse.dir": str(tmp_path_factory.mktemp("warehouse")),
    }
    session = SparkSession.builder.master("local[4]").appName("tests").config(map=conf).getOrCreate()
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf() -> str:
    path = "/root/testdata/sf0.001"
    if not os.path.isdir(path):
        pytest.skip("the driver's tables aren't here")
    return path


@pytest.fixture(scope="session")
def duck(sf):
    import duckdb

    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for f in os.listdir(sf):
        con.sql(f"CREATE VIEW {f.removesuffix('.parquet')} AS SELECT * FROM '{sf}/{f}'")
    return con


def rows_of(pdf) -> tuple[list[str], list[tuple]]:
    """Columns by name, and sorted rows with missing values made equal."""
    columns = sorted(pdf.columns)
    plain = lambda v: "null" if v is None or v != v else repr(v.item() if hasattr(v, "item") else v)
    return columns, sorted(tuple(plain(v) for v in r) for r in pdf[columns].itertuples(index=False))
