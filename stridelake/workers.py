"""Python workers find this package even where it isn't installed and the driver runs in another folder."""

from __future__ import annotations

import os
from pathlib import Path

from pyspark.sql import SparkSession

ROOT = str(Path(__file__).resolve().parents[1])


def importable(spark: SparkSession | None = None) -> None:
    """Adds the package's folder to the path of Python workers that start from now on."""
    spark = spark or SparkSession.getActiveSession()
    if spark is None:
        return
    env = spark.sparkContext.environment
    if ROOT not in env.get("PYTHONPATH", "").split(os.pathsep):
        env["PYTHONPATH"] = os.pathsep.join(filter(None, [ROOT, env.get("PYTHONPATH", "")]))
