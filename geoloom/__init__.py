"""A PySpark-native engine for territorial features, parcels, public documents and corpora."""

from __future__ import annotations

import os

from pyspark.sql import SparkSession

HOME = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def reach(spark: SparkSession) -> None:
    """Let Python workers import this package from where the driver has it (a cluster without it installed needs it on that path)."""
    env = spark.sparkContext.environment
    paths = [p for p in env.get("PYTHONPATH", "").split(os.pathsep) if p]
    if HOME not in paths:
        env["PYTHONPATH"] = os.pathsep.join([HOME, *paths])
