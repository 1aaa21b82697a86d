"""Cutting lineage in the folder that the cluster shares."""

from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: ``spark.checkpoint.dir``.

    Only a local session may go without one; it then gets a temporary folder.
    """
    sc = spark.sparkContext
    at = sc.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not at:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        at = tempfile.mkdtemp(prefix="geoloom-")
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(at)
    return at


def cut(df: DataFrame) -> DataFrame:
    """Materialise a table in the shared checkpoint folder and forget its lineage."""
    shared_dir(df.sparkSession)
    return df.checkpoint()
