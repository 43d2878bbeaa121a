"""Cutting lineage in the shared checkpoint folder."""

from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame, SparkSession


def folder(spark: SparkSession) -> str:
    """The session's checkpoint folder; a local master without one gets its own, a cluster must name one."""
    sc = spark.sparkContext
    if sc._jsc.sc().getCheckpointDir().isEmpty():
        named = sc.getConf().get("spark.checkpoint.dir")
        if not named and not sc.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        sc.setCheckpointDir(named or tempfile.mkdtemp(prefix="checkpoints-"))
    return sc._jsc.sc().getCheckpointDir().get()


def cut(df: DataFrame) -> DataFrame:
    """Write ``df`` to the shared folder and go on from there: lost executors lose nothing."""
    folder(df.sparkSession)
    return df.checkpoint(eager=True)
