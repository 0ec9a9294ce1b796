"""What every session needs before its first query."""

from __future__ import annotations

import os
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

HOME = str(Path(__file__).resolve().parent.parent)


def ready(spark: SparkSession) -> SparkSession:
    """Lets Python workers on this machine import the package. On a cluster, ship it with --py-files or addPyFile."""
    env = spark.sparkContext.environment
    known = env.get("PYTHONPATH", "").split(os.pathsep)
    if HOME not in known:
        env["PYTHONPATH"] = os.pathsep.join([HOME, *filter(None, known)])
    return spark


def spread(df: DataFrame) -> DataFrame:
    """df in as many parts as there are cores, where a small input has fewer: for work that costs more than moving the rows once."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df._jdf.queryExecution().toRdd().getNumPartitions() < cores else df
