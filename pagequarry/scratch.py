"""Shared scratch space: written tables that cut lineage and survive lost executors."""

from __future__ import annotations

import tempfile
import uuid
from functools import lru_cache

from pyspark.sql import DataFrame, SparkSession


def scratch_root(spark: SparkSession) -> str:
    """The folder the cluster names in ``spark.checkpoint.dir``.

    Only a local-mode session without that setting gets a temporary folder: on a
    cluster, other machines could not read it.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder all executors share")
    return _local_root(spark.sparkContext.applicationId)


@lru_cache
def _local_root(application: str) -> str:
    """One temporary folder per local application."""
    return tempfile.mkdtemp(prefix=f"pagequarry-{application}-")


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new folder, below one per application that can be removed when it has ended."""
    application = spark.sparkContext.applicationId
    return f"{scratch_root(spark)}/pagequarry/{application}/{uuid.uuid4().hex}/{label}"


def materialise(df: DataFrame, label: str, partition_by: str | None = None) -> DataFrame:
    """Write ``df`` once to shared scratch and read it back.

    Used where a result is read twice and must be the same both times (row
    positions, model calls), or is costly to compute again.
    """
    spark = df.sparkSession
    path = scratch_path(spark, label)
    df.write.parquet(path, partitionBy=partition_by)
    return spark.read.schema(df.schema).parquet(path)
