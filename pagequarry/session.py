"""Session settings for tests and benchmarks; a cluster brings its own session."""

from __future__ import annotations

import tempfile
import zipfile
from contextlib import contextmanager
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession


def local_session(cpus: int | str = "*", partitions: int = 8, **conf: str) -> SparkSession:
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("pagequarry")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
    )
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


@contextmanager
def small_arrow_batches(spark: SparkSession, rows: int | None = 10):
    """Hand documents to Python workers a few at a time, for the jobs run inside.

    Whole files can be large, so a parse job wants few rows per Arrow batch; every
    other job in the session keeps its setting.
    """
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    spark.conf.set(key, str(rows or before))
    try:
        yield
    finally:
        spark.conf.set(key, before)


def spread(scan: DataFrame, rows_per_task: int | None = None) -> DataFrame:
    """Deal the rows of a table scan out to all cores when it has fewer parts than that.

    For costly steps, ``rows_per_task`` asks for as many parts as keep a task's share bounded
    however large the table is; the rows are counted for it. A scan with parts enough is
    left alone.
    """
    parts = scan.sparkSession.sparkContext.defaultParallelism
    if rows_per_task:
        parts = max(parts, -(-scan.count() // rows_per_task))
    return scan.repartition(parts) if scan.rdd.getNumPartitions() < parts else scan


def ship_package(spark: SparkSession) -> None:
    """Make this package importable in the Python workers, once per session.

    Same as passing it with ``--py-files``; needed where only the driver has it.
    """
    context = spark.sparkContext
    if any(name.startswith("pagequarry") for name in context._python_includes):
        return
    package = Path(__file__).resolve().parent
    archive = Path(tempfile.mkdtemp(prefix="pagequarry-")) / "pagequarry.zip"
    with zipfile.ZipFile(archive, "w") as out:
        for source in sorted(package.rglob("*.py")):
            out.write(source, source.relative_to(package.parent))
    context.addPyFile(str(archive))
