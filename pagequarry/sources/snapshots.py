"""Snapshots of a table that know their digests, so two of them are compared by these.

Rows lie in buckets by the hash of their key. Each bucket has a digest of its rows, whatever
their order; each branch of neighbouring buckets has the sum of theirs. Comparing two
snapshots reads the branches, the digests of branches that differ, and the rows of buckets
that differ: what is read follows the change, not the table.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from pagequarry.operators.changes import fingerprint, snapshot_changes

BUCKETS, BRANCHES = 1024, 32
PARTS = 4  # numbers of a digest, of 60 bits each


def _sums(numbers: list[Column]) -> list[Column]:
    """Digests add up: equal rows in any order and number of files have equal sums."""
    return [F.sum(x).alias(f"d{k}") for k, x in enumerate(numbers)]


def write_snapshot(
    df: DataFrame, key: str, root: str, buckets: int = BUCKETS, branches: int = BRANCHES
) -> None:
    """Write ``df`` below ``root`` with its digests. Snapshots are compared with others of as
    many buckets."""
    spark = df.sparkSession
    bucket = F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int")
    rows = df.select(
        F.struct(*df.columns).alias("row"),
        fingerprint(*df.columns).alias("print"),
        bucket.alias("bucket"),
    )
    rows.hint("rebalance", "bucket").write.partitionBy("bucket").parquet(f"{root}/rows")
    about = [(buckets, branches, df.schema.json())]
    spark.createDataFrame(about, ABOUT).coalesce(1).write.parquet(f"{root}/about")
    numbers = [
        F.conv(F.substring("print", 15 * k + 1, 15), 16, 10).cast("decimal(38,0)") for k in range(PARTS)
    ]
    written = _rows(spark, root).groupBy("bucket").agg(F.count("*").alias("n"), *_sums(numbers))
    branch = F.floor(F.col("bucket") * branches / buckets).cast("int").alias("branch")
    written.select("*", branch).write.partitionBy("branch").parquet(f"{root}/leaves")
    whole = _leaves(spark, root).groupBy("branch")
    tops = whole.agg(F.sum("n").alias("n"), *_sums([F.col(f"d{k}") for k in range(PARTS)]))
    tops.coalesce(1).write.parquet(f"{root}/tops")


ABOUT = "buckets int, branches int, schema string"
DIGEST = "n long, " + ", ".join(f"d{k} decimal(38,0)" for k in range(PARTS))


def _rows(spark: SparkSession, root: str) -> DataFrame:
    schema = StructType.fromJson(json.loads(spark.read.schema(ABOUT).parquet(f"{root}/about").first().schema))
    stored = StructType().add("row", schema).add("print", "string").add("bucket", "integer")
    return spark.read.schema(stored).parquet(f"{root}/rows")


def _leaves(spark: SparkSession, root: str) -> DataFrame:
    return spark.read.schema(f"bucket int, {DIGEST}, branch int").parquet(f"{root}/leaves")


def read_snapshot(spark: SparkSession, root: str, buckets: list[int] | None = None) -> DataFrame:
    """The rows of a snapshot, or of some of its buckets."""
    rows = _rows(spark, root)
    if buckets is not None:
        rows = rows.where(F.col("bucket").isin(buckets))
    return rows.select("row.*")


def _differing(old: DataFrame, new: DataFrame, name: str) -> list[int]:
    """Branches or buckets whose digests differ; at most as many as there are."""
    columns = ["n", *[f"d{k}" for k in range(PARTS)]]
    a, b = (
        df.select(F.col(name), F.struct(*[F.col(c).cast("string") for c in columns]).alias(side))
        for df, side in ((old, "before"), (new, "after"))
    )
    joined = a.join(b, name, "full_outer").where(~F.col("before").eqNullSafe(F.col("after")))
    return sorted(r[0] for r in joined.select(name).collect())


def changed_buckets(spark: SparkSession, old: str, new: str) -> list[int]:
    """The buckets in which two snapshots differ."""
    abouts = [spark.read.schema(ABOUT).parquet(f"{root}/about").first() for root in (old, new)]
    if abouts[0][:2] != abouts[1][:2]:
        raise ValueError("snapshots of different numbers of buckets")
    tops = [spark.read.schema(f"branch int, {DIGEST}").parquet(f"{r}/tops") for r in (old, new)]
    branches = _differing(*tops, "branch")
    leaves = [_leaves(spark, root).where(F.col("branch").isin(branches)) for root in (old, new)]
    return _differing(*leaves, "bucket") if branches else []


def stored_changes(spark: SparkSession, old: str, new: str, key: str) -> DataFrame:
    """``snapshot_changes`` of two written snapshots, from the buckets that differ."""
    buckets = changed_buckets(spark, old, new)
    before, after = (read_snapshot(spark, root, buckets) for root in (old, new))
    return snapshot_changes(before, after, key)
