"""Snapshots compared by their digests."""

import re

import pytest
from conftest import plan
from pyspark.sql import functions as F

from pagequarry.operators.changes import snapshot_changes
from pagequarry.sources import snapshots


def rows(spark, n=400):
    return spark.range(n).select(
        F.col("id"), F.concat(F.lit("text "), F.col("id").cast("string")).alias("text"),
        F.when(F.col("id") % 7 > 0, F.col("id")).alias("number"), F.lit("x").alias("bucket"),
    )


def test_only_differing_buckets_are_read(spark, tmp_path):
    old = rows(spark)
    new = old.withColumn("text", F.when(F.col("id") == 5, "changed").otherwise(F.col("text")))
    new = new.where("id <> 11").unionByName(old.where("id = 3").withColumn("id", F.lit(9000).cast("long")))
    one, two = str(tmp_path / "one"), str(tmp_path / "two")
    snapshots.write_snapshot(old, "id", one, 64, 8)
    snapshots.write_snapshot(new.repartition(7), "id", two, 64, 8)
    buckets = snapshots.changed_buckets(spark, one, two)
    assert 1 <= len(buckets) <= 3
    read = snapshots.read_snapshot(spark, two, buckets)
    assert re.search(r"PartitionFilters: \[[^]]*bucket", plan(read))
    got = {tuple(r) for r in snapshots.stored_changes(spark, one, two, "id").collect()}
    assert got == {tuple(r) for r in snapshot_changes(old, new, "id").collect()}
    assert {(r[0], r[1]) for r in got} == {(5, "update"), (11, "delete"), (9000, "insert")}


def test_equal_snapshots_in_any_order(spark, tmp_path):
    one, two = str(tmp_path / "one"), str(tmp_path / "two")
    snapshots.write_snapshot(rows(spark), "id", one, 16, 4)
    snapshots.write_snapshot(rows(spark).orderBy(F.desc("id")).repartition(5), "id", two, 16, 4)
    assert snapshots.changed_buckets(spark, one, two) == []
    assert snapshots.stored_changes(spark, one, two, "id").count() == 0
    assert snapshots.read_snapshot(spark, one).count() == 400


def test_an_empty_snapshot(spark, tmp_path):
    one, two = str(tmp_path / "one"), str(tmp_path / "two")
    snapshots.write_snapshot(rows(spark, 0), "id", one, 8, 2)
    snapshots.write_snapshot(rows(spark, 3), "id", two, 8, 2)
    assert snapshots.read_snapshot(spark, one).count() == 0
    assert {r.change for r in snapshots.stored_changes(spark, one, two, "id").collect()} == {"insert"}
    assert snapshots.stored_changes(spark, two, one, "id").count() == 3


def test_nulls_and_other_shapes(spark, tmp_path):
    roots = [str(tmp_path / n) for n in "abc"]
    a = spark.createDataFrame([(1, None), (2, ""), (None, "x")], "id long, text string")
    b = spark.createDataFrame([(1, ""), (2, None), (None, "x")], "id long, text string")
    snapshots.write_snapshot(a, "id", roots[0], 8, 2)
    snapshots.write_snapshot(b, "id", roots[1], 8, 2)
    found = snapshots.stored_changes(spark, roots[0], roots[1], "id").collect()
    assert {(r.id, r.change) for r in found if r.id is not None} == {(1, "update"), (2, "update")}
    snapshots.write_snapshot(b, "id", roots[2], 16, 2)
    with pytest.raises(ValueError):
        snapshots.changed_buckets(spark, roots[0], roots[2])
