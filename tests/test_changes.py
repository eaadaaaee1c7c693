from pyspark.sql import functions as F

from pagequarry.operators.changes import apply_changes, snapshot_changes

COLUMNS = "id long, v string, n long"


def changes_of(spark, old, new):
    frames = [spark.createDataFrame(rows, COLUMNS) for rows in (old, new)]
    return snapshot_changes(*frames, "id")


def test_snapshot_changes(spark):
    old = [(1, "a", 0), (2, "b", 0), (3, "c", 0)]
    new = [(1, "a", 0), (2, "B", 0), (4, "d", None)]
    assert {tuple(r) for r in changes_of(spark, old, new).collect()} == {
        (2, "update", "B", 0),
        (3, "delete", None, None),
        (4, "insert", "d", None),
    }


def test_null_differs_from_empty_and_between_columns(spark):
    old = [(1, None, 0), (2, "x", None), (3, None, None)]
    new = [(1, "", 0), (2, None, None), (3, None, None)]
    assert {r.id for r in changes_of(spark, old, new).collect()} == {1, 2}


def test_applying_the_changes_gives_the_new_snapshot(spark):
    old = [(i, f"v{i}", i) for i in range(60)]
    new = [(i, f"v{i}" if i % 3 else "new", i) for i in range(20, 90)]
    feed = changes_of(spark, old, new).withColumn("version", F.lit(1))
    applied = apply_changes(spark.createDataFrame(old, COLUMNS), feed, "id", "version")
    assert sorted(tuple(r) for r in applied.collect()) == new


def test_latest_version_of_a_hot_key_wins(spark):
    base = spark.createDataFrame([(0, "old", 1), (1, "kept", 1)], COLUMNS)
    feed = spark.range(5000).select(
        F.when(F.col("id") < 4000, 0).otherwise(F.col("id")).alias("id"),
        F.lit("update").alias("change"),
        F.concat(F.lit("v"), "id").alias("v"),
        F.col("id").alias("n"),
        F.col("id").alias("version"),
    )
    deleted = feed.withColumn(
        "change", F.when(F.col("version") == 4500, "delete").otherwise(F.col("change"))
    )
    got = {r.id: r.v for r in apply_changes(base, deleted.repartition(9), "id", "version").collect()}
    assert got[0] == "v3999" and got[1] == "kept" and 4500 not in got and len(got) == 1001


def test_microseconds_are_a_change(spark):
    old = spark.sql("SELECT 1 AS id, struct(timestamp'2024-01-01 00:00:00.000123') AS s, timestamp_ntz'2024-01-01 00:00:00' AS t")
    nested = spark.sql("SELECT 1 AS id, struct(timestamp'2024-01-01 00:00:00.000999') AS s, timestamp_ntz'2024-01-01 00:00:00' AS t")
    plain = spark.sql("SELECT 1 AS id, struct(timestamp'2024-01-01 00:00:00.000123') AS s, timestamp_ntz'2024-01-01 00:00:00.000001' AS t")
    assert snapshot_changes(old, old, "id").count() == 0
    assert [r.change for r in snapshot_changes(old, nested, "id").collect()] == ["update"]
    assert [r.change for r in snapshot_changes(old, plain, "id").collect()] == ["update"]
