from pyspark.sql import functions as F

from pagequarry.operators.ids import hash_id, request_batches, wide_id, with_dense_ids


def rows(spark, n):
    return spark.range(n).select(F.concat(F.lit("u"), F.col("id") % 7).alias("url"), F.col("id").alias("ix"))


def test_dense_ids_follow_the_order_of_the_keys(spark):
    expected = None
    for parts in (1, 5):
        numbered = with_dense_ids(rows(spark, 1000).repartition(parts), ["url", "ix"])
        got = [(r.url, r.ix, r.id) for r in numbered.orderBy("url", "ix").collect()]
        assert [i for *_, i in got] == list(range(1, 1001))
        assert expected in (None, got)
        expected = got


def test_hash_ids_do_not_depend_on_the_partitions(spark):
    key = hash_id(F.col("url"), F.col("ix"))
    a = rows(spark, 1000).withColumn("id", key)
    b = rows(spark, 1000).repartition(6).withColumn("id", key)
    assert {tuple(r) for r in a.collect()} == {tuple(r) for r in b.collect()}
    assert a.select("id").distinct().count() == 1000
    assert a.select(wide_id(F.col("url"), F.col("ix")).alias("w")).where("length(w) = 32").distinct().count() == 1000
    assert a.schema["id"].dataType.simpleString() == "bigint"


def test_request_batches(spark):
    batches = request_batches(rows(spark, 301), ["ix"], 150)
    sizes = {r.batch: r.n for r in batches.groupBy("batch").agg(F.count("*").alias("n")).collect()}
    assert sizes == {0: 150, 1: 150, 2: 1}
