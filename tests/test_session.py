"""How the rows of a scan are dealt out."""

from pagequarry.session import spread


def test_the_share_of_a_task_is_bounded(spark, tmp_path):
    cores = spark.sparkContext.defaultParallelism
    spark.range(0, 1000, 1, 1).write.parquet(str(tmp_path / "t"))
    scan = spark.read.parquet(str(tmp_path / "t"))
    assert spread(scan).rdd.getNumPartitions() == cores
    dealt = spread(scan, 50)
    assert dealt.rdd.getNumPartitions() == 20
    sizes = dealt.rdd.mapPartitions(lambda rows: [sum(1 for _ in rows)]).collect()
    assert sum(sizes) == 1000 and max(sizes) <= 60
    # A scan with parts enough is left alone.
    assert spread(dealt, 50) is dealt
