import numpy as np
import pytest
from conftest import plan
from pyspark.sql import functions as F

from pagequarry.operators.embed import Embedder, embed, hashed_words
from pagequarry.session import small_arrow_batches


def sizes():
    """A model whose vectors say how many texts came in the request, and which."""

    def load():
        return lambda texts: [[float(len(texts)), float(t)] for t in texts]

    return Embedder("sizes", 2, load)


def numbers(spark, n):
    return spark.range(n).coalesce(1).select("id", F.col("id").cast("string").alias("text"))


@pytest.mark.parametrize("arrow_rows", [10, 1000])
def test_requests_of_150_in_order_across_arrow_batches(spark, arrow_rows):
    with small_arrow_batches(spark, arrow_rows):
        rows = numbers(spark, 301).withColumn("v", embed(F.col("text"), sizes())).collect()
    assert all(r.v[1] == r.id for r in rows)
    assert [r.v[0] for r in rows] == [150.0] * 300 + [1.0]
    assert spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch") == "10000"


def test_null_text_has_no_vector(spark):
    df = spark.createDataFrame([("1",), (None,), ("2",)], "text string").coalesce(1)
    rows = df.select(embed(F.col("text"), sizes())).collect()
    assert [r[0] for r in rows] == [[2.0, 1.0], None, [2.0, 2.0]]


def test_model_error_fails_the_job(spark):
    def broken():
        def call(texts):
            raise RuntimeError("no model")

        return call

    with pytest.raises(Exception, match="no model"):
        numbers(spark, 1).select(embed(F.col("text"), Embedder("broken", 1, broken))).collect()


@pytest.mark.parametrize("wrong", [lambda t: [[1.0]] * len(t), lambda t: [[1.0, 2.0]]])
def test_model_must_give_one_vector_per_text(spark, wrong):
    def load():
        return wrong

    with pytest.raises(Exception, match="not one vector of 2 per text"):
        df = numbers(spark, 3).select(embed(F.col("text"), Embedder("wrong", 2, load)))
        df.collect()


def test_filter_on_vectors_does_not_embed_twice(spark):
    df = numbers(spark, 3).withColumn("v", embed(F.col("text"), hashed_words(4)))
    assert plan(df.where(F.size("v") > 0).select("v"), "simple").count("ArrowEvalPython") == 1


def test_hashed_words():
    call = hashed_words(8).load()
    one, same, empty = call(["a b b", "b a\nb", " "])
    assert (one == same).all() and one.dtype == np.float32
    assert np.isclose((one**2).sum(), 1) and (empty == 0).all()
