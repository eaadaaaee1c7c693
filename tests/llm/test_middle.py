"""Fill-in-middle against a plain version."""

import hashlib
import random
import re

import pytest
from pyspark.sql import functions as F

from pagequarry.llm import middle


def plain(doc_id, text):
    text = text or ""
    units = re.findall("[A-Za-z]+|[^A-Za-z]", text)
    name = "1:" + ("" if doc_id is None else str(doc_id))
    digest = hashlib.sha256(name.encode()).hexdigest()
    h = [int(digest[8 * k : 8 * k + 8], 16) for k in range(4)]
    a, b = sorted([h[0] % (len(units) + 1), h[1] % (len(units) + 1)])
    prefix, mid, suffix = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if not text or re.search("<[PSM]>", text) or h[2] % 100 >= 90:
        return len(units), "plain", text, None
    if h[3] % 100 < 20:
        return len(units), "spm", f"<S>{suffix}<P>{prefix}<M>{mid}", (prefix, mid, suffix)
    return len(units), "psm", f"<P>{prefix}<S>{suffix}<M>{mid}", (prefix, mid, suffix)


def texts():
    rng = random.Random(3)
    pieces = ["ab", "Z", " ", "\n", "é", "\U0001f600", "<P>", "<", "P>", "<S", "$1", "\\", "7", "\0"]
    odd = [None, "", "a", "<", "a" * 100_000, "a1" * 200_000, "\n" * 5000, "\U0001f600" * 3000]
    return odd + ["".join(rng.choices(pieces, k=rng.randint(0, 12))) for _ in range(600)]


@pytest.fixture(scope="module")
def rows():
    return [(i, t, "x") for i, t in enumerate(texts())] + [(None, "no id at all", "x")] * 2


def test_forms_and_parts(spark, rows):
    docs = spark.createDataFrame(rows, "doc_id long, text string, form string")
    made = middle.fill_in_middle(docs).withColumn("cut", middle.parts(F.col("output"), F.col("form")))
    made = made.withColumn("restored", middle.restore(F.col("output"), F.col("cut")))
    got = [(r.doc_id, r.n, r.form, r.output, r.cut and tuple(r.cut), r.restored) for r in made.collect()]
    want = [(i, *plain(i, t), t or "") for i, t, _ in rows]
    key = lambda r: (r[0] is None, r[0] or 0)
    assert sorted(got, key=key) == sorted(want, key=key)
    assert {r[2] for r in got} == {"plain", "psm", "spm"}


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string, n string")
    assert middle.fill_in_middle(docs).collect() == []


def test_shares_and_seed(spark):
    docs = spark.range(2000).select(F.col("id").alias("doc_id"), F.lit("one two three").alias("text"))
    forms = {r.form: r["count"] for r in middle.fill_in_middle(docs).groupBy("form").count().collect()}
    assert 130 < forms["plain"] < 270 and 270 < forms["spm"] < 450
    only = middle.fill_in_middle(docs, seed="2", plain_from=100, spm_below=0)
    assert [r.form for r in only.select("form").distinct().collect()] == ["psm"]


def test_no_python_worker_and_no_shuffle(spark):
    from conftest import plan

    docs = spark.range(5).select(F.col("id").alias("doc_id"), F.lit("a b").alias("text"))
    text = plan(middle.fill_in_middle(docs))
    assert "Python" not in text and "Exchange" not in text
