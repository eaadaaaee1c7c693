"""Compressed search against brute force, and what it reads and ranks again."""

import numpy as np
import pytest
from conftest import plan
from pyspark.sql import functions as F
from test_nearest import brute_force, frame, random_vectors, ranks

from pagequarry.operators import nearest, quantise


@pytest.mark.parametrize("question_bytes", [1 << 20, 64])
@pytest.mark.parametrize("metric", ["l2", "cosine"])
def test_exact_with_copies(spark, metric, question_bytes):
    q, x = random_vectors(1, 30), random_vectors(2, 300, hot=0.4)
    codes = quantise.build_codes(frame(spark, x, "id"), parts=3, metric=metric, sample=100)
    found = quantise.search_codes(codes, frame(spark, q, "qid"), 5, question_bytes)
    assert ranks(found) == brute_force(q, x, 5, metric)


def test_poor_codes_are_exact_too(spark):
    q, x = random_vectors(3, 20, dim=9), random_vectors(4, 400, dim=9)
    codes = quantise.build_codes(frame(spark, x, "id"), parts=2, sample=3)
    assert ranks(quantise.search_codes(codes, frame(spark, q, "qid"), 4)) == brute_force(q, x, 4, "l2")


def test_codes_rule_out_nearly_all_rows_and_read_no_vectors(spark):
    rng = np.random.default_rng(5)
    centres = rng.normal(size=(20, 32)) * 4
    x = (centres[rng.integers(20, size=4000)] + rng.normal(size=(4000, 32)) * 0.5).astype(np.float32)
    q = x[:50] + rng.normal(size=(50, 32)).astype(np.float32) * 0.1
    codes = quantise.build_codes(frame(spark, x, "id"), parts=16)
    block = nearest.collect_questions(frame(spark, q, "qid"))
    found = quantise.candidates(codes, block, 4, "bigint")
    assert found.count() < 0.05 * 50 * 4000
    scan = codes.rows.select("id", "code", "slack", "same")
    assert "embedding" not in plan(scan).split("ReadSchema")[1]
    assert codes.bytes_per_row() == 32 < 4 * 32


def test_odd_rows(spark):
    rows = [(1, [0.0, 0.0]), (2, None), (3, [float("nan"), 1.0]), (4, [1e20, 1.0]), (5, [1.0, 1.0]), (6, [1.0, 1.0])]
    corpus = spark.createDataFrame(rows, "id long, embedding array<float>")
    q = spark.createDataFrame([(1, [0.0, 0.1]), (2, None)], "qid long, embedding array<float>")
    for k in (2, 5):
        got = quantise.search_codes(quantise.build_codes(corpus), q, k)
        assert [r[:3] for r in ranks(got)] == [r[:3] for r in ranks(nearest.nearest(q, corpus, k))]
    empty = quantise.build_codes(corpus.limit(0))
    assert quantise.search_codes(empty, q).count() == 0
    assert quantise.search_codes(quantise.build_codes(corpus), q.limit(0)).count() == 0
    with pytest.raises(ValueError):
        quantise.build_codes(corpus, metric="ip")


def test_question_blocks_are_bounded_and_whole(spark):
    q = frame(spark, random_vectors(6, 500), "qid")
    blocks = list(nearest.question_blocks(q, 48 * 40))
    assert max(len(b.vectors) for b in blocks) <= 40 and len(blocks) <= 2 * 500 // 40 + 1
    assert sorted(i for b in blocks for i in b.ids.to_pylist()) == list(range(500))


def test_many_questions_leave_the_corpus_in_place(spark):
    q, x = frame(spark, random_vectors(7, 100), "qid"), frame(spark, random_vectors(8, 200), "id")
    block = next(nearest.question_blocks(q, 48 * 20))
    corpus = x.coalesce(4)
    text = plan(nearest.top_k(nearest._scanned(block, q, corpus, 3, "l2"), 3))
    # One exchange, of the k best rows of each task; none of vectors.
    tree = text.split("(1)")[0]
    assert tree.count("Exchange") == 1 + plan(corpus).split("(1)")[0].count("Exchange")
    small = nearest.nearest(q, x, 3, question_bytes=64, block_bytes=1 << 20)
    assert ranks(small) == brute_force(random_vectors(7, 100), random_vectors(8, 200), 3, "l2")
    assert small.where(F.col("rank") > 3).count() == 0


def test_codes_that_rule_out_nothing_keep_no_pairs(spark):
    rng = np.random.default_rng(9)
    x = rng.normal(size=(600, 24)).astype(np.float32)
    codes = quantise.build_codes(frame(spark, x, "id").coalesce(2), parts=2, sample=3)
    q = frame(spark, x[:80], "qid")
    block = nearest.collect_questions(q)
    assert quantise.candidates(codes, block, 4, "bigint").count() > 80 * 600 // 2
    # What leaves the tasks is the best of each, not the pairs.
    found = quantise._nearest_by_codes(codes, block, 4, "bigint")
    assert found.count() <= 80 * 4 * found.rdd.getNumPartitions()
    assert ranks(quantise.search_codes(codes, q, 4)) == brute_force(x[:80], x, 4, "l2")


@pytest.mark.parametrize("kind", ["spread", "together", "large", "copies", "clusters"])
def test_limits_and_open_pairs_leave_out_nothing_near(monkeypatch, kind):
    rng = np.random.default_rng(12)
    x = rng.normal(size=(700, 8))
    if kind == "together":
        x = 100 + x * 1e-6
    elif kind == "large":
        x[::3] *= 1e18
    elif kind == "copies":
        x = x[rng.integers(0, 20, len(x))]
    elif kind == "clusters":
        x = rng.normal(size=(9, 8))[rng.integers(0, 9, len(x))] * 5 + x * 0.1
    q, k = x[:90] + (kind == "spread") * 0.1, 3
    monkeypatch.setattr(quantise, "QUESTION_STEP", 40)
    decoded = x + rng.normal(size=x.shape) * 0.05
    slack = np.sqrt(((x - decoded) ** 2).sum(axis=1))
    order = np.argsort(slack)
    x, decoded, slack = x[order], decoded[order], slack[order]
    scan, l2 = quantise._Scan(q, [], k), nearest.Distances("l2")
    best = np.full((len(q), k), np.inf)
    for at in range(0, len(x), 250):
        scan.lower(best, scan.asked(), decoded[at : at + 250], slack[at : at + 250])
    limit = best.max(axis=1)
    exact = np.stack([l2.pairs(np.broadcast_to(a, x.shape), x) for a in q])
    kth = np.sort(exact, axis=1)[:, k - 1]
    assert (limit**2 + 1e-8 >= kth).all() and (kind == "large" or np.isfinite(limit).all())
    rows = nearest.Rows.of(decoded, np.arange(len(x)), l2)
    found = np.concatenate(
        [scan.open(np.sqrt(kth[c]), some, rows, slack) for c, some in zip(scan.chunks(), scan.asked(), strict=True)]
    )
    assert found[exact <= kth[:, None]].all()
    assert kind != "clusters" or found.mean() < 0.2
    # Rows of unknown slack and questions without a limit stay open.
    slack[5], kth[3] = np.inf, np.inf
    found = scan.open(np.sqrt(kth[:40]), scan.asked()[0], rows, slack)
    assert found[:, 5].all() and found[3].all()


def test_scans_make_no_product_in_double_precision(spark, monkeypatch):
    q, x = random_vectors(61, 60), random_vectors(62, 500, hot=0.2)
    codes = quantise.build_codes(frame(spark, x, "id"), parts=3)

    def scan(self, batch):
        raise AssertionError("double precision")

    monkeypatch.setattr(quantise._Scan, "bounds", scan)
    assert ranks(quantise.search_codes(codes, frame(spark, q, "qid"), 4)) == brute_force(q, x, 4, "l2")
