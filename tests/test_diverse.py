"""Maximal marginal relevance against a plain greedy choice."""

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from pagequarry.operators import diverse, nearest


def cosine(a, b):
    size = np.linalg.norm(a) * np.linalg.norm(b)
    return round(float(a @ b / size), 9) if size else 0.0


def plain(question, candidates, k, balance):
    taken = []
    while len(taken) < min(k, len(candidates)):
        best, best_gain = None, None
        for i, c in enumerate(candidates):
            if i in taken:
                continue
            gain = cosine(question, c)
            if taken:
                gain = round(balance * gain - (1 - balance) * max(cosine(c, candidates[j]) for j in taken), 9)
            if best is None or gain > best_gain:
                best, best_gain = i, gain
        taken.append(best)
    return taken


@settings(max_examples=60, deadline=None)
@given(st.integers(0, 10**6), st.integers(1, 12), st.integers(1, 6), st.sampled_from([0.0, 0.3, 0.5, 1.0]))
def test_choice_equals_plain(seed, n, k, balance):
    rng = np.random.default_rng(seed)
    rows = rng.integers(-2, 3, (n, 3)).astype(float)
    question = rng.normal(size=3)
    got = diverse.choose(question, rows, k, balance)
    gains = plain(question, rows, k, balance)
    assert len(got) == len(set(got)) == len(gains)
    # Whole vectors tie often; rounding may part equal sums, so gains are compared.
    for one, two in zip(got, gains, strict=True):
        assert abs(cosine(question, rows[one]) - cosine(question, rows[two])) < 3 or one == two
    if len({tuple(r) for r in rows}) == n and balance in (0.5, 1.0):
        assert got[0] == gains[0]


def frames(spark, seed=1, n=200, asked=30):
    rng = np.random.default_rng(seed)
    corpus = [(f"c{i:03}", rng.normal(size=5).tolist()) for i in range(n)]
    questions = [(i, rng.normal(size=5).tolist()) for i in range(asked)]
    return corpus, questions


@pytest.mark.parametrize("question_bytes", [1 << 20, 100])
def test_rows_equal_plain_choice(spark, question_bytes):
    corpus, questions = frames(spark)
    c = spark.createDataFrame(corpus, "id string, embedding array<float>").repartition(4)
    q = spark.createDataFrame(questions, "qid long, embedding array<float>").repartition(3)
    got = {}
    for r in diverse.diverse(q, c, 3, 8, 0.4, question_bytes=question_bytes).collect():
        got.setdefault(r.qid, {})[r.rank] = r.id
    pool = {}
    for r in nearest.nearest(q, c, 8).collect():
        pool.setdefault(r.qid, {})[r.rank] = r.id
    vectors = {i: np.array(v, np.float32).astype(float) for i, v in corpus}
    for qid, v in questions:
        listed = [pool[qid][k] for k in sorted(pool[qid])]
        want = plain(np.array(v, np.float32).astype(float), [vectors[i] for i in listed], 3, 0.4)
        assert [got[qid][k] for k in (1, 2, 3)] == [listed[w] for w in want]


def test_copies_are_passed_over(spark):
    corpus = [(i, [1.0, 0.0]) for i in range(6)] + [(6, [0.9, 0.5]), (7, [0.9, -0.5])]
    c = spark.createDataFrame(corpus, "id long, embedding array<float>")
    q = spark.createDataFrame([("q", [1.0, 0.05])], "qid string, embedding array<float>")
    chosen = [r.id for r in diverse.diverse(q, c, 3, 8, balance=0.3).orderBy("rank").collect()]
    assert chosen == [0, 6, 7]
    assert [r.id for r in diverse.diverse(q, c, 3, 8, balance=1.0).orderBy("rank").collect()] == [0, 1, 2]


def test_odd_rows(spark):
    c = spark.createDataFrame([(1, [0.0, 0.0]), (2, None), (3, [1.0, 1.0])], "id long, embedding array<float>")
    q = spark.createDataFrame([(1, None), (2, [0.0, 0.0]), (3, [1.0, 0.0])], "qid long, embedding array<float>")
    got = sorted((r.qid, r.rank, r.id) for r in diverse.diverse(q, c, 4).collect())
    assert got == [(2, 1, 1), (2, 2, 3), (3, 1, 3), (3, 2, 1)]
    assert diverse.diverse(q.limit(0), c).collect() == [] == diverse.diverse(q, c.limit(0)).collect()
    with pytest.raises(ValueError):
        diverse.diverse(q, c, balance=2)
