import numpy as np
import pyarrow as pa
import pytest
from conftest import plan
from pyspark.sql import functions as F

from pagequarry.operators import index, nearest

BLOCKED = {"question_bytes": 64, "block_bytes": 640}


def frame(spark, vectors, name, as_text=False):
    rows = [(f"k{i:04d}" if as_text else i, [float(x) for x in v]) for i, v in enumerate(vectors)]
    kind = "string" if as_text else "long"
    return spark.createDataFrame(rows, f"{name} {kind}, embedding array<float>").repartition(5)


def random_vectors(seed, n, dim=6, hot=0.0):
    """Random vectors, a share of them copies of one."""
    rng = np.random.default_rng(seed)
    vectors = rng.normal(size=(n, dim)).astype(np.float32) * rng.uniform(0.5, 2, size=(n, 1))
    vectors[: int(hot * n)] = vectors[0]
    return vectors.astype(np.float32).astype(np.float64)


def brute_force(q, x, k, metric):
    expected = []
    for i, a in enumerate(q):
        if metric == "l2":
            dist = ((a - x) ** 2).sum(axis=1)
        elif metric == "ip":
            dist = 1 - x @ a
        else:
            dist = 1 - (x @ a) / (np.linalg.norm(a) * np.linalg.norm(x, axis=1))
        ranked = sorted((round(d, 9), j) for j, d in enumerate(dist))[:k]
        expected += [(i, r + 1, j) for r, (_, j) in enumerate(ranked)]
    return expected


def ranks(found):
    return [(r.qid, r.rank, r.id) for r in found.orderBy("qid", "rank").collect()]


@pytest.mark.parametrize("limits", [{}, BLOCKED], ids=["sent", "blocked"])
@pytest.mark.parametrize("metric", nearest.METRICS)
def test_nearest_is_exact_with_ties(spark, metric, limits):
    q, x = random_vectors(1, 30), random_vectors(2, 200, hot=0.4)
    found = nearest.nearest(frame(spark, q, "qid"), frame(spark, x, "id"), 5, metric, **limits)
    assert ranks(found) == brute_force(q, x, 5, metric)


def test_many_questions_are_split_too(spark):
    q, x = random_vectors(3, 200), random_vectors(4, 40)
    questions = frame(spark, q, "qid").select(F.lit(0).cast("bigint").alias("group"), "*")
    corpus = frame(spark, x, "id").select(F.lit(0).cast("bigint").alias("group"), "*")
    joined = nearest.join_groups(questions, corpus, 3, "l2", corpus_rows=15, question_rows=30)
    assert ranks(nearest.top_k(joined, 3)) == brute_force(q, x, 3, "l2")


def test_surplus_copies_are_left_out_only_where_they_cannot_matter():
    x = np.array([[1.0, 2.0], [0.0, 0.0], [1.0, 2.0], [1.0, 2.0], [3.0, 4.0]])
    kept, ids = nearest.without_surplus_copies(x, np.array([9, 8, 3, 5, 1]), 2)
    assert sorted(zip(map(tuple, kept), ids)) == [
        ((0.0, 0.0), 8), ((1.0, 2.0), 3), ((1.0, 2.0), 5), ((3.0, 4.0), 1),
    ]
    same = nearest.without_surplus_copies(x[:2], np.array([1, 2]), 1)
    assert (same[0] == x[:2]).all()


def test_blocks_of_a_hot_group_stay_small(spark):
    groups = F.when(F.col("id") < 4000, 0).otherwise(F.col("id")).cast("bigint").alias("group")
    vector = F.array(F.lit(1.0)).cast("array<float>").alias("embedding")
    corpus = spark.range(10_000).select(groups, "id", vector)
    questions = corpus.withColumnRenamed("id", "qid")
    large = nearest.large_groups(questions, corpus, 500, 1000).collect()
    assert [tuple(r) for r in large] == [(0, 8, 4)]
    placed = nearest._placed(corpus.where("group = 0"), "corpus", F.lit(8), F.lit(4))
    sizes = [r.n for r in placed.groupBy(*nearest.BLOCK).agg(F.count("*").alias("n")).collect()]
    assert len(sizes) == 32 and max(sizes) < 700


def test_results_are_the_same_without_broadcasts(spark, monkeypatch):
    monkeypatch.setattr(nearest, "BROADCAST_ROWS", 0)
    q, x = random_vectors(23, 20), random_vectors(24, 120, hot=0.4)
    questions, corpus = frame(spark, q, "qid"), frame(spark, x, "id")
    expected = brute_force(q, x, 3, "l2")
    group = (F.lit(0).cast("bigint").alias("group"), "*")
    joined = nearest.join_groups(
        questions.select(*group), corpus.select(*group), 3, "l2", corpus_rows=25, question_rows=9
    )
    assert ranks(nearest.top_k(joined, 3)) == expected
    found = nearest.retrieve(questions, corpus.withColumn("content", F.col("id")), 3)
    assert ranks(found) == expected


def test_text_ids(spark):
    q, x = random_vectors(5, 4), random_vectors(6, 50, hot=0.5)
    for limits in ({}, BLOCKED):
        found = nearest.nearest(
            frame(spark, q, "qid", True), frame(spark, x, "id", True), 3, **limits
        )
        expected = [(f"k{i:04d}", r, f"k{j:04d}") for i, r, j in brute_force(q, x, 3, "l2")]
        assert ranks(found) == expected


@pytest.mark.parametrize("k", [2, 3, 4, 9])
def test_fewer_rows_than_k(spark, k):
    q, x = random_vectors(7, 2), random_vectors(8, 3)
    found = ranks(nearest.nearest(frame(spark, q, "qid"), frame(spark, x, "id"), k))
    assert found == brute_force(q, x, k, "l2") and len(found) == 2 * min(k, 3)


def test_empty_sides_and_null_vectors(spark):
    q, x = frame(spark, random_vectors(9, 2), "qid"), frame(spark, random_vectors(10, 3), "id")
    assert nearest.nearest(q, x.where("false")).count() == 0
    assert nearest.nearest(q.where("false"), x).count() == 0
    nulls = x.withColumn("embedding", F.when(F.col("id") > 0, F.col("embedding")))
    assert {r[2] for r in ranks(nearest.nearest(q, nulls))} == {1, 2}


def test_unknown_metric(spark):
    q = frame(spark, random_vectors(9, 2), "qid")
    with pytest.raises(ValueError):
        nearest.nearest(q, q.withColumnRenamed("qid", "id"), metric="hamming")


def test_zero_vectors_have_cosine_distance_one(spark):
    q, x = frame(spark, [[1.0, 0.0]], "qid"), frame(spark, [[0.0, 0.0]], "id")
    assert nearest.nearest(q, x, 1, "cosine").first().dist == 1.0


def test_top_k_is_limited_before_the_shuffle(spark):
    q, x = frame(spark, random_vectors(1, 3), "qid"), frame(spark, random_vectors(2, 9), "id")
    for limits in ({}, BLOCKED):
        text = plan(nearest.nearest(q, x, **limits), "simple")
        assert text.count("WindowGroupLimit") == 2
        assert "Cartesian" not in text and "NestedLoop" not in text


def test_retrieve_looks_up_the_winners(spark):
    q, x = frame(spark, random_vectors(1, 3), "qid"), frame(spark, random_vectors(2, 90), "id")
    chunks = x.withColumn("content", F.concat(F.lit("c"), "id"))
    found = nearest.retrieve(q, chunks, 2)
    assert all(r.content == f"c{r.id}" for r in found.collect()) and found.count() == 6
    assert "BroadcastHashJoin" in plan(found, "simple")


@pytest.mark.parametrize("metric", ["l2", "cosine"])
def test_cells_are_exact(spark, metric):
    q, x = random_vectors(11, 25), random_vectors(12, 300, hot=0.35)
    cells = index.build_cells(frame(spark, x, "id"), 7, metric)
    assert cells.rows.count() == 300
    for probes in (1, 3):
        found = index.search_cells(cells, frame(spark, q, "qid"), 4, probes)
        assert ranks(found) == brute_force(q, x, 4, metric)


def test_cells_learned_from_a_sample_hold_all_rows(spark):
    q, x = random_vectors(13, 10), random_vectors(14, 400)
    cells = index.build_cells(frame(spark, x, "id"), 5)
    assert cells.rows.count() == 400
    assert ranks(index.search_cells(cells, frame(spark, q, "qid"), 4, 1)) == brute_force(q, x, 4, "l2")


def test_probing_alone_is_approximate_but_whole(spark):
    q, x = random_vectors(15, 40), random_vectors(16, 400)
    cells = index.build_cells(frame(spark, x, "id"), 8)
    exact = set(brute_force(q, x, 4, "l2"))
    recall = []
    for probes in (1, 4, 8):
        found = ranks(index.search_cells(cells, frame(spark, q, "qid"), 4, probes, exact=False))
        assert len(found) == 160
        recall.append(len({(i, j) for i, _, j in found} & {(i, j) for i, _, j in exact}) / 160)
    assert recall[0] > 0.3 and recall == sorted(recall) and recall[-1] == 1.0


def test_probed_cells_with_too_few_rows(spark):
    q, x = random_vectors(17, 5), random_vectors(18, 12)
    cells = index.build_cells(frame(spark, x, "id"), 6)
    found = ranks(index.search_cells(cells, frame(spark, q, "qid"), 8, 1, exact=False))
    assert len(found) == 40


def test_a_search_reads_the_opened_cells_only(spark):
    cells = index.build_cells(frame(spark, random_vectors(12, 300), "id"), 7)
    opened = cells.rows.select(
        F.lit(3).cast("bigint").alias("group"), F.col("id").alias("qid"), "embedding"
    )
    text = plan(index._in_open_cells(cells, opened.limit(2), 4))
    assert "PartitionFilters: [cell" in text or "(cell#" in text.split("PartitionFilters: [")[1][:40]


def test_cells_need_a_fit_metric(spark):
    with pytest.raises(ValueError):
        index.build_cells(frame(spark, random_vectors(1, 9), "id"), 2, "ip")


@pytest.mark.parametrize("metric", ["l2", "cosine"])
@pytest.mark.parametrize("length", [None, 2.0, 50.0])
def test_buckets_are_exact(spark, metric, length):
    q, x = random_vectors(19, 40), random_vectors(20, 400, hot=0.3)
    found = index.search_buckets(
        frame(spark, q, "qid"), frame(spark, x, "id"), 4, metric, bucket_length=length
    )
    assert ranks(found) == brute_force(q, x, 4, metric)


@pytest.mark.parametrize("metric", ["l2", "cosine", "ip"])
def test_numbers_that_are_none_come_last(metric):
    q = np.array([[1.0, 0.0], [np.nan, 1.0], [np.inf, 0.0]])
    x = np.array([[np.nan, 0.0], [1.0, 0.1], [np.inf, 1.0], [0.5, 0.5]])
    with np.errstate(invalid="ignore"):
        who, found, dist = nearest.block_nearest(q, x, np.arange(4), 2, nearest.Distances(metric))
    first = [i for w, i in zip(who, found, strict=True) if w == 0]
    assert set(first) == ({1, 3} if metric != "ip" else set(first)) and len(first) == 2
    assert {w for w in who} == {0, 1, 2}


def test_questions_alone_in_their_buckets_are_answered_exactly(spark):
    q, x = random_vectors(21, 6), random_vectors(22, 60)
    found = index.search_buckets(
        frame(spark, q, "qid"), frame(spark, x, "id"), 4, bucket_length=1e-4, tables=2
    )
    assert ranks(found) == brute_force(q, x, 4, "l2")


@pytest.mark.parametrize("metric", nearest.METRICS)
@pytest.mark.parametrize("kind", ["spread", "together", "large", "copies"])
def test_rows_in_turn_equal_rows_at_once(monkeypatch, metric, kind):
    rng = np.random.default_rng(11)
    x = rng.normal(size=(900, 8))
    if kind == "together":  # nearer to one another than single precision tells
        x = 100 + x * 1e-6
    elif kind == "large":
        x[::3] *= 1e25
    elif kind == "copies":
        x = x[rng.integers(0, 20, len(x))]
    ids, q = rng.permutation(len(x)), x[:50]
    distances = nearest.Distances(metric)
    who, which = (a.ravel() for a in np.indices((len(q), len(x))))
    with np.errstate(over="ignore", invalid="ignore"):
        every = (who, ids[which], distances.pairs(q[who], x[which]))
    keep = nearest.smallest(*every, 3)
    want = [column[keep] for column in every]
    monkeypatch.setattr(nearest, "DISTANCE_CELLS", 2000)
    best = None
    for at in range(0, len(x), 100):
        best = nearest.block_nearest(q, x[at : at + 100], ids[at : at + 100], 3, distances, best)
    for got, right in zip(best, want, strict=True):
        np.testing.assert_array_equal(got, right)


def test_small_blocks_of_questions_share_a_job(spark, monkeypatch):
    monkeypatch.setattr(nearest, "WAVE_BLOCKS", 5)
    block = nearest.QuestionBlock(None, np.zeros((2, 4)))
    assert [len(w) for w in nearest._waves(iter([block] * 12))] == [5, 5, 2]
    monkeypatch.setattr(nearest, "WAVE_BYTES", 3 * block.vectors.nbytes)
    assert [len(w) for w in nearest._waves(iter([block] * 7))] == [3, 3, 1]
    q, x = random_vectors(21, 90), random_vectors(22, 200)
    found = nearest.nearest(frame(spark, q, "qid"), frame(spark, x, "id"), 3, question_bytes=64, block_bytes=64)
    assert ranks(found) == brute_force(q, x, 3, "l2")


def test_groups_with_many_distances_are_split(spark, monkeypatch):
    q, x = random_vectors(31, 60), random_vectors(32, 100)
    one = F.lit(7).cast("long").alias("group")
    asked = frame(spark, q, "qid").select(one, "qid", "embedding")
    rows = frame(spark, x, "id").select(one, "id", "embedding")
    assert nearest.large_groups(asked, rows, 1000, 1000).count() == 0
    monkeypatch.setattr(nearest, "BLOCK_CELLS", 1000)
    split = nearest.large_groups(asked, rows, 1000, 1000).first()
    assert (split.corpus_parts, split.question_parts) == (1, 6)
    found = nearest.top_k(nearest.join_groups(asked, rows, 3, "l2"), 3)
    assert ranks(found) == brute_force(q, x, 3, "l2")


def test_blocks_of_one_job_keep_their_own_ranks(spark):
    q, x = random_vectors(41, 40), random_vectors(42, 50)
    block = nearest.QuestionBlock(pa.array(range(20)), q[:20].astype(float))
    other = nearest.QuestionBlock(pa.array(range(20)), q[20:].astype(float))
    asked, corpus = frame(spark, q, "qid"), frame(spark, x, "id")
    parts = [
        nearest._scanned(b, asked, corpus, 3, "l2").withColumn("block", F.lit(n))
        for n, b in enumerate([block, other])
    ]
    assert nearest.top_k(parts[0].unionAll(parts[1]), 3, "block").count() == 2 * 20 * 3


def test_small_blocks_share_a_reading_of_the_corpus(spark, monkeypatch):
    q, x = random_vectors(51, 400), random_vectors(52, 150, hot=0.2)
    corpus, read = frame(spark, x, "id"), []
    scanned = nearest._scanned
    monkeypatch.setattr(nearest, "_scanned", lambda block, *a: read.append(len(block.ids)) or scanned(block, *a))
    # 25 blocks of 16 questions: one reading, not one of each.
    found = nearest.nearest(frame(spark, q, "qid"), corpus, 3, question_bytes=64, block_bytes=64)
    assert ranks(found) == brute_force(q, x, 3, "l2") and read == [400]
    assert len(list(nearest.question_blocks(frame(spark, q, "qid"), 64))) == 25
    monkeypatch.setattr(nearest, "SCAN_BYTES", 8 * 16 * 6 * 8)
    found = nearest.nearest(frame(spark, q, "qid"), corpus, 3, question_bytes=64, block_bytes=64)
    assert ranks(found) == brute_force(q, x, 3, "l2") and read[1:] == [128, 128, 128, 16]


def test_blocks_with_the_same_ids_keep_their_own_rows(spark):
    q, x = random_vectors(41, 40), random_vectors(42, 50)
    asked, corpus = frame(spark, q, "qid", True), frame(spark, x, "id")
    names = pa.array([f"k{i}" for i in range(20)])
    blocks = {3: nearest.QuestionBlock(names, q[:20]), 5: nearest.QuestionBlock(names, q[20:])}
    found = nearest.top_k(nearest._scanned_together(blocks, asked, corpus, 3, "l2"), 3, "block")
    want = {(f"k{i % 20}", r, j) for i, r, j in brute_force(q, x, 3, "l2")}
    got = found.collect()
    assert len(got) == 120 and {(r.qid, r.rank, r.id) for r in got} == want


@pytest.mark.parametrize("k", [1, 4, 40])
def test_the_bound_of_the_kth_is_never_below_it(k):
    dist = np.random.default_rng(k).normal(size=(30, 1000)).astype(np.float32)
    dist[:, ::7] = dist[:, :1]
    kth = np.sort(dist, axis=1)[:, k - 1]
    assert (nearest._kth_bound(dist, k) >= kth).all()
    assert (nearest._kth_bound(dist[:, :3], k) >= np.sort(dist[:, :3], axis=1)[:, min(k, 3) - 1]).all()
    who, which = nearest.positions(dist < 0)
    assert (np.stack([who, which]) == np.stack(np.nonzero(dist < 0))).all()
