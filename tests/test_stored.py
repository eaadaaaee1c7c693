"""The stored index: exact search in waves, and changes that write touched cells only."""

import numpy as np
import pytest
from pyspark.sql import functions as F
from test_nearest import brute_force, frame, random_vectors, ranks

from pagequarry.operators import nearest, stored


@pytest.fixture
def root(tmp_path):
    return str(tmp_path / "index")


def clustered(seed, n, dim=6, groups=8):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(groups, dim)) * 20
    return (centres[rng.integers(groups, size=n)] + rng.normal(size=(n, dim))).astype(np.float32).astype(float)


@pytest.mark.parametrize("question_bytes", [1 << 20, 64])
@pytest.mark.parametrize("metric", ["l2", "cosine"])
def test_exact_after_opening(spark, root, metric, question_bytes):
    q, x = random_vectors(1, 30), random_vectors(2, 300, hot=0.3)
    stored.create_index(frame(spark, x, "id"), root, 7, metric)
    found = stored.search_index(stored.open_index(spark, root), frame(spark, q, "qid"), 5, question_bytes)
    assert ranks(found) == brute_force(q, x, 5, metric)


@pytest.mark.parametrize("k", [1, 4, 50])
def test_cells_smaller_than_k(spark, root, k):
    q, x = random_vectors(3, 9), random_vectors(4, 40)
    index = stored.create_index(frame(spark, x, "id", True), root, 20)
    got = [(r.qid, r.rank, int(r.id[1:])) for r in stored.search_index(index, frame(spark, q, "qid"), k).orderBy("qid", "rank").collect()]
    assert got == brute_force(q, x, k, "l2")


def test_far_cells_stay_closed(spark, root, monkeypatch):
    x = clustered(5, 2000)
    index = stored.create_index(frame(spark, x, "id"), root, 16)
    opened = []
    scan = stored._scan_cells
    monkeypatch.setattr(stored, "_scan_cells", lambda i, b, c, k, s: opened.append(c.sum()) or scan(i, b, c, k, s))
    q = x[:40] + 0.01
    assert ranks(stored.search_index(index, frame(spark, q, "qid"), 4)) == brute_force(q, x, 4, "l2")
    assert sum(opened) < 40 * len(index.cells) / 2


def files(root, cell_version):
    from pathlib import Path

    return {str(p) for p in Path(root).glob(f"cells/v={cell_version}/**/*.parquet")}


def test_changes_touch_few_cells_and_stay_exact(spark, root):
    x = clustered(6, 1200)
    stored.create_index(frame(spark, x, "id"), root, 12)
    before = files(root, 0)
    near = [i for i in range(1200) if np.linalg.norm(x[i] - x[0]) < 8]
    rows = [(near[0], "delete", None), (near[1], "update", x[0].tolist()), (5000, "insert", x[0].tolist())]
    changes = spark.createDataFrame(rows, "id long, change string, embedding array<float>")
    index = stored.sync_index(changes, root)
    assert index.version == 1 and files(root, 0) == before
    assert 0 < (index.versions == 1).sum() <= 4 < (index.versions == 0).sum()
    q = x[:30] + 0.5
    x = np.vstack([x, np.full((3800, 6), 1e9), x[:1]])
    x[near[1]] = x[0]
    x[near[0]] = 1e9
    opened = stored.open_index(spark, root)
    assert ranks(stored.search_index(opened, frame(spark, q, "qid"), 4)) == brute_force(q, x, 4, "l2")
    assert opened.sizes.sum() == 1200


def test_cells_split_merge_and_run_empty(spark, root):
    x = clustered(7, 400, groups=4)
    index = stored.create_index(frame(spark, x, "id"), root, 4)
    more = clustered(7, 4000, groups=4)[400:] + 0.01
    rows = [(400 + i, "insert", v.tolist()) for i, v in enumerate(more)]
    schema = "id long, change string, embedding array<float>"
    grown = stored.sync_index(spark.createDataFrame(rows, schema), root)
    assert len(grown.cells) > len(index.cells) and grown.sizes.sum() == 4000
    whole = np.vstack([x, np.array(more, np.float32).astype(float)])
    q = whole[::400] + 0.3
    assert ranks(stored.search_index(grown, frame(spark, q, "qid"), 3)) == brute_force(q, whole, 3, "l2")
    gone = spark.range(10, 4000).select("id", F.lit("delete").alias("change"), F.lit(None).cast("array<float>").alias("embedding"))
    small = stored.sync_index(gone, root)
    assert small.sizes.sum() == 10 and len(small.cells) < len(grown.cells)
    assert ranks(stored.search_index(small, frame(spark, q, "qid"), 3)) == brute_force(q, whole[:10], 3, "l2")
    empty = stored.sync_index(spark.range(10).select("id", F.lit("delete").alias("change"), F.lit(None).cast("array<float>").alias("embedding")), root)
    assert empty.sizes.sum() == 0 and stored.search_index(empty, frame(spark, q, "qid"), 3).count() == 0
    again = stored.sync_index(spark.createDataFrame([(3, "insert", whole[3].tolist())], schema), root)
    assert {r[2] for r in ranks(stored.search_index(again, frame(spark, q, "qid"), 3))} == {3}
    # Whoever opened an older version still reads it.
    assert ranks(stored.search_index(grown, frame(spark, q, "qid"), 3)) == brute_force(q, whole, 3, "l2")


def test_odd_vectors_and_no_questions(spark, root):
    rows = [(1, [0.0, 0.0]), (2, None), (3, [float("nan"), 1.0]), (4, [1e20, 1.0]), (5, [1.0, 1.0])]
    corpus = spark.createDataFrame(rows, "id long, embedding array<float>")
    q = spark.createDataFrame([(1, [0.0, 0.1]), (2, None), (3, [float("nan"), 0.0])], "qid long, embedding array<float>")
    index = stored.create_index(corpus, root, 2)
    for k in (2, 4):
        assert ranks(stored.search_index(index, q, k)) == ranks(nearest.nearest(q, corpus, k))
    assert stored.search_index(index, q.limit(0)).count() == 0
    with pytest.raises(ValueError):
        stored.create_index(corpus, root, 0)
