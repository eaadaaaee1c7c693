"""Index search: look only where the nearest neighbours are likely to be.

``search_cells`` cuts the corpus into cells around k-means centres and probes the
cells nearest to each question. By default it then opens every further cell that
could hold a closer row, so its result is exact. ``search_buckets`` looks in the hash
buckets of each question and answers those exactly that these cannot settle.

``join_groups`` splits cells and buckets with many rows or many questions, so a cell
with a third of all rows is many tasks' work. Questions and corpus are read more than
once: pass stored tables, not vectors that a model would compute again.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.clustering import KMeans
from pyspark.ml.feature import Normalizer
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pagequarry.operators.nearest import (
    DISTANCE_CELLS,
    Distances,
    as_matrix,
    join_groups,
    k_means,
    nearest,
    points_of,
    top_k,
)
from pagequarry.scratch import materialise

# Most cells of an index.
MAX_CELLS = 65_536

# Most bytes of cell centres sent to every task.
CENTRE_BYTES = 128 << 20

# Rows that centres are learned from on the driver, for each cell and at most.
ROWS_PER_CELL = 64
SAMPLE_BYTES = 64 << 20


@dataclass(frozen=True)
class CellIndex:
    """Corpus rows with their cell, the centre of each cell, and its radius: the
    largest distance of a row to the centre, negative for a cell without rows."""

    rows: DataFrame
    centres: np.ndarray
    radius: np.ndarray
    metric: str


def _distances_to(centres: np.ndarray, points: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """Slices of the points (first position, distances to all centres)."""
    step = max(1, DISTANCE_CELLS // len(centres))
    for at in range(0, len(points), step):
        yield at, np.sqrt(Distances("l2").block(points[at : at + step], centres))


def _as_vectors(df: DataFrame, metric: str) -> DataFrame:
    """Spark ML vectors; scaled to length 1 when only directions count."""
    vectors = df.withColumn("_v", array_to_vector(F.col("embedding").cast("array<double>")))
    if metric == "cosine":
        return Normalizer(inputCol="_v", outputCol="_u").transform(vectors).drop("_v")
    return vectors.withColumnRenamed("_v", "_u")


def learn_centres(
    corpus: DataFrame, cells: int, metric: str = "l2", seed: int = 17, iterations: int = 10
) -> np.ndarray:
    """At most ``cells`` k-means centres of ``corpus`` (id, embedding).

    Up to as many cells as ``SAMPLE_BYTES`` of rows, picked by the hash of the id, can
    tell apart (``ROWS_PER_CELL`` each) are learned from these; more from all rows.
    Searches are exact with any centres.
    """
    if metric not in ("l2", "cosine"):
        raise ValueError("cells need a metric with a triangle inequality: l2 or cosine")
    if not 0 < cells <= MAX_CELLS:
        raise ValueError(f"between 1 and {MAX_CELLS} cells")
    first = corpus.select(F.size("embedding").alias("n")).first()
    if first is None or cells * first.n * 8 > CENTRE_BYTES:
        raise ValueError(f"a corpus with rows, and centres of at most {CENTRE_BYTES} bytes")
    if cells * ROWS_PER_CELL * max(1, first.n) * 8 <= SAMPLE_BYTES:
        some = corpus.orderBy(F.xxhash64(F.lit(seed), "id"), "id").limit(cells * ROWS_PER_CELL)
        vectors = some.select("embedding").toArrow().combine_chunks().column(0).combine_chunks()
        rows = points_of(vectors, metric)
        rows = rows[np.isfinite(rows).all(axis=1)]
        rows = rows if len(rows) else np.zeros((1, first.n))
        return k_means(rows, cells, np.random.default_rng(seed), iterations)
    # Random first centres: the default way gathers several times ``cells`` points on the driver.
    means = KMeans(
        k=cells, seed=seed, maxIter=iterations, initMode="random", featuresCol="_u"
    )
    return np.array(means.fit(_as_vectors(corpus, metric).select("_u")).clusterCenters())


def assigned(corpus: DataFrame, centres: np.ndarray, metric: str) -> DataFrame:
    """(id, embedding) with the nearest centre of each row and its distance to it."""
    sent = corpus.sparkSession.sparkContext.broadcast(centres)

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            x = points_of(batch.column(1), metric)
            cell = np.concatenate([a.argmin(axis=1) for _, a in _distances_to(sent.value, x)])
            gap = np.sqrt(((x - sent.value[cell]) ** 2).sum(axis=1))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(cell), pa.array(gap)],
                ["id", "embedding", "cell", "gap"],
            )

    id_type = corpus.schema["id"].dataType.simpleString()
    return corpus.select("id", "embedding").mapInArrow(
        assign, f"id {id_type}, embedding array<float>, cell long, gap double"
    )


def build_cells(
    corpus: DataFrame,
    cells: int,
    metric: str = "l2",
    seed: int = 17,
    iterations: int = 10,
) -> CellIndex:
    """Cut ``corpus`` (id, embedding) into cells: every row is put in that of its nearest
    centre."""
    vector = F.col("embedding").cast("array<float>").alias("embedding")
    corpus = corpus.select("id", vector).where(F.col("embedding").isNotNull())
    centres = learn_centres(corpus, cells, metric, seed, iterations)
    # A folder per cell, so that a search reads the opened cells only. The range shuffle
    # gives each task few cells to write, and a large cell to many tasks.
    placed = assigned(corpus, centres, metric).repartitionByRange("cell", "id")
    rows = materialise(placed, "cells", partition_by="cell")
    radius = np.full(len(centres), -1.0)
    for row in rows.groupBy("cell").agg(F.max("gap").alias("r")).collect():
        radius[row.cell] = row.r
    return CellIndex(rows, centres, radius, metric)


def reach_of(kth: np.ndarray, q: np.ndarray, centres: np.ndarray, metric: str) -> np.ndarray:
    """How far rows may lie from questions whose k-th distance is ``kth``, with room for the
    rounding of distances."""
    squares = kth * 2 if metric == "cosine" else kth
    with np.errstate(invalid="ignore", over="ignore"):
        sizes = np.concatenate([(q * q).sum(axis=1), (centres * centres).sum(axis=1)])
    scale = np.sqrt(sizes[np.isfinite(sizes)].max(initial=0.0))
    return np.sqrt(np.maximum(squares, 0)) + 1e-4 + 1e-6 * scale


def _open_cells(index: CellIndex, questions: DataFrame, probes: int, further: bool) -> DataFrame:
    """One row per question and cell to look into: (group, qid, embedding).

    First the ``probes`` nearest cells; then (``further``) the cells beyond them whose
    nearest possible row is not farther than ``bound``, the k-th distance found so far.
    """
    sent = questions.sparkSession.sparkContext.broadcast((index.centres, index.radius))
    metric = index.metric

    def cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        centres, radius = sent.value
        for batch in batches:
            q = points_of(batch.column(1), metric)
            for at, away in _distances_to(centres, q):
                away[:, radius < 0] = np.inf
                nearest_first = np.argsort(away, axis=1, kind="stable")[:, :probes]
                chosen = np.zeros(away.shape, bool)
                np.put_along_axis(chosen, nearest_first, True, axis=1)
                if further:
                    part = slice(at, at + len(away))
                    bound = batch.column(2).to_numpy(zero_copy_only=False)[part]
                    reach = reach_of(bound, q[part], centres, metric)
                    chosen = ~chosen & (away - radius <= reach[:, None])
                chosen[:, radius < 0] = False
                who, cell = np.nonzero(chosen)
                for i in range(0, len(who), 10_000):
                    rows = pa.array(who[i : i + 10_000] + at)
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(cell[i : i + 10_000]),
                            batch.column(0).take(rows),
                            batch.column(1).take(rows),
                        ],
                        ["group", "qid", "embedding"],
                    )

    qid_type = questions.schema["qid"].dataType.simpleString()
    return questions.mapInArrow(cells, f"group long, qid {qid_type}, embedding array<float>")


def _in_open_cells(index: CellIndex, opened: DataFrame, k: int) -> DataFrame:
    """``opened`` must be stored: it is read to learn the cells, to count, and to join."""
    rows = index.rows.select(F.col("cell").alias("group"), "id", "embedding")
    # At most MAX_CELLS numbers, which pick the folders to read.
    wanted = [r.group for r in opened.select("group").distinct().collect()]
    rows = rows.where(F.col("group").isin(wanted))
    return join_groups(opened, rows, k, index.metric)


def search_cells(
    index: CellIndex, questions: DataFrame, k: int = 4, probes: int = 4, exact: bool = True
) -> DataFrame:
    """``k`` nearest rows per question (qid, embedding): (qid, rank, id, dist).

    With ``exact=False`` only the probed cells are searched, and the further ones of
    questions whose probed cells hold fewer than ``k`` rows.
    """
    vector = F.col("embedding").cast("array<float>").alias("embedding")
    questions = questions.select("qid", vector).where(F.col("embedding").isNotNull())
    opened = materialise(_open_cells(index, questions, probes, further=False), "open_cells")
    first = materialise(top_k(_in_open_cells(index, opened, k), k), "probed")
    # A question with fewer than k rows so far has no bound: all its cells are opened.
    kth = first.where(F.col("rank") == k).select("qid", F.col("dist").alias("bound"))
    bounded = questions.join(kth, "qid", "left")
    if not exact:
        bounded = bounded.where(F.col("bound").isNull())
    bounded = bounded.select(
        "qid", "embedding", F.coalesce("bound", F.lit(float("inf"))).alias("bound")
    )
    more = materialise(_open_cells(index, bounded, probes, further=True), "further_cells")
    second = _in_open_cells(index, more, k)
    return top_k(first.select("qid", "id", "dist").unionByName(second), k)


def _projected(df: DataFrame, key: str, directions: np.ndarray, metric: str) -> DataFrame:
    """(key, embedding, places): where each vector lies along each direction."""
    sent = df.sparkSession.sparkContext.broadcast(directions)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            places = points_of(batch.column(1), metric) @ sent.value.T
            flat = pa.array(np.nan_to_num(places).ravel())
            ends = np.arange(0, places.size + 1, places.shape[1], dtype=np.int32)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.ListArray.from_arrays(pa.array(ends), flat)],
                [key, "embedding", "places"],
            )

    kind = df.schema[key].dataType.simpleString()
    return df.select(key, "embedding").mapInArrow(
        run, f"{key} {kind}, embedding array<float>, places array<double>"
    )


def search_buckets(
    questions: DataFrame,
    corpus: DataFrame,
    k: int = 4,
    metric: str = "l2",
    bucket_length: float | None = None,
    tables: int = 8,
    seed: int = 17,
) -> DataFrame:
    """The ``k`` nearest rows, looked for in hash buckets first.

    Random directions cut the space into slabs of ``bucket_length`` (by default twice the
    spread of the corpus along them). Two vectors are never nearer than their places along
    a direction, so a question is done if, along one, all within its k-th distance lie
    in its own slab. The others are answered by the exact search.
    """
    if metric not in ("l2", "cosine"):
        raise ValueError("buckets need a metric with a triangle inequality: l2 or cosine")
    vector = F.col("embedding").cast("array<float>").alias("embedding")
    corpus = corpus.select("id", vector).where(F.col("embedding").isNotNull())
    questions = questions.select("qid", vector).where(F.col("embedding").isNotNull())
    first = corpus.select(F.size("embedding").alias("n")).first()
    if first is None:
        return nearest(questions, corpus, k, metric)
    directions = np.random.default_rng(seed).normal(size=(tables, first.n))
    directions /= np.linalg.norm(directions, axis=1, keepdims=True)
    rows = materialise(_projected(corpus, "id", directions, metric), "places")
    asked = materialise(_projected(questions, "qid", directions, metric), "places")
    spread = rows.agg(*[F.stddev_pop(F.col("places")[t]) for t in range(tables)]).first()
    lengths = [bucket_length or max(2 * (s or 0.0), 1e-9) for s in spread]
    length = F.array(*[F.lit(x) for x in lengths])
    slabs = F.transform(F.arrays_zip("places", length.alias("length")), _slab)

    def bucketed(df: DataFrame, key: str) -> DataFrame:
        return df.select(key, "embedding", F.posexplode(slabs).alias("table", "slab")).select(
            key, "embedding", F.xxhash64("table", "slab").alias("group")
        )

    candidates = join_groups(bucketed(asked, "qid"), bucketed(rows, "id"), k, metric)
    candidates = candidates.dropDuplicates(["qid", "id"])
    found = materialise(top_k(candidates, k), "bucketed")
    # The k-th distance as one between points; room for the rounding of distances.
    reach = F.sqrt(F.col("dist") * (2 if metric == "cosine" else 1)) + 1e-4
    kth = found.where(F.col("rank") == k).select("qid", reach.alias("reach"))
    inside = F.exists(
        F.arrays_zip("places", length.alias("length")),
        lambda x: (x["places"] - F.col("reach") >= _slab(x) * x["length"])
        & (x["places"] + F.col("reach") < (_slab(x) + 1) * x["length"]),
    )
    done = materialise(asked.join(kth, "qid").where(inside).select("qid"), "certified")
    rest = nearest(questions.join(done, "qid", "left_anti"), corpus, k, metric)
    return found.join(done, "qid", "left_semi").unionByName(rest)


def _slab(place: Column) -> Column:
    return F.floor(place["places"] / place["length"])
