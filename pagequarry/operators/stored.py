"""A vector index in a folder: made once, opened by any session, kept in step with changes.

Rows lie in a folder for each cell, the rows nearest to one of the centres. A manifest names
the cells, the version that wrote each, how many rows it has, its centre and its radius (the
largest distance of a row to the centre). A change writes new folders for the cells it touches
and a manifest that points to them; all other folders keep their files, and who has opened an
older manifest still reads what it points to. There is one writer at a time.

A search opens cells in waves. The first opens for each question the nearest cells that have
rows enough; each further wave takes those that may still hold a nearer row than the k-th
so far, the nearest first. When none is left, the result is exact. Questions are sent, rows
stay where they are; the driver holds one block of questions and the manifest.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from pagequarry.operators.index import assigned, learn_centres, reach_of
from pagequarry.operators.nearest import (
    DISTANCE_CELLS,
    QUESTION_BYTES,
    Distances,
    QuestionBlock,
    as_matrix,
    block_nearest,
    k_means,
    points,
    question_blocks,
    smallest,
    top_k,
)
from pagequarry.scratch import materialise, scratch_path

MANIFEST = (
    "cell long, version int, n long, centre array<double>, radius double, metric string, "
    "target long, cells long"
)
# A touched cell of more than SPLIT times the rows of an even share is cut in two, one of less
# than a MERGE-th of it goes to its neighbours among the touched ones.
SPLIT, MERGE = 2, 8
SPLIT_SAMPLE = 2000  # rows of a cell that its two halves are learned from
FIRST_CELLS, WIDER = 2, 4  # cells a question opens first, and how much more in each wave
OPEN_PAIRS = 1 << 26  # most pairs of a question and a cell that are looked at together


@dataclass(frozen=True)
class StoredIndex:
    """An opened manifest; entry k of the arrays is a cell."""

    root: str
    version: int
    cells: np.ndarray
    versions: np.ndarray
    sizes: np.ndarray
    centres: np.ndarray
    radius: np.ndarray
    metric: str
    target: int

    def rows(self, spark: SparkSession, which: np.ndarray | None = None) -> DataFrame | None:
        """(id, embedding, cell) of some cells, from their folders alone; None of no cell."""
        which = np.arange(len(self.cells)) if which is None else which
        which = which[self.sizes[which] > 0]
        if not len(which):
            return None
        folders = [
            f"{self.root}/cells/v={v}/cell={c}"
            for v, c in zip(self.versions[which].tolist(), self.cells[which].tolist(), strict=True)
        ]
        read = spark.read.option("basePath", f"{self.root}/cells").parquet(*folders)
        return read.select("id", "embedding", F.col("cell").cast("long").alias("cell"))


def create_index(
    corpus: DataFrame, root: str, cells: int, metric: str = "l2", seed: int = 17
) -> StoredIndex:
    """Write ``corpus`` (id, embedding) as an index below ``root``, a folder all can read."""
    vector = F.col("embedding").cast("array<float>").alias("embedding")
    corpus = corpus.select("id", vector).where(F.col("embedding").isNotNull())
    centres = learn_centres(corpus, cells, metric, seed)
    rows = assigned(corpus, centres, metric)
    return _commit(rows, root, 0, centres, np.arange(len(centres)), metric, None, None)


def open_index(spark: SparkSession, root: str) -> StoredIndex:
    """The newest whole version of an index."""
    manifests = spark.read.schema(f"{MANIFEST}, v int").parquet(f"{root}/manifest")
    whole = manifests.groupBy("v").agg(F.count("*").alias("n"), F.max("cells").alias("cells"))
    last = whole.where("n = cells").agg(F.max("v")).first()[0]
    if last is None:
        raise ValueError(f"no whole index below {root}")
    rows = manifests.where(F.col("v") == last).where("cell >= 0").orderBy("cell").collect()
    about = manifests.where(F.col("v") == last).where("cell < 0").first()
    width = len(rows[0].centre) if rows else 1
    return StoredIndex(
        root,
        last,
        np.array([r.cell for r in rows], np.int64),
        np.array([r.version for r in rows], np.int64),
        np.array([r.n for r in rows], np.int64),
        np.array([r.centre for r in rows], float).reshape(-1, width),
        np.array([r.radius for r in rows], float),
        about.metric,
        about.target,
    )


def _commit(
    rows: DataFrame,
    root: str,
    version: int,
    centres: np.ndarray,
    names: np.ndarray,
    metric: str,
    target: int | None,
    kept: list[tuple] | None,
) -> StoredIndex:
    """Write cells (id, embedding, cell, gap), then the manifest that makes them valid."""
    spark = rows.sparkSession
    path = f"{root}/cells/v={version}"
    # A range shuffle gives each task few cells to write, and a large cell to many tasks.
    rows.repartitionByRange("cell", "id").write.mode("overwrite").partitionBy("cell").parquet(path)
    written = spark.read.schema(rows.schema).parquet(path)
    found = written.groupBy("cell").agg(F.count("*").alias("n"), F.max("gap").alias("radius")).collect()
    place = {int(c): k for k, c in enumerate(names)}
    own = [
        (int(r.cell), version, r.n, centres[place[int(r.cell)]].tolist(), _finite(r.radius))
        for r in found
    ]
    # A cell that lost its rows keeps its centre: rows may come again.
    full = {c[0] for c in own}
    own += [(c, version, 0, centres[k].tolist(), -1.0) for c, k in place.items() if c not in full]
    cells = own + (kept or [])
    if target is None:
        target = max(1, sum(c[2] for c in cells) // max(1, len(cells)))
    # A row of no cell tells what holds for all of them.
    rows_of = [(*c, metric, target, len(cells) + 1) for c in cells]
    rows_of.append((-1, version, 0, [], 0.0, metric, target, len(cells) + 1))
    manifest = spark.createDataFrame(rows_of, MANIFEST)
    manifest.coalesce(1).write.mode("overwrite").parquet(f"{root}/manifest/v={version}")
    return open_index(spark, root)


def _finite(radius: float) -> float:
    """A cell with rows that are no numbers is always opened."""
    return float(radius) if np.isfinite(radius) else float("inf")


# -- search ------------------------------------------------------------------------


def search_index(
    index: StoredIndex,
    questions: DataFrame,
    k: int = 4,
    question_bytes: int = QUESTION_BYTES,
) -> DataFrame:
    """The exact ``k`` nearest rows of each question (qid, embedding): (qid, rank, id, dist)."""
    spark = questions.sparkSession
    path = scratch_path(spark, "nearest")
    width = index.centres.shape[1]
    bound = OPEN_PAIRS // max(1, len(index.cells)) * 8 * width
    for block in question_blocks(questions, max(1, min(question_bytes, bound))):
        _search_block(index, block, questions, k).write.mode("append").parquet(path)
    kind = questions.schema["qid"].dataType.simpleString()
    schema = f"qid {kind}, rank int, id {_id_type(index, spark)}, dist double"
    return spark.read.schema(schema).parquet(path)


def _id_type(index: StoredIndex, spark: SparkSession) -> str:
    rows = index.rows(spark, np.flatnonzero(index.sizes > 0)[:1])
    return "long" if rows is None else rows.schema["id"].dataType.simpleString()


def _search_block(
    index: StoredIndex, block: QuestionBlock, questions: DataFrame, k: int
) -> DataFrame:
    spark, count = questions.sparkSession, len(block.vectors)
    id_type = _id_type(index, spark)
    best = spark.createDataFrame([], f"qid long, rank int, id {id_type}, dist double")
    if count and len(index.cells):
        q = points(block.vectors, index.metric)
        away = np.concatenate(
            [
                np.sqrt(Distances("l2").block(q[at : at + step], index.centres))
                for step in [max(1, DISTANCE_CELLS // len(index.cells))]
                for at in range(0, count, step)
            ]
        )
        least = np.nan_to_num(np.maximum(away - index.radius, 0), nan=0.0)
        order = np.argsort(np.nan_to_num(away, nan=np.inf), axis=1, kind="stable")
        waiting = np.broadcast_to(index.sizes > 0, least.shape).copy()
        kth = np.full(count, np.inf)
        wide = FIRST_CELLS
        while True:
            wanted = waiting & (least <= reach_of(kth, q, index.centres, index.metric)[:, None])
            if not wanted.any():
                break
            chosen = _nearest_first(wanted, order, wide, index.sizes, k if wide == FIRST_CELLS else 0)
            waiting &= ~chosen
            found = _scan_cells(index, block, chosen, k, spark)
            best = materialise(top_k(best.select("qid", "id", "dist").unionByName(found), k), "wave")
            done = best.where(F.col("rank") == k).select("qid", "dist").toArrow()
            # Distances that are no number rule nothing out.
            kth[done.column("qid").to_numpy()] = np.nan_to_num(done.column("dist").to_numpy(), nan=np.inf)
            wide *= WIDER
    kind = questions.schema["qid"].dataType
    names = spark.sparkContext.broadcast(block.ids)

    def named(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.set_column(0, "qid", names.value.take(batch.column(0)).cast(to_arrow_type(kind)))

    schema = f"qid {kind.simpleString()}, rank int, id {id_type}, dist double"
    return best.select("qid", "rank", "id", "dist").mapInArrow(named, schema)


def _nearest_first(
    wanted: np.ndarray, order: np.ndarray, most: int, sizes: np.ndarray, rows: int
) -> np.ndarray:
    """The first ``most`` wanted cells of each question, or as many as hold ``rows``."""
    ranked = np.take_along_axis(wanted, order, axis=1)
    nth = np.cumsum(ranked, axis=1)
    held = np.cumsum(np.where(ranked, sizes[order], 0), axis=1) - np.where(ranked, sizes[order], 0)
    ranked &= (nth <= most) | (held < rows)
    chosen = np.zeros(wanted.shape, bool)
    np.put_along_axis(chosen, order, ranked, axis=1)
    return chosen


def _scan_cells(
    index: StoredIndex, block: QuestionBlock, chosen: np.ndarray, k: int, spark: SparkSession
) -> DataFrame:
    """Each task reads rows of opened cells and keeps the ``k`` best of the questions that
    opened them: (qid, id, dist), the question by its place in the block."""
    opened = np.flatnonzero(chosen.any(axis=0))
    rows = index.rows(spark, opened)
    asked = {int(index.cells[c]): np.flatnonzero(chosen[:, c]).astype(np.int32) for c in opened}
    sent = spark.sparkContext.broadcast((block.vectors, asked))
    distances = Distances(index.metric)
    id_kind = rows.schema["id"].dataType
    id_type = to_arrow_type(id_kind)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        q, asked = sent.value
        best = None
        for batch in batches:
            if not batch.num_rows:
                continue
            cells = batch.column(2).to_numpy()
            edges = np.flatnonzero(np.diff(cells)) + 1
            for low, high in zip([0, *edges], [*edges, len(cells)], strict=True):
                own = asked[int(cells[low])]
                part = batch.slice(low, high - low)
                x = as_matrix(part.column(1))
                ids = part.column(0).to_numpy(zero_copy_only=False)
                who, near, dist = block_nearest(q[own], x, ids, k, distances)
                found = own[who].astype(np.int64), near, dist
                if best is not None:
                    found = tuple(np.concatenate(c) for c in zip(best, found, strict=True))
                keep = smallest(*found, k)
                best = tuple(column[keep] for column in found)
        if best is not None:
            columns = [pa.array(best[0]), pa.array(best[1], type=id_type), pa.array(best[2])]
            yield pa.RecordBatch.from_arrays(columns, ["qid", "id", "dist"])

    return rows.mapInArrow(scan, f"qid long, id {id_kind.simpleString()}, dist double")


# -- changes -----------------------------------------------------------------------


def sync_index(changes: DataFrame, root: str) -> StoredIndex:
    """Bring an index in step with ``changes`` (id, change, embedding), each id once: insert,
    update or delete. A row whose id is there is replaced, whatever the change is called.

    Only the cells that the rows leave or enter are written; of these, large ones are split
    and small ones merged.
    """
    spark = changes.sparkSession
    index = open_index(spark, root)
    vector = F.col("embedding").cast("array<float>").alias("embedding")
    changes = materialise(changes.select("id", "change", vector), "changes")
    enter = changes.where("change <> 'delete' AND embedding IS NOT NULL").select("id", "embedding")
    enter = materialise(assigned(enter, index.centres, index.metric), "entering")
    # Ids and cells alone are read to find where the changed rows are now.
    rows = index.rows(spark)
    left: set[int] = set()
    if rows is not None:
        leave = rows.select("id", "cell").join(changes.select("id"), "id", "left_semi")
        left = {r.cell for r in leave.select("cell").distinct().collect()}
    place = {int(c): k for k, c in enumerate(index.cells)}
    entered = {int(index.cells[r.cell]) for r in enter.select("cell").distinct().collect()}
    touched = np.array(sorted(place[c] for c in left | entered), np.int64)
    if not len(touched):
        return index
    pending = _renamed(enter, index.cells).select("id", "embedding", "cell")
    here = index.rows(spark, touched)
    if here is not None:
        pending = pending.unionByName(here.join(changes.select("id"), "id", "left_anti"))
    pending = materialise(pending, "pending")
    sizes = {r.cell: r["count"] for r in pending.groupBy("cell").count().collect()}
    names, centres = _split_and_merge(index, touched, pending, sizes)
    again = assigned(pending.select("id", "embedding"), centres, index.metric)
    kept = [
        (int(index.cells[c]), int(index.versions[c]), int(index.sizes[c]), index.centres[c].tolist(), float(index.radius[c]))
        for c in np.setdiff1d(np.arange(len(index.cells)), touched)
    ]
    written = _renamed(again, names)
    return _commit(written, root, index.version + 1, centres, names, index.metric, index.target, kept)


def _renamed(rows: DataFrame, names: np.ndarray) -> DataFrame:
    """Cells by their numbers instead of their places among the centres."""
    sent = rows.sparkSession.sparkContext.broadcast(names)
    place = rows.columns.index("cell")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.set_column(place, "cell", pa.array(sent.value[batch.column(place).to_numpy()]))

    return rows.mapInArrow(run, rows.schema)


def _split_and_merge(
    index: StoredIndex, touched: np.ndarray, pending: DataFrame, sizes: dict[int, int]
) -> tuple[np.ndarray, np.ndarray]:
    """Numbers and centres of the touched cells after splits and merges."""
    spark = pending.sparkSession
    numbers = [int(index.cells[c]) for c in touched]
    large = [c for c in numbers if sizes.get(c, 0) > SPLIT * index.target]
    small = [c for c in numbers if sizes.get(c, 0) * MERGE < index.target]
    if len(small) == len(numbers):
        small = small[1:]  # one of them takes the rows of the others
    centre = {int(c): index.centres[k] for k, c in enumerate(index.cells)}
    names = [c for c in numbers if c not in small]
    centres = [centre[c] for c in names]
    fresh = int(index.cells.max()) + 1
    rng = np.random.default_rng(index.version)
    for c in large:
        step = -(-sizes[c] // SPLIT_SAMPLE)
        some = pending.where((F.col("cell") == c) & (F.pmod(F.xxhash64("id"), F.lit(step)) == 0))
        table = some.select("embedding").toArrow().combine_chunks()
        if table.num_rows < 2:
            continue
        halves = k_means(points(as_matrix(table.column(0).combine_chunks()), index.metric), 2, rng)
        if len(halves) == 2 and np.isfinite(halves).all():
            centres[names.index(c)] = halves[0]
            names.append(fresh)
            centres.append(halves[1])
            fresh += 1
    return np.array(names, np.int64), np.array(centres)
