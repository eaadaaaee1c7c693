"""Nearest neighbours: the closest corpus vectors of each question.

Distances are in double precision, rounded to 9 decimals, and ties go to the smaller
id, so the result does not depend on how the corpus is partitioned.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from pagequarry.scratch import materialise, scratch_path

METRICS = ("l2", "cosine", "ip")
DECIMALS = 9

# Most bytes of question vectors sent to every task at once, of corpus vectors sent instead,
# and most cells of one block of distances.
QUESTION_BYTES = 8 << 20
BLOCK_BYTES = 64 << 20
DISTANCE_CELLS = 1 << 21

# Questions and cells of one product in single precision: its cells stay in a core's cache.
QUESTION_STEP = 512
PRODUCT_CELLS = 1 << 20

# Most distances of which the least stands for all where the k-th is looked for.
GROUP = 16

# Bytes and number of question blocks that one job takes, and bytes of those that one reading
# of the corpus takes: the others have tasks of their own.
WAVE_BYTES = 8 << 20
WAVE_BLOCKS = 64
SCAN_BYTES = 4 << 20

# Most distances of one block of a join within groups.
BLOCK_CELLS = 1 << 31

# Fewest questions of a block, however small the limit.
LEAST_BLOCK = 16

# Most rows of a small table broadcast to a join: top-k rows, groups to be split.
BROADCAST_ROWS = 200_000


# -- inside a task -----------------------------------------------------------------


def as_matrix(column: pa.Array) -> np.ndarray:
    """List column as a matrix, without a Python object per row."""
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    sizes = column.value_lengths().to_numpy(zero_copy_only=False)
    if (sizes != sizes[:1]).any():
        raise ValueError("vectors of different dimensions in one column")
    return flat.reshape(len(column), int(sizes[0]) if len(sizes) else 0)


def points_of(column: pa.Array, metric: str) -> np.ndarray:
    return points(as_matrix(column), metric)


def points(vectors: np.ndarray, metric: str) -> np.ndarray:
    """Vectors as points whose distances rank like the metric."""
    if metric != "cosine":
        return vectors
    norms = np.linalg.norm(vectors, axis=1, keepdims=True)
    return np.divide(vectors, norms, out=np.zeros_like(vectors), where=norms > 0)


def smallest(who: np.ndarray, ids: np.ndarray, dist: np.ndarray, k: int) -> np.ndarray:
    """Positions of the ``k`` smallest (dist, id) of each ``who``, grouped by it."""
    order = np.argsort(ids, kind="stable")
    order = order[np.lexsort((dist[order], who[order]))]
    grouped = who[order]
    starts = np.flatnonzero(np.r_[True, grouped[1:] != grouped[:-1]])
    rank = np.arange(len(order)) - np.repeat(starts, np.diff(np.r_[starts, len(order)]))
    return order[rank < k]


def without_surplus_copies(
    x: np.ndarray, ids: np.ndarray, k: int
) -> tuple[np.ndarray, np.ndarray]:
    """Of equal vectors keep the ``k`` smallest ids: no other can be among the ``k``
    nearest of any question, and copies by the thousand are ties to be broken."""
    if not x.size:
        return x, ids
    odd = np.arange(1, 2 * x.shape[1], 2, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    code = (np.ascontiguousarray(x).view(np.uint64) * odd).sum(axis=1)
    _, first, group = np.unique(code, return_index=True, return_inverse=True)
    if len(first) == len(x) or not (x == x[first[group]]).all():
        return x, ids  # no copies, or two vectors with one code: leave all as they are
    keep = smallest(group, ids, np.zeros(len(x)), k)
    return x[keep], ids[keep]


@dataclass(frozen=True)
class Distances:
    """Distances of question rows ``q`` to corpus rows ``x``."""

    metric: str

    def block(self, q: np.ndarray, x: np.ndarray) -> np.ndarray:
        """All pairs by one matrix product; exact up to rounding."""
        dots = q @ x.T
        if self.metric == "ip":
            return 1.0 - dots
        if self.metric == "cosine":
            norms = np.outer(np.linalg.norm(q, axis=1), np.linalg.norm(x, axis=1))
            return 1.0 - np.divide(dots, norms, out=np.zeros_like(dots), where=norms > 0)
        dots *= -2.0
        dots += (q * q).sum(axis=1)[:, None]
        dots += (x * x).sum(axis=1)[None, :]
        return np.maximum(dots, 0.0, out=dots)

    def factors(self, rows: np.ndarray, corpus: bool) -> np.ndarray:
        """Rows in single precision, widened so that one product of both sides gives ``block``."""
        one = np.ones((len(rows), 1))
        with np.errstate(invalid="ignore", over="ignore"):
            if self.metric == "l2":
                squares = (rows * rows).sum(axis=1, keepdims=True)
                sides = [rows, one, squares] if corpus else [-2.0 * rows, squares, one]
            else:
                rows = points(rows, self.metric)
                sides = [rows if corpus else -rows, one]
            return np.concatenate(sides, axis=1).astype(np.float32)

    def single_slack(self, width: int, *squares: np.ndarray) -> float:
        """How far the product of ``factors`` may be from ``pairs``; infinite if unknown.

        ``squares`` has the squared lengths of the rows of either side."""
        scale = 1.0 + sum(float(side.max(initial=0.0)) for side in squares)
        if self.metric == "cosine":
            scale = 3.0 if np.isfinite(scale) else np.inf
        if not scale < 1e30:
            return np.inf
        return 2 * 10.0**-DECIMALS + (width + 8) * 2.0**-22 * scale

    def pairs(self, q: np.ndarray, x: np.ndarray) -> np.ndarray:
        """Row by row, the same for the same two vectors wherever they are."""
        if self.metric == "l2":
            return np.round(((q - x) ** 2).sum(axis=1), DECIMALS)
        dots = (q * x).sum(axis=1)
        if self.metric == "cosine":
            norms = np.sqrt((q * q).sum(axis=1)) * np.sqrt((x * x).sum(axis=1))
            dots = np.divide(dots, norms, out=np.zeros_like(dots), where=norms > 0)
        return np.round(1.0 - dots, DECIMALS)

    def slack(self, q: np.ndarray, x: np.ndarray) -> float:
        """How far ``block`` may be from ``pairs``: rounding to DECIMALS and of sums."""
        scale = 1.0
        if self.metric != "cosine":
            for rows in (q, x):
                squares = (rows * rows).sum(axis=1)
                scale += float(squares[np.isfinite(squares)].max(initial=0.0))
        return 2 * 10.0**-DECIMALS + 1e-12 * scale


def block_nearest(
    q: np.ndarray,
    x: np.ndarray,
    ids: np.ndarray,
    k: int,
    distances: Distances,
    best: tuple[np.ndarray, np.ndarray, np.ndarray] | None = None,
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(question position, id, dist) of the ``k`` nearest of ``x`` to each of ``q``.

    Matrix products pick the candidates, ties at the k-th place included; the
    distances of those alone are computed pair by pair. Both work in slices, so
    memory stays bounded whatever the ties. ``best`` is what earlier rows gave, by question:
    from the k-th of it on, only what is nearer is looked at.
    """
    x, ids = without_surplus_copies(x, ids, k)
    if best is None:
        best = (np.empty(0, np.int64), ids[:0], np.empty(0))
    if not (len(q) and len(x)):
        return best
    most = min(len(q), QUESTION_STEP)
    parts = [Rows.of(x[part], ids[part], distances) for part in cuts(len(x), most)]
    firsts = np.arange(0, len(q), most)
    edges = np.searchsorted(best[0], np.r_[firsts, len(q)])
    found = []
    for first, start, stop in zip(firsts, edges, edges[1:], strict=False):
        asked = Rows.of(q[first : first + most], None, distances)
        mine = (best[0][start:stop] - first, best[1][start:stop], best[2][start:stop])
        for part in parts:
            mine = part.nearer(asked, mine, k, distances)
        found.append((mine[0] + first, *mine[1:]))
    return tuple(np.concatenate(column) for column in zip(*found, strict=True))


def cuts(rows: int, questions: int) -> list[slice]:
    """Slices of the corpus whose products with so many questions stay small."""
    step = max(1, min(DISTANCE_CELLS, PRODUCT_CELLS) // max(1, questions))
    return [slice(at, at + step) for at in range(0, rows, step)]


@dataclass(frozen=True)
class Rows:
    """Vectors made ready for products: corpus rows with their ids, or questions without."""

    rows: np.ndarray
    ids: np.ndarray | None
    factors: np.ndarray
    squares: np.ndarray

    @staticmethod
    def of(rows: np.ndarray, ids: np.ndarray | None, distances: Distances) -> Rows:
        return Rows(rows, ids, distances.factors(rows, ids is not None), squares(rows))

    def nearer(
        self,
        asked: Rows,
        best: tuple[np.ndarray, np.ndarray, np.ndarray],
        k: int,
        distances: Distances,
    ) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """``best`` of the questions ``asked`` with what is nearer among these rows."""
        q, x = asked.rows, self.rows
        known = kth_known(best, len(q), k)
        pairs = None
        slack = distances.single_slack(q.shape[1], asked.squares, self.squares)
        if np.isfinite(slack):
            pairs = _within(asked.factors @ self.factors.T, known.copy(), k, slack)
        if pairs is None or len(pairs[0]) > len(q) * len(x) // 16 + k * len(q):
            # Vectors too large, or too near to one another, for single precision.
            with np.errstate(invalid="ignore", over="ignore"):
                approx = distances.block(q, x)
            # Distances that are no number come last, and are candidates if they are needed.
            approx[np.isnan(approx)] = np.inf
            pairs = _within(approx, known, k, distances.slack(q, x))
        return closer(best, q, x, self.ids, *pairs, k, distances)


def squares(rows: np.ndarray) -> np.ndarray:
    """Squared lengths; those that are no number count as infinite."""
    with np.errstate(invalid="ignore", over="ignore"):
        return np.nan_to_num((rows * rows).sum(axis=1), nan=np.inf, posinf=np.inf)


def _within(
    approx: np.ndarray, known: np.ndarray, k: int, slack: float
) -> tuple[np.ndarray, np.ndarray]:
    """Pairs that may be among the ``k`` nearest: ``known`` is the k-th distance so far."""
    new = np.isinf(known)
    if new.any():
        known[new] = _kth_bound(approx if new.all() else approx[new], k) + slack
    limit = np.nextafter((known + slack).astype(approx.dtype), np.inf, dtype=approx.dtype)
    return positions(approx <= limit[:, None])


def _kth_bound(dist: np.ndarray, k: int) -> np.ndarray:
    """At least the k-th least of each row, and hardly more: the k-th of the least of groups."""
    size = min(GROUP, dist.shape[1] // (8 * k))
    if size > 1:
        groups = dist.shape[1] // size
        dist = dist[:, : groups * size].reshape(len(dist), size, groups).min(axis=1)
    kth = min(k, dist.shape[1]) - 1
    return np.partition(dist, kth, axis=1)[:, kth]


def positions(mask: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """As ``np.nonzero`` of a matrix, but in the time of a vector."""
    return np.divmod(np.flatnonzero(mask), mask.shape[1])


def kth_known(
    best: tuple[np.ndarray, np.ndarray, np.ndarray], questions: int, k: int
) -> np.ndarray:
    """The k-th distance of each question in ``best``, infinite where there are fewer."""
    known = np.full(questions, np.inf)
    who, _, dist = best
    if len(who):
        # ``smallest`` leaves the rows of a question together, the nearest first.
        last = np.flatnonzero(np.r_[who[1:] != who[:-1], True])
        full = np.diff(np.r_[-1, last]) >= k
        known[who[last[full]]] = dist[last[full]]
        known[np.isnan(known)] = np.inf
    return known


def closer(
    best: tuple[np.ndarray, np.ndarray, np.ndarray],
    q: np.ndarray,
    x: np.ndarray,
    ids: np.ndarray,
    who: np.ndarray,
    which: np.ndarray,
    k: int,
    distances: Distances,
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``best`` with the pairs (``who``, ``which``) of questions and rows measured."""
    if not len(who):
        return best
    step = max(1, DISTANCE_CELLS // max(1, q.shape[1]))
    dist = np.concatenate(
        [
            distances.pairs(q[who[i : i + step]], x[which[i : i + step]])
            for i in range(0, len(who), step)
        ]
    )
    found = (
        np.concatenate([best[0], who]),
        np.concatenate([best[1], ids[which]]),
        np.concatenate([best[2], dist]),
    )
    keep = smallest(*found, k)
    return tuple(column[keep] for column in found)


def nearest_centre(rows: np.ndarray, centres: np.ndarray) -> np.ndarray:
    step = max(1, DISTANCE_CELLS // len(centres))
    parts = [
        Distances("l2").block(rows[at : at + step], centres).argmin(axis=1)
        for at in range(0, len(rows), step)
    ]
    return np.concatenate(parts) if parts else np.empty(0, np.int64)


def k_means(rows: np.ndarray, count: int, rng: np.random.Generator, rounds: int = 10) -> np.ndarray:
    """At most ``count`` centres: rounds of the nearest centre of each row and the means."""
    different = np.unique(rows, axis=0)
    if len(different) <= count:
        return different
    centres = different[rng.choice(len(different), count, replace=False)]
    for _ in range(rounds):
        nearest = nearest_centre(rows, centres)
        size = np.bincount(nearest, minlength=len(centres))
        for dim in range(rows.shape[1]):
            total = np.bincount(nearest, rows[:, dim], len(centres))
            centres[:, dim] = np.where(size > 0, total / np.maximum(size, 1), centres[:, dim])
    return centres


# -- DataFrame operators -----------------------------------------------------------


def top_k(candidates: DataFrame, k: int, *within: str) -> DataFrame:
    """Rank (qid, id, dist) rows and keep ``k`` per question, and per value of ``within``.

    Spark limits the window before its shuffle too, so each task sends at most ``k``
    rows per question.
    """
    nearest_first = Window.partitionBy(*within, "qid").orderBy("dist", "id")
    return (
        candidates.withColumn("rank", F.row_number().over(nearest_first))
        .where(F.col("rank") <= k)
        .select("qid", "rank", "id", "dist")
    )


@dataclass(frozen=True)
class QuestionBlock:
    """Questions known to be few enough to be sent to every task."""

    ids: pa.Array
    vectors: np.ndarray


def collect_questions(questions: DataFrame, limit_bytes: int = QUESTION_BYTES) -> QuestionBlock | None:
    """The questions if their vectors fit in ``limit_bytes``, else None.

    Reads one row to learn the dimension and at most one row more than fit.
    """
    first = questions.select(F.size("embedding").alias("n")).first()
    if first is None:
        return QuestionBlock(pa.array([]), np.empty((0, 0)))
    most = max(1, limit_bytes // (8 * max(1, first.n)))
    table = questions.limit(most + 1).toArrow().combine_chunks()
    if table.num_rows > most:
        return None
    ids, vectors = (table.column(c).combine_chunks() for c in ("qid", "embedding"))
    return QuestionBlock(ids, as_matrix(vectors))


def _prepared(df: DataFrame, id: str) -> DataFrame:
    vectors = df.select(id, F.col("embedding").cast("array<float>").alias("embedding"))
    return vectors.where(F.col("embedding").isNotNull())


def nearest(
    questions: DataFrame,
    corpus: DataFrame,
    k: int = 4,
    metric: str = "l2",
    question_bytes: int = QUESTION_BYTES,
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """Exact ``k`` nearest corpus rows of every question: (qid, rank, id, dist).

    ``questions`` has columns ``qid, embedding`` and ``corpus`` has ``id, embedding``.
    Questions of up to ``question_bytes`` are sent to every task, and the corpus stays where
    it is; more are sent in blocks of that size, one after the other, or a corpus of up to
    ``block_bytes`` goes to them. Nothing but the ``k`` best is shuffled. Distances are squared L2, 1 - cosine, or 1 - dot product.
    Questions are read more than once: store vectors that a model computed.
    """
    return _search(questions, corpus, k, metric, question_bytes, block_bytes)[0]


def _search(
    questions: DataFrame,
    corpus: DataFrame,
    k: int,
    metric: str,
    question_bytes: int = QUESTION_BYTES,
    block_bytes: int = BLOCK_BYTES,
) -> tuple[DataFrame, int | None]:
    """The neighbours, and the most rows there can be where that is known."""
    if metric not in METRICS:
        raise ValueError(f"metric must be one of {METRICS}")
    given = corpus
    questions = _prepared(questions, "qid")
    corpus = _prepared(corpus, "id")
    block = collect_questions(questions, question_bytes)
    if block is not None:
        return top_k(_scanned(block, questions, corpus, k, metric), k), k * len(block.vectors)
    # Counted without the vectors: null ones make it smaller, not larger.
    first = corpus.select(F.size("embedding").alias("n")).first()
    if first is None or 8 * max(1, first.n) * given.count() <= block_bytes:
        whole = collect_questions(corpus.withColumnRenamed("id", "qid"), block_bytes)
        if whole is not None:
            return top_k(_scanned_questions(whole, questions, corpus, k, metric), k), None
    return _in_turn(questions, corpus, k, metric, question_bytes), None


def _candidate_schema(questions: DataFrame, corpus: DataFrame) -> str:
    qid, id = (df.schema[0].dataType.simpleString() for df in (questions, corpus))
    return f"qid {qid}, id {id}, dist double"


def _rows(qids: pa.Array, ids: np.ndarray, id_type: pa.DataType, dist: np.ndarray) -> pa.RecordBatch:
    columns = [qids, pa.array(ids, type=id_type), pa.array(dist)]
    return pa.RecordBatch.from_arrays(columns, ["qid", "id", "dist"])


def _scanned(
    block: QuestionBlock, questions: DataFrame, corpus: DataFrame, k: int, metric: str
) -> DataFrame:
    """Each task scans its corpus partition once and emits its ``k`` best per question."""
    schema = _candidate_schema(questions, corpus)
    sent = corpus.sparkSession.sparkContext.broadcast(block)
    distances = Distances(metric)
    id_type = to_arrow_type(corpus.schema[0].dataType)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        q = sent.value.vectors
        best = None
        for batch in batches:
            if not (len(q) and batch.num_rows):
                continue
            x = as_matrix(batch.column(1))
            ids = batch.column(0).to_numpy(zero_copy_only=False)
            best = block_nearest(q, x, ids, k, distances, best)
        if best is not None:
            yield _rows(sent.value.ids.take(pa.array(best[0])), best[1], id_type, best[2])

    return corpus.mapInArrow(scan, schema)


def _scanned_questions(
    corpus_block: QuestionBlock, questions: DataFrame, corpus: DataFrame, k: int, metric: str
) -> DataFrame:
    """A corpus small enough to be sent: each task reads its questions once."""
    schema = _candidate_schema(questions, corpus)
    sent = corpus.sparkSession.sparkContext.broadcast(corpus_block)
    distances = Distances(metric)
    id_type = to_arrow_type(corpus.schema[0].dataType)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        x, ids = sent.value.vectors, sent.value.ids.to_numpy(zero_copy_only=False)
        for batch in batches:
            if len(x) and batch.num_rows:
                who, near, dist = block_nearest(as_matrix(batch.column(1)), x, ids, k, distances)
                yield _rows(batch.column(0).take(pa.array(who)), near, id_type, dist)

    return questions.mapInArrow(scan, schema)


def question_blocks(
    questions: DataFrame, limit_bytes: int = QUESTION_BYTES
) -> Iterator[QuestionBlock]:
    """All questions (qid, embedding), in blocks of bounded size, at least one.

    More than one block's worth are written once; the driver knows the names of the files and
    holds a block at a time, or as many small ones as fit in ``WAVE_BYTES``.
    """
    spark = questions.sparkSession
    questions = _prepared(questions, "qid")
    whole = collect_questions(questions, limit_bytes)
    if whole is not None:
        yield whole
        return
    width = questions.select(F.size("embedding").alias("n")).first().n
    most = max(LEAST_BLOCK, limit_bytes // (8 * max(1, width)))
    # Small blocks are written and read together, as each reading is a job.
    once = max(1, WAVE_BYTES // (8 * max(1, width) * most)) * most
    path = scratch_path(spark, "questions")
    questions.write.option("maxRecordsPerFile", once).parquet(path)
    stored = spark.read.schema(questions.schema).parquet(path)
    files = stored.groupBy(F.input_file_name().alias("file")).count().orderBy("file").collect()
    waiting: list[str] = []
    rows = 0
    for file, count in [*files, (None, once + 1)]:
        if waiting and rows + count > once:
            table = spark.read.schema(questions.schema).parquet(*waiting).toArrow().combine_chunks()
            ids, vectors = (table.column(c).combine_chunks() for c in ("qid", "embedding"))
            for at in range(0, len(ids), most):
                yield QuestionBlock(ids.slice(at, most), as_matrix(vectors.slice(at, most)))
            waiting, rows = [], 0
        waiting.append(file)
        rows += count


def _in_turn(
    questions: DataFrame, corpus: DataFrame, k: int, metric: str, question_bytes: int
) -> DataFrame:
    """Many questions: the corpus stays where it is, and blocks of them are sent to it. A job
    takes as many blocks as ``WAVE_BYTES`` holds, and a reading of the corpus as many as
    ``SCAN_BYTES`` holds: many small ones would each cost a job, and a reading."""
    spark, path = corpus.sparkSession, scratch_path(corpus.sparkSession, "nearest")
    blocks = question_blocks(questions, question_bytes)
    for wave in _waves(blocks, WAVE_BYTES):
        numbered = iter(enumerate(wave))
        scans = [
            _scanned_together(dict(next(numbered) for _ in some), questions, corpus, k, metric)
            for some in _waves(iter(wave), SCAN_BYTES)
        ]
        found = top_k(reduce(DataFrame.unionAll, scans), k, "block")
        found.write.mode("append").parquet(path)
    return spark.read.schema(found.schema).parquet(path)


def _scanned_together(
    blocks: dict[int, QuestionBlock], questions: DataFrame, corpus: DataFrame, k: int, metric: str
) -> DataFrame:
    """``_scanned`` of several blocks in one reading of the corpus, with the ``block`` of each row.

    Every block has its own ranks, also where another one has a question of the same id."""
    first = np.cumsum([0, *(len(block.ids) for block in blocks.values())])
    whole = QuestionBlock(
        pa.array(np.arange(first[-1])), np.concatenate([block.vectors for block in blocks.values()])
    )
    place = questions.select(F.lit(0).cast("long").alias("qid"), "embedding")
    found = _scanned(whole, place, corpus, k, metric)
    schema = f"{_candidate_schema(questions, corpus)}, block int"
    qids = pa.concat_arrays([block.ids for block in blocks.values()])
    numbers = np.repeat(np.array(list(blocks), np.int32), np.diff(first))
    sent = corpus.sparkSession.sparkContext.broadcast((qids, numbers))

    def named(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        qids, numbers = sent.value
        for batch in batches:
            at = batch.column(0)
            columns = [qids.take(at), *batch.columns[1:], pa.array(numbers[at.to_numpy()])]
            yield pa.RecordBatch.from_arrays(columns, ["qid", "id", "dist", "block"])

    return found.mapInArrow(named, schema)


def _waves(
    blocks: Iterator[QuestionBlock], most: int | None = None
) -> Iterator[list[QuestionBlock]]:
    """Blocks, in turn, as many together as fit in ``most`` bytes (``WAVE_BYTES``) and
    ``WAVE_BLOCKS``."""
    most = WAVE_BYTES if most is None else most
    wave, size = [], 0
    for block in blocks:
        if wave and (size + block.vectors.nbytes > most or len(wave) == WAVE_BLOCKS):
            yield wave
            wave, size = [], 0
        wave.append(block)
        size += block.vectors.nbytes
    if wave:
        yield wave


def large_groups(
    questions: DataFrame, corpus: DataFrame, corpus_rows: int, question_rows: int
) -> DataFrame:
    """Groups to be split: (group, corpus_parts, question_parts).

    A block has no more than ``BLOCK_CELLS`` distances either, as rows that fit may be work
    for an hour. There are at most rows / limit such groups, however the rows are spread;
    they are broadcast when that proves few.
    """
    one, none = F.lit(1), F.lit(0)
    rows = corpus.select("group", one.alias("c"), none.alias("q")).unionByName(
        questions.select("group", none.alias("c"), one.alias("q"))
    )
    counted = rows.groupBy("group").agg(F.sum("c").alias("c"), F.sum("q").alias("q"))

    def parts(count: str, limit: int) -> Column:
        return F.greatest(F.ceil(F.col(count) / limit), F.lit(1))

    # Of one part of the corpus with all questions; decimals, as the product may be large.
    cells = F.col("c").cast("double") / parts("c", corpus_rows) * F.col("q")
    many = F.greatest(parts("q", question_rows), F.ceil(cells / BLOCK_CELLS))
    large = materialise(
        counted.where(
            (F.col("c") > corpus_rows) | (F.col("q") > question_rows) | (cells > BLOCK_CELLS)
        ).select(
            "group", parts("c", corpus_rows).alias("corpus_parts"), many.alias("question_parts")
        ),
        "large_groups",
    )
    return F.broadcast(large) if large.count() <= BROADCAST_ROWS else large


def join_groups(
    questions: DataFrame,
    corpus: DataFrame,
    k: int,
    metric: str,
    corpus_rows: int = 100_000,
    question_rows: int = 1_000_000,
) -> DataFrame:
    """``k`` best (qid, id, dist) per question within its groups, block by block.

    ``questions`` is (group, qid, embedding), ``corpus`` is (group, id, embedding). A
    group with more corpus rows or questions than one block takes is cut on that side,
    and the other side is copied to each part, so any pair meets in one block.
    """
    large = large_groups(questions, corpus, corpus_rows, question_rows)
    one = F.lit(1).cast("bigint")
    corpus_parts = F.coalesce("corpus_parts", one)
    question_parts = F.coalesce("question_parts", one)
    return join_blocks(
        _placed(corpus.join(large, "group", "left"), "corpus", corpus_parts, question_parts),
        _placed(questions.join(large, "group", "left"), "question", question_parts, corpus_parts),
        k,
        metric,
    )


BLOCK = ["group", "corpus_part", "question_part"]


def _placed(df: DataFrame, side: str, parts: Column, copies: Column) -> DataFrame:
    """Rows in one part of their own side and in every part of the other."""
    other = "question" if side == "corpus" else "corpus"
    key = "id" if side == "corpus" else "qid"
    zero, one = F.lit(0).cast("bigint"), F.lit(1).cast("bigint")
    return df.select(
        F.col("group").cast("bigint").alias("group"),
        F.pmod(F.xxhash64(key), parts.cast("bigint")).alias(f"{side}_part"),
        F.explode(F.sequence(zero, copies.cast("bigint") - one)).alias(f"{other}_part"),
        key,
        "embedding",
    )


def join_blocks(corpus: DataFrame, questions: DataFrame, k: int, metric: str) -> DataFrame:
    """``k`` best (qid, id, dist) per question and block.

    Within a block the corpus rows are sorted first: a task holds those and streams
    the questions past them, and no pair is written out but the ``k`` best.
    """
    qid_type, id_type = questions.schema["qid"].dataType, corpus.schema["id"].dataType
    schema = f"qid {qid_type.simpleString()}, id {id_type.simpleString()}, dist double"
    arrow_id = to_arrow_type(id_type)
    distances = Distances(metric)
    no_id, no_qid = F.lit(None).cast(id_type).alias("id"), F.lit(None).cast(qid_type).alias("qid")
    tagged = corpus.select(*BLOCK, F.lit(0).alias("side"), "id", no_qid, "embedding").unionByName(
        questions.select(*BLOCK, F.lit(1).alias("side"), no_id, "qid", "embedding")
    )

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, parts, x, ids = None, [], None, None
        for batch in batches:
            if not batch.num_rows:
                continue
            keys = np.stack([batch.column(i).to_numpy() for i in range(4)])
            edges = np.flatnonzero((np.diff(keys) != 0).any(axis=0)) + 1
            for start, stop in zip(np.r_[0, edges], np.r_[edges, keys.shape[1]]):
                rows = batch.slice(start, stop - start)
                here, vectors = tuple(keys[:3, start]), as_matrix(rows.column(6))
                if here != current:
                    current, parts, x, ids = here, [], None, None
                if keys[3, start] == 0:
                    parts.append((vectors, rows.column(4).to_numpy(zero_copy_only=False)))
                    continue
                if parts:
                    x, ids = (np.concatenate(c) for c in zip(*parts))
                    parts = []
                if x is not None:
                    who, near, dist = block_nearest(vectors, x, ids, k, distances)
                    yield _rows(rows.column(5).take(pa.array(who)), near, arrow_id, dist)

    # A fixed number of partitions: adaptive execution would merge blocks that are small
    # in bytes but not in work.
    spark = corpus.sparkSession
    tasks = max(
        int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism
    )
    return (
        tagged.repartition(tasks, *BLOCK)
        .sortWithinPartitions(*BLOCK, "side")
        .mapInArrow(join, schema)
    )


def retrieve(
    questions: DataFrame, chunks: DataFrame, k: int = 4, metric: str = "l2", **limits
) -> DataFrame:
    """Nearest chunks with their content: the top-k rows joined back to the chunk table.

    ``chunks`` has ``id, embedding`` and whatever else is to be returned. Content is
    not carried through the search, only looked up for the winners.
    """
    found, most = _search(questions, chunks, k, metric, **limits)
    if most is not None and most <= BROADCAST_ROWS:
        found = F.broadcast(found)
    return found.join(chunks.drop("embedding"), "id")
