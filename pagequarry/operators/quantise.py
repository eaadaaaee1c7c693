"""Compressed search: a scan of a few bytes a row rules out nearly all rows, exactly.

The dimensions are cut into parts, and each part of a vector becomes the number of the nearest
of 256 centres. A row keeps these bytes and how far its vector is from the one they stand for
(the slack). So each of its distances has a bound from below and from above, and a row
whose least distance exceeds the k-th of the largest distances cannot be among the k nearest.
One scan of the bytes finds that limit; a second measures the rows within it by their vectors
and keeps the k best, so no table of pairs is made. Both are products in single
precision, with room for its rounding: the second has the limits and slacks among its factors. Bounds hold whatever the centres are, so these
are learned from a bounded sample (``SAMPLE`` rows, by the hash of the id); a poor sample
costs time and no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from pagequarry.operators.nearest import (
    DECIMALS,
    DISTANCE_CELLS,
    GROUP,
    QUESTION_BYTES,
    QUESTION_STEP,
    Distances,
    QuestionBlock,
    Rows,
    as_matrix,
    closer,
    cuts,
    k_means,
    kth_known,
    nearest_centre,
    points,
    points_of,
    positions,
    question_blocks,
    smallest,
    top_k,
)
from pagequarry.scratch import materialise, scratch_path

CENTRES = 256
SAMPLE = 20_000
# Share of the pairs of a slice from which a product of all is less work than the pairs.
DENSE = 1 / 32


@dataclass(frozen=True)
class Codes:
    """``rows`` has (id, embedding, code, slack, same); ``books`` the centres of each part."""

    rows: DataFrame
    books: list[np.ndarray]
    metric: str

    def bytes_per_row(self) -> int:
        """What the scan reads of a row besides its id."""
        return len(self.books) + 16


def _cut(width: int, parts: int) -> list[slice]:
    edges = np.linspace(0, width, min(parts, width) + 1).astype(int).tolist()
    return [slice(a, b) for a, b in zip(edges, edges[1:], strict=False)]


def _decoded(code: np.ndarray, books: list[np.ndarray]) -> np.ndarray:
    return np.concatenate([book[code[:, k]] for k, book in enumerate(books)], axis=1)


def build_codes(
    corpus: DataFrame, parts: int = 16, metric: str = "l2", seed: int = 17, sample: int = SAMPLE
) -> Codes:
    """Codes of ``corpus`` (id, embedding), written once. Rows without a vector are left out."""
    if metric not in ("l2", "cosine"):
        raise ValueError("codes need a metric with a triangle inequality: l2 or cosine")
    vector = F.col("embedding").cast("array<float>").alias("embedding")
    corpus = corpus.select("id", vector).where(F.col("embedding").isNotNull())
    learned = corpus.orderBy(F.xxhash64(F.lit(seed), "id"), "id").limit(sample).select("embedding")
    table = learned.toArrow().combine_chunks()
    sampled = points_of(table.column(0).combine_chunks(), metric) if table.num_rows else np.empty((0, 1))
    sampled = sampled[np.isfinite(sampled).all(axis=1)]
    rng = np.random.default_rng(seed)
    cuts = _cut(sampled.shape[1], parts)
    sampled = sampled if len(sampled) else np.zeros((1, sampled.shape[1]))
    books = [k_means(sampled[:, c], CENTRES, rng) for c in cuts]
    sent = corpus.sparkSession.sparkContext.broadcast(books)

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        books = sent.value
        for batch in batches:
            if not batch.num_rows:
                continue
            x = points_of(batch.column(1), metric)
            with np.errstate(invalid="ignore", over="ignore"):
                code = np.stack([nearest_centre(x[:, c], b) for c, b in zip(cuts, books, strict=True)], 1)
                gap = np.sqrt(((x - _decoded(code, books)) ** 2).sum(axis=1))
            code = np.ascontiguousarray(code.astype(np.uint8))
            raw = pa.py_buffer(code.tobytes())
            ends = np.arange(0, code.size + 1, code.shape[1], dtype=np.int32)
            codes = pa.BinaryArray.from_buffers(pa.binary(), len(code), [None, pa.py_buffer(ends), raw])
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, codes, pa.array(gap)], ["id", "embedding", "code", "slack"]
            )

    kind = corpus.schema["id"].dataType.simpleString()
    schema = f"id {kind}, embedding array<float>, code binary, slack double"
    coded = corpus.mapInArrow(encode, schema).withColumn("same", F.xxhash64("embedding"))
    return Codes(materialise(coded, "codes"), books, metric)


def _without_copies(
    same: np.ndarray, code: np.ndarray, slack: np.ndarray, ids: np.ndarray, k: int
) -> np.ndarray:
    """Rows to look at: of equal vectors the ``k`` smallest ids, as no other can be needed."""
    _, first, group = np.unique(same, return_index=True, return_inverse=True)
    alike = (code == code[first[group]]).all() and np.array_equal(slack, slack[first[group]], equal_nan=True)
    if len(first) == len(same) or not alike:
        return np.arange(len(same))
    return smallest(group, ids, np.zeros(len(same)), k)


@dataclass(frozen=True)
class _Scan:
    """What a task needs to bound the distances of a block of questions."""

    q: np.ndarray
    books: list[np.ndarray]
    k: int

    def read(self, batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(rows, code, slack) of a batch of (id, code, slack, same), copies left out."""
        code = np.frombuffer(b"".join(batch.column(1).to_pylist()), np.uint8)
        code = code.reshape(batch.num_rows, -1)
        slack, same = (batch.column(c).to_numpy(zero_copy_only=False) for c in (2, 3))
        ids = batch.column(0).to_numpy(zero_copy_only=False)
        own = _without_copies(same, code, slack, ids, self.k)
        return own, code[own], np.nan_to_num(slack[own], nan=np.inf, posinf=np.inf)

    def bounds(self, batch: pa.RecordBatch) -> Iterator[tuple[np.ndarray, ...]]:
        """(rows, least) of slices of a batch: the least distances there can be."""
        own, code, slack = self.read(batch)
        step = max(1, DISTANCE_CELLS // len(self.q))
        for at in range(0, len(own), step):
            part = slice(at, at + step)
            x = _decoded(code[part], self.books)
            about = np.sqrt(Distances("l2").block(self.q, x))
            room = slack[part][None, :] + _rounding(self.q, x)
            yield own[part], np.nan_to_num(np.maximum(about - room, 0), nan=np.inf)

    def chunks(self) -> list[slice]:
        return [slice(at, at + QUESTION_STEP) for at in range(0, len(self.q), QUESTION_STEP)]

    def asked(self) -> list[Rows]:
        return [Rows.of(self.q[chunk], None, Distances("l2")) for chunk in self.chunks()]

    def parts(self, batch: pa.RecordBatch) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """(rows, decoded vectors, slack) of slices of a batch, by slack."""
        own, code, slack = self.read(batch)
        order = np.argsort(slack, kind="stable")
        for part in cuts(len(own), min(len(self.q), QUESTION_STEP)):
            at = order[part]
            yield own[at], _decoded(code[at], self.books), slack[at]

    def lower(self, best: np.ndarray, asked: list[Rows], x: np.ndarray, slack: np.ndarray) -> None:
        """Put into ``best`` what these rows have of the ``k`` least of the largest distances.

        The nearest of a group of rows of like slack stands for all of it: that leaves out
        some distances, so that the k-th is larger at most."""
        distances, room = Distances("l2"), _rounding(self.q, x)
        size = max(1, min(GROUP, len(x) // (8 * self.k)))
        groups = len(x) // size
        whole = groups * size
        # The rows of a group lie ``groups`` apart, so that the least is taken of vectors.
        order = np.r_[np.arange(whole).reshape(groups, size).T.ravel(), whole : len(x)].astype(int)
        most_slack = np.r_[slack[:whole].reshape(groups, size).max(axis=1), slack[whole:]]
        rows = Rows.of(x[order], order, distances)
        for chunk, some in zip(self.chunks(), asked, strict=True):
            error = distances.single_slack(x.shape[1], some.squares, rows.squares)
            if not np.isfinite(error):
                continue  # too large for single precision: no limit from these
            about = some.factors @ rows.factors.T
            least = about[:, :whole].reshape(len(about), size, groups).min(axis=1)
            least = np.concatenate([least, about[:, whole:]], axis=1).astype(np.float64)
            most = np.sqrt(np.maximum(least + error, 0)) + most_slack + room
            all_ = np.concatenate([best[chunk], most], axis=1)
            best[chunk] = np.partition(all_, self.k - 1, axis=1)[:, : self.k]

    def open(self, limit: np.ndarray, some: Rows, x: Rows, slack: np.ndarray) -> np.ndarray:
        """Pairs of the questions ``some`` and rows that may be within ``limit``: those with
        distance <= limit + slack. Squared, both sides are one product."""
        # Distances that are rounded to the same number are ties.
        limit = np.sqrt(limit**2 + 4 * 10.0**-DECIMALS) + _rounding(some.rows, x.rows)
        bound, loose = np.isfinite(limit), ~np.isfinite(slack)
        limit, slack = np.where(bound, limit, 0.0), np.where(loose, 0.0, slack)
        error = Distances("l2").single_slack(
            some.rows.shape[1] + 2, some.squares, x.squares, limit**2, slack**2
        )
        if not np.isfinite(error):
            return np.ones((len(limit), len(slack)), bool)
        q, one = some.rows, np.ones
        left = [-2.0 * q, (some.squares - limit**2)[:, None], one((len(q), 1)), (-2.0 * limit)[:, None]]
        right = [x.rows, one((len(slack), 1)), (x.squares - slack**2)[:, None], slack[:, None]]
        left, right = (np.concatenate(side, axis=1).astype(np.float32) for side in (left, right))
        found = left @ right.T <= np.nextafter(np.float32(error), np.float32(np.inf))
        found[~bound] = True
        found[:, loose] = True
        return found


def _limits(codes: Codes, block: QuestionBlock, k: int) -> np.ndarray:
    """The k-th least of the largest distances of each question: no nearer row is farther.

    A task keeps ``k`` numbers of each question, whatever the codes rule out."""
    rows = codes.rows.select("id", "code", "slack", "same")
    metric, books = codes.metric, codes.books
    sent = rows.sparkSession.sparkContext.broadcast((block.vectors, books))

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vectors, books = sent.value
        scan = _Scan(points(vectors, metric), books, k)
        asked = scan.asked()
        best = np.full((len(vectors), k), np.inf)
        for batch in batches:
            if not (len(vectors) and batch.num_rows):
                continue
            for _, x, slack in scan.parts(batch):
                scan.lower(best, asked, x, slack)
        if best.size:
            who = np.repeat(np.arange(len(best), dtype=np.int64), best.shape[1])
            yield pa.RecordBatch.from_arrays(
                [pa.array(who), pa.array(np.arange(best.size)), pa.array(best.reshape(-1))],
                ["qid", "id", "dist"],
            )

    found = top_k(rows.mapInArrow(scan, "qid long, id long, dist double"), k)
    limit = np.full(len(block.vectors), np.inf)
    kth = found.where(F.col("rank") == k).select("qid", "dist").toArrow()
    limit[kth.column("qid").to_numpy()] = kth.column("dist").to_numpy()
    return limit


def candidates(codes: Codes, block: QuestionBlock, k: int, qid_type: str) -> DataFrame:
    """(qid, id, least): pairs that the bytes cannot rule out, and their least distance."""
    rows = codes.rows.select("id", "code", "slack", "same")
    metric, books = codes.metric, codes.books
    sent = rows.sparkSession.sparkContext.broadcast((block, books, _limits(codes, block, k)))
    id_type = to_arrow_type(rows.schema["id"].dataType)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, books, limit = sent.value
        scan = _Scan(points(block.vectors, metric), books, k)
        for batch in batches:
            if not (len(limit) and batch.num_rows):
                continue
            for part, least in scan.bounds(batch):
                who, which = np.nonzero(least <= limit[:, None])
                columns = [
                    block.ids.take(pa.array(who)),
                    batch.column(0).take(pa.array(part[which])).cast(id_type),
                    pa.array(least[who, which]),
                ]
                yield pa.RecordBatch.from_arrays(columns, ["qid", "id", "least"])

    kind = rows.schema["id"].dataType.simpleString()
    return rows.mapInArrow(run, f"qid {qid_type}, id {kind}, least double")


def _nearest_by_codes(codes: Codes, block: QuestionBlock, k: int, qid_type: str) -> DataFrame:
    """(qid, id, dist): the ``k`` best of each task among the pairs not ruled out.

    A row is measured with its vector as soon as it is met, so no pair is kept but the
    best: codes that rule out little cost time and no memory."""
    rows = codes.rows.select("id", "code", "slack", "same", "embedding")
    metric, books = codes.metric, codes.books
    sent = rows.sparkSession.sparkContext.broadcast((block, books, _limits(codes, block, k)))
    id_type = to_arrow_type(rows.schema["id"].dataType)
    distances = Distances(metric)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, books, limit = sent.value
        scan = _Scan(points(block.vectors, metric), books, k)
        coded, best = scan.asked(), []
        asked = coded
        if metric != "l2":
            asked = [Rows.of(block.vectors[chunk], None, distances) for chunk in scan.chunks()]
        for batch in batches:
            if not (len(limit) and batch.num_rows):
                continue
            ids = batch.column(0).to_numpy(zero_copy_only=False)
            vectors = as_matrix(batch.column(4))
            best = best or [(np.empty(0, np.int64), ids[:0], np.empty(0))] * len(asked)
            for part, x, slack in scan.parts(batch):
                decoded = Rows.of(x, part, Distances("l2"))
                exact = Rows.of(vectors[part], ids[part], distances)
                for n, (chunk, some) in enumerate(zip(scan.chunks(), asked, strict=True)):
                    # The k-th of the pairs measured so far is a limit too.
                    known = kth_known(best[n], len(some.rows), k)
                    near = np.sqrt(known if metric == "l2" else 2 * known)
                    open_ = scan.open(np.minimum(limit[chunk], near), coded[n], decoded, slack)
                    if np.count_nonzero(open_) > DENSE * open_.size:
                        best[n] = exact.nearer(some, best[n], k, distances)
                        continue
                    pairs = positions(open_)
                    best[n] = closer(best[n], some.rows, exact.rows, exact.ids, *pairs, k, distances)
        if best:
            who = np.concatenate([b[0] + n * QUESTION_STEP for n, b in enumerate(best)])
            columns = [block.ids.take(pa.array(who))]
            columns += [pa.array(np.concatenate([b[1] for b in best]), type=id_type)]
            columns += [pa.array(np.concatenate([b[2] for b in best]))]
            yield pa.RecordBatch.from_arrays(columns, ["qid", "id", "dist"])

    kind = rows.schema["id"].dataType.simpleString()
    return rows.mapInArrow(run, f"qid {qid_type}, id {kind}, dist double")


def _rounding(q: np.ndarray, x: np.ndarray) -> float:
    """Room for the rounding of distances."""
    with np.errstate(invalid="ignore", over="ignore"):
        squares = [(rows * rows).sum(axis=1) for rows in (q, x)]
    scale = max(s[np.isfinite(s)].max(initial=0.0) for s in squares)
    return 1e-5 + 1e-6 * float(np.sqrt(scale))


def search_codes(
    codes: Codes, questions: DataFrame, k: int = 4, question_bytes: int = QUESTION_BYTES
) -> DataFrame:
    """The exact ``k`` nearest rows of each question (qid, embedding): (qid, rank, id, dist)."""
    spark, kind = questions.sparkSession, questions.schema["qid"].dataType.simpleString()
    id_kind = codes.rows.schema["id"].dataType.simpleString()
    path = scratch_path(spark, "nearest")
    for block in question_blocks(questions, question_bytes):
        found = top_k(_nearest_by_codes(codes, block, k, kind), k)
        found.write.mode("append").parquet(path)
    schema = f"qid {kind}, rank int, id {id_kind}, dist double"
    # Every block wrote its rows, the only one of no questions too.
    return spark.read.schema(schema).parquet(path)
