"""Retrieval of answers that differ: maximal marginal relevance.

The ``fetch_k`` nearest rows of a question are its candidates. They are taken one by one: the
next is the one most like the question and least like those taken already. Candidates of one
question lie side by side in a partition, and a task holds one question at a time.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pagequarry.operators.nearest import BROADCAST_ROWS, DECIMALS, _search, as_matrix

FETCH = 20
BALANCE = 0.5


def _unit(rows: np.ndarray) -> np.ndarray:
    norms = np.linalg.norm(rows, axis=1, keepdims=True)
    return np.divide(rows, norms, out=np.zeros_like(rows), where=norms > 0)


def choose(question: np.ndarray, candidates: np.ndarray, k: int, balance: float) -> list[int]:
    """Positions of ``k`` candidates, in the order they are taken; ties to the earlier one.

    A candidate counts ``balance`` times its cosine with the question, less the rest times
    its largest cosine with a candidate taken before.
    """
    units = _unit(candidates)
    like = np.round(units @ _unit(question[None])[0], DECIMALS)
    worst = np.full(len(units), -np.inf)
    taken: list[int] = []
    for _ in range(min(k, len(units))):
        gain = like if not taken else np.round(balance * like - (1 - balance) * worst, DECIMALS)
        gain = np.where(np.isnan(gain), -np.inf, gain)
        gain[taken] = -np.inf
        free = np.setdiff1d(np.arange(len(units)), taken)
        best = int(free[np.argmax(gain[free])])
        taken.append(best)
        worst = np.maximum(worst, np.round(units @ units[best], DECIMALS))
    return taken


def diverse(
    questions: DataFrame,
    corpus: DataFrame,
    k: int = 4,
    fetch_k: int = FETCH,
    balance: float = BALANCE,
    metric: str = "l2",
    **limits,
) -> DataFrame:
    """``k`` rows of each question chosen from its ``fetch_k`` nearest: (qid, rank, id, dist).

    ``questions`` is (qid, embedding) and ``corpus`` (id, embedding), each id once.
    ``balance`` 1 is the nearest rows in order, 0 asks for difference alone. ``dist`` is that
    of ``nearest``; fewer candidates than ``k`` are all taken.
    """
    if not 0 <= balance <= 1:
        raise ValueError("balance is between 0 and 1")
    found, most = _search(questions, corpus, max(k, fetch_k), metric, **limits)
    if most is not None and most <= BROADCAST_ROWS:
        found = F.broadcast(found)
    vector = F.col("embedding").cast("array<float>").alias("embedding")
    candidates = found.join(corpus.select("id", vector), "id")
    asked = questions.select(
        F.lit(None).cast(corpus.schema["id"].dataType).alias("id"),
        "qid",
        F.lit(0).alias("rank"),
        F.lit(None).cast("double").alias("dist"),
        vector,
    ).where(F.col("embedding").isNotNull())
    return taken_in_turn(candidates.unionByName(asked), k, balance)


def taken_in_turn(rows: DataFrame, k: int, balance: float) -> DataFrame:
    """(qid, rank, id, dist, embedding), the question itself at rank 0, to the chosen rows."""
    kinds = {f.name: f.dataType.simpleString() for f in rows.schema}
    rows = rows.select("qid", "rank", "id", "dist", "embedding")

    def picked(parts: list[pa.RecordBatch]) -> pa.RecordBatch | None:
        whole = pa.Table.from_batches(parts).combine_chunks().to_batches()[0]
        vectors = as_matrix(whole.column("embedding"))
        # The question is the first row of its group.
        if whole.num_rows < 2 or whole.column("rank")[0].as_py() != 0:
            return None
        order = choose(vectors[0], vectors[1:], k, balance)
        own = whole.take(pa.array(np.array(order) + 1))
        rank = pa.array(np.arange(1, len(order) + 1), pa.int32())
        return pa.RecordBatch.from_arrays(
            [own.column("qid"), rank, own.column("id"), own.column("dist")],
            ["qid", "rank", "id", "dist"],
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: list[pa.RecordBatch] = []
        for batch in batches:
            if not batch.num_rows:
                continue
            # A group begins with each rank 0; what is left over goes on in the next batch.
            starts = np.flatnonzero(batch.column("rank").to_numpy() == 0)
            for low, high in zip([0, *starts], [*starts, batch.num_rows], strict=True):
                if low in starts and waiting:
                    if (out := picked(waiting)) is not None:
                        yield out
                    waiting = []
                if high > low:
                    waiting.append(batch.slice(low, high - low))
        if waiting and (out := picked(waiting)) is not None:
            yield out

    schema = f"qid {kinds['qid']}, rank int, id {kinds['id']}, dist double"
    return rows.repartition("qid").sortWithinPartitions("qid", "rank").mapInArrow(run, schema)
