"""Embedding text columns."""

from __future__ import annotations

import hashlib
from collections import deque
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

from pagequarry.functions.text import split_words

# Fixed value: the most texts a model takes in one request.
REQUEST_SIZE = 150


@dataclass(frozen=True)
class Embedder:
    """A model by name. ``load()`` runs in the worker and returns the call
    ``list of texts -> list of vectors``."""

    name: str
    dim: int
    load: Callable[[], Callable[[list[str]], Sequence]]


@lru_cache(maxsize=1 << 18)
def _hash(token: str) -> int:
    return int(hashlib.md5(token.encode()).hexdigest()[:8], 16)


def hashed_words(dim: int = 64) -> Embedder:
    """Offline default: word counts hashed into ``dim`` buckets, scaled to length 1."""

    def embed(texts: list[str]) -> list[np.ndarray]:
        vectors = []
        for text in texts:
            buckets = [_hash(t) % dim for t in split_words(text)]
            counts = np.bincount(buckets, minlength=dim) if buckets else np.zeros(dim)
            vectors.append((counts / (np.sqrt((counts**2).sum()) or 1.0)).astype(np.float32))
        return vectors

    return Embedder(f"hashed-words-{dim}", dim, lambda: embed)


def embed(text: Column, embedder: Embedder, request_size: int = REQUEST_SIZE) -> Column:
    """Embed a text column in requests of at most ``request_size`` texts, in order.

    The model is loaded once per batch stream, and requests are filled across Arrow
    batches, so small batches do not mean small requests. An error fails the task.
    Marked nondeterministic so that the optimizer never calls the model twice.
    """

    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        call = embedder.load()

        def request(texts: list[str | None]) -> pd.Series:
            present = [t for t in texts if t is not None]
            vectors = list(call(present)) if present else []
            if len(vectors) != len(present) or any(len(v) != embedder.dim for v in vectors):
                raise ValueError(f"{embedder.name}: not one vector of {embedder.dim} per text")
            given = iter(vectors)
            return pd.Series([None if t is None else next(given) for t in texts], dtype=object)

        waiting: deque[str | None] = deque()
        for batch in batches:
            waiting.extend(batch.tolist())
            while len(waiting) >= request_size:
                yield request([waiting.popleft() for _ in range(request_size)])
        if waiting:
            yield request(list(waiting))

    return F.pandas_udf(run, "array<float>").asNondeterministic()(text)
