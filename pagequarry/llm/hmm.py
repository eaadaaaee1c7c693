"""Language-model scores from a hidden Markov model.

A word is emitted in two steps: a latent state emits the class of the word, the class emits
the word. The most frequent words are classes of their own, others share a class by their
first and last letters; both tables have a fixed size, so states and emissions fit in a
broadcast however large the vocabulary grows. States are trained by Baum-Welch: each task
returns expected counts of the training texts it holds, which are added up in two steps.
The scaled forward recursion gives the exact probability of a text under the model.

Word counts stay a distributed table. The words of a bounded list are looked up in the
tasks; the rest is counted per text and joined, so no frequent word is a hot key.

Defined cases: a null or empty text is a single end token. Without training texts every
token has probability 1 in the base score, and the states are those they begin with.
Repeated rows are texts like others, in training and in scores.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pagequarry.llm import batches
from pagequarry.scratch import materialise

STATES = 12
ROUNDS = 6
OWN_CLASS = 4096  # most frequent words, at most, with a class each
SHARED = 4096  # classes of the other words
LISTED = 1 << 17  # words, at most, that tasks look up without a join
END = b"\n"
CHUNK_TOKENS = 200_000
STAY = 0.9  # the chance to stay in a state, at first
PRIOR = 30.0  # pseudo-counts of a state, spread like all training tokens
SEED = 7


def _affix(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """The shared class of words by their first two and last three bytes."""
    key = np.zeros(len(start), np.uint64)
    places = (start, np.minimum(start + 1, end - 1), end - 1, np.maximum(end - 2, start))
    for place in (*places, np.maximum(end - 3, start)):
        key = key * np.uint64(257) + data[place].astype(np.uint64)
    return (batches.mix(key) % np.uint64(SHARED)).astype(np.int64)


@dataclass
class Lexicon:
    """The listed words by hash, and the numbers of all classes. Class 0 is the end."""

    hashes: np.ndarray
    count: np.ndarray
    kind: np.ndarray
    own: int  # classes of a single word, after class 0
    tokens: int  # of all training texts, ends included
    distinct: int
    class_tokens: np.ndarray | None = None
    class_words: np.ndarray | None = None

    @property
    def classes(self) -> int:
        return 1 + self.own + SHARED

    @property
    def total(self) -> float:
        return self.tokens + 0.5 * (self.distinct + 1)

    def look_up(
        self, hashes: np.ndarray, data: np.ndarray, start: np.ndarray, end: np.ndarray
    ) -> tuple[np.ndarray, np.ndarray]:
        """(place in the list or -1, class) of words."""
        place = np.full(len(hashes), -1)
        if len(self.hashes):
            near = np.minimum(np.searchsorted(self.hashes, hashes), len(self.hashes) - 1)
            place = np.where(self.hashes[near] == hashes, near, -1)
        kind = 1 + self.own + _affix(data, start, end)
        listed = place >= 0
        kind[listed] = np.where(self.kind[place[listed]] > 0, self.kind[place[listed]], kind[listed])
        return place, kind

    def room(self) -> np.ndarray:
        """What the counts of a class and its unknown word add up to, as in the base score."""
        room = self.class_tokens + 0.5 * (self.class_words + 1)
        room[: 1 + self.own] = self.class_tokens[: 1 + self.own] + 0.5
        return room

    def unigram(self) -> np.ndarray:
        """The share of each class among training tokens, none at zero."""
        share = self.class_tokens + 0.5
        return share / share.sum()


@dataclass
class States:
    """Start, transition and emission probabilities."""

    start: np.ndarray
    move: np.ndarray
    emit: np.ndarray


@dataclass
class Model:
    counts: DataFrame  # (word, c) of the training texts
    lexicon: Lexicon
    states: States


def _word_counts(docs: DataFrame) -> DataFrame:
    """(word, c) over (text); each batch is counted before the shuffle. An end for each text."""

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in parts:
            counts = Counter({END: batch.num_rows})
            for _, _, data, texts in batches.pieces(batch):
                raw = data.tobytes().translate(batches.LOWER)
                for a, b in zip(texts[:-1].tolist(), texts[1:].tolist(), strict=True):
                    counts.update(raw[a:b].split())
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(counts), pa.binary()), pa.array(list(counts.values()), pa.int64())],
                names=["word", "c"],
            )

    found = docs.select("text").mapInArrow(run, "word binary, c long")
    return found.groupBy("word").agg(F.sum("c").alias("c"))


def _most_frequent(counts: DataFrame, most: int) -> list[tuple[bytes, int]]:
    """The words at or above the lowest frequency band at which there are at most ``most``."""
    band = F.floor(F.log2("c") * 8).cast("int")
    sizes = counts.groupBy(band.alias("band")).agg(F.count("*").alias("n")).collect()
    room, lowest = most, None
    for row in sorted(sizes, reverse=True):
        room -= row.n
        if room < 0:
            break
        lowest = row.band
    if lowest is None:
        return []
    rows = counts.where(band >= lowest).collect()
    return sorted(((bytes(r.word), r.c) for r in rows), key=lambda r: (-r[1], r[0]))


def _hash_rows(words: list[bytes]) -> np.ndarray:
    column = pa.array(words, pa.binary())
    data, starts = batches.text_bytes(column)
    return batches.span_hash(batches.prefix_sums(data), starts[:-1], starts[1:])


def _lexicon(counts: DataFrame) -> Lexicon:
    total = counts.agg(F.sum("c").alias("n"), F.count("*").alias("v")).first()
    listed = [r for r in _most_frequent(counts.where(F.col("word") != END), LISTED)]
    kind = np.zeros(len(listed), np.int64)
    own = min(OWN_CLASS, len(listed))
    kind[:own] = np.arange(1, own + 1)
    hashes = _hash_rows([w for w, _ in listed]) if listed else np.empty(0, np.uint64)
    order = np.argsort(hashes)
    lexicon = Lexicon(
        hashes[order],
        np.array([c for _, c in listed], np.int64)[order],
        kind[order],
        own,
        int(total.n or 0),
        int(total.v),
    )
    classes = lexicon.classes

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens, words = np.zeros(classes), np.zeros(classes)
        for batch in parts:
            data, starts = batches.text_bytes(batch["word"])
            if not batch.num_rows:
                continue
            hashes = batches.span_hash(batches.prefix_sums(data), starts[:-1], starts[1:])
            _, kind = lexicon.look_up(hashes, data, starts[:-1], starts[1:])
            kind[[bytes(w.as_py()) == END for w in batch["word"]]] = 0
            tokens += np.bincount(kind, batch["c"].to_numpy(), classes)
            words += np.bincount(kind, minlength=classes)
        used = np.flatnonzero(words)
        yield pa.RecordBatch.from_arrays(
            [pa.array(used), pa.array(tokens[used]), pa.array(words[used])],
            names=["class", "tokens", "words"],
        )

    found = (
        counts.mapInArrow(run, "class long, tokens double, words double")
        .groupBy("class")
        .agg(F.sum("tokens").alias("tokens"), F.sum("words").alias("words"))
        .collect()
    )
    lexicon.class_tokens, lexicon.class_words = np.zeros(classes), np.zeros(classes)
    for row in found:
        lexicon.class_tokens[row["class"]] = row.tokens
        lexicon.class_words[row["class"]] = row.words
    return lexicon


READ = (
    "n_tokens long, classes binary, base double, inside double, known long, "
    "rest array<struct<word: binary, n: long, room: double>>"
)


def _read(docs: DataFrame, lexicon: Lexicon) -> DataFrame:
    """(doc_id, train, ...) with the classes of each text's tokens, the sums over its listed
    words, and its other words with their numbers."""
    sent = docs.sparkSession.sparkContext.broadcast(lexicon)

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lexicon = sent.value
        room, total = lexicon.room(), lexicon.total
        base = np.log10((lexicon.count + 0.5) / total)
        end_base = np.log10((lexicon.class_tokens[0] + 0.5) / total)
        for batch in parts:
            for first, last, data, texts in batches.pieces(batch):
                data = batches.lower(data)
                words = batches.Words(data, texts, batches.TOKEN_BYTES)
                hashes = words.hashes()
                place, kind = lexicon.look_up(hashes, data, words.start, words.end)
                size = last - first
                owner = np.repeat(np.arange(size), words.counts())
                listed = place >= 0
                own = lexicon.kind[place[listed]] > 0
                inside = np.log10((lexicon.count[place[listed]] + 0.5) / room[kind[listed]])
                inside[own] = 0.0  # the only word of its class
                rest = np.flatnonzero(~listed)
                order = rest[np.lexsort((hashes[rest], owner[rest]))]
                new = np.ones(len(order), bool)
                new[1:] = (owner[order][1:] != owner[order][:-1]) | (
                    hashes[order][1:] != hashes[order][:-1]
                )
                at = order[new]
                times = np.diff(np.append(np.flatnonzero(new), len(order)))
                raw = data.tobytes()
                spelled = [
                    raw[a:b]
                    for a, b in zip(words.start[at].tolist(), words.end[at].tolist(), strict=True)
                ]
                others = pa.StructArray.from_arrays(
                    [
                        pa.array(spelled, pa.binary()),
                        pa.array(times, pa.int64()),
                        pa.array(room[kind[at]], pa.float64()),
                    ],
                    names=["word", "n", "room"],
                )
                cuts = np.searchsorted(owner[at], np.arange(size + 1)).astype(np.int32)
                kinds = np.split(kind.astype("<u2"), words.first[1:-1])
                yield pa.RecordBatch.from_arrays(
                    [
                        batch["doc_id"].slice(first, size),
                        batch["train"].slice(first, size),
                        pa.array(words.counts() + 1, pa.int64()),
                        pa.array([k.tobytes() + b"\0\0" for k in kinds], pa.binary()),
                        pa.array(
                            np.bincount(owner[listed], base[place[listed]], size) + end_base,
                            pa.float64(),
                        ),
                        pa.array(np.bincount(owner[listed], inside, size), pa.float64()),
                        pa.array(
                            np.bincount(owner[listed], minlength=size)
                            + int(lexicon.class_tokens[0] > 0),
                            pa.int64(),
                        ),
                        pa.ListArray.from_arrays(pa.array(cuts), others),
                    ],
                    names=["doc_id", "train", *[c.split()[0] for c in READ.split(", ")[:5]], "rest"],
                )

    docs = docs.select("doc_id", "train", "text")
    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.mapInArrow(run, f"doc_id {kind}, train boolean, {READ}")


class Chunk:
    """Texts of similar length, side by side: token t of all texts lies in one block."""

    def __init__(self, texts: list[np.ndarray]):
        """``texts`` by falling length."""
        sizes = np.array([len(t) for t in texts])
        self.active = len(texts) - np.searchsorted(sizes[::-1], np.arange(sizes[0]), "right")
        self.start = np.concatenate([[0], np.cumsum(self.active)])
        steps = np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        self.kind = np.empty(sizes.sum(), np.int64)
        self.kind[self.start[steps] + np.repeat(np.arange(len(texts)), sizes)] = np.concatenate(texts)

    def forward(self, states: States) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(scaled forward probabilities, scale of each token, emissions)."""
        emit = np.ascontiguousarray(states.emit.T)[self.kind]
        scale = np.empty(len(self.kind), emit.dtype)
        ahead, ones = np.empty_like(emit), np.ones(emit.shape[1], emit.dtype)
        ahead[: self.start[1]] = states.start
        for t, n in enumerate(self.active.tolist()):
            a, b = self.start[t], self.start[t] + n
            now = ahead[a:b]
            if t:
                np.matmul(ahead[self.start[t - 1] : self.start[t - 1] + n], states.move, out=now)
            now *= emit[a:b]
            np.matmul(now, ones, out=scale[a:b])
            now /= scale[a:b, None]
        return ahead, scale, emit

    def log10(self, states: States) -> np.ndarray:
        """log10 of the probability of each text's classes."""
        _, scale, _ = self.forward(states)
        text = np.arange(len(scale)) - np.repeat(self.start[:-1], self.active)
        return np.bincount(text, np.log10(scale), self.active[0])

    def expected(self, states: States) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Expected counts of starts, moves and emissions."""
        ahead, scale, later = self.forward(states)
        later /= scale[:, None]
        after, back = np.ones_like(ahead), np.ascontiguousarray(states.move.T)
        for t in range(len(self.active) - 2, -1, -1):
            a, m, b = self.start[t], self.active[t + 1], self.start[t + 1]
            now = later[b : b + m]
            now *= after[b : b + m]
            np.matmul(now, back, out=after[a : a + m])
        # The token before each token that has one.
        step = np.arange(self.active[0], len(scale))
        before = step - np.repeat(self.active[:-1], self.active[1:])
        moves = ahead[before].T @ later[self.active[0] :]
        ahead *= after
        starts = ahead[: self.active[0]].sum(axis=0)
        seen = np.stack(
            [np.bincount(self.kind, ahead[:, k], states.emit.shape[1]) for k in range(len(starts))]
        )
        return starts, moves * states.move, seen


def chunks(texts: list[np.ndarray]) -> Iterator[tuple[np.ndarray, Chunk]]:
    """(which texts, chunk) with about ``CHUNK_TOKENS`` tokens each."""
    sizes = np.array([len(t) for t in texts])
    order = np.argsort(-sizes, kind="stable")
    group = (np.cumsum(sizes[order]) - sizes[order]) // CHUNK_TOKENS
    for which in np.split(order, np.flatnonzero(np.diff(group)) + 1):
        if len(which):
            yield which, Chunk([texts[k] for k in which])


def _first_states(lexicon: Lexicon, states: int) -> States:
    """States that differ at random, each likely to stay."""
    random = np.random.default_rng(SEED)
    emit = lexicon.unigram() * np.exp(random.normal(0, 1, (states, lexicon.classes)))
    move = np.full((states, states), (1 - STAY) / max(states - 1, 1))
    np.fill_diagonal(move, STAY if states > 1 else 1.0)
    return States(
        np.full(states, 1 / states), move, emit / emit.sum(axis=1, keepdims=True)
    )


def _classes(batch: pa.RecordBatch) -> list[np.ndarray]:
    return [np.frombuffer(c.as_buffer(), "<u2") for c in batch["classes"]]


def _baum_welch(texts: DataFrame, states: States, lexicon: Lexicon) -> States:
    """One round over all of ``texts`` (classes)."""
    count, classes = states.emit.shape
    # Counts are expectations over all texts: single precision is enough, and scores have double.
    small = States(*(x.astype(np.float32) for x in (states.start, states.move, states.emit)))
    sent = texts.sparkSession.sparkContext.broadcast(small)

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        states = sent.value
        total = np.zeros(count + count * count + count * classes)
        for batch in parts:
            for _, chunk in chunks(_classes(batch)) if batch.num_rows else ():
                total += np.concatenate([x.ravel() for x in chunk.expected(states)])
        yield from _sums(total)

    def add(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(count + count * count + count * classes)
        for batch in parts:
            for row in batch["total"]:
                total += np.frombuffer(row.as_buffer())
        yield from _sums(total)

    def _sums(total: np.ndarray) -> Iterator[pa.RecordBatch]:
        if total.any():
            yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], ["total"])

    # The sums of tasks meet in some tasks, the sums of these on the driver.
    found = texts.mapInArrow(run, "total binary").repartition(8).mapInArrow(add, "total binary")
    total = np.zeros(count + count * count + count * classes)
    for row in found.toLocalIterator():
        total += np.frombuffer(row.total)
    starts, moves, seen = np.split(total, [count, count + count * count])
    moves, seen = moves.reshape(count, count), seen.reshape(count, classes)
    seen = seen + PRIOR * lexicon.unigram()
    moves, starts = moves + 0.1, starts + 0.1
    return States(
        starts / starts.sum(),
        moves / moves.sum(axis=1, keepdims=True),
        seen / seen.sum(axis=1, keepdims=True),
    )


def train(docs: DataFrame, states: int = STATES, rounds: int = ROUNDS) -> tuple[Model, DataFrame]:
    """A model of the rows of ``docs`` (doc_id, train, text) with ``train``, and all rows read
    by its lexicon, as ``score`` takes them."""
    counts = materialise(_word_counts(docs.where("train")), "counts")
    lexicon = _lexicon(counts)
    read = materialise(
        _read(docs, lexicon).withColumn("key", F.monotonically_increasing_id()), "read"
    )
    now = _first_states(lexicon, states)
    texts = read.where("train").select("classes")
    for _ in range(rounds):
        now = _baum_welch(texts, now, lexicon)
    return Model(counts, lexicon, now), read


def score(read: DataFrame, model: Model) -> DataFrame:
    """(doc_id, train, n_tokens, n_known, train_tokens, base_score, score) for every row."""
    sent = read.sparkSession.sparkContext.broadcast(model.states)

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in parts:
            values = np.zeros(batch.num_rows)
            for which, chunk in chunks(_classes(batch)) if batch.num_rows else ():
                values[which] = chunk.log10(sent.value)
            place = batch.schema.get_field_index("classes")
            yield batch.set_column(place, "path", pa.array(values, pa.float64()))

    total = F.lit(float(model.lexicon.total))
    c = F.coalesce("c", F.lit(0)) + 0.5
    others = (
        read.select("key", F.explode("rest").alias("x"))
        .select("key", "x.word", "x.n", "x.room")
        .join(model.counts, "word", "left")
        .groupBy("key")
        .agg(
            F.sum(F.col("n") * F.log10(c / total)).alias("rest_base"),
            F.sum(F.col("n") * F.log10(c / F.col("room"))).alias("rest_inside"),
            F.sum(F.when(F.col("c").isNotNull(), F.col("n")).otherwise(0)).alias("rest_known"),
        )
    )
    whole = read.select("doc_id", "train", "n_tokens", "classes", "base", "inside", "known", "key")
    schema = ", ".join(
        f"{f.name if f.name != 'classes' else 'path'} "
        f"{f.dataType.simpleString() if f.name != 'classes' else 'double'}"
        for f in whole.schema
    )

    def or_0(name: str) -> Column:
        return F.coalesce(name, F.lit(0.0))

    return whole.mapInArrow(run, schema).join(others, "key", "left").select(
        "doc_id",
        "train",
        "n_tokens",
        (F.col("known") + F.coalesce("rest_known", F.lit(0))).alias("n_known"),
        F.lit(model.lexicon.tokens).cast("long").alias("train_tokens"),
        (F.col("base") + or_0("rest_base")).alias("base_score"),
        (F.col("path") + F.col("inside") + or_0("rest_inside")).alias("score"),
    )
