"""Toxicity by a subsequence string kernel, Nystroem landmarks and a support vector machine.

The kernel of two strings sums over their common subsequences of three letters, each
weighted by how far it is stretched in either string, so an insult with letters put in, or
with another ending, stays close to itself. Strings are the words of a sentence (single
letters in a row are put together first). A sentence is as toxic as its worst word: a
multiple-instance machine, trained on sentences of labelled documents, picks the word
that counts in each and is fitted again. The decisions for the worst three words of a
document, and how many different words it has, give its probability: one clear insult is
enough, a word that only looks like one is not.

For a fixed model the decision is linear in the subsequences of a word, so the landmarks
fold into one weight per subsequence: a broadcast table of fixed size.

Defined cases: a null or empty text has the score of a text in which nothing is close to
any landmark. Labels other than 0 and 1 are ignored; a document labelled twice counts as
toxic if one label says so. Without labels of both classes every score is the share of
toxic labels (0 if there are none). Repeated rows each get their row.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache
from heapq import nlargest
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pagequarry.scratch import materialise

REACH = 8  # letters from the first to the last of a subsequence, at most
STRETCH = 0.5  # the weight of one more letter between the ends of a subsequence
LETTERS = 64
LONGEST = 24  # longer words are seen through overlapping windows of this size
MOST_LABELLED = 4000  # documents of each class that the machine is fitted on, at most
LANDMARKS, CLEAN_LANDMARKS, HARD_LANDMARKS = 48, 16, 32
CANDIDATES = 600
SENTENCES = 3  # the worst of a training document, in each round
ROUNDS = 4
WORST = 3  # words of a document that its probability rests on
REMEMBERED = 100_000
CHOICES = 400_000  # subsequences that are looked at together
SENTENCE_END = re.compile(r"[.!?\n]+(?:\s|$)|\n")


def units(text: str) -> list[str]:
    """The words of a text; three or more single letters in a row become one."""
    tokens = text.lower().split()
    single = np.fromiter(map(len, tokens), np.int32, len(tokens)) == 1
    if not single.any():
        return tokens
    edge = np.flatnonzero(np.diff(np.concatenate([[0], single, [0]])))
    runs = [(a, b) for a, b in zip(edge[::2].tolist(), edge[1::2].tolist(), strict=True) if b - a > 2]
    return tokens + ["".join(tokens[a:b]) for a, b in runs]


BEGIN, END = "\x02", "\x03"


def spell(word: str) -> list[str]:
    """Letters and digits of a word between marks of its ends, in windows if it is long."""
    word = BEGIN + "".join(filter(str.isalnum, word)) + END
    if len(word) <= LONGEST:
        return [word]
    return [word[i : i + LONGEST] for i in range(0, len(word) - LONGEST // 2, LONGEST // 2)]


def _code(char: str) -> int:
    if "a" <= char <= "z":
        return ord(char) - 96
    if "0" <= char <= "9":
        return ord(char) - 21
    if char in (BEGIN, END):
        return 0 if char == BEGIN else 63
    return 37 + ord(char) % 26


_CODES: dict[str, int] = {}


def codes(word: str) -> list[int]:
    out = []
    for char in word:
        code = _CODES.get(char)
        if code is None:
            code = _CODES[char] = _code(char)
        out.append(code)
    return out


@lru_cache(maxsize=LONGEST + 1)
def triples(size: int) -> tuple[np.ndarray, np.ndarray]:
    """All choices of three places of a string within ``REACH``, and their weights, which
    depend on its length alone and have norm 1."""
    places = np.array(list(combinations(range(size), 3)), np.int32).reshape(-1, 3)
    places = places[places[:, 2] - places[:, 0] < REACH]
    weight = STRETCH ** (places[:, 2] - places[:, 0] + 1).astype(np.float32)
    return places, (weight / max(np.sqrt((weight**2).sum()), 1e-9)).astype(np.float32)


def by_length(words: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(which words, subsequence codes, weights) for the words of each length."""
    sizes = np.array([len(w) for w in words])
    for size in np.unique(sizes):
        if size < 3:
            continue
        places, weight = triples(int(size))
        which = np.flatnonzero(sizes == size)
        step = max(1, CHOICES // len(places))
        for i in range(0, len(which), step):
            part = which[i : i + step]
            letters = np.array([codes(words[k]) for k in part], np.int32)
            code = letters[:, places[:, 0]] * LETTERS + letters[:, places[:, 1]]
            yield part, code * LETTERS + letters[:, places[:, 2]], weight


def kernel(words: list[str], landmarks: list[str]) -> np.ndarray:
    """The subsequence kernel of every word with every landmark."""
    own = list(by_length(landmarks))
    used = np.unique(np.concatenate([code.ravel() for _, code, _ in own] or [np.empty(0, int)]))
    rows = np.zeros(LETTERS**3, np.int32)
    rows[used] = np.arange(1, len(used) + 1)
    # Row 0 is for the subsequences that no landmark has.
    short = np.zeros((len(used) + 1, len(landmarks)), np.float32)
    for which, code, weight in own:
        for k, row in zip(which, code, strict=True):
            np.add.at(short[:, k], rows[row], weight)
    out = np.zeros((len(words), len(landmarks)), np.float32)
    for which, code, weight in by_length(words):
        row = rows[code]
        word, at = np.nonzero(row)
        part = np.zeros((len(which), len(landmarks)), np.float32)
        for i in range(0, len(word), CHOICES // 10):
            w, a = word[i : i + CHOICES // 10], at[i : i + CHOICES // 10]
            np.add.at(part, w, short[row[w, a]] * weight[a][:, None])
        out[which] = part
    return out


@dataclass
class Model:
    """Weights of subsequences, and those of the worst words for a probability."""

    table: np.ndarray
    bias: float
    slopes: np.ndarray  # of the worst decisions and the logarithm of the number of words
    offset: float

    def decisions(self, words: list[str]) -> np.ndarray:
        """The decision for each word: that of its worst window."""
        spelled = [spell(w) for w in words]
        owner = np.repeat(np.arange(len(words)), [len(s) for s in spelled])
        windows = [w for s in spelled for w in s]
        value = _of_spelled(self, windows)
        worst = np.full(len(words), -np.inf, np.float32)
        np.maximum.at(worst, owner, value)
        return worst

    def probability(self, seen: np.ndarray) -> np.ndarray:
        """Of documents, by their rows of ``evidence``."""
        return 1 / (1 + np.exp(-np.clip(seen @ self.slopes + self.offset, -50, 50)))


def evidence(decisions: list[list[float]], words: list[int], bias: float) -> np.ndarray:
    """A row for each document: its worst decisions, and the logarithm of its words."""
    rows = np.full((len(decisions), WORST + 1), bias)
    for row, own in zip(rows, decisions, strict=True):
        worst = nlargest(WORST, own)
        row[: len(worst)] = worst
    rows[:, WORST] = np.log1p(words)
    return rows


def constant(share: float) -> Model:
    share = min(max(share, 0.0), 0.49) or 1e-12
    none = np.zeros(WORST + 1)
    return Model(np.zeros(LETTERS**3, np.float32), 0.0, none, float(np.log(share / (1 - share))))


def _squared_hinge(x: np.ndarray, y: np.ndarray, weight: np.ndarray, ridge: float) -> np.ndarray:
    """Linear support vector machine with squared loss, by Newton steps."""
    size = x.shape[1]
    w = np.zeros(size + 1)
    keep = np.diag([ridge] * size + [1e-6])
    for _ in range(40):
        inside = np.flatnonzero(y * (x @ w[:-1] + w[-1]) < 1)
        square, side = keep.copy(), np.zeros(size + 1)
        for i in range(0, len(inside), 10_000):
            part = inside[i : i + 10_000]
            rows = np.hstack([x[part], np.ones((len(part), 1))])
            square += (rows * weight[part, None]).T @ rows
            side += rows.T @ (weight[part] * y[part])
        step = np.linalg.solve(square, side)
        if np.abs(step - w).max() < 1e-6:
            break
        w = step
    return w


def _logistic(x: np.ndarray, label: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """Logistic regression with a small ridge against a perfect split; the offset is last."""
    x = np.hstack([x, np.ones((len(x), 1))])
    ridge = np.append(np.full(x.shape[1] - 1, 0.05), 1e-6)
    w = np.zeros(x.shape[1])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -50, 50)))
        curve = (x * (weight * p * (1 - p))[:, None]).T @ x + np.diag(ridge)
        w = w + np.linalg.solve(curve, x.T @ (weight * (label - p)) - ridge * w)
    return w


def choose_landmarks(
    rows: list[tuple[str, int, int]], toxic: int, clean: int, strings: int
) -> list[str]:
    """Strings that tell toxic from clean documents, none too close to one before it.

    Strings that chance would set apart among so many (by the likelihood ratio) are left
    out, but for the first few.
    """
    scored = sorted((-_evidence(p, n, toxic, clean), s) for s, p, n in rows)
    sure = [s for k, (e, s) in enumerate(scored) if -e > np.log(strings + 1) or k < 8]
    common = sorted((-(n / (clean + 1) - p / (toxic + 1)), s) for s, p, n in rows)
    chosen = _apart(sure, LANDMARKS)
    return chosen + _apart([s for _, s in common if s not in chosen], CLEAN_LANDMARKS)


def _evidence(p: int, n: int, toxic: int, clean: int) -> float:
    """Likelihood ratio of being found in ``p`` toxic and ``n`` clean documents."""
    share = toxic / (toxic + clean)
    found = p / (p + n) if p + n else share
    if found <= share:
        return 0.0
    return p * np.log(found / share) + (n * np.log((1 - found) / (1 - share)) if n else 0.0)


def _apart(words: list[str], most: int) -> list[str]:
    if not words:
        return []
    close = kernel(words, words)
    chosen: list[int] = []
    for k in range(len(words)):
        if len(chosen) < most and all(close[k, c] < 0.7 for c in chosen):
            chosen.append(k)
    return [words[k] for k in chosen]


class Machine:
    """What is learned: landmarks, and the words of training sentences seen so far."""

    def __init__(self, landmarks: list[str], clean_weight: float):
        self.clean_weight = clean_weight
        self.words: dict[int, set[str]] = {}
        self.label: dict[int, int] = {}
        self.size: dict[int, int] = {}
        self.toxic_landmarks = max(1, len(landmarks) - CLEAN_LANDMARKS)
        self._stand_on(landmarks)

    def _stand_on(self, landmarks: list[str]) -> None:
        self.landmarks = landmarks
        own = kernel(landmarks, landmarks).astype(float)
        value, vector = np.linalg.eigh((own + own.T) / 2)
        scale = np.where(value > 1e-3, 1 / np.sqrt(np.maximum(value, 1e-3)), 0)
        self.root = (vector * scale) @ vector.T

    def learn_mistakes(self, model: Model) -> None:
        """Add the words of clean documents that look most toxic as landmarks."""
        words = sorted({w for d, own in self.words.items() if not self.label[d] for w in own})
        value = _of_spelled(model, words)
        hard = [words[k] for k in np.argsort(-value, kind="stable")[:CANDIDATES]]
        known = set(self.landmarks)
        self._stand_on(self.landmarks + _apart([w for w in hard if w not in known], HARD_LANDMARKS))

    def see(self, bags: list[tuple[int, int, int, list[str]]]) -> None:
        """More words of (document, label, number of its words, words)."""
        for doc, label, size, words in bags:
            self.label[doc], self.size[doc] = label, size
            self.words.setdefault(doc, set()).update(words)

    def fit(self) -> Model:
        docs = sorted(self.label)
        words = [w for d in docs for w in sorted(self.words[d])]
        doc = np.repeat(np.arange(len(docs)), [len(self.words[d]) for d in docs])
        label = np.array([self.label[d] for d in docs])
        distinct, place = np.unique(np.array(words, dtype=object), return_inverse=True)
        near = kernel(list(distinct), self.landmarks)
        x = (near @ self.root.astype(np.float32))[place]
        worst = near[place][:, : self.toxic_landmarks].max(axis=1)
        toxic = label[doc] == 1
        for _ in range(4):
            # Of a toxic document the worst sentence counts, of a clean one all do.
            best = np.full(len(docs), -np.inf)
            np.maximum.at(best, doc, worst)
            chosen = ~toxic | (worst >= best[doc])
            y = np.where(toxic, 1.0, -1.0)[chosen]
            balance = np.where(y > 0, 1 / max((y > 0).sum(), 1), 1 / max((y < 0).sum(), 1))
            w = _squared_hinge(x[chosen], y, balance * len(y), 0.5)
            worst = x @ w[:-1] + w[-1]
        ends = np.cumsum([len(self.words[d]) for d in docs])
        decisions = [list(part) for part in np.split(worst, ends[:-1])]
        seen = evidence(decisions, [self.size[d] for d in docs], w[-1])
        line = _logistic(seen, label, np.where(label == 1, 1.0, self.clean_weight))
        table = np.zeros(LETTERS**3, np.float64)
        for which, code, weight in by_length(self.landmarks):
            for k, row in zip(which, code, strict=True):
                np.add.at(table, row, weight * (self.root @ w[:-1])[k])
        return Model(table.astype(np.float32), float(w[-1]), line[:-1], float(line[-1]))


def _of_spelled(model: Model, windows: list[str]) -> np.ndarray:
    value = np.full(len(windows), model.bias, np.float32)
    for which, code, weight in by_length(windows):
        value[which] += model.table[code] @ weight
    return value


def _strings(word: str) -> set[str]:
    """What may become a landmark: a word and its beginnings."""
    return {w[:k] for w in spell(word) for k in (5, 6, 7, 8, LONGEST) if len(w) >= 6}


def _count_strings(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in (b.slice(i, 200) for b in parts for i in range(0, b.num_rows, 200)):
        counts = {0: Counter(), 1: Counter()}
        for text, label in zip(batch["text"], batch["toxic"].to_pylist(), strict=True):
            found = set()
            for word in set(units(text.as_py() or "")):
                found |= _strings(word)
            counts[label].update(found)
        strings = list(counts[0].keys() | counts[1].keys())
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(strings, pa.string()),
                pa.array([counts[1][s] for s in strings], pa.int64()),
                pa.array([counts[0][s] for s in strings], pa.int64()),
            ],
            names=["string", "toxic", "clean"],
        )


def train(docs: DataFrame, labels: DataFrame, most: int = MOST_LABELLED) -> Model:
    """Fit the machine on at most ``most`` labelled documents of each class.

    ``labels`` (doc_id, toxic) holds the rows that may be learned from. The documents
    are picked by the hash of their id, their ids go to the scan of ``docs``
    (doc_id, text), and words, sentences and decisions are counted and chosen in tasks.
    """
    known = (
        labels.where("toxic IN (0, 1) AND doc_id IS NOT NULL")
        .groupBy("doc_id")
        .agg(F.max("toxic").cast("int").alias("toxic"))
    )
    size = {r.toxic: r["n"] for r in known.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    if len(size) < 2:
        return constant(float(size.get(1, 0) > 0))
    order = F.xxhash64(F.col("doc_id").cast("string"))
    picked = [known.where(F.col("toxic") == k).orderBy(order, "doc_id").limit(most) for k in (0, 1)]
    sample = picked[0].unionByName(picked[1])
    chosen = materialise(
        docs.select("doc_id", "text")
        .join(F.broadcast(sample), "doc_id")
        .withColumn("doc", F.xxhash64(F.col("doc_id").cast("string"))),
        "labelled",
    ).repartition(docs.sparkSession.sparkContext.defaultParallelism, "doc_id")
    seen = {r.toxic: r["n"] for r in chosen.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    toxic, clean = seen.get(1, 0), seen.get(0, 0)
    if not toxic or not clean:
        return constant(size[1] / (size[0] + size[1]))
    counted = (
        chosen.mapInArrow(_count_strings, "string string, toxic long, clean long")
        .groupBy("string")
        .agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))
    )
    odds = F.log((F.col("toxic") + 0.5) / (toxic + 1)) - F.log((F.col("clean") + 0.5) / (clean + 1))
    rows = [
        tuple(r)
        for table in (
            counted.where("toxic > 1").orderBy(F.desc(odds * F.sqrt("toxic")), "string"),
            counted.orderBy(F.desc("clean"), "string"),
        )
        for r in table.limit(CANDIDATES).collect()
    ]
    landmarks = choose_landmarks(sorted(set(rows)), toxic, clean, counted.count())
    if not landmarks:
        return constant(size[1] / (size[0] + size[1]))

    machine = Machine(landmarks, (size[0] / clean) / (size[1] / toxic))
    model = None
    for turn in range(ROUNDS):
        if turn == ROUNDS // 2:
            machine.learn_mistakes(model)
        found = chosen.mapInArrow(
            _worst_sentences(landmarks, model), "doc long, toxic int, size long, words array<string>"
        ).collect()
        machine.see([(r.doc, r.toxic, r["size"], [v for w in r.words for v in spell(w)]) for r in found])
        model = machine.fit()
    return model


def _worst_sentences(landmarks: list[str], model: Model | None):
    """A job that picks the worst words of each training document, and the worst word of its
    worst sentences: by the kernel with the landmarks at first, then by the decision of the
    model so far."""

    def values(words: list[str]) -> dict[str, float]:
        if model:
            return dict(zip(words, model.decisions(words).tolist(), strict=True))
        spelled = [(w, v) for w in words for v in spell(w)]
        most = max(1, len(landmarks) - CLEAN_LANDMARKS)
        near = kernel([v for _, v in spelled], landmarks[:most]).max(axis=1, initial=0)
        value: dict[str, float] = {}
        for (word, _), v in zip(spelled, near.tolist(), strict=True):
            value[word] = max(v, value.get(word, 0.0))
        return value

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in parts:
            for i in range(0, batch.num_rows, 200):
                rows = batch.slice(i, 200)
                split = [
                    [u for s in SENTENCE_END.split(t.as_py() or "") if (u := units(s))]
                    for t in rows["text"]
                ]
                value = values(sorted({w for doc in split for s in doc for w in s}))
                distinct = [{w for s in doc for w in s} for doc in split]
                words = []
                for doc, own in zip(split, distinct, strict=True):
                    of_sentences = nlargest(SENTENCES, {max((value[w], w) for w in s) for s in doc})
                    worst = nlargest(WORST, ((value[w], w) for w in own))
                    words.append(sorted({w for _, w in of_sentences + worst}))
                yield pa.RecordBatch.from_arrays(
                    [
                        rows["doc"],
                        rows["toxic"],
                        pa.array([len(own) for own in distinct], pa.int64()),
                        pa.array(words, pa.list_(pa.string())),
                    ],
                    names=["doc", "toxic", "size", "words"],
                )

    return run


class Scorer:
    """Scores texts and remembers the decisions for words."""

    def __init__(self, model: Model):
        self.model, self.known, self.old = model, {}, {}

    def scores(self, texts: list[str]) -> np.ndarray:
        words = [set(units(t)) for t in texts]
        new = list(set().union(*words) - self.known.keys())
        if len(self.known) + len(new) > REMEMBERED:
            self.known, self.old = {}, self.known
            new = list(set().union(*words))
        again = {w: self.old[w] for w in new if w in self.old}
        new = [w for w in new if w not in again]
        self.known.update(again)
        self.known.update(zip(new, self.model.decisions(new).tolist(), strict=True))
        found = [list(map(self.known.__getitem__, w)) for w in words]
        return self.model.probability(evidence(found, [len(w) for w in words], self.model.bias))


_SCORERS: dict[int, Scorer] = {}


def _scorer(model) -> Scorer:
    if model.id not in _SCORERS:
        _SCORERS.clear()
        _SCORERS[model.id] = Scorer(model.value)
    return _SCORERS[model.id]


def _forget() -> None:
    """Let go of what an idle worker would hold."""
    _SCORERS.clear()
    pa.default_memory_pool().release_unused()


class _Shared:
    """A model on its way to the tasks, with a name that workers know it by."""

    def __init__(self, spark, model: Model):
        self.sent = spark.sparkContext.broadcast(model)
        self.id = self.sent._jbroadcast.id()

    def __getstate__(self):
        return {"sent": self.sent, "id": self.id}

    @property
    def value(self) -> Model:
        return self.sent.value


def _batch_scores(scorer: Scorer, batch: pa.RecordBatch, size: int = 500) -> np.ndarray:
    texts = batch["text"]
    parts = [
        scorer.scores([t.as_py() or "" for t in texts[i : i + size]])
        for i in range(0, len(texts), size)
    ]
    return np.concatenate(parts) if parts else np.empty(0)


def score(docs: DataFrame, model: Model) -> DataFrame:
    """(doc_id, score) for each row of ``docs`` (doc_id, text)."""
    shared = _Shared(docs.sparkSession, model)

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in parts:
            values = _batch_scores(_scorer(shared), batch)
            yield pa.RecordBatch.from_arrays(
                [batch["doc_id"], pa.array(values, pa.float64())], names=["doc_id", "score"]
            )
        _forget()

    docs = docs.select("doc_id", "text")
    return docs.mapInArrow(run, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, score double")


def drop_toxic(docs: DataFrame, model: Model, limit: float = 0.5) -> DataFrame:
    """The documents, with all their columns, whose score is below ``limit``."""
    shared = _Shared(docs.sparkSession, model)

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in parts:
            values = _batch_scores(_scorer(shared), batch)
            yield batch.filter(pa.array(values < limit, pa.bool_()))
        _forget()

    return docs.mapInArrow(run, docs.schema)
