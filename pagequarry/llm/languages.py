"""Language identification: each text a mixture of languages, by expectation-maximisation.

A character trigram model of each language is counted over all texts of that language. A
text is cut into units, its words; the trigrams of a unit give its likelihood in each
language, and rounds of expectation and maximisation over the units give the shares of the
languages in the text. Sets of languages grow in the order of the shares of all: one more
language stays in the set if the likelihood gains more than a penalty that grows with the
logarithm of the number of units. The language of the largest share is the prediction.

N-grams are counted in a fixed number of hash buckets for each language, so the model that
goes to every task has a size bound (about 1.3 MB a language) at any size of the corpus; a
language is a row of it, so at most ``MOST_LANGUAGES`` are learned, else ValueError. Texts
are read in parts of ``PART`` code points, which also end a word.

Defined cases: a text that is null, empty or without a letter is ``und`` with score 0 and no
languages, and so is every text if nothing was learned. Repeated rows count as often as they
occur. Only doc_id, text and lang are read, so other columns may have any name.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pagequarry.llm import batches

UNKNOWN = "und"
MOST_LANGUAGES = 1000
PART = 1 << 20  # code points read at once
UNIT = 24  # most letters of a unit: scripts without spaces have long words
GRAM_BITS = (14, 16, 18)  # buckets of single characters, pairs and trigrams
SIZES = [1 << bits for bits in GRAM_BITS]
FIRST = [0, SIZES[0], SIZES[0] + SIZES[1]]
BUCKETS = sum(SIZES)
BACK = 5.0  # characters by which a trigram leans on its last character
PULL = 1.0  # units by which the shares of a text lean on those of the corpus
ROUNDS = 40
SETTLED = 1e-3  # change of a share that ends the rounds
PENALTY = 3.0  # times the logarithm of the units, for each further language
GROUP = 1 << 17  # units whose rounds run together
END = np.uint64(0x110000)
RESULT = "lang_pred string, score double, languages array<struct<lang:string,share:double>>"

_KIND = np.zeros(0x110000, np.int8)  # 0 not looked up yet, 1 other, 2 mark, 3 letter


def _kinds(points: np.ndarray) -> np.ndarray:
    found = _KIND[points]
    if not found.all():
        for p in np.unique(points[found == 0]).tolist():
            _KIND[p] = {"L": 3, "M": 2}.get(unicodedata.category(chr(p))[0], 1)
        found = _KIND[points]
    return found


class Units:
    """The units of some texts: unit u has the trigrams ``first[u]`` to ``first[u + 1]`` and
    belongs to text ``text[u]``; ``grams`` are the buckets of each trigram, its first two
    characters and its last one, among all buckets of a language."""

    def __init__(self, texts: list[str]):
        points = np.frombuffer("\n".join(texts).encode("utf-32-le", "replace"), np.uint32)
        kinds = _kinds(points)
        at = np.flatnonzero(kinds >= 2)
        nth = np.arange(len(at))
        new = np.diff(at, prepend=-2) != 1
        run = np.maximum.accumulate(np.where(new, nth, 0))
        start = (nth - run) % UNIT == 0
        unit = np.cumsum(start) - 1
        ends = np.cumsum([len(t) + 1 for t in texts])
        self.text = np.searchsorted(ends, at[start], "right")
        self.first = np.flatnonzero(start) + np.arange(len(self.text))
        # A text with marks only has no letter.
        lettered = np.searchsorted(ends, np.flatnonzero(kinds == 3), "right")
        self.lettered = np.bincount(lettered, minlength=len(texts)) > 0

        # The characters of all units, each unit followed by its end.
        chars = np.full(len(at) + len(self.text), END, np.uint64)
        chars[nth + unit] = points[at]
        before, first = np.full_like(chars, END), np.full_like(chars, END)
        before[1:], first[2:] = chars[:-1], chars[:-2]
        first[before == END] = END
        pair = first << np.uint64(21) | before
        self.grams = [
            _bucket(key, k)
            for k, key in enumerate([chars, pair, pair << np.uint64(21) | chars])
        ]


def _bucket(key: np.ndarray, order: int) -> np.ndarray:
    bits = batches.mix(key * batches.STEP) >> np.uint64(64 - GRAM_BITS[order])
    return bits.astype(np.int64) + FIRST[order]


@dataclass
class Model:
    """``names`` of the languages, their ``share`` of the texts, and ``counts`` of buckets."""

    names: list[str]
    share: np.ndarray
    counts: np.ndarray

    def __post_init__(self):
        single = self.counts[:, : SIZES[0]].astype(np.float64)
        chance = (single + 0.5) / (single.sum(axis=1, keepdims=True) + 0.5 * SIZES[0])
        self.back = (BACK * chance).astype(np.float32)

    def log_likelihoods(self, units: Units) -> np.ndarray:
        """The logarithm of the chance of each unit in each language."""
        if not len(units.first):
            return np.empty((0, len(self.names)), np.float32)
        one, two, three = units.grams
        found = np.empty((len(units.first), len(self.names)), np.float32)
        for k, row in enumerate(self.counts):
            chance = (row[three] + self.back[k][one]) / (row[two] + np.float32(BACK))
            found[:, k] = np.add.reduceat(np.log(chance), units.first)
        return found


# -- mixtures ----------------------------------------------------------------------


def _over_texts(values: np.ndarray, first: np.ndarray) -> np.ndarray:
    return np.add.reduceat(values, first, axis=0)


class Mixture:
    """Texts as mixtures; the units of text t are rows ``first[t]`` to ``first[t + 1]``, at
    least one. ``logs`` are the log likelihoods of the units."""

    def __init__(self, logs: np.ndarray, first: np.ndarray, prior: np.ndarray):
        self.best = logs.max(axis=1)
        self.logs, self.first, self.prior = logs, first, prior
        self.chances = np.exp(logs - self.best[:, None])
        self.sizes = np.diff(np.append(first, len(logs)))
        self.floor = _over_texts(self.best.astype(np.float64), first)

    def only(self, texts: np.ndarray) -> Mixture:
        """The mixture of some of the texts."""
        part = object.__new__(Mixture)
        sizes = self.sizes[texts]
        part.first, part.sizes, part.prior = np.cumsum(sizes) - sizes, sizes, self.prior
        rows = np.repeat(self.first[texts] - part.first, sizes) + np.arange(sizes.sum())
        part.chances = self.chances[rows]
        part.floor = self.floor[texts]
        return part

    def shares(self, among: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Shares of the languages of each text, among those allowed to it, and the log
        likelihood of the text. The rounds of a text end when its shares settle, whatever
        other texts run with it."""
        count = len(self.first)
        prior = np.where(among, self.prior, 0)
        prior = prior / prior.sum(axis=1, keepdims=True)
        shares, fit = prior.copy(), np.zeros(count)
        now, going = self, np.arange(count)
        for nth in range(ROUNDS):
            last = nth == ROUNDS - 1
            parts, total = now._expect(shares[going])
            fit[going] = total
            new = (parts + PULL * prior[going]) / (now.sizes[:, None] + PULL)
            settled = np.abs(new - shares[going]).max(axis=1) < SETTLED
            shares[going] = new
            stay = np.flatnonzero(~settled)
            if last or not len(stay):
                break
            now = now.only(stay) if len(stay) < len(going) else now
            going = going[stay]
        return shares, fit + self.floor

    def _expect(self, shares: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Expected units of each language in each text, and the log likelihoods; a slice of
        the units at a time, so that a long text needs no copies of its own size."""
        parts, total = np.zeros(shares.shape), np.zeros(len(shares))
        text = np.repeat(np.arange(len(shares)), self.sizes)
        for low in range(0, len(self.chances), GROUP):
            own = text[low : low + GROUP]
            mixed = self.chances[low : low + GROUP] * shares[own]
            whole = mixed.sum(axis=1)
            cuts = np.flatnonzero(np.diff(own, prepend=-1))
            parts[own[cuts]] += _over_texts(mixed / whole[:, None], cuts)
            total[own[cuts]] += _over_texts(np.log(whole), cuts)
        return parts, total

    def choose(self) -> tuple[np.ndarray, np.ndarray]:
        """Shares of the languages in the set chosen for each text, zero outside it, and how
        surely its first language alone is likelier than any other alone."""
        count, languages = len(self.first), len(self.prior)
        every = np.ones((count, languages), bool)
        order = np.argsort(-self.shares(every)[0], axis=1, kind="stable")
        rank = np.argsort(order, axis=1, kind="stable")
        alone = _over_texts(self.logs.astype(np.float64), self.first) + np.log(self.prior)
        first = order[:, 0]
        behind = alone - alone[np.arange(count), first][:, None]
        sure = 1 / np.exp(np.clip(behind, -700, 700)).sum(axis=1)
        chosen = (rank < 1).astype(np.float64)
        fit = alone[np.arange(count), first] - np.log(self.prior[first])
        going = np.arange(count)
        for size in range(2, languages + 1):
            part = self.only(going)
            shares, found = part.shares(rank[going] < size)
            gain = found - fit[going] > PENALTY * np.log(part.sizes + 1)
            going = going[gain]
            chosen[going], fit[going] = shares[gain], found[gain]
            if not len(going):
                break
        return chosen, sure


# -- tables ------------------------------------------------------------------------


def _parts(batch: pa.RecordBatch) -> Iterator[tuple[list[int], list[str]]]:
    """Lower-cased texts of a batch with their rows; a long text comes in several parts."""
    rows, found, size = [], [], 0
    for row, text in enumerate(batch.column("text").cast(pa.binary())):
        text = (text.as_py() or b"").decode("utf-8", "replace")
        for low in range(0, len(text), PART):
            part = text[low : low + PART].lower()
            if size and size + len(part) > PART:
                yield rows, found
                rows, found, size = [], [], 0
            rows.append(row)
            found.append(part)
            size += len(part)
    if rows:
        yield rows, found


def train(docs: DataFrame) -> Model:
    """The model of all rows of ``docs`` (text, lang) that have a language."""
    rows = docs.select("text", F.col("lang").cast("string").alias("lang")).where("lang IS NOT NULL")
    many = rows.groupBy("lang").count().orderBy("lang").limit(MOST_LANGUAGES + 1).collect()
    if len(many) > MOST_LANGUAGES:
        raise ValueError(f"more than {MOST_LANGUAGES} languages")
    names = [r.lang for r in many]
    number = {name: k for k, name in enumerate(names)}

    def run(batch_of: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(len(names) * BUCKETS, np.int32)
        for batch in batch_of:
            lang = np.array([number[x] for x in batch.column("lang").to_pylist()], np.int64)
            for own, texts in _parts(batch):
                units = Units(texts)
                sizes = np.diff(np.append(units.first, len(units.grams[0])))
                base = np.repeat(lang[np.array(own)[units.text]] * BUCKETS, sizes)
                for gram in units.grams:
                    np.add.at(counts, base + gram, 1)
        key = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays(
            [pa.array(key), pa.array(counts[key].astype(np.int64))], ["key", "n"]
        )

    # Sums of a fixed number of buckets: their number does not grow with the corpus.
    sums = rows.mapInArrow(run, "key long, n long").groupBy("key").agg(F.sum("n").alias("n"))
    counts = np.zeros((len(names), BUCKETS), np.float32)
    for batch in sums.toArrow().to_batches():
        counts.reshape(-1)[batch.column("key").to_numpy()] = batch.column("n").to_numpy()
    learned = np.flatnonzero(counts.any(axis=1))
    share = np.array([r["count"] for r in many], np.float64)[learned]
    return Model([names[k] for k in learned], share / max(share.sum(), 1), counts[learned])


def identify(docs: DataFrame, model: Model) -> DataFrame:
    """(doc_id, text) to (doc_id, lang_pred, score, languages).

    The score is the share of the predicted language times the chance that it is the
    likeliest language alone; ``languages`` is the chosen set, largest share first.
    """
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def results(batch: pa.RecordBatch) -> Iterator[tuple[int, str, float, list]]:
        model, rows, logs, waiting = sent.value, [], [], 0
        for own, texts in _parts(batch) if model.names else ():
            units = Units(texts)
            row = np.array(own)[units.text]
            found = model.log_likelihoods(units)
            lettered = np.unique(np.array(own)[units.lettered])
            keep = np.isin(row, lettered)
            # Units of texts that are whole are ready; the last text may go on.
            if waiting >= GROUP and len(row) and row[0] != rows[-1][-1]:
                yield from mixed(np.concatenate(rows), np.concatenate(logs))
                rows, logs, waiting = [], [], 0
            if keep.any():
                rows.append(row[keep])
                logs.append(found[keep])
                waiting += int(keep.sum())
        if rows:
            yield from mixed(np.concatenate(rows), np.concatenate(logs))

    def mixed(row: np.ndarray, logs: np.ndarray) -> Iterator[tuple[int, str, float, list]]:
        model = sent.value
        first = np.flatnonzero(np.diff(row, prepend=-1))
        chosen, sure = Mixture(logs, first, model.share).choose()
        for at, shares, chance in zip(row[first].tolist(), chosen, sure.tolist(), strict=True):
            inside = [k for k in np.argsort(-shares, kind="stable").tolist() if shares[k] > 0]
            found = [{"lang": model.names[k], "share": float(shares[k])} for k in inside]
            yield at, found[0]["lang"], found[0]["share"] * chance, found

    def run(batch_of: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batch_of:
            names = [UNKNOWN] * batch.num_rows
            scores, sets = [0.0] * batch.num_rows, [[] for _ in names]
            for at, name, score, found in results(batch):
                names[at], scores[at], sets[at] = name, score, found
            kind = pa.list_(pa.struct([("lang", pa.string()), ("share", pa.float64())]))
            arrays = [pa.array(names, pa.string()), pa.array(scores, pa.float64()), pa.array(sets, kind)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), *arrays], ["doc_id", "lang_pred", "score", "languages"]
            )

    docs = docs.select("doc_id", "text")
    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.mapInArrow(run, f"doc_id {kind}, {RESULT}")
