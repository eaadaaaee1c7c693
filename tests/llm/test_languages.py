"""Language identification against a plain version, on mixtures, and held out."""

import math
import random
import zlib
from collections import Counter

import duckdb
import numpy as np
import pytest

from pagequarry.llm import languages, queries

SOUNDS = {"aa": "ka mo tu ri sel".split(), "bb": "zhe plo wix gna".split(), "cc": "ño übe çal ka".split()}
END = chr(0x110000 - 1)


def text(rng, lang, words):
    return " ".join("".join(rng.choices(SOUNDS[lang], k=rng.randint(1, 4))) for _ in range(words))


@pytest.fixture(scope="module")
def corpus():
    rng = random.Random(5)
    return [(i, text(rng, lang, rng.randint(1, 60)), lang) for i, lang in enumerate(list(SOUNDS) * 40)]


@pytest.fixture(scope="module")
def model(spark, corpus):
    return languages.train(spark.createDataFrame(corpus, "doc_id long, text string, lang string").repartition(4))


def plain_model(corpus):
    """Counts of characters, pairs and trigrams, without hashing."""
    counts = {lang: [Counter(), Counter(), Counter()] for lang in SOUNDS}
    for _, body, lang in corpus:
        for word in body.split():
            for a, b, c in grams(word):
                counts[lang][0][c] += 1
                counts[lang][1][a, b] += 1
                counts[lang][2][a, b, c] += 1
    return counts


def grams(word):
    chars = [END, END, *word, END]
    return list(zip(chars, chars[1:], chars[2:], strict=False))


def plain_logs(counts, word):
    found = []
    for one, two, three in (counts[lang] for lang in sorted(SOUNDS)):
        total = 0
        for a, b, c in grams(word):
            chance = (one[c] + 0.5) / (sum(one.values()) + 0.5 * languages.SIZES[0])
            total += math.log((three[a, b, c] + languages.BACK * chance) / (two[a, b] + languages.BACK))
        found.append(total)
    return found


def plain_shares(logs, among):
    prior = np.array([1 / 3 if k in among else 0.0 for k in range(3)])
    prior /= prior.sum()
    shares = prior
    for _ in range(languages.ROUNDS):
        mixed = np.exp(logs) * shares
        fit = np.log(mixed.sum(axis=1)).sum()
        new = ((mixed / mixed.sum(axis=1, keepdims=True)).sum(axis=0) + languages.PULL * prior) / (
            len(logs) + languages.PULL
        )
        done = np.abs(new - shares).max() < languages.SETTLED
        shares = new
        if done:
            break
    return shares, fit


def plain_choice(logs):
    order = np.argsort(-plain_shares(logs, {0, 1, 2})[0], kind="stable").tolist()
    best, fit = np.eye(3)[order[0]], logs[:, order[0]].sum()
    for size in (2, 3):
        shares, found = plain_shares(logs, set(order[:size]))
        if found - fit <= languages.PENALTY * math.log(len(logs) + 1):
            break
        best, fit = shares, found
    return best


def test_log_likelihoods_equal_plain_counts(model, corpus):
    counts = plain_model(corpus)
    assert model.names == sorted(SOUNDS)
    for body in ["kamo", "zheplo zhe", "unseenñ", "selkaübe ri"]:
        got = model.log_likelihoods(languages.Units([body]))
        assert np.allclose(got, [plain_logs(counts, w) for w in body.split()], atol=1e-4)


def test_mixtures_equal_plain_rounds(spark, model, corpus):
    rng = random.Random(8)
    counts = plain_model(corpus)
    docs = []
    for i in range(60):
        langs = rng.sample(sorted(SOUNDS), rng.randint(1, 3))
        docs.append((i, " ".join(text(rng, lang, rng.randint(1, 40)) for lang in langs)))
    frame = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    for r in languages.identify(frame, model).collect():
        want = plain_choice(np.array([plain_logs(counts, w) for w in docs[r.doc_id][1].split()]))
        got = {x.lang: x.share for x in r.languages}
        assert {model.names[k] for k in np.flatnonzero(want)} == set(got)
        assert all(abs(got[model.names[k]] - want[k]) < 1e-3 for k in np.flatnonzero(want))
        assert r.lang_pred == r.languages[0].lang and 0 <= r.score <= 1


def test_sets_of_mixed_and_single_texts(spark, model):
    rng = random.Random(9)
    docs = [(0, text(rng, "aa", 300)), (1, text(rng, "aa", 200) + " " + text(rng, "bb", 100))]
    docs += [(2, text(rng, "cc", 100) + "\n" + text(rng, "bb", 20)), (3, text(rng, "bb", 2))]
    got = {r.doc_id: r for r in languages.identify(spark.createDataFrame(docs, "doc_id long, text string"), model).collect()}
    assert [[x.lang for x in got[i].languages] for i in range(4)] == [["aa"], ["aa", "bb"], ["cc", "bb"], ["bb"]]
    assert abs(got[1].languages[0].share - 2 / 3) < 0.05


def test_odd_rows(spark, model):
    rows = [(1, None, 1), (2, "", 1), (3, "12 + 7 = !", 1), (4, "́́", 1), (None, "kamo turi", 1)]
    rows += [(5, "KAMO Turi", 1), (5, "KAMO Turi", 1), (6, "mo" * 1_500_000, 1), (7, "1 " * 1_500_000 + "zheplo", 1)]
    rows += [(8, "漢字" * 5000, 1)]
    got = languages.identify(spark.createDataFrame(rows, "doc_id long, text string, score int").repartition(2), model).collect()
    und = [r for r in got if r.lang_pred == "und"]
    assert sorted(r.doc_id for r in und) == [1, 2, 3, 4]
    assert all(r.score == 0 and r.languages == [] for r in und)
    assert sorted((r.doc_id or 0, r.lang_pred) for r in got if r.doc_id in (None, 5, 6, 7)) == [
        (0, "aa"), (5, "aa"), (5, "aa"), (6, "aa"), (7, "bb")
    ]
    none = spark.createDataFrame([], "doc_id long, text string, lang string")
    assert languages.identify(none, model).collect() == []
    empty = languages.train(none)
    assert {r.lang_pred for r in languages.identify(spark.createDataFrame(rows, "doc_id long, text string, n int"), empty).collect()} == {"und"}
    nulls = spark.createDataFrame([(1, "kamo", None), (2, None, "aa"), (3, "plo", "bb")], "doc_id long, text string, lang string")
    assert languages.train(nulls).names == ["bb"]


def test_long_text_equals_its_parts_read_with_others(spark, model):
    rng = random.Random(10)
    docs = [(i, text(rng, rng.choice(sorted(SOUNDS)), rng.randint(1, 50))) for i in range(50)]
    docs.insert(20, (99, text(rng, "aa", 250_000) + " " + text(rng, "bb", 100_000)))
    together = spark.createDataFrame(docs, "doc_id long, text string").coalesce(1)
    apart = spark.createDataFrame(docs, "doc_id long, text string").repartition(17)
    one, two = ({r.doc_id: r for r in languages.identify(d, model).collect()} for d in (together, apart))
    assert one == two and [x.lang for x in one[99].languages] == ["aa", "bb"]


def test_held_out_accuracy(spark, testdata):
    langs = dict(duckdb.sql(f"SELECT doc_id, lang FROM '{testdata}/documents.parquet'").fetchall())
    got = queries.op11_language(spark, testdata).collect()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in got)
    out = [r.lang_pred == langs[r.doc_id] for r in got if r.held_out]
    assert sum(out) / len(out) > 0.97
