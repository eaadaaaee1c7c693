"""Operators over texts, each against a plain version of its contract."""

import collections
import hashlib
import math
import random
import re
import zlib

import numpy as np
import pyarrow as pa
import public_tokenizers
import pytest
import tiktoken

from pagequarry.llm import batches, bpe, hmm, imatch, minmax, queries, repeats, sanitise
from pagequarry.llm.decontaminate import contamination, drop_contaminated, item_windows
from pagequarry.llm.grouping import suffix_array
from pagequarry.llm.repeats import remove_repeats

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
WORDS = ["alpha", "Beta", "gamma", "delta", "Épée", "zeta", "eta,", "theta.", "x9", "ü"]
SCHEMA = "doc_id long, text string"


def texts(seed, n=60, most=60, words=WORDS):
    rng = random.Random(seed)
    return [" ".join(rng.choice(words) for _ in range(rng.randint(0, most))) for _ in range(n)]


# Clashing names, a text in two rows, nulls, an empty and a long text.
ODD = [
    (1, "one two three four five six", 7, "a"),
    (1, "one two three four five six", 7, "a"),
    (2, None, None, None),
    (None, "one two three four five six", 1, ""),
    (None, None, 1, ""),
    (3, "", 2, "b"),
    (4, "word " * 30_000, 2, "b"),
    (5, "a" * 30_000, 2, "b"),
    (6, "one two", 2, "b"),
]
ODD_SCHEMA = "doc_id long, text string, n_words long, key string"


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame(ODD, ODD_SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], ODD_SCHEMA)


@pytest.fixture(scope="module")
def encoder():
    content = bpe.read_ranks(public_tokenizers.path(queries.VOCABULARY))
    return bpe.Encoder(bpe.parse_ranks(content), public_tokenizers.PATTERN)


@pytest.fixture(scope="module")
def library(encoder):
    return tiktoken.Encoding(
        "own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=encoder.ranks, special_tokens={}
    )


@pytest.mark.parametrize("letters", ["ab", "aä ", "abcdefgh ", "aaa1 '\n\t", "日本語é漢 x", "\0 !"])
def test_bpe_equals_the_library(encoder, library, letters):
    rng = random.Random(len(letters))
    for size in [0, 1, 2, 7, 30, 100, 400] * 20:
        text = "".join(rng.choice(letters) for _ in range(size))
        ids = np.frombuffer(encoder.encode(text), "<u4").tolist()
        assert ids == library.encode_ordinary(text)
        assert encoder.decode(ids) == text.encode()


def test_round_trip_equals_both_steps(spark, odd, none):
    ranks, pattern = bpe.ship_ranks(spark, public_tokenizers.path(queries.VOCABULARY)), public_tokenizers.PATTERN
    apart = bpe.decode(bpe.encode(odd, ranks, pattern), ranks, pattern).collect()
    whole = bpe.round_trip(odd, ranks, pattern).collect()
    assert sorted(map(tuple, whole), key=str) == sorted(map(tuple, apart), key=str) and len(whole) == len(ODD)
    assert {bytes(r.decoded).decode() for r in whole} == {t or "" for _, t, *_ in ODD}
    assert bpe.round_trip(none, ranks, pattern).collect() == []


@pytest.mark.parametrize("text", ["a" * 9999, "ab" * 5000, "é" * 3000, " " * 3000, "1" * 5000])
def test_bpe_of_long_pieces(encoder, library, text):
    assert np.frombuffer(encoder.encode(text), "<u4").tolist() == library.encode_ordinary(text)


def test_bpe_of_a_text_that_is_cut(encoder, library, monkeypatch):
    monkeypatch.setattr(bpe, "TEXT_BLOCK", 50)
    text = " ".join(texts(3, 40)) + "\n\n  x 12 'll don't  "
    assert np.frombuffer(encoder.encode(text), "<u4").tolist() == library.encode_ordinary(text)


def test_bpe_query_and_odd_rows(odd, none, library):
    path, pattern = public_tokenizers.path(queries.VOCABULARY), public_tokenizers.PATTERN
    rows = queries.token_digests(odd, path, pattern).collect()
    assert len(rows) == len(ODD)
    want = collections.Counter()
    for doc_id, text, *_ in ODD:
        ids = library.encode_ordinary(text or "")
        want[
            doc_id,
            len(ids),
            hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(),
            hashlib.sha256((text or "").encode()).hexdigest(),
        ] += 1
    assert collections.Counter(tuple(r) for r in rows) == want
    assert queries.token_digests(none, path, pattern).count() == 0


WORD = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def plain_contamination(text, items):
    words = WORD.findall((text or "").translate(LOWER).encode())
    hit, found = set(), set()
    for item_id, item in items:
        own = WORD.findall((item or "").translate(LOWER).encode())
        size = min(len(own), 10)
        windows = {tuple(own[i : i + size]) for i in range(len(own) - size + 1)} if own else set()
        for i in range(len(words) - size + 1 if size else 0):
            if tuple(words[i : i + size]) in windows:
                hit.update(range(i, i + size))
                found.add(str(item_id))
    return len(words), len(hit), len(found), ",".join(sorted(found)), bool(hit)


@pytest.mark.parametrize("block_bytes", [16 << 20, 300])
def test_contamination_equals_plain_search(spark, monkeypatch, block_bytes):
    from pagequarry.llm import decontaminate

    monkeypatch.setattr(decontaminate, "BLOCK_BYTES", block_bytes)
    monkeypatch.setattr(decontaminate.window_blocks, "__defaults__", (10, block_bytes))
    rng = random.Random(4)
    few = ["a", "b", "c"]
    items = [(i, " ".join(rng.choice(few) for _ in range(rng.choice([0, 1, 3, 9, 10, 11, 14])))) for i in range(12)]
    items += [(12, None), (13, items[3][1]), (14, "Épée; the END of it all, x1 y2 z3 w4 v5 u6")]
    docs = list(enumerate(texts(5, 50, 80, few) + ["épée the end of it all x1 y2 z3 w4 v5 u6", None, ""]))
    got = contamination(
        spark.createDataFrame(docs, SCHEMA), spark.createDataFrame(items, "item_id long, text string")
    )
    for row in got.collect():
        n, hit, count, ids, dirty = plain_contamination(dict(docs)[row.doc_id], items)
        want = (n, hit, count, hashlib.sha256(ids.encode()).hexdigest(), dirty)
        assert want == tuple(row)[1:6]
        assert ",".join(row["items"]) == ids


def test_contamination_of_odd_rows(spark, odd, none):
    items = spark.createDataFrame([(1, "TWO three", 3)], "item_id long, text string, n_hit int")
    got = {(r.doc_id, r.n_words, r.n_hit) for r in contamination(odd, items).collect()}
    assert (1, 6, 2) in got and (2, 0, 0) in got and (4, 30_000, 0) in got
    assert sorted(drop_contaminated(odd, items).columns) == sorted(odd.columns)
    assert drop_contaminated(odd, items).count() == len(ODD) - 3
    assert contamination(none, items).count() == 0
    assert not any(r.contaminated for r in contamination(odd, items.limit(0)).collect())
    assert item_windows(None) == item_windows("--") == []


def plain_components(docs):
    sets = {}
    for doc_id, text in docs:
        words = (text or "").translate(LOWER).encode().split()
        own = {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()
        sets.setdefault(doc_id, []).append(own)
    root = {i: i for i in sets}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    ids = sorted(sets)
    for i in ids:
        for j in ids:
            if j < i and any(
                x and y and 100 * len(x & y) >= 75 * len(x | y) for x in sets[i] for y in sets[j]
            ):
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    return {i: find(i) for i in ids}


def near_copies(seed, families=12, copies=9):
    rng = random.Random(seed)
    docs = []
    for f in range(families):
        base = [f"w{rng.randint(0, 400)}" for _ in range(rng.randint(3, 90))]
        for _ in range(copies):
            words = list(base)
            for _ in range(rng.randint(0, 3)):
                words[rng.randrange(len(words))] = f"n{rng.randint(0, 9)}"
            docs.append(" ".join(words))
    rng.shuffle(docs)
    return [(7 * i + 3, t) for i, t in enumerate(docs)]


@pytest.mark.parametrize("seed", [1, 2])
def test_components_equal_all_pairs(spark, seed):
    docs = near_copies(seed)
    got = minmax.near_duplicates(spark.createDataFrame(docs, SCHEMA).repartition(3)).collect()
    assert {r.doc_id: r.component_id for r in got} == plain_components(docs)
    assert all(r.kept == (r.doc_id == r.component_id) for r in got)


def test_copies_just_below_the_threshold_are_not_all_compared(spark, monkeypatch):
    # Edits in five places keep about 0.72 of the text; neighbours have one edit in common.
    rng = random.Random(5)
    base = [f"w{i}" for i in range(150)]
    docs, before = [(0, " ".join(base))], 2
    for i in range(1, 141):
        words, places = list(base), rng.sample(range(5, 145, 6), 4)
        for place in places:
            words[place] = f"n{i}x{place}"
        after = rng.choice([p for p in range(2, 145, 6) if p != before])
        words[before], words[after] = f"s{i}", f"s{i + 1}"
        before = after
        docs.append((i, " ".join(words)))
    compared = []
    measured = minmax._measured
    monkeypatch.setattr(
        minmax, "_measured", lambda pairs, sets: compared.append(pairs.count()) or measured(pairs, sets)
    )
    got = minmax.near_duplicates(spark.createDataFrame(docs, SCHEMA)).collect()
    assert {r.doc_id: r.component_id for r in got} == plain_components(docs)
    assert sum(compared) <= 5 * len(docs), compared


def test_components_of_odd_rows(odd, none):
    rows = [tuple(r) for r in minmax.near_duplicates(odd).collect()]
    assert rows.count((1, 2, 1, True)) == 2
    assert (None, 2, 1, False) in rows and (None, 0, None, True) in rows
    assert (2, 0, 2, True) in rows and (3, 0, 3, True) in rows and (6, 1, 6, True) in rows
    assert (4, 1, 4, True) in rows
    assert minmax.near_duplicates(none).count() == 0


def test_chains_are_one_component(spark):
    from pagequarry.llm.components import components

    rng = random.Random(6)
    ids = list(range(300))
    rng.shuffle(ids)
    links = list(zip(ids, ids[1:], strict=False)) + [(1000, 1001), (1002, 1001), (5000, 5000)]
    got = {r.id: r.root for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {i: 0 for i in ids} | {1000: 1000, 1001: 1000, 1002: 1000}


def test_suffix_array_equals_sorting():
    rng = random.Random(8)
    for _ in range(600):
        letters = rng.choice([1, 2, 3, 26])
        text = bytes(rng.randint(1, letters) for _ in range(rng.choice([0, 1, 2, 9, 60])))
        text *= rng.choice([1, 1, 3])
        want = sorted(range(len(text)), key=lambda i: text[i:])
        assert suffix_array(np.frombuffer(text, np.uint8)).tolist() == want


def plain_repeats(docs):
    first, out = {}, {}
    for doc_id, text in sorted(docs, key=lambda d: d[0]):
        raw = (text or "").encode()
        gone = np.zeros(len(raw), bool)
        for i in range(len(raw) - 99):
            window = raw[i : i + 100]
            if first.setdefault(window, (doc_id, i)) != (doc_id, i):
                gone[i : i + 100] = True
        kept = np.frombuffer(raw, np.uint8)[~gone].tobytes()
        spans = int((np.diff(gone.astype(int), prepend=0) == 1).sum())
        out[doc_id] = (len(raw), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest())
    return out


def test_repeats_of_many_rows_of_one_id(spark):
    """Rows without an id are told apart however many there are."""
    passage = "".join(random.Random(7).choices("abcdefgh ", k=180))
    rows = [(f"{i:010d}" * 11, i) for i in range(24_000)]
    rows += [(f"{i:07d}"[: i % 7] + passage + f"{i:09d}", i) for i in range(2_000)]
    starts = {}
    for text, _ in rows:
        for i in range(len(text) - 99):
            window = text[i : i + 100]
            starts[window] = min(starts.get(window, i), i)
    want = collections.Counter()
    for text, _ in rows:
        gone = np.zeros(len(text), bool)
        for i in range(len(text) - 99):
            if starts[text[i : i + 100]] < i:
                gone[i : i + 100] = True
        kept = "".join(c for c, g in zip(text, gone.tolist(), strict=True) if not g)
        want[len(text), int(gone.sum()), hashlib.sha256(kept.encode()).hexdigest()] += 1
    frame = spark.createDataFrame([(None, t) for t, _ in rows], SCHEMA).repartition(4)
    got = remove_repeats(frame, with_kept=False)
    assert collections.Counter((r.n_bytes, r.n_removed, r.kept_sha256) for r in got.collect()) == want


def passages(seed, n=120):
    rng = random.Random(seed)
    known = ["".join(rng.choice("abcdef gh\n") for _ in range(rng.randint(60, 400))) for _ in range(9)]
    docs = []
    for i in range(n):
        text = ""
        for _ in range(rng.randint(0, 6)):
            kind = rng.random()
            if kind < 0.4:
                text += "".join(rng.choice("abcdefghijé \n\0") for _ in range(rng.randint(0, 200)))
            elif kind < 0.7:
                text += rng.choice(known)
            elif kind < 0.9:
                passage = list(rng.choice(known))
                passage[rng.randrange(len(passage))] = "Z"
                text += "".join(passage)
            else:
                text += rng.choice(["a", "ab", "xyz"]) * rng.randint(1, 200)
        docs.append((3 * i, text))
    return docs


@pytest.mark.parametrize("seed", [1, 2])
def test_repeats_equal_plain_windows(spark, seed):
    docs = passages(seed)
    got = remove_repeats(spark.createDataFrame(docs, SCHEMA).repartition(4)).collect()
    want = plain_repeats(docs)
    for r in got:
        assert (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) == want[r.doc_id]
        assert hashlib.sha256(r.kept).hexdigest() == r.kept_sha256
        assert sum(b - a for a, b in zip(r.spans[::2], r.spans[1::2], strict=True)) == r.n_removed


def test_long_texts_are_read_in_parts(monkeypatch):
    text = "".join(t for _, t in passages(3, 8))
    batch = pa.RecordBatch.from_pydict({"text": [text]})

    def runs():
        out = set()
        for data, texts, rows, offset in repeats._parts(batch):
            for owner, start, count, *_ in zip(*repeats.halves(data, texts), strict=True):
                for k in range(count):
                    out.add((rows[owner], offset[owner] + start - texts[owner] + k))
        return out

    whole = runs()
    assert whole == {(0, i) for i in range(len(text.encode()) - 99)}
    monkeypatch.setattr(repeats, "LONG", 500)
    assert runs() == whole


def test_pieces_that_share_no_window():
    for pieces in ([], [b"x" * 99], [b"a" * 120, b"b" * 120]):
        at = np.zeros(len(pieces), np.int64)
        piece, window = repeats.shared_windows(pieces, np.arange(len(pieces)), at)
        # Of a run of one letter every window but the first starts earlier too.
        assert len(piece) == len(window) == sum(max(len(p) - 100, 0) for p in pieces)


def test_repeats_of_odd_rows(spark, odd, none):
    rows = [(r.doc_id, r.n_bytes, r.n_removed) for r in remove_repeats(odd).collect()]
    assert sorted(rows, key=str) == sorted(
        [(1, 27, 0), (1, 27, 0), (2, 0, 0), (None, 27, 0), (None, 0, 0), (3, 0, 0),
         (4, 150_000, 149_995), (5, 30_000, 29_999), (6, 7, 0)], key=str,
    )
    assert remove_repeats(none).count() == 0
    twice = spark.createDataFrame([(9, "q" * 50 + "w" * 60)] * 2 + [(10, "q" * 50 + "w" * 60)], SCHEMA)
    assert sorted((r.doc_id, r.n_removed) for r in remove_repeats(twice).collect()) == [
        (9, 0), (9, 0), (10, 110),
    ]


KINDS = (
    r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    r"[0-9]([\x20-]?[0-9])+",
    r"\+[0-9][\x20().0-9-]+[0-9]",
)


def plain_entities(text):
    def digits(s):
        return [int(c) for c in s if c in "0123456789"]

    def luhn(s):
        return sum(d if i % 2 == 0 else (2 * d - 9 if d > 4 else 2 * d) for i, d in enumerate(digits(s)[::-1])) % 10 == 0

    valid = (
        lambda s: True,
        lambda s: all(int(p) <= 255 for p in s.split(".")),
        lambda s: 13 <= len(digits(s)) <= 19 and luhn(s),
        lambda s: 9 <= len(digits(s)) <= 15,
    )
    return [
        (k, *m.span())
        for k, pattern in enumerate(KINDS)
        for m in re.finditer(pattern, text)
        if valid[k](m[0])
    ]


def test_entities_equal_the_patterns(spark):
    rng = random.Random(5)
    parts = ["1", "2", "30", "255", "256", "0", ".", ".", "@", "a", "b.c", "-", " ", "+", "(", ")", "é", "_"]
    parts += ["%", "x@y.z", "+1 (386) 555-3733", "4111 1111 1111 1111", "4041894974608795", "10.0.0.1", "🎈", "\n"]
    docs = ["".join(rng.choice(parts) for _ in range(rng.choice([3, 8, 20, 60]))) for _ in range(1500)]
    docs += ["", None, "a" * 5000 + "@b.c", "1" * 5000, "1.2.3.4.5.6.7.8", "a@b.c_d@e.f", "0001.002.3.0255"]
    found = sanitise.find(spark.createDataFrame(list(enumerate(docs)), SCHEMA)).collect()
    assert len(found) == len(docs)
    for r in found:
        assert [(x.k, x.s, x.e) for x in r.found] == plain_entities(docs[r.row.doc_id] or "")


def test_words_that_give_an_entity_away(spark):
    docs = [(i, f"Some filler text {i} then Zorblax wrote to q@x.io about it") for i in range(4)]
    docs += [(i, f"Some filler text {i} then nobody wrote about it") for i in range(4, 60)]
    rows = {r.doc_id: r for r in sanitise.sanitise(spark.createDataFrame(docs, SCHEMA)).collect()}
    assert rows[0].text == "Some filler text 0 then [TERM] wrote [TERM] [EMAIL] about it"
    assert all(rows[i].text == t for i, t in docs[4:])


def test_words_far_off_give_a_class_of_values_away(spark):
    """No value occurs twice, and the words stand far from the entity, or without one."""
    far = " ".join(["filler"] * 40)
    docs = [(i, f"Quorvex {far} mail u{i}@corp.io {far} quorvex {i}") for i in range(5)]
    docs += [(i, f"call Brindle {far} +49 (30) 5550 00{i}") for i in range(5, 10)]
    docs += [(10, f"{far} QUORVEX alone")]
    docs += [(i, f"mail and call {far} {i}") for i in range(11, 80)]
    rows = {r.doc_id: r for r in sanitise.sanitise(spark.createDataFrame(docs, SCHEMA)).collect()}
    assert rows[0].text == f"[TERM] {far} mail [EMAIL] {far} [TERM] 0"
    assert rows[5].text == f"call [TERM] {far} [PHONE]"
    assert rows[10].text == f"{far} [TERM] alone"
    assert all(rows[i].text == t for i, t in docs[11:])


def test_sanitising_odd_rows(odd, none):
    clean = sanitise.sanitise(odd)
    assert clean.columns == odd.columns
    assert sorted(map(tuple, clean.collect()), key=str) == sorted(ODD, key=str)
    assert sanitise.sanitise(none).count() == 0


def test_edits_and_likeness(spark):
    docs = [(3 * i, t) for i, t in enumerate(texts(9, 80, 90, [f"w{i}" for i in range(300)]))]
    docs += [(1000, docs[5][1]), (1001, None)]
    rows = imatch.fingerprints(spark.createDataFrame(docs, SCHEMA).repartition(3)).selectExpr(
        "*", f"{imatch.likeness('print', 'edited_print')} AS near"
    ).collect()
    falling = [t or "" for _, t in sorted(docs, reverse=True)]
    want = {
        i: a[: len(a) - len(a) // 3] + b[: len(a) // 3]
        for (i, _), a, b in zip(sorted(docs, reverse=True), falling, falling[1:] + falling[:1], strict=True)
    }
    assert {r.doc_id: r.edited for r in rows} == want
    by_id = {r.doc_id: r for r in rows}
    assert by_id[1000].print == by_id[15].print
    assert all(r.near == 1 for r in rows if r.body == r.edited and r.near is not None)
    order = [i for i, _ in sorted(docs, reverse=True)]
    for a, b in zip(order, order[1:] + order[:1], strict=True):
        assert by_id[a].next_print == by_id[b].print


@pytest.mark.parametrize("edits", [0, 3])
def test_a_third_of_the_rows_are_copies(spark, edits):
    rng = random.Random(edits)
    own = [f"own{i}" for i in range(60)]
    docs = []
    for i in range(300):
        if i % 3:
            words = rng.sample([f"w{k}" for k in range(900)], 60)
        else:
            words = list(own)
            for k in rng.sample(range(60), edits):
                words[k] = f"w{rng.randrange(900)}"
        docs.append((i, " ".join([*words, "the"])))
    frame = spark.createDataFrame(docs, SCHEMA).repartition(3)
    found = {r.term for r in imatch.lexicon(frame.select("text")).collect()}
    assert set(own) <= found and "the" not in found
    rows = imatch.fingerprints(frame).selectExpr(
        "*", f"{imatch.likeness('print', 'edited_print')} AS near"
    ).collect()
    copies = [r for r in rows if r.doc_id % 3 == 0]
    assert all(any(p is not None for p in r.print) for r in copies)
    assert sum(r.near > 0 for r in copies) > 0.9 * len(copies)


def test_fingerprints_of_odd_rows(odd, none):
    rows = imatch.fingerprints(odd).collect()
    assert len(rows) == len(ODD)
    assert len({tuple(r.print) for r in rows if r.body.startswith("one two three")}) == 1
    assert imatch.fingerprints(none).count() == 0


def plain_scores(docs, train):
    tokens = {i: (t or "").translate(LOWER).encode().split() + [b"\n"] for i, t in docs}
    counts = collections.Counter(w for i in tokens if train[i] for w in tokens[i])
    total = sum(counts.values()) + 0.5 * (len(counts) + 1)
    return {
        i: (len(w), sum(x in counts for x in w), sum(math.log10((counts[x] + 0.5) / total) for x in w))
        for i, w in tokens.items()
    }


def hashed(word):
    data = np.frombuffer(word, np.uint8)
    start, end = np.array([0]), np.array([len(word)])
    return batches.span_hash(batches.prefix_sums(data), start, end), data, start, end


def test_base_scores_and_forward_recursion(spark, monkeypatch):
    for name, value in (("LISTED", 6), ("OWN_CLASS", 3)):
        monkeypatch.setattr(hmm, name, value)
    docs = list(enumerate(texts(11, 60, 30, [*WORDS, *(f"r{i}" for i in range(40))]) + [None, ""]))
    train = {i: zlib.crc32(str(i).encode()) % 5 != 1 for i, _ in docs}
    rows = spark.createDataFrame([(i, train[i], t) for i, t in docs], "doc_id long, train boolean, text string")
    model, read = hmm.train(rows, states=3, rounds=3)
    want = plain_scores(docs, train)
    counts, room = {bytes(r.word): r.c for r in model.counts.collect()}, model.lexicon.room()
    kinds = {r.doc_id: np.frombuffer(r.classes, "<u2") for r in read.collect()}
    got = {r.doc_id: r for r in hmm.score(read, model).collect()}
    for i, r in got.items():
        assert (r.n_tokens, r.n_known) == want[i][:2]
        assert r.base_score == pytest.approx(want[i][2])
        # The recursion over all paths, unscaled, for the classes.
        s = model.states
        ahead = s.start * s.emit[:, kinds[i][0]]
        for k in kinds[i][1:]:
            ahead = (ahead @ s.move) * s.emit[:, k]
        inside = 0.0
        for word in (dict(docs)[i] or "").translate(LOWER).encode().split():
            place, kind = model.lexicon.look_up(*hashed(word))
            if kind[0] > model.lexicon.own:
                inside += math.log10((counts.get(word, 0) + 0.5) / room[kind[0]])
        assert r.score == pytest.approx(math.log10(ahead.sum()) + inside)
    assert model.states.emit.sum(axis=1) == pytest.approx(1)
    assert model.states.move.sum(axis=1) == pytest.approx(1)


def test_words_of_a_class_share_its_mass(spark):
    docs = [(i, True, t) for i, t in enumerate(texts(12, 40))]
    model, _ = hmm.train(spark.createDataFrame(docs, "doc_id long, train boolean, text string"), 2, 1)
    lexicon, counts = model.lexicon, {bytes(r.word): r.c for r in model.counts.collect()}
    assert sum(counts.values()) == lexicon.tokens and len(counts) == lexicon.distinct
    assert lexicon.class_tokens.sum() == lexicon.tokens
    assert lexicon.class_words.sum() == lexicon.distinct


def test_baum_welch_raises_the_likelihood(spark):
    rng = random.Random(13)
    kinds = (["north", "cold", "snow"], ["south", "warm", "sand"])
    docs = [(i, True, " ".join(rng.choices(kinds[i % 2], k=40))) for i in range(60)]
    rows = spark.createDataFrame(docs, "doc_id long, train boolean, text string")
    scores = []
    for rounds in (0, 2, 6):
        model, read = hmm.train(rows, states=2, rounds=rounds)
        scores.append(sum(r.score for r in hmm.score(read, model).collect()))
    assert scores[0] < scores[1] <= scores[2] + 1e-6
    base = sum(r.base_score for r in hmm.score(read, model).collect())
    assert scores[2] > base + 300


def test_scores_of_odd_rows(odd, none):
    from pyspark.sql import functions as F

    model, read = hmm.train(odd.withColumn("train", F.lit(True)), 2, 1)
    rows = hmm.score(read, model).collect()
    assert len(rows) == len(ODD) and all(math.isfinite(r.score) for r in rows)
    assert [r.n_tokens for r in rows if r.doc_id in (2, 3)] == [1, 1]
    model, read = hmm.train(odd.withColumn("train", F.lit(False)), 2, 1)
    assert all(math.isfinite(r.score) and r.n_known == 0 for r in hmm.score(read, model).collect())
    model, read = hmm.train(none.withColumn("train", F.lit(True)), 2, 1)
    assert hmm.score(read, model).count() == 0
