"""Archives, page text and toxicity."""

import hashlib
import random

import numpy as np
import pytest

from pagequarry.llm import toxicity, warc, wrappers
from pagequarry.scratch import scratch_path

PAGES = "page_id long, url string, html string, uri string, plan string"


def archived(spark, pages, least=100):
    path = scratch_path(spark, "archives")
    warc.write_archives(pages, path, least)
    read = warc.read_archives(spark, path)
    return read, warc.resolve_revisits(read)


def odd_pages():
    record = "WARC/1.1\r\nWARC-Type: response\r\nContent-Length: 3\r\n\r\nabc\r\n\r\n"
    same = "same payload " * 20
    rows = [(5, "http://a/5", same), (3, "http://a/3", same), (9, "http://b/9", same)]
    rows += [(1, "http://a/1\r\nX-Page-Id: 7", record * 4), (2, None, None), (4, "", "short"), (6, "x", "short")]
    rows += [(8, "http://a/8", "grün 🎈" * 5000), (None, "n", same), (3, "http://a/3", same)]
    return [(*r, "u", "p") for r in rows]


def test_archives_and_revisits(spark):
    rows = odd_pages()
    read, got = archived(spark, spark.createDataFrame(rows, PAGES).repartition(3))
    want = []
    for page_id, _, html, *_ in rows:
        raw = (html or "").encode()
        ids = [i for i, _, h, *_ in rows if h == html and i is not None]
        again = len(raw) >= 100 and page_id != min(ids)
        kind, refers = ("revisit", min(ids)) if again else ("response", None)
        want.append((page_id, len(raw), hashlib.sha256(raw).hexdigest(), kind, refers))
    assert sorted(map(tuple, got.collect()), key=str) == sorted(want, key=str)
    assert got.columns == ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    payloads = {r.page_id: bytes(r.payload) for r in read.collect() if r.record_type == "response"}
    assert payloads[8] == ("grün 🎈" * 5000).encode() and payloads[1].startswith(b"WARC/1.1")
    assert all(not r.payload for r in read.collect() if r.record_type == "revisit")


def test_archives_of_no_pages(spark):
    _, got = archived(spark, spark.createDataFrame([], PAGES))
    assert got.count() == 0


PAGE = (
    '<!DOCTYPE html><html><head><title>T</title><style>p{{}}</style><script>var a="</p>";</script></head>'
    '<body class="has-sidebar"><header><h1>Site</h1></header><div class="menu">m</div><div class="content">'
    "<article><header><h1>T &amp; x {0}</h1></header><p>a<b>b</b> c<br>d<p>e&nbsp;f {0}<ul><li>x<li>y</ul>"
    "<aside>no</aside><form>q</form><!-- c --><section id=comments><p>c1</p></section></article>"
    '<article class="comment">bad</article></div><div class="cookie-notice">ok?</div><footer>f</footer>'
)


def test_text_of_an_article():
    assert wrappers.extract(PAGE.format(1), None) == "T & x 1\nab c d\ne f 1\nx\ny"
    assert wrappers.extract(None, None) == wrappers.extract("", None) == ""
    assert wrappers.extract("<p>one</p>two<div class='ad'>x</div><p>three &lt;4", None) == "one\ntwo\nthree <4"


def test_names_of_blocks_are_judged_as_wholes():
    keep = ['<div class="product-alert-details">a</div>', '<div class="related-work">b</div>']
    keep += ['<section id="search-algorithms">c</section>']
    drop = ['<div class="related-posts">x</div>', '<div id="cookieNotice">x</div>', '<div class="ad">x</div>']
    drop += ['<div class="lead ad-slot-2">x</div>', '<ul class="social share"><li>x</ul>', "<div class=sidebar>x</div>"]
    page = f"<body><article><h1>t</h1>{''.join(keep + drop)}<p>end</article>"
    assert wrappers.extract(page, None) == "t\na\nb\nc\nend"


def test_wrappers_are_expressions_without_unions():
    a = wrappers.expression(wrappers.parse("<div><p>x</p><p>y</p><h2>s</h2></div>"))
    b = wrappers.expression(wrappers.parse("<div><p>z</p><img><h2>s</h2></div>"))
    both = wrappers.as_expression(wrappers._merge(a, b))
    assert both == "<#root><div>(<p>#</p>)+(<img></img>)?<h2>s</h2></div></#root>"


def test_frame_without_marks_is_found_by_its_sameness(spark):
    page = "<html><body><div>Welcome to the site</div><div><p>story {0}</p><p>more {0}</p></div><div>bye</div>"
    rows = [(i, f"http://h.example/{i}", page.format(i), "u", "p") for i in range(6)]
    rows += [(i, f"http://other.example/{i}", PAGE.format(i), "u", "p") for i in range(10, 13)]
    rows += [(20, None, None, "u", "p"), (21, "no host", "<p>alone", "u", "p"), (21, "no host", "<p>alone", "u", "p")]
    got = wrappers.main_text(spark.createDataFrame(rows, PAGES).repartition(4)).collect()
    assert len(got) == len(rows)
    texts = {r.page_id: r.text for r in got}
    assert all(texts[i] == f"story {i}\nmore {i}" for i in range(6))
    assert texts[11] == "T & x 11\nab c d\ne f 11\nx\ny"
    assert texts[20] == "" and texts[21] == "alone"
    assert all(r.n_chars == len(r.text) for r in got)
    assert wrappers.main_text(spark.createDataFrame([], PAGES)).count() == 0


@pytest.mark.parametrize("page", ["<" * 3000, "<div>" * 5000 + "x", "<p " * 2000, "</p>" * 2000, "a" * 100_000, "<p title='" + "x" * 50_000])
def test_hard_pages_end(page):
    wrappers.extract(page, None)
    wrappers.expression(wrappers._flat(wrappers.parse(page)))


def plain_kernel(a, b):
    def weights(word):
        code, out, norm = toxicity.codes(word), {}, 0.0
        for i in range(len(code)):
            for j in range(i + 1, len(code)):
                for k in range(j + 1, min(len(code), i + toxicity.REACH)):
                    w = toxicity.STRETCH ** (k - i + 1)
                    out[code[i], code[j], code[k]] = out.get((code[i], code[j], code[k]), 0) + w
                    norm += w * w
        return {c: w / norm**0.5 for c, w in out.items()}

    x, y = weights(a), weights(b)
    return sum(w * y.get(c, 0) for c, w in x.items())


def test_kernel_equals_its_definition():
    words = ["idiot", "idxiot", "grün", "aaaa", "ab", "abc", "worthless", "wörthless9"]
    got = toxicity.kernel(words, words[2:])
    for i, a in enumerate(words):
        for j, b in enumerate(words[2:]):
            assert got[i, j] == pytest.approx(plain_kernel(a, b), abs=1e-5)


def labelled(n=240, seed=3):
    rng = random.Random(seed)
    clean = ["the", "house", "stands", "near", "river", "and", "people", "walk", "there", "idea", "moral"]
    bad = ["zorgblat", "kwimpel"]
    rows = []
    for i in range(n):
        words = rng.choices(clean, k=rng.randint(3, 40))
        toxic = int(i % 4 == 0)
        if toxic:
            word = rng.choice(bad)
            word = rng.choice([word, word + "s", word[:4] + "x" + word[4:], ".".join(word), " ".join(word), word.upper()])
            words.insert(rng.randrange(len(words)), word)
        rows.append((i, " ".join(words) + ".", toxic))
    return rows


@pytest.fixture(scope="module")
def model(spark):
    rows = labelled()
    docs = spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string")
    labels = spark.createDataFrame([(i, t) for i, _, t in rows], "doc_id long, toxic long")
    return toxicity.train(docs, labels)


def test_insults_with_gaps_are_found(spark, model):
    rows = labelled(200, 4)
    docs = spark.createDataFrame([(i, t, 1.0) for i, t, _ in rows], "doc_id long, text string, score double")
    got = {r.doc_id: r.score for r in toxicity.score(docs, model).collect()}
    right = np.mean([(got[i] >= 0.5) == bool(t) for i, _, t in rows])
    assert right > 0.95
    kept = toxicity.drop_toxic(docs, model)
    assert kept.columns == docs.columns
    assert {r.doc_id for r in kept.collect()} == {i for i, s in got.items() if s < 0.5}


def test_scores_of_odd_texts(spark, model):
    rows = [(1, None), (None, ""), (2, "a" * 50_000), (2, "a" * 50_000), (3, "x " * 50_000), (4, "!!! ...")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = toxicity.score(docs, model).collect()
    assert len(got) == 6 and all(0 <= r.score <= 1 for r in got)
    assert toxicity.score(docs.limit(0), model).count() == 0


def test_labels_of_one_class_give_a_constant(spark):
    docs = spark.createDataFrame([(1, "a b"), (2, "c d")], "doc_id long, text string")
    for labels in ([], [(1, 0), (2, None)], [(1, 1), (7, 0)]):
        made = toxicity.train(docs, spark.createDataFrame(labels, "doc_id long, toxic int"))
        assert len({r.score for r in toxicity.score(docs, made).collect()}) == 1


def test_wide_nodes_are_aligned_by_the_longest_common_row():
    def longest(a, b):
        best = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
        for i in range(len(a) - 1, -1, -1):
            for j in range(len(b) - 1, -1, -1):
                same = a[i] == b[j]
                best[i][j] = best[i + 1][j + 1] + 1 if same else max(best[i + 1][j], best[i][j + 1])
        pairs, i, j = [], 0, 0
        while i < len(a) and j < len(b):
            if a[i] == b[j]:
                pairs.append((i, j))
                i, j = i + 1, j + 1
            elif best[i + 1][j] >= best[i][j + 1]:
                i += 1
            else:
                j += 1
        return pairs

    rng = random.Random(3)
    for wide in [0, 1, 2, 3, 7, 30, 120] * 6:
        a = [rng.choice("abcdef") for _ in range(wide)]
        b = [rng.choice("abcdefg") for _ in range(rng.randrange(wide + 2))]
        assert wrappers._common(a, b) == longest(a, b)
    # One pass took the first equal kind: the last of b here, and nothing after it.
    names = [f"k{i}" for i in range(500)]
    assert wrappers._common(["end", *names], [*names, "end"]) == [(i + 1, i) for i in range(500)]

    def node(kind):
        made = [None] * (max(wrappers.KIND, wrappers.OPTIONAL, wrappers.REPEATED, wrappers.PAGES, wrappers.TEXT, wrappers.SIZE, wrappers.CHILDREN) + 1)
        made[wrappers.KIND], made[wrappers.TEXT], made[wrappers.CHILDREN] = kind, "", []
        for at in (wrappers.OPTIONAL, wrappers.REPEATED, wrappers.PAGES, wrappers.SIZE):
            made[at] = 0
        return made

    merged = wrappers._align([node(k) for k in ["end", *names]], [node(k) for k in [*names, "end"]])
    assert [(n[wrappers.KIND], n[wrappers.OPTIONAL]) for n in merged] == [("end", 1), *((k, 0) for k in names), ("end", 1)]
