from pyspark.sql import functions as F

from pagequarry.operators import parse
from pagequarry.operators.chat import render_conversations
from pagequarry.operators.concat import ordered_concat

PAGE = """<!DOCTYPE html><html><head><title>T &amp;lt; x</title><style>p{a}</style>
<script>var t="</p><p>no";</script></head><body><!-- <p>no</p> --><ul><li>one<li>two</ul>
<h2>H</h2><p>a <b>bold<br>next<p>b .</p>loose<P CLASS=x>c</P></body></html>"""


def pages(spark, *html):
    rows = [(i, bytearray(h.encode())) for i, h in enumerate(html)]
    return spark.createDataFrame(rows, "doc long, content binary")


def test_html_elements(spark):
    rows = parse.parse_html(pages(spark, PAGE), "doc").orderBy("pos").collect()
    assert [(r.type, r.text) for r in rows] == [
        ("Title", "T &lt; x"),
        ("ListItem", "one"),
        ("ListItem", "two"),
        ("Title", "H"),
        ("NarrativeText", "a bold\nnext"),
        ("NarrativeText", "b ."),
        ("Text", "loose"),
        ("NarrativeText", "c"),
    ]
    assert [r.pos for r in rows] == list(range(8))
    assert {r.page_number for r in rows} == {1}
    assert [r.metadata["tag"] for r in rows] == ["title", "li", "li", "h2", "p", "p", "", "p"]


def test_plain_text_is_one_element_and_empty_is_none(spark):
    rows = parse.parse_html(pages(spark, "just text", "", " \n "), "doc").collect()
    assert [(r.doc, r.type, r.text) for r in rows] == [(0, "Text", "just text")]


def test_html_text(spark):
    text = pages(spark, PAGE).select(parse.html_text(F.col("content"))).first()[0]
    assert text == "T &lt; x\none\ntwo\nH\na boldnext\nb.\nloose\nc"


def test_parser_of_the_caller(spark):
    def parser(document, strategy="auto"):
        first = {"text": document.decode(), "page_number": 3, "metadata": {"strategy": strategy}}
        return [first, {"text": "x", "type": "Title"}] if document else []

    elements = parse.parse_with(parser, F.col("content"), strategy="hi_res")
    rows = parse.element_rows(pages(spark, "abc", ""), elements, "doc").orderBy("pos").collect()
    assert [(r.doc, r.pos, r.type, r.text, r.page_number, r.metadata) for r in rows] == [
        (0, 0, "Text", "abc", 3, {"strategy": "hi_res"}),
        (0, 1, "Title", "x", None, {}),
    ]


def test_page_texts_and_images(spark):
    def parser(document):
        text = document.decode()
        return [{"text": t, "page_number": int(t[0])} for t in text.split("|")]

    docs = pages(spark, "1a .|1b|2c")
    elements = parse.element_rows(docs, parse.parse_with(parser, F.col("content")), "doc")
    rows = parse.page_texts(elements, "doc").collect()
    assert {(r.doc, r.page_number, r.text) for r in rows} == {(0, 1, "1a.\n1b"), (0, 2, "2c")}
    images = spark.createDataFrame([(7, "/i/7.png")], "pdf_page int, page_image_loc string")
    scanned = docs.select(F.lit("/i/7.png").alias("path"), "content")
    row = parse.image_texts(images, scanned, parser).first()
    assert (row.pdf_page, row.text_extract) == (7, "1a .\n1b\n2c")


def test_slice_and_point(spark):
    rows = spark.range(1000).select(F.col("id").alias("pos"))
    assert {r.pos for r in parse.slice_elements(rows, 960, 978).collect()} == set(range(960, 978))
    assert [r.pos for r in parse.element_at(rows, 5).collect()] == [5]


def test_type_counts(spark):
    counts = parse.element_type_counts(parse.parse_html(pages(spark, PAGE), "doc"))
    assert {r.type: r.n for r in counts.collect()} == {
        "Title": 2, "ListItem": 2, "NarrativeText": 3, "Text": 1,
    }


def test_ordered_concat_of_one_long_group(spark):
    rows = spark.range(5000).select(
        F.when(F.col("id") < 3000, 0).otherwise(F.col("id")).alias("g"),
        F.col("id").alias("pos"),
        F.col("id").cast("string").alias("t"),
    )
    joined = ordered_concat(rows.repartition(7), ["g"], "pos", F.col("t"), ",", "text", block=100)
    got = {r.g: r.text for r in joined.collect()}
    assert got[0] == ",".join(map(str, range(3000)))
    assert got[4000] == "4000" and len(got) == 2001


def test_render_conversations(spark):
    rows = [(1, 1, "assistant", "B"), (1, 0, "user", "A"), (2, 0, "system", "C")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    got = {r.conv_id: r.html for r in render_conversations(df).collect()}
    assert got[1].index("A\n") < got[1].index("B\n")
    assert got[1].count("</div>") == 2 and "#e3f6fc" in got[2]


def test_a_turn_without_text_is_an_empty_message(spark):
    rows = [(1, 0, "user", "a"), (1, 1, "assistant", None), (1, 2, "user", "b")]
    df = spark.createDataFrame(rows, "conv_id int, turn int, role string, text string")
    [row] = render_conversations(df).collect()
    assert row.html.count("<div") == 3


def test_texts_by_page_equals_regrouping(spark):
    docs = spark.createDataFrame([(1, [("x .", 2), ("a", 1), ("y", 2)]), (2, [])], "id int, e array<struct<text:string,page_number:int>>")
    elements = F.transform("e", lambda x: F.struct(F.lit("Text").alias("type"), x["text"].alias("text"), x["page_number"].alias("page_number")))
    got = parse.texts_by_page(docs, elements, "id")
    rows = docs.select("id", F.posexplode("e")).select("id", "pos", "col.*")
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, parse.page_texts(rows, "id").collect()))
    assert sorted(map(tuple, got.collect())) == [(1, 1, "a"), (1, 2, "x.\ny")]


def test_control_marks_in_a_page_do_not_split_it(spark):
    df = spark.createDataFrame([("<p>a\u0001b\u0002c</p>",)], "html string")
    [row] = df.select(parse.html_elements(F.col("html")).alias("e")).collect()
    assert [e.text for e in row.e] == ["abc"]
