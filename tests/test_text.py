import pytest
from pyspark.sql import functions as F

from pagequarry.functions import html, text


def one(spark, value, column):
    return spark.createDataFrame([(value,)], "v string").select(column(F.col("v"))).first()[0]


@pytest.mark.parametrize(
    "given, expected",
    [("a\nb  . c .", "ab . c."), ("d .", "d."), ("", ""), ("x\n\ny", "xy"), ("a ..b", "a..b")],
)
def test_clean_section(spark, given, expected):
    assert one(spark, given, text.clean_section) == expected


def test_clean_section_can_keep_words_apart(spark):
    assert one(spark, "a\nb .", lambda c: text.clean_section(c, " ")) == "a b."


def test_join_sections(spark):
    df = spark.createDataFrame([(["a .", "b\nc"],)], "s array<string>")
    assert df.select(text.join_sections(F.col("s"))).first()[0] == "a.\nbc"


def test_guard_agrees_with_strip_on_every_blank_character(spark):
    every = [chr(c) for c in range(1, 0x3100) if not 0xD800 <= c < 0xE000]
    df = spark.createDataFrame([(c,) for c in every], "v string")
    rows = df.select("v", text.is_blank(F.col("v")).alias("b")).collect()
    assert {r.v for r in rows if r.b} == {c for c in every if not c.strip()}


@pytest.mark.parametrize("blank", ["", "   ", "\t\n", " "])
def test_guard_replies_to_blank(spark, blank):
    reply = one(spark, blank, lambda c: text.guarded(c, F.lit("answer")))
    assert reply == "ERROR the question should not be empty"


@pytest.mark.parametrize("asked", [" x ", "​"])
def test_guard_passes_the_rest(spark, asked):
    assert one(spark, asked, lambda c: text.guarded(c, c)) == asked


def test_basename(spark):
    assert one(spark, "http://h/p/x.pdf", text.basename) == "x.pdf"
    assert one(spark, "x.pdf", text.basename) == "x.pdf"


def test_split_items_keeps_empty_pieces(spark):
    assert one(spark, "a\n\nb\n\n", text.split_items) == ["a", "b", ""]


def test_words_are_the_same_in_both_languages(spark):
    given = " a  b c\td\r\ne f "
    assert one(spark, given, text.words) == text.split_words(given)
    assert one(spark, given, text.token_count) == 4


def test_decode(spark):
    df = spark.createDataFrame([(bytearray("é".encode()),)], "b binary")
    assert df.select(text.decode_text(F.col("b"))).first()[0] == "é"


def test_message_html_roles(spark):
    df = spark.createDataFrame([("user", "hi"), ("system", "yo")], "role string, text string")
    user, other = (
        r[0] for r in df.select(html.message_html(F.col("role"), F.col("text"))).collect()
    )
    assert "#c2efff" in user and "hi" in user and "#e3f6fc" in other and "margin-left" in other
    with_avatar = html.message_html(F.col("role"), F.col("text"), "http://x/a.png")
    assert 'src="http://x/a.png"' in df.select(with_avatar).collect()[1][0]


def test_answer_html(spark):
    df = spark.createDataFrame(
        [("a\nb", ["u", "v"]), ("c", [])], "result string, sources array<string>"
    )
    rows = df.select(html.answer_html(F.col("result"), F.col("sources"))).collect()
    assert rows[0][0] == (
        "a<br/>b<br/><br/><br/><strong>Sources:</strong><br/> "
        '<ul><li><a href="u">u</a></li>\n<li><a href="v">v</a></li></ul>'
    )
    assert rows[1][0] == "c"


def test_current_user_and_first_row(spark):
    assert spark.sql("select current_user()").first()[0]


def test_malformed_bytes_do_not_end_a_job(spark):
    rows = [(1, "grün".encode()), (2, "grün".encode("latin-1")), (3, None)]
    df = spark.createDataFrame(rows, "id int, content binary")
    got = {r.id: r.t for r in df.select("id", text.decode_text(F.col("content")).alias("t")).collect()}
    assert got == {1: "grün", 2: "gr�n", 3: None}


def test_character_references(spark):
    cases = {
        "&lt;a&gt; &amp;amp; &#160;&#x27;&mdash;&eacute;&#128512;&#X41;": "<a> &amp;  '—é\U0001f600A",
        "no reference & none": "no reference & none",
        "&nosuch; &#0; &#xD800; &#99999999;": "&nosuch; � � �",
        "": "",
        "&amp;": "&",
    }
    df = spark.createDataFrame([(c,) for c in cases], "t string")
    got = {r.t: r.u for r in df.select("t", text.unescape(F.col("t")).alias("u")).collect()}
    assert got == cases
