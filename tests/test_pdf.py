"""PDF files: syntax, damage, fonts, layout, and the same texts in two writers' styles."""

import random
import zlib

import pytest
from pyspark.sql import functions as F

from pagequarry.operators import pdf
from pagequarry.operators.parse import element_rows
from pagequarry.pdf import layout, objects, text
from pagequarry.plans import pdf_files

WORDS = "Thè quick — (brown) fox\\ jumps “over” the ) lazy ( dög. é\\051".split()
STYLES = [pdf_files.classic, pdf_files.modern]


def some_words(n, seed=1):
    return random.Random(seed).choices(WORDS, k=n)


def read(data, strategy="fast"):
    return pdf.read_pdf(data, strategy)


def all_words(found):
    return " ".join(e["text"] for e in found).split(" ")


@pytest.mark.parametrize("style", STYLES)
@pytest.mark.parametrize("n", [1, 8, 9, 320, 321, 1500])
def test_round_trip(style, n):
    words = some_words(n)
    found = read(style(pdf_files.plain_sheets(words)))
    assert all_words(found) == words
    assert {e["page_number"] for e in found} == set(range(1, -(-n // 320) + 1))


def test_all_of_unicode_in_two_byte_codes():
    words = ["漢字", "\U0001f600x", "ﬁ", "á", "€", "ж"] * 3
    assert all_words(read(pdf_files.modern(pdf_files.plain_sheets(words)))) == words


@pytest.mark.parametrize("style", STYLES)
def test_columns_and_tables_in_reading_order(style):
    words = some_words(251 * 2 + 130)
    data = style(pdf_files.column_sheets(words))
    found = read(data, "hi_res")
    assert all_words(found) == words
    assert [e["type"] for e in found] == ["Title", "NarrativeText", "NarrativeText", "Table"] * 2 + [
        "Title", "NarrativeText", "NarrativeText"
    ]
    # As drawn, lines of both columns alternate.
    assert all_words(read(data)) != words and sorted(all_words(read(data))) == sorted(words)


@pytest.mark.parametrize("style", STYLES)
def test_every_truncation_and_damage_is_survived(style):
    words = some_words(700)
    data = style(pdf_files.plain_sheets(words))
    for end in range(0, len(data), 53):
        found = read(data[:end], "hi_res")
        assert set(all_words(found)) - {""} <= set(WORDS) | {w for w in all_words(found) if len(w) < 8}
        assert pdf.status(data[:end]) in ("damaged", "not_pdf")
    rng = random.Random(2)
    for _ in range(150):
        broken = bytearray(data)
        for _ in range(rng.randint(1, 30)):
            broken[rng.randrange(len(broken))] = rng.randrange(256)
        read(bytes(broken), "hi_res")
        pdf.status(bytes(broken))


@pytest.mark.parametrize("style", STYLES)
def test_damaged_references_are_searched_for(style):
    words = some_words(700)
    data = style(pdf_files.plain_sheets(words))
    for broken in (data.replace(b"startxref", b"startxxxx"), b"junk\n" + data, data[: data.rfind(b"startxref")]):
        assert all_words(read(broken)) == words
    assert pdf.status(data) == "ok"
    assert pdf.status(data.replace(b"startxref", b"startxxxx")) == "damaged"


def test_encrypted_and_other_files():
    data = pdf_files.classic(pdf_files.plain_sheets(WORDS))
    locked = data.replace(b"/Root 1 0 R", b"/Root 1 0 R /Encrypt 9 0 R")
    assert pdf.status(locked) == "encrypted" and read(locked) == []
    for other in (b"", b"<html>", b"%PDF-", b"%PDF-1.4\n%%EOF", b"\0" * 100):
        assert read(other) == [] and pdf.status(other) in ("not_pdf", "damaged")


def one_page(stream, font=b"<< /Type /Font /Subtype /Type1 /BaseFont /Courier >>", extra=(), page=b""):
    """A file without cross references, found by its objects."""
    bodies = [b"<< /Type /Catalog /Pages 2 0 R >>", b"<< /Type /Pages /Kids [3 0 R] /Count 1 >>"]
    bodies.append(b"<< /Type /Page /Parent 2 0 R /Contents 5 0 R /Resources << /Font << /F1 4 0 R >> /XObject << /X1 6 0 R >> >> " + page + b">>")
    bodies.append(font)
    bodies.append(b"<< /Length %d >> stream\n%s\nendstream" % (len(stream), stream))
    bodies += extra
    return b"%PDF-1.4\n" + b"".join(b"%d 0 obj %s endobj\n" % (k, b) for k, b in enumerate(bodies, 1))


def runs(data):
    document = objects.Document(data)
    return text.Page(document, next(document.pages())).runs


def test_text_operators_place_runs():
    stream = b"""BT /F1 10 Tf 14 TL 1 0 0 1 100 700 Tm (ab) Tj (cd) Tj T* (next) Tj (quote) '
    1 2 (spaced) " 0 Tw 0 Tc 50 Tz (ee) Tj (ff) Tj 100 Tz 5 Ts 0 -20 TD [(x) -500 (y) 100 (z)] TJ ET
    q 2 0 0 2 10 20 cm BT /F1 10 Tf 5 5 Td (twice) Tj ET Q BI /W 1 ID \x00(no)Tj EI BT /F1 8 Tf 1 1 Td (end) Tj ET"""
    got = {r.text: r for r in runs(one_page(stream))}
    assert (got["ab"].x0, got["ab"].x1, got["ab"].y) == (100, 112, 700)
    assert got["cd"].x0 == 112 and (got["next"].x0, got["next"].y) == (100, 686)
    assert got["quote"].y == 672 and got["spaced"].y == 658
    assert got["spaced"].x1 - got["spaced"].x0 == pytest.approx(6 * (6 + 2))
    assert got["ee"].x1 - got["ee"].x0 == pytest.approx(6)
    assert got["x yz"].y == 658 - 20 + 5 and got["x yz"].x1 - got["x yz"].x0 == pytest.approx(18 + 5 - 1)
    assert (got["twice"].x0, got["twice"].y, got["twice"].size) == (20, 40, 20)  # the rise stays
    assert "no" not in got and got["end"].size == 8


def test_forms_turned_pages_and_filters():
    inner = zlib.compress(b"BT /F1 10 Tf 1 0 0 1 0 0 Tm (inside) Tj ET /X1 Do")
    form = b"<< /Type /XObject /Subtype /Form /Matrix [1 0 0 1 50 60] /Filter /FlateDecode /Length %d >> stream\n%s\nendstream" % (len(inner), inner)
    data = one_page(b"q 1 0 0 1 5 5 cm /X1 Do Q", extra=[form])
    found = runs(data)
    assert (found[0].x0, found[0].y, found[0].text) == (55, 65, "inside")
    assert len(found) == text.MOST_FORMS  # a form that draws itself ends
    turned = one_page(b"BT /F1 10 Tf 0 1 -1 0 100 50 Tm (up) Tj ET", page=b"/Rotate 90 /MediaBox [0 0 600 800] ")
    assert runs(turned)[0].x1 - runs(turned)[0].x0 == pytest.approx(12)
    assert objects._ascii85(b"<~87cURD]i,\"Ebo80~>") == b"Hello World!"
    assert objects._run_lengths(bytes([2, 65, 66, 67, 254, 90, 128])) == b"ABCZZZ"


@pytest.mark.parametrize("kind", range(5))
def test_png_rows(kind):
    rng = random.Random(kind)
    rows = [bytes(rng.randrange(256) for _ in range(12)) for _ in range(5)]
    coded, above = b"", bytes(12)
    for row in rows:
        out = []
        for k in range(12):
            a, b, c = (row[k - 3] if k > 2 else 0), above[k], (above[k - 3] if k > 2 else 0)
            p = a + b - c
            best = min([(abs(p - a), 0, a), (abs(p - b), 1, b), (abs(p - c), 2, c)])[2]
            out.append((row[k] - [0, a, b, (a + b) // 2, best][kind]) & 255)
        coded += bytes([kind, *out])
        above = row
    how = {"Predictor": 15, "Colors": 3, "Columns": 4}
    assert objects._unpredict(coded, how) == b"".join(rows)


def test_glyph_names_and_differences():
    names = "eacute Scaron quotedblleft fi uni4E2D u1F600 A.alt zcaron germandbls nothing"
    assert [text.glyph(n) for n in names.split()] == ["é", "Š", "“", "fi", "中", "\U0001f600", "A", "ž", "ß", ""]
    font = b"<< /Type /Font /Subtype /Type1 /BaseFont /X /Encoding << /BaseEncoding /WinAnsiEncoding /Differences [65 /eacute /fi 200 /uni4E2D] >> /FirstChar 65 /Widths [700 800] >>"
    found = runs(one_page(b"BT /F1 10 Tf (AB\\310C\\200) Tj ET", font))
    assert found[0].text == "éfi中C€" and found[0].x1 == pytest.approx(7 + 8 + 5 * 3)


def test_syntax():
    assert objects.parse(b"<< /A#20B [1 -2.5 +3 .5 (x(y)\\n\\101\\\r\n) <4a4B4> null true] >>", 0)[0] == {
        "A B": [1, -2.5, 3, 0.5, b"x(y)\nA", b"JK@", None, True]
    }
    for broken in (b"(", b"<", b"<<", b"[", b"[" * 500):
        with pytest.raises(objects.PdfError):
            objects.parse(broken, 0)


def test_grid_with_spans():
    rules = [text.Rule(*r) for r in [(0, 0, 90, 0), (0, 60, 90, 60), (0, 40, 90, 40), (30, 20, 90, 20)]]
    rules += [text.Rule(*r) for r in [(0, 0, 0, 60), (90, 0, 90, 60), (30, 0, 30, 40), (60, 0, 60, 40)]]
    cells = [("top", 40, 45), ("side", 5, 18), ("a", 35, 25), ("b", 65, 25), ("c & d", 35, 5), ("e", 65, 5)]
    found, rest = layout.tables([text.Run(x, x + 10, y, 8, t) for t, x, y in cells] + [text.Run(0, 9, 200, 8, "out")], rules)
    assert [r.text for r in rest] == ["out"] and found[0].as_html() == (
        '<table><tr><td colspan="3">top</td></tr><tr><td rowspan="2">side</td><td>a</td><td>b</td></tr>'
        "<tr><td>c &amp; d</td><td>e</td></tr></table>"
    )


def test_nested_columns_are_cut_recursively():
    def block(name, x, y, n, wide=80):
        return [text.Run(x, x + wide, y - 12 * k, 10, f"{name}{k}") for k in range(n)]

    drawn = block("h", 0, 500, 1, 300) + block("r", 200, 460, 8) + block("b", 0, 460, 3) + block("d", 0, 380, 3)
    drawn += block("f", 0, 300, 2, 300)
    random.Random(1).shuffle(drawn)
    words = all_words(layout.elements(drawn, [], True))
    want = ["h0", *[f"b{k}" for k in range(3)], *[f"d{k}" for k in range(3)], *[f"r{k}" for k in range(8)], "f0", "f1"]
    assert words == want


def test_columns_of_spark(spark):
    data = pdf_files.modern(pdf_files.column_sheets(some_words(300)))
    rows = [(1, data), (2, None), (3, b""), (4, data[:900]), (5, b"<p>one<p>two"), (6, data.replace(b"%PDF-", b"%XXX-"))]
    docs = spark.createDataFrame(rows, "id long, content binary").repartition(3)
    status = {r.id: r.s for r in docs.select("id", pdf.pdf_status(F.col("content")).alias("s")).collect()}
    assert status == {1: "ok", 2: None, 3: "not_pdf", 4: "damaged", 5: "not_pdf", 6: "not_pdf"}
    found = element_rows(docs, pdf.pdf_elements(F.col("content"), "hi_res"), "id").collect()
    assert [(r.pos, r.type) for r in sorted(found, key=lambda r: r.pos) if r.id == 1][:4] == [
        (0, "Title"), (1, "NarrativeText"), (2, "NarrativeText"), (3, "Table")
    ]
    either = {r.id: r.e for r in docs.select("id", pdf.document_elements(F.col("content"), "hi_res").alias("e")).collect()}
    assert [e.text for e in either[5]] == ["one", "two"] and len(either[1]) == len([r for r in found if r.id == 1])
    with pytest.raises(ValueError):
        pdf.pdf_elements(F.col("content"), "best")
