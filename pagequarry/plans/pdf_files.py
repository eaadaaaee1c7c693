"""PDF files in the style of two kinds of writers, for queries that read them back.

``classic`` files have a table of cross references, one-byte codes and plain streams;
``modern`` ones have object streams, cross references in a compressed stream, two-byte codes
with a map to Unicode, and gaps instead of spaces.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from typing import NamedTuple

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

WIDTH = 0.6  # of a character, in font sizes
MARGIN = 40.0


class Text(NamedTuple):
    x: float
    y: float
    size: float
    text: str


class Sheet(NamedTuple):
    """What is drawn on a page: texts, and lines (x0, y0, x1, y1)."""

    wide: float
    high: float
    texts: list[Text]
    lines: list[tuple[float, float, float, float]]


def _escaped(raw: bytes) -> bytes:
    for old in (b"\\", b"(", b")"):
        raw = raw.replace(old, b"\\" + old)
    return raw.replace(b"\r", b"\\r").replace(b"\n", b"\\n")


def _strokes(sheet: Sheet) -> bytes:
    return b"".join(b"%.2f %.2f m %.2f %.2f l S\n" % line for line in sheet.lines)


def classic(sheets: list[Sheet]) -> bytes:
    kids = b" ".join(b"%d 0 R" % (4 + 2 * k) for k in range(len(sheets)))
    objects = [
        b"<< /Type /Catalog /Pages 2 0 R >>",
        b"<< /Type /Pages /Count %d /Kids [%s] /Resources << /Font << /F1 3 0 R >> >> >>"
        % (len(sheets), kids),
        b"<< /Type /Font /Subtype /Type1 /BaseFont /Courier /Encoding /WinAnsiEncoding >>",
    ]
    for k, sheet in enumerate(sheets):
        drawn, x, y, size = [b"BT"], 0.0, 0.0, 0.0
        for t in sheet.texts:
            if t.size != size:
                size = t.size
                drawn.append(b"/F1 %.2f Tf" % size)
            drawn.append(b"%.2f %.2f Td (%s) Tj" % (t.x - x, t.y - y, _escaped(t.text.encode("cp1252"))))
            x, y = t.x, t.y
        stream = b"\n".join([*drawn, b"ET"]) + b"\n" + _strokes(sheet)
        objects.append(
            b"<< /Type /Page /Parent 2 0 R /MediaBox [0 0 %.2f %.2f] /Contents %d 0 R >>"
            % (sheet.wide, sheet.high, 5 + 2 * k)
        )
        objects.append(b"<< /Length %d >>\nstream\n%s\nendstream" % (len(stream), stream))
    out, places = bytearray(b"%PDF-1.4\n%\xe2\xe3\xcf\xd3\n"), []
    for k, body in enumerate(objects, 1):
        places.append(len(out))
        out += b"%d 0 obj\n%s\nendobj\n" % (k, body)
    start = len(out)
    out += b"xref\n0 %d\n0000000000 65535 f \n" % (len(objects) + 1)
    out += b"".join(b"%010d 00000 n \n" % p for p in places)
    out += b"trailer\n<< /Size %d /Root 1 0 R >>\nstartxref\n%d\n%%%%EOF\n" % (len(objects) + 1, start)
    return bytes(out)


def _packed(head: bytes, data: bytes) -> bytes:
    data = zlib.compress(data)
    return b"<< %s /Filter /FlateDecode /Length %d >>\nstream\n%s\nendstream" % (head, len(data), data)


def _to_unicode(codes: dict[str, int]) -> bytes:
    out = [b"1 begincodespacerange <0000> <FFFF> endcodespacerange"]
    out.append(b"1 beginbfrange <0001> <005F> <0020> endbfrange")
    other = [(c, n) for c, n in codes.items() if n > 95]
    for at in range(0, len(other), 100):
        part = other[at : at + 100]
        rows = b"\n".join(
            b"<%04X> <%s>" % (n, c.encode("utf-16-be").hex().upper().encode()) for c, n in part
        )
        out.append(b"%d beginbfchar\n%s\nendbfchar" % (len(part), rows))
    return b"\n".join(out)


def modern(sheets: list[Sheet]) -> bytes:
    # Codes 1 to 95 are those of ASCII, the rest are dealt out as characters come.
    codes = {chr(31 + n): n for n in range(1, 96)}
    for sheet in sheets:
        for t in sheet.texts:
            for c in t.text:
                codes.setdefault(c, len(codes) + 1)
    kids = b" ".join(b"%d 0 R" % (7 + 2 * k) for k in range(len(sheets)))
    inside = {
        1: b"<< /Type /Catalog /Pages 2 0 R >>",
        2: b"<< /Type /Pages /Count %d /Kids [%s] >>" % (len(sheets), kids),
        3: b"<< /Type /Font /Subtype /Type0 /BaseFont /Own /Encoding /Identity-H"
        b" /DescendantFonts [4 0 R] /ToUnicode 5 0 R >>",
        4: b"<< /Type /Font /Subtype /CIDFontType2 /BaseFont /Own /DW 600 >>",
    }
    streams = {5: _packed(b"", _to_unicode(codes))}
    for k, sheet in enumerate(sheets):
        inside[7 + 2 * k] = (
            b"<< /Type /Page /Parent 2 0 R /MediaBox [0 0 %.2f %.2f] /Contents %d 0 R"
            b" /Resources << /Font << /F1 3 0 R >> >> >>" % (sheet.wide, sheet.high, 8 + 2 * k)
        )
        drawn = [b"q"]
        for t in sheet.texts:
            words = [
                b"<%s>" % b"".join(b"%04X" % codes[c] for c in word) for word in t.text.split(" ")
            ]
            drawn.append(
                b"BT /F1 1 Tf %.2f 0 0 %.2f %.2f %.2f Tm [%s] TJ ET"
                % (t.size, t.size, t.x, t.y, b" -600 ".join(words))
            )
        streams[8 + 2 * k] = _packed(b"", b"\n".join(drawn) + b"\nQ\n" + _strokes(sheet))
    heads, bodies, at = [], [], 0
    for number, body in inside.items():
        heads.append(b"%d %d" % (number, at))
        bodies.append(body + b" ")
        at += len(body) + 1
    first = b" ".join(heads) + b" "
    streams[6] = _packed(
        b"/Type /ObjStm /N %d /First %d" % (len(inside), len(first)), first + b"".join(bodies)
    )
    out, places = bytearray(b"%PDF-1.5\n%\xe2\xe3\xcf\xd3\n"), {}
    for number in sorted(streams):
        places[number] = len(out)
        out += b"%d 0 obj\n%s\nendobj\n" % (number, streams[number])
    last, start = 7 + 2 * len(sheets), len(out)
    nth = {number: k for k, number in enumerate(inside)}
    rows = [b"\0" * 7]
    for number in range(1, last):
        if number in nth:
            rows.append(b"\2" + (6).to_bytes(4, "big") + nth[number].to_bytes(2, "big"))
        else:
            rows.append(b"\1" + places[number].to_bytes(4, "big") + b"\0\0")
    rows.append(b"\1" + start.to_bytes(4, "big") + b"\0\0")
    # Rows as differences from the row above.
    table, above = bytearray(), b"\0" * 7
    for row in rows:
        table += b"\2" + bytes((a - b) & 255 for a, b in zip(row, above, strict=True))
        above = row
    body = _packed(
        b"/Type /XRef /Size %d /W [1 4 2] /Root 1 0 R /DecodeParms << /Predictor 12 /Columns 7 >>"
        % (last + 1),
        bytes(table),
    )
    out += b"%d 0 obj\n%s\nendobj\nstartxref\n%d\n%%%%EOF\n" % (last, body, start)
    return bytes(out)


# -- pages of words ----------------------------------------------------------------


def plain_sheets(words: list[str], per_line: int = 8, per_page: int = 320) -> list[Sheet]:
    """Pages of lines of words."""
    sheets = []
    for at in range(0, max(len(words), 1), per_page):
        own = words[at : at + per_page]
        lines = [" ".join(own[k : k + per_line]) for k in range(0, len(own), per_line)]
        texts = [Text(MARGIN, 740.0 - 12 * k, 10.0, line) for k, line in enumerate(lines)]
        sheets.append(Sheet(612.0, 792.0, texts, []))
    return sheets


TITLE, COLUMN, CELLS = 5, 120, 6


def _wrapped(words: list[str], letters: int) -> list[str]:
    out = [""]
    for word in words:
        if out[-1] and len(out[-1]) + 1 + len(word) > letters:
            out.append("")
        out[-1] += (" " if out[-1] else "") + word
    return [line for line in out if line]


def column_sheets(words: list[str]) -> list[Sheet]:
    """Pages with a title, two columns drawn line by line across both, and a ruled table:
    a cell over three columns, one over two rows, and four plain ones."""
    sheets = []
    for at in range(0, len(words), TITLE + 2 * COLUMN + CELLS):
        own = words[at : at + TITLE + 2 * COLUMN + CELLS]
        body = own[TITLE : TITLE + 2 * COLUMN]
        size, letters = 6.0, max([60, *map(len, own)])
        columns = [_wrapped(body[:COLUMN], letters), _wrapped(body[COLUMN:], letters)]
        wide, step = letters * size * WIDTH, 1.2 * size
        high = 200 + step * max(map(len, columns))
        texts = [Text(MARGIN, high - 40, 16.0, " ".join(own[:TITLE]))]
        for k in range(max(map(len, columns))):
            for side, column in enumerate(columns):
                if k < len(column):
                    x = MARGIN + side * (wide + 30)
                    texts.append(Text(x, high - 70 - step * k, size, column[k]))
        cells, lines = own[TITLE + 2 * COLUMN :], []
        if cells:
            x, y = [MARGIN + k * (wide + 10) for k in range(4)], [90.0, 70.0, 50.0, 30.0]
            places = [(0, 0), (1, 0), (1, 1), (1, 2), (2, 1), (2, 2)]
            for word, (row, column) in zip(cells, places, strict=False):
                texts.append(Text(x[column] + 4, y[row + 1] + 6, size, word))
            lines = [(x[0], v, x[3], v) for v in (90.0, 70.0, 30.0)] + [(x[1], 50.0, x[3], 50.0)]
            lines += [(v, 30.0, v, 90.0) for v in (x[0], x[3])] + [(v, 30.0, v, 70.0) for v in x[1:3]]
        sheets.append(Sheet(2 * MARGIN + 3 * (wide + 10), high, texts, lines))
    return sheets


def write_pdf(words: Column, number: Column, columns: bool = False) -> Column:
    """A file of the words of each row; rows of odd number, and texts that one-byte codes
    cannot hold, in the modern style."""

    def file(own: list[str], nth: int) -> bytes:
        sheets = column_sheets(own) if columns else plain_sheets(own)
        try:
            return modern(sheets) if nth % 2 else classic(sheets)
        except UnicodeEncodeError:
            return modern(sheets)

    def run(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        for own, nth in batches:
            files = [file(list(w), int(n)) for w, n in zip(own, nth, strict=True)]
            yield pd.Series(files, index=own.index, dtype=object)

    return F.pandas_udf(run, "binary")(words, number)
