"""Text runs of a PDF page: fonts, and the operators that show text and draw lines."""

from __future__ import annotations

import math
import re
import unicodedata
from collections.abc import Iterator
from html.entities import name2codepoint
from typing import Any, NamedTuple

from pagequarry.pdf.objects import DEEPEST, Document, Name, Op, PdfError, Stream, parse

# Glyph names that are not those of character references.
GLYPHS = {
    "space": " ", "exclam": "!", "quotedbl": '"', "numbersign": "#", "dollar": "$",
    "percent": "%", "ampersand": "&", "quotesingle": "'", "parenleft": "(", "parenright": ")",
    "asterisk": "*", "plus": "+", "comma": ",", "hyphen": "-", "period": ".", "slash": "/",
    "colon": ":", "semicolon": ";", "less": "<", "equal": "=", "greater": ">", "question": "?",
    "at": "@", "bracketleft": "[", "backslash": "\\", "bracketright": "]",
    "asciicircum": "^", "underscore": "_", "grave": "`", "braceleft": "{", "bar": "|",
    "braceright": "}", "asciitilde": "~", "exclamdown": "¡", "sterling": "£",
    "section": "§", "quoteleft": "‘", "quoteright": "’", "quotedblleft": "“",
    "quotedblright": "”", "quotesinglbase": "‚", "quotedblbase": "„", "guillemotleft": "«",
    "guillemotright": "»", "guilsinglleft": "‹", "guilsinglright": "›", "endash": "–",
    "emdash": "—", "dagger": "†", "daggerdbl": "‡", "periodcentered": "·", "paragraph": "¶",
    "bullet": "•", "ellipsis": "…", "questiondown": "¿", "germandbls": "ß", "dotlessi": "ı",
    "fi": "fi", "fl": "fl", "ff": "ff", "ffi": "ffi", "ffl": "ffl", "onesuperior": "¹",
    "twosuperior": "²", "threesuperior": "³", "fraction": "⁄", "minus": "−", "Euro": "€",
    "zero": "0", "one": "1", "two": "2", "three": "3", "four": "4", "five": "5", "six": "6",
    "seven": "7", "eight": "8", "nine": "9", "nbspace": " ", "sfthyphen": "-",
}
ACCENTS = {"caron": "CARON", "ogonek": "OGONEK", "macron": "MACRON", "breve": "BREVE",
           "dotaccent": "DOT ABOVE", "hungarumlaut": "DOUBLE ACUTE", "commaaccent": "CEDILLA"}
CODECS = {"WinAnsiEncoding": "cp1252", "MacRomanEncoding": "mac_roman"}
CODED = re.compile(r"(?:uni|u)([0-9A-F]{4,6})")
# Where standard fonts differ from Latin text, for the codes that plain files use.
STANDARD = {39: "’", 96: "‘", 174: "fi", 175: "fl", 177: "–", 183: "•", 188: "…", 208: "—",
            169: "'", 170: "“", 186: "”", 185: "„", 251: "ß"}

GAP = 0.2  # a move of this part of the font size inside a string is a space
PLAIN_WIDTH, FIXED_WIDTH = 500.0, 600.0
MOST_FORMS = 20  # forms drawn inside forms


def glyph(name: str) -> str:
    """The text of a glyph by its name; empty if the name says nothing."""
    name = name.split(".")[0] or name
    if name in GLYPHS:
        return GLYPHS[name]
    if len(name) == 1:
        return name
    if name in name2codepoint:
        return chr(name2codepoint[name])
    if coded := CODED.fullmatch(name):
        number = int(coded[1], 16)
        return chr(number) if number < 0x110000 and not 0xD800 <= number < 0xE000 else ""
    for accent, label in ACCENTS.items():
        if name == name[0] + accent:
            case = "CAPITAL" if name[0].isupper() else "SMALL"
            try:
                return unicodedata.lookup(f"LATIN {case} LETTER {name[0].upper()} WITH {label}")
            except KeyError:
                return ""
    return ""


def operations(data: bytes) -> Iterator[tuple[str, list]]:
    """(operator, operands) of a content stream, inline images left out."""
    at, operands = 0, []
    while True:
        try:
            value, at = parse(data, at)
        except PdfError:
            return
        if not isinstance(value, Op):
            operands.append(value)
            continue
        if value == "":
            return
        if value == "BI":
            end = re.compile(rb"\sEI(?=[\s\x00]|$)").search(data, at)
            if not end:
                return
            at = end.end()
        elif value in ("true", "false", "null"):
            operands.append(None)
            continue
        else:
            yield str(value), operands
        operands = []


def _unicode(raw: Any) -> str:
    return raw.decode("utf-16-be", "replace") if isinstance(raw, bytes) else ""


def character_map(data: bytes) -> tuple[dict[bytes, str], set[int]]:
    """Codes to text of a ToUnicode map, and the lengths its codes have."""
    found, lengths = {}, set()
    for operator, operands in operations(data):
        if operator == "endcodespacerange":
            lengths |= {len(v) for v in operands[::2] if isinstance(v, bytes)}
        elif operator == "endbfchar":
            for code, text in zip(operands[::2], operands[1::2], strict=False):
                if isinstance(code, bytes):
                    found[code] = _unicode(text) if not isinstance(text, Name) else glyph(text)
        elif operator == "endbfrange":
            for low, high, text in zip(operands[::3], operands[1::3], operands[2::3], strict=False):
                if not isinstance(low, bytes) or not isinstance(high, bytes):
                    continue
                first, last = int.from_bytes(low, "big"), int.from_bytes(high, "big")
                for k in range(min(last - first + 1, 1 << 16)):
                    if isinstance(text, list):
                        value = _unicode(text[k]) if k < len(text) else ""
                    else:
                        value = _unicode(text)
                        value = value[:-1] + chr(min(ord(value[-1]) + k, 0x10FFFF)) if value else ""
                    found[(first + k).to_bytes(len(low), "big")] = value
    return found, lengths


class Font:
    """Codes of a font as text and widths, in thousandths of its size."""

    def __init__(self, document: Document, font: dict):
        get = self.get = document.get
        self.texts, lengths = {}, set()
        to_unicode = get(font.get("ToUnicode"))
        if isinstance(to_unicode, Stream):
            self.texts, lengths = character_map(document.content(to_unicode))
        encoding = get(font.get("Encoding"))
        self.wide = get(font.get("Subtype")) == "Type0"
        self.utf16 = isinstance(encoding, str) and ("UTF16" in encoding or "UCS2" in encoding)
        self.scale, self.widths = 1.0, {}
        if self.wide:
            if isinstance(encoding, Stream):
                lengths = character_map(document.content(encoding))[1] or {2}
            else:
                lengths = {2}
            kids = get(font.get("DescendantFonts")) or [{}]
            inner = get(kids[0]) or {}
            self.default = float(get(inner.get("DW", 1000)))
            self._wide_widths(get(inner.get("W")) or [])
        else:
            lengths = {1}
            self._simple(font, encoding)
        self.lengths = sorted(n for n in lengths if n) or [1]

    def _wide_widths(self, listed: list) -> None:
        at = 0
        while at + 1 < len(listed):
            first, then = self.get(listed[at]), self.get(listed[at + 1])
            if isinstance(then, list):
                self.widths |= {first + k: float(self.get(w)) for k, w in enumerate(then)}
                at += 2
            else:
                wide = float(self.get(listed[at + 2])) if at + 2 < len(listed) else self.default
                self.widths |= {code: wide for code in range(first, min(then, first + 65535) + 1)}
                at += 3

    def _simple(self, font: dict, encoding: Any) -> None:
        get = self.get
        base = get(encoding.get("BaseEncoding")) if isinstance(encoding, dict) else encoding
        codec = CODECS.get(str(base))
        for code in range(256):
            raw = bytes([code])
            if raw in self.texts:
                continue
            text = raw.decode(codec or "latin-1", "replace") if code >= 32 else ""
            if codec is None:
                text = STANDARD.get(code, text)
            self.texts[raw] = "" if text == "�" else text
        if isinstance(encoding, dict) and get(font.get("ToUnicode")) is None:
            code = 0
            for item in get(encoding.get("Differences")) or []:
                item = get(item)
                if isinstance(item, Name):
                    self.texts[bytes([code & 255])] = glyph(item)
                    code += 1
                elif isinstance(item, int):
                    code = item
        first, widths = get(font.get("FirstChar")), get(font.get("Widths"))
        about = get(font.get("FontDescriptor")) or {}
        fixed = "Courier" in str(get(font.get("BaseFont")))
        self.default = float(get(about.get("MissingWidth")) or (FIXED_WIDTH if fixed else PLAIN_WIDTH))
        if isinstance(widths, list) and isinstance(first, int):
            self.widths = {first + k: float(get(w)) for k, w in enumerate(widths)}
        if get(font.get("Subtype")) == "Type3":
            self.scale = 1000 * abs(float((get(font.get("FontMatrix")) or [0.001])[0]))

    def read(self, raw: bytes) -> Iterator[tuple[str, float, bool]]:
        """(text, width, whether it is the code of a space) of each code of a string."""
        at = 0
        while at < len(raw):
            for length in self.lengths:
                code = raw[at : at + length]
                if code in self.texts:
                    break
            else:
                code = raw[at : at + self.lengths[-1]]
            at += max(len(code), 1)
            number = int.from_bytes(code, "big")
            text = self.texts.get(code)
            if text is None:
                text = _unicode(code) if self.utf16 else ""
            yield text, self.widths.get(number, self.default) * self.scale, code == b" "


class Run(NamedTuple):
    """Text from ``x0`` to ``x1`` on the base line ``y``."""

    x0: float
    x1: float
    y: float
    size: float
    text: str


class Rule(NamedTuple):
    """A straight line, level or upright."""

    x0: float
    y0: float
    x1: float
    y1: float


IDENTITY = (1.0, 0.0, 0.0, 1.0, 0.0, 0.0)


def times(m: tuple, n: tuple) -> tuple:
    """The matrix that applies ``m`` first."""
    a, b, c, d, e, f = m
    g, h, i, j, k, l = n  # noqa: E741
    return (a * g + b * i, a * h + b * j, c * g + d * i, c * h + d * j, e * g + f * i + k, e * h + f * j + l)


def place(m: tuple, x: float, y: float) -> tuple[float, float]:
    return m[0] * x + m[2] * y + m[4], m[1] * x + m[3] * y + m[5]


class State(NamedTuple):
    """What q saves and Q brings back."""

    matrix: tuple
    font: Font | None = None
    size: float = 0.0
    chars: float = 0.0
    words: float = 0.0
    stretch: float = 1.0
    leading: float = 0.0
    rise: float = 0.0


class Page:
    """The runs and rules of a page, in the order they are drawn."""

    def __init__(self, document: Document, page: dict):
        self.document, self.fonts = document, {}
        self.runs: list[Run] = []
        self.rules: list[Rule] = []
        box = [float(document.get(v)) for v in document.get(page.get("MediaBox")) or (0, 0, 612, 792)]
        turn = int(document.get(page.get("Rotate")) or 0) % 360 // 90
        upright = (
            IDENTITY,
            (0.0, -1.0, 1.0, 0.0, -box[1], box[2]),
            (-1.0, 0.0, 0.0, -1.0, box[2], box[3]),
            (0.0, 1.0, -1.0, 0.0, box[3], -box[0]),
        )[turn]
        contents = document.get(page.get("Contents"))
        parts = [document.get(c) for c in (contents if isinstance(contents, list) else [contents])]
        data = b"\n".join(document.content(c) for c in parts if isinstance(c, Stream))
        self._draw(data, document.get(page.get("Resources")) or {}, upright, 0)

    def _font(self, resources: dict, name: Any) -> Font | None:
        listed = self.document.get(resources.get("Font")) or {}
        ref = listed.get(name)
        key = ref if isinstance(ref, tuple) else (id(listed), name)
        if key not in self.fonts:
            font = self.document.get(ref)
            self.fonts[key] = Font(self.document, font) if isinstance(font, dict) else None
        return self.fonts[key]

    def _draw(self, data: bytes, resources: dict, matrix: tuple, depth: int) -> None:
        state, saved = State(matrix), []
        text = line = IDENTITY
        path: list[tuple] = []
        at = (0.0, 0.0)
        for operator, args in operations(data):
            try:
                if operator == "q":
                    saved.append(state)
                    if len(saved) > 10 * DEEPEST:
                        return
                elif operator == "Q":
                    state = saved.pop() if saved else state
                elif operator == "cm":
                    state = state._replace(matrix=times(tuple(map(float, args[:6])), state.matrix))
                elif operator == "BT":
                    text = line = IDENTITY
                elif operator == "Tf":
                    state = state._replace(font=self._font(resources, args[0]), size=float(args[1]))
                elif operator == "Tc":
                    state = state._replace(chars=float(args[0]))
                elif operator == "Tw":
                    state = state._replace(words=float(args[0]))
                elif operator == "Tz":
                    state = state._replace(stretch=args[0] / 100)
                elif operator == "TL":
                    state = state._replace(leading=float(args[0]))
                elif operator == "Ts":
                    state = state._replace(rise=float(args[0]))
                elif operator in ("Td", "TD"):
                    if operator == "TD":
                        state = state._replace(leading=-float(args[1]))
                    text = line = times((1.0, 0.0, 0.0, 1.0, float(args[0]), float(args[1])), line)
                elif operator == "Tm":
                    text = line = tuple(map(float, args[:6]))
                elif operator in ("T*", "'", '"', "Tj", "TJ"):
                    if operator == '"':
                        state = state._replace(words=float(args[0]), chars=float(args[1]))
                    if operator in ("T*", "'", '"'):
                        text = line = times((1.0, 0.0, 0.0, 1.0, 0.0, -state.leading), line)
                    if operator != "T*":
                        shown = args[-1] if isinstance(args[-1], list) else [args[-1]]
                        text = self._show(shown, state, text)
                elif operator == "m":
                    at = place(state.matrix, *map(float, args[:2]))
                elif operator == "l":
                    to = place(state.matrix, *map(float, args[:2]))
                    path.append((*at, *to))
                    at = to
                elif operator == "re":
                    x, y, w, h = map(float, args[:4])
                    corners = [(x, y), (x + w, y), (x + w, y + h), (x, y + h)]
                    corners = [place(state.matrix, *c) for c in corners]
                    path += [(*a, *b) for a, b in zip(corners, corners[1:] + corners[:1], strict=True)]
                elif operator in ("S", "s", "f", "F", "f*", "B", "B*", "b", "b*"):
                    self.rules += [r for p in path if (r := _rule(p))]
                    path = []
                elif operator == "n":
                    path = []
                elif operator == "Do" and depth < MOST_FORMS:
                    self._form(resources, args[0], state.matrix, depth)
            except (ValueError, TypeError, IndexError, KeyError, AttributeError, OverflowError):
                self.document.damaged = True

    def _form(self, resources: dict, name: Any, matrix: tuple, depth: int) -> None:
        get = self.document.get
        form = get((get(resources.get("XObject")) or {}).get(name))
        if not isinstance(form, Stream) or get(form.head.get("Subtype")) != "Form":
            return
        own = tuple(float(get(v)) for v in get(form.head.get("Matrix")) or IDENTITY)
        inside = get(form.head.get("Resources")) or resources
        self._draw(self.document.content(form), inside, times(own, matrix), depth + 1)

    def _show(self, parts: list, state: State, text: tuple) -> tuple:
        """Show strings, with moves between them; where the next string would begin."""
        if state.font is None:
            return text
        start, moved, shown = text, 0.0, []
        for part in parts:
            if isinstance(part, bytes):
                for piece, width, space in state.font.read(part):
                    shown.append(piece)
                    step = width / 1000 * state.size + state.chars + (state.words if space else 0)
                    moved += step * state.stretch
            elif isinstance(part, (int, float)):
                moved -= part / 1000 * state.size * state.stretch
                if -part / 1000 > GAP and shown and not shown[-1].endswith(" "):
                    shown.append(" ")
        whole = times((state.size * state.stretch, 0.0, 0.0, state.size, 0.0, state.rise), times(start, state.matrix))
        end = times((1.0, 0.0, 0.0, 1.0, moved, 0.0), start)
        (x0, y0), (x1, _) = place(whole, 0, 0), place(times(end, state.matrix), 0, state.rise)
        found = "".join(shown)
        if found.strip():
            self.runs.append(Run(min(x0, x1), max(x0, x1), y0, math.hypot(whole[2], whole[3]), found))
        return end


def _rule(line: tuple) -> Rule | None:
    x0, y0, x1, y1 = line
    if abs(x0 - x1) > 1 and abs(y0 - y1) > 1:
        return None
    return Rule(min(x0, x1), min(y0, y1), max(x0, x1), max(y0, y1))
