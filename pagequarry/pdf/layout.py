"""Reading order of a PDF page: columns and paragraphs by recursive cuts, tables by rules.

A region is cut along the widest empty bands: upright gutters part columns, level ones part
paragraphs. Lines that are drawn and touch each other make the grid of a table; cells with no
line between them are one cell with a row or column span.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator
from statistics import median
from typing import NamedTuple

from pagequarry.functions.text import split_words
from pagequarry.pdf.text import Rule, Run

# In font sizes: the narrowest gutter of columns, the least space between paragraphs and
# between words, and how far base lines of one line may lie apart.
GUTTER, PARAGRAPH, WORD, LINE = 1.5, 0.5, 0.15, 0.5
LARGER = 1.15  # a title is set larger than the text by this factor
TOUCH = 2.0  # points within which lines meet
# What a list item begins with.
BULLET = re.compile(r"(?:[•‣◦▪–*-]|\(?(?:\d{1,3}|[a-zA-Z])[.)])\s")


class Box(NamedTuple):
    x0: float
    y0: float
    x1: float
    y1: float
    size: float
    item: Run | Table


class Cell(NamedTuple):
    row: int
    rows: int
    columns: int
    text: str


class Table(NamedTuple):
    x0: float
    y0: float
    x1: float
    y1: float
    cells: list[Cell]

    def text(self) -> str:
        return " ".join(c.text for c in self.cells if c.text)

    def as_html(self) -> str:
        rows: dict[int, list[str]] = {}
        for cell in self.cells:
            spans = f' rowspan="{cell.rows}"' if cell.rows > 1 else ""
            spans += f' colspan="{cell.columns}"' if cell.columns > 1 else ""
            shown = f"<td{spans}>{html.escape(cell.text, quote=False)}</td>"
            rows.setdefault(cell.row, []).append(shown)
        return "<table>" + "".join(f"<tr>{''.join(r)}</tr>" for _, r in sorted(rows.items())) + "</table>"


def _box(run: Run) -> Box:
    return Box(run.x0, run.y - 0.2 * run.size, run.x1, run.y + 0.8 * run.size, run.size, run)


# -- lines and paragraphs ----------------------------------------------------------


def _joined(runs: list[Run]) -> str:
    """The runs of one line, with a space where they lie apart."""
    out = ""
    for before, run in zip([None, *runs], runs, strict=False):
        apart = before is not None and run.x0 - before.x1 > WORD * run.size
        out += " " + run.text if apart and not out.endswith(" ") and run.text[0] != " " else run.text
    return " ".join(split_words(out))


def lines(runs: list[Run]) -> list[list[Run]]:
    """Runs by base line, top to bottom, each line left to right."""
    found: list[list[Run]] = []
    for run in sorted(runs, key=lambda r: (-r.y, r.x0)):
        if found and found[-1][0].y - run.y <= LINE * max(run.size, found[-1][0].size):
            found[-1].append(run)
        else:
            found.append([run])
    return [sorted(line, key=lambda r: r.x0) for line in found]


def drawn_lines(runs: list[Run]) -> list[list[Run]]:
    """Runs by base line, in the order they are drawn."""
    found: list[list[Run]] = []
    for run in runs:
        if found and abs(found[-1][-1].y - run.y) <= LINE * run.size and run.x0 >= found[-1][-1].x0:
            found[-1].append(run)
        else:
            found.append([run])
    return found


def paragraphs(listed: list[list[Run]]) -> Iterator[tuple[float, str]]:
    """(font size, text) of neighbouring lines of one size that lie close."""
    block: list[list[Run]] = []
    for line in listed:
        if block:
            last, size = block[-1][0], line[0].size
            far = last.y - line[0].y > (1 + PARAGRAPH) * max(size, last.size) or last.y < line[0].y
            if far or not 1 / LARGER < size / (last.size or 1) < LARGER:
                yield block[0][0].size, " ".join(t for b in block if (t := _joined(b)))
                block = []
        block.append(line)
    if block:
        yield block[0][0].size, " ".join(t for b in block if (t := _joined(b)))


# -- cuts --------------------------------------------------------------------------


def _bands(boxes: list[Box], low: int, high: int, least: float) -> list[list[Box]]:
    """Boxes parted where an empty band at least so wide crosses all of them."""
    parts: list[list[Box]] = []
    reach = 0.0
    for box in sorted(boxes, key=lambda b: b[low]):
        if parts and box[low] - reach <= least:
            parts[-1].append(box)
            reach = max(reach, box[high])
        else:
            parts.append([box])
            reach = box[high]
    return parts


def cut(boxes: list[Box]) -> Iterator[list[Box]]:
    """Regions that cannot be cut further, in reading order."""
    waiting = [boxes] if boxes else []
    while waiting:
        region = waiting.pop()
        size = median(b.size for b in region) or 1.0
        tall = max(b.y1 for b in region) - min(b.y0 for b in region)
        parts = _bands(region, 0, 2, GUTTER * size) if tall > 1.5 * size else [region]
        if len(parts) == 1:
            parts = _bands(region, 1, 3, PARAGRAPH * size)[::-1]
        if len(parts) == 1:
            yield region
        else:
            waiting += reversed(parts)


# -- tables ------------------------------------------------------------------------


def _steps(values: list[float]) -> list[float]:
    """Places of lines, those that nearly coincide as one."""
    found: list[float] = []
    for value in sorted(values):
        if not found or value - found[-1] > TOUCH:
            found.append(value)
    return found


def _meeting(level: list[Rule], upright: list[Rule]) -> list[tuple[list[Rule], list[Rule]]]:
    """Lines that touch each other, directly or through others."""
    every = level + upright
    root = list(range(len(every)))

    def find(k: int) -> int:
        while root[k] != k:
            root[k] = root[root[k]]
            k = root[k]
        return k

    for j, up in enumerate(upright, len(level)):
        for i, flat in enumerate(level):
            if (
                flat.x0 - TOUCH <= up.x0 <= flat.x1 + TOUCH
                and up.y0 - TOUCH <= flat.y0 <= up.y1 + TOUCH
            ):
                root[find(i)] = find(j)
    groups: dict[int, tuple[list[Rule], list[Rule]]] = {}
    for k, rule in enumerate(every):
        groups.setdefault(find(k), ([], []))[k >= len(level)].append(rule)
    return list(groups.values())


def tables(runs: list[Run], rules: list[Rule]) -> tuple[list[Table], list[Run]]:
    """The tables of a page, and the runs outside them."""
    level = [r for r in set(rules) if r.y1 - r.y0 <= 1 and r.x1 - r.x0 > TOUCH]
    upright = [r for r in set(rules) if r.x1 - r.x0 <= 1 and r.y1 - r.y0 > TOUCH]
    found = []
    for flat, up in _meeting(level, upright):
        xs, ys = _steps([r.x0 for r in up]), _steps([r.y0 for r in flat])[::-1]
        if len(xs) < 2 or len(ys) < 2 or (len(xs) == 2 and len(ys) == 2):
            continue
        inside = [r for r in runs if _within(r, xs[0], ys[-1], xs[-1], ys[0])]
        runs = [r for r in runs if not _within(r, xs[0], ys[-1], xs[-1], ys[0])]
        found.append(Table(xs[0], ys[-1], xs[-1], ys[0], list(_cells(xs, ys, flat, up, inside))))
    return found, runs


def _within(run: Run, x0: float, y0: float, x1: float, y1: float) -> bool:
    return x0 <= (run.x0 + run.x1) / 2 <= x1 and y0 <= run.y + 0.3 * run.size <= y1


def _cells(
    xs: list[float], ys: list[float], flat: list[Rule], up: list[Rule], runs: list[Run]
) -> Iterator[Cell]:
    def wall_right(i: int, j: int) -> bool:
        middle = (ys[i] + ys[i + 1]) / 2
        return any(abs(r.x0 - xs[j + 1]) <= TOUCH and r.y0 <= middle <= r.y1 for r in up)

    def wall_below(i: int, j: int) -> bool:
        middle = (xs[j] + xs[j + 1]) / 2
        return any(abs(r.y0 - ys[i + 1]) <= TOUCH and r.x0 <= middle <= r.x1 for r in flat)

    high, wide, taken = len(ys) - 1, len(xs) - 1, set()
    for i in range(high):
        for j in range(wide):
            if (i, j) in taken:
                continue
            columns = rows = 1
            while j + columns < wide and not wall_right(i, j + columns - 1):
                columns += 1
            over = range(j, j + columns)
            while i + rows < high and not any(wall_below(i + rows - 1, c) for c in over):
                rows += 1
            taken |= {(r, c) for r in range(i, i + rows) for c in over}
            inside = [r for r in runs if _within(r, xs[j], ys[i + rows], xs[j + columns], ys[i])]
            text = " ".join(_joined(line) for line in lines(inside))
            yield Cell(i, rows, columns, text)


# -- elements ----------------------------------------------------------------------


def _kind(size: float, text: str, body: float) -> str:
    if size > LARGER * body:
        return "Title"
    return "ListItem" if BULLET.match(text) else "NarrativeText"


def elements(runs: list[Run], rules: list[Rule], hi_res: bool) -> Iterator[dict]:
    """Typed elements of one page: as drawn, or in reading order with tables."""
    letters = sorted((r.size, len(r.text)) for r in runs)
    body, half = 0.0, sum(n for _, n in letters) / 2
    for size, n in letters:
        half -= n
        body = size
        if half <= 0:
            break
    regions: Iterator[list[list[Run] | Table]]
    if hi_res:
        grids, runs = tables(runs, rules)
        boxes = [_box(r) for r in runs] + [Box(*t[:4], 0.0, t) for t in grids]
        regions = (_parts(region) for region in cut(boxes))
    else:
        regions = iter([[runs]])
    for region in regions:
        for part in region:
            if isinstance(part, Table):
                yield {"type": "Table", "text": part.text(), "metadata": {"text_as_html": part.as_html()}}
                continue
            for size, text in paragraphs(lines(part) if hi_res else drawn_lines(part)):
                if text:
                    yield {"type": _kind(size, text, body), "text": text}


def _parts(region: list[Box]) -> list[list[Run] | Table]:
    """A region is text or, where a table lies over text, both."""
    texts = [b.item for b in region if isinstance(b.item, Run)]
    found: list[list[Run] | Table] = [texts] if texts else []
    return found + [b.item for b in region if isinstance(b.item, Table)]
