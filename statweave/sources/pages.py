"""Statistics tables extracted from stored HTML pages.

The one Python operator of the engine: ``mapInArrow`` runs a small
``html.parser`` state machine over each page inside the executors (Arrow
batches, partitioned by page). It emits *long* cell rows; everything after it
(header disambiguation, pivot to wide rows, typing, joins) is Spark.

Per page, the table used is the one with the requested id, else the first
table holding a key cell (``<td data-stat="player">`` by default). A two-row
header gives ``header_top`` (colspans expanded) and ``header``; repeated header
rows inside the body and rows without a keyed link are dropped; the entity key
comes from the link with ``key_pattern`` and travels with its row (no
positional zip).
"""

from __future__ import annotations

import re
from html import unescape
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.schema import dedup_header_names

# Fixed values of the source site's markup.
DEFAULT_KEY_STAT = "player"
DEFAULT_KEY_PATTERN = r"/players/(\w+)/"

CELL = ("struct<row_no: int, col_no: int, header_top: string, header: string, name: string, "
        "value: string, entity_key: string, entity_name: string>")
PAGE_SCHEMA = ("page_id long, n_tables int, table_no int, n_rows int, n_keyed_rows int, "
               f"status string, error string, cells array<{CELL}>")
STATUS_SCHEMA = ("page_id long, n_tables int, table_no int, n_rows int, n_keyed_rows int, "
                 "status string, error string")


def _span(value: str | None) -> int:
    return max(int(value), 1) if (value or "").isdigit() else 1


class _Tables(HTMLParser):
    """Collects every table as header rows and body rows of cells, with the
    repairs of a browser: an opening cell or row closes the open one, the end
    of a table closes what is left open in it, and a table inside a cell has a
    stack entry of its own, so the outer row goes on behind it."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.tables, self._stack = [], []

    def _top(self):
        return self._stack[-1] if self._stack else None

    def _end_cell(self):
        t = self._top()
        if t and t["cell"] is not None:
            t["cell"]["text"] = "".join(t["cell"]["text"]).strip()
            t["row"]["cells"].append(t["cell"])
            t["cell"] = None

    def _end_row(self):
        self._end_cell()
        t = self._top()
        if t and t["row"] is not None:
            t["rows"].append(t["row"])
            t["row"] = None

    def _end_table(self):
        self._end_row()
        self._stack.pop()

    def handle_starttag(self, tag, attrs):
        a = dict(attrs)
        if tag == "table":
            t = {"id": a.get("id"), "rows": [], "row": None, "cell": None, "section": None}
            self.tables.append(t)
            self._stack.append(t)
            return
        t = self._top()
        if t is None:
            return
        if tag in ("thead", "tbody", "tfoot"):
            self._end_row()
            t["section"] = tag
        elif tag == "tr":
            self._end_row()
            t["row"] = {"cells": [], "cls": a.get("class") or "", "section": t["section"]}
        elif tag in ("td", "th"):
            self._end_cell()
            if t["row"] is None:
                t["row"] = {"cells": [], "cls": "", "section": t["section"]}
            t["cell"] = {"tag": tag, "stat": a.get("data-stat"), "text": [], "href": None,
                         "span": _span(a.get("colspan")), "down": _span(a.get("rowspan"))}
        elif tag == "a" and t["cell"] is not None and t["cell"]["href"] is None:
            t["cell"]["href"] = a.get("href")

    def handle_endtag(self, tag):
        t = self._top()
        if t is None:
            return
        if tag in ("td", "th"):
            self._end_cell()
        elif tag == "tr":
            self._end_row()
        elif tag in ("thead", "tbody", "tfoot"):
            self._end_row()
            t["section"] = None
        elif tag == "table":
            self._end_table()

    def handle_data(self, data):
        t = self._top()
        if t and t["cell"] is not None:
            t["cell"]["text"].append(data)

    def close(self):
        super().close()
        while self._stack:
            self._end_table()
        for t in self.tables:
            t["head"], t["body"] = _split_head(t["rows"])


# A page in which every "<" opens one of these tags needs no parser: names,
# double-quoted attributes, no character references inside a tag.
_TAG = re.compile(r'<(/?)([a-zA-Z][a-zA-Z0-9]*)((?:[ \t\r\n\f]+[a-zA-Z][a-zA-Z0-9_:-]*="[^"<>&]*")*)[ \t\r\n\f]*>')
_ATTRIBUTE = re.compile(r'([a-zA-Z][a-zA-Z0-9_:-]*)="([^"]*)"')
# Elements whose content is no markup.
_RAW = {"script", "style", "textarea", "title", "iframe", "noembed", "noframes", "noscript", "xmp",
        "plaintext"}
_USED = {"table", "thead", "tbody", "tfoot", "tr", "td", "th", "a"}


def _read(html: str) -> _Tables:
    """The tables of a page: plain markup is cut by one pattern, any other
    goes through the parser, to the same result."""
    p = _Tables()
    parts = _TAG.split(html)
    names = [n.lower() for n in parts[2::4]]
    if len(names) != html.count("<") or not _RAW.isdisjoint(names) or any(
            a and end for end, a in zip(parts[1::4], parts[3::4])):
        p.feed(html)
    else:
        for end, tag, attrs, text in zip(parts[1::4], names, parts[3::4], parts[4::4]):
            if tag in _USED:
                if end:
                    p.handle_endtag(tag)
                else:
                    p.handle_starttag(tag, [(n.lower(), v) for n, v in _ATTRIBUTE.findall(attrs)] if attrs else ())
            if text:
                p.handle_data(unescape(text) if "&" in text else text)
    p.close()
    return p


def _split_head(rows):
    """Header rows: those of <thead>, else the leading rows of only <th>."""
    head = [r for r in rows if r["section"] == "thead"]
    body = [r for r in rows if r["section"] != "thead"]
    if not head:
        while body and body[0]["cells"] and all(c["tag"] == "th" for c in body[0]["cells"]):
            head.append(body.pop(0))
    return head, body


def _grid(rows):
    """Per row its (column, cell) pairs: colspans advance the column, rowspans
    are carried down."""
    down: dict[int, tuple[int, dict]] = {}
    out = []
    for r in rows:
        at, line = 0, []

        def carried(at):
            while at in down:
                left, cell = down.pop(at)
                line.append((at, cell))
                if left > 1:
                    later[at] = (left - 1, cell)
                at += 1
            return at
        later: dict[int, tuple[int, dict]] = {}
        for c in r["cells"]:
            at = carried(at)
            line.append((at, c))
            for k in range(c["span"]):
                if c["down"] > 1:
                    later[at + k] = (c["down"] - 1, c)
            at += c["span"]
        carried(at)
        down = later
        out.append(line)
    return out


def _pick(tables, table_id, key_stat):
    if table_id:
        for i, t in enumerate(tables):
            if t["id"] == table_id:
                return i
    for i, t in enumerate(tables):
        if any(c["stat"] == key_stat and c["tag"] == "td" for r in t["body"] for c in r["cells"]):
            return i
    return None


def _headers(head_rows):
    """(header_top, header) per column from up to two header rows."""
    def expand(row):
        out = []
        for c in row["cells"]:
            out.extend([c["text"]] * c["span"])
        return out
    if not head_rows:
        return [], []
    low = expand(head_rows[-1])
    top = expand(head_rows[-2]) if len(head_rows) > 1 else [""] * len(low)
    top = (top + [""] * len(low))[:len(low)]
    return top, low


def extract_page(page_id, html, table_id=None, key_stat=DEFAULT_KEY_STAT,
                 key_pattern=DEFAULT_KEY_PATTERN, suffixes=None, unlisted="keep_first"):
    """One page as a row of ``PAGE_SCHEMA``: its status and the cells of its
    table."""
    p = _read(html or "")
    i = _pick(p.tables, table_id, key_stat)
    if i is None:
        return (page_id, len(p.tables), None, 0, 0, "no_table", None, [])
    t = p.tables[i]
    top, low = _headers(t["head"])
    names = dict(dedup_header_names(low, suffixes or {}, unlisted))
    rx = re.compile(key_pattern)
    cells, n_rows, n_keyed = [], 0, 0
    for r, line in zip(t["body"], _grid(t["body"])):
        if "thead" in r["cls"].split() or all(c["tag"] == "th" for c in r["cells"]):
            continue                       # a header row repeated inside the body
        n_rows += 1
        key_cell = next((c for _, c in line if c["stat"] == key_stat), None)
        m = rx.search(key_cell["href"]) if key_cell is not None and key_cell["href"] else None
        if m is None or not key_cell["text"]:
            continue                       # no keyed link: dropped (F1)
        n_keyed += 1
        for j, c in line:
            cells.append((n_keyed - 1, j, top[j] if j < len(top) else None,
                          low[j] if j < len(low) else None, names.get(j), c["text"],
                          m.group(1), key_cell["text"]))
    return (page_id, len(p.tables), i, n_rows, n_keyed, "ok", None, cells)


def parse_pages(pages: DataFrame, table_id: str | None = None,
                key_stat: str = DEFAULT_KEY_STAT, key_pattern: str = DEFAULT_KEY_PATTERN,
                suffixes: dict | None = None, unlisted: str = "keep_first",
                carry: str | None = None, with_cells: bool = True) -> DataFrame:
    """Every page parsed once: its status and its cells in one row (S1-S4; a
    failing page is a row here, not an exception). ``pages`` may carry a
    ``table_id`` column, which then chooses the table page by page;
    ``carry`` names an integer column that is passed through. Without
    ``with_cells`` the cells are left in the task."""
    own = "table_id" in pages.columns
    cell = pa.struct([("row_no", pa.int32()), ("col_no", pa.int32()),
                      *[(n, pa.string()) for n in ("header_top", "header", "name", "value",
                                                   "entity_key", "entity_name")]])
    fields = [("page_id", pa.int64()), ("n_tables", pa.int32()), ("table_no", pa.int32()),
              ("n_rows", pa.int32()), ("n_keyed_rows", pa.int32()), ("status", pa.string()),
              ("error", pa.string()), ("cells", pa.list_(cell))]

    def run(batches):
        for b in batches:
            for at in range(0, b.num_rows, 64):      # bounded by pages, not by cells
                part = b.slice(at, 64)
                ids = part.column(2).to_pylist() if own else [table_id] * part.num_rows
                out = []
                for pid, html, tid in zip(part.column(0).to_pylist(), part.column(1).to_pylist(), ids):
                    try:
                        out.append(extract_page(pid, html, tid, key_stat, key_pattern,
                                                suffixes, unlisted))
                    except Exception as e:  # noqa: BLE001 - the status says so
                        out.append((pid, None, None, 0, 0, "error", repr(e), []))
                if not with_cells:
                    out = [(*r[:-1], []) for r in out]
                arrays = [pa.array([r[i] for r in out], t) for i, (_, t) in enumerate(fields)]
                names = [n for n, _ in fields]
                if carry:
                    arrays.append(part.column(part.num_columns - 1))
                    names.append(carry)
                yield pa.RecordBatch.from_arrays(arrays, names=names)

    more = [*(["table_id"] if own else []), *([carry] if carry else [])]
    schema = PAGE_SCHEMA + (f", {carry} int" if carry else "")
    return pages.select("page_id", "html", *more).mapInArrow(run, schema)


def cells_of(parsed: DataFrame) -> DataFrame:
    """Long cell rows of parsed pages."""
    return parsed.select("page_id", "table_no", F.explode("cells").alias("c")).select(
        "page_id", "table_no", "c.*")


def status_of(parsed: DataFrame) -> DataFrame:
    """One row per parsed page: tables found, table used, rows kept, status."""
    return parsed.drop("cells")


def extract_cells(pages: DataFrame, **how) -> DataFrame:
    """Long cell rows of the chosen table of every page."""
    return cells_of(parse_pages(pages, **how))


def page_status(pages: DataFrame, **how) -> DataFrame:
    """One status row per page."""
    return status_of(parse_pages(pages, **how))


def cells_to_wide(cells: DataFrame, columns: list[str], rename: dict | None = None) -> DataFrame:
    """Pivot long cells to one row per (page, entity row) with the wanted
    disambiguated header names as columns (one aggregate:
    a pivot would shuffle the cells twice), renamed to final names (P4)."""
    rename = rename or {}
    named = [F.first(F.when(F.col("name") == c, F.col("value")), ignorenulls=True).alias(f"_{i}")
             for i, c in enumerate(columns)]
    wide = (cells.filter(F.col("name").isin(columns))
                 .groupBy("page_id", "table_no", "row_no", "entity_key", "entity_name").agg(*named))
    return wide.select("page_id", "row_no", "entity_key", "entity_name",
                       *[F.col(f"_{i}").alias(rename.get(c, c)) for i, c in enumerate(columns)])
