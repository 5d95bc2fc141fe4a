"""Reads CSV and XLSX bytes into rows of text cells, one task per file.

A file is parsed whole, so that row numbers are stable; what can't be read gives
an error row and never stops the others.
"""

from __future__ import annotations

import csv
import io
import re
import zipfile
from collections.abc import Iterator
from datetime import date, datetime, timedelta
from xml.etree import ElementTree

import pyarrow as pa
from pyspark.sql import DataFrame

from panelforge.config import DATASETS
from panelforge.functions.text import fold_header_text

HEADER_ROWS = 10
SCHEMA = "source_file_id string, source_sheet_name string, source_header_row long, source_row_number long, headers array<string>, cells array<string>, error string"
_KNOWN = frozenset(h for d in DATASETS for h in d.headers())
_NS = {"m": "http://schemas.openxmlformats.org/spreadsheetml/2006/main", "r": "http://schemas.openxmlformats.org/officeDocument/2006/relationships"}
#: Built-in number formats that show dates.
_DATE_FORMATS = {*range(14, 23), 27, 30, 36, 45, 46, 47, 50, 57}


def cell_text(v: object) -> str:
    """A cell as text: whole floats without a fraction, dates in ISO form, NaN empty."""
    if v is None or v != v:
        return ""
    if isinstance(v, bool):
        return str(v)
    if isinstance(v, float):
        return "" if v in (float("inf"), float("-inf")) else str(int(v)) if v == int(v) else str(v)
    if isinstance(v, datetime):
        return v.isoformat(sep=" ") if v.time() != datetime.min.time() else v.date().isoformat()
    return v.isoformat() if isinstance(v, date) else str(v).strip()


def read_csv(data: bytes) -> list[tuple[str, list[list[object]]]]:
    for encoding in ("utf-8-sig", "cp1252", "latin-1"):
        try:
            text = data.decode(encoding)
            break
        except UnicodeDecodeError:
            continue
    return [("", [list(r) for r in csv.reader(text.splitlines())])]


def _column(ref: str) -> int:
    n = 0
    for x in re.match(r"[A-Z]+", ref)[0]:
        n = n * 26 + ord(x) - 64
    return n - 1


def _dates(z: zipfile.ZipFile) -> set[int]:
    """Style numbers whose number format shows a date."""
    if "xl/styles.xml" not in z.namelist():
        return set()
    root = ElementTree.fromstring(z.read("xl/styles.xml"))
    own = {int(f.get("numFmtId")): f.get("formatCode", "") for f in root.iterfind("m:numFmts/m:numFmt", _NS)}
    shows = lambda n: n in _DATE_FORMATS or bool(re.search("[dmyh]", re.sub(r'"[^"]*"|\[[^\]]*\]|\\.', "", own.get(n, "").lower())))
    return {i for i, x in enumerate(root.iterfind("m:cellXfs/m:xf", _NS)) if shows(int(x.get("numFmtId", 0)))}


def read_xlsx(data: bytes) -> list[tuple[str, list[list[object]]]]:
    """All sheets with their cached values; numbers in a date style become dates."""
    z = zipfile.ZipFile(io.BytesIO(data))
    shared = []
    if "xl/sharedStrings.xml" in z.namelist():
        shared = ["".join(t.text or "" for t in s.iter(f"{{{_NS['m']}}}t")) for s in ElementTree.fromstring(z.read("xl/sharedStrings.xml")).iterfind("m:si", _NS)]
    dated = _dates(z)
    book = ElementTree.fromstring(z.read("xl/workbook.xml"))
    targets = {x.get("Id"): x.get("Target") for x in ElementTree.fromstring(z.read("xl/_rels/workbook.xml.rels"))}
    out = []
    for sheet in book.iterfind("m:sheets/m:sheet", _NS):
        target = targets[sheet.get(f"{{{_NS['r']}}}id")]
        root = ElementTree.fromstring(z.read(target.lstrip("/") if target.startswith("/") else f"xl/{target}"))
        rows: list[list[object]] = []
        for r in root.iterfind("m:sheetData/m:row", _NS):
            at = int(r.get("r", len(rows) + 1)) - 1
            rows.extend([] for _ in range(at + 1 - len(rows)))
            for c in r.iterfind("m:c", _NS):
                k = _column(c.get("r")) if c.get("r") else len(rows[at])
                rows[at].extend(None for _ in range(k + 1 - len(rows[at])))
                kind, v = c.get("t", "n"), c.find("m:v", _NS)
                if kind == "inlineStr":
                    value: object = "".join(t.text or "" for t in c.iter(f"{{{_NS['m']}}}t"))
                elif v is None or v.text is None:
                    value = None
                elif kind == "s":
                    value = shared[int(v.text)]
                elif kind == "b":
                    value = v.text == "1"
                elif kind in ("str", "e", "d"):
                    value = v.text
                else:
                    value = float(v.text)
                    if int(c.get("s", -1)) in dated and 1 <= value <= 2_958_465:
                        value = datetime(1899, 12, 30) + timedelta(days=value)
                rows[at][k] = value
        out.append((sheet.get("name", ""), rows))
    return out


def header_row(rows: list[list[str]], known: frozenset[str] = _KNOWN) -> int | None:
    """The row of the first HEADER_ROWS with most known headers; the earliest wins, else the first that isn't blank."""
    score = [sum(fold_header_text(c) in known for c in r) for r in rows[:HEADER_ROWS]]
    if score and max(score):
        return score.index(max(score))
    return next((i for i, r in enumerate(rows) if any(r)), None)


def named(cells: list[str]) -> list[str]:
    """Header names without blanks and repeats."""
    out, seen = [], {}
    for i, c in enumerate(cells, 1):
        c = c or f"column_{i}"
        seen[c] = seen.get(c, 0) + 1
        out.append(c if seen[c] == 1 else f"{c}__{seen[c]}")
    return out


def parse(path: str, data: bytes, known: frozenset[str] = _KNOWN) -> Iterator[tuple[str, int, int, list[str], list[str]]]:
    """Sheet, header row (from 1), row number, headers and cells. Numbers go on across sheets; blank rows have none."""
    number = 0
    for sheet, raw in read_xlsx(data) if path.lower().endswith(".xlsx") else read_csv(data):
        rows = [[cell_text(c) for c in r] for r in raw]
        head = header_row(rows, known)
        if head is None:
            continue
        cells = rows[head]
        while cells and not cells[-1]:
            cells = cells[:-1]
        names = named(cells)
        found = False
        for r in rows[head + 1 :]:
            if any(r):
                number, found = number + 1, True
                yield sheet, head + 1, number, names, (r + [""] * len(names))[: len(names)]
        if not found:
            yield sheet, head + 1, 0, names, []


def _rows(known: frozenset[str]):
    kinds = [pa.string(), pa.string(), pa.int64(), pa.int64(), pa.list_(pa.string()), pa.list_(pa.string()), pa.string()]
    columns = [c.split()[0] for c in SCHEMA.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for file_id, path, content in zip(*(b.column(c).to_pylist() for c in ("source_file_id", "source_file_path", "content")), strict=True):
                try:
                    rows = [(file_id, *r, None) for r in parse(path, content, known)]
                    if not rows:
                        rows = [(file_id, None, None, None, None, None, "no rows")]
                except Exception as e:  # any damage is a finding about the file
                    rows = [(file_id, None, None, None, None, None, f"{type(e).__name__}: {e}"[:500])]
                for lo in range(0, len(rows), 4096):
                    part = rows[lo : lo + 4096]
                    yield pa.RecordBatch.from_arrays([pa.array([r[j] for r in part], k) for j, k in enumerate(kinds)], names=columns)

    return run


def rows(files: DataFrame, datasets=DATASETS) -> DataFrame:
    """The rows of files (source_file_id, source_file_path, content)."""
    known = frozenset(h for d in datasets for h in d.headers())
    return files.select("source_file_id", "source_file_path", "content").mapInArrow(_rows(known), SCHEMA)
