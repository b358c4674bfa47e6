"""Workbooks as cells, one row for each cell that is not empty, and small workbooks from tables; standard library only.

Files are read by Spark (binaryFile) from any store and parsed one to a task's turn; a file that can't be parsed gives one row
of kind 'error' and the job goes on. Only the first sheet, or the named one, is read. The row number r counts from 0.
"""

from __future__ import annotations

import io
import re
import zipfile
from collections.abc import Iterator, Sequence
from xml.etree import ElementTree
from xml.sax.saxutils import escape, quoteattr

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

CELLS = "source_file string, source_sha256 string, sheet_name string, r int, c int, kind string, str string, num double, indent int"
_COLUMNS = [c.split()[0] for c in CELLS.split(", ")]
_MAIN = "{http://schemas.openxmlformats.org/spreadsheetml/2006/main}"
_REL = "{http://schemas.openxmlformats.org/officeDocument/2006/relationships}id"


def _column(ref: str) -> int:
    n = 0
    for ch in re.match("[A-Z]+", ref).group():
        n = n * 26 + ord(ch) - 64
    return n - 1


def _text(node) -> str:
    """The runs of a string item without its phonetic hints."""
    return "".join(t.text or "" for part in node if part.tag != f"{_MAIN}rPh" for t in part.iter(f"{_MAIN}t"))


def parse(content: bytes, sheet: str | None = None) -> tuple[str, list[tuple]]:
    """The sheet's name and its cells (r, c, kind, str, num, indent). Formulas count by the value stored with them."""
    with zipfile.ZipFile(io.BytesIO(content)) as book:
        have = set(book.namelist())
        tree = lambda name: ElementTree.fromstring(book.read(name))
        sheets = list(tree("xl/workbook.xml").iter(f"{_MAIN}sheet"))
        chosen = next((s for s in sheets if sheet in (None, s.get("name"))), None)
        if chosen is None:
            raise ValueError(f"no sheet {sheet!r}")
        targets = {x.get("Id"): x.get("Target") for x in tree("xl/_rels/workbook.xml.rels")}
        target = targets[chosen.get(_REL)]
        shared = [_text(si) for si in tree("xl/sharedStrings.xml")] if "xl/sharedStrings.xml" in have else []
        indents = [0]
        if "xl/styles.xml" in have:
            formats = tree("xl/styles.xml").find(f"{_MAIN}cellXfs")
            indents = [int((a.get("indent") or 0) if (a := xf.find(f"{_MAIN}alignment")) is not None else 0) for xf in (formats if formats is not None else ())] or [0]
        out = []
        for r, row in enumerate(tree(target.lstrip("/") if target.startswith("/") else f"xl/{target}").iter(f"{_MAIN}row")):
            r = int(row.get("r", r + 1)) - 1
            for c, cell in enumerate(row.iter(f"{_MAIN}c")):
                c = _column(cell.get("r")) if cell.get("r") else c
                style, kind, value = int(cell.get("s", 0)), cell.get("t", "n"), cell.find(f"{_MAIN}v")
                if kind == "inlineStr":
                    text = _text(cell.find(f"{_MAIN}is"))
                elif value is None or value.text is None:
                    continue
                else:
                    text = shared[int(value.text)] if kind == "s" else value.text
                indent = indents[style] if style < len(indents) else 0
                if kind == "n":
                    out.append((r, c, "number", text, float(text), indent))
                elif kind == "b":
                    out.append((r, c, "boolean", text, None, indent))
                elif text != "":
                    out.append((r, c, "string", text, None, indent))
        return chosen.get("name"), out


def _parse_files(sheet: str | None):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for path, digest, content in zip(batch["path"], batch["digest"], batch["content"], strict=True):
                try:
                    name, cells = parse(content, sheet)
                    rows = [(path, digest, name, *x) for x in cells]
                except Exception as e:  # any bad file is a finding, not the end of the batch
                    rows = [(path, digest, None, -1, -1, "error", f"{type(e).__name__}: {e}", None, 0)]
                yield pd.DataFrame(rows, columns=_COLUMNS)

    return run


def files(spark: SparkSession, path: str) -> DataFrame:
    """(path, digest, content) of the workbooks in a folder, lock files left out; digest is the first 16 hex digits of the SHA-256."""
    found = spark.read.format("binaryFile").option("pathGlobFilter", "*.xlsx").load(path).where(~F.col("path").rlike(r"/~\$[^/]*$"))
    return found.select("path", F.substring(F.sha2("content", 256), 1, 16).alias("digest"), "content")


def file_digest(spark: SparkSession, path: str) -> DataFrame:
    return files(spark, path).select("path", "digest")


def scan_cells(spark: SparkSession, path: str, sheet: str | None = None) -> DataFrame:
    """The cells of all workbooks in a folder; parallel by file."""
    return files(spark, path).mapInPandas(_parse_files(sheet), CELLS)


def write_book(path: str, sheets: dict[str, Sequence[Sequence]], indents: dict[tuple[str, int, int], int] | None = None) -> None:
    """A workbook with inline strings on the driver: for reports a person opens and for fixtures. indents: (sheet, r, c) to a cell's indent."""
    depths = sorted({0, *(indents or {}).values()})
    main = 'xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main"'
    letters = lambda c: (letters(c // 26 - 1) if c >= 26 else "") + chr(65 + c % 26)

    def cell(name: str, r: int, c: int, v) -> str:
        at = f'<c r="{letters(c)}{r + 1}" s="{depths.index((indents or {}).get((name, r, c), 0))}"'
        if isinstance(v, (int, float)) and not isinstance(v, bool):
            return f"{at}><v>{v!r}</v></c>"
        return f'{at} t="inlineStr"><is><t xml:space="preserve">{escape(str(v))}</t></is></c>'

    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as book:
        n = range(1, len(sheets) + 1)
        kind = "application/vnd.openxmlformats-officedocument.spreadsheetml"
        book.writestr("[Content_Types].xml", '<Types xmlns="http://schemas.openxmlformats.org/package/2006/content-types"><Default Extension="rels" ContentType="application/vnd.openxmlformats-package.relationships+xml"/>' f'<Override PartName="/xl/workbook.xml" ContentType="{kind}.sheet.main+xml"/><Override PartName="/xl/styles.xml" ContentType="{kind}.styles+xml"/>' + "".join(f'<Override PartName="/xl/worksheets/sheet{i}.xml" ContentType="{kind}.worksheet+xml"/>' for i in n) + "</Types>")
        rel = "http://schemas.openxmlformats.org/officeDocument/2006/relationships"
        packed = '<Relationships xmlns="http://schemas.openxmlformats.org/package/2006/relationships">'
        book.writestr("_rels/.rels", f'{packed}<Relationship Id="r1" Type="{rel}/officeDocument" Target="xl/workbook.xml"/></Relationships>')
        book.writestr("xl/_rels/workbook.xml.rels", packed + "".join(f'<Relationship Id="s{i}" Type="{rel}/worksheet" Target="worksheets/sheet{i}.xml"/>' for i in n) + f'<Relationship Id="st" Type="{rel}/styles" Target="styles.xml"/></Relationships>')
        book.writestr("xl/workbook.xml", f'<workbook {main} xmlns:r="{rel}"><sheets>' + "".join(f'<sheet name={quoteattr(s)} sheetId="{i}" r:id="s{i}"/>' for i, s in zip(n, sheets, strict=True)) + "</sheets></workbook>")
        book.writestr("xl/styles.xml", f'<styleSheet {main}><fonts count="1"><font/></fonts><fills count="1"><fill/></fills><borders count="1"><border/></borders><cellStyleXfs count="1"><xf/></cellStyleXfs><cellXfs count="{len(depths)}">' + "".join(f'<xf applyAlignment="1"><alignment indent="{d}"/></xf>' for d in depths) + "</cellXfs></styleSheet>")
        for i, (name, rows) in zip(n, sheets.items(), strict=True):
            body = "".join(f'<row r="{r + 1}">' + "".join(cell(name, r, c, v) for c, v in enumerate(row) if v is not None) + "</row>" for r, row in enumerate(rows))
            book.writestr(f"xl/worksheets/sheet{i}.xml", f"<worksheet {main}><sheetData>{body}</sheetData></worksheet>")
