"""Report tables as one workbook (Office Open XML), written with the standard library: a bold header and plain cells.

A sheet holds at most ``ROWS`` rows: a report is for reading, and whole tables are written as Parquet or JSON beside it.
"""

from __future__ import annotations

import io
import math
import zipfile
from xml.sax.saxutils import escape, quoteattr

from pyspark.sql import DataFrame

ROWS = 10_000
_HEAD = '<?xml version="1.0" encoding="UTF-8" standalone="yes"?>'
_MAIN = "http://schemas.openxmlformats.org/spreadsheetml/2006/main"
_DOC = "http://schemas.openxmlformats.org/officeDocument/2006/relationships"
_PACKAGE = "http://schemas.openxmlformats.org/package/2006"
_TYPE = "application/vnd.openxmlformats-officedocument.spreadsheetml"


def column_name(n: int) -> str:
    """0 is A, 26 is AA."""
    out = ""
    n += 1
    while n:
        n, r = divmod(n - 1, 26)
        out = chr(65 + r) + out
    return out


def _cell(at: str, value, style: int = 0) -> str:
    if value is None:
        return ""
    if isinstance(value, bool):
        return f'<c r="{at}" t="b" s="{style}"><v>{int(value)}</v></c>'
    if isinstance(value, (int, float)) and (not isinstance(value, float) or math.isfinite(value)):
        return f'<c r="{at}" s="{style}"><v>{value!r}</v></c>'
    text = "".join(c for c in str(value)[:32_767] if c in "\t\n" or ord(c) >= 32)
    return f'<c r="{at}" t="inlineStr" s="{style}"><is><t xml:space="preserve">{escape(text)}</t></is></c>'


def sheet(columns: list[str], rows: list[tuple]) -> str:
    lines = []
    for i, row in enumerate([columns, *rows]):
        cells = "".join(_cell(f"{column_name(j)}{i + 1}", v, int(i == 0)) for j, v in enumerate(row))
        lines.append(f'<row r="{i + 1}">{cells}</row>')
    return f'{_HEAD}<worksheet xmlns="{_MAIN}"><sheetData>{"".join(lines)}</sheetData></worksheet>'


def workbook(tables: dict[str, tuple[list[str], list[tuple]]]) -> bytes:
    """The bytes of a workbook with a sheet for each table."""
    names = [n[:31] for n in tables]
    parts = {f"xl/worksheets/sheet{i + 1}.xml": sheet(c, r) for i, (c, r) in enumerate(tables.values())}
    parts["xl/workbook.xml"] = f'{_HEAD}<workbook xmlns="{_MAIN}" xmlns:r="{_DOC}"><sheets>' + "".join(f'<sheet name={quoteattr(n)} sheetId="{i + 1}" r:id="r{i + 1}"/>' for i, n in enumerate(names)) + "</sheets></workbook>"
    parts["xl/styles.xml"] = f'{_HEAD}<styleSheet xmlns="{_MAIN}"><fonts count="2"><font/><font><b/></font></fonts><fills count="1"><fill/></fills><borders count="1"><border/></borders><cellStyleXfs count="1"><xf/></cellStyleXfs><cellXfs count="2"><xf/><xf fontId="1" applyFont="1"/></cellXfs></styleSheet>'
    links = "".join(f'<Relationship Id="r{i + 1}" Type="{_DOC}/worksheet" Target="worksheets/sheet{i + 1}.xml"/>' for i in range(len(names)))
    parts["xl/_rels/workbook.xml.rels"] = f'{_HEAD}<Relationships xmlns="{_PACKAGE}/relationships">{links}<Relationship Id="styles" Type="{_DOC}/styles" Target="styles.xml"/></Relationships>'
    parts["_rels/.rels"] = f'{_HEAD}<Relationships xmlns="{_PACKAGE}/relationships"><Relationship Id="r1" Type="{_DOC}/officeDocument" Target="xl/workbook.xml"/></Relationships>'
    kinds = "".join(f'<Override PartName="/xl/worksheets/sheet{i + 1}.xml" ContentType="{_TYPE}.worksheet+xml"/>' for i in range(len(names)))
    parts["[Content_Types].xml"] = f'{_HEAD}<Types xmlns="{_PACKAGE}/content-types"><Default Extension="rels" ContentType="application/vnd.openxmlformats-package.relationships+xml"/><Default Extension="xml" ContentType="application/xml"/><Override PartName="/xl/workbook.xml" ContentType="{_TYPE}.sheet.main+xml"/><Override PartName="/xl/styles.xml" ContentType="{_TYPE}.styles+xml"/>{kinds}</Types>'
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as z:
        for name in sorted(parts):
            z.writestr(name, parts[name])
    return out.getvalue()


def of(tables: dict[str, DataFrame], rows: int = ROWS) -> bytes:
    """A workbook of report tables; the first rows of each, so many at most."""
    return workbook({name: (df.columns, [tuple(str(v) if isinstance(v, (list, dict, tuple)) else v for v in r) for r in df.limit(rows).collect()]) for name, df in tables.items()})
