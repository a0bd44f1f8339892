"""Spreadsheet workbooks (S5): the sheet XML inside an ``.xlsx`` container, read as a stream.

Workbooks reach the executors through Spark's binary file source, so any store that Spark
reads will do.  A workbook is cut into row ranges by its stated size, one task each; a task
inflates the sheet up to its range and keeps nothing outside it.  A sheet has at most
1,048,576 rows by its format, so a range is bounded, and many workbooks spread over many tasks.

Cells come as text: shared and inline strings, numbers as they are written, booleans as
``TRUE`` and ``FALSE``; error cells, empty cells and the text ``NA`` are NULL.  Rows that a
sheet leaves out count as empty rows when a preamble is skipped, as they do on screen; empty rows
after the preamble are left out, as the reference's reader leaves them out.
"""

from __future__ import annotations

import io
import re
import xml.etree.ElementTree as ET
import zipfile
from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

ROWS_PER_TASK = 1 << 16
MAX_ROWS = 1 << 20
_MAIN = "{http://schemas.openxmlformats.org/spreadsheetml/2006/main}"
_REL = "{http://schemas.openxmlformats.org/officeDocument/2006/relationships}"


def _text(node: ET.Element) -> str:
    """The text of a string item: its plain or rich runs, without phonetic hints."""
    return "".join(t.text or "" for part in node if part.tag in (f"{_MAIN}t", f"{_MAIN}r") for t in part.iter(f"{_MAIN}t"))


def _sheet_path(book: zipfile.ZipFile, sheet: int | str) -> str:
    """The container path of a sheet, by place (from 1) or name."""
    tree = ET.fromstring(book.read("xl/workbook.xml"))
    sheets = [(s.get("name"), s.get(f"{_REL}id")) for s in tree.iter(f"{_MAIN}sheet")]
    try:
        link = sheets[sheet - 1][1] if isinstance(sheet, int) else dict(sheets)[sheet]
    except (IndexError, KeyError):
        raise ValueError(f"no sheet {sheet!r} among {[n for n, _ in sheets]}") from None
    links = {r.get("Id"): r.get("Target") for r in ET.fromstring(book.read("xl/_rels/workbook.xml.rels"))}
    target = links[link]
    return target.lstrip("/") if target.startswith("/") else f"xl/{target}"


def _column(ref: str) -> int:
    """0 for A, 25 for Z, 26 for AA."""
    n = 0
    for c in re.match(r"[A-Z]+", ref).group():
        n = 26 * n + ord(c) - 64
    return n - 1


def _rows(book: zipfile.ZipFile, path: str, first: int, end: int) -> Iterator[tuple[int, dict[int, tuple[str, str]]]]:
    """(row number from 1, column -> (type, raw value)) of the rows first <= r < end."""
    last = 0
    with book.open(path) as stream:
        context = ET.iterparse(stream, ("start", "end"))
        holder = None
        for event, node in context:
            if event == "start":
                if node.tag == f"{_MAIN}sheetData":
                    holder = node
                continue
            if node.tag == f"{_MAIN}sheetData":
                return
            if node.tag != f"{_MAIN}row":
                continue
            last = int(node.get("r") or last + 1)
            if last >= end:
                return
            if last >= first:
                cells, at = {}, -1
                for c in node:
                    at = _column(c.get("r")) if c.get("r") else at + 1
                    kind, value = c.get("t", "n"), c.find(f"{_MAIN}v")
                    inline = c.find(f"{_MAIN}is")
                    cells[at] = (kind, _text(inline) if inline is not None else (value.text or "") if value is not None else "")
                yield last, cells
            holder.clear()


def _shared(book: zipfile.ZipFile, wanted: set[int]) -> dict[int, str]:
    """The shared strings that are asked for, found in one pass over their list."""
    out: dict[int, str] = {}
    if not wanted or "xl/sharedStrings.xml" not in book.namelist():
        return out
    with book.open("xl/sharedStrings.xml") as stream:
        top, n = None, 0
        for event, node in ET.iterparse(stream, ("start", "end")):
            if top is None:
                top = node
            if event == "end" and node.tag == f"{_MAIN}si":
                if n in wanted:
                    out[n] = _text(node)
                n += 1
                top.clear()
    return out


def range_rows(content: bytes, sheet: int | str, first: int, end: int, width: int) -> list[list[str | None]]:
    """The non-empty rows first <= r < end of a sheet, ``width`` cells each, as text."""
    with zipfile.ZipFile(io.BytesIO(content)) as book:
        raw = [cells for _, cells in _rows(book, _sheet_path(book, sheet), first, end)]
        strings = _shared(book, {int(v) for cells in raw for kind, v in cells.values() if kind == "s" and v})
    def value(kind: str, v: str) -> str | None:
        if kind == "s":
            v = strings[int(v)] if v else ""
        elif kind == "b":
            v = "TRUE" if v == "1" else "FALSE"
        return None if kind == "e" or v in ("", "NA") else v

    out = [[value(*cells[k]) if k in cells else None for k in range(width)] for cells in raw]
    return [r for r in out if any(c is not None for c in r)]


def read_workbook(spark: SparkSession, path: str, names: Sequence[str], skip: int = 0, sheet: int | str = 1,
                  rows_per_task: int = ROWS_PER_TASK) -> DataFrame:
    """One sheet of each workbook under ``path``, its first ``skip`` rows dropped, columns named by position, all text."""
    names = list(names)
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.xlsx").load(path)

    def ranges(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """The row ranges of each workbook, from the stated size of its sheet where there is one."""
        for pdf in batches:
            for name, content in zip(pdf["path"], pdf["content"], strict=True):
                with zipfile.ZipFile(io.BytesIO(content)) as book, book.open(_sheet_path(book, sheet)) as stream:
                    head = stream.read(4096).decode("utf-8", "replace")
                stated = re.search(r'<dimension ref="[A-Z]+\d+:[A-Z]+(\d+)"', head)
                last = int(stated.group(1)) if stated else MAX_ROWS
                starts = list(range(skip + 1, max(last, skip + 1) + 1, rows_per_task))
                # the stated size is a hint: the last range is open
                yield pd.DataFrame({"path": name, "first": starts, "end": [*starts[1:], MAX_ROWS + 1]})

    def parse(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for content, first, end in zip(pdf["content"], pdf["first"], pdf["end"], strict=True):
                yield pd.DataFrame(range_rows(content, sheet, int(first), int(end), len(names)), columns=names, dtype=object)

    cut = files.select("path", "content").mapInPandas(ranges, "path string, first long, end long")
    parts = files.select("path", "content").join(cut, "path").select("content", "first", "end").repartition(F.col("first"))
    return parts.mapInPandas(parse, ", ".join(f"`{n}` string" for n in names))


# ----------------------------------------------------------------- sink
def workbook_bytes(rows: Iterator[Sequence[str | None]], preamble: Sequence[str] = (), sheet: str = "Hoja1") -> bytes:
    """A workbook with one sheet of text cells (shared strings); preamble lines take a row each, empty ones none."""
    from xml.sax.saxutils import escape

    index: dict[str, int] = {}
    name = lambda k: (chr(64 + k // 26) if k >= 26 else "") + chr(65 + k % 26)
    body, at, wide = [], 0, 1
    for cells in [*([p] for p in preamble), *rows]:
        at, wide = at + 1, max(wide, len(cells))
        held = "".join(f'<c r="{name(k)}{at}" t="s"><v>{index.setdefault(v, len(index))}</v></c>' for k, v in enumerate(cells) if v not in (None, ""))
        if held:
            body.append(f'<row r="{at}">{held}</row>')
    ns = f'xmlns="{_MAIN[1:-1]}"'
    parts = {
        "[Content_Types].xml": '<Types xmlns="http://schemas.openxmlformats.org/package/2006/content-types">'
                               '<Default Extension="rels" ContentType="application/vnd.openxmlformats-package.relationships+xml"/>'
                               '<Default Extension="xml" ContentType="application/xml"/></Types>',
        "xl/workbook.xml": f'<workbook {ns} xmlns:r="{_REL[1:-1]}"><sheets><sheet name="{escape(sheet)}" sheetId="1" r:id="rId1"/></sheets></workbook>',
        "xl/_rels/workbook.xml.rels": '<Relationships xmlns="http://schemas.openxmlformats.org/package/2006/relationships">'
                                      f'<Relationship Id="rId1" Type="{_REL[1:-1]}/worksheet" Target="worksheets/sheet1.xml"/></Relationships>',
        "xl/worksheets/sheet1.xml": f'<worksheet {ns}><dimension ref="A1:{name(wide - 1)}{max(at, 1)}"/><sheetData>{"".join(body)}</sheetData></worksheet>',
        "xl/sharedStrings.xml": f'<sst {ns}>' + "".join(f'<si><t xml:space="preserve">{escape(v)}</t></si>' for v in index) + "</sst>",
    }
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as book:
        for part, text in parts.items():
            book.writestr(part, '<?xml version="1.0" encoding="UTF-8" standalone="yes"?>\n' + text if not text.startswith("<?xml") else text)
    return out.getvalue()


def write_workbooks(df: DataFrame, path: str, preamble: Sequence[str] = ()) -> str:
    """One workbook per partition of ``df`` below ``path``; each is built in its task and written through Hadoop's file system.

    A partition must fit a sheet (1,048,576 rows); the driver holds one workbook at a time.
    """
    spark = df.sparkSession

    def build(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rows = (tuple(None if pd.isna(v) else str(v) for v in r) for pdf in batches for r in pdf.itertuples(index=False))
        yield pd.DataFrame({"content": [workbook_bytes(rows, preamble)]})

    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    for k, row in enumerate(df.mapInPandas(build, "content binary").toLocalIterator()):
        target = jvm.org.apache.hadoop.fs.Path(f"{path}/part-{k:05d}.xlsx")
        stream = target.getFileSystem(conf).create(target, True)
        stream.write(bytearray(row.content))
        stream.close()
    return path
