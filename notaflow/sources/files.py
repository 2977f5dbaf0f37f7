"""Landing-folder files (SRC-1..3): listing, bytes, workbook decode.

``binaryFile`` lists and reads files on the executors; the workbook decode is
a ``mapInPandas`` over (path, content) records, one workbook per record, so
files spread over tasks. xlsx is a zip of XML parts, decoded with the
standard library (no spreadsheet package is needed). Output is the long
cells table ``(arquivo_nome, aba_nome, linha, coluna, valor, erro)``.
"""

from __future__ import annotations

import datetime as _dt
import io
import itertools
import re
import zipfile
from collections.abc import Iterator
from xml.etree import ElementTree as ET

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

CELLS_SCHEMA = "arquivo_nome string, aba_nome string, linha bigint, coluna int, valor string, erro string"

_NS = {"m": "http://schemas.openxmlformats.org/spreadsheetml/2006/main",
       "r": "http://schemas.openxmlformats.org/officeDocument/2006/relationships",
       "pr": "http://schemas.openxmlformats.org/package/2006/relationships"}
# Built-in number formats that display dates (ECMA-376 ids).
_DATE_FORMAT_IDS = set(range(14, 23)) | {45, 46, 47}
_EPOCH = _dt.datetime(1899, 12, 30)


def list_files(spark: SparkSession, folder: str, glob: str = "*") -> DataFrame:
    """SRC-1: name, path, size, modified time — content is not read."""
    df = spark.read.format("binaryFile").option("pathGlobFilter", glob).load(folder)
    return df.select("path", F.regexp_extract("path", r"([^/]+)$", 1).alias("arquivo_nome"),
                     F.col("length").alias("tamanho_bytes"), F.col("modificationTime").alias("data_modificacao"))


def read_files(spark: SparkSession, folder: str, glob: str = "*.xlsx") -> DataFrame:
    """SRC-2: (arquivo_nome, content) with bytes read on the executors."""
    df = spark.read.format("binaryFile").option("pathGlobFilter", glob).load(folder)
    return df.select(F.regexp_extract("path", r"([^/]+)$", 1).alias("arquivo_nome"), "content")


def _col_index(ref: str) -> int:
    letters = re.match(r"[A-Z]+", ref).group(0)
    n = 0
    for ch in letters:
        n = n * 26 + (ord(ch) - 64)
    return n - 1


def _number_text(v: str) -> str:
    f = float(v)
    return str(int(f)) if f.is_integer() and abs(f) < 1e16 else repr(f)


def _date_styles(z: zipfile.ZipFile) -> set[int]:
    """Indexes of cell styles whose number format shows a date."""
    try:
        root = ET.fromstring(z.read("xl/styles.xml"))
    except KeyError:
        return set()
    custom = {}
    for nf in root.iterfind("m:numFmts/m:numFmt", _NS):
        code = re.sub(r'"[^"]*"|\[[^\]]*\]', "", nf.get("formatCode", "")).lower()
        custom[int(nf.get("numFmtId"))] = bool(re.search(r"[dy]", code))
    out = set()
    for i, xf in enumerate(root.iterfind("m:cellXfs/m:xf", _NS)):
        fid = int(xf.get("numFmtId", "0"))
        if fid in _DATE_FORMAT_IDS or custom.get(fid, False):
            out.add(i)
    return out


#: A sheet whose XML is larger than this is read twice, once to see that it is whole.
SHEET_IN_MEMORY = 8 << 20
#: Cells that leave a worker at a time.
CELLS_PER_BATCH = 50_000


def _tag(name: str) -> str:
    return f"{{{_NS['m']}}}{name}"


def _texts(node) -> str:
    return "".join(t.text or "" for t in node.iter(_tag("t")))


def _shared_strings(z: zipfile.ZipFile) -> list[str]:
    """The workbook's string table, one entry in memory at a time but for its text."""
    try:
        part = z.open("xl/sharedStrings.xml")
    except KeyError:
        return []
    out = []
    with part:
        for _, node in ET.iterparse(part):
            if node.tag == _tag("si"):
                out.append(_texts(node))
                node.clear()
    return out


def _placed(part) -> Iterator[tuple]:
    """(row, column, cell) of a sheet's XML as it is read; a row is forgotten once it is done.
    References are optional in the format; a cell or row without one follows the one before it."""
    row, col, data, inside = -1, -1, None, False
    for event, node in ET.iterparse(part, ("start", "end")):
        if event == "start":
            if node.tag == _tag("sheetData"):
                data = node
            elif node.tag == _tag("row") and data is not None:
                row, col, inside = (int(node.get("r")) - 1 if node.get("r") else row + 1), -1, True
        elif node.tag == _tag("c") and inside:
            ref = node.get("r")
            col = _col_index(ref) if ref else col + 1
            yield (int(re.search(r"[0-9]+", ref).group(0)) - 1 if ref else row), col, node
        elif node.tag == _tag("row") and inside:
            inside = False
            data.clear()
        elif node.tag == _tag("sheetData"):
            data = None


def _sheet_cells(part, shared: list[str], dates: set[int], epoch: _dt.datetime) -> Iterator[tuple[int, int, str]]:
    for row, col, c in _placed(part):
        t = c.get("t", "n")
        v = c.find("m:v", _NS)
        if t == "inlineStr":
            text = _texts(c)
        elif v is None:
            continue
        elif t == "s":
            text = shared[int(v.text)]
        elif t == "b":
            text = "True" if v.text == "1" else "False"
        elif t in ("str", "e"):
            text = v.text or ""
        elif int(c.get("s", "0")) in dates:
            text = (epoch + _dt.timedelta(days=float(v.text))).strftime("%Y-%m-%d %H:%M:%S")
        else:
            text = _number_text(v.text)
        yield row, col, text


def workbook_cells(name: str, content: bytes) -> Iterator[tuple]:
    """One workbook -> cells, read row by row, so a sheet of any length takes little
    memory (only the string table is held). A sheet that fails is skipped whole and a file
    that fails yields one row with ``erro`` set (type 'erro' downstream)."""
    try:
        z = zipfile.ZipFile(io.BytesIO(content))
        wb = ET.fromstring(z.read("xl/workbook.xml"))
        rels = ET.fromstring(z.read("xl/_rels/workbook.xml.rels"))
        targets = {r.get("Id"): r.get("Target") for r in rels.iterfind("pr:Relationship", _NS)}
        shared, dates = _shared_strings(z), _date_styles(z)
        pr = wb.find("m:workbookPr", _NS)
        epoch = _dt.datetime(1904, 1, 1) if pr is not None and pr.get("date1904") in ("1", "true") else _EPOCH
    except Exception as e:  # noqa: BLE001
        yield name, None, None, None, None, f"{type(e).__name__}: {e}"
        return
    for sh in wb.iterfind("m:sheets/m:sheet", _NS):
        sheet = sh.get("name")

        def read(found: str) -> Iterator[tuple]:
            with z.open(found) as part:
                yield from _sheet_cells(part, shared, dates, epoch)

        try:
            target = targets[sh.get(f"{{{_NS['r']}}}id")].lstrip("/")
            found = target if target.startswith("xl/") else "xl/" + target
            if z.getinfo(found).file_size <= SHEET_IN_MEMORY:
                cells = list(read(found))
            else:
                for _ in read(found):  # fails here, before any cell has left
                    pass
                cells = read(found)
        except Exception as e:  # noqa: BLE001 — a bad sheet is skipped, with its error on record
            yield name, sheet, None, None, None, f"{type(e).__name__}: {e}"
            continue
        for row, col, text in cells:
            yield name, sheet, row, col, text, None


def decode_workbook(name: str, content: bytes) -> list[tuple]:
    """All cells of one workbook (``workbook_cells``)."""
    return list(workbook_cells(name, content))


def _decode_batches(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    cols = ["arquivo_nome", "aba_nome", "linha", "coluna", "valor", "erro"]
    for pdf in batches:
        for name, content in zip(pdf["arquivo_nome"], pdf["content"]):
            cells = workbook_cells(name, bytes(content))
            while rows := list(itertools.islice(cells, CELLS_PER_BATCH)):
                yield pd.DataFrame(rows, columns=cols).astype({"linha": "Int64", "coluna": "Int32"})


def decode_workbooks(files: DataFrame) -> DataFrame:
    """SRC-3: (arquivo_nome, content) -> long cells, one workbook per record, decoded one
    by one and row by row. An Arrow batch of workbooks is bounded by bytes
    (``spark.sql.execution.arrow.maxBytesPerBatch``, 64 MB by default), in any session."""
    return files.select("arquivo_nome", "content").mapInPandas(_decode_batches, CELLS_SCHEMA)


# ---------------------------------------------------------------- writer (fixtures)
def _xml_text(s: str) -> str:
    return s.replace("&", "&amp;").replace("<", "&lt;").replace(">", "&gt;")


def _ref(row: int, col: int) -> str:
    letters = ""
    n = col + 1
    while n:
        n, r = divmod(n - 1, 26)
        letters = chr(65 + r) + letters
    return f"{letters}{row + 1}"


def build_workbook(sheets: dict[str, list[tuple[int, int, str]]]) -> bytes:
    """Minimal xlsx (inline strings) from {sheet: [(row, col, text)]}."""
    buf = io.BytesIO()
    names = list(sheets)
    with zipfile.ZipFile(buf, "w", zipfile.ZIP_DEFLATED) as z:
        z.writestr("[Content_Types].xml",
                   '<?xml version="1.0" encoding="UTF-8"?><Types xmlns="http://schemas.openxmlformats.org/package/2006/content-types">'
                   '<Default Extension="rels" ContentType="application/vnd.openxmlformats-package.relationships+xml"/>'
                   '<Default Extension="xml" ContentType="application/xml"/>'
                   '<Override PartName="/xl/workbook.xml" ContentType="application/vnd.openxmlformats-officedocument.spreadsheetml.sheet.main+xml"/>'
                   + "".join(f'<Override PartName="/xl/worksheets/sheet{i + 1}.xml" ContentType="application/vnd.openxmlformats-officedocument.spreadsheetml.worksheet+xml"/>'
                             for i in range(len(names))) + "</Types>")
        z.writestr("_rels/.rels",
                   '<?xml version="1.0" encoding="UTF-8"?><Relationships xmlns="http://schemas.openxmlformats.org/package/2006/relationships">'
                   '<Relationship Id="rId1" Type="http://schemas.openxmlformats.org/officeDocument/2006/relationships/officeDocument" Target="xl/workbook.xml"/></Relationships>')
        z.writestr("xl/workbook.xml",
                   f'<?xml version="1.0" encoding="UTF-8"?><workbook xmlns="{_NS["m"]}" xmlns:r="{_NS["r"]}"><sheets>'
                   + "".join(f'<sheet name="{_xml_text(n)}" sheetId="{i + 1}" r:id="rId{i + 1}"/>' for i, n in enumerate(names))
                   + "</sheets></workbook>")
        z.writestr("xl/_rels/workbook.xml.rels",
                   '<?xml version="1.0" encoding="UTF-8"?><Relationships xmlns="http://schemas.openxmlformats.org/package/2006/relationships">'
                   + "".join(f'<Relationship Id="rId{i + 1}" Type="http://schemas.openxmlformats.org/officeDocument/2006/relationships/worksheet" Target="worksheets/sheet{i + 1}.xml"/>'
                             for i in range(len(names))) + "</Relationships>")
        for i, n in enumerate(names):
            by_row: dict[int, list[tuple[int, str]]] = {}
            for r, c, t in sheets[n]:
                by_row.setdefault(r, []).append((c, t))
            body = []
            for r in sorted(by_row):
                cells = "".join(f'<c r="{_ref(r, c)}" t="inlineStr"><is><t xml:space="preserve">{_xml_text(t)}</t></is></c>'
                                for c, t in sorted(by_row[r]))
                body.append(f'<row r="{r + 1}">{cells}</row>')
            z.writestr(f"xl/worksheets/sheet{i + 1}.xml",
                       f'<?xml version="1.0" encoding="UTF-8"?><worksheet xmlns="{_NS["m"]}"><sheetData>'
                       + "".join(body) + "</sheetData></worksheet>")
    return buf.getvalue()


def _build_group(pdf: pd.DataFrame) -> pd.DataFrame:
    sheets: dict[str, list] = {}
    for s, r, c, v in zip(pdf["aba_nome"], pdf["linha"], pdf["coluna"], pdf["valor"]):
        if v is not None and not (isinstance(v, float) and pd.isna(v)):
            sheets.setdefault(s, []).append((int(r), int(c), str(v)))
    return pd.DataFrame({"arquivo_nome": [pdf["arquivo_nome"].iloc[0]], "content": [build_workbook(sheets)]})


def workbooks_from_cells(cells: DataFrame) -> DataFrame:
    """Fixture writer: one xlsx per file from long cells (a file is the unit
    of work, so one group per file)."""
    return cells.groupBy("arquivo_nome").applyInPandas(_build_group, "arquivo_nome string, content binary")
