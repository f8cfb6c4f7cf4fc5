"""Packages that hold files: archives, word-processor files, workbooks, portable documents and embedded objects.

Bytes are opened by small Python functions, one file at a time; everything after that is tables.  Each
function turns one file's bytes into a row of ``PARSED``: elements, sheet rows, embedded files and pictures.
"""

from __future__ import annotations

import io
import posixpath
import re
import zipfile
import zlib
from collections.abc import Callable, Iterator
from xml.etree import ElementTree

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quire.functions.text import control_trim

PARSED = (
    "elements array<struct<position:int,type:string,content:string,metadata:string>>,"
    "sheets array<struct<sheet:string,position:int,rows:array<array<string>>>>,"
    "embedded array<struct<file_name:string,position:int,data:binary>>,"
    "images array<struct<file_name:string,position:int,format:string,data:binary>>,"
    "error string"
)
#: Bytes that one archive may unpack to; beyond, the file is an error.
MOST_UNPACKED = 1 << 30
#: Bytes of files that are parsed before their rows are passed on.
TOGETHER = 4 << 20
#: Namespaces of office files (published; fixed values).
W = "{http://schemas.openxmlformats.org/wordprocessingml/2006/main}"
A = "{http://schemas.openxmlformats.org/drawingml/2006/main}"
S = "{http://schemas.openxmlformats.org/spreadsheetml/2006/main}"
R = "{http://schemas.openxmlformats.org/officeDocument/2006/relationships}"
P = "{http://schemas.openxmlformats.org/package/2006/relationships}"
C = "{http://schemas.openxmlformats.org/package/2006/content-types}"


def opened(data: bytes) -> zipfile.ZipFile:
    archive = zipfile.ZipFile(io.BytesIO(data))
    if sum(i.file_size for i in archive.infolist()) > MOST_UNPACKED:
        raise ValueError("archive unpacks to too many bytes")
    return archive


def parse_zip(data: bytes) -> dict:
    """Every entry that is no folder, numbered in the archive's order."""
    archive = opened(data)
    files = [i for i in archive.infolist() if not i.is_dir()]
    return {"embedded": [{"file_name": i.filename, "position": k, "data": archive.read(i)} for k, i in enumerate(files)]}


def _relations(archive: zipfile.ZipFile, part: str) -> dict[str, str]:
    """Targets of a part's relationships by id, as names in the archive."""
    folder, name = posixpath.split(part)
    rels = f"{folder}/_rels/{name}.rels"
    if rels not in archive.namelist():
        return {}
    return {r.get("Id"): posixpath.normpath(posixpath.join(folder, r.get("Target"))).lstrip("/") for r in ElementTree.fromstring(archive.read(rels)).iter(f"{P}Relationship")}


#: The same characters as ``functions.text.BLANK`` (fixed values), and those that are trimmed: all up to U+0020.
_BLANK = re.compile(r"[\x09-\x0d\x1c-\x20\u1680\u2000-\u2006\u2008-\u200a\u2028\u2029\u205f\u3000]*")
_ENDS = "".join(map(chr, range(33)))


def _text(node: ElementTree.Element) -> str:
    marks = {f"{W}tab": "\t", f"{W}br": "\n"}
    return "".join(marks.get(x.tag, (x.text or "") if x.tag == f"{W}t" else "") for x in node.iter())


def _grid(table: ElementTree.Element) -> list[list[str]]:
    return [[" ".join(_text(p) for p in cell.iter(f"{W}p")).strip() for cell in row.findall(f"{W}tc")] for row in table.findall(f"{W}tr")]


def markdown(grid: list[list[str]]) -> str:
    lines = ["| " + " | ".join(row) + " |" for row in grid]
    return "\n".join([*lines[:1], *(["| " + " | ".join("---" for _ in grid[0]) + " |"] if grid else []), *lines[1:]]).strip()


def content_types(archive: zipfile.ZipFile) -> Callable[[str], str | None]:
    """Content type of a part: its own, else that of its suffix, else none."""
    try:
        root = ElementTree.fromstring(archive.read("[Content_Types].xml"))
    except KeyError:
        return lambda part: None
    own = {e.get("PartName", "").lstrip("/"): e.get("ContentType") for e in root if e.tag == f"{C}Override"}
    by_suffix = {e.get("Extension", "").lower(): e.get("ContentType") for e in root if e.tag == f"{C}Default"}
    return lambda part: own.get(part) or by_suffix.get(part.rpartition(".")[2].lower())


def unboxed(name: str, data: bytes, kind: str | None = None) -> tuple[str, bytes]:
    """The file that an embedded object in the simple layout holds; other parts stay as they are.

    An object is known by its content type (``oleObject`` or ``ole`` in it), and by the suffix ``bin`` where a package tells none.
    """
    if not ("ole" in kind if kind else name.lower().endswith(".bin")):
        return name, data
    at = data[:260].find(b"\0")
    rest = data[at + 1 :]
    size = int.from_bytes(rest[:4], "little", signed=True)
    rest = rest[4 : 4 + size] if 0 < size <= len(rest) - 4 else rest
    return (data[:at].decode("latin-1").strip(), rest) if at > 0 and len(data) >= 4 and rest else (name, data)


def parse_docx(data: bytes) -> dict:
    """Headers, footers, then the body's paragraphs, tables and pictures in order, then embedded parts.

    All pictures of a paragraph share the running position, each of them moves it on by one, and an embedded
    part stands at the number of elements before it: positions may repeat.
    """
    archive = opened(data)
    names = archive.namelist()
    elements: list[dict] = []
    images: list[dict] = []
    add = lambda at, kind, text, meta=None: elements.append({"position": at, "type": kind, "content": text, "metadata": meta})
    for kind in ("header", "footer"):
        for part in sorted(n for n in names if n.startswith(f"word/{kind}") and n.endswith(".xml")):
            for block in ElementTree.fromstring(archive.read(part)):
                text = markdown(_grid(block)) if block.tag == f"{W}tbl" else _text(block)
                if not _BLANK.fullmatch(text):
                    add(len(elements), kind, text.strip(_ENDS))
    rels = _relations(archive, "word/document.xml")
    body = ElementTree.fromstring(archive.read("word/document.xml")).find(f"{W}body")
    at = len(elements)
    for block in body if body is not None else ():
        if block.tag == f"{W}tbl":
            add(at, "table", markdown(_grid(block)))
            at += 1
        elif block.tag == f"{W}p":
            shown = [rels[b.get(f"{R}embed")] for b in block.iter(f"{A}blip") if b.get(f"{R}embed") in rels]
            for target in shown:
                images.append({"file_name": posixpath.basename(target), "position": at, "format": target.rpartition(".")[2].lower(), "data": archive.read(target)})
            text = _text(block)
            told = not _BLANK.fullmatch(text)
            if told:
                add(at + len(shown), "paragraph", text.strip(_ENDS))
            at += len(shown) + told
    embedded, kinds = [], content_types(archive)
    for part in (n for n in names if "embeddings" in n and not n.endswith((".rels", "/"))):
        (name, content), place = unboxed(posixpath.basename(part), archive.read(part), kinds(part)), len(elements)
        add(place, "embed", None, f"file: {name}")
        embedded.append({"file_name": name, "position": place, "data": content})
    return {"elements": elements, "images": images, "embedded": embedded}


def _column(reference: str) -> int:
    out = 0
    for c in reference:
        if not c.isalpha():
            break
        out = out * 26 + ord(c.upper()) - 64
    return out - 1


def _number(text: str) -> str:
    """A number as cells show it: integral values without a fraction."""
    value = float(text)
    return str(int(max(-(2**63), min(2**63 - 1, value)))) if value == value and value == int(value) else repr(value)


def _cell(cell: ElementTree.Element, strings: list[str]) -> str:
    kind, value, formula = cell.get("t", "n"), cell.findtext(f"{S}v"), cell.findtext(f"{S}f")
    if kind == "inlineStr":
        return "".join(t.text or "" for t in cell.iter(f"{S}t"))
    if value is None:
        return formula or ""
    if kind == "s":
        return strings[int(value)]
    if kind == "b":
        return "true" if value == "1" else "false"
    if kind == "n":
        return str(float(value)) if formula is not None else _number(value)
    return value if kind == "str" else ""


def parse_xlsx(data: bytes) -> dict:
    """Each sheet as a header element and its rows; pictures follow after the last sheet.

    Whether rows become a table element or a large table is decided on tables (``operators.tables``); both
    take the position after the sheet's header.
    """
    archive = opened(data)
    strings = []
    if "xl/sharedStrings.xml" in archive.namelist():
        strings = ["".join(t.text or "" for t in item.iter(f"{S}t")) for item in ElementTree.fromstring(archive.read("xl/sharedStrings.xml")).findall(f"{S}si")]
    rels = _relations(archive, "xl/workbook.xml")
    elements, sheets, at = [], [], 0
    for sheet in ElementTree.fromstring(archive.read("xl/workbook.xml")).iter(f"{S}sheet"):
        name = sheet.get("name")
        elements.append({"position": at, "type": "sheet_header", "content": f"[Sheet: {name}]", "metadata": None})
        at += 1
        rows = []
        for row in ElementTree.fromstring(archive.read(rels[sheet.get(f"{R}id")])).iter(f"{S}row"):
            cells: list[str] = []
            for k, cell in enumerate(row.findall(f"{S}c")):
                place = _column(cell.get("r")) if cell.get("r") else k
                cells += [""] * (place - len(cells)) + [_cell(cell, strings)]
            rows.append(cells)
        if rows:
            sheets.append({"sheet": name, "position": at, "rows": rows})
            at += 1
    media = sorted(n for n in archive.namelist() if n.startswith("xl/media/"))
    kinds = {"png": "png", "jpeg": "jpg", "jpg": "jpg", "gif": "gif", "bmp": "bmp"}
    images = []
    for k, name in enumerate(media):
        kind = kinds.get(name.rpartition(".")[2].lower(), "png")
        images.append({"file_name": f"excel_image_{at + k}.{kind}", "position": at + k, "format": kind, "data": archive.read(name)})
    return {"elements": elements, "sheets": sheets, "images": images}


_STREAM = re.compile(rb"<<((?:[^<>]|<[^<]|>[^>]|<<(?:[^<>]|<[^<]|>[^>])*>>)*)>>\s*stream\r?\n(.*?)\r?\n?endstream", re.DOTALL)
_SHOWN = re.compile(rb"\((?:\\.|[^\\()])*\)|<[0-9A-Fa-f\s]*>|\[|\]|-?\d*\.?\d+|[A-Za-z*'\"]+", re.DOTALL)
_ESCAPES = {b"n": b"\n", b"r": b"\r", b"t": b"\t", b"b": b"\b", b"f": b"\f"}


def _string(token: bytes) -> str:
    """A literal or hexadecimal string of a page, read as Latin-1."""
    if token.startswith(b"<"):
        digits = b"".join(token[1:-1].split())
        return bytes.fromhex((digits + b"0" * (len(digits) % 2)).decode()).decode("latin-1")
    plain = re.sub(rb"\\([0-7]{1,3}|.)", lambda m: bytes([int(m[1], 8) & 255]) if m[1].isdigit() else _ESCAPES.get(m[1], m[1]), token[1:-1], flags=re.DOTALL)
    return plain.decode("latin-1")


def _page_lines(content: bytes) -> list[str]:
    """Lines of a page's text: operators that move to another line end one."""
    lines, held = [""], []
    for token in _SHOWN.findall(content):
        if token[:1] in b"(<":
            held.append(_string(token))
        elif token[:1].isalpha() or token in (b"'", b'"', b"T*"):
            if token in (b"'", b'"', b"T*", b"Td", b"TD", b"Tm", b"BT") and lines[-1]:
                lines.append("")
            if token in (b"Tj", b"TJ", b"'", b'"'):
                lines[-1] += "".join(held)
            held = []
    return lines


def parse_pdf(data: bytes) -> dict:
    """Non-blank lines of all pages, then page images with their stored bytes; streams in the order of the file."""
    lines, pictures = [], []
    for head, body in _STREAM.findall(data):
        if re.search(rb"/Subtype\s*/Image", head):
            pictures.append(("jpg" if b"/DCTDecode" in head else "png", body))
        elif not re.search(rb"/Type\s*/(?:XRef|ObjStm|Metadata)|/FontFile|/Length1", head):
            plain = zlib.decompressobj().decompress(body, MOST_UNPACKED) if b"/FlateDecode" in head else body
            if b"BT" in plain:
                lines += [x.strip() for x in _page_lines(plain) if x.strip()]
    elements = [{"position": k, "type": "paragraph", "content": x, "metadata": None} for k, x in enumerate(lines)]
    at = len(lines)
    return {"elements": elements, "images": [{"file_name": f"pdf_image_{at + k}.{kind}", "position": at + k, "format": kind, "data": body} for k, (kind, body) in enumerate(pictures)]}


PARSERS = {"pdf": parse_pdf, "zip": parse_zip, "docx": parse_docx, "xlsx": parse_xlsx}
_LISTS = ("elements", "sheets", "embedded", "images")


def parsed(files: DataFrame, fail_fast: bool = False, keep_content: bool = False, parsers: dict[str, Callable[[bytes], dict]] | None = None) -> DataFrame:
    """``files (..., parser, content)`` with the columns of ``PARSED`` in place of ``content``, or beside it if it is kept.

    A file that cannot be read gets its reason in ``error`` and empty lists, unless ``fail_fast``; so does
    one whose parser is not among ``parsers`` (``PARSERS`` and what is given here; a given parser comes first).
    """
    known = PARSERS | (parsers or {})
    keys = [c for c in files.columns if c != "content" or keep_content]
    schema = files.select(*keys).schema
    added = files.sparkSession.createDataFrame([], PARSED).schema

    def one(kind: str, content: bytes | None) -> dict:
        try:
            if kind not in known:
                raise ValueError(f"no parser for {kind}")
            return {"error": None} | known[kind](content or b"")
        except Exception as e:  # any damage of a file belongs to its row
            if fail_fast:
                raise
            return {"error": f"{type(e).__name__}: {e}"}

    from pyspark.sql.pandas.types import to_arrow_schema

    arrow = to_arrow_schema(added)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            begin, held, rows = 0, 0, []
            for k in range(batch.num_rows):  # few files at a time, as each may be large
                content = batch.column("content")[k].as_py()
                rows.append(one(batch.column("parser")[k].as_py(), content))
                held += len(content or b"")
                if held > TOGETHER or k + 1 == batch.num_rows:
                    new = [pa.array([row.get(f.name) if f.name == "error" else row.get(f.name) or [] for row in rows], f.type) for f in arrow]
                    yield pa.RecordBatch.from_arrays([*(batch.column(c).slice(begin, len(rows)) for c in keys), *new], names=[*keys, *arrow.names])
                    begin, held, rows = k + 1, 0, []

    return files.mapInArrow(work, type(schema)([*schema.fields, *added.fields]))


def _name_ends(blob: Column) -> Column:
    """Place of an embedded object's first NUL, from 1; null without four bytes, or a NUL within 260 of them."""
    at = F.position(F.lit(b"\x00"), blob)
    return F.when(at.between(1, 260) & (F.octet_length(blob) >= 4), at)


def object_name(blob: Column) -> Column:
    """File name at the start of an embedded object: the bytes before the first NUL, trimmed; null if there are none."""
    at = _name_ends(blob)
    return F.when(at > 1, control_trim(F.decode(F.substring(blob, F.lit(1), at - 1), "US-ASCII")))


def object_content(blob: Column) -> Column:
    """Content of an embedded object: after the first NUL, as many bytes as a little-endian length says if that fits, else all that is left."""
    start = _name_ends(blob)
    rest = F.substring(blob, start + 1, F.octet_length(blob))
    digits = F.hex(F.substring(rest, 1, 4))
    turned = F.concat(*[F.substring(digits, k, 2) for k in (7, 5, 3, 1)])
    length = F.conv(turned, 16, 10).cast("long")
    left = F.octet_length(rest)
    fits = (left >= 4) & (length > 0) & (length + 4 <= left)
    return F.when(fits, F.substring(rest, F.lit(5), length.cast("int"))).when(left > 0, rest)


def object_file(blob: Column) -> Column:
    """Name and content of an embedded object; null if it lacks either."""
    name, content = object_name(blob), object_content(blob)
    return F.when(name.isNotNull() & content.isNotNull(), F.struct(name.alias("file_name"), content.alias("data")))
