"""Archives, office files and embedded objects, on files made here."""

from __future__ import annotations

import io
import random
import zipfile

import pytest
from pyspark.sql import functions as F

from quire.functions import text
from quire.operators.naming import allocate
from quire.operators.tables import header_index, large_tables
from quire.plans.expand import expand
from quire.sources import packages
from quire.sources.sinks import inside, write_files

PNG = b"\x89PNG\r\n\x1a\n" + bytes(32)
_W = 'xmlns:w="http://schemas.openxmlformats.org/wordprocessingml/2006/main" xmlns:r="http://schemas.openxmlformats.org/officeDocument/2006/relationships" xmlns:a="http://schemas.openxmlformats.org/drawingml/2006/main"'
_S = 'xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main" xmlns:r="http://schemas.openxmlformats.org/officeDocument/2006/relationships"'
_RELS = '<Relationships xmlns="http://schemas.openxmlformats.org/package/2006/relationships">{}</Relationships>'


def archive(files):
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w") as z:
        for name, data in files.items():
            z.writestr(name, data)
    return out.getvalue()


def docx(body, files=None, pictures=()):
    rels = "".join(f'<Relationship Id="p{k}" Type="image" Target="media/{n}"/>' for k, n in enumerate(pictures))
    parts = {"word/document.xml": f"<w:document {_W}><w:body>{body}</w:body></w:document>", "word/_rels/document.xml.rels": _RELS.format(rels)}
    return archive(parts | {f"word/media/{n}": PNG for n in pictures} | (files or {}))


def par(text, *pictures):
    return f"<w:p>{''.join(f'<w:r><a:blip r:embed={chr(34)}p{k}{chr(34)}/></w:r>' for k in pictures)}<w:r><w:t>{text}</w:t></w:r></w:p>"


def xlsx(sheets):
    names = "".join(f'<sheet name="{n}" r:id="r{k}"/>' for k, n in enumerate(sheets))
    rels = "".join(f'<Relationship Id="r{k}" Type="sheet" Target="worksheets/s{k}.xml"/>' for k in range(len(sheets)))
    cell = lambda c, r, v: f'<c r="{chr(65 + c)}{r}" t="inlineStr"><is><t>{v}</t></is></c>' if isinstance(v, str) else f'<c r="{chr(65 + c)}{r}"><v>{v}</v></c>'
    rows = {f"xl/worksheets/s{k}.xml": f"<worksheet {_S}><sheetData>" + "".join(f'<row r="{r}">' + "".join(cell(c, r, v) for c, v in enumerate(row) if v is not None) + "</row>" for r, row in enumerate(grid, 1)) + "</sheetData></worksheet>" for k, grid in enumerate(sheets.values())}
    return archive({"xl/workbook.xml": f"<workbook {_S}><sheets>{names}</sheets></workbook>", "xl/_rels/workbook.xml.rels": _RELS.format(rels)} | rows)


def test_docx_numbers(spark):
    table = "<w:tbl><w:tr><w:tc><w:p><w:r><w:t>a</w:t></w:r></w:p></w:tc><w:tc><w:p/></w:tc></w:tr></w:tbl>"
    data = docx(par("first") + par("shown", 0, 1) + par("") + table, {"word/header1.xml": f"<w:hdr {_W}>{par('top')}</w:hdr>", "word/embeddings/in.zip": archive({})}, ["a.png", "b.png"])
    got = packages.parse_docx(data)
    assert [(e["position"], e["type"], e["content"]) for e in got["elements"]] == [(0, "header", "top"), (1, "paragraph", "first"), (4, "paragraph", "shown"), (5, "table", "| a |  |\n| --- | --- |"), (4, "embed", None)]
    assert [(i["file_name"], i["position"]) for i in got["images"]] == [("a.png", 2), ("b.png", 2)]
    assert got["elements"][-1]["metadata"] == "file: in.zip"


def test_empty_docx():
    assert packages.parse_docx(docx(""))["elements"] == []


def test_xlsx_cells():
    got = packages.parse_xlsx(xlsx({"one": [["h", None, 3], [1.5, "x"]], "empty": [], "two": [[1e300]]}))
    assert got["sheets"] == [{"sheet": "one", "position": 1, "rows": [["h", "", "3"], ["1.5", "x"]]}, {"sheet": "two", "position": 4, "rows": [["9223372036854775807"]]}]
    assert [e["position"] for e in got["elements"]] == [0, 2, 3]


def test_zip_entries():
    assert [(e["file_name"], e["position"], e["data"]) for e in packages.parse_zip(archive({"d/": b"", "d/a.bin": b"1", "b.bin": b"2"}))["embedded"]] == [("d/a.bin", 0, b"1"), ("b.bin", 1, b"2")]


@pytest.mark.parametrize(
    ("blob", "name", "content"),
    [(b"a.docx\x00hello!", "a.docx", b"hello!"), (b"x.b\x00\x03\x00\x00\x00abcd", "x.b", b"abc"), (b"\x00abcd", None, b"abcd"), (b"ab\x00", None, None), (b"plain text", None, None), (b"", None, None), (None, None, None), (b"large.bin\x00" + bytes(range(256)) * 4, "large.bin", bytes(range(256)) * 4)],
)
def test_embedded_object(spark, blob, name, content):
    row = spark.createDataFrame([(blob,)], "b binary").select(packages.object_name(F.col("b")), packages.object_content(F.col("b"))).first()
    assert (row[0], None if row[1] is None else bytes(row[1])) == (name, content)


def tables(spark, name, data, **how):
    got = expand(spark.createDataFrame([("s", name, bytearray(data))], "session_id string, file_name string, content binary"), **how)
    return [tuple(r) for r in got["docs"].orderBy("seq").select("seq", "dir", "parser", "parent", "depth").collect()], [tuple(r) for r in got["skipped"].select("file_name", "ext").collect()]


def test_nested_files(spark):
    inner = docx(par("deep"))
    middle = archive({"notes.txt": b"text", "inner.docx": inner})
    outer = docx(par("top", 0), {"word/embeddings/files.zip": middle}, ["pic.png"])
    docs, skipped = tables(spark, "outer.docx", outer)
    assert docs == [(0, "outer", "docx", "root", 0), (1, "files", "zip", "outer, pos=1", 1), (2, "inner", "docx", "files, pos=1", 2), (3, "pic", "image", "outer, pos=0", 1)]
    assert skipped == [("notes.txt", "txt")]


def test_pictures_that_hold_themselves(spark):
    docs, _ = tables(spark, "p.png", PNG, images_recurse=True)
    assert [d[1] for d in docs] == ["p", *(f"p_{k}" for k in range(2, 11))]
    docs, _ = tables(spark, "p.png", PNG)
    assert len(docs) == 1


def test_damaged_file(spark):
    docs = expand(spark.createDataFrame([("s", "a.docx", bytearray(b"PK\x03\x04 no archive"))], "session_id string, file_name string, content binary"))["docs"]
    # bytes of an archive that tell no office type go to the archive parser
    assert docs.select("parser", F.col("error").isNotNull()).first()[:] == ("zip", True)


def test_allocate():
    assert allocate(["a", "a", "a_2"]) == ["a", "a_2", "a_2_2"]
    assert allocate(["a_2", "a", "a"]) == ["a_2", "a", "a_3"]


def test_large_table(spark):
    rows = [(0, ["title"]), (1, [" h1 ", "", "h2"]), *((k, [f"v{k}", "", "w"]) for k in range(2, 60))]
    df = spark.createDataFrame([("s", *r) for r in rows], "sheet string, row_no int, cells array<string>")
    assert large_tables(df, ["sheet"]).first()[:] == ("s", 60, 1, "h1 | h2", "Columns: h1 | h2\nRow 1: v2, w\nRow 2: v3, w")
    wide = spark.createDataFrame([("s", 0, [str(k) for k in range(11)])], df.schema)
    assert large_tables(wide, ["sheet"]).count() == 1


def test_header_index(spark):
    df = spark.createDataFrame([([["a"], ["b", " "], ["c", "d"]],), ([["a"]],), ([],)], "g array<array<string>>")
    assert [r[0] for r in df.select(header_index(F.col("g"))).collect()] == [2, 0, 0]


def test_write_files(spark, tmp_path):
    df = spark.createDataFrame([("d/a.md", "text"), ("b.csv", "1,2\n")], "path string, content string")
    assert sorted(r[1] for r in write_files(df, f"file://{tmp_path}").collect()) == [4, 4]
    assert (tmp_path / "d/a.md").read_text() == "text"
    with pytest.raises(ValueError, match="inside"):
        inside("../x")


def test_stream(spark, tmp_path):
    from quire.streaming.incremental import extract_stream

    (tmp_path / "in").mkdir()
    (tmp_path / "in/a.docx").write_bytes(docx(par("one")))
    for _ in range(2):
        extract_stream(spark, str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "mark")).awaitTermination(120)
    assert spark.read.parquet(str(tmp_path / "out")).select("dir").collect()[0][0] == "a"
    (tmp_path / "in/b.docx").write_bytes(docx(par("two")))
    extract_stream(spark, str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "mark")).awaitTermination(120)
    assert sorted(r[0] for r in spark.read.parquet(str(tmp_path / "out")).select("dir").collect()) == ["a", "b"]


def pdf(lines, picture=None, packed=False):
    import zlib

    page = b"BT /F1 12 Tf 50 700 Td " + b" ".join(b"(%s) Tj 0 -15 Td" % x.encode("latin-1").replace(b"(", b"\\(").replace(b")", b"\\)") for x in lines) + b" ET"
    body = zlib.compress(page) if packed else page
    out = b"%PDF-1.4\n4 0 obj\n<< /Length " + str(len(body)).encode() + (b" /Filter /FlateDecode" if packed else b"") + b" >>\nstream\n" + body + b"\nendstream\nendobj\n"
    if picture:
        out += b"5 0 obj\n<< /Type /XObject /Subtype /Image /Filter /DCTDecode /Width 1 >>\nstream\n" + picture + b"\nendstream\nendobj\n"
    return out + b"%%EOF"


@pytest.mark.parametrize("packed", [False, True])
def test_pdf(packed):
    got = packages.parse_pdf(pdf(["First line", " ", "(second) é"], b"\xff\xd8\xffraw", packed))
    assert [(e["position"], e["content"]) for e in got["elements"]] == [(0, "First line"), (1, "(second) é")]
    assert [(i["file_name"], i["position"], i["format"], i["data"]) for i in got["images"]] == [("pdf_image_2.jpg", 2, "jpg", b"\xff\xd8\xffraw")]
    assert packages.parse_pdf(pdf([])) == {"elements": [], "images": []}


def test_boxed_object(spark):
    box = b"inside.docx\x00" + docx(par("in a box"))
    docs, skipped = tables(spark, "o.docx", docx(par("x"), {"word/embeddings/oleObject1.bin": box, "word/embeddings/raw.bin": b"\x00\x01"}))
    assert [d[:3] for d in docs] == [(0, "o", "docx"), (1, "inside", "docx")]
    assert skipped == [("raw.bin", "bin")]


def test_rescan(spark, tmp_path):
    from quire.plans.corpus import index_json
    from quire.sources import rescan

    tables_ = F.expr("array(named_struct('position', 3, 'sheet', 'S 1', 'row_count', 60L, 'file', 'S_1'))")
    text = spark.range(1).select(index_json(F.lit("d/d.md"), F.lit(60), F.lit(0), tables_).alias("j")).first()[0]
    (tmp_path / "d/chunks").mkdir(parents=True)
    (tmp_path / "d/chunks/index.json").write_text(text)
    got = rescan.units(rescan.indexes(spark, f"{tmp_path}/*/chunks/index.json")).orderBy("task_type", "file").collect()
    assert [tuple(r) for r in got] == [("d", "chunk", "chunks/chunk_0001.md"), ("d", "chunk", "chunks/chunk_0002.md"), ("d", "csv", "data/S_1.csv")]
    assert rescan.texts(spark, f"{tmp_path}/*/chunks/index.json").first().value == text


def test_trimmed_paragraphs():
    """Paragraphs lose characters up to U+0020 at both ends; no-break spaces are neither trimmed nor blank."""
    got = packages.parse_docx(docx(par("  padded \t") + par("\u3000 ") + par("\u00a0") + par("\u00a0kept\u00a0")))
    assert [(e["position"], e["content"]) for e in got["elements"]] == [(0, "padded"), (1, "\u00a0"), (2, "\u00a0kept\u00a0")]


def test_object_guards(spark):
    """Without four bytes, or a NUL within 260 of them, an object has neither name nor content."""
    blobs = [b"a\0b", b"ab\0", b"\0abcd", b"x" * 260 + b"\0yy", b"x" * 259 + b"\0yy", b"n.txt\0\x02\0\0\0hi!", b"n \0data", None]
    df = spark.createDataFrame([(k, None if b is None else bytearray(b)) for k, b in enumerate(blobs)], "k int, b binary")
    got = {r[0]: r[1] for r in df.select("k", packages.object_file(F.col("b"))).collect()}
    assert [got[k] is None for k in range(8)] == [True, True, True, True, False, False, False, True]
    assert bytes(got[4].data) == b"yy"
    assert (got[5].file_name, bytes(got[5].data)) == ("n.txt", b"hi")
    assert (got[6].file_name, bytes(got[6].data)) == ("n", b"data")


def test_own_parser(spark):
    """A parser that is given takes its suffix before the known ones, and files that were unsupported."""
    own = {"txt": lambda data: {"elements": [{"position": 0, "type": "note", "content": data.decode(), "metadata": None}]}}
    df = spark.createDataFrame([("s", "a.txt", bytearray(b"hello"))], "session_id string, file_name string, content binary")
    docs = expand(df, parsers=own)["docs"].collect()
    assert [(d.parser, d.elements[0].content) for d in docs] == [("txt", "hello")]
    assert expand(df)["docs"].count() == 0


def test_distinct_names(spark):
    cases = [["a", "a", "a_2"], ["a_2", "a", "a"], [], ["x"] * 5]
    df = spark.createDataFrame([(c,) for c in cases], "n array<string>")
    assert [r[0] for r in df.select(text.distinct_names(F.col("n"))).collect()] == [allocate(c) for c in cases]
    rng = random.Random(5)
    cases = [[rng.choice(["a", "b", "a_2", "a_3", "a_2_2", "b_2_2", "a_02"]) for _ in range(rng.randrange(25))] for _ in range(60)] + [["same"] * 600]
    df = spark.createDataFrame(list(enumerate(cases)), "k int, n array<string>")
    assert [r[0] for r in df.orderBy("k").select(text.distinct_names(F.col("n"))).collect()] == [allocate(c) for c in cases]
    pictures = spark.createDataFrame([(["p.png", "p.png", "p_2.png", "q"],)], "n array<string>")
    assert pictures.select(text.distinct_names(F.col("n"), dotted=True)).first()[0] == ["p.png", "p_2.png", "p_2_2.png", "q"]


def test_corpus_round_trip(spark, tmp_path):
    """A word-processor file with a workbook in it becomes a folder of files, and is read back from there."""
    import json

    from quire.sources import rescan
    from quire.sources.sinks import write_corpus

    grid = [["id", "name, full", "x"], *([str(k), f"n{k}", 'say "hi"'] for k in range(59))]
    small = [["a", "b"], ["1", "2"]]
    book = xlsx({"Big Data": [[c.replace('"', "&quot;") for c in row] for row in grid], "Big_Data": grid, "Small": small})
    outer = docx(par("Hello"), {"word/embeddings/big.xlsx": book})
    sources = spark.createDataFrame([("s1", "in/p.docx", bytearray(outer)), ("s2", "none.docx", bytearray(docx("")))], "session_id string, file_name string, content binary")
    written = write_corpus(expand(sources, keep_content=True)["docs"], f"file://{tmp_path}").collect()
    paths = sorted(r.path for r in written)
    assert paths == sorted(
        ["s1/manifest.json", "s1/in_p/in_p.md", "s1/in_p/p.docx", "s1/in_p/chunks/index.json", "s1/in_p/chunks/chunk_0001.md"]
        + [f"s1/big/{x}" for x in ("big.md", "big.xlsx", "chunks/index.json", "chunks/chunk_0001.md", "data/Big_Data.csv", "data/Big_Data_2.csv")]
        + ["s2/manifest.json", "s2/none/none.md", "s2/none/none.docx", "s2/none/chunks/index.json", "s2/none/chunks/chunk_0001.md"]
    )
    assert (tmp_path / "s1/in_p/p.docx").read_bytes() == outer
    csv = (tmp_path / "s1/big/data/Big_Data.csv").read_text().split("\n")
    assert len(csv) == 61
    assert csv[0] == 'id,"name, full",x'
    assert csv[1] == '0,n0,"say ""hi"""'
    body = (tmp_path / "s1/big/big.md").read_text()
    assert body.startswith("# DOC: 1\n# SOURCE: big.xlsx\n# PARENT: in_p, pos=1\n\n# POS: 0 | TYPE: sheet_header\n")
    assert "| TYPE: data_ref | schema: id | name, full | x | rows: 60 | file: data/Big_Data_2.csv\nColumns: id | name, full | x\nRow 1: 0, n0, say" in body
    assert "| a | b |\n| --- | --- |\n| 1 | 2 |" in body
    assert "PARENT" not in (tmp_path / "s1/in_p/in_p.md").read_text()
    assert "TYPE: embed" in (tmp_path / "s1/in_p/in_p.md").read_text()
    index = json.loads((tmp_path / "s1/big/chunks/index.json").read_text())
    assert (index["total_elements"], index["total_large_tables"], [t["name"] for t in index["large_tables"]]) == (4, 2, ["Big_Data.csv", "Big_Data_2.csv"])
    docs = rescan.manifests(spark, f"{tmp_path}/*/manifest.json").orderBy("session_id", "seq").collect()
    assert [(d.session_id, d.seq, d.dir, d.type, d.element_count, d.data_ref_count, d.parent) for d in docs] == [("s1", 0, "in_p", "docx", 2, 0, "root"), ("s1", 1, "big", "xlsx", 4, 2, "in_p, pos=1"), ("s2", 0, "none", "docx", 0, 0, "root")]
    units = {tuple(r) for r in rescan.units(rescan.indexes(spark, f"{tmp_path}/*/*/chunks/index.json")).collect()}
    assert ("big", "csv", "data/Big_Data_2.csv") in units


def test_pictures_in_a_corpus(spark, tmp_path):
    """Pictures are written under distinct names, the body refers to those, and each is a document of its own."""
    from quire.plans.corpus import corpus_files

    source = docx(par("", 0, 1), pictures=["p q.png", "p_q.png"])
    docs = expand(spark.createDataFrame([("s", "d.docx", bytearray(source))], "session_id string, file_name string, content binary"), keep_content=True)["docs"]
    files = {r.path: bytes(r.content) for r in corpus_files(docs).collect()}
    assert files["s/d/media/p_q.png"] == files["s/d/media/p_q_2.png"] == PNG
    assert b"file: media/p_q_2.png" in files["s/d/d.md"]
    assert b'"image_count":2' in files["s/manifest.json"]
    assert {"s/p_q/p_q.md", "s/p_q_2/p_q.md", "s/p_q_2/media/p_q.png"} <= set(files)
