"""Column functions on the cases where notions of white space, names and numbers part ways."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from quire.functions import detect, text


def values(spark, column, rows, kind="string"):
    df = spark.createDataFrame([(k, r) for k, r in enumerate(rows)], f"k int, x {kind}")
    return [r[0] for r in df.orderBy("k").select(column(F.col("x"))).collect()]


def test_control_trim(spark):
    assert values(spark, text.control_trim, [" a\t", "\x00b\x1f", "　c", " d", "", None]) == ["a", "b", "　c", " d", "", None]


def test_is_blank(spark):
    assert values(spark, text.is_blank, ["", " \t", "　", " ", " ", " ", "\x85", "a", "\n"]) == [True, True, True, False, False, False, False, False, True]


def test_lines(spark):
    assert values(spark, text.lines, ["a\r\n\n b \n", "", None, "　\nx"]) == [["a", "b"], [], [], ["x"]]


@pytest.mark.parametrize(
    ("name", "base"),
    [("Annual plan [draft 3].xlsx", "Annual_plan_draft_3"), ("会议记录-1.0.pdf", "会议记录-1.0"), ("a&&b%%c.zip", "a_b_c"), ("README", "README"), ("", "unknown"), (None, "unknown"), (".hidden", "hidden"), ("___.x", "unknown"), ("a/b.docx", "a_b"), ("..", "unknown")],
)
def test_base_name(spark, name, base):
    assert values(spark, text.base_name, [name]) == [base]


def test_safe_file_name(spark):
    assert values(spark, text.safe_file_name, ["a.b c-d_e", "图1.png"]) == ["a_b_c-d_e", "图1_png"]


def test_csv_field(spark):
    assert values(spark, text.csv_field, ["a", "a,b", 'say "x"', "two\nlines", "cr\r", None]) == ["a", '"a,b"', '"say ""x"""', '"two\nlines"', "cr\r", ""]


def test_json_text(spark):
    assert values(spark, text.json_text, ['\\ " \n \r \t', None]) == ['\\\\ \\" \\n \\r \\t', ""]


def test_number_text(spark):
    assert values(spark, text.number_text, [3.0, -2.5, 1e300, -1e300, 12345678.5, 0.0], "double") == ["3", "-2.5", "9223372036854775807", "-9223372036854775808", "1.23456785E7", "0"]


def test_cell_text(spark):
    rows = [(6.0, None, None, None), (6.0, None, None, "A1*2"), (None, "x", None, "A1"), (None, None, None, "A1"), (None, None, True, None), (None, None, None, None)]
    df = spark.createDataFrame(rows, "n double, s string, b boolean, f string")
    got = [r[0] for r in df.select(text.cell_text(F.col("n"), F.col("s"), F.col("b"), F.col("f"))).collect()]
    assert got == ["6", "6.0", "x", "A1", "true", ""]


def test_markdown_table(spark):
    df = spark.createDataFrame([([["a", " b "], ["1"]],)], "rows array<array<string>>")
    assert df.select(text.markdown_table(F.col("rows"), False), text.markdown_table(F.col("rows"), True)).first()[:] == ("| a |  b  |\n| --- | --- |\n| 1 |", "| a | b |\n| --- | --- |\n| 1 |")


@pytest.mark.parametrize(
    ("content", "name", "kind", "ext", "parser"),
    [
        (b"%PDF-1.4", "x.docx", "application/pdf", "pdf", "pdf"),
        (b"\x89PNG\r\n\x1a\n", "x", "image/png", "png", "image"),
        (b"\xff\xd8\xff\xe0", None, "image/jpeg", "jpg", "image"),
        (b"RIFF\x00\x00\x00\x00WEBP", "a.bin", "image/webp", "webp", "image"),
        (b"plain text", "mydoc.docx", detect.UNKNOWN, "docx", "docx"),
        (b"", "t.XLS", detect.UNKNOWN, "xls", "xlsx"),
        (None, "noext", detect.UNKNOWN, "bin", None),
        (b"plain", "notes.txt", detect.UNKNOWN, "txt", None),
        (b"PK\x03\x04" + bytes(26) + b"word/document.xml", "a.xlsx", "application/vnd.openxmlformats-officedocument.wordprocessingml.document", "docx", "docx"),
        (b"PK\x03\x04" + bytes(26) + b"inner.docx....word/document.xml", "a.bin", "application/zip", "zip", "zip"),
    ],
)
def test_detection(spark, content, name, kind, ext, parser):
    df = spark.createDataFrame([(content, name)], "content binary, file_name string").withColumn("kind", detect.media_type(F.col("content")))
    df = df.withColumn("ext", detect.suffix(F.col("kind"), F.col("file_name")))
    assert df.select("kind", "ext", detect.parser(F.col("ext"), F.col("file_name"))).first()[:] == (kind, ext, parser)
