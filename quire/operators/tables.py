"""Sheets as rows of cells: small or large, header row, schema, preview, CSV and Markdown."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quire.functions.text import control_trim, csv_line, distinct_names, markdown_table, safe_file_name

MOST_ROWS, MOST_COLUMNS = 50, 10
HEADER_CELLS = 2
PREVIEW_ROWS = 2


def filled(cells: Column) -> Column:
    """The cells that hold something, trimmed."""
    return F.filter(F.transform(cells, lambda c: control_trim(F.coalesce(c, F.lit("")))), lambda c: c != "")


def classify(rows: DataFrame, sheet: list[str]) -> DataFrame:
    """``(sheet, row_count, first_width, is_large)`` of ``rows (sheet, row_no, cells)``.

    Large means more than fifty rows, or a first row that is empty or wider than ten cells.
    """
    found = rows.groupBy(*sheet).agg(F.count("*").alias("row_count"), F.min_by(F.size("cells"), "row_no").alias("first_width"))
    return found.withColumn("is_large", (F.col("row_count") > MOST_ROWS) | (F.col("first_width") == 0) | (F.col("first_width") > MOST_COLUMNS))


def header_index(grid: Column) -> Column:
    """Index of the first row of ``grid`` (an array of rows) with two filled cells; 0 if there is none."""
    found = F.array_position(F.transform(grid, lambda row: F.size(filled(row)) >= HEADER_CELLS), True)
    return F.greatest(found - 1, F.lit(0)).cast("int")


def large_tables(rows: DataFrame, sheet: list[str]) -> DataFrame:
    """``(sheet, row_count, header_row, schema_text, preview)`` of the large sheets.

    Only the header and the two rows after it are brought together for a sheet; the rest of its
    rows is counted where it lies.
    """
    facts = rows.groupBy(*sheet).agg(
        F.count("*").alias("row_count"),
        F.min_by(F.size("cells"), "row_no").alias("first_width"),
        F.coalesce(F.min(F.when(F.size(filled(F.col("cells"))) >= HEADER_CELLS, F.col("row_no"))), F.lit(0)).alias("header_row"),
    )
    large = facts.where(f"row_count > {MOST_ROWS} or first_width = 0 or first_width > {MOST_COLUMNS}")
    shown = rows.join(large, sheet).where(F.col("row_no").between(F.col("header_row"), F.col("header_row") + PREVIEW_ROWS))
    place = (F.col("row_no") - F.col("header_row")).alias("place")
    top = shown.groupBy(*sheet, "row_count", "header_row").agg(F.sort_array(F.collect_list(F.struct(place, filled(F.col("cells")).alias("cells")))).alias("top"))
    schema = F.array_join(F.col("top")[0]["cells"], " | ")
    told = F.transform(F.slice("top", 2, PREVIEW_ROWS), lambda r: F.concat(F.lit("Row "), r["place"].cast("string"), F.lit(": "), F.array_join(r["cells"], ", ")))
    preview = control_trim(F.array_join(F.concat(F.array(F.concat(F.lit("Columns: "), schema)), told), "\n"))
    return top.select(*sheet, "row_count", "header_row", schema.alias("schema_text"), preview.alias("preview"))


def small_tables(rows: DataFrame, sheet: list[str], trimmed: bool = False) -> DataFrame:
    """``(sheet, markdown)`` of the sheets that are not large; these have fifty rows at most."""
    small = classify(rows, sheet).where("not is_large").select(*sheet)
    grid = F.transform(F.sort_array(F.collect_list(F.struct("row_no", "cells"))), lambda r: r["cells"])
    return rows.join(small, sheet, "left_semi").groupBy(*sheet).agg(markdown_table(grid, trimmed).alias("markdown"))


def csv_lines(rows: DataFrame, sheet: list[str]) -> DataFrame:
    """``(sheet, row_no, line)``: each row as a line of the sheet's CSV file."""
    return rows.select(*sheet, "row_no", csv_line(F.col("cells")).alias("line"))


def data_ref(position: Column, schema: Column, rows: Column, name: Column) -> Column:
    """The line that stands for a large table in a body file."""
    return F.concat(F.lit("# POS: "), position.cast("string"), F.lit(" | TYPE: data_ref | schema: "), schema, F.lit(" | rows: "), rows.cast("string"), F.lit(" | file: data/"), safe_file_name(name), F.lit(".csv"))


def grid_is_large(grid: Column) -> Column:
    """Whether an array of rows is a large table, as in ``classify``."""
    width = F.size(F.get(grid, F.lit(0)))
    return (F.size(grid) > MOST_ROWS) | (width == 0) | (width > MOST_COLUMNS)


def _large(sheet: Column) -> Column:
    """What a document tells of a large sheet, with its CSV text."""
    grid = sheet["rows"]
    header = header_index(grid)
    schema = F.array_join(filled(F.get(grid, header)), " | ")
    told = F.transform(F.slice(grid, header + 2, PREVIEW_ROWS), lambda row, k: F.concat(F.lit("Row "), (k + 1).cast("string"), F.lit(": "), F.array_join(filled(row), ", ")))
    preview = control_trim(F.array_join(F.concat(F.array(F.concat(F.lit("Columns: "), schema)), told), "\n"))
    csv = F.array_join(F.transform(grid, lambda row: F.concat(csv_line(row), F.lit("\n"))), "")
    return F.struct(sheet["position"].alias("position"), schema.alias("schema_text"), F.size(grid).alias("row_count"), sheet["sheet"].alias("sheet"), preview.alias("preview"), csv.alias("csv"))


def with_tables(docs: DataFrame) -> DataFrame:
    """``docs (..., elements, sheets)`` with small sheets among ``elements`` and large ones in ``tables``; ``sheets`` goes.

    ``tables`` is an array of (position, schema_text, row_count, sheet, preview, csv, file); ``file`` is the base of the name
    of its CSV file, distinct within the document.  All of it is on the document's row: sheets do not shuffle.
    """
    some = F.filter("sheets", lambda s: F.size(s["rows"]) > 0)
    markdown = lambda s: F.struct(s["position"].alias("position"), F.lit("table").alias("type"), markdown_table(s["rows"], False).alias("content"), F.lit(None).cast("string").alias("metadata"))
    small = F.transform(F.filter(some, lambda s: ~grid_is_large(s["rows"])), markdown)
    elements = F.when(F.size("sheets") > 0, F.sort_array(F.concat("elements", small.cast(docs.schema["elements"].dataType)))).otherwise(F.col("elements"))
    found = docs.withColumn("elements", elements).withColumn("tables", F.transform(F.filter(some, lambda s: grid_is_large(s["rows"])), _large)).drop("sheets")
    files = distinct_names(F.transform("tables", lambda t: safe_file_name(t["sheet"])))
    named = F.zip_with("tables", files, lambda t, name: F.struct(*[t[n].alias(n) for n in ("position", "schema_text", "row_count", "sheet", "preview", "csv")], name.alias("file")))
    return found.withColumn("tables", named)
