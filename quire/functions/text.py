"""Column functions on text: white space, names, quoting, number formats."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Largest double below 2**63, and the bounds that integral values saturate at (fixed values).
LONG_MAX, LONG_MIN = 9223372036854775807, -9223372036854775808

#: Characters that count as white space when a line is tested for being blank (fixed values): no-break spaces are not among them.
BLANK = r"\x09-\x0d\x1c-\x20\x{1680}\x{2000}-\x{2006}\x{2008}-\x{200a}\x{2028}\x{2029}\x{205f}\x{3000}"
#: Characters that file names keep (fixed values).
NAME_KEEPS = r"a-zA-Z0-9\x{4e00}-\x{9fa5}_-"


def control_trim(text: Column) -> Column:
    """``text`` without characters up to U+0020 at both ends."""
    return F.regexp_replace(text, r"\A[\x00-\x20]+|[\x00-\x20]+\z", "")


def is_blank(text: Column) -> Column:
    """Whether ``text`` is empty or Unicode white space only."""
    return text.rlike(rf"\A[{BLANK}]*\z")


def lines(text: Column) -> Column:
    """The trimmed non-blank lines of ``text`` as an array; null has none."""
    split = F.split(F.coalesce(text, F.lit("")), r"\r?\n")
    return F.transform(F.filter(split, lambda x: ~is_blank(x)), control_trim)


def base_name(file_name: Column) -> Column:
    """Directory base of a file name: no suffix, odd characters as single ``_``, no ``.`` or ``_`` at the ends, ``unknown`` if nothing is left."""
    stem = F.regexp_replace(file_name, r"(?s)\A(.+)\.[^.]*\z", "$1")
    safe = F.regexp_replace(F.regexp_replace(stem, f"[^.{NAME_KEEPS}]", "_"), "_+", "_")
    cut = F.regexp_replace(safe, r"\A[._]+|[._]+\z", "")
    return F.when(F.coalesce(cut, F.lit("")) == "", "unknown").otherwise(cut)


def safe_file_name(name: Column) -> Column:
    """``name`` with every character that a file name should not have as ``_``; the dot is one of them."""
    return F.regexp_replace(name, f"[^{NAME_KEEPS}]", "_")


def last_segment(path: Column) -> Column:
    """What follows the last ``/``."""
    return F.substring_index(path, "/", -1)


def csv_field(value: Column) -> Column:
    """A CSV field, quoted if it holds a comma, quote or line feed; null is empty."""
    quoted = F.concat(F.lit('"'), F.replace(value, F.lit('"'), F.lit('""')), F.lit('"'))
    return F.coalesce(F.when(value.rlike('[,"\n]'), quoted).otherwise(value), F.lit(""))


def csv_line(cells: Column) -> Column:
    """One CSV line of an array of cells."""
    return F.array_join(F.transform(cells, csv_field), ",")


def json_text(value: Column) -> Column:
    """The inside of a JSON string with the five common escapes; null is empty."""
    out = F.coalesce(value, F.lit(""))
    for plain, escaped in (("\\", "\\\\"), ('"', '\\"'), ("\n", "\\n"), ("\r", "\\r"), ("\t", "\\t")):
        out = F.replace(out, F.lit(plain), F.lit(escaped))
    return out


def number_text(value: Column) -> Column:
    """A numeric cell as text: integral values without a fraction and held within 64 bits, others as doubles are written."""
    whole = (
        F.when(value >= 9.223372036854775807e18, F.lit(LONG_MAX))
        .when(value <= -9.223372036854775808e18, F.lit(LONG_MIN))
        .otherwise(value.try_cast("long"))
    )
    finite = ~F.isnan(value) & (F.abs(value) != float("inf"))
    return F.when(finite & (value == F.rint(value)), whole.cast("string")).otherwise(value.cast("string"))


def cell_text(number: Column, text: Column, flag: Column, formula: Column) -> Column:
    """A workbook cell as text; a formula's cached number keeps its fraction, and empty cells are empty strings."""
    cached = F.coalesce(number.cast("string"), text, formula)
    plain = F.coalesce(number_text(number), text, flag.cast("string"), F.lit(""))
    return F.when(formula.isNotNull(), cached).otherwise(plain)


def session_id(at: Column) -> Column:
    """Name of an extraction session that began at ``at``."""
    return F.concat(F.lit("extract_"), F.date_format(at, "yyyyMMdd_HHmmss"))


def evidence(text: Column, most: int) -> Column:
    """At most ``most`` characters of ``text``."""
    return F.substring(text, 1, most)


def markdown_table(rows: Column, trimmed: bool) -> Column:
    """A Markdown table of an array of arrays of cells: a rule after the first row, as wide as that row; rows may differ in width."""
    cell = control_trim if trimmed else (lambda c: c)
    line = lambda row: F.concat(F.lit("| "), F.array_join(F.transform(row, cell), " | "), F.lit(" |"))
    rule = lambda row: F.concat(F.lit("| "), F.array_join(F.transform(row, lambda _: F.lit("---")), " | "), F.lit(" |"))
    body = F.transform(rows, lambda row, i: F.when(i == 0, F.concat(line(row), F.lit("\n"), rule(row))).otherwise(line(row)))
    return control_trim(F.array_join(body, "\n"))


def distinct_names(names: Column, dotted: bool = False) -> Column:
    """An array of names made distinct in order: a name that is taken gets ``_2``, ``_3``, ... until it is free.

    With ``dotted`` the number stands before the suffix after the last dot.  For the short lists that a document holds.
    """

    def numbered(name: Column, k: Column) -> Column:
        if not dotted:
            return F.when(k == 1, name).otherwise(F.concat_ws("_", name, k.cast("string")))
        stem, suffix = F.regexp_extract(name, r"(?s)\A(.*?)(\.[^.]*)?\z", 1), F.regexp_extract(name, r"(?s)\A(.*?)(\.[^.]*)?\z", 2)
        return F.when(k == 1, name).otherwise(F.concat(stem, F.lit("_"), k.cast("string"), suffix))

    # the numbers below the count of earlier equal names are taken; beyond it, only names that look numbered can be in the way
    earlier = F.transform(names, lambda x, i: F.struct(x.alias("name"), F.size(F.filter(F.slice(names, F.lit(1), i), lambda y: y == x)).alias("n")))
    odd = F.size(F.filter(names, lambda x: x.rlike(r"_[0-9]+(\.[^.]*)?\z")))

    def add(taken: Column, own: Column) -> Column:
        tried = F.transform(F.sequence(own["n"] + 1, own["n"] + odd + 1), lambda k: numbered(own["name"], k))
        return F.concat(taken, F.slice(F.filter(tried, lambda x: ~F.array_contains(taken, x)), 1, 1))

    return F.aggregate(earlier, F.array().cast("array<string>"), add)


def plain_file_name(path: Column) -> Column:
    """The last segment of a path as a name that stays in its folder: odd characters as ``_``, dots kept, none at the start; ``unknown`` if nothing is left."""
    last = F.regexp_replace(F.regexp_extract(F.coalesce(path, F.lit("")), r"(?s)([^/\\]*)\z", 1), f"[^.{NAME_KEEPS}]", "_")
    cut = F.regexp_replace(last, r"\A\.+", "")
    return F.when(cut == "", "unknown").otherwise(cut)
