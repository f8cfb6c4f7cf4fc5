"""File types from leading bytes and names, and the parser that each goes to."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Leading bytes in hexadecimal and their media types (published signatures; fixed values).
SIGNATURES = (
    ("255044462D", "application/pdf"),
    ("89504E470D0A1A0A", "image/png"),
    ("FFD8FF", "image/jpeg"),
    ("47494638", "image/gif"),
    ("424D", "image/bmp"),
    ("49492A00", "image/tiff"),
    ("4D4D002A", "image/tiff"),
    ("D0CF11E0A1B11AE1", "application/x-ole-storage"),
    ("504B0304", "application/zip"),
    ("504B0506", "application/zip"),
)
UNKNOWN = "application/octet-stream"
#: What the first entry of an office file is called, or begins with (fixed values).
OFFICE_ENTRIES = ("[Content_Types].xml", "_rels/", "docProps/", "customXml/", "word/", "xl/")
#: Suffix of each media type that decides it alone (fixed values).
SUFFIXES = {
    "application/pdf": "pdf",
    "application/msword": "doc",
    "application/vnd.ms-excel": "xls",
    "application/vnd.openxmlformats-officedocument.wordprocessingml.document": "docx",
    "application/vnd.openxmlformats-officedocument.spreadsheetml.sheet": "xlsx",
    "application/zip": "zip",
    "image/png": "png",
    "image/jpeg": "jpg",
    "image/gif": "gif",
    "image/bmp": "bmp",
    "image/tiff": "tiff",
    "image/webp": "webp",
}
#: Suffixes of pictures (fixed values).
IMAGE_SUFFIXES = ("png", "jpg", "jpeg", "gif", "bmp", "tiff", "tif", "webp")
#: Parsers in order of priority, with the suffixes that they take (fixed values).
PARSERS = (
    ("docx", ("docx", "docm")),
    ("doc", ("doc",)),
    ("xlsx", ("xlsx", "xls")),
    ("pdf", ("pdf",)),
    ("zip", ("zip",)),
    ("image", IMAGE_SUFFIXES),
)


def media_type(content: Column) -> Column:
    """Media type by leading bytes; a container of office parts is told by the main part's name, which the archive's directory holds in clear."""
    head = F.hex(F.substring(content, 1, 16))
    office = {
        "word/document.xml": "application/vnd.openxmlformats-officedocument.wordprocessingml.document",
        "xl/workbook.xml": "application/vnd.openxmlformats-officedocument.spreadsheetml.sheet",
    }
    first = F.substring(content, 31, 32).cast("string")  # the first entry's name, so that an archive of office files is not taken for one
    begins = reduce(lambda x, y: x | y, [F.coalesce(first.startswith(n), F.lit(False)) for n in OFFICE_ENTRIES])
    holds = lambda name: begins & (F.position(F.lit(name.encode()), content) > 0)
    out = F.when(content.isNull() | (F.octet_length(content) == 0), UNKNOWN)
    for name, kind in office.items():
        out = out.when(head.startswith("504B0304") & holds(name), kind)
    out = out.when(head.startswith("52494646") & (F.substring(head, 17, 8) == "57454250"), "image/webp")
    for signature, kind in SIGNATURES:
        out = out.when(head.startswith(signature), kind)
    return out.otherwise(UNKNOWN)


def name_suffix(name: Column) -> Column:
    """Lower-case suffix after the last dot, ``bin`` if there is none."""
    found = F.lower(F.regexp_extract(F.coalesce(name, F.lit("")), r"(?s)\.([^.]+)\z", 1))
    return F.when(found == "", "bin").otherwise(found)


def suffix(kind: Column, name: Column) -> Column:
    """The suffix that decides the parser: the media type's if it has one, else the name's."""
    known = F.create_map(*[F.lit(x) for pair in SUFFIXES.items() for x in pair])
    return F.coalesce(F.try_element_at(known, kind), name_suffix(name))


def parser(ext: Column, name: Column, handlers: Sequence[tuple[str, Sequence[str]]] = PARSERS) -> Column:
    """First of ``handlers`` (a parser's name and the suffixes that it takes) for the suffix, else the first for the file name, else null."""
    first: dict[str, str] = {}
    for kind, suffixes in handlers:
        for s in suffixes:
            first.setdefault(s, kind)
    if not first:
        return F.lit(None).cast("string")
    taken = F.create_map(*[F.lit(x) for pair in first.items() for x in pair])
    return F.coalesce(F.try_element_at(taken, ext), F.try_element_at(taken, name_suffix(name)))


def image_format(name: Column, kind: Column) -> Column:
    """Format of a picture: its name's suffix, else its media type's, else ``png``; ``jpeg`` and ``tif`` are ``jpg`` and ``tiff``."""
    folded = F.create_map(*[F.lit(x) for s in IMAGE_SUFFIXES for x in (s, {"jpeg": "jpg", "tif": "tiff"}.get(s, s))])
    by_kind = F.create_map(*[F.lit(x) for k, s in SUFFIXES.items() if k.startswith("image/") for x in (k, s)])
    return F.coalesce(F.try_element_at(folded, name_suffix(name)), F.try_element_at(by_kind, kind), F.lit("png"))
