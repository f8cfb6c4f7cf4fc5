"""Recursive expansion of nested files, each distinct content parsed once.

Files are known by the 128-bit hash of their bytes and the parser that takes them.  A level's files are looked up in
the table of contents that are parsed already; only those that are not there are parsed, and what they embed,
without the bytes, becomes a table of links from a content to its children.  The tree of files is then that table joined
with itself, level by level: an attachment that any number of sessions hold is read, parsed and stored once.  Each level
is written to the shared folder, so lost executors cost no more than a level.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quire.functions.detect import PARSERS, image_format, media_type, parser, suffix
from quire.functions.text import base_name, plain_file_name
from quire.operators.elements import preorder
from quire.operators.naming import directory_names
from quire.plans.corpus import parent_label
from quire.sources.packages import parsed
from quire.sources.shared import by_sorting, staged

MOST_DEPTH = 10
IMAGE = "image"
_NAMED = ("file_name", "kind", "ext", "parser", "content_key")
_LISTS = ("elements", "sheets", "embedded", "images", "error")
#: Files to leave out of a level, at most, that executors get as a list; more are told by a filter of so many bits for each, in pieces of ``PIECE`` bits.
FEW, BITS, PIECE = 10_000, 16, 1 << 15


Handlers = Sequence[tuple[str, Sequence[str]]]


def routed(files: DataFrame, handlers: Handlers = PARSERS) -> DataFrame:
    """``files (..., file_name, content)`` with ``kind`` (media type), ``ext`` and ``parser``; the last is null for unsupported files."""
    kinds = files.withColumn("kind", media_type(F.col("content")))
    return kinds.withColumn("ext", suffix(F.col("kind"), F.col("file_name"))).withColumn("parser", parser(F.col("ext"), F.col("file_name"), handlers))


def _keyed(files: DataFrame, handlers: Handlers) -> DataFrame:
    """``files`` routed, with ``content_key``: equal for files with equal bytes that go to the same parser."""
    return routed(files, handlers).withColumn("content_key", F.concat_ws(":", F.md5(F.coalesce("content", F.lit(b""))), "parser"))


def _children(contents: DataFrame, handlers: Handlers) -> DataFrame:
    """What parsed contents embed, in order, then their pictures: ``(content_key of the child, in_key, k, file_name, position, content, ...)``."""
    part = lambda e: F.struct(e["file_name"].alias("file_name"), e["position"].alias("position"), e["data"].alias("data"))
    inner = F.concat(F.transform("embedded", part), F.transform("images", part))
    rows = contents.select(F.col("content_key").alias("in_key"), F.posexplode(inner).alias("k", "e"))
    return _keyed(rows.select("in_key", "k", F.col("e.file_name").alias("file_name"), F.col("e.position").alias("position"), F.col("e.data").alias("content")), handlers)


def _fresh(files: DataFrame, listed: DataFrame, place: list[str], known: DataFrame | None) -> DataFrame:
    """One row of ``files`` per content that some parser takes and that is not ``known``, without moving contents that are not repeated.

    ``listed`` is the stored table of the same files without their contents, ``place`` what tells them apart.  The files
    to leave out are found there; contents only meet that list.  Executors get a copy of it if it is short.
    """
    taken = listed.where("parser is not null").select("content_key", *place)
    repeated = taken.groupBy("content_key").agg(F.count("*").alias("n"), F.min(F.struct(*place)).alias("least")).where("n > 1").select("content_key", "least")
    again = taken.join(by_sorting(repeated), "content_key").where(F.struct(*place) != F.col("least")).select(*place)
    if known is not None:
        again = again.union(taken.join(by_sorting(known), "content_key", "left_semi").select(*place)).distinct()
    return _without(files.where("parser is not null"), staged(again), place).select("content_key", "parser", "content")


def _without(files: DataFrame, out: DataFrame, place: list[str]) -> DataFrame:
    """``files`` but for those whose ``place`` is in ``out``.

    If these are more than ``FEW``, executors get a filter of their hashes.  Files that it lets pass stay where they are;
    only the others, those to leave out and one in ``BITS`` of the rest, are shuffled to meet the list.
    """
    count = out.count()
    if count <= FEW:
        return files.join(F.broadcast(out), place, "left_anti")
    pieces = -(-count * BITS // PIECE)
    bit = F.pmod(F.xxhash64(*place), F.lit(pieces * PIECE))
    bits = out.groupBy(F.floor(bit / PIECE).cast("int").alias("piece")).agg(F.bitmap_construct_agg(bit % PIECE).alias("bits"))
    told = files.withColumn("piece", F.floor(bit / PIECE).cast("int")).join(F.broadcast(bits), "piece", "left")
    byte = F.conv(F.hex(F.substring("bits", (F.floor(bit % PIECE / 8) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
    told = told.withColumn("met", F.coalesce(F.call_function("shiftright", byte, (bit % 8).cast("int")).bitwiseAND(F.lit(1)) == 1, F.lit(False)))
    clear, met = (told.where(c).select(*files.columns) for c in (~F.col("met"), F.col("met")))
    return clear.unionByName(met.join(by_sorting(out), place, "left_anti").select(*files.columns))


class Contents(NamedTuple):
    """What sources hold: the files of level 0, then for each level its new contents, their links to what they embed, and their bytes."""

    level: DataFrame
    parsed: list[DataFrame]
    links: list[DataFrame]
    held_bytes: list[DataFrame]


def contents_of(sources: DataFrame, depth_limit: int = MOST_DEPTH, fail_fast: bool = False, parsers: dict[str, Callable[[bytes], dict]] | None = None, handlers: Handlers | None = None) -> Contents:
    """Each distinct content within ``sources`` parsed once, without the tree of files; the arguments are those of ``expand``."""
    parsers = parsers or {}
    if handlers is None:
        handlers = (*((name, (name,)) for name in parsers), *PARSERS)
    top = _keyed(sources.select("session_id", "file_name", "content"), handlers)
    level = staged(top.select("session_id", F.array(F.lit(0)).alias("path"), F.lit(0).alias("depth"), F.lit(None).cast("int").alias("parent_position"), *_NAMED))

    contents, links, held_bytes = [], [], []
    if level.groupBy("session_id").count().where("count > 1").isEmpty():
        fresh = _fresh(top, level, ["session_id"], None)
    else:  # sources that share a session cannot be told apart by it
        fresh = top.where("parser is not null").groupBy("content_key", "parser").agg(F.first("content").alias("content"))
    for depth in range(depth_limit):
        held_bytes.append(fresh.select("content_key", "content"))  # read again from what holds them, so they are stored once
        rows = parsed(fresh.where(F.col("parser") != IMAGE), fail_fast, parsers=parsers).withColumn("held", F.lit(None).cast("binary"))
        pictures = fresh.where(F.col("parser") == IMAGE).select("content_key", "parser", F.col("content").alias("held"), *[F.lit(None).cast("string").alias(n) if n == "error" else _empty(rows, n) for n in _LISTS])
        done = staged(rows.unionByName(pictures))
        contents.append(done)
        inside = _children(done, handlers)
        found = staged(inside.drop("content"))
        links.append(found)
        if depth + 1 == depth_limit or found.where("parser is not null").isEmpty():
            break
        fresh = _fresh(inside, found, ["in_key", "k"], reduce(DataFrame.unionByName, [c.select("content_key") for c in contents]))
    return Contents(level, contents, links, held_bytes)


def distinct_contents(found: Contents) -> DataFrame:
    """A row per distinct content with what it was parsed to."""
    return reduce(DataFrame.unionByName, found.parsed).drop("held")


def expand(
    sources: DataFrame,
    depth_limit: int = MOST_DEPTH,
    images_recurse: bool = False,
    fail_fast: bool = False,
    keep_content: bool = False,
    parsers: dict[str, Callable[[bytes], dict]] | None = None,
    handlers: Handlers | None = None,
) -> dict[str, DataFrame]:
    """All files within ``sources (session_id, file_name, content)``: tables ``docs``, ``skipped`` and ``contents``.

    ``docs`` has a row per supported file with its path of ordinals, ``seq``, ``dir``, ``parent`` and parsed
    lists; files without a parser are in ``skipped`` and take no ``seq``.  ``contents`` has a row per distinct content with
    what it was parsed to.  Pictures are leaves; with ``images_recurse`` each holds itself again until the depth
    limit, as some older corpora have it.  ``content`` stays with ``keep_content``, for copies of the sources; ``bare`` is ``docs`` without it, for readers that need no bytes.  ``parsers`` are
    functions from bytes to the lists of ``PARSED``, by the suffix that they take; they come before the known ones.  ``handlers``
    replaces the list of parsers: names (of ``parsers`` or known ones) with the suffixes that each takes, the first that
    takes a file being the one that gets it, so parsers can be left out and put in another order.
    """
    level, contents, links, held_bytes = found = contents_of(sources, depth_limit, fail_fast, parsers, handlers)
    levels, embeds = [level], not links[0].isEmpty()
    for depth in range(1, depth_limit):
        held = levels[-1].where("parser is not null")
        below = lambda up, k, at, own: up.select("session_id", F.concat("path", F.array(k)).alias("path"), F.lit(depth).alias("depth"), at.cast("int").alias("parent_position"), *own)  # noqa: B023, E731
        inner = []
        if embeds:  # what a level holds is parsed by then, so deeper links are not asked
            link = reduce(DataFrame.unionByName, links[:depth]).select("in_key", "k", F.col("position").alias("at"), *[F.col(c).alias(f"c_{c}") for c in _NAMED])
            inner.append(below(held.join(by_sorting(link), held.content_key == link.in_key), F.col("k"), F.col("at"), [F.col(f"c_{c}").alias(c) for c in _NAMED]))
        if images_recurse:
            inner.append(below(held.where(F.col("parser") == IMAGE), F.lit(0), F.lit(0), [F.col(c) for c in _NAMED]))
        if not inner:
            break
        levels.append(staged(reduce(DataFrame.unionByName, inner)))
        if levels[-1].isEmpty():
            break
    nodes = reduce(DataFrame.unionByName, levels)
    held = nodes.where("parser is not null")

    order = directory_names(preorder(held.select("session_id", "path", "file_name"), ["session_id"]).withColumn("base", base_name(F.col("file_name"))), ["session_id"])
    placed = held.join(by_sorting(order.select("session_id", "path", "seq", "base", "dir")), ["session_id", "path"])
    above = order.select("session_id", F.col("path").alias("up"), F.col("dir").alias("parent_dir"))
    up = F.slice("path", 1, F.greatest(F.size("path") - 1, F.lit(0)))
    full = placed.withColumn("up", F.when(F.col("depth") > 0, up)).join(by_sorting(above), ["session_id", "up"], "left")
    full = full.withColumn("parent", parent_label(F.col("parent_dir"), F.col("parent_position"))).withColumn("source_copy", F.concat_ws("/", "dir", plain_file_name(F.col("file_name"))))
    full = full.drop("up", "parent_dir")
    if keep_content:  # those who keep it read the tree for the copies and again for what was parsed
        full = staged(full)
    every = reduce(DataFrame.unionByName, contents)
    picture = F.array(F.struct(F.col("file_name"), F.lit(0).alias("position"), image_format(F.col("file_name"), F.col("kind")).alias("format"), F.col("held").alias("data")))
    docs = full.join(by_sorting(every.drop("parser")), "content_key")
    docs = docs.withColumn("images", F.when(F.col("parser") == IMAGE, picture.cast(every.schema["images"].dataType)).otherwise(F.col("images")))
    docs = bare = docs.drop("held")
    if keep_content:
        docs = docs.join(by_sorting(reduce(DataFrame.unionByName, held_bytes)), "content_key")
    return {"docs": docs, "bare": bare, "skipped": nodes.where("parser is null").select("session_id", "path", "file_name", "ext"), "contents": distinct_contents(found)}


def _empty(like: DataFrame, name: str) -> Column:
    return F.array().cast(like.schema[name].dataType).alias(name)
