"""Thousands of keywords found in one pass over the text.

The words become an automaton that every task gets once; texts run through it in Arrow batches, and each place
where a word stands comes out, overlapping ones too.  More words than one automaton should hold are taken in slices,
one pass for each, so their number has no limit.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Characters of the words that one automaton holds; a driver and every worker have room for it.
MOST_CHARACTERS = 8_000_000
#: Places that a worker holds before it passes them on.
MOST_PLACES = 20_000


def _finder(words: dict[str, list[str]], boundary: str | None, lower: bool, names: list[str]):
    import ahocorasick

    automaton = ahocorasick.Automaton()
    for word, kinds in words.items():
        automaton.add_word(word, (word, kinds))
    automaton.make_automaton()

    def places(text: str) -> Iterator[tuple[str, str, int]]:
        for end, (word, kinds) in automaton.iter(text):
            begin = end + 1 - len(word)
            if boundary is not None and not ((begin == 0 or text[begin - 1] in boundary) and (end + 1 == len(text) or text[end + 1] in boundary)):
                continue
            for kind in kinds:
                yield kind, word, begin

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            *keys, texts = batch.columns
            rows, found = [], []

            def out(keys: list[pa.Array] = keys) -> pa.RecordBatch:
                kind, word, at = zip(*found, strict=True)
                kept = [c.take(pa.array(rows, pa.int64())) for c in keys]  # noqa: B023
                return pa.RecordBatch.from_arrays([*kept, pa.array(kind, pa.string()), pa.array(word, pa.string()), pa.array(at, pa.int32())], names=names)

            for k, value in enumerate(texts):
                text = value.as_py()
                for place in places(text.lower() if lower else text) if text else ():
                    found.append(place)
                    rows.append(k)
                    if len(found) >= MOST_PLACES:
                        yield out()
                        rows.clear()
                        found.clear()
            if found:
                yield out()

    return work


def keyword_places(texts: DataFrame, keywords: DataFrame, text_col: str = "content", boundary: str | None = None, lower: bool = False, most: int = MOST_CHARACTERS) -> DataFrame:
    """``texts`` without ``text_col``, with ``kind``, ``word`` and ``at``: a row per place where a word of ``keywords (kind, word)`` stands.

    ``at`` counts code points from 0.  With ``boundary``, only places count that have one of its characters, or the text's
    end, on both sides; else words are found inside others too.  ``lower`` looks in the text's lower case, for words
    that are given so.  Empty and null words and texts have no places; words and kinds may repeat.
    """
    known = keywords.where("word <> ''").groupBy("word").agg(F.sort_array(F.collect_set(F.coalesce("kind", F.lit("")))).alias("kinds"))
    size = known.agg(F.sum(F.length("word"))).first()[0] or 0
    slices = max(1, math.ceil(size / most))
    keys = [f for f in texts.schema if f.name != text_col]
    schema = T.StructType([*keys, T.StructField("kind", T.StringType()), T.StructField("word", T.StringType()), T.StructField("at", T.IntegerType())])
    rows = texts.select(*[f.name for f in keys], text_col)
    out = None
    for k in range(slices):
        own = known if slices == 1 else known.where(F.pmod(F.xxhash64("word"), F.lit(slices)) == k)
        words = {r.word: r.kinds for r in own.toLocalIterator()}
        if words:
            part = rows.mapInArrow(_finder(words, boundary, lower, schema.names), schema)
            out = part if out is None else out.unionByName(part)
    return texts.sparkSession.createDataFrame([], schema) if out is None else out
