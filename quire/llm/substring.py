"""Removal of word windows that occur more than once, by level-wise doubling.

A window is ``WINDOW`` consecutive words of one document.  Levels double the length that is looked
at: 9, 18, then the window itself.  On each level a run of that length stands for the windows
around it, and windows survive only if their run is found at two places or more; survivors go
on to the next level.

Below the last level not every run is counted.  Each window is represented by the smallest-hashed
run inside it, so equal windows choose equal runs and no repeated window can be lost, while
only about one run in fourteen is shuffled.  Runs that merely share a hash there let more windows
through, never fewer.  On the last level each surviving window is counted itself, under a 64-bit and a 32-bit hash
that are built with different factors: windows are taken for equal if both are.  A document is
known by a 64-bit and a 32-bit hash of its id and text.

Counts are partial sums by hash, and the rows that meet the counts again are joined on unique
keys, so one hash may hold any share of the rows.  A document's own positions are the only
thing gathered in one place, as runs.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quire.llm.common import SECOND_FACTOR, Words, byte_texts, grams, mixed, packs, release, stored

WINDOW = 35
#: ``doc`` is a document's number within its task, small enough to travel with each hit; ``second`` is there on the last level only.
_HITS, _SECOND = "doc long, rid long, rid2 int, hash long, at int, len int", ", second int"


def _levels(window: int) -> list[int]:
    """Lengths of the levels below the window: each half of the next, the first at least 6."""
    out, n = [], window
    while (n + 1) // 2 >= 6:
        n = (n + 1) // 2
        out.append(n)
    return out[::-1] or [max(1, window // 2)]


def _chosen(hashes: np.ndarray, span: int) -> np.ndarray:
    """For each run of ``span`` hashes, the index of its smallest (the last of equal ones)."""
    n = len(hashes) - span + 1
    best = np.arange(len(hashes), dtype=np.int64)
    done = 1
    while done < span:
        step = min(done, span - done)
        left, right = best[:-step], best[step:]
        best = np.where(hashes[right] <= hashes[left], right, left)
        done += step
    return best[:n]


def _alive(runs: np.ndarray | None, n: int) -> np.ndarray:
    """Window starts that ``runs`` (start, length, start, length, ...) hold; all ``n`` if there is no list."""
    if runs is None:
        return np.ones(n, dtype=bool)
    edge = np.zeros(n + 1, dtype=np.int64)
    np.add.at(edge, np.minimum(runs[::2], n), 1)
    np.add.at(edge, np.minimum(runs[::2] + runs[1::2], n), -1)
    return np.cumsum(edge[:-1]) > 0


def _represent(code: np.ndarray, runs: np.ndarray | None, length: int, window: int) -> tuple[np.ndarray, ...]:
    """Hashes that stand for a document's surviving windows, with the first window and number of windows of each; on the last level the second hashes too."""
    n = len(code) - window + 1
    starts = np.flatnonzero(_alive(runs, n))
    if length == window:
        return grams(code, window)[starts], starts, np.ones(len(starts), dtype=np.int64), (grams(code, window, SECOND_FACTOR)[starts] >> np.uint64(32)).astype(np.uint32)
    hashes = grams(code, length)
    run = _chosen(mixed(hashes), window - length + 1)[starts]
    first = np.flatnonzero(np.concatenate([[True], (run[1:] != run[:-1]) | (starts[1:] != starts[:-1] + 1)]))
    return hashes[run[first]], starts[first], np.diff(np.append(first, len(starts)))


def _finder(length: int, window: int) -> Callable:
    """Emits the representatives of one level; a column ``runs``, if there is one, holds the survivors of the level before."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 33
        for batch in batches:
            texts, ids, others = byte_texts(batch.column("text")), batch.column("rid").to_numpy(), batch.column("rid2").to_numpy()
            runs = batch.column("runs") if "runs" in batch.schema.names else None
            for lo, hi in packs(texts):
                words, found = Words(texts[lo:hi]), []
                for i in range(lo, hi):
                    code = words.code[words.first[i - lo] : words.first[i - lo + 1]]
                    own = None if runs is None else np.asarray(runs[i].values.to_numpy(zero_copy_only=False), dtype=np.int64)
                    if len(code) >= window:
                        h, at, n, *second = _represent(code, own, length, window)
                        number += 1
                        found.append((np.full(len(h), number, dtype=np.int64), np.full(len(h), ids[i], dtype=np.int64), np.full(len(h), others[i], dtype=np.int32), h, at, n, *second))
                if found:
                    doc, rid, rid2, h, at, n, *second = (np.concatenate(x) for x in zip(*found, strict=True))
                    columns = [doc, rid, rid2, h.view(np.int64), at.astype(np.int32), n.astype(np.int32), *(x.view(np.int32) for x in second)]
                    yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["doc", "rid", "rid2", "hash", "at", "len", "second"][: len(columns)])

    return work


def _repeated(hits: DataFrame) -> DataFrame:
    """By document, the windows whose representative is found twice or more: ``(of, of2, runs)``.

    The repeated hashes are stored before they meet the hits again: the join then has two plain shuffles, so
    Spark can split the partition of a hash that holds a large share of the hits.  Hits travel under their document's number;
    its hashes come back once per document.
    """
    keys = [c for c in ("hash", "second") if c in hits.columns]
    often = stored(hits.groupBy(*keys).agg(F.count("*").alias("n")).where("n > 1").select(*keys))
    length = F.lit(1) if "second" in keys else F.col("len")  # on the last level, a hit is one window
    back = hits.select("doc", *keys, "at", *(["len"] if "second" not in keys else [])).join(often, keys, "left_semi")
    runs = back.groupBy("doc").agg(F.flatten(F.collect_list(F.array("at", length))).alias("runs"))
    names = hits.groupBy(F.col("rid").alias("of"), F.col("rid2").alias("of2")).agg(F.min("doc").alias("doc"))  # rows that share both are alike
    marks = stored(runs.join(names, "doc").select("of", "of2", "runs"))
    release(often)
    return marks


def _covered(runs: np.ndarray, window: int, n_words: int) -> np.ndarray:
    """Words inside the windows that ``runs`` names."""
    return _alive(np.column_stack([runs[::2], runs[1::2] + window - 1]).ravel(), n_words)


def _cutter(window: int, schema: T.StructType, text_col: str, keep_rows: bool) -> Callable:
    """Takes the repeated windows out of each text; whole rows with a new text, or digests."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, runs = byte_texts(batch.column("text")), batch.column("runs")
            kept: list[bytes | None] = []
            counts = []
            for lo, hi in packs(texts):
                words = Words(texts[lo:hi])
                for i in range(lo, hi):
                    a, b = words.first[i - lo], words.first[i - lo + 1]
                    own = np.asarray(runs[i].values.to_numpy(zero_copy_only=False), dtype=np.int64) if runs[i].is_valid else np.zeros(0, dtype=np.int64)
                    gone = _covered(own, window, b - a) if len(own) else np.zeros(b - a, dtype=bool)
                    n_gone = int(gone.sum())
                    if keep_rows and not n_gone:
                        kept.append(None)
                    elif n_gone:
                        stay = np.flatnonzero(~gone)
                        kept.append(b" ".join([words.data[s:e] for s, e in zip(words.start[a:b][stay].tolist(), words.end[a:b][stay].tolist(), strict=True)]))
                    else:
                        kept.append(b" ".join(texts[i].split()))
                    counts.append((int(b - a), n_gone))
            if keep_rows:
                new = [old if k is None else k.decode() for k, old in zip(kept, batch.column("text").to_pylist(), strict=True)]
                yield pa.RecordBatch.from_arrays([pa.array(new, pa.string()) if f.name == text_col else batch.column(f"c_{j}") for j, f in enumerate(schema)], names=schema.names)
            else:
                yield pa.RecordBatch.from_arrays(
                    [batch.column("id"), pa.array([x[0] for x in counts], pa.int64()), pa.array([x[1] for x in counts], pa.int64()), pa.array([hashlib.sha256(k).hexdigest() for k in kept])], names=schema.names
                )

    return work


def repeated_windows(rows: DataFrame, window: int = WINDOW) -> DataFrame:
    """``(of, of2, runs)``: for each ``rid``, ``rid2`` of ``rows (rid, rid2, text, ...)`` with repeated windows, their starts as start and length in turn."""
    marks = None
    for length in [*_levels(window), window]:
        texts = rows if marks is None else rows.join(marks, _same(rows, marks))
        hits = stored(texts.select("rid", "rid2", "text", *([] if marks is None else ["runs"])).mapInArrow(_finder(length, window), _HITS + _SECOND * (length == window)))
        if marks is not None:
            release(marks)
        marks = _repeated(hits)
        release(hits)
    return marks


def _same(rows: DataFrame, marks: DataFrame) -> Column:
    return (rows.rid == marks.of) & (rows.rid2 == marks.of2)


def _rows(docs: DataFrame, id_col: str, text_col: str, columns: bool) -> DataFrame:
    """A row's own key is made of its id and text: rows that share both are alike in everything that follows."""
    own = [F.col(c).alias(f"c_{j}") for j, c in enumerate(docs.columns) if c != text_col] if columns else [F.col(id_col).alias("id")]
    keys = [F.xxhash64(F.col(id_col), F.col(text_col)).alias("rid"), F.shiftright(F.xxhash64(F.lit("second"), F.col(text_col), F.col(id_col)), 32).cast("int").alias("rid2")]
    return docs.select(*keys, F.col(text_col).alias("text"), *own)


def removed_words(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW) -> DataFrame:
    """``(id_col, n_words, n_removed, kept_sha256)`` for each row.

    A word goes if any window that covers it also starts elsewhere, in the same row or another; all
    places lose it.  Null and empty texts, and texts shorter than a window, lose nothing (without words the
    digest is that of nothing); repeated rows count as two documents, so each loses every window; a null id
    is an id like any other; a very long text is one document with all its windows.  Other columns are not read.
    An empty table gives an empty result.
    """
    rows = _rows(docs, id_col, text_col, False)
    marks = repeated_windows(rows, window)
    schema = T.StructType([T.StructField(id_col, docs.schema[id_col].dataType), T.StructField("n_words", T.LongType()), T.StructField("n_removed", T.LongType()), T.StructField("kept_sha256", T.StringType())])
    return rows.join(marks, _same(rows, marks), "left").select("id", "text", "runs").mapInArrow(_cutter(window, schema, text_col, False), schema)


def without_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW) -> DataFrame:
    """``docs`` with repeated windows cut from the text; rows without any keep their text as it is, and no row goes.

    Null, empty and short texts stay as they are; of repeated rows each loses every window, so long ones become
    empty; the words that are left of a text are joined by single spaces.  Columns of any name stay unchanged.  An
    empty table gives an empty result.
    """
    rows = _rows(docs, id_col, text_col, True)
    marks = repeated_windows(rows.select("rid", "rid2", "text"), window)
    return rows.join(marks, _same(rows, marks), "left").drop("rid", "rid2", "of", "of2").mapInArrow(_cutter(window, docs.schema, text_col, True), docs.schema)
