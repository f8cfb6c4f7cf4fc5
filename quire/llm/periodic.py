"""Runs of words that repeat with a period, on a harmonic grid.

For each period p, words are looked at on a grid of step p only.  A run of three periods holds two grid points whose
blocks of p words are equal, so comparing each grid point with the next one misses no run; over all
periods that makes n (1 + 1/2 + 1/3 + ...) comparisons for n words.  All pairs (period, grid point)
that agree are then extended at the same time, to the left and to the right, by binary search on
differences of prefix hashes.  What is found is compared word by word; runs that several grid points or
multiples of a period report become one.

Texts are taken together in packs: their words in a row, with a mark between two texts that equals
nothing.  A text never leaves its task, and rows need no shuffle.
"""

from __future__ import annotations

import zlib
from collections import defaultdict
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quire.llm.common import byte_texts, mixed, packs

#: A run has this many words and this many periods at least.
LEAST, TIMES = 24, 3
#: Pairs of a period and a grid point that are extended together.
TOGETHER = 1 << 20
#: Distinct words that a worker numbers before it begins anew.
MOST_WORDS = 1 << 20
_BASE = np.uint64(0x9E3779B97F4A7C15)
_RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])
RUNS = T.ArrayType(T.StructType([T.StructField(c, T.LongType()) for c in ("start", "length", "period")]))


class Prefixes:
    """Hashes of all prefixes of a row of codes; equal stretches always agree, others hardly ever."""

    def __init__(self, code: np.ndarray):
        self.power = np.full(len(code) + 1, _BASE, dtype=np.uint64)
        self.power[0] = 1
        np.multiply.accumulate(self.power, out=self.power)
        self.sums = np.zeros(len(code) + 1, dtype=np.uint64)
        np.cumsum(mixed(code.astype(np.uint64)) * self.power[:-1], out=self.sums[1:])

    def same(self, a: np.ndarray, b: np.ndarray, n: np.ndarray) -> np.ndarray:
        """Whether ``n`` codes from ``a`` on equal those from ``b`` on; ``b`` is the later one."""
        return (self.sums[a + n] - self.sums[a]) * self.power[b - a] == self.sums[b + n] - self.sums[b]


def _longest(agree: Callable[[np.ndarray], np.ndarray], most: np.ndarray) -> np.ndarray:
    """For each element the largest n up to ``most`` for which ``agree`` holds, by binary search of all at once."""
    low, high = np.zeros_like(most), most.copy()
    while (low < high).any():
        middle = (low + high + 1) >> 1
        good = agree(middle)
        low, high = np.where(good, middle, low), np.where(good, high, middle - 1)
    return low


def _by_words(code: np.ndarray, least: int, times: int) -> Iterator[tuple[int, int, int]]:
    """``(start, end, period)`` of one text's stretches by comparing all words with those p before: exact, in quadratic time."""
    for p in range(1, len(code) // times + 1):
        edge = np.flatnonzero(np.diff(np.concatenate([[False], code[:-p] == code[p:], [False]]).astype(np.int8)))
        for s, e in edge.reshape(-1, 2).tolist():
            if e + p - s >= max(least, times * p):
                yield s, e + p, p


def find_runs(code: np.ndarray, begin: np.ndarray, end: np.ndarray, least: int = LEAST, times: int = TIMES) -> np.ndarray:
    """Rows ``(start, length, period)`` of all runs in texts laid one after another, the longest text first.

    Text k is ``code[begin[k]:end[k]]``; between texts stands a code that occurs once.
    """
    if not len(begin) or end[0] - begin[0] < max(least, times):
        return np.zeros((0, 3), dtype=np.int64)
    prefix, size = Prefixes(code), end - begin
    found: dict[tuple[int, int], int] = {}

    def extend(points: list[tuple[int, np.ndarray]]) -> None:
        p = np.repeat(np.array([x[0] for x in points], dtype=np.int64), [len(x[1]) for x in points])
        g = np.concatenate([x[1] for x in points])
        inside = g + 2 * p <= len(code)
        p, g = p[inside], g[inside]
        block = prefix.same(g, g + p, p)
        p, g = p[block], g[block]
        if not len(p):
            return
        first = np.concatenate([[True], (p[1:] != p[:-1]) | (g[1:] != g[:-1] + p[1:])])  # of a row of equal blocks
        p, g = p[first], g[first]
        text = np.searchsorted(begin, g, side="right") - 1
        right = _longest(lambda n: prefix.same(g, g + p, n), end[text] - g - p)
        left = _longest(lambda n: prefix.same(g - n, g + p - n, n), g - begin[text])
        start, stop = g - left, g + p + right
        good = stop - start >= np.maximum(least, times * p)
        for s, e, q in np.unique(np.column_stack([start, stop, p])[good], axis=0).tolist():
            found[s, e] = min(q, found.get((s, e), q))

    waiting, held = [], 0
    for p in range(1, int(size[0]) // times + 1):
        last = int(np.searchsorted(-size, -max(least, times * p), side="right"))
        grid = code[: end[last - 1] : p]
        points = np.flatnonzero(grid[1:] == grid[:-1])
        if len(points):
            waiting.append((p, points * p))
            held += len(points)
        if held > TOGETHER:
            extend(waiting)
            waiting, held = [], 0
    if waiting:
        extend(waiting)

    wrong = {int(np.searchsorted(begin, s, side="right")) - 1 for (s, e), p in found.items() if not np.array_equal(code[s : e - p], code[s + p : e])}
    for k in wrong:  # hashes of other words agreed: leave them aside
        at, stop = int(begin[k]), int(end[k])
        found = {r: p for r, p in found.items() if not at <= r[0] < stop}
        for s, e, p in _by_words(code[at:stop], least, times):
            found[at + s, at + e] = min(p, found.get((at + s, at + e), p))
    return np.array(sorted((s, e - s, p) for (s, e), p in found.items()), dtype=np.int64).reshape(-1, 3)


def _dropped(runs: np.ndarray, n: int) -> np.ndarray:
    """Words that some run holds after its first period."""
    edge = np.zeros(n + 1, dtype=np.int64)
    np.add.at(edge, runs[:, 0] + runs[:, 2], 1)
    np.add.at(edge, runs[:, 0] + runs[:, 1], -1)
    return np.cumsum(edge[:-1]) > 0


class _Numbers(defaultdict):
    """A number for each distinct word."""

    def __missing__(self, word: bytes) -> int:
        self[word] = len(self)
        return self[word]


def _finder(least: int, times: int, order: Callable | None, schema: T.StructType) -> Callable:
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        numbers = _Numbers()
        for batch in batches:
            ids, texts = batch.column(0), byte_texts(batch.column(1))
            for lo, hi in packs(texts):
                if len(numbers) > MOST_WORDS:
                    numbers = _Numbers()
                words = [t.split() for t in texts[lo:hi]]  # at the bytes 20 and 09 to 0D, as asked
                if order is not None:
                    places = [order(i, len(w)) for i, w in zip(ids[lo:hi].to_pylist(), words, strict=True)]
                    words = [w if at is None else [w[k] for k in at.tolist()] for w, at in zip(words, places, strict=True)]
                size = np.array([len(w) for w in words], dtype=np.int64)
                turn = np.argsort(-size, kind="stable")
                end = np.cumsum(size[turn] + 1) - 1
                begin = end - size[turn]
                code = np.empty(int(size.sum()) + len(size), dtype=np.int64)
                for k, t in enumerate(turn.tolist()):
                    code[begin[k] : end[k]] = np.fromiter(map(numbers.__getitem__, words[t]), dtype=np.int64, count=len(words[t]))
                    code[end[k]] = -1 - k
                runs = find_runs(code, begin, end, least, times)
                cut = np.searchsorted(runs[:, 0], begin)  # texts without words share a place with the one behind, but have no runs
                cut = np.append(cut, len(runs))
                back = np.empty(len(turn), dtype=np.int64)
                back[turn] = np.arange(len(turn))
                kept: list[bytes] = []
                own: list[np.ndarray] = []
                for t, k in enumerate(back.tolist()):
                    of = runs[cut[k] : cut[k + 1]] - np.array([begin[k], 0, 0])
                    own.append(of)
                    w = words[t]
                    kept.append(b" ".join(w if not len(of) else [w[i] for i in np.flatnonzero(~_dropped(of, len(w))).tolist()]))
                flat = np.concatenate([np.zeros((0, 3), dtype=np.int64), *own])
                structs = pa.StructArray.from_arrays([pa.array(flat[:, j]) for j in range(3)], fields=list(_RUN))
                offsets = np.concatenate([[0], np.cumsum([len(o) for o in own])])
                yield pa.RecordBatch.from_arrays(
                    [ids[lo:hi], pa.array(size), pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), structs), pa.array(kept, pa.binary()).cast(pa.string())], names=schema.names
                )

    return work


def collapsed_runs(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: int = LEAST, times: int = TIMES, order: Callable | None = None
) -> DataFrame:
    """``(id_col, n_words, runs, collapsed)`` for each row: its runs in order and its text without their repetitions.

    Words are ``[^\\x20\\x09-\\x0D]+``.  A run is a stretch of words with smallest period p and at least
    ``max(least, times * p)`` words that cannot be made longer; ``runs`` lists ``start``, ``length`` and ``period`` by
    start, then period.  ``collapsed`` holds the other words and the first p of each run, joined by one space.
    ``order(id, n)`` may give the numbers of the words to take instead of a text's n words.

    Null and empty texts have no words, no runs and an empty ``collapsed``; a null id is passed on (and to ``order``);
    repeated rows give equal rows; a very long text is searched whole; other columns are not read, whatever their
    names; an empty table gives an empty result.
    """
    if times < 3:
        raise ValueError("with fewer than three periods, a run need not hold two equal blocks of the grid")
    schema = T.StructType([T.StructField(id_col, docs.schema[id_col].dataType), T.StructField("n_words", T.LongType()), T.StructField("runs", RUNS), T.StructField("collapsed", T.StringType())])
    return docs.select(id_col, text_col).mapInArrow(_finder(least, times, order, schema), schema)


def planted(doc_id: int | None, n: int) -> np.ndarray | None:
    """Word numbers that give one document in ten a tail that repeats, as its id has it; null for the others and for a null id."""
    h = 1 if doc_id is None else zlib.crc32(str(doc_id).encode())
    if h % 10 or not n:
        return None
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    at = np.arange(n, dtype=np.int64)
    at[a:] = a + (at[a:] - a) % p
    return at


def run_digests(found: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Counts, the run of greatest exponent and digests of ``collapsed_runs``.

    ``(id_col, n_runs, start, length, period, exponent_milli, runs_sha256, collapsed_sha256)``; without runs
    the four of the best one are null and ``runs_sha256`` is that of nothing.
    """
    larger = lambda a, b: a["length"] * b["period"] > b["length"] * a["period"]  # noqa: E731  # exact: no division
    # runs come by start, then period: only a greater exponent takes the place of one before
    best = F.aggregate("runs", F.get("runs", F.lit(0)), lambda a, b: F.when(larger(b, a), b).otherwise(a))
    lines = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    return found.withColumn("best", best).select(
        id_col,
        F.size("runs").cast("long").alias("n_runs"),
        "best.start",
        "best.length",
        "best.period",
        F.expr("best.length * 1000 div best.period").alias("exponent_milli"),
        F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )
