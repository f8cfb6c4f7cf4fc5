"""Toxicity by compression distance: separate zstandard dictionaries of toxic and of ordinary text.

Two dictionaries are trained by the zstandard library, each on windows of its own kind of text.  A window is
compressed with either, and the two lengths are compared: a window that repeats something of the toxic dictionary
gets shorter under it, an ordinary one under the other.  Toxic documents are mostly ordinary language too; what
sets them apart are single words in it.  A window is therefore a word (a long word is several windows), and the toxic
dictionary is trained on the windows of labelled toxic texts whose words they use far more often than the ordinary ones.

A document's windows are held against thresholds on the gain.  Numbers and shares of windows beyond each threshold
are turned into a probability by a logistic model, which calibrates the thresholds on labelled rows.  The shares keep
long texts, where chance alone makes some windows gain, apart from short ones.

Fitting uses at most ``SAMPLE`` labelled rows of each class, smallest hashes of the id first, and all windows of those.  The
driver gets these windows, counted words and a few numbers for each row of the sample.  Scoring reads every whole text.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quire.llm.common import byte_texts, packs, release, stored

SAMPLE = 3000
WINDOW_BYTES = 24
DICTIONARY_BYTES = 110 << 10
TOXIC_BYTES = 8 << 10
LEVEL = 10
THRESHOLDS = (1, 2, 3, 4, 5, 6)
N_FEATURES = 2 * len(THRESHOLDS) + 2
#: Lengths of the word beginnings that are looked at, for languages that add endings.
STEMS = (4, 5, 6)
#: How often, and by which log ratio more often, a word must be used for its windows to train the toxic dictionary.
LEAST_USES, LEAST_SHARE, LEAST_RATIO = 5, 0.01, 3.0
#: Bytes before every window that both dictionaries end with, so that a window is never stored uncompressed,
#: and bytes after it, because zstandard looks for no match in the last eight.
BEFORE = bytes((37 * i + 11) % 89 + 33 for i in range(32)) + b" "
AFTER = b" ~~~~~~~~"
CUT = 0.3
#: Windows whose gains a worker keeps, as words come again.
KEPT_WINDOWS = 400_000
_WINDOWS = re.compile(rb"[^\x20\x09-\x0D]{1,%d}" % WINDOW_BYTES)
_TOKEN = re.compile(rb"[^\x20\x09-\x0D]+")
_WORD = re.compile(rb"[^\x00-\x40\x5b-\x60\x7b-\x7f]+")


def windows(text: bytes) -> list[bytes]:
    """The whole text in windows: its words, those longer than ``WINDOW_BYTES`` in pieces."""
    return _WINDOWS.findall(text.lower())


#: Gains of a worker's windows by the dictionaries that they hold for: fitting and scoring share them.
_known: dict[tuple[int, int], dict[bytes, int]] = {}


@dataclass
class Model:
    ordinary: bytes
    toxic: bytes
    weights: np.ndarray

    def gains(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Bytes by which each window is shorter under the toxic dictionary than under the ordinary one, and each text's first window (one more entry than texts)."""
        found = [windows(t) for t in texts]
        first = np.concatenate([[0], np.cumsum([len(x) for x in found])]).astype(np.int64)
        known = _known.setdefault(key := (hash(self.ordinary), hash(self.toxic)), {})
        if len(_known) > 1:  # of other dictionaries
            for other in _known.keys() - {key}:
                del _known[other]
        if len(known) > KEPT_WINDOWS:
            known.clear()
        fresh = {w for x in found for w in x} - known.keys()
        if fresh:
            framed, sizes = [BEFORE + b" " + w + b" " + AFTER for w in fresh], []
            for packer in self.packers():
                sizes.append([len(packer.compress(w)) for w in framed])
            known.update(zip(fresh, map(int.__sub__, *sizes), strict=True))
        return np.fromiter((known[w] for x in found for w in x), dtype=np.int64, count=int(first[-1])), first

    def packers(self) -> list[zstandard.ZstdCompressor]:
        if not hasattr(self, "_packers"):
            self._packers = []
            for content in (self.ordinary + BEFORE, self.toxic + BEFORE):
                data = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
                data.precompute_compress(level=LEVEL)
                self._packers.append(zstandard.ZstdCompressor(level=LEVEL, dict_data=data, write_checksum=False, write_content_size=False, write_dict_id=False))
        return self._packers

    def __getstate__(self):
        return {"ordinary": self.ordinary, "toxic": self.toxic, "weights": self.weights}

    def features(self, texts: list[bytes]) -> np.ndarray:
        gains, first = self.gains(texts)
        count = np.maximum(np.diff(first), 1)
        out = np.zeros((len(texts), N_FEATURES))
        out[:, 0] = 1
        out[:, -1] = np.log(count)
        some = np.flatnonzero(first[1:] > first[:-1])
        if len(some):
            for k, least in enumerate(THRESHOLDS):
                beyond = np.add.reduceat((gains >= least).astype(np.int64), first[some])
                out[some, 2 * k + 1] = np.log1p(beyond)
                out[some, 2 * k + 2] = np.sqrt(beyond / count[some])
        return out

    def scores(self, texts: list[bytes]) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.features(texts) @ self.weights, -30, 30)))


def forms(token: bytes) -> list[bytes]:
    """The word in a lower-cased token, and its beginnings marked as such."""
    word = b"".join(_WORD.findall(token)[:1])
    return [word, *(word[:k] + b"*" for k in STEMS if len(word) > k)] if word else []


def uses(text: bytes) -> set[tuple[bytes, int]]:
    """Words and word beginnings of a text, each with a hash of the word before: so copies of one text count once."""
    out, before = set(), b""
    for token in _TOKEN.findall(text.lower()):
        own = forms(token)
        out.update((form, zlib.crc32(before)) for form in own)
        before = own[0] if own else b""
    return out


def _dictionary(samples: list[bytes], size: int) -> bytes:
    """A dictionary that zstandard trains on ``samples``; the samples themselves where they are too few for that."""
    samples = [b" " + x + b" " for x in samples]
    groups = [b"".join(samples[i : i + 8]) for i in range(0, len(samples), 8)]
    try:
        return zstandard.train_dictionary(size, groups, k=64, d=6).as_bytes()
    except zstandard.ZstdError:
        return b"".join(dict.fromkeys(samples))[-size:]


def _logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1.0, rounds: int = 50) -> np.ndarray:
    """Weights of a logistic model by Newton's method."""
    scale = np.maximum(x.max(axis=0), 1)
    x, w = x / scale, np.zeros(x.shape[1])
    keep = np.full(len(w), ridge)
    keep[0] = 1e-6
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve(x.T @ (x * (p * (1 - p))[:, None]) + np.diag(keep), x.T @ (p - y) + keep * w)
        w = w - step
        if np.abs(step).max() < 1e-9:
            break
    return w / scale


def _emitted(texts: DataFrame, make, schema: str) -> DataFrame:
    """Rows that ``make(text)`` gives for each of ``texts (text)``, in batches as they come."""
    names = [x.split()[0] for x in schema.split(", ")]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = byte_texts(batch.column(0))
            for lo, hi in packs(texts):
                if rows := [row for t in texts[lo:hi] for row in make(t)]:
                    yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*rows, strict=True)], names=names)

    return texts.select("text").mapInArrow(work, schema)


def _gathered(texts: DataFrame, found) -> list[bytes]:
    """What ``found`` gives for each text of a bounded table, all of it, in order."""
    return sorted(bytes(r.window) for r in _emitted(texts, lambda t: [(w,) for w in found(t)], "window binary").toLocalIterator(prefetchPartitions=True))


def _measured(texts: DataFrame, model: Model) -> list[list[float]]:
    """Features of the texts of a bounded table."""
    shared = texts.sparkSession.sparkContext.broadcast(model)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = byte_texts(batch.column(0))
            for lo, hi in packs(own):
                yield pa.RecordBatch.from_arrays([pa.array(shared.value.features(own[lo:hi]).tolist(), pa.list_(pa.float64()))], names=["x"])

    return [r.x for r in texts.select("text").mapInArrow(work, "x array<double>").collect()]


def fit(texts: DataFrame) -> Model:
    """Dictionaries, and thresholds' weights, from ``texts (text, y)``, a bounded table."""
    n = {r.y: r.n for r in texts.groupBy("y").agg(F.count_distinct("text").alias("n")).collect()}
    if not n.get(0) or not n.get(1):
        prior = (n.get(1, 0) + 0.5) / (sum(n.values()) + 1)
        return Model(b"ordinary text", b"toxic text", np.array([np.log(prior / (1 - prior)), *[0.0] * (N_FEATURES - 1)]))
    counted = lambda part, make: _emitted(part, make, "form binary, before long").distinct().groupBy("form").agg(F.count("*").alias("n"))
    toxic, ordinary = texts.where("y = 1"), texts.where("y = 0")
    many = {bytes(r.form): r.n for r in counted(toxic, uses).where(F.col("n") >= max(LEAST_USES, LEAST_SHARE * n[1])).collect()}
    few = {bytes(r.form): r.n for r in counted(ordinary, lambda t: [u for u in uses(t) if u[0] in many]).collect()}
    telling = {w for w, c in many.items() if np.log((c + 0.5) / n[1]) - np.log((few.get(w, 0) + 0.5) / n[0]) > LEAST_RATIO}
    places = _gathered(toxic, lambda t: [w for w in _TOKEN.findall(t.lower()) if any(f in telling for f in forms(w))])
    plain = _gathered(ordinary, windows)
    model = Model(_dictionary(_shuffled(plain), DICTIONARY_BYTES), _dictionary(_shuffled(places), TOXIC_BYTES) if places else b"", np.zeros(N_FEATURES))
    x = [_measured(ordinary, model), _measured(toxic, model)]
    model.weights = _logistic(np.array(x[0] + x[1]), np.repeat([0.0, 1.0], [len(x[0]), len(x[1])]))
    return model


def _shuffled(samples: list[bytes]) -> list[bytes]:
    """In an order that follows from nothing but their number; the trainer reads neighbours together."""
    return [samples[k] for k in np.random.default_rng(0).permutation(len(samples))]


def learn(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic") -> Model:
    """A model from the labelled rows whose ``crc32(id) % 4`` is not 2, within the sample bounds of this module.

    Labels without an id or a value are left out; a null text is empty.  Without labels of both classes every text gets
    the same score, which follows their share.
    """
    usable = labels.where(F.col(label_col).isNotNull() & F.col(id_col).isNotNull() & (F.crc32(F.col(id_col).cast("string").cast("binary")) % 4 != 2))
    order = F.xxhash64(F.lit("fit"), F.col(id_col))
    picked = usable.select(F.col(id_col).alias("id"), (F.col(label_col) > 0).cast("int").alias("y"), order.alias("h"))
    sample = picked.where("y = 1").orderBy("h").limit(SAMPLE).union(picked.where("y = 0").orderBy("h").limit(SAMPLE))
    true = {r["y"]: r["count"] for r in picked.groupBy("y").count().collect()}
    rows = docs.select(F.col(id_col).alias("doc"), F.col(text_col).alias("text"))
    texts = stored(rows.join(F.broadcast(sample), rows.doc == sample.id).select(F.coalesce("text", F.lit("")).alias("text"), "y"))  # 2 * SAMPLE ids at most
    model = fit(texts)
    # the sample may hold the classes in other shares than the labels do
    have = {r["y"]: r["count"] for r in texts.groupBy("y").count().collect()}
    if have.get(0) and have.get(1) and true.get(0) and true.get(1):
        model.weights[0] += np.log(true[1] / true[0]) - np.log(have[1] / have[0])
    release(texts)
    return model


def toxicity(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(id_col, held_out, score, predicted)`` for each row, from the whole text.

    A null or empty text has no windows and gets the score of a text without any gain; equal
    texts have equal scores, so repeated rows have equal results; a very long text is judged by all its
    windows; a null id counts as not held out.  Other columns are not read.  An empty table gives an empty result.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = byte_texts(batch.column(1))
            scores = np.concatenate([shared.value.scores(texts[lo:hi]) for lo, hi in packs(texts)] or [np.zeros(0)])
            held = [i is not None and zlib.crc32(str(i).encode()) % 4 == 2 for i in batch.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(held, pa.bool_()), pa.array(scores), pa.array((scores >= CUT).astype(np.int32))], names=[id_col, "held_out", "score", "predicted"])

    rows = docs.select(id_col, text_col)
    return rows.mapInArrow(work, T.StructType([rows.schema[id_col], T.StructField("held_out", T.BooleanType()), T.StructField("score", T.DoubleType()), T.StructField("predicted", T.IntegerType())]))
