"""Quality by importance resampling: hashed n-gram models of target and raw text, and Gumbel top-k.

Two generative models are counted into hash buckets: raw text (every row of the corpus) and target text
(labelled rows of good quality).  N-grams are of two kinds with a distribution each: single words and
pairs of words, and pairs of word shapes (case, closing mark, digits, length, repetition of the
word before), which carry over to words never seen.  A document's importance weight is the
ratio of its probabilities under the two models.

``resampled`` draws rows in proportion to their weights without replacement: independent Gumbel noise is
added to the log weights and the k largest sums are taken.  ``accepted`` is the classifier
that belongs to it: the log ratio per word, held against a threshold set on labelled rows.

The target model and the threshold come from at most ``SAMPLE`` labelled rows of each class, smallest
hashes of the id first.  Raw counts, scores and decisions cover all rows and whole texts.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quire.llm.common import Words, byte_texts, mixed, packs, stored

SAMPLE = 5000
BUCKETS = 1 << 13
#: Words that a short text's mean log ratio is thought to have besides its own, with ratio 0.
PRIOR_WORDS = 10
TEMPERATURE = 1.0
#: Rows of the last interval in which the k-th largest key is looked up directly.
FEW_ROWS = 10_000

_CLASS = np.full(256, 3, dtype=np.uint8)  # 0 letter, 1 pause mark, 2 exclamation, 3 other sign, 4 digit
_CLASS[[*range(65, 91), *range(97, 123), *range(128, 256)]] = 0
_CLASS[[*b".,;:"]] = 1
_CLASS[[*b"!?"]] = 2
_CLASS[[*range(48, 58)]] = 4


def shapes(words: Words) -> np.ndarray:
    """A small number for the look of each word and whether it repeats the one before."""
    raw = np.frombuffer(words.data, dtype=np.uint8)
    start, end = words.start, words.end
    held = lambda mask: np.diff(np.concatenate([[0], np.cumsum(mask)])[np.column_stack([start, end])], axis=1)[:, 0]
    upper, letters, digits = held((raw >= 65) & (raw <= 90)), held(_CLASS[raw] == 0), held(_CLASS[raw] == 4)
    size = end - start
    again = np.concatenate([[False], words.code[1:] == words.code[:-1]]) if len(size) else np.zeros(0, dtype=bool)
    again[words.first[:-1][words.first[:-1] < len(size)]] = False  # the word before is another text's
    out = (upper >= 2) & (2 * upper > letters)
    for part, base in (((raw[start] >= 65) & (raw[start] <= 90), 2), (_CLASS[raw[end - 1]], 5), (digits > 0, 2), (np.minimum(size // 4, 3), 4), (again, 2), (letters + digits == 0, 2)):
        out = out.astype(np.int64) * base + part
    return out


def ngrams(words: Words) -> tuple[np.ndarray, np.ndarray]:
    """Bucket of each n-gram of the texts, and the text that it belongs to."""
    of = np.repeat(np.arange(len(words.first) - 1), np.diff(words.first))
    shape = shapes(words).astype(np.uint64)
    inside = np.flatnonzero(of[1:] == of[:-1])
    pick = lambda x: (mixed(x) % np.uint64(BUCKETS)).astype(np.int64)
    look = pick(shape[inside] * np.uint64(4096) + shape[inside + 1])
    single = pick(words.code) + BUCKETS
    double = pick(words.code[inside] * np.uint64(3) + mixed(words.code[inside + 1])) + BUCKETS
    return np.concatenate([look, single, double]), np.concatenate([of[inside], of, of[inside]])


@dataclass
class Model:
    ratio: np.ndarray
    threshold: float = 0.0

    def scores(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Log weight of each text, and the log ratio per word."""
        words = Words(texts)
        bucket, of = ngrams(words)
        total = np.bincount(of, weights=self.ratio[bucket], minlength=len(texts))
        return total, total / (np.diff(words.first) + PRIOR_WORDS)


def _sample(labels: DataFrame, id_col: str, label_col: str) -> DataFrame:
    known = labels.where(F.col(label_col).isNotNull() & F.col(id_col).isNotNull()).select(F.col(id_col).alias("known"), (F.col(label_col) > 0).alias("good")).distinct()
    order = F.xxhash64(F.lit("quality"), "known")
    return known.where("good").orderBy(order).limit(SAMPLE).union(known.where("not good").orderBy(order).limit(SAMPLE))


def learn(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality") -> Model:
    """Both models from the corpus and its labelled rows, and the threshold between good and bad labelled rows."""
    sample = F.broadcast(_sample(labels, id_col, label_col))  # 2 * SAMPLE ids at most
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    marked = rows.join(sample, rows.id == sample.known, "left").select("text", F.coalesce("good", F.lit(False)).alias("good"))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        raw, target = np.zeros(2 * BUCKETS, dtype=np.int64), np.zeros(2 * BUCKETS, dtype=np.int64)
        for batch in batches:
            texts, good = byte_texts(batch.column(0)), np.array(batch.column(1).to_pylist(), dtype=bool)
            for lo, hi in packs(texts):
                bucket, of = ngrams(Words(texts[lo:hi]))
                raw += np.bincount(bucket, minlength=2 * BUCKETS)
                target += np.bincount(bucket[good[lo:hi][of]], minlength=2 * BUCKETS)
        some = np.flatnonzero(raw)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(raw[some]), pa.array(target[some])], names=["bucket", "raw", "target"])

    counts = np.zeros((2, 2 * BUCKETS))
    for r in marked.mapInArrow(count, "bucket long, raw long, target long").groupBy("bucket").agg(F.sum("raw").alias("raw"), F.sum("target").alias("target")).collect():
        counts[:, r.bucket] = r.raw, r.target
    model = Model(np.zeros(2 * BUCKETS))
    for part in (slice(0, BUCKETS), slice(BUCKETS, 2 * BUCKETS)):
        own = counts[:, part]
        share = (own[0] + 1) / (own[0].sum() + BUCKETS)
        # the target is smoothed towards the raw text: a bucket that it lacks counts as seen 0.5 times at the raw rate's weight
        weight = 0.05 * max(1.0, own[1].sum()) / 100
        model.ratio[part] = np.log((own[1] + weight * share) / (own[1].sum() + weight)) - np.log(share) if own[1].sum() else 0
    checked = rows.join(sample, rows.id == sample.known).select("id", "text", "good")
    found = scored(checked, model, "id", "text", ["good"]).select("per_word", "good").collect()
    model.threshold = _between(np.array([r.per_word for r in found]), np.array([r.good for r in found], dtype=bool))
    return model


def _between(score: np.ndarray, good: np.ndarray) -> float:
    """The cut that errs least on both classes, in the middle of its gap; below everything if a class is absent."""
    if not good.any() or good.all():
        return -1e9
    order = np.argsort(score, kind="stable")
    s, g = score[order], good[order]
    lost, passed = np.concatenate([[0], np.cumsum(g)]) / g.sum(), 1 - np.concatenate([[0], np.cumsum(~g)]) / (~g).sum()
    cuts = np.flatnonzero((2 * lost + passed) <= (2 * lost + passed).min() + 1e-12)
    edges = np.concatenate([[s[0] - 1], s, [s[-1] + 1]])
    gaps = edges[cuts + 1] - edges[cuts]
    k = cuts[np.argmax(gaps)]
    return float((edges[k] + edges[k + 1]) / 2)


def scored(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text", keep: list[str] | None = None) -> DataFrame:
    """``(id_col, log_weight, per_word, *keep)`` of every row.

    Null and empty texts have weight 1 (log weight 0); repeated rows have equal results, null ids stay null, a very long text is
    read whole, columns beside ``keep`` are not read, and an empty table gives an empty result.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    keep = keep or []

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = byte_texts(batch.column(1))
            got = [shared.value.scores(texts[lo:hi]) for lo, hi in packs(texts)]
            total, mean = (np.concatenate(x) for x in zip(*got, strict=True)) if got else (np.zeros(0), np.zeros(0))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(total), pa.array(mean), *batch.columns[2:]], names=[id_col, "log_weight", "per_word", *keep])

    rows = docs.select(id_col, text_col, *keep)
    return rows.mapInArrow(work, T.StructType([rows.schema[id_col], T.StructField("log_weight", T.DoubleType()), T.StructField("per_word", T.DoubleType()), *(rows.schema[k] for k in keep)]))


def gumbel(key: Column, seed: int = 0) -> Column:
    """Gumbel noise that depends on ``key`` and ``seed`` alone."""
    even = (F.shiftrightunsigned(F.xxhash64(F.lit(seed), key), 11).cast("double") + 0.5) / float(1 << 53)
    return -F.log(-F.log(even))


def kth_largest(df: DataFrame, column: str, k: int) -> float | None:
    """The k-th largest value of a double column: counts over ever narrower intervals, then a look into the last one."""
    low, high, n = df.agg(F.min(column), F.max(column), F.count(column)).first()
    if not 0 < k <= n:
        return None if k <= 0 else low
    while n > FEW_ROWS and low < high:
        width = (high - low) / 1000
        if low + width == low:
            break
        inside = df.where(F.col(column).between(low, high))
        bins = {r.bin: (r.n, r.low, r.high) for r in inside.groupBy(F.least(F.floor((F.col(column) - low) / width), F.lit(999)).alias("bin")).agg(F.count("*").alias("n"), F.min(column).alias("low"), F.max(column).alias("high")).collect()}
        for b in sorted(bins, reverse=True):
            n, low, high = bins[b]
            if k <= n:
                break
            k -= n
    if low == high:
        return low
    return df.where(F.col(column).between(low, high)).select(column).orderBy(F.desc(column)).limit(k).agg(F.min(column)).first()[0]


def resampled(weights: DataFrame, k: int, id_col: str = "doc_id", seed: int = 0) -> DataFrame:
    """``weights`` with ``key`` (log weight plus Gumbel noise) and ``sampled``: the k largest keys, with all rows that tie with the last.

    Noise goes by id, so rows that share one, also a null one, share it; repeated rows are sampled together.  With k of zero, or an
    empty table, nothing is sampled.  Columns named ``key`` or ``sampled`` are replaced.
    """
    keyed = weights.withColumn("key", F.col("log_weight") / TEMPERATURE + gumbel(F.col(id_col), seed))
    least = kth_largest(keyed, "key", k)
    return keyed.withColumn("sampled", F.lit(False) if least is None else F.col("key") >= F.lit(least))


def quality(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality") -> DataFrame:
    """``(id_col, log_weight, per_word, accepted, key, sampled)`` of every row; as many rows are sampled as are accepted.

    A null or empty text has weight 1 (log weight 0).  Equal texts have equal weights; noise goes by id, so
    repeated rows have equal keys, and so do all rows with a null id and one text; rows that tie with the last
    key are sampled all.  Very long texts are read whole.  Without labels of both classes everything is accepted;
    an empty table gives an empty result.  Other columns are not read.
    """
    model = learn(docs, labels, id_col, text_col, label_col)
    rows = stored(scored(docs, model, id_col, text_col).withColumn("accepted", F.col("per_word") >= model.threshold))
    return resampled(rows, rows.where("accepted").count(), id_col)


def accepted(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality") -> DataFrame:
    """The rows of ``docs`` whose log ratio per word reaches the threshold, columns unchanged.

    This is the filter of a pipeline, which must keep every clean document: Gumbel top-k (``resampled``) draws a
    training set of given size and would leave clean documents out by chance.  A null or empty text has the
    log ratio 0; repeated rows stay or go together; a null id and columns of any name stay as they are; long texts
    are read whole.  Without labels of both classes every row stays; an empty table gives an empty result.
    """
    model = learn(docs, labels, id_col, text_col, label_col)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = byte_texts(batch.column(text_col))
            stay = np.concatenate([shared.value.scores(texts[lo:hi])[1] for lo, hi in packs(texts)] or [np.zeros(0)]) >= shared.value.threshold
            yield batch.filter(pa.array(stay))

    return docs.mapInArrow(work, docs.schema)
