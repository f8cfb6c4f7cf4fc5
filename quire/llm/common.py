"""Pieces that several operators of this package share."""

from __future__ import annotations

import atexit
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def shared_folder(spark: SparkSession) -> str:
    """The folder that driver and executors share, as ``spark.checkpoint.dir`` names it.

    Only a local-mode session, where all tasks live on this machine, may go without the
    setting; it then gets a temporary folder.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    if spark.sparkContext.getCheckpointDir() is None:
        import tempfile

        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="quire-"))
    return spark.sparkContext.getCheckpointDir().rstrip("/")


#: Stored tables of this process, in order.
_made: list[tuple[SparkSession, str]] = []
#: Effort of zstandard in ``stored`` tables, where that codec is asked for.
ZSTD_LEVEL = 9


def stored(df: DataFrame, codec: str = "snappy", page: int = 1 << 20) -> DataFrame:
    """``df`` written as Parquet to the shared folder and read back: computed once and cut off from its lineage.

    Smaller on disk than a checkpoint and readable column by column.  A ``page`` of so many bytes is compressed by itself.  The files go when the
    driver's process ends, or before by ``release`` or ``release_since``.
    """
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/quire-{uuid.uuid4().hex}"
    df.write.option("compression", codec).option("parquet.compression.codec.zstd.level", ZSTD_LEVEL).option("parquet.page.size", page).parquet(path)
    removed_at_exit(spark, path)
    _made.append((spark, path))
    out = spark.read.schema(df.schema).parquet(path)
    out.stored_at = path
    return out


def removed_at_exit(spark: SparkSession, path: str) -> None:
    """Notes that a folder of intermediate files goes when the driver's process ends."""
    atexit.register(_remove, spark, path)


def release(df: DataFrame) -> None:
    """Removes the files of a ``stored`` table that nothing will read any more."""
    _remove(df.sparkSession, df.stored_at)


def mark() -> int:
    """A point in time for ``release_since``."""
    return len(_made)


def release_since(when: int, but: DataFrame) -> None:
    """Removes the files of the tables stored since ``when``, but for one of them; nothing else may read them any more."""
    for spark, path in _made[when:]:
        if path != but.stored_at:
            _remove(spark, path)


def _remove(spark: SparkSession, path: str) -> None:
    try:
        target = spark._jvm.org.apache.hadoop.fs.Path(path)
        target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)
    except Exception:  # the session may have ended before its files were removed
        pass


def connected_components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """Smallest vertex that each vertex of ``edges (a, b)`` can reach, as ``(vertex, root)``.

    Alternates large-star and small-star steps; each round is a few shuffles of the edge list,
    whose length never grows, and its result is stored in place of the round's before.  Vertices without an edge to
    another vertex do not appear.
    """
    both = edges.where("a <> b").select(F.greatest("a", "b").alias("v"), F.least("a", "b").alias("u")).distinct()
    links, seen = stored(both), None
    for _ in range(max_rounds):
        near = links.union(links.select(F.col("u").alias("v"), F.col("v").alias("u")))
        least = near.groupBy("v").agg(F.min("u").alias("m")).select(F.col("v").alias("k"), F.least("m", "v").alias("m"))
        large = near.join(least, near.v == least.k).where("u > v").select(F.col("u").alias("v"), F.col("m").alias("u")).distinct()
        low = large.groupBy("v").agg(F.min("u").alias("m")).withColumnRenamed("v", "k")
        met = large.join(low, large.v == low.k)
        last = links
        links = stored(
            met.where("u <> m").select(F.col("u").alias("v"), F.col("m").alias("u")).union(low.select(F.col("k").alias("v"), F.col("m").alias("u"))).distinct()
        )
        release(last)
        now = links.agg(F.count("*"), F.sum(F.xxhash64("v", "u") % F.lit(1 << 40))).first()
        if now == seen or now[0] == 0:
            break
        seen = now
    else:
        raise RuntimeError("components did not settle")
    roots = links.groupBy("v").agg(F.min("u").alias("u"))
    return roots.select(F.col("v").alias("vertex"), F.col("u").alias("root")).union(roots.select("u", "u").distinct())


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit values (two xor-shift-multiply rounds)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, 9, 10, 11, 12, 13]] = True
_FACTORS = mixed(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)) | np.uint64(1)


class Words:
    """Words ``[^\\x20\\x09-\\x0D]+`` of several UTF-8 texts, found together with numpy.

    ``first[i]:first[i + 1]`` are text i's words; ``start`` and ``end`` are byte offsets into
    ``data``; ``code`` holds a 64-bit hash of each word's bytes.
    """

    def __init__(self, texts: list[bytes]):
        self.data = b" ".join([*texts, b""])
        raw = np.frombuffer(self.data, dtype=np.uint8)
        solid = np.concatenate([[False], ~_SPACE[raw], [False]])
        edge = np.flatnonzero(solid[1:] != solid[:-1])
        self.start, self.end = edge[::2], edge[1::2]
        ends = np.cumsum(np.fromiter((len(t) + 1 for t in texts), dtype=np.int64, count=len(texts)))
        self.first = np.concatenate([[0], np.searchsorted(self.start, ends)]).astype(np.int64)
        size = self.end - self.start
        if len(size):
            at = np.flatnonzero(solid[1:-1])
            begin = np.concatenate([[0], np.cumsum(size)[:-1]])
            place = np.arange(len(at), dtype=np.int64) - np.repeat(begin, size)
            turn = (place >> 8).astype(np.uint64) * np.uint64(2) + np.uint64(1)
            parts = (raw[at].astype(np.uint64) + np.uint64(1)) * _FACTORS[place & 255] * turn
            self.code = mixed(np.add.reduceat(parts, begin) + size.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
        else:
            self.code = np.zeros(0, dtype=np.uint64)


#: Odd factors of two independent hashes of runs of words.
FACTOR, SECOND_FACTOR = np.uint64(0xD6E8FEB86659FD93), np.uint64(0xA3B195354A39B70D)


def grams(code: np.ndarray, n: int, factor: np.uint64 = FACTOR) -> np.ndarray:
    """Hashes of all runs of ``n`` codes by doubling: a run of 2k joins two runs of k."""
    if len(code) < n:
        return np.zeros(0, dtype=np.uint64)
    done, out = 1, code
    while done < n:
        step = min(done, n - done)
        out = mixed(out[:-step] * factor + out[step:] + np.uint64(step))
        done += step
    return out


def packs(texts: list[bytes], most: int = 1 << 20) -> Iterator[tuple[int, int]]:
    """Runs of texts of about ``most`` bytes together, so that numpy's arrays stay small."""
    begin, held = 0, 0
    for i, text in enumerate(texts):
        if held and held + len(text) > most:
            yield begin, i
            begin, held = i, 0
        held += len(text) + 1
    if begin < len(texts):
        yield begin, len(texts)


def byte_texts(column: pa.Array) -> list[bytes]:
    """UTF-8 bytes of a string column; null becomes empty."""
    return [x or b"" for x in column.cast(pa.binary()).to_pylist()]
