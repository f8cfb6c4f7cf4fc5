"""The map executor: calls a detector once for each distinct check and text, and remembers the answers.

Answers belong to the hash of check and text and are kept in a store in a shared folder.  Before any work, tasks meet
the store and those that it answers go.  What is left is dealt to buckets by its hash, in rounds if it is much, so that a
bucket's task reads no more than ``ROUND_BYTES`` of texts or so, however many there are.  A bucket's task first
looks at what earlier attempts of it have stored, then calls the detector and stores what it gets in files of few
answers, so an executor that is lost takes at most the calls of an unfinished file with it, and with
``calls_per_file=1`` none.  Errors are rows too; they are tried again in the next run.
"""

from __future__ import annotations

import math
import time
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
import pyarrow.parquet as pq
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quire.sources.shared import staged

#: Bytes of texts that a bucket takes in a round.
ROUND_BYTES = 256 << 20
ANSWERS = "task_key string, answer string, error string, tries int"
_ARROW = pa.schema([("task_key", pa.string()), ("answer", pa.string()), ("error", pa.string()), ("tries", pa.int32())])


def task_key(check: Column, text: Column) -> Column:
    """The hash that an answer belongs to."""
    return F.sha2(F.concat(F.coalesce(check, F.lit("")), F.lit("\x1f"), F.coalesce(text, F.lit(""))), 256)


def answers(spark: SparkSession, store: str) -> DataFrame:
    """``ANSWERS`` of a store, one row per key: an answer if there is one, else the last error."""
    try:
        rows = spark.read.schema(ANSWERS).option("recursiveFileLookup", True).parquet(store)
    except Exception as e:
        if "PATH_NOT_FOUND" not in str(e):
            raise
        return spark.createDataFrame([], ANSWERS)
    best = F.max_by(F.struct("answer", "error", "tries"), F.struct(F.col("answer").isNotNull(), F.col("tries")))
    return rows.groupBy("task_key").agg(best.alias("a")).select("task_key", "a.*")


def _bucket_work(store: str, detector: Callable[[str, str], str], retries: int, wait_s: float, calls_per_file: int):
    def stored(system, folder: str) -> set[str]:
        from pyarrow import fs

        files = [f.path for f in system.get_file_info(fs.FileSelector(folder, allow_not_found=True)) if f.path.endswith(".parquet") and not f.base_name.startswith("_")]
        known: set[str] = set()
        for path in files:
            table = pq.read_table(path, filesystem=system, columns=["task_key", "answer"])
            known.update(k for k, a in zip(table[0].to_pylist(), table[1].to_pylist(), strict=True) if a is not None)
        return known

    def called(check: str, text: str) -> tuple[str | None, str | None, int]:
        error = None
        for k in range(1, retries + 2):
            try:
                return detector(check, text), None, k
            except Exception as e:  # a failure is a row
                error = f"{type(e).__name__}: {e}"
                if k <= retries:
                    time.sleep(wait_s * k)
        return None, error, retries + 1

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs

        system, base = fs.FileSystem.from_uri(store)
        known: dict[int, set[str]] = {}
        held: list[tuple] = []

        def keep(bucket: int) -> None:
            folder = f"{base}/bucket={bucket}"
            system.create_dir(folder, recursive=True)
            name = f"{uuid.uuid4().hex}.parquet"
            table = pa.Table.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held, strict=True), _ARROW, strict=True)], schema=_ARROW)
            pq.write_table(table, f"{folder}/_{name}", filesystem=system)
            system.move(f"{folder}/_{name}", f"{folder}/{name}")
            held.clear()

        last, done = None, 0
        for batch in batches:
            for bucket, key, check, text in zip(*(batch.column(k).to_pylist() for k in range(4)), strict=True):
                if bucket not in known:
                    known[bucket] = stored(system, f"{base}/bucket={bucket}")
                if held and (bucket != last or len(held) >= calls_per_file):
                    keep(last)
                last = bucket
                if key in known[bucket]:
                    continue
                held.append((key, *called(check, text)))
                done += 1
        if held:
            keep(last)
        yield pa.RecordBatch.from_arrays([pa.array([done], pa.int64())], names=["calls"])

    return work


def run_tasks(
    tasks: DataFrame, detector: Callable[[str, str], str], store: str, buckets: int = 64, retries: int = 2, wait_s: float = 0.0, calls_per_file: int = 1
) -> DataFrame:
    """``tasks (..., check_type, text)`` with ``task_key``, ``answer``, ``error`` and ``tries``; ``detector(check, text)`` gives an answer's text.

    ``store`` is a URI that Arrow's file systems and Spark know.  Equal tasks are called once, however many rows they have;
    ``buckets`` bounds how many calls run side by side and stays the same for one store.  Null texts count as empty.
    No task, an empty table, calls nothing.
    """
    spark = tasks.sparkSession
    keyed = tasks.withColumn("task_key", task_key(F.col("check_type"), F.col("text")))
    done = answers(spark, store).where("answer is not null").select("task_key")
    todo = keyed.select("task_key", "check_type", F.coalesce("text", F.lit("")).alias("text")).dropDuplicates(["task_key"]).join(done, "task_key", "left_anti")
    size = keyed.agg(F.sum(F.octet_length("text").cast("long"))).first()[0] or 0  # of equal tasks too, so rounds may be smaller
    rounds = max(1, math.ceil(size / (buckets * ROUND_BYTES)))
    placed = todo.select(F.pmod(F.xxhash64("task_key"), F.lit(buckets)).cast("int").alias("bucket"), "task_key", "check_type", "text")
    if rounds > 1:
        placed = staged(placed.withColumn("round", F.pmod(F.xxhash64(F.lit("round"), "task_key"), F.lit(rounds)).cast("int")), "round")
    for k in range(rounds):
        own = placed.where(F.col("round") == k).drop("round") if rounds > 1 else placed
        dealt = own.repartition(buckets, "bucket").sortWithinPartitions("bucket")
        dealt.mapInArrow(_bucket_work(store, detector, retries, wait_s, calls_per_file), "calls long").agg(F.sum("calls")).collect()
    return keyed.join(answers(spark, store), "task_key", "left")
