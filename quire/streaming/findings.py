"""Findings kept up to date: a new version of a file takes its old findings back and adds its own.

What a file contributes to a finding is a row of counts (how often it is found, how often each rule is missing, ...).
Counts can be taken back, unlike a minimum or an ``or`` of bits.  A stateful stream keeps, per file, the newest version
and its contributions; when a newer one comes, in whatever order versions arrive, it emits the differences,
and older ones are ignored.  The table of differences is append-only, exactly once, and its sums are the state: they equal
a reduce over the newest versions of all files.  ``compacted`` replaces many differences by their sums.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from functools import reduce

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

VERSIONS = "file_id string, version long, findings array<struct<finding:string,counts:array<long>>>"
CHANGES = "finding string, counts array<long>"


def contributions(files: DataFrame, findings: DataFrame, values: dict[str, Column], finding: str = "finding") -> DataFrame:
    """``VERSIONS`` of ``files (file_id, version)``: sums of ``values`` over the ``findings (file_id, version, finding, ...)`` of each.

    A file without findings is a version too: it takes back what older ones contributed.  Null findings are left out.
    """
    found = findings.where(F.col(finding).isNotNull())
    sums = found.groupBy("file_id", "version", F.col(finding).alias("finding")).agg(F.array(*[F.sum(v.cast("long")) for v in values.values()]).alias("counts"))
    held = sums.groupBy("file_id", "version").agg(F.collect_list(F.struct("finding", "counts")).alias("findings"))
    known = files.select(F.col("file_id").cast("string"), F.col("version").cast("long")).distinct()
    held = held.select(F.col("file_id").cast("string"), F.col("version").cast("long"), "findings")
    return known.join(held, ["file_id", "version"], "left").withColumn("findings", F.coalesce("findings", F.array().cast(held.schema["findings"].dataType)))


class NewestVersion(StatefulProcessor):
    """Keeps a file's newest version and emits what it changes."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.kept = handle.getValueState("kept", "version long, findings string")

    def handleInputRows(self, key: tuple, rows: Iterator[Row], timerValues) -> Iterator[Row]:  # noqa: N802, N803
        newest = max(rows, key=lambda r: r.version)
        old = self.kept.get()  # none for a file that is new
        if old is not None and old[0] >= newest.version:
            return
        own = {f["finding"]: [int(n) for n in f["counts"]] for f in newest.findings}
        change: dict[str, list[int]] = {}
        for sign, findings in ((-1, json.loads(old[1]) if old is not None else {}), (1, own)):
            for finding, counts in findings.items():
                sums = change.setdefault(finding, [0] * len(counts))
                for k, n in enumerate(counts):
                    sums[k] += sign * n
        self.kept.update((int(newest.version), json.dumps(own)))
        for finding, counts in change.items():
            if any(counts):
                yield Row(finding=finding, counts=counts)

    def close(self) -> None:
        pass


def changes(versions: DataFrame) -> DataFrame:
    """The stream of ``CHANGES`` that a stream of ``VERSIONS`` makes."""
    versions.sparkSession.conf.set("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    return versions.groupBy("file_id").transformWithState(NewestVersion(), CHANGES, "Append", "None")


def take_versions(spark: SparkSession, folder: str, table: str, checkpoint: str, most_files: int = 1000) -> StreamingQuery:
    """Takes in the ``VERSIONS`` that have come to the Parquet ``folder`` since the last call and adds their changes to ``table``."""
    versions = spark.readStream.schema(VERSIONS).option("maxFilesPerTrigger", most_files).parquet(folder)
    return changes(versions).writeStream.format("parquet").option("path", table).option("checkpointLocation", checkpoint).outputMode("append").trigger(availableNow=True).start()


def state(table: DataFrame, names: list[str], finding: str = "finding") -> DataFrame:
    """``(finding, *names)``: the sums of all changes, for findings that some file still has; the first name counts them."""
    sums = table.groupBy(F.col("finding").alias(finding)).agg(*[F.sum(F.get("counts", F.lit(k))).alias(n) for k, n in enumerate(names)])
    return sums.where(F.col(names[0]) > 0)


def compacted(table: DataFrame, n: int) -> DataFrame:
    """Changes that stand for those of ``table``: one per finding."""
    return table.groupBy("finding").agg(F.array(*[F.sum(F.get("counts", F.lit(k))) for k in range(n)]).alias("counts")).where(F.exists("counts", lambda c: c != 0))


def bits_of(names: list[str]) -> Column:
    """A bit for each of the columns ``names`` that is not zero."""
    return reduce(lambda a, b: a.bitwiseOR(b), [F.when(F.col(n) > 0, 1 << k).otherwise(0) for k, n in enumerate(names)])
