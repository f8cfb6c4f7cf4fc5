"""State of findings under versions that come in any order."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from quire.streaming import findings as kept


@pytest.mark.parametrize("seed", range(2))
def test_state_equals_the_newest_versions(spark, tmp_path, seed):
    rng = random.Random(seed)
    versions = {(f"f{k}", v): [(rng.choice("abcde"), rng.randrange(2)) for _ in range(rng.randrange(5))] for k in range(12) for v in range(1, rng.randrange(2, 6))}
    order = list(versions)
    rng.shuffle(order)
    table, folder = str(tmp_path / "table"), str(tmp_path / "versions")
    for begin in range(0, len(order), 13):  # batches in random order, several versions of a file in one
        own = order[begin : begin + 13]
        files = spark.createDataFrame(own, "file_id string, version int")
        found = spark.createDataFrame([(f, v, name, bad) for f, v in own for name, bad in versions[f, v]] + [(*own[0], None, 1)], "file_id string, version int, finding string, bad int")
        kept.contributions(files, found, {"places": F.lit(1), "bad": F.col("bad")}).write.mode("append").parquet(folder)
        kept.take_versions(spark, folder, table, str(tmp_path / "checkpoint")).awaitTermination()
    newest = {f: max(v for g, v in versions if g == f) for f, _ in versions}
    want = {}
    for f, v in newest.items():
        for name, bad in versions[f, v]:
            places, wrong = want.get(name, (0, 0))
            want[name] = places + 1, wrong + bad
    changes = spark.read.schema(kept.CHANGES).parquet(table)
    assert {r.finding: (r.places, r.bad) for r in kept.state(changes, ["places", "bad"]).collect()} == want
    small = kept.compacted(changes, 2)
    assert small.count() == len(want)
    assert {r.finding: (r.places, r.bad) for r in kept.state(small, ["places", "bad"]).collect()} == want
    kept.take_versions(spark, folder, table, str(tmp_path / "checkpoint")).awaitTermination()  # nothing new: nothing changes
    assert spark.read.parquet(table).count() == changes.count()


def test_versions_without_findings(spark):
    files = spark.createDataFrame([("a", 1), ("b", 2)], "file_id string, version int")
    none = spark.createDataFrame([], "file_id string, version int, finding string")
    got = kept.contributions(files, none, {"places": F.lit(1)}).collect()
    assert sorted((r.file_id, r.version, r.findings) for r in got) == [("a", 1, []), ("b", 2, [])]
