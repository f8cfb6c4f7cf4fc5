"""One local session for all tests, and a comparison with DuckDB."""

from __future__ import annotations

import os
import tempfile

import pytest
from pyspark.sql import SparkSession

DATA = os.environ.get("QUIRE_TEST_DATA", "/root/testdata/sf0.001")
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="session")
def spark():
    session = (
        SparkSession.builder.master(f"local[{os.environ.get('QUIRE_TEST_CPUS', '4')}]")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="spark-", dir="/tmp"))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def data():
    return DATA


@pytest.fixture(scope="session")
def duck():
    import duckdb

    con = duckdb.connect()
    for name in TABLES:
        path = f"{DATA}/{name}.parquet"
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}{'/*.parquet' if os.path.isdir(path) else ''}')")
    return con


def canonical(columns, rows):
    """Rows as sorted text, columns in order of name."""
    order = sorted(range(len(columns)), key=lambda k: columns[k])
    show = lambda v: f"{v:.6f}" if isinstance(v, float) else str(v)
    return [columns[k] for k in order], sorted(tuple(show(r[k]) for k in order) for r in rows)
