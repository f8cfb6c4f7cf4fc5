from __future__ import annotations

import random

from quire.llm.common import connected_components

from .conftest import collected


def test_chains_stars_and_loops(spark):
    rng = random.Random(1)
    edges = [(k, k + 1) for k in range(40)] + [(100, k) for k in range(101, 160)] + [(200, 200)] + [(rng.randrange(300, 400), rng.randrange(300, 400)) for _ in range(70)]
    root = {v: v for e in edges for v in e}

    def find(v):
        while root[v] != v:
            v = root[v]
        return v

    for a, b in edges:
        x, y = sorted((find(a), find(b)))
        root[y] = x
    linked = {v for a, b in edges if a != b for v in (a, b)}
    got = collected(connected_components(spark.createDataFrame(edges, "a long, b long")))
    assert got == sorted((v, find(v)) for v in linked)
    assert connected_components(spark.createDataFrame([], "a long, b long")).count() == 0
