from __future__ import annotations

import random
import re
from collections import defaultdict

from pyspark.sql import functions as F

from quire.llm import packing


def plain_best_fit(sizes, sources, clusters, capacity):
    bins, out = [], []
    for size, s, c in zip(sizes, sources, clusters, strict=True):
        open_ = [(capacity - sum(x[0] for x in b), k) for k, b in enumerate(bins) if sum(x[0] for x in b) + size <= capacity and not any((s is not None and x[1] == s) or x[2] == c for x in b)]
        k = min(open_)[1] if open_ else len(bins)
        if k == len(bins):
            bins.append([])
        out.append((k, sum(x[0] for x in bins[k])))
        bins[k].append((size, s, c))
    return out


def test_best_fit_equals_plain_search():
    rng = random.Random(4)
    for _ in range(20):
        n = rng.randrange(60)
        sizes = sorted((rng.randrange(0, 100) for _ in range(n)), reverse=True)
        sources, clusters = [rng.choice([None, *"abcdef"]) for _ in range(n)], [rng.randrange(8) for _ in range(n)]
        assert packing.best_fit(sizes, sources, clusters, 100) == plain_best_fit(sizes, sources, clusters, 100)


def test_whole_table(docs, texts):
    got = packing.pack(docs, capacity=64, shard=30).collect()
    words, bins = defaultdict(list), defaultdict(list)
    for r in got:
        words[r.doc_id].append(r.n_words)
        bins[r.bin].append(r)
    want = defaultdict(int)
    for i, t in texts:
        want[i] += len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))
    assert {i: sum(n) for i, n in words.items()} == want
    full = {(i, s) for i, _, s in ((r[0], r[1], r[3]) for r in docs.select("doc_id", "text", "lang", "source").collect())}
    hashes_of = defaultdict(set)
    for i, t in texts:
        hashes_of[i].add(t or "")
    for held in bins.values():
        assert sum(r.n_words for r in held) <= 64
        at = 0
        for r in sorted(held, key=lambda r: r.bin_at):
            assert r.bin_at >= at or r.n_words == 0
            at = max(at, r.bin_at + r.n_words)
        hashes = [hashes_of[r.doc_id] for r in held if len(hashes_of[r.doc_id]) == 1]
        assert len(hashes) == len({min(h) for h in hashes})
        if len(held) > 1:
            sources = [s for r in held for i, s in full if i == r.doc_id is not None and s is not None]
            assert len(sources) == len(set(sources))


def test_empty_table(none):
    assert packing.pack(none).count() == 0


def test_ids_come_back(spark):
    """Ids beyond 2**53 beside a null, and ids that are text."""
    ids = [1152921504606846977, None, 1152921504606846979, None, -5]
    df = spark.createDataFrame([(i, "some words here", "s") for i in ids], "doc_id long, text string, source string")
    assert sorted(str(r.doc_id) for r in packing.pack(df).collect()) == sorted(map(str, ids))
    named = df.withColumn("doc_id", F.concat(F.lit("d"), F.col("doc_id").cast("string")))
    assert sorted(str(r.doc_id) for r in packing.pack(named).collect()) == sorted("None" if i is None else f"d{i}" for i in ids)


def test_given_clusters(spark):
    """Near copies share a cluster, so none of them share a bin; a null cluster conflicts with nothing."""
    df = spark.createDataFrame([(k, "word " * (k + 1), None, "c" if k < 4 else None, k) for k in range(8)], "doc_id long, text string, source string, near string, bin int")
    got = packing.pack(df, cluster_col="near").collect()
    assert len({r.bin for r in got if r.doc_id < 4}) == 4
    assert len({r.bin for r in got}) == 4


def test_very_long_text(spark):
    df = spark.createDataFrame([(1, "w " * 300_001, "s"), (2, "x", "s")], "doc_id long, text string, source string")
    got = packing.pack(df, capacity=1000).collect()
    assert sum(r.n_words for r in got if r.doc_id == 1) == 300_001
    assert len({(r.bin, r.bin_at) for r in got}) == len(got) == 302


def test_query(spark, data):
    """Every document of the table has all its words in bins that hold no two members of a source or of a component of near copies."""
    from quire.llm.queries import QUERIES

    rows = spark.read.parquet(f"{data}/documents.parquet").select("doc_id", "text", "source").collect()
    facts = {r.doc_id: (len(re.findall(r"[^\x20\x09-\x0D]+", r.text or "")), r.source) for r in rows}
    near = {r.doc_id: r.component_id for r in QUERIES["op3_simhash"](spark, data).collect()}
    words, bins = defaultdict(int), defaultdict(list)
    for r in QUERIES["op6_packing"](spark, data).collect():
        words[r.doc_id] += r.n_words
        bins[r.bin].append(r)
    assert words == {i: n for i, (n, _) in facts.items()}
    for held in bins.values():
        assert sum(r.n_words for r in held) <= packing.CAPACITY
        sources = [facts[r.doc_id][1] for r in held if facts[r.doc_id][1] is not None]
        assert len(sources) == len(set(sources))
        assert len({near[r.doc_id] for r in held}) == len(held)
