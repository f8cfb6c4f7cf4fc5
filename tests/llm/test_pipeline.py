from __future__ import annotations

import corpus_pipeline as cp
from quire.llm import decontaminate, quality
from quire.llm.queries import QUERIES, table

from .test_simhash import kept_rows
from .test_substring import brute as brute_windows


def test_stages_against_brute_force(spark, data):
    """Each stage on what the one before it kept."""
    docs = table(spark, data, "documents")
    columns = docs.columns
    kept = [docs]
    for _, stage in cp.STAGES[:-1]:
        out = stage(spark, kept[-1], data)
        assert out.columns == columns
        kept.append(cp.stored(out))
    rows = [[(r.doc_id, r.text) for r in d.select("doc_id", "text").collect()] for d in kept]
    model = quality.learn(docs, table(spark, data, "labels"))
    assert {i for i, _ in rows[1]} == {r.doc_id for r in quality.scored(docs, model).collect() if r.per_word >= model.threshold}
    assert sorted((i is None, i or 0) for i, _ in rows[2]) == kept_rows(rows[1])
    want = {i: (n - gone) for i, n, gone, _ in brute_windows(rows[2], 35)}
    assert {i: len(t.encode().split()) for i, t in rows[3]} == want
    bad = {r.doc_id for r in decontaminate.contamination(kept[3], table(spark, data, "benchmark")).where("contaminated").collect()}
    assert {i for i, _ in rows[4]} == {i for i, _ in rows[3]} - bad
    packed = cp.STAGES[-1][1](spark, kept[4], data).collect()
    assert {r.doc_id for r in packed} == {i for i, _ in rows[4]}
    held = {}
    for r in packed:
        held[r.bin] = held.get(r.bin, 0) + r.n_words
    assert max(held.values()) <= 2048


def test_run(spark, data):
    assert cp.run(spark, data).count() > 0


def test_queries_give_rows(spark, data):
    for name in ("op1_toxicity", "op2_html", "op6_packing", "op8_quality"):
        assert QUERIES[name](spark, data).count() > 0


def test_stages_on_odd_rows(spark, data, docs, none, texts):
    """Null ids, nulls and empty texts, repeated rows, a very long text and columns with clashing names, stage after stage."""
    held = docs
    for name, stage in cp.STAGES[:-1]:
        before = held.count()
        out = cp.stored(stage(spark, held, data))
        assert out.columns == docs.columns, name
        assert dict(out.dtypes) == dict(docs.dtypes), name
        assert out.count() <= before
        assert stage(spark, none, data).count() == 0
        held = out
    last = cp.STAGES[-1][1]
    packed = last(spark, held, data).collect()
    assert sorted(str(i) for i in {r.doc_id for r in packed}) == sorted(str(r.doc_id) for r in held.select("doc_id").distinct().collect())
    assert last(spark, none, data).count() == 0


def test_odd_rows_of_each_stage(spark, data, docs, texts):
    """What each stage does with the same odd rows, by itself."""
    size = len(texts)
    stages = dict(cp.STAGES)
    model = quality.learn(docs, table(spark, data, "labels"))
    good = quality.scored(docs, model).where(f"per_word >= {model.threshold!r}").count()
    assert stages["quality classifier"](spark, docs, data).count() == good
    near = stages["simhash near-dedup"](spark, docs, data)
    assert sorted((r.doc_id is None, r.doc_id or 0) for r in near.select("doc_id").collect()) == kept_rows(texts)
    cut = stages["substring dedup"](spark, docs, data)
    assert cut.count() == size
    assert cut.where("n_chars <> length(text) or (n_chars is null and text is not null)").count() == 0
    clean = stages["benchmark decontamination"](spark, docs, data)
    assert clean.count() == size - decontaminate.contamination(docs, table(spark, data, "benchmark")).where("contaminated").count()
    assert stages["best-fit packing"](spark, docs, data).groupBy("doc_id").count().count() == docs.select("doc_id").distinct().count()
