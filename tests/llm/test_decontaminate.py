from __future__ import annotations

import random
import re

import pytest

from quire.llm import decontaminate as dc

from ..conftest import canonical
from .conftest import collected, ordered


def tokens(text):
    return [w for w in re.split(r"[\W_]+", (text or "").lower()) if w]


def brute(rows, items):
    by_words = {}
    for i, t in items:
        w = tuple(tokens(t))
        if w:
            by_words[w] = min(i, by_words.get(w, i))
    out = []
    for d, t in rows:
        own, found = tokens(t), {}
        for w, i in by_words.items():
            n = min(dc.WINDOW, len(w))
            least = dc.WINDOW - dc.ERRORS if len(w) >= dc.WINDOW else len(w) - len(w) // dc.PER_ERROR
            best = max((sum(a == b for a, b in zip(w[k : k + n], own[at : at + n], strict=True)) for k in range(len(w) - n + 1) for at in range(len(own) - n + 1)), default=0)
            if best >= least:
                found[i] = max(best, found.get(i, 0))
        out.append((d, bool(found), len(found), min(found) if found else None, max(found.values()) if found else None))
    return out


@pytest.fixture(scope="module")
def case(spark):
    rng = random.Random(2)
    words = [f"w{k}" for k in range(40)]
    text = lambda n: " ".join(rng.choice(words) for _ in range(n))
    items = [(k, text(n)) for k, n in enumerate([3, 5, 6, 7, 8, 11, 12, 12, 13, 13, 14, 30])] + [(20, None), (21, ""), (22, "a a a a a a a a a a a a a a")]
    items.append((30, items[3][1].upper() + "!"))
    rows = [(k, text(rng.randrange(0, 60))) for k in range(15)] + [(50, None), (51, ""), (52, "a " * 40)]
    for k, (_, t) in enumerate(items[:12]):
        w = t.split()
        for errors in range(4):
            changed = list(w)
            for at in rng.sample(range(len(w)), min(errors, len(w))):
                changed[at] = "zz"
            rows.append((100 + 10 * k + errors, f"{text(6)} {'; '.join(changed)} {text(3)}"))
        rows.append((100 + 10 * k + 7, " ".join(w[:-1])))
        rows.append((100 + 10 * k + 8, " ".join(w[2:])))
    return rows, items, spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")


def test_equals_brute_force(case):
    rows, items, docs, tests = case
    assert collected(dc.contamination(docs, tests)) == ordered(brute(rows, items))


def test_removes_leaks(case):
    rows, items, docs, tests = case
    assert sorted(r.doc_id for r in dc.without_leaks(docs, tests).collect()) == sorted(d for d, bad, *_ in brute(rows, items) if not bad)


def test_odd_rows(docs, none, texts, case):
    _, items, _, tests = case
    assert collected(dc.contamination(docs, tests)) == ordered(brute(texts, items))
    left = dc.without_leaks(docs, tests)
    assert left.columns == docs.columns
    assert left.count() == sum(not bad for _, bad, *_ in brute(texts, items))
    assert dc.contamination(none, tests).count() == 0
    assert dc.contamination(docs, tests.limit(0)).where("contaminated").count() == 0


@pytest.mark.parametrize("n", range(1, 13))
def test_short_items(spark, n):
    """Every way to replace tokens of a short item, as far as its errors go and beyond."""
    words = [f"t{k}" for k in range(n)]
    rows = [(100 * a + b, " ".join("zz" if k in (a, b) else w for k, w in enumerate(words)) + " end") for a in range(n) for b in range(a, n)] + [(5000, "x " + " ".join(words))]
    items = [(1, " ".join(words)), (2, "a b c d e f g h i j k l m n o p")]
    got = dc.contamination(spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string"))
    assert collected(got) == ordered(brute(rows, items))


def test_equals_sql_on_short_items(case, spark, tmp_path):
    import duckdb

    _, _, docs, tests = case
    got = dc.contamination(docs, tests)
    con = duckdb.connect()
    for name, df in (("documents", docs), ("benchmark", tests)):
        con.register(name, df.toArrow())
    cursor = con.execute(dc.ORACLE)
    assert canonical(got.columns, [tuple(r) for r in got.collect()]) == canonical([c[0] for c in cursor.description], cursor.fetchall())


def test_equals_sql(spark, data, duck):
    from quire.llm.queries import ORACLE_SQL, QUERIES

    got = QUERIES["op9_decontamination"](spark, data)
    cursor = duck.execute(ORACLE_SQL["op9_decontamination"])
    assert canonical(got.columns, [tuple(r) for r in got.collect()]) == canonical([c[0] for c in cursor.description], cursor.fetchall())
