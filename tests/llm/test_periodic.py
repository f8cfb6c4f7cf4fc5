from __future__ import annotations

import hashlib
import random
import re
import zlib
from fractions import Fraction

import numpy as np
import pytest

from quire.llm import periodic

from .conftest import collected, ordered


def runs_of(w, least=24, times=3):
    """Every stretch and every period, the plain way."""
    best = {}
    for p in range(1, len(w) // times + 1):
        s = 0
        while s + p < len(w):
            e = s
            while e + p < len(w) and w[e] == w[e + p]:
                e += 1
            if e > s and e + p - s >= max(least, times * p):
                best[s, e + p] = min(p, best.get((s, e + p), p))
            s = e + 1
    return sorted((s, e - s, p) for (s, e), p in best.items())


def brute(rows, least=24, times=3, plant=True):
    out = []
    for i, text in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", text or "")
        h = zlib.crc32(str(i).encode()) if i is not None else 1
        if plant and h % 10 == 0 and w:
            g, n = h // 10, len(w)
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            w = [w[k] if k < a else w[a + (k - a) % p] for k in range(n)]
        runs = runs_of(w, least, times)
        gone = {k for s, n, p in runs for k in range(s + p, s + n)}
        kept = " ".join(x for k, x in enumerate(w) if k not in gone)
        top = min(runs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]), default=None)
        lines = "".join(f"{s},{n},{p}\n" for s, n, p in runs)
        out.append((i, len(runs), *(top or (None,) * 3), top and 1000 * top[1] // top[2], hashlib.sha256(lines.encode()).hexdigest(), hashlib.sha256(kept.encode()).hexdigest()))
    return out


def found(df, **more):
    return collected(periodic.run_digests(periodic.collapsed_runs(df, **more)))


def test_equals_brute_force(docs, texts):
    short = [(i, t) for i, t in texts if len(t or "") < 20_000]
    got = found(docs.where("coalesce(length(text), 0) < 20000"), order=periodic.planted)
    assert got == ordered(brute(short))
    assert any(r[1] for r in got)


@pytest.mark.parametrize("least,times", [(24, 3), (1, 3), (6, 3), (10, 4)])
def test_small_alphabets(spark, least, times):
    rng = random.Random(least)
    rows = []
    for k in range(150):
        w = [rng.choice("abc"[: rng.choice([1, 2, 3])]) for _ in range(rng.randrange(90))]
        if k % 3 == 0 and w:
            w = (w[: rng.randrange(1, 12)] * 20)[: rng.randrange(1, 120)] + w
        if k % 5 == 0:
            w = w + w + w + w
        rows.append((k, " ".join(w)))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert found(df, least=least, times=times) == ordered(brute(rows, least, times, plant=False))


def test_odd_rows(spark, none):
    rows = [(1, None), (2, ""), (3, " \n\t "), (None, "x " * 40), (None, None), (4, "x " * 40), (4, "x " * 40), (5, "é\x1cx " * 30 + "tail"), (10, "one"), (7, "w")]
    df = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 runs", "'a' collapsed", "2 n_words")
    assert found(df, order=periodic.planted) == ordered(brute(rows))
    assert found(none) == []


def test_every_id_is_planted_alike(spark):
    rows = [(k, " ".join(f"w{j % (k + 7)}x{j}" for j in range(k * 3 % 200))) for k in range(400)]
    got = found(spark.createDataFrame(rows, "doc_id long, text string"), order=periodic.planted)
    assert got == ordered(brute(rows)) and sum(r[1] for r in got) > 15


def test_collisions_of_the_hash_change_nothing(monkeypatch):
    """With a hash that sees two kinds of words only, the words decide."""
    monkeypatch.setattr(periodic, "mixed", lambda x: x & np.uint64(1))
    rng = np.random.default_rng(3)
    for _ in range(60):
        w = rng.integers(0, 4, size=int(rng.integers(24, 120)))
        if rng.random() < 0.6:
            w = np.concatenate([w, np.tile(w[:5], 9), w])
        code = np.append(w, -1)
        runs = periodic.find_runs(code, np.array([0]), np.array([len(w)]), 6, 3)
        assert [tuple(r) for r in runs.tolist()] == runs_of(w.tolist(), 6, 3)


def test_long_text_takes_time_in_proportion():
    w = np.arange(300_000) % 100_000
    runs = periodic.find_runs(np.append(w, -1), np.array([0]), np.array([len(w)]))
    assert runs.tolist() == [[0, 300_000, 100_000]]
    assert periodic.find_runs(np.append(np.zeros(200_000, dtype=np.int64), -1), np.array([0]), np.array([200_000])).tolist() == [[0, 200_000, 1]]


def test_two_periods_are_refused(docs):
    with pytest.raises(ValueError):
        periodic.collapsed_runs(docs, times=2)
