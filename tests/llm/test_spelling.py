from __future__ import annotations

import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from quire.llm import spelling

from .conftest import collected


def near(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(b) - len(a) > 1 or a == b:
        return False
    k = next((k for k in range(len(a)) if a[k] != b[k]), len(a))
    return a[k:] == b[k + 1 :] or (len(a) == len(b) and a[k + 1 :] == b[k + 1 :])


def words_of(rows, damage):
    counts = Counter()
    for i, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            word = "".join(c.lower() if c < "\x80" else c for c in run)
            h = zlib.crc32(f"{'' if i is None else i}:{word}".encode())
            if damage and h % damage == 0:
                word = word[: h % len(word)] + word[h % len(word) + 1 :]
            counts[word] += 1
    return counts


def brute(counts, shortest, least):
    kept = {w: n for w, n in counts.items() if len(w) >= shortest and n >= least}
    out, form = [], {}
    for w, n in kept.items():
        others = sorted((v for v in kept if near(w, v)), key=lambda v: (-kept[v], v))
        form[w] = others[0] if others and kept[others[0]] >= 2 * n else None
        out.append([w, n, form[w], None, len(others), form[w] and kept[form[w]]])
    for row in out:
        row[3] = row[0]
        while form[row[3]]:
            row[3] = form[row[3]]
    return sorted(map(tuple, out))


def found(df, **more):
    return sorted(tuple(r) for r in spelling.variants(df, **more).collect())


def random_rows(seed, count=60, alphabet="abé"):
    rng = random.Random(seed)
    words = ["".join(rng.choice(alphabet) for _ in range(rng.randrange(1, 9))) for _ in range(60)]
    return [(k, " ".join(rng.choice(words) if rng.random() < 0.8 else rng.choice(words).upper() for _ in range(rng.randrange(40)))) for k in range(count)]


@pytest.mark.parametrize("subtree", [20_000, 5, 1])
@pytest.mark.parametrize("seed", range(2))
def test_equals_brute_force(spark, seed, subtree):
    """Whether the trie is cut once or at nearly every word."""
    rows = random_rows(seed)
    df = spark.createDataFrame(rows, "doc_id long, text string")
    for shortest, least in ((5, 3), (1, 1)):
        want = brute(words_of(rows, 7), shortest, least)
        assert found(df, damage=7, shortest=shortest, least=least, subtree=subtree) == want
    assert any(r[2] for r in want) and any(r[3] != r[2] for r in want if r[2])


def test_documents(docs, texts):
    assert found(docs, damage=97) == brute(words_of(texts, 97), 5, 3)
    assert found(docs, damage=None, least=1) == brute(words_of(texts, None), 5, 1)


def test_odd_rows(spark, none):
    assert found(none) == []
    long = "x" * 5_000
    rows = [(1, None), (2, ""), (None, "House house HOUSE"), (3, "hous×e mouse mouse mouse"), (3, "hous×e mouse mouse mouse"), (None, None), (4, f"{long} {long} {long} {long}y {long}y {long}y")]
    df = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 word", "2 n", "3 near", "4 form")
    got = found(df)
    assert got == brute(words_of(rows, None), 5, 3)
    assert [r[0][:5] for r in got] == ["house", "mouse", "xxxxx", "xxxxx"]


def test_trie_finds_each_pair_once():
    rng = random.Random(9)
    for _ in range(150):
        words = sorted({"".join(rng.choice("abc") for _ in range(rng.randrange(1, 7))) for _ in range(rng.randrange(1, 60))})
        pairs = [tuple(sorted(p)) for a, b in spelling.Trie(words, np.zeros(len(words), dtype=np.int64)).near() for p in zip(a.tolist(), b.tolist(), strict=True)]
        want = [(i, j) for i in range(len(words)) for j in range(i + 1, len(words)) if near(words[i], words[j])]
        assert sorted(pairs) == want


def test_chains_end_at_their_root(spark):
    forms = spark.createDataFrame([(f"w{k}", f"w{k + 1}" if k < 20 else None) for k in range(21)], "word string, form string")
    assert {r.root for r in spelling.with_roots(forms).collect()} == {"w20"}


def test_empty_vocabulary(spark):
    assert collected(spelling.near_words(spark.createDataFrame([], "word string, n long"))) == []
