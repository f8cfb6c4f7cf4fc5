from __future__ import annotations

import hashlib
import random
import re
from collections import Counter

import pytest

from quire.llm import substring

from .conftest import collected, ordered


def brute(rows, window):
    split = [re.findall(r"[^\x20\x09-\x0D]+", t or "") for _, t in rows]
    seen = Counter(tuple(w[k : k + window]) for w in split for k in range(len(w) - window + 1))
    out = []
    for (i, _), w in zip(rows, split, strict=True):
        gone = [False] * len(w)
        for k in range(len(w) - window + 1):
            if seen[tuple(w[k : k + window])] > 1:
                gone[k : k + window] = [True] * window
        kept = " ".join(x for x, g in zip(w, gone, strict=True) if not g)
        out.append((i, len(w), sum(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return out


@pytest.mark.parametrize("window", [35, 1, 2, 7, 13, 50])
def test_equals_brute_force(docs, texts, window):
    assert collected(substring.removed_words(docs, window=window)) == ordered(brute(texts, window))


@pytest.mark.parametrize("seed", range(3))
def test_short_alphabets(spark, seed):
    """Texts of two words repeat nearly everywhere."""
    rng = random.Random(seed)
    rows = [(k, " ".join(rng.choice("ab") for _ in range(rng.randrange(60)))) for k in range(30)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert collected(substring.removed_words(df, window=9)) == ordered(brute(rows, 9))


def test_cut_texts(docs, texts):
    cut = substring.without_repeats(docs)
    assert cut.schema == docs.schema
    kept = Counter((r.doc_id, hashlib.sha256(" ".join((r.text or "").split()).encode()).hexdigest()) for r in cut.collect() if r.doc_id not in (None,) and "\x1c" not in (r.text or "") and " " not in (r.text or ""))
    want = Counter((i, h) for (i, t), (_, _, _, h) in zip(texts, brute(texts, 35), strict=True) if i is not None and "\x1c" not in (t or "") and " " not in (t or ""))
    assert kept == want


def test_empty_table(none):
    assert substring.removed_words(none).count() == 0
    assert substring.without_repeats(none).count() == 0


def test_second_hash_differs():
    """Windows that share the first hash only are not taken for equal."""
    import numpy as np

    from quire.llm import common

    code = np.arange(100, dtype=np.uint64)
    assert not set(common.grams(code, 35).tolist()) & set(common.grams(code, 35, common.SECOND_FACTOR).tolist())


def test_repeated_and_nameless_rows(spark):
    """Repeated rows and rows without an id lose what they share; a very long text is searched as a whole."""
    words = [f"w{k}" for k in range(60)]
    rows = [(1, " ".join(words)), (1, " ".join(words)), (None, " ".join(words[:40])), (None, "short"), (2, None), (3, ""), (4, " ".join(f"u{k}" for k in range(50_000)) + " " + " ".join(words[5:45]))]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert collected(substring.removed_words(df)) == ordered(brute(rows, 35))
