from __future__ import annotations

import hashlib
import random

import numpy as np
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st

from quire.llm import pieces
from quire.llm.queries import vocabulary

from .conftest import collected, ordered

MODEL = vocabulary("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=MODEL)


@pytest.fixture(scope="module")
def own():
    with open(MODEL, "rb") as f:
        return pieces.PieceEncoder(f.read())


def ids(own, text):
    return np.frombuffer(own.encode(text), dtype="<i4").tolist()


def brute(rows, library):
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    full = [(i, [*library.encode(t or ""), library.eos_id()]) for i, t in rows]
    return [(i, len(x), sha(" ".join(map(str, x))), sha(library.decode(x))) for i, x in full]


def test_equals_the_library_on_rows(docs, texts, library):
    got = collected(pieces.piece_digests(pieces.piece_ids(docs, MODEL, decode=True)))
    assert got == ordered(brute(texts, library))


def test_decoding_by_itself(docs, texts, library):
    got = pieces.piece_texts(pieces.piece_ids(docs, MODEL).withColumnRenamed("doc_id", "key"), MODEL).select("key", "decoded")
    assert collected(got) == ordered([(i, library.decode(library.encode(t or ""))) for i, t in texts])


def test_odd_rows(spark, none):
    assert pieces.piece_ids(none, MODEL, decode=True).count() == 0
    df = spark.createDataFrame([(1, None), (1, None)], "doc_id long, text string").selectExpr("*", "'x' ids", "'y' decoded")
    assert collected(pieces.piece_ids(df, MODEL, decode=True)) == [(1, [2], "")] * 2
    assert collected(pieces.piece_ids(df, MODEL, end=False)) == [(1, [])] * 2
    lists = spark.createDataFrame([(1, None), (2, []), (3, [1, 3, 260])], "k long, ids array<int>")
    assert [r[2] for r in sorted(pieces.piece_texts(lists, MODEL).collect())][:2] == [None, ""]


@pytest.mark.parametrize("kind", ["ab", "aeiou nrst", " ▁a", "0123 \n", "pieces", "letters", "signs"])
def test_random_texts(own, library, kind):
    rng = random.Random(kind)
    names = [library.id_to_piece(i) for i in range(259, library.get_piece_size())]
    pool = names if kind == "pieces" else list("".join(names[-4000:])) if kind == "letters" else list("()[]{};:.,-'\"▁ \r\n#*/") + ["①", "\U0001f600", "　"] if kind == "signs" else list(kind)
    for _ in range(3000):
        text = "".join(rng.choice(pool) for _ in range(rng.randrange(30))).replace("▁", rng.choice(" ▁"))
        want = library.encode(text)
        assert ids(own, text) == want and own.decode(want) == library.decode(want), text


@settings(max_examples=300, deadline=None)
@given(st.text(max_size=60))
def test_any_text(own, library, text):
    assert ids(own, text) == library.encode(text)
    assert own.decode(ids(own, text)) == library.decode(library.encode(text))


def test_any_ids(own, library):
    rng = random.Random(4)
    for _ in range(4000):
        some = [rng.randrange(32_000) if rng.random() < 0.6 else rng.randrange(260) for _ in range(rng.randrange(7))]
        assert own.decode(some) == library.decode(some), some


def test_full_memory_changes_nothing(own, library, monkeypatch):
    for name in ("KEPT", "KEPT_PAIRS"):
        monkeypatch.setattr(pieces, name, 5)
    for text in ("some words that come again, some words that do not", "unbelievable " * 3, "été  naïve\n\n12"):
        assert ids(own, text) == library.encode(text)


def test_long_stretch(own, library):
    """One word of many characters takes one pass."""
    text = "abcab" * 40_000
    assert len(ids(own, text)) > 10_000
    assert ids(own, text[:5_000]) == library.encode(text[:5_000])


def test_each_prefix_has_its_last_piece(own, library):
    word = "▁unbelievableness"
    table = [own.names[k] for k in own._table(word)]
    for k in range(1, len(word)):
        assert library.id_to_piece(library.encode(word[1 : k + 1])[-1]) == table[k]
