"""Small documents with what operators must stand: nulls, empty and long texts, copies, ties, clashing columns."""

from __future__ import annotations

import random

import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, rid long, id string, hash string, runs int, leak long, key int, edits int, c_0 string"


def prose(rng: random.Random, n: int) -> str:
    words = ["alpha", "beta", "gamma", "delta", "omega", "sigma", "kappa", "theta", "été", "naïve", "straße", "x1", "42", "it's"]
    return "".join(rng.choice(words) + str(rng.randrange(30)) * (rng.random() < 0.5) + rng.choice([" ", " ", " ", ", ", "\n", " \t", "\x0b"]) for _ in range(n))


def rows() -> list[tuple]:
    rng = random.Random(5)
    texts: list[str | None] = [prose(rng, rng.choice([1, 2, 3, 20, 60, 120])) for _ in range(40)]
    passage = " ".join(prose(rng, 60).split())
    texts += [None, "", " \n ", None, "word", "Word", texts[3], texts[3], texts[7].upper(), passage, f"Start {passage} end", f"{texts[4]} {passage}\nother {passage}", prose(rng, 5000), "a " * 300, "ﬁn\x1cÉ   wide"]
    texts += [texts[20] + " tail", texts[21].replace("alpha", "alfa", 1)]
    out = [(k * 7 % 97, t, "en", None if k % 11 == 0 else "hot" if k % 3 else f"s{k % 5}", None) for k, t in enumerate(texts)]
    out += [out[5], (None, "no id here", "en", "hot", None), (None, None, None, None, None)]
    return out


@pytest.fixture(scope="session")
def docs(spark):
    full = [(*r, 1, "x", "y", 2, 3, 4, 5, "z") for r in rows()]
    return spark.createDataFrame(full, SCHEMA).repartition(3)


@pytest.fixture(scope="session")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def texts():
    return [(r[0], r[1]) for r in rows()]


def collected(df):
    """Rows as sorted tuples; nulls come first."""
    return sorted((tuple(r) for r in df.collect()), key=lambda r: [(v is not None, v) for v in r])


def ordered(found):
    return sorted(found, key=lambda r: [(v is not None, v) for v in r])
