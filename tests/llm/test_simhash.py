from __future__ import annotations

import random
import re

import pytest
import xxhash
from pyspark.sql import functions as F

from quire.llm import simhash

from .conftest import collected, ordered


def brute_fingerprint(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", low)
    if not words:
        return 0
    grams = [" ".join(words[k : k + 3]) for k in range(len(words) - 2)] or [" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(prints):
    """Smallest id of each row's component; prints is a list of (id, fingerprint)."""
    distinct = list({f for _, f in prints})
    root = {f: f for f in distinct}

    def find(f):
        while root[f] != f:
            f = root[f]
        return f

    for k, a in enumerate(distinct):
        for b in distinct[:k]:
            if (a ^ b).bit_count() <= 2:
                root[find(a)] = find(b)
    least = {}
    for i, f in prints:
        r = find(f)
        if i is not None:
            least[r] = min(i, least.get(r, i))
    return [(i, f"{f:016x}", least.get(find(f))) for i, f in prints]


def test_equals_brute_force(docs, texts):
    assert collected(simhash.near_duplicates(docs)) == ordered(brute_components([(i, brute_fingerprint(t)) for i, t in texts]))


def test_components_of_crowds(spark):
    """Chains and dense groups of fingerprints, on both ways to their links."""
    rng = random.Random(3)
    prints = [rng.getrandbits(64) for _ in range(200)]
    for base in prints[:20]:
        f = base
        for _ in range(12):
            f ^= 1 << rng.randrange(64)
            f ^= 1 << rng.randrange(64)
            prints.append(f)
    for _ in range(300):
        prints.append(prints[0] ^ (1 << rng.randrange(10)) ^ (1 << rng.randrange(10)) ^ (1 << rng.randrange(10)))
    distinct = sorted(set(prints))
    df = spark.createDataFrame([(simhash._signed(f),) for f in distinct], "fp long")
    links = [(r.a & (2**64 - 1), r.b & (2**64 - 1)) for r in simhash.near_links(df).collect()]
    assert all((a ^ b).bit_count() <= 2 for a, b in links)
    root = {f: f for f in distinct}

    def find(f):
        while root[f] != f:
            f = root[f]
        return f

    for a, b in links:
        root[find(a)] = find(b)
    for k, a in enumerate(distinct):
        assert all(find(a) == find(b) for b in distinct[:k] if (a ^ b).bit_count() <= 2)


def shingles(text):
    words = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", words)
    return {tuple(words[k : k + 5]) for k in range(max(1, len(words) - 4))} if words else set()


def brute_groups(texts):
    """Group of each text: what links of similarity 0.8 reach."""
    sets = [shingles(t) for t in texts]
    group = list(range(len(texts)))
    for a in range(len(texts)):
        for b in range(a):
            every = len(sets[a] | sets[b])
            if group[a] != group[b] and (every == 0 or len(sets[a] & sets[b]) >= 0.8 * every):
                group = [group[b] if g == group[a] else g for g in group]
    return group


def kept_rows(rows):
    """What stays of (id, text) rows: of each group the smallest by id, null last."""
    parts = {}
    for (i, _), g in zip(rows, brute_groups([t for _, t in rows]), strict=True):
        parts.setdefault(g, []).append((i is None, i or 0))
    return sorted(min(p) for p in parts.values())


def test_keeps_one(docs, texts):
    kept = simhash.keep_one_of_each(docs)
    assert kept.schema == docs.schema
    assert sorted((r[0] is None, r[0] or 0) for r in kept.select("doc_id").collect()) == kept_rows(texts)


def test_keeps_one_of_odd_rows(spark):
    """Identical rows, rows without an id, and a near copy that shares its id with a row that stays."""
    long = " ".join(f"word{k}" for k in range(300))
    rows = [(1, "a b c d"), (1, "a b c d"), (None, "only here"), (None, "a b c d"), (2, "other text of its own"), (2, "A b c d"), (None, None), (None, ""), (3, long), (3, long.upper()), (4, long)]
    df = spark.createDataFrame([(*r, 7, "x") for r in rows], "doc_id long, text string, row int, fp string").repartition(3)
    kept = simhash.keep_one_of_each(df)
    assert kept.schema == df.schema
    got = kept.collect()
    assert sorted((r.doc_id is None, r.doc_id or 0) for r in got) == kept_rows(rows) == [(False, 1), (False, 2), (False, 3), (True, 0), (True, 0)]
    assert sorted(r.text or "" for r in got if r.doc_id is None) in (["", "only here"], [" ", "only here"])


@pytest.mark.parametrize("size", [20, 60, 150, 400, 3000])
def test_near_copies(spark, size):
    """Texts with a few words replaced: nearly all that are similar enough are found, no others are linked."""
    rng = random.Random(size)
    words = [f"w{k}" for k in range(5000)]
    texts = []
    for _ in range(40):
        base = [rng.choice(words) for _ in range(size)]
        copy = list(base)
        for at in rng.sample(range(size), max(1, size * rng.choice([1, 1, 2, 3]) // 100)):
            copy[at] = "changed"
        texts += [" ".join(base), " ".join(copy)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    kept = {r.doc_id for r in simhash.keep_one_of_each(df).collect()}
    near = [k for k in range(0, len(texts), 2) if len(shingles(texts[k]) & shingles(texts[k + 1])) >= 0.8 * len(shingles(texts[k]) | shingles(texts[k + 1]))]
    gone = set(range(len(texts))) - kept
    assert gone <= {k + 1 for k in near}
    assert len(gone) >= 0.9 * len(near)


def edited(rng, base, how):
    """A copy with one to three words appended, put before, or replaced anywhere or at an edge."""
    n = rng.choice([1, 1, 2, 3])
    more = [f"new{rng.randrange(1000)}" for _ in range(n)]
    if how == "appended":
        return base + more
    if how == "before":
        return more + base
    copy = list(base)
    for k, w in enumerate(more):
        copy[rng.randrange(len(copy)) if how == "replaced" else -1 - k % len(copy)] = w
    return copy


def kept_of_components(texts):
    """The rows that stay by brute force: the first of each component of pairs with the similarity."""
    sets, root = [shingles(t) for t in texts], list(range(len(texts)))
    for j in range(len(texts)):
        for i in range(j):
            if root[i] != root[j] and len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j]):
                root = [root[i] if r == root[j] else r for r in root]
    least = {}
    for k, r in enumerate(root):
        least.setdefault(r, k)
    return sorted(least.values())


@pytest.mark.parametrize("size", [5, 9, 12, 15, 20, 40, 95])
def test_short_copies_are_all_found(spark, size):
    """However the copy differs, from texts of one shingle on."""
    rng = random.Random(size)
    words = [f"w{k}" for k in range(3000)]
    texts = []
    for how in ("appended", "before", "replaced", "edge") * 12:
        base = [rng.choice(words) for _ in range(size)]
        texts += [" ".join(base), " ".join(edited(rng, base, how))]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    got = sorted(r.doc_id for r in simhash.keep_one_of_each(df).collect())
    want = kept_of_components(texts)
    assert got == want
    assert len(want) < len(texts) or size < 9


@pytest.mark.parametrize("together", [1024, 100])
def test_pages_of_one_template(spark, monkeypatch, together):
    """Pages that share most words fall into the groups of the similarity, neither more nor fewer, while a group's rows are compared together."""
    rng = random.Random(4)
    frame = [f"t{k}" for k in range(48)]
    texts = []
    for _ in range(130):
        own = [f"o{rng.randrange(400)}" for _ in range(12)]
        for _ in range(rng.choice([1, 1, 2, 3, 4])):
            words = own[:]
            words[rng.randrange(12)] = f"o{rng.randrange(400)}"
            texts.append(" ".join(frame[:20] + words + frame[20:]))
    monkeypatch.setattr(simhash, "MOST_TOGETHER", together)
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    got, want = sorted(r.doc_id for r in simhash.keep_one_of_each(df).collect()), kept_of_components(texts)
    if together > len(texts):
        assert got == want
    else:
        assert set(want) <= set(got) and len(got) <= 1.05 * len(want)


@pytest.mark.parametrize("seed", range(2))
def test_groups_beyond_a_block_are_exact(spark, monkeypatch, seed):
    """Pages of one template fall into the groups of brute force, however few rows are compared together."""
    rng = random.Random(seed)
    frame, texts = [f"t{k}" for k in range(48)], []
    for _ in range(120):
        own = [f"o{rng.randrange(400)}" for _ in range(12)]
        for _ in range(rng.choice([1, 1, 2, 3])):
            words = own[:]
            words[rng.randrange(12)] = f"o{rng.randrange(400)}"
            texts.append(" ".join(frame[:20] + words + frame[20:]))
    monkeypatch.setattr(simhash, "MOST_TOGETHER", 16)
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    assert sorted(r.doc_id for r in simhash.keep_one_of_each(df).collect()) == kept_of_components(texts)


def test_crowd_of_near_copies(spark):
    """Hundreds of copies of one text, each with a word of its own replaced, leave one."""
    base = [f"w{k}" for k in range(200)]
    texts = [" ".join(base[:k] + [f"own{k}"] + base[k + 1 :]) for k in range(200)] + [" ".join(base)] * 50
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    assert [r.doc_id for r in simhash.keep_one_of_each(df).collect()] == [0]


def test_clusters(docs, texts):
    got = simhash.with_cluster(docs, "near", keep=["source"]).groupBy("near").agg(F.min("doc_id").alias("least"), F.count("*").alias("n")).collect()
    want = {}
    for r in brute_components([(i, brute_fingerprint(t)) for i, t in texts]):
        want[r[2]] = want.get(r[2], 0) + 1
    assert {r.least: r.n for r in got} == want


def test_empty_table(none):
    assert simhash.near_duplicates(none).count() == 0
    assert simhash.keep_one_of_each(none).count() == 0


def test_pivots_bound_distances(spark):
    """No coordinate differs by more than the bits do, and fingerprints within two bits share the cells of three groups."""
    rng = random.Random(8)
    pairs = []
    for _ in range(400):
        f = other = rng.getrandbits(64)
        for _ in range(rng.choice([0, 1, 2, 3, 9])):
            other ^= 1 << rng.randrange(64)
        pairs.append((simhash._signed(f), simhash._signed(other)))
    side = lambda c: F.struct(F.col(c).alias("fp"), *simhash.pivot_table(F.col(c)))
    cells = lambda c: F.array(*[F.col(f"{c}.p{g}") - F.col(f"{c}.origin") * sum(1 << simhash.FIELD * k for k in range(simhash.PER_GROUP)) for g in range(simhash.GROUPS)])
    df = spark.createDataFrame(pairs, "a long, b long").select(side("a").alias("x"), side("b").alias("y"))
    got = df.select(simhash.apart("x", "y").alias("apart"), F.bit_count(F.col("x.fp").bitwiseXOR(F.col("y.fp"))).alias("bits"), cells("x").alias("u"), cells("y").alias("v")).collect()
    assert all(r.apart <= r.bits for r in got)
    assert all(sum(a == b for a, b in zip(r.u, r.v, strict=True)) >= 3 for r in got if r.bits <= 2)
    assert sum(r.apart > 2 for r in got if r.bits > 2) > 100


def test_pivots_discard(spark):
    """Pairs that meet in three cells but are far apart in the others are discarded before they are verified."""
    rng = random.Random(9)
    base = rng.getrandbits(64)
    prints = {base} | {base ^ (rng.getrandbits(13) | 1) ^ (rng.getrandbits(13) << 13) for _ in range(10)} | {base ^ 3}
    met = simhash.candidate_pairs(simhash.candidates(spark.createDataFrame([(simhash._signed(f),) for f in prints], "fp long"))).collect()
    pairs = {(r.a, r.b): r for r in met}
    assert len(pairs) == len(prints) * (len(prints) - 1) // 2
    assert sum(r.coordinates_apart > 2 for r in pairs.values()) > len(pairs) // 2
    assert all(r.coordinates_apart <= 2 for r in pairs.values() if r.bits_apart <= 2)
