"""SimHash near-duplicates with pivot distance tables.

Fingerprints come from word shingles.  Equal fingerprints are merged first, so that groups of
exact copies of any size are one row from there on.  Each distinct fingerprint then gets a row
of the pivot table: its Hamming distances to ``GROUPS * PER_GROUP + 1`` fixed reference fingerprints.

One reference is the origin.  The others form five groups; those of a group differ from the origin only
within the group's own block of bits.  A distance less that to the origin therefore depends on that
block alone, and a group's differences together name a *cell*.  Two fingerprints at most two bits
apart differ in two blocks at most, so they share the cells of three groups: candidates are the
fingerprints that meet on one of the ten choices of three cells.  A pair of candidates is discarded
if any coordinate of the table differs by more than two (by the triangle inequality no true pair is),
and the survivors are verified by their own Hamming distance.

A dense group of near copies would put many fingerprints into one cell.  Cells with more
than ``CROWD`` fingerprints therefore form no pairs; their fingerprints are linked exactly in
another way: two fingerprints are within two bits if and only if some 64-bit point is
within one bit of both, and no point is within one bit of more than 65 fingerprints.  Joining
each fingerprint to the smallest one at each of its 65 points gives the same components.

``keep_one_of_each`` removes near copies of five-word shingles and a similarity of 0.8 from a corpus.  Their
fingerprints may differ by a dozen bits and more, for which no join of whole fingerprints is selective; candidates
there share the SimHash of a *lane*, a fixed small part of their shingles that most edits leave alone.

Texts of up to ``SHORT`` shingles have too few of them for lanes.  They are joined exactly: in an order that puts rare shingles
first, two texts that share 0.8 of their shingles have one in common among the first fifth of each, so only
these meet.  The rows of such a shingle are compared with each other by all their shingles, and rows that always meet together once;
more rows than one task should hold are compared block by block.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from itertools import accumulate, combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quire.llm.common import byte_texts, connected_components, mixed, stored

GROUPS, PER_GROUP = 5, 9
CROWD = 16
LIMIT = 2
SHINGLE = 3
SEED = 42
#: Near copies, as they are removed from a corpus: words of a shingle, share of the shingles of two texts that both have.
WIDE_SHINGLE, SIMILARITY = 5, 0.8
#: Bits that fingerprints of near copies may differ in: beyond, a pair isn't looked at (3.5 standard deviations at that similarity).
WIDE_LIMIT = 20
#: Shingles of a lane, lanes of a scale, and the fewest shingles of a lane that counts.
LANE, MOST_LANES, LEAST_IN_LANE = 6, 32, 3
#: Shingles of a text, at most, whose near copies are found by rare shingles; rows of a group that are compared with each other.
SHORT, MOST_TOGETHER = 100, 1024
#: (first bit, bits) of the block of each group.
BLOCKS = [(0, 13), (13, 13), (26, 13), (39, 13), (52, 12)]
#: Bits that a distance takes in a packed row of the table.
FIELD = 7


def fingerprint(text: bytes, shingle: int = SHINGLE, seed: int = SEED) -> int:
    """Signed 64-bit SimHash of a UTF-8 text; 0 if it has no words."""
    words = text.lower().split()  # bytes: only A-Z change, only ASCII white space splits
    if not words:
        return 0
    line = b" ".join(words)
    if len(words) <= shingle:
        digests = xxhash.xxh64_digest(line, seed)
    else:
        ends = [e - 1 for e in accumulate(len(w) + 1 for w in words)]
        starts = [0, *(e + 1 for e in ends[:-1])]
        digest = xxhash.xxh64_digest
        digests = b"".join([digest(line[a:b], seed) for a, b in zip(starts, ends[shingle - 1 :], strict=False)])
    bits = np.unpackbits(np.frombuffer(digests, dtype=np.uint8)).reshape(-1, 64)
    ones = bits.sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > len(bits)).tobytes(), "big", signed=True)


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE, keep: list[str] | None = None) -> DataFrame:
    """``(id, fp, *keep)`` for each row; a null text counts as empty."""
    keep = keep or []

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            prints = [fingerprint(t, shingle) for t in byte_texts(batch.column(1))]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(prints, pa.int64()), *batch.columns[2:]], names=["id", "fp", *keep])

    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), *keep)
    return rows.mapInArrow(work, T.StructType([T.StructField("id", rows.schema["id"].dataType), T.StructField("fp", T.LongType()), *(rows.schema[k] for k in keep)]))


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def _references() -> tuple[int, list[list[int]]]:
    """The origin, and each group's references; fixed by a hash, so every table has the same."""
    draw = lambda name: xxhash.xxh64_intdigest(name.encode(), SEED)
    origin = draw("origin")
    return origin, [[origin ^ (draw(f"reference {g} {k}") % ((1 << n) - 1) + 1) << at for k in range(PER_GROUP)] for g, (at, n) in enumerate(BLOCKS)]


def pivot_table(fp: Column) -> list[Column]:
    """Hamming distances of ``fp`` to the references: ``p0`` ... a group each, packed in a long, and ``origin``."""
    origin, groups = _references()
    away = lambda r: F.bit_count(fp.bitwiseXOR(F.lit(_signed(r)))).cast("long")
    packed = lambda refs: reduce(lambda x, y: x.bitwiseOR(y), [F.shiftleft(away(r), FIELD * k) for k, r in enumerate(refs)])
    return [*(packed(refs).alias(f"p{g}") for g, refs in enumerate(groups)), away(origin).alias("origin")]


def _cell(g: int) -> Column:
    """A group's cell: its distances less that to the origin, each of them in its own field."""
    return F.col(f"p{g}") - F.col("origin") * sum(1 << FIELD * k for k in range(PER_GROUP))


def apart(a: str, b: str) -> Column:
    """Largest difference of two rows' pivot coordinates."""
    one = lambda side, g, k: F.shiftrightunsigned(F.col(f"{side}.p{g}"), FIELD * k).bitwiseAND(F.lit((1 << FIELD) - 1))
    return F.greatest(F.abs(F.col(f"{a}.origin") - F.col(f"{b}.origin")), *[F.abs(one(a, g, k) - one(b, g, k)) for g in range(GROUPS) for k in range(PER_GROUP)])


def candidates(prints: DataFrame) -> DataFrame:
    """``(key, n, fp, p0, ..., origin)``: rows of the pivot table under each choice of three cells that they share with another."""
    table = prints.select("fp", *pivot_table(F.col("fp")))
    keys = F.array(*[F.xxhash64(F.lit(k), *[_cell(g) for g in chosen]) for k, chosen in enumerate(combinations(range(GROUPS), 3))])
    keyed = table.select("fp", F.explode(keys).alias("key"))
    met = keyed.groupBy("key").agg(F.count("*").alias("n")).where("n > 1")
    return keyed.join(met, "key").select("key", "n", "fp", *pivot_table(F.col("fp")))


def candidate_pairs(rows: DataFrame) -> DataFrame:
    """Pairs of ``candidates`` that meet, with ``coordinates_apart`` (their largest difference in the table) and ``bits_apart``."""
    met = rows.alias("x").join(rows.alias("y"), F.col("x.key") == F.col("y.key")).where(F.col("x.fp") < F.col("y.fp"))
    return met.select(F.col("x.fp").alias("a"), F.col("y.fp").alias("b"), apart("x", "y").alias("coordinates_apart"), F.bit_count(F.col("x.fp").bitwiseXOR(F.col("y.fp"))).alias("bits_apart"))


def near_links(prints: DataFrame) -> DataFrame:
    """Links ``(a, b)`` between the distinct fingerprints ``prints (fp)`` whose components are those of "at most two bits apart"."""
    rows = stored(candidates(prints))
    pairs = candidate_pairs(rows.where(f"n <= {CROWD}")).where(F.col("coordinates_apart") <= LIMIT).where(F.col("bits_apart") <= LIMIT).select("a", "b")
    crowd = rows.where(f"n > {CROWD}").select("fp").distinct()
    points = F.array_append(F.transform(F.sequence(F.lit(0), F.lit(63)), lambda i: F.col("fp").bitwiseXOR(F.call_function("shiftleft", F.lit(1).cast("long"), i))), F.col("fp"))
    shared = crowd.select("fp", F.explode(points).alias("point")).groupBy("point").agg(F.collect_set("fp").alias("fps")).where("size(fps) > 1")
    stars = shared.select(F.array_min("fps").alias("a"), F.explode("fps").alias("b")).where("a <> b")
    return pairs.union(stars).distinct()


def components(prints: DataFrame) -> DataFrame:
    """``(node, root)`` for each distinct fingerprint of ``prints (fp)``: a fingerprint that stands for its component."""
    nodes = prints.select("fp").distinct()
    roots = connected_components(near_links(nodes))
    return nodes.join(roots, nodes.fp == roots.vertex, "left").select(F.col("fp").alias("node"), F.coalesce("root", "fp").alias("root"))


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: ``(id_col, fingerprint, component_id)``.

    ``fingerprint`` is 16 lower-case hex digits; ``component_id`` the smallest id that links of
    at most two differing bits reach, itself included.  Null and empty texts have fingerprint zero
    and link like any other; repeated rows give repeated results; rows with a null id get the
    component of their fingerprint, null only if no row of it has an id.  An empty table gives
    an empty result.
    """
    prints = stored(fingerprints(docs, id_col, text_col))
    nodes = prints.groupBy("fp").agg(F.min("id").alias("least"))
    placed = nodes.join(components(nodes), F.col("fp") == F.col("node")).select("node", "least", "root")
    parts = placed.groupBy("root").agg(F.min("least").alias("component_id"))
    known = stored(placed.join(parts, "root").select("node", "component_id"))
    return prints.join(known, prints.fp == known.node).select(
        F.col("id").alias(id_col),
        F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"),
        "component_id",
    )


def with_cluster(docs: DataFrame, name: str, id_col: str = "doc_id", text_col: str = "text", keep: list[str] | None = None) -> DataFrame:
    """``(id, *keep, name)`` of each row; ``name`` is the same for all rows of a component.

    Null and empty texts have fingerprint zero and are one component with what is within two bits of it; repeated rows and rows
    with a null id are rows like any other; a very long text has one fingerprint; an empty table gives an empty result.
    """
    prints = stored(fingerprints(docs, id_col, text_col, keep=keep))
    found = components(prints)
    return prints.join(found, prints.fp == found.node).select(F.col("id").alias(id_col), *(keep or []), F.col("root").alias(name))


def shingle_hashes(text: bytes, shingle: int, seed: int = SEED) -> np.ndarray:
    """Distinct hashes of a text's shingles, in order; a text with fewer words has one shingle, one without words none."""
    words = text.lower().split()
    if not words:
        return np.zeros(0, dtype=np.uint64)
    n = min(shingle, len(words))
    digest = xxhash.xxh64_intdigest
    return np.unique(np.fromiter((digest(b" ".join(words[k : k + n]), seed) for k in range(len(words) - n + 1)), dtype=np.uint64))


def _simhashes(hashes: np.ndarray, first: np.ndarray) -> np.ndarray:
    """SimHash of each run of ``hashes``; ``first`` has where the runs begin."""
    bits = np.unpackbits(hashes.astype(">u8").view(np.uint8)).reshape(-1, 64)
    ones = np.add.reduceat(bits, first, axis=0, dtype=np.int64)
    size = np.diff(np.append(first, len(hashes)))
    return np.packbits(2 * ones > size[:, None], axis=1).view(">u8")[:, 0].astype(np.uint64)


def lanes(hashes: np.ndarray) -> np.ndarray:
    """Keys of a text's lanes: SimHashes of fixed parts of its shingles.  Short texts have none, but those without words share one.

    A lane holds the shingles whose hash has a certain remainder; there are so many remainders that a lane has about
    ``LANE`` shingles, or half as many on the next scale, and at most ``MOST_LANES`` of them are used on each.  An edit changes
    the lanes of the few shingles that it touches and leaves the others as they are.  Texts whose numbers of shingles
    are no more apart than four to five share a scale.
    """
    if not len(hashes):
        return np.zeros(1, dtype=np.int64)
    if len(hashes) <= SHORT:
        return np.zeros(0, dtype=np.int64)
    scale, out = max(0, int(np.log2(max(1, len(hashes) / LANE)))), []
    mix = mixed(hashes)
    for at in (scale, scale + 1):
        own = mix & np.uint64((1 << at) - 1)
        used = np.flatnonzero(own < MOST_LANES)
        used = used[np.argsort(own[used], kind="stable")]
        if not len(used):
            continue
        lane = own[used]
        first = np.flatnonzero(np.concatenate([[True], lane[1:] != lane[:-1]]))
        size = np.diff(np.append(first, len(lane)))
        keys = mixed(_simhashes(hashes[used], first) + mixed(lane[first] * np.uint64(64) + np.uint64(at + 1)))
        out.append(keys[(size >= LEAST_IN_LANE) | (at == 0)])
    return np.unique(np.concatenate(out)).view(np.int64) if out else np.zeros(0, dtype=np.int64)


def _sketched(rows: DataFrame, text: str, keep: list[str]) -> DataFrame:
    """``(*keep, fp, lanes, short)`` of each row: the SimHash of all its shingles, its lanes, and the shingles themselves if a short text may be its copy."""
    most = int(SHORT / SIMILARITY)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [shingle_hashes(t, WIDE_SHINGLE) for t in byte_texts(batch.column(0))]
            prints = [int(_simhashes(h, np.zeros(1, dtype=np.int64)).view(np.int64)[0]) if len(h) else 0 for h in found]
            yield pa.RecordBatch.from_arrays([*batch.columns[1:], pa.array(prints, pa.int64()), pa.array([lanes(h) for h in found], pa.list_(pa.int64())), pa.array([h.view(np.int64) if 0 < len(h) <= most else None for h in found], pa.list_(pa.int64()))], names=[*keep, "fp", "lanes", "short"])

    read = rows.select(F.col(text).alias("__text"), *keep)
    return read.mapInArrow(work, T.StructType([*(read.schema[k] for k in keep), T.StructField("fp", T.LongType()), T.StructField("lanes", T.ArrayType(T.LongType())), T.StructField("short", T.ArrayType(T.LongType()))]))


def _shingled(rows: DataFrame, text: str) -> DataFrame:
    """``(row, shingles)``: the distinct shingles of each row."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [shingle_hashes(t, WIDE_SHINGLE).view(np.int64) for t in byte_texts(batch.column(1))]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.list_(pa.int64()))], names=["row", "shingles"])

    return rows.select("row", F.col(text)).mapInArrow(work, "row long, shingles array<long>")


def _rare(nodes: DataFrame) -> DataFrame:
    """``(row, key)``: the shingles of each short text by which it must meet its near copies.

    Shingles that no other row has come first of all, and need not be looked up.
    """
    rows = nodes.where("short is not null").select("row", F.size("short").alias("n"), F.explode("short").alias("key"))
    often = rows.groupBy("key").agg(F.count("*").alias("uses")).where("uses > 1")
    shared = rows.join(often, "key").groupBy("row", "n").agg(F.sort_array(F.collect_list(F.struct("uses", "key"))).alias("shared"))
    # n less what must be shared, plus one; of these, n less the shared ones are the row's own
    count = F.size("shared") + 1 - F.ceil(F.lit(SIMILARITY) * F.col("n") - 1e-9).cast("int")
    return shared.select("row", F.explode(F.slice("shared", F.lit(1), F.greatest(count, F.lit(0)))).alias("s")).select("row", "s.key")


def _linked(rows: np.ndarray, shingles: list[np.ndarray]) -> Iterator[tuple[int, int]]:
    """Links that join what is similar among some rows, one less than there are rows at most."""
    flat = np.concatenate(shingles)
    owner = np.repeat(np.arange(len(rows)), [len(s) for s in shingles])
    kinds, code = np.unique(flat, return_inverse=True)
    turn = np.argsort(code, kind="stable")
    first = np.searchsorted(code[turn], np.arange(len(kinds) + 1))
    holders, size = owner[turn], np.array([len(s) for s in shingles])
    root = np.arange(len(rows))
    at = 0
    for k in range(len(rows)):
        own = code[at : at + size[k]]
        at += size[k]
        count = first[own + 1] - first[own]
        places = np.repeat(first[own] - np.cumsum(count) + count, count) + np.arange(count.sum())
        shared = np.bincount(holders[places], minlength=len(rows))[:k]
        for j in np.flatnonzero(shared >= SIMILARITY * (size[k] + size[:k] - shared) - 1e-9).tolist():
            if root[j] != root[k]:
                yield int(rows[j]), int(rows[k])
                root[root == root[k]] = root[j]


def _compared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links within the groups of sorted rows ``(gid, row, short)``."""
    gid, rows, shingles = None, [], []

    def out() -> pa.RecordBatch:
        links = list(_linked(np.array(rows), shingles))
        return pa.RecordBatch.from_arrays([pa.array([x[k] for x in links], pa.int64()) for k in (0, 1)], names=["a", "b"])

    for batch in batches:
        for g, row, own in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2), strict=True):
            if g != gid and rows:
                yield out()
                rows, shingles = [], []
            gid = g
            rows.append(row)
            shingles.append(own.values.to_numpy())
    if rows:
        yield out()


def _compared_together(units: DataFrame, nodes: DataFrame) -> DataFrame:
    """Links ``(a, b)`` between the similar rows of each of ``units (gid, row)``."""
    rows = units.join(nodes.select("row", "short"), "row").select("gid", "row", "short")
    return rows.repartition("gid").sortWithinPartitions("gid").mapInArrow(_compared, "a long, b long").distinct()


def _across_blocks(crowded: DataFrame, links: DataFrame) -> DataFrame:
    """Units ``(gid, row)`` in which all rows of a key of ``crowded (key, row)`` meet that ``links`` leave in different components.

    Per key, the rows outside its largest component meet each other and that component, two blocks at a time.  A key whose rows
    are one component by now has nothing left to find.
    """
    roots = connected_components(links)
    placed = stored(crowded.join(roots, crowded.row == roots.vertex, "left").select("key", "row", F.coalesce("root", "row").alias("root")))
    parts = placed.groupBy("key", "root").agg(F.count("*").alias("n"))
    most = parts.groupBy("key").agg(F.max_by("root", F.struct("n", "root")).alias("main"), F.max("n").alias("inside"), F.sum("n").alias("n")).where("n > inside")
    blocks = lambda n: F.ceil(2 * n / MOST_TOGETHER)
    rest = placed.join(most.select("key", "main", blocks(F.col("n") - F.col("inside")).alias("outer"), blocks(F.col("inside")).alias("inner")), "key")
    drawn = F.xxhash64("row", "key")
    rest = rest.withColumn("block", F.when(F.col("root") == F.col("main"), F.col("outer") + F.pmod(drawn, F.col("inner"))).otherwise(F.pmod(drawn, F.col("outer"))))
    last = F.when(F.col("block") < F.col("outer"), F.col("outer") + F.col("inner")).otherwise(F.col("outer")) - 1
    met = rest.select("key", "row", "block", F.explode(F.sequence(F.lit(0).cast("long"), last.cast("long"))).alias("other")).where("block <> other")
    return met.select(F.xxhash64("key", F.least("block", "other"), F.greatest("block", "other")).alias("gid"), "row")


def short_links(nodes: DataFrame) -> DataFrame:
    """Links ``(a, b)`` that join all similar rows of ``nodes (row, short, ...)``, directly or over others.

    A shingle that is among the rare ones of more than ``MOST_TOGETHER`` rows, as in a large group of copies, first has its rows
    compared in blocks, drawn anew for each shingle, and with the smallest row.  That joins most of them; those of
    different components are then compared across all blocks, so no task holds more rows at once, and no link is lost.
    Where thousands of such rows share a shingle and are not similar, this takes as many comparisons as they have pairs.
    """
    keys = stored(_rare(nodes))
    sizes = keys.groupBy("key").agg(F.count("*").alias("uses"), F.min("row").alias("least")).where("uses > 1")
    met = stored(keys.join(sizes, "key"))
    block = F.when(F.col("uses") > MOST_TOGETHER, F.pmod(F.xxhash64("row", "key"), F.ceil(2 * F.col("uses") / MOST_TOGETHER))).otherwise(0)
    members = met.groupBy("key", "least", block.alias("block")).agg(F.collect_list("row").alias("own")).select(F.array_sort(F.array_union("own", F.array("least"))).alias("members"))
    together = members.where("size(members) > 1").distinct().select(F.xxhash64("members").alias("gid"), F.explode("members").alias("row"))
    links, crowded = stored(_compared_together(together, nodes)), met.where(F.col("uses") > MOST_TOGETHER).select("key", "row")
    if crowded.isEmpty():
        return links
    return links.union(_compared_together(_across_blocks(crowded, links), nodes))


def similar_links(nodes: DataFrame, held: DataFrame, text: str) -> DataFrame:
    """Links ``(a, b)`` between rows of ``nodes (row, fp, lanes, short, p0, ..., origin)`` whose texts in ``held (row, text)`` have ``SIMILARITY``.

    Short texts are linked by ``short_links``.  Each longer one is paired with the smallest row of every lane that it shares with
    others, so a lane that any number of rows share gives one pair for each of them.  Pairs are discarded by their pivot
    coordinates, then by the distance of their fingerprints, both within ``WIDE_LIMIT``; the survivors are verified on their
    shingles themselves.
    """
    links = short_links(nodes)
    keyed = nodes.select("row", F.explode("lanes").alias("key"))
    least = keyed.groupBy("key").agg(F.min("row").alias("least"), F.count("*").alias("n")).where("n > 1").select("key", "least")
    met = keyed.join(least, "key").where("row <> least").select(F.col("row").alias("a"), F.col("least").alias("b")).distinct()
    table = nodes.drop("lanes", "short")
    told = met.join(table.alias("x"), F.col("a") == F.col("x.row")).join(table.alias("y"), F.col("b") == F.col("y.row"))
    near = told.where(apart("x", "y") <= WIDE_LIMIT).where(F.bit_count(F.col("x.fp").bitwiseXOR(F.col("y.fp"))) <= WIDE_LIMIT)
    pairs = stored(near.select("a", "b"))
    wanted = pairs.select(F.col("a").alias("row")).union(pairs.select("b")).distinct()
    shingles = stored(_shingled(held.join(wanted, "row", "left_semi"), text))
    first, second = (shingles.select(F.col("row").alias(c), F.col("shingles").alias(f"s{c}")) for c in "ab")
    both = pairs.join(first, "a").join(second, "b")
    shared = F.size(F.array_intersect("sa", "sb"))
    every = F.size("sa") + F.size("sb") - shared
    return both.where((every == 0) | (shared >= SIMILARITY * every)).select("a", "b").union(links)


def keep_one_of_each(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row of ``docs`` from each group of near copies, columns unchanged.

    Near copies share ``SIMILARITY`` of their ``WIDE_SHINGLE``-word shingles; groups are what links between them reach.  The
    row that stays has the smallest id (rows without an id come last), of those the text with the smallest hash, of
    identical rows it is any one.  Each row has a key of its own for this, so a row stays or goes whatever others share
    its id.  Texts without words are one group, null among them.  Very long texts are one row like any other.
    An empty table gives an empty result.
    """
    names = [f"c{k}" for k in range(len(docs.columns))]
    rows = docs.select(*[F.col(f"`{c}`").alias(n) for c, n in zip(docs.columns, names, strict=True)], F.monotonically_increasing_id().alias("row"))
    own_id, text = (names[docs.columns.index(c)] for c in (id_col, text_col))
    same = [F.xxhash64(text).alias("h1"), F.xxhash64(F.lit("second"), text).alias("h2")]
    # stored with its key: a key that is computed again may not be the same
    held = stored(_sketched(rows.select("*", *same), text, [*names, "row", "h1", "h2"]).select("*", *pivot_table(F.col("fp"))))
    order = F.struct(F.col(own_id).isNull().alias("nameless"), F.col(own_id).alias("id"), F.col("h1"), F.col("row"))
    texts = stored(held.groupBy("h1", "h2").agg(F.min("row").alias("node"), F.min(order).alias("best")).select("node", "best"))
    nodes = held.drop("h1", "h2", *names).join(texts.select(F.col("node").alias("row")), "row", "left_semi")
    roots = connected_components(similar_links(nodes, held.select("row", text), text))
    firsts = texts.join(roots, texts.node == roots.vertex, "left").groupBy(F.coalesce("root", "node")).agg(F.min("best").alias("best")).select(F.col("best.row").alias("kept"))
    return held.join(firsts, held.row == firsts.kept, "left_semi").select(*[F.col(n).alias(c) for c, n in zip(docs.columns, names, strict=True)])
