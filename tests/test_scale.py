"""Groups of any size: numbers, names and expansion without a task that holds a whole session."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from quire.operators import naming, ranking
from quire.operators.elements import path_key, preorder
from quire.operators.naming import allocate, directory_names, simple_names
from quire.plans import corpus
from quire.plans import expand as expand_
from quire.plans.expand import expand
from quire.queries import halves


def test_ranks_and_sums(spark):
    rng = random.Random(1)
    rows = [(rng.choice([None, "hot", "hot", "hot", f"s{k % 7}"]), k, rng.randrange(5)) for k in range(500)]
    df = spark.createDataFrame(rows, "g string, o int, v int").repartition(3)
    want_rank, want_sum = {}, {}
    for g in {r[0] for r in rows}:
        total = 0
        for at, (_, o, v) in enumerate(sorted((r for r in rows if r[0] == g), key=lambda r: r[1])):
            want_rank[o], want_sum[o] = at, total
            total += v
    assert {r.o: r["rank"] for r in ranking.ranked(df, ["g"], ["o"]).collect()} == want_rank
    got = ranking.running(df, ["g"], ["o"], {"before": F.col("v"), "count": F.lit(1)}).collect()
    assert {r.o: r.before for r in got} == want_sum
    assert {r.o: r["count"] for r in got} == want_rank
    assert ranking.ranked(df.where("false"), ["g"], ["o"]).count() == 0


def test_one_group_spreads(spark):
    """The ranges of a single group hold about equal shares."""
    placed = ranking._dealt(spark.range(20_000).selectExpr("1 g", "id * 7919 % 20011 o"), ["g"], ["o"])
    counts = [r["count"] for r in placed.groupBy(ranking._PART).count().collect()]
    if len(counts) > 1:
        assert max(counts) < 2 * 20_000 / len(counts)
    ranks = ranking.ranked(spark.range(20_000).selectExpr("1 g", "id * 7919 % 20011 o"), ["g"], ["o"])
    assert ranks.agg(F.countDistinct("rank"), F.min("rank"), F.max("rank")).first()[:] == (20_000, 0, 19_999)


@pytest.mark.parametrize("keys", [["g"], ["g", "h"], []])
def test_groups_over_several_ranges(spark, keys):
    """Groups that begin before a range, within it and that fill several, with null among them."""
    rng = random.Random(4)
    rows = [(rng.choice([None, "a", "hot", "hot", "hot", f"s{k % 5}"]), rng.randrange(2), k, rng.randrange(5)) for k in range(600)]
    df = spark.createDataFrame(rows, "g string, h int, o int, v int").repartition(3)
    want, sums = {}, {}
    for r in sorted(rows, key=lambda r: r[2]):
        group = tuple(r[:2][: len(keys)])
        n, total = sums.get(group, (0, 0))
        want[r[2]] = (n, total)
        sums[group] = (n + 1, total + r[3])
    held = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        assert ranking._dealt(df, keys, ["o"]).select(ranking._PART).distinct().count() > 2
        assert {r.o: r["rank"] for r in ranking.ranked(df, keys, ["o"]).collect()} == {o: n for o, (n, _) in want.items()}
        got = ranking.running(df, keys, ["o"], {"before": F.col("v"), "count": F.lit(1)})
        assert got.columns == ["g", "h", "o", "v", "before", "count"]
        assert {r.o: (r["count"], r.before) for r in got.collect()} == want
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", held)


def joins(df):
    """Joins of the plan, and those of them that Spark may turn into copies for each executor by the size of files."""
    found = [x for x in df._jdf.queryExecution().optimizedPlan().toString().splitlines() if "Join " in x]
    return found, [x for x in found if "strategy=" not in x]


@pytest.mark.parametrize("few", [100_000, 0])
def test_file_sizes_decide_no_join(spark, monkeypatch, few):
    """Stored rows may be a hundred times as large as their files, so no join of an expansion is left to the files' size."""
    seen = []
    monkeypatch.setattr(expand_, "FEW", few)
    for module in (expand_, naming, ranking, corpus):
        monkeypatch.setattr(module, "staged", lambda df, keep=module.staged: seen.append(df) or keep(df))
    sources = spark.createDataFrame([(f"s{k % 4}", f, bytearray(b"x\ny\nx\ny")) for k, f in enumerate(["f.half", "f_2.half", "a.png", "f.half", "f.half"])], "session_id string, file_name string, content binary")
    found = expand(sources, parsers={"half": halves}, images_recurse=True, keep_content=True)
    every = [joins(df) for df in (*seen, *found.values(), corpus.corpus_files(found["docs"]))]
    assert sum(len(all_) for all_, _ in every) > 20
    assert not [x for _, free in every for x in free]


def test_pictures_that_hold_themselves_join_by_sorting(spark, monkeypatch):
    """Ten levels of pictures alone: nothing is embedded, so levels need no links, and no join goes by the files' size."""
    seen = []
    for module in (expand_, naming, ranking):
        monkeypatch.setattr(module, "staged", lambda df, keep=module.staged: seen.append(df) or keep(df))
    docs = expand(spark.createDataFrame([(k, "a b.png", bytearray(b"p%d" % (k % 3))) for k in range(5)], "session_id int, file_name string, content binary"), images_recurse=True)["docs"]
    assert not [x for df in (*seen, docs) for x in joins(df)[1]]
    assert not [df for df in seen if "parent_position" in df.columns and joins(df)[0]]
    got = sorted((d.session_id, d.depth, d.dir, bytes(d.images[0].data)) for d in docs.select("session_id", "depth", "dir", "images").collect())
    assert got == [(s, d, "a_b" if d == 0 else f"a_b_{d + 1}", b"p%d" % (s % 3)) for s in range(5) for d in range(10)]


def test_path_keys_sort_as_paths(spark):
    rng = random.Random(2)
    paths = [[0, *(rng.choice([0, 1, 2, 300, 70_000]) for _ in range(rng.randrange(5)))] for _ in range(200)]
    df = spark.createDataFrame([(p,) for p in paths], "path array<int>")
    assert [r.path for r in df.orderBy(path_key(F.col("path"))).collect()] == sorted(paths)
    nodes = df.distinct().withColumn("s", F.lit(1))
    order = [r.path for r in preorder(nodes, ["s"]).orderBy("seq").collect()]
    assert order == sorted(map(list, {tuple(p) for p in paths}))


@pytest.mark.parametrize("seed", range(2))
def test_names_equal_the_fold(spark, seed):
    rng = random.Random(seed)
    pool = ["a", "b", "a_2", "a_3", "a_2_2", "a_02", "a_1", "b_2_2", "a_2_3", "_2", "x_5", "a_5", "a_6", "a_999999999999999999999"]
    rows, want = [], {}
    for s in [None, *range(20)]:
        bases = [rng.choice(pool[: rng.choice([3, 6, 14])]) for _ in range(rng.randrange(40))]
        for k, (b, d) in enumerate(zip(bases, allocate(bases), strict=True)):
            rows.append((s, k * 3, b, k))
            want[s, k * 3] = d
    df = spark.createDataFrame(rows, "session int, seq int, base string, extra int").repartition(3)
    got = directory_names(df, ["session"])
    assert got.columns == [*df.columns, "dir"]
    assert {(r.session, r.seq): r.dir for r in got.collect()} == want


def test_names_of_chains(spark):
    """Each claim depends on the one before, so rounds are needed."""
    bases = ["p"] * 6 + [f"p_{k}" for k in (9, 8, 7, 2, 3)] + ["p", "p_7_2", "p_7", "p_7", "p", "p", "p", "p"]
    df = spark.createDataFrame(list(enumerate(bases)), "seq int, base string")
    assert [r.dir for r in directory_names(df, []).orderBy("seq").collect()] == allocate(bases)


def test_plain_names(spark):
    df = spark.createDataFrame([(1, 5, "a"), (1, 2, "a"), (2, 1, "a"), (1, 9, None)], "s int, seq int, base string")
    assert {(r.s, r.seq): r.dir for r in simple_names(df, ["s"]).collect()} == {(1, 2): "a", (1, 5): "a_2", (2, 1): "a", (1, 9): None}


def counted(folder):
    """A parser that leaves a file for each call."""

    def parse(data: bytes) -> dict:
        import uuid

        with open(f"{folder}/{uuid.uuid4().hex}", "wb") as f:
            f.write(data)
        return halves(data)

    return parse


def test_equal_contents_are_parsed_once(spark, tmp_path):
    """A content that comes in many sessions and on several levels is parsed once; the tree is as without sharing."""
    shared = b"x\ny\nx\ny"
    files = [(f"s{k}", "f.half", bytearray(shared if k % 2 else shared + b"\n" + shared)) for k in range(12)]
    files += [("t", "f.half", bytearray(b"x")), ("t2", "f.half", None), ("t3", "f.none", bytearray(b"x"))]
    sources = spark.createDataFrame(files, "session_id string, file_name string, content binary")
    found = expand(sources, parsers={"half": counted(str(tmp_path))}, keep_content=True)
    docs = found["docs"].collect()
    calls = [p.read_bytes() for p in tmp_path.iterdir()]
    assert sorted(calls) == sorted({bytes(d.content or b"") for d in docs})
    assert found["contents"].count() == len(calls)
    assert sum(d.session_id == "s1" for d in docs) == 7
    assert sum(d.session_id == "s0" for d in docs) == 15
    assert [r.file_name for r in found["skipped"].collect()] == ["f.none"]
    s0 = {tuple(d.path): d for d in docs if d.session_id == "s0"}
    assert [bytes(s0[p].content) for p in ((0,), (0, 0), (0, 1, 0, 1))] == [shared + b"\n" + shared, shared, b"y"]
    assert [d.seq for d in sorted(s0.values(), key=lambda d: d.path)] == list(range(15))
    limited = expand(sources, depth_limit=2, parsers={"half": halves})["docs"]
    assert limited.agg(F.max("depth")).first()[0] == 1


@pytest.mark.parametrize("few", [100_000, 0])
def test_files_left_out(spark, monkeypatch, few):
    """A long list of files to leave out leaves the same ones, and moves few of the others."""
    monkeypatch.setattr(expand_, "FEW", few)
    files = spark.range(20_000).select(F.col("id").cast("string").alias("in_key"), (F.col("id") % 3).cast("int").alias("k"), F.lit("parser").alias("parser"), F.repeat(F.lit("x"), 500).cast("binary").alias("content"))
    out = files.where("in_key % 10 = 7").select("in_key", "k")
    kept = expand_._without(files, out, ["in_key", "k"])
    assert kept.columns == files.columns
    assert sorted(int(r.in_key) for r in kept.select("in_key").collect()) == [k for k in range(20_000) if k % 10 != 7]


def test_contents_are_stored_once(spark, monkeypatch):
    """Neither a level's table nor what is laid out holds the bytes of a file beside those that its container embeds."""
    seen = []
    for module in (expand_, corpus):
        monkeypatch.setattr(module, "staged", lambda df, keep=module.staged: seen.append(df.columns) or keep(df))
    sources = spark.createDataFrame([("s", "f.half", bytearray(b"x\ny\nz"))], "session_id string, file_name string, content binary")
    files = corpus.corpus_files(expand(sources, parsers={"half": halves}, keep_content=True)["docs"])
    assert sorted(bytes(r.content) for r in files.where("path like '%.half'").collect()) == [b"x", b"x\ny\nz", b"y", b"y\nz", b"z"]
    assert not [c for c in seen if "content" in c or ("embedded" in c and "body" in c)]


def test_contents_without_the_tree(spark, monkeypatch):
    """Distinct contents are those of the expansion, and no file is placed or numbered for them."""
    sources = spark.createDataFrame([(f"s{k % 4}", "f.half", bytearray(b"x\ny\nx\n%d" % (k // 4))) for k in range(8)] + [("p", "a.png", bytearray(b"x"))], "session_id string, file_name string, content binary")
    want = sorted((r.content_key, len(r.embedded)) for r in expand(sources, parsers={"half": halves})["contents"].collect())
    seen = []
    for module in (expand_, naming, ranking):
        monkeypatch.setattr(module, "staged", lambda df, keep=module.staged: seen.append(df) or keep(df))
    found = expand_.distinct_contents(expand_.contents_of(sources, parsers={"half": halves}))
    assert sorted((r.content_key, len(r.embedded)) for r in found.collect()) == want
    assert not [x for df in (*seen, found) for x in joins(df)[1]]
    assert len([df for df in seen if "path" in df.columns]) == 1


def test_the_tree_of_copies_is_stored(spark):
    """Copies and what is laid out read the tree's names from one table, not from the joins that made them."""
    sources = spark.createDataFrame([("s", "f.half", bytearray(b"x\ny\nz"))], "session_id string, file_name string, content binary")
    plan = expand(sources, parsers={"half": halves}, keep_content=True)["docs"]._jdf.queryExecution().optimizedPlan().toString()
    assert "Window" not in plan and "LeftOuter" not in plan


def test_the_layout_needs_no_bytes(spark, monkeypatch):
    """What is laid out is not joined with the contents that copies need."""
    found = expand(spark.createDataFrame([("s", "f.half", bytearray(b"x\ny"))], "session_id string, file_name string, content binary"), parsers={"half": halves}, keep_content=True)
    seen = []
    monkeypatch.setattr(corpus, "staged", lambda df, keep=corpus.staged: seen.append(df) or keep(df))
    files = corpus.corpus_files(found["docs"], found["bare"])
    assert len(seen) == 1 and len(joins(seen[0])[0]) == 1
    want = corpus.corpus_files(found["docs"])
    assert sorted((r.path, bytes(r.content)) for r in files.collect()) == sorted((r.path, bytes(r.content)) for r in want.collect())
    assert len(joins(seen[1])[0]) > 1


def test_no_files(spark):
    found = expand(spark.createDataFrame([], "session_id string, file_name string, content binary"))
    assert [found[k].count() for k in ("docs", "skipped", "contents")] == [0, 0, 0]


def test_handlers_are_replaced(spark):
    """A list of handlers takes the place of the known one: its order decides, and what it leaves out is unsupported."""
    texts = {"first": lambda data: {"elements": [{"position": 0, "type": "first", "content": data.decode(), "metadata": None}]}, "second": lambda data: {"elements": [{"position": 0, "type": "second", "content": data.decode(), "metadata": None}]}}
    files = spark.createDataFrame([("s", n, bytearray(b"x")) for n in ("a.one", "b.two", "c.pdf")], "session_id string, file_name string, content binary")

    def kinds(handlers):
        found = expand(files, parsers=texts, handlers=handlers)
        return {d.file_name: d.elements[0].type for d in found["docs"].collect()}, sorted(r.file_name for r in found["skipped"].collect())

    assert kinds([("first", ["one"]), ("second", ["one", "two"])]) == ({"a.one": "first", "b.two": "second"}, ["c.pdf"])
    assert kinds([("second", ["one", "two"]), ("first", ["one"])]) == ({"a.one": "second", "b.two": "second"}, ["c.pdf"])
    assert kinds([]) == ({}, ["a.one", "b.two", "c.pdf"])


def test_objects_are_known_by_content_type():
    """A part's own type counts, then that of its suffix; the suffix ``bin`` only where a package tells none."""
    import io
    import zipfile

    from quire.sources import packages

    ns = "http://schemas.openxmlformats.org/package/2006/content-types"
    types = f'<Types xmlns="{ns}"><Default Extension="bin" ContentType="application/vnd.openxmlformats-officedocument.oleObject"/><Override PartName="/word/embeddings/plain.bin" ContentType="application/octet-stream"/><Override PartName="/word/embeddings/o.dat" ContentType="application/ole"/></Types>'
    body = '<w:document xmlns:w="http://schemas.openxmlformats.org/wordprocessingml/2006/main"><w:body/></w:document>'
    box = b"in.txt\0hello"

    def names(with_types):
        out = io.BytesIO()
        with zipfile.ZipFile(out, "w") as z:
            if with_types:
                z.writestr("[Content_Types].xml", types)
            z.writestr("word/document.xml", body)
            for n in ("a.bin", "plain.bin", "o.dat", "p.docx"):
                z.writestr(f"word/embeddings/{n}", box)
        return [(e["file_name"], e["data"]) for e in packages.parse_docx(out.getvalue())["embedded"]]

    assert names(True) == [("in.txt", b"hello"), ("plain.bin", box), ("in.txt", b"hello"), ("p.docx", box)]
    assert names(False) == [("in.txt", b"hello"), ("in.txt", b"hello"), ("o.dat", box), ("p.docx", box)]
