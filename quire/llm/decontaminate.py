"""Benchmark decontamination by spaced-seed hashing, in DataFrame operations only.

Tokens are the runs of letters and digits of the lower-cased text.  A seed is the hash of the tokens
that a fixed mask reads, ignoring the positions between them; seeds of test items and documents
are joined.  Every hit names a diagonal (document position minus item position), and each
diagonal is verified on the tokens themselves: a document is contaminated by an item if
``WINDOW`` successive item tokens lie along it with at most ``ERRORS`` of them replaced.

The default mask leaves no gap: however two tokens of thirteen are replaced, one of its placements
inside the window reads none of them, so the verified result is that of comparing every
document with every item.

Items shorter than the window are searched as a whole, with one token in six replaced at most.  They have seeds of
their own: an item that may have e tokens replaced is cut into e + 1 runs, one of which is unchanged wherever
it occurs.  Documents are read for runs of the lengths that occur among the items, if any do.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quire.llm.common import stored

MASKS = ((0, 1, 3, 6, 7),)
WINDOW = 13
ERRORS = 2
#: Tokens of an item shorter than ``WINDOW`` for each one that may be replaced.
PER_ERROR = 6
#: Seeds of the benchmark (16 bytes each) up to which they are sent to all executors; beyond, the join is shuffled.
BROADCAST_SEEDS = 1 << 20


def tokens(text: Column) -> Column:
    return F.filter(F.split(F.lower(text), r"[^\p{L}\p{N}]+"), lambda w: w != "")


def _seeds(codes: Column, mask: tuple[int, ...], k: int) -> Column:
    """The hash at each placement of a mask on ``codes`` (hashes of tokens); null for fewer tokens than it spans."""
    last = F.size(codes) - mask[-1] - 1
    return F.when(last >= 0, F.transform(F.sequence(F.lit(0), last), lambda i: F.xxhash64(F.lit(k), *[F.get(codes, i + m) for m in mask])))


def _placed(rows: DataFrame, keys: list[str], at: str, masks: dict[int, tuple[int, ...]]) -> DataFrame:
    """``(keys, at, seed)`` for every placement of every mask on ``rows (keys, codes)``.

    The outer form of explode keeps the optimizer from testing the array's size beforehand, which would
    compute the tokens anew for every placement.
    """
    each = [rows.select(*keys, F.posexplode_outer(_seeds(F.col("codes"), mask, k)).alias(at, "seed")) for k, mask in masks.items()]
    return reduce(DataFrame.unionAll, each).where("seed is not null")


def _run(length: int) -> tuple[int, tuple[int, ...]]:
    """Number and mask of a run of ``length`` tokens."""
    return -length, tuple(range(length))


def overlaps(
    docs: DataFrame,
    items: DataFrame,
    text_col: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    masks: tuple[tuple[int, ...], ...] = MASKS,
    window: int = WINDOW,
    errors: int = ERRORS,
) -> DataFrame:
    """Verified overlaps ``(rid, item, matched)`` of ``docs (rid, text_col)``; equal items are one, under their smallest id.

    ``matched`` is the largest number of equal tokens in a window, or in the whole item if it is
    shorter than ``window``.  Null and empty texts and items overlap with nothing; rows that share a ``rid`` are taken for one
    document; a very long text is searched whole; other columns are not read; an empty table on either side gives an empty result.
    """
    tests = items.select(F.col(item_id).alias("item"), tokens(F.col(item_text)).alias("words"))
    tests = tests.groupBy("words").agg(F.min("item").alias("item")).where(F.size("words") > 0).withColumn("item_key", F.struct(F.xxhash64("words"), F.xxhash64(F.lit("second"), "words"))).withColumn("n", F.size("words"))
    short = F.when(F.col("n") < window, F.floor(F.col("n") / PER_ERROR).cast("int") + 1)
    tests = stored(tests.withColumn("errors", F.coalesce(short - 1, F.lit(errors))).withColumn("run", F.floor(F.col("n") / short).cast("int")))
    codes = lambda words: F.transform(words, lambda w: F.xxhash64(w)).alias("codes")
    coded = tests.select("item_key", "n", "run", codes(F.col("words")))
    spaced = dict(enumerate(masks))
    runs = dict(_run(r.run) for r in tests.where("run is not null").select("run").distinct().collect())  # lengths below the window
    theirs = [_placed(coded.where(F.col("n") >= window), ["item_key", "n"], "item_at", spaced)]
    for number, mask in runs.items():
        own = coded.where(F.col("run") == len(mask))
        theirs.append(_placed(own, ["item_key", "n"], "item_at", {number: mask}).where(F.col("item_at") % len(mask) == 0))
    theirs = stored(reduce(DataFrame.unionAll, theirs))
    keys = theirs.select("seed").distinct()
    if theirs.count() <= BROADCAST_SEEDS:
        keys, theirs = F.broadcast(keys), F.broadcast(theirs)
    ours = _placed(docs.select("rid", codes(tokens(F.col(text_col)))), ["rid"], "at", spaced | runs)
    hits = ours.join(keys, "seed", "left_semi").join(theirs, "seed")
    lines = hits.select("rid", "item_key", "n", (F.col("at") - F.col("item_at")).alias("shift")).distinct()
    by_row = stored(lines.groupBy("rid").agg(F.collect_list(F.struct("item_key", "shift", "n")).alias("lines")))
    near = docs.join(by_row, "rid").select("rid", "lines", tokens(F.col(text_col)).alias("own"))

    # only the tokens beside an item leave their document
    def beside(line: Column) -> Column:
        return F.struct(line["item_key"].alias("item_key"), line["shift"].alias("shift"), F.slice("own", F.greatest(line["shift"], F.lit(0)) + 1, line["n"] + F.least(line["shift"], F.lit(0))).alias("part"))

    parts = near.select("rid", F.explode_outer(F.transform("lines", beside)).alias("line")).select("rid", "line.*")
    skip = F.greatest(F.lit(0), -F.col("shift"))
    pairs = stored(
        parts.join(tests, "item_key").select("rid", "item", "n", "errors", F.zip_with("part", F.slice("words", skip + 1, F.size("part")), lambda x, y: (x == y).cast("int")).alias("same"))
    )
    need = F.least(F.lit(window), F.col("n"))
    least = need - F.col("errors")
    # no window fits if the item runs over the document's edge
    at = F.when(F.size("same") >= need, F.sequence(F.lit(1), F.size("same") - need + 1))
    most = F.array_max(F.transform(at, lambda i: F.aggregate(F.slice("same", i, need), F.lit(0), lambda x, y: x + y)))
    return stored(pairs.select("rid", "item", most.alias("matched"), least.alias("least")).groupBy("rid", "item", "least").agg(F.max("matched").alias("matched")).where("matched >= least").drop("least"))


def _keyed(docs: DataFrame, id_col: str, text_col: str) -> Column:
    """A row's own key, of two hashes of its id and text: rows that share both are alike in everything that follows."""
    return F.struct(F.xxhash64(docs[id_col], docs[text_col]), F.xxhash64(F.lit("second"), docs[text_col], docs[id_col]))


def contamination(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_id: str = "item_id", item_text: str = "text") -> DataFrame:
    """One row per row of ``docs``: ``(id_col, contaminated, n_items, item_id, matched)``.

    ``item_id`` is the smallest id of the items found, ``matched`` the most tokens of one
    window; both are null without a find.  Null and empty texts and items match nothing; repeated
    rows have equal results, and a null id is an id like any other; long texts are read whole; an empty table on
    either side gives no finds.  Other columns are not read.
    """
    rows = docs.select(_keyed(docs, id_col, text_col).alias("rid"), F.col(text_col).alias("text"))
    found = overlaps(rows, items, "text", item_id, item_text).groupBy("rid").agg(F.count("*").alias("n_items"), F.min("item").alias("item_id"), F.max("matched").alias("matched"))
    ids = docs.select(_keyed(docs, id_col, text_col).alias("rid"), F.col(id_col))
    return ids.join(found, "rid", "left").select(id_col, F.col("n_items").isNotNull().alias("contaminated"), F.coalesce("n_items", F.lit(0).cast("long")).alias("n_items"), "item_id", "matched")


def without_leaks(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_id: str = "item_id", item_text: str = "text") -> DataFrame:
    """The rows of ``docs`` that no item contaminates, columns of any name unchanged.

    Null and empty texts stay; repeated rows stay or go together, rows with a null id by their text like any other; an
    empty table gives an empty result, and without items every row stays.
    """
    rows = docs.select(_keyed(docs, id_col, text_col).alias("rid"), F.col(text_col).alias("text"))
    leaks = overlaps(rows, items, "text", item_id, item_text).select(F.col("rid").alias("leak")).distinct()
    return docs.join(leaks, _keyed(docs, id_col, text_col) == leaks["leak"], "left_anti")


#: The same result without seeds: thirteen tokens with two replaced leave four successive ones unchanged, so
#: shared runs of four name the diagonals; of shorter items any shared token does.
ORACLE = rf"""
WITH d AS (SELECT doc_id, list_filter(string_split_regex(lower(text), '[^\p{{L}}\p{{N}}]+'), lambda w: w <> '') AS w FROM documents),
b AS (SELECT min(item_id) AS item_id, w, CASE WHEN len(w) >= {WINDOW} THEN {ERRORS} ELSE len(w) // {PER_ERROR} END AS e
  FROM (SELECT item_id, list_filter(string_split_regex(lower(text), '[^\p{{L}}\p{{N}}]+'), lambda w: w <> '') AS w FROM benchmark) WHERE len(w) > 0 GROUP BY w),
dg AS (SELECT doc_id, i, array_to_string(w[i:i+3], ' ') AS g FROM (SELECT doc_id, w, unnest(range(1, len(w) - 2)) AS i FROM d)),
bg AS (SELECT item_id, i, array_to_string(w[i:i+3], ' ') AS g FROM (SELECT item_id, w, unnest(range(1, len(w) - 2)) AS i FROM b WHERE len(w) >= {WINDOW})),
dt AS (SELECT doc_id, i, w[i] AS g FROM (SELECT doc_id, w, unnest(range(1, len(w) + 1)) AS i FROM d)),
bt AS (SELECT item_id, i, w[i] AS g FROM (SELECT item_id, w, unnest(range(1, len(w) + 1)) AS i FROM b WHERE len(w) < {WINDOW})),
lines AS (SELECT DISTINCT doc_id, item_id, dg.i - bg.i AS shift FROM dg JOIN bg USING (g) UNION SELECT DISTINCT doc_id, item_id, dt.i - bt.i FROM dt JOIN bt USING (g)),
cells AS (
  SELECT doc_id, item_id, shift, k, len(b.w) AS n, e, CAST(b.w[k] = d.w[k + shift] AS INTEGER) AS same
  FROM lines JOIN d USING (doc_id) JOIN b USING (item_id), unnest(range(greatest(1, 1 - shift), least(len(b.w), len(d.w) - shift) + 1)) AS t(k)),
sums AS (
  SELECT doc_id, item_id, n, e, k, sum(same) OVER p13 AS matched, count(*) OVER p13 AS held, sum(same) OVER pall AS whole, count(*) OVER pall AS there
  FROM cells WINDOW p13 AS (PARTITION BY doc_id, item_id, shift ORDER BY k ROWS BETWEEN {WINDOW - 1} PRECEDING AND CURRENT ROW), pall AS (PARTITION BY doc_id, item_id, shift)),
hits AS (
  SELECT doc_id, item_id, max(CASE WHEN n >= {WINDOW} THEN matched ELSE whole END) AS matched FROM sums
  WHERE (n >= {WINDOW} AND held = {WINDOW} AND matched >= {WINDOW} - e) OR (n < {WINDOW} AND there = n AND whole >= n - e) GROUP BY ALL)
SELECT doc_id, count(hits.item_id) > 0 AS contaminated, count(hits.item_id) AS n_items, min(hits.item_id) AS item_id, CAST(max(matched) AS INTEGER) AS matched
FROM documents LEFT JOIN hits USING (doc_id) GROUP BY doc_id
"""
