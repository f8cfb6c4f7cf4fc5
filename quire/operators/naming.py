"""Directory names of documents: the first free of base, base_2, base_3, ... in order."""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quire.operators.ranking import ranked, running
from quire.sources.shared import by_sorting, staged

#: A name that a shorter base may be given: the base, and a number from 2 on without leading zeros.
NUMBERED = r"(?s)\A(.+)_([2-9]|[1-9][0-9]{1,17})\z"


def numbered(base: Column, number: Column) -> Column:
    """The name with this number; the first one is the base itself."""
    return F.when(number == 1, base).otherwise(F.concat_ws("_", base, number.cast("string")))


def simple_names(docs: DataFrame, session: list[str], base: str = "base", order: str = "seq") -> DataFrame:
    """``docs`` with ``dir`` where no base ends in an underscore and digits: the suffix is the rank within the base."""
    return ranked(docs, [*session, base], [order], "__rank").withColumn("dir", numbered(F.col(base), F.col("__rank") + 1)).drop("__rank")


def allocate(bases: Iterable[str]) -> list[str]:
    """Names in turn for ``bases``; a name once given stays taken, whichever base it came from."""
    used: set[str] = set()
    following: dict[str, int] = {}
    out = []
    for base in bases:
        name = base
        if name in used:
            k = following.get(base, 2)
            while f"{base}_{k}" in used:
                k += 1
            following[base] = k + 1
            name = f"{base}_{k}"
        used.add(name)
        out.append(name)
    return out


def directory_names(docs: DataFrame, session: list[str], base: str = "base", order: str = "seq") -> DataFrame:
    """``docs`` with ``dir``, also where bases look like given names (a, a, a_2 become a, a_2, a_2_2).

    A name ``p_k`` can be given to two kinds of documents only: the first one with base ``p_k``, or one with base ``p``.
    The base ``p`` passes over k if the other was there first, that is, if the documents of p before it and the numbers
    passed over before k are together less than k.  All such claims are settled by joins in rounds: each
    round counts, for every claim, the numbers that are surely and those that are possibly passed over, and settles those
    for which both counts agree; the smallest open number of a settled base always is among them.  A document's
    number is then its rank among its base's documents and passed numbers together.

    No session, base or family is gathered anywhere: ranks and sums spread over tasks.  ``order`` is distinct within a session.
    """
    rows = ranked(docs, [*session, base], [order], "__rank")
    skipped = _passed(rows.select(*session, base, order), session, base, order)
    if skipped is None:
        return rows.withColumn("dir", numbered(F.col(base), F.col("__rank") + 1)).drop("__rank")
    # the i-th passed number k moves the documents from rank k - i on by one
    marks = ranked(skipped, [*session, base], ["__k"], "__i").select(*session, base, (F.col("__k") - F.col("__i") - 1).alias("__rank"), F.lit(0).alias("__kind"))
    both = rows.withColumn("__kind", F.lit(1)).unionByName(marks, allowMissingColumns=True)
    placed = ranked(both, [*session, base], ["__rank", "__kind"], "__number").where("__kind = 1")
    return placed.withColumn("dir", numbered(F.col(base), F.col("__number") + 1)).drop("__rank", "__kind", "__number")


def _on(left: DataFrame, right: DataFrame, pairs: dict[str, str]) -> Column:
    return reduce(lambda a, b: a & b, [left[a].eqNullSafe(right[b]) for a, b in pairs.items()])


def _passed(rows: DataFrame, session: list[str], base: str, order: str) -> DataFrame | None:
    """``(session, base, __k)``: the numbers that each base passes over, 1 if its own name went to a shorter base; null if no base looks like a given name."""
    if rows.where(F.col(base).rlike(NUMBERED)).isEmpty():
        return None
    bases = rows.groupBy(*session, base).agg(F.min(order).alias(order))
    looks = bases.where(F.col(base).rlike(NUMBERED)).select(*session, F.regexp_extract(base, NUMBERED, 1).alias("__up"), F.regexp_extract(base, NUMBERED, 2).cast("long").alias("__k"), F.col(base).alias("__own"), order)
    shorter = bases.select(*[F.col(c).alias(f"__s{i}") for i, c in enumerate(session)], F.col(base).alias("__base"))
    held = {c: f"__s{i}" for i, c in enumerate(session)}
    claims = staged(looks.join(by_sorting(shorter), _on(looks, shorter, held | {"__up": "__base"})).drop(*held.values(), "__base"))
    if claims.isEmpty():
        return None
    group = [*session, "__up"]
    # documents of the shorter base before each claim: its rank among both, without the claims before it
    asked = ranked(claims, group, [order], "__claims")
    some = asked.select(*[F.col(c).alias(f"__s{i}") for i, c in enumerate(session)], F.col("__up").alias("__base")).distinct()
    theirs = rows.join(by_sorting(some), _on(rows, some, held | {base: "__base"}), "left_semi").withColumnRenamed(base, "__up")
    among = ranked(asked.unionByName(theirs, allowMissingColumns=True), group, [order], "__all").where("__own is not null")
    state = staged(among.select(*group, "__k", "__own", (F.col("__all") - F.col("__claims")).alias("__before"), F.lit(None).cast("boolean").alias("__skip")))
    while True:
        known = state.select(*[F.col(c).alias(f"__s{i}") for i, c in enumerate(session)], F.col("__own").alias("__name"), F.coalesce(F.col("__skip").cast("int"), F.lit(-1)).alias("__first"))
        sums = running(state, group, ["__k"], {"__sure": F.coalesce("__skip", F.lit(False)).cast("long"), "__possible": F.coalesce("__skip", F.lit(True)).cast("long")})
        seen = sums.join(by_sorting(known), _on(sums, known, held | {"__up": "__name"}), "left").drop(*held.values(), "__name")
        # a base whose own name went to a shorter one passes over 1
        low = F.col("__before") + F.col("__sure") + (F.coalesce("__first", F.lit(1)) == 0).cast("long")
        high = F.col("__before") + F.col("__possible") + (F.coalesce("__first", F.lit(1)) != 1).cast("long")
        settled = F.coalesce("__skip", F.when(high < F.col("__k"), True).when(low >= F.col("__k"), False))
        state = staged(seen.withColumn("__skip", settled).drop("__sure", "__possible", "__first"))
        if state.where("__skip is null").isEmpty():
            break
    over = state.where("__skip").select(*session, F.col("__up").alias(base), "__k")
    return over.union(state.where("not __skip").select(*session, F.col("__own").alias(base), F.lit(1).cast("long").alias("__k")))
