"""Conflict-constrained best-fit packing of documents into bins of a fixed number of words.

Bins are kept in order of the room that they have left; each carries a bitmap of the sources and one of
the duplicate clusters that it holds.  A document goes to the tightest bin that has room for it
and shares neither its source nor its cluster; the successor search starts at the first bin
with enough room and goes on until a bin fits.  Without one a new bin is opened.

Packing is sequential, so it is done in shards of about ``SHARD`` pieces, longest pieces first within each.
Shards are dealt by a hash of the document's key, so each is an even sample of sources and
lengths; their number follows the corpus, their size does not.  Within a shard the result is that of
best fit; over the table it takes a few more bins than one pass over everything would (see the README).
"""

from __future__ import annotations

from bisect import bisect_left, insort

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quire.llm.common import stored

CAPACITY = 2048
SHARD = 2000
_PACKED = "doc_id {id}, piece int, n_words int, bin string, bin_at int"
_READ = ["doc_id", "piece", "n_words", "source", "cluster"]


def best_fit(sizes: list[int], sources: list[object], clusters: list[object], capacity: int) -> list[tuple[int, int]]:
    """Bin and offset of each item, in the order of the lists; null sources and clusters conflict with nothing.

    Bins with equal room are tried in the order in which they were opened.
    """
    bit: dict[object, int] = {}
    mask = lambda kind, v: 0 if v is None else 1 << bit.setdefault((kind, v), len(bit))
    rooms: list[tuple[int, int]] = []  # (room left, bin), in order
    held: list[int] = []
    used: list[int] = []
    out = []
    for size, source, cluster in zip(sizes, sources, clusters, strict=True):
        own = mask("source", source) | mask("cluster", cluster)
        for k in range(bisect_left(rooms, (size, -1)), len(rooms)):
            if not held[rooms[k][1]] & own:
                room, chosen = rooms.pop(k)
                break
        else:
            room, chosen = capacity, len(held)
            held.append(0)
            used.append(0)
        out.append((chosen, used[chosen]))
        held[chosen] |= own
        used[chosen] += size
        insort(rooms, (room - size, chosen))
    return out


def word_count(text_col: str) -> Column:
    """Words of a text; null has none."""
    return F.size(F.filter(F.split(F.coalesce(text_col, F.lit("")), r"[\x20\x09-\x0D]+"), lambda w: w != ""))


def pack(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    capacity: int = CAPACITY,
    shard: int = SHARD,
    cluster_col: str | None = None,
    words_col: str | None = None,
) -> DataFrame:
    """``(doc_id, piece, n_words, bin, bin_at)``: the place of every piece of every document.

    Lengths are words (runs of other characters than ASCII white space), or what ``words_col`` says, null being
    none; with it and ``cluster_col`` the text is not read.  A document longer than a bin, however long,
    is cut into full pieces and a rest; full pieces fill bins up.  The cluster is ``cluster_col``, by default
    the text's hash: members of one cluster never share a bin, nor do documents of one source.  A null source or
    cluster conflicts with none.  Null and empty texts have no words and one piece of size 0, which may join a
    full bin but still keeps its conflicts.  Ids come back as they are, of any type and null among others.
    Repeated rows are separate pieces with one cluster.  Ties in size go by id (null first), then piece and
    cluster; bins with equal room by age.  Other columns are not read.  An empty table gives an empty result.
    """
    n_words = word_count(text_col) if words_col is None else F.coalesce(words_col, F.lit(0)).cast("int")
    cluster = F.xxhash64(F.coalesce(text_col, F.lit(""))) if cluster_col is None else F.col(cluster_col).cast("string")
    rows = docs.select(F.col(id_col).alias("doc_id"), cluster.alias("cluster"), F.col(source_col).cast("string").alias("source"), n_words.alias("words"))
    last = F.floor(F.greatest(F.col("words") - 1, F.lit(0)) / capacity).cast("int")
    pieces = rows.select("doc_id", "cluster", "source", "words", F.explode(F.sequence(F.lit(0), last)).alias("piece"))
    size = F.least(F.lit(capacity), F.col("words") - F.col("piece") * capacity).cast("int")
    pieces = stored(pieces.select("doc_id", "cluster", "source", "piece", size.alias("n_words")))
    shards = max(1, -(-pieces.count() // shard))
    kind = docs.schema[id_col].dataType.simpleString()
    # the cluster is part of the key, so that rows without an id are dealt out too
    dealt = pieces.withColumn("shard", F.pmod(F.xxhash64(F.lit("shard"), "doc_id", "piece", "cluster"), F.lit(shards)).cast("int"))

    def work(key: tuple, group: pa.Table) -> pa.Table:
        ids, piece, sizes, sources, clusters = (group.column(c).to_pylist() for c in _READ)
        order = sorted(range(len(ids)), key=lambda i: (-sizes[i], ids[i] is not None, ids[i], piece[i], clusters[i] is not None, clusters[i]))
        place = best_fit([sizes[i] for i in order], [sources[i] for i in order], [clusters[i] for i in order], capacity)
        rows = group.select(_READ[:3]).take(pa.array(order, pa.int64()))
        shard_no = key[0].as_py()
        return rows.append_column("bin", pa.array([f"{shard_no}-{b}" for b, _ in place], pa.string())).append_column("bin_at", pa.array([a for _, a in place], pa.int32()))

    return dealt.groupBy("shard").applyInArrow(work, _PACKED.format(id=kind))
