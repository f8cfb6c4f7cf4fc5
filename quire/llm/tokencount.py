"""Token counts that follow edits: a segment tree over each document's pre-tokens.

A byte-level BPE encodes each pre-token by itself, so a document's count is a sum over pre-tokens.
Leaves of the tree hold runs of about ``LEAF`` pre-tokens (characters and tokens of each); inner nodes hold sums.
An edit re-encodes only the pre-tokens that it touches and some context: scanning starts
at the last old boundary at least ``REACH`` characters before the edit, because no pre-token depends on
more than that many characters after it, and ends at the first new boundary past the edit that is also an
old one, because scanning looks at nothing before its own start.

Trees are kept: ``token_trees`` makes a table of them, a row per document with packed arrays for leaves and nodes, and
``apply_edits`` takes such a table, changes the trees where edits fall and gives a table of the same form, to be
stored in its place.  Nothing is encoded there but the regions that the edits touch.
"""

from __future__ import annotations

import base64
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quire.llm.common import stored

LEAF = 64
#: The longest look ahead of the pattern: a quote mark may turn into ``'re`` with the two letters after it.
REACH = 2
KEPT_PIECES = 200_000
#: Bytes of text whose trees are built or edited together.
PART_BYTES = 1 << 20


class PieceCounter(dict):
    """Tokens of each pre-token, encoded once by tiktoken."""

    def __init__(self, pattern: str, ranks: str):
        super().__init__()
        import tiktoken

        parts = (line.split() for line in ranks.splitlines() if line.strip())
        self.coder = tiktoken.Encoding("pieces", pat_str=pattern, mergeable_ranks={base64.b64decode(a): int(b) for a, b in parts}, special_tokens={})
        self.pattern = regex.compile(pattern)

    def __missing__(self, piece: str) -> int:
        n = len(self.coder.encode_ordinary(piece))
        if len(self) >= KEPT_PIECES:
            self.clear()
        self[piece] = n
        return n


_counters: dict[int, PieceCounter] = {}


def counter(pattern: str, ranks: str) -> PieceCounter:
    """The worker's counter for a vocabulary's contents."""
    key = hash((pattern, ranks))
    if key not in _counters:
        _counters.clear()
        _counters[key] = PieceCounter(pattern, ranks)
    return _counters[key]


class TokenTree:
    """A document's text with its pre-tokens' lengths and counts, in leaves under a tree of sums."""

    def __init__(self, text: str, pieces: PieceCounter):
        self.text, self.counter = text, pieces
        found = pieces.pattern.findall(text)
        self._build(list(map(len, found)), [pieces[p] for p in found])

    @classmethod
    def kept(cls, text: str, pieces: PieceCounter, arrays: Iterable[bytes]) -> TokenTree:
        """A tree from the arrays that ``arrays`` gave; nothing is encoded."""
        self = cls.__new__(cls)
        self.text, self.counter = text, pieces
        lengths, sizes, counts, self.chars, self.tokens = (np.frombuffer(a, dtype="<i4").tolist() for a in arrays)
        self.width = len(self.chars) // 2
        self.leaves, at = [], 0
        for n in lengths:
            self.leaves.append((sizes[at : at + n], counts[at : at + n]))
            at += n
        return self

    def arrays(self) -> list[bytes]:
        """What a table keeps of the tree, in the order of ``ARRAYS``."""
        lists = ([len(size) for size, _ in self.leaves], [s for size, _ in self.leaves for s in size], [c for _, count in self.leaves for c in count], self.chars, self.tokens)
        return [np.array(x, dtype="<i4").tobytes() for x in lists]

    def _build(self, sizes: list[int], counts: list[int]) -> None:
        self.leaves = [(sizes[k : k + LEAF], counts[k : k + LEAF]) for k in range(0, len(sizes), LEAF)] or [([], [])]
        self.width = 1 << (len(self.leaves) - 1).bit_length()
        self.chars, self.tokens = [0] * (2 * self.width), [0] * (2 * self.width)
        for k, (size, count) in enumerate(self.leaves):
            self.chars[self.width + k], self.tokens[self.width + k] = sum(size), sum(count)
        for k in range(self.width - 1, 0, -1):
            self._sum(k)

    def _sum(self, node: int) -> None:
        self.chars[node] = self.chars[2 * node] + self.chars[2 * node + 1]
        self.tokens[node] = self.tokens[2 * node] + self.tokens[2 * node + 1]

    @property
    def total(self) -> int:
        return self.tokens[1]

    def _leaf(self, at: int) -> tuple[int, int]:
        """The leaf that holds character ``at`` (the last leaf if none does) and the characters before it."""
        node, before = 1, 0
        while node < self.width:
            node *= 2
            if at >= before + self.chars[node] and node + 1 < 2 * self.width and self.chars[node + 1]:
                before += self.chars[node]
                node += 1
        return node - self.width, before

    def edit(self, start: int, stop: int, new: str) -> int:
        """Replaces the characters ``start:stop``; returns how many pre-tokens were encoded again."""
        start = min(max(0, start), len(self.text))
        stop = min(max(start, stop), len(self.text))
        shift = len(new) - (stop - start)
        first, before = self._leaf(max(0, start - REACH))
        sizes, counts = self.leaves[first]
        head, at = 0, before
        while head < len(sizes) and at + sizes[head] <= start - REACH:
            at += sizes[head]
            head += 1
        self.text = self.text[:start] + new + self.text[stop:]
        # old boundaries from the edit's end on, leaf by leaf, until one is a new boundary too
        leaf, place, old = first, head, at
        fresh_sizes, fresh_counts, here = [], [], at
        while here < len(self.text):
            while old < stop or old + shift < here:
                while leaf < len(self.leaves) and place == len(self.leaves[leaf][0]):
                    leaf, place = leaf + 1, 0
                if leaf == len(self.leaves):
                    break
                old += self.leaves[leaf][0][place]
                place += 1
            if old >= stop and old + shift == here and fresh_sizes:
                break
            piece = self.counter.pattern.match(self.text, here)[0]
            fresh_sizes.append(len(piece))
            fresh_counts.append(self.counter[piece])
            here += len(piece)
        else:
            leaf, place = len(self.leaves), 0
        last = min(leaf, len(self.leaves) - 1)
        tail = self.leaves[last] if leaf < len(self.leaves) else ([], [])
        self.leaves[first] = (sizes[:head] + fresh_sizes + tail[0][place:], counts[:head] + fresh_counts + tail[1][place:])
        for k in range(first + 1, last + 1):
            self.leaves[k] = ([], [])
        if len(self.leaves[first][0]) > 4 * LEAF:
            self._build([s for size, _ in self.leaves for s in size], [c for _, count in self.leaves for c in count])
        else:
            self._update(first, last)
        return len(fresh_sizes)

    def _update(self, first: int, last: int) -> None:
        for k in range(first, last + 1):
            size, count = self.leaves[k]
            self.chars[self.width + k], self.tokens[self.width + k] = sum(size), sum(count)
        low, high = (self.width + first) // 2, (self.width + last) // 2
        while low:
            for node in range(low, high + 1):
                self._sum(node)
            low, high = low // 2, high // 2


EDITS = T.ArrayType(T.StructType([T.StructField("start", T.IntegerType()), T.StructField("stop", T.IntegerType()), T.StructField("new", T.StringType())]))
#: Columns of a tree, 32-bit little-endian integers each: pre-tokens of each leaf, characters and tokens of each pre-token, and of each node; ``total`` is the root's sum.
ARRAYS = ["leaf_pieces", "piece_chars", "piece_tokens", "node_chars", "node_tokens"]
_TREE = [*(T.StructField(n, T.BinaryType()) for n in ARRAYS), T.StructField("total", T.LongType())]
_COUNTS = ["n_tokens", "n_pieces", "n_edits", "n_tokens_after", "n_encoded_again"]


def _broadcast(df: DataFrame, vocabulary_path: str):
    with open(vocabulary_path, encoding="ascii") as f:
        return df.sparkSession.sparkContext.broadcast(f.read())


def _columns(trees: list[TokenTree]) -> list[pa.Array]:
    return [*(pa.array(c, pa.binary()) for c in zip(*(t.arrays() for t in trees), strict=True)), pa.array([t.total for t in trees], pa.int64())]


def _parts(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """Slices of a batch with about a megabyte of text each: the trees of a slice are all that is in memory."""
    sizes = pc.fill_null(pc.binary_length(batch.column("text").cast(pa.binary())), 0).to_numpy(zero_copy_only=False)
    lo = held = 0
    for k, size in enumerate(sizes):
        if held and held + size > PART_BYTES:
            yield batch.slice(lo, k - lo)
            lo, held = k, 0
        held += int(size) + 1
    if batch.num_rows:
        yield batch.slice(lo)


def token_trees(docs: DataFrame, vocabulary_path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text", keep: list[str] | None = None) -> DataFrame:
    """``(id, text, *keep, leaf_pieces, piece_chars, piece_tokens, node_chars, node_tokens, total)``: the tree of each row, to be stored.

    A null or empty text has a tree with one empty leaf; a very long one has a longer list; repeated rows have equal trees.
    """
    ranks, keep = _broadcast(docs, vocabulary_path), keep or []

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            pieces = counter(pattern, ranks.value)
            for part in _parts(batch):
                trees = [TokenTree(t or "", pieces) for t in part.column("text").to_pylist()]
                yield pa.RecordBatch.from_arrays([*part.columns, *_columns(trees)], names=["id", "text", *keep, *ARRAYS, "total"])

    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), *keep)
    return rows.mapInArrow(work, T.StructType([*rows.schema.fields, *_TREE]))


def apply_edits(trees: DataFrame, vocabulary_path: str, pattern: str, edits_col: str = "edits") -> DataFrame:
    """Trees after their edits: ``(id, text, n_tokens, n_pieces, n_edits, n_tokens_after, n_encoded_again, leaf_pieces, ...)``.

    ``edits_col`` is an array of (start, stop, new) in characters of the text as the edits before left it;
    places outside the text are moved to its ends, and a null edit, list or text counts as none or empty.  Repeated rows
    are edited each by itself, null ids stay null, a very long text is one tree, and an empty table gives an empty result.
    """
    ranks = _broadcast(trees, vocabulary_path)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (part for whole in batches for part in _parts(whole)):
            pieces, made, counts = counter(pattern, ranks.value), [], []
            for text, edits, *arrays in zip(*(batch.column(n).to_pylist() for n in ("text", "edits", *ARRAYS)), strict=True):
                tree = TokenTree.kept(text or "", pieces, arrays)
                before, size, again, done = tree.total, sum(len(s) for s, _ in tree.leaves), 0, 0
                for e in edits or []:
                    if e is not None:
                        again += tree.edit(e["start"] or 0, e["stop"] or 0, e["new"] or "")
                        done += 1
                made.append(tree)
                counts.append((before, size, done, tree.total, again))
            columns = np.array(counts, dtype=np.int64).reshape(-1, 5).T
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array([t.text for t in made], pa.string()), *(pa.array(c) for c in columns), *_columns(made)], names=["id", "text", *_COUNTS, *ARRAYS, "total"])

    rows = trees.select("id", "text", F.col(edits_col).cast(EDITS).alias("edits"), *ARRAYS)
    return rows.mapInArrow(work, T.StructType([rows.schema["id"], T.StructField("text", T.StringType()), *(T.StructField(n, T.LongType()) for n in _COUNTS), *_TREE]))


def edited_counts(docs: DataFrame, vocabulary_path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text", edits_col: str = "edits") -> DataFrame:
    """``(id_col, n_tokens, n_pieces, n_edits, n_tokens_after, n_encoded_again)`` of each row.

    Trees are stored, read back, edited and stored again; the count after the edits is read from the root of
    the tree in the second table.  Edits are as in ``apply_edits``.  A null or empty text has no tokens; very long
    texts are edited as they are; rows are independent, so repeated rows give repeated results and a null id
    stays null.  Other columns are not read.  An empty table gives an empty result.
    """
    rows = docs.select(F.col(id_col).alias("doc"), F.col(text_col).alias("body"), F.col(edits_col).alias("edits"))
    before = stored(token_trees(rows, vocabulary_path, pattern, "doc", "body", keep=["edits"]), "zstd")
    after = stored(apply_edits(before, vocabulary_path, pattern).drop("text", "n_tokens_after"), "zstd")
    return after.select(F.col("id").alias(id_col), "n_tokens", "n_pieces", "n_edits", F.col("total").alias("n_tokens_after"), "n_encoded_again")


def with_sample_edits(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with three edits per row at places that follow from its id: a replacement, a deletion and an insertion."""
    size = F.coalesce(F.length(text_col), F.lit(0))
    place = lambda k: F.pmod(F.xxhash64(F.lit(k), F.col(id_col)), F.greatest(size, F.lit(1)).cast("long")).cast("int")
    edit = lambda at, length, new: F.struct(at.alias("start"), (at + length).alias("stop"), F.lit(new).alias("new"))
    return docs.withColumn("edits", F.array(edit(place(1), 12, "revised wording"), edit(place(2), 30, ""), edit(place(3), 0, " it's a new remark, ")))
