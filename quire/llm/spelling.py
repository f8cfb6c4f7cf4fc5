"""Words one edit apart, by a self-join of the vocabulary's trie with sets of active nodes.

A node of the trie is a prefix; active for a node are the nodes at most one insertion, deletion or replacement from
it, with that distance.  Sets go down the trie: at distance zero a node is active for itself, and its
children give pairs at distance one (two children of one node; a node and its child); a pair at
distance one goes on with equal characters only.  Where both nodes of a pair end a word, the words are near.

The trie is cut by prefixes so that a subtree below a cut holds at most ``SUBTREE`` words, however many words
begin alike, and each subtree is one task's work, level by level in numpy.  Above the cut a pair at distance one must
have equal remainders, so there its words meet by grouping on the rest: such a group holds words that differ in one
character at one place, as many as there are characters at most.  Each near pair is found at the
first character in which the words differ, so once: above the cut or below it.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quire.llm.common import byte_texts, release, stored

#: Characters, and occurrences over all documents, that a word of the vocabulary has at least.
SHORTEST, LEAST = 5, 3
#: Words below one cut of the trie at most, and the first depth of a cut.
SUBTREE, FIRST_DEPTH = 20_000, 2
#: Words that a task takes into one trie.
TOGETHER = 40_000
#: Counts that a task holds before it passes them on.
HELD = 500_000
_RUNS = regex.compile("[a-zÀ-ÿ]+")


def _damaged(doc_id: int | None, counts: Counter, rate: int) -> Iterator[tuple[str, int]]:
    """The words of one document, of which one in ``rate`` loses a character; which ones follows from id and word."""
    start = zlib.crc32(f"{doc_id}:".encode())
    for word, n in counts.items():
        h = zlib.crc32(word.encode(), start)
        if h % rate == 0:
            at = h % len(word)
            word = word[:at] + word[at + 1 :]
        yield word, n


def word_counts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", damage: int | None = None) -> DataFrame:
    """``(word, n)``: maximal runs of the letters A-Z (in lower case), a-z and U+00C0 to U+00FF, with their occurrences.

    Tasks add up what they read before anything is shuffled.  ``damage`` takes a character from the words of a document
    whose hash it divides, to plant misspellings.  Null and empty texts have no words; a null id is an id like any
    other, without a number; repeated rows count again; an empty table gives an empty result.
    """

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter = Counter()

        def out() -> pa.RecordBatch:
            batch = pa.RecordBatch.from_arrays([pa.array(list(held), pa.string()), pa.array(list(held.values()), pa.int64())], names=["word", "n"])
            held.clear()
            return batch

        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), byte_texts(batch.column(1)), strict=True):
                own = Counter(_RUNS.findall(text.lower().decode()))  # of bytes: only A-Z change
                if damage is None:
                    held.update(own)
                else:
                    for word, n in _damaged("" if doc_id is None else doc_id, own, damage):
                        held[word] += n
                if len(held) > HELD:
                    yield out()
        if held:
            yield out()

    return docs.select(id_col, text_col).mapInArrow(work, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))


class Trie:
    """The trie of some sorted words, each with the depth of its cut: nodes by level, with numbers over all levels."""

    def __init__(self, words: list[str], cuts: np.ndarray):
        size = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
        flat = np.frombuffer("".join(words).encode("utf-32-le"), dtype="<u4").astype(np.int64)
        begin = np.concatenate([[0], np.cumsum(size)])
        self.depth = int(size.max(initial=0))
        node, alive, made = np.zeros(len(words), dtype=np.int64), np.arange(len(words)), 1
        #: By node: the word that ends there, and whether its own children may make pairs.
        word, open_ = [np.full(1, -1)], [np.array([bool(len(cuts)) and cuts.min() == 0])]
        parents, chars = [], []
        for d in range(self.depth):
            alive = alive[size[alive] > d]
            char = flat[begin[alive] + d]
            new = np.ones(len(alive), dtype=bool)
            new[1:] = (char[1:] != char[:-1]) | (node[alive][1:] != node[alive][:-1])
            parents.append(node[alive][new])
            chars.append(char[new])
            open_.append(d + 1 >= cuts[alive][new])
            node[alive] = made + np.cumsum(new) - 1
            ends = np.full(int(new.sum()), -1)
            last = size[alive] == d + 1
            ends[node[alive][last] - made] = alive[last]
            word.append(ends)
            made += int(new.sum())
        self.word, self.open = np.concatenate(word), np.concatenate(open_)
        parent, char = (np.concatenate([*x, np.zeros(0, dtype=np.int64)]) for x in (parents, chars))
        #: Nodes but the root in order of parent and character.
        self.key = parent << 21 | char
        self.first = np.searchsorted(parent, np.arange(made + 1))
        self.char = char

    def children(self, nodes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For all children of ``nodes``: the place in ``nodes``, and the child."""
        count = self.first[nodes + 1] - self.first[nodes]
        place = np.repeat(np.arange(len(nodes)), count)
        turn = np.arange(len(place)) - np.repeat(np.cumsum(count) - count, count)
        return place, self.first[nodes][place] + turn + 1

    def child(self, nodes: np.ndarray, chars: np.ndarray) -> np.ndarray:
        """The child of each node by a character, or -1."""
        want = nodes << 21 | chars
        at = np.minimum(np.searchsorted(self.key, want), len(self.key) - 1)
        return np.where(self.key[at] == want, at + 1, -1)

    def near(self) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Pairs of words at distance one, as places in the list of words, level by level."""
        level = np.zeros(1, dtype=np.int64)
        same = [np.zeros(0, dtype=np.int64)] * 2
        longer = same
        while len(level):
            # pairs of equal depth: two children of one node, and pairs of the level above that go on alike
            place, below = self.children(level)
            free = self.open[level][place]
            p, q = self._siblings(place[free], below[free])
            same = self._onward(*same)
            same = [np.concatenate([same[0], p]), np.concatenate([same[1], q])]
            # a node and one that is a character longer: first a child of its own, then alike but for the child's character itself
            longer = self._onward(*longer)
            shorter, child = level[place[free]], below[free]
            yield self._words(shorter, child)
            spot, step = self.children(shorter)
            other = self.char[step - 1] != self.char[child[spot] - 1]
            further = self.child(child[spot][other], self.char[step[other] - 1])
            fits = further >= 0
            longer = [np.concatenate([longer[0], step[other][fits]]), np.concatenate([longer[1], further[fits]])]
            yield self._words(*same)
            yield self._words(*longer)
            level = below

    def _siblings(self, parent: np.ndarray, node: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """All pairs of two children of one parent, the earlier first."""
        last = np.searchsorted(parent, parent, side="right")
        count = last - np.arange(len(parent)) - 1
        left = np.repeat(np.arange(len(parent)), count)
        turn = np.arange(len(left)) - np.repeat(np.cumsum(count) - count, count)
        return node[left], node[left + 1 + turn]

    def _onward(self, a: np.ndarray, b: np.ndarray) -> list[np.ndarray]:
        spot, step = self.children(a)
        further = self.child(b[spot], self.char[step - 1]) if len(step) else step
        return [step[further >= 0], further[further >= 0]]

    def _words(self, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        a, b = self.word[a], self.word[b]
        both = (a >= 0) & (b >= 0)
        return a[both], b[both]


def _best(words: list[str], n: np.ndarray, cuts: np.ndarray) -> Iterator[tuple[str, int, str, int]]:
    """``(word, near words, best near word, its n)`` from the subtrees that hold ``words``."""
    pairs = [np.column_stack(p) for p in Trie(words, cuts).near()]
    pairs = np.concatenate([np.zeros((0, 2), dtype=np.int64), *pairs])
    a, b = np.concatenate([pairs[:, 0], pairs[:, 1]]), np.concatenate([pairs[:, 1], pairs[:, 0]])
    turn = np.lexsort((b, -n[b], a))  # words are sorted, so places are in their order
    a, b = a[turn], b[turn]
    first = np.flatnonzero(np.concatenate([[True], a[1:] != a[:-1]])) if len(a) else a
    count = np.diff(np.append(first, len(a)))
    for w, c, v in zip(a[first].tolist(), count.tolist(), b[first].tolist(), strict=True):
        yield words[w], c, words[v], int(n[v])


def _below(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Walks the subtrees of a sorted partition, whole subtrees at a time."""
    held: list[tuple[str, int, int]] = []

    def out(rows: list[tuple[str, int, int]]) -> pa.RecordBatch:
        found = list(_best([r[0] for r in rows], np.array([r[1] for r in rows], dtype=np.int64), np.array([r[2] for r in rows], dtype=np.int64)))
        columns = list(zip(*found, strict=True)) or [()] * 4
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (pa.string(), pa.int64(), pa.string(), pa.int64()), strict=True)], names=["word", "near", "best", "best_n"])

    for batch in batches:
        for row in zip(*(batch.column(k).to_pylist() for k in range(3)), strict=True):
            if len(held) >= TOGETHER and row[0][: row[2]] != held[-1][0][: held[-1][2]]:
                yield out(held)
                held = []
            held.append(row)
    if held:
        yield out(held)


def _cut(vocabulary: DataFrame, most: int) -> DataFrame:
    """``vocabulary (word, n)`` with the depth ``cut`` at which each word's subtree holds ``most`` words or less.

    Depths double, and each round looks only at the prefixes that are still too full.
    """
    depth, left, done = FIRST_DEPTH, vocabulary, None
    while True:
        prefix = F.substring("word", 1, depth)
        counts = left.groupBy(prefix.alias("prefix")).agg(F.count("*").alias("of"), F.max(F.length("word")).alias("longest"))
        # a prefix as long as its longest word has one word below it
        full = stored(counts.where((F.col("of") > most) & (F.col("longest") > depth)).select("prefix"))
        here = left.withColumn("cut", F.lit(depth))
        if full.isEmpty():
            return here if done is None else done.union(here)
        part = here.join(full, prefix == full.prefix, "left_anti")
        done = part if done is None else done.union(part)
        left = stored(left.join(full, prefix == full.prefix, "left_semi"))
        depth *= 2


def _above(cut: DataFrame) -> DataFrame:
    """Partial results ``(word, near, best, best_n)`` of pairs that first differ above a word's cut."""
    place = lambda last: F.explode(F.sequence(F.lit(1), F.least(F.col("cut"), last))).alias("at")
    here = cut.select("word", "n", place(F.length("word")))
    head, char, rest = F.substring("word", 1, F.col("at") - 1), F.substring("word", F.col("at"), F.lit(1)), F.expr("substring(word, at + 1)")
    item = F.struct((-F.col("n")).alias("order"), "word", "n").alias("item")
    without = here.select("at", F.concat(head, rest).alias("rest"), (char != F.substring(rest, 1, 1)).alias("last"), item)
    # replaced: all words of a group are near each other
    alike = without.groupBy("at", "rest").agg(F.sort_array(F.collect_list("item")).alias("items")).where(F.size("items") > 1)
    replaced = alike.select("items", F.explode("items").alias("own")).select(
        "own.word", (F.size("items") - 1).cast("long").alias("near"), F.when(F.col("items")[0]["word"] == F.col("own.word"), F.col("items")[1]).otherwise(F.col("items")[0]).alias("other")
    )
    # inserted: the word that equals a rest, and those it is the rest of, at the last of equal characters
    longer = without.where("last").groupBy("at", "rest").agg(F.sort_array(F.collect_list("item")).alias("items"))
    whole = cut.select(place(F.length("word") + 1), F.col("word").alias("rest"), F.struct((-F.col("n")).alias("order"), "word", "n").alias("one"))
    met = longer.join(whole, ["at", "rest"])
    grown = met.select("one.word", F.size("items").cast("long").alias("near"), F.col("items")[0].alias("other"))
    shrunk = met.select("one", F.explode("items").alias("own")).select("own.word", F.lit(1).cast("long").alias("near"), F.col("one").alias("other"))
    return replaced.union(grown).union(shrunk).select("word", "near", F.col("other.word").alias("best"), F.col("other.n").alias("best_n"))


def near_words(vocabulary: DataFrame, subtree: int = SUBTREE) -> DataFrame:
    """``(word, n_near, best, best_n)`` for the words of ``vocabulary (word, n)`` that have others at distance one.

    Distance one is one inserted, deleted or replaced code point.  ``best`` is the near word of largest n, the smallest
    in code-point order of equal ones.  Words are distinct and not null.  An empty vocabulary gives an empty result.
    """
    cut = _cut(vocabulary, subtree)
    prefix = F.expr("substring(word, 1, cut)")
    below = cut.select("word", "n", "cut").repartition(prefix).sortWithinPartitions("word").mapInArrow(_below, "word string, near long, best string, best_n long")
    least = F.min(F.struct((-F.col("best_n")).alias("order"), "best", "best_n")).alias("top")
    return below.union(_above(cut)).groupBy("word").agg(F.sum("near").alias("n_near"), least).select("word", "n_near", "top.best", "top.best_n")


def with_roots(forms: DataFrame) -> DataFrame:
    """``forms (word, form, ...)`` with ``root``, the end of a word's chain of forms; the word itself where form is null.

    Chains halve in each round (every word takes its root's root), and each round is stored.
    """
    steps = stored(forms.where("form is not null").select("word", F.col("form").alias("root")))
    while True:
        onward = steps.select(F.col("word").alias("by"), F.col("root").alias("next"))
        met = stored(steps.join(onward, steps.root == onward.by, "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")))
        release(steps)
        steps = met
        if not steps.where("moved").limit(1).count():
            break
    ends = steps.select(F.col("word").alias("of"), F.col("root").alias("end"))
    return forms.join(ends, forms.word == ends.of, "left").withColumn("root", F.coalesce("end", "word")).drop("of", "end")


def variants(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", damage: int | None = None, shortest: int = SHORTEST, least: int = LEAST, subtree: int = SUBTREE) -> DataFrame:
    """``(word, n, form, root, n_near, form_n)`` for each word of the documents with ``shortest`` characters and ``least`` occurrences.

    A word's form is its near word (one character inserted, deleted or replaced) of largest n, ties by code points, if
    that n is twice the word's own at least; its root is where forms lead.  Null and empty texts have no words, a null id
    only matters to ``damage``, repeated rows count again, a very long text or word is taken whole, other columns are not
    read, whatever their names, and an empty table gives an empty result.
    """
    vocabulary = stored(word_counts(docs, id_col, text_col, damage).where((F.length("word") >= shortest) & (F.col("n") >= least)))
    near = near_words(vocabulary, subtree).withColumnRenamed("word", "of")
    good = F.col("best_n") >= 2 * F.col("n")
    joined = stored(
        vocabulary.join(near, vocabulary.word == near.of, "left").select("word", "n", F.when(good, F.col("best")).alias("form"), F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), F.when(good, F.col("best_n")).alias("form_n"))
    )
    return with_roots(joined).select("word", "n", "form", "root", "n_near", "form_n")
