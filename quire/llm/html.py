"""Main text of web pages by a recurrent block labeller.

A page is cut into leaf blocks: runs of text between block-level tags.  Each block becomes a vector of
its hashed tag path (tags, classes and ids of the elements around it), its innermost element, all its hashed
words, and a few measures, among them how many elements end and begin between it and the block before.
A bidirectional LSTM, written in numpy, reads the page's blocks in order in both directions and labels each
one as main text or not, so a block is judged with the whole page in view.

There are no labelled pages to learn from.  ``html_training`` trains the model on made-up pages whose layouts name
their parts in many ways or not at all; the weights that it found are kept in ``html_weights.npz`` beside it.

Cutting a page takes time and memory in proportion to its length, however deep its elements are nested.
"""

from __future__ import annotations

import html as entities
import re
import zlib
from array import array
from bisect import bisect_left
from collections.abc import Iterator
from functools import cache
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

PATH_SIZE, OWN_SIZE, WORD_SIZE, EXTRA = 96, 24, 64, 12
SIZE = PATH_SIZE + OWN_SIZE + WORD_SIZE + EXTRA
HIDDEN = 28
#: Pages labelled together, at most, and the blocks that they have when padded to the longest (a longer page goes alone).
#: Pages of like length go together.
TOGETHER, MOST_BLOCKS = 64, 1 << 14
WEIGHTS = Path(__file__).with_name("html_weights.npz")

#: Comments, tags, declarations.  A quote that nothing closes is a character like any other, so a tag always ends, and what is read once is not read again.
_TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<(/?)([a-zA-Z][^\s/>]*+)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+'|[\"'])*+)(?:>|\Z)|<[!?][^>]*+(?:>|\Z)", re.DOTALL)
_NAMES = re.compile(r"""\b(class|id|role)\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+)""", re.IGNORECASE)
_RAW = {"script", "style", "template", "noscript", "textarea", "svg", "iframe", "select"}
#: Of these, the ones that may stand inside each other.
_NESTED = {"template", "svg", "select"}
_INLINE = {"a", "abbr", "acronym", "b", "bdi", "bdo", "big", "br", "cite", "code", "data", "del", "dfn", "em", "font", "i", "img", "ins", "kbd", "label", "mark", "q", "s", "samp", "small", "span", "strike", "strong", "sub", "sup", "time", "tt", "u", "var", "wbr"}
_VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
_CLOSES_P = {"p", "div", "ul", "ol", "dl", "li", "dt", "dd", "table", "h1", "h2", "h3", "h4", "h5", "h6", "article", "section", "aside", "nav", "header", "footer", "form", "blockquote", "pre", "main", "figure", "hr"}
_SPACES = re.compile(r"\s+")
_NAME_WORDS = re.compile(r"[a-z]+")


class Slots(dict):
    """Place and sign of a hashed word among ``size``: twice the place, and one more for minus.  Kept, as words come again."""

    def __init__(self, size: int):
        super().__init__()
        self.size = size

    def __missing__(self, word: str) -> int:
        h = zlib.crc32(word.encode("utf-8", "surrogatepass"))
        if len(self) > 200_000:
            self.clear()
        out = self[word] = h % self.size * 2 + (h >> 16 & 1)
        return out


_path_slots, _own_slots, _word_slots = Slots(PATH_SIZE), Slots(OWN_SIZE), Slots(WORD_SIZE)


class Block:
    """Text between block-level tags; ``path`` has the sums of the hashed names of all elements around it."""

    __slots__ = ("path", "own", "depth", "closed", "opened", "text", "linked")

    def __init__(self, path: array, own: tuple[str, ...], depth: int, closed: int, opened: int, text: str, linked: int):
        self.path, self.own, self.depth, self.closed, self.opened, self.text, self.linked = path, own, depth, closed, opened, text, linked


class Elements:
    """The open elements of a page, with the sums of their hashed names and the places of each tag among them."""

    def __init__(self):
        self.stack: list[tuple[str, tuple[str, ...]]] = []
        self.sums = array("i", [0] * PATH_SIZE)
        self.places: dict[str, list[int]] = {}
        self.outer: list[int] = []  # places of block-level elements

    def _add(self, names: tuple[str, ...], times: int) -> None:
        for name in names:
            code = _path_slots[name]
            self.sums[code >> 1] += -times if code & 1 else times

    def push(self, tag: str, names: tuple[str, ...]) -> None:
        self.places.setdefault(tag, []).append(len(self.stack))
        if tag not in _INLINE:
            self.outer.append(len(self.stack))
        self.stack.append((tag, names))
        self._add(names, 1)

    def pop(self) -> None:
        tag, names = self.stack.pop()
        self.places[tag].pop()
        if tag not in _INLINE:
            self.outer.pop()
        self._add(names, -1)

    def last(self, tag: str) -> int:
        """Place of the innermost ``tag``, -1 if none is open."""
        found = self.places.get(tag)
        return found[-1] if found else -1

    def top(self) -> str:
        return self.stack[-1][0] if self.stack else ""


class Ends:
    """Where elements without text end, from one scan of the page for each tag that is asked for."""

    def __init__(self, page: str):
        self.page = page
        self.known: dict[str, tuple[list[int], list[int], dict[int, int]]] = {}

    def _scan(self, tag: str) -> tuple[list[int], list[int], dict[int, int]]:
        """Begins and ends of all end tags, and the end of the one that closes a start tag, by the place behind that."""
        if tag not in self.known:
            begins, ends, pairs, open_ = [], [], {}, []
            for found in re.finditer(rf"<(/?){re.escape(tag)}(?=[\s/>])[^>]*+>", self.page, re.IGNORECASE):
                if found[1]:
                    begins.append(found.start())
                    ends.append(found.end())
                    if open_:
                        pairs[open_.pop()] = found.end()
                elif found[0][-2] != "/":
                    open_.append(found.end())
            self.known[tag] = begins, ends, pairs
        return self.known[tag]

    def after(self, tag: str, at: int, parent: str) -> int:
        """Where to go on behind an element whose start tag ends at ``at``: its own end, else the next end of its parent, else right there."""
        begins, ends, pairs = self._scan(tag)
        if tag in _NESTED and at in pairs:
            return pairs[at]
        if tag not in _NESTED and (k := bisect_left(begins, at)) < len(begins):
            return ends[k]
        begins = self._scan(parent)[0] if parent else []
        return begins[k] if (k := bisect_left(begins, at)) < len(begins) else at


def blocks(page: str) -> list[Block]:
    """Leaf blocks in page order, their white space made single; scripts, styles, comments and other markup are not text."""
    out: list[Block] = []
    opened, closing = Elements(), Ends(page)
    held: list[str] = []
    anchors: list[str] = []
    links = begun = ended = 0
    at, size = 0, len(page)

    def flush() -> None:
        nonlocal begun, ended
        if held:
            text = _SPACES.sub(" ", entities.unescape("".join(held))).strip()
            if text:
                own = opened.stack[opened.outer[-1]][1] if opened.outer else ()
                out.append(Block(opened.sums[:], own, len(opened.stack), ended, begun, text, sum(map(len, anchors))))
                begun = ended = 0
            held.clear()
            anchors.clear()

    while at < size:
        found = _TOKEN.search(page, at)
        begin = found.start() if found else size
        if begin > at:
            held.append(page[at:begin])
            if links:
                anchors.append(page[at:begin])
        if not found:
            break
        at = found.end()
        if found[2] is None:
            continue
        tag = found[2].lower()
        if found[1]:
            if tag == "a":
                links = 0
            place = opened.last(tag)
            if tag in _INLINE:
                if place > (opened.outer[-1] if opened.outer else -1):
                    while len(opened.stack) > place:
                        opened.pop()
            elif place >= 0:
                flush()
                while len(opened.stack) > place:
                    ended += opened.top() not in _INLINE
                    opened.pop()
            continue
        if tag in _RAW:
            if not (tag == "svg" and found[3].rstrip().endswith("/")):
                at = closing.after(tag, at, opened.top())
            continue
        if tag not in _INLINE:
            flush()
            links = 0
            while opened.stack and ((top := opened.top()) in _INLINE or (top == "p" and tag in _CLOSES_P) or (top == tag and tag in ("li", "dt", "dd", "option", "tr", "td", "th"))):
                ended += top not in _INLINE
                opened.pop()
        elif tag == "a":
            links = 1
        elif tag == "br":
            held.append(" ")
        if tag not in _VOID and not found[3].rstrip().endswith("/"):
            names = [tag]
            for _, value in _NAMES.findall(found[3]):
                names += _NAME_WORDS.findall(value.lower())
            opened.push(tag, tuple(names))
            begun += tag not in _INLINE
    flush()
    return out


def vectors(page: list[Block]) -> np.ndarray:
    """One row for each block: path, innermost element, words, measures."""
    out = np.zeros((len(page), SIZE), dtype=np.float32)
    for k, block in enumerate(page):
        row = out[k]
        row[:PATH_SIZE] = block.path
        for name in block.own:
            code = _own_slots[name]
            row[PATH_SIZE + (code >> 1)] += -1.0 if code & 1 else 1.0
        codes = np.fromiter(map(_word_slots.__getitem__, block.text.lower().split(" ")), dtype=np.int64)
        uses = np.bincount(codes, minlength=2 * WORD_SIZE).reshape(-1, 2)
        row[PATH_SIZE + OWN_SIZE : -EXTRA] = 4 * (uses[:, 0] - uses[:, 1]) / np.sqrt(len(codes) * max(8, len(codes)))
        size = len(block.text)
        digits = sum(map(block.text.count, "0123456789"))
        row[-EXTRA:] = (
            np.log1p(size) / 4, min(1.0, block.linked / size), min(block.depth, 30) / 10, k / len(page), 1 / len(page), block.text[-1] in ".!?:;\"'", "©" in block.text,
            np.log1p(min(block.closed, 50)), np.log1p(min(block.opened, 50)), digits / size, np.log1p(len(codes)) / 3, 1.0,
        )
    np.clip(out, -3, 3, out=out)
    return out


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


class Labeller:
    """Bidirectional LSTM with one output per block; ``weights`` has (input, state, bias) of each direction and the output's."""

    def __init__(self, seed: int = 0):
        rng = np.random.default_rng(seed)
        draw = lambda *s: (rng.standard_normal(s) / np.sqrt(s[0])).astype(np.float32)
        self.weights: dict[str, np.ndarray] = {}
        for d in ("f", "b"):
            self.weights |= {f"x{d}": draw(SIZE, 4 * HIDDEN), f"h{d}": draw(HIDDEN, 4 * HIDDEN), f"c{d}": np.zeros(4 * HIDDEN, dtype=np.float32)}
            self.weights[f"c{d}"][HIDDEN : 2 * HIDDEN] = 1
        self.weights |= {"o": draw(2 * HIDDEN + SIZE, 1), "p": np.zeros(1, dtype=np.float32)}

    def run(self, x: np.ndarray, mask: np.ndarray, d: str, trace: list | None) -> np.ndarray:
        w = self.weights
        count, steps, _ = x.shape
        into = x @ w[f"x{d}"] + w[f"c{d}"]
        h = c = np.zeros((count, HIDDEN), dtype=np.float32)
        out = np.zeros((count, steps, HIDDEN), dtype=np.float32)
        for t in range(steps) if d == "f" else range(steps - 1, -1, -1):
            z = into[:, t] + h @ w[f"h{d}"]
            i, f, o = (_sigmoid(z[:, k * HIDDEN : (k + 1) * HIDDEN]) for k in range(3))
            g = np.tanh(z[:, 3 * HIDDEN :])
            m = mask[:, t, None]
            new = f * c + i * g
            shown = np.tanh(new)
            if trace is not None:
                trace.append((t, i, f, o, g, c, h, shown, m))
            c, h = np.where(m, new, c), np.where(m, o * shown, h)
            out[:, t] = h
        return out

    def scores(self, x: np.ndarray, mask: np.ndarray) -> np.ndarray:
        both = np.concatenate([self.run(x, mask, "f", None), self.run(x, mask, "b", None), x], axis=2)
        return _sigmoid((both @ self.weights["o"])[..., 0] + self.weights["p"])


def padded(pages: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    longest = max(len(p) for p in pages)
    x, mask = np.zeros((len(pages), longest, SIZE), dtype=np.float32), np.zeros((len(pages), longest), dtype=bool)
    for k, p in enumerate(pages):
        x[k, : len(p)], mask[k, : len(p)] = p, True
    return x, mask


@cache
def trained() -> Labeller:
    """The model that ``html_training`` has made."""
    model = Labeller()
    with np.load(WEIGHTS) as kept:
        model.weights = {k: kept[k].astype(np.float32) for k in model.weights}
    return model


def main_texts(pages: list[str], model: Labeller) -> list[str]:
    found = [blocks(p) for p in pages]
    out = [""] * len(pages)
    order = sorted((k for k in range(len(pages)) if found[k]), key=lambda k: len(found[k]))
    lo = 0
    while lo < len(order):
        hi = lo + 1
        while hi < len(order) and hi - lo < TOGETHER and (hi - lo + 1) * len(found[order[hi]]) <= MOST_BLOCKS:
            hi += 1
        own, lo = order[lo:hi], hi
        x, mask = padded([vectors(found[k]) for k in own])
        main = model.scores(x, mask) >= 0.5
        for row, k in zip(main, own, strict=True):
            out[k] = "\n".join(b.text for b, keep in zip(found[k], row[: len(found[k])], strict=True) if keep)
    return out


def main_text(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", model: Labeller | None = None) -> DataFrame:
    """``(id_col, url_col, text, n_chars)`` for each page, from its whole markup.

    A null or empty page, or one without any main text, gives an empty text; rows are independent, so
    repeated pages give repeated results, and null ids and addresses stay null.  Unclosed and stray tags are
    taken as browsers take them in the common cases; an element left open ends with the element around it, also one whose
    content is no text (``svg``, ``noscript`` and the like), and ``<svg/>`` has no content.  A quote in a tag that nothing
    closes is an ordinary character.  Very long
    and deeply nested pages are read whole, one at a time.  Other columns are not read.  An empty table gives
    an empty result.
    """
    shared = pages.sparkSession.sparkContext.broadcast(model or trained())

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            source = [p or "" for p in batch.column(2).to_pylist()]
            texts = [t for lo in range(0, len(source), 512) for t in main_texts(source[lo : lo + 512], shared.value)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], names=[id_col, url_col, "text", "n_chars"])

    rows = pages.select(id_col, url_col, F.col(html_col))
    return rows.mapInArrow(work, T.StructType([rows.schema[id_col], rows.schema[url_col], T.StructField("text", T.StringType()), T.StructField("n_chars", T.LongType())]))
