"""SentencePiece BPE by a table of prefixes, without merging.

A text's pieces under BPE end with one certain piece at every prefix: for each prefix, exactly one vocabulary entry
that ends there may stand behind the last piece of the prefix before it.  So a text needs one pass: an automaton
names the entries that end at a place, and an entry is right if it and the last piece of the prefix
in front of it stay apart when BPE encodes the two together.  The last pieces of all prefixes
are kept; ids are recovered from the end backwards.

Whether two pieces stay apart follows from their own merges: both are replayed in the order of BPE (best score
first, then leftmost), and they do not if at some moment the last symbol of the one and the first of the other would
merge sooner than anything beside them.  Answers are remembered.

Where two characters meet that stand next to each other in no piece, no merge can cross, so the stretches between
such places (words, signs, single digits) are encoded by themselves, each once per worker.  Models that change
texts before they encode them are refused.
"""

from __future__ import annotations

import struct
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quire.llm.common import packs

MARK = "▁"
#: Stretches that a worker remembers, those longer than LONG characters excepted, and pairs of pieces.
KEPT, LONG, KEPT_PAIRS = 600_000, 64, 1_500_000
NEVER = float("-inf")
#: Texts on which a model must agree with what is assumed here: nothing is changed before encoding but for spaces.
PROBES = ("", " ", "a", " a  b ", "a\nb\t", "ﬁ①　éé", "▁x", "\x00", "<s></s><unk><0x0A>", "ab" * 50, " " * 40)
#: Stretches to encode by themselves: a model takes the first of these that keeps each of its pieces in one stretch.
#: Where a stretch ends depends on two characters alone, so no piece can then cross an end.
STRETCHES = tuple(regex.compile(p) for p in (rf"{MARK}*+\p{{L}}++|{MARK}*+[^{MARK}\p{{L}}0-9\n]++|{MARK}++|[0-9\n]", rf"{MARK}*+[^{MARK}]++|{MARK}++", "(?s:.++)"))


class PieceEncoder(dict):
    """Ids of stretches as little-endian 32-bit integers, and texts of ids, for one model."""

    def __init__(self, model: bytes):
        super().__init__()
        import ahocorasick
        import sentencepiece

        self.library = sp = sentencepiece.SentencePieceProcessor(model_proto=model)
        every = range(sp.get_piece_size())
        names = [sp.id_to_piece(i) for i in every]
        plain = [i for i in every if not (sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i))]
        self.ids = {names[i]: i for i in plain}
        self.scores = {names[i]: sp.get_score(i) for i in plain}
        self.bytes = {int(names[i][3:5], 16): i for i in every if sp.is_byte(i)}
        if any(sp.is_unused(i) for i in every) or len(self.bytes) != 256:
            raise ValueError("the model has unused pieces or no bytes")
        self.stretches = next(r for r in STRETCHES if all(r.findall(p) == [p] for p in self.ids)).findall
        self.apart: dict[int, bool] = {}
        #: Pieces by number, then characters that the vocabulary lacks, as texts bring them.
        self.names, self.sizes, self.numbers = [], [], {}
        #: By piece, over its own merges: first symbol, last symbol, and the score of the next merge.
        self.firsts, self.lasts, self.nexts = [], [], []
        self.automaton = ahocorasick.Automaton()
        for name in sorted(self.ids, key=len):
            if self._number(name) is not None:  # others no text's encoding holds
                self.automaton.add_word(name, self.numbers[name])
        self.automaton.make_automaton()
        #: Scores of two symbols that merge.
        self.merges = {self.numbers[a] << 21 | self.numbers[b]: self.scores[n] for n in self.ids for k in range(1, len(n)) if (a := n[:k]) in self.numbers and (b := n[k:]) in self.numbers}
        #: What each id stands for; control ids and the unknown one are left to the library.
        self.texts = [b"" if sp.is_control(i) or sp.is_unknown(i) else bytes([int(names[i][3:5], 16)]) if sp.is_byte(i) else names[i].replace(MARK, " ").encode() for i in every]
        self.silent = [i for i in every if sp.is_control(i)]
        for text in PROBES:
            ids = sp.encode(text)
            if np.frombuffer(self.encode(text), dtype="<i4").tolist() != ids or self.decode(ids) != sp.decode(ids):
                raise ValueError("the model changes texts before it encodes them")

    def _number(self, name: str) -> int | None:
        """The number of a piece or character, after a replay of its merges; null if they do not make one piece of it."""
        if name in self.numbers:
            return self.numbers[name]
        symbols, steps = list(name), []
        while len(symbols) > 1:
            best, at = max((self.scores.get(a + b, NEVER), -k) for k, (a, b) in enumerate(zip(symbols, symbols[1:], strict=False)))
            if best == NEVER:
                return None
            steps.append((symbols[0], symbols[-1], best))
            symbols[-at : 2 - at] = ["".join(symbols[-at : 2 - at])]
        # every symbol on the way is a shorter piece, or a character
        first, last = [self._number(f) for f, _, _ in steps], [self._number(t) for _, t, _ in steps]
        self.numbers[name] = number = len(self.names)
        self.names.append(name)
        self.sizes.append(len(name))
        self.firsts.append([*first, number])
        self.lasts.append([*last, number])
        self.nexts.append([*(s for _, _, s in steps), NEVER])
        return number

    def _apart(self, left: int, right: int) -> bool:
        """Whether BPE leaves two pieces as they are when one follows the other."""
        last, mine, first, other = self.lasts[left], self.nexts[left], self.firsts[right], self.nexts[right]
        i = j = 0
        while True:
            across, m, o = self.merges.get(last[i] << 21 | first[j]), mine[i], other[j]
            # of equal scores the leftmost merges first: left's own, then the one across, then right's own
            if across is not None and m < across and o <= across:
                return False
            if m >= o:
                if m == NEVER:
                    return True
                i += 1
            else:
                j += 1

    def _table(self, stretch: str) -> list[int]:
        """The number of the last piece of each prefix, from the first character on."""
        out: list[int] = []
        sizes, apart = self.sizes, self.apart
        known = 0
        for end, piece in self.automaton.iter(stretch):  # the longest first where several end
            if end < known:
                continue
            while known < end:  # nothing else ends there: a character by itself
                out.append(self._number(stretch[known]))
                known += 1
            at = end - sizes[piece]
            if at >= 0:
                pair = out[at] << 21 | piece
                fits = apart.get(pair)
                if fits is None:
                    if len(apart) >= KEPT_PAIRS:
                        apart.clear()
                    fits = apart[pair] = self._apart(out[at], piece)
                if not fits:
                    continue
            out.append(piece)
            known += 1
        out.extend(self._number(c) for c in stretch[known:])
        return out

    def _stretch(self, stretch: str) -> bytes:
        last, out, k = self._table(stretch), [], len(stretch)
        while k:
            piece = last[k - 1]
            k -= self.sizes[piece]
            known = self.ids.get(self.names[piece])
            if known is None:  # one character that the vocabulary lacks: its bytes
                out.extend(self.bytes[b] for b in reversed(self.names[piece].encode()))
            else:
                out.append(known)
        out.reverse()
        return array("i", out).tobytes()

    def __missing__(self, stretch: str) -> bytes:
        out = self._stretch(stretch)
        if len(stretch) <= LONG:
            if len(self) >= KEPT:
                self.clear()
            self[stretch] = out
        return out

    def encode(self, text: str) -> bytes:
        """Ids of a text as bytes, without an end id."""
        return b"".join(map(self.__getitem__, self.stretches(MARK + text.replace(" ", MARK)))) if text else b""

    def decode(self, ids: list[int]) -> str:
        """The text of ids: pieces and bytes in a row, marks as spaces, without the space in front."""
        while ids and ids[-1] in self.silent:
            ids = ids[:-1]
        if any(c in ids for c in (*self.silent, self.library.unk_id())):  # they part bytes of one character
            return self.library.decode(ids)
        whole = b"".join(map(self.texts.__getitem__, ids))
        if ids and whole.startswith(b" ") and not self.library.is_byte(ids[0]):
            whole = whole[1:]
        try:
            return whole.decode()
        except UnicodeDecodeError:  # bytes that make no character, which no encoding holds
            return self.library.decode(ids)


_encoders: dict[int, PieceEncoder] = {}


def encoder(model: bytes) -> PieceEncoder:
    """The worker's encoder for a model file's contents."""
    key = hash(model)
    if key not in _encoders:
        _encoders.clear()
        _encoders[key] = PieceEncoder(model)
    return _encoders[key]


def _lists(found: list[bytes]) -> pa.ListArray:
    """Lists of ids from their bytes."""
    sizes = np.fromiter((len(x) for x in found), dtype=np.int64, count=len(found)) // 4
    flat = np.frombuffer(b"".join(found), dtype="<i4")
    return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(sizes)]), pa.int32()), pa.array(flat))


def piece_ids(docs: DataFrame, model_path: str, end: bool = True, decode: bool = False, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(id_col, ids)`` for each row, and ``decoded``, the text of these ids, if ``decode`` is set.

    Ids are those of the sentencepiece library without sampling, with the end id behind them if ``end`` is set.  Null
    and empty texts have no ids but the end id, and decode to an empty text; a null id is passed on; repeated rows give
    equal rows; a very long text is encoded whole, in time proportional to its length; other columns are not read,
    whatever their names; an empty table gives an empty result.
    """
    with open(model_path, "rb") as f:
        model = docs.sparkSession.sparkContext.broadcast(f.read())
    fields = [T.StructField(id_col, docs.schema[id_col].dataType), T.StructField("ids", T.ArrayType(T.IntegerType()))]
    schema = T.StructType(fields + [T.StructField("decoded", T.StringType())] * decode)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            pieces = encoder(model.value)
            last = struct.pack("<i", pieces.library.eos_id()) if end else b""
            texts = batch.column(1)
            sizes = [b""] * len(texts) if not len(texts) else texts.cast(pa.binary()).to_pylist()
            for lo, hi in packs([t or b"" for t in sizes]):
                found = [pieces.encode(t or "") + last for t in texts[lo:hi].to_pylist()]
                columns = [batch.column(0)[lo:hi], _lists(found)]
                if decode:
                    columns.append(pa.array([pieces.decode(np.frombuffer(x, dtype="<i4").tolist()) for x in found], pa.string()))
                yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    return docs.select(id_col, text_col).mapInArrow(work, schema)


def piece_texts(encoded: DataFrame, model_path: str, ids_col: str = "ids", out_col: str = "decoded") -> DataFrame:
    """``encoded`` with the text of each list of ids; a null list has a null text, an empty one an empty text.

    Ids may be any of the model's, in any order; bytes that make no character come out as the library has them.  Other
    columns, repeated rows and null ids of rows stay; an empty table gives an empty result.
    """
    with open(model_path, "rb") as f:
        model = encoded.sparkSession.sparkContext.broadcast(f.read())

    @F.arrow_udf("string")
    def texts(lists: pa.Array) -> pa.Array:
        pieces = encoder(model.value)
        return pa.array([None if ids is None else pieces.decode(ids) for ids in lists.to_pylist()], pa.string())

    return encoded.withColumn(out_col, texts(F.col(ids_col)))


def piece_digests(found: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """``(id_col, n_tokens, ids_sha256, decoded_sha256)`` of ``piece_ids`` with ``decode``."""
    return found.select(
        id_col,
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )
