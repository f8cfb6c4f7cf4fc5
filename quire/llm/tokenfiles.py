"""Token ids as binary files of independent zstandard frames with a trailing seek table.

A file holds one frame per document: its token ids as little-endian unsigned 32-bit integers.  Then
follow two skippable frames: an index (document ids) and the seek table of the public zstandard
seekable format, with each frame's compressed size, plain size and checksum.  Any zstandard tool can
unpack a file; a reader of single documents fetches the tables at its end, then only their frames.

Rows are dealt by ranges of the id, so files follow each other in ascending id order and no task
needs another's result: a document's place in the corpus is its place in its file plus the
tokens of all files before, a running sum over the list of files alone.

Each attempt of a task writes files of its own, named after the attempt, and nothing is renamed or replaced.  The list
that the finished attempts return decides which files count; those of lost attempts are in no list.
"""

from __future__ import annotations

import os
import string
import struct
import uuid
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quire.llm.common import removed_at_exit, shared_folder, stored

SKIPPABLE_INDEX = 0x184D2A50
SKIPPABLE_SEEK = 0x184D2A5E
SEEKABLE = 0x8F92EAB1
#: A task begins another file when one has this many bytes.
ROLL_BYTES = 64 << 20
#: Tasks that read files at the same time, at most.
MOST_TASKS = 10_000
#: Encodings of single words that a worker keeps; when they are more, the next ones come beside them and then in their place.
KEPT_WORDS = 400_000
#: The array module's letter for unsigned 32-bit integers here.
IDS = next(c for c in "IL" if array(c).itemsize == 4)


def _byte_characters() -> dict[int, str]:
    """The character that byte-level BPE writes for each byte: itself if it can be seen, else the next free one from 256 on."""
    seen = {*range(33, 127), *range(161, 173), *range(174, 256)}
    hidden = [b for b in range(256) if b not in seen]
    return {b: chr(256 + k) for k, b in enumerate(hidden)}


_BYTES = _byte_characters()


#: Texts that tell whether a tokenizer's words can be encoded one by one.
PROBES = ("one two", " leading and trailing ", "two  spaces\n\nand lines", "Word, (word). it's! a-b?", "été naïve 12 x1 ___", "don't,stop...now", "日本語 text", "tab\tand\x0bothers", "<|endoftext|> ### %%", "\u0130$ \u0130, x\u0130!")


class WordEncoder(dict):
    """Token ids of space-separated words as bytes, each encoded once by the tokenizers library.

    Right for tokenizers that drop white space, as no token of theirs spans a space, and that part
    letters from marks: letters with closing ASCII marks are looked up as two words.  Words of Latin-1
    letters go straight to the tokenizer's model where that is seen to give the same ids.  All of this is tried
    on ``PROBES``; with a tokenizer that does otherwise on any of them, whole texts are encoded.
    """

    def __init__(self, model: str):
        super().__init__()
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.older: dict[str, bytes] = {}
        self.tokenizer = Tokenizer.from_str(model)
        self.model = self.tokenizer.model
        self.plain = all(self._letters(w) == self._whole(w) for w in ("a", "Word", "STRASSE", "Straße", "été", "ÑANDÚ", "qzxjqk"))
        self.by_word = all(np.frombuffer(self._words(t), dtype="<u4").tolist() == self._whole(t) for t in PROBES)

    def _whole(self, word: str) -> list[int]:
        return self.tokenizer.encode(word, add_special_tokens=False).ids

    def _letters(self, word: str) -> list[int]:
        low = word.lower()
        return [t.id for t in self.model.tokenize(low if low.isascii() else low.encode().decode("latin-1").translate(_BYTES))]

    def __missing__(self, word: str) -> bytes:
        if (known := self.older.get(word)) is not None:
            self[word] = known
            return known
        head = word.rstrip(string.punctuation)
        if head != word and head.isalpha() and head.lower().isalpha():  # a mark that lower-casing brings would join the sign behind it
            out = self[head] + self[word[len(head) :]]
        else:
            known = self.plain and word.isalpha() and (word.isascii() or max(word) <= "\xff")
            out = array(IDS, self._letters(word) if known else self._whole(word)).tobytes()
        if len(self) >= KEPT_WORDS:
            self.older = dict(self)
            self.clear()
        self[word] = out
        return out

    def _words(self, text: str) -> bytes:
        return b"".join([self[w] for w in text.replace("\n", " ").split(" ")])

    def encode(self, text: str) -> bytes:
        return self._words(text) if self.by_word else array(IDS, self._whole(text)).tobytes()


_encoders: dict[int, WordEncoder] = {}


def encoder(model: str) -> WordEncoder:
    """The worker's encoder for a tokenizer file's contents."""
    key = hash(model)
    if key not in _encoders:
        _encoders.clear()
        _encoders[key] = WordEncoder(model)
    return _encoders[key]


class FrameWriter:
    """Writes one file; ``add`` for each document, then ``close``."""

    def __init__(self, system: fs.FileSystem, path: str, level: int = 3):
        self.out = system.open_output_stream(path, compression=None)  # else the suffix would have all of it compressed once more
        self.packer = zstandard.ZstdCompressor(level=level, write_checksum=True, write_content_size=True)
        self.ids: list[int | None] = []
        self.table: list[bytes] = []
        self.bytes = self.tokens = 0

    def add(self, doc_id: int | None, ids: bytes) -> None:
        frame = self.packer.compress(ids)
        self.out.write(frame)
        self.ids.append(doc_id)
        self.table.append(struct.pack("<III", len(frame), len(ids), xxhash.xxh64_intdigest(ids) & 0xFFFFFFFF))
        self.bytes += len(frame)
        self.tokens += len(ids) // 4

    def close(self) -> None:
        known = np.array([i is not None for i in self.ids], dtype=np.uint8)
        index = self.packer.compress(known.tobytes() + np.array([i or 0 for i in self.ids], dtype="<i8").tobytes())
        self.out.write(struct.pack("<II", SKIPPABLE_INDEX, len(index)) + index)
        seek = b"".join(self.table) + struct.pack("<IBI", len(self.table), 0x80, SEEKABLE)
        self.out.write(struct.pack("<II", SKIPPABLE_SEEK, len(seek)) + seek)
        self.out.close()


class FrameReader:
    """Reads documents of one file by their place in it."""

    def __init__(self, uri: str):
        system, path = fs.FileSystem.from_uri(uri)
        self.source = system.open_input_file(path)
        size = self.source.size()
        count, flags, magic = struct.unpack("<IBI", self.source.read_at(9, size - 9))
        if magic != SEEKABLE or flags != 0x80:
            raise ValueError(f"{uri} has no seek table")
        begin = size - 9 - 12 * count - 8
        table = np.frombuffer(self.source.read_at(12 * count, begin + 8), dtype="<u4").reshape(-1, 3)
        self.packed, self.plain, self.checks = table.T.astype(np.int64)
        self.at = np.concatenate([[0], np.cumsum(self.packed)])
        _, length = struct.unpack("<II", self.source.read_at(8, int(self.at[-1])))
        self.unpacker = zstandard.ZstdDecompressor()
        index = self.unpacker.decompress(self.source.read_at(length, int(self.at[-1]) + 8))
        known, ids = np.frombuffer(index[:count], dtype=np.uint8), np.frombuffer(index[count:], dtype="<i8")
        self.ids = [i if k else None for i, k in zip(ids.tolist(), known.tolist(), strict=True)]

    def document(self, place: int) -> bytes:
        """Token ids as bytes, checked against the seek table."""
        plain = self.unpacker.decompress(self.source.read_at(int(self.packed[place]), int(self.at[place])), max_output_size=int(self.plain[place]))
        if xxhash.xxh64_intdigest(plain) & 0xFFFFFFFF != self.checks[place]:
            raise ValueError(f"frame {place} is damaged")
        return plain

    def find(self, doc_id: int) -> np.ndarray:
        """Token ids of one document by its id; only its frame is decompressed."""
        return np.frombuffer(self.document(self.ids.index(doc_id)), dtype="<u4")


def write_token_files(docs: DataFrame, folder: str, tokenizer_path: str, end_id: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Writes ``docs`` to files under ``folder`` and returns their list ``(part, piece, uri, docs, tokens)``.

    A null text counts as empty and yields the end id alone.  Rows with a null id come first; rows that share an
    id follow each other by a hash of the text, so any number of them can be dealt to several tasks.  Repeated rows
    are all written; a very long text is one frame.  An empty table yields no files.
    """
    with open(tokenizer_path, encoding="utf-8") as f:
        model = docs.sparkSession.sparkContext.broadcast(f.read())
    end = struct.pack("<I", end_id)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get()
        part, out, piece, done = task.partitionId(), None, 0, []
        system, base = fs.FileSystem.from_uri(folder)
        for batch in batches:
            words = encoder(model.value)
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                if out is None:
                    system.create_dir(base, recursive=True)
                    name = f"part-{part:06d}-{piece:04d}-{task.taskAttemptId()}.tok.zst"
                    out = FrameWriter(system, f"{base}/{name}")
                out.add(doc_id, words.encode(text or "") + end)
                if out.bytes >= ROLL_BYTES:
                    out.close()
                    done.append((part, piece, f"{folder}/{name}", len(out.ids), out.tokens))
                    out, piece = None, piece + 1
        if out is not None:
            out.close()
            done.append((part, piece, f"{folder}/{name}", len(out.ids), out.tokens))
        if done:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*done, strict=True), (pa.int32(), pa.int32(), pa.string(), pa.int64(), pa.int64()), strict=True)], names=["part", "piece", "uri", "docs", "tokens"])

    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    order = [F.col("id").asc_nulls_first(), F.col("h")]
    dealt = rows.withColumn("h", F.xxhash64("text")).repartitionByRange(*order).sortWithinPartitions(*order, "text")
    return stored(dealt.mapInArrow(work, "part int, piece int, uri string, docs long, tokens long"))


def read_token_files(files: DataFrame) -> DataFrame:
    """``(doc_id, start, n_tokens, ids_crc32)`` of every document in ``files``, read from them.

    Null and repeated ids come back as they were written; an empty list gives an empty result; a damaged frame is an error.
    """
    before = Window.orderBy("part", "piece").rowsBetween(Window.unboundedPreceding, -1)
    placed = files.select("uri", F.coalesce(F.sum("tokens").over(before), F.lit(0)).alias("start"))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for uri, start in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                file = FrameReader(uri)
                sums = [zlib.crc32(file.document(k)) for k in range(len(file.ids))]
                starts = start + np.concatenate([[0], np.cumsum(file.plain // 4)[:-1]])
                yield pa.RecordBatch.from_arrays([pa.array(file.ids, pa.int64()), pa.array(starts, pa.int64()), pa.array(file.plain // 4), pa.array(sums, pa.int64())], names=["doc_id", "start", "n_tokens", "ids_crc32"])

    # by a stated number: the list is small in bytes, so Spark would otherwise put all files in one task
    return placed.repartition(max(1, min(files.count(), MOST_TASKS)), "uri").mapInArrow(work, "doc_id long, start long, n_tokens long, ids_crc32 long")


def token_output(docs: DataFrame, tokenizer_path: str, end_id: int, id_col: str = "doc_id", text_col: str = "text", folder: str | None = None) -> DataFrame:
    """Writes the files and reads them back; ``folder`` is by default a new one in the shared folder, which goes when the driver ends."""
    if folder is None:
        shared = shared_folder(docs.sparkSession)
        shared = f"file://{os.path.abspath(shared)}" if ":" not in shared else shared.replace("file:/", "file:///", 1) if shared.startswith("file:/") and not shared.startswith("file:///") else shared
        folder = f"{shared}/tokens-{uuid.uuid4().hex}"
        removed_at_exit(docs.sparkSession, folder)
    return read_token_files(write_token_files(docs, folder, tokenizer_path, end_id, id_col, text_col))
