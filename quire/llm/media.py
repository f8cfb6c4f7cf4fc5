"""Telephony audio in media columns: mu-law, A-law and IMA ADPCM to resampled PCM.

Audio is kept as WAV bytes in a binary column.  mu-law and A-law samples are expanded by tables of 256
values.  ADPCM blocks are independent, so all blocks of a batch are decoded side by side: one numpy
step per sample position, over as many blocks as there are.  PCM is 16-bit WAV in a column of its own; in
tables that are stored, it is the two planes of a lifting step, which lose nothing and are smaller.  What is told
about audio is computed from stored columns that were read back.
"""

from __future__ import annotations

import hashlib
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quire.llm.common import byte_texts, packs, stored

RATE = 8000
TARGET_RATE = 16000
UNIT = 576
#: Bytes of a page of stored tables: large pages hold more texts that resemble each other.
PAGE = 4 << 20
#: WAV format tags (fixed values).
PCM, ALAW, MULAW, IMA_ADPCM = 1, 6, 7, 17

#: Step sizes of IMA ADPCM (fixed values).
STEPS = np.array(
    [7, 8, 9, 10, 11, 12, 13, 14, 16, 17, 19, 21, 23, 25, 28, 31, 34, 37, 41, 45, 50, 55, 60, 66, 73, 80, 88, 97, 107, 118, 130, 143, 157, 173, 190, 209, 230, 253, 279, 307, 337, 371, 408, 449, 494, 544,
     598, 658, 724, 796, 876, 963, 1060, 1166, 1282, 1411, 1552, 1707, 1878, 2066, 2272, 2499, 2749, 3024, 3327, 3660, 4026, 4428, 4871, 5358, 5894, 6484, 7132, 7845, 8630, 9493, 10442, 11487, 12635,
     13899, 15289, 16818, 18500, 20350, 22385, 24623, 27086, 29794, 32767], dtype=np.int32,
)
#: Change of the step index by the lower three bits of a code (fixed values).
MOVES = np.array([-1, -1, -1, -1, 2, 4, 6, 8], dtype=np.int32)


def _mulaw_table() -> np.ndarray:
    code = ~np.arange(256) & 0xFF
    size = (((code & 0x0F) << 3) + 0x84 << (code >> 4 & 7)) - 0x84
    return np.where(code & 0x80, -size, size).astype(np.int16)


def _alaw_table() -> np.ndarray:
    code = np.arange(256) ^ 0x55
    part, size = code >> 4 & 7, (code & 0x0F) << 4
    size = np.where(part == 0, size + 8, size + 0x108 << np.maximum(part - 1, 0))
    return np.where(code & 0x80, size, -size).astype(np.int16)


MULAW_TABLE, ALAW_TABLE = _mulaw_table(), _alaw_table()


def _adpcm_tables() -> tuple[np.ndarray, np.ndarray]:
    """By step index and code: the change of the sample, and the next step index."""
    step, code = STEPS[:, None], np.arange(16)[None, :]
    size = (step >> 3) + np.where(code & 1, step >> 2, 0) + np.where(code & 2, step >> 1, 0) + np.where(code & 4, step, 0)
    after = np.clip(np.arange(len(STEPS))[:, None] + MOVES[code & 7], 0, len(STEPS) - 1)
    return np.where(code & 8, -size, size).astype(np.int32).ravel(), (after * 16).astype(np.int32).ravel()


DELTAS, AFTER = _adpcm_tables()


def adpcm_blocks(blocks: np.ndarray) -> np.ndarray:
    """PCM of mono IMA ADPCM ``blocks`` (one per row, all of one size): 2 * size - 7 samples each."""
    count, size = blocks.shape
    out = np.empty((2 * (size - 4) + 1, count), dtype=np.int16)
    sample = blocks[:, :2].copy().view("<i2")[:, 0].astype(np.int32)
    state = np.minimum(blocks[:, 2], len(STEPS) - 1).astype(np.int32) * 16
    codes = np.ascontiguousarray(blocks[:, 4:].T)
    out[0] = sample
    for k in range(size - 4):
        for half, code in enumerate((codes[k] & 15, codes[k] >> 4)):
            at = state + code
            sample = np.clip(sample + DELTAS[at], -32768, 32767)
            state = AFTER[at]
            out[2 * k + half + 1] = sample
    return out.T


def wav(samples: bytes, tag: int, rate: int = RATE, align: int = 1) -> bytes:
    """A mono WAV file of stored samples; ``align`` is the block size in bytes."""
    bits = {PCM: 16, ALAW: 8, MULAW: 8, IMA_ADPCM: 4}[tag]
    align = 2 if tag == PCM else align
    per_block = 2 * align - 7 if tag == IMA_ADPCM else 1
    extra = struct.pack("<HH", 2, per_block) if tag == IMA_ADPCM else struct.pack("<H", 0)
    form = struct.pack("<HHIIHH", tag, 1, rate, rate * align // per_block, align, bits) + extra
    body = b"WAVE" + b"fmt " + struct.pack("<I", len(form)) + form + b"fact" + struct.pack("<II", 4, len(samples) // align * per_block) + b"data" + struct.pack("<I", len(samples)) + samples + b"\0" * (len(samples) % 2)
    return b"RIFF" + struct.pack("<I", len(body)) + body


def unwav(data: bytes) -> tuple[int, int, int, bytes]:
    """Format tag, rate, block size and stored samples of a mono WAV file."""
    if data[:4] != b"RIFF" or data[8:12] != b"WAVE":
        raise ValueError("not a WAV file")
    at, form = 12, b""
    while at + 8 <= len(data):
        name, (size,) = data[at : at + 4], struct.unpack_from("<I", data, at + 4)
        if name == b"fmt ":
            form = data[at + 8 : at + 8 + size]
        elif name == b"data":
            tag, channels, rate, _, align = struct.unpack_from("<HHIIH", form)
            if channels != 1:
                raise ValueError("not mono")
            return tag, rate, align, data[at + 8 : at + 8 + size]
        at += 8 + size + size % 2
    raise ValueError("no samples")


def expand(tag: int, align: int, samples: bytes) -> np.ndarray:
    """16-bit PCM of stored samples; an ADPCM remainder shorter than a block is not audio."""
    raw = np.frombuffer(samples, dtype=np.uint8)
    if tag == MULAW:
        return MULAW_TABLE[raw]
    if tag == ALAW:
        return ALAW_TABLE[raw]
    if tag == IMA_ADPCM:
        return adpcm_blocks(raw[: len(raw) // align * align].reshape(-1, align)).ravel()
    return np.frombuffer(samples[: len(samples) // 2 * 2], dtype="<i2")


def resampled(pcm: np.ndarray, rate: int, target: int) -> np.ndarray:
    """Linear interpolation in whole numbers, the last sample being held; to a whole part of the rate, means of successive samples."""
    if rate == target or not len(pcm):
        return pcm
    if rate % target == 0:
        step = rate // target
        sums = np.add.reduceat(pcm.astype(np.int32), np.arange(0, len(pcm), step))
        held = np.full(len(sums), step)
        held[-1] = len(pcm) - step * (len(sums) - 1)
        return (sums // held).astype(np.int16)
    wide = np.append(pcm, pcm[-1]).astype(np.int32)
    if target == 2 * rate:
        out = np.empty(2 * len(pcm), dtype=np.int16)
        out[::2], out[1::2] = pcm, (wide[:-1] + wide[1:]) >> 1
        return out
    place = np.arange(len(pcm) * target // rate, dtype=np.int64) * rate
    at, part = place // target, place % target
    return ((wide[at] * (target - part) + wide[at + 1] * part) // target).astype(np.int16)


def _stored_pcm(pcm: list[np.ndarray | None], rate: int) -> pa.Array:
    """PCM as it is stored: 16-bit WAV bytes."""
    return pa.array([None if p is None else wav(p.astype("<i2", copy=False).tobytes(), PCM, rate) for p in pcm], pa.binary())


def lifted(pcm: np.ndarray) -> bytes:
    """16-bit PCM of any kind without loss: every other sample, then what those between differ from the mean of their neighbours."""
    even = pcm[::2].astype("<i2")
    return even.tobytes() + (pcm[1::2] - _between(even, len(pcm) // 2)).astype("<i2").tobytes()


def unlifted(data: bytes) -> np.ndarray:
    """The PCM that ``lifted`` took."""
    planes = np.frombuffer(data, dtype="<i2")
    out, half = np.empty(len(planes), dtype=np.int16), (len(planes) + 1) // 2
    out[::2] = planes[:half]
    out[1::2] = planes[half:] + _between(planes[:half], len(planes) - half)
    return out


def _between(even: np.ndarray, count: int) -> np.ndarray:
    """Means of neighbours, the last sample being held."""
    wide = np.append(even, even[-1:]).astype(np.int32)
    return ((wide[:-1] + wide[1:]) >> 1).astype(np.int16)[:count]


def to_pcm(media: DataFrame, media_col: str = "media", target_rate: int = TARGET_RATE, pcm_col: str = "pcm") -> DataFrame:
    """``media`` with a column ``pcm_col``: each WAV file decoded and resampled, as 16-bit WAV bytes.

    A null or empty file gives null, and so does one that is no mono WAV file of a known format.  ADPCM files of
    one block size are decoded together.  A column of the name ``pcm_col`` that is there already is replaced, the
    other columns stay; repeated rows have equal results, and an empty table gives an empty result.
    """
    kept = [c for c in media.columns if c != pcm_col]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            files = byte_texts(batch.column(media_col))
            for lo, hi in packs(files):
                out = _stored_pcm(decoded(files[lo:hi], target_rate), target_rate)
                yield pa.RecordBatch.from_arrays([*(c[lo:hi] for c in batch.columns), out], names=[*kept, pcm_col])

    rows = media.select(*kept)
    return rows.mapInArrow(work, T.StructType([*rows.schema.fields, T.StructField(pcm_col, T.BinaryType())]))


def _readable(file: bytes) -> tuple[int, int, int, bytes] | None:
    try:
        parts = unwav(file)
    except (ValueError, struct.error):
        return None
    return parts if parts[0] in (PCM, ALAW, MULAW) or (parts[0] == IMA_ADPCM and parts[2] > 4) else None


def decoded(files: list[bytes], target_rate: int) -> list[np.ndarray | None]:
    """Resampled PCM of several WAV files; the ADPCM blocks of all of them are decoded side by side."""
    parsed = [_readable(f) for f in files]
    out: list[np.ndarray | None] = [None] * len(files)
    by_size: dict[int, list[int]] = {}
    for i, p in enumerate(parsed):
        if p and p[0] == IMA_ADPCM:
            by_size.setdefault(p[2], []).append(i)
        elif p:
            out[i] = resampled(expand(p[0], p[2], p[3]), p[1], target_rate)
    for align, own in by_size.items():
        counts = [len(parsed[i][3]) // align for i in own]
        joined = b"".join(parsed[i][3][: n * align] for i, n in zip(own, counts, strict=True))
        pcm = adpcm_blocks(np.frombuffer(joined, dtype=np.uint8).reshape(-1, align))
        at = np.concatenate([[0], np.cumsum(counts)])
        for k, i in enumerate(own):
            out[i] = resampled(pcm[at[k] : at[k + 1]].ravel(), parsed[i][1], target_rate)
    return out


def padded(payload: bytes, unit: int = UNIT) -> bytes:
    return payload + b"\xff" * (-len(payload) % unit if payload else unit)


def text_media(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", unit: int = UNIT) -> DataFrame:
    """``(id, n_bytes, media)``: the padded UTF-8 bytes of each text as the samples of a mu-law WAV file.

    A null or empty text is ``unit`` bytes 255; repeated rows give equal files, null ids stay null, a very long text is one
    file, other columns are not read, and an empty table gives an empty result.
    """

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = byte_texts(batch.column(1))
            for lo, hi in packs(texts):
                files = [wav(padded(t, unit), MULAW) for t in texts[lo:hi]]
                yield pa.RecordBatch.from_arrays([batch.column(0)[lo:hi], pa.array([len(t) for t in texts[lo:hi]], pa.int64()), pa.array(files, pa.binary())], names=["id", "n_bytes", "media"])

    rows = docs.select(F.col(id_col).alias("id"), text_col)
    return rows.mapInArrow(work, T.StructType([rows.schema["id"], T.StructField("n_bytes", T.LongType()), T.StructField("media", T.BinaryType())]))


_TOLD = [T.StructField(n, k) for n, k in (("payload_bytes", T.LongType()), ("payload_sha256", T.StringType()), ("tail_crc32", T.LongType()), ("media_bytes", T.LongType()), ("media_sha256", T.StringType()), ("others", T.StringType()))]


def _described(media: DataFrame, unit: int, rate: int) -> DataFrame:
    """``(id, n_bytes, ..., pcm)`` of stored files, about a megabyte of them at a time.

    A file tells its payload, the CRC-32s of the PCM that the payload makes as A-law and ADPCM, and the PCM that is stored, lifted.
    """

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column("media")
            for lo, hi in packs(byte_texts(column)):
                files = byte_texts(column[lo:hi])
                back = [unwav(f)[3] for f in files]
                heard, a, ima = decoded(files, rate), decoded([wav(b, ALAW) for b in back], rate), decoded([wav(b, IMA_ADPCM, align=unit) for b in back], rate)
                told = []
                for file, payload, *both in zip(files, back, a, ima, strict=True):
                    others = ";".join(f"{n}={zlib.crc32(x.astype('<i2', copy=False).tobytes()):08x}" for n, x in zip(("alaw", "ima"), both, strict=True))
                    told.append((len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-32:]), len(file), hashlib.sha256(file).hexdigest(), others))
                columns = [pa.array(c) for c in zip(*told, strict=True)]
                yield pa.RecordBatch.from_arrays([batch.column("id")[lo:hi], batch.column("n_bytes")[lo:hi], *columns, pa.array([lifted(p) for p in heard], pa.binary())], names=["id", "n_bytes", *(f.name for f in _TOLD), "pcm"])

    return media.mapInArrow(work, T.StructType([media.schema["id"], media.schema["n_bytes"], *_TOLD, T.StructField("pcm", T.BinaryType())]))


def text_audio(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", unit: int = UNIT, rate: int = TARGET_RATE) -> DataFrame:
    """Each text stored as telephony audio, read back, stored as PCM of ``rate``, read back again and described.

    A table of mu-law WAV files is written first.  What is read back from it gives the payload and media
    columns, and the PCM column (lifted) of a second table.  ``feature`` has the CRC-32, peak and mean size of the PCM
    that is read back from there, and CRC-32s of the PCM that the payload makes as A-law and IMA ADPCM (blocks of
    ``unit`` bytes).  A null or empty text stores ``unit`` bytes 255; a very long text is one file, whatever its
    length; rows are independent, so repeated texts have repeated results and a null id stays null.  Other
    columns are not read.  An empty table gives an empty result.
    """
    media = stored(text_media(docs, id_col, text_col, unit), "zstd", PAGE)
    heard = stored(_described(media, unit, rate), "zstd", PAGE)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            features = []
            for file, others in zip(batch.column("pcm"), batch.column("others").to_pylist(), strict=True):
                pcm = unlifted(file.as_py())
                size = np.abs(pcm.astype(np.int32))
                features.append(f"mulaw={zlib.crc32(pcm.astype('<i2', copy=False).tobytes()):08x};{others};peak={size.max()};mean={size.sum() // len(size)}")
            yield pa.RecordBatch.from_arrays([*(batch.column(n) for n in ("id", *NAMES[:-1])), pa.array(features, pa.string())], names=[id_col, *NAMES])

    known = {f.name: f for f in heard.schema}
    return heard.mapInArrow(work, T.StructType([T.StructField(id_col, known["id"].dataType), *(known[n] for n in NAMES[:-1]), T.StructField("feature", T.StringType())]))


NAMES = ["n_bytes", "payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", "media_sha256", "feature"]
