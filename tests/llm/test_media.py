from __future__ import annotations

import hashlib
import zlib

import numpy as np
import pytest

from quire.llm import media

from .conftest import collected


def test_payload_comes_back(docs, texts):
    got = {}
    for r in media.text_audio(docs).collect():
        got.setdefault(r.doc_id, []).append(r)
    assert sum(map(len, got.values())) == len(texts)
    for i, t in texts:
        raw = (t or "").encode()
        payload = raw + b"\xff" * (-len(raw) % 576 if raw else 576)
        digest = hashlib.sha256(payload).hexdigest()
        row = next(r for r in got[i] if r.payload_sha256 == digest)
        file = media.wav(payload, media.MULAW)
        assert (row.n_bytes, row.payload_bytes, row.tail_crc32, row.media_bytes, row.media_sha256) == (len(raw), len(payload), zlib.crc32(payload[-32:]), len(file), hashlib.sha256(file).hexdigest())


def test_tables():
    assert (media.MULAW_TABLE[0], media.MULAW_TABLE[0x80], media.MULAW_TABLE[0xFF], media.MULAW_TABLE[0x7F]) == (-32124, 32124, 0, 0)
    assert (media.ALAW_TABLE[0xD5], media.ALAW_TABLE[0x55], media.ALAW_TABLE[0xAA], media.ALAW_TABLE[0x2A]) == (8, -8, 32256, -32256)


def adpcm_by_hand(block):
    """One block decoded code by code, as the format is described."""
    sample = int.from_bytes(block[:2], "little", signed=True)
    index, out = min(block[2], 88), [sample]
    for byte in block[4:]:
        for code in (byte & 15, byte >> 4):
            step = int(media.STEPS[index])
            change = step >> 3
            change += step if code & 4 else 0
            change += step >> 1 if code & 2 else 0
            change += step >> 2 if code & 1 else 0
            sample = max(-32768, min(32767, sample - change if code & 8 else sample + change))
            index = max(0, min(88, index + int(media.MOVES[code & 7])))
            out.append(sample)
    return out


def test_adpcm_blocks():
    blocks = np.random.default_rng(0).integers(0, 256, (5, 64), dtype=np.uint8)
    assert media.adpcm_blocks(blocks).tolist() == [adpcm_by_hand(bytes(b)) for b in blocks]


@pytest.mark.parametrize(("tag", "align"), [(media.PCM, 2), (media.ALAW, 1), (media.MULAW, 1), (media.IMA_ADPCM, 32)])
def test_wav_round_trip(tag, align):
    samples = bytes(range(64)) * 3
    assert media.unwav(media.wav(samples, tag, align=align)) == (tag, 8000, align, samples)


def test_to_pcm(spark):
    files = [media.wav(bytes([0, 128, 255]), media.MULAW), media.wav(bytes(64), media.IMA_ADPCM, align=32), None, b"", b"no audio at all"]
    df = spark.createDataFrame([(k, None if f is None else bytearray(f), "x") for k, f in enumerate(files)], "k int, media binary, pcm string")
    assert media.to_pcm(df, pcm_col="sound").columns == ["k", "media", "pcm", "sound"]
    got = collected(media.to_pcm(df).select("k", "pcm"))
    assert np.frombuffer(media.unwav(got[0][1])[3], "<i2").tolist() == [-32124, 0, 32124, 16062, 0, 0]
    assert len(media.unwav(got[1][1])[3]) == 2 * 2 * 2 * 57
    assert [r[1] for r in got[2:]] == [None, None, None]


def test_resampling():
    assert media.resampled(np.array([0, 10, 20], np.int16), 8000, 16000).tolist() == [0, 5, 10, 15, 20, 20]
    assert media.resampled(np.array([0, 10, 20, 30, -7], np.int16), 16000, 8000).tolist() == [5, 25, -7]
    assert media.resampled(np.array([0, 10, 20, 30], np.int16), 8000, 6000).tolist() == [0, 13, 26]
    assert media.resampled(np.array([], np.int16), 8000, 11025).tolist() == []


def linear_mulaw(code):
    """The value of a mu-law code, as its format is described: sign, three bits of exponent, four of mantissa, inverted."""
    code = ~code & 255
    size = (((code & 15) * 2 + 33) << (code >> 4 & 7)) - 33
    return (-size if code & 128 else size) * 4


def linear_alaw(code):
    """The value of an A-law code: every other bit is inverted."""
    code ^= 0x55
    part, low = code >> 4 & 7, code & 15
    size = (low * 2 + 1) if part == 0 else (low * 2 + 33) << (part - 1)
    return (size if code & 128 else -size) * 8


@pytest.mark.parametrize("rate", [4000, 8000, 16000])
def test_features(docs, texts, rate):
    """Features of the whole table against plain Python, sample by sample."""

    def slow(pcm):
        if rate == 8000:
            return pcm
        if rate == 16000:
            return [v for k, a in enumerate(pcm) for v in (a, (a + pcm[min(k + 1, len(pcm) - 1)]) >> 1)]
        return [sum(pcm[k : k + 2]) // len(pcm[k : k + 2]) for k in range(0, len(pcm), 2)]

    def crc(pcm):
        return f"{zlib.crc32(b''.join(v.to_bytes(2, 'little', signed=True) for v in slow(pcm))):08x}"

    def feature(text):
        raw = (text or "").encode()
        payload = raw + b"\xff" * (-len(raw) % 576 if raw else 576)
        mu = [linear_mulaw(b) for b in payload]
        ima = [v for k in range(0, len(payload), 576) for v in adpcm_by_hand(payload[k : k + 576])]
        sizes = [abs(v) for v in slow(mu)]
        return f"mulaw={crc(mu)};alaw={crc([linear_alaw(b) for b in payload])};ima={crc(ima)};peak={max(sizes)};mean={sum(sizes) // len(sizes)}"

    got = collected(media.text_audio(docs, rate=rate).select("doc_id", "feature"))
    assert got == sorted(((i, feature(t)) for i, t in texts), key=lambda r: [(v is not None, v) for v in r])


def test_lifting_loses_nothing():
    rng = np.random.default_rng(3)
    for n in range(9):
        pcm = rng.integers(-32768, 32768, n).astype(np.int16)
        assert len(media.lifted(pcm)) == 2 * n
        assert media.unlifted(media.lifted(pcm)).tolist() == pcm.tolist()
    wide = media.resampled(rng.integers(-32768, 32768, 50).astype(np.int16), 8000, 16000)
    assert set(media.lifted(wide)[100:]) == {0}


def test_query_resamples(spark, data):
    """The registered query hears 16 kHz, twice the samples of the payload."""
    from quire.llm.queries import op5_media, table

    docs = table(spark, data, "documents")
    assert collected(op5_media(spark, data)) == collected(media.text_audio(docs, rate=16000))


def test_empty_table(none):
    assert media.text_audio(none).count() == 0
