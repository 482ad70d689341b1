import io
import random
import wave
import zlib
from hashlib import sha256

import numpy as np
import pytest

from sparkloom.llm import media as M


def slow_adpcm(block):
    """One block, sample by sample."""
    value = int.from_bytes(block[:2], "little", signed=True)
    index, out = min(block[2], 88), [value]
    for byte in block[4:]:
        for code in (byte & 15, byte >> 4):
            step = int(M.STEPS[index])
            move = step >> 3
            for bit, part in ((4, step), (2, step >> 1), (1, step >> 2)):
                if code & bit:
                    move += part
            value = max(-32768, min(32767, value - move if code & 8 else value + move))
            index = max(0, min(88, index + int(M.CHANGES[code & 7])))
            out.append(value)
    return out


def test_tables():
    assert list(M.MULAW[[0, 0x7F, 0x80, 0xFF, 0x0F, 0x8F]]) == [-32124, 0, 32124, 0, -16764, 16764]
    assert list(M.ALAW[[0x55, 0xD5, 0x2A, 0xAA]]) == [-8, 8, -32256, 32256]
    assert len(set(M.MULAW.tolist())) == 255 and len(set(M.ALAW.tolist())) == 256
    assert len(M.STEPS) == 89


def test_adpcm_across_blocks():
    raw = random.Random(0).randbytes(64 * 50)
    got = M.adpcm_blocks(np.frombuffer(raw, np.uint8).reshape(-1, 64))
    assert got.tolist() == [slow_adpcm(raw[i : i + 64]) for i in range(0, len(raw), 64)]


def test_resample():
    x = np.array([0, 100, -200, 32767, -32768], np.int16)
    y = M.resample(x)
    assert y[0::2].tolist() == x.tolist() and len(y) == 10 and y[1] == (9 * (0 + 100) - 0 + 200 + 8) >> 4
    assert len(M.resample(x[:0])) == 0 and M.resample(x[:1]).tolist() == [0, 0]


@pytest.mark.parametrize("codec", M.TAGS)
def test_container(codec):
    for n in (64, 640):
        data = random.Random(n).randbytes(n)
        assert M.from_wav(M.to_wav(data, codec)) == (codec, 64 if codec == "adpcm" else 1, data)
    for bad in (b"", b"RIFF", b"RIFF\0\0\0\0WAVE", M.to_wav(b"x" * 64, codec)[:30]):
        with pytest.raises(ValueError):
            M.from_wav(bad)


def test_query(odd, docs):
    df = odd.unionByName(docs([(100 + i, "text %d " % i * i) for i in range(60)]))
    payloads = {}
    for r in df.collect():
        raw = (r.text or "").encode()
        payloads.setdefault(r.doc_id, []).append((raw, raw + bytes(-len(raw) % 64 or (0 if raw else 64))))
    got = M.op4(df).collect()
    assert len(got) == df.count()
    for r in got:
        raw, p = payloads[r.doc_id][0]
        media = M.to_wav(p, sorted(M.TAGS)[zlib.crc32(p) % 3])
        assert (r.n_bytes, r.payload_bytes, r.payload_sha256, r.tail_crc32) == (len(raw), len(p), sha256(p).hexdigest(), zlib.crc32(p[-64:]))
        assert (r.media_bytes, r.media_sha256) == (len(media), sha256(media).hexdigest())
        codec = r.feature.split("|")[0]
        pcm = np.concatenate([slow_adpcm(p[i : i + 64]) for i in range(0, len(p), 64)]).astype(np.int16) if codec == "adpcm" else (M.MULAW if codec == "mulaw" else M.ALAW)[np.frombuffer(p, np.uint8)]
        assert r.feature.split("|")[-1] == f"{zlib.crc32(M.resample(pcm).tobytes()):x}"
    assert len({r.feature.split("|")[0] for r in got}) == 3
    assert M.op4(odd.limit(0)).count() == 0


def test_damaged_media(spark):
    rows = [(1, None), (2, b"junk"), (3, M.to_wav(b"\xff" * 64, "mulaw"))]
    got = {r.id: r for r in M.decoded(spark.createDataFrame(rows, "id long, media binary")).collect()}
    assert got[1].error == "null" and got[2].error and got[2].pcm is None
    assert got[3].error is None and got[3].n_samples == 128 and got[3].peak == 0


def test_resampled_sound_is_stored(spark):
    rows = [(1, None, "x"), (2, b"junk", "y"), (3, M.to_wav(bytes(range(256)), "alaw"), "z"), (4, M.to_wav(bytes(range(64)) * 2, "adpcm"), None)]
    got = {r.id: r for r in M.resampled(spark.createDataFrame(rows, "id long, media binary, name string")).collect()}
    assert got[1].wav is None and got[1].error == "null" and got[2].wav is None and got[2].name == "y"
    for i, pcm in ((3, M.ALAW), (4, np.concatenate([slow_adpcm(bytes(range(64)))] * 2).astype(np.int16))):
        with wave.open(io.BytesIO(got[i].wav)) as w:
            assert (w.getnchannels(), w.getsampwidth(), w.getframerate()) == (1, 2, 16000)
            assert w.readframes(w.getnframes()) == M.resample(pcm).tobytes() and w.getnframes() == got[i].n_samples
