"""Telephony audio: mu-law, A-law and IMA ADPCM to resampled PCM.

Companded samples are expanded by 256-entry lookup tables. ADPCM blocks are
decoded with numpy across blocks: a step handles the n-th sample of all blocks of
a batch of rows at once. The 8 kHz result is resampled to 16 kHz by a half-band
interpolator to 16-bit PCM.

`stored` puts bytes into WAV containers as they are; `decoded` reads the
containers back; `resampled` stores the sound as WAV files of PCM. `op4` takes texts for signals: their UTF-8 bytes, with bytes 0
appended up to a positive multiple of 64, are the payload, and crc32 of the
payload mod 3 picks the codec, so equal texts get equal values.

Rules for odd input: a null text is empty, that is 64 bytes 0; null media gives null
columns and the error 'null'; media that isn't a WAV file of a known codec gives nulls
and an error; a last short ADPCM block gives no samples; extra columns are ignored.
"""

from __future__ import annotations

import struct
import zlib
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import common

RATE, UNIT = 8000, 64
#: WAV format tags.
TAGS = {"mulaw": 7, "alaw": 6, "adpcm": 17}
PCM = 1
#: Fixed values of the IMA ADPCM standard: step sizes, and index changes by the low three bits.
STEPS = np.array(
    [7, 8, 9, 10, 11, 12, 13, 14, 16, 17, 19, 21, 23, 25, 28, 31, 34, 37, 41, 45, 50, 55, 60, 66, 73, 80, 88, 97, 107, 118, 130, 143, 157, 173, 190, 209, 230, 253, 279, 307, 337, 371, 408, 449, 494, 544, 598, 658, 724, 796, 876, 963, 1060, 1166, 1282, 1411, 1552, 1707, 1878, 2066, 2272, 2499, 2749, 3024, 3327, 3660, 4026, 4428, 4871, 5358, 5894, 6484, 7132, 7845, 8630, 9493, 10442, 11487, 12635, 13899, 15289, 16818, 18500, 20350, 22385, 24623, 27086, 29794, 32767],
    np.int32,
)
CHANGES = np.array([-1, -1, -1, -1, 2, 4, 6, 8], np.int32)


def mulaw_table() -> np.ndarray:
    code = ~np.arange(256) & 0xFF
    size = (((code & 15) << 3) + 132 << ((code >> 4) & 7)) - 132
    return np.where(code & 128, -size, size).astype(np.int16)


def alaw_table() -> np.ndarray:
    code = np.arange(256) ^ 0x55
    exponent, mantissa = (code >> 4) & 7, (code & 15) << 4
    size = np.where(exponent == 0, mantissa + 8, (mantissa + 264) << np.maximum(exponent - 1, 0))
    return np.where(code & 128, size, -size).astype(np.int16)


MULAW, ALAW = mulaw_table(), alaw_table()


def adpcm_blocks(blocks: np.ndarray) -> np.ndarray:
    """Samples (blocks x (2 * (size - 4) + 1)) of IMA ADPCM blocks given as rows of bytes."""
    n, size = blocks.shape
    body = np.ascontiguousarray(blocks[:, 4:].T)
    value = np.ascontiguousarray(blocks[:, :2]).view("<i2").reshape(n).astype(np.int32)
    index = np.minimum(blocks[:, 2].astype(np.int32), 88)
    out = np.empty((2 * (size - 4) + 1, n), np.int16)
    out[0] = value
    for k in range(size - 4):
        for half in (0, 1):
            code = ((body[k] >> 4) if half else (body[k] & 15)).astype(np.int32)
            step = STEPS[index]
            move = (step >> 3) + (step >> 2) * (code & 1) + (step >> 1) * ((code >> 1) & 1) + step * ((code >> 2) & 1)
            value = np.clip(np.where(code & 8, value - move, value + move), -32768, 32767)
            index = np.clip(index + CHANGES[code & 7], 0, 88)
            out[2 * k + half + 1] = value
    return np.ascontiguousarray(out.T)


def resample(pcm: np.ndarray) -> np.ndarray:
    """Twice as many samples: the own ones, and between them (-1, 9, 9, -1) / 16 of the four nearest, edges repeated."""
    if not len(pcm):
        return pcm
    x = np.pad(pcm.astype(np.int32), (1, 2), mode="edge")
    out = np.empty(2 * len(pcm), np.int16)
    out[0::2] = pcm
    out[1::2] = np.clip((9 * (x[1:-2] + x[2:-1]) - x[:-3] - x[3:] + 8) >> 4, -32768, 32767)
    return out


def to_wav(payload: bytes, codec: str, block: int = UNIT) -> bytes:
    """A mono 8 kHz WAV file whose data chunk is the payload."""
    align = block if codec == "adpcm" else 1
    per_block = 2 * (block - 4) + 1 if codec == "adpcm" else 1
    rate = RATE * align // per_block if codec == "adpcm" else RATE
    extra = struct.pack("<H", per_block) if codec == "adpcm" else b""
    fmt = struct.pack("<HHIIHHH", TAGS[codec], 1, RATE, rate, align, 4 if codec == "adpcm" else 8, len(extra)) + extra
    samples = len(payload) // align * per_block
    chunks = b"".join(k + struct.pack("<I", len(v)) + v + b"\0" * (len(v) & 1) for k, v in ((b"fmt ", fmt), (b"fact", struct.pack("<I", samples)), (b"data", payload)))
    return b"RIFF" + struct.pack("<I", 4 + len(chunks)) + b"WAVE" + chunks


def pcm_wav(pcm: bytes, rate: int) -> bytes:
    """A mono WAV file of 16-bit PCM."""
    fmt = struct.pack("<HHIIHH", PCM, 1, rate, 2 * rate, 2, 16)
    chunks = b"fmt " + struct.pack("<I", len(fmt)) + fmt + b"data" + struct.pack("<I", len(pcm)) + pcm
    return b"RIFF" + struct.pack("<I", 4 + len(chunks)) + b"WAVE" + chunks


def from_wav(media: bytes) -> tuple[str, int, bytes]:
    """(codec, block size, payload) of a WAV file; ValueError if it isn't one of a known codec."""
    if media[:4] != b"RIFF" or media[8:12] != b"WAVE":
        raise ValueError("not a WAV file")
    at, found = 12, {}
    while at + 8 <= len(media):
        size = struct.unpack_from("<I", media, at + 4)[0]
        found.setdefault(media[at : at + 4], media[at + 8 : at + 8 + size])
        at += 8 + size + (size & 1)
    if len(found.get(b"fmt ", b"")) < 16 or b"data" not in found:
        raise ValueError("chunks missing")
    tag, channels, _, _, align = struct.unpack_from("<HHIIH", found[b"fmt "])
    codec = {v: k for k, v in TAGS.items()}.get(tag)
    if codec is None or channels != 1 or codec == "adpcm" and align < 5:
        raise ValueError(f"format {tag} with {channels} channels")
    return codec, align, found[b"data"]


def expand(payloads: list[tuple[str, int, bytes]]) -> list[np.ndarray]:
    """8 kHz PCM of each (codec, block size, payload); ADPCM blocks of one size are decoded together."""
    out: list[np.ndarray] = [np.empty(0, np.int16)] * len(payloads)
    groups: dict[int, list[int]] = {}
    for i, (codec, block, data) in enumerate(payloads):
        if codec == "adpcm":
            groups.setdefault(block, []).append(i)
        else:
            out[i] = (MULAW if codec == "mulaw" else ALAW)[np.frombuffer(data, np.uint8)]
    for block, members in groups.items():
        counts = [len(payloads[i][2]) // block for i in members]
        raw = b"".join(payloads[i][2][: n * block] for i, n in zip(members, counts, strict=True))
        samples = adpcm_blocks(np.frombuffer(raw, np.uint8).reshape(-1, block)) if raw else np.empty((0, 1), np.int16)
        at = 0
        for i, n in zip(members, counts, strict=True):
            out[i] = samples[at : at + n].reshape(-1)
            at += n
    return out


def stored(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, n_bytes, media: each text's payload as a WAV file, written to the shared folder."""
    common.session(docs)
    schema = T.StructType([T.StructField("id", docs.schema[id_col].dataType), T.StructField("n_bytes", T.LongType()), T.StructField("media", T.BinaryType())])

    def run(batches):
        codecs = sorted(TAGS)
        for b in batches:
            texts = [t or b"" for t in b.column(1).cast(pa.binary()).to_pylist()]
            media = []
            for t in texts:
                payload = t + b"\0" * (-len(t) % UNIT if t else UNIT)
                media.append(to_wav(payload, codecs[zlib.crc32(payload) % 3]))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(map(len, texts), pa.int64()), pa.array(media, pa.binary())], names=schema.names)

    return common.written(docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text")).mapInArrow(run, schema), "media")


DECODED = "codec string, payload binary, pcm binary, rate int, n_samples long, peak int, energy long, crossings long, error string"


def decoded(media: DataFrame, id_col: str = "id", media_col: str = "media") -> DataFrame:
    """id, codec, payload, pcm (16-bit, 16 kHz), rate, n_samples, peak, energy (sum of squares), crossings (sign changes), error; other columns of media follow."""
    common.session(media)
    rest = [c for c in media.columns if c not in (id_col, media_col, *T.StructType.fromDDL(DECODED).names)]
    schema = T.StructType([T.StructField("id", media.schema[id_col].dataType), *T.StructType.fromDDL(DECODED).fields, *[media.schema[c] for c in rest]])

    def run(batches):
        for whole in batches:
            for at in range(0, whole.num_rows, 256):
                b = whole.slice(at, 256)
                parsed, errors = [], []
                for m in b.column(1).to_pylist():
                    try:
                        parsed.append(from_wav(m) if m is not None else None)
                        errors.append(None if m is not None else "null")
                    except ValueError as e:
                        parsed.append(None)
                        errors.append(str(e))
                pcm = iter(expand([p for p in parsed if p]))
                rows = []
                for p, e in zip(parsed, errors, strict=True):
                    if p is None:
                        rows.append((None,) * 8 + (e,))
                        continue
                    x = resample(next(pcm))
                    wide = x.astype(np.int64)
                    peak = int(np.abs(wide).max()) if len(x) else 0
                    rows.append((p[0], p[2], x.tobytes(), 2 * RATE, len(x), peak, int(wide @ wide), int(((x[1:] < 0) != (x[:-1] < 0)).sum()), None))
                types = [pa.string(), pa.binary(), pa.binary(), pa.int32(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.string()]
                columns = [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)]
                yield pa.RecordBatch.from_arrays([b.column(0), *columns, *[b.column(2 + i) for i in range(len(rest))]], names=schema.names)

    return media.select(F.col(id_col).alias("id"), media_col, *rest).mapInArrow(run, schema)


def resampled(media: DataFrame, id_col: str = "id", media_col: str = "media") -> DataFrame:
    """id, wav, rate, n_samples, error: the sound of each medium as a WAV file of 16-bit PCM, written to the shared folder; other columns of media follow.

    It takes 2 bytes a sample before compression: 4 for each byte of mu-law or A-law, 7.6 for one of ADPCM.
    """
    sound = decoded(media, id_col, media_col).drop("codec", "payload", "peak", "energy", "crossings")

    @F.arrow_udf("binary")
    def wav(pcm: pa.Array, rate: pa.Array) -> pa.Array:
        return pa.array([None if x is None else pcm_wav(x, r) for x, r in zip(pcm.to_pylist(), rate.to_pylist(), strict=True)], pa.binary())

    rest = [c for c in sound.columns if c not in ("id", "pcm", "rate", "n_samples", "error")]
    return common.written(sound.select("id", wav("pcm", "rate").alias("wav"), "rate", "n_samples", "error", *rest), "media-pcm")


def op4(docs: DataFrame) -> DataFrame:
    """Digests of each text's payload as read back, of its stored form, and of its sound."""
    kept = stored(docs)
    back = decoded(kept.withColumn("media_bytes", F.length("media").cast("long")).withColumn("media_sha256", F.sha2("media", 256)))
    feature = F.concat_ws("|", "codec", *[F.col(c).cast("string") for c in ("rate", "n_samples", "peak", "energy", "crossings")], F.lower(F.hex(F.crc32("pcm"))))
    return back.select(
        F.col("id").alias("doc_id"),
        "n_bytes",
        F.length("payload").cast("long").alias("payload_bytes"),
        F.sha2("payload", 256).alias("payload_sha256"),
        F.crc32(F.expr(f"substring(payload, greatest(length(payload) - {UNIT - 1}, 1), {UNIT})")).alias("tail_crc32"),
        "media_bytes",
        "media_sha256",
        feature.alias("feature"),
    )
