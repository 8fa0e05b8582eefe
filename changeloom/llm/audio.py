"""Operator 9: telephony audio in media columns.

Mu-law and A-law samples are expanded by lookup tables, IMA ADPCM is decoded with numpy across the blocks
of all files of a batch (one step of all blocks at a time), and decoded audio is resampled and stored as 16-bit PCM.
Stored audio is a RIFF/WAVE file in a binary column, so a row keeps its media with it and survives recomputation.

The query stores each text as coded samples, in one of the three codings by the CRC of its payload, and beside them
the PCM file that they decode to.  All codes are legal in each coding, so the stored form is lossless
for any bytes.  Decoding and resampling go through blocks of samples and carry their state on, so results don't
depend on the block size.

Defined results: null and empty texts become 64 zero bytes; digests and features are of the files read back;
equal texts have equal media and features; repeated rows are stored each; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import struct
import zlib

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import DataFrame, SparkSession

from changeloom.llm.common import read

MU_LAW, A_LAW, IMA_ADPCM, PCM = 7, 6, 17, 1
RATE, STORED_RATE = 8000, 16000
UNIT = 64
#: Samples that are expanded and resampled at once.
CHUNK = 1 << 18
#: Rows and bytes of text that are coded together, about.
PART_ROWS, PART_BYTES = 256, 1 << 20
CODINGS = (MU_LAW, A_LAW, IMA_ADPCM)
NAMES = {MU_LAW: "mu-law", A_LAW: "a-law", IMA_ADPCM: "ima-adpcm"}

# Fixed values of the IMA ADPCM format: step sizes and the change of the step index by code.
IMA_STEPS = np.array(
    "7 8 9 10 11 12 13 14 16 17 19 21 23 25 28 31 34 37 41 45 50 55 60 66 73 80 88 97 107 118 130 143 157 173 190 209 230 253 279 307 337 371 408 449 494 544 598 658 724 796 876 963 1060 "
    "1166 1282 1411 1552 1707 1878 2066 2272 2499 2749 3024 3327 3660 4026 4428 4871 5358 5894 6484 7132 7845 8630 9493 10442 11487 12635 13899 15289 16818 18500 20350 22385 24623 27086 29794 32767".split(),
    np.int32,
)
IMA_INDEX = np.array([-1, -1, -1, -1, 2, 4, 6, 8] * 2, np.int32)


def mu_law_table() -> np.ndarray:
    """16-bit value of each mu-law code (complemented sign, 3 bits of exponent, 4 of mantissa, bias 132)."""
    code = ~np.arange(256) & 0xFF
    value = ((((code & 15) << 3) + 132) << ((code >> 4) & 7)) - 132
    return np.where(code & 0x80, -value, value).astype(np.int16)


def a_law_table() -> np.ndarray:
    """16-bit value of each A-law code (even bits inverted; no exponent bias in the first segment)."""
    code = np.arange(256) ^ 0x55
    exponent, mantissa = (code >> 4) & 7, ((code & 15) << 4) + 8
    value = np.where(exponent == 0, mantissa, (mantissa + 256) << np.maximum(exponent - 1, 0))
    return np.where(code & 0x80, value, -value).astype(np.int16)


TABLES = {MU_LAW: mu_law_table(), A_LAW: a_law_table()}


def decode_adpcm(data: bytes, block: int = UNIT) -> np.ndarray:
    """Mono IMA ADPCM blocks -> int16 samples, ``2 * block - 7`` from each; all blocks advance together."""
    raw = np.frombuffer(data, np.uint8)[: len(data) // block * block].reshape(-1, block)
    value = raw[:, :2].copy().view("<i2")[:, 0].astype(np.int32)
    index = np.minimum(raw[:, 2], 88).astype(np.int32)
    codes = np.stack([raw[:, 4:] & 15, raw[:, 4:] >> 4], axis=2).reshape(len(raw), -1).T
    out = np.empty((codes.shape[0] + 1, len(raw)), np.int16)
    out[0] = value
    for k, code in enumerate(np.ascontiguousarray(codes), 1):
        step, size = IMA_STEPS[index], code & 7
        change = (step >> 3) + np.where(size & 4, step, 0) + np.where(size & 2, step >> 1, 0) + np.where(size & 1, step >> 2, 0)
        value = np.clip(np.where(code & 8, value - change, value + change), -32768, 32767)
        index = np.clip(index + IMA_INDEX[code], 0, 88)
        out[k] = value
    return out.T.reshape(-1)


def resampled(chunks, source: int = RATE, target: int = STORED_RATE):
    """int16 -> int16 by linear interpolation in integers, in pieces: the same samples however the input is cut (the last one is held)."""
    rest, begin, done = np.empty(0, np.int64), 0, 0  # samples still needed, the index of the first, samples made

    def between(stop: int) -> np.ndarray:
        at = np.arange(done, stop, dtype=np.int64) * source
        left, over = at // target - begin, at % target
        right = np.minimum(left + 1, len(rest) - 1)
        return ((rest[left] * (target - over) + rest[right] * over) // target).astype(np.int16)

    for x in chunks:
        if not len(x):
            continue
        rest = np.concatenate([rest, x.astype(np.int64)])
        last = begin + len(rest) - 1
        stop = max(done, -(-last * target // source))  # from here on the right neighbour isn't known yet
        if stop > done:
            yield between(stop)
            done = stop
        rest, begin = rest[done * source // target - begin :], done * source // target
    stop = (begin + len(rest)) * target // source
    if len(rest) and stop > done:
        yield between(stop)


def resample(x: np.ndarray, source: int = RATE, target: int = STORED_RATE) -> np.ndarray:
    return np.concatenate([np.empty(0, np.int16), *resampled([x], source, target)])


def wave(data: bytes, law: int, rate: int = RATE, block: int = 1, bits: int = 8) -> bytes:
    """A mono RIFF/WAVE file around already coded samples."""
    extra = struct.pack("<HH", 2, 2 * block - 7) if law == IMA_ADPCM else b"" if law == PCM else struct.pack("<H", 0)
    per_s = rate * block if law != IMA_ADPCM else rate * block // (2 * block - 7)
    fmt = struct.pack("<HHIIHH", law, 1, rate, per_s, block, bits) + extra
    units = len(data) if law == MU_LAW or law == A_LAW else len(data) // block * (2 * block - 7 if law == IMA_ADPCM else 1)
    fact = b"" if law == PCM else b"fact" + struct.pack("<II", 4, units)
    body = b"WAVEfmt " + struct.pack("<I", len(fmt)) + fmt + fact + b"data" + struct.pack("<I", len(data)) + data + b"\0" * (len(data) & 1)
    return b"RIFF" + struct.pack("<I", len(body)) + body


def unwave(media: bytes) -> tuple[int, int, int, memoryview]:
    """Format tag, rate, block size and the coded samples of a RIFF/WAVE file."""
    if media[:4] != b"RIFF" or media[8:12] != b"WAVE":
        raise ValueError("not a RIFF/WAVE file")
    at, law, rate, block, view = 12, 0, 0, 1, memoryview(media)
    while at + 8 <= len(media):
        name, size = media[at : at + 4], struct.unpack_from("<I", media, at + 4)[0]
        if name == b"fmt ":
            law, _, rate, _, block = struct.unpack_from("<HHIIH", media, at + 8)
        elif name == b"data":
            return law, rate, block, view[at + 8 : at + 8 + size]
        at += 8 + size + (size & 1)
    raise ValueError("no data chunk")


def decoded_chunks(media: bytes):
    """int16 samples of a file, in order, in pieces of bounded size."""
    law, _, block, data = unwave(media)
    step = max(CHUNK // block, 1) * block
    for k in range(0, max(len(data), 1), step):
        part = data[k : k + step]
        yield TABLES[law][np.frombuffer(part, np.uint8)] if law in TABLES else decode_adpcm(bytes(part), block) if law == IMA_ADPCM else np.frombuffer(part, "<i2")


def to_pcm(media: bytes, rate: int = STORED_RATE) -> bytes:
    """The file decoded, resampled and stored as a 16-bit PCM file."""
    source = unwave(media)[1]
    return wave(b"".join(x.astype("<i2").tobytes() for x in resampled(decoded_chunks(media), source, rate)), PCM, rate, 2, 16)


def to_pcm_all(files: list[bytes], rate: int = STORED_RATE) -> list[bytes]:
    """:func:`to_pcm` of many files; the ADPCM blocks of all short ones with one block size are decoded together."""
    out, together = [b""] * len(files), {}
    for i, f in enumerate(files):
        law, source, block, data = unwave(f)
        if law == IMA_ADPCM and len(data) <= CHUNK:
            together.setdefault((source, block), []).append((i, data[: len(data) // block * block]))
        else:
            out[i] = to_pcm(f, rate)
    for (source, block), parts in together.items():
        samples = decode_adpcm(b"".join(d for _, d in parts), block)
        ends = np.cumsum([len(d) // block * (2 * block - 7) for _, d in parts])
        for (i, _), x in zip(parts, np.split(samples, ends[:-1])):
            out[i] = wave(resample(x, source, rate).astype("<i2").tobytes(), PCM, rate, 2, 16)
    return out


def features(pcm: bytes) -> str:
    """Level, peak, zero crossings and checksum of a PCM file's samples, in integers."""
    n = power = peak = crossings = crc = 0
    last = None
    for x in decoded_chunks(pcm):
        wide = x.astype(np.int64)
        n, power = n + len(x), power + int((wide * wide).sum())
        peak = max(peak, int(np.abs(wide).max(initial=0)))
        sign = x < 0
        crossings += int((sign[1:] != sign[:-1]).sum()) + (last is not None and len(x) > 0 and bool(sign[0]) != last)
        last = bool(sign[-1]) if len(x) else last
        crc = zlib.crc32(x.tobytes(), crc)
    return f"n={n};power={power // max(n, 1)};peak={peak};crossings={crossings};crc32={crc}"


def store(text: bytes) -> bytes:
    """The payload of a text (zeros up to a positive multiple of 64) as a file in the coding that its CRC names."""
    payload = text + b"\0" * (-len(text) % UNIT or (0 if text else UNIT))
    law = CODINGS[zlib.crc32(payload) % len(CODINGS)]
    return wave(payload, law, block=UNIT, bits=4) if law == IMA_ADPCM else wave(payload, law)


def _parts(batches, column: int, rows: int = PART_ROWS, most: int = PART_BYTES):
    """Slices of batches with at most ``rows`` rows and about ``most`` bytes in a column."""
    for batch in batches:
        size = pa.compute.fill_null(pa.compute.binary_length(batch.column(column)), 0).to_pylist()
        begin = held = 0
        for i, n in enumerate(size):
            if i > begin and (i - begin >= rows or held + n > most):
                yield batch.slice(begin, i - begin)
                begin, held = i, 0
            held += n
        if batch.num_rows > begin:
            yield batch.slice(begin)


CODED = "n_bytes long, media binary, pcm binary"
DESCRIBED = "n_bytes long, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string, coding string, pcm_bytes long, pcm_sha256 string"


def code(batches):
    """``key, text`` batches -> ``key, n_bytes, media, pcm``, in parts of bounded size."""
    for part in _parts(batches, 1):
        raw = [(t.as_py() or "").encode("utf-8", "replace") for t in part.column(1)]
        media = list(map(store, raw))
        yield pa.RecordBatch.from_arrays([part.column(0), pa.array(map(len, raw), pa.int64()), pa.array(media, pa.binary()), pa.array(to_pcm_all(media), pa.binary())], [part.schema.names[0], "n_bytes", "media", "pcm"])


def describe(batches):
    """Coded batches -> digests of payload and files, the coding, and features of the samples, all of the files read back."""
    fields = [x.split() for x in DESCRIBED.split(", ")][1:]
    for batch in batches:
        out = []
        for m, p in zip(batch.column(2), batch.column(3)):
            file, pcm = m.as_py(), p.as_py()
            law, _, _, data = unwave(file)
            out.append((len(data), hashlib.sha256(data).hexdigest(), zlib.crc32(data[-UNIT:]), len(file), hashlib.sha256(file).hexdigest(), features(pcm), NAMES[law], len(pcm), hashlib.sha256(pcm).hexdigest()))
        arrays = [pa.array([o[i] for o in out], pa.int64() if t == "long" else pa.string()) for i, (_, t) in enumerate(fields)]
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *arrays], [batch.schema.names[0], "n_bytes", *[n for n, _ in fields]])


def _mapped(df: DataFrame, columns: list[str], f, schema: str) -> DataFrame:
    return df.select(*columns).mapInArrow(f, f"`{columns[0]}` {df.schema[columns[0]].dataType.simpleString()}, {schema}")


def with_media(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key, n_bytes, media, pcm``: binary columns of WAVE files, the coded samples and what they decode to."""
    return _mapped(docs, [key, text], code, CODED)


def described(media: DataFrame, key: str = "doc_id") -> DataFrame:
    """:func:`describe` for a table that :func:`with_media` made."""
    return _mapped(media, [key, "n_bytes", "media", "pcm"], describe, DESCRIBED)


def op9_telephony(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The media columns go from one step to the other as Arrow batches in the worker: they are several times the text."""
    return _mapped(read(spark, sf_dir, "documents"), ["doc_id", "text"], lambda batches: describe(code(batches)), DESCRIBED)
