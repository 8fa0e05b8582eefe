import hashlib
import zlib

import numpy as np
import pytest

from changeloom.llm import audio


def test_laws_match_their_definition():
    mu, a = audio.TABLES[audio.MU_LAW], audio.TABLES[audio.A_LAW]
    assert mu[0x00] == -32124 and mu[0x80] == 32124 and mu[0xFF] == 0 and mu[0x7F] == 0
    assert a[0xD5] == 8 and a[0x55] == -8 and a[0xAA] == 32256 and a[0x2A] == -32256
    assert len(set(mu.tolist())) == 255 and len(set(a.tolist())) == 256


def ima_by_sample(block):
    value, index = int.from_bytes(block[:2], "little", signed=True), min(block[2], 88)
    out = [value]
    for byte in block[4:]:
        for code in (byte & 15, byte >> 4):
            step = int(audio.IMA_STEPS[index])
            change = (step >> 3) + (step if code & 4 else 0) + (step >> 1 if code & 2 else 0) + (step >> 2 if code & 1 else 0)
            value = max(-32768, min(32767, value - change if code & 8 else value + change))
            index = max(0, min(88, index + [-1, -1, -1, -1, 2, 4, 6, 8][code & 7]))
            out.append(value)
    return out


def test_adpcm_across_blocks_equals_sample_by_sample():
    data = np.random.default_rng(1).integers(0, 256, 64 * 9, np.uint8).tobytes()
    want = [x for k in range(0, len(data), 64) for x in ima_by_sample(data[k : k + 64])]
    assert audio.decode_adpcm(data).tolist() == want
    media = audio.wave(data, audio.IMA_ADPCM, block=64, bits=4)
    assert np.concatenate(list(audio.decoded_chunks(media))).tolist() == want


def test_resampling_and_pcm():
    x = np.array([0, 100, -100, 50], np.int16)
    assert audio.resample(x).tolist() == [0, 50, 100, 0, -100, -25, 50, 50]
    assert len(audio.resample(x, 8000, 12000)) == 6
    law, rate, block, data = audio.unwave(audio.to_pcm(audio.wave(bytes(range(256)), audio.MU_LAW)))
    assert (law, rate, block, len(data)) == (audio.PCM, 16000, 2, 1024)
    with pytest.raises(ValueError):
        audio.unwave(b"no file")


def test_resampling_in_pieces_equals_the_whole(monkeypatch):
    x = np.random.default_rng(2).integers(-32768, 32768, 1000, np.int64).astype(np.int16)
    for source, target in ((8000, 16000), (8000, 12000), (8000, 44100), (16000, 8000), (11025, 8000), (8000, 8000)):
        at = np.arange(len(x) * target // source) * source
        left = at // target
        a, b, f = x[left].astype(int), x[np.minimum(left + 1, len(x) - 1)].astype(int), at % target
        want = ((a * (target - f) + b * f) // target).tolist()
        for cut in (1, 7, 64, 999, 5000):
            got = np.concatenate([*audio.resampled([x[k : k + cut] for k in range(0, len(x), cut)], source, target)])
            assert got.tolist() == want, (source, target, cut)
    for law in audio.CODINGS:
        media = audio.wave(x.tobytes()[:1984], law, block=64 if law == audio.IMA_ADPCM else 1)
        want = audio.to_pcm(media)
        monkeypatch.setattr(audio, "CHUNK", 100)
        assert audio.to_pcm(media) == want
        monkeypatch.setattr(audio, "CHUNK", 1 << 18)
        assert audio.to_pcm_all([media, media, audio.wave(b"\1" * 64, audio.IMA_ADPCM, block=64)])[:2] == [want, want]


def by_sample(payload, law):
    """Decoded, doubled by interpolation: one sample after the other."""
    if law == audio.IMA_ADPCM:
        x = [v for k in range(0, len(payload), 64) for v in ima_by_sample(payload[k : k + 64])]
    else:
        x = [int(audio.TABLES[law][b]) for b in payload]
    return [v for a, b in zip(x, [*x[1:], x[-1]]) for v in (a, (a + b) // 2)]


def test_query_rows(spark):
    texts = [None, "", "é" * 32, "x" * 64, "y" * 65, "long " * 60_000, "x" * 64, *[f"text {i} " * i for i in range(1, 30)]]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").selectExpr("*", "1 as media", "2 as pcm")
    rows = {r.doc_id: r for r in audio.described(audio.with_media(df)).collect()}
    assert len(rows) == len(texts) and {r.coding for r in rows.values()} == set(audio.NAMES.values())
    for i, t in enumerate(texts):
        raw = (t or "").encode()
        payload = raw + b"\0" * (max(-(-len(raw) // 64), 1) * 64 - len(raw))
        r = rows[i]
        assert (r.n_bytes, r.payload_bytes) == (len(raw), len(payload))
        assert r.payload_sha256 == hashlib.sha256(payload).hexdigest() and r.tail_crc32 == zlib.crc32(payload[-64:])
        assert r.media_bytes > len(payload)
        law = audio.CODINGS[zlib.crc32(payload) % 3]
        x = by_sample(payload, law)
        crossings = sum((a < 0) != (b < 0) for a, b in zip(x, x[1:]))
        crc = zlib.crc32(np.array(x, "<i2").tobytes())
        assert r.coding == audio.NAMES[law] and r.feature == f"n={len(x)};power={sum(v * v for v in x) // len(x)};peak={max(map(abs, x))};crossings={crossings};crc32={crc}"
        assert r.pcm_bytes == 2 * len(x) + 44
    assert rows[3].feature == rows[6].feature and rows[3].media_sha256 == rows[6].media_sha256
    assert audio.described(audio.with_media(df.limit(0))).count() == 0


def test_query_equals_its_steps(spark, tmp_path):
    rows = [(i, "text " * (i * 37 % 400)) for i in range(700)]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    df = spark.read.parquet(str(tmp_path / "documents.parquet"))
    assert sorted(audio.op9_telephony(spark, str(tmp_path)).collect()) == sorted(audio.described(audio.with_media(df)).collect())
