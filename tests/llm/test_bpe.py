import base64
import hashlib

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F

from changeloom.llm import bpe


@pytest.fixture(scope="module")
def exact():
    with open(public_tokenizers.path("byte_bpe_50k.tiktoken"), "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


TEXTS = [None, "", " ", "a", "Hello  world\n\n\tI'm 42's <|endoftext|>", "éèà ç 漢字 👩‍👩‍👧 \x00\x1c\x85 x", "aaaa" * 500, "́e ﻿", "x" * 3000 + " 1" * 50]


def test_matches_the_exact_encoder_and_round_trips(spark, exact):
    df = spark.createDataFrame([(i, t, 7) for i, t in enumerate(TEXTS)] * 2, "doc_id long, text string, ids int")
    for row in bpe.digest(df).collect():
        text = TEXTS[row.doc_id] or ""
        ids = exact.encode_ordinary(text)
        assert row.n_tokens == len(ids)
        assert row.ids_sha256 == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert row.decoded_sha256 == hashlib.sha256(text.encode()).hexdigest()


def test_every_code_point_in_context(exact):
    model = bpe.model()
    for start in range(0, 0x3100, 7):
        text = "".join(f"a{chr(c)}b {chr(c)}1{chr(c)}! " for c in range(start, start + 7))
        assert model.encode(text).tolist() == exact.encode_ordinary(text)


def test_encode_offsets_and_decode(spark):
    df = spark.createDataFrame([(1, "né 漢字👩 ok", "c")], "doc_id long, text string, N_TOKENS string")
    out = bpe.decode(bpe.encode(df, with_offsets=True)).first()
    assert bytes(out.decoded).decode() == "né 漢字👩 ok"
    assert out.offsets[0].begin == 0 and out.offsets[-1].end == len("né 漢字👩 ok") and len(out.offsets) == out.n_tokens
    assert "".join(bpe.model().decode_stream(out.ids)) == "né 漢字👩 ok"


def test_empty_table(spark):
    assert bpe.digest(spark.createDataFrame([], "doc_id long, text string")).count() == 0
    assert bpe.encode(spark.createDataFrame([(1, "x")], "doc_id long, text string")).select(F.size("ids")).first()[0] == 1
