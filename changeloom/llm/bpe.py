"""Operator 1: byte-level BPE encoding and decoding.

Texts travel in Arrow batches.  A pattern cuts a text into pieces, every piece is written in the
byte-to-character alphabet and merged by the ``tokenizers`` library (piece results are kept in a
bounded per-worker cache), and decoding reverses the byte table.

Defined results: a null or empty text has no ids and decodes to no bytes; other columns pass through
``encode`` untouched and clashing output names are replaced by the operator's; repeated rows are
encoded independently.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from changeloom.llm.common import alone, read

#: Pieces that one Python worker remembers in each of two generations; what the younger one doesn't ask for goes with the older.
CACHE_PIECES = 200_000
#: Ids that are decoded at once.
DECODE_IDS = 1 << 16
#: Longer pieces are encoded each time and never remembered.
CACHE_PIECE_CHARS = 64


def byte_alphabet() -> dict[int, str]:
    """One printable character for every byte: printable Latin-1 stands for itself, the rest is shifted past U+0100."""
    printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    table = {b: chr(b) for b in printable}
    for n, b in enumerate(b for b in range(256) if b not in table):
        table[b] = chr(0x100 + n)
    return table


class ByteBpe:
    """A rank file as a ``tokenizers`` model plus the two byte tables."""

    def __init__(self, rank_file: str, pattern: str):
        import regex
        from tokenizers import Tokenizer, models

        with open(rank_file, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        to_char = byte_alphabet()
        self.to_char = {b: to_char[b] for b in range(256)}
        spell = lambda raw: "".join(map(to_char.__getitem__, raw))
        merges = []
        for raw, rank in sorted(ranks.items(), key=lambda x: x[1]):
            if len(raw) > 1:
                left, right = self._last_merge(raw, rank, ranks)
                merges.append((spell(left), spell(right)))
        self.model = Tokenizer(models.BPE(vocab={spell(t): r for t, r in ranks.items()}, merges=merges, ignore_merges=True, cache_capacity=0))
        self.bytes_of = [b""] * (max(ranks.values()) + 1)
        for raw, rank in ranks.items():
            self.bytes_of[rank] = raw
        self.translate = {i: to_char[i] for i in range(256)}
        self.find = regex.compile(pattern).findall
        self.pieces: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}
        size = np.array([len(raw) for raw in self.bytes_of], np.int64)
        self.joined, self.size, self.start = np.frombuffer(b"".join(self.bytes_of), np.uint8), size, np.cumsum(size) - size

    @staticmethod
    def _last_merge(raw: bytes, rank: int, ranks: dict[bytes, int]) -> tuple[bytes, bytes]:
        """The two tokens whose merge makes ``raw``: merge its bytes by the ranks below its own."""
        parts = [raw[i : i + 1] for i in range(len(raw))]
        while len(parts) > 2:
            best = min(range(len(parts) - 1), key=lambda i: r if (r := ranks.get(parts[i] + parts[i + 1], rank)) < rank else rank)
            parts[best : best + 2] = [parts[best] + parts[best + 1]]
        return parts[0], parts[1]

    def _spelled(self, piece: str) -> str:
        return piece.encode("utf-8").decode("latin-1").translate(self.translate)

    def _learn(self, pieces: list[str]) -> None:
        for k in range(0, len(pieces), 4096):
            part = pieces[k : k + 4096]
            for piece, enc in zip(part, self.model.encode_batch([self._spelled(p) for p in part], add_special_tokens=False)):
                self.pieces[piece] = np.array(enc.ids, "<u4").tobytes()

    def encode_bytes(self, text: str | None) -> bytes:
        """The ids as little-endian unsigned 32-bit integers."""
        found = self.find(text) if text else []
        new = set(found).difference(self.pieces)
        if len(self.pieces) + len(new) > CACHE_PIECES:
            self.older, self.pieces, new = self.pieces, {}, set(found)
        older = {p for p in new if p in self.older}
        self.pieces.update((p, self.older[p]) for p in older)
        self._learn(list(new - older))
        out = b"".join([self.pieces[p] for p in found])
        for p in new:
            if len(p) > CACHE_PIECE_CHARS:
                self.pieces.pop(p, None)
        return out

    def encode(self, text: str | None) -> np.ndarray:
        return np.frombuffer(self.encode_bytes(text), "<u4")

    def decode_bytes(self, ids) -> bytes:
        ids, out = np.asarray(ids, np.int64), []
        for k in range(0, len(ids), DECODE_IDS):
            part = ids[k : k + DECODE_IDS]
            size = self.size[part]
            at = np.repeat(self.start[part] - (np.cumsum(size) - size), size)
            out.append(self.joined[at + np.arange(len(at))].tobytes())
        return b"".join(out)

    def offsets(self, ids) -> list[tuple[int, int]]:
        """Code-point span of each id; ids inside one split character share that character's span."""
        spans, chars = [], 0
        for i in ids:
            raw = self.bytes_of[int(i)]
            starts = sum((b & 0xC0) != 0x80 for b in raw)
            begin = chars if raw and (raw[0] & 0xC0) != 0x80 else max(chars - 1, 0)
            chars += starts
            spans.append((begin, chars))
        return spans

    def decode_stream(self, ids) -> Iterator[str]:
        """Text of each id; bytes of a character split over ids wait for the id that completes it."""
        import codecs

        decoder = codecs.getincrementaldecoder("utf-8")("replace")
        for i in ids:
            yield decoder.decode(self.bytes_of[int(i)])
        if rest := decoder.decode(b"", True):
            yield rest


@lru_cache(maxsize=4)
def _model(rank_file: str | None, pattern: str | None) -> ByteBpe:
    import public_tokenizers

    return ByteBpe(rank_file or public_tokenizers.path("byte_bpe_50k.tiktoken"), pattern or public_tokenizers.PATTERN)


def model(rank_file: str | None = None, pattern: str | None = None) -> ByteBpe:
    """The model of a rank file and a pattern; by default the public ones, which each worker finds for itself."""
    alone(_model.cache_clear)
    return _model(rank_file, pattern)


def encode(df: DataFrame, text: str = "text", rank_file: str | None = None, pattern: str | None = None, with_offsets: bool = False) -> DataFrame:
    """Adds ``ids array<int>``, ``n_tokens long`` and, on request, ``offsets array<struct<begin,end>>``."""
    schema = "ids array<int>, n_tokens long" + ", offsets array<struct<begin:int,end:int>>" * with_offsets

    @F.pandas_udf(f"struct<{schema.replace('ids array', 'ids:array').replace('n_tokens long', 'n_tokens:long').replace('offsets array', 'offsets:array')}>")
    def enc(texts):
        import pandas as pd

        bpe, rows = model(rank_file, pattern), []
        for t in texts:
            ids = bpe.encode(t)
            rows.append((ids.astype("int32"), len(ids), *([[(a, b) for a, b in bpe.offsets(ids)]] if with_offsets else [])))
        return pd.DataFrame(rows, columns=["ids", "n_tokens", "offsets"][: 2 + with_offsets])

    kept = [c for c in df.columns if c.lower() not in ("ids", "n_tokens", "offsets", "_bpe")]
    return df.withColumn("_bpe", enc(F.col(text))).select(*[F.col(f"`{c}`") for c in kept], "_bpe.*")


def decode(df: DataFrame, ids: str = "ids", rank_file: str | None = None, pattern: str | None = None) -> DataFrame:
    """Adds ``decoded binary``; null ids decode to no bytes."""

    @F.pandas_udf("binary")
    def dec(column):
        import pandas as pd

        bpe = model(rank_file, pattern)
        return pd.Series([b"" if x is None else bpe.decode_bytes(x) for x in column])

    return df.withColumn("decoded", dec(F.col(ids)))


def digest(df: DataFrame, key: str = "doc_id", text: str = "text", rank_file: str | None = None, pattern: str | None = None) -> DataFrame:
    """Encodes and decodes every text in one pass and keeps only digests of the ids and of the decoded bytes."""
    field = df.schema[key]

    def run(batches):
        bpe = model(rank_file, pattern)
        for batch in batches:
            n, ids_sha, dec_sha = [], [], []
            for value in batch.column(1):
                packed = bpe.encode_bytes(value.as_py())
                n.append(len(packed) // 4)
                ids_sha.append(hashlib.sha256(packed).hexdigest())
                dec_sha.append(hashlib.sha256(bpe.decode_bytes(np.frombuffer(packed, "<u4"))).hexdigest())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n, pa.int64()), pa.array(ids_sha, pa.string()), pa.array(dec_sha, pa.string())], [key, "n_tokens", "ids_sha256", "decoded_sha256"])

    return df.select(key, text).mapInArrow(run, f"`{key}` {field.dataType.simpleString()}, n_tokens long, ids_sha256 string, decoded_sha256 string")


def op1_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digest(read(spark, sf_dir, "documents"))
