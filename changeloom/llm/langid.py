"""Operator 10: language identification by compression.

For every language blocks of its texts fill two raw-content zstandard dictionaries.  They come from the whole
texts of a bounded sample of labelled rows (about SAMPLE_TEXTS a language); of the blocks those with the smallest
hashes are taken, so that a long text has no more weight than its share.  Texts are
reduced to lower-case words of letters with single spaces between, so that markup, digits and casing
carry no weight.  A text is compressed with both dictionaries of each language and belongs to the language that makes
it smallest in sum; where the margin over the runner-up is narrow the answer is flagged as not accepted.

Defined results: ``und`` (score 0, not accepted) for null texts and texts without a letter (a character of a letter
category; ``½`` or ``①`` are none); equal sizes are settled by the language's name; repeated rows
get equal answers; every language with a labelled text is learned; with no labelled row every answer is ``und``; an
empty table gives no rows; other columns are ignored (``keep_accepted`` passes them through).
"""

from __future__ import annotations

import math
import re

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from changeloom.llm.common import alone, checkpointed, crc32_of, kept_by, read, small_side

#: About so many texts of a language are learned from (all, if it has no more), those with the smallest hashes.
SAMPLE_TEXTS = 800
#: Each of a language's two dictionaries has at most DICTIONARY_BYTES, in blocks of SAMPLE_BLOCK bytes.
DICTIONARY_BYTES = 256 * 1024
SAMPLE_BLOCK = 1024
LEVEL = 3
#: Smallest share of the runner-up's size that an accepted answer saves.
MARGIN = 0.004
#: Longer texts are compressed in even blocks of at most so many bytes, each with a fresh dictionary: what a
#: dictionary saves on one text is bounded, so the margin would shrink with the length.
BLOCK_BYTES = 64 * 1024
_words = re.compile(r"[^\W\d_]+")
_compressors: dict[int, list] = {}


def letters(text: str) -> bytes:
    """The words of a text in lower case, each between single spaces."""
    found = " ".join(_words.findall(text.lower()))
    if found and not found.replace(" ", "").isalpha():  # number characters that aren't digits
        found = " ".join("".join(c if c.isalpha() else " " for c in found).split())
    return f" {found} ".encode("utf-8", "replace") if found else b""


def sample_blocks(batches):
    """``lang, h, block``: of each language's texts (``lang, text``) in these batches the blocks with the smallest hashes."""
    import xxhash

    most, kept = 2 * DICTIONARY_BYTES // SAMPLE_BLOCK, {}
    for batch in batches:
        for lang, text in zip(*[c.to_pylist() for c in batch.columns]):
            raw = letters(text)
            own = kept.setdefault(lang, {}) if raw else {}
            for k in range(0, len(raw), SAMPLE_BLOCK):
                block = raw[k : k + SAMPLE_BLOCK]
                own[xxhash.xxh3_64_intdigest(block) >> 1] = block
                if len(own) > 2 * most:
                    kept[lang] = own = dict(sorted(own.items())[:most])
    for lang, own in kept.items():
        rows = sorted(own.items())[:most]
        yield pa.RecordBatch.from_arrays([pa.array([lang] * len(rows)), pa.array([h for h, _ in rows], pa.int64()), pa.array([b for _, b in rows], pa.binary())], ["lang", "h", "block"])


def fit(docs: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang") -> dict[str, tuple[bytes, bytes]]:
    """Two dictionaries for each language, at most 2 * DICTIONARY_BYTES of them on the driver."""
    known = docs.where(F.col(lang).isNotNull() & F.col(text).isNotNull()).select(F.col(lang).alias("lang"), F.col(text).alias("text"), F.pmod(F.xxhash64(F.col(key)), F.lit(1 << 30)).alias("_u"))
    cuts = small_side(checkpointed(known.groupBy("lang").agg((F.lit(float(SAMPLE_TEXTS << 30)) / F.count(F.lit(1))).alias("_cut"))))
    rows = known.join(cuts, "lang").where(F.col("_u") < F.col("_cut")).select("lang", "text")
    found = rows.mapInArrow(sample_blocks, "lang string, h long, block binary").distinct()
    place = F.row_number().over(W.partitionBy("lang").orderBy("h"))  # over the blocks of the sample alone
    found = found.withColumn("_r", place).where(F.col("_r") <= 2 * DICTIONARY_BYTES // SAMPLE_BLOCK)
    blocks: dict[str, list] = {}
    for r in found.select("lang", "h", "block").collect():
        blocks.setdefault(r["lang"], []).append((r["h"], bytes(r["block"])))
    return {k: tuple(b"".join(b for _, b in sorted(v)[half::2]) for half in (0, 1)) for k, v in sorted(blocks.items())}


def _load(model: dict[str, tuple[bytes, bytes]]) -> list:
    """Compressors for each language, made once in a worker for each model."""
    import zstandard as z

    alone(_compressors.clear)
    ident = hash(tuple((k, *v) for k, v in model.items()))
    if ident not in _compressors:
        _compressors.clear()
        make = lambda raw: z.ZstdCompressor(level=LEVEL, dict_data=z.ZstdCompressionDict(raw, dict_type=z.DICT_TYPE_RAWCONTENT), write_content_size=False, write_dict_id=False, write_checksum=False)
        _compressors[ident] = [(k, make(a or b" "), make(b or a or b" ")) for k, (a, b) in model.items()]  # the second is empty where a language has one block
    return _compressors[ident]


def classify(text: str | None, loaded: list) -> tuple[str, float, bool]:
    """Language, score in (0, 1] and whether the margin is wide enough."""
    raw = letters(text) if text and loaded else b""
    if not raw:
        return "und", 0.0, False
    parts = -(-len(raw) // BLOCK_BYTES)
    blocks = [raw[len(raw) * i // parts : len(raw) * (i + 1) // parts] for i in range(parts)]
    sizes = [(sum(len(a.compress(x)) + len(b.compress(x)) for x in blocks), k) for k, a, b in loaded]
    sizes.sort()
    best = sizes[0]
    if len(sizes) == 1:
        return best[1], 1.0, True
    share = sum(math.exp(max(best[0] - s, -700) / max(best[0], 1) * 40) for s, _ in sizes)
    return best[1], 1 / share, (sizes[1][0] - best[0]) >= MARGIN * sizes[1][0]


def predict(docs: DataFrame, model: dict, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key, lang_pred, score, accepted`` for every row."""

    sent = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        loaded = _load(sent.value)
        for batch in batches:
            out = [classify(t.as_py(), loaded) for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), *[pa.array([o[i] for o in out], t) for i, t in enumerate((pa.string(), pa.float64(), pa.bool_()))]], [key, "lang_pred", "score", "accepted"])

    return docs.select(key, text).mapInArrow(run, f"`{key}` {docs.schema[key].dataType.simpleString()}, lang_pred string, score double, accepted boolean")


def keep_accepted(docs: DataFrame, model: dict, text: str = "text") -> DataFrame:
    """The rows of ``docs`` whose language is known by a wide enough margin, with all their columns."""

    sent = docs.sparkSession.sparkContext.broadcast(model)

    def accepted():
        loaded = _load(sent.value)
        return lambda t: classify(t, loaded)[2]

    return kept_by(docs, text, accepted)


def op10_zstd_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    held_out = crc32_of("doc_id") % 4 == 2
    model = fit(docs.where(~held_out).select("doc_id", "text", "lang"))
    return predict(docs, model).select("doc_id", held_out.alias("held_out"), "lang_pred", "score", "accepted")
