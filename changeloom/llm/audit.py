"""Operator 11: how filters interact, audited over every order of them.

Each document gets one bit for every filter that it fails.  Four filters are answered by scanning the Arrow buffers of
the texts with numpy: bytes are classed by a table (white space, capitals, symbols, first byte of a character), prefix sums
of the classes at the ends of documents give the counts, and hashes of a document's words, sorted and verified byte by
byte, give its distinct words.  The fifth filter (a text that an earlier document has) compares digests over the whole table.
The bits then reduce to 32 masks a part, counted on the map side, from which every order and step follows by arithmetic.

Defined results: a null text is the empty text; a null source is the part named by the empty string; a row without
``doc_id`` is earlier than none and later than none; rows that repeat an id are documents of their own, and none of
them makes the others repeats; a document with several labels is good (toxic) if one of them says so; an empty table gives no
rows; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import json
from itertools import permutations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from changeloom.llm.common import checkpointed, read, small_side, stored

#: The filters, in the order of their bits.
FILTERS = "ABCDE"
LEAST_WORDS = 200
#: Bytes that are classed at once: memory does not grow with a text beyond its words.
BLOCK = 1 << 20
#: Words longer than this are hashed one by one, shorter ones in pieces of 8 bytes.
LONG_WORD = 64

_CLASS = np.zeros(256, np.uint8)
_CLASS[[0x20, *range(0x09, 0x0E)]] = 1  # white space
_CLASS[ord("A") : ord("Z") + 1] = 2
_CLASS[[ord(c) for c in "#$%&*|"]] = 4
_CLASS[(np.arange(256) & 0xC0) != 0x80] |= 8  # first byte of a character
_KEEP = np.array([(1 << (8 * k)) - 1 for k in range(8)] + [0xFFFFFFFFFFFFFFFF], np.uint64)


def _mix(x: np.ndarray) -> np.ndarray:
    """The finaliser of splitmix64."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def buffers(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts and the ``n + 1`` places where they begin and end, as views of the Arrow buffers (null: empty)."""
    if texts.null_count:
        texts = texts.fill_null("")
    kind = np.int64 if pa.types.is_large_string(texts.type) else np.int32
    _, ends, data = texts.buffers()
    if not len(texts):
        return np.empty(0, np.uint8), np.zeros(1, np.int64)
    ends = np.frombuffer(ends, kind)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
    return (np.frombuffer(data, np.uint8) if data else np.empty(0, np.uint8)), ends


def class_counts(data: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """``words, capitals, symbols, characters`` of each text: differences of prefix sums at its ends, block by block."""
    n = len(ends) - 1
    out = np.zeros((4, n), np.int64)
    for at in range(int(ends[0]), int(ends[-1]), BLOCK):
        to = min(at + BLOCK, int(ends[-1]))
        kinds = _CLASS[data[at:to]]
        gap = (kinds & 1).astype(bool)
        begins = ~gap
        begins[1:] &= gap[:-1]
        if begins[0] and at > ends[0]:  # goes on with a word of the block before, unless a text begins here
            begins[0] = bool(_CLASS[data[at - 1]] & 1)
        first, last = np.searchsorted(ends, at, "right") - 1, np.searchsorted(ends, to, "left")
        heads = ends[first:last]
        heads = heads[(heads >= at) & (heads < to)] - at
        begins[heads] = ~gap[heads]
        cuts = np.clip(ends[first : last + 1], at, to) - at
        for row, marks in enumerate((begins, kinds & 2 != 0, kinds & 4 != 0, kinds & 8 != 0)):
            sums = np.zeros(to - at + 1, np.int64)
            np.cumsum(marks, out=sums[1:])
            out[row, first:last] += np.diff(sums[cuts])
    return out


def word_spans(data: np.ndarray, at: int, to: int, heads: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Where the words of ``data[at:to]`` begin and how long they are; no word runs over a place in ``heads``, where a text begins."""
    word = np.zeros(to - at + 2, bool)
    word[1:-1] = _CLASS[data[at:to]] & 1 == 0
    first, last = word[1:] & ~word[:-1], word[:-1] & ~word[1:]
    if heads is not None:
        inner = heads[(heads > at) & (heads < to)] - at
        first[inner], last[inner] = word[inner + 1], word[inner]
    begins = np.flatnonzero(first)
    return begins + at, np.flatnonzero(last) - begins


def first_words(data: np.ndarray, begins: np.ndarray, sizes: np.ndarray, owner: np.ndarray) -> np.ndarray:
    """Places (in ``begins``) of one word for each distinct word of each owner, by sorted hashes that are verified."""
    if not len(begins):
        return begins
    padded = data if len(data) - int((begins + sizes).max()) >= 8 else np.concatenate([data, np.zeros(8, np.uint8)])
    eight = np.ndarray(len(padded) - 7, "<u8", padded, strides=(1,))
    h = _mix(owner.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + sizes.astype(np.uint64))
    longs = np.flatnonzero(sizes > LONG_WORD)
    active = np.flatnonzero(sizes <= LONG_WORD)
    for k in range(0, LONG_WORD, 8):
        active = active[sizes[active] > k]
        if not len(active):
            break
        h[active] = _mix(h[active] * np.uint64(0x9E3779B97F4A7C15) + (eight[begins[active] + k] & _KEEP[np.minimum(sizes[active] - k, 8)]))
    if len(longs):
        import xxhash

        h[longs] ^= np.fromiter((xxhash.xxh3_64_intdigest(data[b : b + s]) for b, s in zip(begins[longs], sizes[longs])), np.uint64, len(longs))
    order = np.argsort(h)
    same = h[order[1:]] == h[order[:-1]]
    a, b = order[:-1][same], order[1:][same]
    good = (sizes[a] == sizes[b]) & (owner[a] == owner[b])
    for k in range(0, LONG_WORD, 8):
        live = np.flatnonzero(good & (sizes[a] > k) & (sizes[a] <= LONG_WORD))
        if not len(live):
            break
        keep = _KEEP[np.minimum(sizes[a[live]] - k, 8)]
        good[live] = (eight[begins[a[live]] + k] & keep) == (eight[begins[b[live]] + k] & keep)
    for i in np.flatnonzero(good & (sizes[a] > LONG_WORD)):
        x, y, n = begins[a[i]], begins[b[i]], sizes[a[i]]
        good[i] = np.array_equal(data[x : x + n], data[y : y + n])
    new = np.ones(len(order), bool)
    new[1:] = ~same
    if good.all():
        return order[new]
    # two words with one hash: these runs are told apart word by word
    run = np.cumsum(new) - 1
    odd = np.zeros(run[-1] + 1, bool)
    odd[run[np.flatnonzero(same)[~good] + 1]] = True
    out, seen = list(order[new & ~odd[run]]), set()
    for i in order[odd[run]]:
        word = int(owner[i]), data[begins[i] : begins[i] + sizes[i]].tobytes()
        if word not in seen:
            seen.add(word)
            out.append(i)
    return np.array(out, order.dtype)


def distinct_words(data: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Distinct words of each text; short texts together, a long one in parts of which the distinct words are merged."""
    n = len(ends) - 1
    out, i = np.zeros(n, np.int64), 0
    while i < n:
        j = max(i + 1, int(np.searchsorted(ends, ends[i] + BLOCK, "right")) - 1)
        j = min(j, n)
        begins, sizes = np.empty(0, np.int64), np.empty(0, np.int64)
        at, to = int(ends[i]), int(ends[j])
        if j > i + 1:
            begins, sizes = word_spans(data, at, to, ends[i:j])
            owner = np.searchsorted(ends, begins, "right") - 1
            out[i:j] = np.bincount(owner[first_words(data, begins, sizes, owner)] - i, minlength=j - i)
        else:
            while at < to:
                end = min(at + BLOCK, to)
                while end < to and not _CLASS[data[end]] & 1:  # up to the end of a word
                    piece = np.flatnonzero(_CLASS[data[end : min(end + BLOCK, to)]] & 1)
                    end = end + int(piece[0]) if len(piece) else min(end + BLOCK, to)
                b, s = word_spans(data, at, end)
                begins, sizes = np.concatenate([begins, b]), np.concatenate([sizes, s])
                keep = first_words(data, begins, sizes, np.zeros(len(begins), np.int64))
                begins, sizes, at = begins[keep], sizes[keep], end
            out[i] = len(begins)
        i = j
    return out


def scanned(texts: pa.Array) -> tuple[np.ndarray, pa.Array]:
    """The bits of the filters A to D for each text, and its digest (16 bytes of SHA-256)."""
    data, ends = buffers(texts)
    words, capitals, symbols, characters = class_counts(data, ends)
    distinct = distinct_words(data, ends)
    bits = (words < LEAST_WORDS) * 1 + (100 * distinct < 50 * words) * 2 + (100 * capitals > 2 * characters) * 4 + (symbols > 0) * 8
    digest = [hashlib.sha256(data[a:b]).digest()[:16] for a, b in zip(ends[:-1], ends[1:])]
    return bits.astype(np.int32), pa.array(digest, pa.binary())


def failures(docs: DataFrame, key: str = "doc_id", text: str = "text", part: str = "source") -> DataFrame:
    """``key, part, mask`` for every row: the bits of the filters that it fails."""

    def run(batches):
        for batch in batches:
            bits, digest = scanned(batch.column(2))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(bits), digest], ["key", "part", "bits", "digest"])

    kind = docs.schema[key].dataType.simpleString()
    narrow = docs.select(F.col(key).alias("key"), F.coalesce(F.col(part).cast("string"), F.lit("")).alias("part"), F.col(text).alias("text"))
    held = stored(narrow.mapInArrow(run, f"key {kind}, part string, bits int, digest binary"))
    again = held.groupBy("digest").agg(F.min("key").alias("_first"), F.count(F.lit(1)).alias("_n")).where("_n > 1").select("digest", "_first")
    later = F.coalesce(F.col("key") > F.col("_first"), F.lit(False)).cast("int") * 16
    return held.join(small_side(checkpointed(again)), "digest", "left").select("key", "part", (F.col("bits") + later).alias("mask"))


def steps() -> list[tuple[str, int, int, int]]:
    """``order, step, bit of its filter, bits of the filters before`` of all orders."""
    out = []
    for order in permutations(FILTERS):
        before = 0
        for k, name in enumerate(order, 1):
            bit = 1 << FILTERS.index(name)
            out.append(("".join(order), k, bit, before))
            before |= bit
    return out


def audit(failed: DataFrame, marks: DataFrame, key: str = "key") -> DataFrame:
    """The report for every part, order and step; ``failed`` is ``key, part, mask`` and ``marks`` is ``key, good, toxic`` (booleans), unique by key."""
    rows = failed.join(marks, key, "left")
    per = rows.groupBy("part", "mask").agg(F.count(F.lit(1)).alias("n"), F.count_if("good").alias("good"), F.count_if("toxic").alias("toxic"))
    masks = per.groupBy("part").agg(F.collect_list(F.struct("mask", "n", "good", "toxic")).alias("masks"))  # 32 a part at most
    # of the k filters that a document fails each one is the first in 1/k of all orders
    turns = F.element_at(F.array(*[F.lit(120 // k).cast("long") for k in range(1, 6)]), F.bit_count(F.col("m.mask")).cast("int"))
    names = ("filter_order", "step", "bit", "before")
    all_steps = F.from_json(F.lit(json.dumps([dict(zip(names, x)) for x in steps()])), "array<struct<filter_order string, step int, bit int, before int>>")
    wide = masks.withColumn("s", F.explode(all_steps)).select("part", "s.*", F.explode("masks").alias("m"))
    own, early = F.col("m.mask").bitwiseAND(F.col("bit")) != 0, F.col("m.mask").bitwiseAND(F.col("before")) != 0
    total = lambda test, what: F.coalesce(F.sum(F.when(test, what)), F.lit(0)).cast("long")
    return wide.groupBy("part", "filter_order", "step").agg(
        total(~own & ~early, F.col("m.n")).alias("kept"),
        total(own & ~early, F.col("m.n")).alias("removed"),
        total(own & early, F.col("m.n")).alias("redundant"),
        total(F.col("m.mask") == F.col("bit"), F.col("m.n")).alias("unique_fails"),
        total(own & ~early, F.col("m.good")).alias("good_lost"),
        total(own & ~early, F.col("m.toxic")).alias("toxic_lost"),
        total(own, F.col("m.n") * turns).alias("shapley"),
    )


def op11_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = read(spark, sf_dir, "labels").where("doc_id is not null and (quality = 1 or toxic = 1)")
    marks = labels.groupBy(F.col("doc_id").alias("key")).agg(F.max(F.col("quality") == 1).alias("good"), F.max(F.col("toxic") == 1).alias("toxic"))
    return audit(failures(read(spark, sf_dir, "documents")), marks)


_ORDERS = ", ".join(f"('{o}', {s}, {b}, {e})" for o, s, b, e in steps())
OP11_SQL = rf"""
WITH d AS (SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
f AS (
SELECT doc_id, part, CASE WHEN len(w) < 200 THEN 1 ELSE 0 END + CASE WHEN 100 * len(list_distinct(w)) < 50 * len(w) THEN 2 ELSE 0 END
 + CASE WHEN 100 * length(regexp_replace(text, '[^A-Z]', '', 'g')) > 2 * length(text) THEN 4 ELSE 0 END
 + CASE WHEN regexp_matches(text, '[#$%&*|]') THEN 8 ELSE 0 END + CASE WHEN doc_id > min(doc_id) OVER (PARTITION BY text) THEN 16 ELSE 0 END AS mask FROM d),
l AS (SELECT doc_id, max(CASE WHEN quality = 1 THEN 1 ELSE 0 END) AS good, max(CASE WHEN toxic = 1 THEN 1 ELSE 0 END) AS toxic FROM labels WHERE doc_id IS NOT NULL GROUP BY 1),
m AS (SELECT part, mask, count(*) AS n, coalesce(sum(good), 0) AS good, coalesce(sum(toxic), 0) AS toxic FROM f LEFT JOIN l USING (doc_id) GROUP BY 1, 2),
o(filter_order, step, bit, before) AS (VALUES {_ORDERS}),
x AS (SELECT part, filter_order, step, bit,
 CAST(coalesce(sum(n) FILTER (mask & (bit | before) = 0), 0) AS BIGINT) AS kept, CAST(coalesce(sum(n) FILTER (mask & bit <> 0 AND mask & before = 0), 0) AS BIGINT) AS removed,
 CAST(coalesce(sum(n) FILTER (mask & bit <> 0 AND mask & before <> 0), 0) AS BIGINT) AS redundant, CAST(coalesce(sum(n) FILTER (mask = bit), 0) AS BIGINT) AS unique_fails,
 CAST(coalesce(sum(good) FILTER (mask & bit <> 0 AND mask & before = 0), 0) AS BIGINT) AS good_lost, CAST(coalesce(sum(toxic) FILTER (mask & bit <> 0 AND mask & before = 0), 0) AS BIGINT) AS toxic_lost
FROM m CROSS JOIN o GROUP BY 1, 2, 3, 4)
SELECT part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost, CAST(sum(removed) OVER (PARTITION BY part, bit) AS BIGINT) AS shapley FROM x
"""
