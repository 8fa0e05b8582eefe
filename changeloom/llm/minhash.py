"""Operator 6: near-duplicates by min-max hashing.

A document is the set of its distinct five-word shingles, each a 64-bit hash.  Every permutation
yields two signature values, the smallest and the largest hash under it, so that half the
permutations give a signature of the same length.  Signatures are cut into bands; documents that
share a band (a bucket) are candidates, and every link is confirmed on the full shingle sets.

How groups of any size stay linear, without a cap:

* equal sets are collapsed to a class first;
* in a bucket every class is compared with one head (a star).  The head is the class that meets most
  others over all its buckets: of edited copies that is the original, so one star links its group;
* classes outside their head's component get a second star, with the most central of them as head;
* pairs that are then still open (of one bucket, neither of them its head, in different components) are
  compared directly in small buckets, a constant number a class.  In larger ones an exact prefix filter finds
  them: a pair that is linked shares one of the rarest shingles of both, at places that leave room
  for the overlap it needs.  Shingles are counted among these classes only, and a shingle whose classes
  are all of one component is dropped.

With 6 values a band and 32 bands a pair at the threshold of 0.85 is missed with probability 3e-7.
Before texts are fetched, pairs are dropped whose sizes rule the threshold out, and those whose one-bit sketches
(one bit of each of the 192 values) differ in more than ``sketch_bits`` places: a pair at the threshold differs in
14 on average, with a standard deviation of 3.7, so 36 costs fewer than one such pair in ten million; None
switches the sketches off.

Defined results: documents without words (or null) have an empty set, are their own component and
link with nothing; with fewer than five words the whole sequence is the one shingle; all rows of one
``doc_id`` are one document: each row has its own ``n_shingles``, any of its texts links, and all get
one component; rows without ``doc_id`` are documents of their own; an empty table gives no rows; other columns
are ignored.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from changeloom.llm.common import alone, checkpointed, gathered, identified, read, small_side, stored

SHINGLE_WORDS = 5
PERMUTATIONS = 96
BAND_VALUES = 6
BANDS = 2 * PERMUTATIONS // BAND_VALUES
#: Links need 100 * intersection >= LINK_PERCENT * union.
LINK_PERCENT = 85
#: Bits in which the sketches of a pair may differ.
SKETCH_BITS = 36
#: Buckets with at most so many open classes are compared pair by pair, larger ones by the prefix filter.
SMALL_BUCKET = 8
#: Hash values handled at once while signing, to bound memory on very long texts.
BLOCK = 4096
#: Word hashes that one worker remembers.
CACHE_WORDS = 150_000

_split = re.compile(rb"[^\x20\x09-\x0D]+").findall
_lower = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))
_word_hash: dict[bytes, int] = {}


def _mix(x: np.ndarray) -> np.ndarray:
    """The finaliser of splitmix64."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingle_set(text: str | None, words: int = SHINGLE_WORDS) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the shingles."""
    import xxhash

    alone(_word_hash.clear)
    found = _split(text.encode("utf-8", "replace").translate(_lower)) if text else []
    if not found:
        return np.empty(0, np.uint64)
    if len(_word_hash) > CACHE_WORDS:
        _word_hash.clear()
    for w in set(found).difference(_word_hash):
        _word_hash[w] = xxhash.xxh3_64_intdigest(w)
    h = np.fromiter(map(_word_hash.__getitem__, found), np.uint64, len(found))
    n = max(len(h) - words + 1, 1)
    acc = np.full(n, min(len(h), words), np.uint64)
    for k in range(min(words, len(h))):
        acc = _mix(acc * np.uint64(0x9E3779B97F4A7C15) + h[k : k + n])
    return np.unique(acc)


def _multipliers(seed: int = 7) -> tuple[np.ndarray, np.ndarray]:
    r = np.random.Generator(np.random.PCG64(seed))
    return r.integers(0, 1 << 32, PERMUTATIONS, np.uint64).astype(np.uint32) | np.uint32(1), r.integers(0, 1 << 32, PERMUTATIONS, np.uint64).astype(np.uint32)


_MUL, _ADD = _multipliers()


def signature(hashes: np.ndarray) -> np.ndarray:
    """The minima, then the maxima, of all permutations (32-bit multiply-add over already mixed hashes)."""
    low, high = np.full(PERMUTATIONS, 0xFFFFFFFF, np.uint32), np.zeros(PERMUTATIONS, np.uint32)
    folded = (hashes ^ (hashes >> np.uint64(32))).astype(np.uint32)
    for k in range(0, len(folded), BLOCK):
        part = folded[None, k : k + BLOCK] * _MUL[:, None] + _ADD[:, None]
        np.minimum(low, part.min(axis=1), out=low)
        np.maximum(high, part.max(axis=1), out=high)
    return np.concatenate([low, high])


def band_keys(sig: np.ndarray) -> np.ndarray:
    """One 64-bit key for each band; a band takes values of different permutations."""
    rows = sig.reshape(BAND_VALUES, BANDS).astype(np.uint64)
    acc = np.arange(1, BANDS + 1, dtype=np.uint64)
    for k in range(BAND_VALUES):
        acc = _mix(acc * np.uint64(0x9E3779B97F4A7C15) + rows[k])
    return acc.view(np.int64)


def sketch(sig: np.ndarray) -> np.ndarray:
    """One bit of each signature value, as 64-bit words."""
    return np.packbits((_mix(sig.astype(np.uint64)) & np.uint64(1)).astype(np.uint8)).view(np.int64)


def alike(a: str, b: str, bits: int) -> Column:
    """Whether two sketch columns are near enough for a link."""
    differ = F.lit(0)
    for i in range(2 * PERMUTATIONS // 64):
        differ = differ + F.bit_count(F.col(a)[i].bitwiseXOR(F.col(b)[i]))
    return differ <= bits


def sign(docs: DataFrame, key: str, text: str) -> DataFrame:
    """``key, n_shingles, set_id, bands, sketch`` (a hash of the whole set; band keys; bits), one row a document."""

    def run(batches):
        import xxhash

        for batch in batches:
            n, ids, bands, bits = [], [], [], []
            for t in batch.column(1):
                s = shingle_set(t.as_py())
                n.append(len(s))
                ids.append(xxhash.xxh3_128_digest(s.tobytes()) if len(s) else None)
                sig = signature(s) if len(s) else None
                bands.append(None if sig is None else band_keys(sig))
                bits.append(None if sig is None else sketch(sig))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n, pa.int64()), pa.array(ids, pa.binary()), pa.array(bands, pa.list_(pa.int64())), pa.array(bits, pa.list_(pa.int64()))], [key, "n_shingles", "set_id", "bands", "sketch"])

    return docs.select(key, text).mapInArrow(run, f"`{key}` {docs.schema[key].dataType.simpleString()}, n_shingles long, set_id binary, bands array<long>, sketch array<long>")


def confirmed(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """The pairs ``a, b`` whose full shingle sets are alike enough; ``texts`` is ``key, text``, unique by key."""
    both = pairs.join(texts.select(F.col("key").alias("b"), F.col("text").alias("_tb")), "b").join(texts.select(F.col("key").alias("a"), F.col("text").alias("_ta")), "a")

    def run(batches):
        seen, first = object(), np.empty(0, np.uint64)
        for batch in batches:
            keep = []
            for a, ta, tb in zip(batch.column(0), batch.column(2), batch.column(3)):
                if (v := a.as_py()) != seen:
                    seen, first = v, shingle_set(ta.as_py())
                other = shingle_set(tb.as_py())
                small, large = sorted((len(first), len(other)))
                if not small or 100 * small < LINK_PERCENT * large:
                    keep.append(False)
                    continue
                common = np.intersect1d(first, other, assume_unique=True).size
                keep.append(100 * common >= LINK_PERCENT * (small + large - common))
            mask = pa.array(keep, pa.bool_())
            yield pa.RecordBatch.from_arrays([batch.column(0).filter(mask), batch.column(1).filter(mask)], ["a", "b"])

    return both.select("a", "b", "_ta", "_tb").mapInArrow(run, "a long, b long")


def components(links: DataFrame) -> DataFrame:
    """``id, root`` for every end of a link: the smallest id reachable.

    Alternates large-star and small-star steps (map-reduce connected components), and steps grow with the
    logarithm of a chain's length.  Minima are made on the map side and written before they are joined, so that
    Spark can split the edges of a hub over many tasks.
    """
    edges = checkpointed(links.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct())
    n, seen = edges.count(), None
    edges = gathered(edges, n)
    while True:  # no step makes more edges than there were, and a least neighbour for each end at most
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = checkpointed(both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m")), 2 * n)
        large = checkpointed(both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct(), 2 * n)
        least = checkpointed(large.groupBy("u").agg(F.min("v").alias("m")), 2 * n)
        small = large.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(least.select("u", F.col("m").alias("v")))
        edges = checkpointed(small.where("u <> v").distinct(), 2 * n)
        now = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == seen:
            break
        n, seen = now[0], now
    # every id but a root has one edge now, which leads to its root
    return edges.select(F.col("u").alias("id"), F.col("v").alias("root")).unionByName(edges.select(F.col("v").alias("id"), F.col("v").alias("root")).distinct())


def star_heads(near: DataFrame) -> DataFrame:
    """``bucket, head``: of each bucket the class that meets most others over all of its buckets (then the smallest id)."""
    sizes = near.groupBy("bucket").agg(F.count(F.lit(1)).alias("size"))
    central = near.join(sizes, "bucket").groupBy("key").agg(F.sum("size").alias("met"))
    return near.join(central, "key").groupBy("bucket").agg(F.min(F.struct((-F.col("met")).alias("m"), "key"))["key"].alias("head"))


def fitting(pairs: DataFrame, about: DataFrame, bits: int | None) -> DataFrame:
    """The distinct pairs ``a, b`` whose set sizes (and sketches) allow a link; ``about`` is ``key, n_shingles, sketch``."""
    side = lambda c: about.select(F.col("key").alias(c), F.col("n_shingles").alias(f"_n{c}"), F.col("sketch").alias(f"_s{c}"))
    both = pairs.where("a <> b").distinct().join(side("a"), "a").join(side("b"), "b").where(100 * F.least("_na", "_nb") >= LINK_PERCENT * F.greatest("_na", "_nb"))
    return (both if bits is None else both.where(alike("_sa", "_sb", bits))).select("a", "b")


def rooted(near: DataFrame, roots: DataFrame) -> DataFrame:
    return near.join(roots.withColumnRenamed("id", "key"), "key", "left").withColumn("root", F.coalesce("root", "key"))


def open_pairs(left: DataFrame, texts: DataFrame) -> DataFrame:
    """Pairs ``a, b`` of different components that may be linked; ``left`` is ``key, root``, a row for each class.

    Every linked pair is among them: both sets, in the order of shingle counts, hold their first common shingle within
    the first ``n - ceil(0.85 n) + 1``, and as many shingles follow it in both as the link needs.
    """

    def run(batches):
        for batch in batches:
            for key, root, text in zip(*[c.to_pylist() for c in batch.columns]):
                s = shingle_set(text)
                for k in range(0, len(s), 1 << 16):
                    part = s[k : k + (1 << 16)].view(np.int64)
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(len(part), key)), pa.array(np.full(len(part), root)), pa.array(np.full(len(part), len(s))), pa.array(part)], ["key", "root", "n", "h"])

    held = stored(left.join(texts, "key").select("key", "root", "text").mapInArrow(run, "key long, root long, n long, h long"))
    counts = checkpointed(held.groupBy("h").agg(F.count(F.lit(1)).alias("df")).where("df > 1"))
    place = F.row_number().over(W.partitionBy("key").orderBy("df", "h")).cast("long")
    ranked = held.join(counts, "h", "left").withColumn("df", F.coalesce("df", F.lit(1))).withColumn("r", place)
    first = checkpointed(ranked.where((F.col("df") > 1) & (F.col("r") <= F.col("n") - F.ceil(F.col("n") * LINK_PERCENT / 100) + 1)).select("h", "key", "root", "n", "r"))
    return crossing(first, LINK_PERCENT)


def crossing(first: DataFrame, percent: int) -> DataFrame:
    """Pairs ``a, b`` of different roots that share an element ``h`` with room for a link behind it.

    ``first`` is ``h, key, root, n, r``: the places ``r`` of the elements of prefixes in sets of size ``n``.
    """
    by_root = first.groupBy("h", "root").agg(F.count(F.lit(1)).alias("c"))
    # of one shingle, the classes outside its most frequent component meet the others
    major = checkpointed(by_root.groupBy("h").agg(F.max(F.struct("c", "root"))["root"].alias("major"), F.count(F.lit(1)).alias("k")).where("k > 1").select("h", "major"))
    some = checkpointed(first.join(major, "h"))
    x = some.where("root <> major").select("h", "major", *[F.col(c).alias(f"{c}_x") for c in ("key", "root", "n", "r")])
    room = 1 + F.least(F.col("n_x") - F.col("r_x"), F.col("n") - F.col("r"))
    test = (F.col("root_x") != F.col("root")) & (100 * room >= percent * (F.col("n_x") + F.col("n") - room))
    return x.join(some.drop("major"), "h").where(test & ((F.col("root") == F.col("major")) | (F.col("key_x") < F.col("key")))).select(F.col("key_x").alias("a"), F.col("key").alias("b"))


def _clustered(docs: DataFrame, top: int | None, sketch_bits: int | None) -> DataFrame:
    """``key, doc, n_shingles, component_id, kept`` from ``key, doc, text``: see :func:`identified` for ``key`` and ``top``."""
    signed = stored(sign(docs, "key", "text"))
    full = signed.where(F.col("set_id").isNotNull())
    # one class for each set, named by its smallest row
    classes = full.groupBy("set_id").agg(F.min("key").alias("cls"), F.count(F.lit(1)).alias("n"))
    copied = small_side(checkpointed(classes.where("n > 1").select("set_id", "cls")))
    same = checkpointed(full.select("key", "set_id").join(copied, "set_id").where("key <> cls").select(F.col("cls").alias("a"), F.col("key").alias("b")))
    about = full.select("key", "n_shingles", "bands", "sketch").join(small_side(same.select(F.col("b").alias("key"))), "key", "left_anti")
    banded = about.select("key", F.explode("bands").alias("bucket"))  # a band's number is part of its hash
    shared = banded.groupBy("bucket").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("bucket")
    near = stored(banded.join(shared, "bucket").select("bucket", "key"))
    n = near.count()  # a bound of the rows of all tables below, until pairs are taken from small buckets and shingles
    keys = small_side(checkpointed(near.select("key").distinct(), n))
    about = checkpointed(about.join(keys, "key", "left_semi").select("key", "n_shingles", "sketch"))
    texts = stored(docs.select("key", "text").join(keys, "key", "left_semi"))

    near = stored(near.join(star_heads(near), "bucket"), n)
    pairs = checkpointed(fitting(near.select(F.col("head").alias("a"), F.col("key").alias("b")), about, sketch_bits), n)
    links = checkpointed(confirmed(pairs, texts))  # its tasks do the work of this operator: not gathered
    links = gathered(links, links.count())
    at = stored(rooted(near, components(links)), n)
    # a second star for the classes outside the component of their bucket's head
    lead = at.where("key = head").select("bucket", F.col("root").alias("lead"))
    rest = stored(at.join(lead, "bucket").where("root <> lead").select("bucket", "key"), n)
    again = rest.join(star_heads(rest), "bucket").select(F.col("head").alias("a"), F.col("key").alias("b"))
    pairs = checkpointed(fitting(again.join(links, ["a", "b"], "left_anti"), about, sketch_bits), n)
    more = checkpointed(confirmed(pairs, texts))
    if not more.isEmpty():
        links = checkpointed(links.unionByName(more).distinct(), 2 * n)
        at = stored(rooted(near, components(links)), n)
    # what is still open: pairs without the head, of different components
    others = at.where("key <> head")
    mixed = others.groupBy("bucket").agg(F.min("root").alias("lo"), F.max("root").alias("hi"), F.count(F.lit(1)).alias("n")).where("lo <> hi").select("bucket", "n")
    left = stored(others.join(mixed, "bucket").select("bucket", "key", "root", "n"), n)
    small = left.where(F.col("n") <= SMALL_BUCKET).select("bucket", "key", "root")
    pairs = small.toDF("bucket", "a", "ra").join(small.toDF("bucket", "b", "rb"), "bucket").where("a < b and ra <> rb").select("a", "b").distinct()
    large = checkpointed(left.where(F.col("n") > SMALL_BUCKET).select("key", "root").distinct(), n)
    if not large.isEmpty():
        pairs = pairs.unionByName(open_pairs(large, texts))
    pairs = checkpointed(pairs.distinct())
    pairs = gathered(pairs, pairs.count())
    links = links.unionByName(confirmed(fitting(pairs, about, sketch_bits), texts))
    # a row's class, then the component of the class
    out = signed.select("key", "n_shingles").join(same.select(F.col("b").alias("key"), F.col("a").alias("cls")), "key", "left").withColumn("cls", F.coalesce("cls", "key"))
    if top is not None:  # rows that repeat a document's id are one document: so are their classes
        out = checkpointed(out.join(docs.select("key", "doc"), "key"))
        again = out.where(F.col("doc").isNotNull() & (F.col("key") > top)).select("doc", "cls").distinct()
        first = small_side(checkpointed(again.groupBy("doc").agg(F.min("cls").alias("a"))))
        links = links.unionByName(again.join(first, "doc").where("a <> cls").select("a", F.col("cls").alias("b")))
    roots = small_side(checkpointed(components(links)))
    out = checkpointed(out).join(roots, F.col("cls") == F.col("id"), "left").withColumn("root", F.coalesce("root", "cls")).drop("id")
    if top is None:
        return out.select("key", F.col("key").alias("doc"), "n_shingles", F.col("root").alias("component_id"), (F.col("key") == F.col("root")).alias("kept"))
    # rows with an id of their own making: a component is named by its smallest real id, if it has any
    out = checkpointed(out)
    out = out.join(small_side(checkpointed(out.groupBy("root").agg(F.min("doc").alias("component_id")))), "root")
    kept = F.when(F.col("component_id").isNull(), F.col("key") == F.col("root")).otherwise(F.coalesce(F.col("doc") == F.col("component_id"), F.lit(False)))
    return out.select("key", "doc", "n_shingles", "component_id", kept.alias("kept"))


def cluster(docs: DataFrame, key: str = "doc_id", text: str = "text", sketch_bits: int | None = SKETCH_BITS) -> DataFrame:
    """``key, n_shingles, component_id, kept`` for every row."""
    rows, top = identified(docs.select(F.col(key).alias("doc"), F.col(text).alias("text")), "doc")
    return _clustered(rows.withColumnRenamed("row_id", "key"), top, sketch_bits).select(F.col("doc").alias(key), "n_shingles", "component_id", "kept")


def keep_one(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``docs`` that are kept, with all their columns: of each component all rows of its smallest ``key``.

    A component of rows without ``key`` keeps the first of its rows.
    """
    packed = docs.select(F.col(key).alias("doc"), F.col(text).alias("text"), F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
    rows, top = identified(packed, "doc")
    rows = rows.withColumnRenamed("row_id", "key")
    kept = _clustered(rows.select("key", "doc", "text"), top, SKETCH_BITS).where("kept").select("key")
    return rows.join(kept, "key", "left_semi").select("row.*")


def op6_minmax_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows without ``doc_id`` are documents of their own; a component of such rows alone has no ``component_id``."""
    return cluster(read(spark, sf_dir, "documents"))
