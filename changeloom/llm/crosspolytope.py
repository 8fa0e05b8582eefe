"""Operator 13: near-duplicate vectors by cross-polytope hashing.

A vector is rotated by three rounds of random signs and a fast Hadamard transform; a hash is the axis (with its sign)
that it then comes nearest to.  A table's bucket takes ``levels`` such hashes; every vector goes into the buckets of its nearest
and second nearest axes in all combinations (multiprobe), and vectors that share a bucket are candidates.  Every link is
verified by its cosine in double precision.

Counting links of groups of any size without pairs:

* equal vectors of one label are one class, with the number of its members;
* in a bucket each class is verified against one head, the class that meets most others.  Classes within half the angle
  of a link from a head that is in no other ball make a ball: any two of its classes are linked, unseen, so a ball counts by its size;
* balls that share a bucket are compared by their centres first.  By the triangle inequality centres, radii and each
  member's own angle to the other centre tell for most members whether they are linked with all of the other ball or
  with none of it; only what these leave open is compared one by one.

The number of levels follows from the rows of the largest label (buckets are as many as these at least), and the number of tables from the
chance ``MISS`` with which a pair at the threshold may meet in none.

Defined results: vectors that are null, empty, zero or hold a null or non-finite component, and those without a label, link with nothing;
vectors of different lengths have no cosine and don't link; -0 equals 0; rows without ``vec_id``, and rows that share one, are vectors of their
own: a component is named by its smallest id (null if it has none, then its first row is kept); an empty table gives no
rows; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from changeloom.llm.common import checkpointed, gathered, identified, read, small_side, stored
from changeloom.llm.minhash import components, star_heads

#: Vectors with this cosine at least are linked.
COSINE = 0.93
#: Two vectors at this cosine from a centre are linked by the triangle inequality (a little is added for rounding).
BALL = math.cos(math.acos(COSINE) / 2) + 1e-9
#: The chance that the two nearest axes of one hash meet, for a pair at the threshold (measured in 64 dimensions).
MEET = 0.886
#: The chance that such a pair meets in no table.
MISS = 1e-4
#: Axes of one hash, with their signs, in 64 dimensions.
AXES = 128
#: Vectors that are rotated at once.
BLOCK = 2048
#: Rounding of angles, in radians: what lies nearer to a bound is compared one by one.
ROUNDING = 1e-7


def levels_for(rows: int) -> int:
    """Hashes of a bucket, so that there are as many buckets as rows of a label."""
    return max(2, math.ceil(math.log(max(rows, 1)) / math.log(AXES)))


def tables_for(levels: int) -> int:
    return math.ceil(math.log(MISS) / math.log(1 - MEET**levels))


def hadamard(x: np.ndarray) -> np.ndarray:
    """The fast Walsh-Hadamard transform of each row (a power of two long), unscaled."""
    n, h = x.shape[1], 1
    while h < n:
        y = x.reshape(-1, n // (2 * h), 2, h)
        x = np.stack([y[:, :, 0] + y[:, :, 1], y[:, :, 0] - y[:, :, 1]], axis=2).reshape(-1, n)
        h *= 2
    return x


def nearest_axes(x: np.ndarray, seed: int) -> np.ndarray:
    """The nearest and second nearest signed axis of each row after one random rotation, shape ``(rows, 2)``."""
    dim = 1 << max(1, (x.shape[1] - 1).bit_length())
    y = np.zeros((len(x), dim), np.float32)
    y[:, : x.shape[1]] = x
    signs = np.random.Generator(np.random.PCG64(seed)).integers(0, 2, (3, dim)).astype(np.float32) * 2 - 1
    for s in signs:
        y = hadamard(y * s) / np.float32(math.sqrt(dim))
    size, at = np.abs(y), np.arange(len(y))
    first = size.argmax(axis=1)
    size[at, first] = -1
    second = size.argmax(axis=1)
    return np.stack([2 * first + (y[at, first] < 0), 2 * second + (y[at, second] < 0)], axis=1)


def bucket_codes(x: np.ndarray, levels: int, tables: int) -> np.ndarray:
    """Codes of the buckets that each row goes into, shape ``(rows, tables, 2 ** levels)``."""
    out = np.empty((len(x), tables, 1 << levels), np.uint64)
    for t in range(tables):
        codes = np.full((len(x), 1), t + 1, np.uint64)
        for k in range(levels):
            axes = nearest_axes(x, t * 64 + k).astype(np.uint64)
            codes = (codes[:, :, None] * np.uint64(0x9E3779B97F4A7C15) + axes[:, None, :] + np.uint64(1)).reshape(len(x), -1)
            codes ^= codes >> np.uint64(29)
        out[:, t] = codes
    return out


def signed(rows: DataFrame, levels: int, tables: int) -> DataFrame:
    """``key, digest, buckets`` of ``key, embedding, label``: nulls for vectors that link with nothing; equal digests are equal vectors of one label."""

    def run(batches):
        for batch in batches:
            vectors, labels = batch.column(1), batch.column(2).to_pylist()
            n = batch.num_rows
            digests, buckets = [None] * n, [None] * n
            sizes = vectors.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
            for dim in np.unique(sizes[sizes > 0]).tolist():
                for k in range(0, n, BLOCK):
                    at = k + np.flatnonzero(sizes[k : k + BLOCK] == dim)
                    at = np.array([i for i in at if labels[i] is not None], np.int64)
                    if not len(at):
                        continue
                    x = vectors.take(pa.array(at)).flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, dim) + 0.0
                    top = np.abs(x).max(axis=1)
                    good = np.isfinite(top) & (top > 0)
                    at, x, top = at[good], x[good], top[good]
                    if not len(at):
                        continue
                    codes = bucket_codes(x / top[:, None], levels, tables).reshape(len(at), -1)
                    for i, row, code in zip(at.tolist(), x, codes):
                        name = f"{labels[i]}:{dim}:".encode()
                        digests[i] = hashlib.sha256(name + row.tobytes()).digest()[:16]
                        own = np.uint64(int.from_bytes(hashlib.sha256(name).digest()[:8], "little"))
                        buckets[i] = np.unique((code ^ own) * np.uint64(0xBF58476D1CE4E5B9)).view(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(digests, pa.binary()), pa.array(buckets, pa.list_(pa.int64()))], ["key", "digest", "buckets"])

    return rows.select("key", "embedding", "label").mapInArrow(run, "key long, digest binary, buckets array<long>")


def _cosines(a: pa.Array, b: pa.Array) -> np.ndarray:
    """Cosines of the pairs of two columns of vectors, in double precision."""
    out = np.empty(len(a))
    for k in range(0, len(a), BLOCK):
        x, y = a.slice(k, BLOCK), b.slice(k, BLOCK)
        n, m = len(x), x.value_lengths().to_numpy(zero_copy_only=False)
        for dim in np.unique(m):
            at = np.flatnonzero(m == dim)
            u, v = (c.take(pa.array(at)).flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, dim) for c in (x, y))
            u, v = (c / np.abs(c).max(axis=1)[:, None] for c in (u, v))
            out[k + at] = np.einsum("ij,ij->i", u, v) / np.sqrt(np.einsum("ij,ij->i", u, u) * np.einsum("ij,ij->i", v, v))
    return out


def measured(pairs: DataFrame, vectors: DataFrame) -> DataFrame:
    """``pairs`` (columns ``a``, ``b`` and numbers) with the cosine of the two vectors of ``key, embedding`` as ``cos``."""
    rest = [c for c in pairs.columns if c not in ("a", "b")]
    side = lambda c: vectors.select(F.col("key").alias(c), F.col("embedding").alias(f"_{c}"))
    both = pairs.join(side("b"), "b").join(side("a"), "a").select("a", "b", *rest, "_a", "_b")

    def run(batches):
        for batch in batches:
            n = batch.num_columns
            yield pa.RecordBatch.from_arrays([*batch.columns[: n - 2], pa.array(_cosines(batch.column(n - 2), batch.column(n - 1)))], ["a", "b", *rest, "cos"])

    kinds = "".join(f", {c} {pairs.schema[c].dataType.simpleString()}" for c in rest)
    return both.mapInArrow(run, f"a long, b long{kinds}, cos double")


def balls(near: DataFrame, vectors: DataFrame) -> DataFrame:
    """``key, ball, angle``: the classes of ``near`` (``bucket, key``) by the head whose ball they are in, and their angle to it.

    Of the heads near enough a class takes the one that meets most others (then the smallest id), if that is more central than the class itself
    and in no other ball; all other classes are the centres of their own ball.
    """
    met = checkpointed(near.join(near.groupBy("bucket").agg(F.count(F.lit(1)).alias("_size")), "bucket").groupBy("key").agg(F.sum("_size").alias("met")))
    pairs = near.join(star_heads(near), "bucket").where("head <> key").select(F.col("head").alias("a"), F.col("key").alias("b")).distinct()
    close = measured(checkpointed(pairs), vectors).where(F.col("cos") >= BALL)
    rank = lambda c: F.struct(F.col(f"met_{c}"), (-F.col(c)).alias("i"))
    ranked = close.join(met.select(F.col("key").alias("a"), F.col("met").alias("met_a")), "a").join(met.select(F.col("key").alias("b"), F.col("met").alias("met_b")), "b")
    ranked = ranked.where((F.col("met_a") > F.col("met_b")) | ((F.col("met_a") == F.col("met_b")) & (F.col("a") < F.col("b"))))
    taken = checkpointed(ranked.groupBy("b").agg(F.max_by(F.struct("a", "cos"), rank("a")).alias("t")).select(F.col("b").alias("key"), F.col("t.a").alias("ball"), F.acos(F.least("t.cos", F.lit(1.0))).alias("angle")))
    inside = taken.join(taken.select(F.col("key").alias("ball")), "ball", "left_anti")
    return near.select("key").distinct().join(inside, "key", "left").select("key", F.coalesce("ball", "key").alias("ball"), F.coalesce("angle", F.lit(0.0)).alias("angle"))


def links_between(near: DataFrame, at: DataFrame, vectors: DataFrame, mult: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Links of classes of different balls: ``key, whole, n`` (links of a class, or of each class of a ball where ``whole``), and pairs ``a, b`` of linked balls.

    ``at`` is ``key, ball, angle`` and ``mult`` is ``key, n``, the members of a class.
    """
    limit = math.acos(COSINE)
    size = checkpointed(at.join(mult, "key").groupBy("ball").agg(F.sum("n").alias("rows"), F.count(F.lit(1)).alias("classes"), F.max("angle").alias("radius")))
    of = lambda c: size.select(F.col("ball").alias(c), *[F.col(x).alias(f"{x}_{c}") for x in ("rows", "classes", "radius")])
    held = checkpointed(near.join(at.select("key", "ball"), "key").select("bucket", "ball").distinct())
    pairs = checkpointed(held.toDF("bucket", "a").join(held.toDF("bucket", "b"), "bucket").where("a < b").select("a", "b").distinct())
    # the smaller ball's members are held against the larger one's centre
    sized = measured(pairs, vectors).join(of("a"), "a").join(of("b"), "b").where(F.acos(F.least("cos", F.lit(1.0))) <= limit + F.col("radius_a") + F.col("radius_b") + ROUNDING)
    turn = F.col("classes_a") > F.col("classes_b")
    pick = lambda c, x, y: F.when(turn, F.col(y)).otherwise(F.col(x)).alias(c)
    sized = sized.select(pick("small", "a", "b"), pick("large", "b", "a"), pick("rows", "rows_b", "rows_a"), pick("radius", "radius_b", "radius_a"))
    each = sized.join(at.select(F.col("ball").alias("small"), F.col("key").alias("a")), "small").select("a", F.col("large").alias("b"), "small", "rows", "radius")
    told = measured(each, vectors).withColumn("far", F.acos(F.least("cos", F.lit(1.0)))).where(F.col("far") <= limit + F.col("radius") + ROUNDING)
    alone = F.col("radius") == 0
    every = F.when(alone, F.col("cos") >= COSINE).otherwise(F.col("far") + F.col("radius") <= limit - ROUNDING)
    told = checkpointed(told.select("a", "b", "small", "rows", every.alias("every")).where(~alone | every))
    whole = told.where("every").join(mult.select(F.col("key").alias("a"), F.col("n").alias("n_a")), "a")
    open_ = told.where("not every").select("a", "b", "small").join(at.select(F.col("ball").alias("b"), "key"), "b").select("a", F.col("key").alias("b"), "small", F.col("b").alias("large"))
    some = checkpointed(measured(open_, vectors).where(F.col("cos") >= COSINE))
    some_n = some.join(mult.select(F.col("key").alias("a"), F.col("n").alias("n_a")), "a").join(mult.select(F.col("key").alias("b"), F.col("n").alias("n_b")), "b")
    counts = (
        whole.select(F.col("a").alias("key"), F.lit(False).alias("whole"), F.col("rows").alias("n"))
        .unionByName(whole.select(F.col("b").alias("key"), F.lit(True).alias("whole"), F.col("n_a").alias("n")))
        .unionByName(some_n.select(F.col("a").alias("key"), F.lit(False).alias("whole"), F.col("n_b").alias("n")))
        .unionByName(some_n.select(F.col("b").alias("key"), F.lit(False).alias("whole"), F.col("n_a").alias("n")))
    )
    linked = whole.select(F.col("small").alias("a"), "b").unionByName(some.select(F.col("small").alias("a"), F.col("large").alias("b"))).distinct()
    return counts.groupBy("key", "whole").agg(F.sum("n").alias("n")), linked


def near_vectors(table: DataFrame, key: str = "vec_id", embedding: str = "embedding", label: str = "label", levels: int | None = None) -> DataFrame:
    """``key, n_links, component_id, kept`` for every row."""
    rows, top = identified(table.select(F.col(key).alias("id"), F.col(embedding).alias("embedding"), F.col(label).alias("label")), "id")
    rows = rows.withColumnRenamed("row_id", "key")
    if levels is None:
        levels = levels_for(rows.where("label is not null").groupBy("label").count().agg(F.max("count")).first()[0] or 0)
    held = stored(signed(rows, levels, tables_for(levels)))
    full = held.where("digest is not null")
    copied = small_side(checkpointed(full.groupBy("digest").agg(F.min("key").alias("cls"), F.count(F.lit(1)).alias("n")).where("n > 1")))
    named = full.join(copied, "digest", "left").select("key", F.coalesce("cls", "key").alias("cls"), F.coalesce("n", F.lit(1)).cast("long").alias("n"), "buckets")
    first = named.where("key = cls")
    banded = first.select("key", F.explode("buckets").alias("bucket"))
    shared = banded.groupBy("bucket").agg(F.count(F.lit(1)).alias("_n")).where("_n > 1").select("bucket")
    near = stored(banded.join(shared, "bucket").select("bucket", "key"))
    keys = small_side(checkpointed(near.select("key").distinct()))
    vectors = stored(rows.select("key", "embedding").join(keys, "key", "left_semi"))
    mult = checkpointed(first.join(keys, "key", "left_semi").select("key", "n"))
    at = checkpointed(balls(near, vectors))
    counts, linked = links_between(near, at, vectors, mult)
    counts, linked = checkpointed(counts), checkpointed(linked)
    roots = components(gathered(linked, linked.count()))
    rows_of = at.join(mult, "key").groupBy("ball").agg(F.sum("n").alias("_rows"))
    own = counts.where("not whole").select("key", F.col("n").alias("_own"))
    whole = counts.where("whole").select(F.col("key").alias("ball"), F.col("n").alias("_whole"))
    zero = lambda c: F.coalesce(c, F.lit(0))
    classes = at.join(rows_of, "ball").join(own, "key", "left").join(whole, "ball", "left").join(roots.withColumnRenamed("id", "ball"), "ball", "left")
    classes = checkpointed(classes.select("key", (F.col("_rows") - 1 + zero("_own") + zero("_whole")).alias("n_links"), F.coalesce("root", "ball").alias("root")))
    least = classes.groupBy("root").agg(F.min("key").alias("component"))
    classes = classes.join(least, "root").select(F.col("key").alias("cls"), "n_links", "component")
    out = held.select("key").join(named.select("key", "cls", "n"), "key", "left").withColumn("cls", F.coalesce("cls", "key")).join(classes, "cls", "left")
    n_links = F.coalesce("n_links", F.col("n") - 1, F.lit(0)).cast("long").alias("n_links")
    out = out.select("key", n_links, F.coalesce("component", "cls").alias("component_id"))
    if top is None:
        return out.select(F.col("key").alias(key), "n_links", "component_id", (F.col("key") == F.col("component_id")).alias("kept"))
    # rows with a number of their own making: a component is named by its smallest real id, if it has any
    out = checkpointed(out.join(rows.select("key", "id"), "key"))
    out = out.withColumnRenamed("component_id", "_root").join(out.groupBy(F.col("component_id").alias("_root")).agg(F.min("id").alias("component_id")), "_root")
    kept = F.when(F.col("component_id").isNull(), F.col("key") == F.col("_root")).otherwise(F.coalesce(F.col("id") == F.col("component_id"), F.lit(False)))
    return out.select(F.col("id").alias(key), "n_links", "component_id", kept.alias("kept"))


def op13_cross_polytope(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_vectors(read(spark, sf_dir, "embeddings"))
