"""Operator 7: document fingerprints by SpotSigs (DataFrame functions only).

A signature is a common word (anchor) with the two content words that follow it; anchors in between
are skipped, and of a run of anchors the last one counts.  A fingerprint is the set of a text's
signatures.  Near-duplicates are compared by Jaccard similarity: sets are partitioned by length, so
that only neighbouring partitions can hold similar sets, candidates come from an inverted index over
the rarest signatures of each set, and pairs whose lengths or places rule the threshold out are never compared.
In a list of the index every set is compared with the most central one; only sets of other components than the
list's largest meet the rest, so that a group of near copies stays linear.

Defined results: a text without any signature is the set of its words, and one without words is one
signature of the whole text (null counts as empty); equal texts have equal fingerprints; repeated
rows are neighbours of each other in ``doc_id`` order, rows without ``doc_id`` come last, by a hash of their texts; a
near-duplicate class of such rows alone has no name (null); an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from changeloom.llm.common import checkpointed, gathered, read, small_side, stored
from changeloom.llm.minhash import components, crossing, rooted, star_heads

#: Anchors are common words of English, German, French and Spanish.
ANCHORS = (
    "a an and are as at be by for from in is it of on or that the this to was with "
    "auf das dem den der des die ein eine ist mit nicht sich und von zu "
    "au aux avec dans de du elle en est et la le les ou par pas pour que qui sur un une "
    "al como con del el es las lo los no para por se su una y"
).split()
CHAIN = r"\|(?=([^ ]+ [^ |]+(?: \|[^ ]+)? [^ |]+))"
#: Rows of neighbouring keys that are put in order together, about.
BIN_ROWS = 4096
#: Keys are cut at so many quantiles squared, and between two of them evenly.
QUANTILES = 32
#: Fingerprints are near duplicates from this Jaccard similarity.
NEAR_PERCENT = 80


def once(df: DataFrame, name: str, value: Column) -> DataFrame:
    """Adds a column that is computed once a row, however often later expressions use it."""
    return df.select("*", F.explode(F.array(value)).alias(name))


def signatures(df: DataFrame, text: str, out: str, anchors: list[str] = ANCHORS) -> DataFrame:
    """Adds ``out array<int>``: the sorted distinct signature hashes of a text that isn't null."""
    words = F.concat(F.lit(" "), F.regexp_replace(F.lower(F.col(text)), r"[^\p{L}\p{N}]+", " "), F.lit(" "))
    df = once(df, "_words", words)
    marked = F.regexp_replace("_words", f" (?=(?:{'|'.join(anchors)}) )", " |")
    df = once(df, "_marked", F.regexp_replace(marked, r"\|[^ ]+ (?=\|)", ""))
    chains = F.regexp_extract_all(F.col("_marked"), F.lit(CHAIN), F.lit(1))
    df = once(df, "_chains", F.transform(chains, lambda c: F.hash(F.regexp_replace(c, r" \|[^ ]+", ""))))
    plain = F.transform(F.filter(F.split(F.col("_words"), " "), lambda w: w != ""), lambda w: F.hash(w))
    df = once(df, "_sigs", F.when(F.size("_chains") > 0, F.col("_chains")).otherwise(plain))
    filled = F.when(F.size("_sigs") > 0, F.array_sort(F.array_distinct("_sigs"))).otherwise(F.array(F.hash(F.col(text))))
    return once(df, out, filled).drop("_words", "_marked", "_chains", "_sigs")


def spelled(sigs: Column) -> Column:
    """A fingerprint as text: 8 hexadecimal digits for each signature, in order."""
    return F.array_join(F.transform(sigs, lambda x: F.lpad(F.lower(F.hex(x.cast("long").bitwiseAND(F.lit(0xFFFFFFFF)))), 8, "0")), " ")


def jaccard(a: Column, b: Column) -> Column:
    """Likeness of two fingerprints that aren't empty."""
    common = F.size(F.array_intersect(a, b))
    return common / (F.size(a) + F.size(b) - common)


def near_classes(prints: DataFrame, percent: int = NEAR_PERCENT) -> DataFrame:
    """``id, root`` of the sets (``id, sigs``, unique by ``id``) that have a near one: the smallest id reachable."""
    sets = prints.select(F.col("id").alias("key"), "sigs", F.size("sigs").cast("long").alias("n"))
    held = sets.select("key", F.explode("sigs").alias("h"))
    counts = checkpointed(held.groupBy("h").agg(F.count(F.lit(1)).alias("df")).where("df > 1"))
    # signatures of one set alone come first in its order and lead to nothing, so the others alone are shuffled by set
    by_set = W.partitionBy("key")
    ranked = held.join(counts, "h").withColumn("_k", F.row_number().over(by_set.orderBy("df", "h"))).withColumn("_all", F.count(F.lit(1)).over(by_set))
    ranked = ranked.join(sets.select("key", "n"), "key").withColumn("r", F.col("n") - F.col("_all") + F.col("_k"))
    # a set and a near one share a signature among the rarest n - ceil(0.8 n) + 1 of each
    index = stored(ranked.where(F.col("r") <= F.col("n") - F.ceil(F.col("n") * percent / 100) + 1).select("h", "key", "n", "r"))
    part = F.floor(F.log(F.col("n")) / F.lit(-math.log(percent / 100)) + 1e-9).cast("long")  # sizes of one part or the next can be near
    lists = index.select("key", F.explode(F.array(part - 1, part)).alias("part"), "h").select("key", (F.col("h").cast("long") * 4096 + F.col("part")).alias("bucket"))
    shared = lists.groupBy("bucket").agg(F.count(F.lit(1)).alias("c")).where("c > 1").select("bucket")
    near = stored(lists.join(shared, "bucket"))
    near = stored(near.join(star_heads(near), "bucket"), near.count())
    links = checkpointed(confirmed(near.where("key <> head").select(F.col("head").alias("a"), F.col("key").alias("b")), sets, percent))
    links = gathered(links, links.count())
    roots = checkpointed(components(links))
    more = checkpointed(confirmed(crossing(rooted(index, roots), percent), sets, percent))
    return components(links.unionByName(more))


def confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The distinct pairs ``a, b`` whose sets (``key, n, sigs``) are near; sizes are compared before the sets are fetched."""
    size = lambda c: sets.select(F.col("key").alias(c), F.col("n").alias(f"_n{c}"))
    full = lambda c: sets.select(F.col("key").alias(c), F.col("sigs").alias(f"_s{c}"))
    fit = pairs.distinct().join(size("a"), "a").join(size("b"), "b").where(100 * F.least("_na", "_nb") >= percent * F.greatest("_na", "_nb"))
    both = fit.join(full("a"), "a").join(full("b"), "b").withColumn("_c", F.size(F.array_intersect("_sa", "_sb")))
    return both.where(100 * F.col("_c") >= percent * (F.col("_na") + F.col("_nb") - F.col("_c"))).select("a", "b")


def near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text", percent: int = NEAR_PERCENT) -> DataFrame:
    """``key, n_signatures, near_class`` for every row: the smallest ``key`` of its near-duplicates (its own if there are none).

    Equal fingerprints are one set, named by one of its rows.
    """
    prints = signatures(docs.select(F.col(key).alias("doc"), F.coalesce(F.col(text), F.lit("")).alias("_t")), "_t", "sigs").drop("_t")
    rows = stored(prints.withColumn("row", F.monotonically_increasing_id()).withColumn("fp", F.md5(F.col("sigs").cast("string"))))
    copied = small_side(checkpointed(rows.groupBy("fp").agg(F.min("row").alias("id"), F.count(F.lit(1)).alias("c")).where("c > 1").select("fp", "id")))
    member = checkpointed(rows.select("row", "doc", "fp", F.size("sigs").cast("long").alias("n_signatures")).join(copied, "fp", "left").select("row", "doc", "n_signatures", F.coalesce("id", "row").alias("id")))
    others = small_side(checkpointed(member.where("row <> id").select("row")))
    sets = rows.select("row", "sigs").join(others, "row", "left_anti").withColumnRenamed("row", "id")
    roots = small_side(checkpointed(near_classes(sets, percent)))
    named = checkpointed(member.join(roots, "id", "left").select("doc", "n_signatures", F.coalesce("root", "id").alias("root")))
    least = small_side(checkpointed(named.groupBy("root").agg(F.min("doc").alias("near_class"))))
    return named.join(least, "root").select(F.col("doc").alias(key), "n_signatures", "near_class")


def bin_of(df: DataFrame, key: str, hashed: str) -> Column:
    """The range of a row's key as a struct that sorts like the key, nulls first.

    Keys lie between QUANTILES ** 2 - 1 approximate quantiles; between two of these ranges are even and hold some
    BIN_ROWS rows.  Rows without a key are dealt by their hash.
    """
    cuts = [i / QUANTILES**2 for i in range(1, QUANTILES**2)]
    n, none, low, high, found = df.agg(F.count(F.lit(1)), F.sum(F.col(key).isNull().cast("long")), F.min(key), F.max(key), F.percentile_approx(key, cuts, 20_000)).first()
    nulls = F.pmod(F.col(hashed), F.lit(-(-(none or 0) // BIN_ROWS) or 1))
    if low is None:
        return F.struct(F.lit(-1).alias("q"), nulls.alias("k"))
    bounds = [low, *found]
    rows = [bounds[i : i + QUANTILES] for i in range(0, len(bounds), QUANTILES)]
    under = lambda a: F.size(F.filter(a, lambda b: b <= F.col(key)))
    many = lambda xs: F.array(*[F.lit(x).cast("long") for x in xs])
    i = under(many([r[0] for r in rows])) - 1
    j = under(F.get(F.array(*[many(r) for r in rows]), i)) - 1
    at = i * QUANTILES + j
    parts = -(-n // (len(bounds) * BIN_ROWS))
    widths = [max(1, -(-(b - a) // parts)) for a, b in zip(bounds, [*bounds[1:], high + 1])]
    inside = F.floor((F.col(key) - F.get(many(bounds), at)) / F.get(many(widths), at))
    return F.when(F.col(key).isNull(), F.struct(F.lit(-1).alias("q"), nulls.alias("k"))).otherwise(F.struct(at.alias("q"), inside.cast("long").alias("k")))


def with_next(df: DataFrame, key: str, text: str, derive) -> DataFrame:
    """``derive(df)`` with ``next_<c>`` of each of its columns but ``key``: the values of the row with the next smaller key (after the last: the first).

    Keys are cut into ranges; a copy of the first row of each range stands at the end of the range before (in the
    order of the result), so that one window over ranges sees all neighbours and ``derive`` works once a row.
    """
    df = df.select(key, text, F.xxhash64(text).alias("_h"))
    bin_ = bin_of(df, key, "_h")
    # the first row of each range is found by key and hash alone
    firsts = checkpointed(df.groupBy(bin_.alias("_bin")).agg(F.max(F.struct(key, "_h")).alias("_f")))
    order = W.partitionBy(F.lit(0)).orderBy(F.desc("_bin"))  # one row for each range of BIN_ROWS rows
    ranges = firsts.select("_bin", F.col(f"_f.{key}").alias("_k"), F.col("_f._h").alias("_fh"), F.lag("_bin").over(order).alias("_to"))
    end = firsts.agg(F.min("_bin")).first()[0] or (0, 0)
    ranges = checkpointed(ranges.select("_k", "_fh", F.coalesce("_to", F.struct(F.lit(end[0]).alias("q"), F.lit(end[1]).cast("long").alias("k"))).alias("_bin")))
    copies = df.join(small_side(ranges), df[key].eqNullSafe(F.col("_k")) & (F.col("_h") == F.col("_fh"))).groupBy("_bin", key, "_h").agg(F.min(text).alias(text))
    both = df.withColumn("_bin", bin_).withColumn("_copy", F.lit(False)).unionByName(copies.withColumn("_copy", F.lit(True)))
    rows = derive(both)
    carried = [c for c in rows.columns if c not in (key, "_bin", "_h", "_copy")]
    place = W.partitionBy("_bin").orderBy("_copy", F.desc_nulls_last(key), F.desc("_h"), text)
    return rows.select("*", *[F.lead(c).over(place).alias(f"next_{c}") for c in carried]).where(~F.col("_copy")).drop("_bin", "_h", "_copy")


def compared(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key, n_chars, edited_sha256, sigs, edited_sigs, near_edited, near_next``: each text beside its edited text and the next document."""
    docs = docs.select(F.col(key).alias("key"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    rows = with_next(docs, "key", "text", lambda d: signatures(d, "text", "sigs"))
    rows = rows.withColumn("n_chars", F.length("text").cast("long"))
    cut = F.floor(F.col("n_chars") / 3).cast("int")
    rows = once(rows, "edited", F.concat(F.substring("text", F.lit(1), F.col("n_chars").cast("int") - cut), F.substring("next_text", F.lit(1), cut)))
    rows = signatures(rows.drop("text", "next_text"), "edited", "edited_sigs")
    near = [jaccard(F.col("sigs"), F.col("edited_sigs")).alias("near_edited"), jaccard(F.col("sigs"), F.col("next_sigs")).alias("near_next")]
    return rows.select(F.col("key").alias(key), "n_chars", F.sha2("edited", 256).alias("edited_sha256"), "sigs", "edited_sigs", *near)


def op7_spotsigs(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = compared(read(spark, sf_dir, "documents").select("doc_id", "text"))
    return rows.select("doc_id", "n_chars", "edited_sha256", spelled(F.col("sigs")).alias("fingerprint"), spelled(F.col("edited_sigs")).alias("edited_fingerprint"), "near_edited", "near_next")


def spotsigs_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The other half of operator 7: near-duplicate classes of all documents by their fingerprints."""
    return near_duplicates(read(spark, sf_dir, "documents"))
