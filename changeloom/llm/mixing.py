"""Operator 3: mixing sources to target weights by Pareto order sampling (DataFrame functions only).

Every source gets a target of words by water-filling.  Within a source a document's expected number of copies
grows with its length: it is proportional to ``1 + k / 8`` for a size of ``k`` binary digits, at most 3, and such that
the expected words are the target (water-filling again, over the source's at most 64 lengths ``k``).  The
whole part of that number is certain; the fraction is the document's inclusion
probability ``p`` in a Pareto sample.  Documents are ranked by their random odds ``u / (1 - u)``
over their inclusion odds ``p / (1 - p)`` and taken in that order until the words that the whole
copies leave open are filled (the document at the boundary is taken if that ends nearer the target).
The sample's fixed size is counted in words, since targets are.

The rank at which a source is cut is found without sorting a source in one task: odds are mapped to
(0, 1), binned, and only the bin that holds the cut is refined, twice; the last step sorts some
``rows / BINS ** 2`` rows.

Defined results: a null or empty text has size 0 and takes 0; null is a source of its own and comes
last; repeated rows draw the same number and are all taken or none (where the cut falls on them, all are),
but in the query rows without an id, or that share one, are numbered and draw one by one; an empty
table gives no rows; other columns pass through and may have any names, as may the columns made here.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from changeloom.llm.common import checkpointed, identified, read, small_side, unit_hash, word_count

BINS = 2048
WEIGHTS = (5.0, 2.0, 1.0)
MOST_COPIES = 3


def _level(s: DataFrame, group: Column, order: str) -> DataFrame:
    """Adds ``_level``: with it, the rows' ``least(_cap, _level * _w)`` sum to ``_total`` in each group (null: all are full).

    With rows in order of ``_cap / _w`` the level follows from running sums: it is that of the first row it doesn't fill.
    """
    all_, fill = W.partitionBy(group), W.partitionBy(group).orderBy("_full", order)
    s = s.withColumn("_full", F.col("_cap") / F.col("_w"))
    s = s.withColumn("_capped", F.coalesce(F.sum("_cap").over(fill.rowsBetween(W.unboundedPreceding, -1)), F.lit(0.0)))
    s = s.withColumn("_open", F.sum("_w").over(fill.rowsBetween(W.currentRow, W.unboundedFollowing)))
    s = s.withColumn("_at", (F.col("_total") - F.col("_capped")) / F.col("_open"))
    fixed = F.min(F.when(F.col("_at") <= F.col("_full"), F.struct("_full", order, "_at"))).over(all_)
    return s.withColumn("_level", fixed["_at"]).drop("_full", "_capped", "_open", "_at")


def targets(sizes: DataFrame, weights: tuple[float, ...] = WEIGHTS, most: int = MOST_COPIES) -> DataFrame:
    """``stratum, source_size`` -> also ``target``: shares by repeating weights, none above ``most`` times its source.  One row a source."""
    by_name = W.partitionBy(F.lit(0)).orderBy("stratum")
    pick = F.element_at(F.array(*[F.lit(float(x)) for x in weights]), (F.row_number().over(by_name) - 1) % len(weights) + 1)
    s = sizes.withColumn("_w", pick).withColumn("_cap", (F.col("source_size") * most).cast("double")).withColumn("_total", F.sum("source_size").over(W.partitionBy(F.lit(0))).cast("double"))
    s = _level(s, F.lit(0), "stratum")
    filled = F.least("_cap", F.coalesce("_level", F.lit(float("inf"))) * F.col("_w"))
    return s.withColumn("target", F.when(F.col("source_size") == 0, 0.0).otherwise(filled)).drop(*[c for c in s.columns if c.startswith("_")])


def expected_copies(sizes: DataFrame, most: int = MOST_COPIES) -> DataFrame:
    """``stratum, k, words, target`` -> also ``whole`` and ``p``: certain copies and the probability of one more.  One row a length in a source."""
    grows = 1 + F.col("k") / 8
    s = sizes.withColumn("_w", grows * F.col("words")).withColumn("_cap", (F.col("words") * most).cast("double")).withColumn("_total", F.col("target"))
    s = _level(s.where("words > 0"), F.col("stratum"), "k")
    mean = F.least(F.lit(float(most)), F.coalesce("_level", F.lit(float("inf"))) * grows)
    s = s.withColumn("whole", F.floor(mean + F.lit(1e-12)).cast("long"))
    return s.withColumn("p", F.greatest(F.lit(0.0), mean - F.col("whole"))).drop("_w", "_cap", "_total", "_level")


def _cut(hist: DataFrame, at: str) -> DataFrame:
    """For each stratum the bin where the running words reach ``_open``, and the words still open at its start."""
    w = W.partitionBy("stratum").orderBy(at)
    s = hist.withColumn("_after", F.sum("_words").over(w.rowsBetween(W.unboundedPreceding, W.currentRow)))
    return s.where((F.col("_after") >= F.col("_open")) & (F.col("_after") - F.col("_words") < F.col("_open"))).select("stratum", at, (F.col("_open") - F.col("_after") + F.col("_words")).alias("_open"))


def pareto_mix(docs: DataFrame, key: str = "doc_id", source: str = "source", size: str = "size", seed: int = 29) -> DataFrame:
    """Adds ``source_size, target, copies, taken`` (copies: 0 to 3) to narrow rows with a key, a source and a size."""
    made = ("source_size", "target", "copies", "taken")
    given = docs.select(F.col(key).alias("key"), F.col(source).alias("_source"), F.col(size).alias("size"), F.struct(*[F.col(f"`{c}`") for c in docs.columns if c.lower() not in made]).alias("_row"))
    base = checkpointed(
        given.withColumn("stratum", F.when(F.col("_source").isNull(), F.lit("n")).otherwise(F.concat(F.lit("a"), F.col("_source")))).withColumn("_u", unit_hash(F.lit(seed), F.col("key"))).withColumn("k", F.length(F.bin("size")))
    )
    words = checkpointed(base.groupBy("stratum", "k").agg(F.sum("size").alias("words")))
    per = targets(words.groupBy("stratum").agg(F.sum("words").alias("source_size")))
    per = checkpointed(per)
    lengths = checkpointed(expected_copies(words.join(per, "stratum")))
    open_ = lengths.groupBy("stratum").agg((F.first("target") - F.sum(F.col("whole") * F.col("words"))).alias("_open"))
    per = checkpointed(per.join(open_, "stratum", "left").withColumn("_open", F.greatest(F.lit(0.0), F.coalesce("_open", F.lit(0.0)))))
    ranked = base.join(small_side(per), "stratum").join(small_side(lengths.select("stratum", "k", "whole", "p")), ["stratum", "k"], "left").fillna({"whole": 0, "p": 0.0})
    p, u = F.col("p"), F.col("_u")
    odds = F.when(p > 0, (u / (1 - u)) / (p / (1 - p)))
    ranked = ranked.withColumn("_q", odds / (1 + odds))
    ranked = ranked.withColumn("_b1", F.floor(F.col("_q") * BINS)).withColumn("_b2", F.floor((F.col("_q") * BINS - F.col("_b1")) * BINS))
    open_ = ranked.where(p > 0).select("stratum", "key", "size", "_open", "_q", "_b1", "_b2")
    first = checkpointed(_cut(open_.groupBy("stratum", "_b1").agg(F.sum("size").alias("_words"), F.first("_open").alias("_open")), "_b1"))
    inner = open_.drop("_open").join(small_side(first), ["stratum", "_b1"])
    second = checkpointed(_cut(inner.groupBy("stratum", "_b1", "_b2").agg(F.sum("size").alias("_words"), F.first("_open").alias("_open")), "_b2"))
    edge = open_.drop("_open").join(small_side(first.drop("_open")), ["stratum", "_b1"]).join(small_side(second), ["stratum", "_b2"])
    place = W.partitionBy("stratum").orderBy("_q", "key").rowsBetween(W.unboundedPreceding, W.currentRow)
    edge = edge.withColumn("_after", F.sum("size").over(place)).where(2 * F.col("_after") - F.col("size") <= 2 * F.col("_open"))
    last = edge.groupBy("stratum").agg(F.max(F.struct("_q", "key")).alias("_last"))
    cut = first.select("stratum", F.col("_b1").alias("_c1")).join(second.select("stratum", F.col("_b2").alias("_c2")), "stratum", "left").join(last, "stratum", "left")
    cut = checkpointed(cut)
    whole = ranked.join(small_side(cut), "stratum", "left")
    here = F.struct("_q", "key")
    extra = (
        F.when(p <= 0, 0)
        .when(F.col("_c1").isNull(), F.when(F.col("_open") > 0, 1).otherwise(0))  # the open words take all of the source
        .when(F.col("_b1") != F.col("_c1"), (F.col("_b1") < F.col("_c1")).cast("int"))
        .when(F.col("_b2") != F.coalesce(F.col("_c2"), F.lit(BINS)), (F.col("_b2") < F.coalesce(F.col("_c2"), F.lit(BINS))).cast("int"))
        .otherwise(F.coalesce((here <= F.col("_last")).cast("int"), F.lit(0)))
    )
    whole = whole.withColumn("copies", (F.col("whole") + extra).cast("int"))
    return whole.select("_row.*", "source_size", "target", "copies", (F.col("copies") * F.col("size")).cast("long").alias("taken"))


def op3_pareto_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    narrow = read(spark, sf_dir, "documents").select("doc_id", "source", word_count("text").alias("size"))
    named, _ = identified(narrow)  # rows without an id, or that share one, draw one by one
    return pareto_mix(named, "row_id").select("doc_id", "size", "source_size", "target", "taken")


#: The same mix as one statement: sources ranked and filled by windows, the cut found by running words.
OP3_SQL = r"""
WITH d AS (SELECT doc_id, source, CAST(coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS BIGINT) AS size,
    (CAST(('0x' || substr(md5('29:' || coalesce(CAST(doc_id AS VARCHAR), '')), 1, 13)) AS BIGINT) + 0.5::DOUBLE) / 4503599627370496.0::DOUBLE AS u FROM documents),
s AS (SELECT source, sum(size)::BIGINT AS source_size FROM d GROUP BY source),
w AS (SELECT *, CASE (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 WHEN 0 THEN 5.0::DOUBLE WHEN 1 THEN 2.0::DOUBLE ELSE 1.0::DOUBLE END AS wt FROM s),
c AS (SELECT *, 3.0::DOUBLE * source_size AS cap, 3.0::DOUBLE * source_size / wt AS full_at, sum(source_size) OVER ()::DOUBLE AS total FROM w),
l AS (SELECT *, (total - coalesce(sum(cap) OVER (ORDER BY full_at, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0.0))
    / sum(wt) OVER (ORDER BY full_at, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS lev FROM c),
t AS (SELECT source, source_size, CASE WHEN source_size = 0 THEN 0.0::DOUBLE ELSE least(cap, wt * (SELECT lev FROM l WHERE lev <= full_at ORDER BY full_at, source NULLS LAST LIMIT 1)) END AS target FROM l),
k AS (SELECT source, length(bin(size)) AS k, sum(size)::BIGINT AS words FROM d WHERE size > 0 GROUP BY ALL),
v AS (SELECT k.*, target, 1 + k / 8.0::DOUBLE AS g, (1 + k / 8.0::DOUBLE) * words AS wt, 3.0::DOUBLE * words AS cap FROM k JOIN t ON k.source IS NOT DISTINCT FROM t.source),
f AS (SELECT *, cap / wt AS full_at, (target - coalesce(sum(cap) OVER (PARTITION BY source ORDER BY cap / wt, k ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0.0))
    / sum(wt) OVER (PARTITION BY source ORDER BY cap / wt, k ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS lev FROM v),
m AS (SELECT *, least(3.0::DOUBLE, coalesce(arg_min(CASE WHEN lev <= full_at THEN lev END, CASE WHEN lev <= full_at THEN full_at END) OVER (PARTITION BY source), 'infinity'::DOUBLE) * g) AS mean FROM f),
r AS (SELECT *, floor(mean + 1e-12)::BIGINT AS whole, greatest(0.0::DOUBLE, mean - floor(mean + 1e-12)) AS p FROM m),
o AS (SELECT source, max(target) - sum(whole * words) AS open_words FROM r GROUP BY source),
q AS (SELECT d.*, source_size, t.target, coalesce(whole, 0) AS whole, coalesce(p, 0) AS p, greatest(0.0, coalesce(open_words, 0)) AS open_words,
    CASE WHEN p > 0 THEN (u / (1 - u)) / (p / (1 - p)) END AS odds
    FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source LEFT JOIN r ON d.source IS NOT DISTINCT FROM r.source AND length(bin(size)) = r.k AND size > 0 LEFT JOIN o ON d.source IS NOT DISTINCT FROM o.source),
a AS (SELECT *, sum(size) OVER (PARTITION BY source, p > 0 ORDER BY odds / (1 + odds), doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS upto FROM q)
SELECT doc_id, size, source_size, target, CAST(size * (whole + CASE WHEN p > 0 AND open_words > 0 AND 2 * upto - size <= 2 * open_words THEN 1 ELSE 0 END) AS BIGINT) AS taken FROM a
"""
