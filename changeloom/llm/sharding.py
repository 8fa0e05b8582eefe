"""Operator 4: sharding by proportional stratified interleaving.

Rows are shuffled inside each source by a seeded hash, ranked there, and sorted by the fractional
rank ``(rank - 1/2) / rows of the source``.  Cutting that order into equal runs gives shards that
each carry the mixture; row counts differ by one at most (law ``rows``).

Ranks are distributed: the hash (and later the fractional rank) is binned, bins are counted, and a
row's rank is its place in its bin plus the rows of the bins before, so a source that holds a third
of all rows is spread over many tasks.

Defined results: a null source is a stratum of its own, a null text has size 1 and crc32 0, equal
texts are not kept together (law ``rows``), repeated rows are placed one after the other (in the query
rows without an id, or that share one, are numbered and placed one by one), an empty
table gives no rows, other columns (sortable ones) pass through and may have any names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from changeloom.llm.common import checkpointed, identified, read, small_side, unit_hash

#: Rows that one bin holds on average once there are more than MIN_BINS such bins.
BIN_ROWS = 250_000
MIN_BINS = 1024


def ranked(df: DataFrame, group: str | None, position: Column, order: list[str], bins: int, out: str) -> DataFrame:
    """Adds the 1-based rank of each row by ``position`` in [0, 1) and ``order``, within ``group`` or over all."""
    df = df.withColumn("_bin", F.least(F.floor(position * bins), F.lit(bins - 1)).cast("int"))
    keys = [group, "_bin"] if group else ["_bin"]
    counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    # at most `bins` rows a group: a fixed number, whatever the input
    w = (W.partitionBy(group) if group else W.partitionBy(F.lit(0))).orderBy("_bin").rowsBetween(W.unboundedPreceding, -1)
    before = counts.select(*keys, F.coalesce(F.sum("_n").over(w), F.lit(0)).alias("_before"))
    placed = df.join(before, keys)
    rank = F.row_number().over(W.partitionBy(*keys).orderBy(*order)).cast("long") + F.col("_before")
    return placed.withColumn(out, rank).drop("_bin", "_before")


def interleave(df: DataFrame, key: str, source: str, shards: int, seed: int = 17) -> DataFrame:
    """Adds ``shard`` and the gapless 0-based ``slot`` inside it to a narrow frame."""
    given = df.select(F.col(key).alias("key"), F.col(source).alias("_source"), F.struct(*[F.col(f"`{c}`") for c in df.columns if c.lower() not in ("shard", "slot")]).alias("_row"))
    base = checkpointed(
        given.withColumn("_stratum", F.when(F.col("_source").isNull(), F.lit("n")).otherwise(F.concat(F.lit("s"), F.col("_source")))).withColumn("_u", unit_hash(F.lit(seed), F.col("key")))
    )
    rows = base.count()
    bins = max(MIN_BINS, -(-rows // BIN_ROWS))
    inside = ranked(base, "_stratum", F.col("_u"), ["_u", "key", "_row"], bins, "_rank")
    sizes = small_side(checkpointed(base.groupBy("_stratum").agg(F.count(F.lit(1)).alias("_size"))))
    frac = inside.join(sizes, "_stratum").withColumn("_frac", (F.col("_rank") - F.lit(0.5)) / F.col("_size"))
    order = ranked(frac, None, F.col("_frac"), ["_frac", "_stratum"], bins, "_place").withColumn("_at", F.col("_place") - 1)
    return (
        order.withColumn("shard", F.floor(F.col("_at") * F.lit(shards) / F.lit(max(rows, 1))).cast("int") if rows * shards < 1 << 52 else F.expr(f"cast(_at * {shards} div {rows} as int)"))
        .withColumn("slot", F.col("_at") - F.expr(f"(cast(shard as bigint) * {rows} + {shards - 1}) div {shards}"))
        .select("_row.*", "shard", "slot")
    )


def op4_interleaved_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.coalesce(F.col("text"), F.lit("")).cast("binary")
    narrow = read(spark, sf_dir, "documents").select("doc_id", "source", (F.octet_length(text) + 1).cast("long").alias("size"), F.crc32(text).alias("text_crc32"))
    named, _ = identified(narrow)  # rows without an id, or that share one, are placed one by one
    return interleave(named, "row_id", "source", 16).select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard")
    )
