"""Snapshot scans, chunking, and the merge of snapshot chunks with the live stream.

Chunks never need a global sort in one task: boundaries come from approximate quantiles (or exactly,
from a ranked key table), and chunk ids from comparing with them.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from changeloom.operators.history import for_events
from changeloom.operators.ranges import by_bounds

MARKERS = ("first", "first_in_data_collection", "true", "last_in_data_collection", "last")


def scan(spark: SparkSession, tables: dict[str, DataFrame], overrides: dict[str, str] | None = None, conditions: dict[str, str] | None = None) -> DataFrame:
    """Rows of all captured tables as reads (JSON images, since tables differ); an override replaces a table's SELECT."""
    out = None
    for name, df in tables.items():
        if overrides and name in overrides:
            df = spark.sql(overrides[name], **{name: df})
        if conditions and name in conditions:
            df = df.where(conditions[name])
        rows = df.select(F.lit("r").alias("op"), F.lit(name).alias("tbl"), F.to_json(F.struct("*")).alias("after"))
        out = rows if out is None else out.unionByName(rows)
    return out


def reads(rows: DataFrame, table: str) -> DataFrame:
    """One table's rows as read events."""
    return rows.select(F.lit("r").alias("op"), F.lit(table).alias("tbl"), F.struct("*").alias("after"))


def with_markers(rows: DataFrame, key: str, table: str = "tbl") -> DataFrame:
    """Adds ``snapshot``: first and last overall and in each table.  ``key`` is unique in a table.

    Positions come from the smallest and largest key of each table (one small aggregate), not from a sort.
    """
    ends = rows.groupBy(table).agg(F.min(key).alias("_lo"), F.max(key).alias("_hi"))
    order = W.partitionBy(F.lit(0)).orderBy(table)  # one row for each table
    ends = ends.withColumn("_f", F.row_number().over(order) == 1).withColumn("_l", F.lead(table).over(order).isNull())
    at_first, at_last = F.col(key) == F.col("_lo"), F.col(key) == F.col("_hi")
    mark = F.when(at_last & F.col("_l"), "last").when(at_first & F.col("_f"), "first").when(at_last, "last_in_data_collection").when(at_first, "first_in_data_collection").otherwise("true")
    return rows.join(ends, table).withColumn("snapshot", mark).drop("_lo", "_hi", "_f", "_l")


def after_key(keys: list[str], values: list, nullable: set[str] = frozenset(), nulls_first: bool = True) -> Column:
    """Rows after a key in ``ORDER BY keys``: ``(k1 > v1) OR (k1 = v1 AND k2 > v2) ...`` with the place of nulls."""
    out = F.lit(False)
    for k in range(len(keys) - 1, -1, -1):
        c, v = F.col(keys[k]), values[k]
        if keys[k] in nullable:
            greater = (c.isNotNull() if nulls_first else F.lit(False)) if v is None else (c > F.lit(v)) if nulls_first else (c > F.lit(v)) | c.isNull()
        else:
            greater = c > F.lit(v)
        same = c.eqNullSafe(F.lit(v))
        out = greater | (same & out) if k < len(keys) - 1 else greater
    return F.coalesce(out, F.lit(False))


def after_key_row(keys: list[str], values: list) -> Column:
    """The same for keys without nulls, as one comparison of rows."""
    typed = lambda k, v: F.when(F.lit(False), F.col(k)).otherwise(F.lit(v)).alias(k)  # noqa: E731  a literal of the column's type
    return F.struct(*[F.col(k) for k in keys]) > F.struct(*[typed(k, v) for k, v in zip(keys, values)])


def max_key(rows: DataFrame, keys: list[str]) -> DataFrame:
    """The largest key, by one aggregate."""
    return rows.agg(F.max(F.struct(*keys)).alias("_k")).select("_k.*")


def next_chunk(rows: DataFrame, keys: list[str], last: list | None, most: list | None, size: int = 1024, condition: str | None = None) -> DataFrame:
    """One chunk of keyset paging.  The upper bound holds for all chunks but the first."""
    rows = rows.where(condition) if condition else rows
    if last is not None:
        rows = rows.where(after_key(keys, last))
        if most is not None:
            rows = rows.where(~after_key(keys, most))
    return rows.orderBy(*keys).limit(size)


def chunk_count(rows: int, rows_per_chunk: int, threads: int, multiplier: int = 1) -> int:
    """min(threads * multiplier, rows / rows per chunk), one at least."""
    return max(1, min(threads * multiplier, -(-rows // max(1, rows_per_chunk))))


#: Bins that each open rank is looked for in at once.
RANK_BINS = 256


def order_statistics(rows: DataFrame, key: str, ranks: list[int]) -> dict[int, float]:
    """The values of a numeric key at 0-based ranks (nulls don't count), without a sort.

    Rows are counted in bins between the smallest and the largest value, and the bin that holds a rank is cut into bins again until it holds one
    value.  The driver sees RANK_BINS short rows a rank and round; a round reads the key column between the values that are still open.
    """
    low, high = rows.agg(F.min(key), F.max(key)).first()
    open_, found = {r: (low, high, 0) for r in set(ranks)}, {}
    while open_:
        spans = sorted({(lo, hi) for lo, hi, _ in open_.values()})  # equal or apart
        at = by_bounds(F.col(key), [F.lit(lo) for lo, _ in spans[1:]])
        lows, widths = (F.array(*[F.lit(float(x)) for x in column]) for column in ([lo for lo, _ in spans], [(hi - lo) / RANK_BINS or 1 for lo, hi in spans]))
        inside = F.lit(False)
        for lo, hi in spans:
            inside = inside | F.col(key).between(lo, hi)
        binned = rows.where(inside).select(F.col(key).alias("v"), at.alias("s"))
        bins = binned.groupBy("s", F.least(F.floor((F.col("v") - F.get(lows, F.col("s"))) / F.get(widths, F.col("s"))), F.lit(RANK_BINS - 1)).alias("b")).agg(F.count(F.lit(1)).alias("n"), F.min("v").alias("lo"), F.max("v").alias("hi")).collect()
        held = {i: sorted((r for r in bins if r["s"] == i), key=lambda r: r["b"]) for i in range(len(spans))}
        for rank, (lo, hi, below) in list(open_.items()):
            for r in held[spans.index((lo, hi))]:
                if below + r["n"] > rank:
                    break
                below += r["n"]
            if r["lo"] == r["hi"]:
                found[rank] = r["lo"]
                del open_[rank]
            else:
                open_[rank] = r["lo"], r["hi"], below
    return found


def boundaries(rows: DataFrame, key: str, chunks: int, exact: bool = False) -> list:
    """The ``chunks - 1`` lower bounds that cut a table into even parts (a list as long as the number of chunks); exact ones lie between two keys, as percentiles do."""
    cuts = [i / chunks for i in range(1, chunks)]
    if not cuts:
        return []
    if not exact:
        return sorted(set(rows.agg(F.percentile_approx(key, F.array(*[F.lit(c) for c in cuts]), F.lit(10_000))).first()[0] or []))
    n = rows.where(F.col(key).isNotNull()).count()
    if not n:
        return []
    places = [c * (n - 1) for c in cuts]
    values = order_statistics(rows, key, [r for p in places for r in (math.floor(p), math.ceil(p))])
    between = lambda p: float(values[math.floor(p)]) + (p - math.floor(p)) * float(values[math.ceil(p)] - values[math.floor(p)])
    return sorted({between(p) for p in places})


def with_chunks(rows: DataFrame, key: str, lower_bounds: list) -> DataFrame:
    """Adds ``chunk``: the number of inclusive lower bounds at or below the key."""
    chunk = F.when(F.col(key).isNull(), F.lit(None)).otherwise(by_bounds(F.col(key), [F.lit(b) for b in sorted(lower_bounds)]))
    return rows.withColumn("chunk", chunk.cast("int"))


#: Rows that one task ranks, about, and sampled keys for each such range.
RANGE_ROWS, RANGE_SAMPLES = 250_000, 32


def paged(rows: DataFrame, keys: list[str], size: int, range_rows: int = RANGE_ROWS) -> DataFrame:
    """Adds ``chunk_id``, the keyset page of each row, all at once.

    Ranks are made in ranges of the whole key, whose number follows from the rows and whose bounds are quantiles of a sample (a bounded number of keys
    a range, the smallest by a hash, so that a rerun takes the same), and shifted by the rows of the ranges before.  No value of the first key is too frequent for that.
    """
    ranges = max(-(-rows.count() // range_rows), rows.sparkSession.sparkContext.defaultParallelism)
    some = rows.select(*keys, F.xxhash64(*keys).alias("_h")).orderBy("_h", *keys).limit(RANGE_SAMPLES * ranges).drop("_h")
    kinds = [some.schema[k].dataType for k in keys]
    order = F.struct(*[F.col(k) for k in keys])
    sample = some.select(F.percent_rank().over(W.partitionBy(F.lit(0)).orderBy(*keys)).alias("_p"), *keys)  # a bounded number of rows
    cuts = sample.withColumn("_g", F.floor(F.col("_p") * ranges)).groupBy("_g").agg(F.min(order).alias("k")).orderBy("_g").select("k.*").collect()
    bounds = [F.struct(*[F.lit(v).cast(t).alias(k) for k, v, t in zip(keys, r, kinds)]) for r in cuts[1:]]
    ranged = rows.withColumn("_g", by_bounds(order, bounds))
    before = ranged.groupBy("_g").agg(F.count(F.lit(1)).alias("_n"))  # one row a range
    before = before.select("_g", F.coalesce(F.sum("_n").over(W.partitionBy(F.lit(0)).orderBy("_g").rowsBetween(W.unboundedPreceding, -1)), F.lit(0)).alias("_b"))
    rank = F.row_number().over(W.partitionBy("_g").orderBy(*keys)) + F.col("_b")
    return ranged.join(before, "_g").withColumn("chunk_id", F.floor((rank - 1) / size)).drop("_g", "_b")


def table_order(counts: dict[str, int | None], how: str = "disabled") -> list[str]:
    """Tables by row count; unknown counts are 0 and ties keep their order."""
    names = list(counts)
    return names if how == "disabled" else sorted(names, key=lambda n: counts[n] or 0, reverse=how == "descending")


MODES = ("always", "initial", "initial_only", "no_data", "recovery", "when_needed", "when_needed_no_data", "configuration_based")


def decide(mode: str, offset_exists: bool, in_progress: bool, log_available: bool = True, custom: tuple[bool, bool, bool] | None = None) -> tuple[bool, bool, bool]:
    """Whether to snapshot data, snapshot the schema, and stream."""
    if mode not in MODES:
        raise ValueError(f"no snapshot mode {mode}")
    if mode == "configuration_based":
        return custom or (False, False, False)
    missing = not offset_exists or in_progress  # nothing to go on from, or a snapshot that broke off
    needed = missing or (mode.startswith("when_needed") and not log_available)
    data = mode == "always" or (needed and mode in ("initial", "initial_only", "when_needed"))
    schema = needed or mode in ("always", "recovery")
    return data, schema, mode != "initial_only"


def deduplicated(chunks: DataFrame, windows: DataFrame, events: DataFrame, keys: list[str], skipped: tuple[str, ...] = ()) -> DataFrame:
    """Snapshot chunks merged with the stream: a chunk row goes if its key has an event inside the chunk's window.

    ``chunks``: ``chunk_id, tbl, keys, after``; ``windows``: ``chunk_id, low, high``; an event counts with
    ``low < seq <= high``, whatever its operation, unless skipped.  Rows come at ``seq = high`` with ``sub`` 0
    and marker ``incremental``; events follow with ``sub`` 1.
    """
    live = events.where(~F.col("op").isin(*skipped)) if skipped else events
    seen = live.select("tbl", *[F.coalesce(F.col(f"after.{k}"), F.col(f"before.{k}")).alias(k) for k in keys], F.col("seq").alias("_at"))
    rows = chunks.join(windows, "chunk_id")
    on = [rows["tbl"].eqNullSafe(seen["tbl"]), *[rows[k].eqNullSafe(seen[k]) for k in keys], seen["_at"] > rows["low"], seen["_at"] <= rows["high"]]
    left = rows.join(seen, on, "left_anti").select(F.col("high").alias("seq"), F.lit(0).alias("sub"), "tbl", F.lit("r").alias("op"), *keys, "after", F.lit("incremental").alias("snapshot"))
    named = [F.coalesce(F.col(f"after.{k}"), F.col(f"before.{k}")).alias(k) for k in keys]
    return left.unionByName(live.select("seq", F.lit(1).alias("sub"), "tbl", "op", *named, "after", F.lit("false").alias("snapshot")))


def windows_from_signals(signals: DataFrame, position: str = "seq") -> DataFrame:
    """Windows from the open and close rows that a snapshot writes into its signal table (ids ``<chunk>-open``, ``<chunk>-close``)."""
    chunk = F.regexp_replace("id", "-(open|close)$", "")
    kind = F.col("type")
    return signals.groupBy(chunk.alias("chunk_id")).agg(F.max(F.when(kind == "snapshot-window-open", F.col(position))).alias("low"), F.max(F.when(kind == "snapshot-window-close", F.col(position))).alias("high")).where("high is not null")


def windows_from_transactions(marks: DataFrame, events: DataFrame, tx: str = "tx_id", width: int = 65_536) -> DataFrame:
    """Windows of a snapshot that may not write: ``marks`` hold ``chunk_id, low_xmin, low_xmax, high_xmax``.

    A window opens at the first event of a transaction from ``low_xmin`` on and closes before the first one beyond both
    ``xmax``.  Transactions commit in any order, so both ends are the smallest position among all later transactions:
    a running minimum in ranges of ``width`` transactions, joined with that of the ranges behind (one row a range).
    A chunk whose window the log has not closed yet is left out.
    """
    ends = {"low": F.col("low_xmin"), "high": F.greatest("low_xmax", "high_xmax") + 1}
    firsts = events.where(F.col(tx).isNotNull()).groupBy(F.col(tx).cast("long").alias("_x")).agg(F.min("seq").alias("_p"))
    asked = marks.select(F.explode(F.array(*[c.cast("long") for c in ends.values()])).alias("_x")).distinct()
    both = firsts.unionByName(asked, allowMissingColumns=True).withColumn("_g", F.floor(F.col("_x") / width))
    behind = W.partitionBy(F.lit(0)).orderBy(F.desc("_g")).rowsBetween(W.unboundedPreceding, -1)  # one row for each range
    later = both.groupBy("_g").agg(F.min("_p").alias("_m")).select("_g", F.min("_m").over(behind).alias("_later"))
    found = both.withColumn("_at", F.min("_p").over(W.partitionBy("_g").orderBy(F.desc("_x")))).join(later, "_g")
    found = found.groupBy("_x").agg(F.min(F.least("_at", "_later")).alias("_at"))
    out = marks
    for name, c in ends.items():
        out = out.join(found.select(F.col("_x").alias(f"_{name}"), (F.col("_at") - 1).alias(name)), c == F.col(f"_{name}"))
    return out.where("high is not null").select(*marks.columns, "low", "high")


def first_at_or_behind(events: DataFrame, asked: DataFrame, group: str, number: str, position: str, width: int = 65_536) -> DataFrame:
    """``group, number`` of ``asked`` with ``at``: the smallest position among the group's events with that number or a larger one (none: no row).

    A running minimum from the largest number down, in ranges of ``width`` numbers, joined with that of the ranges behind (one row a range).
    """
    firsts = events.groupBy(group, F.col(number).alias("_x")).agg(F.min(position).alias("_p"))
    both = firsts.unionByName(asked.select(group, F.col(number).alias("_x")).distinct(), allowMissingColumns=True).withColumn("_g", F.floor(F.col("_x") / width))
    behind = W.partitionBy(group).orderBy(F.desc("_g")).rowsBetween(W.unboundedPreceding, -1)
    later = both.groupBy(group, "_g").agg(F.min("_p").alias("_m")).select(group, "_g", F.min("_m").over(behind).alias("_later"))
    within = W.partitionBy(group, "_g").orderBy(F.desc("_x")).rangeBetween(W.unboundedPreceding, W.currentRow)
    found = both.withColumn("_at", F.min("_p").over(within)).join(later, [group, "_g"])
    return found.groupBy(group, F.col("_x").alias(number)).agg(F.min(F.least("_at", "_later")).alias("at")).where("at is not null")


def gtid_ends(marks: DataFrame, column: str) -> DataFrame:
    """``chunk_id, server, end``: the last transaction of each server in a set such as ``a:1-9:12,b:1-3``."""
    sets = F.filter(F.split(F.regexp_replace(column, r"\s", ""), ","), lambda x: x != "")
    one = marks.select("chunk_id", F.explode(sets).alias("s")).select("chunk_id", F.lower(F.substring_index("s", ":", 1)).alias("server"), F.regexp_extract("s", r"(\d+)$", 1).cast("long").alias("end"))
    return one.groupBy("chunk_id", "server").agg(F.max("end").alias("end"))


def windows_from_gtids(marks: DataFrame, events: DataFrame) -> DataFrame:
    """Windows where positions of several servers are ordered only among themselves: ``chunk_id, low, high``.

    ``marks`` hold ``chunk_id, low_set, high_set``, the transactions executed before and after a chunk was read; ``events`` are ``server, number, seq``.  A window
    opens before the first event beyond the low set, and closes at the largest, over all servers that went on, of the first positions that reach the server's
    end in the high set.  Where no server went on it is empty; a chunk of which a server's end isn't in the log yet is left out.
    """
    events = events.select(F.lower("server").alias("server"), F.col("number").cast("long").alias("number"), "seq")
    low, high = gtid_ends(marks, "low_set"), gtid_ends(marks, "high_set")
    both = high.join(low.withColumnRenamed("end", "low_end"), ["chunk_id", "server"], "left").withColumn("low_end", F.coalesce("low_end", F.lit(0)))
    opens, closes = both.withColumn("number", F.col("low_end") + 1), both.where("end > low_end").withColumn("number", F.col("end"))
    asked = opens.select("server", "number").unionByName(closes.select("server", "number"))
    at = first_at_or_behind(events, asked, "server", "number", "seq")
    first = opens.join(at, ["server", "number"], "left").groupBy("chunk_id").agg((F.min("at") - 1).alias("low"))
    last = closes.join(at, ["server", "number"], "left").groupBy("chunk_id").agg(F.max("at").alias("high"), F.max(F.col("at").isNull()).alias("_open"))
    out = marks.select("chunk_id").join(first, "chunk_id", "left").join(last, "chunk_id", "left").where("not coalesce(_open, false)")
    return out.select("chunk_id", "low", F.coalesce("high", "low").alias("high")).where("high is not null")


def with_rereads(windows: DataFrame, changes: DataFrame) -> DataFrame:
    """Adds ``reread``: the schema of the chunk's table changed inside its window, whose rows are void then.

    ``windows``: ``chunk_id, tbl, low, high``; ``changes``: ``tbl, pos``, which counts with ``low < pos <= high``.
    """
    last = for_events(windows.select("tbl", F.col("high").alias("seq")).distinct(), changes.select("tbl", "pos"))
    last = last.select(F.col("tbl").alias("_t"), F.col("seq").alias("_h"), "schema_pos")
    on = windows["tbl"].eqNullSafe(last["_t"]) & (windows["high"] == last["_h"])
    return windows.join(last, on, "left").withColumn("reread", F.coalesce(F.col("schema_pos") > F.col("low"), F.lit(False))).drop("_t", "_h", "schema_pos")


def valid_reads(windows: DataFrame, changes: DataFrame) -> DataFrame:
    """The last read of each chunk (``attempt``) that no schema change has voided."""
    kept = with_rereads(windows, changes).where("not reread").groupBy("chunk_id").agg(F.max_by(F.struct(*windows.columns), "attempt").alias("_w"))
    return kept.select("_w.*")
