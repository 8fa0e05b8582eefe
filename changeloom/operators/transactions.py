"""Transactions: order inside them, their boundaries, rollback, large-object merge, ordered merge, resume.

Windows are partitioned by transaction, key or capture table, never over the whole log.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

#: Captures up to which they are broadcast to the events (they are counted).
CAPTURES = 50_000


def ordered(events: DataFrame, tx: str = "tx_id", table: str = "tbl") -> DataFrame:
    """Adds ``total_order`` and ``data_collection_order`` (from 1) inside each transaction; none without a transaction."""
    rank = lambda *by: F.when(F.col(tx).isNotNull(), F.row_number().over(W.partitionBy(*by).orderBy("seq")).cast("long"))
    return events.withColumn("total_order", rank(tx)).withColumn("data_collection_order", rank(tx, table))


def runs(events: DataFrame, partition: str, tx: str = "tx_id") -> DataFrame:
    """Adds ``run``: it changes whenever the transaction id does, inside each source partition."""
    w = W.partitionBy(partition).orderBy("seq")
    # ids that come back after another transaction are a new run
    turn = (~F.col(tx).eqNullSafe(F.lag(tx).over(w))) | (F.row_number().over(w) == 1)
    return events.withColumn("run", F.sum(turn.cast("long")).over(w.rowsBetween(W.unboundedPreceding, W.currentRow)))


def boundaries(events: DataFrame, tx: str = "tx_id", table: str = "tbl") -> DataFrame:
    """BEGIN and END rows: status, id, counts over all and for each table (END), position."""
    per = events.where(F.col(tx).isNotNull()).groupBy(tx, table).agg(F.count(F.lit(1)).alias("n"), F.min("seq").alias("lo"), F.max("seq").alias("hi"), F.min("ts_ms").alias("first_ts"), F.max("ts_ms").alias("last_ts"))
    one = per.groupBy(tx).agg(
        F.sum("n").alias("event_count"), F.min("lo").alias("lo"), F.max("hi").alias("hi"), F.min("first_ts").alias("first_ts"), F.max("last_ts").alias("last_ts"),
        F.array_join(F.array_sort(F.collect_list(F.concat_ws("=", table, F.col("n").cast("string")))), ",").alias("collections"),
    )
    begin = F.struct(F.lit("BEGIN").alias("status"), F.col("lo").alias("seq"), F.lit(None).cast("long").alias("event_count"), F.lit(None).cast("string").alias("data_collections"), F.col("first_ts").alias("ts_ms"))
    end = F.struct(F.lit("END").alias("status"), F.col("hi").alias("seq"), F.col("event_count").alias("event_count"), F.col("collections").alias("data_collections"), F.col("last_ts").alias("ts_ms"))
    return one.select(F.col(tx).alias("id"), F.explode(F.array(begin, end)).alias("_b")).select("id", "_b.*")


def run_boundaries(events: DataFrame, partition: str, tx: str = "tx_id", table: str = "tbl") -> DataFrame:
    """BEGIN and END rows by runs of a source partition: a null id, or another one, ends a transaction; an id that returns begins a new one."""
    marked = runs(events, partition, tx).where(F.col(tx).isNotNull())
    out = boundaries(marked.withColumn("_run", F.struct(F.col(partition), F.col(tx), F.col("run"))), "_run", table)
    return out.select(F.col(f"id.{partition}").alias(partition), F.col(f"id.{tx}").alias("id"), *[c for c in out.columns if c != "id"])


def abandoned(events: DataFrame, now_ms: int, retention_ms: int, most: int | None = None, tx: str = "tx_id") -> DataFrame:
    """Transactions whose first event is older than the retention, or that hold more events than ``most``: their buffers are given up."""
    per = events.where(F.col(tx).isNotNull()).groupBy(tx).agg(F.min("ts_ms").alias("_first"), F.count(F.lit(1)).alias("_n"))
    late = F.col("_first") < now_ms - retention_ms
    return per.where(late | (F.col("_n") > most) if most else late).select(tx)


def without_rolled_back(events: DataFrame, rollbacks: DataFrame, tx: str = "tx_id", prefix: int = 8) -> DataFrame:
    """Events without those of rolled-back transactions; a rollback whose id is only known by its first ``prefix`` characters ends all that begin so.

    ``rollbacks`` is ``tx``; ids are texts.
    """
    known = rollbacks.select(F.col(tx).alias("_r")).where("_r is not null").distinct()
    whole = events.join(known, F.col(tx) == F.col("_r"), "left_anti")
    unmatched = known.join(events.select(F.col(tx).alias("_r")).distinct(), "_r", "left_anti").select(F.substring("_r", 1, prefix).alias("_r")).distinct()
    return whole.join(unmatched, F.substring(F.col(tx), 1, prefix) == F.col("_r"), "left_anti")


def relevant(events: DataFrame, tables: list[str], tx: str = "tx_id", table: str = "tbl") -> DataFrame:
    """All events of transactions that touch one of the captured tables."""
    return events.join(events.where(F.col(table).isin(tables)).select(tx).distinct(), tx, "left_semi")


def committed(events: DataFrame, ends: DataFrame, tx: str = "tx_id") -> DataFrame:
    """Events of transactions that commit, at their commit position: ``ends`` is ``tx, end (commit|rollback), end_seq``.

    The last end of a transaction decides; open transactions wait.  Undo rows (``op`` x with ``undo_key``)
    aren't handled here, see :func:`without_undone`.
    """
    last = ends.groupBy(tx).agg(F.max_by(F.struct("end", "end_seq"), "end_seq").alias("_e")).select(tx, "_e.*").where("end = 'commit'").select(tx, F.col("end_seq").alias("commit_seq"))
    return events.join(last, tx)


def without_undone(events: DataFrame, undos: DataFrame, row_id: str, tx: str = "tx_id") -> DataFrame:
    """Each undo (``tx, row_id, seq``) cancels the latest event of that row before it that isn't cancelled yet.

    Events and undos of a row form a stack: with +1 for an event and -1 for an undo an event is cancelled
    when the running height comes back below its own later on.
    """
    both = events.select(tx, row_id, "seq", F.lit(1).alias("d")).unionByName(undos.select(tx, row_id, "seq", F.lit(-1).alias("d")))
    w = W.partitionBy(tx, row_id).orderBy("seq", "d")
    h = both.withColumn("h", F.sum("d").over(w.rowsBetween(W.unboundedPreceding, W.currentRow))).withColumn("low", F.min("h").over(w.rowsBetween(1, W.unboundedFollowing)))
    gone = h.where((F.col("d") == 1) & (F.col("low") < F.col("h"))).select(tx, row_id, "seq")
    return events.join(gone, [tx, row_id, "seq"], "left_anti")


def by_markers(log: DataFrame, partition: str) -> DataFrame:
    """Look-ahead buffering by BEGIN, COMMIT and ROLLBACK markers in ``kind``: rows of rolled-back transactions go.

    A second BEGIN without an end emits the first transaction (``well_formed`` false) and leaves what
    follows outside of any transaction until the next BEGIN.  Rows outside of transactions pass.
    """
    w = W.partitionBy(partition).orderBy("seq")
    upto = w.rowsBetween(W.unboundedPreceding, W.currentRow)
    marked = log.withColumn("_m", F.when(F.col("kind").isin("BEGIN", "COMMIT", "ROLLBACK"), F.col("kind")))
    # within a stretch without COMMIT or ROLLBACK, odd BEGINs open and even ones flush
    marked = marked.withColumn("_s", F.sum(F.coalesce(F.lag("_m").over(w).isin("COMMIT", "ROLLBACK"), F.lit(False)).cast("int")).over(upto))
    stretch = W.partitionBy(partition, "_s").orderBy("seq")
    marked = marked.withColumn("_b", F.sum((F.col("kind") == "BEGIN").cast("int")).over(stretch.rowsBetween(W.unboundedPreceding, W.currentRow)))
    marked = marked.withColumn("_end", F.max(F.when(F.col("_m").isin("COMMIT", "ROLLBACK"), F.col("_m"))).over(W.partitionBy(partition, "_s"))).withColumn("_all", F.max("_b").over(W.partitionBy(partition, "_s")))
    inside = F.col("_b") % 2 == 1
    flushed = inside & (F.col("_b") < F.col("_all"))
    dropped = inside & ~flushed & F.coalesce(F.col("_end") == "ROLLBACK", F.lit(False))
    waiting = inside & ~flushed & F.col("_end").isNull()
    return marked.where(F.col("_m").isNull() & ~dropped & ~waiting).withColumn("well_formed", ~flushed).drop("_m", "_s", "_b", "_end", "_all")


def merge_large_objects(events: DataFrame, columns: list[str], lobs: list[str], unavailable: str, tx: str = "tx_id", key: str = "key") -> DataFrame:
    """Folds updates of a row into the insert before them, and updates that carry a large object into the update before.

    A value that isn't available in the log never overwrites; nulls do.  A group keeps its first position and operation:
    after an insert every update joins it until a delete; elsewhere an update begins a group unless it carries a large
    object and follows an update.
    """
    w = W.partitionBy(tx, key).orderBy("seq")
    so_far = w.rowsBetween(W.unboundedPreceding, W.currentRow)
    carries = F.lit(False)
    for c in lobs:
        carries = carries | F.col(c).isNull() | (F.col(c) != unavailable)
    head = F.last(F.when(F.col("op") != "u", F.col("op")), ignorenulls=True).over(w.rowsBetween(W.unboundedPreceding, -1))
    joins = (F.col("op") == "u") & (F.coalesce(head == "c", F.lit(False)) | ((F.lag("op").over(w) == "u") & carries))
    # all windows are of one order, so rows are sorted once; a group is read off its last row
    marked = events.withColumn("_new", ~F.coalesce(joins, F.lit(False)))
    grouped = marked.withColumn("_g", F.sum(F.col("_new").cast("int")).over(so_far)).withColumn("_end", F.lead("_new", 1, True).over(w))
    told = lambda c: F.col(c).isNull() | (F.col(c).cast("string") != unavailable)
    last = lambda c: F.last(F.when(told(c) & F.col("seq").isNotNull(), F.struct("_g", F.col(c).alias("v"))), ignorenulls=True).over(so_far)
    first = F.last(F.when(F.col("_new"), F.struct("seq", "op")), ignorenulls=True).over(so_far)
    out = grouped.select(tx, key, "_g", "_end", first.alias("_first"), *[F.col(c).alias(f"_own_{c}") for c in columns], *[last(c).alias(f"_last_{c}") for c in columns])
    value = lambda c: F.when(F.col(f"_last_{c}._g") == F.col("_g"), F.col(f"_last_{c}.v")).otherwise(F.col(f"_own_{c}")).alias(c)
    return out.where("_end").select(tx, key, "_first.seq", "_first.op", *map(value, columns))


def merged_by_commit(tables: list[DataFrame]) -> DataFrame:
    """Change tables as one log: ``commit_lsn, tx_lsn, table_idx`` order; before (3) and after (4) rows of an update become one.

    Each input has ``commit_lsn, tx_lsn, code (1 delete, 2 insert, 3 and 4 update), row`` and, for a stopped
    capture, literal ``stop_lsn`` from which its rows are ignored.
    """
    parts = [t.withColumn("table_idx", F.lit(i)) for i, t in enumerate(tables)]
    log = parts[0]
    for p in parts[1:]:
        log = log.unionByName(p, allowMissingColumns=True)
    if "stop_lsn" in log.columns:
        log = log.where(F.col("stop_lsn").isNull() | (F.col("commit_lsn") < F.col("stop_lsn")))
    # an update's two rows share the position, so the pair is one group: no window over a table
    pair = log.groupBy("table_idx", "commit_lsn", "tx_lsn").agg(F.max(F.when(F.col("code").isin(1, 3), F.col("row"))).alias("before"), F.max(F.when(F.col("code").isin(2, 4), F.col("row"))).alias("after"), F.max("code").alias("_c"))
    op = F.when(F.col("_c") == 1, "d").when(F.col("_c") == 2, "c").otherwise("u")
    return pair.withColumn("op", op).drop("_c").orderBy("commit_lsn", "tx_lsn", "table_idx")


def resume_after(events: DataFrame, position: int, serial: int = 0, column: str = "lsn", serial_column: str | None = None) -> DataFrame:
    """Events after a stored position; at the position itself those beyond the stored serial number."""
    later = F.col(column) > position
    return events.where(later | ((F.col(column) == position) & (F.col(serial_column) > serial)) if serial_column else later)


def handed_over(events: DataFrame, captures: DataFrame) -> DataFrame:
    """Events of tables whose change table was replaced: each capture counts until the next one of its table starts.

    ``events``: ``tbl, capture, lsn``; ``captures``: ``tbl, capture, start_lsn`` (a few for each table).  Adds
    ``schema_since``, the start of the capture that an event has its columns from.
    """
    until = F.lead("start_lsn").over(W.partitionBy("tbl").orderBy("start_lsn", "capture"))
    held = captures.select("tbl", "capture", F.col("start_lsn").alias("schema_since"), until.alias("_until"))
    in_time = (F.col("lsn") >= F.col("schema_since")) & (F.col("_until").isNull() | (F.col("lsn") < F.col("_until")))
    # the captures of a table are few rows, the events of one capture may be most of the log: events stay where they are
    few = captures.limit(CAPTURES + 1).count() <= CAPTURES
    return events.join(F.broadcast(held) if few else held, ["tbl", "capture"]).where(in_time).drop("_until")
