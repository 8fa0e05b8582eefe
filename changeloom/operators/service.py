"""Signals, notifications, metrics, counters, column refill, position sets, redo text."""

from __future__ import annotations

import math
import re
import time
from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

#: The types of signals.
SIGNALS = ("execute-snapshot", "stop-snapshot", "pause-snapshot", "resume-snapshot", "snapshot-window-open", "snapshot-window-close", "log", "schema-changes", "set-binlog-position")


def parse_signals(rows: DataFrame) -> DataFrame:
    """``id, type, data`` rows with their data typed; unknown types are marked."""
    data = F.from_json("data", "`data-collections` array<string>, type string, `additional-conditions` array<struct<`data-collection`:string,filter:string>>, `surrogate-key` string, message string")
    return rows.withColumn("_d", data).select("id", "type", F.col("type").isin(*SIGNALS).alias("known"), F.col("_d.`data-collections`").alias("data_collections"), F.coalesce("_d.type", F.lit("INCREMENTAL")).alias("snapshot_type"), F.col("_d.`additional-conditions`").alias("conditions"), F.col("_d.`surrogate-key`").alias("surrogate_key"), F.col("_d.message").alias("message"))


def dispatch(rows: DataFrame, handlers: dict[str, Callable]) -> int:
    """Runs the handler of each signal, in order (signals are few: an operator's commands); returns how many had one."""
    done = 0
    for r in parse_signals(rows).toLocalIterator():
        if r.type in handlers:
            handlers[r.type](r)
            done += 1
    return done


def notifications(progress: DataFrame, aggregate: str = "Incremental Snapshot") -> DataFrame:
    """Status rows from ``id, tbl, status, rows, ts_ms``."""
    data = F.create_map(F.lit("data_collection"), F.col("tbl"), F.lit("total_rows_scanned"), F.col("rows").cast("string"))
    return progress.select("id", F.lit(aggregate).alias("aggregate_type"), F.col("status").alias("type"), data.alias("additional_data"), F.col("ts_ms").alias("timestamp"))


def metrics(events: DataFrame) -> DataFrame:
    """Counts by table and operation, last position and largest lag behind the source."""
    return events.groupBy("tbl", "op").agg(F.count(F.lit(1)).alias("n"), F.max("seq").alias("last_seq"), F.max(F.col("ts_ms") - F.col("source.ts_ms")).alias("max_lag_ms"))


def lag_quantiles(events: DataFrame, quantiles: tuple[float, ...] = (0.5, 0.95, 0.99), exact: bool = False, accuracy: int = 10_000) -> DataFrame:
    """Quantiles of lag behind the source for each table; the sketch merges on the map side, ``exact`` is for small tables."""
    lag = F.col("ts_ms") - F.col("source.ts_ms")
    fn = (lambda q: F.percentile(lag, q)) if exact else (lambda q: F.percentile_approx(lag, q, accuracy))
    return events.groupBy("tbl").agg(*[fn(q).cast("double").alias(f"p{q * 100:g}".replace(".", "_")) for q in quantiles])


def lag_sketch(events: DataFrame, quantiles: tuple[float, ...] = (0.5, 0.95, 0.99), accuracy: float = 0.01) -> DataFrame:
    """Quantiles of lag for each table with a bounded relative error: counts in buckets whose bounds grow by a constant factor.

    The counts are the sketch: they merge by addition, here on the map side; lags of 0 and below are one bucket of value 0.
    """
    gamma = (1 + accuracy) / (1 - accuracy)
    lag = F.col("ts_ms") - F.col("source.ts_ms")
    bucket = F.when(lag > 0, F.ceil(F.log(lag) / F.lit(math.log(gamma))))
    counts = events.groupBy("tbl", bucket.alias("_b")).agg(F.count(F.lit(1)).alias("_n"))
    w = W.partitionBy("tbl").orderBy(F.asc_nulls_first("_b"))  # one row a bucket
    counts = counts.withColumn("_upto", F.sum("_n").over(w)).withColumn("_all", F.sum("_n").over(W.partitionBy("tbl")))
    value = F.coalesce(F.lit(2 / (gamma + 1)) * F.pow(F.lit(gamma), F.col("_b")), F.lit(0.0))
    at = lambda q: F.min_by(value, F.when(F.col("_upto") > F.lit(q) * (F.col("_all") - 1), F.col("_upto")))
    return counts.groupBy("tbl").agg(*[at(q).alias(f"p{q * 100:g}".replace(".", "_")) for q in quantiles])


def retried(action: Callable, attempts: int, wait: Callable[[int], float], retriable: tuple[type[Exception], ...] = (Exception,)):
    """``action()``; a retriable error is tried again up to ``attempts`` times (below 0: for ever) after ``wait(number)`` seconds."""
    number = 0
    while True:
        try:
            return action()
        except retriable:
            number += 1
            if 0 <= attempts < number:
                raise
            time.sleep(wait(number))


def backoff(first: float, most: float) -> Callable[[int], float]:
    """Waits that double from ``first`` up to ``most`` seconds."""
    return lambda number: min(first * 2 ** (number - 1), most)


def counters(deltas: DataFrame) -> DataFrame:
    """Conflict-free counters: ``node, counter, delta`` -> increments, decrements and value; partial sums merge in any order."""
    up, down = F.sum(F.when(F.col("delta") > 0, F.col("delta")).otherwise(0)), F.sum(F.when(F.col("delta") < 0, -F.col("delta")).otherwise(0))
    return deltas.groupBy("counter").agg(up.alias("p"), down.alias("n"), (up - down).alias("value"))


def reselect(events: DataFrame, current: DataFrame, keys: list[str], columns: list[str], placeholder: str = "__unavailable", nulls: bool = True, unavailable: bool = True) -> DataFrame:
    """Refills placeholder or null columns of ``after`` from the current row by key; reads and deletes are left alone.

    A null in the current row is a valid result; a missing row leaves the event as it is.
    """
    now = current.select(*[F.col(k).alias(f"_k_{k}") for k in keys], F.struct(*columns).alias("_now"))
    joined = events.join(now, [F.col(f"after.{k}") == F.col(f"_k_{k}") for k in keys], "left")
    value = F.col("after")
    for c in columns:
        old = F.col(f"after.{c}")
        need = (old.isNull() & F.lit(nulls)) | (F.coalesce(old.cast("string") == placeholder, F.lit(False)) & F.lit(unavailable))
        value = value.withField(c, F.when(need & F.col("op").isin("c", "u") & F.col("_now").isNotNull(), F.col(f"_now.{c}")).otherwise(old))
    return joined.withColumn("after", F.when(F.col("after").isNotNull(), value)).select(*events.columns)


# --- sets of transaction positions: uuid:start-end[:start-end...] --------------------------------


def gtid_rows(sets: DataFrame, column: str = "gtids") -> DataFrame:
    """``uuid, lo, hi`` rows of GTID texts."""
    one = sets.select(F.explode(F.split(F.regexp_replace(column, r"\s", ""), ",")).alias("_s")).where("_s <> ''")
    one = one.select(F.lower(F.split("_s", ":")[0]).alias("uuid"), F.explode(F.slice(F.split("_s", ":"), 2, F.size(F.split("_s", ":")) - 1)).alias("_r"))
    return one.select("uuid", F.split("_r", "-")[0].cast("long").alias("lo"), F.coalesce(F.get(F.split("_r", "-"), F.lit(1)), F.split("_r", "-")[0]).cast("long").alias("hi"))


def gtid_union(rows: DataFrame) -> DataFrame:
    """Overlapping and adjacent intervals of a server merged."""
    w = W.partitionBy("uuid").orderBy("lo", "hi")
    start = F.coalesce(F.col("lo") > F.max("hi").over(w.rowsBetween(W.unboundedPreceding, -1)) + 1, F.lit(True))
    grouped = rows.withColumn("_s", start.cast("int")).withColumn("_g", F.sum("_s").over(w.rowsBetween(W.unboundedPreceding, W.currentRow)))
    return grouped.groupBy("uuid", "_g").agg(F.min("lo").alias("lo"), F.max("hi").alias("hi")).drop("_g")


def gtid_subtract(left: DataFrame, right: DataFrame) -> DataFrame:
    """What ``left`` holds and ``right`` doesn't: a sweep over interval ends."""
    ends = lambda d, tag: d.select("uuid", F.explode(F.array(F.struct(F.col("lo").alias("at"), F.lit(1).alias("d")), F.struct((F.col("hi") + 1).alias("at"), F.lit(-1).alias("d")))).alias("_e"), F.lit(tag).alias("_t")).select("uuid", "_e.*", "_t")
    e = ends(gtid_union(left), 0).unionByName(ends(gtid_union(right), 1)).groupBy("uuid", "at").agg(F.sum(F.when(F.col("_t") == 0, F.col("d")).otherwise(0)).alias("dl"), F.sum(F.when(F.col("_t") == 1, F.col("d")).otherwise(0)).alias("dr"))
    w = W.partitionBy("uuid").orderBy("at")
    run = w.rowsBetween(W.unboundedPreceding, W.currentRow)
    s = e.withColumn("l", F.sum("dl").over(run)).withColumn("r", F.sum("dr").over(run)).withColumn("next", F.lead("at").over(w))
    return gtid_union(s.where("l > 0 and r = 0 and next is not null").select("uuid", F.col("at").alias("lo"), (F.col("next") - 1).alias("hi")))


def gtid_contains(sets: DataFrame, parts: DataFrame) -> bool:
    """Whether all positions of ``parts`` are in ``sets``."""
    return gtid_subtract(parts, sets).isEmpty()


def gtid_retain(rows: DataFrame, servers: list[str]) -> DataFrame:
    """The positions of some servers (patterns without case)."""
    return rows.where(F.col("uuid").rlike("(?i)^(?:" + "|".join(servers) + ")$"))


def gtid_text(rows: DataFrame) -> DataFrame:
    """``uuid, gtid`` texts in order."""
    part = F.when(F.col("lo") == F.col("hi"), F.col("lo").cast("string")).otherwise(F.concat_ws("-", "lo", "hi"))
    return rows.groupBy("uuid").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("lo", part.alias("t")))), lambda x: x["t"]), ":").alias("_r")).select("uuid", F.concat_ws(":", "uuid", "_r").alias("gtid"))


# --- redo statements ---------------------------------------------------------------------------

_value = r"NULL|IS NULL|'(?:[^']|'')*'|[A-Z_]+\((?:[^()']|'(?:[^']|'')*'|\([^()]*\))*\)|[-+.\w]+"
_pair = re.compile(rf'"([^"]+)"\s*(?:=\s*({_value})|(IS NULL))', re.I)
_head = re.compile(r'\s*(insert into|update|delete from)\s+"?([^"\s.]+)"?\."?([^"\s(]+)"?', re.I)


def _literal(text: str | None) -> str | None:
    if text is None or text.upper() in ("NULL", "IS NULL"):
        return None
    return text[1:-1].replace("''", "'") if text.startswith("'") else text


def parse_redo(sql: str | None) -> tuple | None:
    """One redo statement as ``(op, schema, table, before, after)`` with maps of column texts; None if it isn't one."""
    head = _head.match(sql or "")
    if not head:
        return None
    verb, schema, table = head[1].lower(), head[2], head[3]
    rest = sql[head.end() :]
    if verb == "insert into":
        cols, _, vals = rest.partition(" values ")
        names = re.findall(r'"([^"]+)"', cols)
        values = re.findall(_value, vals.strip()[1:], re.I)
        return "c", schema, table, None, {n: _literal(v) for n, v in zip(names, values)}
    new, _, where = re.split(r"(\bwhere\b)", rest, maxsplit=1, flags=re.I) if re.search(r"\bwhere\b", rest, re.I) else (rest, "", "")
    before = {m[1]: _literal(m[2]) for m in _pair.finditer(where)}
    if verb == "delete from":
        return "d", schema, table, before, None
    return "u", schema, table, before, before | {m[1]: _literal(m[2]) for m in _pair.finditer(new)}


def redo_events(rows: DataFrame, column: str = "sql_redo") -> DataFrame:
    """Adds the parsed statement (Arrow batches; text parsing has no built-in form)."""
    kind = "op:string,schema:string,table:string,before:map<string,string>,after:map<string,string>"

    @F.pandas_udf(f"struct<{kind}>")
    def run(sqls):
        import pandas as pd

        return pd.DataFrame([parse_redo(s) or (None,) * 5 for s in sqls], columns=["op", "schema", "table", "before", "after"])

    return rows.withColumn("_p", run(F.col(column))).select("*", "_p.*").drop("_p")


def guard_tables(tables: list[str], limit: int, action: str = "warn") -> str | None:
    """A message, or an error, where more tables are captured than the limit."""
    if len(tables) <= limit:
        return None
    text = f"{len(tables)} tables are captured, the limit is {limit}"
    if action == "fail":
        raise ValueError(text)
    return text


def stale(progress: list[dict], checks: int) -> bool:
    """Whether the end offsets of the last ``checks`` progress reports are all the same."""
    last = [str(p.get("endOffset")) for p in progress[-checks:]]
    return len(last) == checks and len(set(last)) == 1
