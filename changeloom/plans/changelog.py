"""A deterministic changelog derived from the star-schema tables, in SQL that Spark and DuckDB both run.

Two tables change: ``orders`` (inserts or snapshot reads, updates, updates that change nothing, key
changes, deletes) and ``customer`` (inserts and updates), so that transactions span two tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_ORDERS = "SELECT o_orderkey AS k, o_orderstatus AS s, CAST(round(o_totalprice * 100) AS BIGINT) AS p, CAST(o_custkey AS BIGINT) AS c FROM {orders}"
_COLUMNS = "CAST({seq} AS BIGINT) AS seq, '{tbl}' AS tbl, {op} AS op, {b} , {a}, CAST(floor(k / 4) AS BIGINT) AS tx_id, CAST(1700000000000 + k * 1000 + {n} AS BIGINT) AS ts_ms"


def _image(prefix: str, key: str | None, status: str = "s", price: str = "p", cust: str = "c") -> str:
    values = (key, status, price, cust) if key else ("CAST(NULL AS BIGINT)", "CAST(NULL AS VARCHAR(1))", "CAST(NULL AS BIGINT)", "CAST(NULL AS BIGINT)")
    return ", ".join(f"{v} AS {prefix}_{n}" for v, n in zip(values, ("key", "status", "price", "cust")))


def _event(n: int, op: str, before: str | None, after: str | None, where: str, source: str = "o", tbl: str = "orders", **new: str) -> str:
    b, a = _image("b", before), _image("a", after, **new)
    return f"SELECT {_COLUMNS.format(seq=f'k * 10 + {n}', tbl=tbl, op=op, b=b, a=a, n=n)} FROM {source} WHERE {where}"


_KEY = "(CASE WHEN k % 13 = 0 THEN k + 10000000 ELSE k END)"
_UPD = {"status": "(CASE WHEN k % 3 = 0 THEN 'U' ELSE s END)", "price": "(CASE WHEN k % 3 = 0 THEN p + 100 ELSE p END)"}
_NOW = ", ".join(("k", _UPD["status"] + " AS s", _UPD["price"] + " AS p", "c"))

CHANGELOG = f"""
WITH o AS ({_ORDERS}), n AS (SELECT {_NOW} FROM o),
cu AS (SELECT CAST(c_custkey AS BIGINT) AS k, substr(c_mktsegment, 1, 1) AS s, CAST(round(c_acctbal * 100) AS BIGINT) AS p, CAST(c_nationkey AS BIGINT) AS c FROM {{customer}})
{_event(0, "CASE WHEN k % 5 = 0 THEN 'r' ELSE 'c' END", None, "k", "true")}
UNION ALL {_event(1, "'u'", "k", "k", "k % 3 = 0", status="'U'", price="p + 100")}
UNION ALL {_event(2, "'u'", "k", "k", "k % 11 = 0", source="n")}
UNION ALL {_event(3, "'u'", "k", "k + 10000000", "k % 13 = 0", source="n")}
UNION ALL {_event(4, "'d'", _KEY, None, "k % 7 = 0", source="n")}
UNION ALL {_event(5, "'c'", None, "k", "true", source="cu", tbl="customer")}
UNION ALL {_event(6, "'u'", "k", "k", "k % 2 = 0", source="cu", tbl="customer", price="p + 5")}
"""

#: The same for DuckDB, as the first member of a WITH list.
LOG = "changelog AS MATERIALIZED (" + CHANGELOG.format(orders="orders", customer="customer") + ")"
#: The orders part after key changes are split into a delete and a create.
SPLIT = """split AS MATERIALIZED (
SELECT seq, 0 AS sub, tbl, op, b_key, b_status, b_price, b_cust, a_key, a_status, a_price, a_cust, tx_id, ts_ms FROM changelog WHERE tbl = 'orders' AND NOT (op = 'u' AND b_key <> a_key)
UNION ALL SELECT seq, 0, tbl, 'd', b_key, b_status, b_price, b_cust, NULL, NULL, NULL, NULL, tx_id, ts_ms FROM changelog WHERE tbl = 'orders' AND op = 'u' AND b_key <> a_key
UNION ALL SELECT seq, 1, tbl, 'c', NULL, NULL, NULL, NULL, a_key, a_status, a_price, a_cust, tx_id, ts_ms FROM changelog WHERE tbl = 'orders' AND op = 'u' AND b_key <> a_key)"""

IMAGE = ("key", "status", "price", "cust")


def flat_changelog(spark: SparkSession, sf_dir: str) -> DataFrame:
    tables = {t: spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("orders", "customer")}
    return spark.sql(CHANGELOG, **tables)


def changelog(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The changelog as envelopes: ``before`` and ``after`` structs, a ``source`` block, ``op``, ``ts_ms``, ``tx_id``, ``seq``."""
    image = lambda p: F.when(F.col(f"{p}_key").isNotNull(), F.struct(*[F.col(f"{p}_{c}").alias(c) for c in IMAGE]))
    source = F.struct(F.lit("shop").alias("name"), F.lit("db1").alias("db"), F.col("tbl").alias("table"), (F.col("seq") * 8).alias("lsn"), (F.col("ts_ms") - F.col("seq") % 97).alias("ts_ms"))
    return flat_changelog(spark, sf_dir).select("seq", "tbl", "op", image("b").alias("before"), image("a").alias("after"), source.alias("source"), "tx_id", "ts_ms")


def order_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    return changelog(spark, sf_dir).where("tbl = 'orders'")
