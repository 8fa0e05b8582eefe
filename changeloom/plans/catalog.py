"""All queries of the engine by name, each with its SQL where SQL can express it.

Queries return flat columns, so that results compare by value with other SQL engines.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from changeloom.functions import scalars as S
from changeloom.operators import carry as K
from changeloom.operators import documents as D
from changeloom.operators import envelope as E
from changeloom.operators import filters as P
from changeloom.operators import history as H
from changeloom.operators import materialize as M
from changeloom.operators import records as R
from changeloom.operators import routing as G
from changeloom.operators import service as V
from changeloom.operators import snapshot as N
from changeloom.operators import transactions as T
from changeloom.plans.changelog import LOG, SPLIT, changelog, flat_changelog, order_log
from changeloom.sources import buckets as B
from changeloom.sources import positions as L
from changeloom.sources import readers as C
from changeloom.streaming import progress as O

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}

#: The image columns of the changelog.
KEYS = ["key"]
#: Orders under short names, for queries with documents.
_DOCS = "o AS (SELECT o_orderkey AS k, o_orderstatus AS s, CAST(round(o_totalprice * 100) AS BIGINT) AS p, CAST(o_custkey AS BIGINT) AS c FROM orders)"


def query(name: str, sql: str | None = None, log: bool = True):
    """Registers a query; ``sql`` follows the changelog's common table expression unless ``log`` is false."""

    def put(f):
        QUERIES[name] = f
        if sql:
            ORACLE_SQL[name] = f"WITH {LOG}, {SPLIT}\n{sql.strip()}" if log and not sql.lstrip().startswith("WITH") else sql.strip()
        return f

    return put


def _read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


# --- materialize and apply ----------------------------------------------------------------------

_LAST = "SELECT *, coalesce(a_key, b_key) AS k, row_number() OVER (PARTITION BY coalesce(a_key, b_key) ORDER BY seq DESC, sub DESC) AS rn FROM split"


@query("materialize_orders", f"SELECT a_key AS key, a_status AS status, a_price AS price, a_cust AS cust FROM ({_LAST}) WHERE rn = 1 AND op <> 'd'")
def _(spark, sf):
    return M.materialize(E.split_key_changes(order_log(spark, sf), KEYS), KEYS)


@query("last_change_per_key", f"SELECT k AS key, op, a_status AS status, seq FROM ({_LAST}) WHERE rn = 1")
def _(spark, sf):
    return M.last_change(E.split_key_changes(order_log(spark, sf), KEYS), KEYS).select("key", "op", "after.status", "seq")


@query("split_key_changes", "SELECT seq, sub, op, coalesce(a_key, b_key) AS key, CASE WHEN seq % 10 = 3 THEN CASE sub WHEN 0 THEN '{\"key\":' || (b_key + 10000000) || '}' ELSE '{\"key\":' || (a_key - 10000000) || '}' END END AS other FROM split")
def _(spark, sf):
    d = E.split_key_changes(order_log(spark, sf), KEYS)
    return d.select("seq", "sub", "op", F.coalesce("after.key", "before.key").alias("key"), F.coalesce(F.col("headers")["newkey"], F.col("headers")["oldkey"]).alias("other"))


@query("truncate_barrier", "SELECT count(*) AS n, min(seq) AS first_seq FROM changelog WHERE tbl = 'orders' AND seq > (SELECT CAST(floor(max(seq) / 20) * 10 AS BIGINT) FROM changelog WHERE tbl = 'orders')")
def _(spark, sf):
    d = order_log(spark, sf)
    top = d.agg((F.floor(F.max("seq") / 20) * 10).alias("seq")).select("seq", F.lit("orders").alias("tbl"), F.lit("t").alias("op"))
    return M.after_truncates(d.unionByName(top, allowMissingColumns=True)).agg(F.count(F.lit(1)).alias("n"), F.min("seq").alias("first_seq"))


_BASE = "base AS (SELECT CAST(o_orderkey AS BIGINT) AS key, o_orderstatus AS status, CAST(0 AS BIGINT) AS price, CAST(o_custkey AS BIGINT) AS cust FROM orders WHERE o_orderkey % 2 = 0)"


def _base(spark, sf):
    o = _read(spark, sf, "orders").where("o_orderkey % 2 = 0")
    return o.select(F.col("o_orderkey").cast("long").alias("key"), F.col("o_orderstatus").alias("status"), F.lit(0).cast("long").alias("price"), F.col("o_custkey").cast("long").alias("cust"))


for _mode, _deletes, _where in (("upsert", True, "x.op IS DISTINCT FROM 'd'"), ("upsert", False, "true"), ("update", True, "x.op IS DISTINCT FROM 'd' AND b.key IS NOT NULL")):

    @query(
        f"apply_{_mode}" + "_with_deletes" * _deletes,
        f"WITH {LOG}, {SPLIT}, {_BASE}, x AS (SELECT * FROM (SELECT *, coalesce(a_key, b_key) AS k, row_number() OVER (PARTITION BY coalesce(a_key, b_key) ORDER BY seq DESC, sub DESC) AS rn FROM split WHERE op <> '{'' if _deletes else 'd'}') WHERE rn = 1) "
        f"SELECT coalesce(b.key, x.k) AS key, CASE WHEN x.op IS NULL THEN b.status ELSE x.a_status END AS status, CASE WHEN x.op IS NULL THEN b.price ELSE x.a_price END AS price, CASE WHEN x.op IS NULL THEN b.cust ELSE x.a_cust END AS cust FROM base b FULL OUTER JOIN x ON b.key = x.k WHERE {_where}",
    )
    def _(spark, sf, mode=_mode, deletes=_deletes):
        return M.apply(_base(spark, sf), E.split_key_changes(order_log(spark, sf), KEYS), KEYS, mode, delete_enabled=deletes)


@query("schema_evolution", "SELECT CAST(o_orderkey AS BIGINT) AS id, o_orderstatus AS status, NULL::VARCHAR AS segment FROM orders UNION ALL SELECT CAST(c_custkey AS BIGINT), NULL, c_mktsegment FROM customer", log=False)
def _(spark, sf):
    o = _read(spark, sf, "orders").select(F.col("o_orderkey").cast("long").alias("id"), F.col("o_orderstatus").alias("status"))
    return M.evolve(o, _read(spark, sf, "customer").select(F.col("c_custkey").cast("long").alias("id"), F.col("c_mktsegment").alias("segment")))


@query("bucket_table", f"SELECT a_key AS key, a_status AS status, a_price AS price, a_cust AS cust FROM ({_LAST}) WHERE rn = 1 AND op <> 'd'")
def _(spark, sf):
    """The table after 20 batches, each applied to a table of buckets in the shared folder."""
    home = f"{B.shared_folder(spark)}/bucket_table-{uuid.uuid4().hex}"
    batch = (F.col("seq") % 10).cast("int") * 4 + (F.floor(F.col("seq") / 10) % 4).cast("int")
    log = E.split_key_changes(order_log(spark, sf), KEYS).drop("headers").withColumn("batch", batch)
    log.repartition("batch").write.partitionBy("batch").parquet(f"{home}/log")
    table = B.BucketTable(spark, f"{home}/table", KEYS, buckets=8)
    for n in range(20):
        table.apply(spark.read.parquet(f"{home}/log/batch={n}"), n)
    return table.read()


@query("position_reader", "SELECT tbl, CAST(tx_id AS BIGINT) AS pos, seq AS serial, op FROM changelog")
def _(spark, sf):
    """Two change tables read by positions in batches that end inside transactions, and what all batches held."""
    home = f"{B.shared_folder(spark)}/position_reader-{uuid.uuid4().hex}"
    log = flat_changelog(spark, sf).select("tbl", F.col("tx_id").cast("long").alias("pos"), F.col("seq").alias("serial"), "op")
    log.write.partitionBy("tbl").parquet(f"{home}/log")
    tables = {t: spark.read.parquet(f"{home}/log/tbl={t}") for t in ("orders", "customer")}
    rows = sum(t.count() for t in tables.values())
    # an odd number of rows, so that batches end inside transactions
    reader = L.PositionReader(spark, tables, f"{home}/offsets", max_rows=max(7, rows // 5) | 1)
    reader.run(lambda batch, n: batch.write.mode("overwrite").parquet(f"{home}/out/batch={n}"))
    return spark.read.parquet(f"{home}/out").select("tbl", "pos", "serial", "op")


@query(
    "stream_progress",
    "SELECT count(*) AS n, " + ", ".join(f"count_if(op = '{o}') AS n_{o}" for o in O.OPERATIONS) + ", min(seq) AS min_seq, max(seq) AS max_seq, min(seq % 97) AS min_lag, max(seq % 97) AS max_lag, sum(seq % 97) / count(*) AS avg_lag FROM changelog",
)
def _(spark, sf):
    """The whole log as a stream in several batches; what its batches reported, added up."""
    home = f"{B.shared_folder(spark)}/stream_progress-{uuid.uuid4().hex}"
    log = changelog(spark, sf)
    log.write.parquet(f"{home}/log")
    watch = O.ProgressTable(spark, f"{home}/progress")
    spark.streams.addListener(watch)
    try:
        stream = C.stream(spark, f"{home}/log", log.schema, max_files=4)
        run = O.observed(stream).writeStream.format("noop").option("checkpointLocation", f"{home}/offsets").trigger(availableNow=True).start()
        run.awaitTermination()
        if not watch.wait(str(run.runId)):
            raise TimeoutError("the stream's last report did not come")
    finally:
        spark.streams.removeListener(watch)
    return O.totals(watch.read().where(F.col("run") == str(run.runId))).drop("query", "batches")


def _batches_sql(most: int, doublings: int = 63) -> str:
    """Each row leads to the first row of the next batch; the rows that are reached from the first one, by ways of doubled length, begin batches.

    Positions are BIGINT, so 63 doublings reach every batch; ways that are longer than the log are empty tables.
    """
    ctes = [
        "n AS MATERIALIZED (SELECT *, lead(i) OVER (PARTITION BY k ORDER BY i) AS again FROM (SELECT seq, op, coalesce(a_key, b_key) AS k, row_number() OVER (ORDER BY seq) - 1 AS i FROM changelog WHERE tbl = 'orders'))",
        f"j0 AS MATERIALIZED (SELECT i, least(i + {most}, min(again) OVER (ORDER BY i ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)) AS o FROM n)",
    ]
    for d in range(doublings - 1):
        ctes.append(f"j{d + 1} AS MATERIALIZED (SELECT a.i, b.o FROM j{d} a JOIN j{d} b ON a.o = b.i)")
    ctes.append(f"r{doublings} AS (SELECT 0::BIGINT AS i)")
    for d in reversed(range(doublings)):
        ctes.append(f"r{d} AS MATERIALIZED (SELECT i FROM r{d + 1} UNION SELECT o FROM r{d + 1} JOIN j{d} USING (i) WHERE o IS NOT NULL)")
    return f"WITH {LOG}, " + ", ".join(ctes) + " SELECT 'orders' AS tbl, seq, op, count(r0.i) OVER (ORDER BY n.i) - 1 AS batch FROM n LEFT JOIN r0 ON n.i = r0.i"


@query("passthrough_batches", _batches_sql(500))
def _(spark, sf):
    return M.passthrough_batches(order_log(spark, sf), KEYS, most=500)


@query("dead_letters", "SELECT event_id, props, 'k' AS error FROM events WHERE event_id % 10 = 0", log=False)
def _(spark, sf):
    e = _read(spark, sf, "events").select("event_id", "props", F.when(F.col("event_id") % 10 == 0, "bad").otherwise(F.get_json_object("props", "$.k")).alias("k"))
    return M.split_errors(e, {"k": "int"})[1].select("event_id", "props", "error")


@query("clean_rows", "SELECT event_id, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events WHERE event_id % 10 <> 0", log=False)
def _(spark, sf):
    e = _read(spark, sf, "events").select("event_id", F.when(F.col("event_id") % 10 == 0, "bad").otherwise(F.get_json_object("props", "$.k")).alias("k"))
    return M.split_errors(e, {"k": "int"})[0]


# --- envelopes ----------------------------------------------------------------------------------

_FLAT = {
    "drop": "SELECT seq, a_key AS key, a_status AS status, a_price AS price, a_cust AS cust, op AS __op, seq * 8 AS __source_lsn, false AS is_tombstone FROM changelog WHERE tbl = 'orders' AND op <> 'd'",
    "tombstone": "SELECT seq, a_key AS key, a_status AS status, a_price AS price, a_cust AS cust, CASE WHEN op <> 'd' THEN op END AS __op, CASE WHEN op <> 'd' THEN seq * 8 END AS __source_lsn, op = 'd' AS is_tombstone FROM changelog WHERE tbl = 'orders'",
    "rewrite": "SELECT seq, CASE WHEN op = 'd' THEN b_key ELSE a_key END AS key, CASE WHEN op = 'd' THEN b_status ELSE a_status END AS status, CASE WHEN op = 'd' THEN b_price ELSE a_price END AS price, CASE WHEN op = 'd' THEN b_cust ELSE a_cust END AS cust, op AS __op, seq * 8 AS __source_lsn, CASE WHEN op = 'd' THEN 'true' ELSE 'false' END AS __deleted, false AS is_tombstone FROM changelog WHERE tbl = 'orders'",
}
_FLAT["rewrite-with-tombstone"] = _FLAT["rewrite"] + " UNION ALL SELECT seq, NULL, NULL, NULL, NULL, NULL, NULL, NULL, true FROM changelog WHERE tbl = 'orders' AND op = 'd'"
_FLAT["delete-to-tombstone"] = _FLAT["tombstone"]
for _mode, _sql in _FLAT.items():

    @query("flatten_" + _mode.replace("-", "_"), _sql)
    def _(spark, sf, mode=_mode):
        return E.flatten(order_log(spark, sf), E.Flatten(mode, add_fields=("op", "source.lsn")))


@query(
    "flatten_routed",
    "SELECT seq, CASE WHEN op = 'd' THEN b_key ELSE a_key END AS key, coalesce(status, '?') AS status, CASE WHEN op = 'd' THEN b_price ELSE a_price END AS price, op = 'd' AS deleted, coalesce(status, '') AS topic "
    "FROM (SELECT *, CASE WHEN op = 'd' THEN CASE WHEN b_key % 4 <> 0 THEN b_status END ELSE CASE WHEN a_key % 4 <> 0 THEN a_status END END AS status FROM changelog WHERE tbl = 'orders')",
)
def _(spark, sf):
    log = order_log(spark, sf)
    for image in ("before", "after"):  # a quarter of the keys has no status
        blank = F.col(image).withField("status", F.when(F.col(f"{image}.key") % 4 != 0, F.col(f"{image}.status")))
        log = log.withColumn(image, F.when(F.col(image).isNotNull(), blank))
    d = E.flatten(log, E.Flatten("rewrite", route_by="status", defaults=(("status", "?"),), drop_fields=("cust",)))
    return d.select("seq", "key", "status", "price", (F.col("__deleted") == "true").alias("deleted"), "topic")


@query("flatten_headers", "SELECT seq, CASE WHEN op = 'd' THEN 'd' ELSE op END AS h_op, CAST(seq * 8 AS VARCHAR) AS h_lsn FROM changelog WHERE tbl = 'orders'")
def _(spark, sf):
    d = E.flatten(order_log(spark, sf), E.Flatten(add_headers=("op", "lsn:pos")))
    return d.select("seq", F.col("headers")["__op"].alias("h_op"), F.col("headers")["__pos"].alias("h_lsn"))


@query("tombstones", "SELECT seq, op, false AS is_tombstone FROM changelog UNION ALL SELECT seq, op, true FROM changelog WHERE op = 'd'")
def _(spark, sf):
    return E.with_tombstones(changelog(spark, sf)).select("seq", "op", "is_tombstone")


@query(
    "changed_fields",
    "SELECT seq, CASE WHEN a_key IS NULL OR b_key IS NULL THEN '' ELSE concat_ws(',', CASE WHEN a_key <> b_key THEN 'key' END, CASE WHEN a_status <> b_status THEN 'status' END, CASE WHEN a_price <> b_price THEN 'price' END, CASE WHEN a_cust <> b_cust THEN 'cust' END) END AS changed, "
    "CASE WHEN a_key IS NULL OR b_key IS NULL THEN '' ELSE concat_ws(',', CASE WHEN a_key = b_key THEN 'key' END, CASE WHEN a_status = b_status THEN 'status' END, CASE WHEN a_price = b_price THEN 'price' END, CASE WHEN a_cust = b_cust THEN 'cust' END) END AS unchanged FROM changelog",
)
def _(spark, sf):
    d = E.changed_fields(changelog(spark, sf))
    return d.select("seq", F.array_join("changed", ",").alias("changed"), F.array_join("unchanged", ",").alias("unchanged"))


@query("header_to_value", "SELECT seq, a_key AS key, 'h' || seq AS origin FROM changelog WHERE tbl = 'orders' AND a_key IS NOT NULL")
def _(spark, sf):
    d = order_log(spark, sf).where("after is not null").withColumn("headers", F.create_map(F.lit("src"), F.concat(F.lit("h"), F.col("seq").cast("string"))))
    return E.header_to_value(d, ["src"], ["origin"], "move").select("seq", "after.key", "after.origin")


@query("read_to_insert", "SELECT CASE WHEN op = 'r' THEN 'c' ELSE op END AS op, count(*) AS n FROM changelog GROUP BY 1")
def _(spark, sf):
    return E.read_to_insert(changelog(spark, sf)).groupBy("op").agg(F.count(F.lit(1)).alias("n"))


@query("json_round_trip", "SELECT seq, op, a_key AS key, a_status AS status, a_price AS price, a_cust AS cust FROM changelog WHERE tbl = 'orders'")
def _(spark, sf):
    return E.from_json_events(E.to_json_events(order_log(spark, sf)), "struct<key:bigint,status:string,price:bigint,cust:bigint>")


@query("source_schema", "SELECT n_name AS name, 'nation' AS id, 3 AS n_columns, 'n_nationkey:int' AS first FROM nation", log=False)
def _(spark, sf):
    d = E.add_source_schema(_read(spark, sf, "nation"), "nation")
    first = F.col("source_schema.columns")[0]
    return d.select(F.col("n_name").alias("name"), "source_schema.id", F.size("source_schema.columns").alias("n_columns"), F.concat_ws(":", first["name"], first["type"]).alias("first"))


@query("context_headers", "SELECT seq, 'shop' AS connector, '0' AS task FROM changelog")
def _(spark, sf):
    d = E.with_context_headers(changelog(spark, sf), {"__connector": "shop", "__task": "0"})
    return d.select("seq", F.col("headers")["__connector"].alias("connector"), F.col("headers")["__task"].alias("task"))


@query("logical_messages", "SELECT event_id AS seq, event_type AS prefix, 'c' AS op, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events", log=False)
def _(spark, sf):
    e = _read(spark, sf, "events").select(F.col("event_id").alias("seq"), F.col("event_type").alias("prefix"), F.lit("m").alias("op"), F.encode("props", "utf-8").alias("content"))
    return E.decode_messages(e, "k long").select("seq", "prefix", "op", "after.k")


# --- filters ------------------------------------------------------------------------------------


@query("table_filter", "SELECT seq, tbl FROM changelog WHERE regexp_full_match(lower('db1.public.' || tbl), 'db1\\.public\\.(ord.*)')")
def _(spark, sf):
    t = P.Tables(table_include=r"DB1\.public\.(ord.*)", table_exclude=r".*orders")
    return changelog(spark, sf).where(t.predicate(F.lit("db1"), F.lit("public"), F.col("tbl"))).select("seq", "tbl")


@query(
    "postgres_values",
    "SELECT p_partkey, '{' || p_partkey || ',2}' AS first, '{3,\"a}, b\"}' AS second, 'say \"' || p_brand || '\"' AS held, (p_partkey % 3 = 0) AS none, CASE WHEN p_partkey % 2 = 0 THEN 'PT' ELSE 'PT-' END || (p_partkey // 1000) || '.' || lpad(CAST(p_partkey % 1000 AS VARCHAR), 3, '0') || '000S' AS duration, "
    "replace(replace(p_brand, '#', '_u0023_ud83d_ude00'), ' ', '_u0020') AS topic FROM part",
    log=False,
)
def _(spark, sf):
    p = _read(spark, sf, "part")
    k = F.col("p_partkey").cast("string")
    nested = S.pg_array(F.concat(F.lit("{{"), k, F.lit(',2},{3,"a}, b"}}')))
    pairs = S.hstore(F.concat(F.lit('"k,"=>"say \\"'), F.col("p_brand"), F.lit('\\"", "n"=>'), F.when(F.col("p_partkey") % 3 == 0, "NULL").otherwise(F.concat(F.lit('"'), k, F.lit('"')))))
    spent = S.duration_iso(F.col("p_partkey").cast("long") * 1000 * F.when(F.col("p_partkey") % 2 == 0, 1).otherwise(-1))
    name = G.unicode_escaped(F.replace("p_brand", F.lit("#"), F.lit("#😀")))
    return p.select("p_partkey", nested[0].alias("first"), nested[1].alias("second"), pairs["k,"].alias("held"), pairs["n"].isNull().alias("none"), spent.alias("duration"), name.alias("topic"))


@query("builtin_filter", "SELECT r_name FROM region WHERE r_name <> 'REGION_0'", log=False)
def _(spark, sf):
    r = _read(spark, sf, "region").withColumn("s", F.when(F.col("r_name") == "REGION_0", "pg_catalog").otherwise("public"))
    return r.where(P.Tables().predicate(F.lit("db"), F.col("s"), F.col("r_name"))).select("r_name")


@query("name_predicates", "SELECT p_partkey FROM part WHERE lower(p_brand) IN ('brand#1') OR regexp_full_match(lower(p_brand), 'brand#[45].*')", log=False)
def _(spark, sf):
    return _read(spark, sf, "part").where(P.matches(F.col("p_brand"), ["BRAND#1"], ["brand#[45].*"])).select("p_partkey")


@query("column_filter", "SELECT o_orderkey, o_totalprice FROM orders", log=False)
def _(spark, sf):
    return P.project_columns(_read(spark, sf, "orders"), "orders", include=r"orders\.o_total.*", keys=["o_orderkey"])


@query("message_key", "SELECT o_custkey, o_orderpriority, count(*) AS n FROM orders GROUP BY ALL", log=False)
def _(spark, sf):
    o = _read(spark, sf, "orders")
    return o.groupBy(*P.message_key(o, "orders", "cust.*:c_custkey;ord.*:o_custkey,o_orderpriority", ["o_orderkey"])).agg(F.count(F.lit(1)).alias("n"))


@query("skip_operations", "SELECT op, count(*) AS n FROM changelog WHERE op NOT IN ('d', 't') GROUP BY 1")
def _(spark, sf):
    return P.skip_operations(changelog(spark, sf), "d,t").groupBy("op").agg(F.count(F.lit(1)).alias("n"))


@query("skip_unchanged", "SELECT seq FROM changelog WHERE NOT (op = 'u' AND a_key IS NOT DISTINCT FROM b_key AND a_status IS NOT DISTINCT FROM b_status AND a_price IS NOT DISTINCT FROM b_price AND a_cust IS NOT DISTINCT FROM b_cust)")
def _(spark, sf):
    return P.skip_unchanged(changelog(spark, sf)).select("seq")


@query("keep_where", "SELECT seq FROM changelog WHERE coalesce(a_price > 20000000 AND op = 'u', false)")
def _(spark, sf):
    return P.keep_where(changelog(spark, sf), "after.price > 20000000 and op = 'u'").select("seq")


# --- routing ------------------------------------------------------------------------------------


@query("route_by_content", "SELECT CASE WHEN op = 'd' THEN 'deletes' WHEN a_price > 20000000 THEN 'large' ELSE tbl END AS topic, count(*) AS n FROM changelog GROUP BY 1")
def _(spark, sf):
    d = changelog(spark, sf).withColumn("topic", F.col("tbl"))
    return G.by_content(d, "case when op = 'd' then 'deletes' when after.price > 20000000 then 'large' end").groupBy("topic").agg(F.count(F.lit(1)).alias("n"))


@query("logical_table_route", "SELECT seq, CASE WHEN seq % 4 = 3 THEN 'srv.lines' ELSE 'srv.orders_all' END AS topic, CASE WHEN seq % 4 <> 3 THEN 'srv.orders_shard' || (seq % 4) END AS __source FROM changelog WHERE tbl = 'orders'")
def _(spark, sf):
    shard = F.col("seq") % 4
    d = order_log(spark, sf).withColumn("topic", F.when(shard == 3, "srv.lines").otherwise(F.concat(F.lit("srv.orders_shard"), shard.cast("string"))))
    return G.logical_table(d, r"(.*)orders_shard(.*)", "$1orders_all").select("seq", "topic", "__source")


@query(
    "partition_routing",
    "SELECT seq, CAST(CASE WHEN h = 2147483647 THEN 0 ELSE h END % 12 AS INTEGER) AS partition FROM (SELECT seq, (xor(k, k >> 32) + CASE WHEN s IS NULL THEN 0 ELSE ascii(s) END) & 2147483647 AS h FROM (SELECT seq, CASE WHEN op = 'd' THEN b_key ELSE a_key END AS k, CASE WHEN op = 'd' THEN b_status ELSE a_status END AS s FROM changelog))",
)
def _(spark, sf):
    return G.to_partition(changelog(spark, sf), ["change.key", "change.status"], 12).select("seq", "partition")


def _murmur_sql() -> str:
    """Partitions by the hash of a key (the four bytes of its JVM hash) and a status (one byte), in integers of 128 bits."""
    word = lambda x: f"(({x}) % 18446744073709551616)"
    turned = lambda x, n: f"({word(f'{x} * {1 << n}::UHUGEINT')} + {x} // {1 << (64 - n)}::UHUGEINT)"
    u = lambda x: f"{x}::UHUGEINT"
    (a, b), (c, d), (e, f) = [x ^ G.SEED for x in G.HALVES], G.MULTIPLIERS, G.HALF_STEPS
    # one incomplete block: its second word is zero, so the second half turns only
    second = ((b << 41) | (b >> 23)) % (1 << 64)
    steps = ["k * " + u(c), turned("x", 23), "x * " + u(d), f"xor(x, {u(a)}) + {u(b)}"]
    ctes = [
        "v AS (SELECT seq, unnest([{'n': 4, 'v': xor(k, k >> 32) & 4294967295}, {'n': 1, 'v': ascii(s)::BIGINT}], recursive := true), k IS NULL AND s IS NULL AS none, s IS NULL AS bare FROM (SELECT seq, CASE WHEN op = 'd' THEN b_key ELSE a_key END AS k, CASE WHEN op = 'd' THEN b_status ELSE a_status END AS s FROM changelog))",
        # bytes have signs
        "w AS (SELECT seq, n, list_reduce([CASE WHEN i < n THEN (CASE WHEN (v >> (8 * i)) & 255 > 127 THEN 18446744073709551616::HUGEINT - (256 - ((v >> (8 * i)) & 255)) * (1::HUGEINT << (8 * i)) ELSE ((v >> (8 * i)) & 255)::HUGEINT * (1::HUGEINT << (8 * i)) END) ELSE 0::HUGEINT END FOR i IN range(4)], lambda p, q: xor(p, q))::UHUGEINT AS k FROM v WHERE v IS NOT NULL AND NOT (n = 1 AND bare))",
    ]
    last = "w"
    for i, step in enumerate(steps):
        ctes.append(f"s{i} AS (SELECT seq, n, {word(step)} AS x FROM {last})")
        last = f"s{i}"
    ctes.append(f"h AS (SELECT seq, {word(f'x * 3 + {u(e)}')} AS h1, xor({word(f'({word(f"x + {u(second)}")}) * 3 + {u(f)}')}, n::UHUGEINT) AS h2 FROM {last})")
    ctes.append(f"t AS (SELECT seq, {word('h1 + h2')} AS h1, h2 FROM h)")
    ctes.append(f"f0 AS (SELECT seq, h1, {word('h1 + h2')} AS h2 FROM t)")
    shifted = lambda x: f"xor({x}, {x} // {1 << 33}::UHUGEINT)"
    for i, factor in enumerate(G.FINISH):
        ctes.append(f"f{i + 1} AS (SELECT seq, {', '.join(word(f'{shifted(h)} * {u(factor)}') + f' AS {h}' for h in ('h1', 'h2'))} FROM f{i})")
    ctes.append(f"z AS (SELECT seq, sum(({word(shifted('h1') + ' + ' + shifted('h2'))} // 4294967296::UHUGEINT)::BIGINT)::BIGINT & 2147483647 AS h FROM f2 GROUP BY seq)")
    return f"WITH {LOG}, " + ", ".join(ctes) + " SELECT seq, CAST(CASE WHEN h = 2147483647 THEN 0 ELSE h END % 12 AS INTEGER) AS partition FROM changelog LEFT JOIN z USING (seq)"


@query("partition_routing_murmur", _murmur_sql())
def _(spark, sf):
    return G.to_partition(changelog(spark, sf), ["change.key", "change.status"], 12, "murmur").select("seq", "partition")


_OUTBOX = "SELECT event_id AS seq, 'outbox.event.' || event_type AS topic, user_id AS key, props AS value, CAST(event_id AS VARCHAR) AS h_id, event_type AS h_type, epoch_us(ts) // 1000 AS ts_ms FROM events WHERE event_id % 10 <> 3"


@query(
    "outbox_inferred",
    f"WITH {_DOCS} SELECT CAST(k AS BIGINT) AS k, 'paid' AS type, CAST(CASE WHEN k % 2 = 0 THEN p ELSE p / 100.0 END AS DOUBLE) AS amount, CASE WHEN k % 3 <> 0 THEN CAST(c AS BIGINT) END AS x, CASE WHEN k % 3 = 1 THEN 'late' END AS y FROM o WHERE s = 'F' "
    "UNION ALL SELECT k, 'open', NULL, len([k, c]), NULL FROM o WHERE s <> 'F'",
    log=False,
)
def _(spark, sf):
    """Payloads of two event types, whose types are found from all of them: numbers of two kinds, objects with different fields, arrays."""
    o = _read(spark, sf, "orders").selectExpr("CAST(o_orderkey AS BIGINT) AS k", "o_orderstatus AS s", "CAST(round(o_totalprice * 100) AS BIGINT) AS p", "CAST(o_custkey AS BIGINT) AS c")
    nested = "CASE WHEN k % 3 = 0 THEN '{}' WHEN k % 3 = 1 THEN '{\"x\":' || c || ',\"y\":\"late\"}' ELSE '{\"x\":' || c || '}' END"
    paid = f"""'{{"amount":' || CASE WHEN k % 2 = 0 THEN CAST(p AS STRING) ELSE CAST(CAST(p AS DOUBLE) / 100 AS STRING) END || ',"n":' || {nested} || '}}'"""
    e = o.selectExpr("k", "CASE WHEN s = 'F' THEN 'paid' ELSE 'open' END AS type", f"CASE WHEN s = 'F' THEN {paid} ELSE '{{\"ids\":[' || k || ',' || c || ']}}' END AS payload")
    typed = D.typed_payloads(e, "type", "payload")
    a = typed["paid"].select("k", "type", F.col("value.amount").cast("double").alias("amount"), F.col("value.n.x").cast("long").alias("x"), "value.n.y")
    b = typed["open"].select("k", "type", F.lit(None).cast("double").alias("amount"), F.size("value.ids").cast("long").alias("x"), F.lit(None).cast("string").alias("y"))
    return a.unionByName(b)


@query("outbox", _OUTBOX, log=False)
def _(spark, sf):
    e = _read(spark, sf, "events")
    after = F.struct(F.col("event_id").alias("id"), F.col("event_type").alias("aggregatetype"), F.col("user_id").alias("aggregateid"), F.col("event_type").alias("type"), F.col("props").alias("payload"), S.epoch(F.col("ts")).alias("at"))
    e = e.select(F.col("event_id").alias("seq"), F.when(F.col("event_id") % 10 == 3, "d").otherwise("c").alias("op"), after.alias("after"), F.lit(0).alias("ts_ms"))
    d = G.outbox(e, G.Outbox(timestamp="at", placements=(("type", "header"),)))
    return d.select("seq", "topic", "key", "value", F.col("headers")["id"].alias("h_id"), F.col("headers")["type"].alias("h_type"), "ts_ms")


@query("outbox_expanded", "SELECT event_id AS seq, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events", log=False)
def _(spark, sf):
    e = _read(spark, sf, "events").select(F.col("event_id").alias("seq"), F.lit("c").alias("op"), F.struct(F.col("event_id").alias("id"), F.col("event_type").alias("aggregatetype"), F.col("user_id").alias("aggregateid"), F.col("props").alias("payload")).alias("after"), F.lit(0).alias("ts_ms"))
    return G.outbox(e, G.Outbox(expand_schema="k long")).select("seq", "value.k")


@query("hypertables", "SELECT CASE WHEN n_regionkey < 3 THEN 'hyper_' || n_regionkey ELSE n_name END AS tbl, count(*) AS n FROM nation GROUP BY 1", log=False)
def _(spark, sf):
    n = _read(spark, sf, "nation")
    chunks = n.where("n_regionkey < 3").select(F.col("n_name").alias("chunk_table"), F.concat(F.lit("hyper_"), F.col("n_regionkey").cast("string")).alias("hypertable"))
    return G.hypertables(n.withColumn("tbl", F.col("n_name")), chunks).groupBy("tbl").agg(F.count(F.lit(1)).alias("n"))


@query("topic_names", "SELECT p_partkey, substr('srv.public.' || regexp_replace(p_brand, '[^A-Za-z0-9._-]', '_', 'g'), 1, 249) AS topic FROM part", log=False)
def _(spark, sf):
    return _read(spark, sf, "part").select("p_partkey", G.topic_name("srv", F.lit("public"), F.col("p_brand")).alias("topic"))


@query("collection_names", "SELECT p_partkey, 'c_' || replace('srv.' || p_brand, '.', '_') || '_x' AS name FROM part", log=False)
def _(spark, sf):
    p = _read(spark, sf, "part")
    return p.select("p_partkey", G.collection_name("c_${topic}_${source.db}", F.concat(F.lit("srv."), F.col("p_brand")), {"db": F.lit("x")}).alias("name"))


@query("escaped_names", "SELECT p_partkey, replace(replace(replace(p_brand, '_', '_u005f'), '#', '_u0023'), ' ', '_u0020') AS name FROM part", log=False)
def _(spark, sf):
    return _read(spark, sf, "part").select("p_partkey", G.unicode_escaped(F.col("p_brand")).alias("name"))


# --- transactions -------------------------------------------------------------------------------


@query("transaction_order", "SELECT seq, tx_id, row_number() OVER (PARTITION BY tx_id ORDER BY seq) AS total_order, row_number() OVER (PARTITION BY tx_id, tbl ORDER BY seq) AS data_collection_order FROM changelog")
def _(spark, sf):
    return T.ordered(changelog(spark, sf)).select("seq", "tx_id", "total_order", "data_collection_order")


@query(
    "transaction_boundaries",
    "SELECT tx_id AS id, s.status, CASE WHEN s.status = 'END' THEN n END AS event_count, CASE WHEN s.status = 'END' THEN cols END AS data_collections, CASE WHEN s.status = 'BEGIN' THEN lo ELSE hi END AS seq, CASE WHEN s.status = 'BEGIN' THEN t0 ELSE t1 END AS ts_ms FROM (SELECT tx_id, CAST(sum(n) AS BIGINT) AS n, string_agg(tbl || '=' || n, ',' ORDER BY tbl) AS cols, min(lo) AS lo, max(hi) AS hi, min(t0) AS t0, max(t1) AS t1 FROM (SELECT tx_id, tbl, count(*) AS n, min(seq) AS lo, max(seq) AS hi, min(ts_ms) AS t0, max(ts_ms) AS t1 FROM changelog GROUP BY 1, 2) GROUP BY 1), (VALUES ('BEGIN'), ('END')) s(status)",
)
def _(spark, sf):
    return T.boundaries(changelog(spark, sf))


@query("transaction_runs", "SELECT o_custkey % 16 AS part, count(*) AS n_runs FROM (SELECT o_custkey, o_orderkey, CAST(floor(o_orderkey / 64) AS BIGINT) AS tx, lag(CAST(floor(o_orderkey / 64) AS BIGINT)) OVER (PARTITION BY o_custkey % 16 ORDER BY o_orderkey) AS prev FROM orders) WHERE prev IS DISTINCT FROM tx GROUP BY 1", log=False)
def _(spark, sf):
    o = _read(spark, sf, "orders").select((F.col("o_custkey") % 16).alias("part"), F.col("o_orderkey").alias("seq"), F.floor(F.col("o_orderkey") / 64).alias("tx_id"))
    return T.runs(o, "part").groupBy("part").agg(F.countDistinct("run").alias("n_runs"))


@query("committed_only", "SELECT seq, tx_id, (tx_id + 1) * 40 AS commit_seq FROM changelog WHERE tx_id % 17 <> 0")
def _(spark, sf):
    d = changelog(spark, sf)
    ends = d.select("tx_id").distinct().select("tx_id", F.when(F.col("tx_id") % 17 == 0, "rollback").otherwise("commit").alias("end"), ((F.col("tx_id") + 1) * 40).alias("end_seq"))
    return T.committed(d, ends).select("seq", "tx_id", "commit_seq")


@query("undone_rows", "SELECT e.seq FROM changelog e WHERE tbl = 'orders' AND NOT (op = 'u' AND seq % 10 = 1 AND floor(seq / 10) % 9 = 0)")
def _(spark, sf):
    d = order_log(spark, sf).withColumn("row_id", F.floor(F.col("seq") / 10))
    undo = d.where("op = 'u' and seq % 10 = 1 and row_id % 9 = 0").select("tx_id", "row_id", (F.col("seq") * 1).alias("seq"))
    # the undo of an event stands right after it
    e, u = d.withColumn("seq", F.col("seq") * 2), undo.withColumn("seq", F.col("seq") * 2 + 1)
    return T.without_undone(e, u, "row_id").select((F.col("seq") / 2).cast("long").alias("seq"))


@query("merge_by_commit", "SELECT floor(seq / 40) AS commit_lsn, op, coalesce(a_key, b_key) AS key FROM changelog WHERE op <> 'r'")
def _(spark, sf):
    d = changelog(spark, sf).where("op <> 'r'")

    def capture(t):
        x = d.where(F.col("tbl") == t)
        row = lambda side, code: F.struct(F.lit(code).alias("code"), F.col(side).alias("row"))
        rows = F.when(F.col("op") == "u", F.array(row("before", 3), row("after", 4))).when(F.col("op") == "d", F.array(row("before", 1))).otherwise(F.array(row("after", 2)))
        return x.select(F.floor(F.col("seq") / 40).cast("double").alias("commit_lsn"), F.col("seq").alias("tx_lsn"), F.explode(rows).alias("_r")).select("commit_lsn", "tx_lsn", "_r.*")

    m = T.merged_by_commit([capture("orders"), capture("customer")])
    return m.select("commit_lsn", "op", F.coalesce("after.key", "before.key").alias("key"))


@query("resume_position", "SELECT count(*) AS n, min(seq) AS first_seq FROM changelog WHERE seq * 8 > 40000")
def _(spark, sf):
    return T.resume_after(changelog(spark, sf).withColumn("lsn", F.col("source.lsn")), 40000).agg(F.count(F.lit(1)).alias("n"), F.min("seq").alias("first_seq"))


_LOB = (
    "SELECT tx_id, key, seq, op, status, clob FROM (SELECT CAST(floor(o_orderkey / 4) AS BIGINT) AS tx_id, CAST(o_orderkey AS BIGINT) AS key, o_orderstatus AS s, o_orderpriority AS p FROM orders) o, LATERAL (VALUES "
    "(key * 10, 'c', CASE WHEN key % 4 = 0 THEN NULL ELSE s END, CASE WHEN key % 3 = 0 THEN NULL ELSE p END), (key * 10 + 3, 'd', '?', '?'), (key * 10 + 4, 'u', 'X', 'big')) v(seq, op, status, clob) WHERE op = 'c' OR key % 5 = 0"
)


@query("large_object_merge", _LOB, log=False)
def _(spark, sf):
    o = _read(spark, sf, "orders").select(F.floor(F.col("o_orderkey") / 4).alias("tx_id"), F.col("o_orderkey").cast("long").alias("key"), F.col("o_orderstatus").alias("s"), F.col("o_orderpriority").alias("p"))
    row = lambda n, op, status, clob: F.struct((F.col("key") * 10 + n).alias("seq"), F.lit(op).alias("op"), status.alias("status"), clob.alias("clob"))
    gone, k = F.lit("?"), F.col("key")
    rows = [row(0, "c", F.col("s"), gone), row(1, "u", gone, F.when(k % 3 != 0, F.col("p"))), row(2, "u", F.when(k % 4 != 0, gone), gone)]
    late = [row(3, "d", gone, gone), row(4, "u", F.lit("X"), gone), row(5, "u", gone, F.lit("big"))]
    d = o.select("tx_id", "key", F.explode(F.when(k % 5 == 0, F.array(*rows, *late)).otherwise(F.array(*rows))).alias("r")).select("tx_id", "key", "r.*")
    return T.merge_large_objects(d, ["status", "clob"], ["clob"], "?")


@query(
    "transaction_run_boundaries",
    "WITH e AS (SELECT CAST(o_custkey % 16 AS BIGINT) AS part, CAST(o_orderkey AS BIGINT) AS seq, CASE WHEN o_orderkey % 7 <> 0 THEN CAST(floor(o_orderkey / 64) AS BIGINT) % 3 END AS tx FROM orders), "
    "r AS (SELECT *, sum(CASE WHEN tx IS DISTINCT FROM p THEN 1 ELSE 0 END) OVER (PARTITION BY part ORDER BY seq) AS run FROM (SELECT *, lag(tx) OVER (PARTITION BY part ORDER BY seq) AS p FROM e)), "
    "g AS (SELECT part, tx, run, count(*) AS n, min(seq) AS lo, max(seq) AS hi FROM r WHERE tx IS NOT NULL GROUP BY ALL) "
    "SELECT part, tx AS id, 'BEGIN' AS status, lo AS seq, NULL AS event_count, NULL AS data_collections, lo AS ts_ms FROM g UNION ALL SELECT part, tx, 'END', hi, n, 'orders=' || n, hi FROM g",
    log=False,
)
def _(spark, sf):
    k = F.col("o_orderkey").cast("long")
    o = _read(spark, sf, "orders").select((F.col("o_custkey") % 16).cast("long").alias("part"), k.alias("seq"), k.alias("ts_ms"), F.lit("orders").alias("tbl"), F.when(k % 7 != 0, F.floor(k / 64) % 3).alias("tx_id"))
    return T.run_boundaries(o, "part")


@query(
    "look_ahead_buffer",
    "WITH o AS (SELECT o_custkey % 16 AS part, CAST(o_orderkey AS BIGINT) AS k, o_orderkey % 11 = 0 AS open, row_number() OVER (PARTITION BY o_custkey % 16 ORDER BY o_orderkey) AS rn, lead(o_orderkey) OVER (PARTITION BY o_custkey % 16 ORDER BY o_orderkey) AS next FROM orders), "
    "b AS (SELECT *, (rn - 1 - coalesce(max(CASE WHEN NOT open THEN rn END) OVER (PARTITION BY part ORDER BY rn ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)) % 2 = 0 AS inside FROM o) "
    "SELECT k, NOT (inside AND open) AS well_formed FROM b WHERE NOT inside OR (open AND next IS NOT NULL) OR (NOT open AND k % 5 <> 0)",
    log=False,
)
def _(spark, sf):
    o = _read(spark, sf, "orders").select((F.col("o_custkey") % 16).alias("part"), F.col("o_orderkey").cast("long").alias("k"))
    row = lambda n, kind: F.struct((F.col("k") * 4 + n).alias("seq"), kind.alias("kind"))
    end = F.when(F.col("k") % 5 == 0, "ROLLBACK").otherwise("COMMIT")
    log = F.when(F.col("k") % 11 == 0, F.array(row(0, F.lit("BEGIN")), row(1, F.lit("row")))).otherwise(F.array(row(0, F.lit("BEGIN")), row(1, F.lit("row")), row(2, end)))
    return T.by_markers(o.select("part", "k", F.explode(log).alias("e")).select("part", "k", "e.*"), "part").select("k", "well_formed")


@query("abandoned_transactions", "SELECT tx_id FROM changelog GROUP BY tx_id HAVING min(ts_ms) < 1700000500000 OR count(*) > 9")
def _(spark, sf):
    return T.abandoned(changelog(spark, sf), 1_700_000_600_000, 100_000, 9)


@query("rolled_back_by_prefix", "SELECT seq FROM changelog WHERE NOT (tx_id % 17 = 0 OR floor(tx_id / 1000) % 3 = 1)")
def _(spark, sf):
    text = lambda c: F.format_string("%08d%03d", F.floor(c / 1000), c % 1000)
    d = changelog(spark, sf).withColumn("t", text(F.col("tx_id"))).drop("tx_id").withColumnRenamed("t", "tx_id")
    ids = changelog(spark, sf).select("tx_id").distinct()
    known = ids.where("tx_id % 17 = 0 and floor(tx_id / 1000) % 3 <> 1").select(text(F.col("tx_id")).alias("tx_id"))
    cut = ids.where("floor(tx_id / 1000) % 3 = 1").select(F.concat(F.substring(text(F.col("tx_id")), 1, 8), F.lit("ffffffff")).alias("tx_id"))
    return T.without_rolled_back(d, known.unionByName(cut)).select("seq")


@query("relevant_transactions", "SELECT seq FROM changelog WHERE tx_id IN (SELECT tx_id FROM changelog WHERE tbl = 'customer')")
def _(spark, sf):
    return T.relevant(changelog(spark, sf), ["customer"]).select("seq")


# --- snapshots ----------------------------------------------------------------------------------


@query("snapshot_scan", "SELECT 'r' AS op, 'nation' AS tbl, CAST(n_nationkey AS BIGINT) AS key, n_name AS name FROM nation UNION ALL SELECT 'r', 'region', r_regionkey, r_name FROM region WHERE r_regionkey > 1", log=False)
def _(spark, sf):
    tables = {"nation": _read(spark, sf, "nation").selectExpr("n_nationkey AS key", "n_name AS name"), "region": _read(spark, sf, "region").selectExpr("r_regionkey AS key", "r_name AS name")}
    return N.scan(spark, tables, {"region": "SELECT * FROM {region} WHERE key > 1"}).select("op", "tbl", F.get_json_object("after", "$.key").cast("long").alias("key"), F.get_json_object("after", "$.name").alias("name"))


@query("snapshot_condition", "SELECT 'r' AS op, o_orderkey FROM orders WHERE o_orderstatus = 'F'", log=False)
def _(spark, sf):
    return N.reads(_read(spark, sf, "orders").where("o_orderstatus = 'F'"), "orders").select("op", "after.o_orderkey")


@query(
    "snapshot_markers",
    "SELECT tbl, k, CASE WHEN i = n AND j = m THEN 'last' WHEN g = 1 THEN 'first' WHEN i = n THEN 'last_in_data_collection' WHEN i = 1 THEN 'first_in_data_collection' ELSE 'true' END AS snapshot FROM (SELECT *, row_number() OVER (PARTITION BY tbl ORDER BY k) AS i, count(*) OVER (PARTITION BY tbl) AS n, dense_rank() OVER (ORDER BY tbl) AS j, 2 AS m, row_number() OVER (ORDER BY tbl, k) AS g FROM (SELECT 'nation' AS tbl, CAST(n_nationkey AS BIGINT) AS k FROM nation UNION ALL SELECT 'customer', CAST(c_custkey AS BIGINT) FROM customer))",
    log=False,
)
def _(spark, sf):
    d = _read(spark, sf, "nation").select(F.lit("nation").alias("tbl"), F.col("n_nationkey").cast("long").alias("k"))
    d = d.unionByName(_read(spark, sf, "customer").select(F.lit("customer").alias("tbl"), F.col("c_custkey").cast("long").alias("k")))
    return N.with_markers(d, "k").select("tbl", "k", "snapshot")


@query("keyset_pages", "SELECT chunk_id, count(*) AS n, min(o_orderkey) AS lo, max(o_orderkey) AS hi FROM (SELECT o_orderkey, CAST(floor((row_number() OVER (ORDER BY o_orderkey) - 1) / 1024) AS BIGINT) AS chunk_id FROM orders) GROUP BY 1", log=False)
def _(spark, sf):
    return N.paged(_read(spark, sf, "orders").select("o_orderkey"), ["o_orderkey"], 1024).groupBy("chunk_id").agg(F.count(F.lit(1)).alias("n"), F.min("o_orderkey").alias("lo"), F.max("o_orderkey").alias("hi"))


@query("chunk_boundaries", "WITH b AS (SELECT quantile_cont(o_orderkey, [0.25, 0.5, 0.75]) AS q FROM orders) SELECT CASE WHEN o_orderkey >= q[3] THEN 3 WHEN o_orderkey >= q[2] THEN 2 WHEN o_orderkey >= q[1] THEN 1 ELSE 0 END AS chunk, count(*) AS n, min(o_orderkey) AS lo FROM orders, b GROUP BY 1", log=False)
def _(spark, sf):
    o = _read(spark, sf, "orders")
    return N.with_chunks(o, "o_orderkey", N.boundaries(o, "o_orderkey", 4, exact=True)).groupBy("chunk").agg(F.count(F.lit(1)).alias("n"), F.min("o_orderkey").alias("lo"))


@query("chunk_by_bounds", "SELECT CASE WHEN o_orderkey >= 300 THEN 2 WHEN o_orderkey >= 100 THEN 1 ELSE 0 END AS chunk, count(*) AS n FROM orders GROUP BY 1", log=False)
def _(spark, sf):
    return N.with_chunks(_read(spark, sf, "orders"), "o_orderkey", [100, 300]).groupBy("chunk").agg(F.count(F.lit(1)).alias("n"))


@query("after_key", "SELECT l_orderkey, l_linenumber FROM lineitem WHERE l_orderkey > 700 OR (l_orderkey = 700 AND l_linenumber > 2)", log=False)
def _(spark, sf):
    return _read(spark, sf, "lineitem").where(N.after_key(["l_orderkey", "l_linenumber"], [700, 2])).select("l_orderkey", "l_linenumber")


@query("after_key_row", "SELECT l_orderkey, l_linenumber FROM lineitem WHERE (l_orderkey, l_linenumber) > (700, 2)", log=False)
def _(spark, sf):
    return _read(spark, sf, "lineitem").where(N.after_key_row(["l_orderkey", "l_linenumber"], [700, 2])).select("l_orderkey", "l_linenumber")


@query("max_key", "SELECT l_orderkey, l_linenumber FROM lineitem ORDER BY l_orderkey DESC, l_linenumber DESC LIMIT 1", log=False)
def _(spark, sf):
    return N.max_key(_read(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"])


@query("next_chunk", "SELECT o_orderkey FROM orders WHERE o_orderkey > 500 AND o_orderkey <= 100000 ORDER BY 1 LIMIT 256", log=False)
def _(spark, sf):
    return N.next_chunk(_read(spark, sf, "orders"), ["o_orderkey"], [500], [100000], 256).select("o_orderkey")


@query("surrogate_chunk", "SELECT o_custkey, count(*) AS n FROM orders WHERE o_custkey > 40 AND o_custkey <= 90 GROUP BY 1", log=False)
def _(spark, sf):
    o = _read(spark, sf, "orders")
    return o.where(N.after_key(["o_custkey"], [40]) & ~N.after_key(["o_custkey"], [90])).groupBy("o_custkey").agg(F.count(F.lit(1)).alias("n"))


@query(
    "window_dedup",
    f"WITH {LOG}, chunks AS (SELECT CAST(floor(o_orderkey / 100) AS BIGINT) AS chunk_id, CAST(o_orderkey AS BIGINT) AS key FROM orders), w AS (SELECT DISTINCT chunk_id, chunk_id * 4000 AS low, chunk_id * 4000 + 3000 AS high FROM chunks), "
    "hit AS (SELECT DISTINCT c.key FROM chunks c JOIN w USING (chunk_id) JOIN changelog e ON coalesce(e.a_key, e.b_key) = c.key WHERE e.tbl = 'orders' AND e.seq > w.low AND e.seq <= w.high) "
    "SELECT w.high AS seq, 0 AS sub, 'r' AS op, c.key, 'incremental' AS snapshot FROM chunks c JOIN w USING (chunk_id) ANTI JOIN hit ON hit.key = c.key "
    "UNION ALL SELECT seq, 1, op, coalesce(a_key, b_key), 'false' FROM changelog WHERE tbl = 'orders'",
)
def _(spark, sf):
    o = _read(spark, sf, "orders").select(F.col("o_orderkey").cast("long").alias("key"), F.col("o_orderstatus").alias("status"), F.lit(0).cast("long").alias("price"), F.col("o_custkey").cast("long").alias("cust"))
    chunks = o.select(F.floor(F.col("key") / 100).alias("chunk_id"), F.lit("orders").alias("tbl"), "key", F.struct("key", "status", "price", "cust").alias("after"))
    windows = chunks.select("chunk_id").distinct().select("chunk_id", (F.col("chunk_id") * 4000).alias("low"), (F.col("chunk_id") * 4000 + 3000).alias("high"))
    return N.deduplicated(chunks, windows, order_log(spark, sf), KEYS).select("seq", "sub", "op", "key", "snapshot")


_RULES = "(NOT o OR p OR (m LIKE 'when_needed%' AND NOT l))"


@query(
    "snapshot_modes",
    "WITH c AS (SELECT m, o, p, l FROM (SELECT unnest(['always', 'initial', 'initial_only', 'no_data', 'recovery', 'when_needed', 'when_needed_no_data']) AS m), (SELECT unnest([true, false]) AS o), (SELECT unnest([true, false]) AS p), (SELECT unnest([true, false]) AS l)) "
    f"SELECT m AS mode, o AS has_offset, p AS broken_off, l AS log_there, m = 'always' OR (m IN ('initial', 'initial_only', 'when_needed') AND {_RULES}) AS data, m IN ('always', 'recovery') OR {_RULES} AS schema, m <> 'initial_only' AS stream FROM c",
    log=False,
)
def _(spark, sf):
    rows = [(m, o, p, there, *N.decide(m, o, p, there)) for m in N.MODES[:-1] for o in (True, False) for p in (True, False) for there in (True, False)]
    return spark.createDataFrame(rows, "mode string, has_offset boolean, broken_off boolean, log_there boolean, data boolean, schema boolean, stream boolean")


@query("table_order", "SELECT row_number() OVER (ORDER BY n DESC, tbl DESC) AS place, tbl FROM (SELECT 'nation' AS tbl, count(*) AS n FROM nation UNION ALL SELECT 'region', count(*) FROM region UNION ALL SELECT 'customer', count(*) FROM customer UNION ALL SELECT 'a_view', 0)", log=False)
def _(spark, sf):
    counts = {t: _read(spark, sf, t).count() for t in ("nation", "region", "customer")} | {"a_view": None}
    return spark.createDataFrame(list(enumerate(N.table_order(counts, "descending"), 1)), "place long, tbl string")


@query("signal_windows", "SELECT 'c' || c_nationkey AS chunk_id, CAST(min(c_custkey) AS BIGINT) AS low, CAST(max(c_custkey) AS BIGINT) AS high FROM customer GROUP BY 1", log=False)
def _(spark, sf):
    c = _read(spark, sf, "customer").groupBy(F.concat(F.lit("c"), F.col("c_nationkey").cast("string")).alias("c")).agg(F.min("c_custkey").cast("long").alias("lo"), F.max("c_custkey").cast("long").alias("hi"))
    row = lambda end, at: F.struct(F.concat("c", F.lit(f"-{end}")).alias("id"), F.lit(f"snapshot-window-{end}").alias("type"), F.col(at).alias("seq"))
    return N.windows_from_signals(c.select(F.explode(F.array(row("open", "lo"), row("close", "hi"))).alias("_s")).select("_s.*"))


# --- scalar functions ---------------------------------------------------------------------------


@query("masks", "SELECT o_orderkey, '*****' AS masked, substr(md5('salt' || o_orderpriority), 1, 12) AS hashed, sha256('salt' || o_orderpriority) AS hashed256, substr(o_orderpriority, 1, 3) AS cut FROM orders", log=False)
def _(spark, sf):
    c = F.col("o_orderpriority")
    return _read(spark, sf, "orders").select("o_orderkey", S.mask(5).alias("masked"), S.hash_mask(c, "MD5", "salt", 12).alias("hashed"), S.hash_mask(c, "SHA-256", "salt").alias("hashed256"), S.truncate(c, 3).alias("cut"))


@query("hash_mask_v1", "SELECT o_orderkey, sha256(encode('salt') || unhex('ACED000574' || printf('%04X', strlen(o_orderpriority))) || encode(o_orderpriority)) AS hashed FROM orders", log=False)
def _(spark, sf):
    return _read(spark, sf, "orders").select("o_orderkey", S.hash_mask_v1(F.col("o_orderpriority"), "SHA-256", "salt").alias("hashed"))


@query("first_matching_rule", "SELECT '***' AS c_name, substr(c_mktsegment, 1, 2) AS c_mktsegment, c_custkey FROM customer", log=False)
def _(spark, sf):
    c = _read(spark, sf, "customer").select("c_name", "c_mktsegment", "c_custkey")
    return S.first_rule(c, "customer", [(r"customer\.c_name", lambda x: S.mask(3)), (r"customer\.c_(name|mkt.*)", lambda x: S.truncate(x, 2))])


@query("binary_encodings", "SELECT doc_id, base64(encode(text)) AS b64, replace(replace(base64(encode(text)), '+', '-'), '/', '_') AS url, lower(hex(encode(text))) AS hex FROM documents", log=False)
def _(spark, sf):
    c = F.col("text").cast("binary")
    return _read(spark, sf, "documents").select("doc_id", S.binary_as(c, "base64").alias("b64"), S.binary_as(c, "base64-url-safe").alias("url"), S.binary_as(c, "hex").alias("hex"))


@query("numbers", "SELECT o_orderkey, CAST(o_orderkey % 100 AS SMALLINT) AS small, CASE WHEN (o_orderkey % 256) - 128 < 0 THEN (o_orderkey % 256) - 128 + 256 ELSE (o_orderkey % 256) - 128 END AS u8, CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS VARCHAR) AS dec, CASE WHEN o_custkey % 7 <> 0 THEN o_orderkey % (o_custkey % 7) END AS m FROM orders", log=False)
def _(spark, sf):
    k = F.col("o_orderkey")
    return _read(spark, sf, "orders").select("o_orderkey", S.widened(k % 100, "smallint").alias("small"), S.unsigned(k % 256 - 128, 8).alias("u8"), S.decimal_as(S.decimal_as(F.col("o_totalprice"), "precise", 18, 2), "string").alias("dec"), S.arithmetic("%", k, F.col("o_custkey") % 7).alias("m"))


@query(
    "temporal_encodings",
    "SELECT event_id, epoch_us(ts) // 1000 AS ms, epoch_us(ts) AS us, epoch_us(ts) * 1000 AS ns, epoch_us(ts) % 86400000000 AS time_us, date_diff('day', DATE '1970-01-01', CAST(ts AS DATE)) AS days, strftime(ts, '%Y-%m-%dT%H:%M:%SZ') AS iso, year(ts) AS y, second(ts) AS s FROM events",
    log=False,
)
def _(spark, sf):
    ts = F.col("ts")
    parts = S.structured(ts)
    return _read(spark, sf, "events").select(
        "event_id", S.epoch(ts).alias("ms"), S.epoch(ts, "us").alias("us"), S.epoch(ts, "ns").alias("ns"), S.in_day(S.time_of_day(ts)).alias("time_us"), S.epoch_days(ts).cast("long").alias("days"),
        S.iso(ts, "timestamp").alias("iso"), parts["year"].cast("long").alias("y"), parts["second"].cast("long").alias("s"),
    )


# New York's summer time: from the second Sunday of March to the first of November, in wall-clock time
_SUNDAY = "make_timestamp(year(ts), {m}, {d}, {h}, 0, 0) + to_days(CAST((7 - dayofweek(make_date(year(ts), {m}, {d}))) % 7 AS INTEGER))"


@query("zones", f"SELECT event_id, epoch_us(ts) // 1000 + CASE WHEN ts >= {_SUNDAY.format(m=3, d=8, h=3)} AND ts < {_SUNDAY.format(m=11, d=1, h=2)} THEN 14400000 ELSE 18000000 END AS ms FROM events", log=False)
def _(spark, sf):
    e = _read(spark, sf, "events").select("event_id", S.epoch(F.col("ts")).alias("ms"))
    return R.convert_zones(e, "America/New_York", "events", epoch_ms=["ms"])


@query("zoned_texts", "SELECT event_id, strftime(ts, '%Y-%m-%dT%H:%M:%SZ') AS utc, strftime(ts + INTERVAL 330 MINUTE, '%Y-%m-%dT%H:%M:%S+05:30') AS india FROM events", log=False)
def _(spark, sf):
    return _read(spark, sf, "events").select("event_id", S.zoned(F.col("ts")).alias("utc"), S.zoned(F.col("ts"), "Asia/Kolkata").alias("india"))


@query("bit_strings", "SELECT o_orderkey, printf('%02X%02X', o_orderkey % 256, (o_orderkey // 256) % 256) AS bytes, o_orderkey % 2 = 1 AS flag FROM orders", log=False)
def _(spark, sf):
    k = F.col("o_orderkey")
    return _read(spark, sf, "orders").select("o_orderkey", F.hex(S.bits(F.lpad(F.bin(k % 65536), 16, "0"), 16)).alias("bytes"), S.bits((k % 2).cast("string"), 1).alias("flag"))


@query("special_values", "SELECT o_orderkey, CASE WHEN o_orderkey % 5 <> 0 THEN strftime(o_orderdate, '%Y-%m-%d %H:%M') END AS at, o_orderkey % 3 <> 0 AS flag, 'it''s' AS text, CAST(42 AS INTEGER) AS number, NULL::INTEGER AS none FROM orders", log=False)
def _(spark, sf):
    text = F.when(F.col("o_orderkey") % 5 == 0, "0000-00-00 00:00:00").otherwise(F.col("o_orderdate").cast("string"))
    return _read(spark, sf, "orders").select(
        "o_orderkey", F.date_format(S.zero_date(text), "yyyy-MM-dd HH:mm").alias("at"), S.tinyint_as_boolean(F.col("o_orderkey") % 3).alias("flag"), S.default_value("'it''s'", "string").alias("text"), S.default_value("42", "int").alias("number"), S.default_value("NULL", "int").alias("none")
    )


@query("array_and_range_texts", "SELECT o_orderkey, 'a, ' || o_orderkey AS item, true AS last_null, CAST(o_orderkey AS VARCHAR) AS lower, CASE WHEN o_orderkey % 2 = 0 THEN CAST(o_orderkey + 5 AS VARCHAR) END AS upper, true AS from_here, false AS to_there FROM orders", log=False)
def _(spark, sf):
    k = F.col("o_orderkey").cast("string")
    items = S.pg_array(F.concat(F.lit("{x,\"a, "), k, F.lit('",NULL}')))
    span = S.pg_range(F.concat(F.lit("["), k, F.lit(","), F.when(F.col("o_orderkey") % 2 == 0, (F.col("o_orderkey") + 5).cast("string")).otherwise(""), F.lit(")")))
    return _read(spark, sf, "orders").select("o_orderkey", items[1].alias("item"), items[2].isNull().alias("last_null"), span["lower"].alias("lower"), span["upper"].alias("upper"), span["lower_inclusive"].alias("from_here"), span["upper_inclusive"].alias("to_there"))


@query("source_types", "SELECT * FROM (VALUES ('n_nationkey', 'INT', 10), ('n_name', 'STRING', NULL), ('n_regionkey', NULL, NULL)) t(name, type, length)", log=False)
def _(spark, sf):
    d = S.with_source_types(_read(spark, sf, "nation"), "nation", [r"nation\.n_na.*"], {"n_nationkey": {"length": 10}})
    rows = [(f.name, f.metadata.get("source.column.type"), f.metadata.get("length")) for f in d.schema]
    return spark.createDataFrame(rows, "name string, type string, length int")


@query("json_paths", "SELECT event_id, json_extract_string(props, '$.k') AS k FROM events", log=False)
def _(spark, sf):
    return _read(spark, sf, "events").select("event_id", S.json_path(F.col("props"), "$.k").alias("k"))


# --- records ------------------------------------------------------------------------------------


@query("record_size", "SELECT doc_id, 56 + 2 * 8 + 24 + 56 + strlen(text) AS size FROM documents", log=False)
def _(spark, sf):
    d = _read(spark, sf, "documents").select("doc_id", F.struct("doc_id", "text").alias("after"))
    return d.select("doc_id", R.estimated_size(F.col("after"), d.schema["after"].dataType).cast("long").alias("size"))


@query(
    "enforce_size",
    "SELECT doc_id, n, md5(substr(text, 1, n)) AS md5 FROM (SELECT doc_id, text, CASE WHEN e > 0 THEN greatest(0, n - CAST(ceil(CAST(n AS DOUBLE) / n * e) AS BIGINT)) ELSE n END AS n FROM (SELECT doc_id, text, length(text) AS n, 56 + 2 * 8 + 24 + 56 + strlen(text) - 1000 AS e FROM documents))",
    log=False,
)
def _(spark, sf):
    d = _read(spark, sf, "documents").select("doc_id", F.struct("doc_id", "text").alias("after"))
    return R.enforce_size(d, 1000, images=("after",)).select("doc_id", F.length("after.text").cast("long").alias("n"), F.md5(F.col("after.text").cast("binary")).alias("md5"))


@query("vectors_json", "SELECT vec_id, i AS place, round(CAST(embedding[i + 1] AS DOUBLE), 6) AS value FROM embeddings, unnest(range(len(embedding))) AS r(i)", log=False)
def _(spark, sf):
    text = R.dense_vector_json(F.col("embedding"))
    d = _read(spark, sf, "embeddings").select("vec_id", F.posexplode(F.from_json(text, "values array<float>")["values"]).alias("place", "value"))
    return d.select("vec_id", F.col("place").cast("long").alias("place"), F.round(F.col("value").cast("double"), 6).alias("value"))


@query(
    "cloud_events",
    "SELECT seq, 'name:shop;lsn:' || (seq * 8) AS id, '/cdc/shop/srv' AS source, '1.0' AS specversion, 'io.cdc.connector.shop.DataChangeEvent' AS type, strftime(epoch_ms(ts_ms - seq % 97), '%Y-%m-%dT%H:%M:%S.%gZ') AS time, 'application/json' AS datacontenttype, "
    "op, 'orders' AS tbl, CAST(seq * 8 AS VARCHAR) AS lsn, b_key AS old_key, a_key AS key, a_status AS status, a_price AS price, a_cust AS cust FROM changelog WHERE tbl = 'orders'",
)
def _(spark, sf):
    image = "struct<key:long,status:string,price:long,cust:long>"
    v = F.from_json("value", f"id string, source string, specversion string, type string, time string, datacontenttype string, iocdcop string, iocdctable string, iocdclsn string, data struct<before:{image},after:{image}>")
    d = R.cloud_events(order_log(spark, sf)).select("seq", v.alias("v"))
    named = [F.col(f"v.{c}").alias(n) for c, n in (("iocdcop", "op"), ("iocdctable", "tbl"), ("iocdclsn", "lsn"), ("data.before.key", "old_key"))]
    return d.select("seq", *[f"v.{c}" for c in ("id", "source", "specversion", "type", "time", "datacontenttype")], *named, "v.data.after.*")


# Documents of orders: created whole, then changed by parts.  Each line is a kind of update: which keys it concerns, its place in a key's
# events, and JSON of what it sets, paths that it removes, arrays that it cuts.
_DOCUMENT = """'{"id":' || k || ',"s":"' || s || '","cust":{"id":' || c || ',"price":' || p || ',"seg":null},"tags":["a","b",{"t":' || p || '},"d"]}'"""
_UPDATES = [
    (1, "k % 3 = 0", """'{"cust.price":' || (p + 1) || ',"cust.seg":"U"}'""", [], None),
    (2, "k % 5 = 0", "NULL", ["cust.seg", "s"], None),
    (3, "k % 7 = 0", """'{"cust":{"id":5},"n":{"x":[1,[2]]}}'""", [], None),
    (4, "k % 11 = 0", "NULL", [], ("tags", 1)),
    (5, "k % 13 = 0", """'{"tags.0":null,"n.y":' || p || '}'""", ["cust"], None),
    (6, "k % 11 = 0 AND k % 2 = 0", """'{"tags.1":"late"}'""", [], None),
    (8, "k % 34 = 0", """'{"cust.id":9}'""", [], None),
]


@query(
    "document_state",
    f"WITH {_DOCS} SELECT CAST(k * 10 AS BIGINT) AS seq, 'c' AS op, CAST(k AS BIGINT) AS id, s, CAST(c AS BIGINT) AS cust_id, CAST(p AS BIGINT) AS cust_price, 'id,s,cust_id,cust_price' AS mentioned FROM o "
    "UNION ALL SELECT k * 10 + 1, 'u', NULL, NULL, NULL, p + 1, 'cust_price' FROM o WHERE k % 3 = 0 UNION ALL SELECT k * 10 + 2, 'u', NULL, NULL, NULL, NULL, 's' FROM o WHERE k % 5 = 0 "
    "UNION ALL SELECT k * 10 + 3, 'u', NULL, NULL, 5, NULL, 'cust_id,cust_price' FROM o WHERE k % 7 = 0",
    log=False,
)
def _(spark, sf):
    out = R.document_state(document_log(spark, sf).where("seq % 10 < 4"), "id long, s string, cust struct<id:long,price:long>", "_")
    return out.withColumn("mentioned", F.array_join("mentioned", ","))


def document_log(spark, sf):
    """The events of these documents: key ``k``, ``seq``, ``op``, ``after``, and what updates say."""
    o = _read(spark, sf, "orders").selectExpr("o_orderkey AS k", "o_orderstatus AS s", "CAST(round(o_totalprice * 100) AS BIGINT) AS p", "CAST(o_custkey AS BIGINT) AS c")

    def event(n, op, where="true", after="NULL", sets="NULL", gone=(), cut=None):
        paths = F.array(*map(F.lit, gone)).cast("array<string>")
        cuts = F.array(F.struct(F.lit(cut[0]).alias("field"), F.lit(cut[1]).alias("size"))) if cut else F.lit(None).cast("array<struct<field:string,size:int>>")
        text = lambda x: F.expr(f"CAST({x} AS STRING)")
        return o.where(where).select(F.col("k").cast("long"), (F.col("k") * 10 + n).cast("long").alias("seq"), F.lit(op).alias("op"), text(after).alias("after"), text(sets).alias("updated_fields"), paths.alias("removed_fields"), cuts.alias("truncated_arrays"))

    out = event(0, "c", after=_DOCUMENT).unionByName(event(7, "d", "k % 17 = 0"))
    for n, where, sets, gone, cut in _UPDATES:
        out = out.unionByName(event(n, "u", where, "NULL", sets, gone, cut))
    return out


#: By the definition: a node stands if no later event voids its path or one above it (or cuts its array before it).
_NODES = "w AS (" + " UNION ALL ".join(
    f"SELECT k, {n} AS n, '{path}' AS path, CAST({value} AS VARCHAR) AS value FROM o WHERE {where}"
    for n, where, nodes in [
        (0, "true", {"": "'{}'", "id": "k", "s": "'\"' || s || '\"'", "cust": "'{}'", "cust.id": "c", "cust.price": "p", "cust.seg": "'null'", "tags": "'[]'", "tags.0": "'\"a\"'", "tags.1": "'\"b\"'", "tags.2": "'{}'", "tags.2.t": "p", "tags.3": "'\"d\"'"}),
        (1, "k % 3 = 0", {"cust.price": "p + 1", "cust.seg": "'\"U\"'"}),
        (3, "k % 7 = 0", {"cust": "'{}'", "cust.id": "5", "n": "'{}'", "n.x": "'[]'", "n.x.0": "1", "n.x.1": "'[]'", "n.x.1.0": "2"}),
        (5, "k % 13 = 0", {"tags.0": "'null'", "n.y": "p"}),
        (5, "k % 13 = 0 AND k % 7 <> 0", {"n": "'{}'"}),
        (6, "k % 11 = 0 AND k % 2 = 0", {"tags.1": "'\"late\"'"}),
        (8, "k % 34 = 0", {"cust.id": "9", "cust": "'{}'", "": "'{}'"}),
    ]
    for path, value in nodes.items()
) + "), v AS (" + " UNION ALL ".join(
    f"SELECT k, {n} AS n, '{path}' AS path FROM o WHERE {where}"
    for n, where, paths in [(1, "k % 3 = 0", ["cust.price", "cust.seg"]), (2, "k % 5 = 0", ["cust.seg", "s"]), (3, "k % 7 = 0", ["cust", "n"]), (4, "k % 11 = 0", ["tags.1", "tags.2", "tags.3"]), (5, "k % 13 = 0", ["cust", "tags.0", "n.y"]), (6, "k % 22 = 0", ["tags.1"]), (7, "k % 17 = 0", [""]), (8, "k % 34 = 0", ["cust.id"])]
    for path in paths
) + "), a AS (SELECT * FROM w WHERE NOT EXISTS (SELECT 1 FROM v WHERE v.k = w.k AND v.n > w.n AND (v.path = '' OR w.path = v.path OR starts_with(w.path, v.path || '.'))))"


_STANDING = f"WITH {_DOCS}, {_NODES}, f AS (SELECT CAST(k AS BIGINT) AS k, path, value FROM (SELECT *, row_number() OVER (PARTITION BY k, path ORDER BY n DESC) AS r FROM a) WHERE r = 1) "


@query("fold_document_paths", _STANDING + "SELECT k, path, value FROM f", log=False)
def _(spark, sf):
    return D.folded(document_log(spark, sf), ["k"]).select("k", F.array_join("path", ".").alias("path"), "value")


_ONE = lambda path: f"max(CASE WHEN path = '{path}' AND value <> 'null' THEN trim(value, '\"') END)"


@query(
    "fold_documents",
    _STANDING + f"SELECT k, CAST({_ONE('id')} AS BIGINT) AS id, {_ONE('s')} AS s, CAST({_ONE('cust.id')} AS BIGINT) AS cust, {_ONE('cust.seg')} AS seg, {_ONE('tags.0')} AS tag, "
    "CASE WHEN max(path = 'tags') THEN CAST(count(CASE WHEN regexp_full_match(path, 'tags\\.[0-9]+') THEN 1 END) AS INTEGER) END AS tags FROM f GROUP BY k",
    log=False,
)
def _(spark, sf):
    d = D.current(document_log(spark, sf), ["k"], "id long, s string, cust struct<id:long,seg:string>, tags array<string>", depth=3)
    return d.select("k", "id", "s", F.col("cust.id").alias("cust"), "cust.seg", F.get("tags", F.lit(0)).alias("tag"), F.when(F.col("tags").isNotNull(), F.size("tags")).alias("n")).withColumnRenamed("n", "tags")


_IMAGES = (
    """'{"id":' || k || ',"s":"' || s || '","n":{"p":' || p || ',"c":null},"t":[1,' || c || ']}' AS before""",
    """CASE WHEN k % 7 <> 0 THEN '{"id":' || k || CASE WHEN k % 2 = 0 THEN '' ELSE ',"s":"' || s || '"' END || ',"n":' || CASE WHEN k % 3 = 0 THEN '"gone"' ELSE '{"p":' || (p + k % 5) || ',"c":null,"x":{"y":1}}' END || ',"t":[1' || CASE WHEN k % 4 = 0 THEN '' ELSE ',' || c END || ']}' END AS after""",
)
_CHANGED = {  # path: where it changes, what it was, what it is
    "": ("k % 7 = 0", "'{}'", "NULL"), "id": ("k % 7 = 0", "k", "NULL"), "s": ("k % 2 = 0 OR k % 7 = 0", "'\"' || s || '\"'", "NULL"), "t": ("k % 7 = 0", "'[]'", "NULL"), "t.0": ("k % 7 = 0", "1", "NULL"), "t.1": ("k % 4 = 0 OR k % 7 = 0", "c", "NULL"),
    "n": ("k % 3 = 0 OR k % 7 = 0", "'{}'", "CASE WHEN k % 7 <> 0 THEN '\"gone\"' END"), "n.p": ("k % 3 = 0 OR k % 7 = 0 OR k % 5 > 0", "p", "CASE WHEN k % 3 <> 0 AND k % 7 <> 0 THEN p + k % 5 END"),
    "n.c": ("k % 3 = 0 OR k % 7 = 0", "'null'", "NULL"), "n.x": ("k % 3 <> 0 AND k % 7 <> 0", "NULL", "'{}'"), "n.x.y": ("k % 3 <> 0 AND k % 7 <> 0", "NULL", "1"),
}


@query(
    "document_differences",
    f"WITH {_DOCS}, d AS (" + " UNION ALL ".join(f"SELECT CAST(k AS BIGINT) AS k, '{path}' AS path, CAST({old} AS VARCHAR) AS old, CAST({new} AS VARCHAR) AS new FROM o WHERE {where}" for path, (where, old, new) in _CHANGED.items())
    + ") SELECT k, path, CASE WHEN old IS NULL THEN 'add' WHEN new IS NULL THEN 'remove' ELSE 'replace' END AS kind, old, new FROM d",
    log=False,
)
def _(spark, sf):
    o = _read(spark, sf, "orders").selectExpr("o_orderkey AS k", "o_orderstatus AS s", "CAST(round(o_totalprice * 100) AS BIGINT) AS p", "CAST(o_custkey AS BIGINT) AS c")
    return D.differences(o.selectExpr("CAST(k AS BIGINT) AS k", *_IMAGES), ["k"]).select("k", F.array_join("path", ".").alias("path"), "kind", "old", "new")


@query(
    "unchanged_values",
    "SELECT seq, a_key AS key, last_value(price IGNORE NULLS) OVER w AS price, last_value(cust IGNORE NULLS) OVER w AS cust FROM (SELECT *, CASE WHEN op <> 'u' OR a_price <> b_price THEN CAST(a_price AS VARCHAR) END AS price, CASE WHEN op <> 'u' THEN CAST(a_cust AS VARCHAR) END AS cust FROM changelog WHERE tbl = 'orders' AND op <> 'd') "
    "WINDOW w AS (PARTITION BY seq // 10 ORDER BY seq ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)",
)
def _(spark, sf):
    """Updates that hold only what changed; a row's history goes on when its key changes."""
    left_out = lambda c, told: F.when(told, F.col(f"a_{c}").cast("string")).otherwise("__unchanged").alias(c)
    whole = F.col("op") != "u"
    d = flat_changelog(spark, sf).where("tbl = 'orders' and op <> 'd'").select("seq", F.col("a_key").alias("key"), F.col("b_key").alias("was"), left_out("price", whole | (F.col("a_price") != F.col("b_price"))), left_out("cust", whole))
    return K.filled(d, ["key"], ["price", "cust"], "__unchanged", {"key": "was"}).drop("was")


_SETS = "SELECT c AS chunk_id, 's0:1-' || (c * 40 + 5) || ',s1:1-' || (c * 37 + 9) || CASE WHEN c % 3 = 0 THEN '' ELSE ',s2:1-' || (c * 41 + 1) END AS low_set, 's0:1-' || (c * 40 + 5 + CASE WHEN c % 5 = 4 THEN 0 ELSE 30 END) || ',s1:1-' || (c * 37 + 9 + CASE WHEN c % 5 = 4 THEN 0 ELSE c % 7 END) || ',s2:1-' || (c * 41 + CASE WHEN c % 5 = 4 AND c % 3 <> 0 THEN 1 ELSE 22 END) AS high_set"


@query(
    "gtid_windows",
    f"WITH {LOG}, e AS (SELECT 's' || (tx_id % 3) AS server, tx_id // 3 + 1 AS number, seq FROM changelog), m AS ({_SETS} FROM (SELECT DISTINCT o_orderkey // 500 AS c FROM orders)), "
    "x AS (SELECT chunk_id, side, split_part(s, ':1-', 1) AS server, CAST(split_part(s, ':1-', 2) AS BIGINT) AS n FROM (SELECT chunk_id, 'low' AS side, unnest(string_split(low_set, ',')) AS s FROM m UNION ALL SELECT chunk_id, 'high', unnest(string_split(high_set, ',')) FROM m)), "
    "b AS (SELECT h.chunk_id, h.server, h.n AS hi, coalesce(l.n, 0) AS lo FROM x h LEFT JOIN x l ON l.side = 'low' AND l.chunk_id = h.chunk_id AND l.server = h.server WHERE h.side = 'high'), "
    "t AS (SELECT server, number, min(m) OVER (PARTITION BY server ORDER BY number DESC) AS at_or_behind FROM (SELECT server, number, min(seq) AS m FROM e GROUP BY server, number)), "
    "p AS (SELECT b.*, (SELECT at_or_behind FROM t WHERE t.server = b.server AND t.number >= b.lo + 1 ORDER BY t.number LIMIT 1) AS opens, (SELECT at_or_behind FROM t WHERE t.server = b.server AND t.number >= b.hi ORDER BY t.number LIMIT 1) AS closes FROM b) "
    "SELECT CAST(chunk_id AS BIGINT) AS chunk_id, min(opens) - 1 AS low, coalesce(max(CASE WHEN hi > lo THEN closes END), min(opens) - 1) AS high FROM p GROUP BY 1 HAVING count(CASE WHEN hi > lo AND closes IS NULL THEN 1 END) = 0 AND coalesce(max(CASE WHEN hi > lo THEN closes END), min(opens) - 1) IS NOT NULL",
    log=False,
)
def _(spark, sf):
    """Windows of chunks by sets of transactions of three servers, of which one joins late and some stand still."""
    e = flat_changelog(spark, sf).select(F.concat(F.lit("s"), (F.col("tx_id") % 3).cast("string")).alias("server"), (F.floor(F.col("tx_id") / 3) + 1).alias("number"), "seq")
    marks = _read(spark, sf, "orders").select(F.floor(F.col("o_orderkey") / 500).alias("c")).distinct().selectExpr(*_SETS.removeprefix("SELECT ").replace(" AS chunk_id, ", " AS chunk_id\n").replace(" AS low_set, ", " AS low_set\n").split("\n"))
    return N.windows_from_gtids(marks, e).select(F.col("chunk_id").cast("long").alias("chunk_id"), "low", "high")


@query("swap_points")
def _(spark, sf):
    c = _read(spark, sf, "customer").select("c_custkey", R.point_wkb(F.col("c_acctbal"), F.col("c_nationkey").cast("double")).alias("p"))
    return c.select("c_custkey", F.hex(R.swap_point(F.col("p"))).alias("swapped"))


@query(
    "embed_text",
    "WITH w AS (SELECT item_id, unnest(regexp_split_to_array(lower(text), '\\W+')) AS w FROM benchmark), c AS (SELECT item_id, CAST('0x' || substr(md5(w), 1, 8) AS BIGINT) % 16 AS slot, count(*) AS n FROM w WHERE w <> '' GROUP BY ALL), "
    "s AS (SELECT item_id, unnest(range(16)) AS slot FROM benchmark), g AS (SELECT s.item_id, s.slot, coalesce(n, 0) AS n FROM s LEFT JOIN c ON s.item_id = c.item_id AND s.slot = c.slot), "
    "l AS (SELECT item_id, sqrt(sum(n * n)) AS len FROM g GROUP BY 1) SELECT g.item_id, string_agg(CAST(CAST(round(CASE WHEN len > 0 THEN n / len ELSE 0 END * 10000) AS BIGINT) AS VARCHAR), ',' ORDER BY slot) AS v FROM g JOIN l USING (item_id) GROUP BY 1",
    log=False,
)
def _(spark, sf):
    return R.embed(_read(spark, sf, "benchmark"), "text").select("item_id", F.array_join(F.transform("embedding", lambda x: F.round(x.cast("double") * 10000).cast("long").cast("string")), ",").alias("v"))


@query("page_plain_text", "SELECT page_id, trim(regexp_replace(regexp_replace(regexp_replace(html, '(?is)<script\\b.*?</script>|<style\\b.*?</style>', ' ', 'g'), '(?s)<[^>]*>', ' ', 'g'), '\\s+', ' ', 'g')) AS text FROM pages", log=False)
def _(spark, sf):
    return _read(spark, sf, "pages").select("page_id", R.plain_text(F.col("html")).alias("text"))


@query("select_fields", "SELECT o_orderkey, 'inner' AS left_over, o_orderstatus AS state, CAST(o_custkey AS BIGINT) AS cust FROM orders", log=False)
def _(spark, sf):
    inner = F.struct(F.col("o_orderstatus").alias("status"), F.col("o_custkey").cast("long").alias("cust"))
    o = _read(spark, sf, "orders").select("o_orderkey", F.struct(inner.alias("inner"), F.lit(1).alias("x")).alias("after"))
    d = R.select_fields(o, "after", exclude=["x"], rename={"inner.status": "state"})
    return d.select("o_orderkey", F.json_object_keys(F.to_json("after"))[0].alias("left_over"), "after.inner.state", "after.inner.cust")


@query("outbox_documents", "SELECT event_id AS seq, 'outbox.event.' || event_type AS topic, CAST(user_id AS VARCHAR) AS key, props AS value FROM events", log=False)
def _(spark, sf):
    body = F.to_json(F.struct(F.col("event_id").cast("string").alias("_id"), F.col("event_type").alias("aggregatetype"), F.col("user_id").cast("string").alias("aggregateid"), F.col("props").alias("payload")))
    e = _read(spark, sf, "events").select(F.col("event_id").alias("seq"), F.lit("c").alias("op"), body.alias("after"), F.lit(0).alias("ts_ms"))
    return G.outbox_documents(e, "_id string, aggregatetype string, aggregateid string, payload string", G.Outbox(event_id="_id")).select("seq", "topic", "key", "value")


# --- schemas and sinks ----------------------------------------------------------------------------

_HISTORY = "h AS (SELECT CAST(o_orderkey AS BIGINT) * 10 + 5 AS pos, CASE WHEN o_orderkey % 2 = 0 THEN 'orders' ELSE 'other' END AS tbl, o_orderkey % 3 = 0 AS gone FROM orders WHERE o_orderkey % 50 < 2)"


def _history(spark, sf):
    o = _read(spark, sf, "orders").where("o_orderkey % 50 < 2")
    k = F.col("o_orderkey").cast("long")
    return o.select((k * 10 + 5).alias("pos"), F.when(k % 2 == 0, "orders").otherwise("other").alias("tbl"), F.when(k % 3 == 0, "DROP").otherwise("ALTER").alias("type"), F.array(F.struct(F.col("o_orderstatus").alias("name"))).alias("columns"))


@query("schema_positions", f"WITH {LOG}, {_HISTORY}, e AS (SELECT tbl, seq FROM changelog) SELECT e.tbl, e.seq, h.pos AS schema_pos FROM e ASOF LEFT JOIN h ON e.tbl = h.tbl AND e.seq >= h.pos")
def _(spark, sf):
    return H.for_events(changelog(spark, sf), _history(spark, sf))


@query("schema_state", f"WITH {_HISTORY}, l AS (SELECT tbl, max(pos) AS since, arg_max(gone, pos) AS gone FROM h WHERE pos <= 40000 GROUP BY 1) SELECT tbl, since FROM l WHERE NOT gone", log=False)
def _(spark, sf):
    return H.at_position(_history(spark, sf), 40_000).select("tbl", "since")


@query("ddl_replay", "SELECT * FROM (VALUES ('c', 'id', 'INT', false), ('c', 'x', 'DECIMAL(10,2)', true), ('d', 'k', 'BIGINT', false)) t(tbl, name, type, optional)", log=False)
def _(spark, sf):
    ddl = ["CREATE TABLE a (id INT NOT NULL, name VARCHAR(20), PRIMARY KEY (id))", "ALTER TABLE a ADD COLUMN x DECIMAL(10, 2) AFTER id, DROP COLUMN name", "CREATE TABLE b LIKE a", "ALTER TABLE b RENAME TO c", "no statement", "DROP TABLE a", "CREATE TABLE d (k BIGINT PRIMARY KEY)"]
    tables, _ = H.replay(list(enumerate(ddl)))
    return spark.createDataFrame([(t, *c) for t, cs in tables.items() for c in cs], "tbl string, name string, type string, optional boolean")


@query("view_columns", "SELECT * FROM (VALUES ('id', 'bigint'), ('total', 'double'), ('n', 'bigint')) t(name, type)", log=False)
def _(spark, sf):
    found = H.view_columns(spark, "select q.id, sum(q.v) as total, count(*) as n from (select id, v from t1 join t2 using (id)) q group by q.id", {"t1": "id bigint, v double", "t2": "id bigint"})
    return spark.createDataFrame(found, "name string, type string")


@query("schema_change_filter", "SELECT o_orderkey FROM orders WHERE o_orderkey % 10 <> 0 AND o_orderkey % 3 <> 1 AND o_orderkey % 4 <> 3", log=False)
def _(spark, sf):
    k = F.col("o_orderkey")
    one = lambda t: F.array(F.struct(t.alias("type")))
    kinds = F.when(k % 3 == 1, "CREATE").when(k % 3 == 2, "ALTER").otherwise("DROP")
    changes = F.when(k % 10 == 0, None).when(k % 4 == 3, F.slice(one(kinds), 1, 0)).otherwise(one(kinds))
    return P.schema_changes(_read(spark, sf, "orders").select("o_orderkey", changes.alias("table_changes")), ["CREATE", "DATABASE"]).select("o_orderkey")


@query("sink_names", 'SELECT n_nationkey AS "X_nNationkey_Y", n_name AS "X_nName_Y", n_regionkey AS "X_nRegionkey_Y" FROM nation', log=False)
def _(spark, sf):
    return G.restyled(_read(spark, sf, "nation"), "camel_case", "X_", "_Y")


@query("sink_keys", "SELECT a_status AS status, a_cust AS cust, count(*) AS n FROM changelog WHERE tbl = 'orders' AND a_key IS NOT NULL GROUP BY ALL")
def _(spark, sf):
    d = order_log(spark, sf).where("after is not null")
    return d.groupBy(*[F.col(f"after.{k}").alias(k) for k in G.sink_key(d, "record_value", ["status", "cust", "none"])]).agg(F.count(F.lit(1)).alias("n"))


# --- snapshots beside the schema and other windows ---


@query(
    "read_only_windows",
    f"WITH {LOG}, f AS (SELECT tx_id + tx_id % 3 * 4 AS x, min(seq) AS p FROM changelog GROUP BY 1), m AS (SELECT DISTINCT CAST(floor(o_orderkey / 100) AS BIGINT) AS chunk_id FROM orders), "
    "l AS (SELECT chunk_id, min(p) - 1 AS low FROM m JOIN f ON x >= chunk_id * 25 GROUP BY 1), h AS (SELECT chunk_id, min(p) - 1 AS high FROM m JOIN f ON x > chunk_id * 25 + 15 GROUP BY 1) "
    "SELECT chunk_id, low, high FROM l JOIN h USING (chunk_id)",
)
def _(spark, sf):
    c = F.floor(F.col("o_orderkey") / 100)
    at = lambda n: F.col("chunk_id") * 25 + n
    marks = _read(spark, sf, "orders").select(c.alias("chunk_id")).distinct().select("chunk_id", at(0).alias("low_xmin"), at(5).alias("low_xmax"), at(15).alias("high_xmax"))
    events = flat_changelog(spark, sf).select("seq", (F.col("tx_id") + F.col("tx_id") % 3 * 4).alias("tx_id"))
    return N.windows_from_transactions(marks, events, width=1000).select("chunk_id", "low", "high")


_READS = "r AS (SELECT *, low + chunk_id % 3 * 200 AS high FROM (SELECT DISTINCT CAST(floor(o_orderkey / 100) AS BIGINT) AS chunk_id, floor(o_orderkey / 100)::BIGINT * 1000 + 200 AS low FROM orders))"


@query(
    "window_schema_changes",
    f"WITH {_HISTORY}, {_READS} SELECT chunk_id, low, high, EXISTS (SELECT 1 FROM h WHERE tbl = 'orders' AND pos > low AND pos <= high) AS reread FROM r",
)
def _(spark, sf):
    c = F.floor(F.col("o_orderkey") / 100)
    low = c * 1000 + 200
    reads = _read(spark, sf, "orders").select(c.alias("chunk_id"), F.lit("orders").alias("tbl"), low.alias("low"), (low + c % 3 * 200).alias("high")).distinct()
    return N.with_rereads(reads, _history(spark, sf)).select("chunk_id", "low", "high", "reread")


@query("row_id_chunks", "SELECT CAST(floor((r - 1) / 1000) AS BIGINT) AS chunk, count(*) AS n FROM (SELECT row_number() OVER () AS r FROM orders) GROUP BY 1", log=False)
def _(spark, sf):
    return C.with_row_id(_read(spark, sf, "orders"), 1000).groupBy(F.col("row_chunk").alias("chunk")).agg(F.count(F.lit(1)).alias("n"))


@query("handed_over_captures", "SELECT seq, tbl, CASE WHEN tbl = 'orders' AND seq >= 5000 THEN 'second' ELSE 'first' END AS capture, CASE WHEN tbl = 'orders' AND seq >= 5000 THEN 5000 ELSE 0 END AS schema_since FROM changelog")
def _(spark, sf):
    log = flat_changelog(spark, sf).select("seq", "tbl", F.col("seq").alias("lsn"))
    both = log.withColumn("capture", F.explode(F.when((F.col("tbl") == "orders") & (F.col("seq") >= 5000), F.array(F.lit("first"), F.lit("second"))).otherwise(F.array(F.lit("first")))))
    captures = spark.createDataFrame([("orders", "first", 0), ("orders", "second", 5000), ("customer", "first", 0)], "tbl string, capture string, start_lsn long")
    return T.handed_over(both, captures).select("seq", "tbl", "capture", "schema_since")


@query(
    "naming_strategies",
    "SELECT n_nationkey, 'srv.db.' || t AS d, 'srv.' || s || '.' || t AS s, 'all.' || t AS r, 'srv.' || s || '.' || replace(replace(n_name, '_', '_u005f'), ' ', '_u0020') AS u, 'srv.db.' || s || '.' || t AS p "
    "FROM (SELECT n_nationkey, n_name, regexp_replace(n_name, '[^A-Za-z0-9._-]', '_', 'g') AS t, 'r' || n_regionkey AS s FROM nation)",
    log=False,
)
def _(spark, sf):
    parts = F.lit("db"), F.concat(F.lit("r"), F.col("n_regionkey").cast("string")), F.col("n_name")
    by = lambda how, *more, **kw: G.named_topic(how, "srv", *parts, *more, **kw)
    names = by("default").alias("d"), by("schema").alias("s"), by("schema_regex", r"srv\..*?\.(.*)", "all.$1").alias("r"), by("schema_unicode").alias("u"), by("schema", partitions=True).alias("p")
    return _read(spark, sf, "nation").select("n_nationkey", *names)


# --- service ------------------------------------------------------------------------------------


@query("metrics", "SELECT tbl, op, count(*) AS n, max(seq) AS last_seq, max(seq % 97) AS max_lag_ms FROM changelog GROUP BY 1, 2")
def _(spark, sf):
    return V.metrics(changelog(spark, sf))


@query("lag_quantiles", "SELECT tbl, quantile_cont(seq % 97, 0.5)::DOUBLE AS p50, quantile_cont(seq % 97, 0.95)::DOUBLE AS p95, quantile_cont(seq % 97, 0.99)::DOUBLE AS p99 FROM changelog GROUP BY 1")
def _(spark, sf):
    return V.lag_quantiles(changelog(spark, sf), exact=True)


@query(
    "lag_sketch",
    f"WITH {LOG}, g AS (SELECT 1.01::DOUBLE / 0.99::DOUBLE AS gamma), b AS (SELECT tbl, CASE WHEN seq % 97 > 0 THEN ceil(ln(seq % 97) / ln(gamma)) END AS b, any_value(gamma) AS gamma, count(*) AS n FROM changelog, g GROUP BY 1, 2), "
    "c AS (SELECT *, sum(n) OVER (PARTITION BY tbl ORDER BY b NULLS FIRST) AS upto, sum(n) OVER (PARTITION BY tbl) AS total, coalesce(2 / (gamma + 1) * pow(gamma, b), 0) AS v FROM b) "
    "SELECT tbl, " + ", ".join(f"round(arg_min(v, CASE WHEN upto > {q}::DOUBLE * (total - 1) THEN upto END), 6) AS p{int(q * 100)}" for q in (0.5, 0.95, 0.99)) + " FROM c GROUP BY tbl",
)
def _(spark, sf):
    d = V.lag_sketch(changelog(spark, sf))
    return d.select("tbl", *[F.round(c, 6).alias(c) for c in d.columns[1:]])


@query("counters", "SELECT event_type AS counter, CAST(sum(CASE WHEN user_id % 3 > 0 THEN user_id % 3 ELSE 0 END) AS BIGINT) AS p, count(*) FILTER (WHERE user_id % 3 = 0) AS n, CAST(sum(CASE WHEN user_id % 3 > 0 THEN user_id % 3 ELSE -1 END) AS BIGINT) AS value FROM events GROUP BY 1", log=False)
def _(spark, sf):
    u = F.col("user_id") % 3
    return V.counters(_read(spark, sf, "events").select(F.col("event_type").alias("counter"), F.col("user_id").alias("node"), F.when(u > 0, u).otherwise(-1).alias("delta")))


@query("reselect_columns", "SELECT seq, CASE WHEN seq % 10 = 1 THEN o_orderstatus ELSE a_status END AS status FROM changelog LEFT JOIN orders ON a_key = o_orderkey WHERE tbl = 'orders' AND op IN ('c', 'u')")
def _(spark, sf):
    d = order_log(spark, sf).where("op in ('c', 'u')")
    d = d.withColumn("after", F.col("after").withField("status", F.when(F.col("seq") % 10 == 1, "__unavailable").otherwise(F.col("after.status"))))
    now = _read(spark, sf, "orders").select(F.col("o_orderkey").cast("long").alias("key"), F.col("o_orderstatus").alias("status"))
    return V.reselect(d, now, KEYS, ["status"]).select("seq", "after.status")


@query("signals", "SELECT 'event-' || event_id AS id, CASE WHEN event_id % 3 = 0 THEN 'stop-snapshot' WHEN event_id % 3 = 1 THEN 'execute-snapshot' ELSE 'nonsense' END AS type, event_id % 3 <> 2 AS known, 'db.' || event_type AS target, CASE WHEN event_id % 2 = 0 THEN 'BLOCKING' ELSE 'INCREMENTAL' END AS snapshot_type, 'k > ' || event_id AS filter, 'key' || (event_id % 5) AS surrogate_key FROM events", log=False)
def _(spark, sf):
    n, text = F.col("event_id"), lambda p, c: F.concat(F.lit(p), c.cast("string"))
    body = F.struct(F.array(text("db.", F.col("event_type"))).alias("data-collections"), F.when(n % 2 == 0, "BLOCKING").alias("type"), F.array(F.struct(F.lit("t").alias("data-collection"), text("k > ", n).alias("filter"))).alias("additional-conditions"), text("key", n % 5).alias("surrogate-key"))
    kind = F.when(n % 3 == 0, "stop-snapshot").when(n % 3 == 1, "execute-snapshot").otherwise("nonsense")
    rows = _read(spark, sf, "events").select(text("event-", n).alias("id"), kind.alias("type"), F.to_json(body).alias("data"))
    return V.parse_signals(rows).select("id", "type", "known", F.col("data_collections")[0].alias("target"), "snapshot_type", F.col("conditions")[0]["filter"].alias("filter"), "surrogate_key")


@query("notifications", "SELECT 'n-' || tbl AS id, 'Incremental Snapshot' AS aggregate_type, 'COMPLETED' AS type, CAST(count(*) AS VARCHAR) AS rows, max(ts_ms) AS timestamp FROM changelog GROUP BY tbl")
def _(spark, sf):
    p = changelog(spark, sf).groupBy("tbl").agg(F.count(F.lit(1)).alias("rows"), F.max("ts_ms").alias("ts_ms")).select(F.concat(F.lit("n-"), F.col("tbl")).alias("id"), "tbl", F.lit("COMPLETED").alias("status"), "rows", "ts_ms")
    return V.notifications(p).select("id", "aggregate_type", "type", F.col("additional_data")["total_rows_scanned"].alias("rows"), "timestamp")


@query("gtid_union", "SELECT CAST(c_nationkey AS VARCHAR) AS uuid, min(k) AS lo, max(k) AS hi FROM (SELECT c_nationkey, k, k - row_number() OVER (PARTITION BY c_nationkey ORDER BY k) AS g FROM (SELECT DISTINCT c_nationkey, CAST(floor(c_custkey / 40) AS BIGINT) AS k FROM customer)) GROUP BY c_nationkey, g", log=False)
def _(spark, sf):
    c = _read(spark, sf, "customer").select(F.concat_ws(":", F.col("c_nationkey").cast("string"), F.floor(F.col("c_custkey") / 40).cast("string")).alias("gtids"))
    return V.gtid_union(V.gtid_rows(c))


@query(
    "gtid_subtract",
    "SELECT CAST(c_nationkey AS VARCHAR) AS uuid, min(k) AS lo, max(k) AS hi FROM (SELECT c_nationkey, k, k - row_number() OVER (PARTITION BY c_nationkey ORDER BY k) AS g FROM (SELECT DISTINCT c_nationkey, CAST(floor(c_custkey / 40) AS BIGINT) AS k FROM customer) WHERE k % 5 <> 0) GROUP BY c_nationkey, g",
    log=False,
)
def _(spark, sf):
    k = F.floor(F.col("c_custkey") / 40)
    c = _read(spark, sf, "customer").select(F.concat_ws(":", F.col("c_nationkey").cast("string"), k.cast("string")).alias("gtids"), k.alias("k"))
    return V.gtid_subtract(V.gtid_rows(c), V.gtid_rows(c.where("k % 5 = 0")))


@query("redo_statements", "SELECT o_orderkey, 'u' AS op, 'ORDERS' AS \"table\", o_orderpriority AS p, CAST(o_orderkey AS VARCHAR) AS k FROM orders", log=False)
def _(spark, sf):
    o = _read(spark, sf, "orders")
    sql = F.format_string("update \"S\".\"ORDERS\" set \"P\" = '%s' where \"K\" = '%d' and \"S\" IS NULL;", "o_orderpriority", "o_orderkey")
    return V.redo_events(o.select("o_orderkey", sql.alias("sql_redo"))).select("o_orderkey", "op", "table", F.col("after")["P"].alias("p"), F.col("before")["K"].alias("k"))
