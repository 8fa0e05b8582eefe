"""Queries cover all rows of tables that are larger than the smallest scale."""

import random
import re

import duckdb
import pandas as pd
import pytest
from pyspark.sql import functions as F

from changeloom.operators import materialize as M
from changeloom.operators import transactions as T
from changeloom.plans.catalog import ORACLE_SQL, QUERIES

KEYS = [*range(0, 120), *range(19_990, 20_010), *range(39_990, 40_010), 155_000]


@pytest.fixture(scope="module")
def large_keys(tmp_path_factory):
    """Few orders, whose keys go far beyond those of the smallest scale."""
    d = str(tmp_path_factory.mktemp("large_keys"))
    pd.DataFrame({"o_orderkey": KEYS, "o_custkey": 1, "o_orderstatus": "O", "o_totalprice": 1.0}).to_parquet(f"{d}/orders.parquet")
    pd.DataFrame({"c_custkey": [1], "c_mktsegment": "M", "c_acctbal": 1.0, "c_nationkey": 1}).to_parquet(f"{d}/customer.parquet")
    return d


def test_window_dedup_has_a_window_for_every_chunk(spark, large_keys):
    got = {r.key: r.seq for r in QUERIES["window_dedup"](spark, large_keys).where("snapshot = 'incremental'").collect()}
    # the window of chunk c is 4,000 c to 4,000 c + 3,000 and events of key k stand at 10 k: those of chunk 0 alone are inside
    assert got == {k: k // 100 * 4000 + 3000 for k in KEYS if k >= 100}


def test_passthrough_batches_reads_the_whole_log(spark, large_keys):
    got = {r.seq // 10 for r in QUERIES["passthrough_batches"](spark, large_keys).collect()}
    assert got == set(KEYS)


def in_order(rows, most):
    """Batches by one pass over all rows of a table."""
    batch, held, barrier, out = 0, set(), False, {}
    for seq, op, key in rows:
        if held and (key in held or op == "t" or barrier or (most and len(held) >= most)):
            batch, held = batch + 1, set()
        held.add(key)
        barrier, out[seq] = op == "t", batch
    return out


@pytest.mark.parametrize("most", [None, 1, 4, 9])
@pytest.mark.parametrize("keys", [6, 60, 10_000])
def test_passthrough_batches_in_pieces(spark, most, keys):
    rnd = random.Random(keys)
    rows = {t: [(7 * i, "t" if rnd.random() < 0.03 else "u", rnd.randrange(keys)) for i in range(n)] for t, n in (("a", 150), ("b", 40), (None, 90), ("c", 1))}
    rows = {t: [(s, op, None if op == "t" else k) for s, op, k in x] for t, x in rows.items()}
    image = lambda k: None if k is None else (k,)
    log = spark.createDataFrame([(s, t, op, None, image(k)) for t, x in rows.items() for s, op, k in x], "seq long, tbl string, op string, before struct<key:long>, after struct<key:long>").repartition(5)
    got = {}
    for r in M.passthrough_batches(log, ["key"], most=most, piece_rows=11, fan=3 if keys == 60 else 64).collect():
        got.setdefault(r.tbl, {})[r.seq] = r.batch
    assert got == {t: in_order(x, most) for t, x in rows.items()}


def test_events_of_one_capture_stay_in_many_tasks(spark):
    names = [f"spark.sql.{a}autoBroadcastJoinThreshold" for a in ("", "adaptive.")]
    was = {n: spark.conf.get(n, None) for n in names}
    for n in names:
        spark.conf.set(n, "-1")
    try:
        events = spark.range(1_000).repartition(5).select(F.lit("a").alias("tbl"), F.when(F.col("id") % 2 == 0, "x").otherwise("y").alias("capture"), F.col("id").alias("lsn"))
        captures = spark.createDataFrame([("a", "x", 0), ("a", "y", 600)], "tbl string, capture string, start_lsn long")
        got = T.handed_over(events, captures).withColumn("task", F.spark_partition_id()).collect()
    finally:
        for n, v in was.items():
            spark.conf.set(n, v) if v is not None else spark.conf.unset(n)
    assert sorted(r.lsn for r in got) == sorted([*range(0, 600, 2), *range(601, 1_000, 2)])
    assert len({r.task for r in got}) == 5


def test_large_objects_are_merged_by_one_sort(spark):
    rows = [(1, 1, 1, "u", "a", "?"), (1, 1, 2, "u", "?", None), (1, 1, 3, "d", "?", "?"), (1, 1, 4, "u", "?", "?"), (1, 1, 5, "u", "b", "?"), (1, 2, 1, "c", "a", "x"), (1, 2, 2, "u", None, "?"), (None, 2, 3, "u", "q", "z")]
    d = T.merge_large_objects(spark.createDataFrame(rows, "tx_id long, key long, seq long, op string, s string, lob string"), ["s", "lob"], ["lob"], "?")
    assert d._jdf.queryExecution().executedPlan().toString().count("Sort [") == 1
    want = [(1, 1, 1, "u", "a", None), (1, 1, 3, "d", "?", "?"), (1, 1, 4, "u", "?", "?"), (1, 1, 5, "u", "b", "?"), (1, 2, 1, "c", None, "x"), (None, 2, 3, "u", "q", "z")]
    assert sorted(map(tuple, d.collect()), key=str) == sorted(want, key=str)


def test_sql_of_passthrough_batches_reaches_every_position():
    # the ways of doubled length that lead from the first row reach as many batches as positions (BIGINT) can tell apart
    ways = {int(d) for d in re.findall(r"\bj(\d+) AS MATERIALIZED", ORACLE_SQL["passthrough_batches"])}
    assert sum(1 << d for d in ways) >= (1 << 63) - 1


def test_passthrough_batches_equal_their_sql(spark, large_keys):
    db = duckdb.connect()
    for t in ("orders", "customer"):
        db.execute(f"CREATE VIEW {t} AS SELECT * FROM '{large_keys}/{t}.parquet'")
    want = sorted(db.execute(ORACLE_SQL["passthrough_batches"]).fetchall())
    assert sorted(tuple(r) for r in QUERIES["passthrough_batches"](spark, large_keys).collect()) == want
