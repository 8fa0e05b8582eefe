"""Sinks: a table of buckets and databases, over crashes, replays and refused rows."""

import os
import sqlite3

import duckdb
import pytest

from changeloom.operators import materialize as M
from changeloom.sources import dialects as D
from changeloom.sources.buckets import BucketTable


def events(spark, rows, value="string"):
    """``(op, key, value)`` in order."""
    image = lambda k, v: (k, v)
    data = [(i, op, None if op == "c" else image(k, v), None if op == "d" else image(k, v)) for i, (op, k, v) in enumerate(rows)]
    kind = f"struct<key:long,v:{value}>"
    return spark.createDataFrame(data, f"seq long, op string, before {kind}, after {kind}")


def held(table):
    return sorted((r.key, r.v) for r in table.read().collect())


def size(path):
    return sum(os.path.getsize(os.path.join(d, f)) for d, _, names in os.walk(path) for f in names if f.endswith(".parquet"))


def test_only_touched_buckets_are_written(spark, tmp_path):
    table = BucketTable(spark, str(tmp_path / "t"), ["key"], buckets=40)
    text = "".join(chr(97 + i * i % 26) for i in range(300))
    assert table.apply(events(spark, [("c", k, text + str(k * 7919 % 1000)) for k in range(4000)]), 0)
    full = size(tmp_path / "t" / "data")
    written = 0
    for n in range(1, 9):
        before = table.manifest()["buckets"]
        assert table.apply(events(spark, [("u", n, "new"), ("d", 100 + n, ""), ("c", 9000 + n, "x")]), n)
        now = table.manifest()["buckets"]
        fresh = {w for b, w in now.items() if before.get(b) != w}
        assert sum(before.get(b) != w for b, w in now.items()) <= 3 and len(fresh) == 1
        written += size(tmp_path / "t" / "data" / fresh.pop())
    assert written < 8 * 5 / 40 * full  # three of 40 buckets a batch, and some to spare
    want = {k: text + str(k * 7919 % 1000) for k in range(4000)} | {n: "new" for n in range(1, 9)} | {9000 + n: "x" for n in range(1, 9)}
    assert held(table) == sorted((k, v) for k, v in want.items() if not 101 <= k <= 108)
    assert len(table.batches()) == 2 and len(os.listdir(tmp_path / "t" / "data")) <= 9
    some = table.read_keys(spark.createDataFrame([(1,), (101,), (9003,)], "key long")).collect()
    assert sorted(r.key for r in some) == [1, 9003]


def test_a_crash_before_the_manifest_and_a_replay_change_nothing(spark, tmp_path, monkeypatch):
    table = BucketTable(spark, str(tmp_path / "t"), ["key"], buckets=4)
    table.apply(events(spark, [("c", k, "a") for k in range(20)]), 0)
    batch = events(spark, [("u", 1, "b"), ("d", 2, ""), ("c", 30, "b")])
    publish = type(table.folder).publish
    monkeypatch.setattr(type(table.folder), "publish", lambda *a: (_ for _ in ()).throw(OSError("crash")))
    with pytest.raises(OSError):
        table.apply(batch, 1)
    assert held(table) == [(k, "a") for k in range(20)]
    monkeypatch.setattr(type(table.folder), "publish", publish)
    assert table.apply(batch, 1)
    after = held(table)
    assert after == sorted([(k, "a") for k in range(20) if k not in (1, 2)] + [(1, "b"), (30, "b")])
    assert not table.apply(batch, 1) and not table.apply(events(spark, [("d", 1, "")]), 0) and held(table) == after
    assert all(not n.startswith("0-") or n in table.manifest()["buckets"].values() or n in table.manifest(0)["buckets"].values() for n in os.listdir(tmp_path / "t" / "data"))
    assert len([n for n in os.listdir(tmp_path / "t" / "data") if n.startswith("1-")]) == 1  # the crashed attempt's folder is gone


def test_columns_that_come_later_and_buckets_that_empty(spark, tmp_path):
    table = BucketTable(spark, str(tmp_path / "t"), ["key"], buckets=3)
    assert table.read() is None
    table.apply(events(spark, [("c", k, "a") for k in range(9)]), 3)
    wide = spark.createDataFrame([(1, "u", None, (4, "b", 7)), (2, "d", (5, "a", None), None)], "seq long, op string, before struct<key:long,v:string,w:int>, after struct<key:long,v:string,w:int>")
    table.apply(wide, 5)
    assert sorted((r.key, r.v, r.w) for r in table.read().collect()) == sorted([(k, "a", None) for k in range(9) if k not in (4, 5)] + [(4, "b", 7)], key=str)
    table.apply(events(spark, [("d", k, "a") for k in range(9)]), 6)
    assert table.read().count() == 0 and table.read().columns == ["key", "v", "w"]
    table.apply(events(spark, [("c", 1, "z")]), 7)
    assert [tuple(r) for r in table.read().collect()] == [(1, "z", None)]
    assert M.materialize(events(spark, [("c", 1, "z")]), ["key"]).count() == 1


def test_refused_rows_are_found_and_set_aside(spark, tmp_path):
    path, letters = str(tmp_path / "s.db"), str(tmp_path / "dead")
    with sqlite3.connect(path) as db:
        db.execute("create table t (key integer primary key, v integer not null check (v < 100))")
    batch = events(spark, [("c", k, None if k == 7 else 100 + k if k in (3, 11) else k) for k in range(20)] + [("c", 50, 5), ("d", 50, 5)], "long").repartition(3)
    sink = D.database_sink(lambda: sqlite3.connect(path, timeout=60), "t", ["key"], ["key", "v"], "sqlite", rows_per_call=8, dead_letters=letters)
    for _ in range(2):  # a replay finds the same rows
        sink(batch, 4)
        with sqlite3.connect(path) as db:
            assert sorted(db.execute("select * from t").fetchall()) == [(k, k) for k in range(20) if k not in (3, 7, 11)]
        got = spark.read.parquet(letters).collect()
        assert sorted(r.key for r in got) == ['{"key": 11}', '{"key": 3}', '{"key": 7}'] and all("IntegrityError" in r.error and r.batch == 4 for r in got)
    with pytest.raises(Exception, match="IntegrityError"):
        D.database_sink(lambda: sqlite3.connect(path, timeout=60), "t", ["key"], ["key", "v"], "sqlite")(batch, 5)
    with pytest.raises(Exception, match="OperationalError"):  # not the rows' fault
        D.database_sink(lambda: sqlite3.connect(path, timeout=60), "missing", ["key"], ["key", "v"], "sqlite", dead_letters=letters)(batch, 6)


def test_column_arrays(spark, tmp_path):
    path, letters = str(tmp_path / "d.duckdb"), str(tmp_path / "dead")
    with duckdb.connect(path) as db:
        db.execute("create table t (key bigint primary key, v varchar check (v <> 'bad'))")
        db.execute("insert into t values (2, 'old'), (9, 'gone')")
    batch = events(spark, [("c", k, "bad" if k == 5 else None if k == 6 else f"v{k}") for k in range(8)] + [("d", 9, "gone")])
    sink = D.database_sink(lambda: duckdb.connect(path), "t", ["key"], ["key", "v"], "duckdb", rows_per_call=5, dead_letters=letters, connections=1)
    for _ in range(2):
        sink(batch, 0)
        with duckdb.connect(path) as db:
            assert sorted(db.execute("select * from t").fetchall(), key=str) == sorted([(k, None if k == 6 else f"v{k}") for k in range(8) if k != 5], key=str)
    assert [r.key for r in spark.read.parquet(letters).collect()] == ['{"key": 5}']
    assert "UNNEST(?::bigint[], ?::text[])" in D.unnest("t", ["key"], {"key": "bigint", "v": "string"})


def test_a_large_bucket_is_written_by_many_tasks(spark, tmp_path):
    conf = {"spark.sql.adaptive.coalescePartitions.enabled": "false", "spark.sql.adaptive.advisoryPartitionSizeInBytes": "8k"}
    was = {n: spark.conf.get(n) for n in conf}
    for n, v in conf.items():
        spark.conf.set(n, v)
    try:
        log = spark.range(20_000).selectExpr("id AS seq", "'c' AS op", "CAST(NULL AS STRUCT<key: BIGINT>) AS before", "named_struct('key', id) AS after")
        table = BucketTable(spark, str(tmp_path / "t"), ["key"], buckets=1)
        table.apply(log, 0)
        assert table.read().count() == 20_000 and table.read().distinct().count() == 20_000
        assert len(table.read().inputFiles()) > 1
    finally:
        for n, v in was.items():
            spark.conf.set(n, v)
