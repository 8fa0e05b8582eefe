"""Operators on literal rows: truth tables, traps and edges."""

import datetime
import hashlib
import sqlite3
import struct

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from changeloom.functions import scalars as S
from changeloom.operators import envelope as E
from changeloom.operators import filters as P
from changeloom.operators import history as H
from changeloom.operators import materialize as M
from changeloom.operators import records as R
from changeloom.operators import routing as G
from changeloom.operators import service as V
from changeloom.operators import snapshot as N
from changeloom.operators import transactions as T
from changeloom.sources import dialects as D
from changeloom.sources import readers as C

EVENT = "seq long, tbl string, op string, before struct<key:long,v:string>, after struct<key:long,v:string>, tx_id long, ts_ms long"


def events(spark, rows):
    """(op, key, value) or (op, old key, new key, value) in order."""
    out = []
    for i, r in enumerate(rows):
        op, *k = r
        old, new = (k[0], k[0]) if len(k) == 2 else k[:2]
        out.append((i, "t", op, None if op in "crt" else (old, "old"), None if op in "dt" else (new, k[-1]), i // 3, i))
    return spark.createDataFrame(out, EVENT)


def replay(rows):
    state = {}
    for r in rows:
        op, *k = r
        if op == "t":
            state.clear()
        elif op == "d":
            state.pop(k[0], None)
        else:
            if len(k) == 3:
                state.pop(k[0], None)
            state[k[-2]] = k[-1]
    return state


def materialized(spark, rows):
    d = M.after_truncates(E.split_key_changes(events(spark, rows), ["key"]))
    return {r.key: r.v for r in M.materialize(d, ["key"]).collect()}


def test_materialize_order_truncate_and_key_change(spark):
    rows = [("c", 1, "a"), ("c", 2, "b"), ("t", 0, ""), ("c", 1, "c"), ("u", 1, 9, "moved"), ("d", 2, ""), ("c", 2, "again"), ("u", 2, None)]
    assert materialized(spark, rows) == {9: "moved", 2: None}


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.one_of(st.tuples(st.just("c"), st.integers(0, 4), st.sampled_from("ab")), st.tuples(st.just("u"), st.integers(0, 4), st.integers(0, 4), st.sampled_from("xy")), st.tuples(st.just("d"), st.integers(0, 4), st.just("")), st.just(("t", 0, ""))), max_size=20))
def test_materialize_equals_replay(spark, rows):
    assert materialized(spark, rows) == replay(rows)


def test_apply_modes(spark):
    base = spark.createDataFrame([(1, "a"), (2, "b")], "key long, v string")
    log = events(spark, [("u", 1, None), ("c", 3, "n"), ("d", 2, ""), ("d", 77, "")])
    run = lambda **kw: {r.key: r.v for r in M.apply(base, log, ["key"], **kw).collect()}
    assert run() == {1: None, 2: "b", 3: "n"}
    assert run(delete_enabled=True) == {1: None, 3: "n"}
    assert run(mode="update") == {1: None, 2: "b"}
    with pytest.raises(Exception, match="key exists"):
        run(mode="insert")
    cut = events(spark, [("c", 5, "x"), ("t", 0, ""), ("c", 6, "y")])
    assert {r.key for r in M.apply(base, cut, ["key"], truncate_enabled=True).collect()} == {6}
    assert M.missing_columns(base, base.withColumn("w", F.lit(1)).withColumnRenamed("v", "V")) == ["w"]


def test_flatten_truth_table(spark):
    log = events(spark, [("c", 1, "a"), ("u", 1, "b"), ("d", 1, ""), ("t", 0, "")])
    got = {m: [(r.key, r.is_tombstone, r.asDict().get("__deleted")) for r in E.flatten(log, E.Flatten(m)).orderBy("seq", "is_tombstone").collect()] for m in E.DELETE_MODES}
    assert got["drop"] == [(1, False, None)] * 2
    assert got["tombstone"] == got["delete-to-tombstone"] == [(1, False, None), (1, False, None), (None, True, None)]
    assert got["rewrite"] == [(1, False, "false"), (1, False, "false"), (1, False, "true")]
    assert got["rewrite-with-tombstone"] == got["rewrite"] + [(None, True, None)]
    with pytest.raises(ValueError):
        E.flatten(log, E.Flatten("none"))


def test_filter_traps(spark):
    names = spark.createDataFrame([("a", "s", "t"), ("b", "s", "t"), ("a", "pg_catalog", "t"), ("a", "s", "signal")], "d string, s string, t string")
    keep = lambda **kw: [tuple(r) for r in names.where(P.Tables(**kw).predicate(F.col("d"), F.col("s"), F.col("t"))).collect()]
    assert keep(database_include="a", schema_include="S") == [("a", "s", "t"), ("b", "s", "t"), ("a", "s", "signal")]  # the database list doesn't count
    assert keep(table_include="A.s.t", table_exclude=".*") == [("a", "s", "t")]
    assert keep(table_include="none", signal_table="a.s.signal") == [("a", "s", "signal")]
    rows = spark.createDataFrame([(1, "x"), (2, None)], "k int, value string")
    assert [P.keep_where(rows, "k > 0", nulls=n).count() for n in ("keep", "drop", "evaluate")] == [2, 1, 2]
    assert P.message_key(names, "db.t", "db\\.t:s,missing;x:d", ["d"]) == ["s"] and P.listed(r"a\,b, c") == ["a,b", "c"]
    changes = spark.createDataFrame([(1, [("CREATE",)]), (2, []), (3, None)], "i int, table_changes array<struct<type:string>>")
    assert [r.i for r in P.schema_changes(changes, ["CREATE"]).collect()] == [2]


def test_transactions(spark):
    log = spark.createDataFrame([(i, "p", k, t) for i, (k, t) in enumerate([("row", 1), ("BEGIN", 2), ("row", 3), ("BEGIN", 4), ("row", 5), ("COMMIT", 6), ("BEGIN", 7), ("row", 8), ("ROLLBACK", 9), ("row", 10), ("BEGIN", 11), ("row", 12)])], "seq long, part string, kind string, n long")
    assert [(r.n, r.well_formed) for r in T.by_markers(log, "part").orderBy("seq").collect()] == [(1, True), (3, False), (5, True), (10, True)]
    e = spark.createDataFrame([(1, 1, 5), (2, 1, 5), (4, 1, 5), (5, 1, 6)], "seq long, tx_id long, row_id long")
    undo = spark.createDataFrame([(3, 1, 5)], "seq long, tx_id long, row_id long")
    assert sorted(r.seq for r in T.without_undone(e, undo, "row_id").collect()) == [1, 4, 5]
    lob = spark.createDataFrame([(1, 1, 7, "c", "a", "?"), (2, 1, 7, "u", "?", "big"), (3, 1, 7, "u", None, "?"), (4, 1, 8, "u", "z", "?")], "seq long, tx_id long, key long, op string, a string, lob string")
    got = {(r.key, r.seq): (r.op, r.a, r.lob) for r in T.merge_large_objects(lob, ["a", "lob"], ["lob"], "?").collect()}
    assert got[(7, 1)] == ("c", None, "big") and got[(8, 4)] == ("u", "z", "?")
    runs = spark.createDataFrame([(1, "p", 1), (2, "p", 1), (3, "p", 2), (4, "p", 1), (5, "p", None)], "seq long, part string, tx_id long")
    assert [r.run for r in T.runs(runs, "part").orderBy("seq").collect()] == [1, 1, 2, 3, 4]


def test_keyset_bounds_with_nulls(spark):
    d = spark.createDataFrame([(1, None), (1, 2), (2, None), (2, 1), (None, 5)], "a int, b int")
    got = [tuple(r) for r in d.where(N.after_key(["a", "b"], [1, None], {"a", "b"})).orderBy("a", "b").collect()]
    assert got == [(1, 2), (2, None), (2, 1)]
    pages, last = [], None
    rows = spark.range(0, 25).toDF("k")
    while chunk := [r.k for r in N.next_chunk(rows, ["k"], last, [24], 10).collect()]:
        pages += chunk
        last = [chunk[-1]]
    assert pages == list(range(25))
    assert N.chunk_count(1000, 100, 2, 3) == 6 and N.table_order({"a": 5, "b": None}, "ascending") == ["b", "a"]
    assert N.decide("initial", True, False) == (False, False, True) and N.decide("initial_only", False, False) == (True, True, False) and N.decide("when_needed", True, False, log_available=False)[0]


def test_java_hashes(spark):
    d = spark.createDataFrame([("hello", 2**40 + 7, -5), ("é", -1, 3), ("a" * 40, 0, 0)], "s string, l long, i int")

    def text(s):
        h = 0
        for ch in s:
            h = (h * 31 + ord(ch)) & 0xFFFFFFFF
        return h - (1 << 32) if h >= 1 << 31 else h

    for r in d.select("s", "l", "i", G.java_hash(F.col("s"), "string").alias("hs"), G.java_hash(F.col("l"), "bigint").alias("hl"), G.java_hash(F.col("i"), "int").alias("hi")).collect():
        x = (r.l ^ ((r.l & 0xFFFFFFFFFFFFFFFF) >> 32)) & 0xFFFFFFFF
        assert (r.hs, r.hl, r.hi) == (text(r.s), x - (1 << 32) if x >= 1 << 31 else x, r.i)
    assert [G.styled("someFieldName", s) for s in ("snake_case", "camel_case", "upper_case")] == ["some_field_name", "someFieldName", "SOMEFIELDNAME"]
    assert G.avro_name("1a-b") == "_1a_b"


def test_scalars(spark):
    one = lambda c: spark.range(1).select(c.alias("x")).first().x
    assert one(S.mask(3)) == "***" and one(S.unsigned(F.lit(-1), 64)) == 2**64 - 1
    assert bytes(one(S.bits(F.lit("0000000100000010"), 16))) == b"\x02\x01" and one(S.bits(F.lit("1"), 1)) is True
    ts = F.lit("2024-11-03 05:30:00").cast("timestamp")
    assert one(S.zoned(ts, "America/New_York")) == "2024-11-03T01:30:00-04:00" and one(S.zoned(ts)) == "2024-11-03T05:30:00Z"
    overlap = 1730597400000  # 01:30 on the wall, twice; the earlier offset counts
    assert one(S.shifted_epoch(F.lit(overlap), "America/New_York")) == overlap + 4 * 3600_000
    assert one(S.zero_date(F.lit("0000-00-00 00:00:00"))) is None and one(S.default_value("'it''s'", "string")) == "it's"
    assert one(S.hstore(F.lit('"a"=>"1", "b"=>NULL'))) == {"a": "1", "b": None}
    assert str(one(S.money(F.lit("($1,234.50)")))) == "-1234.50" and one(S.pg_array(F.lit("{a,NULL,b}"))) == ["a", None, "b"]
    d = S.with_source_types(spark.range(1), "t", [r"t\.id"], {"id": {"length": 8}})
    assert d.schema["id"].metadata["source.column.type"] == "BIGINT" and d.schema["id"].metadata["length"] == 8


def test_geometry_and_vectors(spark):
    line = struct.pack("<BIIdddd", 1, 2, 2, 1.0, 2.0, 3.0, 4.0)
    many = struct.pack(">BII", 0, 7, 1) + line
    assert R.walk_geometry(many, swap=True) == struct.pack(">BII", 0, 7, 1) + struct.pack("<BIIdddd", 1, 2, 2, 2.0, 1.0, 4.0, 3.0)
    ewkb = R.walk_geometry(line, srid=4326)
    assert struct.unpack_from("<BII", ewkb) == (1, 2 | 0x20000000, 4326) and R.walk_geometry(ewkb, strip=True) == line
    d = spark.createDataFrame([((bytearray(line), 4326),), (None,)], "g struct<wkb:binary,srid:int>")
    out = [r.g for r in R.rewrite_geometries(d, "g", (4326,), "ewkb").collect()]
    assert out[1] is None and struct.unpack_from("<d", bytes(out[0].wkb), 13)[0] == 2.0
    sparse = spark.sql("select named_struct('dimensions', 9S, 'vector', map(7S, 1.5D, 2S, 0.5D)) as v").select(R.sparse_vector_json(F.col("v")).alias("t"))
    assert sparse.first().t == '{ "dimensions": 9, "vector": { "2": 0.5, "7": 1.5 } }'


def test_history_and_ddl(spark, tmp_path):
    ddl = ["CREATE TABLE `a` (id INT NOT NULL, name VARCHAR(20), PRIMARY KEY (id))", "ALTER TABLE a ADD COLUMN x DECIMAL(10, 2) AFTER id, DROP COLUMN name", "CREATE TABLE b LIKE a", "ALTER TABLE b RENAME TO c", "nonsense", "DROP TABLE a"]
    tables, bad = H.replay(list(enumerate(ddl)))
    assert tables == {"c": [("id", "INT", False), ("x", "DECIMAL(10,2)", True)]} and bad == [4]
    H.append(spark, str(tmp_path / "h"), [(5, "t", "CREATE", "", [("id", "int", False)]), (9, "t", "ALTER", "", [("id", "int", False), ("v", "string", True)]), (12, "t", "DROP", "", [])])
    h = spark.read.parquet(str(tmp_path / "h"))
    assert len(H.at_position(h, 10).first()["columns"]) == 2 and H.at_position(h, 4).count() == 0 and H.at_position(h, 12).count() == 0
    e = spark.createDataFrame([("t", 5), ("t", 8), ("t", 11), ("u", 1)], "tbl string, seq long")
    assert {(r.tbl, r.seq): r.schema_pos for r in H.for_events(e, h).collect()} == {("t", 5): 5, ("t", 8): 5, ("t", 11): 9, ("u", 1): None}
    assert H.view_columns(spark, "select q.id, count(*) as n from (select id from t1) q group by q.id", {"t1": "id int, v string"}) == [("id", "int"), ("n", "bigint")]


def test_positions_redo_and_guards(spark):
    rows = lambda t: V.gtid_rows(spark.createDataFrame([(t,)], "gtids string"))
    assert [r.gtid for r in V.gtid_text(V.gtid_union(rows("A:1-5:7-9:6,b:3"))).orderBy("uuid").collect()] == ["a:1-9", "b:3"]
    assert [r.gtid for r in V.gtid_text(V.gtid_subtract(rows("a:1-10"), rows("a:3-4:10"))).collect()] == ["a:1-2:5-9"]
    assert V.parse_redo("""insert into "S"."T"("A","B") values ('it''s',TO_DATE('2020-01-01', 'YYYY-MM-DD'));""") == ("c", "S", "T", None, {"A": "it's", "B": "TO_DATE('2020-01-01', 'YYYY-MM-DD')"})
    assert V.parse_redo("""update "S"."T" set "A" = NULL where "A" = 'x' and "B" IS NULL;""") == ("u", "S", "T", {"A": "x", "B": None}, {"A": None, "B": None})
    assert V.parse_redo("""delete from "S"."T" where "A" = '1';""")[:3] == ("d", "S", "T") and V.parse_redo("commit") is None
    assert V.guard_tables(["a"], 1) is None and "limit" in V.guard_tables(["a", "b"], 1)
    with pytest.raises(ValueError):
        V.guard_tables(["a", "b"], 1, "fail")
    assert V.stale([{"endOffset": 1}, {"endOffset": 1}], 2) and not V.stale([{"endOffset": 1}], 2)
    seen = []
    signals = spark.createDataFrame([("1", "log", '{"message":"hi"}'), ("2", "other", None)], "id string, type string, data string")
    assert V.dispatch(signals, {"log": lambda r: seen.append(r.message)}) == 1 and seen == ["hi"]


def test_tombstones_outbox_and_batches(spark):
    log = events(spark, [("c", 1, "a"), ("c", 2, "b"), ("u", 1, "c"), ("t", 0, ""), ("c", 1, "d")])
    assert [r.batch for r in M.passthrough_batches(log, ["key"]).orderBy("seq").collect()] == [0, 0, 1, 2, 3]
    box = spark.sql("select 1L as seq, 'c' as op, named_struct('id', 'i', 'aggregatetype', 'Order', 'aggregateid', 'k', 'payload', ' ') as after, 5L as ts_ms")
    r = G.outbox(box, G.Outbox(tombstone_on_empty=True)).first()
    assert (r.topic, r.key, r.value, r.headers) == ("outbox.event.Order", "k", None, {"id": "i"})
    with pytest.raises(Exception, match="outbox"):
        G.outbox(box.withColumn("op", F.lit("u")), G.Outbox(on_update="fatal")).collect()


def test_large_objects_between_deletes(spark):
    rows = [(1, "c", "a", "?"), (2, "u", "?", "?"), (3, "u", None, "?"), (4, "d", "?", "?"), (5, "u", "b", "?"), (6, "u", "?", "big"), (7, "u", "z", "?"), (8, "u", "?", None)]
    lob = spark.createDataFrame([(s, 1, 7, *r) for s, *r in rows], "seq long, tx_id long, key long, op string, a string, lob string")
    got = [(r.seq, r.op, r.a, r.lob) for r in T.merge_large_objects(lob, ["a", "lob"], ["lob"], "?").orderBy("seq").collect()]
    assert got == [(1, "c", None, "?"), (4, "d", "?", "?"), (5, "u", "b", "big"), (7, "u", "z", None)]


def test_transaction_runs_and_buffers(spark):
    e = spark.createDataFrame([(1, "p", 1, "t"), (2, "p", 1, "u"), (3, "p", None, "t"), (4, "p", 1, "t"), (5, "p", 2, "t")], "seq long, part string, tx_id long, tbl string").withColumn("ts_ms", F.col("seq") * 10)
    got = sorted((r.seq, r.status, r.id, r.event_count, r.data_collections) for r in T.run_boundaries(e, "part").collect())
    assert got == [(1, "BEGIN", 1, None, None), (2, "END", 1, 2, "t=1,u=1"), (4, "BEGIN", 1, None, None), (4, "END", 1, 1, "t=1"), (5, "BEGIN", 2, None, None), (5, "END", 2, 1, "t=1")]
    assert sorted(r.tx_id for r in T.abandoned(e, 100, 55, 2).collect()) == [1] and T.abandoned(e, 100, 95).count() == 0
    ids = spark.createDataFrame([("aaaaaaaa01",), ("aaaaaaaa02",), ("bbbbbbbb01",), ("bbbbbbbb02",)], "tx_id string")
    back = spark.createDataFrame([("aaaaaaaaffffffff",), ("bbbbbbbb02",), (None,)], "tx_id string")
    assert [r.tx_id for r in T.without_rolled_back(ids, back).collect()] == ["bbbbbbbb01"]


def test_read_only_windows_and_rereads(spark):
    log = [(10, 7), (11, 5), (12, 9), (13, 6), (14, 12), (15, 8), (16, 20), (17, None)]
    e = spark.createDataFrame(log, "seq long, tx_id long")
    marks = [(0, 5, 6, 7), (1, 8, 12, 9), (2, 13, 13, 14), (3, 21, 22, 23), (4, 8, 12, 9), (5, 10, 19, 25)]
    want = set()
    for c, low, *most in marks:  # by the definition, event for event
        opened = [s for s, t in log if t is not None and t >= low]
        closed = [s for s, t in log if t is not None and t > max(most)]
        if closed:
            want.add((c, opened[0] - 1, closed[0] - 1))
    for width in (1, 4, 1000):
        got = N.windows_from_transactions(spark.createDataFrame(marks, "chunk_id int, low_xmin long, low_xmax long, high_xmax long"), e, width=width)
        assert {(r.chunk_id, r.low, r.high) for r in got.collect()} == want and got.count() == len(want) == 4
    assert N.windows_from_transactions(got.select("chunk_id", "low_xmin", "low_xmax", "high_xmax"), e.limit(0)).count() == 0
    reads = spark.createDataFrame([(1, "a", 1, 10, 20), (1, "a", 2, 20, 30), (1, "a", 3, 30, 40), (2, "b", 1, 10, 20), (3, "a", 1, 9, 20)], "chunk_id int, tbl string, attempt int, low long, high long")
    changes = spark.createDataFrame([("a", 20), ("a", 35), ("b", 10), ("c", 15)], "tbl string, pos long")
    assert sorted((r.chunk_id, r.attempt) for r in N.with_rereads(reads, changes).where("reread").collect()) == [(1, 1), (1, 3), (3, 1)]
    assert sorted((r.chunk_id, r.attempt) for r in N.valid_reads(reads, changes).collect()) == [(1, 2), (2, 1)]
    assert N.with_rereads(reads, changes.limit(0)).where("reread").count() == 0


def test_row_ids_and_topic_names(spark, tmp_path):
    spark.range(25).repartition(2).write.parquet(str(tmp_path / "t"))
    rows = C.with_row_id(C.table(spark, str(tmp_path / "t")), 10)
    at = rows.orderBy("row_file", "row_index").collect()
    rest = rows.where(N.after_key(["row_file", "row_index"], [at[9].row_file, at[9].row_index])).collect()
    assert sorted(r.id for r in rest) == sorted(r.id for r in at[10:]) and {r.row_chunk for r in at} == {0, 1}
    name = lambda *a, **k: spark.range(1).select(G.named_topic(a[0], "p", F.lit("c"), F.lit(None).cast("string"), F.lit("t é"), *a[1:], **k).alias("x")).first().x
    assert [name("default"), name("schema"), name("schema", partitions=True)] == ["p.c.t__", "p.t__", "p.c.t__"]
    assert [name("default_regex", "p.*", ""), name("default_regex", "c", "x"), name("default_regex", "(p).*", "$1.all")] == ["p.c.t__", "p.c.t__", "p.all"]
    with pytest.raises(ValueError):
        name("regex")


def test_statements_of_dialects():
    assert D.upsert("s.t", ["id"], ["id", "v"], "postgres") == 'INSERT INTO "s"."t" ("id", "v") VALUES (?, ?) ON CONFLICT ("id") DO UPDATE SET "v" = EXCLUDED."v"'
    assert D.upsert("t", ["id"], ["id"], "postgres").endswith('ON CONFLICT ("id") DO NOTHING')
    assert D.upsert("t", ["id"], ["id", "v"], "mysql") == "INSERT INTO `t` (`id`, `v`) VALUES (?, ?) ON DUPLICATE KEY UPDATE `v` = VALUES(`v`)"
    assert D.upsert("t", ["id"], ["id", "v"], "oracle") == 'MERGE INTO "t" t USING (SELECT ? AS "id", ? AS "v" FROM DUAL) s ON (t."id" = s."id") WHEN MATCHED THEN UPDATE SET t."v" = s."v" WHEN NOT MATCHED THEN INSERT ("id", "v") VALUES (s."id", s."v")'
    assert D.upsert("t", ["id"], ["id", "v"], "sqlserver").startswith("MERGE INTO [t] t") and D.upsert("t", ["id"], ["id"], "sqlserver").endswith("s.[id]);")
    assert D.unnest("t", ["id"], {"id": "bigint", "v": "string"}) == 'INSERT INTO "t" ("id", "v") SELECT * FROM UNNEST(?::bigint[], ?::text[]) ON CONFLICT ("id") DO UPDATE SET "v" = EXCLUDED."v"'
    assert D.update("t", ["id"], ["id", "v"], "db2") == 'UPDATE "t" SET "v" = ? WHERE "id" = ?' and D.delete("t", ["a", "b"], "mysql") == "DELETE FROM `t` WHERE `a` = ? AND `b` = ?"
    assert D.create("t", ["id"], {"id": "int", "v": "string"}, "mysql") == "CREATE TABLE `t` (`id` int NOT NULL, `v` longtext, PRIMARY KEY (`id`))"
    assert D.add_columns("t", {"a": "int", "b": "date"}, "oracle") == 'ALTER TABLE "t" ADD ("a" number(10,0), "b" date)' and D.add_columns("t", {"a": "int"}, "postgres") == 'ALTER TABLE "t" ADD COLUMN "a" integer'
    assert D.quoted('a"b', "db2") == '"a""b"'


def test_database_sink_applies_and_replays(spark, tmp_path):
    path = str(tmp_path / "sink.db")
    with sqlite3.connect(path) as db:
        db.execute(D.create("t", ["key"], {"key": "bigint", "v": "string"}, "sqlite"))
        db.execute(D.insert("t", ["key", "v"], "sqlite"), (9, "old"))
    write = D.database_sink(lambda: sqlite3.connect(path, timeout=60), "t", ["key"], ["key", "v"], "sqlite", rows_per_call=2)
    batch = events(spark, [("c", 1, "a"), ("c", 2, "b"), ("u", 1, "c"), ("d", 2, "b"), ("c", 9, "new"), ("c", 3, None), ("c", 4, "d"), ("c", 5, "e")]).repartition(2)
    for _ in range(2):
        write(batch, 0)
    with sqlite3.connect(path) as db:
        assert sorted(db.execute("select * from t").fetchall()) == [(1, "c"), (3, None), (4, "d"), (5, "e"), (9, "new")]


def test_texts_beyond_the_plain_ones(spark):
    one = lambda c: spark.range(1).select(c.alias("x")).first().x
    assert one(G.unicode_escaped(F.lit("a😀_é"))) == "a_ud83d_ude00_u005f_u00e9"
    want = 0
    for unit in (97, 0xD83D, 0xDE00, 98):
        want = (want * 31 + unit + (1 << 31)) % (1 << 32) - (1 << 31)
    assert one(G.java_hash(F.lit("a😀b"), "string")) == want and one(G.java_hash(F.lit(""), "string")) == 0
    assert [one(S.duration_iso(F.lit(us))) for us in (-500_000, -1_500_001, 0, 2_000_000)] == ["PT-0.500000S", "PT-1.500001S", "PT0.000000S", "PT2.000000S"]
    assert one(S.hstore(F.lit('"x, \\"y\\""=>"a\\\\b", "n"=>NULL, "m"=>"NULL", "e"=>""'))) == {'x, "y"': "a\\b", "n": None, "m": "NULL", "e": ""}
    assert one(S.pg_array(F.lit("{{1,2},{3,4}}"))) == ["{1,2}", "{3,4}"] and one(S.pg_array(F.lit('{{{1},{2}},{{"}{",NULL}}}'))) == ["{{1},{2}}", '{{"}{",NULL}}']
    assert one(F.transform(S.pg_array(F.lit('{{1,"a,b"},{NULL,4}}')), S.pg_array)) == [["1", "a,b"], [None, "4"]]
    assert [G.styled(n, "snake_case") for n in ("größe", "straßeÄÖ", "HTTPServer2x", "имяПоля", "a_b c")] == ["größe", "straße_äö", "http_server_2_x", "имя_поля", "a_b_c"]


def test_small_helpers(spark):
    one = lambda c: spark.range(1).select(c.alias("x")).first().x
    assert one(S.pg_array(F.lit('{a,"b, c","NULL",NULL,"d\\"e"}'))) == ["a", "b, c", "NULL", None, 'd"e'] and one(S.pg_array(F.lit("{}"))) == []
    assert tuple(one(S.pg_range(F.lit('["a, b",)')))) == ("a, b", None, True, False, False) and one(S.pg_range(F.lit("empty"))).empty
    long = "x" * 70_000
    want = hashlib.sha256(b"salt" + bytes.fromhex("ACED00057C") + len(long).to_bytes(8, "big") + long.encode()).hexdigest()
    assert one(S.hash_mask_v1(F.lit(long), "SHA-256", "salt")) == want
    with pytest.raises(Exception, match="plain form"):
        one(S.hash_mask_v1(F.lit("a😀"), "SHA-256", "salt"))
    assert C.chunk_predicates("k", ["it's"], datetime.date(2020, 1, 2)) == ["k < 'it''s'", "k >= 'it''s' AND k <= DATE '2020-01-02'"]
    assert [C.sql_literal(v) for v in (None, True, b"\x01", datetime.datetime(2020, 1, 1), 1.5)] == ["NULL", "TRUE", "X'01'", "TIMESTAMP '2020-01-01 00:00:00'", "1.5"]
    tries, waits = [], []
    fail = lambda: tries.append(1) or (_ for _ in ()).throw(OSError("no"))
    with pytest.raises(OSError):
        V.retried(fail, 2, lambda n: waits.append(V.backoff(0.001, 0.003)(n)) or 0, (OSError,))
    assert len(tries) == 3 and waits == [0.001, 0.002] and V.backoff(1, 3)(9) == 3
    rows = lambda t: V.gtid_rows(spark.createDataFrame([(t,)], "gtids string"))
    assert V.gtid_contains(rows("a:1-9,b:1"), rows("A:2-4:7")) and not V.gtid_contains(rows("a:1-9"), rows("a:8-10"))
    assert [r.uuid for r in V.gtid_retain(rows("a:1,b:2"), ["B"]).collect()] == ["b"]
    assert [N.decide("recovery", *x) for x in ((False, False), (True, False), (True, True))] == [(False, True, True)] * 3
    with pytest.raises(ValueError):
        N.decide("no such mode", True, False)
