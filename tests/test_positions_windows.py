"""The reader by positions, and snapshot windows in a stream, over stops and restarts."""

import pytest
from pyspark.sql import functions as F

from changeloom.operators import snapshot as N
from changeloom.sources.positions import PositionReader
from changeloom.streaming import windows as W

ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def change_tables(spark, tmp_path):
    """Two change tables; position 50 is one large transaction over both."""
    rows = {"a": [(p, s, f"a{p}.{s}") for p in (3, 7, 50, 900) for s in range(40 if p == 50 else 2)], "b": [(p, 100 + s, f"b{p}.{s}") for p in (1, 7, 50, 5000) for s in range(25 if p == 50 else 3)]}
    out = {}
    for t, x in rows.items():
        spark.createDataFrame(x, "pos long, serial long, v string").repartition(3).write.parquet(str(tmp_path / t))
        out[t] = spark.read.parquet(str(tmp_path / t))
    return out, [(t, *r) for t, x in rows.items() for r in x]


@pytest.mark.parametrize("limits", [{"max_rows": 17}, {"max_rows": 1000, "max_bytes": 60, "size": "length(v)"}, {}])
def test_a_reader_that_stops_anywhere_reads_every_row_once(spark, tmp_path, limits):
    tables, want = change_tables(spark, tmp_path)
    reader = lambda: PositionReader(spark, tables, str(tmp_path / "ckpt"), **limits)
    got, sizes = {}, []

    def keep(batch, n):
        got[n] = sorted((r.tbl, r.pos, r.serial, r.v) for r in batch.collect())
        sizes.append(len(got[n]))

    def crash(batch, n):
        keep(batch, n)
        raise OSError("stopped")

    assert reader().run(keep, most=2) <= 2
    if limits:
        with pytest.raises(OSError):
            reader().step(crash)  # begun, not marked: read again between the same ends
        before = dict(got)
        reader().run(keep)
        assert got[2] == before[2]
    rows = [r for n in sorted(got) for r in got[n]]
    assert sorted(rows) == sorted(want) and len(got) == max(got) + 1
    order = [(p, s) for n in sorted(got) for p, s in sorted((r[1], r[2]) for r in got[n])]
    assert order == sorted(order)  # batches are ranges
    if "max_bytes" not in limits and limits:
        assert max(sizes) <= 17 and sum(n == 17 for n in sizes) >= 4 and any(p == 50 for p, _ in order)
    assert reader().run(keep) == 0
    spark.createDataFrame([(5001, 1, "late")], "pos long, serial long, v string").write.mode("append").parquet(str(tmp_path / "a"))
    tables["a"] = spark.read.parquet(str(tmp_path / "a"))
    assert reader().run(keep) == 1 and got[max(got)] == [("a", 5001, 1, "late")]


def test_position_filters_reach_the_scan(spark, tmp_path):
    tables, _ = change_tables(spark, tmp_path)
    spark.conf.set("spark.sql.maxMetadataStringLength", 1000)
    plan = PositionReader(spark, tables, str(tmp_path / "ckpt")).read([7, 1], [50, 3])._jdf.queryExecution().executedPlan().toString()
    spark.conf.unset("spark.sql.maxMetadataStringLength")
    assert "GreaterThanOrEqual(pos,7)" in plan and "LessThanOrEqual(pos,50)" in plan


def test_open_windows_in_a_stream_equal_the_batch(spark, tmp_path):
    image = lambda k, v: (k, v)
    kind = "seq long, tbl string, op string, before struct<key:long,v:string>, after struct<key:long,v:string>"
    events = [(s, "t", "d" if s % 7 == 0 else "u", image(s * 5 % 60, "o"), None if s % 7 == 0 else image(s * 5 % 60, f"e{s}")) for s in range(1, 90)] + [(200, "other", "u", None, image(1, "x"))]
    spans = {1: (10, 40), 2: (20, 70), 3: (45, 60)}  # three windows that overlap
    chunks = [(c, low, "t", k, image(k, f"s{k}")) for c, (low, _) in spans.items() for k in range(20 * (c - 1), 20 * c)]
    ev, ch = spark.createDataFrame(events, kind), spark.createDataFrame(chunks, "chunk_id long, low long, tbl string, key long, after struct<key:long,v:string>")
    marks = spark.createDataFrame([(c, "t", t, s) for c, x in spans.items() for t, s in zip(("open", "close"), x)], "chunk_id long, tbl string, type string, seq long")
    rows = W.event_rows(ev, ["key"]).unionByName(W.chunk_rows(ch, ["key"])).unionByName(W.mark_rows(marks))
    # chunk rows come later than the events that follow their window's beginning
    arrives = F.col("seq") + F.when(F.col("kind") == W.CHUNK, 6).otherwise(0)
    src, out, ckpt = (str(tmp_path / x) for x in ("src", "out", "ckpt"))
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKS)
    try:
        for lo, hi in ((0, 13), (14, 30), (31, 52), (53, 65), (66, 300)):  # a restart between any two
            rows.where(arrives.between(lo, hi)).coalesce(1).write.mode("append").parquet(src)
            live = spark.readStream.schema(rows.schema).parquet(src)
            W.deduplicated(live, 3).writeStream.format("parquet").option("checkpointLocation", ckpt).trigger(availableNow=True).start(out).awaitTermination()
    finally:
        spark.conf.unset("spark.sql.streaming.stateStore.providerClass")
    spans_df = spark.createDataFrame([(c, *x) for c, x in spans.items()], "chunk_id long, low long, high long")
    want = N.deduplicated(ch.drop("low"), spans_df, ev, ["key"])
    cell = lambda d: sorted(map(str, d.collect()))
    got = spark.read.parquet(out)
    assert cell(got.select("seq", "sub", "tbl", "op", F.get_json_object("key", "$.key").cast("long").alias("key"), "after", "snapshot")) == cell(want.select("seq", "sub", "tbl", "op", "key", F.to_json("after").alias("after"), "snapshot"))
    assert 0 < got.where("snapshot = 'incremental'").count() < 60
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKS)
    try:  # a schema change voids the chunk in whose window it lies
        more = spark.createDataFrame([(4, "t", "open", 300), (None, "t", "schema", 310), (4, "t", "close", 320)], "chunk_id long, tbl string, type string, seq long")
        late = spark.createDataFrame([(4, 300, "t", 7, image(7, "s7"))], "chunk_id long, low long, tbl string, key long, after struct<key:long,v:string>")
        W.mark_rows(more).unionByName(W.chunk_rows(late, ["key"])).coalesce(1).write.mode("append").parquet(src)
        live = spark.readStream.schema(rows.schema).parquet(src)
        W.deduplicated(live, 3).writeStream.format("parquet").option("checkpointLocation", ckpt).trigger(availableNow=True).start(out).awaitTermination()
    finally:
        spark.conf.unset("spark.sql.streaming.stateStore.providerClass")
    assert [(r.chunk_id, r.snapshot) for r in spark.read.parquet(out).where("seq = 320").collect()] == [(4, "reread")]
