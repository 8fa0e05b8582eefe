"""Streams against batches, with stops and restarts."""

from pyspark.sql import functions as F

from changeloom.operators import envelope as E
from changeloom.operators import materialize as M
from changeloom.plans.changelog import order_log
from changeloom.sources import readers
from changeloom.streaming import stateful

DATA = "/root/testdata/sf0.001"


def test_table_kept_current_over_a_restart(spark, tmp_path):
    log = E.split_key_changes(order_log(spark, DATA), ["key"]).drop("headers")
    half = log.agg(F.expr("percentile(seq, 0.5)")).first()[0]
    src, out, ckpt = (str(tmp_path / x) for x in ("src", "out", "ckpt"))
    log.where(F.col("seq") <= half).coalesce(1).write.parquet(src)
    for more in (None, log.where(F.col("seq") > half)):
        if more is not None:
            more.coalesce(1).write.mode("append").parquet(src)
        stateful.keep_current(readers.stream(spark, src, log.schema), ["key"], out, ckpt, spark).awaitTermination()
    assert len(readers.versions(spark, out)) == 2
    want = M.materialize(log, ["key"])
    got = readers.current(spark, out).select(*want.columns)
    assert got.count() == want.count() and got.exceptAll(want).isEmpty()


def run(df, tmp_path, name, spark):
    q = df.writeStream.format("memory").queryName(name).outputMode("append").option("checkpointLocation", str(tmp_path / name)).trigger(once=True).start()
    q.awaitTermination()
    return spark.table(name)


def test_stateful_numbers_and_commit_buffer(spark, tmp_path):
    rows = [(1, 10, "event", "a"), (2, 11, "event", "b"), (1, 12, "event", "c"), (2, 13, "rollback", None), (1, 14, "commit", None), (3, 15, "event", "open")]
    spark.createDataFrame(rows, "tx_id long, seq long, kind string, payload string").coalesce(1).write.parquet(str(tmp_path / "log"))
    stream = lambda: readers.stream(spark, str(tmp_path / "log"), "tx_id long, seq long, kind string, payload string")
    held = run(stateful.commit_buffer(stream()), tmp_path, "held", spark).orderBy("seq").collect()
    assert [(r.tx_id, r.seq, r.payload, r.commit_seq) for r in held] == [(1, 10, "a", 14), (1, 12, "c", 14)]
    n = run(stateful.numbered(stream().where("kind = 'event'")), tmp_path, "numbered", spark)
    assert {(r.tx_id, r.seq): r.total_order for r in n.collect()} == {(1, 10): 1, (1, 12): 2, (2, 11): 1, (3, 15): 1}


def test_transactions_over_several_triggers(spark, tmp_path):
    kind = "tx_id long, seq long, kind string, payload string"
    parts = [[(1, 1, "event", "a"), (2, 2, "event", "x"), (1, 3, "event", "b")], [(1, 4, "event", "c"), (2, 5, "rollback", None), (1, 6, "commit", None), (1, 7, "event", "d")], [(2, 8, "event", "y"), (1, 9, "commit", None), (2, 10, "commit", None), (3, 11, "event", "open")]]
    src = str(tmp_path / "log")
    for part in parts:
        spark.createDataFrame(part, kind).coalesce(1).write.mode("append").parquet(src)
        for f, name in ((stateful.commit_buffer, "held"), (stateful.numbered, "numbers")):
            out = f(readers.stream(spark, src, kind))
            out.writeStream.format("parquet").option("checkpointLocation", str(tmp_path / f"{name}-ckpt")).trigger(availableNow=True).start(str(tmp_path / name)).awaitTermination()
    held = spark.read.parquet(str(tmp_path / "held")).orderBy("seq").collect()
    assert [(r.tx_id, r.seq, r.payload, r.commit_seq) for r in held] == [(1, 1, "a", 6), (1, 3, "b", 6), (1, 4, "c", 6), (1, 7, "d", 9), (2, 8, "y", 10)]
    numbers = spark.read.parquet(str(tmp_path / "numbers")).orderBy("seq").collect()
    assert [(r.tx_id, r.seq, r.total_order) for r in numbers] == [(1, 1, 1), (2, 2, 1), (1, 3, 2), (1, 4, 3), (1, 7, 1), (2, 8, 1), (3, 11, 1)]


def test_engine_builder_and_sinks(spark, tmp_path):
    log = order_log(spark, DATA)
    seen = []
    out = readers.Engine(spark).source(log).transform(E.read_to_insert, when="seq > 100").notifying(lambda d, n: seen.append(d.count())).run()
    assert seen == [log.count()] and out.where("op = 'r' and seq > 100").isEmpty() and not out.where("op = 'r'").isEmpty()
    readers.document_sink(str(tmp_path / "docs"))(log.withColumn("key", F.coalesce("after.key", "before.key")), 0)
    assert spark.read.json(str(tmp_path / "docs")).count() > 0
    assert readers.chunk_predicates("k", [5, 9], 20) == ["k < 5", "k >= 5 AND k < 9", "k >= 9 AND k <= 20"]
