"""Reports of streams: a batch is told once, a stalled stream is told, channels hear both."""

import time

from changeloom.plans.changelog import changelog
from changeloom.sources import readers
from changeloom.streaming import progress

DATA = "/root/testdata/sf0.001"


def until(check, seconds=60):
    end = time.time() + seconds
    while time.time() < end and not check():
        time.sleep(0.2)
    return check()


def test_a_stream_that_stalls_and_one_that_is_resumed(spark, tmp_path):
    src, out = str(tmp_path / "src"), str(tmp_path / "progress")
    log = changelog(spark, DATA)
    half = log.agg({"seq": "max"}).first()[0] // 2
    log.where(log.seq <= half).coalesce(1).write.parquet(src)
    heard = []
    watch = progress.ProgressTable(spark, out, checks=3, channels=[heard.append])
    spark.conf.set("spark.sql.streaming.noDataProgressEventInterval", "200")
    spark.streams.addListener(watch)
    kinds = lambda k: [h for h in heard if h["kind"] == k]
    start = lambda: progress.observed(readers.stream(spark, src, log.schema)).writeStream.format("noop").option("checkpointLocation", str(tmp_path / "ckpt")).trigger(processingTime="100 milliseconds").start()
    try:
        q = start()
        assert until(lambda: kinds("stalled")) and len(kinds("batch")) == 1
        # it moves and stalls again
        log.where(log.seq > half).coalesce(1).write.mode("append").parquet(src)
        assert until(lambda: len(kinds("stalled")) == 2)
        q.stop()
        assert watch.wait(str(q.runId))
        again = start()  # nothing is left to read: no batch is told a second time
        assert until(lambda: len(kinds("stalled")) == 3)
        again.stop()
        assert watch.wait(str(again.runId))
    finally:
        spark.streams.removeListener(watch)
        spark.conf.unset("spark.sql.streaming.noDataProgressEventInterval")
    table = watch.read()
    assert {r["kind"]: r["count"] for r in table.groupBy("kind").count().collect()} == {"started": 2, "batch": 2, "stalled": 3, "ended": 2}
    one = progress.totals(table).first()
    assert (one.batches, one.n, one.max_lag) == (2, log.count(), 96)
    # a report that comes twice, as after a failed commit, changes nothing
    before = len(heard)
    watch._tell("batch-" + kinds("batch")[0]["query"] + f"-{0:012d}", kind="batch")
    assert len(heard) == before and watch.read().count() == table.count()
