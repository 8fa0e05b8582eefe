"""Streaming twins of the stateful operators.  State is keyed, so it spreads over executors."""

from __future__ import annotations

from collections.abc import Callable

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from changeloom.sources.readers import upsert_sink


def keep_current(events: DataFrame, keys: list[str], path: str, checkpoint: str, spark: SparkSession) -> StreamingQuery:
    """A table folder kept current from a stream of envelopes (versions by batch, idempotent on replay)."""
    return events.writeStream.foreachBatch(upsert_sink(path, keys, spark)).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
ENDS = ("commit", "rollback")


class _Numbers(StatefulProcessor):
    def init(self, handle: StatefulProcessorHandle) -> None:
        self.count = handle.getValueState("count", "n long")

    def handleInputRows(self, key, rows, timerValues):
        given = pd.concat(list(rows)).sort_values(["seq", "ends"], kind="stable")
        n, out = (self.count.get() or (0,))[0], []
        for seq, ends in zip(given["seq"], given["ends"]):
            n = 0 if ends else n + 1
            if not ends:
                out.append((key[0], seq, n))
        if n:
            self.count.update((n,))
        else:
            self.count.clear()
        if out:
            yield pd.DataFrame(out, columns=["tx", "seq", "total_order"])

    def close(self) -> None:
        pass


def numbered(events: DataFrame, tx: str = "tx_id") -> DataFrame:
    """``total_order`` of each event in its transaction, over batches.

    Where rows have a ``kind``, one that commits or rolls back ends the transaction: it gets no number, and the state goes.  Nothing is
    forgotten by time.
    """
    events.sparkSession.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKS)
    ends = F.col("kind").isin(*ENDS) if "kind" in events.columns else F.lit(False)
    rows = events.select(F.col(tx).alias("tx"), "seq", F.coalesce(ends, F.lit(False)).alias("ends"))
    return rows.groupBy("tx").transformWithStateInPandas(_Numbers(), "tx long, seq long, total_order long", "Append", "None").withColumnRenamed("tx", tx)


class _Held(StatefulProcessor):
    def init(self, handle: StatefulProcessorHandle) -> None:
        self.held = handle.getListState("held", "seq long, payload string")

    def handleInputRows(self, key, rows, timerValues):
        given = pd.concat(list(rows)).sort_values("seq", kind="stable")
        fresh = []
        for seq, kind, payload in zip(given["seq"], given["kind"], given["payload"]):
            if kind == "event":
                fresh.append((seq, payload))
                continue
            if kind == "commit":
                out = sorted([*self.held.get(), *fresh], key=lambda r: r[0])
                if out:
                    yield pd.DataFrame({"tx": key[0], "seq": [r[0] for r in out], "payload": [r[1] for r in out], "commit_seq": seq})
            self.held.clear()
            fresh = []
        if fresh:
            self.held.appendList(fresh)

    def close(self) -> None:
        pass


def commit_buffer(log: DataFrame, tx: str = "tx_id") -> DataFrame:
    """Holds events (``kind`` event) until their transaction's ``commit`` row comes; ``rollback`` discards them.

    Emits ``tx, seq, payload, commit_seq``.  What a transaction holds is a list in the state store that each trigger appends to.
    """
    log.sparkSession.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKS)
    rows = log.select(F.col(tx).alias("tx"), "seq", "kind", "payload")
    return rows.groupBy("tx").transformWithStateInPandas(_Held(), "tx long, seq long, payload string, commit_seq long", "Append", "None").withColumnRenamed("tx", tx)


def deduplicated_chunk(live: DataFrame, chunk: DataFrame, window: tuple[int, int], keys: list[str], emit: Callable[[DataFrame, int], None]) -> Callable[[DataFrame, int], None]:
    """A ``foreachBatch`` function for a stream with one open snapshot window: the chunk loses the keys that the batch touches."""
    low, high = window

    def write(batch: DataFrame, number: int) -> None:
        seen = batch.where((F.col("seq") > low) & (F.col("seq") <= high)).select(*[F.coalesce(F.col(f"after.{k}"), F.col(f"before.{k}")).alias(k) for k in keys])
        emit(chunk.join(seen, keys, "left_anti"), number)

    return write


def heartbeats(spark: SparkSession, server: str, seconds: int = 10) -> DataFrame:
    """A heartbeat row for each interval."""
    return spark.readStream.format("rate").option("rowsPerSecond", 1).load().where(F.col("value") % seconds == 0).select(F.lit(server).alias("server"), F.unix_millis("timestamp").alias("ts_ms"))


def event_time_counts(events: DataFrame, every: str = "5 minutes", late: str = "10 minutes") -> DataFrame:
    """An addition of this engine: counts by event-time window with a watermark."""
    return events.withWatermark("ts", late).groupBy(F.window("ts", every).alias("w"), "event_type").agg(F.count(F.lit(1)).alias("n")).select(F.col("w.start").alias("start"), "event_type", "n")
