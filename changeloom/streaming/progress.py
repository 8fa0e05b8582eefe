"""What a stream reports about itself: counts and lag observed in each batch, notifications, stalled offsets, written to a table.

    watch = ProgressTable(spark, path, channels=[print])
    spark.streams.addListener(watch)
    observed(events).writeStream...

A batch is one file named by query and batch, so that a batch that is reported again adds nothing.  Metrics are computed in the
plan of the stream itself, without a second pass over its rows, and merge over batches by addition, least and greatest.
"""

from __future__ import annotations

import json
import threading
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.listener import QueryIdleEvent, QueryProgressEvent, QueryStartedEvent, QueryTerminatedEvent, StreamingQueryListener

from changeloom.sources.buckets import Folder

#: Operations that are counted apart.
OPERATIONS = ("r", "c", "u", "d", "t", "m")
NAME = "changes"
SCHEMA = "query string, run string, kind string, batch long, at string, rows long, end_offset string, reports long, metrics map<string,long>"


def observed(events: DataFrame, name: str = NAME) -> DataFrame:
    """The events, unchanged, with counts by operation, first and last position and the lag behind the source observed on the way."""
    lag = F.col("ts_ms") - F.col("source.ts_ms")
    counts = [F.count_if(F.col("op") == o).alias(f"n_{o}") for o in OPERATIONS]
    return events.observe(
        name, F.count(F.lit(1)).alias("n"), *counts, F.min("seq").alias("min_seq"), F.max("seq").alias("max_seq"),
        F.count(lag).alias("n_lag"), F.sum(lag).alias("sum_lag"), F.min(lag).alias("min_lag"), F.max(lag).alias("max_lag"),
    )


class ProgressTable(StreamingQueryListener):
    """Writes a row for the start, each batch, each stall and the end of every stream of the session to a folder, and hands it to the channels.

    A stream is stalled when ``checks`` reports in a row, idle ones included, show the same end offsets; that is told once, until they move again.
    """

    def __init__(self, spark: SparkSession, path: str, checks: int = 3, name: str = NAME, channels: list[Callable[[dict], None]] | None = None):
        self.spark, self.folder, self.path = spark, Folder(spark, path), path
        self.checks, self.name, self.channels = checks, name, channels or []
        self.last: dict[str, tuple[str | None, int]] = {}
        self.ended: dict[str, threading.Event] = {}

    def _tell(self, file: str, **row) -> None:
        if self.folder.publish(f"{file}.json", json.dumps(row)):
            for channel in self.channels:
                channel(row)

    def _seen(self, query: str, run: str, at: str, offset: str | None) -> None:
        """Counts reports without a change; ``offset`` None leaves it as it was."""
        before, same = self.last.get(run, (None, 0))
        moved = offset is not None and offset != before
        self.last[run] = (offset if moved else before, 1 if moved else same + 1)
        before, same = self.last[run]
        if same == self.checks:
            self._tell(f"stalled-{run}-{at.replace(':', '')}", query=query, run=run, kind="stalled", at=at, end_offset=before, reports=same)

    def onQueryStarted(self, event: QueryStartedEvent) -> None:
        query, run = str(event.id), str(event.runId)
        self.ended.setdefault(run, threading.Event())
        self._tell(f"started-{run}", query=query, run=run, kind="started", at=event.timestamp)

    def onQueryProgress(self, event: QueryProgressEvent) -> None:
        p = event.progress
        query, run = str(p.id), str(p.runId)
        offset = json.dumps([str(s.endOffset) for s in p.sources])
        if p.numInputRows or p.observedMetrics.get(self.name):
            metrics = {k: v for k, v in (p.observedMetrics[self.name].asDict() if self.name in p.observedMetrics else {}).items() if v is not None}
            self._tell(f"batch-{query}-{p.batchId:012d}", query=query, run=run, kind="batch", batch=p.batchId, at=p.timestamp, rows=p.numInputRows, end_offset=offset, metrics=metrics)
        self._seen(query, run, p.timestamp, offset)

    def onQueryIdle(self, event: QueryIdleEvent) -> None:
        self._seen(str(event.id), str(event.runId), event.timestamp, None)

    def onQueryTerminated(self, event: QueryTerminatedEvent) -> None:
        run = str(event.runId)
        row = {"query": str(event.id), "run": run, "kind": "failed" if event.exception else "ended"}
        self._tell(f"ended-{run}", **row)
        self.last.pop(run, None)
        self.ended.setdefault(run, threading.Event()).set()

    def wait(self, run: str, seconds: float = 60) -> bool:
        """Whether all reports of a run have been written; they come after the stream's own end."""
        return self.ended.setdefault(run, threading.Event()).wait(seconds)

    def read(self) -> DataFrame:
        return self.spark.read.schema(SCHEMA).json(f"{self.path}/*.json")


def totals(progress: DataFrame) -> DataFrame:
    """The metrics of all batches of a query as one row: counts, positions and the least, greatest and average lag."""
    m = lambda c: F.col("metrics")[c]
    return progress.where("kind = 'batch'").groupBy("query").agg(
        F.count(F.lit(1)).alias("batches"), *[F.sum(m(c)).alias(c) for c in ("n", *[f"n_{o}" for o in OPERATIONS])], F.min(m("min_seq")).alias("min_seq"), F.max(m("max_seq")).alias("max_seq"),
        F.min(m("min_lag")).alias("min_lag"), F.max(m("max_lag")).alias("max_lag"), (F.sum(m("sum_lag")) / F.sum(m("n_lag"))).alias("avg_lag"),
    )
