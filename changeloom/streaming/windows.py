"""Snapshot windows in a live stream: chunks lose the rows whose keys change while their window is open.

One stream carries everything, in the order of log positions: live events, the rows that open and close a chunk's window, rows of chunks, and
schema changes.  State is kept by bucket of keys, so it spreads over executors; rows that concern all keys go to every bucket.  A bucket's state are
maps in the state store (its open windows, the rows of chunks that wait, and the keys seen in a window), changed entry by entry, never rewritten whole.
Any number of windows may be open at once.

The result is that of :func:`changeloom.operators.snapshot.deduplicated`: a chunk row comes at its window's end, as a read, unless its key has an
event with ``low < seq <= high``.  If the schema of the chunk's table changes inside the window, its rows are void, and one row
with ``snapshot`` "reread" asks for it again.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

#: Kinds of rows, in the order in which they count at one position.
EVENT, SCHEMA, OPEN, CHUNK, CLOSE = range(5)
OUT = "seq long, sub int, tbl string, key string, op string, after string, snapshot string, chunk_id long"
_NAMES = [c.split()[0] for c in OUT.split(", ")]


def _row(df: DataFrame, kind: int, seq: Column, **columns: Column) -> DataFrame:
    types = {"chunk_id": "long", "tbl": "string", "key": "string", "op": "string", "after": "string"}
    return df.select(F.lit(kind).alias("kind"), seq.cast("long").alias("seq"), *[columns.get(c, F.lit(None)).cast(t).alias(c) for c, t in types.items()])


def event_rows(events: DataFrame, keys: list[str]) -> DataFrame:
    """Envelopes (``seq, tbl, op, before, after``) as rows of the stream."""
    key = F.to_json(F.struct(*[F.coalesce(F.col(f"after.{k}"), F.col(f"before.{k}")).alias(k) for k in keys]))
    return _row(events, EVENT, F.col("seq"), tbl=F.col("tbl"), key=key, op=F.col("op"), after=F.to_json("after"))


def chunk_rows(chunks: DataFrame, keys: list[str]) -> DataFrame:
    """Rows of chunks (``chunk_id, low, tbl, keys, after``); ``low`` is where their window opened."""
    return _row(chunks, CHUNK, F.col("low"), chunk_id=F.col("chunk_id"), tbl=F.col("tbl"), key=F.to_json(F.struct(*keys)), op=F.lit("r"), after=F.to_json("after"))


def mark_rows(marks: DataFrame) -> DataFrame:
    """Rows that open and close windows (``chunk_id, tbl, type, seq``; ``type`` is open or close) and schema changes (``tbl, type`` schema, ``seq``)."""
    kind = F.when(F.col("type") == "open", OPEN).when(F.col("type") == "close", CLOSE).otherwise(SCHEMA)
    return marks.select(kind.alias("kind"), F.col("seq").cast("long").alias("seq"), F.col("chunk_id").cast("long").alias("chunk_id"), "tbl", *[F.lit(None).cast("string").alias(c) for c in ("key", "op", "after")])


class _Windows(StatefulProcessor):
    def init(self, handle: StatefulProcessorHandle) -> None:
        self.windows = handle.getMapState("windows", "chunk_id long", "low long, tbl string, void boolean")
        self.waiting = handle.getMapState("waiting", "chunk_id long, key string", "tbl string, after string")
        self.seen = handle.getMapState("seen", "chunk_id long, key string", "hit boolean")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        bucket, out = key[0], []
        given = pd.concat(list(rows)).sort_values(["seq", "kind"], kind="stable")
        open_ = {k[0]: v for k, v in self.windows.iterator()}
        for kind, seq, chunk, tbl, k, op, after in zip(*[given[c] for c in ("kind", "seq", "chunk_id", "tbl", "key", "op", "after")]):
            if kind == EVENT:
                out.append((seq, 1, tbl, k, op, after, "false", None))
                for c, (low, of, _) in open_.items():
                    if of == tbl and seq > low:
                        self.seen.updateValue((c, k), (True,))
                        self.waiting.removeKey((c, k))
            elif kind == OPEN:
                open_[int(chunk)] = (int(seq), tbl, False)
                self.windows.updateValue((int(chunk),), open_[int(chunk)])
            elif kind == SCHEMA:
                for c, (low, of, _) in open_.items():
                    if of == tbl and seq > low:
                        open_[c] = (low, of, True)
                        self.windows.updateValue((c,), open_[c])
            elif kind == CHUNK:
                if int(chunk) not in open_:
                    raise ValueError(f"a row of chunk {chunk}, whose window isn't open")
                if not self.seen.containsKey((int(chunk), k)):
                    self.waiting.updateValue((int(chunk), k), (tbl, after))
            elif int(chunk) in open_:
                low, of, void = open_.pop(int(chunk))
                self.windows.removeKey((int(chunk),))
                kept = [(w[1], v) for w, v in self.waiting.iterator() if w[0] == chunk]
                for name, (of_table, image) in kept:
                    self.waiting.removeKey((int(chunk), name))
                    if not void:
                        out.append((seq, 0, of_table, name, "r", image, "incremental", int(chunk)))
                for w in [w for w in self.seen.keys() if w[0] == chunk]:
                    self.seen.removeKey((int(chunk), w[1]))
                if void and bucket == 0:
                    out.append((seq, 0, of, None, "r", None, "reread", int(chunk)))
        if out:
            frame = pd.DataFrame(out, columns=_NAMES)
            frame["chunk_id"] = frame["chunk_id"].astype("Int64")
            yield frame

    def close(self) -> None:
        pass


def deduplicated(stream: DataFrame, buckets: int = 64) -> DataFrame:
    """The stream of :func:`event_rows`, :func:`chunk_rows` and :func:`mark_rows` (united by name) with chunks freed of what changed: columns of OUT.

    Needs the RocksDB state store (``spark.sql.streaming.stateStore.providerClass``).  Rows of one trigger are put in order; a later trigger must not
    bring earlier positions.
    """
    own = F.array(F.pmod(F.xxhash64("tbl", "key"), F.lit(buckets)).cast("int"))
    everywhere = F.sequence(F.lit(0), F.lit(buckets - 1))
    dealt = stream.withColumn("bucket", F.explode(F.when(F.col("kind").isin(EVENT, CHUNK), own).otherwise(everywhere)))
    return dealt.groupBy("bucket").transformWithStateInPandas(_Windows(), OUT, "Append", "None")
