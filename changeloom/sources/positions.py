"""A restartable reader of landed change tables: log positions are the offsets.

Tables hold rows with a position (a commit's place in the log) and a serial number inside it.  A batch is a range of
``(position, serial)`` over all tables, so it may end inside a transaction.  Before a batch is handed over, its two ends are written
(``offsets/<n>.json``); when the consumer has returned, it is marked (``commits/<n>.json``).  A restart goes on behind the last mark, and a batch that
was begun is read again between the same ends, with the same number: a consumer that is safe to replay by number sees every row once.

How far a batch goes is found without sorting: rows (and bytes) are counted in bins of positions, and the bin in which
the limit lies is cut into bins again, down to one position and then to one serial number.  Filters on the position reach the scan.
"""

from __future__ import annotations

import json
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from changeloom.sources.buckets import Folder

#: Bins that are counted at once.
BINS = 256


@dataclass
class PositionReader:
    """Change tables by name, read in batches of at most ``max_rows`` rows and ``max_bytes`` bytes (one row at least).

    ``size`` is what a row counts in bytes, as a SQL expression over the tables' columns; all tables have the same columns.
    """

    spark: SparkSession
    tables: dict[str, DataFrame]
    checkpoint: str
    position: str = "pos"
    serial: str = "serial"
    max_rows: int | None = None
    max_bytes: int | None = None
    size: str | None = None

    def __post_init__(self):
        self.folder = Folder(self.spark, self.checkpoint)
        for kind in ("offsets", "commits"):
            self.folder.fs.mkdirs(self.folder.at(kind))

    def rows(self) -> DataFrame:
        """All rows of all tables, with the table's name as ``tbl``."""
        out = None
        for name, table in self.tables.items():
            one = table.withColumn("tbl", F.lit(name))
            out = one if out is None else out.unionByName(one)
        return out

    def between(self, after: list[int] | None, to: list[int] | None) -> Column:
        """Rows behind ``(position, serial)`` up to and with another one."""
        p, s = F.col(self.position), F.col(self.serial)
        test = F.lit(True)
        if after is not None:  # the plain comparison is what the scan can use
            test = test & (p >= after[0]) & ((p > after[0]) | (s > after[1]))
        if to is not None:
            test = test & (p <= to[0]) & ((p < to[0]) | (s <= to[1]))
        return test

    def read(self, after: list[int] | None, to: list[int] | None) -> DataFrame:
        return self.rows().where(self.between(after, to))

    def _cut(self, left: DataFrame, column: str, low: int, high: int, rows: int, size: int) -> tuple[int | None, int, int, int]:
        """The largest value up to which the rows fit (None: not even the first), the value behind it, and what is left of rows and bytes."""
        fits = None
        while True:
            width = max(1, -(-(high - low + 1) // BINS))
            at = F.floor((F.col(column) - low) / width)
            total = F.sum(F.expr(self.size)) if self.size else F.lit(0)
            # at most BINS short rows; a value's remainder tells the next one that occurs
            bins = left.where(F.col(column).between(low, high)).groupBy(at.alias("b")).agg(F.count(F.lit(1)).alias("n"), total.alias("size"), F.min(column).alias("lo"), F.max(column).alias("hi")).collect()
            for r in sorted(bins, key=lambda r: r["b"]):
                if r["n"] <= rows and (r["size"] or 0) <= size:
                    rows, size, fits = rows - r["n"], size - (r["size"] or 0), r["hi"]
                    continue
                if r["lo"] == r["hi"]:
                    return fits, r["lo"], rows, size
                low, high = r["lo"], r["hi"]
                break
            else:
                return fits, high + 1, rows, size

    def next_end(self, after: list[int] | None) -> list[int] | None:
        """Where the batch behind ``after`` ends; None if nothing is there."""
        left = self.read(after, None).select(self.position, self.serial, *([F.expr(self.size).alias("_size")] if self.size else []))
        ends = left.agg(F.min(self.position), F.max(self.position), F.max_by(self.serial, F.struct(self.position, self.serial))).first()
        if ends[0] is None:
            return None
        if self.max_rows is None and self.max_bytes is None:
            return [ends[1], ends[2]]
        left = self.read(after, None)
        rows, size = (1 << 62 if x is None else x for x in (self.max_rows, self.max_bytes))
        fits, beyond, rows_left, size_left = self._cut(left, self.position, ends[0], ends[1], rows, size)
        if fits == ends[1]:
            return [ends[1], ends[2]]
        # the position that doesn't fit whole gives as many serial numbers as fit
        inside = left.where(F.col(self.position) == beyond)
        low, high = inside.agg(F.min(self.serial), F.max(self.serial)).first()
        some, first, _, _ = self._cut(inside, self.serial, low, high, rows_left, size_left)
        if some is not None:
            return [beyond, some]
        if fits is not None:
            return [fits, left.where(F.col(self.position) == fits).agg(F.max(self.serial)).first()[0]]
        return [beyond, first]

    def done(self) -> int:
        """Number of the last batch that is marked (-1: none)."""
        return max((int(n[:-5]) for n in self.folder.names("commits") if n.endswith(".json")), default=-1)

    def step(self, consumer: Callable[[DataFrame, int], None]) -> bool:
        """Reads and hands over the next batch; false if there is none."""
        last = self.done()
        after = json.loads(self.folder.read(f"offsets/{last}.json"))["to"] if last >= 0 else None
        name = f"offsets/{last + 1}.json"
        if f"{last + 1}.json" in self.folder.names("offsets"):
            to = json.loads(self.folder.read(name))["to"]
        else:
            to = self.next_end(after)
            if to is None:
                return False
            self.folder.publish(name, json.dumps({"after": after, "to": to}))
        consumer(self.read(after, to), last + 1)
        self.folder.publish(f"commits/{last + 1}.json", "{}")
        return True

    def run(self, consumer: Callable[[DataFrame, int], None], most: int | None = None) -> int:
        """Batches until nothing is left, or ``most`` of them; returns their number."""
        n = 0
        while (most is None or n < most) and self.step(consumer):
            n += 1
        return n
