"""Values that an update leaves out, filled from the log itself.

A log that doesn't repeat large unchanged values holds a placeholder in their place.  The value is the last one that the row had, under this key or the one
it had before its key changed.  A key's history is cut by position into ranges: inside a range the last known value is carried forward by a window, ranges tell
the last value that they know (one row a key and range), and that is carried over the ranges, so a key with very many changes is never sorted in one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from changeloom.operators.ranges import RANGE_ROWS
from changeloom.operators.ranges import ranges as _ranges
from changeloom.sources.buckets import checkpointed


def _carried(rows: DataFrame, keys: list[str], columns: list[str], at: str) -> DataFrame:
    """``rows`` (with ``_g``, their range) whose columns, structs or null where unknown, hold the last known value."""
    inside = W.partitionBy(*keys, "_g").orderBy(at, "_probe").rowsBetween(W.unboundedPreceding, W.currentRow)
    before = W.partitionBy(*keys).orderBy("_g").rowsBetween(W.unboundedPreceding, -1)
    ends = rows.groupBy(*keys, "_g").agg(*[F.max_by(F.when(F.col(c).isNotNull(), F.col(c)), F.when(F.col(c).isNotNull(), F.col(at))).alias(c) for c in columns])
    ends = ends.select(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)], F.col("_g").alias("_h"), *[F.last(c, ignorenulls=True).over(before).alias(f"_e_{c}") for c in columns])
    near = rows.select(*[F.last(c, ignorenulls=True).over(inside).alias(c) if c in columns else F.col(c) for c in rows.columns])
    on = F.col("_g") == F.col("_h")
    for i, k in enumerate(keys):
        on = on & F.col(k).eqNullSafe(F.col(f"_k{i}"))
    both = near.join(ends, on, "left")
    return both.select(*[F.coalesce(F.col(c), F.col(f"_e_{c}")).alias(c) if c in columns else F.col(c) for c in rows.columns])


def filled(rows: DataFrame, keys: list[str], columns: list[str], placeholder: str, old: dict[str, str] | None = None, ends: str | None = None, at: str = "seq", range_rows: int = RANGE_ROWS) -> DataFrame:
    """``rows`` with the placeholders in ``columns`` (texts) replaced by the last value that the row is known to have had.

    Positions are unique.  ``old`` names for each key column the one that holds the key before the change, null where it is the same: the history goes on under the
    new key and ends under the old one.  It ends too behind rows for which ``ends`` holds (``op = 'd'``).  A null is a value like any other; what the log never
    told stays a placeholder.  Each round follows one change of key further, and rounds end when one finds nothing new.
    """
    unknown = "struct<v:string,gone:boolean>"
    known = lambda c: F.when(~F.col(c).eqNullSafe(F.lit(placeholder)), F.struct(F.col(c).alias("v"), F.lit(False).alias("gone")))
    told = lambda c: F.col(c).isNotNull() & ~F.col(f"{c}.gone")
    base = rows.withColumn("_g", _ranges(rows, at, range_rows)).withColumn("_probe", F.lit(0))
    base = base.select(*[known(c).alias(c) if c in columns else F.col(c) for c in base.columns])
    done = lambda d: d.where("_probe = 0").select(*[F.when(told(c), F.col(f"{c}.v")).otherwise(placeholder).alias(c) if c in columns else F.col(c) for c in rows.columns])
    moved, missing = F.lit(False), F.lit(False)
    for k, o in (old or {}).items():
        moved = moved | (F.col(o).isNotNull() & ~F.col(o).eqNullSafe(F.col(k)))
    for c in columns:
        missing = missing | F.col(c).isNull()

    def beside(some: DataFrame, kind: int, names: dict[str, str], value: Column) -> DataFrame:
        """Rows at the same places, under the keys that ``names`` tells, that ask (1) or end a history (2)."""
        return some.select(*[F.coalesce(F.col(names[c]), F.col(c)).alias(c) if c in names else F.lit(kind).alias(c) if c == "_probe" else value.cast(unknown).alias(c) if c in columns else F.col(c) for c in base.columns])

    gone = F.struct(F.lit(None).cast("string").alias("v"), F.lit(True).alias("gone"))
    marks = beside(base.where(moved), 2, old or {}, gone)
    if ends:
        marks = marks.unionByName(beside(base.where(ends), 2, {}, gone))
    if not old:
        return done(_carried(base.unionByName(marks), keys, columns, at))
    while True:
        # a change of key that doesn't tell all values asks under the old key what they were
        asks = beside(base.where(moved & missing), 1, old, F.lit(None))
        out = checkpointed(_carried(base.unionByName(marks).unionByName(asks), keys, columns, at))
        answers = out.where("_probe = 1").select(F.col(at).alias("_at"), *[F.when(told(c), F.col(c)).alias(f"_t_{c}") for c in columns])
        new = F.lit(False)
        for c in columns:
            new = new | (F.col(c).isNull() & F.col(f"_t_{c}").isNotNull())
        joined = base.join(answers, F.col(at) == F.col("_at"), "left")
        if joined.where(new).isEmpty():
            return done(out)
        base = checkpointed(joined.select(*[F.coalesce(F.col(c), F.col(f"_t_{c}")).alias(c) if c in columns else F.col(c) for c in base.columns]))
