"""Schema history: an append-only table of schema changes, its state at a position, and a small DDL reader."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from changeloom.operators.ranges import RANGE_ROWS, ranges

HISTORY = "pos long, tbl string, type string, ddl string, columns array<struct<name:string,type:string,optional:boolean>>"


def append(spark: SparkSession, path: str, rows: list[tuple]) -> None:
    spark.createDataFrame(rows, HISTORY).write.mode("append").parquet(path)


#: Schema changes up to which their intervals are broadcast.
INTERVALS = 50_000


def at_position(history: DataFrame, pos: int) -> DataFrame:
    """Each table's schema as of a position; dropped tables are left out."""
    last = history.where(F.col("pos") <= pos).groupBy("tbl").agg(F.max_by(F.struct("type", "columns", "pos"), "pos").alias("_s"))
    return last.where("_s.type <> 'DROP'").select("tbl", F.col("_s.pos").alias("since"), "_s.columns")


def for_events(events: DataFrame, history: DataFrame, range_rows: int = RANGE_ROWS) -> DataFrame:
    """The schema position that holds for each event: the last one at or before it.

    Few schema changes (they are counted) go to all tasks as intervals, so that a table's events stay where they are.  A table's
    positions are cut into as many bins as it has changes, and an interval stands in every bin that it reaches (two entries a change, all in all), so an
    event meets the few intervals of its bin.  More changes are merged with the events of their table by windows over ranges of some ``range_rows`` rows.
    """
    if history.count() <= INTERVALS:
        per = W.partitionBy("tbl")
        marks = history.select("tbl", F.col("pos").alias("schema_pos")).distinct()
        marks = marks.select("*", F.lead("schema_pos").over(per.orderBy("schema_pos")).alias("_until"), F.min("schema_pos").over(per).alias("_low"), F.max("schema_pos").over(per).alias("_high"), F.count(F.lit(1)).over(per).alias("_n"))
        marks = marks.withColumn("_width", F.ceil((F.col("_high") - F.col("_low") + 1) / F.col("_n")))
        bin_of = lambda pos: F.least(F.floor((pos - F.col("_low")) / F.col("_width")), F.col("_n") - 1)
        held = marks.select(F.col("tbl").alias("_t"), "schema_pos", "_until", F.explode(F.sequence(bin_of(F.col("schema_pos")), F.coalesce(bin_of(F.col("_until") - 1), F.col("_n") - 1))).alias("_bin"))
        tables = marks.select(F.col("tbl").alias("_s"), "_low", "_width", "_n").distinct()
        placed = events.join(F.broadcast(tables), events["tbl"].eqNullSafe(F.col("_s")), "left").withColumn("_at", bin_of(F.col("seq")))
        on = F.col("tbl").eqNullSafe(F.col("_t")) & (F.col("_at") == F.col("_bin")) & (F.col("seq") >= F.col("schema_pos")) & (F.col("_until").isNull() | (F.col("seq") < F.col("_until")))
        return placed.join(F.broadcast(held), on, "left").select("tbl", "seq", "schema_pos")
    marks = history.where(F.col("pos").isNotNull()).select("tbl", F.col("pos").alias("seq"), F.lit(0).alias("_k"), F.col("pos").alias("schema_pos"))
    both = marks.unionByName(events.select("tbl", "seq", F.lit(1).alias("_k"), F.lit(None).cast("long").alias("schema_pos")))
    both = both.withColumn("_g", ranges(both.select("seq"), "seq", range_rows))
    # what held before a range stands in it behind events without a position and before all others: one row a table and range
    before = W.partitionBy("tbl").orderBy("_g").rowsBetween(W.unboundedPreceding, -1)
    held = both.groupBy("tbl", "_g").agg(F.max("schema_pos").alias("schema_pos")).select("tbl", F.lit(None).cast("long").alias("seq"), F.lit(2).alias("_k"), F.last("schema_pos", ignorenulls=True).over(before).alias("schema_pos"), "_g")
    inside = W.partitionBy("tbl", "_g").orderBy("seq", "_k").rowsBetween(W.unboundedPreceding, W.currentRow)
    return both.unionByName(held).withColumn("schema_pos", F.last("schema_pos", ignorenulls=True).over(inside)).where("_k = 1").drop("_k", "_g")


def replay(statements: list[tuple[int, str]]) -> tuple[dict[str, list[tuple[str, str, bool]]], list[int]]:
    """Applies DDL in order; returns tables with their columns and the positions that couldn't be read."""
    tables, bad = {}, []
    for pos, ddl in statements:
        try:
            apply_ddl(tables, ddl)
        except ValueError:
            bad.append(pos)
    return tables, bad


_name = r"[`\"\[]?([\w$.]+)[`\"\]]?"


def _parts(body: str) -> list[str]:
    """A comma list at the outer level of brackets and quotes."""
    out, depth, quote, start = [], 0, "", 0
    for i, ch in enumerate(body):
        if quote:
            quote = "" if ch == quote else quote
        elif ch in "'\"`":
            quote = ch
        elif ch in "()":
            depth += 1 if ch == "(" else -1
        elif ch == "," and not depth:
            out.append(body[start:i])
            start = i + 1
    return [p.strip() for p in [*out, body[start:]] if p.strip()]


def _column(text: str) -> tuple[str, str, bool]:
    m = re.match(rf"{_name}\s+(\w+(?:\s*\([^)]*\))?(?:\s+(?:unsigned|varying|precision))?)(.*)$", text, re.I | re.S)
    if not m:
        raise ValueError(text)
    return m[1], re.sub(r"\s+", "", m[2].upper()), not re.search(r"not\s+null|primary\s+key", m[3], re.I)


def apply_ddl(tables: dict, ddl: str) -> str:
    """Applies one statement to ``{table: [(column, type, optional)]}`` and names its kind."""
    text = re.sub(r"/\*.*?\*/|--[^\n]*", " ", ddl, flags=re.S).strip().rstrip(";").strip()
    if m := re.match(rf"create\s+(?:temporary\s+)?table\s+(?:if\s+not\s+exists\s+)?{_name}\s+like\s+{_name}$", text, re.I):
        tables[m[1]] = list(tables[m[2]]) if m[2] in tables else []
        return "CREATE"
    if m := re.match(rf"create\s+(?:temporary\s+)?table\s+(?:if\s+not\s+exists\s+)?{_name}\s*\((.*)\)[^)]*$", text, re.I | re.S):
        columns, keys = [], set()
        for p in _parts(m[2]):
            if k := re.match(r"(?:constraint\s+\S+\s+)?primary\s+key\s*\(([^)]*)\)", p, re.I):
                keys |= set(re.findall(r"\w+", k[1]))
            elif not re.match(r"(constraint|unique|key|index|foreign|check|fulltext|spatial)\b", p, re.I):
                columns.append(_column(p))
        tables[m[1]] = [(n, t, o and n not in keys) for n, t, o in columns]
        return "CREATE"
    if m := re.match(rf"drop\s+(table|view)\s+(?:if\s+exists\s+)?(.*)$", text, re.I | re.S):
        for t in re.findall(_name, re.sub(r"\b(cascade|restrict)\b", "", m[2], flags=re.I)):
            tables.pop(t, None)
        return "DROP"
    if m := re.match(r"rename\s+table\s+(.*)$", text, re.I | re.S):
        for p in _parts(m[1]):
            a, b = re.match(rf"{_name}\s+to\s+{_name}", p, re.I).groups()
            tables[b] = tables.pop(a)
        return "RENAME"
    if re.match(r"truncate\b", text, re.I):
        return "TRUNCATE"
    if re.match(r"create\s+(unique\s+)?index|drop\s+index", text, re.I):
        return "INDEX"
    if m := re.match(rf"alter\s+table\s+{_name}\s+(.*)$", text, re.I | re.S):
        table = m[1]
        if table not in tables:
            raise ValueError(f"unknown table {table}")
        for p in _parts(m[2]):
            cols = tables[table]
            at = lambda n: next((i for i, c in enumerate(cols) if c[0].lower() == n.lower()), None)
            if a := re.match(rf"rename\s+(?:to|as)\s+{_name}$", p, re.I):
                tables[a[1]] = tables.pop(table)
                table = a[1]
            elif a := re.match(rf"rename\s+column\s+{_name}\s+to\s+{_name}", p, re.I):
                cols[at(a[1])] = (a[2], *cols[at(a[1])][1:])
            elif a := re.match(rf"drop\s+(?:column\s+)?(?:if\s+exists\s+)?{_name}$", p, re.I):
                if at(a[1]) is not None:
                    del cols[at(a[1])]
            elif a := re.match(rf"change\s+(?:column\s+)?{_name}\s+(.*)$", p, re.I | re.S):
                cols[at(a[1])] = _column(a[2])
            elif a := re.match(r"modify\s+(?:column\s+)?(.*)$", p, re.I | re.S):
                new = _column(a[1])
                cols[at(new[0])] = new
            elif re.match(r"add\s+(constraint|unique|index|key|primary|foreign|fulltext)\b", p, re.I):
                continue
            elif a := re.match(r"add\s+(?:column\s+)?(?:if\s+not\s+exists\s+)?(.*)$", p, re.I | re.S):
                new = _column(re.sub(r"\s+(first|after\s+\S+)$", "", a[1], flags=re.I))
                place = re.search(rf"\s+after\s+{_name}$", a[1], re.I)
                cols.insert(0 if re.search(r"\sfirst$", a[1], re.I) else at(place[1]) + 1 if place else len(cols), new)
            else:
                raise ValueError(p)
        return "ALTER"
    raise ValueError(text[:80])


def view_columns(spark: SparkSession, select: str, tables: dict[str, str]) -> list[tuple[str, str]]:
    """Columns of a view's SELECT over empty tables with the given DDL schemas: the engine's own analysis."""
    empty = {name: spark.createDataFrame([], schema) for name, schema in tables.items()}
    for name, df in empty.items():
        df.createOrReplaceTempView(name)
    try:
        return [(f.name, f.dataType.simpleString()) for f in spark.sql(select).schema]
    finally:
        for name in empty:
            spark.catalog.dropTempView(name)
