"""Which tables, columns, operations and rows are captured.  Predicates only: they reach the scan."""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SYSTEM_SCHEMAS = ("information_schema", "mysql", "performance_schema", "pg_catalog", "sys")


def any_of(name: Column, patterns: list[str]) -> Column:
    """Whether a name matches one of the anchored, case-insensitive patterns."""
    out = F.lit(False)
    for p in patterns:
        out = out | name.rlike(f"(?i)^(?:{p})$")
    return out


def listed(text: str | None) -> list[str]:
    """A comma-separated list; ``\\,`` is a comma inside an item."""
    return [x.replace("\\,", ",").strip() for x in re.split(r"(?<!\\),", text or "") if x.strip()]


def _side(name: Column, include: str | None, exclude: str | None) -> Column | None:
    """Include wins where both are given."""
    return any_of(name, listed(include)) if include else ~any_of(name, listed(exclude)) if exclude else None


@dataclass(frozen=True)
class Tables:
    """Include and exclude lists for databases, schemas and full table names."""

    database_include: str | None = None
    database_exclude: str | None = None
    schema_include: str | None = None
    schema_exclude: str | None = None
    table_include: str | None = None
    table_exclude: str | None = None
    ignore_builtin: bool = True
    signal_table: str | None = None

    def predicate(self, db: Column, schema: Column, table: Column) -> Column:
        """Without table lists the database list no longer counts once a schema list is given (kept as it is known to behave)."""
        full = F.concat_ws(".", db, schema, table)
        d, s, t = _side(db, self.database_include, self.database_exclude), _side(schema, self.schema_include, self.schema_exclude), _side(full, self.table_include, self.table_exclude)
        parts = [x for x in ([d, s, t] if t is not None else [s if s is not None else d]) if x is not None]
        keep = F.lit(True)
        for x in parts:
            keep = keep & x
        if self.ignore_builtin:
            keep = keep & ~F.lower(F.coalesce(schema, db)).isin(*SYSTEM_SCHEMAS)
        return keep | (full == self.signal_table) if self.signal_table else keep


def matches(name: Column, literals: list[str] = (), patterns: list[str] = ()) -> Column:
    """Literal names, patterns, or both (UUIDs are literals that compare without case)."""
    return F.lower(name).isin(*[x.lower() for x in literals]) | any_of(name, list(patterns)) if literals else any_of(name, list(patterns))


def project_columns(rows: DataFrame, table: str, include: str | None = None, exclude: str | None = None, keys: list[str] = ()) -> DataFrame:
    """Columns by patterns over ``table.column``; key columns always stay.  Resolved once, so the scan reads only these."""
    test = lambda c, ps: any(re.fullmatch(p, f"{table}.{c}", re.I) for p in listed(ps))
    keep = [c for c in rows.columns if c in keys or (test(c, include) if include else not (exclude and test(c, exclude)))]
    return rows.select(*keep)


def message_key(rows: DataFrame, table: str, rules: str, primary: list[str]) -> list[str]:
    """Key columns by ``<table pattern>:<c1,c2>;...``; the primary key where no rule matches."""
    for rule in filter(None, (x.strip() for x in rules.split(";"))):
        pattern, _, cols = rule.rpartition(":")
        if re.fullmatch(pattern, table, re.I):
            return [c.strip() for c in cols.split(",") if c.strip() in rows.columns]
    return list(primary)


def skip_operations(events: DataFrame, skipped: str = "t") -> DataFrame:
    """Truncates are skipped unless configured otherwise; "none" skips nothing."""
    ops = [] if skipped == "none" else listed(skipped)
    return events.where(~F.col("op").isin(*ops)) if ops else events


def skip_unchanged(events: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Updates whose captured columns are the same before and after are dropped (nulls compare equal)."""
    b, a = (F.struct(*[F.col(f"{s}.{c}") for c in columns]) if columns else F.col(s) for s in ("before", "after"))
    return events.where((F.col("op") != "u") | ~b.eqNullSafe(a))


def keep_where(events: DataFrame, condition: str, topic: str | None = None, nulls: str = "drop") -> DataFrame:
    """Keeps rows for which the SQL condition is true.

    ``topic`` gates it by a pattern over the topic column (others pass).  ``nulls`` says what happens to
    rows without a value: keep, drop or evaluate.
    """
    test = F.coalesce(F.expr(condition), F.lit(False))
    if nulls != "evaluate":
        test = F.when(F.col("value").isNull(), F.lit(nulls == "keep")).otherwise(test) if "value" in events.columns else test
    return events.where(~F.col("topic").rlike(f"^(?:{topic})$") | test if topic else test)


def schema_changes(changes: DataFrame, excluded_types: list[str]) -> DataFrame:
    """Drops schema events whose first table change is of an excluded type; no change counts as DATABASE, a null list goes."""
    first = F.when(F.size("table_changes") == 0, F.lit("DATABASE")).otherwise(F.get("table_changes", F.lit(0))["type"])
    return changes.where(F.col("table_changes").isNotNull() & ~first.isin(*excluded_types))
