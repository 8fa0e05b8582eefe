"""Operators on change envelopes: ``before, after, source, op, ts_ms`` rows ordered by ``seq``.

All of them are projections, filters or one-to-few explodes: no shuffle, whole-stage code.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

OPERATIONS = ("r", "c", "u", "d", "t", "m")
DELETE_MODES = ("drop", "tombstone", "rewrite", "rewrite-with-tombstone", "delete-to-tombstone")


def split_key_changes(events: DataFrame, keys: list[str]) -> DataFrame:
    """An update that changes the key becomes a delete of the old and a create of the new one (``sub`` orders them).

    Both carry the other key in ``headers``.  Comes before any reduction by key, or old keys survive.
    """
    key = lambda side: F.to_json(F.struct(*[F.col(f"{side}.{k}") for k in keys]))
    moved = (F.col("op") == "u") & ~F.struct(*[F.col(f"before.{k}") for k in keys]).eqNullSafe(F.struct(*[F.col(f"after.{k}") for k in keys]))
    image = F.lit(None).cast(events.schema["before"].dataType)
    part = lambda sub, op, b, a, h: F.struct(F.lit(sub).alias("sub"), op.alias("op"), b.alias("before"), a.alias("after"), h.cast("map<string,string>").alias("headers"))
    none = F.lit(None)
    parts = F.when(
        moved,
        F.array(
            part(0, F.lit("d"), F.col("before"), image, F.create_map(F.lit("newkey"), key("after"))),
            part(1, F.lit("c"), image, F.col("after"), F.create_map(F.lit("oldkey"), key("before"))),
        ),
    ).otherwise(F.array(part(0, F.col("op"), F.col("before"), F.col("after"), none)))
    rest = [c for c in events.columns if c not in ("op", "before", "after", "headers", "sub")]
    return events.select(*rest, F.explode(parts).alias("_e")).select(*rest, "_e.*")


def with_tombstones(events: DataFrame) -> DataFrame:
    """After each delete a row with the same key and no value (``is_tombstone``)."""
    return events.withColumn("is_tombstone", F.explode(F.when(F.col("op") == "d", F.array(F.lit(False), F.lit(True))).otherwise(F.array(F.lit(False)))))


@dataclass(frozen=True)
class Flatten:
    """How an envelope becomes a plain row.

    ``add_fields``: columns to add, ``op``, ``source.lsn``, ``name:alias``; they are prefixed and dots
    become underscores.  ``defaults`` replace nulls.  ``route_by`` names the field that becomes the topic.
    """

    delete_mode: str = "tombstone"
    add_fields: tuple[str, ...] = ()
    add_headers: tuple[str, ...] = ()
    prefix: str = "__"
    defaults: tuple[tuple[str, object], ...] = ()
    route_by: str | None = None
    drop_fields: tuple[str, ...] = ()


def added(events: DataFrame, fields: tuple[str, ...], prefix: str) -> list[tuple[str, Column]]:
    """Names and columns that ``fields`` stand for; an unqualified name is looked up in transaction, root, then source."""
    out = []
    for f in fields:
        path, _, alias = f.partition(":")
        if "." not in path and path not in events.columns:
            path = f"source.{path}"
        out.append((prefix + (alias or path.replace("source.", "source_", 1).replace(".", "_")), F.col(path)))
    return out


def flatten(events: DataFrame, how: Flatten = Flatten()) -> DataFrame:
    """Envelopes -> rows of the table, deletes and tombstones by the chosen mode.

    A delete's value is nothing (``drop``: no row; ``tombstone`` and ``delete-to-tombstone``: a row of
    nulls with ``is_tombstone``) or, in the rewrite modes, its before image with ``__deleted`` "true".
    """
    if how.delete_mode not in DELETE_MODES:
        raise ValueError(f"delete_mode is one of {DELETE_MODES}")
    deleted = F.col("op") == "d"
    rewrite = how.delete_mode.startswith("rewrite")
    if how.delete_mode == "drop":
        events = events.where(~deleted)
    if how.delete_mode == "rewrite-with-tombstone":
        events = with_tombstones(events)
    elif "is_tombstone" not in events.columns:
        events = events.withColumn("is_tombstone", deleted & F.lit(not rewrite))
    image = F.when(F.col("is_tombstone"), F.lit(None)).when(deleted, F.col("before")).otherwise(F.col("after"))
    events = events.where(F.col("op").isin("c", "u", "r", "d")).withColumn("_v", image)
    default = dict(how.defaults)
    names = [f.name for f in events.schema["after"].dataType.fields if f.name not in how.drop_fields]
    live = ~F.col("is_tombstone")
    values = [F.coalesce(F.col(f"_v.{n}"), F.when(live, F.lit(default[n]))).alias(n) if n in default else F.col(f"_v.{n}").alias(n) for n in names]
    extra = [F.when(live, c).alias(n) for n, c in added(events, how.add_fields, how.prefix)]
    marks = [F.when(live, F.when(deleted, "true").otherwise("false")).alias(how.prefix + "deleted")] if rewrite else []
    route = [F.coalesce(F.when(deleted, F.col(f"before.{how.route_by}")).otherwise(F.col(f"after.{how.route_by}")).cast("string"), F.lit("")).alias("topic")] if how.route_by else []
    headers = []
    if how.add_headers:
        cols = added(events, how.add_headers, how.prefix)
        value = lambda n, c: F.when(F.col("is_tombstone"), "d").otherwise(c.cast("string")) if n == how.prefix + "op" else c.cast("string")
        headers = [F.map_from_arrays(F.array(*[F.lit(n) for n, _ in cols]), F.array(*[value(n, c) for n, c in cols])).alias("headers")]
    kept = [c for c in ("seq", "sub") if c in events.columns]
    return events.select(*kept, *values, *extra, *marks, *route, *headers, "is_tombstone")


def changed_fields(events: DataFrame, changed: str = "changed", unchanged: str = "unchanged") -> DataFrame:
    """Names of fields that differ (or not) between the images; empty where one image is missing."""
    names = [f.name for f in events.schema["after"].dataType.fields]
    both = F.col("before").isNotNull() & F.col("after").isNotNull()
    same = {n: F.col(f"before.{n}").eqNullSafe(F.col(f"after.{n}")) for n in names}
    pick = lambda want: F.filter(F.array(*[F.when(both & (same[n] == F.lit(want)), F.lit(n)) for n in names]), lambda x: x.isNotNull())
    return events.withColumn(changed, pick(False)).withColumn(unchanged, pick(True))


def header_to_value(events: DataFrame, headers: list[str], fields: list[str], operation: str = "copy", into: str = "after") -> DataFrame:
    """Copies or moves headers into fields of a struct column."""
    if len(headers) != len(fields):
        raise ValueError("headers and fields must have equal lengths")
    value = F.col(into)
    for h, f in zip(headers, fields):
        value = value.withField(f, F.col("headers")[h])
    events = events.withColumn(into, F.when(F.col(into).isNotNull(), value))
    if operation == "move":
        events = events.withColumn("headers", F.map_filter("headers", lambda k, v: ~k.isin(headers)))
    return events


def add_source_schema(rows: DataFrame, table: str) -> DataFrame:
    """Adds a constant ``source_schema`` struct: table id and the columns with their types."""
    cols = F.array(*[F.struct(F.lit(f.name).alias("name"), F.lit(f.dataType.simpleString()).alias("type"), F.lit(f.nullable).alias("optional"), F.lit(i + 1).alias("position")) for i, f in enumerate(rows.schema)])
    return rows.withColumn("source_schema", F.struct(F.lit(table).alias("id"), cols.alias("columns")))


def read_to_insert(events: DataFrame) -> DataFrame:
    """Snapshot reads count as creates."""
    return events.withColumn("op", F.when(F.col("op") == "r", "c").otherwise(F.col("op")))


def decode_messages(events: DataFrame, schema: str) -> DataFrame:
    """Logical messages (``op`` m, JSON bytes in ``content``) become creates with the decoded content as ``after`` and no key."""
    body = F.from_json(F.decode("content", "utf-8"), schema)
    return events.where("op = 'm'").select("seq", "prefix", F.lit("c").alias("op"), F.lit(None).cast("string").alias("key"), body.alias("after"))


def to_json_events(events: DataFrame) -> DataFrame:
    """``key, value`` JSON text of each envelope (tombstones have a null value)."""
    value = F.to_json(F.struct("before", "after", "source", "op", "ts_ms"))
    return events.select("seq", F.to_json(F.struct(F.coalesce(F.col("after.key"), F.col("before.key")).alias("key"))).alias("key"), value.alias("value"))


def from_json_events(rows: DataFrame, image: str, unwrap: str = "after") -> DataFrame:
    """Parses JSON envelopes (malformed ones give nulls) and unwraps one field."""
    schema = f"struct<before:{image},after:{image},op:string,ts_ms:bigint>"
    return rows.withColumn("_e", F.from_json("value", schema)).select("seq", F.col("_e.op").alias("op"), f"_e.{unwrap}.*")


def with_context_headers(events: DataFrame, context: dict[str, str]) -> DataFrame:
    """Adds connector and task identity to every row's headers."""
    fixed = F.create_map(*[F.lit(x) for kv in context.items() for x in kv])
    return events.withColumn("headers", F.map_concat(F.coalesce(F.col("headers"), F.create_map().cast("map<string,string>")), fixed) if "headers" in events.columns else fixed)
