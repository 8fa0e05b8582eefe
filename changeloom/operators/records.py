"""Record transforms that look inside values: size limits, zones, vectors, geometry, documents, envelopes."""

from __future__ import annotations

import struct

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Fixed values of the size estimate, in bytes.
REFERENCE, EMPTY_STRUCT, PRIMITIVE, EMPTY_STRING, EMPTY_BYTES, EMPTY_ARRAY = 8, 56, 24, 56, 24, 64


def estimated_size(c: Column, kind: T.DataType) -> Column:
    """Approximate bytes of a value: structs pay for each field's reference, texts for their UTF-8 bytes."""
    if isinstance(kind, T.StructType):
        total = F.lit(EMPTY_STRUCT)
        for f in kind.fields:
            total = total + REFERENCE + estimated_size(c[f.name], f.dataType)
        return F.when(c.isNull(), 0).otherwise(total)
    if isinstance(kind, T.StringType):
        return F.coalesce(F.octet_length(c) + EMPTY_STRING, F.lit(0))
    if isinstance(kind, T.BinaryType):
        return F.coalesce(F.octet_length(c) + EMPTY_BYTES, F.lit(0))
    if isinstance(kind, T.ArrayType):
        return F.coalesce(F.aggregate(c, F.lit(EMPTY_ARRAY), lambda a, x: a + REFERENCE + estimated_size(x, kind.elementType)), F.lit(0))
    return F.lit(PRIMITIVE)


def enforce_size(events: DataFrame, max_bytes: int, min_field: int = 0, images: tuple[str, ...] = ("before", "after")) -> DataFrame:
    """Shortens long texts and bytes of the images in proportion until the estimate fits.

    Each gives ``ceil(share * excess)`` of its length; lengths are characters (bytes for binary), so texts
    beyond ASCII can still be over the limit.
    """
    size = F.lit(0)
    for i in images:
        size = size + estimated_size(F.col(i), events.schema[i].dataType)
    fields = [(i, f.name) for i in images for f in events.schema[i].dataType.fields if isinstance(f.dataType, (T.StringType, T.BinaryType))]
    length = lambda i, n: F.coalesce(F.when(F.length(F.col(f"{i}.{n}")) > min_field, F.length(F.col(f"{i}.{n}"))), F.lit(0))
    total = F.lit(0)
    for i, n in fields:
        total = total + length(i, n)
    events = events.withColumn("_excess", size - max_bytes).withColumn("_total", total)
    over = (F.col("_excess") > 0) & (F.col("_total") > 0)
    for i in images:
        value = F.col(i)
        for f in events.schema[i].dataType.fields:
            if (i, f.name) in fields:
                n = length(i, f.name)
                keep = F.greatest(F.lit(0), n - F.ceil(n / F.col("_total") * F.col("_excess"))).cast("int")
                value = value.withField(f.name, F.when(over & (n > 0), F.substring(F.col(f"{i}.{f.name}"), F.lit(1), keep)).otherwise(F.col(f"{i}.{f.name}")))
        events = events.withColumn(f"_{i}", F.when(F.col(i).isNotNull(), value))
    return events.select(*[F.col(f"_{c}").alias(c) if c in images else F.col(c) for c in events.columns if c not in ("_excess", "_total", *[f"_{i}" for i in images])])


def zone_rule(rules: list[str], table: str, field: str, topic: str = "") -> bool:
    """Whether a rule (``source:t[:f]``, ``topic:t[:f]`` or ``name[:f]``) names the field."""
    for r in rules:
        kind, *rest = r.split(":")
        names = rest if kind in ("source", "topic") else [kind, *rest]
        where = topic if kind == "topic" else table
        if names and names[0] == where and (len(names) == 1 or names[1] == field):
            return True
    return False


def convert_zones(rows: DataFrame, zone: str, table: str, epoch_ms: list[str] = (), texts: list[str] = (), include: list[str] = (), exclude: list[str] = ()) -> DataFrame:
    """Epoch columns (wall clock) to true epochs; ISO texts with an offset to the zone's offset."""
    from changeloom.functions.scalars import shifted_epoch, zoned

    hit = lambda c: zone_rule(include, table, c) if include else not zone_rule(exclude, table, c)
    return rows.select(*[shifted_epoch(F.col(c), zone).alias(c) if c in epoch_ms and hit(c) else zoned(F.to_timestamp(c), zone).alias(c) if c in texts and hit(c) else F.col(c) for c in rows.columns])


def dense_vector_json(c: Column) -> Column:
    return F.concat(F.lit('{ "values": ['), F.array_join(F.transform(c, lambda x: x.cast("string")), ", "), F.lit("] }"))


def sparse_vector_json(c: Column) -> Column:
    """``{dimensions, vector map}`` with sorted keys."""
    entries = F.array_sort(F.map_entries(c["vector"]))
    return F.concat(F.lit('{ "dimensions": '), c["dimensions"].cast("string"), F.lit(', "vector": { '), F.array_join(F.transform(entries, lambda e: F.concat(F.lit('"'), e["key"].cast("string"), F.lit('": '), e["value"].cast("string"))), ", "), F.lit(" } }"))


def point_wkb(x: Column, y: Column) -> Column:
    """A little-endian WKB point from two doubles (bits through the engine's own hash-free cast is absent, so Arrow packs them)."""

    @F.pandas_udf("binary")
    def pack(a, b):
        import pandas as pd

        return pd.Series([None if p != p or q != q else struct.pack("<BIdd", 1, 1, p, q) for p, q in zip(a, b)])

    return pack(x, y)


def swap_point(wkb: Column) -> Column:
    """A WKB or EWKB point with its coordinates swapped (they are the last 16 bytes)."""
    n = F.octet_length(wkb)
    part = lambda at, size: F.substring(wkb, at, F.lit(size))
    return F.concat(F.substring(wkb, F.lit(1), n - 16), part(n - 7, 8), part(n - 15, 8))


def walk_geometry(raw: bytes, swap: bool = False, srid: int | None = None, strip: bool = False) -> bytes:
    """Rewrites any WKB or EWKB geometry (2D to 4D, nested): swaps x and y, sets or strips the SRID, keeps byte order."""
    out, at = bytearray(), 0

    def geometry(top: bool) -> None:
        nonlocal at
        order = "<" if raw[at] else ">"
        kind = struct.unpack_from(order + "I", raw, at + 1)[0]
        flags, base = kind & 0xE0000000, kind & 0x1FFFFFFF
        at += 5
        own = None
        if flags & 0x20000000:
            own = struct.unpack_from(order + "I", raw, at)[0]
            at += 4
        own = (srid if srid is not None else own) if top else None
        if strip:
            own = None
        flags = (flags & ~0x20000000) | (0x20000000 if own is not None else 0)
        out.append(1 if order == "<" else 0)
        out.extend(struct.pack(order + "I", flags | base))
        if own is not None:
            out.extend(struct.pack(order + "I", own))
        dims = 2 + bool(flags & 0x80000000) + bool(flags & 0x40000000) + {0: 0, 1: 1, 2: 1, 3: 2}[base // 1000 % 10]
        kind = base % 1000

        def number() -> int:
            nonlocal at
            n = struct.unpack_from(order + "I", raw, at)[0]
            out.extend(struct.pack(order + "I", n))
            at += 4
            return n

        def points(n: int) -> None:
            nonlocal at
            for _ in range(n):
                xs = list(struct.unpack_from(f"{order}{dims}d", raw, at))
                at += 8 * dims
                if swap:
                    xs[0], xs[1] = xs[1], xs[0]
                out.extend(struct.pack(f"{order}{dims}d", *xs))

        if kind == 1:
            points(1)
        elif kind == 2:
            points(number())
        elif kind in (3, 17):
            for _ in range(number()):
                points(number())
        else:
            for _ in range(number()):
                geometry(False)

    geometry(True)
    return bytes(out)


def rewrite_geometries(rows: DataFrame, column: str, swap_srids: tuple[int, ...] = (), to: str | None = None) -> DataFrame:
    """A ``struct<wkb binary, srid int>`` column: coordinates swapped for the listed SRIDs, then ``ewkb`` or ``wkb``.  Other shapes than points need Python."""

    @F.pandas_udf("binary")
    def run(wkb, srid):
        import pandas as pd

        known = [None if s is None or s != s else int(s) for s in srid]
        return pd.Series([None if w is None else walk_geometry(w, s in swap_srids, s if to == "ewkb" else None, to == "wkb") for w, s in zip(wkb, known)])

    c = F.col(column)
    return rows.withColumn(column, F.when(c.isNotNull(), F.struct(run(c["wkb"], c["srid"]).alias("wkb"), c["srid"].alias("srid"))))


def document_state(events: DataFrame, schema: str, flatten: str | None = None) -> DataFrame:
    """JSON documents in ``after`` as columns; updates come as ``updated_fields`` (JSON, by dotted path) and ``removed_fields`` (dotted paths).

    A removed field is null, and so is one that an update doesn't speak of: ``mentioned`` names the columns that the event sets or removes
    (all of them, for a whole document).  :mod:`changeloom.operators.documents` folds such updates into whole documents.  ``flatten`` joins
    nested names with that delimiter.
    """
    parsed = events.withColumn("_d", F.from_json("after", schema)).withColumn("_u", F.try_parse_json("updated_fields"))
    kind = parsed.schema["_d"].dataType
    removed = F.coalesce("removed_fields", F.array().cast("array<string>"))
    # a name counts where it, or one above or below it, is set or removed
    said = F.concat(F.coalesce(F.json_object_keys("updated_fields"), F.array().cast("array<string>")), removed)
    touches = lambda name: F.exists(said, lambda s: F.concat(s, F.lit(".")).startswith(name + ".") | F.lit(name + ".").startswith(F.concat(s, F.lit("."))))

    def leaves(path: str, t: T.StructType, name: tuple[str, ...]) -> list[Column]:
        out = []
        for f in t.fields:
            here = (*name, f.name)
            if flatten and isinstance(f.dataType, T.StructType):
                out += leaves(f"{path}.{f.name}", f.dataType, here)
            else:
                gone = F.array_contains(removed, ".".join(here))
                # an update sets the path itself or one above it
                keys = [(".".join(here[:k]), here[k:]) for k in range(len(here), 0, -1)]
                set_ = F.coalesce(*[F.try_variant_get("_u", f"$['{key}']" + "".join(f"['{n}']" for n in rest), f.dataType.simpleString()) for key, rest in keys])
                out.append(F.when(~gone, F.when(F.col("after").isNotNull(), F.col(f"{path}.{f.name}")).otherwise(set_)).alias((flatten or ".").join(here)))
        return out

    def names(t: T.StructType, at: tuple[str, ...]) -> list[tuple[str, ...]]:
        return [p for f in t.fields for p in (names(f.dataType, (*at, f.name)) if flatten and isinstance(f.dataType, T.StructType) else [(*at, f.name)])]

    columns = leaves("_d", kind, ())
    paths = names(kind, ())
    mentioned = F.filter(F.array(*[F.when(F.col("after").isNotNull() | touches(".".join(p)), F.lit((flatten or ".").join(p))) for p in paths]), lambda n: n.isNotNull())
    return parsed.select("seq", "op", *columns, mentioned.alias("mentioned"))


def select_fields(rows: DataFrame, column: str, exclude: list[str] = (), rename: dict[str, str] | None = None) -> DataFrame:
    """Nested fields of a struct dropped by path, or renamed (``path -> new last name``); a null struct stays null."""
    names = rename or {}

    def built(path: tuple[str, ...], kind: T.StructType, value: Column) -> Column:
        parts = []
        for f in kind.fields:
            here = ".".join([*path, f.name])
            if here not in exclude:
                inside = isinstance(f.dataType, T.StructType) and any(p.startswith(here + ".") for p in [*exclude, *names])
                one = value.getField(f.name)
                parts.append((built((*path, f.name), f.dataType, one) if inside else one).alias(names.get(here, f.name)))
        return F.when(value.isNotNull(), F.struct(*parts))

    return rows.withColumn(column, built((), rows.schema[column].dataType, F.col(column)))


def cloud_events(events: DataFrame, connector: str = "shop", server: str = "srv", source_prefix: str = "/cdc", type_prefix: str = "io.cdc.connector", extension: str = "iocdc") -> DataFrame:
    """CloudEvents 1.0 JSON: id from the source position, the envelope as data, source fields as extensions."""
    ext = [F.col(f"source.{f.name}").cast("string").alias(extension + f.name.replace("_", "")) for f in events.schema["source"].dataType.fields]
    body = F.struct(
        F.format_string("name:%s;lsn:%d", "source.name", "source.lsn").alias("id"), F.lit(f"{source_prefix}/{connector}/{server}").alias("source"), F.lit("1.0").alias("specversion"),
        F.lit(f"{type_prefix}.{connector}.DataChangeEvent").alias("type"), F.date_format(F.timestamp_millis("source.ts_ms"), "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'").alias("time"), F.lit("application/json").alias("datacontenttype"),
        F.col("op").alias(extension + "op"), *ext, F.struct("before", "after").alias("data"),
    )
    return events.select("seq", F.to_json(body).alias("value"))


def embed(rows: DataFrame, field: str, into: str = "embedding", dimensions: int = 16, model=None) -> DataFrame:
    """Texts to vectors by a model (texts -> vectors); without one, a hashing vector of their words, normalised."""
    if model is None:
        words = F.filter(F.split(F.lower(F.coalesce(field, F.lit(""))), r"\W+"), lambda w: w != "")
        slots = F.transform(words, lambda w: F.conv(F.substring(F.md5(w.cast("binary")), 1, 8), 16, 10).cast("long") % dimensions)
        counts = F.transform(F.sequence(F.lit(0), F.lit(dimensions - 1)), lambda i: F.size(F.filter(slots, lambda s: s == i)).cast("float"))
        norm = F.sqrt(F.aggregate(counts, F.lit(0.0), lambda a, x: a + x * x))
        return rows.withColumn(into, F.transform(counts, lambda x: F.when(norm > 0, (x / norm).cast("float")).otherwise(F.lit(0.0).cast("float"))))

    @F.pandas_udf("array<float>")
    def run(texts):
        import pandas as pd

        return pd.Series([list(map(float, v)) for v in model(texts.fillna("").tolist())])

    return rows.withColumn(into, run(F.col(field)))


def plain_text(c: Column) -> Column:
    """Markup stripped from HTML (a local stand-in for document conversion)."""
    bare = F.regexp_replace(F.regexp_replace(c, r"(?is)<script\b.*?</script>|<style\b.*?</style>", " "), r"(?s)<[^>]*>", " ")
    return F.trim(F.regexp_replace(bare, r"\s+", " "))


def offload(rows: DataFrame, column: str, path: str, key: str, longest: int) -> DataFrame:
    """Values above a size go to Parquet under ``path``; the row keeps a reference to them."""
    large = F.octet_length(column) > longest
    rows.where(large).select(F.sha2(F.col(column).cast("binary"), 256).alias("ref"), F.col(key), F.col(column).alias("payload")).write.mode("append").parquet(path)
    return rows.withColumn(f"{column}_ref", F.when(large, F.sha2(F.col(column).cast("binary"), 256))).withColumn(column, F.when(~large, F.col(column)))
