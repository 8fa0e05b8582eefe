"""Where an event goes: topics by content or pattern, partitions by hash, the outbox pattern, names."""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def by_content(events: DataFrame, expression: str, topic: str | None = None) -> DataFrame:
    """The topic is what the SQL expression gives; null keeps the present one.  ``topic`` gates by pattern."""
    new = F.coalesce(F.expr(expression).cast("string"), F.col("topic"))
    return events.withColumn("topic", F.when(F.col("topic").rlike(f"^(?:{topic})$"), new).otherwise(F.col("topic")) if topic else new)


def logical_table(events: DataFrame, pattern: str, replacement: str, key_field: str = "__source", key_pattern: str | None = None, key_replacement: str | None = None) -> DataFrame:
    """Routes shards of one logical table to one topic; the old topic (or a part of it) joins the key so that keys stay unique."""
    hit = F.col("topic").rlike(f"^(?:{pattern})$")
    mark = F.regexp_replace("topic", f"^(?:{key_pattern})$", key_replacement) if key_pattern else F.col("topic")
    return events.withColumn(key_field, F.when(hit, mark)).withColumn("topic", F.when(hit, F.regexp_replace("topic", f"^(?:{pattern})$", replacement)).otherwise(F.col("topic")))


def wrap32(x: Column) -> Column:
    """A long reduced to a signed 32-bit integer (as a long)."""
    low = x.bitwiseAND(F.lit(0xFFFFFFFF))
    return F.when(low >= 1 << 31, low - (1 << 32)).otherwise(low)


def utf16_units(c: Column) -> Column:
    """The UTF-16 units of a text as four hexadecimal digits each; characters beyond the BMP have two."""
    return F.regexp_extract_all(F.lower(F.hex(F.encode(c, "UTF-16BE"))), F.lit("[0-9a-f]{4}"), F.lit(0))


def java_hash(c: Column, kind: str) -> Column:
    """The hash that a JVM gives a value of this SQL type, as a long; text by its UTF-16 units."""
    if kind in ("tinyint", "smallint", "int", "date"):
        return c.cast("long")
    if kind == "bigint":
        return wrap32(c.bitwiseXOR(F.shiftrightunsigned(c, 32)))
    if kind == "boolean":
        return F.when(c, 1231).otherwise(1237).cast("long")
    if kind == "string":
        return F.aggregate(utf16_units(c), F.lit(0).cast("long"), lambda acc, unit: wrap32(acc * 31 + F.conv(unit, 16, 10).cast("long")))
    raise ValueError(f"no hash for {kind}")


# Fixed values of the hash: seed, start of both halves, multipliers, steps of the halves and multipliers, finish.
SEED = 9001
HALVES = (0x9368E53C2F6AF274, 0x586DCD208F7CD3FD)
MULTIPLIERS = (0x87C37B91114253D5, 0x4CF5AD432745937F)
HALF_STEPS = (0x52DCE729, 0x38495AB5)
MULTIPLIER_STEPS = (0x7B7D159C, 0x6BCE6396)
FINISH = (0xFF51AFD7ED558CCD, 0xC4CEB9FE1A85EC53)


def _turned(x: np.ndarray, bits: int) -> np.ndarray:
    return x << np.uint64(bits) | x >> np.uint64(64 - bits)


def murmur3_of(values: list[bytes]) -> np.ndarray:
    """MurmurHash3 (the early variant of 128 bits for 64-bit machines) of each value: the upper half of its first word.

    A block of 16 bytes is mixed for all values that reach so far at once, the longest first; the arithmetic of numpy's
    unsigned words wraps around as the hash needs.  The bytes of an incomplete block have signs, which reach over the bytes that follow.
    """
    size = np.array([len(v) for v in values], "int64")
    order = np.argsort(-size, kind="stable")
    start, size = (np.cumsum(size) - size)[order], size[order]
    data = np.frombuffer(b"".join(values) + bytes(16), "uint8")
    h1, h2 = (np.full(len(values), x ^ SEED, "uint64") for x in HALVES)
    c1, c2 = MULTIPLIERS
    place, reach = np.arange(16), np.searchsorted(-size, -np.arange(0, int(size.max(initial=0)), 16), side="left")
    for i, n in enumerate(reach):  # the first n values are longer than 16 * i bytes
        block = data[(start[:n] + 16 * i)[:, None] + place]
        words = block.view("<u8").astype("uint64")
        short = np.searchsorted(-size[:n], -16 * (i + 1), side="right")  # from here on the block is incomplete
        if short < n:
            byte = np.where(place < (size[short:n] - 16 * i)[:, None], block[short:], 0).astype("int8").astype("int64") << place % 8 * 8
            words[short:] = np.bitwise_xor.reduce(byte.reshape(-1, 2, 8), axis=2).view("uint64")
        m1, m2 = np.uint64(c1), np.uint64(c2)
        a = (h1[:n] ^ _turned(words[:, 0] * m1, 23) * m2) + h2[:n]
        b = (_turned(h2[:n], 41) ^ _turned(words[:, 1] * m2, 23) * m1) + a
        h1[:n], h2[:n] = (x * np.uint64(3) + np.uint64(s) for x, s in zip((a, b), HALF_STEPS))
        c1, c2 = ((c * 5 + s) % (1 << 64) for c, s in zip((c1, c2), MULTIPLIER_STEPS))
    h2 ^= size.astype("uint64")
    h1 += h2
    h2 += h1
    for h in (h1, h2):
        for factor in FINISH:
            h ^= h >> np.uint64(33)
            h *= np.uint64(factor)
        h ^= h >> np.uint64(33)
    out = np.empty(len(values), "int64")
    out[order] = ((h1 + h2) >> np.uint64(32)).astype("uint32").view("int32")
    return out


def murmur3(c: Column, kind: str) -> Column:
    """``murmur3_of`` a column, as a long: texts as UTF-8, binary values as they are, other types by the four bytes of their JVM hash.

    It goes through Arrow: as a Column, with products of 64 bits put together from halves, it took 350 microseconds a value.
    """

    @F.pandas_udf("long")
    def hashed(values: pd.Series) -> pd.Series:
        some = values.notna()
        if kind == "string":
            values = [v.encode() for v in values[some]]
        elif kind == "binary":
            values = [bytes(v) for v in values[some]]
        else:
            values = [v.to_bytes(4, "little", signed=True) for v in values[some].astype("int64").tolist()]
        out = pd.Series(np.nan, some.index).astype("Int64")
        out[some] = murmur3_of(values)
        return out

    return hashed(c if kind in ("string", "binary") else java_hash(c, kind))


def to_partition(events: DataFrame, fields: list[str], partitions: int, function: str = "java") -> DataFrame:
    """Adds ``partition``: the sum of the fields' hashes without its sign, modulo the number of partitions.

    ``change.x`` is ``after.x``, or ``before.x`` for deletes; null fields add nothing; a row without any of
    them has no partition.
    """
    total, some = F.lit(0).cast("long"), F.lit(False)
    for f in fields:
        side, _, name = f.partition(".")
        c = F.when(F.col("op") == "d", F.col(f"before.{name}")).otherwise(F.col(f"after.{name}")) if side == "change" else F.col(f)
        kind = events.select(c.alias("x")).schema[0].dataType.simpleString()
        h = java_hash(c, kind) if function == "java" else murmur3(c, kind)
        total, some = total + F.coalesce(h, F.lit(0)), some | c.isNotNull()
    low = total.bitwiseAND(F.lit(0x7FFFFFFF))
    return events.withColumn("partition", F.when(some, (F.when(low == 0x7FFFFFFF, 0).otherwise(low) % partitions).cast("int")))


@dataclass(frozen=True)
class Outbox:
    """Columns of an outbox table and how they become messages.  ``placements``: ``column -> header|envelope|partition``."""

    event_id: str = "id"
    key: str = "aggregateid"
    event_type: str = "type"
    payload: str = "payload"
    timestamp: str | None = None
    route_by: str = "aggregatetype"
    topic_pattern: str = "(.*)"
    topic_replacement: str = "outbox.event.$1"
    placements: tuple[tuple[str, str], ...] = ()
    tombstone_on_empty: bool = False
    on_update: str = "warn"
    expand_schema: str | None = None


def outbox(events: DataFrame, how: Outbox = Outbox()) -> DataFrame:
    """Messages of an outbox table: inserts only; deletes are dropped; updates are dropped or fail."""
    keep = F.col("op").isin("c", "r")
    if how.on_update == "fatal":  # one predicate, or the optimizer may drop the row before it fails
        keep = F.when(F.col("op") == "u", F.raise_error(F.lit("update in an outbox table")).cast("boolean")).otherwise(keep)
    events = events.where(keep)
    col = lambda name: F.col(f"after.{name}")
    payload = F.from_json(col(how.payload), how.expand_schema) if how.expand_schema else col(how.payload)
    envelope = [(c, p) for c, p in how.placements if p == "envelope"]
    value = F.struct(payload.alias("payload"), *[col(c).alias(c) for c, _ in envelope]) if envelope else payload
    if how.tombstone_on_empty:
        value = F.when(col(how.payload).isNotNull() & (F.length(F.trim(col(how.payload))) > 0), value)
    headers = F.create_map(F.lit("id"), col(how.event_id).cast("string"), *[x for c, p in how.placements if p == "header" for x in (F.lit(c), col(c).cast("string"))])
    topic = F.regexp_replace(col(how.route_by), f"^{how.topic_pattern}$", how.topic_replacement)
    ts = col(how.timestamp) if how.timestamp else F.col("ts_ms")
    parts = [col(c).alias("partition") for c, p in how.placements if p == "partition"]
    return events.select("seq", topic.alias("topic"), col(how.key).alias("key"), value.alias("value"), headers.alias("headers"), ts.alias("ts_ms"), *parts)


def outbox_documents(events: DataFrame, schema: str, how: Outbox = Outbox()) -> DataFrame:
    """The outbox of a document store: ``after`` is a JSON document with the outbox's fields."""
    return outbox(events.withColumn("after", F.from_json("after", schema)), how)


def hypertables(events: DataFrame, chunks: DataFrame) -> DataFrame:
    """Chunk tables take the name of their hypertable (``chunk_table, hypertable``: a small catalog table that AQE broadcasts by its size)."""
    return events.join(chunks, events["tbl"] == chunks["chunk_table"], "left").withColumn("tbl", F.coalesce("hypertable", "tbl")).drop("chunk_table", "hypertable")


def topic_name(prefix: str, *parts: Column, delimiter: str = ".", longest: int = 249) -> Column:
    """``prefix.schema.table`` with characters that topics can't hold replaced."""
    return F.substring(F.regexp_replace(F.concat_ws(delimiter, F.lit(prefix), *parts), r"[^A-Za-z0-9._\-]", "_"), 1, longest)


def unicode_escaped(name: Column) -> Column:
    """Characters that Avro names can't hold as ``_uXXXX``, one for each UTF-16 unit; the underscore itself too."""
    escaped = lambda ch: F.concat(F.lit("_u"), F.array_join(utf16_units(ch), "_u"))
    one = lambda ch: F.when(ch.rlike("[A-Za-z0-9.\\-]"), ch).otherwise(escaped(ch))
    return F.array_join(F.transform(F.filter(F.split(name, ""), lambda x: x != ""), one), "")


def named_topic(strategy: str, prefix: str, catalog: Column, schema: Column, table: Column, pattern: str = "", replacement: str = "", partitions: bool = False) -> Column:
    """A table's topic by a strategy: ``default`` or ``schema``, plain or with ``_regex`` or ``_unicode`` behind it.

    ``default`` leaves the schema out and ``schema`` the catalog, unless one task reads several databases (``partitions``).
    A regular expression has to match the whole name; a name that it would make empty stays.
    """
    kind, _, how = strategy.partition("_")
    if kind not in ("default", "schema") or how not in ("", "regex", "unicode"):
        raise ValueError(f"no topic naming strategy {strategy}")
    parts = [catalog, schema, table] if partitions and kind == "schema" else [catalog if kind == "default" else schema, table]
    if how == "unicode":
        return unicode_escaped(F.concat_ws(".", F.lit(prefix), *parts))
    name = topic_name(prefix, *parts)
    if not how:
        return name
    new = F.regexp_replace(name, f"^(?:{pattern})$", replacement)
    return F.when(new == "", name).otherwise(new)


def collection_name(fmt: str, topic: Column, source: dict[str, Column] | None = None) -> Column:
    """``${topic}`` (dots become underscores) and ``${source.x}`` filled in."""
    parts = []
    for piece in re.split(r"(\$\{[^}]+\})", fmt):
        if piece == "${topic}":
            parts.append(F.replace(topic, F.lit("."), F.lit("_")))
        elif m := re.fullmatch(r"\$\{source\.(\w+)\}", piece):
            parts.append((source or {})[m[1]].cast("string"))
        elif piece:
            parts.append(F.lit(piece))
    return F.concat(*parts)


def name_words(name: str) -> list[str]:
    """The words of a name: runs of letters of any alphabet, cut where a capital begins a word, and runs of digits; other characters part words."""
    kinds = "".join("d" if ch.isdigit() else "U" if ch.isupper() else "l" if ch.isalpha() else " " for ch in name)
    return [name[m.start() : m.end()] for m in re.finditer(r"U+(?!l)|U?l+|d+", kinds)]


def styled(name: str, style: str = "default", prefix: str = "", suffix: str = "") -> str:
    """Sink names: snake_case, camelCase, UPPER_CASE, lower_case or unchanged, then prefix and suffix."""
    words = name_words(name)
    out = {
        "default": lambda: name,
        "snake_case": lambda: "_".join(w.lower() for w in words),
        "camel_case": lambda: "".join(w.lower() if i == 0 else w.capitalize() for i, w in enumerate(words)),
        "upper_case": name.upper,
        "lower_case": name.lower,
    }[style]()
    return prefix + out + suffix


def restyled(rows: DataFrame, style: str = "default", prefix: str = "", suffix: str = "") -> DataFrame:
    return rows.toDF(*[styled(c, style, prefix, suffix) for c in rows.columns])


def avro_name(name: str, replacement: str = "_") -> str:
    """A name that starts with a letter or underscore and goes on with these and digits."""
    fixed = re.sub(r"[^A-Za-z0-9_]", replacement, name)
    return fixed if re.match(r"[A-Za-z_]", fixed) else replacement + fixed


def sink_key(events: DataFrame, mode: str, fields: list[str] = ()) -> list[str]:
    """Columns of a sink's primary key: none, the log position, the record key or chosen value fields."""
    names = [f.name for f in events.schema["after"].dataType.fields]
    chosen = [f for f in fields if f in names]
    return {"none": [], "kafka": ["__topic", "__partition", "__offset"], "record_key": chosen or names[:1], "record_value": chosen or names, "record_header": chosen}[mode]
