"""Column functions: masks, encodings, numbers, decimals, temporal encodings, type handling.

Each takes and gives Columns, stays inside generated code, and leaves nulls null unless said otherwise.
"""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def mask(n: int) -> Column:
    """``n`` stars, for nulls as well."""
    return F.lit("*" * n)


def _digest(data: Column, algorithm: str) -> Column:
    name = algorithm.upper().replace("-", "")
    return F.md5(data) if name == "MD5" else F.sha1(data) if name in ("SHA", "SHA1") else F.sha2(data, int(name.removeprefix("SHA")))


def hash_mask(c: Column, algorithm: str, salt: str, length: int | None = None) -> Column:
    """Hex digest of salt and text, cut to the column's declared length."""
    out = _digest(F.concat(F.lit(salt).cast("binary"), c.cast("string").cast("binary")), algorithm)
    return F.substring(out, 1, length) if length and length > 0 else out


def hash_mask_v1(c: Column, algorithm: str, salt: str, length: int | None = None) -> Column:
    """The older digest, over salt and the JVM's serialized form of a text (its long form from 64 KiB on).

    NUL and characters beyond the basic plane, which that form writes in bytes of its own, are an error.
    """
    text = c.cast("string")
    text = F.when(text.rlike(r"[\x{0}\x{10000}-\x{10FFFF}]"), F.raise_error(F.lit("hash_mask_v1: a character without a plain form")).cast("string")).otherwise(text)
    raw = text.cast("binary")
    long = F.octet_length(raw) > 0xFFFF
    head = F.when(long, F.concat(F.lit("ACED00057C"), F.lpad(F.hex(F.octet_length(raw)), 16, "0"))).otherwise(F.concat(F.lit("ACED000574"), F.lpad(F.hex(F.octet_length(raw)), 4, "0")))
    out = _digest(F.concat(F.lit(salt).cast("binary"), F.unhex(head), raw), algorithm)
    return F.substring(out, 1, length) if length and length > 0 else out


def truncate(c: Column, n: int, declared: int = -1) -> Column:
    """The first ``n`` characters, if the column may be longer."""
    return F.substring(c, 1, n) if declared < 0 or declared > n else c


def first_rule(rows: DataFrame, table: str, rules: list[tuple[str, Callable[[Column], Column]]]) -> DataFrame:
    """Applies to each column the first rule whose pattern matches ``table.column``."""
    out = []
    for c in rows.columns:
        f = next((f for p, f in rules if re.fullmatch(p, f"{table}.{c}", re.I)), None)
        out.append(f(F.col(c)).alias(c) if f else F.col(c))
    return rows.select(*out)


def with_source_types(rows: DataFrame, table: str, patterns: list[str], declared: dict[str, dict] | None = None) -> DataFrame:
    """Attaches source type, length and scale as metadata to the columns that a pattern matches."""
    out = []
    for f in rows.schema:
        meta = {"source.column.type": f.dataType.simpleString().upper(), "source.column.name": f.name} | (declared or {}).get(f.name, {})
        out.append(F.col(f.name).alias(f.name, metadata=meta) if any(re.fullmatch(p, f"{table}.{f.name}", re.I) for p in patterns) else F.col(f.name))
    return rows.select(*out)


def binary_as(c: Column, mode: str) -> Column:
    """bytes, base64, base64-url-safe or hex."""
    text = F.regexp_replace(F.base64(c), r"\s", "")
    return {"bytes": c, "base64": text, "base64-url-safe": F.translate(text, "+/", "-_"), "hex": F.lower(F.hex(c))}[mode]


def bits(c: Column, length: int) -> Column:
    """A text of 0 and 1: boolean for one bit, else little-endian bytes."""
    if length == 1:
        return c == "1"
    width = -(-length // 8) * 8
    padded = F.lpad(c, width, "0")
    return F.concat(*[F.unhex(F.lpad(F.conv(F.substring(padded, width - 8 * (i + 1) + 1, 8), 2, 16), 2, "0")) for i in range(width // 8)])


def widened(c: Column, kind: str) -> Column:
    """To the type that carries a source type; values that don't fit are null."""
    return c.try_cast({"tinyint": "smallint", "smallint": "smallint", "integer": "int", "bigint": "bigint", "real": "float", "float": "double", "double": "double"}[kind])


def decimal_as(c: Column, mode: str, precision: int = 38, scale: int = 10) -> Column:
    """precise, string or double."""
    return {"precise": c.cast(f"decimal({precision},{scale})"), "string": c.cast("string"), "double": c.cast("double")}[mode]


def special_decimal(c: Column) -> Column:
    """``{value, special}``: NaN and infinities are named, not numbers."""
    special = F.when(F.isnan(c), "NAN").when(c == float("inf"), "POSITIVE_INFINITY").when(c == float("-inf"), "NEGATIVE_INFINITY")
    return F.struct(F.when(special.isNull(), c).cast("decimal(38,10)").alias("value"), special.alias("special"))


def unsigned(c: Column, width: int) -> Column:
    """A signed value of ``width`` bits read as unsigned."""
    wide = c.cast("decimal(20,0)") if width == 64 else c.cast("long")
    return F.when(wide < 0, wide + F.lit(str(2**width)).cast("decimal(20,0)" if width == 64 else "long")).otherwise(wide)


def epoch(ts: Column, unit: str = "ms") -> Column:
    """Wall-clock time as if it were UTC, since 1970 in ms, us or ns."""
    us = F.unix_micros(ts.cast("timestamp"))
    return {"ms": F.floor(us / 1000).cast("long"), "us": us, "ns": us * 1000}[unit]


def time_of_day(ts: Column, unit: str = "us") -> Column:
    """Time past midnight in ms, us or ns."""
    us = F.pmod(F.unix_micros(ts.cast("timestamp")), F.lit(86_400_000_000))
    return {"ms": F.floor(us / 1000).cast("long"), "us": us, "ns": us * 1000}[unit]


def in_day(c: Column, unit: str = "us") -> Column:
    """Null where a time of day is negative or beyond 24 hours."""
    return F.when(c.between(0, {"ms": 86_400_000, "us": 86_400_000_000, "ns": 86_400_000_000_000}[unit]), c)


def epoch_days(c: Column) -> Column:
    return F.unix_date(c.cast("date"))


def iso(c: Column, kind: str) -> Column:
    """date, time or timestamp as ISO text in UTC."""
    return F.date_format(c, {"date": "yyyy-MM-dd'Z'", "time": "HH:mm:ss'Z'", "timestamp": "yyyy-MM-dd'T'HH:mm:ss'Z'"}[kind])


def structured(ts: Column) -> Column:
    """A timestamp's parts."""
    parts = [("year", F.year(ts)), ("month", F.month(ts)), ("day", F.day(ts)), ("hour", F.hour(ts)), ("minute", F.minute(ts)), ("second", F.second(ts)), ("nano", (F.pmod(F.unix_micros(ts.cast("timestamp")), F.lit(1_000_000)) * 1000).cast("int"))]
    return F.struct(*[v.alias(n) for n, v in parts])


def zoned(ts: Column, zone: str = "UTC") -> Column:
    """ISO text with the zone's offset at that instant."""
    local = F.from_utc_timestamp(ts, zone)
    offset = F.floor((F.unix_micros(local.cast("timestamp")) - F.unix_micros(ts.cast("timestamp"))) / 60_000_000)
    sign, size = F.when(offset < 0, "-").otherwise("+"), F.abs(offset)
    text = F.concat(sign, F.lpad(F.floor(size / 60).cast("string"), 2, "0"), F.lit(":"), F.lpad((size % 60).cast("string"), 2, "0"))
    return F.concat(F.date_format(local, "yyyy-MM-dd'T'HH:mm:ss"), F.when(offset == 0, "Z").otherwise(text))


def shifted_epoch(ms: Column, zone: str) -> Column:
    """Epoch milliseconds that stand for wall-clock time in ``zone`` -> true epoch (in an overlap the earlier offset)."""
    return F.unix_millis(F.to_utc_timestamp(F.timestamp_millis(ms), zone))


def source_epoch(ms: Column, zone: str) -> Column:
    """Source positions go the other way: the zone's offset is added."""
    return F.unix_millis(F.from_utc_timestamp(F.timestamp_millis(ms), zone))


def zero_date(c: Column) -> Column:
    """Zero dates (0000-00-00) as null."""
    return F.when(c.startswith("0000-00-00"), None).otherwise(c).try_cast("timestamp")


def tinyint_as_boolean(c: Column) -> Column:
    return c != 0


def arithmetic(op: str, a: Column, b: Column) -> Column:
    """Over any numeric types, by the engine's own promotion; division by zero is null."""
    return {"+": lambda: a + b, "-": lambda: a - b, "*": lambda: a * b, "/": lambda: F.try_divide(a, b), "%": lambda: F.when(b != 0, a % b)}[op]()


def json_path(c: Column, path: str) -> Column:
    return F.get_json_object(c, path)


def default_value(text: str | None, kind: str) -> Column:
    """A default written in DDL, typed."""
    if text is None or text.strip().upper() == "NULL":
        return F.lit(None).cast(kind)
    return F.lit(re.sub(r"^'(.*)'$", r"\1", text.strip(), flags=re.S).replace("''", "'")).try_cast(kind)


#: A quoted text in which a backslash takes the next character as it is.
_QUOTED = r'"(?:[^"\\]|\\.)*"'


def _unquoted(x: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(x, r'(?s)^"(.*)"$', "$1"), r"(?s)\\(.)", "$1")


def hstore(c: Column) -> Column:
    """``"a"=>"1", "b"=>NULL`` as a map; backslashes before quotes and backslashes go, in keys and values."""
    pair = rf"(?s)({_QUOTED})\s*=>\s*({_QUOTED}|NULL)"
    keys, values = (F.regexp_extract_all(c, F.lit(pair), F.lit(k)) for k in (1, 2))
    return F.map_from_arrays(F.transform(keys, _unquoted), F.transform(values, lambda v: F.when(v != "NULL", _unquoted(v))))


def money(c: Column) -> Column:
    """Currency text as a decimal; brackets are negative."""
    digits = F.regexp_replace(c, r"[^0-9.\-]", "").cast("decimal(19,2)")
    return F.when(c.rlike(r"^\(.*\)$"), -digits).otherwise(digits)


#: Arrays inside arrays that are told apart.
ARRAY_LEVELS = 6


def pg_array(c: Column) -> Column:
    """``{a,"b, c",NULL}`` as an array of text; quoted items keep commas and are never null.

    The items of an array of arrays are arrays in their text form, for this function again (up to ARRAY_LEVELS deep).
    """
    inner = r"\{[^{}]*\}"
    for _ in range(ARRAY_LEVELS - 1):
        inner = rf"\{{(?:{_QUOTED}|[^{{}}\"]|{inner})*\}}"
    items = F.regexp_extract_all(F.regexp_replace(c, r"(?s)^\{|\}$", ""), F.lit(rf"(?s){_QUOTED}|{inner}|[^,]+"), F.lit(0))
    plain = lambda x: F.when(x.startswith("{"), x).otherwise(_unquoted(x))
    return F.transform(items, lambda x: F.when(x.startswith('"') | (F.upper(x) != "NULL"), plain(x)))


def pg_range(c: Column) -> Column:
    """``[a,b)`` and the like as ``{lower, upper, lower_inclusive, upper_inclusive, empty}``; a missing bound is null."""
    part = lambda k: F.nullif(F.regexp_replace(F.regexp_extract(c, r'^[\[(]\s*("(?:[^"])*"|[^,]*),\s*("(?:[^"])*"|[^\])]*)[\])]$', k), '^"|"$', ""), F.lit(""))
    return F.when(c.isNotNull(), F.struct(part(1).alias("lower"), part(2).alias("upper"), c.startswith("[").alias("lower_inclusive"), c.endswith("]").alias("upper_inclusive"), (c == "empty").alias("empty")))


def duration_iso(us: Column) -> Column:
    """Microseconds as an ISO-8601 duration in seconds; a negative one has its sign before the seconds."""
    size = F.abs(us)
    return F.concat(F.lit("PT"), F.when(us < 0, "-").otherwise(""), F.format_string("%d.%06dS", F.floor(size / 1_000_000).cast("long"), size % 1_000_000))
