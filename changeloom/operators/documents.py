"""Documents that change by parts: ordered partial updates folded path by path.

An event holds a whole JSON document (``after``), or what an update did: ``updated_fields`` (a JSON object of dotted paths
and their new values), ``removed_fields`` (dotted paths) and ``truncated_arrays`` (``field`` and its new ``size``).  Each event becomes
writes of single paths.  A write of a path voids what stood there and below; of each path the last write counts, and it stands unless
a later event voids the path itself or one above it, or cuts the array that it is in.

The fold is one shuffle of the events by key, as they are: paths and documents of a key come into being, and meet, at one place, in so many partitions that
each holds a bounded number of events.  There the writes are sorted once, by key and path in the order of the document: the last writes of a path, the voids and
cuts above it and the text of a document are each found in one pass in that order.  Keys with very many events go another way: their writes are reduced to one a path before
they are shuffled, so they send their distinct paths.  There is no Python in it.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

#: Levels of nesting whose paths are told apart; deeper values are kept whole, as JSON.
DEPTH = 4
#: Events of one partition of the fold, about, and events above which a key's writes are reduced before the shuffle.
PARTITION_EVENTS, HOT_EVENTS = 50_000, 100_000
#: Slots of keys' hashes in which events are counted first.
SLOTS = 65_536
#: What a node holds that has children.
OBJECT, ARRAY = "{}", "[]"


def _expanded(rows: DataFrame, column: str, depth: int) -> DataFrame:
    """Each node of the JSON values in ``column`` (``path, v``: where it stands and the value), down to ``depth``, as ``path, value``.

    One generator for all levels: the nodes of a value are put together before they become rows.
    """
    nobody = F.array().cast("array<struct<key:string,value:variant>>")
    began = F.col(f"{column}.path")

    def nodes(names: list[Column], v: Column) -> Column:
        node = lambda value: F.array(F.struct(F.array(*names).cast("array<string>").alias("below"), value.alias("value")))
        if len(names) == depth:
            return node(F.to_json(v))
        # children are taken once and tell the kind: a value that is no object, or no array, gives null
        open_ = F.size(began) + len(names) < depth
        fields = F.map_entries(F.when(open_, F.try_variant_get(v, "$", "map<string,variant>")))
        items = F.transform(F.when(open_, F.try_variant_get(v, "$", "array<variant>")), lambda x, i: F.struct(i.cast("string").alias("key"), x.alias("value")))

        def met(c: Column) -> Column:
            kind = F.when(c["fields"].isNotNull(), OBJECT).when(c["items"].isNotNull(), ARRAY).otherwise(F.to_json(v))
            children = F.transform(F.coalesce(c["fields"], c["items"], nobody), lambda e: nodes([*names, e["key"]], e["value"]))
            return F.flatten(F.array(node(kind), F.flatten(children)))

        # a transform of one element, so that children have a name and are not taken again
        return F.flatten(F.transform(F.array(F.struct(fields.alias("fields"), items.alias("items"))), met))

    rest = [c for c in rows.columns if c != column]
    # no explode, whose filter of empty arrays would put all nodes together once more
    out = rows.select(*rest, began.alias("path"), F.explode_outer(nodes([], F.col(f"{column}.v"))).alias("n"))
    return out.select(*rest, F.concat("path", "n.below").alias("path"), "n.value")


def writes(events: DataFrame, keys: list[str], depth: int = DEPTH) -> DataFrame:
    """``keys, path, at, kind, value, pos``: what each event writes.

    Kinds: ``v`` voids a path and all below, ``c`` cuts an array at ``pos``, ``n`` is a node (JSON, or the kind of a container), ``p`` a parent that a
    dotted path implies.  ``at`` orders events, and cuts before writes inside one.  An update of a path below ``depth`` is an error.
    """
    have = set(events.columns)
    given = lambda c, kind: F.col(c) if c in have else F.lit(None).cast(kind)
    at = F.col("seq") * 2
    whole = F.when(given("after", "string").isNotNull() | (F.col("op") == "d"), F.array().cast("array<string>"))
    sets = F.map_entries(F.try_variant_get(F.try_parse_json(given("updated_fields", "string")), "$", "map<string,variant>"))
    none = F.array().cast("array<struct<path:array<string>,v:variant>>")
    values = F.concat(
        F.coalesce(F.when(given("after", "string").isNotNull(), F.array(F.struct(F.array().cast("array<string>").alias("path"), F.parse_json(given("after", "string")).alias("v")))), none),
        F.coalesce(F.transform(sets, lambda e: F.struct(F.split(e["key"], r"\.").alias("path"), e["value"].alias("v"))), none),
    )
    set_paths = F.coalesce(F.transform(sets, lambda e: F.split(e["key"], r"\.")), F.array().cast("array<array<string>>"))
    removed = F.coalesce(F.transform(given("removed_fields", "array<string>"), lambda p: F.split(p, r"\.")), F.array().cast("array<array<string>>"))
    cuts = F.coalesce(given("truncated_arrays", "array<struct<field:string,size:int>>"), F.array().cast("array<struct<field:string,size:int>>"))
    mark = lambda path, kind, pos, late: F.struct(path.alias("path"), F.lit(kind).alias("kind"), pos.cast("int").alias("pos"), F.lit(late).alias("late"))
    none_marks = F.array().cast("array<struct<path:array<string>,kind:string,pos:int,late:int>>")
    marks = F.concat(
        F.coalesce(F.when(whole.isNotNull(), F.array(mark(F.coalesce(whole, F.array().cast("array<string>")), "v", F.lit(-1), 1))), none_marks),
        F.transform(F.concat(set_paths, removed), lambda p: mark(p, "v", F.lit(-1), 1)),
        F.transform(cuts, lambda c: mark(F.split(c["field"], r"\."), "c", c["size"], 0)),
        # the parents that a dotted path implies
        F.flatten(F.transform(set_paths, lambda p: F.transform(F.sequence(F.lit(0), F.size(p) - 1), lambda k: mark(F.slice(p, F.lit(1), k), "p", F.lit(-1), 1)))),
    )
    base = events.select(*keys, at.alias("_at"), values.alias("_values"), marks.alias("_marks"))
    out = base.select(*keys, "_at", F.explode_outer("_marks").alias("m")).where("m is not null").select(*keys, "m.path", (F.col("_at") + F.col("m.late")).alias("at"), "m.kind", F.lit(None).cast("string").alias("value"), "m.pos")
    # elements of an array that is cut lie one level deeper
    deep = F.size("path") + (F.col("kind") == "c").cast("int") > depth
    out = out.withColumn("path", F.when(deep, F.raise_error(F.concat(F.lit("an update below the levels that are told apart: "), F.array_join("path", "."))).cast("array<string>")).otherwise(F.col("path")))
    nodes = _expanded(base.select(*keys, (F.col("_at") + 1).alias("at"), F.explode_outer("_values").alias("_n")).where("_n is not null"), "_n", depth)
    return out.unionByName(nodes.select(*keys, "path", "at", F.lit("n").alias("kind"), "value", F.lit(-1).alias("pos")))


def folded(events: DataFrame, keys: list[str], depth: int = DEPTH, partition_events: int = PARTITION_EVENTS, hot_events: int = HOT_EVENTS) -> DataFrame:
    """``keys, path, value``: the nodes of each key's present document, after all events in the order of ``seq``.

    ``path`` is an array (empty for the document itself); ``value`` is JSON, or ``{}`` and ``[]`` for what has (or had) children.  Keys whose last
    event deletes them are left out.  A JSON null is a value; an absent field has no row.
    """
    return _standing(events, keys, depth, partition_events, hot_events).select(*keys, _path(depth).alias("path"), "value")


def _standing(events: DataFrame, keys: list[str], depth: int, partition_events: int = PARTITION_EVENTS, hot_events: int = HOT_EVENTS) -> DataFrame:
    """:func:`folded` with the steps of the paths, in partitions by key that are sorted by key and steps."""
    slot = F.pmod(F.hash(*keys), F.lit(SLOTS))
    slots = events.groupBy(slot.alias("_slot")).agg(F.count(F.lit(1)).alias("_n"))
    total, most = slots.agg(F.sum("_n"), F.max("_n")).first()
    # all cores have work on few events too
    parts = max(events.sparkSession.sparkContext.defaultParallelism, -(-(total or 0) // partition_events))
    if (most or 0) > hot_events:  # keys are counted only where so many events share a slot
        full = slots.where(F.col("_n") > hot_events).select("_slot")
        per = events.join(F.broadcast(full), slot == F.col("_slot"), "left_semi").groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > hot_events)
        if not per.isEmpty():
            # at most one key in so many events
            hot = F.broadcast(per.select(*[F.col(k).alias(f"_h{i}") for i, k in enumerate(keys)]))
            on = F.lit(True)
            for i, k in enumerate(keys):
                on = on & F.col(k).eqNullSafe(F.col(f"_h{i}"))
            cold = _reduced(events.join(hot, on, "left_anti").repartition(parts, *keys), keys, depth)
            return _judged(cold, keys, depth).unionByName(_judged(_reduced(events.join(hot, on, "left_semi"), keys, depth).repartition(parts, *keys), keys, depth))
    return _judged(_reduced(events.repartition(parts, *keys), keys, depth), keys, depth)


def _steps(depth: int) -> list[str]:
    return [f"_p{level}" for level in range(depth)]


def _place(name: Column) -> Column:
    """A name as a place in an array, or null; only what looks like a number is cast, as each failure of a cast makes an exception."""
    return F.when((F.ascii(name) <= 57) & name.rlike(r"^[\x00-\x20\x7f]*[+-]?[0-9]+[\x00-\x20\x7f]*$"), name.try_cast("int"))


def _reduced(events: DataFrame, keys: list[str], depth: int) -> DataFrame:
    """One row a path and place that is cut: the last write of a node, of a parent that is implied, and of a void or cut.

    A path's steps are columns whose order is that of the document: places in arrays by number, behind the names.  What lies deeper is null, so a
    path stands before what is below it, and a cut (a place without a name) before the first place that it cuts.
    """
    at = lambda kind: F.max(F.when(F.col("kind") == kind, F.col("at")))

    def step(level: int) -> Column:
        name = F.get("path", F.lit(level))
        place = F.coalesce(F.when((F.col("kind") == "c") & (F.size("path") == level), F.col("pos")), _place(name))
        return F.when(place >= 0, F.concat(F.lit("1"), F.lpad(place.cast("string"), 10, "0"), F.coalesce(name, F.lit("")))).otherwise(F.concat(F.lit("0"), name))

    # the size of what a void or cut concerns
    w = writes(events, keys, depth).select(*keys, *[step(i).alias(c) for i, c in enumerate(_steps(depth))], F.size("path").cast("byte").alias("_size"), "at", "kind", "value")
    node = F.max(F.when(F.col("kind") == "n", F.struct("at", "value"))).alias("_node")
    return w.groupBy(*keys, *_steps(depth)).agg(F.max("_size").alias("_size"), node, at("p").alias("_parent"), F.greatest(at("v"), at("c")).alias("_void"))


def _judged(rows: DataFrame, keys: list[str], depth: int) -> DataFrame:
    """The nodes that no later event voids: one window by key, in the order of the steps."""
    steps = _steps(depth)
    so_far = W.partitionBy(*keys).orderBy(*steps).rowsBetween(W.unboundedPreceding, W.currentRow)
    void, size = F.col("_void"), F.col("_size")
    # of the voids and cuts of a level, so far, the latest of the last path: it concerns a row below that path, and no other path can
    met = [F.max(F.when((size == level) & void.isNotNull(), F.struct(*steps[:level], void.alias("at")))).over(so_far).alias(f"_v{level}") for level in range(depth)]
    rows = rows.select("*", *met)
    above = []
    for level in range(depth):
        same = F.lit(True)
        for c in steps[:level]:
            same = same & (F.col(f"_v{level}.{c}") == F.col(c))
        above.append(F.when(same, F.col(f"_v{level}.at")))
    last = F.greatest(void, *above)
    stands = lambda at: at.isNotNull() & (last.isNull() | (last <= at))
    value = F.when(stands(F.col("_node.at")), F.col("_node.value")).when(stands(F.col("_parent")), OBJECT)
    return rows.select(*keys, *steps, "_size", value.alias("value")).where("value is not null")


def _path(depth: int) -> Column:
    """The names of the steps."""
    return F.slice(F.array(*[F.when(F.col(c).startswith("1"), F.substring(c, 12, 1 << 30)).otherwise(F.substring(c, 2, 1 << 30)) for c in _steps(depth)]), F.lit(1), F.col("_size").cast("int"))


def documents(events: DataFrame, keys: list[str], depth: int = DEPTH) -> DataFrame:
    """``keys, document``: each key's present document as JSON, fields in the order of their names.

    The nodes stand in the order of the document, so each one's text is its own and the brackets that open or close before the next node.
    """
    rows, size = _standing(events, keys, depth), F.col("_size")
    order = W.partitionBy(*keys).orderBy(*_steps(depth))
    # the last node of a level, so far, is the one that a deeper node lies in
    so_far = order.rowsBetween(W.unboundedPreceding, W.currentRow)
    within = [F.last(F.when(size == level, F.col("value") == ARRAY), ignorenulls=True).over(so_far).alias(f"_w{level}") for level in range(depth)]
    rows = rows.select(*keys, *_steps(depth), "_size", "value", *within, F.row_number().over(order).alias("_at"), F.lag(size).over(order).alias("_before"), F.coalesce(F.lead(size).over(order), F.lit(0)).alias("_after"))
    # texts are quoted in an array, whose brackets go
    name = F.concat(F.btrim(F.to_json(F.array(F.get(_path(depth), size.cast("int") - 1))), F.lit("[]")), F.lit(":"))
    listed = F.get(F.array(*[F.col(f"_w{level}") for level in range(depth)]), size.cast("int") - 1)
    text = F.concat(
        F.when((size > 0) & (F.col("_before") >= size), ",").otherwise(""),
        F.when((size > 0) & ~listed, name).otherwise(""),
        F.when(F.col("_after") <= size, F.col("value")).when(F.col("value") == ARRAY, "[").otherwise("{"),
        *[F.when((size > level) & (F.col("_after") <= level), F.when(F.col(f"_w{level}"), "]").otherwise("}")).otherwise("") for level in reversed(range(depth))],
    )
    parts = rows.select(*keys, F.struct("_at", text.alias("text")).alias("_t")).groupBy(*keys).agg(F.sort_array(F.collect_list("_t")).alias("_t"))
    return parts.select(*keys, F.array_join(F.col("_t.text"), "").alias("document"))


def current(events: DataFrame, keys: list[str], schema: str, depth: int = DEPTH) -> DataFrame:
    """The present documents as typed columns beside the key, as :func:`changeloom.operators.materialize.apply` takes them."""
    return documents(events, keys, depth).select(*keys, F.from_json("document", schema).alias("d")).select(*keys, "d.*")



def differences(rows: DataFrame, keys: list[str], before: str = "before", after: str = "after", depth: int = DEPTH) -> DataFrame:
    """``keys, path, kind, old, new``: where two JSON images of a row differ, node by node (``keys`` are unique).

    Kinds: ``add`` and ``remove`` of a node that one image lacks (all below it too), ``replace`` of a value, or of a kind of container.  A missing
    image has no nodes.  Both images are expanded where the row lies; a path's two sides meet in one aggregation.
    """
    side = lambda c, name: F.struct(F.array().cast("array<string>").alias("path"), F.try_parse_json(c).alias("v"), F.lit(name).alias("side"))
    both = F.filter(F.array(side(F.col(before), "old"), side(F.col(after), "new")), lambda x: x["v"].isNotNull())
    nodes = _expanded(rows.select(*keys, F.explode(both).alias("_i")).select(*keys, F.col("_i.side").alias("side"), F.struct("_i.path", "_i.v").alias("_i")), "_i", depth)
    of = lambda name: F.max(F.when(F.col("side") == name, F.col("value"))).alias(name)
    met = nodes.groupBy(*keys, "path").agg(of("old"), of("new")).where("old is distinct from new")
    return met.select(*keys, "path", F.when(F.col("old").isNull(), "add").when(F.col("new").isNull(), "remove").otherwise("replace").alias("kind"), "old", "new")


def inferred_types(rows: DataFrame, by: str, payload: str) -> dict[str, str]:
    """The type of the JSON payloads of each value of ``by``, widened over all of them: one aggregation, one short text a value."""
    found = rows.where(F.col(by).isNotNull()).groupBy(by).agg(F.schema_of_variant_agg(F.try_parse_json(payload)).alias("t")).collect()
    return {r[by]: _columns_of(r["t"]) for r in found}


def _columns_of(kind: str) -> str:
    """A variant's type as a type of columns: objects are structs; where all values are null, texts."""
    return re.sub(r"\bVOID\b", "STRING", kind.replace("OBJECT<>", "STRING").replace("OBJECT<", "STRUCT<"))


def typed_payloads(rows: DataFrame, by: str, payload: str, into: str = "value") -> dict[str, DataFrame]:
    """One frame for each value of ``by``, with the payload as a column of the type that all its payloads share; what isn't JSON is null."""
    return {name: rows.where(F.col(by) == name).withColumn(into, F.try_variant_get(F.try_parse_json(payload), "$", kind)) for name, kind in sorted(inferred_types(rows, by, payload).items())}
