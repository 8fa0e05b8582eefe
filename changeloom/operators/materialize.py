"""From a changelog to tables: reduction to the last change, truncate barriers, apply, schema evolution.

The work is one shuffle by key.  ``max_by`` reduces on the map side, so a key with very many changes
sends one row a task.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from changeloom.sources.shared import checkpointed

#: Rows of the log that one task puts in batches, about, and pieces whose ways are composed at once.
PIECE_ROWS, PIECE_FAN = 50_000, 64


def order_of(events: DataFrame) -> Column:
    return F.struct("seq", "sub") if "sub" in events.columns else F.struct("seq")


def row_key(keys: list[str]) -> list[Column]:
    return [F.coalesce(F.col(f"after.{k}"), F.col(f"before.{k}")).alias(k) for k in keys]


def after_truncates(events: DataFrame, table: str = "tbl") -> DataFrame:
    """Drops what a later truncate of the same table makes void, and the truncates."""
    last = events.where("op = 't'").groupBy(table).agg(F.max("seq").alias("_cut"))
    return events.where("op <> 't'").join(last, table, "left").where(F.col("_cut").isNull() | (F.col("seq") > F.col("_cut"))).drop("_cut")


def last_change(events: DataFrame, keys: list[str]) -> DataFrame:
    """The last change of each key: ``keys, op, after, seq``."""
    last = events.select(*row_key(keys), F.struct("op", "after", "seq").alias("_e"), order_of(events).alias("_at")).groupBy(*keys).agg(F.max_by("_e", "_at").alias("_e"))
    return last.select(*keys, "_e.op", "_e.after", "_e.seq")


def materialize(events: DataFrame, keys: list[str]) -> DataFrame:
    """Current state: the after image of each key whose last change isn't a delete."""
    return last_change(events, keys).where("op <> 'd'").select("after.*")


def apply(base: DataFrame, events: DataFrame, keys: list[str], mode: str = "upsert", delete_enabled: bool = False, truncate_enabled: bool = False) -> DataFrame:
    """``base`` after the changes, by insert, update or upsert.

    Deletes and truncates are ignored unless enabled; update skips keys that ``base`` doesn't hold;
    insert rejects keys that it does (``raise_error`` when the row is made); a row that consists of its
    key alone is left as it is.
    """
    if truncate_enabled:
        cut = events.where("op = 't'").agg(F.max("seq")).first()[0]
        if cut is not None:
            base, events = base.limit(0), events.where(F.col("seq") > cut)
    events = events.where(F.col("op") != "t")
    if not delete_enabled:
        events = events.where("op <> 'd'")
    last = last_change(events, keys).withColumnRenamed("op", "_op").withColumnRenamed("after", "_after").drop("seq")
    both = base.withColumn("_old", F.lit(True)).join(last, keys, "full_outer").where(F.col("_op").isNull() | (F.col("_op") != "d"))
    if mode == "update":
        both = both.where("_old")
    if mode == "insert":
        clash = F.col("_old") & F.col("_op").isNotNull()
        both = both.where(F.when(clash, F.raise_error(F.lit("insert: the key exists")).cast("boolean")).otherwise(True))
    have = {f.name for f in events.schema["after"].dataType.fields}
    # the side is chosen by the presence of a change, not by the value: an update to null must win
    pick = lambda c: F.when(F.col("_op").isNotNull(), F.col(f"_after.{c}")).otherwise(F.col(c)).alias(c) if c in have else F.col(c)
    return both.select(*[pick(c) if c not in keys else F.col(c) for c in base.columns])


def evolve(base: DataFrame, rows: DataFrame) -> DataFrame:
    """Union by name; columns that one side lacks are added to it as nulls."""
    return base.unionByName(rows, allowMissingColumns=True)


def missing_columns(base: DataFrame, rows: DataFrame) -> list[str]:
    """Columns that the target lacks, in the order of the source (names compare without case)."""
    have = {c.lower() for c in base.columns}
    return [c for c in rows.columns if c.lower() not in have]


def _follow(ways: list, began: int, batch: int) -> tuple[int, int]:
    """Where the open batch begins, and its number, behind a piece."""
    way = next((w for w in ways if w[0] >= began), None)
    return (int(way[1]), batch + int(way[2])) if way is not None else (began, batch)


def _shortest(ways: list) -> list:
    """Neighbours that lead to the same place as one."""
    out = []
    for way in ways:
        if out and out[-1][1:] == way[1:]:
            out.pop()
        out.append(way)
    return out


def _composed(first: int, pieces: list[list]) -> list:
    """The ways through pieces that follow one another, for batches that begin before ``first``."""
    out = []
    for ways in pieces:
        out = [[w[0], *_follow(ways, w[1], w[2])] for w in out]
        for w in ways:  # batches that no piece has ended so far
            if out and out[-1][0] >= first - 1:
                break
            if not out or w[0] > out[-1][0]:
                out.append([int(x) for x in w])
        out = _shortest(out)
    return out


def passthrough_batches(events: DataFrame, keys: list[str], table: str = "tbl", most: int | None = None, piece_rows: int = PIECE_ROWS, fan: int = PIECE_FAN) -> DataFrame:
    """Adds ``batch``: a batch ends before a key would repeat, before and after a truncate, or at ``most`` rows.

    The log is cut by position into pieces of some ``piece_rows`` rows.  What a batch that is open at the start of a piece
    becomes depends only on the place of its first row, so each piece tells where its last batch begins for every such place: a list of
    at most ``most`` ways (or the rows before a key repeats in it).  The lists of ``fan`` pieces that follow one another are composed into one, and so on up a tree;
    then each group hands the batch that is open at its start down to its pieces, and all pieces are numbered at once.
    The driver learns the number of pieces, nothing of their content.  Rows of equal position are told apart by operation and key.
    """
    at = [F.coalesce(F.col("seq"), F.lit((1 << 63) - 1)).alias("_s"), *([F.col("sub").alias("_sub")] if "sub" in events.columns else [])]
    keyed = events.select(F.col(table).alias("_t"), "seq", "op", F.concat_ws("|", *[c.cast("string") for c in row_key(keys)]).alias("_k"), *at)
    order = [*keyed.columns[4:], "op", "_k"]
    number = max(1, -(-keyed.count() // piece_rows))
    # written down, so that bounds and numbers of pieces stay what they are when a task is run again
    keyed = checkpointed(keyed.repartitionByRange(number, "_t", *order).withColumn("_p", F.spark_partition_id().cast("long")))
    here = W.partitionBy("_t").orderBy("_p")  # one row a piece
    sizes = keyed.groupBy("_t", "_p").agg(F.count(F.lit(1)).alias("n"), F.max_by("op", F.struct(*order)).alias("op"))
    starts = sizes.select(
        F.col("_t").alias("_u"), F.col("_p").alias("_q"), (F.row_number().over(here) - 1).cast("long").alias("_i"),
        F.coalesce(F.sum("n").over(here.rowsBetween(W.unboundedPreceding, -1)), F.lit(0)).alias("_first"), F.coalesce(F.lag("op").over(here) == "t", F.lag("_p").over(here).isNull()).alias("_forced"),
    )
    starts = checkpointed(starts)
    place = F.row_number().over(W.partitionBy("_t", "_p").orderBy(*order)) - 1
    ranked = keyed.select("_t", "_p", "_k", "seq", "op", place.cast("long").alias("_n")).join(starts, F.col("_t").eqNullSafe(F.col("_u")) & (F.col("_p") == F.col("_q")))
    ranked = ranked.select("_t", "_i", "_k", "seq", "op", (F.col("_n") + F.col("_first")).alias("_n"), "_forced")
    # the row before of the same key, where it stands in an earlier piece: one row a key and piece
    ends = ranked.groupBy("_t", "_i", "_k").agg(F.max("_n").alias("_n"))
    earlier = ends.select("_t", "_i", "_k", F.lag("_n").over(W.partitionBy("_t", "_k").orderBy("_i")).alias("_e")).where("_e is not null")
    earlier = earlier.select(F.col("_t").alias("_x"), F.col("_i").alias("_y"), F.col("_k").alias("_k"), "_e").groupBy("_x", "_y")

    def laid_out(rows, old):
        """The rows in order, the place of the first, each row's place of the same key before (or -1), and where a batch must begin."""
        rows = rows.sort_values("_n")
        first, known, prev = int(rows["_n"].iloc[0]), dict(zip(old["_k"], old["_e"].tolist())), []
        for i, k in enumerate(rows["_k"], first):
            prev.append(known.get(k, -1))
            known[k] = i
        cut = (rows["op"] == "t").tolist()
        return rows, first, prev, [a or b for a, b in zip(cut, [bool(rows["_forced"].iloc[0]), *cut])]

    def told(piece, rows, old):
        _, first, prev, cut = laid_out(rows, old)
        n, again = len(prev), {p: first + i for i, p in enumerate(prev)}
        end, count, last = first + n, [0] * n, list(range(first, first + n))
        until = end  # the end of a batch that begins at row i
        for i in range(n - 1, -1, -1):
            until = min(until, again.get(first + i, end), first + i + most if most else end)
            if until < end:
                count[i], last[i] = 1 + count[until - first], last[until - first]
            if cut[i]:
                until = first + i
        out, top = [], -2
        for i in range(n):
            # a batch that began at or before this place ends before row i
            reach = first - 1 if cut[i] else min(first - 1, max(prev[i], first + i - most if most else -1))
            if reach > top:
                top = reach
                out.append([top, last[i], 1 + count[i]])
            if top == first - 1:
                break
        return pd.DataFrame({"_t": [piece[0]], "_i": [piece[1]], "_first": [first], "ways": [_shortest(out)]})

    def up(group, below):
        below = below.sort_values("_i")
        first = int(below["_first"].iloc[0])
        return pd.DataFrame({"_t": [group[0]], "_i": [group[1]], "_first": [first], "ways": [_composed(first, [list(w) for w in below["ways"]])]})

    def down(group, below):
        below = below.sort_values("_i")
        state, out = (int(below["_began"].iloc[0]), int(below["_batch"].iloc[0])), []
        for ways in below["ways"]:
            out.append(state)
            state = _follow(list(ways), *state)
        return pd.DataFrame({"_t": [group[0]] * len(out), "_i": below["_i"].tolist(), "_began": [s[0] for s in out], "_batch": [s[1] for s in out]})

    listed, kinds = "_t string, _i long, _first long, ways array<array<long>>", "_t string, _i long, _began long, _batch long"
    parent = F.floor(F.col("_i") / fan)
    levels = [checkpointed(ranked.groupBy("_t", "_i").cogroup(earlier).applyInPandas(told, listed))]
    while number > fan:
        levels.append(checkpointed(levels[-1].groupBy("_t", parent.alias("_i")).applyInPandas(up, listed)))
        number = -(-number // fan)
    opened = levels[-1].select("_t", F.lit(0).alias("_i"), F.lit(-1).alias("_began"), F.lit(-1).alias("_batch")).distinct()
    for level in reversed(levels):
        above = opened.select(F.col("_t").alias("_u"), F.col("_i").alias("_j"), "_began", "_batch")
        opened = level.join(above, F.col("_t").eqNullSafe(F.col("_u")) & (parent == F.col("_j"))).drop("_u", "_j").groupBy("_t", parent).applyInPandas(down, kinds)
    opened = checkpointed(opened).withColumnsRenamed({"_t": "_u", "_i": "_j"})

    def run(piece, rows, old):
        rows, first, prev, cut = laid_out(rows, old)
        began, batch, out = int(rows["_began"].iloc[0]), int(rows["_batch"].iloc[0]), []
        for i, (p, c) in enumerate(zip(prev, cut), first):
            if c or p >= began or (most and i - began >= most):
                began, batch = i, batch + 1
            out.append(batch)
        return rows[["_t", "seq", "op"]].assign(batch=out)

    ready = ranked.join(opened, F.col("_t").eqNullSafe(F.col("_u")) & (F.col("_i") == F.col("_j"))).drop("_u", "_j")
    return ready.groupBy("_t", "_i").cogroup(earlier).applyInPandas(run, "_t string, seq long, op string, batch long").withColumnRenamed("_t", table)


def split_errors(rows: DataFrame, casts: dict[str, str]) -> tuple[DataFrame, DataFrame]:
    """Rows whose columns can be cast, and the rest with the reason (a dead-letter table)."""
    bad = F.concat_ws(",", *[F.when(F.col(c).isNotNull() & F.col(c).try_cast(t).isNull(), F.lit(c)) for c, t in casts.items()])
    marked = rows.withColumn("error", bad)
    good = marked.where("error = ''").drop("error")
    return good.select(*[F.col(c).try_cast(casts[c]).alias(c) if c in casts else F.col(c) for c in good.columns]), marked.where("error <> ''")
