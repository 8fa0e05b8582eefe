"""Operator 12: the prefix trie of conversations, by an external mergesort that carries common prefixes.

A conversation is the sequence of its turns, a turn 24 bytes (16 of the SHA-256 of role and text, 8 for the text's size), so equal
turns are equal bytes and texts are never shuffled.  Equal sequences become one, with the number of its members and its
smallest member.  Sequences are dealt out by range, and each task

* sorts its batches, which makes runs that carry with each sequence the number of turns that it shares with the one before (its LCP);
* merges the runs by a tree of losers that compares LCPs first, and turns only behind those that are known to be shared;
* feeds the merged stream to a stack that holds the open path: what the next sequence doesn't share is finished, and
  is added to its parent.

A node between two sequences of one range is whole there.  The paths to a range's first and last sequence may go on in its
neighbours: of these nodes (two paths a range, however many rows it has) a task tells what it has seen so far, and the same stack goes
over these paths of all ranges, in order, once more.  A node's parent is known by its place in the range; children of nodes that ranges
share find theirs by range and place, a key of which no value is frequent.

Defined results: turns are ordered by number (null first), those with one number by the SHA-256 of role and text; null roles and
texts are empty; rows without ``conv_id`` belong to no conversation; repeated rows are turns of their own; an empty table gives no rows;
other columns are ignored.  The turns of one conversation are held as one row, so a conversation can't exceed some 40 million turns;
groups of equal conversations, and of those that share a prefix, may be of any size.
"""

from __future__ import annotations

import hashlib
from array import array

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from changeloom.llm.common import checkpointed, crc32_of, read, small_side, stored

#: Bytes of a turn.
TURN = 24
#: Bytes of sequences that one task merges, about: its runs and nodes stay in memory.
RANGE_BYTES = 8 << 20
#: Ids that one piece of a list of members holds.
PIECE_IDS = 50_000
#: Rows of a batch of nodes.
OUT_ROWS = 10_000
NONE = hashlib.sha256(b"").hexdigest()
_NOBODY = (1 << 63) - 1


def turn_key(role: str, text: str) -> Column:
    """24 bytes, in hexadecimal, that tell a turn from every other one; the last 8 are the number of UTF-8 bytes of its text."""
    role, text = F.coalesce(F.col(role), F.lit("")), F.coalesce(F.col(text), F.lit(""))
    named = F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text)
    return F.concat(F.substring(F.sha2(named.cast("binary"), 256), 1, 32), F.lpad(F.hex(F.octet_length(text).cast("long")), 16, "0"))


def turns_of(table: DataFrame, group: Column) -> DataFrame:
    """``group, conv_id, own``: the keys of each conversation's turns in order, all conversations of a group on one node."""
    t = F.struct("turn", turn_key("role", "text").alias("k"))
    rows = table.where("conv_id is not null").select("conv_id", group.alias("group"), t.alias("t")).repartition("group")
    return rows.groupBy("group", "conv_id").agg(F.sort_array(F.collect_list("t"))["k"].alias("own"))


def sequence(keys: Column) -> Column:
    return F.unhex(F.array_join(keys, ""))


def shared_turns(a: bytes, b: bytes, known: int = 0) -> int:
    """The number of first turns that two sequences share; they are known to share ``known``."""
    most = min(len(a), len(b)) // TURN
    while known < most and a[known * TURN : (known + 1) * TURN] == b[known * TURN : (known + 1) * TURN]:
        known += 1
    return known


def merged(runs: list[tuple[list[bytes], list[int]]]):
    """``(run, place, lcp)`` of all sequences in order, the LCP being that with the sequence before, by a tree of losers.

    Every head knows how many turns it shares with the last winner.  Of two heads the one that shares more comes first, unseen; heads
    that share equally many are compared behind those turns, and the loser keeps what the comparison found.
    """
    size = len(runs)
    at, lcp, live = [0] * size, [0] * size, [bool(r[0]) for r in runs]
    losers = [0] * size

    def before(a: int, b: int) -> bool:
        """Whether the head of ``a`` comes before that of ``b``."""
        if not (live[a] and live[b]):
            return live[a]
        if lcp[a] != lcp[b]:
            return lcp[a] > lcp[b]
        x, y = runs[a][0][at[a]], runs[b][0][at[b]]
        n = shared_turns(x, y, lcp[a])
        first = x[n * TURN : (n + 1) * TURN] <= y[n * TURN : (n + 1) * TURN]
        lcp[b if first else a] = n
        return first

    def winner(node: int) -> int:
        if node >= size:
            return node - size
        a, b = winner(2 * node), winner(2 * node + 1)
        win, losers[node] = (a, b) if before(a, b) else (b, a)
        return win

    top = winner(1) if size > 1 else 0
    while size and live[top]:
        yield top, at[top], lcp[top]
        at[top] += 1
        live[top] = at[top] < len(runs[top][0])
        if live[top]:
            lcp[top] = runs[top][1][at[top]]
        node = (top + size) // 2
        while node:
            if before(losers[node], top):
                losers[node], top = top, losers[node]
            node //= 2


def sorted_run(seqs: list[bytes]) -> tuple[list[int], tuple[list[bytes], list[int]]]:
    """The order of a batch; the sequences in order, and each one's LCP with the one before (the first: 0)."""
    order = sorted(range(len(seqs)), key=seqs.__getitem__)
    run = [seqs[i] for i in order]
    return order, (run, [0] + [shared_turns(a, b) for a, b in zip(run, run[1:])])


class Path:
    """The stack of open nodes.  Nodes are numbered as they open; arrays hold by number what is known of them."""

    def __init__(self):
        self.up, self.depth, self.conv, self.n, self.children, self.leaves, self.saved, self.size = (array("q") for _ in range(8))
        self.ends: list[str | None] = []
        self.turns: list[bytes] = []
        self.open: list[int] = []
        #: Nodes that are never finished here.
        self.left: set[int] = set()

    def push(self, turn: bytes) -> int:
        i = len(self.up)
        self.up.append(self.open[-1] if self.open else -1)
        self.depth.append(len(self.open))
        self.conv.append(_NOBODY)
        for column in (self.n, self.children, self.leaves, self.saved):
            column.append(0)
        self.size.append(int.from_bytes(turn[TURN - 8 :], "big"))
        self.ends.append(None)
        self.open.append(i)
        del self.turns[len(self.open) - 1 :]
        self.turns.append(turn)
        return i

    def add(self, i: int, conv: int, n: int, children: int, leaves: int, saved: int, ends: str | None = None) -> None:
        """Adds to an open node what was seen in it."""
        self.conv[i] = min(conv, self.conv[i])
        self.n[i] += n
        self.children[i] += children
        self.leaves[i] += leaves
        self.saved[i] += saved
        self.ends[i] = ends or self.ends[i]

    def close(self, depth: int) -> None:
        """Finishes the open nodes from ``depth`` on; each is added to its parent."""
        while len(self.open) > depth:
            i = self.open.pop()
            if i not in self.left:
                self.leaves[i] += self.children[i] == 0
                self.saved[i] += (self.n[i] - 1) * self.size[i]
                if self.open:
                    self.add(self.open[-1], self.conv[i], self.n[i], 1, self.leaves[i], self.saved[i])


NODE = "conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long, ends_sha256 string"
#: Kinds of rows: 0 whole nodes (``up``: the parent's slot where that isn't whole), 1 and 2 nodes of a range's first and last path, 3 ids of slots.
ROWS = f"kind int, part int, slot long, up long, turn binary, {NODE}"
_SCHEMA = pa.schema([(f.split()[0], {"int": pa.int32(), "long": pa.int64(), "string": pa.string(), "binary": pa.binary()}[f.split()[1]]) for f in ROWS.split(", ")])


def _batch(path: Path, kind: int, part: int, slots: list[int], up: list, parents: list, turns: list | None = None) -> pa.RecordBatch:
    of = lambda column: [column[i] for i in slots]
    n = len(slots)
    ends = [path.ends[i] or (None if kind else NONE) for i in slots]
    columns = [[kind] * n, [part] * n, slots, up, turns or [None] * n, of(path.conv), of(path.depth), parents, of(path.n), of(path.children), of(path.leaves), of(path.saved), ends]
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, _SCHEMA)], schema=_SCHEMA)


def _whole(path: Path, part: int, slots: list[int], shared: set[int]):
    """Rows of finished nodes; parents in ``shared`` are named by their slot."""
    for k in range(0, len(slots), OUT_ROWS):
        some = slots[k : k + OUT_ROWS]
        ups = [path.up[i] for i in some]
        yield _batch(path, 0, part, some, [u if u in shared else None for u in ups], [None if u in shared or u < 0 else path.conv[u] for u in ups])


def range_nodes(part: int, batches):
    """The nodes of one range as ROWS; batches are ``seq, conv_id, n, ends``."""
    runs, rest = [], []
    for batch in batches:
        if batch.num_rows:
            order, run = sorted_run(batch.column(0).to_pylist())
            runs.append(run)
            rest.append(pa.RecordBatch.from_arrays(batch.columns[1:], ["conv_id", "n", "ends"]).take(pa.array(order)))
    path, known = Path(), [(r.column(0).to_numpy(), r.column(1).to_numpy(), r.column(2)) for r in rest]
    for run, place, lcp in merged(runs):
        seq, (convs, counts, ends) = runs[run][0][place], known[run]
        begun = bool(path.up)
        if not begun:
            path.push(b"")
        path.close(lcp + 1)
        for d in range(lcp, len(seq) // TURN):
            path.push(seq[d * TURN : (d + 1) * TURN])
        if not begun:
            path.left.update(path.open)
            first = list(zip(path.open, path.turns))
        path.add(path.open[-1], int(convs[place]), int(counts[place]), 0, 0, 0, ends[place].as_py())
    if not path.up:
        return
    last = [(i, t) for i, t in zip(path.open, path.turns) if i not in path.left]
    shared = path.left | {i for i, _ in last}
    yield from _whole(path, part, [i for i in range(len(path.up)) if i not in shared], shared)
    for kind, some in ((1, first), (2, last)):
        for k in range(0, len(some), OUT_ROWS):
            slots, turns = map(list, zip(*some[k : k + OUT_ROWS]))
            yield _batch(path, kind, part, slots, [None] * len(slots), [None] * len(slots), turns)


def shared_nodes(batches):
    """The nodes that ranges share, whole, and the ids of their slots; rows come by range, path and depth."""
    path, slots, before = Path(), [], None
    for batch in batches:
        for kind, part, slot, _, turn, conv, depth, _, n, children, leaves, saved, ends in zip(*[c.to_pylist() for c in batch.columns]):
            if (part, kind) != before:  # a path begins; a last path begins below what it shares with the first
                before, along = (part, kind), kind == 1
                if kind == 2:
                    path.close(depth)
            along = along and depth < len(path.open) and path.turns[depth] == turn
            if not along:
                path.close(depth)
                path.push(turn)
            path.add(path.open[depth], conv, n, children, leaves, saved, ends)
            slots.append((part, slot, path.open[depth]))
    path.close(0)
    yield from _whole(path, -1, list(range(len(path.up))), set())
    for k in range(0, len(slots), OUT_ROWS):
        parts, places, nodes = zip(*slots[k : k + OUT_ROWS])
        n = len(nodes)
        given = {"kind": [3] * n, "part": parts, "slot": places, "conv_id": [path.conv[i] for i in nodes]}
        yield pa.RecordBatch.from_arrays([pa.array(given.get(f.name, [None] * n), f.type) for f in _SCHEMA], schema=_SCHEMA)


def members_hash(members: DataFrame) -> DataFrame:
    """``digest, ends``: SHA-256 of the ascending ids of each digest, joined by commas.

    A group of any size is joined in pieces by many tasks; one task then reads these texts in order, with a hash's state as its memory.
    """

    def pieces(batches):
        held, ids = None, []
        for batch in batches:
            out = []
            for digest, i in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if ids and (digest != held or len(ids) == PIECE_IDS):
                    out.append((held, ids[0], ",".join(map(str, ids))))
                    ids = []
                held = digest
                ids.append(i)
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), (pa.binary(), pa.int64(), pa.string()))], ["digest", "first", "ids"])
        if ids:
            yield pa.RecordBatch.from_arrays([pa.array([held], pa.binary()), pa.array([ids[0]]), pa.array([",".join(map(str, ids))])], ["digest", "first", "ids"])

    def hashes(batches):
        held, state = None, None
        for batch in batches:
            out = []
            for digest, ids in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist()):
                if digest == held:
                    state.update(b",")
                else:
                    if state:
                        out.append((held, state.hexdigest()))
                    held, state = digest, hashlib.sha256()
                state.update(ids.encode())
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), (pa.binary(), pa.string()))], ["digest", "ends"])
        if state:
            yield pa.RecordBatch.from_arrays([pa.array([held], pa.binary()), pa.array([state.hexdigest()])], ["digest", "ends"])

    ranges = members.select("digest", "conv_id").repartitionByRange("digest", "conv_id").sortWithinPartitions("digest", "conv_id")
    texts = ranges.mapInArrow(pieces, "digest binary, first long, ids string")
    return texts.repartition("digest").sortWithinPartitions("digest", "first").mapInArrow(hashes, "digest binary, ends string")


def prefix_trie(conversations: DataFrame) -> DataFrame:
    """The nodes of the trie of ``conv_id, seq`` (unique by id; ``seq`` from :func:`sequence`): the columns of NODE."""
    held = stored(conversations.select("conv_id", "seq", F.unhex(F.sha2("seq", 256)).alias("digest")))
    again = checkpointed(held.groupBy("digest").agg(F.min("conv_id").alias("_rep"), F.count(F.lit(1)).alias("_n")).where("_n > 1"))
    each = held.join(small_side(again), "digest", "left").where("_rep is null or _rep = conv_id")
    ends = F.sha2(F.col("conv_id").cast("string").cast("binary"), 256)
    if not again.isEmpty():
        hashed = checkpointed(members_hash(held.join(small_side(again.select("digest")), "digest")))
        each, ends = each.join(small_side(hashed.withColumnRenamed("ends", "_ends")), "digest", "left"), F.coalesce("_ends", ends)
    each = stored(each.select("seq", "conv_id", F.coalesce("_n", F.lit(1)).cast("long").alias("n"), ends.alias("ends")))
    total = each.agg(F.sum(F.octet_length("seq"))).first()[0] or 0
    ranges = max(-(-total // RANGE_BYTES), each.sparkSession.sparkContext.defaultParallelism)
    rows = stored(each.repartitionByRange(ranges, "seq").mapInArrow(lambda batches: range_nodes(TaskContext.get().partitionId(), batches), ROWS))
    # two paths a range
    paths = rows.where("kind in (1, 2)").repartition(1).sortWithinPartitions("part", "kind", "depth")
    whole = checkpointed(paths.mapInArrow(shared_nodes, ROWS))
    slots = small_side(whole.where("kind = 3").select("part", F.col("slot").alias("up"), F.col("conv_id").alias("_parent")))
    names = [f.split()[0] for f in NODE.split(", ")]
    inner = rows.where("kind = 0").join(slots, ["part", "up"], "left").withColumn("parent_conv_id", F.coalesce("parent_conv_id", "_parent"))
    return inner.select(*names).unionByName(whole.where("kind = 0").select(*names))


def rebuilt(table: DataFrame, group: int = 5) -> DataFrame:
    """``conv_id, seq``: the first turns of the first conversation of ``group`` neighbours, then the conversation's own turns."""
    whole = turns_of(table, F.col("conv_id") - F.col("conv_id") % group)
    heads = whole.where("conv_id = group").select("group", F.slice("own", 1, 8).alias("head"))
    h = (crc32_of("conv_id") % 9).cast("int")
    taken = F.slice(F.coalesce("head", F.array().cast("array<string>")), F.lit(1), h)
    return whole.join(heads, "group", "left").select("conv_id", sequence(F.concat(taken, F.slice("own", h + 1, F.size("own")))).alias("seq"))


def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie(rebuilt(read(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")))


OP12_SQL = f"""
WITH RECURSIVE t AS (
SELECT conv_id, sha256(CAST(strlen(coalesce(role, '')) AS VARCHAR) || ':' || coalesce(role, '') || coalesce(text, '')) AS k, strlen(coalesce(text, '')) AS bytes, turn FROM conversations WHERE conv_id IS NOT NULL),
o AS (SELECT conv_id, k, bytes, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, k) AS r FROM t),
b(b, v) AS (SELECT CAST(range AS UBIGINT), CAST(range AS UBIGINT) FROM range(256)),
crc AS (SELECT b, v, 0 AS i FROM b UNION ALL SELECT b, CASE WHEN v & 1 = 1 THEN xor(v >> 1, CAST(3988292384 AS UBIGINT)) ELSE v >> 1 END, i + 1 FROM crc WHERE i < 8),
c AS (SELECT DISTINCT conv_id, CAST(conv_id AS VARCHAR) AS s FROM o),
h AS (SELECT conv_id, s, 0 AS i, CAST(4294967295 AS UBIGINT) AS v FROM c
 UNION ALL SELECT conv_id, s, h.i + 1, xor(h.v >> 8, crc.v) FROM h JOIN crc ON crc.i = 8 AND crc.b = xor(h.v & 255, CAST(ascii(substr(s, h.i + 1, 1)) AS UBIGINT)) WHERE h.i < length(s)),
n AS (SELECT conv_id, CAST(xor(v, CAST(4294967295 AS UBIGINT)) % 9 AS BIGINT) AS h FROM h WHERE i = length(s)),
p AS (SELECT n.conv_id, o.k, o.bytes, o.r, 0 AS own FROM n JOIN o ON o.conv_id = n.conv_id - n.conv_id % 5 WHERE o.r <= n.h
 UNION ALL SELECT n.conv_id, o.k, o.bytes, o.r, 1 FROM n JOIN o ON o.conv_id = n.conv_id WHERE o.r > n.h),
q AS (SELECT conv_id, k, bytes, row_number() OVER (PARTITION BY conv_id ORDER BY own, r) AS d FROM p),
m AS (SELECT conv_id, d, bytes, string_agg(k, '') OVER (PARTITION BY conv_id ORDER BY d) AS path FROM q UNION ALL SELECT conv_id, 0, 0, '' FROM n),
e AS (SELECT conv_id, max(d) AS d FROM m GROUP BY 1),
g AS (SELECT path, max(d) AS d, min(m.conv_id) AS conv_id, count(*) AS n, max(bytes) AS bytes, coalesce(string_agg(CAST(e.conv_id AS VARCHAR), ',' ORDER BY e.conv_id), '') AS ends FROM m LEFT JOIN e USING (conv_id, d) GROUP BY path),
k AS (SELECT substr(path, 1, length(path) - 64) AS up, count(*) AS children FROM g WHERE d > 0 GROUP BY 1),
f AS (SELECT g.*, coalesce(children, 0) AS children FROM g LEFT JOIN k ON k.up = g.path),
s AS (SELECT m.path, sum(CASE WHEN f.children = 0 THEN 1 ELSE 0 END) AS leaves, sum((f.n - 1) * f.bytes) AS saved FROM f JOIN m ON m.conv_id = f.conv_id AND m.d <= f.d GROUP BY 1)
SELECT f.conv_id, CAST(f.d AS BIGINT) AS depth, u.conv_id AS parent_conv_id, CAST(f.n AS BIGINT) AS n_convs, CAST(f.children AS BIGINT) AS n_children, CAST(s.leaves AS BIGINT) AS n_leaves, CAST(s.saved AS BIGINT) AS saved_tokens, sha256(f.ends) AS ends_sha256
FROM f JOIN s ON s.path = f.path LEFT JOIN f u ON f.d > 0 AND u.path = substr(f.path, 1, length(f.path) - 64)
"""
