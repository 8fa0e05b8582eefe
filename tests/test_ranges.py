"""Bounds, pages and as-of lookups against plain Python, and differences and types of documents."""

import bisect
import json
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from changeloom.operators import documents as D
from changeloom.operators import history as H
from changeloom.operators import snapshot as N


def test_exact_bounds_equal_percentiles(spark):
    rnd = random.Random(3)
    for values in ([rnd.choice([5, 7, 10**15, -3]) for _ in range(301)], [rnd.random() * 10 ** rnd.randrange(9) for _ in range(500)], [4], [1, 2]):
        d = spark.createDataFrame([(v,) for v in values] + [(None,)], "k double" if isinstance(values[0], float) else "k long").repartition(3)
        for chunks in (1, 2, 7):
            want = sorted({d.selectExpr(f"percentile(k, {i / chunks})").first()[0] for i in range(1, chunks)})
            assert N.boundaries(d, "k", chunks, exact=True) == pytest.approx(want, rel=1e-12)
    assert N.boundaries(d.limit(0), "k", 3, exact=True) == []


def test_chunks_by_halving(spark):
    bounds = [-5, 0, 3, 3.5, 100]
    got = {r.k: r.chunk for r in N.with_chunks(spark.createDataFrame([(k,) for k in range(-10, 110)] + [(None,)], "k long"), "k", bounds).collect()}
    assert got == {k: bisect.bisect_right(bounds, k) for k in range(-10, 110)} | {None: None}


@pytest.mark.parametrize("range_rows", [7, 10_000])
def test_pages_of_a_frequent_first_key(spark, range_rows):
    rnd = random.Random(1)
    rows = [("hot" if rnd.random() < 0.6 else rnd.choice([None, "a", "z", ""]), i) for i in range(300)]
    d = spark.createDataFrame(rows, "a string, b long").repartition(4)
    got = {(r.a, r.b): r.chunk_id for r in N.paged(d, ["a", "b"], 11, range_rows).collect()}
    order = sorted(rows, key=lambda r: (r[0] is not None, r[0] or "", r[1]))
    assert got == {r: i // 11 for i, r in enumerate(order)}
    assert N.paged(d.limit(0), ["a", "b"], 11).count() == 0


def test_schema_of_events_by_bins(spark):
    rnd = random.Random(2)
    marks = {"t": sorted(rnd.sample(range(50), 12) + rnd.sample(range(60, 10**9), 5)), "u": [7], None: [3, 9]}
    h = spark.createDataFrame([(p, t) for t, ps in marks.items() for p in ps], "pos long, tbl string")
    events = [(t, s) for t in (*marks, "unknown") for s in [*range(0, 60, 3), 10**8, 10**10]]
    got = {(r.tbl, r.seq): r.schema_pos for r in H.for_events(spark.createDataFrame(events, "tbl string, seq long"), h).collect()}
    want = {(t, s): max((p for p in marks.get(t, []) if p <= s), default=None) for t, s in events}
    assert got == want


def test_differences_of_documents(spark):
    pairs = [('{"a":1,"b":{"c":[1,2]}}', '{"a":"1","b":{"c":[1]},"d":null}'), (None, '{"x":1}'), ("[1]", "{}"), (None, None), ('{"s":1}', '{"s":1}')]
    d = spark.createDataFrame([(i, *p) for i, p in enumerate(pairs)], "k long, before string, after string")
    got = sorted(((r.k, ".".join(r.path), r.kind, r.old, r.new) for r in D.differences(d, ["k"]).collect()), key=str)
    assert got == [(0, "a", "replace", "1", '"1"'), (0, "b.c.1", "remove", "2", None), (0, "d", "add", None, "null"), (1, "", "add", None, "{}"), (1, "x", "add", None, "1"), (2, "", "replace", "[]", "{}"), (2, "0", "remove", "1", None)]


def test_types_are_widened_over_all_payloads(spark):
    rows = [("a", '{"n":1,"o":{"x":1}}'), ("a", '{"n":2.5,"o":{"y":[1,2]},"z":null}'), ("a", "not json"), ("b", '{"n":"s"}'), ("b", '{"n":{"deep":1}}'), ("c", "null"), ("c", None), (None, "{}")]
    d = spark.createDataFrame(rows, "type string, payload string")
    assert set(D.inferred_types(d, "type", "payload")) == {"a", "b", "c"}
    typed = D.typed_payloads(d, "type", "payload")
    a = typed["a"].selectExpr("CAST(value.n AS double) AS n", "value.o.x AS x", "value.o.y AS y", "value.z AS z").collect()
    assert sorted([(r.n, r.x, r.y, r.z) for r in a], key=str) == sorted([(1.0, 1, None, None), (2.5, None, [1, 2], None), (None, None, None, None)], key=str)
    b = [json.loads(r[0])["n"] for r in typed["b"].selectExpr("to_json(value)").collect()]
    assert "s" in b and {"deep": 1} in b  # what conflicts stays as it is
    assert typed["c"].count() == 2


@pytest.mark.parametrize("seed", range(3))
def test_windows_over_servers(spark, seed):
    rnd = random.Random(seed)
    at, events = {s: 0 for s in "abc"}, []
    for seq in range(10, 900, 3):
        s = rnd.choice("aab" if seq < 400 else "abc")
        at[s] += rnd.choice([0, 1, 1])  # a transaction has several events
        if at[s]:
            events.append((s.upper(), at[s], seq))
    text = lambda sets: ", ".join(f"{s}:1-{n}" if n > 1 else f"{s}:{n}" for s, n in sets.items() if n)
    marks, want = [], {}
    for chunk in range(40):
        low = {s: rnd.randrange(0, at[s]) for s in "abc"}
        high = {s: low[s] + rnd.choice([0, 0, 1, 5, 400 if chunk == 7 else 9]) for s in "abc"}
        marks.append((chunk, text(low), text(high)))
        first = lambda s, n: min((q for t, x, q in events if t == s.upper() and x >= n), default=None)
        opens = [first(s, low[s] + 1) for s in "abc" if high[s]]
        ends = [first(s, high[s]) for s in "abc" if high[s] > low[s]]
        opened = min((o for o in opens if o is not None), default=None)
        if None not in ends and (ends or opened is not None):
            want[chunk] = (None if opened is None else opened - 1, max(ends) if ends else opened - 1)
    d = spark.createDataFrame(marks, "chunk_id long, low_set string, high_set string")
    e = spark.createDataFrame(events, "server string, number long, seq long")
    assert {r.chunk_id: (r.low, r.high) for r in N.windows_from_gtids(d, e).collect()} == want


def test_schema_positions_of_one_table_are_found_in_many_tasks(spark, monkeypatch):
    monkeypatch.setattr(H, "INTERVALS", 0)
    rnd = random.Random(5)
    seqs = {t: sorted(rnd.sample(range(9_000), n)) for t, n in (("a", 3_000), ("b", 7), (None, 40))}
    marks = {"a": sorted(rnd.sample(range(1_000, 5_000), 50)), "b": [4_000], None: [2, 8_000], "c": [1]}
    events = spark.createDataFrame([(t, s) for t, x in seqs.items() for s in [*x, None]], "tbl string, seq long").repartition(5)
    history = spark.createDataFrame([(s, t) for t, x in marks.items() for s in [*x, None]], "pos long, tbl string")
    was = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = H.for_events(events, history, range_rows=200).withColumn("task", F.spark_partition_id()).collect()
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", was)
    want = {(t, s): max((m for m in marks[t] if s is not None and m <= s), default=None) for t, x in seqs.items() for s in [*x, None]}
    assert len(got) == len(want) and {(r.tbl, r.seq): r.schema_pos for r in got} == want
    assert max(Counter(r.task for r in got).values()) < 2_000
