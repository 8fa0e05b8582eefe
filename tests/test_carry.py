"""Values left out by updates, filled from the log, against one pass over it."""

import random

import pytest
from pyspark.sql import functions as F

from changeloom.operators import carry

GONE = "__gone"


def log(seed):
    """Rows in order and what they should hold: a hot key, keys that change (some of them again and again), nulls as values."""
    rnd, held, rows, want = random.Random(seed), {}, [], {}
    for seq in range(400):
        key = 0 if rnd.random() < 0.5 else rnd.randrange(1, 25)
        old = None
        if key in held and rnd.random() < 0.15:
            free = [k for k in range(100, 200) if k not in held]
            old, key = key, rnd.choice(free)
            held[key] = held.pop(old)
        elif rnd.random() < 0.1 and held:
            old = rnd.choice([k for k in held])
            free = [k for k in range(1, 200) if k not in held]
            key = rnd.choice(free)
            held[key] = held.pop(old)
        values = [rnd.choice([GONE, GONE, GONE, f"v{seq}", None]) for _ in "ab"] if key in held or rnd.random() < 0.2 else [f"n{seq}", None]
        now = [h if v == GONE else v for v, h in zip(values, held.get(key, [GONE, GONE]))]
        held[key] = now
        rows.append((seq, key, old, *values))
        want[seq] = tuple(now)
    return rows, want


@pytest.mark.parametrize("range_rows", [30, 10_000])
def test_filled_equals_one_pass(spark, range_rows):
    rows, want = log(range_rows)
    d = spark.createDataFrame(rows, "seq long, key long, was long, a string, b string").repartition(5)
    got = {r.seq: (r.a, r.b) for r in carry.filled(d, ["key"], ["a", "b"], GONE, {"key": "was"}, range_rows=range_rows).collect()}
    assert got == want
    plain = {r.seq: (r.a, r.b) for r in carry.filled(d.where("was is null"), ["key"], ["a", "b"], GONE, range_rows=range_rows).collect()}
    assert len(plain) == d.where("was is null").count()


def test_a_hot_key_is_split_over_ranges(spark):
    d = spark.range(1000).select(F.col("id").alias("seq"), F.lit(1).alias("key"), F.when(F.col("id") % 400 == 0, F.col("id").cast("string")).otherwise(GONE).alias("a"))
    out = carry.filled(d, ["key"], ["a"], GONE, range_rows=100)
    assert {(r.seq, r.a) for r in out.collect()} == {(i, str(i // 400 * 400)) for i in range(1000)}
    assert d.withColumn("g", carry._ranges(d, "seq", 100)).groupBy("g").count().where("count > 110").isEmpty()
    assert carry.filled(d.limit(0), ["key"], ["a"], GONE).count() == 0
    ended = carry.filled(d.withColumn("op", F.when(F.col("seq") == 450, "d").otherwise("u")), ["key"], ["a"], GONE, ends="op = 'd'", range_rows=100)
    assert {r.seq: r.a for r in ended.collect()} == {i: GONE if 450 < i < 800 else str(i // 400 * 400) for i in range(1000)}
