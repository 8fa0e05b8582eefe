import hashlib
import zlib
from collections import Counter, defaultdict

import duckdb
import pandas as pd
from pyspark.sql import functions as F

from changeloom.llm import mixing, sharding

SCHEMA = "doc_id long, source string, size long"


def fill(sizes, weights=(5, 2, 1), most=3):
    """Targets by resharing the excess until none is above its cap."""
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + ([None] if None in sizes else [])
    w, out, total = {s: weights[i % 3] for i, s in enumerate(names)}, {}, sum(sizes.values())
    while True:
        left = total - sum(out.values())
        free = [s for s in names if s not in out]
        t = {s: left * w[s] / sum(w[x] for x in free) for s in free}
        if not (over := [s for s in free if t[s] > most * sizes[s]]):
            return out | t
        out |= {s: most * sizes[s] for s in over}


def test_targets_and_taken(spark):
    rows = [(i, ["a", "b", "c", "hot", None][min(i % 11, 4) if i % 2 else 3], (i * 7919) % 90) for i in range(3000)]
    out = mixing.pareto_mix(spark.createDataFrame(rows, SCHEMA)).collect()
    assert len(out) == len(rows)
    sizes = Counter()
    for _, s, n in rows:
        sizes[s] += n
    want, taken = fill(sizes), Counter()
    for r in out:
        assert abs(r.target - want[r.source]) < 1e-6 * max(1, want[r.source]) and r.source_size == sizes[r.source]
        assert r.taken in {0, r["size"], 2 * r["size"], 3 * r["size"]}
        taken[r.source] += r.taken
    assert all(abs(taken[s] - want[s]) <= 90 for s in sizes)
    again = mixing.pareto_mix(spark.createDataFrame(rows[::-1], SCHEMA).repartition(7)).collect()
    assert sorted(map(str, out)) == sorted(map(str, again))


def test_mix_of_odd_tables(spark):
    assert mixing.pareto_mix(spark.createDataFrame([], SCHEMA)).count() == 0
    assert [r.taken for r in mixing.pareto_mix(spark.createDataFrame([(1, None, 0), (2, "x", 0)], SCHEMA)).collect()] == [0, 0]
    same = mixing.pareto_mix(spark.createDataFrame([(1, "a", 5)] * 4 + [(2, "b", 1)], SCHEMA)).collect()
    assert len(same) == 5 and sum(r.taken for r in same) > 0


def test_inclusion_grows_with_length_and_equals_sql(spark, tmp_path):
    rows = [(i, ["a", "b", None][min(i % 9, 2)], " ".join(["w"] * (i * 7919 % 300))) for i in range(2000)]
    pd.DataFrame(rows, columns=["doc_id", "source", "text"]).to_parquet(tmp_path / "documents.parquet")
    out = mixing.op3_pareto_mix(spark, str(tmp_path)).collect()
    want = duckdb.sql(mixing.OP3_SQL.replace("FROM documents", f"FROM '{tmp_path}/documents.parquet'")).fetchall()
    assert sorted(map(tuple, out)) == sorted(want)
    by = defaultdict(list)
    for r in out:
        if r["size"] and r.target < 2.9 * r.source_size:
            by[r.source_size, r["size"].bit_length()].append(r.taken / r["size"])
    mean = {k: sum(v) / len(v) for k, v in by.items() if len(v) > 60}
    for size in {k[0] for k in mean}:
        copies = [mean[k] for k in sorted(mean) if k[0] == size]
        assert copies[-1] > copies[0]


def test_mix_beside_clashing_columns(spark):
    rows = [(i, "ab"[i % 2], i % 9) for i in range(50)]
    clash = [f"{i} as `{c}`" for i, c in enumerate(["_copies", "_u", "_q", "k", "p", "whole", "stratum", "key", "words", "_row", "copies", "target"])]
    plain = {r.doc_id: r.taken for r in mixing.pareto_mix(spark.createDataFrame(rows, SCHEMA)).collect()}
    got = mixing.pareto_mix(spark.createDataFrame(rows, SCHEMA).selectExpr("*", *clash)).collect()
    assert {r.doc_id: r.taken for r in got} == plain and got[0].stratum == 6 and got[0].key == 7
    out = sharding.interleave(spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 as _u", "2 as _bin", "3 as _n", "4 as _stratum", "5 as rows", "6 as key", "7 as shard"), "doc_id", "source", 4).collect()
    assert len(out) == 50 and {(r._u, r._bin, r.rows, r.key) for r in out} == {(1, 2, 5, 6)} and {r.shard for r in out} == {0, 1, 2, 3}


def brute_shards(rows, shards, seed=17):
    """Shard and slot of each row by one sort: seeded shuffle and rank in each source, then by fractional rank."""
    u = lambda i: (int(hashlib.md5(f"{seed}:{'' if i is None else i}".encode()).hexdigest()[:13], 16) + 0.5) / 2**52
    by, order = defaultdict(list), []
    for r in rows:
        by["n" if r[1] is None else "s" + r[1]].append(r)
    for s, own in by.items():
        own.sort(key=lambda r: (u(r[0]), r[0]))
        order += [((k + 0.5) / len(own), s.encode(), r[0]) for k, r in enumerate(own)]
    shard = [k * shards // len(order) for k in range(len(order))]
    return {i: (s, k - shard.index(s)) for k, ((_, _, i), s) in enumerate(zip(sorted(order), shard))}


def test_shard_query_equals_one_sort(spark, tmp_path):
    texts = [None, "", "é", "x" * 200_000, "same", "same"]
    rows = [(i * 3, ["a", "b", None, "hot"][i % 7 if i % 7 < 3 else 3], texts[i % 6]) for i in range(1237)]
    pd.DataFrame(rows, columns=["doc_id", "source", "text"]).to_parquet(tmp_path / "documents.parquet")
    got = {r.doc_id: r for r in sharding.op4_interleaved_shards(spark, str(tmp_path)).collect()}
    assert {i: (r.shard, r.slot) for i, r in got.items()} == brute_shards(rows, 16)
    for i, _, t in rows:
        raw = (t or "").encode()
        assert (got[i]["size"], got[i].text_crc32, got[i].law, got[i].grown_shard) == (len(raw) + 1, zlib.crc32(raw), "rows", None)


def test_open_words_that_end_at_a_bin_edge_equal_sql(spark, tmp_path):
    # equal texts and whole targets (150, 60, 30 of 80 words each): the cut is between two documents
    text = " ".join(["word"] * 10)
    pd.DataFrame({"doc_id": range(24), "source": ["a", "b", "c"] * 8, "text": text}).to_parquet(tmp_path / "documents.parquet")
    want = duckdb.sql(mixing.OP3_SQL.replace("FROM documents", f"FROM '{tmp_path}/documents.parquet'")).fetchall()
    got = mixing.op3_pareto_mix(spark, str(tmp_path)).collect()
    assert sorted(map(tuple, got)) == sorted(want)
    assert sum(r.taken for r in got) == 240


def test_shards_match_the_mixture(spark):
    rows = [(i, ["a", "b", None, "hot"][i % 7 if i % 7 < 3 else 3], i) for i in range(1003)]
    out = sharding.interleave(spark.createDataFrame(rows, SCHEMA), "doc_id", "source", 16).collect()
    shards, mix = defaultdict(list), defaultdict(Counter)
    for r in out:
        shards[r.shard].append(r.slot)
        mix[r.shard][r.source] += 1
    assert set(shards) == set(range(16)) and all(sorted(s) == list(range(len(s))) for s in shards.values())
    assert max(map(len, shards.values())) - min(map(len, shards.values())) <= 1
    whole = Counter(s for _, s, _ in rows)
    assert all(abs(mix[k][s] - n / 16) <= 2 for k in mix for s, n in whole.items())


def test_shards_of_odd_tables(spark):
    assert sharding.interleave(spark.createDataFrame([], SCHEMA), "doc_id", "source", 16).count() == 0
    few = sharding.interleave(spark.createDataFrame([(1, None, 3), (1, None, 3), (None, "s", 1)], SCHEMA), "doc_id", "source", 16).collect()
    assert sorted(r.shard for r in few) == [0, 5, 10] and {r.slot for r in few} == {0}


def test_crc_is_of_utf8(spark):
    df = spark.createDataFrame([("é",)], "text string").select(F.crc32(F.col("text").cast("binary")))
    assert df.first()[0] == zlib.crc32("é".encode())


def test_rows_without_an_id_are_taken_and_placed_one_by_one(spark, tmp_path):
    rows = [(None, "a", "w " * 25)] * 900 + [(7, "a", "w " * 25)] * 600 + [(100 + i, "b", "v " * 60) for i in range(900)]
    pd.DataFrame(rows, columns=["doc_id", "source", "text"]).astype({"doc_id": "Int64"}).to_parquet(tmp_path / "documents.parquet")
    out = mixing.op3_pareto_mix(spark, str(tmp_path)).collect()
    want, taken = fill({"a": 37_500, "b": 54_000}), Counter()
    for r in out:
        taken[25 if r["size"] == 25 else 60] += r.taken
    assert len(out) == 2400 and abs(taken[25] - want["a"]) <= 25 and abs(taken[60] - want["b"]) <= 60
    shards = sharding.op4_interleaved_shards(spark, str(tmp_path)).collect()
    assert Counter(r.shard for r in shards) == {k: 150 for k in range(16)} and len({(r.shard, r.slot) for r in shards}) == 2400
    assert {r.doc_id for r in shards} == {None, 7, *range(100, 1000)}
