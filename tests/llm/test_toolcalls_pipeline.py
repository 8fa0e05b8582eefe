import json

import duckdb

from changeloom.llm import minhash, toolcalls
from changeloom.llm.entry import ORACLE_SQL, QUERIES

CALL = "conv_id long, turn long, idx int, call_id string, name string, arguments string, after array<string>"
SCHEMA = {"t": {"properties": {"n": {"type": "integer", "minimum": 1}, "s": {"type": "string", "enum": ["a", "b"]}, "o": {"type": "object"}}, "required": ["n"], "additionalProperties": False}}


def link(spark, calls, results):
    return {r.call_id: r for r in toolcalls.link(spark.createDataFrame(calls, CALL), spark.createDataFrame(results, "conv_id long, call_id string, content string"), SCHEMA).collect()}


def test_order_validation_and_records(spark):
    calls = [
        (1, 0, 0, "a", "t", '{"s": "a", "n": 2}', ["c"]),
        (1, 1, 0, "b", "t", '{"n": 0, "s": "z"}', ["a", "zz"]),
        (1, 2, 0, "c", "t", '{"n": "x", "q": 1}', []),
        (2, 0, 0, "d", "t", "[1]", ["e"]),
        (2, 1, 0, "e", "u", "{}", ["d"]),
        (3, 0, 0, None, "t", "{}", []),
        (3, 0, 1, "f", None, None, None),
        (3, 1, 0, "g", "t", '{"n": 1.5, "o": {"z": 1, "y": [true, null]}}', ["f"]),
        (3, 1, 0, "g", "t", '{"n": 1.5, "o": {"z": 1, "y": [true, null]}}', ["f"]),
    ]
    got = link(spark, calls, [(1, "a", 'q"é\n'), (1, "b", "1"), (1, "b", "2"), (2, "a", "other"), (1, "none", "x"), (1, None, "y")])
    assert set(got) == set("abcdefg")
    order = sorted("abc", key=lambda k: (got[k].level, got[k].turn))
    assert order == ["c", "a", "b"] and got["d"].level == got["e"].level == -1 and got["g"].level == 0
    assert got["b"].missing_after == 1 and got["g"].n_calls == 2
    assert [got[k].status for k in "abc"] == ["answered", "answered twice", "unanswered"]
    assert got["a"].problems == "" and got["b"].problems == "n: too small; s: not allowed"
    assert got["c"].problems == "n: not a integer; q: unknown" and got["d"].problems == "arguments: not an object"
    assert got["e"].problems == "unknown tool u" and got["f"].problems == "arguments: not an object" and got["g"].problems == "n: not a integer"
    assert json.loads(got["a"].record) == {"arguments": {"n": 2, "s": "a"}, "id": "a", "name": "t", "result": 'q"é\n'}
    assert got["g"].record == '{"arguments":{"n":1.5,"o":{"y":[true,null],"z":1}},"id":"g","name":"t","result":null}'
    assert link(spark, [], []) == {}


def test_identifiers_count_in_their_conversation_only(spark):
    calls = [(c, 0, 0, "call_0", "t", '{"n": 1}', []) for c in (1, 2, None)]
    df = spark.createDataFrame(calls, CALL).selectExpr("*", "1 as node", "2 as level")
    out = toolcalls.link(df, spark.createDataFrame([(1, "call_0", "one"), (None, "call_0", "none")], "conv_id long, call_id string, content string"), SCHEMA).collect()
    assert sorted((r.conv_id or 0, r.status, json.loads(r.record)["result"] or "") for r in out) == [(0, "answered", "none"), (1, "answered", "one"), (2, "unanswered", "")]


def test_levels_of_long_chains_and_cycles(spark, monkeypatch):
    n = 300
    calls = [(1, i, 0, f"k{i}", "t", '{"n": 1}', [f"k{i + 1}"] if i + 1 < n else []) for i in range(n)]  # a chain of forward dependencies
    calls += [(2, i, 0, f"k{i}", "t", '{"n": 1}', [f"k{(i + 1) % 5}"]) for i in range(5)] + [(2, 9, 0, "z", "t", "{}", ["k0"])]  # a cycle and what is behind it
    calls += [(3, 0, 0, "a", "t", "{}", ["b", "c"]), (3, 1, 0, "b", "t", "{}", ["c", "d"]), (3, 2, 0, "c", "t", "{}", ["d"]), (3, 3, 0, "d", "t", "{}", []), (3, 4, 0, "e", "t", "{}", ["a", "e", "a"])]
    jobs = []
    real = toolcalls.checkpointed
    monkeypatch.setattr(toolcalls, "checkpointed", lambda *a: jobs.append(1) or real(*a))
    monkeypatch.setattr(toolcalls, "PART_CALLS", 16)
    empty = spark.createDataFrame([], "conv_id long, call_id string, content string")
    out = {(r.conv_id, r.call_id): r for r in toolcalls.rendered(toolcalls.link(spark.createDataFrame(calls, CALL), empty, SCHEMA)).collect()}
    assert [out[1, f"k{i}"].level for i in range(n)] == [n - 1 - i for i in range(n)] and [out[1, f"k{i}"].place for i in range(n)] == [n - i for i in range(n)]
    assert {out[k].level for k in out if k[0] == 2} == {-1}
    assert [out[3, k].level for k in "abcde"] == [3, 2, 1, 0, -1]
    assert len(jobs) < 90


def test_very_long_arguments(spark):
    text = "é\u0000\"" * 400_000
    calls = [(1, 0, 0, "a", "t", json.dumps({"n": 1, "s": text}), None)]
    out = link(spark, calls, [(1, "a", text)])
    assert json.loads(out["a"].record)["result"] == text and out["a"].problems == "s: not allowed"


def test_messages_are_parsed(spark):
    rows = [(1, 0, "assistant", '{"tool_calls": [{"id": "x", "name": "t", "arguments": {"n": 1}}]}'), (1, 1, "tool", '{"tool_call_id": "x", "content": "ok"}'), (1, 2, "assistant", "{broken"), (1, 3, None, None)]
    calls, results = toolcalls.parse_messages(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"))
    out = toolcalls.rendered(toolcalls.link(calls, results, SCHEMA)).collect()
    assert [(r.call_id, r.status, r.problems, r.place) for r in out] == [("x", "answered", "", 1)]


def test_query_equals_sql(spark):
    sf = "/root/testdata/sf0.001"
    con = duckdb.connect()
    con.execute(f"CREATE VIEW conversations AS SELECT * FROM '{sf}/conversations.parquet'")
    cols = ["conv_id", "turn", "call_id", "place", "level", "missing_after", "status", "problems", "record"]
    got = sorted(tuple(str(r[c]) for c in cols) for r in QUERIES["op5_tool_calls"](spark, sf).collect())
    assert got == sorted(tuple(map(str, r)) for r in con.execute(f"SELECT {', '.join(cols)} FROM ({ORACLE_SQL['op5_tool_calls']})").fetchall())


def test_pipeline_keeps_columns_and_acts(spark):
    import corpus_pipeline

    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    before = docs
    for name, stage in corpus_pipeline.STAGES[:4]:
        after = stage(spark, before, sf)
        assert after.columns == docs.columns, name
        after = spark.createDataFrame(after.collect(), docs.schema)
        if name == "MinHash near-dedup":
            want = {r.doc_id for r in minhash.cluster(before).where("kept").collect()}
            assert {r.doc_id for r in after.collect()} == want
        before = after
    words = lambda d: sum(len((r.text or "").split()) for r in d.collect())
    assert 0 < before.count() and words(before) > 0
    assert corpus_pipeline.run(spark, sf).count() == before.count()


def test_rows_without_doc_id_stay(spark, tmp_path):
    import corpus_pipeline

    text = lambda k: " ".join(f"w{k}x{i}" for i in range(60))
    rows = [(i, text(i)) for i in range(6)] + [(None, text(5)), (None, text(7)), (None, text(8)), (None, text(8)), (None, None), (3, text(3))]
    docs = spark.createDataFrame([(i, t, "en", "s", 0) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long").repartition(3)
    left = corpus_pipeline.drop_near_duplicates(spark, docs, "")
    want = [(i, text(i)) for i in range(6)] + [(3, text(3)), (None, text(7)), (None, text(8)), (None, None)]
    assert sorted(map(str, ((r.doc_id, r.text) for r in left.collect()))) == sorted(map(str, want))
    # the one source is taken once as a whole, a text without words never counts
    mixed = [(r.doc_id, r.text) for r in corpus_pipeline.mix_sources(spark, left, "").collect() if r.text]
    assert sorted(map(str, mixed)) == sorted(map(str, want[:-1]))
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    out = QUERIES["op6_minmax_dedup"](spark, str(tmp_path)).collect()
    assert len(out) == len(rows) and all(r.kept is not None for r in out)
    assert sorted((r.component_id, r.kept) for r in out if r.doc_id is None and r.component_id is not None) == [(5, False)]
    assert sum(r.kept for r in out if r.doc_id is None) == 3


DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def test_stages_on_hard_tables(spark, tmp_path):
    """Null columns, empty and very long texts, repeated ids and rows, no rows, and clashing names: what each stage's docstring says."""
    import corpus_pipeline

    sf = "/root/testdata/sf0.001"
    known = spark.read.parquet(f"{sf}/documents.parquet").where("text is not null and lang is not null")
    english = known.where("lang = 'en' and length(text) > 500").orderBy("doc_id").limit(40).collect()
    rows = [(r.doc_id, r.text, r.lang, r.source, r.n_chars) for r in known.limit(120).collect()]
    long = " ".join(r.text for r in english) * 12
    rows += [(10**6, long, None, None, None), (10**6 + 1, None, None, None, None), (10**6 + 2, "", "en", None, 0), (10**6 + 3, "12 34", None, "s", 5), (None, english[0].text, None, None, None), (10**6 + 4, english[1].text, "en", "s", 1), (10**6 + 4, english[2].text, "en", "s", 1)]
    rows += rows[-1:]
    clash = ["row_id", "key", "_copies", "_copy", "stratum", "accepted", "root", "size", "doc", "row"]
    docs = spark.createDataFrame(rows, DOCS).selectExpr("*", *[f"'{c}' as {c}" for c in clash]).cache()
    ids = lambda d: sorted((r.doc_id or -1, len(r.text or "")) for r in d.collect())
    stages = dict(corpus_pipeline.STAGES)
    clean = stages["toxicity"](spark, docs, sf)
    assert clean.columns == docs.columns and {10**6, 10**6 + 1, 10**6 + 2, 10**6 + 3} <= {i for i, _ in ids(clean)}
    said = stages["language ID"](spark, docs, sf)
    kept = {i for i, _ in ids(said)}
    assert said.columns == docs.columns and 10**6 in kept and not kept & {10**6 + 1, 10**6 + 2, 10**6 + 3} and 10**6 + 4 in kept
    one = stages["MinHash near-dedup"](spark, docs, sf)
    assert one.columns == docs.columns and {(r.row, r.key) for r in one.collect()} == {("row", "key")}
    assert {10**6, 10**6 + 1, 10**6 + 2, 10**6 + 3} <= {i for i, _ in ids(one)}
    assert sum(r.text == english[0].text for r in one.collect()) == 1
    mixed = stages["mixing sources to target weights"](spark, docs, sf)
    assert mixed.columns == docs.columns and {r.stratum for r in mixed.collect()} == {"stratum"}
    assert all(ids(mixed).count(x) <= 3 * ids(docs).count(x) for x in set(ids(mixed))) and set(ids(mixed)) <= set(ids(docs))
    tokens = stages["byte-level BPE encoding and decoding"](spark, docs, sf)
    assert tokens.count() == docs.count() and [r.n_tokens for r in tokens.where("doc_id in (1000001, 1000002)").collect()] == [0, 0]
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs.limit(0), sf).count() == 0, name
