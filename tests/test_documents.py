"""Partial document updates, folded by path, equal a replay one event at a time."""

import re
import copy
import json
import random

import pytest

from changeloom.operators import documents as D

KIND = "key long, seq long, op string, after string, updated_fields string, removed_fields array<string>, truncated_arrays array<struct<field:string,size:int>>"


def put(doc, path, value):
    for i, name in enumerate(path[:-1]):
        doc = doc[int(name)] if isinstance(doc, list) else doc.setdefault(name, {})
    if isinstance(doc, list):
        doc[int(path[-1]) :] = [value] + doc[int(path[-1]) + 1 :]
    else:
        doc[path[-1]] = value


def find(doc, path):
    for name in path:
        doc = doc[int(name)] if isinstance(doc, list) else doc[name]
    return doc


def value(rnd, deep=2):
    kind = rnd.random()
    if deep and kind < 0.3:
        return {n: value(rnd, deep - 1) for n in rnd.sample(["a", "b", "c d", 'q"é'], rnd.randrange(4))}
    if deep and kind < 0.55:
        return [value(rnd, deep - 1) for _ in range(rnd.randrange(13))]
    return rnd.choice([1, -2, 2.5, "x", "", "null", None, True, 'say "hi"', "é😀"])


def paths(doc, at=()):
    """Paths of all nodes below a document, parents first."""
    items = doc.items() if isinstance(doc, dict) else enumerate(doc) if isinstance(doc, list) else ()
    for n, x in items:
        yield (*at, str(n))
        yield from paths(x, (*at, str(n)))


def history(rnd, key, length):
    """Events of a key and the document after them."""
    doc, out = None, []
    for i in range(length):
        kind = rnd.random()
        if doc is None or kind < 0.08:
            doc = {n: value(rnd, 3) for n in rnd.sample("abcdef", 4)}
            out.append(("c", json.dumps(doc), None, None, None))
        elif kind < 0.14:
            doc = None
            out.append(("d", None, None, None, None))
        else:
            new, gone, cut, used = {}, [], [], set()
            for _ in range(rnd.randrange(1, 4)):
                some = [p for p in paths(doc)] or [("a",)]
                path = rnd.choice(some)
                if kind > 0.8:
                    path = (*path[: rnd.randrange(1, len(path) + 1)], rnd.choice(["n", "m"]))[:5]
                if len(path) > 5 or any(u[: len(path)] == path[: len(u)] for u in used):
                    continue
                try:
                    parent = find(doc, path[:-1])
                except (KeyError, IndexError, ValueError, TypeError):
                    continue
                if isinstance(parent, list) and not path[-1].isdigit() or not isinstance(parent, (list, dict)):
                    continue
                used.add(path)
                here = parent[int(path[-1])] if isinstance(parent, list) else parent.get(path[-1])
                if isinstance(here, list) and len(path) < 5 and rnd.random() < 0.5:
                    n = rnd.randrange(len(here) + 1)
                    cut.append((".".join(path), n))
                    del here[n:]
                elif isinstance(parent, dict) and rnd.random() < 0.3:
                    gone.append(".".join(path))
                    parent.pop(path[-1], None)
                else:
                    v = value(rnd)
                    new[".".join(path)] = v
                    put(doc, path, copy.deepcopy(v))
            out.append(("u", None, json.dumps(new), gone, cut))
    return out, doc


@pytest.mark.parametrize("depth", [2, 5])
def test_fold_equals_replay(spark, depth):
    rnd, rows, want = random.Random(depth), [], {}
    for key in range(60):
        events, doc = history(rnd, key, rnd.randrange(1, 25))
        if depth == 2:  # deeper paths can't be told apart
            events = [e for e in events if not (e[2] and any(p.count(".") > 1 for p in json.loads(e[2]))) and not any(p.count(".") > 1 for p in e[3] or []) and not any(f.count(".") > 0 for f, _ in e[4] or [])]
            doc = None
            for op, after, new, gone, cut in events:
                if op in "cd":
                    doc = json.loads(after) if after else None
                else:
                    try:
                        trial = copy.deepcopy(doc)
                        for f, n in cut:
                            del find(trial, f.split("."))[n:]
                        for p in gone:
                            find(trial, p.split(".")[:-1]).pop(p.split(".")[-1], None)
                        for p, v in json.loads(new).items():
                            put(trial, p.split("."), v)
                        doc = trial
                    except (KeyError, IndexError, TypeError, AttributeError, ValueError):
                        doc, events = None, []
                        break
        rows += [(key, 10 * i + key % 10, *e) for i, e in enumerate(events)]
        if doc is not None:
            want[key] = doc
    rnd.shuffle(rows)
    got = {r.key: json.loads(r.document) for r in D.documents(spark.createDataFrame(rows, KIND).repartition(5), ["key"], depth).collect()}
    assert len(want) > 20
    assert got == want


def test_what_an_update_does_not_mention_stays(spark):
    rows = [(1, 1, "c", '{"a":1,"b":2,"n":{"x":1,"y":null}}', None, None, None), (1, 2, "u", None, '{"a":5,"n.x":null}', None, None), (1, 3, "u", None, None, ["n.y", "gone"], None), (2, 1, "u", None, '{"p.q":1}', None, None), (3, 1, "c", "{}", None, None, None)]
    d = spark.createDataFrame(rows, KIND)
    assert {r.key: r.document for r in D.documents(d, ["key"]).collect()} == {1: '{"a":5,"b":2,"n":{"x":null}}', 2: '{"p":{"q":1}}', 3: "{}"}
    assert {r.key: (r.a, r.b) for r in D.current(d, ["key"], "a int, b int").collect()} == {1: (5, 2), 2: (None, None), 3: (None, None)}


def test_updates_below_the_depth_are_an_error(spark):
    d = spark.createDataFrame([(1, 1, "c", '{"a":{"b":{"c":1}}}', None, None, None), (1, 2, "u", None, '{"a.b.c":2}', None, None)], KIND)
    assert D.documents(d, ["key"], 3).first().document == '{"a":{"b":{"c":2}}}'
    with pytest.raises(Exception, match="below the levels"):
        D.documents(d, ["key"], 2).collect()


def test_one_shuffle_by_key_after_the_partial_fold(spark):
    d = spark.createDataFrame([(1, 1, "c", "{}", None, None, None)], KIND)
    plan = D.documents(d, ["key"])._jdf.queryExecution().executedPlan().toString()
    assert plan.split("== Initial Plan ==")[0].count("Exchange hashpartitioning(") == 2
    assert "Python" not in plan and "Arrow" not in plan


def test_events_are_shuffled_before_their_paths(spark):
    rows = [(k, 10 * k + n, "c" if n == 0 else "u", '{"a":{"x":1},"t":[1,2]}' if n == 0 else None, f'{{"a.x":{n},"b{n}":null}}' if n else None) for k in range(4) for n in range(2 + 3 * k)]
    events = spark.createDataFrame(rows, "k long, seq long, op string, after string, updated_fields string")
    got = {}
    for hot in (100, 4):
        d = D.folded(events, ["k"], partition_events=5, hot_events=hot)
        if hot == 100:
            assert "path" not in "".join(re.findall(r"hashpartitioning\([^)]*\)", d._jdf.queryExecution().executedPlan().toString()))
        got[hot] = {(r.k, *r.path): r.value for r in d.collect()}
    assert got[100] == got[4]
    assert got[4] == {(k, *path): v for k in range(4) for path, v in [((), "{}"), (("a",), "{}"), (("a", "x"), str(1 + 3 * k)), (("t",), "[]"), (("t", "0"), "1"), (("t", "1"), "2"), *((((f"b{n}"),), "null") for n in range(1, 2 + 3 * k))]}


def test_paths_are_sorted_once_and_documents_put_together_in_that_order(spark):
    d = spark.createDataFrame([(1, 1, "c", '{"a":[1]}', None, None, None)], KIND)
    for df, windows, groups in ((D.folded(d, ["key"]), 1, 1), (D.documents(d, ["key"]), 2, 2)):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert (len(re.findall(r"\bSort \[", plan)), len(re.findall(r"\bWindow \[", plan))) == (1, windows)
        assert len(re.findall(r"\b(?:Sort|Hash|ObjectHash)Aggregate\(", plan)) == 2 * groups  # each in two halves


def test_names_that_look_like_numbers(spark):
    rows = [
        (1, 1, "c", '{"10":1,"9":{"x":[]},"-3":2,"b":[1,{"2":"]"},3],"1e":{},"":0,"[q]":[[]]}', None, None, None),
        (1, 2, "u", None, '{"9.y":"[","b.1.10":null}', None, None),
        (1, 3, "u", None, None, None, [("b", 2)]),
        (2, 1, "c", '{"b":[0,1,2,3,4,5,6,7,8,9,10,11],"ba":[1]}', None, None, None),
        (2, 2, "u", None, None, None, [("b", 10)]),
        (2, 3, "u", None, '{"b.10":7}', None, [("b", 3)]),
        (3, 1, "c", '{"a":5}', None, None, None),
        (3, 2, "u", None, '{"a.b":1}', None, None),
    ]
    for hot in (100, 1):
        got = {(r.key, *r.path): r.value for r in D.folded(spark.createDataFrame(rows, KIND), ["key"], hot_events=hot).where("key <> 1").collect()}
        assert got == {(2,): "{}", (2, "b"): "[]", **{(2, "b", str(i)): str(i) for i in range(3)}, (2, "b", "10"): "7", (2, "ba"): "[]", (2, "ba", "0"): "1", (3,): "{}", (3, "a"): "5", (3, "a", "b"): "1"}
    got = {r.key: json.loads(r.document) for r in D.documents(spark.createDataFrame(rows, KIND), ["key"]).collect()}
    first = {"10": 1, "9": {"x": [], "y": "["}, "-3": 2, "b": [1, {"2": "]", "10": None}], "1e": {}, "": 0, "[q]": [[]]}
    assert got == {1: first, 2: {"b": [0, 1, 2, 7], "ba": [1]}, 3: {"a": {"b": 1}}}
