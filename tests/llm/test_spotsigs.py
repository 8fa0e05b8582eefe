import hashlib
import random
import re

from changeloom.llm import spotsigs as S

ANCHORS = set(S.ANCHORS)


def chains(text):
    """The signature set of a text as tuples of words, one word after the other."""
    words = re.findall(r"[^\W_]+", text.lower())
    out, content = set(), [i for i, w in enumerate(words) if w not in ANCHORS]
    for i, w in enumerate(words):
        if w in ANCHORS and i + 1 < len(words) and words[i + 1] not in ANCHORS:
            after = [j for j in content if j > i][:2]
            if len(after) == 2:
                out.add((w, words[after[0]], words[after[1]]))
    return out or {(w,) for w in words} or {text}


def like(a, b):
    return len(a & b) / len(a | b)


def texts(n, seed=3):
    r = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(300)] + list(ANCHORS) * 4
    base = [" ".join(r.choice(vocabulary) for _ in range(r.randint(1, 120))) for _ in range(n)]
    for i in range(0, n, 3):
        words = base[i].split()
        words[r.randrange(len(words))] = "changed"
        base.append(" ".join(words))
    return base + ["", None, "the the the the", "to " * 3000, "one", "!?", base[0]]


def components(sets, percent):
    """The smallest id reachable over pairs of near sets, by comparing all of them."""
    root = {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in sorted(sets):
        for b in sorted(sets):
            if a < b and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]):
                p, q = find(a), find(b)
                root[max(p, q)] = min(p, q)
    return {i: find(i) for i in sets}


def test_query_against_brute_force(spark, tmp_path):
    rows = [(i * 3, t) for i, t in enumerate(texts(60))]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = {r.doc_id: r for r in S.op7_spotsigs(spark, str(tmp_path)).collect()}
    assert len(got) == len(rows)
    down = sorted(rows, reverse=True, key=lambda r: r[0])
    prints = {}
    for k, (i, t) in enumerate(down):
        t, nxt = t or "", down[(k + 1) % len(down)][1] or ""
        cut = len(t) // 3
        edited = t[: len(t) - cut] + nxt[:cut]
        r = got[i]
        assert r.n_chars == len(t) and r.edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        assert abs(r.near_edited - like(chains(t), chains(edited))) < 1e-9
        assert abs(r.near_next - like(chains(t), chains(nxt))) < 1e-9
        assert len(r.fingerprint.split()) == len(chains(t))
        assert prints.setdefault(t, r.fingerprint) == r.fingerprint
    near = components({i: chains(t or "") for i, t in rows}, 80)
    assert {r.doc_id: (r.n_signatures, r.near_class) for r in S.spotsigs_near_duplicates(spark, str(tmp_path)).collect()} == {i: (len(chains(t or "")), near[i]) for i, t in rows}
    assert len(set(near.values())) < len(rows) - 10


def test_next_row_with_gaps_ties_and_one_row(spark, monkeypatch):
    nexts = lambda df: S.with_next(df, "doc_id", "text", lambda d: d)
    ids = [5, 5, 900, 10**18, -7, None, None]
    df = spark.createDataFrame([(i, f"t{k}") for k, i in enumerate(ids)], "doc_id long, text string")
    got = {r.text: r.next_text for r in nexts(df).collect()}
    assert len(got) == 7 and sorted(got.values()) == sorted(got)
    assert got["t3"] == "t2" and {got["t2"], got[got["t2"]]} == {"t0", "t1"} and got[got[got["t2"]]] == "t4" and got["t4"] in ("t5", "t6") and got[got[got["t4"]]] == "t3"
    assert nexts(df.limit(1)).collect()[0].next_text == "t0"
    assert nexts(df.limit(0)).count() == 0
    monkeypatch.setattr(S, "BIN_ROWS", 4)
    monkeypatch.setattr(S, "QUANTILES", 2)
    rows = [(k * k, f"t{k}") for k in range(300)] + [(2**62, "t300")]
    got = {r.text: r.next_text for r in nexts(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {f"t{k}": f"t{(k - 1) % 301}" for k in range(301)}


def test_near_classes_equal_all_pairs(spark):
    rows = [(i, t) for i, t in enumerate(texts(80, 5))]
    r = random.Random(4)
    base = [w for i in range(60) for w in ("the", f"a{i}", f"b{i}")]
    for i in range(70):  # copies that are near the original or not, and near each other or not
        copy = list(base)
        for _ in range(r.randint(0, 9)):
            copy[r.randrange(60) * 3 + 1] = f"z{r.randrange(9)}"
        rows.append((1000 + i, " ".join(copy)))
    df = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 as key", "2 as root", "3 as h")
    got = {x.doc_id: x.near_class for x in S.near_duplicates(df, percent=70).collect()}
    assert got == components({i: chains(t or "") for i, t in rows}, 70)
