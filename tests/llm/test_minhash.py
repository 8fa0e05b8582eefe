import random

import numpy as np

from changeloom.llm import minhash as M


def shingles(text):
    words = [w for w in "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "").replace("\t", " ").replace("\n", " ").split(" ") if w]
    return frozenset(tuple(words[i : i + 5]) for i in range(max(len(words) - 4, 1))) if words else frozenset()


def brute(rows):
    """Components and set sizes by comparing all pairs."""
    sets = {i: shingles(t) for i, t in rows}
    root = {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    ids = sorted(sets)
    for k, a in enumerate(ids):
        for b in ids[k + 1 :]:
            x, y = sets[a], sets[b]
            if x and y and 100 * len(x & y) >= 85 * len(x | y):
                p, q = find(a), find(b)
                root[max(p, q)] = min(p, q)
    return {i: (len(sets[i]), find(i)) for i in ids}


def corpus(seed=1):
    r = random.Random(seed)
    word = lambda: f"w{r.randrange(5000)}"
    passage = [word() for _ in range(60)]
    texts = [None, "", " \t\n", "one", "One", "a b c d", "é ü a b c d", "x" * 10_000, "to " * 3000]
    for _ in range(6):
        base = [word() for _ in range(r.randint(60, 220))]
        for _ in range(7):  # chains of edits: neighbours are alike, ends may not be
            texts.append(" ".join(base))
            base = list(base)
            for _ in range(r.randint(0, 3)):
                base[r.randrange(len(base))] = word()
    for _ in range(15):  # a common passage doesn't make a pair
        texts.append(" ".join([word() for _ in range(40)] + passage + [word() for _ in range(40)]))
    near = [word() for _ in range(300)]
    for i in range(20):
        texts.append(" ".join(near[:i * 3] + ["changed"] + near[i * 3 + 1 :]))
    r.shuffle(texts)
    return list(enumerate(texts + texts[:5]))


def test_components_equal_all_pairs(spark):
    rows = corpus()
    df = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 as sketch", "2 as head", "3 as key", "4 as row_id", "5 as doc")
    want = brute(rows)
    got = {r.doc_id: r for r in M.cluster(df).collect()}
    assert len(got) == len(rows)
    assert {i: (r.n_shingles, r.component_id) for i, r in got.items()} == want
    assert all(r.kept == (r.component_id == i) for i, r in got.items())


def test_signature_estimates_and_halves_the_hashing():
    rng = np.random.default_rng(5)
    a = np.unique(rng.integers(0, 1 << 63, 4000, np.uint64))
    b = np.concatenate([a[: len(a) * 9 // 10], np.unique(rng.integers(0, 1 << 63, len(a) // 10, np.uint64))])
    truth = len(np.intersect1d(a, b)) / len(np.union1d(a, b))
    x, y = M.signature(a), M.signature(b)
    assert len(x) == 2 * M.PERMUTATIONS == M.BANDS * M.BAND_VALUES
    assert abs((x == y).mean() - truth) < 0.1


def test_repeated_rows_and_empty_table(spark):
    rows = [(1, "a b c d e f"), (1, "a b c d e f"), (2, "a b c d e f"), (None, "a b c d e f g")]
    got = M.cluster(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted((r.doc_id or 0, r.component_id or 0) for r in got) == [(0, 0), (1, 1), (1, 1), (2, 1)]
    assert M.cluster(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_one_document_with_two_texts(spark):
    text = lambda k: " ".join(f"w{k}x{i}" for i in range(60))
    rows = [(5, text(1)), (5, text(2)), (7, text(1)), (9, text(2) + " end"), (11, text(3)), (None, text(3)), (None, text(4))]
    got = M.cluster(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted((r.doc_id or 0, r.n_shingles, r.component_id or 0, r.kept) for r in got) == [
        (0, 56, 0, True), (0, 56, 11, False), (5, 56, 5, True), (5, 56, 5, True), (7, 56, 5, False), (9, 57, 5, False), (11, 56, 11, True),
    ]


def test_open_pairs_of_a_large_bucket_lose_no_link(spark, monkeypatch):
    """Copies around two centres that share most shingles: with small buckets off, the prefix filter alone finds what stars leave."""
    r = random.Random(9)
    base = [f"b{i}" for i in range(200)]
    rows = []
    for i in range(90):
        t = list(base)
        for _ in range(r.randint(1, 9)):
            t[r.randrange(200)] = f"z{r.randrange(40)}"
        rows.append((i, " ".join(t)))
    monkeypatch.setattr(M, "SMALL_BUCKET", 0)
    got = {x.doc_id: (x.n_shingles, x.component_id) for x in M.cluster(spark.createDataFrame(rows, "doc_id long, text string"), sketch_bits=None).collect()}
    assert got == brute(rows)
    left = spark.createDataFrame([(i, i) for i, _ in rows], "key long, root long")
    found = {frozenset((x.a, x.b)) for x in M.open_pairs(left, spark.createDataFrame(rows, "key long, text string")).collect()}
    sets = {i: shingles(t) for i, t in rows}
    assert {frozenset((a, b)) for a in sets for b in sets if a < b and 100 * len(sets[a] & sets[b]) >= 85 * len(sets[a] | sets[b])} <= found
