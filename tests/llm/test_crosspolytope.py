import numpy as np
import pytest

from changeloom.llm import crosspolytope as cp

KIND = "vec_id long, embedding array<float>, label int"


def brute(rows):
    """``n_links, component`` by comparing all pairs."""
    n = len(rows)
    usable = [v is not None and len(v) > 0 and label is not None and all(x is not None and np.isfinite(x) for x in v) and any(v) for _, v, label in rows]
    vectors = [np.array(v, np.float32).astype(np.float64) if ok else None for ok, (_, v, _) in zip(usable, rows)]
    root = list(range(n))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    links = [0] * n
    for i in range(n):
        for j in range(i):
            if usable[i] and usable[j] and rows[i][2] == rows[j][2] and len(vectors[i]) == len(vectors[j]):
                if vectors[i] @ vectors[j] / np.sqrt((vectors[i] @ vectors[i]) * (vectors[j] @ vectors[j])) >= cp.COSINE:
                    links[i] += 1
                    links[j] += 1
                    a, b = sorted((find(i), find(j)))
                    root[b] = a
    return links, [find(i) for i in range(n)]


def clusters(seed, dim=64):
    """Groups of near copies by growing noise, exact and scaled copies, and vectors that are alike with none."""
    r = np.random.default_rng(seed)
    rows = []
    for label, noise in enumerate((0.05, 0.15, 0.25, 0.35)):
        for group in (2, 9, 25):
            centre = r.standard_normal(dim)
            rows += [(centre + noise * r.standard_normal(dim), label) for _ in range(group)]
    rows += [(v, label) for v, label in rows[:30]] + [(3 * v, label) for v, label in rows[30:40]] + [(v, 9) for v, _ in rows[:5]]
    rows += [(r.standard_normal(dim), int(r.integers(0, 4))) for _ in range(60)]
    order = r.permutation(len(rows))
    return [(int(i), np.float32(rows[k][0]).tolist(), rows[k][1]) for i, k in enumerate(order)]


@pytest.mark.parametrize("seed", [1, 2])
def test_links_equal_all_pairs(spark, seed):
    rows = clusters(seed)
    links, component = brute(rows)
    got = {r.vec_id: r for r in cp.near_vectors(spark.createDataFrame(rows, KIND)).collect()}
    assert len(got) == len(rows)
    found = sum(got[i].n_links for i in range(len(rows)))
    assert all(got[i].n_links <= links[i] for i in range(len(rows))) and found >= 0.999 * sum(links)
    assert all(got[i].component_id == component[i] and got[i].kept == (component[i] == i) for i in range(len(rows)))


def test_threshold_pairs_meet(spark):
    r = np.random.default_rng(4)
    x, u = r.standard_normal((2, 1500, 64))
    x /= np.linalg.norm(x, axis=1)[:, None]
    u -= (u * x).sum(1)[:, None] * x
    y = 0.9301 * x + np.sqrt(1 - 0.9301**2) * u / np.linalg.norm(u, axis=1)[:, None]
    for levels in (2, 3):
        a, b = (cp.bucket_codes(z, levels, cp.tables_for(levels)).reshape(len(x), -1) for z in (x, y))
        assert np.mean([len(np.intersect1d(p, q)) > 0 for p, q in zip(a, b)]) > 0.998


def test_hard_rows(spark):
    v, w = [1.0, 2.0, 0.0], [1.0, 2.0, -0.0]
    rows = [(1, v, 1), (2, w, 1), (3, v, None), (4, None, 1), (5, [], 1), (6, [0.0, 0.0, 0.0], 1), (7, [float("nan"), 1.0, 1.0], 1), (8, [float("inf"), 1.0, 1.0], 1), (9, [1.0, None, 1.0], 1)]
    rows += [(10, [1.0, 2.0], 1), (11, [2.0, 4.0], 1), (12, [1e-30, 2e-30], 1), (13, [3.0], 1), (14, [5.0], 1), (15, [-5.0], 1), (16, v, 2)]
    d = spark.createDataFrame(rows, KIND).selectExpr("*", "1 as n", "2 as cls", "'x' as bucket")
    got = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in cp.near_vectors(d).collect()}
    want = {i: (0, i, True) for i, *_ in rows} | {1: (1, 1, True), 2: (1, 1, False), 10: (2, 10, True), 11: (2, 10, False), 12: (2, 10, False), 13: (1, 13, True), 14: (1, 13, False)}
    assert got == want


def test_rows_without_an_id_of_their_own(spark):
    rows = [(5, [1.0, 0.0], 1), (5, [0.0, 1.0], 1), (None, [0.0, 2.0], 1), (None, [-1.0, 0.0], 1), (None, [-2.0, 0.0], 1), (3, [0.0, 3.0], 1)]
    got = sorted(((r.vec_id, r.n_links, r.component_id, r.kept) for r in cp.near_vectors(spark.createDataFrame(rows, KIND)).collect()), key=repr)
    assert got == sorted([(5, 0, 5, True), (5, 2, 3, False), (None, 2, 3, False), (3, 2, 3, True), (None, 1, None, True), (None, 1, None, False)], key=repr)


def test_empty_table(spark):
    assert cp.near_vectors(spark.createDataFrame([], KIND)).count() == 0
