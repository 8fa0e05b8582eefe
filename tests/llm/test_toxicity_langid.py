import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from changeloom.llm import langid, toxicity
from changeloom.llm.common import crc32_of, read
from changeloom.llm.entry import QUERIES

SF = "/root/testdata/sf0.01"


def by_definition(scores):
    """All maximal segments: the best one, then the best of what is left of and right of it."""
    best, where = 0, None
    for i in range(len(scores)):
        for j in range(i + 1, len(scores) + 1):
            s = sum(scores[i:j])
            if s > best or (s == best and where and j - i < where[1] - where[0]):
                best, where = s, (i, j)
    if where is None:
        return []
    i, j = where
    return by_definition(scores[:i]) + [(i, j)] + [(a + j, b + j) for a, b in by_definition(scores[j:])]


@settings(max_examples=200, deadline=None)
@given(st.lists(st.floats(-5, 5).map(lambda x: round(x * 37.77, 6) or 0.5), max_size=9))
def test_segments_are_the_maximal_ones(scores):
    got = toxicity.maximal_segments((i, i + 1, s) for i, s in enumerate(scores))
    assert abs(sum(s for *_, s in got) - sum(sum(scores[i:j]) for i, j in by_definition(scores))) < 1e-6
    assert [(b, e) for b, e, _ in got] == sorted((b, e) for b, e, _ in got)


def test_toxic_words_are_learned_and_odd_rows_scored(spark):
    r = random.Random(4)
    plain = [f"word{i}" for i in range(60)]
    rows, labels = [], []
    for i in range(300):
        words = [r.choice(plain) for _ in range(80)]
        if i % 3 == 0:
            for k in range(3):
                words.insert(r.randrange(len(words)), r.choice(["nastything", "vilestuff"]))
        rows.append((i, " ".join(words)))
        labels.append((i, int(i % 3 == 0)))
    docs = spark.createDataFrame(rows + [(900, None), (901, ""), (902, "nastything vilestuff " * 2000), (903, "nastything")], "doc_id long, text string").selectExpr("*", "0 as score", "'x' as toxic")
    model = toxicity.fit(docs, spark.createDataFrame(labels + [(1, None)], "doc_id long, toxic int"))
    got = {x.doc_id: x for x in toxicity.score(docs, model).collect()}
    assert len(got) == len(rows) + 4
    assert all(got[i].predicted == y for i, y in labels)
    assert got[900].score == got[901].score < 0.5 and got[902].predicted == 1
    spans = toxicity.passages(docs.where("doc_id = 902"), model).collect()
    assert spans and all(s.begin < s.end for s in spans)
    kept = toxicity.keep_clean(docs, model)
    assert kept.columns == docs.columns and kept.count() == sum(x.predicted == 0 for x in got.values())
    none = toxicity.fit(docs, spark.createDataFrame([], "doc_id long, toxic int"))
    assert all(x.score < 0.01 for x in toxicity.score(docs.limit(3), none).collect())


def test_held_out_toxicity(spark):
    got = QUERIES["op8_toxic_segments"](spark, SF).join(read(spark, SF, "labels"), "doc_id").where("held_out").collect()
    assert sum(r.predicted == r.toxic for r in got) / len(got) > 0.93


def test_held_out_languages(spark):
    docs = read(spark, SF, "documents")
    got = QUERIES["op10_zstd_language"](spark, SF).join(docs.select("doc_id", "lang"), "doc_id").where("held_out").collect()
    assert sum(r.lang_pred == r.lang for r in got) / len(got) > 0.96
    assert all(0 <= r.score <= 1 for r in got)


def test_languages_of_odd_texts(spark):
    rows = [(i, t, g) for i, (t, g) in enumerate([("the cat and the dog are here " * 9, "en"), ("der hund und die katze sind hier " * 9, "de")] * 9)]
    rows += [(100, None, "en"), (101, "", "en"), (102, "123 !? --", "de"), (103, "THE CAT AND THE DOG", None), (104, "der hund und die katze " * 5000, None), (105, "Katze", "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").selectExpr("*", "1 as _lang", "2 as accepted")
    model = langid.fit(docs.where("lang <> ''"))
    got = {r.doc_id: r for r in langid.predict(docs, model).collect()}
    assert [got[i].lang_pred for i in (100, 101, 102, 103, 104)] == ["und", "und", "und", "en", "de"] and got[100].score == 0
    assert langid.keep_accepted(docs, model).columns == docs.columns
    assert {r.lang_pred for r in langid.predict(docs, {}).collect()} == {"und"}
    assert langid.predict(docs.limit(0), model).count() == 0


def test_crc_matches_zlib(spark):
    import zlib

    for r in spark.range(0, 50).select("id", crc32_of("id").alias("c")).collect():
        assert r.c == zlib.crc32(str(r.id).encode())
    with pytest.raises(Exception):
        toxicity.fit(spark.range(1), spark.range(1))


def test_the_margin_of_very_long_texts(spark):
    rnd = random.Random(5)
    vocabulary = {k: ["".join(rnd.choices("abcdefghijklmnop", k=rnd.randrange(3, 10))) for _ in range(3000)] for k in ("x", "y")}
    said = lambda k, n: " ".join(rnd.choices(vocabulary[k], k=n))
    model = {k: tuple(langid.letters(said(k, 38_000)) for _ in range(2)) for k in vocabulary}
    loaded = langid._load(model)
    long = said("x", 2_500_000)
    lang, _, accepted = langid.classify(long, loaded)
    assert len(long) > 16_000_000 and lang == "x" and accepted
    assert langid.classify(said("x", 1000), loaded)[::2] == ("x", True)
    # between two languages, however long
    assert not langid.classify(" ".join(said("xy"[i % 2], 100) for i in range(2000)), loaded)[2]


def test_every_language_is_learned(spark):
    docs = spark.createDataFrame([(i, f"l{i}", "word " * 3) for i in range(450)], "doc_id long, lang string, text string")
    assert len(langid.fit(docs)) == 450


def test_number_characters_are_no_letters():
    assert langid.letters("½ ① ² 12 --") == b"" and langid.letters("a½b É") == " a b é ".encode()


def test_dictionaries_and_answers_equal_brute_force(spark, monkeypatch):
    import xxhash
    import zstandard

    monkeypatch.setattr(langid, "DICTIONARY_BYTES", 4096)
    rnd = random.Random(6)
    vocabulary = {k: ["".join(rnd.choices("abcdefghij", k=rnd.randrange(3, 9))) for _ in range(400)] for k in "xyz"}
    rows = [(i, " ".join(rnd.choices(vocabulary["xyz"[i % 3]], k=rnd.choice((3, 40, 900)))), "xyz"[i % 3]) for i in range(120)]
    model = langid.fit(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    for lang in "xyz":
        blocks = {}
        for _, t, g in rows:
            raw = f" {t} ".encode() if g == lang else b""
            blocks |= {xxhash.xxh3_64_intdigest(raw[k : k + 1024]) >> 1: raw[k : k + 1024] for k in range(0, len(raw), 1024)}
        first = [blocks[h] for h in sorted(blocks)[:8]]
        assert model[lang] == (b"".join(first[::2]), b"".join(first[1::2]))
    tests = [(i, " ".join(rnd.choices(vocabulary["xyz"[i % 3]] + vocabulary["x"][:100], k=1 + i * 3))) for i in range(60)]
    got = {r.doc_id: r for r in langid.predict(spark.createDataFrame(tests, "doc_id long, text string"), model).collect()}
    packed = lambda raw, t: len(zstandard.ZstdCompressor(level=langid.LEVEL, dict_data=zstandard.ZstdCompressionDict(raw, dict_type=zstandard.DICT_TYPE_RAWCONTENT), write_content_size=False, write_dict_id=False).compress(t))
    for i, t in tests:
        sizes = sorted((sum(packed(d, f" {t} ".encode()) for d in two), k) for k, two in model.items())
        assert got[i].lang_pred == sizes[0][1] and got[i].accepted == (sizes[1][0] - sizes[0][0] >= langid.MARGIN * sizes[1][0])


def test_log_odds_and_calibration_equal_brute_force(spark):
    import math
    from collections import Counter

    import numpy as np

    rnd = random.Random(3)
    rows, labels = [], []
    for i in range(400):
        toxic = int(i % 4 == 0)
        words = rnd.choices(["sun", "tree", "river", "stone", "cloud", "horses"], k=rnd.randrange(5, 40)) + (rnd.choices(["vileword", "nasty", "hatefully"], k=rnd.randrange(1, 6)) if toxic and i % 8 else [])
        rows.append((i, " ".join(rnd.sample(words, len(words)))))
        labels.append((i, toxic))
    docs = spark.createDataFrame([*rows, *rows[:40]], "doc_id long, text string").selectExpr("*", "1 as _y", "2 as w")
    model = toxicity.fit(docs, spark.createDataFrame([*labels, *labels[:9], (5, None)], "doc_id long, toxic int"))
    seen = (Counter(), Counter())
    for (_, t), (_, y) in zip(rows, labels):
        seen[y].update({u for w in set(t.split()) for u in toxicity.units_of(w)})
    both = seen[0] + seen[1]
    counted = {w for w in both if both[w] >= 3}
    n = [sum(seen[y][w] for w in counted if not w.endswith("*")) for y in (0, 1)]
    share = toxicity.PRIOR_SHARE
    for w in counted:
        y = [seen[c][w] + share * both[w] for c in (0, 1)]
        odds = [math.log(y[c] / (n[c] + share * sum(n) - y[c])) for c in (0, 1)]
        z = (odds[1] - odds[0]) / math.sqrt(1 / y[0] + 1 / y[1])
        if abs(z) >= toxicity.SIGNIFICANT_Z:
            assert np.allclose(model.weights.pop(w), (odds[1] - odds[0], z))
    assert not model.weights
    weights, p = np.array([2.0, -1.0, -0.3]), np.array([0.1, 0.3, 0.6])
    lam, _ = toxicity.karlin(weights, p)
    assert abs((p * np.exp(lam * weights)).sum() - 1) < 1e-9
    # K by the mean of the largest segments of random texts, which is (log(K * n) + Euler's constant) / lambda
    rng = np.random.default_rng(3)
    for weights, p in ((np.array([1.37, -0.61, -0.29]), np.array([0.15, 0.35, 0.5])), (np.array([3.17, -0.05]), np.array([0.002, 0.998]))):
        lam, k = toxicity.karlin(weights, p)
        n, run, best = 20_000, np.zeros(1000), np.zeros(1000)
        for _ in range(n):
            run = np.maximum(run + weights[np.searchsorted(np.cumsum(p), rng.random(1000) * p.sum())], 0)
            best = np.maximum(best, run)
        assert abs(best.mean() * lam - 0.5772 - np.log(k * n)) < 0.35
    x = np.random.default_rng(1).normal(size=(200, 2))
    y = (x[:, 0] + np.random.default_rng(2).normal(size=200) > 0).astype(float)
    w = toxicity.logistic(x, y, ridge=0.0)
    full = np.hstack([np.ones((200, 1)), x])
    assert abs(full.T @ (y - 1 / (1 + np.exp(-full @ w)))).max() < 0.01  # the likelihood's gradient vanishes
