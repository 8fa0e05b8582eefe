import random
import re
from itertools import permutations

import numpy as np
import pyarrow as pa
import pytest

from changeloom.llm import audit

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def plain(text):
    words = WORD.findall(text)
    return len(words), len(set(words)), len(re.findall("[A-Z]", text)), len(re.findall(r"[#$%&*|]", text)), len(text)


def some_texts(seed):
    rnd = random.Random(seed)
    alphabet = ["a", "b", "A", "Z", " ", " ", "\n", "\x0b", "#", "|", "é", "漢", "😀", "\x00", " ", "word", "x" * 63, "y" * 64, "z" * 65, "q" * 200]
    texts = ["".join(rnd.choice(alphabet) for _ in range(rnd.randrange(0, 60))) for _ in range(150)]
    return [None, "", " ", "w", *texts, "same word " * 4000, "".join(rnd.choice("ab ") for _ in range(20_000)), "n" * 5000, None, "end"]


@pytest.mark.parametrize("block", [7, 64, 1 << 20])
def test_scan_equals_plain_counts(monkeypatch, block):
    monkeypatch.setattr(audit, "BLOCK", block)
    texts = some_texts(block)
    for kind in (pa.string(), pa.large_string()):
        array = pa.array(["skipped Text #", *texts, "more"], kind).slice(1, len(texts))
        data, ends = audit.buffers(array)
        words, capitals, symbols, characters = audit.class_counts(data, ends)
        distinct = audit.distinct_words(data, ends)
        assert list(zip(words, distinct, capitals, symbols, characters)) == [plain(t or "") for t in texts]


def test_words_with_equal_hashes_are_told_apart(monkeypatch):
    monkeypatch.setattr(audit, "_mix", lambda x: x & np.uint64(1))
    texts = some_texts(3)[:60]
    data, ends = audit.buffers(pa.array(texts, pa.string()))
    assert list(audit.distinct_words(data, ends)) == [plain(t or "")[1] for t in texts]


def brute(docs, labels):
    first, fails = {}, []
    for i, t, s in docs:
        if i is not None:
            first[t or ""] = min(first.get(t or "", i), i)
    for i, t, s in docs:
        t = t or ""
        words, distinct, capitals, symbols, size = plain(t)
        fails.append((s or "", i, {f for f, bad in zip("ABCDE", (words < 200, 100 * distinct < 50 * words, 100 * capitals > 2 * size, symbols > 0, i is not None and i > first[t])) if bad}))
    good = {i for i, q, _ in labels if q == 1 and i is not None}
    toxic = {i for i, _, x in labels if x == 1 and i is not None}
    out = {}
    for part in {p for p, *_ in fails}:
        rows = [(i, f) for p, i, f in fails if p == part]
        removed = {}
        for order in permutations("ABCDE"):
            left = rows
            for k, name in enumerate(order, 1):
                here = [(i, f) for i, f in left if name in f]
                left = [(i, f) for i, f in left if name not in f]
                removed[order, name] = len(here)
                n = sum(name in f for _, f in rows)
                out[part, "".join(order), k] = [len(left), len(here), n - len(here), sum(f == {name} for _, f in rows), sum(i in good for i, _ in here), sum(i in toxic for i, _ in here)]
        for (p, order, k), x in out.items():
            if p == part:
                x.append(sum(v for (_, name), v in removed.items() if name == order[k - 1]))
    return out


def test_query_on_hard_rows(spark, tmp_path):
    rnd = random.Random(5)
    vocabulary = ["alpha", "Beta", "x", "#", "GAMMA"] + [f"w{i}" for i in range(150)]
    texts = [" ".join(rnd.choices(vocabulary[: rnd.choice([5, 155])], k=rnd.choice([3, 199, 200, 230]))) for _ in range(30)]
    docs = [(i, rnd.choice([*texts, None, ""]), rnd.choice(["web", "books", "", None])) for i in range(120)]
    docs += [(7, "twice", "web"), (7, "twice", "web"), (None, "twice", "web"), (None, None, None)]
    labels = [(i, rnd.choice([0, 1, None]), rnd.choice([0, 1, None])) for i in range(0, 120, 2)] + [(4, 1, 0), (None, 1, 1)]
    spark.createDataFrame(docs, "doc_id long, text string, source string").selectExpr("*", "1 as mask", "'x' as part", "'y' as digest").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    got = {(r[0], r[1], r[2]): list(r[3:]) for r in audit.op11_filter_audit(spark, str(tmp_path)).collect()}
    assert got == brute(docs, labels)


def test_empty_table(spark, tmp_path):
    spark.createDataFrame([], "doc_id long, text string, source string").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    assert audit.op11_filter_audit(spark, str(tmp_path)).count() == 0
