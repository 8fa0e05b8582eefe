import hashlib
import random
import zlib
from collections import defaultdict

import pytest

from changeloom.llm import trie

COLUMNS = [f.split()[0] for f in trie.NODE.split(", ")]


def key(role, text):
    role, text = role or "", text or ""
    return hashlib.sha256(f"{len(role.encode())}:{role}{text}".encode()).hexdigest()[:32]


def brute(rows):
    own = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            own[conv].append((turn is not None, turn or 0, key(role, text), role or "", text or ""))
    own = {c: [(r, t) for *_, r, t in sorted(x)] for c, x in own.items()}
    members, ends = defaultdict(list), defaultdict(list)
    for c in own:
        h, base = zlib.crc32(str(c).encode()) % 9, c - (abs(c) % 5 if c >= 0 else -(abs(c) % 5))
        path = tuple(own.get(base, [])[:h] + own[c][h:])
        for d in range(len(path) + 1):
            members[path[:d]].append(c)
        ends[path].append(c)
    children = defaultdict(int)
    for p in members:
        if p:
            children[p[:-1]] += 1
    leaves, saved = defaultdict(int), defaultdict(int)
    for p, m in members.items():
        for d in range(len(p) + 1):
            leaves[p[:d]] += not children[p]
            saved[p[:d]] += (len(m) - 1) * (len(p[-1][1].encode()) if p else 0)
    sha = lambda ids: hashlib.sha256(",".join(map(str, sorted(ids))).encode()).hexdigest()
    return sorted(((min(m), len(p), min(members[p[:-1]]) if p else None, len(m), children[p], leaves[p], saved[p], sha(ends[p])) for p, m in members.items()), key=repr)


def some_rows(seed):
    rnd = random.Random(seed)
    texts = ["", None, "a", "é漢😀", "hello", "hello ", "x" * 300]
    rows = []
    for c in rnd.sample(range(-40, 400), 160):
        kind = rnd.random()
        for t in range(12 if kind < 0.3 else rnd.randrange(1, 14)):
            text = texts[t % 3] if kind < 0.5 else rnd.choice(texts)  # many equal conversations
            rows.append((c, rnd.choice([t, t, t, None]), "user" if t % 2 else None, text))
    rows += rows[:20] + [(None, 0, "user", "nobody's")]
    rnd.shuffle(rows)
    return rows


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_trie_equals_brute_force(spark, tmp_path, monkeypatch, seed):
    monkeypatch.setattr(trie, "RANGE_BYTES", 700)  # many ranges
    monkeypatch.setattr(trie, "PIECE_IDS", 3)
    monkeypatch.setattr(trie, "OUT_ROWS", 7)
    rows = some_rows(seed)
    d = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").selectExpr("*", "'x' as depth", "1 as seq", "2 as n")
    d.repartition(3).write.parquet(f"{tmp_path}/conversations.parquet")
    got = [tuple(r[c] for c in COLUMNS) for r in trie.op12_prefix_trie(spark, str(tmp_path)).collect()]
    assert sorted(got, key=repr) == brute(rows)


def test_long_conversations_and_one_group(spark, tmp_path):
    rows = [(c, t, "user", f"turn {t}") for c in (5, 10, 15) for t in range(1500)] + [(c, 0, "user", "same") for c in range(100, 400)]
    spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").write.parquet(f"{tmp_path}/conversations.parquet")
    got = trie.op12_prefix_trie(spark, str(tmp_path)).collect()
    by = {(r.conv_id, r.depth): r for r in got}
    ids = [c for c in (5, 10, 15, *range(100, 400))]
    root = by[5, 0]
    assert root.n_convs == len(ids) and root.parent_conv_id is None
    assert by[5, 1500].n_children == 0 and by[5, 1500].n_convs == 3 and by[5, 1500].ends_sha256 == hashlib.sha256(b"5,10,15").hexdigest()
    assert by[5, 1].saved_tokens == 2 * sum(len(f"turn {t}") for t in range(1500))
    full = range(100, 400)
    assert by[100, 1].n_convs == len(full) and by[100, 1].ends_sha256 == hashlib.sha256(",".join(map(str, full)).encode()).hexdigest()


def test_merging_keeps_order_and_prefixes():
    rnd = random.Random(9)
    seqs = sorted({b"".join(rnd.choice((b"0", b"1")) * trie.TURN for _ in range(n)) for n in (3, 4, 5) for _ in range(60)})
    for size in (1, 2, 3, 7):
        some = seqs[:]
        rnd.shuffle(some)
        runs = [trie.sorted_run(some[k::size])[1] for k in range(size)]
        out = [(runs[r][0][p], lcp) for r, p, lcp in trie.merged(runs)]
        assert [s for s, _ in out] == seqs
        assert [n for _, n in out][1:] == [trie.shared_turns(a, b) for a, b in zip(seqs, seqs[1:])]


def test_empty_table(spark, tmp_path):
    spark.createDataFrame([], "conv_id long, turn long, role string, text string").write.parquet(f"{tmp_path}/conversations.parquet")
    assert trie.op12_prefix_trie(spark, str(tmp_path)).count() == 0
