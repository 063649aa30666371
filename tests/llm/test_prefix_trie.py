import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from gridloom.llm import prefix_trie as op
from gridloom.llm.centroid import centroid_sums

WORD = re.compile("[^\x20\x09-\x0d]+")
SCHEMA = "conv_id long, turn long, role string, text string, depth int, _conv string"


def item(role, text):
    role, text = role or "", text or ""
    return hashlib.sha256(f"{len(role.encode())}:{role}{text}".encode()).digest()[:16]


def brute(rows):
    own = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            own[conv].append(((turn is not None, turn or 0), item(role, text), role or "", text or ""))
    talks = {}
    for c in own:
        h = zlib.crc32(str(c).encode()) % 4
        talk = lambda x: [t[2:] for t in sorted(own.get(x, []))]
        talks[c] = talk(c - c % 20)[:h] + talk(c)[h:]
    members = defaultdict(list)
    for c, talk in talks.items():
        for d in range(len(talk) + 1):
            members[tuple(talk[:d])].append(c)
    kids = Counter(k[:-1] for k in members if k)
    leaves, saved = Counter(), Counter()
    for k, m in members.items():
        words = len(WORD.findall(k[-1][1])) if k else 0
        for d in range(len(k) + 1):
            leaves[k[:d]] += not kids[k]
            saved[k[:d]] += (len(m) - 1) * words
    ends = {k: hashlib.sha256(",".join(map(str, sorted(c for c in m if len(talks[c]) == len(k)))).encode()).hexdigest() for k, m in members.items()}
    return Counter((min(m), len(k), min(members[k[:-1]]) if k else None, len(m), kids[k], leaves[k], saved[k], ends[k]) for k, m in members.items())


def run(spark, rows, **how):
    df = spark.createDataFrame([(*r, 7, "x") for r in rows], SCHEMA)
    return Counter(map(tuple, op.trie(df, **how).collect()))


def bushy(seed, convs=60):
    rng = random.Random(seed)
    return [(c, t, rng.choice(["user", "assistant"]), rng.choice(["a", "b b", "c c c", ""])) for c in range(convs) for t in range(rng.randrange(1, 7))]


@pytest.mark.parametrize("seed", range(20))
def test_sums_on_arrays_equal_brute_force(seed):
    rng = np.random.default_rng(seed)
    n = int(rng.integers(1, 120))
    parent = np.array([-1 if i == 0 or rng.random() < 0.05 else int(rng.integers(max(0, i - (1 if seed % 3 == 0 else 9)), i)) for i in range(n)])
    weight, values = rng.integers(1, 5, n), rng.integers(0, 9, (n, 2))
    load, want = weight.copy(), values.copy()
    for i in range(n - 1, 0, -1):
        if parent[i] >= 0:
            load[parent[i]] += load[i]
            want[parent[i]] += want[i]
    shuffled = rng.permutation(n)
    place = np.argsort(shuffled)
    moved = np.where(parent[shuffled] < 0, -1, place[parent[shuffled]])
    assert np.array_equal(centroid_sums(moved, load[shuffled], values[shuffled]), want[shuffled])


def test_a_deep_chain_takes_no_recursion():
    n = 30_000
    got = centroid_sums(np.arange(n) - 1, np.arange(n, 0, -1), np.ones((n, 1), np.int64))
    assert np.array_equal(got[:, 0], np.arange(n, 0, -1))


@pytest.mark.parametrize("seed, limit, block", [(1, 1 << 11, 1 << 10), (2, 40, 2), (3, 3, 3), (4, 1, 1)])
def test_trie_equals_brute_force_at_any_split(spread, seed, limit, block):
    rows = bushy(seed)
    assert run(spread, rows, limit=limit, block=block) == brute(rows)


def test_long_chain_is_split_by_rounds(spark, monkeypatch):
    monkeypatch.setattr(op.centroid, "BLOCK", 8)
    rows = [(c, t, "user", f"w{t} {c if t > 70 else ''}") for c in (0, 1, 2, 5) for t in range(90)]
    assert run(spark, rows, limit=30, block=16) == brute(rows)


def test_hot_opening_and_many_equal_conversations(spark, monkeypatch):
    monkeypatch.setattr(op, "PIECE", 7)
    rows = [(c, t, "user", "same" if c % 3 == 0 or t == 0 else f"own {c}") for c in range(150) for t in range(3)]
    assert run(spark, rows, limit=20) == brute(rows)


def test_nulls_ties_repeats_missing_bases_and_empty(spark):
    rows = [(20, None, None, None), (20, 0, "user", "Hi there"), (20, 0, "user", "Hi there"), (20, 0, None, "zzz"), (21, 3, "a", ""), (23, 1, "", "a"),
            (45, 0, "user", None), (46, 0, "user", "x " * 50_000), (61, 9, "user", "only"), (None, 0, "user", "lost"), (0, 5, "user", " \t\n"), (7, 0, "é", "ü b c")]
    assert run(spark, rows) == brute(rows)
    assert run(spark, rows[:0]) == Counter()
    alone = [(c, 0, "user", "gone") for c in (121, 122, 125, 127)]  # bases absent: some are left without a turn
    assert run(spark, alone) == brute(alone) and any(zlib.crc32(str(c).encode()) % 4 for c in (121, 122, 125, 127))


def test_whole_table_equals_brute_force(spark):
    talks = spark.read.parquet("/root/testdata/sf0.01/conversations.parquet")
    rows = [tuple(r) for r in talks.select("conv_id", "turn", "role", "text").collect()]
    assert Counter(map(tuple, op.trie(talks, limit=100).collect())) == brute(rows)
