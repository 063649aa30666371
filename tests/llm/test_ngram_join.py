import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from gridloom.llm import ngram_join as op
from gridloom.llm.components import components
from gridloom.llm.count_rtree import GROUPS, CountTree, needed

WORD = re.compile("[^\x20\x09-\x0d]+")
LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def shingles(text, size=4):
    w = WORD.findall((text or "").translate(LOWER))
    return frozenset(tuple(w[i:i + size]) for i in range(max(1, len(w) - size + 1))) if w else frozenset()


def brute(rows, per_cent=85):
    sets = [shingles(t) for _, t in rows]
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= per_cent * len(sets[i] | sets[j]):
                parent[find(i)] = find(j)
    least = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            least[find(i)] = min(d, least.get(find(i), d))
    return [(d, len(sets[i]), least.get(find(i)) if sets[i] else d) for i, (d, _) in enumerate(rows)]


def run(spark, rows):
    df = spark.createDataFrame([(*r, 1) for r in rows], "doc_id long, text string, component_id int")
    return Counter((r._id, r.n_shingles, r.component_id) for r in op.near_duplicates(df).collect())


def near_copies(seed, groups=6, copies=12, words=60):
    """Copies with one or two words changed: chains of links, some pairs under the limit."""
    rng, rows = random.Random(seed), []
    for g in range(groups):
        base = [f"g{g}w{rng.randrange(200)}" for _ in range(words)]
        for _ in range(copies):
            own = list(base)
            for _ in range(rng.randrange(3)):
                own[rng.randrange(words)] = f"x{rng.randrange(10**6)}"
            rows.append((len(rows) * 7 % 1009, " ".join(own)))
            if rng.random() < 0.3:
                base = own
    return rows


EDGES = [(5, None), (6, ""), (7, " \n"), (8, "a b"), (3, "A  b"), (9, "a b c"), (None, "p q r s t"), (2, "p q r s t"), (2, "p q r s t"), (None, "lone words of a row"),
         (11, "same " * 3000), (10, "same same same same"), (12, "long " + " ".join(map(str, range(9000)))), (1, "long " + " ".join(map(str, range(9000))) + " end")]


def test_edges_equal_brute_force(spark):
    assert run(spark, EDGES) == Counter(brute(EDGES))
    assert run(spark, []) == Counter()


@pytest.mark.parametrize("seed", [1, 2, 4])
def test_near_copies_equal_brute_force(spark, seed, monkeypatch):
    if seed == 2:  # cells of a few rows, many blocks
        monkeypatch.setattr(op, "CELL", 3)
        monkeypatch.setattr(op, "plan", lambda total: (5, 3))
    if seed != 1:  # nearly all partitions count as large
        monkeypatch.setattr(op, "SMALL", 2)
    rows = near_copies(seed)
    assert run(spark, rows) == Counter(brute(rows))


@pytest.mark.parametrize("small", [16, 1000])
def test_the_tree_lists_every_link_of_small_partitions(spark, monkeypatch, small):
    """Links, not only components: all pairs of different sets that reach the index, each once, without the star."""
    monkeypatch.setattr(op, "SMALL", small)
    rows = near_copies(5, groups=5, copies=12, words=200) + EDGES
    df = spark.createDataFrame(rows, "doc_id long, text string")
    links, _ = op.class_links(df)
    got = [tuple(r) for r in links.collect()]
    by_class = {}
    for r in op._members(df.withColumn("doc_id", F.monotonically_increasing_id()), "doc_id", "text", op.SIZE).join(
            df.withColumn("_id", F.monotonically_increasing_id()).select("_id", "text"), "_id").collect():
        by_class.setdefault(shingles(r.text), r._class)
    sets = [s for s in by_class if s]
    want = {tuple(sorted((by_class[a], by_class[b]))) for i, a in enumerate(sets) for b in sets[:i] if 100 * len(a & b) >= 85 * len(a | b)}
    assert len(got) == len(set(got)) and set(got) == want and len(want) > 100


def test_documents_equal_brute_force(spark):
    rows = [tuple(r) for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text").collect()]
    want = brute(rows)
    assert len({c for *_, c in want}) < len(rows)
    assert run(spark, rows) == Counter(want)


def test_one_of_each_component_stays(spark):
    rows = near_copies(3, groups=3) + EDGES
    df = spark.createDataFrame([(d, t, "m") for d, t in rows], "doc_id long, text string, _row string")
    kept = op.keep_one_of_each(df)
    assert kept.columns == df.columns
    got = Counter((r.doc_id, r.text) for r in kept.collect())
    best = {}
    for (d, t), (_, n, c) in zip(rows, brute(rows), strict=True):
        if n and d == c:
            best.setdefault((c, t if c is None else None), (d, t))
    want = Counter(best.values()) + Counter(r for r, (_, n, _) in zip(rows, brute(rows), strict=True) if not n)
    assert {k[0] for k in got} == {k[0] for k in want} and sum(got.values()) == sum(want.values())


def test_tree_finds_all_pairs_whose_bound_holds():
    rng = np.random.default_rng(0)
    base = rng.poisson(4, (20, GROUPS))
    vectors = (base[rng.integers(0, 20, 700)] + rng.poisson(0.2, (700, GROUPS))).astype(np.int32)
    sizes = vectors.sum(1).astype(np.int64)
    q, t = CountTree(vectors, sizes).search(vectors[:90], sizes[:90], 85)
    bound = np.minimum(vectors[:90, None], vectors[None]).sum(2)
    fits = (100 * sizes[None] >= 85 * sizes[:90, None]) & (85 * sizes[None] <= 100 * sizes[:90, None])
    want = np.argwhere((bound >= needed(sizes[:90, None], sizes[None], 85)) & fits)
    assert set(zip(q.tolist(), t.tolist(), strict=True)) == set(map(tuple, want.tolist()))


def test_components_of_chains_and_rings(spark):
    links = [(i, i + 1) for i in range(40)] + [(100, 103), (103, 101), (101, 100), (7, 7), (200, 201), (200, 201)]
    got = {r.node: r.root for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(41)}, 100: 100, 101: 100, 103: 100, 200: 200, 201: 200}
