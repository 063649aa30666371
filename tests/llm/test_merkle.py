import hashlib
import random
import zlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from gridloom.llm import merkle as op

SCHEMA = "doc_id long, source string, lang string, n_chars long, text string, leaf string, _pos int, _n int"
LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def h(text):
    return hashlib.sha256(text.encode()).hexdigest()


def leaf(row):
    return h("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in row))


def climb(nodes):
    """Root of ``nodes`` and, for each, the (left, right) siblings up to it."""
    paths, where = [[] for _ in nodes], list(range(len(nodes)))
    while len(nodes) > 1:
        for i, at in enumerate(where):
            lo = at // 16 * 16
            paths[i].append(("".join(nodes[lo:at]), "".join(nodes[at + 1:lo + 16])))
        nodes, where = [h("".join(nodes[lo:lo + 16])) for lo in range(0, len(nodes), 16)], [at // 16 for at in where]
    return nodes[0] if nodes else None, paths


def brute(rows):
    by = defaultdict(list)
    for r in rows:
        by[r[1]].append((r[0] is not None, r[0] or 0, leaf(r), r))
    names = sorted(by, key=lambda s: (s is not None, (s or "").encode()))
    own = {s: climb([x[2] for x in sorted(by[s], key=lambda x: x[:3])]) for s in names}
    root, tops = climb([own[s][0] for s in names])
    out = Counter()
    for s, top in zip(names, tops):
        for (_, _, digest, r), path in zip(sorted(by[s], key=lambda x: x[:3]), own[s][1]):
            steps, acc = path + top, digest
            if r[0] is not None and zlib.crc32(str(r[0]).encode()) % 5 == 0:
                acc = leaf((*r[:4], None if r[4] is None else r[4].translate(LOWER)))
            for left, right in steps:
                acc = h(left + acc + right)
            out[r[0], r[1], digest, own[s][0], root, h("".join(a + b for a, b in steps)), acc, acc == root] += 1
    return out


def run(spark, rows):
    df = spark.createDataFrame([(*r, "x", 1, 2) for r in rows], SCHEMA)
    return Counter(map(tuple, op.manifest(df, tampered=F.crc32(F.col("doc_id").cast("string")) % 5 == 0).collect()))


@pytest.mark.parametrize("sizes", [[1], [2], [16], [17], [1, 1, 1], [600, 1, 15, 33, 257], [3] * 40])
def test_manifest_equals_brute_force(spread, sizes):
    rng = random.Random(len(sizes))
    rows = [(rng.randrange(10**6), f"s{k}", rng.choice(["en", None]), i, f"Text {i} ÄB") for k, n in enumerate(sizes) for i in range(n)]
    rng.shuffle(rows)
    assert run(spread, rows) == brute(rows)


def test_nulls_ties_repeats_long_and_empty(spread):
    rows = [(None, None, None, None, None)] * 20 + [(5, None, "en", 1, "A"), (5, None, "en", 1, "B"), (5, None, "en", 1, "B"), (7, "", "", 0, ""), (8, "é", "de", -4, "W " * 200_000), (9, "z", None, None, None)]
    got = run(spread, rows)
    assert got == brute(rows)
    assert run(spread, []) == Counter()


def test_tampering_is_found_and_only_there(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = [tuple(r) for r in docs.select("doc_id", "source", "lang", "n_chars", "text").collect()]
    got = op.manifest(docs, tampered=F.crc32(F.col("doc_id").cast("string")) % 5 == 0).collect()
    assert Counter(map(tuple, got)) == brute(rows)
    assert {r.verified for r in op.manifest(docs).collect()} == {True}


def test_levels_use_lag_and_lead_within_a_run(spark):
    nodes = spark.createDataFrame([(i, bytes([i]), 20) for i in range(20)], "_pos long, _digest binary, _n long")
    got = {r._pos: (bytes(r._left), bytes(r._right)) for r in op.with_siblings(nodes, []).collect()}
    assert got[0] == (b"", bytes(range(1, 16))) and got[15] == (bytes(range(15)), b"") and got[17] == (bytes([16]), bytes([18, 19]))
