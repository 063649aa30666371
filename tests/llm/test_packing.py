import itertools
import random
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from gridloom.llm import packing as op


@pytest.fixture(scope="module")
def small(spark):
    return spark.read.parquet("/root/testdata/sf0.001/documents.parquet")


def cost(histogram, ends):
    return sum(n * (min(e for e in ends if e >= x) - x) for x, n in histogram)


@pytest.mark.parametrize("seed", range(30))
def test_boundaries_are_optimal(seed):
    rng = random.Random(seed)
    histogram = [(x, rng.randrange(1, 9)) for x in rng.sample(range(60), rng.randrange(1, 9))]
    buckets = rng.randrange(1, 6)
    got = op.choose_boundaries(histogram, buckets)
    lengths = sorted(x for x, _ in histogram)
    want = min(cost(histogram, (*c, lengths[-1])) for k in range(min(buckets, len(lengths))) for c in itertools.combinations(lengths[:-1], k))
    assert len(got) <= buckets and got == sorted(set(got)) and cost(histogram, got) == want


def test_rounding_is_exact_up_to_the_limit(spark):
    values = [0, 1, op.EXACT, op.EXACT + 1, 40_001, 10**6 + 1, 3 * op.EXACT]
    got = [r[0] for r in spark.createDataFrame([(v,) for v in values], "n long").select(op.rounded(F.col("n"))).collect()]
    want = []
    for v in values:
        step = 1
        while v > op.EXACT * step:
            step *= 2
        want.append(-(-v // step) * step)
    assert got == want


def check(rows, docs, buckets, budget):
    assert Counter((r.doc_id, r.n_tokens) for r in rows) == Counter((d, len((t or "").split())) for d, t in docs)
    histogram = Counter(r.n_tokens for r in rows)
    ends = op.choose_boundaries(list(histogram.items()), buckets)
    batches = defaultdict(list)
    for r in rows:
        assert r.bucket_length == min(e for e in ends if e >= r.n_tokens) == ends[r.bucket] and r.padding == r.bucket_length - r.n_tokens
        batches[r.bucket, r.batch].append(r)
    last = {b: max(n for c, n in batches if c == b) for b, _ in batches}
    for (b, n), own in batches.items():
        full = max(1, budget // max(ends[b], 1))
        assert sorted(r.position for r in own) == list(range(len(own))) and (len(own) == full or n == last[b] and len(own) < full)
    assert all(set(n for c, n in batches if c == b) == set(range(m + 1)) for b, m in last.items())


def test_documents_are_packed_once_in_full_batches(spark, small, monkeypatch):
    monkeypatch.setattr(op, "SLOT_ROWS", 40)
    docs = [tuple(r) for r in small.select("doc_id", "text").collect()]
    check(op.pack_documents(small, budget=4000).collect(), docs, op.BUCKETS, 4000)


def test_nulls_repeats_long_and_empty(spark):
    docs = [(1, None), (2, ""), (None, "a b"), (None, "a b"), (3, "w " * 30000), (4, "a"), (4, "a")]
    df = spark.createDataFrame([(*d, 0) for d in docs], "doc_id long, text string, bucket int")
    check(op.pack_documents(df, buckets=3, budget=5).collect(), docs, 3, 5)
    assert op.pack_documents(df.limit(0)).collect() == []
