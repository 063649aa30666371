import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from gridloom.llm import toxicity as op
from gridloom.llm.text import buffers


def test_grams_equal_brute_force():
    texts = ["Ab c", "", "x-1é", " "]
    buckets, words, first, _ = op.grams(*buffers(pa.array(texts)))
    spelled = [b" ab ", b" c ", b" x ", b" 1\xc3\xa9 "]

    def bucket(part):
        code = len(part)
        for b in part:
            code = (code << 8 | b) % 2**64
        return int(op.mix(np.array([code], np.uint64))[0]) % op.BUCKETS

    want = Counter((i, bucket(w[j:j + n])) for i, w in enumerate(spelled) for n in op.GRAMS for j in range(len(w) - n + 1))
    assert Counter(zip(words.tolist(), buckets.tolist(), strict=True)) == want
    assert first.tolist() == [0, 2, 2, 4, 4]


def test_best_window_equals_brute_force():
    rng = np.random.default_rng(1)
    weights = rng.normal(size=op.BUCKETS)
    texts = ["", "one", "a b c d e f g h i j k l", "again again again b again c d e f g h again", " ".join(f"w{i % 13}" for i in range(400))]

    def value(word):
        b, *_ = op.grams(*buffers(pa.array([word])))
        return weights[b].mean()

    def brute(text):
        w = text.split()
        own = [0 if x in w[max(0, i - op.WINDOW + 1):i] else value(x) for i, x in enumerate(w)]
        return max((np.mean(own[i:i + op.WINDOW]) for i in range(max(1, len(w) - op.WINDOW + 1))), default=np.nan) if w else np.nan

    assert np.allclose(op._best_window(weights, *buffers(pa.array(texts))), [brute(t) for t in texts], equal_nan=True)


@pytest.fixture(scope="module")
def mid(spark):
    return [spark.read.parquet(f"/root/testdata/sf0.01/{t}.parquet") for t in ("documents", "labels")]


def test_held_out_accuracy(spark, mid):
    docs, labels = mid
    rows = op.toxicity(docs, labels).join(labels, "doc_id").collect()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in rows)
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.7) for r in rows)
    held = [r for r in rows if r.held_out]
    assert np.mean([r.predicted == r.toxic for r in held]) > 0.9  # 33 toxic documents to learn from


def test_clean_documents_stay_and_columns_too(spark, mid):
    docs, labels = mid
    wide = docs.selectExpr("doc_id", "text", "lang AS score", "source AS row")
    kept = op.drop_toxic(wide, labels)
    assert kept.columns == wide.columns
    ids = {r.doc_id for r in kept.collect()}
    marks = {r.doc_id: r.toxic for r in labels.collect()}
    assert np.mean([d in ids for d, t in marks.items() if not t]) > 0.98 and np.mean([d in ids for d, t in marks.items() if t]) < 0.3


def test_nulls_repeats_and_missing_labels(spark):
    docs = spark.createDataFrame([(1, None), (None, "a b"), (2, ""), (2, ""), (3, "?! ..."), (4, "x " * 20000)], "doc_id long, text string")
    labels = spark.createDataFrame([(1, 1), (2, None), (None, 1), (9, 0)], "doc_id long, toxic int")
    for own in (labels, labels.limit(0)):
        rows = op.toxicity(docs, own).collect()
        assert len(rows) == 6 and all(0 <= r.score <= 1 and r.held_out in (True, False) for r in rows)
    assert op.toxicity(docs.limit(0), labels).collect() == []
    both = spark.createDataFrame([(i, "you idiot " + "word " * 9) if i % 2 else (i, "fine day " + "word " * 9) for i in range(40)] + [(None, None), (41, "")], "doc_id long, text string")
    marks = spark.createDataFrame([(i, i % 2) for i in range(40)], "doc_id long, toxic int")
    found = op.toxicity(both, marks).collect()
    assert all(r.predicted == r.doc_id % 2 for r in found if r.doc_id is not None and r.doc_id < 40)
    assert [r.score for r in found if r.doc_id in (None, 41)] == [0.0, 0.0]


@pytest.mark.parametrize("limit", [40, 90, 400])
def test_pieces_of_a_long_text_have_its_best_window(limit):
    rng = np.random.default_rng(limit)
    weights = rng.normal(size=op.BUCKETS)
    for n in (0, 3, 8, 9, 200):
        for words in (["a", "bb", "ccc", "d-d", "é"], [f"w{i}" for i in range(40)], ["x" * 60, "y"]):
            text = " ".join(rng.choice(words, n))
            data, at = buffers(pa.array([text]))
            got, want = op._best_window(weights, data, at, limit), op._best_window(weights, data, at, 1 << 20)
            assert np.array_equal(np.isnan(got), np.isnan(want)) and np.allclose(got, want, equal_nan=True, atol=1e-9)
