import zlib

import numpy as np
import pyarrow as pa

from gridloom.llm import quality as op
from gridloom.llm.text import buffers


def test_features_of_a_text_do_not_depend_on_its_neighbours():
    texts = ["Aa b1, %% HEY hey\nhey", "", "ü ü ü", " \n", "one"]
    together = op.features(*buffers(pa.array(texts)))
    for t, row in zip(texts, together, strict=True):
        assert np.allclose(op.features(*buffers(pa.array([t])))[0], row)
    words = together[0][op.KINDS:]
    #      capitals only, one capital, with other signs
    assert np.allclose(words[3:6] * 6, [1, 1, 2]) and np.isclose(words[9] * 6, 5)
    assert np.isclose(together[2][op.KINDS + 8] * 3, 2) and np.isclose(together[2][op.KINDS + 9] * 3, 1)


def test_prior_of_a_known_mixture():
    rng = np.random.default_rng(0)
    positive = rng.normal(2, 1, 4000)
    for share in (0.2, 0.6, 0.9):
        web = np.where(rng.random(8000) < share, rng.normal(2, 1, 8000), rng.normal(-2, 1, 8000))
        assert abs(op.estimate_prior(positive, web) - share) < 0.06


def test_network_learns_from_positives_and_unlabelled():
    rng = np.random.default_rng(1)
    x_p, truth = rng.normal(1.5, 1, (1500, 3)), rng.random(3000) < 0.7
    x_u = np.where(truth[:, None], rng.normal(1.5, 1, (3000, 3)), rng.normal(-1.5, 1, (3000, 3)))
    model = op.fit(np.concatenate([x_p, x_u]), np.arange(4500) < 1500)
    assert abs(model["prior"] - 0.7) < 0.08
    assert ((op.predict(model, x_u) >= 0.5) == truth).mean() > 0.95


def test_held_out_accuracy(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.01/{t}.parquet") for t in ("documents", "labels"))
    rows = op.quality(docs, labels).join(labels, "doc_id").collect()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in rows)
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in rows)
    held = [r for r in rows if r.held_out]
    good, bad = ([r.score for r in held if r.quality == k] for k in (1, 0))
    assert np.mean([g > b for g in good for b in bad]) > 0.95 and np.mean([r.predicted for r in held if r.quality == 1]) > 0.97


def test_nulls_repeats_and_missing_labels(spark):
    docs = spark.createDataFrame([(1, None, 0.5), (None, "a b", 0.5), (2, "", 0.5), (2, "", 0.5), (4, "x " * 20000, 0.5)], "doc_id long, text string, score double")
    labels = spark.createDataFrame([(1, 1), (2, None), (None, 1), (9, 0)], "doc_id long, quality int")
    for own in (labels, labels.limit(0)):
        rows = op.quality(docs, own).collect()
        assert len(rows) == 5 and all(0 <= r.score <= 1 and r.held_out in (True, False) for r in rows)
    assert op.quality(docs.limit(0), labels).collect() == []
