"""Operator 8: quality by positive-unlabelled learning.

Trusted positives (label 1) and unlabelled web text train a small network on
shares and counts that describe a text's make-up.  The class prior is estimated
first: for any set of texts, the unlabelled share is at least the prior times the
positives' share, so the smallest ratio over the upper sets of a first scorer
bounds it.  The network then minimises the non-negative unbiased risk
``pi * R_P(+1) + max(0, R_U(-1) - pi * R_P(-1))`` with the logistic loss, whose
minimiser is the probability of label 1.  Negative labels are never used.

The model is fitted by one task on at most ``PER_PART`` positives and twice as
many unlabelled texts; every document is scored over its whole text.

Defined results: a null text counts as empty, and an empty text scores as the
model finds it; without positives the score is 0; repeated rows score alike; of
several texts under one id the first by code point is learned from; a very long text
is scored whole by one task; only ids, labels and text are read, under names of
their own, so further columns clash with nothing; an empty table gives an empty
result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .labelled import fold
from .text import buffers, distinct, slices, split_words, word_hashes

PER_PART = 3000
HIDDEN, STEPS, RATE, DECAY = 8, 300, 0.02, 1e-3
THRESHOLD = 0.3
#: Class of each byte: every ASCII mark by itself, then lower case, upper case, digits, blanks, line ends, controls and longer code points.
MARKS = [b for b in range(33, 127) if not chr(b).isalnum()]
LOWER_CASE, UPPER_CASE, DIGIT, BLANK, LINE, CONTROL, WIDE = range(len(MARKS), len(MARKS) + 7)
KINDS = len(MARKS) + 7
BYTE_KIND = np.full(256, WIDE)
BYTE_KIND[:32] = CONTROL
BYTE_KIND[127] = CONTROL
BYTE_KIND[MARKS] = np.arange(len(MARKS))
for _lo, _hi, _kind in ((97, 123, LOWER_CASE), (65, 91, UPPER_CASE), (48, 58, DIGIT)):
    BYTE_KIND[_lo:_hi] = _kind
BYTE_KIND[[9, 32]] = BLANK
BYTE_KIND[[10, 13]] = LINE


def _shares(part: np.ndarray, whole: np.ndarray) -> np.ndarray:
    return part / np.maximum(whole, 1)


def features(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """One row of features per text."""
    n = len(offsets) - 1
    size = np.diff(offsets)
    rows = np.repeat(np.arange(n), size)
    kinds = np.bincount(rows * KINDS + BYTE_KIND[data], minlength=n * KINDS).reshape(n, KINDS)
    starts, ends, first = split_words(data, offsets)
    words = np.diff(first)
    of = np.repeat(np.arange(n), words)
    length = ends - starts
    upper = np.concatenate([[0], np.cumsum(BYTE_KIND[data] == UPPER_CASE)])
    letters = np.concatenate([[0], np.cumsum(np.isin(BYTE_KIND[data], (LOWER_CASE, UPPER_CASE, WIDE)))])
    capital, lettered = upper[ends] - upper[starts], letters[ends] - letters[starts]
    names = word_hashes(data, starts, ends)
    same = np.zeros(len(names), bool)
    same[1:] = (names[1:] == names[:-1]) & (of[1:] == of[:-1])
    different = np.diff(distinct(names, of, n)[1])

    def count(which):
        return np.bincount(of, which, n)

    per_word = [count(length), count(length * length) ** 0.5, count(lettered == 0), count((capital == lettered) & (lettered > 1)), count((capital == 1) & (lettered > 1)),
                count(lettered < length), count(length > 20), count(length < 3), count(same), different, kinds[:, LINE]]
    logs = [np.log1p(size), np.log1p(words)]
    return np.concatenate([np.sqrt(_shares(kinds, size[:, None])), np.stack([_shares(x, words) for x in per_word], 1), np.stack(logs, 1) / 10], 1)


def column_features(column) -> np.ndarray:
    data, offsets = buffers(column)
    parts = [features(data[offsets[lo]:offsets[hi]], offsets[lo:hi + 1] - offsets[lo]) for lo, hi in slices(offsets)]
    return np.concatenate(parts) if parts else features(data, offsets)


def _sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def forward(x: np.ndarray, net: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    hidden = np.tanh(x @ net[0] + net[1])
    return hidden, hidden @ net[2] + net[3][0]


def _descend(x: np.ndarray, slope, rng) -> list[np.ndarray]:
    """Adam on the whole sample; ``slope`` gives the risk's derivative by the scores."""
    net = [rng.normal(0, x.shape[1] ** -0.5, (x.shape[1], HIDDEN)), np.zeros(HIDDEN), rng.normal(0, HIDDEN ** -0.5, HIDDEN), np.zeros(1)]
    mean, square = [np.zeros_like(p) for p in net], [np.zeros_like(p) for p in net]
    for step in range(1, STEPS + 1):
        hidden, out = forward(x, net)
        g = slope(out)
        back = g[:, None] * net[2] * (1 - hidden * hidden)
        for p, m, s, d in zip(net, mean, square, (x.T @ back, back.sum(0), hidden.T @ g, g.sum(keepdims=True)), strict=True):
            d = d + DECAY * p
            m += 0.1 * (d - m)
            s += 0.01 * (d * d - s)
            p -= RATE * (m / (1 - 0.9 ** step)) / (np.sqrt(s / (1 - 0.99 ** step)) + 1e-8)
    return net


def estimate_prior(positive: np.ndarray, unlabelled: np.ndarray) -> float:
    """The smallest ratio of unlabelled to positive shares above a threshold that keeps at least a tenth of the positives."""
    cuts = np.quantile(positive, np.linspace(0, 0.9, 91))
    ratio = np.array([(unlabelled >= c).mean() for c in cuts]) / np.array([(positive >= c).mean() for c in cuts])
    return float(np.clip(ratio.min(), 0.01, 0.99))


def fit(x: np.ndarray, positive: np.ndarray, seed: int = 3) -> dict:
    """Network, scaling and prior from the features of positives and unlabelled texts."""
    rng = np.random.default_rng(seed)
    middle, spread = x.mean(0), x.std(0) + 1e-3
    x = np.clip((x - middle) / spread, -8, 8)
    n_p, n_u = positive.sum(), (~positive).sum()

    def against(out):
        return np.where(positive, (_sigmoid(out) - 1) / n_p, _sigmoid(out) / n_u)

    # the first scorer tells positives from unlabelled; out-of-sample, so that its upper sets are fair
    half = rng.random(len(x)) < 0.5
    scores = np.zeros(len(x))
    for side in (half, ~half):
        own = positive[side]

        def part(out, own=own):
            return np.where(own, (_sigmoid(out) - 1) / max(own.sum(), 1), _sigmoid(out) / max((~own).sum(), 1))

        scores[~side] = forward(x[~side], _descend(x[side], part, rng))[1]
    prior = estimate_prior(scores[positive], scores[~positive])

    def risk(out):
        p = _sigmoid(out)
        loss = np.logaddexp(0, out)  # of label -1
        negative = loss[~positive].mean() - prior * loss[positive].mean()
        as_positive = np.where(positive, prior * (p - 1) / n_p, 0)
        as_negative = np.where(positive, -prior * p / n_p, p / n_u)
        return as_positive + as_negative if negative >= 0 else -as_negative  # below 0 the risk steps back, as the non-negative estimator asks

    return {"net": _descend(x, risk, rng), "middle": middle, "spread": spread, "prior": prior}


def predict(model: dict, x: np.ndarray) -> np.ndarray:
    return _sigmoid(forward(np.clip((x - model["middle"]) / model["spread"], -8, 8), model["net"])[1])


def _fitter(seed):
    def train(table):
        positive = table["positive"].to_numpy(zero_copy_only=False).astype(bool)
        order = np.lexsort((table["text"].to_numpy(), positive))  # the same model however the rows come
        x, positive = column_features(table["text"].combine_chunks())[order], positive[order]
        if not 0 < positive.sum() < len(positive):
            return pa.table({"model": pa.array([], pa.binary())})
        model = fit(x, positive, seed)
        parts = [*model["net"], model["middle"], model["spread"], np.array([model["prior"]])]
        return pa.table({"model": pa.array([p.astype(np.float64).tobytes() for p in parts], pa.binary())})
    return train


def train(docs: DataFrame, labels: DataFrame, label: str = "quality", folds: int = 5, held_out: int = 0, per_part: int = PER_PART, id: str = "doc_id", text: str = "text", seed: int = 3) -> dict | None:
    """The model, fitted in one task on a bounded sample of the folds that are not held out."""
    known = docs.select(id).distinct().where((fold(id, folds) != held_out) & F.col(id).isNotNull())
    trusted = labels.where(F.col(label) == 1).select(id).distinct().join(known, id).orderBy(F.xxhash64(id), id).limit(per_part)
    web = known.orderBy(F.xxhash64(F.lit(1), id), id).limit(2 * per_part)
    chosen = trusted.withColumn("positive", F.lit(True)).unionByName(web.withColumn("positive", F.lit(False)))
    texts = docs.select(id, F.coalesce(F.col(text).cast("string"), F.lit("")).alias("_text")).join(F.broadcast(chosen), id)  # at most 3 * per_part ids
    rows = texts.groupBy(id, "positive").agg(F.min("_text").alias("text")).select("positive", "text", F.lit(0).alias("_all"))
    parts = [np.frombuffer(r.model) for r in rows.groupBy("_all").applyInArrow(_fitter(seed), "model binary").collect()]  # a network of fixed size
    if not parts:
        return None
    return {"net": [parts[0].reshape(-1, HIDDEN), *parts[1:4]], "middle": parts[4], "spread": parts[5], "prior": float(parts[6][0])}


def quality(docs: DataFrame, labels: DataFrame, folds: int = 5, held_out: int = 0, id: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """Per document: id, ``held_out``, ``score`` (the probability of label 1) and ``predicted``."""
    model = train(docs, labels, folds=folds, held_out=held_out, id=id, text=text, **options)
    shipped = docs.sparkSession.sparkContext.broadcast(model)

    def score(batches):
        for batch in batches:
            x = column_features(batch.column(1))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(predict(shipped.value, x) if shipped.value else np.zeros(len(x)))], ["_id", "score"])

    rows = docs.select(F.col(id).alias("_id"), F.col(text).cast("string").alias("_text"))
    found = rows.mapInArrow(score, T.StructType([rows.schema["_id"], T.StructField("score", T.DoubleType())]))
    return found.select(F.col("_id").alias(id), (fold("_id", folds) == held_out).alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
