"""Operator 9: toxicity by averaged subword embeddings and a linear softmax.

A word is the bag of its character n-grams (with its borders), hashed into
``BUCKETS`` embeddings; a window of ``WINDOW`` words is the average of its words,
and a linear softmax over the average gives its two class probabilities.
Embeddings and softmax are trained jointly in numpy, so a misspelling or a new
ending shares the vectors of the n-grams it keeps.  A document is as toxic as its
most toxic window: training starts with the document's label on all windows and
then keeps, for toxic documents, the windows that the last round found most
toxic.  A logistic fit of the labels on that maximum gives the score.

The model is fitted by one task on at most ``PER_CLASS`` documents of each label;
every document is scored over its whole text.

Defined results: a null text or one without letters or digits scores 0; without
labelled documents of both classes the score is the share of label 1 (0 without
labels); repeated rows score alike; of several texts under one id the first by code
point is learned from; a very long text is scored whole by one task, half a megabyte
of it at a time; other columns ride along in a struct, so they
clash with nothing; an empty table gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .labelled import fold, sample
from .text import LOWER, blank_cuts, buffers, mix, slices, split_words, word_hashes

BUCKETS, DIM = 1 << 17, 6
GRAMS = (3, 4, 5)
WINDOW = 8
PER_CLASS = 2000
#: Bytes of text whose n-grams are held at a time.
GRAM_SLICE = 1 << 19
ROUNDS, EPOCHS, STEPS, BATCH, RATE = 3, 2, 300, 1024, 0.05  # a round has EPOCHS epochs and STEPS steps at least
THRESHOLD = 0.7
#: Letters, digits and bytes of longer code points stay; A-Z in lower case; everything else ends a word.
INSIDE = np.full(256, 32, np.uint8)
INSIDE[128:] = np.arange(128, 256)
for _lo, _hi in ((48, 58), (65, 91), (97, 123)):
    INSIDE[_lo:_hi] = LOWER[_lo:_hi]


def clean_words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """A slice's texts with a blank on either side of each and INSIDE applied, its words, and the first word of each row."""
    n = len(offsets) - 1
    padded = np.full(len(data) + n + 1, 32, np.uint8)
    rows = np.repeat(np.arange(n), np.diff(offsets))
    padded[np.arange(len(data)) + rows + 1] = INSIDE[data]
    return padded, *split_words(padded, np.append(offsets[:-1] + np.arange(n), len(padded)))


def grams(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Bucket and word of every n-gram of a slice, the first word of each row, and the hash of each word."""
    padded, starts, ends, first = clean_words(data, offsets)
    lengths = ends - starts
    buckets, words = [], []
    for size in GRAMS:
        # n-grams of a word with one blank before and behind it
        count = np.maximum(lengths + 2 - size + 1, 0)
        word = np.repeat(np.arange(len(starts), dtype=np.int32), count)
        at = np.arange(len(word)) - np.repeat(np.cumsum(count) - count, count) + starts[word] - 1
        code = np.full(len(at), size, np.uint64)
        for i in range(size):
            code = (code << np.uint64(8)) | padded[at + i]
        buckets.append((mix(code) & np.uint64(BUCKETS - 1)).astype(np.int32))
        words.append(word)
    return np.concatenate(buckets), np.concatenate(words), first, word_hashes(padded, starts, ends)


def vocabulary(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The words of many texts, slice by slice: each word's distinct number and hash, the first word of each row, and the n-grams of
    the distinct words with the first n-gram of each."""
    names, first, known = [np.zeros(0, np.uint64)], [np.zeros(1, np.int64)], np.zeros(0, np.uint64)
    keys, buckets, sizes = [np.zeros(0, np.uint64)], [np.zeros(0, np.int32)], [np.zeros(0, np.int64)]
    for lo, hi in slices(offsets, GRAM_SLICE):
        padded, starts, ends, own = clean_words(data[offsets[lo]:offsets[hi]], offsets[lo:hi + 1] - offsets[lo])
        hashes = word_hashes(padded, starts, ends)
        names.append(hashes)
        first.append(own[1:] + first[-1][-1])
        unique, at = np.unique(hashes, return_index=True)
        at = at[~np.isin(unique, known)]
        known = np.union1d(known, unique)
        length = ends[at] - starts[at]
        spelled = padded[np.arange(length.sum()) + np.repeat(starts[at] - np.cumsum(length) + length, length)]
        found, word, _, _ = grams(spelled, np.concatenate([[0], np.cumsum(length)]))
        keys.append(hashes[at])
        buckets.append(found[np.argsort(word, kind="stable")])
        sizes.append(np.bincount(word, minlength=len(at)))
    keys, sizes, names = np.concatenate(keys), np.concatenate(sizes), np.concatenate(names)
    order = np.argsort(keys)
    return order[np.searchsorted(keys[order], names)], names, np.concatenate(first), np.concatenate(buckets), np.concatenate([[0], np.cumsum(sizes)])


def fresh(names: np.ndarray, first: np.ndarray) -> np.ndarray:
    """1 for each word that the WINDOW - 1 words before it in its text don't hold, else 0: a window counts a word once."""
    out = np.ones(len(names), np.float32)
    place = np.arange(len(names)) - np.repeat(first[:-1], np.diff(first))
    for back in range(1, WINDOW):
        out[back:][(names[back:] == names[:-back]) & (place[back:] >= back)] = 0
    return out


def window_starts(first: np.ndarray, step: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First and last-but-one word and the row of each window; a shorter text is one window."""
    words = np.diff(first)
    count = np.where(words > 0, np.maximum(-(-(words - WINDOW) // step), 0) + 1, 0)
    rows = np.repeat(np.arange(len(words)), count)
    at = first[rows] + np.minimum((np.arange(len(rows)) - np.repeat(np.cumsum(count) - count, count)) * step, np.maximum(words[rows] - WINDOW, 0))
    return at, np.minimum(at + WINDOW, first[rows + 1]), rows


def _word_means(values: np.ndarray, words: np.ndarray, n: int) -> np.ndarray:
    counts = np.maximum(np.bincount(words, minlength=n), 1)
    return np.bincount(words, values, n) / counts


def _best_window(weights: np.ndarray, data: np.ndarray, offsets: np.ndarray, limit: int | None = None) -> np.ndarray:
    """The largest window mean of each row; NaN without words.

    A text over ``limit`` bytes, which is a slice of its own, goes by in pieces.  A
    piece begins with words of the one before: a window's words look back as far as
    the window is long, so windows that begin among the first of them are the other
    piece's.
    """
    limit = limit or GRAM_SLICE
    if len(offsets) == 2 and len(data) > limit:
        best, begin = np.nan, 0
        for lo, hi in blank_cuts(data, limit):
            part = data[begin:hi]
            means, at, _, _ = _window_means(weights, part, np.array([0, len(part)]))
            starts = clean_words(part, np.array([0, len(part)]))[1]
            means = means[at >= (WINDOW - 1 if begin else 0)]
            if len(means) and (len(starts) >= WINDOW or hi == len(data)):  # fewer words are a window only if there are no more
                best = np.fmax(best, means.max())
            if len(starts) >= 2 * (WINDOW - 1):
                begin += int(starts[-2 * (WINDOW - 1)]) - 1
        return np.array([best])
    means, _, rows, filled = _window_means(weights, data, offsets)
    best = np.full(len(offsets) - 1, np.nan)
    if len(means):
        best[filled] = np.maximum.reduceat(means, np.searchsorted(rows, filled))
    return best


def _window_means(weights: np.ndarray, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Mean, first word and row of every window of a slice, and the rows that have words."""
    buckets, words, first, names = grams(data, offsets)
    sums = np.concatenate([[0.0], np.cumsum(_word_means(weights[buckets], words, len(names)) * fresh(names, first))])
    lo, hi, rows = window_starts(first, 1)
    return (sums[hi] - sums[lo]) / np.maximum(hi - lo, 1), lo, rows, np.flatnonzero(np.diff(first))


def _logistic(x, y, rounds=60):
    """Slope and offset of the labels on one value, by Newton steps with a small ridge."""
    scale = max(float(np.std(x)), 1e-6)
    design, w = np.stack([x / scale, np.ones(len(x))], 1), np.zeros(2)
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(design @ w, -30, 30)))
        h = design.T @ (design * (p * (1 - p))[:, None]) + 1e-2 * np.eye(2)
        w -= np.linalg.solve(h, design.T @ (p - y) + 1e-2 * w)
    return w[0] / scale, w[1]


def fit(texts: pa.Array, labels: np.ndarray, seed: int = 7) -> tuple[np.ndarray, float, float]:
    """Weight of each bucket (embedding times the difference of the softmax's rows), and slope and offset of the score."""
    rng = np.random.default_rng(seed)
    data, offsets = buffers(texts)
    ids, names, first, gram_of, gram_at = vocabulary(data, offsets)
    size, new = np.diff(gram_at), fresh(names, first)
    lo, hi, rows = window_starts(first, WINDOW)
    embed = rng.normal(0, 0.1, (BUCKETS, DIM)).astype(np.float32)
    soft = rng.normal(0, 0.1, (DIM + 1, 2)).astype(np.float32)
    state = [np.full_like(embed, 1e-6), np.full_like(soft, 1e-6)]
    target = labels[rows]
    use = np.arange(len(rows))

    def word_vectors(which):
        """Average embedding of distinct words, with their n-grams and shares."""
        length = size[which]
        g = gram_of[np.arange(length.sum()) + np.repeat(gram_at[which] - np.cumsum(length) + length, length)]
        owner = np.repeat(np.arange(len(which)), length)
        share = (1 / np.maximum(length, 1)).astype(np.float32)[owner]
        return np.add.reduceat(embed[g] * share[:, None], np.cumsum(length) - length), g, owner, share

    for round_ in range(ROUNDS):
        pos, neg = use[target[use] == 1], use[target[use] == 0]
        for _ in range(max(EPOCHS, -(-STEPS * BATCH // (2 * len(neg))))):
            take = rng.permutation(np.concatenate([rng.choice(pos, min(len(neg), 2 * len(pos) + 20000)), neg]))
            for at in range(0, len(take), BATCH):
                win = take[at:at + BATCH]
                length = hi[win] - lo[win]
                inside = np.arange(length.sum()) + np.repeat(lo[win] - np.cumsum(length) + length, length)
                once = new[inside][:, None]
                of = np.repeat(np.arange(len(win)), length)
                which, local = np.unique(ids[inside], return_inverse=True)
                vectors, g, owner, share = word_vectors(which)
                mean = np.add.reduceat(vectors[local] * once, np.cumsum(length) - length) / length[:, None]
                full = np.concatenate([mean, np.ones((len(win), 1))], 1)
                logits = full @ soft
                prob = np.exp(logits - logits.max(1, keepdims=True))
                prob /= prob.sum(1, keepdims=True)
                prob[np.arange(len(win)), target[win]] -= 1
                slope = prob @ soft[:DIM].T / length[:, None]
                reach = slope[of] * once
                back = np.stack([np.bincount(local, reach[:, d], len(which)) for d in range(DIM)], 1)
                touched, place = np.unique(g, return_inverse=True)
                pull = np.stack([np.bincount(place, back[owner, d] * share, len(touched)) for d in range(DIM)], 1)
                for param, rows_, grad, kept in ((embed, touched, pull, state[0]), (soft, slice(None), full.T @ prob, state[1])):
                    kept[rows_] += grad * grad
                    param[rows_] -= RATE * grad / np.sqrt(kept[rows_])
        weights = embed @ (soft[:DIM, 1] - soft[:DIM, 0])
        sums = np.concatenate([[0.0], np.cumsum(_word_means(weights[gram_of], np.repeat(np.arange(len(size)), size), len(size))[ids] * new)])
        value = (sums[hi] - sums[lo]) / (hi - lo)
        # of a toxic document, the windows near its most toxic one; of others, all
        best = np.full(len(labels), -np.inf)
        np.maximum.at(best, rows, value)
        use = np.flatnonzero((target == 0) | (value >= np.maximum(best[rows] * 0.6, best[rows] - 4)))
    top = np.concatenate([_best_window(weights, data[offsets[a]:offsets[b]], offsets[a:b + 1] - offsets[a]) for a, b in slices(offsets, GRAM_SLICE)])
    known = ~np.isnan(top)
    slope, offset = _logistic(top[known], labels[known])
    return weights.astype(np.float32), float(slope), float(offset)


def _fitter(seed):
    def train(table):
        labels = table["label"].to_numpy().astype(np.int64)
        order = np.lexsort((table["text"].to_numpy(), labels))  # the same model however the rows come
        if not 0 < labels.sum() < len(labels):
            weights, slope, offset = np.zeros(0, np.float32), 0.0, float(labels.mean())
        else:
            weights, slope, offset = fit(table["text"].combine_chunks().take(pa.array(order)), labels[order], seed)
        return pa.table({"weights": pa.array([weights.tobytes()], pa.binary()), "slope": [slope], "offset": [offset]})
    return train


def train(docs: DataFrame, labels: DataFrame, label: str = "toxic", folds: int = 3, held_out: int = 1, per_class: int = PER_CLASS, id: str = "doc_id", text: str = "text", seed: int = 7) -> tuple[np.ndarray, float, float]:
    """The model, fitted in one task on a bounded sample of the folds that are not held out."""
    rows = sample(docs, labels, label, fold(id, folds) != held_out, per_class, id, text)
    model = rows.withColumn("_all", F.lit(0)).groupBy("_all").applyInArrow(_fitter(seed), "weights binary, slope double, offset double").collect()  # one row of fixed size
    return (np.frombuffer(model[0].weights, np.float32), model[0].slope, model[0].offset) if model else (np.zeros(0, np.float32), 0.0, 0.0)


def scored(docs: DataFrame, model: tuple[np.ndarray, float, float], keep: list[str], text: str = "text") -> DataFrame:
    """Per document: ``row`` (a struct of the columns ``keep``) and ``score``."""
    shipped = docs.sparkSession.sparkContext.broadcast(model)  # BUCKETS floats

    def score(batches):
        weights, slope, offset = shipped.value
        for batch in batches:
            data, offsets = buffers(batch.column(1))
            out = [np.zeros(0)]
            for lo, hi in slices(offsets, GRAM_SLICE):
                if len(weights):
                    best = _best_window(weights, data[offsets[lo]:offsets[hi]], offsets[lo:hi + 1] - offsets[lo])
                    out.append(np.where(np.isnan(best), 0.0, 1 / (1 + np.exp(-np.clip(slope * np.nan_to_num(best) + offset, -30, 30)))))
                else:
                    out.append(np.full(hi - lo, offset))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(np.concatenate(out))], ["row", "score"])

    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in keep]).alias("row"), F.col(text).cast("string").alias("_text"))
    return rows.mapInArrow(score, T.StructType([rows.schema["row"], T.StructField("score", T.DoubleType())]))


def toxicity(docs: DataFrame, labels: DataFrame, folds: int = 3, held_out: int = 1, id: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """Per document: id, ``held_out``, ``score`` and ``predicted``."""
    model = train(docs, labels, folds=folds, held_out=held_out, id=id, text=text, **options)
    found = scored(docs, model, [id], text).select(F.col(f"row.`{id}`"), "score")
    return found.select(id, (fold(id, folds) == held_out).alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))


def drop_toxic(docs: DataFrame, labels: DataFrame, text: str = "text", **options) -> DataFrame:
    """The documents that score below the threshold, with all their columns."""
    names = docs.columns
    kept = scored(docs, train(docs, labels, text=text, **options), names, text).where(F.col("score") < THRESHOLD)
    return kept.select([F.col(f"row.`{c}`").alias(c) for c in names])
