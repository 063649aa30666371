"""Operator 6: language identification by rank-order n-gram profiles.

A profile ranks the most frequent n-grams of one to three characters, words
taken with a blank on either side.  Language profiles rank the counts summed over
every training text of a language; a document's profile ranks its own.  The
out-of-place distance sums, over the document's n-grams, how far each lies from
its rank in the language's profile (``PROFILE`` if it is not there); the nearest
language wins, the first by name of equal ones.

Characters are folded to one case and to an alphabet of ``ALPHABET`` codes:
letters of the scripts keep their own code up to U+07FF, later ones share codes by
hash; everything that is not a letter ends a word.

Defined results: a null text or one without letters (marks alone are none) is
``und`` with score 0; rows with a null language are not learned from; without any
language every text is ``und``; repeated rows count and score each; a very long text
is counted whole by one task, a few megabytes of it at a time; only id, language and
text are read, so further columns clash with nothing; an empty table gives an empty
result.
"""

from __future__ import annotations

import unicodedata

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .labelled import fold
from .text import LOWER, SLICE_BYTES, blank_cuts, buffers, slices

PROFILE = 300
ALPHABET = 1 << 12
UNKNOWN = "und"


def letter_codes() -> np.ndarray:
    """Alphabet code of every code point, 0 for what is no letter."""
    out = np.zeros(0x110000, np.uint16)
    for c in range(0x110000):
        if unicodedata.category(chr(c))[0] in "LM":
            low = ord(chr(c).lower()[0])
            out[c] = low if low < 0x800 else 0x800 + low % 0x800
    return out


def code_points(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Code points of a slice of texts and the row of each."""
    lead = np.flatnonzero((data & 0xC0) != 0x80)
    point = data[lead].astype(np.int64)
    wide = np.flatnonzero(point >= 128)
    if len(wide):
        at, first = lead[wide], point[wide]
        size = 2 + (first >= 0xE0) + (first >= 0xF0)
        own = first & (0x7F >> size)
        for i in range(1, 4):
            more = size > i
            own[more] = (own[more] << 6) | (data[at[more] + i] & 0x3F)
        point[wide] = own
    return point, np.searchsorted(offsets, lead, "right") - 1


def gram_counts(data: np.ndarray, offsets: np.ndarray, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row, n-gram and count of every n-gram of a slice, by row and n-gram."""
    point, row = code_points(data, offsets)
    code = codes[point].astype(np.uint64)
    # words with one blank (0) on either side: drop what is no letter, then put one blank between words
    letter = np.flatnonzero(code)
    if not len(letter):
        none = np.zeros(0, np.int64)
        return none, none, none
    opens = np.ones(len(letter), bool)
    opens[1:] = (letter[1:] != letter[:-1] + 1) | (row[letter][1:] != row[letter][:-1])
    word = np.cumsum(opens)
    text = np.zeros(len(letter) + word[-1] + 1, np.uint64)
    place = np.arange(len(letter)) + word
    text[place] = code[letter]
    rows = np.zeros(len(text), np.int64)
    rows[place] = row[letter]
    rows[place[opens] - 1] = row[letter][opens]  # the blank before a word
    inner = text > 0
    out = [(rows[inner] << 40) | (text[inner].astype(np.int64))]
    two = np.flatnonzero(inner[1:] | inner[:-1])
    pair_row = np.where(inner[two], rows[two], rows[two + 1])
    out.append((pair_row << 40) | (1 << 36) | ((text[two] << np.uint64(12)) | text[two + 1]).astype(np.int64))
    three = np.flatnonzero(inner[1:-1])
    out.append((rows[three + 1] << 40) | (2 << 36) | ((text[three] << np.uint64(24)) | (text[three + 1] << np.uint64(12)) | text[three + 2]).astype(np.int64))
    keys = np.sort(np.concatenate(out))
    new = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
    return keys[new] >> 40, keys[new] & ((1 << 40) - 1), np.diff(np.append(new, len(keys)))


def slice_counts(data: np.ndarray, offsets: np.ndarray, codes: np.ndarray, limit: int | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``gram_counts`` of a slice; the counts of a text over ``limit`` bytes, which is a slice of its own, are added up piece by piece."""
    limit = limit or SLICE_BYTES
    if len(offsets) != 2 or len(data) <= limit:
        return gram_counts(data, offsets, codes)
    grams, counts = np.zeros(0, np.int64), np.zeros(0, np.int64)
    for lo, hi in blank_cuts(data, limit):
        _, own, n = gram_counts(data[lo:hi], np.array([0, hi - lo]), codes)
        grams, back = np.unique(np.concatenate([grams, own]), return_inverse=True)
        counts = np.bincount(back, np.concatenate([counts, n])).astype(np.int64)
    return np.zeros(len(grams), np.int64), grams, counts


def ranked(rows: np.ndarray, counts: np.ndarray, grams: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Order of the entries by row, falling count and n-gram, and each one's rank in its row."""
    order = np.lexsort((grams, -counts, rows))
    at = rows[order]
    start = np.flatnonzero(np.concatenate([[True], at[1:] != at[:-1]])) if len(at) else np.zeros(0, np.int64)
    return order, np.arange(len(at)) - np.repeat(start, np.diff(np.append(start, len(at))))


def _counter(codes):
    def count(batches):
        """Sums of a task's texts by language; the n-grams of an alphabet are bounded, the dictionary of languages is small."""
        sums: dict[str, tuple[np.ndarray, np.ndarray]] = {}
        for batch in batches:
            data, offsets = buffers(batch.column(1))
            langs = np.array(batch.column(0).to_pylist(), object)
            for lo, hi in slices(offsets):
                rows, grams, counts = slice_counts(data[offsets[lo]:offsets[hi]], offsets[lo:hi + 1] - offsets[lo], codes.value)
                for lang in set(langs[lo:hi]):
                    own = langs[lo + rows] == lang
                    old = sums.get(lang, (np.zeros(0, np.int64), np.zeros(0, np.int64)))
                    every, back = np.unique(np.concatenate([old[0], grams[own]]), return_inverse=True)
                    sums[lang] = every, np.bincount(back, np.concatenate([old[1], counts[own]])).astype(np.int64)
        for lang, (grams, counts) in sums.items():
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(grams), pa.string()), pa.array(grams), pa.array(counts)], ["lang", "gram", "n"])
    return count


def language_profiles(docs: DataFrame, codes, lang: str = "lang", text: str = "text", size: int = PROFILE) -> DataFrame:
    """``lang``, ``gram`` and ``rank`` of the ``size`` most frequent n-grams of every language, counted over all given texts."""
    rows = docs.where(F.col(lang).isNotNull()).select(F.col(lang).cast("string").alias("lang"), F.col(text).cast("string").alias("text"))
    counts = rows.mapInArrow(_counter(codes), "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    order = Window.partitionBy("lang").orderBy(F.col("n").desc(), "gram")  # each task sends its best only
    best = counts.withColumn("rank", F.row_number().over(order) - 1).where(F.col("rank") < size)
    return best.select("lang", "gram", "rank")


def distances(data: np.ndarray, offsets: np.ndarray, codes: np.ndarray, grams: np.ndarray, ranks: np.ndarray, size: int = PROFILE) -> tuple[np.ndarray, np.ndarray]:
    """Out-of-place distance of each text to each language, and the n-grams of its profile.

    ``grams`` ascend; ``ranks`` has a row for each language and ``size`` where a profile lacks the n-gram.
    """
    n = len(offsets) - 1
    rows, own, counts = slice_counts(data, offsets, codes)
    order, rank = ranked(rows, counts, own)
    order, rank = order[rank < size], rank[rank < size]
    rows, own = rows[order], own[order]
    at = np.minimum(np.searchsorted(grams, own), max(len(grams) - 1, 0))
    known = grams[at] == own if len(grams) else np.zeros(len(own), bool)
    out = np.zeros((n, len(ranks)))
    for j, theirs in enumerate(ranks):
        place = np.where(known, theirs[at], size) if len(grams) else np.full(len(own), size)
        out[:, j] = np.bincount(rows, np.where(place < size, np.abs(place - rank), size), n)
    return out, np.bincount(rows, minlength=n)


def with_letters(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Whether each text of a slice holds a letter: one of A-Z or a-z, or else the first that is found."""
    plain = (LOWER[data] >= 97) & (LOWER[data] <= 122)
    at = np.flatnonzero(plain) if len(offsets) != 2 else np.array([plain.argmax()] if plain.any() else [], np.int64)
    found = np.diff(np.searchsorted(at, offsets)) > 0
    for r in np.flatnonzero(~found & (np.diff(offsets) > 0)):
        found[r] = any(map(str.isalpha, data[offsets[r]:offsets[r + 1]].tobytes().decode("utf-8", "ignore")))
    return found


def identify(docs: DataFrame, folds: int = 3, held_out: int = 1, id: str = "doc_id", text: str = "text", lang: str = "lang", size: int = PROFILE) -> DataFrame:
    """Per document: id, ``held_out``, ``lang_pred`` and ``score`` (1 - distance / the largest distance possible)."""
    sc = docs.sparkSession.sparkContext
    codes = sc.broadcast(letter_codes())
    profiles = language_profiles(docs.where(fold(id, folds) != held_out), codes, lang, text, size).collect()  # languages x size rows
    names = sorted({r.lang for r in profiles})
    grams = np.unique(np.array([r.gram for r in profiles], np.int64))
    ranks = np.full((len(names), len(grams)), size)
    for r in profiles:
        ranks[names.index(r.lang), np.searchsorted(grams, r.gram)] = r.rank
    model = sc.broadcast((names, grams, ranks))

    def predict(batches):
        names, grams, ranks = model.value
        for batch in batches:
            data, offsets = buffers(batch.column(1))
            langs, scores = [], [np.zeros(0)]
            for lo, hi in slices(offsets):
                part, own = data[offsets[lo]:offsets[hi]], offsets[lo:hi + 1] - offsets[lo]
                far, filled = distances(part, own, codes.value, grams, ranks, size)
                filled = np.where(with_letters(part, own), filled, 0)
                if not names:
                    langs += [UNKNOWN] * (hi - lo)
                    scores.append(np.zeros(hi - lo))
                    continue
                best = far.argmin(1)
                langs += [names[b] if m else UNKNOWN for b, m in zip(best.tolist(), filled.tolist(), strict=True)]
                scores.append(np.where(filled > 0, 1 - far[np.arange(hi - lo), best] / np.maximum(filled * size, 1), 0.0))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(langs, pa.string()), pa.array(np.concatenate(scores))], ["_id", "lang_pred", "score"])

    rows = docs.select(F.col(id).alias("_id"), F.col(text).cast("string").alias("_text"))
    found = rows.mapInArrow(predict, T.StructType([rows.schema["_id"], *T._parse_datatype_string("lang_pred string, score double").fields]))
    return found.select(F.col("_id").alias(id), (fold("_id", folds) == held_out).alias("held_out"), "lang_pred", "score")
