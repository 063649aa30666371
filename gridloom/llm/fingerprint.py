"""Operator 4: document fingerprints by a homomorphic multiset hash.

A text is a multiset of paragraphs: its lines, long ones cut after every word
whose hash is 0 modulo ``CUT``, so that an edit leaves the pieces around it as
they are.  Every piece is hashed to a wide vector; the fingerprint is the sum of
the vectors: the number of pieces, ``UNIFORM`` random lanes and ``SIGNS`` lanes of
+1 or -1, all modulo 2**32.  The random lanes have 128 bits, from the 122 bits of
two polynomials over keyed hashes of the words.  The fingerprint does not depend
on the order, equal multisets have equal fingerprints, different ones differ but
for a chance of about 2**-122, and ``insert`` and ``delete`` update it without the
text.

The mean square of the sign lanes estimates the sum of the squared multiplicities
of a multiset, and that of a difference by how much two multisets differ; the
likeness is 1 - the latter / the sum of the former, within 0..1.  For sets it
estimates 2 |A and B| / (|A| + |B|).

Defined results: a null or blank text is the empty multiset, likeness 1 to another
such; rows are ordered by falling id, nulls last, equal ids by text; a single row
is its own neighbour; a very long text is hashed whole by one task; only id and
text are read, under names of their own, so further columns clash with nothing; an
empty table gives an empty result.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .hash_blocks import plan
from .text import buffers, mix, run_values, slices, split_words, text_bytes, word_values

CUT = 8
UNIFORM, SIGNS = 4, 128
#: Text of a range of ids: it grows with the root of the corpus between these bounds.
PART_BYTES = (2 << 20, 64 << 20)
WIDTH = 1 + UNIFORM + SIGNS  # 32-bit lanes; the first one holds the count


def pieces(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The two values of each piece of a slice of texts, and the first piece of each row (one more entry than rows)."""
    starts, ends, first = split_words(data, offsets)
    n = len(starts)
    if not n:
        return np.zeros((2, 0), np.uint64), np.zeros(len(offsets), np.int64)
    words = word_values(data, starts, ends)
    lines = np.concatenate([[0], np.cumsum((data == 10) | (data == 13))])
    opens = np.zeros(n, bool)
    opens[first[:-1][np.diff(first) > 0]] = True
    opens[1:] |= (lines[starts[1:]] > lines[ends[:-1]]) | (words[0, :-1] % np.uint64(CUT) == 0)
    at = np.flatnonzero(opens)
    return run_values(words, at, np.append(at[1:], n)), np.searchsorted(at, first)


def vectors(values: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Sum of the pieces' vectors of each row, as ``WIDTH`` lanes modulo 2**32."""
    n = len(first) - 1
    out = np.zeros((n, WIDTH), np.uint32)
    filled = np.flatnonzero(np.diff(first))
    if not len(filled):
        return out
    own = [mix(v) for v in values]  # half of the random lanes comes from each value
    lanes = np.stack(own, 1).view(np.uint32)
    seeds = np.arange(1, SIGNS // 64 + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    bits = np.unpackbits(mix((own[0] ^ mix(own[1]))[:, None] ^ seeds).view(np.uint8), axis=1)
    at, count = first[filled], np.diff(first)[filled]
    out[filled, 0] = count.astype(np.uint32)
    out[filled, 1:1 + UNIFORM] = np.add.reduceat(lanes, at, axis=0, dtype=np.uint64).astype(np.uint32)
    out[filled, 1 + UNIFORM:] = (2 * np.add.reduceat(bits, at, axis=0, dtype=np.int64) - count[:, None]).astype(np.uint32)
    return out


def of_texts(texts: pa.Array) -> np.ndarray:
    """Fingerprint vectors of a string column."""
    data, offsets = buffers(texts)
    parts = [vectors(*pieces(data[offsets[lo]:offsets[hi]], offsets[lo:hi + 1] - offsets[lo])) for lo, hi in slices(offsets)]
    return np.concatenate([np.zeros((0, WIDTH), np.uint32), *parts])


def counts(v: np.ndarray) -> np.ndarray:
    return v[:, 0].astype(np.int64)


def insert(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Fingerprints of the multisets with those of ``b`` added."""
    return a + b


def delete(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Fingerprints of the multisets with those of ``b`` taken out."""
    return a - b


def likeness(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    x, y = (np.ascontiguousarray(v[:, 1 + UNIFORM:]).view(np.int32).astype(np.float64) for v in (a, b))
    apart = ((x - y) ** 2).sum(1) / np.maximum((x * x).sum(1) + (y * y).sum(1), 1)
    return np.where((a == b).all(1), 1.0, np.clip(1 - apart, 0, 1))


def spelled(v: np.ndarray) -> pa.Array:
    """Fingerprints as lowercase hex."""
    return pa.array([row.tobytes().hex() for row in v.astype("<u4")], pa.string())


def fingerprints(docs: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """id and ``fingerprint`` of every text."""
    def work(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0), spelled(of_texts(batch.column(1)))], ["_id", "fingerprint"])

    rows = docs.select(F.col(id).alias("_id"), F.col(text).cast("string").alias("_text"))
    return rows.mapInArrow(work, T.StructType([rows.schema["_id"], T.StructField("fingerprint", T.StringType())])).withColumnRenamed("_id", id)


def _router(heads):
    """Adds a row's part.  ``heads`` fall: the first id of each part, which is also sent to the part before as its guest."""
    def route(batches):
        up = -heads.value
        last = len(up) - 1
        for batch in batches:
            ids = batch.column(0).fill_null(0).to_numpy()
            null = batch.column(0).is_null().to_numpy(zero_copy_only=False)
            part = np.where(null, last, np.maximum(np.searchsorted(up, -ids, "right") - 1, 0))
            head = np.flatnonzero(~null & (heads.value[part] == ids) & (last > 0))
            take = np.concatenate([np.arange(len(ids)), head])
            to = np.concatenate([part, (part[head] - 1) % len(up)])
            guest = np.arange(len(take)) >= len(ids)
            yield pa.RecordBatch.from_arrays([pa.array(to, pa.int32()), pa.array(guest), *(c.take(pa.array(take)) for c in batch.columns)], ["_part", "_guest", "_id", "_text"])
    return route


def _pair(table):
    """Fingerprints of a part's texts and of their edited forms; the last row's neighbour is the guest, else the first row."""
    ids, texts, guest = table["_id"].to_pylist(), [t or "" for t in table["_text"].to_pylist()], table["_guest"].to_pylist()
    order = sorted(range(len(ids)), key=lambda i: (guest[i], ids[i] is None, -(ids[i] or 0), texts[i]))
    own = [i for i in order if not guest[i]]
    after = [*order[1:len(own)], order[len(own)] if len(order) > len(own) else order[0]] if own else []
    edited = [texts[i][:len(texts[i]) - len(texts[i]) // 2] + texts[j][:len(texts[i]) // 2] for i, j in zip(own, after, strict=True)]
    every = of_texts(pa.array(texts, pa.large_string()))
    mine, theirs = every[own], of_texts(pa.array(edited, pa.large_string()))
    return pa.table({"_id": table["_id"].combine_chunks().take(pa.array(own, pa.int64())), "n_chars": pa.array([len(texts[i]) for i in own], pa.int64()),
                     "edited_sha256": pa.array([hashlib.sha256(t.encode()).hexdigest() for t in edited], pa.string()), "fingerprint": spelled(mine), "edited_fingerprint": spelled(theirs),
                     "near_edited": likeness(mine, theirs), "near_next": likeness(mine, every[after])})


def edited_fingerprints(docs: DataFrame, id: str = "doc_id", text: str = "text", parts: int | None = None) -> DataFrame:
    """Fingerprints of every text and of the text with its second half replaced by the start of the next document's, by falling id.

    Documents are dealt out by ranges of ids whose ends are ids of the table, so
    the one text a range needs from the next is known beforehand and every text
    is shuffled once.
    """
    rows = docs.select(F.col(id).cast("long").alias("_id"), F.col(text).cast("string").alias("_text"))
    parts = parts or plan(text_bytes(docs, text), PART_BYTES)[0]
    found = rows.agg(F.max("_id"), F.percentile_approx("_id", [i / parts for i in range(1, parts)] or [0.5], max(10_000, 20 * parts))).first()
    ends = {found[0], *(found[1] if parts > 1 and found[1] else [])} - {None}
    heads = np.array(sorted(ends, reverse=True) or [0], np.int64)  # a number for each part
    shipped = docs.sparkSession.sparkContext.broadcast(heads)
    dealt = rows.mapInArrow(_router(shipped), "_part int, _guest boolean, _id long, _text string")
    schema = "_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"
    return dealt.groupBy("_part").applyInArrow(_pair, schema).withColumnRenamed("_id", id)
