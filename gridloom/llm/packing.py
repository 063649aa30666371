"""Operator 5: packing into optimal length buckets.

The global histogram of lengths goes through a dynamic programme that picks the
bucket boundaries with the least padding for a given number of buckets; inside a
bucket, batches hold as many documents as the token budget allows at the bucket's
length.

The histogram is what reaches the driver: lengths up to ``EXACT`` keep their own
entry, longer ones are rounded up to as many significant bits, so it has a bounded
number of entries whatever the corpus, and the programme is exact on them.
Documents are numbered inside a bucket by slots of a hash of their id, with the
slots' offsets, so no bucket meets in one task and no text is shuffled.

Defined results: a null or blank text has length 0 and goes to the first bucket;
repeated rows are packed each; rows with equal ids and lengths are
interchangeable; a document longer than the budget is a batch of its own; only id
and text are read, under names of their own, so further columns clash with nothing;
an empty table gives an empty result.
"""

from __future__ import annotations

from collections import deque

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .components import stored
from .text import buffers, slices, split_words

BUCKETS, BUDGET = 16, 65_536
EXACT = 1 << 14
SLOT_ROWS = 50_000


def word_counts(docs: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """id and ``n_tokens``, the words of every whole text."""
    def work(batches):
        for batch in batches:
            data, offsets = buffers(batch.column(1))
            n = [np.diff(split_words(data[offsets[lo]:offsets[hi]], offsets[lo:hi + 1] - offsets[lo])[2]) for lo, hi in slices(offsets)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(np.concatenate([np.zeros(0, np.int64), *n]), pa.int64())], ["_id", "n_tokens"])

    rows = docs.select(F.col(id).alias("_id"), F.col(text).cast("string").alias("_text"))
    return rows.mapInArrow(work, T.StructType([rows.schema["_id"], T.StructField("n_tokens", T.LongType())])).withColumnRenamed("_id", id)


def rounded(length: Column) -> Column:
    """Lengths over EXACT rounded up to its number of significant bits."""
    step = F.pow(F.lit(2.0), F.greatest(F.lit(0), F.ceil(F.log2(length.cast("double") / EXACT)))).cast("long")
    return F.when(length <= EXACT, length).otherwise(F.ceil(length / step).cast("long") * step)


def choose_boundaries(histogram: list[tuple[int, int]], buckets: int) -> list[int]:
    """The ascending boundaries, at most ``buckets``, that give the histogram (length, count) the least padding.

    The padding of lengths i+1..j in one bucket is length_j * (C_j - C_i) - (S_j - S_i)
    with cumulative counts C and sums S, so for each j the best i is the lowest of a
    set of lines at length_j, which a hull of lines finds in one sweep.
    """
    histogram = sorted(histogram)
    length = [x for x, _ in histogram]
    m = len(length)
    if not m:
        return []
    count, total = [0], [0]
    for x, n in histogram:
        count.append(count[-1] + n)
        total.append(total[-1] + x * n)
    best = [0] + [length[j - 1] * count[j] - total[j] for j in range(1, m + 1)]
    back = [[0] * (m + 1)]
    for _ in range(min(buckets, m) - 1):
        hull: deque[tuple[int, int, int]] = deque()  # slope, height, i
        now, choice = [0] * (m + 1), [0] * (m + 1)
        for j in range(1, m + 1):
            i = j - 1
            line = (-count[i], best[i] + total[i], i)
            while len(hull) > 1 and (hull[-1][1] - hull[-2][1]) * (hull[-2][0] - line[0]) >= (line[1] - hull[-2][1]) * (hull[-2][0] - hull[-1][0]):
                hull.pop()
            hull.append(line)
            x = length[j - 1]
            while len(hull) > 1 and hull[1][0] * x + hull[1][1] <= hull[0][0] * x + hull[0][1]:
                hull.popleft()
            now[j] = x * count[j] - total[j] + hull[0][0] * x + hull[0][1]
            choice[j] = hull[0][2]
        best = now
        back.append(choice)
    out, j = [], m
    for choice in reversed(back):
        if j:
            out.append(length[j - 1])
            j = choice[j]
    return out[::-1]


def pack(lengths: DataFrame, id: str = "doc_id", length: str = "n_tokens", buckets: int = BUCKETS, budget: int = BUDGET) -> DataFrame:
    """``lengths`` (id, length) with ``bucket``, ``bucket_length``, ``batch`` (its number in the bucket), ``position`` in the batch and ``padding``."""
    lengths = stored(lengths.select(F.col(id).alias("_id"), F.col(length).cast("long").alias("_n")), "lengths")
    histogram = [(r.n, r.k) for r in lengths.groupBy(rounded(F.col("_n")).alias("n")).agg(F.count(F.lit(1)).alias("k")).collect()]  # bounded, see above
    ends = choose_boundaries(histogram, buckets)
    slots = max(1, -(-sum(k for _, k in histogram) // SLOT_ROWS))
    every = F.array(*[F.lit(e).cast("long") for e in ends] or [F.lit(None).cast("long")])
    rows = lengths.withColumn("bucket_length", F.array_min(F.filter(every, lambda e: e >= F.col("_n")))).withColumn("bucket", (F.array_position(every, F.col("bucket_length")) - 1).cast("int"))
    rows = rows.withColumn("_slot", F.pmod(F.xxhash64("_id", "_n"), F.lit(slots)))
    sizes = rows.groupBy("bucket", "_slot").agg(F.count(F.lit(1)).alias("_rows"))
    before = Window.partitionBy("bucket").orderBy("_slot").rowsBetween(Window.unboundedPreceding, -1)  # a row per slot
    offsets = sizes.select("bucket", "_slot", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_offset"))
    own = Window.partitionBy("bucket", "_slot").orderBy(F.xxhash64("_id"), "_id", "_n")
    rows = rows.withColumn("_rank", F.row_number().over(own) - 1).join(offsets, ["bucket", "_slot"])
    place, per_batch = F.col("_offset") + F.col("_rank"), F.greatest(F.lit(1), F.floor(F.lit(budget) / F.greatest("bucket_length", F.lit(1)))).cast("long")
    return rows.select(F.col("_id").alias(id), F.col("_n").alias(length), "bucket", "bucket_length", F.floor(place / per_batch).cast("long").alias("batch"),
                       (place % per_batch).cast("long").alias("position"), (F.col("bucket_length") - F.col("_n")).alias("padding"))


def pack_documents(docs: DataFrame, id: str = "doc_id", text: str = "text", buckets: int = BUCKETS, budget: int = BUDGET) -> DataFrame:
    """Packing of every document by its number of words."""
    return pack(word_counts(docs, id, text), id, "n_tokens", buckets, budget)
