"""Operator 10: benchmark items found inside documents by size-partitioned MinHash containment.

Items and documents are sets of five-word shingles (A-Z in lower case).  Items
are partitioned by set size into octaves.  An item's MinHash sketch is its ``k``
smallest shingle hashes, where ``k = u - ceil(t * u) + 1`` for the largest item
``u`` of its partition: a document that holds a share ``t`` of the item misses
fewer than ``k`` of its shingles, so it holds at least one of the sketch and the
search loses nothing.  Pairs found are verified by exact containment, first on
the hashes, then on the words.

The items, not the documents, are shipped to the tasks, in slices of at most
``ITEM_BYTES`` of text each; a larger benchmark takes more slices, one after the
other over the same batch, and no document text is shuffled.

Defined results: a null or blank text on either side matches nothing; an item of
fewer than five words is one shingle and matches documents that are the same
sequence; repeated documents are reported each, repeated items too; null ids
stay null; a very long text is searched whole by one task; other columns ride along
in a struct, so they clash with nothing; empty tables match nothing.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .text import LOWER, buffers, distinct, shingles, slices, split_words, text_bytes

SHINGLE, CONTAINMENT = 5, 0.8
ITEM_BYTES = 4 << 20


def _least(size: int, share: float) -> int:
    """The smallest number of shared shingles that is a share of ``size``."""
    return max(1, math.ceil(share * size - 1e-9))


def _index(ids: list, texts: pa.Array, size: int, share: float) -> dict:
    """Sketches and full sets of a slice of items, both as (hash, item) pairs ascending by hash."""
    data, offsets = buffers(texts)
    hashes, first = distinct(*shingles(LOWER[data], offsets, size), len(ids))
    sizes = np.diff(first)
    octave = np.frexp(sizes)[1]
    largest = np.zeros(octave.max(initial=0) + 1, np.int64)
    np.maximum.at(largest, octave, sizes)
    take = np.array([u - _least(u, share) + 1 for u in largest])[octave]
    rank = np.arange(len(hashes)) - np.repeat(first[:-1], sizes)
    item = np.repeat(np.arange(len(ids)), sizes)
    sketch = rank < np.repeat(take, sizes)  # the hashes of a set ascend

    def table(keep):
        order = np.argsort(hashes[keep], kind="stable")
        return hashes[keep][order], item[keep][order]

    seen = np.zeros(1 << 16, bool)
    seen[(hashes[sketch] >> np.uint64(48)).astype(np.int64)] = True
    return {"ids": ids, "texts": texts.to_pylist(), "sizes": sizes, "need": np.array([_least(n, share) for n in sizes]),
            "sketch": table(sketch), "full": table(np.ones(len(hashes), bool)), "seen": seen}


def _hits(table: tuple[np.ndarray, np.ndarray], hashes: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, item, hash) of every given hash that the table has."""
    lo, hi = np.searchsorted(table[0], hashes, "left"), np.searchsorted(table[0], hashes, "right")
    n = hi - lo
    at = np.repeat(lo - np.cumsum(n) + n, n) + np.arange(n.sum())
    return np.repeat(rows, n), table[1][at], np.repeat(hashes, n)


def _word_shingles(text: bytes, size: int) -> set[bytes]:
    data = LOWER[np.frombuffer(text, np.uint8)]
    starts, ends, _ = split_words(data, np.array([0, len(data)]))
    raw = data.tobytes()
    words = [raw[s:e] for s, e in zip(starts.tolist(), ends.tolist(), strict=True)]
    return {b" ".join(words[i:i + size]) for i in range(max(1, len(words) - size + 1))}


def _matches(index: dict, data: np.ndarray, offsets: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Rows, items and shared shingles of the pairs that hold, by row and item."""
    hashes, rows = shingles(LOWER[data], offsets, size)
    likely = np.flatnonzero(index["seen"][(hashes >> np.uint64(48)).astype(np.int64)])
    row, item, _ = _hits(index["sketch"], hashes[likely], rows[likely])
    n_items = len(index["ids"])
    found = np.unique(row * n_items + item)
    if not len(found):
        return found, found, found
    inside = np.isin(rows, found // n_items)
    own, first = distinct(hashes[inside], rows[inside], len(offsets) - 1)
    row, item, _ = _hits(index["full"], own, np.repeat(np.arange(len(offsets) - 1), np.diff(first)))
    pairs, shared = np.unique(row * n_items + item, return_counts=True)
    good = np.isin(pairs, found) & (shared >= index["need"][pairs % n_items])
    row, item, shared = pairs[good] // n_items, pairs[good] % n_items, shared[good]
    raw, sets = data.tobytes(), {}
    for i, (r, j) in enumerate(zip(row.tolist(), item.tolist(), strict=True)):
        if sets.get("row") != r:
            sets = {"row": r, "own": _word_shingles(raw[offsets[r]:offsets[r + 1]], size)}
        shared[i] = len(sets["own"] & _word_shingles(index["texts"][j].encode(), size))
    good = shared >= index["need"][item]
    return row[good], item[good], shared[good]


def _annotator(index, size, kind, with_text):
    def annotate(batches):
        table = index.value
        for batch in batches:
            data, offsets = buffers(batch.column(1))
            before = batch.column(2).to_pylist()
            for lo, hi in slices(offsets):
                part = _matches(table, data[offsets[lo]:offsets[hi]], offsets[lo:hi + 1] - offsets[lo], size)
                for r, j, n in zip(*(x.tolist() for x in part), strict=True):
                    before[lo + r] = before[lo + r] + [{"item_id": table["ids"][j], "n_item": int(table["sizes"][j]), "n_shared": n}]
            columns = [batch.column(0), *([batch.column(1)] if with_text else []), pa.array(before, kind)]
            yield pa.RecordBatch.from_arrays(columns, ["row", *(["_text"] if with_text else []), "matches"])
    return annotate


def match_items(docs: DataFrame, items: DataFrame, keep: list[str], text: str = "text", item_id: str = "item_id", item_text: str = "text",
                containment: float = CONTAINMENT, size: int = SHINGLE, item_bytes: int = ITEM_BYTES) -> DataFrame:
    """Per document: ``row`` (a struct of the columns ``keep``) and ``matches``, the items it contains.

    A match has ``item_id``, ``n_item`` (shingles of the item) and ``n_shared``.
    """
    spark = docs.sparkSession
    items = items.select(F.col(item_id).cast("long").alias("id"), F.col(item_text).cast("string").alias("text"))
    n_slices = max(1, math.ceil(text_bytes(items) / item_bytes))
    found = T._parse_datatype_string("array<struct<item_id:long,n_item:long,n_shared:long>>")
    kind = pa.list_(pa.struct([(n, pa.int64()) for n in ("item_id", "n_item", "n_shared")]))
    out = docs.select(F.struct(*[F.col(f"`{c}`") for c in keep]).alias("row"), F.col(text).cast("string").alias("_text"), F.array().cast(found).alias("matches"))
    for i in range(n_slices):
        own = items.where(F.pmod(F.xxhash64("id", "text"), F.lit(n_slices)) == i).toArrow()  # about item_bytes
        index = spark.sparkContext.broadcast(_index(own["id"].to_pylist(), own["text"].combine_chunks(), size, containment))
        last = i == n_slices - 1
        fields = [f for f in out.schema.fields if not (last and f.name == "_text")]
        out = out.mapInArrow(_annotator(index, size, kind, not last), T.StructType(fields))
    return out


def contained_items(docs: DataFrame, items: DataFrame, id: str = "doc_id", **options) -> DataFrame:
    """One row per document and item it contains: id, ``item_id``, ``n_item``, ``n_shared``, ``containment``."""
    found = match_items(docs, items, [id], **options).select(F.col(f"row.`{id}`"), F.explode("matches").alias("m"))
    return found.select(id, "m.*", (F.col("m.n_shared") / F.col("m.n_item")).alias("containment"))


def drop_contaminated(docs: DataFrame, items: DataFrame, **options) -> DataFrame:
    """The documents that contain no item, with all their columns."""
    names = [c for c in docs.columns]
    clean = match_items(docs, items, names, **options).where(F.size("matches") == 0)
    return clean.select([F.col(f"row.`{c}`") for c in names])
