"""Operator 1: removal of word passages that occur more than once in the corpus.

Every window of ``window`` consecutive words is hashed (Rabin-Karp) and counted
over all documents; each word covered by a window whose word sequence starts
anywhere else is removed, and overlapping windows merge into maximal intervals.

Two passes over the text, dealt into blocks: the first counts the blocks' packed
hashes by range of the hash space, the second applies the answers (one bit per
hash).  Windows are told apart by 96 bits of two polynomials over keyed hashes
of the words (``text.word_values``): 10^13 windows have a chance of about 10^-3
that any two different ones are taken for the same; nothing else is approximate.

Defined results: a null or blank text has no words and keeps the empty text; a
text shorter than a window keeps all its words; repeated rows are documents of
their own, so their windows repeat each other; a null id is kept as it is; a very
long text is one row of one block, its windows hashed in chunks; other columns ride
along in a struct, so they clash with nothing; an empty table gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .hash_blocks import ascending, pack_wide, plan, range_edges, unpack_wide
from .text import buffers, join_words, slices, split_words, text_bytes, wide, window_values, word_values

WINDOW = 35


def _block_hashes(data, offsets, window):
    """Window hashes of a block (two parts) with the first word of each; words are numbered through the block."""
    high, low, at, words = [np.zeros(0, np.uint64)], [np.zeros(0, np.uint32)], [np.zeros(0, np.int64)], 0
    for lo, hi in slices(offsets):
        part, own = data[offsets[lo]:offsets[hi]], offsets[lo:hi + 1] - offsets[lo]
        starts, ends, first = split_words(part, own)
        values, a, _ = window_values(word_values(part, starts, ends), first, window)
        for parts, h in zip((high, low), wide(values), strict=True):
            parts.append(h)
        at.append(a + words)
        words += len(starts)
    return np.concatenate(high), np.concatenate(low), np.concatenate(at), words


def _sender(window, bits):
    def send(key, table):
        data, offsets = buffers(table["_text"])
        high, low, _, _ = _block_hashes(data, offsets, window)
        order, new = ascending(high, low)
        high, low = high[order[new]], low[order[new]]
        edges = range_edges(high, bits)
        filled = np.flatnonzero(np.diff(edges))
        return pa.table({"_range": pa.array(filled, pa.int32()), "_block": pa.array(np.full(len(filled), key[0].as_py()), pa.int32()),
                         "_packed": pa.array([pack_wide(high[edges[r]:edges[r + 1]], low[edges[r]:edges[r + 1]]) for r in filled], pa.binary())})
    return send


def _answer(table):
    """For each block of a hash range: one bit per hash, set if another block sent the same hash."""
    lists = [unpack_wide(x.as_py()) for x in table["_packed"]]
    order, new = ascending(*(np.concatenate(part) for part in zip(*lists, strict=True)))
    again = ~new
    again[:-1] |= ~new[1:]
    hit = np.zeros(len(order), bool)
    hit[order] = again
    cuts = np.cumsum([0, *(len(high) for high, _ in lists)])
    bits = [np.packbits(hit[a:b]).tobytes() for a, b in zip(cuts[:-1], cuts[1:], strict=True)]
    return pa.table({"_block": table["_block"], "_range": table["_range"], "_bits": pa.array(bits, pa.binary())})


def _spans(gone, first):
    """Maximal removed intervals of each row, as a list column."""
    edge = np.zeros(len(gone), bool)
    edge[first[:-1][np.diff(first) > 0]] = True  # no interval crosses into another row
    opens = np.flatnonzero(gone & (edge | ~np.concatenate([[False], gone[:-1]])))
    closes = np.flatnonzero(gone & np.concatenate([edge[1:] | ~gone[1:], [True]])) + 1 if len(gone) else opens
    base = first[np.searchsorted(first, opens, "right") - 1]
    pairs = pa.StructArray.from_arrays([pa.array(opens - base, pa.int32()), pa.array(closes - base, pa.int32())], ["start", "end"])
    return pa.ListArray.from_arrays(pa.array(np.searchsorted(opens, first), pa.int32()), pairs)


def _without(data, offsets, starts, ends, first, gone):
    """Per row, the text without its removed intervals; everything else stays byte for byte."""
    edge = np.zeros(len(data) + 1, np.int32)
    edge[starts[gone]] += 1
    edge[ends[gone]] -= 1
    follows = np.flatnonzero(gone[1:] & gone[:-1]) + 1
    follows = follows[~np.isin(follows, first)]  # blanks between two removed words of a row go too
    edge[ends[follows - 1]] += 1
    edge[starts[follows]] -= 1
    stays = np.cumsum(edge[:-1]) == 0
    at = np.concatenate([[0], np.cumsum(stays)])[offsets]
    return pa.LargeStringArray.from_buffers(len(offsets) - 1, pa.py_buffer(at.astype(np.int64)), pa.py_buffer(data[stays])).cast(pa.string())


def _cutter(window, bits, joined):
    def cut(texts, answers):
        data, offsets = buffers(texts["_text"])
        high, low, at, n_words = _block_hashes(data, offsets, window)
        order, new = ascending(high, low)
        repeated = np.diff(np.flatnonzero(np.append(new, True))) > 1
        edges = range_edges(high[order[new]], bits)
        for r, packed in zip(answers["_range"].to_pylist(), answers["_bits"].to_pylist(), strict=True):
            lo, hi = edges[r], edges[r + 1]
            repeated[lo:hi] |= np.unpackbits(np.frombuffer(packed, np.uint8), count=hi - lo).astype(bool)
        hit = at[order[repeated[np.cumsum(new) - 1]]]
        depth = np.zeros(n_words + 1, np.int32)
        depth[hit] += 1  # the hits are distinct words, and so are their windows' ends
        depth[hit + window] -= 1
        removed = np.cumsum(depth[:-1]) > 0
        out, words = [], 0
        for lo, hi in slices(offsets):
            part, part_at = data[offsets[lo]:offsets[hi]], offsets[lo:hi + 1] - offsets[lo]
            starts, ends, first = split_words(part, part_at)
            gone = removed[words:words + len(starts)]
            words += len(starts)
            n_removed = np.diff(np.concatenate([[0], np.cumsum(gone)])[first])
            out.append(pa.table({"row": texts["_row"].slice(lo, hi - lo), "n_words": pa.array(np.diff(first), pa.int64()), "n_removed": pa.array(n_removed, pa.int64()),
                                 "spans": _spans(gone, first), "kept_text": join_words(part, part_at, starts, ends, first, ~gone) if joined else _without(part, part_at, starts, ends, first, gone)}))
        return pa.concat_tables(out)
    return cut


def cut_repeated(docs: DataFrame, text: str = "text", n_chars: str = "n_chars", window: int = WINDOW) -> DataFrame:
    """``docs`` with their columns, the text without its repeated passages and ``n_chars``, if there, counted anew."""
    kept = remove_repeated(docs, text, window, joined=False)
    out = {c: F.col("kept_text") if c == text else F.col(f"row.`{c}`") for c in docs.columns}
    if n_chars in out:
        out[n_chars] = F.char_length("kept_text").cast(docs.schema[n_chars].dataType)
    return kept.select([v.alias(c) for c, v in out.items()])


def remove_repeated(docs: DataFrame, text: str = "text", window: int = WINDOW, joined: bool = True) -> DataFrame:
    """``docs`` without repeated passages.

    Returns one row per document: ``row`` (a struct of all columns but the
    text), ``n_words``, ``n_removed``, ``spans`` (removed word intervals,
    half-open, maximal) and ``kept_text`` (kept words joined by one space, or, if
    not ``joined``, the text as it was around the removed intervals).
    """
    others = [F.col(f"`{c}`") for c in docs.columns if c != text] or [F.lit(None).cast("int").alias("none")]
    blocks, bits = plan(text_bytes(docs, text))
    plain = [F.col(f"`{f.name}`") for f in docs.schema.fields if f.name != text and not isinstance(f.dataType, (T.ArrayType, T.MapType, T.StructType, T.VariantType))]
    dealt = docs.select(F.pmod(F.xxhash64(*plain, text), F.lit(blocks)).cast("int").alias("_block"), F.struct(*others).alias("_row"), F.col(text).cast("string").alias("_text"))
    sent = dealt.groupBy("_block").applyInArrow(_sender(window, bits), "_range int, _block int, _packed binary")
    answers = sent.groupBy("_range").applyInArrow(_answer, "_block int, _range int, _bits binary")
    schema = T.StructType([T.StructField("row", dealt.schema["_row"].dataType), *T._parse_datatype_string("n_words long, n_removed long, spans array<struct<start:int,end:int>>, kept_text string").fields])
    return dealt.groupBy("_block").cogroup(answers.groupBy("_block")).applyInArrow(_cutter(window, bits, joined), schema)
