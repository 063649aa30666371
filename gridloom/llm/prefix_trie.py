"""Operator 11: the prefix trie of conversations, rolled up by centroid decomposition.

Conversations are rebuilt so that neighbours may share their opening turns, and
every distinct sequence of first turns is a node.  A node's identity is a chain
of digests over its turns; a conversation's chain is computed in blocks of turns
and the blocks' totals are chained in turn, so that a conversation of any length
is spread over tasks.  Counts of a node come from one aggregate over the turns;
leaves and saved words of its subtree from the centroid decomposition of the
parent links (``centroid.py``).

Digests are SHA-256 cut to 128 bits, of role and text with the role's length in
front.  The ids of the conversations that end at a node are put into sorted
pieces over range partitions first, and hashed piece by piece.

Defined results: a null role or text is empty; a null turn comes first, and turns
of equal number are ordered by their digest; a repeated row is a turn of its own;
rows without a conversation id belong to none and are left out; texts are hashed
and counted whole; an empty table has no nodes.  Only the four columns are read,
under names of their own, so further columns clash with nothing.
"""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import centroid
from .centroid import subtree_sums
from .components import stored
from .mixing import word_count
from .ordered import deal, position, spans, with_spans

GROUP, HEAD = 20, 4
#: Turns that are chained in one go, and ids in one piece of an end list.
BLOCK, PIECE = 1 << 10, 1 << 12
ROOT = bytes(16)
SALTS = 32


def _digest(value: Column) -> Column:
    return F.unhex(F.substring(F.sha2(value, 256), 1, 32))


def turns(talks: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """``_conv``, ``_turn``, ``_item`` (digest of role and text) and ``_words`` of every turn that has a conversation."""
    said, who = F.coalesce(F.col(text).cast("string"), F.lit("")), F.coalesce(F.col(role).cast("string"), F.lit(""))
    item = _digest(F.concat(F.octet_length(who).cast("string"), F.lit(":"), who, said))
    return talks.where(F.col(conv).isNotNull()).select(F.col(conv).cast("long").alias("_conv"), F.col(turn).alias("_turn"), item.alias("_item"), word_count(said).alias("_words"))


def rebuilt(rows: DataFrame, group: int = GROUP, head: int = HEAD) -> tuple[DataFrame, DataFrame]:
    """Lengths (``_conv``, ``_length``) of all rebuilt conversations, and their turns (``_conv``, ``_depth`` from 1, ``_item``, ``_words``).

    A conversation c takes the first crc32(c) % ``head`` turns from c - c % ``group`` and goes on with its own after as many.
    """
    dealt = deal(rows, ["_conv", F.col("_turn").asc_nulls_first(), "_item"], "turns").drop("_turn")
    found = stored(spans(dealt, ["_conv"]), "spans")
    sizes = found.where(F.col("_rows") == 0).select("_conv", F.col("_total").alias("_own"))  # its first partition
    taken = (F.crc32(F.col("_conv").cast("string")) % head).cast("int")
    sizes = sizes.withColumns({"_taken": taken, "_base": F.col("_conv") - F.col("_conv") % group})
    # at most group * (head - 1) rows for one base
    bases = sizes.where(F.col("_conv") == F.col("_base")).select("_base", F.least(F.col("_own"), F.lit(head)).alias("_has"))
    lead = F.least(F.col("_taken").cast("long"), F.coalesce("_has", F.lit(0)))
    sizes = stored(sizes.join(bases, "_base", "left").withColumn("_lead", lead).select(
        "_conv", "_base", "_taken", "_lead", (F.col("_lead") + F.greatest(F.lit(0), F.col("_own") - F.col("_taken"))).alias("_length")), "lengths")
    found = found.join(sizes.drop("_length", "_base"), "_conv")
    at = position()
    own = with_spans(dealt, found, ["_conv"]).where(at >= F.col("_taken"))
    own = own.select("_conv", (F.col("_lead") + at - F.col("_taken") + 1).alias("_depth"), "_item", "_words")
    firsts = with_spans(dealt, found.where((F.col("_rows") < head) & (F.col("_conv") % group == 0)), ["_conv"]).where(at < head - 1)
    firsts = firsts.select(F.col("_conv").alias("_base"), (at + 1).alias("_depth"), "_item", "_words")
    shared = sizes.where(F.col("_lead") > 0).select("_conv", "_base", "_lead").join(firsts, "_base").where(F.col("_depth") <= F.col("_lead"))
    return sizes.select("_conv", "_length"), own.unionByName(shared.select("_conv", "_depth", "_item", "_words"))


def _chain(key: str, group: list[str], kept: list[str]):
    """Task function: over rows sorted within ``group``, the chained digest up to each (``_key``) and before it (``_parent``)."""
    def work(batches):
        last, state = None, ROOT
        for batch in batches:
            before, after = [], []
            for *of, item in zip(*[batch.column(c).to_pylist() for c in group], batch.column(key).to_pylist()):
                if of != last:
                    last, state = of, ROOT
                before.append(state)
                state = hashlib.sha256(state + item).digest()[:16]
                after.append(state)
            yield pa.RecordBatch.from_arrays([batch.column(c) for c in kept] + [pa.array(after, pa.binary()), pa.array(before, pa.binary())], [*kept, "_key", "_parent"])
    return work


def prefix_keys(steps: DataFrame, block: int = BLOCK) -> DataFrame:
    """``steps`` (``_conv``, ``_depth`` from 1, ``_item``, ``_words``) with the keys of the prefix up to each turn and of the one before it."""
    kept = ["_conv", "_depth", "_words"]
    cut = steps.withColumn("_block", F.floor((F.col("_depth") - 1) / block))
    dealt = cut.repartition("_conv", "_block").sortWithinPartitions("_conv", "_block", "_depth")
    lines = stored(dealt.mapInArrow(_chain("_item", ["_conv", "_block"], kept), "_conv long, _depth long, _words long, _key binary, _parent binary"), "lines")
    if (lines.agg(F.max("_depth")).first()[0] or 0) <= block:
        return lines
    number = F.floor((F.col("_depth") - 1) / block)
    totals = lines.where(F.col("_depth") % block == 0).select("_conv", (number + 1).alias("_block"), F.col("_key").alias("_item"))
    # one row for a block of turns
    states = totals.repartition("_conv").sortWithinPartitions("_conv", "_block").mapInArrow(_chain("_item", ["_conv"], ["_conv", "_block"]), "_conv long, _block long, _key binary, _parent binary")
    states = states.select("_conv", "_block", F.col("_key").alias("_state"))
    lines = lines.withColumn("_block", number).join(states, ["_conv", "_block"], "left")
    joined = lambda c: F.when(F.col("_state").isNull(), F.col(c)).otherwise(_digest(F.concat("_state", c)))
    before = F.when((F.col("_parent") == F.lit(ROOT)) & F.col("_state").isNotNull(), F.col("_last")).otherwise(joined("_parent"))
    # the prefix before a block's first turn is the one up to the last turn of the block before
    lines = lines.withColumn("_key", joined("_key"))
    last = lines.where(F.col("_depth") % block == 0).select("_conv", (F.col("_block") + 1).alias("_block"), F.col("_key").alias("_last"))
    return stored(lines.join(last, ["_conv", "_block"], "left").select(*kept, "_key", before.alias("_parent")), "lines")


def _pieces(batches):
    """Per key and run of sorted ids: the first id, and the ids joined by commas."""
    key, held = None, []
    for batch in batches:
        out = []
        for k, c in zip(batch.column("_key").to_pylist(), batch.column("_conv").to_pylist()):
            if held and (k != key or len(held) == PIECE):
                out.append((key, held[0], ",".join(map(str, held))))
                held = []
            key = k
            held.append(c)
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), (pa.binary(), pa.int64(), pa.string()))], ["_key", "_first", "_ids"])
    if held:
        yield pa.RecordBatch.from_arrays([pa.array([key], pa.binary()), pa.array([held[0]], pa.int64()), pa.array([",".join(map(str, held))])], ["_key", "_first", "_ids"])


def _hash_pieces(batches):
    key, state = None, None
    for batch in batches:
        out = []
        for k, ids in zip(batch.column("_key").to_pylist(), batch.column("_ids").to_pylist()):
            if k != key:
                if state:
                    out.append((key, state.hexdigest()))
                key, state = k, hashlib.sha256(ids.encode())
            else:
                state.update(b"," + ids.encode())
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), (pa.binary(), pa.string()))], ["_key", "_ends"])
    if state:
        yield pa.RecordBatch.from_arrays([pa.array([key], pa.binary()), pa.array([state.hexdigest()])], ["_key", "_ends"])


def end_hashes(ends: DataFrame) -> DataFrame:
    """Per ``_key``, the SHA-256 of its ``_conv`` ids, ascending and joined by commas."""
    pieces = ends.repartitionByRange("_key", "_conv").sortWithinPartitions("_key", "_conv").mapInArrow(_pieces, "_key binary, _first long, _ids string")
    return pieces.repartition("_key").sortWithinPartitions("_key", "_first").mapInArrow(_hash_pieces, "_key binary, _ends string")


def trie(talks: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text", group: int = GROUP, head: int = HEAD, limit: int = centroid.LIMIT, block: int = BLOCK) -> DataFrame:
    """One row per node: ``conv_id`` (smallest member), ``depth``, ``parent_conv_id``, ``n_convs``, ``n_children``, ``n_leaves``, ``saved_tokens``, ``ends_sha256``."""
    lengths, steps = rebuilt(turns(talks, conv, turn, role, text), group, head)
    lines = prefix_keys(steps, block)
    counted = [F.min("_conv").alias("_conv"), F.count(F.lit(1)).alias("_convs"), F.first("_words").alias("_words"), F.sum(F.col("_length") - F.col("_depth") + 1).alias("_load")]
    root = lengths.select("_conv", F.lit(0).cast("long").alias("_depth"), F.lit(0).cast("long").alias("_words"), F.lit(ROOT).alias("_key"), F.lit(None).cast("binary").alias("_parent"), "_length")
    every = lines.join(lengths, "_conv").unionByName(root)
    nodes = every.groupBy("_key", "_depth").agg(F.first("_parent").alias("_parent"), *counted)
    kids = nodes.groupBy(F.col("_parent").alias("_key")).agg(F.count(F.lit(1)).alias("_kids"))
    nodes = nodes.join(kids, "_key", "left").withColumns({"_kids": F.coalesce("_kids", F.lit(0).cast("long")), "_saved": (F.col("_convs") - 1) * F.col("_words")}).drop("_words")
    nodes = stored(nodes.withColumn("_leaf", (F.col("_kids") == 0).cast("long")), "nodes")
    if nodes.isEmpty():
        rolled = nodes.withColumns({"_sum_leaf": F.col("_leaf"), "_sum_saved": F.col("_saved")})
    else:
        rolled = subtree_sums(nodes, lines, ["_leaf", "_saved"], limit)

    # a parent may have any number of children: it is looked up once for each of a few salts
    salt = F.pmod(F.xxhash64("_key"), F.lit(SALTS))
    asked = nodes.select("_parent", salt.alias("_salt")).where(F.col("_parent").isNotNull()).distinct()
    over = asked.join(nodes.select(F.col("_key").alias("_parent"), F.col("_conv").alias("_over")), "_parent")
    ends = lengths.join(lines.select("_conv", F.col("_depth").alias("_length"), "_key"), ["_conv", "_length"], "left").select(F.coalesce("_key", F.lit(ROOT)).alias("_key"), "_conv")
    rolled = rolled.withColumn("_salt", salt).join(over, ["_parent", "_salt"], "left").join(end_hashes(ends), "_key", "left")
    return rolled.select(
        F.col("_conv").alias("conv_id"), F.col("_depth").alias("depth"), F.col("_over").alias("parent_conv_id"), F.col("_convs").alias("n_convs"), F.col("_kids").alias("n_children"),
        F.col("_sum_leaf").alias("n_leaves"), F.col("_sum_saved").alias("saved_tokens"), F.coalesce("_ends", F.sha2(F.lit(""), 256)).alias("ends_sha256"))
