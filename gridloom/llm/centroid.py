"""Subtree sums over a forest of any depth by centroid decomposition.

A component is a connected piece of the tree; its load is the summed weight of
its nodes.  Its centroid is the lowest node with at least half of the load below
it.  Cutting there leaves the centroid's child subtrees and the part above, each
with at most half the load; what the centroid's subtree adds up to goes to every
node on the path from the centroid to the component's top, and so does the load
that leaves with it.  The pieces are cut in the same way, so that every node has
met each of its descendants after as many rounds as the load has bits, however
deep the tree is.

Components above ``LIMIT`` are cut by Spark, all of them once per round; smaller
ones are finished in tasks, many at a time, by the same steps on arrays.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .components import stored

LIMIT = 1 << 11
#: Rows that a finishing task works on at a time, and turns of one conversation under one join key.
TASK_ROWS, BLOCK = 1 << 16, 1 << 10


def _tops(up: np.ndarray) -> np.ndarray:
    """The end of every node's chain of ``up`` links, by pointer doubling."""
    while True:
        further = up[up]
        if np.array_equal(further, up):
            return up
        up = further


def centroid_sums(parent: np.ndarray, load: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Subtree sums of the rows of ``values``; ``parent`` is -1 at a top, ``load`` a subtree's weight within its component."""
    n = len(parent)
    up, load, sums, is_open = np.where(parent < 0, np.arange(n), parent), load.copy(), np.zeros_like(values), np.ones(n, bool)
    top = _tops(up)
    while is_open.any():
        rows = np.flatnonzero(is_open)
        heavy = rows[2 * load[rows] >= load[top[rows]]]  # a path from each top, loads falling
        heavy = heavy[np.lexsort((load[heavy], top[heavy]))]
        cut = heavy[np.concatenate([[True], top[heavy][1:] != top[heavy][:-1]])]
        is_cut = np.zeros(n, bool)
        is_cut[cut] = True
        walk = up[cut]
        kids = rows[is_cut[up[rows]] & ~is_cut[rows]]
        owner = up[kids]
        up[kids], up[cut] = kids, cut
        top = _tops(up)
        total = np.zeros_like(values)
        np.add.at(total, top[rows], values[rows])
        np.add.at(total, owner, total[kids])
        sums[cut] += total[cut]
        add, less = total[cut], load[cut]
        while True:  # one step of all paths; each is in a component of its own
            more = walk != cut
            cut, walk, add, less = cut[more], walk[more], add[more], less[more]
            if not len(walk):
                break
            sums[walk] += add
            load[walk] -= less
            cut, walk = walk, up[walk]
        is_open &= ~is_cut
    return sums


def _finish(names: list[str], values: list[str]):
    """Task function: the sums of whole components, which arrive one after the other."""
    def solve(table: pa.Table) -> pa.RecordBatch:
        get = lambda c: np.array([k or b"" for k in table[c].to_pylist()], "S16")
        key, comp, load = get("_key"), get("_comp"), table["_load"].to_numpy()
        own = np.stack([table[v].to_numpy() for v in values], 1).astype(np.int64)
        done = table["_done"].to_numpy(zero_copy_only=False)
        order = np.argsort(key)
        above = get("_parent")
        at = order[np.minimum(np.searchsorted(key[order], above), len(key) - 1)]
        tied = (key[at] == above) & (comp[at] == comp) & ~done & ~done[at] & (table["_depth"].to_numpy() > 0)
        sums = np.stack([table[f"_sum{v}"].to_numpy() for v in values], 1).astype(np.int64)
        left = np.flatnonzero(~done)
        if len(left):
            place = np.cumsum(~done) - 1
            sums[left] += centroid_sums(np.where(tied, place[at], -1)[left], load[left], own[left])
        columns = [table[c].combine_chunks() for c in names] + [pa.array(sums[:, i]) for i in range(len(values))]
        return pa.RecordBatch.from_arrays(columns, names + [f"_sum{v}" for v in values])

    def work(batches):
        held, rows = [], 0
        for batch in batches:
            if not batch.num_rows:
                continue
            held.append(batch)
            rows += batch.num_rows
            if rows >= TASK_ROWS:
                table = pa.Table.from_batches(held)
                comp = table["_comp"].to_pylist()
                cut = len(comp)
                while cut and comp[cut - 1] == comp[-1]:
                    cut -= 1
                if cut:
                    yield solve(table.slice(0, cut))
                held, rows = table.slice(cut).to_batches(), len(comp) - cut
        if rows:
            yield solve(pa.Table.from_batches(held))
    return work


def _cut(nodes: DataFrame, lines: DataFrame, big: DataFrame, values: list[str]) -> DataFrame:
    """One round over the components of ``big`` (``_comp``, ``_whole`` load): their nodes after the cut, with the load ``_left`` of their new component above ``_comp``'s top."""
    rows = nodes.join(big, "_comp")
    lowest = F.min_by(F.struct("_key", "_conv", "_depth", "_load"), "_load").alias("c")
    cuts = rows.where(2 * F.col("_load") >= F.col("_whole")).groupBy("_comp").agg(lowest, F.first("_whole").alias("_whole"))
    cuts = stored(cuts.select("_comp", "_whole", *[F.col(f"c.{c}").alias(f"_cut{c}") for c in ("_key", "_conv", "_depth", "_load")]), "cuts")
    rows = nodes.join(cuts, "_comp").withColumn("_block", F.floor(F.col("_depth") / BLOCK))

    # the child of the centroid above each lower node, asked once for a conversation's block of turns
    asked = rows.where(F.col("_depth") > F.col("_cut_depth")).select("_comp", "_conv", "_block", (F.col("_cut_depth") + 1).alias("_at"), "_cut_key").distinct()
    steps = lines.select(F.col("_conv").alias("_of"), F.col("_depth").alias("_at"), F.col("_key").alias("_low"), F.col("_parent").alias("_over"))
    low = asked.join(steps, (F.col("_conv") == F.col("_of")) & (asked._at == steps._at) & (F.col("_cut_key") == F.col("_over")))
    low = low.select("_comp", "_conv", "_block", "_low")
    # the path from each centroid to its top
    spread = cuts.select("_comp", "_cut_conv", "_cut_depth", F.explode(F.sequence(F.lit(0), F.floor(F.col("_cut_depth") / BLOCK).cast("int"))).alias("_block"))
    on_path = lines.withColumn("_block", F.floor(F.col("_depth") / BLOCK)).join(spread.withColumnRenamed("_cut_conv", "_conv"), ["_conv", "_block"])
    on_path = on_path.where(F.col("_depth") < F.col("_cut_depth")).select("_comp", "_key", F.lit(True).alias("_path"))

    rows = rows.join(low, ["_comp", "_conv", "_block"], "left").join(on_path, ["_comp", "_key"], "left")
    is_cut = F.col("_key") == F.col("_cut_key")
    rows = rows.withColumn("_low", F.when(F.col("_depth") > F.col("_cut_depth"), F.col("_low")))
    rows = rows.withColumn("_path", ~is_cut & ((F.col("_depth") == 0) | F.coalesce("_path", F.lit(False)))).drop("_block")
    rows = stored(rows, "parts")
    below = rows.where(is_cut | F.col("_low").isNotNull()).groupBy("_comp").agg(*[F.sum(v).alias(f"_below{v}") for v in values])
    gets = is_cut | F.col("_path")
    return rows.join(below, "_comp").select(
        "_key", "_parent", "_conv", "_depth", *[c for c in nodes.columns if c not in ("_key", "_parent", "_conv", "_depth", "_comp", "_load", "_done", *[f"_sum{v}" for v in values])],
        F.when(is_cut, F.col("_key")).otherwise(F.coalesce("_low", "_comp")).alias("_comp"),
        F.when(F.col("_path"), F.col("_load") - F.col("_cut_load")).otherwise(F.col("_load")).alias("_load"),
        is_cut.alias("_done"), *[(F.col(f"_sum{v}") + F.when(gets, F.col(f"_below{v}")).otherwise(0)).alias(f"_sum{v}") for v in values])


def subtree_sums(nodes: DataFrame, lines: DataFrame, values: list[str], limit: int = LIMIT) -> DataFrame:
    """``nodes`` with ``_sumX``, the sum of column X over each node's subtree, for every X of ``values``.

    ``nodes`` has ``_key`` and ``_parent`` (16 bytes), ``_conv`` (a conversation that
    passes through it), ``_depth``, ``_load`` (the summed positive weights of its
    subtree) and whatever else is to come along; the tops have depth 0.  ``lines`` says
    what node (``_key``, ``_parent``) a conversation ``_conv`` passes at each ``_depth``
    above 0, so that any node's ancestor at any depth is one lookup.
    """
    kept = nodes.columns
    nodes = nodes.withColumns({"_comp": F.col("_key"), "_done": F.lit(False), **{f"_sum{v}": F.lit(0).cast("long") for v in values}})
    roots = nodes.where(F.col("_depth") == 0).select("_comp", F.col("_load").alias("_whole"))
    if roots.count() != 1:
        raise ValueError("the nodes must have one root")
    nodes = nodes.withColumn("_comp", F.lit(bytes(roots.first()._comp)))
    finished, big = [], stored(roots.where(F.col("_whole") > limit), "big")
    while not big.isEmpty():
        nodes = stored(_cut(nodes, lines, big, values), "cut")
        # a component's load is that of its top; parts above a centroid keep their top, lower ones begin at its children
        tops = nodes.where((F.col("_key") == F.col("_comp")) & ~F.col("_done") & (F.col("_load") > limit))
        big = stored(tops.select("_comp", F.col("_load").alias("_whole")), "big")
        held = nodes.join(big.select("_comp", F.lit(True).alias("_big")), "_comp", "left")
        finished.append(held.where(F.col("_big").isNull()).drop("_big"))
        nodes = held.where(F.col("_big").isNotNull()).drop("_big")
    rest = nodes if not finished else finished[0]
    for part in finished[1:]:
        rest = rest.unionByName(part)
    schema = nodes.select(*kept, *[f"_sum{v}" for v in values]).schema
    return rest.repartition("_comp").sortWithinPartitions("_comp").mapInArrow(_finish(kept, values), schema)
