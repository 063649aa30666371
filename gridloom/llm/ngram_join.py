"""Operator 7: exact n-gram Jaccard join with a count-vector R-tree.

A document's set holds its distinct ``size``-word shingles (A-Z in lower case).
Documents with equal sets form a class; classes link when the Jaccard index of
their sets reaches ``per_cent`` / 100.

1. Classes: one pass hashes every text; equal sets share a 64-bit class key.
2. Partitions: in an order of shingles by document count, linked classes share a
   shingle among the first ``n - ceil(t * n) + 1`` of each (the prefix), so the
   classes are dealt out by their prefix shingles and nothing is lost.  The
   counts come from packed hash blocks (``hash_blocks``).  Shingles that occur in
   one class alone count for a set's size but are not dealt out, and a class with
   too few others to reach the index with anything is left out.
   Partitions of the same classes are searched once.
3. R-tree: the classes of a partition are indexed by their group counts of
   shingles that other classes have too; the tree prunes by the sum of coordinate
   minima, and all surviving pairs are verified on the texts.  So every link of two
   classes that meet in a partition of up to ``SMALL`` classes is found.
4. Large partitions hold groups of copies that must not be expanded into all their
   pairs.  First every class is compared with the partition's most common member
   (the one whose shingles occur most), which ties a group together in one pass;
   partitions that still hold several components then go through the R-tree for
   pairs of different components, in cells of bounded size that pair up all parts.
5. Components over all links by alternating stars.

Pairs are verified on 64-bit shingle hashes of the whole texts.

Defined results: a null or blank text has the empty set and is linked with
nothing (its component is its own id); with fewer words than ``size`` the whole
sequence is the one shingle; repeated rows belong to one class; a null id takes
the smallest id of its component, null if there is none; a very long text is one row
of one block and verified whole; only id and text are read, under names of their
own, so further columns clash with nothing; empty tables give empty results.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .components import components, stored
from .count_rtree import GROUPS, CountTree, needed, points
from .hash_blocks import pack, plan, range_edges, unpack
from .text import LOWER, buffers, distinct, mix, shingles, slices, text_bytes

SIZE, PER_CENT = 4, 85
#: Classes of a partition whose links are all listed.
SMALL = 16
#: Rows of one cell of a partition; a larger partition is cut into cells that pair up its parts.
CELL = 2048
#: Partition rows that one task of the R-tree step holds, about.
GROUP_ROWS = 20_000


def _sets(column, size):
    """(rows' bytes range, set hashes, set offsets) of a column, slice by slice."""
    data, offsets = buffers(column)
    for lo, hi in slices(offsets):
        part, own = LOWER[data[offsets[lo]:offsets[hi]]], offsets[lo:hi + 1] - offsets[lo]
        hashes, first = distinct(*shingles(part, own, size), hi - lo)
        yield lo, hi, hashes, first


def _classes(column, size):
    """Class key and set size of every row; the key of an empty set is 0."""
    keys, sizes = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    for _, _, hashes, first in _sets(column, size):
        n = np.diff(first)
        sums = np.concatenate([[np.uint64(0)], np.cumsum(mix(hashes ^ np.uint64(0xA5A5A5A5A5A5A5A5)), dtype=np.uint64)])
        key = mix((sums[first[1:]] - sums[first[:-1]]) + n.astype(np.uint64)).view(np.int64)
        keys.append(np.where(n > 0, key, 0))
        sizes.append(n)
    return np.concatenate(keys), np.concatenate(sizes)


def _tagger(size, names):
    """Adds class key and set size behind the columns ``names`` (the text is the last column read)."""
    def tag(batches):
        for batch in batches:
            key, n = _classes(batch.column(batch.num_columns - 1), size)
            yield pa.RecordBatch.from_arrays([*batch.columns[:len(names)], pa.array(key), pa.array(n)], [*names, "_class", "_n"])
    return tag


def _first_texts(size, blocks):
    """The texts of a task's rows, one of each class, dealt into blocks by class."""
    def pick(batches):
        seen: set[int] = set()
        for batch in batches:
            key, n = _classes(batch.column(0), size)
            rows = [i for i, (k, m) in enumerate(zip(key.tolist(), n.tolist(), strict=True)) if m and not (k in seen or seen.add(k))]
            yield pa.RecordBatch.from_arrays([pa.array((key[rows].view(np.uint64) % np.uint64(blocks)).astype(np.int32)), pa.array(key[rows]), batch.column(0).take(pa.array(rows, pa.int64()))],
                                             ["_block", "_class", "_text"])
    return pick


def _one_each(table):
    """The rows of a block, one of each class."""
    _, rows = np.unique(table["_class"].to_numpy(), return_index=True)
    return table.take(pa.array(rows))


def _block_sets(table, size):
    hashes, counts = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)]
    for _, _, h, first in _sets(table["_text"], size):
        hashes.append(h)
        counts.append(np.diff(first))
    counts = np.concatenate(counts)
    return np.concatenate(hashes), np.concatenate([[0], np.cumsum(counts)])


def _sender(size, bits):
    def send(key, table):
        hashes, _ = _block_sets(_one_each(table), size)
        own, counts = np.unique(hashes, return_counts=True)
        edges = range_edges(own, bits)
        filled = np.flatnonzero(np.diff(edges))
        cuts = [(edges[r], edges[r + 1]) for r in filled]
        return pa.table({"_range": pa.array(filled, pa.int32()), "_block": pa.array(np.full(len(filled), key[0].as_py()), pa.int32()),
                         "_packed": pa.array([pack(own[a:b]) for a, b in cuts], pa.binary()), "_counts": pa.array([counts[a:b].astype(np.uint32).tobytes() for a, b in cuts], pa.binary())})
    return send


def _answer(table):
    """For each block of a hash range, the level of each of its hashes: 0 if one class has it, else growing with the logarithm of the count."""
    lists = [unpack(x.as_py()) for x in table["_packed"]]
    counts = np.concatenate([np.frombuffer(x.as_py(), np.uint32) for x in table["_counts"]]).astype(np.int64)
    _, inverse = np.unique(np.concatenate(lists), return_inverse=True)
    total = np.bincount(inverse, counts)[inverse]
    level = np.minimum(np.round(8 * np.log2(total)), 255).astype(np.uint8)
    cuts = np.cumsum([0, *map(len, lists)])
    return pa.table({"_block": table["_block"], "_range": table["_range"], "_levels": pa.array([level[a:b].tobytes() for a, b in zip(cuts[:-1], cuts[1:], strict=True)], pa.binary())})


def _prefixer(size, per_cent, bits):
    """The classes of a block that share a prefix shingle with any other class."""
    def prefix(texts, answers):
        texts = _one_each(texts)
        hashes, first = _block_sets(texts, size)
        own, inverse = np.unique(hashes, return_inverse=True)
        edges, levels = range_edges(own, bits), np.zeros(len(own), np.uint8)
        for r, packed in zip(answers["_range"].to_pylist(), answers["_levels"].to_pylist(), strict=True):
            levels[edges[r]:edges[r + 1]] = np.frombuffer(packed, np.uint8)
        level = levels[inverse]
        n = np.diff(first)
        rows = np.repeat(np.arange(len(n)), n)
        order = np.lexsort((hashes, level, rows))
        rank = np.arange(len(hashes)) - np.repeat(first[:-1], n)
        length = n + per_cent * -n // 100 + 1  # n - ceil(t * n) + 1
        shared = np.bincount(rows, level > 0, len(n))
        able = shared >= needed(n, -(-per_cent * n // 100), per_cent)  # with the smallest set that could do
        chosen = order[(rank < np.repeat(length, n)) & (level[order] > 0) & able[rows]]
        keys, key_rows = hashes[chosen].view(np.int64), rows[chosen]
        weight = np.bincount(rows, level, len(n)) / np.maximum(n, 1)
        per_row = np.bincount(key_rows, minlength=len(n))
        some = np.flatnonzero(per_row)
        starts = np.concatenate([[0], np.cumsum(per_row[some])]).astype(np.int32)
        vectors = points(hashes[level > 0], np.concatenate([[0], np.cumsum(shared)]).astype(np.int64))[some]
        return pa.table({"_class": texts["_class"].combine_chunks().take(pa.array(some)), "_n": pa.array(n[some], pa.int64()), "_weight": pa.array(np.round(weight[some] * 1000), pa.int64()),
                         "_point": pa.array([v.tobytes() for v in vectors], pa.binary()), "_keys": pa.ListArray.from_arrays(pa.array(starts), pa.array(keys)),
                         "_text": texts["_text"].combine_chunks().take(pa.array(some))})
    return prefix


def _point_array(column) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.int32).reshape(-1, GROUPS)


def _verifier(size, per_cent):
    """The pairs whose sets reach the index: bound by the points first, then on the sets."""
    def verify(batches):
        for batch in batches:
            na, nb = (batch.column(f"_n_{s}").to_numpy() for s in "ab")
            pa_, pb = (_point_array(batch.column(f"_point_{s}")) for s in "ab")
            rows = np.flatnonzero(np.minimum(pa_, pb).sum(1) >= needed(na, nb, per_cent))
            good = []
            for lo in range(0, len(rows), 256):
                own = rows[lo:lo + 256]
                sets = []
                for s in "ab":
                    parts = list(_sets(batch.column(f"_text_{s}").take(pa.array(own)), size))
                    at = np.concatenate([np.repeat(np.arange(p[0], p[1]), np.diff(p[3])) for p in parts])
                    sets.append((at, np.concatenate([p[2] for p in parts])))
                at, hashes = (np.concatenate([sets[0][i], sets[1][i]]) for i in (0, 1))
                order = np.lexsort((hashes, at))
                at, hashes = at[order], hashes[order]
                twice = (hashes[1:] == hashes[:-1]) & (at[1:] == at[:-1])
                shared = np.bincount(at[1:][twice], minlength=len(own))
                good.append(own[shared >= needed(na[own], nb[own], per_cent)])
            good = pa.array(np.concatenate([np.zeros(0, np.int64), *good]))
            yield pa.RecordBatch.from_arrays([batch.column("a").take(good), batch.column("b").take(good)], ["a", "b"])
    return verify


def _links(pairs: DataFrame, classes: DataFrame, size: int, per_cent: int) -> DataFrame:
    sides = [classes.select(F.col("_class").alias(s), *[F.col(c).alias(f"{c}_{s}") for c in ("_n", "_point", "_text")]) for s in "ab"]
    return pairs.join(sides[0], "a").join(sides[1], "b").mapInArrow(_verifier(size, per_cent), "a long, b long")


def _tree_search(per_cent):
    """Pairs of a task's partitions: different components, bound reached.  Rows of one partition cell are consecutive after the sort."""
    def search(table):
        cols = {c: table[c].to_numpy() for c in ("_key", "_cell", "_class", "_n", "_root", "_side")}
        order = np.lexsort((cols["_cell"], cols["_key"]))
        cols = {c: v[order] for c, v in cols.items()}
        vectors = _point_array(table["_point"])[order]
        new = np.ones(len(order), bool)
        new[1:] = (cols["_key"][1:] != cols["_key"][:-1]) | (cols["_cell"][1:] != cols["_cell"][:-1])
        cuts = np.append(np.flatnonzero(new), len(order))
        found = [np.zeros((0, 2), np.int64)]
        for lo, hi in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True):
            n, side, root, name = (cols[c][lo:hi] for c in ("_n", "_side", "_root", "_class"))
            if (root == root[0]).all():
                continue
            left, right = np.flatnonzero(side != 1), np.flatnonzero(side != 0)
            if not len(left) or not len(right):
                continue
            own = vectors[lo:hi]
            q, t = CountTree(own[right], n[right]).search(own[left], n[left], per_cent)
            q, t = left[q], right[t]
            keep = root[q] != root[t]
            a, b = name[q[keep]], name[t[keep]]
            found.append(np.stack([np.minimum(a, b), np.maximum(a, b)], 1))
        pairs = np.unique(np.concatenate(found), axis=0)
        return pa.table({"a": pa.array(pairs[:, 0]), "b": pa.array(pairs[:, 1])})
    return search


def _cells(rows: DataFrame, classes: DataFrame) -> DataFrame:
    """Partition rows cut into cells: a partition of up to CELL rows is one cell; a larger one has parts, and a cell for each two of them.

    ``_side`` is 0 and 1 for the two parts of a cell, 2 where a cell holds one part alone.
    """
    parts = rows.groupBy("_key").agg(F.ceil(F.count(F.lit(1)) / F.lit(CELL)).cast("int").alias("_parts"))
    own = F.pmod(F.xxhash64("_class"), F.col("_parts")).cast("int")
    rows = rows.join(parts, "_key").withColumn("_own", own).withColumn("_other", F.explode(F.sequence(F.lit(0), F.col("_parts") - 1)))
    low, high = F.least("_own", "_other"), F.greatest("_own", "_other")
    side = F.when(F.col("_own") == F.col("_other"), 2).when(F.col("_own") < F.col("_other"), 0).otherwise(1)
    rows = rows.select("_key", (low * F.col("_parts") + high).alias("_cell"), "_class", "_root", side.cast("int").alias("_side"))
    return rows.join(classes.select("_class", "_n", "_point"), "_class")


def _searched(cells: DataFrame, rows: int, per_cent: int) -> DataFrame:
    """Candidate pairs ``a``, ``b`` of partition cells, by the R-tree, in tasks of about GROUP_ROWS rows."""
    tasks = F.pmod(F.xxhash64("_key", "_cell"), F.lit(max(1, -(-rows // GROUP_ROWS)))).cast("int")
    return cells.withColumn("_task", tasks).groupBy("_task").applyInArrow(_tree_search(per_cent), "a long, b long").distinct()


def class_links(docs: DataFrame, text: str = "text", size: int = SIZE, per_cent: int = PER_CENT) -> tuple[DataFrame, DataFrame]:
    """Verified links ``a``, ``b`` between classes, and their components (``node``, ``root``).

    The links are all those of classes that meet in a partition of up to ``SMALL``
    classes, and beyond them enough to tie every component together.
    """
    blocks, bits = plan(text_bytes(docs, text))
    texts = docs.select(F.col(text).cast("string").alias("_text")).mapInArrow(_first_texts(size, blocks), "_block int, _class long, _text string")
    sent = texts.groupBy("_block").applyInArrow(_sender(size, bits), "_range int, _block int, _packed binary, _counts binary")
    answers = sent.groupBy("_range").applyInArrow(_answer, "_block int, _range int, _levels binary")
    classes = texts.groupBy("_block").cogroup(answers.groupBy("_block")).applyInArrow(_prefixer(size, per_cent, bits), "_class long, _n long, _weight long, _point binary, _keys array<long>, _text string")
    classes = stored(classes, "classes")

    keys = classes.select("_class", "_n", "_weight", F.explode("_keys").alias("_key"))
    centre = F.max(F.struct("_weight", "_class", "_n"))
    # partitions of the same classes are one: the copies of a group share many prefix shingles
    members = [F.bit_xor(F.xxhash64("_class")).alias("_x"), F.bit_xor(F.xxhash64("_class", F.lit(1))).alias("_y"), F.count(F.lit(1)).alias("_m")]
    star = keys.groupBy("_key").agg(centre.alias("_c"), *members).where("_m > 1")
    star = star.groupBy("_x", "_y", "_m").agg(F.min(F.struct("_key", "_c")).alias("_p"))
    star = star.select("_p._key", F.col("_p._c._class").alias("b"), F.col("_p._c._n").alias("_nb"), "_m")
    near = stored(keys.select("_key", "_class", "_n").join(star, "_key"), "near")
    few = near.where(F.col("_m") <= SMALL).select("_key", F.lit(0).alias("_cell"), "_class", F.col("_class").alias("_root"), F.lit(2).alias("_side"))
    found = _searched(few.join(classes.select("_class", "_n", "_point"), "_class"), few.count(), per_cent)
    large = near.where(F.col("_m") > SMALL)
    pairs = large.where((F.col("_class") != F.col("b")) & (F.least("_n", "_nb") * 100 >= F.greatest("_n", "_nb") * per_cent))
    pairs = pairs.select(F.least("_class", "b").alias("a"), F.greatest("_class", "b").alias("b"))
    links = stored(_links(found.unionByName(pairs).distinct(), classes, size, per_cent), "links")

    roots = stored(components(links), "roots")
    # large partitions whose classes, but for the centre that was compared with all, lie in several components
    rest = large.where("_class <> b").select("_key", "_class").join(roots.withColumnRenamed("node", "_class"), "_class", "left").withColumn("_root", F.coalesce("root", "_class")).select("_key", "_class", "_root")
    rest = stored(rest, "rest")
    several = rest.groupBy("_key").agg(F.min("_root").alias("_lo"), F.max("_root").alias("_hi")).where("_lo <> _hi").select("_key")
    open_ = rest.join(several, "_key")
    found = _searched(_cells(open_, classes), open_.count(), per_cent)
    more = stored(_links(found, classes, size, per_cent), "trees")
    if more.isEmpty():
        return links, roots
    links = links.unionByName(more)
    return links, stored(components(links), "roots")


def _members(docs: DataFrame, id: str, text: str, size: int) -> DataFrame:
    """``_id``, ``_class`` and ``_n`` of every document."""
    rows = docs.select(F.col(id).alias("_id"), F.col(text).cast("string").alias("_text"))
    schema = T.StructType([rows.schema["_id"], *T._parse_datatype_string("_class long, _n long").fields])
    return rows.mapInArrow(_tagger(size, ["_id"]), schema)


def near_duplicates(docs: DataFrame, id: str = "doc_id", text: str = "text", size: int = SIZE, per_cent: int = PER_CENT) -> DataFrame:
    """Per document: ``_id``, ``_class``, ``n_shingles``, ``_root`` (its component's key) and ``component_id`` (the smallest id in it)."""
    _, roots = class_links(docs, text, size, per_cent)
    members = stored(_members(docs, id, text, size), "members")
    # one row per class first: a class may hold a third of all documents
    per_class = members.where("_n > 0").groupBy("_class").agg(F.min("_id").alias("_least")).join(roots.withColumnRenamed("node", "_class"), "_class", "left").withColumn("_root", F.coalesce("root", "_class"))
    per_root = per_class.groupBy("_root").agg(F.min("_least").alias("component_id"))
    labelled = per_class.select("_class", "_root").join(per_root, "_root")
    filled = members.where("_n > 0").join(labelled, "_class").select("_id", "_class", F.col("_n").alias("n_shingles"), "_root", "component_id")
    empty = members.where("_n = 0").select("_id", "_class", F.col("_n").alias("n_shingles"), F.lit(None).cast("long").alias("_root"), F.col("_id").alias("component_id"))
    return filled.unionByName(empty)


def keep_one_of_each(docs: DataFrame, id: str = "doc_id", text: str = "text", size: int = SIZE, per_cent: int = PER_CENT) -> DataFrame:
    """``docs`` with one document of each component, the one with the smallest id (of equal rows, one); documents without words stay."""
    found = stored(near_duplicates(docs, id, text, size, per_cent), "components")
    best = found.where("n_shingles > 0 AND _id <=> component_id").groupBy("_root").agg(F.min(F.struct("_id", "_class")).alias("_w"), F.count(F.lit(1)).alias("_copies"))
    best = best.select(F.col("_w._id").alias("_id"), F.col("_w._class").alias("_class"), "_copies")
    names = docs.columns
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in names]).alias("_row"), F.col(text).cast("string").alias("_text"))
    tagged = rows.mapInArrow(_tagger(size, ["_row"]), T.StructType([rows.schema["_row"], *T._parse_datatype_string("_class long, _n long").fields]))
    tagged = tagged.withColumn("_own", F.col(f"_row.`{id}`"))
    kept = tagged.where("_n > 0").join(best, (tagged["_class"] == best["_class"]) & tagged["_own"].eqNullSafe(best["_id"])).select("_row", best["_class"], best["_id"], "_copies")
    once = kept.where("_copies > 1").groupBy("_class", "_id").agg(F.first("_row").alias("_row")).select("_row")
    out = kept.where("_copies = 1").select("_row").unionByName(once).unionByName(tagged.where("_n = 0").select("_row"))
    return out.select([F.col(f"_row.`{c}`").alias(c) for c in names])
