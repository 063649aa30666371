"""Operator 13: a Merkle manifest of a dataset, with proofs.

Each row is hashed to a leaf.  The leaves of a source, ascending by id, are the
first level of its tree; per level, fixed-offset lag and lead columns over a run
of ``FAN`` consecutive nodes, masked by slot and run length, supply every node's
siblings, and the first child's row hashes the parent.  The sources' roots,
ordered by source, are the leaves of one more tree in the same way.

Positions come from a range sort with partition offsets, so a source that holds a
third of all rows is no task of its own, and no window holds more than ``FAN``
rows.  A level has a sixteenth of the rows below it and is written; on the way
down each level joins the sibling lists of the one above, so what is shuffled per
document is two digests and a sixteenth of a path.

Defined results: a null column hashes as ``-``; a null source is a source and
comes first; null ids come first in their source and are never tampered with;
rows of equal ids order by their leaf, so repeated rows are leaves each and are
interchangeable; texts are hashed whole; an empty table gives an empty result.
Columns are read under names of their own, so further columns clash with nothing.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .components import stored
from .ordered import deal, position, spans, with_spans

FAN = 16
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
PATH = "array<struct<left:binary,right:binary>>"


def _text(digests: Column) -> Column:
    """Digests, kept as bytes, as the lowercase hex text that is hashed."""
    return F.lower(F.hex(digests))


def _field(value: Column) -> Column:
    value = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(value).cast("string"), F.lit(":"), value), F.lit("-"))


def leaf_hash(values: list[Column]) -> Column:
    """Digest of one row: each value as its UTF-8 byte count, a colon and the value, ``-`` for a null."""
    return F.unhex(F.sha2(F.concat(*[_field(v) for v in values]), 256))


def with_siblings(nodes: DataFrame, group: list[str]) -> DataFrame:
    """``nodes`` (group, ``_pos``, ``_digest``, ``_n`` nodes in the level) with ``_run``, ``_left`` and ``_right`` siblings."""
    nodes = nodes.withColumn("_run", F.floor(F.col("_pos") / FAN).cast("long"))
    slot, length = F.col("_pos") % FAN, F.least(F.lit(FAN), F.col("_n") - F.col("_run") * FAN)
    run = Window.partitionBy(*group, "_run").orderBy("_pos")
    none = F.lit(b"")
    left = [F.when(slot >= k, F.lag("_digest", k).over(run)).otherwise(none) for k in range(FAN - 1, 0, -1)]
    right = [F.when(slot + k < length, F.lead("_digest", k).over(run)).otherwise(none) for k in range(1, FAN)]
    return nodes.withColumns({"_left": F.concat(*left), "_right": F.concat(*right)})


def parents(nodes: DataFrame, group: list[str]) -> DataFrame:
    """The level above: the first child's row of every run hashes its parent; a lone node stays as it is."""
    hashed = F.when(F.col("_n") > 1, F.unhex(F.sha2(_text(F.concat("_digest", "_right")), 256))).otherwise(F.col("_digest"))
    first = with_siblings(nodes, group).where(F.col("_pos") % FAN == 0)
    return first.select(*group, F.col("_run").alias("_pos"), hashed.alias("_digest"), F.ceil(F.col("_n") / FAN).cast("long").alias("_n"))


def build(leaves: DataFrame, group: list[str]) -> list[DataFrame]:
    """All levels of the trees of ``leaves``, from them to the roots; those above the leaves are written."""
    levels, most = [leaves], leaves.agg(F.max("_n")).first()[0] or 0
    while most > 1:
        levels.append(stored(parents(levels[-1], group), "merkle"))
        most = -(-most // FAN)
    return levels


def _same(columns: dict[str, str]) -> Column:
    return reduce(lambda p, q: p & q, [F.col(c).eqNullSafe(F.col(of)) for c, of in columns.items()])


def paths(levels: list[DataFrame], group: list[str], roots: DataFrame) -> DataFrame:
    """The leaves with ``_path``, the left and right siblings of every level up to their root, then the root's own.

    ``roots`` are the nodes of the last level with the ``_path`` above them; their ``_subroot`` comes down as well.
    """
    down, marks = roots, {c: f"_of{c}" for c in (*group, "_run")}
    for level in reversed(levels[:-1]):
        above = down.select(*[F.col(c).alias(f"_of{c}") for c in group], F.col("_pos").alias("_of_run"), F.col("_path").alias("_up"), "_subroot")
        own = F.when(F.col("_n") > 1, F.array(F.struct(F.col("_left").alias("left"), F.col("_right").alias("right")))).otherwise(F.array().cast(PATH))
        down = with_siblings(level, group).join(above, _same(marks)).withColumn("_path", F.concat(own, "_up")).drop("_up", "_left", "_right", "_run", *marks.values())
    return down


def fold(leaf: Column, path: Column) -> Column:
    """The root, as hex text, that a leaf's hex text gives with the siblings of its path."""
    return F.aggregate(path, leaf, lambda own, s: F.sha2(F.concat(_text(s["left"]), own, _text(s["right"])), 256))


def manifest(docs: DataFrame, id: str = "doc_id", source: str = "source", text: str = "text", fields: tuple[str, ...] = FIELDS, tampered: Column | None = None) -> DataFrame:
    """One row per row of ``docs``: id, ``source``, ``leaf``, ``subroot``, ``root``, ``proof_sha256``, ``folded_root``, ``verified``.

    ``tampered`` is a condition on the input's columns: where it holds, the root is
    folded from the row's leaf with the A-Z of its text in lower case.
    """
    lower = F.translate(F.col(text), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    values = [F.col(c) for c in fields]
    other = leaf_hash([lower if c == text else F.col(c) for c in fields])
    rows = docs.select(F.col(id).alias("_id"), F.col(source).alias("_source"), leaf_hash(values).alias("_digest"), F.when(F.lit(False) if tampered is None else tampered, other).alias("_tampered"))
    dealt = deal(stored(rows, "leaves"), [F.col("_source").asc_nulls_first(), F.col("_id").asc_nulls_first(), "_digest"], "leaves")
    leaves = with_spans(dealt, spans(dealt, ["_source"]), ["_source"]).select("_id", "_source", "_digest", "_tampered", position().alias("_pos"), F.col("_total").alias("_n"))
    levels = build(leaves, ["_source"])

    roots = deal(levels[-1].select("_source", "_digest"), [F.col("_source").asc_nulls_first()], "subroots")
    roots = with_spans(roots, spans(roots, []), []).select("_source", "_digest", position().alias("_pos"), F.col("_total").alias("_n"))
    tops = build(roots, [])
    last = tops[-1].first()
    root = F.lit(last._digest.hex() if last else None)
    above = paths(tops, [], tops[-1].withColumns({"_path": F.array().cast(PATH), "_subroot": F.lit(None).cast("binary")}))
    above = above.select(F.col("_source").alias("_of"), "_path", F.col("_digest").alias("_subroot"))
    found = paths(levels, ["_source"], levels[-1].join(above, F.col("_source").eqNullSafe(F.col("_of"))).drop("_of"))
    folded = fold(_text(F.coalesce("_tampered", "_digest")), F.col("_path"))
    proof = F.sha2(F.array_join(F.transform("_path", lambda s: _text(F.concat(s["left"], s["right"]))), ""), 256)
    return found.withColumn("_folded", folded).select(
        F.col("_id").alias(id), F.col("_source").alias("source"), _text(F.col("_digest")).alias("leaf"), _text(F.col("_subroot")).alias("subroot"), root.alias("root"),
        proof.alias("proof_sha256"), F.col("_folded").alias("folded_root"), (F.col("_folded") == root).alias("verified"))
