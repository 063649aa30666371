"""Operator 12: mixing sources to target weights, in DataFrame functions only.

Every document gets a hash-random key (md5 of a seed and its id) and is
range-sorted by it within its source.  Prefix sums of sizes are the running sum
inside a range partition plus the sizes of the partitions before, so a source
that holds a third of all rows spreads over a third of the partitions.  A source
whose budget is larger than itself is taken whole as often as it fits; the rest
is cut off the sorted order at the exact word, inside a document if need be.

Targets: the sources, by code point with null last, weigh 1, 2, 3 in turn and
share the wanted number of words.  No target exceeds ``epochs`` times its source;
what is over is shared by weight among the others until none is above.  That
fixed point is found in one pass: in ascending order of limit per weight, a
source is at its limit as long as the level at which it would be, with all before
it at theirs, needs no more words than there are.

Defined results: a null or blank text has size 0 and is never taken; a null
source is a source of its own; a null id has one key for all such rows and they
order by size; repeated rows count each and are interchangeable; very long texts
are counted whole; an empty table gives an empty result.  Only id, source and
text of the table are read, under names of their own, so further columns clash
with nothing.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .components import stored
from .ordered import deal, position, spans, with_spans

SEED = "mix"
WEIGHTS, EPOCHS = (1, 2, 3), 3
SEPARATORS = " \t\n\x0b\x0c\r"


def word_count(text: Column) -> Column:
    """Number of ``[^\\x20\\x09-\\x0D]+`` in a text, without an array of them; 0 for a null."""
    marks = F.regexp_replace(text, r"[^\x20\x09-\x0D]+", "x")
    return F.coalesce(F.length(F.translate(marks, SEPARATORS, "")), F.lit(0)).cast("long")


def _before(column: str, within: list[str]) -> Column:
    """Sum of ``column`` over the rows before, after ``with_spans``."""
    own = Window.partitionBy("_part", *within).orderBy("_at").rowsBetween(Window.unboundedPreceding, -1)
    return F.col(f"_rows_{column}") + F.coalesce(F.sum(column).over(own), F.lit(0))


def targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, epochs: int = EPOCHS, share: float = 1.0) -> DataFrame:
    """``_source``, ``_source_size``, ``_target`` and the whole words of it, ``_budget``, of ``sizes`` (``_source``, ``_source_size``)."""
    named = deal(sizes, [F.col("_source").asc_nulls_last()], "sources")
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]), (position() % len(weights) + 1).cast("int")).cast("long")
    named = with_spans(named, spans(named, []), []).select("_source", "_source_size", weight.alias("_weight"), (F.col("_source_size") * epochs).alias("_limit"))
    filled = deal(named, [F.col("_limit") / F.col("_weight")], "limits")
    found = spans(filled, [], ("_limit", "_weight"))
    exact = "decimal(19,0)"
    words = F.floor(F.col("_total__limit") * F.lit(share) / epochs).cast("long")
    filled = stored(with_spans(filled, found, []).withColumns({"_words": words, "_below": _before("_limit", []), "_lighter": _before("_weight", [])}).withColumn(
        "_full", F.col("_limit").cast(exact) * (F.col("_total__weight") - F.col("_lighter")).cast(exact) <= (F.col("_words") - F.col("_below")).cast(exact) * F.col("_weight").cast(exact)), "filled")
    left = filled.agg(F.max("_words").alias("words"), F.sum(F.when(F.col("_full"), F.col("_limit"))).alias("full"), F.sum(F.when(~F.col("_full"), F.col("_weight"))).alias("weight")).first()
    rest = (left.words or 0) - (left.full or 0)
    target = F.when(F.col("_full"), F.col("_limit").cast("double")).otherwise(F.lit(float(rest)) * F.col("_weight") / F.lit(float(left.weight or 1)))
    return filled.select("_source", "_source_size", target.alias("_target"), F.least(F.col("_limit"), F.floor(target + 0.5).cast("long")).alias("_budget"))


def mix(docs: DataFrame, id: str = "doc_id", source: str = "source", text: str = "text", weights: tuple[int, ...] = WEIGHTS, epochs: int = EPOCHS, share: float = 1.0, seed: str = SEED) -> DataFrame:
    """One row per document: id, ``size``, ``source_size``, ``target`` (its source's), ``taken`` words, ``repeats`` (whole passes) and ``cut`` (words of the last pass)."""
    key = F.md5(F.concat(F.lit(seed), F.lit("|"), F.coalesce(F.col(id).cast("string"), F.lit(""))))
    rows = stored(docs.select(F.col(id).alias("_id"), F.col(source).cast("string").alias("_source"), word_count(F.col(text).cast("string")).alias("_size"), F.unhex(key).alias("_key")), "sizes")
    dealt = deal(rows, [F.col("_source").asc_nulls_last(), "_key", "_id", "_size"], "mixed")
    found = spans(dealt, ["_source"], ("_size",))
    wanted = targets(found.groupBy("_source").agg(F.max("_total__size").alias("_source_size")), weights, epochs, share)
    wanted = wanted.withColumnRenamed("_source", "_of")
    found = found.join(wanted, F.col("_source").eqNullSafe(F.col("_of"))).drop("_of")
    repeats = F.when(F.col("_source_size") > 0, F.floor(F.col("_budget") / F.col("_source_size"))).otherwise(F.lit(0)).cast("long")
    rows = with_spans(dealt, found, ["_source"]).withColumn("_repeats", repeats).withColumn("_ahead", _before("_size", ["_source"]))
    rest = F.col("_budget") - F.col("_repeats") * F.col("_source_size")
    cut = F.greatest(F.lit(0), F.least(F.col("_size"), rest - F.col("_ahead"))).cast("long")
    return rows.withColumn("_cut", cut).select(
        F.col("_id").alias(id), F.col("_size").alias("size"), F.col("_source_size").alias("source_size"), F.col("_target").alias("target"),
        (F.col("_repeats") * F.col("_size") + F.col("_cut")).alias("taken"), F.col("_repeats").alias("repeats"), F.col("_cut").alias("cut"))
