"""Folds and bounded samples of labelled documents."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def fold(id: str, folds: int) -> Column:
    """The fold of a document: crc32 of its id as text, modulo ``folds``; a null id is in fold -1."""
    return F.coalesce(F.crc32(F.col(id).cast("string")) % folds, F.lit(-1))


def sample(docs: DataFrame, labels: DataFrame, label: str, training: Column, per_class: int, id: str = "doc_id", text: str = "text") -> DataFrame:
    """``label`` (0 or 1) and ``text`` of at most ``per_class`` documents of each label, first by a hash of the id.

    Only ids and labels are joined and ranked; texts are read for the ids chosen.
    Two labels of one id count as the larger, of two texts the first by code point.
    """
    known = labels.where(F.col(label).isin(0, 1)).groupBy(id).agg(F.max(label).cast("int").alias("_label"))
    known = docs.select(id).distinct().where(training & F.col(id).isNotNull()).join(known, id)
    chosen = [known.where(F.col("_label") == k).orderBy(F.xxhash64(id), id).limit(per_class) for k in (0, 1)]
    chosen = chosen[0].unionByName(chosen[1])
    texts = docs.select(id, F.coalesce(F.col(text).cast("string"), F.lit("")).alias("_text")).join(F.broadcast(chosen), id)  # at most 2 * per_class ids
    return texts.groupBy(id).agg(F.min("_label").alias("label"), F.min("_text").alias("text")).select("label", "text")
