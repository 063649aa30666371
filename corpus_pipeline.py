"""A corpus pipeline of five training-data operators over ``documents``.

Toxic documents go, one document of each near-duplicate group stays, passages
that repeat are cut out, documents with benchmark items go, and what is left is
packed by length.  Every stage takes (spark, docs, sf_dir) and works on all that
the stage before kept; all but the last return the columns of ``documents``.

In every stage a null or blank text is kept as it is: it is not toxic, near nothing,
holds no passage and no benchmark item, and is packed with length 0.  A null id, a
null source or language and further columns ride along.  Repeated rows score alike;
one of them stays as a near duplicate.  Texts are worked on whole, however long, by
one task each.  An empty table goes through as an empty table; without labels of both
classes nothing is toxic, without benchmark items nothing is contaminated.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from gridloom.llm.components import stored
from gridloom.llm.decontamination import drop_contaminated
from gridloom.llm.ngram_join import keep_one_of_each
from gridloom.llm.packing import pack_documents
from gridloom.llm.substring_dedup import cut_repeated
from gridloom.llm.toxicity import drop_toxic


#: Near duplicates of the pipeline: shingles of five words, Jaccard index of 0.8; the query op7 has its own values.
SHINGLE, PER_CENT = 5, 80


def _toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return drop_toxic(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def _ngram_jaccard_join(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return keep_one_of_each(docs, size=SHINGLE, per_cent=PER_CENT)


def _substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return cut_repeated(docs)


def _decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return drop_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def _packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return pack_documents(docs)


STAGES = [
    ("toxicity", _toxicity),
    ("ngram_jaccard_join", _ngram_jaccard_join),
    ("substring_dedup", _substring_dedup),
    ("benchmark_decontamination", _decontamination),
    ("packing", _packing),
]

#: SQL has no subword embeddings; the tests hold every stage against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The packing of what the stages leave of ``documents``; each stage's result is written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
