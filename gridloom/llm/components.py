"""Connected components of a link table, by alternating stars."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared checkpoint folder and read again: lineage ends there and a lost executor costs nothing."""
    path = f"{ensure_checkpoint_dir(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def components(links: DataFrame) -> DataFrame:
    """``node`` and ``root`` (the smallest node reachable) of every node of the links ``a``, ``b``.

    Large-star and small-star steps alternate until nothing moves; every edge
    then runs from a node to its root.  Rounds grow with the logarithm of a
    component's size, and each is written to shared storage.
    """
    edges = stored(links.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "links")
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least("u", F.min("v")).alias("m"))
        large = both.where("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.unionByName(low.where("m < u").select("u", F.col("m").alias("v"))).distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        small = stored(small.unionByName(least.select("u", F.col("m").alias("v"))).distinct(), "links")
        # done when every node has one edge and no root has one
        loose = small.groupBy("u").count().where("count > 1").select("u").unionByName(small.select(F.col("v").alias("u")).distinct().join(small.select("u").distinct(), "u"))
        if loose.isEmpty():
            return small.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(small.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
        edges = small
