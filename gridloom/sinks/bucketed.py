"""Sample tables bucketed by their key, and pairs of them without a shuffle.

A high-resolution sample is a megabyte; pairing it with its low-resolution sample
by an ordinary join moves every tensor of both sides.  Here both tables are
written in the same number of buckets of ``(split, key)``, so that a pair's two
rows lie in buckets of the same number: the join reads bucket against bucket, the
small side of each pair of buckets goes into a hash table, and nothing is
exchanged or sorted.

Buckets are known to Spark through a table, not through a path: a written folder
is announced to the session's catalog when it is read.  Every run writes a folder
of its own and its manifest is switched last, as in ``runs``.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import runs
from .writers import pair_path

BUCKET_BY = ("split", "key")
#: Buckets of a sample table; all tables that are to be paired have the same number.
BUCKETS = 64


def _table(folder: str) -> str:
    return f"gridloom_{folder.replace('-', '_')}"


def write_bucketed(samples: DataFrame, root: str, variable: str, model: str, buckets: int = BUCKETS) -> None:
    """Tensor rows ``(split, key, …)`` of one (variable, model) in ``buckets`` buckets, replacing those of the run before.

    Rows are dealt by bucket first, so that a bucket is one file; rows that are
    dealt that way already are not moved again.
    """
    spark, path = samples.sparkSession, pair_path(root, variable, model)
    folder = f"run-{uuid.uuid4().hex}"
    rows = samples.drop("variable", "model").repartition(buckets, *BUCKET_BY)
    (rows.write.format("parquet").bucketBy(buckets, *BUCKET_BY).sortBy(*BUCKET_BY)
     .option("path", f"{path}/{folder}").saveAsTable(_table(folder)))
    old = runs.manifest(spark, path)
    runs.switch(spark, path, {"folder": folder, "buckets": buckets, "attrs": {}})
    if old and old.get("folder"):
        spark.sql(f"DROP TABLE IF EXISTS {_table(old['folder'])}")
        fs, p = runs._path(spark, f"{path}/{old['folder']}")
        fs.delete(p, True)


def read_bucketed(spark: SparkSession, root: str, variable: str, model: str) -> DataFrame:
    """The current rows of a bucketed table; FileNotFoundError if nothing complete was written."""
    path = pair_path(root, variable, model)
    found = runs.manifest(spark, path)
    if not found or not found.get("folder"):
        raise FileNotFoundError(f"no bucketed samples of {variable} and {model} below {root}")
    name = _table(found["folder"])
    if not spark.catalog.tableExists(name):
        folder = f"{path}/{found['folder']}"
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in spark.read.parquet(folder).schema)
        keys = ", ".join(BUCKET_BY)
        spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING parquet CLUSTERED BY ({keys}) SORTED BY ({keys}) INTO {found['buckets']} BUCKETS LOCATION '{folder}'")
    return spark.table(name)


def pair_bucketed(spark: SparkSession, root: str, lr: tuple[str, str], hr: tuple[str, str], splits: Sequence[str] | None = None) -> DataFrame:
    """``(split, key, lr_tensor, hr_tensor)`` of two written (variable, model) tables, bucket against bucket."""
    low, high = (read_bucketed(spark, root, *of).select(*BUCKET_BY, F.col("tensor").alias(name)) for of, name in ((lr, "lr_tensor"), (hr, "hr_tensor")))
    if splits is not None:
        low, high = (side.where(F.col("split").isin(list(splits))) for side in (low, high))
    # the low-resolution side of a bucket is built, the other one streams by
    return high.join(low.hint("shuffle_hash"), list(BUCKET_BY)).select(*BUCKET_BY, "lr_tensor", "hr_tensor")
