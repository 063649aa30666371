"""Grids written once per run.

A grid is the distinct points of a field, so making one scans the whole field;
alignment then asks the grid for its shape, its axes and its weights, once per
variable.  Here the distinct points are written to the shared checkpoint folder
under a key of the files they come from (names, lengths and modification times)
and of how they are read, and every later request of the run reads that small
table.
"""

from __future__ import annotations

import hashlib
import json
import threading
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession

from ..session import ensure_checkpoint_dir
from .grids import _paths, expand_paths

_making = threading.Lock()


def file_key(spark: SparkSession, path: str | Sequence[str], how: str = "") -> str:
    """A name for the present content of some files, read in some way."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    seen = []
    for p in expand_paths(spark, _paths(path)):
        jp = jvm.org.apache.hadoop.fs.Path(p)
        fs = jp.getFileSystem(conf)
        files = fs.listFiles(jp, True) if fs.exists(jp) else None
        while files is not None and files.hasNext():
            f = files.next()
            seen.append((f.getPath().toString(), f.getLen(), f.getModificationTime()))
    return hashlib.sha256(json.dumps([sorted(seen), how]).encode()).hexdigest()[:32]


def stored_grid(spark: SparkSession, path: str | Sequence[str], how: str, make: Callable[[], DataFrame]) -> DataFrame:
    """The grid ``make`` gives for the files of ``path``: made and written by the first request, read by the others.

    ``how`` tells different readings of the same files apart.  A folder counts
    once Spark has marked it complete, so a write that broke off is made again.
    """
    folder = f"{ensure_checkpoint_dir(spark)}/grids/{file_key(spark, path, how)}"
    jvm = spark.sparkContext._jvm
    done = jvm.org.apache.hadoop.fs.Path(f"{folder}/_SUCCESS")
    with _making:  # variables may run side by side
        if not done.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(done):
            make().write.mode("overwrite").parquet(folder)
    return spark.read.parquet(folder)
