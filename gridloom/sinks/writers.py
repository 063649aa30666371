"""Writers (K1–K8): partitioned Parquet plus small JSON sidecars.

* Every (variable, model) has a path of its own below the root of its kind,
  ``root/variable=…/model=…``, and is replaced as a whole: a partition that a
  new run does not produce is gone, other variables are never touched, and a run
  that fails leaves the rows of the run before (``runs``).
  Splits, invariants, samples, batches and masks have separate roots, and the
  value column is called ``value`` everywhere, so a root has one schema and one
  partition depth.
* Attributes (``history``, train statistics) go into the run's manifest; what has
  attributes but no rows gets a one-row JSON sidecar in ``_attrs/``.  Names
  starting with ``_`` are ignored by the Parquet reader.
* No writer adds a shuffle by default: rows are sorted within their task
  (partition columns, then time), so every file holds an ordered run and
  Parquet row-group statistics let time filters skip data.  Frames coming
  out of the alignment plan are already range-partitioned by time, so their
  files also cover contiguous time ranges.
"""

from __future__ import annotations

import datetime as dt
import json
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.timeaxis import SLOT, by_slot, time_axis
from . import runs

ATTRS_DIR = "_attrs"
VALUE = "value"


def pair_path(root: str, variable: str, model: str) -> str:
    """The folder of one (variable, model) below a root."""
    return f"{root.rstrip('/')}/variable={variable}/model={model}"


def stored_pairs(spark: SparkSession, root: str) -> list[tuple[str, str]]:
    """The (variable, model) pairs written below ``root``, asked of the cluster's file system."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{root.rstrip('/')}/variable=*/model=*")
    found = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).globStatus(path)
    folders = [(f.getPath().getParent().getName(), f.getPath().getName()) for f in found or []]
    return sorted((v.removeprefix("variable="), m.removeprefix("model=")) for v, m in folders)


def read_pairs(spark: SparkSession, root: str, pairs: Sequence[tuple[str, str]]) -> DataFrame:
    """The rows of some pairs with their partition columns; no pair → FileNotFoundError."""
    if not pairs:
        raise FileNotFoundError(f"nothing is written for the variables and models asked for below {root}")
    return runs.read_folders(spark, [pair_path(root, v, m) for v, m in pairs], base=root.rstrip("/"))


def history_line(program: str = "gridloom") -> str:
    return f"Created by {program} on {dt.datetime.now()}"


def write_attrs(spark: SparkSession, path: str, attrs: dict) -> None:
    """One-row JSON sidecar (a handful of scalars)."""
    row = json.dumps({k: (None if v is None else v) for k, v in attrs.items()}, default=str)
    (spark.createDataFrame([(row,)], "value string").coalesce(1)
     .write.mode("overwrite").text(f"{path.rstrip('/')}/{ATTRS_DIR}"))


def read_attrs(spark: SparkSession, path: str) -> dict:
    """The attributes of a written folder, or of a sidecar."""
    found = runs.manifest(spark, path)
    if found:
        return found["attrs"]
    rows = spark.read.text(f"{path.rstrip('/')}/{ATTRS_DIR}").collect()
    return json.loads(rows[0][0]) if rows else {}


def tile_sides(chunks: dict) -> dict[str, int]:
    """Sides of the spatial tiles asked for (K4): rlat and rlon chunk sizes that are positive numbers."""
    return {d: chunks[d] for d in ("rlat", "rlon") if isinstance(chunks.get(d), int) and chunks[d] > 0}


def write_dataset(df: DataFrame, path: str, attrs: dict | None = None,
                  partition_by: Sequence[str] = (), max_records_per_file: int | None = None,
                  tiles: dict[str, int] | None = None) -> None:
    """Replace what ``path`` holds by ``df`` and record ``history`` (K1, K4).

    The old rows stay until the new ones are complete.  An empty frame still
    writes its schema and its attributes.  With ``tiles`` the
    rows of a task are ordered tile by tile, each in time order, so that files cut
    at ``max_records_per_file`` hold chunks of one tile.
    """
    spark = df.sparkSession
    tiles = {d: n for d, n in (tiles or {}).items() if d in df.columns}
    order = [*(c for c in partition_by if c in df.columns), *(F.floor(F.col(d) / n) for d, n in tiles.items()),
             *(c for c in ("time",) if c in df.columns), *tiles]
    out = df.sortWithinPartitions(*order) if order else df
    w = out.write.mode("append")
    if partition_by:
        w = w.partitionBy(*partition_by)
    if max_records_per_file:
        w = w.option("maxRecordsPerFile", max_records_per_file)
    runs.replace(spark, path, lambda: w.parquet(path), {"history": history_line(), **(attrs or {})})


def write_by_time(df: DataFrame, path: str, files: int, attrs: dict | None = None) -> None:
    """``df`` in time order over about ``files`` files of consecutive steps.

    Rows are dealt by a slot computed from the time axis, so nothing is sampled; on
    an uneven axis, whose slots are no ranges, Spark's range partitioning deals them.
    """
    axis = time_axis(df)
    dealt = by_slot(df, axis, files).drop(SLOT) if axis.even else df.repartitionByRange(files, "time")
    write_dataset(dealt, path, attrs=attrs)


def records_per_file(time_chunksize, cells_per_step: int) -> int | None:
    """A time chunk of ``n`` steps → files of at most ``n`` steps (K4); -1/"auto" → no cap."""
    if isinstance(time_chunksize, int) and time_chunksize > 0:
        return time_chunksize * cells_per_step
    return None


def neutral(df: DataFrame, variable: str) -> DataFrame:
    """``df`` with the variable's column under the name all variables share."""
    return df.withColumnRenamed(variable, VALUE)


def write_splits(df: DataFrame, root: str, variable: str, model: str,
                 attrs: dict | None = None, max_records_per_file: int | None = None,
                 tiles: dict[str, int] | None = None) -> None:
    """The splits of one (variable, model), partitioned by split and year (K2).

    ``df`` carries a ``split`` column; an earlier run of the same variable and
    model is replaced entirely, whatever years it had.
    """
    out = neutral(df, variable).withColumn("year", F.year("time").cast("int"))
    write_dataset(out, pair_path(root, variable, model), attrs=attrs, partition_by=("split", "year"),
                  max_records_per_file=max_records_per_file, tiles=tiles)


def write_invariant(df: DataFrame, root: str, variable: str, model: str) -> None:
    """An invariant field, without splits (K3)."""
    write_dataset(neutral(df, variable), pair_path(root, variable, model))


def _write_tensors(rows: DataFrame, root: str, variable: str, model: str) -> None:
    path = pair_path(root, variable, model)
    w = rows.drop("variable", "model").write.mode("append").partitionBy("split")
    runs.replace(rows.sparkSession, path, lambda: w.parquet(path))


def write_samples(samples: DataFrame, root: str, variable: str, model: str) -> None:
    """Tensor rows, one per time step (K5); ``key`` names the sample.

    No extra shuffle: rows are only sorted within their task by split and key,
    so each file holds an ordered run of samples.
    """
    _write_tensors(samples.sortWithinPartitions("split", "key"), root, variable, model)


def write_train_stats(spark: SparkSession, root: str, variable: str, model: str,
                      attrs: dict) -> None:
    """Training statistics sidecar (K6): ``attributes`` with one entry per attribute."""
    write_attrs(spark, f"{root.rstrip('/')}/train/{variable}_train_{model}_attrs",
                {"attributes": attrs})


def write_batches(batches: DataFrame, root: str, variable: str, model: str) -> None:
    """Stacked batch tensors named by their members (K7)."""
    _write_tensors(batches, root, variable, model)


def write_masks(masks: DataFrame, root: str, model: str) -> None:
    """Mask tensors under variable ``pr_mask`` (K8)."""
    _write_tensors(masks, root, "pr_mask", model)
