"""Sample, batch and mask production.

Each runs over the (variable, model) pairs written below a root and writes each
pair to its own path:

* ``make_samples`` reads a pair's splits, packs one tensor per hour key and
  writes them with the pair's training statistics (K6).  Invariants have a root
  of their own and are not sampled.
* ``make_batches`` numbers the keys of each split in the seeded permuted
  order, joins the tensors back and stacks ``batch_size`` of them per row.
* ``make_masks`` turns standardized precipitation samples into 0/1 masks.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import samples as S
from ..sinks import bucketed, writers

SPLITS = ("train", "test", "validation")
GROUP = ("variable", "model", "split")


def wanted(spark: SparkSession, root: str, variables: Sequence[str] | None = None,
           models: Sequence[str] | None = None) -> list[tuple[str, str]]:
    """The pairs written below ``root`` that were asked for (None: all)."""
    return [(v, m) for v, m in writers.stored_pairs(spark, root)
            if (variables is None or v in variables) and (models is None or m in models)]


def read_splits(spark: SparkSession, root: str, variables: Sequence[str] | None = None,
                models: Sequence[str] | None = None, splits: Sequence[str] = SPLITS,
                years: Sequence[int] | None = None) -> DataFrame:
    """Open written splits by naming convention (S5): every filter prunes partitions.

    ``years`` filters the ``year`` partition column (``year(time)`` itself is
    not pushed to the scan).
    """
    df = writers.read_pairs(spark, root, wanted(spark, root, variables, models))
    if years:
        df = df.where(F.col("year").isin([int(y) for y in years]))
    return df.where(F.col("split").isin(list(splits)))


def sample_name(variable: str = "variable", key: str = "key"):
    """Sample name ``{variable}_{yyyy-MM-dd-HH}`` (the stem batches are named after)."""
    return F.concat(F.col(variable), F.lit("_"), F.col(key))


def sample_frame(cells: DataFrame, value: str, ny: int, nx: int,
                 group: Sequence[str] = GROUP, check: bool = True) -> DataFrame:
    """Cells ``(*group, time, rlat, rlon, value)`` → one tensor row per (group, key)."""
    out = S.samples(cells, value, ny, nx, group=group, check=check)
    return out.withColumn("name", sample_name()) if "variable" in out.columns else out


def make_samples(spark: SparkSession, split_root: str, sample_root: str, ny: int, nx: int,
                 variables: Sequence[str] | None = None, models: Sequence[str] | None = None,
                 buckets: int | None = None) -> None:
    """Splits → tensors, each (variable, model) written to its own path.

    With ``buckets`` the samples are bucketed by (split, key), so that tables of
    the same number of buckets pair without a shuffle (``bucketed.pair_bucketed``).
    """
    pairs = wanted(spark, split_root, variables, models)
    if not pairs:
        raise FileNotFoundError(f"no splits of {variables} and {models} below {split_root}")
    for var, model in pairs:
        cells = read_splits(spark, split_root, [var], [model])
        rows = sample_frame(cells, writers.VALUE, ny, nx)
        if buckets:
            bucketed.write_bucketed(rows, sample_root, var, model, buckets)
        else:
            writers.write_samples(rows, sample_root, var, model)
        attrs = writers.read_attrs(spark, writers.pair_path(split_root, var, model))
        writers.write_train_stats(spark, sample_root, var, model, {k: v for k, v in attrs.items() if k != "history"})


def list_samples(spark: SparkSession, sample_root: str, variable: str, model: str,
                 split: str) -> DataFrame:
    """S3: sample keys of one (variable, model, split), ordered, with the count."""
    df = writers.read_pairs(spark, sample_root, [(variable, model)]).where(F.col("split") == split)
    return df.select("key").orderBy("key")


def batch_frame(sample_rows: DataFrame, batch_size: int, seed: int = 0,
                group: Sequence[str] = GROUP, randomize: bool = True) -> DataFrame:
    keys = sample_rows.select(*group, "key")
    assignment = S.assign_batches(keys, batch_size, seed, group=group, randomize=randomize)
    small = S.assignment_fits_broadcast(keys)  # a row per key
    name_col = "name" if "name" in sample_rows.columns else "key"
    return S.batches(sample_rows, assignment, group=group, broadcast_assignment=small,
                     name_col=name_col)


def make_batches(spark: SparkSession, sample_root: str, batch_root: str, batch_size: int,
                 seed: int = 0, randomize: bool = True) -> None:
    """Every (variable, model, split) permuted and batched, the same way for equal keys."""
    pairs = wanted(spark, sample_root)
    if not pairs:
        raise FileNotFoundError(f"no samples below {sample_root}")
    for var, model in pairs:
        rows = writers.read_pairs(spark, sample_root, [(var, model)])
        writers.write_batches(batch_frame(rows, batch_size, seed, randomize=randomize), batch_root, var, model)


def mask_frame(sample_rows: DataFrame, threshold: float | None = None) -> DataFrame:
    return S.masks(sample_rows, threshold)


def make_masks(spark: SparkSession, sample_root: str, mask_root: str,
               models: Sequence[str] = ("lr", "hr"), threshold: float | None = None) -> None:
    """P10: masks for the precipitation samples of the given models."""
    pairs = wanted(spark, sample_root, ["pr"], models)
    if not pairs:
        raise FileNotFoundError(f"no precipitation samples of {list(models)} below {sample_root}")
    for var, model in pairs:
        rows = writers.read_pairs(spark, sample_root, [(var, model)]).drop("variable")
        writers.write_masks(mask_frame(rows, threshold), mask_root, model)


def check_mask_variables(variables: Sequence[str]) -> None:
    """Only precipitation can be masked."""
    for v in variables:
        if v != "pr":
            raise ValueError("Only pr is supported for this script.")
