"""Loading gridded data.

Cell-form Parquet is read lazily; value columns get NaN → NULL once.  Several
paths of one variable are one scan (a concatenation along time); paths of
different variables are combined on the coordinates they share.
"""

from __future__ import annotations

import logging
from collections.abc import Iterable, Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, FloatType

from ..functions.scalars import nan_to_null

log = logging.getLogger(__name__)

COORD_COLUMNS = ("time", "level", "rlat", "rlon", "lat", "lon")


def _paths(path: str | Sequence[str]) -> list[str]:
    return [path] if isinstance(path, str) else list(path)


def null_nans(df: DataFrame, keys: Iterable[str] = COORD_COLUMNS) -> DataFrame:
    """NaN → NULL on floating value columns (coordinates untouched)."""
    keys = set(keys)
    fix = {f.name: nan_to_null(f.name) for f in df.schema.fields
           if f.name not in keys and isinstance(f.dataType, (DoubleType, FloatType))}
    return df.withColumns(fix) if fix else df


def expand_paths(spark: SparkSession, paths: Iterable[str]) -> list[str]:
    """Paths with their globs expanded by the cluster's file system, sorted within a glob; a glob without a match stays as it is."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    out = []
    for p in paths:
        found = []
        if any(c in p for c in "*?[{"):
            jp = jvm.org.apache.hadoop.fs.Path(p)
            found = sorted(f.getPath().toString() for f in jp.getFileSystem(conf).globStatus(jp) or [])
        out += found or [p]
    return out


def load_grid(spark: SparkSession, path: str | Sequence[str],
              keys: Sequence[str] = COORD_COLUMNS) -> DataFrame:
    """Open one path, a glob or a list of either.

    Paths holding the same columns are read as one scan (concatenation);
    different variables are merged on the coordinate columns they share, all in
    one step (see ``combine_all``).  With several paths, their schemas are read first,
    some at a time.
    """
    paths = expand_paths(spark, _paths(path))
    if len(paths) == 1:
        return null_nans(spark.read.parquet(paths[0]), keys)
    with ThreadPoolExecutor(8) as pool:
        columns = list(pool.map(lambda p: tuple(spark.read.parquet(p).columns), paths))
    frames: dict[tuple, list[str]] = {}
    for cols, p in zip(columns, paths, strict=True):
        frames.setdefault(cols, []).append(p)
    return combine_all([null_nans(spark.read.parquet(*ps), keys) for ps in frames.values()], keys)


def _only_value(c: str):
    """The one value of a cell's copies; copies that differ are an error, not a choice."""
    differ = F.raise_error(F.concat(F.lit(f"two values of {c} for one cell: "), F.min(c).cast("string"), F.lit(" and "), F.max(c).cast("string")))
    return F.when(F.min(c) != F.max(c), differ).otherwise(F.max(c)).alias(c)


def collapse_copies(df: DataFrame, on: Sequence[str]) -> DataFrame:
    """One row per coordinate key: copies of a cell (a file listed twice) collapse.

    A partial + final aggregate, so copies of even a very hot key are merged
    map-side before anything is shuffled.
    """
    return df.groupBy(*on).agg(*[_only_value(c) for c in df.columns if c not in on])


def combine_all(frames: Sequence[DataFrame], keys: Sequence[str] = COORD_COLUMNS) -> DataFrame:
    """Merge of any number of variables on their shared coordinates.

    Variables on equal coordinates meet in a full outer merge: one union of all of
    them and one ``groupBy(keys)``, in which each key keeps the value of each
    variable (missing where one lacks it), copies collapse map-side, and no key can
    skew the one exchange, however many variables there are.  Variables with fewer
    coordinates (static fields) are merged among themselves in the same way and
    attached to every row that has their cell; Spark broadcasts them if their size
    allows.  Coordinates that do not contain each other, a variable that two inputs
    carry, and two different values of one cell are errors.
    """
    parts = [(f, [k for k in keys if k in f.columns]) for f in frames]
    values = [c for f, on in parts for c in f.columns if c not in on]
    twice = sorted({c for c in values if values.count(c) > 1})
    if twice:
        raise ValueError(f"several inputs carry {twice}; rename all but one first")
    levels: dict[frozenset, list[tuple[DataFrame, list[str]]]] = {}
    for f, on in parts:
        levels.setdefault(frozenset(on), []).append((f, on))
    order = sorted(levels, key=len, reverse=True)
    for less in order[1:]:
        if not less or not less < order[0]:
            raise ValueError(f"coordinates {sorted(order[0])} and {sorted(less)} do not contain each other")
    out = None
    for level in order:
        on = levels[level][0][1]
        merged = levels[level][0][0]
        if len(levels[level]) > 1:
            for f, _ in levels[level][1:]:
                merged = merged.unionByName(f, allowMissingColumns=True)
        if len(levels[level]) > 1 or out is not None:
            merged = collapse_copies(merged, on)
        out = merged if out is None else out.join(merged, on, "left")
    return out.select(*[k for k in keys if k in order[0]], *values)


def combine_variables(a: DataFrame, b: DataFrame,
                      keys: Sequence[str] = COORD_COLUMNS) -> DataFrame:
    """Merge of two variables on their shared coordinates (J2); see ``combine_all``."""
    return combine_all([a, b], keys)


def existing_paths(spark: SparkSession, paths: Iterable[str]) -> list[str]:
    """Keep the paths that exist; warn about and skip the rest.

    Existence is asked of the cluster file system (Hadoop FS), so it works for
    shared storage as well as local folders.
    """
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    keep = []
    for p in paths:
        jp = jvm.org.apache.hadoop.fs.Path(p)
        fs = jp.getFileSystem(conf)
        if fs.exists(jp):
            keep.append(p)
        else:
            log.warning("Input file %s not found. Skipping this variable.", p)
    return keep


def load_reference_grid(spark: SparkSession, path: str | Sequence[str] | DataFrame,
                        rlat: str = "rlat", rlon: str = "rlon") -> DataFrame:
    """The target grid ``(rlat, rlon, lat, lon)`` of a reference field.

    A cell-form reference field carries the coordinates on every row; only
    the distinct grid points are kept.
    """
    df = path if isinstance(path, DataFrame) else spark.read.parquet(*_paths(path))
    return df.select(rlat, rlon, "lat", "lon").dropDuplicates([rlat, rlon])
