"""Aggregations (A1–A8): block coarsening and fused field statistics.

All of them are partial + final aggregates (map-side combine), so the data
that crosses a shuffle is one partial row per group and task.  Coarsening
groups by ``time`` plus the block indices: a frame already hash-partitioned
by ``time`` needs no further exchange.
"""

from __future__ import annotations

from dataclasses import asdict, dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .select import Shape


def _block(c: str, factor: int):
    return F.floor(F.col(c) / F.lit(factor)).cast("int")


def coarsen(df: DataFrame, factor: int, values: str | list[str], shape: Shape | None = None,
            keys: tuple[str, ...] = ("time",), rlat: str = "rlat",
            rlon: str = "rlon") -> DataFrame:
    """Block mean over ``factor × factor`` cells; missing cells are skipped.

    A block whose cells are all missing is missing.  With a known ``shape`` a
    size that is not a multiple of ``factor`` raises ValueError (exact
    boundary).
    """
    if factor < 1:
        raise ValueError(f"blocks need a side of 1 or more, got {factor}")
    if shape is not None and (shape.ny % factor or shape.nx % factor):
        raise ValueError(f"blocks of {factor} do not tile a {shape.ny}x{shape.nx} grid")
    values = [values] if isinstance(values, str) else list(values)
    keys = [k for k in keys if k in df.columns]
    return (df.groupBy(*keys, _block(rlat, factor).alias(rlat), _block(rlon, factor).alias(rlon))
            .agg(*[F.avg(v).alias(v) for v in values]))


def coarsen_grid(grid: DataFrame, factor: int, coords: tuple[str, ...] = ("lat", "lon")) -> DataFrame:
    """Coordinates are block-averaged like the data."""
    return coarsen(grid, factor, [c for c in coords if c in grid.columns], keys=())


@dataclass
class Stats:
    """Statistics of one variable's training data (NULL-skipping, ddof 0)."""
    mean: float | None = None
    std: float | None = None
    min: float | None = None
    max: float | None = None
    count: int = 0

    def as_dict(self) -> dict:
        return asdict(self)

    def __getitem__(self, key):
        return getattr(self, key)

    def __contains__(self, key) -> bool:
        return key in ("mean", "std", "min", "max", "count") and getattr(self, key) is not None


def stats_columns(value: str | Column) -> list[Column]:
    """Mean, population std, min, max and count as aggregate columns."""
    return [F.avg(value).alias("mean"), F.stddev_pop(value).alias("std"),
            F.min(value).cast("double").alias("min"), F.max(value).cast("double").alias("max"),
            F.count(value).alias("count")]


def stats_frame(df: DataFrame, value: str, group: list[str] | None = None) -> DataFrame:
    """Mean, population std, min, max and count fused into one aggregate."""
    aggs = stats_columns(value)
    return df.groupBy(*group).agg(*aggs) if group else df.agg(*aggs)


def fit_stats(df: DataFrame, value: str) -> Stats:
    """One job; returns driver scalars (the only collect in the scaling path)."""
    r = stats_frame(df, value).first()
    return Stats(r["mean"], r["std"], r["min"], r["max"], int(r["count"]))


def axis_bounds(df: DataFrame, column: str) -> tuple:
    r = df.agg(F.min(column), F.max(column)).first()
    return r[0], r[1]


def dim_sizes(df: DataFrame, columns: list[str]) -> dict[str, int]:
    """Number of distinct values per dimension column (small frames only)."""
    r = df.agg(*[F.count_distinct(c).alias(c) for c in columns]).first()
    return {c: int(r[c]) for c in columns}


def step_counts(df: DataFrame, time: str = "time") -> DataFrame:
    """Rows and distinct time steps."""
    return df.agg(F.count(F.lit(1)).alias("n_cells"), F.count_distinct(time).alias("n_steps"))
