"""Grid alignment plans (P4, P5) and the high-resolution crop.

Physical plan for LR alignment (regrid → crop → coarsen):

    scan ─► Exchange(slot of time, n) ─► Window(slot, time)      (whole steps are marked)
         ─► BroadcastHashJoin(weights of both routes)
         ─► HashAggregate(slot, time, route, rlat, rlon)         (no exchange)
         ─► HashAggregate(slot, time, block_y, block_x)          (no exchange)

* The only shuffle moves the *source* field (the small, low-resolution side)
  before the regrid multiplies it to the target size.  A step's partition is
  computed from its time (``timeaxis``); nothing is sampled.
* ``n`` is sized from the *output* volume (steps × target cells), not from
  the input bytes: AQE would size the exchange by the small input and leave a
  few tasks to produce the high-resolution output.
* The crop is pushed into the weight frame: cropped-away targets are never
  computed.
* Two routes in one plan: for a step that holds every source cell once with a
  value, regrid and block mean are both linear, so their weight matrices multiply
  into one (a few source cells per coarse block; targets outside the source
  hull are absent and each block divides by the targets it covers) and the
  high-resolution intermediate is never built.  A step that lacks a cell, holds
  one twice or a missing value is regridded and then block-averaged, because the
  block mean skips missing cells and is then no longer linear.  A window over
  the step decides, inside the same partitioning; one incomplete step leaves
  the others on their route.
* Weights past the broadcast bound meet the cells in bands of target rows
  (``bands``): one scan, one exchange, and the route is chosen per band and step.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..operators import aggregate, regrid, select
from ..operators.bands import apply_banded
from ..operators.select import Shape
from ..operators.timeaxis import SLOT, by_slot, time_axis

# Output bytes per task the time partitioning aims for (cell rows ≈ 24 bytes).
TARGET_TASK_BYTES = 128 * 1024 * 1024
CELL_BYTES = 24


@dataclass
class SourceProfile:
    steps: int
    complete: int


def profile_source(cells: DataFrame, value: str, keys: tuple[str, ...], n_cells: int | None = None) -> SourceProfile:
    """Time steps of the source, and how many hold each of ``n_cells`` cells once and none missing.

    Decided step by step: a copy of one cell never makes up for the lack of
    another.  Without ``n_cells`` only the steps are counted.
    """
    by = [k for k in keys if k in cells.columns]
    if n_cells is None:
        if not by:
            return SourceProfile(1, 0)
        return SourceProfile(int(aggregate.step_counts(cells, by[0]).first()["n_steps"]), 0)
    per_cell = cells.groupBy(*by, "rlat", "rlon").agg(F.count(F.lit(1)).alias("_n"), F.count(value).alias("_v"))
    per_step = per_cell.groupBy(*by).agg(F.count(F.lit(1)).alias("_cells"), F.max("_n").alias("_most"), F.sum("_v").alias("_v"))
    full = (F.col("_cells") == n_cells) & (F.col("_most") == 1) & (F.col("_v") == n_cells)
    r = per_step.agg(F.count(F.lit(1)).alias("steps"), F.count_if(full).alias("complete")).first()
    return SourceProfile(int(r["steps"]), int(r["complete"]))


def time_partitions(steps: int, out_cells_per_step: int, floor: int) -> int:
    """Tasks so that each produces about ``TARGET_TASK_BYTES`` of output (≤ one per step)."""
    want = math.ceil(steps * out_cells_per_step * CELL_BYTES / TARGET_TASK_BYTES)
    return max(1, min(max(want, floor), max(steps, 1)))


def _cropped_target(tgt_grid: DataFrame, scale_factor: int, x, y,
                    shape: Shape | None) -> tuple[DataFrame, Shape]:
    assert "rlon" in tgt_grid.columns, "the target grid has no rlon column"
    assert "rlat" in tgt_grid.columns, "the target grid has no rlat column"
    shape = shape or select.grid_shape(tgt_grid)
    cropped = select.crop_field(tgt_grid, scale_factor, x, y, shape=shape)
    return cropped, select.cropped_shape(scale_factor, x, y, shape)


def _slots(cells: DataFrame, out_cells_per_step: int):
    """The time axis of the cells and the number of slots for their output."""
    axis = time_axis(cells)
    return axis, time_partitions(axis.steps, out_cells_per_step, cells.sparkSession.sparkContext.defaultParallelism)


def _by_time(cells: DataFrame, keys: tuple[str, ...], out_cells_per_step: int) -> tuple[DataFrame, tuple[str, ...]]:
    """Cells dealt by time slot, and the keys that are clustered by it."""
    if "time" not in keys:
        return cells, keys
    axis, n = _slots(cells, out_cells_per_step)
    return by_slot(cells, axis, n), (SLOT, *keys)


def mark_whole(cells: DataFrame, value: str, keys: tuple[str, ...], n_cells: int) -> DataFrame:
    """``cells`` with ``_whole``: whether their step holds ``n_cells`` different cells, each once with a value.

    Windows over the step: no exchange where ``keys`` are clustered.
    """
    step = Window.partitionBy(*keys)
    again = F.lag(F.struct("rlat", "rlon")).over(step.orderBy("rlat", "rlon")).eqNullSafe(F.struct("rlat", "rlon"))
    whole = (F.count(F.lit(1)).over(step) == n_cells) & (F.count(value).over(step) == n_cells) & ~F.max("_again").over(step)
    return cells.withColumn("_again", again).withColumn("_whole", whole).drop("_again")


def _covered(weights: DataFrame) -> DataFrame:
    """The weights, or an error when no target point lies inside the source grid."""
    if weights.isEmpty():
        raise ValueError("no point of the reference grid lies inside the source grid; do both have the same longitude range?")
    return weights


def align_grid(cells: DataFrame, src_grid: DataFrame, tgt_grid: DataFrame, scale_factor: int,
               x, y, value: str, keys: tuple[str, ...] = ("time",),
               tgt_shape: Shape | None = None,
               max_broadcast_rows: int = regrid.MAX_BROADCAST_ROWS) -> DataFrame:
    """Regrid onto the reference grid and crop it (P4); coordinates are dropped."""
    return _aligned(cells, src_grid, tgt_grid, scale_factor, x, y, value, keys, tgt_shape, max_broadcast_rows).drop(SLOT)


def _aligned(cells, src_grid, tgt_grid, scale_factor, x, y, value, keys, tgt_shape, max_broadcast_rows) -> DataFrame:
    regrid.check_inputs(src_grid, tgt_grid)
    target, out_shape = _cropped_target(tgt_grid, scale_factor, x, y, tgt_shape)
    weights = _covered(regrid.grid_weights(src_grid, target))
    # ≤ 4 weight rows per cropped target point: a bound known without a job
    keys = tuple(k for k in keys if k in cells.columns)
    points = out_shape.ny * out_shape.nx
    if 4 * points > max_broadcast_rows:
        return apply_banded(cells, weights, value, keys, out_shape.ny, points, max_broadcast_rows)
    cells, keys = _by_time(cells, keys, points)
    return regrid.apply_weights(cells, weights, value, keys)


def align_with_lr(cells: DataFrame, src_grid: DataFrame, tgt_grid: DataFrame, scale_factor: int,
                  x, y, value: str, keys: tuple[str, ...] = ("time",),
                  tgt_shape: Shape | None = None, compose: bool | str = "auto",
                  max_broadcast_rows: int = regrid.MAX_BROADCAST_ROWS) -> DataFrame:
    """Regrid, crop and coarsen a low-resolution field (P5).

    ``compose``: ``"auto"`` uses the composed weight matrix for every step that
    is whole, ``False`` always runs the two steps, ``True`` requires all steps to
    be whole.
    """
    regrid.check_inputs(src_grid, tgt_grid)
    tgt_shape = tgt_shape or select.grid_shape(tgt_grid)
    out_shape = select.cropped_shape(scale_factor, x, y, tgt_shape)
    keys = tuple(k for k in keys if k in cells.columns)
    if out_shape.ny % scale_factor or out_shape.nx % scale_factor:
        raise ValueError(f"blocks of {scale_factor} do not tile a {out_shape.ny}x{out_shape.nx} grid")
    if compose is False:
        aligned = _aligned(cells, src_grid, tgt_grid, scale_factor, x, y, value, keys, tgt_shape, max_broadcast_rows)
        by = (SLOT, *keys) if SLOT in aligned.columns else keys
        return aggregate.coarsen(aligned, scale_factor, value, shape=out_shape, keys=by).drop(SLOT)

    target, _ = _cropped_target(tgt_grid, scale_factor, x, y, tgt_shape)
    info: dict = {}
    weights = _covered(regrid.grid_weights(src_grid, target, info=info))
    n_cells, points = info.get("source_cells", -1), out_shape.ny * out_shape.nx
    if compose is True:
        profile = profile_source(cells, value, keys, n_cells)
        if profile.complete != profile.steps:
            raise ValueError(f"{profile.steps - profile.complete} of {profile.steps} steps lack cells, repeat them or hold missing values; "
                             "composed weights need every cell once")
    composed = regrid.compose_coarsen(weights, scale_factor)
    if 8 * points > max_broadcast_rows:  # both routes' weights
        return apply_banded(cells, weights, value, keys, out_shape.ny, points, max_broadcast_rows, composed=composed, factor=scale_factor)
    cells, by = _by_time(cells, keys, points)
    marked = mark_whole(cells, value, by, n_cells)
    both = composed.withColumn("_whole", F.lit(True)).unionByName(weights.withColumn("_whole", F.lit(False)))
    made = regrid.apply_weights(marked, both, value, by, match=("_whole",))
    block = {c: F.when(F.col("_whole"), F.col(c)).otherwise(F.floor(F.col(c) / scale_factor)).cast("int") for c in ("rlat", "rlon")}
    # a whole step has its blocks by now, one row each
    return made.groupBy(*by, *[b.alias(c) for c, b in block.items()]).agg(F.avg(value).alias(value)).drop(SLOT)


def align_hr(cells: DataFrame, scale_factor: int, x, y, shape: Shape | None = None) -> DataFrame:
    """High-resolution fields are only cropped (``hr`` / ``hr_invariant``)."""
    return select.crop_field(cells, scale_factor, x, y, shape=shape)
