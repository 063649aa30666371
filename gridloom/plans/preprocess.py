"""Per-variable preprocessing (P6) and the loop over models.

For one variable the plan is

    load → names → time slice → align (crop, or regrid+crop+coarsen)
         → transform → year split → fit on train → scale → write

``prepare_variable`` builds it lazily.  ``run_variable`` executes it with two
actions: the aligned and transformed field is first materialised as a reliable
checkpoint (``spark.checkpoint.dir``), and the training statistics are observed
on the rows that go by, so they cost no pass; then the partitioned write.
Executors lost during either action are recovered from the checkpoint and
the shuffle files, not from the driver.
"""

from __future__ import annotations

import logging
import time as _time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import DataConfig, Dimension, Model, Variable
from ..operators import names, samples, scale, select
from ..operators.select import Shape
from ..session import ensure_checkpoint_dir
from ..sinks import writers
from ..sources.grids import load_grid, load_reference_grid
from ..sources.gridstore import stored_grid
from . import align

log = logging.getLogger(__name__)

HR_MODELS = ("hr", "hr_invariant")
LR_MODELS = ("lr", "lr_invariant")


def split_root(output_path: str) -> str:
    return f"{output_path.rstrip('/')}/splits"


def invariant_root(output_path: str) -> str:
    return f"{output_path.rstrip('/')}/invariants"


def align_variable(cells: DataFrame, model: str, scale_factor: int, x, y, value: str,
                   src_grid: DataFrame | None = None, hr_ref: DataFrame | None = None,
                   shape: Shape | None = None, keys=("time",)) -> DataFrame:
    """Dispatch on the model name; unknown names (or LR without a reference grid) → KeyError.

    ``shape`` is the shape of the grid being cropped (the field for ``hr``, the
    reference grid for ``lr``) when known; otherwise it is measured.
    """
    if model in HR_MODELS:
        return align.align_hr(cells, scale_factor, x, y, shape=shape)
    if model in LR_MODELS and hr_ref is not None:
        if src_grid is None:
            raise ValueError("a low-resolution field needs its source grid")
        return align.align_with_lr(cells, src_grid, hr_ref, scale_factor, x, y, value, keys=keys,
                                   tgt_shape=shape)
    raise KeyError(model)


def prepare_variable(cells: DataFrame, var: Variable, model: str,
                     dims: list[Dimension] | None, coords: list[Dimension] | None,
                     start, end, test_years, validation_years, scale_factor: int, x, y,
                     src_grid: DataFrame | None = None, hr_ref: DataFrame | None = None,
                     frame_dims: list[str] | None = None, shape: Shape | None = None,
                     stage=None) -> tuple[DataFrame, dict]:
    """Lazy plan for one variable: returns (frame, attributes).

    Time-dependent variables get a ``split`` column and are scaled with train
    statistics; invariants get no time slice, no transform and no scaling.
    ``stage`` (optional) materialises the aligned and transformed field; the
    statistics are observed on the way.
    """
    if dims is not None and coords is not None:
        cells = names.configure_metadata(cells, var, dims, coords, frame_dims=frame_dims)
    else:
        cells = names.rename_keys(cells, var)
    value = var.name
    keys = ("time",) if not var.invariant and "time" in cells.columns else ()
    if not var.invariant:
        bounds = None
        if shape is None and model in HR_MODELS and {"time", "rlat", "rlon"} <= set(cells.columns):
            bounds, shape = select.field_profile(cells)  # one pass for both
        cells = select.slice_time(cells, start, end, bounds=bounds)
    aligned = align_variable(cells, model, scale_factor, x, y, value, src_grid, hr_ref,
                             shape=shape, keys=keys)
    if var.invariant:
        return aligned, {}
    # Stage only expensive alignments: an LR regrid is worth materialising once
    # for the statistics pass and the write; an HR crop is a filter that reaches
    # the scan, so re-reading the source is cheaper than writing a copy of it.
    if stage is None or model not in LR_MODELS:
        return scale.split_and_scale(aligned, var, test_years, validation_years, value=value)
    aligned, stats = scale.user_defined_transform(aligned, var, value), None
    if var.apply_standardize or var.apply_normalize:
        aligned, stats = scale.observe_train(aligned, value, test_years, validation_years)
    staged = stage(aligned)  # the only job over the aligned field; the statistics come with it
    return scale.split_and_scale(staged, var, test_years, validation_years, value=value,
                                 train_stats=stats() if stats else None, transformed=True)


def checkpoint_stage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint in the shared checkpoint folder (never local)."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def run_variable(spark: SparkSession, model: Model, var: Variable, cfg: DataConfig,
                 src_grid: DataFrame | None = None, hr_ref: DataFrame | None = None,
                 frame_dims: list[str] | None = None, samples_root: str | None = None,
                 sample_shape: tuple[int, int] | None = None) -> dict:
    """Load, prepare and write one variable; returns the recorded attributes.

    With ``samples_root`` the tensor samples (P8) are written as well, packed by
    (split, time): for LR models from the staged frame, for HR models from the
    splits just written, which hold the crop only.
    """
    t0 = _time.time()
    cells = load_grid(spark, var.path)
    frame_dims = frame_dims or cell_dims(cells.columns, var, cfg)
    if model.name in LR_MODELS and src_grid is not None:
        # the source grid carries the coordinates (and their longitude shift)
        names_of = {n for c in cfg.coords for n in (c.name, *c.alternative_names)}
        cells = names.drop_coords(cells, names_of)
    frame, attrs = prepare_variable(
        cells, var, model.name, cfg.dims, cfg.coords, cfg.time.start, cfg.time.end,
        cfg.time.test_years, cfg.time.validation_years, cfg.spatial.scale_factor,
        cfg.spatial.x, cfg.spatial.y, src_grid=src_grid, hr_ref=hr_ref,
        frame_dims=frame_dims, stage=checkpoint_stage)
    if var.invariant:
        writers.write_invariant(frame, invariant_root(cfg.output_path), var.name, model.name)
    else:
        ny, nx = sample_shape or _sample_shape(cfg, model.name)
        chunks = {d.name: d.chunksize for d in cfg.dims}
        tiles = writers.tile_sides(chunks)
        cells_per_step = min(tiles.get("rlat", ny), ny) * min(tiles.get("rlon", nx), nx)
        writers.write_splits(frame, split_root(cfg.output_path), var.name, model.name, attrs=attrs, tiles=tiles,
                             max_records_per_file=writers.records_per_file(chunks.get("time", "auto"), cells_per_step))
        if samples_root is not None:
            if model.name in HR_MODELS:  # what was written is the crop, scaled; the source would be read whole again
                written = writers.read_pairs(spark, split_root(cfg.output_path), [(var.name, model.name)])
                frame = written.select("split", "time", "rlat", "rlon", F.col(writers.VALUE).alias(var.name))
            samples.assert_unique_keys(frame, ("split",))
            tens = samples.samples_by_time(frame, var.name, ny, nx, group=("split",))
            out = tens.withColumn("name", F.concat(F.lit(f"{var.name}_"), F.col("key")))
            writers.write_samples(out, samples_root, var.name, model.name)
            writers.write_train_stats(spark, samples_root, var.name, model.name, attrs)
    log.info("Done processing %s in %s (%.1fs)", var.name, model.info, _time.time() - t0)
    return attrs


def cell_dims(columns: list[str], var: Variable, cfg: DataConfig) -> list[str]:
    """The dimension columns of a field: all but its values and its coordinates (M3 compares them with the configured ones)."""
    other = {var.name, *var.alternative_names} | {n for c in cfg.coords for n in (c.name, *c.alternative_names)}
    return [c for c in columns if c not in other]


def _sample_shape(cfg: DataConfig, model: str) -> tuple[int, int]:
    """Tensor shape after cropping (and coarsening for LR models)."""
    ny = cfg.spatial.y.last_index - cfg.spatial.y.first_index
    nx = cfg.spatial.x.last_index - cfg.spatial.x.first_index
    f = cfg.spatial.scale_factor if model in LR_MODELS else 1
    return ny // f, nx // f


def reference_grid(spark: SparkSession, model: Model, cfg: DataConfig) -> DataFrame | None:
    """The model's ``hr_ref`` grid with names and longitudes normalised."""
    if model.hr_ref is None:
        return None
    grid = stored_points(spark, model.hr_ref.path, cfg)
    return names.match_longitudes(grid) if model.hr_ref.is_west_negative else grid


def stored_points(spark: SparkSession, path, cfg: DataConfig) -> DataFrame:
    """The grid points of a field under their configured names, from the run's grid store."""
    def make():
        return load_reference_grid(spark, names.rename_all(names.rename_all(load_grid(spark, path), cfg.coords), cfg.dims))

    return stored_grid(spark, path, repr((cfg.coords, cfg.dims)), make)


def source_grid(cells: DataFrame) -> DataFrame:
    """Grid frame of a cell-form field that carries lat/lon on each row."""
    return cells.select("rlat", "rlon", "lat", "lon").dropDuplicates(["rlat", "rlon"])


def shifted_grid(grid: DataFrame, var: Variable) -> DataFrame:
    """A variable's grid at the longitudes of the reference grid (M4 on the grid that is regridded)."""
    return names.match_longitudes(grid) if var.is_west_negative else grid


def preprocess(spark: SparkSession, cfg: DataConfig, parallel: int = 1,
               samples_root: str | None = None) -> dict:
    """Every model and variable (P7); returns attributes per output.

    Variables are independent, so with ``parallel > 1`` their jobs are
    submitted from a thread pool and Spark runs them side by side (use the
    FAIR scheduler to share executors evenly).  Each variable and model has a
    path of its own, so concurrent writes do not collide.
    """
    tasks = []
    for model in cfg.climate_models:
        hr_ref = reference_grid(spark, model, cfg)
        for var in model.climate_variables:
            src = None
            if model.name in LR_MODELS:
                raw = names.rename_all(names.rename_all(load_grid(spark, var.path), cfg.coords),
                                       cfg.dims)
                if {"lat", "lon"} <= set(raw.columns):
                    src = shifted_grid(stored_points(spark, var.path, cfg), var)
            tasks.append((model, var, src, hr_ref))

    def run(t):
        model, var, src, ref = t
        return (model.name, var.name), run_variable(spark, model, var, cfg, src, ref,
                                                    samples_root=samples_root)

    if parallel <= 1:
        return dict(run(t) for t in tasks)
    from concurrent.futures import ThreadPoolExecutor
    with ThreadPoolExecutor(max_workers=parallel) as pool:
        return dict(pool.map(run, tasks))
