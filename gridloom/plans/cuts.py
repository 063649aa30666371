"""Source preparation: box/date cut (P11) and forecast-lead unfolding.

Both are single projections/filters; the filters reach the Parquet scan.
``cut_all`` and ``unfold_all`` run them over the sources of a configuration file
and write what they make.
"""

from __future__ import annotations

import os
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession

from ..functions.scalars import lead_shift
from ..operators import names, select
from ..sinks import writers
from ..sources.grids import existing_paths, load_grid, load_reference_grid
from ..sources.gridstore import stored_grid

#: Endings of the names that the steps write under.
CUT, UNFOLDED = "_time_sliced_cropped", "_merged_forecast_time"


def unfold_leads(df: DataFrame, time: str = "time", level: str = "level") -> DataFrame:
    """Forecast lead *i* becomes a step at ``time + (i-1) h`` with level 0.

    Splitting by level, shifting each level and merging by time collapse into
    one projection over the ``level`` column; duplicate valid times are kept.
    """
    return names.set_level(df.withColumn(time, lead_shift(time, level)), level=level)


def source_cut(cells: DataFrame, grid: DataFrame, lon_min: float, lon_max: float,
               lat_min: float, lat_max: float, start_date, end_date) -> DataFrame:
    """Longitude/latitude box, then whole-day date range."""
    boxed, _ = select.box_select(cells, grid, lon_min, lon_max, lat_min, lat_max)
    return select.date_select(boxed, start_date, end_date)


def cut_sources(spark: SparkSession, paths: list[str], grid: DataFrame, box: dict,
                start_date, end_date) -> dict[str, DataFrame]:
    """Cut each existing source; missing inputs are warned about and skipped."""
    out = {}
    for p in existing_paths(spark, paths):
        out[p] = source_cut(load_grid(spark, p), grid, box["lon_min"], box["lon_max"],
                            box["lat_min"], box["lat_max"], start_date, end_date)
    return out


def _stem(name: str) -> str:
    return os.path.basename(name.rstrip("/")).split(".")[0]


def cut_all(spark: SparkSession, cfg: Mapping) -> list[str]:
    """P11 for every variable of a configuration; returns the paths written.

    ``cfg`` has ``data_dir``, ``output_dir``, ``lon_min`` … ``lat_max`` and
    ``variables`` with ``name``, ``start_date`` and ``end_date``.  A source that is
    not there is warned about and skipped.  The grid is that of the field itself
    (its ``lat`` and ``lon`` on every row) or the file of ``grid``.
    """
    box = {k: float(cfg[k]) for k in ("lon_min", "lon_max", "lat_min", "lat_max")}
    written = []
    for var in cfg["variables"]:
        source = f"{cfg['data_dir'].rstrip('/')}/{var['name']}"
        if not existing_paths(spark, [source]):
            continue
        where = cfg.get("grid") or source
        grid = stored_grid(spark, where, "cut", lambda where=where: load_reference_grid(spark, load_grid(spark, where)))
        out = f"{cfg['output_dir'].rstrip('/')}/{_stem(var['name'])}{CUT}"
        writers.write_dataset(source_cut(load_grid(spark, source), grid, **box, start_date=var["start_date"], end_date=var["end_date"]), out)
        written.append(out)
    return written


def unfold_all(spark: SparkSession, cfg: Mapping) -> list[str]:
    """P12 for the cut precipitation sources of a configuration (names that begin with ``pr``); returns the paths written."""
    written = []
    for var in cfg["variables"]:
        source = f"{cfg['output_dir'].rstrip('/')}/{_stem(var['name'])}{CUT}"
        if not _stem(var["name"]).startswith("pr") or not existing_paths(spark, [source]):
            continue
        writers.write_dataset(unfold_leads(load_grid(spark, source)), source + UNFOLDED)
        written.append(source + UNFOLDED)
    return written
