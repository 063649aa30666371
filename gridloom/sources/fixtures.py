"""Gridded fields derived from the driver's tables.

Every field here is computed by Spark from the given Parquet tables, so its
size grows with the scale factor:

* ``dense_field`` (G): one 8×8 field per ``embeddings`` row, a time step every
  4 days from 2000-01-01; cells come from ``posexplode`` of the vector.
* ``monthly_field`` (M): a sparse 16×16 monthly field, mean ``l_quantity`` of
  ``lineitem`` per (month, orderkey % 16, partkey % 16).
* ``lead_field`` (L): daily forecast leads 1..12 on a 4×4 grid, sum of
  ``events.value`` per (day, lead, user cell).
* ``curvilinear_target`` (T): a 12×12 rotated grid laid over G's area.
* ``polar_grid``, ``polar_target``: an 8×8 grid that holds the pole and crosses the
  date line, and rings of points around the pole.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .grids import load_grid

# Layout of the derived fields.
DENSE_SIDE = 8
DENSE_START = "2000-01-01 00:00:00"
DENSE_STEP_DAYS = 4
DENSE_LAT0 = 46.0
DENSE_LON0 = 230.0
MONTHLY_SIDE = 16
LEAD_SIDE = 4
LEAD_LEVELS = 12
TARGET_SIDE = 12
POLAR_LAT = 84.0
POLAR_STEP = 0.06
RINGS, RING_POINTS = 9, 16


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return load_grid(spark, f"{sf_dir.rstrip('/')}/{name}.parquet")


def dense_field(spark: SparkSession, sf_dir: str, value: str = "v") -> DataFrame:
    """G: ``(time, rlat, rlon, v)`` from ``embeddings``."""
    emb = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    start = F.lit(DENSE_START).cast("timestamp_ntz")
    cells = emb.select(
        (start + F.make_dt_interval((F.col("vec_id") * DENSE_STEP_DAYS).cast("int"))).alias("time"),
        F.posexplode("embedding").alias("p", "x"))
    return cells.select(
        "time",
        F.floor(F.col("p") / DENSE_SIDE).cast("int").alias("rlat"),
        (F.col("p") % DENSE_SIDE).cast("int").alias("rlon"),
        F.nanvl(F.col("x").cast("double"), F.lit(None).cast("double")).alias(value))


def dense_grid(spark: SparkSession, sf_dir: str, west_negative: bool = False) -> DataFrame:
    """G's regular 1-degree lat/lon grid ``(rlat, rlon, lat, lon)`` (a grid definition).

    ``west_negative`` gives longitudes in -180..180 (for the 0..360 shift).
    """
    n = DENSE_SIDE
    # grid definitions are metadata: one partition is enough
    cells = spark.range(0, n * n, 1, 1).select(F.floor(F.col("id") / n).cast("int").alias("rlat"),
                                      (F.col("id") % n).cast("int").alias("rlon"))
    lon0 = DENSE_LON0 - 360.0 if west_negative else DENSE_LON0
    return cells.select("rlat", "rlon",
                        (F.lit(DENSE_LAT0) + F.col("rlat").cast("double")).alias("lat"),
                        (F.lit(lon0) + F.col("rlon").cast("double")).alias("lon"))


def grid_of_cells(spark: SparkSession, sf_dir: str, west_negative: bool = False) -> DataFrame:
    """G's grid derived from the cells themselves (distinct indices of every step)."""
    cells = dense_field(spark, sf_dir).select("rlat", "rlon").distinct()
    lon0 = DENSE_LON0 - 360.0 if west_negative else DENSE_LON0
    return cells.select("rlat", "rlon",
                        (F.lit(DENSE_LAT0) + F.col("rlat").cast("double")).alias("lat"),
                        (F.lit(lon0) + F.col("rlon").cast("double")).alias("lon"))


def monthly_field(spark: SparkSession, sf_dir: str, value: str = "v",
                  measure: str = "l_quantity", col_key: str = "l_partkey") -> DataFrame:
    """M: ``(time, rlat, rlon, v)`` monthly means from ``lineitem``."""
    li = table(spark, sf_dir, "lineitem")
    return (li.groupBy(
                F.date_trunc("MONTH", "l_shipdate").cast("timestamp_ntz").alias("time"),
                (F.col("l_orderkey") % MONTHLY_SIDE).cast("int").alias("rlat"),
                (F.col(col_key) % MONTHLY_SIDE).cast("int").alias("rlon"))
            .agg(F.avg(measure).alias(value)))


def monthly_grid(spark: SparkSession) -> DataFrame:
    """M's regular half-degree grid over G's area (a grid definition)."""
    n = MONTHLY_SIDE
    cells = spark.range(0, n * n, 1, 1).select(F.floor(F.col("id") / n).cast("int").alias("rlat"),
                                               (F.col("id") % n).cast("int").alias("rlon"))
    return cells.select("rlat", "rlon",
                        (F.lit(DENSE_LAT0) + F.lit(0.5) * F.col("rlat").cast("double")).alias("lat"),
                        (F.lit(DENSE_LON0) + F.lit(0.5) * F.col("rlon").cast("double")).alias("lon"))


def lead_field(spark: SparkSession, sf_dir: str, value: str = "v") -> DataFrame:
    """L: ``(time, level, rlat, rlon, v)`` daily forecast leads from ``events``."""
    ev = table(spark, sf_dir, "events")
    return (ev.groupBy(
                F.date_trunc("DAY", "ts").cast("timestamp_ntz").alias("time"),
                ((F.col("event_id") % LEAD_LEVELS).cast("int") + 1).alias("level"),
                (F.col("user_id") % LEAD_SIDE).cast("int").alias("rlat"),
                (F.floor(F.col("user_id") / LEAD_SIDE) % LEAD_SIDE).cast("int").alias("rlon"))
            .agg(F.sum("value").alias(value)))


def curvilinear_target(spark: SparkSession, lat_shift: float = 0.0,
                       side: int = TARGET_SIDE) -> DataFrame:
    """T: ``side × side`` (12×12) rotated grid over G's area (a grid definition, not data)."""
    n = side
    pts = spark.range(0, n * n, 1, 1).select(
        F.floor(F.col("id") / n).alias("rlat"), (F.col("id") % n).alias("rlon"))
    return pts.select(
        F.col("rlat").cast("int").alias("rlat"), F.col("rlon").cast("int").alias("rlon"),
        (F.lit(46.0 + lat_shift) + F.lit(0.45) * F.col("rlat") + F.lit(0.05) * F.col("rlon")).alias("lat"),
        (F.lit(230.0) + F.lit(0.45) * F.col("rlon") + F.lit(0.05) * F.col("rlat")).alias("lon"))


def polar_grid(spark: SparkSession) -> DataFrame:
    """G's indices on a plane that touches the sphere at 84° N, 0° E: a skewed grid over the pole (a grid definition).

    Longitudes are in -180..180.
    """
    cos, sin, rows = math.cos(math.radians(POLAR_LAT)), math.sin(math.radians(POLAR_LAT)), []
    for j in range(DENSE_SIDE):
        for i in range(DENSE_SIDE):
            a, b = (i - 3.5) * POLAR_STEP, (j - 3.5) * POLAR_STEP * 1.1 + i * 0.01
            x, y, z = cos - sin * b, a, sin + cos * b
            rows.append((j, i, math.degrees(math.asin(z / math.sqrt(x * x + y * y + z * z))), math.degrees(math.atan2(y, x))))
    return spark.createDataFrame(rows, "rlat int, rlon int, lat double, lon double")


def polar_target(spark: SparkSession) -> DataFrame:
    """Rings of points from 73° N to the pole's neighbourhood, longitudes in 0..360 (a grid definition)."""
    pts = spark.range(0, RINGS * RING_POINTS, 1, 1).select(F.floor(F.col("id") / RING_POINTS).cast("int").alias("rlat"), (F.col("id") % RING_POINTS).cast("int").alias("rlon"))
    return pts.select("rlat", "rlon", (F.lit(73.3) + F.lit(2.05) * F.col("rlat")).alias("lat"), (F.lit(22.5) * F.col("rlon") + F.lit(0.37) * F.col("rlat")).alias("lon"))
