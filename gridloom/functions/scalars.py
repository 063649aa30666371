"""Column-level scalar functions (all JVM-side, codegen friendly).

Missing values: an absent cell, a NULL and a NaN all mean "missing".  NaN is
turned into NULL once on load (``nan_to_null``) so that Spark's aggregates
skip it the way NaN-skipping array reductions do.
"""

from __future__ import annotations

import math
import numbers

from pyspark.sql import Column
from pyspark.sql import functions as F

# Precipitation log-scale epsilon and the standardized value of
# zero rain (-mean/std of a fixed set of precipitation statistics).
PRECIP_EPSILON = 1e-3
RAIN_MEAN = 0.0769779160618782
RAIN_STD = 0.3726992905139923

# Fixed value: sample key format, one sample per hour.
SAMPLE_KEY_FORMAT = "yyyy-MM-dd-HH"


def col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def nan_to_null(c: str | Column) -> Column:
    """NaN → NULL (numeric columns only)."""
    return F.nanvl(col(c), F.lit(None).cast("double"))


def _check_number(name: str, v) -> None:
    if v is None:
        return
    if isinstance(v, bool) or not isinstance(v, numbers.Real):
        raise TypeError(f"{name} must be a number, got {type(v).__name__}")


def standardize(c: str | Column, mean, std) -> Column:
    """``(x - mean) / std``; std 0 raises ZeroDivisionError, non-numbers TypeError.

    ``None`` statistics (an empty training set) yield NULL values.
    """
    _check_number("mean", mean)
    _check_number("std", std)
    if std is not None and std == 0:
        raise ZeroDivisionError("the training values are all equal: their standard deviation of 0 cannot scale anything")
    if mean is None or std is None or (isinstance(std, float) and math.isnan(std)):
        return F.lit(None).cast("double")
    return (col(c).cast("double") - F.lit(float(mean))) / F.lit(float(std))


def min_max(c: str | Column, lo, hi) -> Column:
    """``(x - min) / (max - min)``; min == max raises ZeroDivisionError."""
    _check_number("min", lo)
    _check_number("max", hi)
    if lo is not None and hi is not None and lo == hi:
        raise ZeroDivisionError(f"the training values span no range: smallest and largest are both {lo}")
    if lo is None or hi is None:
        return F.lit(None).cast("double")
    return (col(c).cast("double") - F.lit(float(lo))) / F.lit(float(hi) - float(lo))


def log_precip(c: str | Column, lo, hi, eps: float = PRECIP_EPSILON) -> Column:
    """Log scale used for precipitation: ``(ln(x+e) - ln e) / (ln(max+e) - ln e)``.

    ``lo`` is only checked against ``hi`` (it is recorded, not used).  Values
    with ``x + e <= 0`` have no logarithm and become NULL (numpy: NaN/-inf).
    """
    _check_number("min", lo)
    _check_number("max", hi)
    if lo is not None and hi is not None and lo == hi:
        raise ZeroDivisionError(f"the training values span no range: smallest and largest are both {lo}")
    if hi is None:
        return F.lit(None).cast("double")
    denom = math.log(float(hi) + eps) - math.log(eps)
    shifted = col(c).cast("double") + F.lit(eps)
    logged = F.when(shifted > 0, F.ln(shifted))
    return (logged - F.lit(math.log(eps))) / F.lit(denom)


def rain_threshold(mean: float = RAIN_MEAN, std: float = RAIN_STD) -> float:
    """Standardized value of zero rain: ``-mean / std``."""
    return -mean / std


def threshold_from_stats(stats) -> float:
    return rain_threshold(stats.mean, stats.std)


def rain_mask(c: str | Column, threshold: float | None = None) -> Column:
    """1 where the value exceeds the zero-rain threshold, else 0 (missing → 0)."""
    thr = rain_threshold() if threshold is None else threshold
    return F.when(col(c) > F.lit(float(thr)), F.lit(1)).otherwise(F.lit(0))


def rain_mask_tensor(c: str | Column, threshold: float | None = None) -> Column:
    """``rain_mask`` element-wise over a tensor array."""
    thr = rain_threshold() if threshold is None else threshold
    return F.transform(col(c), lambda e: F.when(e > F.lit(float(thr)), F.lit(1)).otherwise(F.lit(0)))


def sample_key(time: str | Column = "time") -> Column:
    """``yyyy-MM-dd-HH`` key of a time step."""
    return F.date_format(col(time), SAMPLE_KEY_FORMAT)


def calendar_year(time: str | Column = "time") -> Column:
    return F.year(col(time)).cast("int")


def lead_shift(time: str | Column, level: str | Column) -> Column:
    """Forecast lead *i* (1-based) is valid ``i - 1`` hours after the base time."""
    return col(time) + F.make_dt_interval(F.lit(0), col(level).cast("int") - F.lit(1))


def path_basename(path: str | Column) -> Column:
    return F.regexp_extract(col(path), r"([^/]+)$", 1)


def path_stem(path: str | Column) -> Column:
    """File name without its last suffix (``a/b/c.pt`` → ``c``)."""
    return F.regexp_extract(col(path), r"([^/]+?)(\.[^./]*)?$", 1)


def day_start(time: str | Column) -> Column:
    """Midnight of the day (kept as timestamp_ntz)."""
    return F.date_trunc("DAY", col(time)).cast("timestamp_ntz")
