"""Column functions: scalars (C2–C11) and user transforms."""

from .expr import compile_transform, transform_column
from .scalars import (
    PRECIP_EPSILON,
    calendar_year,
    day_start,
    lead_shift,
    log_precip,
    min_max,
    nan_to_null,
    path_basename,
    path_stem,
    rain_mask,
    rain_mask_tensor,
    rain_threshold,
    sample_key,
    standardize,
    threshold_from_stats,
)

__all__ = [
    "PRECIP_EPSILON", "calendar_year", "compile_transform", "day_start", "lead_shift",
    "log_precip", "min_max", "nan_to_null", "path_basename", "path_stem", "rain_mask",
    "rain_mask_tensor", "rain_threshold", "sample_key", "standardize",
    "threshold_from_stats", "transform_column",
]
