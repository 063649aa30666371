"""One namespace with the pipeline's entry points under their familiar names.

Every function takes and returns DataFrames (cell form) plus small driver
values; see the modules they come from for the Spark plans they build.
"""

from .config import (DataConfig, Dimension, IndexRange, Loader, Model, Spatial, TimeSelect,
                     Variable, load_config)
from .errors import MissingKey, MultipleKeys
from .functions.expr import compile_transform, transform_column
from .functions.scalars import (log_precip, min_max, rain_mask, sample_key, standardize,
                                threshold_from_stats)
from .operators.aggregate import Stats, coarsen, coarsen_grid, fit_stats, stats_frame
from .operators.names import (configure_metadata, match_longitudes, rename_all, rename_keys,
                              squeeze_extra_dims)
from .operators.regrid import apply_weights, bilinear_weights, grid_weights, interpolate
from .operators.samples import assign_batches, batches, masks, pair_samples, samples
from .operators.scale import (compute_normalization, compute_standardization, split_and_scale,
                              split_and_standardize, user_defined_transform)
from .operators.select import (box_select, crop_field, date_select, slice_time,
                               train_test_split, with_split)
from .operators.sphere import spherical_weights
from .operators.tensor_regrid import regrid_tensors
from .operators.tensors import pack, unpack
from .plans.align import align_grid, align_hr, align_with_lr
from .plans.cuts import cut_all, source_cut, unfold_all, unfold_leads
from .plans.preprocess import preprocess, prepare_variable, run_variable
from .plans.samples import make_batches, make_masks, make_samples
from .sinks.bucketed import pair_bucketed, read_bucketed, write_bucketed
from .sinks.runs import read_dataset
from .sinks.writers import write_by_time, write_dataset, write_splits
from .sources.grids import combine_all, combine_variables, load_grid, load_reference_grid


def coarsen_lr(df, scale_factor: int, value: str = "v", **kw):
    """Block mean by ``scale_factor`` (the low-resolution coarsening step)."""
    return coarsen(df, scale_factor, value, **kw)


__all__ = [n for n in dir() if not n.startswith("_")]
