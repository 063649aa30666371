"""Regridding in tensor form: a sparse matrix–vector product per time step.

When a field is stored one tensor per time step, every step is independent,
so the regrid needs no shuffle at all: each task multiplies its own rows by
the (broadcast) sparse weight matrix.  Spark partitions the work; numpy does
the per-tensor arithmetic inside ``mapInArrow`` on whole Arrow batches.

The weight matrix has at most 4 entries per target point (or a few per
coarse block when composed with the block mean), so the target grid bounds it;
a larger target is cut into bands, each broadcast by itself.  Missing semantics match the
cell form: a target is missing when any contributing source value is missing
or when no source cell contributes (outside the hull).
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .regrid import MAX_BROADCAST_ROWS

# Bytes of gathered products a task materialises at once.
CHUNK_BYTES = 64 * 1024 * 1024


@dataclass
class SparseWeights:
    """CSR-like weights sorted by output index."""
    out_idx: np.ndarray      # unique output positions, ascending
    starts: np.ndarray       # segment starts into in_idx / w
    in_idx: np.ndarray       # source positions
    w: np.ndarray            # weights
    n_out: int


def sparse_weights(weights: DataFrame, nx_in: int, nx_out: int, band: tuple[int, int]) -> SparseWeights:
    """Weights of the output positions ``band[0]`` to ``band[1] - 1`` as sorted arrays, numbered from the band's start.

    Bilinear (and composed) weights hold at most 4 rows per output point, so the
    band bounds what is collected.
    """
    o = F.col("rlat") * nx_out + F.col("rlon")
    pdf = (weights.select((o - F.lit(band[0])).alias("o"), (F.col("sy") * nx_in + F.col("sx")).alias("i"), "w")
           .where((F.col("o") >= 0) & (F.col("o") < band[1] - band[0])).toPandas().sort_values(["o", "i"], kind="stable"))
    uniq, starts = np.unique(pdf["o"].to_numpy(np.int64), return_index=True)
    return SparseWeights(uniq, starts, pdf["i"].to_numpy(np.int64), pdf["w"].to_numpy(np.float64), band[1] - band[0])


def _runner(bcs: list, bands: list[tuple[int, int]], names: list[str], tensor: str, n_in: int, n_out: int):
    """The per-partition function shipped to Python workers.

    Self-contained: it uses only numpy, pyarrow and the broadcast arrays, so
    workers do not need this package on their path.  It emits a batch for every
    few rows, so that neither the gathered products nor the output of a batch
    pass ``CHUNK_BYTES`` by more than one row, and it holds the weights of one
    band at a time.
    """
    limit = CHUNK_BYTES

    def run(batches):
        import numpy as np
        import pyarrow as pa

        def weights(bc):
            arrays = bc.value
            if len(bcs) > 1:
                bc.__dict__.pop("_value", None)  # read again from the worker's disk when its turn comes
            return arrays

        def fill(y, x, bc, start):
            out_idx, starts, in_idx, w = weights(bc)
            if in_idx.size == 0:
                return
            rows = max(1, limit // (8 * in_idx.size))
            for lo in range(0, len(x), rows):
                gathered = x[lo:lo + rows, in_idx]
                sums = np.add.reduceat(gathered * w, starts, axis=1)
                missing = np.add.reduceat(np.isnan(gathered).astype(np.int32), starts, axis=1) > 0
                sums[missing] = np.nan
                y[lo:lo + rows, start + out_idx] = sums

        step = max(1, limit // max(1, 8 * max(n_out, n_in)))
        for whole in batches:
            for lo in range(0, len(whole), step):
                batch = whole.slice(lo, step)
                flat = batch.column(tensor).flatten().to_numpy(zero_copy_only=False).astype(np.float64)
                if flat.size != len(batch) * n_in:
                    raise ValueError(f"tensors must hold {n_in} values each")
                x, y = flat.reshape(len(batch), n_in), np.full((len(batch), n_out), np.nan)
                for bc, (start, _) in zip(bcs, bands):
                    fill(y, x, bc, start)
                offsets = pa.array(np.arange(len(batch) + 1) * n_out, pa.int32())
                values = pa.array(y.ravel(), type=pa.float64(), from_pandas=True)
                yield pa.RecordBatch.from_arrays([*(batch.column(n) for n in names), pa.ListArray.from_arrays(offsets, values)], names=[*names, "_out"])

    return run


def regrid_tensors(df: DataFrame, weights: DataFrame, in_shape: tuple[int, int],
                   out_shape: tuple[int, int], keys: Sequence[str] = ("key", "time"),
                   tensor: str = "tensor", max_rows: int = MAX_BROADCAST_ROWS) -> DataFrame:
    """Map-only regrid of tensor rows ``(*keys, tensor)``; output tensors are doubles.

    Targets whose weights pass ``max_rows`` are cut into bands of output
    positions, one broadcast each; a task fills the bands of a few rows one after
    the other, so there is one pass over the rows whatever the number of bands.
    Nothing is shuffled.
    """
    ny_in, nx_in = in_shape
    ny_out, nx_out = out_shape
    n_in, n_out = ny_in * nx_in, ny_out * nx_out
    per_band = max(1, max_rows // 4)
    keys = [k for k in keys if k in df.columns]
    bands = [(lo, min(n_out, lo + per_band)) for lo in range(0, n_out, per_band)]
    sent = []
    for band in bands:
        sw = sparse_weights(weights, nx_in, nx_out, band)
        sent.append(df.sparkSession.sparkContext.broadcast((sw.out_idx, sw.starts, sw.in_idx, sw.w)))
    rows = df.select(*keys, tensor)
    schema = ", ".join([*(f"`{k}` {df.schema[k].dataType.simpleString()}" for k in keys), "_out array<double>"])
    out = rows.mapInArrow(_runner(sent, bands, keys, tensor, n_in, n_out), schema)
    return out.select(*keys, F.lit(ny_out).alias("ny"), F.lit(nx_out).alias("nx"), F.col("_out").alias(tensor))
