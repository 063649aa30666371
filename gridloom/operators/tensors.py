"""Cell form ↔ tensor form.

Cell form ``(time, rlat, rlon, v)`` is what every relational operator works
on; tensor form ``(time, ny, nx, tensor)`` holds one row-major array per time
step (512×512 float32 = 1 MiB per row instead of 262,144 rows).  Packing streams
the cells of a step into an array of the grid's size, batch by batch: nothing is
collected or sorted by position, and the checks are made on the way, so a step
that is inflated by copies stops at the first cell too many.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _packer(keys: list[str], least: list[str], value: str, ny: int, nx: int, check: bool, element: str, names: list[str]):
    """Task function: the cells of one step, as batches, to one row."""
    size = ny * nx

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tensor, seen, ok = np.zeros(size), np.zeros(size, bool), np.zeros(size, bool)
        rows, head, low = 0, None, {}
        for batch in batches:
            if head is None:
                head = [batch.column(k).slice(0, 1) for k in keys]
                step = "/".join(str(h[0].as_py()) for h in head)
            rows += batch.num_rows
            j, i = (batch.column(c).to_numpy(zero_copy_only=False).astype(np.int64) for c in ("rlat", "rlon"))
            if ((j < 0) | (j >= ny) | (i < 0) | (i >= nx)).any():
                raise ValueError(f"step {step} holds cells off the {ny}x{nx} grid")
            if rows > size:
                raise ValueError(f"step {step} holds more than {size} cells")
            at = j * nx + i
            if seen[at].any() or len(np.unique(at)) < len(at):
                raise ValueError(f"missing or duplicate cells in step {step}")
            seen[at] = True
            v = batch.column(value).cast(pa.float64())
            tensor[at] = v.fill_null(np.nan).to_numpy(zero_copy_only=False)
            ok[at] = v.is_valid().to_numpy(zero_copy_only=False)
            for c in least:
                here = pc.min(batch.column(c))
                low[c] = here if c not in low or here.as_py() < low[c].as_py() else low[c]
        if head is None:
            return
        ok &= ~np.isnan(tensor)
        if check and not ok.all():
            raise ValueError(f"missing or duplicate cells in step {step}")
        values = pa.array(tensor.astype(element), mask=None if ok.all() else ~ok)
        made = pa.ListArray.from_arrays(pa.array([0, size], pa.int32()), values)
        yield pa.RecordBatch.from_arrays([*head, *[pa.array([low[c].as_py()], low[c].type) for c in least], pa.array([ny], pa.int32()), pa.array([nx], pa.int32()), made], names)

    return run


def pack(df: DataFrame, value: str, ny: int, nx: int, keys: tuple[str, ...] = ("time",),
         check: bool = True, element_type: str = "float", out: str = "tensor",
         least: tuple[str, ...] = ()) -> DataFrame:
    """One row-major tensor per step.

    A step with a cell twice, a cell off the grid or more than ``ny·nx`` cells
    fails the job; with ``check`` so does a step that lacks a cell or holds a
    missing value (the original pipeline refuses NaN samples), otherwise its tensor
    has a NULL there.  ``least`` names columns whose smallest value rides along.
    The cells meet by step: a frame that is clustered by a part of ``keys`` needs
    no exchange.
    """
    keys, least = list(keys), list(least)
    element = {"float": T.FloatType(), "double": T.DoubleType()}[element_type]
    schema = T.StructType([*[df.schema[c] for c in (*keys, *least)], T.StructField("ny", T.IntegerType()), T.StructField("nx", T.IntegerType()),
                           T.StructField(out, T.ArrayType(element))])
    run = _packer(keys, least, "_value", ny, nx, check, {"float": "float32", "double": "float64"}[element_type], schema.names)
    cells = df.select(*keys, *[c for c in least if c not in keys], "rlat", "rlon", F.col(value).cast("double").alias("_value"))
    return cells.groupBy(*keys).applyInArrow(run, schema)


def unpack(df: DataFrame, value: str = "v", tensor: str = "tensor",
           keys: tuple[str, ...] = ("time",)) -> DataFrame:
    """Tensor rows back to cells (``posexplode``)."""
    keys = [k for k in keys if k in df.columns]
    exploded = df.select(*keys, "nx", F.posexplode(tensor).alias("_p", "_v"))
    return exploded.select(*keys,
                           F.floor(F.col("_p") / F.col("nx")).cast("int").alias("rlat"),
                           (F.col("_p") % F.col("nx")).cast("int").alias("rlon"),
                           F.nanvl(F.col("_v").cast("double"), F.lit(None).cast("double")).alias(value))


def tensor_has_missing(tensor: str | Column) -> Column:
    t = F.col(tensor) if isinstance(tensor, str) else tensor
    return F.exists(t, lambda e: e.isNull() | F.isnan(e))
