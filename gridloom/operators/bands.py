"""Weights past the broadcast bound: one scan and one exchange for any number of bands.

Targets are cut into bands of rows whose weights fit a task.  Which bands need a
source cell is a small table (band, source row, first and last column) computed
from the weights; every cell goes once to each of those bands, dealt by band and
time slot, and meets the band's weights there in one co-group.  The product is a
sparse matrix applied step by step with numpy.

With ``composed`` weights (regrid and block mean in one matrix) the route is
chosen per band and step: where every source cell that the band needs is there
once with a value, the composed weights apply; elsewhere the band is regridded
and block-averaged in two steps.  Band borders lie on block borders, so no block
is cut.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .timeaxis import SLOT

# Cells that a task holds for one band and slot.
GROUP_CELLS = 4_000_000


def _work(keys: list[str], values: list[str], factor: int | None, schema):
    """Task function of one band and slot: (cells, weights) → the band's targets of every step."""
    def matrix(rows, width):
        """Weights sorted by target: source cells, weights, first row of each target, its indices and corners."""
        import numpy as np

        order = np.lexsort((rows["sx"], rows["sy"], rows["rlon"], rows["rlat"]))
        r = {k: v[order] for k, v in rows.items()}
        code = r["sy"].astype(np.int64) * width + r["sx"]
        new = np.ones(len(code), bool)
        new[1:] = (r["rlat"][1:] != r["rlat"][:-1]) | (r["rlon"][1:] != r["rlon"][:-1])
        first = np.flatnonzero(new)
        return code, r["w"], first, r["rlat"][first], r["rlon"][first], r["n_corners"][first]

    def run(cells, weights):
        import numpy as np
        import pyarrow as pa

        names = [*keys, "rlat", "rlon", *values]
        empty = pa.table({n: pa.array([], t) for n, t in zip(names, schema, strict=True)})
        if not cells.num_rows or not weights.num_rows:
            return empty
        number = lambda t, c: t[c].to_numpy().astype(np.int64)
        w = {c: number(weights, c) for c in ("rlat", "rlon", "sy", "sx", "n_corners")} | {"w": weights["w"].to_numpy()}
        whole = weights["_whole"].to_numpy().astype(bool)
        sy, sx = number(cells, "sy"), number(cells, "sx")
        width = int(max(sx.max(), w["sx"].max())) + 1
        parts = {k: matrix({c: v[whole == k] for c, v in w.items()}, width) for k in (True, False) if (whole == k).any()}
        known = np.unique(np.concatenate([m[0] for m in parts.values()]))
        at = {k: np.searchsorted(known, m[0]) for k, m in parts.items()}
        needed = {k: np.bincount(at[k], minlength=len(known)) > 0 for k in at}
        code = sy * width + sx
        place = np.searchsorted(known, code)
        used = (place < len(known)) & (known[np.minimum(place, len(known) - 1)] == code)

        # steps: equal keys get equal numbers
        step = np.zeros(cells.num_rows, np.int64)
        for k in keys:
            coded = cells[k].combine_chunks().dictionary_encode()
            step = step * (len(coded.dictionary) + 1) + coded.indices.fill_null(len(coded.dictionary)).to_numpy(zero_copy_only=False)
        _, seen, step = np.unique(step, return_index=True, return_inverse=True)
        order = np.argsort(step[used], kind="stable")
        rows, bounds = np.flatnonzero(used)[order], np.searchsorted(step[used][order], np.arange(len(seen) + 1))
        data = [cells[v].combine_chunks().cast(pa.float64()) for v in values]
        data = [(d.is_valid().to_numpy(zero_copy_only=False), d.fill_null(0.0).to_numpy()) for d in data]

        def regridded(k, n, valid, value):
            """Per target: whether a corner is there, and the sum if all are there once with a value."""
            _, weight, first, _, _, corners = parts[k]
            there = np.add.reduceat(n[at[k]], first)
            full = (there == corners) & (np.add.reduceat(valid[at[k]], first) == corners)
            return there > 0, np.where(full, np.add.reduceat(value[at[k]] * weight, first), np.nan)

        def blocks(j, i, there, value):
            """Block means of the targets that are there, skipping the missing."""
            j, i, value = j[there] // factor, i[there] // factor, value[there]
            key = j * (i.max(initial=0) + 1) + i
            _, first, block = np.unique(key, return_index=True, return_inverse=True)
            ok = ~np.isnan(value)
            n = np.bincount(block, ok)
            with np.errstate(all="ignore"):
                return j[first], i[first], np.where(n > 0, np.bincount(block, np.where(ok, value, 0.0)) / n, np.nan)

        out = []
        for s in range(len(seen)):
            own = rows[bounds[s]:bounds[s + 1]]
            n = np.bincount(place[own], minlength=len(known))
            columns, route = [], None
            for valid, value in data:
                ok = valid[own]
                v = np.bincount(place[own], ok, len(known)).astype(np.int64)
                x = np.bincount(place[own], np.where(ok, value[own], 0.0), len(known))
                k = True in parts and bool((n[needed[True]] == 1).all() and (v[needed[True]] == 1).all() and (n[needed[False]] == 1).all() and (v[needed[False]] == 1).all()) if factor else False
                there, got = regridded(k, n, v, x)
                j, i = parts[k][3], parts[k][4]
                if factor and not k:
                    j, i, got = blocks(j, i, there, got)
                else:
                    j, i, got = j[there], i[there], got[there]
                route, columns = (j, i), [*columns, got]
            out.append((np.full(len(route[0]), seen[s]), *route, columns))
        from_row = np.concatenate([o[0] for o in out])
        made = [cells[k].combine_chunks().take(pa.array(from_row)) for k in keys]
        made += [pa.array(np.concatenate([o[c] for o in out]), pa.int32()) for c in (1, 2)]
        made += [pa.array(np.concatenate([o[3][v] for o in out]), pa.float64(), from_pandas=True) for v in range(len(values))]
        return pa.table(dict(zip(names, made, strict=True))).cast(pa.schema(list(zip(names, schema, strict=True))))

    return run


def apply_banded(cells: DataFrame, weights: DataFrame, values: str | list[str], keys: tuple[str, ...], target_rows: int,
                 target_points: int, max_rows: int, composed: DataFrame | None = None, factor: int | None = None,
                 slots: int | None = None, rlat: str = "rlat", rlon: str = "rlon") -> DataFrame:
    """Σ w·v per (keys, target) as ``regrid.apply_weights``, for weights of any size.

    With ``composed`` weights and their block ``factor`` the result is per block.
    ``slots`` is the number of time slots when ``cells`` carry ``SLOT``.
    """
    from pyspark.sql.pandas.types import to_arrow_type

    values = [values] if isinstance(values, str) else list(values)
    keys = [k for k in keys if k in cells.columns and k != SLOT]
    per_row = max(1, math.ceil(target_points / max(target_rows, 1)))
    band = max(1, max_rows // (4 * per_row))
    if factor:
        band = max(factor, band // factor * factor)
    banded = weights.select(F.floor(F.col("rlat") / band).cast("int").alias("_band"), "rlat", "rlon", "sy", "sx", "w", "n_corners", F.lit(False).alias("_whole"))
    if composed is not None:
        banded = banded.unionByName(composed.select(F.floor(F.col("rlat") * factor / band).cast("int").alias("_band"), "rlat", "rlon", "sy", "sx", "w", "n_corners", F.lit(True).alias("_whole")))
    need = banded.groupBy("_band", "sy").agg(F.min("sx").alias("_x0"), F.max("sx").alias("_x1"))
    size = need.agg(F.count(F.lit(1)).alias("rows"), F.sum(F.col("_x1") - F.col("_x0") + 1).alias("cells"), F.count_distinct("_band").alias("bands")).first()
    need = need.withColumnRenamed("sy", rlat)
    if size["rows"] <= max_rows:  # a row per band and source row
        need = F.broadcast(need)
    if SLOT in cells.columns and slots:
        src = cells
    elif keys:
        steps = cells.agg(F.approx_count_distinct(F.struct(*keys))).first()[0]
        slots = max(1, math.ceil(steps * (size["cells"] or 0) / max(size["bands"], 1) / GROUP_CELLS))
        src = cells.withColumn(SLOT, F.pmod(F.xxhash64(*keys), F.lit(slots)).cast("int"))
    else:
        slots, src = 1, cells.withColumn(SLOT, F.lit(0))
    src = src.join(need, rlat).where(F.col(rlon).between(F.col("_x0"), F.col("_x1")))
    src = src.select(F.col("_band").alias("_of_band"), SLOT, *keys, F.col(rlat).alias("sy"), F.col(rlon).alias("sx"), *values)
    spread = banded.withColumn(SLOT, F.explode(F.sequence(F.lit(0), F.lit(slots - 1))))
    schema = T.StructType([*(cells.schema[k] for k in keys), T.StructField("rlat", T.IntegerType()), T.StructField("rlon", T.IntegerType()), *(T.StructField(v, T.DoubleType()) for v in values)])
    run = _work(keys, values, factor, [to_arrow_type(f.dataType) for f in schema])
    return src.groupBy("_of_band", SLOT).cogroup(spread.groupBy("_band", SLOT)).applyInArrow(run, schema)
