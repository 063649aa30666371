"""Property tests with small, bounded example counts."""

import datetime as dt

import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from gridloom.config import Variable
from gridloom.functions import transform_column
from gridloom.operators import aggregate, samples, scale, tensors

SETTINGS = settings(max_examples=8, deadline=None,
                    suppress_health_check=[HealthCheck.function_scoped_fixture])
finite = st.floats(min_value=-1e3, max_value=1e3, allow_nan=False, allow_infinity=False)

ATOMS = ["x", "2.5", "(x * x)", "np.abs(x)", "np.sqrt(np.abs(x))", "np.log1p(np.abs(x))",
         "np.maximum(x, 0)", "np.where(x > 1, x, -x)", "np.clip(x, -2, 2)"]


@st.composite
def expressions(draw):
    a, b = draw(st.sampled_from(ATOMS)), draw(st.sampled_from(ATOMS))
    op = draw(st.sampled_from(["+", "-", "*"]))
    return f"{a} {op} {b}"


@SETTINGS
@given(expr=expressions(), xs=st.lists(finite, min_size=1, max_size=20))
def test_transform_equals_numpy(spark, expr, xs):
    df = spark.createDataFrame([(float(x),) for x in xs], "x double")
    got = [r[0] for r in df.select(transform_column(F.col("x"), [expr]).alias("y")).collect()]
    want = [eval(expr, {"np": np}, {"x": np.float64(x)}) for x in xs]  # test oracle only
    assert np.allclose(got, want, rtol=1e-12, atol=1e-9)


@SETTINGS
@given(xs=st.lists(finite, min_size=2, max_size=40).filter(lambda v: np.std(v) > 1e-6))
def test_standardized_train_has_mean0_std1(spark, xs):
    rows = [(dt.datetime(2003, 1, 1) + dt.timedelta(hours=i), 0, 0, float(x)) for i, x in enumerate(xs)]
    df = spark.createDataFrame(rows, "time timestamp_ntz, rlat int, rlon int, v double")
    out, attrs = scale.split_and_scale(df, Variable("v"), [2001], [2002])
    r = out.where("split = 'train'").agg(F.avg("v"), F.stddev_pop("v")).first()
    assert abs(r[0]) < 1e-9 and r[1] == pytest.approx(1.0, rel=1e-9)
    assert attrs["mean"] == pytest.approx(np.mean(xs)) and attrs["std"] == pytest.approx(np.std(xs))


@SETTINGS
@given(n=st.integers(min_value=1, max_value=60), size=st.integers(min_value=1, max_value=7),
       seed=st.integers(min_value=0, max_value=10**6))
def test_batching_is_a_permutation(spark, n, size, seed):
    keys = spark.createDataFrame([("train", f"k{i:03d}") for i in range(n)], "split string, key string")
    a = samples.assign_batches(keys, size, seed, group=("split",)).collect()
    assert sorted(r.pos for r in a) == list(range(n))
    assert sorted(r.key for r in a) == sorted(f"k{i:03d}" for i in range(n))
    for r in a:
        assert r.batch_id == r.pos // size and r.slot == r.pos % size


@SETTINGS
@given(ny=st.integers(1, 5), nx=st.integers(1, 5), steps=st.integers(1, 3),
       seed=st.integers(0, 1000))
def test_pack_unpack_identity_and_coarsen_mean(spark, ny, nx, steps, seed):
    rng = np.random.default_rng(seed)
    rows = [(dt.datetime(2000, 1, 1) + dt.timedelta(hours=t), y, x, float(rng.normal()))
            for t in range(steps) for y in range(ny) for x in range(nx)]
    df = spark.createDataFrame(rows, "time timestamp_ntz, rlat int, rlon int, v double")
    back = tensors.unpack(tensors.pack(df, "v", ny, nx, element_type="double"), "v")
    assert back.exceptAll(df).count() == 0 and df.exceptAll(back).count() == 0
    f = 2 if ny % 2 == 0 and nx % 2 == 0 else 1
    c = aggregate.coarsen(df, f, "v", shape=aggregate.Shape(ny, nx))
    assert c.count() == steps * (ny // f) * (nx // f)
    assert c.agg(F.avg("v")).first()[0] == pytest.approx(df.agg(F.avg("v")).first()[0])


@SETTINGS
@given(ny=st.integers(2, 7), nx=st.integers(2, 7), x0=st.integers(-9, 9), x1=st.integers(-9, 9),
       y0=st.integers(-9, 9), y1=st.integers(-9, 9), f=st.integers(1, 3))
def test_crop_matches_numpy_slicing(spark, ny, nx, x0, x1, y0, y1, f):
    from gridloom.operators import select
    arr = np.arange(ny * nx, dtype=float).reshape(ny, nx)
    rows = [(dt.datetime(2000, 1, 1), y, x, float(arr[y, x])) for y in range(ny) for x in range(nx)]
    df = spark.createDataFrame(rows, "time timestamp_ntz, rlat int, rlon int, v double")
    want = arr[y0:y1, x0:x1]
    ok_div = (x1 - x0) % f == 0 and (y1 - y0) % f == 0
    if not ok_div or want.shape[0] != want.shape[1]:
        with pytest.raises(AssertionError):
            select.crop_field(df, f, {"first_index": x0, "last_index": x1},
                              {"first_index": y0, "last_index": y1}, shape=select.Shape(ny, nx))
        return
    out = select.crop_field(df, f, {"first_index": x0, "last_index": x1},
                            {"first_index": y0, "last_index": y1}, shape=select.Shape(ny, nx))
    got = np.full(want.shape, np.nan)
    for r in out.collect():
        got[r.rlat, r.rlon] = r.v
    assert np.array_equal(got, want)


def _numpy_bilinear(lats, lons, field, plat, plon):
    """Brute-force planar bilinear on a rectilinear grid; None outside the hull."""
    order_y, order_x = np.argsort(lats), np.argsort(lons)
    ly, lx = np.asarray(lats)[order_y], np.asarray(lons)[order_x]
    if not (ly[0] <= plat <= ly[-1] and lx[0] <= plon <= lx[-1]):
        return None
    k = min(np.searchsorted(ly, plat, side="right") - 1, len(ly) - 2)
    m = min(np.searchsorted(lx, plon, side="right") - 1, len(lx) - 2)
    fy = (plat - ly[k]) / (ly[k + 1] - ly[k])
    fx = (plon - lx[m]) / (lx[m + 1] - lx[m])
    y0, y1, x0, x1 = order_y[k], order_y[k + 1], order_x[m], order_x[m + 1]
    return ((1 - fy) * (1 - fx) * field[y0, x0] + (1 - fy) * fx * field[y0, x1]
            + fy * (1 - fx) * field[y1, x0] + fy * fx * field[y1, x1])


@SETTINGS
@given(seed=st.integers(0, 10_000), ny=st.integers(2, 6), nx=st.integers(2, 6),
       descending=st.booleans())
def test_rectilinear_regrid_matches_numpy(spark, seed, ny, nx, descending):
    from gridloom.operators import regrid
    rng = np.random.default_rng(seed)
    lats = np.cumsum(rng.uniform(0.2, 2.0, ny)) + 40
    lons = np.cumsum(rng.uniform(0.2, 2.0, nx)) + 200
    if descending:
        lats = lats[::-1]
    field = rng.normal(size=(ny, nx))
    grid = spark.createDataFrame([(i, j, float(lats[i]), float(lons[j])) for i in range(ny)
                                  for j in range(nx)], "rlat int, rlon int, lat double, lon double")
    cells = spark.createDataFrame([(dt.datetime(2000, 1, 1), i, j, float(field[i, j]))
                                   for i in range(ny) for j in range(nx)],
                                  "time timestamp_ntz, rlat int, rlon int, v double")
    pts = [(float(a), float(b)) for a, b in zip(rng.uniform(lats.min() - 0.5, lats.max() + 0.5, 25),
                                                 rng.uniform(lons.min() - 0.5, lons.max() + 0.5, 25))]
    tgt = spark.createDataFrame([(0, k, a, b) for k, (a, b) in enumerate(pts)],
                                "rlat int, rlon int, lat double, lon double")
    got = {r.rlon: r.v for r in regrid.interpolate(cells, grid, tgt, "v").collect()}
    for k, (a, b) in enumerate(pts):
        want = _numpy_bilinear(lats, lons, field, a, b)
        if want is None:
            assert k not in got
        else:
            assert got[k] == pytest.approx(want, abs=1e-9)


@SETTINGS
@given(seed=st.integers(0, 10_000), by=st.integers(1, 3), bx=st.integers(1, 3),
       f=st.integers(1, 3), p_missing=st.floats(0.0, 0.9))
def test_coarsen_with_missing_matches_nanmean(spark, seed, by, bx, f, p_missing):
    rng = np.random.default_rng(seed)
    ny, nx = by * f, bx * f
    arr = rng.normal(size=(ny, nx))
    arr[rng.random((ny, nx)) < p_missing] = np.nan
    rows = [(dt.datetime(2000, 1, 1), y, x, None if np.isnan(arr[y, x]) else float(arr[y, x]))
            for y in range(ny) for x in range(nx)]
    df = spark.createDataFrame(rows, "time timestamp_ntz, rlat int, rlon int, v double")
    got = {(r.rlat, r.rlon): r.v for r in
           aggregate.coarsen(df, f, "v", shape=aggregate.Shape(ny, nx)).collect()}
    with np.errstate(all="ignore"):
        import warnings
        with warnings.catch_warnings():
            warnings.simplefilter("ignore")
            want = np.nanmean(arr.reshape(by, f, bx, f), axis=(1, 3))
    for i in range(by):
        for j in range(bx):
            if np.isnan(want[i, j]):
                assert got[(i, j)] is None
            else:
                assert got[(i, j)] == pytest.approx(want[i, j], abs=1e-12)
