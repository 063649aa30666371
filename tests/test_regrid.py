import datetime as dt

import numpy as np
import pytest
from pyspark.sql import functions as F

from gridloom.operators import aggregate, regrid
from gridloom.plans import align

T0 = dt.datetime(2000, 1, 1)


def grid_frame(spark, lats, lons):
    return spark.createDataFrame([(i, j, float(a), float(b)) for i, a in enumerate(lats)
                                  for j, b in enumerate(lons)],
                                 "rlat int, rlon int, lat double, lon double")


def affine(lat, lon):
    return 3.0 + 0.5 * lat - 0.25 * lon


def field(spark, lats, lons, fn=affine, steps=2, skip=()):
    rows = [(T0 + dt.timedelta(hours=t), i, j, float(fn(a, b)) + t)
            for t in range(steps) for i, a in enumerate(lats) for j, b in enumerate(lons)
            if (i, j) not in skip]
    return spark.createDataFrame(rows, "time timestamp_ntz, rlat int, rlon int, v double")


def targets(spark, pts):
    return spark.createDataFrame([(k // 10, k % 10, float(a), float(b)) for k, (a, b) in enumerate(pts)],
                                 "rlat int, rlon int, lat double, lon double")


def result(df):
    return {(r.time.hour, r.rlat, r.rlon): r.v for r in df.collect()}


@pytest.mark.parametrize("lats,lons", [
    (np.arange(40, 48, 1.0), np.arange(200, 210, 1.0)),                 # regular
    ([40, 40.5, 42, 45, 45.2, 47], [200, 203, 203.5, 209]),              # uneven
    (np.arange(47, 39, -1.0), np.arange(200, 210, 1.0)),                 # descending lat
])
def test_affine_field_is_exact(spark, lats, lons):
    rng = np.random.default_rng(0)
    pts = list(zip(rng.uniform(min(lats), max(lats), 30), rng.uniform(min(lons), max(lons), 30)))
    pts += [(max(lats), max(lons)), (min(lats), min(lons)), (lats[2], lons[1])]
    out = regrid.interpolate(field(spark, lats, lons), grid_frame(spark, lats, lons),
                             targets(spark, pts), "v")
    got = result(out)
    assert len(got) == 2 * len(pts)
    for k, (a, b) in enumerate(pts):
        for t in range(2):
            assert got[(t, k // 10, k % 10)] == pytest.approx(affine(a, b) + t, abs=1e-9)


def test_outside_hull_is_absent(spark):
    lats, lons = np.arange(40, 44, 1.0), np.arange(200, 204, 1.0)
    pts = [(41.5, 201.5), (44.5, 201.0), (41.0, 199.0)]
    out = regrid.interpolate(field(spark, lats, lons, steps=1), grid_frame(spark, lats, lons),
                             targets(spark, pts), "v")
    assert set(result(out)) == {(0, 0, 0)}


def test_missing_corner_is_null(spark):
    lats, lons = np.arange(40, 44, 1.0), np.arange(200, 204, 1.0)
    src = field(spark, lats, lons, steps=1, skip={(1, 1), (2, 2)})
    src = src.union(spark.createDataFrame([(T0, 2, 2, None)], src.schema))
    pts = [(40.5, 200.5), (42.5, 202.5), (41.0, 201.0), (42.0, 203.0), (40.5, 202.5)]
    got = result(regrid.interpolate(src, grid_frame(spark, lats, lons), targets(spark, pts), "v"))
    assert got[(0, 0, 0)] is None          # corner (1,1) absent
    assert got[(0, 0, 1)] is None          # corner (2,2) NULL
    assert got.get((0, 0, 2)) is None      # lies exactly on the absent point: absent
    assert got[(0, 0, 3)] == pytest.approx(affine(42.0, 203.0))   # on a point, one corner
    assert got[(0, 0, 4)] == pytest.approx(affine(40.5, 202.5))


def test_broadcast_and_banded_paths_agree(spark):
    lats, lons = np.arange(40, 46, 1.0), np.arange(200, 206, 1.0)
    rng = np.random.default_rng(1)
    pts = list(zip(rng.uniform(40, 45, 40), rng.uniform(200, 205, 40)))
    src, sg, tg = field(spark, lats, lons), grid_frame(spark, lats, lons), targets(spark, pts)
    a = regrid.interpolate(src, sg, tg, "v")
    b = regrid.interpolate(src, sg, tg, "v", max_broadcast_rows=40)   # 4 bands of 10 targets
    assert result(a) == pytest.approx(result(b))
    plan = b._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" not in plan and "ShuffledHashJoin" not in plan
    assert "FlatMapCoGroupsInArrow" in plan


def test_banded_align_equals_single(spark):
    lats, lons = np.arange(40, 48, 1.0), np.arange(200, 208, 1.0)
    src, sg = field(spark, lats, lons, fn=lambda a, b: a * 0.3 - b), grid_frame(spark, lats, lons)
    tg = spark.createDataFrame([(j, i, 40.2 + 0.8 * j, 200.3 + 0.8 * i) for j in range(8) for i in range(8)],
                               "rlat int, rlon int, lat double, lon double")
    w = regrid.bilinear_weights(sg, tg)
    one = regrid.apply_weights(src, w, "v")
    many = regrid.apply_weights_tiled(src, w, "v", ("time",), 8, 64, max_rows=40)
    assert result(many) == pytest.approx(result(one))
    assert many.count() == one.count()


def test_no_nested_loop_or_cartesian(spark):
    lats, lons = np.arange(40, 46, 1.0), np.arange(200, 206, 1.0)
    pts = [(41.2, 201.7), (44.9, 200.1)]
    out = regrid.interpolate(field(spark, lats, lons), grid_frame(spark, lats, lons),
                             targets(spark, pts), "v")
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastNestedLoopJoin" not in plan and "CartesianProduct" not in plan


@pytest.mark.parametrize("which", ["ds", "grid", "no_rlon", "ds_lon", "ds_lat", "grid_lon", "grid_lat"])
def test_input_errors(spark, which):
    g = grid_frame(spark, [40.0, 41.0], [200.0, 201.0])
    src, tgt = g, g
    if which == "ds":
        src = "not a dataset"
    elif which == "grid":
        tgt = "not a dataset"
    elif which == "no_rlon":
        tgt = g.drop("rlon")
    elif which == "ds_lon":
        src = g.drop("lon")
    elif which == "ds_lat":
        src = g.drop("lat")
    elif which == "grid_lon":
        tgt = g.drop("lon")
    else:
        tgt = g.drop("lat")
    with pytest.raises(ValueError):
        regrid.bilinear_weights(src, tgt)


def test_regrid_onto_itself_is_identity(spark):
    lats, lons = np.arange(40, 45, 1.0), np.arange(200, 206, 1.0)
    src, g = field(spark, lats, lons, fn=lambda a, b: np.sin(a) * b), grid_frame(spark, lats, lons)
    out = regrid.interpolate(src, g, g, "v")
    assert result(out) == pytest.approx(result(src))


def test_composed_weights_equal_two_steps(spark):
    lats, lons = np.arange(40, 48, 1.0), np.arange(200, 208, 1.0)
    src, sg = field(spark, lats, lons, fn=lambda a, b: np.cos(a) * b), grid_frame(spark, lats, lons)
    tg = spark.createDataFrame([(j, i, 40.2 + 0.8 * j, 200.3 + 0.8 * i) for j in range(8) for i in range(8)],
                               "rlat int, rlon int, lat double, lon double")
    two = align.align_with_lr(src, sg, tg, 2, {"first_index": 0, "last_index": 8},
                              {"first_index": 0, "last_index": 8}, "v", compose=False)
    w = regrid.compose_coarsen(regrid.bilinear_weights(sg, tg), 2)
    one = regrid.apply_weights(src, w, "v")
    auto = align.align_with_lr(src, sg, tg, 2, {"first_index": 0, "last_index": 8},
                               {"first_index": 0, "last_index": 8}, "v")
    assert result(one) == pytest.approx(result(two))
    assert result(auto) == pytest.approx(result(two))


def test_composed_exact_with_targets_outside_hull(spark):
    lats, lons = np.arange(40, 46, 1.0), np.arange(200, 206, 1.0)
    src, sg = field(spark, lats, lons, fn=lambda a, b: np.sin(a) + b), grid_frame(spark, lats, lons)
    # a 4×4 target grid whose top row and right column fall outside the source
    tg = spark.createDataFrame([(j, i, 41.2 + 1.5 * j, 200.4 + 1.6 * i) for j in range(4) for i in range(4)],
                               "rlat int, rlon int, lat double, lon double")
    args = (src, sg, tg, 2, {"first_index": 0, "last_index": 4}, {"first_index": 0, "last_index": 4}, "v")
    two = result(align.align_with_lr(*args, compose=False))
    one = result(align.align_with_lr(*args, compose=True))
    assert one.keys() == two.keys() and one == pytest.approx(two)


def test_composed_guard_falls_back_on_missing(spark):
    lats, lons = np.arange(40, 48, 1.0), np.arange(200, 208, 1.0)
    src = field(spark, lats, lons, fn=lambda a, b: a + b, skip={(3, 3)})
    sg = grid_frame(spark, lats, lons)
    tg = spark.createDataFrame([(j, i, 40.2 + 0.8 * j, 200.3 + 0.8 * i) for j in range(8) for i in range(8)],
                               "rlat int, rlon int, lat double, lon double")
    args = (src, sg, tg, 2, {"first_index": 0, "last_index": 8}, {"first_index": 0, "last_index": 8}, "v")
    with pytest.raises(ValueError):
        align.align_with_lr(*args, compose=True)
    assert result(align.align_with_lr(*args)) == result(align.align_with_lr(*args, compose=False))


def static_plan(spark, df):
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        return df._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_align_plan_single_data_exchange(spark, tmp_path):
    lats, lons = np.arange(40, 48, 1.0), np.arange(200, 208, 1.0)
    path = str(tmp_path / "src")
    field(spark, lats, lons, steps=3).write.parquet(path)
    src = spark.read.parquet(path)
    sg = grid_frame(spark, lats, lons)
    tg = spark.createDataFrame([(j, i, 40.2 + 0.8 * j, 200.3 + 0.8 * i) for j in range(8) for i in range(8)],
                               "rlat int, rlon int, lat double, lon double")
    for compose in (False, "auto"):
        out = align.align_with_lr(src, sg, tg, 2, {"first_index": 0, "last_index": 8},
                                  {"first_index": 0, "last_index": 8}, "v", compose=compose)
        plan = static_plan(spark, out)
        exchanges = [ln for ln in plan.splitlines() if "Exchange " in ln and "Broadcast" not in ln]
        # one exchange by time slot for the cells, without a sampling pass; the weight side is broadcast
        assert len([ln for ln in exchanges if "direct_shuffle_partition_id(_slot" in ln]) == 1, plan
        assert not any("rangepartitioning" in ln or "hashpartitioning(time" in ln or "hashpartitioning(_slot" in ln for ln in exchanges), plan
        assert "BroadcastHashJoin" in plan



def test_coarsen_skips_missing(spark):
    rows = [(T0, y, x, float(y * 4 + x)) for y in range(4) for x in range(4)]
    rows = [r for r in rows if (r[1], r[2]) != (0, 1)]                       # absent
    rows = [(t, y, x, float("nan") if (y, x) == (3, 3) else v) for t, y, x, v in rows]
    rows = [(t, y, x, None if (y, x) in {(0, 2), (0, 3), (1, 2), (1, 3)} else v)
            for t, y, x, v in rows]                                          # all-missing block
    df = spark.createDataFrame(rows, "time timestamp_ntz, rlat int, rlon int, v double")
    df = df.withColumn("v", F.nanvl("v", F.lit(None).cast("double")))
    got = {(r.rlat, r.rlon): r.v for r in aggregate.coarsen(df, 2, "v").collect()}
    assert got[(0, 0)] == pytest.approx((0 + 4 + 5) / 3)
    assert got[(0, 1)] is None
    assert got[(1, 1)] == pytest.approx((10 + 11 + 14) / 3)
    assert got[(1, 0)] == pytest.approx((8 + 9 + 12 + 13) / 4)


def test_coarsen_not_divisible(spark):
    df = field(spark, [1.0, 2.0, 3.0], [1.0, 2.0, 3.0])
    with pytest.raises(ValueError):
        aggregate.coarsen(df, 2, "v", shape=aggregate.Shape(3, 3))


def test_coarsen_keeps_global_mean(spark):
    df = field(spark, np.arange(8.0), np.arange(8.0), fn=lambda a, b: a * b + 1, steps=3)
    c = aggregate.coarsen(df, 4, "v")
    assert c.agg(F.avg("v")).first()[0] == pytest.approx(df.agg(F.avg("v")).first()[0])


def curvi_grid(ny=6, nx=7):
    pts = {}
    for i in range(ny):
        for j in range(nx):
            pts[(i, j)] = (40 + 0.9 * i + 0.1 * j + 0.02 * i * j, 200 + 1.0 * j + 0.15 * i - 0.01 * i * j)
    return pts


def brute_force_quad(pts, lat, lon, ny, nx):
    """Lowest quad (by index) containing the point, by Newton on every quad."""
    for i in range(ny - 1):
        for j in range(nx - 1):
            c = [np.array(pts[(i + a, j + b)][::-1]) for a, b in ((0, 0), (0, 1), (1, 0), (1, 1))]
            s, t = 0.5, 0.5
            for _ in range(50):
                p = (1 - s) * (1 - t) * c[0] + s * (1 - t) * c[1] + (1 - s) * t * c[2] + s * t * c[3]
                ds = -(1 - t) * c[0] + (1 - t) * c[1] - t * c[2] + t * c[3]
                dt_ = -(1 - s) * c[0] - s * c[1] + (1 - s) * c[2] + s * c[3]
                jac = np.column_stack([ds, dt_])
                step = np.linalg.solve(jac, np.array([lon, lat]) - p)
                s, t = s + step[0], t + step[1]
            if -1e-9 <= s <= 1 + 1e-9 and -1e-9 <= t <= 1 + 1e-9:
                return (i, j, s, t)
    return None


def test_curvilinear_matches_brute_force(spark):
    ny, nx = 6, 7
    pts = curvi_grid(ny, nx)
    sg = spark.createDataFrame([(i, j, la, lo) for (i, j), (la, lo) in pts.items()],
                               "rlat int, rlon int, lat double, lon double")
    assert not regrid.is_rectilinear(sg)
    rng = np.random.default_rng(3)
    tpts = list(zip(rng.uniform(39.5, 45.5, 60), rng.uniform(199.5, 207.5, 60)))
    tpts += [pts[(2, 3)], pts[(0, 0)], pts[(ny - 1, nx - 1)]]
    tg = spark.createDataFrame([(k // 10, k % 10, float(a), float(b)) for k, (a, b) in enumerate(tpts)],
                               "rlat int, rlon int, lat double, lon double")
    w = regrid.grid_weights(sg, tg)
    got = {}
    for r in w.collect():
        got.setdefault((r.rlat, r.rlon), {})[(r.sy, r.sx)] = r.w
    for k, (a, b) in enumerate(tpts):
        q = brute_force_quad(pts, a, b, ny, nx)
        key = (k // 10, k % 10)
        if q is None:
            assert key not in got
            continue
        i, j, s, t = q
        want = {(i, j): (1 - s) * (1 - t), (i, j + 1): s * (1 - t), (i + 1, j): (1 - s) * t,
                (i + 1, j + 1): s * t}
        want = {kk: v for kk, v in want.items() if abs(v) > 1e-9}
        have = {kk: v for kk, v in got[key].items() if abs(v) > 1e-9}
        assert set(have) == set(want), (key, have, want)
        for kk in want:
            assert have[kk] == pytest.approx(want[kk], abs=1e-7)
    # affine fields are reproduced exactly
    src = spark.createDataFrame([(T0, i, j, float(affine(la, lo))) for (i, j), (la, lo) in pts.items()],
                                "time timestamp_ntz, rlat int, rlon int, v double")
    out = result(regrid.interpolate(src, sg, tg, "v"))
    for (h, y, x), v in out.items():
        a, b = tpts[y * 10 + x]
        assert v == pytest.approx(affine(a, b), abs=1e-9)


def test_curvilinear_onto_itself(spark):
    pts = curvi_grid(5, 5)
    sg = spark.createDataFrame([(i, j, la, lo) for (i, j), (la, lo) in pts.items()],
                               "rlat int, rlon int, lat double, lon double")
    src = spark.createDataFrame([(T0, i, j, float(i * 10 + j)) for (i, j) in pts],
                                "time timestamp_ntz, rlat int, rlon int, v double")
    out = result(regrid.interpolate(src, sg, sg, "v"))
    assert out == pytest.approx(result(src))


def test_tensor_regrid_matches_cells(spark):
    from gridloom.operators import tensor_regrid, tensors
    lats, lons = np.arange(40, 46, 1.0), np.arange(200, 206, 1.0)
    src = field(spark, lats, lons, fn=lambda a, b: np.cos(a) * b, steps=3, skip={(2, 2)})
    src = src.union(spark.createDataFrame([(T0 + dt.timedelta(hours=h), 2, 2, None if h == 0 else 1.5)
                                           for h in range(3)], src.schema))
    sg = grid_frame(spark, lats, lons)
    pts = [(40.5, 200.5), (42.5, 202.5), (44.9, 204.9), (47.0, 201.0)] + \
        [(40.2 + 0.5 * k, 200.1 + 0.45 * k) for k in range(8)]
    tg = targets(spark, pts)                      # 2 rows of up to 10 points
    cells = regrid.interpolate(src, sg, tg, "v")
    packed = tensors.pack(src, "v", 6, 6, check=False, element_type="double")
    w = regrid.grid_weights(sg, tg)
    out = tensor_regrid.regrid_tensors(packed, w, (6, 6), (2, 10), keys=("time",))
    got = result(tensors.unpack(out, "v"))
    want = result(cells)
    for k, v in got.items():
        if v is None:
            assert want.get(k) is None
        else:
            assert v == pytest.approx(want[k], abs=1e-12)
    assert got[(0, 0, 1)] is None                 # NULL corner at step 0
    assert got[(1, 0, 1)] is not None             # present at step 1
    assert got[(0, 0, 3)] is None                 # outside the hull


def test_tensor_regrid_in_bands_and_small_chunks(spark, monkeypatch):
    """A low bound cuts the targets into bands, a low chunk size the rows into batches: same tensors, no refusal."""
    from gridloom.operators import tensor_regrid
    g = grid_frame(spark, [40.0, 41.0, 42.0], [200.0, 201.0, 203.0])
    t = grid_frame(spark, [39.5, 40.5, 41.0, 41.75], [200.5, 201.0, 202.0])
    w = regrid.grid_weights(g, t)
    rng = np.random.default_rng(0)
    rows = [(T0 + dt.timedelta(hours=i), [None if rng.random() < 0.1 else float(x) for x in rng.normal(size=9)]) for i in range(40)]
    df = spark.createDataFrame(rows, "time timestamp_ntz, tensor array<double>")

    def run(**options):
        out = tensor_regrid.regrid_tensors(df, w, (3, 3), (4, 3), keys=("time",), **options)
        return {r.time: (r.ny, r.nx, list(r.tensor)) for r in out.collect()}

    one = run()
    assert len(one) == 40 and all(len(v[2]) == 12 for v in one.values())
    monkeypatch.setattr(tensor_regrid, "CHUNK_BYTES", 300)
    assert run() == run(max_rows=20) == run(max_rows=1) == one


def test_nearly_equal_axis_values(spark):
    """Float noise in an axis costs nothing and is interpolated like any other interval."""
    src = grid_frame(spark, [40.0, 40.0 + 1e-9, 41.0, 45.0], [200.0, 201.0])
    tgt = grid_frame(spark, [40.0, 40.0 + 5e-10, 40.5, 44.0, 45.0, 45.1], [200.5])
    got = {(r.rlat, r.sy): r.w for r in regrid.grid_weights(src, tgt).where("sx = 0").collect()}
    assert {k[0] for k in got} == {0, 1, 2, 3, 4}
    assert got[(1, 0)] == pytest.approx(0.25, rel=1e-5) and got[(3, 3)] == pytest.approx(0.375) and got[(4, 3)] == pytest.approx(0.5)


def test_no_overlap_is_empty_on_every_path(spark):
    src, tgt = grid_frame(spark, [40.0, 41.0], [200.0, 201.0]), grid_frame(spark, [10.0, 11.0, 12.0], [20.0, 21.0, 22.0])
    cells = spark.createDataFrame([(T0, y, x, 1.0) for y in range(2) for x in range(2)], "time timestamp_ntz, rlat int, rlon int, v double")
    for bound in (regrid.MAX_BROADCAST_ROWS, 8):
        assert regrid.interpolate(cells, src, tgt, "v", max_broadcast_rows=bound).count() == 0


def test_a_copy_does_not_make_up_for_a_gap(spark):
    """One cell twice and another absent in a step: the counts add up, the composed form must not be taken."""
    src = tgt = grid_frame(spark, [40.0, 41.0, 42.0, 43.0], [200.0, 201.0, 202.0, 203.0])
    rows = [(T0, y, x, float(4 * y + x)) for y in range(4) for x in range(4) if (y, x) != (0, 0)] + [(T0, 3, 3, 15.0)]
    cells = spark.createDataFrame(rows, "time timestamp_ntz, rlat int, rlon int, v double")
    args = (cells, src, tgt, 2, {"first_index": 0, "last_index": 4}, {"first_index": 0, "last_index": 4}, "v")
    with pytest.raises(ValueError, match="1 of 1 steps"):
        align.align_with_lr(*args, compose=True)
    assert result(align.align_with_lr(*args)) == result(align.align_with_lr(*args, compose=False))


@pytest.mark.parametrize("compose", [False, "auto"])
def test_align_banded_equals_broadcast(spark, compose):
    lats, lons = np.arange(40, 48, 1.0), np.arange(200, 208, 1.0)
    src, sg = field(spark, lats, lons, fn=lambda a, b: a * b / 100), grid_frame(spark, lats, lons)
    tg = spark.createDataFrame([(j, i, 40.2 + 0.8 * j, 200.3 + 0.8 * i) for j in range(8) for i in range(8)],
                               "rlat int, rlon int, lat double, lon double")
    args = (src, sg, tg, 2, {"first_index": 0, "last_index": 8}, {"first_index": 0, "last_index": 8}, "v")
    one = result(align.align_with_lr(*args, compose=compose))
    banded = align.align_with_lr(*args, compose=compose, max_broadcast_rows=64)
    assert result(banded) == pytest.approx(one)
    plan = banded._jdf.queryExecution().executedPlan().toString()
    # the cells are never joined by shuffling on source positions
    assert "SortMergeJoin [sy" not in plan and "ShuffledHashJoin [sy" not in plan
    assert "FlatMapCoGroupsInArrow" in plan


def test_one_wide_quad_keeps_the_bins_small(spark, monkeypatch):
    """A last column a hundred times wider than the rest: targets still meet few quads each, and weights stay right."""
    lats, lons = [40.0 + i for i in range(12)], [200.0 + i for i in range(12)] + [1400.0]
    src = grid_frame(spark, lats, lons)
    tgt = grid_frame(spark, [40.25 + i for i in range(10)], [200.5 + i for i in range(10)] + [800.0])
    seen = []
    real = regrid._solver

    def counting(names):
        run = real(names)

        def counted(batches):
            for batch in batches:
                from collections import Counter
                most = max(Counter(zip(batch.column("rlat").to_pylist(), batch.column("rlon").to_pylist())).values(), default=0)
                assert most <= 4, most
                yield from run(iter([batch]))
        seen.append(names)
        return counted

    monkeypatch.setattr(regrid, "_solver", counting)
    a = {(r.rlat, r.rlon, r.sy, r.sx): r.w for r in regrid.curvilinear_weights(src, tgt).collect()}
    b = {(r.rlat, r.rlon, r.sy, r.sx): r.w for r in regrid.bilinear_weights(src, tgt).collect()}
    assert seen and a.keys() == b.keys() and all(abs(a[k] - b[k]) < 1e-9 for k in a)


def test_no_session_setting_is_changed():
    import pathlib

    import gridloom
    for f in pathlib.Path(gridloom.__file__).parent.rglob("*.py"):
        assert "conf.set(" not in f.read_text(), f
