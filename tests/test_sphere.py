"""J1d on the sphere: quads over the date line and the poles."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from gridloom.operators import regrid, sphere


def vectors(lat, lon):
    la, lo = np.radians(lat), np.radians(lon)
    return np.stack([np.cos(la) * np.cos(lo), np.cos(la) * np.sin(lo), np.sin(la)], -1)


def tangent_grid(lat, lon, ny, nx, step):
    """Points in the plane that touches the sphere at (lat, lon), seen from the centre: (rlat, rlon, lat, lon)."""
    c = vectors(lat, lon)
    la, lo = np.radians(lat), np.radians(lon)
    east = np.array([-np.sin(lo), np.cos(lo), 0.0])
    north = np.array([-np.sin(la) * np.cos(lo), -np.sin(la) * np.sin(lo), np.cos(la)])
    out = []
    for j in range(ny):
        for i in range(nx):
            p = c + east * (i - (nx - 1) / 2) * step + north * (j - (ny - 1) / 2) * step * 1.1 + 0.01 * north * i
            p /= np.linalg.norm(p)
            out.append((j, i, float(np.degrees(np.arcsin(p[2]))), float(np.degrees(np.arctan2(p[1], p[0])))))
    return out


def frame(spark, points):
    return spark.createDataFrame(points, "rlat int, rlon int, lat double, lon double")


def weights_of(df):
    out = {}
    for r in df.collect():
        out.setdefault((r.rlat, r.rlon), {})[r.sy, r.sx] = (r.w, r.n_corners)
    return out


def patch(corners, s, t):
    a, b, c, d = corners
    return a * (1 - s) * (1 - t) + b * s * (1 - t) + c * (1 - s) * t + d * s * t


def brute(src, tgt, period=None):
    """Every target against every quad by Newton's method on ``patch(s, t) x target = 0``."""
    at = {(j, i): vectors(la, lo) for j, i, la, lo in src}
    wrap = (lambda i: i % period) if period else (lambda i: i)
    named = [(j, i, [(j, i), (j, wrap(i + 1)), (j + 1, i), (j + 1, wrap(i + 1))]) for j, i in sorted(at)]
    quads = [(j, i, [at[k] for k in keys]) for j, i, keys in named if all(k in at for k in keys)]
    found = {}
    for j, i, la, lo in tgt:
        p = vectors(la, lo)
        e = np.array([-np.sin(np.radians(lo)), np.cos(np.radians(lo)), 0.0])
        n = np.cross(p, e)
        for qy, qx, corners in quads:
            if np.dot(sum(corners), p) <= 0:
                continue
            s = t = 0.5
            with np.errstate(all="ignore"):
                for _ in range(60):
                    f = patch(corners, s, t)
                    ds = (corners[1] - corners[0]) * (1 - t) + (corners[3] - corners[2]) * t
                    dt = (corners[2] - corners[0]) * (1 - s) + (corners[3] - corners[1]) * s
                    m = np.array([[ds @ e, dt @ e], [ds @ n, dt @ n]])
                    if abs(np.linalg.det(m)) < 1e-300:
                        break
                    step = np.linalg.solve(m, [-(f @ e), -(f @ n)])
                    s, t = s + step[0], t + step[1]
            f = patch(corners, s, t)
            if abs(f @ e) + abs(f @ n) < 1e-10 and f @ p > 0 and -1e-9 <= s <= 1 + 1e-9 and -1e-9 <= t <= 1 + 1e-9:
                found[j, i] = {(qy, qx): (1 - s) * (1 - t), (qy, wrap(qx + 1)): s * (1 - t), (qy + 1, qx): (1 - s) * t, (qy + 1, wrap(qx + 1)): s * t}
                break
    return found


def scattered(seed, n, lat=(-90, 90), lon=(-180, 360)):
    rng = np.random.default_rng(seed)
    return [(k, 0, float(a), float(b)) for k, (a, b) in enumerate(zip(rng.uniform(*lat, n), rng.uniform(*lon, n)))]


def same(got, want):
    assert got.keys() == want.keys() and got
    for k, w in want.items():
        for c, x in w.items():
            assert got[k].get(c, (0.0, 0))[0] == pytest.approx(x, abs=1e-7)


@pytest.mark.parametrize("lat, lon, step", [(85.0, 3.0, 0.06), (-88.0, 181.0, 0.05), (10.0, 359.5, 0.04), (35.0, 45.0, 0.09)])
def test_quads_over_pole_seam_and_cube_edges_equal_brute_force(spark, lat, lon, step):
    src = tangent_grid(lat, lon, 7, 6, step)
    tgt = scattered(3, 400, (max(-90, lat - 20), min(90, lat + 20)), (lon - 30, lon + 30) if abs(lat) < 60 else (-180, 360)) + [(1000, 1, 90.0 if lat > 0 else -90.0, 77.0)]
    got = weights_of(sphere.spherical_weights(frame(spark, src), frame(spark, tgt)))
    same(got, brute(src, tgt))
    assert ((1000, 1) in got) == (abs(lat) > 80)


def test_planar_quads_miss_what_the_sphere_holds(spark):
    src = tangent_grid(86.0, 0.0, 5, 5, 0.05)
    tgt = [(0, 0, 89.9, 200.0), (1, 0, 86.0, 359.0)]
    assert set(weights_of(sphere.spherical_weights(frame(spark, src), frame(spark, tgt)))) == {(0, 0), (1, 0)}
    planar = weights_of(regrid.curvilinear_weights(frame(spark, src), frame(spark, [(j, i, la, lo if lo < 180 else lo - 360) for j, i, la, lo in tgt])))
    assert set(planar) != {(0, 0), (1, 0)} or any(abs(a[0] - b) > 1e-3 for k, w in brute(src, tgt).items() for c, b in w.items() for a in [planar[k].get(c, (0.0,))])


def test_periodic_globe_covers_every_target_and_keeps_directions(spark):
    src = [(j, i, -90.0 + 22.5 * j, -180.0 + 30.0 * i) for j in range(9) for i in range(12)]
    tgt = scattered(5, 600) + [(2000, 1, 90.0, 10.0), (2001, 1, -90.0, 0.0), (2002, 1, 0.0, 179.999), (2003, 1, 45.0, 360.0)]
    got = weights_of(sphere.spherical_weights(frame(spark, src), frame(spark, tgt), periodic=True))
    assert len(got) == len(tgt)
    at = {(j, i): vectors(la, lo) for j, i, la, lo in src}
    for j, i, la, lo in tgt:
        w = got[j, i]
        assert sum(x for x, _ in w.values()) == pytest.approx(1.0) and all(n == len(w) for _, n in w.values())
        mixed = sum(at[c] * x for c, (x, _) in w.items())
        assert np.allclose(mixed / np.linalg.norm(mixed), vectors(la, lo), atol=1e-7)
    open_ends = weights_of(sphere.spherical_weights(frame(spark, src), frame(spark, tgt)))
    assert set(open_ends) < set(got)


def test_very_wide_quads_are_found_from_every_face(spark):
    src = [(j, i, (-80.0, 5.0, 80.0)[j], 120.0 * i) for j in range(3) for i in range(3)]
    tgt = scattered(7, 300, (-45, 45))
    got = weights_of(sphere.spherical_weights(frame(spark, src), frame(spark, tgt), periodic=True))
    same(got, brute(src, tgt, 3))


def test_longitude_ranges_do_not_matter_and_empty_grids(spark):
    src, tgt = tangent_grid(70.0, 180.0, 5, 5, 0.05), scattered(2, 100, (60, 80), (165, 195))
    a = weights_of(sphere.spherical_weights(frame(spark, src), frame(spark, tgt)))
    b = weights_of(sphere.spherical_weights(frame(spark, [(j, i, la, lo % 360) for j, i, la, lo in src]), frame(spark, [(j, i, la, lo - 360) for j, i, la, lo in tgt])))
    assert a.keys() == b.keys() and all(b[k][c][0] == pytest.approx(x) for k, w in a.items() for c, (x, _) in w.items())
    assert sphere.spherical_weights(frame(spark, src[:1]), frame(spark, tgt)).count() == 0
    assert sphere.spherical_weights(frame(spark, src), frame(spark, [])).count() == 0


def test_candidates_are_joined_by_tile(spark):
    src = frame(spark, tangent_grid(80.0, 0.0, 30, 30, 0.01))
    plan = sphere.spherical_weights(src, frame(spark, scattered(1, 50)), materialize=False)._jdf.queryExecution().optimizedPlan().toString()
    assert "face" in plan and "Cartesian" not in plan
    cells = src.select(F.lit("2000-01-01").cast("timestamp_ntz").alias("time"), "rlat", "rlon", F.col("lat").alias("v"))
    out = regrid.interpolate(cells, src, frame(spark, [(0, 0, 80.0, 0.05), (0, 1, -80.0, 0.0)]), "v", method="spherical").collect()
    assert [(r.rlat, r.rlon) for r in out] == [(0, 0)] and out[0].v == pytest.approx(80.0, abs=0.05)
