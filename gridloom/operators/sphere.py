"""Curvilinear regridding on the sphere (J1d across the date line and the poles).

Latitude and longitude are no plane: a quad over the 0/360 seam is as wide as the
map, and one that holds a pole has no inside.  Here grid points are unit vectors,
a quad is the patch ``A + s·E + t·F + s·t·G`` spanned by its four corners in
space, and a target belongs to the quad whose patch is met by the line from the
centre through it.  Seen along that line the patch is a planar quad with the
target at the origin, so ``s`` and ``t`` come from the same solver as in the
plane, in the target's own east and north coordinates.

Quads and targets meet through tiles on the six faces of a cube.  The projection
from the centre onto a face keeps great circles straight, so on a face the box
around a quad's four corners holds the quad; a quad is listed on every face it
can reach and in every tile its box touches, a target in the one tile it lies in.
A quad too wide to be seen from a face is listed in the whole face.  There is no
cap on candidates; a target on a shared edge goes to the lowest quad.
"""

from __future__ import annotations

import math
from functools import partial, reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import regrid

# Corners seen under a flatter angle from a face's centre are not projected onto it.
FLAT = 0.1
# Angle from a face's centre to its corner.
FACE_RADIUS = math.acos(1 / math.sqrt(3))
# Boxes are widened by this share of a face, so that rounding never puts a target beside its quad's box.
MARGIN = 1e-9
# Targets this near a grid point take its value, also where several points are one (a pole row).
SNAP = 1e-12
TAGS = ("00", "01", "10", "11")


def unit_vector(lat: Column, lon: Column) -> tuple[Column, Column, Column]:
    """The point on the unit sphere at a latitude and longitude in degrees."""
    la, lo = F.radians(lat), F.radians(lon)
    return F.cos(la) * F.cos(lo), F.cos(la) * F.sin(lo), F.sin(la)


def _dot(a: list[Column], b: list[Column]) -> Column:
    return reduce(lambda p, q: p + q, [x * y for x, y in zip(a, b, strict=True)])


def _once(value: Column, body) -> Column:
    """``body`` of a value that is computed once, however often the body uses it."""
    return F.transform(F.array(value), body)[0]


def _axes(point: Column) -> list[Column]:
    return [point[k] for k in range(3)]


def _on_face(point: Column) -> tuple[Column, Column, Column]:
    """A point's height over the plane through the centre along the face of its row, and its projection onto that face."""
    axis, sign = F.floor(F.col("face") / 2).cast("int"), F.lit(1) - 2 * (F.col("face") % 2)
    height = point[axis] * sign
    return height, F.try_divide(point[(axis + 1) % 3], height), F.try_divide(point[(axis + 2) % 3], height)


def _face_boxes(quads: DataFrame) -> DataFrame:
    """A row per quad (corners ``c00`` … ``c11``) and face it can reach, with its box on the face, cut at the face's edge."""
    corners = [F.col(f"c{t}") for t in TAGS]
    quads = quads.withColumn("_sum", F.array(*[reduce(lambda p, q: p + q, [c[k] for c in corners]) for k in range(3)]))
    length = F.sqrt(_dot(_axes(F.col("_sum")), _axes(F.col("_sum"))))
    quads = quads.withColumn("_mid", F.when(length > 1e-9, F.transform("_sum", lambda x: x / length)))
    # the cap around the middle that holds all corners; none if they surround the sphere
    lowest = F.least(*[_dot(_axes(c), _axes(F.col("_mid"))) for c in corners])
    quads = quads.withColumn("_cap", F.when(lowest > 1e-6, F.acos(F.least(lowest, F.lit(1.0)))))
    rows = quads.withColumn("face", F.explode(F.array(*[F.lit(k) for k in range(6)])))
    away = F.acos(F.greatest(F.lit(-1.0), F.least(F.lit(1.0), _on_face(F.col("_mid"))[0])))
    rows = rows.where(F.col("_cap").isNull() | (away <= F.lit(FACE_RADIUS + MARGIN) + F.col("_cap")))
    rows = rows.withColumn("_seen", F.array(*[F.struct(*[c.alias(n) for c, n in zip(_on_face(c), "huv", strict=True)]) for c in corners]))
    flat = F.array_min(F.col("_seen.h")) <= FLAT
    sides = {}
    for k in "uv":
        sides[f"{k}0"] = F.when(flat, F.lit(-1.0)).otherwise(F.greatest(F.array_min(F.col(f"_seen.{k}")) - MARGIN, F.lit(-1.0)))
        sides[f"{k}1"] = F.when(flat, F.lit(1.0)).otherwise(F.least(F.array_max(F.col(f"_seen.{k}")) + MARGIN, F.lit(1.0)))
    rows = rows.withColumns(sides).where((F.col("u0") <= F.col("u1")) & (F.col("v0") <= F.col("v1")))
    return rows.select("qy", "qx", "face", "u0", "u1", "v0", "v1", *corners)


def _own_face(x: Column, y: Column, z: Column) -> Column:
    """The face a point lies on: its largest coordinate, the first of equals."""
    ax, ay, az = F.abs(x), F.abs(y), F.abs(z)
    return (F.when((ax >= ay) & (ax >= az), F.when(x > 0, F.lit(0)).otherwise(F.lit(1)))
            .when(ay >= az, F.when(y > 0, F.lit(2)).otherwise(F.lit(3)))
            .otherwise(F.when(z > 0, F.lit(4)).otherwise(F.lit(5))))


def _tiles(lo: str, hi: str, side: float) -> Column:
    return F.explode(F.sequence(F.floor((F.col(lo) + 1) / side), F.floor((F.col(hi) + 1) / side)))


def spherical_weights(src_grid: DataFrame, tgt_grid: DataFrame, periodic: bool = False,
                      materialize: bool = True) -> DataFrame:
    """Weights ``(rlat, rlon, sy, sx, w, n_corners)`` of a curvilinear source on the sphere.

    ``periodic`` joins the last column of the source to its first one, as on a
    grid that goes around the globe.  Longitudes may have any range on either
    side; a target that no quad holds gets no weights.
    """
    regrid.check_inputs(src_grid, tgt_grid)
    period = None
    if periodic:
        first, last = src_grid.agg(F.min("rlon"), F.max("rlon")).first()
        period = None if first is None else (int(first), int(last) - int(first) + 1)
    points = src_grid.select("rlat", "rlon", *[c.alias(n) for c, n in zip(unit_vector(F.col("lat"), F.col("lon")), "xyz", strict=True)])
    quads = regrid.grid_quads(points, ("x", "y", "z"), period)
    boxed = _face_boxes(quads.select("qy", "qx", *[F.array(*[f"{k}{t}" for k in "xyz"]).alias(f"c{t}") for t in TAGS]))
    size = boxed.agg(F.count(F.lit(1)), F.percentile_approx(F.greatest(F.col("u1") - F.col("u0"), F.col("v1") - F.col("v0")), 0.5)).first()
    tgt = tgt_grid.select("rlat", "rlon", "lat", "lon")
    if not size[0]:
        return regrid._empty_weights(tgt)
    # a tile is as large as the median quad, and there are not many more tiles than quads
    side = max(float(size[1]), 2.0 / math.sqrt(size[0] / 6 + 1), 1e-9)
    binned = boxed.select("*", _tiles("u0", "u1", side).alias("tu")).select("*", _tiles("v0", "v1", side).alias("tv"))

    la, lo = F.radians("lat"), F.radians("lon")
    pts = tgt.withColumns({"east": F.array(-F.sin(lo), F.cos(lo), F.lit(0.0)),
                           "north": F.array(-F.sin(la) * F.cos(lo), -F.sin(la) * F.sin(lo), F.cos(la)),
                           "up": _once(F.struct("lat", "lon"), lambda p: F.array(*unit_vector(p["lat"], p["lon"])))})
    pts = pts.withColumn("face", _own_face(*_axes(F.col("up"))))
    _, pu, pv = _on_face(F.col("up"))
    pts = pts.withColumns({"pu": pu, "pv": pv}).withColumns({"tu": F.floor((F.col("pu") + 1) / side), "tv": F.floor((F.col("pv") + 1) / side)})
    cand = pts.join(binned, ["face", "tu", "tv"]).where(F.col("pu").between(F.col("u0"), F.col("u1")) & F.col("pv").between(F.col("v0"), F.col("v1")))

    # the corners in the target's east and north, with the target at the origin, on its side of the sphere
    flat = {}
    for tag in TAGS:
        flat[f"lon{tag}"] = _dot(_axes(F.col("east")), _axes(F.col(f"c{tag}")))
        flat[f"lat{tag}"] = _dot(_axes(F.col("north")), _axes(F.col(f"c{tag}")))
    ahead = reduce(lambda p, q: p + q, [_dot(_axes(F.col("up")), _axes(F.col(f"c{t}"))) for t in TAGS]) > 0
    cand = cand.where(ahead).select("rlat", "rlon", "qy", "qx", F.lit(0.0).alias("lat"), F.lit(0.0).alias("lon"), *[c.alias(n) for n, c in flat.items()])
    return regrid.solved_weights(cand, period, materialize, partial(regrid._solver, snap=SNAP))
