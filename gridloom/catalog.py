"""Registered queries: one per operator family, each with a DuckDB oracle.

Every query reads the driver's tables through the derived fields of
``sources.fixtures`` (G = dense 8×8 field from ``embeddings``, M = sparse
monthly 16×16 field from ``lineitem``, L = daily forecast leads from
``events``), so its work grows with the scale factor.  Double outputs are
rounded to 6 places on both sides because parallel sums are not associative.
"""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

from .config import Variable
from .functions import scalars
from .functions.expr import transform_column
from .operators import aggregate, names, regrid, samples, scale, select, tensor_regrid, tensors
from .operators.select import Shape
from .plans import align, cuts
from .session import ensure_checkpoint_dir
from .sources import fixtures
from .sources.grids import load_grid

Query = Callable[[SparkSession, str], DataFrame]

# Fixed query parameters.
# Days cut off at either end of the data's own time range, so that the window grows with the data.
TRIM_DAYS = 31
TEST_YEARS = [2001]
VALIDATION_YEARS = [2004]
SEED = 0
BATCH_SIZE = 4
G_SHAPE = Shape(8, 8)
M_SHAPE = Shape(16, 16)
T_SHAPE = Shape(fixtures.TARGET_SIDE, fixtures.TARGET_SIDE)


# Fixed value: rounding boundary at 6 places, moved off the decimal midpoint.
ROUND_OFFSET = 0.500123457


def round6(c: Column) -> Column:
    """Round at 6 places with plain IEEE arithmetic and a tie-free boundary.

    Averages of exact inputs often land on a decimal midpoint (27.1703125);
    two engines summing in different orders then end one ulp apart on either
    side of it.  The boundary ``k + 0.500123457`` cannot be hit by terminating
    decimals or binary fractions, so equal results round equally.
    """
    return F.floor(c * F.lit(1e6) + F.lit(ROUND_OFFSET)) / F.lit(1e6)


def r6(c: str | Column, name: str | None = None) -> Column:
    col = F.col(c) if isinstance(c, str) else c
    return round6(col).alias(name or (c if isinstance(c, str) else "v"))


def rounded(df: DataFrame) -> DataFrame:
    """Round every double column to 6 places (comparison only)."""
    return df.select(*[round6(F.col(f.name)).alias(f.name) if isinstance(f.dataType, DoubleType)
                       else F.col(f.name) for f in df.schema.fields])


def _sql_round6(sql: str) -> str:
    """Rewrite ``round(expr, 6)`` in oracle SQL into the same floor form as ``round6``."""
    out, i, key = [], 0, "round("
    while True:
        j = sql.find(key, i)
        if j < 0:
            out.append(sql[i:])
            return "".join(out)
        out.append(sql[i:j])
        depth, k = 1, j + len(key)
        while depth:
            depth += {"(": 1, ")": -1}.get(sql[k], 0)
            k += 1
        inner = sql[j + len(key):k - 1]
        expr, _, places = inner.rpartition(",")
        assert places.strip() == "6", inner
        out.append(f"(floor(({_sql_round6(expr)}) * 1000000.0 + {ROUND_OFFSET!r}) / 1000000.0)")
        i = k


def work_folder(spark: SparkSession, name: str) -> str:
    """A folder of its own in the shared checkpoint folder, for queries that write and read back."""
    return f"{ensure_checkpoint_dir(spark)}/{name}-{uuid.uuid4().hex}"


def dense(spark: SparkSession, sf: str) -> DataFrame:
    return fixtures.dense_field(spark, sf)


def inner_window(field: DataFrame) -> tuple[tuple, tuple]:
    """The field's time bounds without TRIM_DAYS at either end, and the bounds themselves."""
    lo, hi = select.time_bounds(field)
    return (lo + dt.timedelta(days=TRIM_DAYS), hi - dt.timedelta(days=TRIM_DAYS)), (lo, hi)


INNER_SQL = f"""(select min(time) + to_days({TRIM_DAYS}) from g) and (select max(time) - to_days({TRIM_DAYS}) from g)"""


# --------------------------------------------------------------------------
# SQL building blocks for the oracle (DuckDB dialect)
# --------------------------------------------------------------------------
G_SQL = """g as materialized (
  select timestamp '2000-01-01' + to_days(cast(vec_id*4 as int)) as time,
         cast((i-1)//8 as int) as rlat, cast((i-1)%8 as int) as rlon,
         cast(embedding[i] as double) as v
  from embeddings, range(1, 65) r(i))"""

G_GRID_SQL = """gg as (
  select distinct rlat, rlon, 46.0::double + cast(rlat as double) as lat,
         230.0::double + cast(rlon as double) as lon from g)"""

M_SQL = """m as (
  select cast(date_trunc('month', l_shipdate) as timestamp) as time,
         cast(l_orderkey % 16 as int) as rlat, cast(l_partkey % 16 as int) as rlon,
         avg(l_quantity) as v
  from lineitem group by all)"""

L_SQL = """l as (
  select cast(date_trunc('day', ts) as timestamp) as time,
         cast(event_id % 12 as int) + 1 as level,
         cast(user_id % 4 as int) as rlat, cast((user_id // 4) % 4 as int) as rlon,
         sum(value) as v
  from events group by all)"""


def T_SQL(shift: float = 0.0, side: int = 12) -> str:
    return f"""t as (
  select cast(j as int) as rlat, cast(i as int) as rlon,
         {46.0 + shift!r}::double + 0.45::double * j + 0.05::double * i as lat,
         230.0::double + 0.45::double * i + 0.05::double * j as lon
  from range({side}) a(j), range({side}) b(i))"""


# Bilinear weights of T on G's regular 1-degree grid, written out by hand.
W_SQL = """b as (
  select rlat, rlon, lat, lon,
         least(cast(floor(lat - 46.0) as int), 6) as y0,
         least(cast(floor(lon - 230.0) as int), 6) as x0
  from t where lat >= 46.0 and lat <= 53.0 and lon >= 230.0 and lon <= 237.0),
f as (
  select rlat, rlon, y0, x0,
         (lat - (46.0 + y0)) / ((46.0 + (y0 + 1)) - (46.0 + y0)) as fy,
         (lon - (230.0 + x0)) / ((230.0 + (x0 + 1)) - (230.0 + x0)) as fx
  from b),
c4 as (
  select rlat, rlon, y0 as sy, x0 as sx, (1.0 - fy) * (1.0 - fx) as w from f
  union all select rlat, rlon, y0, x0 + 1, (1.0 - fy) * fx from f
  union all select rlat, rlon, y0 + 1, x0, fy * (1.0 - fx) from f
  union all select rlat, rlon, y0 + 1, x0 + 1, fy * fx from f),
w as (
  select rlat, rlon, sy, sx, w, cast(count(*) over (partition by rlat, rlon) as int) as n_corners
  from c4 where w <> 0)"""


def with_(*ctes: str) -> str:
    return "with " + ",\n".join(ctes) + "\n"


# --------------------------------------------------------------------------
# Queries
# --------------------------------------------------------------------------
def q_lr_min_slice(spark: SparkSession, sf: str) -> DataFrame:
    """Flagship: slice → coarsen ×4 → ``x * 100`` → year split → standardize (train)."""
    g = dense(spark, sf)
    (start, end), bounds = inner_window(g)
    s = select.slice_time(g, start, end, bounds=bounds)
    c = aggregate.coarsen(s, 4, "v", shape=G_SHAPE)
    var = Variable("v", transform=["x * 100"], apply_standardize=True)
    out, _ = scale.split_and_scale(c, var, TEST_YEARS, VALIDATION_YEARS)
    return out.select("split", "time", "rlat", "rlon", r6("v"))


SQL_LR_MIN_SLICE = with_(
    G_SQL,
    f"""s as (select * from g where time between {INNER_SQL})""",
    """c as (select time, cast(rlat // 4 as int) as rlat, cast(rlon // 4 as int) as rlon,
                 avg(v) * 100.0 as v from s group by all)""",
    """sp as (
  select 'train' as split, * from c where year(time) not in (2001, 2004)
  union all select 'test', * from c where year(time) in (2001)
  union all select 'validation', * from c where year(time) in (2004))""",
    """st as (select avg(v) as mu, stddev_pop(v) as sd from sp where split = 'train')""",
) + "select split, time, rlat, rlon, round((v - mu) / sd, 6) as v from sp, st"


def q_slice_time(spark: SparkSession, sf: str) -> DataFrame:
    g = dense(spark, sf)
    return select.slice_time(g, "20010301T00:00:00", "2004-07-15").select(
        "time", "rlat", "rlon", r6("v"))


SQL_SLICE_TIME = with_(G_SQL) + """select time, rlat, rlon, round(v, 6) as v from g
where time between timestamp '2001-03-01' and timestamp '2004-07-15'"""


def q_year_split(spark: SparkSession, sf: str) -> DataFrame:
    g = dense(spark, sf)
    return select.with_split(g, TEST_YEARS, VALIDATION_YEARS).select(
        "split", "time", "rlat", "rlon", r6("v"))


SQL_YEAR_SPLIT = with_(G_SQL) + """
select 'train' as split, time, rlat, rlon, round(v, 6) as v from g where year(time) not in (2001, 2004)
union all select 'test', time, rlat, rlon, round(v, 6) from g where year(time) in (2001)
union all select 'validation', time, rlat, rlon, round(v, 6) from g where year(time) in (2004)"""


def q_year_split_overlap(spark: SparkSession, sf: str) -> DataFrame:
    g = dense(spark, sf)
    parts = select.train_test_split(g, [2001, 2002], [2002])
    counts = [df.groupBy(F.year("time").cast("int").alias("year"))
              .agg(F.count(F.lit(1)).alias("n_cells"), r6(F.sum("v"), "sum_v"))
              .select(F.lit(name).alias("split"), "*") for name, df in parts.items()]
    out = counts[0]
    for c in counts[1:]:
        out = out.unionByName(c)
    return out


SQL_YEAR_SPLIT_OVERLAP = with_(G_SQL, """y as (
  select 'train' as split, * from g where year(time) not in (2001, 2002, 2002)
  union all select 'test', * from g where year(time) in (2001, 2002)
  union all select 'validation', * from g where year(time) in (2002))""") + """
select split, cast(year(time) as int) as year, count(*) as n_cells, round(sum(v), 6) as sum_v
from y group by all"""


def q_crop(spark: SparkSession, sf: str) -> DataFrame:
    g = dense(spark, sf)
    out = select.crop_field(g, 2, {"first_index": 2, "last_index": 6},
                            {"first_index": 1, "last_index": 5}, shape=G_SHAPE)
    return out.select("time", "rlat", "rlon", r6("v"))


SQL_CROP = with_(G_SQL) + """select time, cast(rlat - 1 as int) as rlat, cast(rlon - 2 as int) as rlon,
round(v, 6) as v from g where rlon >= 2 and rlon < 6 and rlat >= 1 and rlat < 5"""


def q_box_select(spark: SparkSession, sf: str) -> DataFrame:
    g = dense(spark, sf)
    grid = fixtures.dense_grid(spark, sf)
    cells, sub = select.box_select(g, grid, 231.5, 235.0, 47.0, 50.2)
    out = cells.join(F.broadcast(sub), ["rlat", "rlon"])
    return out.select("time", "rlat", "rlon", "lat", "lon", r6("v"))


SQL_BOX_SELECT = with_(G_SQL, G_GRID_SQL, """bx as (
  select min(rlat) y0, max(rlat) y1, min(rlon) x0, max(rlon) x1 from gg
  where lon between 231.5 and 235.0 and lat between 47.0 and 50.2)""") + """
select g.time, cast(g.rlat - y0 as int) as rlat, cast(g.rlon - x0 as int) as rlon,
       gg.lat, gg.lon, round(g.v, 6) as v
from g join gg using (rlat, rlon), bx
where g.rlat between y0 and y1 and g.rlon between x0 and x1"""


def q_date_select(spark: SparkSession, sf: str) -> DataFrame:
    lf = fixtures.lead_field(spark, sf)
    return select.date_select(lf, "20240105", "20240111").select(
        "time", "level", "rlat", "rlon", r6("v"))


SQL_DATE_SELECT = with_(L_SQL) + """select time, level, rlat, rlon, round(v, 6) as v from l
where time >= timestamp '2024-01-05' and time < timestamp '2024-01-12'"""


def q_rename(spark: SparkSession, sf: str) -> DataFrame:
    raw = dense(spark, sf).select(F.col("time").alias("Time"),
                                  F.col("rlat").alias("rotated_latitude"),
                                  F.col("rlon").alias("rotated_longitude"),
                                  F.col("v").alias("T2"))
    from .config import default_coords, default_dims
    var = Variable("tas", ["T2", "surface temperature"])
    out = names.configure_metadata(raw, var, default_dims(), default_coords())
    return out.select("time", "rlat", "rlon", r6("tas"))


SQL_RENAME = with_(G_SQL) + "select time, rlat, rlon, round(v, 6) as tas from g"


def q_squeeze(spark: SparkSession, sf: str) -> DataFrame:
    """Unfolded leads carry a constant level (set to 0) that the squeeze drops."""
    lf = fixtures.lead_field(spark, sf)
    unfolded = cuts.unfold_leads(lf)
    from .config import default_coords, default_dims
    out = names.squeeze_extra_dims(unfolded, ["time", "level", "rlat", "rlon"],
                                   default_dims(), default_coords(), "v")
    return out.select(*[c for c in out.columns if c != "v"], r6("v"))


SQL_SQUEEZE = with_(L_SQL) + """select time + to_hours(level - 1) as time, rlat, rlon,
round(v, 6) as v from l"""


def q_lon_360(spark: SparkSession, sf: str) -> DataFrame:
    grid = fixtures.grid_of_cells(spark, sf, west_negative=True)
    return names.match_longitudes(grid).select("rlat", "rlon", "lat", "lon")


SQL_LON_360 = with_(G_SQL) + """select distinct rlat, rlon, 46.0::double + cast(rlat as double) as lat,
(-130.0::double + cast(rlon as double)) + 360 as lon from g"""


def q_coarsen(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(aggregate.coarsen(dense(spark, sf), 4, "v", shape=G_SHAPE))


SQL_COARSEN = with_(G_SQL) + """select time, cast(rlat // 4 as int) as rlat,
cast(rlon // 4 as int) as rlon, round(avg(v), 6) as v from g group by all"""


def q_coarsen_sparse(spark: SparkSession, sf: str) -> DataFrame:
    m = fixtures.monthly_field(spark, sf)
    return rounded(aggregate.coarsen(m, 4, "v", shape=M_SHAPE))


SQL_COARSEN_SPARSE = with_(M_SQL) + """select time, cast(rlat // 4 as int) as rlat,
cast(rlon // 4 as int) as rlon, round(avg(v), 6) as v from m group by all"""


def q_field_stats(spark: SparkSession, sf: str) -> DataFrame:
    g = dense(spark, sf)
    train = select.train_test_split(g, TEST_YEARS, VALIDATION_YEARS)["train"]
    return rounded(aggregate.stats_frame(train, "v"))


SQL_FIELD_STATS = with_(G_SQL) + """select round(avg(v), 6) as mean, round(stddev_pop(v), 6) as std,
round(min(v), 6) as min, round(max(v), 6) as max, count(v) as count
from g where year(time) not in (2001, 2004)"""


TRANSFORM = "np.log1p(np.abs(x)) * 2 - x ** 2 / 3 + np.where(x > 0, 1, 0)"


def q_transform_expr(spark: SparkSession, sf: str) -> DataFrame:
    g = dense(spark, sf)
    return g.select("time", "rlat", "rlon", r6(transform_column(F.col("v"), [TRANSFORM]), "v"))


SQL_TRANSFORM_EXPR = with_(G_SQL) + """select time, rlat, rlon,
round(ln(1 + abs(v)) * 2 - pow(v, 2) / 3 + case when v > 0 then 1.0 else 0.0 end, 6) as v from g"""


def _split_scaled(spark: SparkSession, frame: DataFrame, name: str, standardize: bool,
                  normalize: bool, transform=None) -> DataFrame:
    var = Variable(name, transform=transform, apply_standardize=standardize,
                   apply_normalize=normalize)
    out, _ = scale.split_and_scale(frame, var, TEST_YEARS, VALIDATION_YEARS, value="v")
    return out.select("split", "time", "rlat", "rlon", r6("v"))


def q_standardize(spark: SparkSession, sf: str) -> DataFrame:
    return _split_scaled(spark, dense(spark, sf), "tas", True, False)


SPLIT_SQL = """sp as (
  select 'train' as split, * from {src} where year(time) not in (2001, 2004)
  union all select 'test', * from {src} where year(time) in (2001)
  union all select 'validation', * from {src} where year(time) in (2004))"""

TRAIN_STATS_SQL = """st as (select avg(v) as mu, stddev_pop(v) as sd, min(v) as lo, max(v) as hi
  from {src} where year(time) not in (2001, 2004))"""

SQL_STANDARDIZE = with_(G_SQL, SPLIT_SQL.format(src="g"), TRAIN_STATS_SQL.format(src="g")) + \
    "select split, time, rlat, rlon, round((v - mu) / sd, 6) as v from sp, st"


def q_minmax(spark: SparkSession, sf: str) -> DataFrame:
    return _split_scaled(spark, fixtures.monthly_field(spark, sf), "qty", False, True)


SQL_MINMAX = with_(M_SQL, SPLIT_SQL.format(src="m"), TRAIN_STATS_SQL.format(src="m")) + \
    "select split, time, rlat, rlon, round((v - lo) / (hi - lo), 6) as v from sp, st"


def q_log_precip_train(spark: SparkSession, sf: str) -> DataFrame:
    """Precipitation log scale over the whole unfolded lead field (every lead at its valid time)."""
    pr = cuts.unfold_leads(fixtures.lead_field(spark, sf)).drop("level")
    var = Variable("pr", apply_standardize=False, apply_normalize=True)
    out, _ = scale.split_and_scale(pr, var, [2001], [2002], value="v")
    return out.select("split", "time", "rlat", "rlon", r6("v"))


SQL_LOG_PRECIP_TRAIN = with_(L_SQL, """p as (select time + to_hours(level - 1) as time, rlat, rlon, v
  from l)""", """st as (select max(v) as hi from p)""") + \
    """select 'train' as split, time, rlat, rlon,
round((ln(v + 0.001) - ln(0.001)) / (ln(hi + 0.001) - ln(0.001)), 6) as v from p, st"""


def q_standardize_then_minmax(spark: SparkSession, sf: str) -> DataFrame:
    return _split_scaled(spark, dense(spark, sf), "tas", True, True, transform="x + 5")


SQL_STANDARDIZE_THEN_MINMAX = with_(
    G_SQL, """g5 as (select time, rlat, rlon, v + 5.0 as v from g)""",
    SPLIT_SQL.format(src="g5"), TRAIN_STATS_SQL.format(src="g5")) + """select split, time, rlat, rlon,
round(((v - mu) / sd - (lo - mu) / sd) / ((hi - mu) / sd - (lo - mu) / sd), 6) as v from sp, st"""


def q_regrid_weights(spark: SparkSession, sf: str) -> DataFrame:
    w = regrid.bilinear_weights(fixtures.grid_of_cells(spark, sf), fixtures.curvilinear_target(spark))
    return rounded(w)


SQL_REGRID_WEIGHTS = with_(G_SQL, T_SQL(), W_SQL) + \
    "select rlat, rlon, sy, sx, round(w, 6) as w, n_corners from w"


def q_regrid_bilinear(spark: SparkSession, sf: str) -> DataFrame:
    g = dense(spark, sf)
    out = regrid.interpolate(g, fixtures.dense_grid(spark, sf), fixtures.curvilinear_target(spark), "v",
                             tgt_points=T_SHAPE.ny * T_SHAPE.nx)
    return rounded(out)


APPLY_SQL = """select g.time, w.rlat, w.rlon,
round(case when count(g.v) = max(w.n_corners) then sum(g.v * w.w) end, 6) as v
from g join w on g.rlat = w.sy and g.rlon = w.sx group by all"""

SQL_REGRID_BILINEAR = with_(G_SQL, T_SQL(), W_SQL) + APPLY_SQL


def q_regrid_tensor(spark: SparkSession, sf: str) -> DataFrame:
    """Tensor-form regrid: one sparse product per step inside ``mapInArrow`` (no shuffle)."""
    s = samples.samples(dense(spark, sf), "v", G_SHAPE.ny, G_SHAPE.nx)
    w = regrid.grid_weights(fixtures.dense_grid(spark, sf), fixtures.curvilinear_target(spark))
    out = tensor_regrid.regrid_tensors(s, w, (G_SHAPE.ny, G_SHAPE.nx), (T_SHAPE.ny, T_SHAPE.nx))
    return rounded(tensors.unpack(out, "v", keys=("time",)))


def q_regrid_outside(spark: SparkSession, sf: str) -> DataFrame:
    """Targets shifted 3 degrees north: those outside the source hull are missing."""
    g = dense(spark, sf)
    out = regrid.interpolate(g, fixtures.dense_grid(spark, sf),
                             fixtures.curvilinear_target(spark, lat_shift=3.0), "v",
                             tgt_points=T_SHAPE.ny * T_SHAPE.nx)
    return rounded(out)


SQL_REGRID_OUTSIDE = with_(G_SQL, T_SQL(3.0), W_SQL) + APPLY_SQL


def q_regrid_curvilinear(spark: SparkSession, sf: str) -> DataFrame:
    """The whole sparse monthly field laid on a 16×16 curvilinear grid, regridded onto G's
    regular points (J1d)."""
    m = fixtures.monthly_field(spark, sf)
    src = fixtures.curvilinear_target(spark, side=fixtures.MONTHLY_SIDE)
    out = regrid.interpolate(m, src, fixtures.dense_grid(spark, sf),
                             "v", method="curvilinear", tgt_points=G_SHAPE.ny * G_SHAPE.nx)
    return rounded(out)


# Targets within quads, from the corners and the target of each pair: inverse bilinear coordinates, lowest quad, weights.
SOLVE_SQL = (
    """c as (select *, gx * fy - gy * fx as k2, (ex * fy - ey * fx) + (hx * gy - hy * gx) as k1,
  hx * ey - hy * ex as k0 from k)""",
    """d as (select *, sqrt(greatest(k1 * k1 - 4.0 * k0 * k2, 0.0)) as disc from c)""",
    """e as (select *, -0.5 * (k1 + (case when k1 >= 0 then 1.0 else -1.0 end) * disc) as qq from d)""",
    """f as (select *, case when qq = 0 then null else k0 / qq end as t_near,
  case when k2 = 0 then null else qq / k2 end as t_far from e)""",
    """g2 as (select *, case when t_near between -1e-9 and 1 + 1e-9 then t_near else t_far end as tt
  from f)""",
    """h as (select *, ex + gx * tt as ddx, ey + gy * tt as ddy from g2)""",
    """st as (select rlat, rlon, qy, qx, tt,
  case when abs(ddx) >= abs(ddy) then (case when ddx = 0 then null else (hx - fx * tt) / ddx end)
       else (case when ddy = 0 then null else (hy - fy * tt) / ddy end) end as ss from h)""",
    """best as (select * from (
  select *, row_number() over (partition by rlat, rlon order by qy, qx) as rn from st
  where ss between -1e-9 and 1 + 1e-9 and tt between -1e-9 and 1 + 1e-9) where rn = 1)""",
    """cl as (select rlat, rlon, qy, qx, least(greatest(ss, 0.0), 1.0) as s,
  least(greatest(tt, 0.0), 1.0) as t from best)""",
    """c4 as (
  select rlat, rlon, qy as sy, qx as sx, (1.0 - s) * (1.0 - t) as w from cl
  union all select rlat, rlon, qy, qx + 1, s * (1.0 - t) from cl
  union all select rlat, rlon, qy + 1, qx, (1.0 - s) * t from cl
  union all select rlat, rlon, qy + 1, qx + 1, s * t from cl)""",
    """w as (select rlat, rlon, sy, sx, w, count(*) over (partition by rlat, rlon) as n_corners
  from c4 where w <> 0)""")


# Brute force: every target point is tested against every quad of T.
SQL_REGRID_CURVILINEAR = with_(M_SQL, T_SQL(side=16), G_SQL, G_GRID_SQL, """q as (
  select a.rlat as qy, a.rlon as qx, a.lat as lat00, a.lon as lon00, b.lat as lat01, b.lon as lon01,
         c.lat as lat10, c.lon as lon10, d.lat as lat11, d.lon as lon11
  from t a join t b on b.rlat = a.rlat and b.rlon = a.rlon + 1
           join t c on c.rlat = a.rlat + 1 and c.rlon = a.rlon
           join t d on d.rlat = a.rlat + 1 and d.rlon = a.rlon + 1)""", """k as (
  select gg.rlat, gg.rlon, q.qy, q.qx,
         gg.lon - lon00 as hx, gg.lat - lat00 as hy, lon01 - lon00 as ex, lat01 - lat00 as ey,
         lon10 - lon00 as fx, lat10 - lat00 as fy,
         lon00 - lon01 - lon10 + lon11 as gx, lat00 - lat01 - lat10 + lat11 as gy
  from gg, q
  where gg.lat between least(lat00, lat01, lat10, lat11) and greatest(lat00, lat01, lat10, lat11)
    and gg.lon between least(lon00, lon01, lon10, lon11) and greatest(lon00, lon01, lon10, lon11))""",
    *SOLVE_SQL) + """select m.time, w.rlat, w.rlon,
round(case when count(*) = max(w.n_corners) and count(m.v) = max(w.n_corners)
      then sum(m.v * w.w) end, 6) as v
from m join w on m.rlat = w.sy and m.rlon = w.sx group by all"""


def q_regrid_curvilinear_global(spark: SparkSession, sf: str) -> DataFrame:
    """G laid on a grid that holds the pole and crosses the date line, regridded on the sphere (J1d)."""
    out = regrid.interpolate(dense(spark, sf), fixtures.polar_grid(spark), fixtures.polar_target(spark), "v",
                             method="spherical", tgt_points=fixtures.RINGS * fixtures.RING_POINTS)
    return rounded(out)


def _xyz(lat: str, lon: str) -> str:
    return f"""cos(radians({lat})) * cos(radians({lon})) as x, cos(radians({lat})) * sin(radians({lon})) as y, sin(radians({lat})) as z"""


def _seen_corners() -> str:
    """The corners a, b, c, d of a quad in the east (lon) and north (lat) of the target t."""
    def along(axis: str, corner: str) -> str:
        return " + ".join(f't."{axis}{k}" * {corner}.{k}' for k in "xyz")

    return ", ".join(f"{along('a', c)} as lon{tag}, {along('b', c)} as lat{tag}" for c, tag in zip("abcd", ("00", "01", "10", "11"), strict=True))


# Brute force: every target against every quad, both seen along the line from the centre through the target.
SQL_REGRID_CURVILINEAR_GLOBAL = with_(G_SQL, f"""pl as (
  select j as rlat, i as rlon, cos(radians({fixtures.POLAR_LAT})) - sin(radians({fixtures.POLAR_LAT})) * b as x, a as y,
         sin(radians({fixtures.POLAR_LAT})) + cos(radians({fixtures.POLAR_LAT})) * b as z
  from (select cast(j as int) as j, cast(i as int) as i, (i - 3.5) * {fixtures.POLAR_STEP}::double as a,
               (j - 3.5) * {fixtures.POLAR_STEP}::double * 1.1::double + i * 0.01::double as b from range(8) p(j), range(8) r(i)))""",
    """pg as (select rlat, rlon, degrees(asin(z / sqrt(x * x + y * y + z * z))) as lat, degrees(atan2(y, x)) as lon from pl)""",
    f"""pv as (select rlat, rlon, {_xyz("lat", "lon")} from pg)""",
    f"""tg as (select cast(j as int) as rlat, cast(i as int) as rlon, 73.3::double + 2.05::double * j as lat, 22.5::double * i + 0.37::double * j as lon
  from range({fixtures.RINGS}) p(j), range({fixtures.RING_POINTS}) r(i))""",
    f"""tv as (select rlat, rlon, {_xyz("lat", "lon")}, -sin(radians(lon)) as ax, cos(radians(lon)) as ay, 0.0::double as az,
  -sin(radians(lat)) * cos(radians(lon)) as bx, -sin(radians(lat)) * sin(radians(lon)) as "by", cos(radians(lat)) as bz from tg)""",
    """q as (
  select t.rlat, t.rlon, a.rlat as qy, a.rlon as qx, """ + _seen_corners() + """
  from tv t, pv a join pv b on b.rlat = a.rlat and b.rlon = a.rlon + 1
           join pv c on c.rlat = a.rlat + 1 and c.rlon = a.rlon
           join pv d on d.rlat = a.rlat + 1 and d.rlon = a.rlon + 1
  where t.x * (a.x + b.x + c.x + d.x) + t.y * (a.y + b.y + c.y + d.y) + t.z * (a.z + b.z + c.z + d.z) > 0)""",
    """k as (
  select rlat, rlon, qy, qx, -lon00 as hx, -lat00 as hy, lon01 - lon00 as ex, lat01 - lat00 as ey,
         lon10 - lon00 as fx, lat10 - lat00 as fy, lon00 - lon01 - lon10 + lon11 as gx, lat00 - lat01 - lat10 + lat11 as gy from q)""",
    *SOLVE_SQL) + """select g.time, w.rlat, w.rlon,
round(case when count(*) = max(w.n_corners) and count(g.v) = max(w.n_corners) then sum(g.v * w.w) end, 6) as v
from g join w on g.rlat = w.sy and g.rlon = w.sx group by all"""


def q_align_lr(spark: SparkSession, sf: str) -> DataFrame:
    """Regrid onto T, crop 8×8 from (2, 2), coarsen by 4 (P5)."""
    g = dense(spark, sf)
    out = align.align_with_lr(g, fixtures.dense_grid(spark, sf), fixtures.curvilinear_target(spark),
                              scale_factor=4, x={"first_index": 2, "last_index": 10},
                              y={"first_index": 2, "last_index": 10}, value="v", tgt_shape=T_SHAPE)
    return rounded(out)


SQL_ALIGN_LR = with_(G_SQL, T_SQL(), W_SQL, """r as (
  select g.time, w.rlat, w.rlon,
         case when count(g.v) = max(w.n_corners) then sum(g.v * w.w) end as v
  from g join w on g.rlat = w.sy and g.rlon = w.sx group by all)""") + """
select time, cast((rlat - 2) // 4 as int) as rlat, cast((rlon - 2) // 4 as int) as rlon,
round(avg(v), 6) as v from r where rlat >= 2 and rlat < 10 and rlon >= 2 and rlon < 10
group by all"""


def q_align_lr_sparse(spark: SparkSession, sf: str) -> DataFrame:
    """Sparse monthly field on its half-degree grid: regrid onto T, crop, coarsen (two-step path)."""
    m = fixtures.monthly_field(spark, sf)
    out = align.align_with_lr(m, fixtures.monthly_grid(spark), fixtures.curvilinear_target(spark),
                              scale_factor=4, x={"first_index": 2, "last_index": 10},
                              y={"first_index": 2, "last_index": 10}, value="v", tgt_shape=T_SHAPE)
    return rounded(out)


# Bilinear weights of T on M's regular half-degree grid, written out by hand.
W_HALF_SQL = """b as (
  select rlat, rlon, lat, lon,
         least(cast(floor((lat - 46.0) / 0.5) as int), 14) as y0,
         least(cast(floor((lon - 230.0) / 0.5) as int), 14) as x0
  from t where lat >= 46.0 and lat <= 53.5 and lon >= 230.0 and lon <= 237.5),
f as (
  select rlat, rlon, y0, x0,
         (lat - (46.0 + 0.5 * y0)) / ((46.0 + 0.5 * (y0 + 1)) - (46.0 + 0.5 * y0)) as fy,
         (lon - (230.0 + 0.5 * x0)) / ((230.0 + 0.5 * (x0 + 1)) - (230.0 + 0.5 * x0)) as fx
  from b),
c4 as (
  select rlat, rlon, y0 as sy, x0 as sx, (1.0 - fy) * (1.0 - fx) as w from f
  union all select rlat, rlon, y0, x0 + 1, (1.0 - fy) * fx from f
  union all select rlat, rlon, y0 + 1, x0, fy * (1.0 - fx) from f
  union all select rlat, rlon, y0 + 1, x0 + 1, fy * fx from f),
w as (
  select rlat, rlon, sy, sx, w, cast(count(*) over (partition by rlat, rlon) as int) as n_corners
  from c4 where w <> 0)"""

SQL_ALIGN_LR_SPARSE = with_(M_SQL, T_SQL(), W_HALF_SQL, """r as (
  select m.time, w.rlat, w.rlon,
         case when count(*) = max(w.n_corners) and count(m.v) = max(w.n_corners)
              then sum(m.v * w.w) end as v
  from m join w on m.rlat = w.sy and m.rlon = w.sx group by all)""") + """
select time, cast((rlat - 2) // 4 as int) as rlat, cast((rlon - 2) // 4 as int) as rlon,
round(avg(v), 6) as v from r where rlat >= 2 and rlat < 10 and rlon >= 2 and rlon < 10
group by all"""


def q_preprocess_hr(spark: SparkSession, sf: str) -> DataFrame:
    """Per-variable preprocessing of an HR model, lazily (P6 ``hr`` branch)."""
    from .config import default_coords, default_dims
    from .plans import preprocess
    (start, end), _ = inner_window(dense(spark, sf))
    raw = dense(spark, sf).select(F.col("time").alias("Time"), "rlat", "rlon",
                                  F.col("v").alias("T2"))
    var = Variable("tas", ["T2"], transform=["x * 100"], apply_standardize=True)
    frame, _ = preprocess.prepare_variable(
        raw, var, model="hr", dims=default_dims(), coords=default_coords(),
        start=start, end=end, test_years=TEST_YEARS,
        validation_years=VALIDATION_YEARS, scale_factor=2,
        x={"first_index": 2, "last_index": 6}, y={"first_index": 1, "last_index": 5},
        shape=G_SHAPE)
    return rounded(frame.select("split", "time", "rlat", "rlon", "tas"))


SQL_PREPROCESS_HR = with_(G_SQL, f"""c as (
  select time, cast(rlat - 1 as int) as rlat, cast(rlon - 2 as int) as rlon, v * 100.0 as v from g
  where time between {INNER_SQL}
    and rlon >= 2 and rlon < 6 and rlat >= 1 and rlat < 5)""",
                          SPLIT_SQL.format(src="c"), TRAIN_STATS_SQL.format(src="c")) + \
    "select split, time, rlat, rlon, round((v - mu) / sd, 6) as tas from sp, st"


def q_align_hr(spark: SparkSession, sf: str) -> DataFrame:
    """High-resolution model: positional crop only (P6 ``hr`` branch)."""
    m = fixtures.monthly_field(spark, sf)
    out = align.align_hr(m, scale_factor=4, x={"first_index": 4, "last_index": 12},
                         y={"first_index": 0, "last_index": 8}, shape=M_SHAPE)
    return rounded(out)


SQL_ALIGN_HR = with_(M_SQL) + """select time, cast(rlat as int) as rlat, cast(rlon - 4 as int) as rlon,
round(v, 6) as v from m where rlon >= 4 and rlon < 12 and rlat >= 0 and rlat < 8"""


def q_invariant_lr(spark: SparkSession, sf: str) -> DataFrame:
    """A time-free field (per-cell mean of G) aligned like an LR invariant: no split, no scaling."""
    inv = dense(spark, sf).groupBy("rlat", "rlon").agg(F.avg("v").alias("v"))
    out = align.align_with_lr(inv, fixtures.dense_grid(spark, sf), fixtures.curvilinear_target(spark),
                              scale_factor=4, x={"first_index": 2, "last_index": 10},
                              y={"first_index": 2, "last_index": 10}, value="v", keys=(),
                              tgt_shape=T_SHAPE)
    return rounded(out)


SQL_INVARIANT_LR = with_(G_SQL, """gi as (select rlat, rlon, avg(v) as v from g group by all)""",
                         T_SQL(), W_SQL, """r as (
  select w.rlat, w.rlon,
         case when count(gi.v) = max(w.n_corners) then sum(gi.v * w.w) end as v
  from gi join w on gi.rlat = w.sy and gi.rlon = w.sx group by all)""") + """
select cast((rlat - 2) // 4 as int) as rlat, cast((rlon - 2) // 4 as int) as rlon,
round(avg(v), 6) as v from r where rlat >= 2 and rlat < 10 and rlon >= 2 and rlon < 10
group by all"""


def q_combine_vars(spark: SparkSession, sf: str) -> DataFrame:
    """Two variables with different support merged on (time, rlat, rlon): full outer join."""
    qty = fixtures.monthly_field(spark, sf, value="qty")
    disc = fixtures.monthly_field(spark, sf, value="disc", measure="l_discount", col_key="l_suppkey")
    from .sources.grids import combine_variables
    return rounded(combine_variables(qty, disc))


SQL_COMBINE_VARS = with_(
    """q as (select cast(date_trunc('month', l_shipdate) as timestamp) as time,
         cast(l_orderkey % 16 as int) as rlat, cast(l_partkey % 16 as int) as rlon,
         avg(l_quantity) as qty from lineitem group by all)""",
    """d as (select cast(date_trunc('month', l_shipdate) as timestamp) as time,
         cast(l_orderkey % 16 as int) as rlat, cast(l_suppkey % 16 as int) as rlon,
         avg(l_discount) as disc from lineitem group by all)""") + """
select time, rlat, rlon, round(qty, 6) as qty, round(disc, 6) as disc
from q full outer join d using (time, rlat, rlon)"""


def q_concat_time(spark: SparkSession, sf: str) -> DataFrame:
    """One variable kept in a file for even years and one for odd years, opened as one field."""
    folder, g = work_folder(spark, "concat"), dense(spark, sf)
    paths = [f"{folder}/{k}" for k in (0, 1)]
    for k, path in enumerate(paths):
        g.where(F.year("time") % 2 == k).write.parquet(path)
    return rounded(load_grid(spark, paths))


SQL_CONCAT_TIME = with_(G_SQL) + "select time, rlat, rlon, round(v, 6) as v from g"


def q_merge_static(spark: SparkSession, sf: str) -> DataFrame:
    """A time field merged with a static one (its mean by cell): every step keeps its row."""
    from .sources.grids import combine_variables
    g = dense(spark, sf)
    static = g.groupBy("rlat", "rlon").agg(F.avg("v").alias("mean"))
    return rounded(combine_variables(g, static))


SQL_MERGE_STATIC = with_(G_SQL, """s as (select rlat, rlon, avg(v) as mean from g group by all)""") + \
    """select time, rlat, rlon, round(v, 6) as v, round(mean, 6) as mean from g left join s using (rlat, rlon)"""


def q_load_many(spark: SparkSession, sf: str) -> DataFrame:
    """Several given tables through one load: those with other columns are merged on the key they share."""
    from .sources.grids import load_grid
    both = load_grid(spark, [f"{sf}/documents.parquet", f"{sf}/labels.parquet"], keys=("doc_id",))
    return both.select("doc_id", "source", "n_chars", "quality", "toxic")


SQL_LOAD_MANY = "select doc_id, source, n_chars, quality, toxic from documents full join labels using (doc_id)"


def q_log_precip_splits(spark: SparkSession, sf: str) -> DataFrame:
    """Precipitation log scale of the monthly field, with rows in all three splits."""
    var = Variable("pr", apply_standardize=False, apply_normalize=True)
    out, _ = scale.split_and_scale(fixtures.monthly_field(spark, sf), var, [1995], [1997], value="v")
    return out.select("split", "time", "rlat", "rlon", r6("v"))


SQL_LOG_PRECIP_SPLITS = with_(M_SQL, """sp as (
  select case when year(time) = 1995 then 'test' when year(time) = 1997 then 'validation' else 'train' end as split, * from m)""",
                              """st as (select max(v) as hi from sp where split = 'train')""") + \
    """select split, time, rlat, rlon, round((ln(v + 0.001) - ln(0.001)) / (ln(hi + 0.001) - ln(0.001)), 6) as v from sp, st"""


def q_transform_missing(spark: SparkSession, sf: str) -> DataFrame:
    """Transforms on M laid on its whole 16x16 grid: absent cells stay missing through clip, where, ``!=`` and logic."""
    m = fixtures.monthly_field(spark, sf)
    cells = F.explode(F.sequence(F.lit(0), F.lit(fixtures.MONTHLY_SIDE ** 2 - 1)))
    full = m.select("time").distinct().select("time", cells.alias("c"))
    full = full.select("time", F.floor(F.col("c") / fixtures.MONTHLY_SIDE).cast("int").alias("rlat"), (F.col("c") % fixtures.MONTHLY_SIDE).cast("int").alias("rlon"))
    x = F.col("v")
    laid = full.join(m, ["time", "rlat", "rlon"], "left")
    out = {"clipped": "np.clip(x, 20, 30)", "hidden": "np.where(x < 25, np.nan, x)", "other": "x != 25",
           "inside": "(x > 20) & ~(x > 30) | (x == 40)", "low": "np.minimum(x, np.inf)"}
    return laid.select("time", "rlat", "rlon", *[r6(transform_column(x, [e]), n) for n, e in out.items()])


SQL_TRANSFORM_MISSING = with_(M_SQL, """f as (select time, cast(c // 16 as int) as rlat, cast(c % 16 as int) as rlon
  from (select distinct time from m), range(256) r(c))""", "l as (select f.*, v from f left join m using (time, rlat, rlon))") + """
select time, rlat, rlon,
round(case when v is null then null when v < 20 then 20.0 when v > 30 then 30.0 else v end, 6) as clipped,
round(case when v >= 25 then v end, 6) as hidden,
round(case when v = 25 then 0.0 else 1.0 end, 6) as other,
round(case when (v > 20 and v <= 30) or v = 40 then 1.0 else 0.0 end, 6) as inside,
round(v, 6) as low from l"""


def q_lead_unfold(spark: SparkSession, sf: str) -> DataFrame:
    """Forecast leads → valid times: time + (level-1) h, level set to 0."""
    out = cuts.unfold_leads(fixtures.lead_field(spark, sf))
    return rounded(out.select("time", "level", "rlat", "rlon", "v"))


SQL_LEAD_UNFOLD = with_(L_SQL) + """select time + to_hours(level - 1) as time, 0 as level,
rlat, rlon, round(v, 6) as v from l"""


def q_sample_tensors(spark: SparkSession, sf: str) -> DataFrame:
    g = dense(spark, sf)
    s = samples.samples(g, "v", 8, 8, element_type="double")
    return s.select("key", "time", "ny", "nx",
                    F.transform("tensor", round6).alias("tensor"))


SQL_SAMPLE_TENSORS = with_(G_SQL) + """select strftime(time, '%Y-%m-%d-%H') as key, time,
8 as ny, 8 as nx, list(round(v, 6) order by rlat, rlon) as tensor from g group by all"""


def q_sample_keys(spark: SparkSession, sf: str) -> DataFrame:
    """Sample keys of each split with the per-sample checksum (tensor form)."""
    g = dense(spark, sf)
    split = select.with_split(g, TEST_YEARS, VALIDATION_YEARS)
    s = samples.samples(split, "v", 8, 8, group=("split",), element_type="double")
    checksum = F.aggregate(F.transform("tensor", lambda e, i: e * (i + 1)), F.lit(0.0),
                           lambda acc, e: acc + e)
    return s.select("split", "key", F.size("tensor").alias("n_cells"), r6(checksum, "checksum"))


SQL_SAMPLE_KEYS = with_(G_SQL, SPLIT_SQL.format(src="g")) + """
select split, strftime(time, '%Y-%m-%d-%H') as key, cast(count(*) as int) as n_cells,
round(sum(v * (rlat * 8 + rlon + 1)), 6) as checksum from sp group by all"""


def _split_samples(spark: SparkSession, sf: str) -> DataFrame:
    g = dense(spark, sf)
    split = select.with_split(g, TEST_YEARS, VALIDATION_YEARS)
    return samples.samples(split, "v", 8, 8, group=("split",))


def q_batches(spark: SparkSession, sf: str) -> DataFrame:
    """Seeded permutation of each split's samples, cut into batches of 4."""
    keys = select.with_split(dense(spark, sf), TEST_YEARS, VALIDATION_YEARS) \
        .select("split", scalars.sample_key("time").alias("key")).distinct()
    a = samples.assign_batches(keys, BATCH_SIZE, SEED, group=("split",))
    return samples.batch_names(a, group=("split",))


SQL_BATCHES = with_(G_SQL, SPLIT_SQL.format(src="g"), """k as (
  select distinct split, strftime(time, '%Y-%m-%d-%H') as key from sp)""", """o as (
  select split, key, row_number() over (partition by split order by md5('0|' || key), key) - 1 as pos
  from k)""") + """select split, cast(pos // 4 as bigint) as batch_id,
string_agg(key, '__' order by pos) as name, cast(count(*) as int) as n from o group by all"""


def q_batch_tensors(spark: SparkSession, sf: str) -> DataFrame:
    """Stacked batch tensors (K7), summarised by batch checksum."""
    s = _split_samples(spark, sf)
    # keys come from the distinct times, so that the field is packed once
    keys = select.with_split(dense(spark, sf).select("time").distinct(), TEST_YEARS, VALIDATION_YEARS) \
        .select("split", scalars.sample_key("time").alias("key")).distinct()
    a = samples.assign_batches(keys, BATCH_SIZE, SEED, group=("split",))
    b = samples.batches(s, a, group=("split",),
                        broadcast_assignment=samples.assignment_fits_broadcast(a))
    total = F.aggregate(F.flatten("tensors"), F.lit(0.0), lambda acc, e: acc + e.cast("double"))
    return b.select("split", "batch_id", "name", F.size("tensors").alias("n"),
                    r6(total, "total"))


SQL_BATCH_TENSORS = with_(G_SQL, SPLIT_SQL.format(src="g"), """k as (
  select distinct split, strftime(time, '%Y-%m-%d-%H') as key from sp)""", """o as (
  select split, key, row_number() over (partition by split order by md5('0|' || key), key) - 1 as pos
  from k)""", """tot as (select split, strftime(time, '%Y-%m-%d-%H') as key,
  sum(cast(cast(v as float) as double)) as s from sp group by all)""") + """
select o.split, cast(pos // 4 as bigint) as batch_id, string_agg(o.key, '__' order by pos) as name,
cast(count(*) as int) as n, round(sum(s), 6) as total
from o join tot using (split, key) group by all"""


def q_rain_mask(spark: SparkSession, sf: str) -> DataFrame:
    """Standardize G (train stats), then mask values above the zero-rain threshold."""
    g = dense(spark, sf)
    var = Variable("pr", apply_standardize=True)
    out, _ = scale.split_and_scale(g, var, TEST_YEARS, VALIDATION_YEARS, value="v")
    return out.select("split", "time", "rlat", "rlon", scalars.rain_mask("v").alias("mask"))


SQL_RAIN_MASK = with_(G_SQL, SPLIT_SQL.format(src="g"), TRAIN_STATS_SQL.format(src="g")) + """
select split, time, rlat, rlon,
case when (v - mu) / sd > -0.0769779160618782 / 0.3726992905139923 then 1 else 0 end as mask
from sp, st"""


def q_pair_lr_hr(spark: SparkSession, sf: str) -> DataFrame:
    """LR (coarsened ×4) and HR samples of the same split and hour, paired by key."""
    g = dense(spark, sf)
    split = select.with_split(g, TEST_YEARS, VALIDATION_YEARS)
    hr = samples.samples(split, "v", 8, 8, group=("split",), element_type="double")
    lr_cells = aggregate.coarsen(split, 4, "v", keys=("split", "time"))
    lr = samples.samples(lr_cells, "v", 2, 2, group=("split",), element_type="double")
    p = samples.pair_samples(lr, hr)
    sum_arr = lambda c: F.aggregate(c, F.lit(0.0), lambda acc, e: acc + e)
    return p.select("split", "key", F.size("lr_tensor").alias("lr_n"),
                    F.size("hr_tensor").alias("hr_n"),
                    r6(sum_arr(F.col("lr_tensor")), "lr_sum"), r6(sum_arr(F.col("hr_tensor")), "hr_sum"))


SQL_PAIR_LR_HR = with_(G_SQL, SPLIT_SQL.format(src="g"), """lr as (
  select split, time, avg(v) as v from sp group by split, time, rlat // 4, rlon // 4)""") + """
select h.split, h.key, l.lr_n, h.hr_n, round(l.lr_sum, 6) as lr_sum, round(h.hr_sum, 6) as hr_sum
from (select split, strftime(time, '%Y-%m-%d-%H') as key, cast(count(*) as int) as hr_n,
             sum(v) as hr_sum from sp group by all) h
join (select split, strftime(time, '%Y-%m-%d-%H') as key, cast(count(*) as int) as lr_n,
             sum(v) as lr_sum from lr group by all) l using (split, key)"""


def q_source_cut(spark: SparkSession, sf: str) -> DataFrame:
    """Box then whole-day date cut of a lat/lon field."""
    g = dense(spark, sf)
    grid = fixtures.dense_grid(spark, sf)
    out = cuts.source_cut(g, grid, lon_min=231.0, lon_max=236.0, lat_min=47.0, lat_max=52.0,
                          start_date="20010101", end_date="20031231")
    return rounded(out.select("time", "rlat", "rlon", "v"))


SQL_SOURCE_CUT = with_(G_SQL) + """select time, cast(rlat - 1 as int) as rlat, cast(rlon - 1 as int) as rlon,
round(v, 6) as v from g where rlat between 1 and 6 and rlon between 1 and 6
and time >= timestamp '2001-01-01' and time < timestamp '2004-01-01'"""


def _preprocess_lr(spark: SparkSession, sf: str, west: bool) -> DataFrame:
    from .plans import preprocess
    (start, end), _ = inner_window(dense(spark, sf))
    g = dense(spark, sf).withColumnRenamed("v", "T2")
    var = Variable("tas", ["T2"], transform=["x - 273.15"], apply_standardize=True,
                   apply_normalize=False, is_west_negative=west)
    grid = fixtures.dense_grid(spark, sf, west_negative=west)
    frame, _ = preprocess.prepare_variable(
        g, var, model="lr", dims=None, coords=None,
        start=start, end=end, test_years=TEST_YEARS,
        validation_years=VALIDATION_YEARS, scale_factor=4,
        x={"first_index": 2, "last_index": 10}, y={"first_index": 2, "last_index": 10},
        src_grid=preprocess.shifted_grid(grid, var), hr_ref=fixtures.curvilinear_target(spark),
        shape=T_SHAPE, stage=preprocess.checkpoint_stage)
    return rounded(frame.select("split", "time", "rlat", "rlon", "tas"))


def q_preprocess_lr(spark: SparkSession, sf: str) -> DataFrame:
    """Per-variable preprocessing of an LR model: staged with its statistics observed (P6 without the write)."""
    return _preprocess_lr(spark, sf, west=False)


def q_preprocess_lr_west(spark: SparkSession, sf: str) -> DataFrame:
    """The same with the source grid at longitudes -130..: the grid is shifted before the regrid (M4, M5)."""
    return _preprocess_lr(spark, sf, west=True)


SQL_PREPROCESS_LR = with_(G_SQL, f"""g2 as (select * from g
  where time between {INNER_SQL})""", T_SQL(), W_SQL, """r as (
  select g2.time, w.rlat, w.rlon,
         case when count(g2.v) = max(w.n_corners) then sum(g2.v * w.w) end as v
  from g2 join w on g2.rlat = w.sy and g2.rlon = w.sx group by all)""", """c as (
  select time, cast((rlat - 2) // 4 as int) as rlat, cast((rlon - 2) // 4 as int) as rlon,
         avg(v) - 273.15 as v
  from r where rlat >= 2 and rlat < 10 and rlon >= 2 and rlon < 10 group by all)""",
                          SPLIT_SQL.format(src="c"), TRAIN_STATS_SQL.format(src="c")) + \
    "select split, time, rlat, rlon, round((v - mu) / sd, 6) as tas from sp, st"


def q_time_bounds(spark: SparkSession, sf: str) -> DataFrame:
    """Axis bounds and counts of the dense field."""
    g = dense(spark, sf)
    return g.agg(F.min("time").alias("first"), F.max("time").alias("last"),
                 F.count_distinct("time").alias("n_steps"), F.count(F.lit(1)).alias("n_cells"),
                 F.min("rlat").alias("rlat_min"), F.max("rlat").alias("rlat_max"))


SQL_TIME_BOUNDS = with_(G_SQL) + """select min(time) as first, max(time) as last,
count(distinct time) as n_steps, count(*) as n_cells, min(rlat) as rlat_min, max(rlat) as rlat_max
from g"""


def q_dim_sizes(spark: SparkSession, sf: str) -> DataFrame:
    """Dimension sizes of the sparse monthly field."""
    m = fixtures.monthly_field(spark, sf)
    return m.agg(*[F.count_distinct(c).alias(f"n_{c}") for c in ("time", "rlat", "rlon")])


SQL_DIM_SIZES = with_(M_SQL) + """select count(distinct time) as n_time, count(distinct rlat) as n_rlat,
count(distinct rlon) as n_rlon from m"""


def q_unpack_tensors(spark: SparkSession, sf: str) -> DataFrame:
    """Samples back to cells (tensor → cell form)."""
    s = samples.samples(dense(spark, sf), "v", 8, 8, element_type="double")
    return rounded(tensors.unpack(s, "v"))


SQL_UNPACK_TENSORS = with_(G_SQL) + "select time, rlat, rlon, round(v, 6) as v from g"


def q_mask_tensors(spark: SparkSession, sf: str) -> DataFrame:
    """Standardized samples of each split turned into 0/1 rain masks ``mask_{key}``."""
    g = dense(spark, sf)
    var = Variable("pr", apply_standardize=True)
    out, _ = scale.split_and_scale(g, var, TEST_YEARS, VALIDATION_YEARS, value="v")
    s = samples.samples(out, "v", 8, 8, group=("split",), element_type="double")
    m = samples.masks(s)
    return m.select("split", "key", F.aggregate("tensor", F.lit(0), lambda a, e: a + e).alias("wet"),
                    F.array_join(F.transform("tensor", lambda e: e.cast("string")), "").alias("bits"))


SQL_MASK_TENSORS = with_(G_SQL, SPLIT_SQL.format(src="g"), TRAIN_STATS_SQL.format(src="g"), """mk as (
  select split, time, rlat, rlon,
         case when (v - mu) / sd > -0.0769779160618782 / 0.3726992905139923 then 1 else 0 end as b
  from sp, st)""") + """select split, 'mask_' || strftime(time, '%Y-%m-%d-%H') as key,
cast(sum(b) as int) as wet, string_agg(cast(b as varchar), '' order by rlat, rlon) as bits
from mk group by all"""


def q_batches_sorted(spark: SparkSession, sf: str) -> DataFrame:
    """Batches in sorted key order (``randomize = False``)."""
    keys = select.with_split(dense(spark, sf), TEST_YEARS, VALIDATION_YEARS) \
        .select("split", scalars.sample_key("time").alias("key")).distinct()
    a = samples.assign_batches(keys, 3, group=("split",), randomize=False)
    return samples.batch_names(a, group=("split",))


SQL_BATCHES_SORTED = with_(G_SQL, SPLIT_SQL.format(src="g"), """k as (
  select distinct split, strftime(time, '%Y-%m-%d-%H') as key from sp)""", """o as (
  select split, key, row_number() over (partition by split order by key) - 1 as pos from k)""") + \
    """select split, cast(pos // 3 as bigint) as batch_id, string_agg(key, '__' order by pos) as name,
cast(count(*) as int) as n from o group by all"""


QUERIES: dict[str, Query] = {
    "lr_min_slice": q_lr_min_slice,
    "slice_time": q_slice_time,
    "year_split": q_year_split,
    "year_split_overlap": q_year_split_overlap,
    "crop": q_crop,
    "box_select": q_box_select,
    "date_select": q_date_select,
    "rename": q_rename,
    "squeeze": q_squeeze,
    "lon_360": q_lon_360,
    "coarsen": q_coarsen,
    "coarsen_sparse": q_coarsen_sparse,
    "field_stats": q_field_stats,
    "transform_expr": q_transform_expr,
    "transform_missing": q_transform_missing,
    "standardize": q_standardize,
    "minmax": q_minmax,
    "log_precip": q_log_precip_train,
    "log_precip_splits": q_log_precip_splits,
    "standardize_then_minmax": q_standardize_then_minmax,
    "regrid_weights": q_regrid_weights,
    "regrid_bilinear": q_regrid_bilinear,
    "regrid_outside": q_regrid_outside,
    "regrid_tensor": q_regrid_tensor,
    "regrid_curvilinear": q_regrid_curvilinear,
    "regrid_curvilinear_global": q_regrid_curvilinear_global,
    "align_lr": q_align_lr,
    "align_hr": q_align_hr,
    "align_lr_sparse": q_align_lr_sparse,
    "preprocess_hr": q_preprocess_hr,
    "invariant_lr": q_invariant_lr,
    "combine_vars": q_combine_vars,
    "merge_static": q_merge_static,
    "concat_time": q_concat_time,
    "load_many": q_load_many,
    "lead_unfold": q_lead_unfold,
    "sample_tensors": q_sample_tensors,
    "sample_keys": q_sample_keys,
    "batches": q_batches,
    "batch_tensors": q_batch_tensors,
    "rain_mask": q_rain_mask,
    "pair_lr_hr": q_pair_lr_hr,
    "source_cut": q_source_cut,
    "preprocess_lr": q_preprocess_lr,
    "preprocess_lr_west": q_preprocess_lr_west,
    "time_bounds": q_time_bounds,
    "dim_sizes": q_dim_sizes,
    "unpack_tensors": q_unpack_tensors,
    "mask_tensors": q_mask_tensors,
    "batches_sorted": q_batches_sorted,
}

_ORACLE: dict[str, str] = {
    "lr_min_slice": SQL_LR_MIN_SLICE,
    "slice_time": SQL_SLICE_TIME,
    "year_split": SQL_YEAR_SPLIT,
    "year_split_overlap": SQL_YEAR_SPLIT_OVERLAP,
    "crop": SQL_CROP,
    "box_select": SQL_BOX_SELECT,
    "date_select": SQL_DATE_SELECT,
    "rename": SQL_RENAME,
    "squeeze": SQL_SQUEEZE,
    "lon_360": SQL_LON_360,
    "coarsen": SQL_COARSEN,
    "coarsen_sparse": SQL_COARSEN_SPARSE,
    "field_stats": SQL_FIELD_STATS,
    "transform_expr": SQL_TRANSFORM_EXPR,
    "transform_missing": SQL_TRANSFORM_MISSING,
    "standardize": SQL_STANDARDIZE,
    "minmax": SQL_MINMAX,
    "log_precip": SQL_LOG_PRECIP_TRAIN,
    "log_precip_splits": SQL_LOG_PRECIP_SPLITS,
    "standardize_then_minmax": SQL_STANDARDIZE_THEN_MINMAX,
    "regrid_weights": SQL_REGRID_WEIGHTS,
    "regrid_bilinear": SQL_REGRID_BILINEAR,
    "regrid_outside": SQL_REGRID_OUTSIDE,
    "regrid_tensor": SQL_REGRID_BILINEAR,
    "regrid_curvilinear": SQL_REGRID_CURVILINEAR,
    "regrid_curvilinear_global": SQL_REGRID_CURVILINEAR_GLOBAL,
    "align_lr": SQL_ALIGN_LR,
    "align_hr": SQL_ALIGN_HR,
    "align_lr_sparse": SQL_ALIGN_LR_SPARSE,
    "preprocess_hr": SQL_PREPROCESS_HR,
    "invariant_lr": SQL_INVARIANT_LR,
    "combine_vars": SQL_COMBINE_VARS,
    "merge_static": SQL_MERGE_STATIC,
    "concat_time": SQL_CONCAT_TIME,
    "load_many": SQL_LOAD_MANY,
    "lead_unfold": SQL_LEAD_UNFOLD,
    "sample_tensors": SQL_SAMPLE_TENSORS,
    "sample_keys": SQL_SAMPLE_KEYS,
    "batches": SQL_BATCHES,
    "batch_tensors": SQL_BATCH_TENSORS,
    "rain_mask": SQL_RAIN_MASK,
    "pair_lr_hr": SQL_PAIR_LR_HR,
    "source_cut": SQL_SOURCE_CUT,
    "preprocess_lr": SQL_PREPROCESS_LR,
    "preprocess_lr_west": SQL_PREPROCESS_LR,
    "time_bounds": SQL_TIME_BOUNDS,
    "dim_sizes": SQL_DIM_SIZES,
    "unpack_tensors": SQL_UNPACK_TENSORS,
    "mask_tensors": SQL_MASK_TENSORS,
    "batches_sorted": SQL_BATCHES_SORTED,
}

ORACLE_SQL: dict[str, str] = {k: _sql_round6(v) for k, v in _ORACLE.items()}
