"""Routing by step, bands of targets and time slots."""

import datetime as dt
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from gridloom.operators import bands, regrid, timeaxis
from gridloom.plans import align
from test_regrid import T0, field, grid_frame, result, static_plan

FULL = {"first_index": 0, "last_index": 8}


def setup(spark, steps=4, rows=None):
    lats, lons = np.arange(40, 48, 1.0), np.arange(200, 208, 1.0)
    grid = grid_frame(spark, lats, lons)
    target = spark.createDataFrame([(j, i, 40.2 + 0.8 * j, 200.3 + 0.95 * i) for j in range(8) for i in range(8)], "rlat int, rlon int, lat double, lon double")
    cells = [(T0 + dt.timedelta(hours=s), y, x, math.sin(s + 3 * y) * x) for s in range(steps) for y in range(8) for x in range(8)]
    for s, y, x, change in rows or []:
        k = s * 64 + y * 8 + x
        if change == "gap":
            cells[k] = None
        elif change == "null":
            cells[k] = (*cells[k][:3], None)
        elif change == "copy":
            cells.append(cells[k])
    return spark.createDataFrame([c for c in cells if c], "time timestamp_ntz, rlat int, rlon int, v double"), grid, target


def with_none(df):
    return {(r.time, r.rlat, r.rlon): r.v for r in df.collect()}


def same(a, b):
    assert a.keys() == b.keys() and a
    for k in a:
        assert (a[k] is None) == (b[k] is None) and (a[k] is None or a[k] == pytest.approx(b[k]))


BROKEN = [(1, 3, 3, "gap"), (2, 0, 5, "null"), (3, 7, 7, "copy")]


@pytest.mark.parametrize("bound", [regrid.MAX_BROADCAST_ROWS, 64])
@pytest.mark.parametrize("rows", [[], BROKEN[:1], BROKEN, [(s, 4, 4, "gap") for s in range(5)]])
def test_routed_steps_equal_the_two_steps(spark, bound, rows):
    args = (*setup(spark, 5, rows), 2, FULL, FULL, "v")
    same(with_none(align.align_with_lr(*args, max_broadcast_rows=bound)), with_none(align.align_with_lr(*args, compose=False)))


def test_one_broken_step_leaves_the_others_on_the_composed_route(spark):
    cells, grid, target = setup(spark, 5, BROKEN[:1])
    marked = align.mark_whole(cells, "v", ("time",), 64)
    route = {r.time: (r.a, r.b) for r in marked.groupBy("time").agg(F.min("_whole").alias("a"), F.max("_whole").alias("b")).collect()}
    assert route == {T0 + dt.timedelta(hours=s): (s != 1, s != 1) for s in range(5)}
    for change in BROKEN:
        cells, _, _ = setup(spark, 5, [change])
        assert {r.time for r in align.mark_whole(cells, "v", ("time",), 64).where("not _whole").collect()} == {T0 + dt.timedelta(hours=change[0])}


def test_routing_needs_no_exchange_of_its_own_and_no_action_on_the_field(spark, tmp_path):
    cells, grid, target = setup(spark, 5, BROKEN[:1])
    cells.write.parquet(str(tmp_path / "src"))
    plan = static_plan(spark, align.align_with_lr(spark.read.parquet(str(tmp_path / "src")), grid, target, 2, FULL, FULL, "v"))
    exchanges = [ln for ln in plan.splitlines() if "Exchange " in ln and "Broadcast" not in ln and "[rlat" not in ln and "(rlat" not in ln and "(by" not in ln]
    assert len([ln for ln in plan.splitlines() if "FileScan" in ln and "time:" in ln]) == 1
    assert len([ln for ln in exchanges if "_slot" in ln]) == 1 and not any("time" in ln for ln in exchanges)


def test_three_bands_scan_and_exchange_the_cells_once(spark, tmp_path):
    cells, grid, target = setup(spark, 5, BROKEN)
    cells.write.parquet(str(tmp_path / "src"))
    cells = spark.read.parquet(str(tmp_path / "src"))
    weights = regrid.bilinear_weights(grid, target)

    def banded():
        return regrid.apply_weights_tiled(cells, weights, "v", ("time",), 8, 64, max_rows=100)  # 3 rows of targets a band

    same(with_none(banded()), with_none(regrid.apply_weights(cells, weights, "v")))
    assert weights.select((F.floor(F.col("rlat") / 3)).alias("b")).distinct().count() == 3
    plan = static_plan(spark, banded())
    assert len([ln for ln in plan.splitlines() if "FileScan" in ln and "time:" in ln]) == 1
    left = plan[plan.index("FlatMapCoGroupsInArrow"):plan.index("FileScan")]
    assert left.count("Exchange hashpartitioning") == 1 and "_of_band" in left


def test_bands_take_several_values_and_static_fields(spark):
    cells, grid, target = setup(spark, 3, BROKEN[:2])
    two = cells.withColumn("u", F.col("v") * 2 + 1)
    weights = regrid.bilinear_weights(grid, target)
    a = {(r.time, r.rlat, r.rlon): (r.v, r.u) for r in bands.apply_banded(two, weights, ["v", "u"], ("time",), 8, 64, 64).collect()}
    b = {(r.time, r.rlat, r.rlon): (r.v, r.u) for r in regrid.apply_weights(two, weights, ["v", "u"]).collect()}
    assert a.keys() == b.keys() and all(x == pytest.approx(y) for k in a for x, y in zip(a[k], b[k]) if y is not None)
    assert {k for k in a if a[k][0] is None} == {k for k in b if b[k][0] is None}
    still = cells.where(F.col("time") == F.lit(T0)).drop("time")
    c = {(r.rlat, r.rlon): r.v for r in bands.apply_banded(still, weights, "v", (), 8, 64, 64).collect()}
    assert c == pytest.approx({(r.rlat, r.rlon): r.v for r in regrid.apply_weights(still, weights, "v", ()).collect()})


def test_slots_follow_an_even_axis_and_hash_an_uneven_one(spark):
    hours = [T0 + dt.timedelta(hours=6 * h) for h in range(400)]
    burst = [T0 + dt.timedelta(seconds=s) for s in range(400)] + [T0 + dt.timedelta(days=4000)]
    for times, even in ((hours, True), (burst, False)):
        df = spark.createDataFrame([(t,) for t in times] + [(None,)], "time timestamp_ntz")
        axis = timeaxis.time_axis(df)
        assert axis.even == even and axis.steps == pytest.approx(len(times), rel=0.1)
        slotted = timeaxis.by_slot(df, axis, 8)
        rows = slotted.withColumn("p", F.spark_partition_id()).collect()
        assert all(r["p"] == r[timeaxis.SLOT] for r in rows)
        sizes = [sum(r["p"] == k for r in rows) for k in range(8)]
        assert max(sizes) < 3 * len(times) / 8
        if even:
            in_order = [r[timeaxis.SLOT] for r in sorted((r for r in rows if r.time), key=lambda r: r.time)]
            assert in_order == sorted(in_order)
    one = timeaxis.time_axis(spark.createDataFrame([], "time timestamp_ntz"))
    assert (one.steps, one.even) == (1, True)


def test_uneven_axis_aligns_the_same(spark):
    cells, grid, target = setup(spark, 2)
    burst = cells.withColumn("k", F.explode(F.sequence(F.lit(0), F.lit(90)))).withColumn(
        "time", F.when(F.col("k") == 90, F.lit(dt.datetime(2050, 1, 1))).otherwise(F.col("time") + F.expr("make_dt_interval(0, 0, 0, k)"))).drop("k").distinct()
    burst = burst.dropDuplicates(["time", "rlat", "rlon"])
    assert not timeaxis.time_axis(burst).even
    args = (burst, grid, target, 2, FULL, FULL, "v")
    assert result(align.align_with_lr(*args)) == pytest.approx(result(align.align_with_lr(*args, compose=False)))
