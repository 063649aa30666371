import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from gridloom.sinks import writers
from gridloom.sources import grids


def test_write_dataset_history(spark, tmp_path):
    path = str(tmp_path / "test1")
    df = spark.createDataFrame([(0, 0, 1), (0, 1, 2), (1, 0, 3), (1, 1, 4)], "x int, y int, data int")
    writers.write_dataset(df, path)
    attrs = writers.read_attrs(spark, path)
    assert "history" in attrs and os.path.exists(path)
    assert spark.read.parquet(path).count() == 4
    writers.write_dataset(df.where("data > 2"), path)          # overwrite
    assert spark.read.parquet(path).count() == 2


def test_write_empty_dataset(spark, tmp_path):
    path = str(tmp_path / "empty")
    df = spark.createDataFrame([], "x int, y int, data double")
    writers.write_dataset(df, path)
    assert "history" in writers.read_attrs(spark, path)
    back = spark.read.parquet(path)
    assert back.count() == 0 and back.columns == ["x", "y", "data"]


def test_write_splits_prunes_partitions(spark, tmp_path):
    root = str(tmp_path / "out")
    rows = [(s, dt.datetime(2000 + k, 1, 1), 0, 0, float(k)) for k, s in
            enumerate(["train", "test", "validation", "train"])]
    df = spark.createDataFrame(rows, "split string, time timestamp_ntz, rlat int, rlon int, tas double")
    writers.write_splits(df, root, "tas", "hr", attrs={"mean": 1.5, "std": 0.5})
    back = spark.read.parquet(root).where("variable = 'tas' and model = 'hr' and split = 'train'")
    plan = back._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and "split" in plan
    assert back.count() == 2
    year = spark.read.parquet(root).where("year = 2001")
    assert year.count() == 1
    assert writers.read_attrs(spark, f"{root}/variable=tas/model=hr")["mean"] == 1.5
    # another model has a path of its own; a rewrite of one replaces all its partitions
    writers.write_splits(df.limit(1), root, "tas", "lr")
    assert spark.read.parquet(root).where("model = 'hr'").count() == 4
    writers.write_splits(df.where("split = 'test'"), root, "tas", "hr")
    assert [(r.split, r.year, r.value) for r in spark.read.parquet(root).where("model = 'hr'").collect()] == [("test", 2001, 1.0)]
    assert writers.stored_pairs(spark, root) == [("tas", "hr"), ("tas", "lr")]


def test_existing_paths_skips_missing(spark, tmp_path):
    p = str(tmp_path / "a")
    spark.range(3).write.parquet(p)
    assert grids.existing_paths(spark, [p, str(tmp_path / "missing")]) == [p]


def test_load_grid_concat_and_merge(spark, tmp_path):
    t0 = dt.datetime(2000, 1, 1)
    a1, a2, b = (str(tmp_path / n) for n in ("a1", "a2", "b"))
    spark.createDataFrame([(t0, 0, 0, 1.0)], "time timestamp_ntz, rlat int, rlon int, uas double").write.parquet(a1)
    spark.createDataFrame([(t0 + dt.timedelta(hours=1), 0, 0, float("nan"))],
                          "time timestamp_ntz, rlat int, rlon int, uas double").write.parquet(a2)
    spark.createDataFrame([(t0, 0, 0, 5.0), (t0, 0, 1, 6.0)],
                          "time timestamp_ntz, rlat int, rlon int, vas double").write.parquet(b)
    one = grids.load_grid(spark, [a1, a2])
    assert one.count() == 2 and one.where(F.col("uas").isNull()).count() == 1   # NaN → NULL
    merged = grids.load_grid(spark, [a1, a2, b])
    assert merged.count() == 3
    assert set(merged.columns) == {"time", "rlat", "rlon", "uas", "vas"}


def test_reference_grid(spark):
    df = spark.createDataFrame([(t, 0, 0, 1.0, 2.0, 3.0) for t in range(3)],
                               "time int, rlat int, rlon int, lat double, lon double, T2 double")
    g = grids.load_reference_grid(spark, df)
    assert g.count() == 1 and g.columns == ["rlat", "rlon", "lat", "lon"]


def test_stats_sidecar(spark, tmp_path):
    writers.write_train_stats(spark, str(tmp_path), "tas", "hr", {"mean": 1.0, "std": 2.0})
    got = writers.read_attrs(spark, str(tmp_path / "train" / "tas_train_hr_attrs"))
    assert got == {"attributes": {"mean": 1.0, "std": 2.0}}


def test_cut_sources_skips_missing(spark, tmp_path):
    from gridloom.plans import cuts
    p = str(tmp_path / "pr")
    rows = [(dt.datetime(2001, 1, d, h), y, x, float(d)) for d in (1, 2, 3) for h in (0, 12)
            for y in range(3) for x in range(3)]
    spark.createDataFrame(rows, "time timestamp_ntz, rlat int, rlon int, pr double").write.parquet(p)
    grid = spark.createDataFrame([(y, x, 46.0 + y, 208.0 + x) for y in range(3) for x in range(3)],
                                 "rlat int, rlon int, lat double, lon double")
    out = cuts.cut_sources(spark, [p, str(tmp_path / "missing")], grid,
                           {"lon_min": 209, "lon_max": 210, "lat_min": 46, "lat_max": 47},
                           "20010102", "20010102")
    assert list(out) == [p]
    got = out[p]
    assert got.count() == 2 * 2 * 2 and got.agg(F.max("rlat"), F.max("rlon")).first() == (1, 1)


def _field(spark, path, columns, rows):
    spark.createDataFrame(rows, columns).write.parquet(path)
    return path


def test_glob_of_two_variables_equals_the_list(spark, tmp_path):
    t0 = dt.datetime(2000, 1, 1)
    paths = [_field(spark, str(tmp_path / f"{v}.parquet"), f"time timestamp_ntz, rlat int, rlon int, {v} double", [(t0, 0, x, float(x)) for x in range(3)]) for v in "ab"]
    listed, globbed = grids.load_grid(spark, paths), grids.load_grid(spark, str(tmp_path / "*.parquet"))
    assert sorted(map(tuple, listed.collect())) == sorted(map(tuple, globbed.collect())) == [(t0, 0, x, float(x), float(x)) for x in range(3)]


def test_static_field_keeps_the_time_axis(spark, tmp_path):
    times = [dt.datetime(2000, 1, d) for d in (1, 2, 3)]
    a = _field(spark, str(tmp_path / "a"), "time timestamp_ntz, rlat int, rlon int, a double", [(t, 0, x, 1.0) for t in times for x in range(2)])
    s = _field(spark, str(tmp_path / "s"), "rlat int, rlon int, s double", [(0, 0, 7.0), (0, 0, 7.0)])
    for order in ([a, s], [s, a]):
        got = sorted((r.time, r.rlon, r.a, r.s) for r in grids.load_grid(spark, order).collect())
        assert got == [(t, x, 1.0, 7.0 if x == 0 else None) for t in times for x in range(2)]


def test_conflicts_are_errors(spark):
    both = spark.createDataFrame([(0, 0, 1.0), (0, 0, 2.0)], "rlat int, rlon int, a double")
    other = spark.createDataFrame([(0, 0, 1.0)], "rlat int, rlon int, b double")
    with pytest.raises(Exception, match="two values of a for one cell"):
        grids.combine_variables(both, other).collect()
    with pytest.raises(ValueError, match="do not contain each other"):
        grids.combine_variables(spark.createDataFrame([(0, 1.0)], "time int, a double"), other)


@pytest.mark.parametrize("n", [2, 4, 7])
def test_any_number_of_variables_is_one_exchange(spark, tmp_path, n):
    t0 = dt.datetime(2000, 1, 1)
    paths = [_field(spark, str(tmp_path / f"v{k}"), f"time timestamp_ntz, rlat int, rlon int, v{k} double",
                    [(t0 + dt.timedelta(hours=h), 0, x, float(10 * k + x)) for h in range(2) for x in range(3) if (x + h) % (k + 1) == 0 for _ in range(2)]) for k in range(n)]
    still = _field(spark, str(tmp_path / "s"), "rlat int, rlon int, s double", [(0, x, -1.0 * x) for x in range(2)])
    other = _field(spark, str(tmp_path / "o"), "rlat int, rlon int, o double", [(0, 2, 5.0)])
    merged = grids.load_grid(spark, paths)
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        plan = merged._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert plan.count("Exchange hashpartitioning") == 1 and "Join" not in plan
    want = {}
    for k in range(n):
        for h in range(2):
            for x in range(3):
                if (x + h) % (k + 1) == 0:
                    want.setdefault((t0 + dt.timedelta(hours=h), x), {})[f"v{k}"] = float(10 * k + x)
    full = grids.load_grid(spark, [still, *paths, other])
    assert full.columns == ["time", "rlat", "rlon", "s", *[f"v{k}" for k in range(n)], "o"]
    got = {(r.time, r.rlon): r for r in full.collect()}
    assert got.keys() == want.keys() and full.count() == len(want)
    for (t, x), r in got.items():
        assert {f"v{k}": r[f"v{k}"] for k in range(n) if r[f"v{k}"] is not None} == want[t, x]
        assert (r.s, r.o) == (-1.0 * x if x < 2 else None, 5.0 if x == 2 else None)


def test_a_variable_given_twice_is_an_error(spark):
    a = spark.createDataFrame([(0, 0, 1.0)], "rlat int, rlon int, a double")
    b = spark.createDataFrame([(0, 0, 1.0, 2.0)], "rlat int, rlon int, a double, b double")
    with pytest.raises(ValueError, match="carry"):
        grids.combine_all([a, b])


def test_bounds_counts_and_grid_coarsening(spark):
    from gridloom.operators import aggregate
    rows = [(dt.datetime(2000, 1, 1, h), y, x, 1.0) for h in range(3) for y in range(2) for x in range(2)]
    df = spark.createDataFrame(rows, "time timestamp_ntz, rlat int, rlon int, v double")
    assert aggregate.axis_bounds(df, "time") == (dt.datetime(2000, 1, 1, 0), dt.datetime(2000, 1, 1, 2))
    r = aggregate.step_counts(df).first()
    assert (r.n_cells, r.n_steps) == (12, 3)
    grid = spark.createDataFrame([(y, x, 40.0 + y, 200.0 + 2 * x) for y in range(4) for x in range(4)],
                                 "rlat int, rlon int, lat double, lon double")
    cg = {(r.rlat, r.rlon): (r.lat, r.lon) for r in aggregate.coarsen_grid(grid, 2).collect()}
    assert cg[(0, 0)] == (40.5, 201.0) and cg[(1, 1)] == (42.5, 205.0)


def test_read_splits_prunes_years(spark, tmp_path):
    from gridloom.plans import samples as sample_plans
    root = str(tmp_path / "out")
    rows = [("train", dt.datetime(2000 + k, 1, 1), 0, 0, float(k)) for k in range(4)]
    df = spark.createDataFrame(rows, "split string, time timestamp_ntz, rlat int, rlon int, tas double")
    writers.write_splits(df, root, "tas", "hr")
    got = sample_plans.read_splits(spark, root, ["tas"], ["hr"], years=[2001, 2003])
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and "year" in plan.split("PartitionFilters")[1][:300]
    assert sorted(r.value for r in got.collect()) == [1.0, 3.0]


def test_files_hold_chunks_of_one_tile(spark, tmp_path):
    root = str(tmp_path / "out")
    rows = [("train", dt.datetime(2000, 1, d), y, x, 1.0) for d in range(1, 7) for y in range(4) for x in range(4)]
    df = spark.createDataFrame(rows, "split string, time timestamp_ntz, rlat int, rlon int, tas double").coalesce(1)
    tiles = writers.tile_sides({"time": 3, "rlat": 2, "rlon": 2, "z": 9})
    writers.write_splits(df, root, "tas", "hr", tiles=tiles, max_records_per_file=writers.records_per_file(3, 4))
    per_file = spark.read.parquet(root).groupBy(F.input_file_name().alias("f")).agg(
        F.count_distinct(F.floor(F.col("rlat") / 2), F.floor(F.col("rlon") / 2)).alias("tiles"), F.count_distinct("time").alias("steps"), F.count(F.lit(1)).alias("n"))
    assert [(r.tiles, r.steps, r.n) for r in per_file.collect()] == [(1, 3, 12)] * 8
    assert writers.tile_sides({"rlat": -1, "rlon": "auto"}) == {}
