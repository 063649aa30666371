import datetime as dt

import pytest

from gridloom.config import Dimension, Variable
from gridloom.errors import MissingKey, MultipleKeys
from gridloom.operators import names

DIMS = [Dimension("time", ["Time"]), Dimension("rlat", ["rotated_latitude"]),
        Dimension("rlon", ["rotated_longitude"])]
COORDS = [Dimension("lat", ["Latitude"]), Dimension("lon", ["Longitude"])]
VAR = Variable("temperature", [], path="this/is/a/path", is_west_negative=False)


def test_rename_variable(spark):
    df = spark.createDataFrame([(0, 0, 1.0), (0, 1, 2.0)], "x int, y int, temperature double")
    out = names.configure_metadata(df, Variable("tas", ["temperature"]), DIMS, COORDS)
    assert out.columns == ["x", "y", "tas"]


def test_rename_noop_when_absent(spark):
    df = spark.createDataFrame([(0, 1.0)], "x int, other double")
    out = names.configure_metadata(df, VAR, DIMS, COORDS)
    assert out.columns == ["x", "other"]


def test_hr_ref_skips_squeeze(spark):
    df = spark.createDataFrame([(0, 0, 0, 0, 1.0)],
                               "extra_dim int, time int, rlat int, rlon int, temperature double")
    out = names.configure_metadata(df, Variable("hr_ref", ["temperature"]), DIMS, COORDS,
                                   frame_dims=["extra_dim", "time", "rlat", "rlon"])
    assert "extra_dim" in out.columns


def test_squeeze_singleton(spark):
    rows = [(0, t, y, x, float(y * 2 + x + 1)) for t in range(2) for y in range(2) for x in range(2)]
    df = spark.createDataFrame(rows, "extra_dim int, time int, rlat int, rlon int, temperature double")
    out = names.configure_metadata(df, VAR, DIMS, COORDS,
                                   frame_dims=["extra_dim", "time", "rlat", "rlon"])
    assert out.columns == ["time", "rlat", "rlon", "temperature"]
    assert out.count() == 8


def test_squeeze_keeps_multi_valued(spark):
    rows = [(e, 0, 0, 0, 1.0) for e in range(2)]
    df = spark.createDataFrame(rows, "extra_dim int, time int, rlat int, rlon int, temperature double")
    out = names.configure_metadata(df, VAR, DIMS, COORDS,
                                   frame_dims=["extra_dim", "time", "rlat", "rlon"])
    assert "extra_dim" in out.columns


def test_multiple_keys(spark):
    df = spark.createDataFrame([(1.0, 2.0)], "temperature double, wind_speed double")
    with pytest.raises(MultipleKeys):
        names.configure_metadata(df, Variable("tas", ["temperature", "wind_speed"]), DIMS, COORDS)


def test_collision_with_canonical(spark):
    df = spark.createDataFrame([(1.0, 2.0)], "tas double, temperature double")
    with pytest.raises(MultipleKeys):
        names.rename_keys(df, Variable("tas", ["temperature"]))


def test_missing_key_when_required(spark):
    df = spark.createDataFrame([(1.0,)], "other double")
    with pytest.raises(MissingKey):
        names.rename_keys(df, Variable("tas", ["temperature"]), required=True)


def test_rename_dims_and_coords(spark):
    df = spark.createDataFrame([(dt.datetime(2000, 1, 1), 0, 0, 1.0, 2.0, 3.0)],
                               "Time timestamp_ntz, rotated_latitude int, rotated_longitude int, "
                               "Latitude double, Longitude double, T2 double")
    out = names.configure_metadata(df, Variable("tas", ["T2"]), DIMS, COORDS)
    assert out.columns == ["time", "rlat", "rlon", "lat", "lon", "tas"]


def test_case_sensitive_matching(spark):
    df = spark.createDataFrame([(1.0,)], "time double")
    out = names.rename_all(df, [Dimension("time", ["TIME"])])
    assert out.columns == ["time"]


@pytest.mark.parametrize("lons,west_negative,expect", [
    ([0.0, 1.0], False, [0.0, 1.0]),
    ([-180.0, 0.0], True, [180.0, 360.0]),
])
def test_match_longitudes(spark, lons, west_negative, expect):
    grid = spark.createDataFrame([(i, v) for i, v in enumerate(lons)], "rlon int, lon double")
    out = names.match_longitudes(grid) if west_negative else grid
    got = [r.lon for r in out.orderBy("rlon").collect()]
    assert got == expect
    assert min(got) >= 0 and max(got) <= 360


def test_match_longitudes_error(spark):
    grid = spark.createDataFrame([(0, 1.0), (1, 181.0)], "rlon int, lon double")
    with pytest.raises(ValueError):
        names.match_longitudes(grid)


def test_set_level_then_squeeze(spark):
    df = spark.createDataFrame([(0, 1, 0, 0, 1.0), (0, 2, 0, 0, 2.0)],
                               "time int, level int, rlat int, rlon int, v double")
    out = names.squeeze_extra_dims(names.set_level(df), ["time", "level", "rlat", "rlon"],
                                   DIMS, COORDS, "v")
    assert "level" not in out.columns and out.count() == 2


def test_order_and_drop(spark):
    df = spark.createDataFrame([(1.0, 0, 0, 0, 5.0, 6.0)],
                               "v double, rlon int, rlat int, time int, lat double, lon double")
    out = names.order_dims(names.drop_coords(df))
    assert out.columns == ["time", "rlat", "rlon", "v"]


def test_load_config_yaml(tmp_path):
    from gridloom.config import load_config
    text = """
_target_: some.Target
output_path: /tmp/out
climate_models:
  - _target_: x.Model
    name: hr
    info: "HR"
    climate_variables:
      - _target_: x.Variable
        name: "U10"
        alternative_names: ["u10", "uas"]
        path: a/b.parquet
        is_west_negative: true
        invariant: false
  - _target_: x.Model
    name: lr
    info: "LR"
    hr_ref:
      _target_: x.Variable
      name: "hr_ref"
      alternative_names: ["T2"]
      path: ref.parquet
      is_west_negative: true
    climate_variables:
      - _target_: x.Variable
        name: "tas"
        alternative_names: ["T2"]
        path: lr.parquet
        is_west_negative: false
        apply_standardize: false
        apply_normalize: true
        transform: null
dims:
  - name: time
    alternative_names: ["Time"]
    chunksize: 100
coords:
  - name: lat
    alternative_names: ["latitude"]
select:
  time:
    range: {start: "20001001T06:00:00", end: "20150928T12:00:00"}
    test_years: [2000, 2009, 2014]
    validation_years: [2015]
  spatial:
    scale_factor: 8
    x: {first_index: 110, last_index: 622}
    y: {first_index: 20, last_index: 532}
loader: {batch_size: 12, randomize: true, seed: 0}
"""
    p = tmp_path / "c.yaml"
    p.write_text(text)
    cfg = load_config(str(p))
    assert [m.name for m in cfg.climate_models] == ["hr", "lr"]
    lr = cfg.climate_models[1]
    assert lr.hr_ref.name == "hr_ref" and lr.climate_variables[0].apply_normalize
    assert lr.climate_variables[0].transforms() == []
    assert cfg.time.test_years == [2000, 2009, 2014] and cfg.spatial.x.last_index == 622
    assert cfg.dims[0].chunksize == 100 and cfg.loader.batch_size == 12
