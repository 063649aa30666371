"""The cut and unfold steps of the command line."""

import datetime as dt

from pyspark.sql import functions as F

from gridloom import cli
from gridloom.plans import cuts
from gridloom.sinks import runs

CONFIG = """
data_dir: {src}
output_dir: {out}
variables:
  - {{name: pr_1hr.nc, start_date: 20010102, end_date: 20010103}}
  - {{name: absent_1hr.nc, start_date: 20010102, end_date: 20010103}}
  - {{name: tas_1hr.nc, start_date: 20010101, end_date: 20010101}}
lat_min: 46.5
lat_max: 48
lon_min: 209
lon_max: 211
"""


def test_cut_then_unfold(spark, tmp_path):
    src, out, cfg = tmp_path / "src", tmp_path / "out", tmp_path / "cdo.yaml"
    rows = [(dt.datetime(2001, 1, d, h), lead, y, x, 46.0 + y, 208.0 + x - (360 if x == 2 else 0), float(100 * d + 10 * lead + y + x))
            for d in (1, 2, 3, 4) for h in (6, 18) for lead in (1, 2, 12) for y in range(4) for x in range(4)]
    df = spark.createDataFrame(rows, "time timestamp_ntz, level int, rlat int, rlon int, lat double, lon double, pr double")
    df.write.parquet(str(src / "pr_1hr.nc"))
    df.where("level = 1").drop("level").withColumnRenamed("pr", "tas").write.parquet(str(src / "tas_1hr.nc"))
    cfg.write_text(CONFIG.format(src=src, out=out))
    cli.main(["cut", str(cfg)])
    cli.main(["unfold", str(cfg)])
    assert sorted(p.name for p in out.iterdir()) == ["pr_1hr_time_sliced_cropped", "pr_1hr_time_sliced_cropped_merged_forecast_time", "tas_1hr_time_sliced_cropped"]
    pr = runs.read_dataset(spark, f"{out}/pr_1hr{cuts.CUT}")
    kept = [r for r in rows if r[0].day in (2, 3) and r[2] in (1, 2) and r[3] in (1, 2, 3)]
    assert sorted((r.time, r.level, r.rlat, r.rlon, r.pr) for r in pr.collect()) == sorted((t, lev, y - 1, x - 1, v) for t, lev, y, x, _, _, v in kept)
    unfolded = runs.read_dataset(spark, f"{out}/pr_1hr{cuts.CUT}{cuts.UNFOLDED}")
    assert sorted((r.time, r.level, r.rlat, r.rlon, r.pr) for r in unfolded.collect()) == sorted((t + dt.timedelta(hours=lev - 1), 0, y - 1, x - 1, v) for t, lev, y, x, _, _, v in kept)
    tas = runs.read_dataset(spark, f"{out}/tas_1hr{cuts.CUT}")
    assert tas.agg(F.min("time"), F.max("time")).first() == (dt.datetime(2001, 1, 1, 6), dt.datetime(2001, 1, 1, 18))
