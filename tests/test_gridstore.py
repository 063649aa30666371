"""Grids are made once per run."""

import json
import re
import subprocess
import sys
import textwrap
from pathlib import Path

import pytest

from gridloom.sources import gridstore

from conftest import SF_SMALL

RUN = """
import sys
sys.path.insert(0, {repo!r})
from pyspark.sql import functions as F
from gridloom.config import DataConfig, IndexRange, Model, Spatial, TimeSelect, Variable, default_coords, default_dims
from gridloom.plans import preprocess
from gridloom.session import local_session
from gridloom.sources import fixtures

spark = local_session(cores=4, extra_conf={{"spark.eventLog.enabled": "true", "spark.eventLog.dir": "file://{tmp}/events", "spark.eventLog.compress": "false", "spark.eventLog.rolling.enabled": "false", "spark.sql.maxMetadataStringLength": "2000"}})
g = fixtures.dense_field(spark, {sf!r})
g.select(F.col("time").alias("Time"), "rlat", "rlon", (F.lit(46.0) + F.col("rlat")).alias("lat"), (F.lit(230.0) + F.col("rlon")).alias("lon"), F.col("v").alias("T2")).write.parquet("{tmp}/lr")
ref = fixtures.curvilinear_target(spark)
ref.crossJoin(spark.range(5).select(F.col("id").alias("step"))).withColumn("z", F.lit(0.0)).write.parquet("{tmp}/ref")
variables = [Variable(n, ["T2"], path="{tmp}/lr", apply_standardize=True) for n in ("tas", "uas", "vas")]
cfg = DataConfig(output_path="{tmp}/out", climate_models=[Model("lr", "test", variables, Variable("hr_ref", path="{tmp}/ref"))], dims=default_dims(), coords=default_coords(),
                 time=TimeSelect("20000201T00:00:00", "20050101T00:00:00", [2001], [2004]), spatial=Spatial(4, IndexRange(2, 10), IndexRange(2, 10)))
preprocess.preprocess(spark, cfg)
spark.stop()
"""


def test_reference_field_is_scanned_once_per_run(tmp_path):
    (tmp_path / "events").mkdir()
    code = textwrap.dedent(RUN).format(repo=str(Path(__file__).parents[1]), tmp=tmp_path, sf=SF_SMALL)
    subprocess.run([sys.executable, "-c", code], check=True, timeout=300, capture_output=True)
    plans = []
    for log in (tmp_path / "events").iterdir():
        for line in log.read_text().splitlines():
            event = json.loads(line)
            if event["Event"].endswith("SQLExecutionStart"):
                plans.append(event["physicalPlanDescription"])
    scans = {name: [s for p in plans for s in re.findall(rf"Location: \w+ \[file:{tmp_path}/{name}\]\n(?:.*\n){{0,5}}?ReadSchema: (.*)", p)] for name in ("ref", "lr")}
    assert len(scans["ref"]) == 1, scans
    assert sum("lat:double" in s for s in scans["lr"]) == 1, scans  # the source grid of three variables


def test_changed_files_and_other_readings_are_made_anew(spark, tmp_path):
    path, made = str(tmp_path / "f"), []

    def grid(how="a"):
        def make():
            made.append(how)
            return spark.read.parquet(path).distinct()
        return sorted(r.x for r in gridstore.stored_grid(spark, path, how, make).collect())

    spark.createDataFrame([(1,), (1,), (2,)], "x int").write.parquet(path)
    assert grid() == grid() == [1, 2] and made == ["a"]
    assert grid("b") == [1, 2] and made == ["a", "b"]
    spark.createDataFrame([(7,)], "x int").write.mode("append").parquet(path)
    assert grid() == [1, 2, 7] and made == ["a", "b", "a"]
    assert gridstore.file_key(spark, str(tmp_path / "none")) == gridstore.file_key(spark, [str(tmp_path / "none")])


def test_a_write_that_broke_off_is_made_again(spark, tmp_path):
    path = str(tmp_path / "f")
    spark.createDataFrame([(1,)], "x int").write.parquet(path)
    with pytest.raises(RuntimeError):
        gridstore.stored_grid(spark, path, "broken", lambda: (_ for _ in ()).throw(RuntimeError("lost")))
    assert gridstore.stored_grid(spark, path, "broken", lambda: spark.read.parquet(path)).count() == 1
