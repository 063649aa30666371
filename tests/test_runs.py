"""A run replaces the rows of the run before, or leaves them (K1, K2, K5, K7)."""

import datetime as dt
import glob
import os

import pytest
from pyspark.sql import functions as F

from gridloom.sinks import runs, writers


def splits(spark, years, broken=False):
    rows = [("train" if y % 2 else "test", dt.datetime(y, 1, 1), 0, x, float(y)) for y in years for x in range(3)]
    df = spark.createDataFrame(rows, "split string, time timestamp_ntz, rlat int, rlon int, tas double")
    if broken:
        df = df.withColumn("tas", F.when(F.col("rlon") < 2, F.col("tas")).otherwise(F.raise_error(F.lit("lost on the way")).cast("double")))
    return df


def years(df):
    return sorted({r.year for r in df.select("year").distinct().collect()})


@pytest.fixture
def written(spark, tmp_path):
    root = str(tmp_path / "out")
    writers.write_splits(splits(spark, [2000, 2001]), root, "tas", "hr", attrs={"mean": 1.0})
    return root


def current(spark, root):
    return writers.read_pairs(spark, root, [("tas", "hr")])


def test_a_run_that_fails_leaves_rows_and_attributes(spark, written):
    with pytest.raises(Exception, match="lost on the way"):
        writers.write_splits(splits(spark, [2001, 2002], broken=True).repartition(3), written, "tas", "hr", attrs={"mean": 2.0})
    assert years(current(spark, written)) == years(spark.read.parquet(written)) == [2000, 2001]
    assert writers.read_attrs(spark, writers.pair_path(written, "tas", "hr"))["mean"] == 1.0


@pytest.mark.parametrize("at", ["switch", "data_files"])
def test_a_run_that_is_killed_after_its_write_leaves_the_old_rows(spark, written, monkeypatch, at):
    """Killed between the commit of the files and the switch: readers still see the old rows; the next run cleans up."""
    def killed(*args, real=getattr(runs, at), calls=[]):  # noqa: B006
        calls.append(1)
        if at == "switch" or len(calls) == 2:
            raise KeyboardInterrupt
        return real(*args)

    with monkeypatch.context() as m:
        m.setattr(runs, at, killed)
        with pytest.raises(KeyboardInterrupt):
            writers.write_splits(splits(spark, [2003]), written, "tas", "hr", attrs={"mean": 3.0})
    assert years(current(spark, written)) == [2000, 2001] and current(spark, written).count() == 6
    assert writers.read_attrs(spark, writers.pair_path(written, "tas", "hr"))["mean"] == 1.0
    writers.write_splits(splits(spark, [2004]), written, "tas", "hr", attrs={"mean": 4.0})
    assert years(current(spark, written)) == years(spark.read.parquet(written)) == [2004]
    assert writers.read_attrs(spark, writers.pair_path(written, "tas", "hr"))["mean"] == 4.0


def test_a_kill_while_old_files_are_removed_leaves_the_new_rows(spark, written, monkeypatch):
    real = runs.switch

    def then_killed(*args):
        real(*args)
        raise KeyboardInterrupt

    with monkeypatch.context() as m:
        m.setattr(runs, "switch", then_killed)
        with pytest.raises(KeyboardInterrupt):
            writers.write_splits(splits(spark, [2003]), written, "tas", "hr", attrs={"mean": 3.0})
    assert years(current(spark, written)) == [2003]
    assert writers.read_attrs(spark, writers.pair_path(written, "tas", "hr"))["mean"] == 3.0


def test_replaced_partitions_files_and_manifests_are_gone(spark, written):
    for y in (2005, 2007, 2008, 2009):
        writers.write_splits(splits(spark, [y]), written, "tas", "hr")
    pair = writers.pair_path(written, "tas", "hr")
    assert [os.path.basename(p) for p in glob.glob(f"{pair}/split=*/year=*")] == ["year=2009"]
    assert not glob.glob(f"{pair}/split=test")
    assert len(glob.glob(f"{pair}/_runs/*.json")) == 2 and not glob.glob(f"{pair}/_runs/*.draft")
    assert len({runs.token_of(f) for f in runs.data_files(spark, pair)}) == 1


def test_pairs_of_several_runs_and_without_manifest(spark, written):
    writers.write_splits(splits(spark, [2010]), written, "tas", "lr")
    plain = writers.neutral(splits(spark, [2011]), "tas").withColumn("year", F.year("time").cast("int"))
    plain.write.partitionBy("split", "year").parquet(writers.pair_path(written, "tas", "old"))
    rows = writers.read_pairs(spark, written, writers.stored_pairs(spark, written))
    assert {(r.model, r.year) for r in rows.collect()} == {("hr", 2000), ("hr", 2001), ("lr", 2010), ("old", 2011)}
    assert {r.model for r in rows.where("variable = 'tas'").collect()} == {"hr", "lr", "old"}


def test_samples_and_datasets_are_replaced_the_same_way(spark, tmp_path, monkeypatch):
    rows = spark.createDataFrame([("train", "2000-01-01-00", [1.0])], "split string, key string, tensor array<double>")
    writers.write_samples(rows, str(tmp_path / "s"), "tas", "hr")
    path = str(tmp_path / "d")
    writers.write_dataset(rows, path)
    monkeypatch.setattr(runs, "switch", lambda *a: (_ for _ in ()).throw(KeyboardInterrupt()))
    for write in (lambda: writers.write_samples(rows.withColumn("key", F.lit("new")), str(tmp_path / "s"), "tas", "hr"), lambda: writers.write_dataset(rows.withColumn("key", F.lit("new")), path)):
        with pytest.raises(KeyboardInterrupt):
            write()
    assert [r.key for r in writers.read_pairs(spark, str(tmp_path / "s"), [("tas", "hr")]).collect()] == ["2000-01-01-00"]
    assert [r.key for r in runs.read_dataset(spark, path).collect()] == ["2000-01-01-00"]
    assert runs.manifest(spark, str(tmp_path / "nothing")) is None and runs.data_files(spark, str(tmp_path / "nothing")) == []
