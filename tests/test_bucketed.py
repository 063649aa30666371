"""Bucketed sample tables and pairs without a shuffle."""

import pytest
from pyspark.sql import functions as F

from gridloom.operators import samples
from gridloom.sinks import bucketed, runs


def tensors(spark, keys, scale, n):
    rows = [(s, f"2000-01-{1 + k // 24:02d}-{k % 24:02d}", [scale * k + i for i in range(n)]) for k in keys for s in (["train", "test"] if k % 7 == 0 else ["train"])]
    return spark.createDataFrame(rows, "split string, key string, tensor array<double>")


def static_plan(spark, df):
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        return df._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")


@pytest.fixture
def root(spark, tmp_path):
    where = str(tmp_path / "samples")
    bucketed.write_bucketed(tensors(spark, range(40), 1.0, 2), where, "tas", "lr", buckets=5)
    bucketed.write_bucketed(tensors(spark, range(10, 60), -1.0, 8).withColumn("model", F.lit("hr")), where, "tas", "hr", buckets=5)
    return where


def test_pairs_are_those_of_the_join_and_nothing_is_exchanged(spark, root):
    got = bucketed.pair_bucketed(spark, root, ("tas", "lr"), ("tas", "hr"))
    plan = static_plan(spark, got)
    assert "Exchange" not in plan and "Sort" not in plan and "ShuffledHashJoin" in plan and plan.count("Bucketed: true") == 2
    want = samples.pair_samples(tensors(spark, range(40), 1.0, 2), tensors(spark, range(10, 60), -1.0, 8))
    key = lambda r: (r.split, r.key)
    assert sorted(map(tuple, got.collect()), key=str) == sorted(map(tuple, want.select(got.columns).collect()), key=str) and got.count() == 30 + 4
    only = bucketed.pair_bucketed(spark, root, ("tas", "lr"), ("tas", "hr"), splits=["test"])
    assert {key(r)[0] for r in only.collect()} == {"test"} and "Exchange" not in static_plan(spark, only)


def test_another_session_knows_the_buckets_from_the_manifest(spark, root):
    for model in ("lr", "hr"):
        folder = runs.manifest(spark, f"{root}/variable=tas/model={model}")["folder"]
        spark.sql(f"DROP TABLE {bucketed._table(folder)}")  # external: the files stay
    got = bucketed.pair_bucketed(spark, root, ("tas", "lr"), ("tas", "hr"))
    assert "Exchange" not in static_plan(spark, got) and got.count() == 34


def test_a_bucket_is_one_file_and_a_run_replaces_the_last(spark, root, monkeypatch):
    pair = f"{root}/variable=tas/model=lr"
    first = runs.manifest(spark, pair)["folder"]
    assert len(runs.data_files(spark, f"{pair}/{first}")) <= 5
    with monkeypatch.context() as m:
        m.setattr(runs, "switch", lambda *a: (_ for _ in ()).throw(KeyboardInterrupt()))
        with pytest.raises(KeyboardInterrupt):
            bucketed.write_bucketed(tensors(spark, range(3), 9.0, 2), root, "tas", "lr", buckets=5)
    assert bucketed.read_bucketed(spark, root, "tas", "lr").where("split = 'train'").count() == 40
    bucketed.write_bucketed(tensors(spark, range(3), 9.0, 2), root, "tas", "lr", buckets=5)
    assert bucketed.read_bucketed(spark, root, "tas", "lr").where("split = 'train'").count() == 3
    assert not runs.data_files(spark, f"{pair}/{first}")


def test_nothing_written_and_empty_tables(spark, root):
    with pytest.raises(FileNotFoundError):
        bucketed.read_bucketed(spark, root, "pr", "lr")
    bucketed.write_bucketed(tensors(spark, range(0, 1), 1.0, 2).limit(0), root, "tas", "lr", buckets=5)
    assert bucketed.pair_bucketed(spark, root, ("tas", "lr"), ("tas", "hr")).count() == 0
