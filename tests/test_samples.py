import datetime as dt
import hashlib

import numpy as np
import pytest
from pyspark.errors import PythonException
from pyspark.sql import functions as F

from gridloom.functions import scalars
from gridloom.operators import samples, tensors
from gridloom.sources import fixtures

from conftest import SF_SMALL

T0 = dt.datetime(2000, 1, 1)


def keys_frame(spark, n, split="train"):
    ks = [(split, (T0 + dt.timedelta(hours=h)).strftime("%Y-%m-%d-%H")) for h in range(n)]
    return spark.createDataFrame(ks, "split string, key string")


def test_tensor_round_trip(spark):
    g = fixtures.dense_field(spark, SF_SMALL)
    packed = tensors.pack(g, "v", 8, 8, element_type="double")
    back = tensors.unpack(packed, "v")
    assert back.exceptAll(g).count() == 0 and g.exceptAll(back).count() == 0
    again = tensors.pack(back, "v", 8, 8, element_type="double")
    assert again.exceptAll(packed).count() == 0


def test_row_major_order(spark):
    rows = [(T0, y, x, float(y * 3 + x)) for y in range(2) for x in range(3)]
    df = spark.createDataFrame(rows[::-1], "time timestamp_ntz, rlat int, rlon int, v double")
    t = tensors.pack(df, "v", 2, 3).first()
    assert list(t.tensor) == [0, 1, 2, 3, 4, 5] and (t.ny, t.nx) == (2, 3)


def test_incomplete_sample_raises(spark):
    rows = [(T0, 0, 0, 1.0), (T0, 0, 1, None), (T0, 1, 0, 1.0), (T0, 1, 1, 1.0)]
    df = spark.createDataFrame(rows, "time timestamp_ntz, rlat int, rlon int, v double")
    with pytest.raises(Exception, match="missing or duplicate"):
        samples.samples(df, "v", 2, 2).collect()


def test_same_hour_steps_raise(spark):
    rows = [(T0 + dt.timedelta(minutes=m), 0, 0, 1.0) for m in (0, 30)]
    df = spark.createDataFrame(rows, "time timestamp_ntz, rlat int, rlon int, v double")
    with pytest.raises(PythonException, match="holds more than 1 cells"):
        samples.samples(df, "v", 1, 1).collect()


def test_copies_and_off_grid_cells_raise_before_packing(spark):
    rows = [(T0, y, x, 1.0) for y in range(2) for x in range(2)]
    df = spark.createDataFrame(rows * 3, "time timestamp_ntz, rlat int, rlon int, v double")
    with pytest.raises(PythonException, match="holds more than 4 cells"):
        tensors.pack(df, "v", 2, 2).collect()
    off = spark.createDataFrame(rows[:3] + [(T0, 5, 0, 1.0)], df.schema)
    with pytest.raises(PythonException, match="off the 2x2 grid"):
        tensors.pack(off, "v", 2, 2).collect()
    twice = spark.createDataFrame(rows[:3] + rows[:1], df.schema)
    for check in (True, False):
        with pytest.raises(PythonException, match="duplicate cells"):
            tensors.pack(twice, "v", 2, 2, check=check).collect()


def test_unchecked_packing_leaves_nulls_in_place(spark):
    rows = [(T0, 1, 1, 4.0), (T0, 0, 0, 1.0), (T0, 1, 0, None), (T0 + dt.timedelta(hours=1), 0, 1, 2.0)]
    df = spark.createDataFrame(rows, "time timestamp_ntz, rlat int, rlon int, v double")
    got = {r.time: list(r.tensor) for r in tensors.pack(df, "v", 2, 2, check=False).collect()}
    assert got == {T0: [1.0, None, None, 4.0], T0 + dt.timedelta(hours=1): [None, 2.0, None, None]}


def test_packing_is_one_pass_without_collected_lists(spark):
    """Steps of several batches stream into one tensor; the plan collects nothing, and the call runs no job."""
    g = spark.range(0, 3 * 150 * 150).select((F.lit(T0) + F.expr("make_dt_interval(0, cast(id % 3 as int))")).alias("time"),
                                             (F.col("id") / 3 % 150).cast("int").alias("rlat"), (F.col("id") / 450).cast("int").alias("rlon"), F.col("id").cast("double").alias("v"))
    before = spark.sparkContext.statusTracker().getJobIdsForGroup(None)
    packed = tensors.pack(g, "v", 150, 150, element_type="double")
    assert spark.sparkContext.statusTracker().getJobIdsForGroup(None) == before
    plan = packed._jdf.queryExecution().optimizedPlan().toString()
    assert "collect_list" not in plan
    back = tensors.unpack(packed, "v")
    assert back.exceptAll(g).count() == 0 and back.count() == g.count()

def test_sample_keys(spark):
    df = spark.createDataFrame([(dt.datetime(2001, 2, 3, 4, 0), 0, 0, 1.0)],
                               "time timestamp_ntz, rlat int, rlon int, v double")
    assert samples.samples(df, "v", 1, 1).first().key == "2001-02-03-04"


def test_batches_of_ten(spark):
    a = samples.assign_batches(keys_frame(spark, 10), 4, seed=0, group=("split",))
    sizes = sorted(r["n"] for r in samples.batch_names(a, ("split",)).collect())
    assert sizes == [2, 4, 4]
    assert sorted(r.pos for r in a.collect()) == list(range(10))


def test_batch_size_must_be_positive(spark):
    with pytest.raises(ValueError):
        samples.assign_batches(keys_frame(spark, 3), 0)


def test_permutation_matches_brute_force(spark):
    n = 10_000
    a = samples.assign_batches(keys_frame(spark, n), 12, seed=7, group=("split",))
    got = {r.key: r.pos for r in a.collect()}
    keys = [(T0 + dt.timedelta(hours=h)).strftime("%Y-%m-%d-%H") for h in range(n)]
    order = sorted(keys, key=lambda k: (hashlib.md5(f"7|{k}".encode()).hexdigest(), k))
    assert got == {k: i for i, k in enumerate(order)}


def test_same_keys_same_order_across_groups(spark):
    k = keys_frame(spark, 50, "train").union(keys_frame(spark, 50, "test"))
    a = samples.assign_batches(k, 4, seed=0, group=("split",))
    by = {}
    for r in a.collect():
        by.setdefault(r.split, {})[r.key] = r.pos
    assert by["train"] == by["test"]


def test_sorted_order_when_not_randomized(spark):
    a = samples.assign_batches(keys_frame(spark, 30), 4, group=("split",), randomize=False)
    got = sorted((r.pos, r.key) for r in a.collect())
    assert [k for _, k in got] == sorted(k for _, k in got)


def test_batch_tensors_and_names(spark):
    g = fixtures.dense_field(spark, SF_SMALL).where(F.col("time") < F.lit("2000-02-10").cast("timestamp_ntz"))
    s = samples.samples(g.withColumn("split", F.lit("train")), "v", 8, 8, group=("split",))
    a = samples.assign_batches(s.select("split", "key"), 4, group=("split",))
    b = samples.batches(s, a, group=("split",)).collect()
    n = s.count()
    assert sum(len(r.tensors) for r in b) == n
    for r in b:
        assert r.name == "__".join(r.keys)
        assert all(len(t) == 64 for t in r.tensors)


def test_batch_with_nan_raises(spark):
    rows = [("train", "k1", [1.0, float("nan")]), ("train", "k2", [1.0, 2.0])]
    s = spark.createDataFrame(rows, "split string, key string, tensor array<float>")
    a = samples.assign_batches(s.select("split", "key"), 4, group=("split",))
    with pytest.raises(Exception, match="missing values"):
        samples.batches(s, a, group=("split",)).collect()


def test_rain_mask_values(spark):
    thr = scalars.rain_threshold()
    assert thr == pytest.approx(-0.0769779160618782 / 0.3726992905139923)
    df = spark.createDataFrame([(thr - 1e-9,), (thr,), (thr + 1e-9,), (None,)], "v double")
    assert [r[0] for r in df.select(scalars.rain_mask("v")).collect()] == [0, 0, 1, 0]


def test_mask_tensors(spark):
    s = spark.createDataFrame([("train", "2000-01-01-00", [-1.0, 0.0, 5.0])],
                              "split string, key string, tensor array<double>")
    m = samples.masks(s).first()
    assert m.key == "mask_2000-01-01-00" and list(m.tensor) == [0, 1, 1]


def test_pair_samples(spark):
    lr = spark.createDataFrame([("train", "a", [1.0]), ("train", "b", [2.0])],
                               "split string, key string, tensor array<double>")
    hr = spark.createDataFrame([("train", "a", [3.0, 4.0]), ("test", "a", [5.0, 6.0])],
                               "split string, key string, tensor array<double>")
    p = samples.pair_samples(lr, hr).collect()
    assert len(p) == 1 and list(p[0].hr_tensor) == [3.0, 4.0]


def test_path_stems(spark):
    df = spark.createDataFrame([("a/b/tas_2000-01-01-00.pt",)], "p string")
    r = df.select(scalars.path_stem("p"), scalars.path_basename("p")).first()
    assert tuple(r) == ("tas_2000-01-01-00", "tas_2000-01-01-00.pt")


def test_lead_shift(spark):
    df = spark.createDataFrame([(T0, lv) for lv in (1, 2, 12)], "time timestamp_ntz, level int")
    got = [r[0] for r in df.select(scalars.lead_shift("time", "level")).collect()]
    assert got == [T0, T0 + dt.timedelta(hours=1), T0 + dt.timedelta(hours=11)]


def test_group_sizes_bounded_by_grid(spark):
    """Packing groups hold ny*nx cells whatever the data volume."""
    g = fixtures.dense_field(spark, SF_SMALL)
    sizes = g.groupBy("time").count().agg(F.max("count")).first()[0]
    assert sizes == 64
    assert np.isfinite(tensors.pack(g, "v", 8, 8).count())


def test_assert_unique_keys_reads_times_only(spark):
    rows = [(T0 + dt.timedelta(minutes=m), y, 0, 1.0) for m in (0, 30) for y in range(2)]
    df = spark.createDataFrame(rows, "time timestamp_ntz, rlat int, rlon int, v double")
    with pytest.raises(ValueError, match="share the sample key 2000-01-01-00"):
        samples.assert_unique_keys(df)
    samples.assert_unique_keys(df.where(F.minute("time") == 0))     # one step per hour: fine
