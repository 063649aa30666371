import datetime as dt

import numpy as np
import pytest
from pyspark.sql import functions as F

from gridloom.config import Variable
from gridloom.functions import compile_transform, scalars, transform_column
from gridloom.operators import aggregate, scale


def col_values(df, c):
    picked = df.select(df.columns[c]) if isinstance(c, int) else df.select(c)
    return [r[0] for r in picked.collect()]


def values_of(df, column):
    return [r[0] for r in df.select(column.alias("out")).collect()]


@pytest.mark.parametrize("name,values,transform,expect", [
    ("temperature", [15, 20, 25], ["x*2"], [30, 40, 50]),
    ("rainfall", [10, 15, 20], ["x+5"], [15, 20, 25]),
    ("temperature", [15, 20, 25], [], [15, 20, 25]),
    ("temperature", [15, 20, 25], None, [15, 20, 25]),
    ("temperature", [15, 20, 25], "x - 10", [5, 10, 15]),
    ("temperature", [300.15], ["x - 273.15", "x * 2"], [54.0]),
])
def test_user_defined_transform(spark, name, values, transform, expect):
    kind = "double" if any(isinstance(v, float) for v in values) else "int"
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"time int, {name} {kind}")
    out = scale.user_defined_transform(df, Variable(name, transform=transform))
    got = col_values(out.orderBy("time"), name)
    assert np.allclose(got, expect)


def test_transform_empty_frame(spark):
    df = spark.range(0).select()
    assert scale.user_defined_transform(df, Variable("t", transform=["x*2"])).columns == []


def test_transform_syntax_error(spark):
    df = spark.createDataFrame([(15,)], "temperature int")
    with pytest.raises(SyntaxError):
        scale.user_defined_transform(df, Variable("temperature", transform=["x**"]))


def test_transform_missing_variable(spark):
    df = spark.createDataFrame([(15,)], "temperature int")
    with pytest.raises(KeyError):
        scale.user_defined_transform(df, Variable("rainfall", transform=["x*2"]))


@pytest.mark.parametrize("expr", [
    "x - 273.15", "x * 3600", "np.log1p(np.abs(x)) * 2 - x ** 2 / 3",
    "np.where(x > 0, x, 0)", "np.clip(x, -1, 1)", "np.sqrt(np.abs(x)) + np.exp(-x)",
    "(x // 2) + (x % 3)", "-x + +x * 2", "np.maximum(x, 0.5) - np.minimum(x, 0.5)",
    "x / 4 + np.pi",
])
def test_transform_matches_numpy(spark, expr):
    xs = [-3.5, -1.0, 0.0, 0.25, 1.0, 2.0, 7.5]
    df = spark.createDataFrame([(x,) for x in xs], "x double")
    got = values_of(df, transform_column(F.col("x"), [expr]))
    ns = {"np": np}
    want = [eval(expr, ns, {"x": np.float64(x)}) for x in xs]  # test oracle only
    assert np.allclose(got, want)


def test_transform_domain_errors_are_missing(spark):
    df = spark.createDataFrame([(0.0,), (-1.0,)], "x double")
    got = values_of(df, transform_column(F.col("x"), ["np.log(x) + 1 / x"]))
    assert got == [None, None]


def test_transform_unknown_name():
    with pytest.raises(NameError):
        compile_transform("y + 1", F.col("x"))


def test_transform_rejects_calls_outside_whitelist():
    with pytest.raises(ValueError):
        compile_transform("__import__('os').system('true')", F.col("x"))


@pytest.mark.parametrize("values,mean,std,expect", [
    ([1, 2, 3], 2.0, 1.0, [-1.0, 0.0, 1.0]),
    ([10, 20, 30], 20.0, 10.0, [-1.0, 0.0, 1.0]),
    ([0, 0, 0], 0.0, 1.0, [0.0, 0.0, 0.0]),
    ([-1, 0, 1], 0.0, 1.0, [-1.0, 0.0, 1.0]),
])
def test_standardize(spark, values, mean, std, expect):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, x int")
    got = values_of(df.orderBy("i"), scalars.standardize("x", mean, std))
    assert np.allclose(got, expect)


@pytest.mark.parametrize("mean,std,err", [(0.0, 0.0, ZeroDivisionError), ("a", 1.0, TypeError),
                                          (1.0, "a", TypeError)])
def test_standardize_errors(mean, std, err):
    with pytest.raises(err):
        scalars.standardize("x", mean, std)


def frame(spark, name, data):
    return spark.createDataFrame([(float(v),) for v in data], f"{name} double")


def rng_array(n):
    return np.random.default_rng(42).random(n)


@pytest.mark.parametrize("name,data", [("var1", np.arange(10)), ("var2", rng_array(100))])
def test_fit_standardization(spark, name, data):
    _, attrs = scale.compute_standardization(frame(spark, name, data), name)
    assert np.isclose(attrs.mean, data.mean()) and np.isclose(attrs.std, data.std())


def test_precomputed_standardization(spark):
    df = frame(spark, "var2", np.arange(10))
    out, attrs = scale.compute_standardization(df, "var2", {"var2": {"mean": 0.0, "std": 1.0}})
    assert (attrs.mean, attrs.std) == (0.0, 1.0)
    assert col_values(out, "var2") == list(map(float, range(10)))


@pytest.mark.parametrize("name,pre,err", [
    ("var1", None, ZeroDivisionError),                           # ones: std 0
    ("var1", {"var1": {"mean": 0.0, "std": 0.0}}, ZeroDivisionError),
    ("var1", {"var1": {"mean": 5.0}}, KeyError),
    ("var2", {"var1": {"mean": 0.0, "std": 0.0}}, KeyError),
])
def test_standardization_errors(spark, name, pre, err):
    data = np.ones(10) if pre is None else np.arange(10)
    with pytest.raises(err):
        scale.compute_standardization(frame(spark, name, data), name, pre)


@pytest.mark.parametrize("name,data", [("var1", np.arange(10)), ("var2", rng_array(100))])
def test_fit_normalization(spark, name, data):
    out, attrs = scale.compute_normalization(frame(spark, name, data), name)
    assert np.isclose(attrs.min, data.min()) and np.isclose(attrs.max, data.max())
    got = np.array(col_values(out, name))
    assert np.isclose(got.min(), 0.0) and np.isclose(got.max(), 1.0)


def test_precip_log_scale(spark):
    data = [0.0, 0.001, 1.0, 10.0]
    out, attrs = scale.compute_normalization(frame(spark, "pr", data), "pr",
                                             {"pr": {"min": 0.0, "max": 1.0}})
    eps = 1e-3
    want = [(np.log(x + eps) - np.log(eps)) / (np.log(1.0 + eps) - np.log(eps)) for x in data]
    assert np.allclose(col_values(out, "pr"), want)
    assert (attrs.min, attrs.max) == (0.0, 1.0)


def test_precip_log_below_domain_is_missing(spark):
    out, _ = scale.compute_normalization(frame(spark, "pr", [-0.001, -1.0]), "pr",
                                         {"pr": {"min": 0.0, "max": 1.0}})
    assert col_values(out, "pr") == [None, None]


@pytest.mark.parametrize("name,pre,err", [
    ("var1", None, ZeroDivisionError),
    ("var1", {"var1": {"min": 0.0, "max": 0.0}}, ZeroDivisionError),
    ("var1", {"var1": {"min": 5.0}}, KeyError),
    ("var2", {"var1": {"min": 0.0, "max": 0.0}}, KeyError),
])
def test_normalization_errors(spark, name, pre, err):
    data = np.ones(10) if pre is None else np.arange(10)
    with pytest.raises(err):
        scale.compute_normalization(frame(spark, name, data), name, pre)


@pytest.fixture(scope="module")
def field30(spark):
    data = np.random.default_rng(42).random((30, 30, 3))
    rows = [(dt.datetime(2000 + k, 1, 1), i, j, float(data[i, j, k]))
            for i in range(30) for j in range(30) for k in range(3)]
    return spark.createDataFrame(rows, "time timestamp_ntz, rlat int, rlon int, var double"), data


@pytest.mark.parametrize("std_flag,norm_flag", [(True, False), (False, False), (False, True),
                                                (True, True)])
def test_split_and_scale(field30, std_flag, norm_flag):
    df, data = field30
    var = Variable("var", transform=[], apply_standardize=std_flag, apply_normalize=norm_flag)
    out, attrs = scale.split_and_scale(df, var, [2000], [2001])
    train = data[:, :, 2].ravel()
    if not std_flag and not norm_flag:
        assert attrs == {}
        assert out.where("split = 'train'").agg(F.sum("var")).first()[0] == pytest.approx(train.sum())
        return
    if std_flag:
        assert np.isclose(attrs["mean"], train.mean()) and np.isclose(attrs["std"], train.std())
    z = out.where("split = 'train'").agg(F.avg("var"), F.stddev_pop("var"), F.min("var"),
                                         F.max("var")).first()
    if std_flag and not norm_flag:
        assert abs(z[0]) < 1e-12 and np.isclose(z[1], 1.0)
    if norm_flag:
        assert np.isclose(z[2], 0.0) and np.isclose(z[3], 1.0)
    test = out.where("split = 'test'").agg(F.count("var")).first()[0]
    assert test == 900


def test_both_flags_normalize_standardized(field30):
    df, data = field30
    var = Variable("var", apply_standardize=True, apply_normalize=True)
    out, attrs = scale.split_and_scale(df, var, [2000], [2001])
    train = data[:, :, 2].ravel()
    z = (train - train.mean()) / train.std()
    assert np.isclose(attrs["min"], z.min()) and np.isclose(attrs["max"], z.max())
    got = np.sort(np.array(col_values(out.where("split = 'test'"), "var")))
    want = np.sort(((data[:, :, 0].ravel() - train.mean()) / train.std() - z.min()) / (z.max() - z.min()))
    assert np.allclose(got, want)


def test_empty_train_gives_null(spark):
    df = spark.createDataFrame([(dt.datetime(2000, 1, 1), 1.0)], "time timestamp_ntz, v double")
    out, attrs = scale.split_and_scale(df, Variable("v"), [2000], [2001])
    assert attrs["mean"] is None
    assert out.where("split = 'test'").first()["v"] is None


def test_stats_skip_missing(spark):
    df = spark.createDataFrame([(1.0,), (None,), (3.0,)], "v double")
    st = aggregate.fit_stats(df.withColumn("v", scalars.nan_to_null("v")), "v")
    assert (st.mean, st.std, st.min, st.max, st.count) == (2.0, 1.0, 1.0, 3.0, 2)


def test_nan_treated_as_missing(spark):
    df = spark.createDataFrame([(1.0,), (float("nan"),), (3.0,)], "v double")
    st = aggregate.fit_stats(df.withColumn("v", scalars.nan_to_null("v")), "v")
    assert st.mean == 2.0 and st.count == 2


@pytest.mark.parametrize("expr,err", [("1 / (x - 1)", ZeroDivisionError), ("x // 0", ZeroDivisionError),
                                      ("x % (x - 1)", ZeroDivisionError)])
def test_transform_trial_at_one_raises(expr, err):
    with pytest.raises(err):
        compile_transform(expr, F.col("x"))


def test_transform_trial_numpy_only_warns(spark):
    # numpy scalars do not raise at x = 1.0; the values are missing where undefined
    df = spark.createDataFrame([(1.0,), (2.0,)], "x double")
    got = values_of(df, transform_column(F.col("x"), ["np.log(x - 1)"]))
    assert got[0] is None and got[1] == pytest.approx(0.0)


def test_split_and_standardize_dict(field30):
    from gridloom import api
    df, data = field30
    parts = api.split_and_standardize(df, Variable("var"), [2000], [2001])
    assert set(parts) == {"train", "test", "validation"}
    for name, (frame, attrs) in parts.items():
        assert "split" not in frame.columns and frame.count() == 900
        assert attrs["mean"] == pytest.approx(data[:, :, 2].mean())
    assert api.coarsen_lr(df, 2, "var").count() == 3 * 15 * 15


@pytest.mark.parametrize("expr", ["np.clip(x, 0, 10)", "np.where(x < 0, np.nan, x)", "(x > 1) & (x < 3)", "(x > 2) | (x == 0)", "~(x > 1)", "(x > 1) ^ (x < 3)",
                                  "x != 2", "np.where((x != 2) & ~(x < 0), x, -1)", "np.minimum(x, np.inf)"])
def test_missing_values_and_logic_equal_numpy(spark, expr):
    values = [-5.0, 0.0, 1.0, 2.0, 2.5, 30.0, float("nan")]
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v double").withColumn("v", F.nanvl("v", F.lit(None).cast("double")))
    got = [r.o for r in rows.select("i", transform_column(F.col("v"), [expr]).alias("o")).orderBy("i").collect()]
    want = np.asarray(eval(expr, {"np": np, "x": np.array(values)}), float)
    assert [None if np.isnan(w) else w for w in want.tolist()] == got


def test_logic_needs_comparisons():
    with pytest.raises(ValueError):
        transform_column(F.col("x"), ["x & 1"])
