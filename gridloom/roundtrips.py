"""Registered queries that write with the library's plans and read back what they wrote.

Each makes its input files from the driver's tables, runs a plan of the pipeline
into a folder of its own below the shared checkpoint folder, and returns the rows
that the library's readers give for it; the oracle computes them from the tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from . import catalog as C
from .config import DataConfig, IndexRange, Model, Spatial, TimeSelect, Variable, default_coords, default_dims
from .functions.scalars import RAIN_MEAN, RAIN_STD
from .operators import aggregate, samples, select
from .plans import preprocess
from .plans import samples as sample_plans
from .sinks import bucketed, runs, writers
from .sources import fixtures

# Fixed query parameters: crop of the 8x8 field and of the 12x12 reference grid, block side, files in time order.
CROP, FACTOR, FILES = (2, 6), 2, 16


def _inputs(spark: SparkSession, sf: str, folder: str) -> dict[str, str]:
    """G as a high-resolution source (its own names), as a low-resolution one (coordinates on every row), time-free, and the reference field."""
    g = fixtures.dense_field(spark, sf)
    where = {k: f"{folder}/{k}" for k in ("hr", "lr", "still", "ref")}
    lat, lon = (F.lit(46.0) + F.col("rlat")).alias("lat"), (F.lit(230.0) + F.col("rlon")).alias("lon")
    g.select(F.col("time").alias("Time"), "rlat", "rlon", F.col("v").alias("T2")).write.parquet(where["hr"])
    g.select(F.col("time").alias("Time"), "rlat", "rlon", lat, lon, F.col("v").alias("T2")).write.parquet(where["lr"])
    g.groupBy("rlat", "rlon").agg(F.avg("v").alias("H")).select("rlat", "rlon", lat, lon, "H").write.parquet(where["still"])
    fixtures.curvilinear_target(spark).withColumn("z", F.lit(0.0)).write.parquet(where["ref"])
    return where


def _run(spark: SparkSession, sf: str, kinds: tuple[str, ...], name: str = "tas") -> str:
    """``preprocess`` (P7) of models of the given kinds, their variable called ``name``; returns the output folder."""
    folder = C.work_folder(spark, "run")
    path = _inputs(spark, sf, folder)
    (start, end), _ = C.inner_window(fixtures.dense_field(spark, sf))
    ref = Variable("hr_ref", path=path["ref"])

    def field(source):
        return Variable(name, ["T2"], path=path[source], transform=["x * 100"], apply_standardize=True)

    height = Variable("orog", ["H"], path=path["still"], invariant=True)
    models = {"hr": Model("hr", "high", [field("hr")]), "lr": Model("lr", "low", [field("lr")], ref),
              "hr_invariant": Model("hr_invariant", "high", [height]), "lr_invariant": Model("lr_invariant", "low", [height], ref)}
    crop = IndexRange(*CROP)
    cfg = DataConfig(output_path=f"{folder}/out", climate_models=[models[k] for k in kinds], dims=default_dims(), coords=default_coords(),
                     time=TimeSelect(start, end, C.TEST_YEARS, C.VALIDATION_YEARS), spatial=Spatial(FACTOR, crop, crop))
    preprocess.preprocess(spark, cfg)
    return cfg.output_path


def q_written_splits(spark: SparkSession, sf: str) -> DataFrame:
    """Both models of a run (P7, with the reference grid of S6), written by split (K2) and opened again."""
    out = _run(spark, sf, ("hr", "lr"))
    rows = sample_plans.read_splits(spark, preprocess.split_root(out), ["tas"], ["hr", "lr"])
    return rows.select("model", "split", F.col("year").cast("int").alias("year"), "time", "rlat", "rlon", C.r6("value"))


_HR_SQL = f"""hr as (
  select time, cast(rlat - 2 as int) as rlat, cast(rlon - 2 as int) as rlon, v * 100.0 as v from g
  where time between {C.INNER_SQL} and rlon >= 2 and rlon < 6 and rlat >= 2 and rlat < 6)"""

_LR_SQL = f"""g2 as (select * from g where time between {C.INNER_SQL})""", C.T_SQL(), C.W_SQL, """r as (
  select g2.time, w.rlat, w.rlon, case when count(g2.v) = max(w.n_corners) then sum(g2.v * w.w) end as v
  from g2 join w on g2.rlat = w.sy and g2.rlon = w.sx group by all)""", """lr as (
  select time, cast((rlat - 2) // 2 as int) as rlat, cast((rlon - 2) // 2 as int) as rlon, avg(v) * 100.0 as v
  from r where rlat >= 2 and rlat < 6 and rlon >= 2 and rlon < 6 group by all)"""


def _model_sql(model: str) -> str:
    """The rows of one model by split, standardized with its training statistics."""
    return f"""select '{model}' as model, split, year(time) as year, time, rlat, rlon, round((v - mu) / sd, 6) as value
  from ({" union all ".join(f"select '{s}' as split, * from {model} where year(time) {cond}" for s, cond in (("train", "not in (2001, 2004)"), ("test", "= 2001"), ("validation", "= 2004")))}),
       (select avg(v) as mu, stddev_pop(v) as sd from {model} where year(time) not in (2001, 2004))"""


SQL_WRITTEN_SPLITS = C.with_(C.G_SQL, _HR_SQL, *_LR_SQL) + f"""select model, split, cast(year as int) as year, time, rlat, rlon, value
from ({_model_sql("hr")} union all {_model_sql("lr")})"""


def q_written_invariants(spark: SparkSession, sf: str) -> DataFrame:
    """Invariants of a high- and a low-resolution model, written without splits (K3) and read again."""
    root = preprocess.invariant_root(_run(spark, sf, ("hr_invariant", "lr_invariant")))
    rows = writers.read_pairs(spark, root, writers.stored_pairs(spark, root))
    return rows.select("variable", "model", "rlat", "rlon", C.r6("value"))


SQL_WRITTEN_INVARIANTS = C.with_(C.G_SQL, """gi as (select rlat, rlon, avg(v) as v from g group by all)""", C.T_SQL(), C.W_SQL, """r as (
  select w.rlat, w.rlon, case when count(gi.v) = max(w.n_corners) then sum(gi.v * w.w) end as v
  from gi join w on gi.rlat = w.sy and gi.rlon = w.sx group by all)""") + """
select 'orog' as variable, 'hr_invariant' as model, cast(rlat - 2 as int) as rlat, cast(rlon - 2 as int) as rlon, round(v, 6) as value
from gi where rlat >= 2 and rlat < 6 and rlon >= 2 and rlon < 6
union all select 'orog', 'lr_invariant', cast((rlat - 2) // 2 as int), cast((rlon - 2) // 2 as int), round(avg(v), 6)
from r where rlat >= 2 and rlat < 6 and rlon >= 2 and rlon < 6 group by all"""


def _sampled(spark: SparkSession, sf: str, name: str = "tas") -> str:
    """Samples (P8) of the splits of a run, with their statistics (K6); returns their root."""
    out = _run(spark, sf, ("hr",), name)
    side = CROP[1] - CROP[0]
    sample_plans.make_samples(spark, preprocess.split_root(out), f"{out}/samples", side, side)
    return f"{out}/samples"


def q_written_samples(spark: SparkSession, sf: str) -> DataFrame:
    """Samples made from written splits (P8, K5), with their names, sizes, and where the cells above the mean and the largest one are."""
    rows = writers.read_pairs(spark, _sampled(spark, sf), [("tas", "hr")])
    above = F.size(F.filter("tensor", lambda e: e > 0)).alias("n_above")
    return rows.select("split", "name", F.size("tensor").alias("n_cells"), above, F.array_position("tensor", F.array_max("tensor")).cast("int").alias("at_max"))


SQL_WRITTEN_SAMPLES = C.with_(C.G_SQL, _HR_SQL) + f"""select split, 'tas_' || strftime(time, '%Y-%m-%d-%H') as name, cast(count(*) as int) as n_cells,
cast(count(*) filter (value > 0) as int) as n_above, cast(arg_max(rlat * 4 + rlon + 1, value) as int) as at_max from ({_model_sql("hr")}) group by all"""


def q_listed_samples(spark: SparkSession, sf: str) -> DataFrame:
    """The written samples of every split in sorted order, with their number."""
    root, listed = _sampled(spark, sf), None
    for split in select.SPLITS:
        keys = sample_plans.list_samples(spark, root, "tas", "hr", split)
        numbered = keys.select(F.lit(split).alias("split"), "key", F.lit(keys.count()).cast("long").alias("n"))
        listed = numbered if listed is None else listed.unionByName(numbered)
    return listed


SQL_LISTED_SAMPLES = C.with_(C.G_SQL, _HR_SQL) + f"""select split, key, count(*) over (partition by split) as n
from (select distinct split, strftime(time, '%Y-%m-%d-%H') as key from ({_model_sql("hr")}))"""


def q_written_stats(spark: SparkSession, sf: str) -> DataFrame:
    """The training statistics written beside samples (K6), as rows (attribute, value)."""
    attrs = writers.read_attrs(spark, f"{_sampled(spark, sf)}/train/tas_train_hr_attrs")["attributes"]
    return spark.createDataFrame(sorted(attrs.items()), "attribute string, value double").select("attribute", C.r6("value"))


SQL_WRITTEN_STATS = C.with_(C.G_SQL, _HR_SQL) + """select 'mean' as attribute, round(avg(v), 6) as value from hr where year(time) not in (2001, 2004)
union all select 'std', round(stddev_pop(v), 6) from hr where year(time) not in (2001, 2004)"""


def q_written_batches(spark: SparkSession, sf: str) -> DataFrame:
    """Batches made from written samples (P9, W3, W4, K7): members in permuted order, and their cells."""
    root = _sampled(spark, sf)
    sample_plans.make_batches(spark, root, f"{root}_batched", C.BATCH_SIZE, C.SEED)
    rows = writers.read_pairs(spark, f"{root}_batched", [("tas", "hr")])
    above = F.aggregate("tensors", F.lit(0), lambda n, t: n + F.size(F.filter(t, lambda e: e > 0)))
    return rows.select("split", "batch_id", "name", F.size("tensors").alias("n"), above.alias("n_above"))


SQL_WRITTEN_BATCHES = C.with_(C.G_SQL, _HR_SQL, f"""s as ({_model_sql("hr")})""", """k as (
  select split, strftime(time, '%Y-%m-%d-%H') as key, count(*) filter (value > 0) as above from s group by all)""", """o as (
  select *, row_number() over (partition by split order by md5('0|' || key), key) - 1 as pos from k)""") + """
select split, cast(pos // 4 as bigint) as batch_id, string_agg('tas_' || key, '__' order by pos) as name,
cast(count(*) as int) as n, cast(sum(above) as int) as n_above from o group by all"""


def q_written_masks(spark: SparkSession, sf: str) -> DataFrame:
    """Masks made from written precipitation samples (P10, K8), as strings of 0 and 1."""
    root = _sampled(spark, sf, "pr")
    sample_plans.make_masks(spark, root, f"{root}_masks")
    rows = writers.read_pairs(spark, f"{root}_masks", [("pr_mask", "hr")])
    return rows.select("variable", "split", "key", F.array_join(F.transform("tensor", lambda e: e.cast("string")), "").alias("bits"))


SQL_WRITTEN_MASKS = C.with_(C.G_SQL, _HR_SQL) + f"""select 'pr_mask' as variable, split, 'mask_' || strftime(time, '%Y-%m-%d-%H') as key,
string_agg(case when value > {-RAIN_MEAN!r} / {RAIN_STD!r} then '1' else '0' end, '' order by rlat, rlon) as bits
from ({_model_sql("hr")}) group by all"""


def q_sorted_files(spark: SparkSession, sf: str) -> DataFrame:
    """G written in time order (W1): rows and steps of every file's range, and whether files overlap."""
    path = f"{C.work_folder(spark, 'sorted')}/g"
    writers.write_by_time(fixtures.dense_field(spark, sf), path, FILES)
    rows = runs.read_dataset(spark, path).withColumn("file", F.col("_metadata.file_name"))
    ranges = rows.groupBy("file").agg(F.min("time").alias("lo"), F.max("time").alias("hi"), F.count(F.lit(1)).alias("n"), F.count_distinct("time").alias("steps"))
    after = F.lead("lo").over(Window.orderBy("lo", "hi"))  # a row per file
    return ranges.withColumn("clash", F.coalesce(after <= F.col("hi"), F.lit(False)).cast("long")).agg(
        F.sum("n").alias("n"), F.sum("steps").alias("steps"), F.sum("clash").alias("overlaps"))


SQL_SORTED_FILES = C.with_(C.G_SQL) + """select count(*) as n, count(distinct time) as steps, cast(0 as bigint) as overlaps from g"""


def q_paired_buckets(spark: SparkSession, sf: str) -> DataFrame:
    """Low- and high-resolution samples written in buckets of their key and paired without a shuffle."""
    root, g = C.work_folder(spark, "buckets"), fixtures.dense_field(spark, sf)
    split = select.with_split(g, C.TEST_YEARS, C.VALIDATION_YEARS)
    hr = samples.samples(split, "v", 8, 8, group=("split",), element_type="double")
    lr = samples.samples(aggregate.coarsen(split, 4, "v", keys=("split", "time")), "v", 2, 2, group=("split",), element_type="double")
    for model, rows in (("lr", lr), ("hr", hr)):
        bucketed.write_bucketed(rows, root, "v", model, buckets=8)
    pairs = bucketed.pair_bucketed(spark, root, ("v", "lr"), ("v", "hr"))
    total = lambda c: F.aggregate(c, F.lit(0.0), lambda acc, e: acc + e)
    return pairs.select("split", "key", F.size("lr_tensor").alias("lr_n"), F.size("hr_tensor").alias("hr_n"),
                        C.r6(total(F.col("lr_tensor")), "lr_sum"), C.r6(total(F.col("hr_tensor")), "hr_sum"))


QUERIES = {
    "written_splits": q_written_splits,
    "written_invariants": q_written_invariants,
    "written_samples": q_written_samples,
    "listed_samples": q_listed_samples,
    "written_stats": q_written_stats,
    "written_batches": q_written_batches,
    "written_masks": q_written_masks,
    "sorted_files": q_sorted_files,
    "paired_buckets": q_paired_buckets,
}

_ORACLE = {
    "written_splits": SQL_WRITTEN_SPLITS,
    "written_invariants": SQL_WRITTEN_INVARIANTS,
    "written_samples": SQL_WRITTEN_SAMPLES,
    "listed_samples": SQL_LISTED_SAMPLES,
    "written_stats": SQL_WRITTEN_STATS,
    "written_batches": SQL_WRITTEN_BATCHES,
    "written_masks": SQL_WRITTEN_MASKS,
    "sorted_files": SQL_SORTED_FILES,
    "paired_buckets": C.SQL_PAIR_LR_HR,
}

ORACLE_SQL = {k: C._sql_round6(v) for k, v in _ORACLE.items()}
