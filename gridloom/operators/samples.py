"""Samples, shuffling and batches.

* A sample is one tensor per time step, keyed ``yyyy-MM-dd-HH``.
* The shuffle is a seeded permutation: samples are ordered by
  ``md5(seed | key)`` (ties by key).  The hash uses the key only, so every
  variable, split and resolution sharing the keys gets the same order.
* Batching numbers the permuted keys globally without moving them to one
  task: keys fall into 4,096 buckets by the first three hex digits of their
  hash (uniform by construction), each bucket is numbered locally, and the
  bucket offsets come from a 4,096-row prefix sum per group.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.scalars import rain_mask_tensor, sample_key
from .tensors import pack, tensor_has_missing

# Fixed value: the number of hash buckets is 16^3 (first three hex digits).
HASH_BUCKET_DIGITS = 3


def samples(df: DataFrame, value: str, ny: int, nx: int,
            group: Sequence[str] = (), check: bool = True,
            element_type: str = "float") -> DataFrame:
    """``(*group, key, time, ny, nx, tensor)``: one tensor per hour key.

    Two steps in the same hour would overwrite each other in the original pipeline;
    here they make the group hold more than ``ny·nx`` cells, which raises.
    """
    keyed = df.withColumn("key", sample_key("time"))
    packed = pack(keyed, value, ny, nx, keys=(*group, "key"), check=check,
                  element_type=element_type, least=("time",))
    return packed.select(*group, "key", "time", "ny", "nx", "tensor")


def samples_by_time(df: DataFrame, value: str, ny: int, nx: int,
                    group: Sequence[str] = (), check: bool = True,
                    element_type: str = "float") -> DataFrame:
    """Like ``samples`` but packed by ``(group, time)``.

    A frame already clustered by time (the alignment plan's range
    partitioning, kept through its checkpoint) packs without any exchange.
    Hour keys are derived afterwards; ``assert_unique_keys`` checks them.
    """
    packed = pack(df, value, ny, nx, keys=(*group, "time"), check=check, element_type=element_type)
    return packed.select(*group, sample_key("time").alias("key"), "time", "ny", "nx", "tensor")


def assert_unique_keys(frame: DataFrame, group: Sequence[str] = (), time: str = "time") -> None:
    """Two steps in one hour would share a sample key: raise.

    Reads only the time column of a cell (or sample) frame: distinct
    ``(group, time)`` pairs are deduplicated map-side, then their hour keys are
    counted, so the check never computes tensors.
    """
    steps = frame.select(*group, time).distinct()
    dup = (steps.groupBy(*group, sample_key(time).alias("key")).agg(F.count(F.lit(1)).alias("n"))
           .where(F.col("n") > 1).limit(1).collect())
    if dup:
        raise ValueError(f"several time steps share the sample key {dup[0]['key']}")


def permutation_hash(seed: int, key: str = "key"):
    return F.md5(F.concat(F.lit(f"{seed}|"), F.col(key)))


def assign_batches(keys: DataFrame, batch_size: int, seed: int = 0,
                   group: Sequence[str] = (), randomize: bool = True) -> DataFrame:
    """``(*group, key, pos, batch_id, slot)`` for a frame of distinct keys.

    ``pos`` is the 0-based rank in the permuted order within each group;
    ``batch_id = pos div batch_size``; the last batch may be short.
    ``randomize=False`` keeps the sorted key order.
    """
    if batch_size < 1:
        raise ValueError(f"a batch holds at least one sample, got a batch size of {batch_size}")
    group = list(group)
    if randomize:
        hashed = keys.select(*group, "key", permutation_hash(seed).alias("_h"))
        bucket = F.substring("_h", 1, HASH_BUCKET_DIGITS)
    else:
        # sorted order: keys are times, so bucket by month (order-preserving)
        hashed = keys.select(*group, "key", F.col("key").alias("_h"))
        bucket = F.substring("_h", 1, 7)
    hashed = hashed.withColumn("_bucket", bucket)
    counts = hashed.groupBy(*group, "_bucket").agg(F.count(F.lit(1)).alias("_cnt"))
    prefix = Window.partitionBy(*group).orderBy("_bucket").rowsBetween(
        Window.unboundedPreceding, -1)
    offsets = counts.select(*group, "_bucket",
                            F.coalesce(F.sum("_cnt").over(prefix), F.lit(0)).alias("_off"))
    local = Window.partitionBy(*group, "_bucket").orderBy("_h", "key")
    ranked = hashed.withColumn("_rn", F.row_number().over(local))
    # hash buckets: at most 16^3 offset rows per group, a proven bound
    side = F.broadcast(offsets) if randomize else offsets
    j = ranked.join(side, [*group, "_bucket"])
    pos = (F.col("_off") + F.col("_rn") - 1).cast("long")
    return j.select(*group, "key", pos.alias("pos"),
                    F.floor(pos / batch_size).cast("long").alias("batch_id"),
                    (pos % batch_size).cast("int").alias("slot"))


def batch_names(assignment: DataFrame, group: Sequence[str] = ()) -> DataFrame:
    """``(*group, batch_id, name, n)``: member keys joined by ``__`` in slot order."""
    members = F.sort_array(F.collect_list(F.struct("slot", "key")))
    return (assignment.groupBy(*group, "batch_id")
            .agg(members.alias("_m"))
            .select(*group, "batch_id",
                    F.array_join(F.transform("_m", lambda m: m["key"]), "__").alias("name"),
                    F.size("_m").alias("n")))


# Keys above which the key → batch assignment is shuffled rather than broadcast
# (≈ 100 bytes per key row: 4M keys ≈ 400 MB is past what executors should hold).
MAX_BROADCAST_KEYS = 2_000_000


def assignment_fits_broadcast(assignment: DataFrame, max_keys: int = MAX_BROADCAST_KEYS) -> bool:
    """Proven bound: one assignment row per sample (one count of the key frame)."""
    return assignment.count() <= max_keys


def batches(sample_frame: DataFrame, assignment: DataFrame, group: Sequence[str] = (),
            check: bool = True, broadcast_assignment: bool = False,
            name_col: str = "key") -> DataFrame:
    """Stack the tensors of each batch: ``(*group, batch_id, name, keys, tensors)``.

    Groups hold at most ``batch_size`` tensors.  A batch containing a missing
    value raises (NaN batches are refused).  With a broadcast
    assignment (one row per sample, size checked by the caller) the tensors
    cross a single exchange, the one grouping them by batch.
    """
    group = list(group)
    side = F.broadcast(assignment) if broadcast_assignment else assignment
    names = F.col(name_col) if name_col != "key" else F.col("key")
    j = sample_frame.select(*group, "key", names.alias("_name"), "tensor").join(side, [*group, "key"])
    members = F.sort_array(F.collect_list(F.struct("slot", "key", "_name", "tensor")))
    g = j.groupBy(*group, "batch_id").agg(members.alias("_m"))
    tensors = F.transform("_m", lambda m: m["tensor"])
    if check:
        bad = F.exists("_m", lambda m: tensor_has_missing(m["tensor"]))
        tensors = F.when(~bad, tensors).otherwise(
            F.raise_error(F.concat(F.lit("missing values in batch "), F.col("batch_id").cast("string"))))
    return g.select(*group, "batch_id",
                    F.array_join(F.transform("_m", lambda m: m["_name"]), "__").alias("name"),
                    F.transform("_m", lambda m: m["key"]).alias("keys"),
                    tensors.alias("tensors"))


def masks(sample_frame: DataFrame, threshold: float | None = None) -> DataFrame:
    """Rain/no-rain mask tensors from standardized precipitation samples.

    ``key`` (and ``name`` when present) get the ``mask_`` prefix.
    """
    renamed = {c: F.concat(F.lit("mask_"), F.col(c)).alias(c)
               for c in ("key", "name") if c in sample_frame.columns}
    return sample_frame.select(
        *[renamed.get(c, F.col(c)) for c in sample_frame.columns if c != "tensor"],
        rain_mask_tensor("tensor", threshold).alias("tensor"))


def pair_samples(lr: DataFrame, hr: DataFrame, on: Sequence[str] = ("split", "key")) -> DataFrame:
    """Pair low- and high-resolution samples of the same step (inner equi-join)."""
    on = [c for c in on if c in lr.columns and c in hr.columns]
    left = lr.select(*on, F.col("tensor").alias("lr_tensor"))
    right = hr.select(*on, F.col("tensor").alias("hr_tensor"))
    return left.join(right, on)
