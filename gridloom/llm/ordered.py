"""Global positions and prefix sums without a global window.

Rows are range-partitioned and sorted, numbered inside their partition and
written; a table with one row per partition and group then says what the
partitions before it hold.  So a group of any size is spread over as many tasks
as its rows need, and a rank or a running sum is the partition's own plus one
offset.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .components import stored


def deal(rows: DataFrame, by: list[Column | str], name: str) -> DataFrame:
    """``rows`` sorted by ``by`` over range partitions and written, with ``_part`` and the ascending position ``_at``.

    Rows that are equal in ``by`` are told apart by their place in the input, so
    that a run of equal rows can be cut as well.
    """
    rows = rows.withColumn("_tie", F.monotonically_increasing_id())
    rows = rows.repartitionByRange(*by, "_tie").sortWithinPartitions(*by, "_tie").drop("_tie")
    rows = stored(rows.withColumn("_at", F.monotonically_increasing_id()), name)  # partition << 33 | row of the partition
    return rows.withColumn("_part", F.shiftright("_at", 33).cast("int"))


def spans(dealt: DataFrame, group: list[str], sums: tuple[str, ...] = ()) -> DataFrame:
    """A row per partition and group of ``dealt`` rows.

    ``_first`` is the group's first position there, ``_rows`` and ``_total`` count
    the group's rows in earlier partitions and in all; ``_rows_x`` and ``_total_x``
    do so for each column x of ``sums``.  A window holds one row per partition.
    """
    named = {"": F.count(F.lit(1)), **{f"_{x}": F.sum(x) for x in sums}}
    per = dealt.groupBy("_part", *group).agg(F.min("_at").alias("_first"), *[how.alias(f"_own{x}") for x, how in named.items()])
    every = Window.partitionBy(*group)
    before = every.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    return per.select("_part", *group, "_first", *[c for x in named for c in (
        F.coalesce(F.sum(f"_own{x}").over(before), F.lit(0)).alias(f"_rows{x}"), F.sum(f"_own{x}").over(every).alias(f"_total{x}"))])


def with_spans(dealt: DataFrame, found: DataFrame, group: list[str]) -> DataFrame:
    """``dealt`` rows with the columns of their partition's and group's row of ``found``; a null group is a group."""
    marks = {c: f"_of{c}" for c in ("_part", *group)}
    on = reduce(lambda p, q: p & q, [F.col(c).eqNullSafe(F.col(m)) for c, m in marks.items()])
    return dealt.join(found.withColumnsRenamed(marks), on).drop(*marks.values())


def position() -> Column:
    """A row's position in its group, after ``with_spans``."""
    return F.col("_rows") + F.col("_at") - F.col("_first")
