"""Partitioning along time without a sampling pass.

A range partitioning samples its whole input before it runs.  The times of a
field are known from one aggregate over the time column alone, so a step's
partition is a number computed from its time, and rows are dealt by that number
(``repartitionById``).  Grouping keys that start with ``SLOT`` are clustered by
it, so aggregates and windows per step need no further exchange.

Where steps are spread evenly, a slot is a contiguous range of times; where they
are not (a gap of decades, a burst of minutes), slots are dealt by a hash of the
time, so that no slot gets more than its share of steps.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SLOT = "_slot"
# Fixed value: the axis is looked at in this many parts of equal row count.
PARTS = 16
# A part this many times shorter than the average means bursts of steps.
BURST = 4


def micros(time: str | Column) -> Column:
    return F.unix_micros((F.col(time) if isinstance(time, str) else time).cast("timestamp"))


@dataclass
class TimeAxis:
    """First and last time in microseconds, the number of steps (within a few per cent) and whether they are spread evenly."""
    first: int
    last: int
    steps: int
    even: bool

    def slot(self, time: str, n: int) -> Column:
        """The slot, 0 to n - 1, of a time; a missing time is in slot 0."""
        if not self.even:
            return F.coalesce(F.pmod(F.xxhash64(time), F.lit(n)), F.lit(0)).cast("int")
        share = (micros(time) - F.lit(self.first)).cast("double") / F.lit(float(self.last - self.first + 1))
        return F.coalesce(F.greatest(F.lit(0), F.least(F.lit(n - 1), F.floor(share * n))), F.lit(0)).cast("int")


def time_axis(cells: DataFrame, time: str = "time") -> TimeAxis:
    """The time axis of a field: one aggregate that reads the time column only."""
    t = micros(time)
    marks = F.percentile_approx(t, [k / PARTS for k in range(1, PARTS)], 1000)
    r = cells.agg(F.min(t).alias("lo"), F.max(t).alias("hi"), F.approx_count_distinct(time, 0.02).alias("n"), marks.alias("marks")).first()
    if r["lo"] is None:
        return TimeAxis(0, 0, 1, True)
    edges = [r["lo"], *r["marks"], r["hi"]]
    shortest = min(b - a for a, b in zip(edges[:-1], edges[1:], strict=True))
    few = r["n"] < 4 * PARTS  # parts of less than a few steps say nothing
    return TimeAxis(r["lo"], r["hi"], max(1, r["n"]), few or shortest * PARTS * BURST >= r["hi"] - r["lo"])


def by_slot(cells: DataFrame, axis: TimeAxis, n: int, time: str = "time") -> DataFrame:
    """``cells`` with ``SLOT``, dealt to ``n`` partitions by it."""
    return cells.withColumn(SLOT, axis.slot(time, n)).repartitionById(n, SLOT)
