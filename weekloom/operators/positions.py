"""Running totals over sorted values without one task holding a whole group.

A window over a group runs in one task, however large the group.  Here all rows are shuffled by
ranges of (group, value) and stored with the number of their range.  Each range is summed up, the
sums give every range its starting total, and a window then runs inside the ranges only.  The
numbers are stored by the time they are used, so a task that runs again sees the same ranges.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from weekloom.sources.tables import staged

RANGE = "_range"


def with_ranges(df: DataFrame, groups: Sequence[str], value: str) -> DataFrame:
    """Store ``df`` with the number of the range each row falls in.

    Spark draws the bounds from a sample and equal values share a range, so rows that are
    unique by group and value spread evenly, whatever the size of a group.  There are as many ranges as
    shuffle partitions, fewer where adaptive execution unites small ones.
    """
    ranged = df.repartitionByRange(*groups, value)
    return staged(ranged.withColumn(RANGE, F.spark_partition_id()), "ranges")


def running_total(
    df: DataFrame, groups: Sequence[str], value: str, weight: str, out: str
) -> DataFrame:
    """Add ``out``: the sum of ``weight`` over the smaller values of the same group.

    Rows have to be unique by group and value.
    """
    ranged = with_ranges(df, groups, value)
    part = [*groups, RANGE]
    smaller = Window.partitionBy(*part).orderBy(value).rowsBetween(Window.unboundedPreceding, -1)
    inside = F.coalesce(F.sum(weight).over(smaller), F.lit(0))
    sums = ranged.groupBy(*part).agg(F.sum(weight).alias("_sum"))
    earlier = Window.partitionBy(*groups).orderBy(RANGE).rowsBetween(
        Window.unboundedPreceding, -1
    )
    starts = sums.select(*part, F.coalesce(F.sum("_sum").over(earlier), F.lit(0)).alias("_start"))
    return (
        ranged.withColumn("_inside", inside)
        .join(starts, part)
        .withColumn(out, F.col("_start") + F.col("_inside"))
        .drop("_inside", "_start", RANGE)
    )
