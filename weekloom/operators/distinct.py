"""Distinct counts over any range of weeks, from bitmaps stored for each week.

Distinct counts of weeks don't add up: an order may show in several.  So each week keeps which numbers it
holds, as bitmaps of 32,768 numbers each; the bitmaps of a range are united and their bits counted,
exactly, without reading the facts again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def weekly_bitmaps(rows: DataFrame, column: str, week: str = "Week") -> DataFrame:
    """``Week``, ``bucket`` and ``bitmap``: the different whole numbers of ``column`` in each week.

    Rows without a week or number are left out.  Bitmaps combine before the shuffle, and a week is as
    many rows as its numbers fill buckets, so a busy week is spread over tasks.
    """
    number = F.col(f"`{column}`").cast("bigint")
    kept = rows.where(F.col(week).isNotNull() & number.isNotNull())
    return kept.groupBy(F.col(week).alias("Week"), F.bitmap_bucket_number(number).alias("bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position(number)).alias("bitmap")
    )


def distinct_count(bitmaps: DataFrame, name: str) -> DataFrame:
    """The number of different numbers in :func:`weekly_bitmaps`, cut to any range of weeks; 0 for none."""
    united = bitmaps.groupBy("bucket").agg(F.bitmap_or_agg("bitmap").alias("bitmap"))
    return united.agg(F.coalesce(F.sum(F.bitmap_count("bitmap")), F.lit(0)).alias(name))
