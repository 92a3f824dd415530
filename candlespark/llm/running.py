"""Running totals over a global order, without one task that sees every row."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Rows that a task sorts at a time, about.
ROWS_A_BUCKET = 2_000


def buckets_for(n_rows: int, rows: int = ROWS_A_BUCKET) -> int:
    """How many buckets of a shuffled order hold about ``rows`` each; a power of two, at most 2**28."""
    return 1 << min(28, max(0, math.ceil(math.log2(max(1, n_rows) / rows))))


def hex_bucket(key: Column, n_buckets: int) -> Column:
    """The bucket of a hexadecimal key: its leading bits, so buckets follow the key's order."""
    bits = n_buckets.bit_length() - 1
    return F.shiftright(F.conv(F.substring(key, 1, 8), 16, 10).cast("bigint"), 32 - bits) if bits else F.lit(0).cast("bigint")


def with_running_total(df: DataFrame, group: str, bucket: str, order: Sequence[Column], value: str, name: str) -> DataFrame:
    """Add ``name``: the sum of ``value`` over this row and those before it in its group.

    ``bucket`` must follow ``order`` and ``group`` hold no null. Totals of buckets
    are summed first; rows then meet only those of their own bucket, so that a
    group with a third of all rows is spread over its buckets.
    """
    before = Window.partitionBy(group).orderBy(bucket).rowsBetween(Window.unboundedPreceding, -1)
    within = Window.partitionBy(group, bucket).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    offsets = df.groupBy(group, bucket).agg(F.sum(value).alias("_sum")).select(group, bucket, F.coalesce(F.sum("_sum").over(before), F.lit(0)).alias("_before"))
    return df.join(offsets, [group, bucket]).withColumn(name, F.col("_before") + F.sum(value).over(within)).drop("_before")
