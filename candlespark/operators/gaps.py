"""Missing minutes of a symbol, the runs they form and their counts."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from candlespark.schemas import BASE_TIMEFRAME, TIMEFRAMES

DAY_MS = 86_400_000


def missing(candles: DataFrame, start_ms: int, end_ms: int, tf: str = BASE_TIMEFRAME) -> DataFrame:
    """(symbol, time): buckets without a candle from the symbol's first in the window to ``end_ms``.

    None for a symbol without a candle in the window. Whole days are dealt out
    before their buckets, so that a long history is not made in one task.
    """
    width = TIMEFRAMES[tf]
    end_ms -= end_ms % width
    there = candles.filter((F.col("tf") == tf) & (F.col("time") >= start_ms) & (F.col("time") < end_ms)).select("symbol", "time")
    first = there.groupBy("symbol").agg(F.min("time").alias("first"))
    last = F.lit(end_ms - width).cast("bigint")
    day = F.explode(F.sequence(F.col("first") - F.pmod("first", F.lit(DAY_MS)), last - F.pmod(last, F.lit(DAY_MS)), F.lit(DAY_MS).cast("bigint")))
    days = first.withColumn("day", day).repartition("symbol", "day")
    buckets = F.explode(F.sequence(F.greatest("first", "day"), F.least(last, F.col("day") + F.lit(DAY_MS - width)), F.lit(width).cast("bigint")))
    return days.select("symbol", buckets.alias("time")).join(there, ["symbol", "time"], "left_anti")


def runs(missing_: DataFrame, tf: str = BASE_TIMEFRAME) -> DataFrame:
    """(symbol, start, end, minutes): the longest unbroken half-open runs."""
    width = TIMEFRAMES[tf]
    nth = F.row_number().over(Window.partitionBy("symbol").orderBy("time")).cast("bigint")
    islands = missing_.withColumn("_island", F.col("time") - nth * F.lit(width))
    return islands.groupBy("symbol", "_island").agg(F.min("time").alias("start"), (F.max("time") + F.lit(width)).alias("end"), F.count(F.lit(1)).alias("n")).drop("_island")


def coverage(missing_: DataFrame, fetched: DataFrame) -> DataFrame:
    """(symbol, missing, repaired): how many buckets lacked, and how many of them the fetched candles fill."""
    filled = fetched.select("symbol", "time", F.lit(1).alias("_has")).distinct()
    return missing_.join(filled, ["symbol", "time"], "left").groupBy("symbol").agg(F.count(F.lit(1)).alias("missing"), F.count("_has").alias("repaired"))
