"""Per-symbol watermarks as window functions over arrival order.

A trade is late when the minute that it belongs to had ended at its symbol's
watermark when it arrived: the greatest event time so far less the allowed
lateness. A late trade can't raise that maximum past what made it late, so the
running maximum over all earlier arrivals is the watermark.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from candlespark.functions.timeutil import floor_ms, width_of

ALLOWED_LATENESS_MS, IDLE_GRACE_MS, MINUTE_MS = 5_000, 2_000, 60_000
#: Arrivals that one task orders at a time: an hour of one symbol.
SPAN_MS = 3_600_000


def with_watermark(trades: DataFrame, allowed_ms: int = ALLOWED_LATENESS_MS) -> DataFrame:
    """Add ``watermark``: the symbol's before this trade, null for its first.

    The maximum of each hour of arrivals is taken first, then those of the hours
    before, then the running maximum inside the hour, so that a symbol with most
    of the trades is still spread over its hours.
    """
    before = Window.partitionBy("symbol").orderBy("_span").rowsBetween(Window.unboundedPreceding, -1)
    within = Window.partitionBy("symbol", "_span").orderBy("arrival", F.length("trade_id"), "trade_id", "source").rowsBetween(Window.unboundedPreceding, -1)
    spanned = trades.withColumn("_span", F.floor(F.col("arrival") / SPAN_MS))
    spans = spanned.groupBy("symbol", "_span").agg(F.max("ts_ms").alias("_max")).select("symbol", "_span", F.max("_max").over(before).alias("_before"))
    joined = spanned.join(spans, ["symbol", "_span"])
    return joined.withColumn("watermark", F.greatest("_before", F.max("ts_ms").over(within)) - F.lit(allowed_ms)).drop("_span", "_before")


def is_late() -> Column:
    return F.coalesce(floor_ms(F.col("ts_ms"), MINUTE_MS) + MINUTE_MS <= F.col("watermark"), F.lit(False))


def split_late(trades: DataFrame, allowed_ms: int = ALLOWED_LATENESS_MS) -> DataFrame:
    """Add ``watermark`` and ``late``."""
    return with_watermark(trades, allowed_ms).withColumn("late", is_late())


def watermarks(trades: DataFrame, allowed_ms: int = ALLOWED_LATENESS_MS) -> DataFrame:
    """(symbol, watermark) after all trades."""
    return trades.groupBy("symbol").agg((F.max("ts_ms") - F.lit(allowed_ms)).alias("watermark"))


def advanced(marks: DataFrame, now_ms: int, allowed_ms: int = ALLOWED_LATENESS_MS, grace_ms: int | None = IDLE_GRACE_MS) -> DataFrame:
    """Watermarks moved on by the wall clock, never back; no grace: not at all."""
    return marks if grace_ms is None else marks.withColumn("watermark", F.greatest("watermark", F.lit(now_ms - allowed_ms - grace_ms)))


def with_closed(candles: DataFrame, marks: DataFrame) -> DataFrame:
    """Set ``closed``: the symbol's watermark has reached the bucket's end."""
    end = F.col("time") + width_of(F.col("tf"))
    return candles.drop("closed").join(marks, "symbol", "left").withColumn("closed", F.coalesce(end <= F.col("watermark"), F.lit(False))).drop("watermark")
