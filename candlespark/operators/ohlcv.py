"""OHLCV aggregation by event time.

Open and close are decided by (ts_ms, length of id, id, source), never by
arrival, so that any order and any batching give the same candles.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from candlespark.functions.numbers import notional
from candlespark.functions.timeutil import floor_ms, width_of
from candlespark.schemas import BASE_TIMEFRAME, NUMBER, QUOTE_VOLUME, TIMEFRAMES, VOLUME

COLUMNS = ["symbol", "tf", "time", "open", "high", "low", "close", "volume", "quote_volume", "trades"]


def order_key() -> Column:
    return F.struct("ts_ms", F.length("trade_id").alias("id_length"), "trade_id", "source")


def partial_minutes(trades: DataFrame) -> DataFrame:
    """One row for each symbol and minute, with the keys of its first and last trade: the mergeable state."""
    # of trades that are equal in all of the key the first to arrive opens and the last closes
    arrival = F.col("arrival") if "arrival" in trades.columns else F.lit(0)
    keyed = trades.select(arrival.alias("arrival"), "symbol", floor_ms(F.col("ts_ms"), TIMEFRAMES[BASE_TIMEFRAME]).alias("minute"), "price", "qty", notional(F.col("price"), F.col("qty")).alias("notional"), order_key().alias("key"))
    return keyed.groupBy("symbol", "minute").agg(
        F.min(F.struct("key", "arrival", "price")).alias("first"),
        F.max(F.struct("key", "arrival", "price")).alias("last"),
        F.max("price").alias("high"),
        F.min("price").alias("low"),
        F.sum("qty").alias("volume"),
        F.sum("notional").alias("quote_volume"),
        F.count(F.lit(1)).alias("trades"),
    )


def candles(trades: DataFrame, timeframes: Sequence[str] = tuple(TIMEFRAMES)) -> DataFrame:
    """COLUMNS for each symbol, timeframe and bucket that has a trade.

    Minutes are folded first; the other timeframes then merge minutes, so that
    what is shuffled for them follows the minutes and not four times the trades.
    """
    minutes = partial_minutes(trades)
    wanted = F.explode(F.array(*[F.lit(tf) for tf in timeframes]))
    placed = minutes.withColumn("tf", wanted).withColumn("time", floor_ms(F.col("minute"), width_of(F.col("tf"))))
    if list(timeframes) == [BASE_TIMEFRAME]:
        merged = placed.select("symbol", "tf", "time", F.col("first.price").alias("open"), "high", "low", F.col("last.price").alias("close"), "volume", "quote_volume", "trades")
    else:
        merged = placed.groupBy("symbol", "tf", "time").agg(
            F.min("first")["price"].alias("open"),
            F.max("high").alias("high"),
            F.min("low").alias("low"),
            F.max("last")["price"].alias("close"),
            F.sum("volume").alias("volume"),
            F.sum("quote_volume").alias("quote_volume"),
            F.sum("trades").alias("trades"),
        )
    kinds = {"open": NUMBER, "high": NUMBER, "low": NUMBER, "close": NUMBER, "volume": VOLUME, "quote_volume": QUOTE_VOLUME}
    return merged.select(*[F.col(c).cast(kinds[c]).alias(c) if c in kinds else F.col(c) for c in COLUMNS])


def rollup(minutes: DataFrame, timeframes: str | Sequence[str], start_ms: int | None = None, end_ms: int | None = None) -> DataFrame:
    """Closed candles of one timeframe or several from 1m candles, closed or not.

    Both bounds are rounded down to each timeframe, so whole buckets come out and
    the first one reaches back to its start. One pass serves all timeframes.
    """
    wanted = [timeframes] if isinstance(timeframes, str) else list(timeframes)
    rows = minutes.filter(F.col("tf") == BASE_TIMEFRAME)
    if start_ms is not None:
        rows = rows.filter(F.col("time") >= min(start_ms - start_ms % TIMEFRAMES[tf] for tf in wanted))
    if end_ms is not None:
        rows = rows.filter(F.col("time") < max(end_ms - end_ms % TIMEFRAMES[tf] for tf in wanted))
    rows = rows.withColumn("tf", F.explode(F.array(*[F.lit(tf) for tf in wanted]))).withColumn("_width", width_of(F.col("tf")))
    if start_ms is not None:
        rows = rows.filter(F.col("time") >= floor_ms(F.lit(start_ms), F.col("_width")))
    if end_ms is not None:
        rows = rows.filter(F.col("time") < floor_ms(F.lit(end_ms), F.col("_width")))
    grouped = rows.withColumn("_bucket", floor_ms(F.col("time"), F.col("_width"))).groupBy("symbol", "tf", "_bucket").agg(
        F.min_by("open", "time").alias("open"),
        F.max("high").alias("high"),
        F.min("low").alias("low"),
        F.max_by("close", "time").alias("close"),
        F.sum("volume").cast(VOLUME).alias("volume"),
        F.sum("quote_volume").cast(QUOTE_VOLUME).alias("quote_volume"),
        F.sum("trades").alias("trades"),
    )
    return grouped.withColumnRenamed("_bucket", "time").withColumn("closed", F.lit(True)).select(*COLUMNS, "closed")
