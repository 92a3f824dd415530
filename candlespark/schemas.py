"""The shapes that cross boundaries: trades, candles, rejections; timeframes."""

from __future__ import annotations

from pyspark.sql import types as T

# Timeframes and their widths in milliseconds, aligned to UTC midnight.
TIMEFRAMES = {"1m": 60_000, "5m": 300_000, "1h": 3_600_000, "1d": 86_400_000}
BASE_TIMEFRAME = "1m"

# Why a trade is refused, and the taker's sides.
MALFORMED, UNKNOWN_SYMBOL, FUTURE, LATE = "malformed", "unknown_symbol", "future", "late"
SIDES = ("buy", "sell")
SYMBOL_PATTERN = r"\A[A-Z0-9]+-[A-Z0-9]+\z"

#: Eight places on both, so that price * qty is exact with sixteen.
NUMBER = T.DecimalType(18, 8)
VOLUME = T.DecimalType(28, 8)
QUOTE_VOLUME = T.DecimalType(38, 16)

TRADE = T.StructType(
    [
        T.StructField("source", T.StringType()),
        T.StructField("symbol", T.StringType()),
        T.StructField("trade_id", T.StringType()),
        T.StructField("price", NUMBER),
        T.StructField("qty", NUMBER),
        T.StructField("side", T.StringType()),
        T.StructField("ts", T.TimestampType()),
        T.StructField("ts_ms", T.LongType()),
        T.StructField("arrival", T.LongType()),
    ]
)

CANDLE = T.StructType(
    [
        T.StructField("symbol", T.StringType()),
        T.StructField("tf", T.StringType()),
        T.StructField("time", T.LongType()),
        T.StructField("open", NUMBER),
        T.StructField("high", NUMBER),
        T.StructField("low", NUMBER),
        T.StructField("close", NUMBER),
        T.StructField("volume", VOLUME),
        T.StructField("quote_volume", QUOTE_VOLUME),
        T.StructField("trades", T.LongType()),
        T.StructField("closed", T.BooleanType()),
    ]
)

CANDLE_KEY = ["symbol", "tf", "time"]
