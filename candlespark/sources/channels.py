"""Streams and channels: names, wire form, reading and writing on files or Kafka."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from candlespark.functions.numbers import fixed
from candlespark.operators.dedup import KEY
from candlespark.operators.validate import payload
from candlespark.schemas import TIMEFRAMES
from candlespark.sources.decoders import wire

CHANNEL = r"\Acandles:([A-Z0-9]+-[A-Z0-9]+):(1m|5m|1h|1d)\z"
MAX_CHANNELS = 50


def candle_channel(symbol: Column, tf: Column) -> Column:
    return F.concat(F.lit("candles:"), symbol, F.lit(":"), tf)


def venue_symbol(symbol: Column, separator: str = "") -> Column:
    """A symbol as venues write it: without the dash, or with their separator."""
    return F.replace(symbol, F.lit("-"), F.lit(separator))


def channel_parts(channel: Column, symbols: Sequence[str]) -> Column:
    """struct(symbol, tf) of a channel that exists, else null."""
    found = F.struct(F.regexp_extract(channel, CHANNEL, 1).alias("symbol"), F.regexp_extract(channel, CHANNEL, 2).alias("tf"))
    return F.when(channel.rlike(CHANNEL) & found["symbol"].isin(*symbols), found)


def snapshot_json() -> Column:
    """A candle as clients get it: numbers as fixed-point text."""
    return F.to_json(F.struct("symbol", "tf", "time", *[fixed(F.col(n)).alias(n) for n in ("open", "high", "low", "close", "volume", "quote_volume")], "trades", "closed"))


def frames(candles: DataFrame) -> DataFrame:
    """(channel, frame): a snapshot put into the frame of its channel."""
    channel = candle_channel(F.col("symbol"), F.col("tf"))
    return candles.select(channel.alias("channel"), F.concat(F.lit('{"channel":"'), channel, F.lit('","data":'), snapshot_json(), F.lit("}")).alias("frame"))


def routed(candles: DataFrame, channels: Sequence[str], symbols: Sequence[str]) -> DataFrame:
    """The frames of the channels that a client asked for; unknown ones are left out."""
    if len(channels) > MAX_CHANNELS:
        raise ValueError(f"at most {MAX_CHANNELS} channels")
    import re

    known = [c for c in channels if (m := re.match(CHANNEL.replace(r"\z", r"\Z"), c)) and m[1] in symbols and m[2] in TIMEFRAMES]
    return frames(candles).filter(F.col("channel").isin(*known)) if known else frames(candles).limit(0)


def append_trades(trades: DataFrame, path: str) -> None:
    """Append trades in wire form, with their arrival, a folder for each symbol's stream."""
    trades.select("symbol", payload(arrival=True).alias("value")).write.mode("append").partitionBy("symbol").text(path)


def not_appended(trades: DataFrame, path: str) -> DataFrame:
    """Trades that the stream at ``path`` doesn't hold, so that reading the same frames again appends nothing."""
    try:
        there = trades.sparkSession.read.format("text").load(path)
    except AnalysisException:  # nothing has been appended
        return trades
    key = F.from_json("value", "source string, trade_id string")
    return trades.join(there.select(key.alias("k")).select("k.*"), KEY, "left_anti").select(*trades.columns)


def read_trades(spark: SparkSession, path: str, files_per_trigger: int = 1000) -> DataFrame:
    """The events of appended trades as they come in: a stream of decoders.EVENT rows."""
    return wire(spark.readStream.format("text").option("maxFilesPerTrigger", files_per_trigger).load(path).select(F.col("value").alias("raw")))


def read_kafka(spark: SparkSession, servers: str, topics: str, offsets_per_trigger: int = 1_000_000) -> DataFrame:
    """The same from Kafka; needs Spark's Kafka package on the class path."""
    rows = spark.readStream.format("kafka").option("kafka.bootstrap.servers", servers).option("subscribe", topics).option("maxOffsetsPerTrigger", offsets_per_trigger).load()
    return wire(rows.select(F.col("value").cast("string").alias("raw")))


def publish_kafka(updates: DataFrame, servers: str, topic: str, checkpoint: str) -> StreamingQuery:
    """Publish snapshots as they change, keyed by channel."""
    rows = frames(updates).select(F.col("channel").alias("key"), F.col("frame").alias("value"))
    return rows.writeStream.format("kafka").option("kafka.bootstrap.servers", servers).option("topic", topic).option("checkpointLocation", checkpoint).outputMode("update").start()
