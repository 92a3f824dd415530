"""Synthetic trades: a seeded geometric walk, the same rows for the same seed."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from candlespark.schemas import NUMBER, TRADE


def _uniform(seed: int, what: str) -> Column:
    """A number in (0, 1) from seed, purpose and row: no state, so any partitioning gives the same."""
    return (F.pmod(F.xxhash64(F.lit(seed), F.lit(what), F.col("i")), F.lit(1 << 52)) + F.lit(0.5)) / F.lit(float(1 << 52))


def _normal(seed: int, what: str) -> Column:
    """Box and Muller's transform of two uniform numbers."""
    return F.sqrt(-2 * F.log(_uniform(seed, what + "r"))) * F.cos(F.lit(6.283185307179586) * _uniform(seed, what + "a"))


def synthetic_trades(
    spark: SparkSession,
    symbols: Sequence[str] = ("BTC-USDT", "ETH-USDT", "SOL-USDT", "XRP-USDT"),
    n: int = 200_000,
    seed: int = 1,
    rate: float = 50.0,
    start_ms: int = 1_704_067_200_000,
    volatility: float = 0.0004,
    first_price: float = 60_000.0,
    span: int = 10_000,
) -> DataFrame:
    """TRADE rows: symbols in turn, exponential sizes and gaps, prices a walk in logarithms.

    Running sums go over spans of rows first, so that no task walks the whole series.
    """
    k = len(symbols)
    rows = spark.range(n).withColumnRenamed("id", "i").withColumn("k", F.col("i") % k).withColumn("span", F.floor(F.col("i") / span))
    rows = rows.withColumn("step", _normal(seed, "step") * volatility).withColumn("gap", -F.log(_uniform(seed, "gap")) * (1000 / rate)).withColumn("size", F.greatest(F.lit(0.0001), -F.log(_uniform(seed, "size")) * 0.05))

    def running(group: list[str], value: str) -> Column:
        return F.sum(value).over(Window.partitionBy(*group, "span").orderBy("i"))

    def before(group: list[str], value: str, name: str) -> DataFrame:
        totals = rows.groupBy(*group, "span").agg(F.sum(value).alias("_s"))
        window = Window.partitionBy(*group).orderBy("span").rowsBetween(Window.unboundedPreceding, -1)
        return totals.select(*group, "span", F.coalesce(F.sum("_s").over(window), F.lit(0.0)).alias(name))

    walked = rows.join(before(["k"], "step", "steps"), ["k", "span"]).join(before([], "gap", "gaps"), ["span"])
    walked = walked.withColumn("log_price", F.col("steps") + running(["k"], "step")).withColumn("ms", F.floor(F.col("gaps") + running([], "gap")))
    symbol = F.element_at(F.array(*[F.lit(s) for s in symbols]), (F.col("k") + 1).cast("int"))
    ts_ms = (F.lit(start_ms) + F.col("ms")).cast("bigint")
    return walked.select(
        F.lit("synthetic").alias("source"),
        symbol.alias("symbol"),
        F.col("i").cast("string").alias("trade_id"),
        F.bround((F.lit(first_price) / F.pow(F.lit(10.0), F.col("k")) * F.exp("log_price")).cast("decimal(28,12)"), 2).cast(NUMBER).alias("price"),
        F.bround(F.col("size").cast("decimal(28,12)"), 4).cast(NUMBER).alias("qty"),
        F.when(_uniform(seed, "side") < 0.5, "buy").otherwise("sell").alias("side"),
        F.timestamp_millis(ts_ms).alias("ts"),
        ts_ms.alias("ts_ms"),
        ts_ms.alias("arrival"),
    ).select(*TRADE.fieldNames())


def live_trades(spark: SparkSession, rate: int = 50, symbols: Sequence[str] = ("BTC-USDT", "ETH-USDT"), seed: int = 1) -> DataFrame:
    """An unbounded stream of TRADE rows from Spark's rate source, for trials."""
    ticks = spark.readStream.format("rate").option("rowsPerSecond", rate).load().withColumnRenamed("value", "i")
    symbol = F.element_at(F.array(*[F.lit(s) for s in symbols]), (F.col("i") % len(symbols) + 1).cast("int"))
    price = F.bround((F.lit(100.0) * F.exp(_normal(seed, "step") * 0.01)).cast("decimal(28,12)"), 2).cast(NUMBER)
    size = F.bround((F.greatest(F.lit(0.0001), -F.log(_uniform(seed, "size")) * 0.05)).cast("decimal(28,12)"), 4).cast(NUMBER)
    return ticks.select(F.lit("synthetic").alias("source"), symbol.alias("symbol"), F.col("i").cast("string").alias("trade_id"), price.alias("price"), size.alias("qty"), F.when(_uniform(seed, "side") < 0.5, "buy").otherwise("sell").alias("side"), F.col("timestamp").alias("ts"), F.unix_millis("timestamp").alias("ts_ms"), F.unix_millis("timestamp").alias("arrival"))
