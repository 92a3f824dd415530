"""Counts, rates and percentiles."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F

from candlespark.functions.numbers import fused
from candlespark.functions.timeutil import floor_ms

#: Ranges of values that percentiles are first looked for in.
SPANS = 1024


def percentiles(rows: DataFrame, value: Column, points: Sequence[float], group: Sequence[str] = ()) -> DataFrame:
    """Exact percentiles of whole numbers, linear between ranks: columns p50, p90, ...

    Values are counted first, then the counts of SPANS ranges of each group's
    values; only the ranges in which a rank falls are looked into, so a group
    with most of the rows is in no task's memory. Nulls are not counted.
    """
    names = [f"p{p * 100:g}".replace(".", "_") for p in points]
    counts = rows.select(F.struct(F.lit(0).alias("_"), *group).alias("g"), value.cast("bigint").alias("v")).filter("v is not null").groupBy("g", "v").agg(F.count(F.lit(1)).alias("n"))
    whole = counts.groupBy("g").agg(F.min("v").alias("low"), F.max("v").alias("high"), F.sum("n").alias("total"))
    placed = counts.join(whole, "g").withColumn("span", F.floor((F.col("v") - F.col("low")) / ((F.col("high") - F.col("low") + 1) / F.lit(SPANS))))
    spans = placed.groupBy("g", "span", "total").agg(F.sum("n").alias("inside"))
    spans = spans.withColumn("upto", F.sum("inside").over(Window.partitionBy("g").orderBy("span")))
    at = [(F.col("total") - 1) * F.lit(float(p)) for p in points]
    # ranks count from 0; the second of a pair may lie in the next range
    ranks = F.array(*[F.floor(a) for a in at], *[F.ceil(a) for a in at])
    spans = spans.withColumn("before", F.col("upto") - F.col("inside")).filter(F.exists(ranks, lambda r: (r >= F.col("before")) & (r < F.col("upto"))))
    inside = placed.join(spans.select("g", "span", "before"), ["g", "span"])
    inside = inside.withColumn("to", F.col("before") + F.sum("n").over(Window.partitionBy("g", "span").orderBy("v")))
    of_rank = lambda r: F.max(F.when((F.col("to") > r) & (F.col("to") - F.col("n") <= r), F.col("v")))
    ends = inside.groupBy("g", "total").agg(*[of_rank(f(a)).alias(f"{name}_{f.__name__}") for name, a in zip(names, at, strict=True) for f in (F.floor, F.ceil)])
    share = [a - F.floor(a) for a in at]
    between = [fused(F.col(f"{name}_floor").cast("double"), 1 - d, F.col(f"{name}_ceil") * d).alias(name) for name, d in zip(names, share, strict=True)]
    return ends.select(*[F.col("g")[c].alias(c) for c in group], *between)


def quantiles_of_buckets(rows: DataFrame, value: Column, points: Sequence[float], group: Sequence[str] = (), accuracy: int = 10_000) -> DataFrame:
    """Approximate percentiles for dashboards, in one bounded sketch a group."""
    return rows.groupBy(*group).agg(*[F.percentile_approx(value, F.lit(p), F.lit(accuracy)).alias(f"p{p * 100:g}".replace(".", "_")) for p in points])


def counts_by(rows: DataFrame, column: str) -> DataFrame:
    """(column, n), most frequent first."""
    return rows.groupBy(column).agg(F.count(F.lit(1)).alias("n")).orderBy(F.col("n").desc(), column)


def rate(trades: DataFrame, width_ms: int = 60_000, group: Sequence[str] = ("symbol",)) -> DataFrame:
    """(group, time, n, per_second) over event time."""
    counted = trades.groupBy(*group, floor_ms(F.col("ts_ms"), width_ms).alias("time")).agg(F.count(F.lit(1)).alias("n"))
    return counted.withColumn("per_second", F.col("n") / F.lit(width_ms / 1000))


def nth_of_bucket(trades: DataFrame, width_ms: int = 60_000) -> DataFrame:
    """Add ``time`` and ``nth``, the trade's place in its bucket by arrival."""
    placed = trades.withColumn("time", floor_ms(F.col("ts_ms"), width_ms))
    return placed.withColumn("nth", F.row_number().over(Window.partitionBy("symbol", "time").orderBy("arrival", F.length("trade_id"), "trade_id")).cast("bigint"))


def observed(rows: DataFrame, name: str = "trades") -> tuple[DataFrame, Observation]:
    """rows with counters that are known once an action has run over them."""
    seen = Observation(name)
    return rows.observe(seen, F.count(F.lit(1)).alias("rows"), F.max("ts_ms").alias("max_event_ms")), seen
