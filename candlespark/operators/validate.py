"""Field checks, the gate that refuses trades, and the dead letters they become."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from candlespark.functions.numbers import fixed
from candlespark.schemas import FUTURE, MALFORMED, SIDES, SYMBOL_PATTERN, UNKNOWN_SYMBOL

MAX_SKEW_MS = 30_000


def once(rows: DataFrame, **values: Column) -> DataFrame:
    """rows with ``values`` worked out once each: the optimizer copies a projection into all that uses it, but no generator."""
    held = F.explode(F.array(F.struct(*[value.alias(name) for name, value in values.items()]))).alias("_once")
    return rows.select("*", held).select(*rows.columns, *[F.col("_once")[name].alias(name) for name in values])


def problems() -> Column:
    """What is wrong with a trade's fields, in field order: an array, empty for a good trade."""
    bad = [
        ("source", F.coalesce(F.length("source"), F.lit(0)) < 1),
        ("symbol", ~F.coalesce(F.col("symbol").rlike(SYMBOL_PATTERN), F.lit(False))),
        ("trade_id", F.coalesce(F.length("trade_id"), F.lit(0)) < 1),
        ("price", ~F.coalesce(F.col("price") > 0, F.lit(False))),
        ("qty", ~F.coalesce(F.col("qty") > 0, F.lit(False))),
        ("side", ~F.coalesce(F.col("side").isin(*SIDES), F.lit(False))),
        ("ts", F.col("ts_ms").isNull()),
    ]
    said = {"source": "source: must not be empty", "symbol": "symbol: must be BASE-QUOTE", "trade_id": "trade_id: must not be empty", "price": "price: must be a number above 0", "qty": "qty: must be a number above 0", "side": "side: must be buy or sell", "ts": "ts: must be a time with an offset"}
    return F.array_compact(F.array(*[F.when(wrong, F.lit(said[name])) for name, wrong in bad]))


def detail() -> Column:
    return F.concat_ws("; ", problems())


def payload(arrival: bool = False) -> Column:
    """A trade as it goes over the wire, numbers as fixed-point text; between services with its arrival."""
    own = ["source", "symbol", "trade_id", fixed(F.col("price")).alias("price"), fixed(F.col("qty")).alias("qty"), "side", "ts_ms"]
    return F.to_json(F.struct(*own, *(["arrival"] if arrival else [])))


def gate(trades: DataFrame, symbols: Sequence[str] | None, now_ms: Column | int, max_skew_ms: int = MAX_SKEW_MS) -> DataFrame:
    """Add ``reason``, null for what is admitted, and ``detail``.

    In this order: malformed, unknown symbol (none is without ``symbols``), more
    than ``max_skew_ms`` ahead of ``now_ms``. Copies are dropped behind the gate,
    by dedup and by what takes trades in, and leave no letter.
    """
    now_ms = F.lit(now_ms) if isinstance(now_ms, int) else now_ms
    checked = once(trades, wrong=detail())
    unknown = F.lit(False) if symbols is None else ~F.col("symbol").isin(*symbols)
    reason = F.when(F.col("wrong") != "", MALFORMED).when(unknown, UNKNOWN_SYMBOL).when(F.col("ts_ms") - now_ms > max_skew_ms, FUTURE)
    said = F.when(F.col("reason") == MALFORMED, F.col("wrong")).when(F.col("reason") == UNKNOWN_SYMBOL, F.col("symbol")).when(F.col("reason") == FUTURE, F.timestamp_millis("ts_ms").cast("string"))
    return checked.withColumn("reason", reason).withColumn("detail", said).drop("wrong")


def admitted(gated: DataFrame) -> DataFrame:
    return gated.filter(F.col("reason").isNull()).drop("reason", "detail")


def dead_letters(gated: DataFrame, stage: str = "ingest") -> DataFrame:
    """(source, reason, payload, detail, stage) of what was refused."""
    return gated.filter(F.col("reason").isNotNull()).select("source", "reason", payload().alias("payload"), "detail", F.lit(stage).alias("stage"))
