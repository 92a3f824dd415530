"""Batch verbs: range reads, backfill, repair, and a whole batch of trades."""

from __future__ import annotations

import time
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from candlespark.functions.timeutil import checked_limit, default_from, settled_before
from candlespark.operators import gaps, lateness, merge, ohlcv
from candlespark.operators.validate import admitted, dead_letters, gate
from candlespark.operators.dedup import keep_first
from candlespark.schemas import CANDLE, CANDLE_KEY, LATE, TIMEFRAMES
from candlespark.sources.store import DAY_MS, Store

#: A venue's history: (symbol, half-open ranges of ms, one request each) to 1m candles.
KlineSource = Callable[[str, list[tuple[int, int]]], DataFrame]
HIGHER = [tf for tf in TIMEFRAMES if tf != "1m"]


def candles_range(candles: DataFrame, symbol: str, tf: str, *, symbols: Sequence[str], start_ms: int | None = None, end_ms: int, limit: int | None = None) -> DataFrame:
    """Candles of [start, end), ascending, the oldest ``limit`` of them.

    Without a start it is ``limit`` buckets before the end, which gives the latest.
    """
    limit = checked_limit(limit)
    if symbol not in symbols:
        raise LookupError(f"unknown symbol {symbol}")
    if tf not in TIMEFRAMES:
        raise ValueError(f"unknown timeframe {tf}")
    start_ms = default_from(end_ms, tf, limit) if start_ms is None else start_ms
    if start_ms >= end_ms:
        raise ValueError("from must lie before to")
    found = candles.filter((F.col("symbol") == symbol) & (F.col("tf") == tf) & (F.col("time") >= start_ms) & (F.col("time") < end_ms))
    return found.orderBy("time").limit(limit)


def folded(trades: DataFrame, symbols: Sequence[str], now_ms: int, allowed_ms: int = lateness.ALLOWED_LATENESS_MS, idle: bool = False) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(candles with their closed flag, dead letters, watermarks) of a batch of trades."""
    gated = gate(trades, symbols, now_ms)
    judged = lateness.split_late(admitted(gated), allowed_ms)
    late = judged.filter("late")
    letters = dead_letters(gated).unionByName(dead_letters(late.withColumn("reason", F.lit(LATE)).withColumn("detail", F.col("watermark").cast("string")), "aggregate"))
    # late comes before duplicate: a copy of a trade whose minute has closed is late
    marks = lateness.watermarks(admitted(gated), allowed_ms)
    marks = lateness.advanced(marks, now_ms, allowed_ms) if idle else marks
    return lateness.with_closed(ohlcv.candles(keep_first(judged.filter("not late"))), marks).select(*CANDLE.fieldNames()), letters, marks


def settled(marks: DataFrame, symbol: str, now_ms: int) -> int:
    """Up to where a symbol's history may be repaired; one row to the driver."""
    row = marks.filter(F.col("symbol") == symbol).agg(F.max("watermark").alias("watermark"))
    return row.select(settled_before(F.col("watermark"), F.lit(now_ms)).alias("at")).first()["at"]


def fill(candles: DataFrame, fetched: DataFrame, symbol: str, start_ms: int, end_ms: int) -> DataFrame:
    """What fetched minutes change: these (guarded) and the timeframes above rolled up anew.

    Rollups cover the buckets that [start, end) touches at its left and completes
    at its right, and replace what is there.
    """
    minutes = candles.filter((F.col("symbol") == symbol) & (F.col("tf") == "1m"))
    filled = merge.guarded_upsert(minutes, fetched.select(*candles.columns).withColumn("seq", F.lit(0).cast("bigint")))
    rolled = ohlcv.rollup(filled, HIGHER, start_ms, end_ms)
    return filled.join(fetched.select(*CANDLE_KEY), CANDLE_KEY, "left_semi").select(*candles.columns).unionByName(rolled.select(*candles.columns))


def backfill_changes(candles: DataFrame, marks: DataFrame, source: KlineSource, symbol: str, start_ms: int, end_ms: int, now_ms: int) -> DataFrame | None:
    """The candles that a venue's minutes of [start, end) change, as far as they have settled; None if nothing has."""
    start_ms -= start_ms % TIMEFRAMES["1m"]
    end_ms = min(end_ms - end_ms % TIMEFRAMES["1m"], settled(marks, symbol, now_ms))
    if start_ms >= end_ms:
        return None
    return fill(candles, source(symbol, [(start_ms, end_ms)]), symbol, start_ms, end_ms)


def backfill(candles: DataFrame, *rest) -> DataFrame:
    """``candles`` with backfill_changes made."""
    changes = backfill_changes(candles, *rest)
    return candles if changes is None else merge.overwrite(candles, changes)


def repair_changes(candles: DataFrame, marks: DataFrame, source: KlineSource, symbol: str, lookback_ms: int, now_ms: int) -> tuple[DataFrame | None, DataFrame]:
    """(the candles that fetching missing minutes changes, None if none is missing, (symbol, missing, repaired)).

    Each run is one request to the venue; there are as many as outages, so their
    list is small.
    """
    end_ms = settled(marks, symbol, now_ms)
    lost = gaps.missing(candles.filter(F.col("symbol") == symbol), end_ms - lookback_ms, end_ms)
    requests = sorted((r["start"], r["end"]) for r in gaps.runs(lost).collect())
    if not requests:
        return None, gaps.coverage(lost, candles.limit(0))
    fetched = source(symbol, requests).select(*candles.columns)
    return fill(candles, fetched, symbol, requests[0][0], end_ms), gaps.coverage(lost, fetched)


def repair(candles: DataFrame, *rest) -> tuple[DataFrame, DataFrame]:
    """(``candles`` with repair_changes made, (symbol, missing, repaired))."""
    changes, found = repair_changes(candles, *rest)
    return (candles if changes is None else merge.overwrite(candles, changes)), found


def repair_all(store: Store, source: KlineSource, symbols: Sequence[str], lookback_ms: int, now_ms: int) -> dict[str, Exception]:
    """Repair each symbol in the store; what went wrong with a symbol stays with it."""
    failed: dict[str, Exception] = {}
    for symbol in symbols:
        try:
            changes, _ = repair_changes(store.candles(start_ms=now_ms - lookback_ms - DAY_MS), store.watermarks(), source, symbol, lookback_ms, now_ms)
            if changes is not None:
                store.put_candles(changes)
        except Exception as e:  # a venue's or a table's; the others go on
            failed[symbol] = e
    return failed


def repair_forever(store: Store, source: KlineSource, symbols: Sequence[str], lookback_ms: int, every_s: float, *, rounds: int | None = None, report: Callable[[dict[str, Exception]], None] = lambda failed: None) -> None:
    """repair_all again and again, ``every_s`` seconds apart, endlessly or ``rounds`` times."""
    done = 0
    while rounds is None or done < rounds:
        if done:
            time.sleep(every_s)
        report(repair_all(store, source, symbols, lookback_ms, int(time.time() * 1000)))
        done += 1


def candles_of(trades: DataFrame, symbol: str, tf: str, *, end_ms: int, start_ms: int | None = None, limit: int | None = None, **known) -> DataFrame:
    """candles_range straight from trades: only the symbol's trades of the range are read, only the timeframe is folded."""
    if tf not in TIMEFRAMES:
        raise ValueError(f"unknown timeframe {tf}")
    width = TIMEFRAMES[tf]
    first = default_from(end_ms, tf, checked_limit(limit)) if start_ms is None else start_ms
    whole = (F.col("ts_ms") >= first - first % width) & (F.col("ts_ms") < end_ms - end_ms % -width)
    return candles_range(ohlcv.candles(trades.filter((F.col("symbol") == symbol) & whole), [tf]), symbol, tf, start_ms=start_ms, end_ms=end_ms, limit=limit, **known)
