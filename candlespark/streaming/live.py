"""Live candles: a stateful processor for each symbol, and an idempotent sink.

Spark's own watermark is one for the whole query, moves once a batch and drops
late rows. Here every symbol has its own, which moves with every trade; late
trades come out as rows of their own; candles come out open and closed.
"""

from __future__ import annotations

import json
from collections import defaultdict
from collections.abc import Iterable, Iterator
from decimal import Context, Decimal
from itertools import accumulate
from typing import NamedTuple

from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery
from pyspark.sql.streaming.listener import StreamingQueryListener

from candlespark.operators.lateness import ALLOWED_LATENESS_MS, IDLE_GRACE_MS
from candlespark.schemas import BASE_TIMEFRAME, CANDLE, LATE, TIMEFRAMES, TRADE
from candlespark.sources.store import Store

EXACT = Context(prec=38)
#: ``kind`` is candle, late, trade (accepted, its time in ``time``), refused (by the decoder) or mark (the symbol's watermark, in ``time``); numbers are exact, ``seq`` orders the snapshots of a key.
OUTPUT = "kind string, symbol string, tf string, time long, open decimal(18,8), high decimal(18,8), low decimal(18,8), close decimal(18,8), volume decimal(28,8), quote_volume decimal(38,16), trades long, closed boolean, seq long, payload string, detail string, source string, reason string, trade_id string, price decimal(18,8), qty decimal(18,8), side string, arrival long"
_NAMES = [c.split()[0] for c in OUTPUT.split(", ")]


def output(**values) -> Row:
    """An OUTPUT row; what isn't given is null."""
    return Row(**(dict.fromkeys(_NAMES) | values))


MINUTE = TIMEFRAMES[BASE_TIMEFRAME]


def number(units: int, places: int = 8) -> Decimal:
    return EXACT.scaleb(Decimal(units), -places)


class Fold(NamedTuple):
    """What some trades come to: ohlcv.partial_minutes for one bucket, in whole units of 1e-8 (quote: 1e-16).

    ``first`` and ``last`` are a trade's (ts_ms, length of id, id, source,
    arrival, price), so that they order as open and close do.
    """

    first: tuple
    last: tuple
    high: int
    low: int
    volume: int
    quote: int
    trades: int

    def saved(self) -> list:
        return list(self)

    @classmethod
    def loaded(cls, saved: list) -> Fold:
        first, last, *numbers = saved
        return cls(tuple(first), tuple(last), *numbers)

    def candle(self) -> dict:
        return {"open": number(self.first[-1]), "high": number(self.high), "low": number(self.low), "close": number(self.last[-1]), "volume": number(self.volume), "quote_volume": number(self.quote, 16), "trades": self.trades}


def fold_of(row: Row) -> Fold:
    at = (row.ts_ms, len(row.trade_id), row.trade_id, row.source, row.arrival, row.price)
    return Fold(at, at, row.price, row.price, row.qty, row.price * row.qty, 1)


def merged(folds: Iterable[Fold]) -> Fold:
    """Of any number of folds, in any order."""
    first, last, high, low, volume, quote, trades = zip(*folds, strict=True)
    return Fold(min(first), max(last), max(high), min(low), sum(volume), sum(quote), sum(trades))


class CandleProcessor(StatefulProcessor):
    """State of a symbol: its watermark; the folds of open minutes; of each higher open bucket the fold of its minutes that have closed; ids seen in open minutes.

    A trade goes into its minute's fold alone. Higher timeframes are merged from
    minutes when they are written out, and a minute that closes is merged into
    what is held for them. Ids are kept in one piece a minute and batch, so that
    a batch writes only those that are new.
    """

    def __init__(self, allowed_ms: int = ALLOWED_LATENESS_MS, grace_ms: int | None = None) -> None:
        self.allowed, self.grace = allowed_ms, grace_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.mark = handle.getValueState("mark", "watermark long, seq long")
        self.open = handle.getMapState("open", "minute long", "saved string")
        self.past = handle.getMapState("past", "tf string, bucket long", "saved string")
        self.seen = handle.getMapState("seen", "minute long, piece int", "ids string")

    def _load(self) -> None:
        saved = self.mark.get() if self.mark.exists() else None
        self.watermark, self.seq = (saved[0], saved[1]) if saved else (None, 0)
        held = {k[0]: json.loads(v[0]) for k, v in self.open.iterator()}
        self.minutes = {minute: Fold.loaded(fold) for minute, (fold, _) in held.items()}
        self.pieces = defaultdict(int, {minute: n for minute, (_, n) in held.items()})
        self.parts = {(k[0], k[1]): Fold.loaded(json.loads(v[0])) for k, v in self.past.iterator()}

    def _new(self, minute: int, rows: list[Row]) -> list[Row]:
        """The rows of a minute whose ids weren't seen in it, which are seen from here on."""
        known = {tuple(key) for n in range(self.pieces[minute]) for key in json.loads(self.seen.getValue((minute, n))[0])}
        firsts = {(r.source, r.trade_id): r for r in reversed(rows)}
        new = [r for r in rows if (r.source, r.trade_id) not in known and firsts[r.source, r.trade_id] is r]
        if new:
            self.seen.updateValue((minute, self.pieces[minute]), (json.dumps([(r.source, r.trade_id) for r in new]),))
            self.pieces[minute] += 1
        return new

    def _flush(self, symbol: str, touched: set[int]) -> Iterator[Row]:
        """A row for each bucket that a new trade touched or the watermark has passed; what stays open is saved."""
        rows = []
        for tf, width in TIMEFRAMES.items():
            folds = defaultdict(list)
            for minute, fold in self.minutes.items():
                folds[minute - minute % width].append(fold)
            for name, bucket in self.parts:
                if name == tf:
                    folds[bucket].append(self.parts[tf, bucket])
            fresh = {minute - minute % width for minute in touched}
            rows += [(bucket, width, tf, merged(held), bucket + width <= self.watermark) for bucket, held in folds.items() if bucket in fresh or bucket + width <= self.watermark]
        for bucket, _, tf, fold, closed in sorted(rows, key=lambda r: r[:2]):
            self.seq += 1
            yield output(kind="candle", symbol=symbol, tf=tf, time=bucket, **fold.candle(), closed=closed, seq=self.seq)
        self._save(touched)
        yield output(kind="mark", symbol=symbol, time=self.watermark, seq=self.seq)

    def _save(self, touched: set[int]) -> None:
        ended = [minute for minute in self.minutes if minute + MINUTE <= self.watermark]
        changed = set()
        for minute in ended:
            fold = self.minutes.pop(minute)
            for tf, width in TIMEFRAMES.items():
                at = (tf, minute - minute % width)
                if at[1] + width > self.watermark:
                    self.parts[at] = merged([fold, self.parts[at]]) if at in self.parts else fold
                    changed.add(at)
            for n in range(self.pieces.pop(minute)):
                self.seen.removeKey((minute, n))
            if self.open.containsKey((minute,)):
                self.open.removeKey((minute,))
        for minute in touched & self.minutes.keys():
            self.open.updateValue((minute,), (json.dumps([self.minutes[minute].saved(), self.pieces[minute]]),))
        for at in changed:
            self.past.updateValue(at, (json.dumps(self.parts[at].saved()),))
        for at in [a for a in self.parts if a[1] + TIMEFRAMES[a[0]] <= self.watermark]:
            del self.parts[at]
            self.past.removeKey(at)
        self.mark.update((self.watermark, self.seq))

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        (symbol,) = key
        self._load()
        # a shuffle keeps no order, so arrival says it
        order = sorted(rows, key=lambda r: (r.arrival, len(r.trade_id), r.trade_id, r.source))
        start = [] if self.watermark is None else [self.watermark]
        marks = list(accumulate(start + [r.ts_ms - self.allowed for r in order], max))
        before = marks if start else [None, *marks]  # the watermark when each arrived
        on_time = defaultdict(list)
        for row, mark in zip(order, before, strict=False):
            minute = row.ts_ms - row.ts_ms % MINUTE
            if mark is None or minute + MINUTE > mark:
                on_time[minute].append(row)
                continue
            self.seq += 1
            said = json.dumps({"source": row.source, "symbol": symbol, "trade_id": row.trade_id, "price": f"{number(row.price):f}", "qty": f"{number(row.qty):f}", "side": row.side, "ts_ms": row.ts_ms})
            yield output(kind="late", symbol=symbol, time=row.ts_ms, seq=self.seq, payload=said, detail=str(mark), source=row.source, reason=LATE)
        touched = set()
        for minute, found in on_time.items():
            new = self._new(minute, found)
            if new:
                touched.add(minute)
                self.minutes[minute] = merged([*(f for m, f in self.minutes.items() if m == minute), *map(fold_of, new)])
            for row in new:
                yield output(kind="trade", symbol=symbol, time=row.ts_ms, source=row.source, trade_id=row.trade_id, price=number(row.price), qty=number(row.qty), side=row.side, arrival=row.arrival)
        self.watermark = marks[-1]
        if self.grace is not None:
            now = timerValues.getCurrentProcessingTimeInMs()
            self.watermark = max(self.watermark, now - self.allowed - self.grace)
        yield from self._flush(symbol, touched)
        if self.grace is not None:
            self._wake(now)

    def _wake(self, now: int) -> None:
        """Look again when the earliest open bucket would be idle; one timer at a time."""
        for timer in list(self.handle.listTimers()):
            self.handle.deleteTimer(timer)
        ends = [minute + MINUTE for minute in self.minutes] + [bucket + TIMEFRAMES[tf] for tf, bucket in self.parts]
        if ends:
            self.handle.registerTimer(max(now + 1, min(ends) + self.allowed + self.grace))

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        (symbol,) = key
        self._load()
        now = timerValues.getCurrentProcessingTimeInMs()
        self.watermark = max(self.watermark, now - self.allowed - (self.grace or 0))
        yield from list(self._flush(symbol, set()))
        self._wake(now)

    def close(self) -> None:
        pass


def live_candles(trades: DataFrame, allowed_ms: int = ALLOWED_LATENESS_MS, grace_ms: int | None = None) -> DataFrame:
    """OUTPUT rows of a stream of trades; with ``grace_ms`` (live only) quiet symbols close on the clock."""
    units = [(F.col(c) * F.lit(100_000_000)).cast("bigint").alias(c) for c in ("price", "qty")]
    rows = trades.select("source", "symbol", "trade_id", *units, "side", "ts_ms", F.coalesce("arrival", "ts_ms").alias("arrival"))
    return rows.groupBy("symbol").transformWithState(
        statefulProcessor=CandleProcessor(allowed_ms, grace_ms), outputStructType=OUTPUT, outputMode="Update", timeMode="None" if grace_ms is None else "ProcessingTime"
    )


def into_store(store: Store):
    """A foreachBatch function: candles, the trade log, dead letters and checkpoints in one commit, a batch at most once."""

    def write(rows: DataFrame, batch: int) -> None:
        rows = rows.persist()  # the stateful stage must run once
        try:
            letters = rows.filter("kind in ('late', 'refused')").select("source", "reason", "payload", "detail", F.lit("aggregate").alias("stage"))
            accepted = rows.filter("kind = 'trade'").withColumn("ts_ms", F.col("time")).withColumn("ts", F.timestamp_millis("time"))
            marks = rows.filter("kind = 'mark'").groupBy("symbol").agg(F.max("time").alias("watermark"))
            store.apply(candles=rows.filter("kind = 'candle'").select(*CANDLE.fieldNames(), "seq"), trades=accepted.select(*TRADE.fieldNames()), letters=letters, marks=marks, batch=batch)
        finally:
            rows.unpersist()

    return write


def refused(rejections: DataFrame) -> DataFrame:
    """OUTPUT rows of a stream of decoders.rejections_of rows."""
    given = {"kind": F.lit("refused"), **{c: F.col(c) for c in ("source", "reason", "payload", "detail")}}
    return rejections.select(*[given.get(name, F.lit(None)).cast(kind).alias(name) for name, kind in (c.split() for c in OUTPUT.split(", "))])


def run(trades: DataFrame, store: Store, checkpoint: str, *, rejections: DataFrame | None = None, allowed_ms: int = ALLOWED_LATENESS_MS, grace_ms: int = IDLE_GRACE_MS, live: bool = True, interval: str = "1 second") -> StreamingQuery:
    """Start the service: live with the idle clock, or a finite replay of what is there.

    ``rejections`` of the same stream are dead-lettered in the commit of their batch.
    """
    rows = live_candles(trades, allowed_ms, grace_ms if live else None)
    if rejections is not None:
        rows = rows.unionByName(refused(rejections))
    writer = rows.writeStream.outputMode("update").option("checkpointLocation", checkpoint).foreachBatch(into_store(store))
    return (writer.trigger(processingTime=interval) if live else writer.trigger(availableNow=True)).start()


class LagListener(StreamingQueryListener):
    """Rows in, rows a second, time taken, files behind and state size of each batch, for a lag probe."""

    def __init__(self) -> None:
        self.batches: list[dict] = []

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        p = event.progress
        self.batches.append({"batch": p.batchId, "rows": p.numInputRows, "rows_a_second": p.processedRowsPerSecond, "batch_ms": p.batchDuration, "behind": [s.metrics for s in p.sources], "state_rows": sum(s.numRowsTotal for s in p.stateOperators)})

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass
