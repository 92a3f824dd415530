"""Candle semantics against a per-record model in plain Python."""

from __future__ import annotations

import random
from collections import Counter
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from candlespark.operators import dedup, gaps, lateness, merge, metrics, ohlcv, validate
from candlespark.plans import jobs
from candlespark.schemas import CANDLE, TIMEFRAMES, TRADE

T0 = 1_704_067_200_000
MINUTE = 60_000


def trade(i, ms, price, qty="1", symbol="BTC-USDT", source="s", side="buy", arrival=None):
    return (source, symbol, str(i), Decimal(price), Decimal(qty), side, None, T0 + ms, T0 + ms if arrival is None else arrival)


def frame(spark, rows):
    return spark.createDataFrame(rows, TRADE)


class Model:
    """Trades one by one: watermark, lateness, duplicates, candles."""

    def __init__(self, allowed):
        self.allowed, self.mark, self.seen, self.candles, self.late = allowed, {}, set(), {}, []

    def add(self, t):
        source, symbol, tid, price, qty, _, _, ms, _ = t
        mark = self.mark.get(symbol)
        if mark is not None and ms - ms % MINUTE + MINUTE <= mark:
            self.late.append(tid)
            return
        self.mark[symbol] = max(mark if mark is not None else ms - self.allowed, ms - self.allowed)
        if (source, tid) in self.seen:
            return
        self.seen.add((source, tid))
        for tf, width in TIMEFRAMES.items():
            self.candles.setdefault((symbol, tf, ms - ms % width), []).append(((ms, len(tid), tid, source), price, qty))

    def result(self):
        out = {}
        for k, rows in self.candles.items():
            rows = sorted(rows, key=lambda r: r[0])
            prices = [r[1] for r in rows]
            out[k] = (prices[0], max(prices), min(prices), prices[-1], sum(r[2] for r in rows), sum(r[1] * r[2] for r in rows), len(rows))
        return out


def random_trades(seed, n=400, symbols=("BTC-USDT", "ETH-USDT")):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        ms = rng.randrange(0, 1_200_000)
        rows.append(trade(i, ms, f"{rng.randint(1, 9999)}.{rng.randint(0, 99999999):08d}", f"0.{rng.randint(1, 99999999):08d}", rng.choice(symbols), arrival=T0 + ms + rng.randrange(0, 30_000)))
    return rows


def got_candles(df):
    return {(r.symbol, r.tf, r.time): (r.open, r.high, r.low, r.close, r.volume, r.quote_volume, r.trades) for r in df.collect()}


@pytest.mark.parametrize("seed", [1, 2])
def test_on_time_candles_equal_the_model(spark, seed):
    rows = random_trades(seed)
    rows += random.Random(seed).sample(rows, 20)
    rows = [(*r[:8], r[8] + i % 3) for i, r in enumerate(rows)]
    model = Model(5_000)
    for t in sorted(rows, key=lambda t: (t[8], len(t[2]), t[2], t[0])):
        model.add(t)
    judged = lateness.split_late(frame(spark, rows), 5_000)
    assert Counter(r.trade_id for r in judged.filter("late").collect()) == Counter(model.late)
    assert got_candles(ohlcv.candles(dedup.keep_first(judged.filter("not late")))) == model.result()


def test_shuffling_batching_and_copies_change_nothing(spark):
    rows = random_trades(3)
    direct = got_candles(ohlcv.candles(frame(spark, rows)))
    random.Random(0).shuffle(rows)
    assert got_candles(ohlcv.candles(dedup.keep_first(frame(spark, rows + rows[:50]).repartition(5)))) == direct


def test_boundaries_empty_minutes_and_ties(spark):
    rows = [trade(9, 59_999, "1"), trade(10, 60_000, "2"), trade(2, 180_000, "5"), trade(10, 180_000, "6", source="t"), trade(3, 180_000, "7")]
    got = got_candles(ohlcv.candles(frame(spark, rows), ["1m"]))
    assert {k[2] - T0 for k in got} == {0, 60_000, 180_000}
    assert got[("BTC-USDT", "1m", T0 + 180_000)][0] == 5 and got[("BTC-USDT", "1m", T0 + 180_000)][3] == 6
    before = [trade(1, -1 - T0, "1")]
    assert next(iter(got_candles(ohlcv.candles(frame(spark, before), ["1m"]))))[2] == -60_000


def test_closing_waits_for_the_lateness(spark):
    for ms, closed in ((64_999, False), (65_000, True)):
        rows = frame(spark, [trade(1, 0, "1"), trade(2, ms, "2")])
        out = lateness.with_closed(ohlcv.candles(rows, ["1m"]), lateness.watermarks(rows, 5_000))
        assert {r.time - T0: r.closed for r in out.collect()} == {0: closed, 60_000: False}
    marks = spark.createDataFrame([("BTC-USDT", T0)], "symbol string, watermark long")
    assert lateness.advanced(marks, T0 + 8_000).first().watermark == T0 + 1_000
    assert lateness.advanced(marks, T0 - 90_000).first().watermark == T0
    assert lateness.advanced(marks, T0 + 99_000, grace_ms=None).first().watermark == T0


def test_a_copy_of_a_trade_of_a_closed_minute_is_late(spark):
    rows = [trade(1, 0, "1", arrival=1), trade(2, 70_000, "2", arrival=2), trade(1, 0, "1", arrival=3), trade(3, 30_000, "3", arrival=4)]
    late = lateness.split_late(frame(spark, rows), 5_000).filter("late").collect()
    assert sorted((r.trade_id, r.arrival) for r in late) == [("1", 3), ("3", 4)]
    candles, letters, marks = jobs.folded(frame(spark, rows), ["BTC-USDT"], T0 + 80_000, 5_000)
    assert letters.filter("reason = 'late'").count() == 2 and candles.filter("tf = '1d'").first().trades == 2
    assert marks.first().watermark == T0 + 65_000


def test_the_gate_and_its_order(spark):
    rows = [trade(1, 0, "1"), trade(2, 0, "0"), trade(3, 0, "1", symbol="DOGE-USDT"), trade(4, 130_001, "1"), trade(5, 130_000, "1"), trade("", 0, "-1", symbol="btc", side="Buy")]
    gated = validate.gate(frame(spark, rows), ["BTC-USDT"], T0 + 100_000).collect()
    assert [(r.trade_id, r.reason) for r in gated] == [("1", None), ("2", "malformed"), ("3", "unknown_symbol"), ("4", "future"), ("5", None), ("", "malformed")]
    assert gated[-1].detail == "symbol: must be BASE-QUOTE; trade_id: must not be empty; price: must be a number above 0; side: must be buy or sell"
    bad = validate.gate(frame(spark, [trade(1, 0, "1", symbol="BTC-USDT\n")]), ["BTC-USDT"], T0)
    assert bad.first().reason == "malformed"


def test_dedup_window_forgets_the_oldest(spark):
    rows = [trade(i, 0, "1", arrival=k) for k, i in enumerate([1, 2, 1, 3, 1, 2, 4])]
    passed = dedup.within_last(frame(spark, rows), 2).orderBy("arrival").collect()
    assert [r.trade_id for r in passed] == ["1", "2", "3", "1", "2", "4"]


def candle(time, o, closed=False, symbol="A-B", tf="1m", n=1):
    return (symbol, tf, T0 + time, Decimal(o), Decimal(o), Decimal(o), Decimal(o), Decimal(1), Decimal(o), n, closed)


def test_guarded_upsert_is_the_fold(spark):
    rng = random.Random(4)
    table, changes, state = [candle(0, 1, True), candle(MINUTE, 1)], [], {T0: (1, True), T0 + MINUTE: (1, False)}
    for seq in range(60):
        c = candle(rng.choice([0, MINUTE, 2 * MINUTE, 3 * MINUTE]), seq + 2, rng.random() < 0.3)
        changes.append((*c, seq))
        if c[2] not in state or not state[c[2]][1] or c[10]:
            state[c[2]] = (seq + 2, c[10])
    out = merge.guarded_upsert(spark.createDataFrame(table, CANDLE), spark.createDataFrame(changes, CANDLE.simpleString().removeprefix("struct<").removesuffix(">") + ", seq: long"))
    assert {r.time: (int(r.open), r.closed) for r in out.collect()} == state


def test_gaps_runs_and_no_history(spark):
    table = spark.createDataFrame([candle(m * MINUTE, 1) for m in (5, 6, 9, 12)] + [candle(0, 1, tf="5m")], CANDLE)
    lost = gaps.missing(table, T0, T0 + 15 * MINUTE)
    assert sorted((r.time - T0) // MINUTE for r in lost.collect()) == [7, 8, 10, 11, 13, 14]
    assert sorted(((r.start - T0) // MINUTE, (r.end - T0) // MINUTE, r.n) for r in gaps.runs(lost).collect()) == [(7, 9, 2), (10, 12, 2), (13, 15, 2)]
    assert gaps.missing(table, T0 + 20 * MINUTE, T0 + 30 * MINUTE).count() == 0


def test_an_outage_of_months_is_one_run(spark):
    days = 100 * 1440
    table = spark.createDataFrame([candle(0, 1), candle(days * MINUTE, 1)], CANDLE)
    lost = gaps.runs(gaps.missing(table, T0, T0 + (days + 1) * MINUTE))
    assert [tuple(r) for r in lost.select("symbol", "start", "end", "n").collect()] == [("A-B", T0 + MINUTE, T0 + days * MINUTE, days - 1)]


def test_rollup_takes_whole_buckets(spark):
    table = spark.createDataFrame([candle(m * MINUTE, m + 1) for m in range(12)], CANDLE)
    rolled = ohlcv.rollup(table, "5m", T0 + 6 * MINUTE, T0 + 11 * MINUTE).collect()
    assert [((r.time - T0) // MINUTE, r.open, r.close, r.trades, r.closed) for r in rolled] == [(5, 6, 10, 5, True)]


def source_of(spark, asked):
    def klines(symbol, ranges):
        asked.extend(ranges)
        rows = [candle(m - T0, 7, True, symbol) for a, b in ranges for m in range(a, b, MINUTE)]
        return spark.createDataFrame(rows, CANDLE)

    return klines


def test_repair_asks_for_runs_and_stops_at_the_watermark(spark):
    table = spark.createDataFrame([candle(m * MINUTE, 1, True) for m in (0, 3, 4, 8)], CANDLE)
    marks = spark.createDataFrame([("A-B", T0 + 10 * MINUTE + 59_999)], "symbol string, watermark long")
    asked: list = []
    out, found = jobs.repair(table, marks, source_of(spark, asked), "A-B", 86_400_000, 0)
    assert [((a - T0) // MINUTE, (b - T0) // MINUTE) for a, b in asked] == [(1, 3), (5, 8), (9, 10)]
    assert out.filter("tf = '1m'").count() == 10 and {((r.time - T0) // MINUTE): r.trades for r in out.filter("tf = '5m'").collect()} == {0: 5, 5: 5}
    assert found.first().asDict() == {"symbol": "A-B", "missing": 6, "repaired": 6}


def test_backfill_is_capped(spark):
    asked: list = []
    empty = spark.createDataFrame([], CANDLE)
    none = spark.createDataFrame([], "symbol string, watermark long")
    out = jobs.backfill(empty, none, source_of(spark, asked), "A-B", T0 + 30_000, T0 + 99 * MINUTE, T0 + 12 * MINUTE + 30_000)
    assert asked == [(T0, T0 + 10 * MINUTE)] and out.filter("tf = '1m'").count() == 10
    assert jobs.backfill(empty, none, source_of(spark, asked), "A-B", T0 + 20 * MINUTE, T0 + 30 * MINUTE, T0) is empty


def test_ranges(spark):
    table = spark.createDataFrame([candle(m * MINUTE, 1) for m in range(10)], CANDLE)
    read = lambda **k: [(r.time - T0) // MINUTE for r in jobs.candles_range(table, "A-B", "1m", symbols=["A-B"], **k).collect()]
    assert read(start_ms=T0, end_ms=T0 + 5 * MINUTE, limit=3) == [0, 1, 2]
    assert read(end_ms=T0 + 10 * MINUTE, limit=3) == [7, 8, 9]
    for wrong in ({"limit": 0, "end_ms": T0}, {"limit": 5001, "end_ms": T0}, {"start_ms": T0, "end_ms": T0}):
        with pytest.raises(ValueError):
            read(**wrong)
    with pytest.raises(LookupError):
        jobs.candles_range(table, "X-Y", "1m", symbols=["A-B"], end_ms=T0)


def test_metrics(spark):
    rows = spark.range(11).withColumn("g", F.lit("x"))
    assert metrics.percentiles(rows, F.col("id"), [0.5, 0.99]).first().asDict() == {"p50": 5.0, "p99": 9.9}
    assert metrics.quantiles_of_buckets(rows, F.col("id"), [0.5]).first().p50 == 5
    seen_rows, seen = metrics.observed(frame(spark, [trade(1, 0, "1")]))
    seen_rows.write.format("noop").mode("overwrite").save()
    assert seen.get == {"rows": 1, "max_event_ms": T0}
