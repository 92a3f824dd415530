from __future__ import annotations

import json
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from candlespark.config import Settings
from candlespark.functions import numbers, timeutil
from candlespark.schemas import CANDLE, TRADE
from candlespark.sources import channels, decoders, synthetic
from candlespark.sources.store import Store
from tests.test_candles import MINUTE, T0, candle, frame, trade

SYMBOLS = ["BTC-USDT", "BTC-USD"]


def decoded(spark, decoder, *raw, **options):
    rows = spark.createDataFrame([(r if isinstance(r, str) else json.dumps(r),) for r in raw], "raw string")
    return decoder(rows, SYMBOLS, **options).collect()


BINANCE = {"e": "trade", "s": "BTCUSDT", "t": 12, "p": "41250.50000000", "q": "0.01500000", "T": 1740900600777, "m": True}


def test_binance(spark):
    good = decoded(spark, decoders.binance, {"stream": "x", "data": BINANCE}, BINANCE | {"m": False})
    assert [(r.symbol, r.trade_id, r.price, r.qty, r.side, r.ts_ms, r.reason) for r in good] == [("BTC-USDT", "12", Decimal("41250.5"), Decimal("0.015"), side, 1740900600777, None) for side in ("sell", "buy")]
    bad = decoded(spark, decoders.binance, "{", "[1]", {"result": None, "id": 1}, BINANCE | {"s": "DOGEUSDT"}, {k: v for k, v in BINANCE.items() if k != "p"}, BINANCE | {"p": "x"}, BINANCE | {"q": "0"}, BINANCE | {"T": "soon"})
    assert [(r.reason, r.detail) for r in bad][2] == ("unknown_symbol", "DOGEUSDT")
    assert [r.reason for r in bad] == ["malformed", "malformed", "unknown_symbol", "malformed", "malformed", "malformed", "malformed"]
    assert all(r.payload for r in bad)


def kraken_item(**more):
    return {"symbol": "BTC/USD", "side": "sell", "price": 39870.2, "qty": 0.0125, "trade_id": 7, "timestamp": "2025-03-02T07:30:00.305118Z"} | more


def test_kraken(spark):
    raw = '{"channel":"trade","data":[{"symbol":"BTC/USD","side":"buy","price":1234567890.12345678,"qty":0.00730000,"trade_id":1,"timestamp":"2025-03-02T07:30:00.305118Z"}]}'
    (one,) = decoded(spark, decoders.kraken, raw)
    assert (one.price, one.qty, one.ts_ms, one.symbol) == (Decimal("1234567890.12345678"), Decimal("0.0073"), 1740900600305, "BTC-USD")
    frame_of = lambda *items: {"channel": "trade", "data": list(items)}
    rows = decoded(spark, decoders.kraken, {"channel": "heartbeat"}, frame_of(kraken_item(), kraken_item(symbol="X/Y"), kraken_item(qty=0)), frame_of(kraken_item(), {"symbol": "BTC/USD"}), frame_of(kraken_item(timestamp="2025-03-02T07:30:00")), "nope")
    assert [r.reason for r in rows] == [None, "unknown_symbol", "malformed", "malformed", "malformed", "malformed"]
    assert rows[3].detail == "an item lacks a field"


def test_engine(spark):
    fmt = decoders.EngineFormat(price_scale=2, qty_scale=4)
    event = {"type": "trade", "trade_id": 4401, "symbol": "BTCUSDT", "price": 4125050, "qty": 175, "taker_side": "BUY", "ts": 1740900600777}
    rows = decoded(spark, decoders.engine, event, [event, {"type": "order_accepted"}, {k: v for k, v in event.items() if k != "type"}], {"type": "order"}, [event, event | {"price": "oops"}], event | {"symbol": "DOGE"}, event | {"taker_side": "x"}, "7", "{", fmt=fmt)
    assert [r.reason for r in rows] == [None, None, None, "malformed", "unknown_symbol", "malformed", "malformed", "malformed"]
    assert (rows[0].price, rows[0].qty, rows[0].side, rows[0].symbol) == (Decimal("41250.5"), Decimal("0.0175"), "buy", "BTC-USDT")
    for unit, ts, ms in (("s", 1740900600.5, 1740900600500), ("us", 1740900600777999, 1740900600777), ("ns", 1740900600777999999, 1740900600777), ("iso", "2025-03-02T07:30:00.777Z", 1740900600777)):
        (row,) = decoded(spark, decoders.engine, event | {"ts": ts}, fmt=decoders.EngineFormat(price_scale=2, ts_unit=unit))
        assert row.ts_ms == ms
    (named,) = decoded(spark, decoders.engine, {"id": 1, "sym": "BTC/USDT", "px": "0.1", "q": "2", "s": "sell", "t": 5}, fmt=decoders.EngineFormat("id", "sym", "px", "q", "s", "t"))
    assert named.price == Decimal("0.1")


def test_wire_round_trip_and_streams(spark, tmp_path):
    rows = frame(spark, [trade(1, 0, "0.00000001", "12345.5"), trade(2, 1, "3", symbol="ETH-USDT")])
    channels.append_trades(rows, f"{tmp_path}/stream")
    back = channels.read_trades(spark, f"{tmp_path}/stream").writeStream.format("memory").queryName("back").trigger(availableNow=True).start()
    back.awaitTermination()
    got = spark.table("back").orderBy("trade_id").collect()
    assert [(r.trade_id, r.price, r.qty, r.reason) for r in got] == [("1", Decimal("1E-8"), Decimal("12345.5"), None), ("2", Decimal(3), Decimal(1), None)]
    bad = decoders.wire(spark.createDataFrame([("{}",), ("x",), ('{"price": 1e400}',)], "raw string")).collect()
    assert {(r.source, r.reason) for r in bad} == {("unknown", "malformed")}


def test_klines(spark):
    line = lambda t: [t, "1.0", "3", "0.5", "2", "10.00000001", t + 59_999, "20.5", 7, "0", "0", "0"]
    pages = spark.createDataFrame([(json.dumps([line(T0), line(T0 + MINUTE)]),), (json.dumps([line(T0 + MINUTE), line(T0 + 2 * MINUTE)]),)], "raw string")
    got = decoders.binance_klines(pages, "BTC-USDT", [(T0, T0 + 2 * MINUTE)]).collect()
    assert sorted(r.time for r in got) == [T0, T0 + MINUTE] and got[0].quote_volume == Decimal("20.5") and got[0].trades == 7
    reply = json.dumps({"error": [], "result": {"XXBTZUSD": [[T0 // 1000, "1", "3", "0.5", "2", "1.5", "10", 4], [T0 // 1000 + 60, "1", "1", "1", "1", "1", "1", 1]], "last": 9}})
    (one,) = decoders.kraken_ohlc(spark.createDataFrame([(reply,)], "raw string"), "BTC-USD", [(T0, T0 + 1)]).collect()
    assert (one.time, one.quote_volume, one.trades) == (T0, Decimal(15), 4)


def test_store_commits_whole_and_once(spark, tmp_path):
    store = Store(spark, f"file://{tmp_path}/store")
    store.put_candles(spark.createDataFrame([candle(0, 1, True)], CANDLE))
    changes = spark.createDataFrame([candle(0, 9), candle(MINUTE, 2)], CANDLE).withColumn("seq", F.lit(1))
    assert store.candles().count() == 1
    store.upsert_candles(changes)
    assert {(r.time - T0, int(r.open)) for r in store.candles().collect()} == {(0, 1), (MINUTE, 2)}
    rows = frame(spark, [trade(1, 0, "1"), trade(2, 0, "1"), trade(1, 0, "1")])
    assert {r.trade_id for r in store.insert_trades(rows).collect()} == {"1", "2"}
    assert store.insert_trades(frame(spark, [trade(2, 5, "1"), trade(3, 0, "1")])).first().trade_id == "3"
    same = store.candles().withColumn("seq", F.lit(2))
    assert store.apply(candles=same, batch=4) and not store.apply(candles=same, batch=4)
    store.save_watermarks(spark.createDataFrame([("A-B", 5)], "symbol string, watermark long"))
    store.save_watermarks(spark.createDataFrame([("A-B", 6), ("C-D", 1)], "symbol string, watermark long"))
    assert {tuple(r) for r in store.watermarks(["A-B"]).collect()} == {("A-B", 6)}
    for _ in range(2):
        store.apply(letters=spark.createDataFrame([("s", "late", "{}", "5", "aggregate")], "source string, reason string, payload string, detail string, stage string"))
    store.apply(letters=store.dead_letters().limit(0))
    assert [r.at[:2] for r in store.dead_letters().collect()] == ["20", "20"]
    store.compact("dead_letters", most=1)
    assert store.dead_letters().count() == 2
    store.prune(T0 + 9 * 86_400_000)
    assert store.trades().count() == 0
    assert store.vacuum() and store.candles().count() == 2 and store.dead_letters().count() == 2
    assert Store(spark, f"file://{tmp_path}/store").watermarks().count() == 2


def test_a_commit_touches_its_own_partitions_alone(spark, tmp_path):
    day, week = 86_400_000, 604_800_000
    store = Store(spark, f"file://{tmp_path}/store")
    store.put_candles(spark.createDataFrame([candle(0, 1, True), candle(3 * week, 2, True)], CANDLE))
    store.insert_trades(frame(spark, [trade(1, 0, "1"), trade(2, 2 * day, "1")]))
    before = store.manifest()["tables"]
    store.put_candles(spark.createDataFrame([candle(MINUTE, 3, True)], CANDLE))
    store.insert_trades(frame(spark, [trade(2, 2 * day, "1"), trade(3, 2 * day, "1")]))
    after = store.manifest()["tables"]
    assert [before["candles"][p] == after["candles"][p] for p in sorted(before["candles"])] == [False, True]
    assert [before["trades"][p] == after["trades"][p] for p in sorted(before["trades"])] == [True, False]
    assert store.candles().count() == 3 and store.trades().count() == 3
    assert store.candles("1m", T0 + 3 * week, T0 + 3 * week + 1).count() == 1 and store.candles("5m").count() == 0
    # a second writer of the same version fails
    late = Store(spark, f"file://{tmp_path}/store")
    known = late.manifest()["version"]
    store.save_watermarks(spark.createDataFrame([("A-B", 5)], "symbol string, watermark long"))
    late.manifest = lambda: {"version": known, "batch": -1, "tables": after}
    with pytest.raises(RuntimeError):
        late.save_watermarks(spark.createDataFrame([("A-B", 4)], "symbol string, watermark long"))
    assert store.watermarks().first().watermark == 5


def test_names_of_venues(spark):
    names = ["A-B", "AB", "A/B", "A--B", "B-A", "a-b", "", None, "X-Y", "AB-"]
    rows = spark.createDataFrame([(n,) for n in names], "n string")
    got = rows.select(decoders.canonical(F.col("n"), ["A-B", "C-D"]).alias("s"), decoders.canonical(F.col("n"), ["A-B"], ["/"]).alias("slash"), decoders.canonical(F.col("n"), []).alias("none")).collect()
    assert [r.s for r in got] == ["A-B"] * 3 + [None] * 7
    assert [r.slash for r in got] == [None, None, "A-B"] + [None] * 7 and all(r.none is None for r in got)


def test_pages_of_klines():
    rows, asked = [[t * MINUTE] for t in range(25)], []

    def ask(start, end):
        asked.append((start, end))
        return json.dumps([r for r in rows if start <= r[0] < end][:10])

    found = [r[0] // MINUTE for page in decoders.paged(ask, [(0, 22 * MINUTE), (24 * MINUTE, 40 * MINUTE)], 10) for r in json.loads(page)]
    assert found == [*range(22), 24] and [s // MINUTE for s, _ in asked] == [0, 10, 20, 24]


def test_channels(spark):
    c = spark.createDataFrame([candle(0, "1.50")], CANDLE)
    (sent,) = channels.routed(c, ["candles:A-B:1m", "candles:A-B:2m", "nope"], ["A-B"]).collect()
    body = json.loads(sent.frame)
    assert body["channel"] == "candles:A-B:1m" and body["data"]["open"] == "1.50000000" and body["data"]["closed"] is False
    with pytest.raises(ValueError):
        channels.routed(c, ["x"] * 51, ["A-B"])
    parts = spark.createDataFrame([("candles:A-B:1m",), ("candles:A-B:1m\n",), ("candles:C-D:1m",)], "c string").select(channels.channel_parts(F.col("c"), ["A-B"]).alias("p")).collect()
    assert [p.p is not None for p in parts] == [True, False, False]


def test_times_and_numbers(spark):
    said = {"1740900600777": 1740900600777, "-1": -1, "2025-03-02T07:30:00Z": 1740900600000, "2025-03-02T09:30:00+02:00": 1740900600000, "2025-03-02": 1740873600000, "2025-03-02T07:30": 1740900600000, "yesterday": None, "now": None, "": None, "99999999999999999999": None, "2024-13-01": None}
    got = spark.createDataFrame([(s,) for s in said], "s string").select("s", timeutil.parse_time(F.col("s")).alias("ms")).collect()
    assert {r.s: r.ms for r in got} == said
    texts = {"0.1": Decimal("0.1"), "1.000000000": Decimal(1), "0.123456789": None, "12345678901": None, "1e3": None, "-2": Decimal(-2)}
    assert {r.s: r.n for r in spark.createDataFrame([(t,) for t in texts], "s string").select("s", numbers.exact(F.col("s")).alias("n")).collect()} == texts
    row = spark.range(1).select(numbers.fixed(F.lit("0.00000001").cast("decimal(18,8)")).alias("f"), numbers.scaled(F.lit("4125050"), 2).alias("s")).first()
    assert row.f == "0.00000001" and row.s == Decimal("41250.5")


def test_synthetic_is_seeded(spark):
    a = synthetic.synthetic_trades(spark, n=3000, seed=5)
    b = synthetic.synthetic_trades(spark, n=3000, seed=5).repartition(3)
    assert a.exceptAll(b).count() == 0 and a.exceptAll(synthetic.synthetic_trades(spark, n=3000, seed=6)).count() > 0
    assert a.schema.fieldNames() == TRADE.fieldNames() and a.filter("price <= 0 or qty <= 0").count() == 0
    assert synthetic.live_trades(spark).isStreaming


def test_settings():
    s = Settings.from_env({"CANDLES_SYMBOLS": " A-B, ,C-D", "CANDLES_ALLOWED_LATENESS_MS": "7"})
    assert s.symbols == ("A-B", "C-D") and s.allowed_lateness_ms == 7 and Settings.from_env({}) == Settings()
