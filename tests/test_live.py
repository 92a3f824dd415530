"""The live processor: replays, restarts and idle symbols."""

from __future__ import annotations

import json
import time
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from candlespark.__main__ import main
from candlespark.operators import dedup, lateness, ohlcv
from candlespark.schemas import TRADE
from candlespark.sources.store import Store
from candlespark.streaming import live
from tests.test_candles import T0, frame, got_candles, random_trades, trade


@pytest.fixture(scope="module")
def session(spark):
    other = spark.newSession()
    for key in ("spark.sql.shuffle.partitions", "spark.sql.session.timeZone"):
        other.conf.set(key, spark.conf.get(key))
    other.conf.set("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    return other


def replay(session, store, at):
    rows = session.readStream.schema(TRADE).option("maxFilesPerTrigger", 1).parquet(f"{at}/in")
    live.run(rows, store, f"{at}/checkpoint", allowed_ms=5_000, live=False).awaitTermination()


def test_replay_with_a_restart_equals_the_batch(spark, session, tmp_path):
    """Half, stop, the rest with copies of the first: candles, flags and dead letters are those of one batch."""
    at = f"file://{tmp_path}"
    rows = frame(spark, random_trades(7)).orderBy("arrival").persist()
    middle = T0 + 600_000
    store = Store(session, f"{at}/store")
    rows.filter(F.col("arrival") < middle).coalesce(1).write.parquet(f"{at}/in")
    replay(session, store, at)
    again = rows.filter((F.col("arrival") < middle) & (F.col("ts_ms") >= middle - 50_000)).withColumn("arrival", F.lit(middle))
    rest = rows.filter(F.col("arrival") >= middle).unionByName(again).persist()
    rest.coalesce(1).write.mode("append").parquet(f"{at}/in")
    replay(session, store, at)
    replay(session, store, at)  # nothing new: nothing changes
    everything = rows.filter(F.col("arrival") < middle).unionByName(rest)
    judged = lateness.split_late(everything, 5_000)
    batch = ohlcv.candles(dedup.keep_first(judged.filter("not late")))
    assert got_candles(store.candles()) == got_candles(batch)
    flags = lateness.with_closed(batch, lateness.watermarks(everything, 5_000))
    key = lambda df: {(r.symbol, r.tf, r.time): r.closed for r in df.collect()}
    assert key(store.candles()) == key(flags)
    assert store.dead_letters().count() == judged.filter("late").count()
    marks = {r.symbol: r.watermark for r in lateness.watermarks(everything, 5_000).collect()}
    assert {r.symbol: r.watermark for r in store.watermarks().collect()} == marks


def test_a_quiet_symbol_closes_on_the_clock(spark, session, tmp_path):
    at = f"file://{tmp_path}"
    store = Store(session, f"{at}/store")
    now = int(time.time() * 1000)
    old = now - now % 60_000 - 120_000
    frame(spark, [trade(1, old - T0, "5")]).coalesce(1).write.parquet(f"{at}/in")
    rows = session.readStream.schema(TRADE).parquet(f"{at}/in")
    query = live.run(rows, store, f"{at}/checkpoint", live=True)
    try:
        for _ in range(120):
            time.sleep(1)
            if store.candles().filter("tf = '1m' and closed").count():
                break
        assert store.candles().filter("tf = '1m' and closed").count() == 1
        assert store.candles().filter("tf = '1d' and closed").count() == 0
    finally:
        query.stop()


def test_verbs_keep_every_row(spark, tmp_path, monkeypatch):
    """What ingest and aggregate refuse is dead-lettered, what they accept is logged, once."""
    at = f"file://{tmp_path}"
    for name in ("store", "stream", "checkpoint"):
        monkeypatch.setenv(f"CANDLES_{name.upper()}", f"{at}/{name}")
    provider = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(provider)
    now = int(time.time() * 1000)
    event = {"e": "trade", "s": "BTCUSDT", "t": 12, "p": "41250.5", "q": "0.015", "T": 1740900600777, "m": True}
    lines = [json.dumps(event), json.dumps(event | {"t": 13}), json.dumps(event | {"t": 14, "T": now + 86_400_000}), "{"]
    spark.createDataFrame([(line,) for line in lines], "raw string").coalesce(1).write.text(f"{at}/frames")
    try:
        main(["ingest", "binance", f"{at}/frames"])
        store = Store(spark, f"{at}/store")
        letters = lambda: sorted((r.reason, r.stage) for r in store.dead_letters().collect())
        assert letters() == [("future", "ingest"), ("malformed", "ingest")]
        spark.createDataFrame([("BTC-USDT", "junk")], "symbol string, value string").write.mode("append").partitionBy("symbol").text(f"{at}/stream")
        for _ in range(2):
            main(["aggregate", "--once"])
            assert letters() == [("future", "ingest"), ("malformed", "aggregate"), ("malformed", "ingest")]
            assert sorted((r.trade_id, r.ts_ms, r.price) for r in store.trades().collect()) == [(t, 1740900600777, Decimal("41250.5")) for t in ("12", "13")]
            assert store.candles().filter("tf = '1m'").select("trades").collect()[0][0] == 2
    finally:
        spark.conf.set(provider, before)
