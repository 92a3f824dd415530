"""Verbs: ``python -m candlespark migrate|ingest|aggregate|read|repair|backfill|compact``; also for spark-submit."""

from __future__ import annotations

import argparse
import time

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from candlespark.config import Settings
from candlespark.operators import dedup
from candlespark.operators.validate import admitted, dead_letters, gate
from candlespark.plans import jobs
from candlespark.sources import channels, decoders
from candlespark.sources.store import Store
from candlespark.streaming import live


def main(args: list[str] | None = None) -> int:
    parser = argparse.ArgumentParser(prog="candlespark")
    verbs = parser.add_subparsers(dest="verb", required=True)
    verbs.add_parser("migrate")
    ingest = verbs.add_parser("ingest", help="recorded venue frames to the trade stream")
    ingest.add_argument("venue", choices=["binance", "kraken", "engine"])
    ingest.add_argument("frames")
    aggregate = verbs.add_parser("aggregate", help="trade stream to candles")
    aggregate.add_argument("--once", action="store_true")
    read = verbs.add_parser("read")
    read.add_argument("symbol")
    read.add_argument("tf")
    read.add_argument("--to", type=int)
    read.add_argument("--limit", type=int)
    repair = verbs.add_parser("repair", help="fetch missing minutes of one symbol, or of all again and again")
    repair.add_argument("symbol", nargs="?")
    repair.add_argument("--forever", action="store_true")
    backfill = verbs.add_parser("backfill")
    backfill.add_argument("symbol")
    backfill.add_argument("start", type=int)
    backfill.add_argument("end", type=int)
    for p in (repair, backfill):
        p.add_argument("--venue", choices=sorted(decoders.KLINES), default="binance")
        p.add_argument("--klines", required=True, help="the venue's replies as text, one a line")
    verbs.add_parser("compact", help="join small folders and delete what no version names")
    given = parser.parse_args(args)
    settings, now = Settings.from_env(), int(time.time() * 1000)
    spark = SparkSession.builder.config("spark.sql.session.timeZone", "UTC").config("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider").getOrCreate()
    store = Store(spark, settings.store)
    if given.verb == "ingest":
        events = getattr(decoders, given.venue)(spark.read.text(given.frames).withColumnRenamed("value", "raw"), settings.symbols)
        # frames on file don't say when they came in
        good = decoders.trades_of(events).withColumn("arrival", F.coalesce("arrival", F.lit(now).cast("bigint")))
        gated = gate(good, settings.symbols, now, settings.max_skew_ms)
        fresh = dedup.within_last(admitted(gated), settings.dedup_window, ("ts_ms", "trade_id"))
        channels.append_trades(channels.not_appended(fresh, settings.stream), settings.stream)
        store.apply(letters=decoders.rejections_of(events).withColumn("stage", F.lit("ingest")).unionByName(dead_letters(gated)))
    elif given.verb == "aggregate":
        events = channels.read_trades(spark, settings.stream, settings.batch_files)
        trades = decoders.trades_of(events).withColumn("arrival", F.coalesce("arrival", "ts_ms"))
        live.run(trades, store, settings.checkpoint, rejections=decoders.rejections_of(events), allowed_ms=settings.allowed_lateness_ms, grace_ms=settings.idle_grace_ms, live=not given.once).awaitTermination()
    elif given.verb == "read":
        rows = jobs.candles_range(store.candles(given.tf), given.symbol, given.tf, symbols=settings.symbols, end_ms=given.to or now, limit=given.limit)
        channels.frames(rows).select("frame").show(truncate=False)
    elif given.verb in ("repair", "backfill"):
        source = decoders.recorded_klines(spark.read.text(given.klines).withColumnRenamed("value", "raw"), given.venue)
        if given.verb == "backfill":
            changes = jobs.backfill_changes(store.candles(), store.watermarks(), source, given.symbol, given.start, given.end, now)
            if changes is not None:
                store.put_candles(changes)
        elif given.forever:
            jobs.repair_forever(store, source, settings.symbols, settings.repair_lookback_ms, settings.repair_every_s, report=lambda failed: print(failed) if failed else None)
        else:
            failed = jobs.repair_all(store, source, [given.symbol] if given.symbol else settings.symbols, settings.repair_lookback_ms, now)
            for symbol, e in failed.items():
                print(f"{symbol}: {e}")
            return 1 if failed else 0
    elif given.verb == "compact":
        for table in ("candles", "trades", "dead_letters"):
            store.compact(table)
        store.vacuum()
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
