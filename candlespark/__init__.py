"""Exact OHLCV candles from trades, live and historical, on Spark."""
