"""Deduplication by (source, trade_id), which identifies a trade."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

KEY = ["source", "trade_id"]


def keep_first(trades: DataFrame, key: Sequence[str] = KEY, order: Sequence[Column | str] = ("arrival",)) -> DataFrame:
    """The first row of each key in ``order``."""
    nth = F.row_number().over(Window.partitionBy(*key).orderBy(*order))
    return trades.withColumn("_nth", nth).filter("_nth = 1").drop("_nth")


def not_in_log(trades: DataFrame, log: DataFrame, key: Sequence[str] = KEY) -> DataFrame:
    """Trades that the log doesn't hold, each once: what an insert-if-absent would add."""
    return keep_first(trades.join(log.select(*key), list(key), "left_anti"), key)


def within_last(trades: DataFrame, admitted: int, order: Sequence[str] = ("arrival",)) -> DataFrame:
    """The trades that a window of the last ``admitted`` admitted keys lets pass.

    A key that passes takes the next number; its copies are held back until
    ``admitted`` numbers have been given since. So whether a copy passes depends
    on all that passed before it: a recursion over the whole input, which runs in
    one task by its nature. Use it on the overlap after a reconnect; keep_first
    and the trade log are the durable guarantee.
    """
    import numpy as np
    import pandas as pd

    columns = trades.columns

    def run(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values(list(order), kind="stable")
        keys = frame.groupby(KEY, sort=False, dropna=False).ngroup().to_numpy()
        taken = np.full(len(keys), -1 - admitted, dtype=np.int64)  # each key's last number
        passed, number = np.zeros(len(keys), dtype=bool), 0
        for place, key in enumerate(keys.tolist()):
            if number - taken[key] > admitted:
                passed[place], taken[key], number = True, number, number + 1
        return frame[passed][columns]

    return trades.groupBy().applyInPandas(run, trades.schema)
