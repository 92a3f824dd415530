"""Merging snapshots: guarded upserts and the last of each key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from candlespark.schemas import CANDLE_KEY


def last_per_key(rows: DataFrame, order: Column | str, key: Sequence[str] = CANDLE_KEY) -> DataFrame:
    """The row of each key that comes last in ``order``."""
    rest = [c for c in rows.columns if c not in key]
    order = F.col(order) if isinstance(order, str) else order
    return rows.groupBy(*key).agg(F.max_by(F.struct(*rest), order).alias("_row")).select(*key, "_row.*")


def guarded_upsert(table: DataFrame, changes: DataFrame, order: str = "seq", key: Sequence[str] = CANDLE_KEY) -> DataFrame:
    """``table`` after ``changes`` in ``order``: an open snapshot never replaces a closed one.

    That fold is associative: of each key the greatest (closed, order) stays, so
    one aggregation does any number of batches. Rows of the table come before
    all changes.
    """
    old = table.withColumn("_at", F.struct("closed", F.lit(None).cast("bigint").alias("n")))
    new = changes.withColumn("_at", F.struct("closed", F.col(order).cast("bigint").alias("n"))).drop(order)
    return last_per_key(old.unionByName(new), "_at", key).select(*table.columns)


def overwrite(table: DataFrame, changes: DataFrame, key: Sequence[str] = CANDLE_KEY) -> DataFrame:
    """``table`` with the rows of ``changes`` in place of those of the same key: rollups ask no guard."""
    return table.join(changes.select(*key), list(key), "left_anti").select(*table.columns).unionByName(changes.select(*table.columns))
