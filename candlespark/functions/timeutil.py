"""Epoch milliseconds, buckets and times as clients write them."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from candlespark.schemas import TIMEFRAMES

#: Minutes that a symbol without a checkpoint is given to settle.
SETTLE_MS = 120_000
MAX_LIMIT, DEFAULT_LIMIT = 5000, 1000

_ISO = r"\A[0-9]{4}-[0-9]{2}-[0-9]{2}([T ][0-9]{2}:[0-9]{2}(:[0-9]{2}(\.[0-9]{1,6})?)?(Z|[+-][0-9]{2}:?[0-9]{2})?)?\z"


def to_ms(ts: Column) -> Column:
    """Epoch milliseconds, rounded down, before 1970 too."""
    return F.unix_millis(ts)


def from_ms(ms: Column) -> Column:
    return F.timestamp_millis(ms)


def floor_ms(ms: Column, width: Column | int) -> Column:
    """The start of the bucket; the remainder is never negative."""
    width = F.lit(width).cast("bigint") if isinstance(width, int) else width
    return ms - F.pmod(ms, width)


def width_of(tf: Column) -> Column:
    """A timeframe's width in ms; null for what isn't one."""
    table = F.create_map(*[F.lit(x) for name, width in TIMEFRAMES.items() for x in (name, width)])
    return F.try_element_at(table, tf).cast("bigint")


def time_bucket(tf: str, ts: Column) -> Column:
    return from_ms(floor_ms(to_ms(ts), TIMEFRAMES[tf]))


def parse_time(text: Column) -> Column:
    """Epoch ms of digits or of an ISO time, which is UTC unless it says otherwise; else null."""
    digits = F.when(text.rlike(r"\A-?[0-9]+\z"), text.try_cast("bigint"))
    # what timestamps can hold, years 1 to 9999
    digits = F.when(digits.between(-62_135_596_800_000, 253_402_300_799_999), digits)
    return F.coalesce(digits, F.when(text.rlike(_ISO), F.unix_millis(text.try_cast("timestamp"))))


def has_offset(text: Column) -> Column:
    """Whether an ISO time names its offset; feeds must, clients need not."""
    return text.rlike(_ISO) & text.rlike(r"[Tt ].*(Z|[+-][0-9]{2}:?[0-9]{2})\z")


def settled_before(watermark: Column, now_ms: Column) -> Column:
    """Up to where history may be repaired: the watermark's minute, or two minutes ago."""
    return floor_ms(F.coalesce(watermark, now_ms - SETTLE_MS), 60_000)


def default_from(to_ms_: int, tf: str, limit: int) -> int:
    """Where a range begins that should hold the latest ``limit`` buckets."""
    return to_ms_ - limit * TIMEFRAMES[tf]


def checked_limit(limit: int | None) -> int:
    limit = DEFAULT_LIMIT if limit is None else limit
    if not 1 <= limit <= MAX_LIMIT:
        raise ValueError(f"a limit lies between 1 and {MAX_LIMIT}")
    return limit
