"""Exact numbers: scaled integers, notionals, fixed-point text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from candlespark.schemas import NUMBER


def fixed(number: Column) -> Column:
    """Fixed-point text, never scientific: what goes over the wire."""
    return number.cast("string")


def scaled(number: Column, scale: int) -> Column:
    """``number`` with its point moved ``scale`` places to the left, exact to eight places."""
    return (number.cast("decimal(28,8)") * F.lit(f"1E-{scale}").cast(f"decimal({max(scale, 1) + 1},{max(scale, 1)})")).try_cast(NUMBER) if scale else number.try_cast(NUMBER)


def notional(price: Column, qty: Column) -> Column:
    """price * qty, exact: eight places each give sixteen."""
    return price.cast(NUMBER) * qty.cast(NUMBER)


def exact(text: Column) -> Column:
    """A number from its text; null where it has more than eight places or ten digits before them."""
    return F.when(text.rlike(r"\A-?[0-9]{1,10}(\.[0-9]{1,8}0*)?\z"), text.try_cast(NUMBER))


def _halves(x: Column) -> tuple[Column, Column]:
    """A double as the sum of two of half its digits (Veltkamp)."""
    big = x * F.lit(134_217_729.0)
    high = big - (big - x)
    return high, x - high


def fused(a: Column, b: Column, c: Column) -> Column:
    """a * b + c of doubles without rounding the product first: its error (Dekker) and the sum's (Knuth) are added back."""
    product = a * b
    (a1, a2), (b1, b2) = _halves(a), _halves(b)
    lost = ((a1 * b1 - product) + a1 * b2 + a2 * b1) + a2 * b2
    total = product + c
    part = total - product
    return total + (((product - (total - part)) + (c - part)) + lost)
