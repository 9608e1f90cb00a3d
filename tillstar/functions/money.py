"""Money arithmetic.

The source system keeps prices and totals in DOUBLE and multiplies and sums doubles, so its results depend on binary noise
and on the order rows arrive in. Here a price counts as the number it is written as (the shortest decimal form of
the double: 0.30000000000000004 is just that), products are exact decimals, and only the stored column is
DOUBLE. Sums read the stored doubles back as decimals, so they do not depend on order or partitioning.

A line with amount and price below ten million keeps 17 decimals of the price; larger ones keep ten, which is beyond
what a double of that size holds. Nothing is rejected for having many decimals.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Decimal shapes: (amount, price) of ordinary and of large lines, share kept after the discount, one stored line.
ORDINARY = ("decimal(7,0)", "decimal(24,17)")
LARGE = ("decimal(12,0)", "decimal(24,10)")
BELOW = 10_000_000
PCT = "decimal(11,8)"
KEEP = "decimal(11,10)"
LINE = "decimal(30,16)"


def _line(amount: Column, price: Column, value) -> Column:
    """``value`` of the two as decimals, as DOUBLE: in the ordinary shapes where they fit."""
    small = (F.abs(amount) < BELOW) & (F.abs(price) < BELOW)
    narrow, wide = ([amount.cast(a), price.cast(p)] for a, p in (ORDINARY, LARGE))
    return F.when(small, value(*narrow).cast("double")).when(amount.isNotNull() & price.isNotNull(), value(*wide).cast("double"))


def line_total(amount: Column, price: Column) -> Column:
    """amount * price, exact, stored as DOUBLE."""
    return _line(amount, price, lambda a, p: a * p)


def discounted(amount: Column, price: Column, discount_pct: Column) -> Column:
    """total - total * coalesce(discount, 0) / 100, exact, stored as DOUBLE (F6 + F7)."""
    left = F.lit(100).cast(PCT) - F.coalesce(discount_pct.cast(PCT), F.lit(0).cast(PCT))
    keep = (left.cast(PCT) * F.lit(0.01).cast("decimal(2,2)")).cast(KEEP)
    return _line(amount, price, lambda a, p: a * p * keep)


def money_sum_dec(col: Column | str) -> Column:
    """Exact SUM of a stored money DOUBLE: each value is read back as ``decimal(30,16)`` first."""
    c = F.col(col) if isinstance(col, str) else col
    return F.sum(c.cast(LINE))


def money_sum(col: Column | str) -> Column:
    """``money_sum_dec`` as the stored DOUBLE."""
    return money_sum_dec(col).cast("double")


def repeated(dec: Column, rows: Column) -> Column:
    """An exact sum times a row count, as DOUBLE. One row, the usual case, keeps all decimals of the sum; the product of
    decimals would keep fewer."""
    return F.when(rows == 1, dec.cast("double")).otherwise((dec * rows).cast("double"))


def money_text(col: Column | str) -> Column:
    """A stored amount as the TEXT that the marts declare (P3): two decimals, never in scientific notation."""
    c = F.col(col) if isinstance(col, str) else col
    return c.cast("decimal(18,2)").cast("string")
