"""Exact money arithmetic.

Floating-point sums depend on the order rows arrive in, which differs
between runs, partitionings and engines. Money is summed as whole
millionths in a 64-bit integer (exact, order-free, and a primitive codegen
path) and turned back into a double once at the end. Six decimals hold a
line's price times its discount rate without rounding; a sum beyond 9.2e12
raises an overflow error under ANSI mode.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

UNITS = 1_000_000


def to_units(amount: Column) -> Column:
    """Amount -> whole millionths as bigint."""
    return F.round(amount * F.lit(float(UNITS))).cast("bigint")


def from_units(units: Column) -> Column:
    """Millionths (bigint) -> amount as double."""
    return units.cast("double") / F.lit(float(UNITS))


def mean_from_units(units_sum: Column, count: Column) -> Column:
    """Average amount from a sum of millionths and a row count; null when
    the count is 0."""
    return F.try_divide(from_units(units_sum), count.cast("double"))
