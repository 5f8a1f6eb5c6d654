"""Exact-as-possible arithmetic for weighted sums.

Weights are summed as integers, so a sum never depends on partition order; one
division at the end turns it into a double.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

Columnish = Column | str


def _c(x: Columnish) -> Column:
    return F.col(x) if isinstance(x, str) else x


def ratio(numerator: Columnish, denominator: Columnish) -> Column:
    """numerator / denominator as a double; NULL for an empty denominator (also under ANSI mode)."""
    return F.try_divide(_c(numerator).cast("double"), _c(denominator).cast("double"))


def percent(numerator: Columnish, denominator: Columnish) -> Column:
    return F.try_divide(F.lit(100.0) * _c(numerator).cast("double"), _c(denominator).cast("double"))


def rounded(x: Columnish, digits: int = 2) -> Column:
    """Half-up rounding on the decimal value, for definitions that use rounded inputs."""
    return F.round(_c(x).cast("decimal(38,10)"), digits).cast("double")


def total_over(column: Columnish, keys) -> Column:
    """Sum of an already aggregated column within `keys` (all rows when `keys` is empty)."""
    from pyspark.sql import Window

    return F.sum(_c(column)).over(Window.partitionBy(*keys))
