"""Reliability labels for small samples."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .numeric import Columnish, _c

# Thresholds and label texts that results must carry unchanged.
SUPPRESS_BELOW = 25
FLAG_BELOW = 50
SMALL_GROUP_N = 500
SUPPRESSED = "suppressed (n<25)"
UNRELIABLE = "unreliable (n 25-49)"
OK = "ok"
STANDARDIZED_EMPTY = "not computed (an age group has no cases)"
STANDARDIZED_CAUTION_25 = "caution (an age cell has n<25)"
STANDARDIZED_CAUTION_50 = "caution (an age cell has n 25-49)"
NO_AGE_CASES = "no cases in an age group"


def sample_flag(n: Columnish) -> Column:
    n = _c(n)
    return F.when(n < SUPPRESS_BELOW, SUPPRESSED).when(n < FLAG_BELOW, UNRELIABLE).otherwise(OK)


def standardized_flag(smallest: Columnish) -> Column:
    s = _c(smallest)
    return (
        F.when(s == 0, STANDARDIZED_EMPTY)
        .when(s < SUPPRESS_BELOW, STANDARDIZED_CAUTION_25)
        .when(s < FLAG_BELOW, STANDARDIZED_CAUTION_50)
        .otherwise(OK)
    )


def age_cell_flag(smallest: Columnish) -> Column:
    """Like `sample_flag`, but an empty age cell has its own label."""
    return F.when(_c(smallest) == 0, NO_AGE_CASES).otherwise(sample_flag(smallest))


def small_group_flag(n: Columnish, below: int = SMALL_GROUP_N) -> Column:
    return F.when(_c(n) < below, f"small sample (n<{below})").otherwise(OK)


def suppress(value: Columnish, n: Columnish) -> Column:
    """`value`, or NULL where it rests on fewer than 25 cases."""
    return F.when(_c(n) >= SUPPRESS_BELOW, _c(value))
