"""Ranks over whole tables without sending the table through one task.

A table value is ranked through the histogram of its distinct values. Callers
that rank reported percentages round them to two decimals, which leaves at most
10,001 values for the only window without a partition key, however many groups
there are; the rest is an equality join on the value.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .numeric import rounded


def _value(column: str, digits: int | None) -> Column:
    return F.col(column) if digits is None else rounded(column, digits)


def value_ranks(df: DataFrame, column: str, digits: int | None = None) -> DataFrame:
    """(value, n, above, rank_min, rank_avg) of the distinct values (rounded if `digits` is given), highest first."""
    counts = (
        df.select(_value(column, digits).alias("value"))
        .filter(F.col("value").isNotNull())
        .groupBy("value")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    higher = Window.orderBy(F.desc("value")).rowsBetween(Window.unboundedPreceding, -1)
    above = F.coalesce(F.sum("n").over(higher), F.lit(0))
    return (
        counts.withColumn("above", above)
        .withColumn("rank_min", F.col("above") + 1)
        .withColumn("rank_avg", F.col("above") + (F.col("n") + 1) / F.lit(2.0))
    )


def with_rank(df: DataFrame, column: str, name: str, kind: str = "rank_min", digits: int | None = None) -> DataFrame:
    """Adds a competition ("rank_min"), average ("rank_avg") rank, or the count "above"; NULL stays unranked."""
    ranks = value_ranks(df, column, digits).select(
        F.col("value").alias(f"_{name}_value"), F.col(kind).alias(name)
    )
    matched = _value(column, digits) == F.col(f"_{name}_value")
    return df.join(ranks, matched, "left").drop(f"_{name}_value")
