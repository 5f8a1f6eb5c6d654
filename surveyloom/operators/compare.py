"""Comparing groups: extremes, gaps against the whole, rank correlation."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.flags import suppress
from ..functions.numeric import Columnish, _c, percent, rounded
from ..functions.ranks import with_rank
from ..sources.tables import cut
from .aggregate import keys
from .standardize import _by_age, _share_struct, _smallest, _standardized

MIN_AGE_CELL_N = 10
GAP_DIFFERENCE = 10.0
MORE = "differs: secondary relatively MORE likely to work than nationally"
LESS = "differs: secondary relatively LESS likely to work than nationally"
SIMILAR = "similar to national"
REFERENCE = "reference"


def top_and_bottom(df: DataFrame, column: str, key: str, n: int = 5) -> DataFrame:
    """The n highest and n lowest rows with their place in the full order (ties by key, NULLs last).

    Each end is an ordered limit, so only n rows per task travel; the place of
    the lowest rows comes from the row count. The table is written once because
    all three read it. Starts a job.
    """
    df = cut(df, "extremes")
    rows = df.agg(F.count(F.lit(1))).scalar()
    down = [F.col(column).desc_nulls_last(), F.col(key).asc()]
    up = [F.col(column).asc_nulls_first(), F.col(key).desc()]
    top = df.orderBy(*down).limit(n).select(
        "*", F.lit("highest").alias("position"),
        F.row_number().over(Window.orderBy(*down)).cast("long").alias("rank_high_to_low"),
    )
    bottom = df.orderBy(*up).limit(n).select(
        "*", F.lit("lowest").alias("position"),
        (rows - F.row_number().over(Window.orderBy(*up)) + 1).cast("long").alias("rank_high_to_low"),
    )
    return top.unionByName(bottom)


def classify_gap(gap: Columnish, national: Columnish, smallest: Columnish, min_cell: int = MIN_AGE_CELL_N) -> Column:
    difference = _c(gap) - _c(national)
    return (
        F.when(
            (_c(smallest) < min_cell) | _c(gap).isNull(), f"not assessed (an age cell has n<{min_cell})"
        )
        .when(difference >= GAP_DIFFERENCE, MORE)
        .when(difference <= -GAP_DIFFERENCE, LESS)
        .otherwise(SIMILAR)
    )


def level_gap_by_group(
    df: DataFrame, group: str, level: str, value: str, shares: DataFrame | None = None, low: int = 0, high: int = 2,
    age: str = "age_group", weight: str = "weight", national_label: int = 0,
) -> DataFrame:
    """The high-minus-low gap of each group against the gap of everybody.

    One scan gives (group, level, age) cells; a grouping set over those cells
    adds the national row; both levels are laid side by side in one aggregate.
    `is_national` marks the reference row, whose group is `national_label`.
    """
    cells = (
        df.dropna(subset=[group, level, age, value])
        .groupBy(group, level, age)
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.sum(F.col(weight) * F.col(value)).alias("wy"),
            F.sum(weight).alias("w"),
        )
    )
    rolled = cells.groupingSets(
        [[F.col(group), F.col(level), F.col(age)], [F.col(level), F.col(age)]], group, level, age
    ).agg(
        F.grouping(group).alias("_national"), F.sum("n").alias("n"), F.sum("wy").alias("wy"), F.sum("w").alias("w")
    )
    sides = []
    for name, code in (("low", low), ("high", high)):
        here = F.col(level) == code
        sides += [F.sum(F.when(here, F.col(c))).alias(f"{name}_{c}") for c in ("n", "wy", "w")]
        sides += _by_age(f"{name}_", here, age)
    wide = rolled.groupBy(group, "_national").agg(*sides).withColumn("_s", _share_struct(shares, cells, age))

    n_low, n_high = (F.coalesce(F.col(f"{x}_n"), F.lit(0)) for x in ("low", "high"))
    crude = {
        x: rounded(suppress(percent(f"{x}_wy", f"{x}_w"), n)) for x, n in (("low", n_low), ("high", n_high))
    }
    std_low, std_high = _standardized("_s", "low_"), _standardized("_s", "high_")
    gaps = wide.select(
        F.when(F.col("_national") == 1, F.lit(national_label)).otherwise(F.col(group)).alias(group),
        (F.col("_national") == 1).alias("is_national"),
        n_low.alias("n_low"),
        n_high.alias("n_high"),
        crude["low"].alias("crude_pct_low"),
        crude["high"].alias("crude_pct_high"),
        rounded(crude["high"] - crude["low"]).alias("crude_gap"),
        std_low.alias("age_std_pct_low"),
        std_high.alias("age_std_pct_high"),
        rounded(std_high - std_low).alias("age_std_gap"),
        F.least(_smallest("low_"), _smallest("high_")).alias("smallest_age_cell_n"),
    )
    # exactly one national row: a scalar, not a join
    national = gaps.filter("is_national").agg(
        F.struct(F.max("crude_gap").alias("crude"), F.max("age_std_gap").alias("age_std"))
    ).scalar()
    return (
        gaps.withColumn("_nat", national)
        .withColumn("national_crude_gap", F.col("_nat.crude"))
        .withColumn("national_age_std_gap", F.col("_nat.age_std"))
        .withColumn("age_std_gap_minus_national", rounded(F.col("age_std_gap") - F.col("national_age_std_gap")))
        .withColumn(
            "pattern",
            F.when(F.col("is_national"), REFERENCE).otherwise(
                classify_gap("age_std_gap", "national_age_std_gap", "smallest_age_cell_n")
            ),
        )
        .drop("_nat")
    )


def spearman(df: DataFrame, a: str, b: str, by=None, digits: int | None = None) -> DataFrame:
    """(n, spearman): Pearson correlation of the average ranks of the reported values, pairwise non-NULL."""
    both = df.dropna(subset=[a, b])
    ranked = with_rank(with_rank(both, a, "_ra", "rank_avg", digits), b, "_rb", "rank_avg", digits)
    return ranked.groupBy(*keys(by)).agg(
        F.count(F.lit(1)).alias("n"), F.corr("_ra", "_rb").alias("spearman")
    )


def rank_correlations(
    table: DataFrame, base: str, measures: list[str], n_column: str, small_n: int = 500, digits: int = 2
) -> DataFrame:
    """Two subsets (all groups, without small groups) x several measures, each ranked within its own subset.

    Every part reads the table again, so it is written once. Starts a job.
    """
    table = cut(table.select(base, n_column, *measures), "correlated")
    rows = None
    for subset, name in ((table, "all groups"), (table.filter(F.col(n_column) >= small_n),
                                                 f"excluding small samples (n<{small_n})")):
        for m in measures:
            part = spearman(subset, base, m, digits=digits).select(
                F.lit(name).alias("groups_included"), F.lit(m).alias("measure"), F.col("n").alias("n_groups"), "spearman"
            )
            rows = part if rows is None else rows.unionByName(part)
    return rows
