"""Direct age standardization.

Respondents are read once, into (group, age) cells. Everything after that works
on at most groups x ages rows.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.expressions import filter_column, outcome_column
from ..functions.flags import age_cell_flag, sample_flag, small_group_flag, standardized_flag, suppress
from ..functions.numeric import percent, ratio, rounded, total_over
from ..functions.ranks import with_rank
from ..sources.tables import cut
from ..spec import Survey
from .aggregate import (code_list, group_sample_sizes, keys, literal_rows, pct_name, wide_distribution,
                        yes_no_sums)
from .clean import AGE_CODES


def standard_age_shares(df: DataFrame, age: str = "age_group", weight: str = "weight") -> DataFrame:
    """The standard population: (age, share), shares summing to 1 over the rows given."""
    weights = df.dropna(subset=[age]).groupBy(age).agg(F.sum(weight).alias("_w"))
    return weights.select(age, ratio("_w", total_over("_w", [])).alias("share"))


def age_cells(df: DataFrame, groups, value: str, age: str = "age_group", weight: str = "weight") -> DataFrame:
    groups = keys(groups)
    return (
        df.dropna(subset=[*groups, age, value])
        .groupBy(*groups, age)
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.sum(F.col(weight) * F.col(value)).alias("wy"),
            F.sum(weight).alias("w"),
        )
    )


def _share_struct(shares: DataFrame | None, cells: DataFrame, age: str) -> Column:
    """The seven shares as one scalar subquery, fields s1..s7.

    Without given shares the standard is the age mix of the cells themselves.
    Its subquery keeps every sum of the cells, so that it is the same exchange
    as the main query's and Spark reuses it: one scan for both.
    """
    if shares is not None:
        row = shares.agg(
            F.struct(*[F.max(F.when(F.col(age) == a, F.col("share"))).alias(f"s{a}") for a in AGE_CODES])
        )
        return row.scalar()
    total = F.sum("w")
    row = cells.groupBy(age).agg(F.sum("n").alias("n"), F.sum("wy").alias("wy"), F.sum("w").alias("w")).agg(
        F.struct(
            *[ratio(F.max(F.when(F.col(age) == a, F.col("w"))), total).alias(f"s{a}") for a in AGE_CODES],
            F.sum("n").alias("n"), F.sum("wy").alias("wy"),
        )
    )
    return row.scalar()


def _by_age(prefix: str = "", condition: Column | None = None, age: str = "age_group") -> list[Column]:
    """Conditional sums that lay a group's seven age cells side by side."""
    out = []
    for a in AGE_CODES:
        here = F.col(age) == a if condition is None else (F.col(age) == a) & condition
        for c in ("n", "wy", "w"):
            out.append(F.sum(F.when(here, F.col(c))).alias(f"{prefix}{c}{a}"))
    return out


def _standardized(shares: str, prefix: str = "") -> Column:
    """s1*rate1 + ... + s7*rate7, written out so the order of addition is fixed; NULL if an age is missing."""
    terms = [F.col(f"{shares}.s{a}") * percent(f"{prefix}wy{a}", f"{prefix}w{a}") for a in AGE_CODES]
    return reduce(lambda x, y: x + y, terms)


def _smallest(prefix: str = "") -> Column:
    return F.least(*[F.coalesce(F.col(f"{prefix}n{a}"), F.lit(0)) for a in AGE_CODES])


def standardized_rates(
    df: DataFrame, groups, value: str, shares: DataFrame | None = None, age: str = "age_group", weight: str = "weight"
) -> DataFrame:
    """Crude and standardized rate per group, unsuppressed, with n and the smallest age cell.

    `standardized_pct` is NULL when one of the seven ages has no case in the
    group. Without `shares`, the respondents given are the standard population.
    """
    groups = keys(groups)
    cells = age_cells(df, groups, value, age, weight)
    wide = (
        cells.groupBy(*groups)
        .agg(
            F.sum("n").alias("n"), F.sum("wy").alias("_wy"), F.sum("w").alias("_w"), *_by_age(age=age)
        )
        .withColumn("_s", _share_struct(shares, cells, age))
    )
    return wide.select(
        *groups,
        "n",
        percent("_wy", "_w").alias("crude_pct"),
        _standardized("_s").alias("standardized_pct"),
        _smallest().alias("smallest_age_cell_n"),
        standardized_flag(_smallest()).alias("standardized_reliability"),
    )


def crude_vs_standardized(
    df: DataFrame, level: str, value: str, shares: DataFrame | None = None, age: str = "age_group", weight: str = "weight"
) -> DataFrame:
    """Both rates per level and the difference of the two as reported (rounded)."""
    rates = standardized_rates(df, level, value, shares, age, weight)
    return rates.withColumn(
        "difference_std_minus_crude", rounded(rounded("standardized_pct") - rounded("crude_pct"))
    )


def age_standardized_metric(
    df: DataFrame, survey: Survey, outcome: dict, group_by, filters=None
) -> DataFrame:
    """Crude and standardized metric for any outcome, grouping and filters.

    The standard is the age mix of the filtered population with a valid
    outcome, over the ages that occur there (NULL age included). Both the
    groups and the standard are rolled up from the same cells.
    """
    groups, age = survey.columns(group_by), survey.age_group
    cells = (
        df.filter(filter_column(survey, filters))
        .groupBy(*groups, age)
        .agg(*yes_no_sums(outcome_column(survey, outcome), survey.weight))
        .select(*groups, F.col(age).alias("_age"), F.struct("n_valid", "weighted_yes", "weighted_valid").alias("c"))
    )
    # one bounded array (one entry per age) as a scalar subquery over the cells
    standard = (
        cells.groupBy("_age")
        .agg(F.sum("c.weighted_valid").alias("wv"), F.sum("c.n_valid").alias("n"), F.sum("c.weighted_yes").alias("wy"))
        .agg(F.array_sort(F.collect_list(F.struct("_age", "wv", "n", "wy"))))
        .scalar()
    )
    per_group = (
        cells.groupBy(*groups)
        .agg(
            F.sum("c.n_valid").alias("n_valid"),
            F.sum("c.weighted_yes").alias("_wy"),
            F.sum("c.weighted_valid").alias("_wv"),
            F.collect_list(F.struct(F.col("_age").alias("age"), F.col("c").alias("c"))).alias("_cells"),
        )
        .withColumn("_std", standard)
    )
    total = F.aggregate("_std", F.lit(0.0), lambda acc, a: acc + a["wv"].cast("double"))

    def cell(a):
        return F.get(F.filter("_cells", lambda x: x["age"].eqNullSafe(a["_age"])), F.lit(0))["c"]

    smallest = F.array_min(F.transform("_std", lambda a: F.coalesce(cell(a)["n_valid"], F.lit(0))))
    weighted = F.aggregate(
        "_std",
        F.lit(0.0),
        lambda acc, a: acc
        + F.try_divide(a["wv"].cast("double"), F.col("_total"))
        * F.try_divide(cell(a)["weighted_yes"].cast("double"), cell(a)["weighted_valid"].cast("double")),
    )
    rated = per_group.withColumn("_total", total).select(
        *groups,
        "n_valid",
        suppress(percent("_wy", "_wv"), "n_valid").alias("crude_pct"),
        (F.lit(100.0) * weighted).alias("_std_pct"),
        smallest.alias("smallest_age_cell_n"),
    )
    return rated.select(
        *groups,
        "n_valid",
        "crude_pct",
        F.when(F.col("crude_pct").isNotNull() & (F.col("smallest_age_cell_n") > 0), F.col("_std_pct")).alias(
            "age_standardized_pct"
        ),
        "smallest_age_cell_n",
        age_cell_flag("smallest_age_cell_n").alias("age_cell_reliability"),
    )


def standardized_ranking(
    df: DataFrame,
    group: str,
    value: str,
    shares: DataFrame | None = None,
    age: str = "age_group",
    weight: str = "weight",
    small_n: int = 500,
) -> DataFrame:
    """Crude and standardized rate per group with the competition rank of each reported rate.

    The rates (one row per group) are written once because the ranks read them
    again; that is cheaper than another scan of the respondents. Starts a job.
    """
    rates = standardized_rates(df, group, value, shares, age, weight).withColumn(
        "sample_size_flag", small_group_flag("n", small_n)
    )
    rates = cut(rates, "rates")
    return with_rank(with_rank(rates, "crude_pct", "rank_crude", digits=2), "standardized_pct", "rank_standardized", digits=2)


# ---- the table set for one grouping variable --------------------------------
def level_cells(
    df: DataFrame, group: str, group_labels: dict[int, str], level: str, level_labels: dict[int, str], value: str,
    shares: DataFrame | None = None, age: str = "age_group", weight: str = "weight",
) -> DataFrame:
    """Every listed (group, level) cell, also the empty ones, with both rates and both flags."""
    grid = literal_rows(
        df,
        [(int(g), str(gt), int(x), str(xt)) for g, gt in group_labels.items() for x, xt in level_labels.items()],
        [group, "group_label", level, "level_label"],
    )
    rates = standardized_rates(df, [group, level], value, shares, age, weight)
    n = F.coalesce("n", F.lit(0))
    smallest = F.coalesce("smallest_age_cell_n", F.lit(0))
    return grid.join(rates, [group, level], "left").select(
        group, "group_label", level, "level_label",
        n.alias("n"),
        suppress("crude_pct", n).alias("crude_pct"),
        sample_flag(n).alias("crude_reliability"),
        "standardized_pct",
        smallest.alias("smallest_age_cell_n"),
        standardized_flag(smallest).alias("standardized_reliability"),
    )


def rate_grid(cells: DataFrame, level: str, column: str, group_labels: dict[int, str], group: str) -> DataFrame:
    """Rows = level, one column per listed group; absent cells are NULL."""
    return cells.groupBy(level, "level_label").agg(*[
        F.max(F.when(F.col(group) == code, F.col(column))).alias(label) for code, label in group_labels.items()
    ])


def level_gaps(cells: DataFrame, group: str, level: str) -> DataFrame:
    """Gaps between levels 2 and 0, and 3 and 2, from the rates as reported; NULL if either is NULL."""
    def at(column, code):
        return F.max(F.when(F.col(level) == code, rounded(column)))

    sums = cells.groupBy(group, "group_label").agg(*[
        at(column, code).alias(f"_{kind}{code}")
        for kind, column in (("crude", "crude_pct"), ("age_std", "standardized_pct"))
        for code in (0, 2, 3)
    ])
    return sums.select(group, "group_label", *[
        rounded(F.col(f"_{kind}{a}") - F.col(f"_{kind}{b}")).alias(f"{kind}_gap_{name}")
        for kind in ("crude", "age_std")
        for a, b, name in ((2, 0, "secondary_minus_no_education"), (3, 2, "higher_minus_secondary"))
    ])


def group_table_set(
    df: DataFrame, group: str, group_labels: dict[int, str], level: str, level_labels: dict[int, str], value: str,
    age: str = "age", age_group: str = "age_group", weight: str = "weight", shares: DataFrame | None = None,
    hold: Callable[[DataFrame], DataFrame] = lambda df: df,
) -> dict[str, DataFrame]:
    """The seven report tables that describe `value` by level within one grouping variable.

    `hold` is applied to the small tables that several of the seven read
    (for example `DataFrame.persist`).
    """
    required = [value, level, age_group, group]
    analytic = df.dropna(subset=required)
    cells = hold(level_cells(analytic, group, group_labels, level, level_labels, value, shares, age_group, weight))
    by_group = standardized_rates(analytic, group, value, shares, age_group, weight)
    return {
        "01_sample_sizes": group_sample_sizes(df, group, group_labels, [value, level, age_group], age, weight),
        "02_education_distribution": wide_distribution(df, level, group, level_labels, weight),
        "03_employment_by_group": hold(code_list(df, group, group_labels, "group_label").join(by_group, group, "left")),
        "04_employment_by_education_and_group": cells,
        "05_crude_grid": rate_grid(cells, level, "crude_pct", group_labels, group),
        "06_age_standardized_grid": rate_grid(cells, level, "standardized_pct", group_labels, group),
        "07_education_gaps": level_gaps(cells, group, level),
    }
