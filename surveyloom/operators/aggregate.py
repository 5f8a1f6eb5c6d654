"""Weighted aggregation.

One pattern throughout: a narrow projection, one hash aggregate with map-side
combine on the group keys, then arithmetic on the aggregated rows. A hot group
costs nothing extra because it reaches the shuffle as one partial row per task.
"""

from __future__ import annotations

from collections.abc import Sequence
from itertools import chain

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.expressions import filter_column, outcome_column
from ..functions.flags import sample_flag, suppress
from ..functions.numeric import Columnish, _c, percent, ratio, total_over
from ..spec import Survey


def keys(columns) -> list[str]:
    return [columns] if isinstance(columns, str) else list(columns or [])


def label_lookup(code: Columnish, labels: dict[int, str]) -> Column:
    """Label of a code from a small fixed code list; a code that is not listed stands for itself."""
    own = _c(code).cast("string")
    if not labels:
        return own
    pairs = [(F.lit(k), F.lit(v)) for k, v in labels.items()]
    return F.coalesce(F.element_at(F.create_map(*chain.from_iterable(pairs)), _c(code).cast("int")), own)


def yes_no_sums(y: Columnish, weight: Columnish) -> list[Column]:
    """The sums behind every weighted percentage of a 0/1/NULL column."""
    y, w = _c(y), _c(weight)
    return [
        F.count(y).alias("n_valid"),
        F.coalesce(F.sum(y), F.lit(0)).alias("n_yes"),
        F.coalesce(F.sum(w * y), F.lit(0)).alias("weighted_yes"),
        F.coalesce(F.sum(F.when(y.isNotNull(), w)), F.lit(0)).alias("weighted_valid"),
    ]


def weighted_distribution(df: DataFrame, var: str, by=None, weight: str = "weight") -> DataFrame:
    """Weighted and unweighted % of each category of `var`, within `by` if given.

    NULL categories and NULL groups are left out of the denominator.
    """
    by = keys(by)
    cells = (
        df.dropna(subset=[*by, var])
        .groupBy(*by, var)
        .agg(F.count(F.lit(1)).alias("n"), F.sum(weight).alias("weighted_n"))
    )
    return cells.withColumn("pct", percent("weighted_n", total_over("weighted_n", by))).withColumn(
        "pct_unweighted", percent("n", total_over("n", by))
    )


def wide_distribution(df: DataFrame, var: str, by, labels: dict[int, str], weight: str = "weight") -> DataFrame:
    """One row per group, one `pct_<label>` column per listed code, and `n`: the fixed-list pivot of the above."""
    by = keys(by)
    valid = df.dropna(subset=[*by, var]).groupBy(*by).agg(
        F.count(F.lit(1)).alias("n"),
        F.sum(weight).alias("_all"),
        *[F.sum(F.when(F.col(var) == code, F.col(weight))).alias(f"_w{code}") for code in labels],
    )
    return valid.select(
        *by,
        "n",
        *[percent(f"_w{code}", "_all").alias(pct_name(label)) for code, label in labels.items()],
    )


def pct_name(label: str) -> str:
    return "pct_" + label.replace(" ", "_")


def weighted_rate(df: DataFrame, groups, value: str, weight: str = "weight") -> DataFrame:
    """Weighted % with `value` = 1 per group; rows with a NULL value or NULL group are dropped."""
    groups = keys(groups)
    valid = df.dropna(subset=[value, *groups])
    return valid.groupBy(*groups).agg(
        F.count(F.lit(1)).alias("n"),
        percent(F.sum(F.col(weight) * F.col(value)), F.sum(weight)).alias("pct"),
    )


def unweighted_rate(df: DataFrame, groups, value: str) -> DataFrame:
    groups = keys(groups)
    valid = df.dropna(subset=[value, *groups])
    return valid.groupBy(*groups).agg(
        F.count(F.lit(1)).alias("n"), percent(F.sum(value), F.count(F.lit(1))).alias("pct_unweighted")
    )


def weighted_mean(df: DataFrame, value: str, by=None, weight: str = "weight") -> DataFrame:
    by = keys(by)
    valid = df.dropna(subset=[value, *by])
    return valid.groupBy(*by).agg(
        F.count(F.lit(1)).alias("n"),
        ratio(F.sum(F.col(weight) * F.col(value)), F.sum(weight)).alias(f"mean_{value}"),
    )


def weighted_percentage(df: DataFrame, survey: Survey, outcome: dict, filters=None, group_by=None) -> DataFrame:
    """The metric query: weighted % with the outcome per group, with its counts and reliability.

    NULL groups are kept as their own row. Without grouping there is always one row.
    """
    groups = survey.columns(group_by)
    population = df.filter(filter_column(survey, filters))
    sums = population.groupBy(*groups).agg(
        *yes_no_sums(outcome_column(survey, outcome), survey.weight), F.count(F.lit(1)).alias("n_in_population")
    )
    return sums.select(
        *groups,
        "n_valid",
        F.col("n_yes").alias("n_yes_unweighted"),
        "n_in_population",
        ratio("weighted_yes", F.lit(survey.weight_scale)).alias("weighted_numerator"),
        ratio("weighted_valid", F.lit(survey.weight_scale)).alias("weighted_denominator"),
        suppress(percent("weighted_yes", "weighted_valid"), "n_valid").alias("weighted_pct"),
        sample_flag("n_valid").alias("reliability"),
    )


def count_respondents(df: DataFrame, survey: Survey, filters=None, group_by=None) -> DataFrame:
    """Respondents per group and their weighted share of everybody, whatever the filters.

    The total is a scalar subquery over the weight column alone, so the filtered
    scan keeps its push-down and no row passes through a single task.
    """
    groups = survey.columns(group_by)
    everyone = df.agg(F.sum(survey.weight)).scalar()
    counted = (
        df.filter(filter_column(survey, filters))
        .groupBy(*groups)
        .agg(F.count(F.lit(1)).alias("n_unweighted"), F.coalesce(F.sum(survey.weight), F.lit(0)).alias("_w"))
    )
    return counted.select(*groups, "n_unweighted", percent("_w", everyone).alias("weighted_pct_of_all"))


def joint_cells(df: DataFrame, dimensions: Sequence[str], measures: Sequence[Column]) -> DataFrame:
    """One scan: the joint cells of several coded dimensions.

    Tables over single dimensions are then re-aggregated from these cells
    instead of scanning (or expanding) the respondents once per dimension.
    """
    return df.groupBy(*dimensions).agg(*measures)


def frequency_table(df: DataFrame, variables: Sequence[str], weight: str = "weight") -> DataFrame:
    """Counts and percentages of every category of several coded variables, in one long table."""
    cells = joint_cells(df, variables, [F.count(F.lit(1)).alias("n"), F.sum(weight).alias("wn")])
    pairs = F.array(*[
        F.struct(F.lit(v).alias("variable"), F.col(v).cast("int").alias("code")) for v in variables
    ])
    long = (
        cells.select(F.explode(pairs).alias("p"), "n", "wn")
        .filter(F.col("p.code").isNotNull())
        .groupBy(F.col("p.variable").alias("variable"), F.col("p.code").alias("code"))
        .agg(F.sum("n").alias("n_unweighted"), F.sum("wn").alias("wn"))
    )
    return long.select(
        "variable",
        "code",
        "n_unweighted",
        percent("n_unweighted", total_over("n_unweighted", ["variable"])).alias("pct_unweighted"),
        percent("wn", total_over("wn", ["variable"])).alias("pct_weighted"),
    )


def education_by_group(
    df: DataFrame, group: str, level: str, labels: dict[int, str], years: str, weight: str = "weight"
) -> DataFrame:
    """Share of each level, answered count and weighted mean years per group, from one aggregate."""
    w = F.col(weight)
    valid_level = F.when(F.col(level).isNotNull(), w)
    sums = df.dropna(subset=[group]).groupBy(group).agg(
        F.count(level).alias("n"),
        F.sum(valid_level).alias("_all"),
        *[F.sum(F.when(F.col(level) == c, w)).alias(f"_w{c}") for c in labels],
        F.sum(w * F.col(years)).alias("_wy"),
        F.sum(F.when(F.col(years).isNotNull(), w)).alias("_wv"),
    )
    return sums.select(
        group,
        "n",
        *[percent(F.coalesce(F.col(f"_w{c}"), F.lit(0)), "_all").alias(pct_name(x)) for c, x in labels.items()],
        ratio("_wy", "_wv").alias("mean_years"),
    )


def coverage_table(df: DataFrame, group: str, answer: str, weight: str = "weight") -> DataFrame:
    """How many per group, how many answered, and the group's weighted share of both."""
    w, answered = F.col(weight), F.col(answer).isNotNull()
    sums = df.dropna(subset=[group]).groupBy(group).agg(
        F.count(F.lit(1)).alias("n"),
        F.count(answer).alias("n_answered"),
        F.sum(w).alias("_w"),
        F.coalesce(F.sum(F.when(answered, w)), F.lit(0)).alias("_wa"),
    )
    return sums.select(
        group,
        "n",
        "n_answered",
        percent("n_answered", "n").alias("pct_answered"),
        percent("_w", total_over("_w", [])).alias("pct_of_all_weighted"),
        percent("_wa", total_over("_wa", [])).alias("pct_of_answered_weighted"),
    )


def flagged_cells(df: DataFrame, groups, value: str, weight: str = "weight") -> DataFrame:
    """Weighted rate of every cell that occurs, NULL where suppressed, with its flag."""
    rate = weighted_rate(df, groups, value, weight)
    return rate.select(*keys(groups), "n", suppress("pct", "n").alias("pct"), sample_flag("n").alias("reliability"))


def code_list(df: DataFrame, name: str, labels: dict[int, str], label_name: str) -> DataFrame:
    """A fixed code list as a small table (`df` only supplies the session)."""
    return literal_rows(df, [(int(c), str(t)) for c, t in labels.items()], [name, label_name])


def literal_rows(df: DataFrame, rows, names: Sequence[str]) -> DataFrame:
    """A few constant rows as a plan literal: no Python worker, no upload."""
    entries = [F.struct(*[F.lit(value).alias(n) for n, value in zip(names, row)]) for row in rows]
    return df.sparkSession.range(1).select(F.inline(F.array(*entries)))


def group_sample_sizes(
    df: DataFrame, group: str, labels: dict[int, str], answer_columns: Sequence[str], age: str, weight: str = "weight"
) -> DataFrame:
    """Every listed group, also an empty one: size, answered, % answered, mean age of those who answered.

    `answered` means a value in every one of `answer_columns`.
    """
    answered = F.lit(True)
    for c in answer_columns:
        answered = answered & F.col(c).isNotNull()
    w = F.when(answered & F.col(age).isNotNull(), F.col(weight))
    sums = df.groupBy(group).agg(
        F.count(F.lit(1)).alias("_n"),
        F.count_if(answered).alias("_a"),
        F.sum(w * F.col(age)).alias("_wx"),
        F.sum(w).alias("_w"),
    )
    return code_list(df, group, labels, "group_label").join(sums, group, "left").select(
        group,
        "group_label",
        F.coalesce("_n", F.lit(0)).alias("n"),
        F.coalesce("_a", F.lit(0)).alias("n_answered"),
        percent("_a", "_n").alias("pct_answered"),
        ratio("_wx", "_w").alias("mean_age_answered"),
    )
