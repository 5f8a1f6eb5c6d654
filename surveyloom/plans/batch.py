"""The six batch analyses as one job graph over one cleaned table."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.flags import small_group_flag
from ..operators import aggregate as A
from ..operators import compare as K
from ..operators import quality as Q
from ..operators import standardize as T
from ..operators.clean import AGE_LABELS, age_label, analytic_sample, clean, with_age_group
from ..sources.tables import write_tables
from ..spec import Survey


@dataclass(frozen=True)
class Roles:
    """Which columns play which part in the analyses."""

    state: str = "v024"
    residence: str = "v025"
    wealth: str = "v190"
    level: str = "v106"
    years: str = "v133"
    value: str = "v714"
    age: str = "v012"
    recorded_age_group: str = "v013"
    age_group: str = "age_group"
    state_labels: dict[int, str] = field(default_factory=dict)
    residence_labels: dict[int, str] = field(default_factory=dict)
    wealth_labels: dict[int, str] = field(default_factory=dict)
    level_labels: dict[int, str] = field(default_factory=dict)

    @classmethod
    def of(cls, survey: Survey, **names) -> Roles:
        r = cls(**names)
        return cls(
            **names, state_labels=survey.labels(r.state), residence_labels=survey.labels(r.residence),
            wealth_labels=survey.labels(r.wealth), level_labels=survey.labels(r.level),
        )

    @property
    def columns(self) -> list[str]:
        return [self.state, self.residence, self.wealth, self.level, self.years, self.value, self.age, self.recorded_age_group]


def survey_tables(
    raw: DataFrame, survey: Survey, roles: Roles, small_n: int = 500,
    hold: Callable[[DataFrame], DataFrame] = lambda df: df,
) -> dict[str, DataFrame]:
    """Every result table of the six analyses, by `analysis/table`.

    `raw` holds the role columns and the weight; persist it or write it first
    when all tables are wanted, since each table reads it on its own. `hold`
    is applied to the small tables that others are derived from.
    """
    r, w = roles, survey.weight
    coded = [survey.variables[c] for c in dict.fromkeys([*r.columns]) if c in survey.variables]
    cleaned = with_age_group(clean(raw, coded), r.age, r.age_group)
    state = lambda df: df.withColumn("state_label", A.label_lookup(r.state, r.state_labels))
    level = lambda df: df.withColumn("level_label", A.label_lookup(r.level, r.level_labels))
    out: dict[str, DataFrame] = {}

    # 1. summary
    coded_four = [r.level, r.value, r.residence, r.wealth]
    freq = hold(A.frequency_table(cleaned, coded_four, w))
    state_edu = hold(state(A.education_by_group(cleaned, r.state, r.level, r.level_labels, r.years, w)))
    state_emp = hold(state(A.weighted_rate(cleaned, r.state, r.value, w)).withColumn(
        "sample_size_flag", small_group_flag("n", small_n)))
    top = A.pct_name(list(r.level_labels.values())[-1])
    out["analysis_1/01_missing_values"] = hold(Q.missingness(raw, [*coded, survey.variables[w]]))
    out["analysis_1/02_frequencies"] = freq
    out["analysis_1/03_national_education"] = freq.filter(F.col("variable") == r.level)
    out["analysis_1/04_national_employment"] = freq.filter(F.col("variable") == r.value)
    out["analysis_1/05_state_education"] = state_edu.orderBy(F.desc(top), r.state)
    out["analysis_1/06_state_employment"] = state_emp.orderBy(F.desc("pct"), r.state)
    out["analysis_1/07_employment_by_education"] = level(A.weighted_rate(cleaned, r.level, r.value, w))

    # 2. age
    aged = analytic_sample(cleaned, [r.value, r.level, r.age_group])
    cells = hold(level(A.flagged_cells(aged, [r.age_group, r.level], r.value, w)))
    out["analysis_2/01_age_checks"] = Q.age_checks(raw, r.age, r.recorded_age_group)
    out["analysis_2/02_age_distribution_and_coverage"] = A.coverage_table(cleaned, r.age_group, r.value, w)
    out["analysis_2/03_employment_by_age"] = A.weighted_rate(aged, r.age_group, r.value, w)
    out["analysis_2/04_employment_by_education_and_age"] = cells
    out["analysis_2/05_education_mix_by_age"] = A.wide_distribution(aged, r.level, r.age_group, r.level_labels, w)
    out["analysis_2/06_crude_vs_age_standardized"] = level(T.crude_vs_standardized(aged, r.level, r.value, age=r.age_group, weight=w))
    out["analysis_2/07_employment_by_education_and_age_wide"] = cells.groupBy(age_label(r.age_group).alias("age")).agg(*[
        F.max(F.when(F.col(r.level) == c, F.col("pct"))).alias(t) for c, t in r.level_labels.items()])

    # 3 and 4. residence and wealth
    for number, column, labels in ((3, r.residence, r.residence_labels), (4, r.wealth, r.wealth_labels)):
        for name, df in T.group_table_set(
            cleaned, column, labels, r.level, r.level_labels, r.value, r.age, r.age_group, w, hold=hold
        ).items():
            out[f"analysis_{number}/{name}"] = df

    # 5. states
    by_state = analytic_sample(aged, [r.state])
    ranking = hold(state(T.standardized_ranking(by_state, r.state, r.value, None, r.age_group, w, small_n)))
    gaps = hold(state(K.level_gap_by_group(by_state, r.state, r.level, r.value, age=r.age_group, weight=w)))
    joined = state_edu.select(r.state, top).join(ranking, r.state)
    correlations = hold(K.rank_correlations(joined, top, ["crude_pct", "standardized_pct"], "n", small_n))
    state_cells = hold(level(state(A.flagged_cells(by_state, [r.state, r.level], r.value, w))))
    out["analysis_5/01_higher_education_top_bottom"] = K.top_and_bottom(state_edu, top, r.state)
    out["analysis_5/02_employment_top_bottom"] = K.top_and_bottom(state_emp, "pct", r.state)
    out["analysis_5/03_state_employment_crude_vs_age_standardized"] = ranking
    out["analysis_5/04_state_employment_by_education"] = state_cells
    out["analysis_5/05_state_education_gap_vs_national"] = gaps
    out["analysis_5/06_state_level_correlations"] = correlations

    # 6. data quality
    dimensions = {
        r.residence: r.residence_labels, r.wealth: r.wealth_labels, r.state: r.state_labels, r.age_group: AGE_LABELS}
    flagged = {
        name: (out[name], [c for c in out[name].columns if "reliability" in c or c == "sample_size_flag"])
        for name in list(out) if any("reliability" in c or c == "sample_size_flag" for c in out[name].columns)
        and not name.startswith("analysis_1")
    }
    out["analysis_6/01_missingness"] = out["analysis_1/01_missing_values"]
    out["analysis_6/02_code_audit"] = Q.code_audit(raw, [*coded, survey.variables[w]])
    out["analysis_6/03_sample_sizes"] = Q.sample_sizes(cleaned, dimensions, r.value)
    out["analysis_6/04_small_cell_summary"] = Q.small_cell_summary(flagged)
    out["analysis_6/05_age_crosstab"] = Q.crosstab(cleaned, r.age_group, r.recorded_age_group, AGE_LABELS)
    out["analysis_6/06_weighted_vs_unweighted"] = Q.weighted_vs_unweighted(
        cleaned, r.level, list(r.level_labels), max(r.level_labels), r.state, r.value,
        [r.level, r.age_group, r.residence, r.wealth, r.state], w)
    out["analysis_6/07a_without_small_groups"] = Q.without_small_groups(
        cleaned, r.state, r.state_labels, r.level, r.value, small_n, w)
    out["analysis_6/07b_correlation_sensitivity"] = Q.correlation_sensitivity(correlations)
    out["analysis_6/07c_pattern_sensitivity"] = Q.pattern_sensitivity(gaps, "state_label")
    return out


def run_batch(raw: DataFrame, survey: Survey, roles: Roles, out: str, small_n: int = 500) -> dict[str, str]:
    """Computes and writes every table as a CSV report. Starts jobs.

    The role columns of the respondents (a few small integers of a very wide
    table) and the small tables that others derive from are persisted to memory
    and disk, recomputed where an executor is lost, and released at the end.
    """
    held: list[DataFrame] = []

    def hold(df: DataFrame) -> DataFrame:
        held.append(df.persist(StorageLevel.MEMORY_AND_DISK))
        return held[-1]

    try:
        narrow = hold(raw.select(survey.weight, *dict.fromkeys(roles.columns)))
        return write_tables(survey_tables(narrow, survey, roles, small_n, hold), out)
    finally:
        for df in held:
            df.unpersist()
