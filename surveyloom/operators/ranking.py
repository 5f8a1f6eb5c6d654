"""Deprivation ranking, channel reach and population profiles.

However many indicators are involved, respondents are scanned once: every
indicator contributes three conditional sums to the same aggregate.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.expressions import filter_column
from ..functions.flags import sample_flag, suppress
from ..functions.numeric import percent, rounded
from ..functions.ranks import with_rank
from ..sources.tables import cut
from ..spec import Survey
from .aggregate import keys

MIN_GROUP_N = 200
ELEVATED_BY = 5.0
REACH_THRESHOLD = 25.0


def indicator_sums(names: Sequence[str], weight: str, condition: Column | None = None, suffix: str = "") -> list[Column]:
    """n, weighted yes and weighted valid of each 0/1/NULL indicator, optionally among rows meeting a condition."""
    out = []
    for i in names:
        y = F.col(i) if condition is None else F.when(condition, F.col(i))
        w = F.col(weight)
        out += [
            F.count(y).alias(f"n_{i}{suffix}"),
            F.sum(w * y).alias(f"wy_{i}{suffix}"),
            F.sum(F.when(y.isNotNull(), w)).alias(f"wv_{i}{suffix}"),
        ]
    return out


def reported_pct(i: str, suffix: str = "") -> Column:
    """The percentage as reported: suppressed below 25 cases, two decimals."""
    return rounded(suppress(percent(f"wy_{i}{suffix}", f"wv_{i}{suffix}"), f"n_{i}{suffix}"))


def mean_of(columns: Sequence[Column]) -> Column:
    return rounded(reduce(lambda a, b: a + b, columns) / F.lit(float(len(columns))))


def indicator_cells(df: DataFrame, survey: Survey, group_by, indicators, filters=None) -> DataFrame:
    """One scan: population size and the sums of every indicator, per group."""
    groups = survey.columns(group_by)
    return df.filter(filter_column(survey, filters)).groupBy(*groups).agg(
        F.count(F.lit(1)).alias("n_in_population"), *indicator_sums(indicators, survey.weight)
    )


def deprivation_scores(
    df: DataFrame, survey: Survey, group_by, indicators=None, filters=None, min_n: int = MIN_GROUP_N
) -> DataFrame:
    """Score of every group: the mean of its reported percentages; NULL unless all are available."""
    groups, names = survey.columns(group_by), survey.deprivations(indicators)
    cells = indicator_cells(df, survey, groups, names, filters).select(
        *groups, "n_in_population", *[reported_pct(i).alias(f"pct_{i}") for i in names], *[f"n_{i}" for i in names]
    )
    score = mean_of([F.col(f"pct_{i}") for i in names])
    return cells.withColumn("deprivation_score", score).withColumn(
        "ranked", F.col("deprivation_score").isNotNull() & (F.col("n_in_population") >= min_n)
    )


def _ranked(scored: DataFrame, groups: Sequence[str], top_k: int | None) -> DataFrame:
    order = [F.desc("deprivation_score"), *groups]
    if top_k is not None:
        best = scored.orderBy(*order).limit(top_k)
        return best.withColumn("rank", F.row_number().over(Window.orderBy(*order)))
    above = with_rank(scored, "deprivation_score", "_above", "above", digits=2)
    within = F.row_number().over(Window.partitionBy("deprivation_score").orderBy(*groups))
    return above.withColumn("rank", (F.col("_above") + within).cast("int")).drop("_above")


def rank_underserved(
    df: DataFrame, survey: Survey, group_by, indicators=None, filters=None, min_n: int = MIN_GROUP_N,
    top_k: int | None = 10,
) -> DataFrame:
    """The ranked groups, highest score first, ties in group order; `top_k=None` ranks every group."""
    groups = survey.columns(group_by)
    scored = deprivation_scores(df, survey, groups, indicators, filters, min_n).filter("ranked").drop("ranked")
    return _ranked(scored, groups, top_k)


def ranking_summary(
    df: DataFrame, survey: Survey, group_by, indicators=None, filters=None, min_n: int = MIN_GROUP_N
) -> DataFrame:
    """One row: groups ranked, groups in all, and the score of the whole filtered population."""
    groups, names = survey.columns(group_by), survey.deprivations(indicators)
    cells = indicator_cells(df, survey, groups, names, filters)
    complete = reduce(lambda a, b: a & b, [F.col(f"n_{i}") >= 25 for i in names])
    sums = cells.agg(
        F.count_if(complete & (F.col("n_in_population") >= min_n)).alias("n_groups_ranked"),
        F.count(F.lit(1)).alias("n_groups"),
        *[F.sum(f"{p}_{i}").alias(f"{p}_{i}") for i in names for p in ("n", "wy", "wv")],
    )
    return sums.select(
        "n_groups_ranked", "n_groups",
        *[reported_pct(i).alias(f"national_{i}") for i in names],
        mean_of([reported_pct(i) for i in names]).alias("national_score"),
    )


def ranking_sensitivity(
    df: DataFrame, survey: Survey, group_by, alternative, indicators=None, filters=None, min_n: int = MIN_GROUP_N
) -> DataFrame:
    """Where the top-ranked group stands when the alternative indicators are used instead.

    Both rankings come from one table of group percentages, written once. Starts a job.
    """
    groups = survey.columns(group_by)
    first, second = survey.deprivations(indicators), survey.deprivations(alternative)
    every = list(dict.fromkeys([*first, *second]))
    pcts = cut(
        indicator_cells(df, survey, groups, every, filters)
        .filter(F.col("n_in_population") >= min_n)
        .select(*groups, *[reported_pct(i).alias(f"pct_{i}") for i in every]),
        "percentages",
    )

    def scored(names):
        score = mean_of([F.col(f"pct_{i}") for i in names])
        return pcts.select(*groups, score.alias("deprivation_score")).dropna(subset=["deprivation_score"])

    best = _ranked(scored(first), groups, 1).select(
        *[F.col(g).alias(f"_b_{g}") for g in groups], F.col("deprivation_score").alias("score")
    )
    other = _ranked(scored(second), groups, None)
    same = reduce(lambda a, b: a & b, [F.col(g).eqNullSafe(F.col(f"_b_{g}")) for g in groups])
    return other.join(F.broadcast(best), same).select(
        *groups, "score", F.col("deprivation_score").alias("alternative_score"), F.col("rank").alias("alternative_rank")
    )


def _long(wide: DataFrame, keep: Sequence[str], entries: Sequence[Column]) -> DataFrame:
    return wide.select(*keep, F.inline(F.array(*entries)))


def channel_reach(df: DataFrame, survey: Survey, filters=None, indicators=None) -> DataFrame:
    """Weighted % reached by each channel indicator, highest first (NULL last)."""
    names = list(indicators or survey.channels())
    wide = df.filter(filter_column(survey, filters)).agg(*indicator_sums(names, survey.weight))
    entries = [
        F.struct(
            F.lit(i).alias("indicator"),
            F.lit(survey.indicators[i].description).alias("description"),
            suppress(percent(f"wy_{i}", f"wv_{i}"), f"n_{i}").alias("weighted_pct"),
            F.col(f"n_{i}").alias("n_valid"),
            sample_flag(f"n_{i}").alias("reliability"),
        )
        for i in names
    ]
    return _long(wide, [], entries).orderBy(F.col("weighted_pct").desc_nulls_last(), "indicator")


def _profile_entry(survey: Survey, i: str, pct: Column, national: Column, n: Column) -> Column:
    return F.struct(
        F.lit(i).alias("indicator"),
        F.lit(survey.indicators[i].kind).alias("kind"),
        pct.alias("pct"),
        national.alias("national_pct"),
        n.alias("n_valid"),
        sample_flag(n).alias("reliability"),
        F.coalesce(pct >= national + ELEVATED_BY, F.lit(False)).alias("elevated"),
    )


def population_profile(df: DataFrame, survey: Survey, filters, indicators=None) -> DataFrame:
    """Target against everybody for each indicator. One scan: the target is a condition inside the sums."""
    names = list(indicators or survey.profile())
    target = F.coalesce(filter_column(survey, filters), F.lit(False))
    wide = df.agg(
        *indicator_sums(names, survey.weight, target, "_t"), *indicator_sums(names, survey.weight)
    )
    return _long(wide, [], [
        _profile_entry(survey, i, reported_pct(i, "_t"), reported_pct(i), F.col(f"n_{i}_t")) for i in names
    ])


def group_profiles(df: DataFrame, survey: Survey, group_by, indicators=None, filters=None) -> DataFrame:
    """A profile of every group at once, one row per (group, indicator), from a single scan."""
    groups, names = survey.columns(group_by), list(indicators or survey.profile())
    cells = indicator_cells(df, survey, groups, names, filters)
    national = cells.agg(F.struct(
        *[F.sum(f"{p}_{i}").alias(f"{p}_{i}") for i in names for p in ("n", "wy", "wv")]
    )).scalar()
    both = cells.withColumn("_nat", national)
    for i in names:
        both = both.withColumns({f"{p}_{i}_all": F.col(f"_nat.{p}_{i}") for p in ("n", "wy", "wv")})
    return _long(both, groups, [
        _profile_entry(survey, i, reported_pct(i), reported_pct(i, "_all"), F.col(f"n_{i}")) for i in names
    ])


def reach_split(profiles: DataFrame, group_by, threshold: float = REACH_THRESHOLD) -> DataFrame:
    """Per population: the reach channels at or above the threshold, and those below it."""
    usable = profiles.filter((F.col("kind") == "reach") & F.col("pct").isNotNull())
    names = lambda keep: F.array_sort(F.collect_list(F.when(keep, F.col("indicator"))))
    return usable.groupBy(*keys(group_by)).agg(
        names(F.col("pct") >= threshold).alias("wide_channels"), names(F.col("pct") < threshold).alias("narrow_channels")
    )


def places_for(df: DataFrame, survey: Survey, filters, place: str, within: str) -> DataFrame:
    """Distinct `place` codes implied by the filters: named directly, or containing the filtered `within` areas."""
    def named(variable):
        return [f for f in filters or [] if f["variable"] == variable and str(f.get("op", "=")).lower() in ("=", "in")]

    conditions = [filter_column(survey, [f]) for f in named(place) + named(within)]
    if not conditions:
        return df.select(place).limit(0)
    return df.filter(reduce(lambda a, b: a | b, conditions)).select(place).distinct()


def members_of(df: DataFrame, ranked: DataFrame, group_by) -> DataFrame:
    """Respondents belonging to the ranked groups (NULL keys match NULL)."""
    groups = keys(group_by)
    wanted = ranked.select(*[F.col(g).alias(f"_k_{g}") for g in groups])
    same = reduce(lambda a, b: a & b, [F.col(g).eqNullSafe(F.col(f"_k_{g}")) for g in groups])
    return df.join(wanted, same, "left_semi")
