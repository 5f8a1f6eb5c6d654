"""Standardization, group comparison, rankings and profiles."""

from __future__ import annotations

from pyspark.sql import functions as F

from surveyloom.functions.expressions import group_filters
from surveyloom.operators import aggregate as A
from surveyloom.operators import clean as C
from surveyloom.operators import compare as K
from surveyloom.operators import ranking as G
from surveyloom.operators import standardize as T

from .registry import check
from .respondents import EDUCATION, RESIDENCE, SURVEY, WEALTH, flag, pct, respondents, rnd, sql, values

NEED = ["working", "education", "age_group"]
SAMPLE = "working IS NOT NULL AND education IS NOT NULL AND age_group IS NOT NULL"
# The analytic sample and its seven standard shares, in SQL.
ANALYTIC = f"""
  a AS (SELECT * FROM r WHERE {SAMPLE}),
  sh AS (SELECT age_group, CAST(sum(weight) AS DOUBLE) / CAST(sum(sum(weight)) OVER () AS DOUBLE) AS share FROM a GROUP BY age_group),
  s AS (SELECT """ + ", ".join(f"max(share) FILTER (WHERE age_group = {i}) AS s{i}" for i in range(1, 8)) + " FROM sh)"


def std_sql(groups: str, where: str = "TRUE", src: str = "a", value: str = "working") -> str:
    """Crude and standardized rate of every group, as a subquery."""
    rate = lambda i: pct(f"sum(weight * {value}) FILTER (WHERE age_group = {i})",
                         f"sum(weight) FILTER (WHERE age_group = {i})")
    total = " + ".join(f"any_value(s{i}) * {rate(i)}" for i in range(1, 8))
    least = ", ".join(f"count(*) FILTER (WHERE age_group = {i})" for i in range(1, 8))
    return f"""(SELECT {groups}, count(*) AS n, {pct(f'sum(weight * {value})', 'sum(weight)')} AS crude_pct,
      {total} AS standardized_pct, least({least}) AS smallest_age_cell_n
      FROM {src}, s WHERE {where} GROUP BY {groups})"""


def std_flag(n: str) -> str:
    return (f"CASE WHEN {n} = 0 THEN 'not computed (an age group has no cases)' "
            f"WHEN {n} < 25 THEN 'caution (an age cell has n<25)' "
            f"WHEN {n} < 50 THEN 'caution (an age cell has n 25-49)' ELSE 'ok' END")


def analytic(spark, sf, *more):
    return C.analytic_sample(respondents(spark, sf, *dict.fromkeys([*NEED, *more])), NEED)


def six(df, *columns):
    return df.withColumns({c: F.round(c, 6) for c in columns})


@check("T1_standard_age_shares", sql("SELECT age_group, share FROM sh", ANALYTIC))
def t1(spark, sf):
    return T.standard_age_shares(analytic(spark, sf))


@check("T2_T3_standardized_rates", sql(f"""
  SELECT state, n, crude_pct, round(standardized_pct, 6) AS standardized_pct, smallest_age_cell_n,
    {std_flag('smallest_age_cell_n')} AS standardized_reliability FROM {std_sql('state')}""", ANALYTIC))
def t2(spark, sf):
    a = analytic(spark, sf, "state")
    return six(T.standardized_rates(a, "state", "working", T.standard_age_shares(a)), "standardized_pct")


@check("T2_missing_age_cells", sql(f"""
  SELECT state, wealth, education, n, crude_pct, round(standardized_pct, 6) AS standardized_pct, smallest_age_cell_n,
    {std_flag('smallest_age_cell_n')} AS standardized_reliability FROM {std_sql('state, wealth, education')}""", ANALYTIC))
def t2m(spark, sf):
    a = analytic(spark, sf, "state", "wealth")
    rates = T.standardized_rates(a, ["state", "wealth", "education"], "working")
    return six(rates, "standardized_pct")


@check("T4_crude_vs_standardized", sql(f"""
  SELECT education, n, crude_pct, round(standardized_pct, 6) AS standardized_pct, smallest_age_cell_n,
    {std_flag('smallest_age_cell_n')} AS standardized_reliability,
    {rnd(rnd('standardized_pct') + ' - ' + rnd('crude_pct'))} AS difference_std_minus_crude
  FROM {std_sql('education')}""", ANALYTIC))
def t4(spark, sf):
    a = analytic(spark, sf)
    return six(T.crude_vs_standardized(a, "education", "working"), "standardized_pct")


def _metric_std_sql(groups: str, y: str, where: str) -> str:
    join = " AND ".join(f"g.{g} IS NOT DISTINCT FROM c.{g}" for g in groups.split(", "))
    return sql(f"""
      SELECT {', '.join('g.' + x for x in groups.split(', '))}, g.n AS n_valid, g.crude AS crude_pct,
        CASE WHEN g.crude IS NOT NULL AND x.smallest > 0 THEN round(x.std, 6) END AS age_standardized_pct,
        x.smallest AS smallest_age_cell_n,
        CASE WHEN x.smallest = 0 THEN 'no cases in an age group' ELSE {flag('x.smallest')} END AS age_cell_reliability
      FROM g JOIN x ON {join.replace('c.', 'x.')}""", f"""
      p AS (SELECT *, {y} AS y FROM r WHERE {where}),
      c AS (SELECT {groups}, age_group, count(y) AS n, coalesce(sum(weight*y),0) AS wy,
              coalesce(sum(weight) FILTER (WHERE y IS NOT NULL),0) AS wv FROM p GROUP BY {groups}, age_group),
      st AS (SELECT age_group, CAST(sum(wv) AS DOUBLE) / CAST(sum(sum(wv)) OVER () AS DOUBLE) AS share FROM c GROUP BY age_group),
      g AS (SELECT {groups}, count(y) AS n, CASE WHEN count(y) >= 25 THEN {pct('sum(weight*y)', 'sum(weight) FILTER (WHERE y IS NOT NULL)')} END AS crude
            FROM p GROUP BY {groups}),
      x AS (SELECT {', '.join('g.' + q for q in groups.split(', '))}, min(coalesce(c.n, 0)) AS smallest,
              100 * sum(st.share * CAST(c.wy AS DOUBLE) / NULLIF(CAST(c.wv AS DOUBLE), 0)) AS std
            FROM g CROSS JOIN st LEFT JOIN c ON {join} AND st.age_group IS NOT DISTINCT FROM c.age_group
            GROUP BY {', '.join('g.' + q for q in groups.split(', '))})""")


@check("T5_age_standardized_metric", _metric_std_sql("education", "working", "residence = 2"))
def t5(spark, sf):
    df = respondents(spark, sf, "education", "age_group", "working", "residence")
    out = T.age_standardized_metric(df, SURVEY, {"variable": "working", "codes": [1]}, ["education"],
                                    [{"variable": "residence", "value": 2}])
    return six(out, "age_standardized_pct")


@check("T5_age_standardized_small_cells", _metric_std_sql("state, wealth", "d4", "age IS NOT NULL"))
def t5s(spark, sf):
    df = respondents(spark, sf, "state", "wealth", "age_group", "age", "d4")
    out = T.age_standardized_metric(df, SURVEY, {"indicator": "d4"}, ["state", "wealth"],
                                    [{"variable": "age", "op": "between", "value": [15, 49]}])
    return six(out, "age_standardized_pct")


SMALL_N = 1000  # so that both sides of the threshold occur in the shared tables


@check("T6_standardized_ranking", sql(f"""
  SELECT state, n, crude_pct, round(standardized_pct, 6) AS standardized_pct, smallest_age_cell_n,
    {std_flag('smallest_age_cell_n')} AS standardized_reliability,
    CASE WHEN n < {SMALL_N} THEN 'small sample (n<{SMALL_N})' ELSE 'ok' END AS sample_size_flag,
    CASE WHEN crude_pct IS NOT NULL THEN rank() OVER (ORDER BY {rnd('crude_pct')} DESC NULLS LAST) END AS rank_crude,
    CASE WHEN standardized_pct IS NOT NULL THEN rank() OVER (ORDER BY {rnd('standardized_pct')} DESC NULLS LAST) END AS rank_standardized
  FROM {std_sql('state')}""", ANALYTIC))
def t6(spark, sf):
    a = analytic(spark, sf, "state")
    out = T.standardized_ranking(a, "state", "working", small_n=SMALL_N)
    return six(out, "standardized_pct")


def _cells_sql(group: str, labels: dict) -> str:
    return f"""
      cells AS (SELECT {group}, group_label, education, level_label, coalesce(n, 0) AS n,
          CASE WHEN n >= 25 THEN crude_pct END AS crude_pct, {flag('coalesce(n, 0)')} AS crude_reliability, standardized_pct,
          coalesce(smallest_age_cell_n, 0) AS smallest_age_cell_n,
          {std_flag('coalesce(smallest_age_cell_n, 0)')} AS standardized_reliability
        FROM (SELECT * FROM {values(labels, group, 'group_label')}, {values(EDUCATION, 'education', 'level_label')})
        LEFT JOIN {std_sql(f'{group}, education')} USING ({group}, education))"""


def tables(spark, sf, group, labels):
    df = respondents(spark, sf, group, "working", "education", "age", "age_group")
    return T.group_table_set(df, group, labels, "education", EDUCATION, "working")


WEALTH_PLUS = {**WEALTH, 9: "NOBODY"}  # a listed group without respondents


@check("T7_employment_by_group", sql(f"""
  SELECT residence, group_label, n, crude_pct, round(standardized_pct, 6) AS standardized_pct, smallest_age_cell_n,
    {std_flag('smallest_age_cell_n')} AS standardized_reliability
  FROM {values(RESIDENCE, 'residence', 'group_label')} LEFT JOIN {std_sql('residence')} USING (residence)""", ANALYTIC))
def t7_3(spark, sf):
    return six(tables(spark, sf, "residence", RESIDENCE)["03_employment_by_group"], "standardized_pct")


@check("T7_education_distribution", sql("SELECT wealth, count(*) AS n, " + ", ".join(
    f"{pct(f'sum(weight) FILTER (WHERE education = {c})', 'sum(weight)')} AS pct_{t.replace(' ', '_')}"
    for c, t in EDUCATION.items()) + " FROM r WHERE education IS NOT NULL GROUP BY wealth"))
def t7_2(spark, sf):
    return tables(spark, sf, "wealth", WEALTH)["02_education_distribution"]


@check("T7_education_by_group_cells", sql(
    "SELECT * REPLACE (round(standardized_pct, 6) AS standardized_pct) FROM cells",
    ANALYTIC + "," + _cells_sql("wealth", WEALTH_PLUS)))
def t7_4(spark, sf):
    return six(tables(spark, sf, "wealth", WEALTH_PLUS)["04_employment_by_education_and_group"], "standardized_pct")


@check("T8_standardized_grid", sql("SELECT education, level_label, " + ", ".join(
    f"round(max(standardized_pct) FILTER (WHERE wealth = {c}), 6) AS \"{t}\"" for c, t in WEALTH_PLUS.items())
    + " FROM cells GROUP BY 1, 2", ANALYTIC + "," + _cells_sql("wealth", WEALTH_PLUS)))
def t8(spark, sf):
    grid = tables(spark, sf, "wealth", WEALTH_PLUS)["06_age_standardized_grid"]
    return six(grid, *WEALTH_PLUS.values())


@check("T8_crude_grid", sql("SELECT education, level_label, " + ", ".join(
    f"max(crude_pct) FILTER (WHERE residence = {c}) AS \"{t}\"" for c, t in RESIDENCE.items())
    + " FROM cells GROUP BY 1, 2", ANALYTIC + "," + _cells_sql("residence", RESIDENCE)))
def t8c(spark, sf):
    return tables(spark, sf, "residence", RESIDENCE)["05_crude_grid"]


def _at(col: str, code: int) -> str:
    return f"max({rnd(col)}) FILTER (WHERE education = {code})"


@check("T9_education_gaps", sql("SELECT wealth, group_label, " + ", ".join(
    f"{rnd(_at(col, x) + ' - ' + _at(col, y))} AS {kind}_gap_{name}"
    for kind, col in (("crude", "crude_pct"), ("age_std", "standardized_pct"))
    for x, y, name in ((2, 0, "secondary_minus_no_education"), (3, 2, "higher_minus_secondary")))
    + " FROM cells GROUP BY 1, 2", ANALYTIC + "," + _cells_sql("wealth", WEALTH_PLUS)))
def t9(spark, sf):
    return tables(spark, sf, "wealth", WEALTH_PLUS)["07_education_gaps"]


# ---- comparison --------------------------------------------------------------
@check("K1_top_and_bottom", sql(f"""
  SELECT position, rank_high_to_low, state, n, pct FROM (
    SELECT *, row_number() OVER (ORDER BY pct DESC, state) AS rank_high_to_low, count(*) OVER () AS total FROM (
      SELECT state, count(*) AS n, {pct('sum(weight * working)', 'sum(weight)')} AS pct FROM r WHERE working IS NOT NULL GROUP BY state))
  JOIN (VALUES ('highest'), ('lowest')) AS p(position)
    ON (position = 'highest' AND rank_high_to_low <= 5) OR (position = 'lowest' AND rank_high_to_low > total - 5)"""))
def k1(spark, sf):
    rate = A.weighted_rate(respondents(spark, sf, "state", "working"), "state", "working")
    return K.top_and_bottom(rate, "pct", "state")


def _gap_side(name: str, code: int) -> str:
    return f"(SELECT * FROM {std_sql('grp', f'education = {code}', 'both_a')}) {name}"


GAP = f"""
  both_a AS (SELECT *, CASE lvl WHEN 0 THEN state ELSE -1 END AS grp FROM a, (VALUES (0), (1)) AS v(lvl) WHERE education IN (0, 2)),
  gaps AS (SELECT grp, lo.n AS n_low, hi.n AS n_high,
      CASE WHEN lo.n >= 25 THEN {rnd('lo.crude_pct')} END AS crude_pct_low,
      CASE WHEN hi.n >= 25 THEN {rnd('hi.crude_pct')} END AS crude_pct_high,
      lo.standardized_pct AS sl, hi.standardized_pct AS sh, {rnd('hi.standardized_pct - lo.standardized_pct')} AS age_std_gap,
      least(coalesce(lo.smallest_age_cell_n, 0), coalesce(hi.smallest_age_cell_n, 0)) AS smallest_age_cell_n
    FROM {_gap_side('lo', 0)} FULL JOIN {_gap_side('hi', 2)} USING (grp)),
  nat AS (SELECT {rnd('crude_pct_high - crude_pct_low')} AS ncg, age_std_gap AS nsg FROM gaps WHERE grp = -1),
  gap_rows AS (SELECT CASE WHEN grp = -1 THEN 0 ELSE grp END AS state, grp = -1 AS is_national, coalesce(n_low, 0) AS n_low, coalesce(n_high, 0) AS n_high,
    crude_pct_low, crude_pct_high, {rnd('crude_pct_high - crude_pct_low')} AS crude_gap,
    round(sl, 6) AS age_std_pct_low, round(sh, 6) AS age_std_pct_high, age_std_gap, smallest_age_cell_n,
    ncg AS national_crude_gap, nsg AS national_age_std_gap, {rnd('age_std_gap - nsg')} AS age_std_gap_minus_national,
    CASE WHEN grp = -1 THEN 'reference'
      WHEN smallest_age_cell_n < 10 OR age_std_gap IS NULL THEN 'not assessed (an age cell has n<10)'
      WHEN age_std_gap - nsg >= 10 THEN 'differs: secondary relatively MORE likely to work than nationally'
      WHEN age_std_gap - nsg <= -10 THEN 'differs: secondary relatively LESS likely to work than nationally'
      ELSE 'similar to national' END AS pattern
  FROM gaps, nat)"""


def gap_table(spark, sf):
    a = analytic(spark, sf, "state")
    return K.level_gap_by_group(a, "state", "education", "working")


@check("K2_K3_education_gap_by_state", sql("SELECT * FROM gap_rows", ANALYTIC + "," + GAP))
def k2(spark, sf):
    return six(gap_table(spark, sf), "age_std_pct_low", "age_std_pct_high")


AVG_RANK = ("(rank() OVER (PARTITION BY {p} ORDER BY {x} DESC) + (count(*) OVER (PARTITION BY {p}, {x}) - 1) / 2.0)")


def correlation_table(spark, sf):
    df = respondents(spark, sf, "state", "education", "working", "age_group")
    higher = A.education_by_group(df.withColumn("years", F.col("education")), "state", "education", EDUCATION, "years")
    a = C.analytic_sample(df, NEED)
    rates = T.standardized_rates(a, "state", "working")
    return higher.select("state", "pct_higher").join(rates, "state")


CORR = f"""
  ed AS (SELECT state, {rnd(pct('coalesce(sum(weight) FILTER (WHERE education = 3), 0)', 'sum(weight) FILTER (WHERE education IS NOT NULL)'))} AS b FROM r GROUP BY state),
  long AS (SELECT state, n, 'crude_pct' AS measure, b, {rnd('crude_pct')} AS m FROM ed JOIN {std_sql('state')} USING (state)
    UNION ALL SELECT state, n, 'standardized_pct', b, {rnd('standardized_pct')} FROM ed JOIN {std_sql('state')} USING (state)),
  sets AS (SELECT 'all groups' AS groups_included, * FROM long
    UNION ALL SELECT 'excluding small samples (n<{SMALL_N})', * FROM long WHERE n >= {SMALL_N}),
  ranked AS (SELECT groups_included, measure,
      {AVG_RANK.format(p='groups_included, measure', x='b')} AS rb, {AVG_RANK.format(p='groups_included, measure', x='m')} AS rm
    FROM sets WHERE b IS NOT NULL AND m IS NOT NULL),
  corrs AS (SELECT groups_included, measure, count(rb) AS n_groups, corr(rb, rm) AS spearman
    FROM (VALUES ('all groups'), ('excluding small samples (n<{SMALL_N})')) AS g(groups_included)
    CROSS JOIN (VALUES ('crude_pct'), ('standardized_pct')) AS m(measure) LEFT JOIN ranked USING (groups_included, measure) GROUP BY 1, 2)"""


@check("K4_rank_correlations", sql("SELECT * REPLACE (round(spearman, 6) AS spearman) FROM corrs", ANALYTIC + "," + CORR))
def k4(spark, sf):
    out = K.rank_correlations(correlation_table(spark, sf), "pct_higher", ["crude_pct", "standardized_pct"], "n", SMALL_N)
    return six(out, "spearman")


# ---- ranking and profiles ----------------------------------------------------
D = ["d1", "d2", "d3", "d4", "d5"]
ALT = ["d2", "d4"]


def _ind(i: str, cond: str = "TRUE") -> str:
    y = f"CASE WHEN {cond} THEN {i} END"
    return (f"CASE WHEN count({y}) >= 25 THEN "
            + rnd(pct(f"sum(weight * {y})", f"sum(CASE WHEN ({y}) IS NOT NULL THEN weight END)")) + " END")


def _scores(groups: str, inds: list[str], where: str = "TRUE") -> str:
    cols = ", ".join(f"{_ind(i)} AS pct_{i}, count({i}) AS n_{i}" for i in inds)
    total = " + ".join(f"pct_{i}" for i in inds)
    return f"""(SELECT *, {rnd(f'({total}) / CAST({len(inds)} AS DOUBLE)')} AS deprivation_score FROM (
      SELECT {groups}, count(*) AS n_in_population, {cols} FROM r WHERE {where} GROUP BY {groups}))"""


def _ranked(groups: str, inds: list[str], min_n: int = 200) -> str:
    return f"""(SELECT *, row_number() OVER (ORDER BY deprivation_score DESC, {groups}) AS rank
      FROM {_scores(groups, inds)} WHERE deprivation_score IS NOT NULL AND n_in_population >= {min_n})"""


@check("K5_rank_underserved_top10", sql(f"SELECT * FROM {_ranked('state, wealth', D)} WHERE rank <= 10"))
def k5(spark, sf):
    return G.rank_underserved(respondents(spark, sf, "state", "wealth", *D), SURVEY, ["state", "wealth"])


@check("K5_rank_underserved_all", sql(f"SELECT * FROM {_ranked('district', D, 25)}"))
def k5all(spark, sf):
    from dataclasses import replace

    s = replace(SURVEY, extra_columns=("district",))
    return G.rank_underserved(respondents(spark, sf, "district", *D), s, ["district"], min_n=25, top_k=None)


@check("K5_ranking_summary", sql(f"""
  SELECT (SELECT count(*) FROM {_ranked('state, wealth', D)}) AS n_groups_ranked,
    (SELECT count(*) FROM {_scores('state, wealth', D)}) AS n_groups, """
    + ", ".join(f"national_{i}" for i in D) + f""", {rnd('(' + ' + '.join(f'national_{i}' for i in D) + ') / CAST(5 AS DOUBLE)')} AS national_score
  FROM (SELECT {', '.join(f'{_ind(i)} AS national_{i}' for i in D)} FROM r)"""))
def k5s(spark, sf):
    return G.ranking_summary(respondents(spark, sf, "state", "wealth", *D), SURVEY, ["state", "wealth"])


@check("K6_ranking_sensitivity", sql(f"""
  SELECT b.state, b.wealth, b.deprivation_score AS score, o.deprivation_score AS alternative_score, o.rank AS alternative_rank
  FROM {_ranked('state, wealth', D)} b JOIN {_ranked('state, wealth', ALT)} o USING (state, wealth) WHERE b.rank = 1"""))
def k6(spark, sf):
    return G.ranking_sensitivity(respondents(spark, sf, "state", "wealth", *D), SURVEY, ["state", "wealth"], ALT)


REACH = ["r1", "r2", "r3"]


def _reach_row(i: str) -> str:
    return f"""SELECT '{i}' AS indicator, '{SURVEY.indicators[i].description}' AS description,
      CASE WHEN count({i}) >= 25 THEN {pct(f'sum(weight * {i})', f'sum(weight) FILTER (WHERE {i} IS NOT NULL)')} END AS weighted_pct,
      count({i}) AS n_valid, {flag(f'count({i})')} AS reliability FROM r WHERE residence = 2 AND state IN (3, 7)"""


TARGET = [{"variable": "residence", "value": 2}, {"variable": "state", "op": "in", "value": [3, 7]}]


@check("K7_channel_reach", sql(" UNION ALL ".join(_reach_row(i) for i in REACH)))
def k7(spark, sf):
    return G.channel_reach(respondents(spark, sf, "residence", "state", *REACH), SURVEY, TARGET, REACH)


@check("K7_default_channels", sql(" UNION ALL ".join(_reach_row(i) for i in ("r2", "r3"))))
def k7d(spark, sf):
    return G.channel_reach(respondents(spark, sf, "residence", "state", *REACH), SURVEY, TARGET)


def _profile_row(i: str, cond: str) -> str:
    return f"""SELECT '{i}' AS indicator, '{SURVEY.indicators[i].kind}' AS kind, p AS pct, q AS national_pct, n AS n_valid,
      {flag('n')} AS reliability, coalesce(p >= q + 5, FALSE) AS elevated
      FROM (SELECT {_ind(i, cond)} AS p, {_ind(i)} AS q, count(CASE WHEN {cond} THEN {i} END) AS n FROM r)"""


@check("K8_population_profile", sql(" UNION ALL ".join(_profile_row(i, "residence = 2 AND state IN (3, 7)") for i in D + REACH)))
def k8(spark, sf):
    return G.population_profile(respondents(spark, sf, "residence", "state", *D, *REACH), SURVEY, TARGET, D + REACH)


@check("K8_default_profile", sql(" UNION ALL ".join(_profile_row(i, "residence = 2 AND state IN (3, 7)") for i in ("d1", "d3", "d5", "r2", "r3"))))
def k8d(spark, sf):
    return G.population_profile(respondents(spark, sf, "residence", "state", *D, *REACH), SURVEY, TARGET)


PROFILES = " UNION ALL ".join(f"""SELECT state, '{i}' AS indicator, '{SURVEY.indicators[i].kind}' AS kind, p AS pct, q AS national_pct,
  n AS n_valid, {flag('n')} AS reliability, coalesce(p >= q + 5, FALSE) AS elevated
  FROM (SELECT state, {_ind(i)} AS p, count({i}) AS n FROM r WHERE wealth = 2 GROUP BY state),
       (SELECT {_ind(i)} AS q FROM r WHERE wealth = 2)""" for i in D + REACH)


def profiles(spark, sf):
    df = respondents(spark, sf, "state", "wealth", *D, *REACH)
    return G.group_profiles(df, SURVEY, ["state"], D + REACH, [{"variable": "wealth", "value": 2}])


@check("K8_group_profiles", sql(PROFILES))
def k8g(spark, sf):
    return profiles(spark, sf)


@check("K9_places_for_filters", sql("SELECT DISTINCT state FROM r WHERE district IN (5, 17, 301, 302) OR state IN (4)"))
def k9(spark, sf):
    df = respondents(spark, sf, "state", "district")
    filters = [{"variable": "district", "op": "in", "value": [5, 17, 301, 302]}, {"variable": "state", "value": 4}]
    return G.places_for(df, SURVEY, filters, "state", "district")


@check("K10_members_of_ranked_groups", sql(f"""
  SELECT state, wealth, count(*) AS n, CAST(sum(weight) AS BIGINT) AS weight_total FROM r
  WHERE (state, wealth) IN (SELECT (state, wealth) FROM {_ranked('state, wealth', D)} WHERE rank <= 3) GROUP BY ALL"""))
def k10(spark, sf):
    df = respondents(spark, sf, "state", "wealth", *D)
    top = G.rank_underserved(df, SURVEY, ["state", "wealth"], top_k=3)
    return G.members_of(df, top, ["state", "wealth"]).groupBy("state", "wealth").agg(
        F.count("*").alias("n"), F.sum("weight").alias("weight_total"))


@check("M8_reach_split", sql(f"""
  SELECT state, coalesce(string_agg(indicator, '; ' ORDER BY indicator) FILTER (WHERE pct >= 25), '') AS wide_channels,
    coalesce(string_agg(indicator, '; ' ORDER BY indicator) FILTER (WHERE pct < 25), '') AS narrow_channels
  FROM ({PROFILES}) WHERE kind = 'reach' AND pct IS NOT NULL GROUP BY state"""))
def m8(spark, sf):
    split = G.reach_split(profiles(spark, sf), "state")
    return split.withColumns({c: F.array_join(c, "; ") for c in ("wide_channels", "narrow_channels")})
