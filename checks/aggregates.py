"""Cleaning, derivation and weighted aggregation."""

from __future__ import annotations

from pyspark.sql import functions as F

from surveyloom.functions.expressions import filter_column, outcome_column
from surveyloom.operators import aggregate as A
from surveyloom.operators import clean as C

from .registry import check
from .respondents import (EDUCATION, RAW_CODED, RESIDENCE, SURVEY, V, WEALTH, flag, pct, raw_respondents,
                          respondents, sql, values)

WORKING = {"variable": "working", "codes": [1]}


# ---- cleaning ---------------------------------------------------------------
@check("C1_valid_code_clean", sql("""
  SELECT CAST(raw.education AS INT) AS raw_education,
         CASE WHEN raw.education BETWEEN 0 AND 3 THEN CAST(raw.education AS INT) END AS education,
         count(*) AS n FROM raw GROUP BY 1, 2"""))
def c1(spark, sf):
    raw = raw_respondents(spark, sf, "education").withColumn("raw_education", F.col("education"))
    return C.clean(raw, [V["education"]]).groupBy("raw_education", "education").agg(F.count("*").alias("n"))


@check("C2_valid_range_clean", sql("""
  SELECT age AS raw_age, CASE WHEN age >= 15 AND age <= 49 THEN age END AS age, count(*) AS n
  FROM raw GROUP BY 1, 2"""))
def c2(spark, sf):
    raw = raw_respondents(spark, sf, "age").withColumn("raw_age", F.col("age"))
    return C.clean(raw, [V["age"]]).groupBy("raw_age", "age").agg(F.count("*").alias("n"))


@check("C3_cleaning_log", sql("""
  SELECT 'education' AS variable, CAST(education AS BIGINT) AS code, 'not specified' AS reason, count(*) AS n
  FROM raw WHERE education NOT IN (0,1,2,3) GROUP BY 2
  UNION ALL SELECT 'age', CAST(age AS BIGINT), 'out of range', count(*) FROM raw WHERE age NOT BETWEEN 15 AND 49 GROUP BY 2
  UNION ALL SELECT 'years', CAST(years AS BIGINT), CASE years WHEN 7 THEN 'inconsistent' ELSE 'out of range' END, count(*)
  FROM raw WHERE years NOT BETWEEN 1 AND 5 GROUP BY 2, years"""))
def c3(spark, sf):
    return C.cleaning_log(raw_respondents(spark, sf, *RAW_CODED), [V[c] for c in RAW_CODED])


@check("C4_special_codes", sql("""
  SELECT count(*) FILTER (WHERE education = 4) AS special_education, count(*) FILTER (WHERE years = 7) AS special_years,
    count(*) FILTER (WHERE education <> 4) AS valid_education, count(*) FILTER (WHERE years < 6) AS valid_years FROM raw"""))
def c4(spark, sf):
    raw = raw_respondents(spark, sf, "education", "years")
    both = raw.withColumns({"raw_education": F.col("education"), "raw_years": F.col("years")})
    cleaned = C.clean(both, [V["education"], V["years"]])
    return cleaned.agg(
        F.count_if((F.col("raw_education") == 4) & F.col("education").isNull()).alias("special_education"),
        F.count_if((F.col("raw_years") == 7) & F.col("years").isNull()).alias("special_years"),
        F.count("education").alias("valid_education"),
        F.count("years").alias("valid_years"),
    )


@check("C5_scaled_weight", sql("""
  SELECT residence, CAST(sum(weight) AS BIGINT) AS weight_total, round(CAST(sum(weight) AS DOUBLE) / 1000000, 6) AS w_total
  FROM raw GROUP BY residence"""))
def c5(spark, sf):
    from dataclasses import replace

    scaled = C.with_scaled_weight(raw_respondents(spark, sf, "residence"), replace(SURVEY, weight_scale=1_000_000))
    return scaled.groupBy("residence").agg(
        F.sum("weight").alias("weight_total"), F.round(F.sum("w"), 6).alias("w_total")
    )


@check("C6_age_bands", sql("""
  SELECT age_group, CASE age_group WHEN 1 THEN '15-19' WHEN 2 THEN '20-24' WHEN 3 THEN '25-29' WHEN 4 THEN '30-34'
    WHEN 5 THEN '35-39' WHEN 6 THEN '40-44' WHEN 7 THEN '45-49' END AS age_label, count(*) AS n,
    min(age) AS youngest, max(age) AS oldest FROM r GROUP BY 1, 2"""))
def c6(spark, sf):
    df = respondents(spark, sf, "age")
    return C.with_age_group(df, "age").groupBy("age_group", C.age_label("age_group").alias("age_label")).agg(
        F.count("*").alias("n"), F.min("age").alias("youngest"), F.max("age").alias("oldest")
    )


@check("C7_derived_indicators", sql("""
  SELECT residence, """ + ", ".join(
    f"count({i}) AS n_{i}, CAST(coalesce(sum({i}),0) AS BIGINT) AS yes_{i}" for i in SURVEY.indicators)
    + " FROM r GROUP BY residence"))
def c7(spark, sf):
    df = respondents(spark, sf, "residence", *SURVEY.indicators)
    return df.groupBy("residence").agg(*[
        x for i in SURVEY.indicators for x in (
            F.count(i).alias(f"n_{i}"), F.coalesce(F.sum(i), F.lit(0)).alias(f"yes_{i}"))
    ])


@check("C8_multi_source_indicator", sql("""
  SELECT residence, count(*) FILTER (WHERE m = 1) AS yes, count(*) FILTER (WHERE m = 0) AS no,
    count(*) FILTER (WHERE m IS NULL) AS unknown
  FROM (SELECT residence, CASE WHEN education <> 0 OR years <> 1 OR working <> 0 THEN 0
          WHEN education IS NULL OR years IS NULL OR working IS NULL THEN NULL ELSE 1 END AS m FROM r)
  GROUP BY residence"""))
def c8(spark, sf):
    from surveyloom.spec import Indicator, survey

    media = Indicator("m", "deprivation", "None of three", "all three at their lowest", ("education", "years", "working"),
                      lambda: (F.col("education") == 0) & (F.col("years") == 1) & (F.col("working") == 0))
    df = C.with_indicators(respondents(spark, sf, "residence", "education", "years", "working"), survey([], [media]))
    return df.groupBy("residence").agg(
        F.count_if(F.col("m") == 1).alias("yes"), F.count_if(F.col("m") == 0).alias("no"),
        F.count_if(F.col("m").isNull()).alias("unknown"))


@check("C9_outcome_expression", sql("""
  SELECT state, count(y) AS n_valid, CAST(sum(y) AS BIGINT) AS n_yes FROM (
    SELECT state, CASE WHEN education IS NULL THEN NULL WHEN education IN (0, 1) THEN 1 ELSE 0 END AS y FROM r)
  GROUP BY state"""))
def c9(spark, sf):
    y = outcome_column(SURVEY, {"variable": "education", "codes": [0, 1]})
    return respondents(spark, sf, "state", "education").groupBy("state").agg(
        F.count(y).alias("n_valid"), F.sum(y).alias("n_yes"))


FILTERS = [
    {"variable": "age", "op": "between", "value": [18, 24]},
    {"variable": "state", "op": "in", "value": [1, 2, 3, 5, 8, 13]},
    {"variable": "education", "op": "!=", "value": 3},
    {"variable": "wealth", "op": "not in", "value": [5]},
    {"variable": "residence", "op": "in", "value": 2},
    {"variable": "years", "op": "<=", "value": 4},
]
FILTER_SQL = ("age BETWEEN 18 AND 24 AND state IN (1,2,3,5,8,13) AND education <> 3 AND wealth NOT IN (5) "
              "AND residence = 2 AND years <= 4")


@check("C10_filter_spec", sql(f"SELECT state, education, count(*) AS n FROM r WHERE {FILTER_SQL} GROUP BY ALL"))
def c10(spark, sf):
    df = respondents(spark, sf, "age", "state", "education", "wealth", "residence", "years")
    return df.filter(filter_column(SURVEY, FILTERS)).groupBy("state", "education").agg(F.count("*").alias("n"))


@check("C12_analytic_sample", sql("""
  SELECT education, age_group, count(*) AS n FROM r
  WHERE working IS NOT NULL AND education IS NOT NULL AND age_group IS NOT NULL GROUP BY ALL"""))
def c12(spark, sf):
    df = respondents(spark, sf, "working", "education", "age_group")
    return C.analytic_sample(df, ["working", "education", "age_group"]).groupBy("education", "age_group").agg(
        F.count("*").alias("n"))


# ---- weighted aggregation ---------------------------------------------------
@check("A1_weighted_distribution", sql(f"""
  SELECT state, education, n, weighted_n, {pct('weighted_n', 'sum(weighted_n) OVER (PARTITION BY state)')} AS pct,
    {pct('n', 'sum(n) OVER (PARTITION BY state)')} AS pct_unweighted
  FROM (SELECT state, education, count(*) AS n, CAST(sum(weight) AS BIGINT) AS weighted_n FROM r
        WHERE state IS NOT NULL AND education IS NOT NULL GROUP BY state, education)"""))
def a1(spark, sf):
    return A.weighted_distribution(respondents(spark, sf, "state", "education"), "education", "state")


@check("A1_weighted_distribution_national", sql(f"""
  SELECT education, n, weighted_n, {pct('weighted_n', 'sum(weighted_n) OVER ()')} AS pct,
    {pct('n', 'sum(n) OVER ()')} AS pct_unweighted
  FROM (SELECT education, count(*) AS n, CAST(sum(weight) AS BIGINT) AS weighted_n FROM r
        WHERE education IS NOT NULL GROUP BY education)"""))
def a1n(spark, sf):
    return A.weighted_distribution(respondents(spark, sf, "education"), "education")


@check("A2_weighted_rate", sql(f"""
  SELECT residence, wealth, count(*) AS n, {pct('sum(weight * working)', 'sum(weight)')} AS pct
  FROM r WHERE working IS NOT NULL AND residence IS NOT NULL AND wealth IS NOT NULL GROUP BY ALL"""))
def a2(spark, sf):
    return A.weighted_rate(respondents(spark, sf, "residence", "wealth", "working"), ["residence", "wealth"], "working")


@check("A3_weighted_mean", sql("""
  SELECT state, count(*) AS n, CAST(sum(weight * years) AS DOUBLE) / CAST(sum(weight) AS DOUBLE) AS mean_years
  FROM r WHERE years IS NOT NULL GROUP BY state"""))
def a3(spark, sf):
    return A.weighted_mean(respondents(spark, sf, "state", "years"), "years", "state")


@check("A4_unweighted_rate", sql(f"""
  SELECT education, count(*) AS n, {pct('sum(working)', 'count(*)')} AS pct_unweighted
  FROM r WHERE working IS NOT NULL AND education IS NOT NULL GROUP BY education"""))
def a4(spark, sf):
    return A.unweighted_rate(respondents(spark, sf, "education", "working"), "education", "working")


def _metric_sql(groups: list[str], y: str, where: str = "TRUE") -> str:
    cols = "".join(f"{g}, " for g in groups)
    by = f"GROUP BY {', '.join(groups)}" if groups else ""
    return sql(f"""
      SELECT {cols} n_valid, n_yes AS n_yes_unweighted, n_all AS n_in_population,
        CAST(wy AS DOUBLE) AS weighted_numerator, CAST(wv AS DOUBLE) AS weighted_denominator,
        CASE WHEN n_valid >= 25 THEN {pct('wy', 'wv')} END AS weighted_pct, {flag('n_valid')} AS reliability
      FROM (SELECT {cols} count(y) AS n_valid, CAST(coalesce(sum(y),0) AS BIGINT) AS n_yes, count(*) AS n_all,
              coalesce(sum(weight * y),0) AS wy, coalesce(sum(CASE WHEN y IS NOT NULL THEN weight END),0) AS wv
            FROM (SELECT *, {y} AS y FROM r WHERE {where}) {by})""")


@check("A5_weighted_percentage", _metric_sql(["state", "residence"], "working"))
def a5(spark, sf):
    df = respondents(spark, sf, "state", "residence", "working")
    return A.weighted_percentage(df, SURVEY, WORKING, None, ["state", "residence"])


@check("A5_null_group_kept", _metric_sql(["education"], "working"))
def a5n(spark, sf):
    return A.weighted_percentage(respondents(spark, sf, "education", "working"), SURVEY, WORKING, None, ["education"])


@check("A5_filtered_ungrouped", _metric_sql([], "working", FILTER_SQL))
def a5f(spark, sf):
    df = respondents(spark, sf, "age", "state", "education", "wealth", "residence", "years", "working")
    return A.weighted_percentage(df, SURVEY, WORKING, FILTERS)


@check("A5_no_matching_rows", _metric_sql([], "working", "age = 15 AND age = 16"))
def a5e(spark, sf):
    df = respondents(spark, sf, "age", "working")
    never = [{"variable": "age", "value": 15}, {"variable": "age", "value": 16}]
    return A.weighted_percentage(df, SURVEY, WORKING, never)


@check("A6_count_respondents", sql(f"""
  SELECT state, residence, count(*) AS n_unweighted,
    {pct('sum(weight)', '(SELECT sum(weight) FROM r)')} AS weighted_pct_of_all
  FROM r WHERE age BETWEEN 18 AND 24 GROUP BY state, residence"""))
def a6(spark, sf):
    df = respondents(spark, sf, "state", "residence", "age")
    return A.count_respondents(df, SURVEY, FILTERS[:1], ["state", "residence"])


FREQ = ["education", "working", "residence", "wealth"]


@check("A7_frequency_table", sql(f"""
  SELECT variable, code, n_unweighted, {pct('n_unweighted', 'sum(n_unweighted) OVER (PARTITION BY variable)')} AS pct_unweighted,
    {pct('wn', 'sum(wn) OVER (PARTITION BY variable)')} AS pct_weighted
  FROM (""" + " UNION ALL ".join(
    f"SELECT '{v}' AS variable, {v} AS code, count(*) AS n_unweighted, sum(weight) AS wn FROM r WHERE {v} IS NOT NULL GROUP BY {v}"
    for v in FREQ) + ")"))
def a7(spark, sf):
    return A.frequency_table(respondents(spark, sf, *FREQ), FREQ)


@check("A8_A9_flags_and_suppression", sql(f"""
  SELECT state, education, age_group, count(*) AS n,
    CASE WHEN count(*) >= 25 THEN {pct('sum(weight * working)', 'sum(weight)')} END AS pct, {flag('count(*)')} AS reliability
  FROM r WHERE working IS NOT NULL AND state IS NOT NULL AND education IS NOT NULL AND age_group IS NOT NULL
  GROUP BY state, education, age_group"""))
def a8(spark, sf):
    df = respondents(spark, sf, "state", "education", "age_group", "working")
    return A.flagged_cells(df, ["state", "education", "age_group"], "working")


@check("A11_state_education", sql("SELECT state, count(education) AS n, " + ", ".join(
    f"{pct(f'coalesce(sum(weight) FILTER (WHERE education = {c}), 0)', 'sum(weight) FILTER (WHERE education IS NOT NULL)')} AS pct_{t.replace(' ', '_')}"
    for c, t in EDUCATION.items()) + """,
    CAST(sum(weight * years) AS DOUBLE) / CAST(sum(weight) FILTER (WHERE years IS NOT NULL) AS DOUBLE) AS mean_years
  FROM r GROUP BY state"""))
def a11(spark, sf):
    df = respondents(spark, sf, "state", "education", "years")
    return A.education_by_group(df, "state", "education", EDUCATION, "years").orderBy(F.desc("pct_higher"), "state")


@check("A12_state_employment", sql(f"""
  SELECT state, count(working) AS n, {pct('sum(weight * working)', 'sum(weight) FILTER (WHERE working IS NOT NULL)')} AS pct
  FROM r GROUP BY state"""))
def a12(spark, sf):
    df = respondents(spark, sf, "state", "working")
    return A.weighted_rate(df, "state", "working").orderBy(F.desc("pct"), "state")


@check("A12_education_employment", sql(f"""
  SELECT education, n, pct, education_label FROM (
    SELECT education, count(*) AS n, {pct('sum(weight * working)', 'sum(weight)')} AS pct
    FROM r WHERE working IS NOT NULL AND education IS NOT NULL GROUP BY education)
  JOIN {values(EDUCATION, 'education', 'education_label')} USING (education)"""))
def a12e(spark, sf):
    rate = A.weighted_rate(respondents(spark, sf, "education", "working"), "education", "working")
    return rate.withColumn("education_label", A.label_lookup("education", EDUCATION))


@check("A13_coverage", sql(f"""
  SELECT age_group, count(*) AS n, count(working) AS n_answered, {pct('count(working)', 'count(*)')} AS pct_answered,
    {pct('sum(weight)', 'sum(sum(weight)) OVER ()')} AS pct_of_all_weighted,
    {pct('sum(weight) FILTER (WHERE working IS NOT NULL)', 'sum(sum(weight) FILTER (WHERE working IS NOT NULL)) OVER ()')}
      AS pct_of_answered_weighted
  FROM r WHERE age_group IS NOT NULL GROUP BY age_group"""))
def a13(spark, sf):
    return A.coverage_table(respondents(spark, sf, "age_group", "working"), "age_group", "working")


@check("A14_employment_by_age", sql(f"""
  SELECT age_group, count(*) AS n, {pct('sum(weight * working)', 'sum(weight)')} AS pct
  FROM r WHERE working IS NOT NULL AND education IS NOT NULL AND age_group IS NOT NULL GROUP BY age_group"""))
def a14(spark, sf):
    df = C.analytic_sample(respondents(spark, sf, "age_group", "education", "working"), ["working", "education", "age_group"])
    return A.weighted_rate(df, "age_group", "working")


@check("A14_education_by_age", sql("SELECT age_group, count(*) AS n, " + ", ".join(
    f"{pct(f'sum(weight) FILTER (WHERE education = {c})', 'sum(weight)')} AS pct_{t.replace(' ', '_')}"
    for c, t in EDUCATION.items()) + """
  FROM r WHERE working IS NOT NULL AND education IS NOT NULL AND age_group IS NOT NULL GROUP BY age_group"""))
def a14e(spark, sf):
    df = C.analytic_sample(respondents(spark, sf, "age_group", "education", "working"), ["working"])
    return A.wide_distribution(df, "education", "age_group", EDUCATION)


@check("A15_flagged_cells", sql(f"""
  SELECT state, education, count(*) AS n,
    CASE WHEN count(*) >= 25 THEN {pct('sum(weight * working)', 'sum(weight)')} END AS pct, {flag('count(*)')} AS reliability
  FROM r WHERE working IS NOT NULL AND education IS NOT NULL GROUP BY state, education"""))
def a15(spark, sf):
    return A.flagged_cells(respondents(spark, sf, "state", "education", "working"), ["state", "education"], "working")


GROUPS_PLUS = {**WEALTH, 9: "NOBODY"}


@check("A16_group_sample_sizes", sql(f"""
  SELECT wealth, group_label, coalesce(n, 0) AS n, coalesce(a, 0) AS n_answered, {pct('a', 'n')} AS pct_answered,
    CAST(wx AS DOUBLE) / NULLIF(CAST(w AS DOUBLE), 0) AS mean_age_answered
  FROM {values(GROUPS_PLUS, 'wealth', 'group_label')} LEFT JOIN (
    SELECT wealth, count(*) AS n, count(*) FILTER (WHERE ok) AS a, sum(weight * age) FILTER (WHERE ok) AS wx,
      sum(weight) FILTER (WHERE ok) AS w
    FROM (SELECT *, working IS NOT NULL AND education IS NOT NULL AND age_group IS NOT NULL AS ok FROM r) GROUP BY wealth)
  USING (wealth)"""))
def a16(spark, sf):
    df = respondents(spark, sf, "wealth", "working", "education", "age", "age_group")
    return A.group_sample_sizes(df, "wealth", GROUPS_PLUS, ["working", "education", "age_group"], "age")
