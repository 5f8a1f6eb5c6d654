"""Sources, sinks, metadata and the data-quality audit."""

from __future__ import annotations

from pyspark.sql import functions as F

from surveyloom.operators import aggregate as A
from surveyloom.operators import clean as C
from surveyloom.operators import quality as Q
from surveyloom.plans.dataset import build_dataset
from surveyloom.sources import codebook as B
from surveyloom.sources import tables as S

from .comparisons import ANALYTIC, CORR, GAP, SMALL_N, _cells_sql, correlation_table, gap_table, std_sql, tables
from .registry import check
from .respondents import (EDUCATION, RAW_CODED, RESIDENCE, STATES, SURVEY, V, WEALTH, flag, pct, raw_respondents,
                          respondents, rnd, sql, table, values)

# ---- sources and sinks -------------------------------------------------------


@check("S1_column_pruned_read", """
  SELECT l_returnflag, count(*) AS n, CAST(sum(CAST(l_quantity AS BIGINT)) AS BIGINT) AS total FROM lineitem GROUP BY l_returnflag""")
def s1(spark, sf):
    df = S.read_columns(spark, f"{sf}/lineitem.parquet", ["l_returnflag", "l_quantity"])
    return df.groupBy("l_returnflag").agg(F.count("*").alias("n"), F.sum(F.col("l_quantity").cast("long")).alias("total"))


# A codebook derived from the tables: one labelled variable per region whose codes are
# its nations, plus one numbered slot per part type and size (no labels).
CODEBOOK = """
  cb AS (
    SELECT 'region_' || chr(97 + r_regionkey) AS variable_name, r_name AS variable_label, 'byte' AS stata_type,
      'lab' AS value_label_name, '{' || string_agg('"' || n_nationkey || '":"' || n_name || '"', ',' ORDER BY n_nationkey) || '}' AS value_labels
    FROM nation JOIN region ON n_regionkey = r_regionkey GROUP BY r_regionkey, r_name
    UNION ALL
    SELECT DISTINCT lower(p_type) || '_' || lpad(CAST(p_size AS VARCHAR), 2, '0'), 'size of ' || lower(p_type), 'int', '', '' FROM part)"""


def codebook(spark, sf):
    nation, region = table(spark, sf, "nation"), table(spark, sf, "region")
    entries = F.array_sort(F.collect_list(F.struct("n_nationkey", "n_name")))
    pairs = F.transform(entries, lambda e: F.concat(F.lit('"'), e["n_nationkey"].cast("string"), F.lit('":"'), e["n_name"], F.lit('"')))
    labelled = (
        nation.join(region, F.col("n_regionkey") == F.col("r_regionkey"))
        .groupBy("r_regionkey", "r_name").agg(pairs.alias("p"))
        .select(
            F.concat(F.lit("region_"), F.chr(F.lit(97) + F.col("r_regionkey"))).alias("variable_name"),
            F.col("r_name").alias("variable_label"), F.lit("byte").alias("stata_type"), F.lit("lab").alias("value_label_name"),
            F.concat(F.lit("{"), F.array_join("p", ","), F.lit("}")).alias("value_labels"),
        )
    )
    slots = table(spark, sf, "part").select(F.lower("p_type").alias("t"), "p_size").distinct().select(
        F.concat("t", F.lit("_"), F.lpad(F.col("p_size").cast("string"), 2, "0")).alias("variable_name"),
        F.concat(F.lit("size of "), "t").alias("variable_label"), F.lit("int").alias("stata_type"),
        F.lit("").alias("value_label_name"), F.lit("").alias("value_labels"),
    )
    return labelled.unionByName(slots)


@check("S2_codebook_load", f"WITH {CODEBOOK} SELECT * FROM cb")
def s2(spark, sf):
    path = S.write_report(codebook(spark, sf).repartition(1), S.scratch_path(spark, "codebook"))
    return B.load_codebook(spark, path)


@check("S3_value_label_table", """
  SELECT 'region_' || chr(97 + n_regionkey) AS variable, n_nationkey AS code, n_name AS label FROM nation""")
def s3(spark, sf):
    return B.value_label_table(codebook(spark, sf))


@check("S4_label_attach", sql(f"""
  SELECT state, n_name AS state_label,
    education, CAST(education AS VARCHAR) AS education_label, count(*) AS n
  FROM r LEFT JOIN nation ON state = n_nationkey GROUP BY ALL"""))
def s4(spark, sf):
    nation = table(spark, sf, "nation")  # education has no labels, so its codes stand for themselves
    labels = nation.select(F.lit("state").alias("variable"), F.col("n_nationkey").alias("code"), F.col("n_name").alias("label"))
    grouped = respondents(spark, sf, "state", "education").groupBy("state", "education").agg(F.count("*").alias("n"))
    return B.attach_labels(grouped, ["state", "education"], labels)


@check("S5_report_sink", sql(f"""
  SELECT state, count(*) AS n, {rnd(pct('sum(weight * working)', 'sum(weight)'))} AS pct FROM r WHERE working IS NOT NULL GROUP BY state"""))
def s5(spark, sf):
    rate = A.weighted_rate(respondents(spark, sf, "state", "working"), "state", "working")
    out = S.write_tables({"state_employment": rate}, S.scratch_path(spark, "reports"))
    return spark.read.schema("state int, n long, pct double").option("header", True).csv(out["state_employment"])


@check("S6_dataset_build", sql("""
  SELECT 'respondents' AS name, count(*) AS n FROM r UNION ALL SELECT 'variables', 12 UNION ALL
  SELECT 'derived_indicators', 8 UNION ALL
  SELECT 'cleaning_log', count(*) FROM (
    SELECT 'e', education FROM raw WHERE education = 4 UNION SELECT 'a', age FROM raw WHERE age NOT BETWEEN 15 AND 49
    UNION SELECT 'y', years FROM raw WHERE years NOT BETWEEN 1 AND 5)
  UNION ALL SELECT 'validation_checks', 2 UNION ALL SELECT 'build_info', 1 UNION ALL SELECT 'value_labels', 45"""))
def s6(spark, sf):
    raw = raw_respondents(spark, sf)
    raw = C.with_age_group(raw, "age")
    rules = [Q.positive("weight"), Q.Unique(("id",), name="id is unique")]
    paths = build_dataset(raw, SURVEY, S.scratch_path(spark, "dataset"), rules)
    parts = [spark.read.parquet(p).agg(F.lit(name).alias("name"), F.count("*").alias("n")) for name, p in paths.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out




def orders_as_text(spark, sf):
    """All columns, numbers and times in a form that does not depend on the engine."""
    return table(spark, sf, "orders").select(
        "o_orderkey", "o_custkey", "o_orderstatus", F.round(F.col("o_totalprice") * 100).cast("long").alias("o_totalprice"),
        F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss").alias("o_orderdate"), "o_orderpriority")


@check("S7_fingerprint", """
  SELECT count(*) AS n_rows, CAST(sum(CAST(('0x' || substr(sha256(concat_ws('|', o_orderkey, o_custkey, o_orderstatus, CAST(round(o_totalprice * 100) AS BIGINT), strftime(o_orderdate, '%Y-%m-%d %H:%M:%S'), o_orderpriority)), 1, 12)) AS BIGINT)) AS VARCHAR) AS checksum
  FROM orders""")
def s7(spark, sf):
    return S.fingerprint(orders_as_text(spark, sf)).withColumn("checksum", F.col("checksum").cast("string"))


@check("S7_integrity_checks", """
  SELECT 'row count' AS "check", CAST(count(*) AS VARCHAR) AS observed, CAST(count(*) AS VARCHAR) AS expected, TRUE AS passed FROM orders
  UNION ALL SELECT 'checksum', s, s, TRUE FROM (
    SELECT CAST(sum(CAST(('0x' || substr(sha256(concat_ws('|', o_orderkey, o_custkey, o_orderstatus, CAST(round(o_totalprice * 100) AS BIGINT), strftime(o_orderdate, '%Y-%m-%d %H:%M:%S'), o_orderpriority)), 1, 12)) AS BIGINT)) AS VARCHAR) AS s FROM orders)""")
def s7i(spark, sf):
    orders = orders_as_text(spark, sf)
    return S.integrity_checks(S.fingerprint(orders), S.fingerprint(orders.repartition(3, "o_custkey")))


PROFILED = ["education", "age", "years", "working"]


@check("S8_column_profile", sql(" UNION ALL ".join(
    f"SELECT '{c}' AS variable, count({c}) AS n_valid, count(*) - count({c}) AS n_missing, {pct(f'count(*) - count({c})', 'count(*)')} AS pct_missing FROM r"
    for c in PROFILED)))
def s8(spark, sf):
    return S.column_profile(respondents(spark, sf, *PROFILED), PROFILED)


# ---- quality -------------------------------------------------------------------
VALID = {"education": "education BETWEEN 0 AND 3", "age": "age BETWEEN 15 AND 49", "years": "years BETWEEN 1 AND 5",
         "working": "working IN (0, 1)"}


@check("V1_missingness", sql(" UNION ALL ".join(
    f"""SELECT '{c}' AS variable, '{V[c].label}' AS label, count(*) AS n_total, count(*) - count({c}) AS missing_raw,
    count({c}) - count(*) FILTER (WHERE {ok}) AS invalid_or_special, count(*) FILTER (WHERE {ok}) AS valid,
    {pct(f'count(*) FILTER (WHERE {ok})', 'count(*)')} AS pct_valid FROM raw""" for c, ok in VALID.items())))
def v1(spark, sf):
    return Q.missingness(raw_respondents(spark, sf, *RAW_CODED), [V[c] for c in RAW_CODED])


def _found(c: str, rule: str, ok: str, meaning: str) -> str:
    return f"""SELECT '{c}' AS variable, '{rule}' AS rule, 'found in data' AS source, CAST({c} AS BIGINT) AS code, {meaning} AS codebook_meaning,
      count(*) AS count FROM raw WHERE NOT ({ok}) GROUP BY {c}"""


@check("V2_code_audit", sql(
    _found("education", "valid codes from codebook", VALID["education"], "'not specified'") + " UNION ALL "
    + _found("age", "valid range 15-49", VALID["age"], "'(not in codebook)'") + " UNION ALL "
    + _found("years", "valid range 1-5", VALID["years"], "CASE years WHEN 7 THEN 'inconsistent' ELSE '(not in codebook)' END")
    + """ UNION ALL SELECT 'years', 'valid range 1-5', 'special code defined in codebook', 7, 'inconsistent', count(*) FROM raw WHERE years = 7
    UNION ALL SELECT 'working', 'valid codes from codebook', 'found in data', NULL, 'no invalid values found', 0
    UNION ALL SELECT 'weight', 'weight must be > 0', 'found in data', NULL, 'no invalid values found', 0"""))
def v2(spark, sf):
    names = [*RAW_CODED, "weight"]
    return Q.code_audit(raw_respondents(spark, sf, *RAW_CODED), [V[c] for c in names])


DIMS = {"residence": RESIDENCE, "wealth": {**WEALTH, 9: "NOBODY"}, "state": STATES, "age_group": C.AGE_LABELS}


@check("V3_sample_sizes", sql("""SELECT 'all' AS dimension, 'all' AS "group", count(*) AS n, count(working) AS n_answered,
  """ + pct("count(working)", "count(*)") + " AS pct_answered FROM r" + "".join(
    f""" UNION ALL SELECT '{d}', label, coalesce(n, 0), coalesce(na, 0), {pct('na', 'n')} FROM {values(labels)} v
    LEFT JOIN (SELECT {d} AS code, count(*) AS n, count(working) AS na FROM r GROUP BY {d}) g USING (code)"""
    for d, labels in DIMS.items())))
def v3(spark, sf):
    return Q.sample_sizes(respondents(spark, sf, *DIMS, "working"), DIMS, "working")


@check("V4_small_cell_summary", sql(f"""
  SELECT *, sum(n_cells) OVER (PARTITION BY "table", flag_column)::BIGINT AS n_cells_total FROM (
    SELECT 'cells' AS "table", 'crude_reliability' AS flag_column, crude_reliability AS flag, count(*) AS n_cells FROM cells GROUP BY 3
    UNION ALL SELECT 'cells', 'standardized_reliability', standardized_reliability, count(*) FROM cells GROUP BY 3
    UNION ALL SELECT 'three_way', 'reliability', {flag('n')}, count(*) FROM (
      SELECT count(*) AS n FROM a GROUP BY state, education, age_group) GROUP BY 3)""",
    ANALYTIC + "," + _cells_sql("wealth", {**WEALTH, 9: "NOBODY"})))
def v4(spark, sf):
    df = respondents(spark, sf, "state", "education", "age_group", "working")
    return Q.small_cell_summary({
        "cells": (tables(spark, sf, "wealth", {**WEALTH, 9: "NOBODY"})["04_employment_by_education_and_group"],
                  ["crude_reliability", "standardized_reliability"]),
        "three_way": (A.flagged_cells(df, ["state", "education", "age_group"], "working"), ["reliability"]),
    })


RECORDED = "CASE WHEN age IN (19, 33) THEN age // 5 - 1 ELSE age // 5 - 2 END"  # a recoding that disagrees at two ages


def recorded(df):
    band = F.floor(F.col("age") / 5).cast("int") - 2
    return df.withColumn("recorded", F.when(F.col("age").isin(19, 33), band + 1).otherwise(band))


@check("V5_crosstab", sql("SELECT age_group, " + ", ".join(
    f"count(*) FILTER (WHERE rec = {c}) AS \"{t}\"" for c, t in C.AGE_LABELS.items())
    + f", count(*) FILTER (WHERE rec <> age_group) AS mismatches_in_row FROM (SELECT *, {RECORDED} AS rec FROM r WHERE age IS NOT NULL) GROUP BY age_group"))
def v5(spark, sf):
    df = recorded(respondents(spark, sf, "age", "age_group"))
    return Q.crosstab(df, "age_group", "recorded", C.AGE_LABELS)


@check("V6_age_checks", sql("""
  SELECT 'n_total' AS "check", count(*) AS value FROM x UNION ALL SELECT 'age_missing', count(*) FILTER (WHERE age IS NULL) FROM x
  UNION ALL SELECT 'age_out_of_range', count(*) FILTER (WHERE age NOT BETWEEN 15 AND 49) FROM x
  UNION ALL SELECT 'age_valid', count(*) FILTER (WHERE age BETWEEN 15 AND 49) FROM x
  UNION ALL SELECT 'age_min', min(age) FILTER (WHERE age BETWEEN 15 AND 49) FROM x
  UNION ALL SELECT 'age_max', max(age) FILTER (WHERE age BETWEEN 15 AND 49) FROM x
  UNION ALL SELECT 'age_group_missing', count(*) FILTER (WHERE rec IS NULL) FROM x
  UNION ALL SELECT 'age_group_matches', count(*) FILTER (WHERE band = rec) FROM x
  UNION ALL SELECT 'age_group_differs', count(*) FILTER (WHERE band <> rec) FROM x""",
    f"x AS (SELECT age, {RECORDED} AS rec, CASE WHEN age BETWEEN 15 AND 49 THEN age // 5 - 2 END AS band FROM raw)"))
def v6(spark, sf):
    return Q.age_checks(recorded(raw_respondents(spark, sf, "age")), "age", "recorded")


BY = ["education", "age_group", "residence", "wealth", "state"]


def _est(name: str, code: str, n: str, u: str, w: str, where: str, group: str) -> str:
    return f"""SELECT '{name}' AS estimate, {code} AS group_code, {n} AS n_unweighted, {u} AS unweighted_pct, {w} AS weighted_pct
      FROM r WHERE {where} {group}"""


W_ALL = [
    _est("% at this level", str(c), f"count(*) FILTER (WHERE education = {c})", pct(f"count(*) FILTER (WHERE education = {c})", "count(*)"),
         pct(f"sum(weight) FILTER (WHERE education = {c})", "sum(weight)"), "education IS NOT NULL", "") for c in EDUCATION
] + [
    _est("% at the top level, by state", "state", "count(*)", pct("count(*) FILTER (WHERE education = 3)", "count(*)"),
         pct("coalesce(sum(weight) FILTER (WHERE education = 3), 0)", "sum(weight)"), "education IS NOT NULL", "GROUP BY state"),
    _est("% working", "NULL", "count(*)", pct("sum(working)", "count(*)"), pct("sum(weight * working)", "sum(weight)"), "working IS NOT NULL", ""),
] + [
    _est(f"% working, by {d}", d, "count(*)", pct("sum(working)", "count(*)"), pct("sum(weight * working)", "sum(weight)"),
         f"working IS NOT NULL AND {d} IS NOT NULL", f"GROUP BY {d}") for d in BY
]


@check("V7_weighted_vs_unweighted", sql(f"""
  SELECT *, weighted_pct - unweighted_pct AS weighted_minus_unweighted, abs(weighted_pct - unweighted_pct) >= 2 AS material_difference
  FROM ({' UNION ALL '.join(W_ALL)})"""))
def v7(spark, sf):
    df = respondents(spark, sf, *BY, "working")
    return Q.weighted_vs_unweighted(df, "education", list(EDUCATION), 3, "state", "working", BY)


@check("V8_without_small_groups", sql(f"""
  SELECT education, {pct('sum(wy)', 'sum(w)')} AS all_groups, {pct('sum(wy) FILTER (WHERE NOT small)', 'sum(w) FILTER (WHERE NOT small)')} AS excluding_small_groups,
    {pct('sum(wy) FILTER (WHERE NOT small)', 'sum(w) FILTER (WHERE NOT small)')} - {pct('sum(wy)', 'sum(w)')} AS difference,
    abs({pct('sum(wy) FILTER (WHERE NOT small)', 'sum(w) FILTER (WHERE NOT small)')} - {pct('sum(wy)', 'sum(w)')}) >= 2 AS material_difference,
    any_value(note) AS note
  FROM z, (SELECT count(DISTINCT state) || ' groups excluded: ' || coalesce(string_agg(DISTINCT 'NATION_' || state, '; ' ORDER BY 'NATION_' || state), '') AS note FROM z WHERE small)
  GROUP BY education""", f"""
  y AS (SELECT state, education, count(*) AS n, sum(weight * working) AS wy, sum(weight) AS w FROM r
        WHERE working IS NOT NULL AND education IS NOT NULL GROUP BY state, education),
  z AS (SELECT *, sum(n) OVER (PARTITION BY state) < 1250 AS small FROM y)"""))
def v8a(spark, sf):
    df = respondents(spark, sf, "state", "education", "working")
    out = Q.without_small_groups(df, "state", STATES, "education", "working", small_n=1250)
    # the report lists names in code order; the check compares them in name order
    head, names = F.split("note", ": ")[0], F.array_sort(F.split(F.split("note", ": ")[1], "; "))
    return out.withColumn("note", F.concat(head, F.lit(": "), F.array_join(names, "; ")))


@check("V8_correlation_sensitivity", sql(f"""
  SELECT measure, x AS all_groups, y AS excluding_small_groups, {rnd('y - x', 3)} AS difference,
    CASE WHEN greatest(abs(x), abs(y)) < 0.3 THEN 'both |r| < 0.3 (weak)' ELSE 'at least one |r| >= 0.3' END AS note
  FROM (SELECT measure, max({rnd('spearman', 3)}) FILTER (WHERE groups_included LIKE 'all%') AS x,
          max({rnd('spearman', 3)}) FILTER (WHERE groups_included LIKE 'excl%') AS y FROM corrs GROUP BY measure)""", ANALYTIC + "," + CORR))
def v8b(spark, sf):
    from surveyloom.operators.compare import rank_correlations

    measures = ["crude_pct", "standardized_pct"]
    return Q.correlation_sensitivity(
        rank_correlations(correlation_table(spark, sf), "pct_higher", measures, "n", SMALL_N))


@check("V8_pattern_sensitivity", sql("""
  SELECT item, a AS all_groups, b AS excluding_small_groups, b - a AS difference, note FROM (
    SELECT 'number of groups assessed' AS item, count(*) FILTER (WHERE pattern NOT LIKE 'not assessed%') AS a,
      count(*) FILTER (WHERE pattern NOT LIKE 'not assessed%' AND smallest_age_cell_n >= 25) AS b FROM gap_rows WHERE NOT is_national
    UNION ALL SELECT 'number of groups classified as differing', count(*) FILTER (WHERE pattern LIKE 'differs%'),
      count(*) FILTER (WHERE pattern LIKE 'differs%' AND smallest_age_cell_n >= 25) FROM gap_rows WHERE NOT is_national),
  (SELECT 'differing at 10: ' || coalesce(string_agg('NATION_' || state, '; ' ORDER BY 'NATION_' || state) FILTER (WHERE pattern LIKE 'differs%'), '')
     || ' | differing at 25: ' || coalesce(string_agg('NATION_' || state, '; ' ORDER BY 'NATION_' || state) FILTER (WHERE pattern LIKE 'differs%' AND smallest_age_cell_n >= 25), '') AS note
   FROM gap_rows WHERE NOT is_national)""", ANALYTIC + "," + GAP))
def v8c(spark, sf):
    gaps = gap_table(spark, sf).withColumn("name", F.concat(F.lit("NATION_"), F.col("state").cast("string")))
    return Q.pattern_sensitivity(gaps, "name")


@check("V9_validation_rules", sql("""
  SELECT 'row count' AS "check", count(*) || ' rows (expected 6)' AS detail, count(*) = 6 AS passed FROM raw
  UNION ALL SELECT 'weights are positive', count(*) FILTER (WHERE weight <= 0) || ' exceptions', count(*) FILTER (WHERE weight <= 0) = 0 FROM raw
  UNION ALL SELECT 'age_group equals recorded', x || ' exceptions', x = 0 FROM (SELECT count(*) FILTER (WHERE age IN (19, 33)) AS x FROM r)
  UNION ALL SELECT 'working is present exactly when asked = 1', '0 exceptions', TRUE
  UNION ALL SELECT 'years is a finer version of d4', '0 exceptions', TRUE
  UNION ALL SELECT 'no schooling means no years', x || ' exceptions', x = 0 FROM (SELECT count(*) FILTER (WHERE education = 0 AND years > 0) AS x FROM r)
  UNION ALL SELECT 'key is unique', count(*) || ' keys, ' || count(*) FILTER (WHERE n > 1) || ' repeated', count(*) FILTER (WHERE n > 1) = 0
    FROM (SELECT count(*) AS n FROM r GROUP BY id, years)
  UNION ALL SELECT 'proportional weights', 'largest relative spread 0.000000', TRUE"""))
def v9(spark, sf):
    df = recorded(respondents(spark, sf, "id", "state", "age", "age_group", "working", "years", "education", "d4"))
    df = df.withColumn("recorded", F.when(F.col("age").isNotNull(), F.col("recorded")))
    df = df.withColumns({
        "asked": F.when(F.col("working").isNotNull(), 1).otherwise(0), "state_weight": F.col("weight") * (F.col("state") + 1)})
    return Q.validate(df, [
        Q.RowCount(6), Q.positive("weight"), Q.same_value("age_group", "recorded"), Q.present_iff("working", "asked"),
        Q.refines("years", "d4", {1: 1, 2: 0, 3: 0, 4: 0, 5: 0}),
        Q.NoException("no schooling means no years", (F.col("education") == 0) & (F.col("years") > 0)),
        Q.Unique(("id", "years")), Q.Proportional("state_weight", "weight", "state", 2.39e-4),
    ])


@check("V10_reproduction", sql(f"""
  SELECT education, {pct('sum(weight * working)', 'sum(weight)')} AS left_value, {pct('sum(weight * working)', 'sum(weight)')} AS right_value, TRUE AS passed
  FROM r WHERE working IS NOT NULL AND education IS NOT NULL GROUP BY education"""))
def v10(spark, sf):
    df = respondents(spark, sf, "education", "working")
    metric = A.weighted_percentage(df, SURVEY, {"variable": "working", "codes": [1]}, None, ["education"])
    batch = A.weighted_rate(df, "education", "working")
    return Q.same_results(metric.dropna(subset=["education"]), batch, "education", "weighted_pct", "pct", 1e-9)
