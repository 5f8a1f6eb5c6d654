"""Organizations and populations, question tagging, statements, grounding, ad-hoc SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from surveyloom.operators import aggregate as A
from surveyloom.operators import chunk as H
from surveyloom.operators import matching as M
from surveyloom.operators import ranking as G
from surveyloom.operators import statements as Q
from surveyloom.operators import tagging as T
from surveyloom.operators.adhoc import run_select

from .comparisons import D, PROFILES, _ranked, profiles
from .registry import check
from .respondents import SURVEY, flag, pct, respondents, rnd, sql, table

# ---- organizations: every supplier is one ------------------------------------------
CHANNELS = {"television": "r1", "radio": "r2", "door-to-door": "r3", "community health workers": "r3"}

ORGS = """
  org AS (SELECT s_suppkey AS org_id, s_name AS name, CASE WHEN s_acctbal > 6000 THEN 'national' WHEN s_acctbal < 2500 THEN 'state' ELSE 'multi-state' END AS scope,
    CASE WHEN s_acctbal > 6000 THEN CAST([] AS VARCHAR[]) WHEN s_acctbal < 2500 THEN ['nation_' || s_nationkey]
      ELSE ['nation_' || s_nationkey, 'nation_' || ((s_nationkey + 1) % 25)] END AS states,
    CASE s_suppkey % 5 WHEN 0 THEN ['d1'] WHEN 1 THEN ['d2', 'd4'] WHEN 2 THEN ['d3'] WHEN 3 THEN ['d1', 'd2', 'd3', 'd4', 'd5'] ELSE CAST([] AS VARCHAR[]) END AS related,
    CASE s_suppkey % 4 WHEN 0 THEN ['television'] WHEN 1 THEN ['door-to-door', 'community health workers', 'radio'] WHEN 2 THEN ['self-help groups'] ELSE ['community health workers', 'door-to-door'] END AS channels
  FROM supplier)"""


def organizations(spark, sf):
    empty = F.array().cast("array<string>")
    near = F.concat(F.lit("nation_"), F.col("s_nationkey").cast("string"))
    after = F.concat(F.lit("nation_"), ((F.col("s_nationkey") + 1) % 25).cast("string"))
    words = lambda *w: F.array(*[F.lit(x) for x in w])
    need, way = F.col("s_suppkey") % 5, F.col("s_suppkey") % 4
    return table(spark, sf, "supplier").select(
        F.col("s_suppkey").alias("org_id"), F.col("s_name").alias("name"),
        F.when(F.col("s_acctbal") > 6000, "national").when(F.col("s_acctbal") < 2500, "state").otherwise("multi-state").alias("scope"),
        F.when(F.col("s_acctbal") > 6000, empty).when(F.col("s_acctbal") < 2500, F.array(near)).otherwise(F.array(near, after)).alias("states"),
        F.when(need == 0, words("d1")).when(need == 1, words("d2", "d4")).when(need == 2, words("d3"))
        .when(need == 3, words("d1", "d2", "d3", "d4", "d5")).otherwise(empty).alias("related_indicators"),
        F.when(way == 0, words("television")).when(way == 1, words("door-to-door", "community health workers", "radio"))
        .when(way == 2, words("self-help groups")).otherwise(words("community health workers", "door-to-door")).alias("channels"),
    )


# every state x wealth group is a population
PAIRS = [f"d{i}" for i in range(1, 6)] + ["r1", "r2", "r3"]


def _ind(i: str) -> str:
    return f"CASE WHEN count({i}) >= 25 THEN {rnd(pct(f'sum(weight * {i})', f'sum(weight) FILTER (WHERE {i} IS NOT NULL)'))} END"


POPS = f"""
  prof AS ({' UNION ALL '.join(f'''SELECT state * 10 + wealth AS population, state, '{i}' AS indicator, '{SURVEY.indicators[i].kind}' AS kind, p AS pct, q AS national_pct, n AS n_valid,
     coalesce(p >= q + 5, FALSE) AS elevated FROM (SELECT state, wealth, {_ind(i)} AS p, count({i}) AS n FROM r GROUP BY state, wealth), (SELECT {_ind(i)} AS q FROM r)''' for i in PAIRS)}),
  pop AS (SELECT DISTINCT population, 'nation_' || state AS place FROM prof),
  chan AS (SELECT * FROM (VALUES ('television', 'r1'), ('radio', 'r2'), ('door-to-door', 'r3'), ('community health workers', 'r3')) AS c(channel, indicator)),
  {ORGS.strip()},
  need AS (SELECT population, org_id, indicator, pct, national_pct FROM (SELECT org_id, unnest(list_distinct(related)) AS indicator FROM org) JOIN prof USING (indicator)
    WHERE kind = 'deprivation' AND elevated),
  chn AS (SELECT population, org_id, indicator, arg_min(channel, i) AS channel, any_value(pct) AS pct, any_value(n_valid) AS n_valid
    FROM (SELECT org_id, unnest(channels) AS channel, generate_subscripts(channels, 1) AS i FROM org) JOIN chan USING (channel) JOIN prof USING (indicator)
    WHERE kind = 'reach' AND pct >= 25 GROUP BY ALL),
  assessed AS (SELECT population, org_id, name,
      CASE WHEN scope = 'national' THEN 1 WHEN list_contains(states, place) THEN 2 WHEN scope = 'state' THEN NULL ELSE 0 END AS geography,
      (SELECT count(*) FROM need n WHERE n.population = pop.population AND n.org_id = org.org_id) AS need,
      (SELECT count(*) FROM chn c WHERE c.population = pop.population AND c.org_id = org.org_id) AS channel FROM pop, org),
  ranked AS (SELECT *, row_number() OVER (PARTITION BY population ORDER BY total DESC, name, org_id) AS rank FROM (
    SELECT *, geography + need + channel AS total FROM assessed WHERE geography IS NOT NULL) WHERE total > 0)"""


def population_profiles(spark, sf):
    df = respondents(spark, sf, "state", "wealth", *PAIRS)
    out = G.group_profiles(df, SURVEY, ["state", "wealth"], PAIRS)
    return out.withColumn("population", F.col("state") * 10 + F.col("wealth"))


def populations(spark, sf):
    state = F.concat(F.lit("nation_"), F.floor(F.col("population") / 10).cast("string"))
    return M.populations_from(population_profiles(spark, sf), "population", F.array(state))


@check("M1_geography_matches", sql(
    "SELECT population, org_id, place AS shared_states, 2 AS geography FROM pop, org WHERE scope <> 'national' AND list_contains(states, place)", POPS))
def m1(spark, sf):
    out = M.geography_matches(organizations(spark, sf), populations(spark, sf), "population")
    return out.withColumn("shared_states", F.array_join("shared_states", ","))


def ranking(spark, sf):
    return M.rank_organizations(organizations(spark, sf), populations(spark, sf), "population", CHANNELS)


@check("M1_M4_ranked_organizations", sql("""
  SELECT population, org_id, name, CAST(geography AS INT) AS geography, CAST(need AS INT) AS need, CAST(channel AS INT) AS channel,
    CAST(total AS INT) AS total, rank FROM ranked WHERE rank <= 10""", POPS))
def m4(spark, sf):
    return ranking(spark, sf)


@check("M2_need_matches", sql("""
  SELECT population, org_id, indicator, need.pct, national_pct FROM need JOIN ranked USING (population, org_id) WHERE rank <= 10""", POPS))
def m2(spark, sf):
    return M.need_matches(ranking(spark, sf), organizations(spark, sf), population_profiles(spark, sf), "population")


@check("M3_channel_matches", sql("""
  SELECT population, org_id, indicator, chn.channel, pct, n_valid FROM chn JOIN ranked USING (population, org_id) WHERE rank <= 10""", POPS))
def m3(spark, sf):
    return M.channel_matches(ranking(spark, sf), organizations(spark, sf), population_profiles(spark, sf), "population", CHANNELS)


FACTS = """
  fct AS (SELECT l_suppkey AS org_id, list('Supplies ' || p_type || ' ' || p_brand ORDER BY p_type, p_brand) AS texts
    FROM (SELECT DISTINCT l_suppkey, p_type, p_brand FROM lineitem JOIN part ON l_partkey = p_partkey) GROUP BY 1)"""


def with_facts(spark, sf):
    part = table(spark, sf, "part").select("p_partkey", "p_type", "p_brand")
    sold = table(spark, sf, "lineitem").join(part, F.col("l_partkey") == F.col("p_partkey")).select(
        F.col("l_suppkey").alias("org_id"), "p_type", "p_brand").distinct()
    text = F.transform(
        F.array_sort(F.collect_list(F.struct("p_type", "p_brand"))),
        lambda x: F.struct(F.concat(F.lit("Supplies "), x["p_type"], F.lit(" "), x["p_brand"]).alias("text"), F.lit("").alias("source_url")))
    return organizations(spark, sf).join(sold.groupBy("org_id").agg(text.alias("facts")), "org_id")


@check("R6_record_chunks", f"""WITH {ORGS}, {FACTS}
  SELECT 'outreach:' || org_id AS id, name || ' (program). Geography: ' || CASE WHEN scope = 'national' THEN 'national (all India)' ELSE array_to_string(states, ', ') END
    || '. see site Channels: ' || array_to_string(channels, ', ') || '. Stated work: ' || array_to_string(texts, ' ') AS text,
    'outreach knowledge base' AS source, name AS title FROM org JOIN fct USING (org_id)""")
def r6(spark, sf):
    geography = F.struct("scope", "states", F.lit("see site").alias("detail"))
    return H.record_chunks(with_facts(spark, sf).select(
        F.col("org_id").alias("id"), "name", F.lit("program").alias("type"), geography.alias("geography"), "facts", "channels"))


@check("M5_keyword_search", f"""WITH {ORGS}, {FACTS},
  qs AS (SELECT DISTINCT c_nationkey * 10 + c_custkey % 7 AS query_id, CASE c_custkey % 7 WHEN 0 THEN 'brand#1 or a ECONOMY' WHEN 1 THEN 'of it' WHEN 2 THEN 'uppli radio'
      WHEN 3 THEN 'zzz supplier#00000001' WHEN 4 THEN '#2' WHEN 5 THEN 'health' ELSE 'nothing here' END AS text,
    CASE WHEN c_custkey % 7 IN (2, 3) THEN '' ELSE 'Nation_' || c_nationkey END AS state FROM customer),
  body AS (SELECT org_id, scope, states, lower(name || ' ' || array_to_string(texts, ' ') || ' ' || array_to_string(channels, ' ')) AS b FROM org JOIN fct USING (org_id)),
  ws AS (SELECT *, list_filter(string_split_regex(lower(text), '\\s+'), lambda w: length(w) > 2) AS words FROM qs)
  SELECT query_id, org_id FROM ws, body WHERE (scope = 'national' OR state = '' OR list_contains(states, lower(state)))
    AND (len(words) = 0 OR len(list_filter(words, lambda w: contains(b, w))) > 0)""")
def m5(spark, sf):
    kind = F.col("c_custkey") % 7
    text = F.when(kind == 0, "brand#1 or a ECONOMY").when(kind == 1, "of it").when(kind == 2, "uppli radio").when(
        kind == 3, "zzz supplier#00000001").when(kind == 4, "#2").when(kind == 5, "health").otherwise("nothing here")
    queries = table(spark, sf, "customer").select(
        (F.col("c_nationkey") * 10 + kind).alias("query_id"), text.alias("text"),
        F.when(kind.isin(2, 3), "").otherwise(F.concat(F.lit("Nation_"), F.col("c_nationkey").cast("string"))).alias("state"),
    ).distinct()
    return M.search_records(queries, with_facts(spark, sf), "query_id")


def web_records(spark, sf):
    altered = F.when(F.col("page_id") % 3 == 0, F.concat("url", F.lit("&made=up"))).otherwise(F.col("url"))
    pages = table(spark, sf, "pages")
    return pages.select(F.floor(F.col("page_id") / 2).alias("record"), altered.alias("source_url")), pages.select("url")


WEB = "w AS (SELECT page_id // 2 AS record, CASE WHEN page_id % 3 = 0 THEN url || '&made=up' ELSE url END AS source_url FROM pages)"


@check("M6_sourced_facts", f"WITH {WEB} SELECT record, source_url FROM w WHERE source_url IN (SELECT url FROM pages)")
def m6(spark, sf):
    records, seen = web_records(spark, sf)
    return M.sourced_facts(records, seen, "record").select("record", "source_url")


@check("M6_dropped_facts", f"""WITH {WEB} SELECT CAST(sum(n - k) AS BIGINT) AS dropped_facts, count(*) FILTER (WHERE k = 0) AS dropped_records FROM (
  SELECT record, count(*) AS n, count(*) FILTER (WHERE source_url IN (SELECT url FROM pages)) AS k FROM w GROUP BY record)""")
def m6d(spark, sf):
    return M.dropped_facts(*web_records(spark, sf), "record")


@check("M7_name_deduplication", """
  SELECT c_custkey, name FROM (SELECT c_custkey, CASE WHEN c_custkey % 2 = 0 THEN replace(upper(c_name), 'CUSTOMER#', 'Supplier - ') ELSE c_name END AS name FROM customer)
  WHERE regexp_replace(lower(name), '[^\\p{L}\\p{N}]', '', 'g') NOT IN (SELECT regexp_replace(lower(s_name), '[^\\p{L}\\p{N}]', '', 'g') FROM supplier)""")
def m7(spark, sf):
    name = F.when(F.col("c_custkey") % 2 == 0, F.replace(F.upper("c_name"), F.lit("CUSTOMER#"), F.lit("Supplier - "))).otherwise(F.col("c_name"))
    found = table(spark, sf, "customer").select("c_custkey", name.alias("name"))
    return M.new_records(table(spark, sf, "supplier").select(F.col("s_name").alias("name")), found)


# ---- questions -----------------------------------------------------------------------
PREFIXES = [
    "Explain v012 please.", "How many women between 18 and 24 were interviewed in Nation_3?", "What share of rural women goes without health insurance?",
    "Where do the most underserved women live?", "Which group should a charity prioritize first?", "Name NGOs or outreach channels for them in nation_12 and nation_1.",
    "Share of women aged 15 to 49 who own a mobile phone, by state", "Set urban against rural women on internet use.", "Number of interviews by caste",
    "What is the rate of anaemia among the poorest women?", "Do women aged 60-70 listen to the radio?", "Percent with no education across districts",
    "Recommend partners for richer urban women", "Employment by age group and education levels", "Secondary school, but never online", "",
]
_PREFIX_SQL = "[" + ", ".join("'" + p.replace("'", "''") + "'" for p in PREFIXES) + "]"
ASKED = f"""
  ask AS (SELECT conv_id, turn, {_PREFIX_SQL}[(conv_id * 3 + turn) % {len(PREFIXES)} + 1] || ' ' || text AS text,
    (conv_id * 3 + turn) % {len(PREFIXES)} = 0 AS mentions FROM conversations WHERE role = 'user')"""


def questions(spark, sf):
    n = ((F.col("conv_id") * 3 + F.col("turn")) % len(PREFIXES)).cast("int")
    prefix = F.get(F.array(*[F.lit(p) for p in PREFIXES]), n)
    return table(spark, sf, "conversations").filter("role = 'user'").select(
        "conv_id", "turn", F.concat(prefix, F.lit(" "), "text").alias("text"), (n == 0).alias("mentions"))


PLACED = ASKED + """,
  hit AS (SELECT conv_id, turn, n_nationkey AS code, lower(n_name) AS name FROM ask, nation
    WHERE length(n_name) >= 3 AND regexp_matches(lower(text), '(^|[^a-z])' || lower(n_name) || '([^a-z]|$)')),
  kept AS (SELECT * FROM hit h WHERE NOT EXISTS (SELECT 1 FROM hit o WHERE o.conv_id = h.conv_id AND o.turn = h.turn AND o.name <> h.name AND contains(o.name, h.name))),
  placed AS (SELECT conv_id, turn, string_agg(CAST(code AS VARCHAR), ',' ORDER BY length(name) DESC, code) AS states FROM kept GROUP BY conv_id, turn)"""


def placed(spark, sf):
    labels = table(spark, sf, "nation").select(F.col("n_nationkey").alias("code"), F.col("n_name").alias("label"))
    q = questions(spark, sf).withColumn("key", F.struct("conv_id", "turn"))
    return q, T.places(q, labels, "key")


@check("Q2_place_names", f"WITH {PLACED} SELECT conv_id, turn, states FROM placed")
def q2(spark, sf):
    _, found = placed(spark, sf)
    codes = F.array_join(F.transform("places", lambda p: p["code"].cast("string")), ",")
    return found.select("key.conv_id", "key.turn", codes.alias("states"))


@check("Q3_age_range", f"""WITH {ASKED}
  SELECT conv_id, turn, lo AS low, hi AS high FROM (SELECT conv_id, turn,
    TRY_CAST(regexp_extract(lower(text), '([0-9]{{2}})\\s*(?:-|–|—|to|and)\\s*([0-9]{{2}})', 1) AS INT) AS lo,
    TRY_CAST(regexp_extract(lower(text), '([0-9]{{2}})\\s*(?:-|–|—|to|and)\\s*([0-9]{{2}})', 2) AS INT) AS hi FROM ask)
  WHERE lo >= 15 AND lo <= hi AND hi <= 49""")
def q3(spark, sf):
    return questions(spark, sf).select("conv_id", "turn", F.inline(F.array_compact(F.array(T.age_range(F.lower("text"))))))


def _rx(p: str) -> str:
    return f"regexp_matches(t, '{p.replace(chr(39), chr(39) * 2)}')"


def _say(spec: dict | None) -> str:
    if not spec:
        return "NULL"
    return f"'{spec['indicator']}'" if "indicator" in spec else f"'{spec['variable']} in {','.join(map(str, spec['codes']))}'"


_OUT = "CASE " + " ".join(
    f"WHEN {_rx(p)} THEN " + (f"CASE WHEN {_rx(T.NEGATION)} THEN {_say(n)} ELSE {_say(a)} END" if n else _say(a))
    for p, a, n in T.OUTCOME_RULES) + " END"
_GROUPS = "list_filter([" + ", ".join(f"CASE WHEN {_rx(p)} THEN '{c}' END" for p, c in T.GROUP_BY_RULES) + "], lambda x: x IS NOT NULL)"
_WEALTH = "CASE " + " ".join(f"WHEN {_rx(chr(92) + 'b' + w + chr(92) + 'b')} THEN {c}" for w, c in T.WEALTH_WORDS) + " END"
_ASK_NGO = T.ASKING_FOR_AN_NGO


@check("Q1_question_tags", f"""WITH {PLACED},
  f AS (SELECT *, {_OUT} AS outcome, {_GROUPS} AS g,
      regexp_matches(regexp_replace(t, '{_ASK_NGO}', '', 'g'), '{T.OUTREACH_WORDS}') AS wo, {_rx(T.UNDERSERVED_WORDS)} AS wu, ({_rx(T.DOC_WORDS)} OR mentions) AS wd,
      {_rx(T.PERCENT_WORDS)} AS wp, {_rx(T.COUNT_WORDS)} AS wc,
      TRY_CAST(regexp_extract(t, '([0-9]{{2}})\\s*(?:-|–|—|to|and)\\s*([0-9]{{2}})', 1) AS INT) AS lo,
      TRY_CAST(regexp_extract(t, '([0-9]{{2}})\\s*(?:-|–|—|to|and)\\s*([0-9]{{2}})', 2) AS INT) AS hi
    FROM (SELECT ask.*, lower(text) AS t, coalesce(states, '') AS states FROM ask LEFT JOIN placed USING (conv_id, turn))),
  h AS (SELECT *, coalesce(lo >= 15 AND lo <= hi AND hi <= 49, FALSE) AS aged,
      CASE WHEN NOT list_contains(g, 'v025') THEN CASE WHEN {_rx(chr(92) + 'brural' + chr(92) + 'b')} THEN 2 WHEN {_rx(chr(92) + 'burban' + chr(92) + 'b')} THEN 1 END END AS residence,
      CASE WHEN NOT list_contains(g, 'v190') THEN {_WEALTH} END AS wealth,
      CASE WHEN wu THEN 'underserved' WHEN wo AND NOT (wp OR wc) THEN 'outreach_only' WHEN wc AND NOT wp THEN 'count' WHEN wp AND outcome IS NOT NULL THEN 'percentage'
        WHEN wd THEN 'documentation' WHEN outcome IS NOT NULL THEN 'percentage' ELSE 'unknown' END AS i FROM f),
  k AS (SELECT *, aged OR states <> '' OR residence IS NOT NULL OR wealth IS NOT NULL AS filtered FROM h)
  SELECT conv_id, turn, outcome, array_to_string(g, ',') AS group_by, CASE WHEN aged THEN lo || '-' || hi END AS age, states, residence, wealth,
    CASE WHEN i = 'outreach_only' AND NOT filtered THEN 'underserved' ELSE i END AS intent, i <> 'outreach_only' OR NOT filtered AS needs_data,
    wo OR i = 'outreach_only' AS needs_outreach FROM k""")
def q1(spark, sf):
    q, found = placed(spark, sf)
    tagged = T.tag_questions(q.join(found, "key", "left"), mentions="mentions", states="places")
    o = F.col("outcome")
    spec = F.coalesce(o["indicator"], F.concat(o["variable"], F.lit(" in "), F.array_join(o["codes"].cast("array<string>"), ",")))
    return tagged.select(
        "conv_id", "turn", spec.alias("outcome"), F.array_join("group_by", ",").alias("group_by"),
        F.concat(F.col("age.low").cast("string"), F.lit("-"), F.col("age.high").cast("string")).alias("age"),
        F.array_join(F.col("states").cast("array<string>"), ",").alias("states"), "residence", "wealth", "intent", "needs_data", "needs_outreach")


# ---- statements and grounding -----------------------------------------------------------
METRIC = f"""
  m AS (SELECT state, wealth, count(working) AS n_valid, CAST(coalesce(sum(working), 0) AS BIGINT) AS n_yes, count(*) AS n_pop,
      CASE WHEN count(working) >= 25 THEN {pct('sum(weight * working)', 'sum(weight) FILTER (WHERE working IS NOT NULL)')} END AS p,
      {flag('count(working)')} AS reliability FROM r WHERE education IS NOT NULL AND years <= 2 GROUP BY state, wealth),
  n AS (SELECT *, 'w' || wealth AS label, format('{{:,}}', n_valid) AS nv, CAST({rnd('p')} AS VARCHAR) || '%' AS sp FROM m)"""


def metric(spark, sf):
    df = respondents(spark, sf, "state", "wealth", "education", "years", "working")
    keep = [{"variable": "education", "op": ">=", "value": 0}, {"variable": "years", "op": "<=", "value": 2}]
    rows = A.weighted_percentage(df, SURVEY, {"variable": "working", "codes": [1]}, keep, ["state", "wealth"])
    return rows.withColumn("label", F.concat(F.lit("w"), F.col("wealth").cast("string")))


@check("Q4_value_statements", sql("""
  SELECT state, wealth, 0 AS line, coalesce(sp, 'suppressed (too few cases)') || ' of this group: working (weighted; n = ' || nv || ' women with a valid answer, '
    || format('{:,}', n_yes) || ' of them ''yes'').' AS statement FROM n
  UNION ALL SELECT state, wealth, 1, format('{:,}', n_pop - n_valid) || ' of the ' || format('{:,}', n_pop)
    || ' women in this population have no valid answer (not asked or missing) and are excluded.' FROM n WHERE n_valid < n_pop""", METRIC))
def q4v(spark, sf):
    return Q.value_statements(metric(spark, sf), ["state", "wealth"], F.lit("working"), F.lit("this group"))


def _group_lines(by: str, label: str) -> str:
    item = f"{label} || ' ' || sp || ' (n=' || nv || ')'"
    return f"""
  SELECT {by}, 0 AS line, CASE WHEN t > 6 THEN 'Highest: ' || string_agg({item}, '; ' ORDER BY d) FILTER (WHERE d <= 3)
      ELSE string_agg({label} || ': ' || sp || ' (n=' || nv || ')', '; ' ORDER BY d) END AS statement
  FROM o GROUP BY {by}, t
  UNION ALL SELECT {by}, 1, 'Lowest: ' || string_agg({item}, '; ' ORDER BY d) FROM o WHERE t > 6 AND d > t - 3 GROUP BY {by}
  UNION ALL SELECT {by}, 2, max(c) || ' group(s) have small samples and are suppressed or flagged: ' || string_agg({label} || ' (' || reliability || ')', '; ' ORDER BY {label})
  FROM (SELECT *, row_number() OVER (PARTITION BY {by} ORDER BY {label}) AS k, count(*) OVER (PARTITION BY {by}) AS c FROM n WHERE reliability <> 'ok') WHERE k <= 8 GROUP BY {by}"""


def _ordered(by: str, label: str) -> str:
    return (f", o AS (SELECT *, row_number() OVER (PARTITION BY {by} ORDER BY p DESC, {label}) AS d, count(*) OVER (PARTITION BY {by}) AS t FROM n WHERE p IS NOT NULL)")


@check("Q4_group_statements_few", sql(_group_lines("state", "label"), METRIC + _ordered("state", "label")))
def q4g(spark, sf):
    return Q.group_statements(metric(spark, sf), "state", "label")


@check("Q4_group_statements_many", sql(_group_lines("wealth", "('s' || state)"), METRIC + _ordered("wealth", "('s' || state)")))
def q4m(spark, sf):
    rows = metric(spark, sf).withColumn("label", F.concat(F.lit("s"), F.col("state").cast("string")))
    return Q.group_statements(rows, "wealth", "label")


@check("Q4_count_statements", sql(f"""
  SELECT state, format('{{:,}}', count(*)) || ' respondents match: this state. After weighting, they represent '
    || CAST({rnd(pct('sum(weight)', '(SELECT sum(weight) FROM r)'))} AS VARCHAR) || '% of all respondents in the survey.' AS statement
  FROM r WHERE age BETWEEN 18 AND 24 GROUP BY state"""))
def q4c(spark, sf):
    df = respondents(spark, sf, "state", "age")
    rows = A.count_respondents(df, SURVEY, [{"variable": "age", "op": "between", "value": [18, 24]}], ["state"])
    return Q.count_statements(rows, "state", F.lit("this state"))


@check("Q4_ranking_statements", sql(f"""
  SELECT 0 AS line, 'Top ' || count(*) || ' by deprivation score (higher = more women lacking the indicators): '
    || string_agg('#' || rank || ' state ' || state || ', w' || wealth || ' score ' || deprivation_score || ' (n=' || format('{{:,}}', n_in_population) || ')', '; ' ORDER BY rank) AS statement
  FROM {_ranked('state, wealth', D)} WHERE rank <= 5
  UNION ALL SELECT 1, 'state ' || state || ', w' || wealth || ': ' || {" || ', ' || ".join(f"'{i} ' || pct_{i} || '%'" for i in D)} || '.'
  FROM {_ranked('state, wealth', D)} WHERE rank = 1"""))
def q4r(spark, sf):
    top = G.rank_underserved(respondents(spark, sf, "state", "wealth", *D), SURVEY, ["state", "wealth"])
    label = F.concat(F.lit("state "), F.col("state").cast("string"), F.lit(", w"), F.col("wealth").cast("string"))
    return Q.ranking_statements(top.withColumn("label", label), "label", D)


@check("Q4_reach_statements", sql(f"""
  SELECT state, 'Channel reach in this population: ' || string_agg(indicator || ' ' || pct || '% (n=' || format('{{:,}}', n_valid) || ')', '; ' ORDER BY pct DESC, indicator) || '.' AS statement
  FROM ({PROFILES}) WHERE kind = 'reach' AND pct IS NOT NULL GROUP BY state"""))
def q4h(spark, sf):
    return Q.reach_statements(profiles(spark, sf), "state")


# Narratives repeat the statements; in every fifth state one digit group is altered.
NARRATED = METRIC + """,
  st AS (SELECT state, wealth, 'w' || wealth || ': ' || sp || ' (n=' || nv || ')' AS text FROM n WHERE sp IS NOT NULL),
  na AS (SELECT state, wealth, 'About ' || CAST(round(CAST(p AS DECIMAL(38,10)), 1) AS VARCHAR) || CASE WHEN state % 5 = 0 THEN '7% work' ELSE '% work' END
      || ', n = ' || CASE WHEN state % 5 = 1 THEN format('{:,}', n_valid + 11) ELSE nv END || ', about 3 of 10.' AS text FROM n WHERE sp IS NOT NULL)"""


@check("Q5_number_grounding", sql(r"""
  SELECT state, wealth, coalesce(problems, '') AS problems FROM (SELECT DISTINCT state, wealth FROM na) LEFT JOIN (
    SELECT state, wealth, string_agg(token, ',' ORDER BY token) AS problems FROM cn WHERE NOT (v <= 10 AND dec = 0) AND NOT EXISTS (
      SELECT 1 FROM en WHERE en.state = cn.state AND en.wealth = cn.wealth
        AND CASE cn.dec WHEN 0 THEN CAST(round(en.v, 0) AS DECIMAL(38,10)) WHEN 1 THEN CAST(round(en.v, 1) AS DECIMAL(38,10)) ELSE CAST(round(en.v, 2) AS DECIMAL(38,10)) END = cn.v)
    GROUP BY state, wealth) USING (state, wealth)""", NARRATED + r""",
  cn AS (SELECT DISTINCT state, wealth, token, CAST(replace(token, ',', '') AS DECIMAL(38,10)) AS v, CASE WHEN contains(token, '.') THEN length(token) - instr(token, '.') ELSE 0 END AS dec
    FROM (SELECT state, wealth, unnest(regexp_extract_all(text, '(?:^|[^\p{L}\p{N}_.])([0-9][0-9,]*(?:\.[0-9]+)?)', 1)) AS token FROM na)),
  en AS (SELECT DISTINCT state, wealth, CAST(replace(token, ',', '') AS DECIMAL(38,10)) AS v
    FROM (SELECT state, wealth, unnest(regexp_extract_all(text, '(?:^|[^\p{L}\p{N}_.])([0-9][0-9,]*(?:\.[0-9]+)?)', 1)) AS token FROM st))"""))
def q5(spark, sf):
    rows = metric(spark, sf).dropna(subset=["weighted_pct"])
    shown = F.round(F.col("weighted_pct").cast("decimal(38,10)"), 1).cast("string")
    evidence = rows.select("state", "wealth", F.concat("label", F.lit(": "), Q.shown_pct("weighted_pct"), F.lit(" (n="), Q.thousands("n_valid"), F.lit(")")).alias("text"))
    text = F.concat(
        F.lit("About "), shown, F.when(F.col("state") % 5 == 0, "7% work").otherwise("% work"), F.lit(", n = "),
        F.when(F.col("state") % 5 == 1, Q.thousands(F.col("n_valid") + 11)).otherwise(Q.thousands("n_valid")), F.lit(", about 3 of 10."))
    out = Q.unverified_numbers(rows.select("state", "wealth", text.alias("text")), evidence, ["state", "wealth"])
    return out.withColumn("problems", F.array_join("problems", ","))


ADHOC = "SELECT state, residence, count(*) AS n, CAST(sum(weight) AS BIGINT) AS weight_total FROM {t} WHERE residence = 2 GROUP BY state, residence"


@check("Q6_adhoc_select", sql(ADHOC.format(t="r")))
def q6(spark, sf):
    text = ADHOC.format(t="respondents").replace("residence = 2", "residence = :which")
    return run_select(spark, text, {"respondents": respondents(spark, sf, "state", "residence")}, {"which": 2})


LIMITED = "SELECT state, education, wealth, age, count(*) AS n FROM {t} GROUP BY state, education, wealth, age ORDER BY n DESC, state, education, wealth, age"


@check("Q6_adhoc_limited", sql(LIMITED.format(t="r") + " LIMIT 200"))
def q6l(spark, sf):
    df = respondents(spark, sf, "state", "education", "wealth", "age")
    return run_select(spark, LIMITED.format(t="respondents") + ";", {"respondents": df}, limit=200)
