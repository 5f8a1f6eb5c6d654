"""The survey shape over the shared tables: one lineitem row is one respondent.

The attributes live in dimension tables reached over unique keys, so a left
join never changes the number of respondents and only the dimensions a query
asks for are joined. No side is hinted: Spark broadcasts a dimension when its
size allows and otherwise shuffles, with skewed keys split by AQE.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from surveyloom.operators.clean import AGE_LABELS, age_band, clean, with_indicators
from surveyloom.spec import Indicator, Survey, Variable, survey

WEALTH = {1: "AUTOMOBILE", 2: "BUILDING", 3: "FURNITURE", 4: "HOUSEHOLD", 5: "MACHINERY"}
RESIDENCE = {1: "urban", 2: "rural"}
EDUCATION = {0: "no education", 1: "primary", 2: "secondary", 3: "higher"}
STATES = {i: f"NATION_{i}" for i in range(25)}

VARIABLES = [
    Variable("state", "state", topic="geography", labels=STATES),
    Variable("district", "district", kind="id", topic="geography"),
    Variable("residence", "type of place of residence", topic="geography", labels=RESIDENCE),
    Variable("age", "current age", kind="numeric", topic="demographics", low=15, high=49),
    Variable("education", "highest level", topic="education", labels=EDUCATION, special={4: "not specified"}),
    Variable("years", "years in level", kind="numeric", topic="education", low=1, high=5, special={7: "inconsistent"}),
    Variable("wealth", "wealth class", topic="wealth", labels=WEALTH),
    Variable("working", "currently working", topic="employment", labels={0: "no", 1: "yes"}),
    Variable("discount", "discount rate", kind="design"),
    Variable("tax", "tax rate", kind="design"),
    Variable("weight", "sample weight", kind="weight"),
    Variable("age_group", "age in five-year groups", topic="demographics", labels=AGE_LABELS),
]
RAW_CODED = ["education", "age", "years", "working"]

INDICATORS = [
    Indicator("d1", "deprivation", "Has no education", "education = 0", ("education",),
              lambda: F.col("education") == 0),
    Indicator("d2", "deprivation", "Low discount", "discount < 0.03", ("discount",),
              lambda: F.col("discount") < 0.03),
    Indicator("d3", "deprivation", "Low tax and discount", "tax < 0.02 and discount < 0.05", ("tax", "discount"),
              lambda: (F.col("tax") < 0.02) & (F.col("discount") < 0.05)),
    Indicator("d4", "deprivation", "One year", "years = 1", ("years",), lambda: F.col("years") == 1),
    Indicator("d5", "deprivation", "Rural", "residence = 2", ("residence",), lambda: F.col("residence") == 2),
    Indicator("r1", "reach", "Currently working", "working = 1", ("working",), lambda: F.col("working") == 1),
    Indicator("r2", "reach", "High tax", "tax >= 0.04", ("tax",), lambda: F.col("tax") >= 0.04),
    Indicator("r3", "reach", "High discount", "discount >= 0.06", ("discount",), lambda: F.col("discount") >= 0.06),
]

SURVEY: Survey = survey(
    VARIABLES, INDICATORS, weight="weight", default_deprivations=("d1", "d2", "d3", "d4", "d5"),
    profile_deprivations=("d1", "d3", "d5"), channel_indicators=("r2", "r3"),
)
V = SURVEY.variables

# which dimension each attribute needs, nearest first
_NEEDS = {
    "district": ("orders",), "education": ("orders",),
    "state": ("orders", "customer"), "wealth": ("orders", "customer"), "segment": ("orders", "customer"),
    "age": ("part",), "age_group": ("part",),
    "d1": ("orders",),
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def raw_respondents(spark: SparkSession, sf_dir: str, *columns: str) -> DataFrame:
    """Raw codes of the asked-for attributes (all of them when none are named)."""
    wanted = list(dict.fromkeys(columns)) or [
        "id", "state", "district", "residence", "education", "wealth", "age", "working", "years", "discount", "tax"
    ]
    needs = {d for c in wanted for d in _NEEDS.get(c, ())}
    df = table(spark, sf_dir, "lineitem")
    if "orders" in needs:
        orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderpriority")
        df = df.join(orders, F.col("l_orderkey") == F.col("o_orderkey"), "left")
    if "customer" in needs:
        customer = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey", "c_mktsegment")
        df = df.join(customer, F.col("o_custkey") == F.col("c_custkey"), "left")
    if "part" in needs:
        part = table(spark, sf_dir, "part").select("p_partkey", "p_size")
        df = df.join(part, F.col("l_partkey") == F.col("p_partkey"), "left")

    wealth = F.lit(None).cast("int")
    for code, name in WEALTH.items():
        wealth = F.when(F.col("c_mktsegment") == name, code).otherwise(wealth)
    roles = {
        "id": F.col("l_orderkey"),
        "line": F.col("l_linenumber"),
        "state": F.col("c_nationkey"),
        "district": F.col("o_custkey"),
        "residence": F.when(F.col("l_linestatus") == "F", 1).otherwise(2),
        "education": F.substring("o_orderpriority", 1, 1).cast("int") - 1,
        "wealth": wealth,
        "segment": F.col("c_mktsegment"),
        "age": F.col("p_size"),
        "working": F.when(F.col("l_returnflag") == "A", 1).when(F.col("l_returnflag") == "R", 0),
        "years": F.col("l_linenumber"),
        "discount": F.col("l_discount"),
        "tax": F.col("l_tax"),
    }
    return df.select(F.col("l_quantity").cast("long").alias("weight"), *[roles[c].alias(c) for c in wanted])


def respondents(spark: SparkSession, sf_dir: str, *columns: str) -> DataFrame:
    """Cleaned respondents with the asked-for attributes, age group and indicators."""
    all_columns = [
        "id", "state", "district", "residence", "education", "wealth", "age", "age_group", "working", "years",
        "discount", "tax", *SURVEY.indicators,
    ]
    wanted = list(dict.fromkeys(columns)) or all_columns
    raw_names = []
    for c in wanted:
        if c in SURVEY.indicators:
            raw_names += SURVEY.indicators[c].sources
        else:
            raw_names.append("age" if c == "age_group" else c)
    raw = raw_respondents(spark, sf_dir, *raw_names)
    df = clean(raw, [V[c] for c in raw.columns if c in V])
    if "age_group" in wanted:
        df = df.withColumn("age_group", age_band("age"))
    names = [c for c in wanted if c in SURVEY.indicators]
    if names:
        df = with_indicators(df, SURVEY, names)
    return df.select("weight", *wanted)


# The same shape written independently in SQL.
R = """
raw AS (
  SELECT l_orderkey AS id, CAST(l_quantity AS BIGINT) AS weight, c_nationkey AS state, o_custkey AS district,
    CASE l_linestatus WHEN 'F' THEN 1 ELSE 2 END AS residence,
    CAST(substr(o_orderpriority,1,1) AS INT) - 1 AS education,
    CASE c_mktsegment WHEN 'AUTOMOBILE' THEN 1 WHEN 'BUILDING' THEN 2 WHEN 'FURNITURE' THEN 3
                      WHEN 'HOUSEHOLD' THEN 4 WHEN 'MACHINERY' THEN 5 END AS wealth,
    p_size AS age,
    CASE l_returnflag WHEN 'A' THEN 1 WHEN 'R' THEN 0 END AS working,
    l_linenumber AS years, l_discount AS discount, l_tax AS tax
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey
  JOIN customer ON o_custkey = c_custkey JOIN part ON l_partkey = p_partkey),
cl AS (
  SELECT id, weight, state, district, residence, wealth, working, discount, tax,
    CASE WHEN education BETWEEN 0 AND 3 THEN education END AS education,
    CASE WHEN age BETWEEN 15 AND 49 THEN age END AS age,
    CASE WHEN years BETWEEN 1 AND 5 THEN years END AS years
  FROM raw),
r AS (
  SELECT *, CASE age // 5 WHEN 3 THEN 1 WHEN 4 THEN 2 WHEN 5 THEN 3 WHEN 6 THEN 4 WHEN 7 THEN 5
                          WHEN 8 THEN 6 WHEN 9 THEN 7 END AS age_group,
    CASE WHEN education IS NULL THEN NULL WHEN education = 0 THEN 1 ELSE 0 END AS d1,
    CASE WHEN discount < 0.03 THEN 1 ELSE 0 END AS d2,
    CASE WHEN tax < 0.02 AND discount < 0.05 THEN 1 ELSE 0 END AS d3,
    CASE WHEN years IS NULL THEN NULL WHEN years = 1 THEN 1 ELSE 0 END AS d4,
    CASE WHEN residence = 2 THEN 1 ELSE 0 END AS d5,
    CASE WHEN working IS NULL THEN NULL WHEN working = 1 THEN 1 ELSE 0 END AS r1,
    CASE WHEN tax >= 0.04 THEN 1 ELSE 0 END AS r2,
    CASE WHEN discount >= 0.06 THEN 1 ELSE 0 END AS r3
  FROM cl)
"""


def sql(body: str, more: str = "") -> str:
    """A full statement: the respondents view, optional further CTEs, then the body."""
    ctes = R + ("," + more if more.strip() else "")
    return f"WITH {ctes} {body}"


FLAG = ("CASE WHEN {n} < 25 THEN 'suppressed (n<25)' WHEN {n} < 50 THEN 'unreliable (n 25-49)' ELSE 'ok' END")


def flag(n: str) -> str:
    return FLAG.format(n=n)


def pct(num: str, den: str) -> str:
    return f"(CAST(100 AS DOUBLE) * CAST({num} AS DOUBLE) / NULLIF(CAST({den} AS DOUBLE), 0))"


def rnd(x: str, d: int = 2) -> str:
    return f"CAST(round(CAST({x} AS DECIMAL(38,10)), {d}) AS DOUBLE)"


def values(labels: dict, code: str = "code", label: str = "label") -> str:
    rows = ", ".join(f"({c}, '{t}')" for c, t in labels.items())
    return f"(SELECT * FROM (VALUES {rows}) AS t({code}, {label}))"
