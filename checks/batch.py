"""The whole set of batch analyses over the shared tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from surveyloom.operators.clean import age_band
from surveyloom.plans.batch import Roles, run_batch
from surveyloom.sources.tables import scratch_path

from .registry import check
from .respondents import SURVEY, pct, raw_respondents, rnd, sql

ROLES = Roles.of(SURVEY, state="state", residence="residence", wealth="wealth", level="education", years="years",
                 value="working", age="age", recorded_age_group="recorded", age_group="age_group")


def run(spark, sf):
    raw = raw_respondents(spark, sf, "state", "residence", "wealth", "education", "years", "working", "age")
    return run_batch(raw.withColumn("recorded", age_band("age")), SURVEY, ROLES, scratch_path(spark, "batch"), 1000)


@check("S5_batch_analyses", sql(f"""
  SELECT 'state' AS kind, state AS code, count(*) AS n, {rnd(pct('sum(weight * working)', 'sum(weight)'))} AS pct FROM r WHERE working IS NOT NULL GROUP BY state
  UNION ALL SELECT 'education', education, count(*), {rnd(pct('sum(weight * working)', 'sum(weight)'))} FROM r
    WHERE working IS NOT NULL AND education IS NOT NULL GROUP BY education"""))
def batch(spark, sf):
    """Writes every table of the six analyses, then reads two of the reports back."""
    paths = run(spark, sf)
    read = lambda name, schema: spark.read.schema(schema).option("header", True).csv(paths[name])
    states = read("analysis_1/06_state_employment", "state int, n long, pct double, label string, flag string")
    levels = read("analysis_1/07_employment_by_education", "education int, n long, pct double, label string")
    return states.select(F.lit("state").alias("kind"), F.col("state").alias("code"), "n", "pct").unionByName(
        levels.select(F.lit("education").alias("kind"), F.col("education").alias("code"), "n", "pct"))
