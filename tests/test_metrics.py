"""Hand-computed results, error handling and properties of the metric operators."""

from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from surveyloom.curated import SURVEY
from surveyloom.functions.expressions import filter_column, group_filters, outcome_column
from surveyloom.operators import aggregate as A
from surveyloom.operators import ranking as G
from surveyloom.operators import standardize as T
from surveyloom.operators.adhoc import run_select
from surveyloom.spec import SpecError

S = replace(SURVEY, weight_scale=1)


def test_denominator_leaves_out_missing_answers(mini):
    row = A.weighted_percentage(mini, S, {"indicator": "owns_mobile_phone"}).first()
    assert (row.n_valid, row.weighted_numerator, row.weighted_denominator) == (5, 4.0, 9.0)
    assert row.weighted_pct is None and row.reliability == "suppressed (n<25)" and row.n_in_population == 6


def test_filter_and_grouping(mini):
    rows = A.weighted_percentage(mini, S, {"indicator": "currently_working"}, [{"variable": "v024", "value": 9}], ["v025"])
    got = {r.v025: (r.n_valid, r.weighted_numerator, r.weighted_denominator) for r in rows.collect()}
    assert got == {1: (2, 1.0, 3.0), 2: (0, 0.0, 0.0)}


def test_codes_outcome_equals_indicator(mini):
    a = A.weighted_percentage(mini, S, {"variable": "v169a", "codes": [1]}).first()
    b = A.weighted_percentage(mini, S, {"indicator": "owns_mobile_phone"}).first()
    assert a == b


def test_count_and_weighted_share(mini):
    row = A.count_respondents(mini, S, [{"variable": "v012", "op": "between", "value": [18, 24]}]).first()
    assert (row.n_unweighted, row.weighted_pct_of_all) == (3, 40.0)
    by_state = A.count_respondents(mini, S, None, ["v024"]).collect()
    assert sorted((r.v024, r.n_unweighted) for r in by_state) == [(9, 3), (10, 3)]


def test_empty_population(mini):
    never = [{"variable": "v024", "value": 99}]
    assert A.weighted_percentage(mini, S, {"indicator": "currently_working"}, never).count() == 1
    assert A.weighted_percentage(mini, S, {"indicator": "currently_working"}, never, ["v025"]).count() == 0


@pytest.mark.parametrize("call", [
    lambda: outcome_column(S, {"indicator": "made_up"}),
    lambda: outcome_column(S, {"variable": "v106", "codes": []}),
    lambda: outcome_column(S, {"variable": "nope", "codes": [1]}),
    lambda: outcome_column(S, {}),
    lambda: filter_column(S, [{"variable": "v024; drop table x", "value": 1}]),
    lambda: filter_column(S, [{"variable": "v024", "op": "like", "value": 1}]),
    lambda: S.columns(["password"]),
    lambda: S.deprivations(["owns_mobile_phone"]),
])
def test_bad_descriptions_are_rejected(spark, call):
    with pytest.raises(SpecError):
        call()


def test_text_value_is_never_code(mini):
    assert mini.filter(filter_column(S, [{"variable": "v024", "value": "10 OR 1=1"}])).count() == 0
    assert mini.filter(filter_column(S, [{"variable": "v024", "value": "10"}])).count() == 3


@pytest.mark.parametrize("text", ["DELETE FROM women", "SELECT 1; SELECT 2", "WITH x AS (SELECT 1) INSERT INTO y SELECT * FROM x", "DROP TABLE women", "SET spark.x = 1", "SELEC 1"])
def test_only_reading_sql(spark, mini, text):
    with pytest.raises(SpecError):
        run_select(spark, text, {"women": mini})


def test_adhoc_sql(spark, mini):
    wide = spark.range(1000)
    assert run_select(spark, "SELECT * FROM many", {"many": wide}).count() == 1000
    assert [r.id for r in run_select(spark, "SELECT id FROM many ORDER BY id DESC", {"many": wide}, limit=2).collect()] == [999, 998]
    assert run_select(spark, "SELECT replace('update', 'up', 'x') AS t, (SELECT 1) AS one").first().t == "xdate"
    assert not spark.catalog.tableExists("many")
    assert run_select(spark, "SELECT count(*) AS n FROM women WHERE v024 = :s;", {"women": mini}, {"s": 9}).first().n == 3


def test_distribution_sums_to_100_and_ignores_partitioning(spark):
    df = spark.range(1000).select(
        (F.col("id") % 7).cast("int").alias("g"), (F.col("id") * 13 % 5).cast("int").alias("c"), (F.col("id") % 11 + 1).alias("weight"))
    once = A.weighted_distribution(df, "c", "g")
    assert all(abs(r.t - 100) < 1e-9 for r in once.groupBy("g").agg(F.sum("pct").alias("t")).collect())
    again = A.weighted_distribution(df.repartition(9, "c"), "c", "g")
    assert sorted(once.collect()) == sorted(again.collect())


def test_equal_weights_make_weighting_irrelevant(spark):
    df = spark.range(500).select((F.col("id") % 3).alias("g"), (F.col("id") * 7 % 10 < 4).cast("int").alias("y"), F.lit(5).alias("weight"))
    a = {r.g: r.pct for r in A.weighted_rate(df, "g", "y").collect()}
    b = {r.g: r.pct_unweighted for r in A.unweighted_rate(df, "g", "y").collect()}
    assert a == pytest.approx(b)


def test_own_standard_gives_the_crude_rate(spark):
    df = spark.range(3000).select(
        F.lit(1).alias("g"), (F.col("id") % 7 + 1).cast("int").alias("age_group"), (F.col("id") * 31 % 9 < 4).cast("int").alias("y"),
        (F.col("id") % 4 + 1).alias("weight"))
    row = T.standardized_rates(df, "g", "y").first()
    assert row.standardized_pct == pytest.approx(row.crude_pct)
    given = T.standardized_rates(df, "g", "y", T.standard_age_shares(df)).first()
    assert given.standardized_pct == pytest.approx(row.standardized_pct)


def test_missing_age_cell_is_not_computed(spark):
    df = spark.range(600).select(
        F.when(F.col("id") < 300, 1).otherwise(2).alias("g"), (F.col("id") % 7 + 1).cast("int").alias("age_group"),
        (F.col("id") % 2).cast("int").alias("y"), F.lit(1).alias("weight")).filter("g = 1 OR age_group <> 4")
    got = {r.g: (r.standardized_pct is None, r.standardized_reliability) for r in T.standardized_rates(df, "g", "y").collect()}
    assert got[2] == (True, "not computed (an age group has no cases)") and got[1][0] is False


def test_rank_ties(spark):
    from surveyloom.functions.ranks import with_rank

    df = spark.createDataFrame([("a", 10.0), ("b", 20.001), ("c", 20.004), ("d", None), ("e", 5.0)], "k string, x double")
    got = {r.k: r.r for r in with_rank(df, "x", "r", digits=2).collect()}
    assert got == {"a": 3, "b": 1, "c": 1, "d": None, "e": 4}
    assert {r.k: r.r for r in with_rank(df, "x", "r", "rank_avg", digits=2).collect()}["b"] == 1.5


def test_group_filters_round_trip(mini):
    f = group_filters({"v024": 9, "v025": 1}, ["v024", "v025"])
    assert mini.filter(filter_column(S, f)).count() == 2


def test_hot_group_is_ranked_like_any_other(spark):
    """A third of all rows in one group, and every score tied: order falls back to the group keys."""
    df = spark.range(9000).select(
        F.when(F.col("id") % 3 == 0, 7).otherwise((F.col("id") % 20).cast("int")).cast("int").alias("v024"),
        F.lit(1).alias("v005"), F.lit(1).alias("no_education"))
    ranked = G.rank_underserved(df, S, ["v024"], ["no_education"], min_n=1, top_k=None)
    assert [r.v024 for r in ranked.orderBy("rank").collect()] == sorted(r.v024 for r in ranked.collect())
    assert ranked.count() == df.select("v024").distinct().count()
