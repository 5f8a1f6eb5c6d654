"""Sentences generated from result tables, and the check that a text's numbers are backed by evidence."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.flags import OK
from ..functions.numeric import Columnish, _c, rounded
from ..sources.tables import cut
from .aggregate import keys

# Fixed value: a number in running text (not inside a word or after a point).
NUMBER = r"(?<![\p{L}\p{N}_.])([0-9][0-9,]*(?:\.[0-9]+)?)"


def thousands(n: Columnish) -> Column:
    return F.format_number(_c(n), 0)


def shown_pct(pct: Columnish) -> Column:
    return F.coalesce(F.concat(rounded(pct).cast("string"), F.lit("%")), F.lit("suppressed (too few cases)"))


def value_statements(rows: DataFrame, by, title: Columnish, population: Columnish) -> DataFrame:
    """One sentence per ungrouped metric row, and one more when respondents were left out."""
    by = keys(by)
    first = F.concat(
        shown_pct("weighted_pct"), F.lit(" of "), _c(population), F.lit(": "), _c(title), F.lit(" (weighted; n = "),
        thousands("n_valid"), F.lit(" women with a valid answer, "), thousands("n_yes_unweighted"),
        F.lit(" of them 'yes')."),
    )
    excluded = F.concat(
        thousands(F.col("n_in_population") - F.col("n_valid")), F.lit(" of the "), thousands("n_in_population"),
        F.lit(" women in this population have no valid answer (not asked or missing) and are excluded."),
    )
    lines = F.array_compact(F.array(first, F.when(F.col("n_valid") < F.col("n_in_population"), excluded)))
    return rows.select(*by, F.posexplode(lines).alias("line", "statement"))


def group_statements(rows: DataFrame, by, label: str, max_groups: int = 6) -> DataFrame:
    """Per result: all groups if at most six have a value, else the three highest and lowest; then the flagged ones.

    rows(by..., label, weighted_pct, n_valid, reliability). Only rows that will
    be named are gathered: at most six from the top, three from the bottom and
    eight flagged. The result table is written once because each part reads it.
    Starts a job.
    """
    by = keys(by)
    rows = cut(rows.select(*by, label, "weighted_pct", "n_valid", "reliability"), "rows")
    spread = Window.partitionBy(*by)
    shown = rows.filter(F.col("weighted_pct").isNotNull())
    ordered = [F.desc("weighted_pct"), F.asc(label)]
    item = F.concat(F.col(label), F.lit(" "), shown_pct("weighted_pct"), F.lit(" (n="), thousands("n_valid"), F.lit(")"))
    listed = F.concat(F.col(label), F.lit(": "), shown_pct("weighted_pct"), F.lit(" (n="), thousands("n_valid"), F.lit(")"))
    totals = shown.groupBy(*by).agg(F.count(F.lit(1)).alias("total"))
    down = shown.withColumn("p", F.row_number().over(spread.orderBy(*ordered))).filter(F.col("p") <= max_groups)
    up = shown.withColumn("p", F.row_number().over(spread.orderBy(F.asc("weighted_pct"), F.desc(label)))).filter(F.col("p") <= 3)

    def joined(column, upto, backwards=False):
        picked = F.array_sort(F.collect_list(F.when(F.col("p") <= upto, F.struct((-F.col("p") if backwards else F.col("p")).alias("p"), column.alias("t")))))
        return F.array_join(F.transform(picked, lambda x: x["t"]), "; ")

    top = down.groupBy(*by).agg(joined(item, 3).alias("top"), joined(listed, max_groups).alias("all"))
    bottom = up.groupBy(*by).agg(joined(item, 3, backwards=True).alias("bottom"))
    both = totals.join(top, by).join(bottom, by)
    many = F.col("total") > max_groups
    lines = both.select(*by, F.posexplode(
        F.when(many, F.array(F.concat(F.lit("Highest: "), "top"), F.concat(F.lit("Lowest: "), "bottom"))).otherwise(F.array("all"))
    ).alias("line", "statement"))

    flagged = rows.filter(F.col("reliability") != OK)
    named = F.concat(F.col(label), F.lit(" ("), F.col("reliability"), F.lit(")"))
    first = flagged.withColumn("p", F.row_number().over(spread.orderBy(label))).filter(F.col("p") <= 8)
    counts = flagged.groupBy(*by).agg(F.count(F.lit(1)).alias("n"))
    warned = counts.join(first.groupBy(*by).agg(joined(named, 8).alias("names")), by).select(
        *by, F.lit(2).alias("line"),
        F.concat(F.col("n").cast("string"), F.lit(" group(s) have small samples and are suppressed or flagged: "), "names").alias("statement"),
    )
    return lines.unionByName(warned)


def count_statements(rows: DataFrame, by, population: Columnish) -> DataFrame:
    text = F.concat(
        thousands("n_unweighted"), F.lit(" respondents match: "), _c(population), F.lit(". After weighting, they represent "),
        shown_pct("weighted_pct_of_all"), F.lit(" of all respondents in the survey."),
    )
    return rows.select(*keys(by), text.alias("statement"))


def ranking_statements(ranked: DataFrame, label: str, indicators: list[str], top: int = 5) -> DataFrame:
    """Two sentences about a ranking: its first places, and the indicators of the first place. Reads at most `top` rows."""
    rows = ranked.filter(F.col("rank") <= top)
    item = F.concat(
        F.lit("#"), F.col("rank").cast("string"), F.lit(" "), F.col(label), F.lit(" score "),
        F.col("deprivation_score").cast("string"), F.lit(" (n="), thousands("n_in_population"), F.lit(")"),
    )
    parts = F.concat_ws(", ", *[
        F.concat(F.lit(i.replace("_", " ") + " "), F.col(f"pct_{i}").cast("string"), F.lit("%")) for i in indicators
    ])
    packed = rows.agg(
        F.count(F.lit(1)).alias("n"), F.array_sort(F.collect_list(F.struct("rank", item.alias("t")))).alias("items"),
        F.min_by(F.concat(F.col(label), F.lit(": "), parts, F.lit(".")), "rank").alias("best"),
    )
    lines = F.array(
        F.concat(
            F.lit("Top "), F.col("n").cast("string"),
            F.lit(" by deprivation score (higher = more women lacking the indicators): "),
            F.array_join(F.transform("items", lambda x: x["t"]), "; "),
        ),
        F.col("best"),
    )
    return packed.filter(F.col("n") > 0).select(F.posexplode(lines).alias("line", "statement"))


def reach_statements(profiles: DataFrame, by, description: Columnish = "indicator") -> DataFrame:
    """One sentence per population listing the reach channels with a value, highest first."""
    by = keys(by)
    usable = profiles.filter((F.col("kind") == "reach") & F.col("pct").isNotNull())
    text = F.concat(F.lower(_c(description)), F.lit(" "), shown_pct("pct"), F.lit(" (n="), thousands("n_valid"), F.lit(")"))
    packed = usable.groupBy(*by).agg(
        F.array_sort(F.collect_list(F.struct((-F.col("pct")).alias("o"), F.col("indicator"), text.alias("t")))).alias("c")
    )
    return packed.select(*by, F.concat(
        F.lit("Channel reach in this population: "), F.array_join(F.transform("c", lambda x: x["t"]), "; "), F.lit(".")
    ).alias("statement"))


# ---- number grounding --------------------------------------------------------------
def numbers(df: DataFrame, by, text: str) -> DataFrame:
    """Distinct numbers of each text: (by..., token, decimals, digits), digits without point and leading zeros, of any length."""
    by = keys(by)
    found = df.select(*by, F.explode(F.regexp_extract_all(text, F.lit(NUMBER), F.lit(1))).alias("token")).distinct()
    plain = F.replace(F.col("token"), F.lit(","), F.lit(""))
    point = F.instr(plain, ".")
    decimals = F.when(point > 0, F.length(plain) - point).otherwise(0)
    return found.select(*by, "token", decimals.alias("decimals"), _trimmed(F.replace(plain, F.lit("."), F.lit(""))).alias("digits"))


def _trimmed(digits: Column) -> Column:
    return F.regexp_replace(digits, "^0+(?=[0-9])", "")


def _one_more(digits: Column) -> Column:
    """Digits counted up by one: trailing nines turn to zeros and the digit before them grows."""
    nines = F.length(F.regexp_extract(digits, "9*$", 0))
    head = F.left(digits, F.length(digits) - nines)
    grown = F.when(head == "", F.lit("1")).otherwise(F.concat(F.left(head, F.length(head) - 1), (F.right(head, F.lit(1)).cast("int") + 1).cast("string")))
    return F.concat(grown, F.repeat(F.lit("0"), nines))


def _rounded_digits(digits: Column, decimals: Column, to: Column) -> Column:
    """The digits of a number rounded half up to `to` decimals, exact at any length."""
    whole = F.lpad(digits, F.greatest(F.length(digits), decimals + 1), F.lit("0"))
    kept = F.left(whole, F.length(whole) - (decimals - to))
    up = F.substring(whole, F.length(kept) + 1, F.lit(1)) >= "5"
    cut_off = F.when(up, _one_more(kept)).otherwise(kept)
    return _trimmed(F.when(to >= decimals, F.concat(whole, F.repeat(F.lit("0"), to - decimals))).otherwise(cut_off))


def unverified_numbers(narratives: DataFrame, evidence: DataFrame, by, text: str = "text") -> DataFrame:
    """(by..., problems): numbers of the narrative that no evidence number rounds to, sorted as text.

    Whole numbers up to ten are ignored. Evidence is rounded once per number of
    decimals its narrative uses, so the comparison is an equality anti-join on
    digit strings, which holds numbers of any length.
    """
    by = keys(by)
    small = (F.col("decimals") == 0) & ((F.length("digits") == 1) | (F.col("digits") == "10"))
    claimed = numbers(narratives, by, text).filter(~small)
    backed = numbers(evidence, by, text).select(*by, F.col("digits").alias("e"), F.col("decimals").alias("ed")).distinct()
    wanted = claimed.select(*by, "decimals").distinct()
    rounded_evidence = backed.join(wanted, by).select(*by, "decimals", _rounded_digits(F.col("e"), F.col("ed"), F.col("decimals")).alias("digits")).distinct()
    bad = claimed.join(rounded_evidence, [*by, "decimals", "digits"], "left_anti")
    problems = bad.groupBy(*by).agg(F.array_sort(F.collect_set("token")).alias("problems"))
    empty = F.array().cast("array<string>")
    return narratives.select(*by).distinct().join(problems, by, "left").withColumn("problems", F.coalesce("problems", empty))
