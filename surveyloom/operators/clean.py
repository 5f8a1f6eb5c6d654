"""Raw codes to valid answers, weights, age bands and derived indicators."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.numeric import Columnish, _c
from ..spec import Survey, Variable

AGE_LOW, AGE_HIGH, AGE_WIDTH = 15, 49, 5
AGE_CODES = tuple(range(1, 8))
AGE_LABELS = {
    i: f"{AGE_LOW + AGE_WIDTH * (i - 1)}-{AGE_LOW + AGE_WIDTH * i - 1}" for i in AGE_CODES
}


def clean(raw: DataFrame, variables: Iterable[Variable]) -> DataFrame:
    """Same rows; every value that is not an answer becomes NULL, per variable."""
    replaced = {
        v.name: F.when(v.is_valid(), F.col(v.name)) for v in variables if v.has_rule and v.kind != "weight"
    }
    return raw.withColumns(replaced)


def cleaning_log(raw: DataFrame, variables: Iterable[Variable]) -> DataFrame:
    """(variable, code, reason, n) for every value `clean` turns into NULL.

    Only the offending values are exploded, so a clean row adds nothing to the
    shuffle, and counts are combined before it.
    """
    rules = [v for v in variables if v.has_rule and v.kind != "weight"]
    found = F.array_compact(
        F.array(*[
            F.when(~v.is_valid(), F.struct(F.lit(v.name).alias("variable"), F.col(v.name).cast("long").alias("code")))
            for v in rules
        ])
    )
    counts = (
        raw.select(F.explode(found).alias("hit"))
        .groupBy(F.col("hit.variable").alias("variable"), F.col("hit.code").alias("code"))
        .agg(F.count(F.lit(1)).alias("n"))
    )
    return counts.select("variable", "code", _reason(rules).alias("reason"), "n")


def _reason(rules: list[Variable]) -> Column:
    """The codebook meaning of a special code, else which kind of rule failed."""
    reason = F.when(F.lit(False), F.lit(None).cast("string"))
    for v in rules:
        for code, text in v.special.items():
            reason = reason.when((F.col("variable") == v.name) & (F.col("code") == code), F.lit(text))
    ranged = [v.name for v in rules if v.low is not None]
    if ranged:
        reason = reason.when(F.col("variable").isin(*ranged), F.lit("out of range"))
    return reason.otherwise(F.lit("not a valid code"))


def with_scaled_weight(df: DataFrame, survey: Survey, name: str = "w") -> DataFrame:
    """Adds the weight on its natural scale; the integer column stays for summing."""
    return df.withColumn(name, F.col(survey.weight) / F.lit(survey.weight_scale))


def age_band(age: Columnish) -> Column:
    """Code 1..7 of the left-closed five-year band; NULL outside 15-49."""
    a = _c(age)
    return F.when(a.between(AGE_LOW, AGE_HIGH), F.floor((a - AGE_LOW) / AGE_WIDTH).cast("int") + 1)


def age_label(code: Columnish) -> Column:
    c = _c(code)
    start = F.lit(AGE_LOW) + (c - 1) * AGE_WIDTH
    return F.concat(start.cast("string"), F.lit("-"), (start + (AGE_WIDTH - 1)).cast("string"))


def with_age_group(df: DataFrame, age: str, name: str = "age_group") -> DataFrame:
    return df.withColumn(name, age_band(age))


def with_indicators(df: DataFrame, survey: Survey, names=None) -> DataFrame:
    """Adds the derived 0/1/NULL columns; unused ones are pruned from the plan."""
    chosen = names or list(survey.indicators)
    return df.withColumns({n: survey.indicators[n].column() for n in chosen})


def analytic_sample(df: DataFrame, required: Iterable[str]) -> DataFrame:
    """Rows with a value in every required column. Decided per calculation, never globally."""
    return df.dropna(subset=list(required))
