"""Read-only SQL over named tables."""

from __future__ import annotations

from pyspark.errors import ParseException
from pyspark.sql import DataFrame, SparkSession

from ..spec import SpecError

_PLANS = "org.apache.spark.sql.catalyst.plans.logical."


def _changes_something(spark: SparkSession, plan) -> bool:
    """Whether any node of a parsed plan is a command or an unresolved statement."""
    kinds = [spark._jvm.java.lang.Class.forName(_PLANS + k) for k in ("Command", "ParsedStatement")]
    if any(k.isInstance(plan) for k in kinds):
        return True
    below = plan.children()
    return any(_changes_something(spark, below.apply(i)) for i in range(below.size()))


def run_select(spark: SparkSession, query: str, tables: dict[str, DataFrame] | None = None, params=None, limit: int | None = None) -> DataFrame:
    """The rows of one query, values bound as parameters; `limit` keeps the first rows of the query's order.

    Spark's own parser decides what the text is: anything but a single query is
    refused before it is analyzed. The tables are visible to this query only.
    """
    try:
        plan = spark._jsparkSession.sessionState().sqlParser().parsePlan(query)
    except ParseException as error:
        raise SpecError(f"not a single query: {error.getMessage()}") from error
    if _changes_something(spark, plan):
        raise SpecError("the text is a statement, not a query")
    named = tables or {}
    if taken := [n for n in named if spark.catalog.tableExists(n)]:
        raise SpecError(f"tables of these names exist already: {taken}")
    try:
        for name, df in named.items():
            df.createTempView(name)
        rows = spark.sql(query.strip().rstrip(";"), args=params)
        return rows if limit is None else rows.limit(limit)
    finally:
        for name in named:
            spark.catalog.dropTempView(name)
