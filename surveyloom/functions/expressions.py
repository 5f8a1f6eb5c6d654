"""Query descriptions (outcome and filter dicts) compiled to Columns.

Values always enter the plan as literals, never as SQL text.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..spec import SpecError, Survey

COMPARISONS = {
    "=": lambda c, v: c == v,
    "!=": lambda c, v: c != v,
    ">": lambda c, v: c > v,
    ">=": lambda c, v: c >= v,
    "<": lambda c, v: c < v,
    "<=": lambda c, v: c <= v,
}


def outcome_column(survey: Survey, outcome: dict) -> Column:
    """1 / 0 / NULL for `{"indicator": name}` or `{"variable": name, "codes": [...]}`."""
    if "indicator" in outcome:
        name = outcome["indicator"]
        if name not in survey.indicators:
            raise SpecError(f"unknown indicator {name!r}; known: {sorted(survey.indicators)}")
        return F.col(name)
    if "variable" in outcome and "codes" in outcome:
        column = F.col(survey.check(outcome["variable"]))
        codes = [int(c) for c in outcome["codes"]]
        if not codes:
            raise SpecError("outcome codes must not be empty")
        return column.isin(*codes).cast("int")  # NULL IN (...) is NULL, so missing stays missing
    raise SpecError("an outcome needs 'indicator', or 'variable' and 'codes'")


def _literal(survey: Survey, name: str, value) -> Column:
    """Text given for a coded column becomes its number, or NULL (matching nothing) if it is not one."""
    variable = survey.variables.get(name)
    coded = name in survey.indicators or (variable is not None and variable.kind in ("categorical", "numeric"))
    literal = F.lit(value)
    return literal.try_cast("bigint") if coded and isinstance(value, str) else literal


def filter_column(survey: Survey, filters) -> Column:
    """AND of `{"variable", "op", "value"}` conditions; TRUE when there are none."""
    parts = []
    for f in filters or []:
        name = survey.check(f["variable"])
        column, op, value = F.col(name), str(f.get("op", "=")).lower(), f["value"]
        if op in ("in", "not in"):
            values = list(value) if isinstance(value, (list, tuple, set)) else [value]
            inside = column.isin(*[_literal(survey, name, v) for v in values])
            parts.append(inside if op == "in" else ~inside)
        elif op == "between":
            low, high = value
            parts.append(column.between(_literal(survey, name, low), _literal(survey, name, high)))
        elif op in COMPARISONS:
            parts.append(COMPARISONS[op](column, _literal(survey, name, value)))
        else:
            raise SpecError(f"unsupported operator {op!r}")
    return reduce(lambda a, b: a & b, parts) if parts else F.lit(True)


def group_filters(row: dict, group_by) -> list[dict]:
    """A ranked group's key values as equality filters for a follow-up query."""
    return [{"variable": g, "op": "=", "value": row[g]} for g in group_by]
