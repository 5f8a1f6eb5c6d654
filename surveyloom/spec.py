"""What a survey looks like: variables, indicators and the checked column access.

A `Survey` is the allow-list that every query description is validated
against; the operators only ever build `Column`s from names found in it.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column
from pyspark.sql import functions as F

KINDS = ("id", "design", "weight", "categorical", "numeric")


class SpecError(ValueError):
    """A query description names something the survey does not define."""


@dataclass(frozen=True)
class Variable:
    """One curated variable and the rule that says which raw values are answers.

    codes:   the valid codes (categorical)
    low/high: the inclusive valid range (numeric)
    labels:  {code: label}; also the valid set when `codes` is None
    special: {code: meaning} of codes that exist in the raw data but are not answers
    """

    name: str
    label: str = ""
    kind: str = "categorical"
    topic: str = ""
    codes: tuple[int, ...] | None = None
    low: int | None = None
    high: int | None = None
    labels: dict[int, str] = field(default_factory=dict)
    special: dict[int, str] = field(default_factory=dict)
    note: str = ""

    def __post_init__(self):
        if self.kind not in KINDS:
            raise SpecError(f"{self.name}: unknown kind {self.kind!r}")

    @property
    def has_rule(self) -> bool:
        return self.kind in ("weight", "categorical", "numeric") and (
            self.kind == "weight" or self.low is not None or bool(self.valid_codes) or bool(self.special)
        )

    @property
    def valid_codes(self) -> tuple[int, ...]:
        if self.codes is not None:
            return self.codes
        return tuple(c for c in sorted(self.labels) if c not in self.special)

    @property
    def rule(self) -> str:
        if self.kind == "weight":
            return "weight must be > 0"
        if self.low is not None:
            return f"valid range {self.low}-{self.high}"
        return "valid codes from codebook"

    def is_valid(self, column: Column | None = None) -> Column:
        """TRUE where the raw value is an answer; NULL where the raw value is NULL."""
        c = F.col(self.name) if column is None else column
        if self.kind == "weight":
            return c > 0
        if self.low is not None:
            return c.between(self.low, self.high)
        if self.valid_codes:
            return c.isin(*self.valid_codes)
        if self.special:
            return ~c.isin(*self.special)
        return c.isNotNull()

    def meaning(self, code: int) -> str | None:
        return self.labels.get(code, self.special.get(code))


@dataclass(frozen=True)
class Indicator:
    """A derived 0/1/NULL column. `build` returns the three-valued condition."""

    name: str
    kind: str
    description: str
    rule: str
    sources: tuple[str, ...]
    build: Callable[[], Column]
    universe: str = "all respondents"

    def column(self) -> Column:
        """1 / 0 / NULL: SQL's own three-valued logic already gives NULL for NULL sources."""
        return self.build().cast("int").alias(self.name)


@dataclass(frozen=True)
class Survey:
    variables: dict[str, Variable]
    indicators: dict[str, Indicator]
    weight: str = "weight"
    weight_scale: int = 1
    age_group: str = "age_group"
    default_deprivations: tuple[str, ...] = ()
    profile_deprivations: tuple[str, ...] = ()  # of a population profile; empty: all deprivations
    channel_indicators: tuple[str, ...] = ()  # that stand for a channel; empty: all reach indicators
    extra_columns: tuple[str, ...] = ()

    @property
    def allowed(self) -> set[str]:
        return {*self.variables, *self.indicators, *self.extra_columns}

    def check(self, name: str) -> str:
        if name not in self.allowed:
            raise SpecError(f"unknown or disallowed column: {name!r}")
        return name

    def columns(self, names) -> list[str]:
        return [self.check(n) for n in (names or [])]

    def labels(self, name: str) -> dict[int, str]:
        variable = self.variables.get(name)
        return dict(variable.labels) if variable else {}

    def indicators_of(self, kind: str) -> list[str]:
        return [i.name for i in self.indicators.values() if i.kind == kind]

    def channels(self) -> list[str]:
        """The reach indicators that stand for a channel."""
        return list(self.channel_indicators or self.indicators_of("reach"))

    def profile(self) -> list[str]:
        """The indicators of a population profile: deprivations, then channels."""
        return [*(self.profile_deprivations or self.indicators_of("deprivation")), *self.channels()]

    def deprivations(self, names=None) -> list[str]:
        """The chosen deprivation indicators; anything else is an error."""
        chosen = list(names or self.default_deprivations)
        for n in chosen:
            found = self.indicators.get(n)
            if found is None or found.kind != "deprivation":
                raise SpecError(f"{n!r} is not a deprivation indicator")
        return chosen


def survey(variables, indicators, **options) -> Survey:
    return Survey({v.name: v for v in variables}, {i.name: i for i in indicators}, **options)
