"""The curated women's survey: 36 variables, 18 derived indicators and their rules."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .operators.clean import AGE_LABELS
from .sources.codebook import value_label_table
from .spec import Indicator, Survey, Variable, survey

# Codes, meanings and ranges of the curated variables.
YES_NO = {0: "no", 1: "yes"}
QUINTILES = {1: "poorest", 2: "poorer", 3: "middle", 4: "richer", 5: "richest"}
HOW_OFTEN = {0: "not at all", 1: "less than once a week", 2: "at least once a week", 3: "almost every day"}

VARIABLES = [
    Variable("caseid", "case identification", "id", "identifier", note="Unique respondent ID (text)."),
    Variable("v001", "cluster number", "design", "survey design"),
    Variable("v021", "primary sampling unit", "design", "survey design", note="Needed for standard errors."),
    Variable("v022", "sample strata for sampling errors", "design", "survey design"),
    Variable("v005", "women's individual sample weight (6 decimals)", "weight", "survey design",
             note="National women's weight, 6 implied decimals."),
    Variable("sweight", "sample weight (6 decimals) (state level)", "weight", "survey design",
             note="State-level weight, 6 implied decimals."),
    Variable("ssmod", "household selected for the state module", topic="survey design", labels=YES_NO,
             note="Employment, phone, bank and internet questions exist only where this is 1."),
    Variable("v024", "state", topic="geography"),
    Variable("sdist", "district", topic="geography", note="Many districts have small samples."),
    Variable("v025", "type of place of residence", topic="geography", labels={1: "urban", 2: "rural"}),
    Variable("v012", "respondent's current age", "numeric", "demographics", low=15, high=49),
    Variable("v013", "age in 5-year groups", topic="demographics", labels=dict(AGE_LABELS)),
    Variable("v130", "religion", topic="demographics", labels={
        1: "hindu", 2: "muslim", 3: "christian", 4: "sikh", 5: "buddhist / neo-buddhist", 6: "jain", 7: "jewish",
        8: "parsi / zoroastrian", 9: "no religion", 96: "other"}, note="96 is a real answer and is kept."),
    Variable("s116", "belong to a scheduled caste, a scheduled tribe, other backward class", topic="demographics",
             labels={1: "schedule caste", 2: "schedule tribe", 3: "obc", 4: "none of them"}, special={8: "don't know"}),
    Variable("v501", "current marital status", topic="demographics", labels={
        0: "never in union", 1: "married", 2: "living with partner", 3: "widowed", 4: "divorced",
        5: "no longer living together/separated"}),
    Variable("v201", "total children ever born", "numeric", "demographics", low=0, high=20),
    Variable("v106", "highest educational level", topic="education",
             labels={0: "no education", 1: "primary", 2: "secondary", 3: "higher"}),
    Variable("v133", "education in single years", "numeric", "education", low=0, high=30, special={97: "inconsistent"}),
    Variable("v149", "educational attainment", topic="education", labels={
        0: "no education", 1: "incomplete primary", 2: "complete primary", 3: "incomplete secondary",
        4: "complete secondary", 5: "higher"}),
    Variable("v155", "literacy", topic="education", labels={
        0: "cannot read at all", 1: "able to read only parts of sentence", 2: "able to read whole sentence"},
        special={3: "no card with required language", 4: "blind/visually impaired"}),
    Variable("v190", "wealth index combined", topic="wealth", labels=QUINTILES, note="National wealth quintile."),
    Variable("s190s", "wealth index within state", topic="wealth", labels=QUINTILES),
    Variable("v714", "respondent currently working", topic="employment", labels=YES_NO),
    Variable("v731", "respondent worked in last 12 months", topic="employment", labels={
        0: "no", 1: "in the past year", 2: "currently working", 3: "have a job, but on leave last 7 days"}),
    Variable("v717", "respondent's occupation (grouped)", topic="employment", labels={
        0: "not working", 1: "professional / technical / managerial", 3: "clerical", 4: "sales",
        5: "services / household and domestic", 6: "agricultural", 7: "skilled and unskilled manual", 9: "other"},
        special={98: "don't know"}),
    Variable("v741", "type of earnings from respondent's work", topic="employment", labels={
        0: "not paid", 1: "cash only", 2: "cash and in-kind", 3: "in-kind only"}, note="Asked only of women who work."),
    Variable("v157", "frequency of reading newspaper or magazine", topic="media and access", labels=HOW_OFTEN),
    Variable("v158", "frequency of listening to radio", topic="media and access", labels=HOW_OFTEN),
    Variable("v159", "frequency of watching television", topic="media and access", labels=HOW_OFTEN),
    Variable("v169a", "owns a mobile telephone", topic="media and access", labels=YES_NO),
    Variable("v170", "has an account in a bank or other financial institution", topic="media and access", labels=YES_NO),
    Variable("v171a", "use of internet", topic="media and access", labels={
        0: "never", 1: "yes, last 12 months", 2: "yes, before last 12 months", 3: "yes, can't establish when"}),
    Variable("v481", "covered by health insurance", topic="health", labels=YES_NO),
    Variable("s361", "met with an anganwadi worker, asha or other community health worker in last 3 mo", topic="health",
             labels=YES_NO),
    Variable("v457", "anemia level", topic="health", labels={1: "severe", 2: "moderate", 3: "mild", 4: "not anemic"},
             note="Only where hemoglobin was measured."),
    Variable("v119", "household has: electricity", topic="household", labels=YES_NO, special={7: "not a dejure resident"}),
]

MODULE = "state-module women only (ssmod = 1)"
WORKER = "an Anganwadi worker, ASHA or other community health worker (last 3 months)"


def _equals(name: str, *codes: int):
    return lambda: F.col(name).isin(*codes)


def _at_least_one(name: str):
    return lambda: F.col(name) >= 1


def _no_media() -> Column:
    """SQL AND: one medium used means 0 even if another answer is missing; otherwise a missing answer means unknown."""
    return (F.col("v157") == 0) & (F.col("v158") == 0) & (F.col("v159") == 0)


def _deprivation(name, description, rule, sources, build, universe="all women"):
    return Indicator(name, "deprivation", description, rule, sources, build, universe)


def _reach(name, description, rule, sources, build, universe="all women"):
    return Indicator(name, "reach", description, rule, sources, build, universe)


# Names and definitions of the derived indicators.
INDICATORS = [
    _deprivation("no_education", "Has no education", "v106 = 0", ("v106",), _equals("v106", 0)),
    _deprivation("cannot_read", "Cannot read at all", "v155 = 0", ("v155",), _equals("v155", 0), "all women assessed"),
    _deprivation("no_media_exposure", "No exposure to newspaper, radio or TV", "v157 = 0 AND v158 = 0 AND v159 = 0",
                 ("v157", "v158", "v159"), _no_media),
    _deprivation("no_health_insurance", "Not covered by health insurance", "v481 = 0", ("v481",), _equals("v481", 0)),
    _deprivation("no_frontline_worker_contact", f"Did not meet {WORKER}", "s361 = 0", ("s361",), _equals("s361", 0)),
    _deprivation("any_anemia", "Has any anemia (severe, moderate or mild)", "v457 in (1, 2, 3)", ("v457",),
                 _equals("v457", 1, 2, 3), "women with a hemoglobin measurement"),
    _deprivation("no_mobile_phone", "Does not own a mobile phone", "v169a = 0", ("v169a",), _equals("v169a", 0), MODULE),
    _deprivation("no_bank_account", "Has no bank or financial institution account", "v170 = 0", ("v170",), _equals("v170", 0), MODULE),
    _deprivation("never_used_internet", "Has never used the internet", "v171a = 0", ("v171a",), _equals("v171a", 0), MODULE),
    _deprivation("not_working", "Not currently working", "v714 = 0", ("v714",), _equals("v714", 0), MODULE),
    _reach("reads_newspaper", "Reads a newspaper or magazine at all", "v157 >= 1", ("v157",), _at_least_one("v157")),
    _reach("listens_radio", "Listens to the radio at all", "v158 >= 1", ("v158",), _at_least_one("v158")),
    _reach("watches_tv", "Watches television at all", "v159 >= 1", ("v159",), _at_least_one("v159")),
    _reach("owns_mobile_phone", "Owns a mobile phone", "v169a = 1", ("v169a",), _equals("v169a", 1), MODULE),
    _reach("ever_used_internet", "Has ever used the internet", "v171a in (1, 2, 3)", ("v171a",), _equals("v171a", 1, 2, 3), MODULE),
    _reach("met_frontline_worker", f"Met {WORKER}", "s361 = 1", ("s361",), _equals("s361", 1)),
    _reach("has_bank_account", "Has a bank or financial institution account", "v170 = 1", ("v170",), _equals("v170", 1), MODULE),
    _reach("currently_working", "Currently working", "v714 = 1", ("v714",), _equals("v714", 1), MODULE),
]
# The indicators of scores, profiles and channels.
DEFAULT_DEPRIVATIONS = ("no_education", "cannot_read", "no_media_exposure", "no_health_insurance", "no_frontline_worker_contact")
PROFILE_DEPRIVATIONS = (*DEFAULT_DEPRIVATIONS, "any_anemia", "no_mobile_phone", "no_bank_account", "never_used_internet")
CHANNEL_INDICATORS = tuple(i.name for i in INDICATORS if i.kind == "reach" and i.name != "currently_working")
VALIDATED_MODULE = ("v714", "v169a", "v170", "v171a", "v731")
FINE_TO_COARSE_EDUCATION = {0: 0, 1: 1, 2: 1, 3: 2, 4: 2, 5: 3}

SURVEY: Survey = survey(
    VARIABLES, INDICATORS, weight="v005", weight_scale=1_000_000, age_group="v013",
    default_deprivations=DEFAULT_DEPRIVATIONS, profile_deprivations=PROFILE_DEPRIVATIONS, channel_indicators=CHANNEL_INDICATORS,
)


def with_codebook_labels(base: Survey, codebook: DataFrame) -> Survey:
    """The survey with value labels read from a codebook for variables that declare none (state, district).

    Collects only the labels of those variables, which are code lists.
    """
    unlabelled = [v.name for v in base.variables.values() if v.kind == "categorical" and not v.labels]
    rows = value_label_table(codebook.filter(F.col("variable_name").isin(*unlabelled))).collect()
    labels: dict[str, dict[int, str]] = {}
    for r in rows:
        labels.setdefault(r["variable"], {})[r["code"]] = r["label"]
    variables = {n: replace(v, labels=labels[n]) if n in labels else v for n, v in base.variables.items()}
    return replace(base, variables=variables)


def validation_rules(expected_rows: int | None = None) -> list:
    """The relationships between the curated variables that a build verifies."""
    from .operators.clean import age_band
    from .operators.quality import NoException, Proportional, RowCount, Unique, positive, present_iff, refines, same_value

    rules = [RowCount(expected_rows)] if expected_rows is not None else []
    return rules + [
        Unique(("caseid",), name="caseid is unique"),
        positive("v005", "sweight"),
        NoException("v013 is the 5-year group of v012", age_band("v012") != F.col("v013")),
        refines("v149", "v106", FINE_TO_COARSE_EDUCATION),
        NoException("v133 = 0 years when v106 = no education", (F.col("v106") == 0) & (F.col("v133") != 0)),
        *[present_iff(c, "ssmod") for c in VALIDATED_MODULE],
        Proportional("sweight", "v005", "v024", 2.5e-4, name="sweight = v005 x a constant within each state"),
        same_value("v021", "v001"),
    ]
