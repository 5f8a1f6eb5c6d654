"""The data-quality audit: missingness, codes, consistency, sensitivity, validation."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.numeric import percent, rounded, total_over
from ..sources.tables import cut
from ..spec import Variable
from .aggregate import code_list, joint_cells, keys, literal_rows
from .clean import AGE_CODES, AGE_LABELS, age_band

MATERIAL_DIFFERENCE = 2.0


def missingness(raw: DataFrame, variables: Iterable[Variable]) -> DataFrame:
    """Per variable: missing in the raw data, made missing by its rule, and valid. One aggregate."""
    vs = list(variables)
    counts = raw.agg(
        F.count(F.lit(1)).alias("_all"),
        *[F.count(v.name).alias(f"_p_{v.name}") for v in vs],
        *[F.count_if(v.is_valid()).alias(f"_v_{v.name}") for v in vs],
    )
    entries = [
        F.struct(
            F.lit(v.name).alias("variable"),
            F.lit(v.label).alias("label"),
            F.col("_all").alias("n_total"),
            (F.col("_all") - F.col(f"_p_{v.name}")).alias("missing_raw"),
            (F.col(f"_p_{v.name}") - F.col(f"_v_{v.name}")).alias("invalid_or_special"),
            F.col(f"_v_{v.name}").alias("valid"),
            percent(f"_v_{v.name}", "_all").alias("pct_valid"),
        )
        for v in vs
    ]
    return counts.select(F.inline(F.array(*entries)))


def code_audit(raw: DataFrame, variables: Iterable[Variable]) -> DataFrame:
    """Values outside the rules with counts, special codes the range rules exclude, and clean variables.

    Only offending values are exploded and counted; the rest is joins of those
    few counts, written once, with the rules. Starts a job.
    """
    vs = list(variables)
    hits = F.array_compact(F.array(*[
        F.when(~v.is_valid(), F.struct(F.lit(v.name).alias("variable"), F.col(v.name).cast("long").alias("code")))
        for v in vs
    ]))
    found = raw.select(F.explode(hits).alias("h")).groupBy("h.variable", "h.code").agg(F.count(F.lit(1)).alias("n"))
    found = cut(found.select("variable", "code", "n"), "invalid-codes")

    meaning = F.when(F.lit(False), F.lit(None).cast("string"))
    for v in vs:
        for code, text in {**v.labels, **v.special}.items():
            meaning = meaning.when((F.col("variable") == v.name) & (F.col("code") == code), F.lit(text))
    rules = literal_rows(raw, [(v.name, v.rule) for v in vs], ["variable", "rule"])

    parts = [
        found.join(F.broadcast(rules), "variable").select(
            "variable", "rule", F.lit("found in data").alias("source"), "code",
            meaning.otherwise("(not in codebook)").alias("codebook_meaning"), F.col("n").alias("count"),
        ),
        rules.join(found, "variable", "left_anti").select(
            "variable", "rule", F.lit("found in data").alias("source"), F.lit(None).cast("long").alias("code"),
            F.lit("no invalid values found").alias("codebook_meaning"), F.lit(0).cast("long").alias("count"),
        ),
    ]
    excluded = [
        (v.name, v.rule, int(code), text)
        for v in vs if v.low is not None
        for code, text in v.special.items() if not v.low <= code <= v.high
    ]
    if excluded:
        special = literal_rows(raw, excluded, ["variable", "rule", "code", "codebook_meaning"])
        parts.append(
            special.withColumn("code", F.col("code").cast("long")).join(found, ["variable", "code"], "left").select(
                "variable", "rule", F.lit("special code defined in codebook").alias("source"), "code",
                "codebook_meaning", F.coalesce("n", F.lit(0)).alias("count"),
            )
        )
    return reduce(DataFrame.unionByName, parts)


def sample_sizes(df: DataFrame, dimensions: dict[str, dict[int, str]], answer: str) -> DataFrame:
    """All respondents and every listed group of several dimensions: n, answered, % answered."""
    cells = joint_cells(df, list(dimensions), [F.count(F.lit(1)).alias("n"), F.count(answer).alias("a")])
    places = [F.struct(F.lit("all").alias("dimension"), F.lit(0).alias("code"))] + [
        F.struct(F.lit(d).alias("dimension"), F.col(d).cast("int").alias("code")) for d in dimensions
    ]
    sums = cells.select(F.explode(F.array(*places)).alias("p"), "n", "a").groupBy("p.dimension", "p.code").agg(
        F.sum("n").alias("n"), F.sum("a").alias("a")
    )
    listed = literal_rows(
        df,
        [("all", 0, "all")] + [(d, int(c), str(t)) for d, labels in dimensions.items() for c, t in labels.items()],
        ["dimension", "code", "group"],
    )
    return listed.join(sums, ["dimension", "code"], "left").select(
        "dimension", "group", F.coalesce("n", F.lit(0)).alias("n"), F.coalesce("a", F.lit(0)).alias("n_answered"),
        percent("a", "n").alias("pct_answered"),
    )


def small_cell_summary(tables: dict[str, tuple[DataFrame, Sequence[str]]]) -> DataFrame:
    """How many cells of each result table carry each reliability flag."""
    parts = [
        table.select(F.lit(name).alias("table"), F.lit(c).alias("flag_column"), F.col(c).alias("flag"))
        for name, (table, columns) in tables.items() for c in columns
    ]
    counts = reduce(DataFrame.unionByName, parts).groupBy("table", "flag_column", "flag").agg(
        F.count(F.lit(1)).alias("n_cells")
    )
    return counts.withColumn("n_cells_total", total_over("n_cells", ["table", "flag_column"]))


def crosstab(df: DataFrame, rows: str, columns: str, labels: dict[int, str]) -> DataFrame:
    """Counts of two codings of the same thing, zeros included, with the off-diagonal count per row."""
    counted = df.dropna(subset=[rows, columns]).groupBy(rows).agg(*[
        F.count_if(F.col(columns) == c).alias(t) for c, t in labels.items()
    ])
    filled = code_list(df, rows, labels, "row_label").join(counted, rows, "left").na.fill(0, list(labels.values()))
    total = reduce(lambda a, b: a + b, [F.col(t) for t in labels.values()])
    same = reduce(lambda a, b: a + b, [F.when(F.col(rows) == c, F.col(t)).otherwise(0) for c, t in labels.items()])
    return filled.withColumn("mismatches_in_row", total - same).drop("row_label")


def age_checks(raw: DataFrame, age: str, recorded: str) -> DataFrame:
    """(check, value): missing, out of range, valid, bounds, and agreement with the recorded age group."""
    a, derived = F.col(age), age_band(age)
    both = derived.isNotNull() & F.col(recorded).isNotNull()
    valid = F.when(a.between(15, 49), a)
    checks = {
        "n_total": F.count(F.lit(1)),
        "age_missing": F.count_if(a.isNull()),
        "age_out_of_range": F.count_if(~a.between(15, 49)),
        "age_valid": F.count(valid),
        "age_min": F.min(valid),
        "age_max": F.max(valid),
        "age_group_missing": F.count_if(F.col(recorded).isNull()),
        "age_group_matches": F.count_if(both & (derived == F.col(recorded))),
        "age_group_differs": F.count_if(both & (derived != F.col(recorded))),
    }
    row = raw.agg(*[x.cast("long").alias(name) for name, x in checks.items()])
    return row.select(F.inline(F.array(*[
        F.struct(F.lit(name).alias("check"), F.col(name).alias("value")) for name in checks
    ])))


def weighted_vs_unweighted(
    df: DataFrame, level: str, level_codes: Sequence[int], top_level: int, group: str, value: str,
    dimensions: Sequence[str], weight: str = "weight",
) -> DataFrame:
    """Every headline estimate weighted and unweighted, and whether weighting matters (>= 2 points).

    All estimates come from the joint cells of the dimensions, so respondents
    are read once. `group_code` is NULL for the estimate over everybody.
    """
    dims = list(dict.fromkeys([level, group, *dimensions]))
    v, w = F.col(value), F.col(weight)
    cells = joint_cells(df, dims, [
        F.count(F.lit(1)).alias("n"), F.sum(w).alias("w"), F.count(v).alias("nv"), F.coalesce(F.sum(v), F.lit(0)).alias("y"),
        F.coalesce(F.sum(F.when(v.isNotNull(), w)), F.lit(0)).alias("wv"), F.coalesce(F.sum(w * v), F.lit(0)).alias("wy"),
    ])
    zero = F.lit(0).cast("long")

    def entry(name, code, n_reported, n, yes, wn, wyes):
        return F.struct(
            F.lit(name).alias("estimate"), code.cast("int").alias("group_code"), n_reported.cast("long").alias("nr"),
            n.alias("n"), yes.cast("long").alias("yes"), wn.alias("wn"), wyes.cast("long").alias("wyes"),
        )

    n, wn = F.col("n"), F.col("w")
    entries = []
    for c in level_codes:
        here = F.col(level) == c
        entries.append(F.when(F.col(level).isNotNull(), entry(
            "% at this level", F.lit(c), F.when(here, n).otherwise(zero), n,
            F.when(here, n).otherwise(zero), wn, F.when(here, wn).otherwise(zero))))
    top = F.col(level) == top_level
    entries.append(F.when(F.col(level).isNotNull() & F.col(group).isNotNull(), entry(
        f"% at the top level, by {group}", F.col(group), n, n, F.when(top, n).otherwise(zero), wn,
        F.when(top, wn).otherwise(zero))))
    answered = (F.col("nv"), F.col("nv"), F.col("y"), F.col("wv"), F.col("wy"))
    entries.append(entry(f"% {value}", F.lit(None), *answered))
    entries += [
        F.when(F.col(d).isNotNull() & (F.col("nv") > 0), entry(f"% {value}, by {d}", F.col(d), *answered))
        for d in dimensions
    ]
    sums = cells.select(F.inline(F.array_compact(F.array(*entries)))).groupBy("estimate", "group_code").agg(*[
        F.sum(c).alias(c) for c in ("nr", "n", "yes", "wn", "wyes")
    ])
    out = sums.withColumn("unweighted_pct", percent("yes", "n")).withColumn("weighted_pct", percent("wyes", "wn"))
    difference = F.col("weighted_pct") - F.col("unweighted_pct")
    return out.select(
        "estimate", "group_code", F.col("nr").alias("n_unweighted"), "unweighted_pct", "weighted_pct",
        difference.alias("weighted_minus_unweighted"),
        (F.abs(difference) >= MATERIAL_DIFFERENCE).alias("material_difference"),
    )


# ---- sensitivity to small groups ----------------------------------------------
def without_small_groups(
    df: DataFrame, group: str, group_labels: dict[int, str], level: str, value: str, small_n: int = 500,
    weight: str = "weight",
) -> DataFrame:
    """The rate at each level with and without respondents of small groups; the note names those groups.

    The (group, level) cells are written once because the note reads them too. Starts a job.
    """
    cells = df.dropna(subset=[value, level, group]).groupBy(group, level).agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.col(weight) * F.col(value)).alias("wy"), F.sum(weight).alias("w")
    )
    sized = cut(cells, "cells").withColumn("_small", total_over("n", [group]) < small_n)
    kept = lambda c: F.sum(F.when(~F.col("_small"), F.col(c)))
    names = F.array_sort(F.collect_set(F.when(F.col("_small"), F.col(group))))
    sums = sized.groupBy(level).agg(
        percent(F.sum("wy"), F.sum("w")).alias("all_groups"), percent(kept("wy"), kept("w")).alias("excluding_small_groups")
    )
    lookup = F.create_map(*[x for c, t in group_labels.items() for x in (F.lit(c), F.lit(t))])
    note = sized.agg(
        F.concat(
            F.size(names).cast("string"), F.lit(" groups excluded: "),
            F.array_join(F.transform(names, lambda c: F.element_at(lookup, c.cast("int"))), "; "),
        )
    ).scalar()
    difference = F.col("excluding_small_groups") - F.col("all_groups")
    return sums.select(
        level, "all_groups", "excluding_small_groups", difference.alias("difference"),
        (F.abs(difference) >= MATERIAL_DIFFERENCE).alias("material_difference"), note.alias("note"),
    )


def correlation_sensitivity(correlations: DataFrame) -> DataFrame:
    """Per measure: correlation over all groups, without small groups, and their difference (three decimals)."""
    at = lambda like: F.max(F.when(F.col("groups_included").startswith(like), rounded("spearman", 3)))
    both = correlations.groupBy("measure").agg(at("all").alias("all_groups"), at("excluding").alias("excluding_small_groups"))
    weak = F.greatest(F.abs("all_groups"), F.abs("excluding_small_groups")) < 0.3
    return both.select(
        "measure", "all_groups", "excluding_small_groups",
        rounded(F.col("excluding_small_groups") - F.col("all_groups"), 3).alias("difference"),
        F.when(weak, "both |r| < 0.3 (weak)").otherwise("at least one |r| >= 0.3").alias("note"),
    )


def pattern_sensitivity(gaps: DataFrame, name: str, loose: int = 10, strict: int = 25) -> DataFrame:
    """How many groups are assessed, and differ, at the loose and at the strict age-cell minimum."""
    assessed = ~F.col("pattern").startswith("not assessed")
    differs = F.col("pattern").startswith("differs")
    enough = F.col("smallest_age_cell_n") >= strict
    listed = lambda c: F.array_join(F.array_sort(F.collect_list(F.when(c, F.col(name)))), "; ")
    row = gaps.filter(~F.col("is_national")).agg(
        F.count_if(assessed).alias("a0"), F.count_if(assessed & enough).alias("a1"),
        F.count_if(differs).alias("d0"), F.count_if(differs & enough).alias("d1"),
        F.concat(
            F.lit(f"differing at {loose}: "), listed(differs), F.lit(f" | differing at {strict}: "), listed(differs & enough)
        ).alias("note"),
    )
    entries = [
        F.struct(
            F.lit(item).alias("item"), F.col(a).alias("all_groups"), F.col(b).alias("excluding_small_groups"),
            (F.col(b) - F.col(a)).alias("difference"), F.col("note").alias("note"),
        )
        for item, a, b in (("number of groups assessed", "a0", "a1"), ("number of groups classified as differing", "d0", "d1"))
    ]
    return row.select(F.inline(F.array(*entries)))


# ---- validation rules ----------------------------------------------------------
@dataclass(frozen=True)
class RowCount:
    expected: int
    name: str = "row count"


@dataclass(frozen=True)
class Unique:
    columns: tuple[str, ...]
    name: str = "key is unique"


@dataclass(frozen=True)
class NoException:
    """Passes when no row meets `exception` (NULL counts as no exception)."""

    name: str
    exception: Column


@dataclass(frozen=True)
class Proportional:
    """`a` is a constant multiple of `b` within each group, up to a relative spread."""

    a: str
    b: str
    within: str
    tolerance: float
    name: str = "proportional weights"


def positive(*columns: str) -> NoException:
    bad = reduce(lambda x, y: x | y, [F.coalesce(F.col(c) <= 0, F.lit(True)) for c in columns])
    return NoException("weights are positive", bad)


def present_iff(column: str, flag: str) -> NoException:
    return NoException(
        f"{column} is present exactly when {flag} = 1",
        F.col(column).isNotNull() != F.coalesce(F.col(flag) == 1, F.lit(False)),
    )


def same_value(a: str, b: str) -> NoException:
    return NoException(f"{a} equals {b}", ~F.col(a).eqNullSafe(F.col(b)))


def refines(fine: str, coarse: str, mapping: dict[int, int]) -> NoException:
    """Each fine category belongs to the coarse category it is mapped to."""
    pairs = F.create_map(*[x for f, c in mapping.items() for x in (F.lit(f), F.lit(c))])
    return NoException(f"{fine} is a finer version of {coarse}", F.element_at(pairs, F.col(fine).cast("int")) != F.col(coarse))


def validate(df: DataFrame, rules: Sequence) -> DataFrame:
    """(check, detail, passed). Row-level rules share one aggregate; only keyed rules shuffle."""
    simple = [r for r in rules if isinstance(r, (RowCount, NoException))]
    parts = []
    if simple:
        row = df.agg(*[
            (F.count(F.lit(1)) if isinstance(r, RowCount) else F.count_if(r.exception)).alias(f"c{i}")
            for i, r in enumerate(simple)
        ])
        entries = []
        for i, r in enumerate(simple):
            c = F.col(f"c{i}")
            if isinstance(r, RowCount):
                detail = F.concat(c.cast("string"), F.lit(f" rows (expected {r.expected})"))
                passed = c == r.expected
            else:
                detail, passed = F.concat(c.cast("string"), F.lit(" exceptions")), c == 0
            entries.append(F.struct(F.lit(r.name).alias("check"), detail.alias("detail"), passed.alias("passed")))
        parts.append(row.select(F.inline(F.array(*entries))))
    for r in rules:
        if isinstance(r, Unique):
            per_key = df.groupBy(*r.columns).agg(F.count(F.lit(1)).alias("n"))
            one = per_key.agg(F.count(F.lit(1)).alias("keys"), F.count_if(F.col("n") > 1).alias("repeated"))
            detail = F.concat(F.col("keys").cast("string"), F.lit(" keys, "), F.col("repeated").cast("string"), F.lit(" repeated"))
            parts.append(one.select(F.lit(r.name).alias("check"), detail.alias("detail"), (F.col("repeated") == 0).alias("passed")))
        elif isinstance(r, Proportional):
            q = F.try_divide(F.col(r.a).cast("double"), F.col(r.b).cast("double"))
            spread = df.groupBy(r.within).agg((F.max(q) / F.min(q) - 1).alias("s")).agg(F.max("s").alias("s"))
            parts.append(spread.select(
                F.lit(r.name).alias("check"),
                F.concat(F.lit("largest relative spread "), F.format_number("s", 6)).alias("detail"),
                (F.col("s") <= r.tolerance).alias("passed"),
            ))
    return reduce(DataFrame.unionByName, parts)


def same_results(a: DataFrame, b: DataFrame, on, left: str, right: str, tolerance: float = 0.0) -> DataFrame:
    """Two result tables side by side; a row fails when it is missing on one side or differs by more than the tolerance."""
    on = keys(on)
    joined = a.select(*on, F.col(left).alias("_a")).join(b.select(*on, F.col(right).alias("_b")), on, "full")
    passed = F.coalesce(F.abs(F.col("_a") - F.col("_b")) <= tolerance, F.col("_a").isNull() & F.col("_b").isNull())
    return joined.select(*on, F.col("_a").alias("left_value"), F.col("_b").alias("right_value"), passed.alias("passed"))


AGE_GROUP_LABELS = {a: AGE_LABELS[a] for a in AGE_CODES}
