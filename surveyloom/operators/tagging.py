"""Rule-based tagging of a column of questions: intent, measure, population, grouping."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.numeric import Columnish, _c

# The word patterns that decide a question's intent.
OUTREACH_WORDS = r"\b(ngos?|non-?profits?|charit\w*|organi[sz]ations?|outreach|channels?|partners?|programs?|programmes?|campaigns?|reach (them|this|these|her|women)|market\w*|communicat\w*)\b"
UNDERSERVED_WORDS = r"\b(underserved|under-served|most deprived|deprived|disadvantaged|marginali[sz]ed|vulnerable|left behind|prioriti[sz]e|priority|neediest|most in need)\b"
DOC_WORDS = r"\b(what does|what is|meaning|mean|define|definition|categor\w*|codebook|which variables?|what variables?|relevant variables?|how (is|was|are) .* (measured|defined|coded)|methodolog\w*|weights?|limitations?|missing)\b"
PERCENT_WORDS = r"(%|\bpercent\w*|\bshare\b|\bproportion\b|\brate\b|\bfraction\b)"
COUNT_WORDS = r"\bhow many\b|\bnumber of (respondents|women)\b|\bcount\b"
NEGATION = r"\b(no|not|don'?t|do not|does not|doesn'?t|without|never|lack\w*|cannot|can'?t|unable)\b"
ASKING_FOR_AN_NGO = r"\b(should|could|would|can|must) an? (ngo|organi[sz]ation)\b"

# Pattern, what it measures, what it measures when negated; first match wins.
OUTCOME_RULES = [
    (r"mobile|cell ?phone|phone", {"indicator": "owns_mobile_phone"}, {"indicator": "no_mobile_phone"}),
    (r"bank", {"indicator": "has_bank_account"}, {"indicator": "no_bank_account"}),
    (r"internet|online", {"indicator": "ever_used_internet"}, {"indicator": "never_used_internet"}),
    (r"insur", {"variable": "v481", "codes": [1]}, {"indicator": "no_health_insurance"}),
    (r"an(a)?emi", {"indicator": "any_anemia"}, {"indicator": "any_anemia"}),
    (r"asha|anganwadi|health worker|frontline|community health", {"indicator": "met_frontline_worker"}, {"indicator": "no_frontline_worker_contact"}),
    (r"\b(work\w*|employ\w*|job)", {"indicator": "currently_working"}, {"indicator": "not_working"}),
    (r"\b(tv|television)\b", {"indicator": "watches_tv"}, {"variable": "v159", "codes": [0]}),
    (r"radio", {"indicator": "listens_radio"}, {"variable": "v158", "codes": [0]}),
    (r"newspaper|magazine", {"indicator": "reads_newspaper"}, {"variable": "v157", "codes": [0]}),
    (r"\bmedia\b", {"indicator": "no_media_exposure"}, {"indicator": "no_media_exposure"}),
    (r"\b(illiterate|literacy|literate|read)\b", {"variable": "v155", "codes": [1, 2]}, {"indicator": "cannot_read"}),
    (r"higher education|college|university", {"variable": "v106", "codes": [3]}, {"variable": "v106", "codes": [0, 1, 2]}),
    (r"secondary", {"variable": "v106", "codes": [2]}, None),
    (r"primary", {"variable": "v106", "codes": [1]}, None),
    (r"no education|uneducated|never (been to|attended) school|no schooling", {"indicator": "no_education"}, {"indicator": "no_education"}),
]

# Pattern and the column it groups by.
GROUP_BY_RULES = [
    (r"\bby state|across states|each state|state-wise|statewise|which states?\b", "v024"),
    (r"\bby district|across districts|which districts?\b", "sdist"),
    (r"urban (and|vs\.?|versus|or) rural|rural (and|vs\.?|versus|or) urban|by residence", "v025"),
    (r"\bby wealth|wealth quintiles?|by quintile|rich(er)? (and|vs) poor", "v190"),
    (r"\bby age|age groups?\b", "v013"),
    (r"\bby education|education levels?\b", "v106"),
    (r"\bby caste|caste|scheduled (caste|tribe)", "s116"),
    (r"\bby religion\b", "v130"),
]
# Words of wealth groups, and an age range.
WEALTH_WORDS = [("poorest", 1), ("poorer", 2), ("richest", 5), ("richer", 4)]
AGE_RANGE = r"([0-9]{2})\s*(?:-|–|—|to|and)\s*([0-9]{2})"


def age_range(text: Columnish) -> Column:
    """struct<low, high> of the first two joined two-digit numbers, if they are ages in order; else NULL."""
    low = F.regexp_extract(_c(text), AGE_RANGE, 1).try_cast("int")
    high = F.regexp_extract(_c(text), AGE_RANGE, 2).try_cast("int")
    return F.when((low >= 15) & (low <= high) & (high <= 49), F.struct(low.alias("low"), high.alias("high")))


LABEL_CHARACTERS = 4_000_000  # of the names that one automaton holds


def places(texts: DataFrame, labels: DataFrame, key: str, text: str = "text") -> DataFrame:
    """(key, places): labels occurring as whole words, longest first, none inside a longer one. Starts jobs that read the labels.

    `labels(code, label)`. One automaton over the names is sent to the texts,
    which are read once where they lie; only names found leave them. Names
    beyond LABEL_CHARACTERS make further automata, each with a pass of its own.
    """
    name = F.lower(F.trim("label"))
    known = labels.select("code", name.alias("name")).filter(F.length("name") >= 3)
    lowered = texts.select(key, F.lower(F.col(text)).alias("_text"))
    schema = f"`{key}` {dict(lowered.dtypes)[key]}, name string"
    parts = math.ceil((known.agg(F.sum(F.length("name"))).first()[0] or 0) / LABEL_CHARACTERS)
    found = texts.sparkSession.createDataFrame([], schema)
    for i in range(parts):
        own = known.filter(F.pmod(F.xxhash64("name"), F.lit(parts)) == i).select("name").distinct()
        sent = texts.sparkSession.sparkContext.broadcast([r.name for r in own.collect()])
        found = found.union(lowered.mapInArrow(lambda batches, sent=sent: _named(batches, key, sent.value), schema))
    matched = found.join(known, "name").groupBy(key).agg(F.array_sort(F.collect_set(F.struct((-F.length("name")).alias("order"), "code", "name"))).alias("m"))

    def covered(m, i):
        return F.exists(
            F.slice(F.col("m"), F.lit(1), i), lambda longer: F.contains(longer["name"], m["name"])
        )

    kept = F.filter("m", lambda m, i: ~covered(m, i))
    return matched.select(key, F.transform(kept, lambda m: F.struct(m["code"].alias("code"), m["name"].alias("name"))).alias("places"))


def _named(batches, key: str, names: list[str]):
    """(key, name) of the names that stand in a text with no letter a to z right before or after them."""
    import ahocorasick
    import pyarrow as pa

    if not names:
        return
    automaton, letters = ahocorasick.Automaton(), frozenset("abcdefghijklmnopqrstuvwxyz")
    for n in names:
        automaton.add_word(n, n)
    automaton.make_automaton()
    for batch in batches:
        at, out = [], []
        for row, text in enumerate(batch.column("_text").to_pylist()):
            hits = set()
            for last, n in automaton.iter(text or ""):
                first = last + 1 - len(n)
                if (first == 0 or text[first - 1] not in letters) and (last + 1 == len(text) or text[last + 1] not in letters):
                    hits.add(n)
            at += [row] * len(hits)
            out += sorted(hits)
        yield pa.RecordBatch.from_arrays([batch.column(key).take(pa.array(at, pa.int64())), pa.array(out, pa.string())], [key, "name"])


def _outcome(spec: dict | None) -> Column:
    spec = spec or {}
    codes = spec.get("codes")
    return F.struct(
        F.lit(spec.get("indicator")).cast("string").alias("indicator"),
        F.lit(spec.get("variable")).cast("string").alias("variable"),
        (F.array(*[F.lit(c) for c in codes]) if codes else F.lit(None)).cast("array<int>").alias("codes"),
    )


def measured(text: Columnish) -> Column:
    """struct<indicator, variable, codes> of the first outcome rule that applies, negated where the text is."""
    t = _c(text)
    negated = t.rlike(NEGATION)
    picked = F.lit(None)
    for pattern, positive, negative in reversed(OUTCOME_RULES):
        choice = F.when(negated, _outcome(negative)).otherwise(_outcome(positive)) if negative else _outcome(positive)
        picked = F.when(t.rlike(pattern), choice).otherwise(picked)
    return picked


def group_columns(text: Columnish) -> Column:
    t = _c(text)
    return F.array_compact(F.array(*[F.when(t.rlike(p), F.lit(c)) for p, c in GROUP_BY_RULES]))


def tag_questions(questions: DataFrame, text: str = "text", mentions: str | None = None, states: str | None = None,
                  districts: str | None = None, has_context: bool = False) -> DataFrame:
    """Adds the plan of each question: intent, needs_data, needs_outreach, outcome, group_by and the population.

    `mentions` is a boolean column (the text names a known variable); `states`
    and `districts` are array columns of place structs as made by `places`.
    """
    t = F.lower(F.col(text))
    none = F.array().cast("array<struct<code:int,name:string>>")
    df = questions.withColumns({
        "_t": t,
        "_states": F.coalesce(F.col(states), none) if states else none,
        "_districts": F.coalesce(F.col(districts), none) if districts else none,
    })
    t = F.col("_t")
    flags = {
        "_outreach": F.regexp_replace(t, ASKING_FOR_AN_NGO, "").rlike(OUTREACH_WORDS),
        "_underserved": t.rlike(UNDERSERVED_WORDS),
        "_doc": t.rlike(DOC_WORDS) | (F.coalesce(F.col(mentions), F.lit(False)) if mentions else F.lit(False)),
        "_percent": t.rlike(PERCENT_WORDS),
        "_count": t.rlike(COUNT_WORDS),
        "outcome": measured(t),
        "group_by": group_columns(t),
        "age": age_range(t),
    }
    df = df.withColumns(flags)
    state_names = F.transform("_states", lambda s: s["name"])
    residence = F.when(
        ~F.array_contains("group_by", "v025"), F.when(t.rlike(r"\brural\b"), 2).when(t.rlike(r"\burban\b"), 1)
    )
    wealth = F.lit(None).cast("int")
    for word, code in reversed(WEALTH_WORDS):
        wealth = F.when(t.rlike(rf"\b{word}\b"), code).otherwise(wealth)
    df = df.withColumns({
        "states": F.transform("_states", lambda s: s["code"]),
        "districts": F.transform(F.filter("_districts", lambda d: ~F.array_contains(state_names, d["name"])), lambda d: d["code"]),
        "residence": residence,
        "wealth": F.when(~F.array_contains("group_by", "v190"), wealth),
    })
    filtered = (
        F.col("age").isNotNull() | (F.size("states") > 0) | (F.size("districts") > 0)
        | F.col("residence").isNotNull() | F.col("wealth").isNotNull()
    )
    intent = (
        F.when(F.col("_underserved"), "underserved")
        .when(F.col("_outreach") & ~(F.col("_percent") | F.col("_count")), "outreach_only")
        .when(F.col("_count") & ~F.col("_percent"), "count")
        .when(F.col("_percent") & F.col("outcome").isNotNull(), "percentage")
        .when(F.col("_doc"), "documentation")
        .when(F.col("outcome").isNotNull(), "percentage")
        .otherwise("unknown")
    )
    df = df.withColumns({"_intent": intent, "_placed": filtered | F.lit(has_context)})
    nowhere = (F.col("_intent") == "outreach_only") & ~F.col("_placed")
    return df.withColumns({
        "intent": F.when(nowhere, "underserved").otherwise(F.col("_intent")),
        "needs_data": (F.col("_intent") != "outreach_only") | ~F.col("_placed"),
        "needs_outreach": F.col("_outreach") | (F.col("_intent") == "outreach_only"),
    }).drop(*[c for c in ("_t", "_states", "_districts", "_outreach", "_underserved", "_doc", "_percent", "_count", "_intent", "_placed")])
