"""Secrets in texts, with weak candidates linked to their complements. JVM expressions only.

Base kinds stand for themselves: assignments of a secret name, access
identifiers, long hexadecimal runs. Weak candidates mean little alone:

* id        a short access identifier, `AKIA` and 8 to 15 capitals or digits
* key       a mixed run of 20 or more base64 characters with a digit, a capital and a small letter
* endpoint  a host with a scheme or a host:port of a known service port, from the start of its run

A weak `id` or `key` is reported when a part of the other sort (identifier
against secret, base spans included) or an endpoint with both lies within
`scope` characters; an endpoint when an identifier and a secret do. Parts are
rows; the interval join of the parts of a text is a range window around each
of them, so a text with thousands of parts costs no pairs.

Parts are keyed by the SHA-256 of their text: copies of a text, however many,
collapse to one set of spans before they are linked. Null counts as an empty
text. Positions are code points, ends exclusive.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..sources.tables import cut

SCOPE = 400

# The base patterns.
ASSIGN = r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]+"
HEX = r"[0-9a-f]+"
BASE = ("assign", "access", "hex")
KINDS = (*BASE, "id", "key", "endpoint")
IDENTIFIERS, SECRETS = ("access", "id"), ("assign", "hex", "key")

KEY = r"(?<![A-Za-z0-9+/])[A-Za-z0-9+/]{20,}={0,2}(?![A-Za-z0-9+/=])"
# Possessive, and only from the start of a run: no text makes them scan a run twice or recurse.
ENDPOINT = (
    r"(?:(?<![a-z0-9+])[a-z][a-z0-9+]*+://[A-Za-z0-9.-]++(?::[0-9]++)?"
    r"|(?<![A-Za-z0-9.-])[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++:(?:22|443|1433|3306|5432|5672|6379|8080|8443|9200|27017))"
)
SPAN = "array<struct<kind:string,start:int,end:int,match:string>>"
CHUNK = 256  # spans that are put together at once, so many matches in one text cost no copies of all before


def found(text: Column, pattern: str, kind: str) -> Column:
    """array<struct<kind, start, end, match>> of the leftmost non-overlapping matches.

    The pieces between matches and the matches themselves alternate, so a
    running sum of their lengths gives the positions.
    """
    matches = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    between = F.split(text, pattern, -1)
    none = F.array().cast(SPAN)

    def step(state: Column, pair: Column) -> Column:
        start = state["at"] + F.length(pair["before"])
        end = start + F.length(pair["match"])
        span = F.struct(F.lit(kind).alias("kind"), start.alias("start"), end.alias("end"), pair["match"].alias("match"))
        return F.struct(end.alias("at"), F.concat(state["out"], F.array(span)).alias("out"))

    def chunk(state: Column, some: Column) -> Column:
        # each step copies its state, so what is done stays out of it
        now = F.aggregate(some, F.struct(state["at"].alias("at"), none.alias("out")), step)
        return F.get(F.transform(F.array(now), lambda n: F.struct(n["at"].alias("at"), F.concat(state["done"], F.array(n["out"])).alias("done"))), F.lit(0))

    pairs = F.zip_with(matches, F.slice(between, F.lit(1), F.size(matches)), lambda m, b: F.struct(b.alias("before"), m.alias("match")))
    zero = F.struct(F.lit(0).alias("at"), F.array().cast(f"array<{SPAN}>").alias("done"))

    def placed(own: Column) -> Column:
        chunks = F.transform(F.sequence(F.lit(1), F.size(own), F.lit(CHUNK)), lambda i: F.slice(own, i, F.lit(CHUNK)))
        return F.aggregate(chunks, zero, chunk, lambda state: F.flatten(state["done"]))

    # as the element of an array the pairs are found once, not once for each chunk
    return F.when(F.size(matches) > 0, F.get(F.transform(F.array(pairs), placed), F.lit(0))).otherwise(none)


def parts(text: Column) -> Column:
    """All base and weak spans of a text, unlinked."""
    value = lambda s: F.regexp_extract(s["match"], ASSIGN, 2)
    long_hex = r"[0-9a-f]{24,}"  # a maximal run of 24 or more, as filtering the runs of one or more would leave
    mixed = lambda s: s["match"].rlike("[0-9]") & s["match"].rlike("[A-Z]") & s["match"].rlike("[a-z]")
    assign = F.filter(found(text, ASSIGN, "assign"), lambda s: F.length(value(s)) >= 6)
    access = F.filter(found(text, ACCESS, "access"), lambda s: F.length(s["match"]) >= 20)
    weak_id = F.filter(found(text, ACCESS, "id"), lambda s: F.length(s["match"]).between(12, 19))
    key = F.filter(found(text, KEY, "key"), mixed)
    return F.concat(assign, access, found(text, long_hex, "hex"), weak_id, key, found(text, ENDPOINT, "endpoint"))


def _position(kind: Column) -> Column:
    return reduce(lambda other, k: F.when(kind == k, KINDS.index(k)).otherwise(other), KINDS, F.lit(len(KINDS)))


def linked_spans(docs: DataFrame, text: str, scope: int = SCOPE) -> DataFrame:
    """(text_key, kind, start, end, score) of the base spans and of the weak ones whose complements lie within `scope`.

    `score` counts the complementary sorts found: 0 for a base span alone.
    """
    body = F.coalesce(F.col(text).cast("string"), F.lit(""))
    # Most texts hold no part; one test decides before anything is cut out.
    anything = F.lower(body).rlike(r"password|passwd|secret|token|api_?key") | body.rlike(f"AKIA[A-Z0-9]{{8}}|[0-9a-f]{{24}}|[A-Za-z0-9+/]{{20}}|{ENDPOINT}")
    # the key is made below the generator, not once for each part
    keyed = docs.select(body.alias("text")).filter(anything).select("text", F.sha2("text", 256).alias("text_key"))
    some = keyed.select("text_key", F.explode(parts(F.col("text"))).alias("s"))
    rows = some.select("text_key", "s.kind", "s.start", "s.end").distinct()
    near = Window.partitionBy("text_key").orderBy("start").rangeBetween(-scope, scope)
    of = lambda kinds: F.max(F.col("kind").isin(*kinds).cast("int")).over(near)
    has = rows.select("*", of(IDENTIFIERS).alias("ids"), of(SECRETS).alias("keys"), of(("endpoint",)).alias("ends"))
    mine = F.when(F.col("kind").isin(*IDENTIFIERS), F.col("keys")).when(F.col("kind").isin(*SECRETS), F.col("ids")).otherwise(F.least("ids", "keys"))
    score = mine + F.when(F.col("kind") == "endpoint", F.lit(0)).otherwise(F.least(mine, F.col("ends")))
    scored = has.select("text_key", "kind", "start", "end", score.alias("score"))
    return scored.filter(F.col("kind").isin(*BASE) | (F.col("score") > 0))


def report(docs: DataFrame, key: str, text: str, scope: int = SCOPE) -> DataFrame:
    """(key, n_assign, n_access, n_hex, base_sha256, spans, n_linked) of every row of docs."""
    body = F.coalesce(F.col(text).cast("string"), F.lit(""))
    span = F.struct(F.col("start"), _position(F.col("kind")).alias("place"), F.col("kind"), F.col("end"))
    write = lambda spans: F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")
    count = lambda kind: F.size(F.filter("all", lambda s: s["kind"] == kind)).cast("long")
    texts = (
        linked_spans(docs, text, scope)
        .groupBy("text_key")
        .agg(F.sort_array(F.collect_list(span)).alias("all"), F.sum((F.col("score") > 0).cast("long")).alias("n_linked"))
        .select(
            "text_key", count("assign").alias("n_assign"), count("access").alias("n_access"), count("hex").alias("n_hex"),
            F.sha2(write(F.filter("all", lambda s: s["kind"].isin(*BASE))), 256).alias("base_sha256"), write(F.col("all")).alias("spans"), "n_linked",
        )
    )
    # A written table has a known size, from which Spark chooses how to join.
    known = cut(texts, "secret-spans")
    rows = docs.select(F.col(key).alias("key"), F.sha2(body, 256).alias("text_key")).join(known, "text_key", "left")
    number = lambda n: F.coalesce(F.col(n), F.lit(0).cast("long")).alias(n)
    return rows.select(
        F.col("key").alias(key), number("n_assign"), number("n_access"), number("n_hex"),
        F.coalesce("base_sha256", F.sha2(F.lit(""), 256)).alias("base_sha256"), F.coalesce("spans", F.lit("")).alias("spans"), number("n_linked"),
    )
