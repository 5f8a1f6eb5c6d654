"""Documents to retrievable chunks. Every step works inside one row: no shuffle."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.numeric import Columnish, _c
from ..functions.text import LINE_END, strip

MAX_CHUNK_CHARS = 1800
HEADING = r"^#{1,4} "


def sections(text: Columnish, stem: Columnish) -> Column:
    """array<struct<heading, body>> of the non-empty heading sections of a markdown text.

    Text before the first heading goes under `stem`.
    """
    pieces = F.split(F.regexp_replace(_c(text), LINE_END, "\n"), r"(?m)(?=^#{1,4} )")

    def part(piece: Column) -> Column:
        headed = piece.rlike(HEADING)
        first_line = F.regexp_extract(piece, r"^#+([^\n]*)", 1)
        body = F.regexp_replace(piece, r"^#[^\n]*", "")
        return F.struct(
            F.when(headed, strip(first_line)).otherwise(_c(stem)).alias("heading"),
            strip(F.when(headed, body).otherwise(piece)).alias("body"),
        )

    return F.filter(F.transform(pieces, part), lambda s: s["body"] != "")


def split_long(text: Columnish, limit: int = MAX_CHUNK_CHARS, separator: str = "\n\n") -> Column:
    """Pieces of a long text, packed greedily from whole paragraphs; a short text is one piece."""
    t = _c(text)
    start = F.struct(F.array().cast("array<string>").alias("done"), F.lit("").alias("current"))

    def step(acc: Column, paragraph: Column) -> Column:
        full = (acc["current"] != "") & (F.length(acc["current"]) + F.length(paragraph) > limit)
        added = F.concat(paragraph, F.lit(separator))
        return F.struct(
            F.when(full, F.concat(acc["done"], F.array(strip(acc["current"])))).otherwise(acc["done"]).alias("done"),
            F.when(full, added).otherwise(F.concat(acc["current"], added)).alias("current"),
        )

    def finish(acc: Column) -> Column:
        last = strip(acc["current"])
        return F.when(last != "", F.concat(acc["done"], F.array(last))).otherwise(acc["done"])

    pattern = separator.replace("\n", r"\n")
    packed = F.aggregate(F.split(t, pattern), start, step, finish)
    return F.when(F.length(t) <= limit, F.array(t)).otherwise(packed)


def identifiers(text: Columnish, pattern: str) -> Column:
    """Distinct identifiers matching `pattern` (group 1), sorted."""
    return F.array_sort(F.array_distinct(F.regexp_extract_all(_c(text), F.lit(pattern), F.lit(1))))


def markdown_chunks(
    docs: DataFrame, identifier_pattern: str, limit: int = MAX_CHUNK_CHARS, separator: str = "\n\n"
) -> DataFrame:
    """`docs(file, name, stem, source, text)` to chunks (id, text, source, title, metadata, variables)."""
    by_section = docs.select("file", "name", "source", F.posexplode(sections("text", "stem")).alias("number", "s"))
    parts = by_section.select(
        "file", "name", "source", "number", F.col("s.heading").alias("heading"),
        F.posexplode(split_long("s.body", limit, separator)).alias("part_number", "part"),
    )
    return parts.select(
        F.concat("file", F.lit("#"), F.col("number").cast("string"), F.lit("."), F.col("part_number").cast("string")).alias("id"),
        F.concat("heading", F.lit("\n\n"), "part").alias("text"),
        "source",
        F.concat("name", F.lit(" > "), "heading").alias("title"),
        F.create_map(F.lit("file"), "file", F.lit("heading"), "heading").alias("metadata"),
        identifiers(F.concat("heading", F.lit(" "), "part"), identifier_pattern).alias("variables"),
    )


def record_chunks(orgs: DataFrame) -> DataFrame:
    """Organization records to one text chunk each."""
    where = F.when(F.col("geography.scope") == "national", F.lit("national (all India)")).otherwise(
        F.array_join("geography.states", ", ")
    )
    text = F.concat(
        F.col("name"), F.lit(" ("), F.col("type"), F.lit("). Geography: "), where, F.lit(". "),
        F.coalesce("geography.detail", F.lit("")), F.lit(" Channels: "), F.array_join("channels", ", "),
        F.lit(". Stated work: "), F.array_join(F.transform("facts", lambda f: f["text"]), " "),
    )
    return orgs.select(
        F.concat(F.lit("outreach:"), F.col("id").cast("string")).alias("id"), text.alias("text"),
        F.lit("outreach knowledge base").alias("source"), F.col("name").alias("title"),
    )


def text_to_embed(title: Columnish = "title", text: Columnish = "text") -> Column:
    """The title counts twice: it carries most of a chunk's meaning."""
    return F.concat(_c(title), F.lit(". "), _c(title), F.lit(". "), _c(text))
