"""The codebook: variable names, labels, types and JSON value labels."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.numeric import Columnish, _c

CODEBOOK_COLUMNS = ("variable_name", "variable_label", "stata_type", "value_label_name", "value_labels")
NO_LABELS = "no value labels (the values are numbers or text)"


def load_codebook(spark: SparkSession, path: str) -> DataFrame:
    """All columns as text; an empty cell stays an empty string instead of NULL."""
    schema = ", ".join(f"{c} string" for c in CODEBOOK_COLUMNS)
    raw = (
        spark.read.schema(schema)
        .option("header", True).option("quote", '"').option("escape", '"').option("multiLine", True)
        .csv(path)
    )
    return raw.select(*[F.coalesce(F.col(c), F.lit("")).alias(c) for c in CODEBOOK_COLUMNS])


def label_map(value_labels: Columnish) -> Column:
    return F.from_json(F.when(_c(value_labels) != "", _c(value_labels)), "map<string,string>")


def value_label_table(codebook: DataFrame) -> DataFrame:
    """(variable, code, label), one row per labelled code."""
    return codebook.select(
        F.col("variable_name").alias("variable"), F.explode(label_map("value_labels")).alias("code", "label")
    ).select("variable", F.col("code").cast("int").alias("code"), "label")


def attach_labels(df: DataFrame, columns, labels: DataFrame) -> DataFrame:
    """Adds `<column>_label`: the label, the code itself when it has none, NULL for NULL."""
    for c in columns:
        of_c = labels.filter(F.col("variable") == c).select(
            F.col("code").alias(f"_{c}_code"), F.col("label").alias(f"_{c}_label")
        )
        joined = df.join(of_c, F.col(c) == F.col(f"_{c}_code"), "left")
        text = F.when(F.col(c).isNotNull(), F.coalesce(f"_{c}_label", F.col(c).cast("string")))
        df = joined.withColumn(f"{c}_label", text).drop(f"_{c}_code", f"_{c}_label")
    return df


def format_labels(value_labels: Columnish, limit: int | None = None) -> Column:
    """'code = meaning; ...' of all codes, or of the first `limit` and then how many there are."""
    entries = F.transform(
        F.map_entries(label_map(value_labels)), lambda e: F.concat(e["key"], F.lit(" = "), e["value"])
    )
    n = F.size(entries)
    shown = F.array_join(entries if limit is None else F.slice(entries, 1, limit), "; ")
    more = F.concat(shown, F.lit("; ... ("), n.cast("string"), F.lit(" codes in total)"))
    listed = shown if limit is None else F.when(n > limit, more).otherwise(shown)
    return F.when(_c(value_labels) == "", F.lit(NO_LABELS)).otherwise(listed)


def codebook_chunks(codebook: DataFrame, order: str, max_labels: int | None = None) -> DataFrame:
    """One text chunk per variable; numbered repeats with the same label and codes become one chunk.

    `order` is the column giving the source order of the rows; `max_labels`
    limits the value labels a chunk lists.
    """
    pattern = r"^(.+?)_(\d{1,2})$"
    name = F.col("variable_name")
    based = codebook.withColumn(
        "_base", F.when(name.rlike(pattern), F.regexp_extract(name, pattern, 1)).otherwise(name)
    )
    slots = (
        based.groupBy("_base", "variable_label", "value_labels")
        .agg(F.array_sort(F.collect_list(F.struct(F.col(order).alias("_order"), "variable_name", "stata_type"))).alias("_rows"))
        .withColumn("variables", F.transform("_rows", lambda r: r["variable_name"]))
    )
    first, last, n = F.get("variables", F.lit(0)), F.element_at("variables", -1), F.size("variables")
    label = F.col("variable_label")
    title = F.when(n == 1, F.concat(first, F.lit(": "), label)).otherwise(
        F.concat(first, F.lit(" ... "), last, F.lit(": "), label)
    )
    names = F.when(n == 1, F.concat(F.lit("Variable "), first)).otherwise(
        F.concat(
            F.lit("Variables "), F.array_join("variables", ", "), F.lit(" (the same question repeated "),
            n.cast("string"), F.lit(" times, once per slot, e.g. per child or per birth)"),
        )
    )
    text = F.concat(
        names, F.lit(". Description (codebook label): "), F.when(label != "", label).otherwise("(no label)"),
        F.lit(". Stata type: "), F.get("_rows", F.lit(0))["stata_type"],
        F.lit(". Value labels: "), format_labels("value_labels", max_labels), F.lit("."),
    )
    return slots.select(
        F.concat(F.lit("codebook:"), first).alias("id"), text.alias("text"), F.lit("codebook").alias("source"),
        title.alias("title"), "variables",
    )


def lookup_variable(names: DataFrame, chunks: DataFrame, dictionary: DataFrame) -> DataFrame:
    """Exact definitions: the codebook chunk and the dictionary chunk of each asked name, or found = false.

    `names(name)`, `chunks(id, text, variables)`, `dictionary(variable, text)`.
    """
    asked = names.select("name", F.lower(F.trim("name")).alias("_key")).distinct()
    by_name = chunks.select(F.explode("variables").alias("_v"), "id", "text").select(
        F.lower("_v").alias("_key"), F.col("id").alias("chunk_id"), F.col("text").alias("codebook_text")
    )
    described = dictionary.select(F.lower("variable").alias("_key"), F.col("text").alias("dictionary_text"))
    return (
        asked.join(by_name, "_key", "left")
        .join(described, "_key", "left")
        .select("name", "chunk_id", "codebook_text", "dictionary_text", F.col("chunk_id").isNotNull().alias("found"))
    )
