"""The analysis dataset: cleaned, derived and weighted respondents plus their metadata tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.aggregate import literal_rows
from ..operators.clean import clean, cleaning_log, with_indicators, with_scaled_weight
from ..operators.quality import validate
from ..spec import Survey


def metadata_tables(df: DataFrame, survey: Survey) -> dict[str, DataFrame]:
    variables = [(v.name, v.label, v.kind, v.topic, v.note) for v in survey.variables.values()]
    labels = [(v.name, int(c), t) for v in survey.variables.values() for c, t in v.labels.items()]
    indicators = [
        (i.name, i.kind, i.description, i.rule, ", ".join(i.sources), i.universe) for i in survey.indicators.values()
    ]
    return {
        "variables": literal_rows(df, variables, ["name", "label", "kind", "topic", "note"]),
        "value_labels": literal_rows(df, labels, ["variable", "code", "label"]),
        "derived_indicators": literal_rows(df, indicators, ["name", "kind", "description", "rule", "sources", "universe"]),
    }


def build_dataset(
    raw: DataFrame, survey: Survey, out: str, rules: Sequence = (), partition_by: Sequence[str] = ()
) -> dict[str, str]:
    """Writes every table as Parquet under `out` and returns their paths. Starts jobs.

    Respondents are written first; validation then reads the written table, so
    the cleaning work happens once.
    """
    spark = raw.sparkSession
    coded = [v for v in survey.variables.values() if v.name in raw.columns]
    ready = with_indicators(with_scaled_weight(clean(raw, coded), survey), survey)
    paths = {name: f"{out.rstrip('/')}/{name}" for name in (
        "respondents", "cleaning_log", "variables", "value_labels", "derived_indicators", "validation_checks", "build_info")}
    writer = ready.write.mode("overwrite")
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(paths["respondents"])
    cleaning_log(raw, coded).write.mode("overwrite").parquet(paths["cleaning_log"])
    written = spark.read.parquet(paths["respondents"])
    for name, df in metadata_tables(raw, survey).items():
        df.write.mode("overwrite").parquet(paths[name])
    if rules:
        validate(written, rules).write.mode("overwrite").parquet(paths["validation_checks"])
    else:
        del paths["validation_checks"]
    info = written.agg(
        F.count(F.lit(1)).alias("n_rows"), F.sum(survey.weight).alias("weight_total"),
        F.lit(len(written.columns)).alias("n_columns"), F.current_timestamp().alias("built_at"),
    )
    info.write.mode("overwrite").parquet(paths["build_info"])
    return paths
