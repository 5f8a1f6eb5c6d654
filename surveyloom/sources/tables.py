"""Column-pruned reads, report and table sinks, and the content fingerprint."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.numeric import percent


def read_columns(spark: SparkSession, path: str, columns: Sequence[str], format: str = "parquet") -> DataFrame:
    """Only the named columns of a wide table; the projection reaches the scan."""
    return spark.read.format(format).load(path).select(*columns)


_OWN: dict[str, str] = {}  # by application


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path in the folder all executors share, named by spark.checkpoint.dir.

    Where it is unset, an own folder serves as long as driver and executors are
    one process (master local[n]); elsewhere that is an error.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        master = spark.sparkContext.master
        if master != "local" and not master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        shared = _OWN.get(spark.sparkContext.applicationId) or tempfile.mkdtemp(prefix="surveyloom-")
        _OWN[spark.sparkContext.applicationId] = shared
    return f"{shared.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def cut(df: DataFrame, name: str) -> DataFrame:
    """Writes `df` to the shared folder and reads it back: lineage ends there and survives lost executors."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def delete_cut(df: DataFrame) -> None:
    """Deletes the folder of a table that `cut` returned, once nothing reads it any more."""
    spark = df.sparkSession
    for folder in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
        path = spark._jvm.org.apache.hadoop.fs.Path(spark._jvm.java.net.URI.create(folder))
        path.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(path, True)


def spread(df: DataFrame) -> DataFrame:
    """The rows over all cores where the scan has fewer partitions, as of one file with one row group; else untouched."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df


def first_rows(df: DataFrame, column: str, n: int) -> DataFrame:
    """The n first rows by a column of distinct values. Starts jobs.

    The rows are dealt out in ranges and written once; ranges wholly among the
    first are kept as they are, and only the range at the border is sorted.
    """
    ranged = cut(df.repartitionByRange(column).withColumn("_range", F.spark_partition_id()), "ranges")
    sizes = {r["_range"]: r.n for r in ranged.groupBy("_range").agg(F.count(F.lit(1)).alias("n")).collect()}
    whole, left, border = [], n, None
    for part in sorted(sizes):
        if sizes[part] <= left:
            whole.append(part)
            left -= sizes[part]
        else:
            border = part
            break
    kept = ranged.filter(F.col("_range").isin(whole)) if whole else ranged.limit(0)
    if border is not None and left > 0:
        at = F.row_number().over(Window.partitionBy("_range").orderBy(column))
        kept = kept.unionByName(ranged.filter(F.col("_range") == border).withColumn("_at", at).filter(F.col("_at") <= left).drop("_at"))
    return kept.drop("_range")


def write_report(df: DataFrame, path: str, digits: int | None = 2) -> str:
    """A small result table as one CSV with header; doubles are rounded here and nowhere earlier."""
    if digits is not None:
        doubles = [c for c, t in df.dtypes if t == "double"]
        df = df.withColumns({c: F.round(F.col(c).cast("decimal(38,10)"), digits).cast("double") for c in doubles})
    df.coalesce(1).write.mode("overwrite").option("header", True).option("escape", '"').csv(path)
    return path


def write_tables(tables: dict[str, DataFrame], out: str, report: bool = True, at_once: int = 8) -> dict[str, str]:
    """Named result tables under `out`: CSV for reports, otherwise Parquet keeping its partitions.

    Independent tables are submitted `at_once` at a time, so small reports do not queue behind each other.
    """
    def write(entry):
        name, df = entry
        path = f"{out.rstrip('/')}/{name}"
        if report:
            write_report(df, path)
        else:
            df.write.mode("overwrite").parquet(path)
        return name, path

    with ThreadPoolExecutor(max_workers=at_once) as pool:
        return dict(pool.map(write, tables.items()))


def fingerprint(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """(n_rows, checksum) that do not depend on row order or partitioning.

    Per row: the first 48 bits of the SHA-256 of the values joined by '|' (NULL
    as '~'); the checksum is their sum, so it combines map-side.
    """
    text = F.concat_ws("|", *[F.coalesce(F.col(c).cast("string"), F.lit("~")) for c in columns or df.columns])
    bits = F.conv(F.substring(F.sha2(text, 256), 1, 12), 16, 10).cast("decimal(20,0)")
    return df.agg(F.count(F.lit(1)).alias("n_rows"), F.sum(bits).alias("checksum"))


def integrity_checks(before: DataFrame, after: DataFrame) -> DataFrame:
    """(check, observed, expected, passed) from two fingerprints."""
    a = before.select(F.col("n_rows").alias("n0"), F.col("checksum").alias("c0"))
    b = after.select("n_rows", "checksum")
    both = b.withColumn("_before", a.select(F.struct("n0", "c0")).scalar())
    entries = [
        F.struct(
            F.lit(name).alias("check"),
            F.col(now).cast("string").alias("observed"),
            F.col(f"_before.{then}").cast("string").alias("expected"),
            (F.col(now) == F.col(f"_before.{then}")).alias("passed"),
        )
        for name, now, then in (("row count", "n_rows", "n0"), ("checksum", "checksum", "c0"))
    ]
    return both.select(F.inline(F.array(*entries)))


def column_profile(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """(variable, n_valid, n_missing, pct_missing) of many columns from one aggregate."""
    names = list(columns or df.columns)
    counts = df.agg(F.count(F.lit(1)).alias("_all"), *[F.count(c).alias(f"_n_{c}") for c in names])
    entries = [
        F.struct(
            F.lit(c).alias("variable"),
            F.col(f"_n_{c}").alias("n_valid"),
            (F.col("_all") - F.col(f"_n_{c}")).alias("n_missing"),
            percent(F.col("_all") - F.col(f"_n_{c}"), "_all").alias("pct_missing"),
        )
        for c in names
    ]
    return counts.select(F.inline(F.array(*entries)))
