"""Raw files: CSV scans with explicit text schemas, snapshots and exports."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Raw account and feedback columns.
ACCOUNT_FIELDS = (
    "customerID", "gender", "SeniorCitizen", "Partner", "Dependents", "tenure", "PhoneService",
    "MultipleLines", "InternetService", "OnlineSecurity", "OnlineBackup", "DeviceProtection",
    "TechSupport", "StreamingTV", "StreamingMovies", "Contract", "PaperlessBilling", "PaymentMethod",
    "MonthlyCharges", "TotalCharges", "Churn",
)
REVIEW_FIELDS = ("review_id", "customerID", "review_date", "channel", "rating", "review_text")

# Spellings of a missing value in data files. A blank (" ") is not one.
NULL_TOKENS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
)


def _first_existing(spark: SparkSession, paths: Sequence[str]) -> str:
    """The first path that is there, on whatever file system it names."""
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    for path in paths:
        hadoop_path = jvm.org.apache.hadoop.fs.Path(path)
        if hadoop_path.getFileSystem(conf).exists(hadoop_path):
            return path
    raise FileNotFoundError(f"none of these sources exists: {', '.join(paths)}")


def read_text_table(
    spark: SparkSession, paths: Sequence[str], fields: Sequence[str], multi_line: bool = False
) -> DataFrame:
    """CSV with a header as text columns; null spellings become null, blanks stay.

    Columns are matched by the header, so a file may order them differently or leave
    some out (they are then absent, as the contract check wants to see). Quoted line
    breaks need ``multi_line``, which reads a file in one piece: keep such files small.
    """
    path = _first_existing(spark, paths)
    options = {"header": True, "multiLine": multi_line, "escape": '"', "quote": '"'}
    header = spark.read.options(**options).csv(path).columns
    schema = T.StructType([T.StructField(c, T.StringType()) for c in header])
    raw = spark.read.options(**options, enforceSchema=True).schema(schema).csv(path)
    known = [c for c in fields if c in header] + [c for c in header if c not in fields]
    return raw.select(
        *[F.when(~F.col(c).isin(*NULL_TOKENS), F.col(c)).alias(c) for c in known]
    )


def read_accounts(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    return read_text_table(spark, paths, ACCOUNT_FIELDS)


def read_reviews(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    raw = read_text_table(spark, paths, REVIEW_FIELDS, multi_line=True)
    return raw.withColumns(
        {
            "review_date": F.to_date(F.try_to_timestamp(F.col("review_date"))),
            "rating": F.col("rating").try_cast("int"),
        }
    )


def read_parquet(spark: SparkSession, path: str, spread: bool = False) -> DataFrame:
    """A Parquet scan. ``spread`` deals the rows of a few small files out to all cores
    before heavy work per row; a scan that already has enough splits is left alone."""
    df = spark.read.parquet(path)
    cores = spark.sparkContext.defaultParallelism
    return df.repartition(cores) if spread and df.rdd.getNumPartitions() < cores else df


def write_snapshot(df: DataFrame, folder: str, name: str) -> str:
    path = f"{folder}/{name}.parquet"
    df.write.mode("overwrite").parquet(path)
    return path


def export_csv(df: DataFrame, path: str, single_file: bool = False) -> None:
    """A report as CSV, a file per partition. A single file suits report-sized results only."""
    out = df.coalesce(1) if single_file else df
    keep_blanks = {"ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}
    out.write.mode("overwrite").options(header=True, escape='"', **keep_blanks).csv(path)
