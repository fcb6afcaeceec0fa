"""Deduplication, type coercion, repair, target decoding and schema alignment."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark import settings as s
from tidemark.functions.numbers import parse_number
from tidemark.operators.quantiles import exact_median
from tidemark.operators.ranking import with_global_rank

UNKNOWN = "Unknown"
_WHOLE_TYPES = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)


def drop_exact_duplicates(df: DataFrame) -> DataFrame:
    return df.dropDuplicates()


def keep_first(df: DataFrame, key: str, order_by: Sequence[Column]) -> DataFrame:
    """One row per key, the first in the given order (Spark has no input order)."""
    w = Window.partitionBy(key).orderBy(*order_by)
    return df.withColumn("_rn", F.row_number().over(w)).where("_rn = 1").drop("_rn")


def coerce_numbers(df: DataFrame, names: Sequence[str]) -> DataFrame:
    present = [c for c in names if c in df.columns]
    return df.withColumns({c: parse_number(c) for c in present})


def repair_billing(df: DataFrame, columns: s.AccountColumns = s.ACCOUNTS) -> DataFrame:
    """A missing lifetime total is rebuilt from the monthly charge, else 0.0."""
    total = F.coalesce(columns.total, F.col(columns.monthly) * F.col(columns.tenure), F.lit(0.0))
    return df.withColumn(columns.total, total)


def fill_unknown(df: DataFrame) -> DataFrame:
    names = [f.name for f in df.schema if isinstance(f.dataType, T.StringType)]
    return df.fillna(UNKNOWN, subset=names)


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema if isinstance(f.dataType, T.NumericType)]


def fit_medians(df: DataFrame, names: Sequence[str] | None = None) -> dict[str, float]:
    """Exact medians of the numeric columns that have nulls (the others need none)."""
    names = list(names or numeric_columns(df))
    if not names:
        return {}
    counted = df.agg(F.count(F.lit(1)).alias("_rows"), *[F.count(c).alias(c) for c in names]).first()
    gaps = {c: counted[c] for c in names if counted[c] < counted["_rows"]}
    return {c: m for c, m in exact_median(df, list(gaps), gaps).items() if m is not None}


def fill_medians(df: DataFrame, medians: Mapping[str, float]) -> DataFrame:
    return df.withColumns(
        {c: F.coalesce(F.col(c), F.lit(m)) for c, m in medians.items() if c in df.columns}
    )


def decode_target(
    df: DataFrame, target: str = s.ACCOUNTS.target, words: Sequence[str] = s.CHURNED_WORDS
) -> DataFrame:
    """Any spelling of the outcome to 0/1; whole numbers are left as they are."""
    if target not in df.columns or isinstance(df.schema[target].dataType, _WHOLE_TYPES):
        return df
    word = F.lower(F.trim(F.col(target).cast("string")))
    return df.withColumn(target, F.coalesce(word.isin(*words), F.lit(False)).cast("int"))


def training_target(df: DataFrame, target: str = s.ACCOUNTS.target) -> DataFrame:
    """Numeric targets are truncated to whole numbers, text must name a churned customer."""
    if isinstance(df.schema[target].dataType, T.NumericType):
        return df.withColumn(target, F.col(target).cast("int"))
    return decode_target(df, target, s.TRAINING_CHURNED_WORDS)


def coerce_and_repair(
    df: DataFrame,
    columns: s.AccountColumns = s.ACCOUNTS,
    medians: Mapping[str, float] | None = None,
) -> DataFrame:
    """Row-wise cleaning that never drops a row.

    Null numbers take the median of this frame, or ``medians`` fitted elsewhere
    (serving and streaming must pass those).
    """
    out = coerce_numbers(df, (columns.total, columns.tenure, columns.monthly, columns.senior))
    if columns.total in df.columns:
        out = repair_billing(out, columns)
    out = fill_unknown(out)
    out = fill_medians(out, fit_medians(out) if medians is None else medians)
    return decode_target(out, columns.target)


def clean_accounts(
    df: DataFrame,
    order_by: Sequence[Column],
    columns: s.AccountColumns = s.ACCOUNTS,
    medians: Mapping[str, float] | None = None,
) -> DataFrame:
    """Deduplicate, then coerce and repair.

    Keeping the first row per id also removes exact copies, so a table with an id
    needs one pass; without an id whole rows are compared.
    """
    if columns.id in df.columns:
        unique = keep_first(df, columns.id, order_by)
    else:
        unique = drop_exact_duplicates(df)
    return coerce_and_repair(unique, columns, medians)


def count_blank_totals(df: DataFrame, columns: s.AccountColumns = s.ACCOUNTS) -> DataFrame:
    """How many lifetime totals the billing repair has to rebuild."""
    return df.agg(F.count_if(parse_number(columns.total).isNull()).alias("blank_totals"))


def feature_types(
    df: DataFrame, columns: s.AccountColumns = s.ACCOUNTS, exclude: Sequence[str] | None = None
) -> tuple[list[str], list[str]]:
    """Numeric and categorical model inputs, without ids, outcomes and duplicates of them."""
    dropped = set(LEAKING_COLUMNS if exclude is None else exclude) | {columns.id, columns.target}
    usable = [f for f in df.schema if f.name not in dropped]
    numeric = [f.name for f in usable if isinstance(f.dataType, (T.NumericType, T.BooleanType))]
    return numeric, [f.name for f in usable if f.name not in numeric]


# Columns that give the outcome away or repeat another input.
LEAKING_COLUMNS = (
    "customerID",
    "Churn",
    "annual_revenue_at_risk",
    "annual_margin_at_risk",
    "clv_to_date",
    "last_review_date",
)


def align_columns(df: DataFrame, schema: T.StructType, keep: Sequence[str] = ()) -> DataFrame:
    """Exactly the training columns: missing ones become null, extra ones are dropped."""
    aligned = [
        F.col(f.name).cast(f.dataType).alias(f.name)
        if f.name in df.columns
        else F.lit(None).cast(f.dataType).alias(f.name)
        for f in schema
        if f.name not in keep
    ]
    return df.select(*[F.col(c) for c in keep], *aligned)


def fill_ids(df: DataFrame, id_column: str, order_by: Sequence[Column]) -> DataFrame:
    """Null or absent ids become ``row-<position>`` in the given order."""
    ranked = with_global_rank(df, order_by, "_row")
    fallback = F.concat(F.lit("row-"), F.col("_row").cast("string"))
    known = F.col(id_column).cast("string") if id_column in df.columns else F.lit(None)
    return ranked.withColumn(id_column, F.coalesce(known, fallback)).drop("_row")
