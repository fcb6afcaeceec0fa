"""Derived billing, product, lifecycle and feedback features."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark import settings as s
from tidemark.functions.numbers import exact_avg, flag
from tidemark.operators.cleaning import coerce_and_repair
from tidemark.operators.quantiles import exact_median


def tenure_bucket(
    tenure: Column,
    edges: Sequence[float] = s.TENURE_EDGES,
    labels: Sequence[str] = s.TENURE_LABELS,
    floor: float = s.TENURE_FLOOR,
    outside: str | None = None,
) -> Column:
    """Label of the first bucket whose upper edge is not exceeded; ``outside`` otherwise."""
    bucket = F.lit(outside).cast("string")
    for edge, label in reversed(list(zip(edges, labels, strict=True))):
        bucket = F.when(tenure <= F.lit(edge), F.lit(label)).otherwise(bucket)
    return F.when(tenure > F.lit(floor), bucket).otherwise(F.lit(outside).cast("string"))


def engineer_features(
    df: DataFrame,
    columns: s.AccountColumns = s.ACCOUNTS,
    economics: s.Economics = s.ECONOMICS,
    edges: Sequence[float] = s.TENURE_EDGES,
    labels: Sequence[str] = s.TENURE_LABELS,
    outside: str | None = None,
) -> DataFrame:
    """Add the derived columns; optional inputs are resolved when the plan is built."""
    tenure, monthly = F.col(columns.tenure), F.col(columns.monthly)
    rebuilt = monthly * tenure
    known_total = F.col(columns.total) if columns.total in df.columns else F.lit(None).cast("double")
    out = df.withColumn(columns.total, F.coalesce(known_total, rebuilt, F.lit(0.0)))

    total = F.col(columns.total)
    out = out.withColumn(
        "avg_charge_per_month", F.when(tenure > 0, F.try_divide(total, tenure)).otherwise(monthly)
    )
    average = F.col("avg_charge_per_month")
    out = out.withColumn("charge_drift", monthly - average)
    out = out.withColumns(
        {
            "charge_drift_pct": F.coalesce(F.try_divide(F.col("charge_drift"), average), F.lit(0.0)),
            "clv_to_date": total,
            "services_count": _count_yes(out, columns.services),
            "has_premium_support": flag(_count_yes(out, columns.premium) > 0),
            "tenure_bucket": tenure_bucket(tenure, edges, labels, outside=outside),
            "is_new_customer": flag(tenure <= 6),
            "annual_revenue_at_risk": monthly * F.lit(float(economics.horizon_months)),
        }
    )
    out = out.withColumn(
        "annual_margin_at_risk", F.col("annual_revenue_at_risk") * F.lit(economics.margin)
    )
    if columns.contract in df.columns:
        monthly_contract = F.col(columns.contract) == "Month-to-month"
        out = out.withColumn("is_month_to_month", flag(monthly_contract))
    if columns.payment in df.columns:
        manual = F.col(columns.payment).isin(*s.MANUAL_PAYMENT_METHODS)
        out = out.withColumn("is_manual_payment", flag(manual))
    return out


def _count_yes(df: DataFrame, names: Sequence[str]) -> Column:
    total = F.lit(0)
    for name in names:
        if name in df.columns:
            total = total + F.col(name).eqNullSafe("Yes").cast("int")
    return total


def prepare_for_scoring(
    df: DataFrame,
    columns: s.AccountColumns = s.ACCOUNTS,
    economics: s.Economics = s.ECONOMICS,
    medians: Mapping[str, float] | None = None,
) -> DataFrame:
    """Repair and engineer at scoring time: every row in comes out again."""
    return engineer_features(coerce_and_repair(df, columns, medians), columns, economics)


def review_features(reviews: DataFrame, id_column: str = s.ACCOUNTS.id) -> DataFrame:
    """Feedback per customer: how much, how good, how bad, how recent."""
    return (
        reviews.where(F.col(id_column).isNotNull())
        .groupBy(id_column)
        .agg(
            F.count("review_id").alias("review_count"),
            exact_avg("rating").alias("avg_rating"),
            F.min("rating").alias("min_rating"),
            F.max("review_date").alias("last_review_date"),
        )
        .withColumn("has_negative_review", flag(F.col("min_rating") <= 2))
    )


def reviews_before(
    reviews: DataFrame, cutoffs: DataFrame, id_column: str = s.ACCOUNTS.id, cutoff: str = "as_of"
) -> DataFrame:
    """Point-in-time feedback: only reviews older than the customer's cutoff date."""
    keyed = cutoffs.select(id_column, cutoff)
    return reviews.join(keyed, id_column).where(F.col("review_date") < F.col(cutoff)).drop(cutoff)


def add_review_features(
    features: DataFrame,
    per_customer: DataFrame,
    id_column: str = s.ACCOUNTS.id,
    median_rating: float | None = None,
) -> DataFrame:
    """Left join the feedback features and fill customers without feedback.

    Their average rating is the median of the customers that have one, and their
    minimum rating falls back to that average.
    """
    joined = features.join(per_customer, id_column, "left")
    if median_rating is None:
        matched = per_customer.join(features.select(id_column), id_column, "left_semi")
        median_rating = exact_median(matched, ["avg_rating"])["avg_rating"]
    average = F.coalesce("avg_rating", F.lit(median_rating).cast("double"))
    return joined.withColumns(
        {
            "review_count": F.coalesce("review_count", F.lit(0)),
            "avg_rating": average,
            "min_rating": F.coalesce(F.col("min_rating").cast("double"), average),
            "has_negative_review": F.coalesce("has_negative_review", F.lit(0)),
        }
    ).drop("last_review_date")
