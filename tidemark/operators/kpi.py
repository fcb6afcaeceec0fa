"""Executive, contract, lifecycle, segment and campaign aggregates."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark import settings as s
from tidemark.functions.numbers import exact_avg, exact_sum, round_half_up, share
from tidemark.operators.quantiles import exact_median


def row_count() -> Column:
    return F.count(F.lit(1))


def _kpi_measures(columns: s.AccountColumns) -> list[Column]:
    revenue = exact_sum(columns.monthly)
    return [
        row_count().alias("customers"),
        round_half_up(exact_avg(columns.target) * 100, 2).alias("churn_rate_pct"),
        round_half_up(revenue, 2).alias("monthly_recurring_revenue"),
        round_half_up(revenue * 12, 2).alias("annualised_revenue"),
        round_half_up(exact_avg(columns.tenure), 1).alias("avg_tenure_months"),
        round_half_up(exact_avg(columns.monthly), 2).alias("arpu"),
    ]


def executive_kpis(features: DataFrame, columns: s.AccountColumns = s.ACCOUNTS) -> DataFrame:
    return features.agg(*_kpi_measures(columns))


def contract_risk(features: DataFrame, columns: s.AccountColumns = s.ACCOUNTS) -> DataFrame:
    """Per contract, worst first; a null contract keeps its own row."""
    return (
        features.groupBy(F.col(columns.contract).alias("contract_type"))
        .agg(
            row_count().alias("customers"),
            round_half_up(exact_avg(columns.target) * 100, 2).alias("churn_rate_pct"),
            round_half_up(exact_sum("annual_margin_at_risk"), 2).alias("margin_at_risk"),
        )
        .orderBy(F.desc("churn_rate_pct"), "contract_type")
    )


def kpis_with_contracts(features: DataFrame, columns: s.AccountColumns = s.ACCOUNTS) -> DataFrame:
    """The company row and the contract rows from one scan."""
    return (
        features.withColumnRenamed(columns.contract, "contract_type")
        .rollup("contract_type")
        .agg(
            F.grouping("contract_type").cast("int").alias("is_company"),
            *_kpi_measures(columns),
            round_half_up(exact_sum("annual_margin_at_risk"), 2).alias("margin_at_risk"),
        )
        .orderBy(F.desc("is_company"), F.desc("churn_rate_pct"), "contract_type")
    )


def contract_table(features: DataFrame, columns: s.AccountColumns = s.ACCOUNTS) -> DataFrame:
    """Per contract, unrounded; customers without a contract are left out."""
    return (
        features.where(F.col(columns.contract).isNotNull())
        .groupBy(columns.contract)
        .agg(
            F.count(columns.id).alias("customers"),
            exact_avg(columns.target).alias("churn_rate"),
            exact_sum("annual_margin_at_risk").alias("margin"),
        )
        .orderBy(F.desc("churn_rate"), columns.contract)
    )


def tenure_hazard(
    features: DataFrame, width: int = 6, top: int = 78, columns: s.AccountColumns = s.ACCOUNTS
) -> DataFrame:
    """Churn rate per (0, 6], (6, 12] … months; tenure 0 and beyond the top are left out."""
    tenure = F.col(columns.tenure)
    return (
        features.where((tenure > 0) & (tenure <= top))
        .groupBy((F.ceil(tenure / width) * width).cast("int").alias("upto_months"))
        .agg(exact_avg(columns.target).alias("churn_rate"))
        .where("churn_rate is not null")
        .orderBy("upto_months")
    )


def risk_band_counts(
    predictions: DataFrame, order: Sequence[str] = s.RISK_BAND_ORDER
) -> DataFrame:
    """Customers per band in display order, empty bands included."""
    counts = [F.count_if(F.col("risk_band") == band) for band in order]
    rows = [
        F.struct(F.lit(i).alias("position"), F.lit(band).alias("risk_band"), F.col(f"n{i}").alias("customers"))
        for i, band in enumerate(order, start=1)
    ]
    return predictions.agg(*[c.alias(f"n{i}") for i, c in enumerate(counts, start=1)]).select(
        F.inline(F.array(*rows))
    )


def segment_summary(
    features: DataFrame, segments: DataFrame, columns: s.AccountColumns = s.ACCOUNTS
) -> DataFrame:
    """Size and averages per segment, largest first."""
    joined = features.join(segments.select(columns.id, "segment_name"), columns.id, "left")
    return (
        joined.where("segment_name is not null")
        .groupBy("segment_name")
        .agg(
            F.count(columns.id).alias("customers"),
            exact_avg(columns.target).alias("churn_rate"),
            exact_avg(columns.monthly).alias("avg_monthly"),
            exact_avg(columns.tenure).alias("avg_tenure"),
        )
        .orderBy(F.desc("customers"), "segment_name")
    )


def segment_profile(
    features: DataFrame, segments: DataFrame, columns: s.AccountColumns = s.ACCOUNTS
) -> DataFrame:
    """The summary rounded to three decimals, most churning segment first."""
    summary = segment_summary(features, segments, columns)
    rounded = [round_half_up(c, 3).alias(c) for c in ("avg_tenure", "avg_monthly", "churn_rate")]
    return summary.select("segment_name", "customers", *rounded).orderBy(
        F.desc("churn_rate"), "segment_name"
    )


def topic_summary(enriched: DataFrame, columns: s.AccountColumns = s.ACCOUNTS) -> DataFrame:
    """Volume, sentiment, rating and reach per topic, most negative first."""
    measured = (
        enriched.where("topic_id is not null and topic_label is not null")
        .groupBy("topic_id", "topic_label")
        .agg(
            F.count("review_id").alias("documents"),
            round_half_up(exact_avg("sentiment_score"), 4).alias("avg_sentiment"),
            round_half_up(share(F.col("sentiment_label") == "negative"), 4).alias("negative_share"),
            round_half_up(exact_avg("rating"), 4).alias("avg_rating"),
            F.countDistinct(columns.id).alias("customers_affected"),
        )
    )
    return measured.orderBy(F.desc("negative_share"), F.desc("documents"), "topic_id")


def plotted_themes(summary: DataFrame, k: int = 6, limit_first: bool = True) -> DataFrame:
    """Themes with any negative share; the limit applies before or after that filter."""
    ranked = summary.orderBy(F.desc("negative_share"), F.desc("documents"), "topic_id")
    negative = F.col("negative_share") > 0
    return ranked.limit(k).where(negative) if limit_first else ranked.where(negative).limit(k)


def portfolio_exposure(joined: DataFrame) -> DataFrame:
    """Probability-weighted annual margin at risk."""
    exposed = F.col("churn_probability") * F.col("annual_margin_at_risk")
    return joined.agg(exact_sum(exposed).alias("margin_at_risk"))


def campaign_totals(predictions: DataFrame, economics: s.Economics = s.ECONOMICS) -> DataFrame:
    """Cost, net value and return of contacting every targeted customer."""
    targeted = F.col("targeted_by_policy") == 1
    totals = predictions.agg(
        F.count_if(targeted).alias("targeted"),
        F.coalesce(exact_sum(F.when(targeted, F.col("expected_value_of_offer"))), F.lit(0.0)).alias(
            "campaign_net"
        ),
    )
    cost = F.col("targeted") * F.lit(economics.offer_cost)
    return totals.select(
        "targeted",
        cost.alias("campaign_cost"),
        "campaign_net",
        F.coalesce(F.try_divide(F.col("campaign_net") + cost, cost), F.lit(0.0)).alias("roi"),
    )


def headline_figures(features: DataFrame, columns: s.AccountColumns = s.ACCOUNTS) -> DataFrame:
    return features.agg(
        row_count().alias("n_customers"),
        exact_avg(columns.target).alias("churn_rate"),
        exact_sum(columns.monthly).alias("mrr"),
        exact_avg(columns.monthly).alias("arpu"),
        exact_avg(columns.tenure).alias("avg_tenure"),
    )


def high_risk_envelope(high_risk: DataFrame) -> DataFrame:
    """Count and margin of the rows returned by the (limited) high-risk list."""
    return high_risk.agg(
        row_count().alias("count"),
        F.coalesce(round_half_up(exact_sum("annual_margin_at_risk"), 2), F.lit(0.0)).alias(
            "total_margin_at_risk"
        ),
    )


def scoring_totals(predictions: DataFrame) -> DataFrame:
    """Rows scored, rows targeted, and the offer value over the targeted ones."""
    targeted = F.col("targeted_by_policy") == 1
    value = exact_sum(F.when(targeted, F.col("expected_value_of_offer")))
    return predictions.agg(
        row_count().alias("count"),
        F.count_if(targeted).alias("targeted"),
        F.coalesce(round_half_up(value, 2), F.lit(0.0)).alias("total_expected_value"),
    )


def counts_by(df: DataFrame, column: str) -> DataFrame:
    return df.groupBy(column).agg(row_count().alias("n"))


def column_medians(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """One row per column with its exact median (fitted, so known when this returns)."""
    medians = exact_median(df, names)
    return df.sparkSession.createDataFrame(
        [(name, medians[name]) for name in names], "feature string, median double"
    )


def cluster_centroids(assigned: DataFrame, features: Sequence[str], cluster: str) -> DataFrame:
    """Mean of each feature per cluster, in the original units."""
    return assigned.groupBy(cluster).agg(*[exact_avg(c).alias(c) for c in features])


def share_of_total(df: DataFrame, label: str, value: str) -> DataFrame:
    """Each label's part of the whole (a table with one row per label)."""
    whole = F.sum(value).over(Window.partitionBy())
    return df.select(label, value, F.coalesce(F.try_divide(F.col(value), whole), F.lit(0.0)).alias("share"))


def worst_verbatims(
    reviews: DataFrame, pool: int = 60, key_length: int = 40, k: int = 3
) -> DataFrame:
    """The worst reviews with distinct openings: first of each opening among the worst pool."""
    worst = reviews.orderBy("sentiment_score", "review_id").limit(pool)
    opening = Window.partitionBy("_opening").orderBy("sentiment_score", "review_id")
    return (
        worst.withColumn("_opening", F.substring("review_text", 1, key_length))
        .withColumn("_rn", F.row_number().over(opening))
        .where("_rn = 1")
        .orderBy("sentiment_score", "review_id")
        .limit(k)
        .select("review_id", "review_text", "rating", "channel", "sentiment_score")
    )
