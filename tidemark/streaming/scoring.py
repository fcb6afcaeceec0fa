"""The same row-wise scoring and request rollup over streams."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark import settings as s
from tidemark.operators import modelling
from tidemark.plans.training_run import score_accounts


def score_stream(
    model: modelling.ChurnModel,
    accounts: DataFrame,
    columns: s.AccountColumns = s.ACCOUNTS,
    economics: s.Economics = s.ECONOMICS,
) -> DataFrame:
    """Decisions for a stream of raw accounts.

    Stateless: nulls take the medians fitted in training, kept in the model.
    """
    if not model.medians:
        raise ValueError("a stream needs the medians fitted in training")
    return score_accounts(model, accounts, columns, economics)


def rollup_stream(
    log: DataFrame,
    path: str = "path",
    latency: str = "latency_ms",
    failed: str = "failed",
    ts: str = "ts",
    window: str = "1 hour",
    late: str = "10 minutes",
) -> DataFrame:
    """Requests, errors and approximate latency quantiles per path and time window."""
    served = F.when(~F.col(failed), F.col(latency))
    quantiles = F.percentile_approx(served, [0.5, 0.95])
    return (
        log.withColumn(ts, F.col(ts).cast("timestamp"))
        .withWatermark(ts, late)
        .groupBy(F.window(ts, window), path)
        .agg(
            F.count_if(~F.col(failed)).alias("requests"),
            F.count_if(F.col(failed)).alias("errors"),
            quantiles.alias("q"),
        )
        .select(
            F.col("window.start").alias("window_start"), path, "requests", "errors",
            F.col("q")[0].alias("p50_ms"), F.col("q")[1].alias("p95_ms"),
        )
    )
