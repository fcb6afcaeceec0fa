"""Scoring and question requests as tables: contract checks and the request-log rollup."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark import settings as s
from tidemark.functions.numbers import parse_number, round_half_up
from tidemark.operators.ranking import top_k

# Limits of a request.
TENURE_RANGE = (0, 200)
QUESTION_LENGTH = (3, 500)
TOP_K_RANGE = (1, 25)
BATCH_SIZE = (1, 1000)


def _with_reasons(df: DataFrame, checks: dict[str, Column]) -> DataFrame:
    reasons = F.array(*[F.when(broken, F.lit(reason)) for reason, broken in checks.items()])
    return df.withColumn("reasons", F.array_compact(reasons)).withColumn(
        "accepted", F.size("reasons") == 0
    )


def _missing_or(value: Column, broken: Column) -> Column:
    return value.isNull() | F.coalesce(broken, F.lit(False))


def check_scoring_requests(df: DataFrame, columns: s.AccountColumns = s.ACCOUNTS) -> DataFrame:
    """Add the list of broken rules and whether the row is accepted. Extra columns stay."""
    tenure, monthly = parse_number(columns.tenure), parse_number(columns.monthly)
    checks = {
        f"{columns.tenure}: required, {TENURE_RANGE[0]} to {TENURE_RANGE[1]}": _missing_or(
            tenure, ~tenure.between(*TENURE_RANGE)
        ),
        f"{columns.monthly}: required, not negative": _missing_or(monthly, monthly < 0),
    }
    if columns.total in df.columns:
        total = parse_number(columns.total)
        given = F.col(columns.total).isNotNull()
        checks[f"{columns.total}: a number, not negative"] = given & _missing_or(total, total < 0)
    return _with_reasons(df, checks)


def check_batches(df: DataFrame, batch_column: str) -> DataFrame:
    """Size of each batch and whether it is within bounds (counted, never collected)."""
    sized = df.groupBy(batch_column).agg(F.count(F.lit(1)).alias("size"))
    return sized.withColumn("accepted", F.col("size").between(*BATCH_SIZE))


def check_questions(df: DataFrame, question: str = "question", top_k_column: str = "top_k") -> DataFrame:
    length = F.length(question)
    checks = {
        f"question: {QUESTION_LENGTH[0]} to {QUESTION_LENGTH[1]} characters": _missing_or(
            F.col(question), ~length.between(*QUESTION_LENGTH)
        )
    }
    if top_k_column in df.columns:
        k = F.col(top_k_column)
        checks[f"top_k: {TOP_K_RANGE[0]} to {TOP_K_RANGE[1]}"] = k.isNotNull() & ~k.between(*TOP_K_RANGE)
    return _with_reasons(df, checks)


def last_requests(log: DataFrame, path: str, order_by: list[Column], last: int = 500) -> DataFrame:
    """The newest requests of each path; busy paths are cut before the shuffle."""
    return top_k(log, [path], order_by, last).drop("rank")


def request_rollup(
    log: DataFrame,
    path: str = "path",
    latency: str = "latency_ms",
    order_by: list[Column] | None = None,
    failed: str = "failed",
    last: int = 500,
) -> DataFrame:
    """Requests and errors per path, and exact latency quantiles over the newest ones.

    Failed requests count as errors only: they have no latency.
    """
    counters = log.groupBy(path).agg(
        F.count_if(~F.col(failed)).alias("requests"), F.count_if(F.col(failed)).alias("errors")
    )
    newest = last_requests(log.where(~F.col(failed)), path, order_by or [F.desc("ts")], last)
    quantiles = newest.groupBy(path).agg(
        F.count(F.lit(1)).alias("count"),
        F.percentile(latency, F.array(F.lit(0.5), F.lit(0.95))).alias("q"),
    )
    return counters.join(quantiles, path, "left").select(
        path, "requests", "errors",
        F.coalesce("count", F.lit(0)).alias("count"),
        round_half_up(F.col("q")[0], 2).alias("p50_ms"),
        round_half_up(F.col("q")[1], 2).alias("p95_ms"),
    )
