"""Scored customers to decisions: offer value, policy, call lists, scenarios."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark import settings as s
from tidemark.functions import economics as econ
from tidemark.functions.numbers import exact_sum, round_half_up

# Candidate thresholds, 0.05 to 0.95 in steps of 0.01, as the doubles
# that numpy's arange produces (they decide ties with a probability of exactly 0.29).
THRESHOLD_GRID = tuple(float(t) for t in np.arange(0.05, 0.96, 0.01))


def decide(
    scored: DataFrame,
    threshold: float,
    economics: s.Economics = s.ECONOMICS,
    columns: s.AccountColumns = s.ACCOUNTS,
    probability: str = "churn_probability",
    scored_at: Column | None = None,
) -> DataFrame:
    """The decision table: one row per scored customer.

    Targeting uses the unrounded offer value; the stored value has two decimals.
    """
    p, monthly = F.col(probability), F.col(columns.monthly)
    value = econ.expected_value(p, monthly, economics)
    targeted = F.coalesce(econ.is_targeted(p, value, threshold), F.lit(False))
    return scored.select(
        F.col(columns.id).cast("string").alias(columns.id),
        p.alias("churn_probability"),
        econ.risk_band(p).alias("risk_band"),
        round_half_up(value, 2).alias("expected_value_of_offer"),
        round_half_up(econ.margin_at_risk(monthly, economics), 2).alias("margin_at_risk"),
        targeted.cast("int").alias("targeted_by_policy"),
        (F.current_timestamp() if scored_at is None else scored_at).alias("scored_at"),
        econ.recommended_action(p, targeted, threshold).alias("recommended_action"),
    )


def decision_response(predictions: DataFrame, threshold: float, model: str) -> DataFrame:
    """The rounded, typed columns a consumer receives."""
    return predictions.select(
        F.col(s.ACCOUNTS.id).alias("customer_id"),
        round_half_up("churn_probability", 4).alias("churn_probability"),
        "risk_band",
        F.lit(threshold).alias("decision_threshold"),
        "expected_value_of_offer",
        (F.col("targeted_by_policy") == 1).alias("targeted_by_policy"),
        "recommended_action",
        F.lit(model).alias("model"),
    )


def response_violations(response: DataFrame) -> DataFrame:
    """Rows outside the closed vocabularies or the probability range (normally none)."""
    actions = (s.ACTION_PRIORITY, s.ACTION_OFFER, s.ACTION_MONITOR, s.ACTION_NONE)
    good = (
        F.col("risk_band").isin(*s.RISK_BAND_ORDER)
        & F.col("recommended_action").isin(*actions)
        & F.col("churn_probability").between(0.0, 1.0)
    )
    return response.where(~F.coalesce(good, F.lit(False)))


def with_account_columns(
    predictions: DataFrame, features: DataFrame, columns: s.AccountColumns = s.ACCOUNTS
) -> DataFrame:
    """Predictions with the five account columns the reports show (left join)."""
    shown = [columns.id, columns.tenure, columns.monthly, columns.contract, "annual_margin_at_risk"]
    return predictions.join(features.select(*shown), columns.id, "left")


def high_risk(
    predictions: DataFrame,
    features: DataFrame,
    threshold: float = 0.55,
    limit: int = 100,
    columns: s.AccountColumns = s.ACCOUNTS,
) -> DataFrame:
    """Customers at or above the threshold, best offer value first."""
    wanted = predictions.where(F.col("churn_probability") >= threshold)
    return (
        wanted.join(features, columns.id)
        .orderBy(F.desc("expected_value_of_offer"), columns.id)
        .limit(limit)
        .select(
            columns.id,
            round_half_up("churn_probability", 4).alias("churn_probability"),
            "risk_band",
            "recommended_action",
            round_half_up("expected_value_of_offer", 2).alias("expected_value_of_offer"),
            columns.tenure,
            columns.monthly,
            columns.contract,
            round_half_up("annual_margin_at_risk", 2).alias("annual_margin_at_risk"),
        )
    )


def targeted_only(predictions: DataFrame) -> DataFrame:
    return predictions.where("targeted_by_policy = 1")


def call_list(joined: DataFrame, k: int = 12, columns: s.AccountColumns = s.ACCOUNTS) -> DataFrame:
    """The k targeted customers with the best stored offer value."""
    return (
        targeted_only(joined)
        .orderBy(F.desc("expected_value_of_offer"), columns.id)
        .limit(k)
        .select(
            columns.id, "risk_band", "churn_probability", columns.tenure, columns.monthly,
            columns.contract, "expected_value_of_offer",
        )
    )


def repriced_call_list(
    joined: DataFrame,
    threshold: float,
    economics: s.Economics,
    k: int | None = 200,
    columns: s.AccountColumns = s.ACCOUNTS,
) -> DataFrame:
    """The call list under other economics; ``k=None`` gives the whole list for export."""
    p = F.col("churn_probability")
    priced = joined.withColumn("ev", econ.expected_value(p, F.col(columns.monthly), economics))
    listed = priced.where(econ.is_targeted(p, F.col("ev"), threshold)).orderBy(F.desc("ev"), columns.id)
    if k is not None:
        listed = listed.limit(k)
    return listed.select(
        columns.id, "risk_band", p.alias("p_churn"), columns.tenure, columns.monthly, columns.contract,
        F.col("ev").alias("expected_value"), "recommended_action",
    )


def price_scenarios(
    scored: DataFrame,
    scenarios: Sequence[Mapping[str, float]],
    columns: s.AccountColumns = s.ACCOUNTS,
) -> DataFrame:
    """Campaign totals under each scenario, in one pass over the scored base.

    A scenario names offer_cost, save_rate, margin, horizon_months and threshold. The
    short list is exploded inside each row and summed before the shuffle.
    """
    names = ("offer_cost", "save_rate", "margin", "horizon_months", "threshold")
    listed = F.array(
        *[
            F.struct(F.lit(i).alias("scenario"), *[F.lit(float(sc[n])).alias(n) for n in names])
            for i, sc in enumerate(scenarios)
        ]
    )
    p = F.col("churn_probability")
    rows = scored.select(p, columns.monthly, F.inline(listed))
    at_risk = F.col(columns.monthly) * F.col("margin") * F.col("horizon_months")
    value = p * F.col("save_rate") * at_risk - F.col("offer_cost")
    targeted = (p >= F.col("threshold")) & (value > 0)
    totals = rows.groupBy("scenario", "offer_cost").agg(
        F.count_if(targeted).alias("targeted"),
        F.coalesce(exact_sum(F.when(targeted, value)), F.lit(0.0)).alias("net_saving"),
        exact_sum(p * at_risk).alias("exposure"),
    )
    cost = F.col("targeted") * F.col("offer_cost")
    return totals.select(
        "scenario", "targeted", cost.alias("campaign_cost"), "net_saving",
        F.coalesce(F.try_divide(F.col("net_saving") + cost, cost), F.lit(0.0)).alias("roi"), "exposure",
    )


def threshold_sweep(
    scored: DataFrame,
    grid: Sequence[float] = THRESHOLD_GRID,
    economics: s.Economics = s.ECONOMICS,
    columns: s.AccountColumns = s.ACCOUNTS,
    label: str = "label",
) -> DataFrame:
    """What each threshold would target: one pass bins the rows, the rest is grid-sized.

    Negative offer values count here, as the policy contacts everyone at or above t.
    """
    p = F.col("churn_probability")
    thresholds = F.array(*[F.lit(t) for t in grid])
    reached = F.size(F.filter(thresholds, lambda t: t <= p))
    value = econ.expected_value(p, F.col(columns.monthly), economics)
    binned = (
        scored.select(reached.alias("bin"), value.alias("value"), F.col(label).alias("y"))
        .groupBy("bin")
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.sum(F.col("value").cast("decimal(28,6)")).alias("net"),
            F.sum(F.col("y").cast("long")).alias("hits"),
        )
    )
    # At most len(grid) + 1 rows from here on.
    upto = Window.orderBy(F.desc("bin")).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    everyone = Window.partitionBy()
    swept = binned.select(
        "bin",
        F.sum("n").over(upto).alias("n_targeted"),
        F.sum("net").over(upto).alias("net"),
        F.sum("hits").over(upto).alias("hits"),
        F.sum("hits").over(everyone).alias("positives"),
    )
    # A threshold between two occupied bins targets the same customers as the next one up.
    lower = F.coalesce(F.lag("bin").over(Window.orderBy("bin")), F.lit(0))
    return (
        swept.where("bin > 0")
        .withColumn("lower", lower)
        .withColumn("step", F.explode(F.sequence(F.col("lower") + 1, F.col("bin"))))
        .withColumn("threshold", F.element_at(thresholds, F.col("step")))
        .select("step", "threshold", "n_targeted", "net", "hits", "positives")
    )


def choose_threshold(
    scored: DataFrame,
    grid: Sequence[float] = THRESHOLD_GRID,
    economics: s.Economics = s.ECONOMICS,
    columns: s.AccountColumns = s.ACCOUNTS,
    label: str = "label",
) -> DataFrame:
    """The policy that earns most; the lowest threshold on ties; 0.5 when none targets anyone."""
    swept = threshold_sweep(scored, grid, economics, columns, label)
    best = swept.agg(
        F.max_by(
            F.struct("threshold", "n_targeted", "net", "hits", "positives"),
            F.struct(F.col("net"), -F.col("step")),
        ).alias("b")
    )
    n = F.coalesce("b.n_targeted", F.lit(0))
    net = F.coalesce(F.col("b.net").cast("double"), F.lit(0.0))
    cost = n * F.lit(economics.offer_cost)
    hits = F.col("b.hits").cast("double")
    zero = F.lit(0.0)
    return best.select(
        round_half_up(F.coalesce("b.threshold", F.lit(0.5)), 3).alias("threshold"),
        n.alias("n_targeted"),
        round_half_up(net, 2).alias("expected_net_saving"),
        round_half_up(cost, 2).alias("campaign_cost"),
        F.coalesce(round_half_up(F.try_divide(net + cost, cost), 3), zero).alias("roi"),
        F.lit(economics.offer_cost).alias("offer_cost"),
        F.lit(economics.save_rate).alias("offer_success_rate"),
        F.lit(economics.horizon_months).alias("horizon_months"),
        F.coalesce(round_half_up(F.try_divide(hits, n.cast("double")), 4), zero).alias("precision_at_threshold"),
        F.coalesce(round_half_up(F.try_divide(hits, F.col("b.positives").cast("double")), 4), zero).alias(
            "recall_at_threshold"
        ),
    )
