"""Decision columns: offer value, risk band, recommended action."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidemark import settings as s


def margin_at_risk(monthly: Column, economics: s.Economics = s.ECONOMICS) -> Column:
    return monthly * F.lit(economics.margin) * F.lit(float(economics.horizon_months))


def expected_value(
    probability: Column, monthly: Column, economics: s.Economics = s.ECONOMICS
) -> Column:
    """Expected gain of one offer: chance of leaving × chance of saving × margin − cost."""
    saved = probability * F.lit(economics.save_rate) * margin_at_risk(monthly, economics)
    return saved - F.lit(economics.offer_cost)


def risk_band(probability: Column) -> Column:
    band = F.lit(s.LOWEST_RISK_BAND)
    for edge, name in reversed(s.RISK_BANDS):
        band = F.when(probability >= edge, F.lit(name)).otherwise(band)
    return band


def is_targeted(probability: Column, value: Column, threshold: float) -> Column:
    """Contact only at or above the threshold and only when the offer pays."""
    return (probability >= F.lit(threshold)) & (value > 0)


def recommended_action(probability: Column, targeted: Column, threshold: float) -> Column:
    return (
        F.when(targeted & (probability >= s.PRIORITY_PROBABILITY), s.ACTION_PRIORITY)
        .when(targeted, s.ACTION_OFFER)
        .when(probability >= F.lit(threshold), s.ACTION_MONITOR)
        .otherwise(s.ACTION_NONE)
    )
