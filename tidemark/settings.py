"""Names, thresholds and economics, passed to operators as parameters."""

from __future__ import annotations

from dataclasses import dataclass, field

# The service flags that count as products held.
SERVICE_COLUMNS = (
    "PhoneService",
    "MultipleLines",
    "OnlineSecurity",
    "OnlineBackup",
    "DeviceProtection",
    "TechSupport",
    "StreamingTV",
    "StreamingMovies",
)

# Upper edges (inclusive) and labels of the tenure buckets. The first
# bucket starts just below zero so that tenure 0 belongs to it.
TENURE_FLOOR = -0.1
TENURE_EDGES = (6.0, 12.0, 24.0, 48.0, float("inf"))
TENURE_LABELS = ("0-6m", "6-12m", "1-2y", "2-4y", "4y+")

# Payment methods that need a manual step every month.
MANUAL_PAYMENT_METHODS = ("Electronic check", "Mailed check")

# Spellings of a churned customer when cleaning and when training.
CHURNED_WORDS = ("yes", "y", "true", "1", "churned")
TRAINING_CHURNED_WORDS = ("yes", "y", "true", "1")

# Lower edges of the risk bands, highest first, and display order.
RISK_BANDS = ((0.70, "Critical"), (0.50, "High"), (0.30, "Medium"))
LOWEST_RISK_BAND = "Low"
RISK_BAND_ORDER = ("Low", "Medium", "High", "Critical")

# The next step shown for a scored customer.
ACTION_PRIORITY = "Priority save call + retention offer"
ACTION_OFFER = "Retention offer / contract upgrade"
ACTION_MONITOR = "Monitor — offer not economic at this margin"
ACTION_NONE = "No action"
PRIORITY_PROBABILITY = 0.70


@dataclass(frozen=True)
class AccountColumns:
    """Column names of the account table, so operators run on any star schema."""

    id: str = "customerID"
    tenure: str = "tenure"
    monthly: str = "MonthlyCharges"
    total: str = "TotalCharges"
    senior: str = "SeniorCitizen"
    contract: str = "Contract"
    payment: str = "PaymentMethod"
    target: str = "Churn"
    services: tuple[str, ...] = SERVICE_COLUMNS
    premium: tuple[str, ...] = ("TechSupport", "OnlineSecurity")


@dataclass(frozen=True)
class Economics:
    """What a retention offer costs and saves. The defaults are fixed values."""

    margin: float = 0.35
    offer_cost: float = 45.0
    save_rate: float = 0.30
    horizon_months: int = 12


@dataclass(frozen=True)
class DataContract:
    """Expectations on the raw account table. The defaults are fixed values."""

    required: tuple[str, ...] = (
        "customerID",
        "tenure",
        "MonthlyCharges",
        "TotalCharges",
        "Contract",
        "Churn",
    )
    max_null_fraction: float = 0.05
    max_duplicate_fraction: float = 0.0
    ranges: dict[str, tuple[float, float]] = field(
        default_factory=lambda: {
            "tenure": (0, 100),
            "MonthlyCharges": (0, 1000),
            "TotalCharges": (0, 100000),
        }
    )
    base_rate: tuple[float, float] = (0.02, 0.80)


ACCOUNTS = AccountColumns()
ECONOMICS = Economics()
CONTRACT = DataContract()
