"""Word lists and lookup texts used by the text operators. All are fixed values."""

from __future__ import annotations

# Support-desk words that carry no topic signal.
DOMAIN_STOPWORDS = (
    "customer", "service", "company", "please", "thanks", "thank", "hi", "hello",
    "regards", "team", "im", "ive", "dont", "didnt", "would", "could", "really",
    "also", "still", "just", "get", "got", "one", "even", "back", "since",
)

# Weighted negative words.
NEGATIVE_WORDS = {
    "unusable": 2.0, "unacceptable": 2.0, "terrible": 2.0, "awful": 2.0, "worst": 2.0,
    "slow": 1.2, "late": 1.2, "delay": 1.3, "delayed": 1.3, "dropping": 1.2, "outage": 1.6,
    "outages": 1.6, "charged": 1.0, "overcharged": 1.8, "mess": 1.4, "broken": 1.6,
    "poor": 1.4, "bad": 1.3, "complain": 1.3, "complained": 1.3, "cancel": 1.7,
    "cancelled": 1.5, "refund": 1.2, "waiting": 1.0, "never": 1.0, "again": 0.4,
    "painfully": 1.5, "problem": 1.2, "issue": 0.9, "fail": 1.6, "failed": 1.6,
}

# Weighted positive words.
POSITIVE_WORDS = {
    "excellent": 2.0, "great": 1.6, "good": 1.2, "reliable": 1.5, "solid": 1.4,
    "fast": 1.2, "quick": 1.2, "helpful": 1.5, "love": 1.7, "perfect": 1.8,
    "resolved": 1.4, "fixed": 1.3, "happy": 1.5, "recommend": 1.4, "value": 1.0,
    "better": 1.0, "smooth": 1.3, "easy": 1.1,
}

# Words that flip the polarity of the two words after them, and by how much.
NEGATORS = ("not", "no", "never", "cannot", "cant", "dont", "didnt", "wasnt", "isnt")
NEGATION_FACTOR = -0.8
NEGATION_REACH = 2

# Score above / below which a text is positive / negative.
LABEL_EDGE = 0.15

# Question words and the corpus vocabulary they stand for.
QUERY_EXPANSIONS = {
    "leaving": "churn cancel cancelled attrition switch left",
    "leave": "churn cancel attrition switch",
    "churn": "leaving cancel attrition retention",
    "unhappy": "complaint negative dissatisfied poor bad",
    "complaints": "negative unhappy issue problem",
    "revenue": "charges billing monthly arpu margin",
    "price": "charges cost billing expensive increase",
    "support": "ticket agent help service technical",
    "delivery": "shipment late delayed warehouse",
    "risk": "churn probability high-risk retention",
    "loyal": "tenure long-standing contract retention",
}

# Model input → (plain-English reason, action when it raises risk).
DRIVER_NARRATIVES = {
    "tenure": ("short tenure with the company", "Enrol in the first-year onboarding and check-in programme"),
    "MonthlyCharges": ("high monthly charges", "Review plan fit; offer a right-sized bundle"),
    "TotalCharges": ("low lifetime billing to date", "Too early to be loyal — prioritise early-life engagement"),
    "charge_drift": ("recent price increase versus their historical average",
                     "Grandfather the previous rate or offer a loyalty credit"),
    "charge_drift_pct": ("bill rising faster than their historical average", "Proactive bill-shock outreach"),
    "avg_charge_per_month": ("high average spend", "Confirm they are on the best available tariff"),
    "services_count": ("few products held", "Cross-sell a sticky add-on (security or support)"),
    "has_premium_support": ("no premium support attached", "Offer 3 months of TechSupport free"),
    "is_month_to_month": ("month-to-month contract", "Offer a discounted 12-month contract"),
    "is_manual_payment": ("manual payment method", "Incentivise switching to autopay"),
    "is_new_customer": ("still in the first six months", "Assign to the new-customer nurture track"),
    "avg_rating": ("low average feedback rating", "Route to a service-recovery specialist"),
    "min_rating": ("at least one very negative review", "Service recovery call within 48 hours"),
    "has_negative_review": ("logged a negative review", "Service recovery call within 48 hours"),
    "review_count": ("frequent support contact", "Investigate the underlying unresolved issue"),
    "Contract_Month-to-month": ("month-to-month contract", "Offer a discounted 12-month contract"),
    "Contract_Two year": ("two-year contract", "Low-risk — no action needed"),
    "InternetService_Fiber optic": ("fibre service (historically higher churn)",
                                    "Check line quality and recent outage history"),
    "PaymentMethod_Electronic check": ("paying by electronic check",
                                       "Offer a discount for switching to autopay"),
    "TechSupport_No": ("no tech-support package", "Offer 3 months of TechSupport free"),
    "OnlineSecurity_No": ("no online-security package", "Bundle security at no extra cost for 3 months"),
}
DEFAULT_DRIVER_ACTION = "Review with the segment owner"
NO_DRIVER_ACTION = "—"
RAISES_RISK = "increases risk"
LOWERS_RISK = "reduces risk"
