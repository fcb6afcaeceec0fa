"""All registered queries. Importing the parts fills the registry."""

from __future__ import annotations

from tidemark.plans import (  # noqa: F401
    catalog_accounts,
    catalog_decisions,
    catalog_models,
    catalog_text,
)
from tidemark.plans.registry import ORACLES, QUERIES, Query, oracle_text


def queries() -> dict[str, Query]:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return {name: oracle_text(body) for name, body in ORACLES.items()}
