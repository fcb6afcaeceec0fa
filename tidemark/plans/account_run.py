"""Raw accounts and feedback to validated, cleaned and engineered tables."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark import settings as s
from tidemark.operators import cleaning, contract, features
from tidemark.session import ensure_checkpoint_dir
from tidemark.sources import files, tables


@dataclass(frozen=True)
class AccountRun:
    customers: DataFrame
    features: DataFrame
    reviews: DataFrame
    quality: DataFrame

    def summary(self) -> dict[str, int]:
        return {
            "customers": self.customers.count(),
            "features_rows": self.features.count(),
            "features_cols": len(self.features.columns),
            "reviews": self.reviews.count(),
            "quality_checks": self.quality.count(),
        }


def run_accounts(
    accounts: DataFrame,
    reviews: DataFrame | None,
    order_by: Sequence[Column],
    data_contract: s.DataContract = s.CONTRACT,
    columns: s.AccountColumns = s.ACCOUNTS,
    economics: s.Economics = s.ECONOMICS,
    fail_on_error: bool = True,
    order_columns: Sequence[str] = (),
) -> AccountRun:
    """Check the contract, stop on a blocking failure, clean, engineer, join feedback.

    The cleaned accounts feed several tables, so they are kept once. ``order_columns``
    only order the input; they are not part of the contract or the result.
    """
    ensure_checkpoint_dir(accounts.sparkSession)
    checked = contract.check_accounts(accounts.drop(*order_columns), data_contract, columns).checkpoint()
    contract.enforce(checked, fail_on_error)
    unique = cleaning.keep_first(accounts, columns.id, order_by).drop(*order_columns)
    clean = cleaning.coerce_and_repair(unique, columns).checkpoint()
    engineered = features.engineer_features(clean, columns, economics)
    if reviews is not None:
        per_customer = features.review_features(reviews, columns.id)
        engineered = features.add_review_features(engineered, per_customer, columns.id)
    else:
        reviews = accounts.sparkSession.createDataFrame(
            [], f"review_id string, {columns.id} string, review_date date, channel string, rating int, review_text string"
        )
    stamped = checked.withColumn("run_ts", F.current_timestamp())
    return AccountRun(clean, engineered, reviews, stamped)


def write_accounts(run: AccountRun, folder: str | None = None, snapshots: str | None = None) -> dict[str, int]:
    """The four tables (the quality history is appended) and columnar snapshots."""
    written = {
        tables.TABLES[name]: tables.write_table(df, tables.TABLES[name], folder=folder)
        for name, df in (("customers", run.customers), ("features", run.features), ("reviews", run.reviews))
    }
    quality = run.quality.drop("run_ts")
    written[tables.TABLES["quality"]] = tables.append_quality(quality, folder=folder)
    if snapshots:
        files.write_snapshot(run.features, snapshots, "features")
        files.write_snapshot(run.reviews, snapshots, "reviews")
    return written
