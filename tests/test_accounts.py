"""Contract, cleaning, features and KPIs on hand-written rows."""

from __future__ import annotations

import random
import statistics

import pytest
from pyspark.sql import functions as F

from tidemark import settings as s
from tidemark.functions.numbers import parse_number, round_half_up
from tidemark.operators import cleaning, contract, features, kpi
from tidemark.operators.quantiles import exact_quantiles
from tidemark.plans import account_run

SCHEMA = (
    "customerID string, SeniorCitizen string, Partner string, tenure string, TechSupport string, "
    "OnlineSecurity string, Contract string, PaymentMethod string, MonthlyCharges string, "
    "TotalCharges string, Churn string, seq int"
)
ROWS = [
    ("a", "0", "Yes", "0", "Yes", "No", "Month-to-month", "Electronic check", "50", " ", "No", 1),
    ("b", "1", None, "10", "No", "No", "One year", "Mailed check", "60.5", "700", "Yes", 2),
    ("b", "1", None, "10", "No", "No", "One year", "Mailed check", "60.5", "700", "Yes", 3),
    ("b", "1", "No", "11", "No", "No", "One year", "Mailed check", "61", "701", "Yes", 4),
    ("c", None, "No", "30", "No", "Yes", "Two year", "Card", "20", "x", " YES ", 5),
    ("d", "0", "No", None, "No", "No", None, "Card", "80", "160", "churned", 6),
    ("e", "0", "No", "72", None, "Yes", "Two year", "Card", "100", "7000", "no", 7),
]


@pytest.fixture()
def raw(spark):
    return spark.createDataFrame(ROWS, SCHEMA)


def by_id(df):
    return {r["customerID"]: r for r in df.collect()}


def test_parse_number(spark):
    rows = [(" 12.5 ", 12.5), (" ", None), ("", None), ("abc", None), ("nan", None), ("1e3", 1000.0), ("1.5d", None), (None, None)]
    df = spark.createDataFrame(rows, "text string, wanted double")
    for r in df.select("wanted", parse_number("text").alias("got")).collect():
        assert r["got"] == r["wanted"]


def test_rounding_does_not_follow_binary_noise(spark):
    df = spark.createDataFrame([(1.005, 1.01), (2.675, 2.68), (-0.125, -0.13)], "x double, wanted double")
    for r in df.select("wanted", round_half_up("x", 2).alias("got")).collect():
        assert r["got"] == r["wanted"]


def test_exact_duplicates_and_first_per_key(raw):
    assert cleaning.drop_exact_duplicates(raw.drop("seq")).count() == 6
    kept = by_id(cleaning.keep_first(raw, "customerID", [F.asc("seq")]))
    assert kept["b"]["seq"] == 2 and len(kept) == 5
    last = by_id(cleaning.keep_first(raw, "customerID", [F.desc("seq")]))
    assert last["b"]["seq"] == 4


def test_hot_keys_are_cut_before_the_shuffle(raw):
    plan = cleaning.keep_first(raw, "customerID", [F.asc("seq")])._jdf.queryExecution().toString()
    assert "WindowGroupLimit" in plan


def test_repair_follows_the_rules(raw):
    rows = by_id(cleaning.clean_accounts(raw, [F.asc("seq")]))
    assert rows["a"]["TotalCharges"] == 0.0  # blank: 50 × 0
    assert rows["c"]["TotalCharges"] == 600.0  # unparseable: 20 × 30
    assert rows["b"]["Partner"] == "Unknown" and rows["d"]["Contract"] == "Unknown"
    assert rows["d"]["tenure"] == 20.0  # median of 0, 10, 30, 72
    assert rows["c"]["SeniorCitizen"] == 0.0
    assert {k: r["Churn"] for k, r in rows.items()} == {"a": 0, "b": 1, "c": 1, "d": 1, "e": 0}


def test_target_vocabularies_differ(spark):
    df = spark.createDataFrame([("churned",), ("Y",), ("1",), ("no",), (None,)], "Churn string")
    assert [r[0] for r in cleaning.decode_target(df).collect()] == [1, 1, 1, 0, 0]
    assert [r[0] for r in cleaning.training_target(df).collect()] == [0, 1, 1, 0, 0]
    whole = spark.createDataFrame([(1,), (0,)], "Churn int")
    assert cleaning.decode_target(whole).schema == whole.schema
    decimal = spark.createDataFrame([(1.0,)], "Churn double")
    assert cleaning.decode_target(decimal).first()[0] == 0  # its text is "1.0"


def test_scoring_keeps_every_row(raw):
    same = raw.where("customerID = 'b'").drop("customerID", "seq")
    assert features.prepare_for_scoring(same).count() == 3


def test_scoring_accepts_fitted_medians(raw):
    one = raw.where("customerID = 'd'").drop("seq")
    out = features.prepare_for_scoring(one, medians={"tenure": 33.0}).first()
    assert out["tenure"] == 33.0


def test_engineered_features(raw):
    rows = by_id(features.engineer_features(cleaning.clean_accounts(raw, [F.asc("seq")])))
    a, b, e = rows["a"], rows["b"], rows["e"]
    assert a["avg_charge_per_month"] == 50.0 and a["charge_drift"] == 0.0  # tenure 0: the monthly charge
    assert b["avg_charge_per_month"] == 70.0 and b["charge_drift"] == pytest.approx(-9.5)
    assert b["charge_drift_pct"] == pytest.approx(-9.5 / 70)
    assert (a["tenure_bucket"], b["tenure_bucket"], e["tenure_bucket"]) == ("0-6m", "6-12m", "4y+")
    assert (a["is_new_customer"], b["is_new_customer"]) == (1, 0)
    assert (a["has_premium_support"], b["has_premium_support"], e["has_premium_support"]) == (1, 0, 1)
    assert (a["services_count"], e["services_count"]) == (1, 1)
    assert (a["is_month_to_month"], b["is_month_to_month"]) == (1, 0)
    assert (a["is_manual_payment"], b["is_manual_payment"], e["is_manual_payment"]) == (1, 1, 0)
    assert b["annual_margin_at_risk"] == pytest.approx(60.5 * 12 * 0.35)


def test_zero_average_gives_zero_drift_share(spark):
    df = spark.createDataFrame([("z", 5.0, 0.0, 0.0)], "customerID string, tenure double, MonthlyCharges double, TotalCharges double")
    assert features.engineer_features(df).first()["charge_drift_pct"] == 0.0


def test_tenure_bucket_edges(spark):
    df = spark.createDataFrame([(0.0,), (6.0,), (6.5,), (12.0,), (48.0,), (49.0,), (-1.0,), (None,)], "t double")
    got = [r[0] for r in df.select(features.tenure_bucket(F.col("t"))).collect()]
    assert got == ["0-6m", "0-6m", "6-12m", "6-12m", "2-4y", "4y+", None, None]
    parity = [r[0] for r in df.select(features.tenure_bucket(F.col("t"), outside="nan")).collect()]
    assert parity[-2:] == ["nan", "nan"]


def test_review_features_and_fills(spark):
    reviews = spark.createDataFrame(
        [("r1", "a", 1, "2024-01-01"), ("r2", "a", 4, "2024-02-01"), ("r3", "b", 5, "2024-01-05"), ("r4", None, 1, "2024-01-05"), ("r5", "x", 1, "2024-01-05")],
        "review_id string, customerID string, rating int, review_date string",
    )
    per_customer = features.review_features(reviews)
    base = spark.createDataFrame([("a",), ("b",), ("c",)], "customerID string")
    rows = by_id(features.add_review_features(base, per_customer))
    assert (rows["a"]["review_count"], rows["a"]["avg_rating"], rows["a"]["min_rating"]) == (2, 2.5, 1.0)
    assert rows["a"]["has_negative_review"] == 1 and rows["b"]["has_negative_review"] == 0
    # No feedback: the median of 2.5 and 5.0; "x" is not a customer and does not count.
    assert (rows["c"]["review_count"], rows["c"]["avg_rating"], rows["c"]["min_rating"]) == (0, 3.75, 3.75)
    assert rows["c"]["has_negative_review"] == 0 and "last_review_date" not in rows["a"].asDict()


@pytest.mark.parametrize("limit", [50_000, 20, 1])
def test_exact_quantiles_match_brute_force(spark, limit):
    rng = random.Random(5)
    hot = [7.0] * 400 + [rng.uniform(-50, 50) for _ in range(800)] + [None] * 30
    wide = [float(rng.randrange(10**6)) for _ in range(1229)] + [None]
    rng.shuffle(hot)
    df = spark.createDataFrame(list(zip(hot, wide, [None] * 1230, strict=True)), "a double, b double, c double")
    got = exact_quantiles(df, ["a", "b", "c"], 0.5, bracket_limit=limit)
    assert got["a"] == pytest.approx(statistics.median(x for x in hot if x is not None))
    assert got["b"] == pytest.approx(statistics.median(x for x in wide if x is not None))
    assert got["c"] is None
    q95 = exact_quantiles(df, ["b"], 0.95, bracket_limit=limit)["b"]
    ordered = sorted(x for x in wide if x is not None)
    at = 0.95 * (len(ordered) - 1)
    low = int(at)
    assert q95 == pytest.approx(ordered[low] + (ordered[low + 1] - ordered[low]) * (at - low))


def test_quantiles_past_a_bracket_that_missed(spark, monkeypatch):
    """A bracket of single values misses most ranks, NaN is the largest value, ties fill brackets."""
    from tidemark.operators import quantiles

    rng = random.Random(11)
    wide = [rng.uniform(-1, 1) for _ in range(4001)]
    tied = [3.0] * 2500 + [float(x) for x in range(1501)]
    late = [float("nan")] * 3000 + [rng.uniform(0, 1) for _ in range(1001)]
    endless = [float("-inf")] * 2500 + [float("inf")] * 1501
    names = ["wide", "tied", "late", "endless"]
    data = spark.createDataFrame(
        list(zip(wide, tied, late, endless, strict=True)), ", ".join(f"{n} double" for n in names)
    ).repartition(5)
    for margin in (quantiles.MARGIN, 0.0):
        monkeypatch.setattr(quantiles, "MARGIN", margin)
        for p in (0.0, 0.25, 0.5, 1.0):
            got = exact_quantiles(data, names, p, bracket_limit=100)
            at = int(4000 * p)
            assert got["wide"] == sorted(wide)[at] and got["tied"] == sorted(tied)[at]
            assert got["endless"] == sorted(endless)[at]
            numbers = sorted(late[3000:])
            assert got["late"] == numbers[at] if at < 1001 else got["late"] != got["late"]
    known = exact_quantiles(data, ["wide"], 0.5, bracket_limit=100, counts={"wide": 4001})
    assert known == {"wide": sorted(wide)[2000]}
    empty = data.limit(0)
    assert exact_quantiles(empty, ["wide", "late"]) == {"wide": None, "late": None}
    assert exact_quantiles(data, []) == {}


def test_quantiles_take_two_scans(spark, tmp_path):
    """However many columns: one scan for the sketches, one for the counts."""
    scans = spark.sparkContext.accumulator(0)

    def counted(batches):
        for batch in batches:
            scans.add(batch.num_rows)
            yield batch

    n = 3000
    rows = spark.range(n).selectExpr(*[f"cast(hash(id, {k}) as double) as c{k}" for k in range(6)])
    watched = rows.mapInArrow(counted, rows.schema)
    got = exact_quantiles(watched, watched.columns, 0.5, bracket_limit=10)
    assert scans.value == 2 * n
    whole = rows.toPandas().median()
    assert all(got[c] == pytest.approx(whole[c]) for c in watched.columns)


# ---------------------------------------------------------------- contract

CHECKED = s.DataContract(ranges={"tenure": (0, 100), "MonthlyCharges": (0, 1000)})


def report_of(df):
    return {(r["check"], r["column"]): r for r in contract.check_accounts(df, CHECKED).collect()}


def test_clean_contract(raw):
    report = report_of(raw.drop("seq").dropDuplicates())
    assert report[("column_exists", "Churn")]["status"] == "PASS"
    assert report[("null_fraction", "TotalCharges")]["observed"] == 0.0  # a blank is not null
    assert report[("null_fraction", "tenure")]["status"] == "WARN"
    assert report[("value_in_range", "tenure")]["status"] == "PASS"  # null counts as in range
    assert report[("duplicate_fraction", "<row>")]["status"] == "PASS"


def test_missing_column_blocks(raw):
    checked = contract.check_accounts(raw.drop("Contract", "seq"), CHECKED)
    with pytest.raises(contract.ContractBroken, match="column_exists:Contract"):
        contract.enforce(checked)
    assert contract.enforce(checked, fail_on_error=False) is checked


def test_out_of_range_blocks(raw):
    spoilt = raw.drop("seq").withColumn("tenure", F.when(F.col("customerID") == "e", "9999").otherwise(F.col("tenure")))
    with pytest.raises(contract.ContractBroken, match="value_in_range:tenure"):
        contract.enforce(contract.check_accounts(spoilt, CHECKED))


def test_duplicates_only_warn(raw):
    report = report_of(raw.drop("seq"))
    row = report[("duplicate_fraction", "<row>")]
    assert row["status"] == "WARN" and row["detail"].startswith("1 exact duplicate rows")
    assert row["observed"] == pytest.approx(1 / 7, abs=1e-5)


def test_base_rate_knows_only_yes(raw):
    row = report_of(raw.drop("seq"))[("target_base_rate", "Churn")]
    assert row["observed"] == pytest.approx(4 / 7, abs=1e-5)  # " YES " counts, "churned" does not
    numbers = raw.drop("seq").withColumn("Churn", F.lit(1))
    assert report_of(numbers)[("target_base_rate", "Churn")]["status"] == "FAIL"


def test_status_summary_and_auc_gate(spark, raw):
    summary = contract.status_summary(contract.check_accounts(raw.drop("seq"), CHECKED)).first()[0]
    assert summary.startswith("PASS=") and "WARN=" in summary
    contract.require_auc(spark.createDataFrame([(0.8,)], "roc_auc double"))
    with pytest.raises(contract.ContractBroken):
        contract.require_auc(spark.createDataFrame([(0.7,)], "roc_auc double"))


def test_32_checks_on_the_full_schema(frames):
    assert contract.check_accounts(frames.views.raw_accounts).count() == 32


# ---------------------------------------------------------------- KPIs and alignment


def test_null_groups(spark):
    df = spark.createDataFrame(
        [("a", 1.0, 10.0, "x", 1, 5.0), ("b", 2.0, 20.0, None, 0, 6.0)],
        "customerID string, tenure double, MonthlyCharges double, Contract string, Churn int, annual_margin_at_risk double",
    )
    assert kpi.contract_risk(df).count() == 2  # SQL keeps the null contract
    assert kpi.contract_table(df).count() == 1  # the report drops it


def test_hazard_leaves_out_zero_and_beyond(spark):
    df = spark.createDataFrame([(0.0, 1), (6.0, 1), (7.0, 0), (78.0, 1), (79.0, 1)], "tenure double, Churn int")
    got = [(r[0], r[1]) for r in kpi.tenure_hazard(df).collect()]
    assert got == [(6, 1.0), (12, 0.0), (78, 1.0)]


def test_band_counts_keep_empty_bands(spark):
    df = spark.createDataFrame([("High",), ("High",), ("Low",)], "risk_band string")
    assert [(r["risk_band"], r["customers"]) for r in kpi.risk_band_counts(df).orderBy("position").collect()] == [
        ("Low", 1), ("Medium", 0), ("High", 2), ("Critical", 0)
    ]


def test_verbatims_have_distinct_openings(spark):
    same = "this opening is the same for both of these reviews, "
    rows = [("r1", same + "one", 1, "email", -1.0), ("r2", same + "two", 1, "email", -0.9), ("r3", "other", 2, "app", -0.8),
            ("r4", "third", 2, "app", -0.7), ("r5", "fourth", 2, "app", -0.6)]
    df = spark.createDataFrame(rows, "review_id string, review_text string, rating int, channel string, sentiment_score double")
    assert [r[0] for r in kpi.worst_verbatims(df).collect()] == ["r1", "r3", "r4"]


def test_align_columns(spark):
    schema = spark.createDataFrame([], "x double, y string").schema
    out = cleaning.align_columns(spark.createDataFrame([("a", 1, 2)], "id string, x int, z int"), schema, keep=["id"])
    assert out.columns == ["id", "x", "y"] and tuple(out.first()) == ("a", 1.0, None)


def test_missing_ids_get_their_position(spark):
    df = spark.createDataFrame([("a", 3), (None, 1), (None, 2)], "customerID string, at int")
    out = {r["at"]: r["customerID"] for r in cleaning.fill_ids(df, "customerID", [F.asc("at")]).collect()}
    assert out == {1: "row-0", 2: "row-1", 3: "a"}
    absent = cleaning.fill_ids(df.drop("customerID"), "customerID", [F.asc("at")])
    assert sorted(r["customerID"] for r in absent.collect()) == ["row-0", "row-1", "row-2"]


def test_feature_types_leave_out_leaks(frames):
    numeric, categorical = cleaning.feature_types(frames.features)
    assert not {"customerID", "Churn", "clv_to_date", "annual_margin_at_risk"} & {*numeric, *categorical}
    assert "tenure" in numeric and "Contract" in categorical


def test_account_run_end_to_end(spark, frames, tmp_path):
    run = account_run.run_accounts(
        frames.views.raw_accounts_dup, frames.views.feedback, [F.asc("seq"), F.asc("MonthlyCharges")], order_columns=["seq"]
    )
    summary = run.summary()
    assert summary["customers"] == summary["features_rows"] == 150 and summary["quality_checks"] == 32
    assert not [c for c in run.features.columns if run.features.where(F.col(c).isNull()).count()]
    written = account_run.write_accounts(run, folder=str(tmp_path), snapshots=str(tmp_path / "snap"))
    assert written["fct_customer_features"] == 150
    assert spark.table("ops_data_quality").count() == 32
    account_run.write_accounts(run, folder=str(tmp_path))
    assert spark.table("ops_data_quality").count() == 64  # history is kept
    assert spark.read.parquet(str(tmp_path / "snap" / "features.parquet")).count() == 150
