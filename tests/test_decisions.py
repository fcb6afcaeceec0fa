"""Offer economics, policy, lists, evaluation and ranking."""

from __future__ import annotations

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark import settings as s
from tidemark.functions import economics as econ
from tidemark.functions import render
from tidemark.operators import decisions, evaluation, kpi
from tidemark.operators.ranking import ntile_of, with_global_rank, with_running_totals
from tidemark.operators.requests import check_batches, check_questions, check_scoring_requests, request_rollup

SCORED = "customerID string, churn_probability double, MonthlyCharges double, label int"


@pytest.fixture()
def scored(spark):
    rng = random.Random(3)
    rows = []
    for i in range(500):
        p = 0.29 if i % 3 == 0 else round(rng.random(), 3)  # one score holds a third of the rows
        rows.append((f"c{i:04d}", p, rng.uniform(5, 150), int(rng.random() < p)))
    return spark.createDataFrame(rows, SCORED).repartition(5)


def one(df):
    return df.first().asDict()


def test_expected_value(spark):
    df = spark.createDataFrame([(1.0, 100.0), (0.99, 5.0)], "p double, m double")
    values = [r[0] for r in df.select(econ.expected_value(F.col("p"), F.col("m"))).collect()]
    assert values[0] == pytest.approx(81.0) and values[1] < 0


def test_bands_and_actions(spark):
    df = spark.createDataFrame([(0.05,), (0.30,), (0.55,), (0.70,)], "p double")
    assert [r[0] for r in df.select(econ.risk_band(F.col("p"))).collect()] == ["Low", "Medium", "High", "Critical"]
    p = F.col("p")
    got = df.select(econ.recommended_action(p, p >= 0.5, 0.3)).collect()
    assert [r[0] for r in got] == [s.ACTION_NONE, s.ACTION_MONITOR, s.ACTION_OFFER, s.ACTION_PRIORITY]


def test_decisions_keep_every_row(spark):
    rows = [("a", 0.9, 100.0, 1), ("a", 0.9, 100.0, 1), (None, 0.5, 107.14285714285714, 0)]
    out = decisions.decide(spark.createDataFrame(rows, SCORED), 0.5)
    assert out.count() == 3
    zero = out.where("customerID is null").first()
    assert zero["targeted_by_policy"] in (0, 1) and zero["expected_value_of_offer"] == 22.5
    response = decisions.decision_response(out, 0.5, "m")
    assert decisions.response_violations(response).count() == 0


def test_zero_value_is_not_targeted(spark):
    exact = s.Economics(margin=0.5, offer_cost=50.0, save_rate=0.5, horizon_months=2)
    out = decisions.decide(spark.createDataFrame([("a", 1.0, 100.0, 1)], SCORED), 0.5, exact).first()
    assert out["expected_value_of_offer"] == 0.0 and out["targeted_by_policy"] == 0


def brute_policy(rows, economics=s.ECONOMICS):
    p = np.array([r["churn_probability"] for r in rows])
    m = np.array([r["MonthlyCharges"] for r in rows])
    y = np.array([r["label"] for r in rows])
    value = p * economics.save_rate * (m * economics.margin * economics.horizon_months) - economics.offer_cost
    best = None
    for t in np.arange(0.05, 0.96, 0.01):
        hit = p >= t
        if hit.any() and (best is None or value[hit].sum() > best[1] + 1e-9):
            best = (t, value[hit].sum(), int(hit.sum()), y[hit].sum())
    return best, y.sum()


def test_threshold_policy_matches_brute_force(scored):
    (t, net, n, hits), positives = brute_policy(scored.collect())
    got = one(decisions.choose_threshold(scored))
    assert got["threshold"] == round(t, 3) and got["n_targeted"] == n
    assert got["expected_net_saving"] == pytest.approx(net, abs=0.01)
    assert got["precision_at_threshold"] == pytest.approx(hits / n, abs=1e-4)
    assert got["recall_at_threshold"] == pytest.approx(hits / positives, abs=1e-4)
    assert got["roi"] == pytest.approx((net + n * 45) / (n * 45), abs=1e-3)


def test_policy_is_at_least_contacting_everyone(scored):
    value = econ.expected_value(F.col("churn_probability"), F.col("MonthlyCharges"))
    everyone = scored.where("churn_probability >= 0.05").agg(F.sum(value)).first()[0]
    assert one(decisions.choose_threshold(scored))["expected_net_saving"] >= everyone - 0.01


def test_sweep_covers_every_reached_threshold(scored):
    swept = {r["step"]: r["n_targeted"] for r in decisions.threshold_sweep(scored).collect()}
    p = [r["churn_probability"] for r in scored.collect()]
    for step, t in enumerate(decisions.THRESHOLD_GRID, start=1):
        n = sum(x >= t for x in p)
        assert swept.get(step, 0) == n


def test_nobody_above_the_grid(spark):
    got = one(decisions.choose_threshold(spark.createDataFrame([("a", 0.01, 10.0, 0)], SCORED)))
    assert (got["threshold"], got["n_targeted"], got["expected_net_saving"], got["roi"]) == (0.5, 0, 0.0, 0.0)


def test_ranking_metrics_match_brute_force(scored):
    rows = scored.collect()
    pos = [r["churn_probability"] for r in rows if r["label"] == 1]
    neg = [r["churn_probability"] for r in rows if r["label"] == 0]
    auc = sum((a > b) + 0.5 * (a == b) for a in pos for b in neg) / (len(pos) * len(neg))
    precision = 0.0
    for t in sorted(set(pos), reverse=True):
        called = sum(r["churn_probability"] >= t for r in rows)
        hits = sum(x >= t for x in pos)
        precision += pos.count(t) / len(pos) * hits / called
    got = one(evaluation.ranking_metrics(scored))
    assert got["roc_auc"] == pytest.approx(auc) and got["pr_auc"] == pytest.approx(precision)


def test_step_wise_average_precision(spark):
    rows = [("a", 0.8, 1.0, 1), ("b", 0.4, 1.0, 0), ("c", 0.35, 1.0, 1), ("d", 0.1, 1.0, 0)]
    assert one(evaluation.ranking_metrics(spark.createDataFrame(rows, SCORED)))["pr_auc"] == pytest.approx(0.8333, abs=1e-4)


def test_all_eight_metrics(scored):
    got = one(evaluation.classification_report(scored))
    assert set(got) == {"roc_auc", "pr_auc", "log_loss", "brier", "accuracy", "precision", "recall", "f1"}
    assert got["f1"] == pytest.approx(2 * got["precision"] * got["recall"] / (got["precision"] + got["recall"]))
    none = evaluation.point_metrics(scored.withColumn("churn_probability", F.lit(0.1))).first()
    assert (none["precision"], none["recall"], none["f1"]) == (0.0, 0.0, 0.0)


def test_lift_table_matches_brute_force(scored):
    rows = sorted(scored.collect(), key=lambda r: (-r["churn_probability"], r["customerID"]))
    y = np.array([r["label"] for r in rows])
    table = evaluation.lift_table(scored).collect()
    assert len(table) == 10 and table[-1]["cumulative_capture"] == 1.0
    for row, part in zip(table, np.array_split(y, 10), strict=True):
        assert row["customers"] == len(part)
        assert row["churn_rate"] == pytest.approx(part.mean(), abs=1e-4)
        assert row["lift"] == pytest.approx(part.mean() / y.mean(), abs=1e-3)


def test_lift_with_fewer_rows_than_tiles(spark):
    rows = [("a", 0.8, 1.0, 1), ("b", 0.4, 1.0, 0), ("c", 0.35, 1.0, 1)]
    table = evaluation.lift_table(spark.createDataFrame(rows, SCORED)).collect()
    assert [r["customers"] for r in table] == [1, 1, 1]


@pytest.mark.parametrize("partitions", [1, 3, 7])
def test_global_rank_does_not_depend_on_partitions(spark, partitions):
    df = spark.range(1000).withColumn("score", F.when(F.col("id") % 3 == 0, 5).otherwise(F.col("id") % 11))
    order = [F.desc("score"), F.asc("id")]
    ranked = with_global_rank(df.repartition(partitions), order)
    got = [r["id"] for r in ranked.orderBy("rank").collect()]
    assert got == [r["id"] for r in df.orderBy(*order).collect()]
    assert [r["rank"] for r in ranked.orderBy("rank").select("rank").collect()] == list(range(1000))


def test_running_totals(spark):
    df = spark.range(500).withColumn("v", F.col("id") % 7)
    got = with_running_totals(df.repartition(6), [F.desc("id")], ["v"]).orderBy(F.desc("id")).collect()
    total = 0
    for r in got:
        total += r["v"]
        assert r["cum_v"] == total


def test_ntile_of(spark):
    for n in (1, 9, 10, 23):
        df = spark.range(n).select(ntile_of(F.col("id"), F.lit(n), 10).alias("t"))
        want = [i + 1 for i, part in enumerate(np.array_split(np.arange(n), 10)) for _ in part]
        assert [r["t"] for r in df.collect()] == want


def test_scenarios_match_single_runs(scored):
    scenarios = [
        {"offer_cost": 45.0, "save_rate": 0.3, "margin": 0.35, "horizon_months": 12, "threshold": 0.5},
        {"offer_cost": 900.0, "save_rate": 0.1, "margin": 0.1, "horizon_months": 1, "threshold": 0.9},
    ]
    rows = scored.collect()
    got = {r["scenario"]: r for r in decisions.price_scenarios(scored, scenarios).collect()}
    for i, sc in enumerate(scenarios):
        values = [
            r["churn_probability"] * sc["save_rate"] * (r["MonthlyCharges"] * sc["margin"] * sc["horizon_months"]) - sc["offer_cost"]
            for r in rows
            if r["churn_probability"] >= sc["threshold"]
        ]
        wins = [v for v in values if v > 0]
        assert got[i]["targeted"] == len(wins) and got[i]["net_saving"] == pytest.approx(sum(wins), abs=1e-3)
    assert got[1]["roi"] == 0.0


def test_campaign_totals_without_targets(spark):
    df = spark.createDataFrame([(0, 5.0)], "targeted_by_policy int, expected_value_of_offer double")
    assert one(kpi.campaign_totals(df)) == {"targeted": 0, "campaign_cost": 0.0, "campaign_net": 0.0, "roi": 0.0}


def test_call_lists(frames):
    top = decisions.call_list(frames.joined).collect()
    values = [r["expected_value_of_offer"] for r in top]
    assert len(top) == 12 and values == sorted(values, reverse=True)
    whole = decisions.repriced_call_list(frames.joined, 0.4, s.Economics(offer_cost=30.0), k=None)
    assert whole.count() >= decisions.repriced_call_list(frames.joined, 0.4, s.Economics(offer_cost=30.0), k=5).count() == 5


def test_request_contract(spark):
    rows = [("a", -3.0, 10.0, None), ("b", 5.0, None, None), ("c", 5.0, 10.0, "-1"), ("d", 200.0, 0.0, "5"), ("e", 5.0, 1.0, "x")]
    df = spark.createDataFrame(rows, "customerID string, tenure double, MonthlyCharges double, TotalCharges string")
    got = {r["customerID"]: (r["accepted"], len(r["reasons"])) for r in check_scoring_requests(df).collect()}
    assert got == {"a": (False, 1), "b": (False, 1), "c": (False, 1), "d": (True, 0), "e": (False, 1)}


def test_question_and_batch_contract(spark):
    df = spark.createDataFrame([("a", None), ("why?", 5), ("why?", 26), ("x" * 501, None)], "question string, top_k int")
    assert [r["accepted"] for r in check_questions(df).collect()] == [False, True, False, False]
    sizes = check_batches(spark.range(1002).selectExpr("if(id < 1001, 'big', 'small') as b"), "b").collect()
    assert {r["b"]: r["accepted"] for r in sizes} == {"big": False, "small": True}


def test_request_rollup(spark):
    rows = [("/a", float(i), i, False) for i in range(600)] + [("/a", 1e9, 601, True), ("/b", 4.0, 1, False)]
    df = spark.createDataFrame(rows, "path string, latency_ms double, ts int, failed boolean")
    got = {r["path"]: r for r in request_rollup(df).collect()}
    newest = np.arange(100, 600)
    assert (got["/a"]["requests"], got["/a"]["errors"], got["/a"]["count"]) == (600, 1, 500)
    assert got["/a"]["p50_ms"] == round(float(np.percentile(newest, 50)), 2)
    assert got["/a"]["p95_ms"] == round(float(np.percentile(newest, 95)), 2)
    assert got["/b"]["p95_ms"] == 4.0


def test_number_texts(spark):
    df = spark.createDataFrame([(1234567.0,), (12345.0,), (950.4,), (-2500000.0,)], "v double")
    assert [r[0] for r in df.select(render.money(F.col("v"))).collect()] == ["$1.23M", "$12K", "$950", "$-2.50M"]
    rows = [(0.1234, "pct", "12.3%"), (0.5, "pct0", "50%"), (1500.0, "money", "$1.5K"), (1.5, "x", "1.50×"),
            (1234.5, "number", "1,234"), (0.5, "number", "0.5"), (3.0, "number", "3")]
    df = spark.createDataFrame(rows, "v double, kind string, wanted string")
    for r in df.select("wanted", render.value_text(F.col("v"), F.col("kind")).alias("got")).collect():
        assert r["got"] == r["wanted"]
