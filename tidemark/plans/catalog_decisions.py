"""Queries over scored customers: decisions, campaigns, evaluation, attribution, segments."""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions import economics as econ
from tidemark.functions import render
from tidemark.functions.numbers import ratio_to, round_half_up
from tidemark.operators import contract, decisions, evaluation, explain, kpi, segmentation
from tidemark.plans import frames as fr
from tidemark.plans import segment_run, training_run
from tidemark.plans.catalog_accounts import scratch
from tidemark.plans.frames import Frames
from tidemark.plans.oracle_views import mean, rnd, total, value_of_offer
from tidemark.plans.registry import register
from tidemark.settings import Economics
from tidemark.sources import files, tables

# ---------------------------------------------------------------- decision columns


@register("x10_expected_value", f"SELECT customerID, {value_of_offer()} AS ev FROM {{scored}}")
def _(f: Frames) -> DataFrame:
    value = econ.expected_value(F.col("churn_probability"), F.col("MonthlyCharges"))
    return f.scored.select("customerID", value.alias("ev"))


_DECISION = """customerID, churn_probability, risk_band, expected_value_of_offer, margin_at_risk,
    targeted_by_policy, recommended_action"""


@register("m11_x11_x12_decisions", f"SELECT {_DECISION} FROM {{predictions}}")
def _(f: Frames) -> DataFrame:
    return f.predictions.drop("scored_at")


@register("p2_p6_targeted", f"SELECT {_DECISION} FROM {{predictions}} WHERE targeted_by_policy = 1")
def _(f: Frames) -> DataFrame:
    return decisions.targeted_only(f.predictions).drop("scored_at")


@register(
    "j3_predictions_with_account_columns",
    "SELECT customerID, tenure, MonthlyCharges, Contract, annual_margin_at_risk, risk_band FROM {joined}",
)
def _(f: Frames) -> DataFrame:
    return f.joined.select(
        "customerID", "tenure", "MonthlyCharges", "Contract", "annual_margin_at_risk", "risk_band"
    )


_HIGH_RISK = f"""SELECT customerID, {rnd('churn_probability', 4)} AS churn_probability, risk_band,
    recommended_action, expected_value_of_offer, tenure, MonthlyCharges, Contract,
    {rnd('annual_margin_at_risk', 2)} AS annual_margin_at_risk
    FROM {{joined}} WHERE churn_probability >= 0.55e0
    ORDER BY expected_value_of_offer DESC, customerID LIMIT 100"""


@register("p1_j2_t3_high_risk_list", _HIGH_RISK)
def _(f: Frames) -> DataFrame:
    return decisions.high_risk(f.predictions, f.features, 0.55, 100)


@register(
    "a14_high_risk_envelope",
    f"""SELECT count(*) AS "count", coalesce({rnd(total('annual_margin_at_risk'), 2)}, 0.0)
        AS total_margin_at_risk FROM ({_HIGH_RISK}) listed""",
)
def _(f: Frames) -> DataFrame:
    return kpi.high_risk_envelope(decisions.high_risk(f.predictions, f.features, 0.55, 100))


@register(
    "t1_call_list",
    """SELECT customerID, risk_band, churn_probability, tenure, MonthlyCharges, Contract, expected_value_of_offer
       FROM {joined} WHERE targeted_by_policy = 1 ORDER BY expected_value_of_offer DESC, customerID LIMIT 12""",
)
def _(f: Frames) -> DataFrame:
    return decisions.call_list(f.joined)


_REPRICED = """SELECT customerID, risk_band, churn_probability AS p_churn, tenure, MonthlyCharges, Contract,
    ev AS expected_value, recommended_action
    FROM (SELECT *, churn_probability * 0.25e0 * (MonthlyCharges * 0.35e0 * 12) - 30 AS ev FROM {joined}) priced
    WHERE churn_probability >= 0.4e0 AND ev > 0"""
_NEW_PRICES = Economics(offer_cost=30.0, save_rate=0.25)


@register("t2_repriced_call_list", f"{_REPRICED} ORDER BY ev DESC, customerID LIMIT 200")
def _(f: Frames) -> DataFrame:
    return decisions.repriced_call_list(f.joined, 0.4, _NEW_PRICES)


@register("t2_k11_whole_call_list", _REPRICED)
def _(f: Frames) -> DataFrame:
    calls = decisions.repriced_call_list(f.joined, 0.4, _NEW_PRICES, k=None)
    path = f"{scratch(f)}/calls"
    files.export_csv(calls, path)
    return f.spark.read.options(header=True, escape='"').schema(calls.schema).csv(path)


_SCENARIO_ROWS = ", ".join(
    f"({i}, {c['offer_cost']}e0, {c['save_rate']}e0, {c['margin']}e0, {float(c['horizon_months'])}e0, {c['threshold']}e0)"
    for i, c in enumerate(fr.SCENARIOS)
)


@register(
    "j9_price_scenarios",
    f"""SELECT scenario, targeted, targeted * offer_cost AS campaign_cost, {rnd('net', 2)} AS net_saving,
               {rnd('coalesce((net + targeted * offer_cost) / nullif(targeted * offer_cost, 0), 0.0)', 4)} AS roi,
               {rnd('exposure', 2)} AS exposure
        FROM (SELECT scenario, offer_cost, CAST(count_if(hit) AS BIGINT) AS targeted,
                     coalesce({total('CASE WHEN hit THEN ev END')}, 0.0) AS net, {total('p * at_risk')} AS exposure
              FROM (SELECT *, p >= threshold AND ev > 0 AS hit FROM (
                    SELECT scenario, offer_cost, threshold, churn_probability AS p,
                           MonthlyCharges * margin * horizon AS at_risk,
                           churn_probability * save_rate * (MonthlyCharges * margin * horizon) - offer_cost AS ev
                    FROM {{joined}}, (VALUES {_SCENARIO_ROWS})
                         s(scenario, offer_cost, save_rate, margin, horizon, threshold)) priced) flagged
              GROUP BY scenario, offer_cost) sums""",
)
def _(f: Frames) -> DataFrame:
    priced = decisions.price_scenarios(f.joined, fr.SCENARIOS)
    digits = {"net_saving": 2, "roi": 4, "exposure": 2}
    return priced.withColumns({c: round_half_up(c, d) for c, d in digits.items()})


_GRID = ", ".join(f"({i}, {t:.17e})" for i, t in enumerate(decisions.THRESHOLD_GRID, start=1))
_SWEEP = f"""SELECT step, t AS threshold, count(*) AS n_targeted, {total('ev')} AS net, sum(label) AS hits,
        (SELECT sum(label) FROM {{scored}}) AS positives
    FROM (VALUES {_GRID}) grid(step, t)
    JOIN (SELECT *, {value_of_offer()} AS ev FROM {{scored}}) s ON churn_probability >= t
    GROUP BY step, t"""


@register(
    "j8_w10_threshold_sweep",
    f"""SELECT step, threshold, n_targeted, net, CAST(hits AS BIGINT) AS hits, CAST(positives AS BIGINT) AS positives
        FROM ({_SWEEP}) swept""",
)
def _(f: Frames) -> DataFrame:
    return decisions.threshold_sweep(f.scored).withColumn("net", F.col("net").cast("double"))


@register(
    "m10_threshold_policy",
    f"""SELECT {rnd('threshold', 3)} AS threshold, n_targeted, {rnd('net', 2)} AS expected_net_saving,
               {rnd('n_targeted * 45', 2)} AS campaign_cost,
               {rnd('(net + n_targeted * 45) / (n_targeted * 45e0)', 3)} AS roi, 45e0 AS offer_cost,
               0.3e0 AS offer_success_rate, 12 AS horizon_months,
               {rnd('CAST(hits AS DOUBLE) / n_targeted', 4)} AS precision_at_threshold,
               {rnd('CAST(hits AS DOUBLE) / positives', 4)} AS recall_at_threshold
        FROM ({_SWEEP}) swept ORDER BY net DESC, step LIMIT 1""",
)
def _(f: Frames) -> DataFrame:
    return decisions.choose_threshold(f.scored)


# ---------------------------------------------------------------- evaluation

_AUC = """SELECT sum(neg * (2 * (cum_pos - pos) + pos)) / (2.0 * sum(pos) * sum(neg)) AS roc_auc,
       sum(pos * (cum_pos / cum_n)) / sum(pos) AS pr_auc
    FROM (SELECT pos, neg, CAST(sum(pos) OVER w AS DOUBLE) AS cum_pos,
                 CAST(sum(pos + neg) OVER w AS DOUBLE) AS cum_n
          FROM (SELECT churn_probability AS p, sum(label) AS pos, sum(1 - label) AS neg
                FROM {scored} GROUP BY 1) by_score
          WINDOW w AS (ORDER BY p DESC ROWS UNBOUNDED PRECEDING)) running"""


@register(
    "m8a_m8b_w9_ranking_metrics",
    f"SELECT {rnd('roc_auc', 8)} AS roc_auc, {rnd('pr_auc', 8)} AS pr_auc FROM ({_AUC}) ranked",
)
def _(f: Frames) -> DataFrame:
    metrics = evaluation.ranking_metrics(f.scored)
    return metrics.select(*[round_half_up(c, 8).alias(c) for c in metrics.columns])


_POINT = """SELECT avg(-(label * ln(safe) + (1 - label) * ln(1 - safe))) AS log_loss,
       avg((p - label) * (p - label)) AS brier,
       CAST(count_if((p >= 0.5e0) = (label = 1)) AS DOUBLE) / count(*) AS accuracy,
       coalesce(CAST(count_if(p >= 0.5e0 AND label = 1) AS DOUBLE) / nullif(count_if(p >= 0.5e0), 0), 0.0) AS "precision",
       coalesce(CAST(count_if(p >= 0.5e0 AND label = 1) AS DOUBLE) / nullif(count_if(label = 1), 0), 0.0) AS recall,
       coalesce(2.0 * count_if(p >= 0.5e0 AND label = 1)
                / nullif(count_if(p >= 0.5e0) + count_if(label = 1), 0), 0.0) AS f1
    FROM (SELECT label, churn_probability AS p, least(greatest(churn_probability, 1e-6), 1 - 1e-6) AS safe
          FROM {scored}) clipped"""
_POINT_NAMES = ("log_loss", "brier", "accuracy", "precision", "recall", "f1")


@register(
    "m8c_m8d_point_metrics",
    "SELECT " + ", ".join(f'{rnd(chr(34) + c + chr(34), 8)} AS "{c}"' for c in _POINT_NAMES) + f" FROM ({_POINT}) points",
)
def _(f: Frames) -> DataFrame:
    metrics = evaluation.point_metrics(f.scored)
    return metrics.select(*[round_half_up(c, 8).alias(c) for c in metrics.columns])


@register(
    "m9_w1_lift_table",
    f"""SELECT CAST(decile AS INTEGER) AS decile, customers, {rnd('hits / customers', 4)} AS churn_rate,
               {rnd('(hits / customers) / (all_hits / all_customers)', 3)} AS lift,
               {rnd('running / all_hits', 4)} AS cumulative_capture
        FROM (SELECT decile, customers, CAST(hits AS DOUBLE) AS hits,
                     CAST(sum(hits) OVER (ORDER BY decile) AS DOUBLE) AS running,
                     CAST(sum(hits) OVER () AS DOUBLE) AS all_hits, sum(customers) OVER () AS all_customers
              FROM (SELECT decile, count(*) AS customers, sum(label) AS hits
                    FROM (SELECT label, ntile(10) OVER (ORDER BY churn_probability DESC, customerID) AS decile
                          FROM {{scored}}) tiles GROUP BY decile) grouped) totals""",
)
def _(f: Frames) -> DataFrame:
    return evaluation.lift_table(f.scored)


@register(
    "v8_model_refusals",
    f"""SELECT 'model:roc_auc' AS gate FROM ({_AUC}) measured WHERE roc_auc < 0.78""",
)
def _(f: Frames) -> DataFrame:
    return contract.auc_refusal(evaluation.classification_report(f.scored)).select("gate")


# ---------------------------------------------------------------- written runs


def _names(*kinds: str) -> list[str]:
    return [f"tidemark_{kind}_{uuid.uuid4().hex}" for kind in kinds]


@register(
    "k4_m22_predictions_written",
    f"""SELECT {_DECISION}, 'second' AS run_id FROM {{predictions}} WHERE churn_probability >= 0.5
        UNION ALL SELECT {_DECISION}, 'first' AS run_id FROM {{predictions}}""",
)
def _(f: Frames) -> DataFrame:
    """Two runs, one of them written again in another form, both read back."""
    table, manifest = _names("predictions", "manifest")
    folder, shown = scratch(f), f.predictions.drop("scored_at")
    training_run.write_predictions(shown, "first", folder, table, manifest)
    training_run.write_predictions(shown, "second", folder, table, manifest)
    again = shown.where("churn_probability >= 0.5")
    training_run.write_predictions(again, "second", folder, table, manifest)
    last = tables.read_run(f.spark, table, manifest=manifest)  # the run that ended last
    return last.unionByName(tables.read_run(f.spark, table, "first", manifest))


@register("k5_segments_written", "SELECT customerID, segment_id, segment_name, 'r' AS run_id FROM {segments}")
def _(f: Frames) -> DataFrame:
    table, manifest = _names("segments", "manifest")
    segment_run.write_segments(f.segments, f.features, "r", None, scratch(f), table, manifest)
    return tables.read_run(f.spark, table, "r", manifest)


@register(
    "k5_segment_profile_csv",
    f"""SELECT segment_name, customers, {rnd('avg_tenure', 3)} AS avg_tenure, {rnd('avg_monthly', 3)} AS avg_monthly,
               {rnd('churn_rate', 3)} AS churn_rate
        FROM (SELECT segment_name, count(customerID) AS customers, {mean('Churn')} AS churn_rate,
                     {mean('MonthlyCharges')} AS avg_monthly, {mean('tenure')} AS avg_tenure
              FROM {{segments}} GROUP BY segment_name) means""",
)
def _(f: Frames) -> DataFrame:
    (table, manifest), folder = _names("segments", "manifest"), scratch(f)
    segment_run.write_segments(f.segments, f.features, "r", f"{folder}/profile", folder, table, manifest)
    schema = "segment_name string, customers bigint, avg_tenure double, avg_monthly double, churn_rate double"
    return f.spark.read.schema(schema).csv(f"{folder}/profile", header=True)


@register(
    "k7_s7_report_written",
    """SELECT 'decision_policy' AS part, 'r' AS run_id, CAST(1 AS BIGINT) AS n
       UNION ALL SELECT 'final_metrics', 'r', CAST(1 AS BIGINT)
       UNION ALL SELECT 'lift_table', 'r', least(10, count(*)) FROM {scored}""",
)
def _(f: Frames) -> DataFrame:
    """The parts that don't compare candidates, written twice under one run: once each."""
    (prefix, manifest), folder = _names("report", "manifest"), scratch(f)
    scored = f.scored.select("customerID", "label", "MonthlyCharges", "churn_probability")
    parts = {
        "final_metrics": evaluation.classification_report(scored),
        "decision_policy": decisions.choose_threshold(scored),
        "lift_table": evaluation.lift_table(scored),
    }
    for _ in range(2):
        tables.write_report(parts, "r", prefix, folder, manifest)
    back = tables.read_report(f.spark, "r", prefix, manifest)
    counts = [
        rows.groupBy("run_id").agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("part"), "run_id", "n")
        for name, rows in back.items()
    ]
    return reduce(DataFrame.unionByName, counts)


# ---------------------------------------------------------------- attribution


@register(
    "m12_linear_contributions",
    f"SELECT customerID, feature, {rnd('contribution', 8)} AS contribution FROM {{contributions}}",
)
def _(f: Frames) -> DataFrame:
    rows = f.explained.select("customerID", F.inline("contributions"))
    return rows.withColumn("contribution", round_half_up("contribution", 8))


@register(
    "m14_global_importance",
    f"""SELECT feature, {rnd(mean('abs(contribution)', 10), 8)} AS importance, 'mean_abs_contribution' AS method
        FROM {{contributions}} GROUP BY feature ORDER BY importance DESC LIMIT 20""",
)
def _(f: Frames) -> DataFrame:
    ranked = explain.global_importance(f.explained)
    return ranked.withColumn("importance", round_half_up("importance", 8))


_REASONS = {
    "tenure": ("short tenure with the company", "Enrol in the first-year onboarding and check-in programme"),
    "MonthlyCharges": ("high monthly charges", "Review plan fit; offer a right-sized bundle"),
    "services_count": ("few products held", "Cross-sell a sticky add-on (security or support)"),
    "is_month_to_month": ("month-to-month contract", "Offer a discounted 12-month contract"),
    "is_manual_payment": ("manual payment method", "Incentivise switching to autopay"),
    "charge_drift": ("recent price increase versus their historical average",
                     "Grandfather the previous rate or offer a loyalty credit"),
    "charge_drift_pct": ("bill rising faster than their historical average", "Proactive bill-shock outreach"),
    "has_premium_support": ("no premium support attached", "Offer 3 months of TechSupport free"),
}
_REASON_ROWS = ", ".join(f"('{k}', '{r}', '{a}')" for k, (r, a) in _REASONS.items())


@register(
    "m15_w3_j5_x14_customer_drivers",
    f"""SELECT customerID, CAST(rank AS INTEGER) AS rank, feature, {rnd('contribution', 5)} AS contribution,
               CASE WHEN contribution > 0 THEN 'increases risk' ELSE 'reduces risk' END AS direction, reason,
               CASE WHEN contribution > 0 THEN action ELSE '—' END AS recommended_action
        FROM (SELECT *, row_number() OVER (PARTITION BY customerID ORDER BY abs(contribution) DESC, feature) AS rank
              FROM {{contributions}}) ranked
        JOIN (VALUES {_REASON_ROWS}) n(feature, reason, action) USING (feature)
        WHERE rank <= 4""",
)
def _(f: Frames) -> DataFrame:
    return explain.top_drivers(f.explained, "customerID")


# ---------------------------------------------------------------- segments

_Z = ("tenure", "MonthlyCharges", "services_count")
_CENTRES = f"""SELECT segment_id, count(*) AS n, {', '.join(f"{mean(c, 10)} AS c_{c}" for c in _Z)}
    FROM {{segments}} GROUP BY segment_id"""
_GAP = " + ".join(f"(s.{c} - k.c_{c}) * (s.{c} - k.c_{c})" for c in _Z)
_STATS = f"""SELECT k.segment_id, k.n, {', '.join(f'k.c_{c}' for c in _Z)}, avg(sqrt({_GAP})) AS scatter,
           sum({_GAP}) AS "within"
    FROM {{segments}} s JOIN ({_CENTRES}) k ON k.segment_id = s.segment_id GROUP BY ALL"""
_BETWEEN = " + ".join(f"(c_{c} - mean_{c}) * (c_{c} - mean_{c})" for c in _Z)
_PAIR = " + ".join(f"(a.c_{c} - b.c_{c}) * (a.c_{c} - b.c_{c})" for c in _Z)


@register(
    "m18_m19_cluster_quality",
    f"""WITH stats AS ({_STATS}),
        worst AS (SELECT a.segment_id, max((a.scatter + b.scatter) / sqrt({_PAIR})) AS ratio
                  FROM stats a JOIN stats b ON a.segment_id <> b.segment_id GROUP BY a.segment_id),
        means AS (SELECT {', '.join(f'sum(n * c_{c}) / sum(n) AS mean_{c}' for c in _Z)},
                         sum(n) AS points, sum("within") AS inside, count(*) AS k FROM stats)
        SELECT CAST((SELECT k FROM means) AS INTEGER) AS k,
               {rnd('(SELECT avg(ratio) FROM worst)', 6)} AS davies_bouldin,
               {rnd('max(ch)', 4)} AS calinski_harabasz
        FROM (SELECT sum(n * ({_BETWEEN})) / (max(k) - 1) / (max(inside) / (max(points) - max(k))) AS ch
              FROM stats, means) ratio""",
)
def _(f: Frames) -> DataFrame:
    quality = segmentation.cluster_quality(f.segments, _Z, "segment_id")
    return quality.withColumns(
        {
            "davies_bouldin": round_half_up("davies_bouldin", 6),
            "calinski_harabasz": round_half_up("calinski_harabasz", 4),
        }
    )


@register(
    "m20_x13_w7_named_segments",
    f"""SELECT segment_id, CASE WHEN used > 1 THEN name || ' ' || CAST(used AS VARCHAR) ELSE name END AS segment_name
        FROM (SELECT segment_id, name, row_number() OVER (PARTITION BY name ORDER BY segment_id) AS used
              FROM (SELECT segment_id,
                           CASE WHEN monthly >= m AND tenure >= t THEN 'Premium Loyal'
                                WHEN monthly >= m THEN 'High-Value At-Risk'
                                WHEN tenure >= t THEN 'Steady Low-Spend'
                                WHEN services >= s THEN 'Emerging Multi-Product'
                                ELSE 'Price-Sensitive New' END AS name
                    FROM (SELECT segment_id, {mean('MonthlyCharges')} AS monthly, {mean('tenure')} AS tenure,
                                 {mean('services_count')} AS services FROM {{segments}} GROUP BY segment_id) centres,
                         (SELECT median(MonthlyCharges) AS m, median(tenure) AS t, median(services_count) AS s
                          FROM {{features}}) medians) named) numbered""",
)
def _(f: Frames) -> DataFrame:
    names = ["MonthlyCharges", "tenure", "services_count"]
    medians = segmentation.exact_median(f.features, names)
    centroids = kpi.cluster_centroids(f.segments, names, "segment_id")
    return segmentation.name_segments(centroids, medians)


# ---------------------------------------------------------------- rendering


@register(
    "x7_money_text",
    """SELECT customerID, MonthlyCharges * 12000 AS amount,
              CASE WHEN MonthlyCharges * 12000 >= 1000000 THEN format('${:.2f}M', MonthlyCharges * 12000 / 1000000)
                   WHEN MonthlyCharges * 12000 >= 1000 THEN format('${:.0f}K', MonthlyCharges * 12000 / 1000)
                   ELSE format('${:,.0f}', MonthlyCharges * 12000) END AS text
       FROM {features}""",
)
def _(f: Frames) -> DataFrame:
    amount = F.col("MonthlyCharges") * 12000
    return f.features.select("customerID", amount.alias("amount"), render.money(amount).alias("text"))


@register(
    "x8_value_text",
    """SELECT customerID, kind, CASE kind WHEN 'pct' THEN format('{:.1f}%', v * 100)
              WHEN 'pct0' THEN format('{:.0f}%', v * 100) WHEN 'x' THEN format('{:.2f}×', v)
              WHEN 'money' THEN CASE WHEN w >= 1000 THEN format('${:.1f}K', w / 1000) ELSE format('${:,.0f}', w) END
              ELSE CASE WHEN w >= 1000 THEN format('{:,.0f}', w)
                        ELSE rtrim(rtrim(format('{:,.2f}', w), '0'), '.') END END AS text
       FROM (SELECT customerID, churn_probability AS v, TotalCharges AS w,
                    CASE CAST(customerID AS BIGINT) % 5 WHEN 0 THEN 'pct' WHEN 1 THEN 'pct0' WHEN 2 THEN 'money'
                         WHEN 3 THEN 'x' ELSE 'number' END AS kind FROM {scored}) kinds""",
)
def _(f: Frames) -> DataFrame:
    names = F.array(*[F.lit(k) for k in ("pct", "pct0", "money", "x", "number")])
    kind = F.element_at(names, (F.col("customerID").cast("bigint") % 5).cast("int") + 1)
    rows = f.scored.withColumn("kind", kind)
    share_kind = F.col("kind").isin("pct", "pct0", "x")
    value = F.when(share_kind, F.col("churn_probability")).otherwise(F.col("TotalCharges"))
    return rows.select("customerID", "kind", render.value_text(value, F.col("kind")).alias("text"))


@register(
    "x15_x18_ratio_to_best",
    f"""SELECT customerID, least(greatest(MonthlyCharges / 150e0, 0.0), 1.0) AS meter,
               {rnd('abs(charge_drift)', 2)} AS drift FROM {{features}}""",
)
def _(f: Frames) -> DataFrame:
    return f.features.select(
        "customerID",
        ratio_to(F.col("MonthlyCharges"), F.lit(150.0)).alias("meter"),
        round_half_up(F.abs("charge_drift"), 2).alias("drift"),
    )
