"""Queries over accounts: sources, cleaning, contract, features, KPIs."""

from __future__ import annotations

import dataclasses
import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark import settings as s
from tidemark.functions.numbers import parse_number
from tidemark.operators import cleaning, contract, decisions, features, kpi
from tidemark.operators.requests import (
    check_batches,
    check_questions,
    check_scoring_requests,
    last_requests,
    request_rollup,
)
from tidemark.plans import frames as fr
from tidemark.plans.frames import Frames
from tidemark.plans.oracle_views import engineered, mean, number, repaired, rnd, total
from tidemark.plans.registry import register
from tidemark.scratch import scratch_root
from tidemark.sources import files, tables


def scratch(frames: Frames) -> str:
    """A new folder in the shared scratch of this application."""
    return f"{scratch_root(frames.spark)}/tables-{uuid.uuid4().hex}"


# ---------------------------------------------------------------- sources and sinks

_RAW = list(files.ACCOUNT_FIELDS)
_RAW_TEXT = ", ".join(f"CAST({c} AS VARCHAR) AS {c}" for c in _RAW)


@register("s1_account_csv_scan", f"SELECT {_RAW_TEXT} FROM {{raw_accounts}}")
def _(f: Frames) -> DataFrame:
    folder = scratch(f)
    files.export_csv(f.views.raw_accounts, f"{folder}/accounts")
    return files.read_accounts(f.spark, [f"{folder}/absent", f"{folder}/accounts"])


@register(
    "s2_review_csv_scan",
    """SELECT review_id, customerID, CAST(review_date AS VARCHAR) AS review_date, channel, rating, review_text
       FROM {feedback}""",
)
def _(f: Frames) -> DataFrame:
    folder = scratch(f)
    reviews = f.views.feedback.select(*files.REVIEW_FIELDS)
    files.export_csv(reviews, f"{folder}/reviews")
    read = files.read_reviews(f.spark, [f"{folder}/reviews"])
    return read.withColumn("review_date", F.col("review_date").cast("string"))


@register("s3_table_scan", "SELECT * FROM {raw_accounts}")
def _(f: Frames) -> DataFrame:
    table = f"tidemark_accounts_{uuid.uuid4().hex}"
    tables.write_table(f.views.raw_accounts, table, folder=scratch(f))
    return tables.read_table(f.spark, table, limit=0)


@register(
    "s4_parameterised_sql",
    "SELECT Contract, count(*) AS customers FROM {raw_accounts} WHERE MonthlyCharges >= 100 GROUP BY Contract",
)
def _(f: Frames) -> DataFrame:
    f.views.raw_accounts.createOrReplaceTempView("tidemark_raw_accounts")
    sql = """SELECT Contract, count(*) AS customers FROM tidemark_raw_accounts
             WHERE MonthlyCharges >= :least GROUP BY Contract"""
    return tables.query(f.spark, sql, least=100.0)


@register("k1_table_replace_and_append", "SELECT customerID, Churn, 2 AS copies FROM {clean}")
def _(f: Frames) -> DataFrame:
    table, folder = f"tidemark_clean_{uuid.uuid4().hex}", scratch(f)
    rows = f.clean.select("customerID", "Churn")
    tables.write_table(rows, table, folder=folder)
    tables.write_table(rows, table, "append", folder=folder)
    grouped = f.spark.table(table).groupBy("customerID", "Churn")
    return grouped.agg(F.count(F.lit(1)).cast("int").alias("copies"))


@register("k2_feature_snapshot", "SELECT * FROM {features}")
def _(f: Frames) -> DataFrame:
    return f.spark.read.parquet(files.write_snapshot(f.features, scratch(f), "features"))


@register("k3_quality_history", 'SELECT "check", count(*) AS n FROM {contract_report} GROUP BY "check"')
def _(f: Frames) -> DataFrame:
    table = f"tidemark_quality_{uuid.uuid4().hex}"
    tables.append_quality(contract.check_accounts(f.views.raw_accounts), table, scratch(f))
    return f.spark.table(table).groupBy("check").agg(F.count(F.lit(1)).alias("n"))


@register(
    "s5_s6_optional_tables",
    """SELECT 'absent' AS name, false AS there, CAST(0 AS BIGINT) AS customers
       UNION ALL SELECT 'written', true, count(*) FROM {raw_accounts}""",
)
def _(f: Frames) -> DataFrame:
    names = {name: f"tidemark_{name}_{uuid.uuid4().hex}" for name in ("absent", "written")}
    tables.write_table(f.views.raw_accounts, names["written"], folder=scratch(f))
    rows = [
        tables.read_optional(f.spark, table, f.views.raw_accounts.schema).agg(
            F.lit(name).alias("name"), F.lit(tables.table_exists(f.spark, table)).alias("there"),
            F.count(F.lit(1)).alias("customers"),
        )
        for name, table in names.items()
    ]
    return rows[0].unionByName(rows[1])


@register(
    "k8_run_log",
    """SELECT 'r' AS run_id, 'base' AS model, 'customers' AS key, CAST(count(*) AS VARCHAR) AS value FROM {features}
       UNION ALL SELECT 'r', 'base', 'churned', CAST(sum(Churn) AS VARCHAR) FROM {features}""",
)
def _(f: Frames) -> DataFrame:
    table = f"tidemark_log_{uuid.uuid4().hex}"
    counts = f.features.agg(F.count(F.lit(1)).alias("customers"), F.sum("Churn").alias("churned")).first()
    tables.log_run(f.spark, "r", {"base": counts.asDict() | {"left_out": None}}, table, scratch(f))
    return f.spark.table(table).drop("ts")


@register(
    "v7_contract_refusals",
    """SELECT "check" || ':' || "column" AS gate, detail FROM {contract_report}
       WHERE status = 'FAIL' AND "check" <> 'target_base_rate'
       UNION ALL SELECT 'target_base_rate:Churn', 'churn base rate outside plausible range'
       FROM {contract_report} WHERE "check" = 'target_base_rate' AND NOT observed BETWEEN 0.9 AND 1.0""",
)
def _(f: Frames) -> DataFrame:
    """Of a contract that these accounts break: hardly any are to stay."""
    strict = dataclasses.replace(s.CONTRACT, base_rate=(0.9, 1.0))
    return contract.refusals(contract.check_accounts(f.views.raw_accounts, strict))


# ---------------------------------------------------------------- cleaning

_DUP_COLUMNS = ", ".join(_RAW)


@register("c1_exact_dedupe", f"SELECT DISTINCT {_DUP_COLUMNS} FROM {{raw_accounts_dup}}")
def _(f: Frames) -> DataFrame:
    return cleaning.drop_exact_duplicates(f.views.raw_accounts_dup.drop("seq"))


@register(
    "c2_w2_first_row_per_key",
    f"""SELECT {_DUP_COLUMNS} FROM
        (SELECT *, row_number() OVER (PARTITION BY customerID ORDER BY seq, MonthlyCharges) AS rn
         FROM {{raw_accounts_dup}}) numbered WHERE rn = 1""",
)
def _(f: Frames) -> DataFrame:
    order = [F.asc("seq"), F.asc("MonthlyCharges")]
    return cleaning.keep_first(f.views.raw_accounts_dup, "customerID", order).drop("seq")


@register(
    "c3_text_to_number",
    f"SELECT customerID, {number('TotalCharges')} AS total, {number('SeniorCitizen')} AS senior FROM {{raw_accounts}}",
)
def _(f: Frames) -> DataFrame:
    return f.views.raw_accounts.select(
        "customerID", parse_number("TotalCharges").alias("total"), parse_number("SeniorCitizen").alias("senior")
    )


@register(
    "c4_billing_repair",
    f"""SELECT customerID, coalesce({number('TotalCharges')}, MonthlyCharges * CAST(tenure AS DOUBLE), 0.0)
        AS TotalCharges FROM {{raw_accounts}}""",
)
def _(f: Frames) -> DataFrame:
    numbers = cleaning.coerce_numbers(f.views.raw_accounts, ("tenure", "MonthlyCharges", "TotalCharges"))
    return cleaning.repair_billing(numbers).select("customerID", "TotalCharges")


@register(
    "c4_blank_totals",
    f"SELECT CAST(count_if({number('TotalCharges')} IS NULL) AS BIGINT) AS blank_totals FROM {{raw_accounts}}",
)
def _(f: Frames) -> DataFrame:
    return cleaning.count_blank_totals(f.views.raw_accounts)


@register(
    "c5_unknown_level",
    "SELECT coalesce(Partner, 'Unknown') AS Partner, count(*) AS n FROM {raw_accounts} GROUP BY 1",
)
def _(f: Frames) -> DataFrame:
    return kpi.counts_by(cleaning.fill_unknown(f.views.raw_accounts), "Partner")


@register(
    "c6_median_fill",
    """SELECT doc_id, coalesce(CAST(quality AS DOUBLE), median(CAST(quality AS DOUBLE)) OVER ()) AS quality,
              coalesce(n_chars, median(n_chars) OVER ()) AS n_chars
       FROM (SELECT d.doc_id, quality, CASE WHEN toxic = 1 THEN NULL ELSE CAST(n_chars AS DOUBLE) END AS n_chars
             FROM documents d LEFT JOIN labels l ON l.doc_id = d.doc_id) joined""",
)
def _(f: Frames) -> DataFrame:
    rows = f.views.documents.select("doc_id", "n_chars").join(f.views.labels, "doc_id", "left")
    gaps = rows.select(
        "doc_id",
        F.col("quality").cast("double").alias("quality"),
        F.when(F.coalesce(F.col("toxic"), F.lit(0)) != 1, F.col("n_chars").cast("double")).alias("n_chars"),
    )
    return cleaning.fill_medians(gaps, cleaning.fit_medians(gaps))


@register(
    "c7_target_decode",
    "SELECT customerID, CAST(lower(trim(Churn)) = 'yes' AS INTEGER) AS Churn FROM {raw_accounts}",
)
def _(f: Frames) -> DataFrame:
    return cleaning.decode_target(f.views.raw_accounts).select("customerID", "Churn")


@register(
    "c8_clean_accounts",
    repaired(
        f"""(SELECT {_DUP_COLUMNS} FROM
             (SELECT *, row_number() OVER (PARTITION BY customerID ORDER BY seq, MonthlyCharges) AS rn
              FROM {{raw_accounts_dup}}) numbered WHERE rn = 1) unique_rows"""
    ),
)
def _(f: Frames) -> DataFrame:
    order = [F.asc("seq"), F.asc("MonthlyCharges")]
    kept = cleaning.keep_first(f.views.raw_accounts_dup, "customerID", order).drop("seq")
    return cleaning.coerce_and_repair(kept)


@register(
    "c9_scoring_transform",
    engineered("{repaired_dup}", s.TENURE_EDGES, s.TENURE_LABELS),
)
def _(f: Frames) -> DataFrame:
    return features.prepare_for_scoring(f.views.raw_accounts_dup.drop("seq"))


@register(
    "c10_training_target",
    """SELECT customerID, CAST(lower(trim(Churn)) IN ('yes', 'y', 'true', '1') AS INTEGER) AS Churn
       FROM {raw_accounts}""",
)
def _(f: Frames) -> DataFrame:
    return cleaning.training_target(f.views.raw_accounts).select("customerID", "Churn")


_INPUTS = {
    "numeric": """
    tenure MonthlyCharges TotalCharges SeniorCitizen avg_charge_per_month charge_drift
    charge_drift_pct services_count has_premium_support is_new_customer is_month_to_month
    is_manual_payment
    """,
    "categorical": """
    gender Partner Dependents PhoneService MultipleLines InternetService OnlineSecurity
    OnlineBackup DeviceProtection TechSupport StreamingTV StreamingMovies Contract
    PaperlessBilling PaymentMethod tenure_bucket
    """,
}


@register(
    "c11_p8_model_inputs",
    " UNION ALL ".join(
        f"SELECT '{kind}' AS kind, '{c}' AS feature, count({c}) AS filled FROM {{features}}"
        for kind, names in _INPUTS.items()
        for c in names.split()
    ),
)
def _(f: Frames) -> DataFrame:
    numeric, categorical = cleaning.feature_types(f.features)
    measures = [(kind, c) for kind, names in (("numeric", numeric), ("categorical", categorical)) for c in names]
    counted = f.features.agg(
        F.array(
            *[
                F.struct(
                    F.lit(kind).alias("kind"),
                    F.lit(c).alias("feature"),
                    F.count(c).alias("filled"),
                )
                for kind, c in measures
            ]
        ).alias("inputs")
    )
    return counted.select(F.inline("inputs"))


@register(
    "c12_align_columns",
    """SELECT customerID, tenure, MonthlyCharges, CAST(services_count AS DOUBLE) AS services_count,
              CAST(NULL AS DOUBLE) AS avg_rating, CAST(NULL AS BIGINT) AS review_count FROM {features}""",
)
def _(f: Frames) -> DataFrame:
    training = "tenure double, MonthlyCharges double, services_count double, avg_rating double, review_count bigint"
    schema = f.spark.createDataFrame([], training).schema
    return cleaning.align_columns(f.features, schema, keep=["customerID"])


@register(
    "c13_id_fallback",
    """SELECT CASE WHEN key % 7 = 0 THEN 'row-' || CAST(row_number() OVER (ORDER BY key) - 1 AS VARCHAR)
                   ELSE customerID END AS customerID, key
       FROM (SELECT customerID, CAST(customerID AS BIGINT) AS key FROM {raw_accounts}) keyed""",
)
def _(f: Frames) -> DataFrame:
    key = F.col("customerID").cast("bigint")
    rows = f.views.raw_accounts.select(
        F.when(key % 7 != 0, F.col("customerID")).alias("customerID"), key.alias("key")
    )
    return cleaning.fill_ids(rows, "customerID", [F.asc("key")])


_SPOILT = """SELECT customerID,
        CASE WHEN CAST(customerID AS BIGINT) % 40 = 0 THEN -3 WHEN CAST(customerID AS BIGINT) % 41 = 0 THEN 201
             ELSE tenure END AS tenure,
        CASE WHEN CAST(customerID AS BIGINT) % 37 = 0 THEN NULL ELSE MonthlyCharges END AS MonthlyCharges,
        CASE WHEN CAST(customerID AS BIGINT) % 43 = 0 THEN '-1' WHEN CAST(customerID AS BIGINT) % 50 = 0 THEN NULL
             ELSE TotalCharges END AS TotalCharges
        FROM {raw_accounts}"""


@register(
    "c14_scoring_request_contract",
    f"""SELECT customerID, tenure_ok AND monthly_ok AND total_ok AS accepted,
               CAST(NOT tenure_ok AS INTEGER) + CAST(NOT monthly_ok AS INTEGER) + CAST(NOT total_ok AS INTEGER)
                   AS broken_rules
        FROM (SELECT customerID, tenure IS NOT NULL AND tenure BETWEEN 0 AND 200 AS tenure_ok,
                     MonthlyCharges IS NOT NULL AND MonthlyCharges >= 0 AS monthly_ok,
                     TotalCharges IS NULL OR coalesce({number('TotalCharges')} >= 0, FALSE) AS total_ok
              FROM ({_SPOILT}) spoilt) checked""",
)
def _(f: Frames) -> DataFrame:
    spoilt = f.spark.sql(_SPOILT, raw_accounts=f.views.raw_accounts)
    checked = check_scoring_requests(spoilt)
    return checked.select("customerID", "accepted", F.size("reasons").alias("broken_rules"))


@register(
    "c14_batch_sizes",
    "SELECT CAST(floor(CAST(customerID AS BIGINT) / 1000) AS BIGINT) AS batch, count(*) AS size, "
    "count(*) BETWEEN 1 AND 1000 AS accepted FROM {raw_accounts} GROUP BY 1",
)
def _(f: Frames) -> DataFrame:
    batch = F.floor(F.col("customerID").cast("bigint") / 1000).alias("batch")
    return check_batches(f.views.raw_accounts.select(batch), "batch")


@register(
    "c14_question_contract",
    """SELECT question_id, length(question) BETWEEN 3 AND 500
              AND (top_k IS NULL OR top_k BETWEEN 1 AND 25) AS accepted
       FROM (SELECT question_id, question, CAST(nullif(question_id % 29, 28) AS INTEGER) AS top_k
             FROM {questions}) asked""",
)
def _(f: Frames) -> DataFrame:
    top_k = F.nullif(F.col("question_id") % 29, F.lit(28)).cast("int")
    return check_questions(f.views.questions.withColumn("top_k", top_k)).select("question_id", "accepted")


@register(
    "c15_response_schema",
    f"""SELECT customerID AS customer_id, {rnd('churn_probability', 4)} AS churn_probability, risk_band,
               0.5e0 AS decision_threshold, expected_value_of_offer, targeted_by_policy = 1 AS targeted_by_policy,
               recommended_action, 'given' AS model FROM {{predictions}}""",
)
def _(f: Frames) -> DataFrame:
    return decisions.decision_response(f.predictions, fr.THRESHOLD, "given")


# ---------------------------------------------------------------- contract checks

@register("v1_v5_contract_checks", "SELECT * FROM {contract_report}")
def _(f: Frames) -> DataFrame:
    return contract.check_accounts(f.views.raw_accounts)


@register(
    "v3_duplicate_rows",
    f"""SELECT (SELECT count(*) FROM {{raw_accounts_dup}}) - count(*) AS duplicates,
               (SELECT count(*) FROM {{raw_accounts_dup}}) AS "rows"
        FROM (SELECT DISTINCT {_DUP_COLUMNS} FROM {{raw_accounts_dup}}) unique_rows""",
)
def _(f: Frames) -> DataFrame:
    return contract.duplicate_rows(f.views.raw_accounts_dup.drop("seq"))


@register("v6_a13_status_counts", "SELECT status, count(*) AS checks FROM {contract_report} GROUP BY status")
def _(f: Frames) -> DataFrame:
    return contract.status_counts(contract.check_accounts(f.views.raw_accounts))


@register(
    "v6_status_summary",
    """SELECT string_agg(status || '=' || CAST(checks AS VARCHAR), ' | ' ORDER BY status) AS summary
       FROM (SELECT status, count(*) AS checks FROM {contract_report} GROUP BY status) counted""",
)
def _(f: Frames) -> DataFrame:
    return contract.status_summary(contract.check_accounts(f.views.raw_accounts))


# ---------------------------------------------------------------- features

@register("f2_f13_engineered_features", "SELECT * FROM {features}")
def _(f: Frames) -> DataFrame:
    return f.features


@register(
    "f1_total_when_absent",
    """SELECT customerID, coalesce(MonthlyCharges * tenure, 0.0) AS TotalCharges,
              CASE WHEN tenure > 0 THEN coalesce(MonthlyCharges * tenure, 0.0) / tenure ELSE MonthlyCharges END
                  AS avg_charge_per_month
       FROM {clean}""",
)
def _(f: Frames) -> DataFrame:
    rebuilt = features.engineer_features(f.clean.drop("TotalCharges"))
    return rebuilt.select("customerID", "TotalCharges", "avg_charge_per_month")


@register(
    "f8_default_tenure_buckets",
    """SELECT bucket AS tenure_bucket, count(*) AS n FROM (
         SELECT CASE WHEN tenure <= 6 THEN '0-6m' WHEN tenure <= 12 THEN '6-12m' WHEN tenure <= 24 THEN '1-2y'
                     WHEN tenure <= 48 THEN '2-4y' WHEN tenure > 48 THEN '4y+' ELSE 'nan' END AS bucket
         FROM {raw_accounts}) bucketed GROUP BY bucket""",
)
def _(f: Frames) -> DataFrame:
    bucket = features.tenure_bucket(F.col("tenure"), outside="nan").alias("tenure_bucket")
    return kpi.counts_by(f.views.raw_accounts.select(bucket), "tenure_bucket")


@register(
    "f14_a8_review_features",
    "SELECT * REPLACE (CAST(last_review_date AS VARCHAR) AS last_review_date) FROM {review_features}",
)
def _(f: Frames) -> DataFrame:
    return f.review_features.withColumn("last_review_date", F.col("last_review_date").cast("string"))


@register("f15_j1_features_with_reviews", "SELECT * FROM {full_features}")
def _(f: Frames) -> DataFrame:
    return f.full_features


@register(
    "e3_point_in_time_reviews",
    f"""SELECT customerID, count(review_id) AS review_count, {mean('rating')} AS avg_rating
        FROM {{feedback}} JOIN (SELECT customerID, DATE '2000-01-01' + CAST(tenure AS INTEGER) * 8 AS as_of
                                FROM {{clean}}) cutoffs USING (customerID)
        WHERE review_date < as_of GROUP BY customerID""",
)
def _(f: Frames) -> DataFrame:
    as_of = F.date_add(F.lit("2000-01-01").cast("date"), F.col("tenure").cast("int") * 8)
    cutoffs = f.clean.select("customerID", as_of.alias("as_of"))
    past = features.review_features(features.reviews_before(f.views.feedback, cutoffs))
    return past.select("customerID", "review_count", "avg_rating")


# ---------------------------------------------------------------- KPIs

_KPIS = f"""count(*) AS customers, {rnd(mean('Churn') + ' * 100', 2)} AS churn_rate_pct,
    {rnd(total('MonthlyCharges'), 2)} AS monthly_recurring_revenue,
    {rnd(total('MonthlyCharges') + ' * 12', 2)} AS annualised_revenue,
    {rnd(mean('tenure'), 1)} AS avg_tenure_months, {rnd(mean('MonthlyCharges'), 2)} AS arpu"""


@register("a1_executive_kpis", f"SELECT {_KPIS} FROM {{features}}")
def _(f: Frames) -> DataFrame:
    return kpi.executive_kpis(f.features)


@register(
    "a2_contract_risk",
    f"""SELECT Contract AS contract_type, count(*) AS customers, {rnd(mean('Churn') + ' * 100', 2)} AS churn_rate_pct,
               {rnd(total('annual_margin_at_risk'), 2)} AS margin_at_risk FROM {{features}} GROUP BY Contract""",
)
def _(f: Frames) -> DataFrame:
    return kpi.contract_risk(f.features)


@register(
    "a1_a2_u3_kpis_with_contracts",
    f"""SELECT CAST(NULL AS VARCHAR) AS contract_type, 1 AS is_company, {_KPIS},
               {rnd(total('annual_margin_at_risk'), 2)} AS margin_at_risk FROM {{features}}
        UNION ALL
        SELECT Contract, 0, {_KPIS}, {rnd(total('annual_margin_at_risk'), 2)} FROM {{features}} GROUP BY Contract""",
)
def _(f: Frames) -> DataFrame:
    return kpi.kpis_with_contracts(f.features)


@register(
    "a3_contract_table",
    f"""SELECT Contract, count(customerID) AS customers, {mean('Churn')} AS churn_rate,
               {total('annual_margin_at_risk')} AS margin FROM {{features}} GROUP BY Contract""",
)
def _(f: Frames) -> DataFrame:
    return kpi.contract_table(f.features)


@register(
    "a4_tenure_hazard",
    f"""SELECT CAST(ceil(tenure / 6) * 6 AS INTEGER) AS upto_months, {mean('Churn')} AS churn_rate
        FROM {{features}} WHERE tenure > 0 AND tenure <= 78 GROUP BY 1""",
)
def _(f: Frames) -> DataFrame:
    return kpi.tenure_hazard(f.features)


@register(
    "a5_risk_band_counts",
    """SELECT position, b.risk_band, count(customerID) AS customers
       FROM (VALUES (1, 'Low'), (2, 'Medium'), (3, 'High'), (4, 'Critical')) b(position, risk_band)
       LEFT JOIN {predictions} p ON p.risk_band = b.risk_band GROUP BY 1, 2""",
)
def _(f: Frames) -> DataFrame:
    return kpi.risk_band_counts(f.predictions)


_SEGMENT_MEANS = f"""segment_name, count(customerID) AS customers, {mean('Churn')} AS churn_rate,
    {mean('MonthlyCharges')} AS avg_monthly, {mean('tenure')} AS avg_tenure"""


@register("a6_j4_segment_summary", f"SELECT {_SEGMENT_MEANS} FROM {{segments}} GROUP BY segment_name")
def _(f: Frames) -> DataFrame:
    return kpi.segment_summary(f.features, f.segments)


@register(
    "a7_segment_profile",
    f"""SELECT segment_name, customers, {rnd('avg_tenure', 3)} AS avg_tenure, {rnd('avg_monthly', 3)} AS avg_monthly,
               {rnd('churn_rate', 3)} AS churn_rate
        FROM (SELECT {_SEGMENT_MEANS} FROM {{segments}} GROUP BY segment_name) means""",
)
def _(f: Frames) -> DataFrame:
    return kpi.segment_profile(f.features, f.segments)


@register("a10_portfolio_exposure",
          f"SELECT {total('churn_probability * annual_margin_at_risk')} AS margin_at_risk FROM {{joined}}")
def _(f: Frames) -> DataFrame:
    return kpi.portfolio_exposure(f.joined)


@register(
    "a11_campaign_totals",
    f"""SELECT targeted, targeted * 45e0 AS campaign_cost, net AS campaign_net,
               coalesce((net + targeted * 45e0) / nullif(targeted * 45e0, 0), 0.0) AS roi
        FROM (SELECT count(*) AS targeted, coalesce({total('expected_value_of_offer')}, 0.0) AS net
              FROM {{predictions}} WHERE targeted_by_policy = 1) sums""",
)
def _(f: Frames) -> DataFrame:
    return kpi.campaign_totals(f.predictions)


@register(
    "a12_headline_figures",
    f"""SELECT count(*) AS n_customers, {mean('Churn')} AS churn_rate, {total('MonthlyCharges')} AS mrr,
               {mean('MonthlyCharges')} AS arpu, {mean('tenure')} AS avg_tenure FROM {{features}}""",
)
def _(f: Frames) -> DataFrame:
    return kpi.headline_figures(f.features)


@register(
    "a15_scoring_totals",
    f"""SELECT count(*) AS "count", CAST(count_if(targeted_by_policy = 1) AS BIGINT) AS targeted,
               {rnd(total('CASE WHEN targeted_by_policy = 1 THEN expected_value_of_offer END'), 2)}
                   AS total_expected_value FROM {{predictions}}""",
)
def _(f: Frames) -> DataFrame:
    return kpi.scoring_totals(f.predictions)


_NEWEST = "row_number() OVER (PARTITION BY path ORDER BY ts DESC, event_id DESC)"


@register(
    "a16_request_rollup",
    f"""SELECT c.path, requests, errors, "count", p50_ms, p95_ms
        FROM (SELECT path, CAST(count_if(NOT failed) AS BIGINT) AS requests,
                     CAST(count_if(failed) AS BIGINT) AS errors
              FROM {{requests}} GROUP BY path) c
        JOIN (SELECT path, count(*) AS "count", {rnd('quantile_cont(latency_ms, 0.5)', 2)} AS p50_ms,
                     {rnd('quantile_cont(latency_ms, 0.95)', 2)} AS p95_ms
              FROM (SELECT *, {_NEWEST} AS rn FROM {{requests}} WHERE NOT failed) numbered
              WHERE rn <= 500 GROUP BY path) q ON q.path = c.path""",
)
def _(f: Frames) -> DataFrame:
    return request_rollup(f.views.requests, order_by=[F.desc("ts"), F.desc("event_id")])


@register(
    "w6_last_requests_per_path",
    f"""SELECT event_id, path, latency_ms FROM (SELECT *, {_NEWEST} AS rn FROM {{requests}}) numbered
        WHERE rn <= 500""",
)
def _(f: Frames) -> DataFrame:
    newest = last_requests(f.views.requests, "path", [F.desc("ts"), F.desc("event_id")])
    return newest.select("event_id", "path", "latency_ms")


@register("a17_counts_by_source", "SELECT channel, count(*) AS n FROM {feedback} GROUP BY channel")
def _(f: Frames) -> DataFrame:
    return kpi.counts_by(f.views.feedback, "channel")


@register(
    "a18_column_medians",
    """SELECT 'tenure' AS feature, median(tenure) AS median FROM {features}
       UNION ALL SELECT 'MonthlyCharges', median(MonthlyCharges) FROM {features}
       UNION ALL SELECT 'TotalCharges', median(TotalCharges) FROM {features}
       UNION ALL SELECT 'avg_charge_per_month', median(avg_charge_per_month) FROM {features}
       UNION ALL SELECT 'services_count', median(CAST(services_count AS DOUBLE)) FROM {features}""",
)
def _(f: Frames) -> DataFrame:
    names = ["tenure", "MonthlyCharges", "TotalCharges", "avg_charge_per_month", "services_count"]
    return kpi.column_medians(f.features, names)


@register(
    "a19_cluster_centroids",
    f"""SELECT segment_id, {mean('tenure')} AS tenure, {mean('MonthlyCharges')} AS MonthlyCharges,
               {mean('services_count')} AS services_count FROM {{segments}} GROUP BY segment_id""",
)
def _(f: Frames) -> DataFrame:
    return kpi.cluster_centroids(f.segments, ["tenure", "MonthlyCharges", "services_count"], "segment_id")


@register(
    "x18_share_of_total",
    """SELECT Contract, customers, customers / sum(customers) OVER () AS share
       FROM (SELECT Contract, count(*) AS customers FROM {clean} GROUP BY Contract) counted""",
)
def _(f: Frames) -> DataFrame:
    counted = f.clean.groupBy("Contract").agg(F.count(F.lit(1)).alias("customers"))
    return kpi.share_of_total(counted, "Contract", "customers")


@register("x16_date_range", """SELECT strftime(min(review_date), '%Y-%m-%d') AS first_review,
       strftime(max(review_date), '%Y-%m-%d') AS last_review, count(*) AS reviews FROM {feedback}""")
def _(f: Frames) -> DataFrame:
    return f.views.feedback.agg(
        F.date_format(F.min("review_date"), "yyyy-MM-dd").alias("first_review"),
        F.date_format(F.max("review_date"), "yyyy-MM-dd").alias("last_review"),
        F.count(F.lit(1)).alias("reviews"),
    )


