"""The benchmark tables seen as accounts, feedback, requests, questions and vectors.

The SQL is neutral between Spark and the checking engine, so both sides start from the
same rows. ``{name}`` stands for a table or an earlier view, ``{n_name}`` for its row count.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidemark.sources.files import read_parquet

TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
)

LONG_TEXT = ("documents",)  # whole texts: the work per row dwarfs the scan

VIEWS: dict[str, str] = {
    # Lines are summed per order, orders per customer: every join meets unique keys.
    "raw_accounts": """
        WITH line AS (
            SELECT l_orderkey,
                   count(*) AS n,
                   count_if(l_returnflag = 'R') AS n_r,
                   count_if(l_returnflag = 'A') AS n_a,
                   count_if(l_linestatus = 'O') AS n_o,
                   count_if(l_quantity > 25) AS n_q,
                   count_if(l_discount >= 0.05) AS n_d,
                   count_if(l_tax >= 0.04) AS n_t,
                   max(l_linenumber) AS last_line
            FROM {lineitem} GROUP BY l_orderkey
        ), history AS (
            SELECT o_custkey,
                   count(*) AS n_orders,
                   sum(CAST(o_totalprice AS DECIMAL(18,2))) AS billed,
                   min(year(o_orderdate) * 12 + month(o_orderdate)) AS first_month,
                   max(o_orderdate) AS last_order,
                   max_by(o_orderpriority, o_orderkey) AS priority,
                   sum(n) AS n, sum(n_r) AS n_r, sum(n_a) AS n_a, sum(n_o) AS n_o,
                   sum(n_q) AS n_q, sum(n_d) AS n_d, sum(n_t) AS n_t, max(last_line) AS last_line
            FROM {orders} LEFT JOIN line ON l_orderkey = o_orderkey
            GROUP BY o_custkey
        )
        SELECT CAST(c_custkey AS STRING) AS customerID,
               CASE WHEN c_custkey % 2 = 0 THEN 'Female' ELSE 'Male' END AS gender,
               CASE WHEN c_acctbal < 0 THEN '1' ELSE '0' END AS SeniorCitizen,
               CASE WHEN c_custkey % 83 = 0 THEN NULL WHEN c_acctbal > 4500 THEN 'Yes' ELSE 'No' END AS Partner,
               CASE WHEN c_nationkey % 3 = 0 THEN 'Yes' ELSE 'No' END AS Dependents,
               2001 * 12 + 8 - first_month AS tenure,
               CASE WHEN 3 * n_r >= n THEN 'Yes' ELSE 'No' END AS PhoneService,
               CASE WHEN 2 * n_o >= n THEN 'Yes' ELSE 'No' END AS MultipleLines,
               CASE WHEN c_nationkey % 4 = 0 THEN 'No' WHEN c_nationkey % 4 = 1 THEN 'DSL'
                    ELSE 'Fiber optic' END AS InternetService,
               CASE WHEN 3 * n_a >= n THEN 'Yes' ELSE 'No' END AS OnlineSecurity,
               CASE WHEN 2 * n_q >= n THEN 'Yes' ELSE 'No' END AS OnlineBackup,
               CASE WHEN 2 * n_d >= n THEN 'Yes' ELSE 'No' END AS DeviceProtection,
               CASE WHEN 2 * n_t >= n THEN 'Yes' ELSE 'No' END AS TechSupport,
               CASE WHEN 3 * (n_a + n_r) >= 2 * n THEN 'Yes' ELSE 'No' END AS StreamingTV,
               CASE WHEN last_line >= 7 THEN 'Yes' ELSE 'No' END AS StreamingMovies,
               CASE c_mktsegment WHEN 'AUTOMOBILE' THEN 'Month-to-month' WHEN 'BUILDING' THEN 'Month-to-month'
                    WHEN 'MACHINERY' THEN 'Two year' ELSE 'One year' END AS Contract,
               CASE WHEN c_nationkey % 2 = 0 THEN 'Yes' ELSE 'No' END AS PaperlessBilling,
               CASE priority WHEN '1-URGENT' THEN 'Electronic check' WHEN '2-HIGH' THEN 'Mailed check'
                    WHEN '3-MEDIUM' THEN 'Bank transfer (automatic)'
                    WHEN '4-NOT SPECIFIED' THEN 'Credit card (automatic)'
                    ELSE 'Electronic check' END AS PaymentMethod,
               floor(CAST(billed AS DOUBLE) * 100 / (n_orders * 2500)) / CAST(100 AS DOUBLE) AS MonthlyCharges,
               CASE WHEN c_custkey % 50 = 0 THEN ' '
                    ELSE CAST(CAST(billed AS DECIMAL(28,2)) * CAST(0.002 AS DECIMAL(4,3)) AS STRING)
               END AS TotalCharges,
               CASE WHEN last_order >= TIMESTAMP '2000-08-01 00:00:00' THEN 'No' ELSE 'Yes' END AS Churn
        FROM {customer} LEFT JOIN history ON o_custkey = c_custkey
    """,
    # Defects on purpose: exact copies (every 250th) and changed copies (every 100th).
    "raw_accounts_dup": """
        SELECT *, CAST(customerID AS BIGINT) AS seq FROM {raw_accounts}
        UNION ALL
        SELECT *, CAST(customerID AS BIGINT) AS seq FROM {raw_accounts}
        WHERE CAST(customerID AS BIGINT) % 250 = 0
        UNION ALL
        SELECT customerID, gender, SeniorCitizen, Partner, Dependents, tenure, PhoneService, MultipleLines,
               InternetService, OnlineSecurity, OnlineBackup, DeviceProtection, TechSupport, StreamingTV,
               StreamingMovies, Contract, PaperlessBilling, PaymentMethod,
               MonthlyCharges + 1 AS MonthlyCharges, TotalCharges, Churn,
               CAST(customerID AS BIGINT) + 1000000000000 AS seq
        FROM {raw_accounts} WHERE CAST(customerID AS BIGINT) % 100 = 0
    """,
    "feedback": """
        SELECT concat('R', CAST(d.doc_id AS STRING)) AS review_id,
               CAST((d.doc_id * 7) % CAST(floor({n_customer} / 2) AS BIGINT) AS STRING)
                   AS customerID,
               DATE '2000-01-01' + CAST(d.doc_id % 730 AS INT) AS review_date,
               d.source AS channel,
               CASE WHEN toxic = 1 THEN 1 WHEN quality = 0 THEN 2 WHEN quality = 1 THEN 4 ELSE 3 END AS rating,
               d.text AS review_text,
               d.lang AS lang
        FROM {documents} d LEFT JOIN {labels} l ON l.doc_id = d.doc_id
    """,
    "requests": """
        SELECT event_id, event_type AS path, value AS latency_ms, ts, value < 1 AS failed FROM {events}
    """,
    # Texts as evidence of four kinds, each with a stored embedding dealt out by position.
    "evidence": """
        SELECT concat('D', CAST(d.doc_id AS STRING)) AS doc_id, d.text AS text,
               CASE CAST(substring(d.source, 4) AS INT) % 4 WHEN 0 THEN 'kpi' WHEN 1 THEN 'model_driver'
                    WHEN 2 THEN 'topic_summary' ELSE 'review' END AS source,
               CAST(d.doc_id % 101 AS DOUBLE) / 100 AS negative_share,
               e.embedding AS embedding
        FROM {documents} d JOIN {embeddings} e ON e.vec_id = d.doc_id % {n_embeddings}
    """,
    "questions": """
        SELECT b.item_id AS question_id,
               concat(CASE b.item_id % 5 WHEN 0 THEN 'Why are customers leaving? '
                                         WHEN 1 THEN 'Complaints about price and support: '
                                         WHEN 2 THEN 'Is delivery a risk? '
                                         WHEN 3 THEN 'Revenue of loyal accounts. '
                                         ELSE '' END, b.text) AS question,
               e.embedding AS embedding
        FROM {benchmark} b JOIN {embeddings} e ON e.vec_id = (b.item_id * 3) % {n_embeddings}
    """,
    "vectors": "SELECT vec_id AS doc_id, label AS source, embedding FROM {embeddings}",
}


class Views:
    """Tables and views of one scale folder as DataFrames, built on first use."""

    def __init__(self, spark: SparkSession, folder: str) -> None:
        self.spark = spark
        self.folder = folder
        self._built: dict[str, DataFrame] = {}

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_") or (name not in TABLES and name not in VIEWS):
            raise AttributeError(name)
        if name not in self._built:
            self._built[name] = self._build(name)
        return self._built[name]

    def _build(self, name: str) -> DataFrame:
        if name in TABLES:
            return read_parquet(self.spark, f"{self.folder}/{name}.parquet", spread=name in LONG_TEXT)
        sql = VIEWS[name]
        needed = {n: getattr(self, n) for n in (*TABLES, *VIEWS) if "{" + n + "}" in sql}
        needed |= {f"n_{n}": getattr(self, n).count() for n in TABLES if "{n_" + n + "}" in sql}
        return self.spark.sql(sql, **needed)
