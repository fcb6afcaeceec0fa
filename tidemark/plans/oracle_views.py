"""Shared parts of the checks, written in SQL on their own terms."""

from __future__ import annotations

from tidemark.plans import frames as fr
from tidemark.settings import CONTRACT
from tidemark.sources.files import ACCOUNT_FIELDS


def rnd(value: str, digits: int) -> str:
    return f"CAST(round(CAST({value} AS DECIMAL(30,10)), {digits}) AS DOUBLE)"


def total(value: str, scale: int = 6) -> str:
    return f"CAST(sum(CAST({value} AS DECIMAL(28,{scale}))) AS DOUBLE)"


def mean(value: str, scale: int = 6) -> str:
    return f"({total(value, scale)} / count({value}))"


def number(value: str) -> str:
    return f"try_cast(nullif(trim(CAST({value} AS VARCHAR)), '') AS DOUBLE)"


def strings(words) -> str:
    return ", ".join("'" + w.replace("'", "''") + "'" for w in words)


_TEXT_COLUMNS = (
    "gender", "Partner", "Dependents", "PhoneService", "MultipleLines", "InternetService",
    "OnlineSecurity", "OnlineBackup", "DeviceProtection", "TechSupport", "StreamingTV",
    "StreamingMovies", "Contract", "PaperlessBilling", "PaymentMethod",
)
_SERVICES = (
    "PhoneService", "MultipleLines", "OnlineSecurity", "OnlineBackup", "DeviceProtection",
    "TechSupport", "StreamingTV", "StreamingMovies",
)


def repaired(source: str) -> str:
    """Coercion, billing repair, Unknown, medians and target of any raw account table."""
    filled = ",\n".join(f"coalesce({c}, 'Unknown') AS {c}" for c in _TEXT_COLUMNS)
    return f"""
        SELECT coalesce(customerID, 'Unknown') AS customerID,
               {filled},
               coalesce(SeniorCitizen, median(SeniorCitizen) OVER ()) AS SeniorCitizen,
               coalesce(tenure, median(tenure) OVER ()) AS tenure,
               coalesce(MonthlyCharges, median(MonthlyCharges) OVER ()) AS MonthlyCharges,
               coalesce(TotalCharges, MonthlyCharges * tenure, 0.0) AS TotalCharges,
               CAST(lower(trim(Churn)) IN ('yes', 'y', 'true', '1', 'churned') AS INTEGER) AS Churn
        FROM (SELECT * REPLACE ({number('SeniorCitizen')} AS SeniorCitizen, CAST(tenure AS DOUBLE) AS tenure,
                     CAST(MonthlyCharges AS DOUBLE) AS MonthlyCharges, {number('TotalCharges')} AS TotalCharges)
              FROM {source}) numbers
    """


def bucket(edges, labels) -> str:
    cases = []
    for edge, label in zip(edges, labels, strict=True):
        reach = "" if edge == float("inf") else f" AND tenure <= {edge}"
        cases.append(f"WHEN tenure > -0.1{reach} THEN '{label}'")
    return f"CASE {' '.join(cases)} END"


def engineered(source: str, edges=fr.TENURE_EDGES, labels=fr.TENURE_LABELS) -> str:
    services = " + ".join(f"CAST({c} = 'Yes' AS INTEGER)" for c in _SERVICES)
    return f"""
        SELECT *, MonthlyCharges - avg_charge_per_month AS charge_drift,
               coalesce((MonthlyCharges - avg_charge_per_month) / nullif(avg_charge_per_month, 0), 0.0)
                   AS charge_drift_pct
        FROM (SELECT *,
               CASE WHEN tenure > 0 THEN TotalCharges / tenure ELSE MonthlyCharges END AS avg_charge_per_month,
               TotalCharges AS clv_to_date,
               {services} AS services_count,
               CAST(TechSupport = 'Yes' OR OnlineSecurity = 'Yes' AS INTEGER) AS has_premium_support,
               {bucket(edges, labels)} AS tenure_bucket,
               CAST(tenure <= 6 AS INTEGER) AS is_new_customer,
               CAST(Contract = 'Month-to-month' AS INTEGER) AS is_month_to_month,
               CAST(PaymentMethod IN ('Electronic check', 'Mailed check') AS INTEGER) AS is_manual_payment,
               MonthlyCharges * 12 AS annual_revenue_at_risk,
               MonthlyCharges * 12 * 0.35e0 AS annual_margin_at_risk
        FROM {source}) priced
    """


def value_of_offer(p: str = "churn_probability", monthly: str = "MonthlyCharges") -> str:
    return f"({p} * 0.3e0 * ({monthly} * 0.35e0 * 12) - 45)"


_STOP = strings(fr.TEXT_STOP_WORDS)


def word_list(text: str, stop: str) -> str:
    found = f"regexp_extract_all(lower({text}), '[\\p{{L}}\\p{{N}}_]{{{{2,}}}}')".replace("{{2,}}", "{2,}")
    return f"list_filter({found}, lambda w: w NOT IN ({stop}))"


def term_rows(source: str, key: str, text: str, stop: str = _STOP) -> str:
    """(key, term, tf) of words and neighbouring pairs."""
    return f"""
        SELECT {key}, term, count(*) AS tf FROM (
            SELECT {key}, word AS term FROM words
            UNION ALL
            SELECT {key}, word || ' ' || following FROM
                (SELECT {key}, word, lead(word) OVER (PARTITION BY {key} ORDER BY i) AS following FROM words) pairs
            WHERE following IS NOT NULL
        ) all_terms GROUP BY {key}, term
    """.replace(
        "FROM words",
        f"FROM (SELECT {key}, unnest(list) AS word, generate_subscripts(list, 1) AS i FROM "
        f"(SELECT {key}, {word_list(text, stop)} AS list FROM {source}) lists) words",
    )


def sentiment_sql() -> str:
    weights = {**fr.TEXT_POSITIVE, **{w: -v for w, v in fr.TEXT_NEGATIVE.items()}}
    rows = ", ".join(f"('{w}', {v}e0)" for w, v in weights.items())
    negators = strings(fr.TEXT_NEGATORS)
    return f"""
        WITH lexicon(word, weight) AS (VALUES {rows}),
        tokens AS (SELECT review_id, unnest(string_split(clean_text, ' ')) AS word,
                          generate_subscripts(string_split(clean_text, ' '), 1) AS i FROM {{corpus}}),
        placed AS (SELECT review_id, word,
                          lag(word, 1, '') OVER w IN ({negators}) OR lag(word, 2, '') OVER w IN ({negators}) AS flipped
                   FROM tokens WINDOW w AS (PARTITION BY review_id ORDER BY i)),
        scores AS (SELECT review_id, CASE WHEN flipped THEN weight * -0.8e0 ELSE weight END AS polarity
                   FROM placed JOIN lexicon USING (word)),
        summed AS (SELECT review_id, {rnd('sum(polarity) / sum(abs(polarity))', 10)} AS score
                   FROM scores GROUP BY review_id)
        SELECT c.*, coalesce(score, 0.0) AS sentiment_score,
               CASE WHEN coalesce(score, 0.0) > 0.15 THEN 'positive'
                    WHEN coalesce(score, 0.0) < -0.15 THEN 'negative' ELSE 'neutral' END AS sentiment_label,
               'lexicon' AS sentiment_backend
        FROM {{corpus}} c LEFT JOIN summed USING (review_id)
    """


def contract_report(source: str) -> str:
    """The 32 checks of the account table, one SELECT per check."""
    rows = []

    def add(check: str, column: str, status: str, observed: str, threshold: str, detail: str) -> None:
        rows.append(
            f"""SELECT '{check}' AS "check", '{column}' AS "column", {status} AS status,
                {rnd(observed, 5)} AS observed, CAST({threshold} AS DOUBLE) AS threshold, {detail} AS detail
                FROM {source}"""
        )

    for c in CONTRACT.required:
        add("column_exists", c, "'PASS'", "1.0 + 0 * count(*)", "1.0", "''")
    for c in ACCOUNT_FIELDS:
        part = f"(CAST(count_if({c} IS NULL) AS DOUBLE) / count(*))"
        add("null_fraction", c, f"CASE WHEN {part} <= 0.05 THEN 'PASS' ELSE 'WARN' END", part, "0.05", "''")
    repeats = f"(count(*) - (SELECT count(*) FROM (SELECT DISTINCT * FROM {source}) d))"
    add("duplicate_fraction", "<row>", f"CASE WHEN {repeats} = 0 THEN 'PASS' ELSE 'WARN' END",
        f"CAST({repeats} AS DOUBLE) / count(*)", "0.0",
        f"CAST({repeats} AS VARCHAR) || ' exact duplicate rows (deduplicated downstream)'")
    for c, (low, high) in CONTRACT.ranges.items():
        part = f"(CAST(count_if({number(c)} < {low} OR {number(c)} > {high}) AS DOUBLE) / count(*))"
        add("value_in_range", c, f"CASE WHEN {part} = 0 THEN 'PASS' ELSE 'FAIL' END", part, "0.0",
            f"'expected [{low}, {high}]'")
    rate = "(CAST(count_if(lower(trim(Churn)) = 'yes') AS DOUBLE) / count(*))"
    add("target_base_rate", "Churn", f"CASE WHEN {rate} BETWEEN 0.02 AND 0.8 THEN 'PASS' ELSE 'FAIL' END",
        rate, "NULL",
        f"CASE WHEN {rate} BETWEEN 0.02 AND 0.8 THEN '' ELSE 'churn base rate outside plausible range' END")
    return "\nUNION ALL\n".join(rows)


ORACLE_VIEWS: dict[str, str] = {
    "contract_report": contract_report("{raw_accounts}"),
    "repaired_dup": repaired("(SELECT * EXCLUDE (seq) FROM {raw_accounts_dup}) copies"),
    "clean": repaired("{raw_accounts}"),
    "features": engineered("{clean}"),
    "review_features": f"""
        SELECT customerID, count(review_id) AS review_count, {mean('rating')} AS avg_rating,
               min(rating) AS min_rating, max(review_date) AS last_review_date,
               CAST(min(rating) <= 2 AS INTEGER) AS has_negative_review
        FROM {{feedback}} WHERE customerID IS NOT NULL GROUP BY customerID
    """,
    "full_features": """
        SELECT f.*, coalesce(review_count, 0) AS review_count,
               coalesce(avg_rating, median(avg_rating) OVER ()) AS avg_rating,
               coalesce(CAST(min_rating AS DOUBLE), avg_rating, median(avg_rating) OVER ()) AS min_rating,
               coalesce(has_negative_review, 0) AS has_negative_review
        FROM {features} f LEFT JOIN {review_features} USING (customerID)
    """,
    "scored": """
        SELECT *, CAST(CAST(customerID AS BIGINT) * 37 % 1000 AS DOUBLE) / 1000 AS churn_probability,
               Churn AS label
        FROM {features}
    """,
    "predictions": f"""
        SELECT customerID, churn_probability,
               CASE WHEN churn_probability >= 0.7e0 THEN 'Critical' WHEN churn_probability >= 0.5e0 THEN 'High'
                    WHEN churn_probability >= 0.3e0 THEN 'Medium' ELSE 'Low' END AS risk_band,
               {rnd('ev', 2)} AS expected_value_of_offer,
               {rnd('MonthlyCharges * 0.35e0 * 12', 2)} AS margin_at_risk,
               CAST(hit AS INTEGER) AS targeted_by_policy,
               CASE WHEN hit AND churn_probability >= 0.7e0 THEN 'Priority save call + retention offer'
                    WHEN hit THEN 'Retention offer / contract upgrade'
                    WHEN churn_probability >= 0.5e0 THEN 'Monitor — offer not economic at this margin'
                    ELSE 'No action' END AS recommended_action
        FROM (SELECT *, churn_probability >= 0.5e0 AND ev > 0 AS hit
              FROM (SELECT *, {value_of_offer()} AS ev FROM {{scored}}) valued) flagged
    """,
    "joined": """
        SELECT p.*, f.tenure, f.MonthlyCharges, f.Contract, f.annual_margin_at_risk
        FROM {predictions} p LEFT JOIN {features} f USING (customerID)
    """,
    # RE2 knows only ASCII word edges: a letter outside ASCII becomes an underscore, which is
    # a word character and is dropped by the last step like the letter itself.
    "corpus": r"""
        SELECT *, CASE WHEN clean_text = '' THEN 0 ELSE len(string_split(clean_text, ' ')) END AS token_count
        FROM (SELECT *, trim(regexp_replace(regexp_replace(regexp_replace(lower(
                 regexp_replace(regexp_replace(regexp_replace(
                     regexp_replace(review_text, '[^\x00-\x7F]', '_', 'g'),
                     '\S+@\S+\.\S+', ' <email> ', 'g'),
                     'https?://\S+|www\.\S+', ' <url> ', 'g'),
                     '(?i)\b(?:order|ticket|ref|case)[\s#:-]*[A-Z0-9]{4,}\b', ' <ref> ', 'g')),
                 '\b\d[\d,]*(?:\.\d+)?\b', ' <num> ', 'g'),
                 '[^a-z<>\s'']', ' ', 'g'),
                 '\s+', ' ', 'g')) AS clean_text
              FROM {feedback}) masked
        WHERE CASE WHEN clean_text = '' THEN 0 ELSE len(string_split(clean_text, ' ')) END >= 3
    """,
    "sentiment": sentiment_sql(),
    "topics": """
        SELECT *, CAST(substring(channel, 4) AS INTEGER) % 8 AS topic_id,
               'theme ' || CAST(CAST(substring(channel, 4) AS INTEGER) % 8 AS VARCHAR) AS topic_label
        FROM {sentiment}
    """,
    "topic_summary": f"""
        SELECT topic_id, topic_label, count(review_id) AS documents,
               {rnd(mean('sentiment_score'), 4)} AS avg_sentiment,
               {rnd("CAST(count_if(sentiment_label = 'negative') AS DOUBLE) / count(*)", 4)} AS negative_share,
               {rnd(mean('rating'), 4)} AS avg_rating,
               count(DISTINCT customerID) AS customers_affected
        FROM {{topics}} GROUP BY topic_id, topic_label
    """,
    "segments": """
        SELECT *, 'segment ' || CAST(segment_id AS VARCHAR) AS segment_name FROM (
            SELECT *, 4 * CAST(MonthlyCharges >= 100 AS INTEGER) + 2 * CAST(tenure >= 72 AS INTEGER)
                      + CAST(services_count >= 5 AS INTEGER) AS segment_id
            FROM {features}) assigned
    """,
    "contributions": "\nUNION ALL\n".join(
        f"""SELECT customerID, '{name}' AS feature,
            {weight}e0 * (CAST({name} AS DOUBLE) - (SELECT {mean(name)} FROM {{features}})) AS contribution
            FROM {{features}}"""
        for name, weight in fr.LINEAR_MODEL.items()
    ),
    "evidence_terms": term_rows("{evidence}", "doc_id", "text"),
    "vocabulary": """
        SELECT term, df, ln((1.0 + (SELECT count(*) FROM {evidence})) / (1 + df)) + 1.0 AS idf
        FROM (SELECT term, count(*) AS df, sum(tf) AS occurrences FROM {evidence_terms} GROUP BY term) counted
        ORDER BY occurrences DESC, term LIMIT 20000
    """,
    "postings": """
        SELECT doc_id, term, raw / sqrt(sum(raw * raw) OVER (PARTITION BY doc_id)) AS weight
        FROM (SELECT doc_id, term, tf * idf AS raw FROM {evidence_terms} JOIN {vocabulary} USING (term)) weighted
    """,
    "question_terms": term_rows("{questions}", "question_id", "question"),
    "question_postings": """
        SELECT question_id, term, raw / sqrt(sum(raw * raw) OVER (PARTITION BY question_id)) AS weight
        FROM (SELECT question_id, term, tf * idf AS raw FROM {question_terms} JOIN {vocabulary} USING (term)) weighted
    """,
    "lexical": f"""
        SELECT question_id, doc_id,
               {rnd('raw / max(raw) OVER (PARTITION BY question_id)', 8)} AS lexical
        FROM (SELECT question_id, doc_id, sum(p.weight * q.weight) AS raw
              FROM {{postings}} p JOIN {{question_postings}} q USING (term)
              GROUP BY question_id, doc_id) overlap
    """,
    "hybrid": f"""
        SELECT question_id, doc_id, source, dense, lexical,
               {rnd('0.65e0 * dense + 0.35e0 * lexical', 10)} AS score
        FROM (SELECT q.question_id, d.doc_id, d.source,
                     {rnd('list_cosine_similarity(CAST(q.embedding AS DOUBLE[]), CAST(d.embedding AS DOUBLE[]))', 8)}
                         AS dense,
                     coalesce(l.lexical, 0.0) AS lexical
              FROM {{questions}} q CROSS JOIN {{evidence}} d
              LEFT JOIN {{lexical}} l ON l.question_id = q.question_id AND l.doc_id = d.doc_id) parts
    """,
    "quotas": "SELECT * FROM (VALUES ('kpi', 3), ('model_driver', 3), ('topic_summary', 6), ('review', 4)) q(source, quota)",
    "hits": """
        SELECT question_id, doc_id, source, dense, lexical, score, text, negative_share,
               CAST(row_number() OVER (PARTITION BY question_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank
        FROM (SELECT h.*, row_number() OVER (PARTITION BY question_id, source ORDER BY score DESC, doc_id) AS place
              FROM {hybrid} h) placed
        JOIN {quotas} USING (source)
        JOIN (SELECT doc_id, text, negative_share FROM {evidence}) texts USING (doc_id)
        WHERE place <= quota
    """,
}
