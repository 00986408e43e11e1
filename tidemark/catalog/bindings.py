"""Subscription, telco, experiment and scored inputs derived from the test tables.

Each text runs unchanged in Spark (with ``{table}`` bound to a DataFrame) and in DuckDB (with
the braces removed).
"""

from __future__ import annotations

from string import Formatter

from pyspark.sql import DataFrame, SparkSession

BINDINGS = {
    # Customers and suppliers are accounts; only customers have member, order or event rows.
    "b_label": """
SELECT CAST(c_custkey AS STRING) AS msno, CAST(CASE WHEN c_acctbal < 0 THEN 1 ELSE 0 END AS INT) AS is_churn FROM {customer}
UNION ALL
SELECT concat('s', CAST(s_suppkey AS STRING)) AS msno, CAST(CASE WHEN s_acctbal < 0 THEN 1 ELSE 0 END AS INT) AS is_churn FROM {supplier}""",
    "b_members": """
SELECT CAST(c_custkey AS STRING) AS msno, CAST(c_nationkey AS STRING) AS city,
 CASE WHEN c_custkey % 11 = 0 THEN 'n/a' ELSE CAST(CAST(floor(c_acctbal/100) AS INT) AS STRING) END AS bd,
 CASE c_mktsegment WHEN 'HOUSEHOLD' THEN ' Male ' WHEN 'BUILDING' THEN 'FEMALE' WHEN 'MACHINERY' THEN '' WHEN 'FURNITURE' THEN NULL ELSE 'other' END AS gender,
 CAST(c_custkey % 13 AS STRING) AS registered_via,
 CAST(19940101 + (c_custkey % 12) * 100 + (c_custkey % 28) AS STRING) AS registration_init_time
FROM {customer}""",
    "b_transactions": """
SELECT CAST(o_custkey AS STRING) AS msno, substr(o_orderpriority,1,1) AS payment_method_id,
 CAST(30*(1 + o_orderkey % 6) AS STRING) AS payment_plan_days, CAST(CAST(floor(o_totalprice/4) AS BIGINT) AS STRING) AS plan_list_price,
 CAST(paid AS STRING) AS actual_amount_paid,
 CASE o_orderstatus WHEN 'O' THEN '1' WHEN 'P' THEN '0' ELSE '2' END AS is_auto_renew,
 CAST(year(o_orderdate)*10000+month(o_orderdate)*100+day(o_orderdate) AS STRING) AS transaction_date,
 CAST(year(e)*10000+month(e)*100+day(e) AS STRING) AS membership_expire_date,
 CASE WHEN o_orderpriority='5-LOW' THEN '1' ELSE '0' END AS is_cancel
FROM (SELECT o.*, o_orderdate + INTERVAL '30' DAY * (1 + o_orderkey % 6) AS e, CAST(floor(o_totalprice * (100 - o_orderkey % 10) / 400) AS BIGINT) AS paid FROM {orders} o) x""",
    # The largest table in the role of the transaction history: few users with many rows each.
    "b_line_transactions": """
SELECT CAST(l_suppkey AS STRING) AS msno, CAST(l_linenumber AS STRING) AS payment_method_id,
 CAST(30*(1 + l_orderkey % 6) AS STRING) AS payment_plan_days, CAST(CAST(floor(l_extendedprice) AS BIGINT) AS STRING) AS plan_list_price,
 CAST(CAST(floor(l_extendedprice * (100 - l_orderkey % 10) / 100) AS BIGINT) AS STRING) AS actual_amount_paid,
 CASE l_returnflag WHEN 'A' THEN '1' WHEN 'N' THEN '0' ELSE '2' END AS is_auto_renew,
 CAST(year(l_shipdate)*10000+month(l_shipdate)*100+day(l_shipdate) AS STRING) AS transaction_date,
 CASE WHEN l_partkey % 17 = 0 THEN NULL ELSE CAST(year(e)*10000+month(e)*100+day(e) AS STRING) END AS membership_expire_date,
 CASE WHEN l_linestatus='F' THEN '1' ELSE '0' END AS is_cancel
FROM (SELECT l.*, l_shipdate + INTERVAL '30' DAY * (1 + l_orderkey % 6) AS e FROM {lineitem} l) x""",
    "b_logs": """
SELECT CAST(user_id AS STRING) AS msno, CAST(d AS STRING) AS date,
 CAST(SUM(CASE WHEN event_type='error' THEN 1 ELSE 0 END) AS STRING) AS num_25,
 CAST(SUM(CASE WHEN event_type='signup' THEN 1 ELSE 0 END) AS STRING) AS num_50,
 CAST(SUM(CASE WHEN event_type='view' THEN 1 ELSE 0 END) AS STRING) AS num_75,
 CAST(SUM(CASE WHEN event_type='click' THEN 1 ELSE 0 END) AS STRING) AS num_985,
 CAST(SUM(CASE WHEN event_type='purchase' THEN 1 ELSE 0 END) AS STRING) AS num_100,
 CAST(COUNT(DISTINCT props) AS STRING) AS num_unq,
 CAST(CAST(round(SUM(value)*60) AS BIGINT) AS STRING) AS total_secs
FROM (SELECT e.*, year(ts)*10000+month(ts)*100+day(ts) AS d FROM {events} e) y GROUP BY user_id, d""",
    "b_experiment": """
SELECT c_custkey AS id, CAST(c_custkey % 2 AS INT) AS treatment, CAST(CASE WHEN c_acctbal < 0 THEN 1 ELSE 0 END AS DOUBLE) AS outcome,
 c_mktsegment AS segment, CAST(20 + 6*(c_custkey % 10) AS DOUBLE)/100 AS propensity, CAST((c_custkey*7919) % 1000 AS DOUBLE)/1000 AS score FROM {customer}""",
    "b_scored": """
SELECT c_custkey AS id, CAST(CASE WHEN c_acctbal < 2000 THEN 1 ELSE 0 END AS INT) AS y,
 CAST((c_custkey*7919) % 1000 AS DOUBLE)/1000 AS p, CAST(floor(abs(c_acctbal)) AS DOUBLE)/100 AS MonthlyCharges FROM {customer}""",
    # One driver per customer, named after a feature, and five signed contributions.
    "b_drivers": """
SELECT c_custkey AS id, CAST((c_custkey*7919) % 1000 AS DOUBLE)/1000 AS churn_probability,
 concat(CASE c_custkey % 9 WHEN 0 THEN 'num__songs_played_avg' WHEN 1 THEN 'cat__PaymentMethod_' WHEN 2 THEN 'num__days_since_last_' WHEN 3 THEN 'num__tenure'
  WHEN 4 THEN 'num__MonthlyCharges' WHEN 5 THEN 'cat__TechSupport_' WHEN 6 THEN 'num__num_unq_' WHEN 7 THEN 'cat__Contract_' ELSE 'x_' END, lower(c_mktsegment)) AS feature,
 CAST((c_custkey*31) % 201 - 100 AS DOUBLE)/100 AS v0, CAST((c_custkey*57) % 181 - 90 AS DOUBLE)/100 AS v1, CAST((c_custkey*83) % 161 - 80 AS DOUBLE)/100 AS v2,
 CAST((c_custkey*11) % 221 - 110 AS DOUBLE)/100 AS v3, CAST((c_custkey*19) % 191 - 95 AS DOUBLE)/100 AS v4 FROM {customer}""",
    "b_telco": """
SELECT CAST(c_custkey AS STRING) AS customerID,
 CASE WHEN c_custkey % 2 = 0 THEN 'Male' ELSE 'Female' END AS gender,
 CAST(CASE WHEN c_custkey % 6 = 0 THEN 1 ELSE 0 END AS INT) AS SeniorCitizen,
 CASE WHEN c_custkey % 3 = 0 THEN 'Yes' ELSE 'No' END AS Partner,
 CASE WHEN c_custkey % 4 = 0 THEN 'Yes' ELSE 'No' END AS Dependents,
 CAST(c_custkey % 76 AS INT) AS tenure,
 CASE WHEN c_custkey % 10 < 9 THEN 'Yes' ELSE 'No' END AS PhoneService,
 CASE c_custkey % 3 WHEN 0 THEN 'Yes' WHEN 1 THEN 'No' ELSE 'No phone service' END AS MultipleLines,
 CASE c_custkey % 5 WHEN 0 THEN 'DSL' WHEN 1 THEN 'No' ELSE 'Fiber optic' END AS InternetService,
 CASE WHEN c_custkey % 7 < 3 THEN 'Yes' WHEN c_custkey % 29 = 0 THEN NULL ELSE 'No' END AS OnlineSecurity,
 CASE WHEN c_custkey % 7 > 3 THEN 'Yes' ELSE 'No' END AS OnlineBackup,
 CASE WHEN c_custkey % 8 < 4 THEN 'Yes' ELSE 'No internet service' END AS DeviceProtection,
 CASE WHEN c_custkey % 9 < 2 THEN 'Yes' ELSE 'No' END AS TechSupport,
 CASE WHEN c_custkey % 11 < 5 THEN 'Yes' ELSE 'No' END AS StreamingTV,
 CASE WHEN c_custkey % 13 < 6 THEN 'Yes' ELSE 'No' END AS StreamingMovies,
 CASE c_custkey % 4 WHEN 0 THEN 'Two year' WHEN 1 THEN 'One year' ELSE 'Month-to-month' END AS Contract,
 CASE WHEN c_custkey % 5 < 3 THEN 'Yes' ELSE 'No' END AS PaperlessBilling,
 CASE WHEN c_custkey % 19 = 0 THEN NULL WHEN c_custkey % 4 = 0 THEN 'Electronic check' WHEN c_custkey % 4 = 1 THEN 'Mailed check' WHEN c_custkey % 4 = 2 THEN 'Bank transfer (automatic)' ELSE 'Credit card (automatic)' END AS PaymentMethod,
 18 + CAST((c_custkey * 37) % 1000 AS DOUBLE) / 10 AS MonthlyCharges,
 CASE WHEN c_custkey % 23 = 0 THEN ' ' ELSE CAST((c_custkey % 76) * (18 + (c_custkey * 37) % 1000) AS STRING) END AS TotalCharges,
 CASE WHEN c_acctbal < 2000 THEN 'Yes' ELSE 'No' END AS Churn FROM {customer}""",
}


def _tables(text: str) -> list[str]:
    return sorted({name for _, name, _, _ in Formatter().parse(text) if name})


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def bind(spark: SparkSession, sf_dir: str, name: str, **override: DataFrame) -> DataFrame:
    """The binding as a DataFrame; ``override`` replaces a source table (e.g. by a stream)."""
    text = BINDINGS[name]
    frames = {t: override[t] if t in override else table(spark, sf_dir, t) for t in _tables(text)}
    return spark.sql(text, **frames)


def cte(*names: str) -> str:
    """The bindings as CTE text for DuckDB (no leading WITH, no trailing comma)."""
    parts = []
    for name in names:
        text = BINDINGS[name]
        parts.append(f"{name} AS ({text.format(**{t: t for t in _tables(text)})}\n)")
    return ",\n".join(parts)
