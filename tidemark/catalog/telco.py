"""Telco customer features."""

from __future__ import annotations

from ..fixed_values import SERVICE_COLUMNS
from ..functions.telco import engineer_telco, fit_bill_cutoffs
from ..operators.subscription import column_roles, fill_categories
from .bindings import bind, cte
from .registry import query, rounded, rounded_sql

_SERVICES = " + ".join(f"CAST(coalesce({c} = 'Yes', false) AS INT)" for c in SERVICE_COLUMNS)


def _flags(conditions: dict[str, str]) -> str:
    return ", ".join(f"CAST(coalesce({cond}, false) AS INT) AS {name}" for name, cond in conditions.items())


_m2m, _support = "Contract = 'Month-to-month'", "(coalesce(OnlineSecurity, '') = 'Yes' OR coalesce(TechSupport, '') = 'Yes')"
FEATURES = (
    "WITH " + cte("b_telco") + ",\n"
    "q AS (SELECT quantile_cont(MonthlyCharges, 0.75) AS p75, quantile_cont(MonthlyCharges, 0.5) AS med FROM b_telco),\n"
    "typed AS (SELECT * EXCLUDE (TotalCharges), coalesce(TRY_CAST(trim(TotalCharges) AS DOUBLE), MonthlyCharges) AS TotalCharges, " + _SERVICES + " AS num_services FROM b_telco),\n"
    "spend AS (SELECT *, CASE WHEN tenure > 0 THEN TotalCharges / tenure ELSE MonthlyCharges END AS avg_monthly_spend FROM typed),\n"
    "features AS (SELECT * EXCLUDE (num_services, avg_monthly_spend, p75, med), CAST(lower(Churn) = 'yes' AS INT) AS ChurnFlag, avg_monthly_spend,"
    " CASE WHEN avg_monthly_spend > 0 THEN MonthlyCharges / avg_monthly_spend ELSE 1.0 END AS price_ratio,\n"
    " MonthlyCharges * greatest(tenure, 1) AS revenue_risk_proxy,\n"
    " CASE WHEN tenure <= -1 THEN NULL WHEN tenure <= 0 THEN 'new' WHEN tenure <= 12 THEN '0-1yr' WHEN tenure <= 24 THEN '1-2yr' WHEN tenure <= 48 THEN '2-4yr' WHEN tenure <= 72 THEN '4-6yr' END AS tenure_group,\n"
    " CASE WHEN tenure <= -1 THEN NULL WHEN tenure <= 6 THEN 'new' WHEN tenure <= 24 THEN 'established' WHEN tenure <= 60 THEN 'loyal' ELSE 'long_term' END AS customer_stage,\n "
    + _flags({
        "is_month_to_month": _m2m, "auto_pay": "PaymentMethod ILIKE '%automatic%'", "electronic_check": "PaymentMethod = 'Electronic check'",
        "paperless": "PaperlessBilling = 'Yes'", "multi_service_customer": "num_services >= 4", "has_support": _support,
        "has_streaming": "StreamingTV = 'Yes' OR StreamingMovies = 'Yes'", "fiber_customer": "InternetService = 'Fiber optic'",
        "high_bill": "MonthlyCharges > p75", "low_tenure_high_bill": "tenure <= 12 AND MonthlyCharges > med",
        "high_value_long_tenure": "MonthlyCharges > p75 AND tenure > 24", "fiber_monthly": f"InternetService = 'Fiber optic' AND {_m2m}",
        "month_to_month_no_support": f"{_m2m} AND NOT {_support}",
    })
    + ",\n num_services, num_services / 8.0::DOUBLE AS service_adoption_rate, SeniorCitizen AS senior_citizen FROM spend, q)"
)
DOUBLES = ["avg_monthly_spend", "price_ratio", "revenue_risk_proxy", "TotalCharges", "MonthlyCharges"]


@query("f1_f23_telco_features", rounded_sql(FEATURES + "\n--SELECT\nSELECT * FROM features", DOUBLES))
def f1_f23_telco_features(spark, sf):
    return rounded(engineer_telco(bind(spark, sf, "b_telco")), DOUBLES)


_SINGLE = {
    "f1_total_charges": ["TotalCharges"], "f2_churn_flag": ["ChurnFlag"], "f3_monthly_spend": ["avg_monthly_spend"], "f4_price_ratio": ["price_ratio"],
    "f5_revenue_proxy": ["revenue_risk_proxy"], "f6_tenure_group": ["tenure_group"], "f7_customer_stage": ["customer_stage"],
    "f8_month_to_month": ["is_month_to_month"], "f9_auto_pay": ["auto_pay"], "f10_electronic_check": ["electronic_check"], "f11_paperless": ["paperless"],
    "f12_num_services": ["num_services"], "f13_adoption_rate": ["service_adoption_rate"], "f14_multi_service": ["multi_service_customer"],
    "f15_support": ["has_support"], "f16_streaming": ["has_streaming"], "f17_fiber": ["fiber_customer"], "f18_senior": ["senior_citizen"],
    "f19_high_bill": ["high_bill"], "f20_low_tenure_high_bill": ["low_tenure_high_bill"], "f21_fiber_monthly": ["fiber_monthly"],
    "f22_month_to_month_no_support": ["month_to_month_no_support"], "f23_high_value_long_tenure": ["high_value_long_tenure"],
}


def _register_single(name: str, columns: list[str]) -> None:
    doubles = [c for c in columns if c in DOUBLES]
    body = f"SELECT customerID, {', '.join(columns)} FROM features"
    sql = rounded_sql(FEATURES + "\n--SELECT\n" + body, doubles) if doubles else FEATURES + "\n" + body

    @query(name, sql)
    def run(spark, sf):
        return rounded(engineer_telco(bind(spark, sf, "b_telco")).select("customerID", *columns), doubles)


for _name, _columns in _SINGLE.items():
    _register_single(_name, _columns)


@query("f19_bill_cutoffs", rounded_sql(
    "WITH " + cte("b_telco") + "\n--SELECT\nSELECT quantile_cont(MonthlyCharges, 0.75) AS p75, quantile_cont(MonthlyCharges, 0.5) AS median FROM b_telco", ["p75", "median"]))
def f19_bill_cutoffs(spark, sf):
    return rounded(fit_bill_cutoffs(bind(spark, sf, "b_telco")), ["p75", "median"])


@query("f24_model_frame", rounded_sql(
    FEATURES + "\n--SELECT\nSELECT * EXCLUDE (customerID, Churn) REPLACE (coalesce(OnlineSecurity, '__missing__') AS OnlineSecurity,"
    " coalesce(PaymentMethod, '__missing__') AS PaymentMethod, coalesce(tenure_group, '__missing__') AS tenure_group) FROM features", DOUBLES))
def f24_model_frame(spark, sf):
    frame = engineer_telco(bind(spark, sf, "b_telco")).drop("customerID", "Churn")
    _, categorical = column_roles(frame, exclude=("ChurnFlag",))
    return rounded(fill_categories(frame, categorical), DOUBLES)
