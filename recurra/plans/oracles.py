"""DuckDB twins of the registered queries.

They share one prefix of common table expressions that derives the billing
tables (FIXTURES.md section 4) and restates the metrics in plain SQL, on
purpose in another shape than the Spark plans: row numbers instead of
aggregates, joins instead of conditional counts, one row per tenant and month
offset instead of collapsed counts.
"""

from __future__ import annotations

# Fixed values, written again here so that a wrong one in the library shows as a difference.
EVENT_TYPES = [
    "subscription_created",
    "subscription_upgraded",
    "subscription_downgraded",
    "subscription_cancelled",
    "invoice_paid",
    "invoice_failed",
    "trial_started",
    "trial_converted",
]
PLANS = ["starter", "growth", "business", "enterprise"]
PLAN_TIER = {"starter": 1, "growth": 2, "business": 3, "enterprise": 4}
SUBSCRIPTION_STATUSES = ["active", "cancelled", "paused", "trial"]
INVOICE_STATUSES = ["paid", "failed", "pending", "refunded"]
REVENUE_PLAN_COLOURS = {"enterprise": "#3C3489", "business": "#185FA5", "growth": "#0F6E56", "starter": "#633806"}
REVENUE_PLAN_COLOUR_DEFAULT = "#185FA5"
CHURN_PLAN_COLOURS = {"starter": "#E24B4A", "growth": "#EF9F27", "business": "#85B7EB", "enterprise": "#1D9E75"}
CHURN_PLAN_COLOUR_DEFAULT = "#85B7EB"
# End of fixed values.


def _sql_list(values: list[str]) -> str:
    return ", ".join(f"'{value}'" for value in values)


def _padded(column: str, prefix: str) -> str:
    text = f"CAST({column} AS VARCHAR)"
    return f"'{prefix}' || lpad({text}, CAST(greatest(length({text}), 10) AS INTEGER), '0')"


def _period(year: str, month: str) -> str:
    return f"CAST({year} AS VARCHAR) || '-' || lpad(CAST({month} AS VARCHAR), 2, '0')"


def _inr(x: str) -> str:
    return f"""CASE WHEN {x} IS NULL THEN 'INR 0'
        WHEN {x} >= 10000000 THEN printf('INR %.2fCr', CAST({x} AS DOUBLE) / 10000000)
        WHEN {x} >= 100000 THEN printf('INR %.2fL', CAST({x} AS DOUBLE) / 100000)
        WHEN {x} >= 1000 THEN printf('INR %.1fk', CAST({x} AS DOUBLE) / 1000)
        ELSE printf('INR %.0f', CAST({x} AS DOUBLE)) END"""


def _trend(x: str) -> str:
    return f"""CASE WHEN {x} IS NULL THEN '-'
        WHEN {x} > 0 THEN printf('+%.1f%%', CAST({x} AS DOUBLE))
        WHEN {x} < 0 THEN printf('-%.1f%%', abs(CAST({x} AS DOUBLE)))
        ELSE '0.0%' END"""


def _trend_class(x: str) -> str:
    return f"CASE WHEN {x} > 0 THEN 'up' WHEN {x} < 0 THEN 'dn' ELSE 'neutral' END"


def _capital(x: str) -> str:
    return f"upper(substr({x}, 1, 1)) || lower(substr({x}, 2))"


def _choose(x: str, values: dict, default) -> str:
    def literal(value):
        return f"'{value}'" if isinstance(value, str) else str(value)

    whens = " ".join(f"WHEN {literal(k)} THEN {literal(v)}" for k, v in values.items())
    return f"CASE {x} {whens} ELSE {literal(default)} END"


def _half_even(x: str, digits: int) -> str:
    return f"CAST(printf('%.{digits}f', {x}) AS DOUBLE)"


_PREFIX = f"""
WITH RECURSIVE numbered AS (
  SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS rn
  FROM orders),
typed AS (
  SELECT *, CASE WHEN rn = 1 THEN 'subscription_created'
    WHEN o_orderkey % 1000 < 700 THEN 'invoice_paid'
    WHEN o_orderkey % 1000 < 780 THEN 'invoice_failed'
    WHEN o_orderkey % 1000 < 860 THEN 'subscription_upgraded'
    WHEN o_orderkey % 1000 < 910 THEN 'subscription_downgraded'
    WHEN o_orderkey % 1000 < 925 THEN 'subscription_cancelled'
    WHEN o_orderkey % 1000 < 963 THEN 'trial_started'
    ELSE 'trial_converted' END AS et
  FROM numbered),
raw AS (
  SELECT CASE WHEN o_orderkey % 227 <> 0 THEN {_padded("o_orderkey", "EVT_")} END AS event_id,
    CASE WHEN o_orderkey % 229 <> 0 THEN {_padded("o_custkey", "TNT_")} END AS tenant_id,
    CASE WHEN o_orderkey % 211 = 0 THEN 'unknown_type' ELSE et END AS event_type,
    CASE o_orderpriority WHEN '1-URGENT' THEN 'enterprise' WHEN '2-HIGH' THEN 'business'
      WHEN '3-MEDIUM' THEN 'growth' ELSE 'starter' END AS plan,
    CAST(CASE WHEN o_orderkey % 223 = 0 THEN -100
      WHEN et NOT IN ('invoice_paid', 'subscription_created') OR o_orderkey % 97 = 0 THEN 0
      ELSE floor(o_totalprice) END AS INTEGER) AS amount,
    'INR' AS currency,
    CASE WHEN o_orderkey % 233 <> 0 THEN o_orderdate END AS event_date,
    CASE WHEN et = 'invoice_failed' THEN 'failed'
      WHEN et = 'invoice_paid' AND o_orderkey % 41 = 0 THEN 'pending' ELSE 'success' END AS status,
    CASE WHEN o_orderkey % 43 = 0 THEN NULL WHEN o_orderkey % 47 = 0 THEN {_padded("(o_orderkey + 5000000000)", "INV_")}
      ELSE {_padded("o_orderkey", "INV_")} END AS invoice_id,
    CAST(1 + o_orderkey % 20 AS INTEGER) AS seats,
    rn = 1 AND o_custkey % 2 = 0 AS trial
  FROM typed),
tagged AS (
  SELECT *, CASE WHEN event_id IS NULL THEN 'missing event_id'
    WHEN tenant_id IS NULL THEN 'missing tenant_id'
    WHEN event_type NOT IN ({_sql_list(EVENT_TYPES)}) THEN 'invalid event_type'
    WHEN amount < 0 THEN 'negative amount'
    WHEN event_date IS NULL THEN 'null event_date' END AS validation_error
  FROM raw),
clean AS (SELECT * EXCLUDE (validation_error) FROM tagged WHERE validation_error IS NULL),
rejected AS (SELECT * FROM tagged WHERE validation_error IS NOT NULL),
events_x AS (
  SELECT *, CAST(year(event_date) AS INTEGER) AS event_year,
    CAST(month(event_date) AS INTEGER) AS event_month,
    CAST(event_date AS DATE) AS event_date_only,
    event_type = 'invoice_paid' AS is_revenue_event,
    event_type = 'subscription_cancelled' AS is_churn_event
  FROM clean),
tenants AS (
  SELECT {_padded("c_custkey", "TNT_")} AS tenant_id, c_name AS company_name, c_mktsegment AS industry,
    CASE WHEN c_custkey % 10 < 4 THEN 'starter' WHEN c_custkey % 10 < 7 THEN 'growth'
      WHEN c_custkey % 10 < 9 THEN 'business' ELSE 'enterprise' END AS plan,
    n_name AS country,
    (SELECT CAST(CAST(min(o_orderdate) AS DATE) AS VARCHAR) FROM orders WHERE o_custkey = c_custkey)
      AS signup_date
  FROM customer JOIN nation ON c_nationkey = n_nationkey WHERE c_custkey % 101 <> 0),
invoices AS (
  SELECT {_padded("o_orderkey", "INV_")} AS invoice_id, {_padded("o_custkey", "TNT_")} AS tenant_id,
    CASE WHEN o_orderkey % 59 <> 0 THEN {_padded("o_orderkey", "SUB_")} END AS subscription_id,
    CAST(floor(o_totalprice) AS INTEGER) AS amount, 'INR' AS currency,
    CASE WHEN o_orderkey % 53 = 0 THEN 'refunded' WHEN o_orderstatus = 'F' THEN 'paid'
      WHEN o_orderstatus = 'P' THEN 'failed' ELSE 'pending' END AS status,
    CAST(o_orderdate AS DATE) AS billing_date, CAST(o_orderdate AS DATE) + 30 AS due_date,
    CASE WHEN o_orderstatus = 'F' AND o_orderkey % 53 <> 0 THEN CAST(o_orderdate AS DATE) END AS paid_date
  FROM orders),
subscriptions AS (
  SELECT CASE WHEN o_orderkey % 251 = 0 THEN {_padded("(o_orderkey - 1)", "SUB_")}
      ELSE {_padded("o_orderkey", "SUB_")} END AS subscription_id,
    CASE WHEN o_orderkey % 239 <> 0 THEN {_padded("o_custkey", "TNT_")} END AS tenant_id,
    CASE WHEN o_orderkey % 257 = 0 THEN 'legacy' ELSE CASE o_orderpriority WHEN '1-URGENT' THEN 'enterprise'
      WHEN '2-HIGH' THEN 'business' WHEN '3-MEDIUM' THEN 'growth' ELSE 'starter' END END AS plan,
    s.status, CAST(floor(o_totalprice) AS INTEGER) AS monthly_amount,
    CAST(CASE WHEN o_orderkey % 5 <> 0 THEN 1 + o_orderkey % 20 END AS INTEGER) AS seats,
    CASE WHEN o_orderkey % 233 <> 0 THEN CAST(o_orderdate AS DATE) END AS start_date,
    CASE WHEN s.status = 'cancelled' THEN CAST(o_orderdate AS DATE) + 365 END AS end_date,
    CASE WHEN s.status = 'trial' THEN CAST(o_orderdate AS DATE) + 14 END AS trial_end_date
  FROM (SELECT *, CASE WHEN o_orderkey % 263 = 0 THEN 'expired' WHEN o_orderstatus = 'F' THEN 'cancelled'
      WHEN o_orderstatus = 'P' THEN 'paused' WHEN o_orderkey % 9 = 0 THEN 'trial' ELSE 'active' END AS status
    FROM orders) s),
monthly AS (
  SELECT tenant_id, event_year, event_month, CAST(sum(amount) AS BIGINT) AS mrr,
    count(invoice_id) AS invoice_count, avg(seats) AS avg_seats
  FROM events_x WHERE event_type = 'invoice_paid' AND status = 'success'
  GROUP BY tenant_id, event_year, event_month),
lagged AS (
  SELECT *, {_period("event_year", "event_month")} AS period, lag(mrr) OVER w AS prev_mrr,
    CAST(sum(mrr) OVER (w ROWS UNBOUNDED PRECEDING) AS BIGINT) AS cumulative_mrr,
    avg(mrr) OVER (w ROWS BETWEEN 2 PRECEDING AND CURRENT ROW) AS rolling_3m_mrr
  FROM monthly WINDOW w AS (PARTITION BY tenant_id ORDER BY event_year, event_month)),
mrr AS (
  SELECT tenant_id, event_year, event_month, mrr, invoice_count, avg_seats, period, prev_mrr,
    CASE WHEN prev_mrr IS NOT NULL AND prev_mrr <> 0
      THEN round((mrr - prev_mrr) / prev_mrr * 100, 2) END AS mrr_growth_pct,
    cumulative_mrr, rolling_3m_mrr, mrr * 12 AS arr
  FROM lagged),
global_mrr AS (
  SELECT event_year, event_month, period, CAST(sum(mrr) AS BIGINT) AS total_mrr,
    CAST(sum(arr) AS BIGINT) AS total_arr, count(DISTINCT tenant_id) AS paying_tenants, avg(mrr) AS arpu
  FROM mrr GROUP BY event_year, event_month, period),
ltv AS (
  SELECT tenant_id, avg_monthly_mrr, active_months, total_revenue, company_name, industry, plan, country,
    avg_monthly_mrr * active_months AS estimated_ltv
  FROM (SELECT tenant_id, avg(mrr) AS avg_monthly_mrr, count(period) AS active_months,
      CAST(sum(mrr) AS BIGINT) AS total_revenue FROM mrr GROUP BY tenant_id) a
  JOIN tenants USING (tenant_id)),
active AS (
  SELECT event_year, event_month, {_period("event_year", "event_month")} AS period, plan,
    count(DISTINCT tenant_id) AS active_tenants
  FROM events_x WHERE event_type = 'invoice_paid' GROUP BY event_year, event_month, plan),
churned AS (
  SELECT event_year, event_month, {_period("event_year", "event_month")} AS period, plan,
    count(DISTINCT tenant_id) AS churned_tenants
  FROM events_x WHERE event_type = 'subscription_cancelled' GROUP BY event_year, event_month, plan),
churn AS (
  SELECT a.*, coalesce(c.churned_tenants, 0) AS churned_tenants,
    round(coalesce(c.churned_tenants, 0) / a.active_tenants * 100, 2) AS churn_rate_pct
  FROM active a LEFT JOIN churned c
    ON a.event_year = c.event_year AND a.event_month = c.event_month AND a.plan = c.plan),
churn_period AS (
  SELECT period, CAST(sum(active_tenants) AS BIGINT) AS active_tenants,
    CAST(sum(churned_tenants) AS BIGINT) AS churned_tenants FROM churn GROUP BY period),
selected AS (
  SELECT coalesce((SELECT max(period) FROM churn_period WHERE churned_tenants > 0),
    (SELECT max(period) FROM churn_period)) AS selected_period),
signup AS (
  SELECT tenant_id, min(event_date) AS first_event_date,
    CAST(year(min(event_date)) AS INTEGER) AS cohort_year,
    CAST(month(min(event_date)) AS INTEGER) AS cohort_month,
    strftime(min(event_date), '%Y-%m') AS cohort
  FROM clean WHERE event_type = 'subscription_created' GROUP BY tenant_id),
cancel AS (
  SELECT tenant_id, min(event_date) AS first_cancel_date,
    CAST(year(min(event_date)) AS INTEGER) AS cancel_year,
    CAST(month(min(event_date)) AS INTEGER) AS cancel_month
  FROM clean WHERE event_type = 'subscription_cancelled' GROUP BY tenant_id),
sizes AS (SELECT cohort, count(*) AS cohort_size FROM signup GROUP BY cohort),
tenant_months AS (
  SELECT s.tenant_id, s.cohort, m.months_since_start,
    (cancel_year - cohort_year) * 12 + (cancel_month - cohort_month) AS cancel_offset
  FROM signup s LEFT JOIN cancel c USING (tenant_id),
    (SELECT unnest(range(0, 12)) AS months_since_start) m),
retention AS (
  SELECT cohort, months_since_start, count(*) AS retained_tenants, cohort_size,
    round(count(*) / cohort_size * 100, 1) AS retention_pct
  FROM tenant_months JOIN sizes USING (cohort)
  WHERE months_since_start = 0 OR cancel_offset IS NULL OR cancel_offset > months_since_start
  GROUP BY cohort, months_since_start, cohort_size),
revenue_view AS (
  SELECT t.tenant_id, t.company_name, t.industry, t.plan, t.country,
    CAST(date_trunc('month', i.billing_date) AS DATE) AS billing_month,
    count(i.invoice_id) AS invoice_count, CAST(sum(i.amount) AS BIGINT) AS total_mrr,
    CAST(sum(i.amount) * 12 AS BIGINT) AS arr, avg(i.amount) AS avg_invoice_amount
  FROM invoices i JOIN tenants t ON i.tenant_id = t.tenant_id WHERE i.status = 'paid'
  GROUP BY ALL),
status AS (
  SELECT l.*, m.mrr AS latest_mrr,
    CASE WHEN m.tenant_id IS NOT NULL THEN 'Active' ELSE 'Churned' END AS status
  FROM ltv l LEFT JOIN (SELECT tenant_id, mrr FROM mrr WHERE period = (SELECT max(period) FROM mrr)) m
    USING (tenant_id)),
ranked_months AS (
  SELECT *, row_number() OVER (ORDER BY period DESC) AS back,
    lag(total_mrr) OVER (ORDER BY period) AS p_mrr, lag(total_arr) OVER (ORDER BY period) AS p_arr,
    lag(paying_tenants) OVER (ORDER BY period) AS p_payers, lag(period) OVER (ORDER BY period) AS p_period
  FROM global_mrr),
kpis AS (
  SELECT g.period, total_mrr,
    CASE WHEN p_mrr > 0 THEN (total_mrr - p_mrr) / p_mrr * 100 ELSE 0.0::DOUBLE END AS mrr_change_pct,
    total_arr, CASE WHEN p_arr > 0 THEN (total_arr - p_arr) / p_arr * 100 ELSE 0.0::DOUBLE END AS arr_change_pct,
    c.churned_tenants / c.active_tenants * 100 AS churn_pct,
    c.churned_tenants / c.active_tenants * 100 - p.churned_tenants / p.active_tenants * 100 AS churn_change,
    paying_tenants, paying_tenants - p_payers AS paying_tenants_change
  FROM ranked_months g LEFT JOIN churn_period c ON c.period = g.period
  LEFT JOIN churn_period p ON p.period = g.p_period WHERE back = 1),
latest_mrr AS (
  SELECT * EXCLUDE (back) FROM (SELECT *, row_number() OVER
    (PARTITION BY tenant_id ORDER BY event_year DESC, event_month DESC) AS back FROM mrr) WHERE back = 1),
plan_latest AS (
  SELECT l.plan, CAST(sum(m.mrr) AS BIGINT) AS mrr, count(*) AS payers
  FROM mrr m JOIN tenants l USING (tenant_id) WHERE m.period = (SELECT max(period) FROM mrr) GROUP BY l.plan),
plan_rates AS (
  SELECT p.plan, coalesce(c.churn_rate_pct, 0) AS rate
  FROM (SELECT unnest([{_sql_list(PLANS)}]) AS plan) p
  LEFT JOIN (SELECT * FROM churn WHERE period = (SELECT selected_period FROM selected)) c USING (plan)),
scenario_rows AS (
  SELECT {_padded("c_custkey", "SCN_")} AS scenario_id,
    CAST(CASE WHEN c_custkey % 97 = 0 THEN 0 ELSE 1 + c_custkey * 37 % 5000 END AS INTEGER) AS starting_tenants,
    CAST(floor(abs(c_acctbal)) * 10 + (c_custkey % 4) / 4
      - CASE WHEN c_custkey % 89 = 0 THEN 1e6 ELSE 0e0 END AS DOUBLE) AS monthly_arpu,
    ((c_custkey * 7) % 60 - 15) / 2 + CASE WHEN c_custkey % 83 = 0 THEN 5e2 ELSE 0e0 END AS monthly_growth_pct,
    ((c_custkey * 11) % 48) / 4 + CASE WHEN c_custkey % 79 = 0 THEN 1.005e2 ELSE 0e0 END AS monthly_churn_pct,
    CAST(1 + c_custkey % 36 + CASE WHEN c_custkey % 73 = 0 THEN 36 ELSE 0 END AS INTEGER) AS months
  FROM customer),
scenario_tags AS (
  SELECT *, CASE WHEN NOT starting_tenants BETWEEN 1 AND 100000 THEN 'starting_tenants out of range'
    WHEN NOT monthly_arpu BETWEEN 0 AND 10000000 THEN 'monthly_arpu out of range'
    WHEN NOT monthly_growth_pct BETWEEN -100 AND 200 THEN 'monthly_growth_pct out of range'
    WHEN NOT monthly_churn_pct BETWEEN 0 AND 100 THEN 'monthly_churn_pct out of range'
    WHEN NOT months BETWEEN 1 AND 36 THEN 'months out of range' END AS scenario_error
  FROM scenario_rows),
scenarios AS (SELECT * EXCLUDE (scenario_error) FROM scenario_tags WHERE scenario_error IS NULL),
plan_scenarios AS (
  SELECT {_capital("plan")} AS scenario_id, CAST(payers AS INTEGER) AS starting_tenants,
    mrr / payers AS monthly_arpu, 4e0 AS monthly_growth_pct, rate AS monthly_churn_pct, 12 AS months
  FROM plan_latest JOIN plan_rates USING (plan)),
messages AS (
  SELECT event_id AS source_key, event_id % 199 = 0 AS broken, {_padded("event_id", "EVT_")} AS event_id,
    CASE WHEN event_id % 61 <> 0 THEN {_padded("user_id", "TNT_")} END AS tenant_id,
    CASE event_type WHEN 'signup' THEN 'subscription_created' WHEN 'purchase' THEN 'invoice_paid'
      WHEN 'error' THEN 'invoice_failed' WHEN 'click' THEN 'subscription_upgraded'
      WHEN 'view' THEN 'trial_started' END AS event_type,
    CASE user_id % 4 WHEN 0 THEN 'starter' WHEN 1 THEN 'growth' WHEN 2 THEN 'business'
      ELSE 'enterprise' END AS plan,
    CAST(CASE WHEN event_id % 67 = 0 THEN -1 WHEN event_type = 'purchase' THEN floor(value) ELSE 0 END
      AS INTEGER) AS amount,
    'INR' AS currency,
    CASE WHEN event_id % 71 <> 0 THEN ts END AS event_date,
    CASE WHEN event_type = 'error' THEN 'failed' ELSE 'success' END AS status
  FROM events),
delivered AS (
  SELECT * FROM messages UNION ALL SELECT * FROM messages WHERE source_key % 50 = 0),
stream_clean AS (
  SELECT * EXCLUDE (source_key, broken) FROM delivered
  WHERE NOT broken AND tenant_id IS NOT NULL AND amount >= 0 AND event_date IS NOT NULL)
"""


def _projected(table: str, tail: str) -> str:
    """The month-by-month recursion over a scenario table."""
    return f""",
steps AS (
  SELECT scenario_id, monthly_arpu AS arpu, monthly_growth_pct / 100 AS g, monthly_churn_pct / 100 AS c,
    months, 1 AS month, CAST(starting_tenants AS DOUBLE) AS s,
    greatest(CAST(starting_tenants AS DOUBLE) * (monthly_growth_pct / 100),
      -CAST(starting_tenants AS DOUBLE)) AS added
  FROM {table}
  UNION ALL
  SELECT scenario_id, arpu, g, c, months, month + 1, e, greatest(e * g, -e)
  FROM (SELECT *, greatest(s + added - s * c, 0e0) AS e FROM steps WHERE month < months)),
months_out AS (SELECT *, greatest(s + added - s * c, 0e0) AS e FROM steps)
{tail}"""


_MONTH_ROWS = f"""
SELECT scenario_id, month, {_half_even("s", 1)} AS starting_tenants, {_half_even("added", 1)} AS added_tenants,
  {_half_even("s * c", 1)} AS churned_tenants, {_half_even("e", 1)} AS ending_tenants,
  {_half_even("e * arpu", 2)} AS mrr, {_inr("(e * arpu)")} AS mrr_formatted,
  {_inr("(e * arpu * 12)")} AS arr_formatted
FROM months_out"""

_SUMMARY = f"""
SELECT scenario_id, {_inr("start_mrr")} AS starting_mrr, {_inr("end_mrr")} AS ending_mrr,
  {_inr("(end_mrr * 12)")} AS ending_arr, {_inr("(end_mrr - start_mrr)")} AS mrr_change,
  CASE WHEN start_mrr <> 0 THEN {_half_even("(end_mrr - start_mrr) / start_mrr * 100", 1)}
    ELSE 0e0 END AS mrr_change_pct, ending_tenants
FROM (SELECT m.scenario_id, sc.starting_tenants * sc.monthly_arpu AS start_mrr,
    {_half_even("m.e * m.arpu", 2)} AS end_mrr, {_half_even("m.e", 1)} AS ending_tenants
  FROM months_out m JOIN scenarios sc USING (scenario_id) WHERE m.month = m.months)"""

_LABEL_ROWS = f"""
SELECT 'Total MRR' AS label, {_inr("total_mrr")} AS value, {_trend("mrr_change_pct")} AS trend_text,
  {_trend_class("mrr_change_pct")} AS trend_class FROM kpis
UNION ALL SELECT 'ARR', {_inr("total_arr")}, {_trend("arr_change_pct")}, {_trend_class("arr_change_pct")} FROM kpis
UNION ALL SELECT 'Active Tenants', CAST(paying_tenants AS VARCHAR),
  CASE WHEN paying_tenants_change >= 0 THEN '+' ELSE '-' END
    || CAST(abs(paying_tenants_change) AS VARCHAR) || ' this month',
  CASE WHEN paying_tenants_change >= 0 THEN 'up' ELSE 'dn' END FROM kpis
UNION ALL """

_TREND_ROWS = f"""
SELECT period, strftime(make_date(event_year, event_month, 1), '%b') AS month_name, total_mrr AS mrr,
  {_inr("total_mrr")} AS mrr_formatted, pct_height,
  CASE WHEN pct_height > 75 THEN '#0C447C' WHEN pct_height > 50 THEN '#185FA5'
    WHEN pct_height > 30 THEN '#378ADD' WHEN pct_height > 15 THEN '#85B7EB' ELSE '#B5D4F4' END AS color
FROM (SELECT *, CAST(floor(total_mrr / max(total_mrr) OVER () * 90) AS INTEGER) AS pct_height
  FROM ranked_months WHERE back <= {{shown}})"""


def _null_rows(table: str, source: str, columns: list[str]) -> str:
    return "\nUNION ALL ".join(
        f"SELECT '{table}' AS table_name, '{c}' AS column_name, count(*) FILTER (WHERE {c} IS NULL) AS null_rows"
        f" FROM {source}"
        for c in columns
    )


def _domain_rows(table: str, source: str, column: str, allowed: list[str]) -> str:
    return (
        f"SELECT '{table}' AS table_name, '{column}' AS column_name,"
        f" count(*) FILTER (WHERE {column} NOT IN ({_sql_list(allowed)})) AS violations FROM {source}"
    )


def _duplicate_rows(table: str, source: str, keys: list[str]) -> str:
    named = ", ".join(keys)
    present = " AND ".join(f"{k} IS NOT NULL" for k in keys)
    return (
        f"SELECT '{table}' AS table_name, '{','.join(keys)}' AS key_columns,"
        f" count(*) FILTER (WHERE n > 1) AS duplicate_keys,"
        f" CAST(coalesce(sum(n - 1), 0) AS BIGINT) AS surplus_rows"
        f" FROM (SELECT {named}, count(*) AS n FROM {source} WHERE {present} GROUP BY {named})"
    )


def _orphan_rows(table: str, child: str, column: str, parent: str, key: str) -> str:
    return (
        f"SELECT '{table}' AS table_name, '{column}' AS column_name, {column} AS key_value,"
        f" count(*) AS orphan_rows FROM {child} c WHERE {column} IS NOT NULL"
        f" AND NOT EXISTS (SELECT 1 FROM {parent} p WHERE p.{key} = c.{column}) GROUP BY {column}"
    )


def _check_row(table: str, source: str, checksum: str) -> str:
    return (
        f"SELECT '{table}' AS table_name, count(*) AS table_rows, CAST(sum({checksum}) AS BIGINT) AS checksum"
        f" FROM {source}"
    )


def _risk_rows(events: str) -> str:
    return f"""SELECT CAST(row_number() OVER (ORDER BY failure_count DESC, tenant_id) AS INTEGER) AS rank,
        tenant_id, company_name, failure_count,
        CASE WHEN failure_count > 1 THEN CAST(failure_count AS VARCHAR) || ' failed invoices in last 90d'
          ELSE '1 failed invoice in last 90d' END AS reason,
        CASE WHEN failure_count >= 3 THEN 'var(--color-text-danger)'
          ELSE 'var(--color-text-warning)' END AS color
        FROM (SELECT tenant_id, count(*) AS failure_count FROM {events} WHERE event_type = 'invoice_failed'
            AND event_date >= (SELECT max(event_date) FROM {events}) - INTERVAL 90 DAY
          GROUP BY tenant_id ORDER BY failure_count DESC, tenant_id LIMIT 4)
        JOIN ltv USING (tenant_id)"""


_MATRIX = ", ".join(
    f"max(retention_pct) FILTER (WHERE months_since_start = {m}) AS M{m}" for m in range(12)
)
_SLOT_TEXTS = ", ".join(
    f"coalesce(CAST(max(retention_pct) FILTER (WHERE months_since_start = {m}) AS VARCHAR), 'null')" for m in range(12)
)
_UNION = "\nUNION ALL "
_RAW_TEXT = " || '|' || ".join(
    f"coalesce(CAST({c} AS VARCHAR), '')"
    for c in (
        "event_id", "tenant_id", "event_type", "plan", "amount", "currency", "event_date", "status", "invoice_id", "seats", "trial"
    )
)

_TAILS: dict[str, str] = {
    "validated_events": "SELECT * FROM clean",
    "rejected_events": "SELECT * FROM rejected",
    "rejection_summary": "SELECT validation_error, count(*) AS rejected_rows FROM rejected GROUP BY ALL",
    "enriched_events": "SELECT * FROM events_x",
    "mrr_by_tenant_month": "SELECT * FROM mrr",
    "global_mrr_monthly": "SELECT * FROM global_mrr ORDER BY event_year, event_month",
    "global_mrr_last6": "SELECT * FROM global_mrr ORDER BY period DESC LIMIT 6",
    "tenant_ltv": "SELECT * FROM ltv",
    "top_tenants_ltv": "SELECT * FROM ltv ORDER BY estimated_ltv DESC, tenant_id LIMIT 10",
    "paid_months": """SELECT tenant_id, CAST(year(event_date) AS INTEGER) AS event_year,
        CAST(month(event_date) AS INTEGER) AS event_month, CAST(sum(amount) AS BIGINT) AS mrr
        FROM clean WHERE event_type = 'invoice_paid' GROUP BY ALL""",
    "mrr_total": """SELECT CAST(sum(m) AS BIGINT) AS mrr_total FROM (
        SELECT tenant_id, date_trunc('month', event_date) AS month, sum(amount) AS m FROM clean
        WHERE event_type = 'invoice_paid' GROUP BY ALL)""",
    "latest_tenant_mrr": "SELECT * FROM latest_mrr",
    "mv_monthly_revenue": "SELECT * FROM revenue_view",
    "tenant_revenue_trend": """SELECT billing_month, total_mrr, arr FROM revenue_view
        WHERE tenant_id = 'TNT_0000000001' ORDER BY billing_month""",
    "top_lifetime_revenue": """SELECT tenant_id, company_name, CAST(sum(total_mrr) AS BIGINT) AS lifetime_value
        FROM revenue_view GROUP BY ALL ORDER BY lifetime_value DESC, tenant_id LIMIT 10""",
    "active_tenants_by_plan": "SELECT * FROM active",
    "churned_tenants_by_plan": "SELECT * FROM churned",
    "churn_by_plan_month": "SELECT * FROM churn ORDER BY event_year, event_month, plan",
    "churn_month_sample": "SELECT * FROM churn WHERE event_month = 6",
    "churn_head": "SELECT * FROM churn ORDER BY event_year, event_month, plan LIMIT 8",
    "churn_by_period": "SELECT * FROM churn_period",
    "latest_churn_period": "SELECT * FROM selected",
    "churn_kpis": f"""SELECT selected_period, c.churned_tenants / c.active_tenants * 100 AS overall_churn_pct,
        printf('%.1f%%', c.churned_tenants / c.active_tenants * 100) AS overall_churn_label,
        (SELECT {_capital("plan")} FROM churn WHERE period = selected_period
          ORDER BY churn_rate_pct DESC, plan LIMIT 1) AS highest_plan,
        (SELECT max(churn_rate_pct) FROM churn WHERE period = selected_period) AS highest_plan_churn,
        (SELECT {_capital("plan")} FROM churn WHERE period = selected_period
          ORDER BY churn_rate_pct, plan LIMIT 1) AS lowest_plan,
        (SELECT min(churn_rate_pct) FROM churn WHERE period = selected_period) AS lowest_plan_churn,
        c.churned_tenants AS churned_in_period,
        (SELECT count(DISTINCT tenant_id) FROM clean WHERE event_type = 'subscription_cancelled')
          AS all_time_cancelled
        FROM selected JOIN churn_period c ON c.period = selected_period""",
    "plan_churn_latest": f"""SELECT {_capital("plan")} AS plan, rate AS churn_rate_pct,
        printf('%.1f%%', rate) AS rate_label, CAST(floor(least(rate * 10, 100)) AS INTEGER) AS bar_width,
        {_choose("plan", CHURN_PLAN_COLOURS, CHURN_PLAN_COLOUR_DEFAULT)} AS color FROM plan_rates""",
    "billing_risk": _risk_rows("clean"),
    "billing_risk_text_dates": _risk_rows(
        "(SELECT * REPLACE (CASE WHEN seats % 7 <> 0 THEN event_date END AS event_date) FROM clean)"
    ),
    "billing_risk_none": """SELECT CAST(1 AS INTEGER) AS rank, CAST(NULL AS VARCHAR) AS tenant_id,
        'No high-risk accounts found' AS company_name, CAST(0 AS BIGINT) AS failure_count,
        'No recent failed invoices in processed data' AS reason, 'var(--color-text-tertiary)' AS color
        WHERE NOT EXISTS (SELECT 1 FROM tenants WHERE plan = 'retired')""",
    "churn_candidates": """SELECT t.tenant_id, t.company_name, max(i.billing_date) AS last_payment
        FROM tenants t LEFT JOIN invoices i ON t.tenant_id = i.tenant_id AND i.status = 'paid'
        GROUP BY t.tenant_id, t.company_name
        HAVING max(i.billing_date) < (SELECT max(billing_date) FROM invoices) - INTERVAL 60 DAY
          OR max(i.billing_date) IS NULL""",
    "cohort_assignment": "SELECT * FROM signup",
    "first_cancellation": "SELECT * FROM cancel",
    "cohort_sizes": "SELECT * FROM sizes",
    "cohort_retention": "SELECT * FROM retention",
    "cohort_retention_head": "SELECT * FROM retention ORDER BY cohort, months_since_start LIMIT 20",
    "cohort_matrix": f"""SELECT cohort, coalesce(max(s.cohort_size), 25) AS cohort_size, {_MATRIX}
        FROM retention r LEFT JOIN sizes s USING (cohort) GROUP BY cohort""",
    "cohort_retention_lists": f"""SELECT cohort, coalesce(max(s.cohort_size), 25) AS cohort_size,
        concat_ws(',', {_SLOT_TEXTS}) AS retention
        FROM retention r LEFT JOIN sizes s USING (cohort) GROUP BY cohort""",
    "overview_kpis": "SELECT * FROM kpis",
    "overview_labels": _LABEL_ROWS
    + """SELECT 'Churn Rate', printf('%.1f%%', churn_pct),
        CASE WHEN churn_change > 0 THEN printf('+%.1f%% vs last mo', churn_change)
          WHEN churn_change < 0 THEN printf('-%.1f%% vs last mo', abs(churn_change)) ELSE 'No change' END,
        CASE WHEN churn_change > 0 THEN 'dn' WHEN churn_change < 0 THEN 'up' ELSE 'neutral' END FROM kpis""",
    "overview_empty": _LABEL_ROWS + "SELECT 'Churn Rate', '0.0%', '-', 'neutral' FROM kpis",
    "mrr_trend": _TREND_ROWS.format(shown=12),
    "mrr_trend_6m": _TREND_ROWS.format(shown=6),
    "mrr_trend_all": _TREND_ROWS.format(shown=1_000_000),
    "revenue_by_plan": f"""SELECT {_capital("plan")} AS plan, mrr AS raw_mrr, {_inr("mrr")} AS mrr,
        CAST(floor(mrr / sum(mrr) OVER () * 100) AS INTEGER) AS pct,
        {_choose("plan", REVENUE_PLAN_COLOURS, REVENUE_PLAN_COLOUR_DEFAULT)} AS color,
        {_choose("plan", PLAN_TIER, 0)} AS tier FROM plan_latest""",
    "revenue_by_plan_none": f"""SELECT {_capital("plan")} AS plan, CAST(0 AS BIGINT) AS raw_mrr, 'INR 0' AS mrr,
        CAST(0 AS INTEGER) AS pct, {_choose("plan", REVENUE_PLAN_COLOURS, REVENUE_PLAN_COLOUR_DEFAULT)} AS color,
        {_choose("plan", PLAN_TIER, 0)} AS tier FROM (SELECT unnest([{_sql_list(PLANS)}]) AS plan)
        WHERE NOT EXISTS (SELECT 1 FROM tenants WHERE plan = 'retired')""",
    "top_tenants": f"""SELECT CAST(row_number() OVER (ORDER BY estimated_ltv DESC, t.tenant_id) AS INTEGER) AS rank, t.tenant_id, company_name, {_capital("plan")} AS plan, estimated_ltv,
        {_inr("estimated_ltv")} AS ltv, m.mrr AS latest_mrr, {_inr("m.mrr")} AS mrr,
        {_trend("mrr_growth_pct")} AS mom_growth, {_trend_class("mrr_growth_pct")} AS mom_class
        FROM (SELECT * FROM ltv ORDER BY estimated_ltv DESC, tenant_id LIMIT 5) t
        JOIN latest_mrr m USING (tenant_id)""",
    "kpi_formatting": f"""SELECT tenant_id, period, {_inr("mrr")} AS mrr_label,
        {_inr("rolling_3m_mrr")} AS rolling_label, {_inr("(arr * 40)")} AS large_label,
        {_inr("(mrr - prev_mrr)")} AS change_label, {_trend("mrr_growth_pct")} AS trend_text,
        {_trend_class("mrr_growth_pct")} AS trend_class FROM mrr""",
    "tenant_status": "SELECT * FROM status",
    "tenant_portfolio": """SELECT count(*) AS total_count, count(*) FILTER (WHERE status = 'Active') AS active_count,
        round(avg(estimated_ltv), 2) AS avg_ltv, round(avg(avg_monthly_mrr), 2) AS arpu FROM status""",
    "tenant_search": """SELECT * FROM status WHERE plan = 'starter'
        AND (regexp_matches(company_name, 'customer#0+.*[37]$', 'i')
          OR regexp_matches(tenant_id, 'customer#0+.*[37]$', 'i'))""",
    "tenant_search_literal": """SELECT * FROM status
        WHERE contains(lower(company_name), 'r#00000001') OR contains(lower(tenant_id), 'r#00000001')""",
    "tenant_search_indexed": r"""SELECT * FROM status WHERE
        regexp_matches(company_name, 'customer#0+\d*12[37]$|^tnt_0*\d0{3}$|mer#000000011', 'i')
          OR regexp_matches(tenant_id, 'customer#0+\d*12[37]$|^tnt_0*\d0{3}$|mer#000000011', 'i')""",
    "tenant_page": f"""SELECT tenant_id, company_name, {_capital("plan")} AS plan,
        {_inr("(CASE WHEN latest_mrr > 0 THEN CAST(latest_mrr AS DOUBLE) ELSE avg_monthly_mrr END)")} AS mrr,
        active_months, {_inr("estimated_ltv")} AS ltv, status,
        (SELECT count(*) FROM status WHERE plan = 'growth') AS total_filtered
        FROM status WHERE plan = 'growth' ORDER BY estimated_ltv DESC, tenant_id LIMIT 15 OFFSET 15""",
    "dataset_inventory": """SELECT dataset, items, format('{:,}', items) AS items_label,
        CASE WHEN items > 0 THEN 100 ELSE 0 END AS bar_width,
        CASE WHEN items > 0 THEN 'st-ok' ELSE 'st-idle' END AS status,
        CASE WHEN items > 0 THEN 'Done' ELSE 'Waiting for data' END AS status_text
        FROM (SELECT 'clean_events' AS dataset, count(*) AS items FROM clean
          UNION ALL SELECT 'rejected_rows', count(*) FROM rejected
          UNION ALL SELECT 'paying_tenants', count(*) FROM ltv
          UNION ALL SELECT 'cohorts', count(DISTINCT cohort) FROM retention)""",
    "tenant_scoped_mrr": "SELECT * FROM mrr WHERE tenant_id = 'TNT_0000000007'",
    "tenant_scoped_tenants": "SELECT * FROM tenants WHERE tenant_id = 'TNT_0000000007'",
    "tenant_scoped_events": "SELECT * FROM raw WHERE tenant_id = 'TNT_0000000007'",
    "tenant_scoped_invoices": "SELECT * FROM invoices WHERE tenant_id = 'TNT_0000000007'",
    "tenant_scoped_subscriptions": "SELECT * FROM subscriptions WHERE tenant_id = 'TNT_0000000007'",
    "sample_events": f"SELECT * FROM raw ORDER BY md5('42|' || {_RAW_TEXT}) LIMIT 5000",
    "revenue_projection": _projected("scenarios", _MONTH_ROWS),
    "projection_summary": _projected("scenarios", _SUMMARY),
    "scenario_rejects": "SELECT * FROM scenario_tags WHERE scenario_error IS NOT NULL",
    "projection_by_plan": _projected("plan_scenarios", _MONTH_ROWS),
    "dq_duplicate_keys": _UNION.join(
        [
            _duplicate_rows("tenants", "tenants", ["tenant_id"]),
            _duplicate_rows("subscriptions", "subscriptions", ["subscription_id"]),
            _duplicate_rows("invoices", "invoices", ["invoice_id"]),
            _duplicate_rows("billing_events", "raw", ["event_id"]),
            _duplicate_rows("mv_monthly_revenue", "revenue_view", ["tenant_id", "billing_month"]),
        ]
    ),
    "dq_nulls": _UNION.join(
        [
            _null_rows("tenants", "tenants", ["tenant_id", "company_name", "plan", "signup_date"]),
            _null_rows(
                "subscriptions",
                "subscriptions",
                ["subscription_id", "tenant_id", "plan", "status", "monthly_amount", "start_date"],
            ),
            _null_rows("invoices", "invoices", ["invoice_id", "tenant_id", "amount", "status", "billing_date"]),
            _null_rows("billing_events", "raw", ["event_id", "tenant_id", "event_type", "event_date"]),
        ]
    ),
    "dq_domain": _UNION.join(
        [
            _domain_rows("tenants", "tenants", "plan", PLANS),
            _domain_rows("subscriptions", "subscriptions", "plan", PLANS),
            _domain_rows("subscriptions", "subscriptions", "status", SUBSCRIPTION_STATUSES),
            _domain_rows("invoices", "invoices", "status", INVOICE_STATUSES),
            _domain_rows("billing_events", "raw", "plan", PLANS),
            _domain_rows("billing_events", "raw", "event_type", EVENT_TYPES),
        ]
    ),
    "dq_orphans": _UNION.join(
        [
            _orphan_rows("billing_events", "raw", "tenant_id", "tenants", "tenant_id"),
            _orphan_rows("billing_events", "raw", "invoice_id", "invoices", "invoice_id"),
            _orphan_rows("invoices", "invoices", "tenant_id", "tenants", "tenant_id"),
            _orphan_rows("invoices", "invoices", "subscription_id", "subscriptions", "subscription_id"),
            _orphan_rows("subscriptions", "subscriptions", "tenant_id", "tenants", "tenant_id"),
        ]
    ),
    "subscriptions_with_defaults": "SELECT * REPLACE (coalesce(seats, 1) AS seats) FROM subscriptions",
    "events_with_defaults": """SELECT event_id, coalesce(nullif(amount, 0), 0) AS amount,
        coalesce(CASE WHEN plan <> 'growth' THEN currency END, 'INR') AS currency,
        coalesce(nullif(status, 'success'), 'success') AS status,
        coalesce(CASE WHEN trial THEN true END, false) AS trial, event_date FROM raw""",
    "csv_roundtrip_events": "SELECT * FROM raw",
    "csv_roundtrip_tenants": "SELECT * FROM tenants",
    "partitioned_roundtrip": """SELECT event_year, event_month, count(*) AS events,
        CAST(sum(amount) AS BIGINT) AS amount, count(DISTINCT event_date_only) AS days,
        count(*) FILTER (WHERE event_type = 'invoice_paid') AS revenue_events,
        count(*) FILTER (WHERE event_type = 'subscription_cancelled') AS churn_events
        FROM events_x GROUP BY event_year, event_month""",
    "marts_roundtrip": _UNION.join(
        [
            _check_row("billing_events", "clean", "amount"),
            _check_row("rejected", "rejected", "length(validation_error)"),
            _check_row("tenants", "tenants", "length(company_name)"),
            _check_row("mrr_by_tenant_month", "mrr", "cumulative_mrr"),
            _check_row("global_mrr_monthly", "global_mrr", "total_arr"),
            _check_row("tenant_ltv", "ltv", "total_revenue"),
            _check_row("churn_by_plan_month", "churn", "churned_tenants"),
            _check_row("cohort_retention", "retention", "retained_tenants"),
            _check_row("cohort_sizes", "sizes", "cohort_size"),
        ]
    ),
    "mv_refresh": "SELECT * FROM revenue_view",
    "mv_refresh_stored": "SELECT * FROM revenue_view",
    "json_event_roundtrip": """SELECT event_id, tenant_id, event_type, plan, amount, currency, event_date, status
        FROM clean""",
    "stream_ingest": """SELECT *, CAST(event_date AS DATE) AS event_date_only,
        event_type = 'invoice_paid' AS is_revenue_event, event_type = 'subscription_cancelled' AS is_churn_event,
        CAST(year(event_date) AS INTEGER) AS event_year, CAST(month(event_date) AS INTEGER) AS event_month
        FROM (SELECT DISTINCT * FROM stream_clean)""",
    "stream_rejects": """SELECT CASE WHEN NOT broken THEN event_id END AS event_id,
        CASE WHEN NOT broken THEN tenant_id END AS tenant_id,
        CASE WHEN NOT broken THEN event_type END AS event_type,
        CASE WHEN NOT broken THEN amount END AS amount, CASE WHEN NOT broken THEN status END AS status,
        CASE WHEN broken THEN '{"event_id": "' || event_id END AS raw_message,
        CASE WHEN broken THEN 'missing event_id' WHEN tenant_id IS NULL THEN 'missing tenant_id'
          WHEN amount < 0 THEN 'negative amount' ELSE 'null event_date' END AS validation_error
        FROM delivered WHERE broken OR tenant_id IS NULL OR amount < 0 OR event_date IS NULL""",
    "stream_dedup": """SELECT DISTINCT event_id, tenant_id, event_type, amount, event_date FROM stream_clean""",
    "stream_conflicts": """SELECT event_id, tenant_id, event_type, amount, event_date + INTERVAL 40 DAY AS event_date,
        'event_id stored with other content' AS validation_error
        FROM messages WHERE source_key % 97 = 0 AND NOT broken AND tenant_id IS NOT NULL AND amount >= 0 AND event_date IS NOT NULL""",
    "stream_mrr": """SELECT tenant_id, CAST(year(event_date) AS INTEGER) AS event_year,
        CAST(month(event_date) AS INTEGER) AS event_month, CAST(sum(amount) AS BIGINT) AS mrr
        FROM (SELECT DISTINCT * FROM stream_clean) WHERE event_type = 'invoice_paid' AND status = 'success'
        GROUP BY ALL""",
    "stream_daily": """SELECT CAST(event_date AS DATE) AS day, event_type, count(*) AS events FROM stream_clean
        GROUP BY 1, 2 HAVING CAST(event_date AS DATE) + INTERVAL 1 DAY
          <= (SELECT max(event_date) FROM stream_clean) - INTERVAL 1 DAY""",
}
_TAILS["stream_daily_late"] = _TAILS["stream_daily"]
_TAILS["stream_mart_refresh"] = f"""SELECT *, CAST(0 AS BIGINT) AS invoice_count, CAST(NULL AS DOUBLE) AS avg_seats,
    {_period("event_year", "event_month")} AS period, lag(mrr) OVER w AS prev_mrr,
    CASE WHEN lag(mrr) OVER w <> 0 THEN round((mrr - lag(mrr) OVER w) / lag(mrr) OVER w * 100, 2) END AS mrr_growth_pct,
    CAST(sum(mrr) OVER (w ROWS UNBOUNDED PRECEDING) AS BIGINT) AS cumulative_mrr,
    avg(mrr) OVER (w ROWS 2 PRECEDING) AS rolling_3m_mrr, mrr * 12 AS arr
    FROM ({_TAILS["stream_mrr"]}) WINDOW w AS (PARTITION BY tenant_id ORDER BY event_year, event_month)"""

ORACLES: dict[str, str] = {
    name: f"{_PREFIX}{tail if tail.startswith(',') else chr(10) + tail}" for name, tail in _TAILS.items()
}
