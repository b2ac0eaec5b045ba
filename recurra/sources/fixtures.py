"""Billing tables derived from the shared TPC-H-like test tables.

The rules are set out in FIXTURES.md section 4.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from recurra.functions import padded_id

# Column types of the shared tables, so that a read needs no look at a file.
TABLES = {
    "orders": "o_orderkey BIGINT, o_custkey BIGINT, o_orderstatus STRING, o_totalprice DOUBLE, "
    "o_orderdate TIMESTAMP_NTZ, o_orderpriority STRING",
    "customer": "c_custkey BIGINT, c_name STRING, c_nationkey INT, c_acctbal DOUBLE, c_mktsegment STRING",
    "nation": "n_nationkey INT, n_name STRING, n_regionkey INT",
    "events": "event_id BIGINT, ts TIMESTAMP_NTZ, user_id BIGINT, event_type STRING, value DOUBLE, props STRING",
}


# Every 47th event names an invoice that doesn't exist.
LOST_INVOICE = "(o_orderkey + IF(o_orderkey % 47 = 0, 5000000000, 0))"


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(TABLES[name]).parquet(f"{sf_dir}/{name}.parquet")


def _orders_with_first_flag(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders plus ``first_key``, set on each customer's earliest order.

    The earliest order comes from an aggregate (combined map-side) and is
    joined back on the unique order key, so a customer with very many orders
    is never gathered in one task.
    """
    orders = read_table(spark, sf_dir, "orders")
    first_orders = orders.groupBy("o_custkey").agg(
        F.expr("min(struct(o_orderdate, o_orderkey)).o_orderkey AS first_key")
    )
    return orders.join(first_orders.select("first_key"), F.expr("o_orderkey = first_key"), "left")


def raw_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One billing event per order, with rule violations sprinkled in."""
    true_type = """CASE
        WHEN first_key IS NOT NULL THEN 'subscription_created'
        WHEN o_orderkey % 1000 < 700 THEN 'invoice_paid'
        WHEN o_orderkey % 1000 < 780 THEN 'invoice_failed'
        WHEN o_orderkey % 1000 < 860 THEN 'subscription_upgraded'
        WHEN o_orderkey % 1000 < 910 THEN 'subscription_downgraded'
        WHEN o_orderkey % 1000 < 925 THEN 'subscription_cancelled'
        WHEN o_orderkey % 1000 < 963 THEN 'trial_started'
        ELSE 'trial_converted' END"""
    is_first = "first_key IS NOT NULL"
    is_paid = f"(NOT {is_first} AND o_orderkey % 1000 < 700)"
    is_failed = f"(NOT {is_first} AND o_orderkey % 1000 BETWEEN 700 AND 779)"
    return _orders_with_first_flag(spark, sf_dir).selectExpr(
        f"IF(o_orderkey % 227 = 0, NULL, {padded_id('EVT_', 'o_orderkey')}) AS event_id",
        f"IF(o_orderkey % 229 = 0, NULL, {padded_id('TNT_', 'o_custkey')}) AS tenant_id",
        f"IF(o_orderkey % 211 = 0, 'unknown_type', {true_type}) AS event_type",
        """CASE o_orderpriority WHEN '1-URGENT' THEN 'enterprise' WHEN '2-HIGH' THEN 'business'
            WHEN '3-MEDIUM' THEN 'growth' ELSE 'starter' END AS plan""",
        f"""CASE WHEN o_orderkey % 223 = 0 THEN -100 WHEN o_orderkey % 97 = 0 THEN 0
            WHEN {is_first} OR {is_paid} THEN CAST(floor(o_totalprice) AS INT) ELSE 0 END AS amount""",
        "'INR' AS currency",
        "IF(o_orderkey % 233 = 0, NULL, o_orderdate) AS event_date",
        f"""CASE WHEN {is_failed} THEN 'failed' WHEN {is_paid} AND o_orderkey % 41 = 0 THEN 'pending'
            ELSE 'success' END AS status""",
        f"IF(o_orderkey % 43 = 0, NULL, {padded_id('INV_', LOST_INVOICE)}) AS invoice_id",
        "CAST(1 + o_orderkey % 20 AS INT) AS seats",
        f"{is_first} AND o_custkey % 2 = 0 AS trial",
    )


def tenants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tenant dimension from customers; every 101st customer is left out."""
    customers = read_table(spark, sf_dir, "customer").filter("c_custkey % 101 <> 0")
    nations = read_table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    signups = (
        read_table(spark, sf_dir, "orders")
        .groupBy("o_custkey")
        .agg(F.expr("CAST(CAST(min(o_orderdate) AS DATE) AS STRING) AS signup_date"))
    )
    return (
        customers.join(nations, F.expr("c_nationkey = n_nationkey"))
        .join(signups, F.expr("c_custkey = o_custkey"), "left")
        .selectExpr(
            f"{padded_id('TNT_', 'c_custkey')} AS tenant_id",
            "c_name AS company_name",
            "c_mktsegment AS industry",
            """CASE WHEN c_custkey % 10 < 4 THEN 'starter' WHEN c_custkey % 10 < 7 THEN 'growth'
                WHEN c_custkey % 10 < 9 THEN 'business' ELSE 'enterprise' END AS plan""",
            "n_name AS country",
            "signup_date",
        )
    )


def invoices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One invoice per order."""
    status = """CASE WHEN o_orderkey % 53 = 0 THEN 'refunded' WHEN o_orderstatus = 'F' THEN 'paid'
        WHEN o_orderstatus = 'P' THEN 'failed' ELSE 'pending' END"""
    return read_table(spark, sf_dir, "orders").selectExpr(
        f"{padded_id('INV_', 'o_orderkey')} AS invoice_id",
        f"{padded_id('TNT_', 'o_custkey')} AS tenant_id",
        f"IF(o_orderkey % 59 = 0, NULL, {padded_id('SUB_', 'o_orderkey')}) AS subscription_id",
        "CAST(floor(o_totalprice) AS INT) AS amount",
        "'INR' AS currency",
        f"{status} AS status",
        "CAST(o_orderdate AS DATE) AS billing_date",
        "date_add(CAST(o_orderdate AS DATE), 30) AS due_date",
        f"IF({status} = 'paid', CAST(o_orderdate AS DATE), NULL) AS paid_date",
    )


def subscriptions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One subscription period per order, with violations of each constraint sprinkled in."""
    status = """CASE WHEN o_orderkey % 263 = 0 THEN 'expired' WHEN o_orderstatus = 'F' THEN 'cancelled'
        WHEN o_orderstatus = 'P' THEN 'paused' WHEN o_orderkey % 9 = 0 THEN 'trial' ELSE 'active' END"""
    # Every 251st row repeats the id before it.
    number = "(o_orderkey - IF(o_orderkey % 251 = 0, 1, 0))"
    return read_table(spark, sf_dir, "orders").selectExpr(
        f"{padded_id('SUB_', number)} AS subscription_id",
        f"IF(o_orderkey % 239 = 0, NULL, {padded_id('TNT_', 'o_custkey')}) AS tenant_id",
        """CASE WHEN o_orderkey % 257 = 0 THEN 'legacy' WHEN o_orderpriority = '1-URGENT' THEN 'enterprise'
            WHEN o_orderpriority = '2-HIGH' THEN 'business' WHEN o_orderpriority = '3-MEDIUM' THEN 'growth'
            ELSE 'starter' END AS plan""",
        f"{status} AS status",
        "CAST(floor(o_totalprice) AS INT) AS monthly_amount",
        "CAST(IF(o_orderkey % 5 = 0, NULL, 1 + o_orderkey % 20) AS INT) AS seats",
        "IF(o_orderkey % 233 = 0, NULL, CAST(o_orderdate AS DATE)) AS start_date",
        f"IF({status} = 'cancelled', date_add(CAST(o_orderdate AS DATE), 365), NULL) AS end_date",
        f"IF({status} = 'trial', date_add(CAST(o_orderdate AS DATE), 14), NULL) AS trial_end_date",
    )


def scenarios(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One what-if scenario per customer; some break an input range."""
    return read_table(spark, sf_dir, "customer").selectExpr(
        f"{padded_id('SCN_', 'c_custkey')} AS scenario_id",
        "CAST(IF(c_custkey % 97 = 0, 0, 1 + c_custkey * 37 % 5000) AS INT) AS starting_tenants",
        """floor(abs(c_acctbal)) * 10 + (c_custkey % 4) / 4
            - IF(c_custkey % 89 = 0, 1e6D, 0D) AS monthly_arpu""",
        "((c_custkey * 7) % 60 - 15) / 2 + IF(c_custkey % 83 = 0, 500D, 0D) AS monthly_growth_pct",
        "((c_custkey * 11) % 48) / 4 + IF(c_custkey % 79 = 0, 100.5D, 0D) AS monthly_churn_pct",
        "CAST(1 + c_custkey % 36 + IF(c_custkey % 73 = 0, 36, 0) AS INT) AS months",
    )


def stream_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Message fields of the ``events`` table, before JSON encoding.

    Broken on purpose: no tenant on every 61st event, a negative amount on
    every 67th, a bad date on every 71st.
    """
    return read_table(spark, sf_dir, "events").selectExpr(
        f"{padded_id('EVT_', 'event_id')} AS event_id",
        f"IF(event_id % 61 = 0, NULL, {padded_id('TNT_', 'user_id')}) AS tenant_id",
        """CASE event_type WHEN 'signup' THEN 'subscription_created' WHEN 'purchase' THEN 'invoice_paid'
            WHEN 'error' THEN 'invoice_failed' WHEN 'click' THEN 'subscription_upgraded'
            WHEN 'view' THEN 'trial_started' END AS event_type""",
        """CASE user_id % 4 WHEN 0 THEN 'starter' WHEN 1 THEN 'growth' WHEN 2 THEN 'business'
            ELSE 'enterprise' END AS plan""",
        """CAST(CASE WHEN event_id % 67 = 0 THEN -1 WHEN event_type = 'purchase' THEN floor(value)
            ELSE 0 END AS INT) AS amount""",
        "'INR' AS currency",
        """IF(event_id % 71 = 0, 'not a date', date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")) AS event_date""",
        "IF(event_type = 'error', 'failed', 'success') AS status",
        "event_id AS source_key",
    )
