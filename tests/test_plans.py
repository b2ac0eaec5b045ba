"""The shape of physical plans: pushdown, pruning, shuffles, no Python, no cross joins."""

import re

import pytest
from pyspark.sql import functions as F

from recurra.operators import churn, cohorts, overview, revenue, validation
from recurra.plans.queries import QUERIES, Billing, bind
from recurra.sources import event_store, fixtures

SF = "/root/testdata/sf0.01"
EAGER = re.compile("roundtrip$|^stream_|^mv_refresh|_indexed$")


@pytest.fixture(scope="module", autouse=True)
def untruncated(spark):
    spark.conf.set("spark.sql.maxMetadataStringLength", "5000")
    yield
    spark.conf.unset("spark.sql.maxMetadataStringLength")


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def shuffles(df):
    return re.findall(r"Exchange (\w+)", plan(df).replace("BroadcastExchange", ""))


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("store") / "events")
    event_store.write_events(fixtures.raw_events(spark, SF), path)
    return event_store.read_clean(spark, path)


@pytest.fixture
def no_auto_broadcast(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


@pytest.mark.parametrize("name", [n for n in sorted(QUERIES) if not EAGER.search(n)])
def test_no_cross_join_no_python_no_expand(spark, no_auto_broadcast, name):
    text = plan(bind(QUERIES[name])(spark, SF))
    assert not re.search("BroadcastNestedLoopJoin|CartesianProduct|EvalPython|InPandas|Expand", text)


def test_filters_and_columns_reach_the_scan(stored):
    text = plan(revenue.monthly_mrr(stored))
    assert "EqualTo(event_type,invoice_paid)" in text and "EqualTo(status,success)" in text
    read = re.search(r"ReadSchema: struct<([^>]*)>", text).group(1)
    assert {c.split(":")[0] for c in read.split(",")} == {"tenant_id", "event_type", "amount", "status", "invoice_id", "seats"}
    text = plan(churn.churn_by_plan(stored))
    assert "In(event_type, [invoice_paid,subscription_cancelled])" in text
    text = plan(cohorts.cohort_retention(stored))
    assert "In(event_type, [subscription_cancelled,subscription_created])" in text


def test_month_filter_prunes_directories_through_the_aggregate(stored):
    text = plan(churn.churn_in_month(churn.churn_by_plan(stored), 6))
    partition_filters = re.search(r"PartitionFilters: \[([^\]]*)\]", text).group(1)
    assert re.search(r"event_month#\d+ = 6", partition_filters) and "outcome" in partition_filters


def test_shuffle_counts(stored):
    # tenant and month, then tenant for the windows on the aggregate
    assert shuffles(revenue.monthly_mrr(stored)) == ["hashpartitioning"] * 2
    # the latest month per tenant rides on the windows' partitioning
    assert shuffles(revenue.latest_tenant_mrr(revenue.monthly_mrr(stored))) == ["hashpartitioning"] * 2
    assert shuffles(churn.churn_by_plan(stored)) == ["hashpartitioning"] * 2
    assert shuffles(cohorts.cohort_retention(stored)) == ["hashpartitioning"] * 3
    assert shuffles(revenue.paid_total(stored)) == ["SinglePartition"]
    assert shuffles(validation.rejection_summary(validation.split_events(stored)[1])) == ["hashpartitioning"]


def test_one_window_sort_serves_all_three_frames(stored):
    assert len(re.findall(r"\bWindow \[", plan(revenue.monthly_mrr(stored)))) == 1


def test_projection_needs_no_shuffle(spark):
    for name in ("revenue_projection", "projection_summary", "scenario_rejects"):
        assert shuffles(bind(QUERIES[name])(spark, SF)) == []


def test_events_are_combined_before_every_shuffle(spark, stored):
    """One tenant with a third of all events sends one row per task, month and plan."""
    busy = stored.withColumn("tenant_id", F.when(F.rand(5) < 0.34, F.lit("BUSY")).otherwise(F.col("tenant_id")))
    text = plan(churn.churn_by_plan(busy))
    assert text.index("partial_max") > text.index("hashpartitioning")  # printed below, so it runs before
    mrr = revenue.monthly_mrr(busy)
    assert mrr.filter("tenant_id = 'BUSY'").count() <= 80
    assert revenue.global_mrr(mrr).agg(F.sum("total_mrr")).first() == revenue.global_mrr(
        revenue.monthly_mrr(stored)
    ).agg(F.sum("total_mrr")).first()


def test_a_busy_customer_is_not_gathered_for_the_first_order(spark, no_auto_broadcast):
    text = plan(fixtures.raw_events(spark, SF))
    assert "Window" not in text
    assert re.search(r"SortMergeJoin \[o_orderkey#\d+L?\], \[first_key", text)


def test_top_k_is_fused(spark):
    b = Billing(spark, SF)
    for df in (revenue.top_by_ltv(b.ltv), overview.mrr_trend(b.global_mrr), revenue.top_lifetime_revenue(b.view)):
        assert "TakeOrderedAndProject" in plan(df)
