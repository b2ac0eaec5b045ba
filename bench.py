"""Times the headline queries and prints one JSON line.

The ``queries`` start from the Parquet tables in ``$BENCH_SF_DIR``, so each of
them includes deriving the billing events. The entries named ``stored_*`` run
the same operators on billing tables written before the clock starts, as CSV or
as Parquet by month. Every run goes to the last row, into Spark's ``noop`` sink.
Each query runs once untimed, then the best of ``$BENCH_REPEATS`` runs counts.
"""

import json
import os
import sys
import time
from functools import partial

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from recurra.operators import churn, cohorts, revenue, validation
from recurra.plans import marts
from recurra.plans.queries import QUERIES, Billing, bind
from recurra.sources import event_store, files
from recurra.sources.scratch import shared_path

HEADLINE = [
    "mrr_total",
    "validated_events",
    "rejection_summary",
    "enriched_events",
    "mrr_by_tenant_month",
    "global_mrr_monthly",
    "tenant_ltv",
    "top_tenants_ltv",
    "latest_tenant_mrr",
    "churn_by_plan_month",
    "churn_kpis",
    "billing_risk",
    "churn_candidates",
    "cohort_retention",
    "cohort_matrix",
    "mv_monthly_revenue",
    "top_lifetime_revenue",
    "overview_kpis",
    "revenue_by_plan",
    "top_tenants",
    "tenant_page",
    "revenue_projection",
    "dq_orphans",
    "sample_events",
    "partitioned_roundtrip",
    "stream_mrr",
]


def stored_queries(spark, sf_dir):
    """Operators over tables written here, before any timing."""
    root = shared_path(spark, "bench")
    billing = Billing(spark, sf_dir)
    files.write_csv(billing.raw, f"{root}/events-csv")
    marts.ingest(billing.raw, billing.tenants, root)

    def from_csv():
        return files.read_events_csv(spark, f"{root}/events-csv")

    def checked_csv():
        return validation.enrich_events(validation.split_events(from_csv())[0])

    def total_of_months(rows):
        return revenue.paid_months(rows).agg(F.sum("mrr").alias("mrr_total"))

    def events():
        return event_store.read_clean(spark, f"{root}/billing_events")

    def tenants():
        return spark.read.parquet(f"{root}/tenants")

    return {
        "stored_csv_mrr_total": lambda: revenue.paid_total(from_csv()),
        "stored_csv_mrr_total_by_month": lambda: total_of_months(checked_csv()),
        "stored_mrr_total_by_month": lambda: total_of_months(events()),
        "stored_csv_rejection_summary": lambda: validation.rejection_summary(
            validation.split_events(from_csv())[1]
        ),
        "stored_mrr_total": lambda: revenue.paid_total(events()),
        "stored_mrr_by_tenant_month": lambda: revenue.monthly_mrr(events()),
        "stored_global_mrr_monthly": lambda: revenue.global_mrr(revenue.monthly_mrr(events())),
        "stored_tenant_ltv": lambda: revenue.tenant_ltv(revenue.monthly_mrr(events()), tenants()),
        "stored_churn_by_plan_month": lambda: churn.churn_by_plan(events()),
        "stored_cohort_retention": lambda: cohorts.cohort_retention(events()),
    }


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    repeats = int(os.environ.get("BENCH_REPEATS", "3"))
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("recurra-bench")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.codegen.cache.maxEntries", "1000")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    runs = {name: partial(bind(QUERIES[name]), spark, sf_dir) for name in sys.argv[1:] or HEADLINE}
    if not sys.argv[1:]:
        runs.update(stored_queries(spark, sf_dir))

    def seconds(run) -> float:
        start = time.perf_counter()
        run().write.format("noop").mode("overwrite").save()
        return time.perf_counter() - start

    best = {}
    for name, run in runs.items():
        seconds(run)
        best[name] = round(min(seconds(run) for _ in range(repeats)), 4)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(best.values()), 4),
                "unit": "sec",
                "queries": best,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
