"""The registered queries: operators bound to the shared test tables."""

from __future__ import annotations

from collections.abc import Callable
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.readwriter import DataStreamWriter

from recurra import functions as fn
from recurra import schemas
from recurra.operators import (
    access,
    churn,
    cohorts,
    fallback,
    inventory,
    overview,
    portfolio,
    projection,
    quality,
    revenue,
    sampling,
    validation,
)
from recurra.plans import marts
from recurra.sources import event_store, files, fixtures, invoice_store, name_index
from recurra.sources.scratch import shared_path
from recurra.streaming import daily, jobs, messages

SCOPED_TENANT = "TNT_0000000007"
TREND_TENANT = "TNT_0000000001"
SEARCH = "customer#0+.*[37]$"
LITERAL_SEARCH = "r#00000001"
INDEXED_SEARCH = r"customer#0+\d*12[37]$|^tnt_0*\d0{3}$|mer#000000011"
UNSOLD_PLAN = "retired"
UNREADABLE_EVERY = 7
SAMPLE_SIZE = 5_000
REDELIVERED_EVERY = 50
LATE_BATCHES = 3
BROKEN_EVERY = 199
# Every 97th clean message comes again with a date in another month.
RETURNED = "source_key % 97 = 0 AND source_key % 61 <> 0 AND source_key % 67 <> 0 AND source_key % 71 <> 0 AND source_key % 199 <> 0"
RETURNED_DAYS = 40
LATE_DAYS = 45
REVISED_EVERY = 101


class Billing:
    """The billing tables and marts of one scale factor, built lazily."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir

    @cached_property
    def raw(self) -> DataFrame:
        return fixtures.raw_events(self.spark, self.sf_dir)

    @cached_property
    def clean(self) -> DataFrame:
        return validation.split_events(self.raw)[0]

    @cached_property
    def rejected(self) -> DataFrame:
        return validation.split_events(self.raw)[1]

    @cached_property
    def events(self) -> DataFrame:
        return validation.enrich_events(self.clean)

    @cached_property
    def tenants(self) -> DataFrame:
        return fixtures.tenants(self.spark, self.sf_dir)

    @cached_property
    def invoices(self) -> DataFrame:
        return fixtures.invoices(self.spark, self.sf_dir)

    @cached_property
    def subscriptions(self) -> DataFrame:
        return fixtures.subscriptions(self.spark, self.sf_dir)

    @cached_property
    def mrr(self) -> DataFrame:
        return revenue.monthly_mrr(self.events)

    @cached_property
    def global_mrr(self) -> DataFrame:
        return revenue.global_mrr(self.mrr)

    @cached_property
    def ltv(self) -> DataFrame:
        return revenue.tenant_ltv(self.mrr, self.tenants)

    @cached_property
    def churn(self) -> DataFrame:
        return churn.churn_by_plan(self.events)

    @cached_property
    def retention(self) -> DataFrame:
        return cohorts.cohort_retention(self.events)

    @cached_property
    def cohort_sizes(self) -> DataFrame:
        return cohorts.cohort_sizes(self.events)

    @cached_property
    def view(self) -> DataFrame:
        return revenue.monthly_revenue_view(self.invoices, self.tenants)

    @cached_property
    def status(self) -> DataFrame:
        return portfolio.tenant_standing(self.mrr, self.tenants)

    @cached_property
    def scenarios(self) -> DataFrame:
        return projection.split_scenarios(fixtures.scenarios(self.spark, self.sf_dir))[0]


def _plain_dates(events: DataFrame) -> DataFrame:
    """``event_date`` without a zone, as the test tables have it."""
    return events.withColumn("event_date", F.col("event_date").cast("timestamp_ntz"))


def _union(parts: list[DataFrame]) -> DataFrame:
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


# --- file round trips -------------------------------------------------------


def _csv_roundtrip_events(b: Billing) -> DataFrame:
    path = shared_path(b.spark, "events-csv")
    files.write_csv(b.raw, path)
    return _plain_dates(files.read_events_csv(b.spark, path))


def _csv_roundtrip_tenants(b: Billing) -> DataFrame:
    path = shared_path(b.spark, "tenants-csv")
    files.write_csv(b.tenants, path)
    return files.read_tenants_csv(b.spark, path)


def _partitioned_roundtrip(b: Billing) -> DataFrame:
    path = shared_path(b.spark, "events")
    event_store.write_events(b.raw, path)
    return event_store.read_clean(b.spark, path).groupBy("event_year", "event_month").agg(
        F.count("*").alias("events"),
        F.sum("amount").alias("amount"),
        F.countDistinct("event_date_only").alias("days"),
        F.count_if("is_revenue_event").alias("revenue_events"),
        F.count_if("is_churn_event").alias("churn_events"),
    )


def _marts_roundtrip(b: Billing) -> DataFrame:
    """Row count and one checksum per stored table."""
    root = shared_path(b.spark, "marts")
    marts.ingest(b.raw, b.tenants, root)
    marts.build_marts(b.spark, root)
    checks = {
        "billing_events": F.sum("amount"),
        "rejected": F.sum(F.length("validation_error")),
        "tenants": F.sum(F.length("company_name")),
        "mrr_by_tenant_month": F.sum("cumulative_mrr"),
        "global_mrr_monthly": F.sum("total_arr"),
        "tenant_ltv": F.sum("total_revenue"),
        "churn_by_plan_month": F.sum("churned_tenants"),
        "cohort_retention": F.sum("retained_tenants"),
        "cohort_sizes": F.sum("cohort_size"),
    }
    events = f"{root}/billing_events"
    tables = {name: b.spark.read.parquet(f"{root}/{name}") for name in ["tenants", *marts.MARTS]}
    tables["billing_events"] = event_store.read_clean(b.spark, events)
    tables["rejected"] = event_store.read_rejected(b.spark, events)
    return _union(
        [
            tables[name].agg(
                F.lit(name).alias("table_name"), F.count("*").alias("table_rows"), check.alias("checksum")
            )
            for name, check in checks.items()
        ]
    )


def _mv_refresh(b: Billing) -> DataFrame:
    """Store the view without the newest invoices, then refresh their months."""
    path = shared_path(b.spark, "monthly-revenue")
    newest = b.invoices.agg(F.max("billing_date")).scalar()
    late = F.col("billing_date") >= F.date_sub(newest, LATE_DAYS)
    first_load = revenue.monthly_revenue_view(b.invoices.filter(~late), b.tenants)
    marts.write_monthly_revenue(first_load, path)
    marts.refresh_monthly_revenue(b.invoices, b.tenants, b.invoices.filter(late), path)
    return marts.read_monthly_revenue(b.spark, path).select(*schemas.MONTHLY_REVENUE.names)


def _mv_refresh_stored(b: Billing) -> DataFrame:
    """Store invoices of which some are older versions in another month, apply the present ones, refresh the months they touch."""
    root = shared_path(b.spark, "invoices")
    revised = F.crc32(F.col("invoice_id").cast("binary")) % REVISED_EVERY == 0
    older = F.when(revised, F.add_months("billing_date", 1)).otherwise(F.col("billing_date"))
    first = b.invoices.withColumns({"billing_date": older, "amount": F.when(revised, F.lit(1)).otherwise(F.col("amount")).cast("long")})
    first = first.select(*(F.col(f.name).cast(f.dataType) for f in b.invoices.schema))
    invoice_store.write_invoices(first, f"{root}/table")
    marts.write_monthly_revenue(revenue.monthly_revenue_view(first, b.tenants), f"{root}/view")
    touched = invoice_store.apply_changes(b.spark, b.invoices.filter(revised), f"{root}/table")
    marts.refresh_from_store(b.spark, f"{root}/table", b.tenants, touched, f"{root}/view")
    return marts.read_monthly_revenue(b.spark, f"{root}/view").select(*schemas.MONTHLY_REVENUE.names)


def _tenant_search_indexed(b: Billing) -> DataFrame:
    """The tenant list stored with its trigram index, and searched there."""
    return name_index.build(b.status, shared_path(b.spark, "name-index")).search(INDEXED_SEARCH)


# --- streams ----------------------------------------------------------------


def _message_stream(b: Billing, returned: bool = True, parts: int | None = None) -> DataFrame:
    """The ``events`` table as a stream of JSON texts, some twice, some broken, and some again with a date in another month.

    With ``parts`` the texts are dealt to that many files whatever their dates, and each is a micro-batch of its own.
    """
    path = shared_path(b.spark, "messages")
    key = F.col("source_key")
    copies = F.when(key % REDELIVERED_EVERY == 0, 2).otherwise(1)
    broken = F.concat(F.lit('{"event_id": "'), F.col("event_id"))
    sent = fixtures.stream_events(b.spark, b.sf_dir)
    if returned:
        later = f"date_format(CAST(event_date AS TIMESTAMP_NTZ) + INTERVAL {RETURNED_DAYS} DAYS, \"yyyy-MM-dd'T'HH:mm:ss.SSSSSS\")"
        sent = sent.unionByName(sent.filter(RETURNED).withColumns({"event_date": F.expr(later), "source_key": F.lit(-1).cast("long")}))
    texts = (
        sent.withColumn("copy", F.explode(F.sequence(F.lit(1), copies)))
        .select(F.when(key % BROKEN_EVERY == 0, broken).otherwise(messages.message_text()).alias("value"))
    )
    if parts:
        texts = texts.repartition(parts)
    texts.write.mode("overwrite").text(path)
    return messages.decode_messages(messages.read_message_files(b.spark, path, parts and 1))


def _finish(writer: DataStreamWriter, root: str) -> None:
    jobs.start(writer, f"{root}/checkpoint").awaitTermination()


def _ingested(b: Billing) -> str:
    root = shared_path(b.spark, "stream-ingest")
    _finish(jobs.ingest(_message_stream(b), f"{root}/events"), root)
    return f"{root}/events"


def _stream_ingest(b: Billing) -> DataFrame:
    stored = event_store.read_clean(b.spark, _ingested(b))
    return _plain_dates(stored).drop("invoice_id", "seats", "trial")


def _stream_rejects(b: Billing) -> DataFrame:
    return event_store.read_rejected(b.spark, _ingested(b)).select(
        "event_id", "tenant_id", "event_type", "amount", "status", "raw_message", "validation_error"
    )


def _to_parquet(b: Billing, name: str, stream: DataFrame) -> DataFrame:
    root = shared_path(b.spark, name)
    _finish(stream.writeStream.format("parquet").option("path", f"{root}/out"), root)
    return b.spark.read.parquet(f"{root}/out")


def _stream_conflicts(b: Billing) -> DataFrame:
    """What a second delivery brings under ids that are stored already."""
    root = shared_path(b.spark, "stream-conflicts")
    for n, returned in enumerate((False, True)):
        _finish(jobs.ingest(_message_stream(b, returned), f"{root}/events"), f"{root}/{n}")
    found = _plain_dates(event_store.read_conflicts(b.spark, f"{root}/events"))
    return found.select("event_id", "tenant_id", "event_type", "amount", "event_date", "validation_error")


def _stream_dedup(b: Billing) -> DataFrame:
    stored = event_store.read_clean(b.spark, _ingested(b))
    return _plain_dates(stored).select("event_id", "tenant_id", "event_type", "amount", "event_date")


def _stream_mrr(b: Billing) -> DataFrame:
    return jobs.running_mrr(b.spark, _ingested(b)).select("tenant_id", "event_year", "event_month", "mrr")


def _stream_daily(b: Billing) -> DataFrame:
    clean = validation.split_events(_message_stream(b, returned=False))[0].drop("raw_message")
    return _to_parquet(b, "stream-daily", jobs.daily_counts(clean))


def _stream_daily_late(b: Billing) -> DataFrame:
    """The closed days of batches that each hold events of all days, so that most come late."""
    root = shared_path(b.spark, "stream-daily-late")
    clean = validation.split_events(_message_stream(b, returned=False, parts=LATE_BATCHES))[0].drop("raw_message")
    _finish(daily.count_days(clean, f"{root}/days"), root)
    return daily.closed_days(b.spark, f"{root}/days").select("day", "event_type", "events")


def _stream_mart_refresh(b: Billing) -> DataFrame:
    root = shared_path(b.spark, "stream-marts")
    _finish(jobs.refresh_marts(_message_stream(b), f"{root}/events", f"{root}/mrr"), root)
    return jobs.read_mart(b.spark, f"{root}/mrr")


# --- reports ----------------------------------------------------------------


def _json_event_roundtrip(b: Billing) -> DataFrame:
    iso = F.date_format("event_date", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
    rendered = b.clean.withColumn("event_date", iso).select(messages.message_text().alias("value"))
    return _plain_dates(messages.decode_messages(rendered)).select(*schemas.MESSAGE.names)


def _kpi_formatting(b: Billing) -> DataFrame:
    change = F.col("mrr") - F.col("prev_mrr")
    growth = F.col("mrr_growth_pct")
    return b.mrr.select(
        "tenant_id",
        "period",
        fn.inr_label(F.col("mrr")).alias("mrr_label"),
        fn.inr_label(F.col("rolling_3m_mrr")).alias("rolling_label"),
        fn.inr_label(F.col("arr") * 40).alias("large_label"),
        fn.inr_label(change).alias("change_label"),
        fn.trend_label(growth).alias("trend_text"),
        fn.trend_class(growth).alias("trend_class"),
    )


def _overview_empty(b: Billing) -> DataFrame:
    """Overview while the churn mart does not exist yet."""
    absent = files.load_or_empty(b.spark, shared_path(b.spark, "no-churn-mart"), schemas.CHURN)
    return overview.overview_labels(overview.overview_kpis(b.global_mrr, absent))


def _unsold(b: Billing) -> DataFrame:
    """Tenants of a plan that nobody has, so that a report on them is empty."""
    return b.tenants.filter(F.col("plan") == UNSOLD_PLAN)


def _billing_risk_text_dates(b: Billing) -> DataFrame:
    """Billing risk over events whose dates are texts, some unreadable."""
    text = F.date_format("event_date", "yyyy-MM-dd HH:mm:ss")
    unreadable = F.col("seats") % UNREADABLE_EVERY == 0
    dated = b.clean.withColumn("event_date", F.when(unreadable, "not a date").otherwise(text))
    return churn.billing_risk(dated, b.ltv)


def _retention_texts(b: Billing) -> DataFrame:
    """The matrix with its twelve slots in one list, shown as text."""
    shown = F.transform("retention", lambda rate: F.coalesce(rate.cast("string"), F.lit("null")))
    lists = cohorts.retention_lists(cohorts.cohort_matrix(b.retention, b.cohort_sizes))
    return lists.withColumn("retention", F.concat_ws(",", shown))


def _rounded(df: DataFrame, digits: int, *names: str) -> DataFrame:
    return df.withColumns({name: F.round(name, digits) for name in names})


def _plan_scenarios(b: Billing) -> DataFrame:
    return projection.seeded_scenarios(b.mrr, b.tenants, churn.plan_churn(b.churn))[0]


def _dq_duplicate_keys(b: Billing) -> DataFrame:
    return _union(
        [
            quality.duplicate_keys(b.tenants, "tenants", ["tenant_id"]),
            quality.duplicate_keys(b.subscriptions, "subscriptions", ["subscription_id"]),
            quality.duplicate_keys(b.invoices, "invoices", ["invoice_id"]),
            quality.duplicate_keys(b.raw, "billing_events", ["event_id"]),
            quality.duplicate_keys(b.view, "mv_monthly_revenue", ["tenant_id", "billing_month"]),
        ]
    )


def _dq_nulls(b: Billing) -> DataFrame:
    return _union(
        [
            quality.null_counts(b.tenants, "tenants", ["tenant_id", "company_name", "plan", "signup_date"]),
            quality.null_counts(
                b.subscriptions,
                "subscriptions",
                ["subscription_id", "tenant_id", "plan", "status", "monthly_amount", "start_date"],
            ),
            quality.null_counts(
                b.invoices, "invoices", ["invoice_id", "tenant_id", "amount", "status", "billing_date"]
            ),
            quality.null_counts(
                b.raw, "billing_events", ["event_id", "tenant_id", "event_type", "event_date"]
            ),
        ]
    )


def _dq_domain(b: Billing) -> DataFrame:
    return _union(
        [
            quality.domain_violations(b.tenants, "tenants", {"plan": schemas.PLANS}),
            quality.domain_violations(
                b.subscriptions,
                "subscriptions",
                {"plan": schemas.PLANS, "status": schemas.SUBSCRIPTION_STATUSES},
            ),
            quality.domain_violations(b.invoices, "invoices", {"status": schemas.INVOICE_STATUSES}),
            quality.domain_violations(
                b.raw, "billing_events", {"plan": schemas.PLANS, "event_type": schemas.EVENT_TYPES}
            ),
        ]
    )


def _dq_orphans(b: Billing) -> DataFrame:
    def named(df: DataFrame, table: str, column: str) -> DataFrame:
        return df.select(F.lit(table).alias("table_name"), F.lit(column).alias("column_name"), "*")

    return _union(
        [
            named(quality.orphans(b.raw, "tenant_id", b.tenants, "tenant_id"), "billing_events", "tenant_id"),
            named(quality.orphans(b.raw, "invoice_id", b.invoices, "invoice_id"), "billing_events", "invoice_id"),
            named(quality.orphans(b.invoices, "tenant_id", b.tenants, "tenant_id"), "invoices", "tenant_id"),
            named(
                quality.orphans(b.invoices, "subscription_id", b.subscriptions, "subscription_id"),
                "invoices",
                "subscription_id",
            ),
            named(quality.orphans(b.subscriptions, "tenant_id", b.tenants, "tenant_id"), "subscriptions", "tenant_id"),
        ]
    )


def _events_with_defaults(b: Billing) -> DataFrame:
    """Defaults over events whose default values were left out."""
    thin = b.raw.select(
        "event_id",
        F.when(F.col("amount") != 0, F.col("amount")).alias("amount"),
        F.when(F.col("plan") != "growth", F.col("currency")).alias("currency"),
        F.when(F.col("status") != "success", F.col("status")).alias("status"),
        F.when(F.col("trial"), F.col("trial")).alias("trial"),
        "event_date",
    )
    return quality.with_defaults(thin)


QUERIES: dict[str, Callable[[Billing], DataFrame]] = {
    # validation
    "validated_events": lambda b: b.clean,
    "rejected_events": lambda b: b.rejected,
    "rejection_summary": lambda b: validation.rejection_summary(b.rejected),
    "enriched_events": lambda b: b.events,
    # revenue
    "mrr_by_tenant_month": lambda b: b.mrr,
    "global_mrr_monthly": lambda b: b.global_mrr.orderBy("event_year", "event_month"),
    "global_mrr_last6": lambda b: revenue.last_months(b.global_mrr),
    "tenant_ltv": lambda b: b.ltv,
    "top_tenants_ltv": lambda b: revenue.top_by_ltv(b.ltv),
    "paid_months": lambda b: revenue.paid_months(b.events),
    "mrr_total": lambda b: revenue.paid_total(b.clean),
    "latest_tenant_mrr": lambda b: revenue.latest_tenant_mrr(b.mrr),
    "mv_monthly_revenue": lambda b: b.view,
    "tenant_revenue_trend": lambda b: revenue.tenant_revenue_trend(b.view, TREND_TENANT),
    "top_lifetime_revenue": lambda b: revenue.top_lifetime_revenue(b.view),
    # churn
    "active_tenants_by_plan": lambda b: churn.active_tenants(b.events),
    "churned_tenants_by_plan": lambda b: churn.churned_tenants(b.events),
    "churn_by_plan_month": lambda b: b.churn.orderBy("event_year", "event_month", "plan"),
    "churn_month_sample": lambda b: churn.churn_in_month(b.churn),
    "churn_head": lambda b: churn.churn_head(b.churn),
    "churn_by_period": lambda b: churn.churn_by_period(churn.with_activity(b.churn)),
    "latest_churn_period": lambda b: churn.latest_churn_period(b.churn),
    "churn_kpis": lambda b: churn.churn_kpis(b.churn, b.events),
    "plan_churn_latest": lambda b: churn.plan_churn(b.churn),
    "billing_risk": lambda b: churn.billing_risk(b.events, b.ltv),
    "billing_risk_text_dates": _billing_risk_text_dates,
    "billing_risk_none": lambda b: fallback.billing_risk_or_notice(churn.billing_risk(b.events, _unsold(b))),
    "churn_candidates": lambda b: churn.churn_candidates(b.tenants, b.invoices),
    # cohorts
    "cohort_assignment": lambda b: cohorts.cohort_assignment(b.events),
    "first_cancellation": lambda b: cohorts.first_cancellation(b.events),
    "cohort_sizes": lambda b: b.cohort_sizes,
    "cohort_retention": lambda b: b.retention,
    "cohort_retention_head": lambda b: cohorts.retention_head(b.retention),
    "cohort_matrix": lambda b: cohorts.cohort_matrix(b.retention, b.cohort_sizes),
    "cohort_retention_lists": _retention_texts,
    # reports
    "overview_kpis": lambda b: overview.overview_kpis(b.global_mrr, b.churn),
    "overview_labels": lambda b: overview.overview_labels(overview.overview_kpis(b.global_mrr, b.churn)),
    "overview_empty": _overview_empty,
    "mrr_trend": lambda b: overview.mrr_trend(b.global_mrr),
    "mrr_trend_6m": lambda b: overview.mrr_trend(b.global_mrr, "6m"),
    "mrr_trend_all": lambda b: overview.mrr_trend(b.global_mrr, "all"),
    "revenue_by_plan": lambda b: overview.revenue_by_plan(b.mrr, b.tenants),
    "revenue_by_plan_none": lambda b: fallback.revenue_by_plan_or_zero(overview.revenue_by_plan(b.mrr, _unsold(b))),
    "top_tenants": lambda b: overview.top_tenants(b.ltv, b.mrr),
    "kpi_formatting": _kpi_formatting,
    "tenant_status": lambda b: b.status,
    "tenant_portfolio": lambda b: _rounded(portfolio.tenant_portfolio(b.status), 2, "avg_ltv", "arpu"),
    "tenant_search": lambda b: portfolio.tenant_search(b.status, SEARCH, "Starter"),
    "tenant_search_literal": lambda b: portfolio.tenant_search(b.status, LITERAL_SEARCH, literal=True),
    "tenant_search_indexed": _tenant_search_indexed,
    "tenant_page": lambda b: portfolio.tenant_page(portfolio.tenant_search(b.status, plan="growth"), page=2),
    "dataset_inventory": lambda b: inventory.dataset_inventory(b.events, b.rejected, b.ltv, b.retention),
    "tenant_scoped_mrr": lambda b: access.tenant_scope(b.mrr, SCOPED_TENANT),
    "tenant_scoped_tenants": lambda b: access.tenant_scope(b.tenants, SCOPED_TENANT),
    "tenant_scoped_events": lambda b: access.tenant_scope(b.raw, SCOPED_TENANT),
    "tenant_scoped_invoices": lambda b: access.tenant_scope(b.invoices, SCOPED_TENANT),
    "tenant_scoped_subscriptions": lambda b: access.tenant_scope(b.subscriptions, SCOPED_TENANT),
    "sample_events": lambda b: sampling.sample_rows(b.raw, SAMPLE_SIZE),
    # projections
    "revenue_projection": lambda b: projection.revenue_projection(b.scenarios),
    "projection_summary": lambda b: projection.projection_summary(b.scenarios),
    "scenario_rejects": lambda b: projection.split_scenarios(fixtures.scenarios(b.spark, b.sf_dir))[1],
    "projection_by_plan": lambda b: projection.revenue_projection(_plan_scenarios(b)),
    # data quality
    "dq_duplicate_keys": _dq_duplicate_keys,
    "dq_nulls": _dq_nulls,
    "dq_domain": _dq_domain,
    "dq_orphans": _dq_orphans,
    "subscriptions_with_defaults": lambda b: quality.with_defaults(b.subscriptions, quality.SUBSCRIPTION_DEFAULTS),
    "events_with_defaults": _events_with_defaults,
    # files
    "csv_roundtrip_events": _csv_roundtrip_events,
    "csv_roundtrip_tenants": _csv_roundtrip_tenants,
    "partitioned_roundtrip": _partitioned_roundtrip,
    "marts_roundtrip": _marts_roundtrip,
    "mv_refresh": _mv_refresh,
    "mv_refresh_stored": _mv_refresh_stored,
    "json_event_roundtrip": _json_event_roundtrip,
    # streams
    "stream_ingest": _stream_ingest,
    "stream_rejects": _stream_rejects,
    "stream_dedup": _stream_dedup,
    "stream_conflicts": _stream_conflicts,
    "stream_mrr": _stream_mrr,
    "stream_daily": _stream_daily,
    "stream_daily_late": _stream_daily_late,
    "stream_mart_refresh": _stream_mart_refresh,
}


def bind(build: Callable[[Billing], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    """A query as a function of the session and the table directory."""
    return lambda spark, sf_dir: build(Billing(spark, sf_dir))
