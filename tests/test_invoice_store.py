"""Invoices by billing month: changes, moves between months, and the view refreshed from touched directories."""

import datetime
import pathlib

import pytest
from pyspark.sql import functions as F

from recurra.operators.revenue import monthly_revenue_view
from recurra.plans import marts
from recurra.sources import fixtures, invoice_store

SF = "/root/testdata/sf0.001"
LAYOUT = "invoice_id string, tenant_id string, billing_date date, amount long, status string"


def day(month, number=5):
    return datetime.date(2024, month, number)


def stored(spark, path):
    return sorted((r.invoice_id, r.billing_month and r.billing_month.month, r.amount) for r in invoice_store.read_invoices(spark, path).collect())


def parts(path):
    return {p for p in pathlib.Path(path).rglob("*.parquet")}


def test_changes_moves_additions_and_emptied_months(spark, tmp_path):
    path = str(tmp_path / "invoices")
    rows = [("a", "t", day(1), 1, "paid"), ("b", "t", day(1), 2, "paid"), ("c", "t", day(2), 3, "paid"), ("d", "u", day(3), 4, "paid")]
    invoice_store.write_invoices(spark.createDataFrame(rows + [("e", "u", None, 5, "paid")], LAYOUT), path)
    march = {p for p in parts(path) if "2024-03" in str(p)}
    change = [("a", "t", day(1), 10, "paid"), ("c", "t", day(4), 30, "paid"), ("n", "v", day(5), 7, "open"), ("n", "v", day(5), 8, "open")]
    changed = spark.createDataFrame(change, LAYOUT)
    months = invoice_store.apply_changes(spark, changed, path)
    assert sorted(r.billing_month.month for r in months.collect()) == [1, 2, 4, 5]
    want = [("a", 1, 10), ("b", 1, 2), ("c", 4, 30), ("d", 3, 4), ("e", 1, 5), ("n", 5, 8)]
    assert stored(spark, path) == want and march <= parts(path)
    invoice_store.apply_changes(spark, changed, path)
    assert stored(spark, path) == want
    invoice_store.apply_changes(spark, spark.createDataFrame([("e", "u", day(2), 6, "paid")], LAYOUT), path)
    assert stored(spark, path) == [w if w[0] != "e" else ("e", 2, 6) for w in want]
    assert march <= parts(path)
    invoice_store.apply_changes(spark, changed.limit(0), path)
    assert len(stored(spark, path)) == 6
    with pytest.raises(ValueError, match="no index"):
        invoice_store.apply_changes(spark, changed, str(tmp_path / "none"))


def test_refresh_reads_and_writes_touched_directories_only(spark, tmp_path):
    table, view = str(tmp_path / "table"), str(tmp_path / "view")
    dim, before = fixtures.tenants(spark, SF), fixtures.invoices(spark, SF)
    invoice_store.write_invoices(before, table)
    marts.write_monthly_revenue(monthly_revenue_view(before, dim), view)
    more = (F.col("amount") + 1).cast(before.schema["amount"].dataType)
    change = before.where("billing_date BETWEEN DATE'1996-05-01' AND DATE'1996-05-31'").withColumn("amount", more)
    files_before = parts(view)
    touched = invoice_store.apply_changes(spark, change, table)
    assert [str(r.billing_month) for r in touched.collect()] == ["1996-05-01"]
    affected = invoice_store.in_months(invoice_store.read_invoices(spark, table), touched)
    assert affected.count() == change.count() > 0
    plan = affected._jdf.queryExecution()
    assert "dynamicpruning" in plan.executedPlan().toString()
    marts.refresh_from_store(spark, table, dim, touched, view)
    ids = change.select("invoice_id")
    after = before.join(ids, "invoice_id", "left_anti").unionByName(change)
    want = monthly_revenue_view(after, dim)
    got = marts.read_monthly_revenue(spark, view).select(*want.columns)
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0
    assert {p.parent.name for p in files_before - parts(view)} == {"billing_month=1996-05-01"}
