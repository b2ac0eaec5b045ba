"""The id index, conflicts, and the revenue mart that follows changed months."""

import random
import re

import pytest
from pyspark.sql import functions as F

from recurra.operators.revenue import monthly_mrr
from recurra.operators.validation import enrich_events
from recurra.sources import event_store, id_index
from recurra.streaming import history
from tests.rows import event, events

IDS = "event_id string, event_year int, event_month int"


def stored(spark, path):
    return sorted((r.event_id, r.event_month, r.amount) for r in event_store.read_clean(spark, path).collect())


def conflicts(spark, path):
    return sorted((r.event_id, r.event_date.month, r.amount, r.validation_error) for r in event_store.read_conflicts(spark, path).collect())


def test_index_finds_all_claimed_ids_and_reads_their_buckets_only(spark, tmp_path):
    rows = [(f"EVT_{n}", 2024, 1 + n % 12) for n in range(3_000)]
    index = id_index.build(spark.createDataFrame(rows[:2_000], IDS), str(tmp_path / "ids"), buckets=16, blocks=2)
    index.claim(spark.createDataFrame(rows[2_000:], IDS))
    index.claim(spark.createDataFrame(rows[:50], IDS))  # again
    asked = spark.createDataFrame([(f"EVT_{n}",) for n in range(2_900, 3_100)], "event_id string")
    found = {(r.event_id, r.event_month) for r in index.located(asked).collect()}
    assert found == {(name, month) for name, _, month in rows[2_900:]}
    new = spark.createDataFrame([(f"NEW_{n}",) for n in range(4_000)], "event_id string")
    assert index.maybe(new).count() < 40  # one percent would be 40, and the blocks are less than full
    fill = index.fill().agg(F.max("filled"), F.count("*"), F.max("false_hits")).first()
    assert 0 < fill[0] < 0.05 and fill[1] == 32 and fill[2] < 1e-6
    again = id_index.open_or_none(spark, str(tmp_path / "ids"))
    assert (again.buckets, again.blocks) == (16, 2)
    assert id_index.open_or_none(spark, str(tmp_path / "none")) is None
    one = spark.createDataFrame([("EVT_7",)], "event_id string")
    plan = again.located(one)._jdf.queryExecution().executedPlan().toString()
    assert len(re.search(r"PartitionFilters: \[isnotnull\(bucket#\d+\), \(bucket#\d+ = \d+\)\]", plan).group()) > 0
    assert again.located(spark.createDataFrame([("NEW_x",)], "event_id string")) is None


def test_an_id_that_returns_with_another_month_or_amount_is_a_conflict(spark, tmp_path):
    path = str(tmp_path / "events")
    first = [event("1", "T", "invoice_paid", "2024-01-05 00:00:00"), event("2", "T", "invoice_paid", "2024-02-05 00:00:00"),
             event("2", "T", "invoice_paid", "2024-02-05 00:00:00"), event("3", None, "invoice_paid", "2024-02-05 00:00:00")]
    done = event_store.append_once(events(spark, first), path)
    assert done == event_store.Appended([(2024, 1), (2024, 2)], stored=2, copies=1, conflicts=0, rejected=1)
    second = [event("1", "T", "invoice_paid", "2024-03-05 00:00:00"), event("2", "T", "invoice_paid", "2024-02-05 00:00:00", amount=7),
              event("1", "T", "invoice_paid", "2024-01-05 00:00:00"), event("4", "T", "invoice_paid", "2024-03-05 00:00:00", amount=9),
              event("4", "T", "invoice_paid", "2024-03-05 00:00:00", amount=8), event("1", "T", "invoice_paid", "2024-03-05 00:00:00")]
    for attempt in range(2):  # the second time nothing is new
        done = event_store.append_once(events(spark, second), path)
        assert (done.stored, done.copies, done.conflicts, done.rejected) == ((1, 1, 4, 0), (0, 2, 4, 0))[attempt]
        assert stored(spark, path) == [("EVT_1", 1, 100), ("EVT_2", 2, 100), ("EVT_4", 3, 8)]
        wrong = event_store.CONFLICT_ERROR
        assert conflicts(spark, path) == [("EVT_1", 3, 100, wrong), ("EVT_2", 2, 7, wrong), ("EVT_4", 3, 9, wrong)]
    assert event_store.read_rejected(spark, path).count() == 1


def test_a_claim_without_its_event_loses_nothing(spark, tmp_path):
    path = str(tmp_path / "events")
    event_store.append_once(events(spark, [event("1", "T", "invoice_paid", "2024-01-05 00:00:00")]), path)
    index = id_index.open_or_none(spark, event_store.index_path(path))
    index.claim(spark.createDataFrame([("EVT_2", 2024, 1), ("EVT_3", 2024, 5)], IDS))  # and then the batch broke off
    rows = [event("2", "T", "invoice_paid", "2024-01-05 00:00:00"), event("3", "T", "invoice_paid", "2024-06-05 00:00:00")]
    assert event_store.append_once(events(spark, rows), path).stored == 2
    assert [name for name, *_ in stored(spark, path)] == ["EVT_1", "EVT_2", "EVT_3"]


def test_a_store_written_as_a_batch_gets_its_index(spark, tmp_path):
    path = str(tmp_path / "events")
    old = [event(str(n), "T", "invoice_paid", f"2024-0{n}-05 00:00:00") for n in (1, 2)]
    event_store.write_events(events(spark, old), path)
    assert event_store.append_once(events(spark, [*old, event("1", "T", "invoice_paid", "2024-05-05 00:00:00")]), path).conflicts == 1
    event_store.write_events(events(spark, [event("9", "T", "invoice_paid", "2024-01-05 00:00:00")]), path)  # replaced, index too
    done = event_store.append_once(events(spark, [*old, event("9", "T", "invoice_paid", "2024-01-05 00:00:00")]), path)
    assert (done.stored, done.copies, done.conflicts) == (2, 1, 0)


def paid(tenant, year, month, amount, n):
    return event(f"{tenant}{year}{month}{n}", tenant, "invoice_paid", f"{year}-{month:02d}-05 00:00:00", amount=amount)


@pytest.mark.parametrize("seed", range(3))
def test_history_equals_the_batch_table_after_any_update(spark, tmp_path, seed):
    draw, path = random.Random(seed), str(tmp_path / "mart")
    months = [(y, m) for y in (2023, 2024) for m in range(1, 13)]
    all_rows = []
    for batch in range(4):  # months come in any order, late ones and second payments of known months included
        rows = [paid(f"T{draw.randrange(9)}", *draw.choice(months), draw.randrange(1000), f"_{batch}_{k}") for k in range(25)]
        all_rows += rows
        enriched = enrich_events(events(spark, all_rows))
        now = monthly_mrr(enriched)
        touched = enrich_events(events(spark, rows)).select("tenant_id", "event_year", "event_month").distinct()
        changed = now.join(touched, ["tenant_id", "event_year", "event_month"], "left_semi").select(*history.MONTHLY)
        history.update(changed, path, slots=4)
        if batch == 2:
            history.update(changed, path, slots=4)
        got = history.read(spark, path)
        assert got.columns == now.columns and sorted(map(repr, got.collect())) == sorted(map(repr, now.collect()))
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan and "Exchange" not in plan


def test_an_update_leaves_other_slots_and_earlier_months_alone(spark, tmp_path):
    path = tmp_path / "mart"
    rows = [paid(f"T{t}", 2024, m, 10 * t + m, "a") for t in range(20) for m in (1, 2, 3)]
    history.update(monthly_mrr(enrich_events(events(spark, rows))).select(*history.MONTHLY), str(path), slots=8)
    before = {str(f) for f in path.rglob("*.parquet")}
    late = monthly_mrr(enrich_events(events(spark, [paid("T3", 2024, 2, 500, "b"), paid("T3", 2024, 2, 32, "a")]))).select(*history.MONTHLY)
    history.update(late, str(path), slots=8)
    kept = before & {str(f) for f in path.rglob("*.parquet")}
    assert len(before) - len(kept) == 1  # one slot was written anew
    got = {r.event_month: (r.mrr, r.prev_mrr, r.cumulative_mrr) for r in history.read(spark, str(path)).filter("tenant_id = 'T3'").collect()}
    assert got == {1: (31, None, 31), 2: (532, 31, 563), 3: (33, 532, 596)}
    history.update(late.limit(0), str(path), slots=8)
