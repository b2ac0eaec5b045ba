import json
import os

import pytest
from pyspark.sql import functions as F

from recurra.operators.revenue import monthly_mrr
from recurra.operators.validation import enrich_events, split_events
from recurra.sources import event_store
from recurra.streaming import daily, jobs, messages


def message(n, date, kind="invoice_paid", tenant="T1", amount=100, **more):
    body = {
        "event_id": f"EVT_{n}", "tenant_id": tenant, "event_type": kind, "plan": "growth", "amount": amount,
        "currency": "INR", "event_date": date, "status": "success", **more,
    }
    return json.dumps(body)


@pytest.fixture
def topic(tmp_path):
    """A folder of message files, delivered in the order they are added."""
    folder = tmp_path / "topic"
    folder.mkdir()

    def deliver(name, lines):
        file = folder / f"{name}.txt"
        file.write_text("\n".join(lines) + "\n")
        stamp = 1_700_000_000 + 100 * len(list(folder.iterdir()))
        os.utime(file, (stamp, stamp))

    deliver.path = str(folder)
    return deliver


def decoded(spark, topic, max_files=None):
    return messages.decode_messages(messages.read_message_files(spark, topic.path, max_files))


def clean(spark, topic, max_files=None):
    return split_events(decoded(spark, topic, max_files))[0].drop("raw_message")


def run(writer, checkpoint):
    query = jobs.start(writer, str(checkpoint))
    query.awaitTermination()
    return query


def to_folder(df, folder):
    return df.writeStream.format("parquet").option("path", str(folder))


def test_ingest_splits_like_the_batch_job(spark, topic, tmp_path):
    topic("a", [
        message(1, "2024-01-01T00:00:07.179575"),
        message(2, "2024-01-01T00:00:08"),
        message(3, "2024-01-01T00:00:08", tenant=None),
        message(4, "2024-01-01T00:00:08", kind="nonsense"),
        message(5, "2024-01-01T00:00:08", amount=-1),
        message(6, "yesterday"),
        message(7, "2024-01-02T00:00:08", amount="many"),
        '{"event_id": "EVT_8", "tenant',
    ])
    path = str(tmp_path / "out")
    run(jobs.ingest(decoded(spark, topic), path), tmp_path / "c")
    rows = {r.event_id: r for r in event_store.read_clean(spark, path).collect()}
    # An amount that is no number is NULL, and a NULL amount passes.
    assert set(rows) == {"EVT_1", "EVT_2", "EVT_7"}
    assert rows["EVT_1"].event_date.microsecond == 179575 and rows["EVT_1"].event_month == 1
    assert rows["EVT_7"].amount is None and rows["EVT_1"].seats is None
    errors = {r.validation_error: r.raw_message for r in event_store.read_rejected(spark, path).collect()}
    assert set(errors) == {"missing event_id", "missing tenant_id", "invalid event_type", "negative amount", "null event_date"}
    assert errors["missing event_id"].startswith('{"event_id": "EVT_8"')


def test_redelivery_within_and_across_batches(spark, topic, tmp_path):
    topic("a", [message(1, "2024-01-01T00:00:01"), message(1, "2024-01-01T00:00:01"), message(2, "2024-01-01T00:10:00")])
    topic("b", [message(1, "2024-01-01T00:00:01"), message(3, "2024-03-01T01:00:00")])
    topic("c", [message(3, "2024-03-01T01:00:00"), message(2, "2024-01-01T00:10:00")])
    path = str(tmp_path / "out")
    run(jobs.ingest(decoded(spark, topic, 1), path), tmp_path / "c")
    assert sorted(r.event_id for r in event_store.read_clean(spark, path).collect()) == ["EVT_1", "EVT_2", "EVT_3"]


def test_late_first_deliveries_are_stored(spark, topic, tmp_path):
    topic("a", [message(1, "2030-01-10T00:00:00")])  # a date far ahead
    for n in range(2, 5):
        topic(f"b{n}", [message(n, f"2024-01-{12 - n:02d}T00:00:00"), message(1, "2030-01-10T00:00:00")])
    path = str(tmp_path / "out")
    run(jobs.ingest(decoded(spark, topic, 1), path), tmp_path / "c")
    assert sorted(r.event_id for r in event_store.read_clean(spark, path).collect()) == [f"EVT_{n}" for n in range(1, 5)]


def test_late_rows_are_dropped_from_the_third_batch_on(spark, topic, tmp_path):
    topic("a", [message(1, "2024-01-10T00:00:00")])
    topic("b", [message(2, "2024-01-01T00:00:00")])  # late, but the watermark has not moved yet
    topic("c", [message(3, "2024-01-01T00:00:00")])  # late for good
    topic("d", [message(4, "2024-02-01T00:00:00")])
    run(to_folder(jobs.daily_counts(clean(spark, topic, 1)), tmp_path / "out"), tmp_path / "c")
    got = {str(r.day): r.events for r in spark.read.parquet(str(tmp_path / "out")).collect()}
    assert got == {"2024-01-01": 1, "2024-01-10": 1}


def test_late_rows_are_kept_and_counts_reconcile(spark, topic, tmp_path):
    topic("a", [message(1, "2024-01-01T05:00:00"), message(2, "2024-01-02T00:00:00")])
    topic("b", [message(3, "2024-01-10T05:00:00"), message(4, "2024-01-01T23:00:00")])  # closed by nothing before this batch
    topic("c", [message(5, "2024-01-01T06:00:00"), message(6, "2024-01-08T23:59:59"), message(7, "2024-01-09T00:00:00")])
    topic("d", [message(8, "2024-01-12T00:00:00", kind="subscription_cancelled"), message(9, "2024-01-01T06:00:00")])
    stream, path = clean(spark, topic, 1), str(tmp_path / "days")
    run(daily.count_days(stream, path), tmp_path / "c")
    got = {str(r.day): (r.on_time, r.late, r.events) for r in daily.closed_days(spark, path).collect()}
    assert got == {
        "2024-01-01": (2, 2, 4), "2024-01-02": (1, 0, 1), "2024-01-08": (0, 1, 1), "2024-01-09": (1, 0, 1), "2024-01-10": (1, 0, 1),
    }
    late = {(r.event_id, str(r.day), r.batch) for r in daily.late_rows(spark, path, stream.schema).collect()}
    assert late == {("EVT_5", "2024-01-01", 2), ("EVT_6", "2024-01-08", 2), ("EVT_9", "2024-01-01", 3)}


def test_a_replayed_batch_of_daily_counts_changes_nothing(spark, topic, tmp_path):
    topic("a", [message(1, "2024-01-01T05:00:00"), message(2, "2024-01-20T00:00:00")])
    topic("b", [message(3, "2024-01-01T05:00:00"), message(4, "2024-01-20T00:00:00")])
    stream, path = clean(spark, topic, 1), str(tmp_path / "days")
    run(daily.count_days(stream, path), tmp_path / "c")
    before = sorted(map(tuple, daily.closed_days(spark, path).collect()))
    last = tmp_path / "c" / "commits" / "1"
    os.replace(last, tmp_path / "uncommitted")  # as if the second batch had never been committed
    os.replace(tmp_path / "c" / "commits" / ".1.crc", tmp_path / "uncommitted.crc")
    run(daily.count_days(clean(spark, topic, 1), path), tmp_path / "c")
    assert sorted(map(tuple, daily.closed_days(spark, path).collect())) == before
    assert before[0][2:] == (1, 1, 2) and daily.late_rows(spark, path, stream.schema).count() == 1


def test_days_without_a_stream(spark, tmp_path):
    assert daily.closed_days(spark, str(tmp_path / "none")).count() == 0


def test_running_totals_equal_the_batch_job(spark, topic, tmp_path):
    for batch in range(3):
        topic(f"f{batch}", [
            message(f"{batch}{n}", f"2024-{1 + n % 3:02d}-05T00:00:00", tenant=f"T{n % 4}", amount=n * 10 + batch)
            for n in range(24)
        ])
    topic("again", [message("10", "2024-01-05T00:00:00", tenant="T0", amount=999)])  # an id that is stored already
    path = str(tmp_path / "events")
    run(jobs.ingest(decoded(spark, topic, 1), path), tmp_path / "c")
    run(jobs.ingest(decoded(spark, topic), path), tmp_path / "d")  # everything again, in one batch
    streamed = {(r.tenant_id, r.event_month): r.mrr for r in jobs.running_mrr(spark, path).collect()}
    batch = messages.decode_messages(spark.read.text(topic.path)).filter("event_id != 'EVT_10' OR amount != 999")
    want = monthly_mrr(enrich_events(split_events(batch)[0])).collect()
    assert streamed == {(r.tenant_id, r.event_month): r.mrr for r in want}


def test_mart_refresh_over_other_cuts_and_added_files(spark, topic, tmp_path):
    topic("a", [message(1, "2024-01-05T00:00:00"), message(2, "2024-02-05T00:00:00")])
    topic("b", [message(3, "2024-02-06T00:00:00", amount=50), message(4, "2024-03-06T00:00:00"), message(1, "2024-01-05T00:00:00")])
    store, mart = str(tmp_path / "events"), str(tmp_path / "mart")
    for attempt, files in enumerate((1, None, 1)):  # new checkpoints replay every batch, cut in other ways
        run(jobs.refresh_marts(decoded(spark, topic, files), store, mart), tmp_path / f"c{attempt}")
        got = {r.event_month: r.mrr for r in jobs.read_mart(spark, mart).collect()}
        assert got == {1: 100, 2: 150, 3: 100}
    topic("c", [message(5, "2024-01-09T00:00:00", amount=7)])
    run(jobs.refresh_marts(decoded(spark, topic, 2), store, mart), tmp_path / "more")
    batch = messages.decode_messages(spark.read.text(topic.path)).dropDuplicates(["event_id"])
    want = monthly_mrr(enrich_events(split_events(batch)[0]))
    got = jobs.read_mart(spark, mart).select(*want.columns)
    assert sorted(got.collect()) == sorted(want.collect()) and got.columns == want.columns


def test_message_text_round_trip(spark):
    df = spark.createDataFrame([("E", "T", "invoice_paid", "growth", 5, "INR", "2024-01-01T00:00:00.000001", "success")],
                               "event_id string, tenant_id string, event_type string, plan string, amount int, currency string, event_date string, status string")
    back = messages.decode_messages(df.select(messages.message_text().alias("value"))).first()
    assert (back.event_id, back.amount, back.event_date.microsecond, back.raw_message) == ("E", 5, 1, None)
    assert messages.decode_messages(df.select(F.lit("[]").alias("value"))).first().event_id is None
