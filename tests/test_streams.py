"""Messages, micro-batches and stateful summaries, driven by staged files."""

from __future__ import annotations

from datetime import datetime
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from storepulse.functions.numbers import exact
from storepulse.schemas import MESSAGE, ORDER_EVENT, SALE_EVENT
from storepulse.sources.streams import parquet_files
from storepulse.streaming import aggregates, batches, messages

NOON = "2024-05-01T12:00:"


def sale(number, category="Hogar", city="Lima", amount=10.0, risk=0.2, stock=50, second=0, **more):
    return {
        "event_id": f"EVT-{number:06d}", "transaction_id": f"TRX-{number:08d}",
        "category": category, "city": city, "total_amount": amount, "risk_score": risk,
        "is_risk": risk is not None and risk >= 0.7, "stock_actual": stock, "stock_minimo": 10,
        "event_timestamp": f"{NOON}{second:02d}", **more,
    }


def stage(spark, folder, rows, schema=SALE_EVENT, texts=()):
    """One file of messages: the rows as JSON, and the texts as they are."""
    frame = spark.createDataFrame(
        [tuple(row.get(name) for name in schema.fieldNames()) for row in rows], schema)
    key = "transaction_id" if schema is SALE_EVENT else "order_id"
    sent = messages.to_messages(frame, schema, key, F.lit(datetime(2024, 5, 1, 12)))
    if texts:
        raw = spark.createDataFrame(
            [(b"raw", text if text is None else text.encode(), datetime(2024, 5, 1, 12)) for text in texts],
            MESSAGE)
        sent = sent.unionByName(raw)
    # Numbered, so that the file source takes the files in the order they were staged.
    number = len(list(Path(folder).glob("*.parquet"))) if Path(folder).exists() else 0
    part = Path(f"{folder}-parts-{number}")
    sent.coalesce(1).write.parquet(str(part))
    Path(folder).mkdir(exist_ok=True)
    (written,) = part.glob("part-*.parquet")
    (Path(folder) / f"{number:03d}.parquet").write_bytes(written.read_bytes())


def parsed(spark, folder, schema=SALE_EVENT):
    return messages.parse_messages(parquet_files(spark, folder, MESSAGE, files_per_batch=1), schema)


def run(spark, folder, out):
    query = batches.start_sales_stream(parsed(spark, folder), out, availableNow=True)
    batches.run_to_end(query)
    return query


def output(spark, folder, out, name):
    frame = parsed(spark, folder)
    schema = (batches.DERIVED[name](frame) if name in batches.DERIVED else frame).schema
    return batches.read_output(spark, out, name, schema)


def bag(frame):
    return sorted((tuple(row) for row in frame.collect()), key=repr)


@pytest.fixture
def folder(scratch):
    return f"{scratch}/in"


@pytest.fixture
def out(scratch):
    return f"{scratch}/out"


# Messages

def at_rest(spark, folder, schema=SALE_EVENT):
    return messages.parse_messages(spark.read.schema(MESSAGE).parquet(folder), schema)


def test_message_round_trip_keeps_every_field(spark, folder):
    row = sale(1, customer_id="CLI-1", product_id="P", customer_name="Ñandú \"x\"",
               product_name="a,b", store="S", quantity=3, unit_price=3.33)
    stage(spark, folder, [row])
    read = at_rest(spark, folder).first()
    assert read["message_key"] == "TRX-00000001"
    assert read["event_timestamp"] == datetime(2024, 5, 1, 12)
    assert {name: read[name] for name in SALE_EVENT.fieldNames() if name != "event_timestamp"} == {
        name: row[name] for name in SALE_EVENT.fieldNames() if name != "event_timestamp"}
    assert read["corrupt_record"] is None
    text = spark.read.schema(MESSAGE).parquet(folder).select(F.col("value").cast("string")).first()[0]
    assert '"Ñandú \\"x\\""' in text


def test_unreadable_messages_stay_as_nulls_and_go_to_the_dead_letters(spark, folder):
    bad_time = '{"event_id": "E2", "event_timestamp": "yesterday"}'
    bad_field = '{"event_id": "E3", "quantity": "many", "total_amount": 5.5}'
    stage(spark, folder, [sale(1)], texts=["{broken", bad_time, bad_field, None])
    events = at_rest(spark, folder)
    by_id = {row["event_id"]: row for row in events.collect() if row["event_id"]}
    assert events.count() == 5
    assert by_id["E2"]["event_timestamp"] is None and by_id["E2"]["corrupt_record"] == bad_time
    assert by_id["E3"]["quantity"] is None and by_id["E3"]["total_amount"] == 5.5
    assert by_id["EVT-000001"]["corrupt_record"] is None
    assert {row["corrupt_record"] for row in messages.dead_letters(events).collect()} == {
        "{broken", bad_time, bad_field, ""}


def test_absurd_numbers_do_not_stop_the_stream(spark, folder, out):
    large = '{"event_id": "E1", "category": "Hogar", "total_amount": 2e13, "risk_score": 0.5}'
    beyond = '{"event_id": "E3", "category": "Ropa", "total_amount": 1e300, "risk_score": 0.5}'
    none = '{"event_id": "E2", "category": "Hogar", "total_amount": NaN, "risk_score": 0.7}'
    stage(spark, folder, [sale(1, risk=0.6)], texts=[large, beyond, none])
    run(spark, folder, out)
    assert bag(output(spark, folder, out, "summary_by_category")) == [
        ("Hogar", 3, 20000000000010.0, 0.6, 0), ("Ropa", 1, None, 0.5, 0)]
    letters = output(spark, folder, out, "dead_letter").collect()
    assert {row["corrupt_record"] for row in letters} == {none, beyond}


def test_amounts_that_no_sum_holds_go_to_the_dead_letters(spark, folder):
    texts = [f'{{"event_id": "E{i}", "total_amount": {x}}}'
             for i, x in enumerate(("9.9e31", "1e32", "-1e32", "1e33", "-9.9e31"))]
    stage(spark, folder, [sale(1)], texts=texts)
    events = at_rest(spark, folder)
    assert {row["corrupt_record"] for row in messages.dead_letters(events).collect()} == set(texts[1:4])
    kept = {row["event_id"]: row["total_amount"] for row in events.collect()}
    assert kept["E0"] == 9.9e31 and kept["E4"] == -9.9e31 and kept["E1"] is None
    # What is not in the dead letters is in the sums.
    total = events.agg(F.sum(exact(F.col("total_amount")))).first()[0]
    assert total == 10


def test_enrichment_fills_defaults(spark):
    sales = spark.createDataFrame(
        [(1, "t1", 1, 1, "Sur", 2, 800.0, datetime(2024, 5, 1)),
         (2, "t2", 9, 9, None, 1, 5.0, datetime(2024, 5, 1))],
        "event_id int, transaction_id string, customer_id int, product_id int, store string, "
        "quantity int, unit_price double, event_time timestamp")
    customers = spark.createDataFrame([(1, "Ana", "Lima")], "customer_id int, customer_name string, city string")
    products = spark.createDataFrame(
        [(1, "Bota", "Calzado", 50, 10)],
        "product_id int, product_name string, category string, stock int, stock_minimum int")
    known, unknown = messages.score_events(
        messages.enrich_events(sales, customers, products)).orderBy("event_id").collect()
    assert (known["city"], known["total_amount"], known["event_timestamp"]) == (
        "Lima", 1600.0, "2024-05-01T00:00:00")
    assert 0.40 <= known["risk_score"] <= 0.75
    assert [unknown[c] for c in ("customer_name", "city", "category", "store", "stock_actual", "stock_minimo")] == [
        messages.UNKNOWN] * 4 + [0, 0]
    assert unknown["risk_score"] >= 0.70 and unknown["is_risk"]


# Micro-batches

@pytest.fixture
def two_batches(spark, folder):
    stage(spark, folder, [sale(1, amount=10.0, risk=0.2), sale(2, amount=5.55, risk=0.31, city="Cusco"),
                          sale(3, "Ropa", risk=0.9)], texts=["{broken"])
    stage(spark, folder, [sale(4, stock=10), sale(5, "Ropa", risk=0.7, amount=None)])


SUMMARY = [
    (None, 1, None, None, 0), ("Hogar", 2, 15.55, 0.26, 0), ("Ropa", 1, 10.0, 0.9, 0),
    ("Hogar", 1, 10.0, 0.2, 1), ("Ropa", 1, None, 0.7, 1),
]


def test_each_batch_writes_its_outputs(spark, two_batches, folder, out):
    query = run(spark, folder, out)
    received = [progress["observedMetrics"]["received"] for progress in query.recentProgress]
    assert [(r["n_events"], r["n_alerts"], r["n_dead_letters"]) for r in received] == [(4, 1, 1), (2, 2, 0)]
    served = batches.served_summary(output(spark, folder, out, "summary_by_category"), "category")
    assert [(r["batch_id"], r["category"]) for r in served.collect()] == [
        (0, "Hogar"), (0, "Ropa"), (0, None), (1, "Hogar"), (1, "Ropa")]
    events = output(spark, folder, out, "events")
    assert {r["batch_id"]: r["count"] for r in events.groupBy("batch_id").count().collect()} == {0: 4, 1: 2}
    stamps = events.groupBy("batch_id").agg(F.countDistinct("processing_timestamp").alias("n"))
    assert {row["n"] for row in stamps.collect()} == {1}
    assert bag(output(spark, folder, out, "summary_by_category")) == sorted(SUMMARY, key=repr)
    assert output(spark, folder, out, "summary_by_city").filter("city = 'Cusco'").count() == 1
    alerts = batches.served_alerts(output(spark, folder, out, "alerts"))
    assert [(r["transaction_id"][-1], r["batch_id"]) for r in alerts.collect()] == [("3", 0), ("5", 1), ("4", 1)]
    assert output(spark, folder, out, "dead_letter").first()["corrupt_record"] == "{broken"


def test_restart_adds_nothing_and_goes_on_with_new_files(spark, two_batches, folder, out):
    run(spark, folder, out)
    run(spark, folder, out)
    assert output(spark, folder, out, "events").count() == 6
    stage(spark, folder, [sale(6)])
    run(spark, folder, out)
    assert output(spark, folder, out, "events").count() == 7
    assert output(spark, folder, out, "summary_by_category").filter("batch_id = 2").count() == 1


def test_replayed_batch_replaces_its_outputs(spark, two_batches, folder, out):
    write = batches.batch_writer(out)
    batch = at_rest(spark, folder)
    for _ in range(2):
        write(batch, 7)
    assert output(spark, folder, out, "events").count() == 6
    assert output(spark, folder, out, "summary_by_category").count() == 3


def test_empty_batch_writes_no_reports(spark, two_batches, folder, out):
    batches.batch_writer(out)(at_rest(spark, folder).filter("false"), 0)
    assert list(Path(out).glob("*/batch_id=*")) == []


def test_batch_without_alerts_writes_none(spark, folder, out):
    stage(spark, folder, [sale(1)])
    stage(spark, folder, [sale(2, risk=0.9)])
    run(spark, folder, out)
    assert [p.name for p in Path(out, "alerts").glob("batch_id=*")] == ["batch_id=1"]
    assert not Path(out, "dead_letter").exists()
    assert output(spark, folder, out, "dead_letter").isEmpty()


def test_output_of_no_stream_fails(spark, folder, out):
    stage(spark, folder, [sale(1)])
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        output(spark, folder, out, "alerts")


def test_waiting_has_an_end(spark, folder, out):
    stage(spark, folder, [sale(1)])
    query = batches.start_sales_stream(parsed(spark, folder), out, processingTime="1 second")
    with pytest.raises(TimeoutError):
        batches.run_to_end(query, 5)
    assert not query.isActive


def test_bounded_run_stops(spark, two_batches, folder, out):
    query = batches.start_sales_stream(parsed(spark, folder), out, ["alerts"], processingTime="1 second")
    batches.run_for(query, 8)
    assert not query.isActive and query.exception() is None
    assert output(spark, folder, out, "events").count() == 6
    assert not Path(out, "summary_by_city").exists()


def test_failed_query_raises(spark, folder, out):
    stage(spark, folder, [sale(1)])

    def fail(batch, batch_id):
        raise RuntimeError("no room")

    query = batches.start(parsed(spark, folder), out, fail, availableNow=True)
    with pytest.raises(Exception, match="no room"):
        batches.run_to_end(query)


# Summaries with state

def updates(spark, out, summary, *keys):
    batches.run_to_end(aggregates.start_updates(summary, out, "updates", availableNow=True))
    return aggregates.latest(batches.read_output(spark, out, "updates", summary.schema), *keys)


def test_windows_do_not_depend_on_batches(spark, folder, out):
    stage(spark, folder, [sale(1, second=1, risk=0.2), sale(2, second=9, risk=0.31)])
    stage(spark, folder, [sale(3, second=9, amount=1.0, risk=0.31), sale(4, second=10)])
    summary = aggregates.windowed_summary(parsed(spark, folder))
    found = updates(spark, out, summary, "window_start", "window_end", "category")
    noon = datetime(2024, 5, 1, 12)
    assert bag(found) == [
        (noon, noon.replace(second=10), "Hogar", 3, 21.0, 0.27),
        (noon.replace(second=10), noon.replace(second=20), "Hogar", 1, 10.0, 0.2),
    ]


def test_too_late_events_are_dropped(spark, folder, out):
    stage(spark, folder, [sale(1, second=50)])
    stage(spark, folder, [sale(2, second=55)])
    stage(spark, folder, [sale(3, second=1)])
    summary = aggregates.windowed_summary(parsed(spark, folder), "10 seconds", "20 seconds")
    assert updates(spark, out, summary, "window_start", "window_end", "category").count() == 1


def order(number, kind, district="Lima", **more):
    return {"event_id": f"E{number}", "order_id": f"O{number}", "event_type": kind,
            "district": district, "event_timestamp": f"{NOON}00", **more}


def test_running_totals_go_on_over_batches(spark, folder, out):
    stage(spark, folder, [order(1, "placed", total_amount=1.1), order(2, "placed", "Cusco", total_amount=2.0),
                          order(3, "cancelled", total_amount=9.0)], ORDER_EVENT)
    stage(spark, folder, [order(4, "placed", total_amount=2.2)], ORDER_EVENT)
    totals = aggregates.running_totals(parsed(spark, folder, ORDER_EVENT))
    assert bag(updates(spark, out, totals, "district")) == [("Cusco", 1, 2.0), ("Lima", 2, 3.3)]


def test_cancellations_and_delays(spark, folder, out, scratch):
    stage(spark, folder, [order(1, "cancelled", cancel_reason="stock"), order(2, "placed", cancel_reason="stock"),
                          order(3, "delayed", delay_minutes=30.0), order(4, "delayed", delay_minutes=30.5)], ORDER_EVENT)
    stage(spark, folder, [order(5, "cancelled", cancel_reason="stock")], ORDER_EVENT)
    events = parsed(spark, folder, ORDER_EVENT)
    assert bag(updates(spark, out, aggregates.cancellations_by_reason(events), "cancel_reason")) == [("stock", 2)]
    late = aggregates.delay_alerts(events)
    other = f"{scratch}/late"
    batches.run_to_end(batches.start(late, other, aggregates.update_writer(other, "late"), availableNow=True))
    assert [r["order_id"] for r in batches.read_output(spark, other, "late", late.schema).collect()] == ["O4"]


def test_low_rating_alert_ends_when_the_mean_recovers(spark, folder, out):
    def rated(number, courier, rating):
        return order(number, "delivered", courier_id=courier, rating=rating)

    stage(spark, folder, [rated(1, "a", 2.0), rated(2, "b", 2.0), rated(3, "c", 2.5)], ORDER_EVENT)
    first = aggregates.ratings_by_courier(parsed(spark, folder, ORDER_EVENT))
    assert bag(aggregates.low_ratings(updates(spark, out, first, "courier_id"))) == [("a", 1, 2.0), ("b", 1, 2.0)]
    stage(spark, folder, [rated(4, "a", 5.0), rated(5, "b", 2.9)], ORDER_EVENT)
    again = aggregates.ratings_by_courier(parsed(spark, folder, ORDER_EVENT))
    assert bag(aggregates.low_ratings(updates(spark, out, again, "courier_id"))) == [("b", 2, 2.45)]
