import json

import pytest
from pyspark.sql import functions as F

from tradewatch import schemas
from tradewatch.operators.alerts import alert_messages, conform
from tradewatch.sources.messages import malformed_orders, parse_alerts, parse_messages, parse_orders


def order(**fields):
    base = {
        "event_type": "order", "order_id": "o1", "trader_id": "t1", "trader_type": "normal",
        "symbol": "AAPL", "side": "buy", "price": 100.25, "quantity": 7, "status": "NEW",
        "timestamp": "2024-01-01T10:00:02.999999+00:00",
    }
    return json.dumps({**base, **fields})


@pytest.fixture
def lines(spark):
    def build(*values):
        return spark.createDataFrame([("orders", v) for v in values], "topic string, value string")

    return build


def test_event_time_is_cut_to_the_second(lines):
    (row,) = parse_orders(lines(order())).collect()
    assert str(row.event_time) == "2024-01-01 10:00:02"
    assert (row.price, row.quantity) == (100.25, 7)


def test_offset_is_ignored(lines):
    (row,) = parse_orders(lines(order(timestamp="2024-01-01T10:00:02.5-05:00"))).collect()
    assert str(row.event_time) == "2024-01-01 10:00:02"


def test_bad_json_is_skipped_and_quarantined(lines):
    raw = lines("{bad json", "", "null", order())
    assert parse_orders(raw).count() == 1
    reasons = [r.reason for r in malformed_orders(raw).collect()]
    assert reasons == ["unparsable message"] * 3


def test_bad_field_is_null_and_the_row_stays(lines):
    raw = lines(order(price="notnum", quantity="7.9"))
    (row,) = parse_orders(raw).collect()
    assert row.price is None and row.quantity is None and row.order_id == "o1"
    assert malformed_orders(raw).count() == 0


def test_numbers_given_as_text_are_read(lines):
    (row,) = parse_orders(lines(order(price="99.5", quantity="12"))).collect()
    assert (row.price, row.quantity) == (99.5, 12)


def test_bad_time_is_quarantined(lines):
    raw = lines(order(timestamp="garbage"))
    assert parse_orders(raw).first().event_time is None
    assert malformed_orders(raw).first().reason == "unparsable event time"


def test_alert_message_round_trip(spark):
    rows = [("SPOOFING", "t", "AAPL", 11, 12, 11 / 12), ("SPOOFING", "u", "TSLA", 20, 20, 1.0)]
    ddl = "alert_type string, trader_id string, symbol string, cancel_count bigint, total_orders bigint, cancel_rate double"
    alerts = conform(spark.createDataFrame(rows, ddl)).withColumn(
        "window_start", F.lit("2024-01-01 10:00:00").cast("timestamp")
    )
    sent = alert_messages(alerts)
    assert {r.key for r in sent.collect()} == {"AAPL", "TSLA"}
    assert sorted(parse_alerts(sent).collect(), key=str) == sorted(alerts.collect(), key=str)


def test_alert_times_in_sql_format_are_read(lines):
    text = '{"alert_type":"SPOOFING","window_start":"2024-01-01 10:00:00.000","detected_at":"2024-01-01 10:02:00"}'
    row = parse_alerts(lines(text)).first()
    assert str(row.window_start) == "2024-01-01 10:00:00" and str(row.detected_at) == "2024-01-01 10:02:00"


def test_raw_numbers_stay_text(lines):
    row = parse_messages(lines(order(quantity="7.9")), schemas.RAW_ORDER).first()
    assert (row.price, row.quantity) == ("100.25", "7.9")
