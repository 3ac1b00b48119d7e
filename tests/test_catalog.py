from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tradewatch import schemas
from tradewatch.operators import catalog
from tradewatch.operators.alerts import conform
from tradewatch.sources.lake import read_csv
from tradewatch.streaming.catalog import rebuild_catalog, write_snapshots

AT = datetime(2024, 1, 1, 10, 0, 0)


def spoof(trader, symbol="aapl", at=0, rate=0.9, cancels=11):
    return {
        "alert_type": "SPOOFING", "trader_id": trader, "symbol": symbol, "cancel_count": cancels,
        "total_orders": 12, "cancel_rate": rate, "at": at,
    }


def wash(one, two, symbol="aapl", at=0):
    return {
        "alert_type": "WASH_TRADING", "trader_id_1": one, "trader_id_2": two, "symbol": symbol,
        "match_count": 4, "at": at,
    }


@pytest.fixture
def bronze(spark):
    def build(*alerts):
        rows = []
        for alert in alerts:
            start = AT + timedelta(seconds=alert.pop("at"))
            end = start + timedelta(seconds=120)
            rows.append({"window_start": start, "window_end": end, "detected_at": end, **alert})
        filled = [tuple(r.get(f.name) for f in schemas.ALERT_CSV) for r in rows]
        return spark.createDataFrame(filled, schemas.ALERT_CSV)

    return build


def test_wash_pairs_of_one_window_collapse_unless_keyed_by_pair(bronze):
    alerts = bronze(wash("c", "d"), wash("a", "b"))
    (kept,) = catalog.silver_alerts(alerts).collect()
    assert (kept.trader_id_1, kept.trader_id_2) == ("a", "b")
    assert (kept.alert_type, kept.symbol) == ("wash_trading", "AAPL")
    assert catalog.silver_alerts(alerts, by_pair=True).count() == 2
    assert catalog.silver_alerts_sql(alerts).count() == 0


def test_repeated_firings_collapse_and_overlapping_windows_stay(bronze):
    alerts = bronze(spoof("s"), spoof("s"), spoof("s", at=30))
    assert catalog.silver_alerts(alerts).count() == 2
    assert catalog.silver_alerts_sql(alerts).count() == 3


def test_risk_summary_counts_both_traders_of_a_wash_alert_once(bronze):
    alerts = bronze(wash("a", "b"), spoof("a", symbol="tsla", at=60, rate=0.8, cancels=20))
    found = {r.trader_id: r for r in catalog.trader_risk_summary(alerts).collect()}
    a, b = found["a"], found["b"]
    assert (a.total_alerts, a.distinct_symbols_flagged, a.distinct_alert_types) == (2, 2, 2)
    assert (a.avg_cancel_rate, a.max_cancel_count_in_window) == (0.8, 20)
    assert a.latest_alert_at - a.first_alert_at == timedelta(seconds=60)
    assert (b.total_alerts, b.distinct_symbols_flagged, b.avg_cancel_rate) == (1, 1, None)


def test_daily_metrics_count_a_wash_alert_under_its_first_trader(bronze):
    alerts = bronze(wash("a", "b"), wash("a", "c", symbol="tsla"), spoof("s", at=86_400))
    found = {r.alert_type: r for r in catalog.daily_alert_metrics(alerts).collect()}
    day_one = found["WASH_TRADING"]
    assert (day_one.total_alerts, day_one.unique_traders, day_one.unique_symbols) == (2, 1, 2)
    assert str(found["SPOOFING"].alert_date) == "2024-01-02"


def test_null_audit(bronze):
    found = {r.alert_type: tuple(r)[1:] for r in catalog.alert_null_audit(bronze(wash("a", "b"), spoof("s"))).collect()}
    assert found == {"WASH_TRADING": (1, 0, 1, 1), "SPOOFING": (1, 1, 0, 0)}


def test_trades_keep_the_buy_leg(spark):
    rows = [("1", "", t, "normal", "aapl", s, 1.0, 1, "x") for t, s in (("a", "sell"), ("b", "BUY"))]
    legs = spark.createDataFrame(rows, schemas.LEG_CSV)
    (kept,) = catalog.silver_trades_catalog(legs).collect()
    assert (kept.trader_id, kept.side, kept.symbol) == ("b", "buy", "AAPL")
    assert catalog.silver_trades_distinct(legs).count() == 2


def test_orders_keep_one_row_per_status(spark):
    rows = [("1", "t", "Normal", "aapl", "BUY", 1.0, 1, s, "x") for s in ("NEW", "FILLED", "NEW")]
    orders = spark.createDataFrame(rows, schemas.ORDER_CSV)
    assert {r.status for r in catalog.silver_orders_catalog(orders).collect()} == {"new", "filled"}
    assert catalog.silver_orders_catalog(orders).count() == 2


def test_rebuild_replaces_tables(bronze, spark, tmp_path):
    legs = spark.createDataFrame([("1", "", "a", "normal", "S", "buy", 1.5, 2, "2024-01-01")], schemas.LEG_CSV)
    orders = spark.createDataFrame([("1", "t", "normal", "S", "buy", 1.5, 2, "NEW", "2024-01-01")], schemas.ORDER_CSV)
    for alerts, expected in ((bronze(spoof("s"), wash("a", "b")), 3), (bronze(spoof("s")), 1)):
        write_snapshots(str(tmp_path / "csv"), alerts=alerts, orders=orders, trades=legs)
        built = rebuild_catalog(spark, str(tmp_path / "csv"), "rebuild_test_", str(tmp_path / "db"))
        assert built["gold.trader_risk_summary"].count() == expected
        assert spark.table("rebuild_test_silver.alerts").count() == alerts.count()
    assert built["bronze.alerts"].first().match_count is None
    assert built["bronze.trades"].first().price == 1.5


def test_snapshots_are_compressed_and_read_back_whole(spark, tmp_path):
    rows = [(str(n), "", f"t{n % 3}", None, "AAPL", "buy", n / 7, n, "2024-01-01") for n in range(3000)]
    legs = spark.createDataFrame(rows, schemas.LEG_CSV)
    write_snapshots(str(tmp_path), trades=legs)
    parts = list((tmp_path / "trades").glob("part-*"))
    assert parts and all(part.name.endswith(".csv.gz") for part in parts)
    found = read_csv(spark, str(tmp_path / "trades"), schemas.LEG_CSV)
    assert found.exceptAll(legs.replace("", None, ["order_id"])).isEmpty() and found.count() == 3000


def test_conform_adds_missing_columns(spark):
    df = conform(spark.createDataFrame([("SPOOFING",)], "alert_type string"))
    assert df.schema.fieldNames() == schemas.ALERT.fieldNames()
    assert df.where(F.col("cancel_rate").isNull()).count() == 1
