from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tradewatch import schemas
from tradewatch.operators import cases, serving
from tradewatch.operators.alerts import alert_digest, all_alerts
from tradewatch.operators.lake_gold import alert_summary
from tradewatch.params import ServingParams

AT = datetime(2024, 1, 1, 9, 0, 0)


@pytest.fixture
def alerts(spark):
    def build(*rows):
        full = []
        for number, row in enumerate(rows):
            at = AT + timedelta(minutes=number)
            base = {"symbol": "AAPL", "window_start": at, "window_end": at, "detected_at": at, **row}
            full.append(tuple(base.get(f.name) for f in schemas.ALERT))
        return spark.createDataFrame(full, schemas.ALERT)

    return build


def spoof(trader="s", rate=0.9, **extra):
    return {"alert_type": "SPOOFING", "trader_id": trader, "cancel_rate": rate, "cancel_count": 11, "total_orders": 12, **extra}


def wash(one="a", two="b", **extra):
    return {"alert_type": "WASH_TRADING", "trader_id_1": one, "trader_id_2": two, "match_count": 3, "avg_price_diff_pct": 0.0625, **extra}


def test_severity(alerts):
    rows = [spoof(rate=r) for r in (0.95, 0.9499, 0.85, 0.8499, None)] + [wash()]
    graded = serving.with_severity(alerts(*rows)).orderBy("detected_at").collect()
    assert [r.severity for r in graded] == ["HIGH", "MEDIUM", "MEDIUM", "LOW", "LOW", "HIGH"]


def test_kpis(alerts):
    (row,) = serving.alert_kpis(alerts(spoof("a"), wash("a", "b"), wash("b", "c"), spoof(None))).collect()
    assert tuple(row) == (4, 2, 2, 3)
    (empty,) = serving.alert_kpis(alerts()).collect()
    assert tuple(empty) == (0, 0, 0, 0)


def test_feed_filters_and_limit(alerts):
    df = alerts(spoof(rate=0.99), spoof(rate=0.99, symbol="TSLA"), spoof(rate=0.8), wash())
    assert serving.alert_feed(df).count() == 4
    assert serving.alert_feed(df, level="HIGH").count() == 3
    assert serving.alert_feed(df, "SPOOFING", "HIGH", "TSLA").count() == 1
    (newest,) = serving.alert_feed(df, params=ServingParams(feed_limit=1)).collect()
    assert newest.alert_type == "WASH_TRADING"


def test_formats(alerts):
    rows = serving.formatted(serving.alert_feed(alerts(spoof(rate=0.8125), wash()))).collect()
    shown = {r.alert_type: (r.detected_at, r.cancel_rate, r.avg_price_diff_pct) for r in rows}
    assert shown == {"SPOOFING": ("09:00:00", "81.2%", "—"), "WASH_TRADING": ("09:01:00", "—", "0.062%")}


def test_high_risk_traders(alerts):
    df = alerts(spoof("x", 0.9), spoof("x", 1.0), wash("x", "y"), wash("y", "z"))
    rows = serving.high_risk_traders(df).collect()
    assert [(r.trader_id, r.alert_count, r.alert_types) for r in rows] == [
        ("x", 3, "SPOOFING + WASH_TRADING"), ("y", 2, "WASH_TRADING"), ("z", 1, "WASH_TRADING"),
    ]
    assert rows[0].avg_cancel_rate == pytest.approx(0.95) and rows[1].avg_cancel_rate is None
    shown = serving.high_risk_traders_formatted(df).collect()
    assert [r.avg_cancel_rate for r in shown] == ["95.0%", "—", "—"]
    assert serving.high_risk_traders(df, ServingParams(top_traders=1)).count() == 1


def test_drilldown_finds_every_role(alerts):
    df = alerts(spoof("x"), wash("x", "y"), wash("y", "x"), wash("y", "z"))
    assert serving.trader_alert_drilldown(df, "x").count() == 3


def test_options(alerts):
    rows = serving.alert_filter_options(alerts(spoof("x"), wash("x", "y"))).collect()
    assert [tuple(r) for r in rows] == [
        ("alert_type", "SPOOFING"), ("alert_type", "WASH_TRADING"), ("symbol", "AAPL"),
        ("trader", "x"), ("trader", "y"),
    ]


def test_activity_lookup_keeps_traders_without_activity(alerts, spark):
    activity = spark.createDataFrame([("x", "2024-01-01", 5)], "trader_id string, date string, total_orders bigint")
    rows = serving.trader_activity_lookup(alerts(spoof("x"), wash("x", "y")), activity).collect()
    assert sorted((r.trader_id, r.total_orders) for r in rows) == [("x", 5), ("y", None)]


def test_activity_cards(spark):
    ddl = (
        "trader_id string, date string, symbol string, total_orders bigint, total_cancels bigint, "
        "cancel_rate double, total_trades bigint, avg_order_size double, avg_time_to_cancel double"
    )
    rows = [("t", "d", "S", 1234, 10, 0.0081, 3, 12.25, 2.5), ("t", "d", "U", 1, 0, None, 0, None, None)]
    shown = [tuple(r)[3:] for r in serving.activity_cards(spark.createDataFrame(rows, ddl)).collect()]
    assert shown == [("1,234", "10", "0.8%", "3", "12.2", "2s"), ("1", "0", "—", "0", "—", "—")]


def test_case_ids_are_repeatable_and_distinct(alerts):
    df = alerts(spoof("x"), spoof("x"), wash("x", "y"))
    first, again = (sorted(cases.alert_case_rows(df).collect(), key=str) for _ in range(2))
    assert first == again
    assert len({r.alert_id for r in first}) == 3
    assert {r.status for r in first} == {"open"} and all(len(r.alert_id) == 36 for r in first)
    texts = {r.description for r in first}
    assert texts == {
        "x cancelled 11 of 12 completed orders in AAPL",
        "x and y matched 3 opposite fills in AAPL",
    }


def test_profiles_and_scorecard(alerts, spark):
    profiles = spark.createDataFrame([("x", "Mr X", "retail", "normal")], "trader_id string, trader_name string, trader_type string, risk_rating string")
    rows = cases.alerts_with_profile(alerts(spoof("x"), wash("x", "y")), profiles).collect()
    assert sorted((r.trader_id, r.trader_name) for r in rows) == [("x", "Mr X"), ("x", "Mr X"), ("y", None)]
    orders = spark.createDataFrame(
        [("x", "spoofer"), ("y", "normal"), ("z", "spoofer"), ("x", "spoofer")],
        "trader_id string, trader_type string",
    )
    card = {r.alert_type: r for r in cases.detection_scorecard(alerts(spoof("x"), spoof("y")), orders).collect()}
    s = card["SPOOFING"]
    assert (s.true_positives, s.false_positives, s.false_negatives, s.true_negatives) == (1, 1, 1, 0)
    assert (s.precision, s.recall) == (0.5, 0.5)
    assert card["WASH_TRADING"].precision is None


def test_display_orders(spark):
    risk = spark.createDataFrame([("a", 1), ("b", 3), ("c", 3)], "trader_id string, total_alerts bigint")
    assert [r.trader_id for r in serving.ranked_risk(risk).collect()] == ["b", "c", "a"]
    assets = spark.createDataFrame([("A", "x", 1), ("B", "x", 2)], "symbol string, alert_type string, alert_count bigint")
    assert [r.symbol for r in serving.ranked_assets(assets).collect()] == ["B", "A"]
    days = spark.createDataFrame([("2024-01-01", "x"), ("2024-01-02", "y"), ("2024-01-02", "x")], "alert_date string, alert_type string")
    assert [tuple(r) for r in serving.newest_days(days).collect()] == [("2024-01-02", "x"), ("2024-01-02", "y"), ("2024-01-01", "x")]


def test_case_states(spark, alerts):
    """Replays change nothing, a review survives them, and a detection after its end reopens a case."""
    first = cases.alert_case_rows(alerts(spoof("a"), spoof("b"), spoof("c"), spoof("d")))
    ids = {r.trader_id: r.alert_id for r in first.collect()}
    later = first.where("trader_id in ('b', 'c')").selectExpr(
        *[c if c != "detected_at" else "detected_at + interval 3 hours as detected_at" for c in first.columns]
    )
    at = AT + timedelta(hours=1)
    reviews = spark.createDataFrame(
        [
            (ids["a"], "resolved", "x", at, "n"), (ids["b"], "dismissed", "x", at, None), (ids["c"], "reviewing", "y", at, None),
            (ids["a"], "reviewing", "y", AT, "old"), ("unknown", "resolved", "x", at, None), (None, "resolved", "x", at, None),
        ],
        schemas.CASE_REVIEW,
    )
    once = cases.current_cases(first.unionByName(later), reviews)
    state = {r.trader_id: (r.status, r.reviewed_by, r.notes) for r in once.collect()}
    assert state == {"a": ("resolved", "x", "n"), "b": ("reopened", "x", None), "c": ("reviewing", "y", None), "d": ("open", None, None)}
    again = cases.current_cases(first.unionByName(later).unionByName(first), reviews.unionByName(reviews))
    assert sorted(map(str, again.collect())) == sorted(map(str, once.collect()))
    assert cases.current_cases(first, reviews.limit(0)).where("status = 'open'").count() == 4


def test_digest_rows_count_as_their_alerts(make_orders):
    legs = [(f"T{n}", "FILLED", 3 * n + k, {"side": side}) for n in range(6) for k, side in enumerate(("buy", "buy", "sell", "sell"))]
    orders = make_orders(*legs, *[("s", "CANCELLED", k) for k in range(12)])
    views = (
        serving.alert_kpis, serving.alert_filter_options, serving.asset_risk_counts, serving.alert_hourly_volume,
        alert_summary,
    )
    folded, plain = (find(orders, detected_at=F.col("window_end")) for find in (alert_digest, all_alerts))
    assert plain.count() > folded.count()
    for view in views:
        assert sorted(view(folded).collect()) == sorted(view(plain).collect())
