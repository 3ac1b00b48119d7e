import json

from test_streaming import order, spoof_burst, wash_burst

from tradewatch.jobs import main
from tradewatch.params import ExportParams, LakeParams, SpoofingParams, WashParams
from tradewatch.sources.messages import parse_alerts
from tradewatch.streaming.lake import Lake


def write_lines(path, *events):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text("".join(json.dumps(e) + "\n" for e in events))


def test_parameters_come_from_the_environment():
    env = {"WINDOW_SIZE_MIN": "3", "WINDOW_SLIDE_SEC": "60", "MIN_CANCEL_COUNT": "5", "MIN_CANCEL_RATE": "0.5"}
    assert SpoofingParams.from_env(env) == SpoofingParams(180, 60, 5, 0.5)
    env = {"MATCH_WINDOW_SEC": "10", "MAX_PRICE_DIFF_PCT": "1", "MAX_QTY_DIFF_PCT": "20"}
    assert WashParams.from_env(env) == WashParams(300, 10, 3, 1.0, 20.0)
    assert WashParams.from_env({}).price_tolerance == 0.005
    assert LakeParams.from_env({}) == LakeParams(60, 300, None)
    assert LakeParams.from_env({"LOOKBACK_HOURS": "24"}).lookback_hours == 24
    assert ExportParams().alert_limit is None


def test_detector_jobs_write_alert_messages(spark, tmp_path):
    write_lines(tmp_path / "in" / "a.json", *spoof_burst(), *wash_burst(), order("z", "NEW", 7200))
    for job, expected in (("spoofing", 4), ("wash", 1)):
        folders = {name: str(tmp_path / f"{job}-{name}") for name in ("out", "checkpoint")}
        main(
            [job, "--folder", str(tmp_path / "in"), "--out", folders["out"],
             "--checkpoint", folders["checkpoint"], "--once"],
            spark,
        )
        alerts = parse_alerts(spark.read.text(folders["out"]))
        assert alerts.count() == expected
        assert alerts.where("detected_at is null").count() == 0


def test_lake_jobs_from_landing_to_catalog(spark, tmp_path):
    lake = Lake(str(tmp_path / "lake"))
    trade = {"trade_id": "1", "buy_trader_id": "a", "sell_trader_id": "market", "symbol": "S", "price": 1.5, "quantity": 3, "timestamp": "2024-01-01T10:00:00+00:00"}
    alert = {"alert_type": "SPOOFING", "trader_id": "s", "symbol": "S", "cancel_rate": 0.9, "detected_at": "2024-01-01 10:00:00"}
    for topic, events in (("orders", spoof_burst()), ("trades", [trade]), ("alerts", [alert])):
        write_lines(tmp_path / "lake" / "bronze" / f"topic={topic}" / "date=2024-01-01" / "hour=10" / "a.txt", *events)
    base = ["--lake", lake.root]
    main(["orders", *base, "--once"], spark)
    main(["order-index", *base, "--once"], spark)
    main(["trades", *base, "--once"], spark)
    main(["alert-gold", *base, "--date", "2024-01-01"], spark)
    main(["rebuild", *base], spark)
    assert spark.read.parquet(lake.gold("trader_daily_activity")).first().total_cancels == 12
    assert spark.read.parquet(lake.gold("alert_summary")).first().total_alerts == 1
    main(["snapshots", *base, "--out", str(tmp_path / "csv")], spark)
    main(["catalog", "--folder", str(tmp_path / "csv"), "--prefix", "jobs_test_", "--location", str(tmp_path / "db")], spark)
    counts = {n: spark.table(f"jobs_test_bronze.{n}").count() for n in ("alerts", "orders", "trades")}
    assert counts == {"alerts": 1, "orders": 12, "trades": 2}
    assert spark.table("jobs_test_gold.trader_risk_summary").first().trader_id == "s"


def test_landing_job(spark, tmp_path):
    write_lines(tmp_path / "in" / "a.json", *spoof_burst())
    main(["landing", "--folder", str(tmp_path / "in"), "--topics", "orders", "--lake", str(tmp_path / "lake"), "--once"], spark)
    assert spark.read.text(str(tmp_path / "lake" / "bronze")).count() == 12


def test_priced_orders_job(spark, tmp_path):
    lake = Lake(str(tmp_path / "lake"))
    stamp = 1704144600000  # the time of orders at second 0
    prints = [{"event_type": "market_tick", "symbol": "AAPL", "price": p, "timestamp_ms": stamp + ms} for p, ms in ((1.5, 0), (2.5, 9000), (3.5, 60_000))]
    feeds = {
        "orders": [order("t", "NEW", 10, order_id="1"), order("t", "NEW", 60, order_id="2")],
        "market-data-stocks": prints,
        "market-data-crypto": [{**prints[2], "symbol": "BINANCE:BTCUSDT"}],
    }
    for topic, events in feeds.items():
        write_lines(tmp_path / "lake" / "bronze" / f"topic={topic}" / "date=2024-01-01" / "hour=10" / "a.txt", *events)
    main(["priced-orders", "--lake", lake.root, "--once"], spark)
    rows = spark.read.parquet(lake.folder("prices", "orders")).collect()
    assert [(r.order_id, r.tick_ms, r.last_price) for r in rows] == [("1", stamp + 9000, 2.5)]
