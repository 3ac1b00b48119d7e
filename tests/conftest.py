import sys
from datetime import datetime, timedelta
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]
sys.path.insert(0, str(ROOT))
sys.path.insert(0, str(ROOT / "tests"))

from tradewatch.session import build_session

SF_DIR = "/root/testdata/sf0.001"
ORDER_DDL = (
    "order_id string, trader_id string, trader_type string, symbol string, side string, "
    "price double, quantity int, status string, event_time timestamp"
)
START = datetime(2024, 1, 1, 21, 34, 0)


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "tests",
        master="local[4]",
        shuffle_partitions=4,
        conf={
            "spark.ui.enabled": "false",
            "spark.sql.warehouse.dir": str(tmp_path_factory.mktemp("warehouse")),
            "spark.checkpoint.dir": str(tmp_path_factory.mktemp("work")),
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def make_orders(spark):
    """Order events from (trader, status, seconds after START, overrides) tuples."""

    def build(*events):
        rows = []
        for number, (trader, status, at, *extra) in enumerate(events):
            row = {
                "order_id": f"o{number}",
                "trader_id": trader,
                "trader_type": "normal",
                "symbol": "AAPL",
                "side": "buy",
                "price": 100.0,
                "quantity": 100,
                "status": status,
                "event_time": START + timedelta(seconds=at),
                **(extra[0] if extra else {}),
            }
            rows.append(tuple(row.values()))
        return spark.createDataFrame(rows, ORDER_DDL)

    return build
