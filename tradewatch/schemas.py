"""Declared schemas of every feed and table; nothing is inferred."""

from __future__ import annotations

from pyspark.sql import types as T

STRING, INT, LONG, DOUBLE = T.StringType(), T.IntegerType(), T.LongType(), T.DoubleType()
TIMESTAMP = T.TimestampType()


def _struct(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in fields.items()])


ORDER = _struct(
    event_type=STRING, order_id=STRING, trader_id=STRING, trader_type=STRING, symbol=STRING,
    side=STRING, price=DOUBLE, quantity=INT, status=STRING, timestamp=STRING,
)

# The cleaning step coerces numbers itself, so it reads them as text.
RAW_ORDER = _struct(
    event_type=STRING, order_id=STRING, trader_id=STRING, trader_type=STRING, symbol=STRING,
    side=STRING, price=STRING, quantity=STRING, status=STRING, timestamp=STRING,
)

TRADE = _struct(
    event_type=STRING, trade_id=STRING, buy_trader_id=STRING, sell_trader_id=STRING,
    symbol=STRING, price=DOUBLE, quantity=INT, timestamp=STRING,
)

RAW_TRADE = _struct(
    event_type=STRING, trade_id=STRING, buy_trader_id=STRING, sell_trader_id=STRING,
    symbol=STRING, price=STRING, quantity=STRING, timestamp=STRING,
)

TICK_MESSAGE = _struct(
    type=STRING,
    data=T.ArrayType(_struct(s=STRING, p=DOUBLE, v=DOUBLE, t=LONG, c=T.ArrayType(STRING))),
)

MARKET_TICK = _struct(
    event_type=STRING, symbol=STRING, price=DOUBLE, volume=DOUBLE, timestamp_ms=LONG,
    timestamp_iso=STRING, conditions=T.ArrayType(STRING), ingested_at=STRING,
)

# Spoofing alerts fill trader_id and the cancel columns, wash alerts the pair and match columns.
ALERT = _struct(
    alert_type=STRING, trader_id=STRING, symbol=STRING, cancel_count=LONG, total_orders=LONG,
    cancel_rate=DOUBLE, match_count=LONG, trader_id_1=STRING, trader_id_2=STRING,
    avg_price_diff_pct=DOUBLE, window_start=TIMESTAMP, window_end=TIMESTAMP,
    detected_at=TIMESTAMP,
)

# Column order of the exported snapshots.
ALERT_CSV = _struct(
    alert_type=STRING, trader_id=STRING, symbol=STRING, cancel_count=LONG, total_orders=LONG,
    cancel_rate=DOUBLE, match_count=LONG, trader_id_1=STRING, trader_id_2=STRING,
    window_start=TIMESTAMP, window_end=TIMESTAMP, detected_at=TIMESTAMP,
)

ORDER_CSV = _struct(
    order_id=STRING, trader_id=STRING, trader_type=STRING, symbol=STRING, side=STRING,
    price=DOUBLE, quantity=INT, status=STRING, timestamp=STRING,
)

LEG_CSV = _struct(
    trade_id=STRING, order_id=STRING, trader_id=STRING, trader_type=STRING, symbol=STRING,
    side=STRING, price=DOUBLE, quantity=INT, timestamp=STRING,
)

ALERT_CASE = _struct(
    alert_id=STRING, alert_type=STRING, severity=STRING, trader_id=STRING, asset=STRING,
    description=STRING, details=STRING, market_context=STRING, detected_at=TIMESTAMP,
    status=STRING, reviewed_by=STRING, reviewed_at=TIMESTAMP, notes=STRING,
)

CASE_REVIEW = _struct(
    alert_id=STRING, status=STRING, reviewed_by=STRING, reviewed_at=TIMESTAMP, notes=STRING,
)
