"""DuckDB SQL that each query must equal, written independently of the Spark code."""

from __future__ import annotations


def _trader(number: str) -> str:
    return (
        f"(CASE WHEN {number} % 10 = 0 THEN 'spoofer_' WHEN {number} % 10 IN (1, 2) THEN 'wash_' "
        f"ELSE 'normal_' END || lpad(CAST({number} AS VARCHAR), 5, '0'))"
    )


def _symbol(index: str) -> str:
    names = "'AAPL','TSLA','JPM','MSFT','GOOGL','BINANCE:BTCUSDT','BINANCE:ETHUSDT','BINANCE:XRPUSDT'"
    return f"([{names}][CAST({index} AS INTEGER) + 1])"


def _r(value: str, digits: int) -> str:
    return f"(CAST(round_even(({value}) * 1e{digits}, 0) AS DOUBLE) / CAST(1e{digits} AS DOUBLE))"


ORDERS = f"""
base AS (
  SELECT event_id, user_id, ts, event_type, date_trunc('second', ts) AS placed,
         CASE WHEN user_id % 10 = 0 THEN 'spoofer'
              WHEN user_id % 10 IN (1, 2) THEN 'wash_trader' ELSE 'normal' END AS trader_type
  FROM events
),
sized AS (
  SELECT *,
         CASE WHEN trader_type = 'normal' THEN (event_id * 31 + user_id) % 8
              ELSE (user_id // 10) % 8 END AS sidx,
         CAST(CASE trader_type WHEN 'spoofer' THEN 2000 + event_id % 500
                   WHEN 'wash_trader' THEN 300 + event_id % 40
                   ELSE 50 + event_id % 400 END AS INTEGER) AS quantity,
         CASE trader_type
              WHEN 'spoofer' THEN CASE WHEN event_id % 10 <> 3 THEN 'CANCELLED' ELSE 'FILLED' END
              WHEN 'wash_trader' THEN 'FILLED'
              ELSE CASE event_type WHEN 'error' THEN 'CANCELLED' WHEN 'signup' THEN NULL
                        ELSE 'FILLED' END END AS term,
         CASE trader_type WHEN 'spoofer' THEN 1 + event_id % 3 WHEN 'wash_trader' THEN 1
              ELSE 10 + event_id % 110 END AS delay_s
  FROM base
),
lifecycle AS (
  SELECT *, 'NEW' AS status, placed AS event_time FROM sized
  UNION ALL
  SELECT *, term AS status, placed + to_seconds(delay_s) AS event_time
  FROM sized WHERE term IS NOT NULL
),
order_feed AS (
  SELECT CAST(event_id AS VARCHAR) AS order_id, {_trader("user_id")} AS trader_id, trader_type,
         {_symbol("sidx")} AS symbol,
         CASE WHEN event_id % 2 = 0 THEN 'buy' ELSE 'sell' END AS side,
         CAST((sidx + 1) * (10000 + (event_id * 37) % 101 - 50) AS DOUBLE)
           / CAST(100 AS DOUBLE) AS price,
         quantity, status, event_time, event_id, ts
  FROM lifecycle
)"""

ALERTS = (
    ORDERS
    + f""",
hop AS (
  SELECT trader_id, symbol, status,
         (epoch_us(event_time) // 1000000 // 43200 - step.i) * 43200 AS start_s
  FROM order_feed, (SELECT unnest(range(4)) AS i) AS step
),
hop_counts AS (
  SELECT trader_id, symbol, start_s,
         CAST(count(*) FILTER (status = 'CANCELLED') AS BIGINT) AS cancel_count,
         CAST(count(*) FILTER (status IN ('CANCELLED', 'FILLED')) AS BIGINT) AS total_orders
  FROM hop GROUP BY trader_id, symbol, start_s
),
cancel_windows AS (
  SELECT trader_id, symbol, cancel_count, total_orders,
         CAST(cancel_count AS DOUBLE) / CAST(total_orders AS DOUBLE) AS cancel_rate,
         make_timestamp(start_s * 1000000) AS window_start,
         make_timestamp((start_s + 172800) * 1000000) AS window_end
  FROM hop_counts WHERE total_orders > 0
),
spoofing AS (
  SELECT 'SPOOFING' AS alert_type, *, window_end AS detected_at
  FROM cancel_windows WHERE cancel_count > 3 AND cancel_rate > 0.8
),
filled AS (
  SELECT *, epoch_us(event_time) // 1000000 AS at_s,
         epoch_us(event_time) // 1000000 // 432000 * 432000 AS start_s
  FROM order_feed WHERE status = 'FILLED'
),
opposed AS (
  SELECT buy.symbol, buy.start_s, buy.order_id AS buy_order_id, sell.order_id AS sell_order_id,
         buy.trader_id AS buy_trader_id, sell.trader_id AS sell_trader_id,
         sell.at_s - buy.at_s AS gap_sec,
         buy.price + sell.price AS price_sum, abs(buy.price - sell.price) AS price_gap,
         CAST(buy.quantity AS DOUBLE) + CAST(sell.quantity AS DOUBLE) AS size_sum,
         abs(CAST(buy.quantity AS DOUBLE) - CAST(sell.quantity AS DOUBLE)) AS size_gap
  FROM (FROM filled WHERE side = 'buy') AS buy
  JOIN (FROM filled WHERE side = 'sell') AS sell USING (symbol, start_s)
  WHERE buy.trader_id <> sell.trader_id
),
deviations AS (
  SELECT *, price_gap / (price_sum / CAST(2 AS DOUBLE)) AS price_off,
         size_gap / (size_sum / CAST(2 AS DOUBLE)) AS size_off
  FROM opposed WHERE abs(gap_sec) <= 43200
),
matches AS (
  SELECT symbol, buy_order_id, sell_order_id, buy_trader_id, sell_trader_id,
         price_off * CAST(100 AS DOUBLE) AS price_diff_pct, gap_sec,
         make_timestamp(start_s * 1000000) AS window_start,
         make_timestamp((start_s + 432000) * 1000000) AS window_end
  FROM deviations
  WHERE price_off <= CAST(0.005 AS DOUBLE) AND size_off <= CAST(0.1 AS DOUBLE)
),
wash AS (
  SELECT 'WASH_TRADING' AS alert_type,
         least(buy_trader_id, sell_trader_id) AS trader_id_1,
         greatest(buy_trader_id, sell_trader_id) AS trader_id_2,
         symbol, count(*) AS match_count,
         {_r("avg(price_diff_pct)", 6)} AS avg_price_diff_pct,
         window_start, window_end, window_end AS detected_at
  FROM matches
  GROUP BY least(buy_trader_id, sell_trader_id), greatest(buy_trader_id, sell_trader_id),
           symbol, window_start, window_end
  HAVING count(*) >= 3
),
all_alerts AS (
  SELECT alert_type, trader_id, symbol, cancel_count, total_orders, cancel_rate,
         CAST(NULL AS BIGINT) AS match_count, CAST(NULL AS VARCHAR) AS trader_id_1,
         CAST(NULL AS VARCHAR) AS trader_id_2, CAST(NULL AS DOUBLE) AS avg_price_diff_pct,
         window_start, window_end, detected_at
  FROM spoofing
  UNION ALL
  SELECT alert_type, NULL, symbol, NULL, NULL, NULL, match_count, trader_id_1, trader_id_2,
         avg_price_diff_pct, window_start, window_end, detected_at
  FROM wash
),
graded AS (
  SELECT *,
         CASE WHEN alert_type = 'WASH_TRADING' THEN 'HIGH'
              WHEN coalesce(cancel_rate, 0) >= 0.95 THEN 'HIGH'
              WHEN coalesce(cancel_rate, 0) >= 0.85 THEN 'MEDIUM' ELSE 'LOW' END AS severity
  FROM all_alerts
),
named AS (
  SELECT alert_type, symbol, trader_id, cancel_rate, cancel_count, detected_at, window_start,
         window_end FROM all_alerts WHERE trader_id IS NOT NULL
  UNION ALL
  SELECT alert_type, symbol, trader_id_1, cancel_rate, cancel_count, detected_at, window_start,
         window_end FROM all_alerts WHERE trader_id_1 IS NOT NULL
  UNION ALL
  SELECT alert_type, symbol, trader_id_2, cancel_rate, cancel_count, detected_at, window_start,
         window_end FROM all_alerts WHERE trader_id_2 IS NOT NULL
)"""
)

BRONZE_ALERTS = (
    ALERTS
    + """,
bronze_alerts AS (
  SELECT a.* EXCLUDE (avg_price_diff_pct)
  FROM all_alerts a, (SELECT unnest(range(2)) AS i) AS again
  WHERE again.i = 0 OR hour(window_end) = 0
),
clean_alerts AS (
  SELECT lower(alert_type) AS alert_type, trader_id, upper(symbol) AS symbol, cancel_count,
         total_orders, cancel_rate, CAST(match_count AS INTEGER) AS match_count, trader_id_1,
         trader_id_2, window_start, window_end, detected_at
  FROM bronze_alerts
),
silver_alerts AS (
  SELECT * FROM clean_alerts
  QUALIFY row_number() OVER (
    PARTITION BY alert_type, trader_id, symbol, window_start, window_end
    ORDER BY trader_id_1 NULLS FIRST, trader_id_2 NULLS FIRST) = 1
),
all_flagged AS (
  SELECT trader_id, symbol, alert_type, cancel_rate, cancel_count, detected_at
  FROM silver_alerts WHERE trader_id IS NOT NULL
  UNION ALL
  SELECT trader_id_1, symbol, alert_type, cancel_rate, cancel_count, detected_at
  FROM silver_alerts WHERE trader_id_1 IS NOT NULL
  UNION ALL
  SELECT trader_id_2, symbol, alert_type, cancel_rate, cancel_count, detected_at
  FROM silver_alerts WHERE trader_id_2 IS NOT NULL
)"""
)

RAW = (
    ORDERS
    + """,
dirty AS (
  SELECT order_id, trader_id, trader_type, symbol, side, status, event_time, event_id,
         CASE WHEN event_id % 107 = 0 THEN NULL
              WHEN event_id % 109 <> 0 AND event_id % 113 <> 0 AND event_id % 127 <> 0
                   AND event_id % 131 = 0 THEN CAST('1e300' AS DOUBLE) ELSE price END AS price,
         CASE WHEN event_id % 107 = 0 THEN quantity WHEN event_id % 109 = 0 THEN NULL
              WHEN event_id % 113 = 0 THEN quantity WHEN event_id % 127 = 0 THEN NULL
              ELSE quantity END AS whole_quantity,
         event_id % 107 <> 0 AND event_id % 109 <> 0 AND event_id % 113 = 0 AS is_fraction,
         CASE WHEN event_id % 103 = 0 THEN 'garbage' WHEN event_id % 137 = 0 THEN '12:30'
              ELSE strftime(event_time, '%Y-%m-%dT%H:%M:%S.%f+00:00') END AS stamp
  FROM order_feed
),
raw_lines AS (
  SELECT * FROM dirty
  UNION ALL
  SELECT * FROM dirty WHERE event_id % 97 = 0 AND status <> 'NEW'
),
broken_lines AS (
  SELECT event_id FROM order_feed WHERE event_id % 101 = 0 AND status = 'NEW'
)"""
)

SILVER = (
    RAW
    + f""",
usable AS (
  SELECT * REPLACE (CASE WHEN price < 1e15 THEN price END AS price)
  FROM raw_lines WHERE stamp NOT IN ('garbage', '12:30')
),
cancel_pairs AS (
  SELECT order_id, min(event_time) FILTER (status = 'NEW') AS placed_at,
         min(event_time) FILTER (status = 'CANCELLED') AS cancelled_at
  FROM usable GROUP BY order_id
),
latest AS (
  SELECT * FROM usable
  QUALIFY row_number() OVER (
    PARTITION BY order_id ORDER BY event_time DESC, (status <> 'NEW') DESC) = 1
),
silver_orders AS (
  SELECT 'order' AS event_type, order_id, trader_id, lower(trader_type) AS trader_type, symbol,
         side, {_r("price", 2)} AS price,
         CAST(coalesce(whole_quantity, 0) AS BIGINT) AS quantity,
         CASE status WHEN 'NEW' THEN 'placed' ELSE lower(status) END AS status,
         strftime(event_time, '%Y-%m-%dT%H:%M:%SZ') AS timestamp,
         strftime(event_time, '%Y-%m-%d') AS date,
         greatest(CAST(epoch_us(cancelled_at) - epoch_us(placed_at) AS DOUBLE) / 1e6, 0)
           AS ttc_or_zero, placed_at, cancelled_at
  FROM latest JOIN cancel_pairs USING (order_id)
),
silver AS (
  SELECT * EXCLUDE (ttc_or_zero, placed_at, cancelled_at),
         CASE WHEN placed_at IS NOT NULL AND cancelled_at IS NOT NULL THEN ttc_or_zero END
           AS time_to_cancel_seconds
  FROM silver_orders
),
activity AS (
  SELECT date, trader_id, symbol, count(order_id) AS total_orders,
         count(*) FILTER (status = 'cancelled') AS total_cancels,
         count(*) FILTER (status = 'filled') AS total_trades,
         {_r("avg(quantity)", 2)} AS avg_order_size,
         {_r("avg(time_to_cancel_seconds)", 2)} AS avg_time_to_cancel,
         {_r("CAST(count(*) FILTER (status = 'cancelled') AS DOUBLE) / count(order_id)", 4)}
           AS cancel_rate
  FROM silver GROUP BY date, trader_id, symbol
)"""
)

TRADES = f"""
trade_feed AS (
  SELECT 'trade' AS event_type,
         CAST(l_orderkey * 10 + l_linenumber AS VARCHAR) AS trade_id,
         {_trader("o_custkey")} AS buy_trader_id,
         CASE WHEN l_suppkey % 10 = 9 THEN 'market' ELSE {_trader("l_suppkey")} END
           AS sell_trader_id,
         {_symbol("l_partkey % 8")} AS symbol,
         l_extendedprice / l_quantity AS price, CAST(l_quantity AS INTEGER) AS quantity,
         strftime(l_shipdate, '%Y-%m-%dT%H:%M:%S+00:00') AS timestamp, l_shipdate
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey
),
legs AS (
  SELECT trade_id, '' AS order_id, trader_id,
         CASE WHEN trader_id IN ('', 'market') THEN 'market'
              WHEN contains(trader_id, 'spoofer') THEN 'spoofer'
              WHEN contains(trader_id, 'wash') THEN 'wash_trader' ELSE 'normal' END AS trader_type,
         symbol, side, price, quantity, timestamp, buy_trader_id, sell_trader_id, place
  FROM (SELECT *, buy_trader_id AS trader_id, 'buy' AS side, 0 AS place FROM trade_feed
        UNION ALL
        SELECT *, sell_trader_id, 'sell', 1 FROM trade_feed)
),
leg_rows AS (
  SELECT trade_id, order_id, trader_id, trader_type, symbol, side, price, quantity, timestamp
  FROM legs
),
leg_sample AS (
  SELECT * FROM legs
  ORDER BY timestamp DESC, trade_id DESC, price DESC, quantity DESC, buy_trader_id DESC,
           sell_trader_id DESC, place LIMIT 5000
)"""

TICKS = f"""
ticks AS (
  SELECT {_symbol("(event_id * 31 + user_id) % 8")} AS symbol, value AS price,
         CAST(event_id % 1000 AS DOUBLE) AS volume, epoch_us(ts) // 1000 AS timestamp_ms,
         CASE WHEN event_id % 5 <> 0 THEN CAST(event_id % 4 AS VARCHAR) ELSE '' END AS conditions,
         event_id
  FROM events WHERE event_type IN ('view', 'click')
),
prints AS (
  SELECT symbol, price + CAST(k.i AS DOUBLE) AS price, volume,
         timestamp_ms + k.i AS timestamp_ms, conditions
  FROM ticks, (SELECT unnest(range(3)) AS i) AS k
  WHERE k.i <= (event_id % 1000) % 3 AND (event_id % 1000) % 7 <> 0
)"""

FEED = """
feed AS (
  SELECT detected_at, alert_type, severity, symbol, trader_id, trader_id_1, trader_id_2,
         cancel_rate, cancel_count, total_orders, match_count, avg_price_diff_pct
  FROM graded
  ORDER BY detected_at DESC, alert_type, symbol, trader_id NULLS FIRST, trader_id_1 NULLS FIRST,
           trader_id_2 NULLS FIRST, window_start
)"""

RISK = """
roles AS (
  SELECT trader_id, 'SPOOFING' AS alert_type, count(*) AS alerts, avg(cancel_rate) AS rate,
         max(detected_at) AS latest FROM spoofing GROUP BY trader_id
  UNION ALL
  SELECT trader_id_1, 'WASH_TRADING', count(*), NULL, max(detected_at)
  FROM wash GROUP BY trader_id_1
  UNION ALL
  SELECT trader_id_2, 'WASH_TRADING', count(*), NULL, max(detected_at)
  FROM wash GROUP BY trader_id_2
),
risk AS (
  SELECT trader_id, CAST(sum(alerts) AS BIGINT) AS alert_count,
         string_agg(DISTINCT alert_type, ' + ' ORDER BY alert_type) AS alert_types,
         avg(rate) AS avg_cancel_rate, max(latest) AS latest_alert
  FROM roles GROUP BY trader_id ORDER BY alert_count DESC, trader_id LIMIT 25
)"""


def _with(prefix: str, body: str) -> str:
    return f"WITH {prefix.strip()}\n{body.strip()}"


LATE_WINDOWS = "(SELECT max(event_time) - INTERVAL 5 SECOND FROM order_feed)"

ORACLES: dict[str, str] = {
    # Ingest
    "order_feed": _with(ORDERS, "SELECT * EXCLUDE (event_id, ts) FROM order_feed"),
    "parse_orders_json": _with(
        RAW,
        """
        SELECT 'order' AS event_type, order_id, trader_id, trader_type, symbol, side, price,
               CASE WHEN is_fraction THEN NULL ELSE whole_quantity END AS quantity, status,
               stamp AS timestamp,
               CASE WHEN stamp NOT IN ('garbage', '12:30') THEN event_time END AS event_time
        FROM raw_lines
        """,
    ),
    "event_time_parse": """
        SELECT event_id,
               CASE WHEN event_id % 103 = 0 THEN 'garbage'
                    ELSE strftime(ts, '%Y-%m-%dT%H:%M:%S.%f')
                         || CASE WHEN event_id % 2 = 0 THEN '+00:00' ELSE '-05:00' END END
                 AS timestamp,
               CASE WHEN event_id % 103 <> 0 THEN date_trunc('second', ts) END AS event_time
        FROM events
        """,
    "malformed_orders": _with(
        RAW,
        """
        SELECT 'orders' AS topic, 'unparsable event time' AS reason, order_id
        FROM raw_lines WHERE stamp IN ('garbage', '12:30')
        UNION ALL
        SELECT 'orders', 'unparsable message', NULL FROM broken_lines
        """,
    ),
    # Detectors
    "spoofing_alerts": _with(ALERTS, "SELECT * FROM spoofing"),
    "cancel_windows": _with(ALERTS, "SELECT * FROM cancel_windows"),
    "wash_matches": _with(
        ALERTS,
        f"SELECT * EXCLUDE (price_diff_pct), {_r('price_diff_pct', 6)} AS price_diff_pct FROM matches",
    ),
    "wash_alerts": _with(ALERTS, "SELECT * FROM wash"),
    "wash_alerts_unfolded": _with(ALERTS, "SELECT * FROM wash"),
    "all_alerts": _with(ALERTS, "SELECT * FROM all_alerts"),
    "alerts_json": _with(ALERTS, "SELECT * FROM all_alerts"),
    "alerts_since_midnight": _with(
        ALERTS, "SELECT * FROM all_alerts WHERE detected_at >= TIMESTAMP '2024-01-20'"
    ),
    "detection_scorecard": _with(
        ALERTS,
        """
        , population AS (SELECT DISTINCT trader_id, trader_type FROM order_feed),
        outcome AS (
          SELECT kind.alert_type, p.trader_type = kind.trader_type AS planted,
                 EXISTS (SELECT 1 FROM named n WHERE n.trader_id = p.trader_id
                         AND n.alert_type = kind.alert_type) AS flagged
          FROM population p, (VALUES ('SPOOFING', 'spoofer'), ('WASH_TRADING', 'wash_trader'))
               AS kind(alert_type, trader_type)
        ),
        counts AS (
          SELECT alert_type, count(*) FILTER (planted AND flagged) AS true_positives,
                 count(*) FILTER (NOT planted AND flagged) AS false_positives,
                 count(*) FILTER (planted AND NOT flagged) AS false_negatives,
                 count(*) FILTER (NOT planted AND NOT flagged) AS true_negatives
          FROM outcome GROUP BY alert_type
        )
        SELECT *, CAST(true_positives AS DOUBLE) / nullif(true_positives + false_positives, 0)
                    AS precision,
               CAST(true_positives AS DOUBLE) / nullif(true_positives + false_negatives, 0)
                    AS recall
        FROM counts
        """,
    ),
    # Lake
    "silver_orders": _with(SILVER, "SELECT * FROM silver"),
    "time_to_cancel": _with(
        SILVER,
        """
        SELECT order_id, placed_at, cancelled_at,
               greatest(CAST(epoch_us(cancelled_at) - epoch_us(placed_at) AS DOUBLE) / 1e6, 0)
                 AS time_to_cancel_seconds
        FROM cancel_pairs WHERE placed_at IS NOT NULL AND cancelled_at IS NOT NULL
        """,
    ),
    "silver_trades": _with(
        TRADES,
        f"""
        SELECT event_type, trade_id, buy_trader_id, sell_trader_id, symbol,
               {_r("price", 2)} AS price, CAST(quantity AS BIGINT) AS quantity,
               strftime(l_shipdate, '%Y-%m-%dT%H:%M:%SZ') AS timestamp,
               strftime(l_shipdate, '%Y-%m-%d') AS date
        FROM trade_feed
        QUALIFY row_number() OVER (
          PARTITION BY trade_id
          ORDER BY l_shipdate DESC, buy_trader_id DESC, sell_trader_id DESC, symbol DESC,
                   {_r("price", 2)} DESC, quantity DESC) = 1
        """,
    ),
    "trader_daily_activity": _with(SILVER, "SELECT * FROM activity"),
    "asset_hourly_summary": _with(
        SILVER,
        f"""
        SELECT date, CAST(substr(timestamp, 12, 2) AS INTEGER) AS hour, symbol,
               {_r("CAST(sum(CAST(round_even(price * 100, 0) AS BIGINT)) AS DOUBLE) / 100 / count(price)", 4)}
                 AS avg_price,
               {_r("stddev_samp(price)", 4)} AS price_volatility,
               CAST(sum(quantity) AS BIGINT) AS total_volume, count(order_id) AS total_orders,
               count(*) FILTER (status = 'filled') AS total_trades
        FROM silver GROUP BY ALL
        """,
    ),
    "alert_summary": _with(
        ALERTS,
        f"""
        , traders AS (
          SELECT alert_type, count(DISTINCT trader_id) AS unique_traders_flagged
          FROM named GROUP BY alert_type
        )
        SELECT alert_type, count(*) AS total_alerts,
               any_value(unique_traders_flagged) AS unique_traders_flagged,
               {_r("avg(cancel_rate)", 4)} AS avg_cancel_rate
        FROM all_alerts JOIN traders USING (alert_type) GROUP BY alert_type
        """,
    ),
    # Catalog
    "silver_alerts": _with(BRONZE_ALERTS, "SELECT * FROM silver_alerts"),
    "silver_alerts_by_pair": _with(BRONZE_ALERTS, "SELECT DISTINCT * FROM clean_alerts"),
    "silver_alerts_sql": _with(
        BRONZE_ALERTS,
        """
        SELECT * FROM clean_alerts c
        WHERE EXISTS (
          SELECT 1 FROM (SELECT alert_type, trader_id, symbol, window_start, window_end
                         FROM clean_alerts GROUP BY ALL HAVING count(*) >= 1) k
          WHERE k.alert_type = c.alert_type AND k.trader_id = c.trader_id
            AND k.symbol = c.symbol AND k.window_start = c.window_start
            AND k.window_end = c.window_end)
        """,
    ),
    "silver_orders_catalog": _with(
        RAW,
        """
        SELECT order_id, trader_id, lower(trader_type) AS trader_type, upper(symbol) AS symbol,
               lower(side) AS side, price,
               CASE WHEN is_fraction THEN NULL ELSE whole_quantity END AS quantity,
               lower(status) AS status, stamp AS timestamp
        FROM raw_lines
        QUALIFY row_number() OVER (PARTITION BY order_id, status ORDER BY stamp) = 1
        """,
    ),
    "silver_orders_distinct": _with(
        RAW,
        """
        SELECT DISTINCT order_id, trader_id, lower(trader_type) AS trader_type,
               upper(symbol) AS symbol, lower(side) AS side, price,
               CASE WHEN is_fraction THEN NULL ELSE whole_quantity END AS quantity,
               lower(status) AS status, stamp AS timestamp
        FROM raw_lines
        """,
    ),
    "silver_trades_catalog": _with(
        TRADES,
        """
        SELECT * FROM leg_rows
        QUALIFY row_number() OVER (
          PARTITION BY trade_id
          ORDER BY (side = 'buy') DESC, order_id, trader_id, trader_type, symbol, side, price,
                   quantity, timestamp) = 1
        """,
    ),
    "silver_trades_distinct": _with(TRADES, "SELECT DISTINCT * FROM leg_rows"),
    "flagged_traders": _with(BRONZE_ALERTS, "SELECT * FROM all_flagged"),
    "trader_risk_summary": _with(
        BRONZE_ALERTS,
        f"""
        SELECT trader_id, count(*) AS total_alerts,
               count(DISTINCT symbol) AS distinct_symbols_flagged,
               count(DISTINCT alert_type) AS distinct_alert_types,
               {_r("avg(cancel_rate)", 9)} AS avg_cancel_rate,
               max(cancel_count) AS max_cancel_count_in_window,
               min(detected_at) AS first_alert_at, max(detected_at) AS latest_alert_at
        FROM all_flagged GROUP BY trader_id
        """,
    ),
    "asset_alert_activity": _with(
        BRONZE_ALERTS,
        f"""
        SELECT symbol, alert_type, count(*) AS alert_count,
               {_r("avg(cancel_rate)", 9)} AS avg_cancel_rate,
               min(detected_at) AS first_detected, max(detected_at) AS latest_detected
        FROM silver_alerts GROUP BY symbol, alert_type
        """,
    ),
    "daily_alert_metrics": _with(
        BRONZE_ALERTS,
        f"""
        SELECT strftime(detected_at, '%Y-%m-%d') AS alert_date, alert_type,
               count(*) AS total_alerts,
               count(DISTINCT coalesce(trader_id, trader_id_1)) AS unique_traders,
               count(DISTINCT symbol) AS unique_symbols,
               {_r("avg(cancel_rate)", 9)} AS avg_cancel_rate
        FROM silver_alerts GROUP BY strftime(detected_at, '%Y-%m-%d'), alert_type
        """,
    ),
    "alert_null_audit": _with(
        BRONZE_ALERTS,
        """
        SELECT alert_type, count(*) AS total, count(trader_id) AS has_trader_id,
               count(trader_id_1) AS has_trader_id_1, count(trader_id_2) AS has_trader_id_2
        FROM silver_alerts GROUP BY alert_type
        """,
    ),
    # Serving
    "alert_severity": _with(ALERTS, "SELECT * FROM graded"),
    "alert_kpis": _with(
        ALERTS,
        """
        SELECT count(*) AS total_alerts,
               count(*) FILTER (alert_type = 'SPOOFING') AS spoofing_alerts,
               count(*) FILTER (alert_type = 'WASH_TRADING') AS wash_alerts,
               (SELECT count(DISTINCT trader_id) FROM named) AS unique_traders
        FROM all_alerts
        """,
    ),
    "alert_feed": _with(ALERTS + "," + FEED, "SELECT * FROM feed"),
    "alert_feed_filtered": _with(
        ALERTS,
        """
        SELECT detected_at, alert_type, severity, symbol, trader_id, trader_id_1, trader_id_2,
               cancel_rate, cancel_count, total_orders, match_count, avg_price_diff_pct
        FROM graded
        WHERE alert_type = 'SPOOFING' AND severity = 'HIGH' AND symbol = 'MSFT'
        ORDER BY detected_at DESC, trader_id, window_start
        """,
    ),
    "alert_feed_formatted": _with(
        ALERTS + "," + FEED,
        """
        SELECT strftime(detected_at, '%H:%M:%S') AS detected_at, alert_type, severity, symbol,
               trader_id, trader_id_1, trader_id_2,
               coalesce(printf('%.1f%%', cancel_rate * 100), '—') AS cancel_rate, cancel_count,
               total_orders, match_count,
               coalesce(printf('%.3f%%', avg_price_diff_pct), '—') AS avg_price_diff_pct
        FROM feed
        """,
    ),
    "alert_filter_options": _with(
        ALERTS,
        """
        SELECT DISTINCT 'alert_type' AS selector, alert_type AS value FROM all_alerts
        UNION ALL SELECT DISTINCT 'symbol', symbol FROM all_alerts
        UNION ALL SELECT DISTINCT 'trader', trader_id FROM named
        """,
    ),
    "high_risk_traders": _with(
        ALERTS + "," + RISK,
        f"SELECT * EXCLUDE (avg_cancel_rate), {_r('avg_cancel_rate', 9)} AS avg_cancel_rate FROM risk",
    ),
    "high_risk_traders_formatted": _with(
        ALERTS + "," + RISK,
        """
        SELECT trader_id, alert_count, alert_types,
               coalesce(printf('%.1f%%', avg_cancel_rate * 100), '—') AS avg_cancel_rate,
               strftime(latest_alert, '%H:%M:%S') AS latest_alert
        FROM risk
        """,
    ),
    "asset_risk_counts": _with(
        ALERTS,
        "SELECT symbol, alert_type, count(*) AS alert_count FROM all_alerts GROUP BY ALL",
    ),
    "alert_hourly_volume": _with(
        ALERTS,
        """
        SELECT CAST(hour(detected_at) AS INTEGER) AS hour, alert_type, count(*) AS alert_count
        FROM all_alerts GROUP BY ALL
        """,
    ),
    "trader_alert_drilldown": _with(
        ALERTS,
        """
        SELECT * FROM graded
        WHERE trader_id = 'spoofer_00010' OR trader_id_1 = 'spoofer_00010'
           OR trader_id_2 = 'spoofer_00010'
        ORDER BY detected_at DESC, alert_type, symbol, trader_id NULLS FIRST,
                 trader_id_1 NULLS FIRST, trader_id_2 NULLS FIRST, window_start
        """,
    ),
    "trader_activity_lookup": _with(
        ALERTS + SILVER.replace(ORDERS, ""),
        """
        SELECT t.trader_id, a.* EXCLUDE (trader_id)
        FROM (SELECT DISTINCT trader_id FROM named) t LEFT JOIN activity a USING (trader_id)
        """,
    ),
    "trader_activity_cards": _with(
        SILVER,
        """
        SELECT trader_id, date, symbol, format('{:,}', total_orders) AS orders,
               format('{:,}', total_cancels) AS cancels,
               coalesce(printf('%.1f%%', cancel_rate * 100), '—') AS cancel_rate,
               format('{:,}', total_trades) AS trades,
               coalesce(printf('%.1f', avg_order_size), '—') AS avg_order_size,
               coalesce(printf('%.0fs', avg_time_to_cancel), '—') AS avg_time_to_cancel
        FROM activity
        """,
    ),
    # Ticks
    "flatten_ticks": _with(
        TICKS,
        """
        SELECT 'market_tick' AS event_type, symbol, price, volume, timestamp_ms,
               CASE WHEN timestamp_ms % 1000 = 0
                    THEN strftime(make_timestamp(timestamp_ms * 1000), '%Y-%m-%dT%H:%M:%S+00:00')
                    ELSE strftime(make_timestamp(timestamp_ms * 1000),
                                  '%Y-%m-%dT%H:%M:%S.%f+00:00') END AS timestamp_iso,
               conditions, '2024-02-01T00:00:00+00:00' AS ingested_at
        FROM prints
        """,
    ),
    "route_ticks": _with(
        TICKS,
        """
        SELECT CASE WHEN starts_with(symbol, 'BINANCE:') THEN 'market-data-crypto'
                    ELSE 'market-data-stocks' END AS topic, symbol, price, volume, timestamp_ms
        FROM prints
        """,
    ),
    "latest_tick_per_symbol": _with(
        TICKS,
        """
        SELECT symbol, timestamp_ms, price FROM ticks WHERE price <> 0
        QUALIFY row_number() OVER (PARTITION BY symbol ORDER BY timestamp_ms DESC, price DESC) = 1
        """,
    ),
    "order_vs_last_tick": _with(
        ORDERS + "," + TICKS,
        """
        , quotes AS (
          SELECT symbol, timestamp_ms, max(price) AS price FROM ticks WHERE price <> 0
          GROUP BY symbol, timestamp_ms
        ),
        placed AS (
          SELECT order_id, trader_id, symbol, side, price, event_time,
                 epoch_us(event_time) // 1000 AS at_ms FROM order_feed WHERE status = 'NEW'
        )
        SELECT order_id, trader_id, p.symbol, side, p.price, event_time,
               q.timestamp_ms AS tick_ms, q.price AS last_price
        FROM placed p ASOF LEFT JOIN quotes q
          ON p.symbol = q.symbol AND p.at_ms >= q.timestamp_ms
        """,
    ),
    # Export
    "balanced_alert_sample": _with(
        ALERTS,
        """
        SELECT * EXCLUDE (avg_price_diff_pct) FROM all_alerts
        QUALIFY row_number() OVER (
          PARTITION BY alert_type
          ORDER BY detected_at DESC, window_start DESC, symbol, trader_id NULLS FIRST,
                   trader_id_1 NULLS FIRST, trader_id_2 NULLS FIRST) <= 2500
        """,
    ),
    "latest_orders_sample": _with(
        ORDERS,
        """
        SELECT order_id, trader_id, trader_type, symbol, side, price, quantity, status,
               strftime(event_time, '%Y-%m-%dT%H:%M:%S.%f+00:00') AS timestamp
        FROM order_feed ORDER BY event_time DESC, order_id DESC, status LIMIT 10000
        """,
    ),
    "trade_legs": _with(TRADES, "SELECT * FROM leg_rows"),
    "latest_trade_legs_sample": _with(
        TRADES,
        """
        SELECT trade_id, order_id, trader_id, trader_type, symbol, side, price, quantity, timestamp
        FROM leg_sample
        """,
    ),
    "csv_round_trip": _with(
        ALERTS, "SELECT * EXCLUDE (avg_price_diff_pct) FROM all_alerts"
    ),
    # Cases
    "alert_case_rows": _with(
        ALERTS,
        f"""
        , keyed AS (
          SELECT *, md5(concat_ws('|', alert_type, symbol, trader_id, trader_id_1, trader_id_2,
                                  strftime(window_start, '%Y-%m-%d %H:%M:%S'),
                                  strftime(window_end, '%Y-%m-%d %H:%M:%S'))) AS digest
          FROM graded
        )
        SELECT substr(digest, 1, 8) || '-' || substr(digest, 9, 4) || '-' || substr(digest, 13, 4)
                 || '-' || substr(digest, 17, 4) || '-' || substr(digest, 21, 12) AS alert_id,
               lower(alert_type) AS alert_type, lower(severity) AS severity,
               coalesce(trader_id, trader_id_1) AS trader_id, symbol AS asset,
               CASE alert_type
                 WHEN 'SPOOFING' THEN trader_id || ' cancelled ' || cancel_count || ' of '
                   || total_orders || ' completed orders in ' || symbol
                 ELSE trader_id_1 || ' and ' || trader_id_2 || ' matched ' || match_count
                   || ' opposite fills in ' || symbol END AS description,
               CASE alert_type
                 WHEN 'SPOOFING' THEN '{{"cancel_count":' || cancel_count || ',"total_orders":'
                   || total_orders || ',"cancel_rate":' || {_r("cancel_rate", 3)} || '}}'
                 ELSE '{{"trader_id_1":"' || trader_id_1 || '","trader_id_2":"' || trader_id_2
                   || '","match_count":' || match_count || ',"avg_price_diff_pct":'
                   || {_r("avg_price_diff_pct", 3)} || '}}' END AS details,
               CAST(NULL AS VARCHAR) AS market_context, detected_at, 'open' AS status,
               CAST(NULL AS VARCHAR) AS reviewed_by, CAST(NULL AS TIMESTAMP) AS reviewed_at,
               CAST(NULL AS VARCHAR) AS notes
        FROM keyed
        """,
    ),
    "alerts_with_profile": _with(
        ALERTS,
        f"""
        , profiles AS (
          SELECT {_trader("c_custkey")} AS trader_id, c_name AS trader_name,
                 lower(c_mktsegment) AS profile_type,
                 CASE WHEN c_acctbal < 0 THEN 'elevated' ELSE 'normal' END AS risk_rating
          FROM customer
        )
        SELECT n.trader_id, n.alert_type, n.symbol, n.window_start, n.window_end, p.trader_name,
               p.profile_type, p.risk_rating
        FROM named n LEFT JOIN profiles p USING (trader_id)
        """,
    ),
    # Sinks and streams
    "silver_partition_write": _with(SILVER, "SELECT * FROM silver"),
    "gold_partition_overwrite": _with(
        SILVER,
        """
        SELECT * REPLACE (CASE WHEN date >= '2024-01-20' THEN total_orders
                               ELSE total_orders + 1 END AS total_orders)
        FROM activity
        """,
    ),
    "bronze_landing": _with(
        RAW + "," + TICKS,
        """
        SELECT 'orders' AS topic, order_id AS message_key, count(*) AS lines
        FROM raw_lines GROUP BY order_id
        UNION ALL
        SELECT 'orders', NULL, count(*) FROM broken_lines
        UNION ALL
        SELECT CASE WHEN starts_with(symbol, 'BINANCE:') THEN 'market-data-crypto'
                    ELSE 'market-data-stocks' END, symbol, count(*)
        FROM ticks GROUP BY symbol
        """,
    ),
    "bronze_incremental_read": _with(
        RAW,
        """
        SELECT CASE WHEN e.ts < TIMESTAMP '2024-01-20' THEN 1 ELSE 2 END AS cycle,
               'orders' AS topic, count(*) AS lines
        FROM (SELECT event_id FROM raw_lines UNION ALL SELECT event_id FROM broken_lines)
        JOIN events e USING (event_id) GROUP BY cycle
        """,
    ),
    "stream_spoofing_alerts": _with(
        ALERTS, f"SELECT * FROM spoofing WHERE window_end <= {LATE_WINDOWS}"
    ),
    "stream_wash_alerts": _with(
        ALERTS, f"SELECT * FROM wash WHERE window_end <= {LATE_WINDOWS}"
    ),
    "lake_cycle": _with(SILVER, "SELECT * FROM activity"),
    "lake_cycle_orders": _with(SILVER, "SELECT * FROM silver"),
    "stream_malformed_orders": _with(
        RAW,
        """
        SELECT 'orders' AS topic, 'unparsable event time' AS reason, order_id
        FROM raw_lines WHERE stamp IN ('garbage', '12:30')
        UNION ALL
        SELECT 'orders', 'unparsable message', NULL FROM broken_lines
        """,
    ),
    "catalog_rebuild": _with(
        ALERTS + "," + TRADES,
        """
        , kept AS (
          SELECT * FROM all_alerts
          QUALIFY row_number() OVER (
            PARTITION BY alert_type, trader_id, symbol, window_start, window_end
            ORDER BY trader_id_1, trader_id_2) = 1
        )
        SELECT 'bronze.alerts' AS table_name, count(*) AS row_count FROM all_alerts
        UNION ALL SELECT 'bronze.orders', count(*) FROM order_feed
        UNION ALL SELECT 'bronze.trades', count(*) FROM leg_rows
        UNION ALL SELECT 'silver.alerts', count(*) FROM kept
        UNION ALL SELECT 'silver.orders', count(DISTINCT (order_id, status)) FROM order_feed
        UNION ALL SELECT 'silver.trades', count(DISTINCT trade_id) FROM leg_rows
        UNION ALL SELECT 'gold.trader_risk_summary', count(DISTINCT t) FROM (
          SELECT trader_id AS t FROM kept UNION ALL SELECT trader_id_1 FROM kept
          UNION ALL SELECT trader_id_2 FROM kept)
        UNION ALL SELECT 'gold.asset_alert_activity', count(DISTINCT (symbol, alert_type)) FROM kept
        UNION ALL SELECT 'gold.daily_alert_metrics',
                         count(DISTINCT (date_trunc('day', detected_at), alert_type)) FROM kept
        """,
    ),
    "catalog_orders_table": _with(
        ORDERS,
        """
        SELECT order_id, trader_id, lower(trader_type) AS trader_type, upper(symbol) AS symbol,
               lower(side) AS side, price, quantity, lower(status) AS status,
               strftime(event_time, '%Y-%m-%dT%H:%M:%S.%f+00:00') AS timestamp
        FROM order_feed
        """,
    ),
}
ORACLES["lake_cycle_hourly"] = ORACLES["asset_hourly_summary"]
ORACLES["silver_trades_cycle"] = ORACLES["silver_trades"]
ORACLES["alert_summary_cycle"] = ORACLES["alert_summary"].replace(
    "SELECT alert_type, count(*) AS total_alerts",
    "SELECT '2024-02-01' AS date, alert_type, count(*) AS total_alerts",
)
# An empty field of a snapshot is read as NULL.
ORACLES["catalog_trades_table"] = (
    f"SELECT * REPLACE (CAST(NULL AS VARCHAR) AS order_id) FROM ({ORACLES['silver_trades_catalog']})"
)
# The same rows; the query puts them in the order of display.
ORACLES["trader_risk_ranking"] = ORACLES["trader_risk_summary"]
ORACLES["asset_activity_ranking"] = ORACLES["asset_alert_activity"]
ORACLES["newest_alert_days"] = ORACLES["daily_alert_metrics"]
ORACLES["alert_kpis_by_sets"] = _with(
    ALERTS,
    """
    , since AS (SELECT * FROM all_alerts WHERE detected_at >= TIMESTAMP '2024-01-20'),
    who AS (
      SELECT alert_type, unnest([trader_id, trader_id_1, trader_id_2]) AS trader FROM since
    ),
    kinds AS (SELECT DISTINCT alert_type AS kind FROM since UNION ALL SELECT 'ALL')
    SELECT kind AS alert_type,
           (SELECT count(*) FROM since WHERE kind IN ('ALL', alert_type)) AS total_alerts,
           (SELECT count(DISTINCT trader) FROM who WHERE kind IN ('ALL', alert_type)) AS unique_traders
    FROM kinds
    """,
)
ORACLES["case_lifecycle"] = f"""
WITH opened AS ({ORACLES["alert_case_rows"]}),
seen AS (
  SELECT *, detected_at + INTERVAL 1 HOUR AS closed_at,
         CASE WHEN asset = 'AAPL' THEN detected_at + INTERVAL 2 HOUR ELSE detected_at END AS last_at
  FROM opened
)
SELECT alert_id, alert_type, severity, asset, last_at AS detected_at,
       CASE WHEN severity <> 'high' THEN 'open' WHEN last_at > closed_at THEN 'reopened'
            ELSE 'resolved' END AS status,
       CASE WHEN severity = 'high' THEN 'analyst' END AS reviewed_by,
       CASE WHEN severity = 'high' THEN closed_at END AS reviewed_at,
       CASE WHEN severity = 'high' THEN 'seen' END AS notes
FROM seen
"""
ORACLES["late_orders"] = _with(
    ORDERS,
    """
    SELECT order_id, status, event_time FROM order_feed
    WHERE status <> 'NEW'
      AND event_time < (SELECT max(event_time) - INTERVAL 5 SECOND FROM order_feed WHERE status = 'NEW')
    """,
)
ORACLES["schema_guard"] = _with(
    ORDERS,
    """
    , counts AS (
      SELECT count(*) FILTER (status = 'NEW') AS placed, count(*) FILTER (status <> 'NEW') AS ended
      FROM order_feed
    )
    SELECT CAST(1 AS BIGINT) AS version, 'order_id' AS field, 'missing' AS problem, CAST(0 AS BIGINT) AS lines
    UNION ALL SELECT 1, 'oid', 'new', placed FROM counts
    UNION ALL SELECT 0, NULL, 'passed', placed FROM counts
    UNION ALL SELECT 1, NULL, 'skipped', placed FROM counts
    UNION ALL SELECT 2, NULL, 'passed', ended FROM counts
    """,
)
ORACLES["stream_order_vs_last_tick"] = _with(
    ORDERS + "," + TICKS,
    """
    , quotes AS (
      SELECT symbol, timestamp_ms, max(price) AS price FROM prints WHERE price <> 0
      GROUP BY symbol, timestamp_ms
    ),
    placed AS (
      SELECT order_id, trader_id, symbol, side, price, event_time,
             epoch_us(event_time) // 1000 AS at_ms FROM order_feed WHERE status = 'NEW'
    ),
    mark AS (
      SELECT least((SELECT max(at_ms) FROM placed), (SELECT max(timestamp_ms) FROM quotes)) - 5000 AS at_ms
    )
    SELECT order_id, trader_id, p.symbol, side, p.price, event_time,
           q.timestamp_ms AS tick_ms, q.price AS last_price
    FROM (SELECT * FROM placed WHERE at_ms < (SELECT at_ms FROM mark)) AS p ASOF LEFT JOIN quotes q
      ON p.symbol = q.symbol AND p.at_ms >= q.timestamp_ms
    """,
)
ORACLES["orders_by_id"] = _with(
    SILVER,
    """
    SELECT * FROM silver
    WHERE order_id IN (SELECT order_id FROM order_feed WHERE trader_id = 'spoofer_00010')
    """,
)
