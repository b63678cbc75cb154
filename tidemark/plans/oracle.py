"""DuckDB SQL equal in meaning to each entry of ``plans.queries``.

Written independently of the Spark code: the feed mapping of
``sources.testfeeds`` restated in SQL over the ``events`` view, then the
operator's semantics as plain SQL.
"""

from __future__ import annotations

BASE = """
base AS (
  SELECT event_id, event_type, epoch_us(ts) // 1000 AS trade_time,
         CAST(json_extract_string(props, '$.k') AS INTEGER) AS k,
         CAST(user_id % 3 AS INTEGER) AS sym,
         ['BTCUSDT', 'ETHUSDT', 'SOLUSDT'][CAST(user_id % 3 AS INTEGER) + 1] AS symbol,
         ['BTC-USD', 'ETH-USD', 'SOL-USD'][CAST(user_id % 3 AS INTEGER) + 1] AS product_id,
         CAST(CAST(value AS DECIMAL(18,2)) + 100 AS DECIMAL(18,8)) AS price,
         CAST((CAST(json_extract_string(props, '$.k') AS INTEGER) + 1)
              * CASE user_id % 3 WHEN 0 THEN 0.1 WHEN 1 THEN 1.0 ELSE 10.0 END AS DECIMAL(18,8)) AS quantity,
         event_id % 2 = 0 AS even
  FROM events),
ta AS (
  SELECT 'trade' AS event_type, trade_time + k AS event_time, symbol, event_id AS trade_id,
         price, quantity, trade_time, even AS is_buyer_maker, trade_time + 20 + 5 * k AS ingestion_time
  FROM base WHERE event_type IN ('click', 'purchase')),
tb AS (
  SELECT CAST(event_id AS VARCHAR) AS trade_id, product_id, price, quantity AS size,
         CASE WHEN even THEN 'SELL' ELSE 'BUY' END AS side, trade_time AS event_time,
         trade_time + 20 + 5 * k AS ingestion_time
  FROM base WHERE event_type IN ('view', 'signup')),
raw_a AS (
  SELECT symbol, CAST(price AS DOUBLE) AS price, CAST(quantity AS DOUBLE) AS quantity,
         trade_time, is_buyer_maker, ingestion_time FROM ta),
whales_u AS (
  SELECT symbol, CAST(price AS DOUBLE) AS price, CAST(quantity AS DOUBLE) AS quantity,
         CAST(price AS DOUBLE) * CAST(quantity AS DOUBLE) AS trade_value, 'binance' AS exchange,
         CASE WHEN is_buyer_maker THEN 'SELL' ELSE 'BUY' END AS side, trade_time AS event_time
  FROM ta
  UNION ALL
  SELECT {b_symbol} AS symbol, CAST(price AS DOUBLE), CAST(size AS DOUBLE),
         CAST(price AS DOUBLE) * CAST(size AS DOUBLE), 'coinbase', side, event_time
  FROM tb),
whales AS (
  SELECT * FROM whales_u
  WHERE (symbol = 'BTCUSDT' AND quantity >= 5.0) OR (symbol = 'ETHUSDT' AND quantity >= 50.0)
     OR (symbol = 'SOLUSDT' AND quantity >= 500.0))
"""


def _with(body: str, normalise: bool = True) -> str:
    b_symbol = "replace(product_id, '-USD', 'USDT')" if normalise else "product_id"
    return "WITH " + BASE.replace("{b_symbol}", b_symbol).strip() + "\n" + body


def _vwap(width_ms: int, label: str) -> str:
    return f"""
vw AS (
  SELECT symbol, (trade_time // {width_ms}) * {width_ms} AS window_start,
         (trade_time // {width_ms}) * {width_ms} + {width_ms} AS window_end,
         SUM(CAST(price AS DOUBLE) * CAST(quantity AS DOUBLE)) / NULLIF(SUM(CAST(quantity AS DOUBLE)), 0) AS vwap,
         SUM(CAST(quantity AS DOUBLE)) AS total_volume, COUNT(trade_id) AS trade_count,
         '{label}' AS interval_label
  FROM ta GROUP BY 1, 2, 3)"""


WHALE_COLS = ("symbol, ROUND(price, 6) AS price, ROUND(quantity, 6) AS quantity, "
              "ROUND(trade_value, 6) AS trade_value, exchange, side, event_time")

WHALE_COLS_SEC = ("symbol, ROUND(price, 6) AS price, ROUND(quantity, 6) AS quantity, "
                  "ROUND(trade_value, 6) AS trade_value, exchange, side, event_time // 1000 * 1000 AS event_time")

PAIRS = """
pairs AS (
  SELECT a.symbol, CAST(a.price AS DOUBLE) AS a_price, CAST(b.price AS DOUBLE) AS b_price,
         a.trade_time AS a_time_ms, b.event_time AS b_time_ms
  FROM ta a JOIN tb b
    ON a.symbol = replace(b.product_id, '-USD', 'USDT')
   AND b.event_time BETWEEN a.trade_time - {h} AND a.trade_time + {h})"""

RECON = """
sv AS (
  SELECT symbol, window_start // 3600000 * 3600000 AS hour_start_ms, AVG(vwap) AS streaming_vwap
  FROM vw WHERE window_end <= window_start // 3600000 * 3600000 + 3600000 GROUP BY 1, 2),
bv AS (
  SELECT symbol, trade_time // 3600000 * 3600000 AS hour_start_ms,
         SUM(price * quantity) / NULLIF(SUM(quantity), 0) AS batch_vwap
  FROM raw_a GROUP BY 1, 2),
j AS (
  SELECT COALESCE(bv.symbol, sv.symbol) AS symbol, COALESCE(bv.hour_start_ms, sv.hour_start_ms) AS hour_start_ms,
         sv.streaming_vwap, bv.batch_vwap
  FROM bv FULL OUTER JOIN sv ON bv.symbol = sv.symbol AND bv.hour_start_ms = sv.hour_start_ms),
jj AS (
  SELECT *, ABS(batch_vwap - streaming_vwap) / NULLIF(batch_vwap, 0) * 100 AS diff_pct FROM j),
jr AS (
  SELECT *, CASE WHEN hour_start_ms NOT IN (SELECT hour_start_ms FROM bv) THEN 'no_batch_rows'
                 WHEN hour_start_ms NOT IN (SELECT hour_start_ms FROM sv) THEN 'no_streamed_rows'
                 WHEN batch_vwap IS NULL THEN 'batch' WHEN streaming_vwap IS NULL THEN 'stream'
                 WHEN diff_pct IS NULL THEN 'undefined_diff' END AS reason FROM jj)"""

# both sides with outages (see plans.queries._with_outages)
RECON_OUTAGES = RECON.replace(
    "FROM vw WHERE window_end <=", "FROM vw WHERE window_start // 3600000 % 7 <> 0 AND "
    "(window_start // 3600000 % 5 <> 0 OR symbol <= 'BTCUSDT') AND window_end <=").replace(
    "SUM(price * quantity)", "SUM(CASE WHEN trade_time // 3600000 % 17 = 0 THEN 0 ELSE price END * quantity)").replace(
    "FROM raw_a GROUP", "FROM raw_a WHERE trade_time // 3600000 % 11 <> 0 AND "
    "(trade_time // 3600000 % 13 <> 0 OR symbol <> 'BTCUSDT') GROUP")

def _pattern(within_ms: int) -> str:
    return f"""
r AS (SELECT symbol, trade_time AS ts, trade_id AS tid, CAST(price AS DOUBLE) AS price FROM ta),
d AS (
  SELECT *, COALESCE(SIGN(price - LAG(price) OVER w), 0) AS d, LEAD(price) OVER w AS np, LEAD(ts) OVER w AS nts
  FROM r WINDOW w AS (PARTITION BY symbol ORDER BY ts, tid)),
e AS (SELECT *, CASE WHEN nts IS NULL OR COALESCE(SIGN(np - price), 0) <> d THEN 1 ELSE 0 END AS is_end FROM d),
g AS (
  SELECT *, COALESCE(SUM(is_end) OVER (PARTITION BY symbol ORDER BY ts, tid
                                       ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS run_no
  FROM e),
g2 AS (
  SELECT symbol, run_no, d, FIRST_VALUE(price) OVER wr AS first_price, LAST_VALUE(price) OVER wr AS last_price,
         LAST_VALUE(ts) OVER wr AS last_ts, LAST_VALUE(np) OVER wr AS next_price, LAST_VALUE(nts) OVER wr AS next_ts
  FROM g WINDOW wr AS (PARTITION BY symbol, run_no ORDER BY ts, tid
                       ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)),
runs AS (SELECT DISTINCT * FROM g2),
cand AS (
  SELECT f.symbol, f.run_no AS f_run, p.last_price AS peak_price, s.last_price AS second_dip,
         s.next_price AS breakout_price, s.next_ts AS b_ts
  FROM runs f JOIN runs p ON p.symbol = f.symbol AND p.run_no = f.run_no + 1
              JOIN runs s ON s.symbol = f.symbol AND s.run_no = f.run_no + 2
  WHERE f.d = -1 AND p.d = 1 AND s.d = -1 AND s.next_ts IS NOT NULL
    AND s.next_price > p.first_price AND s.next_ts - f.last_ts < {within_ms}),
starts AS (
  SELECT c.*, g.price AS first_dip, g.ts AS st_ts, g.tid AS st_tid
  FROM cand c JOIN g ON g.symbol = c.symbol AND g.run_no = c.f_run
  WHERE c.b_ts - g.ts < {within_ms}),
c1 AS (
  SELECT * FROM starts
  QUALIFY ROW_NUMBER() OVER (PARTITION BY symbol, f_run ORDER BY st_ts, st_tid) = 1),
c2 AS (
  SELECT *, CASE WHEN LAG(f_run) OVER (PARTITION BY symbol ORDER BY f_run) = f_run - 2 THEN 0 ELSE 1 END AS is_start,
         ROW_NUMBER() OVER (PARTITION BY symbol ORDER BY f_run) AS idx
  FROM c1),
c3 AS (
  SELECT *, MAX(CASE WHEN is_start = 1 THEN idx END) OVER (PARTITION BY symbol ORDER BY f_run
                                                           ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS sidx
  FROM c2)"""


INGEST = """
fa AS (
  SELECT * FROM base
  WHERE (event_type IN ('click', 'purchase') OR (event_type = 'error' AND sym <> 1))
    AND k % 17 <> 0 AND k % 25 NOT IN (5, 6)),
fb AS (
  SELECT * FROM base
  WHERE (event_type IN ('view', 'signup') OR (event_type = 'error' AND sym = 1))
    AND k % 23 <> 0 AND k % 19 <> 0),
pa AS (
  SELECT 'trade' AS event_type, trade_time + k AS event_time, symbol, event_id AS trade_id,
         price, quantity, trade_time, even AS is_buyer_maker, trade_time + 20 + 5 * k AS ingestion_time
  FROM fa WHERE event_type <> 'error'),
pb AS (
  SELECT CAST(event_id AS VARCHAR) AS trade_id, product_id, price, quantity AS size,
         CASE WHEN even THEN 'SELL' ELSE 'BUY' END AS side, trade_time AS event_time,
         trade_time + 20 + 5 * k AS ingestion_time
  FROM fb WHERE event_type <> 'error'),
body_a AS (
  SELECT *, '{"e":"trade","E":' || CAST(trade_time + k AS VARCHAR) || ',"s":"' || symbol || '","t":'
            || CAST(event_id AS VARCHAR) || ',"p":"n/a","q":"' || CAST(quantity AS VARCHAR) || '","T":'
            || CAST(trade_time AS VARCHAR) || ',"m":' || CASE WHEN even THEN 'true' ELSE 'false' END
            || CASE WHEN k % 10 = 3 THEN '' ELSE ',"M":true' END || '}' AS body
  FROM fa WHERE event_type = 'error'),
dead AS (
  SELECT 'raw-binance-trades' AS original_topic, symbol AS original_key,
         CASE WHEN k % 7 = 0 THEN body
              ELSE '{"stream":"' || lower(symbol) || '@trade","data":' || body || '}' END AS payload,
         'invalid_price' AS error, trade_time + 20 + 5 * k AS failed_at
  FROM body_a
  UNION ALL
  SELECT 'raw-coinbase-match', replace(product_id, '-USD', 'USDT'),
         '{"channel":"market_trades","events":[{"type":"' || CASE WHEN k % 5 = 0 THEN 'snapshot' ELSE 'update' END
         || '","trades":[{"trade_id":"' || CAST(event_id AS VARCHAR) || '","product_id":"' || product_id
         || '","price":"' || CAST(CAST(price AS DECIMAL(18,2)) AS VARCHAR) || '","size":"'
         || CAST(quantity AS VARCHAR) || '","side":"' || CASE WHEN even THEN 'SELL' ELSE 'BUY' END
         || '","time":"not-a-time"}]}]}',
         'invalid_time', trade_time + 20 + 5 * k
  FROM fb WHERE event_type = 'error')"""

DB_COLS = ("symbol, ROUND(first_dip, 6) AS first_dip, ROUND(second_dip, 6) AS second_dip, "
           "ROUND(peak_price, 6) AS peak_price, ROUND(breakout_price, 6) AS breakout_price")

# the streamed side holds only windows the final watermark (max time - 10 s) closed
RECON_STREAMED = RECON.replace(
    "FROM vw WHERE window_end <=", "FROM vw WHERE window_end <= (SELECT MAX(trade_time) FROM ta) - 10000 AND window_end <=")

RUN_TIME_MS = 1_706_747_400_000  # 2024-02-01 00:30:00 UTC

ORACLE: dict[str, str] = {
    "stream_vwap": _with(", " + _vwap(3_600_000, "1h").strip() + """
SELECT symbol, window_start, window_end, ROUND(vwap, 6) AS vwap, ROUND(total_volume, 6) AS total_volume,
       trade_count, interval_label, CAST(window_start // 1000 AS BIGINT) AS version FROM vw
WHERE window_end <= (SELECT MAX(trade_time) FROM ta) - 10000"""),

    "stream_whales": _with(f"SELECT {WHALE_COLS_SEC}, CAST(event_time // 1000 AS BIGINT) AS version FROM whales",
                           normalise=False),

    "stream_arbitrage": _with(", " + PAIRS.format(h=600_000).strip() + """
SELECT symbol, ROUND(a_price, 6) AS binance_price, ROUND(b_price, 6) AS coinbase_price,
       ROUND(ABS(a_price - b_price), 6) AS spread, ROUND(ABS(a_price - b_price) / a_price * 100, 6) AS spread_pct,
       CASE WHEN a_price > b_price THEN 'BUY_COINBASE_SELL_BINANCE' ELSE 'BUY_BINANCE_SELL_COINBASE' END AS direction,
       a_time_ms // 1000 * 1000 AS event_time, CAST(a_time_ms // 1000 AS BIGINT) AS version
FROM pairs WHERE a_price <> 0 AND ABS(a_price - b_price) / a_price * 100 > 0.2"""),

    "stream_double_bottom": _with(", " + _pattern(43_200_000).strip() + f"""
SELECT {DB_COLS}, b_ts // 1000 * 1000 AS confirmed_at, CAST(b_ts // 1000 AS BIGINT) AS version
FROM c3 WHERE (idx - sidx) % 2 = 0 AND b_ts < (SELECT MAX(trade_time) FROM ta) - 10000"""),

    "stream_double_bottom_next_row": _with(", " + _pattern(43_200_000).strip() + f"""
SELECT {DB_COLS}, b_ts // 1000 * 1000 AS confirmed_at, CAST(b_ts // 1000 AS BIGINT) AS version
FROM starts WHERE b_ts < (SELECT MAX(trade_time) FROM ta) - 10000"""),

    "stream_lake_a": _with("""
SELECT symbol, ROUND(price, 6) AS price, ROUND(quantity, 6) AS quantity, trade_time, is_buyer_maker,
       ingestion_time FROM raw_a"""),

    "stream_lake_b": _with("""
SELECT trade_id, product_id, ROUND(CAST(price AS DOUBLE), 6) AS price, ROUND(CAST(size AS DOUBLE), 6) AS size,
       side, event_time, ingestion_time FROM tb"""),

    "stream_ingest_a": _with(", " + INGEST.strip() + """
SELECT event_type, event_time, symbol, trade_id, ROUND(CAST(price AS DOUBLE), 6) AS price,
       ROUND(CAST(quantity AS DOUBLE), 6) AS quantity, trade_time, is_buyer_maker, ingestion_time FROM pa"""),

    "stream_dead_letter_b": _with(", " + INGEST.strip() + """
SELECT * FROM dead WHERE original_topic = 'raw-coinbase-match'"""),

    "parse_feed_a": _with(", " + INGEST.strip() + """
SELECT event_type, event_time, symbol, trade_id, ROUND(CAST(price AS DOUBLE), 6) AS price,
       ROUND(CAST(quantity AS DOUBLE), 6) AS quantity, trade_time, is_buyer_maker, ingestion_time FROM pa"""),

    "parse_feed_b": _with(", " + INGEST.strip() + """
SELECT trade_id, product_id, ROUND(CAST(price AS DOUBLE), 6) AS price, ROUND(CAST(size AS DOUBLE), 6) AS size,
       side, event_time, ingestion_time FROM pb"""),

    "dead_letter_rows": _with(", " + INGEST.strip() + """
SELECT * FROM dead"""),

    "latency_stats": _with(", " + INGEST.strip() + """
, lat AS (
  SELECT symbol, 'binance' AS exchange, ingestion_time - trade_time AS l FROM pa
  UNION ALL
  SELECT replace(product_id, '-USD', 'USDT'), 'coinbase', ingestion_time - event_time FROM pb)
SELECT symbol, exchange, COUNT(*) AS trades, MIN(l) AS min_latency_ms, MAX(l) AS max_latency_ms,
       ROUND(AVG(l), 6) AS avg_latency_ms
FROM lat GROUP BY 1, 2"""),

    "double_bottom": _with(", " + _pattern(43_200_000).strip() + f"""
SELECT {DB_COLS}, b_ts AS confirmed_at FROM c3 WHERE (idx - sidx) % 2 = 0"""),

    "double_bottom_default": _with(", " + _pattern(600_000).strip() + f"""
SELECT {DB_COLS}, b_ts AS confirmed_at FROM c3 WHERE (idx - sidx) % 2 = 0"""),

    "arbitrage_signals_default": _with(", " + PAIRS.format(h=10_000).strip() + """
SELECT symbol, ROUND(a_price, 6) AS binance_price, ROUND(b_price, 6) AS coinbase_price,
       ROUND(ABS(a_price - b_price), 6) AS spread, ROUND(ABS(a_price - b_price) / a_price * 100, 6) AS spread_pct,
       CASE WHEN a_price > b_price THEN 'BUY_COINBASE_SELL_BINANCE' ELSE 'BUY_BINANCE_SELL_COINBASE' END AS direction,
       a_time_ms AS event_time
FROM pairs WHERE a_price <> 0 AND ABS(a_price - b_price) / a_price * 100 > 0.2"""),

    "double_bottom_next_row": _with(", " + _pattern(43_200_000).strip() + f"""
SELECT {DB_COLS}, b_ts AS confirmed_at FROM starts"""),

    "double_bottom_latest": _with(", " + _pattern(43_200_000).strip() + f"""
, sig AS (
  SELECT symbol, first_dip, second_dip, peak_price, breakout_price, b_ts // 1000 * 1000 AS confirmed_at,
         CAST(b_ts // 1000 AS BIGINT) AS version FROM starts),
ranked AS (
  SELECT *, ROW_NUMBER() OVER (PARTITION BY symbol, confirmed_at ORDER BY version DESC, first_dip DESC,
                               second_dip DESC, peak_price DESC, breakout_price DESC) AS rn FROM sig)
SELECT {DB_COLS}, confirmed_at, version FROM ranked WHERE rn = 1"""),

    "vwap_by_window": _with(", " + _vwap(3_600_000, "1h").strip() + """
SELECT symbol, window_start, window_end, ROUND(vwap, 6) AS vwap, ROUND(total_volume, 6) AS total_volume,
       trade_count, interval_label FROM vw"""),

    "vwap_result_rows": _with(", " + _vwap(300_000, "5m").strip() + """
SELECT symbol, window_start, window_end, ROUND(vwap, 6) AS vwap, ROUND(total_volume, 6) AS total_volume,
       trade_count, interval_label, CAST(window_start // 1000 AS BIGINT) AS version FROM vw"""),

    "batch_vwap_range": _with("""
SELECT symbol, ROUND(SUM(price * quantity) / NULLIF(SUM(quantity), 0), 6) AS batch_vwap
FROM raw_a WHERE trade_time >= 1704067200000 AND trade_time < 1706745600000 GROUP BY symbol"""),

    "whale_trades": _with(f"SELECT {WHALE_COLS} FROM whales", normalise=False),

    "whale_trades_normalised": _with(f"SELECT {WHALE_COLS} FROM whales"),

    "whale_flags": _with("""
, u AS (
  SELECT symbol, CAST(trade_id AS VARCHAR) AS trade_id, 'binance' AS exchange, CAST(price AS DOUBLE) AS price,
         CAST(quantity AS DOUBLE) AS quantity, CASE WHEN is_buyer_maker THEN 'SELL' ELSE 'BUY' END AS side,
         trade_time AS event_time FROM ta
  UNION ALL
  SELECT replace(product_id, '-USD', 'USDT'), trade_id, 'coinbase', CAST(price AS DOUBLE),
         CAST(size AS DOUBLE), side, event_time FROM tb)
SELECT symbol, trade_id, exchange, ROUND(price, 6) AS price, ROUND(quantity, 6) AS quantity, side, event_time,
       quantity >= CASE symbol WHEN 'BTCUSDT' THEN 5.0 WHEN 'ETHUSDT' THEN 50.0 WHEN 'SOLUSDT' THEN 500.0
                               ELSE 999999.0 END AS is_whale,
       replace(symbol, 'USDT', '') AS base_asset, ROUND(price * quantity, 6) AS trade_value
FROM u"""),

    "interval_join_pairs": _with(", " + PAIRS.format(h=600_000).strip() + """
SELECT symbol, ROUND(a_price, 6) AS a_price, ROUND(b_price, 6) AS b_price, a_time_ms, b_time_ms FROM pairs"""),

    "arbitrage_signals": _with(", " + PAIRS.format(h=600_000).strip() + """
SELECT symbol, ROUND(a_price, 6) AS binance_price, ROUND(b_price, 6) AS coinbase_price,
       ROUND(ABS(a_price - b_price), 6) AS spread, ROUND(ABS(a_price - b_price) / a_price * 100, 6) AS spread_pct,
       CASE WHEN a_price > b_price THEN 'BUY_COINBASE_SELL_BINANCE' ELSE 'BUY_BINANCE_SELL_COINBASE' END AS direction,
       a_time_ms AS event_time
FROM pairs WHERE a_price <> 0 AND ABS(a_price - b_price) / a_price * 100 > 0.2"""),

    "latest_by_key": _with("""
, rows_ AS (
  SELECT symbol, price, quantity, trade_value, exchange, side, event_time // 1000 * 1000 AS event_time,
         CAST(event_time // 1000 AS BIGINT) AS version FROM whales),
ranked AS (
  SELECT *, ROW_NUMBER() OVER (PARTITION BY symbol, event_time
            ORDER BY version DESC, price DESC, quantity DESC, trade_value DESC, exchange DESC, side DESC) AS rn
  FROM rows_)
SELECT """ + WHALE_COLS + """, version FROM ranked WHERE rn = 1"""),

    "top_recent_alerts": _with("""
SELECT """ + WHALE_COLS + """ FROM whales
WHERE event_time >= 1704067200000 AND event_time <= 1706745600000
ORDER BY event_time DESC, symbol DESC, exchange DESC, side DESC, price DESC, quantity DESC LIMIT 100"""),

    "vwap_series": _with(", " + _vwap(3_600_000, "1h").strip() + """
SELECT window_start AS time, concat(symbol, ' VWAP') AS metric, ROUND(vwap, 6) AS vwap FROM vw
WHERE window_start >= 1704067200000 AND window_start <= 1706745600000"""),

    "reconcile": _with(", " + _vwap(300_000, "5m").strip() + ", " + RECON.strip() + f"""
SELECT CAST({RUN_TIME_MS} AS BIGINT) AS run_time, hour_start_ms AS window_start,
       hour_start_ms + 3600000 AS window_end, symbol, ROUND(streaming_vwap, 6) AS streaming_vwap,
       ROUND(batch_vwap, 6) AS batch_vwap, ROUND(diff_pct, 6) AS diff_pct,
       CASE WHEN diff_pct > 0.01 THEN 'ALERT' ELSE 'OK' END AS status,
       CAST({RUN_TIME_MS // 1000} AS BIGINT) AS version
FROM jr WHERE reason IS NULL"""),

    "reconcile_missing": _with(", " + _vwap(300_000, "5m").strip() + ", " + RECON_OUTAGES.strip() + """
SELECT hour_start_ms AS window_start, symbol, ROUND(streaming_vwap, 6) AS streaming_vwap,
       ROUND(batch_vwap, 6) AS batch_vwap, reason FROM jr WHERE reason IS NOT NULL"""),

    "reconcile_streamed": _with(", " + _vwap(300_000, "5m").strip() + ", " + RECON_STREAMED.strip() + f"""
SELECT CAST({RUN_TIME_MS} AS BIGINT) AS run_time, hour_start_ms AS window_start,
       hour_start_ms + 3600000 AS window_end, symbol, ROUND(streaming_vwap, 6) AS streaming_vwap,
       ROUND(batch_vwap, 6) AS batch_vwap, ROUND(diff_pct, 6) AS diff_pct,
       CASE WHEN diff_pct > 0.01 THEN 'ALERT' ELSE 'OK' END AS status,
       CAST({RUN_TIME_MS // 1000} AS BIGINT) AS version
FROM jr WHERE reason IS NULL"""),

    "reconcile_streamed_missing": _with(", " + _vwap(300_000, "5m").strip() + ", " + RECON_STREAMED.strip() + """
SELECT hour_start_ms AS window_start, symbol, ROUND(streaming_vwap, 6) AS streaming_vwap,
       ROUND(batch_vwap, 6) AS batch_vwap, reason FROM jr WHERE reason IS NOT NULL"""),

    "normalise_symbols": _with("SELECT trade_id, product_id, replace(product_id, '-USD', 'USDT') AS symbol FROM tb"),

    "raw_a_projection": _with("""
SELECT symbol, ROUND(price, 6) AS price, ROUND(quantity, 6) AS quantity, trade_time, is_buyer_maker,
       ingestion_time FROM raw_a"""),

    "raw_b_projection": _with("""
SELECT trade_id, product_id, ROUND(CAST(price AS DOUBLE), 6) AS price, ROUND(CAST(size AS DOUBLE), 6) AS size,
       side, event_time, ingestion_time FROM tb"""),
}

_STREAMED_5M = _with(", " + _vwap(300_000, "5m").strip() + """
SELECT symbol, window_start, window_end, ROUND(vwap, 6) AS vwap, ROUND(total_volume, 6) AS total_volume,
       trade_count, interval_label, CAST(window_start // 1000 AS BIGINT) AS version FROM vw
WHERE window_end <= (SELECT MAX(trade_time) FROM ta) - 10000""")

# stored tables: the same rows, written by jobs and read back
ORACLE.update({
    "stream_arbitrage_idle": ORACLE["stream_arbitrage"],
    "catalog_raw_a_range": ORACLE["raw_a_projection"] + " WHERE trade_time >= 1704067200000 AND trade_time < 1706745600000",
    "catalog_result_range": _STREAMED_5M + " AND window_start >= 1704067200000 AND window_end <= 1706745600000",
    "compacted_rows": _STREAMED_5M,
    "reconcile_run": "SELECT window_start, window_end, symbol, streaming_vwap, batch_vwap, diff_pct, status FROM (" + ORACLE["reconcile_streamed"]
                     + f") WHERE window_end <= {RUN_TIME_MS}",
    "stream_latest": ORACLE["latest_by_key"],
    "stored_recent_alerts": "SELECT * EXCLUDE (version) FROM (" + ORACLE["latest_by_key"] + """)
WHERE event_time >= 1704067200000 AND event_time <= 1706745600000
ORDER BY event_time DESC, symbol DESC, exchange DESC, side DESC, price DESC, quantity DESC LIMIT 100""",
    "latency_quantiles": ORACLE["latency_stats"][:ORACLE["latency_stats"].index("SELECT symbol, exchange, COUNT(*)")] + """
SELECT symbol, exchange, COUNT(*) AS trades, quantile_disc(l, 0.5) AS p50, quantile_disc(l, 0.9) AS p90, quantile_disc(l, 0.99) AS p99
FROM lat WHERE l IS NOT NULL GROUP BY 1, 2""",
})
