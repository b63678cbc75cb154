"""Defaults of every operator.

Fixed values: these must equal the behaviour being reproduced, so they are
stated here once, as plain text, and every operator takes them as overridable
parameters.
"""

from __future__ import annotations

# --- fixed values -----------------------------------------------------------
# Large-trade thresholds per symbol, inclusive (quantity >= threshold).
WHALE_THRESHOLDS = {"BTCUSDT": 5.0, "ETHUSDT": 50.0, "SOLUSDT": 500.0}
# Threshold used by the ingest-time flag for symbols not in the table above.
UNKNOWN_SYMBOL_THRESHOLD = 999999.0

VWAP_WINDOW = "5 minutes"          # tumbling, epoch aligned, [start, end)
VWAP_INTERVAL_LABEL = "5m"
WATERMARK_DELAY = "10 seconds"     # max event time - delay
JOIN_HALF_WIDTH_MS = 10_000        # venue B time within venue A time +- 10 s, ends included
SPREAD_PCT_MIN = 0.2               # keep spread_pct > 0.2 (strict)
PATTERN_WITHIN_MS = 600_000        # double bottom: break.ts - start.ts < 10 min
RECON_DIFF_PCT = 0.01              # ALERT when diff_pct > 0.01

EXCHANGE_A = "binance"
EXCHANGE_B = "coinbase"
DIRECTION_B_CHEAPER = "BUY_COINBASE_SELL_BINANCE"   # venue A price > venue B price
DIRECTION_A_CHEAPER = "BUY_BINANCE_SELL_COINBASE"
STATUS_OK = "OK"
STATUS_ALERT = "ALERT"

# Symbol normalisation of venue B product ids: plain substring replacement.
NORMALISE_FROM = "-USD"
NORMALISE_TO = "USDT"
BASE_ASSET_SUFFIX = "USDT"

# Raw message vocabulary.
FEED_A_EVENT = "trade"
FEED_B_CHANNEL = "market_trades"
FEED_B_EVENT_TYPES = ("update", "snapshot")
TOPIC_A = "raw-binance-trades"
TOPIC_B = "raw-coinbase-match"
PRICE_DECIMAL = "decimal(18,8)"
# --- end of fixed values ----------------------------------------------------

# Size of the latency quantile sketches (not a fixed value of the behaviour being reproduced).
LATENCY_SKETCH_K = 4096
