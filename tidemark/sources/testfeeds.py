"""Trade feeds derived from the driver's ``events`` table.

The given tables hold no trades, so both venues are derived row by row from
``events`` (a map-only projection; its work grows with the table):

* symbol by ``user_id % 3`` (BTCUSDT, ETHUSDT, SOLUSDT); venue B product id
  ``BTC-USD`` ...
* ``k`` = ``props.$.k``; price = ``100 + value`` (2 decimals);
  quantity = ``(k + 1) * {0.1, 1, 10}`` by symbol
* ``is_buyer_maker`` = ``event_id`` even; venue B side SELL when even
* venue A = ``click``/``purchase`` rows, venue B = ``view``/``signup`` rows,
  ``error`` rows are the malformed messages of the raw feeds
* trade time = ``ts`` in epoch ms; event time (A) = trade time + k ms;
  ingestion time = trade time + 20 + 5k ms

``raw_feed_a`` / ``raw_feed_b`` render the same rows as the JSON text the two
venues send, with deterministic variations (envelope, ``M`` flag, other event
types and channels, bad numbers and times) to exercise the ingest operators.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# bump when the derivation below changes (staged copies are keyed by it)
DERIVATION_VERSION = "1"

VENUE_A_TYPES = ("click", "purchase")
VENUE_B_TYPES = ("view", "signup")
SYMBOLS = ("BTCUSDT", "ETHUSDT", "SOLUSDT")
PRODUCTS = ("BTC-USD", "ETH-USD", "SOL-USD")


def read_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/events.parquet")


def _k() -> Column:
    return F.get_json_object("props", "$.k").cast("int")


def _pick(values: tuple[str, ...]) -> Column:
    return F.element_at(F.array(*[F.lit(v) for v in values]), F.pmod("user_id", F.lit(3)).cast("int") + 1)


def _base(events: DataFrame) -> DataFrame:
    return events.select(
        "event_id", "event_type",
        F.unix_millis(F.col("ts").cast("timestamp")).alias("trade_time"),
        _k().alias("k"),
        F.pmod("user_id", F.lit(3)).cast("int").alias("sym"),
        _pick(SYMBOLS).alias("symbol"),
        _pick(PRODUCTS).alias("product_id"),
        (F.col("value").cast("decimal(18,2)") + F.lit(100)).cast("decimal(18,8)").alias("price"),
        F.expr("CAST((CAST(get_json_object(props, '$.k') AS INT) + 1) * "
               "CASE pmod(user_id, 3) WHEN 0 THEN 0.1 WHEN 1 THEN 1.0 ELSE 10.0 END "
               "AS DECIMAL(18,8))").alias("quantity"),
        (F.pmod("event_id", F.lit(2)) == 0).alias("even"),
    )


def trades_a(events: DataFrame) -> DataFrame:
    """Venue A typed trades (schema ``TRADES_A``)."""
    b = _base(events).where(F.col("event_type").isin(*VENUE_A_TYPES))
    return b.select(
        F.lit("trade").alias("event_type"),
        (F.col("trade_time") + F.col("k")).alias("event_time"),
        "symbol",
        F.col("event_id").alias("trade_id"),
        "price", "quantity", "trade_time",
        F.col("even").alias("is_buyer_maker"),
        (F.col("trade_time") + 20 + 5 * F.col("k")).alias("ingestion_time"),
    )


def trades_b(events: DataFrame) -> DataFrame:
    """Venue B typed trades (schema ``TRADES_B``)."""
    b = _base(events).where(F.col("event_type").isin(*VENUE_B_TYPES))
    return b.select(
        F.col("event_id").cast("string").alias("trade_id"),
        "product_id", "price",
        F.col("quantity").alias("size"),
        F.when(F.col("even"), F.lit("SELL")).otherwise(F.lit("BUY")).alias("side"),
        F.col("trade_time").alias("event_time"),
        (F.col("trade_time") + 20 + 5 * F.col("k")).alias("ingestion_time"),
    )


def _q(x) -> Column:
    """JSON string literal of a column (values here need no escaping)."""
    return F.concat(F.lit('"'), x, F.lit('"'))


def raw_feed_a(events: DataFrame) -> DataFrame:
    """Venue A raw messages: ``value`` (JSON text), ``received_at`` (ms).

    Variations by ``k``: no envelope when k % 7 = 0; ``e`` = aggTrade when
    k % 17 = 0; ``M`` omitted when k % 10 = 3, false when k % 25 = 5, null when
    k % 25 = 6; ``error`` rows with ``user_id % 3 <> 1`` carry a price that is
    not a number."""
    b = _base(events).where(
        F.col("event_type").isin(*VENUE_A_TYPES)
        | ((F.col("event_type") == "error") & (F.col("sym") != 1)))
    k = F.col("k")
    price = F.when(F.col("event_type") == "error", F.lit("n/a")).otherwise(F.col("price").cast("decimal(18,2)").cast("string"))
    m = (F.when(k % 10 == 3, F.lit(""))
         .when(k % 25 == 5, F.lit(',"M":false'))
         .when(k % 25 == 6, F.lit(',"M":null'))
         .otherwise(F.lit(',"M":true')))
    body = F.concat(
        F.lit('{"e":'), _q(F.when(k % 17 == 0, F.lit("aggTrade")).otherwise(F.lit("trade"))),
        F.lit(',"E":'), (F.col("trade_time") + k).cast("string"),
        F.lit(',"s":'), _q(F.col("symbol")),
        F.lit(',"t":'), F.col("event_id").cast("string"),
        F.lit(',"p":'), _q(price),
        F.lit(',"q":'), _q(F.col("quantity").cast("string")),
        F.lit(',"T":'), F.col("trade_time").cast("string"),
        F.lit(',"m":'), F.when(F.col("even"), F.lit("true")).otherwise(F.lit("false")),
        m, F.lit("}"))
    value = F.when(k % 7 == 0, body).otherwise(
        F.concat(F.lit('{"stream":'), _q(F.concat(F.lower(F.col("symbol")), F.lit("@trade"))),
                 F.lit(',"data":'), body, F.lit("}")))
    return b.select(value.alias("value"),
                    (F.col("trade_time") + 20 + 5 * k).alias("received_at"))


def raw_feed_b(events: DataFrame) -> DataFrame:
    """Venue B raw messages: one trade per message.

    Variations by ``k``: event type ``snapshot`` when k % 5 = 0, ``heartbeat``
    (skipped) when k % 19 = 0; channel ``subscriptions`` (skipped) when
    k % 23 = 0; ``error`` rows with ``user_id % 3 = 1`` carry a bad time."""
    b = _base(events).where(
        F.col("event_type").isin(*VENUE_B_TYPES)
        | ((F.col("event_type") == "error") & (F.col("sym") == 1)))
    k = F.col("k")
    iso = F.when(F.col("event_type") == "error", F.lit("not-a-time")).otherwise(
        F.date_format(F.timestamp_millis(F.col("trade_time")), "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'"))
    trade = F.concat(
        F.lit('{"trade_id":'), _q(F.col("event_id").cast("string")),
        F.lit(',"product_id":'), _q(F.col("product_id")),
        F.lit(',"price":'), _q(F.col("price").cast("decimal(18,2)").cast("string")),
        F.lit(',"size":'), _q(F.col("quantity").cast("string")),
        F.lit(',"side":'), _q(F.when(F.col("even"), F.lit("SELL")).otherwise(F.lit("BUY"))),
        F.lit(',"time":'), _q(iso), F.lit("}"))
    etype = (F.when(k % 19 == 0, F.lit("heartbeat"))
             .when(k % 5 == 0, F.lit("snapshot")).otherwise(F.lit("update")))
    channel = F.when(k % 23 == 0, F.lit("subscriptions")).otherwise(F.lit("market_trades"))
    value = F.concat(F.lit('{"channel":'), _q(channel),
                     F.lit(',"events":[{"type":'), _q(etype),
                     F.lit(',"trades":['), trade, F.lit("]}]}"))
    return b.select(value.alias("value"),
                    (F.col("trade_time") + 20 + 5 * k).alias("received_at"))


def load(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    # ``events.ts`` has no zone; it is read as UTC like every time here.
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    ev = read_events(spark, sf_dir)
    return {"events": ev, "trades_a": trades_a(ev), "trades_b": trades_b(ev)}
