"""Raw JSON messages -> typed trade rows plus dead-letter rows.

Input: a DataFrame (batch or stream) with ``value`` (message text) and
``received_at`` (epoch ms of arrival, the ingestion stamp). Both parsers are
map-only (``from_json``, ``explode``), so they scale with the input and add
no shuffle. ``parsed_feed_a/_b`` give one frame with an ``error`` column, in
which each message is parsed once; ``split_feed_a/_b`` cut it into ``(trades,
dead_letters)`` by two filters. A caller that writes both persists the frame in
between; ``parse_feed_a/_b`` do both steps.

Rules (venue A): the trade object is ``data`` when the message has that key,
else the message itself; only ``e = "trade"`` is kept; an ``M`` flag that is
present and falsy (false, null, 0, "") drops the row, a missing one and any
other text keep it.
Venue B: only channel ``market_trades``; events of type ``update`` or
``snapshot``; every trade of such an event is one row, symbols are not
changed (``product_id`` is kept as sent).

Rows that are skipped by these rules are dropped silently. Rows that fail to
parse (broken JSON, a missing field, a price, size or time that is not valid)
go to the dead-letter output with the whole message as payload; a bad event or
trade does not take its good siblings of the same message with it. A time must
have a date.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark import config as C
from tidemark.functions.columns import normalise_symbol

_MAP = "map<string,string>"
# nested values are kept as JSON text and parsed one by one, so that a bad
# element does not take its siblings with it
_B_MESSAGE = "struct<channel:string,events:array<string>,_corrupt:string>"
_B_EVENT = "struct<type:string,trades:array<string>,_corrupt:string>"
_B_OPTIONS = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt"}

ERR_JSON = "malformed_json"
ERR_PRICE = "invalid_price"
ERR_QTY = "invalid_quantity"
ERR_TIME = "invalid_time"


def _once(df: DataFrame, expr: Column, name: str) -> DataFrame:
    """Add ``expr`` as column ``name``, evaluated once per row.

    A parsed JSON value is referenced by many filters and checks; as a plain
    alias the optimizer would inline (and re-parse) it at each reference. As
    the output of a generator it is computed once and then only read."""
    return df.select("*", F.inline(F.array(F.struct(expr.alias(name)))))


def _missing(m: Column, name: str) -> Column:
    return ~F.map_contains_key(m, F.lit(name)) | m[name].isNull()


def _truthy(v: Column, body: Column, name: str) -> Column:
    """JSON truthiness of the top-level value ``name`` of ``body``, given as text ``v``: of texts only the
    empty one is falsy, of literals null, false, any zero, and empty lists and objects. Only a value that reads like
    a falsy literal is looked up again, to tell whether it is a text."""
    zero = F.coalesce(v.try_cast("double") == 0, F.lit(False))
    kind = F.schema_of_variant(F.try_variant_get(F.try_parse_json(body), f"$.{name}", "variant"))
    return v.isNotNull() & (v != "") & F.when(v.isin("false", "[]", "{}") | zero, F.coalesce(kind == "STRING", F.lit(False))).otherwise(True)


def _first_error(checks: list[tuple[Column, str]]) -> Column:
    out = F.lit(None).cast("string")
    for cond, msg in reversed(checks):
        out = F.when(cond, F.lit(msg)).otherwise(out)
    return out


def _dead(df: DataFrame, topic: str, key: Column) -> DataFrame:
    return df.select(
        F.lit(topic).alias("original_topic"), key.alias("original_key"),
        F.col("value").alias("payload"), F.col("error"),
        F.col("received_at").alias("failed_at"))


def _stamp(stamp_now: bool) -> Column:
    """Ingestion time = the source's arrival time, or processing time."""
    return F.unix_millis(F.current_timestamp()) if stamp_now else F.col("received_at")


def parsed_feed_a(raw: DataFrame, *, stamp_now: bool = False) -> DataFrame:
    """Venue A messages as typed rows with ``error`` (null: a trade)."""
    df = _once(raw.select("value", "received_at"), F.from_json(F.col("value"), _MAP), "_top")
    body = F.when(F.map_contains_key(F.col("_top"), F.lit("data")), F.col("_top")["data"]).otherwise(F.col("value"))
    df = _once(df, F.when(F.col("_top").isNotNull(), F.from_json(body, _MAP)), "_d")
    d = F.col("_d")
    keep = (F.col("_top").isNull() | d.isNull()
            | ((d["e"] == C.FEED_A_EVENT)
               & (~F.map_contains_key(d, F.lit("M")) | _truthy(d["M"], body, "M"))))
    df = df.where(keep)
    typed = df.select(
        "value", "received_at", "_top", "_d",
        d["e"].alias("event_type"),
        F.expr("try_cast(_d['E'] AS BIGINT)").alias("event_time"),
        d["s"].alias("symbol"),
        F.expr("try_cast(_d['t'] AS BIGINT)").alias("trade_id"),
        F.expr(f"try_cast(_d['p'] AS {C.PRICE_DECIMAL})").alias("price"),
        F.expr(f"try_cast(_d['q'] AS {C.PRICE_DECIMAL})").alias("quantity"),
        F.expr("try_cast(_d['T'] AS BIGINT)").alias("trade_time"),
        F.expr("try_cast(_d['m'] AS BOOLEAN)").alias("is_buyer_maker"),
        _stamp(stamp_now).alias("ingestion_time"))
    checks = [(F.col("_top").isNull() | d.isNull(), ERR_JSON)]
    for f, col in (("E", "event_time"), ("s", "symbol"), ("t", "trade_id"), ("T", "trade_time"),
                   ("m", "is_buyer_maker")):
        checks.append((_missing(d, f) | F.col(col).isNull(), f"missing_field:{f}"))
    checks += [(F.col("price").isNull(), ERR_PRICE), (F.col("quantity").isNull(), ERR_QTY)]
    return typed.withColumn("error", _first_error(checks)).drop("_top", "_d")


def split_feed_a(parsed: DataFrame, *, topic: str = C.TOPIC_A) -> tuple[DataFrame, DataFrame]:
    """``parsed_feed_a`` rows -> (``trades_a`` rows, dead letters)."""
    trades = parsed.where(F.col("error").isNull()).select(
        "event_type", "event_time", "symbol", "trade_id", "price", "quantity", "trade_time",
        "is_buyer_maker", "ingestion_time")
    return trades, _dead(parsed.where(F.col("error").isNotNull()), topic, F.col("symbol"))


def parse_feed_a(raw: DataFrame, *, topic: str = C.TOPIC_A,
                 stamp_now: bool = False) -> tuple[DataFrame, DataFrame]:
    """Venue A messages -> (``trades_a`` rows, dead letters)."""
    return split_feed_a(parsed_feed_a(raw, stamp_now=stamp_now), topic=topic)


def parsed_feed_b(raw: DataFrame, *, stamp_now: bool = False) -> DataFrame:
    """Venue B messages as one typed row per trade with ``error`` (null: a
    trade); a broken message, event or trade is one row with an error."""
    df = _once(raw.select("value", "received_at"), F.from_json(F.col("value"), _B_MESSAGE, _B_OPTIONS), "_m")
    broken = F.col("_m").isNull() | F.col("_m._corrupt").isNotNull()
    ev = (df.withColumn("_bad", broken).where(F.col("_bad") | (F.col("_m.channel") == C.FEED_B_CHANNEL))
            .select("value", "received_at", "_bad", F.posexplode_outer(F.when(~F.col("_bad"), F.col("_m.events"))).alias("_i", "_es"))
            .where(F.col("_bad") | F.col("_i").isNotNull()))
    ev = _once(ev, F.when(~F.col("_bad"), F.from_json(F.col("_es"), _B_EVENT, _B_OPTIONS)), "_e")
    not_event = F.col("_e").isNull() | F.col("_e._corrupt").isNotNull()
    tr = (ev.withColumn("_bad", F.col("_bad") | not_event).where(F.col("_bad") | F.col("_e.type").isin(*C.FEED_B_EVENT_TYPES))
            .select("value", "received_at", "_bad", F.posexplode_outer(F.when(~F.col("_bad"), F.col("_e.trades"))).alias("_j", "_ts"))
            .where(F.col("_bad") | F.col("_j").isNotNull()))
    tr = _once(tr, F.when(~F.col("_bad"), F.from_json(F.col("_ts"), _MAP)), "_t")
    t = F.col("_t")
    # a time of day alone would be read as today's
    ts = F.when(t["time"].rlike(r"^\s*\d{4}-\d{1,2}-\d{1,2}[T ]"), F.expr("try_to_timestamp(_t['time'])"))
    typed = tr.select(
        "value", "received_at", "_t",
        t["trade_id"].alias("trade_id"),
        t["product_id"].alias("product_id"),
        F.expr(f"try_cast(_t['price'] AS {C.PRICE_DECIMAL})").alias("price"),
        F.expr(f"try_cast(_t['size'] AS {C.PRICE_DECIMAL})").alias("size"),
        t["side"].alias("side"),
        F.unix_millis(ts).alias("event_time"),
        _stamp(stamp_now).alias("ingestion_time"))
    checks = [(t.isNull(), ERR_JSON)]
    for f in ("trade_id", "product_id", "side"):
        checks.append((_missing(t, f), f"missing_field:{f}"))
    checks += [(_missing(t, "time"), "missing_field:time"),
               (F.col("price").isNull(), ERR_PRICE), (F.col("size").isNull(), ERR_QTY),
               (F.col("event_time").isNull(), ERR_TIME)]
    return typed.withColumn("error", _first_error(checks)).drop("_t")


def split_feed_b(parsed: DataFrame, *, topic: str = C.TOPIC_B) -> tuple[DataFrame, DataFrame]:
    """``parsed_feed_b`` rows -> (``trades_b`` rows, dead letters)."""
    trades = parsed.where(F.col("error").isNull()).select(
        "trade_id", "product_id", "price", "size", "side", "event_time", "ingestion_time")
    return trades, _dead(parsed.where(F.col("error").isNotNull()), topic, normalise_symbol("product_id"))


def parse_feed_b(raw: DataFrame, *, topic: str = C.TOPIC_B,
                 stamp_now: bool = False) -> tuple[DataFrame, DataFrame]:
    """Venue B messages -> (``trades_b`` rows, dead letters)."""
    return split_feed_b(parsed_feed_b(raw, stamp_now=stamp_now), topic=topic)


def latency(trades_a: DataFrame | None = None, trades_b: DataFrame | None = None) -> DataFrame:
    """Per-trade latency = ingestion time - event time (ms), I12. Venue A uses
    its trade time; venue B symbols are normalised."""
    return _latency_at(trades_a, trades_b).drop("time_ms")


def _latency_at(trades_a: DataFrame | None, trades_b: DataFrame | None) -> DataFrame:
    """``latency`` with the event time as ``time_ms``."""
    parts = []
    if trades_a is not None:
        parts.append(trades_a.select(
            "symbol", F.lit(C.EXCHANGE_A).alias("exchange"),
            (F.col("ingestion_time") - F.col("trade_time")).alias("latency_ms"), F.col("trade_time").alias("time_ms")))
    if trades_b is not None:
        parts.append(trades_b.select(
            normalise_symbol("product_id").alias("symbol"), F.lit(C.EXCHANGE_B).alias("exchange"),
            (F.col("ingestion_time") - F.col("event_time")).alias("latency_ms"), F.col("event_time").alias("time_ms")))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def latency_sketches(trades_a: DataFrame | None = None, trades_b: DataFrame | None = None, *, window: str = "1 hour",
                     k: int = C.LATENCY_SKETCH_K) -> DataFrame:
    """One quantile sketch (KLL) of the latencies per symbol, venue and event-time window: symbol, exchange,
    window_start, trades, sketch. Sketches are partial per input partition and merge, so a
    hot symbol ships one sketch per window and partition; rows with a null latency are left out. Sketches of
    windows can be stored and merged later (``latency_quantiles``)."""
    rows = _latency_at(trades_a, trades_b).where("latency_ms IS NOT NULL")
    return (rows.groupBy("symbol", "exchange", F.window(F.timestamp_millis("time_ms"), window).alias("w"))
            .agg(F.count(F.lit(1)).alias("trades"), F.kll_sketch_agg_bigint("latency_ms", k).alias("sketch"))
            .select("symbol", "exchange", F.col("w.start").alias("window_start"), "trades", "sketch"))


def latency_quantiles(sketches: DataFrame, quantiles: tuple[float, ...] = (0.5, 0.9, 0.99), *,
                      k: int = C.LATENCY_SKETCH_K) -> DataFrame:
    """Quantiles per symbol and venue over all windows, from the merged sketches: columns p50, p90, p99 and so on.
    Exact up to ``k`` trades; beyond, the rank of an answer is off by about 2 / k of all trades at most
    (with 99 % confidence)."""
    merged = sketches.groupBy("symbol", "exchange").agg(F.sum("trades").alias("trades"), F.kll_merge_agg_bigint("sketch", k).alias("sketch"))
    return merged.select("symbol", "exchange", "trades", *[
        F.kll_sketch_get_quantile_bigint("sketch", F.lit(float(q))).alias(f"p{100 * q:g}".replace(".", "_")) for q in quantiles])


def latency_stats(trades_a: DataFrame | None = None, trades_b: DataFrame | None = None) -> DataFrame:
    """Count, min, max and mean latency per symbol and venue (partial
    aggregation; no per-group value lists)."""
    return (latency(trades_a, trades_b)
            .groupBy("symbol", "exchange")
            .agg(F.count(F.lit(1)).alias("trades"),
                 F.min("latency_ms").alias("min_latency_ms"),
                 F.max("latency_ms").alias("max_latency_ms"),
                 F.avg("latency_ms").alias("avg_latency_ms")))
