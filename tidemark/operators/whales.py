"""Large-trade ("whale") detection over both venues."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark import config as C
from tidemark.functions.columns import (as_double, base_asset, ms_to_ts, normalise_symbol,
                                        side_from_maker, version_of)

_LIMIT = "decimal(38,18)"


def _reaches(symbol: Column, qty: Column, thresholds: dict[str, float]) -> Column:
    """``qty >= thresholds[symbol]`` in decimals, the same form for any number of
    symbols. The first two tests follow from the third; they are what a Parquet
    reader can evaluate (pushed filters). Symbols not in the table never pass."""
    if not thresholds:
        return F.lit(False)
    limits = {s: Decimal(str(t)) for s, t in thresholds.items()}
    pairs = [x for s, t in limits.items() for x in (F.lit(s), F.lit(t).cast(_LIMIT))]
    return ((qty >= F.lit(min(limits.values()))) & symbol.isin(*limits)
            & (qty >= F.try_element_at(F.create_map(*pairs), symbol)))


def _preimages(symbol: str) -> list[str]:
    """Every product id that normalises to ``symbol``."""
    places = [i for i in range(len(symbol)) if symbol.startswith(C.NORMALISE_TO, i)]
    ids = {symbol}
    for i in reversed(places):  # from the right, so that the places before stay valid
        ids |= {x[:i] + C.NORMALISE_FROM + x[i + len(C.NORMALISE_TO):] for x in ids if x.startswith(C.NORMALISE_TO, i)}
    return sorted(x for x in ids if x.replace(C.NORMALISE_FROM, C.NORMALISE_TO) == symbol)


def _threshold_lookup(symbol: Column, thresholds: dict[str, float]) -> Column:
    pairs = []
    for s, t in thresholds.items():
        pairs += [F.lit(s), F.lit(float(t))]
    return F.try_element_at(F.create_map(*pairs), symbol)


def whale_union(trades_a: DataFrame, trades_b: DataFrame, *, normalise: bool = False) -> DataFrame:
    """Both venues in one 7-column shape (U1): symbol, price, quantity,
    trade_value, exchange, side, event_time (venue A uses its trade time)."""
    a = trades_a.select(
        F.col("symbol"),
        as_double("price").alias("price"),
        as_double("quantity").alias("quantity"),
        (as_double("price") * as_double("quantity")).alias("trade_value"),
        F.lit(C.EXCHANGE_A).alias("exchange"),
        side_from_maker("is_buyer_maker").alias("side"),
        ms_to_ts("trade_time").alias("event_time"),
    )
    sym_b = normalise_symbol("product_id") if normalise else F.col("product_id")
    b = trades_b.select(
        sym_b.alias("symbol"),
        as_double("price").alias("price"),
        as_double("size").alias("quantity"),
        (as_double("price") * as_double("size")).alias("trade_value"),
        F.lit(C.EXCHANGE_B).alias("exchange"),
        F.col("side").cast("string").alias("side"),
        ms_to_ts("event_time").alias("event_time"),
    )
    return a.unionByName(b)


def whale_trades(trades_a: DataFrame, trades_b: DataFrame, *,
                 thresholds: dict[str, float] | None = None,
                 normalise: bool = False) -> DataFrame:
    """Trades whose quantity reaches the symbol's threshold (X9), inclusive.

    ``normalise=False`` reproduces the reference text: venue B rows keep their
    product id (``BTC-USD``) and so never match a threshold symbol.
    ``normalise=True`` maps them to venue A symbols first.

    The threshold test is applied to each venue's raw columns before the union:
    symbol (venue B: the product ids that normalise to it) and least quantity
    reach both Parquet scans as pushed filters; the job is map-only."""
    thr = C.WHALE_THRESHOLDS if thresholds is None else thresholds
    a = trades_a.where(_reaches(F.col("symbol"), F.col("quantity"), thr))
    thr_b = {p: t for s, t in thr.items() for p in _preimages(s)} if normalise else thr
    b = trades_b.where(_reaches(F.col("product_id"), F.col("size"), thr_b))
    return whale_union(a, b, normalise=normalise)


def whale_alert_rows(whales: DataFrame) -> DataFrame:
    """``whale_alerts`` result rows: event time cut to seconds, version added."""
    return whales.select(
        "symbol", "price", "quantity", "trade_value", "exchange", "side",
        F.date_trunc("second", "event_time").alias("event_time"),
        version_of("event_time").alias("version"))


def whale_flags(trades_a: DataFrame, trades_b: DataFrame, *,
                thresholds: dict[str, float] | None = None,
                unknown_threshold: float = C.UNKNOWN_SYMBOL_THRESHOLD) -> DataFrame:
    """Ingest-time flag on every trade of both venues (I13, I14): venue B
    symbols normalised; a symbol missing from the table uses
    ``unknown_threshold``. Adds ``base_asset`` and the dollar ``trade_value``."""
    thr = C.WHALE_THRESHOLDS if thresholds is None else thresholds
    a = trades_a.select(
        "symbol", F.col("trade_id").cast("string").alias("trade_id"),
        F.lit(C.EXCHANGE_A).alias("exchange"),
        as_double("price").alias("price"), as_double("quantity").alias("quantity"),
        side_from_maker("is_buyer_maker").alias("side"),
        F.col("trade_time").alias("event_time"))
    b = trades_b.select(
        normalise_symbol("product_id").alias("symbol"), "trade_id",
        F.lit(C.EXCHANGE_B).alias("exchange"),
        as_double("price").alias("price"), as_double("size").alias("quantity"),
        "side", "event_time")
    u = a.unionByName(b)
    limit = F.coalesce(_threshold_lookup(F.col("symbol"), thr), F.lit(float(unknown_threshold)))
    return u.select(
        "*",
        (F.col("quantity") >= limit).alias("is_whale"),
        base_asset("symbol").alias("base_asset"),
        (F.col("price") * F.col("quantity")).alias("trade_value"))
