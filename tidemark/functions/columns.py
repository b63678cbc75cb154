"""Scalar column expressions (all JVM-side, codegen friendly)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidemark import config as C


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def as_double(x) -> Column:
    """Decimal -> double; all arithmetic runs on doubles."""
    return _c(x).cast("double")


def ms_to_ts(x) -> Column:
    """Epoch milliseconds -> instant (session zone is UTC)."""
    return F.timestamp_millis(_c(x))


def ts_to_ms(x) -> Column:
    """Instant -> epoch milliseconds, sub-millisecond digits truncated."""
    return F.unix_millis(_c(x).cast("timestamp"))


def to_second(x) -> Column:
    """Truncate an instant to whole seconds (result tables keep seconds)."""
    return F.date_trunc("second", _c(x))


def version_of(ts) -> Column:
    """Version of a result row: epoch seconds of its key time."""
    return F.unix_seconds(to_second(ts))


def side_from_maker(is_buyer_maker) -> Column:
    """Venue A side: buyer is maker -> SELL, otherwise (null too) BUY."""
    return F.when(_c(is_buyer_maker), F.lit("SELL")).otherwise(F.lit("BUY"))


def normalise_symbol(product_id, src: str = C.NORMALISE_FROM, dst: str = C.NORMALISE_TO) -> Column:
    """Venue B product id -> venue A symbol by substring replacement
    (``BTC-USD`` -> ``BTCUSDT``; ``BTC-USDC`` -> ``BTCUSDTC``)."""
    return F.replace(_c(product_id), F.lit(src), F.lit(dst))


def base_asset(symbol) -> Column:
    return F.replace(_c(symbol), F.lit(C.BASE_ASSET_SUFFIX), F.lit(""))


def safe_div(a, b) -> Column:
    """Division that yields null on a zero divisor (ANSI mode would raise)."""
    return F.try_divide(_c(a), _c(b))


def spread(pa, pb) -> Column:
    return F.abs(_c(pa) - _c(pb))


def spread_pct(pa, pb) -> Column:
    return safe_div(spread(pa, pb), _c(pa)) * F.lit(100.0)


def direction(pa, pb) -> Column:
    return (F.when(_c(pa) > _c(pb), F.lit(C.DIRECTION_B_CHEAPER))
            .otherwise(F.lit(C.DIRECTION_A_CHEAPER)))


def metric_label(symbol, suffix: str = " VWAP") -> Column:
    return F.concat(_c(symbol), F.lit(suffix))


def half_open(col, start, end) -> Column:
    """start <= col < end."""
    return (_c(col) >= start) & (_c(col) < end)


def closed(col, start, end) -> Column:
    """start <= col <= end."""
    return _c(col).between(start, end)
