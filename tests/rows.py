"""Builders of small typed trade tables for the unit tests."""

from __future__ import annotations

from decimal import Decimal

from tidemark import schemas


def D(x) -> Decimal:
    return Decimal(str(x))


def trades_a(spark, rows):
    """rows: (symbol, trade_time_ms, trade_id, price, quantity[, is_buyer_maker])."""
    data = []
    for r in rows:
        sym, t, tid, p, q = r[:5]
        maker = r[5] if len(r) > 5 else False
        data.append(("trade", t, sym, tid, None if p is None else D(p), None if q is None else D(q),
                     t, maker, t + 5))
    return spark.createDataFrame(data, schemas.TRADES_A)


def trades_b(spark, rows):
    """rows: (product_id, event_time_ms, trade_id, price, size[, side])."""
    data = []
    for r in rows:
        pid, t, tid, p, q = r[:5]
        side = r[5] if len(r) > 5 else "BUY"
        data.append((str(tid), pid, D(p), D(q), side, t, t + 5))
    return spark.createDataFrame(data, schemas.TRADES_B)
