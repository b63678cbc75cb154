"""Streaming double bottom (C1 on a stream): a per-symbol stateful matcher.

Same semantics as ``operators.double_bottom``. Rows become *final* when the
watermark passes them (time < watermark); later rows are only ever newer, so
the final prefix of a symbol's sequence is fixed and can be matched. Start
rows are tried in order; an attempt that runs off the end of the final rows
is *undecided* unless the time limit already rules it out, and scanning
stops there until more rows are final.

State per symbol: the rows from the context row before the first undecided
start onwards (all within the time limit of the newest final row) plus rows
not yet final. It is bounded by trade rate x (limit + watermark delay), not
by history. Each micro-batch hands a symbol's new rows to one task, so the
work per task is bounded by the trigger interval. An event-time timeout
brings a symbol back when the watermark passes its oldest pending row, even
without new input for it.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from tidemark import config as C

OUTPUT_SCHEMA = T.StructType([
    T.StructField("symbol", T.StringType()),
    T.StructField("first_dip", T.DoubleType()),
    T.StructField("second_dip", T.DoubleType()),
    T.StructField("peak_price", T.DoubleType()),
    T.StructField("breakout_price", T.DoubleType()),
    T.StructField("confirmed_at", T.TimestampType()),
    T.StructField("confirmed_at_ms", T.LongType()),
])

STATE_SCHEMA = T.StructType([
    T.StructField("ts", T.ArrayType(T.LongType())),
    T.StructField("tid", T.ArrayType(T.LongType())),
    T.StructField("price", T.ArrayType(T.DoubleType())),
    T.StructField("n_final", T.LongType()),
])

MATCH, NOMATCH, UNDECIDED = 0, 1, 2


def _attempt(ts, p, s: int, n: int, within_ms: int):
    """Try a match starting at row ``s`` over the first ``n`` (final) rows."""
    def fall(i):
        return p[i] < p[i - 1]

    def rise(i):
        return p[i] > p[i - 1]

    def off_end():
        return (NOMATCH, None) if ts[n - 1] - ts[s] >= within_ms else (UNDECIDED, None)

    if s < 1 or not fall(s):
        return NOMATCH, None
    i = s
    while i < n and fall(i):
        i += 1
    if i >= n:
        return off_end()
    if not rise(i):
        return NOMATCH, None
    pk_first = i
    while i < n and rise(i):
        i += 1
    if i >= n:
        return off_end()
    if not fall(i):
        return NOMATCH, None
    pk_last = i - 1
    while i < n and fall(i):
        i += 1
    if i >= n:
        return off_end()
    if p[i] > p[pk_first] and ts[i] - ts[s] < within_ms:
        return MATCH, (s, pk_last, i - 1, i)
    return NOMATCH, None


def scan(ts, p, n: int, within_ms: int, after_match: str):
    """Decide starts 1.. in order. Returns (matches, first undecided start)."""
    out = []
    s = 1
    while s < n:
        res, m = _attempt(ts, p, s, n, within_ms)
        if res == UNDECIDED:
            break
        if res == MATCH:
            out.append(m)
            s = m[3] + 1 if after_match == "past_last_row" else s + 1
        else:
            s += 1
    return out, s


def make_matcher(within_ms: int = C.PATTERN_WITHIN_MS, after_match: str = "past_last_row"):
    def fn(key, pdfs: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        symbol = key[0]
        if state.exists:
            st = state.get
            ts, tid, pr = list(st[0]), list(st[1]), list(st[2])
            n_final = int(st[3])
        else:
            ts, tid, pr, n_final = [], [], [], 0
        wm = state.getCurrentWatermarkMs()
        new = [pdf for pdf in pdfs if len(pdf)]
        if new:
            nd = pd.concat(new)
            last = (ts[n_final - 1], tid[n_final - 1]) if n_final else None
            for t, i, p in zip(nd["ts_ms"].tolist(), nd["tid"].tolist(), nd["price"].tolist()):
                if last is not None and (t, i) <= last:
                    continue  # older than rows already matched: late
                ts.append(int(t)); tid.append(int(i)); pr.append(float(p))
        # sort the pending tail; the final prefix is already in order
        tail = sorted(zip(ts[n_final:], tid[n_final:], pr[n_final:]))
        ts[n_final:] = [r[0] for r in tail]
        tid[n_final:] = [r[1] for r in tail]
        pr[n_final:] = [r[2] for r in tail]
        n_final = n_final + sum(1 for r in tail if r[0] < wm)
        out = []
        if n_final >= 2:
            a_ts = np.asarray(ts[:n_final], dtype=np.int64)
            a_p = np.asarray(pr[:n_final], dtype=np.float64)
            matches, stop = scan(a_ts, a_p, n_final, within_ms, after_match)
            for s, pk_last, sd_last, b in matches:
                out.append((symbol, pr[s], pr[sd_last], pr[pk_last], pr[b], int(ts[b])))
            keep = max(stop - 1, 0)
            ts, tid, pr = ts[keep:], tid[keep:], pr[keep:]
            n_final -= keep
        state.update((ts, tid, pr, n_final))
        if len(ts) > n_final:
            state.setTimeoutTimestamp(max(int(ts[n_final]) + 1, int(wm) + 1))
        if out:
            df = pd.DataFrame(out, columns=["symbol", "first_dip", "second_dip", "peak_price",
                                            "breakout_price", "confirmed_at_ms"])
            df["confirmed_at"] = pd.to_datetime(df["confirmed_at_ms"], unit="ms")
            yield df[[f.name for f in OUTPUT_SCHEMA.fields]]

    return fn


def stream_double_bottom(trades: DataFrame, *, within_ms: int = C.PATTERN_WITHIN_MS,
                         after_match: str = "past_last_row", watermark: str = C.WATERMARK_DELAY,
                         time_col: str = "trade_time", price_col: str = "price",
                         id_col: str = "trade_id", symbol_col: str = "symbol") -> DataFrame:
    """Streaming matches; emitted once, when their BREAK row is final. Rows without a time are left out;
    a null id sorts before all others, as in the batch form, and a null price ends a run."""
    if after_match not in ("past_last_row", "next_row"):
        raise ValueError(f"after_match must be past_last_row or next_row, not {after_match!r}")
    rows = (trades.select(
        F.col(symbol_col).alias("symbol"),
        F.timestamp_millis(F.col(time_col)).alias("ts"),
        F.col(time_col).cast("long").alias("ts_ms"),
        F.coalesce(F.col(id_col).cast("long"), F.lit(-2 ** 63)).alias("tid"),
        F.col(price_col).cast("double").alias("price"))
        .where(F.col("ts").isNotNull()).withWatermark("ts", watermark))
    return rows.groupBy("symbol").applyInPandasWithState(
        make_matcher(within_ms, after_match), OUTPUT_SCHEMA, STATE_SCHEMA, "append",
        GroupStateTimeout.EventTimeTimeout)
