"""Procedural reference implementations used only by the tests."""

from __future__ import annotations

from collections import defaultdict


def double_bottom_brute(rows, within_ms, after_match="past_last_row"):
    """rows: iterable of (symbol, ts_ms, tid, price). Returns sorted match tuples
    (symbol, first_dip, second_dip, peak_price, breakout_price, confirmed_at_ms)."""
    by_sym = defaultdict(list)
    for sym, ts, tid, price in rows:
        by_sym[sym].append((ts, tid, float(price)))
    out = []
    for sym, rs in by_sym.items():
        rs.sort(key=lambda r: (r[0], r[1]))
        ts = [r[0] for r in rs]
        p = [r[2] for r in rs]
        n = len(rs)

        def fall(i):
            return i > 0 and p[i] < p[i - 1]

        def rise(i):
            return i > 0 and p[i] > p[i - 1]

        def attempt(s):
            if not fall(s):
                return None
            i = s
            while i < n and fall(i):
                i += 1
            if i >= n or not rise(i):
                return None
            pk_first = i
            while i < n and rise(i):
                i += 1
            pk_last = i - 1
            if i >= n or not fall(i):
                return None
            while i < n and fall(i):
                i += 1
            sd_last = i - 1
            if i >= n or not p[i] > p[pk_first]:
                return None
            if not ts[i] - ts[s] < within_ms:
                return None
            return (sym, p[s], p[sd_last], p[pk_last], p[i], ts[i]), i

        s = 0
        while s < n:
            m = attempt(s)
            if m is None:
                s += 1
                continue
            out.append(m[0])
            s = m[1] + 1 if after_match == "past_last_row" else s + 1
    return sorted(out)


def interval_join_brute(a_rows, b_rows, half_width_ms):
    """a_rows: (symbol, ts, price); b_rows: (symbol, ts, price) already normalised."""
    out = []
    for sa, ta, pa in a_rows:
        for sb, tb, pb in b_rows:
            if sa == sb and ta - half_width_ms <= tb <= ta + half_width_ms:
                out.append((sa, ta, tb, pa, pb))
    return sorted(out)
