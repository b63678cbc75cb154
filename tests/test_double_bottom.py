import pytest
from brute import double_bottom_brute
from conftest import ms
from hypothesis import given, settings
from hypothesis import strategies as st
from rows import trades_a

from tidemark.operators.double_bottom import double_bottom

T0 = ms("2024-01-01 00:00:00")
MIN = 60_000


def series(spark, prices, sym="X", step=MIN, t0=T0):
    return trades_a(spark, [(sym, t0 + i * step, i, p, 1) for i, p in enumerate(prices)])


def run(df, **kw):
    return sorted((r.symbol, r.first_dip, r.second_dip, r.peak_price, r.breakout_price, r.confirmed_at_ms)
                  for r in double_bottom(df, **kw).collect())


def test_worked_example(spark):
    out = run(series(spark, [10, 9, 8, 9, 11, 10, 9.5, 12]))
    assert out == [("X", 9.0, 9.5, 11.0, 12.0, T0 + 7 * MIN)]


def test_no_prior_row_cannot_start(spark):
    # the first row has no previous row, so the dip starts at the second row
    assert run(series(spark, [9, 8, 9, 11, 10, 9.5, 12]))[0][1] == 8.0
    assert run(series(spark, [8, 9, 11, 10, 9.5, 12])) == []


def test_flat_row_breaks_a_run(spark):
    assert run(series(spark, [10, 9, 9, 11, 10, 12])) == []
    assert run(series(spark, [10, 9, 11, 11, 10, 12])) == []


def test_break_must_exceed_first_peak(spark):
    assert run(series(spark, [10, 9, 11, 13, 12, 10, 11])) == []      # break 11 == first peak 11
    out = run(series(spark, [10, 9, 11, 13, 12, 11.5, 12.5]))         # above first, below last peak
    assert out == [("X", 9.0, 11.5, 13.0, 12.5, T0 + 6 * MIN)]


def test_time_limit_strict_and_trimming(spark):
    # start 9 (t=1) to break (t=7): 6 min; start 8 (t=2): 5 min
    p = [10, 9, 8, 9, 11, 10, 9.5, 12]
    assert [r[1] for r in run(series(spark, p), within_ms=6 * MIN + 1)] == [9.0]
    assert [r[1] for r in run(series(spark, p), within_ms=6 * MIN)] == [8.0]   # trimmed
    assert run(series(spark, p), within_ms=5 * MIN + 1) != []
    assert run(series(spark, p), within_ms=5 * MIN) == []                     # exactly at the limit
    # long first dip: the start moves forward until the span fits
    prices = [20, 19, 18, 17, 16, 15, 16, 17, 16, 18]
    out = run(series(spark, prices), within_ms=5 * MIN)
    assert out == [("X", 15.0, 16.0, 17.0, 18.0, T0 + 9 * MIN)]


def test_overlap_modes(spark):
    # second dip of the first match is the first dip of the next candidate
    prices = [10, 9, 11, 10, 12, 11, 13]
    plr = run(series(spark, prices))
    assert [r[4] for r in plr] == [12.0]
    nr = run(series(spark, prices), after_match="next_row")
    assert sorted(r[4] for r in nr) == [12.0, 13.0]


def test_interleaved_symbols_and_equal_times(spark):
    a = [("A", T0 + i * MIN, 2 * i, p, 1) for i, p in enumerate([10, 9, 8, 9, 11, 10, 9.5, 12])]
    b = [("B", T0 + i * MIN, 2 * i + 1, p, 1) for i, p in enumerate([5, 4, 6, 5, 7])]
    # equal times ordered by trade id
    c = [("C", T0, 1, 10, 1), ("C", T0, 2, 9, 1), ("C", T0 + MIN, 3, 11, 1), ("C", T0 + MIN, 4, 10, 1),
         ("C", T0 + MIN, 5, 12, 1)]
    out = run(trades_a(spark, a + b + c))
    assert [r[0] for r in out] == ["A", "B", "C"]


def test_bad_mode(spark):
    with pytest.raises(ValueError):
        double_bottom(series(spark, [1, 2]), after_match="skip")


walk = st.lists(st.integers(-2, 2), min_size=2, max_size=60)


@settings(max_examples=12, deadline=None)
@given(st.lists(walk, min_size=1, max_size=3), st.sampled_from([3 * MIN, 10 * MIN, 40 * MIN]),
       st.sampled_from(["past_last_row", "next_row"]), st.sampled_from([2 * MIN, 7 * MIN, 3_600_000]),
       st.integers(0, 3))
def test_matches_brute_force(spark, walks, within, mode, bucket, gap_seed):
    rows = []
    tid = 0
    for k, w in enumerate(walks):
        p, t = 100, T0
        for j, step in enumerate(w):
            p += step
            t += MIN * (1 + (j * gap_seed) % 5) if j % 4 else 0   # gaps and equal times
            rows.append((f"S{k}", t, tid, p, 1))
            tid += 1
    got = run(trades_a(spark, rows), within_ms=within, after_match=mode, bucket_ms=bucket)
    exp = double_bottom_brute([(s, t, i, float(p)) for s, t, i, p, _ in rows], within, mode)
    assert got == exp
