"""Double-bottom row pattern per symbol, in event-time order.

Pattern ``FIRST_DIP+ PEAK+ SECOND_DIP+ BREAK`` within a time limit, one row
per match. ``FIRST_DIP``/``SECOND_DIP``: price below the previous row's;
``PEAK``: above it; ``BREAK``: above the price of the *first* PEAK row. Rows
are ordered by ``(time, trade_id)``; the previous row is the physically
previous row of the symbol. Quantifiers are greedy and give nothing back, so
BREAK is the first row after the second dip's falling run. The limit is
strict: ``break.time - start.time < within``; the earliest row of the first
dip run that satisfies it starts the match. Measures: first_dip (start
price), peak_price (last PEAK), second_dip (last SECOND_DIP), breakout_price,
confirmed_at (BREAK time).

After a match, ``after_match="past_last_row"`` resumes after the BREAK row
(matches never overlap); ``"next_row"`` resumes at the row after the start,
so every eligible start row of the first dip run gives a match.

Distributed formulation (no task ever holds a whole symbol):

1. Rows are partitioned by ``(symbol, time bucket)``. ``lag``/``lead`` inside
   a bucket give each row its neighbours; a bucket's first/last row takes
   them from a per-bucket summary (one row per bucket) shifted by one bucket.
   ``d = sign(price - previous price)`` (0 for the first row).
2. A row ends a *run* when the next row's ``d`` differs. Every row gets the
   first run end at or after it inside its bucket (the last non-null end of a
   frame that runs backwards, on the same partitioning); a bucket's trailing
   rows have none yet. All frames are running ones, linear in the rows.
3. Rows are aggregated into segments by that key (combined map-side); a
   bucket's trailing segment takes the first run end of a later bucket (one
   row per bucket), and segments are merged into runs: direction, first row,
   last price, and the row after the run. Two row-level tables are written:
   the four columns read from the source (which is read once; rows and bucket
   summary both come from that table) and the rows with their run keys. The next run is the one whose first row is that row, so the
   sequence falling -> rising -> falling -> break row is found with two
   equi-joins on high-cardinality run keys.
4. The time limit picks the start row; only candidates whose whole first-dip
   run is too old need a join back to that run's rows.
5. ``past_last_row``: an accepted match blocks exactly the candidate whose
   first-dip run is its second-dip run. Such links form chains of adjacent
   candidates, and the odd members of each chain are the matches. Chain
   starts are found by a self-join; positions by a segmented scan: row
   numbers inside candidate time buckets plus per-bucket offsets from a
   summary.

Windows over the per-bucket summaries are partitioned by symbol only: they
hold one row per non-empty bucket, a count bounded by the time span over the
bucket width, not by the number of trades.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark import config as C
from tidemark.functions.columns import as_double, version_of
from tidemark.session import delete_path, materialize, scratch_path

DEFAULT_BUCKET_MS = 3_600_000


def _rows(trades: DataFrame, time_col: str, price_col: str, id_col: str,
          symbol_col: str, bucket_ms: int) -> DataFrame:
    return trades.select(
        F.col(symbol_col).alias("symbol"),
        F.col(time_col).cast("long").alias("ts"),
        F.coalesce(F.col(id_col), F.lit(-2 ** 63)).alias("tid") if dict(trades.dtypes)[id_col] == "bigint" else F.col(id_col).alias("tid"),
        as_double(price_col).alias("price"),
    ).where("ts IS NOT NULL").withColumn("bucket", F.floor(F.col("ts") / bucket_ms))


def _with_neighbours(rows: DataFrame) -> DataFrame:
    """Add ``d`` (direction from the previous row), ``nxt`` (next row) and
    the bucket-local run key ``lkey``: the first run end at or after the row
    inside its bucket (null for the bucket's trailing rows, whose run ends in
    a later bucket)."""
    key = F.struct("ts", "tid")
    summ = rows.groupBy("symbol", "bucket").agg(
        F.max_by("price", key).alias("last_price"),
        F.min_by(F.struct("ts", "tid", "price"), key).alias("first_row"))
    wb = Window.partitionBy("symbol").orderBy("bucket")
    summ = summ.select(
        "symbol", "bucket",
        F.lag("last_price").over(wb).alias("prev_bucket_price"),
        F.lead("first_row").over(wb).alias("next_bucket_row"))
    wl = Window.partitionBy("symbol", "bucket").orderBy("ts", "tid")
    r = rows.join(summ, ["symbol", "bucket"])
    rn = F.row_number().over(wl)
    prev = F.when(rn == 1, F.col("prev_bucket_price")).otherwise(F.lag("price").over(wl))
    nxt = F.coalesce(F.lead(F.struct("ts", "tid", "price")).over(wl), F.col("next_bucket_row"))
    r = r.select("symbol", "bucket", "ts", "tid", "price", rn.alias("rn"),
                 F.coalesce(F.signum(F.col("price") - prev), F.lit(0.0)).cast("int").alias("d"),
                 nxt.alias("nxt"))
    d_next = F.coalesce(F.signum(F.col("nxt.price") - F.col("price")), F.lit(0.0)).cast("int")
    is_end = F.col("nxt").isNull() | (d_next != F.col("d"))
    # the first run end at or after a row is the last one so far, read backwards:
    # a running frame, linear in the rows of the bucket
    back = (Window.partitionBy("symbol", "bucket").orderBy(F.desc("rn"))
            .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    r = r.withColumn("_lkey", F.last(F.when(is_end, F.struct("ts", "tid")), ignorenulls=True).over(back))
    return r.select("symbol", "bucket", "ts", "tid", "price", "d", "nxt",
                    F.col("_lkey.ts").alias("lkey_ts"), F.col("_lkey.tid").alias("lkey_tid"))


def _segments(nb: DataFrame) -> DataFrame:
    """Rows grouped by bucket-local run key; a bucket's trailing rows (null
    key) form one segment. Combined map-side."""
    key = F.struct("ts", "tid")
    return nb.groupBy("symbol", "bucket", "lkey_ts", "lkey_tid").agg(
        F.max("d").alias("d"),
        F.min_by(F.struct("ts", "tid", "price"), key).alias("first"),
        F.max_by(F.struct("price", "nxt"), key).alias("last"),
        F.max(key).alias("last_key"))


def _tail_map(segs: DataFrame) -> DataFrame:
    """Per bucket: the first run end in any later bucket, i.e. the run key of
    the bucket's trailing rows (one row per non-empty bucket)."""
    per_bucket = segs.groupBy("symbol", "bucket").agg(
        F.min(F.when(F.col("lkey_ts").isNotNull(), F.struct(
            F.col("lkey_ts").alias("ts"), F.col("lkey_tid").alias("tid")))).alias("first_end"))
    wb = (Window.partitionBy("symbol").orderBy(F.desc("bucket"))
          .rowsBetween(Window.unboundedPreceding, -1))
    return per_bucket.select("symbol", "bucket",
                             F.last("first_end", ignorenulls=True).over(wb).alias("later_end"))


def _runs(segs: DataFrame, tails: DataFrame) -> DataFrame:
    """Segments merged into whole runs: a trailing segment joins the run that
    ends in a later bucket."""
    heads = segs.where(F.col("lkey_ts").isNotNull()).select(
        "symbol", F.col("lkey_ts").alias("run_ts"), F.col("lkey_tid").alias("run_tid"),
        "d", "first", "last", "last_key")
    trailing = (segs.where(F.col("lkey_ts").isNull()).join(tails, ["symbol", "bucket"])
                    .select("symbol", F.col("later_end.ts").alias("run_ts"),
                            F.col("later_end.tid").alias("run_tid"), "d", "first", "last", "last_key"))
    return heads.unionByName(trailing).groupBy("symbol", "run_ts", "run_tid").agg(
        F.max("d").alias("d"),
        F.min_by("first", F.struct(F.col("first.ts"), F.col("first.tid"))).alias("first"),
        F.max_by("last", "last_key").alias("last"))


def _candidates(runs: DataFrame, within_ms: int) -> DataFrame:
    """Falling, rising, falling runs in a row, followed by a break row above the
    first peak price, whose first-dip run ends within the limit."""
    f = runs.where(F.col("d") == -1).select(
        "symbol", F.col("run_ts").alias("f_ts"), F.col("run_tid").alias("f_tid"),
        F.col("first.ts").alias("f_first_ts"), F.col("first.price").alias("f_first_price"),
        F.col("last.nxt.ts").alias("p_ts0"), F.col("last.nxt.tid").alias("p_tid0"))
    p = runs.where(F.col("d") == 1).select(
        "symbol", F.col("first.ts").alias("p_ts0"), F.col("first.tid").alias("p_tid0"),
        F.col("first.price").alias("peak_first_price"), F.col("last.price").alias("peak_price"),
        F.col("last.nxt.ts").alias("s_ts0"), F.col("last.nxt.tid").alias("s_tid0"))
    s = runs.where(F.col("d") == -1).select(
        "symbol", F.col("first.ts").alias("s_ts0"), F.col("first.tid").alias("s_tid0"),
        F.col("run_ts").alias("s_ts"), F.col("run_tid").alias("s_tid"),
        F.col("last.price").alias("second_dip"),
        F.col("last.nxt.ts").alias("b_ts"), F.col("last.nxt.price").alias("breakout_price"))
    c = (f.join(p, ["symbol", "p_ts0", "p_tid0"])
          .join(s, ["symbol", "s_ts0", "s_tid0"])
          .where(F.col("b_ts").isNotNull()
                 & (F.col("breakout_price") > F.col("peak_first_price"))
                 & (F.col("b_ts") - F.col("f_ts") < within_ms)))
    return c.select("symbol", "f_ts", "f_tid", "f_first_ts", "f_first_price", "s_ts", "s_tid",
                    "peak_price", "second_dip", "b_ts", "breakout_price")


def _first_dip_rows(nb: DataFrame, tails: DataFrame) -> DataFrame:
    """Falling rows with their run key (trailing rows take it from ``tails``,
    one row per bucket)."""
    r = nb.where(F.col("d") == -1).join(tails, ["symbol", "bucket"], "left")
    return r.select(
        "symbol",
        F.coalesce(F.col("lkey_ts"), F.col("later_end.ts")).alias("f_ts"),
        F.coalesce(F.col("lkey_tid"), F.col("later_end.tid")).alias("f_tid"),
        F.col("ts").alias("st_ts"), F.col("tid").alias("st_tid"), F.col("price").alias("st_price"))


def _starts_first(c: DataFrame, dips: DataFrame, within_ms: int) -> DataFrame:
    """Earliest eligible start per candidate."""
    whole = c.where(F.col("b_ts") - F.col("f_first_ts") < within_ms).withColumn(
        "first_dip", F.col("f_first_price"))
    trim = c.where(F.col("b_ts") - F.col("f_first_ts") >= within_ms)
    key = ["symbol", "f_ts", "f_tid"]
    rest = [x for x in c.columns if x not in key]
    starts = (trim.join(dips, key)
                  .where(F.col("b_ts") - F.col("st_ts") < within_ms)
                  .groupBy(*key)
                  .agg(*[F.first(x).alias(x) for x in rest],
                       F.min_by("st_price", F.struct("st_ts", "st_tid")).alias("first_dip")))
    return whole.unionByName(starts)


def _past_last_row(c: DataFrame, bucket_ms: int) -> DataFrame:
    """Keep the odd members of each chain of linked candidates."""
    pred = c.select("symbol", F.col("s_ts").alias("f_ts"), F.col("s_tid").alias("f_tid"),
                    F.lit(True).alias("has_pred"))
    c = (c.join(pred, ["symbol", "f_ts", "f_tid"], "left")
          .withColumn("is_start", F.col("has_pred").isNull())
          .drop("has_pred")
          .withColumn("cb", F.floor(F.col("f_ts") / bucket_ms)))
    wl = Window.partitionBy("symbol", "cb").orderBy("f_ts", "f_tid")
    c = c.withColumn("li", F.row_number().over(wl)).withColumn(
        "lstart", F.max(F.when(F.col("is_start"), F.col("li"))).over(
            wl.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    summ = c.groupBy("symbol", "cb").agg(F.count(F.lit(1)).alias("n"), F.max("lstart").alias("mstart"))
    wb = Window.partitionBy("symbol").orderBy("cb")
    before = wb.rowsBetween(Window.unboundedPreceding, -1)
    summ = summ.withColumn("off", F.coalesce(F.sum("n").over(before), F.lit(0)))
    summ = summ.withColumn("carry", F.max(F.col("mstart") + F.col("off")).over(before))
    c = c.join(summ.select("symbol", "cb", "off", "carry"), ["symbol", "cb"])
    idx = F.col("li") + F.col("off")
    start = F.coalesce(F.col("lstart") + F.col("off"), F.col("carry"))
    return c.where(((idx - start) % 2) == 0)


def double_bottom(trades: DataFrame, *, within_ms: int = C.PATTERN_WITHIN_MS,
                  after_match: str = "past_last_row", bucket_ms: int = DEFAULT_BUCKET_MS,
                  time_col: str = "trade_time", price_col: str = "price",
                  id_col: str = "trade_id", symbol_col: str = "symbol",
                  cleanup: bool = True, out_path: str | None = None) -> DataFrame:
    """Batch double-bottom matches. Output: symbol, first_dip, second_dip,
    peak_price, breakout_price, confirmed_at (timestamp), confirmed_at_ms.

    Runs its stages eagerly (writes under ``spark.checkpoint.dir``) and
    returns a DataFrame over the written matches (at ``out_path``, else a
    new folder there). The stages are removed also when one of them fails."""
    if after_match not in ("past_last_row", "next_row"):
        raise ValueError(f"after_match must be past_last_row or next_row, not {after_match!r}")
    rows = _rows(trades, time_col, price_col, id_col, symbol_col, bucket_ms)
    # Each stage below feeds several later branches; it is written once to the
    # shared folder instead of being recomputed per branch. The matches (small)
    # are written last, then the intermediate tables are removed.
    spark = trades.sparkSession
    paths: list[str] = []

    def stage(df: DataFrame, name: str) -> DataFrame:
        paths.append(scratch_path(spark, name))
        return materialize(df, name, path=paths[-1])

    try:
        nb = stage(_with_neighbours(stage(rows, "double-bottom-source")), "double-bottom-rows")
        segs = stage(_segments(nb), "double-bottom-segments")
        tails = _tail_map(segs)
        runs = stage(_runs(segs, tails), "double-bottom-runs")
        c = stage(_candidates(runs, within_ms), "double-bottom-candidates")
        dips = _first_dip_rows(nb, tails)
        if after_match == "next_row":
            m = (c.join(dips, ["symbol", "f_ts", "f_tid"])
                  .where(F.col("b_ts") - F.col("st_ts") < within_ms)
                  .withColumn("first_dip", F.col("st_price")))
        else:
            st = stage(_starts_first(c, dips, within_ms), "double-bottom-starts")
            m = _past_last_row(st, bucket_ms)
        return materialize(m.select("symbol", "first_dip", "second_dip", "peak_price", "breakout_price",
                                    F.timestamp_millis("b_ts").alias("confirmed_at"),
                                    F.col("b_ts").alias("confirmed_at_ms")), "double-bottom-matches", path=out_path)
    finally:
        if cleanup:
            for p in paths:
                delete_path(spark, p)


def double_bottom_rows(matches: DataFrame) -> DataFrame:
    """``double_bottom_signals`` result rows."""
    return matches.select(
        "symbol", "first_dip", "second_dip", "peak_price", "breakout_price",
        F.date_trunc("second", "confirmed_at").alias("confirmed_at"),
        version_of("confirmed_at").alias("version"))
