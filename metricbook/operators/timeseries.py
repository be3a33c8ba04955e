"""Time-series analysis: rolling +/-1.5 sigma bands and alerts per KPI series.

The original model crosses a calendar spine with every metric, left-joins the
report and slides a ROWS frame over the spine, which materialises
metrics x periods rows.  Here the spine is only a *numbering* of the
reporting periods (period_idx 0..P-1, bounded by the calendar, not by the
data); it is broadcast onto the report rows and the frame becomes a RANGE
frame over that index:

    Window.partitionBy(indicator, cycle, dimensions).orderBy(period_idx).rangeBetween(-N, -1)

``count(value) == N`` then means exactly what the spine version means by
"has history": all N preceding periods exist and carry a value; gaps and NULL
values switch it off in both.  One window spec feeds count, avg and stddev,
so the plan has a single shuffle and a single sort.  A series has at most P
rows, so no window partition grows with the data volume.
"""

from __future__ import annotations

import bisect
import datetime as dt

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from metricbook.config import RunConfig
from metricbook.functions import cycles, keys

BAND_WIDTH = 1.5
DIGITS = 6
SERIES = ["indicator", "cycle", "dimensions"]


def calendar(period: str, start: dt.date, end: dt.date) -> list[dt.datetime]:
    """Distinct period starts of every day in ``[start, end]``, in order.

    Its length is bounded by the number of days in the range (the original
    capped it at 5,000 days), independent of the data.
    """
    out: list[dt.datetime] = []
    d = start
    while d <= end:
        s = cycles.start_of(d, period)
        if not out or out[-1] != s:
            out.append(s)
        d += dt.timedelta(days=1)
    return out


def period_index(spark: SparkSession, period: str, start: dt.date, end: dt.date) -> DataFrame:
    """``(cycle_timestamp, period_idx)`` for the reporting spine (small, bounded, broadcast)."""
    rows = [(t, i) for i, t in enumerate(calendar(period, start, end))]
    return F.broadcast(spark.createDataFrame(rows, "cycle_timestamp timestamp_ntz, period_idx int"))


def _window_input(report: DataFrame, cfg: RunConfig, lookback: int) -> DataFrame:
    spark = report.sparkSession
    p = cfg.reporting_period
    spine_ts = calendar(p, cfg.spine_start, cfg.spine_end)
    rep = report.filter(F.col("cycle") == p)
    if cfg.incremental:
        lc = cfg.last_complete
        # Only the last complete period and its `lookback` predecessors can
        # influence the rows this run emits: a literal range, pushed down.
        i = bisect.bisect_left(spine_ts, lc)
        lo = spine_ts[max(i - lookback, 0)] if spine_ts else lc
        rep = rep.filter((F.col("cycle_timestamp") <= cycles.ntz(lc))
                         & (F.col("cycle_timestamp") >= cycles.ntz(lo)))
    return rep.join(period_index(spark, p, cfg.spine_start, cfg.spine_end), on="cycle_timestamp", how="inner")


def timeseries_analysis(report: DataFrame, cfg: RunConfig) -> DataFrame:
    """Report rows of ``cfg.reporting_period`` with history flag, bands and alerts."""
    p = cycles.check_cycle(cfg.reporting_period, cycles.CYCLES)
    n = cycles.LOOKBACK[p]
    rep = _window_input(report, cfg, n)
    w = Window.partitionBy(*SERIES).orderBy("period_idx").rangeBetween(-n, -1)
    dec = F.col("current_value")
    v = dec.cast("double")
    # One rule: moments in exact scaled-integer arithmetic (value * 10^4 is
    # integral for decimal(18,4)), rounded once, on conversion to double.  Where
    # the exact sums need more than 38 digits (values near the 14-digit limit
    # of the type) there is no sigma: boundaries and alert are NULL.
    x = (dec * 10000).cast("decimal(38,0)")
    cnt = F.count(dec).over(w)
    s1 = F.try_sum(x).over(w)
    s2 = F.try_sum(F.try_multiply(x, x)).over(w)
    num = F.try_subtract(F.try_multiply(cnt.cast("decimal(20,0)"), s2), F.try_multiply(s1, s1))
    var = num.cast("double") / (cnt.cast("double") * (cnt - 1).cast("double") * F.lit(1e8))
    sig_all = F.sqrt(var)
    mid_all = s1.cast("double") / (cnt.cast("double") * F.lit(1e4))
    # exact mean rounded half-up to 6 digits (decimal division)
    mid6 = (s1 / (cnt.cast("decimal(20,0)") * 10000)).cast("decimal(38,6)").cast("double")
    out = (rep.withColumn("has_history", cnt == n)
           .withColumn("__mid", F.when(F.col("has_history"), mid_all))
           .withColumn("__mid6", F.when(F.col("has_history"), mid6))
           .withColumn("__sig", F.when(F.col("has_history"), sig_all))
           .withColumn("__up", F.col("__mid") + BAND_WIDTH * F.col("__sig"))
           .withColumn("__lo", F.col("__mid") - BAND_WIDTH * F.col("__sig")))
    in_alert = ~v.between(F.col("__lo"), F.col("__up"))
    out = out.withColumn("in_alert", in_alert).withColumn(
        "alert", F.when(F.col("in_alert"), F.when(v < F.col("__lo"), F.lit("↓")).otherwise(F.lit("↑"))))
    if cfg.incremental:
        out = out.filter(F.col("cycle_timestamp") == cycles.ntz(cfg.last_complete))
    rest = [c for c in report.columns if c not in ("id", "indicator", "dimensions", "cycle", "cycle_timestamp")]
    res = out.select(
        "indicator", "dimensions", "cycle", "cycle_timestamp", *rest,
        F.lit(n).cast("int").alias("historical_lookback"), "has_history",
        F.col("__mid6").alias("midpoint"), F.round("__sig", DIGITS).alias("sigma"),
        F.round("__up", DIGITS).alias("upper_boundary"), F.round("__lo", DIGITS).alias("lower_boundary"),
        "in_alert", "alert")
    res = res.withColumn("id", keys.surrogate_key(res, "indicator", "dimensions", "cycle", "cycle_timestamp"))
    return res.select("id", *[c for c in res.columns if c != "id"])
