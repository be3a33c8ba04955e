"""Additive trend / seasonality decomposition and a seasonal-naive forecast per KPI series.

* trend: centred moving mean of one season (RANGE frame on the period index, only
  when every period of the window has a value); for an even season the two ends of
  the season + 1 points count half, so no slot of the season counts twice;
* seasonal: mean of (value - trend) per series and calendar slot (month of year,
  ISO week, ...), less the mean of these indices, so they sum to zero;
* seasonal_naive: the value one season earlier (RANGE frame at exactly -season).
Means are exact decimal means rounded half-up to 6 digits.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from metricbook.config import RunConfig
from metricbook.functions import cycles
from metricbook.operators.timeseries import SERIES, period_index

SEASON = {"day": 7, "week": 52, "bi-week": 26, "month": 12, "quarter": 4, "year": 1}


def season_slot(period: str, ts) -> F.Column:
    t = F.col(ts) if isinstance(ts, str) else ts
    return {"day": F.dayofweek(t), "week": F.weekofyear(t), "bi-week": F.ceil(F.weekofyear(t) / 2).cast("int"),
            "month": F.month(t), "quarter": F.quarter(t), "year": F.lit(1)}[period]


def _exact_mean(scaled_sum, cnt, scale: int):
    return F.try_divide(scaled_sum, cnt.cast("decimal(20,0)") * (10 ** scale)).cast("decimal(38,6)")


def decompose(report: DataFrame, cfg: RunConfig) -> DataFrame:
    p = cycles.check_cycle(cfg.reporting_period, cycles.CYCLES)
    season = SEASON[p]
    k = season // 2
    rep = report.filter(F.col("cycle") == p).join(
        period_index(report.sparkSession, p, cfg.spine_start, cfg.spine_end), on="cycle_timestamp")
    order = Window.partitionBy(*SERIES).orderBy("period_idx")
    x = (F.col("current_value") * 10000).cast("decimal(38,0)")
    rep = rep.withColumn("__x", x)
    cnt = F.count("__x").over(order.rangeBetween(-k, k))
    total = F.try_sum("__x").over(order.rangeBetween(-k, k))
    if season % 2 == 0:
        # both ends are the same slot of the season: each counts half
        ends = F.max("__x").over(order.rangeBetween(-k, -k)) + F.max("__x").over(order.rangeBetween(k, k))
        weighted, points = total * 2 - ends, F.lit(2 * season)
    else:
        weighted, points = total, F.lit(season)
    trend = F.when(cnt == 2 * k + 1, _exact_mean(weighted.cast("decimal(38,0)"), points, 4))
    out = rep.withColumn("__trend", trend).withColumn("__slot", season_slot(p, "cycle_timestamp"))
    out = out.withColumn("__det", (F.col("current_value") - F.col("__trend")).cast("decimal(38,6)"))
    # Seasonal index: mean of a slot minus the mean of the slots (a series has at most `season` of them).
    d6 = (F.col("__det") * 1000000).cast("decimal(38,0)")
    slots = (out.withColumn("__d6", d6).groupBy(*SERIES, "__slot")
             .agg(_exact_mean(F.try_sum("__d6"), F.count("__d6"), 6).alias("__mean")))
    m6 = (F.col("__mean") * 1000000).cast("decimal(38,0)")
    every = Window.partitionBy(*SERIES)
    slots = slots.withColumn("__m6", m6).select(*SERIES, "__slot", (F.col("__mean") - _exact_mean(
        F.try_sum("__m6").over(every), F.count("__m6").over(every), 6)).alias("__seasonal"))
    out = out.withColumn("seasonal_naive", F.max("current_value").over(order.rangeBetween(-season, -season)))
    return out.join(slots, [*SERIES, "__slot"], "left").select(
        "indicator", "dimensions", "cycle", "cycle_timestamp", "current_value",
        F.col("__trend").cast("double").alias("trend"), F.col("__seasonal").cast("double").alias("seasonal"),
        "seasonal_naive")
