"""Robust baseline: mean of the previous six points after trimming outliers.

For each report row, the values of the six preceding periods of its series
(RANGE frame over the period index, so gaps count) are collected; when all
six exist, up to three trimming steps run: compute the mean and population
sigma, find the point farthest from the mean outside mean +/- 2 sigma (first
index wins ties), drop it.  The result is the mean of what remains.

Everything is a higher-order-function expression (``aggregate``,
``transform``, ``filter``) evaluated in the JVM: the three steps are unrolled.
Sums run left to right and divide by n, then squared deviations, then sqrt,
the same order of floating-point operations as the original.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from metricbook.config import RunConfig
from metricbook.functions import cycles
from metricbook.operators.timeseries import SERIES, period_index

POINTS = 6
MAX_STEPS = 3
Z = 2.0
DIGITS = 6


def _mean(a: Column) -> Column:
    return F.try_divide(F.aggregate(a, F.lit(0.0), lambda acc, x: acc + x), F.size(a))


def trim_steps(df: DataFrame, col: str, steps: int = MAX_STEPS) -> tuple[DataFrame, str]:
    """Apply the trimming step ``steps`` times; returns the frame and the final array column.

    Each intermediate (mean, sigma, distances, array) is its own column, so
    the optimizer keeps the steps as separate projections instead of inlining
    one array expression into the next.
    """
    a = col
    for k in range(steps):
        m, sd, d, nxt = f"__m{k}", f"__sd{k}", f"__d{k}", f"__a{k + 1}"
        df = df.withColumn(m, _mean(F.col(a)))
        df = df.withColumn(sd, F.sqrt(F.try_divide(
            F.aggregate(F.col(a), F.lit(0.0), lambda acc, x: acc + (x - F.col(m)) * (x - F.col(m))),
            F.size(F.col(a)))))
        lo, hi = F.col(m) - Z * F.col(sd), F.col(m) + Z * F.col(sd)
        df = df.withColumn(d, F.transform(F.col(a), lambda x: F.when((x < lo) | (x > hi), F.abs(x - F.col(m)))
                                          .otherwise(F.lit(-1.0))))
        best = F.array_max(F.col(d))
        idx = F.array_position(F.col(d), best) - 1  # first index of the largest distance
        # no outlier (best <= 0) or fewer than two points left: keep the array
        df = df.withColumn(nxt, F.when((F.size(F.col(a)) >= 2) & (best > 0),
                                       F.filter(F.col(a), lambda x, i: i != idx)).otherwise(F.col(a)))
        a = nxt
    return df, a


def robust_baseline(report: DataFrame, cfg: RunConfig, points: int = POINTS) -> DataFrame:
    """``indicator, dimensions, cycle, cycle_timestamp, current_value, baseline_points, robust_mean``."""
    p = cycles.check_cycle(cfg.reporting_period, cycles.CYCLES)
    rep = report.filter(F.col("cycle") == p).join(
        period_index(report.sparkSession, p, cfg.spine_start, cfg.spine_end), on="cycle_timestamp")
    w = Window.partitionBy(*SERIES).orderBy("period_idx").rangeBetween(-points, -1)
    prev = F.collect_list(F.col("current_value").cast("double")).over(w)
    out = rep.withColumn("__a0", prev)
    full = F.size("__a0") == points
    out = out.withColumn("__full", full).withColumn(
        "__a0", F.when(F.col("__full"), F.col("__a0")).otherwise(F.array().cast("array<double>")))
    out, last = trim_steps(out, "__a0")
    return out.select(
        "indicator", "dimensions", "cycle", "cycle_timestamp", "current_value",
        F.when(F.col("__full"), F.lit(points)).otherwise(F.lit(0)).alias("baseline_points"),
        F.round(F.when(F.col("__full"), _mean(F.col(last))), DIGITS).alias("robust_mean"))
