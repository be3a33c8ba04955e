"""Split monthly plan targets into day, week or bi-week targets.

Each monthly plan row is exploded into its days (``sequence`` of dates, so
the work is spread with the rows); every day but the last gets
``plan / days_in_month`` rounded half-up to 8 decimals and the last day takes
the remainder, so day shares sum exactly to the month.  Days are then
regrouped by the target cycle; a week that spans two months sums the shares
of both.  Plans may have 20 digits before the point (a seed's
``decimal(18,8)`` has 10), their sums 30.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from metricbook.functions import cycles

PLAN_TYPE = "decimal(28,8)"
TARGET_TYPE = "decimal(38,8)"


def split_monthly_plan(aop: DataFrame, target: str) -> DataFrame:
    """``aop`` rows with cycle 'month' -> ``cycle_timestamp, plan, indicator, dimensions, cycle=target``."""
    cycles.check_cycle(target, ("day", "week", "bi-week"))
    m = aop.where(F.col("cycle") == "month").select(
        "indicator", "dimensions", F.col("plan").cast(PLAN_TYPE).alias("plan"),
        F.to_date("cycle_timestamp").alias("__m"))
    days = m.select("*", F.explode(F.sequence("__m", F.last_day("__m"))).alias("__d"))
    n = F.dayofmonth(F.last_day("__m"))
    # Two digits for the days: with ten, a product has more than 38 and Spark cuts its scale.
    share = (F.col("plan") / n.cast("decimal(2,0)")).cast(PLAN_TYPE)
    day_plan = F.when(F.col("__d") == F.last_day("__m"), F.col("plan") - share * (n - 1).cast("decimal(2,0)")) \
        .otherwise(share).cast(PLAN_TYPE)
    daily = days.select("indicator", "dimensions",
                        cycles.period_start(F.col("__d").cast("timestamp_ntz"), target).alias("cycle_timestamp"),
                        day_plan.alias("plan"))
    return (daily.groupBy("indicator", "dimensions", "cycle_timestamp")
            .agg(F.sum("plan").cast(TARGET_TYPE).alias("plan"))
            .select("cycle_timestamp", "plan", "indicator", "dimensions", F.lit(target).alias("cycle")))
