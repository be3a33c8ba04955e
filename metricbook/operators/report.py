"""Performance report: each KPI row with its prior-year value, plan target and labels.

Plan shape
----------
The original join to the prior year is an OR of two date rules followed by a
ROW_NUMBER that keeps the latest match; planned as-is in Spark the OR becomes
a residual over every (series x series) pair.  Here both rules are folded into
one computed key:

* week / bi-week: ``year * 100 + ISO week`` (the current row asks for
  ``(year - 1) * 100 + week``);
* day / month / quarter / year: the period start (the current row asks for
  its start minus one year).

Modules may repeat a coordinate; a report has one row for it, the one with the
smallest id (an aggregate with map-side combine, not a window).  The prior side
comes from the same reduced rows and is reduced per key with
``max_by(value, cycle_timestamp)`` ("latest match wins"), so the join is a pure
equi-join whose build side is already hash-partitioned on the join keys: no
window, no fan-out.  Glossary and plan joins are left to AQE's measured bytes.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from metricbook.config import RunConfig
from metricbook.functions import cycles, dims as D, keys

PLAN_TYPE = "decimal(18,8)"
COORDS = ["indicator", "dimensions", "cycle", "cycle_timestamp"]
JOIN_KEYS = ["indicator", "dimensions", "cycle", "__pk"]
AOP_KEYS = ["cycle_timestamp", "cycle", "indicator", "dimensions"]
REPORT_COLUMNS = ["id", "indicator", "cycle", "cycle_timestamp", "dimensions", "metric",
                  "metric_display_name", "coordinates", "sortkey", "label", "current_value",
                  "prior_value", "aop_value", "alt_id"]


def _prior_filter(cfg: RunConfig):
    p, lc = cfg.reporting_period, cfg.last_complete
    cond = F.col("cycle") == p
    ts = F.col("cycle_timestamp")
    if p in ("week", "bi-week"):
        y = lc.year - 1
        # calendar-year range (pushes down) + the ISO week number
        cond &= (ts >= F.lit(f"{y}-01-01 00:00:00").cast("timestamp_ntz")) \
            & (ts < F.lit(f"{y + 1}-01-01 00:00:00").cast("timestamp_ntz")) \
            & (F.weekofyear(ts) == lc.isocalendar()[1])
    else:
        cond &= ts == cycles.ntz(cycles.minus_one_year(lc))
    return cond


def plan_targets(aop: DataFrame, cfg: RunConfig) -> DataFrame:
    """Typed, canonical plan rows, one per coordinate (duplicates keep the largest plan)."""
    a = aop.select(F.col("cycle_timestamp").cast("timestamp_ntz").alias("cycle_timestamp"),
                   F.col("plan").cast(PLAN_TYPE).alias("plan"),
                   F.col("indicator").cast("string").alias("indicator"),
                   D.canonical_any(F.col("dimensions"), aop.schema["dimensions"]).alias("dimensions"),
                   F.col("cycle").cast("string").alias("cycle"))
    if cfg.aop_scope == "last_complete":
        a = a.filter((F.col("cycle") == cfg.reporting_period)
                     & (F.col("cycle_timestamp") == cycles.ntz(cfg.last_complete)))
    return a.groupBy(*AOP_KEYS).agg(F.max("plan").alias("aop_value"))


def performance_report(repository: DataFrame, glossary: DataFrame, aop: DataFrame | None = None,
                       cfg: RunConfig | None = None) -> DataFrame:
    """Report rows (see ``REPORT_COLUMNS``) for every cycle on backfill, else the last complete period."""
    cfg = cfg or RunConfig(backfill=True)
    repo = repository.select("id", "indicator", "cycle", "cycle_timestamp", "dimensions", "value")
    last = (F.col("cycle") == cfg.reporting_period) & (F.col("cycle_timestamp") == cycles.ntz(cfg.last_complete))
    if cfg.incremental:
        repo = repo.filter(last | _prior_filter(cfg))
    # One row per coordinate, before the joins and for both sides of them.
    one = (repo.groupBy(*COORDS).agg(F.min(F.struct("id", "value")).alias("__r"))
           .select(*COORDS, F.col("__r.id").alias("id"), F.col("__r.value").alias("value")))
    cur, prior = one, one
    if cfg.incremental:
        cur, prior = cur.filter(last), prior.filter(_prior_filter(cfg))

    prior = (prior.withColumn("__pk", cycles.prior_match_key("cycle", "cycle_timestamp"))
             .where(F.col("__pk").isNotNull())
             .groupBy(*JOIN_KEYS)
             .agg(F.max_by("value", "cycle_timestamp").alias("prior_value")))
    cur = cur.withColumn("__pk", cycles.prior_lookup_key("cycle", "cycle_timestamp"))
    m = cur.join(prior, on=JOIN_KEYS, how="left").withColumnRenamed("value", "current_value")

    if aop is not None:
        # No hint: the plan may be derived from data, and counting it would
        # recompute its lineage.  AQE turns this into a broadcast join only
        # when the plan's measured runtime size is under the threshold.
        m = m.join(plan_targets(aop, cfg), on=AOP_KEYS, how="left")
    else:
        m = m.withColumn("aop_value", F.lit(None).cast(PLAN_TYPE))

    g = glossary.select("indicator", "readable_indicator")
    m = m.join(g, on="indicator", how="inner")

    e = F.col("__e")
    out = m.withColumn("__e", D.entries("dimensions")).select(  # parsed once for the three names
        "id", "indicator", "cycle", "cycle_timestamp", "dimensions",
        D.metric_name("indicator", e).alias("metric"),
        D.display_name("readable_indicator", "indicator", e).alias("metric_display_name"),
        D.coordinates(e).alias("coordinates"),
        cycles.sortkey("cycle", "cycle_timestamp").alias("sortkey"),
        cycles.label("cycle", "cycle_timestamp").alias("label"),
        "current_value", "prior_value", "aop_value")
    return out.withColumn("alt_id", keys.surrogate_key(
        out, "indicator", "metric", "coordinates", "cycle", "cycle_timestamp"))
