"""Event-time ingestion of a KPI module: each period is emitted once, when the watermark has passed its end.

Spark keeps the state: facts are reduced by (day, dimensions[, counted value]) under a watermark, and a day leaves
the state once nothing for it is accepted any more. Closed days go to a table of partial values; a period whose
end the watermark has passed is rolled up from them and written to the module table, for good. Facts that
come after their day was closed are not in any emitted period: they are counted per run and written to a
backfill table, from which their periods can be restated.

A micro-batch is written to the shared folder first and everything is derived from what was written; its
tables are partitioned by the batch's number and overwritten, so a batch that is delivered again after a
restart leaves the same rows.
"""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from metricbook.functions import cycles
from metricbook.operators import lattice as L
from metricbook.operators.pyramid import Measure, placed
from metricbook.session import shared_folder
from metricbook.sources.sink import _delete, read_table, upsert

PERIOD = "cycle_timestamp"
EPOCH = "timestamp_ntz'1970-01-01 00:00:00'"


def _replace(rows: DataFrame, path: str, epoch: int) -> None:
    (rows.withColumn("epoch", F.lit(epoch).cast("long")).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy("epoch").parquet(path))


def _passed(spark: SparkSession, path: str, before: int, delay: dt.timedelta) -> dt.datetime | None:
    """The watermark that the batches before ``before`` make."""
    seen = read_table(spark, path, "latest timestamp_ntz, epoch long")
    latest = None if seen is None else seen.where(F.col("epoch") < before).agg(F.max("latest")).first()[0]
    return None if latest is None else latest - delay


def stream_closed_periods(spark: SparkSession, source_dir: str, schema, ts: str, period: str, dims: dict, measures: list[Measure],
                          out_dir: str, checkpoint_dir: str, delay: dt.timedelta = dt.timedelta(days=1),
                          query_name: str = "closed_periods", trigger_once: bool = True):
    """Start the stream; returns the StreamingQuery. ``out_dir`` gets the tables ``module`` (closed periods), ``days``
    (partial values of closed days), ``late`` (facts that came too late, as they are) and ``progress``."""
    cycles.check_cycle(period, cycles.CYCLES)
    names, distinct = list(dims), L.one_distinct(measures)
    values = [f"__in_{i}" for i in distinct]
    facts = spark.readStream.schema(schema).parquet(source_dir)
    # A watermark needs an instant: the wall clock is read as UTC, whatever the session's time zone is.
    instant = F.timestamp_micros(F.expr(f"timestampdiff(MICROSECOND, {EPOCH}, CAST(`{ts}` AS TIMESTAMP_NTZ))"))
    placed_facts = placed(facts, ts, "day", dims, [instant.alias("__ts"), *L.inputs(measures)])
    days = (placed_facts.withWatermark("__ts", f"{int(delay.total_seconds())} seconds")
            .groupBy(F.window("__ts", "1 day").alias("__day"), *names, *values).agg(*L.partials(measures)))
    columns = [c for c in days.columns if c != "__day"]
    closed = days.select(F.expr(f"timestampadd(MICROSECOND, unix_micros(__day.start), {EPOCH})").alias("__at"), F.lit(None).cast(facts.schema).alias("__fact"), *columns)
    passing = facts.select(F.col(ts).cast("timestamp_ntz").alias("__at"), F.struct(*facts.columns).alias("__fact"),
                           *[F.lit(None).cast(days.schema[c].dataType).alias(c) for c in columns])

    def apply(batch: DataFrame, epoch: int) -> None:
        staged = f"{shared_folder(spark)}/closed-{uuid.uuid4().hex}"
        try:
            batch.write.parquet(staged)
            rows = spark.read.schema(batch.schema).parquet(staged)
            new = rows.where("__fact IS NOT NULL")
            # Spark accepts what the watermark of the batch before still lets in, and closes days by its own.
            accepted, now = (_passed(spark, f"{out_dir}/progress", e, delay) for e in (epoch - 1, epoch))
            before = _passed(spark, f"{out_dir}/progress", epoch - 1, delay)
            _replace(new.agg(F.max("__at").alias("latest")).where("latest IS NOT NULL"), f"{out_dir}/progress", epoch)
            if accepted is not None:
                late = F.col("__at") < cycles.ntz(cycles.start_of(accepted, "day"))
                _replace(new.where(late).select("__fact.*"), f"{out_dir}/late", epoch)
            _replace(rows.where("__fact IS NULL").select(F.col("__at").alias(PERIOD), *columns), f"{out_dir}/days", epoch)
            if now is None:
                return
            end = cycles.following_start(cycles.period_start(PERIOD, period), period)
            done = end <= cycles.ntz(now)
            if before is not None:
                done &= end > cycles.ntz(before)
            stored = spark.read.parquet(f"{out_dir}/days").where(done).drop("epoch")
            if not stored.isEmpty():
                upsert(L.modules_of_days(stored, names, measures, [period]), f"{out_dir}/module", ["id"], ["cycle", PERIOD],
                       keys_hold_partition=True)
        finally:
            _delete(spark, staged, True)

    w = (closed.unionByName(passing).writeStream.outputMode("append").foreachBatch(apply)
         .option("checkpointLocation", checkpoint_dir).queryName(query_name))
    return (w.trigger(availableNow=True) if trigger_once else w).start()
