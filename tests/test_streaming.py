"""Streaming ingestion of a module equals the batch module over the same facts."""

from metricbook.operators.pyramid import Measure, kpi_module
from metricbook.streaming.incremental import stream_module

SF = "/root/testdata/sf0.001"
MEASURES = [Measure("EVENTS", "count"), Measure("EVENT_VALUE", "sum", "value")]


def test_stream_goes_on_after_a_restart(spark, tmp_path):
    src, table = str(tmp_path / "events_in"), str(tmp_path / "module")
    events = spark.read.parquet(f"{SF}/events.parquet").select("ts", "user_id", "event_type", "value")

    def run():
        q = stream_module(spark, src, events.schema, "ts", "week", {"event_type": "event_type"}, MEASURES, table,
                          str(tmp_path / "stream"), query_name="test_stream_events")
        q.awaitTermination(300)
        got = spark.read.schema(want.schema).parquet(table)
        return got, kpi_module(spark.read.parquet(src), "ts", "week", {"event_type": "event_type"}, MEASURES)

    want = kpi_module(events, "ts", "week", {"event_type": "event_type"}, MEASURES)
    events.where("ts < timestamp_ntz'2024-01-10 00:00:00'").write.parquet(src)
    for later in (None, "ts >= timestamp_ntz'2024-01-10 00:00:00'", "ts >= timestamp_ntz'2024-01-28 00:00:00'"):
        if later:  # more files arrive (the last ones again), and the stream is started anew
            events.where(later).write.mode("append").parquet(src)
        got, expected = run()
        assert got.count() == expected.count() > 0
        assert got.select(*expected.columns).exceptAll(expected).isEmpty()


def _written(spark, path, schema=None):
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.parquet(path)


def test_closed_periods_are_emitted_once_and_late_facts_set_aside(spark, tmp_path):
    """Files out of order, some too late, the stream started anew for each."""
    import datetime as dt

    from metricbook.streaming.event_time import stream_closed_periods
    src, out = str(tmp_path / "in"), str(tmp_path / "out")
    events = spark.read.parquet(f"{SF}/events.parquet").select("ts", "user_id", "event_type", "value")
    measures = [*MEASURES, Measure("USERS", "count_distinct", "user_id")]
    dims = {"event_type": "event_type"}

    def between(a, b):
        return f"ts >= timestamp_ntz'2024-01-{a:02d} 00:00:00' AND ts < timestamp_ntz'2024-01-{b:02d} 00:00:00'"

    even = "user_id % 2 = 0"
    # What arrives in turn; of the third the days up to the 9th are closed by then, those of the 11th on are not.
    arrivals = [between(1, 8), between(12, 14), f"({between(8, 12)}) AND {even}", between(14, 18), f"({between(8, 12)}) AND NOT {even}",
                between(18, 29), between(29, 31)]
    seen = []
    for i, what in enumerate(arrivals):
        events.where(what).coalesce(1).write.mode("append").parquet(src)
        q = stream_closed_periods(spark, src, events.schema, "ts", "week", dims, measures, out, str(tmp_path / "stream"),
                                  dt.timedelta(days=3), query_name=f"closed_{i}")
        q.awaitTermination(300)
        assert q.exception() is None
        if (tmp_path / "out" / "module").exists():
            seen.append({tuple(r) for r in _written(spark, f"{out}/module").select("id", "value").collect()})
    late = _written(spark, f"{out}/late").drop("epoch")
    days = {r[0] for r in late.selectExpr("CAST(ts AS DATE)").collect()}
    assert late.count() > 0 and late.where(even).where("ts >= timestamp_ntz'2024-01-11 00:00:00'").isEmpty()
    assert days <= {dt.date(2024, 1, d) for d in range(8, 12)}
    on_time = events.exceptAll(late)
    want = kpi_module(on_time, "ts", "week", dims, measures).where("cycle_timestamp < timestamp_ntz'2024-01-22 00:00:00'")
    got = _written(spark, f"{out}/module", want.schema).select(*want.columns)
    assert got.count() == want.count() > 0 and got.exceptAll(want).isEmpty()
    assert all(a <= b for a, b in zip(seen, seen[1:])) and len(seen[0]) < len(seen[-1])  # nothing emitted is changed
    # The backfill table restates the periods: with the late facts the module is that of all facts.
    whole = kpi_module(on_time.unionAll(late), "ts", "week", dims, measures)
    assert whole.exceptAll(kpi_module(events, "ts", "week", dims, measures)).isEmpty()
