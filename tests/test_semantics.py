"""Hand-made frames for the calendar, dimension, override and trimming traps."""

import calendar
import datetime as dt
from decimal import ROUND_HALF_UP, Decimal

import pytest
from pyspark.sql import functions as F

from metricbook.config import RunConfig
from metricbook.functions import cycles, dims as D
from metricbook.operators import checks as C
from metricbook.operators.repository import ModuleContractError, build_repository, validate_module
from metricbook.operators.robust import trim_steps
from metricbook.sources.refdata import REPOSITORY, SCHEMAS


def _starts(spark, days, period):
    df = spark.createDataFrame([(d,) for d in days], "d date")
    return [r[0] for r in df.select(cycles.period_start(F.col("d").cast("timestamp_ntz"), period)).collect()]


def test_biweek_after_53_week_year(spark):
    days = [dt.date(2020, 12, 14) + dt.timedelta(days=i) for i in range(0, 43)]
    got = sorted(set(_starts(spark, days, "bi-week")))
    assert got[:3] == [dt.datetime(2020, 12, 14), dt.datetime(2020, 12, 28), dt.datetime(2021, 1, 4)]
    # python twin agrees day by day
    assert _starts(spark, days, "bi-week") == [cycles.start_of(d, "bi-week") for d in days]


def test_leap_day_minus_one_year():
    assert cycles.minus_one_year(dt.datetime(2024, 2, 29)) == dt.datetime(2023, 2, 28)


def test_last_complete_periods():
    a = dt.date(2001, 6, 15)
    assert cycles.last_complete("week", a) == dt.datetime(2001, 6, 4)
    assert cycles.last_complete("month", a) == dt.datetime(2001, 5, 1)
    assert cycles.last_complete("quarter", a) == dt.datetime(2001, 1, 1)
    assert cycles.last_complete("year", a) == dt.datetime(2000, 1, 1)
    assert cycles.last_complete("day", a) == dt.datetime(2001, 6, 14)


def test_canonical_dimensions_order_and_nulls(spark):
    rows = [('{"b":"1","a":"x"}',), ('{"a":"x","b":"1"}',), ("{}",), (None,), ('{"a":null}',)]
    out = [r[0] for r in spark.createDataFrame(rows, "j string").select(D.canonical("j")).collect()]
    assert out == ['{"a":"x","b":"1"}', '{"a":"x","b":"1"}', "{}", None, "{}"]
    names = spark.createDataFrame(rows, "j string").select(
        D.metric_name(F.lit("X"), D.entries("j")), D.display_name(F.lit(None), F.lit("X"), D.entries("j"))).collect()
    assert names[0][0] == "X by a x b" and names[2][0] == "X by *" and names[3][0] == "X by *"
    assert names[0][1] == "X - x, 1" and names[2][1] == "X - Global"


def test_week_prior_keys(spark):
    ts = [dt.datetime(2024, 12, 30), dt.datetime(2023, 1, 2), dt.datetime(2025, 12, 29), dt.datetime(2024, 1, 1)]
    df = spark.createDataFrame([(t,) for t in ts], "t timestamp_ntz")
    r = df.select(cycles.prior_match_key(F.lit("week"), "t"), cycles.prior_lookup_key(F.lit("week"), "t")).collect()
    # 2024-12-30 (week 1 of calendar 2024) looks up 2023-01-02
    assert r[0][1] == r[1][0]
    # 2025-12-29 has two candidates: 2024-01-01 and 2024-12-30
    assert r[2][1] == r[3][0] == r[0][0]


def test_shadow_override_by_id_and_coordinates(spark):
    mod = spark.createDataFrame([
        ("A", '{"k":"1"}', "week", dt.datetime(2024, 1, 1), Decimal("1"), "id1"),
        ("A", '{"k":"2"}', "week", dt.datetime(2024, 1, 1), Decimal("2"), "id2"),
        ("A", '{"k":"3"}', "week", dt.datetime(2024, 1, 1), Decimal("3"), "id3")],
        "indicator string, dimensions string, cycle string, cycle_timestamp timestamp_ntz, value decimal(18,4), id string")
    shadow = spark.createDataFrame([
        ("A", '{"k": "9"}', dt.datetime(2024, 1, 1), "week", Decimal("10.12345678"), "id1"),
        ("A", '{"k": "2"}', dt.datetime(2024, 1, 1), "week", Decimal("20"), "new"),
        ("B", "{}", dt.datetime(2024, 1, 1), "week", Decimal("30"), "other")], SCHEMAS["repository_shadow"])
    out = build_repository(spark, {"m": mod}, shadow).orderBy("id").collect()
    assert [(r.id, r.value) for r in out] == [
        ("id1", Decimal("10.1235")), ("id3", Decimal("3.0000")), ("new", Decimal("20.0000")), ("other", Decimal("30.0000"))]


def test_empty_repository_keeps_schema(spark):
    df = build_repository(spark, {}, None)
    assert df.count() == 0 and df.schema == REPOSITORY


def test_module_contract(spark):
    df = spark.createDataFrame([("A",)], "INDICATOR string")
    with pytest.raises(ModuleContractError):
        validate_module("bad", df)


# Points, and the mean of what trimming leaves, worked out by hand: 90 lies 2.24 sigma out and goes,
# the rest is within two sigma; in [5 x 5, 6] the six goes; 100 goes; symmetric and flat series keep all.
@pytest.mark.parametrize("pts, want", [
    ([.1, .2, .3, .4, .5, 90], 0.3), ([5, 5, 5, 5, 5, 6], 5.0), ([1, 1, 1, 9, 9, 9], 5.0), ([3, 3, 3, 3, 3, 3], 3.0),
    ([100, 1, 2, 3, 4, 5], 3.0)])
def test_robust_trimming_by_hand(spark, pts, want):
    df = spark.createDataFrame([([float(x) for x in pts],)], "a array<double>")
    out, last = trim_steps(df, "a")
    got = out.select(F.aggregate(last, F.lit(0.0), lambda acc, x: acc + x) / F.size(last)).first()[0]
    assert got == pytest.approx(want)


def test_json_key_checks_null_relation(spark):
    df = spark.createDataFrame([('{"geo":"US"}',), ('{"geo":"XX"}',), ("{}",)], "dimensions string")
    rel = spark.createDataFrame([("US",), (None,)], "v string")
    bad = C.json_key_accepted_values(df, "dimensions", "geo", relation=rel, relation_column="v")
    assert [r[0] for r in bad.collect()] == ['{"geo":"XX"}']
    # empty accepted set: every present value fails
    assert C.json_key_accepted_values(df, "dimensions", "geo").count() == 2


def test_hour_rejected_by_timeseries(spark):
    from metricbook.operators.timeseries import timeseries_analysis
    with pytest.raises(ValueError):
        timeseries_analysis(spark.createDataFrame([], REPOSITORY), RunConfig(reporting_period="hour"))


def test_upsert_touches_only_its_partitions(spark, tmp_path):
    from metricbook.sources.sink import read_table, upsert
    path = str(tmp_path / "t")
    schema = "id string, v int, p string"

    def files(p):
        return {f.name: f.stat().st_mtime_ns for f in (tmp_path / "t" / f"p={p}").glob("*.parquet")}

    assert read_table(spark, path) is None
    first = spark.createDataFrame([("1", 1, "a"), ("2", 2, "a"), ("3", 3, "b"), ("4", 4, "c")], schema)
    upsert(first, path, ["id"], ["p"])
    b, c = files("b"), files("c")
    batch = spark.createDataFrame([("2", 20, "a"), ("4", 40, "a"), ("5", 5, "d")], schema)
    for _ in range(2):  # a repeated batch changes nothing
        upsert(batch, path, ["id"], ["p"])
        got = sorted(tuple(r) for r in spark.read.schema(first.schema).parquet(path).collect())
        assert got == [("1", 1, "a"), ("2", 20, "a"), ("3", 3, "b"), ("4", 40, "a"), ("5", 5, "d")]
    assert files("b") == b and c and not files("c")


def test_upsert_drops_rows_at_the_same_coordinates(spark, tmp_path):
    from metricbook.sources.sink import upsert
    path, schema = str(tmp_path / "t"), "id string, k string, p string"
    upsert(spark.createDataFrame([("1", "x", "a"), ("2", "y", "a")], schema), path, ["id"], ["p"])
    upsert(spark.createDataFrame([("9", "x", "a")], schema), path, ["id"], ["p"], coordinates=["k"])
    assert sorted(r.id for r in spark.read.parquet(path).collect()) == ["2", "9"]


def test_upsert_into_timestamp_partitions(spark, tmp_path):
    from metricbook.sources.sink import upsert
    path, schema = str(tmp_path / "t"), "id string, at timestamp_ntz"
    one, two = dt.datetime(2024, 1, 1), dt.datetime(2024, 1, 8, 5)
    upsert(spark.createDataFrame([("1", one), ("2", one), ("3", None)], schema), path, ["id"], ["at"])
    upsert(spark.createDataFrame([("1", two), ("2", two), ("3", None)], schema), path, ["id"], ["at"])
    got = spark.read.schema(schema).parquet(path).collect()
    assert sorted((r.id, r["at"]) for r in got if r["at"]) == [("1", two), ("2", two)] and len(got) == 3


def test_merge_refuses_repeated_keys(spark):
    from metricbook.sources.sink import DuplicateKeyError, merge_frames
    target = spark.createDataFrame([("1", 0)], "id string, v int")
    batch = spark.createDataFrame([("1", 1), ("1", 2)], "id string, v int")
    with pytest.raises(DuplicateKeyError):
        merge_frames(target, batch, ["id"], "merge")
    assert merge_frames(target, batch.limit(1), ["id"], "merge").count() == 1


def test_seed_files(spark, tmp_path):
    from metricbook.sources.refdata import read_reference
    header = "indicator,dimensions,cycle_timestamp,cycle,value,id\n"
    f = tmp_path / "shadow.csv"
    f.write_text(header + 'A,"{""geo"": ""US"", ""a"": ""x, y""}",2024-01-01 00:00:00,week,1.5,"say ""hi"""\n'
                 "NA,{},2024-01-08 00:00:00,week,,z\n", encoding="utf-8")
    rows = read_reference(spark, "repository_shadow", str(f)).collect()
    assert rows[0].dimensions == '{"a":"x, y","geo":"US"}' and rows[0].id == 'say "hi"'
    assert rows[1].indicator == "NA" and rows[1].value is None
    f.write_text(header)
    empty = read_reference(spark, "repository_shadow", str(f))
    assert empty.count() == 0 and empty.schema["value"].dataType == SCHEMAS["repository_shadow"]["value"].dataType
    g = tmp_path / "regions.csv"
    g.write_text("REGION,COUNTRY_CODE\nEurope,FR\n")
    with pytest.raises(Exception):
        read_reference(spark, "country_regions", str(g)).collect()


def test_dirty_dimensions_survive(spark):
    rows = [('{"a":"1","a":"2","b":null}',), ("not json",), ("[1]",), ('{"a":{"b":1}}',)]
    df = spark.createDataFrame(rows, "j string")
    assert [r[0] for r in df.select(D.canonical("j")).collect()] == ['{"a":"2"}', None, None, '{"a":"{\\"b\\":1}"}']
    assert [r[0] for r in df.select(D.get_key("j", "a")).collect()][:3] == ["2", None, None]
    kinds = spark.createDataFrame([({"b": "1", "a": None},)], "d map<string,string>")
    assert kinds.select(D.canonical_any("d", kinds.schema["d"])).first()[0] == '{"b":"1"}'
    variant = df.limit(1).select(F.parse_json(F.lit('{"z": "1", "a": 2}')).alias("d"))
    assert variant.select(D.canonical_any("d", variant.schema["d"])).first()[0] == '{"a":"2","z":"1"}'


def test_report_parses_dimensions_once(spark):
    from metricbook.plans import catalog
    plan = catalog.QUERIES["report_week"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("from_json") == 1


@pytest.mark.parametrize("name, column", [("report_incremental_week", "o_orderdate"), ("report_incremental_week", "l_shipdate"),
                                          ("timeseries_incremental", "o_orderdate"), ("report_incremental_month", "l_shipdate"),
                                          ("repository_incremental", "o_orderdate"), ("top_movers", "o_orderdate"),
                                          ("yoy_pivot", "l_shipdate")])
def test_incremental_queries_push_their_periods(spark, name, column):
    from metricbook.plans import catalog
    plan = catalog.QUERIES[name](spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    scans = [line for line in plan.splitlines() if "FileScan" in line and column in line]
    assert scans and all(f"GreaterThanOrEqual({column}" in line for line in scans)


def test_distinct_counts_scan_the_facts_once(spark):
    from metricbook.plans import catalog
    plan = catalog.QUERIES["module_events_day"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString()
    lines = [x.strip(" :+-") for x in plan.splitlines()]
    assert sum("parquet" in x for x in lines) == 1
    expand = max(i for i, x in enumerate(lines) if x.startswith("Expand"))
    assert any(x.startswith("Aggregate") for x in lines[expand + 1:])


def test_needed_periods():
    a = dt.date(2001, 6, 15)
    assert cycles.needed_starts("week", a, prior=True) == [dt.datetime(2000, 6, 5), dt.datetime(2001, 6, 4)]
    assert cycles.needed_starts("month", a, lookback=2, prior=True) == [
        dt.datetime(2000, 5, 1), dt.datetime(2001, 3, 1), dt.datetime(2001, 4, 1), dt.datetime(2001, 5, 1)]
    # two weeks numbered 1 in calendar 2024
    assert cycles.prior_starts(dt.datetime(2025, 12, 29), "week") == [dt.datetime(2024, 1, 1), dt.datetime(2024, 12, 30)]
    assert cycles.next_start(dt.datetime(2020, 12, 28), "bi-week") == dt.datetime(2021, 1, 4)
    assert cycles.last_complete("bi-week", dt.date(2021, 1, 10)) == dt.datetime(2020, 12, 21)
    assert cycles.last_complete("bi-week", dt.date(2021, 1, 10), strict_biweek=True) == dt.datetime(2020, 12, 28)


def test_check_suite(spark):
    rows = spark.createDataFrame([(1, None), (2, "x"), (3, "y")], "i int, s string")
    checks = [C.Check("no_null", rows, F.col("s").isNull()), C.Check("small", rows, F.col("i") > 2, severity="warn"),
              C.Check("fine", rows=lambda: rows.where("i > 9")), C.Check("off", rows, F.lit(True), enabled=False)]
    out = {r.check: (r.failures, r.status) for r in C.run_checks(spark, checks).collect()}
    assert out == {"no_null": (1, "fail"), "small": (1, "warn"), "fine": (0, "pass")}
    assert C.run_checks(spark, []).count() == 0


def test_stale_coordinates(spark):
    m = spark.createDataFrame([("A", '{"geo":"US"}', "week", dt.datetime(2001, 6, 4)), ("A", '{"geo":"FR"}', "week", dt.datetime(2001, 5, 28))],
                              "indicator string, dimensions string, cycle string, cycle_timestamp timestamp_ntz")
    assert C.freshness(m, "week", dt.date(2001, 6, 15)).count() == 0
    assert [r.dimensions for r in C.freshness(m, "week", dt.date(2001, 6, 15), by="coordinates").collect()] == ['{"geo":"FR"}']


def test_profile_rules(spark):
    from metricbook.operators.profile import profile_tables
    countries = spark.createDataFrame([("FR",), ("DE",)], "alpha_2 string")
    t = spark.createDataFrame([('{"country":"FR","x":"1"}', 1.0, "1100")], "dimensions string, value double, GL_ACCOUNT_NUMBER string")
    out = {(r.table_name, r.column_name): r for r in
           profile_tables(spark, {"KPI_a": t, "kpib": t, "other": t, "kpi_bad": t.select(F.lit(1).alias("dimensions"))}, "view", "kpi", countries).collect()}
    assert out["kpi_a", "value"].suggested_check == "not_null" and out["kpib", "value"].suggested_check is None
    assert out["kpi_a", "gl_account_number"].suggested_check.startswith("not_null; accepted_values(1100, 2500")
    assert out["kpi_a", "dimensions:country"].suggested_check == "json_key_accepted_values(country: XX, DE, FR)"
    assert out["kpi_a", "dimensions:x"].suggested_check is None and out["kpi_a", "dimensions:x"].table_type == "view"
    assert any(r.table_name == "kpi_bad" and "Error" in (r.description or "") for r in out.values())
    assert not any(k[0] == "other" for k in out)


def test_seasonal_indices_cancel_a_pure_season(spark):
    from metricbook.operators.decompose import decompose
    rows = [("A", "{}", "quarter", dt.datetime(2018 + i // 4, 1 + 3 * (i % 4), 1), Decimal(100 + [10, -5, 0, -5][i % 4])) for i in range(24)]
    df = spark.createDataFrame(rows, "indicator string, dimensions string, cycle string, cycle_timestamp timestamp_ntz, current_value decimal(18,4)")
    out = decompose(df, RunConfig("quarter", dt.date(2024, 1, 1), as_of=dt.date(2024, 1, 1))).orderBy("cycle_timestamp").collect()
    assert {r.trend for r in out[2:-2]} == {100.0} and [r.seasonal for r in out[:4]] == [10.0, -5.0, 0.0, -5.0]


def test_wide_pyramid_with_several_measures(spark):
    from metricbook.operators.pyramid import Measure, pyramid
    facts = spark.createDataFrame([(dt.datetime(2024, 1, 1), "a", 1, 5), (dt.datetime(2024, 1, 2), "b", 1, 6), (dt.datetime(2024, 1, 3), "a", 2, 7)],
                                  "t timestamp_ntz, d string, u int, v int")
    out = pyramid(facts, "t", "week", ["d"], [Measure("N", "count"), Measure("U", "count_distinct", "u"), Measure("V", "count_distinct", "v"),
                                              Measure("LOW", "min", "v")])
    got = {r.d: (int(r.N), int(r.U), int(r.V), int(r.LOW)) for r in out.collect()}
    assert got == {None: (3, 2, 3, 5), "a": (2, 2, 2, 5), "b": (1, 1, 1, 6)}


def test_plan_split_day_shares_sum_to_month(spark):
    from metricbook.operators.plan_split import split_monthly_plan
    aop = spark.createDataFrame([
        (dt.datetime(2024, 2, 1), Decimal("100.00000001"), "A", "{}", "month"),
        (dt.datetime(2024, 3, 1), Decimal("7"), "A", "{}", "month")], SCHEMAS["aop_targets"])
    days = split_monthly_plan(aop, "day")
    tot = {r[0]: r[1] for r in days.groupBy(F.trunc(F.to_date("cycle_timestamp"), "month"))
           .agg(F.sum("plan")).collect()}
    assert tot[dt.date(2024, 2, 1)] == Decimal("100.00000001") and tot[dt.date(2024, 3, 1)] == Decimal("7")
    assert days.count() == 29 + 31
    weeks = split_monthly_plan(aop, "week")
    # the week of 2024-02-26 spans February and March
    wk = weeks.where(F.col("cycle_timestamp") == dt.datetime(2024, 2, 26)).first()
    assert wk is not None and wk.plan > 0


@pytest.mark.parametrize("target", ["bi-week", "day", "week"])
def test_plan_split_of_plans_beyond_eighteen_digits(spark, target):
    from metricbook.operators.plan_split import split_monthly_plan
    from metricbook.plans.testdata import aop_from
    values = {dt.date(2024, 1, 1): Decimal("30727305617.4001"), dt.date(2024, 2, 1): Decimal("99999999999999.9999")}
    repo = spark.createDataFrame([("orders_module", "REVENUE", "{}", "month", dt.datetime(m.year, m.month, 1), v, str(m))
                                  for m, v in values.items()], REPOSITORY)
    want = {}
    for m, v in values.items():
        plan, n = v * Decimal("1.05"), calendar.monthrange(m.year, m.month)[1]
        share = (plan / n).quantize(Decimal("1e-8"), ROUND_HALF_UP)
        for i in range(n):
            d = m + dt.timedelta(i)
            week = d.isocalendar().week
            start = d if target == "day" else d - dt.timedelta(d.weekday() + 7 * (target == "bi-week" and week % 2 == 0))
            want[start] = want.get(start, 0) + (share if i < n - 1 else plan - share * (n - 1))
    out = split_monthly_plan(aop_from(repo), target)
    assert {r.cycle_timestamp.date(): r.plan for r in out.collect()} == want
    assert sum(want.values()) == sum(values.values()) * Decimal("1.05")


def test_generation_cohort_boundaries(spark):
    from metricbook.operators.insights import generation_cohort, generation_years
    people = spark.createDataFrame([(1, 1996), (2, 1997), (3, 1921), (4, 2039), (5, None)], "pid int, born int")
    out = {r.pid: r.generation for r in generation_cohort(people, "born", generation_years(spark)).collect()}
    assert out == {1: "Millennials", 2: "Gen Z", 3: None, 4: "Beta", 5: None}


def test_holiday_rules(spark):
    from metricbook.operators.insights import fixed_date_holidays
    h = fixed_date_holidays(spark, "US", [(7, 4, "Independence Day")], 2000, 2001)
    assert sorted(r.date for r in h.collect()) == [dt.date(2000, 7, 4), dt.date(2001, 7, 4)]


def test_optional_tables(spark):
    from metricbook.sources.refdata import KPI_MODULE, empty, optional_table
    assert optional_table(spark, "no_such_table_here") is None
    spark.range(3).createOrReplaceTempView("some_overrides")
    assert optional_table(spark, "some_overrides").count() == 3
    assert empty(spark, KPI_MODULE).schema == KPI_MODULE


def test_hour_modules(spark):
    from metricbook.operators.pyramid import Measure, kpi_module
    facts = spark.createDataFrame([(dt.datetime(2024, 1, 1, 10, 5), "a"), (dt.datetime(2024, 1, 1, 10, 59), "a"),
                                   (dt.datetime(2024, 1, 1, 11, 0), "b")], "t timestamp_ntz, d string")
    out = kpi_module(facts, "t", "hour", ["d"], [Measure("N", "count")]).where("dimensions = '{}'").collect()
    assert {r.cycle_timestamp: int(r.value) for r in out} == {dt.datetime(2024, 1, 1, 10): 2, dt.datetime(2024, 1, 1, 11): 1}


def test_bands_without_room_for_exact_sums(spark):
    from metricbook.operators.timeseries import timeseries_analysis
    big = Decimal("99999999999999.9999")
    rows = [("A", "{}", "year", dt.datetime(2015 + i, 1, 1), v, "m", "m", "", 0.0, "", None, None, "x", f"i{i}")
            for i, v in enumerate([big, -big, big, Decimal(1), Decimal(2), Decimal(3), Decimal(9)])]
    rep = spark.createDataFrame(rows, "indicator string, dimensions string, cycle string, cycle_timestamp timestamp_ntz, "
                                "current_value decimal(18,4), metric string, metric_display_name string, coordinates string, "
                                "sortkey double, label string, prior_value decimal(18,4), aop_value decimal(18,8), alt_id string, id string")
    out = timeseries_analysis(rep, RunConfig("year", dt.date(2023, 1, 1), backfill=True, spine_start=dt.date(2015, 1, 1),
                                             as_of=dt.date(2022, 1, 1))).orderBy("cycle_timestamp").collect()
    assert [r.has_history for r in out] == [False] * 3 + [True] * 4
    assert out[-1].midpoint == 2.0 and out[-1].sigma == 1.0 and out[-1].alert == "↑"
