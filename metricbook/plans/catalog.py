"""Registered queries (Spark) and their DuckDB oracle SQL, keyed by name."""

from __future__ import annotations

import datetime as dt
from functools import partial

from metricbook.functions import cycles
from metricbook.plans import oracle as O
from metricbook.plans import testdata as TD

QUERIES: dict = {}
ORACLE: dict = {}


def register(name: str, fn, sql: str | None = None):
    QUERIES[name] = fn
    if sql is not None:
        ORACLE[name] = sql


# ---------------------------------------------------------------- stage 1: modules / pyramid
def _pyramid(period, spark, base):
    return TD.orders_module(spark, base, period)


for _p in ("day", "week", "bi-week", "month", "quarter", "year"):
    register(f"pyramid_{_p.replace('-', '')}", partial(_pyramid, _p), O.orders_module(_p))

register("pyramid_geo", lambda spark, base: TD.orders_geo_module(spark, base, "week"),
         O.orders_geo_module("week"))
register("module_events_day", lambda spark, base: TD.events_module(spark, base, "day"),
         O.events_module("day"))
register("module_lineitem_month", lambda spark, base: TD.lineitem_module(spark, base, "month"),
         O.lineitem_module("month"))
register("module_last_complete",
         lambda spark, base: TD.orders_module(spark, base, "week", TD.cfg("week", backfill=False)),
         O.orders_module("week", anchor=TD.ANCHOR))


# ---------------------------------------------------------------- stage 2: repository
def _needed(period, **kw):
    return cycles.needed_starts(period, TD.ANCHOR, **kw)


def _mods_sql(period, anchor=None):
    return {"orders_module": O.orders_module(period, anchor), "lineitem_module": O.lineitem_module(period, anchor)}


register("repository_union", lambda spark, base: TD.repository(spark, base, "week"),
         O.repository(_mods_sql("week")))
register("repository_shadow_by_id",
         lambda spark, base: TD.repository(spark, base, "week", TD.SHADOW_BY_ID + TD.SHADOW_NEW),
         O.repository(_mods_sql("week"), O.shadow_values(TD.SHADOW_BY_ID + TD.SHADOW_NEW)))
register("repository_shadow_by_coords",
         lambda spark, base: TD.repository(spark, base, "week", TD.SHADOW_BY_COORDS),
         O.repository(_mods_sql("week"), O.shadow_values(TD.SHADOW_BY_COORDS)))
register("repository_incremental",
         lambda spark, base: TD.repository(spark, base, "week", TD.SHADOW_BY_ID + TD.SHADOW_BY_COORDS,
                                           TD.cfg("week", backfill=False), only=_needed("week")),
         O.repository(_mods_sql("week"), O.shadow_values(TD.SHADOW_BY_ID + TD.SHADOW_BY_COORDS),
                      period="week", anchor=TD.ANCHOR))


# ---------------------------------------------------------------- stage 3: report
def _report(period, spark, base, backfill=True, aop_scope=None, only=None):
    """``only``: the periods whose events are read; an incremental report needs its own and their prior year's."""
    from metricbook.operators.report import performance_report
    if not backfill and only is None:
        only = _needed(period, prior=True)
    repo = TD.repository(spark, base, period, only=only)
    run = TD.cfg(period, backfill=backfill, **({"aop_scope": aop_scope} if aop_scope else {}))
    aop = TD.aop_from(repo) if aop_scope else None
    return performance_report(repo, TD.glossary(spark), aop, run)


def _aop_sql(period):
    return (f"SELECT cycle_timestamp, CAST(value * 1.05 AS DECIMAL(18,8)) AS plan, indicator, dimensions, cycle "
            f"FROM ({O.repository(_mods_sql(period))}) r WHERE indicator = 'REVENUE'")


for _p in ("day", "week", "bi-week", "month", "quarter", "year"):
    register(f"report_{_p.replace('-', '')}", partial(_report, _p), O.report(O.repository(_mods_sql(_p)), _p))

register("report_incremental_week", partial(_report, "week", backfill=False),
         O.report(O.repository(_mods_sql("week")), "week", anchor=TD.ANCHOR))
register("report_incremental_month", partial(_report, "month", backfill=False),
         O.report(O.repository(_mods_sql("month")), "month", anchor=TD.ANCHOR))
register("report_aop_all", partial(_report, "week", aop_scope="all"),
         O.report(O.repository(_mods_sql("week")), "week", aop_sql=_aop_sql("week"), aop_scope="all"))
register("report_aop_last_complete", partial(_report, "week", aop_scope="last_complete"),
         O.report(O.repository(_mods_sql("week")), "week", aop_sql=_aop_sql("week"), aop_scope="last_complete"))


# ---------------------------------------------------------------- stage 4: time series, robust baseline
def _timeseries(period, spark, base, backfill=True):
    from metricbook.operators.timeseries import timeseries_analysis
    only = None if backfill else _needed(period, lookback=cycles.LOOKBACK[period], prior=True)
    rep = _report(period, spark, base, only=only)
    return timeseries_analysis(rep, TD.cfg(period, backfill=backfill))


def _report_sql(period):
    return O.report(O.repository(_mods_sql(period)), period)


for _p in ("day", "week", "bi-week", "month", "quarter", "year"):
    register(f"timeseries_{_p.replace('-', '')}", partial(_timeseries, _p),
             O.timeseries(_report_sql(_p), _p, TD.SPINE_START, TD.AS_OF))

register("timeseries_incremental", partial(_timeseries, "week", backfill=False),
         O.timeseries(_report_sql("week"), "week", TD.SPINE_START, TD.AS_OF, anchor=TD.ANCHOR))


def _robust(spark, base):
    from metricbook.operators.robust import robust_baseline
    return robust_baseline(_report("week", spark, base), TD.cfg("week"))


register("robust_baseline_week", _robust,
         O.robust(_report_sql("week"), "week", TD.SPINE_START, TD.AS_OF))


# ---------------------------------------------------------------- stage 5: owners and checks
def _owners(spark, base):
    from pyspark.sql import functions as F
    from metricbook.operators.owners import kpi_owners, owner_rules
    present = TD.repository(spark, base, "week").select("indicator").distinct()
    g = TD.glossary(spark).join(present, on="indicator", how="left_semi")
    return kpi_owners(g, owner_rules(spark))


_RULES_SQL = ("(SELECT * FROM (VALUES (DATE '2025-01-01', 'acquisition', 'John Doe', '', 'Jane Doe'), "
              "(DATE '2025-01-01', 'conversion', 'Jose Sanchez', '', 'Josephine Sanchez'), "
              "(DATE '2025-01-01', 'engagement', 'Ivan Petrov', '', 'Maria Petrova')) "
              "AS r(effective_date, category, owner, lead_analyst, bi_pal))")
register("owners", _owners, f"""
    SELECT DISTINCT r.effective_date, g.indicator, r.owner, r.lead_analyst, r.bi_pal
    FROM {O.glossary_values()} g JOIN {_RULES_SQL} r ON g.category = r.category
    WHERE g.is_kpi = TRUE AND g.indicator IN (SELECT indicator FROM ({O.repository(_mods_sql("week"))}) x)""")


def _check(fn):
    def run(spark, base):
        from metricbook.operators import checks as C
        return fn(C, spark, base)
    return run


register("check_not_null", _check(lambda C, s, b: C.not_null(_report("week", s, b), "prior_value")
                                  .select("id", "indicator", "dimensions", "cycle_timestamp")),
         f"SELECT id, indicator, dimensions, cycle_timestamp FROM ({_report_sql('week')}) r WHERE prior_value IS NULL")
register("check_unique", _check(lambda C, s, b: C.unique(
            __import__("metricbook.sources.tables", fromlist=["x"]).read_table(s, b, "events", ["user_id"]), "user_id")),
         "SELECT user_id AS unique_field, COUNT(*) AS n_records FROM events WHERE user_id IS NOT NULL "
         "GROUP BY user_id HAVING COUNT(*) > 1")
register("check_accepted_values", _check(lambda C, s, b: C.accepted_values(
            __import__("metricbook.sources.tables", fromlist=["x"]).read_table(s, b, "orders", ["o_orderpriority"]),
            "o_orderpriority", ["1-URGENT", "2-HIGH", "3-MEDIUM"])),
         "SELECT CAST(o_orderpriority AS VARCHAR) AS value_field, COUNT(*) AS n_records FROM orders "
         "WHERE o_orderpriority IS NOT NULL AND o_orderpriority NOT IN ('1-URGENT', '2-HIGH', '3-MEDIUM') GROUP BY 1")
_DOUBLE_MODULE = (lambda s, b: TD.orders_module(s, b, "week").unionByName(
    TD.orders_module(s, b, "week").where("dimensions = '{}'")))
register("check_unique_combination", _check(lambda C, s, b: C.unique_combination(
            _DOUBLE_MODULE(s, b), ["indicator", "dimensions", "cycle", "cycle_timestamp"])),
         f"SELECT indicator, dimensions, cycle, cycle_timestamp, COUNT(*) AS n_records FROM "
         f"(SELECT * FROM ({O.orders_module('week')}) a UNION ALL SELECT * FROM ({O.orders_module('week')}) b "
         f"WHERE dimensions = '{{}}') u GROUP BY ALL HAVING COUNT(*) > 1")
register("check_values_in_other", _check(lambda C, s, b: C.values_in_other(
            TD.repository(s, b, "week"), "indicator", TD.glossary(s).where("indicator <> 'NET_REVENUE'"), "indicator")),
         f"SELECT r.indicator AS invalid_value FROM ({O.repository(_mods_sql('week'))}) r "
         f"LEFT JOIN (SELECT indicator FROM {O.glossary_values()} g WHERE indicator <> 'NET_REVENUE') a "
         f"ON r.indicator = a.indicator WHERE a.indicator IS NULL")
register("check_freshness", _check(lambda C, s, b: C.freshness(
            TD.orders_module(s, b, "week").where(
                "NOT (dimensions LIKE '%segment%' AND dimensions NOT LIKE '%status%' "
                "AND cycle_timestamp = timestamp_ntz'2001-06-04 00:00:00')"), "week", TD.ANCHOR)),
         f"""WITH m AS (SELECT * FROM ({O.orders_module('week')}) x WHERE NOT (dimensions LIKE '%segment%'
                AND dimensions NOT LIKE '%status%' AND cycle_timestamp = TIMESTAMP '2001-06-04 00:00:00')),
             u AS (SELECT DISTINCT indicator, list_sort(json_keys(dimensions)) AS dimensions FROM m),
             c AS (SELECT DISTINCT indicator, list_sort(json_keys(dimensions)) AS dimensions FROM m
                   WHERE cycle = 'week' AND cycle_timestamp = TIMESTAMP '2001-06-04 00:00:00')
             SELECT u.indicator, u.dimensions FROM u LEFT JOIN c USING (indicator, dimensions)
             WHERE c.indicator IS NULL""")
register("check_json_key_accepted_values", _check(lambda C, s, b: C.json_key_accepted_values(
            TD.orders_module(s, b, "week"), "dimensions", "status", values=["F"],
            relation=__import__("metricbook.sources.tables", fromlist=["x"]).read_table(s, b, "orders", ["o_orderstatus"])
            .where("o_orderstatus <> 'P'"), relation_column="o_orderstatus")),
         f"SELECT * FROM ({O.orders_module('week')}) m WHERE (dimensions->>'status') IS NOT NULL AND "
         f"(dimensions->>'status') NOT IN (SELECT o_orderstatus FROM orders WHERE o_orderstatus <> 'P' "
         f"UNION SELECT 'F')")


# ---------------------------------------------------------------- stage 6: sinks
def _upsert(spark, base):
    """delete+insert of the last complete week (incremental run) into the full weekly module."""
    from metricbook.sources.sink import merge_frames
    target = TD.orders_module(spark, base, "week")
    batch = TD.orders_module(spark, base, "week", TD.cfg("week", backfill=False))
    from pyspark.sql import functions as F
    batch = batch.withColumn("value", (F.col("value") + 1).cast("decimal(18,4)"))
    return merge_frames(target, batch, ["id"], "delete_insert")


register("upsert_delete_insert", _upsert, f"""
    WITH t AS ({O.orders_module('week')}),
         b AS (SELECT indicator, dimensions, cycle, cycle_timestamp, CAST(value + 1 AS DECIMAL(18,4)) AS value, id
               FROM ({O.orders_module('week', anchor=TD.ANCHOR)}) x)
    SELECT * FROM t WHERE id NOT IN (SELECT id FROM b) UNION ALL SELECT * FROM b""")


# ---------------------------------------------------------------- stage 7: profile and downstream jobs
def _profile(spark, base):
    from metricbook.operators.profile import profile_tables
    return profile_tables(spark, {"kpi__repository": TD.repository(spark, base, "week"),
                                  "KPI_Events": TD.events_module(spark, base, "day"),
                                  "kpi__geo": TD.orders_geo_module(spark, base, "month"),
                                  "other": TD.events_module(spark, base, "day")}, name_prefix="KPI_")


def _profile_sql():
    columns = _MODULE_COLUMNS
    whole = [("_source_relation", "string", "", None), ("indicator", "string", "", None)] + columns[1:]
    return _profile_rows({"kpi__repository": (O.repository(_mods_sql("week")), whole), "kpi_events": (O.events_module("day"), columns),
                          "kpi__geo": (O.orders_geo_module("month"), columns)}, "base table")


def _profile_rows(tables, table_type):
    parts = []
    for name, (sql, columns) in tables.items():
        rows = ", ".join(f"({i}, {O.q(c)}, {O.q(t)}, {O.q(d)}, {'NULL' if k is None else O.q(k)})"
                         for i, (c, t, d, k) in enumerate(columns, 1))
        parts.append(f"""SELECT '{name}' AS table_name, '{table_type}' AS table_type, position, column_name, data_type, description,
                        suggested_check
                 FROM (VALUES {rows}) v(position, column_name, data_type, description, suggested_check)
                 UNION ALL
                 SELECT DISTINCT '{name}', '{table_type}', CAST(NULL AS INTEGER), 'dimensions:' || k, 'string',
                        'dimension key ' || k, CASE k WHEN 'geo' THEN 'json_key_accepted_values(geo: US, ROW)' END
                 FROM (SELECT unnest(json_keys(dimensions)) AS k FROM ({sql}) m) u""")
    return " UNION ALL ".join(parts)


def _catalog_profile(spark, base):
    """What the session's catalog lists, here temporary views of modules over the given tables."""
    from metricbook.operators.profile import profile_catalog
    views = {"KPI__catalog_orders": TD.orders_module(spark, base, "week"), "kpi__catalog_events": TD.events_module(spark, base, "day"),
             "kpi__catalog_geo": TD.orders_geo_module(spark, base, "month"), "another_catalog": TD.events_module(spark, base, "day")}
    for name, df in views.items():
        df.createOrReplaceTempView(name)
    try:
        return profile_catalog(spark, name_prefix="kpi__CATALOG_")
    finally:
        for name in views:
            spark.catalog.dropTempView(name)


_MODULE_COLUMNS = [
    ("indicator", "string", "", None), ("dimensions", "string", "Measurement dimensional coordinates", "not_null"),
    ("cycle", "string", "Reporting time period", "not_null; accepted_values(minute, hour, day, week, month, year)"),
    ("cycle_timestamp", "timestamp_ntz", "Timestamp associated with the reporting time period start time", "not_null"),
    ("value", "decimal(18,4)", "Metric measurement value observed at the reporting period.", "not_null"),
    ("id", "string", "Unique record identifier", "primary_key; unique_combination_of_columns(id)")]
register("table_profile", _profile, _profile_sql())
register("catalog_profile", _catalog_profile, _profile_rows(
    {"kpi__catalog_orders": (O.orders_module("week"), _MODULE_COLUMNS), "kpi__catalog_events": (O.events_module("day"), _MODULE_COLUMNS),
     "kpi__catalog_geo": (O.orders_geo_module("month"), _MODULE_COLUMNS)}, "temporary view"))


def _profile_repository(spark, base):
    """The weekly repository of both modules by itself."""
    from metricbook.operators.profile import profile_tables
    return profile_tables(spark, {"kpi__repository": TD.repository(spark, base, "week")})


def _profile_repository_sql():
    return f"""
    SELECT 'kpi__repository' AS table_name, 'base table' AS table_type, position, column_name, data_type, description,
           suggested_check
    FROM (VALUES
        (1, '_source_relation', 'string', '', NULL), (2, 'indicator', 'string', '', NULL),
        (3, 'dimensions', 'string', 'Measurement dimensional coordinates', 'not_null'),
        (4, 'cycle', 'string', 'Reporting time period', 'not_null; accepted_values(minute, hour, day, week, month, year)'),
        (5, 'cycle_timestamp', 'timestamp_ntz', 'Timestamp associated with the reporting time period start time', 'not_null'),
        (6, 'value', 'decimal(18,4)', 'Metric measurement value observed at the reporting period.', 'not_null'),
        (7, 'id', 'string', 'Unique record identifier', 'primary_key; unique_combination_of_columns(id)')
    ) v(position, column_name, data_type, description, suggested_check)
    UNION ALL
    SELECT DISTINCT 'kpi__repository', 'base table', CAST(NULL AS INTEGER), 'dimensions:' || k, 'string',
           'dimension key ' || k, NULL
    FROM (SELECT unnest(json_keys(dimensions)) AS k FROM ({O.repository(_mods_sql('week'))}) m) u"""


register("table_profile_repository", _profile_repository, _profile_repository_sql())


def _yoy(spark, base):
    from metricbook.operators.insights import yoy_pivot
    return yoy_pivot(_report("week", spark, base, only=_needed("week", periods=4, prior=True)),
                     TD.cfg("week", backfill=False))


def _yoy_sql():
    lc = O.last_complete("week", TD.ANCHOR)
    weeks = [O.shift(lc, "week", -k) for k in range(4)]
    case = " ".join(f"WHEN cycle_timestamp = {O.ts_lit(w)} THEN {i}" for i, w in enumerate(weeks))
    cols = ", ".join(f"max(CASE WHEN k = {i} THEN current_value END) AS value_w{i}, "
                     f"max(CASE WHEN k = {i} THEN yoy END) AS yoy_w{i}" for i in range(4))
    yoy = O.r6("CAST(current_value AS DOUBLE) / CAST(prior_value AS DOUBLE) - 1.0")
    return (f"SELECT indicator, dimensions, metric, coordinates, {cols} FROM ("
            f"SELECT *, CASE {case} END AS k, {yoy} AS yoy FROM ({_report_sql('week')}) r "
            f"WHERE cycle = 'week' AND cycle_timestamp IN ({', '.join(O.ts_lit(w) for w in weeks)})) x "
            f"GROUP BY indicator, dimensions, metric, coordinates")


register("yoy_pivot", _yoy, _yoy_sql())


def _region(spark, base):
    from metricbook.operators.insights import region_rollup
    from metricbook.operators.pyramid import Measure, kpi_module
    from metricbook.sources.tables import read_table
    nation = read_table(spark, base, "nation", ["n_nationkey", "n_name", "n_regionkey"])
    region = read_table(spark, base, "region", ["r_regionkey", "r_name"])
    cust = read_table(spark, base, "customer", ["c_custkey", "c_nationkey"]).join(
        nation, F.col("c_nationkey") == F.col("n_nationkey"), "left")
    orders = read_table(spark, base, "orders", ["o_custkey", "o_totalprice", "o_orderdate"])
    facts = orders.join(cust, F.col("o_custkey") == F.col("c_custkey"), "left")
    mod = kpi_module(facts, "o_orderdate", "month", {"country": "n_name"},
                     [Measure("ORDERS", "count"), Measure("REVENUE", "sum", "o_totalprice")])
    mapping = nation.join(region, F.col("n_regionkey") == F.col("r_regionkey")).select(
        F.col("n_name").alias("country_code"), F.col("r_name").alias("region"))
    return region_rollup(mod, mapping)


from pyspark.sql import functions as F  # noqa: E402

register("region_rollup", _region, f"""
    SELECT m.indicator, m.cycle, m.cycle_timestamp, r.r_name AS region, CAST(SUM(m.value) AS DECIMAL(18,4)) AS value
    FROM ({O.module("orders o LEFT JOIN (SELECT c.c_custkey, n.n_name FROM customer c LEFT JOIN nation n "
                    "ON c.c_nationkey = n.n_nationkey) cn ON o.o_custkey = cn.c_custkey", "o.o_orderdate", "month",
                    {"country": "cn.n_name"}, [("ORDERS", "count", None), ("REVENUE", "sum", "o.o_totalprice")])}) m
    JOIN nation n ON (m.dimensions->>'country') = n.n_name JOIN region r ON n.n_regionkey = r.r_regionkey
    GROUP BY m.indicator, m.cycle, m.cycle_timestamp, r.r_name""")


def _movers(spark, base):
    from metricbook.operators.insights import top_movers
    return top_movers(_report("week", spark, base, only=_needed("week", prior=True)), TD.cfg("week", backfill=False))


def _alerts(spark, base):
    from metricbook.operators.insights import alert_sentences
    return alert_sentences(_timeseries("week", spark, base, backfill=False), TD.cfg("week", backfill=False))


def _alerts_sql():
    def amount(c):
        return f"format('{{:,.2f}}', CAST(round(CAST(CAST({c} AS VARCHAR) AS DECIMAL(38,6)), 2) AS DOUBLE))"
    bands = O.timeseries(_report_sql("week"), "week", TD.SPINE_START, TD.AS_OF, anchor=TD.ANCHOR)
    return f"""
    SELECT indicator, dimensions, cycle_timestamp, alert,
           metric_display_name || CASE alert WHEN '↓' THEN ' fell below ' ELSE ' rose above ' END || 'its usual range: '
             || {amount('current_value')} || ' against ' || {amount('lower_boundary')} || ' to '
             || {amount('upper_boundary')} AS sentence
    FROM ({bands}) b WHERE in_alert"""


register("alert_sentences", _alerts, _alerts_sql())


def _movers_sql():
    lc = O.ts_lit(O.last_complete("week", TD.ANCHOR))
    d = "(CAST(current_value AS DOUBLE) / CAST(prior_value AS DOUBLE) - 1.0)"
    pct = f"CAST(CAST(round(CAST(CAST(abs({d}) * 100 AS VARCHAR) AS DECIMAL(38,12)), 1) AS DOUBLE) AS VARCHAR)"
    return f"""
    SELECT indicator, dimensions, cycle_timestamp, rank, current_value, prior_value, {O.r6('delta')} AS delta,
           metric_display_name || ' ' || CASE WHEN delta >= 0 THEN 'up' ELSE 'down' END || ' ' || pct
             || '% vs the same period last year' AS sentence
    FROM (SELECT *, {d} AS delta, {pct} AS pct,
                 ROW_NUMBER() OVER (PARTITION BY indicator ORDER BY abs({d}) DESC, dimensions ASC) AS rank
          FROM ({_report_sql('week')}) r
          WHERE cycle = 'week' AND cycle_timestamp = {lc} AND prior_value IS NOT NULL AND prior_value <> 0) x
    WHERE rank <= 5"""


register("top_movers", _movers, _movers_sql())


def _split(target, spark, base):
    from metricbook.operators.plan_split import split_monthly_plan
    return split_monthly_plan(TD.aop_from(TD.repository(spark, base, "month")), target)


def _split_sql(target):
    aop = (f"SELECT cycle_timestamp, CAST(value * 1.05 AS DECIMAL(18,8)) AS plan, indicator, dimensions, cycle "
           f"FROM ({O.repository(_mods_sql('month'))}) r WHERE indicator = 'REVENUE'")
    return f"""
    WITH a AS (SELECT indicator, dimensions, plan, CAST(cycle_timestamp AS DATE) AS m,
                      CAST(CAST(plan AS DECIMAL(38,8)) * 100000000 AS HUGEINT) AS p8, day(last_day(CAST(cycle_timestamp AS DATE))) AS n
               FROM ({aop}) x WHERE cycle = 'month'),
         d AS (SELECT a.*, CAST(g.d AS DATE) AS day FROM a, generate_series(a.m, CAST(last_day(a.m) AS DATE),
                                                                              INTERVAL 1 DAY) g(d)),
         s AS (SELECT *, (p8 * 2 + n) // (2 * n) AS s8 FROM d),
         dp AS (SELECT indicator, dimensions, {O.period_start('day', target)} AS cycle_timestamp,
                       CAST(CASE WHEN day = last_day(m) THEN p8 - s8 * (n - 1) ELSE s8 END AS DECIMAL(38,0))
                         / 100000000 AS plan FROM s)
    SELECT cycle_timestamp, CAST(SUM(plan) AS DECIMAL(18,8)) AS plan, indicator, dimensions, '{target}' AS cycle
    FROM dp GROUP BY indicator, dimensions, cycle_timestamp"""


for _t in ("day", "week", "bi-week"):
    register(f"aop_split_{_t.replace('-', '')}", partial(_split, _t), _split_sql(_t))


# Fixed holiday rules for the test query (month, day, name).
US_FIXED_HOLIDAYS = [(1, 1, "New Year's Day"), (7, 4, "Independence Day"), (12, 25, "Christmas Day")]


def _holiday(spark, base):
    from metricbook.operators.insights import fixed_date_holidays, holiday_flag
    hol = fixed_date_holidays(spark, "US", US_FIXED_HOLIDAYS, TD.SPINE_START.year, TD.AS_OF.year)
    return holiday_flag(TD.orders_module(spark, base, "day"), hol, default_country="US")


def _movable_rules():
    from metricbook.operators.insights import HolidayRule
    return [HolidayRule("US", "Good Friday", offset=-2), HolidayRule("US", "Easter Monday", offset=1),
            HolidayRule("US", "Super Bowl Sunday", 2, nth=1, weekday="Sun"), HolidayRule("US", "Memorial Day", 5, nth=-1, weekday="Mon"),
            HolidayRule("US", "Thanksgiving", 11, nth=4, weekday="Thu"), HolidayRule("US", "Black Friday", 11, nth=4, weekday="Thu", offset=1),
            HolidayRule("US", "Oktoberfest (End Date)", 10, nth=1, weekday="Sun", not_before=(10, 3)),
            HolidayRule("US", "New Year's Day", 1, 1)]


def _holiday_movable(spark, base):
    from metricbook.operators.insights import holiday_flag, holidays_by_rule
    days = holidays_by_rule(spark, _movable_rules(), TD.SPINE_START.year, TD.AS_OF.year)
    return holiday_flag(TD.orders_module(spark, base, "day"), days, default_country="US")


def _holiday_movable_sql():
    """Easter by Gauss's rule with its constants for 1900 to 2099, weekdays by numbering the days of a month."""
    return f"""
    WITH y AS (SELECT unnest(range({TD.SPINE_START.year}, {TD.AS_OF.year + 1})) AS y),
    g AS (SELECT y, (19 * (y % 19) + 24) % 30 AS d, (2 * (y % 4) + 4 * (y % 7) + 6 * ((19 * (y % 19) + 24) % 30) + 5) % 7 AS e FROM y),
    easter AS (SELECT make_date(y, 3, 22) + CAST(d + e - CASE WHEN d = 29 AND e = 6 OR d = 28 AND e = 6 AND y % 19 > 10
                                                              THEN 7 ELSE 0 END AS INTEGER) AS s FROM g),
    days AS (SELECT CAST(unnest(range(make_date(min(y), 1, 1), make_date(max(y) + 1, 1, 1), INTERVAL 1 DAY)) AS DATE) AS d FROM y),
    n AS (SELECT d, month(d) AS m, isodow(d) AS w, row_number() OVER p AS nth, count(*) OVER (PARTITION BY year(d), month(d), isodow(d)) AS times
          FROM days WINDOW p AS (PARTITION BY year(d), month(d), isodow(d) ORDER BY d)),
    hol AS (SELECT s - 2 AS date, 'Good Friday' AS holiday FROM easter UNION ALL SELECT s + 1, 'Easter Monday' FROM easter
            UNION ALL SELECT d, 'Super Bowl Sunday' FROM n WHERE m = 2 AND w = 7 AND nth = 1
            UNION ALL SELECT d, 'Memorial Day' FROM n WHERE m = 5 AND w = 1 AND nth = times
            UNION ALL SELECT d, 'Thanksgiving' FROM n WHERE m = 11 AND w = 4 AND nth = 4
            UNION ALL SELECT d + 1, 'Black Friday' FROM n WHERE m = 11 AND w = 4 AND nth = 4
            UNION ALL SELECT greatest(d, make_date(year(d), 10, 3)), 'Oktoberfest (End Date)' FROM n WHERE m = 10 AND w = 7 AND nth = 1
            UNION ALL SELECT make_date(y, 1, 1), 'New Year''s Day' FROM y),
    hh AS (SELECT date, array_to_string(list_sort(list(DISTINCT holiday)), ', ') AS holiday FROM hol GROUP BY date)
    SELECT m.*, hh.holiday IS NOT NULL AS is_holiday, hh.holiday
    FROM ({O.orders_module('day')}) m LEFT JOIN hh ON CAST(m.cycle_timestamp AS DATE) = hh.date"""


register("holiday_flag_movable", _holiday_movable, _holiday_movable_sql())


def _holiday_sql():
    rules = ", ".join(f"({m}, {d}, {O.q(n)})" for m, d, n in US_FIXED_HOLIDAYS)
    return f"""
    WITH h AS (SELECT 'US' AS country, make_date(CAST(y AS INTEGER), m, d) AS date, holiday
               FROM range({TD.SPINE_START.year}, {TD.AS_OF.year + 1}) t(y), (VALUES {rules}) r(m, d, holiday)),
         hh AS (SELECT country, date, array_to_string(list_sort(list(DISTINCT holiday)), ', ') AS holiday
                FROM h GROUP BY country, date),
         m AS ({O.orders_module('day')})
    SELECT m.*, hh.holiday IS NOT NULL AS is_holiday, hh.holiday
    FROM m LEFT JOIN hh ON coalesce(m.dimensions->>'country', 'US') = hh.country
                       AND CAST(m.cycle_timestamp AS DATE) = hh.date"""


register("holiday_flag", _holiday, _holiday_sql())


def _decompose(spark, base):
    from metricbook.operators.decompose import decompose
    return decompose(_report("month", spark, base), TD.cfg("month"))


def _decompose_sql():
    return f"""
    WITH {O.numbered(_report_sql('month'), 'month', TD.SPINE_START, TD.AS_OF)},
    t AS (SELECT r.*, month(r.cycle_timestamp) AS slot, b.s1, b.ends, b.points, naive.current_value AS seasonal_naive
          FROM r
          JOIN (SELECT c.indicator, c.dimensions, c.n, count(p.current_value) AS points,
                       sum(CAST(p.current_value * 10000 AS HUGEINT)) AS s1,
                       sum(CASE WHEN abs(p.n - c.n) = 6 THEN CAST(p.current_value * 10000 AS HUGEINT) END) AS ends
                FROM r c JOIN r p ON p.indicator = c.indicator AND p.dimensions = c.dimensions
                                 AND p.n BETWEEN c.n - 6 AND c.n + 6
                GROUP BY c.indicator, c.dimensions, c.n) b USING (indicator, dimensions, n)
          LEFT JOIN r naive ON naive.indicator = r.indicator AND naive.dimensions = r.dimensions AND naive.n = r.n - 12),
    t2 AS (SELECT *, CASE WHEN points = 13 THEN sign(2 * s1 - ends) * ((abs(2 * s1 - ends) * 200 + 24) // 48) END AS trend6
           FROM t),
    t3 AS (SELECT *, CAST(current_value * 1000000 AS HUGEINT) - trend6 AS det6 FROM t2),
    slots AS (SELECT indicator, dimensions, slot, sum(det6) AS ds, count(det6) AS dn FROM t3 GROUP BY ALL),
    means AS (SELECT *, CASE WHEN dn > 0 THEN sign(ds) * ((abs(ds) * 2 + dn) // (2 * dn)) END AS m6 FROM slots),
    centres AS (SELECT indicator, dimensions, sum(m6) AS cs, count(m6) AS cn FROM means GROUP BY ALL),
    seasons AS (SELECT indicator, dimensions, slot,
                       m6 - sign(cs) * ((abs(cs) * 2 + cn) // (2 * cn)) AS season6
                FROM means JOIN centres USING (indicator, dimensions) WHERE cn > 0)
    SELECT indicator, dimensions, cycle, cycle_timestamp, current_value, CAST(trend6 AS DOUBLE) / 1000000 AS trend,
           CAST(season6 AS DOUBLE) / 1000000 AS seasonal, seasonal_naive
    FROM t3 LEFT JOIN seasons USING (indicator, dimensions, slot)"""


register("decompose_month", _decompose, _decompose_sql())


PCA_INDICATORS = ["ORDERS", "REVENUE", "UNITS", "NET_REVENUE"]


def _pca(spark, base):
    from metricbook.operators.pca import kpi_pca
    return kpi_pca(_report("week", spark, base), PCA_INDICATORS, "week")


register("kpi_pca_week", _pca)  # eigenvectors are not SQL: rows-only check, see kpi_pca_spectrum


def _pca_spectrum(spark, base):
    """Sign-free figures of all components: sums of the first three powers of their variances."""
    from metricbook.operators.pca import kpi_pca
    d = len(PCA_INDICATORS)
    v = (kpi_pca(_report("week", spark, base), PCA_INDICATORS, "week", k=d)
         .agg(F.count("*").alias("periods"), *[F.var_samp(f"pc{i + 1}").alias(f"v{i}") for i in range(d)]))
    return v.select("periods", *[F.round(sum((F.col(f"v{i}") ** e for i in range(d)), F.lit(0.0)), 3).alias(f"power_{e}")
                                 for e in (1, 2, 3)])


def _pca_spectrum_sql():
    d = len(PCA_INDICATORS)
    corr = {(i, j): f"corr(x{i}, x{j})" if i != j else "1.0" for i in range(d) for j in range(d)}
    cols = ", ".join(f"max(CASE WHEN indicator = '{c}' THEN CAST(current_value AS DOUBLE) END) AS x{i}"
                     for i, c in enumerate(PCA_INDICATORS))
    square = " + ".join(f"{corr[i, j]} * {corr[j, i]}" for i in range(d) for j in range(d))
    cube = " + ".join(f"{corr[i, j]} * {corr[j, k]} * {corr[k, i]}" for i in range(d) for j in range(d) for k in range(d))
    return f"""
    WITH m AS (SELECT cycle_timestamp, {cols} FROM ({_report_sql('week')}) r WHERE cycle = 'week' AND dimensions = '{{}}'
               GROUP BY cycle_timestamp)
    SELECT count(*) AS periods, CAST({d} AS DOUBLE) AS power_1, round({square}, 3) AS power_2, round({cube}, 3) AS power_3
    FROM m WHERE {' AND '.join(f'x{i} IS NOT NULL' for i in range(d))}"""


register("kpi_pca_spectrum", _pca_spectrum, _pca_spectrum_sql())


def _pca_coordinates(spark, base):
    """Orders against revenue at every coordinate: the first component's variance is 1 + |r|."""
    from metricbook.operators.pca import kpi_pca_by_coordinate
    scores = kpi_pca_by_coordinate(_report("week", spark, base), ["ORDERS", "REVENUE"], "week")
    return scores.groupBy("dimensions").agg(
        F.count("*").alias("periods"), F.round(F.max("variance_1"), 6).alias("variance_1"), F.round(F.max("variance_2"), 6).alias("variance_2"),
        F.round(F.var_samp("pc1"), 3).alias("spread_1"), F.round(F.var_samp("pc2"), 3).alias("spread_2"))


register("kpi_pca_coordinates", _pca_coordinates, f"""
    WITH m AS (SELECT dimensions, cycle_timestamp, max(CASE WHEN indicator = 'ORDERS' THEN CAST(current_value AS DOUBLE) END) AS x,
                      max(CASE WHEN indicator = 'REVENUE' THEN CAST(current_value AS DOUBLE) END) AS y
               FROM ({_report_sql('week')}) r WHERE cycle = 'week' GROUP BY dimensions, cycle_timestamp),
    c AS (SELECT dimensions, count(*) AS periods, abs(corr(x, y)) AS r FROM m WHERE x IS NOT NULL AND y IS NOT NULL
          GROUP BY dimensions HAVING stddev_samp(x) > 0 AND stddev_samp(y) > 0)
    SELECT dimensions, periods, round(1 + r, 6) AS variance_1, round(1 - r, 6) AS variance_2, round(1 + r, 3) AS spread_1,
           round(1 - r, 3) AS spread_2 FROM c""")


# ---------------------------------------------------------------- stage 8: repeated coordinates, options, suites
def _restated(spark, base):
    """Two modules that repeat the all-up coordinates with other values and ids."""
    from metricbook.operators.repository import build_repository
    m = TD.orders_module(spark, base, "week")
    again = (m.where("dimensions = '{}'").withColumn("value", (F.col("value") + 7).cast("decimal(18,4)"))
             .withColumn("id", F.md5("id")))
    return build_repository(spark, {"orders_module": m, "orders_restated": again})


def _restated_sql():
    return O.repository({"orders_module": O.orders_module("week"), "orders_restated":
                         f"SELECT indicator, dimensions, cycle, cycle_timestamp, CAST(value + 7 AS DECIMAL(18,4)) AS value, "
                         f"md5(id) AS id FROM ({O.orders_module('week')}) o WHERE dimensions = '{{}}'"})


def _restated_report(spark, base):
    from metricbook.operators.report import performance_report
    return performance_report(_restated(spark, base), TD.glossary(spark), None, TD.cfg("week"))


def _restated_bands(spark, base):
    from metricbook.operators.timeseries import timeseries_analysis
    return timeseries_analysis(_restated_report(spark, base), TD.cfg("week"))


register("report_duplicate_coordinates", _restated_report, O.report(_restated_sql(), "week"))
register("timeseries_duplicate_coordinates", _restated_bands,
         O.timeseries(O.report(_restated_sql(), "week"), "week", TD.SPINE_START, TD.AS_OF))


def _events_two_dims(spark, base):
    from metricbook.operators.pyramid import Measure, kpi_module
    from metricbook.sources.tables import read_table
    ev = read_table(spark, base, "events", ["ts", "user_id", "event_type", "value", "props"])
    return kpi_module(ev, "ts", "week", {"event_type": "event_type", "k": F.get_json_object("props", "$.k")},
                      [Measure("EVENTS", "count"), Measure("MAX_VALUE", "max", "value"),
                       Measure("ACTIVE_USERS", "count_distinct", "user_id")])


register("module_events_two_dims", _events_two_dims, O.module(
    "events", "ts", "week", {"event_type": "event_type", "k": "props->>'k'"},
    [("EVENTS", "count", None), ("MAX_VALUE", "max", "value"), ("ACTIVE_USERS", "count_distinct", "user_id")]))


# After a 53-week year the plain bi-weekly run is empty; the strict one is not.
STRICT_ANCHOR = dt.date(1999, 1, 10)


def _strict(spark, base):
    from metricbook.config import RunConfig
    return TD.orders_module(spark, base, "bi-week", RunConfig("bi-week", STRICT_ANCHOR, strict_biweek=True))


register("module_last_complete_biweek_strict", _strict,
         f"SELECT * FROM ({O.orders_module('bi-week')}) m WHERE cycle_timestamp = TIMESTAMP '1998-12-28 00:00:00'")


def _contract(spark, base):
    from metricbook.operators.repository import validate_module
    m = TD.orders_module(spark, base, "month")
    loose = m.select(F.col("id").alias("ID"), F.col("value").cast("double").alias("Value"), "cycle_timestamp",
                     F.from_json("dimensions", "map<string,string>").alias("DIMENSIONS"), F.lit(1).alias("extra"),
                     "cycle", "indicator")
    return validate_module("orders_module", loose)


register("module_contract", _contract,
         f"SELECT 'orders_module' AS _source_relation, * FROM ({O.orders_module('month')}) m")

register("check_freshness_coordinates", _check(lambda C, s, b: C.freshness(
            TD.orders_module(s, b, "week"), "week", TD.ANCHOR, by="coordinates")),
         f"""SELECT DISTINCT indicator, dimensions FROM ({O.orders_module('week')}) m
             EXCEPT SELECT indicator, dimensions FROM ({O.orders_module('week')}) m
             WHERE cycle_timestamp = {O.ts_lit(O.last_complete('week', TD.ANCHOR))}""")


def _suite_modules(spark, base):
    from metricbook.operators.repository import build_repository
    return build_repository(spark, {"orders_module": TD.orders_module(spark, base, "week"),
                                    "geo_module": TD.orders_geo_module(spark, base, "week")})


def _suite(spark, base):
    from metricbook.operators.checks import repository_suite
    from metricbook.sources.tables import read_table
    countries = read_table(spark, base, "nation", ["n_name"]).withColumnRenamed("n_name", "alpha_2")
    return repository_suite(_suite_modules(spark, base), TD.glossary(spark).where("indicator <> 'ORDERS'"), countries, TD.ANCHOR)


def _suite_sql():
    repo = O.repository({"orders_module": O.orders_module("week"), "geo_module": O.orders_geo_module("week")})

    def stale(period):
        at = O.ts_lit(O.last_complete(period, TD.ANCHOR))
        return (f"SELECT count(*) FROM (SELECT DISTINCT indicator, list_sort(json_keys(dimensions)) AS ks FROM r EXCEPT "
                f"SELECT indicator, list_sort(json_keys(dimensions)) FROM r WHERE cycle = '{period}' AND cycle_timestamp = {at})")

    def outside(key, values):
        return f"SELECT count(*) FROM r WHERE dimensions->>'{key}' NOT IN ({', '.join(map(O.q, values))})"

    def repeated(columns):
        return f"SELECT count(*) FROM (SELECT 1 FROM r GROUP BY {columns} HAVING count(*) > 1)"

    counts = [
        ("indicator_in_glossary", "error", f"SELECT count(*) FROM r WHERE indicator NOT IN (SELECT indicator FROM {O.glossary_values()} g "
                                           f"WHERE indicator <> 'ORDERS')"),
        ("dimension_geo_accepted", "error", outside("geo", ["US", "ROW"])),
        ("dimension_platform_accepted", "error", outside("platform", ["iOS", "Android", "Web", "Other"])),
        ("dimension_user_class_accepted", "error", outside("user_class", ["Premium", "Non-Premium", "PremiumPlus"])),
        ("dimension_country_accepted", "error", "SELECT count(*) FROM r WHERE dimensions->>'country' <> 'XX' AND "
                                                "dimensions->>'country' NOT IN (SELECT n_name FROM nation)"),
        ("cycle_timestamp_not_null", "error", "SELECT count(*) FROM r WHERE cycle_timestamp IS NULL"),
        ("cycle_accepted", "error", "SELECT count(*) FROM r WHERE cycle NOT IN ('day', 'week', 'bi-week', 'month', 'quarter', 'year')"),
        ("id_not_null", "error", "SELECT count(*) FROM r WHERE id IS NULL"),
        ("id_unique", "error", repeated("id")), ("id_combination_unique", "error", repeated("id")),
        ("coordinates_unique", "error", repeated("indicator, dimensions, cycle, cycle_timestamp")),
        ("fresh_week", "warn", stale("week")), ("fresh_month", "error", stale("month"))]
    rows = " UNION ALL ".join(f'SELECT \'{n}\' AS "check", \'{s}\' AS severity, ({q}) AS failures' for n, s, q in counts)
    return (f"WITH r AS ({repo}), c AS ({rows}) SELECT *, CASE WHEN failures = 0 THEN 'pass' WHEN severity = 'warn' "
            f"THEN 'warn' ELSE 'fail' END AS status FROM c")


register("check_suite", _suite, _suite_sql())


def _merge(spark, base):
    """Keyed merge of a restated last week into the weekly module; its keys are unique, else it would raise."""
    from metricbook.sources.sink import merge_frames
    target = TD.orders_module(spark, base, "week")
    batch = TD.orders_module(spark, base, "week", TD.cfg("week", backfill=False)) \
        .withColumn("value", (F.col("value") * 2).cast("decimal(18,4)"))
    return merge_frames(target, batch, ["id"], "merge")


register("upsert_merge", _merge, f"""
    SELECT indicator, dimensions, cycle, cycle_timestamp,
           CAST(value * CASE WHEN cycle_timestamp = {O.ts_lit(O.last_complete('week', TD.ANCHOR))} THEN 2 ELSE 1 END
                AS DECIMAL(18,4)) AS value, id
    FROM ({O.orders_module('week')}) m""")


def _owned(spark, base):
    """Owners of what the last complete week reports: the data decide which indicators and values come out."""
    from metricbook.operators.owners import kpi_owners, owner_rules
    last = _report("week", spark, base, backfill=False).groupBy("indicator").agg(
        F.count("*").alias("coordinates"), F.max("current_value").alias("largest_value"))
    return kpi_owners(TD.glossary(spark), owner_rules(spark)).join(last, "indicator")


register("owners_of_report", _owned, f"""
    SELECT r.effective_date, g.indicator, r.owner, r.lead_analyst, r.bi_pal, x.coordinates, x.largest_value
    FROM {O.glossary_values()} g JOIN {_RULES_SQL} r ON g.category = r.category
    JOIN (SELECT indicator, count(*) AS coordinates, max(current_value) AS largest_value
          FROM ({O.report(O.repository(_mods_sql('week')), 'week', anchor=TD.ANCHOR)}) p GROUP BY indicator) x
      ON x.indicator = g.indicator
    WHERE g.is_kpi""")


def _cohort(spark, base):
    """Generations of customers; the tables carry no birth year, so one is derived from the key."""
    from metricbook.operators.insights import generation_cohort, generation_years
    from metricbook.sources.tables import read_table
    c = read_table(spark, base, "customer", ["c_custkey"]).withColumn(
        "birth_year", (F.lit(1918) + F.col("c_custkey") % 125).cast("int"))
    return generation_cohort(c.withColumnRenamed("birth_year", "born"), "born", generation_years(spark))


def _cohort_sql():
    from metricbook.operators.insights import GENERATIONS
    rows = ", ".join(f"({O.q(g)}, {a}, {b})" for g, a, b in GENERATIONS)
    return f"""SELECT c_custkey, CAST(1918 + c_custkey % 125 AS INTEGER) AS born, g.generation
               FROM customer LEFT JOIN (VALUES {rows}) g(generation, a, b) ON 1918 + c_custkey % 125 BETWEEN a AND b"""


register("generation_cohort", _cohort, _cohort_sql())


COUNTRY_HOLIDAYS = {"UNITED STATES": US_FIXED_HOLIDAYS, "FRANCE": [(1, 1, "Jour de l'an"), (7, 14, "Fête nationale")]}


def _holiday_country(spark, base):
    from metricbook.operators.insights import fixed_date_holidays, holiday_flag
    from metricbook.operators.pyramid import Measure, kpi_module
    from metricbook.sources.tables import read_table
    nation = read_table(spark, base, "nation", ["n_nationkey", "n_name"])
    cust = read_table(spark, base, "customer", ["c_custkey", "c_nationkey"]).join(
        nation, F.col("c_nationkey") == F.col("n_nationkey"), "left")
    orders = read_table(spark, base, "orders", ["o_custkey", "o_orderdate"])
    module = kpi_module(orders.join(cust, F.col("o_custkey") == F.col("c_custkey"), "left"), "o_orderdate", "day",
                        {"country": "n_name"}, [Measure("ORDERS", "count")])
    days = None
    for country, rules in COUNTRY_HOLIDAYS.items():
        h = fixed_date_holidays(spark, country, rules, TD.SPINE_START.year, TD.AS_OF.year)
        days = h if days is None else days.unionByName(h)
    return holiday_flag(module, days)


def _holiday_country_sql():
    rules = ", ".join(f"({O.q(c)}, {m}, {d}, {O.q(n)})" for c, r in COUNTRY_HOLIDAYS.items() for m, d, n in r)
    module = O.module("orders o LEFT JOIN (SELECT c_custkey, n_name FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey) cn "
                      "ON o.o_custkey = cn.c_custkey", "o.o_orderdate", "day", {"country": "cn.n_name"}, [("ORDERS", "count", None)])
    return f"""
    SELECT m.*, h.holiday IS NOT NULL AS is_holiday, h.holiday
    FROM ({module}) m LEFT JOIN (VALUES {rules}) h(country, mon, mday, holiday)
      ON m.dimensions->>'country' = h.country AND month(m.cycle_timestamp) = mon AND day(m.cycle_timestamp) = mday"""


register("holiday_flag_country", _holiday_country, _holiday_country_sql())


# ---------------------------------------------------------------- entity KPIs, calendar lattice
from metricbook.plans import entity_catalog  # noqa: E402

for _name, _fn in entity_catalog.QUERIES.items():
    register(_name, _fn, entity_catalog.ORACLE.get(_name))
