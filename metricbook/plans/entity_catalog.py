"""Registered queries of entity KPIs and of the calendar lattice, with their DuckDB oracles."""

from __future__ import annotations

from functools import partial

from pyspark.sql import functions as F

from metricbook.functions import cycles
from metricbook.operators import entities as E
from metricbook.operators import lattice as L
from metricbook.operators.pyramid import Measure
from metricbook.operators.repository import build_repository
from metricbook.plans import oracle as O
from metricbook.plans import testdata as TD
from metricbook.sources.tables import read_table

COHORT = "CAST(get_json_object(props, '$.k') AS INT) % 4"


def _events(spark, base):
    return read_table(spark, base, "events", ["ts", "user_id", "event_type", "value", "props"]).withColumn("cohort", F.expr(COHORT))


def _orders(spark, base):
    return TD.orders_facts(spark, base)


def _is(kind: str):
    return F.col("event_type") == kind


def conversion(period, spark, base):
    purchasers = Measure("purchasers", "count_distinct", "user_id", _is("purchase"))
    return E.ratio_module(_events(spark, base), "ts", period, ["cohort"], [
        E.Ratio("PURCHASE_CONVERSION", purchasers, Measure("viewers", "count_distinct", "user_id", _is("view"))),
        E.Ratio("CLICK_THROUGH", Measure("clicks", "count", where=_is("click")), Measure("views", "count", where=_is("view"))),
        E.Ratio("VALUE_PER_PURCHASER", Measure("value", "sum", "value", _is("purchase")), purchasers)])


def order_ratios(period, spark, base):
    orders = Measure("orders", "count")
    return E.ratio_module(_orders(spark, base), "o_orderdate", period, {"segment": "c_mktsegment"}, [
        E.Ratio("FULFILLED_RATE", Measure("fulfilled", "count", where=F.col("o_orderstatus") == "F"), orders),
        E.Ratio("AVERAGE_ORDER_VALUE", Measure("revenue", "sum", "o_totalprice"), orders),
        E.Ratio("OPEN_VALUE_PER_CUSTOMER", Measure("open", "sum", "o_totalprice", F.col("o_orderstatus") == "O"),
                Measure("customers", "count_distinct", "o_custkey", F.col("o_orderstatus") == "O"))])


def end_of_period(period, spark, base):
    orders = read_table(spark, base, "orders", ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate"])
    customer = read_table(spark, base, "customer", ["c_custkey", "c_mktsegment"])
    facts = orders.join(customer, F.col("o_custkey") == F.col("c_custkey"), "left")
    return E.end_of_period(facts, "o_orderdate", period, {"segment": "c_mktsegment", "status": "o_orderstatus"}, "o_custkey",
                           {"EOP_CUSTOMERS": None, "EOP_LAST_ORDER_VALUE": "o_totalprice"}, TD.cfg(period), tie=["o_orderkey"])


def average_daily(period, spark, base):
    return E.average_daily(_events(spark, base), "ts", period, ["event_type"], "user_id", "AVG_DAILY_USERS")


def retention(period, spark, base):
    return E.retention(_orders(spark, base), "o_orderdate", period, {"segment": "c_mktsegment"}, "o_custkey", "CUSTOMER_RETENTION")


STATES = {"new": "NEW_CUSTOMERS", "retained": "RETAINED_CUSTOMERS", "resurrected": "RESURRECTED_CUSTOMERS",
          "churned": "CHURNED_CUSTOMERS", "active": "ACTIVE_CUSTOMERS"}


def lifecycle(period, spark, base):
    return E.lifecycle(_orders(spark, base), "o_orderdate", period, {"segment": "c_mktsegment"}, "o_custkey", STATES)


def streaks(period, spark, base):
    return E.streaks(_events(spark, base), "ts", period, ["event_type"], "user_id", {2: "CONSECUTIVE_USERS_2", 3: "CONSECUTIVE_USERS_3"})


def entity_repository(spark, base):
    """The month's entity KPIs beside the plain module, as consumers consolidate them."""
    return build_repository(spark, {"orders_module": TD.orders_module(spark, base, "month"),
                                    "order_ratios": order_ratios("month", spark, base),
                                    "retention": retention("month", spark, base)})


def all_cycles(spark, base):
    li = read_table(spark, base, "lineitem", ["l_quantity", "l_extendedprice", "l_discount", "l_returnflag", "l_linestatus", "l_shipdate"])
    net = (F.col("l_extendedprice").cast("decimal(18,4)") * (F.lit(1) - F.col("l_discount").cast("decimal(18,4)"))).cast("decimal(18,4)")
    return build_repository(spark, {
        "orders_module": L.all_cycles_module(_orders(spark, base), "o_orderdate", {"segment": "c_mktsegment", "status": "o_orderstatus"},
                                             [Measure("ORDERS", "count"), Measure("REVENUE", "sum", "o_totalprice")]),
        "lineitem_module": L.all_cycles_module(li, "l_shipdate", {"returnflag": "l_returnflag", "linestatus": "l_linestatus"},
                                               [Measure("UNITS", "sum", "l_quantity"), Measure("NET_REVENUE", "sum", net)])})


def events_all_cycles(spark, base):
    """Exact distinct users go up the lattice as values."""
    return L.all_cycles_module(read_table(spark, base, "events", ["ts", "user_id", "event_type", "value"]), "ts", ["event_type"],
                               [Measure("EVENTS", "count"), Measure("EVENT_VALUE", "sum", "value"),
                                Measure("ACTIVE_USERS", "count_distinct", "user_id")])


def sketched_users(spark, base):
    """Merged sketches beside the exact counts: whether each lies within three standard errors."""
    ev = read_table(spark, base, "orders", ["o_orderdate", "o_custkey", "o_orderstatus"])
    coordinates = ["indicator", "dimensions", "cycle", "cycle_timestamp"]
    exact = L.all_cycles_module(ev, "o_orderdate", {"status": "o_orderstatus"}, [Measure("BUYERS", "count_distinct", "o_custkey")])
    days = L.sketch_days(ev, "o_orderdate", {"status": "o_orderstatus"}, "o_custkey")
    merged = L.sketch_module(days, ["status"], "BUYERS").select(*coordinates, F.col("value").alias("estimate"))
    bound = 3 * 1.04 / 2 ** (L.LG_K / 2)
    return exact.join(merged, coordinates, "left").select(
        *coordinates, "value", (F.abs(F.col("estimate") - F.col("value")) <= F.greatest(F.lit(1), F.col("value") * bound)).alias("within_bound"))


# ---------------------------------------------------------------- oracles
def _cube(names):
    out = [[]]
    for n in names:
        out += [s + [n] for s in out]
    return out


def _sets(names):
    return ", ".join("(" + ", ".join(["cycle_timestamp"] + s) + ")" for s in _cube(names))


def _long(ctes: str, wide: str, names: list[str], period: str, indicators: list[str]) -> str:
    """Module rows of the CTE ``wide`` (cycle_timestamp, names, one column per indicator)."""
    parts = " UNION ALL ".join(f"SELECT '{i}' AS indicator, {O.dims_json(names)} AS dimensions, '{period}' AS cycle, cycle_timestamp, "
                               f"CAST(\"{i}\" AS DECIMAL(18,4)) AS value FROM {wide}" for i in indicators)
    return (f"WITH {ctes} SELECT indicator, dimensions, cycle, cycle_timestamp, value, "
            f"{O.skey('indicator', 'dimensions', 'cycle', 'cycle_timestamp')} AS id FROM ({parts}) x")


def _quotient(n: str, d: str) -> str:
    n, d = (f"CAST(CAST({x} AS DECIMAL(18,4)) * 10000 AS HUGEINT)" for x in (n, d))
    return f"CASE WHEN {d} <> 0 THEN CAST(({n} * 20000 + {d}) // (2 * {d}) AS DECIMAL(18,0)) * CAST(0.0001 AS DECIMAL(5,4)) END"


def _ratio_sql(frm, ts, period, dims, ratios):
    names = list(dims)
    base = ", ".join(f"coalesce(CAST({e} AS VARCHAR), 'unknown') AS {k}" for k, e in dims.items())
    values = ", ".join(f"{_quotient(n, d)} AS \"{i}\"" for i, n, d in ratios)
    return _long(f"f AS (SELECT {O.period_start(ts, period)} AS cycle_timestamp, {base}, * FROM {frm}), "
                 f"w AS (SELECT cycle_timestamp, {', '.join(names)}, {values} FROM f GROUP BY GROUPING SETS ({_sets(names)}))",
                 "w", names, period, [i for i, _, _ in ratios])


def _conversion_sql(period):
    buyers = "count(DISTINCT user_id) FILTER (event_type = 'purchase')"
    views = "count(*) FILTER (event_type = 'view')"
    return _ratio_sql("events", "ts", period, {"cohort": "CAST(props->>'k' AS INTEGER) % 4"}, [
        ("PURCHASE_CONVERSION", buyers, "count(DISTINCT user_id) FILTER (event_type = 'view')"),
        ("CLICK_THROUGH", "count(*) FILTER (event_type = 'click')", views),
        ("VALUE_PER_PURCHASER", "coalesce(sum(CAST(value AS DECIMAL(18,4))) FILTER (event_type = 'purchase'), 0)", buyers)])


_ORDERS = "orders o LEFT JOIN customer c ON o.o_custkey = c.c_custkey"


def _order_ratios_sql(period):
    price = "sum(CAST(o_totalprice AS DECIMAL(18,4)))"
    return _ratio_sql(_ORDERS, "o_orderdate", period, {"segment": "c.c_mktsegment"}, [
        ("FULFILLED_RATE", "count(*) FILTER (o_orderstatus = 'F')", "count(*)"), ("AVERAGE_ORDER_VALUE", price, "count(*)"),
        ("OPEN_VALUE_PER_CUSTOMER", f"coalesce({price} FILTER (o_orderstatus = 'O'), 0)",
         "count(DISTINCT o_custkey) FILTER (o_orderstatus = 'O')")])


def _eop_sql(period):
    """Every entity's last state at the end of every period, by brute force."""
    span = {"month": "INTERVAL 1 MONTH", "week": "INTERVAL 7 DAY"}[period]
    return _long(f"""
    spine AS (SELECT DISTINCT {O.period_start('d', period)} AS cycle_timestamp
              FROM (SELECT unnest(range(DATE '{TD.SPINE_START}', DATE '{TD.AS_OF}' + 1, INTERVAL 1 DAY)) AS d)),
    s AS (SELECT cycle_timestamp, coalesce(c_mktsegment, 'unknown') AS segment, o_orderstatus AS status,
                 CAST(o_totalprice AS DECIMAL(18,4)) AS v FROM spine JOIN ({_ORDERS}) ON o_orderdate < cycle_timestamp + {span}
          QUALIFY row_number() OVER (PARTITION BY cycle_timestamp, o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) = 1),
    g AS (SELECT cycle_timestamp, segment, status, count(*) AS n, sum(v) AS v FROM s
          GROUP BY GROUPING SETS ({_sets(['segment', 'status'])})),
    every AS (SELECT segment, status, min(cycle_timestamp) AS first FROM g GROUP BY segment, status),
    w AS (SELECT spine.cycle_timestamp, e.segment, e.status, coalesce(g.n, 0) AS "EOP_CUSTOMERS", coalesce(g.v, 0) AS "EOP_LAST_ORDER_VALUE"
          FROM every e JOIN spine ON spine.cycle_timestamp >= e.first LEFT JOIN g ON g.cycle_timestamp = spine.cycle_timestamp
               AND g.segment IS NOT DISTINCT FROM e.segment AND g.status IS NOT DISTINCT FROM e.status)""",
                 "w", ["segment", "status"], period, ["EOP_CUSTOMERS", "EOP_LAST_ORDER_VALUE"])


def _average_daily_sql(period):
    days = {"week": "7", "month": "day(last_day(cycle_timestamp))"}[period]
    return _long(f"""
    d AS (SELECT CAST(ts AS DATE) AS day, event_type, count(DISTINCT user_id) AS n FROM events
          GROUP BY GROUPING SETS ((day), (day, event_type))),
    p AS (SELECT {O.period_start('day', period)} AS cycle_timestamp, event_type, sum(n) AS n FROM d GROUP BY ALL),
    w AS (SELECT cycle_timestamp, event_type, {_quotient('n', days)} AS "AVG_DAILY_USERS" FROM p)""",
                 "w", ["event_type"], period, ["AVG_DAILY_USERS"])


def _active_sql(period, frm, ts, dim, expr, entity):
    """CTE ``a``: active entities per period and coordinate (the dimension's value, or NULL for all)."""
    start = O.period_start(ts, period)
    return (f"a AS (SELECT DISTINCT {start} AS p, coalesce(CAST({expr} AS VARCHAR), 'unknown') AS {dim}, {entity} AS u FROM {frm} "
            f"UNION ALL SELECT DISTINCT {start}, NULL, {entity} FROM {frm}), seen AS (SELECT DISTINCT p FROM a)")


_STEP = {"month": "INTERVAL 1 MONTH", "week": "INTERVAL 7 DAY"}


def _retention_sql(period):
    return _long(f"""
    {_active_sql(period, _ORDERS, 'o.o_orderdate', 'segment', 'c.c_mktsegment', 'o.o_custkey')},
    w AS (SELECT old.p + {_STEP[period]} AS cycle_timestamp, old.segment,
                 {_quotient('count(now.u)', 'count(*)')} AS "CUSTOMER_RETENTION"
          FROM a old JOIN seen ON seen.p = old.p + {_STEP[period]}
          LEFT JOIN a now ON now.u = old.u AND now.segment IS NOT DISTINCT FROM old.segment AND now.p = old.p + {_STEP[period]}
          GROUP BY old.p, old.segment)""", "w", ["segment"], period, ["CUSTOMER_RETENTION"])


def _lifecycle_sql(period):
    """Each active entity looked up in the period before and in all earlier ones; churn from the period missed."""
    step = _STEP[period]
    return _long(f"""
    {_active_sql(period, _ORDERS, 'o.o_orderdate', 'segment', 'c.c_mktsegment', 'o.o_custkey')},
    first AS (SELECT segment, u, min(p) AS f FROM a GROUP BY segment, u),
    s AS (SELECT a.p, a.segment, a.u, CASE WHEN a.p = f THEN 'new' WHEN b.p IS NOT NULL THEN 'retained' ELSE 'resurrected' END AS state
          FROM a JOIN first ON first.u = a.u AND first.segment IS NOT DISTINCT FROM a.segment
          LEFT JOIN a b ON b.u = a.u AND b.segment IS NOT DISTINCT FROM a.segment AND b.p = a.p - {step}
          UNION ALL
          SELECT seen.p, a.segment, a.u, 'churned' FROM a JOIN seen ON seen.p = a.p + {step}
          LEFT JOIN a b ON b.u = a.u AND b.segment IS NOT DISTINCT FROM a.segment AND b.p = seen.p WHERE b.p IS NULL),
    w AS (SELECT p AS cycle_timestamp, segment, {', '.join(f"count(*) FILTER (state = '{s}') AS " + '"' + i + '"' for s, i in STATES.items() if s != 'active')},
                 count(*) FILTER (state <> 'churned') AS "ACTIVE_CUSTOMERS" FROM s GROUP BY p, segment)""",
                 "w", ["segment"], period, list(STATES.values()))


def _streaks_sql(period):
    step = _STEP[period]
    back = [f"LEFT JOIN a b{k} ON b{k}.u = a.u AND b{k}.event_type IS NOT DISTINCT FROM a.event_type AND b{k}.p = a.p - {k} * {step}"
            for k in (1, 2)]
    return _long(f"""
    {_active_sql(period, 'events', 'ts', 'event_type', 'event_type', 'user_id')},
    w AS (SELECT a.p AS cycle_timestamp, a.event_type, count(b1.u) AS "CONSECUTIVE_USERS_2",
                 count(CASE WHEN b1.u IS NOT NULL THEN b2.u END) AS "CONSECUTIVE_USERS_3"
          FROM a {' '.join(back)} GROUP BY a.p, a.event_type)""",
                 "w", ["event_type"], period, ["CONSECUTIVE_USERS_2", "CONSECUTIVE_USERS_3"])


def _all_cycles_sql():
    return " UNION ALL ".join(f"SELECT * FROM ({O.repository({'orders_module': O.orders_module(p), 'lineitem_module': O.lineitem_module(p)})})"
                              for p in cycles.CYCLES)


def _sketched_sql():
    return " UNION ALL ".join(
        f"SELECT indicator, dimensions, cycle, cycle_timestamp, value, TRUE AS within_bound FROM "
        f"({O.module('orders', 'o_orderdate', p, {'status': 'o_orderstatus'}, [('BUYERS', 'count_distinct', 'o_custkey')])})"
        for p in cycles.CYCLES)


QUERIES = {
    "module_conversion_week": partial(conversion, "week"),
    "module_order_ratios_month": partial(order_ratios, "month"),
    "module_eop_month": partial(end_of_period, "month"),
    "module_eop_week": partial(end_of_period, "week"),
    "module_avg_daily_users_week": partial(average_daily, "week"),
    "module_avg_daily_users_month": partial(average_daily, "month"),
    "module_retention_month": partial(retention, "month"),
    "module_lifecycle_week": partial(lifecycle, "week"),
    "module_lifecycle_month": partial(lifecycle, "month"),
    "module_streaks_week": partial(streaks, "week"),
    "repository_entity_kpis": entity_repository,
    "repository_all_cycles": all_cycles,
    "module_events_all_cycles": events_all_cycles,
    "module_buyers_sketch": sketched_users,
}

ORACLE = {
    "module_conversion_week": _conversion_sql("week"),
    "module_order_ratios_month": _order_ratios_sql("month"),
    "module_eop_month": _eop_sql("month"),
    "module_eop_week": _eop_sql("week"),
    "module_avg_daily_users_week": _average_daily_sql("week"),
    "module_avg_daily_users_month": _average_daily_sql("month"),
    "module_retention_month": _retention_sql("month"),
    "module_lifecycle_week": _lifecycle_sql("week"),
    "module_lifecycle_month": _lifecycle_sql("month"),
    "module_streaks_week": _streaks_sql("week"),
    "repository_entity_kpis": O.repository({"orders_module": O.orders_module("month"), "order_ratios": _order_ratios_sql("month"),
                                            "retention": _retention_sql("month")}),
    "repository_all_cycles": _all_cycles_sql(),
    "module_events_all_cycles": " UNION ALL ".join(f"SELECT * FROM ({O.events_module(p)})" for p in cycles.CYCLES),
    "module_buyers_sketch": _sketched_sql(),
}
