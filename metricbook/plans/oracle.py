"""DuckDB SQL twins of the registered queries (the correctness oracle).

They are written in a shape of their own - correlated lookups for the prior
year and the plan, NOT EXISTS for overrides, self-joins over numbered periods
for the bands - so they check the Spark plans (equi-join keys, anti-joins,
RANGE frames) rather than repeat them.
"""

from __future__ import annotations

import datetime as dt

from metricbook.functions.cycles import LOOKBACK, last_complete, shift, start_of
from metricbook.functions.keys import NULL_SENTINEL
from metricbook.plans import testdata as TD


def q(s: str) -> str:
    return "'" + str(s).replace("'", "''") + "'"


def ts_lit(t: dt.datetime) -> str:
    return f"TIMESTAMP '{t:%Y-%m-%d %H:%M:%S}'"


def period_start(expr: str, period: str) -> str:
    d = f"CAST({expr} AS DATE)"
    if period == "hour":
        return f"date_trunc('hour', CAST({expr} AS TIMESTAMP))"
    if period == "day":
        return f"CAST({d} AS TIMESTAMP)"
    if period == "bi-week":
        w = f"date_trunc('week', {d})"
        return (f"CAST({w} - CASE WHEN weekofyear({w}) % 2 = 0 THEN INTERVAL 7 DAY "
                f"ELSE INTERVAL 0 DAY END AS TIMESTAMP)")
    return f"CAST(date_trunc('{period}', {d}) AS TIMESTAMP)"


def dims_json(keys: list[str]) -> str:
    keys = sorted(keys)
    if not keys:
        return "'{}'"
    parts = ", ".join(f"CASE WHEN {k} IS NOT NULL THEN '\"{k}\":\"' || {k} || '\"' END" for k in keys)
    return f"'{{' || concat_ws(',', {parts}) || '}}'"


def skey(*cols: str, ts_cols=("cycle_timestamp",)) -> str:
    parts = []
    for c in cols:
        e = f"strftime({c}, '%Y-%m-%d %H:%M:%S')" if c in ts_cols else f"CAST({c} AS VARCHAR)"
        parts.append(f"coalesce({e}, {q(NULL_SENTINEL)})")
    return f"md5(concat_ws('-', {', '.join(parts)}))"


_AGG = {"count": "COUNT(*)", "sum": "SUM(CAST({m} AS DECIMAL(18,4)))",
        "count_distinct": "COUNT(DISTINCT {m})", "min": "MIN(CAST({m} AS DECIMAL(18,4)))",
        "max": "MAX(CAST({m} AS DECIMAL(18,4)))"}


def module(from_sql: str, ts: str, period: str, dims: dict[str, str],
           measures: list[tuple[str, str, str]], where: str | None = None, incremental_anchor=None) -> str:
    """Pyramid module: GROUPING SETS over every dimension subset, unpivoted.

    ``measures`` are ``(indicator, kind, expression)``.
    """
    names = list(dims)
    conds = [where] if where else []
    if incremental_anchor is not None:
        lo = last_complete(period, incremental_anchor)
        hi = start_of(incremental_anchor, period)
        conds.append(f"{ts} >= {ts_lit(lo)} AND {ts} < {ts_lit(hi)}")
    w = (" WHERE " + " AND ".join(conds)) if conds else ""
    dim_sel = "".join(f"coalesce(CAST({e} AS VARCHAR), 'unknown') AS {k}, " for k, e in dims.items())
    meas_sel = ", ".join(f"{e or 1} AS __m{i}" for i, (_, _, e) in enumerate(measures))
    subsets = [[]]
    for n in names:
        subsets += [s + [n] for s in subsets]
    gsets = ", ".join("(" + ", ".join(["cycle_timestamp"] + s) + ")" for s in subsets)
    aggs = ", ".join(f"CAST({_AGG[k].format(m=f'__m{i}')} AS DECIMAL(18,4)) AS \"{ind}\""
                     for i, (ind, k, _) in enumerate(measures))
    dl = "".join(n + ", " for n in names)
    unions = " UNION ALL ".join(
        f"SELECT cycle_timestamp, {dl}'{ind}' AS indicator, \"{ind}\" AS value FROM p" for ind, _, _ in measures)
    return f"""
    SELECT indicator, dimensions, cycle, cycle_timestamp, value,
           {skey('indicator', 'dimensions', 'cycle', 'cycle_timestamp')} AS id
    FROM (
      WITH f AS (SELECT {period_start(ts, period)} AS cycle_timestamp, {dim_sel}{meas_sel} FROM {from_sql}{w}),
           p AS (SELECT cycle_timestamp, {dl}{aggs} FROM f GROUP BY GROUPING SETS ({gsets})),
           u AS ({unions})
      SELECT indicator, {dims_json(names)} AS dimensions, '{period}' AS cycle, cycle_timestamp, value FROM u
    ) m"""


# ---------------------------------------------------------------- test modules
def orders_module(period, anchor=None):
    return module("orders o LEFT JOIN customer c ON o.o_custkey = c.c_custkey", "o.o_orderdate", period,
                  {"segment": "c.c_mktsegment", "status": "o.o_orderstatus"},
                  [("ORDERS", "count", None), ("REVENUE", "sum", "o.o_totalprice")], incremental_anchor=anchor)


def orders_geo_module(period, anchor=None):
    frm = ("orders o LEFT JOIN (SELECT c.c_custkey, c.c_mktsegment, g.geo FROM customer c LEFT JOIN "
           "(SELECT n.n_nationkey, CASE WHEN r.r_name = 'AMERICA' THEN 'US' ELSE 'ROW' END AS geo "
           "FROM nation n JOIN region r ON n.n_regionkey = r.r_regionkey) g ON c.c_nationkey = g.n_nationkey) cg "
           "ON o.o_custkey = cg.c_custkey")
    return module(frm, "o.o_orderdate", period, {"geo": "cg.geo", "segment": "cg.c_mktsegment"},
                  [("ORDERS", "count", None), ("REVENUE", "sum", "o.o_totalprice")], incremental_anchor=anchor)


def lineitem_module(period, anchor=None):
    net = ("CAST(CAST(l_extendedprice AS DECIMAL(18,4)) * (1 - CAST(l_discount AS DECIMAL(18,4))) "
           "AS DECIMAL(18,4))")
    return module("lineitem", "l_shipdate", period, {"returnflag": "l_returnflag", "linestatus": "l_linestatus"},
                  [("UNITS", "sum", "l_quantity"), ("NET_REVENUE", "sum", net)], incremental_anchor=anchor)


def events_module(period, anchor=None):
    return module("events", "ts", period, {"event_type": "event_type"},
                  [("EVENTS", "count", None), ("EVENT_VALUE", "sum", "value"),
                   ("ACTIVE_USERS", "count_distinct", "user_id")], incremental_anchor=anchor)


def glossary_values() -> str:
    def v(x):
        if x is None:
            return "NULL"
        if isinstance(x, bool):
            return "TRUE" if x else "FALSE"
        return q(x)
    rows = ", ".join("(" + ", ".join(v(x) for x in r) + ")" for r in TD.GLOSSARY_ROWS)
    return (f"(SELECT * FROM (VALUES {rows}) AS g(indicator, readable_indicator, business_meaning, "
            f"methodology, is_core4, is_kpi, category))")


# ---------------------------------------------------------------- repository / report
def r6(x: str) -> str:
    """Round a double half-up at 6 decimals from its shortest decimal text (Spark's rule)."""
    return f"CAST(round(CAST(CAST({x} AS VARCHAR) AS DECIMAL(38,12)), 6) AS DOUBLE)"


def canon(j: str) -> str:
    """Canonical JSON object text: sorted keys, null entries dropped, values as text."""
    return (f"('{{' || array_to_string(list_transform(list_filter(list_sort(json_keys({j})), "
            f"lambda k: ({j}->>k) IS NOT NULL), lambda k: '\"' || k || '\":\"' || ({j}->>k) || '\"'), ',') || '}}')")


def shadow_values(rows) -> str:
    def v(x):
        if x is None:
            return "NULL"
        if isinstance(x, dt.datetime):
            return ts_lit(x)
        return q(x)
    vals = ", ".join("(" + ", ".join(v(x) for x in r) + ")" for r in rows)
    return (f"(SELECT indicator, dimensions, cycle_timestamp, cycle, CAST(value AS DECIMAL(18,8)) AS value, id "
            f"FROM (VALUES {vals}) AS s(indicator, dimensions, cycle_timestamp, cycle, value, id))")


def repository(modules: dict[str, str], shadow: str | None = None, period=None, anchor=None) -> str:
    data = " UNION ALL ".join(
        f"SELECT '{n}' AS _source_relation, indicator, dimensions, cycle, cycle_timestamp, value, id FROM ({s}) x"
        for n, s in modules.items())
    if shadow is not None:
        body = f"""
        SELECT 'repository_shadow' AS _source_relation, indicator, {canon('dimensions')} AS dimensions, cycle,
               CAST(cycle_timestamp AS TIMESTAMP) AS cycle_timestamp, CAST(value AS DECIMAL(18,4)) AS value, id
        FROM shadow
        UNION
        SELECT _source_relation, indicator, dimensions, cycle, cycle_timestamp, value, id FROM data
        WHERE NOT EXISTS (SELECT 1 FROM shadow s WHERE data.id = s.id OR (
            data.indicator = s.indicator AND data.dimensions = {canon('s.dimensions')}
            AND data.cycle = s.cycle AND data.cycle_timestamp = CAST(s.cycle_timestamp AS TIMESTAMP)))"""
        sql = f"WITH data AS ({data}), shadow AS (SELECT * FROM {shadow}) {body}"
    else:
        sql = data
    where = ""
    if anchor is not None:
        where = f" WHERE cycle = '{period}' AND cycle_timestamp = {ts_lit(last_complete(period, anchor))}"
    return f"SELECT * FROM ({sql}) r{where}"


def only_clause(period: str, starts) -> str:
    return f"cycle = '{period}' AND cycle_timestamp IN ({', '.join(ts_lit(t) for t in starts)})"


def report(repo_sql: str, period: str = "week", anchor=None, aop_sql: str | None = None,
           aop_scope: str = "all", plan_anchor=TD.ANCHOR) -> str:
    """Prior year by lookup: weeks through (year, ISO week) of the latest such period, others through the day a
    year back. Repository and series are computed once (MATERIALIZED), so that daily reports end within seconds."""
    emitted = f"WHERE {only_clause(period, [last_complete(period, anchor)])}" if anchor is not None else ""
    plan = "CAST(NULL AS DECIMAL(18,8))"
    if aop_sql is not None:
        scope = ""
        if aop_scope == "last_complete":
            scope = f" AND {only_clause(period, [last_complete(period, anchor or plan_anchor)]).replace('cycle', 't.cycle')}"
        plan = (f"(SELECT max(CAST(t.plan AS DECIMAL(18,8))) FROM ({aop_sql}) t WHERE t.indicator = e.indicator "
                f"AND {canon('t.dimensions')} = e.dimensions AND t.cycle = e.cycle "
                f"AND CAST(t.cycle_timestamp AS TIMESTAMP) = e.cycle_timestamp{scope})")
    series = "p.indicator = e.indicator AND p.dimensions = e.dimensions AND p.cycle = e.cycle"
    if period in ("week", "bi-week"):
        prior = (f"LEFT JOIN (SELECT indicator, dimensions, cycle, year(cycle_timestamp) + 1 AS y, weekofyear(cycle_timestamp) AS w, "
                 f"arg_max(value, cycle_timestamp) AS value FROM one GROUP BY ALL) p "
                 f"ON {series} AND p.y = year(e.cycle_timestamp) AND p.w = weekofyear(e.cycle_timestamp)")
    else:
        prior = f"LEFT JOIN one p ON {series} AND p.cycle_timestamp = e.cycle_timestamp - INTERVAL 1 YEAR"
    return f"""
    WITH one AS MATERIALIZED (
                 SELECT indicator, dimensions, cycle, cycle_timestamp, min(id) AS id, arg_min(value, id) AS value
                 FROM ({repo_sql}) GROUP BY indicator, dimensions, cycle, cycle_timestamp),
    e AS (SELECT * FROM one {emitted}),
    looked_up AS (
      SELECT e.*, {plan} AS aop_value, p.value AS prior_value,
        list_sort(json_keys(e.dimensions)) AS ks,
        list_transform(list_sort(json_keys(e.dimensions)), lambda k: e.dimensions->>k) AS vs
      FROM e {prior}),
    worded AS (
      SELECT l.id, l.indicator, l.cycle, l.cycle_timestamp, l.dimensions,
        l.indicator || ' by ' || CASE WHEN len(ks) = 0 THEN '*' ELSE array_to_string(ks, ' x ') END AS metric,
        coalesce(g.readable_indicator, l.indicator) || ' - '
          || coalesce(nullif(trim(array_to_string(vs, ', ')), ''), 'Global') AS metric_display_name,
        array_to_string(vs, ',') AS coordinates,
        1e10 * (list_position(['day', 'week', 'bi-week', 'month', 'quarter', 'year'], l.cycle) - 1)
          + CAST(strftime(l.cycle_timestamp, '%Y%m%d%H') AS DOUBLE) AS sortkey,
        CASE l.cycle WHEN 'week' THEN format('W-{{}}', weekofyear(l.cycle_timestamp))
             WHEN 'month' THEN strftime(l.cycle_timestamp, '%Y-%b')
             WHEN 'quarter' THEN format('{{}}Q{{}}', year(l.cycle_timestamp), quarter(l.cycle_timestamp))
             WHEN 'year' THEN strftime(l.cycle_timestamp, 'Y-%Y') END AS label,
        l.value AS current_value, l.prior_value, l.aop_value
      FROM looked_up l JOIN {glossary_values()} g ON g.indicator = l.indicator)
    SELECT *, {skey('indicator', 'metric', 'coordinates', 'cycle', 'cycle_timestamp')} AS alt_id FROM worded"""


# ---------------------------------------------------------------- time series / robust baseline
REPORT_REST = ["metric", "metric_display_name", "coordinates", "sortkey", "label", "current_value",
               "prior_value", "aop_value", "alt_id"]


def numbered(report_sql: str, period: str, spine_start, as_of) -> str:
    """CTE ``r``: report rows of the cycle with ``n``, the number of their period in the calendar."""
    return f"""
    days AS (SELECT unnest(range(DATE '{spine_start}', DATE '{as_of}' + 1, INTERVAL 1 DAY)) AS d),
    periods AS (SELECT s, row_number() OVER (ORDER BY s) - 1 AS n
                FROM (SELECT DISTINCT {period_start('d', period)} AS s FROM days)),
    r AS MATERIALIZED (SELECT x.*, n FROM ({report_sql}) x JOIN periods ON s = x.cycle_timestamp WHERE x.cycle = '{period}')"""


def _previous(points: int) -> str:
    """Self-join of ``r``: each row ``c`` with the rows ``p`` of its series in the ``points`` periods before."""
    return (f"r c LEFT JOIN r p ON p.indicator = c.indicator AND p.dimensions = c.dimensions "
            f"AND p.n BETWEEN c.n - {points} AND c.n - 1")


def timeseries(report_sql: str, period: str, spine_start, as_of, anchor=None) -> str:
    k = LOOKBACK[period]
    emitted = f"WHERE {only_clause(period, [last_complete(period, anchor)])}" if anchor is not None else ""
    scaled = "CAST(current_value * 10000 AS HUGEINT)"
    rest = ", ".join(REPORT_REST)
    return f"""
    WITH {numbered(report_sql, period, spine_start, as_of)},
    sums AS (SELECT *, count(current_value) OVER before AS points, sum({scaled}) OVER before AS s1,
                    sum({scaled} * {scaled}) OVER before AS s2
             FROM r WINDOW before AS (PARTITION BY indicator, dimensions ORDER BY n RANGE BETWEEN {k} PRECEDING AND 1 PRECEDING)),
    bands AS (SELECT *, points = {k} AS has_history,
                     CASE WHEN points = {k} THEN CAST(CAST(s1 AS VARCHAR) AS DOUBLE) / ({k} * 10000.0) END AS mid,
                     CASE WHEN points = {k} THEN CAST((s1 * 200 + {k}) // (2 * {k}) AS DOUBLE) / 1000000 END AS midpoint,
                     CASE WHEN points = {k} THEN sqrt(CAST(CAST({k} * s2 - s1 * s1 AS VARCHAR) AS DOUBLE)
                                                      / (CAST({k} AS DOUBLE) * ({k} - 1) * 1e8)) END AS sd
              FROM sums),
    judged AS (SELECT *, mid + 1.5 * sd AS hi, mid - 1.5 * sd AS lo, CAST(current_value AS DOUBLE) AS v FROM bands)
    SELECT {skey('indicator', 'dimensions', 'cycle', 'cycle_timestamp')} AS id, indicator, dimensions, cycle,
           cycle_timestamp, {rest}, CAST({k} AS INTEGER) AS historical_lookback, has_history, midpoint,
           {r6('sd')} AS sigma, {r6('hi')} AS upper_boundary, {r6('lo')} AS lower_boundary,
           v < lo OR v > hi AS in_alert, CASE WHEN v < lo THEN '↓' WHEN v > hi THEN '↑' END AS alert
    FROM judged {emitted}"""


def _trim_steps(src: str, steps: int = 3) -> tuple[str, str]:
    """CTEs applying the trimming step ``steps`` times to list column a0 of ``src``."""
    ctes = []
    prev = src
    for k in range(steps):
        a = f"a{k}"
        ctes.append(f"""
    s{k}m AS (SELECT *, list_reduce({a}, lambda acc, x: acc + x, 0.0) / nullif(len({a}), 0) AS m{k} FROM {prev}),
    s{k}s AS (SELECT *, sqrt(list_reduce(list_transform({a}, lambda x: (x - m{k}) * (x - m{k})),
                                         lambda acc, y: acc + y, 0.0) / nullif(len({a}), 0)) AS sd{k} FROM s{k}m),
    s{k}d AS (SELECT *, list_transform({a}, lambda x: CASE WHEN x < m{k} - 2 * sd{k} OR x > m{k} + 2 * sd{k}
                                                          THEN abs(x - m{k}) ELSE -1.0 END) AS d{k} FROM s{k}s),
    s{k}b AS (SELECT *, list_max(d{k}) AS b{k}, list_position(d{k}, list_max(d{k})) AS i{k} FROM s{k}d),
    s{k} AS (SELECT *, CASE WHEN len({a}) >= 2 AND b{k} > 0 THEN list_filter({a}, lambda x, i: i != i{k})
                          ELSE {a} END AS a{k + 1} FROM s{k}b)""")
        prev = f"s{k}"
    return ",".join(ctes), prev


def robust(report_sql: str, period: str, spine_start, as_of, points: int = 6) -> str:
    steps, last = _trim_steps("pts", 3)
    return f"""
    WITH {numbered(report_sql, period, spine_start, as_of)},
    pts AS (SELECT c.indicator, c.dimensions, c.cycle, c.cycle_timestamp, any_value(c.current_value) AS current_value,
                   count(p.current_value) = {points} AS full_,
                   coalesce(list(CAST(p.current_value AS DOUBLE) ORDER BY p.n)
                            FILTER (p.current_value IS NOT NULL), []) AS a0
            FROM {_previous(points)} GROUP BY c.indicator, c.dimensions, c.cycle, c.cycle_timestamp),{steps}
    SELECT indicator, dimensions, cycle, cycle_timestamp, current_value,
           CASE WHEN full_ THEN {points} ELSE 0 END AS baseline_points,
           {r6('CASE WHEN full_ THEN list_reduce(a3, lambda acc, x: acc + x, 0.0) / len(a3) END')} AS robust_mean
    FROM {last}"""
