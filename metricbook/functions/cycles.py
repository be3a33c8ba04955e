"""Reporting cycles: period truncation, period arithmetic and period labels.

Every function returns a Column built from Spark built-ins, so it stays inside
whole-stage codegen and never leaves the JVM.  Truncation goes through
``DateType`` (``trunc``/``to_date``) and is cast back to ``timestamp_ntz``,
which keeps it independent of the session time zone.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values that must equal the reference's.
# Cycle kinds accepted in KPI modules, in rank order (hour only in modules).
CYCLES = ("day", "week", "bi-week", "month", "quarter", "year")
MODULE_CYCLES = ("hour",) + CYCLES
# Number of previous data points that establish a reliable history, per cycle.
LOOKBACK = {"day": 32, "bi-week": 6, "week": 8, "month": 13, "quarter": 5, "year": 3}
# Rank of each cycle in the chart sort key (rank * 10^10 + yyyymmddHH).
SORT_RANK = {"day": 0, "week": 1, "bi-week": 2, "month": 3, "quarter": 4, "year": 5}


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def check_cycle(period: str, allowed=MODULE_CYCLES) -> str:
    if period not in allowed:
        raise ValueError(f"unsupported cycle {period!r}; expected one of {allowed}")
    return period


def period_start(ts, period: str) -> Column:
    """Start of the ``period`` containing ``ts`` as ``timestamp_ntz``.

    ``bi-week`` is the Monday of the ISO week, minus one week when the ISO week
    number is even (so bi-weeks start on odd ISO weeks).
    """
    check_cycle(period)
    d = F.to_date(_col(ts))
    if period == "hour":
        return d.cast("timestamp_ntz") + F.make_dt_interval(hours=F.hour(_col(ts)))
    if period == "day":
        start = d
    elif period == "week":
        start = F.trunc(d, "week")
    elif period == "bi-week":
        monday = F.trunc(d, "week")
        start = F.date_sub(monday, F.when(F.weekofyear(monday) % 2 == 0, 7).otherwise(0))
    else:
        start = F.trunc(d, period)
    return start.cast("timestamp_ntz")


def following_start(start, period: str) -> Column:
    """Start of the period after the one that starts at ``start`` (a bi-week after a 53-week year lasts one week)."""
    d = F.to_date(_col(start))
    if period == "hour":
        return _col(start) + F.expr("INTERVAL 1 HOUR")
    if period in ("day", "week"):
        after = F.date_add(d, 1 if period == "day" else 7)
    elif period == "bi-week":
        week = F.date_add(d, 7)
        after = F.when(F.weekofyear(week) % 2 == 1, week).otherwise(F.date_add(d, 14))
    else:
        after = F.add_months(d, {"month": 1, "quarter": 3, "year": 12}[check_cycle(period)])
    return after.cast("timestamp_ntz")


def days_in(start, period: str) -> Column:
    """Number of calendar days of the period that starts at ``start``."""
    return F.datediff(F.to_date(following_start(start, period)), F.to_date(_col(start)))


# ---------------------------------------------------------------- driver side
# The run configuration (anchor date, period) is a handful of literals; the
# helpers below turn it into literal bounds so the filters push down to the scan.

def _add_months(d: dt.date, months: int) -> dt.date:
    y, m = divmod(d.year * 12 + d.month - 1 + months, 12)
    return dt.date(y, m + 1, 1)


def start_of(d: dt.date | dt.datetime, period: str) -> dt.datetime:
    """Python twin of :func:`period_start` for a single literal."""
    check_cycle(period)
    if isinstance(d, dt.datetime):
        if period == "hour":
            return d.replace(minute=0, second=0, microsecond=0)
        d = d.date()
    if period in ("hour", "day"):
        s = d
    elif period in ("week", "bi-week"):
        s = d - dt.timedelta(days=d.weekday())
        if period == "bi-week" and s.isocalendar()[1] % 2 == 0:
            s -= dt.timedelta(days=7)
    elif period == "month":
        s = d.replace(day=1)
    elif period == "quarter":
        s = dt.date(d.year, 3 * ((d.month - 1) // 3) + 1, 1)
    else:
        s = dt.date(d.year, 1, 1)
    return dt.datetime(s.year, s.month, s.day)


def shift(ts: dt.datetime, period: str, n: int = 1) -> dt.datetime:
    """``ts`` moved by ``n`` period lengths (1 period, or 2 weeks for bi-week)."""
    if period == "hour":
        return ts + dt.timedelta(hours=n)
    if period == "day":
        return ts + dt.timedelta(days=n)
    if period == "week":
        return ts + dt.timedelta(weeks=n)
    if period == "bi-week":
        return ts + dt.timedelta(weeks=2 * n)
    months = {"month": 1, "quarter": 3, "year": 12}[period] * n
    d = _add_months(ts.date(), months)
    return dt.datetime(d.year, d.month, d.day, ts.hour, ts.minute, ts.second)


def minus_one_year(ts: dt.datetime) -> dt.datetime:
    """Calendar year back; Feb 29 becomes Feb 28 (same rule as interval arithmetic)."""
    try:
        return ts.replace(year=ts.year - 1)
    except ValueError:
        return ts.replace(year=ts.year - 1, day=28)


def ntz(t: dt.datetime | dt.date) -> Column:
    """Timestamp literal as ``timestamp_ntz`` via its text (no session or process time zone involved)."""
    if not isinstance(t, dt.datetime):
        t = dt.datetime(t.year, t.month, t.day)
    return F.lit(t.strftime("%Y-%m-%d %H:%M:%S.%f")).cast("timestamp_ntz")


def as_date(anchor) -> dt.date:
    if isinstance(anchor, dt.datetime):
        return anchor.date()
    if isinstance(anchor, dt.date):
        return anchor
    return dt.date.fromisoformat(str(anchor))


def last_complete(period: str, anchor, strict_biweek: bool = False) -> dt.datetime:
    """Start of the last complete period before ``anchor``: trunc(anchor) - 1 period.

    After a 53-week year the plain rule steps back two weeks from a bi-week whose
    predecessor lasts one, to a date where no bi-week starts, so such a run is
    empty.  ``strict_biweek`` takes the start of the bi-week before instead.
    """
    current = start_of(as_date(anchor), period)
    if strict_biweek and period == "bi-week":
        return start_of(current - dt.timedelta(days=1), period)
    return shift(current, period, -1)


def in_last_complete(ts, period: str, anchor, strict_biweek: bool = False) -> Column:
    """Half-open event window ``[start, end)`` of the last complete period."""
    start = last_complete(period, anchor, strict_biweek)
    end = start_of(as_date(anchor), period)
    c = _col(ts)
    return (c >= ntz(start)) & (c < ntz(end))


def prior_starts(start: dt.datetime, period: str) -> list[dt.datetime]:
    """Period starts that :func:`prior_lookup_key` of ``start`` can match."""
    if period not in _WEEKLY:
        return [minus_one_year(start)]
    first = dt.date(start.year - 1, 1, 1)
    days = (first + dt.timedelta(days=i) for i in range(366))
    return sorted({start_of(d, period) for d in days
                   if start_of(d, period).year == start.year - 1
                   and start_of(d, period).isocalendar()[1] == start.isocalendar()[1]})


def needed_starts(period: str, anchor, lookback: int = 0, periods: int = 1, prior: bool = False) -> list[dt.datetime]:
    """Periods that an incremental run reads: the last ``periods`` complete ones, ``lookback`` more
    before them, and (``prior``) what the former are compared with a year back."""
    emitted, s = [], last_complete(period, anchor)
    for _ in range(periods):
        emitted.append(s)
        s = start_of(s - dt.timedelta(days=1), period)
    before = []
    for _ in range(lookback):
        before.append(s)
        s = start_of(s - dt.timedelta(days=1), period)
    out = set(emitted) | set(before)
    if prior:
        out |= {p for e in emitted for p in prior_starts(e, period)}
    return sorted(out)


def in_periods(ts, period: str, starts: list[dt.datetime]) -> Column:
    """Events of the given periods: half-open literal ranges (neighbours joined), which reach the scan."""
    ranges: list[list[dt.datetime]] = []
    for s in starts:
        end = next_start(s, period)
        if ranges and ranges[-1][1] == s:
            ranges[-1][1] = end
        else:
            ranges.append([s, end])
    c = _col(ts)
    out = F.lit(False)
    for i, (a, b) in enumerate(ranges):
        inside = (c >= ntz(a)) & (c < ntz(b))
        out = inside if i == 0 else out | inside
    return out


def next_start(start: dt.datetime, period: str) -> dt.datetime:
    """Start of the period after the one that starts at ``start`` (a bi-week may last one week)."""
    if period != "bi-week":
        return shift(start, period, 1)
    week = start + dt.timedelta(weeks=1)
    return week if start_of(week, period) == week else start + dt.timedelta(weeks=2)


# ---------------------------------------------------------------- labels
def sortkey(cycle, ts) -> Column:
    """Chart sort key: cycle rank * 10^10 + yyyymmddHH, as double (NULL for hour)."""
    rank = None
    for name, r in SORT_RANK.items():
        rank = (F.when(_col(cycle) == name, F.lit(r)) if rank is None
                else rank.when(_col(cycle) == name, F.lit(r)))
    return (rank.cast("double") * F.lit(1e10)
            + F.date_format(_col(ts), "yyyyMMddHH").cast("double"))


def label(cycle, ts) -> Column:
    """`Y-2024`, `2024-Jan`, `W-1`, `2024Q1`; NULL for day, bi-week and hour."""
    c, t = _col(cycle), _col(ts)
    return (F.when(c == "year", F.concat(F.lit("Y-"), F.year(t).cast("string")))
            .when(c == "month", F.date_format(t, "yyyy-MMM"))
            .when(c == "week", F.concat(F.lit("W-"), F.weekofyear(t).cast("string")))
            .when(c == "quarter", F.concat(F.year(t).cast("string"), F.lit("Q"),
                                           F.quarter(t).cast("string"))))


# ---------------------------------------------------------------- prior year key
_WEEKLY = ("week", "bi-week")
_YEARLY = ("day", "month", "quarter", "year")


def _ts_key(t: Column) -> Column:
    return F.date_format(t, "yyyyMMddHHmmss").cast("long")


def prior_match_key(cycle, ts) -> Column:
    """Key under which a row is looked up as somebody's prior-year value.

    week / bi-week: year * 100 + ISO week; day ... year: the timestamp itself.
    """
    c, t = _col(cycle), _col(ts)
    return (F.when(c.isin(*_WEEKLY), F.year(t).cast("long") * 100 + F.weekofyear(t))
            .when(c.isin(*_YEARLY), _ts_key(t)))


def prior_lookup_key(cycle, ts) -> Column:
    """Key of the prior-year row wanted by a current row.

    week / bi-week: same ISO week number in the previous *calendar* year;
    day ... year: the timestamp minus one year.  NULL for any other cycle.
    """
    c, t = _col(cycle), _col(ts)
    return (F.when(c.isin(*_WEEKLY), (F.year(t).cast("long") - 1) * 100 + F.weekofyear(t))
            .when(c.isin(*_YEARLY), _ts_key(t - F.expr("INTERVAL 1 YEAR"))))
