"""Entity KPIs and the calendar lattice against plain Python, above all over bi-weeks and gaps."""

import datetime as dt
import random
from collections import defaultdict
from decimal import ROUND_HALF_UP, Decimal
from itertools import combinations

import pytest
from pyspark.sql import functions as F

from metricbook.config import RunConfig
from metricbook.functions import cycles
from metricbook.operators import entities as E
from metricbook.operators import lattice as L
from metricbook.operators.pyramid import Measure, kpi_module

DIMS = ["geo", "plan"]


def _facts(n=400, seed=1, users=25, first=dt.date(2020, 11, 30), days=70):
    draw = random.Random(seed)
    rows = []
    for i in range(n):
        day = first + dt.timedelta(days=int(draw.random() ** 2 * days))
        rows.append((i, dt.datetime(day.year, day.month, day.day, draw.randrange(24)), draw.choice([None, *range(users)]),
                     draw.choice(["US", "ROW", None]), draw.choice("ab"), Decimal(draw.randrange(-500, 10_000)) / 100))
    return rows


def _frame(spark, rows):
    return spark.createDataFrame(rows, "k long, ts timestamp_ntz, user long, geo string, plan string, v decimal(18,4)")


def _coordinates(geo, plan):
    """Every subset of the dimensions of a fact, as canonical text."""
    pairs = [("geo", geo or "unknown"), ("plan", plan)]
    for r in range(3):
        for some in combinations(pairs, r):
            yield "{" + ",".join(f'"{k}":"{v}"' for k, v in some) + "}"


def _by_period(rows, period):
    out = defaultdict(list)  # (coordinate, period) -> facts
    for row in rows:
        for c in _coordinates(row[3], row[4]):
            out[c, cycles.start_of(row[1], period)].append(row)
    return out


def _got(df, indicator=None):
    return {(r.dimensions, r.cycle_timestamp): r.value for r in df.collect() if indicator in (None, r.indicator)}


def _quotient(n, d):
    return None if not d else (Decimal(n) / Decimal(d)).quantize(Decimal("0.0001"), ROUND_HALF_UP)


PERIODS = ["day", "week", "bi-week", "month", "quarter", "year"]


@pytest.mark.parametrize("period", ["day", "bi-week", "month"])
def test_following_start_is_the_literal_rule(spark, period):
    days = [dt.datetime(2019, 12, 1) + dt.timedelta(days=i) for i in range(800)]
    starts = sorted({cycles.start_of(d, period) for d in days})
    df = spark.createDataFrame([(s,) for s in starts], "s timestamp_ntz")
    rows = df.select("s", cycles.following_start("s", period).alias("n"), cycles.days_in("s", period).alias("d")).collect()
    assert {r.s: (r.n, r.d) for r in rows} == {s: (cycles.next_start(s, period), (cycles.next_start(s, period) - s).days) for s in starts}


@pytest.mark.parametrize("period", ["bi-week", "month"])
def test_ratios_divide_once_per_coordinate(spark, period):
    rows = _facts()
    us, a = F.col("geo") == "US", F.col("plan") == "a"
    out = E.ratio_module(_frame(spark, rows), "ts", period, DIMS, [
        E.Ratio("USERS_A", Measure("x", "count_distinct", "user", a), Measure("y", "count_distinct", "user")),
        E.Ratio("SHARE_US", Measure("x", "count", where=us), Measure("y", "count")),
        E.Ratio("V_PER_US", Measure("x", "sum", "v"), Measure("y", "count", where=us))], keep_parts=True)
    facts = _by_period(rows, period)
    users = lambda f, keep=lambda r: True: len({r[2] for r in f if r[2] is not None and keep(r)})
    assert _got(out, "USERS_A") == {k: _quotient(users(f, lambda r: r[4] == "a"), users(f)) for k, f in facts.items()}
    assert _got(out, "SHARE_US") == {k: _quotient(sum(r[3] == "US" for r in f), len(f)) for k, f in facts.items()}
    value = lambda f: sum(r[5] for r in f)
    assert _got(out, "V_PER_US") == {k: _quotient(value(f), sum(r[3] == "US" for r in f)) for k, f in facts.items()}
    assert any(v is None for v in _got(out, "V_PER_US").values()) and out.where("indicator = 'V_PER_US' AND value < 0").count() >= 0
    parts = out.where("indicator = 'SHARE_US' AND dimensions = '{}'").agg(F.sum("numerator"), F.sum("denominator")).first()
    assert tuple(parts) == (sum(r[3] == "US" for r in rows), len(rows))
    with pytest.raises(ValueError):
        E.ratio_module(_frame(spark, rows), "ts", period, DIMS, [E.Ratio("X", Measure("a", "count_distinct", "user"), Measure("b", "count_distinct", "k"))])


@pytest.mark.parametrize("period", ["week", "bi-week", "month"])
def test_stocks_at_the_end_of_each_period(spark, period):
    rows = _facts()
    cfg = RunConfig(period, dt.date(2021, 3, 1), True, spine_start=dt.date(2020, 12, 9), as_of=dt.date(2021, 2, 20))
    out = E.end_of_period(_frame(spark, rows), "ts", period, DIMS, "user", {"N": None, "V": "v"}, cfg, tie=["k"])
    spine, d = [], cfg.spine_start
    while d <= cfg.as_of:
        if cycles.start_of(d, period) not in spine:
            spine.append(cycles.start_of(d, period))
        d += dt.timedelta(days=1)
    count, value, seen = {}, {}, set()
    for s in spine:
        last = {}
        for r in sorted(rows, key=lambda r: (r[1], r[0])):
            if r[2] is not None and r[1] < cycles.next_start(s, period):
                last[r[2]] = r
        n, v = defaultdict(int), defaultdict(Decimal)
        for r in last.values():
            for c in _coordinates(r[3], r[4]):
                n[c] += 1
                v[c] += r[5]
        seen |= set(n)
        count |= {(c, s): n[c] for c in seen}
        value |= {(c, s): v[c] for c in seen}
    assert _got(out, "N") == count and _got(out, "V") == value


@pytest.mark.parametrize("period", ["week", "bi-week", "quarter"])
def test_average_daily_users(spark, period):
    rows = _facts()
    out = _got(E.average_daily(_frame(spark, rows), "ts", period, DIMS, "user", "DAU"))
    daily = {k: {r[2] for r in f if r[2] is not None} for k, f in _by_period(rows, "day").items()}
    want = defaultdict(int)
    for (c, day), users in daily.items():
        want[c, cycles.start_of(day, period)] += len(users)
    assert out == {(c, s): _quotient(n, (cycles.next_start(s, period) - s).days) for (c, s), n in want.items() if n}
    cfg = RunConfig("week", dt.date(2020, 12, 15))
    if period == "week":
        one = _got(E.average_daily(_frame(spark, rows), "ts", period, DIMS, "user", "DAU", cfg=cfg))
        assert one == {k: v for k, v in out.items() if k[1] == dt.datetime(2020, 12, 7)}


def _active(rows, period):
    return {k: {r[2] for r in f if r[2] is not None} for k, f in _by_period(rows, period).items() if any(r[2] is not None for r in f)}


@pytest.mark.parametrize("period", ["day", "bi-week", "month"])
def test_retention_by_bitmaps_and_by_rows(spark, period):
    rows = [(k, t, None if u is None else u * 50_021 - 400_000, g, p, v) for k, t, u, g, p, v in _facts(users=60)]
    facts, active = _frame(spark, rows), _active(rows, period)
    seen = {s for _, s in active}
    want = {}
    for (c, s), users in active.items():
        after = cycles.next_start(s, period)
        if after in seen:
            want[c, after] = _quotient(len(users & active.get((c, after), set())), len(users))
    assert any(v == 0 for v in want.values()) and any(v for v in want.values())
    assert _got(E.retention(facts, "ts", period, DIMS, "user", "R")) == want
    assert _got(E.retention(facts, "ts", period, DIMS, "user", "R", bitmaps=False)) == want
    named = facts.withColumn("user", F.concat(F.lit("u"), F.col("user").cast("string")))
    assert _got(E.retention(named, "ts", period, DIMS, "user", "R")) == want
    with pytest.raises(ValueError):
        E.retention(named, "ts", period, DIMS, "user", "R", bitmaps=True)


def test_retention_of_the_last_period_reads_two(spark):
    rows = _facts(users=60)
    facts = _frame(spark, rows)
    for period, anchor in (("week", dt.date(2020, 12, 16)), ("bi-week", dt.date(2021, 1, 20))):
        cfg = RunConfig(period, anchor)
        whole = _got(E.retention(facts, "ts", period, DIMS, "user", "R"))
        one = _got(E.retention(facts, "ts", period, DIMS, "user", "R", cfg=cfg))
        assert one and one == {k: v for k, v in whole.items() if k[1] == cfg.last_complete}


@pytest.mark.parametrize("period", ["day", "bi-week", "month"])
def test_lifecycle_states(spark, period):
    rows = _facts(n=250)
    names = {s: s.upper() for s in (*E.STATES, "active")}
    out = E.lifecycle(_frame(spark, rows), "ts", period, DIMS, "user", names)
    active = _active(rows, period)
    seen = {s for _, s in active}
    want = {s: defaultdict(int) for s in names}
    keys = set()
    for c in {c for c, _ in active}:
        for u in {u for (d, _), us in active.items() if d == c for u in us}:
            mine = sorted(s for (d, s), us in active.items() if d == c and u in us)
            for i, s in enumerate(mine):
                state = "new" if not i else "retained" if cycles.next_start(mine[i - 1], period) == s else "resurrected"
                want[state][c, s] += 1
                want["active"][c, s] += 1
                keys.add((c, s))
                after = cycles.next_start(s, period)
                if after in seen and after not in mine:
                    want["churned"][c, after] += 1
                    keys.add((c, after))
    for s, i in names.items():
        assert _got(out, i) == {k: want[s][k] for k in keys}, s
    assert sum(want["resurrected"].values()) and sum(want["churned"].values())


@pytest.mark.parametrize("period", ["day", "bi-week", "week"])
def test_streaks(spark, period):
    rows = _facts(n=600, users=12)
    out = E.streaks(_frame(spark, rows), "ts", period, DIMS, "user", {1: "S1", 2: "S2", 4: "S4"})
    active = _active(rows, period)

    def length(c, s, u):
        n = 0
        while u in active.get((c, s), ()):
            n += 1
            s = cycles.start_of(s - dt.timedelta(days=1), period)
        return n

    for k, name in ((1, "S1"), (2, "S2"), (4, "S4")):
        assert _got(out, name) == {(c, s): sum(length(c, s, u) >= k for u in us) for (c, s), us in active.items()}


def test_entity_kpis_of_no_facts(spark):
    none = _frame(spark, _facts(3)).limit(0)
    cfg = RunConfig("week", dt.date(2021, 3, 1), True, spine_start=dt.date(2020, 12, 9), as_of=dt.date(2021, 2, 20))
    frames = [E.ratio_module(none, "ts", "week", DIMS, [E.Ratio("R", Measure("a", "count"), Measure("b", "count_distinct", "user"))]),
              E.end_of_period(none, "ts", "week", DIMS, "user", {"N": None}, cfg), E.average_daily(none, "ts", "week", DIMS, "user", "D"),
              E.retention(none, "ts", "week", DIMS, "user", "R"), E.lifecycle(none, "ts", "week", DIMS, "user", {"new": "N"}),
              E.streaks(none, "ts", "week", DIMS, "user", {2: "S"}), L.all_cycles_module(none, "ts", DIMS, [Measure("N", "count")])]
    assert [f.count() for f in frames] == [0] * len(frames)


# ---- lattice

def _measures():
    return [Measure("N", "count"), Measure("US", "count", where=F.col("geo") == "US"), Measure("V", "sum", "v"), Measure("LOW", "min", "v"),
            Measure("HIGH", "max", "v"), Measure("USERS", "count_distinct", "user"), Measure("PLANS", "count_distinct", "plan")]


def test_all_cycles_equal_the_modules_of_each(spark, tmp_path):
    _frame(spark, _facts(n=900, days=500)).write.parquet(str(tmp_path / "facts"))
    facts = spark.read.parquet(str(tmp_path / "facts"))
    got = L.all_cycles_module(facts, "ts", DIMS, _measures())
    want = None
    for period in cycles.CYCLES:
        part = kpi_module(facts, "ts", period, DIMS, _measures())
        want = part if want is None else want.unionByName(part)
    assert got.columns == want.columns and got.exceptAll(want).isEmpty() and want.exceptAll(got).isEmpty() and got.count() > 1000


def test_all_cycles_read_the_facts_once(spark, tmp_path):
    _frame(spark, _facts(n=900, days=500)).write.parquet(str(tmp_path / "facts"))
    got = L.all_cycles_module(spark.read.parquet(str(tmp_path / "facts")), "ts", DIMS, _measures()[:6])
    got.collect()
    plan = got._jdf.queryExecution().executedPlan().toString()
    final = plan.split("== Initial Plan ==")[0]
    assert final.count("FileScan parquet") == 1 and final.count("ReusedExchange") >= 5


def test_sketches_merge_within_their_bound(spark):
    rows = [(i, dt.datetime(2024, 1, 1) + dt.timedelta(hours=i % 2000), (i * 7919) % 30_000, "US" if i % 3 else "ROW", "a", Decimal(1))
            for i in range(60_000)]
    facts = _frame(spark, rows)
    days = L.sketch_days(facts, "ts", {"geo": "geo"}, "user")
    merged = _got(L.sketch_module(days, ["geo"], "U", ["day", "week", "quarter"]))
    exact = _got(L.all_cycles_module(facts, "ts", ["geo"], [Measure("U", "count_distinct", "user")], ["day", "week", "quarter"]))
    assert merged.keys() == exact.keys() and len(exact) > 100 and max(exact.values()) == 30_000
    bound = Decimal(3 * 1.04 / 2 ** (L.LG_K / 2))
    assert all(abs(merged[k] - exact[k]) <= max(1, exact[k] * bound) for k in exact)
