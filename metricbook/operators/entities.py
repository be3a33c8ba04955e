"""KPI modules that plain sums cannot give: ratios, stocks at the end of a period, daily averages, retention,
lifecycle states and streaks of entities (users, customers, subscribers).

All return the module contract (``indicator, dimensions, cycle, cycle_timestamp, value, id``) at every subset
of the dimensions, so repository, report and time series take them like any other module.

Common to all plans: facts are scanned once and first reduced to one row per (period, dimensions, entity); only
that table is expanded into the grouping sets, with the entity as a further key, so that a coordinate that
holds all entities is still spread over tasks; the last step adds up rows per (period, coordinate) with
map-side partial sums. No facts are joined with themselves. NULL dimensions become ``unknown``.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from metricbook.config import RunConfig
from metricbook.functions import cycles, dims as D, keys
from metricbook.operators.pyramid import VALUE_TYPE, Measure, _as_col, all_subsets, placed, to_module
from metricbook.operators.timeseries import calendar, period_index

PERIOD = "cycle_timestamp"


def _dims(dims) -> dict:
    return {d: d for d in dims} if isinstance(dims, (list, tuple)) else dict(dims)


def _sets(names: list[str], sets) -> list[tuple[str, ...]]:
    out = [tuple(s) for s in (sets if sets is not None else all_subsets(names))]
    unknown = {d for s in out for d in s} - set(names)
    if unknown:
        raise ValueError(f"grouping sets use unknown dimensions {unknown}")
    return out


def _expand(df: DataFrame, names: list[str], sets, more: list[str], aggs: list[Column]) -> DataFrame:
    """``df`` grouped by (period, subset of the dimensions, ``more``) for every set; other dimensions are NULL."""
    columns = [F.col(c) for c in (PERIOD, *names, *more)]
    return (df.groupingSets([[F.col(c) for c in (PERIOD, *s, *more)] for s in sets], *columns)
            .agg(*aggs).select(PERIOD, *names, *more, *[c for c in _names(aggs)]))


def _names(aggs: list[Column]) -> list[str]:
    return [f"__a{i}" for i in range(len(aggs))]


def _named(aggs: list[Column]) -> list[Column]:
    return [c.alias(n) for c, n in zip(aggs, _names(aggs))]


def _rows(wide: DataFrame, period: str, names: list[str], indicators: list[str]) -> DataFrame:
    return to_module(wide.withColumn("cycle", F.lit(period)), names, indicators)


def quotient(numerator: Column, denominator: Column) -> Column:
    """``numerator / denominator`` rounded half up to 4 decimals, exact; NULL where the denominator is 0."""
    n, d = (F.abs(x.cast(VALUE_TYPE)) for x in (numerator, denominator))
    units = F.call_function("div", n * F.lit(20_000) + d, d * F.lit(2)).cast("decimal(18,0)")
    sign = F.when((numerator < 0) != (denominator < 0), -1).otherwise(1)
    return F.when(denominator != 0, (units * sign * F.lit("0.0001").cast("decimal(4,4)")).cast(VALUE_TYPE))


# ---------------------------------------------------------------- ratios
@dataclass(frozen=True)
class Ratio:
    """A KPI of two measures, count / sum / count_distinct each, with conditions of their own."""

    indicator: str
    numerator: Measure
    denominator: Measure


def ratio_module(facts: DataFrame, ts: str | Column, period: str, dims, ratios: list[Ratio],
                 cfg: RunConfig | None = None, sets=None, keep_parts: bool = False, only: list | None = None) -> DataFrame:
    """Ratios are not additive: numerator and denominator pass both aggregation stages and are divided once
    per coordinate. A distinct count is one flag per entity there, so both sides may count the same entities.

    A ratio over nothing is NULL. ``keep_parts`` adds columns ``numerator`` and ``denominator``, from which
    ratios of wider coordinates or longer periods of additive sides can be formed again."""
    cycles.check_cycle(period)
    dims = _dims(dims)
    names, sets = list(dims), _sets(list(dims), sets)
    parts = [m for r in ratios for m in (r.numerator, r.denominator)]
    distinct = [m for m in parts if m.kind == "count_distinct"]
    if any(m.kind in ("min", "max") for m in parts):
        raise ValueError("a ratio is of counts, sums and distinct counts")
    if len({str(_as_col(m.column)) for m in distinct}) > 1:
        raise ValueError("the distinct counts of one ratio module must count one kind of entity")
    entity = ["__entity"] if distinct else []
    inputs = [m.input.alias(f"__in{i}") for i, m in enumerate(parts)]
    base = placed(facts, ts, period, dims, [_as_col(distinct[0].column).alias("__entity")] * bool(distinct) + inputs, cfg, only=only)

    def first(i: int, m: Measure) -> Column:
        c = F.col(f"__in{i}")
        if m.kind == "count_distinct":
            return F.max(c.isNotNull().cast("int"))
        return F.count(c).cast(VALUE_TYPE) if m.kind == "count" else F.coalesce(F.sum(c.cast(VALUE_TYPE)), F.lit(0).cast(VALUE_TYPE))

    fine = base.groupBy(PERIOD, *names, *entity).agg(*_named([first(i, m) for i, m in enumerate(parts)]))
    again = _named([(F.max if m.kind == "count_distinct" else F.sum)(F.col(f"__a{i}")) for i, m in enumerate(parts)])
    wide = _expand(fine, names, sets, entity, again)
    if entity:
        wide = wide.groupBy(PERIOD, *names).agg(*_named([F.sum(F.col(n)) for n in _names(parts)]))
    sides = [F.struct(F.col(f"__a{2 * i}").cast(VALUE_TYPE).alias("numerator"), F.col(f"__a{2 * i + 1}").cast(VALUE_TYPE)
                      .alias("denominator"), F.lit(r.indicator).alias("indicator")) for i, r in enumerate(ratios)]
    long = wide.select(PERIOD, *names, F.inline(F.array(*sides)))
    return _rows_of(long.withColumn("value", quotient(F.col("numerator"), F.col("denominator"))), period, names,
                    ["numerator", "denominator"] if keep_parts else [])


def _rows_of(long: DataFrame, period: str, names: list[str], more: list[str]) -> DataFrame:
    """Module rows of a frame that already has ``indicator`` and ``value``."""
    rows = long.select("indicator", D.from_columns(names).alias("dimensions", metadata=D.CANONICAL), F.lit(period).alias("cycle"),
                       PERIOD, F.col("value").cast(VALUE_TYPE).alias("value"), *more)
    return rows.withColumn("id", keys.surrogate_key(rows, "indicator", "dimensions", "cycle", PERIOD)).select(
        "indicator", "dimensions", "cycle", PERIOD, "value", "id", *more)


# ---------------------------------------------------------------- stocks and daily averages
def end_of_period(facts: DataFrame, ts: str | Column, period: str, dims, entity: str, measures: dict[str, str | Column | None],
                  cfg: RunConfig, tie: list[str] | None = None, sets=None) -> DataFrame:
    """Stocks at the end of each period: every entity counts with its last state up to then, also in periods
    without a fact of it. ``measures``: indicator -> value of the state (None counts entities).

    Additive over dimensions, not over time. A change of state is an entry at the new coordinates and an exit
    at the old ones; entries and exits are summed over the grouping sets and then run up over the calendar, so
    no row per entity and period is ever made. A coordinate has rows from its first entry to the end of the run's
    reporting calendar; what happened before that calendar enters with its first period. ``tie`` orders facts of
    one time."""
    cycles.check_cycle(period)
    dims = _dims(dims)
    names, sets = list(dims), _sets(list(dims), sets)
    values = [f"__v{i}" for i in range(len(measures))]
    inputs = [(F.lit(1) if m is None else _as_col(m)).cast(VALUE_TYPE).alias(v) for v, m in zip(values, measures.values())]
    order = F.struct(_as_col(ts).alias("t"), *[F.col(c).alias(f"t{i}") for i, c in enumerate(tie or [])])
    periods = calendar(period, cfg.spine_start, cfg.spine_end)
    spine = period_index(facts.sparkSession, period, cfg.spine_start, cfg.spine_end)
    facts = facts.filter(_as_col(ts) < cycles.ntz(cycles.next_start(periods[-1], period)))
    base = placed(facts, ts, period, dims, [F.col(entity).alias("__entity"), order.alias("__order"), *inputs])
    base = base.withColumn(PERIOD, F.greatest(PERIOD, cycles.ntz(periods[0])))
    state = F.struct(*names, *values)
    last = base.where("__entity IS NOT NULL").groupBy("__entity", PERIOD).agg(F.max_by(state, "__order").alias("__now"))
    before = F.lag("__now").over(Window.partitionBy("__entity").orderBy(PERIOD))

    def entry(s: Column, sign: int) -> Column:
        return F.struct(*[s[n].alias(n) for n in names], *[(F.coalesce(s[v], F.lit(0)) * sign).cast(VALUE_TYPE).alias(v) for v in values])

    moved = (last.withColumn("__before", before)
             .withColumn("__moves", F.filter(F.array(entry(F.col("__now"), 1), F.when(
                 F.col("__before").isNotNull(), entry(F.col("__before"), -1))), lambda x: x.isNotNull()))
             .select(PERIOD, F.inline("__moves")))
    sums = _named([F.sum(F.col(v)).cast("decimal(28,4)") for v in values])
    steps = _expand(moved.groupBy(PERIOD, *names).agg(*[F.sum(v).alias(v) for v in values]), names, sets, [], sums)
    # Each step holds until the next one; the calendar is numbered, so that is a range of numbers.
    per = Window.partitionBy(*names).orderBy("period_idx")
    stock = (steps.join(spine, PERIOD)
             .select(*names, "period_idx", *[F.sum(a).over(per.rowsBetween(Window.unboundedPreceding, 0)).alias(a) for a in _names(sums)],
                     F.lead("period_idx").over(per).alias("__next"))
             .withColumn("__next", F.coalesce("__next", F.lit(len(periods)))))
    dense = (stock.withColumn("period_idx", F.explode(F.sequence("period_idx", F.col("__next") - 1)))
             .join(spine, "period_idx").select(PERIOD, *names, *[F.col(a).cast(VALUE_TYPE).alias(m) for a, m in zip(_names(sums), measures)]))
    return _rows(dense, period, names, list(measures))


def average_daily(facts: DataFrame, ts: str | Column, period: str, dims, entity: str, indicator: str, sets=None,
                  cfg: RunConfig | None = None, only: list | None = None) -> DataFrame:
    """Mean over the calendar days of a period of the day's distinct entities (days without any count 0)."""
    cycles.check_cycle(period, cycles.CYCLES)
    dims = _dims(dims)
    names, sets = list(dims), _sets(list(dims), sets)
    if cfg is not None and cfg.incremental and only is None:
        only = [cfg.last_complete]
    if only is not None:
        facts = facts.filter(cycles.in_periods(ts, period, only) & cycles.period_start(ts, period).isin(*[cycles.ntz(s) for s in only]))
    daily = placed(facts, ts, "day", dims, [F.col(entity).alias("__entity")]).where("__entity IS NOT NULL").distinct()
    each = _expand(daily, names, sets, ["__entity"], _named([F.lit(1)]))
    per_period = (each.groupBy(cycles.period_start(PERIOD, period).alias("__start"), PERIOD, *names).agg(F.count("*").alias("n"))
                  .groupBy("__start", *names).agg(F.sum("n").alias("n")))
    wide = per_period.select(F.col("__start").alias(PERIOD), *names,
                             quotient(F.col("n").cast(VALUE_TYPE), cycles.days_in("__start", period).cast(VALUE_TYPE)).alias(indicator))
    return _rows(wide, period, names, [indicator])


# ---------------------------------------------------------------- entities over time
def _active(facts, ts, period, dims, entity, cfg=None, only=None) -> DataFrame:
    return placed(facts, ts, period, dims, [F.col(entity).alias("__entity")], cfg, only=only).where("__entity IS NOT NULL").distinct()


def _observed(rows: DataFrame, active: DataFrame) -> DataFrame:
    """Rows of periods that have facts; exits after the last one lie in a period that is not there yet."""
    return rows.join(active.select(PERIOD).distinct(), PERIOD, "left_semi")


def retention(facts: DataFrame, ts: str | Column, period: str, dims, entity: str, indicator: str, sets=None,
              cfg: RunConfig | None = None, bitmaps: bool | None = None) -> DataFrame:
    """Share of the entities of a period that are active in the next one, at the same coordinate: P(n) over
    P(n - 1), a row for each period n whose predecessor had any.

    Whole-number entities are kept as bitmaps of 32,768 neighbouring numbers each: built per (period,
    coordinate, bucket), moved on by one period and intersected with those that stand there. Other types go
    the same way as rows. ``bitmaps`` decides by hand, e.g. for numbers that are very sparse."""
    cycles.check_cycle(period)
    dims = _dims(dims)
    names, sets = list(dims), _sets(list(dims), sets)
    whole = dict(facts.dtypes)[entity] in ("tinyint", "smallint", "int", "bigint")
    if bitmaps and not whole:
        raise ValueError("bitmaps need whole-number entities")
    only = None
    if cfg is not None and cfg.incremental:
        only = [cycles.start_of(cycles.shift(cfg.last_complete, "day", -1), period), cfg.last_complete]
    active = placed(facts, ts, period, dims, [F.col(entity).alias("__entity")], None, only=only).where("__entity IS NOT NULL")
    if whole if bitmaps is None else bitmaps:
        fine = (active.groupBy(PERIOD, *names, F.bitmap_bucket_number("__entity").alias("__bucket"))
                .agg(F.bitmap_construct_agg(F.bitmap_bit_position("__entity")).alias("__bits")))
        now = _expand(fine, names, sets, ["__bucket"], _named([F.bitmap_or_agg("__bits")])).withColumnRenamed("__a0", "__bits")
        moved = now.withColumn(PERIOD, cycles.following_start(PERIOD, period))
        met = (now.withColumn("__old", F.lit(False)).unionByName(moved.withColumn("__old", F.lit(True)))
               .groupBy(PERIOD, *names, "__bucket")
               .agg(F.count("*").alias("__n"), F.bitmap_and_agg("__bits").alias("__both"),
                    F.sum(F.when(F.col("__old"), F.bitmap_count("__bits")).otherwise(0)).alias("__before"))
               .withColumn("__kept", F.when(F.col("__n") == 2, F.bitmap_count("__both")).otherwise(0)))
    else:
        now = _expand(active.distinct(), names, sets, ["__entity"], _named([F.lit(1)])).drop("__a0")
        moved = now.withColumn(PERIOD, cycles.following_start(PERIOD, period))
        met = (now.withColumn("__old", F.lit(0)).unionByName(moved.withColumn("__old", F.lit(1)))
               .groupBy(PERIOD, *names, "__entity").agg(F.sum("__old").alias("__before"), F.count("*").alias("__n"))
               .withColumn("__kept", (F.col("__n") == 2).cast("int")))
    both = met.groupBy(PERIOD, *names).agg(F.sum("__kept").alias("kept"), F.sum("__before").alias("before")).where("before > 0")
    wide = _observed(both, active).select(PERIOD, *names, quotient(F.col("kept").cast(VALUE_TYPE), F.col("before").cast(VALUE_TYPE))
                                          .alias(indicator))
    if cfg is not None and cfg.incremental:
        wide = wide.filter(F.col(PERIOD) == cycles.ntz(cfg.last_complete))
    return _rows(wide, period, names, [indicator])


#: States of an entity in a period; the first three add up to the active ones.
STATES = ("new", "retained", "resurrected", "churned")


def lifecycle(facts: DataFrame, ts: str | Column, period: str, dims, entity: str, indicators: dict[str, str], sets=None) -> DataFrame:
    """Entities per state (keys of ``indicators``: some of STATES, and ``active``), period and coordinate.

    An active entity is new in its first period, retained if it was active in the period before, resurrected
    after a gap; it is churned in the first period it misses. One window over the active periods of an entity
    at a coordinate (at most one row a period) gives all four."""
    unknown = set(indicators) - {*STATES, "active"}
    if unknown:
        raise ValueError(f"unknown states {unknown}")
    cycles.check_cycle(period)
    dims = _dims(dims)
    names, sets = list(dims), _sets(list(dims), sets)
    active = _active(facts, ts, period, dims, entity)
    each = _expand(active, names, sets, ["__entity"], _named([F.lit(1)])).drop("__a0")
    own = Window.partitionBy(*names, "__entity").orderBy(PERIOD)
    before, after = F.lag(PERIOD).over(own), F.lead(PERIOD).over(own)
    following = cycles.following_start(PERIOD, period)
    told = (each.withColumn("__before", before).withColumn("__after", after).withColumn("__following", following)
            .withColumn("__state", F.when(F.col("__before").isNull(), "new")
                        .when(cycles.following_start("__before", period) == F.col(PERIOD), "retained").otherwise("resurrected"))
            .withColumn("__left", ~F.coalesce(F.col("__after") == F.col("__following"), F.lit(False))))
    states = told.select(*names, F.inline(F.filter(F.array(
        F.struct(F.col(PERIOD).alias(PERIOD), F.col("__state").alias("state")),
        F.struct(F.when(F.col("__left"), F.col("__following")).alias(PERIOD), F.lit("churned").alias("state"))),
        lambda x: x[PERIOD].isNotNull())))
    wide = _observed(states, active).groupBy(PERIOD, *names).agg(*[
        F.sum((F.col("state") != "churned" if s == "active" else F.col("state") == s).cast("int")).cast(VALUE_TYPE).alias(i)
        for s, i in indicators.items()])
    return _rows(wide, period, names, list(indicators.values()))


def streaks(facts: DataFrame, ts: str | Column, period: str, dims, entity: str, indicators: dict[int, str], sets=None) -> DataFrame:
    """Entities that are active for at least k periods in a row, this one included (k -> indicator).

    Rows in a row are found by what period follows which, not by days, as a bi-week may last one week. An
    entity's place among its active periods less its place where the run began is the run's length."""
    cycles.check_cycle(period)
    dims = _dims(dims)
    names, sets = list(dims), _sets(list(dims), sets)
    each = _expand(_active(facts, ts, period, dims, entity), names, sets, ["__entity"], _named([F.lit(1)])).drop("__a0")
    own = Window.partitionBy(*names, "__entity").orderBy(PERIOD)
    runs = (each.withColumn("__place", F.row_number().over(own))
            .withColumn("__begins", ~F.coalesce(cycles.following_start(F.lag(PERIOD).over(own), period) == F.col(PERIOD), F.lit(False)))
            .withColumn("__length", F.col("__place") + 1 - F.max(F.when(F.col("__begins"), F.col("__place"))).over(
                own.rowsBetween(Window.unboundedPreceding, 0))))
    wide = runs.groupBy(PERIOD, *names).agg(*[F.sum((F.col("__length") >= k).cast("int")).cast(VALUE_TYPE).alias(i)
                                              for k, i in indicators.items()])
    return _rows(wide, period, names, list(indicators.values()))
