"""All cycles of a module from one scan of its facts, and distinct counts that can be merged.

The calendar is a lattice: day -> week -> bi-week and day -> month -> quarter -> year. Facts are reduced once
to the day grain; every longer cycle is grouped from the one below it, never from the facts, and each cycle's
grain goes through its grouping sets. The branches share the shuffles of their grains (Spark reuses equal
exchanges), so a fact table is read once however many cycles are asked for.

Sums, counts, minima and maxima are carried as partial values. An exact distinct count is not the sum of the
counts of its days, so its values are carried; the grain then has a row per value. Where that is too much,
``sketch_days`` keeps one HyperLogLog state per day and coordinate, which can be stored, appended day by day
and merged up the same lattice with a relative standard error of 1.04 / sqrt(2 ** lg_k).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from metricbook.functions import cycles
from metricbook.operators.pyramid import ADDITIVE, VALUE_TYPE, Measure, _grouping_sets, all_subsets, placed, to_module

BELOW = {"week": "day", "bi-week": "week", "month": "day", "quarter": "month", "year": "quarter"}
PERIOD = "cycle_timestamp"
PARTIAL = "decimal(28,4)"
LG_K = 12


def _merge(kind: str):
    return {"count": F.sum, "sum": F.sum, "min": F.min, "max": F.max}[kind]


def _checked(periods) -> list[str]:
    out = list(periods)
    for p in out:
        cycles.check_cycle(p, cycles.CYCLES)
    return out


def _up(day: DataFrame, periods: list[str], keys: list[str], aggs: list[Column]) -> dict[str, DataFrame]:
    """The grain of each cycle asked for, each from the one below."""
    grains = {"day": day}

    def grain(period: str) -> DataFrame:
        if period not in grains:
            below = grain(BELOW[period]).withColumn(PERIOD, cycles.period_start(PERIOD, period)).groupBy(PERIOD, *keys)
            grains[period] = below.agg(*aggs) if aggs else below.agg(F.lit(1).alias("__one")).drop("__one")
        return grains[period]

    return {p: grain(p) for p in periods}


def one_distinct(measures: list[Measure]) -> list[int]:
    """Places of the distinct counts; the values of two in one grain would multiply."""
    found = [i for i, m in enumerate(measures) if m.kind not in ADDITIVE]
    if len(found) > 1:
        raise ValueError("one grain carries the values of one distinct count")
    return found


def partials(measures: list[Measure]) -> list[Column]:
    """Aggregates of the day grain, over facts that are ``placed`` with the inputs of ``measures``."""
    return [(F.count(f"__in_{i}") if m.kind == "count" else _merge(m.kind)(F.col(f"__in_{i}").cast(VALUE_TYPE)))
            .cast(PARTIAL).alias(f"__p_{i}") for i, m in enumerate(measures) if m.kind in ADDITIVE]


def inputs(measures: list[Measure]) -> list[Column]:
    return [m.input.alias(f"__in_{i}") for i, m in enumerate(measures)]


def modules_of_days(day: DataFrame, names: list[str], measures: list[Measure], periods=cycles.CYCLES,
                    sets: list[tuple[str, ...]] | None = None) -> DataFrame:
    """Module rows of every cycle from a day grain: (cycle_timestamp of the day, dimensions, the counted value of a
    distinct count, partial values). Its rows may come in several parts, as from separate runs."""
    sets = [tuple(s) for s in (sets if sets is not None else all_subsets(names))]
    distinct = one_distinct(measures)
    additive = [(i, m) for i, m in enumerate(measures) if m.kind in ADDITIVE]
    again = [_merge(m.kind)(f"__p_{i}").cast(PARTIAL).alias(f"__p_{i}") for i, m in additive]
    out = None
    for period, grain in _up(day, _checked(periods), names + [f"__in_{i}" for i in distinct], again).items():
        wide = _grouping_sets(grain, names, sets, [_merge(m.kind)(f"__p_{i}").cast(VALUE_TYPE).alias(m.indicator) for i, m in additive]
                              + [F.count_distinct(f"__in_{i}").cast(VALUE_TYPE).alias(measures[i].indicator) for i in distinct])
        rows = to_module(wide.withColumn("cycle", F.lit(period)), names, [m.indicator for m in measures])
        out = rows if out is None else out.unionByName(rows)
    return out


def all_cycles_module(facts: DataFrame, ts: str | Column, dims: dict[str, str | Column] | list[str], measures: list[Measure],
                      periods=cycles.CYCLES, sets: list[tuple[str, ...]] | None = None) -> DataFrame:
    """Module rows of every cycle in ``periods``; equal to the union of the modules of each."""
    dims = {d: d for d in dims} if isinstance(dims, (list, tuple)) else dict(dims)
    distinct = [m for m in measures if m.kind not in ADDITIVE]
    if len(distinct) > 1:  # each further one goes up the lattice by itself
        out = all_cycles_module(facts, ts, dims, [m for m in measures if m not in distinct[1:]], periods, sets)
        for m in distinct[1:]:
            out = out.unionByName(all_cycles_module(facts, ts, dims, [m], periods, sets))
        return out
    base = placed(facts, ts, "day", dims, inputs(measures))
    grain = base.groupBy(PERIOD, *dims, *[f"__in_{i}" for i in one_distinct(measures)])
    first = partials(measures)
    day = grain.agg(*first) if first else grain.agg(F.lit(1).alias("__one")).drop("__one")
    return modules_of_days(day, list(dims), measures, periods, sets)


def sketch_days(facts: DataFrame, ts: str | Column, dims: dict[str, str | Column], entity: str, lg_k: int = LG_K) -> DataFrame:
    """(cycle_timestamp of the day, dimensions, sketch): what to store, one row per day and finest coordinate."""
    return (placed(facts, ts, "day", dims, [F.col(entity).alias("__entity")]).where("__entity IS NOT NULL")
            .groupBy(PERIOD, *dims).agg(F.hll_sketch_agg("__entity", lg_k).alias("sketch")))


def sketch_module(days: DataFrame, dims: list[str], indicator: str, periods=cycles.CYCLES,
                  sets: list[tuple[str, ...]] | None = None) -> DataFrame:
    """Module rows of approximate distinct counts, from stored days."""
    sets = [tuple(s) for s in (sets if sets is not None else all_subsets(list(dims)))]
    out = None
    for period, grain in _up(days, _checked(periods), list(dims), [F.hll_union_agg("sketch").alias("sketch")]).items():
        wide = _grouping_sets(grain, list(dims), sets, [F.hll_sketch_estimate(F.hll_union_agg("sketch")).cast(VALUE_TYPE).alias(indicator)])
        rows = to_module(wide.withColumn("cycle", F.lit(period)), list(dims), [indicator])
        out = rows if out is None else out.unionByName(rows)
    return out
