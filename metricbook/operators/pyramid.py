"""KPI modules: facts -> period pyramid (grouping sets) -> long-form KPI rows.

A module turns a fact table into rows of the module contract
``indicator, dimensions, cycle, cycle_timestamp, value, id``: one row per
indicator, period and coordinate, where the coordinates are every subset of
the dimension columns (the "pyramid", a GROUPING SETS aggregation).

Scale notes
-----------
* Additive measures (count, sum, min, max) are first reduced to the finest
  grain ``(cycle_timestamp, all dims)`` - map-side partial aggregation, so a
  hot key costs one row per task - and only that reduced table is expanded
  into the 2^k grouping sets.  The Expand therefore multiplies grain rows,
  not fact rows.
* Distinct counts are not additive.  The facts are first grouped by
  ``(cycle_timestamp, all dims, value)``; that table, which also carries the
  additive partial sums, goes through the grouping-sets + distinct plan.  It
  shuffles on (set keys, value), so even the all-up coordinate of a period is
  spread over many tasks, facts are scanned once and never expanded.
* The incremental event window is a literal range on the timestamp column and
  reaches the Parquet scan as a pushed filter.
"""

from __future__ import annotations

import itertools
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from metricbook.config import RunConfig
from metricbook.functions import cycles, dims as D, keys

VALUE_TYPE = "decimal(18,4)"
ADDITIVE = ("count", "sum", "min", "max")


@dataclass(frozen=True)
class Measure:
    """One indicator of a module: ``kind`` in count / sum / min / max / count_distinct.

    ``where`` limits the facts that count for this measure alone."""

    indicator: str
    kind: str
    column: str | Column | None = None
    where: Column | None = None

    def __post_init__(self):
        if self.kind not in ADDITIVE + ("count_distinct",):
            raise ValueError(f"unknown measure kind {self.kind!r}")
        if self.kind != "count" and self.column is None:
            raise ValueError(f"measure {self.indicator} needs a column")


    @property
    def input(self) -> Column:
        """What one fact contributes: its value (1 for a count), NULL where it does not count."""
        value = F.lit(1) if self.kind == "count" else _as_col(self.column)
        return value if self.where is None else F.when(self.where, value)


def _as_col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def all_subsets(names: list[str]) -> list[tuple[str, ...]]:
    """Every subset of the dimension names (the full cube), smallest first."""
    return [s for r in range(len(names) + 1) for s in itertools.combinations(names, r)]


def pyramid(facts: DataFrame, ts: str | Column, period: str, dims: dict[str, str | Column] | list[str],
            measures: list[Measure], sets: list[tuple[str, ...]] | None = None,
            cfg: RunConfig | None = None, null_token: str | None = "unknown") -> DataFrame:
    """Wide pyramid: ``cycle, cycle_timestamp, <dims>, <one column per indicator>``.

    Rolled-up dimensions are NULL.  Real NULLs in dimension columns would be
    indistinguishable from subtotals, so they are replaced by ``null_token``
    (pass ``None`` to keep them and accept the ambiguity).
    """
    cycles.check_cycle(period)
    if isinstance(dims, (list, tuple)):
        dims = {d: d for d in dims}
    names = list(dims)
    sets = [tuple(s) for s in (sets if sets is not None else all_subsets(names))]
    for s in sets:
        unknown = set(s) - set(names)
        if unknown:
            raise ValueError(f"grouping set {s} uses unknown dimensions {unknown}")

    parts = _pyramid_parts(facts, ts, period, dims, measures, sets, cfg, null_token)
    out = parts[0][0]
    for p, _ in parts[1:]:
        out = _merge(out, p, names)
    return out.select(F.lit(period).alias("cycle"), "cycle_timestamp", *names,
                      *[m.indicator for m in measures])


def placed(facts: DataFrame, ts: str | Column, period: str, dims: dict[str, str | Column], inputs: list[Column],
           cfg: RunConfig | None = None, null_token: str | None = "unknown", only: list | None = None) -> DataFrame:
    """Facts of the run's periods as ``cycle_timestamp``, the dimensions as text, and ``inputs``."""
    start = cycles.period_start(ts, period)
    if cfg is not None and cfg.incremental and only is None:
        facts = facts.filter(cycles.in_last_complete(ts, period, cfg.anchor_date, cfg.strict_biweek))
    if only is not None:
        facts = facts.filter(cycles.in_periods(ts, period, only) & start.isin(*[cycles.ntz(s) for s in only]))
    dim_cols = []
    for k, c in dims.items():
        c = _as_col(c).cast("string")
        dim_cols.append((F.coalesce(c, F.lit(null_token)) if null_token is not None else c).alias(k))
    return facts.select(start.alias("cycle_timestamp"), *dim_cols, *inputs)


def _pyramid_parts(facts, ts, period, dims, measures, sets, cfg, null_token, only=None):
    names = list(dims)
    base = placed(facts, ts, period, dims, [m.input.alias(f"__in_{i}") for i, m in enumerate(measures)], cfg, null_token, only)

    additive = [(i, m) for i, m in enumerate(measures) if m.kind in ADDITIVE]
    distinct = [(i, m) for i, m in enumerate(measures) if m.kind == "count_distinct"]
    parts = []
    if additive or not distinct:
        # With a distinct count the additive measures ride on its table: one pass over the facts.
        parts.append((_grain_pyramid(base, names, sets, additive, distinct[:1]),
                      [m.indicator for _, m in additive + distinct[:1]]))
        distinct = distinct[1:]
    for d in distinct:
        parts.append((_grain_pyramid(base, names, sets, [], [d]), [d[1].indicator]))
    return parts


def _merge(a: DataFrame, b: DataFrame, names: list[str]) -> DataFrame:
    # Both sides have one row per (grouping set, period, coordinate); the set id
    # keeps subtotal NULLs apart from each other in the join keys.
    keys_ = ["cycle_timestamp", "__gid"] + names
    cond = [a[k].eqNullSafe(b[k]) for k in keys_]
    return a.join(b, on=cond, how="full").select(
        *[F.coalesce(a[k], b[k]).alias(k) for k in keys_],
        *[a[c] for c in a.columns if c not in keys_], *[b[c] for c in b.columns if c not in keys_])


def _grouping_sets(df: DataFrame, names: list[str], sets: list[tuple[str, ...]], aggs: list[Column]) -> DataFrame:
    gsets = [[F.col("cycle_timestamp")] + [F.col(n) for n in s] for s in sets]
    cols = [F.col("cycle_timestamp")] + [F.col(n) for n in names]
    return df.groupingSets(gsets, *cols).agg(*aggs, F.grouping_id().alias("__gid"))


def _grain_pyramid(base: DataFrame, names, sets, additive, distinct) -> DataFrame:
    """Grouping sets over the finest grain, which also holds the value of a distinct count (if any)."""
    # Stage 1: finest grain, map-side combined.
    partial = []
    for i, m in additive:
        c = F.col(f"__in_{i}")
        if m.kind == "count":
            partial.append(F.count(F.lit(1) if m.where is None else c).alias(f"__p_{i}"))
        elif m.kind == "sum":
            partial.append(F.sum(c.cast(VALUE_TYPE)).alias(f"__p_{i}"))
        else:
            partial.append(getattr(F, m.kind)(c.cast(VALUE_TYPE)).alias(f"__p_{i}"))
    values = [f"__in_{i}" for i, _ in distinct]
    fine = base.groupBy("cycle_timestamp", *names, *values)
    grain = fine.agg(*partial) if partial else base.select("cycle_timestamp", *names, *values).distinct()
    # Stage 2: expand the (much smaller) grain table into the grouping sets.
    combine = []
    for i, m in additive:
        p = F.col(f"__p_{i}")
        f = {"count": F.sum, "sum": F.sum, "min": F.min, "max": F.max}[m.kind]
        combine.append(f(p).cast(VALUE_TYPE).alias(m.indicator))
    combine += [F.count_distinct(F.col(f"__in_{i}")).cast(VALUE_TYPE).alias(m.indicator) for i, m in distinct]
    return _grouping_sets(grain, names, sets, combine)


def to_module(wide: DataFrame, dims: list[str], indicators: list[str]) -> DataFrame:
    """Unpivot a wide pyramid to the module contract and add the surrogate key."""
    long = wide.unpivot(["cycle", "cycle_timestamp", *dims], indicators, "indicator", "value")
    long = long.select("indicator", D.from_columns(dims).alias("dimensions", metadata=D.CANONICAL), "cycle",
                       "cycle_timestamp", F.col("value").cast(VALUE_TYPE).alias("value"))
    return long.withColumn("id", keys.surrogate_key(long, "indicator", "dimensions", "cycle", "cycle_timestamp"))


def kpi_module(facts: DataFrame, ts: str | Column, period: str, dims: dict[str, str | Column] | list[str],
               measures: list[Measure], cfg: RunConfig | None = None,
               sets: list[tuple[str, ...]] | None = None, null_token: str | None = "unknown",
               only: list | None = None) -> DataFrame:
    """Facts -> KPI module rows (indicator, dimensions, cycle, cycle_timestamp, value, id).

    With an incremental ``cfg`` only events of the last complete period are
    read (half-open window), so a run never emits a partial period.  ``only``
    (period starts, see :func:`cycles.needed_starts`) reads those periods
    instead: what an incremental report or time series compares with.
    """
    if isinstance(dims, (list, tuple)):
        dims = {d: d for d in dims}
    cycles.check_cycle(period)
    names = list(dims)
    sets = [tuple(s) for s in (sets if sets is not None else all_subsets(names))]
    out = None
    for wide, indicators in _pyramid_parts(facts, ts, period, dims, measures, sets, cfg, null_token, only):
        wide = wide.withColumn("cycle", F.lit(period))
        part = to_module(wide, names, indicators)
        out = part if out is None else out.unionByName(part)
    return out
