"""Downstream jobs over the report: year-over-year pivot and region roll-up."""

from __future__ import annotations

from dataclasses import dataclass

import datetime as dt

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from metricbook.config import RunConfig
from metricbook.functions import cycles, dims as D


def yoy_pivot(report: DataFrame, cfg: RunConfig, periods: int = 4) -> DataFrame:
    """Board table: one row per metric coordinate, the last ``periods`` complete periods wide.

    ``value_wK`` is the value K periods before the last complete one, ``yoy_wK``
    its year-over-year change (current / prior - 1, 6 digits).
    """
    p = cfg.reporting_period
    lc = cfg.last_complete
    starts = [cycles.shift(lc, p, -k) for k in range(periods)]
    k = None
    for i, s in enumerate(starts):
        cond = F.col("cycle_timestamp") == cycles.ntz(s)
        k = F.when(cond, F.lit(i)) if k is None else k.when(cond, F.lit(i))
    rep = (report.where((F.col("cycle") == p) & F.col("cycle_timestamp").isin(
        *[cycles.ntz(s) for s in starts])).withColumn("__k", k)
           .withColumn("__yoy", F.round(F.col("current_value").cast("double")
                                        / F.col("prior_value").cast("double") - 1.0, 6)))
    aggs = []
    for i in range(periods):
        aggs.append(F.max(F.when(F.col("__k") == i, F.col("current_value"))).alias(f"value_w{i}"))
        aggs.append(F.max(F.when(F.col("__k") == i, F.col("__yoy"))).alias(f"yoy_w{i}"))
    return rep.groupBy("indicator", "dimensions", "metric", "coordinates").agg(*aggs)


def region_rollup(module: DataFrame, mapping: DataFrame, key: str = "country",
                  code_col: str = "country_code", region_col: str = "region") -> DataFrame:
    """Sum KPI rows whose only dimension is ``key`` up to regions (broadcast mapping, size-checked)."""
    m = mapping.select(F.col(code_col).alias("__code"), F.col(region_col).alias("region"))
    rows = module.where(F.size(D.keys("dimensions")) == 1).withColumn("__code", D.get_key("dimensions", key)) \
        .where(F.col("__code").isNotNull())
    return (rows.join(m, on="__code", how="inner")
            .groupBy("indicator", "cycle", "cycle_timestamp", "region")
            .agg(F.sum("value").cast("decimal(18,4)").alias("value")))


def top_movers(report: DataFrame, cfg: RunConfig, k: int = 5) -> DataFrame:
    """Largest year-over-year moves of the last complete period, ``k`` per indicator, with a sentence.

    ``row_number() <= k`` is planned as a WindowGroupLimit, which keeps only
    the top ``k`` per indicator inside each task before the shuffle, so a hot
    indicator never lands whole in one task.
    """
    lc = cycles.ntz(cfg.last_complete)
    rows = (report.where((F.col("cycle") == cfg.reporting_period) & (F.col("cycle_timestamp") == lc)
                         & F.col("prior_value").isNotNull() & (F.col("prior_value") != 0))
            .withColumn("delta", F.col("current_value").cast("double") / F.col("prior_value").cast("double") - 1.0))
    w = Window.partitionBy("indicator").orderBy(F.abs("delta").desc(), F.col("dimensions").asc())
    top = rows.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)
    pct = F.round(F.abs(F.col("delta")) * 100, 1).cast("string")
    sentence = F.concat(F.col("metric_display_name"), F.lit(" "),
                        F.when(F.col("delta") >= 0, F.lit("up")).otherwise(F.lit("down")),
                        F.lit(" "), pct, F.lit("% vs the same period last year"))
    return top.select("indicator", "dimensions", "cycle_timestamp", F.col("rank").cast("long").alias("rank"),
                      "current_value", "prior_value",
                      F.round("delta", 6).alias("delta"), sentence.alias("sentence"))


def alert_sentences(bands: DataFrame, cfg: RunConfig) -> DataFrame:
    """One sentence per series that is outside its band in the last complete period."""
    def amount(name: str):
        return F.format_number(F.col(name).cast("decimal(38,6)"), 2)

    rows = bands.where((F.col("cycle") == cfg.reporting_period) & F.col("in_alert")
                       & (F.col("cycle_timestamp") == cycles.ntz(cfg.last_complete)))
    low = F.col("alert") == "↓"
    sentence = F.concat(
        F.col("metric_display_name"), F.when(low, F.lit(" fell below ")).otherwise(F.lit(" rose above ")),
        F.lit("its usual range: "), amount("current_value"), F.lit(" against "), amount("lower_boundary"), F.lit(" to "),
        amount("upper_boundary"))
    return rows.select("indicator", "dimensions", "cycle_timestamp", "alert", sentence.alias("sentence"))


# Societal generations (name, first birth year, last birth year).
GENERATIONS = [
    ("Beta", 2025, 2039), ("Alpha", 2010, 2024), ("Gen Z", 1997, 2009), ("Millennials", 1981, 1996),
    ("Gen X", 1965, 1980), ("Boomers II", 1955, 1964), ("Boomers I", 1946, 1954), ("Post War", 1928, 1945),
    ("WWII", 1922, 1927),
]


def generation_years(spark, generations=None) -> DataFrame:
    """One row per birth year -> generation (at most a few hundred rows: a bounded broadcast)."""
    g = spark.createDataFrame(generations or GENERATIONS, "generation string, from_year int, upto_year int")
    return g.select("generation", F.explode(F.sequence("from_year", "upto_year")).alias("birth_year"))


def generation_cohort(df: DataFrame, birth_year_col: str, generations: DataFrame) -> DataFrame:
    """Add ``generation`` from a birth year: the range join becomes an equi-join on the exploded years."""
    years = generations
    return df.join(years, F.col(birth_year_col) == years.birth_year, "left").drop(years.birth_year)


def fixed_date_holidays(spark, country: str, rules: list[tuple[int, int, str]], first_year: int,
                        last_year: int) -> DataFrame:
    """Holiday table built from fixed-date rules over a range of years: ``country, date, holiday``."""
    rule_array = F.array(*[F.struct(F.lit(m).alias("m"), F.lit(d).alias("d"), F.lit(n).alias("holiday"))
                           for m, d, n in rules])
    years = spark.range(first_year, last_year + 1).select(F.col("id").cast("int").alias("y"),
                                                           F.explode(rule_array).alias("r"))
    return years.select(F.lit(country).alias("country"), F.make_date("y", "r.m", "r.d").alias("date"),
                        F.col("r.holiday").alias("holiday"))


WEEKDAYS = ("Mon", "Tue", "Wed", "Thu", "Fri", "Sat", "Sun")


@dataclass(frozen=True)
class HolidayRule:
    """When a holiday is, in every year: a fixed ``month`` and ``day``; the ``nth`` ``weekday`` of a month (-1: the last);
    or Easter Sunday (neither). ``offset`` days are added, and the result is never before ``not_before`` (month, day)."""

    country: str
    holiday: str
    month: int | None = None
    day: int | None = None
    nth: int | None = None
    weekday: str | None = None
    offset: int = 0
    not_before: tuple[int, int] | None = None

    def __post_init__(self):
        if self.nth is not None and (self.month is None or self.weekday not in WEEKDAYS or self.nth not in (-1, 1, 2, 3, 4)):
            raise ValueError(f"{self.holiday}: the nth weekday needs a month, a weekday of {WEEKDAYS} and -1 or 1 to 4")
        if self.nth is None and (self.month is None) != (self.day is None):
            raise ValueError(f"{self.holiday}: a fixed date needs month and day")

    def date(self, year: Column) -> Column:
        if self.nth is not None:
            first = F.make_date(year, F.lit(self.month), F.lit(1))
            # The first such weekday after the day before the month, or after the eighth day from its end.
            found = (F.date_add(F.next_day(F.date_sub(first, 1), self.weekday), 7 * (self.nth - 1)) if self.nth > 0
                     else F.next_day(F.date_sub(F.last_day(first), 7), self.weekday))
        else:
            found = easter_sunday(year) if self.month is None else F.make_date(year, F.lit(self.month), F.lit(self.day))
        found = F.date_add(found, self.offset)
        if self.not_before is not None:
            found = F.greatest(found, F.make_date(year, *map(F.lit, self.not_before)))
        return found


def easter_sunday(year: Column) -> Column:
    """Easter Sunday of the Gregorian calendar: the Sunday after the first full moon (by the church's table) from
    21 March on. ``moon``: days from 21 March to that full moon, from the year's place in the 19-year moon cycle
    and the leap days and moon corrections of its century."""
    golden, century = year % 19, F.floor(year / 100).cast("int")
    skipped = century - F.floor(century / 4).cast("int")
    corrected = F.floor((8 * century + 13) / 25).cast("int")
    raw = F.pmod(19 * golden + skipped - corrected + 15, F.lit(30))
    moon = raw - F.when((raw == 29) | ((raw == 28) & (golden > 10)), 1).otherwise(0)
    return F.next_day(F.date_add(F.make_date(year, F.lit(3), F.lit(21)), moon.cast("int")), "Sun")


def holidays_by_rule(spark, rules: list[HolidayRule], first_year: int, last_year: int) -> DataFrame:
    """``country, date, holiday`` of every rule and year: one row each, computed from a range of years."""
    years = spark.range(first_year, last_year + 1).select(F.col("id").cast("int").alias("y"))
    return years.select(F.inline(F.array(*[F.struct(F.lit(r.country).alias("country"), r.date(F.col("y")).alias("date"),
                                                    F.lit(r.holiday).alias("holiday")) for r in rules])))


def holiday_flag(daily: DataFrame, holidays: DataFrame, default_country: str | None = None,
                 key: str = "country") -> DataFrame:
    """Flag daily KPI rows falling on a holiday of their ``country`` dimension (or a default country)."""
    h = holidays.groupBy("country", "date").agg(
        F.array_join(F.array_sort(F.collect_set("holiday")), ", ").alias("holiday"))
    c = D.get_key("dimensions", key)
    if default_country is not None:
        c = F.coalesce(c, F.lit(default_country))
    rows = daily.withColumn("__c", c).withColumn("__d", F.to_date("cycle_timestamp"))
    out = rows.join(h, (rows.__c == h.country) & (rows.__d == h.date), "left")
    return out.select(*daily.columns, h.holiday.isNotNull().alias("is_holiday"), h.holiday)
