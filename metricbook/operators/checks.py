"""Data-quality checks. Each returns the failing rows: an empty frame means pass.

All checks are distributed DataFrame jobs (filters, grouped counts,
left-anti joins); ``run_checks`` folds their failure counts into one small
result frame, with one scan for all row-level checks of a table.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from metricbook.functions import cycles, dims as D


def not_null(df: DataFrame, column: str) -> DataFrame:
    return df.filter(F.col(column).isNull())


def unique(df: DataFrame, column: str) -> DataFrame:
    """Values occurring more than once (NULLs ignored): ``unique_field, n_records``."""
    return (df.where(F.col(column).isNotNull()).groupBy(F.col(column).alias("unique_field"))
            .agg(F.count(F.lit(1)).alias("n_records")).where(F.col("n_records") > 1))


def accepted_values(df: DataFrame, column: str, values: list[str]) -> DataFrame:
    """Values outside the list (NULL passes): ``value_field, n_records``."""
    return (df.where(F.col(column).isNotNull() & ~F.col(column).cast("string").isin(*values))
            .groupBy(F.col(column).cast("string").alias("value_field"))
            .agg(F.count(F.lit(1)).alias("n_records")))


def unique_combination(df: DataFrame, columns: list[str]) -> DataFrame:
    """Key combinations occurring more than once: ``<columns>, n_records``."""
    return df.groupBy(*columns).agg(F.count(F.lit(1)).alias("n_records")).where(F.col("n_records") > 1)


def values_in_other(df: DataFrame, column: str, other: DataFrame, other_column: str) -> DataFrame:
    """Rows whose value has no match in ``other`` (NULL counts as no match): ``invalid_value``."""
    ref = other.select(F.col(other_column).alias("__v")).where(F.col("__v").isNotNull()).distinct()
    return (df.select(F.col(column).alias("invalid_value"))
            .join(ref, F.col("invalid_value") == F.col("__v"), "left_anti"))


def freshness(df: DataFrame, period: str, anchor, by: str = "keys") -> DataFrame:
    """Combinations with no row in the last complete ``period``.

    ``by="keys"``: (indicator, dimension key names), so one fresh value of a key
    hides the missing others; ``by="coordinates"``: (indicator, dimensions).
    """
    if by not in ("keys", "coordinates"):
        raise ValueError("by must be 'keys' or 'coordinates'")
    shape = (D.keys("dimensions") if by == "keys" else F.col("dimensions")).alias("dimensions")
    lc = cycles.last_complete(period, anchor)
    # one pass: a combination is stale if none of its rows is in the period
    fresh = ((F.col("cycle") == period) & (F.col("cycle_timestamp") == cycles.ntz(lc)))
    return (df.select("indicator", shape, fresh.alias("__fresh")).groupBy("indicator", "dimensions")
            .agg(F.max("__fresh").alias("__fresh")).where(~F.coalesce("__fresh", F.lit(False)))
            .drop("__fresh"))


def json_key_accepted_values(df: DataFrame, column: str, key: str, values: list[str] | None = None,
                             relation: DataFrame | None = None, relation_column: str | None = None) -> DataFrame:
    """Rows whose ``column:key`` is present and not accepted (static list and/or relation values).

    NULLs in the relation are dropped (a NULL would make NOT IN flag nothing);
    an empty accepted set fails every present value.
    """
    v = D.get_key(F.col(column), key)
    rows = df.withColumn("__k", v).where(F.col("__k").isNotNull())
    acc = None
    if relation is not None and relation_column is not None:
        acc = relation.select(F.col(relation_column).cast("string").alias("__a"))
    if values:
        lit_df = df.sparkSession.createDataFrame([(x,) for x in values], "__a string")
        acc = lit_df if acc is None else acc.unionByName(lit_df)
    if acc is None:
        return rows.drop("__k")
    acc = acc.where(F.col("__a").isNotNull()).distinct()
    return rows.join(acc, F.col("__k") == F.col("__a"), "left_anti").drop("__k")


@dataclass
class Check:
    """A named check: ``failing`` is a condition on the rows of ``table``, or ``rows`` builds the
    frame of failing rows."""

    name: str
    table: DataFrame | None = None
    failing: Column | None = None
    rows: Callable[[], DataFrame] | None = None
    severity: str = "error"  # "warn" or "error"
    enabled: bool = True


RESULT_SCHEMA = "check string, severity string, failures long, status string"


def run_checks(spark: SparkSession, checks: list[Check]) -> DataFrame:
    """One row per enabled check: ``check, severity, failures, status`` (pass / warn / fail).

    The row-level checks of one table are counted in one aggregation over it;
    the others add one count each.  Without an enabled check the result is empty.
    """
    live = [c for c in checks if c.enabled]
    if not live:
        return spark.createDataFrame([], RESULT_SCHEMA)
    parts = []
    by_table: dict[int, list[Check]] = {}
    for c in live:
        if c.rows is None:
            by_table.setdefault(id(c.table), []).append(c)
        else:
            parts.append(c.rows().agg(F.count(F.lit(1)).alias("failures"))
                         .select(F.lit(c.name).alias("check"), F.lit(c.severity).alias("severity"), "failures"))
    for group in by_table.values():
        counted = group[0].table.agg(*[F.count_if(c.failing).alias(f"__{i}") for i, c in enumerate(group)])
        parts.append(counted.select(F.inline(F.array(*[
            F.struct(F.lit(c.name).alias("check"), F.lit(c.severity).alias("severity"), F.col(f"__{i}").alias("failures"))
            for i, c in enumerate(group)]))))
    return _status(reduce(DataFrame.unionByName, parts))


#: Accepted values of well-known dimension keys, and of the cycle column.
ACCEPTED_DIMENSIONS = {"geo": ["US", "ROW"], "platform": ["iOS", "Android", "Web", "Other"],
                       "user_class": ["Premium", "Non-Premium", "PremiumPlus"]}


def repository_checks(repo: DataFrame, glossary: DataFrame, countries: DataFrame | None, anchor) -> list[Check]:
    """The checks that guard a KPI repository: keys, accepted values, glossary coverage, freshness."""
    def not_accepted(key: str, values: list[str]) -> Column:
        v = D.get_key("dimensions", key)
        return v.isNotNull() & ~v.isin(*values)

    coords = ["indicator", "dimensions", "cycle", "cycle_timestamp"]
    checks = [Check("indicator_in_glossary", rows=lambda: values_in_other(repo, "indicator", glossary, "indicator"))]
    checks += [Check(f"dimension_{k}_accepted", repo, not_accepted(k, v)) for k, v in ACCEPTED_DIMENSIONS.items()]
    if countries is not None:
        checks.append(Check("dimension_country_accepted", rows=lambda: json_key_accepted_values(
            repo, "dimensions", "country", ["XX"], countries, "alpha_2")))
    checks += [
        Check("cycle_timestamp_not_null", repo, F.col("cycle_timestamp").isNull()),
        Check("cycle_accepted", repo, F.col("cycle").isNotNull() & ~F.col("cycle").isin(*cycles.CYCLES)),
        Check("id_not_null", repo, F.col("id").isNull()),
        Check("id_unique", rows=lambda: unique(repo, "id")),
        Check("id_combination_unique", rows=lambda: unique_combination(repo, ["id"])),
        Check("coordinates_unique", rows=lambda: unique_combination(repo, coords)),
        Check("fresh_week", rows=lambda: freshness(repo, "week", anchor), severity="warn"),
        Check("fresh_month", rows=lambda: freshness(repo, "month", anchor))]
    return checks


def _status(out: DataFrame) -> DataFrame:
    return out.withColumn("status", F.when(F.col("failures") == 0, "pass")
                          .when(F.col("severity") == "warn", "warn").otherwise("fail"))


def repository_suite(repo: DataFrame, glossary: DataFrame, countries: DataFrame | None, anchor) -> DataFrame:
    """The result of ``run_checks`` over :func:`repository_checks`, from one evaluation of ``repo``.

    Each row is taken apart into what the checks group by (its id, coordinates, indicator with dimension keys,
    indicator, country) and one entry for the row-level conditions; a single grouped count over these entries,
    combined map-side, feeds all checks. What must occur in a reference is looked up on the grouped keys."""
    checks = repository_checks(repo, glossary, countries, anchor)
    row_level = [c for c in checks if c.rows is None]
    fresh = {f"fresh_{p}": (F.col("cycle") == p) & (F.col("cycle_timestamp") == cycles.ntz(cycles.last_complete(p, anchor)))
             for p in ("week", "month")}

    def entry(kind: str, key: Column) -> Column:
        flags = [(c.failing if kind == "row" else F.lit(False)).alias(c.name) for c in row_level]
        states = [(v if kind == "shape" else F.lit(False)).alias(k) for k, v in fresh.items()]
        return F.struct(F.lit(kind).alias("kind"), key.cast("string").alias("key"), *flags, *states)

    entries = [entry("row", F.lit(None)), entry("id", F.col("id")), entry("indicator", F.col("indicator")),
               entry("coordinates", F.to_json(F.struct("indicator", "dimensions", "cycle", "cycle_timestamp"))),
               entry("shape", F.to_json(F.struct("indicator", D.keys("dimensions").alias("keys"))))]
    if countries is not None:
        country = D.get_key("dimensions", "country")
        entries.append(F.when(country.isNotNull(), entry("country", country)))
    known = glossary.select(F.lit("indicator").alias("kind"), F.col("indicator").alias("key"))
    if countries is not None:
        known = known.unionByName(countries.select(F.lit("country").alias("kind"), F.col("alpha_2").cast("string").alias("key"))) \
            .unionByName(repo.sparkSession.createDataFrame([("country", "XX")], "kind string, key string"))
    known = known.where("key IS NOT NULL").distinct().withColumn("__known", F.lit(True))
    grouped = (repo.select(F.inline(F.filter(F.array(*entries), lambda x: x.isNotNull()))).groupBy("kind", "key")
               .agg(F.count("*").alias("n"), *[F.count_if(c.name).alias(c.name) for c in row_level],
                    *[F.max(F.coalesce(F.col(k), F.lit(False))).alias(k) for k in fresh])
               .join(known, ["kind", "key"], "left"))
    unknown = F.col("__known").isNull()
    failures = {c.name: F.sum(c.name) for c in row_level} | {
        "indicator_in_glossary": F.sum(F.when((F.col("kind") == "indicator") & unknown, F.col("n"))),
        "dimension_country_accepted": F.sum(F.when((F.col("kind") == "country") & unknown, F.col("n"))),
        "id_unique": F.count_if((F.col("kind") == "id") & (F.col("n") > 1) & F.col("key").isNotNull()),
        "id_combination_unique": F.count_if((F.col("kind") == "id") & (F.col("n") > 1)),
        "coordinates_unique": F.count_if((F.col("kind") == "coordinates") & (F.col("n") > 1))} | {
        k: F.count_if((F.col("kind") == "shape") & ~F.col(k)) for k in fresh}
    wide = grouped.agg(*[F.coalesce(failures[c.name], F.lit(0)).cast("long").alias(f"__{i}") for i, c in enumerate(checks)])
    return _status(wide.select(F.inline(F.array(*[
        F.struct(F.lit(c.name).alias("check"), F.lit(c.severity).alias("severity"), F.col(f"__{i}").alias("failures"))
        for i, c in enumerate(checks)]))))


def observed(df: DataFrame, checks: list[Check]) -> tuple[DataFrame, Callable[[], list[tuple[str, str, int, str]]]]:
    """``df``, and a function that gives the results (check, severity, failures, status) of its row-level
    ``checks`` once it has been written: they are counted while the rows pass by, without a second scan."""
    if any(c.rows is not None for c in checks):
        raise ValueError("only conditions on rows can be counted in passing")
    live = [c for c in checks if c.enabled]
    if not live:
        return df, list
    watch = Observation()
    out = df.observe(watch, *[F.count_if(F.coalesce(c.failing, F.lit(False))).alias(c.name) for c in live])

    def results() -> list[tuple[str, str, int, str]]:
        counts = watch.get
        return [(c.name, c.severity, counts[c.name], "pass" if not counts[c.name] else "warn" if c.severity == "warn" else "fail")
                for c in live]

    return out, results
