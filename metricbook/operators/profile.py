"""Table profile with suggested checks (the data part of a schema-doc generator).

Column rows come from each DataFrame's schema; the keys found inside the
``dimensions`` objects are discovered from the data with a distributed
``explode`` + ``distinct``.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from metricbook.functions import dims as D

# Descriptions and suggested checks by column name.
DESCRIPTIONS = {
    "id": "Unique record identifier",
    "what": "Metric measurement (see business glossary for details)",
    "cycle": "Reporting time period",
    "cycle_timestamp": "Timestamp associated with the reporting time period start time",
    "dimensions": "Measurement dimensional coordinates",
}
VALUE_DESCRIPTION = "Metric measurement value observed at the reporting period."
CYCLE_VALUES = ["minute", "hour", "day", "week", "month", "year"]
ACCOUNT_VALUES = ["1100", "2500", "6815", "1405", "4002", "4000", "6800", "4001", "6801"]
KEY_VALUES = {
    "geo": ["US", "ROW"],
    "platform": ["iOS", "Android", "Web", "Other"],
    "user_class": ["Premium", "Non-Premium"],
    "country": ["XX"],
}
PROFILE_SCHEMA = ("table_name string, table_type string, position int, column_name string, data_type string, "
                  "description string, suggested_check string")


def _suggest(table: str, column: str) -> tuple[str, str | None]:
    """(description, suggested checks) of a column."""
    if column == "id":
        return DESCRIPTIONS["id"], "primary_key; unique_combination_of_columns(id)"
    if column == "cycle":
        return DESCRIPTIONS["cycle"], f"not_null; accepted_values({', '.join(CYCLE_VALUES)})"
    if column == "value" and table.startswith("kpi_"):
        return VALUE_DESCRIPTION, "not_null"
    if column == "gl_account_number":
        return "", f"not_null; accepted_values({', '.join(ACCOUNT_VALUES)})"
    if column in ("what", "cycle_timestamp", "dimensions"):
        return DESCRIPTIONS[column], "not_null"
    return "", None


def profile_tables(spark: SparkSession, tables: dict[str, DataFrame], table_type: str = "base table",
                   name_prefix: str = "", countries: DataFrame | None = None) -> DataFrame:
    """One row per column, in order, and one per dimension key found (position NULL).

    ``name_prefix`` keeps tables whose name begins with it, in any case.  The
    country key accepts the ``alpha_2`` codes of ``countries`` besides XX.  A
    table whose ``dimensions`` are no objects gets an error row in place of keys.
    """
    tables = {t.lower(): df for t, df in tables.items() if t.lower().startswith(name_prefix.lower())}
    return _profile(spark, {t: (df, table_type) for t, df in tables.items()}, countries)


def _profile(spark: SparkSession, tables: dict[str, tuple[DataFrame, str]], countries: DataFrame | None) -> DataFrame:
    rows = [(t, table_type, i, f.name.lower(), f.dataType.simpleString(), *_suggest(t, f.name.lower()))
            for t, (df, table_type) in sorted(tables.items(), key=lambda x: x[0]) for i, f in enumerate(df.schema.fields, 1)]
    out = spark.createDataFrame(rows, PROFILE_SCHEMA)
    for t, (df, table_type) in tables.items():
        fields = {f.name.lower(): f for f in df.schema.fields}
        if "dimensions" not in fields:
            continue
        if fields["dimensions"].dataType.simpleString().split("<")[0] not in ("string", "map", "struct", "variant"):
            out = out.unionByName(spark.createDataFrame([(
                t, table_type, None, "dimensions", None, "Error retrieving dimension keys: not an object", None)], PROFILE_SCHEMA))
            continue
        keys = (df.select(F.explode(D.keys(D.canonical_any(fields["dimensions"].name, fields["dimensions"]))).alias("k"))
                .distinct())
        accepted = F.create_map(*[x for k, v in KEY_VALUES.items() for x in (F.lit(k), F.lit(", ".join(v)))])[F.col("k")]
        if countries is not None:
            # a code list of a few hundred entries, as one sorted text
            codes = countries.agg(F.array_join(F.array_sort(F.collect_set("alpha_2")), ", ").alias("codes"))
            keys = keys.join(codes.select(F.lit("country").alias("k"), "codes"), "k", "left")
            accepted = F.concat_ws(", ", accepted, F.col("codes"))
        known = F.col("k").isin(*KEY_VALUES)
        out = out.unionByName(keys.select(
            F.lit(t).alias("table_name"), F.lit(table_type).alias("table_type"), F.lit(None).cast("int").alias("position"),
            F.concat(F.lit("dimensions:"), "k").alias("column_name"), F.lit("string").alias("data_type"),
            F.concat(F.lit("dimension key "), "k").alias("description"),
            F.when(known, F.concat(F.lit("json_key_accepted_values("), "k", F.lit(": "), accepted, F.lit(")")))
            .alias("suggested_check")))
    return out


def profile_catalog(spark: SparkSession, schema: str | None = None, name_prefix: str = "",
                    countries: DataFrame | None = None) -> DataFrame:
    """The profile of the tables and views that the session's catalog lists in ``schema`` (its current one by
    default, with temporary views), as :func:`profile_tables` gives it.

    Tables come from ``spark.catalog`` with their own type (base table, view, temporary view), columns in order.
    A table that cannot be read gives one row that says so; the others are not affected. The driver holds one
    entry per table and column, as the catalog does."""
    kinds = {"MANAGED": "base table", "EXTERNAL": "external table", "VIEW": "view", "TEMPORARY": "temporary view"}
    listed = spark.catalog.listTables(schema) if schema else spark.catalog.listTables()
    found, errors = {}, []
    for table in sorted(listed, key=lambda t: t.name.lower()):
        if not table.name.lower().startswith(name_prefix.lower()):
            continue
        parts = [table.name] if table.isTemporary else [*(table.namespace or []), table.name]
        kind = kinds.get(table.tableType, "base table")
        try:
            found[table.name.lower()] = (spark.table(".".join(f"`{p}`" for p in parts)), kind)
        except AnalysisException as e:
            errors.append((table.name.lower(), kind, None, None, None, f"Error reading the table: {e.getCondition() or 'unknown'}", None))
    out = _profile(spark, found, countries)
    return out.unionByName(spark.createDataFrame(errors, PROFILE_SCHEMA)) if errors else out
