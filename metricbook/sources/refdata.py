"""Reference (seed) tables: typed CSV loads, optional tables, empty typed frames.

Header-only seed files keep their declared types because every load passes an
explicit schema; nothing is inferred.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from metricbook.functions import dims

_S, _TS = T.StringType(), T.TimestampNTZType()

SCHEMAS: dict[str, T.StructType] = {
    "aop_targets": T.StructType([
        T.StructField("cycle_timestamp", _TS), T.StructField("plan", T.DecimalType(18, 8)),
        T.StructField("indicator", _S), T.StructField("dimensions", _S), T.StructField("cycle", _S)]),
    "repository_shadow": T.StructType([
        T.StructField("indicator", _S), T.StructField("dimensions", _S),
        T.StructField("cycle_timestamp", _TS), T.StructField("cycle", _S),
        T.StructField("value", T.DecimalType(18, 8)), T.StructField("id", _S)]),
    "business_glossary": T.StructType([
        T.StructField("indicator", _S), T.StructField("readable_indicator", _S),
        T.StructField("business_meaning", _S), T.StructField("methodology", _S),
        T.StructField("is_core4", T.BooleanType()), T.StructField("is_kpi", T.BooleanType()),
        T.StructField("category", _S)]),
    "countries": T.StructType([T.StructField(n, _S) for n in ("alpha_2", "alpha_3", "flag", "name")]),
    "country_regions": T.StructType([T.StructField("country_code", _S), T.StructField("region", _S)]),
    "country_holidays": T.StructType([
        T.StructField("country", _S), T.StructField("date", T.DateType()), T.StructField("holiday", _S)]),
    "societal_generations": T.StructType([
        T.StructField("generation", _S), T.StructField("from_year", T.IntegerType()),
        T.StructField("upto_year", T.IntegerType())]),
}

KPI_MODULE = T.StructType([
    T.StructField("indicator", _S), T.StructField("dimensions", _S), T.StructField("cycle", _S),
    T.StructField("cycle_timestamp", _TS), T.StructField("value", T.DecimalType(18, 4)),
    T.StructField("id", _S)])

REPOSITORY = T.StructType([T.StructField("_source_relation", _S)] + KPI_MODULE.fields)


def read_reference(spark: SparkSession, name: str, path: str) -> DataFrame:
    """Load one seed CSV with its declared types.

    Codes such as ``NA`` (Namibia) stay text; only empty fields become NULL.
    A doubled quote inside a quoted field is a quote, so JSON dimensions load as
    they are.  The header must name the declared columns in their order; a file
    with others fails instead of loading swapped columns.
    """
    df = (spark.read.schema(SCHEMAS[name]).option("header", True).option("mode", "FAILFAST")
          .option("nullValue", "").option("emptyValue", "").option("multiLine", True)
          .option("quote", '"').option("escape", '"').option("enforceSchema", False)
          .option("encoding", "UTF-8").csv(path))
    if "dimensions" in df.columns:
        df = df.withColumn("dimensions", dims.canonical("dimensions"))
    return df


def empty(spark: SparkSession, schema: T.StructType) -> DataFrame:
    """Zero rows with the right schema."""
    return spark.createDataFrame([], schema)


def optional_table(spark: SparkSession, name: str) -> DataFrame | None:
    """A catalog table if it exists, else None (plan and shadow are optional)."""
    return spark.table(name) if spark.catalog.tableExists(name) else None
