"""Owner registry: who owns each KPI, from category rules joined to the glossary."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


# Owner rules by glossary category (effective 2025-01-01).
DEFAULT_RULES = [
    (dt.date(2025, 1, 1), "acquisition", "John Doe", "", "Jane Doe"),
    (dt.date(2025, 1, 1), "conversion", "Jose Sanchez", "", "Josephine Sanchez"),
    (dt.date(2025, 1, 1), "engagement", "Ivan Petrov", "", "Maria Petrova"),
]
RULE_SCHEMA = "effective_date date, category string, owner string, lead_analyst string, bi_pal string"


def owner_rules(spark: SparkSession, rules=None) -> DataFrame:
    return spark.createDataFrame(rules or DEFAULT_RULES, RULE_SCHEMA)


def kpi_owners(glossary: DataFrame, rules: DataFrame) -> DataFrame:
    """``effective_date, indicator, owner, lead_analyst, bi_pal`` for KPI indicators (distinct)."""
    kpis = glossary.where(F.col("is_kpi") == F.lit(True)).select("indicator", "category")
    return (kpis.join(rules, on="category", how="inner")
            .select("effective_date", "indicator", "owner", "lead_analyst", "bi_pal").distinct())
