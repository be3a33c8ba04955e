"""The KPI repository: union of modules plus audited manual overrides (shadow).

Override rule: a module row is replaced when a shadow row has the same ``id``
*or* the same coordinates (indicator, dimensions, cycle, cycle_timestamp).
The OR is split into two left-anti equi-joins (NOT(a OR b) = NOT a AND NOT b),
so Spark plans hash/broadcast anti-joins instead of a nested-loop join.  No
size is counted beforehand: AQE chooses from the bytes it measures.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from metricbook.config import RunConfig
from metricbook.functions import cycles, dims as D
from metricbook.sources.refdata import REPOSITORY

REQUIRED = ("indicator", "dimensions", "cycle", "cycle_timestamp", "value", "id")
COORDS = ["indicator", "dimensions", "cycle", "cycle_timestamp"]
VALUE_TYPE = "decimal(18,4)"


class ModuleContractError(ValueError):
    pass


def validate_module(name: str, df) -> DataFrame:
    """Check the module contract (six columns, any case) and project it typed and canonical."""
    if not isinstance(df, DataFrame):
        raise ModuleContractError(f"module {name!r}: expected a DataFrame, got {type(df).__name__}")
    by_lower = {c.lower(): c for c in df.columns}
    missing = [c for c in REQUIRED if c not in by_lower]
    if missing:
        raise ModuleContractError(
            f"module {name!r} lacks {', '.join(missing)} of the contract columns {', '.join(REQUIRED)}")
    field = df.schema[by_lower["dimensions"]]
    return df.select(
        F.lit(name).alias("_source_relation"),
        F.col(by_lower["indicator"]).cast("string").alias("indicator"),
        D.canonical_any(F.col(by_lower["dimensions"]), field).alias("dimensions", metadata=D.CANONICAL),
        F.col(by_lower["cycle"]).cast("string").alias("cycle"),
        F.col(by_lower["cycle_timestamp"]).cast("timestamp_ntz").alias("cycle_timestamp"),
        F.col(by_lower["value"]).cast(VALUE_TYPE).alias("value"),
        F.col(by_lower["id"]).cast("string").alias("id"))


def shadow_rows(shadow: DataFrame, name: str = "repository_shadow") -> DataFrame:
    field = shadow.schema["dimensions"]
    return shadow.select(
        F.lit(name).alias("_source_relation"), F.col("indicator").cast("string").alias("indicator"),
        D.canonical_any(F.col("dimensions"), field).alias("dimensions", metadata=D.CANONICAL),
        F.col("cycle").cast("string").alias("cycle"),
        F.col("cycle_timestamp").cast("timestamp_ntz").alias("cycle_timestamp"),
        F.col("value").cast(VALUE_TYPE).alias("value"), F.col("id").cast("string").alias("id"))


def only_last_complete(df: DataFrame, cfg: RunConfig) -> DataFrame:
    """rows of the last complete reporting period (literal filter, pushes down)."""
    return df.filter((F.col("cycle") == cfg.reporting_period)
                     & (F.col("cycle_timestamp") == cycles.ntz(cfg.last_complete)))


def build_repository(spark: SparkSession, modules: dict[str, DataFrame] | None,
                     shadow: DataFrame | None = None, cfg: RunConfig | None = None,
                     shadow_name: str = "repository_shadow") -> DataFrame:
    """Consolidate modules and overrides into the repository table.

    * modules only: UNION ALL of the modules (duplicates are kept);
    * shadow present: shadow rows UNION (distinct) the surviving module rows;
    * neither: an empty, correctly typed frame.
    An incremental ``cfg`` keeps only the last complete period.
    """
    modules = modules or {}
    data = None
    for name, df in modules.items():
        v = validate_module(name, df)
        data = v if data is None else data.unionByName(v)
    if shadow is not None:
        sh = shadow_rows(shadow, shadow_name)
        if data is not None:
            by_id = sh.select("id").where(F.col("id").isNotNull()).distinct()
            by_coords = sh.select(*COORDS).distinct()
            survivors = (data.join(by_id, on="id", how="left_anti")
                         .join(by_coords, on=COORDS, how="left_anti"))
            out = sh.unionByName(survivors).distinct()
        else:
            out = sh
    elif data is not None:
        out = data
    else:
        out = spark.createDataFrame([], REPOSITORY)
    out = out.select(*REPOSITORY.names)
    if cfg is not None and cfg.incremental:
        out = only_last_complete(out, cfg)
    return out
