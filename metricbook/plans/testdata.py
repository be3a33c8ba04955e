"""KPI modules over the TPC-H-like test tables, plus the small seed tables they use.

These are the consumer-side models: each one reads the fact tables with only
the columns it needs and hands them to :func:`kpi_module`.
"""

from __future__ import annotations

import datetime as dt
import hashlib
from decimal import Decimal

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from metricbook.config import RunConfig
from metricbook.operators.pyramid import Measure, kpi_module
from metricbook.sources.refdata import SCHEMAS
from metricbook.sources.tables import read_table

# Fixed run parameters of the test queries.
ANCHOR = dt.date(2001, 6, 15)
SPINE_START = dt.date(1995, 1, 1)
AS_OF = dt.date(2001, 8, 2)

# Seed: business glossary for the test modules (ACTIVE_USERS has no readable name
# on purpose: display names fall back to the indicator).
GLOSSARY_ROWS = [
    ("ORDERS", "Orders", "Orders placed", "count of orders", True, True, "acquisition"),
    ("REVENUE", "Revenue", "Gross order value", "sum of order total price", True, True, "conversion"),
    ("UNITS", "Units shipped", "Quantity shipped", "sum of line quantity", False, True, "engagement"),
    ("NET_REVENUE", "Net revenue", "Value after discount", "sum of price x (1 - discount)", True, True, "conversion"),
    ("EVENTS", "Events", "Tracked events", "count of events", False, False, "engagement"),
    ("EVENT_VALUE", "Event value", "Value carried by events", "sum of event value", False, True, "engagement"),
    ("ACTIVE_USERS", None, "Distinct active users", "count of distinct users", False, True, "retention"),
]


def glossary(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(GLOSSARY_ROWS, SCHEMAS["business_glossary"])


def cfg(period: str, backfill: bool = True, **kw) -> RunConfig:
    return RunConfig(reporting_period=period, anchor_date=ANCHOR, backfill=backfill,
                     spine_start=SPINE_START, as_of=AS_OF, **kw)


def orders_facts(spark: SparkSession, base: str) -> DataFrame:
    orders = read_table(spark, base, "orders", ["o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate"])
    customer = read_table(spark, base, "customer", ["c_custkey", "c_mktsegment"])
    return orders.join(customer, orders.o_custkey == customer.c_custkey, "left")


def orders_module(spark: SparkSession, base: str, period: str, run: RunConfig | None = None, only=None) -> DataFrame:
    """ORDERS and REVENUE by market segment and order status."""
    return kpi_module(orders_facts(spark, base), "o_orderdate", period,
                      {"segment": "c_mktsegment", "status": "o_orderstatus"},
                      [Measure("ORDERS", "count"), Measure("REVENUE", "sum", "o_totalprice")], cfg=run, only=only)


def orders_geo_module(spark: SparkSession, base: str, period: str, run: RunConfig | None = None, only=None) -> DataFrame:
    """ORDERS and REVENUE by geo (AMERICA -> US, else ROW) and market segment."""
    orders = read_table(spark, base, "orders", ["o_custkey", "o_totalprice", "o_orderdate"])
    customer = read_table(spark, base, "customer", ["c_custkey", "c_nationkey", "c_mktsegment"])
    nation = read_table(spark, base, "nation", ["n_nationkey", "n_regionkey"])
    region = read_table(spark, base, "region", ["r_regionkey", "r_name"])
    geo = (nation.join(region, nation.n_regionkey == region.r_regionkey)
           .select("n_nationkey", F.when(F.col("r_name") == "AMERICA", "US").otherwise("ROW").alias("geo")))
    cust = customer.join(geo, customer.c_nationkey == geo.n_nationkey, "left")
    facts = orders.join(cust, orders.o_custkey == cust.c_custkey, "left")
    return kpi_module(facts, "o_orderdate", period, {"geo": "geo", "segment": "c_mktsegment"},
                      [Measure("ORDERS", "count"), Measure("REVENUE", "sum", "o_totalprice")], cfg=run, only=only)


def lineitem_module(spark: SparkSession, base: str, period: str, run: RunConfig | None = None, only=None) -> DataFrame:
    """UNITS and NET_REVENUE by return flag and line status, on ship date."""
    li = read_table(spark, base, "lineitem",
                    ["l_quantity", "l_extendedprice", "l_discount", "l_returnflag", "l_linestatus", "l_shipdate"])
    net = (F.col("l_extendedprice").cast("decimal(18,4)")
           * (F.lit(1) - F.col("l_discount").cast("decimal(18,4)"))).cast("decimal(18,4)")
    return kpi_module(li, "l_shipdate", period, {"returnflag": "l_returnflag", "linestatus": "l_linestatus"},
                      [Measure("UNITS", "sum", "l_quantity"), Measure("NET_REVENUE", "sum", net)], cfg=run, only=only)


def events_module(spark: SparkSession, base: str, period: str, run: RunConfig | None = None, only=None) -> DataFrame:
    """EVENTS, EVENT_VALUE and ACTIVE_USERS by event type."""
    ev = read_table(spark, base, "events", ["ts", "user_id", "event_type", "value"])
    return kpi_module(ev, "ts", period, {"event_type": "event_type"},
                      [Measure("EVENTS", "count"), Measure("EVENT_VALUE", "sum", "value"),
                       Measure("ACTIVE_USERS", "count_distinct", "user_id")], cfg=run, only=only)


def _sk(*parts) -> str:
    return hashlib.md5("-".join(parts).encode()).hexdigest()


# Seed: manual overrides for the weekly orders + lineitem repository.
#  1. by id: takes the id of REVENUE {} 1998-01-05 but states other coordinates;
#  2. by coordinates: ORDERS {segment BUILDING, status F} 1999-03-01 under a new id,
#     with its keys in another order and with spaces (canonicalised on load);
#  3. no match: a new row.
SHADOW_BY_ID = [("REVENUE_ADJUSTED", "{}", dt.datetime(1998, 1, 5), "week", Decimal("12345.6789"),
                 _sk("REVENUE", "{}", "week", "1998-01-05 00:00:00"))]
SHADOW_BY_COORDS = [("ORDERS", '{"status": "F", "segment": "BUILDING"}', dt.datetime(1999, 3, 1), "week",
                     Decimal("42.0000"), "override-0002")]
SHADOW_NEW = [("UNITS", '{"returnflag": "X"}', dt.datetime(2000, 1, 3), "week", Decimal("1.5"), "override-0003")]


def shadow(spark: SparkSession, rows) -> DataFrame:
    return spark.createDataFrame(rows, SCHEMAS["repository_shadow"])


def modules(spark: SparkSession, base: str, period: str = "week", only=None) -> dict[str, DataFrame]:
    return {"orders_module": orders_module(spark, base, period, only=only),
            "lineitem_module": lineitem_module(spark, base, period, only=only)}


def repository(spark: SparkSession, base: str, period: str, shadow_rows=None, run: RunConfig | None = None, only=None):
    """Repository of the two modules; ``only`` limits the events read to those periods."""
    from metricbook.operators.repository import build_repository
    sh = shadow(spark, shadow_rows) if shadow_rows else None
    return build_repository(spark, modules(spark, base, period, only), sh, run)


def aop_from(repo: DataFrame) -> DataFrame:
    """Plan targets derived from the data: 1.05 x REVENUE for every period and coordinate.

    Any value of a module (14 digits before the point) has its plan, so they are wider than a seed's."""
    return repo.where(F.col("indicator") == "REVENUE").select(
        "cycle_timestamp", (F.col("value") * F.lit(Decimal("1.05"))).cast("decimal(28,8)").alias("plan"),
        "indicator", "dimensions", "cycle")
