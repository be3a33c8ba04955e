"""Every registered query with an oracle equals DuckDB on the smallest test tables."""

import pytest

import __spark_entry__ as E
from oracle_harness import compare

from metricbook.plans import catalog

SF = "/root/testdata/sf0.001"
# Eigenvectors are no SQL; kpi_pca_spectrum checks them through figures without a sign.
NO_SQL = {"kpi_pca_week"}


def test_every_query_has_an_oracle():
    assert set(catalog.ORACLE) == set(catalog.QUERIES) - NO_SQL
    assert set(catalog.QUERIES) <= set(E.queries()) and set(catalog.ORACLE) <= set(E.oracle_sql())


@pytest.mark.parametrize("name", sorted(catalog.ORACLE))
def test_matches_duckdb(spark, name):
    r = compare(spark, name, SF, verbose=True)
    assert r["match"], r


def test_profile_of_the_whole_repository(spark):
    rows = catalog.QUERIES["table_profile_repository"](spark, SF).collect()
    keys = {r.column_name for r in rows if r.position is None}
    assert keys == {"dimensions:segment", "dimensions:status", "dimensions:returnflag", "dimensions:linestatus"}


def test_entry(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert "aop_value" in df.columns


def test_pca_components_are_centred(spark):
    from pyspark.sql import functions as F
    df = E.queries()["kpi_pca_week"](spark, SF)
    r = df.agg(F.count("*"), F.avg("pc1"), F.avg("pc2")).first()
    assert r[0] > 0 and abs(r[1]) < 1e-5 and abs(r[2]) < 1e-5
