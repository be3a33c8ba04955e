"""Sinks, checks in passing, catalog scan, nested dimensions, rules for holidays."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from metricbook.functions import dims as D
from metricbook.operators import checks as C
from metricbook.operators.insights import HolidayRule, easter_sunday, holidays_by_rule
from metricbook.operators.profile import profile_catalog
from metricbook.operators.repository import build_repository
from metricbook.plans import testdata as TD

SF = "/root/testdata/sf0.001"


def test_a_batch_of_one_period_is_evaluated_once_and_written_by_many(spark, tmp_path):
    from metricbook.sources.sink import upsert
    path, n = str(tmp_path / "t"), 40_000
    evaluated = spark.sparkContext.accumulator(0)

    @F.udf("string")
    def seen(x):
        evaluated.add(1)
        return f"{x}" * 5

    def batch(first):
        return spark.range(first, first + n, numPartitions=4).select(F.col("id").cast("string").alias("id"), seen("id").alias("v"), F.lit("p").alias("p"))

    old = spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "128k")
    try:
        for i, first in enumerate((0, n // 2)):
            upsert(batch(first), path, ["id"], ["p"], mode="merge", coordinates=["v"])
            assert evaluated.value == n * (i + 1)
            assert len(list((tmp_path / "t" / "p=p").glob("*.parquet"))) > 2
    finally:
        spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", old)
    got = spark.read.parquet(path)
    assert got.count() == got.select("id").distinct().count() == n + n // 2


def test_upserts_leave_no_staged_tables_and_may_trust_their_keys(spark, tmp_path):
    from pathlib import Path

    from metricbook.session import shared_folder
    from metricbook.sources.sink import DuplicateKeyError, upsert
    path, schema = str(tmp_path / "t"), "id string, v int, p string"
    before = set(Path(shared_folder(spark)).glob("upsert-*"))
    upsert(spark.createDataFrame([("1", 1, "a"), ("2", 2, "b")], schema), path, ["id"], ["p"])
    upsert(spark.createDataFrame([("1", 9, "a"), ("3", 3, "a")], schema), path, ["id"], ["p"], keys_hold_partition=True)
    with pytest.raises(DuplicateKeyError):
        upsert(spark.createDataFrame([("1", 9, "a"), ("1", 3, "a")], schema), path, ["id"], ["p"], mode="merge")
    assert sorted(map(tuple, spark.read.schema(schema).parquet(path).collect())) == [("1", 9, "a"), ("2", 2, "b"), ("3", 3, "a")]
    assert set(Path(shared_folder(spark)).glob("upsert-*")) == before


def _dirty(spark):
    rows = TD.orders_module(spark, SF, "week").where("cycle_timestamp >= timestamp_ntz'2001-05-01 00:00:00'")
    odd = [("ORDERS", '{"country":"XX","geo":"XX"}', "week", dt.datetime(2001, 6, 4), 1, "a"), ("NOBODY", '{"country":"QQ"}', "wek", None, 1, "a"),
           (None, '{"platform":"Web"}', None, dt.datetime(2001, 6, 4), 2, None), (None, '{"platform":"Web"}', None, dt.datetime(2001, 6, 4), 2, None),
           ("REVENUE", "{}", "month", dt.datetime(2001, 5, 1), 2, "b"), ("REVENUE", None, "month", dt.datetime(2001, 5, 1), 2, "c")]
    return build_repository(spark, {"m": rows, "odd": spark.createDataFrame(odd, "indicator string, dimensions string, cycle string, "
                                                                                 "cycle_timestamp timestamp_ntz, value int, id string")})


def test_suite_from_one_evaluation_equals_the_checks_by_themselves(spark):
    countries = spark.createDataFrame([("US",), (None,)], "alpha_2 string")
    repo = _dirty(spark)
    for reference in (countries, None):
        want = C.run_checks(spark, C.repository_checks(repo, TD.glossary(spark), reference, TD.ANCHOR)).collect()
        got = C.repository_suite(repo, TD.glossary(spark), reference, TD.ANCHOR)
        assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want))
    assert sum(r.failures > 0 for r in want) >= 8
    none = C.repository_suite(repo.limit(0), TD.glossary(spark), countries, TD.ANCHOR).collect()
    assert len(none) == 13 and all(r.failures == 0 and r.status == "pass" for r in none)
    final = got._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert final.count("orders.parquet") <= 1


def test_row_checks_are_counted_while_rows_are_written(spark, tmp_path):
    repo = _dirty(spark).cache()
    rows = [c for c in C.repository_checks(repo, TD.glossary(spark), None, TD.ANCHOR) if c.rows is None]
    rows.append(C.Check("off", repo, F.lit(True), enabled=False))
    out, results = C.observed(repo, rows)
    out.write.parquet(str(tmp_path / "repo"))
    assert results() == sorted([tuple(r) for r in C.run_checks(spark, rows).collect()], key=lambda r: [c.name for c in rows].index(r[0]))
    assert {r[0]: r[2] for r in results()}["id_not_null"] == 2
    with pytest.raises(ValueError):
        C.observed(repo, C.repository_checks(repo, TD.glossary(spark), None, TD.ANCHOR))
    repo.unpersist()


def test_catalog_scan_names_what_it_cannot_read(spark):
    df = spark.createDataFrame([("1", '{"geo":"US"}')], "id string, dimensions string")
    df.createOrReplaceTempView("kpi__scan_base")
    df.createOrReplaceTempView("KPI__scan_good")
    spark.sql("CREATE OR REPLACE TEMPORARY VIEW kpi__scan_gone AS SELECT * FROM kpi__scan_base")
    spark.catalog.dropTempView("kpi__scan_base")
    try:
        rows = profile_catalog(spark, name_prefix="kpi__scan").collect()
    finally:
        for v in ("KPI__scan_good", "kpi__scan_gone"):
            spark.catalog.dropTempView(v)
    good = [r for r in rows if r.table_name == "kpi__scan_good"]
    assert [r.column_name for r in sorted(good, key=lambda r: (r.position is None, r.position))] == ["id", "dimensions", "dimensions:geo"]
    gone, = [r for r in rows if r.table_name == "kpi__scan_gone"]
    assert gone.description.startswith("Error reading the table") and gone.column_name is None and len(rows) == 4


def test_nested_dimensions_have_one_spelling(spark):
    same = ['{"geo":"US","app":{"v":[1.50,{"b":null,"a":"x 1.0"}],"os":"iOS"}}', '{"app": {"os": "iOS", "v": [1.5, {"a":"x 1.0","b":null}]}, "geo":"US"}',
            '{"app":{"os":"iOS","v":[15e-1,{"a":"x 1.0","b":null}]},"geo":"US"}']
    other = ['{"app":{"os":"iOS","v":[{"b":null,"a":"x 1.0"},1.5]},"geo":"US"}', '{"app":{"os":"iOS","v":[1.5,{"a":"x 1","b":null}]},"geo":"US"}']
    texts = spark.createDataFrame([(t,) for t in same + other], "t string").select(D.canonical("t").alias("c"))
    got = [r.c for r in texts.collect()]
    assert len(set(got[:3])) == 1 and len(set(got)) == 3
    again = [r.c for r in texts.select(D.canonical("c").alias("c")).collect()]
    assert again == got  # idempotent
    struct = spark.sql("SELECT named_struct('geo', 'US', 'app', named_struct('v', array(2, 1), 'os', 'iOS')) AS dimensions")
    variant = spark.sql("""SELECT parse_json('{"app":{"os":"iOS","v":[2.0,1]},"geo":"US"}') AS dimensions""")
    texts = {df.select(D.canonical_any("dimensions", df.schema["dimensions"]).alias("c")).first().c for df in (struct, variant)}
    assert texts == {r'{"app":"{\"os\":\"iOS\",\"v\":[2,1]}","geo":"US"}'}
    plain = ['{"a":"{not json","b":"[x"}', '{"a":{"k":1,"k":2}}', '{"a":"1.50"}', "[1]", None]
    kept = [r.c for r in spark.createDataFrame([(t,) for t in plain], "t string").select(D.canonical("t").alias("c")).collect()]
    assert kept[0] == plain[0] and kept[2] == plain[2] and kept[4] is None


def _easter(year):
    """The well-known rule of 1876, in whole numbers."""
    a, (b, c) = year % 19, divmod(year, 100)
    (d, e), f = divmod(b, 4), (b + 8) // 25
    h = (19 * a + b - d - (b - f + 1) // 3 + 15) % 30
    i, k = divmod(c, 4)
    m = (a + 11 * h + 22 * ((32 + 2 * e + 2 * i - h - k) % 7)) // 451
    month, day = divmod(h + (32 + 2 * e + 2 * i - h - k) % 7 - 7 * m + 114, 31)
    return dt.date(year, month, day + 1)


def test_movable_holidays(spark):
    years = spark.range(1583, 4100).select(F.col("id").cast("int").alias("y"))
    assert {r.y: r.e for r in years.select("y", easter_sunday(F.col("y")).alias("e")).collect()} == {y: _easter(y) for y in range(1583, 4100)}
    rules = [HolidayRule("US", "T", 11, nth=4, weekday="Thu"), HolidayRule("US", "M", 5, nth=-1, weekday="Mon"),
             HolidayRule("DE", "O", 10, nth=1, weekday="Sun", not_before=(10, 3)), HolidayRule("PH", "S", 1, nth=3, weekday="Sun"),
             HolidayRule("US", "F", 7, 4), HolidayRule("DE", "K", offset=-47)]
    got = {(r.country, r.holiday, r.date.year): r.date for r in holidays_by_rule(spark, rules, 2018, 2030).collect()}
    assert len(got) == 6 * 13
    assert got["US", "T", 2024] == dt.date(2024, 11, 28) and got["US", "M", 2027] == dt.date(2027, 5, 31)
    assert [got["DE", "O", y].day for y in (2021, 2022, 2023, 2024, 2028)] == [3, 3, 3, 6, 3]
    assert got["PH", "S", 2024] == dt.date(2024, 1, 21) and got["DE", "K", 2025] == dt.date(2025, 3, 4) and got["US", "F", 2020] == dt.date(2020, 7, 4)
    for wrong in (dict(month=2), dict(month=2, nth=5, weekday="Mon"), dict(month=2, nth=1, weekday="Montag")):
        with pytest.raises(ValueError):
            HolidayRule("US", "X", **wrong)


def test_components_of_each_coordinate_are_those_of_it_alone(spark):
    import random

    from metricbook.operators.pca import kpi_pca, kpi_pca_by_coordinate
    draw = random.Random(4)
    rows = []
    for c in range(12):
        for w in range(2 if c == 3 else 30):
            x = draw.gauss(0, 1)
            values = (x, 2 * x + draw.gauss(0, 1) * c, draw.gauss(0, 3) if c != 5 else 1.0)
            rows += [(i, f'{{"c":"{c}"}}', "week", dt.datetime(2024, 1, 1) + dt.timedelta(weeks=w), v) for i, v in zip("ABC", values)
                     if draw.random() < 0.95]
    report = spark.createDataFrame(rows, "indicator string, dimensions string, cycle string, cycle_timestamp timestamp_ntz, current_value double")
    got = kpi_pca_by_coordinate(report, list("ABC"), "week", 2)
    by = {}
    for r in got.collect():
        by.setdefault(r.dimensions, {})[r.cycle_timestamp] = (r.pc1, r.pc2)
    for c in (0, 1, 2, 4, 5, 11):
        alone = {r.cycle_timestamp: (r.pc1, r.pc2) for r in kpi_pca(report, list("ABC"), "week", f'{{"c":"{c}"}}').collect()}
        mine = by.get(f'{{"c":"{c}"}}', {})
        assert mine.keys() == alone.keys()
        assert all(abs(a - b) < 1e-5 for t in alone for a, b in zip(alone[t], mine[t]))
    assert '{"c":"5"}' not in by and len(by) >= 10
