"""The corpus pipeline, stage by stage, against what each stage promises."""

import re

from pyspark.sql import functions as F

import corpus_pipeline as P
from metricbook.llm import rules, simhash

WORD = r"[^\x20\x09-\x0D]+"


def test_stages_do_what_they_say(spark, tmp_path):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    columns = docs.dtypes
    seen = [docs]
    for name, stage in P.STAGES:
        stage(spark, seen[-1], None).write.parquet(str(tmp_path / name))
        seen.append(spark.read.parquet(str(tmp_path / name)))
    first, good, single, safe, mixed, packed = seen
    assert all(x.dtypes == columns for x in seen[:-1])
    verdict = rules.ledger(first, ["doc_id"]).where(rules.passes(P.POLICY)).select("doc_id")
    assert good.exceptAll(first.join(verdict, "doc_id").select(*first.columns)).isEmpty() and good.count() == verdict.count()
    groups = simhash.near_duplicates(good, "doc_id", ["doc_id"])
    assert {r.doc_id for r in single.collect()} == {r.component for r in groups.collect()} and single.exceptAll(good).isEmpty()
    assert safe.count() == single.count() and not [r for r in safe.collect() if re.search(r"mail\d\.example", r.text)]
    assert mixed.select("doc_id").subtract(safe.select("doc_id")).isEmpty()
    n = F.regexp_count("text", F.lit(WORD))
    before, after = (x.agg(F.sum(n)).first()[0] for x in (safe, mixed))
    assert before - 20 <= after <= before
    assert packed.select("doc_id").distinct().count() == mixed.select("doc_id").distinct().count()
    assert packed.groupBy("sequence_id").agg(F.sum("length").alias("n")).where("n > 2048").isEmpty()


def test_run_on_hostile_rows(spark, tmp_path):
    text = " ".join(f"plain{i} word{i}" for i in range(60))
    rows = [(1, text, "en", "a", 5), (1, text, "en", "a", 5), (None, text + " more", "en", None, None), (2, None, None, None, None),
            (3, "", "en", "b", 0), (4, " ".join(f"q{i}" for i in range(20_000)), "en", "b", 1),
            (5, "mail x.1@mail2.example.com " + " ".join(f"other{i}" for i in range(40)), "de", "c", 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    assert P.run(spark, str(tmp_path)).count() > 0
    docs.limit(0).write.parquet(str(tmp_path / "none" / "documents.parquet"))
    assert P.run(spark, str(tmp_path / "none")).count() == 0


def test_near_dedup_keeps_unlike_rows_without_own_ids(spark):
    texts = [" ".join(f"{x}{i}" for i in range(60)) for x in "abcde"]
    rows = list(zip([None, None, 7, 7, 8], texts)) + [(None, texts[4]), (None, texts[0])]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    kept = sorted(map(tuple, P.simhash_near_dedup(spark, docs, None).collect()), key=lambda r: r[1])
    assert kept == list(zip([None, None, 7, 7, 8], texts))
