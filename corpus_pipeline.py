"""Corpus pipeline: quality rules, near-duplicate removal, surrogates for personal data, mixing of
sources, packing. Each stage is written as Parquet and read again as the next one's documents."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from metricbook.llm import mixing, packing, pii, rules, simhash
from metricbook.llm.common import ROW_FILE, ROW_INDEX, named_rows, read, shared_dir
from metricbook.llm.queries import PII_KEY, POLICY

SHINGLE_WORDS, MAX_BITS = 4, 4


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that fail no rule of the policy."""
    return rules.keep_passing(docs, POLICY)


def simhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: the smallest doc_id, of repeated ids one row (a null id
    only where no document of the group has one)."""
    own = {c: f"_c{i}" for i, c in enumerate(docs.columns)}  # no name of the input clashes
    rows = named_rows(docs, {name: F.col(f"`{c}`") for c, name in own.items()})
    key, ids = own["doc_id"], [ROW_FILE, ROW_INDEX]
    groups = simhash.near_duplicates(rows, key, [key, *ids], own["text"], SHINGLE_WORDS, MAX_BITS)
    first = F.min(F.struct(F.col(key).isNull().alias("z"), F.col(key), *ids)).alias("f")
    chosen = groups.groupBy("component_fp").agg(first).select(*[F.col(f"f.{c}").alias(c) for c in ids])
    return rows.join(chosen, ids, "left_semi").select(*[F.col(name).alias(c) for c, name in own.items()])


def pii_surrogates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with surrogates for the entities found in them."""
    return pii.replace_entities(docs, PII_KEY, n_chars="n_chars")


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The words that the mixture takes: a row for each document and epoch."""
    return mixing.mixed_documents(docs, n_chars="n_chars")


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Where every token piece of every row goes."""
    return packing.pack(packing.pieces(docs, ["doc_id"], added=packing.default_added()), ["doc_id", "piece", "ids_crc32"])


STAGES = [("quality_rules", quality_rules), ("simhash_near_dedup", simhash_near_dedup),
          ("pii_surrogates", pii_surrogates), ("mix_sources", mix_sources), ("best_fit_packing", best_fit_packing)]

#: SQL has neither the fingerprints nor the permutations; the stages are tested by brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = f"{shared_dir(spark)}/pipeline-{uuid.uuid4().hex}"
    docs = read(spark, sf_dir, "documents")
    for i, (name, stage) in enumerate(STAGES):
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{i}-{name}")
        docs = spark.read.parquet(f"{folder}/{i}-{name}")
    return docs
