"""Helpers shared by the corpus operators: words, written intermediate tables, row identity,
distributed running offsets, readers."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

WORD = r"[^\x20\x09-\x0D]+"
SPACE = r"[\x20\x09-\x0D]"

ROW_FILE, ROW_INDEX = "_row_file", "_row_index"


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The cluster's ``spark.checkpoint.dir``; a scratch folder only where it is unset and all runs in one process."""
    sc = spark.sparkContext
    folder = sc.getCheckpointDir() or sc.getConf().get("spark.checkpoint.dir", None)
    if not folder:
        if not (sc.master == "local" or sc.master.startswith("local[")):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        folder = tempfile.mkdtemp(prefix="corpus-ckpt-")
        sc.setCheckpointDir(folder)
    return folder


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Writes ``df`` as Parquet into the shared folder and reads it back: lineage ends there, and a
    lost executor costs a re-read instead of a recomputation."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def with_row_identity(df: DataFrame) -> DataFrame:
    """Adds (file hash, row index), which tells even equal rows apart and is the same on every read.

    A frame that does not come straight from files is written to the shared folder first."""
    try:
        return df.select("*", F.xxhash64("_metadata.file_path").alias(ROW_FILE),
                         F.col("_metadata.row_index").alias(ROW_INDEX))
    except AnalysisException:
        return with_row_identity(materialise(df, "rows"))


def named_rows(df: DataFrame, columns: dict[str, Column]) -> DataFrame:
    """The given columns by their new names, and the row identity; no other column of ``df``, so none clashes."""
    chosen = [c.alias(name) for name, c in columns.items()]
    if "_metadata" in df.columns:  # hides what Spark knows of the file
        return named_rows(materialise(df.select(*chosen), "rows"), {name: F.col(name) for name in columns})
    try:
        return df.select(*chosen, F.xxhash64("_metadata.file_path").alias(ROW_FILE),
                         F.col("_metadata.row_index").alias(ROW_INDEX))
    except AnalysisException:
        return named_rows(materialise(df.select(*chosen), "rows"), {name: F.col(name) for name in columns})


def words(text: Column) -> Column:
    """The words ``[^\\x20\\x09-\\x0D]+`` of a text, in order (null: no word)."""
    return F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(WORD), F.lit(0))


def with_running_offset(df: DataFrame, keys: list[str], order: list[str], value: str, out: str,
                        buckets: int = 4096, spread_by: list[str] | None = None) -> DataFrame:
    """Adds the sum of ``value`` over the rows that come before a row within its key.

    The order is (hash bucket of ``spread_by`` or else ``order``, ``order``): every key is split into ``buckets`` windows,
    so a key with a third of all rows is spread out; only the bucket totals (keys x buckets rows)
    are summed per key. ``keys`` must not be null. Rows equal in ``order`` take any order."""
    spread = df.withColumn("_bucket", F.pmod(F.xxhash64(*(spread_by or order)), F.lit(buckets)).cast("int"))
    earlier = Window.partitionBy(*keys).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    base = (spread.groupBy(*keys, "_bucket").agg(F.sum(value).alias("_total"))
            .select(*keys, "_bucket", F.coalesce(F.sum("_total").over(earlier), F.lit(0)).alias("_base")))
    within = (Window.partitionBy(*keys, "_bucket").orderBy(*order)
              .rowsBetween(Window.unboundedPreceding, -1))
    return (spread.join(base, [*keys, "_bucket"])
            .withColumn(out, F.col("_base") + F.coalesce(F.sum(value).over(within), F.lit(0)))
            .drop("_bucket", "_base"))


def let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` evaluated once, however often the body names it and wherever the
    optimizer moves the expression (chained projections would be inlined by a pushed-down filter)."""
    return F.element_at(F.transform(F.array(value), body), 1)


def zip_shifted(a: Column, b: Column, step: int, fn) -> Column:
    """``fn(a[i], b[i + step])`` for every i that has both (empty if none)."""
    return let(F.struct(a.alias("a"), b.alias("b"), F.greatest(F.size(b) - step, F.lit(0)).alias("n")), lambda x: F.zip_with(
        F.slice(x.a, F.lit(1), x.n), F.slice(x.b, F.lit(1 + step), x.n), fn))
