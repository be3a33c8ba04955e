"""Idempotent sinks on partitioned Parquet: delete+insert and keyed merge.

The batch is written to the shared staging folder first: it is evaluated once, and every later step sees the
same rows, also of a batch that would come out differently a second time.  An upsert rewrites only the
partitions it touches: those of the batch, and those that hold a row whose key (or coordinates) the batch
replaces.  Their surviving rows (a left-anti equi-join) are staged beside the batch, so the write never reads
what it replaces, and then swapped in by dynamic partition overwrite; partitions left without a row are removed
last.  The final write is rebalanced by partition: a run of one period is spread over as many tasks (and files)
as its size asks for, and small partitions stay in one file.  Repeating an upsert gives the same table, also
after a run that broke off; all other partition files stay as they are.  Staged tables are deleted at the end.
"""

from __future__ import annotations

import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from metricbook.session import shared_folder

MODES = ("delete_insert", "merge")


class DuplicateKeyError(ValueError):
    pass


def merge_frames(target: DataFrame | None, batch: DataFrame, keys: list[str], mode: str = "delete_insert",
                 coordinates: list[str] | None = None) -> DataFrame:
    """New table content after an upsert.

    ``delete_insert``: drop target rows whose ``keys`` occur in the batch, then
    insert the batch.  ``merge``: the same, but a key that occurs twice in the
    batch raises :class:`DuplicateKeyError` (one job over the batch's keys).
    ``coordinates`` additionally removes target rows sharing the batch's
    coordinates (an override that arrives under a new id).
    """
    if mode not in MODES:
        raise ValueError(f"mode must be one of {MODES}")
    if mode == "merge":
        twice = batch.groupBy(*keys).agg(F.count("*").alias("n")).where("n > 1").limit(5).collect()
        if twice:
            raise DuplicateKeyError(f"keys that occur more than once: {[tuple(r)[:-1] for r in twice]}")
    if target is None:
        return batch
    kept = target.join(batch.select(*keys).distinct(), on=keys, how="left_anti")
    if coordinates:
        kept = kept.join(batch.select(*coordinates).distinct(), on=coordinates, how="left_anti")
    return kept.unionByName(batch.select(*target.columns))


def read_table(spark: SparkSession, path: str, schema: StructType | None = None) -> DataFrame | None:
    """The table at ``path``, or None before its first upsert."""
    reader = spark.read.schema(schema) if schema is not None else spark.read
    try:
        return reader.parquet(path)
    except AnalysisException as e:
        if "PATH_NOT_FOUND" in str(e):
            return None
        raise


def _delete(spark: SparkSession, path: str, recursive: bool) -> None:
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, recursive)


def upsert(batch: DataFrame, path: str, keys: list[str], partition_by: list[str], mode: str = "delete_insert",
           coordinates: list[str] | None = None, keys_hold_partition: bool = False) -> None:
    """Upsert ``batch`` into the table at ``path``, rewriting only the partitions it touches.

    The list of touched partitions reaches the driver: for KPI tables (cycle,
    period) at most one entry per period of the batch and of the rows it replaces.
    To find rows of the batch's keys in other partitions, the key columns of the whole table are read;
    ``keys_hold_partition`` says that equal keys (and coordinates) lie in equal partitions, as surrogate ids
    made of cycle and period do, and saves that read.
    """
    spark = batch.sparkSession
    folder = f"{shared_folder(spark)}/upsert-{uuid.uuid4().hex}"
    schema, columns = batch.schema, batch.columns
    try:
        batch.write.parquet(f"{folder}/batch")
        _swap_in(spark, spark.read.schema(schema).parquet(f"{folder}/batch"), f"{folder}/new", path, keys, partition_by, mode,
                 coordinates, keys_hold_partition, columns)
    finally:
        _delete(spark, folder, True)


def _swap_in(spark, batch, staged, path, keys, partition_by, mode, coordinates, keys_hold_partition, columns) -> None:
    target = read_table(spark, path, batch.schema)
    if target is not None:
        touched = batch.select(*partition_by).distinct()
        for named in [] if keys_hold_partition else [keys] + ([coordinates] if coordinates else []):
            replaced = target.select(*dict.fromkeys([*partition_by, *named]))
            touched = touched.unionByName(replaced.join(batch.select(*named).distinct(), named, "left_semi")
                                          .select(*partition_by)).distinct()
        where = F.lit(False)
        for row in touched.collect():
            same = F.lit(True)
            for c in partition_by:
                same &= F.col(c).eqNullSafe(F.lit(None if row[c] is None else str(row[c])).cast(batch.schema[c].dataType))
            where |= same
        target = target.where(where)
    merge_frames(target, batch, keys, mode, coordinates).select(*columns).write.parquet(staged)
    new = spark.read.schema(batch.schema).parquet(staged)
    emptied = []
    if target is not None:
        old = target.select(*partition_by, F.col("_metadata.file_path").alias("__file")).distinct()
        match = [old[c].eqNullSafe(new[c]) for c in partition_by]
        emptied = [r[0] for r in old.join(new, match, "left_anti").select("__file").collect()]
    (new.hint("rebalance", *partition_by).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy(*partition_by).parquet(path))
    for file in emptied:
        _delete(spark, spark._jvm.java.net.URI(file), False)  # file_path is URL-encoded
