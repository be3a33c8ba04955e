"""Spark session helpers: local test session and the shared checkpoint folder."""

from __future__ import annotations

import tempfile

from pyspark.sql import SparkSession


def local_session(cpus: int | str = "*", app: str = "metricbook", shuffle_partitions: int = 8,
                  **conf) -> SparkSession:
    """Session for tests and the local benchmark (UTC, AQE on, UI off).

    ``checkpoint_dir`` is a scratch folder here; on a cluster the setting names a shared one."""
    b = (SparkSession.builder.master(f"local[{cpus}]").appName(app)
         .config("spark.ui.enabled", "false")
         .config("spark.ui.showConsoleProgress", "false")
         .config("spark.sql.session.timeZone", "UTC")
         .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
         .config("spark.sql.adaptive.enabled", "true")
         .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
         .config("spark.sql.adaptive.skewJoin.enabled", "true")
         .config("spark.checkpoint.dir", conf.pop("checkpoint_dir", None) or tempfile.mkdtemp(prefix="metricbook-"))
         .config("spark.driver.memory", "8g"))
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_folder(spark: SparkSession) -> str:
    """The folder that ``spark.checkpoint.dir`` names, which all executors share."""
    folder = spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if not folder:
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    return folder.rstrip("/")
