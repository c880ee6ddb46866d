"""Session and working-folder helpers."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession


def get_session(app_name: str = "tickbars") -> SparkSession:
    """Session for the jobs. Cluster sizing comes from spark-submit / spark-defaults."""
    spark = (
        SparkSession.builder.appName(app_name)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    return use_utc(spark)


def use_utc(spark: SparkSession) -> SparkSession:
    """Hours and dates are cut in the session zone, so every entry point pins it to UTC.

    Instants are stored as microseconds: the default kind has no statistics, so no time could be skipped in a file.
    """
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    spark.conf.set("spark.sql.parquet.outputTimestampType", "TIMESTAMP_MICROS")
    return spark


def work_dir(spark: SparkSession, name: str) -> str:
    """A fresh directory below the cluster's shared `spark.checkpoint.dir`.

    Executors on other machines must see it, so a machine-local folder is only used in local mode.
    """
    shared = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.conf.get(
        "spark.checkpoint.dir", None
    )
    if shared is None:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
        shared = tempfile.mkdtemp(prefix="tickbars-")
    return f"{shared.rstrip('/')}/tickbars/{name}-{uuid.uuid4().hex}"
