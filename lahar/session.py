"""Session builder with the settings every plan here relies on."""

from __future__ import annotations

import os

from pyspark.sql import SparkSession


def build_session(app: str = "lahar", cores: int | None = None, **conf: str) -> SparkSession:
    """A local session for tests and benches; on a cluster pass master and sizes through spark-submit."""
    n = cores or int(os.environ.get("BENCH_CPUS", "0")) or os.cpu_count() or 4
    builder = (
        SparkSession.builder.master(f"local[{n}]")
        .appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", str(n))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
    )
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def table(spark: SparkSession, sf_dir: str, name: str):
    """One of the driver's Parquet tables."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
