"""Where loops cut their lineage."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """The folder that driver and executors share. A local session may name none: then one under /tmp."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if not named and spark.conf.get("spark.master", "local").split("[")[0] != "local":
        raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
    return (named or "file:///tmp/lahar-shared").rstrip("/")


def shared_cut(spark: SparkSession):
    """Write a frame to the shared folder and read it back."""
    folder = shared_folder(spark)

    def cut(df: DataFrame) -> DataFrame:
        path = f"{folder}/cut-{uuid.uuid4().hex}"
        df.write.parquet(path)
        return spark.read.schema(df.schema).parquet(path)

    return cut
