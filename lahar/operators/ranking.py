"""Places of all rows of a table, without one task that holds them all."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def placed(df: DataFrame, order: list[Column], name: str, cut, ties: bool = False) -> DataFrame:
    """df with each row's place in an order, from 1; with ties, equal rows share the first place among them.

    Rows are dealt by range and written where lost executors don't matter, so that parts keep their rows; a place is
    that within a part, plus the rows of the parts before. Equal keys fall into one part. The window over parts has a
    row for each of them.
    """
    dealt = cut(df.repartitionByRange(*order).withColumn("_part", F.spark_partition_id()))
    before = F.sum("count").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1))
    offsets = dealt.groupBy("_part").count().select("_part", F.coalesce(before, F.lit(0)).alias("_before"))
    own = Window.partitionBy("_part").orderBy(*order)
    place = (F.rank() if ties else F.row_number()).over(own)
    return dealt.join(offsets, "_part").withColumn(name, place + F.col("_before")).drop("_part", "_before")
