"""Assertions over tables: each is a lazy one-row count, run together, blocking or not."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lahar.functions import geo

Assertion = tuple[str, Callable[[], DataFrame], bool]


def broken(df: DataFrame, cond: Column) -> DataFrame:
    """How many rows break a rule; null counts as broken."""
    return df.agg(F.count_if(F.coalesce(cond, F.lit(True))).alias("n"))


def run(spark: SparkSession, assertions: list[Assertion]) -> DataFrame:
    """(name, broken, blocking, ok) of each; one that can't be planned fails at its own severity."""
    out = None
    for name, make, blocking in assertions:
        try:
            row = make().select(F.col("n").cast("long").alias("broken"))
        except Exception:  # whatever stops an assertion from being evaluated is its failure
            row = spark.range(1).select(F.lit(None).cast("long").alias("broken"))
        row = row.select(F.lit(name).alias("name"), "broken", F.lit(blocking).alias("blocking"), F.coalesce(F.col("broken") == 0, F.lit(False)).alias("ok"))
        out = row if out is None else out.unionByName(row)
    return out


def impact_assertions(impact: DataFrame, lookup: DataFrame) -> list[Assertion]:
    return [
        ("negative_population", lambda: broken(impact, F.col("pop_total") < 0), True),
        ("null_keys", lambda: broken(impact, F.col("pop_total").isNull() | F.col("adm2_id").isNull()), True),
        ("unnamed_municipality", lambda: impact.where("mmi >= 6").join(lookup, "adm2_id", "left_anti").agg(F.count("*").alias("n")), False),
    ]


def float_columns(df: DataFrame) -> list[str]:
    return [c for c, t in df.dtypes if t in ("double", "float")]


def not_finite(df: DataFrame) -> DataFrame:
    """Values of each float column that are NaN or infinite; the table names its own columns."""
    cols = float_columns(df)
    sums = df.agg(*[F.count_if(F.col(c).isNotNull() & ~geo.is_finite(F.col(c))).alias(c) for c in cols])
    return sums.select(F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).alias("broken")) for c in cols])).alias("x")).select("x.*")


def layer_coverage(df: DataFrame, layers: list[str]) -> DataFrame:
    """Sum of each layer and whether it is there, finite and not zero."""
    sums = df.agg(*[F.sum(F.col(c).cast("decimal(28,6)")).cast("double").alias(c) for c in layers])
    rows = F.explode(F.array(*[F.struct(F.lit(c).alias("layer"), F.col(c).alias("total")) for c in layers])).alias("x")
    return sums.select(rows).select("x.layer", "x.total", F.coalesce(geo.is_finite(F.col("x.total")) & (F.col("x.total") != 0), F.lit(False)).alias("ok"))


def age_consistency(df: DataFrame, tolerance: float = 1e-6) -> DataFrame:
    total, bands = F.col("pop_total"), F.col("pop_0_14") + F.col("pop_15_64") + F.col("pop_65p")
    return df.agg(
        F.count_if(F.col("pop_0_14") > total * (1 + tolerance)).alias("young_over"),
        F.count_if(F.col("pop_65p") > total * (1 + tolerance)).alias("old_over"),
        F.count_if(F.abs(bands - total) > total * tolerance).alias("not_total"),
    )


def national_total(df: DataFrame, expected: float, tolerance_pct: float) -> DataFrame:
    total = F.sum(F.col("pop_total").cast("decimal(28,6)")).cast("double")
    return df.agg(total.alias("total")).withColumn("pct", F.round((F.col("total") - expected) * 100 / expected, 4)).withColumn("ok", F.abs("pct") <= tolerance_pct)


def mixed_manifests(df: DataFrame, col: str) -> DataFrame:
    return df.agg(F.countDistinct(col).alias("manifests")).withColumn("ok", F.col("manifests") <= 1)


def reach(cells: DataFrame, floor: float, offshore_allowed: bool) -> DataFrame:
    """Why a footprint has no cells: an empty source, none at the floor, or a place without an asset."""
    sums = cells.agg(F.count("*").alias("all"), F.max("mmi").alias("most"))
    verdict = F.when(F.col("all") == 0, F.lit("offshore" if offshore_allowed else "wrong country")).when(F.col("most") < floor, "below the floor").otherwise("reached")
    return sums.select(F.col("all").alias("cells"), verdict.alias("verdict"))


def blind_sources(reads: DataFrame) -> DataFrame:
    """Sources of which nothing could be read; nothing read isn't nothing happened."""
    return reads.groupBy("source").agg(F.count("*").alias("files"), F.count_if(F.col("ok")).alias("read")).withColumn("blind", F.col("read") == 0)


def stale(files: DataFrame, now: Column) -> DataFrame:
    """Files past their age; one without a readable date is a finding too."""
    age = (F.unix_micros(now.cast("timestamp")) - F.unix_micros(F.col("dated").cast("timestamp"))) / 3.6e9
    return files.withColumn("age_h", F.round(age, 3)).withColumn("finding", F.when(F.col("dated").isNull(), "undated").when(F.col("age_h") > F.col("most_h"), "stale")).where("finding IS NOT NULL").select("name", "age_h", "finding")


def tightened(old: Column, proposed: Column) -> Column:
    """A tolerance is only ever lowered."""
    return F.when(proposed < old, proposed).otherwise(old)


def digest_findings(pinned: DataFrame, files: DataFrame) -> DataFrame:
    """Sources whose digest differs from the pinned one, or that have no files."""
    both = pinned.join(files, "source", "left")
    return both.select("source", F.when(F.col("digest").isNull(), "no files").when(F.col("digest") != F.col("pinned"), "mismatch").alias("finding")).where("finding IS NOT NULL")
