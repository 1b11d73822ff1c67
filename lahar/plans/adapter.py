"""The domain's tables built from the generic test tables, as DataFrames and as the same SQL.

Coordinates come from pairs of ids inside the region's box; cross-table cells have a side of four degrees
(level -2), single-table ones of a quarter degree (level 2).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lahar.functions import grid
from lahar.session import table

COARSE, FINE = -2, 2


def lon(a: Column) -> Column:
    return F.lit(-119.0) + ((a.cast("long") * 7919) % 87000) / 1000.0


def lat(b: Column) -> Column:
    return F.lit(-57.5) + ((b.cast("long") * 104729) % 90500) / 1000.0


def lon_sql(a: str) -> str:
    return f"(-119.0::DOUBLE + ((({a})::BIGINT * 7919) % 87000) / 1000.0::DOUBLE)"


def lat_sql(b: str) -> str:
    return f"(-57.5::DOUBLE + ((({b})::BIGINT * 104729) % 90500) / 1000.0::DOUBLE)"


def cell_sql(x: str, y: str, level: int) -> str:
    return f"(floor(({x} + 180) * {2.0**level}::DOUBLE)::BIGINT * 1048576 + floor(({y} + 90) * {2.0**level}::DOUBLE)::BIGINT)"


def _money(c: str) -> Column:
    return F.col(c).cast("decimal(18,2)")


def exposure(spark: SparkSession, d: str, level: int = COARSE) -> DataFrame:
    """One row for each cell and municipality, with every layer of the asset."""
    both = table(spark, d, "orders").join(table(spark, d, "customer"), F.col("o_custkey") == F.col("c_custkey"))
    key = F.col("c_custkey")
    price = _money("o_totalprice")
    first = F.substring("o_orderpriority", 1, 1)

    def total(cond: Column | None) -> Column:
        return F.sum(price if cond is None else F.when(cond, price).otherwise(F.lit(0).cast("decimal(18,2)"))).cast("double")

    rows = both.select("*", grid.cell_of(lon(key), lat(key), level).alias("cell"), F.lpad(F.col("c_nationkey").cast("string"), 5, "0").alias("adm2_id"))
    return rows.groupBy("cell", "adm2_id").agg(
        total(None).alias("pop_total"),
        total(first == "1").alias("pop_0_14"),
        total(first.isin("2", "3", "4")).alias("pop_15_64"),
        total(first == "5").alias("pop_65p"),
        total(F.col("o_orderstatus") != "P").alias("pop_alt"),
        F.count("*").alias("bld_count"),
        F.sum(F.floor("o_totalprice")).cast("double").alias("built_m2"),
        F.count_if(F.col("o_orderstatus") == "F").alias("health_count"),
        F.count_if(F.col("o_orderstatus") == "O").alias("edu_count"),
        F.sum(F.when(first == "1", 1.5).otherwise(0.25)).alias("road_km"),
        F.max(F.when(F.col("o_orderstatus") == "P", F.lit("parcial"))).alias("flags_calidad"),
    )


EXPOSURE_SQL = f"""exposure AS (
  SELECT {cell_sql(lon_sql("c_custkey"), lat_sql("c_custkey"), COARSE)} AS cell, lpad(c_nationkey::VARCHAR, 5, '0') AS adm2_id,
    sum(o_totalprice::DECIMAL(18,2))::DOUBLE AS pop_total,
    sum(CASE WHEN o_orderpriority[1] = '1' THEN o_totalprice::DECIMAL(18,2) ELSE 0 END)::DOUBLE AS pop_0_14,
    sum(CASE WHEN o_orderpriority[1] IN ('2','3','4') THEN o_totalprice::DECIMAL(18,2) ELSE 0 END)::DOUBLE AS pop_15_64,
    sum(CASE WHEN o_orderpriority[1] = '5' THEN o_totalprice::DECIMAL(18,2) ELSE 0 END)::DOUBLE AS pop_65p,
    sum(CASE WHEN o_orderstatus <> 'P' THEN o_totalprice::DECIMAL(18,2) ELSE 0 END)::DOUBLE AS pop_alt,
    count(*) AS bld_count, sum(floor(o_totalprice)::BIGINT)::DOUBLE AS built_m2,
    count(*) FILTER (o_orderstatus = 'F') AS health_count, count(*) FILTER (o_orderstatus = 'O') AS edu_count,
    sum(CASE WHEN o_orderpriority[1] = '1' THEN 1.5::DOUBLE ELSE 0.25::DOUBLE END) AS road_km,
    max(CASE WHEN o_orderstatus = 'P' THEN 'parcial' END) AS flags_calidad
  FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY 1, 2)"""


def lookup(spark: SparkSession, d: str) -> DataFrame:
    """The municipality dictionary."""
    both = table(spark, d, "nation").join(table(spark, d, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    return both.select(F.lpad(F.col("n_nationkey").cast("string"), 5, "0").alias("adm2_id"), F.col("n_name").alias("nombre"), F.col("n_regionkey").cast("string").alias("adm1_id"), F.col("r_name").alias("departamento"))


LOOKUP_SQL = """lookup AS (
  SELECT lpad(n_nationkey::VARCHAR, 5, '0') AS adm2_id, n_name AS nombre, n_regionkey::VARCHAR AS adm1_id, r_name AS departamento
  FROM nation JOIN region ON n_regionkey = r_regionkey)"""


def _event_cell(level: int) -> Column:
    return grid.cell_of(lon(F.col("event_id")), lat(F.col("user_id")), level)


def intensity(spark: SparkSession, d: str) -> DataFrame:
    """Highest intensity of each cell, five and more."""
    m = F.lit(4.5) + F.least(F.lit(4.0), F.lit(0.5) * F.floor(F.col("value") / 40))
    return table(spark, d, "events").select(_event_cell(COARSE).alias("cell"), m.alias("mmi")).where("mmi >= 5").groupBy("cell").agg(F.max("mmi").alias("mmi"))


INTENSITY_SQL = f"""intensity AS (
  SELECT cell, max(mmi) AS mmi FROM (
    SELECT {cell_sql(lon_sql("event_id"), lat_sql("user_id"), COARSE)} AS cell, 4.5::DOUBLE + least(4.0::DOUBLE, 0.5::DOUBLE * floor(value / 40)) AS mmi FROM events)
  WHERE mmi >= 5 GROUP BY cell)"""


def ground_failure(spark: SparkSession, d: str) -> DataFrame:
    """Landslide probability and liquefaction coverage of each cell; units differ."""
    share = F.col("value") / 500
    rows = table(spark, d, "events").select(_event_cell(COARSE).alias("cell"), "event_type", share.alias("share"))
    return rows.groupBy("cell").agg(F.max(F.when(F.col("event_type") == "click", F.col("share"))).alias("ls_prob"), F.max(F.when(F.col("event_type") == "purchase", F.col("share"))).alias("lq_prob"))


GROUND_FAILURE_SQL = f"""ground_failure AS (
  SELECT {cell_sql(lon_sql("event_id"), lat_sql("user_id"), COARSE)} AS cell,
    max(CASE WHEN event_type = 'click' THEN value / 500 END) AS ls_prob, max(CASE WHEN event_type = 'purchase' THEN value / 500 END) AS lq_prob
  FROM events GROUP BY 1)"""


def detections(spark: SparkSession, d: str) -> DataFrame:
    """Satellite fire detections."""
    return table(spark, d, "events").select(
        F.col("event_id"), lon(F.col("event_id")).alias("lon"), lat(F.col("user_id")).alias("lat"), "ts",
        F.when(F.col("event_type") == "error", "low").when(F.col("event_type") == "view", "high").otherwise("nominal").alias("confidence"),
        F.col("value").cast("decimal(18,2)").alias("frp"), (F.lit(300.0) + F.col("event_id") % 90).alias("brightness"), (F.col("event_id") % 2).cast("int").alias("sensor"),
    )


DETECTIONS_SQL = f"""detections AS (
  SELECT event_id, {lon_sql("event_id")} AS lon, {lat_sql("user_id")} AS lat, ts,
    CASE event_type WHEN 'error' THEN 'low' WHEN 'view' THEN 'high' ELSE 'nominal' END AS confidence,
    value::DECIMAL(18,2) AS frp, 300.0::DOUBLE + event_id % 90 AS brightness, (event_id % 2)::INT AS sensor FROM events)"""


def customer_points(spark: SparkSession, d: str) -> DataFrame:
    c = F.col("c_custkey")
    return table(spark, d, "customer").select(c.alias("id"), lon(c).alias("lon"), lat(c).alias("lat"), "c_nationkey", "c_acctbal")


POINTS_SQL = f"""points AS (SELECT c_custkey AS id, {lon_sql("c_custkey")} AS lon, {lat_sql("c_custkey")} AS lat, c_nationkey, c_acctbal FROM customer)"""


def pixels(spark: SparkSession, d: str) -> DataFrame:
    k = F.col("l_orderkey")
    return table(spark, d, "lineitem").select(lon(k).alias("lon"), lat(F.col("l_partkey")).alias("lat"), F.concat("l_returnflag", "l_linestatus").alias("class"), F.col("l_quantity").alias("value"))


PIXELS_SQL = f"""pixels AS (SELECT {lon_sql("l_orderkey")} AS lon, {lat_sql("l_partkey")} AS lat, l_returnflag || l_linestatus AS class, l_quantity AS value FROM lineitem)"""


def products(spark: SparkSession, d: str) -> DataFrame:
    """Product versions of events: event, contributor, weight, status, version."""
    p = F.col("p_partkey")
    return table(spark, d, "part").select(
        (p % 40).alias("event"), F.col("p_brand").alias("contributor"), F.col("p_size").alias("weight"), F.when(p % 11 == 0, "DELETE").otherwise("UPDATE").alias("status"), (p % 17).cast("int").alias("version"), p.alias("updated")
    )


PRODUCTS_SQL = """products AS (
  SELECT p_partkey % 40 AS event, p_brand AS contributor, p_size AS weight, CASE WHEN p_partkey % 11 = 0 THEN 'DELETE' ELSE 'UPDATE' END AS status,
    (p_partkey % 17)::INT AS version, p_partkey AS updated FROM part)"""


def with_ctes(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"
