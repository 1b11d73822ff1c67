"""Writers: the asset, tagged CSV, columnar JSON, contours, report documents and their index."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def asset(cells: DataFrame, path: str) -> None:
    """Parquet by country and layer, ZSTD."""
    cells.write.mode("overwrite").partitionBy("iso3", "layer").option("compression", "zstd").parquet(path)


def contract(df: DataFrame, columns: list[str], keep: tuple[str, ...] = ()) -> DataFrame:
    """The closed column list as text: an unknown column is an error, a missing one is empty; keep stays as it is."""
    if unknown := sorted(set(df.columns) - set(columns) - set(keep)):
        raise ValueError(f"columns outside the contract: {', '.join(unknown)}")
    return df.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) if c in df.columns else F.lit("").alias(c) for c in columns], *keep)


def tagged_csv(df: DataFrame, tags: dict[str, str], path: str, order: list | None = None) -> None:
    """CSV whose second row holds a tag for each column, rows in the order of the sort keys, else of the first column.

    One file, as its row order is part of the format; it has the rows of a report's table.
    """
    ranked = df.withColumn("_place", F.row_number().over(Window.orderBy(*(order or list(tags)[:1]))))
    head = df.sparkSession.createDataFrame([(*tags.values(), 0)], [*tags, "_place"])
    both = head.unionByName(contract(ranked, list(tags), ("_place",)))
    both.coalesce(1).sortWithinPartitions("_place").drop("_place").write.mode("overwrite").option("header", True).option("emptyValue", "").csv(path)


def read_tagged_csv(spark, path: str) -> DataFrame:
    df = spark.read.option("header", True).csv(path)
    return df.where(~F.coalesce(F.col(df.columns[0]).startswith("#"), F.lit(False)))


def columnar(df: DataFrame, columns: list[str]) -> DataFrame:
    """Each row as a JSON list, in the order of columns; null stays null."""
    field = lambda c: F.coalesce(F.nullif(F.regexp_extract(F.to_json(F.struct(F.col(c).alias("v"))), r'^\{"v":(.*)\}$', 1), F.lit("")), F.lit("null"))
    return df.select(F.concat(F.lit("["), F.concat_ws(",", *[field(c) for c in columns]), F.lit("]")).alias("row"))


def published_contours(contours: DataFrame, floor: float) -> DataFrame:
    """Contours at or above the floor; if there are none, the highest alone."""
    top = F.broadcast(contours.agg(F.max("value").alias("_top")))  # one row
    return contours.crossJoin(top).where((F.col("value") >= floor) | ((F.col("_top") < floor) & (F.col("value") == F.col("_top")))).drop("_top")


def documents(df: DataFrame, required: list[str]) -> DataFrame:
    """(id, json) of each row; raises when run if a required field is null."""
    missing = F.array_compact(F.array(*[F.when(F.col(c).isNull(), F.lit(c)) for c in required]))
    body = F.to_json(F.struct(*df.columns))
    return df.select("id", F.when(F.size(missing) > 0, F.raise_error(F.concat(F.lit("report without "), F.array_join(missing, ", ")))).otherwise(body).alias("json"))


def index(reports: DataFrame) -> DataFrame:
    """One line for each report, newest first, without its lists."""
    flat = [c for c, t in reports.dtypes if not t.startswith("array")]
    return reports.select(*flat).orderBy(F.desc("ts"), F.desc("id"))


def measurements(cells: DataFrame, version: str = "", sums: tuple[str, ...] = (), sections: dict[str, DataFrame] | None = None) -> DataFrame:
    """One JSON document of what a build measured: a summary of its cells, and a section from each one-row frame."""
    total = lambda c: F.sum(F.col(c).cast("decimal(28,6)")).cast("double").alias(c)
    counted = [F.sum(c).alias(c) for c in sums]
    one = cells.agg(F.count("*").alias("cells"), total("pop_total"), *counted, F.countDistinct("adm2_id").alias("municipalities"))
    doc = one.select(F.struct(*one.columns).alias("summary"))
    for name, part in (sections or {}).items():
        doc = doc.crossJoin(F.broadcast(part.select(F.struct(*part.columns).alias(name))))  # one row each
    return doc.select(F.to_json(F.struct(F.lit(version).alias("version"), *doc.columns)).alias("json"))


def admin_lookup(lookup: DataFrame, path: str) -> None:
    """The side table of municipality names, small enough for one file, in order of its key."""
    lookup.coalesce(1).sortWithinPartitions("adm2_id").write.mode("overwrite").option("compression", "zstd").parquet(path)


def schema_finding(fields: dict[str, tuple[str, ...] | None], columns: list[str]) -> Column:
    """The first way in which a row breaks a closed schema; null if none. fields: name to its values, None for any.

    Columns outside the schema are an error at once.
    """
    if unknown := sorted(set(columns) - set(fields)):
        raise ValueError(f"fields outside the schema: {', '.join(unknown)}")
    found = [F.when(F.col(c).isNull(), F.lit(f"{c} missing")) for c in fields if c in columns] + [F.lit(f"{c} missing") for c in fields if c not in columns]
    found += [F.when(F.col(c).isNotNull() & ~F.col(c).isin(*values), F.lit(f"{c} outside its values")) for c, values in fields.items() if values and c in columns]
    return F.coalesce(*found)


def xml_grid(rows: DataFrame, by: str, fields: tuple[str, ...] = ("lon", "lat", "mmi")) -> DataFrame:
    """(by, value): the XML grid text of each group of points, from north to south and in a row from west to east.

    A group is one file's grid: its points and its text are held whole in one task.
    """
    line = F.concat_ws(" ", *[F.col(c).cast("string") for c in fields])
    points = F.array_sort(F.collect_list(F.struct((-F.col("lat")).alias("south"), "lon", line.alias("line"))))
    ends = [F.format_string(f'{n}_{k}="%s"', f(n).cast("string")) for n in ("lon", "lat") for k, f in (("min", F.min), ("max", F.max))]
    counts = [F.format_string(f'n{n}="%d"', F.count_distinct(n)) for n in ("lon", "lat")]
    names = "".join(f'<grid_field index="{i}" name="{c.upper()}"/>' for i, c in enumerate(fields, 1))
    data = F.array_join(F.transform(points, lambda p: p["line"]), "\n")
    return rows.groupBy(by).agg(F.concat(F.lit("<grid><grid_specification "), F.concat_ws(" ", *ends, *counts), F.lit(f"/>{names}<grid_data>\n"), data, F.lit("\n</grid_data></grid>")).alias("value"))


def _hex(value: Column | int, octets: int) -> Column:
    """A number without sign in so many octets, as hexadecimal text."""
    value = F.lit(value) if isinstance(value, int) else value
    return F.lpad(F.hex(value.cast("long")), 2 * octets, "0")


def grib2_message(packed: Column, ni: int, nj: int, north: int, west: int, step: int, category: int, number: int, ten: int = 0) -> Column:
    """A GRIB2 message as binary: ni by nj integers of 16 bits from north to south, nulls left out by the bitmap.

    Regular grid, simple packing: a value is its integer / 10**ten. north, west and step are in millionths of a degree.
    """
    known = F.filter(packed, lambda v: v.isNotNull())
    bits = F.array_join(F.transform(packed, lambda v: F.when(v.isNull(), "0").otherwise("1")), "")
    octets = -(-ni * nj // 8)
    padded = F.rpad(bits, 8 * octets, "0")
    bitmap = F.concat(*[F.lpad(F.conv(F.substring(padded, 8 * i + 1, 8), 2, 16), 2, "0") for i in range(octets)])
    zeros = lambda n: F.lit("00" * n)
    body = F.concat(
        _hex(21, 4), F.lit("01"), zeros(16),
        _hex(72, 4), F.lit("03"), zeros(1), _hex(ni * nj, 4), zeros(20), _hex(ni, 4), _hex(nj, 4), zeros(8), _hex(north, 4), _hex(west, 4), zeros(9), _hex(step, 4), _hex(step, 4), zeros(1),
        _hex(34, 4), F.lit("04"), zeros(4), _hex(category, 1), _hex(number, 1), zeros(23),
        _hex(21, 4), F.lit("05"), _hex(F.size(known), 4), zeros(2), zeros(4), zeros(2), _hex(ten, 2), _hex(16, 1), zeros(1),
        _hex(6 + octets, 4), F.lit("06"), zeros(1), bitmap,
        _hex(5 + 2 * F.size(known), 4), F.lit("07"), F.array_join(F.transform(known, lambda v: _hex(v, 2)), ""),
        F.hex(F.lit("7777")),
    )
    return F.unhex(F.concat(F.hex(F.lit("GRIB")), F.lit("00000002"), _hex(16 + F.length(body) / 2, 8), body))
