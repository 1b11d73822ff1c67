"""Catalogue-driven Parquet scans: files chosen by their listed extents, rows by a filter on nested boxes that reaches the scan."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lahar.functions import geo

Box = tuple[float, float, float, float]


def _flat(extent: Column) -> Column:
    """west, south, east, north of an extent of four numbers, or of six with heights in between; else an error."""
    four, six = F.size(extent) == 4, F.size(extent) == 6
    bad = F.raise_error(F.concat(F.lit("extent of neither four nor six numbers: "), F.to_json(extent))).cast("array<double>")
    at = lambda *k: F.array(*[F.get(extent, F.lit(i)) for i in k])
    known = F.forall(extent, lambda v: v.isNotNull())
    return F.when(extent.isNull(), F.lit(None).cast("array<double>")).when(four & known, at(0, 1, 2, 3)).when(six & known, at(0, 1, 3, 4)).otherwise(bad)


def touches(extents: Column, box: Box) -> Column:
    """Whether a file's extents meet a box. Of several, the first is the union of the others, which then decide.

    A file without extents, or with a null one, is taken: nothing says that it holds nothing. An extent that crosses the date line (west
    beyond east) is taken as the two parts that it is.
    """
    west, south, east, north = box

    def meets(extent: Column) -> Column:
        e = _flat(extent)
        w, s, x, n = (F.get(e, F.lit(i)) for i in range(4))
        wide = F.when(w <= x, (w <= east) & (x >= west)).otherwise((w <= east) | (x >= west))
        return wide & (s <= north) & (n >= south)

    several = F.size(extents) > 1
    parts = F.when(several, F.slice(extents, F.lit(2), F.greatest(F.size(extents) - 1, F.lit(0)))).otherwise(extents)
    found = F.when(extents.isNull() | (F.size(extents) == 0), F.lit(True)).otherwise(meets(F.get(extents, F.lit(0))) & F.exists(parts, meets))
    return F.coalesce(found, F.lit(True))


def selected(catalog: DataFrame, box: Box) -> list[str]:
    """Paths of a catalogue (file, extents) whose extents meet the box: what a scan has to open, a path a file."""
    return [r.file for r in catalog.where(touches(F.col("extents"), box)).select("file").distinct().orderBy("file").collect()]


def scan(spark: SparkSession, catalog: DataFrame, box: Box, schema: str) -> DataFrame:
    """Rows of the catalogue's files whose bbox(xmin, ymin, xmax, ymax) meets the box; both filters are intersections.

    The schema is given, so no file is opened to plan; the filter is on plain nested fields, so that row groups outside
    the box are skipped by their statistics.
    """
    files = selected(catalog, box)
    if not files:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(*files).where(geo.boxes_intersect(F.col("bbox"), *box))
