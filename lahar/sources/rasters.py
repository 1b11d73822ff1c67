"""Text rasters read by Spark's own splits, and categorical rasters at an overview level."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

HEAD = ("ncols", "nrows", "xllcorner", "yllcorner", "cellsize", "nodata_value")


def numbered_lines(spark: SparkSession, path: str) -> DataFrame:
    """(line_no, value): the lines of one text file with their number from 0, whatever splits it is read in.

    Lines are counted by split in a first pass; a line's number is its place in its split plus the lines of the splits
    before. Both passes read each byte once, and only a row for each split is sorted and broadcast.
    """
    # the running id is cut off from what the optimizer may move: it numbers rows as the scan gives them
    lines = spark.read.text(path).select(F.col("_metadata.file_block_start").alias("split"), "value", F.monotonically_increasing_id().alias("at"))
    splits = lines.groupBy("split").agg(F.count("*").alias("n"), F.min("at").alias("first"))
    before = F.sum("n").over(Window.orderBy("split").rowsBetween(Window.unboundedPreceding, -1))
    offsets = splits.select("split", (F.coalesce(before, F.lit(0)) - F.col("first")).alias("shift"))
    return lines.join(F.broadcast(offsets), "split").select((F.col("at") + F.col("shift")).alias("line_no"), "value")


def header(spark: SparkSession, path: str) -> dict[str, float]:
    """The six values of a text raster's head; an error if one is missing."""
    rows = numbered_lines(spark, path).where(F.col("line_no") < len(HEAD)).collect()  # six lines
    got = {p[0].lower(): float(p[1]) for r in rows if len(p := r.value.split()) == 2}
    if missing := [h for h in HEAD if h not in got]:
        raise ValueError(f"text raster without {', '.join(missing)}")
    return got


def text_raster(spark: SparkSession, path: str, rows: tuple[int, int] | None = None) -> DataFrame:
    """(row, col, lon, lat, value) of each pixel that has a value, at its centre; of a window of rows [first, end) if given.

    Rows count from the north. Any path that Spark opens will do, and large files are read in splits side by side.
    """
    h = header(spark, path)
    row = F.col("line_no") - len(HEAD)
    lines = numbered_lines(spark, path).where(F.col("line_no") >= len(HEAD)).select(row.alias("row"), "value").where(F.col("row") < h["nrows"])
    if rows:
        lines = lines.where((F.col("row") >= rows[0]) & (F.col("row") < rows[1]))
    px = lines.select("row", F.posexplode(F.split(F.trim("value"), r"\s+")).alias("col", "v")).withColumn("value", F.col("v").cast("double"))
    top = h["yllcorner"] + h["nrows"] * h["cellsize"]
    lon, lat = h["xllcorner"] + (F.col("col") + 0.5) * h["cellsize"], top - (F.col("row") + 0.5) * h["cellsize"]
    return px.where(F.col("value") != h["nodata_value"]).select("row", "col", lon.alias("lon"), lat.alias("lat"), "value")


def overview(pixels: DataFrame, factor: int, groups: dict[int, str], nodata: int | None = None, keys: tuple[str, ...] = ()) -> DataFrame:
    """(keys, row, col, code, class): the commonest code of each block of factor by factor pixels, and its group.

    pixels: keys, row, col, code. Ties go to the smallest code. Blocks of nodata alone are left out; codes outside the
    groups keep a null class, so they are seen and not taken for anything. Counts combine before the shuffle.
    """
    kept = pixels.where(F.col("code").isNotNull() & (F.lit(True) if nodata is None else F.col("code") != nodata))
    block = [F.floor(F.col(c) / factor).alias(c) for c in ("row", "col")]
    counts = kept.groupBy(*keys, *block, "code").agg(F.count("*").alias("n"))
    mode = counts.groupBy(*keys, "row", "col").agg(F.max_by("code", F.struct("n", -F.col("code"))).alias("code"))
    named = F.create_map(*[F.lit(x) for kv in groups.items() for x in kv])
    return mode.withColumn("class", F.element_at(named, F.col("code")))


def class_counts(cells: DataFrame, pixels: DataFrame, tiles: DataFrame, tile: Column) -> DataFrame:
    """(cell, class, n, status): pixels of each class by cell; cells without any are told apart by their tile.

    cells: cell and what `tile` reads; pixels: cell, class; tiles: tile, those that were there to read. A cell in a tile
    that was read and has no pixel is 'ocean', one in a tile that was not is 'missing': nothing is known of it.
    """
    counts = pixels.groupBy("cell", "class").agg(F.count("*").alias("n"))
    there = tiles.select("tile", F.lit(True).alias("_there")).distinct()
    both = cells.withColumn("tile", tile).join(there, "tile", "left").join(counts, "cell", "left")
    status = F.when(F.col("n").isNotNull(), "measured").when(F.col("_there"), "ocean").otherwise("missing")
    return both.select("cell", "class", F.coalesce("n", F.lit(0)).alias("n"), status.alias("status"))
