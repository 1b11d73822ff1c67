"""Readers: fire CSV, event feeds, product details, contours, grids in XML and GRIB2, rasters by window, listings."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

#: The columns of a fire detection file, in order.
FIRE_COLUMNS = ("latitude", "longitude", "bright_ti4", "scan", "track", "acq_date", "acq_time", "satellite", "confidence", "version", "bright_ti5", "frp", "daynight")
FEATURES = "type string, features array<struct<id:string,properties:struct<mag:double,place:string,time:bigint,updated:bigint,detail:string,status:string,type:string,ids:string>,geometry:struct<coordinates:array<double>>>>"
CONTOURS = "type string, features array<struct<properties:struct<value:double,paramvalue:double,units:string,type:string>,geometry:struct<type:string,coordinates:array<array<array<double>>>>>>"
VERSIONS = "map<string,array<struct<status:string,preferredWeight:int,updateTime:bigint,properties:map<string,string>,contents:map<string,struct<url:string>>>>>"


def fires(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Detections with their file; rows without readable place or date have ok false, blank power is zero."""
    schema = ", ".join(f"{c} string" for c in FIRE_COLUMNS)
    raw = spark.read.schema(schema).option("header", True).option("mode", "PERMISSIVE").csv(path)
    num = lambda c: F.expr(f"try_cast(nullif(trim({c}), '') AS double)")
    stamp = F.try_to_timestamp(F.concat_ws(" ", "acq_date", F.lpad(F.trim("acq_time"), 4, "0")), F.lit("yyyy-MM-dd HHmm"))
    out = raw.select(
        num("longitude").alias("lon"), num("latitude").alias("lat"), stamp.alias("ts"), F.lower(F.trim("confidence")).alias("confidence"), F.coalesce(num("frp"), F.lit(0.0)).alias("frp"),
        num("bright_ti4").alias("brightness"), F.trim("satellite").alias("sensor"), F.input_file_name().alias("file"),
    )
    return out.withColumn("ok", F.col("lon").isNotNull() & F.col("lat").isNotNull() & F.col("ts").isNotNull())


def audit(rows: DataFrame, expected: DataFrame) -> DataFrame:
    """Of each expected file: failed (never read), empty (no good row) or read; and the rows skipped."""
    seen = rows.groupBy("file").agg(F.count_if("ok").alias("good"), F.count_if(~F.col("ok")).alias("bad"))
    both = expected.join(seen, "file", "left")
    status = F.when(F.col("good").isNull(), "failed").when(F.col("good") == 0, "empty").otherwise("read")
    return both.select("file", status.alias("status"), F.coalesce("bad", F.lit(0)).alias("skipped"))


def feed(texts: DataFrame, col: str = "value") -> DataFrame:
    """One row for each feature of GeoJSON feeds, bad ones flagged; a feed of which no feature is good fails."""
    parsed = texts.select(F.from_json(col, FEATURES).alias("f"))
    rows = parsed.select(F.explode("f.features").alias("x"))
    p, at = F.col("x.properties"), F.col("x.geometry.coordinates")
    out = rows.select(
        F.col("x.id").alias("id"), p["mag"].alias("mag"), p["place"].alias("place"), F.timestamp_millis(p["time"]).alias("ts"), p["type"].alias("kind"), p["status"].alias("status"),
        F.filter(F.split(F.coalesce(p["ids"], F.lit("")), ","), lambda v: v != "").alias("ids"), F.get(at, F.lit(0)).alias("lon"), F.get(at, F.lit(1)).alias("lat"), F.get(at, F.lit(2)).alias("depth"),
    )
    return out.withColumn("ok", F.col("id").isNotNull() & F.col("ts").isNotNull() & F.col("lon").isNotNull() & F.col("lat").isNotNull())


def assert_some_good(rows: DataFrame) -> DataFrame:
    """rows' good ones; raises when run if there are rows and none is good."""
    sums = rows.agg(F.count("*").alias("n"), F.count_if("ok").alias("good"))
    check = sums.select(F.when((F.col("n") > 0) & (F.col("good") == 0), F.raise_error(F.lit("no feature of the feed can be read"))).alias("_e"))
    return rows.where("ok").crossJoin(F.broadcast(check)).where(F.col("_e").isNull()).drop("_e")  # one row


def polled(spark: SparkSession, feeds: dict) -> tuple[DataFrame, DataFrame]:
    """Several feeds read in one pass: the good features with their feed, and what became of each feed.

    feeds: name to a function that gives its texts. One that can't be opened is 'failed' and does not stop the others;
    one of which nothing is usable is told apart from one that is empty. Events of two feeds are deduplicated by id.
    """
    rows, failed = None, []
    for name, texts in feeds.items():
        try:
            own = feed(texts()).withColumn("feed", F.lit(name))
            rows = own if rows is None else rows.unionByName(own)
        except AnalysisException:
            failed.append(name)
    names = spark.createDataFrame([(n, n in failed) for n in feeds], "feed string, failed boolean")
    if rows is None:
        return spark.createDataFrame([], "feed string"), names.select("feed", F.lit("failed").alias("status"), F.lit(0).cast("long").alias("events"))
    seen = rows.groupBy("feed").agg(F.count("*").alias("n"), F.count_if("ok").alias("good"))
    both = names.join(seen, "feed", "left")
    status = F.when(F.col("failed"), "failed").when(F.coalesce("n", F.lit(0)) == 0, "empty").when(F.col("good") == 0, "nothing usable").otherwise("read")
    first = F.min_by(F.struct(*[c for c in rows.columns if c != "id"]), "feed").alias("r")
    return rows.where("ok").groupBy("id").agg(first).select("id", "r.*"), both.select("feed", status.alias("status"), F.coalesce("good", F.lit(0)).alias("events"))


def json_directory(spark: SparkSession, path: str, schema: str, whole: bool = True) -> DataFrame:
    """Every JSON document of a directory (one for each file, or for each line): its fields, file, raw text, and ok.

    Unreadable documents stay as rows with ok false, so that they can be counted and named.
    """
    texts = spark.read.text(path, wholetext=whole).withColumn("file", F.input_file_name())
    parsed = texts.select("file", F.col("value").alias("raw"), F.from_json("value", schema + ", _bad string", {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_bad"}).alias("j"))
    names = [f.split()[0] for f in schema.split(",")]
    ok = F.col("j").isNotNull() & F.col("j._bad").isNull()
    return parsed.select("file", "raw", ok.alias("ok"), *[F.when(ok, F.col(f"j.{c}")).alias(c) for c in names])


def from_arrow(spark: SparkSession, data: pa.Table) -> DataFrame:
    """An Arrow table as a relation, column by column without rows in between."""
    return spark.createDataFrame(data)


def geojson_rings(texts: DataFrame, col: str = "value") -> DataFrame:
    """(properties map, part, ring) of every polygon and multipolygon feature: a row for each ring, holes included."""
    feature = "struct<properties:map<string,string>,geometry:struct<type:string,coordinates:string>>"
    rows = texts.select(F.explode(F.from_json(col, f"features array<{feature}>")["features"]).alias("x"))
    point, g = "array<double>", F.col("x.geometry")
    parts = F.when(g["type"] == "MultiPolygon", F.from_json(g["coordinates"], f"array<array<array<{point}>>>")).when(g["type"] == "Polygon", F.array(F.from_json(g["coordinates"], f"array<array<{point}>>")))
    split = rows.select(F.col("x.properties").alias("properties"), F.posexplode(parts).alias("part", "rings")).select("properties", "part", F.explode("rings").alias("line"))
    return split.select("properties", "part", F.transform("line", lambda p: F.struct(p[0].alias("x"), p[1].alias("y"))).alias("ring"))


def product_versions(details: DataFrame, col: str = "value") -> DataFrame:
    """(event, product, contributor, status, weight, version, updated) of every version in event details."""
    text = F.col(col)
    parsed = details.select(F.get_json_object(text, "$.id").alias("event"), F.from_json(F.get_json_object(text, "$.properties.products"), VERSIONS).alias("m"))
    rows = parsed.select("event", F.explode("m").alias("product", "list")).select("event", "product", F.explode("list").alias("v"))
    return rows.select("event", "product", F.element_at("v.properties", "eventsource").alias("contributor"), F.col("v.status").alias("status"), F.col("v.preferredWeight").alias("weight"), F.expr("try_cast(element_at(v.properties, 'version') AS int)").alias("version"), F.col("v.updateTime").alias("updated"), F.map_keys("v.contents").alias("contents"))


def contours(texts: DataFrame, col: str = "value") -> DataFrame:
    """(value, ring) of intensity contours, lowest first; units decide, then the type, and neither is accepted."""
    rows = texts.select(F.explode(F.from_json(col, CONTOURS)["features"]).alias("x"))
    kind = F.lower(F.coalesce("x.properties.units", "x.properties.type", F.lit("mmi")))
    value = F.coalesce("x.properties.value", "x.properties.paramvalue")
    lines = rows.where((kind == "mmi") & value.isNotNull()).select(value.alias("value"), F.explode("x.geometry.coordinates").alias("line"))
    return lines.select("value", F.transform("line", lambda p: F.struct(p[0].alias("x"), p[1].alias("y"))).alias("ring")).orderBy("value")


def xml_points(texts: DataFrame, col: str = "value") -> DataFrame:
    """(*others, lon, lat, mmi) of XML grids, a whole text each: fields name the columns, data is one point for each line.

    A grid without specification, or whose rows aren't as many as it says or don't run from its north-west corner to its
    south-east one, is an error when run: read the wrong way round it would give plausible values elsewhere.
    """
    others = [c for c in texts.columns if c != col]
    spec = F.regexp_extract(col, r"<grid_specification([^>]*)>", 1)
    said = lambda n: F.nullif(F.regexp_extract(spec, rf'\b{n}="([^"]+)"', 1), F.lit("")).cast("double")
    names = F.transform(F.regexp_extract_all(col, F.lit(r'<grid_field[^>]*?name="([^"]+)"'), F.lit(1)), F.upper)
    lines = F.filter(F.split(F.regexp_extract(col, r"(?s)<grid_data>(.*?)</grid_data>", 1), r"\s*\n\s*"), lambda x: F.trim(x) != "")
    rows = texts.select(*others, spec.alias("spec"), *[said(n).alias(n) for n in ("lon_min", "lon_max", "lat_min", "lat_max", "nlon", "nlat")], names.alias("names"), lines.alias("lines"))
    field = lambda line, n: F.element_at(F.split(F.trim(line), r"\s+"), F.array_position("names", F.lit(n)).cast("int")).cast("double")
    at = lambda place, n, want: F.abs(field(F.element_at("lines", place), n) - F.col(want)) < 1e-6
    corners = at(1, "LON", "lon_min") & at(1, "LAT", "lat_max") & at(-1, "LON", "lon_max") & at(-1, "LAT", "lat_min")
    wrong = (
        F.when(F.col("spec") == "", "no grid_specification")
        .when(~F.coalesce(F.size("lines") == F.col("nlon") * F.col("nlat"), F.lit(False)), "not as many rows as grid_specification says")
        .when(~F.coalesce(corners, F.lit(False)), "rows not in the order of grid_specification")
    )
    sound = rows.withColumn("lines", F.when(wrong.isNull(), F.col("lines")).otherwise(F.raise_error(F.concat(F.lit("XML grid: "), wrong))))
    points = sound.select(*others, "names", F.explode("lines").alias("line"))
    return points.select(*others, field(F.col("line"), "LON").alias("lon"), field(F.col("line"), "LAT").alias("lat"), field(F.col("line"), "MMI").alias("mmi"))


def xml_grid(spark: SparkSession, path: str) -> DataFrame:
    """(lon, lat, mmi) of XML grid files, see xml_points()."""
    return xml_points(spark.read.text(path, wholetext=True))


def hrefs(texts: DataFrame, col: str, suffix: str = ".tif") -> DataFrame:
    """Links of a directory page with a suffix, and the age band that their name holds."""
    rows = texts.select(F.explode(F.regexp_extract_all(col, F.lit(r'href="([^"]+)"'), F.lit(1))).alias("href")).where(F.col("href").endswith(suffix))
    band = F.regexp_extract("href", r"_([fmt])_(\d+)_", 2)
    return rows.withColumn("age", F.when(band != "", band.cast("int")))


def _bits(data: bytes, start: int, width: int, count: int) -> np.ndarray:
    bits = np.unpackbits(np.frombuffer(data, np.uint8)[start:])[: width * count].reshape(count, width)
    return bits.astype(np.int64) @ (1 << np.arange(width - 1, -1, -1, dtype=np.int64)) if width else np.zeros(count, np.int64)


def _sign_magnitude(b: bytes) -> int:
    v = int.from_bytes(b, "big")
    top = 1 << (8 * len(b) - 1)
    return -(v & (top - 1)) if v & top else v


def decode_grib2(data: bytes) -> Iterator[pd.DataFrame]:
    """(category, number, lon, lat, value) of each message: regular grids (template 3.0) with simple packing (5.0) only.

    value = (reference + packed * 2**E) / 10**D; points that a bitmap leaves out are NaN.
    """
    at = 0
    while at + 16 <= len(data) and data[at : at + 4] == b"GRIB":
        end = at + int.from_bytes(data[at + 8 : at + 16], "big")
        p, bitmap, kind = at + 16, None, (0, 0)
        while data[p : p + 4] != b"7777":
            size = int.from_bytes(data[p : p + 4], "big")
            if size < 5 or p + size > end:
                raise ValueError("GRIB2: a section without length or past the end of its message")
            number = data[p + 4]
            s = data[p : p + size]
            if number == 3:
                if int.from_bytes(s[12:14], "big") != 0:
                    raise ValueError("GRIB2: only regular latitude-longitude grids are read")
                ni, nj = int.from_bytes(s[30:34], "big"), int.from_bytes(s[34:38], "big")
                la1, lo1 = _sign_magnitude(s[46:50]) / 1e6, _sign_magnitude(s[50:54]) / 1e6
                di, dj, scan = int.from_bytes(s[63:67], "big") / 1e6, int.from_bytes(s[67:71], "big") / 1e6, s[71]
            elif number == 4:
                kind = (s[9], s[10])
            elif number == 5:
                if int.from_bytes(s[9:11], "big") != 0:
                    raise ValueError("GRIB2: only simple packing is read")
                packed, ref = int.from_bytes(s[5:9], "big"), np.frombuffer(s[11:15], ">f4")[0]
                two, ten, width = _sign_magnitude(s[15:17]), _sign_magnitude(s[17:19]), s[19]
            elif number == 6 and s[5] == 0:
                bitmap = np.unpackbits(np.frombuffer(s[6:], np.uint8))[: ni * nj].astype(bool)
            elif number == 7:
                values = (float(ref) + _bits(s, 5, width, packed) * 2.0**two) / 10.0**ten
                full = np.full(ni * nj, np.nan)
                full[bitmap if bitmap is not None else slice(None)] = values
                i, j = np.tile(np.arange(ni), nj), np.repeat(np.arange(nj), ni)
                lon = (lo1 + i * di * (-1 if scan & 128 else 1) + 180) % 360 - 180
                lat = la1 + j * dj * (1 if scan & 64 else -1)
                yield pd.DataFrame({"category": kind[0], "number": kind[1], "lon": lon, "lat": lat, "value": full})
            p += size
        at = end


def grib2_values(files: DataFrame) -> DataFrame:
    """(file, category, number, lon, lat, value) of GRIB2 contents (path, content), a file each at a time in a task."""

    def run(batches):
        for batch in batches:
            for name, content in zip(batch["path"], batch["content"], strict=True):
                for df in decode_grib2(bytes(content)):
                    yield df.assign(file=name)[["file", "category", "number", "lon", "lat", "value"]]

    return files.select(F.col("path").cast("string").alias("path"), "content").mapInPandas(run, "file string, category int, number int, lon double, lat double, value double")


def grib2(spark: SparkSession, path: str) -> DataFrame:
    """All grid values of GRIB2 files."""
    return grib2_values(spark.read.format("binaryFile").load(path))


class _Window(InputPartition):
    def __init__(self, first: int, rows: int):
        self.first, self.rows = first, rows


class AsciiRaster(DataSource):
    """spark.read.format("ascii_raster").load(path): pixels (lon, lat, value) of a text raster, a window of rows each task.

    Options: rows (of a window, 512). Points are pixel centres; nodata pixels are left out. A path must be readable
    on every executor; tables that only Spark can open go through pixel Parquet instead.
    """

    @classmethod
    def name(cls) -> str:
        return "ascii_raster"

    def schema(self) -> str:
        return "lon double, lat double, value double"

    def reader(self, schema) -> DataSourceReader:
        return _RasterReader(self.options)


class _RasterReader(DataSourceReader):
    def __init__(self, options):
        self.path, self.window = options["path"].removeprefix("file:"), int(options.get("rows", 512))

    def _head(self, f) -> dict[str, float]:
        return {k.lower(): float(v) for k, v in (f.readline().split() for _ in range(6))}

    def partitions(self):
        with open(self.path) as f:
            rows = int(self._head(f)["nrows"])
        return [_Window(i, min(self.window, rows - i)) for i in range(0, rows, self.window)]

    def read(self, partition: _Window):
        with open(self.path) as f:
            h = self._head(f)
            top = h["yllcorner"] + h["nrows"] * h["cellsize"]
            for r, line in enumerate(f):
                if partition.first <= r < partition.first + partition.rows:
                    lat = top - (r + 0.5) * h["cellsize"]
                    for c, v in enumerate(map(float, line.split())):
                        if v != h["nodata_value"]:
                            yield h["xllcorner"] + (c + 0.5) * h["cellsize"], lat, v
