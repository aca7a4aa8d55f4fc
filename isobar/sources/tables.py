"""Text products as rows: inventories with byte ranges, sectioned and comma-laden files, day files, documents of features."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def numbered_lines(spark: SparkSession, path: str) -> DataFrame:
    """(file, n, line): lines with their number in their file. Each file is read whole, so numbers hold whatever the splits."""
    files = spark.read.text(path, wholetext=True).select(F.input_file_name().alias("file"), F.posexplode(F.split("value", "\r?\n")).alias("n", "line"))
    return files.where("line <> ''")


def inventory(lines: DataFrame) -> DataFrame:
    """(file, n, start, length, var, level, info) of lines ``n:offset:d=...:VAR:LEVEL:INFO:``; the last one's length is null."""
    parts = F.split("line", ":")
    rows = lines.select("file", F.get(parts, F.lit(0)).cast("double").alias("n"), F.get(parts, F.lit(1)).cast("long").alias("start"), F.get(parts, F.lit(3)).alias("var"), F.get(parts, F.lit(4)).alias("level"), F.get(parts, F.lit(5)).alias("info"))
    after = F.lead("start").over(Window.partitionBy("file").orderBy("start"))
    return rows.withColumn("length", after - F.col("start"))


def wanted_ranges(rows: DataFrame, wanted: DataFrame) -> DataFrame:
    """(file, start, end, messages): byte ranges of the wanted (var, level), neighbours merged; an open end is null."""
    hits = rows.join(wanted, ["var", "level"], "left_semi")
    w = Window.partitionBy("file").orderBy("start")
    marked = hits.withColumn("_new", F.when(F.lag(F.col("start") + F.col("length")).over(w) == F.col("start"), 0).otherwise(1))
    islands = marked.withColumn("_i", F.sum("_new").over(w.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    ends = F.when(F.bool_or(F.col("length").isNull()), None).otherwise(F.max(F.col("start") + F.col("length")) - 1)
    return islands.groupBy("file", "_i").agg(F.min("start").alias("start"), ends.alias("end"), F.count("*").alias("messages")).drop("_i")


def sectioned(lines: DataFrame, headers: dict[str, str]) -> DataFrame:
    """(file, n, section, line): data lines with the section that the last header line (``headers``: line start to name) opened."""
    name = F.lit(None).cast("string")
    for start, section in headers.items():
        name = F.when(F.col("line").startswith(start), F.lit(section)).otherwise(name)
    w = Window.partitionBy("file").orderBy("n").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    marked = lines.withColumn("_header", name).withColumn("section", F.last("_header", ignorenulls=True).over(w))
    return marked.where("_header is null and section is not null").drop("_header")


def storm_events(rows: DataFrame, day: Column) -> DataFrame:
    """(file, n, section, t, magnitude, lat, lon) of sectioned ``time,magnitude,place,county,state,lat,lon,text`` lines: times before 12 UTC are of the day after."""
    parts = F.split("line", ",", 8)
    hhmm = F.get(parts, F.lit(0))
    minutes = F.substring(hhmm, 1, 2).try_cast("int") * 60 + F.substring(hhmm, 3, 2).try_cast("int")
    at = F.timestamp_seconds(F.unix_date(day) * F.lit(86_400) + (minutes + F.when(minutes < 720, 1440).otherwise(0)) * 60)
    number = lambda k: F.get(parts, F.lit(k)).try_cast("double")
    return rows.select("file", "n", "section", at.alias("t"), number(1).alias("magnitude"), number(5).alias("lat"), number(6).alias("lon"))


def trailing_fields(lines: DataFrame, first: list[str], last: list[str], free: str) -> DataFrame:
    """Columns of comma-separated lines whose free text may hold commas: some are counted from the start, some from the end."""
    parts = F.split("line", ",")
    n = F.size(parts)
    middle = F.array_join(F.slice(parts, F.lit(len(first) + 1), F.greatest(n - len(first) - len(last), F.lit(0))), ",")
    columns = [F.get(parts, F.lit(k)).alias(c) for k, c in enumerate(first)] + [F.get(parts, n - len(last) + k).alias(c) for k, c in enumerate(last)]
    return lines.where(n >= len(first) + len(last)).select("file", "n", *columns, middle.alias(free))


def day_files(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """JSON lines, gzipped or not; broken lines are left out."""
    rows = spark.read.schema(f"{schema}, _broken string").option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", "_broken").json(path)
    return rows.where("_broken is null").drop("_broken")


def quoted_csv(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Comma-separated files with a header; quoted fields may hold commas, quotes and line breaks."""
    return spark.read.schema(schema).option("header", True).option("multiLine", True).option("quote", '"').option("escape", '"').csv(path)


def features(documents: DataFrame, column: str = "value") -> DataFrame:
    """(kind, properties, rings) per distinct feature of GeoJSON documents; polygons and multi-polygons as rings, lines as one."""
    shape = "features array<struct<type string, properties map<string,string>, geometry struct<type string, coordinates string>>>"
    rows = documents.select(F.explode(F.from_json(column, shape)["features"]).alias("f")).select("f.geometry.type", "f.geometry.coordinates", "f.properties")
    one = F.from_json("coordinates", "array<array<double>>")
    ring = F.when(F.col("type") == "LineString", F.array(one)).when(F.col("type") == "Polygon", F.from_json("coordinates", "array<array<array<double>>>")).when(F.col("type").isin("MultiPolygon"), F.flatten(F.from_json("coordinates", "array<array<array<array<double>>>>")))
    points = F.transform(ring, lambda r: F.transform(r, lambda p: F.struct(F.get(p, F.lit(0)).alias("x"), F.get(p, F.lit(1)).alias("y"))))
    return rows.select(F.col("type").alias("kind"), F.to_json("properties").alias("properties"), points.alias("rings")).where("rings is not null").distinct()


def placemarks(spark: SparkSession, path: str) -> DataFrame:
    """(name, description, rings) of KML placemarks."""
    row = "name string, description string, Polygon struct<outerBoundaryIs: struct<LinearRing: struct<coordinates: string>>>"
    rows = spark.read.format("xml").option("rowTag", "Placemark").schema(row).load(path)
    pairs = F.split(F.trim("Polygon.outerBoundaryIs.LinearRing.coordinates"), r"\s+")
    point = lambda p: F.struct(F.split(p, ",")[0].cast("double").alias("x"), F.split(p, ",")[1].cast("double").alias("y"))
    return rows.select("name", "description", F.transform(pairs, point).alias("ring"))


def index_entries(lines: DataFrame, wanted: dict[str, tuple[str, ...]], column: str = "line") -> DataFrame:
    """The columns of ``lines`` with start, end and ``attributes`` of index lines, a JSON object each with _offset, _length and attributes.

    An entry is wanted if each attribute in ``wanted`` has one of its values; an entry without the attribute isn't. The end is the
    last byte. Lines that are no JSON object, or without a place, are left out.
    """
    found = lines.withColumn("attributes", F.from_json(column, "map<string,string>")).where("attributes is not null")
    of = lambda name: F.try_element_at(F.col("attributes"), F.lit(name))
    for name, values in wanted.items():
        found = found.where(F.coalesce(of(name).isin(*values), F.lit(False)))
    start, length = of("_offset").try_cast("long"), of("_length").try_cast("long")
    return found.select(*lines.columns, start.alias("start"), (start + length - 1).alias("end"), "attributes").where("start is not null and end is not null")


def csv_fields(lines: DataFrame, schema: str, column: str = "line") -> DataFrame:
    """The columns of ``lines`` with the fields of one comma-separated line; quoted fields may hold commas, line breaks and doubled quotes."""
    return lines.select(*lines.columns, F.from_csv(column, schema, {"quote": '"', "escape": '"', "mode": "PERMISSIVE", "multiLine": "true"}).alias("_f")).select(*lines.columns, "_f.*")


def placemarks_of(documents: DataFrame, column: str = "value") -> DataFrame:
    """(name, description, ring) of the placemarks in KML documents; documents without one, or broken ones, have none."""
    row = "Document struct<Placemark: array<struct<name: string, description: string, Polygon: struct<outerBoundaryIs: struct<LinearRing: struct<coordinates: string>>>>>>"
    marks = documents.select(F.explode(F.from_xml(column, row)["Document"]["Placemark"]).alias("p"))
    pairs = F.filter(F.split(F.trim("p.Polygon.outerBoundaryIs.LinearRing.coordinates"), r"\s+"), lambda x: x != "")
    point = lambda p: F.struct(F.get(F.split(p, ","), F.lit(0)).try_cast("double").alias("x"), F.get(F.split(p, ","), F.lit(1)).try_cast("double").alias("y"))
    return marks.select("p.name", "p.description", F.transform(pairs, point).alias("ring"))


def feed_items(documents: DataFrame, column: str = "value") -> DataFrame:
    """The columns of ``documents`` with title, text, link and ``published`` (null where it is no date) of every item of an RSS feed.

    A description's markup is taken out, its line breaks stay; broken feeds have no items.
    """
    row = "channel struct<item: array<struct<title: string, description: string, link: string, pubDate: string>>>"
    kept = [c for c in documents.columns if c != column]
    items = documents.select(*kept, F.explode(F.from_xml(column, row)["channel"]["item"]).alias("i")).select(*kept, "i.*")
    broken = F.regexp_replace(F.coalesce("description", F.lit("")), r"(?i)<br\s*/?>", "\n")
    day = F.regexp_extract("pubDate", r"(\d{1,2} [A-Z][a-z]{2} \d{4} \d\d:\d\d:\d\d)", 1)
    published = F.try_to_timestamp(F.nullif(day, F.lit("")), F.lit("d MMM yyyy HH:mm:ss"))
    return items.select(*kept, F.trim("title").alias("title"), F.trim(F.regexp_replace(broken, "<[^>]+>", "")).alias("text"), F.trim("link").alias("link"), published.cast("timestamp_ntz").alias("published"))
