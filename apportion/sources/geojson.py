"""GeoJSON layers, both ways: collections and feature sequences as rows, and rows as one collection.

A file is cut where a feature says that it is one ("Feature", in quotes), by Spark's own splits of text, so a large layer is the
work of many tasks whether it has a line for each feature or is one line; so can the parts of write_collection() be. A writer that puts other members of a feature
before its type can't be read so; `whole` reads such files, one task each. What can't be read raises an error.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from apportion.operators.geo import RINGS, polygons

from .order import row_numbers

FEATURE = "struct<type: string, properties: map<string, string>, geometry: string, id: string>"
MARK = '"Feature"'


def read(spark: SparkSession, path: str | list[str], whole: bool = False) -> DataFrame:
    """(properties map, geometry as JSON, id) of each feature; ValueError-like errors of Spark for text that is no GeoJSON."""
    if whole:
        raw = spark.read.option("wholetext", True).text(path)
        each = F.from_json("value", f"struct<type: string, features: array<{FEATURE}>>")
        found = raw.select(F.when(each["type"].eqNullSafe("FeatureCollection"), each["features"]).otherwise(F.raise_error(F.concat(F.lit("no collection of features: "), F.col("_metadata.file_path")))).alias("features"))
        return found.select(F.explode("features").alias("f")).select("f.properties", "f.geometry", "f.id")
    chunks = spark.read.option("lineSep", MARK).text(path).select("value", F.col("_metadata.file_path").alias("path"), F.ltrim(F.regexp_replace("value", r"^[\s\x{FEFF}]+", "")).alias("own"))
    # What comes before a file's first feature begins with a brace; what comes after a feature's type with a comma and a member. A part
    # of a collection goes on with a comma and a feature, or only ends it.
    end = F.substring("own", -200, 200)
    onward = F.col("own").rlike(r'^(,\s*\{\s*"type"\s*:|\]\s*\})\s*$')
    head = F.col("own").startswith("{") | (F.col("own") == "") | onward
    next_one = end.rlike(r'"type"\s*:\s*$')
    f = F.from_json(F.concat(F.lit('{"type":"Feature"'), F.col("own")), FEATURE)
    good_head = (F.col("own") == "") | onward | F.col("own").rlike(r'^\{\s*"type"\s*:\s*$') | F.col("own").contains('"FeatureCollection"')
    good = ~F.col("own").startswith("[") & f["type"].isNotNull() & (~next_one | end.rlike(r'\{\s*"type"\s*:\s*$'))
    bad = F.raise_error(F.concat(F.lit("no GeoJSON, or features whose type is not their first member (whole=True reads those): "), F.col("path")))
    checked = chunks.select(F.when(head & good_head, F.lit(None).cast(FEATURE)).when(~head & good, f).otherwise(bad).alias("f"))
    return checked.where("f IS NOT NULL").select("f.properties", "f.geometry", "f.id")


def rings(geometry: Column) -> Column:
    """Rings of a Polygon or MultiPolygon, one after the other; no rings for other geometries and null."""
    kind = F.get_json_object(geometry, "$.type")
    one = F.from_json(F.get_json_object(geometry, "$.coordinates"), "array<array<array<double>>>")
    many = F.from_json(F.get_json_object(geometry, "$.coordinates"), "array<array<array<array<double>>>>")
    found = F.when(kind == "Polygon", one).when(kind == "MultiPolygon", F.flatten(many))
    points = F.transform(found, lambda r: F.transform(r, lambda p: F.struct(p[0].alias("x"), p[1].alias("y"))))
    return F.coalesce(points, F.array().cast(RINGS))


def polygon(of: Column) -> Column:
    """Rings as the JSON of a Polygon or, if they have several shells, of a MultiPolygon; null without any."""
    parts = F.transform(polygons(of), lambda p: F.transform(p, lambda r: F.transform(r, lambda x: F.array(x["x"], x["y"]))))
    one = F.to_json(F.struct(F.lit("Polygon").alias("type"), F.element_at(parts, 1).alias("coordinates")))
    return F.when(F.size(parts) == 1, one).when(F.size(parts) > 1, F.to_json(F.struct(F.lit("MultiPolygon").alias("type"), parts.alias("coordinates"))))


def point(lon: Column, lat: Column) -> Column:
    return F.struct(F.lit("Point").alias("type"), F.array(lon, lat).alias("coordinates"))


def features(df: DataFrame, geometry: str, *properties: str, keep: tuple[str, ...] = ()) -> DataFrame:
    """One feature a row, in column `feature`; `geometry` is a struct (type, coordinates) or GeoJSON text. Columns of `keep`
    stay, to order by. A property without a value is null."""
    shape = F.col(geometry)
    text = shape if dict(df.dtypes)[geometry] == "string" else F.to_json(shape)
    own = F.to_json(F.struct(*properties), {"ignoreNullFields": "false"}) if properties else F.lit("{}")
    return df.select(*keep, F.concat(F.lit('{"type":"Feature","properties":'), own, F.lit(',"geometry":'), F.coalesce(text, F.lit("null")), F.lit("}")).alias("feature"))


def write_features(rows: DataFrame, path: str) -> None:
    """One feature a line, which readers of GeoJSON sequences take."""
    rows.select("feature").write.mode("overwrite").text(path)


def write_collection(rows: DataFrame, path: str, *order: str, one_file: bool = False) -> None:
    """A collection as parts that follow each other: `cat path/part-*` is one JSON value, features in the order given.

    Features are numbered by ranges of the order and sorted by ranges; the collection's head and tail are a line before the
    first and after the last. With `one_file` there is one part: one task writes it line by line, after a sort that spills.
    """
    numbered = row_numbers(rows.select(*order, "feature"), *order)
    lines = numbered.select(F.col("id").cast("long").alias("id"), F.concat(F.when(F.col("id") > 1, ",").otherwise(""), F.col("feature")).alias("value"))
    ends = rows.sparkSession.createDataFrame([(0, '{"type":"FeatureCollection","features":['), ((1 << 63) - 1, "]}")], "id long, value string")
    every = lines.unionByName(ends)
    out = every.coalesce(1).sortWithinPartitions("id") if one_file else every.orderBy("id")
    out.select("value").write.mode("overwrite").text(path)
