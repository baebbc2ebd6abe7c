"""Polygon layers in zipped shapefiles, and published slices as rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from apportion.operators import geo

from . import archives

RESULT = "struct<dem_votes: long, rep_votes: long, other_votes: long, total_votes: long, dem_candidate: string, rep_candidate: string, winner: string, margin: long, margin_pct: double, color: string>"
SLICE = f"meta struct<scope: string, contest_type: string, year: int>, general struct<results: map<string, {RESULT}>>"


def zipped_shapes(spark: SparkSession, path: str, attributes: tuple[str, ...], with_rings: bool = True, split_bytes: int = archives.SPLIT_BYTES) -> DataFrame:
    """Attributes (as text; missing ones are empty) and rings of each record of zipped shapefiles, a folder's or one's; a layer
    is read by a task for each `split_bytes` of it. Without rings only the attribute table is read. Rings carry the reference
    system that the layer describes, if it is known.
    """
    spark.dataSource.register(archives.ZippedShapes)
    schema = ", ".join([*(f"`{a}` string" for a in attributes), *(["rings array<array<struct<x: double, y: double>>>"] if with_rings else [])])
    rows = spark.read.format("zipped_shapes").schema(schema).option("splitBytes", split_bytes).load(path)
    system = archives.system_of(path) if with_rings else None
    return rows if system is None else geo.with_crs(rows, system)


def slices(spark: SparkSession, path: str) -> DataFrame:
    """District rows of published slice files, with their keys."""
    raw = spark.read.schema(SLICE).option("multiLine", True).option("pathGlobFilter", "*_*_*.json").json(path).where("meta.scope IS NOT NULL")
    return raw.select("meta.*", F.explode("general.results").alias("district", "r")).select("scope", "contest_type", "year", "district", "r.*")
