"""Precinct layers: blocks gathered by precinct, with labels from the returns and, where blocks have outlines, their own."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from apportion.functions import text as T

from . import geo
from .contest import label_mode


def labels(ballots: DataFrame) -> DataFrame:
    """(county, code, label): the most frequent label of each precinct code in the returns."""
    own = ballots.select(T.normal_key(F.col("county")).alias("county"), T.precinct_code_of_label(F.col("precinct")).alias("code"), F.col("precinct")).where("county != '' AND code != ''")
    return label_mode(own.withColumn("label", T.precinct_label(F.col("precinct"), F.col("code"))), ["county", "code"], "label")


def precincts(blocks: DataFrame, assignment: DataFrame, counties: DataFrame, names: DataFrame) -> DataFrame:
    """One row for each precinct, numbered in order of county and code: its blocks' area, name and key.

    blocks (BLOCKID, weight), assignment (BLOCKID, COUNTYFP, DISTRICT), counties (countyfp, county), names as labels()
    gives them. A code with a leading 5 that only the short code's returns know takes the short code.
    """
    own = blocks.join(assignment, "BLOCKID").groupBy(F.lpad("COUNTYFP", 3, "0").alias("countyfp20"), F.col("DISTRICT").alias("district_raw")).agg(F.sum("weight").alias("area"))
    named = own.join(counties.select(F.col("countyfp").alias("countyfp20"), F.upper("county").alias("county_nam")), "countyfp20", "left").withColumn("county_nam", F.coalesce("county_nam", "countyfp20"))
    coded = named.withColumn("long", T.precinct_code(F.col("district_raw"))).withColumn("short", F.regexp_replace(F.regexp_replace("long", r"^5(?=\d{2,}$)", ""), r"^0+(?=\d)", ""))
    for side in ("long", "short"):
        known = names.select(F.col("county").alias("county_nam"), F.col("code").alias(side), F.lit(True).alias(f"has_{side}"))
        coded = coded.join(known, ["county_nam", side], "left")
    code = T.legacy_code(F.col("long"), F.coalesce("has_short", F.lit(False)), F.coalesce("has_long", F.lit(False)))
    full = coded.select("countyfp20", "district_raw", "county_nam", code.alias("prec_id"), "area").join(names.select(F.col("county").alias("county_nam"), F.col("code").alias("prec_id"), "label"), ["county_nam", "prec_id"], "left")
    name = F.coalesce("label", F.concat(F.col("prec_id"), F.lit(" - VTD "), F.col("district_raw")))
    # Numbers run over counties in order; a county's precincts are few, so the windows are small.
    counted = full.groupBy("countyfp20").agg(F.count("*").alias("n"))
    before = counted.select("countyfp20", F.coalesce(F.sum("n").over(Window.orderBy("countyfp20").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("before"))
    place = F.col("before") + F.row_number().over(Window.partitionBy("countyfp20").orderBy("prec_id", "district_raw"))
    return full.join(before, "countyfp20").select(place.cast("int").alias("id"), "countyfp20", "district_raw", "county_nam", "prec_id", name.alias("precinct_name"), T.precinct_key(F.col("county_nam"), F.col("prec_id")).alias("precinct_norm"), "area")


def outlines(blocks: DataFrame, assignment: DataFrame) -> DataFrame:
    """(countyfp20, district_raw, rings): each precinct's outline, of blocks (BLOCKID, rings) that share their borders' points."""
    own = blocks.select("BLOCKID", "rings").join(assignment, "BLOCKID")
    return geo.dissolve(own.select(F.lpad("COUNTYFP", 3, "0").alias("countyfp20"), F.col("DISTRICT").alias("district_raw"), "rings"), "countyfp20", "district_raw")


def outlined(layer: DataFrame, rings: DataFrame) -> DataFrame:
    """A layer as precincts() gives it, with the rings that outlines() gives; none where a precinct's blocks have no outline."""
    joined = layer.join(rings, ["countyfp20", "district_raw"], "left")
    return joined.select(*layer.columns, F.coalesce("rings", F.array().cast(geo.RINGS)).alias("rings"))
