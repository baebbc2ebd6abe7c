"""Fractional crosswalks from precincts to districts, as long frames that joins can see.

A Crosswalk has three frames, each with `scope`: splits (county, code, district, share), county_weights (county,
district, share) and code_weights (county, code, weight). Shares of a precinct and of a county sum to one.
"""

from __future__ import annotations

import re
import warnings
from collections.abc import Callable
from dataclasses import dataclass

from py4j.protocol import Py4JJavaError
from pyspark.errors import AnalysisException, PySparkException
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from apportion.functions.settle import settle
from apportion.functions.text import district_id, office_class, precinct_code, precinct_code_of_label, locality_key


@dataclass(frozen=True)
class Crosswalk:
    splits: DataFrame
    county_weights: DataFrame
    code_weights: DataFrame

    def union(self, other: Crosswalk) -> Crosswalk:
        return Crosswalk(self.splits.unionByName(other.splits), self.county_weights.unionByName(other.county_weights), self.code_weights.unionByName(other.code_weights))


def shares(df: DataFrame, keys: list[str], value: str, into: str = "share") -> DataFrame:
    """Each row's part of its group's sum; rows that aren't above zero go."""
    return df.where(F.col(value) > 0).withColumn(into, F.col(value) / F.sum(value).over(Window.partitionBy(*keys)))


def from_areas(areas: DataFrame) -> Crosswalk:
    """Crosswalk from pieces (scope, county, code, district, weight) of precincts, codes and districts not yet normalised.

    A piece's share is of its raw precinct's total. Raw codes that come to the same code are averaged alike, and the
    code's weight is the greatest of their totals.
    """
    sums = areas.groupBy("scope", "county", F.col("code").alias("raw"), "district").agg(F.sum("weight").alias("weight"))
    raw = sums.withColumn("total", F.sum("weight").over(Window.partitionBy("scope", "county", "raw")))
    # All three frames come from these sums, which are settled once.
    every = settle(raw.select("scope", F.upper("county").alias("county"), precinct_code(F.col("raw")).alias("code"), district_id(F.col("district")).alias("district"), (F.col("weight") / F.col("total")).alias("part"), "total", "weight"))
    placed = every.where("county != '' AND district != ''")
    named = placed.where("code != '' AND part > 0")
    splits = shares(named.groupBy("scope", "county", "code", "district").agg(F.sum("part").alias("part")), ["scope", "county", "code"], "part").drop("part")
    weights = named.groupBy("scope", "county", "code").agg(F.max("total").alias("weight"))
    counties = placed.groupBy("scope", "county", "district").agg(F.sum("weight").alias("weight"))
    return Crosswalk(splits, shares(counties, ["scope", "county"], "weight").drop("weight"), weights)


DISTRICT_COLUMNS = ("DISTRICT", "CD119FP", "CD118FP", "SLDLST", "SLDUST", "district_id", "district")
VINTAGES = (("GEOID20", "ALAND20", "AWATER20"), ("GEOID10", "ALAND10", "AWATER10"), ("GEOID", "ALAND", "AWATER"))


def pick_column(df: DataFrame, wanted: tuple[str, ...] = DISTRICT_COLUMNS) -> str:
    """The first of these columns that df has."""
    found = next((c for c in wanted if c in df.columns), None)
    if found is None:
        raise ValueError(f"none of the columns {wanted}")
    return found


def block_weights(blocks: DataFrame) -> DataFrame:
    """(BLOCKID, weight) of a block table of any vintage: land and water area, 1 where that isn't above zero."""
    names = next((v for v in VINTAGES if set(v) <= set(blocks.columns)), None)
    if names is None:
        raise ValueError(f"no vintage's columns among {blocks.columns}")
    area = F.coalesce(F.col(names[1]).try_cast("double"), F.lit(0.0)) + F.coalesce(F.col(names[2]).try_cast("double"), F.lit(0.0))
    return blocks.select(F.col(names[0]).alias("BLOCKID"), F.when(area > 0, area).otherwise(1.0).alias("weight"))


def from_overlay(precincts: DataFrame, districts: DataFrame, scope: str, cell: float | None = None) -> Crosswalk:
    """Crosswalk from two polygon layers: precincts (id, county, code, rings), districts (one of DISTRICT_COLUMNS, rings).

    Pieces are the common areas; the layers meet on grid cells of the size `cell`, that of most precincts if not given.
    """
    from .geo import overlay

    named = districts.select(F.col(pick_column(districts)).cast("string").alias("id"), "rings")
    pieces = overlay(precincts.select("id", "rings"), named, cell)
    owners = precincts.select(F.col("id").alias("left_id"), "county", "code")
    return from_areas(pieces.join(owners, "left_id").select(F.lit(scope).alias("scope"), "county", "code", F.col("right_id").alias("district"), F.col("area").alias("weight")))


_UNFIT = re.compile(r"\b(?:FileNotFoundError|BadZipFile|ValueError|KeyError|FileNotFoundException|FILE_NOT_EXIST)\b")
"""What errors of tasks say where an input is missing or unfit."""


def probed(make: Callable[[], Crosswalk]) -> Crosswalk:
    """The crosswalk, if its inputs can be read: a row of each frame is asked for. FileNotFoundError, ValueError or KeyError
    if not, also where it was the planner or a task that found out; other errors stay as they are."""
    try:
        found = make()
        if found.splits.isEmpty() or found.county_weights.isEmpty() or found.code_weights.isEmpty():
            raise ValueError("no precinct is assigned")
    except AnalysisException as e:
        missing = e.getCondition() or ""
        if missing.startswith("PATH_NOT_FOUND"):
            raise FileNotFoundError(str(e)) from e
        if missing.startswith(("UNRESOLVED_COLUMN", "FIELD_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA")):
            raise KeyError(str(e)) from e
        if _UNFIT.search(str(e)):
            raise FileNotFoundError(str(e)) from e
        raise
    except (PySparkException, Py4JJavaError) as e:
        # A worker's error comes with its traceback, a reader's with the file that is gone.
        if _UNFIT.search(str(e)):
            raise FileNotFoundError(str(e)) from e
        raise
    return found


def chosen(source: str, overlay: Callable[[], Crosswalk], blocks: Callable[[], Crosswalk]) -> Crosswalk:
    """The crosswalk of a source: overlay, blockassign, or auto, which is blockassign or, where its input is missing or
    unfit, overlay with a warning."""
    if source not in ("overlay", "blockassign", "auto"):
        raise ValueError(f"unknown mapping source {source!r}")
    if source == "overlay":
        return overlay()
    try:
        return probed(blocks)
    except (FileNotFoundError, ValueError, KeyError) as e:
        if source == "blockassign":
            raise
        warnings.warn(f"block assignment failed, using overlay: {str(e).splitlines()[0]}", stacklevel=2)
        return overlay()


def from_blocks(precincts: DataFrame, districts: DataFrame, weights: DataFrame, counties: DataFrame, scope: str) -> Crosswalk:
    """Crosswalk from block assignments: precincts (BLOCKID, COUNTYFP, DISTRICT), districts (BLOCKID, DISTRICT),
    weights (BLOCKID, weight; missing ones count 1) and county names (countyfp, county; missing ones are their code)."""
    own = precincts.select("BLOCKID", F.lpad("COUNTYFP", 3, "0").alias("countyfp"), F.col("DISTRICT").alias("code"))
    blocks = own.join(districts.select("BLOCKID", F.col("DISTRICT").alias("district")), "BLOCKID").join(weights.select("BLOCKID", "weight"), "BLOCKID", "left").fillna(1.0, ["weight"])
    # Blocks are added up before the county names are joined, so the join sees one row for each piece.
    pieces = blocks.groupBy("countyfp", "code", "district").agg(F.sum("weight").alias("weight"))
    named = pieces.join(counties.select("countyfp", "county"), "countyfp", "left").withColumn("county", F.coalesce("county", "countyfp"))
    return from_areas(named.withColumn("scope", F.lit(scope)))


def from_contests(ballots: DataFrame) -> Crosswalk:
    """Crosswalk from contests that are held by district, for legislative scopes: a precinct's shares are of its votes.

    Ballots have county, precinct, office, year and votes; counties are keyed without aliases.
    """
    # Votes are added up before their labels are read, so that is done once for each precinct and office, not for each ballot.
    sums = settle(ballots.where("votes > 0").groupBy("county", "precinct", "office", "year").agg(F.sum("votes").alias("votes")))
    own = sums.withColumn("__c", office_class(F.col("office"), F.col("year"))).where("__c.kind = 'district'")
    keyed = own.select(F.col("__c.contest_type").alias("scope"), locality_key(F.col("county")).alias("county"), precinct_code_of_label(F.col("precinct")).alias("code"), district_id(F.col("__c.district")).alias("district"), "votes").where("county != '' AND code != '' AND district != ''")
    sums = keyed.groupBy("scope", "county", "code", "district").agg(F.sum("votes").alias("votes"))
    return Crosswalk(
        shares(sums, ["scope", "county", "code"], "votes").drop("votes"),
        shares(sums.groupBy("scope", "county", "district").agg(F.sum("votes").alias("votes")), ["scope", "county"], "votes").drop("votes"),
        sums.groupBy("scope", "county", "code").agg(F.sum("votes").alias("weight")),
    )


def normalise(df: DataFrame, keys: list[str], value: str = "share") -> DataFrame:
    """Weights above zero, scaled to sum to one in each group."""
    return shares(df, keys, value, value)


def blend(primary: DataFrame, fallback: DataFrame, alpha, keys: list[str], unit: str = "district", value: str = "share") -> DataFrame:
    """alpha of the primary weights and the rest of the fallback's, over all districts of either; where a group has only
    one of them, that one. `alpha` is a number or a column of the primary's keys."""
    p = normalise(primary, keys, value).withColumnRenamed(value, "__p")
    f = normalise(fallback, keys, value).withColumnRenamed(value, "__f")
    w = Window.partitionBy(*keys)
    both = p.join(f, [*keys, unit], "full_outer").withColumn("__hp", F.max(F.col("__p").isNotNull()).over(w)).withColumn("__hf", F.max(F.col("__f").isNotNull()).over(w))
    a = F.least(F.greatest(F.lit(alpha) if isinstance(alpha, (int, float)) else alpha, F.lit(0.0)), F.lit(1.0))
    p0, f0 = F.coalesce("__p", F.lit(0.0)), F.coalesce("__f", F.lit(0.0))
    mixed = F.when(~F.col("__hf"), p0).when(~F.col("__hp"), f0).otherwise(a * p0 + (1 - a) * f0)
    return normalise(both.select(*keys, unit, mixed.alias(value)), keys, value)


def distance(a: DataFrame, b: DataFrame, keys: list[str], unit: str = "district", value: str = "share") -> DataFrame:
    """Sum of absolute differences of two groups' weights."""
    x, y = normalise(a, keys, value).withColumnRenamed(value, "__a"), normalise(b, keys, value).withColumnRenamed(value, "__b")
    return x.join(y, [*keys, unit], "full_outer").groupBy(*keys).agg(F.sum(F.abs(F.coalesce("__a", F.lit(0.0)) - F.coalesce("__b", F.lit(0.0)))).alias("l1"))
