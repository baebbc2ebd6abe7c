"""Resolution of drifting precinct codes against a crosswalk, as a ladder of equi-joins.

Stages, the first that finds anything wins: 1 the code itself; 2 codes with the same number; 3 one to three numbers
that add one digit; 4 one to four codes that differ by a suffix of one or two letters or digits on either side, or that
share at least three leading digits. Each stage joins on keys that are derived from the codes (their numbers, their
heads, their leading digits), so a county's codes never meet each other pair by pair.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from apportion.functions.settle import settle
from apportion.functions.text import leading_digits

from .crosswalk import Crosswalk, shares

SUFFIX = "^[A-Z0-9]{1,2}$"
ON = ["scope", "county"]


def _number(code: Column) -> Column:
    bare = F.regexp_replace(code, "-+$", "")
    return F.when(bare.rlike(r"^\d+$"), F.regexp_replace(bare, r"^0+(?=\d)", "")).otherwise(F.lit(""))


def _head(code: Column, cut: int) -> Column:
    return F.when(F.length(code) > cut, F.substring(code, F.lit(1), F.length(code) - cut)).otherwise(F.lit(""))


SAME, LONGER, ADDED, DROPPED, BASE = 2, 3, 4, 5, 6
"""Kinds of keys. A kind's stage is its number, 4 at most."""


def _keys(df: DataFrame, code: str, keep: str | list[str], kinds: dict[int, Column], cut_kind: int) -> DataFrame:
    """(scope, county, keep, kind, key, ok), one row for each key that a code has; `code` is the column that keys are made of.

    A code's heads, short of one or two characters that can be a suffix, are its keys of cut_kind. ok tells for BASE
    whether what follows the leading digits can be a suffix, and holds for all other kinds.
    """
    digits = leading_digits(F.col(code))
    based = F.expr(f"substring({code}, length(__digits) + 1)").rlike(SUFFIX)
    heads = [F.struct(F.lit(cut_kind).alias("kind"), F.when(F.right(F.col(code), F.lit(n)).rlike(SUFFIX), _head(F.col(code), n)).otherwise("").alias("key"), F.lit(True).alias("ok")) for n in (1, 2)]
    own = [F.struct(F.lit(kind).alias("kind"), key.alias("key"), F.lit(True).alias("ok")) for kind, key in kinds.items()]
    base = F.struct(F.lit(BASE).alias("kind"), F.when(F.length("__digits") >= 3, F.col("__digits")).otherwise("").alias("key"), based.alias("ok"))
    keyed = df.withColumn("__digits", digits).withColumn("__number", _number(F.col(code)))
    kept = [keep] if isinstance(keep, str) else keep
    return keyed.select(*ON, *kept, F.explode(F.array(*own, *heads, base)).alias("__k")).select(*ON, *kept, "__k.*").where("key != ''")


def candidates(wanted: DataFrame, codes: DataFrame) -> DataFrame:
    """(scope, county, code, stage, candidate) of stages 2 to 4, before any guard, with what else `codes` has. Both sides
    are distinct codes.

    Each side is exploded into its keys of all kinds, so that all stages are one join; its rows come together by code.
    """
    p = wanted.select(*ON, "code", F.regexp_replace("code", "-+$", "").alias("__p")).where("__p != ''")
    number = F.col("__number")
    left = _keys(p, "__p", "code", {SAME: number, LONGER: number, ADDED: F.col("__p")}, DROPPED)
    c = codes.withColumnRenamed("code", "candidate")
    more = [x for x in c.columns if x not in (*ON, "candidate")]
    right = _keys(c, "candidate", ["candidate", *more], {SAME: number, LONGER: _head(number, 1), DROPPED: F.col("candidate")}, ADDED).withColumnRenamed("ok", "__ok")
    met = left.join(right, [*ON, "kind", "key"]).where("ok OR __ok")
    return met.select(*ON, "code", F.least("kind", F.lit(4)).alias("stage"), "candidate", *more).repartition(*ON, "code").distinct()


def resolve(wanted: DataFrame, crosswalk: Crosswalk) -> DataFrame:
    """(scope, county, code, district, share, stage) for the wanted distinct (scope, county, code) that can be resolved.

    Candidates of a stage are averaged by their weights (1 where there is none); weights that aren't above zero drop
    out, and a stage that comes to nothing gives way to the next.
    """
    splits, weights = crosswalk.splits, crosswalk.code_weights
    # Settled before its filter, which would otherwise be pushed below the expressions that make the codes, into every row.
    own = settle(wanted.select(*ON, "code").distinct()).where("county != '' AND code != ''")
    known = settle(own.join(splits.select(*ON, "code", "district", "share"), [*ON, "code"], "left"))
    exact = known.where("district IS NOT NULL").select(*ON, "code", "district", "share", F.lit(1).alias("stage"))
    codes = splits.select(*ON, "code").distinct().join(weights.select(*ON, "code", "weight"), [*ON, "code"], "left").withColumn("weight", F.coalesce("weight", F.lit(1.0)))
    # From here to the end rows stay together by code, so nothing but the districts of the candidates has to move.
    found = candidates(known.where("district IS NULL").select(*ON, "code"), codes)
    found = found.withColumn("n", F.count("*").over(Window.partitionBy(*ON, "code", "stage"))).where("(stage = 2 OR (stage = 3 AND n <= 3) OR (stage = 4 AND n <= 4)) AND weight > 0")
    best = found.withColumn("first", F.min("stage").over(Window.partitionBy(*ON, "code"))).where("stage = first")
    parts = best.join(splits.select(*ON, F.col("code").alias("candidate"), "district", "share"), [*ON, "candidate"])
    merged = parts.groupBy(*ON, "code", "stage", "district").agg(F.sum(F.col("share") * F.col("weight")).alias("part"))
    return exact.unionByName(shares(merged, [*ON, "code"], "part").select(*ON, "code", "district", "share", "stage"))


def by_label(rows: DataFrame, layer: DataFrame) -> DataFrame:
    """rows (county, code, label, ...) with `matched`, the code of the precinct layer (county, code, label) that they fall
    to: their own code if the layer has it, else the code of the only precinct of the county with their label."""
    codes = layer.select("county", "code", F.col("code").alias("__own")).distinct()
    only = layer.where("label != ''").groupBy("county", "label").agg(F.min("code").alias("__by_label"), F.count_distinct("code").alias("__n")).where("__n = 1").drop("__n")
    joined = rows.join(codes, ["county", "code"], "left").join(only, ["county", "label"], "left")
    return joined.select(*[F.col(c) for c in rows.columns], F.coalesce("__own", "__by_label").alias("matched"))


def redistributed(rows: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, county, matched, votes): votes of rows without a match are dealt over the matched precincts of their county
    in proportion to those' votes in the same group; where the county has none, they stay with a null match."""
    group = [*keys, "county"]
    sums = rows.groupBy(*group, "matched").agg(F.sum("votes").alias("votes"))
    known = sums.where("matched IS NOT NULL AND votes > 0")
    parts = shares(known, group, "votes").select(*group, "matched", "votes", "share")
    rest = sums.where("matched IS NULL").select(*group, F.col("votes").alias("__rest"))
    given = parts.join(rest, group, "left").select(*group, "matched", (F.col("votes") + F.col("share") * F.coalesce("__rest", F.lit(0.0))).alias("votes"))
    lost = rest.join(known.select(*group).distinct(), group, "left_anti").select(*group, F.lit(None).cast("string").alias("matched"), F.col("__rest").alias("votes"))
    return given.unionByName(lost)
