"""Apportionment of precinct votes to districts, and allocation of what no precinct matches.

Ballots (contest_type, year, county, code, non_geographic, bucket, candidate, votes) are added up by precinct before
they meet the crosswalk, so joins and shuffles see one row for each precinct, bucket and candidate. Contributions keep
their county and their source (direct or allocated): results, coverage and diagnostics are all sums over them.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from apportion.functions.settle import settle

from .contest import bucket_sums
from .crosswalk import Crosswalk, shares
from .resolve import resolve

CONTEST = ["scope", "contest_type", "year"]
# How far a bucket's unmatched votes follow its own districts rather than all votes', by scope.
DEFAULT_BLEND = {"congressional": 0.35, "state_house": 0.15, "state_senate": 0.15}
COUNTY_BLEND = (
    ("congressional", "CHESAPEAKE CITY", 0.55),
    ("state_house", "CHESTERFIELD COUNTY", 0.85),
    ("state_house", "FAIRFAX COUNTY", 0.0),
    ("state_house", "HENRICO COUNTY", 0.0),
    ("state_house", "STAFFORD COUNTY", 1.0),
    ("state_senate", "CHESTERFIELD COUNTY", 0.0),
    ("state_senate", "FAIRFAX COUNTY", 0.0),
    ("state_senate", "HENRICO COUNTY", 0.0),
    ("state_senate", "MONTGOMERY COUNTY", 0.0),
    ("state_senate", "ROANOKE COUNTY", 0.15),
    ("state_senate", "ROANOKE CITY", 0.7),
    ("state_senate", "SALEM CITY", 0.7),
)


@dataclass(frozen=True)
class Apportioned:
    """contributions: (scope, contest_type, year, county, district, bucket, candidate, source, votes); unmatched: (scope,
    contest_type, year, county, bucket, candidate, votes), allocated or not."""

    contributions: DataFrame
    unmatched: DataFrame


def blends(spark, defaults: dict[str, float] = DEFAULT_BLEND, counties=COUNTY_BLEND) -> DataFrame:
    """(scope, county, blend); county is null for a scope's default."""
    # Literals, so that no Python worker has to start for a few rows.
    rows = [F.struct(F.lit(s).alias("scope"), F.lit(c).cast("string").alias("county"), F.lit(float(b)).alias("blend")) for s, c, b in [(s, None, b) for s, b in defaults.items()] + list(counties)]
    return spark.range(1, numPartitions=1).select(F.inline(F.array(*rows)))


def with_blend(df: DataFrame, config: DataFrame) -> DataFrame:
    """df with the blend of its scope and county."""
    own = config.where("county IS NOT NULL").select("scope", "county", F.col("blend").alias("__own"))
    default = config.where("county IS NULL").select("scope", F.col("blend").alias("__default"))
    return df.join(own, ["scope", "county"], "left").join(default, "scope", "left").withColumn("blend", F.coalesce("__own", "__default", F.lit(0.15))).drop("__own", "__default")


def apportion(ballots: DataFrame, geometry: Crosswalk, explicit: Crosswalk | None, scopes: tuple[str, ...], candidates: bool = True, direct_candidates: bool = True) -> Apportioned:
    """Direct contributions by precinct splits. Explicit splits serve codes that geometry leaves open, in their scopes.

    Without `candidates`, votes are added up over them and the column is empty: readers that ask for buckets alone then
    aggregate and shuffle one row for each bucket instead of each candidate. Without `direct_candidates` this holds for the
    direct contributions alone, which readers of allocated votes need as weights only; unmatched votes keep their candidates.
    """
    keys = ["contest_type", "year", "county", "code", "bucket", "candidate"]
    code = F.when(F.col("non_geographic"), F.lit("")).otherwise(F.col("code"))
    sums = settle(ballots.where("votes > 0 AND county != ''").withColumn("code", code).withColumn("candidate", F.trim(F.coalesce("candidate", F.lit(""))) if candidates else F.lit("")).groupBy(*keys).agg(F.sum("votes").alias("votes")))
    scope = F.explode(F.array(*[F.lit(s) for s in scopes])).alias("scope")
    wanted = sums.where("code != ''").select("county", "code").distinct().select(scope, "county", "code")
    on = ["scope", "county", "code"]
    splits = resolve(wanted, geometry)
    if explicit is not None:
        splits = settle(splits)
        splits = splits.unionByName(resolve(wanted.join(splits.select(*on).distinct(), on, "left_anti"), explicit))
    if candidates and not direct_candidates:
        splits = settle(splits)
        # Precincts meet their splits with one row for each bucket, and candidates are looked at where some scope has no split.
        tally = sums.where("code != ''").groupBy("contest_type", "year", "county", "code", "bucket").agg(F.sum("votes").alias("votes"))
        direct = tally.join(splits.select(*on, "district", "share"), ["county", "code"]).groupBy(*CONTEST, "county", "district", "bucket").agg(F.sum(F.col("votes") * F.col("share")).alias("votes"))
        contributions = settle(direct).select(*CONTEST, "county", "district", "bucket", F.lit("").alias("candidate"), F.lit("direct").alias("source"), "votes")
        unsplit = wanted.join(splits.select(*on).distinct(), on, "left_anti").groupBy("county", "code").agg(F.collect_set("scope").alias("scopes"))
        left = sums.where("code = ''").withColumn("scopes", F.array(*[F.lit(s) for s in scopes])).unionByName(sums.where("code != ''").join(unsplit, ["county", "code"]))
        rest = left.groupBy("contest_type", "year", "county", "bucket", "candidate", "scopes").agg(F.sum("votes").alias("votes")).withColumn("scope", F.explode("scopes"))
        return Apportioned(contributions, settle(rest.groupBy(*CONTEST, "county", "bucket", "candidate").agg(F.sum("votes").alias("votes"))))
    # One pass over the precincts: rows that no split matches keep all their votes, with a null district.
    part = F.sum(F.col("votes") * F.coalesce("share", F.lit(1.0))).alias("votes")
    both = settle(sums.select("*", scope).join(splits.select(*on, "district", "share"), on, "left").groupBy(*CONTEST, "county", "district", "bucket", "candidate").agg(part))
    return Apportioned(both.where("district IS NOT NULL").withColumn("source", F.lit("direct")), both.where("district IS NULL").drop("district"))


def allocation_weights(direct: DataFrame, county_weights: DataFrame, config: DataFrame, strict_zero: bool = False) -> tuple[DataFrame, DataFrame]:
    """Weights of counties' districts: by bucket where the bucket has direct votes, and for all votes.

    For all votes a county's weights are its direct votes', else its area's. A bucket's weights blend those with its own
    direct votes'; a blend of 0 means the bucket's own alone, unless strict_zero, which makes it mean none of its own.
    """
    own = [*CONTEST, "county"]
    by_bucket = direct.groupBy(*own, "district", "bucket").agg(F.sum("votes").alias("votes"))
    by_bucket = settle(by_bucket)
    total = shares(by_bucket.groupBy(*own, "district").agg(F.sum("votes").alias("votes")), own, "votes", "total_share").drop("votes")
    party = shares(by_bucket, [*own, "bucket"], "votes", "party_share").drop("votes")
    buckets = party.select(*own, "bucket").distinct()
    both = total.join(buckets, own).join(party, [*own, "district", "bucket"], "left").fillna(0.0, ["party_share"])
    mixed = with_blend(both, config).withColumn("raw", blended(F.col("total_share"), F.col("party_share"), F.col("blend"), strict_zero))
    by = shares(mixed, [*own, "bucket"], "raw", "share").select(*own, "bucket", "district", "share")
    return by, total.withColumnRenamed("total_share", "share")


def blended(total: Column, party: Column, blend: Column, strict_zero: bool = False) -> Column:
    mixed = (1 - blend) * total + blend * party
    return mixed if strict_zero else F.when(blend > 0, mixed).otherwise(party)


def allocate(found: Apportioned, geometry: Crosswalk, config: DataFrame, strict_zero: bool = False) -> Apportioned:
    """Adds allocated contributions of the unmatched votes; counties without any weights keep theirs unallocated."""
    own = [*CONTEST, "county"]
    by, total = allocation_weights(found.contributions, geometry.county_weights, config, strict_zero)
    rest = found.unmatched

    def listed(df: DataFrame, keys: list[str], name: str) -> DataFrame:
        # A list is as long as its county has districts.
        return df.groupBy(*keys).agg(F.collect_list(F.struct("district", "share")).alias(name))

    weights = rest.select(*own, "bucket").distinct().join(listed(by, [*own, "bucket"], "__bucket"), [*own, "bucket"], "left").join(listed(total, own, "__total"), own, "left").join(listed(geometry.county_weights, ["scope", "county"], "__area"), ["scope", "county"], "left")
    weights = weights.select(*own, "bucket", F.coalesce("__bucket", "__total", "__area").alias("__weights"))
    dealt = rest.join(weights, [*own, "bucket"]).select(*own, "bucket", "candidate", "votes", F.explode("__weights").alias("__w"))
    given = dealt.select(*own, F.col("__w.district").alias("district"), "bucket", "candidate", F.lit("allocated").alias("source"), (F.col("votes") * F.col("__w.share")).alias("votes"))
    return Apportioned(found.contributions.unionByName(given), rest)


def direct_contests(ballots: DataFrame) -> DataFrame:
    """Contributions of contests that are held by district: ballots with scope, district and the rest."""
    own = ballots.where("votes > 0 AND district != ''").withColumn("candidate", F.trim(F.coalesce("candidate", F.lit(""))))
    return own.groupBy("scope", F.col("scope").alias("contest_type"), "year", "county", "district", "bucket", "candidate").agg(F.sum("votes").alias("votes")).withColumn("source", F.lit("direct"))


def over_counties(found: Apportioned) -> Apportioned:
    """found with its contributions added up over counties and settled, for readers that ask for several sums of districts;
    contributions have no county then."""
    keys = [*CONTEST, "district", "bucket", "candidate", "source"]
    return Apportioned(settle(found.contributions.groupBy(*keys).agg(F.sum("votes").alias("votes"))), found.unmatched)


def district_results(contributions: DataFrame) -> DataFrame:
    """Votes by bucket of each district; districts without votes go."""
    sums = contributions.groupBy(*CONTEST, "district").agg(*bucket_sums(suffix="_votes"))
    return sums.withColumn("total_votes", F.expr("dem_votes + rep_votes + other_votes")).where("total_votes > 0")


def coverage(found: Apportioned) -> DataFrame:
    """Votes of each contest that came in, matched directly, were allocated, and both; with percentages of what came in."""
    c = found.contributions.groupBy(*CONTEST).agg(F.sum(F.when(F.col("source") == "direct", F.col("votes")).otherwise(0.0)).alias("direct_matched_votes"), F.sum(F.when(F.col("source") == "allocated", F.col("votes")).otherwise(0.0)).alias("allocated_votes"))
    u = found.unmatched.groupBy(*CONTEST).agg(F.sum("votes").alias("unmatched"))
    both = c.join(u, CONTEST, "full_outer").fillna(0.0, ["direct_matched_votes", "allocated_votes", "unmatched"])
    both = both.select(*CONTEST, (F.col("direct_matched_votes") + F.col("unmatched")).alias("input_votes"), (F.col("direct_matched_votes") + F.col("allocated_votes")).alias("matched_votes"), "direct_matched_votes", "allocated_votes")
    pct = [F.when(F.col("input_votes") > 0, F.col(c) / F.col("input_votes") * 100).otherwise(0.0).alias(n) for c, n in (("matched_votes", "match_coverage_pct"), ("direct_matched_votes", "direct_match_coverage_pct"))]
    return both.select("*", *pct)
