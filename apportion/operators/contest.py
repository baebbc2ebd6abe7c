"""Contest slices: votes by party bucket, leading candidates, winners, margins, ratings; and their summaries.

Ballots are rows with keys, `bucket` (dem, rep, other), `candidate` and `votes`. Each slice is one partial and final
aggregation on its keys; leading candidates come from a second one on keys and candidate, without a window.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from apportion.functions import votes as V

BUCKETS = ("dem", "rep", "other")


def bucket_sums(prefix: str = "", suffix: str = "", value: str = "votes", cast: str | None = None) -> list[Column]:
    sums = [F.sum(F.when(F.col("bucket") == b, F.col(value)).otherwise(0)) for b in BUCKETS]
    return [(s.cast(cast) if cast else s).alias(f"{prefix}{b}{suffix}") for s, b in zip(sums, BUCKETS, strict=True)]


def tally(ballots: DataFrame, keys: list[str], cast: str | None = None) -> DataFrame:
    """Votes by bucket, and in total, of each group with votes; rows without votes don't count."""
    sums = ballots.where("votes > 0").groupBy(*keys).agg(*bucket_sums(suffix="_votes", cast=cast))
    return sums.withColumn("total_votes", F.expr("dem_votes + rep_votes + other_votes")).where("total_votes > 0")


def leading_candidates(ballots: DataFrame, keys: list[str]) -> DataFrame:
    """Candidate with most votes in each party bucket of each group; of equals, the first by name."""
    named = ballots.where("votes > 0 AND bucket IN ('dem', 'rep') AND trim(candidate) != ''")
    each = named.groupBy(*keys, "bucket", "candidate").agg(F.sum("votes").alias("votes"))
    best = [F.min(F.when(F.col("bucket") == b, F.struct(-F.col("votes"), F.col("candidate").alias("name"))))["name"] for b in ("dem", "rep")]
    return each.groupBy(*keys).agg(*[F.coalesce(c, F.lit("")).alias(f"{b}_candidate") for c, b in zip(best, ("dem", "rep"), strict=True)])


def rated(results: DataFrame) -> DataFrame:
    """Adds winner, margin, signed margin percentage, rating and colour to results with votes by bucket."""
    pct = V.margin_pct(F.col("dem_votes"), F.col("rep_votes"), F.col("total_votes"))
    return results.select(
        "*",
        V.winner(F.col("dem_votes"), F.col("rep_votes")).alias("winner"),
        F.abs(F.col("rep_votes") - F.col("dem_votes")).alias("margin"),
        pct.alias("margin_pct"),
        V.rating_tier(pct).alias("rating"),
        V.rating_colour(pct).alias("color"),
    )


def county_slice(ballots: DataFrame, keys: tuple[str, ...] = ("contest_type", "year", "county")) -> DataFrame:
    """One row for each contest, year and county: votes cut to whole numbers, candidates, winner, margin, rating."""
    whole = ballots.withColumn("votes", F.col("votes").cast("bigint"))
    slim = tally(whole, list(keys), cast="bigint").join(leading_candidates(whole, list(keys)), list(keys), "left")
    return rated(slim.fillna("", ["dem_candidate", "rep_candidate"]))


def slice_meta(rows: DataFrame, keys: tuple[str, ...] = ("contest_type", "year")) -> DataFrame:
    """Totals of each slice, and whether both major parties have votes in it."""
    sums = rows.groupBy(*keys).agg(F.count("*").alias("rows"), *[F.sum(f"{b}_votes").alias(f"{b}_total") for b in BUCKETS], F.sum("total_votes").alias("total_votes"))
    return sums.withColumn("major_party_contested", F.expr("dem_total > 0 AND rep_total > 0"))


def label_mode(df: DataFrame, keys: list[str], label: str) -> DataFrame:
    """Most frequent non-empty label of each group; of equals, the first by name."""
    each = df.where(F.col(label) != "").groupBy(*keys, label).agg(F.count("*").alias("n"))
    return each.groupBy(*keys).agg(F.min(F.struct(-F.col("n"), F.col(label).alias("label")))["label"].alias(label))


def district_rows(results: DataFrame, candidates: DataFrame | None = None, keys: tuple[str, ...] = ("scope", "contest_type", "year", "district")) -> DataFrame:
    """District results as they are published: votes rounded half to even, margin from unrounded votes."""
    rows = rated(results)
    for b in ("dem", "rep", "other", "total"):
        rows = rows.withColumn(f"{b}_votes", V.round_half_even(F.col(f"{b}_votes")))
    rows = rows.withColumn("margin", V.round_half_even(F.col("margin")))
    return rows if candidates is None else rows.join(candidates, list(keys), "left").fillna("", ["dem_candidate", "rep_candidate"])


def slice_payloads(rows: DataFrame, meta: DataFrame, keys: tuple[str, ...], district: str = "district") -> DataFrame:
    """One JSON text for each slice: its meta, and its districts by name."""
    own = [c for c in rows.columns if c not in keys and c != district]
    results = rows.groupBy(*keys).agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct(F.col(district), F.struct(*own))))).alias("results"))
    joined = results.join(meta, list(keys))
    return joined.select(*keys, F.to_json(F.struct(F.struct(*meta.columns).alias("meta"), F.struct("results").alias("general"))).alias("payload"))
