"""Where district errors come from: contributions by county and source, coverage by county, candidates for tuning."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from apportion.functions import votes as V

from .allocate import CONTEST, Apportioned

KEY = [*CONTEST, "district"]


def county_contributions(found: Apportioned, targets: DataFrame | None = None) -> DataFrame:
    """Votes of each district by county, bucket and source, with shares; only targets' districts if there are targets."""
    sums = {f"{b}_{s}": F.sum(F.when((F.col("bucket") == b) & (F.col("source") == s), F.col("votes")).otherwise(0.0)) for b in ("dem", "rep", "other") for s in ("direct", "allocated")}
    own = found.contributions if targets is None else found.contributions.join(targets.select(*KEY).distinct(), KEY, "left_semi")
    rows = own.groupBy(*KEY, "county").agg(*[v.alias(k) for k, v in sums.items()])
    direct, allocated = F.expr("dem_direct + rep_direct + other_direct"), F.expr("dem_allocated + rep_allocated + other_allocated")
    rows = rows.withColumn("direct_votes", direct).withColumn("allocated_votes", allocated).withColumn("total_votes", F.expr("direct_votes + allocated_votes")).where("total_votes > 0")
    return rows.withColumn("allocated_share", V.share(F.col("allocated_votes"), F.col("total_votes"))).withColumn("district_share_of_total", V.share(F.col("total_votes"), F.sum("total_votes").over(Window.partitionBy(*KEY))))


def county_coverage(found: Apportioned) -> DataFrame:
    """Votes of each county that came in, matched directly, were allocated, and were not."""
    own = [*CONTEST, "county"]
    c = found.contributions.groupBy(*own).agg(F.sum(F.when(F.col("source") == "direct", F.col("votes")).otherwise(0.0)).alias("direct_votes"), F.sum(F.when(F.col("source") == "allocated", F.col("votes")).otherwise(0.0)).alias("allocated_votes"))
    u = found.unmatched.groupBy(*own).agg(F.sum("votes").alias("__rest"))
    both = c.join(u, own, "full_outer").fillna(0.0, ["direct_votes", "allocated_votes", "__rest"])
    return both.select(*own, (F.col("direct_votes") + F.col("__rest")).alias("input_votes"), "direct_votes", "allocated_votes", (F.col("__rest") - F.col("allocated_votes")).alias("unallocated_votes"))


def top_counties(contributions: DataFrame, n: int = 6) -> DataFrame:
    """The n counties with most votes of each district, as text. Sums that differ in their last bits alone count as equal,
    and percentages are rounded as decimals, so the text doesn't depend on the order of adding."""
    w = Window.partitionBy(*KEY).orderBy(F.round("total_votes", 6).desc(), "county")
    ranked = contributions.withColumn("__n", F.row_number().over(w)).where(F.col("__n") <= max(1, n))
    pct = [F.round((F.col(c) * 100).cast("decimal(38, 7)"), 1).cast("string") for c in ("district_share_of_total", "allocated_share")]
    part = F.format_string("%s:%s%% (alloc %s%%)", "county", *pct)
    return ranked.groupBy(*KEY).agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("__n", part.alias("text")))), lambda x: x["text"]), " | ").alias("top_counties"))


def raw_report(results: DataFrame, targets: DataFrame, contributions: DataFrame, n: int = 6) -> DataFrame:
    """Errors of every target before calibration, with its leading counties."""
    rows = targets.select(*KEY, "target_margin_pct").join(results, KEY, "left").fillna(0.0, ["dem_votes", "rep_votes", "other_votes", "total_votes"])
    margin = V.margin_pct(F.col("dem_votes"), F.col("rep_votes"), F.col("total_votes"))
    error = margin - F.col("target_margin_pct")
    return rows.join(top_counties(contributions, n), KEY, "left").select(*KEY, *[F.bround(c, 3).alias(a) for c, a in ((F.col("target_margin_pct"), "target_margin_pct"), (margin, "raw_margin_pct"), (error, "raw_error_pct"), (F.abs(error), "raw_abs_error_pct"), *((F.col(f"{b}_votes"), f"{b}_votes") for b in ("dem", "rep", "other", "total")))], F.coalesce("top_counties", F.lit("")).alias("top_counties"))


def candidate_counties(report: DataFrame, contributions: DataFrame, error: float = 8.0, county_share: float = 0.08, allocated_share: float = 0.4) -> DataFrame:
    """(scope, county) that weigh much in districts with large errors and owe much of it to allocation."""
    bad = report.where(F.coalesce("raw_abs_error_pct", F.lit(0.0)) >= error).select(*KEY)
    own = contributions.join(bad, KEY, "left_semi").where((F.col("district_share_of_total") >= county_share) & (F.col("allocated_share") >= allocated_share))
    return own.select("scope", F.upper(F.trim("county")).alias("county")).where("county != ''").distinct()


def with_coverage(contributions: DataFrame, coverage: DataFrame) -> DataFrame:
    """Contributions with their county's votes in the whole contest (county_scope_*); 0 where there are none."""
    names = ("input_votes", "direct_votes", "allocated_votes")
    own = coverage.select(*CONTEST, "county", *[F.col(n).alias(f"county_scope_{n}") for n in names])
    rows = contributions.join(own, [*CONTEST, "county"], "left").fillna(0.0, [f"county_scope_{n}" for n in names])
    return rows.withColumn("county_scope_allocated_share", V.share(F.col("county_scope_allocated_votes"), F.col("county_scope_input_votes")))


def select_contests(df: DataFrame, years: tuple[int, ...] = (), scopes: tuple[str, ...] = (), contests: tuple[str, ...] = ()) -> DataFrame:
    """Rows of any of the years, of any of the scopes and of any of the contests; no value means no filter."""
    for column, values in (("year", years), ("scope", scopes), ("contest_type", contests)):
        if values:
            df = df.where(F.col(column).isin(*values))
    return df


def report_order() -> list:
    """Raw reports: the greatest error first, a missing one as none; (column, descending) pairs."""
    return [(F.coalesce("raw_abs_error_pct", F.lit(0.0)), True), *coverage_order()[:-1], *V.district_order(F.col("district"))]


def coverage_order() -> list[Column]:
    return [F.col("scope"), F.col("contest_type"), F.col("year"), F.col("county")]
