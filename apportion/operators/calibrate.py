"""Margin calibration, exact overrides, and the report on both.

Results are keyed by scope, contest_type, year and district. Targets and overrides are keyed alike; of repeated keys the
last by `position` counts where the frame has one, as later lines of a file replace earlier ones.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from apportion.functions import votes as V

KEY = ["scope", "contest_type", "year", "district"]


def latest(df: DataFrame, position: str = "position") -> DataFrame:
    if position not in df.columns:
        return df.dropDuplicates(KEY)
    return df.withColumn("__n", F.row_number().over(Window.partitionBy(*KEY).orderBy(F.col(position).desc()))).where("__n = 1").drop("__n", position)


def calibrate(results: DataFrame, targets: DataFrame) -> DataFrame:
    """Results with dem and rep votes moved to the target margin; their sum, other votes and the total stay.

    The margin is kept within what the two parties' votes allow. Adds raw_margin_pct, the margin before.
    """
    wanted = latest(targets).select(*KEY, "target_margin_pct")
    total = F.col("total_votes")
    major = total - F.col("other_votes")
    gap = V.clamp(F.col("target_margin_pct") / 100.0 * total, -major, major)
    rep = 0.5 * (major + gap)
    moved = F.col("target_margin_pct").isNotNull() & (total > 0) & (major > 0)
    joined = results.withColumn("raw_margin_pct", V.margin_pct(F.col("dem_votes"), F.col("rep_votes"), total)).join(wanted, KEY, "left")
    out = joined.withColumn("__rep", F.when(moved, rep).otherwise(F.col("rep_votes"))).withColumn("__dem", F.when(moved, major - rep).otherwise(F.col("dem_votes")))
    return out.withColumn("rep_votes", F.col("__rep")).withColumn("dem_votes", F.col("__dem")).drop("__rep", "__dem", "target_margin_pct")


def override(results: DataFrame, exact: DataFrame) -> DataFrame:
    """Results with votes (and candidates, where given) replaced; never adds a district."""
    names = [c for c in ("dem_votes", "rep_votes", "other_votes", "dem_candidate", "rep_candidate") if c in exact.columns and c in results.columns]
    own = latest(exact).select(*KEY, *[F.col(c).alias(f"__{c}") for c in names], F.lit(True).alias("__has"))
    joined = results.join(own, KEY, "left")
    for c in names:
        new = F.nullif(F.trim(F.col(f"__{c}")), F.lit("")) if c.endswith("candidate") else F.when(F.col("__has"), F.coalesce(F.col(f"__{c}"), F.lit(0.0)))
        joined = joined.withColumn(c, F.coalesce(new, F.col(c)))
    return joined.withColumn("total_votes", F.expr("dem_votes + rep_votes + other_votes")).drop("__has", *[f"__{c}" for c in names])


def upsert(current: DataFrame, new: DataFrame) -> DataFrame:
    """Rows of `current` with those of `new` in place of rows with their key, or added."""
    both = current.withColumn("__n", F.lit(0)).unionByName(new.withColumn("__n", F.lit(1)))
    w = Window.partitionBy(*KEY).orderBy(F.col("__n").desc())
    return both.withColumn("__r", F.row_number().over(w)).where("__r = 1").drop("__n", "__r")


def needs_calibration(abs_error: Column, threshold: float) -> Column:
    """yes or no; a missing error and an error of exactly 0 both count as infinite."""
    return F.when(F.coalesce(F.nullif(abs_error, F.lit(0.0)), F.lit(float("inf"))) >= threshold, "yes").otherwise("no")


def report(results: DataFrame, targets: DataFrame, threshold: float = 1.0) -> DataFrame:
    """One row for each target: margins before and after, their errors, and a status; results come from calibrate()."""
    own = results.select(*KEY, "raw_margin_pct", V.margin_pct(F.col("dem_votes"), F.col("rep_votes"), F.col("total_votes")).alias("calibrated_margin_pct"), F.lit(True).alias("__has"))
    rows = latest(targets).select(*KEY, "target_margin_pct").join(own, KEY, "left")
    raw, now = F.col("raw_margin_pct") - F.col("target_margin_pct"), F.col("calibrated_margin_pct") - F.col("target_margin_pct")
    status = F.when(F.col("__has").isNull(), "missing_output").when(F.col("calibrated_margin_pct").isNull(), "no_votes").otherwise("ok")
    errors = [(raw, "raw_error_pct"), (F.abs(raw), "raw_abs_error_pct"), (now, "calibrated_error_pct"), (F.abs(now), "calibrated_abs_error_pct")]
    wide = rows.select(*KEY, *[F.bround(c, 3).alias(c) for c in ("target_margin_pct", "raw_margin_pct")], *[F.bround(e, 3).alias(n) for e, n in errors[:2]], F.bround("calibrated_margin_pct", 3).alias("calibrated_margin_pct"), *[F.bround(e, 3).alias(n) for e, n in errors[2:]], needs_calibration(F.abs(raw), threshold).alias("needs_calibration"), status.alias("status"))
    return wide


def report_order() -> list[Column]:
    return [F.when(F.col("status") == "ok", 0).otherwise(1), F.coalesce("raw_abs_error_pct", F.lit(0.0)).desc(), V.place_in(F.col("scope"), V.SCOPES), F.col("contest_type"), F.col("year"), *V.district_order(F.col("district"))]


def outliers(rows: DataFrame) -> DataFrame:
    return rows.where("needs_calibration = 'yes'")
