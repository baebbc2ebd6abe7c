"""Output sets of a diagnosis, of a tuning run and of suggestions: CSV reports in one order each, and a JSON summary beside them."""

from __future__ import annotations

import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from apportion.functions import votes as V
from apportion.operators import diagnose, tune
from apportion.operators.allocate import Apportioned, district_results

from .outputs import write_csv, write_summary

ERRORS, CONTRIBUTIONS, COVERAGE = "benchmark_raw_error_report", "benchmark_county_contributions", "benchmark_county_coverage"
WORST = 12
TOP = 10


def contributions(rows: DataFrame, coverage: DataFrame) -> DataFrame:
    """County contributions as they are reported: votes by bucket and source, shares, and the county's votes in the contest."""
    own = diagnose.with_coverage(rows, coverage)
    of_bucket = [(F.expr(f"{b}_direct + {b}_allocated"), f"{b}_votes") for b in ("dem", "rep", "other")]
    named = [(F.col("total_votes"), "total_votes"), *of_bucket, *((F.col(c), c) for c in ("direct_votes", "allocated_votes"))]
    votes = [F.bround(c, 3).alias(f"district_county_{n}") for c, n in named]
    scope = [F.bround(f"county_scope_{c}", 3).alias(f"county_scope_{c}") for c in ("input_votes", "direct_votes", "allocated_votes")]
    shares = [F.bround(F.col(c), 6).alias(n) for c, n in (("allocated_share", "district_county_allocated_share"), ("district_share_of_total", "district_share_of_total"))]
    return own.select(*diagnose.KEY, "county", *votes, *shares, *scope, F.bround("county_scope_allocated_share", 6).alias("county_scope_allocated_share"))


def coverage(rows: DataFrame) -> DataFrame:
    """County coverage as it is reported: votes, and percentages of what came in."""
    kinds = {"direct_votes": "direct_match_pct", "allocated_votes": "allocated_pct", "unallocated_votes": "unallocated_pct"}
    pct = [F.bround(V.share(F.col(c), F.col("input_votes")) * 100, 3).alias(n) for c, n in kinds.items()]
    return rows.select("scope", "contest_type", "year", "county", *[F.bround(c, 3).alias(c) for c in ("input_votes", *kinds)], *pct)


def write_diagnosis(found: Apportioned, targets: DataFrame, folder: str, n: int = 6, **about) -> None:
    """Reports of the targets' errors, of the counties' parts in them and of coverage, and their summary with the worst
    targets; `about` goes into the summary."""
    parts, covered = diagnose.county_contributions(found, targets), diagnose.county_coverage(found)
    errors = diagnose.raw_report(district_results(found.contributions), targets, parts, n)
    scopes = V.place_in(F.col("scope"), V.SCOPES)
    write_csv(errors, f"{folder}/{ERRORS}", *diagnose.report_order())
    write_csv(contributions(parts, covered), f"{folder}/{CONTRIBUTIONS}", scopes, F.col("contest_type"), F.col("year"), *V.district_order(F.col("district")), (F.col("district_county_total_votes"), True), F.col("county"))
    write_csv(coverage(covered), f"{folder}/{COVERAGE}", scopes, F.col("contest_type"), F.col("year"), F.col("county"))
    worst = read(errors.sparkSession, f"{folder}/{ERRORS}").orderBy(F.col("raw_abs_error_pct").desc(), *diagnose.KEY).limit(WORST).collect()
    write_summary(errors.sparkSession, f"{folder}/benchmark_diagnostics_summary", targets_used=targets.count(), outputs=[ERRORS, CONTRIBUTIONS, COVERAGE], worst_targets=[r.asDict() for r in worst], **about)


TEXTS = ("scope", "contest_type", "district", "county", "top_counties", "status", "needs_calibration", "param_group", "top_improved_targets")


def read(spark: SparkSession, path: str) -> DataFrame:
    """A report as it was written: names and texts as text, years as whole numbers, all else as numbers."""
    raw = spark.read.option("header", True).csv(path)
    return raw.select(*[F.coalesce(c, F.lit("")).alias(c) if c in TEXTS else F.col(c).try_cast("int" if c == "year" else "double").alias(c) for c in raw.columns])


def _errors(stats: DataFrame, config: tune.Config) -> DataFrame:
    rows = tune.evaluate(stats, tune.config_frame(stats.sparkSession, [("", config)]))
    return rows.select(*tune.KEY, *[F.bround(c, 3).alias(c) for c in ("target_margin_pct", "raw_margin_pct")], F.bround(F.col("raw_margin_pct") - F.col("target_margin_pct"), 3).alias("raw_error_pct"), F.bround("abs_error", 3).alias("raw_abs_error_pct"))


def _named(config: tune.Config) -> dict[str, float]:
    return {s if c is None else f"{s}:{c}": v for (s, c), v in config.items()}


def write_tuning(stats: DataFrame, start: tune.Config, grid: list[float], folder: str, rounds: int = 1, **about) -> tune.Config:
    """Tunes by coordinate descent and writes the targets' errors before and after, and a summary with the metrics and
    configurations of both, the history, how many configurations were scored and how long it took. Returns the best."""
    began, seen = time.time(), {}
    best, history = tune.coordinate_descent(stats, start, grid, rounds, seen=seen)
    order = [(F.coalesce("raw_abs_error_pct", F.lit(0.0)), True), V.place_in(F.col("scope"), V.SCOPES), F.col("contest_type"), F.col("year"), *V.district_order(F.col("district"))]
    for name, config in (("baseline", start), ("best", best)):
        write_csv(_errors(stats, config), f"{folder}/party_blend_{name}_report", *order)
    metrics = {f"{n}_metrics": {k: v for k, v in seen[tune.signature(c)].items() if k != "config_id"} for n, c in (("baseline", start), ("best", best))}
    write_summary(stats.sparkSession, f"{folder}/party_blend_tuning_summary", **metrics, baseline_config=_named(start), best_config=_named(best), parameters_tuned=sorted(_named(start)), grid=grid, iterations_requested=rounds, evaluations_run=len(seen), history=history, elapsed_seconds=round(time.time() - began, 3), **about)
    return best


def write_suggestions(stats: DataFrame, start: tune.Config, counties: list[tuple[str, str]], grid: list[float], folder: str, **about) -> list[dict]:
    """Suggested overrides, the greatest gain first, as CSV, and a summary with the first TOP; returns them."""
    began = time.time()
    found = tune.suggestions(stats, start, counties, grid)
    columns = "place int, scope string, county string, param_group string, current_value double, suggested_value double, delta_value double, mae_gain double, rmse_gain double, over_threshold_delta long, top_improved_targets string"
    names = [c.split()[0] for c in columns.split(", ")]
    # One row for each county asked for, at most.
    rows = [tuple({**r, "place": k, "param_group": f"{r['scope']}_county"}[c] for c in names) for k, r in enumerate(found)]
    write_csv(stats.sparkSession.createDataFrame(rows, columns), f"{folder}/county_blend_override_suggestions", F.col("place"))
    counts = {s: sum(x == s for x, _ in counties) for s in sorted({s for s, _ in counties})}
    write_summary(stats.sparkSession, f"{folder}/county_blend_override_suggestions_summary", grid=grid, candidate_counts=counts, suggestions_count=len(found), top_suggestions=found[:TOP], evaluations_run=1 + len({*counties}) * len(grid), elapsed_seconds=round(time.time() - began, 3), **about)
    return found
