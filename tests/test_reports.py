"""Output sets: what they hold, in what order, and that they read back."""

import json

import pytest
from pyspark.sql import functions as F

from apportion.operators import allocate, crosswalk
from apportion.operators import tune as tuning
from apportion.sources import reports


@pytest.fixture(scope="module")
def found(spark):
    areas = [("congressional", "X", "1", "1", 1.0), ("congressional", "X", "2", "2", 1.0), ("congressional", "Y", "9", "2", 1.0), ("congressional", "Y", "8", "1", 1.0)]
    geometry = crosswalk.from_areas(spark.createDataFrame(areas, "scope string, county string, code string, district string, weight double"))
    rows = [("X", "1", False, "dem", "A", 60.0), ("X", "2", False, "rep", "B", 40.0), ("X", "", True, "dem", "A", 30.0), ("Y", "9", False, "rep", "B", 50.0), ("Y", "8", False, "dem", "A", 5.0), ("Z", "7", False, "rep", "B", 3.0)]
    ballots = spark.createDataFrame([("president", 2020, *r) for r in rows], "contest_type string, year int, county string, code string, non_geographic boolean, bucket string, candidate string, votes double")
    direct = allocate.apportion(ballots, geometry, None, ("congressional",))
    return geometry, direct, allocate.allocate(direct, geometry, allocate.blends(spark))


@pytest.fixture(scope="module")
def targets(spark):
    return spark.createDataFrame([("congressional", "president", 2020, "1", -95.0), ("congressional", "president", 2020, "2", 10.0)], "scope string, contest_type string, year int, district string, target_margin_pct double")


def summary(spark, path):
    (text,) = [r["value"] for r in spark.read.text(path).collect()]
    return json.loads(text)


def test_diagnosis(spark, found, targets, tmp_path):
    reports.write_diagnosis(found[2], targets, str(tmp_path), scope_filters=["congressional"])
    errors = reports.read(spark, f"{tmp_path}/{reports.ERRORS}").collect()
    assert [r["district"] for r in errors] == ["2", "1"] and errors[0]["raw_abs_error_pct"] > errors[1]["raw_abs_error_pct"]
    assert errors[0]["top_counties"].startswith("Y:") and errors[0]["year"] == 2020
    parts = reports.read(spark, f"{tmp_path}/{reports.CONTRIBUTIONS}").collect()
    assert [(r["district"], r["county"]) for r in parts] == [("1", "X"), ("1", "Y"), ("2", "Y"), ("2", "X")]
    x = parts[0]
    assert x["district_county_total_votes"] == pytest.approx(x["district_county_direct_votes"] + x["district_county_allocated_votes"], abs=0.002)
    assert x["county_scope_input_votes"] == 130 and x["district_county_dem_votes"] == x["district_county_total_votes"]
    covered = {r["county"]: r for r in reports.read(spark, f"{tmp_path}/{reports.COVERAGE}").collect()}
    assert list(covered) == ["X", "Y", "Z"] and covered["Z"]["unallocated_pct"] == 100 and covered["X"]["allocated_pct"] == round(3000 / 130, 3)
    told = summary(spark, f"{tmp_path}/benchmark_diagnostics_summary")
    assert told["targets_used"] == 2 and told["scope_filters"] == ["congressional"] and [t["district"] for t in told["worst_targets"]] == ["2", "1"]


def test_tuning_and_suggestions(spark, found, targets, tmp_path):
    stats = tuning.statistics(found[1], found[0], targets)
    start = {("congressional", None): 0.35}
    best = reports.write_tuning(stats, start, [0.0001, 0.5, 1.0], str(tmp_path), rounds=2, targets_file="t.csv")
    told = summary(spark, f"{tmp_path}/party_blend_tuning_summary")
    assert told["best_metrics"]["mae"] <= told["baseline_metrics"]["mae"] and told["evaluations_run"] == 4 and told["targets_file"] == "t.csv"
    assert told["best_config"] == {"congressional": best["congressional", None]} and told["elapsed_seconds"] > 0
    for name in ("baseline", "best"):
        rows = reports.read(spark, f"{tmp_path}/party_blend_{name}_report")
        assert rows.agg(F.avg("raw_abs_error_pct")).first()[0] == pytest.approx(told[f"{name}_metrics"]["mae"], abs=1e-3)
    given = reports.write_suggestions(stats, start, [("congressional", "X"), ("congressional", "Y")], [0.0001, 1.0], str(tmp_path))
    rows = reports.read(spark, f"{tmp_path}/county_blend_override_suggestions").collect()
    assert [r["county"] for r in rows] == [r["county"] for r in given] == ["X"] and rows[0]["param_group"] == "congressional_county"
    assert summary(spark, f"{tmp_path}/county_blend_override_suggestions_summary")["candidate_counts"] == {"congressional": 2}
