"""Explicit splits, blends of counties, and counties that only their area's weights can serve."""

import pytest

from apportion.operators import allocate
from apportion.operators.crosswalk import Crosswalk

SPLITS = "scope string, county string, code string, district string, share double"
COUNTIES = "scope string, county string, district string, share double"
CODES = "scope string, county string, code string, weight double"
S = "congressional"


@pytest.fixture(scope="module")
def geometry(spark):
    return Crosswalk(
        spark.createDataFrame([(S, "A", "1", "d1", 1.0)], SPLITS),
        spark.createDataFrame([(S, "A", "d1", 0.6), (S, "A", "d2", 0.4), (S, "B", "d3", 1.0)], COUNTIES),
        spark.createDataFrame([(S, "A", "1", 1.0)], CODES),
    )


@pytest.fixture(scope="module")
def found(spark, geometry):
    explicit = Crosswalk(spark.createDataFrame([(S, "A", "9", "d2", 1.0), (S, "A", "1", "d9", 1.0)], SPLITS), geometry.county_weights.limit(0), geometry.code_weights.limit(0))
    rows = [("A", "1", "dem", "x", 10.0), ("A", "9", "rep", "y", 5.0), ("A", "777", "dem", "x", 4.0), ("B", "5", "dem", "x", 3.0), ("C", "1", "dem", "x", 2.0), ("A", "1", "other", None, 0.0)]
    ballots = spark.createDataFrame([("president", 2020, c, k, False, b, n, v) for c, k, b, n, v in rows], "contest_type string, year int, county string, code string, non_geographic boolean, bucket string, candidate string, votes double")
    return allocate.apportion(ballots, geometry, explicit, (S,))


def votes(df, *keys):
    return {tuple(r[k] for k in keys): pytest.approx(r["votes"]) for r in df.collect()}


def test_explicit_splits_serve_what_geometry_leaves_open(found):
    assert votes(found.contributions, "district", "bucket") == {("d1", "dem"): 10.0, ("d2", "rep"): 5.0}
    assert votes(found.unmatched, "county") == {("A",): 4.0, ("B",): 3.0, ("C",): 2.0}


@pytest.mark.parametrize(
    ("county", "strict", "want"),
    [
        (None, False, {"d1": 4 * (0.65 * 2 / 3 + 0.35), "d2": 4 * 0.65 / 3, "d3": 3.0}),
        (1.0, False, {"d1": 4.0, "d3": 3.0}),
        (0.0, False, {"d1": 4.0, "d3": 3.0}),  # a blend of 0 means the bucket's own districts alone
        (0.0, True, {"d1": 4 * 2 / 3, "d2": 4 / 3, "d3": 3.0}),
    ],
)
def test_blends_of_counties_and_area_weights(spark, found, geometry, county, strict, want):
    config = allocate.blends(spark, counties=() if county is None else ((S, "A", county),))
    given = allocate.allocate(found, geometry, config, strict).contributions.where("source = 'allocated'")
    assert votes(given, "district") == {(d,): v for d, v in want.items()}
    stats = allocate.coverage(allocate.allocate(found, geometry, config, strict)).first()
    assert stats["input_votes"] == pytest.approx(24) and stats["matched_votes"] == pytest.approx(22)


def test_known_counties_have_their_blends(spark, geometry):
    rows = spark.createDataFrame([("state_house", "STAFFORD COUNTY"), ("state_house", "ELSEWHERE"), ("congressional", "CHESAPEAKE CITY"), ("unknown", "X")], "scope string, county string")
    got = {(r["scope"], r["county"]): r["blend"] for r in allocate.with_blend(rows, allocate.blends(spark)).collect()}
    assert got == {("state_house", "STAFFORD COUNTY"): 1.0, ("state_house", "ELSEWHERE"): 0.15, ("congressional", "CHESAPEAKE CITY"): 0.55, ("unknown", "X"): 0.15}


def test_sums_over_counties_are_settled(spark):
    rows = [("s", "c", 2020, f"county {k % 9}", f"{k % 2}", ("dem", "rep")[k % 2], "X", ("direct", "allocated")[k % 3 // 2], 1.0 + k) for k in range(90)]
    made = spark.createDataFrame(rows, "scope string, contest_type string, year int, county string, district string, bucket string, candidate string, source string, votes double")
    found = allocate.Apportioned(made, made.where("source = 'allocated'"))
    own = allocate.over_counties(found)
    assert own.contributions.count() == 4 and own.contributions.groupBy().sum("votes").first()[0] == sum(r[-1] for r in rows)
    assert "Aggregate" not in own.contributions._jdf.queryExecution().optimizedPlan().toString()  # later sums don't work it out again
    for f in (lambda x: allocate.district_results(x.contributions), allocate.coverage):
        assert sorted(map(tuple, f(own).collect())) == sorted(map(tuple, f(found).collect()))


def test_allocated_votes_need_no_candidates_of_direct_ones(spark, geometry):
    """Direct votes are added up over candidates before they meet splits; what is unmatched, in some scope or all, keeps its own."""
    other = "state_house"
    two = Crosswalk(
        geometry.splits.union(spark.createDataFrame([(other, "A", "1", "h1", 0.5), (other, "A", "1", "h2", 0.5), (other, "B", "5", "h3", 1.0)], SPLITS)),
        geometry.county_weights.union(spark.createDataFrame([(other, "A", "h1", 1.0), (other, "B", "h3", 1.0)], COUNTIES)),
        geometry.code_weights.union(spark.createDataFrame([(other, "A", "1", 1.0)], CODES)),
    )
    explicit = Crosswalk(spark.createDataFrame([(S, "A", "9", "d2", 1.0)], SPLITS), geometry.county_weights.limit(0), geometry.code_weights.limit(0))
    rows = [("A", "1", False, "dem", "x", 10.0), ("A", "1", False, "dem", "y", 6.0), ("A", "1", True, "dem", "y", 2.0), ("A", "9", False, "rep", "y", 5.0), ("A", "777", False, "dem", "x", 4.0), ("B", "5", False, "dem", " x", 3.0), ("B", "5", False, "dem", "z", 1.0), ("C", "1", False, "dem", None, 2.0)]
    ballots = spark.createDataFrame([("president", 2020, *r) for r in rows], "contest_type string, year int, county string, code string, non_geographic boolean, bucket string, candidate string, votes double")
    whole, short = (allocate.apportion(ballots, two, explicit, (S, other), direct_candidates=d) for d in (True, False))
    keys = ("scope", "contest_type", "year", "county", "bucket", "candidate")
    assert votes(short.unmatched, *keys) == votes(whole.unmatched, *keys)
    assert whole.contributions.count() > short.contributions.count()
    assert {r["candidate"] for r in short.contributions.collect()} == {""}
    by_bucket = [k for k in keys if k != "candidate"] + ["district"]
    assert votes(short.contributions, *by_bucket) == votes(whole.contributions.groupBy(*by_bucket).agg({"votes": "sum"}).withColumnRenamed("sum(votes)", "votes"), *by_bucket)
    given = [votes(allocate.allocate(x, two, allocate.blends(spark)).contributions.where("source = 'allocated'"), *keys, "district") for x in (whole, short)]
    assert given[0] == given[1] and len(given[0]) > 5
