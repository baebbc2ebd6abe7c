"""Queries of places and files: overlays, outlines and points of rectangles made from keys, searches, layers and returns that are
written to files and read again, reports; with their SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from apportion.functions import text as T
from apportion.functions import votes as V
from apportion.functions.settle import scratch
from apportion.operators import allocate, crosswalk, diagnose, dims, geo, trend
from apportion.sources import geojson, order, outputs, tables

from . import ballots as B
from .catalogue import SCOPES, _allocated, _crosswalk, _names, _NAMES_SQL, query, rounded

# Rectangles: parts are small ones, suppliers large ones.

_SMALL_SQL = "a AS (SELECT p_partkey AS id, CAST(p_partkey * 7 % 101 AS DOUBLE) AS x, CAST(p_partkey * 13 % 89 AS DOUBLE) AS y, 0.5 + p_size % 4 AS w, 0.25 + p_partkey % 3 AS h FROM part)"
_LARGE_SQL = "c AS (SELECT s_suppkey AS id, s_nationkey, CAST(s_suppkey * 11 % 97 AS DOUBLE) AS x, CAST(s_suppkey * 5 % 83 AS DOUBLE) AS y, 2.125 + s_suppkey % 9 AS w, 2.0 + s_nationkey % 7 AS h FROM supplier)"
_COMMON_SQL = f"""{_SMALL_SQL}, {_LARGE_SQL}, o AS (SELECT a.id AS left_id, c.id AS right_id, (least(a.x + a.w, c.x + c.w) - greatest(a.x, c.x)) * (least(a.y + a.h, c.y + c.h) - greatest(a.y, c.y)) AS area
  FROM a JOIN c ON a.x < c.x + c.w AND c.x < a.x + a.w AND a.y < c.y + c.h AND c.y < a.y + a.h)"""


def _rectangle(x, y, w, h):
    corners = [(x, y), (x, y + h), (x + w, y + h), (x + w, y), (x, y)]
    return F.array(F.array(*[F.struct(a.cast("double").alias("x"), b.cast("double").alias("y")) for a, b in corners]))


def _small(spark, sf_dir):
    k = F.col("p_partkey")
    return B.read(spark, sf_dir, "part").select(k.alias("id"), _rectangle(k * 7 % 101, k * 13 % 89, F.col("p_size") % 4 + 0.5, k % 3 + 0.25).alias("rings"))


def _large(spark, sf_dir):
    k = F.col("s_suppkey")
    return B.read(spark, sf_dir, "supplier").select(k.alias("id"), "s_nationkey", _rectangle(k * 11 % 97, k * 5 % 83, k % 9 + 2.125, F.col("s_nationkey") % 7 + 2.0).alias("rings"))


@query(f"WITH {_COMMON_SQL} SELECT left_id, right_id, round(area, 6) AS area FROM o")
def overlay_areas(spark, sf_dir):
    return rounded(geo.overlay(_small(spark, sf_dir), _large(spark, sf_dir).select("id", "rings")), 6, "area")


@query(f"""WITH {_COMMON_SQL}, s AS (SELECT CAST(left_id % 30 AS VARCHAR) AS county, CAST(left_id AS VARCHAR) AS code, CAST(right_id % 12 AS VARCHAR) AS district, sum(area) AS w FROM o GROUP BY ALL)
SELECT county, code, district, round(w / sum(w) OVER (PARTITION BY county, code), 8) AS share FROM s""")
def overlay_crosswalk(spark, sf_dir):
    own = _small(spark, sf_dir).select("id", (F.col("id") % 30).cast("string").alias("county"), F.col("id").cast("string").alias("code"), "rings")
    districts = _large(spark, sf_dir).select((F.col("id") % 12).cast("string").alias("SLDLST"), "rings")
    return rounded(crosswalk.from_overlay(own, districts, "state_house").splits.drop("scope"), 8, "share")


_BLOCKS_SQL = "b AS (SELECT DISTINCT c_nationkey AS owner, c_custkey * 7 % 53 AS x, c_custkey * 3 % 47 AS y FROM customer)"


def _blocks(spark, sf_dir):
    k = F.col("c_custkey")
    cells = B.read(spark, sf_dir, "customer").select(F.col("c_nationkey").alias("owner"), (k * 7 % 53).alias("x"), (k * 3 % 47).alias("y")).distinct()
    return cells.select("owner", _rectangle(F.col("x"), F.col("y"), F.lit(1), F.lit(1)).alias("rings"))


@query(f"""WITH {_BLOCKS_SQL}, n AS (SELECT b.owner, (SELECT count(*) FROM b AS o WHERE o.owner = b.owner AND abs(o.x - b.x) + abs(o.y - b.y) = 1) AS near FROM b)
SELECT owner, CAST(count(*) AS DOUBLE) AS area, CAST(sum(4 - near) AS BIGINT) AS edges FROM n GROUP BY owner""")
def dissolved_outlines(spark, sf_dir):
    edges = F.aggregate("rings", F.lit(0).cast("long"), lambda s, r: s + F.size(r) - 1)
    return geo.dissolve(_blocks(spark, sf_dir), "owner").select("owner", geo.area(F.col("rings")).alias("area"), edges.alias("edges"))


@query(f"""WITH {_SMALL_SQL} SELECT id, CASE WHEN id % 5 = 0 THEN CAST(id AS DOUBLE) ELSE round(x + w / 2, 6) END AS lon, round(y + h / 2, 6) AS lat FROM a""")
def centroid_points(spark, sf_dir):
    own = _small(spark, sf_dir).withColumn("lon", F.when(F.col("id") % 5 == 0, F.col("id").cast("string"))).withColumn("lat", F.lit(None).cast("string"))
    return rounded(geo.centroid_layer(own), 6, "lon", "lat")


# A layer written as one collection and read again: rectangles of a nation are one feature, with holes where they are odd.

@query(f"""WITH {_LARGE_SQL} SELECT CAST(id AS VARCHAR) AS id, CAST(s_nationkey AS VARCHAR) AS nation, CASE WHEN id % 3 = 0 THEN 'MultiPolygon' ELSE 'Polygon' END AS kind, CAST(CASE WHEN id % 3 = 0 THEN 3 ELSE 1 END AS INT) AS n_rings,
round(w * h + CASE WHEN id % 3 = 0 THEN 1.0 - 0.25 ELSE 0 END, 6) AS area FROM c""")
def geojson_round_trip(spark, sf_dir):
    far = _rectangle(F.lit(200), F.lit(200), F.lit(1), F.lit(1))
    hole = F.transform(_rectangle(F.lit(200.25), F.lit(200.25), F.lit(0.5), F.lit(0.5)), F.reverse)
    layer = _large(spark, sf_dir).withColumn("rings", F.when(F.col("id") % 3 == 0, F.concat("rings", hole, far)).otherwise(F.col("rings")))
    made = geojson.features(layer.withColumn("g", geojson.polygon(F.col("rings"))).withColumnRenamed("s_nationkey", "nation"), "g", "id", "nation", keep=("id",))
    path = scratch(spark)
    geojson.write_collection(made, path, "id")
    rings = geojson.rings(F.col("geometry"))
    back = geojson.read(spark, path).select(F.col("properties.id").alias("id"), F.col("properties.nation").alias("nation"), F.get_json_object("geometry", "$.type").alias("kind"), F.size(rings).alias("n_rings"), geo.area(rings).alias("area"))
    return rounded(back, 6, "area")


# Returns written to files of both layouts and read again.

_RETURNS_SQL = f"""WITH {B.LINES_SQL}, v AS (SELECT upper(county) AS county, year, lpad(CAST(l_partkey % 200 AS VARCHAR), 3, '0') || ' - MAIN' AS precinct, candidate, bucket, CAST(sum(votes) AS BIGINT) AS votes FROM b WHERE l_linenumber > 1 AND contest_type = '1-URGENT' GROUP BY ALL)"""


def _returns(spark, sf_dir):
    own = B.lines(spark, sf_dir).where("l_linenumber > 1 AND contest_type = '1-URGENT'")
    label = F.concat(F.lpad((F.col("l_partkey") % 200).cast("string"), 3, "0"), F.lit(" - Main (CD 1)"))
    return own.groupBy("county", "year", label.alias("precinct"), "candidate", "party").agg(F.sum("votes").cast("bigint").alias("votes"))


@query(f"""{_RETURNS_SQL} SELECT county, precinct || ' ' || year AS precinct, 'President' AS office, CASE bucket WHEN 'dem' THEN 'DEM' WHEN 'rep' THEN 'REP' ELSE 'LIB' END AS party, candidate, votes FROM v WHERE year < 1998 AND votes > 0""")
def wide_returns(spark, sf_dir):
    """A pivoted file for each year, whose candidates are not the same, read in one scan."""
    own = _returns(spark, sf_dir).where("year < 1998").withColumn("precinct", F.regexp_replace("precinct", " \\(", F.concat(F.lit(" "), "year", F.lit(" ("))))
    columns = own.groupBy("year").agg(F.array_sort(F.collect_set(F.struct("candidate", "party"))).alias("columns"))  # as many as a contest has candidates
    cells = own.groupBy("year", "county", "precinct").agg(F.map_from_entries(F.collect_list(F.struct(F.struct("candidate", "party"), "votes"))).alias("votes"))
    quoted = lambda x: F.concat(F.lit('"'), x, F.lit('"'))
    tail = F.transform("columns", lambda c: F.coalesce(F.format_number(F.try_element_at("votes", c), 0), F.lit("-")))
    rows = cells.join(columns, "year").select("year", F.lit(2).alias("k"), F.concat_ws(",", quoted(F.col("county")), F.lit(""), quoted(F.col("precinct")), F.array_join(F.transform(tail, quoted), ","), F.lit("9")).alias("line"))
    head = columns.select("year", F.lit(0).alias("k"), F.concat_ws(",", F.lit("﻿County/City,Ward,Pct"), F.array_join(F.transform("columns", lambda c: quoted(c["candidate"])), ","), F.lit("Total Votes Cast")).alias("line"))
    party = columns.select("year", F.lit(1).alias("k"), F.concat_ws(",", F.lit(",,"), F.array_join(F.transform("columns", lambda c: c["party"]), ","), F.lit("")).alias("line"))
    path = scratch(spark)
    # One file a year: it has one head. A pivoted file is one contest's, and as long as there are precincts.
    every = rows.unionByName(head).unionByName(party).withColumnRenamed("year", "of")
    every.repartition("of").sortWithinPartitions("of", "k", "line").select("of", "line").write.partitionBy("of").text(path)
    return tables.wide(spark, f"{path}/*/*", "president").select("county", "precinct", "office", "party", "candidate", "votes")


@query(f"""{_RETURNS_SQL} SELECT county, precinct, 'Member, Test (' || year || 'th)' AS office, CASE WHEN bucket = 'dem' THEN '7' ELSE '' END AS district, CASE bucket WHEN 'dem' THEN 'DEM' WHEN 'rep' THEN 'REP' ELSE 'LIB' END AS party, candidate, votes FROM v WHERE year >= 1998 AND votes > 0""")
def long_returns(spark, sf_dir):
    """Files with a line for each candidate, written as canonical ones and read as such again."""
    own = _returns(spark, sf_dir).where("year >= 1998")
    first, second = scratch(spark), scratch(spark)
    kind = F.when(F.col("party") == "Democratic", "congressional").otherwise("State")
    own.select(F.col("county").alias("LocalityName"), F.col("precinct").alias("PrecinctName"), F.concat(F.lit("Member, Test ("), "year", F.lit("th)")).alias("OfficeTitle"), F.col("candidate").alias("CandidateName"), F.col("party").alias("Party"), F.format_number("votes", 0).alias("TOTAL_VOTES"), kind.alias("DistrictType"), F.lit("7").alias("DistrictName")).write.option("header", True).csv(first)
    tables.write_canonical(tables.long(spark, first).withColumn("year", F.lit(2024)), second)
    return tables.canonical(spark, second).select("county", "precinct", "office", F.coalesce("district", F.lit("")).alias("district"), "party", "candidate", F.col("votes").cast("bigint").alias("votes"))


@query(f"""WITH {B.LINES_SQL}, s AS (SELECT county, year, CAST(sum(votes) AS BIGINT) AS votes FROM b GROUP BY ALL) SELECT county, year, CASE WHEN year = 1996 THEN 2 * votes ELSE votes END AS votes, CAST(2 AS INT) AS version FROM s""")
def staged_patch(spark, sf_dir):
    """Slices written, read, patched and written in place of themselves."""
    rows = B.lines(spark, sf_dir).groupBy("county", "year").agg(F.sum("votes").cast("bigint").alias("votes"))
    path = scratch(spark)
    tables.write_slices(rows.select("year", "county", F.to_json(F.struct("votes")).alias("payload")), path, "year")
    old = tables.read_slices(spark, path)
    numbered = B.lines(spark, sf_dir).groupBy("county", "year").agg(F.sum("votes").cast("bigint").alias("votes"))
    text = F.to_json(F.struct("county", F.when(F.col("year") == 1996, 2 * F.col("votes")).otherwise(F.col("votes")).alias("votes")))
    # What is written comes from the slices that it replaces, joined with what they lack.
    fixed = old.select("year", F.get_json_object("payload", "$.votes").cast("bigint").alias("votes")).distinct().join(numbered, ["year", "votes"]).select("year", text.alias("payload"))
    n = tables.write_slices(fixed, path, "year")
    back = tables.read_slices(spark, path)
    return back.select(F.get_json_object("payload", "$.county").alias("county"), "year", F.get_json_object("payload", "$.votes").cast("bigint").alias("votes"), F.lit(n).alias("version"))


# Localities.


@query(f"""WITH {_NAMES_SQL}, t AS (SELECT DISTINCT term FROM (SELECT n_name AS term FROM nation UNION ALL SELECT substr(n_name, 1, 8) FROM nation UNION ALL SELECT 'City of ' || n_name FROM nation UNION ALL SELECT n_name || ' county' FROM nation WHERE n_nationkey < 9)),
k AS (SELECT term, CASE WHEN upper(term) LIKE 'CITY OF %' THEN substr(upper(term), 9) || ' CITY' ELSE upper(term) END AS key FROM t), m AS (SELECT alias, count(*) AS n FROM al GROUP BY alias),
f AS (SELECT term, canonical, min((CASE WHEN alias = key AND n = 1 THEN 1 WHEN alias = key THEN 2 ELSE 3 END) * 1000 + length(alias)) AS best FROM k JOIN al ON starts_with(alias, key) JOIN m USING (alias) GROUP BY term, canonical)
SELECT term, CAST(place AS INT) AS place, canonical, CASE best // 1000 WHEN 1 THEN 'exact' WHEN 2 THEN 'ambiguous' ELSE 'prefix' END AS kind FROM (SELECT *, row_number() OVER (PARTITION BY term ORDER BY best, canonical) AS place FROM f) WHERE place <= 5""")
def locality_search(spark, sf_dir):
    n = B.read(spark, sf_dir, "nation")
    terms = n.select("n_name").union(n.select(F.substring("n_name", 1, 8))).union(n.select(F.concat(F.lit("City of "), "n_name"))).union(n.where("n_nationkey < 9").select(F.concat("n_name", F.lit(" county"))))
    return dims.search(terms.toDF("term"), _names(spark, sf_dir))


@query("""SELECT o_orderkey, CASE WHEN year(o_orderdate) = 1996 THEN CASE WHEN o_custkey % 2 = 0 THEN 'KING AND QUEEN' ELSE 'KING & QUEEN' END ELSE 'KING & QUEEN' END || ' ' || (o_custkey % 7) || CASE WHEN o_orderkey % 3 = 0 THEN ' CITY' ELSE '' END AS key,
CASE WHEN o_orderkey % 4 = 0 THEN 'NAME ' || (o_custkey % 5) ELSE 'LONG ' || (o_custkey % 5) || ' COUNTY' END AS locality, CASE year(o_orderdate) WHEN 1996 THEN '20201103' ELSE year(o_orderdate) || '1101' END AS day_token,
CASE WHEN o_orderkey % 5 IN (0, 1) THEN '' ELSE 'District ' || (o_custkey % 9) END AS district, CAST(round_even(o_totalprice * 0.01, 0) AS BIGINT) AS whole FROM orders""", exact=True)
def key_functions(spark, sf_dir):
    """Keys by year, Census names, dates, districts of rows and whole votes."""
    year, cust, key = F.year("o_orderdate"), F.col("o_custkey"), F.col("o_orderkey")
    raw = F.concat(F.when(key % 3 == 0, "City of ").otherwise(""), F.lit(" king  & queen "), (cust % 7).cast("string"))
    as_2025 = F.when((year == 1996) & (cust % 2 == 0), 2025).otherwise(2024)
    census = T.census_locality(F.concat(F.lit("name "), cust % 5), F.when(key % 4 != 0, F.concat(F.lit("Long "), cust % 5, F.lit("  County"))))
    day = T.date_token(T.general_date(F.when(year == 1996, 2020).otherwise(year)))
    district = T.district_of_row(F.when(key % 5 > 0, F.concat(F.lit(" District "), cust % 9)).otherwise(" "), F.when(key % 5 == 1, "State").otherwise("Congressional"))
    return B.read(spark, sf_dir, "orders").select("o_orderkey", T.locality_key_of_year(raw, as_2025).alias("key"), census.alias("locality"), day.alias("day_token"), district.alias("district"), V.round_half_even(F.col("o_totalprice") * 0.01).alias("whole"))


# Reports.


@query(f"""WITH {B.APPORTION_SQL}, k AS (SELECT scope, contest_type, year, district, county, sum(CASE WHEN source = 'allocated' THEN votes ELSE 0 END) AS y, sum(votes) AS v FROM con GROUP BY ALL),
r AS (SELECT *, v / sum(v) OVER (PARTITION BY scope, contest_type, year, district) AS part, row_number() OVER (PARTITION BY scope, contest_type, year, district ORDER BY round(v, 6) DESC, county) AS n FROM k)
SELECT scope, contest_type, year, district, string_agg(county, '|' ORDER BY n) AS counties, round(sum(part), 6) AS share, round(sum(y / v), 6) AS allocated FROM r WHERE n <= 6 GROUP BY ALL""")
def leading_counties(spark, sf_dir):
    """The counties of top_counties' text, in order, with their shares as numbers, which texts round."""
    rows = diagnose.county_contributions(_allocated(spark, sf_dir)).withColumn("total_votes", F.round("total_votes", 6))
    names = diagnose.top_counties(rows).withColumn("county", F.explode(F.transform(F.split("top_counties", r" \| "), lambda x: F.regexp_extract(x, r"^(.*):", 1))))
    key = ["scope", "contest_type", "year", "district"]
    own = names.join(rows, [*key, "county"]).groupBy(*key).agg(F.first(F.array_join(F.transform(F.split("top_counties", r" \| "), lambda x: F.regexp_extract(x, r"^(.*):", 1)), "|")).alias("counties"), F.sum("district_share_of_total").alias("share"), F.sum("allocated_share").alias("allocated"))
    return rounded(own, 6, "share", "allocated")


@query(f"""WITH {B.APPORTION_SQL}, c AS (SELECT scope, contest_type, year, county, sum(CASE WHEN source = 'direct' THEN votes ELSE 0 END) AS x, sum(CASE WHEN source = 'allocated' THEN votes ELSE 0 END) AS y FROM con GROUP BY ALL), u AS (SELECT scope, contest_type, year, county, sum(votes) AS z FROM unm GROUP BY ALL)
SELECT scope, contest_type, year, county, round(greatest(coalesce(z, 0) - coalesce(y, 0), 0), 2) AS unallocated_votes, round(CASE WHEN coalesce(x, 0) + coalesce(z, 0) > 0 THEN coalesce(x, 0) / (coalesce(x, 0) + coalesce(z, 0)) * 100 ELSE 0 END, 2) AS direct_match_pct, round(CASE WHEN coalesce(x, 0) + coalesce(z, 0) > 0 THEN coalesce(y, 0) / (coalesce(x, 0) + coalesce(z, 0)) * 100 ELSE 0 END, 2) AS allocated_pct
FROM c FULL JOIN u USING (scope, contest_type, year, county)""")
def county_coverage(spark, sf_dir):
    rows = diagnose.county_coverage(_allocated(spark, sf_dir))
    pct = [(V.share(F.col(c), F.col("input_votes")) * 100).alias(n) for c, n in (("direct_votes", "direct_match_pct"), ("allocated_votes", "allocated_pct"))]
    return rounded(rows.select("scope", "contest_type", "year", "county", F.greatest("unallocated_votes", F.lit(0.0)).alias("unallocated_votes"), *pct), 2, "unallocated_votes", "direct_match_pct", "allocated_pct")


_BLENDED_SQL = """SELECT scope, contest_type, year, district, county, bucket, round(sum(votes), 3) AS votes FROM al GROUP BY ALL"""


@query(f"WITH {B.APPORTION_SQL} {_BLENDED_SQL}".replace("(CASE WHEN tt.scope = 'congressional' THEN 0.65 ELSE 0.85 END) * ts + (CASE WHEN tt.scope = 'congressional' THEN 0.35 ELSE 0.15 END)", "(1 - CASE WHEN tt.county = 'FRANCE' THEN 0.9 WHEN tt.scope = 'congressional' AND tt.county < 'D' THEN 0.5 WHEN tt.scope = 'congressional' THEN 0.25 ELSE 0.15 END) * ts + (CASE WHEN tt.county = 'FRANCE' THEN 0.9 WHEN tt.scope = 'congressional' AND tt.county < 'D' THEN 0.5 WHEN tt.scope = 'congressional' THEN 0.25 ELSE 0.15 END)"))
def blends_by_county(spark, sf_dir):
    """Allocation with blends of a scope's default, of counties, and of scopes without any (0.15)."""
    geometry = _crosswalk(spark, sf_dir)
    direct = allocate.apportion(B.ballots(spark, sf_dir), geometry, None, SCOPES, False)
    n = B.read(spark, sf_dir, "nation").select(F.col("n_name").alias("county"))
    each = n.where("county = 'FRANCE'").select(F.explode(F.array(*[F.lit(s) for s in SCOPES])).alias("scope"), "county", F.lit(0.9).alias("blend"))
    config = each.union(n.where("county < 'D' AND county != 'FRANCE'").select(F.lit("congressional"), "county", F.lit(0.5))).union(n.limit(1).select(F.lit("congressional"), F.lit(None).cast("string"), F.lit(0.25)))
    rows = allocate.allocate(direct, geometry, config).contributions.where("source = 'allocated'")
    return rounded(rows.groupBy("scope", "contest_type", "year", "district", "county", "bucket").agg(F.sum("votes").alias("votes")), 3, "votes")


@query(f"""WITH {B.APPORTION_SQL}, k AS (SELECT scope, contest_type, year, district, county, sum(CASE WHEN source = 'allocated' THEN votes ELSE 0 END) AS y, sum(votes) AS v FROM con GROUP BY ALL),
r AS (SELECT *, v / sum(v) OVER (PARTITION BY scope, contest_type, year, district) AS part FROM k),
e AS (SELECT scope, contest_type, year, district FROM res WHERE abs((rep_votes - dem_votes) / total_votes * 100) >= 5)
SELECT DISTINCT scope, county FROM r SEMI JOIN e USING (scope, contest_type, year, district) WHERE part >= 0.04 AND y / v >= 0.2""")
def tuning_candidates(spark, sf_dir):
    found = _allocated(spark, sf_dir)
    results = allocate.district_results(found.contributions)
    report = results.withColumn("raw_abs_error_pct", F.abs(V.margin_pct(F.col("dem_votes"), F.col("rep_votes"), F.col("total_votes"))))
    return diagnose.candidate_counties(report, diagnose.county_contributions(found), 5.0, 0.04, 0.2)


@query("""SELECT CAST(place AS INT) AS id, district, scope, e AS raw_abs_error_pct, status FROM (SELECT *, row_number() OVER (ORDER BY CASE WHEN status = 'ok' THEN 0 ELSE 1 END, coalesce(e, 0) DESC, CASE scope WHEN 'congressional' THEN 1 WHEN 'state_house' THEN 2 ELSE 3 END, year, CASE WHEN regexp_matches(district, '^[0-9]+$') THEN 0 ELSE 1 END, district) AS place
FROM (SELECT CAST(o_orderkey AS VARCHAR) || CASE WHEN o_orderkey % 5 = 0 THEN 'X' ELSE '' END AS district, CASE o_custkey % 3 WHEN 0 THEN 'congressional' WHEN 1 THEN 'state_house' ELSE 'state_senate' END AS scope, CAST(year(o_orderdate) AS INT) AS year, CASE WHEN o_custkey % 7 > 0 THEN CAST(o_custkey % 50 AS DOUBLE) / 4 END AS e, CASE WHEN o_custkey % 11 = 0 THEN 'missing_output' ELSE 'ok' END AS status FROM orders))""", exact=True)
def report_order(spark, sf_dir):
    """Rows numbered in the order of the margin report."""
    cust, key = F.col("o_custkey"), F.col("o_orderkey")
    scope = F.element_at(F.array(*[F.lit(s) for s in ("congressional", "state_house", "state_senate")]), (cust % 3 + 1).cast("int"))
    rows = B.read(spark, sf_dir, "orders").select(F.concat(key.cast("string"), F.when(key % 5 == 0, "X").otherwise("")).alias("district"), scope.alias("scope"), F.lit("president").alias("contest_type"), F.year("o_orderdate").alias("year"), F.when(cust % 7 > 0, (cust % 50).cast("double") / 4).alias("raw_abs_error_pct"), F.when(cust % 11 == 0, "missing_output").otherwise("ok").alias("status"))
    keys = outputs.margin_order()
    keyed = rows.select("*", *[(-c[0] if isinstance(c, tuple) else c).alias(f"__k{i}") for i, c in enumerate(keys)])
    return order.row_numbers(keyed, *[c for c in keyed.columns if c.startswith("__k")]).select("id", "district", "scope", "raw_abs_error_pct", "status")


@query("""SELECT n_name AS unit, CASE WHEN n_nationkey % 5 * 25.0 - 1 >= 98 THEN 'high' WHEN n_nationkey % 5 * 25.0 + 5 >= 80 THEN 'medium' ELSE 'low' END AS confidence FROM nation""".replace("25.0 - 1 >= 98", "25.0 + 5 >= 98"))
def confidence_levels(spark, sf_dir):
    n = B.read(spark, sf_dir, "nation")
    return n.select(F.col("n_name").alias("unit"), trend.confidence(F.col("n_nationkey") % 5 * 25.0 + 5).alias("confidence"))
