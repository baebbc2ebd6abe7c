"""More queries over the test tables: filters, comparisons, orders, manifests, fallbacks and insights, with their SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from apportion.operators import contest, diagnose, population, resolve, trend, tune
from apportion.sources import outputs

from . import ballots as B
from .catalogue import query, rounded

_SLICES_SQL = f"""{B.LINES_SQL}, s AS (SELECT scope, contest_type, year, CAST(s_nationkey % n + 1 AS VARCHAR) AS district, CAST(sum(CASE WHEN bucket = 'dem' THEN votes ELSE 0 END) AS BIGINT) AS dem_votes,
CAST(sum(CASE WHEN bucket = 'rep' THEN votes ELSE 0 END) AS BIGINT) AS rep_votes, CAST(sum(CASE WHEN bucket = 'other' THEN votes ELSE 0 END) AS BIGINT) AS other_votes FROM b CROSS JOIN ({B._SCOPES_SQL}) GROUP BY ALL)"""


def _slices(spark, sf_dir):
    """Whole votes of each scope's districts, where a district is that of the supplier's nation."""
    lines = B.lines(spark, sf_dir)
    lines = lines.withColumn("bucket", F.when(F.col("party") == "Democratic", "dem").when(F.col("party") == "REPUBLICAN", "rep").otherwise("other"))
    sums = lines.groupBy("contest_type", "year", "s_nationkey").agg(*contest.bucket_sums(suffix="_votes", cast="bigint"))
    each = F.explode(F.array(*[F.struct(F.lit(s).alias("scope"), (F.col("s_nationkey") % n + 1).cast("string").alias("district")) for s, n in B.SCOPE_DISTRICTS.items()])).alias("x")
    rows = sums.select("*", each).select("x.scope", "contest_type", "year", "x.district", "dem_votes", "rep_votes", "other_votes")
    return rows.groupBy("scope", "contest_type", "year", "district").agg(*[F.sum(c).alias(c) for c in ("dem_votes", "rep_votes", "other_votes")])


@query(f"WITH {_SLICES_SQL} SELECT * FROM s WHERE year IN (1996, 1998) AND scope IN ('state_house')")
def select_contests(spark, sf_dir):
    return diagnose.select_contests(_slices(spark, sf_dir), years=(1996, 1998), scopes=("state_house",))


@query(f"""WITH {_SLICES_SQL} SELECT scope, contest_type, year, scope || '.json' AS file, CASE WHEN scope = 'state_senate' THEN CAST(7 AS BIGINT) ELSE count(*) END AS rows,
CASE WHEN scope = 'state_senate' THEN CAST(0 AS BIGINT) ELSE CAST(sum(dem_votes) AS BIGINT) END AS dem_total, CASE WHEN scope = 'state_senate' THEN CAST(0 AS BIGINT) ELSE CAST(sum(rep_votes) AS BIGINT) END AS rep_total,
CASE WHEN scope = 'state_senate' THEN false ELSE sum(dem_votes) > 0 AND sum(rep_votes) > 0 END AS major_party_contested FROM s GROUP BY scope, contest_type, year""")
def manifest_refresh(spark, sf_dir):
    rows = _slices(spark, sf_dir)
    entries = rows.select("scope", "contest_type", "year").distinct().select("*", F.concat("scope", F.lit(".json")).alias("file"), F.lit(7).cast("bigint").alias("rows"), F.lit(0).cast("bigint").alias("dem_total"), F.lit(0).cast("bigint").alias("rep_total"), F.lit(False).alias("major_party_contested"))
    return outputs.refreshed(entries, rows.where("scope != 'state_senate'"))


@query(f"""WITH {_SLICES_SQL}, p AS (SELECT scope, contest_type, year, district, CASE WHEN district = '2' THEN CAST(10 AS BIGINT) ELSE dem_votes END AS dem_votes, CASE WHEN district = '2' THEN CAST(30 AS BIGINT) ELSE rep_votes END AS rep_votes,
CASE WHEN district = '2' THEN CAST(0 AS BIGINT) ELSE other_votes END AS other_votes, CASE WHEN district = '2' THEN 'New' ELSE 'Old' END AS dem_candidate, 'Old' AS rep_candidate FROM s), t AS (SELECT *, dem_votes + rep_votes + other_votes AS total_votes FROM p)
SELECT *, CASE WHEN rep_votes > dem_votes THEN 'Republican' WHEN dem_votes > rep_votes THEN 'Democratic' ELSE 'Tie' END AS winner, abs(rep_votes - dem_votes) AS margin FROM t""")
def slice_patch(spark, sf_dir):
    rows = _slices(spark, sf_dir).withColumn("total_votes", F.expr("dem_votes + rep_votes + other_votes")).select("*", F.lit("Old").alias("dem_candidate"), F.lit("Old").alias("rep_candidate"), F.lit("").alias("winner"), F.lit(0).cast("bigint").alias("margin"))
    fixes = rows.where("district = '2'").select("scope", "contest_type", "year", "district", F.lit(10).alias("dem_votes"), F.lit(30).alias("rep_votes"), F.lit(0).alias("other_votes"), F.lit("New").alias("dem_candidate"), F.lit(" ").alias("rep_candidate"))
    return outputs.patched(rows, fixes)


_TRIAL_SQL = """(SELECT scope, contest_type, year, district, abs(dem_votes - rep_votes) / 8.0 AS e, abs(dem_votes - 2 * rep_votes) / 16.0 AS a, CASE WHEN district = '3' THEN NULL ELSE abs(2 * dem_votes - rep_votes) / 16.0 END AS z FROM s)"""
_PAIRS_SQL = f"""c AS (SELECT 'a' AS config_id, scope, contest_type, year, district, e, a AS t FROM {_TRIAL_SQL} UNION ALL SELECT 'z', scope, contest_type, year, district, e, coalesce(z, e) FROM {_TRIAL_SQL})"""


def _compared(spark, sf_dir):
    rows = _slices(spark, sf_dir)
    key = ["scope", "contest_type", "year", "district"]
    base = rows.select(*key, (F.abs(F.col("dem_votes") - F.col("rep_votes")) / 8.0).alias("abs_error"))
    a = rows.select(F.lit("a").alias("config_id"), *key, (F.abs(F.col("dem_votes") - 2 * F.col("rep_votes")) / 16.0).alias("abs_error"))
    z = rows.where("district != '3'").select(F.lit("z").alias("config_id"), *key, (F.abs(2 * F.col("dem_votes") - F.col("rep_votes")) / 16.0).alias("abs_error"))
    return tune.compared(base, a.unionByName(z))


@query(f"WITH {_SLICES_SQL}, {_PAIRS_SQL} SELECT config_id, scope, contest_type, year, district, CAST(e AS DOUBLE) AS baseline_abs_error, CAST(t AS DOUBLE) AS trial_abs_error, CAST(e - t AS DOUBLE) AS improvement FROM c WHERE e - t > 0")
def baseline_vs_trial(spark, sf_dir):
    return _compared(spark, sf_dir)


@query(f"""WITH {_SLICES_SQL}, {_PAIRS_SQL}, r AS (SELECT *, row_number() OVER (PARTITION BY config_id ORDER BY e - t DESC, scope, contest_type, year, district) AS n FROM c WHERE e - t > 0)
SELECT config_id, CAST(n AS INT) AS place, scope, contest_type, year, district FROM r WHERE n <= 5""")
def top_improved_targets(spark, sf_dir):
    parsed = F.from_json("top_improved_targets", "array<struct<scope: string, contest_type: string, year: int, district: string>>")
    rows = tune.top_improved(_compared(spark, sf_dir)).select("config_id", F.posexplode(parsed).alias("place", "t"))
    return rows.select("config_id", (F.col("place") + 1).cast("int").alias("place"), "t.*")


@query(f"""WITH {_SLICES_SQL} SELECT scope, contest_type, year, district, CAST(row_number() OVER (ORDER BY CASE scope WHEN 'congressional' THEN 1 WHEN 'state_house' THEN 2 ELSE 3 END, contest_type, year, CASE WHEN regexp_matches(district, '^[0-9]+$') THEN 0 ELSE 1 END, district) AS INT) AS id FROM s""")
def override_order(spark, sf_dir):
    from apportion.sources.order import row_numbers

    rows = _slices(spark, sf_dir).select("scope", "contest_type", "year", "district")
    names = [f"k{i}" for i in range(len(outputs.override_order()))]
    keyed = rows.select("*", *[c.alias(n) for c, n in zip(outputs.override_order(), names, strict=True)])
    return row_numbers(keyed, *names).select(*rows.columns, "id")


_FILES_SQL = """f AS (SELECT (1000 + o_custkey % 40) || '-x' AS file, o_orderkey AS position, CASE WHEN o_orderkey % 3 = 0 THEN '' ELSE strftime(o_orderdate, '%Y-%m-%d') END AS day, CASE WHEN o_orderkey % 5 = 0 THEN 'Special Election' WHEN o_orderkey % 5 = 1 THEN 'General' ELSE '' END AS kind,
CASE WHEN o_custkey % 40 < 20 THEN 'Governor' ELSE o_orderpriority END AS office, o_totalprice > 100000 AS kept FROM orders)"""


@query(f"""WITH {_FILES_SQL}, g AS (SELECT file, arg_min(day, position) FILTER (WHERE day <> '') AS election_date, CASE arg_max(kind, position) FILTER (WHERE kind <> '') WHEN 'Special Election' THEN 'special_election' ELSE 'general' END AS election_type,
CASE WHEN count(DISTINCT CASE WHEN kept THEN office END) = 1 AND min(CASE WHEN kept THEN office END) = 'Governor' THEN 'governor' ELSE 'multi_office' END AS office, CAST(sum(CASE WHEN kept THEN 1 ELSE 0 END) AS BIGINT) AS n_rows FROM f GROUP BY file)
SELECT *, substr(election_date, 1, 4) || '/' || replace(election_date, '-', '') || '__va__' || election_type || '__precinct__' || office || '.csv' AS name FROM g""")
def file_profile(spark, sf_dir):
    o = B.read(spark, sf_dir, "orders")
    rows = o.select(
        F.concat((1000 + F.col("o_custkey") % 40).cast("string"), F.lit("-x")).alias("file"),
        F.col("o_orderkey").alias("position"),
        F.when(F.col("o_orderkey") % 3 == 0, " ").otherwise(F.date_format("o_orderdate", "yyyy-MM-dd")).alias("ElectionDate"),
        F.when(F.col("o_orderkey") % 5 == 0, "Special Election").when(F.col("o_orderkey") % 5 == 1, " General ").otherwise("").alias("ElectionType"),
        F.when(F.col("o_custkey") % 40 < 20, "Governor").otherwise(F.col("o_orderpriority")).alias("office"),
        (F.col("o_totalprice") > 100000).alias("kept"),
    )
    found = outputs.file_profile(rows)
    return found.withColumn("name", outputs.output_name(F.col("election_date"), F.col("election_type"), F.col("office")))


_LABEL_SQL = f"""{B.LINES_SQL}, r AS (SELECT contest_type, county, 'C' || (l_partkey % 40) AS code, 'L' || (l_partkey % 40 // 2) AS label, votes FROM b),
y AS (SELECT DISTINCT county, 'C' || (l_partkey % 40) AS code, 'L' || (l_partkey % 40 // 2) AS label FROM b WHERE l_partkey % 40 % 4 IN (0, 2, 3) AND l_partkey % 40 < 30),
o AS (SELECT county, label, min(code) AS c, count(DISTINCT code) AS n FROM y GROUP BY county, label),
m AS (SELECT r.contest_type, r.county, r.votes, coalesce(x.code, CASE WHEN o.n = 1 THEN o.c END) AS matched FROM r LEFT JOIN (SELECT DISTINCT county, code FROM y) x USING (county, code) LEFT JOIN o USING (county, label)),
q AS (SELECT contest_type, county, matched, sum(votes) AS votes FROM m GROUP BY ALL)"""


def _labelled(spark, sf_dir):
    lines = B.lines(spark, sf_dir)
    k = F.col("l_partkey") % 40
    rows = lines.select("contest_type", "county", F.concat(F.lit("C"), k.cast("string")).alias("code"), F.concat(F.lit("L"), F.floor(k / 2).cast("string")).alias("label"), "votes", k.alias("k"))
    # Added up by precinct before they meet the layer.
    sums = rows.groupBy("contest_type", "county", "code", "label", "k").agg(F.sum("votes").alias("votes"))
    layer = sums.where("k % 4 IN (0, 2, 3) AND k < 30").select("county", "code", "label").distinct()
    return resolve.by_label(sums.drop("k"), layer)


@query(f"WITH {_LABEL_SQL} SELECT * FROM q")
def label_fallback(spark, sf_dir):
    return _labelled(spark, sf_dir).groupBy("contest_type", "county", "matched").agg(F.sum("votes").alias("votes"))


@query(f"""WITH {_LABEL_SQL}, d AS (SELECT contest_type, county, sum(votes) AS rest FROM q WHERE matched IS NULL GROUP BY ALL)
SELECT q.contest_type, q.county, matched, round(votes + votes / sum(votes) OVER (PARTITION BY q.contest_type, q.county) * coalesce(rest, 0), 4) AS votes FROM q LEFT JOIN d USING (contest_type, county) WHERE matched IS NOT NULL""")
def redistribute_unmatched(spark, sf_dir):
    return rounded(resolve.redistributed(_labelled(spark, sf_dir), ["contest_type"]), 4, "votes")


_GROWTH_SQL = """g AS (SELECT n_name AS unit, round((sum(CASE WHEN year(o_orderdate) = 2000 THEN 1 ELSE 0 END) - sum(CASE WHEN year(o_orderdate) = 1996 THEN 1 ELSE 0 END)) / CAST(sum(CASE WHEN year(o_orderdate) = 1996 THEN 1 ELSE 0 END) AS DOUBLE) * 100, 2) AS growth FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey GROUP BY n_name)"""


def _growth(spark, sf_dir):
    rows = B.read(spark, sf_dir, "orders").join(B.read(spark, sf_dir, "customer"), F.col("o_custkey") == F.col("c_custkey")).join(B.read(spark, sf_dir, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
    wide = rows.groupBy(F.col("n_name").alias("normalized_name")).agg(*[F.sum((F.year("o_orderdate") == y).cast("bigint")).alias(n) for y, n in ((1996, "estimate_base_1996"), (1996, "estimate_1996"), (2000, "estimate_2000"))])
    return population.estimates(wide, "estimate_base_1996", "estimate_1996", "estimate_2000")


@query(f"""WITH {_GROWTH_SQL} SELECT * FROM (SELECT 'growth' AS kind, CAST(row_number() OVER (ORDER BY growth DESC, unit) AS INT) AS place, unit, growth AS value FROM g WHERE growth > 0) WHERE place <= 5
UNION ALL SELECT * FROM (SELECT 'decline', CAST(row_number() OVER (ORDER BY growth, unit) AS INT) AS place, unit, growth FROM g WHERE growth < 0) WHERE place <= 5""", exact=True)
def population_signals(spark, sf_dir):
    return trend.population_signals(_growth(spark, sf_dir), "pct_change_1996_to_2000")


@query(f"""WITH {_GROWTH_SQL}, {B.LINES_SQL}, t AS (SELECT county AS unit, (sum(CASE WHEN bucket = 'rep' THEN votes ELSE 0 END) - sum(CASE WHEN bucket = 'dem' THEN votes ELSE 0 END)) / CAST(sum(votes) AS DOUBLE) * 100.0 AS lean FROM b GROUP BY county)
SELECT unit, growth, lean, (CASE WHEN growth >= 5 THEN 'Growing' WHEN growth < 0 THEN 'Declining' ELSE 'Steady' END) || ' ' || (CASE WHEN lean > 0 THEN 'Republican' WHEN lean < 0 THEN 'Democratic' ELSE 'Even' END) AS insight FROM g JOIN t USING (unit)""", exact=True)
def census_insight(spark, sf_dir):
    t = contest.rated(contest.tally(B.ballots(spark, sf_dir), ["county"], cast="bigint")).withColumnRenamed("county", "unit")
    return population.census_insight(t, _growth(spark, sf_dir), "pct_change_1996_to_2000")


@query("""SELECT n_name AS normalized_name, CASE WHEN n_nationkey % 3 = 0 THEN 'county' ELSE 'other' END AS locality_type, CASE WHEN n_nationkey % 2 = 0 THEN lpad(CAST(n_nationkey AS VARCHAR), 3, '0') ELSE '' END AS countyfp, CASE WHEN n_nationkey % 2 = 0 THEN '51' || lpad(CAST(n_nationkey AS VARCHAR), 3, '0') ELSE '' END AS geoid FROM nation""")
def locality_attributes(spark, sf_dir):
    n = B.read(spark, sf_dir, "nation")
    rows = n.select(F.col("n_name").alias("normalized_name"), F.when(F.col("n_nationkey") % 3 == 0, "county").otherwise("other").alias("locality_type"))
    fp = F.lpad(F.col("n_nationkey").cast("string"), 3, "0")
    geo = n.where("n_nationkey % 2 = 0").select(F.col("n_name").alias("name"), fp.alias("countyfp"), F.concat(F.lit("51"), fp).alias("geoid"))
    return population.with_attributes(rows, geo)


@query(f"""WITH {B.APPORTION_SQL}, k AS (SELECT scope, contest_type, year, district, county, sum(votes) AS v FROM con GROUP BY ALL), u AS (SELECT scope, contest_type, year, county, sum(votes) AS z FROM unm GROUP BY ALL),
c AS (SELECT scope, contest_type, year, county, sum(CASE WHEN source = 'direct' THEN votes ELSE 0 END) AS x, sum(CASE WHEN source = 'allocated' THEN votes ELSE 0 END) AS y FROM con GROUP BY ALL)
SELECT k.scope, k.contest_type, k.year, k.district, k.county, round(v, 3) AS total_votes, round(coalesce(x, 0) + coalesce(z, 0), 2) AS county_scope_input_votes, round(coalesce(x, 0), 2) AS county_scope_direct_votes, round(coalesce(y, 0), 2) AS county_scope_allocated_votes
FROM k LEFT JOIN c USING (scope, contest_type, year, county) LEFT JOIN u USING (scope, contest_type, year, county)""")
def contributions_with_coverage(spark, sf_dir):
    from .catalogue import _allocated

    found = _allocated(spark, sf_dir)
    rows = diagnose.with_coverage(diagnose.county_contributions(found), diagnose.county_coverage(found))
    return rounded(rounded(rows.select("scope", "contest_type", "year", "district", "county", "total_votes", "county_scope_input_votes", "county_scope_direct_votes", "county_scope_allocated_votes"), 3, "total_votes"), 2, "county_scope_input_votes", "county_scope_direct_votes", "county_scope_allocated_votes")
