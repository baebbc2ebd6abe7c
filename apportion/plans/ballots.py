"""Adapter: the star-schema test tables as ballots, districts and crosswalk pieces.

Localities are the customers' nations, contests the order priorities, candidates the part brands, parties the return
flags, precinct labels are made from part keys, and districts from the suppliers' nations. Each frame has its SQL twin.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from apportion.functions import votes as V
from apportion.operators import dims

SCOPE_DISTRICTS = {"congressional": 5, "state_house": 7, "state_senate": 3}


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _label():
    number = F.lpad((F.col("l_partkey") % 200).cast("string"), 3, "0")
    return F.when(F.col("l_linenumber") == 1, F.concat(number, F.lit(" - Absentee"))).otherwise(F.concat(number, F.when(F.col("l_partkey") % 11 == 0, "a").otherwise(""), F.lit(" - Main Street")))


def _party():
    return F.when(F.col("l_returnflag") == "A", "Democratic").when(F.col("l_returnflag") == "R", "REPUBLICAN").otherwise("Libertarian")


def lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row for each line: locality, region, year, contest, party, candidate, precinct label, votes, supplier's nation."""
    t = {n: read(spark, sf_dir, n) for n in ("lineitem", "orders", "customer", "nation", "region", "part", "supplier")}
    nations = t["nation"].join(t["region"], F.col("n_regionkey") == F.col("r_regionkey")).select("n_nationkey", F.col("n_name").alias("county"), F.col("r_name").alias("region"))
    buyers = t["customer"].join(nations, F.col("c_nationkey") == F.col("n_nationkey")).select("c_custkey", "county", "region")
    # Lines, orders and customers grow together, so they are merged by key: files as small as the test tables' would make
    # the optimiser broadcast the lines themselves.
    orders = t["orders"].join(buyers.hint("merge"), F.col("o_custkey") == F.col("c_custkey")).select("o_orderkey", "county", "region", F.year("o_orderdate").alias("year"), F.col("o_orderpriority").alias("contest_type"))
    own = t["lineitem"].select("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_returnflag")
    joined = own.join(orders.hint("merge"), F.col("l_orderkey") == F.col("o_orderkey")).join(t["part"].select("p_partkey", "p_brand"), F.col("l_partkey") == F.col("p_partkey")).join(t["supplier"].select("s_suppkey", "s_nationkey"), F.col("l_suppkey") == F.col("s_suppkey"))
    return joined.select("county", "region", "year", "contest_type", _party().alias("party"), F.col("p_brand").alias("candidate"), _label().alias("precinct"), F.col("l_quantity").alias("votes"), "s_nationkey", "l_partkey", "l_linenumber")


def ballots(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ballots with bucket, precinct code and whether the label is no place."""
    labels = read(spark, sf_dir, "lineitem").select(_party().alias("party"), _label().alias("precinct"))
    return dims.coded(lines(spark, sf_dir), labels).select("county", "region", "year", "contest_type", "bucket", "candidate", "code", "non_geographic", "votes")


def pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Crosswalk pieces (scope, county, code, district, weight) of lines 2 to 4; parts of every 13th key have a B code."""
    own = lines(spark, sf_dir).where("l_linenumber BETWEEN 2 AND 4 AND l_partkey % 11 != 0")
    code = F.concat((F.col("l_partkey") % 200).cast("string"), F.when(F.col("l_partkey") % 13 == 0, "B").otherwise(""))
    sums = own.groupBy("county", code.alias("code"), "s_nationkey").agg(F.sum("votes").alias("weight"))
    scopes = F.explode(F.array(*[F.struct(F.lit(s).alias("scope"), (F.col("s_nationkey") % n + 1).cast("string").alias("district")) for s, n in SCOPE_DISTRICTS.items()]))
    return sums.select("county", "code", "weight", scopes.alias("x")).select("x.scope", "county", "code", "x.district", "weight")


LINES_SQL = """l AS (SELECT cn.n_name AS county, r.r_name AS region, CAST(year(o_orderdate) AS INT) AS year, o_orderpriority AS contest_type,
  CASE l_returnflag WHEN 'A' THEN 'dem' WHEN 'R' THEN 'rep' ELSE 'other' END AS bucket, p_brand AS candidate,
  CAST(l_partkey % 200 AS VARCHAR) || CASE WHEN l_linenumber > 1 AND l_partkey % 11 = 0 THEN 'A' ELSE '' END AS code0,
  l_linenumber = 1 AS non_geographic, l_quantity AS votes, s_nationkey, l_partkey, l_linenumber
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey JOIN nation cn ON c_nationkey = n_nationkey
  JOIN region r ON n_regionkey = r_regionkey JOIN part ON l_partkey = p_partkey JOIN supplier ON l_suppkey = s_suppkey),
b AS (SELECT county, region, year, contest_type, bucket, candidate, CASE WHEN regexp_matches(code0, '^[0-9]+A$') THEN lpad(rtrim(code0, 'A'), 3, '0') || 'A' ELSE code0 END AS code, non_geographic, votes, s_nationkey, l_partkey, l_linenumber FROM l)"""

TALLY_SQL = """t AS (SELECT {keys}, CAST(sum(CASE WHEN bucket = 'dem' THEN votes ELSE 0 END) AS BIGINT) AS dem_votes,
  CAST(sum(CASE WHEN bucket = 'rep' THEN votes ELSE 0 END) AS BIGINT) AS rep_votes,
  CAST(sum(CASE WHEN bucket = 'other' THEN votes ELSE 0 END) AS BIGINT) AS other_votes,
  CAST(sum(votes) AS BIGINT) AS total_votes FROM b WHERE votes > 0 GROUP BY {keys})"""


def rating_sql(margin: str, which: int) -> str:
    cases = " ".join(f"WHEN abs({margin}) >= {t[0]} THEN " + (f"'{t[1]}'" if which == 0 else f"CASE WHEN {margin} >= 0 THEN '{t[2]}' ELSE '{t[3]}' END") for t in V.TIERS)
    return f"CASE {cases} ELSE '{V.TOSSUP if which == 0 else V.TOSSUP_COLOUR}' END"


RATED_SQL = """CASE WHEN rep_votes > dem_votes THEN 'Republican' WHEN dem_votes > rep_votes THEN 'Democratic' ELSE 'Tie' END AS winner,
  abs(rep_votes - dem_votes) AS margin, CAST(rep_votes - dem_votes AS DOUBLE) / CAST(total_votes AS DOUBLE) * 100.0 AS margin_pct"""

_SCOPES_SQL = " UNION ALL ".join(f"SELECT '{s}' AS scope, {n} AS n" for s, n in SCOPE_DISTRICTS.items())


def _number(x: str) -> str:
    return f"(CASE WHEN regexp_matches(rtrim({x}, '-'), '^[0-9]+$') THEN CAST(CAST(rtrim({x}, '-') AS BIGINT) AS VARCHAR) ELSE '' END)"


def _digits(x: str) -> str:
    return f"regexp_extract({x}, '^([0-9]+)', 1)"


_SUFFIX = "'^[A-Z0-9]{1,2}$'"

CROSSWALK_SQL = f"""{LINES_SQL},
scopes AS ({_SCOPES_SQL}),
pieces AS (SELECT scope, county, CAST(l_partkey % 200 AS VARCHAR) || CASE WHEN l_partkey % 13 = 0 THEN 'B' ELSE '' END AS code, CAST(s_nationkey % n + 1 AS VARCHAR) AS district, sum(votes) AS weight
  FROM b CROSS JOIN scopes WHERE l_linenumber BETWEEN 2 AND 4 AND l_partkey % 11 <> 0 GROUP BY ALL),
sp AS (SELECT scope, county, code, district, weight / sum(weight) OVER (PARTITION BY scope, county, code) AS share FROM pieces),
cw AS (SELECT scope, county, district, w / sum(w) OVER (PARTITION BY scope, county) AS share FROM (SELECT scope, county, district, sum(weight) AS w FROM pieces GROUP BY ALL)),
wt AS (SELECT scope, county, code, sum(weight) AS weight FROM pieces GROUP BY ALL)"""

LADDER_SQL = f"""{CROSSWALK_SQL},
each AS (SELECT scope, contest_type, year, county, CASE WHEN non_geographic THEN '' ELSE code END AS code, bucket, candidate, sum(votes) AS votes FROM b CROSS JOIN scopes GROUP BY ALL),
want AS (SELECT DISTINCT scope, county, code FROM each WHERE code <> ''),
ex AS (SELECT w.scope, w.county, w.code, s.district, s.share, 1 AS stage FROM want w JOIN sp s USING (scope, county, code)),
codes AS (SELECT DISTINCT scope, county, code AS c FROM sp),
pr AS (SELECT w.scope, w.county, w.code, k.c, rtrim(w.code, '-') AS p FROM (SELECT * FROM want ANTI JOIN (SELECT DISTINCT scope, county, code FROM ex) USING (scope, county, code)) w JOIN codes k USING (scope, county)),
cand AS (SELECT scope, county, code, c, 2 AS stage FROM pr WHERE {_number('p')} <> '' AND {_number('p')} = {_number('c')}
  UNION SELECT scope, county, code, c, 3 FROM pr WHERE {_number('p')} <> '' AND {_number('c')} <> '' AND starts_with({_number('c')}, {_number('p')}) AND length({_number('c')}) = length({_number('p')}) + 1
  UNION SELECT scope, county, code, c, 4 FROM pr WHERE p <> '' AND ((starts_with(c, p) AND regexp_matches(substr(c, length(p) + 1), {_SUFFIX})) OR (starts_with(p, c) AND regexp_matches(substr(p, length(c) + 1), {_SUFFIX}))
    OR (length({_digits('p')}) >= 3 AND {_digits('p')} = {_digits('c')} AND (regexp_matches(substr(p, length({_digits('p')}) + 1), {_SUFFIX}) OR regexp_matches(substr(c, length({_digits('c')}) + 1), {_SUFFIX}))))),
g AS (SELECT *, count(*) OVER (PARTITION BY scope, county, code, stage) AS n FROM cand),
ok AS (SELECT g.scope, g.county, g.code, g.c, g.stage, coalesce(wt.weight, 1.0) AS w FROM g LEFT JOIN wt ON wt.scope = g.scope AND wt.county = g.county AND wt.code = g.c WHERE (stage = 2 OR (stage = 3 AND n <= 3) OR (stage = 4 AND n <= 4)) AND coalesce(wt.weight, 1.0) > 0),
best AS (SELECT * FROM (SELECT *, min(stage) OVER (PARTITION BY scope, county, code) AS f FROM ok) WHERE stage = f),
mg AS (SELECT best.scope, best.county, best.code, best.stage, sp.district, sum(sp.share * best.w) AS part FROM best JOIN sp ON sp.scope = best.scope AND sp.county = best.county AND sp.code = best.c GROUP BY ALL),
rs AS (SELECT scope, county, code, district, share, stage FROM ex UNION ALL SELECT scope, county, code, district, part / sum(part) OVER (PARTITION BY scope, county, code) AS share, stage FROM mg)"""

APPORTION_SQL = f"""{LADDER_SQL},
direct AS (SELECT scope, contest_type, year, county, district, bucket, candidate, 'direct' AS source, sum(votes * share) AS votes FROM each JOIN rs USING (scope, county, code) GROUP BY ALL),
unm AS (SELECT scope, contest_type, year, county, bucket, candidate, sum(votes) AS votes FROM each ANTI JOIN (SELECT DISTINCT scope, county, code FROM rs) r USING (scope, county, code) GROUP BY ALL),
m AS (SELECT scope, contest_type, year, county, district, bucket, sum(votes) AS votes FROM direct GROUP BY ALL),
tt AS (SELECT scope, contest_type, year, county, district, v / sum(v) OVER (PARTITION BY scope, contest_type, year, county) AS ts FROM (SELECT scope, contest_type, year, county, district, sum(votes) AS v FROM m GROUP BY ALL)),
pp AS (SELECT scope, contest_type, year, county, bucket, district, votes / sum(votes) OVER (PARTITION BY scope, contest_type, year, county, bucket) AS ps FROM m),
wb AS (SELECT scope, contest_type, year, county, bucket, district, x / sum(x) OVER (PARTITION BY scope, contest_type, year, county, bucket) AS share FROM (
  SELECT tt.scope, tt.contest_type, tt.year, tt.county, k.bucket, tt.district, (CASE WHEN tt.scope = 'congressional' THEN 0.65 ELSE 0.85 END) * ts + (CASE WHEN tt.scope = 'congressional' THEN 0.35 ELSE 0.15 END) * coalesce(ps, 0) AS x
  FROM tt JOIN (SELECT DISTINCT scope, contest_type, year, county, bucket FROM pp) k USING (scope, contest_type, year, county) LEFT JOIN pp USING (scope, contest_type, year, county, bucket, district)) WHERE x > 0),
al AS (SELECT u.scope, u.contest_type, u.year, u.county, w.district, u.bucket, u.candidate, 'allocated' AS source, u.votes * w.share AS votes FROM unm u JOIN wb w USING (scope, contest_type, year, county, bucket)
  UNION ALL SELECT u.scope, u.contest_type, u.year, u.county, w.district, u.bucket, u.candidate, 'allocated', u.votes * w.ts FROM (SELECT * FROM unm ANTI JOIN (SELECT DISTINCT scope, contest_type, year, county, bucket FROM wb) USING (scope, contest_type, year, county, bucket)) u JOIN tt w USING (scope, contest_type, year, county)
  UNION ALL SELECT u.scope, u.contest_type, u.year, u.county, w.district, u.bucket, u.candidate, 'allocated', u.votes * w.share FROM (SELECT * FROM unm ANTI JOIN (SELECT DISTINCT scope, contest_type, year, county FROM tt) USING (scope, contest_type, year, county)) u JOIN cw w USING (scope, county)),
con AS (SELECT scope, contest_type, year, county, district, bucket, candidate, source, votes FROM direct UNION ALL SELECT scope, contest_type, year, county, district, bucket, candidate, source, votes FROM al),
res AS (SELECT scope, contest_type, year, district, sum(CASE WHEN bucket = 'dem' THEN votes ELSE 0 END) AS dem_votes, sum(CASE WHEN bucket = 'rep' THEN votes ELSE 0 END) AS rep_votes, sum(CASE WHEN bucket = 'other' THEN votes ELSE 0 END) AS other_votes, sum(votes) AS total_votes FROM con GROUP BY ALL HAVING sum(votes) > 0)"""
