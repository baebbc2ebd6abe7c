"""Queries over the test tables, with equivalent SQL for an independent engine."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from apportion.functions import text as T
from apportion.functions import votes as V
from apportion.operators import allocate, calibrate, contest, crosswalk, diagnose, dims, population, resolve, trend, tune
from apportion.sources import order, tables

from . import ballots as B

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}
SCOPES = tuple(B.SCOPE_DISTRICTS)
SLICE = "contest_type, year, county"


# Sums of shares differ between engines in their last bits, and often end in an exact half of the last digit wanted. So
# both engines first cast to a decimal of six digits more, which drops those bits, and round that half up.


def _exact_rounds(sql: str) -> str:
    """SQL with each round(x, digits) made of a decimal."""
    out, at = "", 0
    while (i := sql.find("round(", at)) >= 0:
        depth, j, comma = 1, i + 6, 0
        while depth:
            depth += {"(": 1, ")": -1}.get(sql[j], 0)
            comma = j if sql[j] == "," and depth == 1 else comma
            j += 1
        digits = int(sql[comma + 1 : j - 1])
        out += f"{sql[at:i]}CAST(round(CAST({sql[i + 6 : comma]} AS DECIMAL(38, {digits + 6})), {digits}) AS DOUBLE)"
        at = j
    return out + sql[at:]


def query(sql: str | None = None, exact: bool = False):
    def add(f):
        QUERIES[f.__name__] = f
        if sql is not None:
            ORACLES[f.__name__] = sql if exact else _exact_rounds(sql)
        return f

    return add


def rounded(df: DataFrame, digits: int, *columns: str) -> DataFrame:
    return df.withColumns({c: F.round(F.col(c).cast(f"decimal(38, {digits + 6})"), digits).cast("double") for c in columns})


# Contest slices.


@query(f"""WITH {B.LINES_SQL}, {B.TALLY_SQL.format(keys=SLICE)}, c AS (SELECT {SLICE}, bucket, candidate, sum(votes) AS v FROM b WHERE bucket <> 'other' GROUP BY ALL),
k AS (SELECT {SLICE}, bucket, candidate FROM (SELECT *, row_number() OVER (PARTITION BY {SLICE}, bucket ORDER BY v DESC, candidate) AS n FROM c) WHERE n = 1)
SELECT t.*, coalesce(d.candidate, '') AS dem_candidate, coalesce(r.candidate, '') AS rep_candidate, {B.RATED_SQL}, {B.rating_sql('margin_pct', 0)} AS rating, {B.rating_sql('margin_pct', 1)} AS color
FROM t LEFT JOIN (SELECT * FROM k WHERE bucket = 'dem') d USING ({SLICE}) LEFT JOIN (SELECT * FROM k WHERE bucket = 'rep') r USING ({SLICE})""".replace("SELECT t.*, coalesce(d", "SELECT t.contest_type, t.year, t.county, dem_votes, rep_votes, other_votes, total_votes, coalesce(d"))
def county_slice(spark, sf_dir):
    return contest.county_slice(B.ballots(spark, sf_dir))


@query(f"""WITH {B.LINES_SQL}, {B.TALLY_SQL.format(keys=SLICE)}
SELECT contest_type, year, CAST(count(*) AS BIGINT) AS rows, CAST(sum(dem_votes) AS BIGINT) AS dem_total, CAST(sum(rep_votes) AS BIGINT) AS rep_total, CAST(sum(other_votes) AS BIGINT) AS other_total, CAST(sum(total_votes) AS BIGINT) AS total_votes,
  sum(dem_votes) > 0 AND sum(rep_votes) > 0 AS major_party_contested FROM t GROUP BY contest_type, year""")
def county_slice_meta(spark, sf_dir):
    rows = contest.tally(B.ballots(spark, sf_dir).withColumn("votes", F.col("votes").cast("bigint")), ["contest_type", "year", "county"], cast="bigint")
    return contest.slice_meta(rows)


@query(f"""WITH {B.LINES_SQL}, c AS (SELECT county, year, bucket, candidate, sum(votes) AS v FROM b WHERE bucket <> 'other' GROUP BY ALL)
SELECT county, year, max(CASE WHEN bucket = 'dem' AND n = 1 THEN candidate END) AS dem_candidate, max(CASE WHEN bucket = 'rep' AND n = 1 THEN candidate END) AS rep_candidate
FROM (SELECT *, row_number() OVER (PARTITION BY county, year, bucket ORDER BY v DESC, candidate) AS n FROM c) GROUP BY county, year""")
def top_candidate_by_bucket(spark, sf_dir):
    return contest.leading_candidates(B.ballots(spark, sf_dir), ["county", "year"])


@query("""SELECT p_brand, p_type FROM (SELECT p_brand, p_type, row_number() OVER (PARTITION BY p_brand ORDER BY count(*) DESC, p_type) AS n FROM part GROUP BY p_brand, p_type) WHERE n = 1""")
def label_mode(spark, sf_dir):
    return contest.label_mode(B.read(spark, sf_dir, "part"), ["p_brand"], "p_type")


@query(f"""WITH {B.LINES_SQL}, {B.TALLY_SQL.format(keys='county, year')}, m AS (SELECT county, year, {B.RATED_SQL} FROM t)
SELECT county, year, winner, {B.rating_sql('margin_pct', 0)} AS rating, {B.rating_sql('margin_pct', 1)} AS colour, CASE winner WHEN 'Republican' THEN '#cb181d' WHEN 'Democratic' THEN '#3182bd' ELSE '#f7f7f7' END AS winner_colour FROM m""")
def rating_tier(spark, sf_dir):
    rows = contest.rated(contest.tally(B.ballots(spark, sf_dir), ["county", "year"], cast="bigint"))
    return rows.select("county", "year", "winner", "rating", F.col("color").alias("colour"), V.winner_colour(F.col("winner")).alias("winner_colour"))


# Keys and labels.


@query("""SELECT s_suppkey, CASE WHEN s_suppkey % 3 = 0 THEN n_name || ' CITY' ELSE upper(n_name) END AS locality_key, CASE WHEN s_suppkey % 3 = 0 THEN 'city' WHEN s_suppkey % 3 = 1 THEN 'county' ELSE 'other' END AS locality_type
FROM supplier JOIN nation ON s_nationkey = n_nationkey""")
def locality_key(spark, sf_dir):
    rows = B.read(spark, sf_dir, "supplier").join(B.read(spark, sf_dir, "nation"), F.col("s_nationkey") == F.col("n_nationkey"))
    raw = F.when(F.col("s_suppkey") % 3 == 0, F.concat(F.lit(" City  of\t"), F.initcap("n_name"))).otherwise(F.concat(F.lit("  "), F.lower("n_name"), F.lit("\n")))
    named = F.when(F.col("s_suppkey") % 3 == 0, F.concat("n_name", F.lit(" City"))).when(F.col("s_suppkey") % 3 == 1, F.concat("n_name", F.lit(" county "))).otherwise(F.col("n_name"))
    return rows.select("s_suppkey", T.locality_key(raw).alias("locality_key"), T.locality_type(named).alias("locality_type"))


@query("""SELECT p_partkey, CASE WHEN p_partkey % 2 = 0 THEN CAST(p_partkey AS VARCHAR) ELSE lpad(CAST(p_partkey AS VARCHAR), 6, '0') || 'B' END AS code, CAST(p_partkey % 7 AS VARCHAR) AS district,
  CAST(p_partkey AS VARCHAR) AS leading, CASE WHEN p_partkey % 4 = 0 THEN CAST(p_partkey AS VARCHAR) ELSE 'x' || p_partkey END AS token, CASE WHEN p_partkey % 5 = 0 THEN 0 ELSE p_partkey * 1000 END AS parsed FROM part""")
def precinct_code_norm(spark, sf_dir):
    k = F.col("p_partkey").cast("string")
    code = F.when(F.col("p_partkey") % 2 == 0, F.concat(F.lit(" 000"), k)).otherwise(F.concat(F.lpad(k, 6, "0"), F.lit(" #b")))
    number = F.when(F.col("p_partkey") % 5 == 0, F.lit("--")).otherwise(F.concat(k, F.lit(",000")))
    return B.read(spark, sf_dir, "part").select(
        "p_partkey",
        T.precinct_code(code).alias("code"),
        T.district_id(F.concat(F.lit("0."), (F.col("p_partkey") % 7).cast("string"))).alias("district"),
        T.leading_digits(F.concat(F.lit(" "), k, F.lit("ab"))).alias("leading"),
        T.int_token(F.when(F.col("p_partkey") % 4 == 0, F.concat(k, F.lit(".0"))).otherwise(F.concat(F.lit("x"), k))).alias("token"),
        V.parse_int(number).alias("parsed"),
    )


@query("""SELECT p_partkey, CASE WHEN p_partkey % 2 = 0 THEN CAST(p_partkey AS VARCHAR) ELSE upper(split_part(p_name, ' ', 1)) END AS code, regexp_replace(trim(regexp_replace(upper(p_name), '\\s+', ' ', 'g')), 'x^', '') AS label FROM part""")
def precinct_code_extract(spark, sf_dir):
    k = F.col("p_partkey").cast("string")
    raw = F.when(F.col("p_partkey") % 2 == 0, F.concat(F.lit("00"), k, F.lit(" - "), F.col("p_name"))).otherwise(F.col("p_name"))
    return B.read(spark, sf_dir, "part").select("p_partkey", F.regexp_replace(T.precinct_code_of_label(raw), "^$", "").alias("code"), T.precinct_text(F.concat("p_name", F.lit(" (CD 2)"))).alias("label"))


@query("""SELECT l_orderkey, l_linenumber, CASE l_returnflag WHEN 'A' THEN 'dem' WHEN 'R' THEN 'rep' ELSE 'other' END AS bucket, CASE l_returnflag WHEN 'A' THEN 'DEM' WHEN 'R' THEN 'REP' ELSE 'LIB' END AS code FROM lineitem""")
def party_bucket(spark, sf_dir):
    party = F.when(F.col("l_returnflag") == "A", " Democratic").when(F.col("l_returnflag") == "R", "republican").otherwise("Libertarian ")
    return B.read(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", T.party_bucket(party).alias("bucket"), T.party_code(party, F.lit("x")).alias("code"))


@query("""SELECT s_suppkey, CASE WHEN s_suppkey % 3 = 0 THEN 'us_senate' ELSE 'state_house' END AS contest_type, CASE WHEN s_suppkey % 3 = 0 THEN 'statewide' ELSE 'district' END AS kind, CASE WHEN s_suppkey % 3 = 0 THEN NULL ELSE CAST(s_nationkey AS VARCHAR) END AS district
FROM supplier WHERE s_suppkey % 3 < 2""")
def office_classify(spark, sf_dir):
    office = F.when(F.col("s_suppkey") % 3 == 0, F.lit("U.S. Senate")).otherwise(F.concat(F.lit("Member, House of Delegates ("), F.lpad(F.col("s_nationkey").cast("string"), 3, "0"), F.lit("th District)")))
    year = F.when(F.col("s_suppkey") % 3 == 2, 2021).otherwise(2023)
    rows = B.read(spark, sf_dir, "supplier").withColumn("c", T.office_class(office, year))
    return rows.where("c IS NOT NULL").select("s_suppkey", "c.contest_type", "c.kind", "c.district")


@query("""SELECT p_partkey, CASE WHEN trim(regexp_replace(lower(p_name), '[^a-z0-9]+', '_', 'g'), '_') = '' THEN 'contest' ELSE trim(regexp_replace(lower(p_name), '[^a-z0-9]+', '_', 'g'), '_') END AS slug,
  replace(CASE WHEN trim(regexp_replace(lower(p_name), '[^a-z0-9]+', '_', 'g'), '_') = '' THEN 'contest' ELSE trim(regexp_replace(lower(p_name), '[^a-z0-9]+', '_', 'g'), '_') END, '_', ' ') AS label FROM part""")
def slugify(spark, sf_dir):
    return B.read(spark, sf_dir, "part").select("p_partkey", T.slug(F.concat(F.lit(" "), "p_name", F.lit("!"))).alias("slug"), T.office_label(T.slug(F.col("p_name"))).alias("label"))


@query("""SELECT event_type, CAST(count(*) AS BIGINT) AS n, CAST(sum(CASE WHEN contains(upper(event_type), 'MAIL') OR contains(upper(event_type), 'EARLY') OR contains(upper(event_type), 'ABSENTEE') OR contains(upper(event_type), 'PROVISIONAL') OR contains(upper(event_type), 'CURBSIDE') OR contains(upper(event_type), 'ONE STOP') OR contains(upper(event_type), 'OS ') OR contains(upper(event_type), 'OS-') THEN 1 ELSE 0 END) AS BIGINT) AS non_geographic FROM events GROUP BY event_type""")
def non_geo_filter(spark, sf_dir):
    return B.read(spark, sf_dir, "events").groupBy("event_type").agg(F.count("*").alias("n"), F.sum(T.is_non_geographic(F.col("event_type")).cast("bigint")).alias("non_geographic"))


@query("""WITH k AS (SELECT DISTINCT n_name AS county, CAST(l_partkey * 13 % 600 AS VARCHAR) AS code FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey)
SELECT county, code, CASE WHEN regexp_matches(code, '^5[0-9]{2,}$') AND EXISTS (SELECT 1 FROM k s WHERE s.county = k.county AND s.code = CAST(CAST(substr(k.code, 2) AS BIGINT) AS VARCHAR) AND s.code <> '') AND county = 'NATION_1' THEN CAST(CAST(substr(code, 2) AS BIGINT) AS VARCHAR) ELSE code END AS canonical FROM k WHERE regexp_matches(code, '^5[0-9]{2,}$')""")
def legacy_code_alias(spark, sf_dir):
    nations = B.read(spark, sf_dir, "supplier").join(B.read(spark, sf_dir, "nation"), F.col("s_nationkey") == F.col("n_nationkey"))
    codes = B.read(spark, sf_dir, "lineitem").join(nations, F.col("l_suppkey") == F.col("s_suppkey")).select(F.col("n_name").alias("county"), (F.col("l_partkey") * 13 % 600).cast("string").alias("code")).distinct()
    short = codes.where(F.col("code").rlike(r"^5\d{2,}$")).withColumn("short", F.regexp_replace(F.substring("code", 2, 9), r"^0+(?=\d)", ""))
    known = codes.select("county", F.col("code").alias("short"), F.lit(True).alias("known"))
    rows = short.join(known, ["county", "short"], "left")
    return rows.select("county", "code", T.legacy_code(F.col("code"), F.coalesce("known", F.lit(False)), F.col("county") != "NATION_1").alias("canonical"))


# Dimensions and lookups.

_NAMES_SQL = """names AS (SELECT upper(n_name) || ' COUNTY' AS canonical FROM nation UNION SELECT upper(n_name) || ' CITY' FROM nation WHERE n_nationkey % 4 = 0),
al AS (SELECT DISTINCT alias, canonical FROM (SELECT canonical AS alias, canonical FROM names UNION ALL SELECT regexp_replace(canonical, ' (COUNTY|CITY)$', ''), canonical FROM names UNION ALL SELECT 'CITY OF ' || regexp_replace(canonical, ' CITY$', ''), canonical FROM names WHERE canonical LIKE '% CITY'))"""


def _names(spark, sf_dir):
    n = B.read(spark, sf_dir, "nation")
    return n.select(F.concat("n_name", F.lit(" County")).alias("name")).union(n.where("n_nationkey % 4 = 0").select(F.concat(F.lit("City of "), "n_name")))


@query(f"WITH {_NAMES_SQL} SELECT alias, min(canonical) AS canonical FROM al GROUP BY alias HAVING count(DISTINCT canonical) = 1")
def alias_unambiguous(spark, sf_dir):
    return dims.alias_map(_names(spark, sf_dir))


@query(f"WITH {_NAMES_SQL} SELECT alias, string_agg(canonical, '|' ORDER BY canonical) AS candidates FROM al GROUP BY alias HAVING count(DISTINCT canonical) > 1")
def alias_ambiguous(spark, sf_dir):
    return dims.ambiguous_aliases(_names(spark, sf_dir))


@query(f"""WITH {_NAMES_SQL}, u AS (SELECT alias, min(canonical) AS canonical FROM al GROUP BY alias HAVING count(DISTINCT canonical) = 1)
SELECT coalesce(u.canonical, n_name) AS county, CAST(count(*) AS BIGINT) AS customers FROM customer JOIN nation ON c_nationkey = n_nationkey LEFT JOIN u ON u.alias = n_name GROUP BY 1""")
def locality_lookup_default(spark, sf_dir):
    rows = B.read(spark, sf_dir, "customer").join(B.read(spark, sf_dir, "nation"), F.col("c_nationkey") == F.col("n_nationkey")).select(T.locality_key(F.col("n_name")).alias("key"))
    # Customers are added up by key before the lookup.
    counts = rows.groupBy("key").agg(F.count("*").alias("n"))
    return dims.canonicalise(counts, dims.alias_map(_names(spark, sf_dir)), "key").groupBy("county").agg(F.sum("n").alias("customers"))


@query("SELECT CAST(o_custkey AS VARCHAR) AS alias FROM (SELECT DISTINCT o_custkey FROM orders) WHERE o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_acctbal > 0)")
def unmatched_localities(spark, sf_dir):
    names = B.read(spark, sf_dir, "customer").where("c_acctbal > 0").select(F.col("c_custkey").cast("string").alias("alias"))
    return dims.unmatched(B.read(spark, sf_dir, "orders").select(F.col("o_custkey").cast("string").alias("key")), names, "key")


@query("SELECT c_custkey FROM customer WHERE EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_totalprice > 200000)")
def exists_code(spark, sf_dir):
    big = B.read(spark, sf_dir, "orders").where("o_totalprice > 200000").select(F.col("o_custkey").alias("c_custkey"))
    return B.read(spark, sf_dir, "customer").select("c_custkey").join(big, "c_custkey", "left_semi")


# Reshaping.


@query("""SELECT l_orderkey, l_linenumber, 'quantity' AS candidate, l_quantity AS votes FROM lineitem WHERE l_quantity > 10 UNION ALL SELECT l_orderkey, l_linenumber, 'tax', l_tax * 1000 FROM lineitem WHERE l_tax * 1000 > 10""")
def wide_to_long(spark, sf_dir):
    wide = B.read(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", F.col("l_quantity").alias("quantity"), (F.col("l_tax") * 1000).alias("tax"))
    return wide.unpivot(["l_orderkey", "l_linenumber"], ["quantity", "tax"], "candidate", "votes").where("votes > 10")


@query(f"WITH {B.LINES_SQL}, {B.TALLY_SQL.format(keys='region, contest_type')} SELECT * FROM t")
def long_to_bucket_pivot(spark, sf_dir):
    return contest.tally(B.ballots(spark, sf_dir), ["region", "contest_type"], cast="bigint")


# Crosswalks.


def _crosswalk(spark, sf_dir):
    return crosswalk.from_areas(B.pieces(spark, sf_dir))


@query(f"WITH {B.CROSSWALK_SQL} SELECT scope, county, code, district, round(share, 8) AS share FROM sp")
def crosswalk_shares(spark, sf_dir):
    return rounded(_crosswalk(spark, sf_dir).splits, 8, "share")


@query(f"WITH {B.CROSSWALK_SQL} SELECT scope, county, district, round(share, 8) AS share FROM cw")
def county_weights(spark, sf_dir):
    return rounded(_crosswalk(spark, sf_dir).county_weights, 8, "share")


@query(f"WITH {B.CROSSWALK_SQL} SELECT scope, county, code, weight FROM wt")
def code_weights_max(spark, sf_dir):
    return _crosswalk(spark, sf_dir).code_weights


@query("""WITH x AS (SELECT n_name AS county, CAST(l_partkey % 200 AS VARCHAR) AS code, CAST(s_nationkey AS VARCHAR) AS district, CASE WHEN s_suppkey % 2 = 0 THEN 'state_house' ELSE 'state_senate' END AS scope, sum(l_quantity) AS v
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey JOIN supplier ON l_suppkey = s_suppkey GROUP BY ALL)
SELECT scope, county, code, district, round(v / sum(v) OVER (PARTITION BY scope, county, code), 8) AS share FROM x""")
def explicit_splits(spark, sf_dir):
    own = B.read(spark, sf_dir, "supplier").select("s_suppkey", F.concat(F.when(F.col("s_suppkey") % 2 == 0, "Member, House of Delegates (").otherwise("Member, Senate of Virginia ("), F.col("s_nationkey").cast("string"), F.lit("th District)")).alias("office"))
    buyers = B.read(spark, sf_dir, "customer").join(B.read(spark, sf_dir, "nation"), F.col("c_nationkey") == F.col("n_nationkey")).select("c_custkey", F.col("n_name").alias("county"))
    orders = B.read(spark, sf_dir, "orders").join(buyers, F.col("o_custkey") == F.col("c_custkey")).select("o_orderkey", "county")
    rows = B.read(spark, sf_dir, "lineitem").join(orders, F.col("l_orderkey") == F.col("o_orderkey")).join(own, F.col("l_suppkey") == F.col("s_suppkey"))
    rows = rows.select("county", F.concat((F.col("l_partkey") % 200).cast("string"), F.lit(" - X")).alias("precinct"), "office", F.lit(2023).alias("year"), F.col("l_quantity").alias("votes"))
    return rounded(crosswalk.from_contests(rows).splits, 8, "share")


@query("""WITH j AS (SELECT n_name AS county, CAST(l_partkey % 50 AS VARCHAR) AS code, CAST(s_nationkey AS VARCHAR) AS district, sum(coalesce(CASE WHEN p_size > 25 THEN p_size END, 1.0)) AS w
  FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN part ON l_partkey = p_partkey JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey GROUP BY ALL)
SELECT 'congressional' AS scope, county, code, district, round(w / sum(w) OVER (PARTITION BY county, code), 8) AS share FROM j""")
def block_crosswalk_left_fill(spark, sf_dir):
    line = B.read(spark, sf_dir, "lineitem").select(F.concat_ws("-", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice").alias("BLOCKID"), "l_orderkey", "l_partkey", "l_suppkey")
    orders = B.read(spark, sf_dir, "orders").join(B.read(spark, sf_dir, "customer"), F.col("o_custkey") == F.col("c_custkey")).select("o_orderkey", "c_nationkey")
    precincts = line.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).select("BLOCKID", F.col("c_nationkey").cast("string").alias("COUNTYFP"), (F.col("l_partkey") % 50).cast("string").alias("DISTRICT"))
    districts = line.join(B.read(spark, sf_dir, "supplier"), F.col("l_suppkey") == F.col("s_suppkey")).select("BLOCKID", F.col("s_nationkey").cast("string").alias("DISTRICT"))
    weights = line.join(B.read(spark, sf_dir, "part").where("p_size > 25"), F.col("l_partkey") == F.col("p_partkey")).select("BLOCKID", F.col("p_size").cast("double").alias("weight"))
    counties = B.read(spark, sf_dir, "nation").select(F.lpad(F.col("n_nationkey").cast("string"), 3, "0").alias("countyfp"), F.col("n_name").alias("county"))
    return rounded(crosswalk.from_blocks(precincts, districts, weights, counties, "congressional").splits, 8, "share")


@query(f"WITH {B.LADDER_SQL} SELECT scope, county, code, district, CAST(stage AS INT) AS stage, round(share, 7) AS share FROM rs")
def ladder_resolve(spark, sf_dir):
    codes = B.ballots(spark, sf_dir).where("NOT non_geographic").select("county", "code").distinct()
    wanted = codes.select(F.explode(F.array(*[F.lit(s) for s in SCOPES])).alias("scope"), "county", "code")
    return rounded(resolve.resolve(wanted, _crosswalk(spark, sf_dir)), 7, "share")


@query(f"""WITH {B.CROSSWALK_SQL}, v AS (SELECT county, CAST(s_nationkey % 5 + 1 AS VARCHAR) AS district, sum(votes) AS x FROM b WHERE year = 1996 GROUP BY ALL), p AS (SELECT county, district, x / sum(x) OVER (PARTITION BY county) AS p FROM v),
f AS (SELECT county, district, share AS f FROM cw WHERE scope = 'congressional'), k AS (SELECT coalesce(p.county, f.county) AS county, coalesce(p.district, f.district) AS district, coalesce(p, 0) AS p, coalesce(f, 0) AS f, max(p) OVER (PARTITION BY coalesce(p.county, f.county)) AS hp, max(f) OVER (PARTITION BY coalesce(p.county, f.county)) AS hf FROM p FULL JOIN f ON p.county = f.county AND p.district = f.district),
m AS (SELECT county, district, CASE WHEN hf IS NULL THEN p WHEN hp IS NULL THEN f ELSE 0.3 * p + 0.7 * f END AS x FROM k)
SELECT county, district, round(x / sum(x) OVER (PARTITION BY county), 8) AS share FROM m WHERE x > 0""")
def blend_weights(spark, sf_dir):
    rows = B.lines(spark, sf_dir).where("year = 1996").groupBy("county", (F.col("s_nationkey") % 5 + 1).cast("string").alias("district")).agg(F.sum("votes").alias("share"))
    area = _crosswalk(spark, sf_dir).county_weights.where("scope = 'congressional'").drop("scope")
    return rounded(crosswalk.blend(rows, area, 0.3, ["county"]), 8, "share")


@query(f"""WITH {B.CROSSWALK_SQL}, p AS (SELECT county, district, x / sum(x) OVER (PARTITION BY county) AS p FROM (SELECT county, CAST(s_nationkey % 5 + 1 AS VARCHAR) AS district, sum(votes) AS x FROM b WHERE year = 1996 GROUP BY ALL)),
f AS (SELECT county, district, share AS f FROM cw WHERE scope = 'congressional')
SELECT coalesce(p.county, f.county) AS county, round(sum(abs(coalesce(p, 0) - coalesce(f, 0))), 7) AS l1 FROM p FULL JOIN f ON p.county = f.county AND p.district = f.district GROUP BY 1""")
def weights_l1(spark, sf_dir):
    rows = B.lines(spark, sf_dir).where("year = 1996").groupBy("county", (F.col("s_nationkey") % 5 + 1).cast("string").alias("district")).agg(F.sum("votes").alias("share"))
    area = _crosswalk(spark, sf_dir).county_weights.where("scope = 'congressional'").drop("scope")
    return rounded(crosswalk.distance(rows, area, ["county"]), 7, "l1")


# Apportionment and allocation.


def _allocated(spark, sf_dir, candidates=False, direct_candidates=True):
    geometry = _crosswalk(spark, sf_dir)
    direct = allocate.apportion(B.ballots(spark, sf_dir), geometry, None, SCOPES, candidates, direct_candidates)
    return allocate.allocate(direct, geometry, allocate.blends(spark))


_VOTES = ("dem_votes", "rep_votes", "other_votes", "total_votes")
_VOTES_SQL = ", ".join(f"round({c}, 3) AS {c}" for c in _VOTES)


@query(f"WITH {B.APPORTION_SQL} SELECT scope, contest_type, year, county, district, bucket, round(sum(votes), 3) AS votes FROM direct GROUP BY ALL")
def apportion(spark, sf_dir):
    found = allocate.apportion(B.ballots(spark, sf_dir), _crosswalk(spark, sf_dir), None, SCOPES, candidates=False).contributions
    return rounded(found.groupBy("scope", "contest_type", "year", "county", "district", "bucket").agg(F.sum("votes").alias("votes")), 3, "votes")


@query(f"WITH {B.APPORTION_SQL} SELECT scope, contest_type, year, district, {_VOTES_SQL} FROM res")
def allocate_unmatched(spark, sf_dir):
    return rounded(allocate.district_results(_allocated(spark, sf_dir).contributions), 3, *_VOTES)


@query(f"WITH {B.APPORTION_SQL} SELECT scope, contest_type, year, district, bucket, candidate, round(sum(votes), 3) AS votes FROM al GROUP BY ALL")
def allocated_candidates(spark, sf_dir):
    found = _allocated(spark, sf_dir, candidates=True, direct_candidates=False).contributions.where("source = 'allocated'")
    return rounded(found.groupBy("scope", "contest_type", "year", "district", "bucket", "candidate").agg(F.sum("votes").alias("votes")), 3, "votes")


@query(f"""WITH {B.APPORTION_SQL}, d AS (SELECT scope, contest_type, year, sum(CASE WHEN source = 'direct' THEN votes ELSE 0 END) AS x, sum(CASE WHEN source = 'allocated' THEN votes ELSE 0 END) AS y FROM con GROUP BY ALL), u AS (SELECT scope, contest_type, year, sum(votes) AS z FROM unm GROUP BY ALL)
SELECT scope, contest_type, year, round(x + z, 2) AS input_votes, round(x + y, 2) AS matched_votes, round(x, 2) AS direct_matched_votes, round(y, 2) AS allocated_votes, round((x + y) / (x + z) * 100, 5) AS match_coverage_pct, round(x / (x + z) * 100, 5) AS direct_match_coverage_pct FROM d JOIN u USING (scope, contest_type, year)""")
def coverage_stats(spark, sf_dir):
    rows = rounded(allocate.coverage(_allocated(spark, sf_dir)), 2, "input_votes", "matched_votes", "direct_matched_votes", "allocated_votes")
    return rounded(rows, 5, "match_coverage_pct", "direct_match_coverage_pct")


@query(f"WITH {B.LINES_SQL} SELECT 'state_house' AS scope, 'state_house' AS contest_type, year, CAST(s_nationkey AS VARCHAR) AS district, sum(CASE WHEN bucket = 'dem' THEN votes ELSE 0 END) AS dem_votes, sum(CASE WHEN bucket = 'rep' THEN votes ELSE 0 END) AS rep_votes, sum(CASE WHEN bucket = 'other' THEN votes ELSE 0 END) AS other_votes, sum(votes) AS total_votes FROM b GROUP BY ALL")
def direct_district(spark, sf_dir):
    rows = B.lines(spark, sf_dir).select(F.lit("state_house").alias("scope"), "year", "county", F.col("s_nationkey").cast("string").alias("district"), T.party_bucket(F.col("party")).alias("bucket"), "candidate", "votes")
    return allocate.district_results(allocate.direct_contests(rows))


# Calibration.

_TARGET_SQL = "CAST(CAST(district AS INT) * 4 - 12 AS DOUBLE)"
_CALIBRATED_SQL = f"""cal AS (SELECT *, (rep_votes - dem_votes) / total_votes * 100 AS raw, CASE WHEN total_votes - other_votes > 0 THEN 0.5 * ((total_votes - other_votes) + greatest(least({_TARGET_SQL} / 100.0 * total_votes, total_votes - other_votes), -(total_votes - other_votes))) ELSE rep_votes END AS rep2 FROM res)"""


def _targets(results):
    return results.select("scope", "contest_type", "year", "district", (F.col("district").cast("int") * 4 - 12).cast("double").alias("target_margin_pct"))


@query(f"WITH {B.APPORTION_SQL}, {_CALIBRATED_SQL} SELECT scope, contest_type, year, district, round(CASE WHEN total_votes - other_votes > 0 THEN total_votes - other_votes - rep2 ELSE dem_votes END, 3) AS dem_votes, round(rep2, 3) AS rep_votes, round(other_votes, 3) AS other_votes, round(total_votes, 3) AS total_votes, round(raw, 5) AS raw_margin_pct FROM cal")
def calibrate_margin(spark, sf_dir):
    results = allocate.district_results(_allocated(spark, sf_dir).contributions)
    return rounded(rounded(calibrate.calibrate(results, _targets(results)), 3, *_VOTES), 5, "raw_margin_pct")


@query(f"""WITH {B.APPORTION_SQL} SELECT scope, contest_type, year, district, CASE WHEN district = '2' THEN 100.0 ELSE round(dem_votes, 3) END AS dem_votes, CASE WHEN district = '2' THEN CAST(year AS DOUBLE) ELSE round(rep_votes, 3) END AS rep_votes,
CASE WHEN district = '2' THEN 0.0 ELSE round(other_votes, 3) END AS other_votes, CASE WHEN district = '2' THEN 100.0 + year ELSE round(total_votes, 3) END AS total_votes FROM res""")
def apply_overrides(spark, sf_dir):
    results = allocate.district_results(_allocated(spark, sf_dir).contributions)
    exact = results.where("district = '2'").select("scope", "contest_type", "year", "district", F.lit(100.0).alias("dem_votes"), F.col("year").cast("double").alias("rep_votes"), F.lit(0.0).alias("other_votes"))
    return rounded(calibrate.override(results, exact), 3, *_VOTES)


@query(f"""WITH {B.APPORTION_SQL}, {_CALIBRATED_SQL} SELECT scope, contest_type, year, district, {_TARGET_SQL} AS target_margin_pct, round(raw, 3) AS raw_margin_pct, round(raw - {_TARGET_SQL}, 3) AS raw_error_pct, round(abs(raw - {_TARGET_SQL}), 3) AS raw_abs_error_pct,
CASE WHEN abs(raw - {_TARGET_SQL}) >= 1.0 OR raw = {_TARGET_SQL} THEN 'yes' ELSE 'no' END AS needs_calibration, 'ok' AS status FROM cal""", exact=True)
def calibration_report(spark, sf_dir):
    results = allocate.district_results(_allocated(spark, sf_dir).contributions)
    rows = calibrate.report(calibrate.calibrate(results, _targets(results)), _targets(results))
    return rows.select("scope", "contest_type", "year", "district", "target_margin_pct", "raw_margin_pct", "raw_error_pct", "raw_abs_error_pct", "needs_calibration", "status")


@query("""WITH k AS (SELECT 'congressional' AS scope, o_orderpriority AS contest_type, CAST(year(o_orderdate) AS INT) AS year, CAST(o_custkey % 20 AS VARCHAR) AS district, CAST(round(sum(CAST(o_totalprice AS DECIMAL(18, 2)))) AS BIGINT) AS votes FROM orders WHERE o_custkey % 20 < 12 GROUP BY ALL)
SELECT scope, contest_type, year, district, CASE WHEN CAST(district AS INT) >= 6 THEN CAST(1 AS BIGINT) ELSE votes END AS votes FROM k UNION ALL SELECT DISTINCT 'congressional', o_orderpriority, CAST(year(o_orderdate) AS INT), CAST(o_custkey % 20 AS VARCHAR), CAST(1 AS BIGINT) FROM orders WHERE o_custkey % 20 BETWEEN 12 AND 15""", exact=True)
def upsert_overrides(spark, sf_dir):
    o = B.read(spark, sf_dir, "orders").select(F.lit("congressional").alias("scope"), F.col("o_orderpriority").alias("contest_type"), F.year("o_orderdate").alias("year"), (F.col("o_custkey") % 20).cast("string").alias("district"), F.col("o_totalprice").cast("decimal(18, 2)").alias("price"))
    key = ["scope", "contest_type", "year", "district"]
    current = o.where("CAST(district AS INT) < 12").groupBy(*key).agg(F.round(F.sum("price")).cast("bigint").alias("votes"))
    new = o.where("CAST(district AS INT) BETWEEN 6 AND 15").select(*key).distinct().withColumn("votes", F.lit(1).cast("bigint"))
    return calibrate.upsert(current, new)


# Diagnosis and tuning.


@query(f"""WITH {B.APPORTION_SQL}, k AS (SELECT scope, contest_type, year, district, county, sum(CASE WHEN source = 'direct' THEN votes ELSE 0 END) AS x, sum(CASE WHEN source = 'allocated' THEN votes ELSE 0 END) AS y FROM con GROUP BY ALL)
SELECT scope, contest_type, year, district, county, round(x, 3) AS direct_votes, round(y, 3) AS allocated_votes, round(y / (x + y), 5) AS allocated_share, round((x + y) / sum(x + y) OVER (PARTITION BY scope, contest_type, year, district), 5) AS district_share_of_total FROM k""")
def diag_contributions(spark, sf_dir):
    rows = diagnose.county_contributions(_allocated(spark, sf_dir)).select("scope", "contest_type", "year", "district", "county", "direct_votes", "allocated_votes", "allocated_share", "district_share_of_total")
    return rounded(rounded(rows, 3, "direct_votes", "allocated_votes"), 5, "allocated_share", "district_share_of_total")


@query(f"""WITH {B.APPORTION_SQL}, c AS (SELECT scope, contest_type, year, county, sum(CASE WHEN source = 'direct' THEN votes ELSE 0 END) AS x, sum(CASE WHEN source = 'allocated' THEN votes ELSE 0 END) AS y FROM con GROUP BY ALL), u AS (SELECT scope, contest_type, year, county, sum(votes) AS z FROM unm GROUP BY ALL)
SELECT scope, contest_type, year, county, round(coalesce(x, 0) + coalesce(z, 0), 2) AS input_votes, round(coalesce(x, 0), 2) AS direct_votes, round(coalesce(y, 0), 2) AS allocated_votes FROM c FULL JOIN u USING (scope, contest_type, year, county)""")
def diag_coverage(spark, sf_dir):
    rows = diagnose.county_coverage(_allocated(spark, sf_dir)).drop("unallocated_votes")
    return rounded(rows, 2, "input_votes", "direct_votes", "allocated_votes")


@query(f"""WITH {B.APPORTION_SQL}, k AS (SELECT scope, contest_type, year, district, county, sum(CASE WHEN source = 'allocated' THEN votes ELSE 0 END) AS y, sum(votes) AS v FROM con GROUP BY ALL),
r AS (SELECT *, v / sum(v) OVER (PARTITION BY scope, contest_type, year, district) AS part, row_number() OVER (PARTITION BY scope, contest_type, year, district ORDER BY round(v, 6) DESC, county) AS n FROM k)
SELECT scope, contest_type, year, district, string_agg(county || ':' || CAST(round(part * 100, 1) AS VARCHAR) || '% (alloc ' || CAST(round(y / v * 100, 1) AS VARCHAR) || '%)', ' | ' ORDER BY n) AS top_counties FROM r WHERE n <= 6 GROUP BY ALL""")
def diag_topn_text(spark, sf_dir):
    return diagnose.top_counties(diagnose.county_contributions(_allocated(spark, sf_dir)))


def _statistics(spark, sf_dir):
    geometry = _crosswalk(spark, sf_dir)
    direct = allocate.apportion(B.ballots(spark, sf_dir), geometry, None, SCOPES, candidates=False)
    results = allocate.district_results(allocate.allocate(direct, geometry, allocate.blends(spark)).contributions)
    return tune.statistics(direct, geometry, _targets(results))


@query(f"""WITH {B.APPORTION_SQL}, e AS (SELECT abs((rep_votes - dem_votes) / total_votes * 100 - {_TARGET_SQL}) AS e FROM res)
SELECT CAST(count(*) AS BIGINT) AS target_count, CAST(0 AS BIGINT) AS missing_count, CAST(sum(CASE WHEN e >= 1.0 THEN 1 ELSE 0 END) AS BIGINT) AS over_threshold_count, round(avg(e), 5) AS mae, round(sqrt(avg(e * e)), 5) AS rmse, round(max(e), 5) AS max_abs_error FROM e""")
def eval_metrics(spark, sf_dir):
    stats = _statistics(spark, sf_dir)
    config = {(s, None): v for s, v in allocate.DEFAULT_BLEND.items()}
    rows = tune.metrics(tune.evaluate(stats, tune.config_frame(spark, [("default", config)]))).drop("config_id")
    return rounded(rows, 5, "mae", "rmse", "max_abs_error")


GRID = "0,0.15,0.3,0.5,0.7,0.85,1.0"


def _metrics_sql(blend: float) -> str:
    # A blend of 0 means the bucket's own districts alone.
    total, party = (1 - blend, blend) if blend else (0.0, 1.0)
    own = B.APPORTION_SQL.replace("(CASE WHEN tt.scope = 'congressional' THEN 0.65 ELSE 0.85 END)", str(total)).replace("(CASE WHEN tt.scope = 'congressional' THEN 0.35 ELSE 0.15 END)", str(party))
    return f"""(WITH {own}, e AS (SELECT abs((rep_votes - dem_votes) / total_votes * 100 - {_TARGET_SQL}) AS e FROM res)
SELECT '{blend:.2f}' AS config_id, CAST(count(*) AS BIGINT) AS target_count, CAST(0 AS BIGINT) AS missing_count, CAST(sum(CASE WHEN e >= 1.0 THEN 1 ELSE 0 END) AS BIGINT) AS over_threshold_count, round(avg(e), 5) AS mae, round(sqrt(avg(e * e)), 5) AS rmse, round(max(e), 5) AS max_abs_error FROM e)"""


@query(" UNION ALL ".join(_metrics_sql(v) for v in tune.parse_grid(GRID)))
def grid_eval(spark, sf_dir):
    configs = [(f"{v:.2f}", {(s, None): v for s in SCOPES}) for v in tune.parse_grid(GRID)]
    return rounded(tune.metrics(tune.evaluate(_statistics(spark, sf_dir), tune.config_frame(spark, configs))), 5, "mae", "rmse", "max_abs_error")


# Population.

_POP_SQL = """p AS (SELECT n_name AS name, CAST(sum(CASE WHEN year(o_orderdate) = 1995 THEN 1 ELSE 0 END) AS BIGINT) AS a, CAST(sum(CASE WHEN year(o_orderdate) = 1996 THEN 1 ELSE 0 END) AS BIGINT) AS b, CAST(sum(CASE WHEN year(o_orderdate) = 2000 THEN 1 ELSE 0 END) AS BIGINT) AS c FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey GROUP BY n_name)"""


@query(f"""WITH {_POP_SQL} SELECT name, a AS estimate_base_1995, b AS estimate_1996, c AS estimate_2000, c - a AS change_base_1995_to_2000, CASE WHEN a <> 0 THEN round((c - a) / CAST(a AS DOUBLE) * 100, 2) END AS pct_change_base_1995_to_2000, c - b AS change_1996_to_2000, CASE WHEN b <> 0 THEN round((c - b) / CAST(b AS DOUBLE) * 100, 2) END AS pct_change_1996_to_2000 FROM p""", exact=True)
def population_change(spark, sf_dir):
    rows = B.read(spark, sf_dir, "orders").join(B.read(spark, sf_dir, "customer"), F.col("o_custkey") == F.col("c_custkey")).join(B.read(spark, sf_dir, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
    wide = rows.groupBy(F.col("n_name").alias("name")).agg(*[F.sum((F.year("o_orderdate") == y).cast("bigint")).alias(n) for y, n in ((1995, "estimate_base_1995"), (1996, "estimate_1996"), (2000, "estimate_2000"))])
    return population.estimates(wide, "estimate_base_1995", "estimate_1996", "estimate_2000")


# Order, sets, ids.


@query("SELECT p_brand, p_partkey, CAST(row_number() OVER (ORDER BY p_brand, p_partkey) AS INT) AS id FROM part")
def row_ids(spark, sf_dir):
    return order.row_numbers(B.read(spark, sf_dir, "part").select("p_brand", "p_partkey"), "p_brand", "p_partkey")


@query("SELECT o_orderkey, o_orderpriority, o_totalprice FROM orders ORDER BY o_orderpriority, o_totalprice DESC, o_orderkey LIMIT 100")
def canonical_sort_topk(spark, sf_dir):
    return B.read(spark, sf_dir, "orders").select("o_orderkey", "o_orderpriority", "o_totalprice").orderBy("o_orderpriority", F.col("o_totalprice").desc(), "o_orderkey").limit(100)


@query("""SELECT district, CAST(row_number() OVER (ORDER BY CASE WHEN regexp_matches(district, '^[0-9]+$') THEN 0 ELSE 1 END, district) AS INT) AS place FROM (SELECT DISTINCT CASE WHEN n_nationkey % 6 = 0 THEN 'Z' || n_nationkey ELSE CAST(n_nationkey AS VARCHAR) END AS district FROM nation)""")
def district_sort_key(spark, sf_dir):
    d = B.read(spark, sf_dir, "nation").select(F.when(F.col("n_nationkey") % 6 == 0, F.concat(F.lit("Z"), F.col("n_nationkey").cast("string"))).otherwise(F.col("n_nationkey").cast("string")).alias("district")).distinct()
    keyed = d.select("district", *[c.alias(f"__k{i}") for i, c in enumerate(V.district_order(F.col("district")))])
    return order.row_numbers(keyed, *[c for c in keyed.columns if c != "district"]).select("district", F.col("id").alias("place"))


@query("SELECT DISTINCT o_custkey % 500 AS k FROM orders UNION SELECT c_custkey % 700 FROM customer")
def set_union(spark, sf_dir):
    return B.read(spark, sf_dir, "orders").select((F.col("o_custkey") % 500).alias("k")).union(B.read(spark, sf_dir, "customer").select(F.col("c_custkey") % 700)).distinct()


@query("SELECT c_custkey FROM customer EXCEPT SELECT o_custkey FROM orders WHERE o_totalprice > 350000")
def set_except(spark, sf_dir):
    return B.read(spark, sf_dir, "customer").select("c_custkey").subtract(B.read(spark, sf_dir, "orders").where("o_totalprice > 350000").select("o_custkey"))


@query("SELECT DISTINCT o_orderpriority, CAST(year(o_orderdate) AS INT) AS year FROM orders")
def distinct_groups(spark, sf_dir):
    return B.read(spark, sf_dir, "orders").select("o_orderpriority", F.year("o_orderdate").alias("year")).distinct()


# Trends.

_TREND_SQL = f"""{B.LINES_SQL}, {B.TALLY_SQL.format(keys='contest_type, county, year')}, e AS (SELECT contest_type AS contest, county AS unit, year, dem_votes AS dem, rep_votes AS rep, other_votes AS oth, total_votes AS total, CAST(rep_votes - dem_votes AS DOUBLE) / CAST(total_votes AS DOUBLE) * 100.0 AS margin_pct,
CASE WHEN rep_votes > dem_votes THEN 'Republican' WHEN dem_votes > rep_votes THEN 'Democratic' ELSE 'Tie' END AS winner FROM t)"""


def _elections(spark, sf_dir):
    rows = contest.rated(contest.tally(B.ballots(spark, sf_dir), ["contest_type", "county", "year"], cast="bigint"))
    return rows.select(F.col("contest_type").alias("contest"), F.col("county").alias("unit"), "year", F.col("dem_votes").alias("dem"), F.col("rep_votes").alias("rep"), F.col("other_votes").alias("oth"), F.col("total_votes").alias("total"), "margin_pct", "winner")


@query(f"""WITH {_TREND_SQL} SELECT contest, unit, year, lag(year) OVER w AS prior_year, round(margin_pct - lag(margin_pct) OVER w, 6) AS shift, CASE WHEN lag(winner) OVER w = 'Democratic' AND winner = 'Republican' THEN 'D→R' WHEN lag(winner) OVER w = 'Republican' AND winner = 'Democratic' THEN 'R→D' END AS flip,
dem - lag(dem) OVER w AS dem_delta, rep - lag(rep) OVER w AS rep_delta, total - lag(total) OVER w AS total_delta FROM e WINDOW w AS (PARTITION BY contest, unit ORDER BY year)""")
def shift_and_flip(spark, sf_dir):
    return rounded(trend.with_prior(_elections(spark, sf_dir)).select("contest", "unit", "year", "prior_year", "shift", "flip", "dem_delta", "rep_delta", "total_delta"), 6, "shift")


@query(f"""WITH {_TREND_SQL}, r AS (SELECT *, sum(CASE WHEN winner = pw THEN 0 ELSE 1 END) OVER (PARTITION BY contest, unit ORDER BY year) AS run FROM (SELECT *, lag(winner) OVER (PARTITION BY contest, unit ORDER BY year) AS pw FROM e))
SELECT contest, unit, max(year) AS latest_year, max_by(winner, year) AS latest_winner, CAST(min_by(year, abs(margin_pct) * 1000000 + year) AS INT) AS closest_year, round(min(abs(margin_pct)), 6) AS closest_margin, CAST(min(CASE WHEN run = mr THEN year END) AS INT) AS since_year
FROM (SELECT *, max(run) OVER (PARTITION BY contest, unit) AS mr FROM r) GROUP BY contest, unit""")
def closest_latest_since(spark, sf_dir):
    return rounded(trend.extremes(_elections(spark, sf_dir)), 6, "closest_margin")


@query(f"""WITH {_TREND_SQL} SELECT contest, unit, year, round((sum(rep) OVER s - sum(dem) OVER s) / CAST(sum(total) OVER s AS DOUBLE) * 100, 6) AS state_margin_pct, round(margin_pct - (sum(rep) OVER s - sum(dem) OVER s) / CAST(sum(total) OVER s AS DOUBLE) * 100, 6) AS vs_state FROM e WINDOW s AS (PARTITION BY contest, year)""")
def vs_statewide(spark, sf_dir):
    return rounded(trend.against_state(_elections(spark, sf_dir)).select("contest", "unit", "year", "state_margin_pct", "vs_state"), 6, "state_margin_pct", "vs_state")


@query(f"""WITH {_TREND_SQL}, f AS (SELECT contest, unit, CAST(count(*) AS BIGINT) AS elections, arg_min(margin_pct, year) AS a, arg_max(margin_pct, year) AS z, arg_min(winner, year) AS wa, arg_max(winner, year) AS wz FROM e GROUP BY contest, unit)
SELECT contest, unit, elections, round(z - a, 6) AS moved, CASE WHEN z - a > 2 THEN '→' WHEN z - a < -2 THEN '←' ELSE '↔' END AS arrow, CASE WHEN wa <> wz THEN 'Realigning' WHEN abs(z) < 5.5 THEN 'Competitive' WHEN abs(z - a) < 2 THEN 'Stable' WHEN abs(z) > abs(a) THEN 'Reinforcing' ELSE 'Softening' END AS category FROM f""")
def trajectory(spark, sf_dir):
    return rounded(trend.trajectories(_elections(spark, sf_dir)), 6, "moved")


@query(f"""WITH {_TREND_SQL}, s AS (SELECT *, margin_pct - lag(margin_pct) OVER (PARTITION BY contest, unit ORDER BY year) AS shift FROM e),
u AS ((SELECT 'closest' AS kind, contest, unit, year, abs(margin_pct) AS value FROM s ORDER BY value, contest, unit, year LIMIT 5) UNION ALL (SELECT 'shift', contest, unit, year, abs(shift) AS value FROM s WHERE shift IS NOT NULL ORDER BY value DESC, contest, unit, year LIMIT 5))
SELECT kind, contest, unit, year, round(value, 6) AS value, CAST(row_number() OVER (PARTITION BY kind ORDER BY CASE WHEN kind = 'closest' THEN value ELSE -value END, contest, unit, year) AS INT) AS place FROM u""")
def smart_insights(spark, sf_dir):
    return rounded(trend.insights(_elections(spark, sf_dir)), 6, "value")


@query()
def district_payloads(spark, sf_dir):
    found = allocate.over_counties(_allocated(spark, sf_dir, candidates=True))
    keys = ("scope", "contest_type", "year")
    rows = contest.district_rows(allocate.district_results(found.contributions), contest.leading_candidates(found.contributions, [*allocate.CONTEST, "district"]))
    return contest.slice_payloads(rows, allocate.coverage(found), keys)


@query(f"""WITH {B.APPORTION_SQL}, c AS (SELECT scope, contest_type, year, sum(CASE WHEN source = 'direct' THEN votes ELSE 0 END) AS x FROM con GROUP BY ALL), u AS (SELECT scope, contest_type, year, sum(votes) AS z FROM unm GROUP BY ALL)
SELECT scope, contest_type, year, district, round(x / (x + z) * 100, 5) AS direct_match_coverage_pct, CASE WHEN rep_votes > dem_votes THEN 'Republican' WHEN dem_votes > rep_votes THEN 'Democratic' ELSE 'Tie' END AS winner, round((rep_votes - dem_votes) / total_votes * 100, 5) AS margin_pct
FROM res JOIN c USING (scope, contest_type, year) JOIN u USING (scope, contest_type, year)""")
def payload_rows(spark, sf_dir):
    """What the slices' payloads hold, read back from their text."""
    schema = "meta struct<direct_match_coverage_pct: double>, general struct<results: map<string, struct<winner: string, margin_pct: double>>>"
    back = district_payloads(spark, sf_dir).withColumn("p", F.from_json("payload", schema)).select("scope", "contest_type", "year", F.col("p.meta.direct_match_coverage_pct").alias("direct_match_coverage_pct"), F.explode("p.general.results").alias("district", "r"))
    return rounded(back.select("scope", "contest_type", "year", "district", "direct_match_coverage_pct", "r.*"), 5, "direct_match_coverage_pct", "margin_pct")
