"""Column functions that normalise localities, precincts, offices and parties.

All take and return Columns and treat null as empty text, so no key is ever null. `\\s` covers all Unicode white space.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values.
PARTY_CODES = {"DEMOCRATIC": "DEM", "DEMOCRAT": "DEM", "REPUBLICAN": "REP", "LIBERTARIAN": "LIB", "GREEN": "GRN", "INDEPENDENT": "IND", "WRITE-IN": "WRI", "WRITE IN": "WRI", "NONPARTISAN": ""}
OFFICE_LABELS = {"president": "President", "u_s_senate": "U.S. Senate", "governor": "Governor", "lieutenant_governor": "Lieutenant Governor", "attorney_general": "Attorney General"}
STATEWIDE = {"PRESIDENT": "president", "US SENATE": "us_senate", "U S SENATE": "us_senate", "GOVERNOR": "governor", "LIEUTENANT GOVERNOR": "lieutenant_governor", "ATTORNEY GENERAL": "attorney_general"}
DISTRICT_OFFICES = {"state_house": "HOUSE OF DELEGATES", "state_senate": "SENATE OF VIRGINIA"}
DISTRICT_YEARS = (2023, 2025)
GENERAL_DATES = {2008: "2008-11-04", 2009: "2009-11-03", 2012: "2012-11-06", 2013: "2013-11-05", 2014: "2014-11-04", 2016: "2016-11-08", 2017: "2017-11-07", 2018: "2018-11-06", 2020: "2020-11-03", 2021: "2021-11-02", 2024: "2024-11-05", 2025: "2025-11-04"}
NON_GEOGRAPHIC = ("ABSENTEE", "PROVISIONAL", "EARLY", "MAIL", "CURBSIDE", "ONE STOP", "OS ", "OS-")
SUFFIXES = ("COUNTY", "CITY", "TOWN")
SPACE = "\t\n\v\f\r \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"


def _lookup(key: Column, table: dict, default: Column) -> Column:
    return reduce(lambda c, kv: c.when(key == F.lit(kv[0]), F.lit(kv[1])), table.items(), F.when(F.lit(False), F.lit(None))).otherwise(default)


def text(c: Column) -> Column:
    return F.coalesce(c.cast("string"), F.lit(""))


def strip(c: Column) -> Column:
    return F.btrim(text(c), F.lit(SPACE))


def clean_text(c: Column) -> Column:
    """Trimmed, each run of white space as one blank."""
    return F.regexp_replace(strip(c), r"(?U)\s+", " ")


def normal_key(c: Column) -> Column:
    return F.upper(clean_text(c))


def flat_key(c: Column) -> Column:
    """Upper case with tabs and line breaks as blanks, runs of blanks kept."""
    return F.upper(F.translate(strip(c), "\t\n\r", "   "))


def spelled_key(c: Column) -> Column:
    """Upper case with every ampersand spelled out between blanks, as population tables need it."""
    return F.upper(F.replace(clean_text(c), F.lit("&"), F.lit(" AND ")))


def locality_key(c: Column) -> Column:
    """normal_key with CITY OF X as X CITY."""
    return F.regexp_replace(normal_key(c), r"^CITY OF\s+(.+)$", "$1 CITY")


def locality_key_of_year(c: Column, year: Column) -> Column:
    """locality_key; in 2025 ampersands are spelled out first."""
    return locality_key(F.when(year == 2025, F.replace(text(c), F.lit("&"), F.lit(" AND "))).otherwise(text(c)))


def census_locality(name: Column, long_name: Column) -> Column:
    """Canonical locality: the long name if there is one, its base and suffix parted by one blank."""
    value = F.coalesce(F.nullif(normal_key(long_name), F.lit("")), normal_key(name))
    return F.regexp_replace(value, r"^(.+?)\s+(COUNTY|CITY|TOWN)$", "$1 $2")


def plain_locality(name: Column, long_name: Column) -> Column:
    """Canonical locality without a look at suffixes."""
    return F.coalesce(F.nullif(normal_key(long_name), F.lit("")), normal_key(name))


def locality_aliases(canonical: Column) -> Column:
    """Array of names for a canonical locality: itself, its base alone, base and suffix, and CITY OF base for cities."""
    key = normal_key(canonical)
    base, suffix = F.regexp_extract(key, r"^(.+?) (COUNTY|CITY|TOWN)$", 1), F.regexp_extract(key, r"^(.+?) (COUNTY|CITY|TOWN)$", 2)
    named = F.array(key, base, F.concat(base, F.lit(" "), suffix), F.when(suffix == "CITY", F.concat(F.lit("CITY OF "), base)).otherwise(F.lit("")))
    return F.filter(F.array_distinct(F.when(base == "", F.array(key)).otherwise(named)), lambda x: x != "")


def _without_zeros(c: Column) -> Column:
    return F.when(c.rlike(r"^[0-9]+$"), F.coalesce(F.nullif(F.ltrim(c, F.lit("0")), F.lit("")), F.lit("0"))).otherwise(c)


def precinct_code(c: Column) -> Column:
    return _without_zeros(F.regexp_replace(F.upper(text(c)), r"[^A-Z0-9.-]", ""))


def precinct_code_of_label(c: Column) -> Column:
    """Code at the head of a precinct's label: up to the first ` - `, else up to the first blank or underscore."""
    label = strip(c)
    head = F.when(F.contains(label, F.lit(" - ")), F.split_part(label, F.lit(" - "), F.lit(1))).otherwise(F.get(F.split(label, r"(?U)[_\s]+", 2), F.lit(0)))
    return precinct_code(strip(head))


def district_id(c: Column) -> Column:
    return _without_zeros(F.regexp_replace(F.upper(text(c)), r"[^A-Z0-9-]", ""))


def precinct_label(c: Column, code: Column) -> Column:
    """Label as `code - name`."""
    key = normal_key(c)
    return F.when(F.contains(key, F.lit(" - ")), key).otherwise(F.concat(text(code), F.lit(" - "), key))


def precinct_text(c: Column) -> Column:
    """Upper case without a parenthesis at the end."""
    return F.upper(clean_text(F.regexp_replace(clean_text(c), r"\s*\([^)]*\)\s*$", "")))


def party_code(party: Column, candidate: Column) -> Column:
    """Code of at most four letters; empty for parties that have none."""
    p, who = normal_key(party), normal_key(candidate)
    known = _lookup(p, PARTY_CODES, F.when(p == "OTHER", F.lit("OTH")).when(F.length(p) <= 4, p).otherwise(F.lit("")))
    return F.when((p == "") & (who == "ALL OTHERS"), F.lit("OTH")).otherwise(known)


def party_bucket(c: Column) -> Column:
    p = F.upper(strip(c))
    return F.when(p.startswith("DEM"), "dem").when(p.startswith("REP"), "rep").otherwise("other")


def office_text(c: Column) -> Column:
    return strip(F.regexp_replace(F.upper(text(c)), r"[^A-Z0-9 ]+", ""))


def statewide_contest(office: Column) -> Column:
    """Contest of a statewide office; null for any other."""
    return _lookup(office_text(office), STATEWIDE, F.lit(None).cast("string"))


def office_class(office: Column, year: Column) -> Column:
    """struct(kind, contest_type, district); all null if the office is none of those counted in that year."""
    own, raw = statewide_contest(office), F.upper(text(office))
    found = F.when(own.isNotNull(), F.struct(F.lit("statewide").alias("kind"), own.alias("contest_type"), F.lit(None).cast("string").alias("district")))
    for contest, name in DISTRICT_OFFICES.items():
        pattern = rf"MEMBER,\s*{name}\s*\((\d+)(?:ST|ND|RD|TH)\s+DISTRICT\)"
        number = F.regexp_replace(F.regexp_extract(raw, pattern, 1), r"^0+(?=\d)", "")
        found = found.when(raw.rlike(pattern) & year.isin(*DISTRICT_YEARS), F.struct(F.lit("district").alias("kind"), F.lit(contest).alias("contest_type"), number.alias("district")))
    return found.otherwise(F.lit(None))


def is_non_geographic(precinct: Column) -> Column:
    """Whether the label names a way of voting rather than a place; tokens match anywhere in it."""
    p = F.upper(text(precinct))
    return reduce(lambda a, b: a | b, [F.contains(p, F.lit(t)) for t in NON_GEOGRAPHIC])


def slug(c: Column) -> Column:
    s = F.regexp_replace(F.regexp_replace(F.lower(text(c)), "[^a-z0-9]+", "_"), "^_+|_+$", "")
    return F.when(s == "", F.lit("contest")).otherwise(s)


def office_label(slug_: Column) -> Column:
    return _lookup(slug_, OFFICE_LABELS, F.replace(slug_, F.lit("_"), F.lit(" ")))


def general_date(year: Column) -> Column:
    return _lookup(year, GENERAL_DATES, F.concat(year.cast("string"), F.lit("-11-01")))


def date_token(c: Column) -> Column:
    return F.replace(text(c), F.lit("-"), F.lit(""))


def district_of_row(name: Column, kind: Column) -> Column:
    """District name; empty if there is none or the district is the state."""
    n = clean_text(name)
    return F.when((n == "") | (F.lower(clean_text(kind)) == "state"), F.lit("")).otherwise(n)


def locality_type(c: Column) -> Column:
    k = F.lower(clean_text(c))
    return F.when(k.endswith(" county"), "county").when(k.endswith(" city"), "city").when(k.endswith(" town"), "town").otherwise("other")


def census_table_locality(c: Column) -> Column:
    """Key of a population table's row label: no dots before it, no state after it."""
    return spelled_key(F.regexp_replace(F.regexp_replace(strip(c), r"^\.+", ""), r"(?i),\s*VIRGINIA$", ""))


def precinct_key(county: Column, code: Column) -> Column:
    return F.concat_ws(" - ", county, code)


def display_name(code: Column, name: Column, fallback: str = "VTD") -> Column:
    """`code - NAME`, or `code - VTD raw` where there is no name."""
    n = normal_key(name)
    return F.concat(text(code), F.lit(" - "), F.when(n == "", F.concat(F.lit(f"{fallback} "), text(code))).otherwise(n))


def int_token(c: Column) -> Column:
    """A number's text without a fraction; any other text as it is."""
    t = strip(c)
    return F.coalesce(t.try_cast("double").try_cast("bigint").cast("string"), t)


def leading_digits(c: Column) -> Column:
    return F.regexp_extract(F.upper(strip(c)), r"^(\d+)", 1)


def legacy_code(code: Column, short_known: Column, long_known: Column) -> Column:
    """A code that begins with 5 and has three digits or more loses the 5 if only the short code is in the returns."""
    return F.when(code.rlike(r"^5\d{2,}$") & short_known & ~long_known, F.regexp_replace(F.substring(code, 2, 1000), r"^0+(?=\d)", "")).otherwise(code)
