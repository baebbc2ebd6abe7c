"""Readers and writers for returns, targets, overrides, population tables and boundary attributes.

Readers give frames of text columns, as files have them; normalisation is the operators' work. Validation collects only
a count of bad rows and one example.
"""

from __future__ import annotations

import json
import re
from functools import reduce

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from apportion.functions import text as T
from apportion.functions import votes as V

from . import archives, geojson, versions
from .order import fields
from .order import lines as rows_of_files

CANONICAL = ("county", "precinct", "office", "district", "party", "candidate", "votes")
WIDE_FILE = r"(?i)^Virginia_Elections_Database__(\d{4})_(.+?)_General_Election_including_precincts\.csv$"
LONG_FILE = r"(?i)^Election Results_(.+)\.csv$"
TOTALS = ("TOTAL VOTES CAST", "TOTAL")


def _strings(*names: str) -> str:
    return ", ".join(f"{n} string" for n in names)


def canonical(spark: SparkSession, root: str) -> DataFrame:
    """All canonical files below a folder, with the year of each file's name."""
    rows = spark.read.schema(_strings(*CANONICAL)).option("header", True).option("recursiveFileLookup", True).option("pathGlobFilter", "*.csv").csv(root)
    return rows.select("*", V.year_of_file(F.col("_metadata.file_name")).alias("year"))


def source_kind(file_name) -> F.Column:
    """wide, long or null, by the file's name."""
    return F.when(file_name.rlike(WIDE_FILE), "wide").when(file_name.rlike(LONG_FILE), "long")


def heads(lines: DataFrame) -> DataFrame:
    """(path, second, titles, columns) of each pivoted file: where its second line is, the cells of its first, and its candidates'
    columns (at, candidate, party); totals and columns without a name are none."""
    begin = lines.groupBy("path").agg(F.min("at").alias("first"))
    own = lines.join(begin, "path").groupBy("path").agg(F.min_by("value", "at").alias("one"), F.min_by("value", F.when(F.col("at") > F.col("first"), F.col("at"))).alias("two"), F.min(F.when(F.col("at") > F.col("first"), F.col("at"))).alias("second"))

    def named(line):
        return F.transform(fields(F.coalesce(line, F.lit(""))), lambda c: T.strip(F.replace(c, F.lit("\ufeff"), F.lit(""))))

    both = F.zip_with(named(F.col("one")), named(F.col("two")), lambda a, b: F.struct(F.coalesce(a, F.lit("")).alias("candidate"), F.coalesce(b, F.lit("")).alias("party")))
    columns = F.transform(both, lambda x, i: F.struct((i + 1).alias("at"), x["candidate"].alias("candidate"), x["party"].alias("party")))
    wanted = F.filter(columns, lambda c: (c["at"] > 3) & (c["candidate"] != "") & ~F.upper(c["candidate"]).isin(*TOTALS))
    return own.select("path", "second", named(F.col("one")).alias("titles"), wanted.alias("columns"))


def wide(spark: SparkSession, path: str | list[str], office: str | None = None) -> DataFrame:
    """Canonical rows of pivoted files, and the `file` of each: candidates in a file's first line, parties in its second, then
    one line a precinct. The office is that of the file's name if none is given.

    All files are read in one scan, by their lines: heads are a table of one row a file, which the lines meet by path, so plans
    are as long for a thousand files as for one, and a large file is the work of several tasks. Cells hold no line breaks.
    """
    lines = rows_of_files(spark, path)
    met = lines.join(heads(lines), "path").where(F.col("at") > F.col("second")).withColumn("cell", fields(F.col("value")))
    county, precinct = F.get("cell", F.lit(0)), F.coalesce(F.get("cell", F.lit(2)), F.lit(""))
    places = met.where((F.coalesce(T.strip(county), F.lit("")) != "") & (T.strip(precinct) != "") & ~T.normal_key(precinct).isin(*TOTALS))
    # Some files repeat their first line.
    places = places.where((county != F.coalesce(F.get("titles", F.lit(0)), F.lit(""))) | (precinct != F.coalesce(F.get("titles", F.lit(2)), F.lit(""))))
    rows = places.select("file", T.normal_key(county).alias("county"), T.precinct_text(precinct).alias("precinct"), F.explode(F.transform("columns", lambda c: F.struct(c["candidate"].alias("candidate"), c["party"].alias("party"), F.get("cell", c["at"] - 1).alias("votes")))).alias("x"))
    named = F.trim(F.regexp_replace(F.lower(F.regexp_extract("file", WIDE_FILE, 2)), "[^a-z0-9]+", " "))
    slug = F.lit(office) if office is not None else F.when(named == "", "contest").otherwise(F.replace(named, F.lit(" "), F.lit("_")))
    out = rows.select("county", "precinct", T.office_label(slug).alias("office"), F.lit("").alias("district"), T.party_code(F.col("x.party"), F.col("x.candidate")).alias("party"), T.clean_text(F.col("x.candidate")).alias("candidate"), V.parse_int(F.col("x.votes")).alias("votes"), "file")
    return out.where("votes > 0")


def long(spark: SparkSession, path: str | list[str], line_breaks: bool = False) -> DataFrame:
    """Canonical rows of files with one line for each candidate and precinct, and the name of each row's `file`. With
    `line_breaks` cells may hold them, and a file is one task."""
    rows = spark.read.option("header", True).option("multiLine", line_breaks).csv(path)
    out = rows.select(
        T.normal_key(F.col("LocalityName")).alias("county"),
        T.precinct_text(F.col("PrecinctName")).alias("precinct"),
        T.clean_text(F.col("OfficeTitle")).alias("office"),
        T.district_of_row(F.col("DistrictName"), F.col("DistrictType")).alias("district"),
        T.party_code(F.col("Party"), F.col("CandidateName")).alias("party"),
        T.clean_text(F.col("CandidateName")).alias("candidate"),
        V.parse_int(F.col("TOTAL_VOTES")).alias("votes"),
        F.url_decode(F.col("_metadata.file_name")).alias("file"),
    )
    return out.where("votes > 0 AND county != '' AND precinct != '' AND office != '' AND candidate != ''")


def converted(spark: SparkSession, *paths: str) -> DataFrame:
    """Canonical rows of all files whose names tell their kind, with `file`; other files are ignored. Each kind is one scan."""
    named = {p: p.rstrip("/").rsplit("/", 1)[-1] for p in paths}
    kinds = [(read, [p for p, name in named.items() if re.match(pattern, name)]) for read, pattern in ((wide, WIDE_FILE), (long, LONG_FILE))]
    frames = [read(spark, own) for read, own in kinds if own]
    if not frames:
        raise FileNotFoundError("no file of a known kind")
    return frames[0] if len(frames) == 1 else frames[0].unionByName(frames[1])


def census_matrix(spark: SparkSession, path: str, header: str = "Geographic Area", footnotes: tuple[str, ...] = ("Note:", "Suggested Citation", "Source:", "Release Date")) -> DataFrame:
    """Cells c0 to c7 of a population table: rows after the header's two lines, up to the first footnote."""
    lines = rows_of_files(spark, path)
    cell = F.transform(fields(F.col("value")), lambda c: F.nullif(c, F.lit("")))
    rows = lines.select("at", *[F.get(cell, F.lit(i)).alias(f"c{i}") for i in range(8)])
    note = reduce(lambda x, y: x | y, [F.ltrim("c0").startswith(f) for f in footnotes])
    marks = rows.agg(F.min(F.when(F.trim("c0") == header, F.col("at"))).alias("head"), F.min(F.when(note, F.col("at"))).alias("note")).first()
    if marks["head"] is None:
        raise ValueError(f"no row begins with {header!r}")

    def literal(at):
        return F.struct(F.lit(at["start"]).cast("long").alias("start"), F.lit(at["place"]).cast("long").alias("place"))

    after = rows.where(F.col("at") > literal(marks["head"]))
    second = after.agg(F.min("at").alias("at")).first()["at"]
    kept = after.where(F.col("c7").isNotNull() & (F.lit(True) if second is None else F.col("at") > literal(second)))
    return (kept if marks["note"] is None else kept.where(F.col("at") < literal(marks["note"]))).drop("at")


def localities(spark: SparkSession, path: str) -> DataFrame:
    """(name, countyfp, geoid) of a boundary file's localities."""
    p = F.col("properties")
    return geojson.read(spark, path).select(T.census_locality(p["NAME20"], p["NAMELSAD20"]).alias("name"), F.lpad(T.text(p["COUNTYFP20"]), 3, "0").alias("countyfp"), T.text(p["GEOID20"]).alias("geoid"))


def zipped_text(spark: SparkSession, path: str, suffix: str, required: tuple[str, ...], sep: str = "|", split_bytes: int = archives.SPLIT_BYTES) -> DataFrame:
    """Rows of the first member with this suffix of each archive, as text columns; a member is read by a task for each
    `split_bytes` of it. A missing file, member or column is an error."""
    spark.dataSource.register(archives.ZippedText)
    return spark.read.format("zipped_text").schema(_strings(*required)).option("suffix", suffix).option("sep", sep).option("splitBytes", split_bytes).load(path)


def _checked(df: DataFrame, bad: F.Column, what: str) -> DataFrame:
    n = df.where(bad).limit(1).collect()
    if n:
        raise ValueError(f"bad row in {what}: {n[0].asDict()}")
    return df


def _keyed(spark: SparkSession, path: str, values: tuple[str, ...], texts: tuple[str, ...] = ()) -> DataFrame:
    names = ("scope", "contest_type", "year", "district", *values, *texts)
    raw = spark.read.option("header", True).csv(path)
    if missing := {"scope", "contest_type", "year", "district", *values} - set(raw.columns):
        raise ValueError(f"columns are missing: {sorted(missing)}")
    own = raw.select(*[T.strip(F.col(c)).alias(c) if c in raw.columns else F.lit("").alias(c) for c in names], F.struct(F.col("_metadata.file_block_start").alias("start"), F.monotonically_increasing_id().alias("place")).alias("position")).where(F.concat(*[F.col(c) for c in names]) != "")
    typed = own.select(F.lower("scope").alias("scope"), F.lower("contest_type").alias("contest_type"), F.col("year").try_cast("int").alias("year"), T.district_id(F.col("district")).alias("district"), *[F.col(v).try_cast("double").alias(v) for v in values], *texts, "position")
    known = (*V.CONTESTS, "state_house", "state_senate")
    bad = ~F.col("scope").isin(*V.SCOPES) | ~F.col("contest_type").isin(*known) | F.col("year").isNull() | (F.col("district") == "")
    for v in values:
        bad = bad | F.col(v).isNull()
    return _checked(typed, bad, path)


def margin_targets(spark: SparkSession, path: str) -> DataFrame:
    """Targets (scope, contest_type, year, district, target_margin_pct, position); ValueError if any row is bad."""
    return _keyed(spark, path, ("target_margin_pct",))


def result_overrides(spark: SparkSession, path: str) -> DataFrame:
    """Overrides with votes by bucket and candidates; ValueError if any row is bad or has negative votes."""
    own = _keyed(spark, path, ("dem_votes", "rep_votes", "other_votes"), ("dem_candidate", "rep_candidate"))
    return _checked(own, F.least("dem_votes", "rep_votes", "other_votes") < 0, path)


def repaired_lines(spark: SparkSession, path: str, joins: dict[str, str]) -> DataFrame:
    """Lines of a file after literal replacements that put lost line breaks back; blank lines go, and so do lines of
    separators alone. The file, which people keep by hand, is one row of one task until its lines are split."""
    whole = F.col("value")
    for bad, good in joins.items():
        whole = F.replace(whole, F.lit(bad), F.lit(good))
    return spark.read.option("wholetext", True).text(path).select(F.explode(F.split(whole, "\n")).alias("line")).where(F.translate("line", " ,\r\t", "") != "")


def write_canonical(rows: DataFrame, path: str) -> int:
    """Canonical rows as CSV, a folder for each year, in the order of the six keys within it; returns how many there were.

    Rows are dealt by ranges of the whole order, so a large year has many tasks and files, which follow each other.
    """
    seen = Observation("canonical")
    # Counted above the sort, which reads its input twice to find its ranges.
    ordered = rows.orderBy("year", *CANONICAL[:6]).observe(seen, F.count("*").alias("n"))
    ordered.write.mode("overwrite").partitionBy("year").option("header", True).csv(path)
    return seen.get["n"]


def write_slices(payloads: DataFrame, path: str, *keys: str, meta: DataFrame | None = None) -> int:
    """One JSON text for each slice, in folders by key, as a new version of `path` that takes the place of the one before at
    once; slices that are no longer made go. Returns the version's number. With `meta`, one row for each slice, their
    manifest is part of the version. payloads may come from the slices that they replace."""
    return versions.publish(payloads.select(*keys, "payload"), path, "text", *keys, note=None if meta is None else manifest(meta, *keys))


def read_slices(spark: SparkSession, path: str) -> DataFrame:
    """(payload, keys) of the slices of `path` as last written."""
    return versions.current(spark, path).withColumnRenamed("value", "payload")


def manifest(meta: DataFrame, *keys: str) -> str:
    """JSON list of slices; meta has one row for each."""
    return json.dumps({"files": [r.asDict() for r in meta.orderBy(*keys).collect()]}, sort_keys=True)
