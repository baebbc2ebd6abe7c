"""Writers of reports, layers, populations and slices, and the refresh of published slices and their manifest.

Reports are folders of CSV parts in one global order: rows are dealt by ranges of the order, so no task sorts them all.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from apportion.functions import text as T
from apportion.functions import votes as V
from apportion.operators.calibrate import outliers

SLICE_KEY = ["scope", "contest_type", "year"]


def write_csv(df: DataFrame, path: str, *order: Column | tuple[Column, bool]) -> None:
    """df as CSV with a header; parts follow each other in this order; (column, True) is a descending one."""
    out = df
    if order:
        keys = [f"__order{i}" for i in range(len(order))]
        out = df.select("*", *[_value(c).alias(k) for c, k in zip(order, keys, strict=True)])
        out = out.orderBy(*[_directed(c, k) for c, k in zip(order, keys, strict=True)]).drop(*keys)
    out.write.mode("overwrite").option("header", True).csv(path)


def _value(c: Column | tuple[Column, bool]) -> Column:
    return c[0] if isinstance(c, tuple) else c


def _directed(c: Column | tuple[Column, bool], name: str) -> Column:
    return F.col(name).desc_nulls_last() if isinstance(c, tuple) and c[1] else F.col(name)


def write_summary(spark: SparkSession, path: str, **values) -> None:
    """One JSON object of a run's inputs, counts, metrics and elapsed seconds, its keys in order."""
    spark.range(1, numPartitions=1).select(F.lit(json.dumps(values, sort_keys=True)).alias("value")).write.mode("overwrite").text(path)


def margin_order() -> list:
    """Targets with results before others, the greatest error first."""
    return [F.when(F.col("status") == "ok", 0).otherwise(1), (F.coalesce("raw_abs_error_pct", F.lit(0.0)), True), V.place_in(F.col("scope"), V.SCOPES), F.col("contest_type"), F.col("year"), *V.district_order(F.col("district"))]


def write_margin_report(rows: DataFrame, folder: str) -> None:
    """The report of all targets, worst first, and that of the targets that need calibration."""
    order = margin_order()
    write_csv(rows, f"{folder}/district_margin_target_report", *order)
    write_csv(outliers(rows), f"{folder}/district_margin_target_outliers", *order)


def write_population(rows: DataFrame, folder: str) -> None:
    """Estimates by locality as CSV and as JSON lines, in order of name."""
    write_csv(rows, f"{folder}/csv", F.col("normalized_name"))
    rows.orderBy("normalized_name").write.mode("overwrite").json(f"{folder}/json")


def override_order() -> list[Column]:
    """Overrides by scope, contest, year and district; unknown scopes and missing years last."""
    return [V.place_in(F.lower("scope"), V.SCOPES), F.lower("contest_type"), F.coalesce(F.col("year").try_cast("int"), F.lit(9999)), *V.district_order(F.col("district"))]


def write_overrides(rows: DataFrame, path: str) -> None:
    write_csv(rows, path, *override_order())


def file_profile(rows: DataFrame, file: str = "file", position: str = "position") -> DataFrame:
    """(file, election_date, election_type, office, n_rows) of each converted file of long returns.

    The date is the file's first one that isn't empty, the type its last; the office is the only one that kept rows have,
    else multi_office. rows have ElectionDate, ElectionType, office, kept and a position within the file.
    """
    day, kind = T.clean_text(F.col("ElectionDate")), T.clean_text(F.col("ElectionType"))
    sums = rows.groupBy(file).agg(
        F.min_by(day, F.when(day != "", F.col(position))).alias("day"),
        F.max_by(kind, F.when(kind != "", F.col(position))).alias("kind"),
        F.min(F.when(F.col("kept"), F.col("office"))).alias("first"),
        F.max(F.when(F.col("kept"), F.col("office"))).alias("last"),
        F.sum(F.col("kept").cast("long")).alias("n_rows"),
    )
    date = F.coalesce("day", F.concat(F.substring(file, 1, 4), F.lit("-11-01")))
    office = F.when(F.col("first") == F.col("last"), T.slug(F.col("first"))).otherwise("multi_office")
    return sums.select(file, date.alias("election_date"), F.coalesce(T.slug(F.col("kind")), F.lit("general")).alias("election_type"), office.alias("office"), "n_rows")


def output_name(date: Column, election_type: Column, office: Column, source: Column | None = None) -> Column:
    """Path of a converted file below the root: its year, then date, state, type, grain, office and source."""
    parts = [F.replace(date, F.lit("-"), F.lit("")), F.lit("va"), election_type, F.lit("precinct"), office, *([] if source is None else [source])]
    return F.concat(F.substring(date, 1, 4), F.lit("/"), F.concat_ws("__", *parts), F.lit(".csv"))


def patched(rows: DataFrame, fixes: DataFrame) -> DataFrame:
    """District rows of published slices with the votes of `fixes` in place of their own, and what follows from votes
    made anew; candidates that a fix leaves empty stay."""
    from apportion.operators.contest import rated

    key = [*SLICE_KEY, "district"]
    new = fixes.select(*key, *[F.col(f"{b}_votes").alias(f"__{b}") for b in ("dem", "rep", "other")], *[F.nullif(F.trim(F.col(f"{b}_candidate")), F.lit("")).alias(f"__{b}_name") for b in ("dem", "rep")])
    both = rows.join(new, key, "left")
    votes = [F.coalesce(F.col(f"__{b}").cast("long"), F.col(f"{b}_votes")).alias(f"{b}_votes") for b in ("dem", "rep", "other")]
    names = [F.coalesce(f"__{b}_name", f"{b}_candidate").alias(f"{b}_candidate") for b in ("dem", "rep")]
    made = both.select(*key, *votes, *names).withColumn("total_votes", F.expr("dem_votes + rep_votes + other_votes"))
    return rated(made).select(*[c for c in rows.columns if c in (*key, "dem_votes", "rep_votes", "other_votes", "total_votes", "dem_candidate", "rep_candidate", "winner", "margin", "margin_pct", "color")])


def refreshed(entries: DataFrame, rows: DataFrame) -> DataFrame:
    """Manifest entries with totals and row counts of their slices' rows; entries without rows stay as they are.

    Where a slice has several entries, the first by file name is refreshed.
    """
    sums = rows.groupBy(*SLICE_KEY).agg(F.count("*").alias("__rows"), F.sum("dem_votes").alias("__dem"), F.sum("rep_votes").alias("__rep"))
    first = entries.groupBy(*SLICE_KEY).agg(F.min("file").alias("__first"))
    own = entries.join(first, SLICE_KEY, "left").join(sums, SLICE_KEY, "left")
    has = F.col("__rows").isNotNull() & (F.col("file") == F.col("__first"))
    new = {"rows": F.col("__rows"), "dem_total": F.col("__dem"), "rep_total": F.col("__rep"), "major_party_contested": (F.col("__dem") > 0) & (F.col("__rep") > 0)}
    return own.select(*[F.when(has, new[c]).otherwise(F.col(c)).alias(c) if c in new else F.col(c) for c in entries.columns])


def read_manifest(spark: SparkSession, path: str) -> DataFrame:
    """Entries of a manifest: what contests there are, without a look at their files."""
    schema = "files array<struct<scope: string, contest_type: string, year: int, file: string, rows: long, dem_total: long, rep_total: long, major_party_contested: boolean>>"
    return spark.read.schema(schema).option("multiLine", True).json(path).select(F.explode("files").alias("f")).select("f.*")


def require(spark: SparkSession, *paths: str) -> None:
    """FileNotFoundError for the first of the inputs that isn't there, before any work."""
    from pyspark.errors import AnalysisException

    for path in paths:
        try:
            spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
        except AnalysisException as e:
            raise FileNotFoundError(path) from e
