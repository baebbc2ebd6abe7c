"""Population estimates by locality, with change and percentage change."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from apportion.functions.text import census_table_locality, locality_type
from apportion.functions.votes import parse_int, pct_change

YEARS = (2020, 2021, 2022, 2023, 2024, 2025)


def estimates(rows: DataFrame, base: str = "estimate_base_2020", first: str = "estimate_2020", last: str = "estimate_2025") -> DataFrame:
    """Adds change and percentage change of the last estimate over the base and over the first."""
    out = rows
    for start, name in ((base, base.removeprefix("estimate_")), (first, first.removeprefix("estimate_"))):
        to = last.removeprefix("estimate_")
        out = out.withColumn(f"change_{name}_to_{to}", F.col(last) - F.col(start)).withColumn(f"pct_change_{name}_to_{to}", pct_change(F.col(start), F.col(last)))
    return out


def from_matrix(cells: DataFrame) -> DataFrame:
    """Estimates from a table's cells (locality label and seven numbers as text, c0 to c7)."""
    named = cells.select(census_table_locality(F.col("c0")).alias("normalized_name"), F.regexp_replace(F.regexp_replace(F.trim("c0"), r"^\.+", ""), r"(?i),\s*Virginia$", "").alias("name"), *[parse_int(F.col(f"c{i + 1}")).alias(n) for i, n in enumerate(["estimate_base_2020", *(f"estimate_{y}" for y in YEARS)])])
    return estimates(named.withColumn("locality_type", locality_type(F.col("name"))))


def missing_localities(rows: DataFrame, localities: DataFrame, key: str = "normalized_name") -> DataFrame:
    """Localities of the boundary layer that the estimates lack."""
    return localities.join(rows.select(key), key, "left_anti")


def table_notes(cells: DataFrame, title: str = "Annual Estimates of the Resident Population", cell: str = "c0") -> tuple[str, str]:
    """Title and release date of a population table: the first cells that begin so; a missing title is the prefix itself."""
    own = F.trim(F.col(cell))
    found = cells.agg(F.first(F.when(own.startswith(title), own), ignorenulls=True), F.first(F.when(own.startswith("Release Date:"), own), ignorenulls=True)).first()
    return found[0] or title, (found[1] or "").partition(":")[2].strip()


def with_attributes(rows: DataFrame, localities: DataFrame, key: str = "normalized_name") -> DataFrame:
    """Estimates with the boundary layer's countyfp, geoid and locality type; empty, or by the name, where it lacks them."""
    geo = localities.select(F.col("name").alias(key), F.col("countyfp").alias("__fp"), F.col("geoid").alias("__geoid"), F.nullif(locality_type(F.col("name")), F.lit("other")).alias("__type"))
    joined = rows.drop("countyfp", "geoid").join(geo, key, "left")
    return joined.select(*rows.drop("countyfp", "geoid", "locality_type").columns, F.coalesce("__type", "locality_type").alias("locality_type"), F.coalesce("__fp", F.lit("")).alias("countyfp"), F.coalesce("__geoid", F.lit("")).alias("geoid"))


def check_complete(rows: DataFrame, localities: DataFrame, expected: int, statewide: str = "VIRGINIA", key: str = "normalized_name") -> DataFrame:
    """rows, after a look that every locality and the statewide row are there, and `expected` localities in all."""
    missing = [r[key] for r in missing_localities(rows, localities, key).orderBy(key).limit(5).collect()]
    counts = rows.agg(F.count("*").alias("n"), F.sum((F.col(key) == statewide).cast("long")).alias("state")).first()
    if missing or not counts["state"] or counts["n"] - counts["state"] != expected:
        raise ValueError(f"localities without estimates: {missing}; statewide rows: {counts['state']}; localities: {counts['n'] - (counts['state'] or 0)}, not {expected}")
    return rows


def census_insight(results: DataFrame, rows: DataFrame, growth: str = "pct_change_2020_to_2025", fast: float = 5.0, slow: float = 0.0, lean: float = 0.0) -> DataFrame:
    """(unit, growth, lean, insight): how a locality's growth goes with its lean. results (unit, margin_pct) has the
    republican lead in percent; growth of `fast` or more is Growing, below `slow` Declining, else Steady."""
    pace = F.when(F.col("growth") >= fast, "Growing").when(F.col("growth") < slow, "Declining").otherwise("Steady")
    side = F.when(F.col("lean") > lean, "Republican").when(F.col("lean") < -lean, "Democratic").otherwise("Even")
    both = results.select("unit", F.col("margin_pct").alias("lean")).join(rows.select(F.col("normalized_name").alias("unit"), F.col(growth).alias("growth")), "unit")
    return both.select("unit", "growth", "lean", F.concat_ws(" ", pace, side).alias("insight"))
