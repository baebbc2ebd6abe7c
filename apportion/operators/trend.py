"""Elections over time: shifts, flips, vote changes, trajectories, extremes, and comparison with the whole state.

Results are rows (contest, unit, year, dem, rep, oth, total, margin_pct, winner). A prior election is the nearest
earlier one of the same contest and unit. Thresholds of arrows and categories are parameters.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

UNIT = ["contest", "unit"]


def _by_year():
    return Window.partitionBy(*UNIT).orderBy("year")


def with_prior(results: DataFrame) -> DataFrame:
    """Adds each election's shift, flip and vote changes from the prior one; null where there is none."""
    w = _by_year()
    before = F.lag("winner").over(w)
    flip = F.when((before == "Democratic") & (F.col("winner") == "Republican"), "D→R").when((before == "Republican") & (F.col("winner") == "Democratic"), "R→D")
    deltas = [(F.col(c) - F.lag(c).over(w)).alias(f"{c}_delta") for c in ("dem", "rep", "total")]
    return results.select("*", F.lag("year").over(w).alias("prior_year"), (F.col("margin_pct") - F.lag("margin_pct").over(w)).alias("shift"), flip.alias("flip"), *deltas)


def arrow(shift: Column, epsilon: float = 1.0) -> Column:
    return F.when(shift > epsilon, "→").when(shift < -epsilon, "←").when(shift.isNotNull(), "↔")


def trajectories(results: DataFrame, close: float = 5.5, still: float = 2.0) -> DataFrame:
    """Category of each unit from its first and last election.

    Realigning if the winner changed, Competitive if the last margin is below `close`, Stable if it moved less than
    `still`, else Reinforcing or Softening as the winner's margin grew or shrank.
    """
    ends = results.groupBy(*UNIT).agg(*[f(F.struct("margin_pct", "winner"), "year").alias(n) for f, n in ((F.min_by, "first"), (F.max_by, "last"))], F.count("*").alias("elections"))
    a, b = F.col("first.margin_pct"), F.col("last.margin_pct")
    category = F.when(F.col("first.winner") != F.col("last.winner"), "Realigning").when(F.abs(b) < close, "Competitive").when(F.abs(b - a) < still, "Stable").when(F.abs(b) > F.abs(a), "Reinforcing").otherwise("Softening")
    return ends.select(*UNIT, "elections", (b - a).alias("moved"), arrow(b - a, still).alias("arrow"), category.alias("category"))


def extremes(results: DataFrame) -> DataFrame:
    """Latest and closest election of each unit, and since when its latest winner has won."""
    w = _by_year()
    runs = results.withColumn("__new", F.when(F.col("winner") == F.lag("winner").over(w), 0).otherwise(1)).withColumn("__run", F.sum("__new").over(w))
    latest = F.max_by(F.struct("year", "winner", "__run"), "year")
    own = runs.groupBy(*UNIT).agg(latest.alias("latest"), F.min(F.struct(F.abs("margin_pct").alias("m"), "year")).alias("closest"), F.collect_list(F.struct("__run", "year")).alias("runs"))
    since = F.array_min(F.transform(F.filter("runs", lambda r: r["__run"] == F.col("latest.__run")), lambda r: r["year"]))
    return own.select(*UNIT, F.col("latest.year").alias("latest_year"), F.col("latest.winner").alias("latest_winner"), F.col("closest.year").alias("closest_year"), F.col("closest.m").alias("closest_margin"), since.alias("since_year"))


def against_state(results: DataFrame) -> DataFrame:
    """Adds the whole contest's margin in that year, and the unit's lead over it."""
    w = Window.partitionBy("contest", "year")
    state = (F.sum("rep").over(w) - F.sum("dem").over(w)).cast("double") / F.sum("total").over(w).cast("double") * 100.0
    return results.withColumn("state_margin_pct", state).withColumn("vs_state", F.col("margin_pct") - F.col("state_margin_pct"))


def insights(results: DataFrame, n: int = 5) -> DataFrame:
    """The n closest margins and the n greatest shifts, as (kind, place, contest, unit, year, value)."""
    shifted = with_prior(results)
    order = [F.col("contest"), F.col("unit"), F.col("year")]
    top = [
        shifted.select(F.lit("closest").alias("kind"), *UNIT, "year", F.abs("margin_pct").alias("value")).orderBy("value", *order).limit(n),
        shifted.where("shift IS NOT NULL").select(F.lit("shift").alias("kind"), *UNIT, "year", F.abs("shift").alias("value")).orderBy(F.col("value").desc(), *order).limit(n),
    ]
    place = F.row_number().over(Window.partitionBy("kind").orderBy(F.when(F.col("kind") == "closest", F.col("value")).otherwise(-F.col("value")), *order))
    return top[0].unionByName(top[1]).withColumn("place", place)


def population_signals(rows: DataFrame, growth: str = "pct_change_2020_to_2025", n: int = 5) -> DataFrame:
    """The n localities that grow most and the n that shrink most, as (kind, place, unit, value)."""
    own = rows.where(F.col(growth).isNotNull()).select(F.col("normalized_name").alias("unit"), F.col(growth).alias("value"))
    up = own.where("value > 0").orderBy(F.col("value").desc(), "unit").limit(n).withColumn("kind", F.lit("growth"))
    down = own.where("value < 0").orderBy("value", "unit").limit(n).withColumn("kind", F.lit("decline"))
    place = F.row_number().over(Window.partitionBy("kind").orderBy(F.abs("value").desc(), "unit"))
    return up.unionByName(down).select("kind", place.alias("place"), "unit", "value")


def confidence(matched_pct: Column, low: float = 80.0, high: float = 98.0) -> Column:
    return F.when(matched_pct >= high, "high").when(matched_pct >= low, "medium").otherwise("low")
