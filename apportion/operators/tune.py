"""Tuning of blends: every configuration is scored from the same sufficient statistics, in one job for a whole grid.

A district's votes are linear in its counties' blends. So one pass over the ballots gives, for each target, county and
bucket, the votes that don't depend on the blend and both ends of those that do; a configuration is then a join of a few
rows, not another pass. Search loops run on the driver over tables of metrics alone.
"""

from __future__ import annotations

import json
import math
from collections.abc import Iterable

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from apportion.functions import votes as V

from .allocate import CONTEST, Apportioned
from .crosswalk import Crosswalk, shares

KEY = [*CONTEST, "district"]


def statistics(found: Apportioned, geometry: Crosswalk, targets: DataFrame) -> DataFrame:
    """(target key, target_margin_pct, county, bucket, fixed, at_total, at_party): votes of each target's district.

    `fixed` votes are direct or allocated without a choice; unmatched votes of the bucket come to (1 - blend) at_total +
    blend at_party. Targets without votes have one row of zeros with no county.
    """
    own = [*CONTEST, "county"]
    direct = found.contributions.where("source = 'direct'").groupBy(*own, "district", "bucket").agg(F.sum("votes").alias("votes"))
    rest = found.unmatched.groupBy(*own, "bucket").agg(F.sum("votes").alias("rest"))
    total = shares(direct.groupBy(*own, "district").agg(F.sum("votes").alias("v")), own, "v", "t").drop("v")
    party = shares(direct, [*own, "bucket"], "votes", "p").drop("votes")
    has = party.select(*own, "bucket").distinct().withColumn("__p", F.lit(True))
    a = rest.join(total, own).join(has, [*own, "bucket"], "left").join(party, [*own, "bucket", "district"], "left").fillna(0.0, ["p"])
    a = a.select(*own, "district", "bucket", F.when(F.col("__p").isNull(), F.col("rest") * F.col("t")).otherwise(0.0).alias("fixed"), *[F.when(F.col("__p"), F.col("rest") * F.col(c)).otherwise(0.0).alias(n) for c, n in (("t", "at_total"), ("p", "at_party"))])
    b = rest.join(total.select(*own).distinct(), own, "left_anti").join(geometry.county_weights, ["scope", "county"]).select(*own, "district", "bucket", (F.col("rest") * F.col("share")).alias("fixed"), F.lit(0.0).alias("at_total"), F.lit(0.0).alias("at_party"))
    d = direct.select(*own, "district", "bucket", F.col("votes").alias("fixed"), F.lit(0.0).alias("at_total"), F.lit(0.0).alias("at_party"))
    sums = d.unionByName(a).unionByName(b).groupBy(*KEY, "county", "bucket").agg(*[F.sum(c).alias(c) for c in ("fixed", "at_total", "at_party")])
    return targets.select(*KEY, "target_margin_pct").join(sums, KEY, "left").fillna(0.0, ["fixed", "at_total", "at_party"])


def evaluate(stats: DataFrame, configs: DataFrame, strict_zero: bool = False) -> DataFrame:
    """(config_id, target key, target_margin_pct, raw_margin_pct, abs_error) for configs (config_id, scope, county, blend).

    Each configuration has a row with null county for each scope, and may have rows for counties.
    """
    own = configs.where("county IS NOT NULL").select("config_id", "scope", "county", F.col("blend").alias("__own"))
    each = stats.join(configs.where("county IS NULL").select("config_id", "scope", F.col("blend").alias("__default")), "scope").join(own, ["config_id", "scope", "county"], "left")
    blend = V.clamp(F.coalesce("__own", "__default"), 0.0, 1.0)
    moving = (1 - blend) * F.col("at_total") + blend * F.col("at_party")
    moving = moving if strict_zero else F.when(blend > 0, moving).otherwise(F.col("at_party"))
    sums = each.withColumn("votes", F.col("fixed") + moving).groupBy("config_id", *KEY, "target_margin_pct").agg(*[F.sum(F.when(F.col("bucket") == b, F.col("votes")).otherwise(0.0)).alias(b) for b in ("dem", "rep", "other")])
    margin = V.margin_pct(F.col("dem"), F.col("rep"), F.expr("dem + rep + other"))
    return sums.select("config_id", *KEY, "target_margin_pct", margin.alias("raw_margin_pct"), F.abs(margin - F.col("target_margin_pct")).alias("abs_error"))


def compared(baseline: DataFrame, trials: DataFrame) -> DataFrame:
    """(config_id, target key, baseline_abs_error, trial_abs_error, improvement) of the targets that each trial improves.

    A target without an error in the trial keeps the baseline's, so it doesn't count.
    """
    base = baseline.select(*KEY, F.col("abs_error").alias("baseline_abs_error"))
    ids = F.array(*[F.lit(r["config_id"]) for r in trials.select("config_id").distinct().collect()]).cast("array<string>")  # as many as the grid has
    both = base.select("*", F.explode(ids).alias("config_id")).join(trials.select("config_id", *KEY, F.col("abs_error").alias("__trial")), ["config_id", *KEY], "left")
    rows = both.withColumn("trial_abs_error", F.coalesce("__trial", "baseline_abs_error")).withColumn("improvement", F.col("baseline_abs_error") - F.col("trial_abs_error"))
    return rows.where("improvement > 0").select("config_id", *KEY, "baseline_abs_error", "trial_abs_error", "improvement")


def top_improved(compared_rows: DataFrame, n: int = 5) -> DataFrame:
    """(config_id, top_improved_targets): the n targets that improve most, as JSON; of equals, in order of the key."""
    w = Window.partitionBy("config_id").orderBy(F.col("improvement").desc(), *KEY)
    rows = compared_rows.withColumn("__n", F.row_number().over(w)).where(F.col("__n") <= n)
    item = F.struct("__n", F.struct(*KEY, F.bround("improvement", 3).alias("abs_error_improvement_pct"), F.bround("baseline_abs_error", 3).alias("baseline_abs_error_pct"), F.bround("trial_abs_error", 3).alias("trial_abs_error_pct")).alias("target"))
    return rows.groupBy("config_id").agg(F.to_json(F.transform(F.array_sort(F.collect_list(item)), lambda x: x["target"])).alias("top_improved_targets"))


def metrics(rows: DataFrame, threshold: float = 1.0, penalty: float = 100.0) -> DataFrame:
    """(config_id, target_count, missing_count, over_threshold_count, mae, rmse, max_abs_error); a missing margin counts `penalty`."""
    e = F.coalesce("abs_error", F.lit(penalty))
    return rows.groupBy("config_id").agg(F.count("*").alias("target_count"), F.sum(F.col("abs_error").isNull().cast("long")).alias("missing_count"), F.sum((e >= threshold).cast("long")).alias("over_threshold_count"), F.avg(e).alias("mae"), F.sqrt(F.avg(e * e)).alias("rmse"), F.max(e).alias("max_abs_error"))


def parse_grid(text: str) -> list[float]:
    """Distinct values in order, each within 0 and 1, to six decimals."""
    values = sorted({round(float(x), 6) for x in text.split(",") if x.strip()})
    if not values or values[0] < 0 or values[-1] > 1:
        raise ValueError("a grid needs values from 0 to 1")
    return values


Config = dict[tuple[str, str | None], float]
"""Blend by scope and county; county None is the scope's default."""


def signature(config: Config) -> str:
    return json.dumps([[s, c, b] for (s, c), b in sorted(config.items(), key=lambda x: (x[0][0], x[0][1] or ""))], separators=(",", ":"))


def config_frame(spark, configs: Iterable[tuple[str, Config]]) -> DataFrame:
    return spark.createDataFrame([(i, s, c, float(b)) for i, config in configs for (s, c), b in config.items()], "config_id string, scope string, county string, blend double")


def _rank(m) -> tuple:
    return (m["mae"], m["rmse"], m["max_abs_error"], m["over_threshold_count"], m["missing_count"])


def score_all(stats: DataFrame, configs: list[Config], threshold: float = 1.0, penalty: float = 100.0) -> dict[str, dict]:
    """Metrics by signature, for all configurations in one job."""
    named = {signature(c): c for c in configs}
    rows = evaluate(stats, config_frame(stats.sparkSession, named.items()))
    return {r["config_id"]: r.asDict() for r in metrics(rows, threshold, penalty).collect()}


def coordinate_descent(stats: DataFrame, start: Config, grid: list[float], rounds: int = 1, threshold: float = 1.0, penalty: float = 100.0, seen: dict[str, dict] | None = None) -> tuple[Config, list[dict]]:
    """Best configuration and the history of improvements; each parameter's grid is one job, and none is scored twice.
    `seen` gets the metrics of all that was scored, by signature."""
    stats = stats.cache()
    known: dict[str, dict] = {} if seen is None else seen

    def score(configs: list[Config]) -> list[dict]:
        new = [c for c in configs if signature(c) not in known]
        if new:
            known.update(score_all(stats, new, threshold, penalty))
        return [known[signature(c)] for c in configs]

    best, history = dict(start), []
    top = score([best])[0]
    for r in range(rounds):
        better = False
        for p in sorted(best, key=lambda k: (k[1] is not None, k[0], k[1] or "")):
            trials = [{**best, p: v} for v in grid]
            for trial, m in zip(trials, score(trials), strict=True):
                if _rank(m) < _rank(top) and not math.isnan(m["mae"]):
                    best, top, better = trial, m, True
                    history.append({"round": r + 1, "scope": p[0], "county": p[1], "value": trial[p], **{k: m[k] for k in ("mae", "rmse", "max_abs_error")}})
        if not better:
            break
    stats.unpersist()
    return best, history


def suggestions(stats: DataFrame, start: Config, counties: list[tuple[str, str]], grid: list[float], threshold: float = 1.0, penalty: float = 100.0, min_gain: float = 0.01) -> list[dict]:
    """For each county, the one value that improves the start's mean error most, if by min_gain or more; best first, with
    the targets that improve most."""
    trials = {(s, c, v): {**start, (s, c): v} for s, c in counties for v in grid}
    found = score_all(stats, [start, *trials.values()], threshold, penalty)
    base = found[signature(start)]
    out, kept = [], {}
    for s, c in counties:
        v, m = min(((v, found[signature(trials[s, c, v])]) for v in grid), key=lambda x: (_rank(x[1]), x[0]))
        if (gain := base["mae"] - m["mae"]) >= min_gain:
            now = start.get((s, c), start.get((s, None), 0.15))
            kept[signature(trials[s, c, v])] = trials[s, c, v]
            out.append({"scope": s, "county": c, "current_value": now, "suggested_value": v, "delta_value": v - now, "mae_gain": gain, "rmse_gain": base["rmse"] - m["rmse"], "over_threshold_delta": base["over_threshold_count"] - m["over_threshold_count"], "top_improved_targets": signature(trials[s, c, v])})
    if out:
        spark = stats.sparkSession
        tops = top_improved(compared(evaluate(stats, config_frame(spark, [("", start)])), evaluate(stats, config_frame(spark, kept.items()))))
        texts = {r["config_id"]: r["top_improved_targets"] for r in tops.collect()}
        for row in out:
            row["top_improved_targets"] = texts.get(row["top_improved_targets"], "[]")
    return sorted(out, key=lambda x: -x["mae_gain"])
