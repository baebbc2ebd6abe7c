"""Locality dimension: aliases that mean one locality, and lookups that fall back on the key itself."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from apportion.functions.settle import settle
from apportion.functions.text import is_non_geographic, locality_aliases, locality_key, party_bucket, precinct_code_of_label


def aliases(localities: DataFrame, name: str = "name") -> DataFrame:
    """(alias, canonical), distinct, for every alias of every locality."""
    canonical = locality_key(F.col(name))
    return localities.select(canonical.alias("canonical")).where("canonical != ''").select(F.explode(locality_aliases(F.col("canonical"))).alias("alias"), "canonical").distinct()


def alias_map(localities: DataFrame, name: str = "name") -> DataFrame:
    """(alias, canonical) for aliases of exactly one locality."""
    return aliases(localities, name).groupBy("alias").agg(F.min("canonical").alias("canonical"), F.count("*").alias("n")).where("n = 1").drop("n")


def ambiguous_aliases(localities: DataFrame, name: str = "name") -> DataFrame:
    """(alias, candidates) for aliases of more than one locality, candidates in order and joined by a bar."""
    return aliases(localities, name).groupBy("alias").agg(F.array_join(F.array_sort(F.collect_set("canonical")), "|").alias("candidates"), F.count("*").alias("n")).where("n > 1").drop("n")


def canonicalise(df: DataFrame, names: DataFrame, key: str, into: str = "county") -> DataFrame:
    """df with the canonical locality of column `key` (a locality key); unknown keys stay as they are."""
    found = names.select(F.col("alias").alias("__alias"), F.col("canonical").alias("__canonical"))
    return df.join(found, F.col(key) == F.col("__alias"), "left").withColumn(into, F.coalesce("__canonical", F.col(key))).drop("__alias", "__canonical")


def unmatched(df: DataFrame, names: DataFrame, key: str) -> DataFrame:
    """Distinct keys of df that the map lacks."""
    return df.select(F.col(key).alias("alias")).distinct().join(names.select("alias"), "alias", "left_anti")


def search(terms: DataFrame, localities: DataFrame, n: int = 5, term: str = "term", name: str = "name") -> DataFrame:
    """(term, place, canonical, kind): up to n localities for each distinct search term, best first.

    A term is an alias (`exact`) or, if several localities have that alias, a bare name that suggests them all
    (`ambiguous`), or the beginning of an alias (`prefix`). Within a kind the shorter alias comes first, then the name. Prefixes are a
    table, as long as the aliases are, so terms meet it in one equi-join. Empty terms find nothing.
    """
    known = aliases(localities, name)
    many = known.groupBy("alias").agg(F.count("*").alias("__n"))
    heads = F.transform(F.sequence(F.lit(1), F.length("alias")), lambda i: F.substring("alias", F.lit(1), i))
    prefixes = known.join(many, "alias").select("alias", "canonical", "__n", F.explode(heads).alias("__key"))
    asked = terms.select(F.col(term).alias("term"), locality_key(F.col(term)).alias("__key")).where("__key != ''").distinct()
    exact = F.col("alias") == F.col("__key")
    rank = F.when(exact & (F.col("__n") == 1), 1).when(exact, 2).otherwise(3)
    best = asked.join(prefixes, "__key").groupBy("term", "canonical").agg(F.min(F.struct(rank.alias("rank"), F.length("alias").alias("size"))).alias("best"))
    place = F.row_number().over(Window.partitionBy("term").orderBy("best", "canonical"))
    kind = F.element_at(F.array(F.lit("exact"), F.lit("ambiguous"), F.lit("prefix")), F.col("best.rank"))
    return best.select("term", place.alias("place"), "canonical", kind.alias("kind")).where(F.col("place") <= n)


FEW_LABELS = 200_000
"""Labels up to this number are sent to all tasks; more are joined by their key."""


def coded(ballots: DataFrame, labels: DataFrame | None = None) -> DataFrame:
    """ballots with bucket, code and non_geographic, made from their party and precinct label.

    Returns name a precinct in each line of each contest, so what labels mean is worked out once for each distinct (party,
    precinct) and joined back. `labels` may give these pairs where they are known from less than the ballots.
    """
    on = ["party", "precinct"]
    pairs = (ballots if labels is None else labels).select(*[F.coalesce(c, F.lit("")).alias(c) for c in on]).distinct()
    known = settle(pairs.select(*on, party_bucket(F.col("party")).alias("bucket"), precinct_code_of_label(F.col("precinct")).alias("code"), is_non_geographic(F.col("precinct")).alias("non_geographic")))
    known = F.broadcast(known) if known.count() <= FEW_LABELS else known
    return ballots.withColumns({c: F.coalesce(c, F.lit("")) for c in on}).join(known, on)
