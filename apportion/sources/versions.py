"""Folders whose content is replaced at once: each write is a new version beside the old one, made current by one small file.

    <path>/data/version=<n>      rows, in folders by key
    <path>/current/version=<n>   one file that names version n, its format and a note, such as a manifest

Data are written first, whole. The file that names them is moved to its place by the commit of its job, so whoever reads sees the old
version or the new one, with its note, and a run that ends in between leaves the old one as it was. A run may read
what it replaces. One writer at a time is meant.
"""

from __future__ import annotations

import json

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_NAMED = "format string, note string, version int"


def latest(spark: SparkSession, path: str):
    """The row (version, format, note) of the version that is current; None before the first."""
    try:
        named = spark.read.schema(_NAMED).json(f"{path}/current")
    except AnalysisException as e:
        if "PATH_NOT_FOUND" in str(e):
            return None
        raise
    # A version's folder may be there before its file is.
    return named.where("format IS NOT NULL").orderBy(F.col("version").desc()).first()


def publish(rows: DataFrame, path: str, kind: str = "parquet", *keys: str, note: str | None = None, **options) -> int:
    """rows as the current version of `path`, in folders by `keys`; returns the version's number."""
    spark = rows.sparkSession
    before = latest(spark, path)
    n = 1 + (before["version"] if before else 0)
    # What an earlier run left of this number was never current.
    rows.write.mode("overwrite").partitionBy(*keys).format(kind).options(**options).save(f"{path}/data/version={n}")
    one = spark.range(1, numPartitions=1).select(F.lit(json.dumps({"format": kind, "note": note, "options": options})).alias("value"))
    one.write.mode("overwrite").text(f"{path}/current/version={n}")
    return n


def current(spark: SparkSession, path: str, schema: str | None = None, **options) -> DataFrame:
    """Rows of the version that is current; FileNotFoundError before the first."""
    found = latest(spark, path)
    if found is None:
        raise FileNotFoundError(path)
    reader = spark.read.format(found["format"]).options(**options)
    return (reader.schema(schema) if schema else reader).load(f"{path}/data/version={found['version']}")


def tidy(spark: SparkSession, path: str, keep: int = 2) -> list[int]:
    """Removes all but the last `keep` versions, those that no run reads any more; returns their numbers."""
    found = latest(spark, path)
    old = [] if found is None else [r["version"] for r in spark.read.schema(_NAMED).json(f"{path}/current").where(F.col("version") <= found["version"] - keep).select("version").distinct().collect()]
    jvm = spark.sparkContext._jvm
    for n in sorted(old):
        for part in ("current", "data"):
            where = jvm.org.apache.hadoop.fs.Path(f"{path}/{part}/version={n}")
            where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)
    return sorted(old)
