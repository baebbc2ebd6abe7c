"""Secret scans over an incremental blob ledger.

Every version of every path is content-addressed (SHA-256 of its text). The ledger is a stored table with one row for
each blob and rule version that has been scanned, with its spans; update() reads it, scans what it lacks and appends.
A scan finds the unseen blobs from hashes alone, an anti-join of distinct hashes with the ledger at this rule version,
and reads only the texts that a semi-join leaves; the texts of known blobs are never shuffled, and against an empty
ledger no text is: each task scans its own, each blob once, and copies in other tasks meet as ledger rows. Findings are
joined back to all paths that hold the blob; a blob that many paths share is dealt to SALTS parts.

Null text counts as empty: it has a blob like any other, without spans. Rows that repeat keep their own findings.
"""

from __future__ import annotations

import re

import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import fresh

RULE_VERSION = "2"
KINDS = ("assign", "access", "hex", "pem")
"""In the order of the digest; the first three are the base rules, pem is this method's own."""

_ASSIGN = re.compile(r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII)
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
_HEX = re.compile(r"[0-9a-f]{16,}")
_PEM = re.compile(r"-----BEGIN (?:[A-Z]+ )*PRIVATE KEY-----[A-Za-z0-9+/=\s]+(?:-----END (?:[A-Z]+ )*PRIVATE KEY-----)?")

SALTS = 16
"""Parts that the paths of one blob are dealt to where findings are joined back."""
MEMO = 100_000
"""Blobs that a task remembers, so as to scan copies once; beyond it copies are scanned again, with the same result."""

SPANS = "array<struct<kind: string, start: int, end: int>>"
LEDGER = f"blob string, rule_version string, spans {SPANS}"
_SPAN = pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())])


def find_spans(text: str) -> list[tuple[str, int, int]]:
    """(kind, start, end) in code points, by start and then by the order of KINDS.

    A match that is too short is dropped but still consumed, so matches are found with open lengths and filtered after,
    save for hex runs, where a shorter run can't hide a longer one.
    """
    found = []
    if ":" in text or "=" in text:
        found += [(m.start(), 0, m.end()) for m in _ASSIGN.finditer(text) if m.end(2) - m.start(2) >= 12]
    if "AKIA" in text:
        found += [(m.start(), 1, m.end()) for m in _ACCESS.finditer(text) if m.end() - m.start() >= 18]
    found += [(m.start(), 2, m.end()) for m in _HEX.finditer(text)]
    if "PRIVATE KEY-----" in text:
        found += [(m.start(), 3, m.end()) for m in _PEM.finditer(text)]
    return [(KINDS[k], a, b) for a, k, b in sorted(found)]


def blob_id(text: Column) -> Column:
    return F.sha2(F.coalesce(text, F.lit("")), 256)


def history(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(path, blob): every row is a version; rows repeat if the input's do."""
    return docs.select(F.col(id_col).alias("path"), blob_id(F.col(text_col)).alias("blob"))


def unseen(docs: DataFrame, ledger: DataFrame, text_col: str = "text", rule_version: str = RULE_VERSION) -> DataFrame:
    """Distinct blobs of docs that the ledger lacks at this rule version."""
    known = ledger.where(F.col("rule_version") == rule_version).select("blob")
    return docs.select(blob_id(F.col(text_col)).alias("blob")).distinct().join(known, "blob", "left_anti")


def scan(docs: DataFrame, ledger: DataFrame | None = None, text_col: str = "text", rule_version: str = RULE_VERSION) -> DataFrame:
    """New ledger rows (blob, rule_version, spans) for blobs of docs that the ledger lacks at this rule version."""

    def run(batches):
        seen: set[str] = set()
        for batch in batches:
            rows = []
            for k, (blob, t) in enumerate(zip(batch.column("blob").to_pylist(), batch.column("text").to_pylist(), strict=True)):
                if blob not in seen:
                    if len(seen) < MEMO:
                        seen.add(blob)
                    rows.append((k, blob, [{"kind": kind, "start": a, "end": b} for kind, a, b in find_spans(t or "")]))
            yield pa.RecordBatch.from_arrays([pa.array([r[1] for r in rows], pa.string()), pa.array([r[2] for r in rows], pa.list_(_SPAN))], names=["blob", "spans"])

    blobs = docs.select(blob_id(F.col(text_col)).alias("blob"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    if ledger is not None:
        blobs = blobs.join(unseen(docs, ledger, text_col, rule_version), "blob", "left_semi")
    found = blobs.mapInArrow(run, f"blob string, spans {SPANS}")
    # Copies have the same spans, so any of them will do.
    return found.groupBy("blob").agg(F.first("spans").alias("spans")).select("blob", F.lit(rule_version).alias("rule_version"), "spans")


def read_ledger(spark: SparkSession, folder: str) -> DataFrame | None:
    """The ledger stored in a folder that all nodes share; None if there is none yet."""
    try:
        return spark.read.schema(LEDGER).parquet(folder)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


def update(docs: DataFrame, folder: str, text_col: str = "text", rule_version: str = RULE_VERSION) -> DataFrame:
    """Scans the blobs of docs that the ledger in `folder` lacks, appends them, and returns the whole ledger.

    Rows that a run cut short has appended already are simply known to the next one.
    """
    spark = docs.sparkSession
    scan(docs, read_ledger(spark, folder), text_col, rule_version).write.mode("append").parquet(folder)
    return read_ledger(spark, folder)


def forget(spark: SparkSession, folder: str) -> None:
    """Removes a stored ledger."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def _hits(ledger: DataFrame, rule_version: str, blob: str, salt: str, spans: str) -> DataFrame:
    own = ledger.where((F.col("rule_version") == rule_version) & (F.size("spans") > 0)).groupBy("blob").agg(F.first("spans").alias("spans"))
    return own.select(F.col("blob").alias(blob), F.explode(F.array(*[F.lit(s) for s in range(SALTS)])).alias(salt), F.col("spans").alias(spans))


def _salt(*columns: Column) -> Column:
    return F.pmod(F.xxhash64(*columns), F.lit(SALTS)).cast("int")


def findings(docs: DataFrame, ledger: DataFrame, id_col: str = "doc_id", text_col: str = "text", rule_version: str = RULE_VERSION) -> DataFrame:
    """(path, spans) for every row of docs, from the ledger's rows of this rule version; spans is empty if there are none."""
    paths = history(docs, id_col, text_col).withColumn("salt", _salt(F.col("path")))
    return paths.join(_hits(ledger, rule_version, "blob", "salt", "spans"), ["blob", "salt"], "left").select("path", F.coalesce("spans", F.array().cast(SPANS)).alias("spans"))


def redact(docs: DataFrame, ledger: DataFrame, text_col: str = "text", mark: str = "[REDACTED]", rule_version: str = RULE_VERSION) -> DataFrame:
    """docs with every span (overlapping ones as one) replaced by `mark`; rows without findings are as they were."""

    @F.pandas_udf("string")
    def clean(text, spans):
        def one(t, found):
            out, at = [], 0
            for s in found:
                if s["end"] <= at:
                    continue
                if s["start"] >= at:
                    out += [t[at : s["start"]], mark]
                at = s["end"]
            return "".join([*out, t[at:]])

        return text.combine(spans, lambda t, s: t if t is None or s is None or len(s) == 0 else one(t, s))

    blob, salt, spans = fresh(docs, "blob"), fresh(docs, "salt"), fresh(docs, "spans")
    others = [F.col(f"`{c}`") for c in docs.columns if c != text_col]
    rows = docs.withColumn(blob, blob_id(F.col(text_col))).withColumn(salt, _salt(*others) if others else F.lit(0))
    rows = rows.join(_hits(ledger, rule_version, blob, salt, spans), [blob, salt], "left")
    return rows.withColumn(text_col, F.when(F.col(spans).isNull(), F.col(text_col)).otherwise(clean(F.col(text_col), F.col(spans)))).select(*[F.col(f"`{c}`") for c in docs.columns])
