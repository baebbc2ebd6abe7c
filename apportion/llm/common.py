"""Helpers shared by the corpus operators."""

from __future__ import annotations

import tempfile

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fold(doc_id: Column, k: int) -> Column:
    """crc32 of the id as text, modulo k; a null id counts as empty text."""
    return F.pmod(F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")), F.lit(k)).cast("int")


def cut(df: DataFrame) -> DataFrame:
    """Cut lineage with an eager checkpoint in the folder that spark.checkpoint.dir names.

    Where the setting is missing, a local session gets a folder of its own; a cluster, whose nodes share none, an error.
    """
    shared_folder(df.sparkSession)
    return df.checkpoint()


def shared_folder(spark: SparkSession) -> str:
    """A folder of this session's own in the one that spark.checkpoint.dir names."""
    sc = spark.sparkContext
    if sc.getCheckpointDir() is None:
        folder = sc.getConf().get("spark.checkpoint.dir")
        if folder is None and not (sc.master == "local" or sc.master.startswith("local[")):
            raise RuntimeError("spark.checkpoint.dir must name a folder that all nodes share")
        sc.setCheckpointDir(folder or tempfile.mkdtemp(prefix="checkpoint"))
    return sc.getCheckpointDir()


def fresh(df: DataFrame, name: str) -> str:
    """A name for a new column that no column of df has, in whatever case."""
    taken = {c.lower() for c in df.columns}
    out = f"__{name}"
    while out.lower() in taken:
        out = f"_{out}"
    return out


def text_batches(batches, column: str = "text", rows: int = 256):
    """Slices of each Arrow batch of at most `rows` rows, with the texts as a list (null: empty)."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            part = batch.slice(at, rows)
            yield part, [x if x is not None else "" for x in part.column(column).to_pylist()]


LONGEST = 1 << 16
"""Characters of the longest text that a sample to learn from may hold."""


def bounded_sample(df: DataFrame, rows: int, text: str | None = "text") -> DataFrame:
    """At most `rows` distinct rows of df whose text is not null and has at most LONGEST characters, to learn a model from.
    So a sample has at most rows x LONGEST characters, however many rows repeat an id or a text.

    They are the rows with the smallest hashes of all their columns: the same ones however df is partitioned and whatever
    its size, all of them where df has no more, and equal rows once. Hashes below a bound that lets through four times the
    need are looked at first; where rows repeat so much that this is too few, the bound is raised.
    """
    total = df.count()
    h = fresh(df, "hash")
    own = (df if text is None else df.where(F.length(text) <= LONGEST)).withColumn(h, F.xxhash64(*df.columns, F.lit("sample")))
    share = min(1.0, 4 * rows / max(1, total))
    while True:
        low = own if share == 1 else own.where(F.col(h) < -(1 << 63) + int((1 << 64) * share))
        found = low.select(h).distinct().orderBy(h).limit(rows).agg(F.count("*").alias("n"), F.max(h).alias("last")).first()
        if found["n"] == rows or share == 1:
            break
        share = min(1.0, 16 * share)
    return low.where(F.col(h) <= F.lit(found["last"])).drop(h).distinct()


def labelled_sample(docs: DataFrame, labels: DataFrame, label_col: str, rows: int, id_col: str = "doc_id", text_col: str = "text") -> list:
    """At most `rows` rows (__id, text, __label) of docs with labels 0 and 1, as bounded_sample() draws them: `rows` labels,
    the bounded side of a broadcast join, and of what they meet `rows` distinct texts, however often an id occurs."""
    own = labels.where(F.col(label_col).isin(0, 1) & F.col(id_col).isNotNull()).select(F.col(id_col).alias("__id"), F.col(label_col).cast("int").alias("__label"))
    chosen = bounded_sample(own, rows, None)
    met = docs.select(F.col(id_col).alias("__id"), F.col(text_col).alias("text")).join(F.broadcast(chosen), "__id")
    return bounded_sample(met.select("__id", "text", "__label"), rows).collect()


def offsets(lengths) -> np.ndarray:
    """Start of each run, for runs of these lengths laid end to end, and the end of the last."""
    out = np.zeros(len(lengths) + 1, dtype=np.int64)
    np.cumsum(lengths, out=out[1:])
    return out


def record_batch(schema: pa.Schema, *columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([c if isinstance(c, (pa.Array, pa.ChunkedArray)) else pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)
