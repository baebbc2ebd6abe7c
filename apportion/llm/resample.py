"""Resampling towards a target distribution: each document is drawn with odds of its likelihood ratio, exactly k of them.

Features are the runs of 1 to 3 words, hashed to BUCKETS buckets. A bucket's gain is the log of its smoothed share in the
target over that in the corpus, in whole thousandths; a document's weight is the sum over its features, looked up in an
array. Weight and Gumbel noise, fixed by the document's id, make its score: the k highest scores are a draw without
replacement in proportion to the exponentials of the weights.

The k-th highest key is found by radix selection: rounds count the rows of each digit of (score, id, number of features,
place) among the rows that share all digits before, until the rows of a digit are wanted all together. A round's counts
are at most DIGITS rows. Only the drawn rows are then sorted, by ranges, and ranked.

Null texts have no words and weight 0. Null ids draw as the empty text, and rank after all others of their score. Rows
that repeat an id and a score rank by their number of features; rows that agree in that too are the same in the result.
Without a document of enough words nothing is drawn.
"""

from __future__ import annotations

import math
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import cut
from .words import LETTER_OR_DIGIT, Words, blocks, words

BUCKETS = 10_000
LONGEST_RUN = 3
DIGITS = 1 << 12
SCALE = 1000

_shifts: list[np.ndarray] = []


def _shift_tables() -> np.ndarray:
    """[l, k, v]: byte k of value v of a checksum, after l further bytes of zero; by linearity, a checksum of joined texts."""
    if not _shifts:
        one = np.array([zlib.crc32(bytes([v])) for v in range(256)], dtype=np.uint32) ^ np.uint32(zlib.crc32(b"\0"))
        out = np.zeros((64, 4, 256), dtype=np.uint32)
        out[0] = np.arange(256, dtype=np.uint32) << (np.arange(4, dtype=np.uint32) * 8)[:, None]
        for n in range(1, 64):
            out[n] = one[out[n - 1] & np.uint32(255)] ^ (out[n - 1] >> np.uint32(8))
        _shifts.append(out)
    return _shifts[0]


def shifted(crc: np.ndarray, by: np.ndarray) -> np.ndarray:
    """Checksums moved over `by` bytes each: crc32(a + b) is shifted(crc32(a), len(b)) ^ crc32(b)."""
    t = _shift_tables()

    def step(x, n):
        return t[n, 0, x & 255] ^ t[n, 1, (x >> np.uint32(8)) & 255] ^ t[n, 2, (x >> np.uint32(16)) & 255] ^ t[n, 3, x >> np.uint32(24)]

    out = step(crc, by & 63)
    left, span = by >> 6, 0  # long words: 64 bytes at a time, doubled
    while left.any():
        odd = np.flatnonzero(left & 1)
        if len(odd):
            x = out[odd]
            for _ in range(1 << span):
                x = step(step(x, 63), 1)
            out[odd] = x
        left, span = left >> 1, span + 1
    return out


def features(w: Words) -> list[tuple[np.ndarray, np.ndarray]]:
    """(text, bucket) of each run of 1, of 2 and of 3 words."""
    code, distinct = w.coded()
    held = distinct.to_pylist()
    own = np.array([zlib.crc32(x) for x in held], dtype=np.uint32)[code] if held else np.zeros(0, dtype=np.uint32)
    blank = np.uint32(zlib.crc32(b" "))
    out, crc, text = [(w.text, own % BUCKETS)], own, w.text
    for k in range(1, LONGEST_RUN):
        n = max(0, len(own) - k)
        spaced = shifted(crc[:n], np.ones(n, dtype=np.int64)) ^ blank
        crc = shifted(spaced, w.length[k:]) ^ own[k:]
        out.append((text[:n][same := text[:n] == text[k:]], crc[same] % BUCKETS))
    return out


def bucket_counts(docs: DataFrame, text_col: str = "text") -> np.ndarray:
    """How many features of all texts fall into each bucket: a sum in each task, then over tasks."""

    def run(batches):
        total = np.zeros(BUCKETS, dtype=np.int64)
        for batch in batches:
            for _, _, raw, at in blocks(batch.column(0)):
                for _, bucket in features(words(raw, at, LETTER_OR_DIGIT)):
                    total += np.bincount(bucket, minlength=BUCKETS)
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some, pa.int32()), pa.array(total[some], pa.int64())], names=["bucket", "n"])

    out = np.zeros(BUCKETS, dtype=np.int64)
    for r in docs.select(text_col).mapInArrow(run, "bucket int, n long").groupBy("bucket").agg(F.sum("n").alias("n")).collect():
        out[r["bucket"]] = r["n"]
    return out


def gains(corpus: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Whole thousandths of each bucket's log ratio, rounded down."""
    s, t = float(corpus.sum()), float(target.sum())
    return np.array([math.floor(SCALE * math.log((b + 1.0) * (s + BUCKETS) / ((a + 1.0) * (t + BUCKETS)))) for a, b in zip(map(float, corpus), map(float, target), strict=True)], dtype=np.int64)


def weights(docs: DataFrame, gain: np.ndarray, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Rows (id, n_words, n_features, weight), one for each row of docs. Weights are whole numbers below 2^53."""
    kind = docs.select(id_col).schema[0].dataType.simpleString()
    sent = docs.sparkSession.sparkContext.broadcast(gain)

    def run(batches):
        for batch in batches:
            for first, end, raw, at in blocks(batch.column(1)):
                n = end - first
                w = words(raw, at, LETTER_OR_DIGIT)
                found = features(w)
                counts = [np.bincount(text, minlength=n) for text, _ in found]
                weight = sum(np.bincount(text, weights=sent.value[bucket], minlength=n) for text, bucket in found).astype(np.int64)
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(first, n), *(pa.array(x.astype(np.int64)) for x in (counts[0], sum(counts), weight))], names=[id_col, "n_words", "n_features", "weight"])

    return docs.select(id_col, text_col).mapInArrow(run, f"`{id_col}` {kind}, n_words long, n_features long, weight long")


def noise(doc_id: Column, seed: int = 42) -> Column:
    """Standard Gumbel noise in whole thousandths, from a hash of the seed and the id."""
    h = F.conv(F.substring(F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit(""))), 256), 1, 8), 16, 10).cast("long")
    return F.floor(-SCALE * F.log(-F.log((h + F.lit(0.5)) / F.lit(4294967296.0)))).cast("long")


def last_key(rows: DataFrame, keys: list[str], k: int, size: int) -> list[int]:
    """The k-th smallest (k > 0) of the keys of `size` rows by radix selection; keys are whole numbers, none null, and no two
    rows agree in all of them.

    A round is one pass over narrow rows and gives at most DIGITS counts. Where rows that agree in the first keys are not
    all wanted, the next key decides; keys that decide nothing are left out of the answer.
    """
    at: list[int] = []
    rest = rows
    for key in keys:
        ends = rest.agg(F.min(key).alias("low"), F.max(key).alias("high")).first()
        low, high = int(ends["low"]), int(ends["high"])
        while low < high:
            step = -(-(high - low + 1) // DIGITS)
            # The difference of two numbers may have 65 bits.
            digit = F.expr(f"({key} - ({low}L)) div {step}L" if high - low < 1 << 62 else f"cast((cast({key} as decimal(20,0)) - ({low}BD)) div {step}BD as long)")
            counts = rest.where(F.col(key).between(low, high)).groupBy(digit.alias("digit")).agg(F.count("*").alias("n")).collect()
            for d, size in sorted((r["digit"], r["n"]) for r in counts):
                if size >= k:
                    break
                k -= size
            low, high = low + d * step, min(high, low + (d + 1) * step - 1)
            if size == k:
                return [*at, high]
        at.append(low)
        rest = rest.where(F.col(key) == low)
    return at


def up_to(keys: list[str], last: list[int]) -> Column:
    """Whether the keys, in order, are at most `last`, which may be shorter."""
    out = F.lit(True)
    for key, x in reversed(list(zip(keys, last, strict=False))):
        out = (F.col(key) < x) | ((F.col(key) == x) & out)
    return out


def ranked(rows: DataFrame, keys: list[str]) -> DataFrame:
    """Adds rank, from 1 in the order of keys that no two rows share: sorted by ranges, then placed after the ranges before."""
    placed = cut(rows.repartitionByRange(*keys).sortWithinPartitions(*keys).withColumn("__at", F.monotonically_increasing_id()))
    # The number's upper bits are the range's, its lower 33 bits the position in it.
    split = placed.withColumn("__range", F.shiftright("__at", 33))
    sizes = split.groupBy("__range").agg(F.count("*").alias("__n"))
    before = sizes.select("__range", F.coalesce(F.sum("__n").over(Window.orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("__before"))
    return split.join(before, "__range").select(*rows.columns, (F.col("__before") + F.col("__at").bitwiseAND((1 << 33) - 1) + 1).alias("rank"))


def resample(docs: DataFrame, target: DataFrame, percent: int = 5, least_words: int = 20, seed: int = 42, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Rows (id, n_features, weight, score, rank), one for each row of docs; ids are whole numbers.

    Of the documents with at least `least_words` words `percent` in a hundred are drawn, rounded down: those of the highest
    scores, of equal ones the smaller id. They are ranked from 1 in this order; the others have no rank.
    """
    gain = gains(bucket_counts(docs, text_col), bucket_counts(target, text_col))
    scored = weights(docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")), gain, "id").withColumn("score", F.col("weight") + noise(F.col("id"), seed))
    keys = [f"k{i}" for i in range(5)]
    # All that follows needs a few numbers a row. A row's place tells equal rows apart.
    own = [-F.col("score"), F.col("id").isNull().cast("long"), F.coalesce(F.col("id").cast("long"), F.lit(0).cast("long")), F.col("n_features"), F.col("place")]
    rows = cut(scored).withColumn("place", F.monotonically_increasing_id()).select("*", *[c.alias(k) for c, k in zip(own, keys, strict=True)])
    able = F.col("n_words") >= least_words
    size = rows.where(able).count()
    k = percent * size // 100
    drawn = able & up_to(keys, last_key(rows.where(able), keys, k, size)) if 0 < k < size else able & F.lit(k > 0)
    out = [F.col("id").alias(id_col), "n_features", "weight", "score"]
    first = ranked(rows.where(drawn), keys).select(*out, "rank")
    return first.unionByName(rows.where(~drawn).select(*out, F.lit(None).cast("long").alias("rank")))
