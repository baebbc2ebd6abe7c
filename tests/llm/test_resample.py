"""Importance resampling against a plain computation of all of it."""

import hashlib
import math
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from apportion.llm import queries, resample
from apportion.llm import words as W

CAPITALS = {c: c + 32 for c in range(65, 91)}


def grams(text):
    own = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(CAPITALS))
    return own, [" ".join(own[i : i + k]) for k in (1, 2, 3) for i in range(len(own) - k + 1)]


def plain(docs, target, percent=5, least=20):
    """(id, n_features, weight, score, rank), for rows whose (score, id, n_features) differ or that are equal in all."""

    def bucket(g):
        return zlib.crc32(g.encode()) % 10_000

    s, t = np.zeros(10_000), np.zeros(10_000)
    for _, text in docs:
        for g in grams(text)[1]:
            s[bucket(g)] += 1
    for text in target:
        for g in grams(text)[1]:
            t[bucket(g)] += 1
    gain = [math.floor(1000 * math.log((b + 1) * (s.sum() + 10_000) / ((a + 1) * (t.sum() + 10_000)))) for a, b in zip(s, t, strict=True)]
    rows = []
    for i, text in docs:
        own, all_grams = grams(text)
        weight = sum(gain[bucket(g)] for g in all_grams)
        h = int(hashlib.sha256(f"42:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        rows.append([i, len(all_grams), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), None, len(own) >= least])
    able = sorted((r for r in rows if r[5]), key=lambda r: (-r[3], r[0] is None, r[0] or 0, r[1]))
    for n, r in enumerate(able[: percent * len(able) // 100], 1):
        r[4] = n
    return sorted(map(tuple, (r[:5] for r in rows)), key=repr)


def test_checksums_of_joined_texts():
    r = random.Random(2)
    for n in (0, 1, 5, 63, 64, 65, 128, 1_000, 70_001):
        a, b = r.randbytes(r.randrange(40)), r.randbytes(n)
        got = resample.shifted(np.array([zlib.crc32(a)], dtype=np.uint32), np.array([n])) ^ np.uint32(zlib.crc32(b))
        assert got[0] == zlib.crc32(a + b)


@pytest.mark.parametrize("size", [1, 40, 1 << 20])
def test_words_of_odd_texts(size):
    import pyarrow as pa

    texts = ["", None, "One two2\tthree", "é été Ünï", "a" * 100, "日本語 テキスト", "\x00a\x7fb", "end", "start", "-", "x" * 300 + " y"]
    for column in (pa.array(texts), pa.array(["before", *texts])[1:], pa.chunked_array([texts])):
        got = {}
        for first, _, raw, at in W.blocks(column, size):
            w = W.words(raw, at, W.LETTER_OR_DIGIT)
            code, distinct = w.coded()
            for t, c in zip(w.text, code, strict=True):
                got.setdefault(first + int(t), []).append(distinct[int(c)].as_py().decode())
        assert [got.get(i, []) for i in range(len(texts))] == [grams(t)[0] for t in texts]


def docs_of(n, seed=1):
    r = random.Random(seed)
    vocabulary = [*"the of and to in is was é für naïve Z9 x1".split(), "w" * 90]
    return [(i, " ".join(r.choices(vocabulary, k=r.randrange(12, 50)))) for i in range(n)]


@pytest.mark.parametrize("percent", [0, 5, 33, 100])
def test_against_plain(spark, percent):
    docs = [*docs_of(300), (None, None), (None, "the of " * 15), (None, "the of " * 15), (-5, ""), (7, "É, é! " * 30), (300, "one. two\x00three"), *docs_of(3)]
    target = ["the of naïve x1 x1 is", "für was", None]
    df = spark.createDataFrame([(i, t, "s") for i, t in docs], "doc_id long, text string, score string").repartition(5)
    got = resample.resample(df, spark.createDataFrame([(t,) for t in target], "text string"), percent)
    assert got.dtypes == [("doc_id", "bigint"), *((c, "bigint") for c in ("n_features", "weight", "score", "rank"))]
    assert sorted(map(tuple, got.collect()), key=repr) == plain(docs, target, percent)


@pytest.mark.parametrize("digits", [64, 4096])
def test_the_last_key_is_that_of_sorting(spark, monkeypatch, digits):
    monkeypatch.setattr(resample, "DIGITS", digits)
    r = random.Random(9)
    rows = [(r.choice([0, 0, 0, -(1 << 63), (1 << 63) - 1, r.randrange(9)]), r.randrange(3), k) for k in range(200)]
    df = spark.createDataFrame(rows, "a long, b long, c long").cache()
    for k in (1, 77, 140, 200):
        last = resample.last_key(df, ["a", "b", "c"], k, 200)
        assert sorted(map(tuple, df.where(resample.up_to(["a", "b", "c"], last)).collect())) == sorted(rows)[:k]


def test_one_text_in_every_row_and_no_rows(spark):
    """All weights agree, so noise and ids decide; rows that are equal in all are ranked each."""
    docs = [(k // 3, "same text " * 12) for k in range(600)]
    df = spark.createDataFrame(docs, "doc_id int, text string").repartition(4)
    got = resample.resample(df, df.select("text").limit(1), 10)
    assert sorted(map(tuple, got.collect()), key=repr) == plain(docs, ["same text " * 12], 10)
    empty = df.where("false")
    assert resample.resample(empty, empty.select("text")).count() == 0
    assert {r["rank"] for r in resample.resample(df, empty.select("text"), 0).collect()} == {None}


def test_query(spark):
    sf = "/root/testdata/sf0.001"
    docs = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    target = [r["text"] for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
    got = queries.op12_resample(spark, sf)
    assert sorted(map(tuple, got.collect()), key=repr) == plain(docs, target)
    assert got.where(F.col("rank").isNotNull()).count() > 0
