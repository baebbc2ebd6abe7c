"""The audit of sources against a plain computation with whole numbers of any size."""

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest

from apportion.llm import divergence, queries

CAPITALS = {c: c + 32 for c in range(65, 91)}


def plain(docs, least=10, top=10):
    docs = [tuple(x or "" for x in d) for d in docs]
    seen, counts = defaultdict(Counter), defaultdict(Counter)
    for text, lang, source in docs:
        own = re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", text.translate(CAPITALS))
        seen[lang].update(set(own))
        counts[lang, source].update(own)
    out = []
    for lang in seen:
        kept = [t for t, n in seen[lang].items() if n >= least]
        pools = {s: counts[k, s] for k, s in counts if k == lang}

        def shares(c):
            total = sum(c[t] for t in kept) + 2 * len(kept)
            return {t: 1 + 10**9 * (c[t] + 2) // total for t in kept}

        p = {s: shares(c) for s, c in pools.items()}
        q = shares(sum(pools.values(), Counter()))

        def f(a, b):
            return (a - b) ** 2 // (a + b)

        for s in pools:
            pair = sorted(((-sum(f(p[s][t], p[o][t]) for t in kept), o.encode()) for o in pools if o != s))
            term = sorted((-f(p[s][t], q[t]), t.encode()) for t in kept if pools[s][t] and p[s][t] > q[t])[:top]
            for part, rows in (("pair", pair), ("term", term)):
                out += [(lang, s, part, item.decode(), -v, n) for n, (v, item) in enumerate(rows, 1)]
    return sorted(out)


def docs_of(n, seed=1):
    r = random.Random(seed)
    words = [*"the of and to is was é für naïve Ünï x".split(), *(f"w{'abcdefghij'[k % 10]}{'klmnopqrst'[k // 10]}" for k in range(60))]
    return [(" ".join(r.choices(words, k=r.randrange(40))), r.choice(["en", "de", None]), r.choice(["a", "b", "c", "é", None])) for _ in range(n)]


@pytest.mark.parametrize("block,spill", [(divergence.BLOCK, divergence.SPILL), (100, 7)])
def test_against_plain(spark, monkeypatch, block, spill):
    monkeypatch.setattr(divergence, "BLOCK", block)
    monkeypatch.setattr(divergence, "SPILL", spill)
    docs = [*docs_of(300), (None, "en", "only nulls"), ("", "fr", "z"), ("no term often enough", "fr", "y"), ("THE the. tHe" * 50, "en", "a"), ("é" * 400 + " \x00the\x7f", None, ""), *docs_of(5)]
    df = spark.createDataFrame([(*d, "x", 1) for d in docs], "text string, lang string, source string, term string, n int").repartition(5)
    got = divergence.audit(df)
    assert got.dtypes == [("lang", "string"), ("source", "string"), ("part", "string"), ("item", "string"), ("value", "bigint"), ("rank", "int")]
    assert sorted(map(tuple, got.collect())) == plain(docs)


def test_no_rows_and_one_text_in_every_row(spark):
    docs = [("same text again", "en", f"s{k % 3}") for k in range(60)]
    df = spark.createDataFrame(docs, "text string, lang string, source string")
    assert sorted(map(tuple, divergence.audit(df).collect())) == plain(docs)
    assert divergence.audit(df.where("false")).count() == 0


def test_a_term_at_the_edge_of_the_cut(spark):
    docs = [("often rare" if k < 9 else "often", "en", "ab"[k % 2]) for k in range(10)]
    df = spark.createDataFrame(docs, "text string, lang string, source string")
    assert sorted(map(tuple, divergence.audit(df).collect())) == plain(docs)
    assert sorted(map(tuple, divergence.audit(df, least=9, top=1).collect())) == plain(docs, 9, 1)


def test_large_counts_are_exact(spark):
    n, total, terms = 9_300_000_000_000, 3 * 10**13, 70_000_000
    df = spark.createDataFrame([(n, total, terms)], "n long, total long, terms long")
    from pyspark.sql import functions as F

    assert df.select(divergence.share(F.col("n"), F.col("total"), F.col("terms")).alias("p")).first()["p"] == 1 + 10**9 * (n + 2) // (total + 2 * terms)


def test_runs_are_whole_whatever_the_batches():
    r = random.Random(5)
    keys = sorted(r.choice("abc") for _ in range(40))
    table = pa.table({"k": keys, "i": range(40)})
    for size in (1, 3, 40):
        parts = list(divergence._streamed(table.to_batches(max_chunksize=size), 1))
        assert [x for t in parts for x in t["i"].to_pylist()] == list(range(40))
        ends = [t["k"][0].as_py() for t in parts]
        assert len(set(ends)) == len(ends) or size == 40
    assert np.array_equal(divergence._runs(np.array([1, 1, 2]), np.array([1, 2, 2])), [0, 1, 2])
    assert list(divergence._streamed([], 1)) == []


def test_query(spark):
    sf = "/root/testdata/sf0.001"
    docs = [(r["text"], r["lang"], r["source"]) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    assert sorted(map(tuple, queries.op13_divergence(spark, sf).collect())) == plain(docs)
