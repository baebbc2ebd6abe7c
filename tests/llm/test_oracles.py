"""Queries with SQL against that SQL in another engine; paths of pieces against all segmentations."""

import itertools
import random

import duckdb
import pytest

from apportion.llm import pieces, queries

SF = "/root/testdata/sf0.001"
MODEL = queries.TOKENIZERS + "/piece_bpe_32k.model"


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(columns), sorted((tuple(r[i] for i in order) for r in rows), key=repr)


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_query(spark, name):
    con = duckdb.connect()
    for t in ("documents", "benchmark"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    found = con.execute(queries.ORACLES[name])
    want = rows_of([c[0] for c in found.description], found.fetchall())
    df = queries.QUERIES[name](spark, SF)
    assert rows_of(df.columns, map(tuple, df.collect())) == want and want[1]


def best(unit, model):
    """The segmentation of the greatest sum of scores, of all there are."""
    found = []
    for cuts in itertools.product((False, True), repeat=len(unit) - 1):
        ends = [i + 1 for i, c in enumerate(cuts) if c] + [len(unit)]
        parts = [unit[a:b] for a, b in zip([0, *ends], ends, strict=False)]
        if all(p in model.pieces or len(p) == 1 for p in parts):
            found.append((sum(model.pieces[p][1] if p in model.pieces else model.unknown for p in parts), parts))
    top = max(s for s, _ in found)
    return [p for s, p in found if s == top]


def test_paths_have_the_greatest_sum(spark):
    model = pieces.by_score(pieces.load(MODEL))
    r = random.Random(3)
    texts = ["".join(r.choices("etaoin 12é中", k=r.randint(0, 9))) for _ in range(150)] + ["the cat", "e" * 70, "", None]
    got = {x["doc_id"]: x["ids"] for x in pieces.encode(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3), model).collect()}

    def ids(parts):
        return [i for p in parts for i in ([model.pieces[p][0]] if p in model.pieces else [model.byte_ids[b] for b in p.encode()])]

    for i, t in enumerate(texts):
        choices = [[ids(p) for p in best(u, model)] for u in model.units_of(t or "") if len(u) <= 12]
        if all(len(u) <= 12 for u in model.units_of(t or "")):
            assert any(got[i] == [x for part in way for x in part] for way in itertools.product(*choices)), t
    assert got[151] == [x for u in model.units_of("e" * 70) for x in pieces.best_path(u, model)]


def test_paths_of_the_query(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    got = {r["doc_id"]: r["n_pieces"] for r in queries.sentencepiece_paths(spark, SF).collect()}
    model = pieces.by_score(pieces.load(MODEL))
    for r in docs.limit(20).collect():
        assert got[r["doc_id"]] == sum(len(pieces.best_path(u, model)) for u in model.units_of(r["text"]))
    assert len(got) == docs.count()


def test_paths_of_many_units_at_a_time(spark):
    """Viterbi goes over batches of units in arrays, not step by step through each as an expression; with the same paths."""
    model = pieces.by_score(pieces.load(MODEL))
    r = random.Random(8)
    units = sorted({"".join(r.choices("etaoinshr▁12é中\U0001f600", k=r.choice([1, 2, 5, 15, 62]))) for _ in range(600)} | {"▁", "e" * 62, "\U0001f600" * 62})
    found = pieces.lattice(spark.createDataFrame([(u,) for u in [*units, "e" * 63, ""]], "unit string").repartition(2, "unit"), spark, model)
    assert "aggregate(" not in found._jdf.queryExecution().optimizedPlan().toString()
    got = {x["unit"]: x["ids"] for x in found.collect()}
    assert got.keys() == set(units)
    for u in units:
        assert got[u] == pieces.best_path(u, model), u
    assert pieces.lattice(spark.createDataFrame([], "unit string"), spark, model).count() == 0
