"""Language-model scores against a plain count of the same model."""

import math
import random
import tracemalloc
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from apportion.llm import ngram
from apportion.llm.packed import growth, pack, pack_numbered, pack_sorted, unpack, unpack_numbered, unpack_sorted


def plain(rows):
    """Scores of (id, text, train) rows by counting everything in one place, with the operator's own EM."""
    toks = {i: [*(t or "").encode().lower().split(), b"\n"] for i, t, _ in rows}
    uni, bi = Counter(), Counter()
    for i, _, train in rows:
        if train:
            uni.update(toks[i])
            bi.update(zip([b"\n", *toks[i]], toks[i]))
    total, distinct = sum(uni.values()), len(uni)

    def bucket(c):
        return min(math.frexp(c)[1], ngram.BUCKETS - 1)

    hist = [(bucket(uni[u]), k, k, n, n * math.log2((n - 1) / (uni[u] - 1)) if n > 1 else 0.0, n * math.log2((uni[w] - 1) / (total - 1)) if uni[w] > 1 else 0.0, n > 1, uni[w] > 1) for k, ((u, w), n) in enumerate(sorted(bi.items()))]
    weights = ngram.learn([(b, k if ok2 else -1, k if ok1 else -1, n, s2, s1) for b, k, _, n, s2, s1, ok2, ok1 in hist], distinct)
    out = {}
    for i, _, _ in rows:
        base = sum(math.log10((uni[w] + 0.5) / (total + 0.5 * (distinct + 1))) for w in toks[i])
        score = 0.0
        for u, w in zip([b"\n", *toks[i]], toks[i]):
            l2, l1, l0 = weights[bucket(uni[u])]
            score += math.log10((l2 * bi[u, w] / uni[u] if uni[u] else 0.0) + l1 * uni[w] / total + l0 / (distinct + 1))
        out[i] = (len(toks[i]), sum(uni[w] > 0 for w in toks[i]), total, base, score)
    return out


@pytest.mark.parametrize("changes", [{"ROW_CHARS": 1}, {"ROW_CHARS": 1 << 30, "GROUP_CHARS": 500}, {"ROW_CHARS": 1, "NARROW": 3, "GROUP_CHARS": 500}])
def test_scores_match_a_plain_count(spark, monkeypatch, changes):
    """Also where blocks deal in two levels, and where two ranks are more than a key of 64 bits."""
    monkeypatch.setattr(ngram, "BLOCK_CHARS", 400)
    for name, value in changes.items():
        monkeypatch.setattr(ngram, name, value)
    r = random.Random(5)
    words = [chr(97 + k % 26) * (1 + k // 26) for k in range(80)]
    rows = [(i, " ".join(r.choices(words, [1 / (k + 1) for k in range(80)], k=r.choice([0, 1, 5, 40]))).upper(), i % 4 != 1) for i in range(120)]
    rows += [(500, None, True), (501, None, False), (502, "unseen words only", False), (503, " \t\n", True), (504, "a " * 3000, True)]
    df = spark.createDataFrame(rows, "doc_id long, text string, train boolean").repartition(3)
    deal = ngram.Dealing.of(sum(len(t or "") for _, t, _ in rows), ngram.BLOCK_CHARS, ngram.GROUP_CHARS, ngram.ROW_CHARS)
    assert (deal.bunches > 1) == (ngram.ROW_CHARS > 1)
    got = {x["doc_id"]: tuple(x)[1:] for x in ngram.score(df, F.col("train")).collect()}
    want = plain(rows)
    assert got.keys() == want.keys()
    for i, w in want.items():
        assert got[i][:3] == w[:3]
        assert got[i][3] == pytest.approx(w[3], abs=1e-7)
        # EM sees estimates by bins, so weights agree closely rather than exactly.
        assert got[i][4] == pytest.approx(w[4], rel=2e-3, abs=1e-3)


def test_probabilities_sum_to_one():
    weights = ngram.learn([(3, 4, 8, 10.0, -10.0, -20.0), (5, -1, 9, 3.0, 0.0, -6.0)], 50)
    assert np.allclose(weights.sum(axis=1), 1)
    assert (weights[:, 1:] > 0).all()


def test_no_training_rows_and_no_rows(spark):
    df = spark.createDataFrame([(1, "a b"), (2, None)], "doc_id long, text string")
    got = sorted(tuple(x) for x in ngram.score(df, F.lit(False)).collect())
    assert [(x[0], x[1], x[2], x[3]) for x in got] == [(1, 3, 0, 0), (2, 1, 0, 0)]
    assert all(x[4] == 0 and x[5] == 0 for x in got)
    assert ngram.score(df.where("false"), F.lit(True)).count() == 0


def test_packed_numbers_come_back():
    r = np.random.default_rng(0)
    for x in (np.zeros(0, np.uint64), np.array([0], np.uint64), r.integers(0, 1 << 63, 1000, dtype=np.uint64), np.array([2**64 - 1, 0, 5], np.uint64)):
        assert (unpack(pack(x)) == x).all()
        assert (unpack_sorted(pack_sorted(np.sort(x))) == np.sort(x)).all()
    for seen in ([], [0], [0, 1, 0, 2, 2, 1, 3], list(range(300)) + [5, 299, 0]):
        assert unpack_numbered(pack_numbered(np.array(seen, dtype=np.int64))).tolist() == seen


def test_equal_blocks_keep_their_own_sums(spark, monkeypatch):
    monkeypatch.setattr(ngram, "BLOCK_CHARS", 4)
    rows = [(1, "a b a b", True), (2, "a c", False)]
    df = spark.createDataFrame(rows, "doc_id long, text string, train boolean").repartition(1)
    both = df.union(df)
    got = sorted(tuple(x) for x in ngram.score(both, F.col("train")).collect())
    want = plain([(k, t, f) for k, (_, t, f) in enumerate(rows + rows)])
    assert [x[0] for x in got] == [1, 1, 2, 2]
    for x in got:
        w = want[0 if x[0] == 1 else 1]
        assert x[1:4] == w[:3] and x[4] == pytest.approx(w[3], abs=1e-9) and x[5] == pytest.approx(w[4], rel=2e-3)


def test_blocks_that_were_read_differently_raise():
    counts, end = ngram._count_table([(2, 1), (1, 2)], 1)
    rows = {wanted: list(ngram._block_rows(7, [1, 2], ["a b", "a c"], [True, False], ngram.Dealing(100, 4), wanted)) for wanted in (0, 1)}
    text = dict(zip(("kind", "place", "block", "a", "b", "ids", "c"), next(r for r in rows[1] if r[0] == 1), strict=True))
    with pytest.raises(RuntimeError):  # no ranks for its words
        list(ngram._pair([text], counts, end, 4))
    with pytest.raises(RuntimeError):  # ranks for a block that is not there
        list(ngram._pair([{"block": 7, "a": b"", "c": b"", "ids": None}], counts, end, 4))


def test_null_and_repeated_ids_and_clashing_names(spark):
    df = spark.createDataFrame([(None, "a b", 1), (None, None, 2), (5, "a b", 3), (5, "b", 4)], "doc_id long, text string, score int").withColumn("train", F.lit(True))
    got = sorted((str(x["doc_id"]), x["n_tokens"]) for x in ngram.score(df, F.col("train")).collect())
    assert got == [("5", 2), ("5", 3), ("None", 1), ("None", 3)]


def test_rows_of_a_block_keep_their_size_as_the_input_grows():
    def words_in_a_row(chars):
        groups = max(8, -(-chars // (ngram.GROUP_CHARS * growth(chars, 4))))
        return ngram.BLOCK_CHARS * growth(chars, 8) / 6 / groups

    small = words_in_a_row(1 << 29)
    assert all(words_in_a_row((1 << 29) * k) > small / 2 for k in (1, 4, 10, 16, 30, 60))
    # Blocks and groups are as large as memory allows from 64 times that input on.
    assert growth(1 << 60, 8) == 8 and growth(0, 8) == 1


def test_rows_stay_long_at_any_size():
    for tera in (0.001, 0.03, 1, 10, 100):
        chars = int(tera * 1e12)
        deal = ngram.Dealing.of(chars, ngram.BLOCK_CHARS, ngram.GROUP_CHARS, ngram.ROW_CHARS)
        assert deal.row_chars(chars) >= ngram.ROW_CHARS and bool(deal.bunches) == (tera >= 1)


def test_sums_of_few_texts_and_of_many():
    score = np.zeros(10)
    for texts in ([], [0], [9], [0, 1, 2, 3], [2, 3, 9]):
        numbers, sums = ngram._sparse(np.array(texts, dtype=np.int64), np.arange(len(texts)) + 1.0)
        assert (numbers is None) == (2 * len(texts) >= (texts[-1] + 1 if texts else 0))
        ngram._add(score, {"texts": numbers, "sums": sums})
    assert score.tolist() == [2.0, 2.0, 4.0, 6.0, 0, 0, 0, 0, 0, 4.0]


def _text_rows(texts, words, r, n_blocks, deal):
    """Rows for _pair() of blocks of random texts, and the counts of their words."""
    made, counts = [], Counter()
    for block in range(n_blocks):
        own = [" ".join(r.choices(words, [1 / (k + 1) for k in range(len(words))], k=300)) for _ in range(texts)]
        train = [i % 4 != 1 for i in range(texts)]
        made.append((block, own, train))
        for t, f in zip(own, train, strict=True):
            counts.update(ngram._words_of(t) if f else [])
    ranked = {w: k for k, (w, _) in enumerate(counts.most_common())}
    table, end = ngram._count_table(sorted(Counter(counts.values()).items()), sum(f for *_, fs in made for f in fs))
    # The end's rank is the first of its level, so words of that level and below come after it.
    ranked = {w: k + (k >= end) for w, k in ranked.items()}
    rows = []
    for block, own, train in made:
        names = [x for x in ngram._block_rows(block, list(range(texts)), own, train, deal, 1)]
        seen: dict = {}
        for i in sorted(range(texts), key=lambda i: not train[i]):
            for w in ngram._words_of(own[i]):
                seen.setdefault(w, len(seen))
        answer = {"block": block, "a": pack(np.array([ranked.get(w, -1) + 1 for w in seen])), "b": None, "ids": None, "c": pack(np.arange(len(seen)))}
        rows.append([dict(zip(("kind", "place", "block", "a", "b", "ids", "c"), x, strict=True)) for x in names] + [answer])
    return rows, table, end


def test_memory_for_each_token_of_a_block_and_of_a_group(monkeypatch):
    """Numbers of a block's or a group's tokens take few bytes each, whatever their size; slices give the same sums."""
    r, deal = random.Random(7), ngram.Dealing(1 << 22, 1)
    blocks, counts, end = _text_rows(400, [f"w{k}" for k in range(20_000)], r, 6, deal)
    tokens = 400 * 301
    names = ("kind", "place", "block", "u", "w", "n", "texts", "n_train", "ids", "numbers", "lone")

    def peak(f):
        tracemalloc.start()
        out = f()
        found = tracemalloc.get_traced_memory()[1]
        tracemalloc.stop()
        return out, found

    _, used = peak(lambda: list(ngram._pair(blocks[0], counts, end, ngram.Dealing(1 << 22, 16))))
    assert used / tokens < 90
    rows = [dict(zip(names, x, strict=True)) for b in blocks for x in ngram._pair(b, counts, end, deal) if x[0] == 0]
    weights = ngram.learn([], counts.distinct)
    whole = ngram._group_sums(list(rows), counts, weights)
    histogram = [np.concatenate(x) for x in zip(*ngram._group_estimates(list(rows), counts), strict=True)]
    monkeypatch.setattr(ngram, "SLICE_TOKENS", tokens // 4)
    sliced, used = peak(lambda: ngram._group_sums(list(rows), counts, weights))
    assert used / (6 * tokens) < 30
    assert [x[:2] for x in sliced] == [x[:2] for x in whole]
    for x, y in zip(sliced, whole, strict=True):
        assert np.allclose(np.frombuffer(x[2]), np.frombuffer(y[2]), atol=1e-9)
    parts = [np.concatenate(x) for x in zip(*ngram._group_estimates(list(rows), counts), strict=True)]
    assert parts[3].sum() == histogram[3].sum() and len(parts[0]) > len(histogram[0])
    assert parts[4].sum() == pytest.approx(histogram[4].sum()) and parts[5].sum() == pytest.approx(histogram[5].sum())


def test_scores_by_slices_match_a_plain_count(spark, monkeypatch):
    monkeypatch.setattr(ngram, "SLICE_TOKENS", 7)
    r = random.Random(9)
    rows = [(i, " ".join(r.choices("abcdefgh", k=r.choice([0, 1, 30]))), i % 4 != 1) for i in range(60)]
    got = {x["doc_id"]: tuple(x)[1:] for x in ngram.score(spark.createDataFrame(rows, "doc_id long, text string, train boolean").repartition(2), F.col("train")).collect()}
    for i, w in plain(rows).items():
        assert got[i][:3] == w[:3] and got[i][3] == pytest.approx(w[3], abs=1e-7) and got[i][4] == pytest.approx(w[4], rel=2e-3, abs=1e-3)
