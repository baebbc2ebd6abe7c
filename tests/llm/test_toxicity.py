"""The toxicity classifier: what it learns, what swaps of identity terms do, and odd rows."""

import random

import numpy as np
import pytest

from apportion.llm import queries, toxicity

INSULTS = "idiot moron pathetic worthless".split()
WORDS = "the a house river walked long day table green under market spoke quiet letter garden seven".split()
NAMED = "women muslims gay immigrants jews".split()


def sentences(n, seed):
    """Insults make a text toxic. Groups are named in six of ten toxic texts and in one of twenty others."""
    r = random.Random(seed)
    out = []
    for k in range(n):
        toxic = int(k % 4 == 0)
        words = r.choices(WORDS, k=r.randrange(8, 30))
        # An insult of the training set is no sure sign, so that the terms are worth weight.
        words += [r.choice(INSULTS)] if toxic and r.random() < 0.7 or not toxic and r.random() < 0.04 else []
        words += [r.choice(NAMED)] if r.random() < (0.6 if toxic else 0.05) else []
        r.shuffle(words)
        out.append((" ".join(words) + ".", toxic))
    return out


def test_swaps_lower_false_positives_on_neutral_mentions():
    train, r = sentences(1_600, 1), random.Random(3)
    neutral = [" ".join([*(own := r.choices(WORDS, k=12))[:6], r.choice(NAMED), *own[6:]]) + "." for _ in range(200)]
    fair, plain = (toxicity.fit_texts(train, fairness=x) for x in (toxicity.FAIRNESS, 0.0))
    wrong = [(toxicity.scores(neutral, m) >= 0.5).mean() for m in (fair, plain)]
    assert wrong[1] > 0.3 and wrong[0] < 0.05

    def change(m):
        pairs = [p for t in neutral for p in toxicity.swapped(t)]
        return np.abs(toxicity.scores([a for a, _ in pairs], m) - toxicity.scores([b for _, b in pairs], m)).mean()

    assert change(fair) < change(plain) / 3
    insulted = [t.replace(".", f" {r.choice(INSULTS)}.") for t in neutral]
    assert (toxicity.scores(insulted, fair) >= 0.5).mean() > 0.9


def test_swapped():
    pairs = toxicity.swapped("Two Muslims met. Nobody else did!\nThe gay man spoke")
    assert [a for a, _ in pairs] == ["Two Muslims met."] * 2 + ["The gay man spoke"] * 2
    assert pairs[1][1] == "Two believers met." and pairs[3][1] == "The ordinary person spoke"
    assert "Muslims" not in pairs[0][1] and pairs[0][1].startswith("Two ") and pairs[0][1].endswith(" met.")
    assert toxicity.swapped("") == [] and toxicity.swapped("people walked") == []


def test_counts_do_not_depend_on_blocks(monkeypatch):
    r = random.Random(2)
    texts = ["", "idiot", *(" ".join(r.choices([*WORDS, *INSULTS, "É"], k=r.randrange(200))) for _ in range(20)), "idiot " * 500]
    place = np.arange(toxicity.BUCKETS, dtype=np.int32)
    want = toxicity.counted(texts, place)
    # By hand: every gram of 4 to 7 marked letters that no end of a word divides.
    import re

    grams = [sum(max(0, len(w) + 2 - n + 1) for w in re.findall(r"[^\W\d_]+", t) for n in toxicity.ORDERS) for t in texts]
    assert np.array_equal(np.bincount(want[0], weights=want[2], minlength=len(texts)), grams)
    for size in (7, 64):
        monkeypatch.setattr(toxicity, "BLOCK_CHARS", size)
        assert all(np.array_equal(a, b) for a, b in zip(toxicity.counted(texts, place), want, strict=True))


def test_the_minimum_is_one(monkeypatch):
    """The fit is at a minimum of its loss: more rounds don't change scores."""
    train = sentences(300, 5)
    a = toxicity.fit_texts(train)
    monkeypatch.setattr(toxicity, "ROUNDS", 1_600)
    b = toxicity.fit_texts(train)
    texts = [t for t, _ in train]
    assert np.abs(toxicity.scores(texts, a) - toxicity.scores(texts, b)).max() < 0.05


def test_rows(spark):
    train = sentences(400, 7)
    docs = [(k, t) for k, (t, _) in enumerate(train)] + [(None, None), (None, "you pathetic idiot"), (900, ""), (901, "x" * 200_000), (5, "a moron"), (902, "1 2 3")]
    df = spark.createDataFrame([(*d, "s", 9) for d in docs], "doc_id long, text string, score string, __label int")
    labels = spark.createDataFrame([(k, y) for k, (_, y) in enumerate(train)] + [(900, None), (None, 1), (5, 7), (12_345, 1)], "doc_id long, toxic int")
    a, b = (toxicity.fit(df.repartition(n), labels.repartition(n)) for n in (1, 7))
    assert np.array_equal(a.weight, b.weight) and a.shift == b.shift
    got = toxicity.score(df, a).collect()
    assert sorted(str(r["doc_id"]) for r in got) == sorted(str(i) for i, _ in docs)
    assert all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.5) for r in got)
    assert [r["predicted"] for r in got if r["doc_id"] in (900, 902)] == [0, 0]
    assert toxicity.score(df.where("false"), a).count() == 0


@pytest.mark.parametrize("kept,score", [("false", 0.5), ("toxic = 1", 2.5 / 3)])
def test_without_both_labels(spark, kept, score):
    docs = spark.createDataFrame([(1, "a"), (2, "b"), (3, None)], "doc_id long, text string")
    labels = spark.createDataFrame([(1, 1), (2, 1), (3, 0)], "doc_id long, toxic int").where(kept)
    got = toxicity.score(docs, toxicity.fit(docs, labels)).collect()
    assert {round(r["score"], 9) for r in got} == {round(score, 9)}


def test_held_out_accuracy_of_the_query(spark):
    sf = "/root/testdata/sf0.01"
    truth = {r["doc_id"]: r["toxic"] for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    got = queries.op11_toxicity(spark, sf).collect()
    assert len(got) == spark.read.parquet(f"{sf}/documents.parquet").count()
    held = [r for r in got if r["held_out"] and r["doc_id"] in truth]
    assert sum(r["predicted"] == truth[r["doc_id"]] for r in held) >= 0.93 * len(held)
    assert sum(r["predicted"] for r in held if not truth[r["doc_id"]]) <= 0.02 * len(held)
