"""Toxicity by a sparse linear classifier whose scores don't change when a sentence speaks of another group.

Features are the 4- to 7-grams of lower-cased letters within words, word ends marked, hashed to BUCKETS; a feature's value
is log(1 + its count). The FEATURES buckets that tell the labels apart most surely in training are kept. A logistic curve is
fitted to them with an L1 penalty, which leaves chance features without weight, so long clean texts don't gather evidence.

The counterfactual part: in labelled sentences that name a group (IDENTITY, a parameter), each term is swapped for another
of its list and for the list's first, which is neutral; FAIRNESS times the mean square of the change of the score is added
to the loss. A term that occurs with insults often can then carry no more weight than the neutral one, and the weight goes to the
insults: neutral mentions stay below the threshold.

It is trained in numpy on at most TRAIN_ROWS labelled rows, drawn by hash; scoring is one narrow pass over whole texts, in
blocks of bounded length. Null and empty texts have no features and get the score of their length, zero. Without both labels
in training every score is the share of label 1 (0.5 without labels).
"""

from __future__ import annotations

import math
import re
import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import labelled_sample
from .words import letter_codes

TRAIN_ROWS = 8_000
BITS = 21
BUCKETS = 1 << BITS
ORDERS = (4, 5, 6, 7)
TAIL = ORDERS[-1] - 1
FEATURES = 1 << 13
BLOCK_CHARS = 1 << 20
FAIRNESS, SPARSE, RIDGE, ROUNDS = 4.0, 2e-4, 1e-5, 400

# Fixed lists of terms for groups of people; the first of each list is neutral.
IDENTITY = tuple(
    tuple(line.split())
    for line in (
        "people women men girls boys mothers fathers",
        "person woman man girl boy mother father",
        "religious muslim christian jewish hindu buddhist catholic protestant sikh atheist",
        "believers muslims christians jews hindus buddhists catholics protestants sikhs atheists",
        "local black white asian african european american latino mexican indian chinese arab foreign",
        "citizens immigrants migrants refugees foreigners africans asians arabs mexicans indians",
        "ordinary gay lesbian bisexual transgender queer straight",
        "adult old young elderly teenage",
        "healthy disabled blind deaf autistic",
        "leute frauen männer muslime christen juden ausländer flüchtlinge schwule lesben behinderte",
        "gens femmes hommes musulmans chrétiens juifs immigrés réfugiés homosexuels lesbiennes handicapés",
        "gente mujeres hombres musulmanes cristianos judíos inmigrantes refugiados homosexuales lesbianas discapacitados",
    )
)

_SENTENCE = re.compile(r"(?<=[.!?])\s+|\n+")


def _grams(x: np.ndarray):
    """Buckets of the n-grams that begin at each place but the last TAIL, for each of ORDERS, and which of them count: those
    that no word's end divides."""
    n = len(x) - TAIL
    letter = x != 0
    h = x[:n] * np.uint32(0x9E3779B1) + np.uint32(7)
    inner = np.ones(n, dtype=bool)
    for k in range(1, ORDERS[-1]):
        h = (h ^ (h >> np.uint32(15))) * np.uint32(0x85EBCA6B) + x[k : n + k] * np.uint32(0xC2B2AE35) + np.uint32(k)
        if k + 1 in ORDERS:
            yield (h ^ (h >> np.uint32(13))) >> np.uint32(32 - BITS), inner
        inner = inner & letter[k : n + k]


def counted(texts: list[str], place: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(text, feature, count) of the features that occur, where `place` numbers the buckets that are features (others: -1);
    and the number of letters and word ends of each text."""
    x, starts = letter_codes(texts, TAIL)
    found, width = [np.zeros(0, dtype=np.int64)], int(place.max(initial=-1)) + 1
    for at in range(0, len(x) - TAIL, BLOCK_CHARS):
        block = x[at : at + BLOCK_CHARS + TAIL]
        for bucket, valid in _grams(block):
            own = np.where(valid, place[bucket], -1)
            where = np.flatnonzero(own >= 0)
            found.append((np.searchsorted(starts, where + at, "right") - 1) * width + own[where])
    keys, count = np.unique(np.concatenate(found), return_counts=True)
    return *np.divmod(keys, max(1, width)), count, np.diff(starts)


@dataclass(frozen=True)
class Rows:
    """A sparse matrix: values at (row, column), and one more column, dense: the logarithm of each text's length."""

    row: np.ndarray
    column: np.ndarray
    value: np.ndarray
    long: np.ndarray

    def times(self, w: np.ndarray) -> np.ndarray:
        return np.bincount(self.row, weights=self.value * w[self.column], minlength=len(self.long)) + self.long * w[-1]

    def turned(self, r: np.ndarray, width: int) -> np.ndarray:
        out = np.bincount(self.column, weights=self.value * r[self.row], minlength=width)
        out[-1] += self.long @ r
        return out


def _rows(texts: list[str], place: np.ndarray) -> Rows:
    parts, long, first = [], [], 0
    for at in range(0, len(texts), 256):
        text, feature, count, size = counted(texts[at : at + 256], place)
        parts.append((text + first, feature, np.log1p(count)))
        long.append(np.log1p(size) / 10)
        first += len(size)
    if not parts:
        return Rows(*(np.zeros(0, dtype=k) for k in (np.int64, np.int64, float, float)))
    return Rows(*(np.concatenate([p[k] for p in parts]) for k in range(3)), np.concatenate(long))


@dataclass(frozen=True)
class Model:
    place: np.ndarray  # of each bucket: its feature's number, or -1
    weight: np.ndarray  # of each feature; one more, of a text's length
    shift: float


def swapped(text: str, identity: tuple[tuple[str, ...], ...] = IDENTITY) -> list[tuple[str, str]]:
    """Sentences of a text that name a group, each with its terms swapped: for others of their lists, drawn by the
    sentence's hash, and for the neutral ones."""
    lists = {term: terms for terms in identity for term in terms[1:]}
    out = []
    for sentence in _SENTENCE.split(text):
        words = re.split(r"([^\W\d_]+)", sentence)
        named = [i for i in range(1, len(words), 2) if words[i].lower() in lists]
        if named:
            for neutral in (False, True):
                other = list(words)
                for i in named:
                    term, terms = words[i].lower(), lists[words[i].lower()]
                    rest = [t for t in terms[1:] if t != term]
                    other[i] = terms[0] if neutral or not rest else rest[zlib.crc32(f"{i} {sentence}".encode()) % len(rest)]
                out.append((sentence, "".join(other)))
    return out


def _chosen(texts: list[str], labels: np.ndarray) -> np.ndarray:
    """Numbers of the buckets whose presence tells the labels apart most surely: by log odds over their standard error."""
    every = np.arange(BUCKETS, dtype=np.int32)
    present = np.zeros((2, BUCKETS))
    for at in range(0, len(texts), 256):
        text, bucket, _, _ = counted(texts[at : at + 256], every)
        for k in (0, 1):
            present[k] += np.bincount(bucket[labels[at : at + 256][text] == k], minlength=BUCKETS)
    size = np.array([(labels == 0).sum(), (labels == 1).sum()])[:, None]
    odds = np.log(present + 0.5) - np.log(size - present + 0.5)
    sure = np.abs(odds[1] - odds[0]) / np.sqrt((1 / (present + 0.5) + 1 / (size - present + 0.5)).sum(axis=0))
    sure[present.sum(axis=0) < 2] = 0
    best = np.argsort(-sure, kind="stable")[:FEATURES]
    best = np.sort(best[sure[best] > 0])
    place = np.full(BUCKETS, -1, dtype=np.int16)
    place[best] = np.arange(len(best))
    return place


def fit_texts(rows: list[tuple[str, int]], identity: tuple[tuple[str, ...], ...] = IDENTITY, fairness: float = FAIRNESS) -> Model:
    labels = np.array([y for _, y in rows], dtype=np.int64)
    ones, n = int(labels.sum()), len(labels)
    if not 0 < ones < n:
        return Model(np.full(BUCKETS, -1, dtype=np.int16), np.zeros(1), math.log((ones + 0.5) / (n - ones + 0.5)))
    texts = [t for t, _ in rows]
    place = _chosen(texts, labels)
    x = _rows(texts, place)
    pairs = [p for t in texts for p in swapped(t, identity)]
    a, b = (_rows([p[k] for p in pairs], place) for k in (0, 1))
    d = Rows(np.concatenate([a.row, b.row]), np.concatenate([a.column, b.column]), np.concatenate([a.value, -b.value]), a.long - b.long)
    width = int(place.max(initial=-1)) + 2

    def slope(w: np.ndarray, shift: float) -> tuple[np.ndarray, float]:
        wrong = 1 / (1 + np.exp(-np.clip(x.times(w) + shift, -30, 30))) - labels
        out = x.turned(wrong, width) / n + RIDGE * w
        if pairs:
            out += 2 * fairness / len(pairs) * d.turned(d.times(w), width)
        return out, float(wrong.mean())

    # Steps by the greatest curvature, found by power iteration.
    v, top = np.full(width, 1 / math.sqrt(width)), 1.0
    for _ in range(30):
        u = x.turned(x.times(v), width) / (4 * n) + (2 * fairness / len(pairs) * d.turned(d.times(v), width) if pairs else 0)
        top = float(np.linalg.norm(u)) or 1.0
        v = u / top
    step = 1 / (1.1 * top + 0.25 + RIDGE)
    w, shift = np.zeros(width), math.log(ones / (n - ones))
    ahead, ahead_shift, t = w, shift, 1.0
    for _ in range(ROUNDS):
        g, g0 = slope(ahead, ahead_shift)
        new = ahead - step * g
        new[:-1] = np.sign(new[:-1]) * np.maximum(np.abs(new[:-1]) - step * SPARSE, 0)
        new_shift = ahead_shift - step * g0
        after = (1 + math.sqrt(1 + 4 * t * t)) / 2
        ahead, ahead_shift = new + (t - 1) / after * (new - w), new_shift + (t - 1) / after * (new_shift - shift)
        w, shift, t = new, new_shift, after
    # Features without weight are left out.
    some = np.flatnonzero(w[:-1])
    number = np.full(width, -1, dtype=np.int16)
    number[some] = np.arange(len(some))
    return Model(number[place], np.append(w[some], w[-1]), shift)


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", rows: int = TRAIN_ROWS, identity: tuple[tuple[str, ...], ...] = IDENTITY) -> Model:
    """Model from labelled rows of docs; `labels` has ids with labels 0 and 1 (others and nulls are left out)."""
    got = labelled_sample(docs, labels, label_col, rows, id_col, text_col)
    return fit_texts(sorted((r["text"], r["__label"]) for r in got), identity)


def scores(texts: list[str], model: Model) -> np.ndarray:
    text, feature, count, size = counted(texts, model.place)
    z = np.bincount(text, weights=np.log1p(count) * model.weight[feature], minlength=len(texts)) + model.weight[-1] * np.log1p(size) / 10 + model.shift
    return 1 / (1 + np.exp(-np.clip(z, -500, 500)))


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Rows (id, score, predicted), one for each row of docs."""
    kind = docs.select(id_col).schema[0].dataType.simpleString()
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        for batch in batches:
            at = 0
            while at < batch.num_rows:
                texts, size = [], 0
                while at + len(texts) < batch.num_rows and size < BLOCK_CHARS and len(texts) < 1024:
                    texts.append(batch.column(1)[at + len(texts)].as_py() or "")
                    size += len(texts[-1])
                p = scores(texts, sent.value)
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(at, len(texts)), pa.array(p, pa.float64()), pa.array((p >= 0.5).astype(np.int32))], names=[id_col, "score", "predicted"])
                at += len(texts)

    return docs.select(id_col, text_col).mapInArrow(run, f"`{id_col}` {kind}, score double, predicted int")
