"""Language ID: the average of hashed subword embeddings goes through a linear softmax, as in fast text classifiers.

Subwords are the 2- to 4-grams of lower-cased letters within words, word ends marked, hashed to BUCKETS embeddings.
Embeddings and softmax are trained by stochastic gradient descent in numpy on at most TRAIN_ROWS documents, chosen by
hash; a part of them that training doesn't see sets the temperature and the threshold of rejection. As the model is
linear in the average, each bucket's embedding is multiplied by the softmax weights once, and a text's logits are the
mean of its subwords' rows; texts are scored in blocks of bounded length, whole, in one narrow pass.

Null texts and texts without letters are `und` with score 0, and rejected. So is everything if no row has a language.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import bounded_sample
from .words import letter_codes

TRAIN_ROWS = 6_000
BITS, WIDTH, EPOCHS, RATE = 16, 16, 6, 1.0
BUCKETS = 1 << BITS
BLOCK_CHARS = 1 << 20
KEEP = 0.999
"""Share of correctly labelled calibration rows that the threshold of rejection must keep."""


def _grams(x: np.ndarray):
    """Buckets of the 2-, 3- and 4-grams that begin at each place but the last three, and which of them count."""
    n = len(x) - 3
    letter = x != 0
    h = x[:n] * np.uint32(0x9E3779B1) + np.uint32(7)
    inner = np.ones(n, dtype=bool)
    for k in (1, 2, 3):
        h = (h ^ (h >> np.uint32(15))) * np.uint32(0x85EBCA6B) + x[k : n + k] * np.uint32(0xC2B2AE35) + np.uint32(k)
        valid = (letter[:n] | letter[1 : n + 1]) if k == 1 else inner
        yield (h ^ (h >> np.uint32(13))) >> np.uint32(32 - BITS), valid
        inner = inner & letter[k : n + k]


def subwords(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Distinct buckets of a text, and each one's share of its subwords."""
    x, _ = letter_codes([text], 3)
    found = [b[v] for b, v in _grams(x)]
    ids, counts = np.unique(np.concatenate(found), return_counts=True)
    return ids, (counts / max(1, counts.sum())).astype(np.float32)


@dataclass(frozen=True)
class Model:
    langs: tuple[str, ...]
    table: np.ndarray  # logits of each bucket; one more row of zeros
    temperature: float
    threshold: float


def _softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


def fit_texts(rows: list[tuple[str, str]], seed: int = 0) -> Model:
    rng = np.random.default_rng(seed)
    langs = tuple(sorted({lang for _, lang in rows}))
    if not langs:
        return Model((), np.zeros((BUCKETS + 1, 0), np.float32), 1.0, 1.0)
    data = [(*subwords(t), langs.index(lang)) for t, lang in rows]
    data = [d for d in data if len(d[0])]
    order = rng.permutation(len(data))
    held, used = order[: len(data) // 5], order[len(data) // 5 :]
    e = rng.uniform(-1 / WIDTH, 1 / WIDTH, (BUCKETS, WIDTH)).astype(np.float32)
    w = np.zeros((WIDTH, len(langs)), dtype=np.float32)
    steps, step = max(1, EPOCHS * len(used)), 0
    for _ in range(EPOCHS):
        for i in rng.permutation(used):
            ids, share, y = data[i]
            rate = np.float32(RATE * (1 - step / steps))
            step += 1
            h = share @ e[ids]
            g = _softmax(h @ w)
            g[y] -= 1
            back = w @ g
            w -= rate * np.outer(h, g)
            e[ids] -= rate * len(langs) * share[:, None] * back[None, :]
    table = np.zeros((BUCKETS + 1, len(langs)), dtype=np.float32)
    table[:-1] = e @ w
    temperature, threshold = 1.0, 0.0
    if len(held) and len(langs) > 1:
        z = np.array([data[i][1] @ table[data[i][0]] for i in held], dtype=np.float64)
        y = np.array([data[i][2] for i in held])
        grid = np.geomspace(0.05, 20, 61)
        temperature = float(min(grid, key=lambda t: -np.log(_softmax(z / t)[np.arange(len(y)), y] + 1e-12).mean()))
        p = _softmax(z / temperature)
        right = p.max(axis=1)[p.argmax(axis=1) == y]
        threshold = min(0.5, float(np.quantile(right, 1 - KEEP))) if len(right) else 0.0
    return Model(langs, table, temperature, threshold)


def fit(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", rows: int = TRAIN_ROWS) -> Model:
    """Model from the rows of docs with a text and a language, at most `rows` of them, drawn by a hash of the row."""
    own = docs.where(F.col(lang_col).isNotNull()).select(F.col(text_col).alias("text"), F.col(lang_col).alias("__lang"))
    chosen = bounded_sample(own, rows).collect()
    return fit_texts(sorted((r["text"], r["__lang"]) for r in chosen))


def logits(texts: list[str], model: Model) -> tuple[np.ndarray, np.ndarray]:
    """Mean logits of each text, and its number of subwords."""
    x, starts = letter_codes(texts, 3)
    total, count = np.zeros((len(texts), len(model.langs))), np.zeros(len(texts), dtype=np.int64)
    for at in range(0, len(x) - 3, BLOCK_CHARS):
        block = x[at : at + BLOCK_CHARS + 3]
        first = int(np.searchsorted(starts, at, "right")) - 1
        last = int(np.searchsorted(starts, min(at + BLOCK_CHARS, len(x) - 3), "left"))
        cuts = np.maximum(starts[first:last] - at, 0)
        for ids, valid in _grams(block):
            total[first:last] += np.add.reduceat(model.table[np.where(valid, ids, BUCKETS)], cuts, axis=0)
            count[first:last] += np.add.reduceat(valid.astype(np.int64), cuts)
    return total / np.maximum(count, 1)[:, None], count


def predict(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Rows (id, lang_pred, score, rejected), one for each row of docs; rejected rows keep their best language, or `und`."""
    kept = docs.select(id_col, F.col(text_col).alias("text"))
    return kept.mapInArrow(_predictor(docs, model, keep=[id_col]), f"`{id_col}` {kept.schema[0].dataType.simpleString()}, lang_pred string, score double, rejected boolean")


def accepted(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """Rows of docs that the model doesn't reject, with all their columns; decided in place, without a join."""
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema)
    return docs.mapInArrow(_predictor(docs, model, keep=docs.columns, text_col=text_col, drop=True), schema)


def _predictor(docs: DataFrame, model: Model, keep: list[str], text_col: str = "text", drop: bool = False):
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        m = sent.value
        names = np.array([*m.langs, "und"], dtype=object)
        for batch in batches:
            column = batch.column(text_col)
            at = 0
            while at < batch.num_rows:
                texts, size = [], 0
                while at + len(texts) < batch.num_rows and size < BLOCK_CHARS and len(texts) < 1024:
                    texts.append(column[at + len(texts)].as_py() or "")
                    size += len(texts[-1])
                part = batch.slice(at, len(texts))
                at += len(texts)
                z, n = logits(texts, m)
                known = (n > 0) & (len(m.langs) > 0)
                if m.langs:
                    p = _softmax(z / m.temperature)
                    best, top = np.where(known, p.argmax(axis=1), -1), np.where(known, p.max(axis=1), 0.0)
                else:
                    best, top = np.full(len(texts), -1), np.zeros(len(texts))
                rejected = ~known | (top < m.threshold)
                if drop:
                    yield pa.RecordBatch.from_arrays([part.column(c) for c in keep], names=keep).filter(pa.array(~rejected))
                else:
                    yield pa.RecordBatch.from_arrays([*(part.column(c) for c in keep), pa.array(names[best].tolist(), pa.string()), pa.array(top, pa.float64()), pa.array(rejected, pa.bool_())], names=[*keep, "lang_pred", "score", "rejected"])

    return run
