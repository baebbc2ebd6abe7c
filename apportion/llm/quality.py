"""Quality by compression: a text that packs better with a dictionary of good texts than with one of bad texts is good.

Two zstandard dictionaries are trained from labelled texts, one for each label. A text's evidence is the difference of
its two compressed sizes divided by the square root of its length (the size of a chance difference grows so); a
logistic fit on labelled texts that the dictionaries have not seen turns it into a score between 0 and 1. Training is
on at most TRAIN_ROWS labelled rows, chosen by hash; scoring is one narrow pass with two compressors in each task.

Null and empty texts have no evidence and get the score of difference zero. Without both labels in training, every
score is the share of label 1 (0.5 if there are no labels at all).
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import labelled_sample, text_batches

TRAIN_ROWS = 4_000
DICTIONARY_BYTES = 112_000
LEVEL = 3


@dataclass(frozen=True)
class Model:
    good: bytes
    bad: bytes
    slope: float
    shift: float


def _compressors(good: bytes, bad: bytes):
    import zstandard

    out = []
    for data in (good, bad):
        held = zstandard.ZstdCompressionDict(data)
        held.precompute_compress(level=LEVEL)
        out.append(zstandard.ZstdCompressor(level=LEVEL, dict_data=held, write_content_size=False, write_checksum=False, write_dict_id=False))
    return out


def _evidence(compressors, raw: bytes) -> float:
    if not raw:
        return 0.0
    good, bad = (len(c.compress(raw)) for c in compressors)
    return (bad - good) / math.sqrt(len(raw) + 100)


def _dictionary(texts: list[bytes]) -> bytes:
    import zstandard

    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, texts).as_bytes()
    except zstandard.ZstdError:  # too few texts to train from: their own bytes serve
        return b"\n".join(texts)[-DICTIONARY_BYTES:] or b"\n"


def _logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1e-3) -> tuple[float, float]:
    """Slope and shift of the most likely logistic curve, by Newton's method with a small ridge."""
    scale = float(np.std(x)) or 1.0
    a = np.column_stack([x / scale, np.ones(len(x))])
    w = np.zeros(2)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(a @ w, -30, 30)))
        step = np.linalg.solve(a.T @ (a * (p * (1 - p))[:, None]) + ridge * np.eye(2), a.T @ (y - p) - ridge * w)
        w += np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-9:
            break
    return float(w[0] / scale), float(w[1])


def fit_texts(rows: list[tuple[str, int]]) -> Model:
    """Two thirds of the rows, of each label, make the dictionaries; the others the calibration."""
    by = {k: [t.encode() for t, y in rows if y == k and t] for k in (0, 1)}
    if not by[0] or not by[1]:
        n0, n1 = len(by[0]), len(by[1])
        return Model(b"", b"", 0.0, math.log((n1 + 0.5) / (n0 + 0.5)))
    seen = {k: v[: max(1, 2 * len(v) // 3)] for k, v in by.items()}
    rest = {k: v[len(seen[k]) :] or v for k, v in by.items()}
    good, bad = _dictionary(seen[1]), _dictionary(seen[0])
    both = _compressors(good, bad)
    x = np.array([_evidence(both, t) for k in (0, 1) for t in rest[k]])
    slope, shift = _logistic(x, np.array([k for k in (0, 1) for _ in rest[k]], dtype=float))
    return Model(good, bad, max(slope, 0.0), shift)


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality", rows: int = TRAIN_ROWS) -> Model:
    """Model from labelled rows of docs; `labels` has ids with labels 0 and 1 (others and nulls are left out).

    Of labels and of texts at most `rows` are drawn, each text of at most LONGEST characters, however often an id occurs.
    """
    got = labelled_sample(docs, labels, label_col, rows, id_col, text_col)
    got.sort(key=lambda r: (hash_order(r["__id"]), r["__label"], r["text"] or ""))
    return fit_texts([(r["text"] or "", int(r["__label"])) for r in got])


def hash_order(x) -> int:
    import zlib

    return zlib.crc32(str(x).encode()[::-1])


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Rows (id, score, predicted), one for each row of docs."""
    id_type = docs.select(id_col).schema[0]
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        m = sent.value
        both = _compressors(m.good, m.bad) if m.slope else None
        for part, texts in text_batches(batches):
            x = [m.slope * _evidence(both, t.encode()) + m.shift if both else m.shift for t in texts]
            p = [1 / (1 + math.exp(-max(-500.0, min(500.0, v)))) for v in x]
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array(p, pa.float64()), pa.array([int(v >= 0.5) for v in p], pa.int32())], names=[id_col, "score", "predicted"])

    return docs.select(id_col, F.col(text_col).alias("text")).mapInArrow(run, f"`{id_col}` {id_type.dataType.simpleString()}, score double, predicted int")
