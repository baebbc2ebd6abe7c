"""Benchmark decontamination by greedy string tiling with running Karp-Rabin matching.

Documents and benchmark items are sequences of words (lower-cased A-Z, runs of bytes other than ASCII white space,
without punctuation at either end). Seeds are the Karp-Rabin hashes of MIN_MATCH consecutive words; a document and an
item that share a seed are tiled: the longest match of words that no tile covers yet is marked, again and again, until
none of MIN_MATCH words is left. The share of the item's words that tiles cover is its coverage, so passages whose
sentences were reordered are caught as well; a document with an item of coverage THRESHOLD or more is contaminated.

Tiling falls through the search lengths: the longest length that still has a match is found by halving, with the hashes
of all runs of a length computed anew for each length tried from running sums, in time proportional to the words. All
matches of that length are marked, then shorter ones are sought. There are at most about sqrt(2 n) lengths for an item
of n words, and a length's matches are walked once, so repetitive texts cost no more than others.

The benchmark goes to the tasks while it has at most BROADCAST_CHARS characters, and each document is then tiled in
place, without a shuffle. A larger benchmark is joined by seed: distinct document seeds meet the benchmark's seeds in an
equi-join, salted so that a seed which many documents hold is dealt to several tasks, and each document and item that
met are tiled. Both ways give the same rows.

Items with fewer than MIN_MATCH words are matched whole (their seed is all their words). Items without words match
nothing, and neither do null or empty documents. Ids of documents and items may be of any type, null or repeated: each
row of either table keeps its own rows.
"""

from __future__ import annotations

from collections import defaultdict, deque

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from .common import fresh, text_batches

MIN_MATCH = 5
THRESHOLD = 0.8
BROADCAST_CHARS = 16_000_000
EDGES = b"\"'.,;:!?()[]{}<>*_|"

SALTS = 16
"""Parts that the documents of one seed are dealt to, where seeds are joined."""

COUNTS = "tiles: int, matched: int, n_words: int, coverage: double"

BASE = np.uint64(0x9E3779B97F4A7C15)


def words(text: str) -> list[bytes]:
    return [w for w in (x.strip(EDGES) for x in text.encode().lower().split()) if w]


_INVERSE = np.uint64(pow(int(BASE), -1, 1 << 64))


class Running:
    """Karp-Rabin hashes, modulo 2^64, of the runs of any length of a sequence of numbers, from running sums."""

    def __init__(self, ids: np.ndarray):
        self.ids = ids.astype(np.uint64)
        n = len(ids)
        up, down = np.full(n + 1, BASE, dtype=np.uint64), np.full(n + 1, _INVERSE, dtype=np.uint64)
        up[0] = down[0] = 1
        self.down = np.cumprod(down)
        self.sums = np.concatenate((np.zeros(1, dtype=np.uint64), np.cumsum(self.ids * np.cumprod(up)[:n])))

    def of(self, k: int) -> np.ndarray:
        n = len(self.ids) - k + 1
        return (self.sums[k:] - self.sums[:-k]) * self.down[:n] if n > 0 else np.zeros(0, dtype=np.uint64)


def rolling(ids: np.ndarray, k: int) -> np.ndarray:
    """Karp-Rabin hash, modulo 2^64, of each run of k numbers."""
    return Running(ids).of(k)


def _free_runs(blocked: np.ndarray, k: int) -> np.ndarray:
    """Where runs of k numbers begin that hold no blocked one."""
    sums = np.concatenate(([0], np.cumsum(blocked)))
    return np.flatnonzero(sums[k:] == sums[:-k]) if len(blocked) >= k else np.zeros(0, dtype=np.int64)


def tile(doc: np.ndarray, item: np.ndarray, shortest: int) -> list[tuple[int, int, int]]:
    """Tiles (length, place in doc, place in item) of greedy string tiling; numbers below 0 match nothing.

    Of matches of equal length the one first in doc, then in item, is marked first.
    """
    shortest = max(1, min(shortest, len(item)))
    if len(doc) < shortest or not len(item):
        return []
    a, b = Running(doc), Running(item)
    used_a, used_b = doc < 0, item < 0
    tiles: list[tuple[int, int, int]] = []

    def common(k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        at_a, at_b = _free_runs(used_a, k), _free_runs(used_b, k)
        h_a, h_b = a.of(k)[at_a], b.of(k)[at_b]
        at_a, at_b = at_a[near := np.isin(h_a, h_b)], at_b[far := np.isin(h_b, h_a)]
        return at_a, h_a[near], at_b, h_b[far]

    longest = min(len(doc), len(item))
    while longest >= shortest:
        low, high = shortest - 1, longest
        while low < high:
            k = (low + high + 1) // 2
            low, high = (k, high) if len(common(k)[0]) else (low, k - 1)
        if low < shortest:
            break
        at_a, h_a, at_b, h_b = common(low)
        places = defaultdict(deque)
        for j, h in zip(at_b.tolist(), h_b.tolist(), strict=True):
            places[h].append(j)
        free = 0  # the doc is covered up to here by tiles of this length
        for i, h in zip(at_a.tolist(), h_a.tolist(), strict=True):
            own = places[h]
            while own and i >= free:
                j = own.popleft()  # marked now, or overlapped for good
                if not used_b[j : j + low].any() and (doc[i : i + low] == item[j : j + low]).all():
                    used_a[i : i + low] = used_b[j : j + low] = True
                    tiles.append((low, i, j))
                    free = i + low
        longest = low - 1
    return tiles


class Index:
    """Numbers of the benchmark's words, and which items have each seed."""

    def __init__(self, items: list[tuple[object, str]], shortest: int):
        self.shortest, self.number = shortest, {}
        self.items = []
        for item_id, text in items:
            own = words(text or "")
            self.items.append((item_id, np.array([self.number.setdefault(w, len(self.number) + 1) for w in own], dtype=np.int64)))
        by_length = defaultdict(lambda: defaultdict(set))
        for at, (_, ids) in enumerate(self.items):
            if len(ids):
                k = min(shortest, len(ids))
                for h in rolling(ids.astype(np.uint64), k).tolist():
                    by_length[k][h].add(at)
        self.seeds = [(k, np.sort(np.fromiter(v, dtype=np.uint64, count=len(v))), {h: tuple(s) for h, s in v.items()}) for k, v in by_length.items()]

    def matches(self, text: str) -> list[tuple[object, int, int, int, float]]:
        """(item_id, tiles, matched, n_words, coverage) of every item that shares a seed with the text, in the items' order."""
        get = self.number.get
        doc = np.array([get(w, 0) for w in words(text)], dtype=np.int64)
        doc[doc == 0] = -1
        # Only runs of known words can hold seeds.
        found: set[int] = set()
        for k, hashes, items in self.seeds:
            if len(doc) < k or not len(hashes):
                continue
            known = np.concatenate(([0], np.cumsum(doc > 0)))
            at = np.flatnonzero(known[k:] - known[:-k] == k)
            if not len(at):
                continue
            h = rolling(doc.astype(np.uint64), k)[at]
            place = np.minimum(np.searchsorted(hashes, h), len(hashes) - 1)
            for x in np.unique(h[hashes[place] == h]).tolist():
                found.update(items[x])
        out = []
        for at in sorted(found):
            item_id, ids = self.items[at]
            tiles = tile(doc, ids, self.shortest)
            if tiles:
                matched = sum(n for n, _, _ in tiles)
                out.append((item_id, len(tiles), matched, len(ids), matched / len(ids)))
        return out


def _items(benchmark: DataFrame, item_col: str, item_text: str) -> DataFrame:
    return benchmark.select(F.col(item_col).alias("item_id"), F.coalesce(F.col(item_text), F.lit("")).alias("text"))


def _matches(items: DataFrame) -> str:
    return f"item_id: {items.schema['item_id'].dataType.simpleString()}, {COUNTS}"


def overlaps(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text: str = "text", shortest: int = MIN_MATCH) -> DataFrame:
    """Rows (id, item_id, tiles, matched, n_words, coverage) for each document and item that share a seed."""
    items = _items(benchmark, item_col, item_text)
    kept = docs.select(F.struct(F.col(id_col).alias("id")).alias("__key"), F.col(text_col).alias("text"))
    if _bounded(items):
        found = kept.mapInArrow(_tiler(docs, items, shortest, ["__key"]), f"__key {kept.schema[0].dataType.simpleString()}, matches array<struct<{_matches(items)}>>")
        found = found.select("__key", F.explode("matches").alias("m"))
    else:
        found = _joined(kept, items, shortest)
    return found.select(F.col("__key.id").alias(id_col), "m.*")


def clean(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text: str = "text", shortest: int = MIN_MATCH, threshold: float = THRESHOLD) -> DataFrame:
    """Rows of docs, with all their columns, whose coverage of every item is below the threshold."""
    items = _items(benchmark, item_col, item_text)
    if _bounded(items):
        schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema)
        return docs.mapInArrow(_tiler(docs, items, shortest, docs.columns, text_col, threshold), schema)
    # Whether a row is contaminated depends on its text alone, so rows go by a digest of it.
    digest = F.sha2(F.coalesce(F.col(text_col), F.lit("")), 256)
    kept = docs.select(F.struct(digest.alias("digest")).alias("__key"), F.col(text_col).alias("text")).dropDuplicates(["__key"])
    bad = _joined(kept, items, shortest).where(F.col("m.coverage") >= threshold).select(F.col("__key.digest").alias(fresh(docs, "digest"))).distinct()
    return docs.join(bad, digest == F.col(bad.columns[0]), "left_anti")


def _bounded(items: DataFrame) -> bool:
    return (items.agg(F.sum(F.length("text"))).first()[0] or 0) <= BROADCAST_CHARS


def _tiler(docs: DataFrame, items: DataFrame, shortest: int, keep: list[str], text_col: str = "text", threshold: float | None = None):
    sent = docs.sparkSession.sparkContext.broadcast([(r["item_id"], r["text"]) for r in items.collect()])
    item_type = to_arrow_type(items.schema["item_id"].dataType)

    def run(batches):
        index = Index(sent.value, shortest)
        match = pa.struct([("item_id", item_type), ("tiles", pa.int32()), ("matched", pa.int32()), ("n_words", pa.int32()), ("coverage", pa.float64())])
        names = [f.name for f in match]
        for part, texts in text_batches(batches, text_col):
            found = [index.matches(t) for t in texts]
            if threshold is not None:
                yield part.filter(pa.array([all(m[4] < threshold for m in f) for f in found]))
            else:
                some = pa.array([bool(f) for f in found])
                rows = [[dict(zip(names, m, strict=True)) for m in f] for f in found if f]
                yield pa.RecordBatch.from_arrays([*(part.column(c).filter(some) for c in keep), pa.array(rows, pa.list_(match))], names=[*keep, "matches"])

    return run


def _joined(docs: DataFrame, items: DataFrame, shortest: int) -> DataFrame:
    """Rows (__key, m) as overlaps() has them, by an equi-join on seeds, for docs (__key, text). Seeds are hashes of the
    words themselves, one row for each distinct seed of a row. Rows are found again by what they hold, their key and a
    digest of their text, not by numbers that another reading might deal anew; equal rows are counted instead."""

    @F.pandas_udf("array<long>")
    def seeds(texts, lengths):
        import xxhash

        def one(text, wanted):
            own = words(text or "")
            out = set()
            for k in wanted:
                out.update(xxhash.xxh64_intdigest(b" ".join(own[i : i + k]), seed=int(k)) - (1 << 63) for i in range(len(own) - int(k) + 1))
            return sorted(out)

        return texts.combine(lengths, one)

    sized = items.withColumn("k", F.least(F.lit(shortest), _word_count(F.col("text")))).where("k > 0")
    lengths = [r["k"] for r in sized.select("k").distinct().collect()]  # at most `shortest` numbers
    sized = sized.groupBy("item_id", "text", "k").agg(F.count("*").alias("copies"))
    item = F.struct("item_id", F.sha2("text", 256).alias("digest"))
    held = sized.select(item.alias("item"), F.explode(seeds("text", F.array("k"))).alias("seed"), F.explode(F.array(*[F.lit(s) for s in range(SALTS)])).alias("salt"))
    rows = docs.withColumn("digest", F.sha2(F.coalesce("text", F.lit("")), 256))
    own = rows.select(F.struct("__key", "digest").alias("row"), F.explode(seeds("text", F.array(*[F.lit(k) for k in lengths]))).alias("seed"))
    own = own.withColumn("salt", F.pmod(F.xxhash64("row"), F.lit(SALTS)).cast("int"))
    pairs = own.join(held, ["seed", "salt"]).select("row", "item").distinct()
    texts = sized.select(item.alias("item"), F.col("text").alias("item_text"), "copies")
    near = pairs.join(texts, "item").join(rows.select(F.struct("__key", "digest").alias("row"), "text"), "row")

    @F.pandas_udf(f"struct<{COUNTS}>")
    def tiled(text, item):
        import pandas as pd

        found = [(Index([(0, x)], shortest).matches(t or "") or [(0, 0, 0, 0, 0.0)])[0][1:] for t, x in zip(text, item, strict=True)]
        return pd.DataFrame(found, columns=["tiles", "matched", "n_words", "coverage"])

    counted = near.select("row.__key", "item.item_id", "copies", tiled("text", "item_text").alias("c")).where("c.tiles > 0")
    each = counted.select("*", F.explode(F.expr("sequence(1L, copies)")))
    return each.select("__key", F.struct("item_id", "c.*").alias("m"))


def _word_count(text):
    @F.pandas_udf("int")
    def count(texts):
        return texts.map(lambda t: len(words(t or "")))

    return count(text)
