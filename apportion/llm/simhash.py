"""Near-duplicate documents by SimHash over a byte-position inverted index with count filtering.

A fingerprint is 64 majority bits over the XXH64 hashes of a text's 3-word shingles. Fingerprints that differ in at most
DISTANCE bits agree in at least MATCHES = 8 - DISTANCE = 5 of their 8 byte positions, so in four of the first seven. The
inverted index has a list for each value of four of the first seven bytes (35 choices); pairs that meet in a list have
four shared bytes, and the tally over all eight positions keeps those that reach five, whose bits are then compared.
Only links to a root of each connected part leave a list: n fingerprints give fewer than n rows, never n^2.

    * pairs of a list of up to SMALL fingerprints are tallied in blocks;
    * a longer list is tallied by splitting: each of the four other bytes deals it into lists of five shared bytes, which
      reach the count by themselves. Such a list differs in 24 bits only; if it is still long, it is verified with a
      table of 2^24 marks: two fingerprints are within three bits if and only if some value is within one bit of the one
      and two bits of the other. The links join the same parts as those of all pairs.

Texts with equal fingerprints are one vertex, which takes care of exact copies before the index. Links between vertices
are joined to connected components by alternating large and small stars, with lineage cut at each round. Where rows are
joined to what their fingerprint, neighbours or component come to, keys with over 1/HOT of the rows are dealt to SALTS parts.

Null texts count as empty; texts without words have fingerprint zero and are linked like any other. Rows are kept as
they are, repeated ids included; a component's id is its smallest id that isn't null.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import cut, fresh, offsets, text_batches

SHINGLE, SEED, DISTANCE, SMALL = 3, 42, 3, 2048
MATCHES = 8 - DISTANCE
MASKS = [sum(0xFF << 8 * b for b in kept) for kept in combinations(range(7), MATCHES - 1)]
HOT, SALTS, FEW = 1000, 32, 1_000_000
"""Keys with over 1/HOT of the rows are dealt to SALTS parts; FEW links are no work for one task, so they are not dealt."""
_U = np.uint64


def fingerprints(texts: list[str]) -> np.ndarray:
    """64-bit fingerprints of texts."""
    import xxhash

    digest = xxhash.xxh64_intdigest
    hashes, counts = [], []
    for text in texts:
        words = text.encode().lower().split()
        if not words:
            counts.append(0)
            continue
        if len(words) < SHINGLE:
            hashes.append(digest(b" ".join(words), SEED))
            counts.append(1)
            continue
        joined, n = b" ".join(words), len(words) - SHINGLE + 1
        at = np.zeros(len(words) + 1, dtype=np.int64)
        np.cumsum([len(w) + 1 for w in words], out=at[1:])
        hashes += [digest(joined[a:b], SEED) for a, b in zip(at[:n].tolist(), (at[SHINGLE:] - 1).tolist(), strict=True)]
        counts.append(n)
    out = np.zeros(len(texts), dtype=_U)
    starts = offsets(counts)
    h = np.array(hashes, dtype=_U)
    weights = _U(1) << np.arange(64, dtype=_U)
    for i, n in enumerate(counts):
        if n == 1:
            out[i] = h[starts[i]]
        elif n:
            ones = np.zeros(64, dtype=np.int64)
            for a in range(starts[i], starts[i + 1], 1 << 16):  # in blocks: a bit takes a byte
                own = h[a : min(a + (1 << 16), starts[i + 1])]
                ones += np.unpackbits(own.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
            out[i] = weights[ones * 2 > n].sum(dtype=_U)
    return out


def with_fingerprint(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Rows (id, fp): fp is the fingerprint's bits as a signed long."""
    id_type = docs.select(id_col).schema[0]

    def run(batches):
        for part, texts in text_batches(batches):
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array(fingerprints(texts).view(np.int64), pa.int64())], names=[id_col, "fp"])

    return docs.select(id_col, F.col(text_col).alias("text")).mapInArrow(run, f"`{id_col}` {id_type.dataType.simpleString()}, fp long")


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def _popcount(x: np.ndarray) -> np.ndarray:
    return np.bitwise_count(x)


def _roots(n: int, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Smallest number of each one's connected part, for numbers below n and these edges."""
    root = np.arange(n)
    while True:
        low = np.minimum(root[left], root[right])
        new = root.copy()
        np.minimum.at(new, root[left], low)
        np.minimum.at(new, root[right], low)
        new = new[new]
        if (new == root).all():
            return root
        root = new


def _pairs(fps: np.ndarray) -> np.ndarray:
    """Root of each fingerprint of a short list, by tallying shared bytes and verifying bits of all its pairs, in blocks."""
    left, right = [], []
    for a in range(0, len(fps), 256):
        for b in range(a, len(fps), 256):
            x = fps[a : a + 256, None] ^ fps[None, b : b + 256]
            shared = (x.view(np.uint8).reshape(*x.shape, 8) == 0).sum(axis=2)
            i, j = np.nonzero((shared >= MATCHES) & (_popcount(x) <= DISTANCE))
            left.append(i + a)
            right.append(j + b)
    return _roots(len(fps), np.concatenate(left), np.concatenate(right))


def _table(fps: np.ndarray, mask: int) -> np.ndarray:
    """Root of each fingerprint of a long list, in which all agree in the mask's bits."""
    free = [b for b in range(64) if not mask >> b & 1]
    low = np.zeros(len(fps), dtype=np.int64)
    for k, b in enumerate(free):
        low |= ((fps >> _U(b)) & _U(1)).astype(np.int64) << k
    near = np.concatenate([[0], 1 << np.arange(len(free))])
    far = np.array([x ^ y for x, y in combinations(near.tolist(), 2)])
    far = np.unique(np.concatenate([near, far]))
    root = np.arange(len(fps))
    while True:
        # The smallest root of those within one bit of a value, then handed to all within two bits of it.
        mark = np.full(1 << len(free), len(fps), dtype=np.int64)
        for e in near.tolist():
            np.minimum.at(mark, low ^ e, root)
        hub = mark < len(fps)
        for e in far.tolist():
            at = low ^ e
            at = at[hub[at]], root[hub[at]]
            np.minimum.at(mark, *at)
        new = root.copy()
        for e in far.tolist():
            at = low ^ e
            ok = hub[at]
            np.minimum.at(new, root[ok], mark[at[ok]])
        least = np.arange(len(fps))
        np.minimum.at(least, root, new)
        while (least != least[least]).any():
            least = least[least]
        new = least[root]
        if (new == root).all():
            return root
        root = new


def _split(fps: np.ndarray, mask: int) -> np.ndarray:
    """Root of each fingerprint of a long list, whose pairs share the mask's four bytes and need a fifth."""
    left, right = [], []
    for b in (b for b in range(8) if not mask >> 8 * b & 1):
        value = (fps >> _U(8 * b)) & _U(0xFF)
        order = np.argsort(value, kind="stable")
        for own in np.split(order, np.flatnonzero(np.diff(value[order])) + 1):
            root = _pairs(fps[own]) if len(own) <= SMALL else _table(fps[own], mask | 0xFF << 8 * b)
            left.append(own)
            right.append(own[root])
    return _roots(len(fps), np.concatenate(left), np.concatenate(right))


def _list_links(position: int, fps: np.ndarray) -> list[tuple[int, int]]:
    """(fingerprint, root) for each one of a list that isn't its part's root."""
    root = _pairs(fps) if len(fps) <= SMALL else _split(fps, MASKS[position])
    own = np.flatnonzero(root != np.arange(len(fps)))
    return list(zip(fps[own].view(np.int64).tolist(), fps[root[own]].view(np.int64).tolist(), strict=True))


def _dealt(left: DataFrame, right: DataFrame, key: str, sizes: DataFrame, total: int) -> DataFrame:
    """left joined to right, which has one row for each key. sizes (key, n) has left's rows of each key, total of all:
    fewer than HOT keys can have over total / HOT, so these go to every task, and both sides deal them to SALTS parts."""
    hot = F.broadcast(sizes.where(F.col("n") * HOT > total).select(key, F.lit(True).alias("__hot")))
    salt = F.when(F.col("__hot"), F.pmod(F.xxhash64(*left.columns), F.lit(SALTS))).otherwise(0).cast("int").alias("__salt")
    each = F.explode(F.when(F.col("__hot"), F.sequence(F.lit(0), F.lit(SALTS - 1))).otherwise(F.array(F.lit(0)))).alias("__salt")
    return left.join(hot, key, "left").select(*left.columns, salt).join(right.join(hot, key, "left").select(*right.columns, each), [key, "__salt"]).drop("__salt")


def links(vertices: DataFrame) -> DataFrame:
    """Distinct links (u, v) between distinct fingerprints (column fp) that keep all connected parts whole."""
    index = vertices.select(F.posexplode(F.array(*[F.col("fp").bitwiseAND(F.lit(_signed(m))) for m in MASKS])).alias("position", "shared"), "fp")
    sorted_lists = index.repartition("position", "shared").sortWithinPartitions("position", "shared")

    def run(batches):
        held: list[np.ndarray] = []  # the last list so far: its key is in `key`
        key = None

        def batch_of(found):
            return pa.RecordBatch.from_arrays([pa.array([x for x, _ in found], pa.int64()), pa.array([y for _, y in found], pa.int64())], names=["u", "v"])

        for batch in batches:
            position, shared, fp = (batch.column(c).to_numpy() for c in ("position", "shared", "fp"))
            if not len(fp):
                continue
            fp = fp.view(_U)
            edge = np.flatnonzero((position[1:] != position[:-1]) | (shared[1:] != shared[:-1])) + 1
            starts = np.concatenate(([0], edge, [len(fp)]))
            out = []
            sizes = np.diff(starts)
            first = (int(position[0]), int(shared[0]))
            if key is not None and key != first:
                out += _list_links(key[0], np.concatenate(held))
                held = []
            key = first
            # The batch's first list may go on from the batch before, and its last into the next.
            for g in [0, *(np.flatnonzero(sizes[1:-1] > 1) + 1).tolist(), len(sizes) - 1] if len(sizes) > 1 else [0]:
                own = fp[starts[g] : starts[g + 1]]
                if g == 0:
                    held.append(own.copy())
                    if len(sizes) > 1:
                        out += _list_links(key[0], np.concatenate(held))
                        held = []
                elif g == len(sizes) - 1:
                    key, held = (int(position[starts[g]]), int(shared[starts[g]])), [own.copy()]
                else:
                    out += _list_links(int(position[starts[g]]), own)
            if out:
                yield batch_of(out)
        if held and (out := _list_links(key[0], np.concatenate(held))):
            yield batch_of(out)

    return sorted_lists.mapInArrow(run, "u long, v long").distinct()


def components(edges: DataFrame, most_rounds: int = 60) -> DataFrame:
    """(node, root) for every node of the links (u, v): root is the smallest node of its connected component.

    Alternating large and small stars: each round links larger neighbours, then smaller ones, to the smallest
    neighbour, and ends when every node is linked to its root alone. Work of a round is in proportion to the links.
    """

    def star(e: DataFrame, large: bool, links: int) -> DataFrame:
        both = e.union(e.select(F.col("v").alias("u"), F.col("u").alias("v"))) if large else e.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
        sized = both.groupBy("u").agg(F.min("v").alias("m"), F.count("*").alias("n"))
        least = sized.select("u", F.least("u", "m").alias("m"))
        joined = _dealt(both, least, "u", sized.select("u", "n"), links) if links > FEW else both.join(least, "u")
        if large:
            return joined.where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        return joined.select(F.col("v").alias("u"), F.col("m").alias("v")).union(least.select("u", F.col("m").alias("v"))).where("u != v").distinct()

    def state(e: DataFrame) -> tuple:
        return tuple(e.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())

    e = cut(edges.where("u != v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct())
    now = state(e)
    for _ in range(most_rounds):
        # Both stars have at most twice the links; a bound that is too low deals some more keys, which does no harm.
        e = cut(star(star(e, True, int(now[0])), False, int(now[0])))
        before, now = now, state(e)
        if now == before:
            return e.select(F.col("u").alias("node"), F.col("v").alias("root"))
    raise RuntimeError("components did not settle")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Rows (id, fingerprint, component_id, component_root), one for each row of docs; the root is the component's smallest fingerprint."""
    # The id has a name of its own meanwhile, whatever it is called.
    rows = cut(with_fingerprint(docs.select(F.col(id_col).alias("__id"), F.col(text_col).alias("text")), "__id"))
    vertices = cut(rows.groupBy("fp").agg(F.min("__id").alias("least"), F.count("*").alias("n")))
    found, total = vertices.agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0))).first()
    joined = components(links(vertices.select("fp")))
    rooted = vertices.join(joined.withColumnRenamed("node", "fp"), "fp", "left").select("fp", "least", F.coalesce("root", "fp").alias("root"))
    parts = rooted.groupBy("root").agg(F.min("least").alias("component_id"), F.count("*").alias("n"))
    classes = _dealt(rooted, parts.select("root", "component_id"), "root", parts.select("root", "n"), found).select("fp", "root", "component_id")
    every = _dealt(rows, classes, "fp", vertices.select("fp", "n"), total)
    return every.select(F.col("__id").alias(id_col), hex_of(F.col("fp")).alias("fingerprint"), "component_id", hex_of(F.col("root")).alias("component_root"))


def hex_of(fp: Column) -> Column:
    return F.lpad(F.lower(F.hex(fp)), 16, "0")


def representatives(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row of docs for each component, with all its columns: that of its smallest id; of its rows that repeat this id, one.

    Rows without an id are left out if their component has one; else one row of the component stays.
    """
    i, h, r, n, fp = (fresh(docs, x) for x in ("id", "hex", "root", "n", "fp"))
    found = near_duplicates(docs, id_col, text_col).select(F.col(id_col).alias(i), F.col("fingerprint").alias(h), "component_id", F.col("component_root").alias(r))
    own = F.col(i) == F.col("component_id")
    ids = found.groupBy(i).agg(F.max(own).alias("least"), (F.min(h) != F.max(h)).alias("several")).where("least")
    first = F.row_number().over(Window.partitionBy(id_col).orderBy(F.col(text_col).asc_nulls_last()))

    def of(few: str) -> DataFrame:
        return docs.join(ids.where(few).select(i), F.col(id_col) == F.col(i), "left_semi")

    # Rows of different texts may repeat an id; these few are told apart by their fingerprints, as are rows without one.
    classes = found.where(own).select(i, h, r).distinct()
    repeated = _attach(of("several"), text_col, fp).join(classes, (F.col(id_col) == F.col(i)) & (hex_of(F.col(fp)) == F.col(h)))
    roots = found.where("component_id IS NULL").select(h, r).distinct()
    lone = _attach(docs.where(F.col(id_col).isNull()), text_col, fp).join(roots, hex_of(F.col(fp)) == F.col(h))
    by_root = F.row_number().over(Window.partitionBy(r).orderBy(F.col(text_col).asc_nulls_last()))
    every = [of("NOT several").withColumn(n, first), repeated.withColumn(n, by_root), lone.withColumn(n, by_root)]
    kept = [rows.where(F.col(n) == 1).select(*[F.col(f"`{c}`") for c in docs.columns]) for rows in every]
    return kept[0].unionByName(kept[1]).unionByName(kept[2])


def _attach(docs: DataFrame, text_col: str, fp: str) -> DataFrame:
    names = docs.columns

    def run(batches):
        for part, texts in text_batches(batches, text_col):
            yield pa.RecordBatch.from_arrays([*(part.column(c) for c in names), pa.array(fingerprints(texts).view(np.int64), pa.int64())], names=[*names, fp])

    return docs.mapInArrow(run, ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema) + f", `{fp}` long")
