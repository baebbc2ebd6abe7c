"""Language-model scores by deleted interpolation of bigrams.

Tokens are words (A-Z lower-cased, runs of bytes other than ASCII white space), then one end for each text; a text's
first context is the end. The probability of w after u is

    l2(b) c(u,w) / c(u) + l1(b) c(w) / N + l0(b) / (V + 1)

where b is the bucket of the context's frequency (its power of two) and the weights of a bucket are learned by
expectation-maximisation on held-out counts: each training token in turn is deleted, so its own estimates are
(c(u,w) - 1) / (c(u) - 1) and (c(w) - 1) / (N - 1).

All counts are over all training texts, and no table of words or bigrams goes to the driver or to every task:

    1. read      each task turns blocks of about BLOCK_CHARS characters into packed rows: the block's texts as numbers
                 of its own words, and the words' hashes and training counts, split over word groups;
    2. count     word groups add up counts over blocks (a shuffle of each block's distinct words); the driver gets the
                 histogram of counts alone (at most the square root of 2 N rows), which turns a rank into its count;
    3. rank      word groups send each block the ranks of its words, highest counts first;
    4. pair      each block scores what needs no bigram count, and sends its distinct bigrams of known words, with the
                 texts that hold them, to bigram groups (the largest shuffle, a few bytes for each token);
    5. learn     bigram groups add up counts and histogram (bucket, estimates); the driver runs EM on the histogram;
    6. score     bigram groups send each block one sum for each of its texts.

A frequent word or bigram is one entry in each block, so it does not make a group large; groups are hashes of words
and bigrams, and their number follows the input. Words and bigrams are told apart by 64-bit hashes of words. The texts are
read twice (for steps 1 and 4), so docs must give the same rows in the same order each time, as tables and checkpoints do.

Null texts count as empty: one end. Without training texts, N and V are 0 and every token has probability 1 in the base
formula's limit of log10(0.5 / 0.5) = 0, and 1 / (V + 1) = 1 in the model.
"""

from __future__ import annotations

import math
from dataclasses import dataclass
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import cut, offsets, text_batches
from .packed import Dealing, mix, pack, pack_numbered, pack_sorted, unpack, unpack_numbered, unpack_sorted

BLOCK_CHARS, GROUP_CHARS = 1 << 22, 1 << 24
"""Characters of a block and of a group at 2^29 characters of input; they grow with its root, up to 8 and 4 times."""
ROW_CHARS = 1 << 14
"""Characters of text that a row from a block to a group stands for at least; below it, blocks deal in two levels."""
NARROW = 1 << 32
"""Two ranks below this are one key of 64 bits."""
SLICE_TOKENS = 1 << 20
"""Tokens of a bigram group that are sorted and scored at once, about."""
BUCKETS, STEPS, ROUNDS = 48, 4, 60
"""Frequency buckets; histogram bins to a factor of two; rounds of EM."""

END = "\n"  # no word holds it
U64 = np.uint64


@dataclass(frozen=True)
class Counts:
    """Counts by rank: `level[i]` is the count of ranks from `first[i]` up to the next."""

    first: np.ndarray
    level: np.ndarray
    total: int
    distinct: int

    def of(self, rank: np.ndarray) -> np.ndarray:
        return self.level[np.searchsorted(self.first, rank, "right") - 1]


def _words_of(text: str) -> list[bytes]:
    return text.encode().lower().split()


ROW = "kind int, place long, block long, a binary, b binary, ids array<{id}>, c binary"
"""kind 0: words of a block for the word group `place`: hashes (a), training counts (b), numbers in the block (c).
kind 1: a block's texts, training texts first: lengths (a), words' numbers (b), ids; c: number of training texts."""


def _block_rows(block: int, ids: list, texts: list[str], train: list[bool], deal: Dealing, wanted: int):
    import xxhash

    order = sorted(range(len(texts)), key=lambda i: not train[i])
    number: dict[bytes, int] = {}
    sequence: list[int] = []
    lengths = []
    n_train = sum(train)
    at_train = 0
    for k, i in enumerate(order):
        words = _words_of(texts[i])
        sequence += [number.setdefault(w, len(number)) for w in words]
        lengths.append(len(words))
        if k + 1 == n_train:
            at_train = len(sequence)
    seq = np.array(sequence, dtype=np.int64)
    if wanted == 1:
        yield (1, block, block, pack(np.array(lengths)), pack_numbered(seq), [ids[i] for i in order], n_train.to_bytes(8, "little"))
        return
    hashes = np.fromiter((xxhash.xxh64_intdigest(w) for w in number), dtype=U64, count=len(number))
    counts = np.bincount(seq[:at_train], minlength=len(number)) if len(number) else np.zeros(0, np.int64)
    place = deal.place(block, _word_group(hashes, deal))
    order_w = np.lexsort((hashes, place))
    for g, part in _runs(place[order_w], order_w):
        yield (0, g, block, pack_sorted(hashes[part]), pack(counts[part]), None, pack(part))


def _word_group(hashes: np.ndarray, deal: Dealing) -> np.ndarray:
    return (mix(hashes) % U64(deal.groups)).astype(np.int64)


def _runs(sorted_keys: np.ndarray, values: np.ndarray):
    """(key, values) of each run of equal keys."""
    if len(sorted_keys):
        at = np.concatenate(([0], np.flatnonzero(np.diff(sorted_keys)) + 1, [len(sorted_keys)]))
        for a, b in zip(at[:-1].tolist(), at[1:].tolist(), strict=True):
            yield int(sorted_keys[a]), values[a:b]


def _table(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    cols = list(zip(*rows, strict=True)) if rows else [[] for _ in schema]
    return pa.RecordBatch.from_arrays([pa.array(list(c), f.type) for c, f in zip(cols, schema, strict=True)], schema=schema)


def _rows(table: pa.Table) -> list[dict]:
    return table.to_pylist()


def _read(docs: DataFrame, train: Column, deal: Dealing, id_col: str, text_col: str, wanted: int) -> DataFrame:
    """Rows of ROW of one kind. A block's name is a hash of its partition's number, its own in the partition and its rows,
    so each reading gives it the same name, and blocks of equal rows have names of their own."""
    import xxhash
    from pyspark import TaskContext

    kept = docs.select(id_col, F.col(text_col).alias("text"), F.coalesce(train, F.lit(False)).alias("train"))
    id_type = kept.schema[0].dataType

    def run(batches):
        part, ordinal = TaskContext.get().partitionId(), count()

        def fresh_name():
            return xxhash.xxh64(f"{part} {next(ordinal)} ".encode())

        ids, texts, train, size, name, kind = [], [], [], 0, fresh_name(), None

        def flush():
            nonlocal ids, texts, train, size, name
            schema = pa.schema([("kind", pa.int32()), ("place", pa.int64()), ("block", pa.int64()), ("a", pa.binary()), ("b", pa.binary()), ("ids", pa.list_(kind)), ("c", pa.binary())])
            block = name.intdigest() - (1 << 63)
            rows = [r for r in _block_rows(block, ids, texts, train, deal, wanted) if r[0] == wanted]
            ids, texts, train, size, name = [], [], [], 0, fresh_name()
            for i in range(0, len(rows), 64):
                yield _table(rows[i : i + 64], schema)

        for batch, own in text_batches(batches):
            kind = batch.column(0).type
            flags = batch.column("train").to_pylist()
            for i, t, f in zip(batch.column(0).to_pylist(), own, flags, strict=True):
                ids.append(i)
                texts.append(t)
                train.append(f)
                size += len(t)
                name.update(f"{i!r} {f} ".encode() + t.encode())
                if size >= deal.block_chars:
                    yield from flush()
        if ids:
            yield from flush()

    return kept.mapInArrow(run, ROW.format(id=id_type.simpleString()))


def _group_words(rows: list[dict]) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
    """Distinct hashes of a word group in order, their training counts, and each row's places among them."""
    parts = [unpack_sorted(r["a"]) for r in rows]
    every, where = np.unique(np.concatenate(parts), return_inverse=True)
    counts = np.bincount(where, weights=np.concatenate([unpack(r["b"]) for r in rows]).astype(np.float64), minlength=len(every)).astype(np.int64)
    return every, counts, np.split(where, offsets([len(p) for p in parts])[1:-1])


def _bunched_words(words: DataFrame, deal: Dealing) -> DataFrame:
    """Rows to word groups, of what a bunch's blocks sent to a range of them: each word once, numbered in order of hashes."""
    schema = pa.schema([("place", pa.int64()), ("block", pa.int64()), ("a", pa.binary()), ("b", pa.binary()), ("c", pa.binary())])

    def run(table: pa.Table) -> pa.Table:
        every, counts, _ = _group_words(_rows(table))
        group = _word_group(every, deal)
        order = np.argsort(group, kind="stable")
        place = table.column("place")[0].as_py()
        return pa.Table.from_batches([_table([(g, place, pack_sorted(every[part]), pack(counts[part]), pack(part)) for g, part in _runs(group[order], order)], schema)])

    return words.groupBy("place").applyInArrow(run, "place long, block long, a binary, b binary, c binary")


def _split_ranks(words: DataFrame, answers: DataFrame) -> DataFrame:
    """Ranks of blocks' words, as _ranks() gives them, from those of their bunches' ranges."""
    schema = pa.schema([("block", pa.int64()), ("a", pa.binary()), ("c", pa.binary())])

    def run(table: pa.Table, got: pa.Table) -> pa.Table:
        rows = _rows(table)
        if not rows:
            return schema.empty_table()
        every, _, where = _group_words(rows)
        rank = np.zeros(len(every), dtype=np.int64)
        for r in _rows(got):
            rank[unpack(r["c"]).astype(np.int64)] = unpack(r["a"]).astype(np.int64)
        return pa.Table.from_batches([_table([(r["block"], pack(rank[w]), r["c"]) for r, w in zip(rows, where, strict=True)], schema)])

    return words.groupBy("place").cogroup(answers.groupBy("block")).applyInArrow(run, "block long, a binary, c binary")


def _histogram(words: DataFrame) -> DataFrame:
    """(place, level, n): how many words of each group have each training count above zero."""

    def run(table: pa.Table) -> pa.Table:
        _, counts, _ = _group_words(_rows(table))
        level, n = np.unique(counts[counts > 0], return_counts=True)
        return pa.table({"place": pa.array(np.full(len(level), table.column("place")[0].as_py()), pa.int64()), "level": pa.array(level, pa.int64()), "n": pa.array(n, pa.int64())})

    return words.groupBy("place").applyInArrow(run, "place long, level long, n long")


def _count_table(levels: list[tuple[int, int]], ends: int) -> tuple[Counts, int]:
    """Counts from (count, number of words), with the end token as one more word, and the end's rank (-1 if untrained)."""
    table = dict(levels)
    if ends:
        table[ends] = table.get(ends, 0) + 1
    level = np.array(sorted(table, reverse=True), dtype=np.int64)
    n = np.array([table[x] for x in level.tolist()], dtype=np.int64)
    first = offsets(n)[:-1]
    end = int(first[np.flatnonzero(level == ends)[0]]) if ends else -1  # the first rank of its level
    return Counts(first, level, int((level * n).sum()), int(n.sum())), end


def _ranks(words: DataFrame, starts: DataFrame) -> DataFrame:
    """(block, a, c): ranks plus one (0: not in training) of each block's words of each group, in the order of their numbers c."""
    out_schema = pa.schema([("block", pa.int64()), ("a", pa.binary()), ("c", pa.binary())])

    def run(table: pa.Table, own: pa.Table) -> pa.Table:
        rows = _rows(table)
        if not rows:
            return out_schema.empty_table()
        start = dict(zip(own.column("level").to_pylist(), own.column("start").to_pylist(), strict=True))
        every, counts, where = _group_words(rows)
        rank = np.zeros(len(every), dtype=np.int64)
        order = np.argsort(-counts, kind="stable")
        for level, at in _runs(-counts[order], order):
            if level:
                rank[at] = start[-level] + np.arange(len(at)) + 1
        return pa.Table.from_batches([_table([(r["block"], pack(rank[w]), r["c"]) for r, w in zip(rows, where, strict=True)], out_schema)])

    return words.groupBy("place").cogroup(starts.groupBy("place")).applyInArrow(run, "block long, a binary, c binary")


def _safe_log10(x: np.ndarray) -> np.ndarray:
    return np.log10(np.maximum(x, 1e-300))


def _bucket(c: np.ndarray) -> np.ndarray:
    """Power of two of a context's count; bucket 0 has the contexts that training lacks."""
    return np.minimum(np.frexp(c.astype(np.float64))[1], BUCKETS - 1)


PAIR_ROW = "kind int, place long, block long, u binary, w binary, n binary, texts binary, n_train long, ids array<{id}>, numbers array<struct<n_tokens: long, n_known: long, base: double>>, lone binary"
"""kind 0: distinct bigrams of a block for the bigram group `place`: ranks in order (u, w), how many tokens each has (n),
and the tokens' texts as numbers in the block, training texts first. kind 1: a block's texts: ids, counts and base
scores, and in `lone` the context buckets and counts of tokens whose bigram training can't have: bucket, c(w), text."""


def _in_order(u: np.ndarray, w: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The order of pairs of ranks, and where in it each distinct one begins."""
    if max(u.max(initial=0), w.max(initial=0)) < NARROW:
        key = u << U64(32) | w
        order = np.argsort(key, kind="stable")
        key = key[order]
        new = key[1:] != key[:-1]
    else:
        order = np.lexsort((w, u))
        new = (u[order][1:] != u[order][:-1]) | (w[order][1:] != w[order][:-1])
    return order, np.flatnonzero(np.concatenate(([True], new))) if len(order) else np.zeros(0, np.int64)


def _pair_group(u: np.ndarray, w: np.ndarray, deal: Dealing) -> np.ndarray:
    return (mix(u << U64(32) ^ w ^ mix(u >> U64(32))) % U64(deal.groups)).astype(np.int64)


def _pair(rows: list[dict], counts: Counts, end: int, deal: Dealing):
    """Rows of PAIR_ROW for one block. Its texts and the ranks of its words come from two readings; if these didn't give
    the same blocks, that is an error, never a wrong score."""
    own = [r for r in rows if r["ids"] is not None]
    if len(own) != 1:
        raise RuntimeError("docs gave other rows when they were read again: pass a table or a checkpoint")
    texts, block, answers = own[0], own[0]["block"], [r for r in rows if r["ids"] is None]
    lengths, seq = unpack(texts["a"]).astype(np.int64), unpack_numbered(texts["b"])
    n_train = int.from_bytes(texts["c"], "little")
    places = [unpack(r["c"]).astype(np.int64) for r in answers]
    rank = np.full(int(seq.max()) + 1 if len(seq) else 0, -2, dtype=np.int64)
    for at, r in zip(places, answers, strict=True):
        if len(at) and int(at.max()) >= len(rank):
            raise RuntimeError("a block came back with other words")
        rank[at] = unpack(r["a"]).astype(np.int64) - 1
    if (rank == -2).any():
        raise RuntimeError("docs gave other rows when they were read again: pass a table or a checkpoint")
    # Tokens of all texts as numbers of words, an end after each; contexts likewise, an end before each. The end is the last word.
    # A block has many more tokens than words, so ranks and counts stay with the words, and tokens are 4 bytes.
    word = np.append(rank, end)
    at = offsets(lengths + 1)
    token = np.full(at[-1], len(rank), dtype=np.int32)
    inner = np.ones(at[-1], dtype=bool)
    inner[at[1:] - 1] = False
    token[inner] = seq
    del seq, inner
    context = np.concatenate((np.array([len(rank)], dtype=np.int32), token[:-1]))
    text = np.repeat(np.arange(len(lengths), dtype=np.int32), lengths + 1)
    cw = np.where(word >= 0, counts.of(np.maximum(word, 0)), 0) if counts.distinct else np.zeros(len(word), np.int64)
    base = np.log10((cw + 0.5) / (counts.total + 0.5 * (counts.distinct + 1)))
    numbers = [{"n_tokens": n, "n_known": k, "base": b} for n, k, b in zip((lengths + 1).tolist(), np.add.reduceat((cw > 0)[token], at[:-1], dtype=np.int64).tolist(), np.add.reduceat(base[token], at[:-1]).tolist(), strict=True)]
    known = (word >= 0)[token] & (word >= 0)[context]
    lone = np.flatnonzero(~known)
    yield (1, block, block, None, None, None, None, n_train, texts["ids"], numbers, b"".join(len(p).to_bytes(8, "little") + p for p in (pack(_bucket(cw[context[lone]])), pack(cw[token[lone]]), pack(text[lone]))))
    u, w, text = word[context[known]].astype(U64), word[token[known]].astype(U64), text[known]
    del numbers, token, context, known, lone
    order, first = _in_order(u, w)
    u, w, owner = u[order[first]], w[order[first]], text[order]
    size = np.diff(np.append(first, len(order)))
    del order, text
    place = deal.place(block, _pair_group(u, w, deal))
    by_place = np.argsort(place, kind="stable")
    for g, part in _runs(place[by_place], by_place):
        n = size[part]
        starts = np.repeat(first[part] - offsets(n)[:-1], n) + np.arange(n.sum())
        yield (0, g, block, pack_sorted(u[part]), pack(w[part]), pack(n), pack(owner[starts]), n_train, None, None, None)


def _pairs(answers: DataFrame, texts: DataFrame, counts: Counts, end: int, deal: Dealing, id_type: str) -> DataFrame:
    sent = answers.sparkSession.sparkContext.broadcast(counts)

    def run(table: pa.Table) -> pa.Table:
        kind = table.schema.field("ids").type
        schema = pa.schema([("kind", pa.int32()), ("place", pa.int64()), ("block", pa.int64()), *((x, pa.binary()) for x in ("u", "w", "n", "texts")), ("n_train", pa.int64()), ("ids", kind), ("numbers", pa.list_(pa.struct([("n_tokens", pa.int64()), ("n_known", pa.int64()), ("base", pa.float64())]))), ("lone", pa.binary())])
        return pa.Table.from_batches([_table(list(_pair(_rows(table), sent.value, end, deal)), schema)])

    both = texts.select("block", "a", "b", "ids", "c").unionByName(answers, allowMissingColumns=True)
    made = both.groupBy("block").applyInArrow(run, PAIR_ROW.format(id=id_type))
    return cut(made.repartition(deal.groups, "place", "kind").sortWithinPartitions("kind", "place"))


def _renumbered(rows: list[dict]) -> tuple[list[np.ndarray], list[tuple[int, int]], int]:
    """Of a bunch's rows, in order of their blocks: each one's texts as numbers in the bunch, its numbers of training texts and
    of others, and how many training texts there are; as in a block, they have the first numbers."""
    texts = [unpack(r["texts"]).astype(np.int64) for r in rows]
    sizes = [(r["n_train"], max(int(t.max(initial=-1)) + 1 - r["n_train"], 0)) for r, t in zip(rows, texts, strict=True)]
    total = sum(a for a, _ in sizes)
    trained, other = offsets([a for a, _ in sizes]), total + offsets([b for _, b in sizes])
    return [np.where(t < a, t + trained[k], t - a + other[k]) for k, (t, (a, _)) in enumerate(zip(texts, sizes, strict=True))], sizes, total


def _bunched_pairs(pairs: DataFrame, deal: Dealing) -> DataFrame:
    """Rows to bigram groups, of what a bunch's blocks sent to a range of them: each bigram once, texts numbered over the bunch."""
    names = ("u", "w", "n", "texts")
    schema = pa.schema([("kind", pa.int32()), ("place", pa.int64()), ("block", pa.int64()), *((x, pa.binary()) for x in names), ("n_train", pa.int64())])

    def run(table: pa.Table) -> pa.Table:
        rows = sorted(_rows(table), key=lambda r: r["block"])
        texts, _, n_train = _renumbered(rows)
        u, w, n = (np.concatenate([f(r[c]) for r in rows]) for c, f in (("u", unpack_sorted), ("w", unpack), ("n", unpack)))
        order, first = _in_order(u, w)
        pair = np.empty(len(u), dtype=np.int64)
        pair[order] = np.repeat(np.arange(len(first)), np.diff(np.append(first, len(u))))
        token = np.repeat(pair, n.astype(np.int64))
        owner = np.concatenate(texts)[np.argsort(token, kind="stable")]
        size = np.bincount(token, minlength=len(first))
        begin = offsets(size)[:-1]
        u, w = u[order][first], w[order][first]
        group = _pair_group(u, w, deal)
        by_group = np.argsort(group, kind="stable")
        out = []
        for g, part in _runs(group[by_group], by_group):
            at = np.repeat(begin[part] - offsets(size[part])[:-1], size[part]) + np.arange(size[part].sum())
            out.append((0, g, rows[0]["place"], pack_sorted(u[part]), pack(w[part]), pack(size[part]), pack(owner[at]), n_train))
        return pa.Table.from_batches([_table(out, schema)])

    made = pairs.where("kind = 0").groupBy("place").applyInArrow(run, "kind int, place long, block long, u binary, w binary, n binary, texts binary, n_train long")
    return cut(made.repartition(deal.groups, "place", "kind").sortWithinPartitions("kind", "place"))


def _split_sums(pairs: DataFrame, sums: DataFrame) -> DataFrame:
    """Sums of blocks' texts, as _sums() gives them, from those of their bunches' ranges."""
    schema = pa.schema([("block", pa.int64()), ("texts", pa.binary()), ("sums", pa.binary())])

    def run(table: pa.Table, got: pa.Table) -> pa.Table:
        rows = sorted(_rows(table), key=lambda r: r["block"])
        if not rows:
            return schema.empty_table()
        texts, sizes, total = _renumbered(rows)
        score = np.zeros(sum(a + b for a, b in sizes))
        for r in sorted(_rows(got), key=lambda r: (len(r["sums"]), r["sums"])):
            _add(score, r)
        out = []
        for r, t in zip(rows, texts, strict=True):
            own, here = np.unique(unpack(r["texts"]).astype(np.int64)), np.unique(t)  # both in the same order: training texts first
            out.append((r["block"], *_sparse(own, score[here])))
        return pa.Table.from_batches([_table(out, schema)])

    return pairs.where("kind = 0").select("place", "block", "texts", "n_train").groupBy("place").cogroup(sums.groupBy("block")).applyInArrow(run, "block long, texts binary, sums binary")


def _sparse(texts: np.ndarray, sums: np.ndarray) -> tuple[bytes | None, bytes]:
    """Sums of some texts, numbered in ascending order: without the numbers if at least half of those up to the last are there."""
    n = int(texts[-1]) + 1 if len(texts) else 0
    if 2 * len(texts) < n:
        return pack_sorted(texts.astype(U64)), sums.tobytes()
    full = np.zeros(n)
    full[texts] = sums
    return None, full.tobytes()


def _add(score: np.ndarray, row: dict) -> None:
    x = np.frombuffer(row["sums"])
    if row["texts"] is None:
        score[: len(x)] += x
    else:
        score[unpack_sorted(row["texts"]).astype(np.int64)] += x


def _by_place(batches):
    """Lists of rows (dicts) that share a place, from batches in order of place."""
    held: list[dict] = []
    for batch in batches:
        for k in range(batch.num_rows):
            r = batch.slice(k, 1).to_pylist()[0]
            if held and held[0]["place"] != r["place"]:
                yield held
                held = []
            held.append(r)
    if held:
        yield held


def _small(x: np.ndarray) -> np.ndarray:
    """Whole numbers in as few bytes as the greatest needs."""
    return x.astype(np.min_scalar_type(int(x.max(initial=0))))


def _numbered(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct numbers in order, and each one's place among them."""
    if int(x.max(initial=0)) >= 4 * len(x):
        return np.unique(x, return_inverse=True)
    there = np.bincount(x) > 0
    return np.flatnonzero(there), (np.cumsum(there) - 1)[x]


class _Group:
    """The rows of a bigram group, unpacked into as few bytes as their numbers need; `rows` is emptied meanwhile.

    Each block's row has the ranks (u, w) of its distinct bigrams, how many tokens of each are of training texts (c) and, with
    `texts`, of all texts (n), and the tokens' texts as places in the list of its own texts."""

    def __init__(self, rows: list[dict], texts: bool):
        self.u, self.w, self.c, self.n, self.slot, self.own, self.block, self.tokens = [], [], [], [], [], [], [], 0
        rows.reverse()
        while rows:
            r = rows.pop()
            n, t = unpack(r["n"]).astype(np.int64), unpack(r["texts"]).astype(np.int64)
            self.tokens += len(t)
            self.block.append(r["block"])
            self.u.append(_small(unpack_sorted(r["u"])))
            self.w.append(_small(unpack(r["w"])))
            self.c.append(_small(np.add.reduceat(t < r["n_train"], offsets(n)[:-1], dtype=np.int64)))
            if texts:
                own, slot = _numbered(t)
                self.n.append(_small(n))
                self.own.append(_small(own))
                self.slot.append(_small(slot))

    def slices(self):
        """By ranges of u, of about SLICE_TOKENS tokens each: distinct bigrams (u, w) and their training counts; then the place among
        them of each row's bigrams, laid end to end, and where these begin and end in each row."""
        some = np.sort(np.concatenate([u[::16] for u in self.u]))
        n = -(-self.tokens // SLICE_TOKENS)
        bounds = np.unique(some[np.arange(1, n) * len(some) // n])
        at = np.stack([np.concatenate(([0], np.searchsorted(u, bounds), [len(u)])) for u in self.u])
        for a, b in zip(at[:, :-1].T.tolist(), at[:, 1:].T.tolist(), strict=True):
            u, w, c = (np.concatenate([x[i:j] for x, i, j in zip(xs, a, b, strict=True)]) for xs in (self.u, self.w, self.c))
            u, w = u.astype(U64), w.astype(U64)
            order, first = _in_order(u, w)
            where = np.empty(len(u), dtype=np.int64)
            where[order] = np.repeat(np.arange(len(first)), np.diff(np.append(first, len(u))))
            distinct = order[first]
            yield u[distinct].astype(np.int64), w[distinct].astype(np.int64), np.bincount(where, weights=c, minlength=len(first)).astype(np.int64), where, a, b


def _group_estimates(rows: list[dict], c: Counts):
    """Histograms (bucket, x2, x1, n, s2, s1) of a bigram group's slices."""
    for u, w, n, *_ in _Group(rows, False).slices():
        own = n > 0
        u, w, n = u[own], w[own], n[own]
        cu, cw = c.of(u), c.of(w)
        with np.errstate(divide="ignore", invalid="ignore"):
            l2 = np.where(n > 1, np.log2((n - 1) / np.maximum(cu - 1, 1)), -np.inf)
            l1 = np.where(cw > 1, np.log2((cw - 1) / max(c.total - 1, 1)), -np.inf)
        bins = [np.where(np.isfinite(x), np.floor(-np.where(np.isfinite(x), x, 0) * STEPS), -1).astype(np.int64) for x in (l2, l1)]
        key = (_bucket(cu) * 2048 + bins[0] + 1) * 2048 + bins[1] + 1
        every, where = np.unique(key, return_inverse=True)
        sums = [np.bincount(where, weights=n * np.where(np.isfinite(x), x, 0), minlength=len(every)) for x in (l2, l1)]
        yield every // (2048 * 2048), every // 2048 % 2048 - 1, every % 2048 - 1, np.bincount(where, weights=n, minlength=len(every)), *sums


def _group_sums(rows: list[dict], c: Counts, l: np.ndarray) -> list[tuple]:
    """(block, texts, sums) of each row of a bigram group."""
    group = _Group(rows, True)
    sums, done = [np.zeros(len(own)) for own in group.own], [0] * len(group.own)
    for u, w, n, where, begin, end in group.slices():
        cu, cw = c.of(u), c.of(w)
        b = _bucket(cu)
        logs, at = _safe_log10(l[b, 0] * n / cu + l[b, 1] * cw / c.total + l[b, 2] / (c.distinct + 1)), 0
        for k, (i, j) in enumerate(zip(begin, end, strict=True)):
            each = np.repeat(logs[where[at : at + j - i]], group.n[k][i:j])
            if len(each):
                sums[k] += np.bincount(group.slot[k][done[k] : done[k] + len(each)], weights=each, minlength=len(sums[k]))
            at, done[k] = at + j - i, done[k] + len(each)
    return [(block, *_sparse(own.astype(np.int64), x)) for block, own, x in zip(group.block, group.own, sums, strict=True)]


def _estimates(pairs: DataFrame, counts: Counts) -> DataFrame:
    """Histogram of deleted estimates: (bucket, x2, x1) with the number of tokens and the sums of the estimates' logs.

    x2 and x1 number the bins of the bigram and unigram estimates, STEPS to a factor of two; -1 for zero.
    """
    sent = pairs.sparkSession.sparkContext.broadcast(counts)

    def run(batches):
        c = sent.value
        for rows in _by_place(batches):
            for found in _group_estimates(rows, c):
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in found], names=["bucket", "x2", "x1", "n", "s2", "s1"])

    found = pairs.where("kind = 0").select("place", "block", "u", "w", "n", "texts", "n_train").mapInArrow(run, "bucket long, x2 long, x1 long, n double, s2 double, s1 double")
    return found.groupBy("bucket", "x2", "x1").agg(F.sum("n").alias("n"), F.sum("s2").alias("s2"), F.sum("s1").alias("s1"))


def learn(histogram: list[tuple], distinct: int) -> np.ndarray:
    """Weights (bucket, (l2, l1, l0)) by expectation-maximisation; a bucket without tokens takes the nearest lower one's."""
    weights = np.zeros((BUCKETS, 3))
    weights[:] = (0.0, 0.7, 0.3)
    by: dict[int, list] = {}
    for bucket, x2, x1, n, s2, s1 in sorted(histogram):
        by.setdefault(int(bucket), []).append((0.0 if x2 < 0 else 2.0 ** (s2 / n), 0.0 if x1 < 0 else 2.0 ** (s1 / n), 1 / (distinct + 1), n))
    seen = None
    for b in range(BUCKETS):
        if b in by:
            rows = np.array(by[b])
            p, n = rows[:, :3], rows[:, 3]
            l = np.array([0.5, 0.4, 0.1])
            for _ in range(ROUNDS):
                r = p * l
                l = (n[:, None] * r / r.sum(axis=1, keepdims=True)).sum(axis=0) / n.sum()
                l = np.maximum(l, 1e-6)  # an estimate that never helped may be the only one for a new text
                l /= l.sum()
            seen = l
        if seen is not None:
            weights[b] = seen
    if seen is not None:  # contexts that training lacks have no bigrams: the rarest contexts' other weights
        low = weights[min(by)]
        weights[: min(by)] = (0.0, *(low[1:] / low[1:].sum()))
    else:
        weights[:] = (0.0, 0.5, 0.5)
    return weights


def _sums(pairs: DataFrame, counts: Counts, weights: np.ndarray) -> DataFrame:
    """(block, texts, sums): for each block and bigram group, the sum of log10 probabilities of each text, as doubles of all texts up to
    the last, or of the packed numbers in `texts`."""
    sent = pairs.sparkSession.sparkContext.broadcast((counts, weights))

    def run(batches):
        c, l = sent.value
        for rows in _by_place(batches):
            out = list(zip(*_group_sums(rows, c, l), strict=True))
            yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(out, (pa.int64(), pa.binary(), pa.binary()), strict=True)], names=["block", "texts", "sums"])

    return pairs.where("kind = 0").select("place", "block", "u", "w", "n", "texts", "n_train").mapInArrow(run, "block long, texts binary, sums binary")


def _totals(pairs: DataFrame, sums: DataFrame, counts: Counts, weights: np.ndarray, id_col: str, id_type: str) -> DataFrame:
    sent = pairs.sparkSession.sparkContext.broadcast((counts, weights))

    def run(table: pa.Table) -> pa.Table:
        c, l = sent.value
        rows = _rows(table)
        own = next(r for r in rows if r["ids"] is not None)
        score = np.zeros(len(own["ids"]))
        for r in sorted((r for r in rows if r["sums"] is not None), key=lambda r: len(r["sums"])):
            _add(score, r)
        parts, at = [], 0
        while at < len(own["lone"]):
            size = int.from_bytes(own["lone"][at : at + 8], "little")
            parts.append(unpack(own["lone"][at + 8 : at + 8 + size]).astype(np.int64))
            at += 8 + size
        bucket, cw, text = parts
        p = l[bucket, 1] * cw / max(c.total, 1) + l[bucket, 2] / (c.distinct + 1) if c.total else np.ones(len(cw))
        score += np.bincount(text, weights=_safe_log10(p), minlength=len(score))
        numbers = own["numbers"]
        return pa.table({id_col: pa.array(own["ids"], table.schema.field("ids").type.value_type), "n_tokens": pa.array([x["n_tokens"] for x in numbers], pa.int64()), "n_known": pa.array([x["n_known"] for x in numbers], pa.int64()), "base_score": pa.array([x["base"] for x in numbers], pa.float64()), "score": pa.array(score, pa.float64())})

    both = pairs.where("kind = 1").select("block", "ids", "numbers", "lone").unionByName(sums, allowMissingColumns=True)
    return both.groupBy("block").applyInArrow(run, f"`{id_col}` {id_type}, n_tokens long, n_known long, base_score double, score double")


def score(docs: DataFrame, train: Column, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Rows (id, n_tokens, n_known, train_tokens, base_score, score), one for each row of docs.

    The model learns from the rows for which `train` holds; base_score is that of the smoothed unigrams.
    """
    id_type = docs.select(id_col).schema[0].dataType.simpleString()
    chars, ends = docs.agg(F.sum(F.length(F.col(text_col))), F.sum(F.coalesce(train, F.lit(False)).cast("long"))).first()
    deal = Dealing.of(chars or 0, BLOCK_CHARS, GROUP_CHARS, ROW_CHARS)
    # Words are dealt to their groups once; the checkpoint keeps that, so steps 2 and 3 need no shuffle of their own.
    read = cut(_read(docs, train, deal, id_col, text_col, 0).select("place", "block", "a", "b", "c").repartition(deal.groups, "place"))
    words = cut(_bunched_words(read, deal).repartition(deal.groups, "place")) if deal.bunches else read
    histogram = cut(_histogram(words))
    levels = [(r["level"], r["n"]) for r in histogram.groupBy("level").agg(F.sum("n").alias("n")).collect()]
    counts, end = _count_table(levels, ends or 0)
    spark = docs.sparkSession
    # Where each group's words of a level begin: ranks of the level in order of the groups, after the end token's.
    first = spark.createDataFrame([(int(v), int(f) + (int(v) == (ends or 0))) for v, f in zip(counts.level, counts.first, strict=True)] or [(0, 0)], "level long, first long")
    before = Window.partitionBy("level").orderBy("place").rowsBetween(Window.unboundedPreceding, -1)
    starts = histogram.withColumn("before", F.coalesce(F.sum("n").over(before), F.lit(0))).join(first, "level").select("place", "level", (F.col("first") + F.col("before")).alias("start"))
    answers = _split_ranks(read, _ranks(words, starts)) if deal.bunches else _ranks(words, starts)
    texts = _pairs(answers, _read(docs, train, deal, id_col, text_col, 1), counts, end, deal, id_type)
    pairs = _bunched_pairs(texts, deal) if deal.bunches else texts
    found = _estimates(pairs, counts).collect()
    weights = learn([tuple(r) for r in found], counts.distinct)
    sums = _split_sums(texts, _sums(pairs, counts, weights)) if deal.bunches else _sums(pairs, counts, weights)
    out = _totals(texts, sums, counts, weights, id_col, id_type)
    return out.select(id_col, "n_tokens", "n_known", F.lit(counts.total).cast("long").alias("train_tokens"), "base_score", "score")
