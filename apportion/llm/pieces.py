"""SentencePiece encoding and decoding over a relational lattice.

Encoding follows the model file exactly, so its ids are those of the SentencePiece library: blanks become word marks,
one mark is put before the text, and the text falls into units that no piece can cross: before a run of marks and, if no
piece of the model mixes letters, digits and others or has two digits, between those. Distinct units are encoded once, as relations:

    1. each unit's substrings of at most the longest piece's length are exploded;
    2. an equi-join with the piece table keeps the substrings that are pieces: the lattice's edges;
    3. edges are grouped by unit, a byte-pair model's best score first;
    4. a fold over the grouped edges finds the unit's segmentation.

A unigram model's fold is Viterbi: the state holds the greatest sum of scores up to each character and the edge that
reached it, in arrays for a batch of units at a time, as an expression's steps through each unit took more time than all
the rest. A byte-pair model's scores are ranks of merges, and the greatest sum of ranks is not what its encoder gives;
so its fold, a higher-order one, replays the merges on the lattice: the state is a bit set of boundaries, and each step takes the best edge
that spans exactly two segments, the leftmost of equals. Characters that are no piece fall back to byte pieces. Units of
over LONGEST characters, whose lattice would be one row's state, are done in place by a heap of merges or by Viterbi over
the same pieces, with the same ids. (Sums are of single precision and by unit; the library's run on through the text, so
segmentations whose sums are equal but for rounding may differ from its choice.) load() refuses models that would need more: other types, normalisation rules, added
or suffixed blanks, no byte pieces, and pieces with a blank inside, which would cross units.

Texts don't move to be encoded: each task names the distinct units of blocks of texts, units are encoded in groups by
hash, and each block gets its units' ids back; so a frequent word is one row in each block. The blocks are read from
docs more than once, so docs must give the same rows in the same partitions and order each time, as tables and checkpoints do.

Null and empty texts have no ids and decode to empty. The word mark in a text is taken for a blank, as the library does.
"""

from __future__ import annotations

import heapq
import re
from collections import defaultdict
from dataclasses import dataclass, replace
from functools import cached_property
from itertools import count

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import offsets, text_batches
from .packed import Dealing, pack, pack_numbered, pack_sorted, unpack, unpack_numbered, unpack_sorted

MARK = "▁"
LONGEST = 62
BLOCK_CHARS, GROUP_CHARS, BATCH_ROWS = 1 << 22, 1 << 24, 1 << 10
"""Characters of a block and of a group at 2^29 characters of input; they grow with its root, up to 8 and 4 times."""
_WORDS = re.compile(r" +[^ ]*")


UNKNOWN_PENALTY = 10.0
"""How far an unknown character's score lies below the least score of a unigram model's pieces."""


@dataclass(frozen=True)
class Model:
    """Pieces that text can match, with ids and scores; byte pieces' ids by byte; the text of each id; whether scores are
    those of a unigram model, and then that of an unknown character."""

    pieces: dict[str, tuple[int, float]]
    byte_ids: tuple[int, ...]
    texts: tuple[bytes | None, ...]
    unigram: bool = False
    unknown: float = 0.0

    @property
    def longest(self) -> int:
        return max(map(len, self.pieces), default=1)

    @cached_property
    def units(self) -> re.Pattern:
        """What finds a text's units: runs of letters, digits one by one, and runs of others, unless a piece crosses these."""

        def kind(c):
            return 1 if c.isalpha() else 2 if c.isdecimal() else 0

        beside = {(kind(a), kind(b)) for p in self.pieces for a, b in zip(p, p[1:], strict=False) if a != MARK}
        if not all(a == b != 2 for a, b in beside):
            return _WORDS
        # Numbers that aren't decimal digits are word characters to a pattern, but no letters.
        odd = re.escape("".join(sorted({c for p in self.pieces for c in p if c.isalnum() and kind(c) == 0})))
        return re.compile(rf" *[^\W\d_{odd}]+| *\d| *(?:[^\w ]|[_{odd}])+| +")

    def units_of(self, text: str) -> list[str]:
        return [u.replace(" ", MARK) for u in self.units.findall(" " + text.replace(MARK, " "))] if text else []


def load(model_file: str) -> Model:
    from sentencepiece import sentencepiece_model_pb2

    proto = sentencepiece_model_pb2.ModelProto()
    with open(model_file, "rb") as f:
        proto.ParseFromString(f.read())
    trained, rules = proto.trainer_spec, proto.normalizer_spec
    pieces, texts, bytes_, least = {}, [], {}, 0.0
    kinds = sentencepiece_model_pb2.ModelProto.SentencePiece
    wrong = {
        "type": trained.model_type not in (trained.UNIGRAM, trained.BPE),
        "normalisation": bool(rules.precompiled_charsmap or rules.normalization_rule_tsv) or rules.remove_extra_whitespaces or not rules.escape_whitespaces,
        "blanks": not rules.add_dummy_prefix or trained.treat_whitespace_as_suffix,
        "pieces": any(p.type == kinds.USER_DEFINED or (p.type == kinds.NORMAL and MARK in p.piece.lstrip(MARK)) for p in proto.pieces),
    }
    for i, p in enumerate(proto.pieces):
        if p.type == kinds.BYTE:
            bytes_[int(p.piece[3:5], 16)] = i
            texts.append(bytes([int(p.piece[3:5], 16)]))
        elif p.type in (kinds.CONTROL, kinds.UNKNOWN):
            texts.append(None)
        else:
            texts.append(p.piece.replace(MARK, " ").encode())
            if p.type == kinds.NORMAL:
                pieces[p.piece] = (i, p.score)
                least = min(least, p.score)
    wrong["byte pieces"] = len(bytes_) < 256
    if any(wrong.values()):
        raise ValueError(f"this encoder does not do what the model asks for: {', '.join(k for k, v in wrong.items() if v)}")
    return Model(pieces, tuple(bytes_[b] for b in range(256)), tuple(texts), trained.model_type == trained.UNIGRAM, least - UNKNOWN_PENALTY)


def by_score(model: Model) -> Model:
    """The model as one whose segmentations are those of the greatest sum of scores, whatever it was trained for."""
    least = min((s for _, s in model.pieces.values()), default=0.0)
    return replace(model, unigram=True, unknown=min(0.0, least) - UNKNOWN_PENALTY)


def best_path(unit: str, model: Model) -> list[int]:
    """Ids of a unit by Viterbi, with sums of single precision as the library has them."""
    add, get, longest = np.float32, model.pieces.get, model.longest
    best: list = [add(0), *[None] * len(unit)]
    back: list = [None] * (len(unit) + 1)
    for at in range(len(unit)):
        single = False
        for to in range(at + 1, min(at + longest, len(unit)) + 1):
            if (p := get(unit[at:to])) is not None:
                single |= to == at + 1
                if best[to] is None or best[at] + add(p[1]) > best[to]:
                    best[to], back[to] = best[at] + add(p[1]), (at, [p[0]])
        if not single and (best[at + 1] is None or best[at] + add(model.unknown) > best[at + 1]):
            best[at + 1], back[at + 1] = best[at] + add(model.unknown), (at, [model.byte_ids[b] for b in unit[at].encode()])
    out, at = [], len(unit)
    while at:
        at, ids = back[at]
        out.append(ids)
    return [i for ids in reversed(out) for i in ids]


def merge(unit: str, model: Model) -> list[int]:
    """Ids of a unit: by a heap of merges, in time n log n, or by Viterbi if the model is a unigram one."""
    if model.unigram:
        return best_path(unit, model)
    n, get = len(unit), model.pieces.get
    end = list(range(1, n + 1))
    left, right = list(range(-1, n - 1)), [*range(1, n), -1]
    heap: list = []

    def offer(i):
        if i >= 0 and (j := right[i]) >= 0 and (p := get(unit[i : end[j]])) is not None:
            heapq.heappush(heap, (-p[1], i, end[i], end[j]))

    for i in range(n):
        offer(i)
    while heap:
        _, i, middle, stop = heapq.heappop(heap)
        j = right[i] if end[i] == middle else -1
        if j < 0 or end[j] != stop:
            continue
        end[i], right[i] = stop, right[j]
        if right[j] >= 0:
            left[right[j]] = i
        end[j] = -1
        offer(i)
        offer(left[i])
    out, i = [], 0
    while i >= 0:
        p = get(unit[i : end[i]])
        out += [p[0]] if p else [model.byte_ids[b] for b in unit[i : end[i]].encode()]
        i = right[i]
    return out


def lattice(units: DataFrame, spark: SparkSession, model: Model) -> DataFrame:
    """(unit, ids) for distinct units of at most LONGEST characters; `units` is already hashed by unit.

    An edge is one number, so that edges sort and travel cheaply: rank of its score, start, size, and id; a character
    that is no piece is an edge of the last rank whose id stands for none.
    """
    ranks = {s: k for k, s in enumerate(sorted({s for _, s in model.pieces.values()}, reverse=True))}
    none = (1 << 28) - 1
    table = spark.createDataFrame([(p, (0 if model.unigram else ranks[s] << 40) + i, s) for p, (i, s) in model.pieces.items()] or [("", 0, 0.0)], "piece string, known long, score float")
    if not model.unigram:
        table = table.drop("score")
    spans = (
        units.where(F.length("unit").between(1, LONGEST))
        .select("unit", F.length("unit").alias("n"))
        .select("*", F.explode(F.expr("sequence(0, n - 1)")).alias("start"))
        .select("*", F.explode(F.expr(f"sequence(1, least({model.longest}, n - start))")).alias("size"))
        .select("unit", "start", "size", F.expr("substring(unit, start + 1, size)").alias("piece"))
    )
    # The piece table is a vocabulary file's, so its size doesn't grow with the texts.
    edges = spans.join(F.broadcast(table), "piece", "left").where("known IS NOT NULL OR size = 1")
    edge = F.expr(f"coalesce(known, {(0 if model.unigram else 1 << 60) + none}L) + shiftleft(CAST(start AS BIGINT), 34) + shiftleft(CAST(size AS BIGINT), 28)")
    if model.unigram:
        edge = F.struct(edge.alias("edge"), F.coalesce("score", F.lit(model.unknown).cast("float")).alias("score"))
    if model.unigram:
        return edges.groupBy("unit").agg(F.collect_list(edge).alias("edges")).mapInArrow(_viterbi(model.byte_ids, none), "unit string, ids array<int>")
    words = edges.groupBy("unit").agg(F.sort_array(F.collect_list(edge)).alias("edges"))
    # What a fold needs more than once is bound to a variable of a one-element array, as the optimiser would repeat a column's expression at each use.
    known = F.array(*[F.lit(i) for i in model.byte_ids])

    def bind(value, body):
        return F.get(F.transform(F.array(value), body), F.lit(0))

    def bit(at):
        return F.call_function("shiftleft", F.lit(1).cast("long"), at)

    def start(e):
        return F.shiftright(e, 34).bitwiseAND(63).cast("int")

    def size(e):
        return F.shiftright(e, 28).bitwiseAND(63).cast("int")

    done = F.lit(-(1 << 63))  # the state's highest bit, which no boundary has: no edge is ready, nor will one be

    def fold(merges):
        def step(state, _):
            ready = F.filter(merges, lambda e: (F.bit_count(state.bitwiseAND(e["inside"])) == 1) & (state.bitwiseAND(e["ends"]) == e["ends"]))
            return F.when(state < 0, state).otherwise(F.coalesce(state.bitwiseAND(F.bitwise_not(F.get(ready, F.lit(0))["inside"])), state.bitwiseOR(done)))

        every = bit(F.length("unit") + 1) - 1
        return F.when(F.size(merges) == 0, every).otherwise(F.aggregate(F.sequence(F.lit(2), F.length("unit")), every, step))

    def raw(char):
        return F.transform(F.sequence(F.lit(1), F.octet_length(char)), lambda i: F.element_at(known, F.conv(F.substring(F.hex(F.encode(char, "UTF-8")), i * 2 - 1, F.lit(2)), 16, 10).cast("int") + 1))

    def ids_of(e):
        i = e.bitwiseAND(none)
        return F.when(i == none, raw(F.substring(F.col("unit"), start(e) + 1, F.lit(1)))).otherwise(F.array(i.cast("int")))

    spread = F.transform("edges", lambda e: F.struct((bit(start(e)) + bit(start(e) + size(e))).alias("ends"), (bit(start(e) + size(e)) - bit(start(e) + 1)).alias("inside"), e.bitwiseAND((1 << 40) - 1).alias("key")))

    def segmented(all_edges):
        def chosen(bounds):
            # Edges between neighbouring bounds, by start.
            whole = F.filter(all_edges, lambda e: (bounds.bitwiseAND(e["ends"]) == e["ends"]) & (bounds.bitwiseAND(e["inside"]) == 0))
            return F.flatten(F.transform(F.sort_array(F.transform(whole, lambda e: e["key"])), ids_of))

        return bind(bind(F.filter(all_edges, lambda e: e["inside"] > 0), fold), chosen)

    return words.select("unit", bind(spread, segmented).alias("ids"))


def _viterbi(byte_ids: tuple[int, ...], none: int):
    """What maps batches of (unit, edges) to (unit, ids): the path with the greatest sum of scores, of single precision.

    Edges of all units of a batch are taken by their end, so sums up to where they start are settled; of equal sums to a
    character the longest edge's stays. Each character has an edge of size 1, so each end is reached.
    """

    def paths(units: pa.Array, lists: pa.ListArray) -> pa.ListArray:
        flat = lists.flatten()
        edge, score = flat.field("edge").to_numpy(), flat.field("score").to_numpy()
        row = np.repeat(np.arange(len(lists)), np.diff(lists.offsets.to_numpy()))
        start = edge >> 34 & 63
        end = start + (edge >> 28 & 63)
        order = np.argsort(end << 48 | row << 6 | start)
        edge, score, row, start, end = (x[order] for x in (edge, score, row, start, end))
        best = np.zeros((len(lists), LONGEST + 1), dtype=np.float32)
        back = np.zeros((len(lists), LONGEST + 1), dtype=np.int64)
        at = np.flatnonzero(np.diff(end, prepend=0))
        for i, j in zip(at.tolist(), [*at[1:].tolist(), len(end)], strict=True):
            r, total = row[i:j], best[row[i:j], start[i:j]] + score[i:j]
            new = np.flatnonzero(np.diff(r, prepend=-1))
            top = np.flatnonzero(total == np.repeat(np.maximum.reduceat(total, new), np.diff(np.append(new, j - i))))
            top = top[np.diff(r[top], prepend=-1) > 0]
            best[r[top], end[i]], back[r[top], end[i]] = total[top], i + top
        # All paths are walked back together; then their edges are put in order of unit and start.
        place, left, chosen = np.zeros(len(lists), dtype=np.int64), np.arange(len(lists)), []
        np.maximum.at(place, row, end)
        while len(left):
            own = back[left, place[left]]
            chosen.append(own)
            place[left] = start[own]
            left = left[start[own] > 0]
        own = np.concatenate(chosen)
        own = own[np.argsort(row[own] << 6 | start[own])]
        ids = edge[own] & none
        size = np.ones(len(own), dtype=np.int64)
        raw = [(k, np.array([byte_ids[b] for b in units[row[own[k]]].as_py()[start[own[k]]].encode()])) for k in np.flatnonzero(ids == none).tolist()]
        for k, x in raw:
            size[k] = len(x)
        to = offsets(size)
        out = np.repeat(ids, size)
        for k, x in raw:
            out[to[k] : to[k + 1]] = x
        first = np.searchsorted(row[own], np.arange(len(lists) + 1))
        return pa.ListArray.from_arrays(pa.array(to[first], pa.int32()), pa.array(out, pa.int32()))

    def run(batches):
        for batch in batches:
            if batch.num_rows:
                units = batch.column("unit")
                yield pa.RecordBatch.from_arrays([units, paths(units, batch.column("edges"))], names=["unit", "ids"])

    return run


def _blocks(batches, model: Model, chars: int | None = None):
    """(block, ids, texts' numbers of units, units' numbers, units in order of number) of this partition's blocks.

    A block's name is a hash of its partition's number, its own in the partition and its texts, so every reading of it has
    the same name, and blocks of equal texts have names of their own.
    """
    import xxhash
    from pyspark import TaskContext

    find, part, ordinal = model.units.findall, TaskContext.get().partitionId(), count()

    def fresh():
        return [], [], [], defaultdict(count().__next__), 0, xxhash.xxh64(f"{part} {next(ordinal)} ".encode())

    ids, lengths, seq, number, size, name = fresh()
    for batch, texts in text_batches(batches):
        for i, t in zip(batch.column(0).to_pylist(), texts, strict=True):
            before = len(seq)
            if t:
                seq.extend(map(number.__getitem__, find(" " + t.replace(MARK, " "))))
            ids.append(i)
            lengths.append(len(seq) - before)
            size += len(t)
            name.update(t.encode() + b"\xff")
            if size >= (chars or BLOCK_CHARS):
                yield name.intdigest() - (1 << 63), ids, lengths, seq, [u.replace(" ", MARK) for u in number]
                ids, lengths, seq, number, size, name = fresh()
    if ids:
        yield name.intdigest() - (1 << 63), ids, lengths, seq, [u.replace(" ", MARK) for u in number]


def _pack_texts(texts: list[str]) -> bytes:
    import zstandard

    lengths = pack(np.array([len(t) for t in texts]))
    return len(lengths).to_bytes(8, "little") + lengths + zstandard.ZstdCompressor(level=1).compress("".join(texts).encode())


def _unpack_texts(data: bytes) -> list[str]:
    import zstandard

    size = int.from_bytes(data[:8], "little")
    at = offsets(unpack(data[8 : 8 + size]).astype(np.int64)).tolist()
    joined = zstandard.ZstdDecompressor().decompressobj().decompress(data[8 + size :]).decode()
    return [joined[a:b] for a, b in zip(at, at[1:], strict=False)]


PLACED = "kind int, place long, block long, a binary, b binary, ids array<{id}>"
"""kind 0: units of a block in the group `place`: texts (a) and numbers in the block (b). kind 1: a block's texts, at its
own place: numbers of units of each text (a), units' numbers (b), and ids."""


ROW_CHARS = 1 << 14
"""Characters of text that a row from a block to a group stands for at least; below it, blocks deal in two levels."""


def dealing(chars: int) -> Dealing:
    return Dealing.of(chars, BLOCK_CHARS, GROUP_CHARS, ROW_CHARS)


def encode(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Rows (id, ids), one for each row of docs: the ids of its text's pieces, in order."""
    import zlib

    spark = docs.sparkSession
    # Units are already together by partition, about 2^14 in each; without this, grouping their edges would sort them all.
    spark.conf.set("spark.sql.objectHashAggregate.sortBased.fallbackThreshold", 1 << 17)
    # Whole texts and lists of ids travel in batches, so a batch of the usual 10,000 rows takes tens of megabytes on either side.
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS)
    kept = docs.select(id_col, F.col(text_col).alias("text"))
    id_type = kept.schema[0].dataType.simpleString()
    chars = kept.agg(F.sum(F.length("text"))).first()[0] or 0
    deal = dealing(chars)
    groups = deal.groups
    sent = spark.sparkContext.broadcast(model)

    def by_place(units: list[str], block: int | None):
        """(place, numbers of units) of a block's units, or of a bunch's, which go to their groups."""
        place = np.fromiter(map(zlib.crc32, map(str.encode, units)), dtype=np.int64, count=len(units)) % groups
        place = place if block is None else deal.place(block, place)
        order = np.argsort(place, kind="stable")
        starts = np.flatnonzero(np.diff(place[order], prepend=np.iinfo(np.int64).min))
        for own in np.split(order, starts[1:]) if len(order) else ():
            yield int(place[own[0]]), own

    def name(batches):
        kind = None

        def seen(it):
            nonlocal kind
            for b in it:
                kind = b.schema.field(0).type
                yield b

        for block, ids, lengths, seq, units in _blocks(seen(batches), sent.value, deal.block_chars):
            rows = [(0, g, block, _pack_texts([units[k] for k in own.tolist()]), pack_sorted(own), None) for g, own in by_place(units, block)]
            rows.append((1, block, block, pack(np.array(lengths)), pack_numbered(np.array(seq)), ids))
            types = (pa.int32(), pa.int64(), pa.int64(), pa.binary(), pa.binary(), pa.list_(kind))
            for k in range(0, len(rows), 64):
                cols = zip(*rows[k : k + 64], strict=True)
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types, strict=True)], names=["kind", "place", "block", "a", "b", "ids"])

    # One shuffle by place serves the three uses below, so the texts are read once.
    placed = kept.mapInArrow(name, PLACED.format(id=id_type))

    def of_kind(table: pa.Table, kind: int) -> pa.Table:
        return table.filter(pa.compute.equal(table.column("kind"), kind))

    def gather(table: pa.Table) -> pa.Table:
        """Rows to groups for those that a bunch's blocks send to a range of groups: each unit once, numbered in order."""
        place = table.column("place")[0].as_py()
        every = sorted({u for x in of_kind(table, 0).column("a").to_pylist() for u in _unpack_texts(x)})
        rows = [(0, g, place, _pack_texts([every[k] for k in own.tolist()]), pack_sorted(own), None) for g, own in by_place(every, None)]
        return pa.Table.from_arrays([pa.array(c, f.type) for c, f in zip(list(zip(*rows, strict=True)) or [[]] * 6, table.schema, strict=True)], schema=table.schema)

    def distinct(table: pa.Table) -> pa.Table:
        return pa.table({"unit": pa.array({u for x in of_kind(table, 0).column("a").to_pylist() for u in _unpack_texts(x) if len(u) <= LONGEST}, pa.string())})

    # Groups are hashes of units, so their units are distinct over all groups. The number of partitions is given, as the
    # work on a unit is much more than its size.
    at_groups = placed.where("kind = 0").groupBy("place").applyInArrow(gather, PLACED.format(id=id_type)) if deal.bunches else placed
    units = at_groups.groupBy("place").applyInArrow(distinct, "unit string").repartition(groups * 4, "unit")
    encoded = lattice(units, spark, model).withColumn("place", F.pmod(F.crc32(F.col("unit").cast("binary")), F.lit(groups)).cast("long"))
    answer_schema = pa.schema([("place", pa.int64()), ("numbers", pa.binary()), ("sizes", pa.binary()), ("flat", pa.binary())])

    def answer(table: pa.Table, own: pa.Table) -> pa.Table:
        lists = own.column("ids").combine_chunks()
        flat, ends = np.asarray(lists.flatten(), dtype=np.int64), np.asarray(lists.offsets, dtype=np.int64) if own.num_rows else np.zeros(1, dtype=np.int64)
        ends = ends - ends[0]
        known = {u: k for k, u in enumerate(own.column("unit").to_pylist())}
        n_known = len(known)
        size, start = np.diff(ends), ends[:-1]
        rows = []
        for block, a, b in zip(*(of_kind(table, 0).column(c).to_pylist() for c in ("block", "a", "b")), strict=True):
            units = _unpack_texts(a)
            for u in units:
                if u not in known:  # too long for the lattice
                    x = np.array(merge(u, sent.value), dtype=np.int64)
                    known[u] = len(size)
                    start, size, flat = np.append(start, len(flat)), np.append(size, len(x)), np.concatenate([flat, x])
            at = np.fromiter((known[u] for u in units), dtype=np.int64, count=len(units))
            ids = flat[np.repeat(start[at] - offsets(size[at])[:-1], size[at]) + np.arange(size[at].sum())]
            rows.append((block, b, pack(size[at]), pack(ids)))
        assert all(len(u) > LONGEST for u in list(known)[n_known:])
        cols = list(zip(*rows, strict=True)) or [[]] * 4
        return pa.Table.from_arrays([pa.array(c, f.type) for c, f in zip(cols, answer_schema, strict=True)], schema=answer_schema)

    answers = at_groups.groupBy("place").cogroup(encoded.groupBy("place")).applyInArrow(answer, "place long, numbers binary, sizes binary, flat binary")

    def split(table: pa.Table, got: pa.Table) -> pa.Table:
        """Answers to blocks from those to their bunch's range of groups."""
        sent_rows = of_kind(table, 0).select(["block", "a", "b"]).to_pylist()
        blocks = [(r["block"], r["b"], _unpack_texts(r["a"])) for r in sent_rows]
        number = {u: k for k, u in enumerate(sorted({u for *_, units in blocks for u in units}))}
        size, start, flat, at = np.zeros(len(number), dtype=np.int64), np.zeros(len(number), dtype=np.int64), [np.zeros(0, dtype=np.int64)], 0
        for num, sizes, x in zip(*(got.column(c).to_pylist() for c in ("numbers", "sizes", "flat")), strict=True) if number else ():
            places, own = unpack_sorted(num).astype(np.int64), unpack(sizes).astype(np.int64)
            size[places], start[places] = own, at + offsets(own)[:-1]
            flat.append(unpack(x).astype(np.int64))
            at += int(own.sum())
        every, rows = np.concatenate(flat), []
        for block, b, units in blocks:
            k = np.fromiter((number[u] for u in units), dtype=np.int64, count=len(units))
            rows.append((block, b, pack(size[k]), pack(every[np.repeat(start[k] - offsets(size[k])[:-1], size[k]) + np.arange(size[k].sum())])))
        return pa.Table.from_arrays([pa.array(c, f.type) for c, f in zip(list(zip(*rows, strict=True)) or [[]] * 4, answer_schema, strict=True)], schema=answer_schema)

    if deal.bunches:
        answers = placed.groupBy("place").cogroup(answers.groupBy("place")).applyInArrow(split, "place long, numbers binary, sizes binary, flat binary")

    def assemble(table: pa.Table, got: pa.Table) -> pa.Table:
        text = of_kind(table, 1)
        schema = pa.schema([(id_col, table.schema.field("ids").type.value_type), ("ids", pa.list_(pa.int32()))])
        numbers = [unpack_sorted(x).astype(np.int64) for x in got.column("numbers").to_pylist()] if text.num_rows else []
        n = max((int(x.max()) + 1 for x in numbers if len(x)), default=0)
        size, start = np.full(n, -1, dtype=np.int64), np.zeros(n, dtype=np.int64)
        flat, at = [np.zeros(0, dtype=np.int32)], 0
        for num, s, x in zip(numbers, *(got.column(c).to_pylist() for c in ("sizes", "flat")), strict=True) if text.num_rows else ():
            own = unpack(s).astype(np.int64)
            size[num], start[num] = own, at + offsets(own)[:-1]
            flat.append(unpack(x).astype(np.int32))
            at += int(own.sum())
        every = np.concatenate(flat)
        made = []
        for row in text.select(["ids", "a", "b"]).to_batches(max_chunksize=1):
            seq = unpack_numbered(row.column("b")[0].as_py())
            if len(seq) and (int(seq.max()) >= n or (size < 0).any()):
                raise RuntimeError("docs gave other rows when they were read again: pass a table or a checkpoint")
            ends = offsets(size[seq])
            ids = every[np.repeat(start[seq] - ends[:-1], size[seq]) + np.arange(ends[-1])]
            cut_at = ends[offsets(unpack(row.column("a")[0].as_py()).astype(np.int64))]
            batch = pa.RecordBatch.from_arrays([row.column("ids").flatten(), pa.ListArray.from_arrays(pa.array(cut_at, pa.int32()), pa.array(ids, pa.int32()))], schema=schema)
            made += [batch.slice(k, 128) for k in range(0, batch.num_rows, 128)]
        return pa.Table.from_batches(made, schema=schema)

    return placed.groupBy("place").cogroup(answers.groupBy("place")).applyInArrow(assemble, f"`{id_col}` {id_type}, ids array<int>")


def decode(encoded: DataFrame, model: Model, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """Rows (id, text): each list of ids as text; control ids give nothing, ids out of range are an error."""
    sent = encoded.sparkSession.sparkContext.broadcast(model)
    kept = encoded.select(id_col, F.col(ids_col).alias("ids"))

    def run(batches):
        texts = [t or b"" for t in sent.value.texts]
        for batch in batches:
            lists = batch.column("ids")
            flat, ends = lists.values.to_numpy(), lists.offsets.to_pylist()
            out = [b"".join([texts[i] for i in flat[a:b].tolist()]).decode("utf-8", "replace").removeprefix(" ") for a, b in zip(ends, ends[1:], strict=False)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, pa.string())], names=[id_col, "text"])

    return kept.mapInArrow(run, f"`{id_col}` {kept.schema[0].dataType.simpleString()}, text string")
