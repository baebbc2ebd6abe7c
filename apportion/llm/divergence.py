"""How far sources of a language differ in their words: exact divergences between sources, and the terms that mark one.

Terms are counted by sorting and streaming. In a task, the words of a block of texts are numbered, sorted by language, term,
source and text, and scanned in runs: a run gives the number of texts and of occurrences of a term in a source. These rows
are dealt by (language, term), sorted by (language, term, source) and scanned again: a run of a language and a term gives
its document frequency and its count in each source. Terms of enough documents are kept and get their smoothed shares in
whole billionths; their runs are dealt and scanned once more, and give partial sums for pairs of sources that share the
term, and a row for each source that uses it more than its language.

The sum of a pair over all kept terms needs a term that only one of two sources has, too. Such a term adds a number that
depends on its count in the one source and on the other source's share of an absent term, so it is summed over the
distinct counts of each source; terms that neither has add one number, times how many there are. Runs hold a row for each
source at most, however often a term occurs.

A row is a document, so rows that repeat an id count as many. Null texts have no terms; null languages and sources are ''.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import cut
from .words import LETTER, blocks, words

UNIT = 1_000_000_000
LEAST_DOCUMENTS = 10
TOP_TERMS = 10
BLOCK = 1 << 25
"""Bytes of texts that are sorted at once in a task; a longer text is a block of its own."""
SPILL = 1 << 20
"""Partial sums of pairs that a task holds before it passes them on."""


def _runs(*columns: np.ndarray) -> np.ndarray:
    """Where runs of rows begin that agree in all columns."""
    new = np.zeros(len(columns[0]), dtype=bool)
    new[:1] = True
    for c in columns:
        new[1:] |= c[1:] != c[:-1]
    return np.flatnonzero(new)


def term_counts(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", source_col: str = "source") -> DataFrame:
    """Rows (lang, term, source, docs, n) of blocks of texts; a term and source may have several."""

    def run(batches):
        for batch in batches:
            langs, sources = (batch.column(k).dictionary_encode() for k in (1, 2))
            lang, source = (x.indices.to_numpy(zero_copy_only=False).astype(np.int64) for x in (langs, sources))
            for first, end, raw, at in blocks(batch.column(0), BLOCK):
                w = words(raw, at, LETTER)
                term, terms = w.coded()
                # Texts are numbered by (language, source), so a sort by (term, text) is one by (term, language, source, text).
                group = lang[first:end] * len(sources.dictionary) + source[first:end]
                order = np.argsort(group, kind="stable")
                number = np.empty_like(order)
                number[order] = np.arange(len(order))
                keys = np.sort(term * (end - first) + number[w.text])
                starts = _runs(keys)
                n = np.diff(starts, append=len(keys))
                term, text = np.divmod(keys[starts], max(1, end - first))
                group = group[order][text]
                starts = _runs(term, group)
                if not len(starts):
                    continue
                group = group[starts]
                yield pa.RecordBatch.from_arrays(
                    [
                        langs.dictionary.take(pa.array(group // len(sources.dictionary))),
                        terms.view(pa.large_string()).take(pa.array(term[starts])).cast(pa.string()),
                        sources.dictionary.take(pa.array(group % len(sources.dictionary))),
                        pa.array(np.diff(starts, append=len(term))),
                        pa.array(np.add.reduceat(n, starts)),
                    ],
                    names=["lang", "term", "source", "docs", "n"],
                )

    own = docs.select(F.col(text_col).alias("text"), *[F.coalesce(F.col(c), F.lit("")).alias(f"c{k}") for k, c in enumerate((lang_col, source_col))])
    return own.mapInArrow(run, "lang string, term string, source string, docs long, n long")


def _streamed(batches, keys: int):
    """Tables of sorted rows in which every run of the first `keys` columns is whole."""
    held = None
    for batch in batches:
        if not batch.num_rows:
            continue
        table = pa.Table.from_batches([batch])
        table = table if held is None else pa.concat_tables([held, table])
        same = np.ones(table.num_rows, dtype=bool)
        for k in range(keys):
            same &= pc.equal(table.column(k), table.column(k)[table.num_rows - 1]).to_numpy()
        last = int(np.argmax(same))
        if last:
            yield table.slice(0, last)
        held = table.slice(last)
    if held is not None:
        yield held


def _codes(column: pa.ChunkedArray) -> np.ndarray:
    return column.combine_chunks().dictionary_encode().indices.to_numpy(zero_copy_only=False)


def _sorted_runs(rows: DataFrame) -> DataFrame:
    """Rows whose runs of a language and a term lie together, sources in order."""
    return rows.repartition("lang", "term").sortWithinPartitions("lang", "term", "source")


def kept_terms(counts: DataFrame, least: int = LEAST_DOCUMENTS) -> DataFrame:
    """Rows (lang, term, source, n, n_lang, first) of the terms in at least `least` documents of their language: occurrences
    in the source and in the language, and whether the row is its run's first."""

    def run(batches):
        for table in _streamed(batches, 2):
            starts = _runs(_codes(table.column(0)), _codes(table.column(1)))
            size = np.diff(starts, append=table.num_rows)
            docs, n = (np.repeat(np.add.reduceat(table.column(c).to_numpy(), starts), size) for c in ("docs", "n"))
            first = np.zeros(table.num_rows, dtype=bool)
            first[starts] = True
            out = table.select(["lang", "term", "source", "n"]).append_column("n_lang", pa.array(n)).append_column("first", pa.array(first))
            yield from out.filter(pa.array(docs >= least)).to_batches()

    # Blocks' rows are added up after they are dealt, as the dealing holds for sources too; a run then has a row a source.
    sums = counts.repartition("lang", "term").groupBy("lang", "term", "source").agg(F.sum("docs").alias("docs"), F.sum("n").alias("n"))
    return sums.sortWithinPartitions("lang", "term", "source").mapInArrow(run, "lang string, term string, source string, n long, n_lang long, first boolean")


def share(n: Column, total: Column, terms: Column) -> Column:
    """Smoothed share of a count in whole billionths; exact, as a decimal holds the product."""
    top = (n + 2).cast("decimal(20,0)") * F.lit(UNIT).cast("decimal(10,0)")
    return F.call_function("div", top, (total + 2 * terms).cast("decimal(20,0)")).cast("long") + 1


def distance(p, q):
    """Of two shares, as numbers, arrays or columns of whole numbers: below 2^63, as shares are at most UNIT + 1."""
    over, under = (p - q) * (p - q), p + q
    return F.call_function("div", over, under) if isinstance(over, Column) else over // under


def shared_terms(rows: DataFrame) -> DataFrame:
    """Partial sums (lang, a, b, x) over terms that two sources a < b share, of what their sum has beyond that of terms that
    only one of them has. rows (lang, term, source, p, p0) hold a source's shares of the term and of an absent one."""

    def run(batches):
        known: dict[tuple[str, str], int] = {}
        keys, sums = np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)

        def passed_on():
            names = list(known)
            a, b = ([names[i] for i in part.tolist()] for part in (keys >> 32, keys & 0xFFFFFFFF))
            return pa.RecordBatch.from_arrays([pa.array([x[0] for x in a], pa.string()), pa.array([x[1] for x in a], pa.string()), pa.array([x[1] for x in b], pa.string()), pa.array(sums)], names=["lang", "a", "b", "x"])

        for table in _streamed(batches, 2):
            lang, source = _codes(table.column(0)), _codes(table.column(2))
            starts = _runs(lang, _codes(table.column(1)))
            group = lang.astype(np.int64) << 32 | source
            distinct, at, code = np.unique(group, return_index=True, return_inverse=True)
            own = np.array([known.setdefault((table.column(0)[i].as_py(), table.column(2)[i].as_py()), len(known)) for i in at.tolist()], dtype=np.int64)[code]
            p, p0 = table.column("p").to_numpy(), table.column("p0").to_numpy()
            # Each row meets the rows of its run that follow it.
            follow = np.repeat(starts + np.diff(starts, append=table.num_rows), np.diff(starts, append=table.num_rows)) - 1 - np.arange(table.num_rows)
            before, row = np.concatenate([[0], np.cumsum(follow)]), 0
            while row < table.num_rows:
                end = max(row + 1, int(np.searchsorted(before, before[row] + SPILL, "right")) - 1)
                i = np.repeat(np.arange(row, end), follow[row:end])
                j = i + 1 + np.arange(len(i)) - (before[i] - before[row])
                x = distance(p[i], p[j]) - distance(p[i], p0[j]) - distance(p0[i], p[j]) + distance(p0[i], p0[j])
                keys, where = np.unique(np.concatenate([keys, own[i] << 32 | own[j]]), return_inverse=True)
                more = np.zeros(len(keys), dtype=np.int64)
                np.add.at(more, where, np.concatenate([sums, x]))
                sums, row = more, end
                if len(keys) > SPILL:
                    yield passed_on()
                    keys, sums = keys[:0], sums[:0]
        yield passed_on()

    return _sorted_runs(rows).select("lang", "term", "source", "p", "p0").mapInArrow(run, "lang string, a string, b string, x long")


def audit(docs: DataFrame, least: int = LEAST_DOCUMENTS, top: int = TOP_TERMS, text_col: str = "text", lang_col: str = "lang", source_col: str = "source") -> DataFrame:
    """Rows (lang, source, part, item, value, rank).

    Part `pair`: each other source of the language, with the divergence of the two. Part `term`: the `top` kept terms that
    diverge most among those which the source uses more than its language. Ranks are by falling value, then by item.
    """
    kept = cut(kept_terms(term_counts(docs, text_col, lang_col, source_col), least))
    named = docs.select(F.coalesce(lang_col, F.lit("")).alias("lang"), F.coalesce(source_col, F.lit("")).alias("source")).distinct()
    totals = kept.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    langs = kept.groupBy("lang").agg(F.sum(F.col("first").cast("long")).alias("terms"), F.sum("n").alias("lang_total"))
    zero = {"total": 0, "terms": 0, "lang_total": 0}
    groups = named.join(totals, ["lang", "source"], "left").join(langs, "lang", "left").fillna(zero)
    groups = cut(groups.withColumn("p0", F.when(F.col("terms") > 0, share(F.lit(0).cast("long"), F.col("total"), F.col("terms")))))
    shares = kept.join(groups, ["lang", "source"]).withColumn("p", share(F.col("n"), F.col("total"), F.col("terms")))

    q = share(F.col("n_lang"), F.col("lang_total"), F.col("terms"))
    above = shares.withColumn("q", q).where("p > q")
    terms = above.select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), distance(F.col("p"), F.col("q")).alias("value"))

    other = groups.select("lang", F.col("source").alias("other"), F.col("p0").alias("other_p0"))
    # Terms that neither has, all taken as such; then what terms of one source add to that, whatever the other has; then what both having them does.
    pairs = groups.join(other, "lang").where("source != other")
    absent = pairs.select("lang", "source", "other", F.coalesce(F.col("terms") * distance(F.col("p0"), F.col("other_p0")), F.lit(0)).alias("x"))
    levels = shares.groupBy("lang", "source", "p", "p0").agg(F.count("*").alias("times"))
    single = levels.join(other, "lang").where("source != other").select("lang", "source", "other", (F.col("times") * (distance(F.col("p"), F.col("other_p0")) - distance(F.col("p0"), F.col("other_p0")))).alias("x"))
    both = shared_terms(shares).select("lang", F.col("a").alias("source"), F.col("b").alias("other"), "x")
    once = single.unionByName(both).groupBy("lang", "source", "other").agg(F.sum("x").alias("x"))
    each_way = once.select("lang", F.inline(F.array(F.struct("source", "other", "x"), F.struct(F.col("other").alias("source"), F.col("source").alias("other"), "x"))))
    parts = absent.unionByName(each_way)
    sums = parts.groupBy("lang", "source", "other").agg(F.sum("x").alias("value"))
    pair = sums.select("lang", "source", F.lit("pair").alias("part"), F.col("other").alias("item"), "value")

    def ranked(df: DataFrame) -> DataFrame:
        return df.withColumn("rank", F.row_number().over(Window.partitionBy("lang", "source", "part").orderBy(F.col("value").desc(), "item")))

    return ranked(pair).unionByName(ranked(terms).where(F.col("rank") <= top))
