"""Token counts: greedy longest-match word pieces, counted in linear time without building the pieces.

The vocabulary is a trie of word-initial pieces and continuation pieces. Each node has a failure link and the number of
pieces that are popped when the scan fails there; so a word's count is a sum over the failures on its path, found in
time linear in its length. The vocabulary comes from the pieces of a SentencePiece file: a piece with a leading word
mark begins a word, any other piece continues one. Words are runs of bytes other than ASCII white space; a word that
can't be covered counts as one unknown piece, as word-piece encoders do.

Null and empty texts count zero. Counts of words are remembered in each task up to MEMO words, then dropped, so memory
is bounded and results don't depend on it.
"""

from __future__ import annotations

from collections import Counter

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import text_batches

MARK = "▁"
MEMO = 200_000


def pieces(model_file: str) -> tuple[list[str], list[str]]:
    """(word-initial, continuation) pieces of a SentencePiece model; control and byte pieces are left out."""
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=model_file)
    own = [sp.id_to_piece(i) for i in range(sp.get_piece_size()) if not (sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i))]
    return [p[1:] for p in own if p.startswith(MARK) and len(p) > 1 and MARK not in p[1:]], [p for p in own if MARK not in p]


class Automaton:
    """The automaton. Nodes are numbers; 0 is the root for word starts, 1 the root for continuations."""

    def __init__(self, initial: list[str], continuing: list[str]):
        self.next: list[dict[str, int]] = [{}, {}]
        depth_of, ends = [0, 0], [False, False]
        for root, words in ((0, initial), (1, continuing)):
            for w in words:
                v = root
                for c in w:
                    u = self.next[v].get(c)
                    if u is None:
                        u = self.next[v][c] = len(self.next)
                        self.next.append({})
                        depth_of.append(depth_of[v] + 1)
                        ends.append(False)
                    v = u
                ends[v] = w != ""
        # fail[v]: node for what is left after popping the longest pieces of v's path; -1 if nothing can be popped.
        self.fail, self.popped = [-1] * len(self.next), [0] * len(self.next)
        level = [0, 1]
        while level:
            below = []
            for v in level:
                for c, u in self.next[v].items():
                    if ends[u]:
                        self.fail[u], self.popped[u] = 1, 1
                    else:
                        z, n = self.fail[v], self.popped[v]
                        while z != -1 and c not in self.next[z]:
                            n += self.popped[z]
                            z = self.fail[z]
                        if z != -1:
                            self.fail[u], self.popped[u] = self.next[z][c], n
                    below.append(u)
            level = below

    def count(self, word: str) -> int:
        """Pieces of a non-empty word; 1 (the unknown piece) if it can't be covered."""
        follow, fail, popped = self.next, self.fail, self.popped
        v, n = 0, 0
        for c in word:
            u = follow[v].get(c)
            while u is None:
                n += popped[v]
                v = fail[v]
                if v == -1:
                    return 1
                u = follow[v].get(c)
            v = u
        while v != 1:
            n += popped[v]
            v = fail[v]
            if v == -1:
                return 1
        return n


def token_counts(docs: DataFrame, initial: list[str], continuing: list[str], id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Rows (id, n_words, n_tokens), one for each row of docs. The vocabulary goes to the tasks, so its size is the caller's bound."""
    id_type = docs.select(id_col).schema[0]
    sent = docs.sparkSession.sparkContext.broadcast((initial, continuing))

    def run(batches):
        automaton, memo = Automaton(*sent.value), {}
        for part, texts in text_batches(batches):
            words, tokens = [], []
            for text in texts:
                each = text.encode().split()
                total = 0
                for w, k in Counter(each).items():
                    n = memo.get(w)
                    if n is None:
                        if len(memo) >= MEMO:
                            memo.clear()
                        n = memo[w] = automaton.count(w.decode())
                    total += n * k
                words.append(len(each))
                tokens.append(total)
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array(words, pa.int64()), pa.array(tokens, pa.int64())], names=[id_col, "n_words", "n_tokens"])

    return docs.select(id_col, F.col(text_col).alias("text")).mapInArrow(run, f"`{id_col}` {id_type.dataType.simpleString()}, n_words long, n_tokens long")
