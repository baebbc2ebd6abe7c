"""Words of a batch of texts as arrays: where they lie in the texts' bytes, and whose they are."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from .common import offsets

BLOCK_BYTES = 1 << 23

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32  # only A-Z
LETTER = np.zeros(256, dtype=bool)
LETTER[97:123] = LETTER[128:] = True  # of lower-cased bytes; every byte of a character beyond ASCII is from 128 up
LETTER_OR_DIGIT = LETTER.copy()
LETTER_OR_DIGIT[48:58] = True


@dataclass(frozen=True)
class Words:
    """Words of some texts in order, those of a text next to each other: `data` has their bytes end to end, `length` how many
    each has, `text` which text it is of."""

    data: np.ndarray
    length: np.ndarray
    text: np.ndarray

    def coded(self) -> tuple[np.ndarray, pa.Array]:
        """The number of each word among the distinct words, and these, as binary values."""
        every = pa.Array.from_buffers(pa.large_binary(), len(self.length), [None, pa.py_buffer(offsets(self.length)), pa.py_buffer(self.data)])
        coded = every.dictionary_encode()
        return coded.indices.to_numpy(zero_copy_only=False).astype(np.int64), coded.dictionary


def words(raw: np.ndarray, at: np.ndarray, member: np.ndarray) -> Words:
    """Words, with A-Z lower-cased, of texts laid end to end in `raw`, from one place of `at` to the next; `member` has the
    bytes that words are made of."""
    low = LOWER[raw]
    inside = member[low]
    first = inside.copy()
    first[1:] &= ~inside[:-1]
    last = inside.copy()
    last[:-1] &= ~inside[1:]
    # A word ends with its text.
    edges = at[(at > 0) & (at < len(raw))]
    first[edges] = inside[edges]
    last[edges - 1] = inside[edges - 1]
    start = np.flatnonzero(first)
    return Words(low[inside], np.flatnonzero(last) + 1 - start, np.searchsorted(at, start, "right") - 1)


def text_bytes(column) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of a column of texts laid end to end, and where each text begins, with the end of the last; null: empty."""
    flat = pc.fill_null(column.cast(pa.large_string()), "")
    flat = flat.combine_chunks() if isinstance(flat, pa.ChunkedArray) else flat
    if not len(flat):
        return np.zeros(0, dtype=np.uint8), np.zeros(1, dtype=np.int64)
    _, places, data = flat.buffers()
    at = np.frombuffer(places, dtype=np.int64)[flat.offset : flat.offset + len(flat) + 1]
    raw = np.frombuffer(data, dtype=np.uint8)[at[0] : at[-1]] if data is not None else np.zeros(0, dtype=np.uint8)
    return raw, at - at[0]


_letters: list[np.ndarray] = []


def letter_codes(texts: list[str], tail: int) -> tuple[np.ndarray, np.ndarray]:
    """Lower-cased code points, 0 for anything but letters, of texts laid end to end with a 0 before each and `tail` of them
    at the end; and where each text begins, with the end of the last."""
    if not _letters:
        _letters.append(np.fromiter((chr(i).isalpha() for i in range(0x110000)), dtype=bool, count=0x110000))
    raw = [("\0" + t.lower()).encode("utf-32-le", "replace") for t in texts]
    x = np.frombuffer(b"".join(raw) + b"\0" * 4 * tail, dtype=np.uint32)
    return np.where(_letters[0][x], x, np.uint32(0)), offsets([len(r) // 4 for r in raw])


def blocks(column, size: int = BLOCK_BYTES):
    """(first, last, bytes, offsets) of runs of whole texts of about `size` bytes; a longer text is a run of its own."""
    raw, at = text_bytes(column)
    i, n = 0, len(at) - 1
    while i < n:
        j = max(i + 1, int(np.searchsorted(at, at[i] + size, "right")) - 1)
        yield i, j, raw[at[i] : at[j]], at[i : j + 1] - at[i]
        i = j
