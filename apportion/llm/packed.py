"""Packed columns of whole numbers, so that a shuffle carries a few bytes for each token rather than a row."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np


def growth(chars: int, most: int) -> int:
    """How many times larger blocks or groups are than at 2^29 characters: as the square root of the input, `most` at most.

    Each block sends one row to each group. Were both of one size at all inputs, rows would grow with the square of the
    input and hold ever fewer numbers; growing as the root, rows grow with the input and keep their size, until memory
    sets `most`.
    """
    return max(1, min(most, round((chars / (1 << 29)) ** 0.5)))


@dataclass(frozen=True)
class Dealing:
    """How packed rows travel: blocks of `block_chars` characters to `groups` groups or, with `bunches` above zero, by way of
    bunches of blocks: a block sends a row to each of `ranges` ranges of groups in its bunch, and a bunch's range one to each of its
    groups.

    Were there one level only, rows would grow with the square of the input, and each would hold ever fewer numbers. In
    two, rows grow with its power of one and a half: each still stands for as many characters at a thousand times the input
    that one level serves. What a bunch's range holds at once is about a block."""

    block_chars: int
    groups: int
    bunches: int = 0
    ranges: int = 0

    @staticmethod
    def of(chars: int, block: int, group: int, least: int) -> Dealing:
        """For `chars` characters of input: one level if a row then stands for `least` characters or more; `block` and `group` are
        the sizes at 2^29 characters, of which they may grow up to 8 and 4 times."""
        block_chars = block * growth(chars, 8)
        groups = max(8, -(-chars // (group * growth(chars, 4))))
        if block_chars >= least * groups:
            return Dealing(block_chars, groups)
        ranges = max(2, round(groups**0.5))
        blocks_of_bunch = max(1, groups // ranges)
        return Dealing(block_chars, groups, max(1, -(-chars // (block_chars * blocks_of_bunch))), ranges)

    def place(self, block: int, group):
        """Where a block sends what is for a group, or for each group of an array: places of bunches are below zero."""
        return -1 - (block % self.bunches * self.ranges + group % self.ranges) if self.bunches else group

    def row_chars(self, chars: int) -> float:
        """Characters that a row stands for, at the level where that is least."""
        if not self.bunches:
            return self.block_chars / self.groups
        return min(self.block_chars / self.ranges, chars / self.bunches / self.groups)


def pack(x: np.ndarray) -> bytes:
    """A byte string that holds non-negative numbers: byte planes of the widest one's size, compressed."""
    import zstandard

    x = np.ascontiguousarray(x, dtype=np.uint64)
    width = max(1, (int(x.max()).bit_length() + 7) // 8) if len(x) else 1
    planes = x.view(np.uint8).reshape(-1, 8)[:, :width].T
    return bytes([width]) + len(x).to_bytes(8, "little") + zstandard.ZstdCompressor(level=1).compress(planes.tobytes())


def unpack(data: bytes) -> np.ndarray:
    import zstandard

    width, n = data[0], int.from_bytes(data[1:9], "little")
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(data[9:], max_output_size=max(1, n * width)), dtype=np.uint8).reshape(width, n)
    out = np.zeros((n, 8), dtype=np.uint8)
    out[:, :width] = planes.T
    return out.view(np.uint64).ravel()


def pack_sorted(x: np.ndarray) -> bytes:
    """As pack(), for numbers in ascending order."""
    return pack(np.diff(x, prepend=np.uint64(0)) if len(x) else x)


def unpack_sorted(data: bytes) -> np.ndarray:
    return np.cumsum(unpack(data), dtype=np.uint64)


def pack_numbered(x: np.ndarray) -> bytes:
    """As pack(), for numbers given out in order of first sight (0, 1, ...): first sights need no number, so they are 0."""
    x = np.ascontiguousarray(x, dtype=np.int64)
    new = np.diff(np.maximum.accumulate(x), prepend=-1) > 0 if len(x) else x > 0
    return pack(np.where(new, 0, x + 1))


def unpack_numbered(data: bytes) -> np.ndarray:
    x = unpack(data).astype(np.int64)
    return np.where(x == 0, np.cumsum(x == 0), x) - 1


def mix(x: np.ndarray) -> np.ndarray:
    """Numbers spread over 64 bits, each by itself."""
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))
