"""Word and window hashes of whole texts, by arrays instead of by word.

A text's bytes are looked up in a random table and summed with powers of an odd base modulo 2^64;
the hash of any run is then a difference of two running sums, times a power of the inverse base.
The same is done once more over the words' hashes for windows of words.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np

PIECE = 1 << 20
_WORD64 = 1 << 64
_MIX1, _MIX2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)

_space = np.zeros(256, bool)
_space[[9, 10, 11, 12, 13, 32]] = True
_bytes = np.random.default_rng(4711).integers(0, _WORD64, 256, dtype=np.uint64)
_lowered = _bytes.copy()
_lowered[65:91] = _bytes[97:123]


class Powers:
    """Powers of an odd base and of its inverse, grown as needed."""

    def __init__(self, base: int) -> None:
        self.base, self.inverse = base, pow(base, -1, _WORD64)
        self.up = self.down = np.ones(1, np.uint64)

    def upto(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            n = max(n, 2 * len(self.up))
            self.up, self.down = (
                np.multiply.accumulate(np.r_[np.uint64(1), np.full(n - 1, x, np.uint64)])
                for x in (self.base, self.inverse))
        return self.up, self.down


BYTE_POWERS = Powers(0x9E3779B97F4A7C13)
WINDOW_POWERS = (Powers(0xD1342543DE82EF9B), Powers(0xA0761D6478BD642B))


def mixed(x: np.ndarray) -> np.ndarray:
    """All bits of the result depend on all bits of ``x``."""
    x = (x ^ (x >> np.uint64(30))) * _MIX1
    x = (x ^ (x >> np.uint64(27))) * _MIX2
    return x ^ (x >> np.uint64(31))


def word_hashes(data: np.ndarray, lower: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and hash of each word; ``data`` ends with a space."""
    word = ~_space[data]
    turns = np.flatnonzero(word[1:] != word[:-1]) + 1
    if len(data) and word[0]:
        turns = np.r_[0, turns]
    starts, ends = turns[::2], turns[1::2]
    up, down = BYTE_POWERS.upto(len(data) + 1)
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((_lowered if lower else _bytes)[data] * up[:len(data)], out=sums[1:])
    return starts, ends, mixed((sums[ends] - sums[starts]) * down[starts]
                         + (ends - starts).astype(np.uint64))


def _pieces(text: bytes) -> Iterator[bytes]:
    """A long text cut at spaces, so that the working memory follows ``PIECE``."""
    at = 0
    while len(text) - at > 2 * PIECE:
        cut = at + PIECE
        while True:
            spaces = np.flatnonzero(_space[np.frombuffer(text[cut:cut + PIECE], np.uint8)])
            if len(spaces) or cut + PIECE >= len(text):
                break
            cut += PIECE
        cut = cut + int(spaces[0]) if len(spaces) else len(text)
        yield text[at:cut]
        at = cut
    yield text[at:]


def piece_hashes(piece: bytes, lower: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``word_hashes`` of what ``_pieces`` yields; a word of many MB is hashed by parts."""
    if len(piece) <= 3 * PIECE:
        return word_hashes(np.frombuffer(piece + b"\n", np.uint8), lower)
    # A piece is that long only if its last word goes on from within its first PIECE bytes.
    data = np.frombuffer(piece, np.uint8)
    spaces = np.flatnonzero(_space[data[:PIECE]])
    begin = int(spaces[-1]) + 1 if len(spaces) else 0
    starts, ends, hashes = word_hashes(np.frombuffer(piece[:begin] + b"\n", np.uint8), lower)
    up, total = BYTE_POWERS.upto(PIECE)[0], 0
    for at in range(begin, len(piece), PIECE):
        part = (_lowered if lower else _bytes)[data[at:at + PIECE]]
        total += int((part * up[:len(part)]).sum(dtype=np.uint64)) * pow(BYTE_POWERS.base, at - begin, _WORD64)
    last = np.array([(total + len(piece) - begin) % _WORD64], np.uint64)
    return np.r_[starts, begin], np.r_[ends, len(piece)], np.r_[hashes, mixed(last)]


def hashed(texts: Sequence[bytes | None], lower: bool = False
           ) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """In runs of texts: index of the first, words per text, and all word hashes in order."""

    def run(first: int, few: list[bytes]) -> tuple[int, np.ndarray, np.ndarray]:
        if len(few) == 1 and len(few[0]) > 2 * PIECE:
            parts = [word_hashes(np.frombuffer(p + b"\n", np.uint8), lower)[2]
                     for p in _pieces(few[0])]
            return first, np.array([sum(map(len, parts))]), np.concatenate(parts)
        starts, _, hashes = word_hashes(np.frombuffer(b"\n".join(few) + b"\n", np.uint8), lower)
        ends = np.cumsum([len(x) + 1 for x in few])
        return first, np.diff(np.searchsorted(starts, ends), prepend=0), hashes

    few, size, first = [], 0, 0
    for i, text in enumerate(texts):
        text = text or b""
        if few and size + len(text) > PIECE:
            yield run(first, few)
            few, size, first = [], 0, i
        few.append(text)
        size += len(text) + 1
    if few:
        yield run(first, few)


def windows(hashes: np.ndarray, size: int, which: int = 0) -> np.ndarray:
    """Hash of each window of ``size`` words; windows may cross texts."""
    if len(hashes) < size:
        return np.zeros(0, np.uint64)
    up, down = WINDOW_POWERS[which].upto(len(hashes) + 1)
    sums = np.zeros(len(hashes) + 1, np.uint64)
    np.cumsum(hashes * up[:len(hashes)], out=sums[1:])
    return mixed((sums[size:] - sums[:-size]) * down[:len(hashes) - size + 1]
                 + np.uint64(size * 0x9E3779B97F4A7C15 % _WORD64))
