"""Words of whole texts as arrays: byte positions, 64-bit hashes, runs of words.

Texts stay UTF-8 bytes. All separators are ASCII, so cutting bytes is cutting characters.
A batch is worked through in pieces of about a megabyte, so that memory does not follow
the batch; a text longer than that is one piece.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

PIECE_BYTES = 1 << 20

#: Kinds of bytes: 0 separates words, and a word ends where the kind changes.
BY_SPACE = np.array([0 if b == 0x20 or 0x09 <= b <= 0x0D else 1 for b in range(256)], np.uint8)
#: Letters, digits and all non-ASCII characters only.
ALNUM = np.array([int(b > 127 or chr(b).isalnum()) for b in range(256)], np.uint8)
#: Runs of marks are words too.
ALNUM_OR_MARKS = np.where(BY_SPACE == 0, 0, np.where(ALNUM == 1, 1, 2)).astype(np.uint8)
AS_IS = np.arange(256, dtype=np.uint8)
LOWER = np.array([b + 32 if 65 <= b <= 90 else b for b in range(256)], np.uint8)

_BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
_BASE_INVERSE = np.uint64(pow(int(_BASE), -1, 1 << 64))


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit over all others."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def seed_of(*parts: int) -> np.uint64:
    x = np.zeros(1, np.uint64)
    for p in parts:
        x = mix(x + np.uint64(p) + np.uint64(0x632BE59BD9B4E019))
    return x[0]


_powers: dict[str, np.ndarray] = {}


def _power_table(n: int) -> tuple[np.ndarray, np.ndarray]:
    if "up" not in _powers or len(_powers["up"]) < n:
        size = max(n, PIECE_BYTES + 4096)
        for name, base in (("up", _BASE), ("down", _BASE_INVERSE)):
            steps = np.full(size, base, np.uint64)
            steps[0] = 1
            _powers[name] = np.cumprod(steps)
    return _powers["up"], _powers["down"]


@dataclass
class Piece:
    """Some neighbouring texts: their bytes, and where each begins; ``first`` is the row of the first."""

    first: int
    data: np.ndarray
    offsets: np.ndarray

    @property
    def n_texts(self) -> int:
        return len(self.offsets) - 1


def pieces(column: pa.Array) -> Iterator[Piece]:
    """Null counts as the empty text."""
    array = pc.fill_null(column, "").cast(pa.large_string())
    if len(array) == 0:
        return
    offsets = np.frombuffer(array.buffers()[1], np.int64)[array.offset : array.offset + len(array) + 1]
    values = array.buffers()[2]
    data = np.frombuffer(values, np.uint8) if values is not None else np.zeros(0, np.uint8)
    low = 0
    while low < len(array):
        high = int(np.searchsorted(offsets, offsets[low] + PIECE_BYTES, "right")) - 1
        high = min(max(high, low + 1), len(array))
        yield Piece(low, data[offsets[low] : offsets[high]], offsets[low : high + 1] - offsets[low])
        low = high


@dataclass
class Words:
    """Byte range, text and hash of every word of a piece, in order."""

    starts: np.ndarray
    ends: np.ndarray
    text: np.ndarray
    hashes: np.ndarray
    per_text: np.ndarray
    first_word: np.ndarray


def words(piece: Piece, kinds: np.ndarray = BY_SPACE, fold: np.ndarray = LOWER) -> Words:
    data = fold[piece.data]
    n = len(data)
    kind = np.zeros(n + 2, np.uint8)
    kind[1:-1] = kinds[data]
    change = kind[1:] != kind[:-1]
    change[piece.offsets] = True
    starts = np.flatnonzero(change & (kind[1:] > 0))
    stops = np.flatnonzero(change & (kind[:-1] > 0))
    text = np.searchsorted(piece.offsets, starts, "right") - 1
    up, down = _power_table(n + 1)
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[:n], out=sums[1:])
    hashes = mix((sums[stops] - sums[starts]) * down[starts] + (stops - starts).astype(np.uint64))
    per_text = np.bincount(text, minlength=piece.n_texts)
    first = np.zeros(piece.n_texts + 1, np.int64)
    np.cumsum(per_text, out=first[1:])
    return Words(starts, stops, text, hashes, per_text, first)


def word_runs(w: Words, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash and first word of every run of ``length`` words of one text."""
    n = len(w.hashes) - length + 1
    if n <= 0:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    at = np.flatnonzero(w.text[:n] == w.text[length - 1 :])
    return _chain(w.hashes, at, length), at


def _chain(hashes: np.ndarray, at: np.ndarray, length: int) -> np.ndarray:
    value = mix(hashes[at] + seed_of(length))
    for k in range(1, length):
        value = mix(value * np.uint64(3) + hashes[at + k])
    return value


def shingle_sets(w: Words, length: int) -> list[np.ndarray]:
    """Per text its distinct shingles, sorted: runs of ``length`` words; of a shorter text the
    whole sequence; of a text without words none."""
    runs, at = word_runs(w, length)
    of = w.text[at] if len(at) else at
    cuts = np.searchsorted(of, np.arange(len(w.per_text) + 1))
    found = []
    for k, n in enumerate(w.per_text):
        if n >= length:
            found.append(np.unique(runs[cuts[k] : cuts[k + 1]]))
        elif n:
            found.append(_chain(w.hashes, w.first_word[k : k + 1], int(n)))
        else:
            found.append(np.zeros(0, np.uint64))
    return found


def signed(x: np.ndarray) -> np.ndarray:
    """Spark's longs are signed."""
    return x.view(np.int64)
