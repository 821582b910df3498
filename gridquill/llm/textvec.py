"""Vectorised text kernels: words, hashes and windows over a whole Arrow batch of texts at once.

All arrays are numpy; no function loops over characters or words in Python. A batch is cut into
slices of about SLICE_BYTES of text, so memory is bounded by the slice or by one longest text.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SLICE_BYTES = 1 << 20

U = np.uint64
_RADIX = 0x9E3779B97F4A7C15
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
IDENTITY = np.arange(256, dtype=np.uint8)


def mix(x: np.ndarray) -> np.ndarray:
    """SplitMix64 finaliser."""
    x = x.astype(U, copy=True)
    x ^= x >> U(30)
    x *= U(0xBF58476D1CE4E5B9)
    x ^= x >> U(27)
    x *= U(0x94D049BB133111EB)
    x ^= x >> U(31)
    return x


def constants(seed: int, n: int) -> np.ndarray:
    """n odd multipliers, fixed by the seed."""
    return mix(np.arange(1, n + 1, dtype=U) + U((seed * _RADIX) % (1 << 64))) | U(1)


_POWERS = np.ones(1, U)


def powers(n: int) -> np.ndarray:
    """Powers 0..n-1 of an odd radix modulo 2**64, grown on demand."""
    global _POWERS
    if len(_POWERS) < n:
        factors = np.full(max(n, 2 * len(_POWERS), 256), _RADIX, U)
        factors[0] = 1
        _POWERS = np.multiply.accumulate(factors)
    return _POWERS


def lower_latin(data: np.ndarray) -> np.ndarray:
    """A copy in which the capitals of ASCII and Latin-1 (bytes C3 80 to C3 9E, but for the times sign) are small."""
    out = LOWER[data]
    after = np.flatnonzero(data[:-1] == 0xC3) + 1
    capital = after[(data[after] >= 0x80) & (data[after] <= 0x9E) & (data[after] != 0x97)]
    out[capital] += 32
    return out


def utf8(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string or binary column; null counts as empty. Offsets start at 0."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_binary())
    if column.null_count:
        column = pc.fill_null(column, b"")
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    bounds = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    raw = column.buffers()[2]
    data = np.frombuffer(raw, np.uint8) if raw is not None else np.zeros(0, np.uint8)
    return data[bounds[0] : bounds[-1]], bounds - bounds[0]


def slices(offsets: np.ndarray, most: int = SLICE_BYTES, rows: int = 1 << 14) -> Iterator[tuple[int, int]]:
    """Row ranges whose texts hold about ``most`` bytes, ``rows`` rows at most; a longer text stands alone."""
    row, n = 0, len(offsets) - 1
    while row < n:
        end = int(np.searchsorted(offsets, offsets[row] + most, "right")) - 1
        end = min(max(end, row + 1), row + rows, n)
        yield row, end
        row = end


class Words:
    """The words of some texts: ``hash`` and ``doc`` by word, ``first`` by text (one entry more than texts).

    ``start`` and ``length`` are byte positions in ``data``.
    """

    def __init__(self, data: np.ndarray, offsets: np.ndarray, table: np.ndarray = LOWER, drop: np.ndarray | None = None, breaks: np.ndarray | None = None):
        """table maps bytes before hashing; drop marks bytes that separate words besides white space;
        breaks marks positions in data at which a new word starts in any case."""
        gap = _SPACE if drop is None else _SPACE | drop
        at = np.flatnonzero(~gap[data])
        fresh = np.ones(len(at), bool)
        if len(at):
            begins = np.zeros(len(data) + 1, bool)
            begins[offsets[:-1]] = True
            if breaks is not None:
                begins[: len(data)] |= breaks
            fresh[1:] = (at[1:] != at[:-1] + 1) | begins[at[1:]]
        first_char = np.flatnonzero(fresh)
        self.start = at[first_char]
        self.length = np.diff(np.append(first_char, len(at)))
        if len(first_char):
            inside = np.arange(len(at)) - np.repeat(first_char, self.length)
            value = (table[data[at]].astype(U) + U(1)) * powers(int(self.length.max()))[inside]
            self.hash = mix(np.add.reduceat(value, first_char) + self.length.astype(U) * U(0xD6E8FEB86659FD93))
        else:
            self.hash = np.zeros(0, U)
        self.first = np.searchsorted(self.start, offsets)
        self.count = np.diff(self.first)
        self.doc = np.repeat(np.arange(len(self.count)), self.count)


def windows(words: Words, width: int, seed: int = 1) -> tuple[np.ndarray, np.ndarray]:
    """(hash, index of the first word) of all runs of ``width`` words inside one text."""
    n = len(words.hash) - width + 1
    if n <= 0:
        return np.zeros(0, U), np.zeros(0, np.int64)
    total = np.zeros(n, U)
    for k, c in enumerate(constants(seed, width)):
        total += words.hash[k : k + n] * c
    at = np.flatnonzero(words.doc[:n] == words.doc[width - 1 :])
    return mix(total[at]), at


def shingle_sets(data: np.ndarray, offsets: np.ndarray, width: int = 5) -> list[np.ndarray]:
    """For each text its sorted distinct hashes of ``width``-word shingles.

    A text with fewer words has its whole word sequence as one shingle; one without words has none.
    """
    words = Words(data, offsets)
    value, at = windows(words, width)
    bounds = np.searchsorted(at, words.first)
    out = []
    for row in range(len(words.count)):
        n = int(words.count[row])
        if n >= width:
            out.append(np.unique(value[bounds[row] : bounds[row + 1]]))
        elif n:
            own = words.hash[words.first[row] : words.first[row + 1]]
            out.append(mix((own * constants(1000 + n, n)).sum(keepdims=True, dtype=U)))
        else:
            out.append(np.zeros(0, U))
    return out


def text_slices(batches: Iterator[pa.RecordBatch], column: str = "text", most: int = SLICE_BYTES, rows: int = 1 << 14):
    """(batch slice, bytes, offsets) over all batches, in order."""
    for batch in batches:
        data, offsets = utf8(batch.column(column))
        for a, b in slices(offsets, most, rows):
            yield batch.slice(a, b - a), data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a]
