r"""Words ``[^\x20\x09-\x0D]+`` of many texts at once, as 64-bit hashes, over the bytes of an Arrow string column."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

#: Texts are taken together up to so many bytes; a longer text is taken alone and whole.
BYTES_AT_ONCE = 500_000

_rng = np.random.default_rng(20)
_LETTER = _rng.integers(0, 2**64, 256, dtype=np.uint64)
_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_BASE, -1, 2**64)
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_powers: dict[int, np.ndarray] = {}


def _power(base: int, n: int) -> np.ndarray:
    """base ** 0 .. n - 1, modulo 2 ** 64; kept for the next call."""
    held = _powers.get(base)
    if held is None or len(held) < n:
        factors = np.full(max(n, BYTES_AT_ONCE) + 1, base, dtype=np.uint64)
        factors[0] = 1
        held = _powers[base] = np.multiply.accumulate(factors)
    return held[:n]


def mix(x: np.ndarray) -> np.ndarray:
    """Spread 64-bit values; one to one."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Words:
    """Words of some texts: ``hashes``, byte ``starts`` and ``ends`` in ``data``, and each text's range ``bounds``."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, lower: bool):
        self.data, n = (_LOWER[data] if lower else data), len(data)
        letter = ~_SPACE[data]
        first = np.zeros(n + 1, dtype=bool)
        first[offsets] = True
        before = np.zeros(n + 1, dtype=bool)
        before[1:] = letter
        after = np.zeros(n + 1, dtype=bool)
        after[:-1] = letter
        self.starts = np.flatnonzero(after & (~before | first))
        self.ends = np.flatnonzero(before & (~after | first))
        self.bounds = np.searchsorted(self.starts, offsets)
        sums = np.zeros(n + 1, dtype=np.uint64)
        np.cumsum(_LETTER[self.data] * _power(_BASE, n), out=sums[1:])
        raw = (sums[self.ends] - sums[self.starts]) * _power(_INVERSE, n + 1)[self.starts]
        self.hashes = mix(raw ^ (self.ends - self.starts).astype(np.uint64))

    def grams(self, k: int) -> np.ndarray:
        """A hash for each k neighbouring words, by the first of them; windows may reach over texts."""
        h = self.hashes
        out = np.zeros(max(0, len(h) - k + 1), dtype=np.uint64)
        for i in range(k):
            out = mix(out * np.uint64(3) + h[i : len(h) - k + 1 + i])
        return out

    def texts(self, first: np.ndarray, stop: np.ndarray) -> list[bytes]:
        """Words first .. stop - 1 (counted over all texts, none of no words), joined by one space, for each pair."""
        raw = self.data.tobytes()
        # How many gaps between neighbouring words, so far, are not one space.
        odd = np.zeros(len(self.starts), dtype=np.int64)
        if len(self.starts) > 1:
            np.cumsum((self.starts[1:] - self.ends[:-1] != 1) | (self.data[np.minimum(self.ends[:-1], len(self.data) - 1)] != 0x20), out=odd[1:])
        plain = odd[first] == odd[stop - 1]
        return [raw[a:b] if p else b" ".join(raw[a:b].split()) for a, b, p in zip(self.starts[first].tolist(), self.ends[stop - 1].tolist(), plain.tolist(), strict=True)]

    def numbers(self) -> np.ndarray:
        """The words as numbers from 0, equal for equal bytes only: hashes say which may be equal, bytes are compared."""
        _, first, number = np.unique(self.hashes, return_index=True, return_inverse=True)
        sizes = self.ends - self.starts
        like = first[number]  # a word with the same hash
        same = (sizes == sizes[like]).all()
        if same:
            shift = np.repeat(self.starts[like] - self.starts, sizes)
            inside = np.repeat(self.starts - np.cumsum(sizes) + sizes, sizes) + np.arange(len(shift))
            same = (self.data[inside] == self.data[inside + shift]).all()
        if not same:  # two words have one hash
            raw = self.data.tobytes()
            known: dict[bytes, int] = {}
            return np.array([known.setdefault(raw[a:b], len(known)) for a, b in zip(self.starts.tolist(), self.ends.tolist(), strict=True)], dtype=np.int64)
        return number


def chunks(column: pa.Array, lower: bool) -> Iterator[tuple[int, Words]]:
    """(first row, words) of successive runs of rows of a string column; nulls are empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("")
    wide = pa.types.is_large_string(column.type)
    buffers = column.buffers()
    offsets = np.frombuffer(buffers[1], dtype=np.int64 if wide else np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    data = np.frombuffer(buffers[2], dtype=np.uint8) if buffers[2] is not None else np.zeros(0, dtype=np.uint8)
    low = 0
    while low < len(column):
        high = max(low + 1, int(np.searchsorted(offsets, offsets[low] + BYTES_AT_ONCE, "right")) - 1)
        yield low, Words(data[offsets[low] : offsets[high]], offsets[low : high + 1] - offsets[low], lower)
        low = high
