"""Words of whole texts as 64-bit hashes, found in the UTF-8 bytes of an Arrow column.

Helpers for code inside Spark tasks.  Texts are cut into pieces of bounded size; a text longer
than a piece is a piece of its own, and its bytes are hashed in bounded windows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

# Bytes of text that one piece holds (a single longer text excepted), and that one hashing window holds.
# A window's 64-bit sums and powers should stay in a core's cache.
PIECE_BYTES = 1 << 20
WINDOW_BYTES = 1 << 18

_BASE = np.uint64(0x9E3779B97F4A7C15)
_GOLDEN = np.uint64(0x9E3779B97F4A7C15)


def mix(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit integers (the finalizer of splitmix64)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x = x * np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def _fold(data: np.ndarray) -> np.ndarray:
    """Lower-case A to Z, leave every other byte."""
    table = np.arange(256, dtype=np.uint8)
    table[65:91] += 32
    return table[data]


def _letters() -> np.ndarray:
    """Bytes of ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]`` once A to Z are lower-cased."""
    table = np.zeros(256, dtype=bool)
    for low, high in ((0x30, 0x3A), (0x41, 0x5B), (0x61, 0x7B), (0x80, 0x100)):
        table[low:high] = True
    return table


def _solid() -> np.ndarray:
    """Bytes of ``[^\\x20\\x09-\\x0D]``."""
    table = np.ones(256, dtype=bool)
    table[[0x20, *range(0x09, 0x0E)]] = False
    return table


LETTERS, SOLID = _letters(), _solid()
# Values of the bytes once A to Z are lower-cased.
_BYTE_VALUE = mix(np.arange(1, 257, dtype=np.uint64) * _GOLDEN)[_fold(np.arange(256, dtype=np.uint8))]
_powers: dict[str, np.ndarray] = {}


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse modulo 2**64."""
    have = _powers.get("up")
    if have is None or len(have) < n:
        size = max(n, 1 << 16)
        inverse = np.uint64(pow(int(_BASE), -1, 1 << 64))
        for name, base in (("up", _BASE), ("down", inverse)):
            steps = np.full(size, base, dtype=np.uint64)
            steps[0] = 1
            _powers[name] = np.cumprod(steps, dtype=np.uint64)
    return _powers["up"], _powers["down"]


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a string column and the offset of each text; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column.cast(pa.large_string()), "")
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, dtype=np.int64)[column.offset: column.offset + len(column) + 1]
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, dtype=np.uint8)
    return raw[at[0]: at[-1]], at - at[0]


def pieces(offsets: np.ndarray, limit: int = PIECE_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of texts, each of at most ``limit`` bytes or of one text."""
    low, n = 0, len(offsets) - 1
    while low < n:
        high = int(np.searchsorted(offsets, offsets[low] + limit, side="right")) - 1
        high = min(max(high, low + 1), n)
        yield low, high
        low = high


def spans(data: np.ndarray, offsets: np.ndarray, inside: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First byte and byte after the last of every word; no word crosses from text to text."""
    if not len(data):
        empty = np.zeros(0, dtype=np.int64)
        return empty, empty
    mask = np.frombuffer(data.tobytes().translate(inside.tobytes()), dtype=bool)
    cut = np.zeros(len(data) + 1, dtype=bool)
    cut[offsets] = True
    edge = (mask[1:] != mask[:-1]) | cut[1:-1]
    first, last = mask.copy(), mask.copy()
    first[1:] &= edge
    last[:-1] &= edge
    starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
    return starts, ends


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each word, A to Z lower-cased."""
    out = np.empty(len(starts), dtype=np.uint64)
    low, n = 0, len(starts)
    while low < n:
        first = int(starts[low])
        high = max(low + 1, int(np.searchsorted(ends, first + WINDOW_BYTES, side="right")))
        window = data[first: int(ends[high - 1])]
        up, down = _power_tables(len(window) + 1)
        sums = np.zeros(len(window) + 1, dtype=np.uint64)
        np.take(_BYTE_VALUE, window, out=sums[1:], mode="clip")
        sums[1:] *= up[: len(window)]
        np.cumsum(sums, out=sums)
        a, b = starts[low:high] - first, ends[low:high] - first
        out[low:high] = mix((sums[b] - sums[a]) * down[a] + (b - a).astype(np.uint64) * _GOLDEN)
        low = high
    return out


def hashed_words(data: np.ndarray, offsets: np.ndarray, inside: np.ndarray):
    """(starts, ends, hashes, word offset of each text) of one piece."""
    starts, ends = spans(data, offsets, inside)
    return starts, ends, word_hashes(data, starts, ends), np.searchsorted(starts, offsets)


def shingle_sets(hashes: np.ndarray, word_at: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """The distinct shingles of each text, ascending, and their offsets.

    A text of fewer than ``width`` words, but not none, has its whole sequence as one shingle.
    """
    counts = np.diff(word_at)
    n_docs = len(counts)
    made = np.where(counts >= width, counts - width + 1, (counts > 0).astype(counts.dtype))
    at = np.concatenate([[0], np.cumsum(made)])
    doc = np.repeat(np.arange(n_docs), made)
    first = word_at[doc] + (np.arange(at[-1]) - at[doc])
    length = np.minimum(counts[doc], width)
    value = mix(length.astype(np.uint64) * _GOLDEN)
    for k in range(width):
        there = length > k
        step = np.uint64((2 * k + 3) * 0x632BE59BD9B4E019 % (1 << 64))
        if there.all():
            value = value + mix(hashes[first + k] ^ step) * (step | np.uint64(1))
        elif there.any():
            value[there] += mix(hashes[first[there] + k] ^ step) * (step | np.uint64(1))
    value = mix(value)
    order = np.argsort(value)
    small = doc.astype(np.uint16) if n_docs < 1 << 16 else doc
    order = order[np.argsort(small[order], kind="stable")]
    value, doc = value[order], doc[order]
    new = np.ones(len(value), dtype=bool)
    if len(value):
        new[1:] = (value[1:] != value[:-1]) | (doc[1:] != doc[:-1])
    value, doc = value[new], doc[new]
    return value, np.searchsorted(doc, np.arange(n_docs + 1))
