"""Words and 64-bit hashes of whole batches of UTF-8 texts, in numpy.

Texts arrive as Arrow string arrays inside ``mapInArrow`` tasks. Everything
here works on one slice of such an array (a few MB of text at a time), so a
task's memory does not depend on the size of its partition; a text longer
than a slice forms a slice of its own.

Words are the maximal runs of bytes other than 0x20 and 0x09-0x0D, which for
valid UTF-8 are the matches of ``[^\\x20\\x09-\\x0D]+``; A-Z is lower-cased.
A null text counts as empty.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

SLICE_BYTES = 2 << 20

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
SPACE = np.zeros(256, dtype=bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True

_BASE = np.uint64(0x9E3779B97F4A7C15)
_BASE_INV = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))


def mix(x: np.ndarray) -> np.ndarray:
    """The splitmix64 finaliser: a bijection of 64-bit values."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_BYTE = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0xD1342543DE82EF95))
_powers: dict[bool, np.ndarray] = {}


def _power(n: int, inverse: bool) -> np.ndarray:
    have = _powers.get(inverse)
    if have is None or len(have) < n:
        base = _BASE_INV if inverse else _BASE
        have = np.full(n, base, dtype=np.uint64)
        have[:1] = 1
        have = np.multiply.accumulate(have)
        if n <= 4 * SLICE_BYTES:
            _powers[inverse] = have
    return have[:n]


def slices(column: pa.Array, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, bytes, offsets) for runs of rows of at most ``limit`` bytes."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("" if pa.types.is_string(column.type) or pa.types.is_large_string(column.type) else b"")
    n = len(column)
    if n == 0:
        return
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, offset_buffer, data = column.buffers()
    offsets = np.frombuffer(offset_buffer, np.int64 if wide else np.int32)[column.offset:column.offset + n + 1].astype(np.int64)
    whole = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    a = 0
    while a < n:
        b = max(a + 1, int(np.searchsorted(offsets, offsets[a] + limit, "right")) - 1)
        yield a, b, whole[offsets[a]:offsets[b]], offsets[a:b + 1] - offsets[a]
        a = b


def word_spans(buf: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Word starts, word ends, and per text the index of its first word (one more entry at the end)."""
    solid = ~SPACE[buf]
    edge = np.zeros(len(buf) + 1, dtype=bool)
    edge[offsets] = True
    first = solid.copy()
    first[1:] &= ~solid[:-1] | edge[1:-1]
    last = solid.copy()
    last[:-1] &= ~solid[1:] | edge[1:-1]
    starts = np.flatnonzero(first)
    return starts, np.flatnonzero(last) + 1, np.searchsorted(starts, offsets)


def prefix_hash(buf: np.ndarray) -> np.ndarray:
    """Running polynomial sums; ``span_hash`` takes differences of them."""
    sums = np.zeros(len(buf) + 1, dtype=np.uint64)
    np.cumsum(_BYTE[buf] * _power(len(buf), False), out=sums[1:])
    return sums


def span_hash(sums: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each byte span, the same for equal bytes wherever they stand."""
    raw = (sums[ends] - sums[starts]) * _power(len(sums), True)[starts]
    return mix(raw + (ends - starts).astype(np.uint64) * np.uint64(0xA0761D6478BD642F))


def word_hashes(buf: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all lower-cased words of a slice, and the word offsets of its texts."""
    starts, ends, first = word_spans(buf, offsets)
    if not len(starts):
        return np.zeros(0, np.uint64), first
    return span_hash(prefix_hash(LOWER[buf]), starts, ends), first


_STEP = np.uint64(0xE7037ED1A0B428DB)


def shingle_hashes(words: np.ndarray, n: int) -> np.ndarray:
    """Hashes of the n-word shingles of one word sequence, in order; a shorter
    non-empty sequence is one shingle as a whole, an empty one has none."""
    m = min(n, len(words))
    if m == 0:
        return words[:0]
    total = np.zeros(len(words) - m + 1, dtype=np.uint64)
    for i in range(m):
        total = total * _STEP + words[i:len(words) - m + 1 + i]
    return mix(total + np.uint64(m))
