"""Vectorised work on the UTF-8 bytes of Arrow string columns: words, word hashes, shingle hashes."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

U64 = np.uint64


def byte_class(pattern: str) -> np.ndarray:
    """Which of the 256 bytes match the one-character bytes pattern ``pattern``."""
    import re

    r = re.compile(pattern.encode("latin-1"), re.S)
    return np.array([bool(r.fullmatch(bytes([i]))) for i in range(256)])


def lower_table() -> np.ndarray:
    t = np.arange(256, dtype=np.uint8)
    t[65:91] += 32
    return t


def column_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string column and the n + 1 offsets of its rows; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = pc.fill_null(column, b"" if pa.types.is_binary(column.type) or pa.types.is_large_binary(column.type) else "")
    large = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, off, data = column.buffers()
    offsets = np.frombuffer(off, np.int64 if large else np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64) if off is not None and len(column) else np.zeros(len(column) + 1, np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    raw = raw[offsets[0] : offsets[-1]]
    return raw, offsets - offsets[0]


def row_blocks(offsets: np.ndarray, most: int = 1 << 20) -> Iterator[tuple[int, int]]:
    """Row ranges of at most ``most`` bytes; a longer row is a range of its own, never cut."""
    n, lo = len(offsets) - 1, 0
    while lo < n:
        hi = max(lo + 1, int(np.searchsorted(offsets, offsets[lo] + most, "right")) - 1)
        yield lo, min(hi, n)
        lo = min(hi, n)


def word_spans(raw: np.ndarray, offsets: np.ndarray, is_word: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end byte of each word, and the number of words before each row (n + 1 values).

    A word is a maximal run of bytes of the class ``is_word`` inside one row.
    """
    if not len(raw):
        z = np.zeros(0, np.int64)
        return z, z, np.zeros(len(offsets), np.int64)
    w = is_word[raw]
    first = w.copy()
    first[1:] &= ~w[:-1]
    last = w.copy()
    last[:-1] &= ~w[1:]
    inner = offsets[(offsets > 0) & (offsets < len(raw))]
    first[inner] = w[inner]
    last[inner - 1] = w[inner - 1]
    starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (bijective)."""
    x = x ^ (x >> U64(30))
    x *= U64(0xBF58476D1CE4E5B9)
    x ^= x >> U64(27)
    x *= U64(0x94D049BB133111EB)
    x ^= x >> U64(31)
    return x


MASKS = np.array([(1 << (8 * i)) - 1 for i in range(8)] + [(1 << 64) - 1], dtype=np.uint64)


def span_hashes(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of the bytes of each span; eight bytes are taken in at a time."""
    padded = np.concatenate([raw, np.zeros(8, np.uint8)])
    lanes = np.ndarray((len(padded) - 7,), dtype="<u8", buffer=padded, strides=(1,))
    size = ends - starts
    h = mix(size.astype(np.uint64) + U64(0x9E3779B97F4A7C15))
    live, at = np.arange(len(starts)), 0
    while len(live):
        rest = size[live] - at
        keep = rest > 0
        if not keep.all():
            live, rest = live[keep], rest[keep]
            if not len(live):
                break
        lane = lanes[starts[live] + at] & MASKS[np.minimum(rest, 8)]
        h[live] = mix((h[live] ^ lane) * U64(0xFF51AFD7ED558CCD) + U64(0x2545F4914F6CDD1D))
        at += 8
    return h


def shingle_hashes(words: np.ndarray, k: int) -> np.ndarray:
    """Hash of the ``k`` words from each position on (len(words) - k + 1 values)."""
    n = len(words) - k + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    h = np.full(n, U64(k), np.uint64)
    for i in range(k):
        h = (h ^ words[i : i + n]) * U64(0x9FB21C651E98DF25)
        h ^= h >> U64(32)
    return mix(h)
