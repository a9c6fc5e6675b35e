"""Array helpers for whole texts inside Arrow tasks: words, word hashes, n-gram hashes.

A word is a maximal run of characters outside space and the controls 9 to 13, so words can
be cut on the UTF-8 bytes. A null text counts as empty everywhere.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

WORD_PATTERN = r"[^\x20\x09-\x0D]+"
# Texts are worked on in groups of about this many bytes; a longer text is a group of its own.
GROUP_BYTES = 2_000_000

_SPACE = np.zeros(256, dtype=bool)
_SPACE[[32, 9, 10, 11, 12, 13]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_BASE = 0x9E3779B97F4A7C15 | 1
_BASE_INVERSE = pow(_BASE, -1, 1 << 64)
_powers: dict[int, np.ndarray] = {}


def powers(base: int, count: int) -> np.ndarray:
    """base**0 .. base**(count-1) modulo 2**64; kept for reuse up to the usual group size."""
    held = _powers.get(base)
    if held is None or len(held) < count:
        held = np.full(max(count, GROUP_BYTES + 1), base, dtype=np.uint64)
        held[0] = 1
        np.multiply.accumulate(held, out=held)
        if count <= 2 * GROUP_BYTES:
            _powers[base] = held
    return held[:count]


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every input bit moves every output bit."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of a string column and the offsets of its texts."""
    column = pc.fill_null(column.cast(pa.string()) if pa.types.is_null(column.type) else column, "")
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    kind = np.int64 if pa.types.is_large_string(column.type) else np.int32
    _, where, held = column.buffers()
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    offsets = np.frombuffer(where, kind)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    data = np.frombuffer(held, np.uint8)[offsets[0] : offsets[-1]] if held is not None and held.size else np.zeros(0, np.uint8)
    return data, offsets - offsets[0]


def groups(batch: pa.RecordBatch, column: str = "text", size: int = GROUP_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut a batch into runs of rows of about `size` text bytes; no text is cut."""
    _, offsets = buffers(batch.column(column))
    start = 0
    while start < batch.num_rows:
        end = int(np.searchsorted(offsets, offsets[start] + size, "right")) - 1
        end = min(max(end, start + 1), batch.num_rows)
        yield batch.slice(start, end - start)
        start = end


def lower(data: np.ndarray) -> np.ndarray:
    """A-Z to a-z; other characters stay."""
    return _LOWER[data]


def word_bounds(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end of every word, and for each text the place of its first word (one more at the end)."""
    inside = ~_SPACE[data]
    first, last = inside.copy(), inside.copy()
    first[1:] &= ~inside[:-1]
    last[:-1] &= ~inside[1:]
    edge = offsets[:-1][offsets[:-1] < offsets[1:]]
    first[edge] = inside[edge]
    edge = offsets[1:][offsets[:-1] < offsets[1:]] - 1
    last[edge] = inside[edge]
    starts = np.flatnonzero(first)
    return starts, np.flatnonzero(last) + 1, np.searchsorted(starts, offsets)


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hash of data[start:end] for many spans, from one prefix sum."""
    prefix = np.zeros(len(data) + 1, dtype=np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * powers(_BASE, len(data)), out=prefix[1:])
    value = (prefix[ends] - prefix[starts]) * powers(_BASE_INVERSE, len(data) + 1)[starts]
    return mix(value + (ends - starts).astype(np.uint64))


def word_hashes(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Hashes of the words, their bounds, and the place of each text's first word."""
    starts, ends, places = word_bounds(data, offsets)
    return span_hashes(data, starts, ends), starts, ends, places


def gram_hashes(words: np.ndarray, size: int) -> np.ndarray:
    """Hash of every run of `size` words; one entry per word where a run starts."""
    count = len(words) - size + 1
    if count <= 0:
        return np.zeros(0, np.uint64)
    total = np.zeros(count, dtype=np.uint64)
    for k, weight in enumerate(powers(_BASE, size)):
        total += words[k : k + count] * weight
    return mix(total)


def gram_set(words: np.ndarray, size: int) -> np.ndarray:
    """Sorted distinct n-gram hashes of one text; a shorter text is one gram of all its words."""
    if not len(words):
        return np.zeros(0, np.uint64)
    return np.unique(gram_hashes(words, min(size, len(words))))
