"""Words of many texts at once, as arrays over their bytes.

Separators and letters of the contracts are ASCII or Latin-1, so UTF-8 bytes decide where a
word begins and ends. Words become dictionary codes; Python code meets distinct words only.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

# Bytes of text handled together; a longer text is handled by itself.
BYTES_AT_ONCE = 8 << 20

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def slices(batch: pa.RecordBatch, limit: int = BYTES_AT_ONCE) -> Iterator[pa.RecordBatch]:
    """Consecutive rows of a batch (with a column text) of some `limit` bytes of text each."""
    sizes = pc.fill_null(pc.binary_length(batch.column("text")), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    group = (np.cumsum(sizes) - sizes) // limit
    cuts = np.flatnonzero(np.diff(group, prepend=-1, append=-1)) if len(group) else []
    for a, b in zip(cuts[:-1], cuts[1:]):
        yield batch.slice(a, b - a)


def flat(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts (nulls are empty) and where each text begins, with the end."""
    texts = pc.fill_null(texts, "").cast(pa.large_string())
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset:texts.offset + len(texts) + 1]
    data = texts.buffers()[2]
    data = np.frombuffer(data, np.uint8)[offsets[0]:offsets[-1]] if data is not None else np.empty(0, np.uint8)
    return data, offsets - offsets[0]


def borders(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """True at the first byte of each text."""
    first = np.zeros(len(data), bool)
    first[offsets[:-1][offsets[:-1] < len(data)]] = True
    return first


def extents(inside: np.ndarray, begins: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the runs of `inside` bytes; a run also begins where `begins` says so."""
    start, end = inside.copy(), inside.copy()
    start[1:] &= ~inside[:-1] | begins[1:]
    end[:-1] &= ~inside[1:] | begins[1:]
    return np.flatnonzero(start), np.flatnonzero(end) + 1


def coded(data: np.ndarray, inside: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, pa.Array]:
    """A code for each run, and the distinct runs (binary) that the codes point to."""
    offsets = np.zeros(len(starts) + 1, np.int64)
    np.cumsum(ends - starts, out=offsets[1:])
    runs = pa.Array.from_buffers(
        pa.large_binary(), len(starts), [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(data[inside]))])
    encoded = runs.dictionary_encode()
    return encoded.indices.to_numpy().astype(np.int64), encoded.dictionary


def text_of(starts: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """The number of the text that each position is in."""
    return np.searchsorted(offsets, starts, side="right") - 1
