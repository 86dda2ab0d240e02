"""Words of a batch of texts as numpy arrays over one byte buffer.

Tasks receive Arrow batches.  They are cut into chunks of a bounded number of
bytes (a single longer text is a chunk of its own), and all work on words is
array work on the bytes of a chunk: no Python object per word.
"""

from __future__ import annotations

import sys
import types
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Bytes of text that a task works on at once.
CHUNK = 5 << 20

#: Bytes that separate words: space and tab to carriage return.
SEPARATOR = np.zeros(256, dtype=bool)
SEPARATOR[[9, 10, 11, 12, 13, 32]] = True

#: Lower-cases A-Z and leaves every other byte.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


class Words(NamedTuple):
    """Words ``start[i]:end[i]`` of ``data``; text ``d`` has words ``first[d]:first[d + 1]``."""

    data: np.ndarray
    start: np.ndarray
    end: np.ndarray
    first: np.ndarray

    def owner(self) -> np.ndarray:
        """The text that each word belongs to."""
        return np.repeat(np.arange(len(self.first) - 1), np.diff(self.first))


def worker_state() -> dict:
    """A dictionary that lives as long as the Python worker, over many tasks."""
    name = "_ordermill_llm_worker"
    return sys.modules.setdefault(name, types.ModuleType(name)).__dict__


def slices(batches: Iterator[pa.RecordBatch], text: str = "text", limit: int = CHUNK) -> Iterator[pa.RecordBatch]:
    """The batches again, cut so that the texts of each have ``limit`` bytes at most (or are one text)."""
    for batch in batches:
        ends = np.cumsum(pc.fill_null(pc.binary_length(batch.column(text)), 0).to_numpy(zero_copy_only=False), dtype=np.int64)
        at = 0
        while at < batch.num_rows:
            done = ends[at - 1] if at else 0
            to = max(at + 1, int(np.searchsorted(ends, done + limit, side="right")))
            yield batch.slice(at, to - at)
            pa.default_memory_pool().release_unused()
            at = to


def layout(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts and where each begins; a null is an empty text."""
    return layout_bytes(pc.fill_null(texts, "").cast(pa.large_string()))


def layout_bytes(values: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all values (a large string or binary array without nulls) and where each begins."""
    _, offsets, data = values.buffers()
    if not len(values):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    offsets = np.frombuffer(offsets, dtype=np.int64)[values.offset : values.offset + len(values) + 1]
    data = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def words(texts: pa.Array, lower: bool = False) -> Words:
    """The words of all texts: longest runs of bytes that are no separators."""
    data, offsets = layout(texts)
    if lower:
        data = LOWER[data]
    solid = ~SEPARATOR[data]
    start, end = solid.copy(), solid.copy()
    start[1:] &= ~solid[:-1]
    end[:-1] &= ~solid[1:]
    filled = np.flatnonzero(np.diff(offsets))
    start[offsets[filled]] = solid[offsets[filled]]
    end[offsets[filled + 1] - 1] = solid[offsets[filled + 1] - 1]
    start = np.flatnonzero(start)
    return Words(data, start, np.flatnonzero(end) + 1, np.searchsorted(start, offsets))


def ragged(start: np.ndarray, length: np.ndarray) -> np.ndarray:
    """The numbers ``start[i] .. start[i] + length[i] - 1`` of all i, one after the other."""
    total = int(length.sum())
    steps = np.ones(total, dtype=np.int64)
    start, length = start[length > 0], length[length > 0]
    if total:
        steps[0] = start[0]
        steps[np.cumsum(length)[:-1]] = start[1:] - start[:-1] - length[:-1] + 1
    return np.cumsum(steps)


def binaries(data: np.ndarray, offsets: np.ndarray) -> pa.Array:
    """``data[offsets[i]:offsets[i + 1]]`` as an Arrow array, without copying the bytes."""
    offsets = np.ascontiguousarray(offsets, dtype=np.int64)
    return pa.Array.from_buffers(pa.large_binary(), len(offsets) - 1, [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(data))])


def word_array(w: Words) -> pa.Array:
    """All words as an Arrow array."""
    length = w.end - w.start
    return binaries(w.data[ragged(w.start, length)], np.concatenate(([0], np.cumsum(length))))


def numbered(values: pa.Array) -> tuple[np.ndarray, pa.Array]:
    """Equal values get equal numbers: the number of each, and the distinct values."""
    coded = values.dictionary_encode()
    return coded.indices.to_numpy(zero_copy_only=False), coded.dictionary


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit numbers (the finaliser of splitmix64)."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def powers(base: int, n: int) -> np.ndarray:
    """``base ** 0 .. base ** (n - 1)`` modulo 2**64."""
    out = np.full(max(n, 1), base, dtype=np.uint64)
    out[0] = 1
    return np.cumprod(out)


_BASE = 0x9E3779B97F4A7C15
_UNBASE = pow(_BASE, -1, 1 << 64)


def span_hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each ``data[start:end]``, the same wherever the bytes stand.

    Prefix sums of byte times power, so the cost does not depend on the spans.
    """
    codes = (data.astype(np.uint64) + np.uint64(1)) * np.uint64(0xD6E8FEB86659FD93)
    sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(codes * powers(_BASE, len(data)))))
    return mixed((sums[end] - sums[start]) * powers(_UNBASE, len(data) + 1)[start])


def window_keys(codes: np.ndarray, size: int) -> np.ndarray:
    """A 64-bit hash of each run of ``size`` consecutive codes."""
    n = max(0, len(codes) - size + 1)
    keys = np.zeros(n, dtype=np.uint64)
    codes = mixed(codes.astype(np.uint64) + np.uint64(1))
    for i in range(size):
        keys *= np.uint64(_BASE)
        keys += codes[i : i + n]
    return mixed(keys)


def equal_windows(codes: np.ndarray, starts: np.ndarray, size: int, group: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Sort the windows of ``size`` codes that begin at ``starts``: the order, and where each run of equal ones begins.

    With ``group``, windows are equal only within a group.  Equal windows keep
    their order.  They are sorted by a hash and neighbours are then compared
    code by code; should two different windows share a hash, the codes are
    sorted instead.
    """
    if not len(starts):
        return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=bool)
    keys = window_keys(codes, size)[starts]
    if group is not None:
        keys = mixed(keys + group.astype(np.uint64) * np.uint64(_BASE))
    order = np.argsort(keys, kind="stable")
    fresh = np.concatenate(([True], keys[order[1:]] != keys[order[:-1]]))

    def differ(pairs: np.ndarray) -> np.ndarray:
        left, right = order[pairs - 1], order[pairs]
        unlike = np.zeros(len(pairs), dtype=bool) if group is None else group[left] != group[right]
        for i in range(size):
            unlike |= codes[starts[left] + i] != codes[starts[right] + i]
        return unlike

    if differ(np.flatnonzero(~fresh)).any():
        columns = [codes[starts + i] for i in range(size)]
        order = np.lexsort(columns if group is None else [*columns, group])
        fresh = np.ones(len(order), dtype=bool)
        fresh[1:] = differ(np.arange(1, len(order)))
    return order, fresh


def inside(first: np.ndarray, size: int) -> np.ndarray:
    """The starts of all windows of ``size`` words that lie in one text."""
    n = np.maximum(np.diff(first) - size + 1, 0)
    return ragged(first[:-1], n)


def covered(starts: np.ndarray, size: int, total: int) -> np.ndarray:
    """Which of ``total`` words lie in a window of ``size`` that begins at one of ``starts``."""
    edge = np.zeros(total + 1, dtype=np.int32)
    np.add.at(edge, starts, 1)
    np.add.at(edge, np.minimum(starts + size, total), -1)
    return np.cumsum(edge[:-1]) > 0


def per_text(marks: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """The sum of ``marks`` between each two ``bounds``."""
    sums = np.concatenate(([0], np.cumsum(marks, dtype=np.int64)))
    return sums[bounds[1:]] - sums[bounds[:-1]]
